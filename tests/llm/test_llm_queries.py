"""The registered queries against DuckDB, and their columns."""

from __future__ import annotations

import pytest
from compare import connect, difference

from termledger.llm.queries import ORACLE, QUERIES

COLUMNS = {
    "op1_mixing": {"doc_id", "size", "source_size", "target", "taken"},
    "op2_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op3_url_filter": {"page_id", "host", "path", "rule", "verdict"},
    "op5_simhash": {"doc_id", "fingerprint", "component_id"},
    "op9_token_counts": {"doc_id", "n_bytes", "n_tokens", "over_limit"},
    "op10_topk": {"query_id", "rank", "vec_id", "score"},
    "op11_lexical_search": {"item_id", "rank", "doc_id", "score"},
    "op12_source_divergence": {"lang", "source", "part", "item", "value", "rank"},
    "op13_sentencepiece": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(name, spark, tiny):
    assert difference(QUERIES[name](spark, tiny), connect(tiny), ORACLE[name]) == ""


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_agreed_columns(name, spark, tiny):
    assert COLUMNS[name] <= set(QUERIES[name](spark, tiny).columns)


def test_thirteen_operators():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
