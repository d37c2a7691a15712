"""One query per operator, over its whole tables, and the same in SQL where SQL
can say it. The queries reduce the operators' results to the agreed columns."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from termledger.llm import (
    decontaminate,
    divergence,
    lexical,
    licenses,
    lines,
    mixing,
    pieces,
    sharding,
    simhash,
    tokens,
    topk,
    toxicity,
    url_rules,
)
from termledger.llm.common import load
from termledger.llm.url_rules import Rule
from termledger.session import work_dir

MIX_WEIGHTS = (5, 2, 1)
URL_RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]
TOKENIZER = "piece_bpe_32k.model"
SHARDS = [f"shard-{k:02d}" for k in range(16)]


def op1_mixing(spark, sf_dir):
    return mixing.mix(load(spark, sf_dir, "documents"), MIX_WEIGHTS).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "repeats"
    )


def op2_toxicity(spark, sf_dir):
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(~toxicity.held_out()))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op3_url_filter(spark, sf_dir):
    found = url_rules.judge(load(spark, sf_dir, "pages"), URL_RULES)
    return found.select("page_id", "host", "path", "rule", "verdict", "mined", "confidence")


def op4_license_scan(spark, sf_dir):
    return licenses.scan(load(spark, sf_dir, "documents"))


def op5_simhash(spark, sf_dir):
    found = simhash.near_duplicates(load(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op6_decontamination(spark, sf_dir):
    found = decontaminate.contaminated(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return found.drop("doc_text")


def op7_sharding(spark, sf_dir):
    return sharding.place(load(spark, sf_dir, "documents").select("doc_id"), SHARDS)


def op8_line_dedup(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return lines.dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "clean_text")


def op9_token_counts(spark, sf_dir):
    """With a cache of its own, so that every run does the whole work."""
    import public_tokenizers

    tokenizer = tokens.Tokenizer(public_tokenizers.path(TOKENIZER))
    cache = f"{work_dir(spark)}/token-counts-{uuid.uuid4().hex}"
    return tokens.count_tokens(load(spark, sf_dir, "documents"), tokenizer, cache)


def op10_topk(spark, sf_dir):
    found = topk.top_k(load(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)
    return found.select("query_id", "rank", "vec_id", "score")


def op11_lexical_search(spark, sf_dir):
    return lexical.search(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op12_source_divergence(spark, sf_dir):
    return divergence.audit(load(spark, sf_dir, "documents"))


def op13_sentencepiece(spark, sf_dir):
    import public_tokenizers

    model = pieces.Pieces(public_tokenizers.path(TOKENIZER))
    return pieces.round_trip(pieces.encode(load(spark, sf_dir, "documents"), model), model)


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_toxicity": op2_toxicity,
    "op3_url_filter": op3_url_filter,
    "op4_license_scan": op4_license_scan,
    "op5_simhash": op5_simhash,
    "op6_decontamination": op6_decontamination,
    "op7_sharding": op7_sharding,
    "op8_line_dedup": op8_line_dedup,
    "op9_token_counts": op9_token_counts,
    "op10_topk": op10_topk,
    "op11_lexical_search": op11_lexical_search,
    "op12_source_divergence": op12_source_divergence,
    "op13_sentencepiece": op13_sentencepiece,
}

_SIZE = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"


def _draw(seed: str, *columns: str) -> str:
    key = " || '|' || ".join(f"coalesce(cast({column} as varchar), '<null>')" for column in columns)
    return f"cast('0x' || substr(md5('{seed}|' || {key}), 1, 13) as bigint)"


def _terms(kept: str, text: str = "text") -> str:
    """The terms of a text: runs of the signs of ``kept``, A-Z lower-cased."""
    lower = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all({lower}, '{kept}')"


_SEARCHED = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_AUDITED = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"

ORACLE = {
    # Sources ordered by the level at which they are full: the first that the
    # level of those after it doesn't fill ends the clamping.
    "op1_mixing": f"""
with d as (
  select doc_id, source, cast({_SIZE} as bigint) as size, {_draw("mix", "doc_id", "md5(text)")} as draw
  from documents
), s as (
  select source, cast(sum(size) as bigint) as source_size,
    cast([5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as double) as weight
  from d group by source
), o as (
  select *, 2.0::double * source_size as cap, sum(source_size) over () * 1.5::double as total,
    row_number() over (order by 2.0::double * source_size / weight, source nulls last) as k from s
), l as (
  select *, (total - (coalesce(sum(cap) over (order by k rows between unbounded preceding and 1 preceding), 0)))
    / sum(weight) over (order by k rows between current row and unbounded following) as level from o
), f as (
  select level from l where level * weight <= cap order by k limit 1
), t as (
  select l.source, l.source_size,
    case when f.level is null or f.level * weight > cap then cap else f.level * weight end as target
  from l left join f on true
), w as (
  select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as whole from t
), p as (
  select d.*, w.source_size, w.target, w.whole, w.target - w.whole * w.source_size as part,
    sum(size) over (partition by d.source order by draw, doc_id, size rows unbounded preceding) as upto
  from d join w on d.source is not distinct from w.source
), r as (
  select *, whole + case when part > 0 and upto - size / 2.0::double <= part then 1 else 0 end as repeats from p
)
select doc_id, size, source_size, target, cast(size * repeats as bigint) as taken, source,
  cast(repeats as bigint) as repeats from r
""",
    "op7_sharding": f"""
with recursive shards as (
  select range as s, 'shard-' || lpad(cast(range as varchar), 2, '0') as shard from range(16)
), pref as (
  select s, shard, cast('0x' || substr(md5('shard|' || shard || '|offset'), 1, 13) as bigint) % 1601 as start,
    cast('0x' || substr(md5('shard|' || shard || '|skip'), 1, 13) as bigint) % 1600 + 1 as skip from shards
), orders as (
  select s, [(start + k * skip) % 1601 for k in range(1601)] as slots from pref
), fill as (
  select 0 as step, cast(-1 as bigint) as slot, cast(repeat('0', 1601) as bit) as taken
  union all
  select step + 1, n.slot, set_bit(n.taken, cast(n.slot as int), 1) from (
    select step, taken, [x for x in slots if get_bit(taken, cast(x as int)) = 0][1] as slot
    from fill join orders on orders.s = fill.step % 16 where step < 1601
  ) n
)
select d.doc_id, d.slot, shards.shard
from (select doc_id, {_draw("shard", "doc_id")} % 1601 as slot from documents) d
join fill on fill.slot = d.slot join shards on shards.s = (fill.step - 1) % 16
""",
    "op8_line_dedup": r"""
with l as (
  select doc_id, source, i, line, trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as bare from (
    select doc_id, source, unnest(range(len(string_split(text, chr(10))))) as i, unnest(string_split(text, chr(10))) as line
    from documents)
), shared as (
  select bare from l where bare <> '' group by bare having count(distinct source) >= 8
), d as (
  select doc_id, count(*) as n_lines, count(s.bare) as n_removed,
    coalesce(string_agg(line, chr(10) order by i) filter (s.bare is null), '') as clean_text
  from l left join shared s using (bare) group by doc_id
)
select doc_id, coalesce(d.n_lines, 0) as n_lines, coalesce(d.n_removed, 0) as n_removed, clean_text
from documents left join d using (doc_id)
""",
    "op10_topk": """
with v as (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as e
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
), p as (
  select q.r, q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.e, c.e) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 100 = 0
)
select query_id, cast(rank as int) as rank, vec_id, score from (
  select *, row_number() over (partition by r order by score desc, vec_id) as rank from p
) where rank <= 10
""",
    "op11_lexical_search": f"""
with d as (
  select row_number() over () as r, doc_id, {_terms(_SEARCHED)} as t from documents
), s as (
  select count(*) as docs, cast(sum(len(t)) as bigint) as total from d where len(t) > 0
), tf as (
  select r, term, count(*) as tf from (select r, unnest(t) as term from d) group by all
), df as (
  select term, count(*) as df from tf group by term
), q as (
  select row_number() over () as i, item_id, text from (select distinct item_id, text from benchmark where item_id is not null)
), it as (
  select distinct i, item_id, unnest({_terms(_SEARCHED)}) as term from q
), w as (
  select i, item_id, term, cast(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) as bigint) as w from it join df using (term), s
), p as (
  select i, item_id, d.r, d.doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf
    + 20 * (100 - 50 + (50 * len(t) * docs) // total)))) as bigint) as score
  from w join tf using (term) join d using (r), s group by i, item_id, d.r, d.doc_id
)
select item_id, cast(rank as int) as rank, doc_id, score from (
  select *, row_number() over (partition by i order by score desc, doc_id nulls last) as rank from p where score > 0
) where rank <= 50
""",
    "op12_source_divergence": f"""
with d as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source, {_terms(_AUDITED)} as t
  from documents
), w as (
  select r, lang, source, unnest(t) as term from d
), kept as (
  select lang, term from w group by lang, term having count(distinct r) >= 3
), v as (
  select lang, count(*) as v from kept group by lang
), g as (
  select distinct lang, source from d
), c as (
  select lang, source, term, count(*) as n from w semi join kept using (lang, term) group by all
), dense as (
  select lang, g.source, term, coalesce(n, 0) as n
  from g join kept using (lang) left join c using (lang, source, term)
), own as (
  select lang, source, term, n, 1 + (1000000000::hugeint * (n + 1)) // (sum(n) over (partition by lang, source) + v) as p
  from dense join v using (lang)
), whole as (
  select lang, term, 1 + (1000000000::hugeint * (n + 1)) // (sum(n) over (partition by lang) + v) as p
  from (select lang, term, sum(n) as n from dense group by all) join v using (lang)
), pairs as (
  select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) as value
  from own a join own b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
), value as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0) as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
  left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source
  union all
  select lang, source, 'term', term, ((own.p - whole.p) * (own.p - whole.p)) // whole.p
  from own join whole using (lang, term) where n > 0 and own.p > whole.p
)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as int) as rank from (
  select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from value
) where part = 'pair' or rank <= 200
""",
}
