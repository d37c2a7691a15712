"""URL filters: stated host and path rules, and mined rules for the rest."""

from __future__ import annotations

import math
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termledger.session import StepFolder

MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.9
#: Rules that are kept, and held by every task, at most.
MAX_RULES = 100_000
#: Marks the label among a basket's items; no token begins so.
VERDICT = "verdict="
_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_TAIL = re.compile(r"\?([^#]*)")


class Rule(NamedTuple):
    """``allow`` or ``block`` for a host with all its subdomains, below a path."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


class Mined(NamedTuple):
    """All tokens present: the verdict, with its confidence and support."""

    tokens: tuple[str, ...]
    verdict: str
    confidence: float
    support: float


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path; both empty for a null or a text without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return host.translate(_UPPER), path


def tokens(url: str | None) -> list[str]:
    """What the miner sees of a url, each thing once: the scheme, every label of
    the host, every segment of the path, with its digits as 0, every key of the
    query, and the number of segments."""
    host, path = split_url(url)
    if not host:
        return []
    steps = [re.sub(r"\d+", "0", s) for s in path.split("/") if s]
    query = _TAIL.search(url or "")
    keys = [p.partition("=")[0] for p in query.group(1).split("&")] if query else []
    found = [("scheme", url.partition("://")[0].translate(_UPPER)), ("depth", str(len(steps)))]
    found += [("label", x) for x in host.split(".")] + [("step", x) for x in steps] + [("key", x) for x in keys]
    return list(dict.fromkeys(f"{k}={v}" for k, v in found if v))


def stated(rules: list[Rule]):
    """A function from (host, path) to the longest fitting rule, or None."""
    below: dict[str, list[Rule]] = {}
    for rule in sorted(set(rules), key=lambda r: (-len(r.text), r)):
        below.setdefault(rule.host, []).append(rule)

    def find(host: str, path: str) -> Rule | None:
        labels, best = host.split("."), None
        for k in range(len(labels)):
            for rule in below.get(".".join(labels[k:]), ()):
                if path.startswith(rule.path):
                    if best is None or len(rule.text) > len(best.text):
                        best = rule
                    break
        return best

    return find


def _support_pruned(baskets: DataFrame, least: int) -> set[str]:
    """The tokens that lead to a label often enough, one of those that always
    stand together. There are fewer than a row's tokens over the support."""
    rows = baskets.select("label", F.xxhash64("tokens", "label").cast("decimal(38,0)").alias("row"), F.explode("tokens").alias("t"))
    by_label = rows.groupBy("t", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("row").alias("rows"))
    often = by_label.groupBy("t").agg(F.max("n").alias("most"), F.sum("n").alias("n"), F.sum("rows").alias("rows"))
    same = often.where(F.col("most") >= least).groupBy("n", "rows").agg(F.min("t").alias("t"))
    return {r["t"] for r in same.select("t").collect()}


def mine(
    labelled: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    max_rules: int = MAX_RULES,
) -> list[Mined]:
    """Association rules from (tokens, label), every row of it, by Spark's
    FP-growth.

    Tokens that don't have the support with a label go first, which loses no
    rule, and of tokens that always stand together one stays, so that the
    itemsets don't multiply. FP-growth over the rest, the label among the items,
    gives the rules from a combination of tokens, of any size, to a label. Rules
    without the support or confidence go, and so do those of which a smaller part
    leads to the label at least as surely. If there are more than ``max_rules``
    of them, the surest are kept, then those with more support.

    FP-growth's itemsets of one url may be as many as the subsets of its frequent
    tokens; below the support, tokens cost nothing.
    """
    folder = StepFolder(labelled.sparkSession, "url-rules", keep=True)
    baskets = labelled.where("label is not null and size(tokens) > 0")
    baskets = folder.write(baskets.select(F.array_sort(F.array_distinct("tokens")).alias("tokens"), "label"))
    rows = baskets.count()
    if not rows:
        return []
    least = max(1, math.ceil(rows * min_support - 1e-9))
    frequent = _support_pruned(baskets, least)

    def run(batches):
        for batch in batches:
            left = [
                [*sorted(frequent.intersection(own.as_py())), VERDICT + label.as_py()]
                for own, label in zip(batch.column(0), batch.column(1))
            ]
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.list_(pa.string()))], names=["items"])

    items = folder.write(baskets.mapInArrow(run, "items array<string>"))
    model = FPGrowth(minSupport=(least - 0.5) / rows, minConfidence=min_confidence).fit(items)
    rules = model.associationRules.select(
        F.array_sort("antecedent").alias("tokens"), F.col("consequent")[0].alias("verdict"), "confidence", "support"
    ).where(F.col("verdict").startswith(VERDICT) & ~F.exists("tokens", lambda t: t.startswith(VERDICT)))
    best = rules.orderBy(F.desc("confidence"), F.desc("support"), F.size("tokens"), "tokens", "verdict").limit(max_rules)
    found = [
        Mined(tuple(r["tokens"]), r["verdict"].removeprefix(VERDICT), r["confidence"], r["support"]) for r in best.collect()
    ]
    return without_redundant(found)


def without_redundant(found: list[Mined]) -> list[Mined]:
    """The rules of which no smaller part leads to the verdict at least as surely."""
    kept: dict[tuple[str, str], list[Mined]] = {}
    out = []
    for rule in sorted(found, key=lambda r: (len(r.tokens), r.tokens, r.verdict)):
        have = set(rule.tokens)
        shorter = (r for t in rule.tokens for r in kept.get((rule.verdict, t), ()))
        if not any(r.confidence >= rule.confidence and have.issuperset(r.tokens) for r in shorter):
            kept.setdefault((rule.verdict, rule.tokens[0]), []).append(rule)
            out.append(rule)
    return out


def matcher(mined: list[Mined]):
    """A function from a url's tokens to the best mined rule, or None. Rules hang
    on their rarest token, so a url meets few of them."""
    often: dict[str, int] = {}
    for rule in mined:
        for t in rule.tokens:
            often[t] = often.get(t, 0) + 1
    index: dict[str, list[Mined]] = {}
    for rule in mined:
        index.setdefault(min(rule.tokens, key=lambda t: (often[t], t)), []).append(rule)

    def find(present: list[str]) -> Mined | None:
        have = set(present)
        fits = (r for t in present for r in index.get(t, ()) if have.issuperset(r.tokens))
        return max(fits, key=lambda r: (r.confidence, r.support, r.verdict, r.tokens), default=None)

    return find


def _parse(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """(tokens, label) of the urls that a stated rule decides."""

    def run(batches):
        find = stated(rules)
        for batch in batches:
            urls = [u.as_py() for u in batch.column(0)]
            fits = [find(*split_url(u)) for u in urls]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([tokens(u) for u in urls], pa.list_(pa.string())),
                    pa.array([f and f.verdict for f in fits], pa.string()),
                ],
                names=["tokens", "label"],
            )

    return pages.mapInArrow(run, "tokens array<string>, label string")


def judge(
    pages: DataFrame,
    rules: list[Rule],
    labelled: DataFrame | None = None,
    default: str = "allow",
    id_col: str = "page_id",
    url_col: str = "url",
    **mining,
) -> DataFrame:
    """Per row of ``pages``: id, url, host, path, rule, mined, confidence, verdict.

    The longest stated rule that fits decides. Other urls go by the mined rule of
    the highest confidence, then support; without one the verdict is the default.
    ``labelled`` is a table (url, label); if absent, the urls that the stated
    rules decide are the labels. Null urls and texts without ``://`` have no
    tokens. The stated rules are a parameter and are held by each task. Repeated
    rows are judged alike; other columns are left out.
    """
    urls = pages.select(F.col(url_col).cast("string").alias("url"))
    if labelled is None:
        known = _parse(urls, rules)
    else:
        known = labelled.select("url", "label").mapInArrow(_tokenize, "tokens array<string>, label string")
    mined = mine(known, **mining)
    source = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches):
        find, match = stated(rules), matcher(mined)
        for batch in batches:
            out = []
            for u in batch.column(1):
                url = u.as_py()
                host, path = split_url(url)
                rule = find(host, path)
                best = None if rule else match(tokens(url))
                out.append((
                    url, host, path, rule and rule.text, best and " & ".join(best.tokens), best and best.confidence,
                    rule.verdict if rule else best.verdict if best else default,
                ))
            columns = list(zip(*out)) or [()] * 7
            kinds = [pa.string()] * 5 + [pa.float64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds))],
                names=["id", "url", "host", "path", "rule", "mined", "confidence", "verdict"],
            )

    schema = f"id {kind}, url string, host string, path string, rule string, mined string, confidence double, verdict string"
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def _tokenize(batches):
    for batch in batches:
        found = [tokens(u.as_py()) for u in batch.column(0)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.list_(pa.string())), batch.column(1).cast(pa.string())], names=["tokens", "label"]
        )
