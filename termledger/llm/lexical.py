"""Ranked lexical search for many queries that share their terms.

Terms that the same items hold form one shared set: a document's partial score
of the set is made once for all of those items. Sets that stand side by side in
two items or more become a larger one, and so on, which makes a directed graph of
partial accumulators; an item's score is the sum of the few nodes that are left
of it. Tasks evaluate the graph for a block of documents at a time and keep the
best documents of each item.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termledger.llm.topk import _NONE, Best
from termledger.session import StepFolder

#: Documents that are returned for an item.
TOP = 50
#: Terms of the items that are searched for in one plan; more make more plans.
PLAN_TERMS = 50_000
#: Accumulators that a task holds at once, 8 bytes each.
CELLS = 2_000_000
#: Weights and scores are whole numbers; these are their fixed parts.
WEIGHT, UNIT, TF, LENGTH = 1000, 1_000_000_000, 1000, 20

_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_INTS = pa.list_(pa.int32())


def terms(text: str | None) -> list[bytes]:
    """Runs of letters, digits and signs beyond ASCII, A-Z lower-cased, in UTF-8."""
    return _TERM.findall((text or "").encode("utf-8", "surrogatepass").translate(_LOWER))


# -- the shared sets and their graph -------------------------------------------


def shared_sets(owned: DataFrame) -> DataFrame:
    """(items, terms): the terms that exactly these items hold, from rows (item,
    term). The sets are disjoint, and each item is a union of them."""
    holders = owned.groupBy("term").agg(F.sort_array(F.collect_set("item")).alias("items"))
    return holders.groupBy("items").agg(F.sort_array(F.collect_list("term")).alias("terms"))


@dataclass
class Graph:
    """Nodes are the sets, then the unions by level; a level names the two nodes
    that each of its nodes adds. ``parts`` are the nodes left of each item."""

    sets: int
    levels: list[tuple[np.ndarray, np.ndarray]]
    parts: list[list[int]]

    @property
    def nodes(self) -> int:
        return self.sets + sum(len(a) for a, _ in self.levels)


def share(sequences: list[list[int]], sets: int) -> Graph:
    """Join neighbours that stand side by side in two sequences or more into a
    node of their own, round by round, until no such pair is left. A round reads
    each sequence once and prefers the more frequent pair of two that overlap."""
    levels, nodes = [], sets
    while True:
        often = Counter(pair for s in sequences for pair in set(zip(s, s[1:])))
        often = {pair: n for pair, n in often.items() if n > 1}
        made: dict[tuple[int, int], int] = {}
        joined = []
        for s in sequences:
            out, k = [], 0
            while k < len(s):
                pair = tuple(s[k : k + 2])
                if often.get(pair, 0) and often[pair] >= often.get(tuple(s[k + 1 : k + 3]), 0):
                    out.append(made.setdefault(pair, nodes + len(made)))
                    k += 2
                else:
                    out.append(s[k])
                    k += 1
            joined.append(out)
        if not made:
            return Graph(sets, levels, sequences)
        levels.append((np.array([a for a, _ in made], np.int64), np.array([b for _, b in made], np.int64)))
        nodes, sequences = nodes + len(made), joined


@dataclass
class Plan:
    """What a task needs: the terms' places, set by set, their weights, the graph,
    and the items in the order of ``graph.parts``."""

    places: dict[bytes, int]
    starts: np.ndarray
    graph: Graph
    items: np.ndarray
    weights: np.ndarray | None = None


def plan(sets: list[tuple[list[int], list[str]]]) -> Plan:
    """The plan of some items from their shared sets. In an item's sequence the
    sets that more items hold come first, so that items which share sets share
    neighbours."""
    sets = sorted(sets, key=lambda s: (-len(s[0]), s[0]))
    flat = [t.encode("utf-8", "surrogatepass") for _, own in sets for t in own]
    sizes = np.array([len(own) for _, own in sets], np.int64)
    sequences: dict[int, list[int]] = {}
    for k, (holders, _) in enumerate(sets):
        for item in holders:
            sequences.setdefault(item, []).append(k)
    items = sorted(sequences)
    graph = share([sequences[item] for item in items], len(sets))
    return Plan({t: k for k, t in enumerate(flat)}, np.cumsum(sizes) - sizes, graph, np.array(items, np.int64))


def accumulate(graph: Graph, starts: np.ndarray, single: np.ndarray) -> np.ndarray:
    """Items x documents, from terms x documents: each node is added up once."""
    nodes = np.empty((graph.nodes, single.shape[1]), np.int64)
    np.add.reduceat(single, starts, axis=0, out=nodes[: graph.sets])
    done = graph.sets
    for left, right in graph.levels:
        np.add(nodes[left], nodes[right], out=nodes[done : done + len(left)])
        done += len(left)
    out = np.empty((len(graph.parts), single.shape[1]), np.int64)
    for k, own in enumerate(graph.parts):
        np.add.reduce(nodes[own], axis=0, out=out[k])
    return out


# -- postings and scores --------------------------------------------------------


def postings(docs: DataFrame, places: dict[bytes, int]) -> DataFrame:
    """(doc, n, at, tf) per row (doc, text): its number of terms, and the places
    and occurrences of those that are asked for."""
    shared = docs.sparkSession.sparkContext.broadcast(places)

    def run(batches):
        wanted = shared.value
        for batch in batches:
            sizes, ats, tfs = [], [], []
            for text in batch.column(1):
                seen = Counter(terms(text.as_py()))
                own = [(wanted[t], n) for t, n in seen.items() if t in wanted]
                sizes.append(seen.total())
                ats.append([a for a, _ in own])
                tfs.append([n for _, n in own])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(ats, _INTS), pa.array(tfs, _INTS)],
                names=["doc", "n", "at", "tf"],
            )

    return docs.mapInArrow(run, "doc bigint, n bigint, at array<int>, tf array<int>")


def document_frequencies(rows: DataFrame, n_terms: int) -> np.ndarray:
    """Documents of each place, summed in the tasks first."""

    def run(batches):
        held = np.zeros(n_terms, np.int64)
        for batch in batches:
            held += np.bincount(pc.list_flatten(batch.column(0)).to_numpy(), minlength=n_terms)
        at = np.nonzero(held)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(held[at])], names=["at", "df"])

    summed = rows.select("at").mapInArrow(run, "at int, df bigint").groupBy("at").agg(F.sum("df").alias("df"))
    out = np.zeros(n_terms, np.int64)
    for row in summed.collect():
        out[row["at"]] = row["df"]
    return out


def _search(rows: DataFrame, asked: Plan, n_docs: int, length: int, top: int) -> DataFrame:
    """(item, doc, score): the ``top`` documents of each item in each task."""
    shared = rows.sparkSession.sparkContext.broadcast(asked)

    def run(batches):
        asked = shared.value
        graph, n_terms, none = asked.graph, len(asked.places), np.iinfo(np.int64).max
        block = max(8, CELLS // (n_terms + graph.nodes + len(asked.items)))
        best = Best(len(asked.items), top, np.full(len(asked.items), 1, np.int64))

        def score(batch):
            docs = pc.fill_null(batch.column(0), none).to_numpy()
            order = np.argsort(docs, kind="stable")
            batch, docs = batch.take(pa.array(order)), docs[order]
            size = batch.column(1).to_numpy()
            m = 100 - 50 + (50 * size * n_docs) // length
            ats, tfs = (pc.list_flatten(batch.column(k)).to_numpy().astype(np.int64) for k in (2, 3))
            column = np.repeat(np.arange(len(batch)), pc.list_value_length(batch.column(2)).to_numpy())
            single = np.zeros((n_terms, len(batch)), np.int64)
            single[ats, column] = asked.weights[ats] * ((UNIT * tfs) // (TF * tfs + LENGTH * m[column]))
            scores = accumulate(graph, asked.starts, single)
            scores[scores <= 0] = _NONE
            which = np.nonzero((scores >= best.threshold(np.arange(len(scores)))[:, None]).any(axis=1))[0]
            if len(which):
                best.offer(which, scores[which], docs)

        for batch in batches:
            batch = batch.filter(pc.greater(pc.list_value_length(batch.column(2)), 0))
            for start in range(0, len(batch), block):
                score(batch.slice(start, block))
        at, place = np.nonzero(best.scores != _NONE)
        docs = best.ids[at, place]
        yield pa.RecordBatch.from_arrays(
            [pa.array(asked.items[at]), pa.array(docs, mask=docs == none), pa.array(best.scores[at, place])],
            names=["item", "doc", "score"],
        )

    return rows.mapInArrow(run, "item bigint, doc bigint, score bigint")


def search(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    plan_terms: int = PLAN_TERMS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(item id, rank, doc id, score): the ``top`` documents of each item with a
    score above 0, the highest first, equal scores by id, null ids last.

    A term's weight falls with the documents that hold it, its share of a score
    rises with its occurrences and falls with the document's length; all is
    arithmetic of whole numbers but the weight's logarithm. Items with a null id
    are left out, rows that repeat an item's id and text count once; an id with
    several texts has a ranking for each. Null texts have no terms; items and
    documents without terms, and empty tables, give no rows. Repeated documents
    are ranked one by one. Document ids are whole numbers below 2 ** 63 - 1.
    Other columns are left out, whatever their names.

    The items are dealt to plans of a bounded number of terms, which are
    broadcast. Texts are read once a plan; what is kept of them are the
    occurrences of the plan's terms. All plans are searched in one job; a task
    passes on ``top`` documents an item at most.
    """
    spark = docs.sparkSession
    folder = StepFolder(spark, "lexical", keep=True)
    source = items.select(F.col(item_id_col).alias("id"), F.col(item_text_col).cast("string").alias("text"))
    source = source.where("id is not null").distinct().withColumn("item", F.monotonically_increasing_id())
    kind = source.schema["id"].dataType.simpleString()

    def split(batches):
        for batch in batches:
            found = [sorted({t.decode("utf-8", "surrogatepass") for t in terms(x.as_py())}) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(found, pa.list_(pa.string()))], names=["id", "item", "terms"]
            )

    asked = folder.write(source.mapInArrow(split, f"id {kind}, item bigint, terms array<string>").where("size(terms) > 0"))
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    plans = -(-total // plan_terms)
    owned = asked.select(F.pmod(F.xxhash64("item"), F.lit(max(1, plans))).alias("plan"), "item", F.explode("terms").alias("term"))
    owned = folder.write(owned)
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))

    found = None
    for number in range(plans):
        sets = [(r["items"], r["terms"]) for r in shared_sets(owned.where(F.col("plan") == number)).collect()]
        if not sets:
            continue
        own = plan(sets)
        rows = folder.write(postings(texts, own.places))
        n_docs, length = rows.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs:
            break
        often = document_frequencies(rows, len(own.places))
        own.weights = np.array(
            [math.floor(WEIGHT * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in often.tolist()], np.int64
        )
        best = _search(rows, own, n_docs, length, top)
        found = best if found is None else found.unionAll(best)
    if found is None:
        found = spark.createDataFrame([], "item bigint, doc bigint, score bigint")
    first = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    ranked = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)
    return ranked.join(asked.select("item", F.col("id").alias("_id")), "item").select(
        F.col("_id").alias(item_id_col), "rank", F.col("doc").alias(id_col), "score"
    )
