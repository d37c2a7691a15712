"""Exact top-k inner products by norm-bucketed retrieval."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termledger.session import StepFolder

#: Queries that go through the candidates in one pass; bounds what is broadcast.
QUERY_BLOCK = 4096
#: Candidates of a bucket: neighbours in the order of length.
BUCKET = 4096
#: The longest vectors, against which the first thresholds are set.
SEEDS = 2048
#: Local cosine threshold from which a query is pruned by a coordinate.
BY_COORDINATE = 0.9
_NONE = np.iinfo(np.int64).min
#: Whole numbers that a double holds exactly.
_EXACT = float(2**53)


def scaled(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, dim, norm, vec) with whole components floor(scale * x); rows without
    an id, and vectors that are null or hold null or non-finite components, are
    left out."""
    source = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")
    ).where("id is not null and v is not null and not exists(v, x -> x is null or isnan(x) or abs(x) = double('inf'))")

    def run(batches):
        for batch in batches:
            rows = [np.floor(scale * np.asarray(x.as_py(), np.float64)) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(r) for r in rows], pa.int32()),
                    pa.array([float(np.sqrt(r @ r)) for r in rows], pa.float64()),
                    pa.array([r.tobytes() for r in rows], pa.binary()),
                ],
                names=["id", "dim", "norm", "vec"],
            )

    return source.mapInArrow(run, "id bigint, dim int, norm double, vec binary")


def _matrix(vecs, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(vecs), np.float64).reshape(len(vecs), dim)


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products as int64 (raises if one doesn't fit)."""
    top = (np.abs(q).max(initial=0.0)) * (np.abs(c).max(initial=0.0)) * max(1, c.shape[1])
    if top < _EXACT:
        return (q @ c.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in row] for row in m], object).reshape(m.shape)
    return (whole(q) @ whole(c).T).astype(np.int64)


class Best:
    """The k best (score, id) of each query so far."""

    def __init__(self, queries: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor
        self.scores = np.full((queries, k), _NONE, np.int64)
        self.ids = np.full((queries, k), np.iinfo(np.int64).max, np.int64)

    def threshold(self, which: np.ndarray) -> np.ndarray:
        return np.maximum(self.floor[which], self.scores[which, -1])

    def offer(self, which: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores``: queries x candidates, _NONE where there is none; ``ids``
        ascending, so that a stable order settles ties."""
        if scores.shape[1] > self.k:
            # places of the k best: those above the k-th score, then the first ties
            cut = ~np.partition(~scores, self.k - 1, axis=1)[:, self.k - 1 : self.k]
            above, tie = scores > cut, scores == cut
            room = self.k - above.sum(axis=1, keepdims=True)
            take = above | (tie & (np.cumsum(tie, axis=1) <= room))
            at = np.nonzero(take)[1].reshape(len(which), self.k)
            scores, ids = np.take_along_axis(scores, at, 1), ids[at]
        else:
            ids = np.broadcast_to(ids, scores.shape)
        scores = np.concatenate([self.scores[which], scores], axis=1)
        ids = np.concatenate([self.ids[which], np.where(scores[:, self.k :] == _NONE, np.iinfo(np.int64).max, ids)], axis=1)
        order = np.lexsort((ids, ~scores), axis=1)[:, : self.k]
        self.scores[which] = np.take_along_axis(scores, order, 1)
        self.ids[which] = np.take_along_axis(ids, order, 1)


def search_bucket(best: Best, q, q_ids, q_norms, c, c_ids, c_norms) -> None:
    """Offer one bucket's candidates, pruned by length or by a coordinate.

    A score of theta or more needs a cosine of theta / (|q| * longest) or more.
    Above 1 the bucket is skipped; near 1 the query's largest coordinate bounds
    the candidates' same coordinate; below, candidates too short for theta go.
    """
    order = np.argsort(c_ids, kind="stable")
    c, c_ids, c_norms = c[order], c_ids[order], c_norms[order]
    everyone = np.arange(len(q))
    theta = best.threshold(everyone).astype(np.float64)
    reach = q_norms * c_norms.max()
    active = theta <= reach * (1 + 1e-9)
    with np.errstate(divide="ignore", invalid="ignore"):
        local = np.where(reach > 0, theta / reach, -1.0)
    narrow = active & (local >= BY_COORDINATE)
    for k in np.nonzero(narrow)[0]:
        unit = q[k] / q_norms[k]
        f = int(np.argmax(np.abs(unit)))
        t = min(1.0, local[k]) * (1 - 1e-9)
        slack = np.sqrt(max(0.0, (1 - t * t) * (1 - unit[f] ** 2))) + 1e-9
        along = c[:, f] / np.maximum(c_norms, 1e-300)
        # a cosine of t or more keeps the coordinate near its multiple of the query's
        low = min(t * unit[f], unit[f]) - slack
        high = max(t * unit[f], unit[f]) + slack
        if abs(unit[f]) > t:  # the whole cap around the query reaches the axis
            low, high = (low, 1.0) if unit[f] > 0 else (-1.0, high)
        rows = np.nonzero((along >= low - 1e-9) & (along <= high + 1e-9) & (c_ids != q_ids[k]))[0]
        if len(rows):
            best.offer(np.array([k]), _products(q[k : k + 1], c[rows]), c_ids[rows])
    wide = np.nonzero(active & ~narrow)[0]
    for start in range(0, len(wide), 512):
        part = wide[start : start + 512]
        with np.errstate(divide="ignore", invalid="ignore"):
            needed = np.min(np.where(q_norms[part] > 0, theta[part] / q_norms[part], -np.inf))
        rows = np.nonzero(c_norms >= needed * (1 - 1e-9) if needed > 0 else c_norms >= 0)[0]
        if not len(rows):
            continue
        scores = _products(q[part], c[rows])
        scores[q_ids[part][:, None] == c_ids[rows][None, :]] = _NONE
        best.offer(part, scores, c_ids[rows])


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    scale: int = 1024,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, rank, id, score) of the k largest inner products per query.

    Queries are the rows that ``is_query``, a condition on the column ``id``,
    picks; candidates are all rows but the query's own id. Products are of whole
    components floor(scale * x) and exact; a tie goes to the smaller id. Rows
    without an id and vectors that are null or hold null or non-finite components
    take no part. Vectors meet those of their own dimension. Every row is a
    candidate of its own, and a query of its own if it is picked, also one that
    repeats an id or an id and its vector; queries of one id are told apart by
    ``query_no``. Zero vectors score 0.

    The candidates are dealt by length, equal lengths by id and equal rows by a
    draw, so that no task gets all copies of a row. Queries go through
    them in blocks of bounded size, one pass a block; each task keeps the k best
    of each query of the block and prunes by them, starting from thresholds that
    the longest vectors set.
    """
    spark = vectors.sparkSession
    folder = StepFolder(spark, "topk", keep=True)
    rows = folder.write(scaled(vectors, id_col, vector_col, scale).withColumn("draw", F.rand(7)))
    order = ["dim", F.desc("norm"), "id", "draw"]
    rows = folder.write(rows.repartitionByRange(*order).sortWithinPartitions(*order))
    asked = rows.where(is_query)
    blocks = -(-asked.count() // query_block)
    asked = folder.write(asked.withColumn("block", F.pmod(F.xxhash64("id", "vec", "draw"), F.lit(max(1, blocks)))))
    seeds = rows.orderBy(F.desc("norm"), "id").limit(SEEDS).collect()
    results = None
    for block in range(blocks):
        queries = asked.where(F.col("block") == block).orderBy("id", "vec").collect()
        if not queries:
            continue
        found = _pass(rows, queries, seeds, k, block)
        first = Window.partitionBy("query_no").orderBy(F.desc("score"), "id")
        found = folder.write(found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k))
        results = found if results is None else results.unionAll(found)
    if results is None:
        results = spark.createDataFrame([], "query_no string, query_id bigint, id bigint, score bigint, rank int")
    return results.select("query_no", "query_id", "rank", F.col("id").alias(id_col), "score")


def _pass(rows: DataFrame, queries: list, seeds: list, k: int, block: int) -> DataFrame:
    by_dim: dict[int, list] = {}
    for row in queries:
        by_dim.setdefault(row["dim"], []).append(row)
    plan = {}
    for dim, own in by_dim.items():
        q, ids = _matrix([r["vec"] for r in own], dim), np.array([r["id"] for r in own], np.int64)
        floor = np.full(len(own), _NONE, np.int64)
        near = [s for s in seeds if s["dim"] == dim]
        if near:
            c, c_ids = _matrix([s["vec"] for s in near], dim), np.array([s["id"] for s in near], np.int64)
            for start in range(0, len(own), 512):
                part = slice(start, start + 512)
                scores = _products(q[part], c)
                scores[ids[part][:, None] == c_ids[None, :]] = _NONE
                if scores.shape[1] >= k:
                    floor[part] = ~np.partition(~scores, k - 1, axis=1)[:, k - 1]
        plan[dim] = (q, ids, np.array([r["norm"] for r in own]), floor)
    shared = rows.sparkSession.sparkContext.broadcast(plan)

    def run(batches):
        plan = shared.value
        best = {dim: Best(len(p[0]), k, p[3]) for dim, p in plan.items()}
        for batch in batches:
            ids, dims, norms = (batch.column(n).to_numpy(zero_copy_only=False) for n in (0, 1, 2))
            for dim in np.unique(dims):
                if int(dim) not in plan:
                    continue
                at = np.nonzero(dims == dim)[0]
                q, q_ids, q_norms, _ = plan[int(dim)]
                for start in range(0, len(at), BUCKET):
                    part = at[start : start + BUCKET]
                    c = _matrix([batch.column(3)[int(i)].as_py() for i in part], int(dim))
                    search_bucket(best[int(dim)], q, q_ids, q_norms, c, ids[part], norms[part])
        for dim, b in best.items():
            at, place = np.nonzero((b.scores != _NONE) & (b.scores >= b.floor[:, None]))
            names = [f"{block}:{dim}:{i}" for i in at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(plan[dim][1][at]), pa.array(b.ids[at, place]), pa.array(b.scores[at, place])],
                names=["query_no", "query_id", "id", "score"],
            )

    return rows.select("id", "dim", "norm", "vec").mapInArrow(run, "query_no string, query_id bigint, id bigint, score bigint")
