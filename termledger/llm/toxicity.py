"""Toxicity: gradient-boosted trees over dense features, calibrated.

The lexicon is mined from labels: words and word beginnings that stand in toxic
documents far more often than in others. Trees see densities of its entries,
their distance from second-person words, capitals, punctuation and obfuscation.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termledger.session import StepFolder

#: Labelled rows that the model is fitted on at most, drawn by a hash of the id.
SAMPLE = 20_000
#: Parts of the sample. Each row's training features come from a lexicon of the
#: other parts; the last part calibrates.
FOLDS = 4
#: Beginnings of words that may enter the lexicon, in letters.
STEMS = (4, 5, 6)
#: A lexicon entry: documents, log-likelihood ratio, and entries at most.
MIN_DOCS, MIN_RATIO, MAX_ENTRIES = 3, 15.0, 2000
#: Words between a hit and a second-person word that still count as near.
NEAR = 5
#: Rows added to the calibration whose label is the trees' own probability.
PRIOR_ROWS = 39
#: Weight of the trees' own probability in the score: it orders documents that
#: the calibration puts on one step.
WITHIN_STEP = 1e-3
#: Word counts that one task holds before it passes them on, and weights of words that it keeps.
HELD = 20_000
#: Letters of the longest word whose weight is kept: bounds the bytes of what is held.
KEPT_LETTERS = 64

# Second-person words of the corpus languages, and letters that signs stand for.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos ti tuyo "
    "vosotros usted ustedes su sus".split()
)
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"})

FEATURES = (
    "hit_density", "hits", "weight_density", "max_weight", "distinct_hits", "near_second_person",
    "second_person_density", "capitals", "shouted_words", "exclamations", "punctuation", "obfuscated_hits",
    "obfuscated_words", "words",
)

_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_INNER = re.compile(r"[\W\d_]+")


def grams(word: str) -> list[str]:
    """What a word may be known by: itself, or a beginning marked with ``*``."""
    return [word, *(f"{word[:n]}*" for n in STEMS if len(word) > n)]


def read_word(token: str) -> tuple[str, str]:
    """The token lower-cased without outer signs, and, if signs or digits stand
    inside or for letters, what it reads as without them; else empty."""
    token = token.lower()
    if token.isalpha():
        return token, ""
    bare = _EDGES.sub("", token)
    if not bare or bare.isalpha() and token.find(bare) == 0:
        return bare, ""
    return bare, _INNER.sub("", token.rstrip("!").translate(LEET))


def features(text: str | None, weights: dict[str, float], known: dict[str, float] | None = None) -> list[float]:
    """The features of a whole text, by name in ``FEATURES``. ``known`` keeps
    the weights of words seen before."""
    text = text or ""
    known = {} if known is None else known

    def weight(word: str) -> float:
        found = known.get(word)
        if found is None:
            found = max((weights[g] for g in grams(word) if g in weights), default=0.0)
            if len(word) <= KEPT_LETTERS:
                if len(known) >= HELD:
                    known.clear()
                known[word] = found
        return found

    hits: list[int] = []
    second: list[int] = []
    distinct, total, most, hidden, odd, shouted, n = set(), 0.0, 0.0, 0, 0, 0, 0
    for token in text.split():
        word, read = read_word(token)
        if not word and not read:
            continue
        w = weight(word) if word else 0.0
        if read:
            odd += 1
            if not w and (w := weight(read)):
                hidden, word = hidden + 1, read
        if w:
            hits.append(n)
            distinct.add(word)
            total, most = total + w, max(most, w)
        elif word in SECOND_PERSON:
            second.append(n)
        shouted += len(token) > 2 and token.isupper()
        n += 1
    near = 0
    if hits and second:
        at, where = np.array(hits), np.array(second)
        place = np.searchsorted(where, at)
        left = at - where[np.maximum(place - 1, 0)]
        right = where[np.minimum(place, len(where) - 1)] - at
        near = int(((np.abs(left) <= NEAR) | (np.abs(right) <= NEAR)).sum())
    chars, n1 = max(1, len(text)), max(1, n)
    capitals = sum(map(str.isupper, text))
    marks = sum(text.count(c) for c in ".,;:?!*%#&$@~^-_")
    return [
        len(hits) / n1, math.log1p(len(hits)), total / n1, most, math.log1p(len(distinct)), math.log1p(near),
        len(second) / n1, capitals / chars, shouted / n1, text.count("!") / chars, marks / chars,
        math.log1p(hidden), odd / n1, math.log1p(n),
    ]


@dataclass
class Model:
    """A fitted model; ``trees`` is None if the labels name one class or none,
    and the score is then ``constant``."""

    lexicon: dict[str, float]
    trees: GBTClassificationModel | None = None
    calibration: IsotonicRegressionModel | None = None
    constant: float = 0.0


def _count_grams(batches):
    """(gram, toxic documents, all documents) per fold, summed in the task."""

    def flush(counts):
        rows = [(g, fold, *n) for (g, fold), n in counts.items()]
        columns = zip(*rows) if rows else ([], [], [], [])
        kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["gram", "fold", "toxic", "docs"]
        )

    counts: dict = {}
    for batch in batches:
        for text, toxic, fold in zip(*(batch.column(k) for k in range(3))):
            toxic, fold = toxic.as_py(), fold.as_py()
            words = {w for token in set((text.as_py() or "").split()) for w in read_word(token) if 1 < len(w) < 40}
            for g in {g for w in words for g in grams(w)}:
                held = counts.setdefault((g, fold), [0, 0])
                held[0] += toxic
                held[1] += 1
            if len(counts) >= HELD:
                yield flush(counts)
                counts = {}
    yield flush(counts)


def _lexicons(rows: DataFrame, folder) -> list[dict[str, float]]:
    """Per fold the lexicon of the other folds, and last that of all: at most
    MAX_ENTRIES entries each, which bounds what reaches the driver."""
    counted = rows.select("text", "toxic", "fold").mapInArrow(
        _count_grams, "gram string, fold int, toxic bigint, docs bigint"
    )
    totals = {r["fold"]: (r["t"], r["n"]) for r in rows.groupBy("fold").agg(
        F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n")
    ).collect()}
    outside = lambda col, k: F.sum(F.when(F.col("fold") != k, F.col(col)).otherwise(0))
    summed = counted.groupBy("gram").agg(
        *[outside("toxic", k).alias(f"t{k}") for k in range(FOLDS + 1)],
        *[outside("docs", k).alias(f"n{k}") for k in range(FOLDS + 1)],
    ).where(F.col(f"t{FOLDS}") >= MIN_DOCS)
    summed = folder.write(summed)
    found = []
    for k in range(FOLDS + 1):
        t_all = sum(t for fold, (t, _) in totals.items() if fold != k)
        n_all = sum(n for fold, (_, n) in totals.items() if fold != k)
        if not 0 < t_all < n_all:
            found.append({})
            continue
        share = t_all / n_all
        t, n = F.col(f"t{k}"), F.col(f"n{k}")
        part = lambda x, of: F.when(x > 0, x * F.log(x / of)).otherwise(0.0)
        ratio = 2 * (part(t, n * share) + part(n - t, n * (1 - share)))
        odds = F.log((t + 0.5) / (t_all + 1) / ((n - t + 0.5) / (n_all - t_all + 1)))
        best = (
            summed.select("gram", t.alias("t"), (t / F.greatest(n, F.lit(1))).alias("p"), ratio.alias("ratio"), odds.alias("odds"))
            .where((F.col("t") >= MIN_DOCS) & (F.col("p") > 2 * share) & (F.col("ratio") >= MIN_RATIO))
            .orderBy(F.desc("ratio"), "gram")
            .limit(MAX_ENTRIES)
        )
        found.append({r["gram"]: r["odds"] for r in best.collect() if r["odds"] > 0})
    return found


def _featured(rows: DataFrame, lexicons: list[dict[str, float]], keep: str) -> DataFrame:
    """(keep, x) for rows (keep, text, fold): a row's features by its fold's
    lexicon. The weights kept are those of one lexicon at a time, and a batch is
    read fold by fold, so a task keeps ``HELD`` words at most."""

    def run(batches):
        known, of = {}, 0
        for batch in batches:
            folds = batch.column(2).to_numpy(zero_copy_only=False)
            xs = [None] * len(folds)
            for k in np.argsort(folds, kind="stable").tolist():
                if folds[k] != of:
                    known, of = {}, int(folds[k])
                xs[k] = features(batch.column(1)[k].as_py(), lexicons[of], known)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(xs, pa.list_(pa.float64()))], names=[keep, "x"])

    kind = rows.schema[keep].dataType.simpleString()
    return rows.select(keep, "text", "fold").mapInArrow(run, f"{keep} {kind}, x array<double>")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample: int = SAMPLE,
    seed: int = 7,
) -> Model:
    """Fit on at most ``sample`` labelled rows.

    A document with several labels is toxic if one says so; null labels and ids,
    and labels of documents that are not there, are left out. Equal texts count
    once. Only the drawn ids are broadcast, and only their texts are written.
    """
    folder = StepFolder(docs.sparkSession, "toxicity", keep=True)
    drawn = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"))
        .where("id is not null and toxic in (0, 1)")
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(sample)
    )
    drawn = folder.write(drawn)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(drawn), "id").withColumn("digest", F.xxhash64("text"))
    rows = folder.write(rows.repartition("digest"))
    once = rows.groupBy("digest").agg(F.max(F.struct("toxic", "id")).alias("m")).select(F.col("m.id").alias("id"), F.col("m.toxic").alias("toxic"))
    rows = folder.write(
        rows.drop("toxic").join(once, "id").dropDuplicates(["id"])
        .select("id", "text", "toxic", F.pmod("digest", F.lit(FOLDS)).cast("int").alias("fold"))
    )
    classes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if len(classes) < 2:
        return Model({}, constant=float(next(iter(classes), 0)))
    lexicons = _lexicons(rows, folder)
    train = folder.write(
        _featured(rows, lexicons, "id").join(rows.select("id", "toxic", "fold"), "id")
        .select("fold", F.col("toxic").cast("double").alias("label"), array_to_vector("x").alias("features"))
        .coalesce(8)
    )
    calibrating = train.where(F.col("fold") == FOLDS - 1)
    if calibrating.select("label").distinct().count() < 2 or train.where(F.col("fold") < FOLDS - 1).select("label").distinct().count() < 2:
        fitting = calibrating = train
    else:
        fitting = train.where(F.col("fold") < FOLDS - 1)
    trees = GBTClassifier(maxIter=20, maxDepth=4, stepSize=0.3, minInstancesPerNode=3, seed=seed).fit(fitting)
    margins = trees.transform(calibrating).select("label", vector_to_array("probability")[1].alias("margin"))
    # a few rows that trust the trees' probability, so that a small sample can't
    # make one labelled row the whole step
    grid = docs.sparkSession.range(1, PRIOR_ROWS + 1).select((F.col("id") / (PRIOR_ROWS + 1)).alias("label"))
    prior = grid.select("label", F.col("label").alias("margin"))
    calibration = IsotonicRegression(featuresCol="margin").fit(margins.unionByName(prior))
    return Model(lexicons[-1], trees, calibration)


def score(
    docs: DataFrame, model: Model, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, score, predicted) per row of ``docs``, from its whole text alone.

    The score lies between 0 and 1; null and empty texts have the features of a
    text without words. Repeated rows score alike; other columns are left out.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.lit(0).alias("fold"))
    if model.trees is None:
        scored = rows.select("id", F.lit(model.constant).alias("score"))
    else:
        xs = _featured(rows, [model.lexicon], "id").select("id", array_to_vector("x").alias("features"))
        margins = model.trees.transform(xs).select("id", vector_to_array("probability")[1].alias("margin"))
        step = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("prediction")))
        mixed = step * (1 - WITHIN_STEP) + F.col("margin") * WITHIN_STEP
        scored = model.calibration.transform(margins).select("id", mixed.alias("score"))
    return scored.select(F.col("id").alias(id_col), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def held_out(id_col: str = "doc_id"):
    """The third of the ids that labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))
