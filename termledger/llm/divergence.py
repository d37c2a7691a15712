"""Source divergence audit by a recount over minimal perfect hashes.

The first pass counts in how many documents of its language each term stands;
terms in enough of them are kept, exactly. The kept terms are dealt to shards,
and each shard gets a minimal perfect hash: a displacement per bucket that sends
its terms to the slots 0 to n - 1, with the term stored at its slot. The second
pass finds a term's slot by two hashes, compares the stored key, and increments
the slot of the document's group.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termledger.llm.common import parts
from termledger.session import StepFolder

#: Documents of the language that a kept term stands in.
MIN_DOCS = 3
#: Ranks of the terms of a group.
TOP_TERMS = 200
#: Kept terms of a shard, on average, and of a bucket of its hash.
SHARD_KEYS, BUCKET_KEYS = 65_536, 4
#: Bytes of the shards that are broadcast for one pass over the texts; more
#: kept terms take more passes.
PASS_BYTES = 24_000_000
#: Terms that a task holds with their slots.
HELD = 100_000
#: Cells of a block of numbers.
CELLS = 500_000
#: Bytes of texts whose terms are looked up together.
PART_BYTES = 2_000_000
#: Bytes of texts whose documents are counted together.
COUNTED_BYTES = 4_000_000
#: Counts of a group and shard that are added up in one step.
ADDED = 64
#: Displacements of a bucket that are tried before another seed is.
TRIES = 1 << 16
#: All shares are whole numbers of this part.
PARTS = 1_000_000_000

#: Signs of terms, and their lower case, by byte.
_OF_TERM = np.isin(np.arange(256), [*range(65, 91), *range(97, 123), *range(128, 256)])
_LOWER = np.frombuffer(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256)), np.uint8)
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def coded_terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(text's place, code) of each term in order, and the terms by code, in
    UTF-8: runs of letters and of signs beyond ASCII, A-Z lower-cased. No term
    becomes an object of its own."""
    texts = pc.fill_null(texts, "").cast(pa.binary())
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    signs = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]] if ends[-1] > ends[0] else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    inside = _OF_TERM[signs]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = ends[:-1][ends[:-1] < len(signs)]  # a term doesn't reach into the next text
    begins[first] = inside[first]
    at = np.flatnonzero(begins)
    kept = np.cumsum(inside, dtype=np.int32)
    offsets = np.append(kept[at] - 1, kept[-1:]) if len(at) else np.zeros(1, np.int32)
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(_LOWER[signs[inside]])]
    coded = pa.Array.from_buffers(pa.binary(), len(at), buffers).dictionary_encode()
    return np.searchsorted(ends, at, side="right") - 1, coded.indices.to_numpy(), coded.dictionary


# -- minimal perfect hashes ---------------------------------------------------


def _slot(hashes: np.ndarray, shift: np.ndarray, n) -> np.ndarray:
    x = hashes + shift.astype(np.uint64) * _K1
    x = (x ^ (x >> np.uint64(32))) * _K2
    return ((x ^ (x >> np.uint64(29))) % np.uint64(n) if np.isscalar(n) else (x ^ (x >> np.uint64(29))) % n).astype(np.int64)


def build(keys: list[bytes]) -> tuple[int, np.ndarray, np.ndarray]:
    """(seed, displacement of each bucket, slot of each key) of a minimal perfect
    hash of distinct keys. Large buckets are placed first; a bucket of one key
    takes a free slot directly, written as a negative displacement."""
    n = len(keys)
    for seed in count(1):
        hashes = np.fromiter((xxhash.xxh64_intdigest(k, seed) for k in keys), np.uint64, n)
        if len(np.unique(hashes)) == n and (found := _displace(hashes)):
            return seed, *found


def _displace(hashes: np.ndarray):
    n = len(hashes)
    buckets = max(1, n // BUCKET_KEYS)
    bucket = ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    members = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=buckets)
    starts = np.cumsum(sizes) - sizes
    shift, slots, free = np.zeros(buckets, np.int64), np.empty(n, np.int64), np.ones(n, bool)
    for b in np.argsort(-sizes, kind="stable"):
        own = members[starts[b] : starts[b] + sizes[b]]
        if len(own) < 2:
            break
        for start in range(0, TRIES, 64):
            tried = np.arange(start, start + 64)
            at = np.sort(_slot(hashes[own][None, :], tried[:, None], n), axis=1)
            fits = free[at].all(axis=1) & (np.diff(at, axis=1) > 0).all(axis=1)
            if fits.any():
                shift[b] = tried[np.argmax(fits)]
                slots[own] = _slot(hashes[own], np.full(len(own), shift[b]), n)
                free[slots[own]] = False
                break
        else:
            return None
    alone = np.nonzero(sizes == 1)[0]
    rest = np.nonzero(free)[0]
    shift[alone] = -1 - rest
    slots[members[starts[alone]]] = rest
    return shift, slots


class Shards:
    """Some shards side by side: slots of a shard follow those of the one before."""

    def __init__(self, table: pa.Table, first: int, shards: int):
        self.first, self.last, self.shards = first, first + len(table), shards
        column = lambda name: table.column(name).combine_chunks()
        keys = pc.binary_join_element_wise(pc.list_flatten(column("langs")), pc.list_flatten(column("terms")), "\0")
        self.keys = keys.cast(pa.binary())
        self.seeds = column("seed").to_numpy()
        self.sizes = pc.list_value_length(column("terms")).to_numpy().astype(np.int64)
        shifts = column("shift")
        self.buckets = pc.list_value_length(shifts).to_numpy().astype(np.int64)
        self.shift = pc.list_flatten(shifts).to_numpy()
        self.slots_from = np.cumsum(self.sizes) - self.sizes
        self.buckets_from = np.cumsum(self.buckets) - self.buckets
        # a language's slots in order, and the place of each slot among them
        coded = pc.dictionary_encode(pc.list_flatten(column("langs")))
        codes = coded.indices.to_numpy()
        self.of_lang = {lang: np.nonzero(codes == k)[0] for k, lang in enumerate(coded.dictionary.to_pylist())}
        self.place = np.zeros(len(codes), np.int64)
        for slots in self.of_lang.values():
            self.place[slots] = np.arange(len(slots))

    def find(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(places in ``keys``, slots) of the keys that are stored here."""
        home = np.fromiter((xxhash.xxh64_intdigest(k, 42) for k in keys), np.uint64, len(keys))
        shard = home.view(np.int64) % self.shards - self.first
        here = np.nonzero((shard >= 0) & (shard < len(self.sizes)))[0]
        shard = shard[here]
        here, shard = here[self.sizes[shard] > 0], shard[self.sizes[shard] > 0]
        seeds = self.seeds[shard]
        hashes = np.fromiter((xxhash.xxh64_intdigest(keys[k], s) for k, s in zip(here.tolist(), seeds.tolist())), np.uint64, len(here))
        bucket = ((hashes >> np.uint64(32)) % self.buckets[shard].astype(np.uint64)).astype(np.int64)
        shift = self.shift[self.buckets_from[shard] + bucket]
        slot = np.where(shift < 0, -1 - shift, _slot(hashes, np.maximum(shift, 0), self.sizes[shard].astype(np.uint64)))
        slot += self.slots_from[shard]
        same = pc.equal(self.keys.take(pa.array(slot)), pa.array([keys[k] for k in here.tolist()], pa.binary()))
        same = same.to_numpy(zero_copy_only=False).astype(bool)
        return here[same], slot[same]


# -- the two passes -----------------------------------------------------------


def _document_counts(batches):
    """(lang, term, documents), summed over ``COUNTED_BYTES`` of texts."""
    for whole in batches:
        for batch in parts(whole, 2, COUNTED_BYTES):
            langs = batch.column(0).dictionary_encode()
            text, code, words = coded_terms(batch.column(2))
            if not len(code):
                continue
            met = np.unique(text.astype(np.int64) * len(words) + code)  # each term once a text
            of_lang = langs.indices.to_numpy().astype(np.int64)[met // len(words)]
            found, docs = np.unique(of_lang * len(words) + met % len(words), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [langs.dictionary.take(pa.array(found // len(words))), words.take(pa.array(found % len(words))).cast(pa.string()),
                 pa.array(docs, pa.int64())],
                names=["lang", "term", "docs"],
            )


def _build_shard(table: pa.Table) -> pa.Table:
    langs, words = table.column("lang").to_pylist(), table.column("term").to_pylist()
    seed, shift, slots = build([f"{a}\0{b}".encode("utf-8", "surrogatepass") for a, b in zip(langs, words)])
    order = np.argsort(slots)
    return pa.table({
        "shard": pa.array([table.column("shard")[0].as_py()], pa.int64()),
        "seed": pa.array([seed], pa.int64()),
        "shift": pa.array([shift], pa.list_(pa.int64())),
        "langs": pa.array([[langs[k] for k in order]], pa.list_(pa.string())),
        "terms": pa.array([[words[k] for k in order]], pa.list_(pa.string())),
    })


def perfect_hashes(kept: DataFrame, shards: int) -> DataFrame:
    """(shard, seed, shift, langs, terms) of the terms (lang, term), one row a
    shard; ``langs`` and ``terms`` stand in the order of the slots."""
    shard = F.pmod(F.xxhash64(F.concat("lang", F.lit("\0"), "term")), F.lit(shards))
    return kept.select(shard.alias("shard"), "lang", "term").groupBy("shard").applyInArrow(
        _build_shard, "shard bigint, seed bigint, shift array<bigint>, langs array<string>, terms array<string>"
    )


_COUNTED = "lang string, source string, shard bigint, slots array<int>, n array<bigint>"


def recount(groups: DataFrame, hashes: DataFrame, shards: int, folder: StepFolder) -> DataFrame:
    """(lang, source, shard, slots, n): one row a group and shard with the slots
    that are met and their counts, from rows (lang, source, text).

    Each pass over the texts has as many shards broadcast as ``PASS_BYTES`` hold
    by their stored keys. A task takes its rows group by group, so it holds the
    dense slots of one group, and passes each group on once. The tasks' counts are
    added up ``ADDED`` at a time, so a group never meets whole in one task,
    however many tasks have counted it.
    """
    tasks = groups.rdd.getNumPartitions()
    groups = groups.sortWithinPartitions("lang", "source")
    size = F.aggregate(F.transform("terms", F.octet_length), F.lit(0).cast("long"), lambda a, b: a + b)
    size += F.aggregate(F.transform("langs", F.octet_length), F.lit(0).cast("long"), lambda a, b: a + b)
    total = hashes.agg(F.sum(size + F.size("terms") * 5 + F.size("shift") * 8)).first()[0] or 0
    passes = max(1, -(-total // PASS_BYTES))
    step, found = -(-shards // passes), None
    for first in range(0, shards, step):
        table = hashes.where((F.col("shard") >= first) & (F.col("shard") < first + step)).toArrow()
        counted = _one_pass(groups, table, first, min(step, shards - first), shards)
        found = counted if found is None else found.unionAll(counted)
    found = found.withColumn("part", F.spark_partition_id().cast("bigint"))
    while True:
        tasks = -(-tasks // ADDED)
        dealt = found.withColumn("lot", F.pmod(F.xxhash64("part"), F.lit(max(1, tasks))))
        added = dealt.groupBy("lang", "source", "shard", "lot").applyInArrow(_add, f"{_COUNTED}, part bigint")
        found = folder.write(added)
        if tasks <= 1:
            return found.drop("part")


def _add(table: pa.Table) -> pa.Table:
    """One row for those of a group, shard and lot."""
    slots = pc.list_flatten(table.column("slots")).to_numpy()
    counts = np.zeros(int(slots.max()) + 1, np.int64)
    np.add.at(counts, slots, pc.list_flatten(table.column("n")).to_numpy())
    at = np.nonzero(counts)[0]
    return pa.table({
        **{name: table.column(name).slice(0, 1) for name in ("lang", "source", "shard")},
        "slots": pa.array([at], pa.list_(pa.int32())),
        "n": pa.array([counts[at]], pa.list_(pa.int64())),
        "part": table.column("lot").slice(0, 1).cast(pa.int64()),
    })


def _one_pass(groups: DataFrame, table: pa.Table, first: int, step: int, shards: int) -> DataFrame:
    # a shard that got no term has an empty hash
    empty = sorted({*range(first, first + step)} - set(table.column("shard").to_pylist()))
    blank = {"shard": empty, "seed": [1] * len(empty), "shift": [[0]] * len(empty), "langs": [[]] * len(empty), "terms": [[]] * len(empty)}
    table = pa.concat_tables([table, pa.table(blank, schema=table.schema)]).sort_by("shard")
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    shared = groups.sparkSession.sparkContext.broadcast(sink.getvalue().to_pybytes())

    def run(batches):
        own = Shards(pa.ipc.open_stream(shared.value).read_all(), first, shards)
        # per language the place of each term met, the last place for terms that aren't kept
        known: dict[str, dict[bytes, int]] = defaultdict(dict)

        def passed_on(group, counts):
            at = np.nonzero(counts[:-1])[0]
            slots = own.of_lang[group[0]][at]
            shard = np.searchsorted(own.slots_from, slots, side="right") - 1
            starts = np.nonzero(np.diff(shard, prepend=-1))[0]
            offsets = pa.array(np.append(starts, len(at)), pa.int32())
            lists = lambda values, kind: pa.ListArray.from_arrays(offsets, pa.array(values, kind))
            return pa.RecordBatch.from_arrays(
                [*(pa.array([name] * len(starts), pa.string()) for name in group), pa.array(shard[starts] + first, pa.int64()),
                 lists(slots - own.slots_from[shard], pa.int32()), lists(counts[at], pa.int64())],
                names=["lang", "source", "shard", "slots", "n"],
            )

        def learn(lang: str, words: set[bytes]):
            new = list(words - known[lang].keys())
            if sum(map(len, known.values())) + len(new) > HELD:
                known.clear()
                new = list(words)
            prefix = lang.encode("utf-8", "surrogatepass") + b"\0"
            known[lang].update(dict.fromkeys(new, len(own.of_lang[lang])))
            places, slots = own.find([prefix + w for w in new])
            known[lang].update(zip(map(new.__getitem__, places.tolist()), own.place[slots].tolist()))

        current, counts = None, None
        for whole in batches:
            for batch in parts(whole, 2, PART_BYTES):
                names = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                text, code, words = coded_terms(batch.column(2))
                for group, rows in groupby(enumerate(names), lambda row: row[1]):
                    if group[0] not in own.of_lang:
                        continue
                    if group != current:
                        if current:
                            yield passed_on(current, counts)
                        current, counts = group, np.zeros(len(own.of_lang[group[0]]) + 1, np.int64)
                    rows = [k for k, _ in rows]
                    start, end = np.searchsorted(text, [rows[0], rows[-1] + 1])
                    often = np.bincount(code[start:end], minlength=len(words))
                    met = np.flatnonzero(often)
                    mine = words.take(pa.array(met)).to_pylist()
                    learn(group[0], set(mine))
                    places = np.fromiter(map(known[group[0]].__getitem__, mine), np.int64, len(mine))
                    np.add.at(counts, places, often[met])
        if current:
            yield passed_on(current, counts)

    return groups.mapInArrow(run, _COUNTED)


# -- the audit ----------------------------------------------------------------


def shares(counts: np.ndarray, total, smoothed: int) -> np.ndarray:
    """1 + floor(PARTS * (count + 1) / (total + smoothed)), exactly."""
    below = np.asarray(total) + smoothed
    if int(np.max(below, initial=0)) >= (1 << 62) // PARTS:
        return (1 + PARTS * (counts.astype(object) + 1) // below.astype(object)).astype(np.int64)
    return 1 + PARTS * (counts + 1) // below


def gains(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q) ** 2 / q): below 2 ** 62, as no share is above PARTS + 1."""
    return (p - q) ** 2 // q


def _compare(top_terms: int):
    """A function of the counts (source's number ``at``, slots, n) and the terms of
    one language and shard: the gains of the groups against the language, as far
    as they may come to the top, and the sums of gains of each group against each
    other one."""

    def run(counted: pa.Table, terms: pa.Table) -> pa.Table:
        lang, totals, v, lang_total = (terms.column(c)[0].as_py() for c in ("lang", "totals", "v", "lang_total"))
        totals = np.array(totals, np.int64)
        slots = pc.list_flatten(terms.column("slots")).to_numpy()
        place = np.zeros(int(slots.max()) + 1, np.int64)
        place[slots] = np.arange(len(slots))
        words = pc.list_flatten(terms.column("words"))
        lines = [place[own] for own in _lists(counted.column("slots"))]
        numbers, ns = counted.column("at").to_pylist(), _lists(counted.column("n"))
        sums = np.zeros((len(totals), len(totals)), np.int64)
        out = []
        step = max(1, CELLS // len(totals))
        for start in range(0, len(slots), step):
            counts = np.zeros((min(step, len(slots) - start), len(totals)), np.int64)
            for at, line, n in zip(numbers, lines, ns):
                here = (line >= start) & (line < start + step)
                counts[line[here] - start, at] = n[here]
            p = shares(counts, totals[None, :], v)
            q = shares(counts.sum(axis=1), lang_total, v)[:, None]
            for g in range(len(totals)):
                sums[g] += gains(p[:, g : g + 1], p).sum(axis=0)
                row = np.nonzero((counts[:, g] > 0) & (p[:, g] > q[:, 0]))[0]
                value = gains(p[row, g], q[row, 0])
                if len(row) > top_terms:
                    often = value >= np.partition(value, -top_terms)[-top_terms]
                    row, value = row[often], value[often]
                out.append(_rows(lang, np.full(len(row), g), np.full(len(row), -1), words.take(pa.array(row + start)), value))
        a, b = np.nonzero(~np.eye(len(totals), dtype=bool))
        out.append(_rows(lang, a, b, pa.nulls(len(a), pa.string()), sums[a, b]))
        return pa.Table.from_batches(out)

    return run


def _lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [x.values.to_numpy(zero_copy_only=False) for x in column]


def _rows(lang, at, other, words, values):
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(other, pa.int32()),
         words.combine_chunks() if isinstance(words, pa.ChunkedArray) else words, pa.array(values, pa.int64())],
        names=["lang", "at", "other", "term", "value"],
    )


def audit(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    top_terms: int = TOP_TERMS,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """(lang, source, part, item, value, rank): how each source's words depart
    from those of its language's other sources (part ``pair``, one row each
    other source) and of the language (part ``term``, the ``top_terms`` terms it
    holds more of).

    Shares are smoothed over the language's kept terms, those in ``min_docs`` of
    its rows or more; all arithmetic is of whole numbers. Nulls read as ''. A
    group without terms is compared by the smoothing alone; a language without
    kept terms has pairs of value 0. Repeated rows count each. Ties go to the
    smaller item by UTF-8. Other columns are left out, whatever their names. An
    empty table gives an empty result.

    Both passes sum in the task before anything is shuffled, so a source or term
    that holds most rows is a few rows a task. Shards hold a bounded number of
    terms; those broadcast at once are bounded in bytes. A language's shard meets
    with a count for each of its terms and sources; its pairs are as many as the
    result's.
    """
    folder = StepFolder(docs.sparkSession, "divergence", keep=True)
    named = {"lang": lang_col, "source": source_col, "text": text_col}
    groups = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for a, c in named.items()])
    often = groups.mapInArrow(_document_counts, "lang string, term string, docs bigint").groupBy("lang", "term")
    kept = folder.write(often.agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs).select("lang", "term"))
    shards = -(-kept.count() // SHARD_KEYS)
    if shards:
        hashes = folder.write(perfect_hashes(kept, shards))
        counts = recount(groups, hashes, shards, folder)
        slots = hashes.select("shard", F.posexplode(F.arrays_zip("langs", "terms")).alias("slot", "key"))
        slots = slots.groupBy(F.col("key.langs").alias("lang"), "shard").agg(
            F.collect_list(F.struct("slot", F.col("key.terms").alias("word"))).alias("own")
        )
    else:
        counts = docs.sparkSession.createDataFrame([], _COUNTED)
        slots = docs.sparkSession.createDataFrame([], "lang string, shard bigint, own array<struct<slot:int,word:string>>")

    # one row a language: its sources in order, their totals, kept terms
    sum_of = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, b: a + b)
    total = counts.groupBy("lang", "source").agg(F.sum(sum_of("n")).alias("total"))
    sources = groups.select("lang", "source").distinct().join(total, ["lang", "source"], "left")
    lists = sources.groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct("source", F.coalesce("total", F.lit(0)).alias("total")))).alias("own")
    )
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    lists = folder.write(
        lists.join(sizes, "lang", "left").select(
            "lang", F.col("own.source").alias("sources"), F.col("own.total").alias("totals"), F.coalesce("v", F.lit(0)).alias("v")
        ).withColumn("lang_total", sum_of("totals"))
    )
    numbered = lists.select("lang", F.posexplode("sources").alias("at", "source"))
    counted = counts.join(numbered, ["lang", "source"]).select("lang", "shard", "at", "slots", "n")
    known = slots.join(lists, "lang").select(
        "lang", "shard", F.col("own.slot").alias("slots"), F.col("own.word").alias("words"), "totals", "v", "lang_total"
    )
    met = counted.groupBy("lang", "shard").cogroup(known.groupBy("lang", "shard"))
    found = folder.write(met.applyInArrow(_compare(top_terms), "lang string, at int, other int, term string, value bigint"))

    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    held = found.where("other < 0").join(numbered, ["lang", "at"])
    held = held.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    held = held.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top_terms)

    summed = found.where("other >= 0").groupBy("lang", "at", "other").agg(F.sum("value").alias("value"))
    others = lists.select("lang", "sources", F.posexplode("sources").alias("at", "source")).select(
        "lang", "at", "source", F.posexplode("sources").alias("other", "item")
    ).where("at != other")
    pairs = others.join(summed, ["lang", "at", "other"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value")
    )
    return pairs.withColumn("rank", F.row_number().over(best)).unionByName(held)
