"""SentencePiece encoding and decoding by a table of distinct chunks.

The library marks white space with U+2581 and puts one mark before the text.
Where no piece of the vocabulary holds a mark behind another sign, no merge
crosses from one run of marks and signs to the next: such a run, a chunk, has the
same pieces wherever it stands. So distinct chunks are segmented, not texts, and
a text's ids are its chunks' ids, joined back by position.

The table of distinct chunks has two parts. The frequent chunks of the corpus are
segmented once for all and broadcast, bounded in number and bytes. Every other
chunk is segmented once in a partition that holds it, whose own table it enters.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termledger.llm.common import parts
from termledger.session import StepFolder

MARK = "\u2581"
#: Chunks that are broadcast at most, the most frequent ones, and the bytes of
#: each: some 32 MB.
FREQUENT, FREQUENT_BYTES = 131_072, 64
#: Distinct chunks and letters that a task holds at most, to count or segment them.
HELD_CHUNKS, HELD_LETTERS = 100_000, 4_000_000
#: Letters of a text that are cut into chunks at once.
SLICE = 1_000_000
#: Bytes of texts or ids whose results are held before they are passed on.
PART_BYTES = 4_000_000

_CHUNK = re.compile(f"{MARK}+[^{MARK}]*")
_INTS = pa.list_(pa.int32())


class Pieces:
    """A SentencePiece model, whose bytes travel with the tasks."""

    def __init__(self, path: str):
        self.data = Path(path).read_bytes()
        check_model(self.data)


@lru_cache(maxsize=2)
def processor(data: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=data)


def check_model(data: bytes) -> None:
    """Raise if chunks of the model's texts can't be segmented apart: a piece
    crosses into a mark, or the normaliser does more than mark white space."""
    model = processor(data)
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        if MARK in piece.lstrip(MARK):
            raise ValueError(f"piece {piece!r} crosses a white-space mark; encode whole texts instead")
    for text in (" a  b\t\u3000c ", "A\u0301 \ufb01 \n\u200b"):
        if model.normalize(text) != MARK + text.replace(" ", MARK):
            raise ValueError("the model's normaliser changes texts; encode whole texts instead")


def chunks(text: str) -> Iterator[list[str]]:
    """The chunks of a text in order, in lists of bounded letters: the text is
    cut before a mark that follows another sign."""
    if not text:
        return
    marked = MARK + text.replace(" ", MARK)
    start = 0
    while len(marked) - start > SLICE:
        end = start + SLICE
        # a border is a mark behind another sign; a chunk without one stays whole
        while end < len(marked) and not (marked[end] == MARK and marked[end - 1] != MARK):
            end += 1
        yield _CHUNK.findall(marked, start, end)
        start = end
    if start < len(marked):
        yield _CHUNK.findall(marked, start)


def segment(model, some: list[str]) -> list[list[int]]:
    """The ids of each chunk. The library puts the first mark back by itself, but
    for a text without signs."""
    alone = [model.piece_to_id(MARK)]
    return [ids or alone for ids in model.encode([chunk[1:] for chunk in some], num_threads=1)]


def packed(ids: list[int]) -> bytes:
    """Ids as 32-bit integers: a fifth of a list's memory, and joined as they are."""
    return array("i", ids).tobytes()


def _count(batches):
    """(chunk, n), summed in the task as far as it holds them."""

    def flush(counts):
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["chunk", "n"]
        )

    counts, letters = Counter(), 0
    for batch in batches:
        for text in batch.column(0):
            for some in chunks(text.as_py() or ""):
                counts.update(some)
                letters += sum(map(len, some))
                if letters >= HELD_LETTERS:
                    # what is held: repeats of a chunk are held once
                    letters = sum(map(len, counts))
                if len(counts) >= HELD_CHUNKS or letters >= HELD_LETTERS:
                    yield flush(counts)
                    counts, letters = Counter(), 0
    yield flush(counts)


def segmented(table: DataFrame, model: Pieces) -> DataFrame:
    """(chunk, ids) for the distinct chunks of a table (chunk)."""
    data = model.data

    def run(batches):
        own = processor(data)
        for batch in batches:
            ids = segment(own, batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, _INTS)], names=["chunk", "ids"])

    return table.select("chunk").mapInArrow(run, "chunk string, ids array<int>")


def least_count(table: DataFrame, most: int) -> int:
    """The smallest count from which on there are ``most`` chunks at most. One
    row a different count is looked at, from the largest down."""
    sizes = table.groupBy("n").agg(F.count(F.lit(1)).alias("chunks")).orderBy(F.desc("n")).limit(most + 1)
    total, least = 0, 1 << 62
    for row in sizes.collect():
        total += row["chunks"]
        if total > most:
            break
        least = row["n"]
    return least


def encode(docs: DataFrame, model: Pieces, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids) per row of ``docs``: the ids of its whole text between the
    model's begin and end ids, as the library gives them.

    A null text is the empty one, which has the two outer ids. Null and repeated
    ids and repeated rows are fine. Other columns are left out, whatever their
    names. An empty table gives an empty result.

    Chunks are counted in the tasks, then summed, so a frequent one is a few
    rows a task; only those counts are shuffled, never texts or ids. A task's
    own table of rarer chunks is bounded too: it begins anew when it is full.
    """
    spark = docs.sparkSession
    folder = StepFolder(spark, "pieces", keep=True)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    counts = texts.select("text").mapInArrow(_count, "chunk string, n bigint")
    counts = counts.where(F.octet_length("chunk") <= FREQUENT_BYTES).groupBy("chunk").agg(F.sum("n").alias("n"))
    counts = folder.write(counts.where("n > 1"))
    frequent = counts.where(F.col("n") >= least_count(counts, FREQUENT))
    table = folder.write(segmented(frequent, model))
    known = spark.sparkContext.broadcast({r["chunk"]: packed(r["ids"]) for r in table.collect()})
    data = model.data

    def run(batches):
        frequent, own = known.value, processor(data)
        begin, end = packed([own.bos_id()]), packed([own.eos_id()])
        held, letters = dict(frequent), 0
        for whole in batches:
            for batch in parts(whole, 1, PART_BYTES):
                cut = [list(chunks(text.as_py() or "")) for text in batch.column(1)]
                new = list({chunk for text in cut for some in text for chunk in some if chunk not in held})
                if len(held) - len(frequent) + len(new) > HELD_CHUNKS or letters > HELD_LETTERS:
                    held, letters = dict(frequent), 0
                    new = list({chunk for text in cut for some in text for chunk in some if chunk not in held})
                held.update(zip(new, map(packed, segment(own, new))))
                letters += sum(map(len, new))
                joined = lambda some: b"".join(map(held.__getitem__, some))
                ids = [np.frombuffer(b"".join([begin, *map(joined, text), end]), np.int32) for text in cut]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, _INTS)], names=["id", "ids"])

    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, model: Pieces, id_col: str = "doc_id") -> DataFrame:
    """``encoded`` (id, ids) with ``text``, as the library decodes the whole list."""
    data = model.data
    source = encoded.select(F.col(id_col).alias("id"), "ids")
    kind = source.schema["id"].dataType.simpleString()

    def run(batches):
        own = processor(data)
        for whole in batches:
            for batch in parts(whole, 1, PART_BYTES):
                texts = [own.decode(ids.values.to_numpy().tolist()) for ids in batch.column(1)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=["id", "ids", "text"])

    return source.mapInArrow(run, f"id {kind}, ids array<int>, text string").withColumnRenamed("id", id_col)


def round_trip(encoded: DataFrame, model: Pieces, id_col: str = "doc_id") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of (id, ids): digests of the ids
    as little-endian unsigned 32-bit integers and of the decoded text in UTF-8."""
    data = model.data
    source = encoded.select(F.col(id_col).alias("id"), "ids")
    kind = source.schema["id"].dataType.simpleString()

    def run(batches):
        own = processor(data)
        for batch in batches:
            sizes, of_ids, of_texts = [], [], []
            for ids in batch.column(1):
                ids = ids.values.to_numpy()
                text = own.decode(ids.tolist())
                ids = ids.astype("<u4")
                sizes.append(len(ids))
                of_ids.append(hashlib.sha256(ids.tobytes()).hexdigest())
                of_texts.append(hashlib.sha256(text.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_texts, pa.string())],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)
