"""SentencePiece encoding by distinct chunks against the library itself."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from termledger.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
SIGNS = list("abcdeXYZ 01  ▁▁\t\n.,'\"<>/s") + [
    "é", "ß", "漢", "😀", "‍", "\x00", "</s>", "<s>", "<unk>", "<0x41>", "　", "\r\n", " the", " of ",
]


@pytest.fixture(scope="module")
def model():
    return pieces.Pieces(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts(n, most):
    draw = random.Random(5)
    return ["".join(draw.choice(SIGNS) for _ in range(draw.randrange(most))) for _ in range(n)]


def test_chunks_are_segmented_as_in_the_whole_text(model, library, monkeypatch):
    monkeypatch.setattr(pieces, "SLICE", 37)
    for text in texts(3000, 120):
        ids = [i for some in pieces.chunks(text) for own in pieces.segment(library, some) for i in own]
        assert [library.bos_id(), *ids, library.eos_id()] == library.encode(text, add_bos=True, add_eos=True)


@pytest.mark.parametrize("frequent", [pieces.FREQUENT, 5, 0])
def test_encoding_and_decoding(spark, model, library, monkeypatch, frequent):
    """However few chunks are broadcast; null, empty, long, repeated, no id, odd columns."""
    monkeypatch.setattr(pieces, "FREQUENT", frequent)
    words = texts(40, 9)
    draw = random.Random(6)
    rows = [(n, " ".join(draw.choice(words) for _ in range(draw.randrange(60)))) for n in range(80)]
    rows += [(7, None), (8, ""), (8, ""), (None, "no id"), (None, "no id"), (9, " "), (10, "x" * 3000), (11, "long one " * 9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.withColumn("ids", F.lit("clash")).withColumn("row", F.lit(1)).withColumn("chunk", F.lit(2))
    encoded = pieces.encode(docs, model)
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in pieces.round_trip(encoded, model).collect())

    def expected(text):
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()

    assert got == sorted((str(n), *expected(text)) for n, text in rows)
    decoded = sorted((str(r.doc_id), r.text) for r in pieces.decode(encoded, model).collect())
    assert decoded == sorted((str(n), library.decode(library.encode(t or ""))) for n, t in rows)
    assert pieces.encode(docs.limit(0), model).count() == 0


def test_models_whose_pieces_cross_marks_are_refused(monkeypatch):
    class Crossing:
        vocab_size = staticmethod(lambda: 1)
        id_to_piece = staticmethod(lambda i: "a▁b")

    monkeypatch.setattr(pieces, "processor", lambda data: Crossing)
    with pytest.raises(ValueError, match="crosses"):
        pieces.check_model(b"")


def test_counts_of_the_table(spark, model, monkeypatch):
    """However little a task holds, the counts are the same."""
    monkeypatch.setattr(pieces, "HELD_CHUNKS", 3)
    batches = spark.createDataFrame([("a b a c d e a",), (None,), ("b  a",)], "text string").coalesce(1)
    found = {r.chunk: r.n for r in batches.mapInArrow(pieces._count, "chunk string, n bigint").groupBy("chunk").agg(F.sum("n").alias("n")).collect()}
    assert found == {"▁a": 3, "▁b": 2, "▁c": 1, "▁d": 1, "▁e": 1, "▁▁a": 1}
