"""Operators against brute force, and on nulls, ties, repeats and empty tables."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from termledger.llm import decontaminate, licenses, lines, mixing, sharding, simhash, tokens, topk, toxicity, url_rules
from termledger.llm.components import connected_components
from termledger.llm.url_rules import Rule
from termledger.session import StepFolder

DOCS = "doc_id long, text string, source string"


def sentence(draw, n):
    return " ".join(draw.choice("abcdefghij") + str(draw.randrange(400)) for _ in range(n))


def classes(nodes, linked):
    """Smallest node reachable, for every node."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# -- SimHash -----------------------------------------------------------------


def test_fingerprint_by_the_definition():
    import xxhash

    text = "The quick  brown\tfox jumps\nover THE lazy dog the quick brown fox"
    words = text.lower().split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]), 42) for i in range(len(words) - 2)]
    expected = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint(text) & (2**64 - 1) == expected
    assert simhash.fingerprint(None) == simhash.fingerprint(" \t\n") == 0
    assert simhash.fingerprint("A b") & (2**64 - 1) == xxhash.xxh64_intdigest("a b", 42)


@pytest.mark.parametrize("paired", [256, 2])
def test_links_of_fingerprints(spark, paired):
    draw = random.Random(3)
    found = {draw.getrandbits(64) - 2**63 for _ in range(40)}
    for _ in range(5):
        base = draw.getrandbits(64) - 2**63
        for _ in range(40):
            x = base ^ (1 << draw.randrange(63)) ^ (1 << draw.randrange(63)) ^ (1 << draw.randrange(63))
            found.add(x)
    nodes = sorted(found)
    linked = [(a, b) for a in nodes for b in nodes if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2]
    expected = classes(nodes, linked)
    folder = StepFolder(spark, "test", keep=True)
    pairs = simhash.near_pairs(spark.createDataFrame([(n,) for n in nodes], "fp long"), folder, paired)
    assert all(((r.u ^ r.v) & (2**64 - 1)).bit_count() <= 2 for r in pairs.collect())
    got = {n: n for n in nodes} | {r.u: r.v for r in connected_components(pairs, folder).collect()}
    assert got == expected


def test_near_duplicates_of_odd_rows(spark):
    text = sentence(random.Random(1), 60)
    rows = [(5, text, "a"), (3, text, "b"), (9, None, None), (8, "", "c"), (8, "", "c"), (None, text, "a"), (1, "x", "a")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("fingerprint", F.lit("clash")).withColumn("component_id", F.lit(0))
    got = sorted((r.doc_id or -1, r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert got == [(-1, 3), (1, 1), (3, 3), (5, 3), (8, 8), (8, 8), (9, 8)]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


# -- mixing and sharding -----------------------------------------------------


def test_keys_of_fingerprints_are_not_broadcast(spark, tmp_path):
    """1.3 million keys exploded from a table of 160 kB, of which many are shared:
    the planner takes the keys for small, and the shared ones it has just counted
    for large."""
    draw = random.Random(5)
    prints = [draw.getrandbits(64) - 2**63 for _ in range(10_000)]
    prints += [fp ^ 1 << draw.randrange(62) for fp in prints]
    folder, written = StepFolder(spark, "keys", keep=True), []

    class Kept:
        def write(self, df):
            written.append(df)
            return folder.write(df)

    distinct = folder.write(spark.createDataFrame([(fp,) for fp in prints], "fp long").distinct())
    pairs = simhash.near_pairs(distinct, Kept()).distinct()
    assert {(min(r), max(r)) for r in pairs.collect()} >= {(min(p), max(p)) for p in zip(prints, prints[10_000:])}
    (shared,) = written
    shared.collect()
    plan = shared._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "SortMergeJoin" in plan and "BroadcastExchange" not in plan


def test_water_filling(spark):
    rows = [("a", 100, 5.0), ("b", 1000, 2.0), (None, 1000, 1.0), ("z", 0, 5.0)]
    sources = spark.createDataFrame(rows, "source string, source_size long, weight double")
    got = {r.source: r.target for r in mixing.water_fill(sources, 2100 * 1.5, 2.0).collect()}
    assert got["a"] == 200 and got["z"] == 0
    assert got["b"] == pytest.approx(2950 * 2 / 3) and got[None] == pytest.approx(2950 / 3)
    tight = {r.source: r.target for r in mixing.water_fill(sources, 2100 * 1.8, 2.0).collect()}
    assert (tight["a"], tight["b"]) == (200, 2000) and tight[None] == pytest.approx(1580)


def test_mix_meets_its_targets(spark):
    draw = random.Random(5)
    rows = [(n, sentence(draw, draw.randrange(1, 80)), draw.choice(["p", "q", "r", None])) for n in range(900)]
    rows += [(None, None, "p"), (7, "", "q"), (7, "one", "q")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("size", F.lit(-1)).withColumn("draw", F.lit("x"))
    out = mixing.mix(docs, (5, 2, 1), per_bucket=50).collect()
    assert len(out) == len(rows)
    assert all(r.taken <= 2 * r["size"] for r in out)
    for source in ("p", "q", "r", None):
        own = [r for r in out if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 40
        assert sum(r["size"] for r in own) == own[0].source_size
    again = mixing.mix(docs, (5, 2, 1), per_bucket=3).collect()
    key = lambda r: (str(r.doc_id), r["size"], str(r.source), r.taken)
    assert sorted(map(key, out)) == sorted(map(key, again))
    assert mixing.mix(docs.limit(0), (5, 2, 1)).count() == 0


def test_mix_of_rows_without_ids_and_of_copies(spark):
    """Rows without an id are drawn by their texts; copies are taken one by one."""
    draw = random.Random(6)
    rows = [(None if n % 3 else n, sentence(draw, draw.randrange(1, 40)), draw.choice("pq")) for n in range(600)]
    rows += [(None, "one and the same text", "p")] * 400 + [(5, None, "q")] * 30
    docs = spark.createDataFrame(rows, DOCS)
    for per_bucket in (4096, 20):
        out = mixing.mix(docs, (5, 2, 1), per_bucket=per_bucket).collect()
        assert sorted((str(r.doc_id), r.source, r["size"]) for r in out) == sorted(
            (str(a), c, len((b or "").split())) for a, b, c in rows
        )
        for source in "pq":
            own = [r for r in out if r.source == source]
            assert abs(sum(r.taken for r in own) - own[0].target) <= 40
        copies = {r.repeats for r in out if r["size"] == 5 and r.doc_id is None and r.source == "p"}
        assert max(copies) - min(copies) <= 1


def test_lookup_table():
    names = [f"s{k}" for k in range(7)]
    table = sharding.lookup_table(names)
    counts = np.bincount(table)
    assert counts.max() - counts.min() <= 1 and -1 not in table
    fewer = sharding.lookup_table(names[:-1], len(table))
    moved = sum(a != b for a, b in zip(table, fewer) if a != 6)
    assert moved < 0.1 * len(table)
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.lookup_table(bad)


def test_placement(spark):
    rows = [(1, "x", "a"), (1, "y", "b"), (None, "z", None), (None, "w", None)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("slot", F.lit("clash"))
    out = sharding.place(docs, ["a", "b", "c"]).collect()
    assert len(out) == 4 and len({(r.doc_id, r.shard) for r in out}) == 2
    assert sharding.place(docs.limit(0), ["a"]).count() == 0


# -- lines, licenses, benchmark ----------------------------------------------


def test_shared_lines_go(spark):
    rows = [(n, f"own {n}\n  menu  \n\ntail {n}", f"s{n % 10}") for n in range(30)]
    rows += [(100 + n, "rare\nmenu", "s0") for n in range(20)] + [(200, None, "s1"), (201, "", None), (202, "menu", None)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("n_lines", F.lit("clash"))
    for name in ("line", "lines", "doc", "digest", "shared", "kept"):
        docs = docs.withColumn(name, F.lit(f"own {name}"))
    out = {r.doc_id: r for r in lines.dedup_lines(docs, min_sites=8).collect()}
    assert out[3].clean_text == "own 3\n\ntail 3" and (out[3].n_lines, out[3].n_removed) == (4, 1)
    assert {out[3][name] for name in ("doc", "digest", "shared")} == {"own doc", "own digest", "own shared"}
    assert out[100].clean_text == "rare" and out[202].clean_text == ""
    assert out[200].clean_text is None and out[200].n_lines == 0 and out[201].clean_text == ""
    more = lines.dedup_lines(docs, min_sites=11)
    assert more.where("n_removed > 0").count() == 0
    assert lines.dedup_lines(docs.limit(0)).count() == 0


def test_license_windows(spark):
    draw = random.Random(2)
    mit = licenses.TEMPLATES["mit"].split()
    changed = [w if k % 40 else "other" for k, w in enumerate(mit)]
    rows = [
        (1, sentence(draw, 3000) + " " + " ".join(mit) + " " + sentence(draw, 500), "a"),
        (2, sentence(draw, 77) + " " + " ".join(changed), "a"),
        (3, "Released under the MIT License.", None),
        (3, "Released under the MIT License.", None),
        (4, " ".join(mit[:40]) + " " + sentence(draw, 60), "a"),
        (5, None, "a"), (6, "", "a"), (7, sentence(draw, 900), "a"), (None, "x " + licenses.TEMPLATES["gpl-3.0"], "a"),
    ]
    docs = spark.createDataFrame(rows, DOCS).withColumn("template", F.lit(1)).withColumn("h", F.lit(1))
    out = licenses.scan(docs).collect()
    assert {(r.doc_id, r.template) for r in out} == {(1, "mit"), (2, "mit"), (3, "mit-short"), (None, "gpl-3.0")}
    first = next(r for r in out if r.doc_id == 1)
    assert (first.first_word, first.containment) == (3000, 1.0)
    assert licenses.scan(docs.limit(0)).count() == 0


def test_bands_guarantee_collisions():
    for m in range(1, 300):
        w = 1 << (m - 1).bit_length()
        j = licenses.least_jaccard(m, w)
        assert 1 - (1 - j) ** licenses.bands(j) >= licenses.COLLISION


ITEM = "A train leaves Paris at 7 km per hour and then it meets Anna after 12 minutes near the old stone bridge of Lyon"


def test_changed_questions_are_caught(spark):
    draw = random.Random(4)
    fill = lambda n: sentence(draw, n).replace("0", "o")
    other = ITEM.replace("Paris", "Rome").replace("7", "31").replace("Anna", "Otto").replace("12", "55").replace("Lyon", "Bonn")
    rows = [
        (1, f"{fill(200)}.\n{ITEM}\n{fill(50)}", "a"),
        (2, f"{fill(20)}.\n{other}.", "a"),
        (3, fill(300), "a"), (4, None, "a"), (5, "", "a"), (None, ITEM, "a"), (6, ITEM, "b"), (6, ITEM, "b"),
    ]
    docs = spark.createDataFrame(rows, DOCS).withColumn("window", F.lit(1)).withColumn("item", F.lit(2))
    bench = spark.createDataFrame([(70, ITEM), (70, ITEM), (71, None), (None, ITEM), (72, "")], "item_id long, text string")
    out = decontaminate.contaminated(docs, bench).collect()
    assert sorted((r.doc_id or -1, r.item_id, r.kind) for r in out) == [
        (-1, 70, "exact"), (1, 70, "exact"), (2, 70, "changed"), (6, 70, "exact"), (6, 70, "exact"),
    ]
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def test_slots_must_agree(spark):
    item = "take 3 and 3 and then 3 and again 3 with 3 of 3 so that 3 is 3"
    mixed = "take 1 and 2 and then 4 and again 5 with 6 of 7 so that 8 is 9"
    alike = item.replace("3", "8")
    docs = spark.createDataFrame([(1, mixed, "a"), (2, alike, "a")], DOCS)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert [r.doc_id for r in decontaminate.contaminated(docs, bench).collect()] == [2]


# -- urls --------------------------------------------------------------------


def test_urls_and_stated_rules():
    assert url_rules.split_url("HTTP://A.Example.ORG/Es/x?q#f") == ("a.example.org", "/Es/x")
    assert url_rules.split_url("x://h?a/b") == ("h", "") and url_rules.split_url(None) == url_rules.split_url("h/p") == ("", "")
    rules = [Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1")]
    find = url_rules.stated(rules)
    assert find("m.example.org", "/es/1").verdict == "block" and find("example.org", "/en/2").text == "org/"
    assert find("notexample.com", "/") is None and find("example.org", "") is None


def test_mined_rules(spark):
    rows = [(n, f"https://h{n % 30}.spam.com/{'buy' if n % 2 else 'win'}/{n}", None) for n in range(200)]
    rows += [(1000 + n, f"https://h{n % 30}.good.com/{'buy' if n % 2 else 'read'}/{n}", None) for n in range(200)]
    pages = spark.createDataFrame([(a, b) for a, b, _ in rows], "page_id long, url string")
    labels = pages.where("page_id % 2 = 0 or page_id % 5 = 0").selectExpr(
        "url", "if(url like '%spam%', 'block', 'allow') as label"
    )
    odd = spark.createDataFrame([(5, None), (6, "no url"), (7, "https://else.net/")], "page_id long, url string")
    out = url_rules.judge(pages.unionByName(odd), [], labels, min_support=0.02).collect()
    brute = {r.page_id: "block" if "spam" in (r.url or "") else "allow" for r in out}
    assert {r.page_id: r.verdict for r in out if r.page_id not in (5, 6, 7)} == {k: v for k, v in brute.items() if k not in (5, 6, 7)}
    assert url_rules.judge(pages.limit(0), []).count() == 0
    assert {r.verdict for r in url_rules.judge(odd, [Rule("block", "net", "/")]).collect()} == {"allow", "block"}


# -- tokens ------------------------------------------------------------------


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_token_counts(spark, tmp_path, name):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    rows = [(1, "Hello  world <|endoftext|> <s>", "a"), (2, None, "a"), (3, "", "a"), (4, "ß ŧ \u0000 é" * 50, "a"), (1, "other", "a")]
    rows += [(10 + n, "the same text", "a") for n in range(20)] + [(None, "the same text", "a")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("digest", F.lit(1)).withColumn("n_tokens", F.lit("x"))
    if name.endswith(".model"):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(model.encode(t))
    else:
        model = Tokenizer.from_file(path)
        count = lambda t: len(model.encode(t, add_special_tokens=False).ids)
    tokenizer = tokens.Tokenizer(path)
    expected = sorted((str(i), len((t or "").encode()), count(t or "")) for i, t, _ in rows)
    cache = str(tmp_path / "cache")
    for _ in range(2):
        out = tokens.count_tokens(docs, tokenizer, cache).collect()
        assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in out) == expected
        assert spark.read.parquet(cache).count() == len({t or "" for _, t, _ in rows})
    assert tokens.count_tokens(docs.limit(0), tokenizer, cache).count() == 0


def test_repeated_texts_are_encoded_once(spark, tmp_path, monkeypatch):
    """Copies of a row, with and without an id: one line of the cache a text."""
    import public_tokenizers

    rows = [(None, f"text {n % 7}") for n in range(70)] + [(3, "text 1")] * 5 + [(4, "its own"), (None, None), (None, "")] + [(9, "copied")] * 8
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    tokenizer, cache = tokens.Tokenizer(public_tokenizers.path("piece_bpe_32k.model")), str(tmp_path / "cache")
    for limit in (10**6, 0):  # either way of choosing the rows to encode
        monkeypatch.setattr(tokens, "BROADCAST_ROWS", limit)
        out = tokens.count_tokens(docs, tokenizer, f"{cache}{limit}").collect()
        assert len(out) == len(rows)
        stored = spark.read.parquet(f"{cache}{limit}")
        assert stored.count() == stored.select("digest").distinct().count() == len({t or "" for _, t in rows})


# -- top-k -------------------------------------------------------------------


@pytest.mark.parametrize("query_block", [4096, 3])
def test_top_k(spark, query_block, monkeypatch):
    monkeypatch.setattr(topk, "BUCKET", 16)
    draw = np.random.default_rng(1)
    vectors = (draw.normal(size=(200, 6)) * draw.uniform(0.01, 3, size=(200, 1))).tolist()
    vectors += [vectors[3]] * 40 + [[0.0] * 6] + [[2 * x for x in vectors[0]]]
    rows = [(n, v) for n, v in enumerate(vectors)]
    odd = [(500, None), (501, [None] * 6), (502, [float("nan")] * 6), (503, [float("inf")] + [0.0] * 5), (None, vectors[0]), (600, [1.0, 2.0])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("norm", F.lit("clash"))
    ints = {n: [int(np.floor(1024 * x)) for x in v] for n, v in rows}
    expected = set()
    for q in range(0, len(rows), 10):
        scored = sorted((-sum(a * b for a, b in zip(ints[q], v)), n) for n, v in ints.items() if n != q)[:5]
        expected |= {(q, rank + 1, n, -s) for rank, (s, n) in enumerate(scored)}
    out = topk.top_k(df, F.col("id") % 10 == 0, k=5, query_block=query_block).collect()
    assert {(r.query_id, r.rank, r.vec_id, r.score) for r in out} == expected
    assert topk.top_k(df.limit(0), F.col("id") % 10 == 0).count() == 0


def test_top_k_of_repeated_rows(spark):
    """Each row is a candidate and a query of its own, whatever repeats."""
    draw = np.random.default_rng(4)
    rows = [(n, v) for n, v in enumerate(draw.normal(size=(40, 4)).tolist())]
    rows += [rows[10]] * 3 + [rows[7]] * 5 + [(10, rows[3][1]), (7, rows[3][1])]
    ints = [(n, [int(np.floor(1024 * x)) for x in v]) for n, v in rows]
    expected = []
    for q, own in ints:
        if q % 10 == 0:
            scored = sorted((-sum(a * b for a, b in zip(own, v)), n) for n, v in ints if n != q)[:6]
            expected += [(q, rank + 1, n, -s) for rank, (s, n) in enumerate(scored)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for block in (4096, 2):
        out = topk.top_k(df, F.col("id") % 10 == 0, k=6, query_block=block).collect()
        assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in out) == sorted(expected)


# -- toxicity ----------------------------------------------------------------


def test_toxicity_learns_and_survives_odd_rows(spark):
    draw = random.Random(8)
    rows = []
    for n in range(600):
        text = sentence(draw, draw.randrange(5, 120)).split()
        if n % 6 == 0:
            for _ in range(4):
                text.insert(draw.randrange(len(text)), draw.choice(["grubble", "Snorfy", "vlakest", "vlakend", "vlaking"]))
        rows.append((n, " ".join(text), "a"))
    docs = spark.createDataFrame(rows, DOCS)
    labels = docs.selectExpr("doc_id", "cast(doc_id % 6 = 0 as int) as toxic").unionByName(
        spark.createDataFrame([(None, 1), (5, None), (99999, 1), (6, 1)], "doc_id long, toxic int")
    )
    model = toxicity.fit(docs, labels.where(~toxicity.held_out()))
    odd = spark.createDataFrame([(None, "gru-bble you"), (1000, None), (1000, ""), (1001, "x " * 50_000)], "doc_id long, text string")
    scored = toxicity.score(docs.select("doc_id", "text").unionByName(odd).withColumn("score", F.lit("clash")), model).collect()
    assert len(scored) == 604 and all(0 <= r.score <= 1 for r in scored)
    held = [(r.doc_id % 6 == 0, r.predicted) for r in scored if r.doc_id is not None and r.doc_id < 600]
    assert sum(a != b for a, b in held) <= 0.03 * len(held)
    nothing = toxicity.fit(docs, labels.limit(0))
    assert {r.predicted for r in toxicity.score(docs.limit(5), nothing).collect()} == {0}
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_features_read_through_signs():
    weights = {"grubble": 3.0}
    at = toxicity.FEATURES.index
    plain, hidden = (toxicity.features(t, weights) for t in ("you grubble!", "you gr.u-bble"))
    assert plain[at("hits")] == hidden[at("hits")] > 0 and plain[at("near_second_person")] > 0
    assert hidden[at("obfuscated_hits")] > 0 == plain[at("obfuscated_hits")]
