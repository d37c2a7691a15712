"""Plain nested-loop versions against the operators, on what a cut would lose."""

from __future__ import annotations

import itertools
import random
import re
import unicodedata

import xxhash
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from termledger.llm import decontaminate, licenses, url_rules

ROWS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(draw, n):
    return " ".join(draw.choice("abcdefghij") + str(draw.randrange(400)) for _ in range(n))


def classes(nodes, pairs):
    """Smallest node reachable, for every node."""
    root = {n: n for n in nodes}
    for _ in nodes:
        before = dict(root)
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
        if root == before:
            return root
    return root


def prints(text):
    """The fingerprint by its definition: three words, XXH64 with seed 42."""
    words = (text or "").lower().split()
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates_stage_by_nested_loops(spark, tiny):
    """Links of two bits at most between all rows; of each component the
    smallest id stays, rows without an id last, a repeated row once."""
    draw = random.Random(12)
    rows = []
    for n in range(40):
        words = sentence(draw, draw.randrange(150, 400)).split()
        rows.append((n, " ".join(words)))
        for k in range(draw.randrange(4)):
            words = list(words)
            words[draw.randrange(len(words))] = "changed"
            rows.append((draw.choice([None, 100 * n + k, 7]), " ".join(words)))
    rows += [(6, None), (None, None), (5, " "), (4, "one"), (4, "one"), (None, "two words"), (None, "two words")]
    fps = [prints(text) for _, text in rows]
    near = [(a, b) for a in range(len(rows)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 2]
    group = classes(list(range(len(rows))), near)
    order = lambda n: (rows[n][0] is None, rows[n][0] or 0)
    expected = {}
    for n in sorted(range(len(rows)), key=order):
        expected.setdefault(group[n], []).append(n)
    docs = spark.createDataFrame([(a, b, "en", "s", 0) for a, b in rows], ROWS)
    out = [(r.doc_id, r.text) for r in pipeline.near_duplicates(spark, docs, tiny).collect()]
    assert len(out) == len(expected) < len(rows)
    for members in expected.values():
        kept = [rows[n] for n in members if rows[n] in out]
        assert kept and order(members[0]) == min((kept[0][0] is None, kept[0][0] or 0) for _ in kept)


WORDS = "item_id long, text string"


def question(draw, n=50):
    """An item whose names and numbers repeat."""
    words = [draw.choice("abcdefghij") + "xyzuv"[k % 5] + str(draw.randrange(9)) for k in range(n)]
    words[0] = "Say"
    for k in range(3, n - 1, 4):
        words[k] = draw.choice(["Paris", "Anna", "Otto", "7", "12"])
    return words


def found(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), WORDS)
    return {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs, bench).collect()}


def test_slots_after_an_inserted_or_deleted_word(spark):
    """Each place of insertion and deletion, with other names and numbers."""
    draw = random.Random(21)
    words = question(draw)
    other = {"Paris": "Rome", "Anna": "Berta", "Otto": "Karl", "7": "31", "12": "55"}
    changed = [other.get(w, w) for w in words]
    texts = [" ".join(changed[:k] + ["inserted"] + changed[k:]) for k in range(1, 50)]
    texts += [" ".join(changed[:k] + changed[k + 1 :]) for k in range(1, 49)]
    # an earlier instance of the template, filled at random
    loose = " ".join(draw.choice("BCDEF") + "ob" if w in ("Paris", "Anna", "Otto") else str(draw.randrange(99)) if w in other else w for w in words)
    texts += [loose, f"{loose}. {' '.join(changed)}"]
    out = found(spark, texts, [" ".join(words)])
    assert {d for d, _ in out} == set(range(len(texts))) - {len(texts) - 2}
    assert {r.kind for r in out.values()} == {"changed"}


def test_own_words_whatever_the_marks_and_capitals(spark):
    """Against nested loops over the plain words of every document and item."""
    draw = random.Random(22)
    items = []
    for n in (5, 6, 8, 20, 50):
        words = question(draw, n)
        items.append(" ".join(w + ("," if k % 7 == 3 else "." if k % 9 == 8 else "") for k, w in enumerate(words)) + "?")
    items.append("What is 3 plus 5?")
    texts = []
    for item in items:
        bare = re.sub(r"[.,?]", "", item)
        texts += [item, bare, item.upper(), item.lower(), f"Question {item}", f'he said "{bare}" and (more', f"({item}) It"]
        texts.append(" ".join(bare.split()[:-3] + ["else", "and", "other"]))
    texts.append(sentence(draw, 80))

    def plain(text):
        words = re.findall(r"[a-z0-9]+", text.lower())
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    expected = {
        (d, i) for d, text in enumerate(texts) for i, item in enumerate(items)
        if len(plain(text) & plain(item)) >= 0.8 * len(plain(item)) - 1e-9
    }
    out = found(spark, texts, items)
    assert expected <= set(out) and len(expected) >= 7 * len(items)
    assert not any(d == len(texts) - 1 for d, _ in out)


def test_nearest_shifts_by_nested_loops(spark):
    """Every base against every read of every slot."""
    draw = random.Random(3)
    read = sorted({(draw.choice("xy"), j, f"a{j % 3}", draw.randrange(-30, 60)) for _ in range(120) for j in [draw.randrange(5)]})
    read = [(*r, f"b{(r[3] * 7 + r[1]) % 5}") for r in read]
    expected = []
    for pair in "xy":
        own = [r for r in read if r[0] == pair]
        for base in {r[3] for r in own}:
            for sign in (1, -1):
                slots = []
                for j in {r[1] for r in own}:
                    best = min((r for r in own if r[1] == j), key=lambda r: (abs(r[3] - base), sign * r[3]))
                    slots.append((best[2], best[4]))
                expected.append((pair, sorted(slots)))
    frame = spark.createDataFrame(read, "pair string, j int, a string, shift int, b string").repartition(3)
    found = [(r.pair, sorted((s.a, s.b) for s in r.slots)) for r in decontaminate._nearest(frame, ["pair"]).collect()]
    assert sorted(found) == sorted(expected)


def test_placeholders_word_by_word(spark):
    """Words, placeholders and windows against loops over the words; windows are
    made in compiled code."""
    draw = random.Random(23)
    signs = list("aAbZ09 .!?:,;-\n\t()'\u00e9\u00c9\u00df\u0130\u01c5\u2162\u4e2d\u212a\u0301$\\")
    signs += [" km", " KM", "5 km", " Kg.", " The", " 3.5", " and ", "..", ". ", " 5 Km", " mm", " x y z"]
    texts = ["".join(draw.choice(signs) for _ in range(draw.randrange(70))) for _ in range(3000)]
    texts += ["", " ", "...", "one", "Only three Words", "\u039f\u03a3'\u0391 \u039f\u03a3. b", None]
    letter = lambda c: unicodedata.category(c)[0] in "LN"

    def forms(text):
        lines = (text or "").replace("\n", ". ")
        spaced = "".join(
            c if letter(c) or c in ".!?:" and k and letter(lines[k - 1]) else " " for k, c in enumerate(lines)
        )
        words = [w for w in spaced.split(" ") if w]
        bare = [w.rstrip(".!?:") for w in words]
        canon = []
        for k, b in enumerate(bare):
            if "0" <= b[0] <= "9":
                canon.append("<num>")
            elif k and "0" <= bare[k - 1][0] <= "9" and b.lower() in decontaminate.UNITS:
                canon.append("<unit>")
            elif b[0].lower() != b[0] and k and words[k - 1][-1] not in ".!?:":
                canon.append("<name>")
            else:
                canon.append(b.lower())
        plain = "".join(c if letter(c) else " " for c in (text or "").lower()).split()
        return [b.lower() for b in bare], canon, plain

    docs = spark.createDataFrame(list(enumerate(texts)), "doc_text long, text string").repartition(3)
    split = decontaminate.canonical(docs, "text", "doc_text")
    got = {r.doc_text: (r.raw, r.canon, r.plain) for r in split.collect()}
    assert got == {k: forms(t) for k, t in enumerate(texts)}

    held = decontaminate._held(split)
    plain = decontaminate.windows(F.col("plain"), F.lit("plain"))
    want = split.select("doc_text", F.explode(F.concat(decontaminate.windows(F.col("canon")), plain)).alias("window"))
    assert sorted(map(tuple, held.collect())) == sorted(map(tuple, want.collect()))
    planned = held._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in planned and planned.count("regexp_replace") == 6  # each pattern runs once


def test_a_long_document_of_numbers(spark):
    """Its windows repeat at every place; the table of numbers holds the item's template."""
    item = "Sum " + " ".join(str(n) for n in range(1, 13))
    text = "Sum " + " ".join(str(n) for n in range(1, 30_000))
    other = "Sum " + " ".join("7" for _ in range(3_000))
    out = found(spark, [text, other, "Nothing of the kind"], [item])
    assert set(out) == {(0, 0), (1, 0)} or set(out) == {(0, 0)}
    assert out[0, 0].kind == "exact" and out[0, 0].slot_agreement == 1.0


def test_stages_tell_rows_apart_by_id_and_text(spark, tiny):
    """A third of the rows lacks an id; ids repeat with different texts."""
    draw = random.Random(31)
    item = pipeline.load(spark, tiny, "benchmark").first().text
    rows = [(None if n % 3 == 0 else n // 2, sentence(draw, draw.randrange(20, 90)), "en", f"s{n % 3}", n) for n in range(150)]
    leaks = [(None, f"Before.\n{item}", "en", "s0", 0), (2, f"{item}\nafter", "en", "s1", 0)]
    docs = spark.createDataFrame(rows + leaks, ROWS)
    kept = pipeline.decontaminated(spark, docs, tiny).collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, rows))

    rows += [rows[0]] * 4
    docs = spark.createDataFrame(rows, ROWS)
    out = pipeline.mixed(spark, docs, tiny).collect()
    size = lambda r: len(r[1].split())
    total = sum(map(size, rows))
    targets = {r.source: r.target for r in pipeline.mixing.mix(docs, pipeline.MIX_WEIGHTS).collect()}
    for source, target in targets.items():
        taken = sum(size(r) for r in out if r.source == source)
        assert abs(taken - target) <= 45, (source, taken, target, total)
    times = {}
    for r in out:
        times[tuple(r)] = times.get(tuple(r), 0) + 1
    assert all(n <= 2 * rows.count(r) for r, n in times.items())


def test_url_rules_see_the_whole_url(spark):
    """Deep segments, inner host labels and keys; the rules by nested loops."""
    draw, rows = random.Random(41), []
    for n in range(400):
        bad, host = n % 2, f"h{n}"
        kind = n % 3
        label = f"{'pills' if bad and kind == 0 else 'shop' if kind == 0 else 'plain'}"
        step = "buy" if bad and kind == 1 else "read"
        key = "aff" if bad and kind == 2 else "lang"
        url = f"https://{draw.choice(['www', 'm', 'x', 'y'])}.{label}.{host}.com/a/b/{step}/{n}/{'/'.join(f's{k}' for k in range(25))}?{key}=1&id={n}"
        rows.append((n, url, "block" if bad else "allow"))
    pages = spark.createDataFrame(rows, "page_id long, url string, label string")
    labels = pages.where("page_id < 300").select("url", "label")
    out = url_rules.judge(pages, [], labels, min_support=0.02).collect()
    assert {r.page_id: r.verdict for r in out} == {n: v for n, _, v in rows}

    # by nested loops over all combinations, of tokens that always stand together one
    baskets = [(set(url_rules.tokens(u)), v) for _, u, v in rows[:60]]
    frame = spark.createDataFrame([(sorted(t), v) for t, v in baskets], "tokens array<string>, label string")
    standing = {}
    for t in sorted({t for b, _ in baskets for t in b}):
        standing.setdefault(tuple(t in b for b, _ in baskets), t)
    singles = [t for at, t in standing.items() if sum(at) >= 6]
    assert 8 < len(singles) < 14
    sure = {}
    for k in range(1, len(singles) + 1):
        for c in itertools.combinations(sorted(singles), k):
            labels = [v for b, v in baskets if b.issuperset(c)]
            for v in set(labels):
                n, surety = labels.count(v), labels.count(v) / len(labels)
                if n >= 6 and surety >= 0.9 and not any(
                    s >= surety and w == v and set(part) < set(c) for (part, w), s in sure.items()
                ):
                    sure[c, v] = surety
    mined = url_rules.mine(frame, min_support=0.1)
    assert {(r.tokens, r.verdict): r.confidence for r in mined} == sure
    assert any(len(tokens) > 1 for tokens, _ in sure)


def plain_words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def test_license_scan_by_nested_loops(spark):
    """Every window of every text against every template of its class."""
    draw = random.Random(17)
    templates = {k: v for k, v in licenses.TEMPLATES.items() if k in ("mit", "gpl-3.0", "bsd-2-clause", "mit-short", "apache-2.0-short")}
    templates["odd"] = "A Licence of seven words, no more"
    rows = [(900, None), (901, ""), (902, "four words are short"), (903, sentence(draw, 2000))]
    for n in range(60):
        own = draw.choice(list(templates.values())).split()
        long = len(own) > 20  # a change in a short one leaves too little of it
        for _ in range(draw.randrange(0, 6) * long):
            at = draw.randrange(len(own))
            own[at : at + draw.randrange(2)] = draw.choice([["inserted"], ["other"], []])
        cut = own[draw.randrange(0, 4) * long : len(own) - draw.randrange(0, 9) * long]
        rows.append((n, " ".join([sentence(draw, draw.randrange(1, 150)), *cut, sentence(draw, draw.randrange(1, 150))])))
    shingled = lambda w: [tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] * bool(w)
    known = {name: dict.fromkeys(shingled(plain_words(t))) for name, t in templates.items()}
    expected = set()
    for n, text in rows:
        h = shingled(plain_words(text))
        for name, s in known.items():
            w = 1 << (len(s) - 1).bit_length()
            step, best = max(1, w // 4), None
            for start in range(0, max(0, len(h) - 1 - step) + 1, step):
                window = h[start : start + w + step]
                share = len(set(window) & set(s)) / len(s)
                held = [k for k, x in enumerate(window) if x in s]
                if share >= 0.8:
                    key = (share, -start, -held[-1])
                    best = max(best, (key, start + held[0], start + held[-1] + 4)) if best else (key, start + held[0], start + held[-1] + 4)
            if best:
                expected.add((n, name, round(best[0][0], 12), best[1], best[2]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = licenses.scan(docs, templates).collect()
    assert {(r.doc_id, r.template, round(r.containment, 12), r.first_word, r.last_word) for r in out} == expected
    assert len(expected) > 15 and len({name for _, name, *_ in expected}) >= 4
