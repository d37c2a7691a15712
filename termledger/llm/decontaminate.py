"""Benchmark decontamination by canonical templates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termledger.llm.common import broadcast_if_small
from termledger.session import StepFolder

#: Words of a window, and the share of an item's windows that a document must hold.
WINDOW = 5
SIMILARITY = 0.8
#: Share of an item's slots that must be filled alike, or by one other value each.
SLOTS = 0.8

#: What ends a sentence if it ends a word; all other marks part words.
ENDS = ".!?:"
# Runs of letters and digits are read whole; ASCII stands first since it is tested fastest.
LETTER = r"a-zA-Z0-9\p{L}\p{N}"
# All from a sign that is no letter or digit to the next letter or digit, but for an end behind a letter or digit.
MARKS = rf"[^{LETTER}](?<![{LETTER}][{ENDS}])[^{LETTER}]*+"
# The units known after a number.
UNITS = (
    "mm cm dm m km in ft yd mi mg g kg t oz lb ml cl dl l s sec second seconds min minute minutes h hour hours day days "
    "week weeks month months year years mph hz khz mhz ghz w kw kwh j kj cal kcal v a c f k pa bar "
    "meter meters metre metres kilometer kilometers mile miles inch inches foot feet gram grams kilogram kilograms "
    "pound pounds liter liters litre litres cent cents dollar dollars euro euros usd eur gbp percent degrees"
).split()
NUM, NAME, UNIT = "<num>", "<name>", "<unit>"
# Signs whose lower case is another one: capitals but for some letter-like symbols, and Roman numerals.
CAPITAL = (
    r"[A-Z\p{Lu}\p{Lt}\x{2160}-\x{216f}&&[^\x{3d2}-\x{3d4}\x{2100}-\x{2125}\x{2127}-\x{2129}"
    r"\x{212c}-\x{2131}\x{2133}-\x{214f}\x{1d400}-\x{1d7ff}]]"
)
# In words that each follow one blank; the sign of Kelvin is a capital k.
_UNITS = "|".join(UNITS).replace("k", r"[k\x{212a}]")
UNIT_AT = rf"( [0-9][^ ]*+) (?i:{_UNITS})(?=[{ENDS}]?(?: |\z))"
NAME_AT = rf" (?<=[^ {ENDS}] )(?![a-z0-9]){CAPITAL}[^ ]*+"
NUM_AT = " [0-9][^ ]*+"
END_AT = rf"[{ENDS}](?= |\z)"
# Between plain words, once all other marks are blanks; the dot of a lower-cased capital I with a dot is no letter.
GAPS = f" {ENDS}\u0307"


def canonical(df: DataFrame, text_col: str, *keep: str) -> DataFrame:
    """The columns to keep, and the words three times: ``raw``, lower-cased,
    ``canon``, with placeholders, and ``plain``, lower-cased and parted by
    whatever is no letter or digit.

    Words are parted by white space and marks, but for a point or colon behind a
    letter or digit, as in 3.5. A word that begins with a digit is a number; a
    known unit behind a number is a unit; a capitalised word that doesn't begin a
    sentence or line is a name.

    All is done on the whole text, by patterns whose first sign is a blank, and
    only the result is split: functions of single words aren't compiled.
    """
    lines = F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit("\n"), F.lit(". "))
    spaced = F.concat(F.lit(" "), F.trim(F.regexp_replace(lines, MARKS, " ")))
    spaced = df.select(*keep, F.col(text_col).alias("_t"), spaced.alias("_s"))

    def words(text: str, gaps: str = " ") -> Column:
        bare = F.trim(F.col(text), F.lit(gaps))
        parted_by = gaps if len(gaps) == 1 else f"[{gaps}]++"
        return F.when(bare != "", F.split(bare, parted_by)).otherwise(F.array().cast("array<string>"))

    canon = F.regexp_replace("_s", UNIT_AT, f"$1 {UNIT}")
    canon = F.regexp_replace(F.regexp_replace(canon, NAME_AT, f" {NAME}"), NUM_AT, f" {NUM}")
    # the lower case of a capital sigma depends on the marks around it
    sigma = F.regexp_replace(F.lower(F.col("_t")), rf"[^{LETTER}]++", " ")
    plain = F.when(F.contains(F.col("_t"), F.lit("\u03a3")), sigma).otherwise(F.lower("_s"))
    forms = spaced.select(
        *keep,
        F.lower(F.regexp_replace("_s", END_AT, "")).alias("_r"),
        F.lower(F.regexp_replace(canon, END_AT, "")).alias("_c"),
        plain.alias("_p"),
    )
    return forms.select(*keep, words("_r").alias("raw"), words("_c").alias("canon"), words("_p", GAPS).alias("plain"))


def windows(canon: Column, *salt: Column) -> Column:
    """Hash of each run of five canonical words; fewer make one window.
    ``canon`` must be a column of the input."""
    runs = F.transform(
        F.sequence(F.lit(0), F.size(canon) - WINDOW),
        lambda i: F.xxhash64(*salt, *[F.get(canon, i + k) for k in range(WINDOW)]),
    )
    return (
        F.when(F.size(canon) >= WINDOW, runs)
        .when(F.size(canon) > 0, F.array(F.xxhash64(*salt, F.concat_ws(" ", canon))))
        .otherwise(F.array().cast("array<bigint>"))
    )


def _held(docs: DataFrame) -> DataFrame:
    """(doc_text, window) of all windows of the columns ``canon`` and ``plain``,
    the same hashes as those of ``windows``.

    The words of both forms stand in one array, and each place of it is a row
    that hashes the five words from there; rows of places beyond a form's last
    window go. So the windows are made in compiled code. The explode is an outer
    one since before another the planner filters by the array's size, which
    would make the words twice.
    """
    def padded(form: str) -> Column:
        nulls = [F.lit(None).cast("string")] * (WINDOW - 1)
        return (
            F.when(F.size(form) >= WINDOW, F.col(form))
            .when(F.size(form) > 0, F.array(F.concat_ws(" ", form), *nulls))
            .otherwise(F.array().cast("array<string>"))
        )

    both = docs.select("doc_text", padded("canon").alias("_c"), padded("plain").alias("_p"))
    both = both.select("doc_text", F.size("_c").alias("_n"), F.concat("_c", "_p").alias("_w"))
    placed = both.select("doc_text", "_n", "_w", F.posexplode_outer("_w").alias("_i", "_first"))
    at, n = F.col("_i"), F.col("_n")
    last = F.when(at < n, n).otherwise(F.size("_w")) - WINDOW
    salt = F.when(at >= n, F.lit("plain"))  # a null leaves the hash as it is
    run = F.xxhash64(salt, "_first", *[F.get("_w", at + k) for k in range(1, WINDOW)])
    return placed.where(at <= last).select("doc_text", run.alias("window"))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    similarity: float = SIMILARITY,
    slots: float = SLOTS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(id, item id, containment, slot_agreement, kind, doc_text) for each document that
    holds ``similarity`` or more of an item's distinct canonical windows, with
    consistent slots, or of its distinct windows of plain words.

    Numbers, names and units become typed placeholders, so a question whose
    numbers or names were changed has the same windows. Its slots must agree:
    each value of the item must always have become the same value of the
    document; ``slot_agreement`` is the share of slots that do. ``kind`` is
    ``exact`` if all values are the same, else ``changed``. Without slots the
    agreement is 1. Slots are read where the windows that cover them match
    (``_aligned``); slots under no matched window are left out.

    What is a name depends on capitals and marks. So the lower-cased words
    without marks have windows of their own; a document that holds enough of
    those holds the item's own words, and its slots agree.

    Windows of documents meet the distinct windows of the benchmark in an
    equality join; only hits go on. Candidate pairs come from each item's rarest
    windows, of which a match must hold one, so a window that many documents or
    items share makes no pairs by itself. Item ids that are null are left out;
    rows that repeat an item's id and text count once. Null and empty texts match
    nothing. Documents are told apart by id and by a digest of the text, so null
    and repeated ids are fine; ``doc_text`` is that digest. Other columns are left out.
    """
    spark = docs.sparkSession
    folder = StepFolder(spark, "decontaminate", keep=True)
    items = benchmark.select(F.col(item_id_col).alias("item"), F.col(item_text_col).alias("text"))
    items = items.where("item is not null").distinct().withColumn("item_text", F.xxhash64("text"))
    items = canonical(items, "text", "item", "item_text")
    items = folder.write(
        items.select("item", "item_text", "raw", "canon", windows(F.col("canon")).alias("at"),
                     windows(F.col("plain"), F.lit("plain")).alias("plain_at"))
    )
    forms = F.create_map(F.lit("canon"), F.array_distinct("at"), F.lit("plain"), F.array_distinct("plain_at"))
    owned = items.select("item", "item_text", F.explode(forms).alias("form", "windows"))
    owned = folder.write(owned.select("item", "item_text", "form", F.explode("windows").alias("window")))
    known = folder.write(owned.select("window").distinct())

    keyed = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("doc_text"))
    hits = _held(canonical(keyed, "text", "doc_text")).join(
        broadcast_if_small(known, known.count()), "window", "left_semi"
    )
    hits = folder.write(hits.distinct())

    # the rarest windows of an item, one more than a match may lack
    often = hits.groupBy("window").agg(F.count(F.lit(1)).alias("often"))
    rarest = Window.partitionBy("item", "item_text", "form").orderBy("often", "window")
    n = F.count(F.lit(1)).over(Window.partitionBy("item", "item_text", "form"))
    ranked = (
        owned.join(often, "window", "left")
        .withColumn("often", F.coalesce("often", F.lit(0)))
        .withColumn("place", F.row_number().over(rarest))
        .withColumn("n", n)
    )
    needed = F.ceil(F.col("n") * similarity - 1e-9)
    signature = ranked.where(F.col("place") <= F.col("n") - needed + 1).select("window", "item", "item_text", "form", "n")
    pairs = hits.join(signature, "window").select("doc_text", "item", "item_text", "form", "n").distinct()
    matched = (
        pairs.join(owned, ["item", "item_text", "form"])
        .join(hits, ["doc_text", "window"])
        .groupBy("doc_text", "item", "item_text", "form")
        .agg((F.count(F.lit(1)) / F.first("n")).alias("containment"))
        .where(F.col("containment") >= similarity - 1e-9)
    )
    matched = folder.write(matched)

    texts = folder.write(matched.select("doc_text").distinct())
    found = keyed.join(broadcast_if_small(texts, texts.count()), "doc_text", "left_semi")
    ids = folder.write(found.select("doc", "doc_text"))
    slotted = found.groupBy("doc_text").agg(F.first("text").alias("text"))
    slotted = canonical(slotted, "text", "doc_text").select(
        "doc_text", F.col("raw").alias("doc_raw"), windows(F.col("canon")).alias("doc_at")
    )
    slotted = folder.write(slotted)
    pairs = matched.where("form = 'canon'").select("doc_text", "item", "item_text", "containment")
    aligned = _aligned(pairs, slotted, items, folder)
    same = F.forall("slots", lambda s: s["a"] == s["b"])
    # a slot agrees if its value became what most slots of that value became
    apart = F.size(F.array_distinct("slots")) - F.size(F.array_distinct(F.transform("slots", lambda s: s["a"])))
    changed = pairs.join(aligned, ["doc_text", "item", "item_text"], "left").select(
        "doc_text", "item", "containment",
        F.when(F.size("slots") > 0, 1 - apart / F.size("slots")).otherwise(1.0).alias("slot_agreement"),
        F.when(F.coalesce(same, F.lit(True)), "exact").otherwise("changed").alias("kind"),
    ).where(F.col("slot_agreement") >= slots)
    own_words = matched.where("form = 'plain'").select(
        "doc_text", "item", "containment", F.lit(1.0).alias("slot_agreement"), F.lit("exact").alias("kind")
    )
    verified = changed.unionByName(own_words)
    verified = verified.groupBy("doc_text", "item").agg(F.max_by(
        F.struct("containment", "slot_agreement", "kind"), F.struct("containment", "slot_agreement", "kind")
    ).alias("best"))
    return ids.join(verified, "doc_text").select(F.col("doc").alias(id_col), F.col("item").alias(item_id_col), "best.*", "doc_text")


def _aligned(pairs: DataFrame, slotted: DataFrame, items: DataFrame, folder: StepFolder) -> DataFrame:
    """(doc_text, item, item_text, slots) per pair and alignment; pairs without
    a slot under a matched window have no row.

    A window may lie at several places of the document. Each distance between
    an item's place and a document's is tried as the base of an alignment: every
    slot is read at the shift, among those of the matched windows that cover it,
    that is nearest to the base; of two as near, once the smaller and once the
    larger one.

    """
    key = ["doc_text", "item", "item_text"]
    wanted = F.col("c").isin(NUM, NAME, UNIT)
    slot = items.select("item", "item_text", "raw", "at", F.posexplode("canon").alias("j", "c")).where(wanted)
    # the windows over a slot; the one window of a short item is over all
    over = F.sequence(F.greatest(F.col("j") - WINDOW + 1, F.lit(0)), F.least("j", F.size("at") - 1))
    slot = slot.select("item", "item_text", "j", F.get("raw", F.col("j")).alias("a"), "at", F.explode(over).alias("i"))
    cover = folder.write(slot.select("item", "item_text", "j", "a", "i", F.get("at", F.col("i")).alias("window")))
    # the words go with each window, so no row holds a whole document
    held = F.transform("doc_at", lambda w, p: F.struct(
        w.alias("window"), p.alias("p"), F.slice("doc_raw", p + 1, WINDOW).alias("words")
    ))
    places = slotted.select("doc_text", F.explode(held).alias("_h")).select("doc_text", "_h.*")
    wide = folder.write(cover.select("window").distinct())
    places = folder.write(places.join(broadcast_if_small(wide, wide.count()), "window", "left_semi"))
    cover = broadcast_if_small(cover, cover.count())
    read = (
        pairs.select(*key).join(cover, ["item", "item_text"]).join(places, ["doc_text", "window"])
        .select(*key, "j", "a", (F.col("p") - F.col("i")).alias("shift"), F.get("words", F.col("j") - F.col("i")).alias("b"))
        .distinct()
    )
    return _nearest(folder.write(read), key)


def _nearest(read: DataFrame, key: list[str]) -> DataFrame:
    """(key, slots) per base and tie, from rows (key, j, a, shift, b): what each
    slot ``j`` of the item, with the value ``a``, reads at a shift.

    The bases and a slot's shifts are sorted together, and one sweep in each
    direction gives every base its neighbours, so a pair costs its places times
    the slots of the item, however often a window repeats.
    """
    slots = read.select(*key, "j", "a").distinct()
    bases = read.select(*key, F.col("shift").alias("at")).distinct().join(slots, key)
    known = F.struct("shift", "b").alias("known")
    points = read.select(*key, "j", "a", F.col("shift").alias("at"), known, F.lit(False).alias("asked"))
    points = points.unionByName(bases.withColumns({"known": F.lit(None), "asked": F.lit(True)}))
    sweep = Window.partitionBy(*key, "j").rowsBetween(Window.unboundedPreceding, 0)
    points = points.withColumn("below", F.last("known", True).over(sweep.orderBy("at", "asked")))
    points = points.withColumn("above", F.last("known", True).over(sweep.orderBy(F.desc("at"), "asked")))
    down, up = F.col("at") - F.col("below.shift"), F.col("above.shift") - F.col("at")
    nearest = lambda closer: F.when(F.coalesce(closer, up.isNull()), F.col("below.b")).otherwise(F.col("above.b"))
    return (
        points.where("asked")
        .select(*key, "at", "a", F.explode(F.create_map(F.lit(0), nearest(down <= up), F.lit(1), nearest(down < up))).alias("tie", "b"))
        .groupBy(*key, "at", "tie")
        .agg(F.collect_list(F.struct("a", "b")).alias("slots"))
        .drop("at", "tie")
    )
