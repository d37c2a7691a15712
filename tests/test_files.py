"""Readers and writers on hand-written bytes."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from termledger import schemas as S
from termledger.operators import history
from termledger.operators import relational as rel
from termledger.sources.readers import LINE, read_delimited, read_rf2, scan_delimited, scan_rf2
from termledger.sources.writers import materialize, replace_release, to_rf2, write_rf2


def lines(path, rows, sep="\t"):
    path.write_bytes("".join(sep.join(row) + "\r\n" for row in rows).encode())
    return str(path)


MAP_HEADER = ["id", "effectiveTime", "active", "moduleId", "refsetId", "referencedComponentId", "mapTarget"]


def map_file(path, *targets):
    return lines(
        path,
        [MAP_HEADER]
        + [[f"m{n}", "20180801", "1", "21000210109", "41", str(n), t] for n, t in enumerate(targets)],
    )


def test_rf2_text_survives(spark, tmp_path):
    targets = ["A\rB", 'say "hi"', "back\\slash", "café", "", "'single'", '"', "X76Hb11  "]
    rows = read_rf2(spark, map_file(tmp_path / "m.txt", *targets), S.SIMPLE_MAP_SNAPSHOT)
    found = [r.map_target for r in rows.orderBy("referenced_component_id").collect()]
    assert found == targets
    assert rows.dtypes[1] == ("effective_time", "date") and rows.dtypes[3] == ("module_id", "bigint")


def test_zero_date_is_null_and_long_ids_are_exact(spark, tmp_path):
    path = lines(
        tmp_path / "c.txt",
        [["id", "effectiveTime", "active", "moduleId", "definitionStatusId"]]
        + [["900000000000207008", "00000000", "1", "900000000000012004", "900000000000073002"]],
    )
    (row,) = read_rf2(spark, path, S.CONCEPT_SNAPSHOT).collect()
    assert tuple(row) == (900000000000207008, None, 1, 900000000000012004, 900000000000073002)


def test_code_columns_lose_padding_and_keep_case(spark, tmp_path):
    path = lines(tmp_path / "p.txt", [["c", "r", "t"], ["1", "R102 ", "00"], ["2", "r102 ", "00"]])
    rows = read_rf2(spark, path, S.PREPARED_MAP)
    assert {r.read_code for r in rows.collect()} == {"R102", "r102"}


def test_columns_are_bound_by_position_then_picked(spark, tmp_path):
    path = lines(
        tmp_path / "f.txt",
        [["a", "b", "c", "d", "e", "f"], ["X76Hb", "11", "term", "friendly", "5", "51"]],
    )
    rows = read_rf2(
        spark, path, S.PATIENT_FRIENDLY_TERMS, columns=["description_id", "concept_id"]
    )
    assert rows.columns == ["description_id", "concept_id"]
    assert tuple(rows.collect()[0]) == (51, 5)


def test_comma_files(spark, tmp_path):
    legacy = '"term, key",1,,"a ""quoted"" term",,00,EN,R102.,0\r\nk,2,t30,,,00,EN,r102.,0\r\n'
    (tmp_path / "keys").write_bytes(legacy.encode())
    rows = read_delimited(spark, str(tmp_path / "keys"), S.LEGACY_TERMS).orderBy("uniquifier").collect()
    assert [r.term_key for r in rows] == ["term, key", "k"]
    assert [r.term_60 for r in rows] == ['a "quoted" term', ""]
    assert [r.read_code for r in rows] == ["R102.", "r102."]
    medicines = 'mp,term,date,d,c,fsn\r\n1,"metformin, tablet",20190101,2,3,Product (medicinal product)\r\n'
    (tmp_path / "m.csv").write_bytes(medicines.encode())
    (row,) = read_delimited(spark, str(tmp_path / "m.csv"), S.MEDICINES_MAP, header=True).collect()
    assert (row.mp_id, row.mp_term, row.effective_date) == (1, "metformin, tablet", dt.date(2019, 1, 1))


def extract(path, *rows):
    header = ["id", "effectiveTime", "active", "moduleId", "refsetId", "referencedComponentId"]
    return lines(path, [header] + [[m, "20190101", "1", "1", str(r), str(c)] for m, r, c in rows])


def test_extracts_skip_repeated_keys_in_file_order(spark, tmp_path):
    # The second file is read first although its name sorts last.
    first = extract(tmp_path / "z.txt", ("a", 1, 10), ("b", 1, 11), ("a", 1, 12))
    second = extract(tmp_path / "a.txt", ("c", 1, 11), ("d", 2, 11), ("c", 3, 13))
    rows = read_rf2(spark, [first, second], S.REFSET_EXTRACT, with_line=True)
    kept = rel.load_unique(rows, [["member_id"], ["refset_id", "concept_id"]], LINE)
    found = {(r.member_id, r.refset_id, r.concept_id) for r in kept.collect()}
    # (c, 1, 11) repeats a pair and is skipped, so the later c is kept.
    assert found == {("a", 1, 10), ("b", 1, 11), ("d", 2, 11), ("c", 3, 13)}


def test_line_order_holds_across_blocks(spark, tmp_path):
    path = extract(tmp_path / "big.txt", *[(f"{n:06d}", 1, n) for n in range(20_000)])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 * 1024))
    try:
        rows = read_rf2(spark, [path], S.REFSET_EXTRACT, with_line=True)
        assert rows.rdd.getNumPartitions() > 1
        ordered = [r.member_id for r in rows.orderBy(LINE).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert ordered == sorted(ordered) and len(ordered) == 20_000


def joined(path) -> bytes:
    """The files of a printed table in name order; Hadoop's checksums are hidden."""
    return b"".join(p.read_bytes() for p in sorted(path.iterdir()) if not p.name.startswith("."))


@pytest.fixture()
def members(spark):
    rows = [
        ("b", dt.date(2018, 8, 1), 1, 21000210109, 41, 368009, 'say "hi"'),
        ("b", dt.date(2018, 11, 1), 0, 21000210109, 41, 368009, 'say "hi"'),
        ("a", dt.date(2018, 8, 1), 1, 900000000000207008, 41, 1376001, " back\\slash "),
        ("c", dt.date(2018, 8, 1), 1, 21000210109, 42, 5, ""),
    ]
    return spark.createDataFrame(rows, S.SIMPLE_MAP.schema)


def test_written_bytes(members, tmp_path):
    path = tmp_path / "out" / "map.txt"
    assert write_rf2(members, str(path), S.SIMPLE_MAP) == 4
    assert joined(path) == (
        b"id\teffectiveTime\tactive\tmoduleId\trefsetId\treferencedComponentId\tmapTarget\r\n"
        b"a\t20180801\t1\t900000000000207008\t41\t1376001\t back\\slash \r\n"
        b'b\t20180801\t1\t21000210109\t41\t368009\tsay "hi"\r\n'
        b'b\t20181101\t0\t21000210109\t41\t368009\tsay "hi"\r\n'
        b"c\t20180801\t1\t21000210109\t42\t5\t\r\n"
    )


def test_odd_characters_are_printed_as_they_are(spark, tmp_path):
    values = ["A\rB", "#c", "'q'", '"', "é", "\\N", " x "]
    rows = [(str(n), dt.date(2018, 8, 1), 1, 1, 1, 1, v) for n, v in enumerate(values)]
    path = tmp_path / "odd.txt"
    write_rf2(spark.createDataFrame(rows, S.SIMPLE_MAP.schema), str(path), S.SIMPLE_MAP)
    lines = joined(path).decode().split("\r\n")[1:-1]
    assert [line.split("\t")[-1] for line in lines] == values
    back = read_rf2(spark, str(path), S.SIMPLE_MAP.schema).orderBy("member_id").collect()
    assert [r.map_target for r in back] == values


def test_missing_values_are_empty_fields(spark, tmp_path):
    schema = S.StructType([S.StructField(f.name, f.dataType, True) for f in S.SIMPLE_MAP.schema])
    path = tmp_path / "null.txt"
    write_rf2(spark.createDataFrame([("a", None, 1, 1, 1, 1, None)], schema), str(path), S.SIMPLE_MAP)
    assert joined(path).endswith(b"\r\na\t\t1\t1\t1\t1\t\r\n")


def test_round_trip_and_rewrite(spark, members, tmp_path):
    path = str(tmp_path / "map.txt")
    write_rf2(members, path, S.SIMPLE_MAP)
    write_rf2(members, path, S.SIMPLE_MAP)
    assert [p.name for p in tmp_path.iterdir()] == ["map.txt"]
    back = read_rf2(spark, path, S.SIMPLE_MAP.schema)
    assert back.exceptAll(members).count() == 0 and members.exceptAll(back).count() == 0


def test_empty_table_has_its_header(spark, members, tmp_path):
    path = tmp_path / "empty.txt"
    write_rf2(members.where("active = 7"), str(path), S.SIMPLE_MAP)
    assert joined(path) == b"\t".join(h.encode() for h in S.SIMPLE_MAP.header) + b"\r\n"
    assert read_rf2(spark, str(path), S.SIMPLE_MAP.schema).count() == 0


def test_large_table_is_ordered_parts(spark, tmp_path):
    rows = spark.range(1000).select(
        F.format_string("%05d", F.col("id") * 7919 % 1000).alias("member_id"),
        F.lit(dt.date(2018, 8, 1)).alias("effective_date"),
        F.lit(1).alias("active"),
        F.lit(1).cast("bigint").alias("module_id"),
        F.lit(1).cast("bigint").alias("refset_id"),
        F.col("id").alias("concept_id"),
    )
    path = tmp_path / "refset.txt"
    assert write_rf2(rows, str(path), S.SIMPLE_REFSET, rows_per_file=30) == 1000
    assert sum(p.name.startswith("part-") for p in path.iterdir()) > 30
    header, *lines = joined(path).split(b"\r\n")[:-1]
    assert header == b"\t".join(h.encode() for h in S.SIMPLE_REFSET.header)
    found = [line.split(b"\t")[0] for line in lines]
    assert found == sorted(found) and len(found) == 1000
    one = tmp_path / "one.txt"
    write_rf2(rows, str(one), S.SIMPLE_REFSET)
    assert joined(one) == joined(path)
    assert read_rf2(spark, str(path), S.SIMPLE_REFSET.schema).exceptAll(rows).count() == 0


def test_plain_files_and_printed_folders_are_read_together(spark, members, tmp_path):
    write_rf2(members.where("member_id = 'b'"), str(tmp_path / "printed.txt"), S.SIMPLE_MAP)
    plain = lines(tmp_path / "plain.txt", [MAP_HEADER, ["x", "20180801", "1", "1", "41", "5", "A"]])
    paths = [str(tmp_path / "printed.txt"), plain]
    for with_line in (False, True):
        found = read_rf2(spark, paths, S.SIMPLE_MAP.schema, with_line=with_line).collect()
        assert sorted(r.member_id for r in found) == ["b", "b", "x"]


def test_a_failed_print_keeps_the_release(spark, members, tmp_path):
    path = tmp_path / "map.txt"
    write_rf2(members, str(path), S.SIMPLE_MAP)
    before = joined(path)
    with pytest.raises(Exception):
        write_rf2(members.withColumn("map_target", F.raise_error(F.lit("x"))), str(path), S.SIMPLE_MAP)
    assert joined(path) == before


def test_export_of_every_component(spark):
    for component in S.COMPONENTS:
        assert len(component.header) == len(component.schema.fields)
        printed = to_rf2(spark.createDataFrame([], component.schema), component)
        assert tuple(printed.columns) == component.header


def test_release_partition_is_replaced_not_repeated(spark, members, tmp_path):
    path = str(tmp_path / "full")
    full = materialize(members, path, ["effective_date"])
    rows = members.limit(1).withColumn("effective_date", F.lit(dt.date(2019, 2, 1)))
    for _ in range(2):
        replace_release(rows, path, "effective_date")
    full = spark.read.schema(members.schema).parquet(path).select(members.columns)
    assert full.count() == 5
    new = history.delta(full, dt.date(2019, 2, 1))
    assert new.count() == 1
    plan = new._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(effective_date" in plan


def test_a_history_load_loses_no_line(spark, tmp_path):
    from termledger.plans import release

    rows = [
        ["m1", "20180801", "1", "1", "41", "5", "A"],
        ["m2", "00000000", "1", "1", "41", "6", "B"],
        ["m3", "2018-8-1x", "1", "1", "41", "7", "C"],
        ["m4", "20300101", "1", "1", "41", "8", "D"],
        ["m5", "20181101", "1", "1", "41", "9", "E"],
    ]
    path = lines(tmp_path / "map.txt", [MAP_HEADER, *rows])
    stages = release.Stages(spark, str(tmp_path / "stages"))
    history = release._load_history(stages, S.SIMPLE_MAP, path, dt.date(2018, 11, 1))
    rejects = stages[f"{S.SIMPLE_MAP.name}_rejects"]
    assert {r.member_id for r in history.collect()} == {"m1", "m5"}
    assert sorted(tuple(r)[1:] for r in rejects.collect()) == [
        (3, "effective_date", "\t".join(rows[1])),
        (4, "effective_date", "\t".join(rows[2])),
        (5, "effective_date", "\t".join(rows[3])),
    ]
    with pytest.raises(ValueError, match="rejects"):
        release._refuse_rejects(stages, S.SIMPLE_MAP)


def test_a_history_without_a_good_line(spark, tmp_path):
    from termledger.plans import release

    stages = release.Stages(spark, str(tmp_path / "stages"))
    for rows, rejects in (([BAD[0], BAD[2]], 2), ([], 0)):
        path = lines(tmp_path / f"{rejects}.txt", [MAP_HEADER, *rows])
        release._load_history(stages, S.SIMPLE_MAP, path, dt.date(2018, 11, 1))
        assert stages[S.SIMPLE_MAP.name].count() == 0 and stages[f"{S.SIMPLE_MAP.name}_rejects"].count() == rejects


GOOD = ["m1", "20180801", "1", "1", "41", "5", "A"]
BAD = [
    ["short", "20180801", "1"],
    [*GOOD, "one", "two"],
    ["typed", "20180801", "1", "x9", "41", "5", "A"],
    ["dated", "20181399", "1", "1", "41", "5", "A"],
    ["both", "2018-08-01", "yes", "1", "41", "5", 'a "quote"'],
]


def rejects_of(scanned):
    return sorted(tuple(r)[1:] for r in scanned.rejects.collect())


def test_every_line_is_a_row_or_a_reject(spark, tmp_path):
    given = [GOOD, BAD[0], BAD[1], GOOD, BAD[2], ["m0", "00000000", "", "1", "41", "5", ""], BAD[3], BAD[4]]
    scanned = scan_rf2(spark, lines(tmp_path / "with space.txt", [MAP_HEADER, *given]), S.SIMPLE_MAP_SNAPSHOT)
    assert [r.id for r in scanned.rows.collect()] == ["m1", "m1", "m0"]
    reasons = {3: "fields", 4: "fields", 6: "module_id", 8: "effective_time", 9: "effective_time, active"}
    assert rejects_of(scanned) == [(n, reason, "\t".join(given[n - 2])) for n, reason in reasons.items()]
    assert scanned.rows.count() + scanned.rejects.count() == len(given)
    picked = scan_rf2(spark, str(tmp_path / "with space.txt"), S.SIMPLE_MAP_SNAPSHOT, columns=["map_target"])
    assert [r.map_target for r in picked.rows.collect()] == ["A", "A", ""] and rejects_of(picked) == rejects_of(scanned)


def test_a_bad_line_ends_a_plain_read(spark, tmp_path):
    for n, bad in enumerate(BAD):
        path = lines(tmp_path / f"{n}.txt", [MAP_HEADER, GOOD, bad])
        with pytest.raises(Exception, match="unreadable line"):
            read_rf2(spark, path, S.SIMPLE_MAP_SNAPSHOT).collect()
        with pytest.raises(Exception, match="unreadable line"):
            read_rf2(spark, path, S.SIMPLE_MAP_SNAPSHOT, columns=["id"]).count()


def test_rejects_of_comma_files(spark, tmp_path):
    text = 'mp,term,date,d,c,fsn\r\n1,"a, b",20190101,2,3,x\r\nz,"c, d",20190101,2,3,x\r\n5,6\r\n'
    (tmp_path / "m.csv").write_bytes(text.encode())
    scanned = scan_delimited(spark, str(tmp_path / "m.csv"), S.MEDICINES_MAP, header=True)
    assert [r.mp_term for r in scanned.rows.collect()] == ["a, b"]
    assert rejects_of(scanned) == [(3, "mp_id", 'z,"c, d",20190101,2,3,x'), (4, "fields", "5,6")]


def test_rejects_are_numbered_across_blocks_and_files(spark, tmp_path):
    paths, expected = [], []
    for k in range(3):
        rows = [(f"{n:06d}", 1, "x" if n % 4999 == 7 else n) for n in range(12_000)]
        paths.append(extract(tmp_path / f"e{k}.txt", *rows))
        expected += [(f"e{k}.txt", n + 2, "concept_id") for n in range(12_000) if n % 4999 == 7]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 * 1024))
    try:
        scanned = scan_rf2(spark, paths, S.REFSET_EXTRACT, with_line=True)
        found = sorted((r.file.rsplit("/", 1)[1], r.line, r.reason) for r in scanned.rejects.collect())
        ordered = [r.member_id for r in scanned.rows.orderBy(LINE).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert found == sorted(expected)
    assert ordered == [f"{n:06d}" for n in range(12_000) if n % 4999 != 7] * 3


def test_many_extracts_are_one_scan(spark, tmp_path):
    """The order is that of the list, whatever the names; folders count as one path."""
    paths = [extract(tmp_path / f"f{(k * 8) % 21:02d}.txt", (f"m{k}", k, k)) for k in range(21)]
    rows = read_rf2(spark, paths, S.REFSET_EXTRACT, with_line=True)
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert [r.member_id for r in rows.orderBy(LINE).collect()] == [f"m{k}" for k in range(21)]
    (tmp_path / "z").mkdir()
    inside = [extract(tmp_path / "z" / f"{k}.txt", (f"z{k}", 50 + k, k)) for k in range(2)]
    assert len(inside) == 2
    rows = read_rf2(spark, [str(tmp_path / "z"), *paths[:2]], S.REFSET_EXTRACT, with_line=True)
    assert [r.member_id for r in rows.orderBy(LINE).collect()] == ["z0", "z1", "m0", "m1"]
    with pytest.raises(ValueError, match="once"):
        read_rf2(spark, paths[:1] * 2, S.REFSET_EXTRACT, with_line=True)


def test_a_good_load_reads_once(spark, tmp_path):
    from termledger.plans import release

    stages = release.Stages(spark, str(tmp_path / "stages"))
    good, bad = (lines(tmp_path / f"{n}.txt", [MAP_HEADER, GOOD, *extra]) for n, extra in (("good", []), ("bad", BAD)))
    read = []
    scanned = scan_rf2(spark, good, S.SIMPLE_MAP_SNAPSHOT)
    monitored = scanned.parsed
    spark.sparkContext.setJobGroup("good-load", "")
    try:
        stages.load("m", scanned)
        read.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup("good-load")))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert read == [1] and monitored.count() == 1
    assert stages["m"].count() == 1 and stages["m_rejects"].isEmpty()
    stages.load("m", scan_rf2(spark, bad, S.SIMPLE_MAP_SNAPSHOT))
    assert stages["m"].count() == 1 and stages["m_rejects"].count() == len(BAD)
    stages.load("m", scan_rf2(spark, good, S.SIMPLE_MAP_SNAPSHOT))
    assert not (tmp_path / "stages" / "m_rejects").exists()


def rows_scanned(df) -> int:
    """Rows that the scans of a plan gave, after it has run."""
    execution = df._jdf.queryExecution()
    df_rows = execution.executedPlan().executeCollect()
    leaves = execution.executedPlan().collectLeaves()
    assert df_rows is not None
    return sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.size()))


def test_lookups_read_few_rows(spark, tmp_path):
    """Two sorted copies of a closure, and a history sorted within its dates."""
    from termledger.operators import closure

    pairs = spark.range(200_000).select(
        (F.col("id") * 7919 % 4000).alias("sub_concept_id"), (F.col("id") * 104729 % 5003).alias("super_concept_id")
    )
    up = materialize(pairs, str(tmp_path / "by_sub"), sort_by=["sub_concept_id", "super_concept_id"])
    down = materialize(pairs, str(tmp_path / "by_super"), sort_by=["super_concept_id", "sub_concept_id"])
    assert up.count() == down.count() == 200_000
    for found in (closure.ancestors(up, 77), closure.descendants(down, 77)):
        assert 30 < found.count() < 60 and rows_scanned(found) <= 3 * 2_000
    full = spark.range(60_000).select(
        F.concat(F.lit("m"), F.col("id") % 20_000).alias("member_id"),
        F.date_add(F.lit(dt.date(2018, 1, 1)), (F.col("id") / 20_000).cast("int")).alias("effective_date"),
        (F.col("id") * 7 % 20_000).alias("concept_id"),
    )
    stored = materialize(full, str(tmp_path / "full"), ["effective_date"], ["concept_id"])
    versions = history.component_history(stored, ["effective_date"], concept_id=5)
    assert versions.count() == 3
    assert rows_scanned(stored.where("concept_id = 5")) <= 3 * 2 * 2_000
