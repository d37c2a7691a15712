"""The three release jobs end to end on a small world of files."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

import pytest
import world as W
from pyspark.sql import functions as F

from termledger import constants as K
from termledger import schemas as S
from termledger.operators import quality
from termledger.plans import release
from termledger.sources.readers import read_rf2


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return tmp_path_factory.mktemp("world")


@pytest.fixture(scope="module")
def intl(spark, folder):
    files = W.international(folder / "international")
    return release.load_international(spark, files, str(folder / "stages/international"))


@pytest.fixture(scope="module")
def extension(spark, folder, intl):
    files = W.extension(folder / "extension")
    return release.roll_extension(spark, files, intl, W.CONTEXT, str(folder / "stages/extension"))


@pytest.fixture(scope="module")
def printed(spark, folder, extension):
    return release.export_release(extension, W.CONTEXT, str(folder / "out"))


def test_concepts(intl):
    found = rows(intl["concept"], "concept_id", "fully_specified_name", "preferred_term",
                 "preferred_term_case_significant", "fully_defined", "ctv3_code")
    assert found == [
        (W.C[n], f"Name {n} (finding)", f"name {n}", int(n == 2), int(n < 3), {1: "X1abc", 2: "X2abc"}.get(n))
        for n in (1, 2, 3, 4, 5)
    ]
    assert intl["concept_active_or_inactive"].count() == 6
    assert intl["concept_synonym"].count() == 5


def test_names(intl):
    assert intl["dialect"].count() == 20
    assert intl["dialect_description"].count() == 20
    assert intl["preferred_term"].count() == 6
    assert intl["synonym_term"].count() == 7
    flags = rows(intl["description_active"], "description_id", "is_fsn", "is_pt")
    assert (W.FSN[1], 1, 0) in flags and (W.PT[1], 0, 1) in flags and (W.SYN[1], 0, 0) in flags


def test_graph(intl):
    n = {c: k for k, c in W.C.items()}
    pairs = {(n[a], n[b]) for a, b in rows(intl["is_a"])}
    assert pairs == {(2, 1), (3, 2), (3, 1), (4, 3), (4, 2), (4, 1), (5, 4), (5, 3), (5, 2), (5, 1)}
    assert rows(intl["finding_site_relationship"]) == [(W.C[3], W.C[1])]
    assert rows(intl["assoc_morph_relationship"]) == [(W.C[4], W.C[2])]
    assert intl["finding_site"].columns == ["finding_site_concept_id", "finding_site_fully_specified_name"]


def test_legacy_codes(intl):
    assert rows(intl["read_tab"], "read_code", "preferred_term_30") == [("R102.", "Name, thirty")]
    assert rows(intl["read_term"]) == [
        ("R102.", "00", "t60"), ("R102.", "11", "a, b"), ("r102.", "00", ""),
    ]
    assert intl["stated_relationship"].count() == 5
    assert intl["extended_map_load"].collect()[0].map_target == "A00"


def test_international_checks(intl):
    found = {r.name: r.n for r in release.international_checks(intl).counts().collect()}
    assert found.pop("read_term empty") == 1
    assert found.pop("read_term code") == 1
    assert set(found.values()) == {0}


def test_international_counts(intl):
    found = {name: rows(df) for name, df in release.international_counts(intl).items()}
    assert found["map members"] == [(446608001, 1), (K.LEGACY_CODE_MAP_REFSET, 2)]
    assert found["descriptions"] == [(0, 0, 7), (0, 1, 6), (1, 0, 7)]


def test_map_release(extension):
    new = extension["simple_map"].where("effective_date = '2019-02-01'")
    c2r, r2c = K.MAP_CONCEPT_TO_READ, K.MAP_READ_TO_CONCEPT
    known = {"m1", "m2", "m3", "m4", "m5"}
    found = {
        (r.member_id if r.member_id in known else None, r.active, r.refset_id, r.referenced_component_id, r.map_target)
        for r in new.collect()
    }
    assert found == {
        ("m2", 0, c2r, W.C[2], "BBBBB00"),
        (None, 1, c2r, W.C[2], "bbbbb00"),
        ("m3", 1, c2r, W.C[3], "CCCCC00"),
        ("m4", 0, c2r, W.C[6], "DDDDD00"),
        (None, 1, r2c, W.C[1], "AAAAA00"),
        (None, 1, K.MAP_BENEFITS, W.C[1], "AAAAA00"),
        (None, 1, K.MAP_BENEFITS, W.C[2], "bbbbb00"),
        (None, 1, K.MAP_ACCIDENT_CLAIMS, W.C[1], "AAAAA00"),
        (None, 1, K.MAP_ACCIDENT_CLAIMS, W.C[2], "BBBBB11"),
        (None, 1, K.MAP_MEDICINES, W.C[4], "77"),
    }
    assert rows(extension["concept_to_read"]) == [
        (W.C[1], "AAAAA", "00"), (W.C[2], "bbbbb", "00"), (W.C[3], "CCCCC", "00"),
    ]
    assert rows(extension["medicines"]) == [(W.C[4], "77")]
    assert extension["simple_map"].count() == 6 + len(found)


def test_language_release(extension):
    new = extension["language"].where("effective_date = '2019-02-01'")
    known = {r.member_id: (r.active, r.acceptability_id) for r in new.where("member_id like 'l%'").collect()}
    assert known == {
        "l2": (1, K.ACCEPTABLE),
        "l3": (1, K.PREFERRED),
        "l4": (0, K.PREFERRED),
    }
    # 20 dialect members of which three are known, own description, friendly one.
    assert new.count() == 3 + 17 + 1 + 1
    active = extension["language_snapshot"].where("active = 1")
    assert rows(active.groupBy("refset_id").count()) == [
        (K.LANGUAGE_ENGLISH, 21), (K.LANGUAGE_PATIENT_FRIENDLY, 1),
    ]


def test_refset_release(extension):
    new = extension["simple_refset"].where("effective_date = '2019-02-01'")
    assert rows(new, "member_id", "active", "refset_id", "concept_id") == sorted([
        ("r2", 0, W.OLD_REFSET, W.C[2]),
        ("r3", 1, W.OLD_REFSET, W.C[3]),
        ("n1", 1, W.NEW_REFSET, W.C[5]),
    ])


def test_metadata_release(extension):
    new = extension["refset_descriptor"].where("effective_date = '2019-02-01'")
    assert rows(new, "referenced_component_id", "attribute_description", "attribute_order") == [
        (W.NEW_REFSET, K.ATTRIBUTE_REFERENCED_COMPONENT, 0)
    ]
    # Two rows a release.
    assert extension["module_dependency"].count() == 6
    assert extension["maori_language_snapshot"].count() == 0
    assert rows(extension["description_snapshot"], "term") == [("Old refset, renamed",), ("friendly",)]


def test_extension_checks(extension, intl):
    checks = release.extension_checks(extension, intl, W.CONTEXT)
    found = {r.name: r.n for r in checks.counts().collect() if r.n}
    assert found == {
        # The description that is a text definition, and the retired map.
        "language description": 1,
        "extract on inactive concept": 1,
        "claims within benefits": 1,
        "medicines inactive concept": 1,
        "medicines_map tag": 1,
    }


def test_building_the_checks_starts_no_job(spark, extension, intl):
    spark.sparkContext.setJobGroup("build-checks", "")
    try:
        checks = release.extension_checks(extension, intl, W.CONTEXT)
        assert len(checks) > 60
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("build-checks")) == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def seeded(stages, twice, **changed):
    """The stages with the rows of some tables doubled and others replaced."""
    tables = stages.tables | {name: stages[name].unionByName(stages[name]) for name in twice} | changed
    return replace(stages, tables=tables)


def test_seeded_faults_of_the_international_tables(intl):
    twice = ["preferred_term", "fully_specified_name", "concept", "concept_active_or_inactive", "concept_synonym",
             "read_tab", "read_term_load", "extended_map_load"]
    long = intl["map_load"].withColumn("map_target", F.repeat("map_target", 20))
    checks = release.international_checks(seeded(intl, twice, map_load=long))
    fire = [f"{name} key" for name in twice] + ["map_load width"]
    fire += [f"{name} {kind} id" for kind in ("preferred_term", "fully_specified_name")
             for name in (kind, "concept", "concept_active_or_inactive")]
    assert [name for name in fire if checks[name].isEmpty()] == []


def test_seeded_faults_of_the_extension(spark, extension, intl):
    twice = ["simple_map_snapshot", "language_snapshot", "simple_refset_snapshot", "concept_to_read_snapshot", "refset_target"]
    prepared = [f"prepared_map_{n}" for n in (K.MAP_CONCEPT_TO_READ, K.MAP_BENEFITS, K.MAP_ACCIDENT_CLAIMS)]
    changed = {
        name: extension[name].unionByName(spark.createDataFrame([(404, "AAAAAA", "00")], S.PREPARED_MAP)) for name in prepared
    }
    checks = release.extension_checks(seeded(extension, twice, **changed), intl, W.CONTEXT)
    fire = [f"{name} {kind}" for name in ("simple_map snapshot", "language snapshot", "simple_refset snapshot",
                                          "concept_to_read_snapshot", "refset_target") for kind in ("member", "key")]
    fire += [f"{name} {kind}" for name in prepared for kind in ("concept", "width")] + ["language total"]
    assert [name for name in fire if checks[name].isEmpty()] == []


def test_extension_counts(extension, intl):
    found = {name: rows(df) for name, df in release.extension_counts(extension, intl, W.CONTEXT).items()}
    assert found["simple_map active"] == sorted([
        (K.MAP_READ_TO_CONCEPT, 1), (K.MAP_CONCEPT_TO_READ, 3), (K.MAP_MEDICINES, 1),
        (K.MAP_ACCIDENT_CLAIMS, 2), (K.MAP_BENEFITS, 2),
    ])
    assert found["simple_refset changes"] == [(W.OLD_REFSET, 0, 1), (W.OLD_REFSET, 1, 1), (W.NEW_REFSET, 1, 1)]
    assert found["concept ids"] == [("1000210", "10", 0)]
    assert found["description ids"] == [("1000210", "11", 0)]
    assert found["relationship ids"] == [("1000210", "12", K.INFERRED, 0)]
    assert found["medicines lengths"] == [(17, 29)]
    assert found["medicines concepts"] == [(2,)]
    assert dict(found["dialect in language"]) == {
        "source_rows": 20, "present": 20, "missing": 0, "active_members": 21,
    }
    assert found["own descriptions in language"] == [("own_descriptions", 1)]


def test_standard_file_names():
    found = release.international_files("/in", dt.date(2019, 1, 31))
    assert found.concept == "/in/Snapshot/Terminology/sct2_Concept_Snapshot_INT_20190131.txt"
    assert found.language == "/in/Snapshot/Refset/Language/der2_cRefset_LanguageSnapshot-en_INT_20190131.txt"
    paths = release.extension_histories("/old", "/new", W.CONTEXT)
    assert paths["concept"] == "/new/Full/Terminology/sct2_Concept_Full_XX1000210_20190201.txt"
    assert paths["simple_map"] == "/old/Full/Refset/Map/der2_sRefset_SimpleMapFull_XX1000210_20181101.txt"
    assert paths["maori_language"].endswith("der2_cRefset_LanguageFull-mi_XX1000210_20181101.txt")
    assert len(paths) == 10


def test_printed_files(spark, folder, printed, extension):
    assert len(printed) == 23
    assert sum(name.startswith("Full/") for name in printed) == 5
    assert "Delta/Refset/Map/der2_sRefset_SimpleMapDelta_XX1000210_20190201.txt" in printed
    assert "Snapshot/Terminology/sct2_Description_Snapshot-en-XX_XX1000210_20190201.txt" in printed
    for component in S.COMPONENTS:
        delta, latest = (
            read_rf2(
                spark,
                str(folder / "out" / component.file_name(kind, "XX1000210", "20190201", "en-XX")),
                component.schema,
            )
            for kind in ("Delta", "Snapshot")
        )
        full = extension[component.name]
        assert rows(delta) == rows(full.where("effective_date = '2019-02-01'"))
        versions = {}
        for row in full.collect():
            kept = versions.setdefault(row[0], row)
            if row.effective_date > kept.effective_date:
                versions[row[0]] = row
        assert rows(latest) == sorted(tuple(r) for r in versions.values())


def test_rerun_gives_the_same_release(spark, folder, intl, extension, printed):
    before = {c.name: rows(extension[c.name]) for c in S.COMPONENTS}
    files = W.extension(folder / "extension")
    again = release.roll_extension(spark, files, intl, W.CONTEXT, str(folder / "stages/extension"))
    assert {c.name: rows(again[c.name]) for c in S.COMPONENTS} == before


def test_next_release_with_the_same_targets_is_empty(spark, folder, intl, extension, printed):
    """The printed release is the input of the next one."""
    files = W.extension(folder / "extension")
    context = replace(
        W.CONTEXT,
        release=dt.date(2019, 5, 1),
        previous=W.RELEASE,
        calendar=[*W.CONTEXT.calendar, dt.date(2019, 5, 1)],
    )
    histories = release.extension_histories(str(folder / "out"), str(folder / "edited"), context)
    full = {c.name: histories[c.name] for c in S.COMPONENTS if c.writes_full}
    files = replace(files, **full)
    following = release.roll_extension(spark, files, intl, context, str(folder / "stages/next"))
    for name in ("simple_map", "language", "simple_refset", "refset_descriptor"):
        assert following[name].where("effective_date = '2019-05-01'").count() == 0
    assert following["module_dependency"].count() == 8
