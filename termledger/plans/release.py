"""The three release jobs: load and derive, roll an extension forward, print.

Each job is a set of DataFrames cut by Parquet stages under one base folder.
Histories are partitioned by release date and bucketed by their key: a release
adds one partition and meets the older ones where they lie, and a rerun gives
the same result.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from termledger import constants as K
from termledger import schemas as S
from termledger.functions import text
from termledger.operators import closure, history, identifiers, quality, refsets, terms
from termledger.operators import relational as rel
from termledger.schemas import Component
from termledger.session import remove
from termledger.sources.readers import LINE, Lines, scan_delimited, scan_rf2
from termledger.sources.writers import materialize, materialize_bucketed, replace_bucketed_release, write_rf2

Paths = str | Sequence[str]
VERSION = history.VERSION
REJECT = "file string, line bigint, reason string, text string"


@dataclass(frozen=True)
class ReleaseContext:
    """Everything that changes from one release to the next."""

    release: dt.date
    previous: dt.date
    target: dt.date
    calendar: Sequence[dt.date]
    namespace: str
    language: str = "en"
    module_id: int = K.EXTENSION_MODULE


@dataclass(frozen=True)
class InternationalFiles:
    concept: Paths
    description: Paths
    relationship: Paths
    language: Paths
    simple_map: Paths
    extended_map: Paths | None = None
    stated_relationship: Paths | None = None
    legacy_codes: Paths | None = None
    legacy_terms: Paths | None = None


@dataclass(frozen=True)
class ExtensionFiles:
    """Histories of the previous release and the prepared inputs of the new one.

    The terminology histories already hold the new release's rows.
    """

    module_dependency: Paths
    concept: Paths
    description: Paths
    relationship: Paths
    stated_relationship: Paths
    simple_map: Paths
    language: Paths
    maori_language: Paths
    refset_descriptor: Paths
    simple_refset: Paths
    prepared_maps: Mapping[int, Paths]
    medicines_map: Paths
    patient_friendly: Paths
    refset_extracts: Sequence[str]


def international_files(
    folder: str, release: dt.date, edition: str = "INT", language: str = "en"
) -> InternationalFiles:
    """Snapshot files of a release folder under their standard names."""
    tail = f"{edition}_{release:%Y%m%d}.txt"
    terminology, refset = f"{folder}/Snapshot/Terminology", f"{folder}/Snapshot/Refset"
    return InternationalFiles(
        concept=f"{terminology}/sct2_Concept_Snapshot_{tail}",
        description=f"{terminology}/sct2_Description_Snapshot-{language}_{tail}",
        relationship=f"{terminology}/sct2_Relationship_Snapshot_{tail}",
        stated_relationship=f"{terminology}/sct2_StatedRelationship_Snapshot_{tail}",
        language=f"{refset}/Language/der2_cRefset_LanguageSnapshot-{language}_{tail}",
        simple_map=f"{refset}/Map/der2_sRefset_SimpleMapSnapshot_{tail}",
        extended_map=f"{refset}/Map/der2_iisssccRefset_ExtendedMapSnapshot_{tail}",
    )


def extension_histories(previous: str, new: str, context: ReleaseContext) -> dict[str, str]:
    """Full files by table, for :class:`ExtensionFiles`: those of the previous
    release folder, and from the new one the terminology files, to which the
    release's rows have been added by hand."""
    paths = {}
    for component in (*S.COMPONENTS, S.MAORI_LANGUAGE):
        edited = component.folder == "Terminology"
        folder, day = (new, context.release) if edited else (previous, context.previous)
        language = "mi" if component is S.MAORI_LANGUAGE else context.language
        paths[component.name] = (
            f"{folder}/{component.file_name('Full', context.namespace, f'{day:%Y%m%d}', language)}"
        )
    return paths


@dataclass
class Stages:
    """Tables of a job, each written below the base folder when it is saved."""

    spark: SparkSession
    base: str
    tables: dict[str, DataFrame] = field(default_factory=dict)
    bucketed_by: dict[str, Sequence[str]] = field(default_factory=dict)

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    @property
    def buckets(self) -> int:
        """As many as a shuffle has partitions, so that neither side of a join is dealt anew."""
        return int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def save(self, name: str, df: DataFrame, sort_by: Sequence[str] = ()) -> DataFrame:
        return self.view(name, materialize(df, self.path(name), sort_by=sort_by))

    def save_history(self, name: str, df: DataFrame, key: Sequence[str]) -> DataFrame:
        """A history, partitioned by release date and bucketed by its key."""
        self.bucketed_by[name] = key
        return self.view(name, materialize_bucketed(df, self.path(name), key, self.buckets, [VERSION]))

    def load(self, name: str, lines: Lines, key: Sequence[str] = ()) -> DataFrame:
        """Save the readable lines of some files as a table and the others as
        its rejects, so that every line is in one of the two.

        The lines are counted while they are read, so files without a bad line
        are read once; only those with one are read again for the rejects, and
        those without a good one, of which Spark drops the count. With a ``key``
        the table is a history.
        """
        seen = Observation()
        rows = lines.counted(seen)
        table = self.save_history(name, rows, key) if key else self.save(name, rows)
        try:
            rejects = seen.get["rejects"] > 0
        except Py4JJavaError:
            rejects = lines.has_rejects
        if rejects:
            self.save(f"{name}_rejects", lines.rejects)
        else:
            remove(self.spark, self.path(f"{name}_rejects"))
            self.view(f"{name}_rejects", self.spark.createDataFrame([], REJECT))
        return table

    def view(self, name: str, df: DataFrame) -> DataFrame:
        """A table that is cheap enough to stay a query over saved ones."""
        self.tables[name] = df
        return df

    def add_release(self, name: str, rows: DataFrame) -> DataFrame:
        rows = rows.select(*self.tables[name].columns)
        return self.view(name, replace_bucketed_release(rows, self.path(name), self.bucketed_by[name], self.buckets))

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]


# -- load and derive ---------------------------------------------------------


def load_international(spark: SparkSession, files: InternationalFiles, base: str) -> Stages:
    """Read an international release and derive its query layer."""
    t = Stages(spark, base)
    t.load("concept_load", scan_rf2(spark, files.concept, S.CONCEPT_SNAPSHOT))
    t.load("description_load", scan_rf2(spark, files.description, S.DESCRIPTION_SNAPSHOT))
    t.load("relationship_load", scan_rf2(spark, files.relationship, S.RELATIONSHIP_SNAPSHOT))
    t.load("language_load", scan_rf2(spark, files.language, S.LANGUAGE_SNAPSHOT))
    t.load("map_load", scan_rf2(spark, files.simple_map, S.SIMPLE_MAP_SNAPSHOT))
    if files.extended_map:
        t.load("extended_map_load", scan_rf2(spark, files.extended_map, S.EXTENDED_MAP_SNAPSHOT))
    if files.stated_relationship:
        stated = t.load(
            "stated_relationship_load", scan_rf2(spark, files.stated_relationship, S.STATED_RELATIONSHIP_SNAPSHOT)
        )
        t.view("stated_relationship", terms.active_relationships(stated).drop("is_inferred"))

    t.save("ctv3_map", terms.simple_map(t["map_load"], K.LEGACY_CODE_MAP_REFSET))
    t.view("relationship", terms.active_relationships(t["relationship_load"]))
    dialect = t.save("dialect", terms.dialect_members(t["language_load"], t["description_load"]))
    described = t.save("description_accepted", terms.accepted(t["description_load"], dialect))
    t.view("dialect_description", terms.dialect_descriptions(described))
    t.view("preferred_term", terms.preferred_terms(described))
    t.view("synonym_term", terms.synonyms(described))
    t.view("fully_specified_name", terms.fully_specified_names(described))
    t.view("description_active", terms.active_descriptions(described))

    named = t.save(
        "concept_active_or_inactive",
        terms.concepts(t["concept_load"], t["fully_specified_name"], t["preferred_term"]),
    )
    t.save("concept", terms.active_concepts(named, t["ctv3_map"]))
    t.view("concept_synonym", terms.concept_synonyms(t["concept"], t["synonym_term"]))

    core = terms.core_relationships(t["relationship_load"])
    pair = ["sub_concept_id", "super_concept_id"]
    t.save("is_a", closure.transitive_closure(terms.is_a_edges(core)), sort_by=pair)
    t.save("is_a_by_super", t["is_a"], sort_by=pair[::-1])
    for role, type_id in (
        ("assoc_morph", K.ASSOCIATED_MORPHOLOGY),
        ("finding_site", K.FINDING_SITE),
    ):
        t.save(f"{role}_relationship", terms.attribute(t["relationship"], type_id, role))
        t.view(role, rel.role_view(t["concept"], role, "concept_id", "fully_specified_name"))

    if files.legacy_codes:
        t.load("read_tab", scan_delimited(spark, files.legacy_codes, S.LEGACY_CODES))
    if files.legacy_terms:
        legacy = t.load("read_term_load", scan_delimited(spark, files.legacy_terms, S.LEGACY_TERMS))
        t.save("read_term", terms.read_terms(legacy))
    return t


def _declare(to: quality.Checks, t: Stages, name: str, row: Sequence[str], **declared) -> None:
    """Constraints of a table, if the job has it."""
    if name in t.tables:
        to.declare(name, t[name], quality.Constraints(row, **declared))


def international_checks(t: Stages) -> quality.Checks:
    """Constraints of the loaded and derived tables, as violating rows."""
    checks = quality.Checks()
    loaded = {
        "concept_load": ("concept_id", S.CONCEPT_SNAPSHOT),
        "description_load": ("description_id", S.DESCRIPTION_SNAPSHOT),
        "relationship_load": ("relationship_id", S.RELATIONSHIP_SNAPSHOT),
        "language_load": ("member_id", S.LANGUAGE_SNAPSHOT),
        "map_load": ("id", S.SIMPLE_MAP_SNAPSHOT),
    }
    for name, (key, schema) in loaded.items():
        _declare(
            checks, t, name, [key], keys={"key": [key]}, not_null=schema.fieldNames(), widths=S.widths(schema)
        )
    _declare(checks, t, "extended_map_load", ["id"], keys={"key": ["id"]}, widths=S.widths(S.EXTENDED_MAP_SNAPSHOT))
    _declare(checks, t, "read_tab", ["read_code"], keys={"key": ["read_code"]}, widths=S.widths(S.LEGACY_CODES))
    legacy = ["read_code", "term_code", "uniquifier"]
    _declare(checks, t, "read_term_load", legacy, keys={"key": legacy}, widths=S.widths(S.LEGACY_TERMS))
    code = ["read_code", "read_term_code"]
    _declare(checks, t, "read_term", code, keys={"key": code}, checks={"empty": F.col("read_term") != ""})

    _declare(checks, t, "ctv3_map", ["concept_id"], keys={"key": ["concept_id"]}, unique={"code": ["ctv3_code"]})
    ids = {f"{kind} id": [f"{kind}_description_id"] for kind in ("preferred_term", "fully_specified_name")}
    _declare(
        checks, t, "concept", ["concept_id"],
        keys={"key": ["concept_id"], **ids}, unique={"code": ["ctv3_code"]}, widths={"ctv3_code": 5},
    )
    _declare(checks, t, "concept_active_or_inactive", ["concept_id"], keys={"key": ["concept_id"], **ids})
    for kind in ("preferred_term", "fully_specified_name"):
        _declare(checks, t, kind, ["concept_id"], keys={"key": ["concept_id"], f"{kind} id": ids[f"{kind} id"]})
    for name, key in (
        ("dialect", ["description_id"]),
        ("synonym_term", ["synonym_description_id"]),
        ("description_active", ["description_id"]),
        ("is_a", ["sub_concept_id", "super_concept_id"]),
        ("concept_synonym", ["synonym_description_id"]),
    ):
        _declare(checks, t, name, key, keys={"key": key})
    for name in ("dialect_description", "description_active"):
        checks.add(f"{name} concept", lambda name=name: quality.orphans(t[name], t["concept_load"], ["concept_id"]))
    checks.add("is_a cycle", lambda: closure.closure_cycles(t["is_a"]))
    if "read_term" in t.tables and "read_tab" in t.tables:
        checks.add("read_term code", lambda: quality.orphans(t["read_term"], t["read_tab"], ["read_code"]))
    _add_rejects(checks, t)
    return checks


def _add_rejects(checks: quality.Checks, t: Stages) -> None:
    """Lines that a load left out, by table."""
    for name in t.tables:
        if name.endswith("_rejects"):
            checks.add(name.replace("_rejects", " rejects"), lambda name=name: t[name])


def international_counts(t: Stages) -> dict[str, DataFrame]:
    """Rows per refset of the map table and per type of the description table."""
    return {
        "map members": rel.count_by(t["map_load"], ["refset_id"]),
        "descriptions": rel.count_by(t["description_active"], ["is_fsn", "is_pt"]),
    }


# -- roll forward ------------------------------------------------------------


def _load_history(t: Stages, component: Component, paths: Paths, until: dt.date) -> DataFrame:
    """History up to a date. Lines without a date and lines of a later one are
    rejects too."""
    lines = scan_rf2(t.spark, paths, component.schema)
    late = ~F.coalesce(F.col(VERSION) <= F.lit(until), F.lit(False))
    return t.load(component.name, lines.refuse(VERSION, late), component.key)


def _rejects(component: Component) -> str:
    return f"{component.name}_rejects"


def _refuse_rejects(t: Stages, component: Component) -> None:
    """A history that lacks rows must not be rolled forward: members in them
    would be taken for new ones and get other ids."""
    if not t[_rejects(component)].isEmpty():
        raise ValueError(
            f"{component.name}: unreadable lines, or lines without a date up to the previous release, "
            f"see {_rejects(component)}"
        )


def _roll(
    t: Stages,
    component: Component,
    target: DataFrame,
    context: ReleaseContext,
    values: Sequence[str] = (),
    supplied_id: bool = False,
) -> None:
    """Meet a history with its target set, add the release and its snapshot.

    The comparison is saved once; delta and snapshot are projections of it.
    """
    _refuse_rejects(t, component)
    compared = t.save(
        f"{component.name}_compared",
        history.compare(
            t[component.name], target, component.key, values, supplied_id=supplied_id, colocated=True
        ),
    )
    t.add_release(
        component.name, history.release_rows(compared, context.release, context.module_id)
    )
    t.view(f"{component.name}_snapshot", history.release_snapshot(compared, context.release, context.module_id))


def roll_extension(
    spark: SparkSession,
    files: ExtensionFiles,
    international: Mapping[str, DataFrame],
    context: ReleaseContext,
    base: str,
) -> Stages:
    """Take every table of an extension from its previous release to the next.

    ``international`` holds the query layer of the release extended, of which
    ``concept``, ``concept_load``, ``description_load`` and ``dialect`` are used.
    """
    t = Stages(spark, base)
    modules = spark.range(1).select(F.lit(context.module_id).alias("module_id"))
    t.view("module_release", rel.release_calendar(modules, context.calendar))

    dependencies = _load_history(t, S.MODULE_DEPENDENCY, files.module_dependency, context.previous)
    _refuse_rejects(t, S.MODULE_DEPENDENCY)
    t.add_release(
        S.MODULE_DEPENDENCY.name,
        history.carry_forward(dependencies, context.previous, context.release, context.target),
    )

    for component, paths in (
        (S.CONCEPT, files.concept),
        (S.DESCRIPTION, files.description),
        (S.RELATIONSHIP, files.relationship),
        (S.STATED_RELATIONSHIP, files.stated_relationship),
    ):
        _load_history(t, component, paths, context.release)
    t.view("all_concept", refsets.all_components(t["concept"], international["concept_load"], "concept_id"))
    t.view(
        "all_description",
        refsets.all_components(t["description"], international["description_load"], "description_id"),
    )
    t.view("map_refset", refsets.refsets_of(t["relationship"], K.SIMPLE_MAP_PARENT))
    t.view("simple_refset_refset", refsets.refsets_of(t["relationship"], K.SIMPLE_REFSET_PARENT))

    active = international["concept"].select("concept_id")
    _roll_maps(t, files, active, context)
    _roll_language(t, files, international["dialect"], context)
    _roll_refsets(t, files, active, context)
    _describe_refsets(t, files, context)

    _load_history(t, S.MAORI_LANGUAGE, files.maori_language, context.previous)
    for component in (*S.COMPONENTS, S.MAORI_LANGUAGE):
        if f"{component.name}_snapshot" not in t.tables:
            t.save(
                f"{component.name}_snapshot",
                history.snapshot(t[component.name], component.id_columns()),
            )
    return t


def _roll_maps(t: Stages, files: ExtensionFiles, active: DataFrame, context: ReleaseContext) -> None:
    _load_history(t, S.SIMPLE_MAP, files.simple_map, context.previous)
    code = text.join_code(F.col("read_code"), F.col("read_term_code"))
    sources = []
    for refset_id, paths in files.prepared_maps.items():
        prepared = t.load(f"prepared_map_{refset_id}", scan_rf2(t.spark, paths, S.PREPARED_MAP))
        sources.append((prepared, refset_id, code))
    medicines = t.load(
        "medicines_map", scan_delimited(t.spark, files.medicines_map, S.MEDICINES_MAP, header=True)
    )
    sources.append((medicines, K.MAP_MEDICINES, text.cast_code(F.col("mp_id"))))
    target = t.save("map_target", refsets.build_target(sources, active))
    renamed = target.withColumnRenamed("concept_id", "referenced_component_id")
    _roll(t, S.SIMPLE_MAP, renamed, context)

    members = t["simple_map_snapshot"].withColumnRenamed("referenced_component_id", "concept_id")
    t.view("read_to_concept", refsets.refset_view(members, K.MAP_READ_TO_CONCEPT))
    t.view("concept_to_read", refsets.refset_view(members, K.MAP_CONCEPT_TO_READ))
    t.view(
        "concept_to_read_snapshot",
        refsets.refset_view(members, K.MAP_CONCEPT_TO_READ, active_only=False),
    )
    t.view("medicines", refsets.medicines_view(members, K.MAP_MEDICINES))


def _roll_language(t: Stages, files: ExtensionFiles, dialect: DataFrame, context: ReleaseContext) -> None:
    _load_history(t, S.LANGUAGE, files.language, context.previous)
    friendly = t.load(
        "patient_friendly", scan_rf2(t.spark, files.patient_friendly, S.PATIENT_FRIENDLY_TERMS)
    )
    own = rel.outside_range("description_id", *K.PATIENT_FRIENDLY_DESCRIPTION_RANGE)
    target = t.save(
        "language_target",
        refsets.build_language_target(dialect, friendly, t["description"], own),
    )
    _roll(t, S.LANGUAGE, target, context, values=["acceptability_id"])


def _roll_refsets(t: Stages, files: ExtensionFiles, active: DataFrame, context: ReleaseContext) -> None:
    _load_history(t, S.SIMPLE_REFSET, files.simple_refset, context.previous)
    extracts = t.load("refset_extract_load", scan_rf2(t.spark, files.refset_extracts, S.REFSET_EXTRACT, with_line=True))
    loaded = t.save(
        "refset_extract",
        rel.load_unique(extracts, [["member_id"], ["refset_id", "concept_id"]], LINE).drop(LINE),
    )
    target = t.save("refset_target", refsets.restrict_active(loaded, active))
    _roll(t, S.SIMPLE_REFSET, target, context, supplied_id=True)


def _describe_refsets(t: Stages, files: ExtensionFiles, context: ReleaseContext) -> None:
    _load_history(t, S.REFSET_DESCRIPTOR, files.refset_descriptor, context.previous)
    new = history.delta(t["concept"], context.release).where(F.col("active") == 1)
    rows = [
        refsets.describe_refsets(t[found], new, context.release, context.module_id, attributes)
        for found, attributes in (
            ("simple_refset_refset", refsets.SIMPLE_REFSET_ATTRIBUTES),
            ("map_refset", refsets.SIMPLE_MAP_ATTRIBUTES),
        )
    ]
    t.add_release(S.REFSET_DESCRIPTOR.name, reduce(DataFrame.unionByName, rows))


def extension_checks(
    t: Stages, international: Mapping[str, DataFrame], context: ReleaseContext
) -> quality.Checks:
    """Constraints and "should be empty" checks of a rolled extension."""
    checks = quality.Checks()

    def orphans(name: str, table: str, parent: DataFrame, keys: list[str], parent_keys: list[str] | None = None) -> None:
        checks.add(name, lambda: quality.orphans(t[table], parent, keys, parent_keys))

    # One row per module and literal release date, so its size is bounded.
    calendar = F.broadcast(t["module_release"])
    for component in (*S.COMPONENTS, S.MAORI_LANGUAGE):
        rows, name = t[component.name], component.name
        _declare(
            checks, t, name, [component.id_column], keys={"key": [component.id_column, VERSION]},
            not_null=rows.columns, widths=S.widths(component.schema),
        )
        released = rows if component is not S.MODULE_DEPENDENCY else rows.drop(VERSION).withColumnRenamed(
            "source_effective_date", VERSION
        )
        checks.add(f"{name} release", lambda rows=released: quality.not_in(rows, calendar, ["module_id", VERSION]))
    for component in (S.SIMPLE_MAP, S.LANGUAGE, S.SIMPLE_REFSET):
        rows, name = t[component.name], component.name
        member, key = [component.id_column], list(component.key)
        for check, pair in (("one member per key", (key, member)), ("one key per member", (member, key))):
            checks.add(f"{name} {check}", lambda rows=rows, pair=pair: quality.fd_violations(rows, *pair))
        checks.declare(
            f"{name} snapshot", t[f"{name}_snapshot"], quality.Constraints(member, keys={"member": member, "key": key})
        )
    codes = ["concept_id", "read_code", "read_term_code"]
    for name, key in (("concept_to_read_snapshot", codes), ("refset_target", ["refset_id", "concept_id"])):
        _declare(checks, t, name, ["member_id"], keys={"member": ["member_id"], "key": key})
    code = ["read_code", "read_term_code"]
    for name in t.tables:
        if name.startswith("prepared_map_") and not name.endswith("_rejects"):
            refset_id = int(name.removeprefix("prepared_map_"))
            keys = {"key": code} if refset_id == K.MAP_READ_TO_CONCEPT else (
                {"key": ["concept_id"]} if refset_id in (K.MAP_CONCEPT_TO_READ, K.MAP_BENEFITS, K.MAP_ACCIDENT_CLAIMS) else {}
            )
            _declare(checks, t, name, ["concept_id", *code], keys=keys, widths=S.widths(S.PREPARED_MAP))
    _declare(checks, t, "refset_extract", ["member_id"], widths=S.widths(S.REFSET_EXTRACT))
    _declare(
        checks, t, "medicines_map", ["mp_id"], keys={"unique": ["mp_id"]}, widths=S.widths(S.MEDICINES_MAP),
        checks={"tag": ~rel.without_tags("fully_specified_name", K.PRODUCT_TAGS)},
    )
    _declare(
        checks, t, "patient_friendly", code, keys={"unique": code}, widths=S.widths(S.PATIENT_FRIENDLY_TERMS)
    )
    for name, key in (
        ("all_concept", ["concept_id"]),
        ("all_description", ["description_id"]),
        ("map_refset", ["refset_id"]),
        ("simple_refset_refset", ["refset_id"]),
        ("read_to_concept", code),
        ("concept_to_read", ["concept_id"]),
        ("medicines", ["mp_id"]),
    ):
        _declare(checks, t, name, key, keys={"unique": key})
    target = ["refset_id", "concept_id", "map_target"]
    checks.declare("map target", t["map_target"], quality.Constraints(target, keys={"key": target}))
    target = ["refset_id", "description_id"]
    checks.declare("language target", t["language_target"], quality.Constraints(target, keys={"key": target}))

    concepts, active = international["concept_load"], international["concept"]
    orphans("map concept", "simple_map", concepts, ["referenced_component_id"], ["concept_id"])
    orphans("map refset", "simple_map", t["map_refset"], ["refset_id"])
    orphans("language description", "language_snapshot", t["all_description"], ["description_id"])
    orphans("refset of members", "simple_refset", t["simple_refset_refset"], ["refset_id"])
    checks.add("extract on inactive concept", lambda: quality.inactive_references(t["refset_extract"], active))
    orphans("description concept", "description", t["all_concept"], ["concept_id"])
    for name in ("relationship", "stated_relationship"):
        orphans(f"{name} source", name, t["concept_snapshot"], ["source_id"], ["concept_id"])
    for name in ("concept", "description", "relationship", "stated_relationship"):
        checks.add(
            f"{name} id", lambda name=name: identifiers.invalid_ids(t[name], f"{name.removeprefix('stated_')}_id")
        )
    for name in ("read_to_concept", "concept_to_read", "medicines", "patient_friendly"):
        orphans(f"{name} concept", name, active, ["concept_id"])
    orphans("patient_friendly description", "patient_friendly", t["all_description"], ["description_id"])
    for name in ("map_refset", "simple_refset_refset"):
        orphans(f"{name} concept", name, t["concept"], ["refset_id"], ["concept_id"])
    orphans(
        "descriptor concept", "refset_descriptor", t["concept_snapshot"], ["referenced_component_id"], ["concept_id"]
    )
    for refset_id in (K.MAP_CONCEPT_TO_READ, K.MAP_BENEFITS, K.MAP_ACCIDENT_CLAIMS):
        name = f"prepared_map_{refset_id}"
        if name in t.tables:
            checks.add(f"{name} id", lambda name=name: identifiers.invalid_ids(t[name], "concept_id"))
            orphans(f"{name} concept", name, concepts, ["concept_id"])
    claims, benefits = (f"prepared_map_{r}" for r in (K.MAP_ACCIDENT_CLAIMS, K.MAP_BENEFITS))
    if claims in t.tables and benefits in t.tables:
        checks.add("claims within benefits", lambda: quality.not_in(t[claims], t[benefits], t[claims].columns))
    checks.add("medicines inactive concept", lambda: quality.inactive_references(t["medicines_map"], active))
    checks.add("own description inactive", lambda: quality.must_be_active(
        t["description_snapshot"], t["language_snapshot"], "description_id"
    ))
    english = t["language_snapshot"].where(
        (F.col("refset_id") == K.LANGUAGE_ENGLISH) & (F.col("active") == 1)
    )
    checks.add("language total", lambda: quality.count_mismatch(
        [international["dialect"], _own_descriptions(t)], english
    ))
    named = ["description_id", "concept_id", "type_id"]
    described = t["description_snapshot"].select(named).unionByName(
        international["description_load"].select(named)
    )
    checks.add("preferred term per concept", lambda: quality.preferred_per_concept(
        t["language_snapshot"], described.where(F.col("type_id") == K.SYNONYM)
    ))
    _add_rejects(checks, t)
    return checks


def _own_descriptions(t: Stages) -> DataFrame:
    """The extension's descriptions outside its patient-friendly set."""
    friendly = t["language_snapshot"].where(F.col("refset_id") == K.LANGUAGE_PATIENT_FRIENDLY)
    return rel.anti_join(t["description_snapshot"].select("description_id"), friendly, ["description_id"])


def extension_counts(
    t: Stages, international: Mapping[str, DataFrame], context: ReleaseContext
) -> dict[str, DataFrame]:
    """Profiles and counts a release is signed off with."""
    counts: dict[str, DataFrame] = {}
    for component in (S.SIMPLE_MAP, S.LANGUAGE, S.SIMPLE_REFSET):
        name = component.name
        counts[f"{name} active"] = quality.active_counts(t[f"{name}_snapshot"])
        counts[f"{name} changes"] = quality.release_change_counts(t[name], context.release)
    for name in ("concept", "description"):
        counts[f"{name} ids"] = identifiers.id_profile(t[name], f"{name}_id")
    for name in ("relationship", "stated_relationship"):
        counts[f"{name} ids"] = identifiers.id_profile(
            t[name], "relationship_id", "characteristic_type_id"
        )
    counts["description values"] = (
        t["description"].select("type_id", "case_significance_id", "language_code").distinct()
    )
    counts["extract dates"] = quality.date_profile(t["refset_extract"])
    counts["medicines lengths"] = rel.max_length(
        t["medicines_map"], ["mp_term", "fully_specified_name"]
    )
    counts["medicines concepts"] = t["medicines_map"].agg(
        F.count_distinct("concept_id").alias("n_concepts")
    )
    english = t["language_snapshot"].where(F.col("refset_id") == K.LANGUAGE_ENGLISH)
    counts["dialect in language"] = quality.reconcile(
        international["dialect"], english, "description_id"
    )
    counts["own descriptions in language"] = quality.check_counts({"own_descriptions": _own_descriptions(t)})
    counts["preferred members"] = quality.preferred_cardinality(t["language_snapshot"])
    return counts


# -- print -------------------------------------------------------------------


def export_release(t: Stages, context: ReleaseContext, out_dir: str) -> dict[str, int]:
    """Print the tables as Full, Delta and Snapshot; rows by file name.

    Full files of the terminology tables are the inputs of the job and are not
    printed again. Language snapshots carry the extension's module throughout.
    """
    written = {}
    release = context.release.strftime("%Y%m%d")
    for component in S.COMPONENTS:
        full = t[component.name]
        latest = t[f"{component.name}_snapshot"]
        if component is S.LANGUAGE or "module_id" not in latest.columns:
            latest = latest.withColumn("module_id", F.lit(context.module_id))
        kinds = {"Delta": history.delta(full, context.release), "Snapshot": latest}
        if component.writes_full:
            kinds["Full"] = full
        for kind, rows in kinds.items():
            name = component.file_name(kind, context.namespace, release, context.language)
            written[name] = write_rf2(rows, f"{out_dir}/{name}", component)
    return written
