"""One query per operator, over the driver's tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termledger import constants as K
from termledger.functions import text
from termledger.operators import closure, history, identifiers, quality, refsets, terms
from termledger.operators import relational as rel
from termledger.plans import fixtures as fx
from termledger.schemas import SIMPLE_MAP
from termledger.sources.writers import to_rf2

# After the last date of the data.
RELEASE = dt.date(2002, 1, 1)
AS_OF = dt.date(1996, 6, 30)
DELTA_DAY = dt.date(1996, 3, 15)
CARRY_FROM, CARRY_TO, CARRY_TARGET = dt.date(2018, 11, 1), dt.date(2019, 2, 1), dt.date(2019, 1, 31)

# The release dates of the extension.
RELEASE_DATES = [
    dt.date(2016, 10, 1),
    dt.date(2017, 7, 1),
    dt.date(2017, 8, 1),
    dt.date(2017, 11, 1),
    dt.date(2018, 3, 1),
    dt.date(2018, 5, 1),
    dt.date(2018, 8, 1),
    dt.date(2018, 11, 1),
    dt.date(2019, 2, 1),
]

REFSET_NAMES = {0: "READ TO CONCEPT", 1: "CONCEPT TO READ", 2: "MEDICINES", 3: "CLAIMS", 4: "BENEFITS"}
MAP_KEY = ["concept_id", "map_target", "refset_id"]
LANGUAGE_KEY = ["description_id", "refset_id"]
REFSET_KEY = ["concept_id", "refset_id"]
SAMPLE_REFSET = 3
SAMPLE_CONCEPT = 42
SAMPLE_PARENT = 5
SAMPLE_ANCESTOR = 7
OWN_RANGE = (1000, 4999)
NAME_TAGS = ["(economy)", "(standard)", "(promo)"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _named(name: str, function: Query) -> None:
    QUERIES[name] = function


# -- sources, literals, projections, filters ---------------------------------


@query
def scan_all(spark, sf_dir):
    return fx.table(spark, sf_dir, "part")


@query
def literal_rows(spark, sf_dir):
    rows = ", ".join(f"({refset}, '{name}')" for refset, name in REFSET_NAMES.items())
    names = spark.sql(
        f"select cast(refset_id as bigint) as refset_id, refset_name "
        f"from values {rows} as t(refset_id, refset_name)"
    )
    return rel.count_by(fx.fx_map_full(spark, sf_dir), ["refset_id"]).join(names, "refset_id")


@query
def dedupe_first(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    return rel.dedupe_first(lines, keys, [c for c in lines.columns if c not in keys])


@query
def load_unique(spark, sf_dir):
    """Extract rows with two unique keys, as a load that skips repeats keeps them."""
    lines = fx.table(spark, sf_dir, "lineitem")
    order = [c for c in lines.columns if c not in {"l_orderkey", "l_linenumber"}]
    first = ["l_orderkey", "l_linenumber"]
    return rel.load_unique(lines, [first, ["l_partkey", "l_suppkey"]], [*first, *order])


@query
def project_rename(spark, sf_dir):
    return fx.fx_description(spark, sf_dir).select(
        "concept_id",
        F.col("description_id").alias("synonym_description_id"),
        F.col("term").alias("synonym_term"),
    )


@query
def literal_columns(spark, sf_dir):
    return fx.fx_map_pairs(spark, sf_dir).select(
        F.lit(RELEASE).alias("effective_date"),
        F.lit(1).alias("active"),
        F.lit(K.EXTENSION_MODULE).alias("module_id"),
        *MAP_KEY,
    )


@query
def case_flags(spark, sf_dir):
    return fx.fx_description(spark, sf_dir).select(
        "description_id",
        rel.flag(F.col("type_id") == K.FULLY_SPECIFIED_NAME).alias("is_fsn"),
        rel.flag(F.col("case_significance_id") == K.CASE_SENSITIVE).alias("case_significant"),
        rel.flag((F.col("type_id") == K.SYNONYM) & rel.is_active()).alias("is_active_synonym"),
    )


@query
def filter_eq(spark, sf_dir):
    return fx.fx_map_full(spark, sf_dir).where(F.col("refset_id") == SAMPLE_REFSET)


@query
def filter_and(spark, sf_dir):
    return fx.fx_description(spark, sf_dir).where(
        (F.col("active") == 1) & (F.col("language_code") == "en") & (F.col("type_id") == K.SYNONYM)
    )


@query
def filter_or_changed(spark, sf_dir):
    target = fx.fx_lang_active(spark, sf_dir).withColumnRenamed("acceptability_id", "new_acceptability_id")
    return (
        snapshot_lang(spark, sf_dir)
        .join(target, LANGUAGE_KEY)
        .where(history.changed(F.col("active"), F.col("acceptability_id"), F.col("new_acceptability_id")))
        .select("member_id", "active", *LANGUAGE_KEY, "acceptability_id", "new_acceptability_id")
    )


@query
def filter_ne(spark, sf_dir):
    return fx.fx_description(spark, sf_dir).where(F.col("type_id") != K.FULLY_SPECIFIED_NAME)


@query
def filter_not_between(spark, sf_dir):
    return fx.fx_description(spark, sf_dir).where(rel.outside_range("description_id", *OWN_RANGE))


@query
def filter_not_like(spark, sf_dir):
    names = terms.fully_specified_names(fx.fx_description(spark, sf_dir))
    return names.where(rel.without_tags("fully_specified_name", NAME_TAGS))


@query
def filter_truthy(spark, sf_dir):
    return fx.fx_relationship(spark, sf_dir).where(rel.is_active())


@query
def component_history(spark, sf_dir):
    full = fx.fx_map_full(spark, sf_dir)
    return history.component_history(full, concept_id=SAMPLE_CONCEPT)


@query
def role_view(spark, sf_dir):
    return rel.role_view(
        concept(spark, sf_dir), "finding_site", "concept_id", "fully_specified_name"
    )


# -- joins -------------------------------------------------------------------


@query
def natural_join(spark, sf_dir):
    return rel.natural_join(fx.fx_description(spark, sf_dir), fx.fx_dialect_all(spark, sf_dir))


@query
def natural_join_chain(spark, sf_dir):
    named = rel.natural_join(fx.fx_concept(spark, sf_dir), fully_specified_name(spark, sf_dir))
    return rel.natural_join(named, preferred_term(spark, sf_dir))


@query
def semi_join(spark, sf_dir):
    return refsets.restrict_active(fx.fx_map_pairs(spark, sf_dir), _active_concepts(spark, sf_dir))


@query
def cross_join(spark, sf_dir):
    modules = fx.fx_map_full(spark, sf_dir).select(F.col("refset_id").alias("module_id")).distinct()
    return rel.release_calendar(modules, RELEASE_DATES)


@query
def left_enrich(spark, sf_dir):
    return rel.enrich(
        fx.fx_description(spark, sf_dir), fx.fx_dialect(spark, sf_dir), ["description_id"]
    ).select(
        "description_id",
        "concept_id",
        "term",
        # A null among 18-digit ids would turn them into floats in pandas.
        text.cast_code(F.col("acceptability_id")).alias("acceptability_id"),
    )


@query
def anti_join(spark, sf_dir):
    members = snapshot_map(spark, sf_dir).where(F.col("active") == 1)
    return rel.anti_join(members, fx.fx_map_active(spark, sf_dir), MAP_KEY)


@query
def anti_join_not_exists(spark, sf_dir):
    return rel.anti_join(
        fx.fx_refset_active(spark, sf_dir), snapshot_simple_refset(spark, sf_dir), REFSET_KEY
    )


@query
def two_hop_edges(spark, sf_dir):
    return closure.two_hop_edges(fx.fx_is_a(spark, sf_dir))


@query
def subset_violations(spark, sf_dir):
    return quality.not_in(fx.fx_map_active(spark, sf_dir), fx.fx_map_full(spark, sf_dir), MAP_KEY)


# -- aggregations and order --------------------------------------------------


@query
def count_global(spark, sf_dir):
    return fx.fx_map_full(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))


@query
def count_grouped(spark, sf_dir):
    return rel.count_by(fx.fx_map_full(spark, sf_dir), ["refset_id", "active"])


@query
def count_distinct(spark, sf_dir):
    return fx.fx_map_full(spark, sf_dir).groupBy("refset_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("concept_id").alias("n_concepts")
    )


@query
def max_by_key(spark, sf_dir):
    return history.latest_version(fx.fx_map_full(spark, sf_dir), ["member_id"])


@query
def max_length(spark, sf_dir):
    return rel.max_length(fx.fx_read_term(spark, sf_dir), ["term_60", "term_198"])


@query
def having_alias(spark, sf_dir):
    return (
        fx.fx_map_full(spark, sf_dir)
        .groupBy("refset_id", "concept_id")
        .agg(F.count_distinct("member_id").alias("n"))
        .where("n > 1")
    )


@query
def select_distinct(spark, sf_dir):
    return (
        fx.fx_relationship(spark, sf_dir)
        .select("type_id", "characteristic_type_id", "active")
        .distinct()
    )


@query
def ordered_history(spark, sf_dir):
    return fx.fx_map_full(spark, sf_dir).orderBy(
        "refset_id", "concept_id", "effective_date", "member_id"
    )


# -- sets and scalar functions -----------------------------------------------


@query
def union_distinct(spark, sf_dir):
    own = fx.fx_map_full(spark, sf_dir).select("concept_id")
    return refsets.all_components(own, fx.fx_concept(spark, sf_dir), "concept_id")


@query
def append_union(spark, sf_dir):
    rows = _map_compared(spark, sf_dir)
    new = history.release_rows(rows, RELEASE, K.EXTENSION_MODULE).drop("module_id")
    return rel.append(fx.fx_map_full(spark, sf_dir), new)


@query
def split_code(spark, sf_dir):
    return refsets.refset_view(snapshot_map(spark, sf_dir), SAMPLE_REFSET, active_only=False)


@query
def join_code(spark, sf_dir):
    return fx.fx_read_term(spark, sf_dir).select(
        "read_code",
        text.join_code(F.col("read_code"), F.col("term_code")).alias("map_target"),
        text.join_code(F.col("read_code"), F.col("term_60")).alias("labelled"),
    )


@query
def strip_cr(spark, sf_dir):
    members = fx.fx_map_full(spark, sf_dir).withColumn(
        "map_target", F.concat("map_target", F.lit("\r"), "member_id", F.lit("\r"))
    )
    return terms.simple_map(members, SAMPLE_REFSET, component="concept_id")


@query
def first_non_empty(spark, sf_dir):
    return terms.read_terms(fx.fx_read_term(spark, sf_dir))


@query
def nzmt_style_map(spark, sf_dir):
    return refsets.medicines_view(snapshot_map(spark, sf_dir), SAMPLE_REFSET)


@query
def member_ids(spark, sf_dir):
    return history.assign_member_ids(fx.fx_map_pairs(spark, sf_dir), MAP_KEY)


@query
def export_projection(spark, sf_dir):
    members = fx.fx_map_full(spark, sf_dir).select(
        "member_id",
        "effective_date",
        "active",
        F.lit(K.EXTENSION_MODULE).alias("module_id"),
        "refset_id",
        F.col("concept_id").alias("referenced_component_id"),
        "map_target",
    )
    return to_rf2(members, SIMPLE_MAP)


# -- histories ---------------------------------------------------------------


@query
def snapshot_map(spark, sf_dir):
    return history.snapshot(fx.fx_map_full(spark, sf_dir), ["member_id", *MAP_KEY])


@query
def snapshot_lang(spark, sf_dir):
    return history.snapshot(fx.fx_lang_full(spark, sf_dir), ["member_id", *LANGUAGE_KEY])


@query
def snapshot_simple_refset(spark, sf_dir):
    return history.snapshot(fx.fx_refset_full(spark, sf_dir), ["member_id", *REFSET_KEY])


@query
def snapshot_asof(spark, sf_dir):
    return history.snapshot_asof(fx.fx_map_full(spark, sf_dir), ["member_id", *MAP_KEY], AS_OF)


@query
def delta_map(spark, sf_dir):
    return history.delta(fx.fx_map_full(spark, sf_dir), DELTA_DAY)


def _map_compared(spark, sf_dir):
    return history.compare(fx.fx_map_full(spark, sf_dir), fx.fx_map_active(spark, sf_dir), MAP_KEY)


def _language_compared(spark, sf_dir):
    return history.compare(
        fx.fx_lang_full(spark, sf_dir),
        fx.fx_lang_active(spark, sf_dir),
        LANGUAGE_KEY,
        values=["acceptability_id"],
    )


def _refset_compared(spark, sf_dir):
    return history.compare(
        fx.fx_refset_full(spark, sf_dir),
        fx.fx_refset_active(spark, sf_dir),
        REFSET_KEY,
        supplied_id=True,
    )


def _release_query(compared: Query, change: str) -> Query:
    return lambda spark, sf_dir: history.release_rows(
        compared(spark, sf_dir), RELEASE, K.EXTENSION_MODULE, [change]
    )


_named("rf_map_inactivated", _release_query(_map_compared, history.INACTIVATED))
_named("rf_map_new", _release_query(_map_compared, history.ADDED))
_named("rf_map_reactivated", _release_query(_map_compared, history.UPDATED))
_named("rf_lang_inactivated", _release_query(_language_compared, history.INACTIVATED))
_named("rf_lang_new", _release_query(_language_compared, history.ADDED))
_named("rf_lang_updated", _release_query(_language_compared, history.UPDATED))
_named("rf_refset_del", _release_query(_refset_compared, history.INACTIVATED))
_named("rf_refset_add", _release_query(_refset_compared, history.ADDED))
_named("rf_refset_upd", _release_query(_refset_compared, history.UPDATED))


@query
def rf_map_snapshot(spark, sf_dir):
    return history.release_snapshot(_map_compared(spark, sf_dir), RELEASE)


@query
def rf_lang_snapshot(spark, sf_dir):
    return history.release_snapshot(_language_compared(spark, sf_dir), RELEASE)


@query
def rf_refset_snapshot(spark, sf_dir):
    return history.release_snapshot(_refset_compared(spark, sf_dir), RELEASE)


@query
def carry_forward(spark, sf_dir):
    rows = fx.fx_dep(spark, sf_dir)
    return rel.append(rows, history.carry_forward(rows, CARRY_FROM, CARRY_TO, CARRY_TARGET))


# -- reference sets ----------------------------------------------------------


def _active_concepts(spark, sf_dir):
    return fx.fx_concept(spark, sf_dir).where(F.col("active") == 1)


@query
def discover_refsets(spark, sf_dir):
    return refsets.refsets_of(fx.fx_relationship(spark, sf_dir), SAMPLE_PARENT)


@query
def refset_descriptors(spark, sf_dir):
    new = _active_concepts(spark, sf_dir)
    found = fx.fx_relationship(spark, sf_dir)
    simple = refsets.describe_refsets(
        refsets.refsets_of(found, SAMPLE_PARENT), new, RELEASE, K.EXTENSION_MODULE
    )
    maps = refsets.describe_refsets(
        refsets.refsets_of(found, SAMPLE_PARENT + 1),
        new,
        RELEASE,
        K.EXTENSION_MODULE,
        refsets.SIMPLE_MAP_ATTRIBUTES,
    )
    return simple.unionByName(maps)


@query
def map_target_set(spark, sf_dir):
    prepared = fx.fx_read_term(spark, sf_dir).withColumn("concept_id", F.col("read_code").cast("bigint"))
    medicines = fx.fx_map_pairs(spark, sf_dir)
    code = text.join_code(F.col("read_code"), F.col("term_code"))
    return refsets.build_target(
        [
            (prepared, K.MAP_READ_TO_CONCEPT, code),
            (prepared, K.MAP_CONCEPT_TO_READ, code),
            (medicines, K.MAP_MEDICINES, text.cast_code(F.col("refset_id"))),
        ],
        _active_concepts(spark, sf_dir),
    ).distinct()


@query
def lang_target_set(spark, sf_dir):
    own = fx.fx_description(spark, sf_dir).where(F.col("type_id") == K.FULLY_SPECIFIED_NAME)
    return refsets.build_language_target(
        fx.fx_dialect_all(spark, sf_dir),
        fx.fx_lang_customers(spark, sf_dir),
        own,
        rel.outside_range("description_id", *OWN_RANGE),
    )


# -- graph -------------------------------------------------------------------


@query
def is_a_closure(spark, sf_dir):
    return closure.transitive_closure(fx.fx_is_a(spark, sf_dir))


@query
def descendants_of(spark, sf_dir):
    return closure.reachable(fx.fx_is_a(spark, sf_dir), SAMPLE_ANCESTOR, "super_concept_id", "sub_concept_id")


@query
def ancestors_of(spark, sf_dir):
    return closure.reachable(fx.fx_is_a(spark, sf_dir), SAMPLE_CONCEPT, "sub_concept_id", "super_concept_id")


@query
def closure_cycles(spark, sf_dir):
    """Edges into the root are also taken backwards, which seeds cycles."""
    edges = fx.fx_is_a(spark, sf_dir)
    back = edges.where(F.col("super_concept_id") == 0).select(
        F.col("super_concept_id").alias("sub_concept_id"),
        F.col("sub_concept_id").alias("super_concept_id"),
    )
    return closure.closure_cycles(closure.transitive_closure(edges.unionByName(back)))


# -- names, concepts, relationships ------------------------------------------


def _described(spark, sf_dir):
    return terms.accepted(fx.fx_description(spark, sf_dir), fx.fx_dialect(spark, sf_dir))


@query
def preferred_term(spark, sf_dir):
    return terms.preferred_terms(_described(spark, sf_dir))


@query
def synonym_term(spark, sf_dir):
    return terms.synonyms(_described(spark, sf_dir))


@query
def fully_specified_name(spark, sf_dir):
    return terms.fully_specified_names(fx.fx_description(spark, sf_dir))


@query
def dialect_description(spark, sf_dir):
    return terms.dialect_descriptions(_described(spark, sf_dir))


@query
def description_active(spark, sf_dir):
    return terms.active_descriptions(_described(spark, sf_dir))


@query
def concept_active_or_inactive(spark, sf_dir):
    return terms.concepts(
        fx.fx_concept(spark, sf_dir),
        fully_specified_name(spark, sf_dir),
        preferred_term(spark, sf_dir),
    )


@query
def concept(spark, sf_dir):
    return terms.active_concepts(concept_active_or_inactive(spark, sf_dir), _legacy_codes(spark, sf_dir))


def _legacy_codes(spark, sf_dir):
    return fx.fx_read_term(spark, sf_dir).select(
        F.col("read_code").cast("bigint").alias("concept_id"), F.col("read_code").alias("ctv3_code")
    )


@query
def concept_synonym(spark, sf_dir):
    names = terms.names_by_concept(_described(spark, sf_dir))
    named = terms.concepts_with_names(fx.fx_concept(spark, sf_dir), names)
    return terms.spread_synonyms(terms.active_concepts(named, _legacy_codes(spark, sf_dir)))


@query
def attribute_pairs(spark, sf_dir):
    relationships = terms.active_relationships(fx.fx_relationship(spark, sf_dir))
    return terms.attribute(relationships, K.ASSOCIATED_MORPHOLOGY, "assoc_morph")


@query
def finding_site_pairs(spark, sf_dir):
    relationships = terms.active_relationships(fx.fx_relationship(spark, sf_dir))
    return terms.attribute(relationships, K.FINDING_SITE, "finding_site")


@query
def active_relationship(spark, sf_dir):
    return terms.active_relationships(fx.fx_relationship(spark, sf_dir))


# -- checks ------------------------------------------------------------------


@query
def fd_violations(spark, sf_dir):
    return quality.fd_violations(fx.fx_map_full(spark, sf_dir), REFSET_KEY, ["member_id"])


@query
def dq_duplicates(spark, sf_dir):
    return quality.duplicates(fx.fx_map_full(spark, sf_dir), REFSET_KEY)


@query
def dq_orphans(spark, sf_dir):
    return quality.orphans(
        fx.fx_lang_full(spark, sf_dir), fx.fx_lang_active(spark, sf_dir), ["description_id"]
    )


@query
def dq_orphans_composite(spark, sf_dir):
    return quality.orphans(
        fx.fx_map_full(spark, sf_dir),
        fx.fx_lang_full(spark, sf_dir),
        ["refset_id", "effective_date"],
    )


@query
def dq_check(spark, sf_dir):
    return quality.violations(first_non_empty(spark, sf_dir), F.col("read_term") != "")


@query
def dq_nulls(spark, sf_dir):
    return quality.nulls(fx.fx_read_term(spark, sf_dir), ["term_30", "term_60"])


@query
def date_profile(spark, sf_dir):
    return quality.date_profile(fx.fx_map_full(spark, sf_dir))


@query
def dq_inactive_refs(spark, sf_dir):
    return quality.inactive_references(
        fx.fx_map_pairs(spark, sf_dir), _active_concepts(spark, sf_dir)
    )


@query
def active_counts(spark, sf_dir):
    return quality.active_counts(snapshot_map(spark, sf_dir))


@query
def release_change_counts(spark, sf_dir):
    rows = history.release_rows(_map_compared(spark, sf_dir), RELEASE, K.EXTENSION_MODULE)
    return quality.release_change_counts(rows, RELEASE)


@query
def reconcile_counts(spark, sf_dir):
    return quality.reconcile(
        fx.fx_lang_active(spark, sf_dir), snapshot_lang(spark, sf_dir), "description_id"
    )


@query
def must_be_active(spark, sf_dir):
    found = quality.must_be_active(
        fx.fx_lang_active(spark, sf_dir), snapshot_lang(spark, sf_dir), "description_id"
    )
    state = F.when(F.col("active").isNull(), "missing").otherwise("inactive")
    return found.select("description_id", "member_id", state.alias("state"))


@query
def pt_cardinality(spark, sf_dir):
    return quality.preferred_cardinality(snapshot_lang(spark, sf_dir))


@query
def pt_per_concept(spark, sf_dir):
    """Nations stand in for concepts, customers for their descriptions."""
    described = fx.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("description_id"), F.col("c_nationkey").alias("concept_id")
    )
    return quality.preferred_per_concept(snapshot_lang(spark, sf_dir), described)


# -- identifiers -------------------------------------------------------------


@query
def id_profile(spark, sf_dir):
    return identifiers.id_profile(fx.fx_ids(spark, sf_dir), "sctid")


@query
def invalid_ids(spark, sf_dir):
    return identifiers.invalid_ids(fx.fx_ids(spark, sf_dir), "sctid")


@query
def generated_check_digits(spark, sf_dir):
    bodies = fx.fx_ids(spark, sf_dir).select(
        "sctid", F.expr("substring(sctid, 1, length(sctid) - 1)").alias("body")
    )
    return identifiers.add_check_digit(bodies, "body", "check_digit")
