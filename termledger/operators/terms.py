"""The query layer: names of concepts, concept tables, attributes, legacy codes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termledger import constants as K
from termledger.functions.text import first_non_empty, strip_cr
from termledger.operators.relational import enrich, flag, is_active, natural_join, semi_join


def dialect_members(
    language: DataFrame, descriptions: DataFrame, refset_id: int = K.GB_ENGLISH_REFSET
) -> DataFrame:
    """Active members of one language refset, without those on texts that are
    no descriptions."""
    members = language.where((F.col("refset_id") == refset_id) & (F.col("active") == 1))
    return semi_join(members, descriptions, ["description_id"]).select(
        "description_id", "effective_date", "acceptability_id"
    )


def accepted(descriptions: DataFrame, dialect: DataFrame) -> DataFrame:
    """Descriptions with their acceptability in the dialect, null outside it.

    The one join of the name layer: preferred terms, synonyms and flags are
    filters of its result.
    """
    return enrich(
        descriptions, dialect.select("description_id", "acceptability_id"), ["description_id"]
    )


def dialect_descriptions(described: DataFrame) -> DataFrame:
    """Descriptions of the dialect with their acceptability."""
    return described.where(F.col("acceptability_id").isNotNull()).select(
        "description_id", "concept_id", "type_id", "term", "case_significance_id", "acceptability_id"
    )


def _named(descriptions: DataFrame, term: str, prefix: str) -> DataFrame:
    """Descriptions under the column names of one kind of name."""
    return descriptions.select(
        "concept_id",
        F.col("description_id").alias(f"{prefix}_description_id"),
        F.col("term").alias(term),
        flag(F.col("case_significance_id") == K.CASE_SENSITIVE).alias(f"{prefix}_case_significant"),
    )


def _dialect_term(acceptability: int) -> Column:
    return (
        (F.col("active") == 1)
        & (F.col("language_code") == "en")
        & (F.col("type_id") == K.SYNONYM)
        & (F.col("acceptability_id") == acceptability)
    )


def preferred_terms(described: DataFrame) -> DataFrame:
    return _named(described.where(_dialect_term(K.PREFERRED)), "preferred_term", "preferred_term")


def synonyms(described: DataFrame) -> DataFrame:
    return _named(described.where(_dialect_term(K.ACCEPTABLE)), "synonym_term", "synonym")


def fully_specified_names(descriptions: DataFrame) -> DataFrame:
    names = descriptions.where(
        (F.col("active") == 1) & (F.col("type_id") == K.FULLY_SPECIFIED_NAME)
    )
    return _named(names, "fully_specified_name", "fully_specified_name")


def active_descriptions(described: DataFrame) -> DataFrame:
    """Active English descriptions, flagged as full or preferred name."""
    preferred = (F.col("type_id") == K.SYNONYM) & (F.col("acceptability_id") == K.PREFERRED)
    return described.where((F.col("active") == 1) & (F.col("language_code") == "en")).select(
        "concept_id",
        "description_id",
        "term",
        "case_significance_id",
        flag(F.col("type_id") == K.FULLY_SPECIFIED_NAME).alias("is_fsn"),
        flag(preferred).alias("is_pt"),
    )


def concepts(concept_rows: DataFrame, full_names: DataFrame, preferred: DataFrame) -> DataFrame:
    """One row per named concept of any status. All joins share the concept id,
    so the rows of a concept meet in one partition and are shuffled once per
    table."""
    rows = concept_rows.select(
        "concept_id",
        F.col("effective_time").alias("concept_effective_time"),
        F.col("active").alias("concept_active"),
        "definition_status_id",
    )
    named = rows.join(full_names, "concept_id").join(preferred, "concept_id")
    defined = flag(F.col("definition_status_id") == K.FULLY_DEFINED).alias("fully_defined")
    return named.select(
        "concept_id",
        "concept_effective_time",
        "concept_active",
        *[c for c in full_names.columns + preferred.columns if c != "concept_id"],
        defined,
    )


def active_concepts(named: DataFrame, legacy_codes: DataFrame) -> DataFrame:
    """The active ones among named concepts, with their legacy code if any."""
    codes = legacy_codes.select("concept_id", "ctv3_code")
    return enrich(named.where(F.col("concept_active") == 1), codes, ["concept_id"])


# Kinds of names of a concept, as arrays of one grouped pass: prefix of the columns, column of the term.
_KINDS = {
    "full_names": ("fully_specified_name", "fully_specified_name"),
    "preferred": ("preferred_term", "preferred_term"),
    "accepted": ("synonym", "synonym_term"),
}


def names_by_concept(described: DataFrame) -> DataFrame:
    """(concept_id, full_names, preferred, accepted): all names of a concept from
    one conditional aggregation of the descriptions, which have met the dialect
    once. A concept has a few names, so an array is short."""
    name = F.struct(
        "description_id", "term", flag(F.col("case_significance_id") == K.CASE_SENSITIVE).alias("case_significant")
    )
    full = (F.col("active") == 1) & (F.col("type_id") == K.FULLY_SPECIFIED_NAME)
    wanted = {"full_names": full, "preferred": _dialect_term(K.PREFERRED), "accepted": _dialect_term(K.ACCEPTABLE)}
    return described.where(reduce(Column.__or__, wanted.values())).groupBy("concept_id").agg(
        *[F.collect_list(F.when(kind, name)).alias(column) for column, kind in wanted.items()]
    )


def _spread(rows: DataFrame, column: str) -> DataFrame:
    """A row per name of one kind, under the column names of the kind."""
    prefix, term = _KINDS[column]
    return rows.withColumn("_name", F.explode(column)).withColumns({
        f"{prefix}_description_id": F.col("_name.description_id"),
        term: F.col("_name.term"),
        f"{prefix}_case_significant": F.col("_name.case_significant"),
    }).drop("_name", column)


def concepts_with_names(concept_rows: DataFrame, names: DataFrame) -> DataFrame:
    """As :func:`concepts`, from the grouped names, with the ``accepted`` ones:
    the concept table meets one table of names."""
    spread = _spread(_spread(names, "full_names"), "preferred")
    rows = concept_rows.select(
        "concept_id",
        F.col("effective_time").alias("concept_effective_time"),
        F.col("active").alias("concept_active"),
        flag(F.col("definition_status_id") == K.FULLY_DEFINED).alias("fully_defined"),
    )
    return rows.join(spread, "concept_id")


def spread_synonyms(named: DataFrame) -> DataFrame:
    """As :func:`concept_synonyms`, from concepts with their ``accepted`` names."""
    return _spread(named, "accepted")


def concept_synonyms(concept: DataFrame, synonym: DataFrame) -> DataFrame:
    """One row per synonym with all columns of its concept."""
    return natural_join(concept, synonym)


def attribute(relationships: DataFrame, type_id: int, value: str) -> DataFrame:
    """Distinct (concept, value) pairs of one relationship type."""
    return (
        relationships.where(F.col("type_id") == type_id)
        .select(
            F.col("source_id").alias("concept_id"),
            F.col("destination_id").alias(f"{value}_concept_id"),
        )
        .distinct()
    )


def active_relationships(relationships: DataFrame) -> DataFrame:
    """Active relationships. The flag is named for what its type id means."""
    kept = [
        c for c in relationships.columns if c not in {"active", "module_id", "modifier_id", "characteristic_type_id"}
    ]
    return relationships.where(is_active()).select(
        *kept, flag(F.col("characteristic_type_id") == K.INFERRED).alias("is_inferred")
    )


def core_relationships(relationships: DataFrame, module_id: int = K.CORE_MODULE) -> DataFrame:
    """Active relationships of the core module."""
    return relationships.where((F.col("module_id") == module_id) & (F.col("active") == 1)).select(
        "relationship_id",
        "effective_time",
        "source_id",
        "destination_id",
        "type_id",
        "characteristic_type_id",
        "modifier_id",
    )


def is_a_edges(relationships: DataFrame) -> DataFrame:
    return relationships.where(F.col("type_id") == K.IS_A).select(
        F.col("source_id").alias("sub_concept_id"),
        F.col("destination_id").alias("super_concept_id"),
    )


def simple_map(
    members: DataFrame, refset_id: int, component: str = "referenced_component_id"
) -> DataFrame:
    """One refset of the map table with clean codes."""
    return members.where(F.col("refset_id") == refset_id).select(
        F.col(component).alias("concept_id"), strip_cr(F.col("map_target")).alias("ctv3_code")
    )


def read_terms(legacy_terms: DataFrame) -> DataFrame:
    """Distinct (code, term code, longest term that is not empty)."""
    return legacy_terms.select(
        "read_code",
        F.col("term_code").alias("read_term_code"),
        first_non_empty(F.col("term_198"), F.col("term_60"), F.col("term_30")).alias("read_term"),
    ).distinct()
