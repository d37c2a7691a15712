"""Reference sets: discovery, description, target sets and views."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termledger import constants as K
from termledger.functions.text import code_part, member_uuid, term_code_part
from termledger.operators.relational import semi_join

# Attribute rows of a refset descriptor: description, type, order.
SIMPLE_REFSET_ATTRIBUTES = (
    (K.ATTRIBUTE_REFERENCED_COMPONENT, K.ATTRIBUTE_TYPE_COMPONENT, 0),
)
SIMPLE_MAP_ATTRIBUTES = (
    (K.ATTRIBUTE_MAP_SOURCE, K.ATTRIBUTE_TYPE_COMPONENT, 0),
    (K.ATTRIBUTE_MAP_TARGET, K.ATTRIBUTE_TYPE_STRING, 1),
)


def refsets_of(relationships: DataFrame, parent: int) -> DataFrame:
    """Refsets are the sources of relationships to a metadata parent."""
    return (
        relationships.where(F.col("destination_id") == parent)
        .select(F.col("source_id").alias("refset_id"))
        .distinct()
    )


def describe_refsets(
    refsets: DataFrame,
    new_concepts: DataFrame,
    release: dt.date,
    module_id: int,
    attributes: Sequence[tuple[int, int, int]] = SIMPLE_REFSET_ATTRIBUTES,
) -> DataFrame:
    """Descriptor rows of the refsets whose concept is new in a release.

    One row per attribute: one for a simple refset, two for a simple map. The
    attribute rows are literals, so each refset is fanned out in place.
    """
    rows = F.array(
        *[
            F.struct(
                F.lit(description).alias("attribute_description"),
                F.lit(kind).alias("attribute_type"),
                F.lit(order).alias("attribute_order"),
            )
            for description, kind, order in attributes
        ]
    )
    concepts = refsets.select(F.col("refset_id").alias("referenced_component_id"))
    fresh = new_concepts.select(F.col("concept_id").alias("referenced_component_id"))
    return semi_join(concepts, fresh, ["referenced_component_id"]).select(
        "referenced_component_id", F.explode(rows).alias("attribute")
    ).select(
        member_uuid(
            F.lit(K.DESCRIPTOR_REFSET), F.col("referenced_component_id"), F.col("attribute.attribute_order")
        ).alias("attribute_id"),
        F.lit(release).alias("effective_date"),
        F.lit(1).alias("active"),
        F.lit(module_id).alias("module_id"),
        F.lit(K.DESCRIPTOR_REFSET).alias("refset_id"),
        "referenced_component_id",
        "attribute.*",
    )


def restrict_active(members: DataFrame, concepts: DataFrame) -> DataFrame:
    """Members on active concepts."""
    return semi_join(members, concepts, ["concept_id"])


def build_target(
    sources: Sequence[tuple[DataFrame, int, Column]], concepts: DataFrame
) -> DataFrame:
    """Active set of the maps: (refset, concept, target) from several sources,
    each with its refset id and target expression, on active concepts only.

    The planner moves the semi join below the union and shuffles the concepts
    once for all sources.
    """
    parts = [
        df.select(F.lit(refset_id).alias("refset_id"), "concept_id", target.alias("map_target"))
        for df, refset_id, target in sources
    ]
    return restrict_active(reduce(DataFrame.unionByName, parts), concepts)


def build_language_target(
    dialect: DataFrame,
    friendly: DataFrame,
    own_descriptions: DataFrame,
    own: Column,
    english: int = K.LANGUAGE_ENGLISH,
    patient_friendly: int = K.LANGUAGE_PATIENT_FRIENDLY,
) -> DataFrame:
    """Active set of the language refsets.

    The dialect's members keep their acceptability; patient-friendly terms are
    preferred in their own refset; the extension's descriptions that satisfy
    ``own`` are preferred in the main one. A description with several versions
    counts once.
    """
    members = dialect.select(
        F.lit(english).alias("refset_id"), "description_id", "acceptability_id"
    )
    for df, refset_id in ((friendly, patient_friendly), (own_descriptions.where(own), english)):
        members = members.unionByName(
            df.select(
                F.lit(refset_id).alias("refset_id"),
                "description_id",
                F.lit(K.PREFERRED).alias("acceptability_id"),
            )
        )
    return members.distinct()


def refset_view(members: DataFrame, refset_id: int, active_only: bool = True) -> DataFrame:
    """Members of one map with the target split into its code parts."""
    rows = members.where(F.col("refset_id") == refset_id)
    if active_only:
        rows = rows.where(F.col("active") == 1)
    rest = [] if active_only else ["effective_date", "active"]
    return rows.select(
        *([] if active_only else ["member_id"]),
        "concept_id",
        code_part(F.col("map_target")).alias("read_code"),
        term_code_part(F.col("map_target")).alias("read_term_code"),
        *rest,
    )


def medicines_view(members: DataFrame, refset_id: int) -> DataFrame:
    """Active members of a map whose target is a product id."""
    return members.where((F.col("refset_id") == refset_id) & (F.col("active") == 1)).select(
        "concept_id", F.col("map_target").alias("mp_id")
    )


def all_components(own: DataFrame, other: DataFrame, id_col: str) -> DataFrame:
    """Ids of the extension and of the release it extends.

    Own ids are assumed active, retired ones too; the column says so.
    """
    return (
        own.select(id_col, F.lit(1).alias("assumed_active"))
        .unionByName(other.select(id_col, F.col("active").alias("assumed_active")))
        .distinct()
    )
