"""Declared schemas of every input and the layout of every output.

Schemas are never inferred: identifiers have up to 18 digits and must be read
as bigint, dates are eight digits, and flags are plain integers. A text column
marked ``char`` holds fixed-width codes, whose trailing blanks do not count.
Declared widths cut nothing; a check reports what a bounded column would cut.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql.types import (
    DataType,
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

_TYPES: dict[str, DataType] = {
    "id": LongType(),
    "date": DateType(),
    "small": IntegerType(),
    "text": StringType(),
    "char": StringType(),
}


_COLUMN = re.compile(r"(\w+):([a-z]+)(\d*)(\??)")


def _schema(columns: str) -> StructType:
    """Schema from ``name:kind`` words; a number behind the kind is a declared
    width, a trailing ``?`` allows nulls."""
    fields = []
    for word in columns.split():
        name, kind, width, nullable = _COLUMN.fullmatch(word).groups()
        metadata = {"char": True} if kind == "char" else {}
        if width:
            metadata["width"] = int(width)
        fields.append(StructField(name, _TYPES[kind], bool(nullable), metadata))
    return StructType(fields)


def widths(schema: StructType) -> dict[str, int]:
    """Declared widths of the columns that have one, in characters."""
    return {f.name: f.metadata["width"] for f in schema.fields if "width" in f.metadata}


# Snapshot files of the international release.
CONCEPT_SNAPSHOT = _schema(
    "concept_id:id effective_time:date active:small module_id:id definition_status_id:id"
)
DESCRIPTION_SNAPSHOT = _schema(
    "description_id:id effective_time:date active:small module_id:id concept_id:id "
    "language_code:char2 type_id:id term:text case_significance_id:id"
)
RELATIONSHIP_SNAPSHOT = _schema(
    "relationship_id:id effective_time:date active:small module_id:id source_id:id "
    "destination_id:id relationship_group:small type_id:id characteristic_type_id:id modifier_id:id"
)
STATED_RELATIONSHIP_SNAPSHOT = RELATIONSHIP_SNAPSHOT
LANGUAGE_SNAPSHOT = _schema(
    "member_id:char36 effective_date:date active:small module_id:id refset_id:id "
    "description_id:id acceptability_id:id"
)
SIMPLE_MAP_SNAPSHOT = _schema(
    "id:char36 effective_time:date active:small module_id:id refset_id:id "
    "referenced_component_id:id map_target:text20"
)
EXTENDED_MAP_SNAPSHOT = _schema(
    "id:char36 effective_time:date active:small module_id:id refset_id:id "
    "referenced_component_id:id map_group:small map_priority:small? map_rule:text500 "
    "map_advice:text500? map_target:text20 correlation_id:id? map_category_id:id?"
)

# Prepared inputs of an extension release.
PREPARED_MAP = _schema("concept_id:id read_code:char5 read_term_code:char2")
MEDICINES_MAP = _schema(
    "mp_id:id mp_term:text500 effective_date:date description_id:id concept_id:id "
    "fully_specified_name:text150"
)
PATIENT_FRIENDLY_TERMS = _schema(
    "read_code:char5 read_term_code:char2 read_term:text100 pft:text100 concept_id:id description_id:id"
)
REFSET_EXTRACT = _schema(
    "member_id:char36 effective_date:date active:small module_id:id refset_id:id concept_id:id"
)

# Legacy code system.
LEGACY_CODES = _schema(
    "read_code:char5 preferred_term_30:text30 preferred_term_60:text60? preferred_term_198:text198? "
    "icd9_code:text20? icd9_code_def:text2? icd9_cm_code:text20? icd9_cm_code_def:text2? "
    "opcs_42_code:text20? opcs_code_def:text2? specialty_flag:text10? status_flag:small? "
    "language_code:text2"
)
LEGACY_TERMS = _schema(
    "term_key:text10 uniquifier:text2 term_30:text30? term_60:text60? term_198:text198? term_code:char2 "
    "language_code:text2 read_code:char5 status_flag:small"
)


@dataclass(frozen=True)
class Component:
    """A versioned table: its Full schema and how releases print it.

    ``key`` are the columns that a member id stands for, the most selective one
    first; ``header`` the printed column names in schema order; ``order`` the
    print order.
    """

    name: str
    schema: StructType
    key: tuple[str, ...]
    header: tuple[str, ...]
    order: tuple[str, ...]
    folder: str
    stem: str
    localized: bool = False
    writes_full: bool = True

    @property
    def id_column(self) -> str:
        return self.schema.fieldNames()[0]

    def id_columns(self) -> list[str]:
        """The id and the key columns that never change for it."""
        return list(dict.fromkeys([self.id_column, *self.key]))

    def file_name(self, kind: str, namespace: str, release: str, language: str) -> str:
        """Path below the release folder; ``kind`` is Full, Delta or Snapshot."""
        tag = f"-{language}" if self.localized else ""
        return f"{kind}/{self.folder}/{self.stem}{kind}{tag}_{namespace}_{release}.txt"


_RELATIONSHIP_COLUMNS = (
    "relationship_id:id effective_date:date active:small module_id:id source_id:id "
    "destination_id:id relationship_group:small type_id:id characteristic_type_id:id modifier_id:id"
)
_RELATIONSHIP_HEADER = (
    "id effectiveTime active moduleId sourceId destinationId relationshipGroup typeId "
    "characteristicTypeId modifierId"
)

MODULE_DEPENDENCY = Component(
    name="module_dependency",
    schema=_schema(
        "dep_id:char36 effective_date:date active:small module_id:id refset_id:id "
        "referenced_component_id:id source_effective_date:date target_effective_date:date"
    ),
    key=("referenced_component_id", "module_id"),
    header=tuple(
        "id effectiveTime active moduleId refsetId referencedComponentId sourceEffectiveTime "
        "targetEffectiveTime".split()
    ),
    order=("module_id", "effective_date", "referenced_component_id", "target_effective_date"),
    folder="Refset/Metadata",
    stem="der2_ssRefset_ModuleDependency",
)
CONCEPT = Component(
    name="concept",
    schema=_schema(
        "concept_id:id effective_date:date active:small module_id:id definition_status_id:id"
    ),
    key=("concept_id",),
    header=tuple("id effectiveTime active moduleId definitionStatusId".split()),
    order=("concept_id",),
    folder="Terminology",
    stem="sct2_Concept_",
    writes_full=False,
)
DESCRIPTION = Component(
    name="description",
    schema=_schema(
        "description_id:id effective_date:date active:small module_id:id concept_id:id "
        "language_code:char2 type_id:id term:text case_significance_id:id"
    ),
    key=("description_id",),
    header=tuple(
        "id effectiveTime active moduleId conceptId languageCode typeId term "
        "caseSignificanceId".split()
    ),
    order=("description_id",),
    folder="Terminology",
    stem="sct2_Description_",
    localized=True,
    writes_full=False,
)
RELATIONSHIP = Component(
    name="relationship",
    schema=_schema(_RELATIONSHIP_COLUMNS),
    key=("relationship_id",),
    header=tuple(_RELATIONSHIP_HEADER.split()),
    order=("relationship_id",),
    folder="Terminology",
    stem="sct2_Relationship_",
    writes_full=False,
)
STATED_RELATIONSHIP = Component(
    name="stated_relationship",
    schema=_schema(_RELATIONSHIP_COLUMNS),
    key=("relationship_id",),
    header=tuple(_RELATIONSHIP_HEADER.split()),
    order=("relationship_id",),
    folder="Terminology",
    stem="sct2_StatedRelationship_",
    writes_full=False,
)
SIMPLE_MAP = Component(
    name="simple_map",
    schema=_schema(
        "member_id:char36 effective_date:date active:small module_id:id refset_id:id "
        "referenced_component_id:id map_target:text20"
    ),
    key=("referenced_component_id", "map_target", "refset_id"),
    header=tuple(
        "id effectiveTime active moduleId refsetId referencedComponentId mapTarget".split()
    ),
    order=("member_id", "effective_date"),
    folder="Refset/Map",
    stem="der2_sRefset_SimpleMap",
)
LANGUAGE = Component(
    name="language",
    schema=_schema(
        "member_id:char36 effective_date:date active:small module_id:id refset_id:id "
        "description_id:id acceptability_id:id"
    ),
    key=("description_id", "refset_id"),
    header=tuple(
        "id effectiveTime active moduleId refsetId referencedComponentId acceptabilityId".split()
    ),
    order=("member_id", "effective_date"),
    folder="Refset/Language",
    stem="der2_cRefset_Language",
    localized=True,
)
# Loaded and reduced to its snapshot, never printed.
MAORI_LANGUAGE = Component(
    name="maori_language",
    schema=_schema(
        "member_id:char36 effective_date:date active:small module_id:id refset_id:id "
        "referenced_component_id:id acceptability_id:id"
    ),
    key=("referenced_component_id", "refset_id"),
    header=LANGUAGE.header,
    order=LANGUAGE.order,
    folder="Refset/Language",
    stem="der2_cRefset_Language",
    localized=True,
    writes_full=False,
)
REFSET_DESCRIPTOR = Component(
    name="refset_descriptor",
    schema=_schema(
        "attribute_id:char36 effective_date:date active:small module_id:id refset_id:id "
        "referenced_component_id:id attribute_description:id attribute_type:id "
        "attribute_order:small"
    ),
    key=("referenced_component_id", "attribute_order"),
    header=tuple(
        "id effectiveTime active moduleId refsetId referencedComponentId attributeDescription "
        "attributeType attributeOrder".split()
    ),
    order=("module_id", "effective_date", "referenced_component_id", "attribute_order"),
    folder="Refset/Metadata",
    stem="der2_cciRefset_RefsetDescriptor",
)
SIMPLE_REFSET = Component(
    name="simple_refset",
    schema=_schema(
        "member_id:char36 effective_date:date active:small module_id:id refset_id:id concept_id:id"
    ),
    key=("concept_id", "refset_id"),
    header=tuple("id effectiveTime active moduleId refsetId referencedComponentId".split()),
    order=("member_id", "effective_date"),
    folder="Refset/Content",
    stem="der2_Refset_Simple",
)

# Every table a release prints.
COMPONENTS = (
    MODULE_DEPENDENCY,
    CONCEPT,
    DESCRIPTION,
    RELATIONSHIP,
    STATED_RELATIONSHIP,
    SIMPLE_MAP,
    LANGUAGE,
    REFSET_DESCRIPTOR,
    SIMPLE_REFSET,
)
