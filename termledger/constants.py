"""Fixed values of the release format: public concept ids and literals.

These must equal the published identifiers for results to be right; they are
stated as plain text and nothing is derived from them.
"""

from __future__ import annotations

# Description types.
FULLY_SPECIFIED_NAME = 900000000000003001
SYNONYM = 900000000000013009

# Acceptability of a description in a language refset.
PREFERRED = 900000000000548007
ACCEPTABLE = 900000000000549004

# Case significance: whole term is case sensitive.
CASE_SENSITIVE = 900000000000017005

# Definition status: sufficiently defined.
FULLY_DEFINED = 900000000000073002

# Characteristic type that marks an inferred relationship.
INFERRED = 900000000000011006

# Relationship types.
IS_A = 116680003
ASSOCIATED_MORPHOLOGY = 116676008
FINDING_SITE = 363698007

# Modules.
CORE_MODULE = 900000000000207008

# Metadata parents whose children are refsets.
SIMPLE_MAP_PARENT = 900000000000496009
SIMPLE_REFSET_PARENT = 446609009

# International refsets.
LEGACY_CODE_MAP_REFSET = 900000000000497000
GB_ENGLISH_REFSET = 900000000000508004

# Refset descriptor: the refset itself, and the attribute rows it may hold.
DESCRIPTOR_REFSET = 900000000000456007
ATTRIBUTE_REFERENCED_COMPONENT = 449608002
ATTRIBUTE_MAP_SOURCE = 900000000000500006
ATTRIBUTE_MAP_TARGET = 900000000000499002
ATTRIBUTE_TYPE_COMPONENT = 900000000000461009
ATTRIBUTE_TYPE_STRING = 900000000000465000

# Semantic tags a medicinal product name may end with.
PRODUCT_TAGS = ("(product)", "(medicinal product)")

# The extension whose releases are rolled forward.
EXTENSION_MODULE = 21000210109
MAP_READ_TO_CONCEPT = 31000210106
MAP_CONCEPT_TO_READ = 41000210103
MAP_MEDICINES = 311000210107
MAP_ACCIDENT_CLAIMS = 401000210101
MAP_BENEFITS = 411000210104
LANGUAGE_ENGLISH = 271000210107
LANGUAGE_PATIENT_FRIENDLY = 281000210109
PATIENT_FRIENDLY_DESCRIPTION_RANGE = (911000210112, 2051000210118)
