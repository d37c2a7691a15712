"""License scans: MinHash bands over overlapping text windows."""

from __future__ import annotations

import math
import random
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termledger.llm.common import BROADCAST_ROWS

#: Words of a shingle, and the share of a template's shingles that a window must hold.
SHINGLE = 5
SIMILARITY = 0.8
#: Probability with which a window of the stated similarity must collide in a band.
COLLISION = 0.999
#: Band values are literals of the plan; their number is checked.
MAX_BAND_VALUES = 100_000

# Notices of public licenses.
TEMPLATES = {
    "apache-2.0-short": "Licensed under the Apache License, Version 2.0.",
    "mit-short": "Released under the MIT License.",
    "gpl-3.0-short": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-short": "Licensed under CC BY-NC 4.0.",
    "apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software."
    ),
    "gpl-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    ),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce "
        "the above copyright notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution."
    ),
}


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    bare = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, " "))


def shingles(w: Column) -> Column:
    """Hash of each run of five words, in order; fewer words make one shingle.

    ``w`` must be a column of the input, not an expression: a lambda would
    evaluate that again for each word.
    """
    runs = F.transform(
        F.sequence(F.lit(0), F.size(w) - SHINGLE),
        lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)]),
    )
    return (
        F.when(F.size(w) >= SHINGLE, runs)
        .when(F.size(w) > 0, F.array(F.xxhash64(F.concat_ws(" ", w))))
        .otherwise(F.array().cast("array<bigint>"))
    )


def window_classes(lengths: list[int]) -> list[int]:
    """Powers of two that cover the templates' lengths in shingles."""
    return sorted({1 << (n - 1).bit_length() for n in lengths})


def stride(w: int) -> int:
    return max(1, w // 4)


def bands(least_jaccard: float, collision: float = COLLISION) -> int:
    """Bands of one row so that sets of the stated Jaccard similarity meet in
    one at least with the stated probability: 1 - (1 - j) ** bands."""
    return math.ceil(math.log(1 - collision) / math.log(1 - least_jaccard))


def least_jaccard(m: int, w: int) -> float:
    """Of a template of m shingles and the window of w + stride(w) shingles that
    holds ``SIMILARITY`` of them."""
    return SIMILARITY * m / (w + stride(w) + (1 - SIMILARITY) * m)


def masks(n: int) -> list[int]:
    """The hash of band k is the shingle's hash xor mask k; spread masks make
    the minima of different bands different shingles."""
    draw = random.Random(20)
    return [draw.getrandbits(64) - 2**63 for _ in range(n)]


def _xor(mask: int):
    return lambda h: h.bitwiseXOR(F.lit(mask))


def _minima(hashes: Column, n: int) -> Column:
    return F.array(*[F.array_min(F.transform(hashes, _xor(m))) for m in masks(n)])


def template_table(spark, templates: dict[str, str]) -> list[dict]:
    """Shingles and size class per template, computed as those of documents."""
    rows = spark.createDataFrame(list(templates.items()), "template string, text string")
    cut = rows.select("template", words(F.col("text")).alias("w"))
    found = cut.select("template", F.array_distinct(shingles(F.col("w"))).alias("s")).collect()
    return [
        {"template": r["template"], "s": r["s"], "w": 1 << (len(r["s"]) - 1).bit_length()} for r in found if r["s"]
    ]


def scan(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    similarity: float = SIMILARITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, template, containment, first_word, last_word) for each document and
    template whose shingles a window of the document holds to ``similarity`` or
    more: the best such window, the earliest of equals.

    A text is cut into overlapping windows of one size per class of template
    lengths, so that a run as long as a template lies in one window whole. A
    window and a template of the class are compared if a MinHash band of theirs
    is the same; the number of bands follows from the least Jaccard similarity
    that such a window can have, for a collision with probability 0.999. Matches
    are verified by exact shingle containment.

    A band value is the xor of one shingle and the band's mask, so a document
    without any shingle that is the minimum of a template's band can't collide
    and is left out before windows are cut; that loses no collision.

    Null and empty texts match nothing. Rows that repeat an id and a text give
    repeated results; other columns are left out. Templates are a parameter of
    checked size; template texts under five words match only whole texts.
    """
    if similarity < SIMILARITY:
        raise ValueError(f"the bands are set for a similarity of {SIMILARITY} or more")
    spark = docs.sparkSession
    known = template_table(spark, TEMPLATES if templates is None else templates)
    schema = "template string, w int, s array<bigint>"
    table = spark.createDataFrame([(t["template"], t["w"], t["s"]) for t in known], schema)
    n = bands(min((least_jaccard(len(t["s"]), t["w"]) for t in known), default=0.5))
    if len(known) * n > min(MAX_BAND_VALUES, BROADCAST_ROWS):
        raise ValueError("scan with fewer templates at a time")
    banded = table.select("template", "w", "s", F.posexplode(_minima(F.col("s"), n)).alias("band", "value"))
    anchors = [r[0] for r in banded.select(
        F.col("value").bitwiseXOR(F.element_at(F.array(*map(F.lit, masks(n))), F.col("band") + 1))
    ).distinct().collect()]

    def anchored(h: str) -> Column:
        """The array, or null if it holds no anchor. A filter would be pushed
        below the projection and compute the hashes twice."""
        return F.when(F.exists(h, lambda x: x.isin(anchors)) if anchors else F.lit(False), F.col(h))

    hashed = (
        docs.select(F.col(id_col).alias("id"), words(F.col(text_col)).alias("words"))
        .select("id", shingles(F.col("words")).alias("all"))
        .select("id", anchored("all").alias("h"))
    )
    classes = window_classes([len(t["s"]) for t in known])

    def windows(w: int) -> Column:
        step = stride(w)
        starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("h") - 1 - step), F.lit(step))
        return F.transform(starts, lambda i: F.struct(
            F.lit(w).alias("w"), i.cast("int").alias("start"), F.slice("h", i + 1, w + step).alias("h")
        ))

    cut = [windows(w) for w in classes] or [F.array().cast("array<struct<w:int,start:int,h:array<bigint>>>")]
    pieces = hashed.select("id", F.explode(reduce(lambda a, b: F.concat(a, b), cut)).alias("x")).select("id", "x.*")
    # most windows end here, before their minima are taken
    pieces = pieces.select("id", "w", "start", anchored("h").alias("h")).where("h is not null")
    met = pieces.select("id", "w", "start", "h", F.posexplode(_minima(F.col("h"), n)).alias("band", "value")).join(
        F.broadcast(banded), ["w", "band", "value"]
    )
    share = F.size(F.array_intersect("h", "s")) / F.size("s")
    held = F.filter(F.transform("h", lambda h, i: F.when(F.array_contains("s", h), i)), lambda i: i.isNotNull())
    verified = met.select("id", "template", share.alias("containment"), "start", held.alias("held")).where(
        F.col("containment") >= similarity
    )
    best = verified.groupBy("id", "template").agg(
        F.max_by(
            F.struct("containment", "start", "held"), F.struct("containment", -F.col("start"), -F.array_max("held"))
        ).alias("best")
    )
    return best.select(
        F.col("id").alias(id_col),
        "template",
        "best.containment",
        (F.col("best.start") + F.array_min("best.held")).alias("first_word"),
        (F.col("best.start") + F.array_max("best.held") + SHINGLE - 1).alias("last_word"),
    )
