"""Finds license notices inside documents.

Templates and documents become shingles of five words, without case and
punctuation. Documents are covered by overlapping windows of as many shingles
as the templates have, in size classes that double. A window is described by
twelve minima of its shingles' hashes under different functions, and two of them
make a band: two windows of Jaccard similarity J share one of six bands with
probability 1 - (1 - J^2)^6, which is 0.998 at 0.8 and certain for equal windows.
A template is indexed by its windows at every offset, so a copy meets an equal
window wherever it begins; and by windows of a small class, at every place of the
document, of which some lies in a part that edits and insertions left whole.
Templates that share a band are then checked exactly, by the share of their
shingles that the whole document holds. A document that holds no shingle of any
template can't match; windows are made for the others only.

Minima of large windows are the least of those of two halves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deposit_analytics.llm.common import row_key, stored
from deposit_analytics.llm.decontamination import BROADCAST_ROWS, SEGMENT, holding, longest_run, segmented, shingle_hashes

THRESHOLD = 0.8
BANDS = 6
ROWS = 2
MINIMA = BANDS * ROWS
# Shingles of a window, and shingles from one window to the next.
CLASSES = {1: 1, 2: 1, 4: 1, 8: 1, 16: 8, 32: 16, 64: 32}
SMALLEST = 8

# Notices by which works state their license, and the texts of short licenses.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
    " and associated documentation files (the Software), to deal in the Software without restriction",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the"
    " GNU General Public License as published by the Free Software Foundation",
    "BSD-redistribution": "Redistribution and use in source and binary forms, with or without modification, are"
    " permitted provided that the following conditions are met",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "Apache-2.0-header": "you may not use this file except in compliance with the License. You may obtain a copy of the"
    " License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,"
    " software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY"
    " KIND, either express or implied.",
    "LGPL-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU"
    " Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or"
    " (at your option) any later version.",
    "AGPL-notice": "it under the terms of the GNU Affero General Public License as published by the Free Software"
    " Foundation, either version 3 of the License, or (at your option) any later version.",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public"
    " License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-SA-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0"
    " International License.",
    "CC0-1.0": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring"
    " rights to this software to the public domain worldwide. This software is distributed without any warranty.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
    " associated documentation files (the Software), to deal in the Software without restriction, including without"
    " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the"
    " Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    " The above copyright notice and this permission notice shall be included in all copies or substantial portions of"
    " the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT"
    " LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT"
    " SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION"
    " OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER"
    " DEALINGS IN THE SOFTWARE.",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
    " hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE"
    " SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL"
    " IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,"
    " INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER"
    " IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR"
    " PERFORMANCE OF THIS SOFTWARE.",
    "BSD-2-text": "Redistribution and use in source and binary forms, with or without modification, are permitted"
    " provided that the following conditions are met: Redistributions of source code must retain the above copyright"
    " notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the"
    " above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other"
    " materials provided with the distribution.",
    "BSD-3-endorsement": "Neither the name of the copyright holder nor the names of its contributors may be used to"
    " endorse or promote products derived from this software without specific prior written permission.",
    "Zlib-text": "This software is provided as-is, without any express or implied warranty. In no event will the authors"
    " be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this"
    " software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject"
    " to the following restrictions",
    "Unlicense-text": "This is free and unencumbered software released into the public domain. Anyone is free to copy,"
    " modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled"
    " binary, for any purpose, commercial or non-commercial, and by any means.",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
}


def templates(spark: SparkSession) -> DataFrame:
    """license_id, text of the notices above."""
    rows = F.explode(F.array(*[F.struct(F.lit(name).alias("license_id"), F.lit(text).alias("text")) for name, text in NOTICES.items()]))
    return spark.range(1).select(rows.alias("row")).select("row.*")


def templates_from(spark: SparkSession, folder: str) -> DataFrame:
    """license_id, text of the files in a folder of license texts, of any length.

    A file is one template, named as the file without ``.txt``. Files whose names
    begin with a dot or an underscore are left out, as by every reader.
    """
    name = F.regexp_replace(F.col("_metadata.file_name"), r"\.txt$", "")
    return spark.read.text(folder, wholetext=True).select(name.alias("license_id"), F.col("value").alias("text"))


def word_hashes(text: Column) -> Column:
    """Hashes of the runs of letters and digits of a text, in lower case."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.array_remove(words, ""), lambda word: F.xxhash64(word))


def template_class(shingles: Column) -> Column:
    """The largest class of which a template holds a grid window wherever it begins."""
    fits = [F.when(shingles >= size + step - 1, F.lit(size)) for size, step in CLASSES.items()]
    return F.greatest(*fits, F.lit(None).cast("int"))


def bands(size: int) -> int:
    """Windows of one shingle are alike in one hash or not at all."""
    return 1 if size == 1 else BANDS


def _pairs(shingles: str, step: int) -> Column:
    """Minima of every ``step``-th shingle and the next."""
    count = F.floor((F.size(shingles) - 2) / step).cast("int")
    zero = F.struct(*[F.lit(0).cast("long").alias(f"m{band}") for band in range(MINIMA)])

    def least(place: Column) -> Column:
        a, b = F.get(shingles, place * step), F.get(shingles, place * step + 1)
        return F.struct(
            *[F.least(F.xxhash64(a, F.lit(band)), F.xxhash64(b, F.lit(band))).alias(f"m{band}") for band in range(MINIMA)]
        )

    return F.when(count >= 0, F.transform(F.sequence(F.lit(0), count), least)).otherwise(F.slice(F.array(zero), 1, 0))


def _halves(left: str, right: str) -> Column:
    return F.zip_with(
        left, right, lambda a, b: F.struct(*[F.least(a[f"m{band}"], b[f"m{band}"]).alias(f"m{band}") for band in range(MINIMA)])
    )


def _every(column: Column, ratio: int) -> Column:
    return column if ratio == 1 else F.filter(column, lambda _, i: i % ratio == 0)


def _described(minima: str, size: int, step: int) -> Column:
    """start and band keys of the windows of one class."""

    def window(one: Column, i: Column) -> Column:
        rows = [[one[f"m{ROWS * band + row}"] for row in range(ROWS)] for band in range(BANDS)]
        keys = F.array(*[F.xxhash64(F.lit(size), F.lit(band), *minima) for band, minima in enumerate(rows)])
        return F.struct(F.lit(size).alias("size"), (i * step).alias("start"), keys.alias("keys"))

    return F.transform(minima, window)


def _single(shingles: str) -> Column:
    """The same for windows of one shingle."""
    return F.transform(
        shingles,
        lambda one, i: F.struct(
            F.lit(1).alias("size"), i.alias("start"), F.array(F.xxhash64(F.lit(1), F.lit(0), one)).alias("keys")
        ),
    )


def _windows(frame: DataFrame, steps: dict[int, int]) -> DataFrame:
    """Adds ``windows`` over column ``shingles``; ``steps`` has the classes and their grids."""
    found = [_single("shingles")] if 1 in steps else []
    larger = {size: step for size, step in steps.items() if size > 1}
    size, step = 2, min([2, *larger.values()])
    if larger:
        frame = frame.withColumn("least2", _pairs("shingles", step))
    while larger:
        if size in larger:
            found.append(_described(f"least{size}", size, step))
        if size == max(larger):
            break
        wider = min(size * 2, min(one for at, one in larger.items() if at > size))
        source, offset = f"least{size}", size // step
        count = F.floor((F.size(source) - offset + wider // step - 1) / (wider // step)).cast("int")
        shifted = F.slice(source, F.lit(offset + 1), F.greatest(F.size(source) - offset, F.lit(0)))
        frame = frame.withColumns(
            {"left": _every(F.col(source), wider // step), "right": _every(shifted, wider // step)}
        )
        size, step = size * 2, wider
        frame = frame.withColumn(f"least{size}", F.slice(_halves("left", "right"), F.lit(1), F.greatest(count, F.lit(0))))
    return frame.withColumn("windows", F.concat(*found))


def _index(known: DataFrame, sizes: list[int]) -> DataFrame:
    """key, template, offset of every band of every window of the templates."""
    every = _windows(known, dict.fromkeys(sizes, 1))
    windows = every.select("template", "class", "small", F.explode_outer("windows").alias("window"))
    windows = windows.where(F.col("window.size").isin(F.col("class"), F.col("small")))
    return windows.select(
        "template", F.col("window.start").alias("offset"), F.explode_outer("window.keys").alias("key")
    ).distinct()


def _held(shingles: str) -> Column:
    """How many of ``parts`` are among the shingles."""
    return F.size(F.array_intersect("parts", shingles))


def _small_class(threshold: float) -> Column:
    """The largest of the small classes of which every match of the template holds a whole window."""
    distinct = F.size(F.array_distinct("shingles"))
    lacking = F.floor((1 - threshold) * distinct + 1e-6)
    run = longest_run(distinct - lacking, lacking)
    fits = [F.when(run >= size, F.lit(size)) for size in CLASSES if size <= SMALLEST]
    return F.greatest(*fits).cast("int")


def find_licenses(docs: DataFrame, notices: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """Returns doc_id, license_id, containment, at for every notice found in a document.

    ``notices`` has license_id and text. The containment is the share of the
    notice's distinct shingles that occur anywhere in the document, so parts
    that lie apart add up; it is at least ``threshold``. A notice is found by one of
    its windows, so some run of it must be whole in the document. ``at`` is the place, as
    the number of the word there, around which most of them lie (within a quarter
    of the notice's length and eight shingles to either side), the first of
    equals. Notices of fewer than five words match only texts that
    are nothing else. Notices and texts without words or NULL, and rows without
    doc_id, match nothing. Rows that repeat a doc_id with another text are judged on
    their own and reported once, as are repeated notices. Empty tables give no rows. Other columns are ignored.
    """
    text = F.col("text").cast("string")
    docs = docs.where(F.col("doc_id").isNotNull()).select(
        row_key(F.col("doc_id"), F.col("text")).alias("row"), "doc_id", text.alias("text")
    )
    known = notices.select(
        "license_id", F.xxhash64("license_id", "text").alias("template"), word_hashes(text).alias("words")
    ).dropDuplicates(["template"])
    known = known.select("license_id", "template", shingle_hashes("words").alias("shingles")).where(F.size("shingles") > 0)
    known = known.withColumns({"class": template_class(F.size("shingles")), "small": _small_class(threshold)})
    known = stored(known, "templates")
    sizes = sorted({size for row in known.select("class", "small").distinct().collect() for size in row}) or [1]
    index = stored(_index(known, sizes), "template_index")
    small = index.count() <= BROADCAST_ROWS
    shingled = holding(docs, known.select(F.explode("shingles").alias("shingle")), word_hashes)
    step = SEGMENT - SEGMENT % max(CLASSES.values())
    windows = _windows(segmented(shingled, step, 2 * max(sizes)), {size: CLASSES[size] for size in sizes}).select(
        "row", "from", F.explode_outer("windows").alias("window")
    )
    most = max(bands(size) for size in sizes)
    names = [f"key{band}" for band in range(most)]
    spread = windows.select(
        "row",
        (F.col("from") + F.col("window.start")).alias("start"),
        *[F.get("window.keys", F.lit(band)).alias(name) for band, name in enumerate(names)],
    )
    probes = spread.unpivot(["row", "start"], names, "band", "key")
    found = stored(
        probes.join(F.broadcast(index) if small else index, "key")
        .select("row", "template", (F.col("start") - F.col("offset")).alias("at"))
        .distinct(),
        "notices",
    )
    whole = known.select("template", "license_id", F.array_distinct("shingles").alias("parts"), F.size("shingles").alias("long"))
    whole = F.broadcast(whole) if small else whole
    scored = (
        found.select("row", "template")
        .distinct()
        .join(shingled, "row")
        .join(whole, "template")
        .select("row", "doc_id", "template", "license_id", (_held("shingles") / F.size("parts")).alias("containment"))
        .where(F.col("containment") >= threshold - 1e-9)
    )
    scored = stored(scored, "scored")
    pad = F.floor(F.col("long") / 4).cast("int") + 8
    first = F.greatest(F.col("at") - pad, F.lit(0))
    span = F.slice("shingles", first + 1, F.greatest(F.col("at") + F.col("long") + pad - first, F.lit(0)))
    spans = (
        found.join(scored.select("row", "template"), ["row", "template"])
        .join(shingled.select("row", "shingles"), "row")
        .join(whole, "template")
        .select("row", "template", "at", "parts", span.alias("span"))
        .select("row", "template", "at", _held("span").alias("near"))
    )
    places = spans.groupBy("row", "template").agg(F.min_by("at", F.struct(-F.col("near"), F.col("at"))).alias("at"))
    return (
        scored.join(places, ["row", "template"], "left")
        .groupBy("doc_id", "license_id")
        .agg(
            F.max("containment").alias("containment"),
            F.greatest(F.min_by("at", F.struct(-F.col("containment"), F.col("at"))), F.lit(0)).alias("at"),
        )
    )
