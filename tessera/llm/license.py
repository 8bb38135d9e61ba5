"""License scans (7): MinHash bands over overlapping text windows, in DataFrame
functions only.

A template of L shingles is looked for in windows of L + stride shingles that start at
every multiple of the stride, so some window holds any whole occurrence. An occurrence
that inserted words stretch beyond a window is out of reach but for the part that one
window holds. A window is a
candidate if one band of its MinHash signature equals the template's; candidates are
verified by exact shingle containment. A band can only be equal if the window holds the
band's first minimum, so signatures are made only for windows that hold such a shingle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import broadcast_if_small, staged
from tessera.llm.decontam import bind, words_of

SHINGLE, CONTAINMENT = 5, 0.8
#: A window of 1.25 L shingles that contains 0.8 L of a template has with it a union of
#: at most 1.45 L, so a Jaccard similarity of at least 0.55: 40 bands of 2 miss one in
#: two million such windows ((1 - 0.55 ** 2) ** 40), 20 would miss one in 1,400.
BANDS, ROWS = 40, 2
#: Templates' shingles up to which the first test is one literal set.
LITERAL = 20_000

#: Notices as their licenses word them.
NOTICES = {
    "apache-2.0-short": "Licensed under the Apache License, Version 2.0.",
    "mit-short": "Released under the MIT License.",
    "gpl-3.0-short": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-short": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-short": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
           "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
           "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
           "conditions:",
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                  "compliance with the License. You may obtain a copy of the License at "
                  "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                  "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                  "CONDITIONS OF ANY KIND, either express or implied.",
    "gpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
               "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
               "option) any later version.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
           "the following conditions are met:",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
               "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
           "granted, provided that the above copyright notice and this permission notice appear in all copies.",
}


def default_templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(NOTICES.items()), "license string, text string")


def _shingles(words: Column) -> Column:
    """Hash of every run of ``SHINGLE`` words, in order (the whole sequence as one if
    there are fewer, but not none); ``words`` must be bound or a column."""
    n = F.size(words)
    at = F.when(n >= SHINGLE, F.sequence(F.lit(0), n - SHINGLE)).when(n > 0, F.array(F.lit(0))).otherwise(
        F.expr("array()").cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(SHINGLE)]))


def _minimum(shingles: Column, j: int) -> Column:
    """The shingle that the j-th hash function puts first; ``shingles`` must be bound."""
    return F.array_min(F.transform(shingles, lambda s: F.struct(F.xxhash64(s, F.lit(j)).alias("h"), s.alias("s"))))["s"]


def _signature(shingles: Column) -> Column:
    return F.array(*[_minimum(shingles, j) for j in range(BANDS * ROWS)])


def _bands(signature: Column) -> Column:
    """One hash for each band; ``signature`` must be bound or a column."""
    return F.array(*[F.xxhash64(F.lit(b), *[F.get(signature, F.lit(b * ROWS + r)) for r in range(ROWS)])
                     for b in range(BANDS)])


def scan_licenses(docs: DataFrame, templates: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  license_col: str = "license", template_col: str = "text",
                  containment: float = CONTAINMENT) -> DataFrame:
    """``(id_col, license, first_word, n_words, containment)``: for each row of ``docs``
    and each template found in it the best window (highest containment, then first):
    where it starts and how many words it spans. A template of fewer than ``SHINGLE``
    words is one shingle and must occur as a whole text. Null and empty texts and
    templates match nothing; templates with a null name are left out; rows equal in id
    and text give one result. Other columns are not read."""
    t = templates.select(F.col(license_col).cast("string").alias("license"), words_of(F.col(template_col)).alias("w"))
    t = t.filter(F.col("license").isNotNull() & (F.size("w") > 0)).distinct().withColumn("ts", F.array_distinct(_shingles(F.col("w"))))
    t = t.withColumn("sig", bind(F.col("ts"), _signature))
    length = F.size("ts")
    t = t.select("license", "ts", F.col("sig").alias("tsig"), _bands(F.col("sig")).alias("tbands"),
                 F.greatest(F.lit(1), F.floor(length / 4)).cast("int").alias("stride"), F.xxhash64("license", "w").alias("tk"))
    t = staged(t.withColumn("wide", F.when(F.size("ts") == 1, 1).otherwise(F.size("ts") + F.col("stride"))), "license-templates")
    marks = staged(t.select("tk", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.get(
        F.col("tsig"), b * ROWS)))).alias("mark")), "license-marks")

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("th", F.xxhash64("text"))
    own = rows.select("id", "th", bind(words_of(F.col("text")), _shingles).alias("ds"))
    first = marks.select("mark").distinct()
    if first.count() <= LITERAL:
        wanted = F.lit([r["mark"] for r in first.collect()]) if first.limit(1).count() else F.expr("array()").cast("array<bigint>")
        own = own.filter(F.arrays_overlap("ds", wanted))
    own = staged(own.dropDuplicates(["id", "th"]), "license-docs")
    anchors = own.select("id", "th", F.posexplode("ds").alias("at", "mark")).join(broadcast_if_small(marks), "mark")
    spans = anchors.join(F.broadcast(t.select("tk", "stride", "wide")), "tk") if t.count() <= LITERAL else anchors.join(
        t.select("tk", "stride", "wide"), "tk")
    lowest = F.greatest(F.lit(0), F.ceil((F.col("at") - F.col("wide") + 1) / F.col("stride")).cast("int"))
    starts = F.transform(F.sequence(lowest, F.floor(F.col("at") / F.col("stride")).cast("int")), lambda i: i * F.col("stride"))
    spans = spans.select("id", "th", "tk", "wide", F.explode(starts).alias("start")).distinct()
    same = F.col("id").eqNullSafe(F.col("hid")) & (F.col("th") == F.col("hth"))
    spans = spans.join(own.select(F.col("id").alias("hid"), F.col("th").alias("hth"), "ds"), same)
    windows = spans.select("id", "th", "tk", "start", F.array_distinct(F.slice("ds", F.col("start") + 1, F.col("wide"))).alias("ws"),
                           F.least(F.col("wide"), F.size("ds") - F.col("start")).alias("n"))
    windows = staged(windows.withColumn("wbands", bind(bind(F.col("ws"), _signature), _bands)), "license-windows")
    met = windows.join(broadcast_if_small(t.select("tk", "license", "ts", "tbands")), "tk").filter(
        F.exists(F.zip_with("wbands", "tbands", lambda x, y: x == y), lambda x: x))
    share = F.size(F.array_intersect("ws", "ts")) / F.size("ts")
    found = met.withColumn("containment", share).filter(F.col("containment") >= F.lit(containment))
    best = found.groupBy("id", "th", "license").agg(F.max(F.struct("containment", (-F.col("start")).alias("s"), "n")).alias("b"))
    return best.select(F.col("id").alias(id_col), "license", (-F.col("b.s")).cast("long").alias("first_word"),
                       (F.col("b.n") + SHINGLE - 1).cast("long").alias("n_words"), F.col("b.containment").alias("containment"))
