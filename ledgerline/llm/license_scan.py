"""Licence scans: a trained paragraph classifier confirmed by templates.

All texts are cut into paragraphs: every non-blank line, and notices that are
wrapped over several lines: within consecutive non-blank lines, the stretch of
words from the first to the last three-word run of a family, cut where no
template could lose as many words and still be confirmed.  A multinomial
logistic regression over hashed word n-grams (sparse, one and two words) names
the licence family of each paragraph or the class ``unknown``.  Kept are the
paragraphs that it names, the stretches, and, as ``unknown``, lines with a
licence word (``CUES``).  It is trained on notices, on the
names of each licence in usual sentences (``FRAMES``), on variants of both with
a run of words left out, and, as ``unknown``, on a bounded sample of different
corpus lines without licence wording, on sentences that use the words
otherwise, on runs of words that notices of several families share, and on the
same frames around names of no licence.  A second,
one-dimensional logistic regression on variants and paragraphs kept out of
training calibrates the log-odds of being known.

The classifier decides: a paragraph is of the family it names, or ``unknown``
if the calibrated probability is below ``threshold``.  Templates confirm: a
prediction is confirmed when enough three-word runs of some template of its
family stand in the paragraph.  All steps are DataFrame operations and
``pyspark.ml``; no Python runs on rows.

Defined cases: null and blank texts, and texts in which no paragraph is named
or has a licence word, have a null family; repeated rows each return the result
of their (id, text), in which no paragraph counts twice; a very long text is
searched whole;
ties between families go to the higher probability, then to the earlier
paragraph; ids may be null; extra columns, whatever their names, are ignored;
empty tables give an empty result, and a corpus without lines trains against
the built-in sentences.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_, or_

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import materialise, small_side, split_words, text_key, unit_hash

# Notices and characteristic paragraphs of common licences, fixed values.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software.",
    ],
    "gpl-2.0": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or any later "
        "version.",
    ],
    "lgpl-2.1": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version.",
    ],
    "lgpl-3.0": [
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version.",
    ],
    "agpl-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version.",
    ],
    "bsd-2-clause": [
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer.",
    ],
    "bsd-3-clause": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "bsl-1.0": [
        "Distributed under the Boost Software License, Version 1.0.",
    ],
    "epl-2.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0.",
    ],
    "zlib": [
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software.",
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain.",
    ],
    "cc0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work under CC0 1.0 Universal.",
    ],
    "cc-by-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-sa-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc-by-nc-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
}
# Usual names of the licences, fixed values.
NAMES = {
    "apache-2.0": ["Apache License 2.0", "Apache-2.0", "Apache licence, version 2.0"],
    "mit": ["MIT License", "MIT", "MIT licence", "X11 MIT license"],
    "gpl-2.0": ["GNU General Public License version 2", "GPL-2.0", "GPL-2.0-only", "GPL v2"],
    "gpl-3.0": ["GNU General Public License version 3", "GPL-3.0", "GPL-3.0-or-later", "GPL v3"],
    "lgpl-2.1": ["GNU Lesser General Public License version 2.1", "LGPL-2.1", "LGPL-2.1-or-later", "LGPL v2.1"],
    "lgpl-3.0": ["GNU Lesser General Public License version 3", "LGPL-3.0", "LGPL v3"],
    "agpl-3.0": ["GNU Affero General Public License version 3", "AGPL-3.0", "AGPL v3"],
    "bsd-2-clause": ["BSD 2-Clause License", "BSD-2-Clause", "Simplified BSD License"],
    "bsd-3-clause": ["BSD 3-Clause License", "BSD-3-Clause", "New BSD License"],
    "isc": ["ISC License", "ISC"],
    "mpl-2.0": ["Mozilla Public License 2.0", "MPL-2.0", "MPL 2.0"],
    "bsl-1.0": ["Boost Software License 1.0", "BSL-1.0"],
    "epl-2.0": ["Eclipse Public License 2.0", "EPL-2.0"],
    "zlib": ["zlib License", "Zlib"],
    "unlicense": ["Unlicense"],
    "cc0-1.0": ["CC0 1.0 Universal", "CC0-1.0"],
    "cc-by-4.0": ["CC BY 4.0", "CC-BY-4.0", "Creative Commons Attribution 4.0"],
    "cc-by-sa-4.0": ["CC BY-SA 4.0", "CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0"],
    "cc-by-nc-4.0": ["CC BY-NC 4.0", "CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0"],
}
FRAMES = ["Released under the {}.", "Licensed under the {}.", "This file is distributed under the terms of the {}.",
          "SPDX-License-Identifier: {}", "Licensed under {} or later.", "You may use this work under the {}."]
#: Names of no licence: the frames alone say nothing.
NO_NAMES = ["Foo License, Version 9", "house rules", "standard licence of the company", "terms of the contract",
            "new name", "same conditions as before", "Acme Public License 1.2", "licence of the city"]
PLAIN = ["The meeting was moved to the next week because of the weather.", "All of them are free to go on with it.",
         "The second version of the plan was better than the first.", "It is not known who may use this way.",
         "He renewed his driving licence last week.", "The copyright of the song was sold to a friend.",
         "The warranty of the fridge ran out before it broke.", "They gave permission to build the house.",
         "A fishing license is needed at this lake.", "The land was redistributed among the farmers."]
#: Licence words in sentences about other things.
PLAIN += [frame.replace("{}", w) for w in ("license", "licence", "copyright", "warranty", "permission", "licensed shop")
          for frame in ("The {} of the house is old.", "He asked for the {} again and was told to wait.",
                        "They talked there of the {} and of the weather of the week.", "Nobody had a {} for it.",
                        "It is the second {} of the year, so it is not the last of the {}.")]
#: A line with one of these words is kept as ``unknown`` if the classifier names no licence in it.
CUES = (r"licen[cs]e|copyright|warrant(?:y|ies)|redistribut|permission|creative commons|public domain|spdx|"
        r"\bcc[ -]?(?:by|0)\b|\b[al]?gpl\b|free of charge")
#: Each match of ``CUES`` holds one of these, which are found faster.
CUE_PARTS = ("licen", "copyright", "warrant", "redistribut", "permission", "creative commons", "public domain", "spdx",
             "ccby", "cc by", "cc-by", "cc0", "cc 0", "cc-0", "gpl", "free of charge")
#: Between words, also the full stop at the end of one.
SEPARATORS = r"[^\p{L}\p{N}.+-]+|[.](?=\s|$)"
FEATURES = 1 << 13
#: Corpus paragraphs sampled as class ``unknown`` at most.
MAX_UNKNOWN = 2_000
SHARED = 3
CONFIRM = 0.6
UNKNOWN = "unknown"


def _words(text: Column) -> Column:
    return split_words(F.lower(text), SEPARATORS)


def _grams(words: Column, n: int) -> Column:
    parts = [F.slice(words, k + 1, F.greatest(F.size(words) - (n - 1), F.lit(0))) for k in range(n)]
    return reduce(lambda a, b: F.zip_with(a, b, lambda x, y: F.concat(x, F.lit(" "), y)), parts)


def _template_frame(spark: SparkSession, templates: dict[str, list[str]]) -> DataFrame:
    rows = [(f, f"{f}/{i}", t) for f, ts in sorted(templates.items()) for i, t in enumerate(ts)]
    df = spark.createDataFrame(rows, "family string, template string, line string").withColumn("w", _words(F.col("line")))
    # a template shorter than a run is one run
    return df.withColumn("runs", F.array_distinct(F.when(F.size("w") < SHARED, F.array(F.concat_ws(" ", "w")))
                                                  .otherwise(_grams(F.col("w"), SHARED))))


def _features(df: DataFrame) -> DataFrame:
    return df.withColumn("grams", F.concat(F.col("w"), _grams(F.col("w"), 2)))


def _wrapped(texts: DataFrame, runs: DataFrame, longest_gap: int) -> DataFrame:
    """(doc_id, text_key, paragraph, last, line, w, of_family): stretches of
    one family's wording that cover more than one line of ``texts``.  ``runs``:
    (run, of_family)."""
    key = ["doc_id", "text_key"]
    lines = texts.select(*key, F.posexplode(F.split("text", "\n", -1)).alias("paragraph", "line"))
    lines = lines.withColumn("w", _words(F.regexp_replace("line", r"^[^\p{L}\p{N}]+", "")))
    blank = (F.size("w") == 0).cast("int")
    lines = lines.withColumn("block", F.sum(blank).over(Window.partitionBy(*key).orderBy("paragraph")))
    blocks = (lines.filter(F.size("w") > 0).groupBy(*key, "block")
              .agg(F.array_sort(F.collect_list(F.struct("paragraph", "w"))).alias("ls")).filter(F.size("ls") > 1))
    blocks = blocks.select(*key, "block", F.flatten(F.col("ls.w")).alias("all"), F.flatten(F.transform(
        "ls", lambda s: F.array_repeat(s["paragraph"], F.size(s["w"])))).alias("at"))
    hits = (blocks.select(*key, "block", F.posexplode(_grams(F.col("all"), SHARED)).alias("pos", "run"))
            .join(runs, "run").select(*key, "block", "pos", "of_family").distinct())
    stretch = [*key, "block", "of_family"]
    ordered = Window.partitionBy(*stretch).orderBy("pos")
    cut = F.coalesce(F.col("pos") - F.lag("pos").over(ordered) - SHARED > longest_gap, F.lit(False))
    hits = hits.withColumn("cut", cut.cast("int")).withColumn("part", F.sum("cut").over(ordered))
    found = hits.groupBy(*stretch, "part").agg(F.min("pos").alias("lo"), (F.max("pos") + SHARED).alias("hi"))
    b = blocks.select(F.col("doc_id").alias("bid"), F.col("text_key").alias("btk"), F.col("block").alias("bb"), "all", "at")
    found = found.join(b, F.col("doc_id").eqNullSafe(F.col("bid")) & (F.col("text_key") == F.col("btk"))
                       & (F.col("block") == F.col("bb")))
    w = F.slice("all", F.col("lo") + 1, F.col("hi") - F.col("lo"))
    return (found.select(*key, F.get("at", F.col("lo")).alias("paragraph"), F.get("at", F.col("hi") - 1).alias("last"),
                         F.array_join(w, " ").alias("line"), w.alias("w"), "of_family")
            .filter(F.col("last") > F.col("paragraph")))


def _paragraphs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    # the key of a text is computed below the generator, once a text and not once a line
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), text_key(F.col(text_col)).alias("text_key"))
    src = src.select("doc_id", "text_key", F.posexplode(F.split("text", "\n", -1)).alias("paragraph", "line"))
    return src.filter(F.length(F.btrim(F.col("line"), F.lit(" \t\x0b\f\r"))) > 0)


class LicenseModel:
    """The trained classifier with its calibration."""

    def __init__(self, pipeline: PipelineModel, calibration: LogisticRegressionModel | None):
        self.pipeline, self.calibration = pipeline, calibration

    def predict(self, paragraphs: DataFrame) -> DataFrame:
        """``paragraphs`` (with words w) plus family, p_family, p_known."""
        names = self.pipeline.stages[0].labels
        # of the model's columns only the probabilities are used, so the others are not made
        classifier = self.pipeline.stages[2].copy().setRawPredictionCol("").setPredictionCol("")
        out = classifier.transform(self.pipeline.stages[1].transform(_features(paragraphs)))
        out = out.withColumn("p", vector_to_array("probability"))
        unknown = names.index(UNKNOWN)
        known = [i for i in range(len(names)) if i != unknown]
        best = F.array_max(F.array(*[F.struct(F.col("p")[i].alias("p"), F.lit(names[i]).alias("f")) for i in known]))
        out = out.withColumn("best", best).withColumn("raw", _log_odds(F.col("p")[unknown]))
        if self.calibration is None:
            calibrated = 1 - F.col("p")[unknown]
        else:
            slope, bias = float(self.calibration.coefficients[0]), float(self.calibration.intercept)
            calibrated = 1 / (1 + F.exp(-(F.lit(slope) * F.col("raw") + F.lit(bias))))
        return out.select(*paragraphs.columns, F.col("best.f").alias("family"), F.col("best.p").alias("p_family"),
                          calibrated.alias("p_known"))


def _log_odds(p_unknown: Column) -> Column:
    p = F.least(F.greatest(p_unknown, F.lit(1e-9)), F.lit(1 - 1e-9))
    return F.log((1 - p) / p)


def _sample_lines(paragraphs: DataFrame, most: int, first_share: float = 1.0) -> DataFrame:
    """At most ``most`` different lines, those of the smallest hashes.  Lines
    above a share of the hash range are left out before they are made distinct;
    the share grows until it holds enough lines, so the result does not depend
    on where it starts."""
    share = min(1.0, max(first_share, 1e-9))
    while True:
        few = paragraphs.select("line", unit_hash("line").alias("o")).filter(F.col("o") <= share).distinct()
        few = materialise(few.orderBy("o", "line").limit(most), "license-lines")
        if share >= 1.0 or few.count() >= most:
            return few.select("line")
        share = min(1.0, share * 32)


def _notices(spark: SparkSession, templates: dict[str, list[str]], names: dict[str, list[str]]) -> DataFrame:
    """(family, line): templates, and names in the usual sentences; around
    names of no licence the sentences are ``unknown``."""
    rows = [(f, t) for f, ts in sorted(templates.items()) for t in ts]
    rows += [(f, frame.format(n)) for f, ns in sorted(names.items()) for n in ns for frame in FRAMES]
    rows += [(UNKNOWN, frame.format(n)) for n in NO_NAMES for frame in FRAMES]
    return spark.createDataFrame(rows, "family string, line string")


def train_model(spark: SparkSession, paragraphs: DataFrame, templates: dict[str, list[str]] = TEMPLATES,
                max_unknown: int = MAX_UNKNOWN, names: dict[str, list[str]] = NAMES,
                first_share: float = 1.0) -> LicenseModel:
    """``paragraphs``: corpus paragraphs (line) to sample the unknown class
    from, those without licence wording."""
    notices = _notices(spark, templates, {f: n for f, n in names.items() if f in templates})
    notices = notices.withColumn("w", _words(F.col("line")))
    # variants: every run of a quarter of the words of a notice left out; names must stay whole
    tmpl = notices.filter((F.size("w") > 10) & (F.col("family") != UNKNOWN))
    cut = F.greatest(F.floor(F.size("w") / 4).cast("int"), F.lit(1))
    variants = tmpl.withColumn("cut", cut).withColumn(
        "at", F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - F.col("cut"), F.lit(0)))))
    variants = variants.select("family", F.concat(F.slice("w", F.lit(1), F.col("at")),
                                                  F.slice("w", F.col("at") + F.col("cut") + 1, F.size("w"))).alias("w"))
    known = notices.select("family", "w").union(variants).filter(F.size("w") > 0)
    plain = spark.createDataFrame([(x,) for x in PLAIN], "line string")
    sample = _sample_lines(paragraphs, max_unknown, first_share)
    sample = sample.filter(~F.rlike(F.lower("line"), F.lit(CUES))).union(plain)
    unknown = sample.select(F.lit(UNKNOWN).alias("family"), _words(F.col("line")).alias("w"))
    # wording that several families share names none of them
    for n in (3, 5):
        shared = (tmpl.select("family", F.explode(_grams(F.col("w"), n)).alias("run")).groupBy("run")
                  .agg(F.countDistinct("family").alias("n")).where("n > 1"))
        unknown = unknown.union(shared.select(F.lit(UNKNOWN), F.split("run", " ")))
    rows = _features(known.union(unknown.filter(F.size("w") > 0))).withColumn(
        "held", unit_hash(F.lit("held"), "family", "w") < 0.2)
    rows = materialise(rows.withColumn("weight", F.lit(1.0)), "license-train")
    sizes = {r["family"]: r["count"] for r in rows.groupBy("family").count().collect()}      # one row per family
    total = sum(sizes.values())
    weight = F.create_map(*[x for f, n in sizes.items() for x in (F.lit(f), F.lit(total / (len(sizes) * n)))])
    rows = rows.withColumn("weight", weight[F.col("family")])
    pipeline = Pipeline(stages=[
        StringIndexer(inputCol="family", outputCol="label", handleInvalid="keep", stringOrderType="alphabetAsc"),
        HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True),
        LogisticRegression(weightCol="weight", regParam=0.002, maxIter=40, family="multinomial")])
    # the notices themselves are never held out, so every family is trained
    train = rows.filter(~F.col("held")).unionByName(
        _features(notices.select("family", "w")).withColumn("held", F.lit(False)).withColumn("weight", F.lit(1.0)))
    model = LicenseModel(pipeline.fit(train.coalesce(4)), None)      # a few thousand bounded rows
    names = model.pipeline.stages[0].labels
    held = model.pipeline.transform(rows.filter("held")).withColumn("p", vector_to_array("probability"))
    held = held.select(_log_odds(F.col("p")[names.index(UNKNOWN)]).alias("raw"),
                       (F.col("family") != UNKNOWN).cast("double").alias("label"))
    if held.agg(F.countDistinct("label")).first()[0] == 2:
        held = VectorAssembler(inputCols=["raw"], outputCol="features").transform(held)
        model.calibration = LogisticRegression(regParam=0.01, maxIter=50).fit(held)
    return model


def _has_cue(lower: Column) -> Column:
    return reduce(or_, [F.contains(lower, F.lit(c)) for c in CUE_PARTS]) & F.rlike(lower, F.lit(CUES))


def _once(df: DataFrame, column: Column, name: str) -> DataFrame:
    """``df`` with a column that no later filter computes anew: a filter is not
    moved below a generator."""
    return df.select("*", F.explode(F.array(column)).alias(name))


def _hold_runs(texts: DataFrame, runs: list[str]) -> DataFrame:
    """The rows of ``texts`` whose words, across line ends, hold any of the
    ``runs``, a bounded list.  Most words begin no run, so words are looked up
    first, and a run is joined only where each of its words can stand there."""
    w = F.flatten(F.transform(F.split("text", "\n", -1),
                              lambda line: _words(F.regexp_replace(line, r"^[^\p{L}\p{N}]+", ""))))
    parts = [p for p in (run.split(" ") for run in runs) if len(p) == SHARED]       # shorter ones are no runs of a text

    def begins_run(word: Column, i: Column) -> Column:
        words = [word] + [F.get("w", i + k) for k in range(1, SHARED)]
        fits = [w.isin(sorted({p[k] for p in parts})) for k, w in enumerate(words)]
        return reduce(and_, fits) & F.concat_ws(" ", *words).isin([" ".join(p) for p in parts])

    return _once(texts, w, "w").filter(F.size(F.filter("w", begins_run)) > 0).select(*texts.columns)


def scan(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES, threshold: float = 0.5,
         confirm: float = CONFIRM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All paragraphs of all texts go through the classifier.  Those that it
    names, stretches of several lines, and lines with a licence word: doc_id,
    text_key, paragraph (its first line), last (its last line), line, family,
    p_family, p_known, template, containment, confirmed.  ``family`` is
    ``unknown`` below ``threshold``.  A stretch counts only for the family
    whose wording it was cut by."""
    spark = docs.sparkSession
    paragraphs = _paragraphs(docs, id_col, text_col)
    tmpl = materialise(_template_frame(spark, templates), "license-templates")
    owned = materialise(tmpl.select(F.explode("runs").alias("run"), F.col("family").alias("of_family")).distinct(),
                        "license-owned")
    rows = docs.count()
    model = train_model(spark, paragraphs, templates, first_share=4 * MAX_UNKNOWN / max(rows, 1))
    kept = ["doc_id", "text_key", "paragraph", "last", "line", "w", "of_family", "family", "p_family", "p_known"]
    lines = _once(paragraphs, _words(F.col("line")), "w").withColumn("last", F.col("paragraph")).withColumn(
        "of_family", F.lit(None).cast("string"))
    lines = _once(model.predict(lines), F.struct("family", "p_family", "p_known"), "found")
    lines = _once(lines, F.lower("line"), "low")
    lines = lines.filter((F.col("found.p_known") >= threshold) | _has_cue(F.col("low")))
    lines = lines.select(*kept[:7], "found.*").distinct()       # repeated rows have the same paragraphs
    texts = docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("text_key"),
                        F.col(text_col).alias("text"))
    runs = sorted({r["run"] for r in owned.select("run").collect()})       # parameters only
    texts = materialise(_hold_runs(texts, runs).distinct(), "license-texts")
    longest = max((len(t.split()) for ts in templates.values() for t in ts), default=0)
    wrapped = materialise(_wrapped(texts, small_side(owned), math.ceil((1 - confirm) * longest)), "license-wrapped")
    wrapped = model.predict(wrapped).filter(F.col("of_family") == F.col("family"))
    found = materialise(lines.unionByName(wrapped.select(*kept)), "license-paragraphs")
    by_family = tmpl.groupBy("family").agg(F.collect_list(F.struct("template", "runs")).alias("ts"))   # parameters only
    found = found.withColumn("own", _grams(F.col("w"), SHARED)).join(F.broadcast(by_family), "family")
    best = F.array_max(F.transform("ts", lambda t: F.struct(
        (F.size(F.array_intersect("own", t["runs"])) / F.size(t["runs"])).alias("c"), t["template"].alias("t"))))
    found = found.withColumn("best", best)
    known = F.col("p_known") >= threshold
    return found.select("doc_id", "text_key", "paragraph", "last", "line",
                        F.when(known, F.col("family")).otherwise(UNKNOWN).alias("family"), "p_family", "p_known",
                        F.col("best.t").alias("template"), F.col("best.c").alias("containment"),
                        (known & (F.col("best.c") >= confirm)).alias("confirmed"))


def document_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """Per row: doc_id, family (of the best confirmed paragraph, else of the
    best one; ``unknown`` if the classifier names none, null without licence
    words), probability, containment, paragraph, confirmed, n_licenses
    (confirmed paragraphs; a wrapped stretch counts once, and not besides its
    own confirmed lines)."""
    found = materialise(scan(docs, id_col=id_col, text_col=text_col, **kw), "license-found")
    lines = found.filter((F.col("last") == F.col("paragraph")) & F.col("confirmed")).select(
        F.col("doc_id").alias("lid"), F.col("text_key").alias("ltk"), F.col("family").alias("lf"),
        F.col("paragraph").alias("lp"))
    wrapped = found.filter(F.col("last") > F.col("paragraph")).join(
        lines, F.col("doc_id").eqNullSafe(F.col("lid")) & (F.col("text_key") == F.col("ltk"))
        & (F.col("family") == F.col("lf")) & F.col("lp").between(F.col("paragraph"), F.col("last")), "left_anti")
    found = found.filter(F.col("last") == F.col("paragraph")).unionByName(wrapped)
    rank = F.struct("confirmed", (F.col("family") != UNKNOWN).alias("named"), "p_known",
                    (-F.col("paragraph")).alias("first"), "family", "containment", "paragraph")
    per = found.groupBy("doc_id", "text_key").agg(F.max(rank).alias("b"), F.count_if("confirmed").alias("n"))
    per = per.select(F.col("doc_id").alias("fid"), F.col("text_key").alias("ftk"), "b", "n")
    rows = docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("text_key"))
    return (rows.join(per, F.col("doc_id").eqNullSafe(F.col("fid")) & (F.col("text_key") == F.col("ftk")), "left")
            .select("doc_id", F.col("b.family").alias("family"), F.col("b.p_known").alias("probability"),
                    F.col("b.containment").alias("containment"), F.col("b.paragraph").alias("paragraph"),
                    F.coalesce("b.confirmed", F.lit(False)).alias("confirmed"),
                    F.coalesce("n", F.lit(0)).cast("long").alias("n_licenses")))
