"""Licence scans by a trained paragraph classifier (native).

A multinomial logistic regression over sparse word n-grams (words and pairs) tells
licence families from each other and from ordinary text. It is trained in Spark on
phrases built from the notices below and, for the class ``unknown``, on a bounded
sample of paragraphs of the given documents, as they are and with a word of licence
notices put before them. A temperature, chosen on a part of these rows that training
does not see, calibrates the probabilities. A prediction counts only if a notice of
its family is found: the paragraph must hold ``OVERLAP`` of the pairs of one of the
family's ``CORES`` or ``NOTICES``, and of a core all words and pairs that tell the family.

A notice may be a line of its own or wrapped: each line with a word of ``MARKS`` is
looked at alone and together with its neighbours up to a blank line, ``LINES_BEFORE``
and ``LINES_AFTER`` at most. Every notice has such a word; lines far from one are
``unknown`` without being looked at further. Neighbouring hits of one family are one
notice if they come from joined lines.

Defined results: a null or empty text has no paragraphs; repeated rows keep rows of
their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, NGram, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.llm.common import lower_ascii, row_key
from tallywatch.session import written

UNKNOWN = "unknown"
OVERLAP = 0.75
LEAST_PROBABILITY = 0.5
SAMPLE_PARAGRAPHS = 3000
SAMPLE_WORDS = 40
TEMPERATURES = (0.25, 0.5, 1.0, 2.0, 4.0)
MARKS = ("license", "licensed", "licence", "licenced", "rights", "permission", "redistribution", "unlicense", "spdx", "copyright", "copying", "gpl", "gplv2", "gplv3", "lgpl", "agpl", "agplv3", "cc0", "cc", "creativecommons", "unencumbered")
LINES_BEFORE = 4
LINES_AFTER = 6
WORDS_BESIDE = 60
WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Short notices of public licences.
NOTICES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "You may not use this file except in compliance with the License. You may obtain a copy of the License at apache.org licenses LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
        "SPDX-License-Identifier: GPL-3.0-only",
    ],
    "gpl-2.0": [
        "This work is licensed under the GNU General Public License, version 2",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
        "SPDX-License-Identifier: GPL-2.0-only",
    ],
    "lgpl": [
        "Licensed under the GNU Lesser General Public License",
        "SPDX-License-Identifier: LGPL-3.0-only",
    ],
    "bsd": [
        "Licensed under the BSD License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by-4.0": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "cc-by-sa-4.0": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "cc-by-nc-4.0": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "agpl-3.0": [
        "Licensed under the GNU Affero General Public License, version 3",
        "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "gpl": ["Licensed under the GNU General Public License", "Released under the GPL"],
    "isc": [
        "Released under the ISC License",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice",
        "SPDX-License-Identifier: ISC",
    ],
    "epl-2.0": ["made available under the terms of the Eclipse Public License 2.0", "SPDX-License-Identifier: EPL-2.0"],
    "cc0-1.0": ["Released under CC0 1.0 Universal", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work", "SPDX-License-Identifier: CC0-1.0"],
    "zlib": ["Released under the zlib License", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely"],
    "bsl-1.0": ["Distributed under the Boost Software License, Version 1.0", "SPDX-License-Identifier: BSL-1.0"],
    "cc-by-nd-4.0": ["Licensed under CC BY-ND 4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "cc-by-nc-sa-4.0": ["Licensed under CC BY-NC-SA 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"],
    "unlicense": ["This is free and unencumbered software released into the public domain. Unlicense"],
    "all-rights-reserved": ["All rights reserved", "Copyright. All rights reserved"],
}
# The distinctive part of usual wordings, and the words and pairs of it that must be there.
CORES = {
    "apache-2.0": [("Apache License Version 2.0", "apache license, 2 0"), ("Apache License 2.0", "apache license, 2 0"), ("Apache 2.0 License", "apache 2"), ("Apache-2.0", "apache 2")],
    "mit": [("MIT License", "mit license"), ("MIT licensed", "mit licensed"), ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "hereby granted, any person")],
    "gpl-3.0": [("GNU General Public License version 3", "gnu general, version 3"), ("GNU General Public License v3", "gnu general, license v3"), ("GNU General Public License 3.0", "gnu general, license 3"),
                ("GPL version 3", "gpl version, version 3"), ("GPL v3", "gpl v3"), ("GPL-3.0", "gpl 3"), ("GPLv3", "gplv3"), ("GNU GPL 3", "gpl 3"),
                ("GNU General Public License as published by the Free Software Foundation either version 3", "gnu general, version 3")],
    "gpl-2.0": [("GNU General Public License version 2", "gnu general, version 2"), ("GNU General Public License v2", "gnu general, license v2"), ("GNU General Public License 2.0", "gnu general, license 2"),
                ("GPL version 2", "gpl version, version 2"), ("GPL v2", "gpl v2"), ("GPL-2.0", "gpl 2"), ("GPLv2", "gplv2"), ("GNU GPL 2", "gpl 2"),
                ("GNU General Public License as published by the Free Software Foundation either version 2", "gnu general, version 2")],
    "gpl": [("GNU General Public License", "gnu general, public license"), ("under the GPL", "the gpl"), ("GPL License", "gpl license")],
    "agpl-3.0": [("GNU Affero General Public License", "affero general"), ("AGPL-3.0", "agpl 3"), ("AGPLv3", "agplv3"), ("under the AGPL", "the agpl")],
    "lgpl": [("GNU Lesser General Public License", "lesser general"), ("GNU Library General Public License", "library general"), ("under the LGPL", "lgpl"), ("LGPL License", "lgpl")],
    "bsd": [("BSD License", "bsd license"), ("BSD 3-Clause License", "bsd 3"), ("BSD 2-Clause License", "bsd 2"), ("3-Clause BSD License", "bsd license"), ("BSD-style license", "bsd style"), ("Redistribution and use in source and binary forms, with or without modification, are permitted", "redistribution, binary forms")],
    "mpl-2.0": [("Mozilla Public License", "mozilla public, public license"), ("MPL-2.0", "mpl 2"), ("MPL 2.0 License", "mpl 2")],
    "isc": [("ISC License", "isc license"), ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee", "permission to, without fee")],
    "epl-2.0": [("Eclipse Public License 2.0", "eclipse public, public license"), ("Eclipse Public License v 2.0", "eclipse public, public license"), ("EPL-2.0", "epl 2")],
    "cc0-1.0": [("CC0 1.0", "cc0"), ("Creative Commons Zero", "commons zero"), ("CC0", "cc0"), ("waived all copyright and related or neighboring rights", "waived all, related or")],
    "zlib": [("zlib License", "zlib license"), ("Permission is granted to anyone to use this software for any purpose including commercial applications", "to anyone, commercial applications")],
    "bsl-1.0": [("Boost Software License", "boost software, software license"), ("BSL-1.0", "bsl 1")],
    "cc-by-4.0": [("CC BY 4.0", "cc by, by 4"), ("Creative Commons Attribution 4.0", "commons attribution, attribution 4")],
    "cc-by-sa-4.0": [("CC BY-SA 4.0", "cc by, by sa"), ("Creative Commons Attribution ShareAlike 4.0", "commons attribution, attribution sharealike"), ("Creative Commons Attribution Share Alike 4.0", "commons attribution, attribution share")],
    "cc-by-nc-4.0": [("CC BY-NC 4.0", "cc by, by nc, nc 4"), ("Creative Commons Attribution NonCommercial 4.0", "attribution noncommercial, noncommercial 4")],
    "cc-by-nd-4.0": [("CC BY-ND 4.0", "cc by, by nd"), ("Creative Commons Attribution NoDerivatives 4.0", "attribution noderivatives")],
    "cc-by-nc-sa-4.0": [("CC BY-NC-SA 4.0", "cc by, by nc, nc sa"), ("Creative Commons Attribution NonCommercial ShareAlike 4.0", "attribution noncommercial, noncommercial sharealike")],
    "unlicense": [("free and unencumbered software released into the public domain", "unencumbered software"), ("The Unlicense", "the unlicense")],
    "all-rights-reserved": [("All rights reserved", "rights reserved")],
}
# Words put around notices for training.
FRAMES = ("{}", "{}.", "Licensed under the {}", "Released under the terms of the {}.", "The {} applies.", "This text: {}", "{} and its terms.", "Copyright the authors. {}", "Note: {}.")


def words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(text), WORD_GAP), "")


def beside(lines: Column) -> Column:
    """The lines up to the first blank one."""
    blank = F.array_position(F.transform(lines, lambda x: F.trim(F.translate(x, "\t\r", "  ")) == ""), True)
    return F.when(blank > 0, F.slice(lines, 1, F.greatest(blank - 1, F.lit(0)).cast("int"))).otherwise(lines)


def paragraphs(documents: DataFrame) -> DataFrame:
    """``doc_id, key, nth, wrapped, words``: the lines with a word of ``MARKS``, alone and joined with their neighbours."""
    marked = F.coalesce(F.col("text"), F.lit("")).rlike(r"(?i)\b(" + "|".join(MARKS) + r")\b")
    lines, nth = F.col("lines"), F.col("nth")
    start = F.greatest(nth - LINES_BEFORE + 1, F.lit(1))
    before = F.reverse(beside(F.reverse(F.slice(lines, start, nth + 1 - start))))
    after = beside(F.slice(lines, nth + 2, F.lit(LINES_AFTER)))
    found = (
        documents.select("doc_id", "text", row_key(F.col("doc_id"), F.col("text")).alias("key"))
        .filter(marked)
        .select("doc_id", "key", F.split("text", "\n").alias("lines"))
        .select("doc_id", "key", "lines", F.posexplode("lines").alias("nth", "said"))
        .filter(F.col("said").rlike(r"(?i)(" + "|".join(MARKS) + ")"))
        .withColumn("words", words(F.col("said")))
        .filter(F.arrays_overlap("words", F.array(*map(F.lit, MARKS))))
        .select("doc_id", "key", "nth", "words", words(F.concat_ws("\n", before)).alias("ahead"), words(F.concat_ws("\n", after)).alias("behind"))
    )
    ahead = F.slice("ahead", F.greatest(F.size("ahead") - WORDS_BESIDE + 1, F.lit(1)), F.lit(WORDS_BESIDE))
    whole = F.concat(ahead, "words", F.slice("behind", 1, WORDS_BESIDE))
    # The line with what follows, too: a header above a notice tells nothing of it.
    forms = F.array(
        F.struct(F.lit(False).alias("wrapped"), F.col("words").alias("words")),
        F.struct(F.lit(True).alias("wrapped"), whole.alias("words")),
        F.struct(F.lit(True).alias("wrapped"), F.concat("words", F.slice("behind", 1, WORDS_BESIDE)).alias("words")),
    )
    return found.select("doc_id", "key", "nth", F.inline(F.array_distinct(forms)))


def notice_table(spark: SparkSession) -> DataFrame:
    """``family, words, pairs, needed`` of every notice and core."""
    rows = [(family, notice, "") for family, notices in NOTICES.items() for notice in notices if family not in ("gpl-3.0", "gpl-2.0") or "SPDX" in notice]
    rows += [(family, core, needed) for family, cores in CORES.items() for core, needed in cores]
    said = spark.createDataFrame(rows, "family string, notice string, needed string").withColumn("words", words(F.col("notice")))
    needed = F.array_remove(F.split("needed", ", "), "")
    return said.select("family", "words", pairs(F.col("words")).alias("pairs"), needed.alias("needed"))


def pairs(said: Column) -> Column:
    """Distinct neighbouring pairs of words, the first and last word counted with the edges."""
    length = F.size(said)
    joined = F.transform(F.sequence(F.lit(1), F.greatest(length - 1, F.lit(1))), lambda i: F.concat_ws(" ", F.slice(said, i, F.lit(2))))
    return F.when(length > 0, F.array_distinct(joined)).otherwise(F.array().cast("array<string>"))


def training_rows(documents: DataFrame) -> DataFrame:
    """``family, words, held_out``: framed notices, and a bounded sample of ordinary paragraphs."""
    spark = documents.sparkSession
    rows = [(family, notice) for family, notices in NOTICES.items() for notice in notices]
    rows += [(family, core) for family, cores in CORES.items() for core, _ in cores]
    framed = spark.createDataFrame([(family, frame.format(notice)) for family, notice in rows for frame in FRAMES], "family string, said string")
    said = documents.select(F.explode(F.split(F.coalesce(F.col("text"), F.lit("")), "\n")).alias("said")).filter(F.length("said") > 20)
    known = r"(?i)\b(" + "|".join(MARKS) + r")\b"
    ordinary = said.filter(~F.col("said").rlike(known)).orderBy(F.xxhash64("said"), "said").limit(SAMPLE_PARAGRAPHS)
    mark = F.element_at(F.array(*map(F.lit, MARKS)), (F.pmod(F.xxhash64("said"), F.lit(len(MARKS))) + 1).cast("int"))
    start = F.slice(words(F.col("said")), 1, SAMPLE_WORDS)
    plain = ordinary.select(F.lit(UNKNOWN).alias("family"), F.explode(F.array(start, F.concat(F.array(mark), start), F.concat(F.array(F.lit("the"), mark, F.lit("of")), start))).alias("words"))
    everything = framed.select("family", words(F.col("said")).alias("words")).unionByName(plain)
    return everything.withColumn("held_out", F.pmod(F.xxhash64("words"), F.lit(5)) == 0)


def fit(rows: DataFrame) -> tuple[PipelineModel, list[str], float]:
    """The fitted model, its classes in order, and the temperature of least loss on held-out rows."""
    classes = [UNKNOWN, *NOTICES]
    number = F.array_position(F.array(*map(F.lit, classes)), F.col("family")) - 1
    labelled = rows.withColumn("label", number.cast("double"))
    steps = [
        NGram(n=2, inputCol="words", outputCol="two"),
        SQLTransformer(statement="SELECT *, concat(words, two) AS grams FROM __THIS__"),
        CountVectorizer(inputCol="grams", outputCol="counts", binary=True, minDF=2.0, vocabSize=20_000),
        VectorAssembler(inputCols=["counts"], outputCol="features"),
        LogisticRegression(maxIter=40, regParam=1e-3, elasticNetParam=0.1, family="multinomial"),
    ]
    model = Pipeline(stages=steps).fit(labelled.filter("not held_out"))
    scored = model.transform(labelled.filter("held_out")).withColumn("raw", vector_to_array("rawPrediction"))
    losses = scored.agg(*(F.avg(-F.log(F.element_at(softmax(F.col("raw"), t), (F.col("label") + 1).cast("int")) + 1e-12)).alias(str(k)) for k, t in enumerate(TEMPERATURES))).first()
    known = [(loss, t) for loss, t in zip(losses, TEMPERATURES, strict=True) if loss is not None]
    return model, classes, min(known)[1] if known else 1.0


def softmax(raw: Column, temperature: float) -> Column:
    scaled = F.transform(raw, lambda x: F.exp((x - F.array_max(raw)) / temperature))
    return F.transform(scaled, lambda x: x / F.aggregate(scaled, F.lit(0.0), lambda a, b: a + b))


def classified(documents: DataFrame) -> DataFrame:
    """``doc_id, key, nth, wrapped, family, probability, overlap`` of the paragraphs whose prediction a notice confirms."""
    spark = documents.sparkSession
    model, classes, temperature = fit(written(training_rows(documents), "licence-training").coalesce(4))
    found = written(paragraphs(documents), "licence-paragraphs")
    scored = model.transform(found.select("doc_id", "key", "nth", "wrapped", "words")).withColumn("chances", softmax(vector_to_array("rawPrediction"), temperature))
    best = F.array_max("chances")
    named = F.element_at(F.array(*map(F.lit, classes)), F.array_position("chances", best).cast("int"))
    predicted = scored.select("doc_id", "key", "nth", "wrapped", F.array_union(pairs(F.col("words")), F.col("words")).alias("pairs"), named.alias("family"), best.alias("probability"))
    likely = predicted.filter((F.col("family") != UNKNOWN) & (F.col("probability") >= LEAST_PROBABILITY))
    notices = notice_table(spark).groupBy("family").agg(F.collect_list(F.struct("pairs", "needed")).alias("notices"))
    overlap = F.array_max(F.transform("notices", lambda n: F.when(
        F.size(F.array_except(n["needed"], "pairs")) == 0, F.size(F.array_intersect(n["pairs"], "pairs")) / F.size(n["pairs"])
    ).otherwise(0.0)))
    return likely.join(notices, "family").withColumn("overlap", overlap).filter(F.col("overlap") >= OVERLAP).select(
        "doc_id", "key", "nth", "wrapped", "family", "probability", "overlap"
    )


def scan(documents: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, families, n_notices, probability``; families sorted and joined by commas."""
    # Rows that agree in id and text share a key and its notices.
    near = lambda a, b: F.abs(a["nth"] - b["nth"]) <= LINES_BEFORE + LINES_AFTER
    # A version found beside it says more than the bare name.
    found = classified(documents).groupBy("key").agg(F.collect_set(F.struct("family", "nth", "wrapped", "probability")).alias("all"))
    versions = F.filter("all", lambda b: b["family"].isin("gpl-2.0", "gpl-3.0"))
    specific = found.select("key", F.inline(F.filter("all", lambda a: (a["family"] != "gpl") | ~F.exists(versions, lambda b: near(a, b)))))
    # A joined hit counts if no line near it is a hit of its family, nor is the joined hit before it.
    counted = F.filter("places", lambda a: ~a["wrapped"] | ~F.exists("places", lambda b: near(a, b) & (~b["wrapped"] | (b["nth"] < a["nth"]))))
    hits = written(
        specific.groupBy("key", "family").agg(F.collect_set(F.struct("nth", "wrapped")).alias("places"), F.max("probability").alias("probability"))
        .select("key", "family", F.size(counted).alias("n"), "probability")
        .groupBy("key").agg(F.array_join(F.array_sort(F.collect_set("family")), ",").alias("families"), F.sum("n").alias("n_notices"), F.max("probability").alias("probability")),
        "licence-hits",
    )
    return documents.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key")).join(hits, "key", "left").select(
        "doc_id", F.coalesce("families", F.lit(UNKNOWN)).alias("families"), F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"), "probability"
    )
