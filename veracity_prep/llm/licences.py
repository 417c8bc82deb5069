"""Licences of files: sparse TF-IDF cosine to templates, and inheritance from the nearest ancestor directory.

Runs of lines that hold a licence word, anywhere in a text, are its notices; a file is a licence file if its name
says so or if more than half of its text is notices, and then its whole text is compared. Terms are weighted by
IDF over all notices; the cosine to each template is a sum over shared terms only. The best template from
``COSINE`` on is the file's own licence. A licence file governs its directory: files without a licence of their own
take that of the nearest ancestor directory that has one. Directories are resolved first, once each, so a directory
that holds a third of all files is one row when ancestors are joined.

Templates are one-sentence notices and the full texts in ``licence_texts``. They and their terms are fixed and small and
alone are broadcast; the document frequencies of all terms are joined in ``SALTS`` copies, so that no term is one task. All of it is DataFrame work.

Nulls and edge cases: null and empty texts have no notices; a null path has no directory and inherits nothing; of
equal cosines the licence whose name sorts first wins; repeated rows come back each. Extra columns are ignored.
"""

from __future__ import annotations

import pkgutil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veracity_prep.llm.shared import cut

COSINE = 0.6
SALTS = 16
CUES = r"(?i)licen[sc]e|copyright|permission is hereby|redistribution|spdx-|warrant(?:y|ies)|public domain|all rights reserved"
FILE_NAME = r"(?i)(?:^|/)(?:licen[sc]e|copying|copyright|unlicense)[^/]*$"

#: Fixed texts: notices by which the licences are stated.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights and dedicated this work to the public domain under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved. No part may be reproduced without written permission."),
)

#: Licences whose full text is in ``licence_texts``.
FULL_TEXTS = ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-SA-4.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0")


def terms_of(text: Column) -> Column:
    """Lower-case words and numbers of a text."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[a-z0-9][a-z0-9.]*[a-z0-9]|[a-z0-9]"), F.lit(0))


def templates(spark: SparkSession) -> DataFrame:
    whole = [(name, pkgutil.get_data(__package__, f"licence_texts/{name}.txt").decode()) for name in FULL_TEXTS]
    rows = [(k, name, text) for k, (name, text) in enumerate([*TEMPLATES, *whole])]
    return spark.createDataFrame(rows, "template int, licence string, notice string")


def notices(files: DataFrame) -> DataFrame:
    """``id, path, row, notice, whole``: each notice of each file; of a licence file its whole text."""
    cued = lambda line: line.rlike(CUES)
    lines = files.where(F.col("text").rlike(CUES)).withColumn("lines", F.split("text", "\n"))
    # A line that has no cue ends a run: it is turned into the separator.
    marked = F.array_join(F.transform("lines", lambda x: F.when(cued(x), F.concat(x, F.lit(" "))).otherwise("\x00")), "")
    runs = F.filter(F.split(marked, "\x00+"), lambda x: F.length(F.trim(x)) > 0)
    found = lines.withColumn("runs", runs)
    long_ = F.aggregate("runs", F.lit(0), lambda s, x: s + F.length(x))
    whole = F.coalesce(F.col("path").rlike(FILE_NAME), F.lit(False)) | (long_ * 2 > F.length("text"))
    return found.withColumn("whole", whole).select("row", "path", "whole", F.posexplode(F.when(F.col("whole"), F.array("text")).otherwise(F.col("runs"))).alias("n", "notice"))


def own_licences(files: DataFrame) -> DataFrame:
    """``row, path, whole, licence, score`` of the files with a licence of their own."""
    spark = files.sparkSession
    found = notices(files).select("row", "path", "whole", "n", F.explode(terms_of(F.col("notice"))).alias("term"))
    found = cut(found.groupBy("row", "path", "whole", "n", "term").agg(F.count("*").alias("tf")), "notice-terms")
    total = found.select("row", "n").distinct().count()
    texts = templates(spark).select("template", "licence", F.explode(terms_of(F.col("notice"))).alias("term"))
    texts = texts.groupBy("template", "licence", "term").agg(F.count("*").alias("tf"))
    idf = F.log((F.lit(total) + 1) / (F.coalesce("df", F.lit(0)) + 1)) + 1
    held = cut(found.groupBy("term").agg(F.count("*").alias("df")), "notice-frequencies")
    copies = held.select("term", idf.alias("idf"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salt = F.pmod(F.xxhash64("row", "n"), F.lit(SALTS)).cast("int")
    weighed = found.withColumn("salt", salt).join(copies, ["term", "salt"]).withColumn("w", F.col("tf") * F.col("idf")).drop("salt")
    # The terms of the fixed templates: a few thousand rows.
    terms = F.broadcast(texts.select("term").distinct())
    weights = F.broadcast(terms.join(held.join(terms, "term", "left_semi"), "term", "left").select("term", idf.alias("idf")))
    lengths = weighed.groupBy("row", "n").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    sides = texts.join(weights, "term").withColumn("u", F.col("tf") * F.col("idf"))
    unit = sides.groupBy("template").agg(F.sqrt(F.sum(F.col("u") * F.col("u"))).alias("unit"))
    sides = F.broadcast(sides.join(F.broadcast(unit), "template").select("template", "licence", "term", (F.col("u") / F.col("unit")).alias("u")))
    dots = weighed.join(sides, "term").groupBy("row", "path", "whole", "n", "template", "licence").agg(F.sum(F.col("w") * F.col("u")).alias("dot"))
    scored = dots.join(lengths, ["row", "n"]).withColumn("score", F.round(F.col("dot") / F.col("length"), 6)).where(F.col("score") >= COSINE)
    best = scored.groupBy("row", "path", "whole").agg(F.min(F.struct((-F.col("score")).alias("less"), "licence")).alias("best"))
    return best.select("row", "path", "whole", F.col("best.licence").alias("licence"), (-F.col("best.less")).alias("score"))


def ancestors(directory: Column) -> Column:
    """A directory and all above it, nearest first, each with its distance."""
    parts = F.split(directory, "/")
    return F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda k: F.struct(k.alias("up"), F.array_join(F.slice(parts, F.lit(1), F.size(parts) - k), "/").alias("above")))


def licences(files: DataFrame) -> DataFrame:
    """For each row of ``files`` (id, path, text): id, path, licence (null if none), basis (``own`` or ``inherited``), score."""
    rows = cut(files.select("id", "path", F.xxhash64("id", "path", "text").alias("row")), "files")
    own = cut(own_licences(files.select("path", "text", F.xxhash64("id", "path", "text").alias("row")).distinct()), "own-licences")
    folder = F.when(F.col("path").contains("/"), F.regexp_extract("path", "^(.*)/", 1)).when(F.col("path").isNotNull(), F.lit(""))
    governed = own.where("whole").withColumn("above", folder).where("above is not null")
    governed = governed.groupBy("above").agg(F.min(F.struct((-F.col("score")).alias("less"), "licence")).alias("best")).select("above", F.col("best.licence").alias("licence"))
    folders = rows.select(folder.alias("folder")).where("folder is not null").distinct()
    climbed = folders.select("folder", F.inline(ancestors(F.col("folder")))).join(governed, "above")
    inherited = climbed.groupBy("folder").agg(F.min(F.struct("up", "licence")).alias("best")).select("folder", F.col("best.licence").alias("from_folder"))
    out = rows.join(own.select("row", "licence", "score").distinct(), "row", "left").withColumn("folder", folder).join(inherited, "folder", "left")
    basis = F.when(F.col("licence").isNotNull(), "own").when(F.col("from_folder").isNotNull(), "inherited")
    return out.select("id", "path", F.coalesce("licence", "from_folder").alias("licence"), basis.alias("basis"), "score")
