"""Licences of files: TF-IDF cosines to templates, then inheritance from directories.

Each line of a file, and each file as a whole, is a sparse vector of its words' TF-IDF. A line
close to a template is a header: it gives the file its licence. A file close to a template as
a whole, or named as licence files are, gives its licence to its directory; files without a
header take that of the nearest directory above them. DataFrame functions only.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anchorline.llm.common import row_key, text_of
from anchorline.sources.staging import Staging

#: Cosines from which a line, a whole file, or one that is named as a licence, has the licence
#: of a template.
HEADER = 0.7
FILE = 0.5
NAMED = 0.4
#: What a licence file that is like no template gives itself and its folder.
UNKNOWN = "unknown"
#: What a word is. Numbers keep their points, so that versions are words.
TOKEN = r"[\p{L}0-9]+(?:\.[0-9]+)*"
#: Names of licence files.
FILE_NAMES = r"(?i)(^|/)(licen[cs]e|copying|unlicense)(\.[a-z]+)?$"

#: Notices by which public licences are applied to files, short and long.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files, to deal in the software without restriction",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
        "except in compliance with the License.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or any later version.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    (
        "CC-BY-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    (
        "CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License.",
    ),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose"),
]

KEY = ["doc_id", "key_a", "key_b"]


def words_of(text: str) -> list[str]:
    """The words of a template, as TOKEN has them."""
    return re.findall(TOKEN.replace(r"\p{L}", "a-z"), text.lower())


VOCABULARY = sorted({w for _, text in TEMPLATES for w in words_of(text)})


@dataclass(frozen=True)
class Weights:
    """Inverse document frequencies over the corpus, and the templates' unit vectors."""

    idf: dict[str, float]
    rarest: float
    vectors: list[dict[str, float]]

    def telling(self) -> list[str]:
        """Words without any of which no line or file is close to a template.

        Of each template the heaviest words, until the rest has a length below the lower
        limit: what shares only the rest has a smaller cosine.
        """
        out: set[str] = set()
        for vector in self.vectors:
            left = 1.0
            for word, weight in sorted(vector.items(), key=lambda x: (-x[1], x[0])):
                if left < min(HEADER, FILE, NAMED) ** 2:
                    break
                out.add(word)
                left -= weight**2
        return sorted(out)


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def document_frequencies(files: DataFrame) -> tuple[int, dict[str, int]]:
    """All files, and how many have each word of the templates (VOCABULARY bounds them)."""
    known = F.array(*[F.lit(w) for w in VOCABULARY])
    found = (
        files.select(
            F.explode(F.concat(F.array(F.lit("")), F.array_intersect(tokens(text_of()), known)))
        )
        .groupBy("col")
        .count()
        .collect()
    )
    counts = {r["col"]: r["count"] for r in found}
    return counts.pop("", 0), counts


def weights(files: DataFrame) -> Weights:
    n, counts = document_frequencies(files)
    idf = {w: math.log((1 + n) / (1 + counts.get(w, 0))) + 1 for w in VOCABULARY}
    vectors = []
    for _, text in TEMPLATES:
        words = words_of(text)
        vector = {w: words.count(w) * idf[w] for w in set(words)}
        length = math.sqrt(sum(x * x for x in vector.values()))
        vectors.append({w: x / length for w, x in vector.items()})
    return Weights(idf, math.log(1 + n) + 1, vectors)


def closest(files: DataFrame, by: Weights) -> DataFrame:
    """Per line (and file: line -1) with a telling word its best template and the cosine.

    Words that no template has weigh as words of one document.
    """
    telling = F.array(*[F.lit(w) for w in by.telling()])
    lines = F.posexplode(F.split("text", "\n", -1)).alias("line", "part")
    has_any = files.where(F.arrays_overlap(tokens(F.col("text")), telling))
    parts = has_any.select(*KEY, lines).unionByName(
        has_any.select(*KEY, F.lit(-1).alias("line"), F.col("text").alias("part"))
    )
    spark = files.sparkSession
    table = spark.createDataFrame(
        [(w, by.idf[w], [v.get(w, 0.0) for v in by.vectors]) for w in VOCABULARY],
        "word string, idf double, shares array<double>",
    )
    counted = (
        parts.select(*KEY, "line", tokens(F.col("part")).alias("words"))
        .where(F.arrays_overlap("words", telling))
        .select(*KEY, "line", F.explode("words").alias("word"))
        .groupBy(*KEY, "line", "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    weight = F.col("n") * F.coalesce("idf", F.lit(by.rarest))
    cosines = (
        counted.join(F.broadcast(table), "word", "left")
        .groupBy(*KEY, "line")
        .agg(
            F.sqrt(F.sum(weight * weight)).alias("length"),
            *[F.sum(weight * F.col("shares")[i]).alias(f"t{i}") for i in range(len(TEMPLATES))],
        )
    )
    best = F.array_max(
        F.array(
            *[
                F.struct(
                    F.round(F.coalesce(F.col(f"t{i}"), F.lit(0.0)) / F.col("length"), 6).alias("score"),
                    F.lit(-i).alias("order"),
                    F.lit(name).alias("license"),
                )
                for i, (name, _) in enumerate(TEMPLATES)
            ]
        )
    )
    return cosines.select(*KEY, "line", best.alias("best")).select(
        *KEY, "line", "best.score", "best.license"
    )


def directory(path: Column) -> Column:
    """What is before a path's last slash; the empty text for a path without one."""
    return F.regexp_replace(path, "(^|/)[^/]*$", "")


def above(folder: Column) -> Column:
    """The folder and all above it, with their depths, the empty root last."""
    parts = F.split(folder, "/")
    return F.transform(
        F.sequence(F.size(parts), F.lit(0)),
        lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("folder")),
    )


def scan(files: DataFrame, staging: Staging) -> DataFrame:
    """Per file its licence: doc_id, path, license, how, score.

    `how` is header (a line says it), file (the whole file does), inherited, or none. Of
    several lines the closest counts, the first of equals; of several licence files in a
    directory the closest, then the smallest path. A file named as a licence has that of its
    whole text from NAMED on, else that of its header; if it has words and neither, its licence
    is `unknown`, with score 0, and so is what its folder inherits. Null texts are empty, null paths are
    files of the root without a name. Rows equal in id and text but not in path have equal
    own licences; repeated rows repeat. An empty table gives no row. Columns other than
    doc_id, path and text are not read.
    """
    files = files.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("path", F.lit("")).alias("path"),
        text_of().alias("text"),
        *row_key(text_of()),
    )
    scores = staging.table(closest(files, weights(files)), "scores")
    # Rows with the same key have the same lines, counted together: cosines stay the same.
    own = scores.groupBy(*KEY).agg(
        F.max(
            F.when(
                (F.col("line") >= 0) & (F.col("score") >= HEADER),
                F.struct("score", (-F.col("line")).alias("order"), "license"),
            )
        ).alias("header"),
        F.max(
            F.when(F.col("line") < 0, F.struct("score", F.lit(0).alias("order"), "license"))
        ).alias("whole"),
    )
    own = staging.table(own.withColumnsRenamed({k: f"own_{k}" for k in KEY}), "own")
    match = [F.col(k).eqNullSafe(F.col(f"own_{k}")) for k in KEY]
    named = F.col("path").rlike(FILE_NAMES)
    known = (F.col("whole.score") >= FILE) | (named & (F.col("whole.score") >= NAMED))
    unknown = F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("order"), F.lit(UNKNOWN).alias("license"))
    says_other = named & F.lower("text").rlike(TOKEN)
    judged = staging.table(
        files.withColumn("says_other", says_other)
        .drop("text")
        .join(own, match, "left")
        .select(
            "doc_id",
            "path",
            directory(F.col("path")).alias("folder"),
            "header",
            F.when(known, F.col("whole"))
            .when(named & F.col("header").isNotNull(), F.col("header"))
            .when(F.col("says_other"), unknown)
            .alias("whole"),
        ),
        "judged",
    )
    given = (
        judged.where(F.col("whole").isNotNull())
        .groupBy("folder")
        .agg(F.min(F.struct((-F.col("whole.score")).alias("far"), "path", "whole.license")).alias("g"))
        .select(F.col("folder").alias("source"), F.col("g.license").alias("license"))
    )
    given = staging.table(given, "given")
    # Folders, not files, look upwards: a folder of a third of all files is one row here.
    inherited = staging.table(
        judged.groupBy("folder")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("folder", F.explode(above(F.col("folder"))).alias("up"))
        .select("folder", "up.depth", F.col("up.folder").alias("source"))
        .join(given, "source")
        .groupBy("folder")
        .agg(F.max(F.struct("depth", "license")).alias("nearest"))
        .select("folder", F.col("nearest.license").alias("inherited")),
        "inherited",
    )
    found = judged.join(inherited, "folder", "left")
    return found.select(
        "doc_id",
        "path",
        F.coalesce("header.license", "whole.license", "inherited").alias("license"),
        F.when(F.col("header").isNotNull(), "header")
        .when(F.col("whole").isNotNull(), "file")
        .when(F.col("inherited").isNotNull(), "inherited")
        .otherwise("none")
        .alias("how"),
        F.coalesce("header.score", "whole.score", F.lit(0.0)).alias("score"),
    )


def _template_rows() -> str:
    return ", ".join(
        "({}, '{}', '{}')".format(i, name, text.replace("'", "''"))
        for i, (name, text) in enumerate(TEMPLATES)
    )


def oracle_sql(files: str) -> str:
    """The same result in DuckDB over a query that gives doc_id, path and text."""

    def words(text: str) -> str:
        return f"regexp_extract_all(lower({text}), '{TOKEN}')"

    return f"""
WITH files AS (
  SELECT doc_id, coalesce(path, '') AS path, coalesce(text, '') AS text FROM ({files})
), templates(id, license, text) AS (VALUES {_template_rows()}),
size AS (SELECT count(*) AS n FROM files),
told AS (
  SELECT id, word, count(*) AS tf
  FROM (SELECT id, unnest({words("text")}) AS word FROM templates) GROUP BY 1, 2
), idf AS (
  SELECT v.word, ln((1 + n) / (1 + coalesce(df, 0))) + 1 AS idf
  FROM (SELECT DISTINCT word FROM told) v CROSS JOIN size
  LEFT JOIN (
    SELECT word, count(*) AS df
    FROM (SELECT unnest(list_distinct({words("text")})) AS word FROM files) GROUP BY 1
  ) d ON d.word = v.word
), vectors AS (
  SELECT id, word, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY id)) AS share
  FROM told JOIN idf USING (word)
), parts AS (
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line,
         unnest(string_split(text, chr(10))) AS part
  FROM (SELECT DISTINCT doc_id, text FROM files)
  UNION ALL SELECT DISTINCT doc_id, -1, text FROM files
), counted AS (
  SELECT doc_id, line, word, count(*) AS tf
  FROM (SELECT doc_id, line, unnest({words("part")}) AS word FROM parts) GROUP BY 1, 2, 3
), weighed AS (
  SELECT c.*, tf * coalesce(idf, ln(1 + n) + 1) AS weight
  FROM counted c CROSS JOIN size LEFT JOIN idf USING (word)
), lengths AS (
  SELECT doc_id, line, sqrt(sum(weight * weight)) AS length FROM weighed GROUP BY 1, 2
), cosines AS (
  SELECT w.doc_id, w.line, v.id, round(sum(weight * share) / any_value(length), 6) AS score
  FROM weighed w JOIN vectors v USING (word)
  JOIN lengths l ON l.doc_id = w.doc_id AND l.line = w.line GROUP BY 1, 2, 3
), best AS (
  SELECT c.doc_id, c.line, c.score, t.license
  FROM cosines c JOIN templates t ON t.id = c.id
  QUALIFY row_number() OVER (PARTITION BY c.doc_id, c.line ORDER BY c.score DESC, c.id) = 1
), headers AS (
  SELECT * FROM best WHERE line >= 0 AND score >= {HEADER}
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, line) = 1
), judged AS (
  SELECT f.doc_id, f.path, regexp_replace(f.path, '(^|/)[^/]*$', '') AS folder,
         h.license AS header, h.score AS header_score,
         CASE WHEN w.score >= {FILE} OR named AND w.score >= {NAMED} THEN w.license
              WHEN named AND h.score IS NOT NULL THEN h.license
              WHEN named AND says THEN '{UNKNOWN}' END AS whole,
         CASE WHEN w.score >= {FILE} OR named AND w.score >= {NAMED} THEN w.score
              WHEN named AND h.score IS NOT NULL THEN h.score
              WHEN named AND says THEN 0.0 END AS whole_score
  FROM (SELECT *, regexp_matches(path, '{FILE_NAMES}') AS named,
               len({words("text")}) > 0 AS says FROM files) f
  LEFT JOIN headers h ON h.doc_id = f.doc_id
  LEFT JOIN best w ON w.doc_id = f.doc_id AND w.line = -1
), given AS (
  SELECT folder AS source, whole AS license FROM judged WHERE whole IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY folder ORDER BY whole_score DESC, path, whole) = 1
), nearest AS (
  SELECT f.folder, g.license AS inherited
  FROM (SELECT DISTINCT folder FROM judged) f
  JOIN given g ON g.source = '' OR f.folder = g.source OR starts_with(f.folder, g.source || '/')
  QUALIFY row_number() OVER (PARTITION BY f.folder ORDER BY length(g.source) DESC) = 1
)
SELECT doc_id, path, coalesce(header, whole, inherited) AS license,
       CASE WHEN header IS NOT NULL THEN 'header' WHEN whole IS NOT NULL THEN 'file'
            WHEN inherited IS NOT NULL THEN 'inherited' ELSE 'none' END AS how,
       coalesce(header_score, whole_score, 0.0) AS score
FROM judged LEFT JOIN nearest USING (folder)
"""
