"""Licences of files: notices in their text by TF-IDF cosine, else the nearest licensed directory above.

Runs of consecutive lines of a text (of the lengths in ``RUNS``, so headers of one line and of many) are compared with
notice templates: sentences, usual file headers, the text of short licences, and SPDX lines.  Terms are runs of a-z and
0-9 in lower case (A-Z), so comment signs do not count; a term's weight is its count times
``ln((1 + N) / (1 + files with it)) + 1``, with files counted over the whole table; terms of no template weigh as terms
that no file has.  A file's own licence is that of its most similar run, if the cosine reaches the template's threshold
(SPDX lines need nearly all of it, as they differ in a name alone).  A clause that only one of two nested licences has
counts before all else.  In a file named like a licence file the whole text
is compared too.

A licence file, or a text that is a notice for ``share`` of its terms or more, licenses its directory.  A file without
a notice of its own inherits from the nearest directory above it that is licensed, by joins on directory paths.

Only runs with a rare template term are looked at: template terms count as common, the most frequent first, only as
long as common terms alone cannot reach the threshold with any template, so one of the others must be present.

Null or empty texts and paths are empty: no notice, directory ``''``.  Ties go to the first licence by name, then line,
then the shorter run, or path.  Rows that repeat a path are one file with several texts and all get its best result;
other columns are ignored.  All steps are built-in expressions; no run of lines leaves its file's row, whose best notice
alone is shuffled.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agrometry.llm.staging import staged

THRESHOLD = 0.6
EXACT = 0.95
CLAUSE = 0.8
SHARE = 0.5
#: Lengths of the runs of lines that are compared.
RUNS = (1, 2, 3, 4, 6, 8, 11, 14, 18, 22)

# Names and usual notices of licences.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

# Usual headers of files and texts of short licences.
_GNU_HEADER = (
    "This {thing} is free software; you can redistribute it and/or modify it under the terms of the GNU {name} as published by "
    "the Free Software Foundation, either version {version} of the License, or (at your option) any later version. "
    "This {thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty "
    "of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details. "
    "You should have received a copy of the GNU {name} along with this {thing}. If not, see https://www.gnu.org/licenses/"
)
_GNU = (
    ("GPL-2.0", "General Public License", "2", "program"),
    ("GPL-3.0", "General Public License", "3", "program"),
    ("LGPL-2.1", "Lesser General Public License", "2.1", "library"),
    ("LGPL-3.0", "Lesser General Public License", "3", "library"),
    ("AGPL-3.0", "Affero General Public License", "3", "program"),
)
HEADERS = (
    *((short, _GNU_HEADER.format(name=name, version=version, thing=thing)) for short, name, version, thing in _GNU),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
        'in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
        "so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
        "this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
        "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
)
# Fixed value: the clause that sets a licence apart from one whose text it holds whole.
CLAUSES = (
    (
        "BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
        "this software without specific prior written permission.",
    ),
)
# Identifiers of the SPDX list and the licences they stand for.
SPDX = (
    *((name, name) for name in ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "ISC", "MIT", "MPL-2.0", "Unlicense")),
    *((short, short + more) for short, *_ in _GNU for more in ("", "-only", "-or-later")),
)


@dataclass(frozen=True)
class Template:
    license: str
    terms: Counter
    threshold: float
    #: A notice of higher rank counts before any other of its file.
    rank: int = 0


LICENCE_FILE = "^(licen[cs]e|copying|notice|unlicense)([.-].*)?$"

_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BREAK = "[^a-z0-9]+"


def _terms(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, _CAPITALS, _SMALL), _BREAK), lambda t: t != "")


def templates() -> list[Template]:
    """All templates; one of two with the same terms counts."""
    texts = [(name, text, THRESHOLD, 0) for name, text in (*TEMPLATES, *HEADERS)]
    texts += [(name, f"SPDX-License-Identifier: {sign}", EXACT, 0) for name, sign in SPDX]
    texts += [(name, text, CLAUSE, 1) for name, text in CLAUSES]
    return [Template(name, Counter(t for t in re.split(_BREAK, text.lower()) if t), least, rank) for name, text, least, rank in texts]


def _rare(known: list[Template], idf: dict[str, float]) -> list[str]:
    """Terms of which a run must have one to reach the threshold with any template."""
    weight = lambda t, term: (t.terms[term] * idf[term]) ** 2
    limits = [(0.999 * t.threshold) ** 2 * sum(weight(t, term) for term in t.terms) for t in known]
    reached = [0.0] * len(known)
    common: set[str] = set()
    for term in sorted(idf, key=lambda t: (idf[t], t)):
        reached = [r + weight(t, term) for r, t in zip(reached, known)]
        if any(r >= limit for r, limit in zip(reached, limits)):
            break
        common.add(term)
    return sorted(set(idf) - common)


def _directory(path: Column) -> Column:
    return F.when(F.contains(path, F.lit("/")), F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.lit(""))


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is worked out once; a lambda function works out what it captures for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _runs(lines: Column, rare: Column, runs=RUNS) -> Column:
    """Runs (line, length, held, known) of lines, given as structs (held, known), around the lines with a rare term."""
    count = F.size(lines)
    marked = F.filter(F.transform(lines, lambda l, i: F.when(F.arrays_overlap(l["known"], rare), i)), lambda i: i.isNotNull())

    def starts(line: Column, n: int) -> Column:
        first, last = F.greatest(line - F.lit(n - 1), F.lit(0)), F.least(line, count - F.lit(n))
        places = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.struct(i.alias("line"), F.lit(n).alias("length")))

    def around(line: Column) -> Column:
        return F.concat(*(starts(line, n) for n in runs))

    def gathered(run: Column) -> Column:
        part = F.slice(lines, run["line"] + 1, run["length"])
        held = F.aggregate(part, F.lit(0), lambda total, l: total + l["held"])
        return F.struct(run["line"].alias("line"), run["length"].alias("length"), held.alias("held"), F.flatten(part["known"]).alias("known"))

    return F.transform(F.array_distinct(F.flatten(F.transform(marked, around))), gathered)


def _best(piece: Column, whole: Column, known: list[Template], idf: dict[str, float], unseen: float) -> Column:
    """The best notice (rank, order, license, line, length, score, share) in a run; null without one.

    ``unseen`` is the weight of terms that no template has; of these only the number counts.
    """
    norms = [math.sqrt(sum((n * idf[term]) ** 2 for term, n in t.terms.items())) for t in known]
    held = {term: {"idf": value, "weights": [t.terms[term] * value * value / norm for t, norm in zip(known, norms)]} for term, value in idf.items()}
    # one literal instead of thousands of expressions
    weights = F.from_json(F.lit(json.dumps(held)), "map<string, struct<idf: double, weights: array<double>>>")
    told = F.array(*(F.struct(F.lit(-t.rank).alias("rank"), F.lit(t.license).alias("license"), F.lit(t.threshold).alias("least")) for t in known))
    terms = piece["known"]
    counted = F.transform(F.array_distinct(terms), lambda k: F.struct(F.size(F.filter(terms, lambda t: t == k)).alias("n"), F.try_element_at(weights, k).alias("of")))

    def sums(counts: Column) -> Column:
        norm = F.aggregate(counts, (piece["held"] - F.size(terms)) * F.lit(unseen**2), lambda total, c: total + (c["n"] * c["of"]["idf"]) ** 2)
        dots = F.aggregate(counts, F.array_repeat(F.lit(0.0), len(known)), lambda total, c: F.zip_with(total, c["of"]["weights"], lambda d, w: d + c["n"] * w))
        return F.struct(F.sqrt(norm).alias("norm"), dots.alias("dots"))

    def reached(sums: Column) -> Column:
        scored = F.zip_with(sums["dots"], told, lambda d, t: F.struct(F.round(d / sums["norm"], 6).alias("score"), t.alias("of")))
        enough = F.filter(scored, lambda s: s["score"] >= s["of"]["least"])
        share = (piece["held"] / whole).alias("share")
        parts = piece["line"].alias("line"), piece["length"].alias("length")
        rows = F.transform(enough, lambda s: F.struct(s["of"]["rank"].alias("rank"), (-s["score"]).alias("order"), s["of"]["license"].alias("license"), *parts, s["score"].alias("score"), share))
        return F.array_min(rows)

    return _bound(_bound(counted, sums), reached)


def own_notices(files: DataFrame, known: list[Template]) -> DataFrame:
    """Rows (path, license, score, share): the best notice of each file that has one, and its share of the file's terms.

    Runs are compared inside their file's row; only the best notice of a row is shuffled.
    """
    vocabulary = sorted({term for t in known for term in t.terms})
    listed = F.array(*map(F.lit, vocabulary))
    seen = files.select(F.explode(F.concat(F.array_intersect(_terms(F.col("text")), listed), F.array(F.lit("")))).alias("term"))
    counts = {r["term"]: r["n"] for r in seen.groupBy("term").agg(F.count("*").alias("n")).collect()}
    total = counts.get("", 0)
    weigh = lambda n: math.log((1 + total) / (1 + n)) + 1
    idf = {t: weigh(counts.get(t, 0)) for t in vocabulary}
    rare = F.array(*map(F.lit, _rare(known, idf)))

    named = F.regexp_like(F.translate(F.element_at(F.split("path", "/"), -1), _CAPITALS, _SMALL), F.lit(LICENCE_FILE))
    whole = files.select("path", "text", named.alias("named"), _terms(F.col("text")).alias("all")).where(F.arrays_overlap("all", rare))

    def counted(terms: Column, present: Column) -> Column:
        return F.struct(F.size(terms).alias("held"), F.filter(terms, lambda t: F.array_contains(present, t)).alias("known"))

    def pieces(present: Column) -> Column:
        lines = F.transform(F.split("text", "\n"), lambda line: _bound(_terms(line), lambda terms: counted(terms, present)))
        everything = counted(F.col("all"), present)
        text = F.array(F.struct(F.lit(-1).alias("line"), F.lit(0).alias("length"), everything["held"].alias("held"), everything["known"].alias("known")))
        return F.concat(_bound(lines, lambda held: _runs(held, rare)), F.when(F.col("named"), text).otherwise(F.slice(text, 1, 0)))

    cut = whole.select("path", F.size("all").alias("whole"), F.explode(_bound(F.array_intersect("all", listed), pieces)).alias("piece"))
    best = cut.select("path", _best(F.col("piece"), F.col("whole"), known, idf, weigh(0)).alias("best"))
    # a condition before the groups would work out every run twice
    best = best.groupBy("path").agg(F.min("best").alias("best")).where("best is not null")
    return best.select("path", "best.license", "best.score", "best.share")


def scan(files: DataFrame, known: list[Template] | None = None, share: float = SHARE) -> DataFrame:
    """Rows (path, license, score, evidence, source): one for each row of ``files`` (path, text).

    ``evidence`` is ``notice``, ``inherited`` or ``none``; ``source`` is the file itself or the licensed directory.
    """
    files = files.select(F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    own = staged(own_notices(files, known or templates()), "notices")
    named = F.regexp_like(F.translate(F.element_at(F.split("path", "/"), -1), _CAPITALS, _SMALL), F.lit(LICENCE_FILE))
    granted = own.where(named | (F.col("share") >= share)).withColumn("directory", _directory(F.col("path")))
    granted = granted.groupBy("directory").agg(F.min(F.struct((-F.col("score")).alias("order"), "license", "path", "score")).alias("best"))
    granted = granted.select("directory", F.col("best.license").alias("up_license"), F.col("best.score").alias("up_score"))
    joined = files.select("path").join(own, "path", "left")
    bare = joined.where("license is null").select("path").distinct()
    steps = F.split(_directory(F.col("path")), "/")
    above = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(steps, F.lit(1), k), "/").alias("directory")))
    nearest = bare.select("path", F.explode(above).alias("up")).select("path", "up.*").join(granted, "directory")
    nearest = nearest.groupBy("path").agg(F.max(F.struct("depth", "directory", "up_license", "up_score")).alias("up")).select("path", "up.*")
    result = joined.join(nearest, "path", "left")
    return result.select(
        "path",
        F.coalesce("license", "up_license").alias("license"),
        F.coalesce("score", "up_score").alias("score"),
        F.when(F.col("license").isNotNull(), "notice").when(F.col("up_license").isNotNull(), "inherited").otherwise("none").alias("evidence"),
        F.when(F.col("license").isNotNull(), F.col("path")).otherwise(F.col("directory")).alias("source"),
    )


def document_path(doc_id: str = "doc_id", source: str = "source") -> Column:
    """Where a document of the given tables lies: by source and ten thousands of its number, nine in ten a step deeper.

    One in fifty is named like a licence file.
    """
    number = F.col(doc_id)
    deeper = F.when(number % 10 != 0, F.floor(number / 1000).cast("string"))
    place = [F.coalesce(F.col(source), F.lit("none")), F.floor(number / 10000).cast("string"), deeper]
    name = F.concat(F.when(number % 50 == 7, "LICENSE-").otherwise(""), number.cast("string"), F.lit(".txt"))
    return F.concat_ws("/", *place, name)


def sql(share: float = SHARE) -> str:
    """The scan of documents for DuckDB: every run of lines against every template.

    Only texts that hold enough of a template's weight for its threshold (by the inequality of Cauchy and Schwarz) are cut into runs.
    """
    known = templates()
    values = ", ".join(f"({k}, '{t.license}', {t.threshold}, {t.rank}, '{term}', {n})" for k, t in enumerate(known) for term, n in t.terms.items())
    lengths = ", ".join(map(str, RUNS))
    words = f"list_filter(string_split_regex(translate(text, '{_CAPITALS}', '{_SMALL}'), '{_BREAK}'), lambda t: t <> '')"
    return f"""
WITH files AS (
    SELECT doc_id, coalesce(source, 'none') || '/' || (doc_id // 10000) || CASE WHEN doc_id % 10 = 0 THEN '' ELSE '/' || (doc_id // 1000) END AS directory,
        CASE WHEN doc_id % 50 = 7 THEN 'LICENSE-' ELSE '' END || doc_id || '.txt' AS name, doc_id % 50 = 7 AS named, coalesce(text, '') AS text FROM documents
), template(template, license, least, rank, term, n) AS (VALUES {values}),
total AS (SELECT count(*) AS files FROM files),
held AS (SELECT doc_id, {words} AS words FROM files),
idf AS (
    SELECT term, ln((1 + any_value(total.files)) / (1 + count(DISTINCT doc_id))) + 1 AS idf
    FROM (SELECT DISTINCT term FROM template) LEFT JOIN (SELECT doc_id, unnest(words) AS term FROM held) USING (term), total GROUP BY term
), unknown AS (SELECT ln(1 + files) + 1 AS idf FROM total),
weighted AS (SELECT template, license, least, rank, term, n * idf / sqrt(sum((n * idf) ** 2) OVER (PARTITION BY template)) AS weight FROM template JOIN idf USING (term)),
able AS (
    SELECT DISTINCT doc_id FROM (
        SELECT doc_id, template FROM (SELECT DISTINCT doc_id, unnest(words) AS term FROM held) JOIN weighted USING (term)
        GROUP BY doc_id, template HAVING sqrt(sum(weight ** 2)) >= 0.999 * any_value(least)
    )
), line AS (
    SELECT doc_id, line, {words.replace("text", "piece")} AS terms
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS piece, unnest(range(len(string_split(text, chr(10))))) AS line FROM files SEMI JOIN able USING (doc_id))
), counted AS (SELECT doc_id, line, term, count(*) AS n FROM (SELECT doc_id, line, unnest(terms) AS term FROM line) GROUP BY ALL),
lasting AS (SELECT doc_id, max(line) + 1 AS lines FROM line GROUP BY doc_id),
run AS (SELECT doc_id, length, unnest(range(0, greatest(lines - length + 1, 0))) AS line FROM lasting, (SELECT unnest([{lengths}]) AS length)),
tf AS (
    SELECT r.doc_id, r.line, r.length, term, sum(n) AS n FROM run r JOIN counted c ON c.doc_id = r.doc_id AND c.line >= r.line AND c.line < r.line + r.length GROUP BY ALL
    UNION ALL SELECT doc_id, -1, 0, term, sum(n) FROM counted JOIN files USING (doc_id) WHERE named GROUP BY ALL
), norms AS (
    SELECT doc_id, line, length, sum(n) AS held, sum(CASE WHEN idf.idf IS NULL THEN n * unknown.idf ** 2 ELSE (n * idf.idf) ** 2 END) AS norm
    FROM tf LEFT JOIN idf USING (term), unknown GROUP BY ALL
), dots AS (
    SELECT doc_id, line, length, template, license, least, rank, sum(n * idf * weight) AS dot FROM tf JOIN idf USING (term) JOIN weighted USING (term) GROUP BY ALL
), scored AS (
    SELECT doc_id, line, length, license, least, rank, round(dot / sqrt(norm), 6) AS score, norms.held / len(words) AS share
    FROM dots JOIN norms USING (doc_id, line, length) JOIN held USING (doc_id)
), own AS (
    SELECT * FROM scored WHERE score >= least QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY rank DESC, score DESC, license, line, length) = 1
), granted AS (
    SELECT directory, license AS up_license, score AS up_score FROM own JOIN files USING (doc_id) WHERE named OR share >= {share}
    QUALIFY row_number() OVER (PARTITION BY directory ORDER BY score DESC, license, directory || '/' || name) = 1
), nearest AS (
    SELECT f.doc_id, g.* FROM files f JOIN granted g ON starts_with(f.directory || '/', g.directory || '/')
    WHERE f.doc_id NOT IN (SELECT doc_id FROM own) QUALIFY row_number() OVER (PARTITION BY f.doc_id ORDER BY length(g.directory) DESC) = 1
)
SELECT f.directory || '/' || name AS path, coalesce(license, up_license) AS license, coalesce(score, up_score) AS score,
    CASE WHEN license IS NOT NULL THEN 'notice' WHEN up_license IS NOT NULL THEN 'inherited' ELSE 'none' END AS evidence,
    CASE WHEN license IS NOT NULL THEN f.directory || '/' || name ELSE nearest.directory END AS source, f.doc_id
FROM files f LEFT JOIN own USING (doc_id) LEFT JOIN nearest USING (doc_id)
"""
