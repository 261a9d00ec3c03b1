"""Quality rules whose thresholds follow the documents of the same language and source.

1. Every text is measured: words, code points in words, symbols, repeated lines, and words in 8-word windows that the
   text holds twice.  Windows are told apart by 64-bit fingerprints.
2. Measures of documents that pass the two fixed rules (``base_failed``) go into a quantile sketch for each language,
   source and measure: counts of values cut to their 7 leading bits, so a value errs by less than a 64th.  Sketches
   merge by adding counts, whatever the partitions, and the same rows always give the same sketch.  A source with less
   than ``LEAST`` documents in its language takes the sketch of the whole language, and a language with less that of all.
3. A value is too high beyond ``Q3 + 3 spread``, and (for the length of words) too low beyond ``Q1 - 3 spread``, where the
   spread is ``Q3 - Q1`` or the measure's least spread: where the middle half of a group lies close together, the bounds
   are the usual fixed ones (about 3 % symbols, 30 % repeated lines or words); groups that vary more get wider ones.
4. Documents are joined with the bounds of their group.  Groups with a ten-thousandth of all documents or more are at
   most 10 000, whose bounds are broadcast; of the other groups none is large, and they are joined by a shuffle.

Null texts have no words and fail; a null language or source is a group of its own; repeated rows and null ids give
rows of their own; other columns are ignored unless carried.  Everything is built-in expressions.  A text is held whole,
with its windows' fingerprints, in its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agrometry.llm.spans import carried
from agrometry.llm.staging import staged

WINDOW = 8
LEAST = 200
#: Bounds of so many groups are broadcast at most.
HEAVY = 10_000
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Measure, its value as a whole number, the least spread, and whether low values count as well.
MEASURES = (
    ("symbols", "1000000 * n_symbols div greatest(word_chars, 1)", 10_000, False),
    ("lines", "1000000 * n_dup_lines div greatest(n_lines, 1)", 100_000, False),
    ("repeats", "1000000 * n_repeat_words div greatest(n_words, 1)", 100_000, False),
    ("length", "1000 * word_chars div greatest(n_words, 1)", 500, True),
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _named(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _covered(marks: Column, window: int) -> Column:
    """How many words lie in windows whose fingerprint occurs twice among ``marks``."""
    ordered = F.sort_array(F.transform(marks, lambda m, i: F.struct(m.alias("mark"), i.alias("place"))))

    def places(held: Column) -> Column:
        equal = lambda x, k: F.get(held, k)["mark"] == x["mark"]
        twice = F.filter(held, lambda x, k: F.coalesce(equal(x, k - 1), F.lit(False)) | F.coalesce(equal(x, k + 1), F.lit(False)))
        return F.sort_array(F.transform(twice, lambda x: x["place"]))

    def total(at: Column) -> Column:
        steps = F.transform(at, lambda x, k: F.coalesce(F.least(F.get(at, k + 1) - x, F.lit(window)), F.lit(window)))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    return F.when(F.size(F.array_distinct(marks)) < F.size(marks), _named(_named(ordered, places), total)).otherwise(F.lit(0))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    def marks(held: Column) -> Column:
        starts = F.when(F.size(held) >= window, F.sequence(F.lit(1), F.size(held) - F.lit(window - 1)))
        return F.transform(starts, lambda i: F.xxhash64(F.slice(held, i, F.lit(window))))

    return F.coalesce(_named(_named(words, marks), lambda m: _covered(m, window)), F.lit(0))


def measured(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Rows (doc_id, lang, source, carried, the counts, n_lines, base_failed), one for each document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, BLANKS, "") != "")
    counted = _named(words, lambda w: F.struct(F.size(w).alias("n_words"), repeated_words(w).alias("n_repeat_words")))
    listed = _named(lines, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        *(F.col(c).cast("string").alias(c) for c in ("lang", "source")),
        carried(carry),
        counted.alias("counted"),
        listed.alias("listed"),
        F.length(F.translate(text, BLANKS, "")).alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).alias("n_symbols"),
    )
    rows = rows.select("doc_id", "lang", "source", "carried", *(c.cast("bigint").alias(n) for n, c in (
        ("n_words", F.col("counted.n_words")), ("word_chars", F.col("word_chars")), ("n_symbols", F.col("n_symbols")),
        ("n_dup_lines", F.col("listed.n_dup_lines")), ("n_repeat_words", F.col("counted.n_repeat_words")), ("n_lines", F.col("listed.n_lines")),
    )))
    return rows.withColumn("base_failed", F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words"))


def _cell(value: str) -> str:
    """A value cut to its 7 leading bits."""
    shift = f"greatest(length(bin({value})) - 7, 0)"
    return f"shiftleft(shiftright({value}, {shift}), {shift})"


def sketches(rows: DataFrame) -> DataFrame:
    """Rows (lang_key, key, measure, cell, n) from rows (lang_key, key, base_failed, cells)."""
    each = rows.where("not base_failed").select("lang_key", "key", F.posexplode("cells").alias("measure", "cell"))
    return each.groupBy("lang_key", "key", "measure", "cell").agg(F.count("*").alias("n"))


def bounds(sketch: DataFrame, key: list[str]) -> DataFrame:
    """Rows (key, n, bounds): for each measure, as an array of (low, high)."""
    merged = sketch.groupBy(*key, "measure", "cell").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*key, "measure")
    upto = merged.select(*key, "measure", "cell", F.sum("n").over(group.orderBy("cell")).alias("upto"), F.sum("n").over(group).alias("n"))
    quantile = lambda q: F.min(F.when(100 * F.col("upto") >= q * F.col("n"), F.col("cell")))
    found = upto.groupBy(*key, "measure").agg(F.max("n").alias("n"), *(quantile(q).alias(f"q{q}") for q in (25, 75)))
    least = F.get(F.array(*(F.lit(m[2]) for m in MEASURES)), F.col("measure"))
    both = F.get(F.array(*(F.lit(m[3]) for m in MEASURES)), F.col("measure"))
    spread = 3 * F.greatest(F.col("q75") - F.col("q25"), least)
    low = F.when(both, F.col("q25") - spread).otherwise(F.lit(0)).cast("bigint")
    pair = F.struct("measure", low.alias("low"), (F.col("q75") + spread).alias("high"))
    return found.groupBy(*key).agg(F.max("n").alias("n"), F.sort_array(F.collect_list(pair)).alias("bounds"))


def thresholds(sketch: DataFrame, least: int = LEAST) -> DataFrame:
    """Rows (key, n, bounds): those of the group, of its language or of all, whichever first has ``least`` documents."""
    own = bounds(sketch, ["lang_key", "key"])
    language = bounds(sketch, ["lang_key"]).select("lang_key", F.col("n").alias("lang_n"), F.col("bounds").alias("lang_bounds"))
    every = bounds(sketch.withColumn("all", F.lit(0)), ["all"]).select(F.col("bounds").alias("all_bounds"), "all")
    found = own.join(language, "lang_key").withColumn("all", F.lit(0)).join(F.broadcast(every), "all")
    chosen = F.when(F.col("n") >= least, F.col("bounds")).when(F.col("lang_n") >= least, F.col("lang_bounds")).otherwise(F.col("all_bounds"))
    return found.select("key", "n", chosen.alias("bounds"))


def judged(docs: DataFrame, carry: list[str] | None = None, least: int = LEAST, heavy: int = HEAVY) -> DataFrame:
    """The measured rows with ``kept``: passed by the fixed rules and within the bounds of their language and source."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), F.md5(c)), F.lit("-"))
    cells = F.array(*(F.expr(_cell(f"({value})")) for _, value, _, _ in MEASURES))
    rows = measured(docs, carry).withColumn("lang_key", part("lang")).withColumn("key", F.concat("lang_key", part("source")))
    rows = staged(rows.withColumn("cells", cells), "measures")
    limits = staged(thresholds(sketches(rows), least), "thresholds")
    total = limits.agg(F.sum("n")).first()[0] or 0
    large = F.col("n") * heavy >= total
    often, rare = (limits.where(c).select("key", "bounds") for c in (large, ~large))
    found = rows.join(F.broadcast(often), "key", "left")
    if not rare.isEmpty():
        rest = rows.join(F.broadcast(often.select("key")), "key", "left_anti")
        found = rows.join(F.broadcast(often), "key").union(rest.join(rare, "key", "left").select(found.columns))
    outside = F.exists(F.zip_with("cells", "bounds", lambda c, b: (c < b["low"]) | (c > b["high"])), lambda x: x)
    kept = ~F.col("base_failed") & ~F.coalesce(outside, F.lit(False))
    return found.select("doc_id", "lang", "source", "carried", *COUNTS, "n_lines", "base_failed", kept.alias("kept"))


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", *COUNTS, "base_failed", "kept")


def sql(least: int = LEAST) -> str:
    """The digest for DuckDB."""
    value = ", ".join(f"({v.replace(' div ', ' // ')})" for _, v, _, _ in MEASURES)
    spread = " ".join(f"WHEN {k} THEN {m[2]}" for k, m in enumerate(MEASURES))
    both = ", ".join(str(k) for k, m in enumerate(MEASURES) if m[3])
    quantiles = ", ".join(f"min(cell) FILTER (100 * upto >= {q} * total) AS q{q}" for q in (25, 75))

    def limits(name: str, key: str) -> str:
        return f"""{name} AS (
    SELECT {key}, measure, total, CASE WHEN measure IN ({both}) THEN q25 - spread ELSE 0 END AS low, q75 + spread AS high
    FROM (SELECT *, 3 * greatest(q75 - q25, CASE measure {spread} END) AS spread FROM (
        SELECT {key}, measure, total, {quantiles} FROM (
            SELECT {key}, measure, cell, sum(n) OVER (PARTITION BY {key}, measure ORDER BY cell) AS upto, sum(n) OVER (PARTITION BY {key}, measure) AS total
            FROM (SELECT {key}, measure, cell, count(*) AS n FROM cells WHERE NOT base_failed GROUP BY ALL)
        ) GROUP BY {key}, measure, total
    ))
)"""

    words = "regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
split AS (SELECT *, {words} AS words, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM docs),
win AS (SELECT rid, i, list_slice(words, i, i + {WINDOW - 1}) AS w FROM (SELECT rid, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM split)),
twice AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, w) > 1),
covered AS (SELECT rid, count(DISTINCT place) AS n_repeat_words FROM (SELECT rid, unnest(range(i, i + {WINDOW})) AS place FROM twice) GROUP BY rid),
counted AS (
    SELECT rid, doc_id, lang, source, len(words) AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM split LEFT JOIN covered USING (rid)
), base AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted),
cells AS (
    SELECT rid, lang, source, base_failed, measure, (v >> greatest(length(bin(v)) - 7, 0)::INTEGER) << greatest(length(bin(v)) - 7, 0)::INTEGER AS cell
    FROM (SELECT rid, lang, source, base_failed, unnest([{value}]) AS v, unnest(range({len(MEASURES)})) AS measure FROM base)
), {limits("own", "lang, source")}, {limits("spoken", "lang")}, {limits("every", "1")},
verdict AS (
    SELECT rid, bool_and(cell BETWEEN CASE WHEN o.total >= {least} THEN o.low WHEN s.total >= {least} THEN s.low ELSE e.low END
        AND CASE WHEN o.total >= {least} THEN o.high WHEN s.total >= {least} THEN s.high ELSE e.high END) AS inside
    FROM cells c LEFT JOIN own o ON o.lang IS NOT DISTINCT FROM c.lang AND o.source IS NOT DISTINCT FROM c.source AND o.measure = c.measure
    LEFT JOIN spoken s ON s.lang IS NOT DISTINCT FROM c.lang AND s.measure = c.measure LEFT JOIN every e ON e.measure = c.measure GROUP BY rid
)
SELECT doc_id, {", ".join(f"{c}::BIGINT AS {c}" for c in COUNTS)}, base_failed, NOT base_failed AND coalesce(inside, true) AS kept FROM base JOIN verdict USING (rid)
"""
