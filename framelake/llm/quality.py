"""Line-first quality rules, in DataFrame functions alone.

Every line is judged by itself (punctuation, navigation, boilerplate); failing lines are removed, and a document that
loses too much of its text with them is rejected. All work is inside the row: no shuffle, no Python."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.llm.common import WHITE, WORD, unused

SYMBOLS = "#*$%&|<>"
#: Regular expressions that Java and RE2 read alike; they look at one line.
TERMINAL = r"[.!?:;\x{2026}\x{3002}\x{FF01}\x{FF1F}][\"'\x{201D}\x{2019}\x{00BB})\]]*[ \x09-\x0D]*$"
SEPARATORS = r"[|\x{2022}\x{00B7}\x{00BB}>]"
BOILERPLATE = (
    r"(^|[^a-z])(cookie|javascript|privacy policy|terms of (use|service)|all rights reserved|lorem ipsum|log ?in|sign (in|up)"
    r"|subscribe|newsletter|read more|click here|skip to|powered by|back to top|share (this|on))"
)


def bound_to(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value evaluated once for the row however often use names it."""
    return F.transform(F.array(value), use)[0]


def squeezed(text: Column) -> Column:
    """text without the six ASCII white-space characters."""
    return F.translate(text, WHITE, "")


def without_symbols(text: Column) -> Column:
    return F.translate(text, SYMBOLS, "")


def repeated_words(words: Column) -> Column:
    """How many words lie in a 3-word window that occurs twice or more in the array."""

    def covered(grams: Column) -> Column:
        by_text = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

        def marked(s: Column) -> Column:
            twin = F.filter(s, lambda x, k: F.coalesce(F.get(s, k + 1)["g"] == x["g"], F.lit(False)) | F.coalesce((k > 0) & (F.get(s, k - 1)["g"] == x["g"]), F.lit(False)))
            at = F.sort_array(F.transform(twin, lambda x: x["i"]))
            return bound_to(at, lambda p: F.aggregate(F.transform(p, lambda x, k: F.coalesce(F.least(F.get(p, k + 1) - x, F.lit(3)), F.lit(3))), F.lit(0), lambda a, x: a + x))

        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0)).otherwise(bound_to(by_text, marked))

    def counted(words: Column) -> Column:
        last = F.size(words) - 2
        grams = F.filter(F.transform(words, lambda w, i: F.when(i < last, F.concat_ws(" ", w, F.get(words, i + 1), F.get(words, i + 2)))), lambda g: g.isNotNull())
        return F.when(last < 2, F.lit(0)).otherwise(bound_to(grams, covered))

    return bound_to(words, counted)


def line_fails(line: Column, max_symbols: float = 0.1, separators: int = 3) -> Column:
    """A line without closing punctuation, of navigation (many separators) or with a boilerplate phrase; a line without a word never fails."""
    signs = F.length(line) - F.length(without_symbols(line))
    return F.when(
        line.rlike(TERMINAL),
        (line.rlike("[" + SYMBOLS + "]") & (signs > F.lit(max_symbols) * F.length(squeezed(line))))
        | line.rlike(SEPARATORS + f"(.*{SEPARATORS}){{{separators - 1}}}")
        | F.lower(line).rlike(BOILERPLATE),
    ).otherwise(line.rlike(r"[^\x20\x09-\x0D]"))


def clean_lines(docs: DataFrame, text: str = "text", min_words: int = 50, max_repeat: float = 0.5, max_lost: float = 0.5) -> DataFrame:
    """docs with the counts n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and base_failed, lost (the share
    of word characters in removed lines), kept, clean_text.

    base_failed: fewer than min_words words, or more than max_repeat of them in repeated 3-word windows. kept: not
    base_failed and lost <= max_lost. A null or empty text has no words: counts 0, base_failed, lost 0, not kept,
    clean_text ''. Other columns stay; one that has the name of a result is replaced."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.split(t, "\n")
    own_words, own_lines, own_good = (unused(n, docs.columns) for n in ("_words", "_lines", "_good"))
    out = docs.withColumns({own_words: words, own_lines: F.filter(lines, lambda x: F.length(squeezed(x)) > 0)})
    out = out.withColumns(
        {
            "n_words": F.size(own_words).cast("long"),
            "word_chars": F.length(squeezed(t)).cast("long"),
            "n_symbols": (F.length(t) - F.length(without_symbols(t))).cast("long"),
            "n_dup_lines": (F.size(own_lines) - F.size(F.array_distinct(own_lines))).cast("long"),
            "n_repeat_words": repeated_words(F.col(own_words)).cast("long"),
            own_good: F.filter(lines, lambda x: ~line_fails(x)),
        }
    )
    out = out.withColumn("clean_text", F.array_join(own_good, "\n"))
    out = out.withColumns(
        {
            "lost": F.when(F.col("word_chars") > 0, 1 - F.length(squeezed(F.col("clean_text"))) / F.col("word_chars")).otherwise(F.lit(0.0)),
            "base_failed": (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 100 * max_repeat * F.col("n_words")),
        }
    )
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("lost") <= max_lost)).drop(own_words, own_lines, own_good)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return clean_lines(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("lost", 6).alias("lost"))


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '{WORD}') AS ws FROM d),
g AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS gram
      FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) > 2)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM g) WHERE n > 1),
rep AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY rid),
l AS (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d),
lj AS (SELECT rid, line, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS n FROM l),
lf AS (SELECT rid, line, n, n > 0 AND (
         NOT regexp_matches(line, '{TERMINAL.replace("'", "''")}')
         OR regexp_matches(line, '{SEPARATORS}(.*{SEPARATORS}){{2}}')
         OR length(line) - length(translate(line, '{SYMBOLS}', '')) > 0.1 * n
         OR regexp_matches(lower(line), '{BOILERPLATE}')) AS bad FROM lj),
ls AS (SELECT rid, sum(CASE WHEN bad THEN 0 ELSE n END) AS left_chars,
         count(CASE WHEN n > 0 THEN 1 END) - count(DISTINCT CASE WHEN n > 0 THEN line END) AS dups FROM lf GROUP BY rid),
r AS (SELECT d.doc_id, len(w.ws)::BIGINT AS n_words,
        length(regexp_replace(d.t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        (length(d.t) - length(translate(d.t, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
        ls.dups::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, ls.left_chars AS left_chars
      FROM d JOIN w USING (rid) JOIN ls USING (rid) LEFT JOIN rep USING (rid)),
s AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        CASE WHEN word_chars > 0 THEN 1 - left_chars::DOUBLE / word_chars ELSE 0.0 END AS lost0 FROM r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND lost0 <= 0.5 AS kept, round(lost0, 6) AS lost FROM s
"""
