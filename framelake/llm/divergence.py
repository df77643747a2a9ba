"""How far the sources of a language diverge in their terms, with strings materialised late.

Documents are counted by fixed-width digests of their terms first. A second reading counts the terms of digests in enough documents by source, and
writes counts and strings as columns of one table, of which digests and counts alone are shuffled for the reports. The least and the greatest string of each such digest tell whether it stands for
several terms; those few are split by a second digest. Reports work on (digest, sub) pairs, and text is joined back to the rows that stay."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelake.llm.common import _power_tables, mix, written

#: Bits of the filter of kept digests that second readings carry: 1 MB, whatever the vocabulary; a full filter passes more strings, not other ones.
FILTER_BITS = 23
#: Distinct entries that a task holds before it sends them on.
HELD = 500_000
#: (term, source) rows that one group of the pair report aims at, and sources compared with all others at a time.
PAIR_ROWS = 1 << 14
TILE = 128

# A term byte: an ASCII letter, or any byte of a longer character. Letters are lower-cased.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_TERM = np.zeros(256, bool)
_TERM[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms(texts: pa.Array, bits: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes lower-cased, begin, end, row, digest) of all terms of an array of texts (no nulls)."""
    bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(texts.buffers()[2], np.uint8)[bounds[0] : bounds[-1]] if bounds[-1] > bounds[0] else np.empty(0, np.uint8)
    bounds = bounds - bounds[0]
    raw = _LOWER[raw]
    inside = _TERM[raw]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    first = bounds[:-1][np.diff(bounds) > 0]
    starts[first] = inside[first]
    last = first[1:] - 1
    ends[last] = inside[last]
    begin, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    up, down = _power_tables(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
    digest = mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))
    if bits < 64:
        digest &= np.uint64((1 << bits) - 1)
    return raw, begin, end, np.searchsorted(bounds, begin, "right") - 1, digest.view(np.int64)


def _runs(batch: pa.RecordBatch, bytes_: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """A batch in runs of texts of about so many bytes."""
    size = np.cumsum(pc.binary_length(batch.column("text")).to_numpy().astype(np.int64))
    a = 0
    while a < len(size):
        z = max(a + 1, int(np.searchsorted(size, (size[a - 1] if a else 0) + bytes_)))
        yield batch.slice(a, z - a)
        a = z


def _grouped(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Distinct keys, and the sums of values by them."""
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    at = np.flatnonzero(new)
    return [k[at] for k in keys], [np.add.reduceat(v[order], at) if len(at) else v[:0] for v in values]


def _numbered(digest: np.ndarray, second: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(number, first): a number for each different digest (and second digest), from 0, and a place of each."""
    order = np.argsort(digest, kind="stable")
    d = digest[order]
    new = np.ones(len(d), bool)
    new[1:] = d[1:] != d[:-1]
    if second is not None:
        other = second[order][1:] != second[order][:-1]
        if (other & ~new[1:]).any():
            order = np.lexsort([second, digest])
            d, other = digest[order], second[order][1:] != second[order][:-1]
            new[1:] = d[1:] != d[:-1]
        new[1:] |= other
    number = np.empty(len(d), np.int64)
    number[order] = np.cumsum(new) - 1
    return number, order[new]


def _counted(a: np.ndarray, b: np.ndarray, width: int, *values: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct pairs of numbers, b below width, with how often each occurs, or the sums of values by them."""
    key = a * width + b
    if not values:
        key, n = np.unique(key, return_counts=True)
        return key // width, key % width, [n.astype(np.int64)]
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = np.flatnonzero(np.diff(key, prepend=-1))
    return key[at] // width, key[at] % width, [np.add.reduceat(v[order], at) if len(at) else v[:0] for v in values]


def _in_filter(digest: np.ndarray, words: np.ndarray) -> np.ndarray:
    bit = digest.view(np.uint64) & np.uint64((1 << FILTER_BITS) - 1)
    return (words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) > 0


def bit_filter(digests: DataFrame) -> np.ndarray:
    """The filter of a table of digests, as 64-bit words: at most 2**(FILTER_BITS - 6) rows reach the driver, however many digests there are."""
    bit = F.col("digest").bitwiseAND((1 << FILTER_BITS) - 1)
    rows = digests.groupBy(F.shiftrightunsigned(bit, 6).alias("w")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST((digest & {(1 << FILTER_BITS) - 1}) & 63 AS INT))")).alias("b")).collect()
    words = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for r in rows:
        words[r.w] = r.b
    return words.view(np.uint64)


class _Sums:
    """Sums by keys, all of them arrays; compacted whenever they have doubled."""

    def __init__(self, keys: int):
        self.keys, self.columns, self.size, self.limit = keys, [], 0, HELD

    def add(self, *columns: np.ndarray) -> None:
        self.columns.append(columns)
        self.size += len(columns[0])
        if self.size > 2 * self.limit:
            self.compact()
            self.limit = max(HELD, self.size)

    def compact(self) -> list[np.ndarray]:
        whole = [np.concatenate(c) for c in zip(*self.columns, strict=True)]
        keys, values = _grouped(whole[: self.keys], whole[self.keys :])
        self.columns = [tuple(keys + values)]
        self.size = len(keys[0])
        return keys + values

    def full(self) -> bool:
        return self.size > 3 * HELD

    def taken(self) -> Iterator[list[np.ndarray]]:
        """What is held, in pieces; nothing is held any more."""
        if self.columns:
            whole = self.compact()
            for k in range(0, len(whole[0]), 1 << 16):
                yield [c[k : k + (1 << 16)] for c in whole]
        self.columns, self.size, self.limit = [], 0, HELD


def _named(codes: np.ndarray, names: list) -> pa.Array:
    return pa.DictionaryArray.from_arrays(pa.array(codes.astype(np.int32)), pa.array(names, pa.string())).dictionary_decode()


def term_documents(docs: DataFrame, bits: int = 64) -> DataFrame:
    """(lang, digest, df) from docs (text, lang, no nulls): documents that have the term, summed within tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs: dict[str, int] = {}
        sums = _Sums(2)

        def sent() -> Iterator[pa.RecordBatch]:
            for g, d, df in sums.taken():
                yield pa.RecordBatch.from_arrays([_named(g, list(langs)), pa.array(d), pa.array(df)], ["lang", "digest", "df"])

        for batch in batches:
            for part in _runs(batch):
                _, _, _, row, digest = terms(part.column("text"), bits)
                group = np.fromiter((langs.setdefault(k, len(langs)) for k in part.column("lang").to_pylist()), np.int64, part.num_rows)
                number, first = _numbered(digest)
                row, number, _ = _counted(row, number, max(1, len(first)))
                lang, number, (df,) = _counted(group[row], number, max(1, len(first)))
                sums.add(lang, digest[first[number]], df)
                if sums.full():
                    yield from sent()
        yield from sent()

    return docs.select("text", "lang").mapInArrow(run, "lang string, digest long, df long")


def term_hits(docs: DataFrame, words: np.ndarray, bits: int = 64) -> DataFrame:
    """(lang, source, digest, second, n, df) of the terms whose digests pass a filter, summed within tasks: occurrences and documents. second is
    another digest, and term the string on one row at least of each task that has these two."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[tuple[str, str], int] = {}
        strings: dict[tuple[int, int], bytes] = {}
        sums = _Sums(3)

        def sent() -> Iterator[pa.RecordBatch]:
            for g, d, second, n, df in sums.taken():
                # A string is told once, with the first row that has its digests.
                text = pa.array([strings.pop(k, None) for k in zip(d.tolist(), second.tolist(), strict=True)], pa.binary()).cast(pa.string())
                columns = [_named(g, [x[0] for x in names]), _named(g, [x[1] for x in names]), pa.array(d), pa.array(second), text, pa.array(n), pa.array(df)]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "digest", "second", "term", "n", "df"])
            strings.clear()

        for batch in batches:
            for part in _runs(batch):
                raw, begin, end, row, digest = terms(part.column("text"), bits)
                at = np.flatnonzero(_in_filter(digest, shared.value))
                begin, end, row, digest = begin[at], end[at], row[at], digest[at]
                second = _second(raw, begin, end)
                number, first = _numbered(digest, second)
                for d, x, a, z in zip(digest[first].tolist(), second[first].tolist(), begin[first].tolist(), end[first].tolist(), strict=True):
                    if (d, x) not in strings:
                        strings[d, x] = raw[a:z].tobytes()
                keys = zip(part.column("lang").to_pylist(), part.column("source").to_pylist(), strict=True)
                group = np.fromiter((names.setdefault(k, len(names)) for k in keys), np.int64, part.num_rows)
                row, number, (n,) = _counted(row, number, max(1, len(first)))
                own, number, (n, df) = _counted(group[row], number, max(1, len(first)), n, np.ones(len(row), np.int64))
                sums.add(own, digest[first[number]], second[first[number]], n, df)
                if sums.full():
                    yield from sent()
        yield from sent()

    return docs.select("text", "lang", "source").mapInArrow(run, "lang string, source string, digest long, second long, term string, n long, df long")


def _second(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Another 64-bit digest of runs of bytes."""
    up, down = _power_tables(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(mix(raw.astype(np.uint64) + np.uint64(0x1234567)) * up[: len(raw)], out=sums[1:])
    return ((sums[end] - sums[begin]) * down[begin]).view(np.int64)


def kept_terms(docs: DataFrame, least: int = 30, bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """(counts, texts): counts (lang, source, digest, sub, n) of the terms in at least so many documents of their lang, and
    texts (digest, sub, term). Both are tables. bits narrows the digests, to test what collisions do."""
    enough = term_documents(docs, bits).groupBy("lang", "digest").agg(F.sum("df").alias("df")).where(F.col("df") >= least).select("lang", "digest")
    enough = written(enough, "term-digests")
    # The second reading's table stays as the tasks wrote it; its strings and its counts are separate columns of its files.
    hits = written(term_hits(docs, bit_filter(enough), bits), "term-hits")
    counts = written(hits.groupBy("lang", "source", "digest").agg(F.sum("n").alias("n")).join(enough, ["lang", "digest"]).select("lang", "source", "digest", "n"), "term-counts")
    strings = hits.where("term IS NOT NULL")
    found = written(strings.groupBy("digest").agg(F.min("term").alias("low"), F.max("term").alias("high")), "term-strings")
    several = found.where("low != high").select("digest")
    texts = found.where("low = high").select("digest", F.lit(0).alias("sub"), F.col("low").alias("term"))
    if several.isEmpty():
        return counts.withColumn("sub", F.lit(0)), texts
    # Digests of several terms: their terms are told apart by both digests, which must then have one string, and are numbered within the first.
    one = F.when(F.min("term") == F.max("term"), F.min("term")).otherwise(F.raise_error(F.lit("two terms have the same two digests")))
    numbered = strings.join(several, "digest").groupBy("digest", "second").agg(one.alias("term"))
    numbered = written(numbered.withColumn("sub", F.row_number().over(Window.partitionBy("digest").orderBy("second"))), "term-numbers")
    apart = hits.join(numbered, ["digest", "second"]).groupBy("lang", "digest", "sub", "source").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    apart = apart.withColumn("all", F.sum("df").over(Window.partitionBy("lang", "digest", "sub"))).where(F.col("all") >= least)
    whole = counts.join(several, "digest", "left_anti").select("lang", "source", "digest", "n", F.lit(0).alias("sub"))
    return written(whole.unionByName(apart.select("lang", "source", "digest", "n", "sub")), "term-counts-split"), texts.unionByName(numbered.select("digest", "sub", "term"))


def share(n: Column, total: Column, v: Column) -> Column:
    """1 + floor(1000000000 * (n + 5) / (total + 5 v)), in whole numbers."""
    return (F.lit(1) + F.call_function("div", (n.cast("decimal(19,0)") + 5) * F.lit(1000000000).cast("decimal(10,0)"), (total.cast("decimal(19,0)") + 5 * v.cast("decimal(19,0)")))).cast("long")


def _pairs(sources: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """Sums of |p - q| over the terms of one group, of a tile's sources with all: the sources a column each, terms without a row at their source's least share."""
    sources = sources.sort_values("at")
    base = sources["least"].to_numpy(np.int64)
    tile = np.flatnonzero(sources["mine"].to_numpy(bool))
    total = np.zeros((len(tile), len(base)), np.int64)
    if len(rows):
        term = rows.groupby(["digest", "sub"], sort=False).ngroup().to_numpy()
        order = np.argsort(term, kind="stable")
        term, at, p = term[order], rows["place"].to_numpy(np.int64)[order], rows["p"].to_numpy(np.int64)[order]
        step = max(1, (1 << 20) // len(base))
        for a in range(0, int(term[-1]) + 1, step):
            low, high = np.searchsorted(term, [a, a + step])
            many = min(step, int(term[-1]) + 1 - a)
            m = np.repeat(base[:, None], many, axis=1)
            m[at[low:high], term[low:high] - a] = p[low:high]
            for k, i in enumerate(tile):
                total[k] += np.abs(m - m[i]).sum(axis=1)
    names = sources["source"].to_numpy()
    left, right = np.repeat(tile, len(base)), np.tile(np.arange(len(base)), len(tile))
    other = left != right
    return pd.DataFrame({"lang": sources["lang"].iloc[0], "source": names[left[other]], "item": names[right[other]], "value": total.ravel()[other]})


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = 30, top: int = 50, bits: int = 64) -> DataFrame:
    """(lang, source, part, item, value, rank) of every (lang, source) that occurs in docs.

    part "pair": item is another source of the lang, value the sum over the lang's kept terms of the differences of their shares.
    part "term": item is a kept term whose share in the source is above that in the lang, value the difference, ranks up to top.
    Ranks go by value downwards and item upwards by bytes. Nulls in text, lang and source are ''; texts without a term, and sources of none, count as
    sources; a repeated row is a document of its own; an empty table gives no row. Other columns don't matter."""
    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    plain = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((text, "text"), (lang, "lang"), (source, "source"))))
    counts, texts = kept_terms(plain, least, bits)
    occurring = plain.select("lang", "source").distinct()
    by_lang = counts.groupBy("lang").agg(F.count_distinct("digest", "sub").alias("v"), F.sum("n").alias("lang_n"), F.count("*").alias("rows"))
    groups = occurring.join(counts.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left").join(by_lang, "lang", "left")
    groups = groups.na.fill(0, ["total", "v", "lang_n", "rows"]).withColumn("at", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    groups = groups.withColumn("least", F.when(F.col("v") > 0, share(F.lit(0), F.col("total"), F.col("v"))).otherwise(0).cast("long"))
    groups = written(groups.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("rows") / PAIR_ROWS)).cast("int")), "term-groups")
    told = counts.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("v")))

    # Pairs: terms dealt to blocks by digest; a block meets all sources of its lang, a tile of them against all.
    tiles = Window.partitionBy("lang")
    sides = groups.withColumn("tiles", F.floor(F.max("at").over(tiles) / TILE).cast("int"))
    sides = sides.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles"))))
    sides = sides.select("lang", "block", "tile", "source", "at", "least", (F.floor(F.col("at") / TILE) == F.col("tile")).alias("mine"))
    many = groups.groupBy("lang").agg(F.floor(F.max("at") / TILE).cast("int").alias("tiles"))
    rows = told.join(many, "lang").select("lang", F.pmod(F.xxhash64("digest", "sub"), F.col("blocks")).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("tiles"))).alias("tile"), "digest", "sub", F.col("at").alias("place"), "p")
    summed = sides.groupBy("lang", "block", "tile").cogroup(rows.groupBy("lang", "block", "tile")).applyInPandas(_pairs, "lang string, source string, item string, value long")
    pair = summed.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pair = pair.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    # Terms: the lang's share beside the source's; ranks by value alone first, with their ties, then text decides.
    spread = told.repartition(parts, "lang", "digest", "sub").withColumn("everywhere", F.sum("n").over(Window.partitionBy("lang", "digest", "sub")))
    over = spread.withColumn("value", F.col("p") - share(F.col("everywhere"), F.col("lang_n"), F.col("v"))).where("value > 0").select("lang", "source", "digest", "sub", "value")
    few = over.withColumn("near", F.rank().over(Window.partitionBy("lang", "source").orderBy(F.desc("value")))).where(F.col("near") <= top)
    term = few.join(texts, ["digest", "sub"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    term = term.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pair.unionByName(term)


def query(spark, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
o AS (SELECT rid, lang, source, unnest(ts) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM o GROUP BY lang, term HAVING count(DISTINCT rid) >= 30),
c AS (SELECT o.lang, o.source, o.term, count(*) AS n FROM o JOIN k ON o.lang = k.lang AND o.term = k.term GROUP BY ALL),
l AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
gn AS (SELECT g.lang, g.source, coalesce((SELECT sum(n) FROM c WHERE c.lang = g.lang AND c.source = g.source), 0)::HUGEINT AS total FROM g),
p AS (SELECT gn.lang, gn.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (gn.total + 5 * l.v) AS p,
        1 + (1000000000::HUGEINT * (k.n + 5)) // (l.total + 5 * l.v) AS q
      FROM gn JOIN l ON gn.lang = l.lang JOIN k ON k.lang = gn.lang LEFT JOIN c ON c.lang = gn.lang AND c.source = gn.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
      UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q),
n AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM r)
SELECT * FROM n WHERE part = 'pair' OR rank <= 50
"""
