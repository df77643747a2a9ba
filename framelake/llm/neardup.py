"""Near-duplicates by order min hash.

Word 5-grams are labelled with their occurrence number. Under each of several hash functions the two least labelled
5-grams are kept in text order and hashed together (order min hash, Marçais et al. 2019): equal values need common
5-grams in the same order, so collisions follow edit similarity rather than set overlap. Short texts, of which few 5-grams outlive an edit, have hashes of word pairs. Texts that collide are compared by
banded alignment of their words, unless their word counts tell already that they are too far apart."""

from __future__ import annotations

import hashlib
import itertools
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.llm.common import connected, drop, gram_hashes, mix, word_hashes, written

SHINGLE = 5
SIMILARITY = 0.8
#: Few 5-grams outlive scattered edits in a short text: up to SHORT words, texts have SHORT_SKETCHES hashes of two word pairs, and 5-grams from LONG words on. Two
#: texts that may be similar and aren't both short have at least LONG words, as SHORT * SIMILARITY is more.
SHORT, LONG = 60, 40
SHORT_SHINGLE, SHORT_SKETCHES = 2, 64
#: At similarity 0.80 by scattered words, 112 hashes of two grams bring 0.95 of pairs of 100 words together; 24 brought 0.56.
SKETCHES = 112
#: Bins of a text's word counts, by the first ten bits of the word's hash, and of the sums of neighbouring bins that are compared first.
BAG = 1024
COARSE = 256
#: Rounds in which texts are compared with centers, of which at most so many a text, before all texts of a bucket are compared.
CENTERS = 1
TRIES = 5
#: Texts of a bucket that meet in one task when all of them are compared: some 25 MB of word counts.
BLOCK = 20_000
#: Texts that a task compares with one center.
COMPARED = 500
_WORDS = re.compile(r"\w+").findall


def normal(text: str | None) -> str:
    """Lower-cased words (letters, digits, _), one space between."""
    return " ".join(_WORDS(text.lower())) if text else ""


_scratch = np.empty(2 << 15, np.uint32)


@lru_cache
def _seeds(sketches: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each hash function a 64-bit seed and an odd number."""
    seeds = mix(np.arange(1, sketches + 1, dtype=np.uint64))
    return seeds, (seeds >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def sketch(words: np.ndarray, sketches: int = SKETCHES, kept: int = 2, k: int = SHINGLE) -> np.ndarray:
    """The order min hashes of a text, given its words' hashes; a text of fewer than k words is one gram."""
    grams = gram_hashes(words, min(k, len(words)))
    n = len(grams)
    order = np.argsort(grams, kind="stable")
    same = grams[order]
    first = np.flatnonzero(np.concatenate([[True], same[1:] != same[:-1]]))
    label = grams
    if len(first) < n:
        number = np.empty(n, np.uint64)
        number[order] = np.arange(n) - np.repeat(first, np.diff(first, append=n))
        label = grams + number * np.uint64(0xD1342543DE82EF95)
    # A gram's rank under a hash function is 32 bits of its label, multiplied and folded by an odd number of the function's own.
    low = mix(label).astype(np.uint32)
    kept = min(kept, n)
    value, odd = _seeds(sketches)
    at = np.empty((sketches, kept), np.int64)
    step = max(1, (1 << 15) // n)
    for t in range(0, sketches, step):
        some = odd[t : t + step, None]
        size = len(some) * n
        rank, fold = (np.empty((2, len(some), n), np.uint32) if 2 * size > len(_scratch) else _scratch[: 2 * size].reshape(2, len(some), n))
        np.multiply(low, some, out=rank)
        np.right_shift(rank, np.uint32(15), out=fold)
        np.bitwise_xor(rank, fold, out=rank)
        np.multiply(rank, np.uint32(0x2C1B3C6D), out=rank)
        each = np.arange(len(some))
        for i in range(kept):
            at[t : t + step, i] = least = rank.argmin(axis=1)
            rank[each, least] = np.iinfo(np.uint32).max
    at.sort(axis=1)
    for i in range(kept):
        value = mix(value * np.uint64(31) + grams[at[:, i]])
    return value.view(np.int64)


def sketches_of(words: np.ndarray, sketches: int = SKETCHES) -> np.ndarray:
    """All order min hashes of a text: those of 5-grams, if it has LONG words, and behind them those of pairs, if it has at most SHORT."""
    parts = [sketch(words, sketches)] if len(words) >= LONG else []
    if len(words) <= SHORT:
        parts.append(mix(sketch(words, SHORT_SKETCHES, k=SHORT_SHINGLE).view(np.uint64) + np.uint64(1)).view(np.int64))
    return np.concatenate(parts)


def _aligned(marks: pa.Array, words: np.ndarray, sketches: int) -> np.ndarray:
    """The hashes of texts, a row each, in columns of equal hash functions; where a text has none of a function, a number that no other row has there."""
    width = sketches + SHORT_SKETCHES
    out = -1 - np.arange(len(words) * width, dtype=np.int64).reshape(-1, width)
    has = np.zeros(out.shape, bool)
    has[:, :sketches] = (words >= LONG)[:, None]
    has[:, sketches:] = (words <= SHORT)[:, None]
    out[has] = pc.list_flatten(marks).to_numpy()
    return out


def edit_distance(a: list[str], b: list[str], band: int) -> int | None:
    """The edit distance of two word lists if it is at most band, else None.

    Only the diagonals within the band are computed: a column of 2 x band + 1 cells is two bit vectors that move down
    a cell with each word of b (the banded form of Myers' method, Hyyrö 2003)."""
    begin = 0
    while begin < len(a) and begin < len(b) and a[begin] == b[begin]:
        begin += 1
    end = 0
    while end < len(a) - begin and end < len(b) - begin and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[begin : len(a) - end], b[begin : len(b) - end]
    if len(a) < len(b):
        a, b = b, a
    m, n = len(a), len(b)
    if m - n > band:
        return None
    if not n:
        return m
    where: dict[str, int] = {}
    for i, w in enumerate(a):
        where[w] = where.get(w, 0) | 1 << i
    band = min(band, m)
    # The window at word j of b (from 0) covers rows j - band .. j + band of a; bit x is row j - band + x.
    width = 2 * band + 1
    full, low = (1 << width) - 1, 1 << band
    # Before the first word, row i costs i: vertical steps of +1 below row -1, none above.
    up = full & ~((1 << band) - 1)
    down = 0
    score = band  # at the lowest diagonal, row j + band
    bottom = 1 << (width - 1)
    for j, w in enumerate(b):
        shift = j - band
        eq = where.get(w, 0)
        eq = (eq >> shift if shift >= 0 else eq << -shift) & full
        zero = (((eq & up) + up) ^ up) | eq | down
        plus = down | ~(zero | up) & full
        minus = up & zero
        if not zero & bottom:
            score += 1
        zero >>= 1
        up = (minus | ~(zero | plus)) & full
        down = zero & plus
    # score is at row n - 1 + band; walk up the last column to row m - 1.
    for row in range(n - 1 + band, m - 1, -1):
        bit = 1 << (row - (n - 1) + band - 1)
        score -= bool(up & bit) - bool(down & bit)
    return score if score <= band else None


def similar(a: list[str], b: list[str], least: float = SIMILARITY) -> bool:
    """1 - edit distance / longer length is at least so much."""
    longer = max(len(a), len(b))
    band = int((1 - least) * longer + 1e-9)
    if not longer or abs(len(a) - len(b)) > band:
        return False
    # Words that aren't in both, by their counts, each cost an edit.
    return longer - (Counter(a) & Counter(b)).total() <= band and edit_distance(a, b, band) is not None


def bag(words: np.ndarray) -> bytes:
    """How many of a text's words fall into each of BAG bins by their hash, up to 255."""
    return np.minimum(np.bincount((words >> np.uint64(54)).astype(np.intp), minlength=BAG), 255).astype(np.uint8).tobytes()


def may_be_near(n_a: np.ndarray, n_b: np.ndarray, bags_a: np.ndarray, bags_b: np.ndarray, least: float) -> np.ndarray:
    """False where numbers of words or bags prove that similar() is false: an edit moves the length by at most one, adds
    at most one word to a bin and takes at most one from a bin."""
    band = ((1 - least) * np.maximum(n_a, n_b) + 1e-9).astype(np.int64)
    out = np.abs(n_a - n_b) <= band
    at = np.flatnonzero(out)
    for t in range(0, len(at), 4096):
        part = at[t : t + 4096]
        d = bags_a[part].astype(np.int16) - bags_b[part]
        more = np.maximum(d, 0).sum(axis=1)
        out[part] = np.maximum(more, more - d.sum(axis=1)) <= band[part]
    return out


def _bags(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BAG)


def _apart(bags: np.ndarray, one: np.ndarray) -> np.ndarray:
    """The edits that each of bags (rows) and one other bag prove at least."""
    most = np.maximum(bags, one)
    return np.maximum((most - one).sum(axis=1, dtype=np.int64), (most - bags).sum(axis=1, dtype=np.int64))


def _features(docs: DataFrame, carried: list[str], text: str, sketches: int) -> DataFrame:
    """(row, text_hash, words, bag, sketch) of every row, row holding the carried columns, text among them."""
    rows, at = docs.select(F.struct(*carried).alias("row")), carried.index(text)
    schema = rows.select("row").schema.add("text_hash", "binary").add("words", "long").add("bag", "binary").add("sketch", T.ArrayType(T.LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digest, number, bags, marks = [], [], [], []
            for t in pc.struct_field(b["row"], [at]):
                plain = normal(t.as_py())
                raw = plain.encode()
                words = word_hashes(raw)
                digest.append(hashlib.blake2b(raw, digest_size=16).digest() if raw else None)
                number.append(len(words))
                bags.append(bag(words) if raw else None)
                marks.append(sketches_of(words, sketches) if raw else [])
            columns = [b["row"], pa.array(digest, pa.binary()), pa.array(number, pa.int64()), pa.array(bags, pa.binary()), pa.array(marks, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(run, schema)


def _possible(pairs: DataFrame, facts: DataFrame, least: float) -> DataFrame:
    """The pairs (id, center) that may_be_near leaves, given facts (id, words, bag)."""
    other = facts.select(F.col("id").alias("center"), F.col("words").alias("words_c"), F.col("bag").alias("bag_c"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = may_be_near(b["words"].to_numpy(), b["words_c"].to_numpy(), _bags(b["bag"]), _bags(b["bag_c"]), least)
            yield b.select(["id", "center"]).filter(pa.array(near))

    both = pairs.join(facts.hint("merge"), "id").join(other.hint("merge"), "center")
    return both.select("id", "center", "words", "bag", "words_c", "bag_c").mapInArrow(run, "id long, center long")


def _all_pairs(rows: DataFrame, facts: DataFrame, least: float, block: int, sketches: int) -> DataFrame:
    """All pairs (id, center) of a bucket's texts that are of different classes and that may_be_near leaves; rows are (value, id, class).

    A bucket of more than block texts is dealt into blocks, and each two blocks meet in a cell of their own, so no
    task holds a bucket. A pair is told in the first bucket that it shares only; facts: (id, words, bag, sketch)."""
    sizes = rows.groupBy("value").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    own, other = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    # A text meets its facts once, with the list of its buckets, of which there are at most as many as hashes.
    met = rows.join(sizes, "value").groupBy("id").agg(F.min("class").alias("class"), F.collect_list(F.struct("value", "blocks")).alias("met"))
    dealt = met.join(facts.hint("merge"), "id").select("id", "class", "words", "bag", "sketch", F.inline("met")).withColumn("own", own).withColumn("other", other)
    cells = dealt.select("value", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "class", "words", "bag", "sketch")

    def pairs(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        inside = t["i"][0] == t["j"][0]
        order = np.argsort(t["words"].to_numpy(), kind="stable")
        own, id_, part, words = (t[c].to_numpy()[order] for c in ("own", "id", "class", "words"))
        bags = _bags(t["bag"])[order]
        coarse = np.minimum(bags.reshape(len(order), COARSE, -1).sum(axis=2), 255).astype(np.uint8)
        marks = _aligned(t["sketch"], t["words"].to_numpy(), sketches)[order]
        value = t["value"][0].as_py()
        # Of texts in order of length, those that are not too long to be near one are a run behind it.
        band = ((1 - least) * words + 1e-9).astype(np.int64)
        last = np.searchsorted(words - band, words, side="right")
        left, right = [], []
        for a in range(len(id_) - 1):
            z = last[a]
            meet = part[a + 1 : z] != part[a]
            if not inside:
                meet &= own[a + 1 : z] != own[a]
            b = a + 1 + np.flatnonzero(meet)
            near = b[_apart(coarse[b], coarse[a]) <= band[b]]
            near = near[_apart(bags[near], bags[a]) <= band[near]]
            first = (marks[near] == marks[a]).argmax(axis=1)
            near = near[marks[a][first] == value]
            left.append(np.full(len(near), id_[a]))
            right.append(id_[near])
        a, b = np.concatenate(left), np.concatenate(right)
        return np.maximum(a, b), np.minimum(a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in itertools.chain(batches, [None]):
            if b is not None and not b.num_rows:
                continue
            t = held if b is None else pa.Table.from_batches([b] if held is None else [*held.to_batches(), b])
            if t is None:
                return
            keys = [t[c].to_numpy() for c in ("value", "i", "j")]
            edges = (np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys])) + 1).tolist()
            edges = [0, *edges, *([t.num_rows] if b is None else [])]
            found = [pairs(t.slice(m, n - m)) for m, n in zip(edges, edges[1:], strict=False) if n - m > 1]
            held = t.slice(edges[-1])
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], ["id", "center"])

    return cells.repartition("value", "i", "j").sortWithinPartitions("value", "i", "j").mapInArrow(run, "id long, center long").distinct()


def _verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """pairs (id, center) with near, by alignment of the texts (id, text).

    A center's text goes once to each task that has texts to compare with it; the texts of a center of many are dealt to several."""
    members = pairs.select("id").union(pairs.select("center")).distinct()
    texts = written(texts.join(members.hint("merge"), "id", "left_semi"), "near-texts")
    salts = written(pairs.groupBy("center").agg(F.ceil(F.count("*") / COMPARED).cast("int").alias("salts")), "near-salts")
    mine = salts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).join(texts.withColumnRenamed("id", "center").hint("merge"), "center")
    theirs = pairs.join(salts, "center").withColumn("salt", F.pmod(F.xxhash64("id"), "salts").cast("int")).join(texts.hint("merge"), "id")
    dealt = mine.select("center", "salt", F.lit(None).cast("long").alias("id"), "text").unionByName(theirs.select("center", "salt", "id", "text"))
    dealt = dealt.repartition("center", "salt").sortWithinPartitions("center", "salt", F.col("id").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: list[str] = []
        for b in batches:
            ids, centers, near = [], [], []
            for center, id_, t in zip(b["center"].to_pylist(), b["id"].to_pylist(), b["text"], strict=True):
                here = normal(t.as_py()).split(" ")
                if id_ is None:
                    words = here
                else:
                    ids.append(id_)
                    centers.append(center)
                    near.append(similar(here, words, least))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(centers, pa.int64()), pa.array(near, pa.bool_())], ["id", "center", "near"])

    judged = written(dealt.mapInArrow(run, "id long, center long, near boolean"), "near-judged")
    drop(texts, salts)
    return judged


def _linked(features: DataFrame, key: str, text: str, least: float, block: int, sketches: int) -> DataFrame:
    """(text_hash, id, none, key, component), written, of each different text of features: the component of texts that links close, by the number
    of one of its texts; id is the row that has the least key, if one isn't null, and none tells that all are."""
    first = F.min(F.struct(F.col(f"row.{key}").isNull().alias("none"), F.col(f"row.{key}").alias("key"), "id")).alias("first")
    nodes = features.where("text_hash IS NOT NULL").groupBy("text_hash").agg(first).select("text_hash", "first.*")
    nodes = written(nodes, "near-ids")
    named = features.join(nodes.select("id").hint("merge"), "id", "left_semi")
    all_facts = written(named.select("id", "words", "bag", "sketch"), "near-facts")
    rows = all_facts.select("id", F.explode("sketch").alias("value"))
    facts = all_facts.select("id", "words", "bag")
    links, judged, parts = None, None, None
    for depth in range(CENTERS + 1):
        if parts is None:
            classed = None
            rows = rows.withColumn("class", F.col("id"))
        else:
            classed = written(rows.join(parts, "id", "left").select("value", "id", F.coalesce("component", "id").alias("class")), "near-classed")
            drop(buckets)
            rows = classed
        first = [F.min("id").alias("center"), F.min("id").alias("center_class"), F.max("id").alias("other")]
        later = [F.min(F.struct(F.xxhash64("id", F.lit(depth)), F.col("id").alias("center"), F.col("class").alias("center_class"))).alias("c"), F.min("class").alias("low"), F.max("class").alias("high")]
        if not depth:
            centers = rows.groupBy("value").agg(*first).where("center < other").drop("other")
        else:
            centers = rows.groupBy("value").agg(*later).where("low < high").select("value", "c.center", "c.center_class")
        buckets = written(rows.join(centers, "value"), "near-buckets")
        if classed is not None:
            drop(classed)
        if buckets.isEmpty():
            break
        if depth < CENTERS:
            # Of the centers of a text's buckets, those it meets most often: a few comparisons a text, and the most likely ones.
            often = Window.partitionBy("id").orderBy(F.desc("n"), "center")
            met = buckets.where("class != center_class").groupBy("id", "center").agg(F.count("*").alias("n")).withColumn("place", F.row_number().over(often)).where(F.col("place") <= TRIES)
            pairs = _possible(met.select(F.greatest("id", "center").alias("id"), F.least("id", "center").alias("center")).distinct(), facts, least)
        else:
            pairs = _all_pairs(buckets.select("value", "id", "class"), all_facts, least, block, sketches)
        rows = buckets.select("value", "id")
        if judged is not None:
            pairs = pairs.join(judged, ["id", "center"], "left_anti")
        pairs = written(pairs, "near-pairs")
        new = _verified(pairs, features.select("id", F.col(f"row.{text}").alias("text")), least)
        drop(pairs)
        judged = new.drop("near") if judged is None else judged.unionByName(new.drop("near"))
        found = new.where("near").select("id", "center")
        links = found if links is None else links.unionByName(found)
        if parts is None or not found.isEmpty():
            linked = connected(links, "id", "center", "near-links")
            parts = written(linked.select(F.col("node").alias("id"), "component"), "near-parts")
    drop(buckets)
    known = nodes.withColumn("component", F.col("id")) if parts is None else nodes.join(parts, "id", "left").withColumn("component", F.coalesce("component", "id"))
    known = written(known, "near-known")
    drop(nodes, all_facts)
    return known


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = SIMILARITY, sketches: int = SKETCHES, block: int = BLOCK) -> DataFrame:
    """(key, class_id) of every row: the least key of its class of texts that are linked by similarity of at least least.

    Equal texts (after normalising case, punctuation and white space) share a class and go on as one. Texts that share an
    order min hash meet in a bucket. First one text of a bucket is its center, and each text is compared with the few centers that it meets most
    often, in rounds with different ones; that joins large groups of near copies by as many comparisons as they have members. Then every two texts of a bucket that
    aren't yet in one class are compared, so each colliding pair is verified or already in one class when this ends: none is
    capped or sampled. Pairs whose lengths or word counts prove them too far apart are told without an alignment.
    Links are then closed transitively. Two texts that share no hash are missed, as min hashing goes.
    Null and wordless texts are classes of their own (class_id is the key); a null key takes the class of its text.
    Rows that share a key have a row each, by their own texts."""
    features = written(_features(docs, [key, text], text, sketches).withColumn("id", F.monotonically_increasing_id()), "near-features")
    known = _linked(features, key, text, least, block, sketches)
    least_key = known.groupBy("component").agg(F.min("key").alias("class_id"))
    known_key = known.join(least_key, "component").select("text_hash", "class_id")
    own = F.col(f"row.{key}")
    found = features.select(F.struct(f"row.{key}").alias("row"), "text_hash").join(known_key, "text_hash", "left").select(own, F.when(F.col("text_hash").isNull(), own).otherwise(F.col("class_id")).alias("class_id"))
    found = written(found, "near-classes")
    drop(features, known)
    return found


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = SIMILARITY, sketches: int = SKETCHES, block: int = BLOCK) -> DataFrame:
    """The rows of docs that stay when one of each class, as above, does: the one of least key, a null key only where the class has no other, and one of equal rows.

    Rows are told apart by themselves and not by their key, so different texts of one key or without one don't replace each other.
    Null and wordless texts are no copies, and stay. All columns stay, whatever they are called."""
    features = written(_features(docs, docs.columns, text, sketches).withColumn("id", F.monotonically_increasing_id()), "near-features")
    known = _linked(features, key, text, least, block, sketches)
    chosen = written(known.groupBy("component").agg(F.min(F.struct("none", "key", "id")).alias("first")).select("first.id"), "near-chosen")
    texts = features.where("text_hash IS NOT NULL").join(chosen, "id", "left_semi").unionByName(features.where("text_hash IS NULL"))
    kept = written(texts.select("row.*"), "near-kept")
    drop(features, known, chosen)
    return kept


def query(spark, sf_dir: str) -> DataFrame:
    return classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
