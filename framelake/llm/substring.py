"""Removal of repeated passages with sharded Aho-Corasick automata.

1. Anchors. Every run of window words holds an anchor, a short gram chosen by its hash alone, so equal windows have equal
   anchors. Anchors that occur once in the corpus rule out the windows around them.
2. Stretches. The windows in a row that share an anchor are one stretch of text. Equal stretches, by a 128-bit digest of their words, are
   brought together first, and only one of each goes on, with its number: near copies have most of theirs in common.
3. Recurring windows are found by counting the 128-bit digests of their words over these stretches. Windows that are always
   followed alike and equally often are chained into one passage: each recurring window lies in exactly one passage, and
   wherever its first window occurs, the whole passage does.
4. Passages are dealt into shards by anchor, and so are the stretches. A task compiles its shard's passages into an automaton over
   words and streams the shard's stretches through it. Shards with many stretches are salted: several tasks compile the same
   automaton and share the stretches. Every document's stretches around recurring anchors are so searched, and what is found holds for
   all places of a stretch. A passage is confirmed by two occurrences of its very words.

Equal texts go through all this once, weighted by their number. Texts are named by the SHA-256 of their characters, never by
their key, so null and repeated keys cost nothing. Tables are deleted once their last reader is written."""

from __future__ import annotations

import collections
import hashlib
import itertools
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.llm.common import WORD_RE, drop, gram_hashes, mix, run_hashes, unused, word_hashes, written

WINDOW = 35
ANCHOR = 8
#: Words of passages that one automaton holds, about; a worker has one at a time.
SHARD_WORDS = 400_000
#: A shard with more stretches than this, and than twice the mean, is shared by several tasks.
SHARD_STRETCHES = 2_000
#: Up to so many involved texts (32 bytes each) their names are broadcast, to leave the others out before texts are shuffled.
BROADCAST_TEXTS = 200_000
#: Bytes of text that a task works on at once.
RUN_BYTES = 1 << 19


def words_of(text: str | None) -> list[str]:
    return WORD_RE.findall(text) if text else []


def _plains(texts: pa.Array) -> list[bytes]:
    """Each text's words, one space between; the white space of bytes.split is that of the contract."""
    return [b" ".join(t.split()) if t else b"" for t in texts.cast(pa.binary()).to_pylist()]


def _joined(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the words of several plain texts in a row, and how many each text has."""
    return word_hashes(b" ".join(raws)), np.array([r.count(b" ") + 1 if r else 0 for r in raws], np.int64)


def _inside(count: np.ndarray, window: int) -> np.ndarray:
    """The beginnings of windows that lie inside one text, of texts of so many words in a row."""
    return np.flatnonzero(np.arange(count.sum()) + window <= np.repeat(np.cumsum(count), count))


def _sid(text: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


_OTHER_WORDS = np.uint64(0xA0761D6478BD642F)


def _digests(words: np.ndarray, begin: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """128 bits of each run of words, as two columns of fixed width, so that Spark counts them in hash maps."""
    return [run_hashes(w, begin, end).view(np.int64) for w in (words, mix(words ^ _OTHER_WORDS))]


_PLACE = (1 << 20) - 1


def anchors_of(words: np.ndarray, window: int = WINDOW, k: int = ANCHOR) -> tuple[np.ndarray, np.ndarray]:
    """For each window the place of its anchor, the k-gram of least hash in it (44 bits of it), leftmost of equals; and all k-grams' hashes."""
    grams = gram_hashes(words, k)
    n, span = len(words) - window + 1, window - k + 1
    at = np.empty(max(n, 0), np.int64)
    step = _PLACE - span
    for a in range(0, n, step):
        part = grams[a : a + step + span - 1]
        x = part & np.uint64(~_PLACE & 0xFFFFFFFFFFFFFFFF) | np.arange(len(part), dtype=np.uint64)
        wide = 1
        while 2 * wide <= span:
            x = np.minimum(x[:-wide], x[wide:])
            wide *= 2
        x = np.minimum(x[: len(part) - span + 1], x[span - wide :])
        at[a : a + step] = (x & np.uint64(_PLACE)).astype(np.int64) + a
    return at, grams


def _arrow_map(df: DataFrame, columns_of, schema: str, text: str = "text") -> DataFrame:
    """df through columns_of(batch) -> list of Arrow arrays or None, in slices of about RUN_BYTES of text."""
    names = T._parse_datatype_string(schema).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = np.cumsum(pc.fill_null(pc.binary_length(b[text]), 0).to_numpy().astype(np.int64) + 64)
            a = 0
            while a < b.num_rows:
                z = max(a + 1, int(np.searchsorted(size, (size[a - 1] if a else 0) + RUN_BYTES)))
                columns = columns_of(b.slice(a, z - a))
                a = z
                if columns is not None:
                    yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)

    return df.mapInArrow(run, schema)


def _lists(values: np.ndarray, count: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(count)]).astype(np.int32), pa.array(values))


def features(docs: DataFrame, key: str, text: str, window: int) -> DataFrame:
    """(row, sid, n_words, plain, at, anchor) of every row: row holds the key, sid names the text, plain is the SHA-256 of its words,
    at and anchor are the places and hashes of its anchors."""
    rows = docs.select(F.struct(F.col(key)).alias("row"), _sid(text).alias("sid"), F.col(text).alias("text"))

    def columns_of(b):
        raws = _plains(b["text"])
        words, count = _joined(raws)
        places, grams = anchors_of(words, window)
        places = np.unique(places[_inside(count, window)])
        ends = np.cumsum(count)
        of = np.searchsorted(ends, places, side="right")
        here = np.bincount(of, minlength=len(raws))
        at = (places - (ends - count)[of]).astype(np.int32)
        return [b["row"], b["sid"], count, pa.array([hashlib.sha256(r).digest() for r in raws], pa.binary()), _lists(at, here), _lists(grams[places].view(np.int64), here)]

    row = rows.schema["row"].dataType.simpleString()
    return _arrow_map(rows, columns_of, f"row {row}, sid binary, n_words long, plain binary, at array<int>, anchor array<long>")


def involved(docs: DataFrame, each: DataFrame, text: str) -> DataFrame:
    """(rid, sid, n, text, at), written: each different text that has an anchor which recurs in the corpus, how many rows have it, and those anchors' places."""
    once = each.where(F.size("at") > 0).groupBy("sid").agg(F.first("at").alias("at"), F.first("anchor").alias("anchor"), F.count("*").alias("n"))
    # Written before it is used again, so the numbers stay.
    once = written(once.withColumn("rid", F.monotonically_increasing_id()), "repeats-texts")
    pairs = once.select("rid", "n", F.explode(F.arrays_zip("at", "anchor")).alias("x")).select("rid", "n", F.col("x.at").alias("at"), F.col("x.anchor").alias("anchor"))
    common = pairs.groupBy("anchor").agg(F.sum("n").alias("total")).where("total > 1").select("anchor")
    marked = pairs.select("rid", "at", "anchor").join(common, "anchor", "left_semi").groupBy("rid").agg(F.collect_list("at").alias("at"))
    marked = written(marked.join(once.select("rid", "sid", "n"), "rid"), "repeats-marked")
    drop(once)
    texts = docs.select(_sid(text).alias("sid"), F.col(text).alias("text"))
    if marked.count() <= BROADCAST_TEXTS:
        texts = texts.join(F.broadcast(marked.select("sid")), "sid", "left_semi")
    # One row of each text, chosen before the shuffle, so a text that very many rows have is not gathered.
    met = texts.groupBy("sid").agg(F.first("text").alias("text")).join(marked, "sid").select("rid", "sid", "n", "text", "at")
    met = written(met, "repeats-involved")
    drop(marked)
    return met


def stretches(texts: DataFrame, window: int) -> DataFrame:
    """(hi, lo, anchor, rid, begin, size, n): the windows in a row that share an anchor which recurs: digest of their words, and where they are."""

    def columns_of(b):
        words, count = _joined(_plains(b["text"]))
        places, grams = anchors_of(words, window)
        first = np.cumsum(count) - count
        known = np.zeros(len(words), bool)
        known[pc.list_flatten(b["at"]).to_numpy() + np.repeat(first, pc.list_value_length(b["at"]).to_numpy())] = True
        inside = _inside(count, window)
        places = places[inside]
        # Anchors of two texts never have one place, so a stretch ends with its text.
        cut = np.flatnonzero(np.diff(places, prepend=-1))
        begin, end = inside[cut], inside[np.append(cut[1:], len(inside)) - 1] + window
        of_known = known[places[cut]]
        begin, end, places = begin[of_known], end[of_known], places[cut][of_known]
        of = np.searchsorted(np.cumsum(count), begin, side="right")
        rid, n = (b[c].to_numpy()[of] for c in ("rid", "n"))
        return [*_digests(words, begin, end), grams[places].view(np.int64), rid, (begin - first[of]).astype(np.int32), (end - begin).astype(np.int32), n]

    return _arrow_map(texts.select("rid", "n", "text", "at"), columns_of, "hi long, lo long, anchor long, rid long, begin int, size int, n long")


def different(texts: DataFrame, places: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two written tables: of each different stretch one place, n and stid; and (stid, anchor, n, words): its words, and how often it occurs."""
    least = [F.min("rid").alias("rid"), F.min_by("begin", "rid").alias("begin"), F.min("size").alias("size"), F.min("anchor").alias("anchor"), F.sum("n").alias("n")]
    names = written(places.groupBy("hi", "lo").agg(*least).withColumn("stid", F.monotonically_increasing_id()), "repeats-names")
    by_text = names.groupBy("rid").agg(F.collect_list(F.struct("stid", "begin", "size", "anchor", "n")).alias("places"))

    def columns_of(b):
        found = []
        for t, places in zip(b["text"], b["places"], strict=True):
            words = words_of(t.as_py())
            of = [places.values.field(k).to_pylist() for k in range(5)]
            found += [(stid, anchor, n, " ".join(words[begin : begin + size])) for stid, begin, size, anchor, n in zip(*of, strict=True)]
        return [pa.array(c, t) for c, t in zip(zip(*found, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)]

    words = _arrow_map(texts.select("rid", "text").join(by_text, "rid").select("text", "places"), columns_of, "stid long, anchor long, n long, words string")
    return names, written(words, "repeats-stretches")


def recurring(words: DataFrame, window: int) -> DataFrame:
    """(stid, at, n, alike): for each window that occurs twice or more, one place of it, its number, and whether the same window follows everywhere."""

    def columns_of(b):
        hashes, count = _joined(b["words"].cast(pa.binary()).to_pylist())
        at = _inside(count, window)
        of = np.searchsorted(np.cumsum(count), at, side="right")
        hi, lo = _digests(hashes, at, at + window)
        goes_on = np.append(at[1:] == at[:-1] + 1, False)
        stid, n = (b[c].to_numpy()[of] for c in ("stid", "n"))
        begin = (np.cumsum(count) - count)[of]
        return [hi, lo, stid, (at - begin).astype(np.int32), n, pa.array(np.roll(hi, -1), mask=~goes_on)]

    each = _arrow_map(words.select("stid", "n", "words"), columns_of, "hi long, lo long, stid long, at int, n long, follows long", "words")
    # Windows of one chain have the same stretches, and so the same least one.
    met = each.groupBy("hi", "lo").agg(F.sum("n").alias("n"), F.min("stid").alias("stid"), F.min_by("at", "stid").alias("at"), F.min("follows").alias("low"), F.max("follows").alias("high"), F.count("follows").alias("followed"), F.count("*").alias("rows"))
    return met.where("n > 1").select("stid", "at", "n", F.coalesce(F.expr("low = high AND followed = rows"), F.lit(False)).alias("alike"))


def passages(words: DataFrame, places: DataFrame, window: int) -> DataFrame:
    """(anchor, passage, n_words): the recurring windows' words, chained where they always follow each other."""
    by_stretch = places.groupBy("stid").agg(F.collect_list(F.struct("at", "n", "alike")).alias("places"))

    def columns_of(b):
        values = pc.list_flatten(b["places"])
        of = np.repeat(np.arange(b.num_rows), pc.list_value_length(b["places"]).to_numpy())
        at, n, alike = (values.field(k).to_numpy(zero_copy_only=False) for k in range(3))
        order = np.lexsort((at, of))
        of, at, n, alike = of[order], at[order], n[order], alike[order].astype(bool)
        goes_on = alike[:-1] & (of[1:] == of[:-1]) & (at[1:] == at[:-1] + 1) & (n[1:] == n[:-1])
        last = np.append(np.flatnonzero(~goes_on), len(at) - 1)
        first = np.append(0, last[:-1] + 1)
        split = [t.as_py().split(" ") for t in b["words"]]
        found = [" ".join(split[i][x:y]) for i, x, y in zip(of[first].tolist(), at[first].tolist(), (at[last] + window).tolist(), strict=True)]
        return [b["anchor"].to_numpy()[of[first]], pa.array(found, pa.string()), (at[last] - at[first] + window).astype(np.int64)]

    chosen = words.select("stid", "anchor", "words").join(by_stretch, "stid").select("anchor", "words", "places")
    return _arrow_map(chosen, columns_of, "anchor long, passage string, n_words long", "words")


class Shard:
    """An automaton over the words of some passages, (number, text)."""

    def __init__(self, some: list[tuple[int, str]]):
        self.number: dict[str, int] = collections.defaultdict(itertools.count(1).__next__)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for k, p in some:
            words = tuple(map(self.number.__getitem__, p.split(" ")))
            self.automaton.add_word(words, (k, len(words)))
        if len(self.automaton):
            self.automaton.make_automaton()

    def hits(self, words: list[str]) -> list[tuple[int, int, int]]:
        """(number, a, b) of each occurrence of a passage, as words a to b."""
        if not len(self.automaton):
            return []
        return [(k, end + 1 - size, end + 1) for end, (k, size) in self.automaton.iter(tuple(map(self.number.get, words, itertools.repeat(0))))]


def _merged(spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return [{"a": a, "b": b} for a, b in out]


_SPANS = "array<struct<a:int,b:int>>"


def located(words: DataFrame, found: DataFrame, shard_words: int = SHARD_WORDS, shard_stretches: int = SHARD_STRETCHES) -> DataFrame:
    """(stid, spans): where passages (pid, anchor, passage, n_words) occur in the stretches.

    An occurrence counts if its passage has another one, word by word: each task counts its own, and what it has seen once is counted
    over the tasks that share the shard. So two windows whose digests are equal by chance remove nothing."""
    spark = words.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = found.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    shards = max(parts, -(-total // shard_words))
    shard = F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard")
    sizes = words.groupBy(shard).agg(F.count("*").alias("n"))
    most = max(shard_stretches, 2 * sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] // shards)
    # A row a shard, whose number the words of passages bound. A shard with too many words for one automaton, as an anchor that very many passages share makes it, is dealt
    # into parts: a passage is in one of them, and the shard's stretches go through each.
    sums = found.groupBy(shard).agg(F.greatest(F.lit(1), F.ceil(F.sum("n_words") / (2 * shard_words))).cast("int").alias("pieces"))
    salts = written(sums.join(sizes, "shard").select("shard", "pieces", F.ceil(F.col("n") / most).cast("int").alias("salts")), "repeats-salts")
    shared = (F.col("salts") > 1).alias("shared")
    salt = F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    piece = F.pmod(F.xxhash64("pid"), F.col("pieces")).cast("int").alias("piece")
    mine = found.select(shard, "pid", "passage").join(salts, "shard").select("shard", piece, salt, shared, "pid", F.lit(None).cast("long").alias("stid"), F.lit(0).cast("long").alias("n"), F.col("passage").alias("words"))
    salt = F.pmod(F.xxhash64("stid"), F.col("salts")).cast("int").alias("salt")
    piece = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece")
    theirs = words.select(shard, "stid", "n", "words").join(salts, "shard").select("shard", piece, salt, shared, F.lit(None).cast("long").alias("pid"), "stid", "n", "words")
    dealt = mine.unionByName(theirs).repartition(max(parts, shards), "shard", "piece", "salt").sortWithinPartitions("shard", "piece", "salt", F.col("stid").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(held: list[tuple[int, int, list]], shared: bool) -> list[tuple]:
            counts: collections.Counter = collections.Counter()
            for _, n, hits in held:
                for k, _, _ in hits:
                    counts[k] += n
            out = []
            for stid, n, hits in held:
                if spans := [(a, b) for k, a, b in hits if counts[k] > 1]:
                    out.append((stid, None, 0, _merged(spans)))
                out += [(stid, k, n, [{"a": a, "b": b}]) for k, a, b in hits if counts[k] == 1]
            return out + [(None, k, n, None) for k, n in counts.items() if shared and n > 1]

        now, some, automaton, held, rows = None, [], None, [], []
        for b in itertools.chain(batches, [None]):
            for place, part, salt, shared, pid, stid, n, text in zip(*(c.to_pylist() for c in b.columns), strict=True) if b is not None else [(None,) * 8]:
                if (place, part, salt, shared) != now:
                    if held:
                        rows += done(held, now[3])
                    now, some, automaton, held = (place, part, salt, shared), [], None, []
                if pid is not None:
                    some.append((pid, text))
                elif stid is not None:
                    if automaton is None:
                        automaton, some = Shard(some), []
                    if hits := automaton.hits(text.split(" ")):
                        held.append((stid, n, hits))
            if rows:
                types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["stid", "pid", "n", "spans"])
                rows = []

    hits = written(dealt.mapInArrow(run, f"stid long, pid long, n long, spans {_SPANS}"), "repeats-hits")
    once = hits.where("pid IS NOT NULL")
    again = once.groupBy("pid").agg(F.sum("n").alias("total")).where("total > 1").select("pid")
    spans = hits.where("pid IS NULL").select("stid", "spans").unionByName(once.where("stid IS NOT NULL").join(again, "pid", "left_semi").select("stid", "spans"))
    out = written(spans, "repeats-spans")
    drop(salts, hits)
    return out


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What the results are made of, written: each row's (row, sid, n_words, plain), the involved texts, and the spans of their repeated words by rid."""
    if window < ANCHOR:
        raise ValueError(f"a window has at least {ANCHOR} words")
    each = written(features(docs, key, text, window), "repeats-features")
    texts = involved(docs, each, text)
    places = written(stretches(texts, window), "repeats-places")
    names, words = different(texts, places)
    found = written(passages(words, recurring(words, window), window).withColumn("pid", F.monotonically_increasing_id()), "repeats-passages")
    spans = located(words, found, shard_words)
    drop(words, found)
    by_name = written(names.select("hi", "lo", "stid").join(spans, "stid").select("hi", "lo", "spans"), "repeats-known")
    drop(names, spans)
    shifted = F.transform("spans", lambda s: F.struct((s["a"] + F.col("begin")).alias("a"), (s["b"] + F.col("begin")).alias("b")))
    of_texts = places.select("hi", "lo", "rid", "begin").join(by_name, ["hi", "lo"]).groupBy("rid").agg(F.flatten(F.collect_list(shifted)).alias("spans"))
    of_texts = written(of_texts, "repeats-located")
    drop(places, by_name)
    return each, texts, of_texts


def _covered(count: np.ndarray, spans: pa.Array) -> np.ndarray:
    """Which words of texts in a row, of so many words each, lie in the texts' spans."""
    first = np.repeat(np.cumsum(count) - count, pc.list_value_length(spans).to_numpy())
    values = pc.list_flatten(spans)
    edge = np.zeros(count.sum() + 1, np.int64)
    np.add.at(edge, values.field(0).to_numpy() + first, 1)
    np.add.at(edge, values.field(1).to_numpy() + first, -1)
    return np.cumsum(edge[:-1]) > 0


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(key, n_words, n_removed, kept_sha256) of every row.

    A word goes if a run of window words that covers it occurs anywhere else, in the same row or another, equal rows
    included; all of its occurrences go. Null, empty and shorter texts lose nothing. Each row is judged by its own text, so null and
    repeated keys don't matter; other columns are left out."""
    each, texts, spans = repeats(docs, key, text, window, shard_words)

    def columns_of(b):
        texts = [t.split(b" ") for t in _plains(b["text"])]
        count = np.array([len(t) for t in texts], np.int64)
        gone = _covered(count, b["spans"])
        ends = np.cumsum(count)
        stays = [(~gone[z - n : z]).tolist() for n, z in zip(count.tolist(), ends.tolist(), strict=True)]
        kept = [hashlib.sha256(b" ".join(itertools.compress(t, s))).digest() for t, s in zip(texts, stays, strict=True)]
        return [b["sid"], np.add.reduceat(gone.astype(np.int64), ends - count), pa.array(kept, pa.binary())]

    changed = written(_arrow_map(texts.join(spans, "rid").select("sid", "text", "spans"), columns_of, "sid binary, n_removed long, kept binary"), "repeats-changed")
    drop(texts, spans)
    out = each.select("row", "sid", "n_words", "plain").join(changed, "sid", "left")
    return out.select(f"row.{key}", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.lower(F.hex(F.coalesce("kept", "plain"))).alias("kept_sha256"))


def _cut(text: str, spans: pa.Array) -> str:
    words = list(WORD_RE.finditer(text))
    gone = _covered(np.array([len(words)], np.int64), spans)
    edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
    kept, last = [], 0
    for a, b in zip(edge[::2], edge[1::2], strict=True):
        kept.append(text[last : words[a].start()].rstrip() if a else "")
        last = words[b].start() if b < len(words) else len(text)
    kept.append(text[last:])
    return "\n".join(k for k in kept if k)


def remove(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """docs with the repeated words, as above, cut from the text; what stays keeps its white space, but for what stood around a cut.
    All rows and columns stay, whatever they are called."""
    each, texts, spans = repeats(docs, key, text, window, shard_words)
    sid, cut = unused("sid", docs.columns), unused("spans", docs.columns)
    cuts = written(texts.select("rid", "sid").join(spans, "rid").select(F.col("sid").alias(sid), F.col("spans").alias(cut)), "repeats-cuts")
    drop(each, texts, spans)
    names, at = docs.columns, docs.columns.index(text)
    joined = docs.withColumn(sid, _sid(text)).join(cuts, sid, "left").select(cut, *docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = [t.as_py() if not s.is_valid else _cut(t.as_py(), b.column(0).slice(k, 1)) for k, (s, t) in enumerate(zip(b.column(0), b.column(at + 1), strict=True))]
            columns = b.columns[1:]
            columns[at] = pa.array(new, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return joined.mapInArrow(run, docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
