"""Benchmark decontamination by pigeonhole edit matching.

A test item of n words may occur with up to k edited words. Split into k + 1 pieces, at least one piece of any such
occurrence is exact; piece hits name the places where Myers' bit-parallel distance, on words, decides. Items are a
stated query set: they lie in the shared folder in blocks of bounded size, which each task reads and goes through, an automaton at a time, in one pass over the documents."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.llm.common import local_path, new_folder, unused

#: Characters of items that a block holds, but for a last item that goes beyond; an automaton takes some 60 bytes for each.
BLOCK_CHARS = 2_000_000
#: Bytes of texts that a task holds while it goes through several blocks.
CHUNK_BYTES = 32 << 20
_WORDS = re.compile(r"\w+").findall


def normal_words(text: str | None) -> list[str]:
    return _WORDS(text.lower()) if text else []


def error_budget(n: int, rate: float = 0.1) -> int:
    """Edited words allowed in an item of n words: a tenth, at least one from five words on."""
    return max(int(n * rate), 1 if n >= 5 else 0)


def best_match(pattern: list[str], text: list[str], k: int) -> tuple[int, int, int] | None:
    """(edits, begin, end) of the least word edit distance of pattern to any run of text's words, the earliest such end;
    None if over k. Myers (1999): a column of the matrix is two bit vectors, one step a word of the text; a second run
    over the reversed words finds the begin."""

    def least_end(pattern: list[str], text: list[str], free: bool) -> tuple[int, int]:
        m = len(pattern)
        where: dict[str, int] = {}
        for i, w in enumerate(pattern):
            where[w] = where.get(w, 0) | 1 << i
        full, top = (1 << m) - 1, 1 << (m - 1)
        up, down, score = full, 0, m
        best = (m, 0)
        for j, w in enumerate(text):
            eq = where.get(w, 0)
            xv = eq | down
            xh = (((eq & up) + up) ^ up) | eq
            ph = down | ~(xh | up) & full
            mh = up & xh
            if ph & top:
                score += 1
            elif mh & top:
                score -= 1
            ph = (ph << 1 | (0 if free else 1)) & full
            mh = mh << 1 & full
            up = mh | ~(xv | ph) & full
            down = ph & xv
            if score < best[0]:
                best = (score, j + 1)
        return best

    edits, end = least_end(pattern, text, True)
    if edits > k:
        return None
    again, length = least_end(pattern[::-1], text[:end][::-1], False)
    assert again == edits
    return edits, end - length, end


def all_matches(pattern: list[str], text: list[str], k: int) -> list[tuple[int, int, int]]:
    """The places (edits, begin, end) of pattern in text that don't overlap: the best one, then the best of what lies before it and behind it, and so on."""
    out, parts = [], [(0, len(text))]
    while parts:
        low, high = parts.pop()
        found = best_match(pattern, text[low:high], k) if high - low >= len(pattern) - k else None
        if found:
            edits, begin, end = found
            out.append((edits, low + begin, low + end))
            parts += [(low, low + begin), (low + end, high)]
    return sorted(out, key=lambda m: m[1])


class Items:
    """One block of items, with an automaton over their pieces."""

    def __init__(self, rows: list[tuple[int, list[str]]], rate: float):
        self.items = []
        pieces: dict[str, list[tuple[int, int]]] = {}
        for item_id, words in rows:
            k = error_budget(len(words), rate)
            which = len(self.items)
            self.items.append((item_id, words, k))
            cut = [len(words) * p // (k + 1) for p in range(k + 2)]
            for a, b in zip(cut, cut[1:], strict=False):
                pieces.setdefault(" " + " ".join(words[a:b]) + " ", []).append((which, a))
        self.automaton = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()

    def find(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item_id, edits, begin, end) in words, of places that don't overlap."""
        words = normal_words(text)
        if not words or not len(self.automaton):
            return []
        joined = " " + " ".join(words) + " "
        hits = [(end - size + 1, places) for end, (size, places) in self.automaton.iter(joined)]
        if not hits:
            return []
        begins: dict[int, set[int]] = {}
        number, last = 0, 0
        for at, places in sorted(hits, key=lambda h: h[0]):
            number += joined.count(" ", last, at)
            last = at
            for which, offset in places:
                begins.setdefault(which, set()).add(number - offset)
        out = []
        for which, starts in begins.items():
            item_id, pattern, k = self.items[which]
            group: list[int] = []
            for s in [*sorted(starts), None]:
                if group and (s is None or s - group[-1] > len(pattern) + 2 * k):
                    # Whatever a place that a hit names can reach.
                    low = max(0, group[0] - k)
                    out += [(item_id, edits, low + a, low + b) for edits, a, b in all_matches(pattern, words[low : group[-1] + len(pattern) + k], k)]
                    group = []
                if s is not None:
                    group.append(s)
        return sorted(out)


def _write_blocks(items: DataFrame, item_id: str, text: str, block_chars: int) -> str:
    """Items with a word, as files of (item, text) in the shared folder: a file is a block of about block_chars characters. Items never pass through the driver."""
    spark = items.sparkSession
    some = items.select(F.col(item_id).alias("item"), F.col(text).cast("string").alias("text")).where(F.length("text") > 0)
    total = some.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    folder = new_folder(spark, "leak-items")
    some.repartition(max(1, -(-total // block_chars)), F.xxhash64("item", "text")).write.parquet(folder)
    return folder


class Blocks:
    """The blocks of a folder, an automaton at a time; the last one is kept, so a single block is read once a worker."""

    def __init__(self, folder: str, rate: float):
        self.fs, top = local_path(folder)
        from pyarrow import fs

        self.paths = sorted(f.path for f in self.fs.get_file_info(fs.FileSelector(top)) if f.path.endswith(".parquet"))
        self.rate, self.path, self.held = rate, None, None

    def items(self) -> Iterator[Items]:
        # The block that is held already comes first.
        for path in sorted(self.paths, key=lambda p: p != self.path):
            if path != self.path:
                self.path, self.held = None, None
                with self.fs.open_input_file(path) as f:
                    t = pq.read_table(f)
                self.held = Items([(i, w) for i, x in zip(t["item"].to_pylist(), t["text"].to_pylist(), strict=True) if (w := normal_words(x))], self.rate)
                self.path = path
            yield self.held


def _chunks(batches: Iterator[pa.RecordBatch], at: int, whole: bool) -> Iterator[list[pa.RecordBatch]]:
    """Batches one by one, or in runs of about CHUNK_BYTES of texts, where several automata have to be built for each run."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += pc.sum(pc.binary_length(b.column(at))).as_py() or 0
        if whole or size >= CHUNK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", rate: float = 0.1, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row (key, item_id, edits, begin_word, end_word) for each place where an item occurs in a document with at most error_budget edited words.

    Words are runs of letters, digits and _, lower-cased. A null or wordless text or item matches nothing; items under
    five words must occur exactly. Rows that repeat are matched each by themselves. Of overlapping places of one item in a
    document the one of least distance counts (the earliest end of equals), and places beside it count each.
    A key that is called like a result makes the result's name end in _."""
    names = [unused(n, [key]) for n in ("item_id", "edits", "begin_word", "end_word")]
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField(names[0], items.schema[item_id].dataType)]).add(names[1], "long").add(names[2], "long").add(names[3], "long")
    folder = _write_blocks(items, item_id, item_text, block_chars)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = Blocks(folder, rate)
        types = None
        for run in _chunks(batches, 1, len(blocks.paths) < 2):
            for held in blocks.items():
                for b in run:
                    rows = [(i, *m) for i, t in enumerate(b.column(1)) for m in held.find(t.as_py())]
                    if rows:
                        at, *found = zip(*rows, strict=True)
                        types = types or [pa.array(found[0]).type] + [pa.int64()] * 3
                        yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), *(pa.array(c, k) for c, k in zip(found, types, strict=True))], schema.names)

    return docs.select(F.col(key), F.col(text).cast("string").alias(unused("text", [key]))).mapInArrow(search, schema)


def clean(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", rate: float = 0.1, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of docs in whose text no item occurs, as leaks finds them. Each row is judged by its own text, so null and repeated keys don't matter. All columns stay."""
    schema, at = docs.schema, docs.columns.index(text)
    folder = _write_blocks(items, item_id, item_text, block_chars)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = Blocks(folder, rate)
        for run in _chunks(batches, at, len(blocks.paths) < 2):
            clear = [[True] * b.num_rows for b in run]
            for held in blocks.items():
                for mask, b in zip(clear, run, strict=True):
                    for i, t in enumerate(b.column(at)):
                        if mask[i] and held.find(t.as_py()):
                            mask[i] = False
            for mask, b in zip(clear, run, strict=True):
                yield b.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(keep, schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return leaks(docs, items)
