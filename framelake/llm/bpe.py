"""Byte-level BPE, encoding and decoding.

A piece's merges are found with a segment tree over its byte positions: a node holds the least rank of a neighbouring
pair below it, ties going left, so the next merge is read at the root's path and each merge updates three live
positions in logarithmic time. Words repeat, so each Python worker remembers a
bounded number of them, and the new words of a run of texts are merged together, one tree a row of an array."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_NONE = 1 << 60
_SLOT_BITS = 20
#: Words a worker remembers; beyond, new ones are merged again in each run of texts.
REMEMBERED = 250_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """The ids of one piece: merge the leftmost pair of least rank until no pair has a rank."""
    if piece in ranks:
        return (ranks[piece],)
    n = len(piece)
    leaves = 1
    while leaves < n:
        leaves *= 2
    tree = [_NONE] * (2 * leaves)
    rank = ranks.get
    for i in range(n - 1):
        tree[leaves + i] = rank(piece[i : i + 2], _NONE)
    for node in range(leaves - 1, 0, -1):
        a, b = tree[2 * node], tree[2 * node + 1]
        tree[node] = a if a <= b else b
    end = list(range(1, n + 1))  # of the live part that begins here
    before = list(range(-1, n - 1))  # where the live part before this one begins

    def put(i: int, value: int) -> None:
        i += leaves
        tree[i] = value
        while i > 1:
            i >>= 1
            a, b = tree[2 * i], tree[2 * i + 1]
            value = a if a <= b else b
            if tree[i] == value:
                break
            tree[i] = value

    while (least := tree[1]) != _NONE:
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] != least:
                node += 1
        i = node - leaves
        gone = end[i]
        end[i] = end[gone]
        if end[i] < n:
            before[end[i]] = i
            put(i, rank(piece[i : end[end[i]]], _NONE))
        else:
            put(i, _NONE)
        put(gone, _NONE)
        if (b := before[i]) >= 0:
            put(b, rank(piece[b : end[i]], _NONE))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = end[i]
    return tuple(ids)


class Codec:
    """Text to ids and back, by a file of ranks and a pattern of pieces.

    The pattern must be of the usual kind for byte-level BPE: a piece is letters, digits or signs after at most one
    space, or a run of white space, so that every single space between words begins a piece."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.bytes_of = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for b, r in self.ranks.items():
            self.bytes_of[r] = b
        self.byte_ids = np.array([self.ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        pairs = [(self.ranks[x] << 32 | self.ranks[y], r) for b, r in self.ranks.items() for i in range(1, len(b)) if (x := b[:i]) in self.ranks and (y := b[i:]) in self.ranks]
        self.pair_keys, self.pair_ranks = np.array(sorted(pairs), np.int64).reshape(-1, 2).T.copy()
        self.pieces = regex.compile(pattern).findall
        white = regex.compile(r"\s").match
        self.white = frozenset(c for c in map(chr, range(0x3001)) if white(c))
        self.word_ids: dict[str, tuple[int, ...]] = {}
        # The pairs once more in a table by hash; a pair whose place is taken is looked up in the sorted keys.
        self.slot_keys = np.full(1 << _SLOT_BITS, -1, np.int64)
        self.slot_ranks = np.full(1 << _SLOT_BITS, _NONE, np.int64)
        slot = self._slot(self.pair_keys)
        self.slot_keys[slot], self.slot_ranks[slot] = self.pair_keys, self.pair_ranks
        self.byte_pair = self._pair_rank(np.repeat(self.byte_ids, 256), np.tile(self.byte_ids, 256))

    @staticmethod
    def _slot(key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)

    def _pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks of pairs of ids, _NONE where an id is -1 or the pair has no rank."""
        key = left << 32 | right
        slot = self._slot(key)
        there = self.slot_keys[slot]
        rank = np.where(there == key, self.slot_ranks[slot], _NONE)
        other = np.flatnonzero((there != key) & (there >= 0))
        if len(other):
            at = np.minimum(np.searchsorted(self.pair_keys, key[other]), len(self.pair_keys) - 1)
            rank[other] = np.where(self.pair_keys[at] == key[other], self.pair_ranks[at], _NONE)
        rank[(left < 0) | (right < 0)] = _NONE
        return rank

    def _merge_alike(self, pieces: list[bytes], leaves: int) -> list[tuple[int, ...]]:
        """merge_piece of pieces of at most so many bytes at once: one segment tree a row, each round one merge in every unfinished row."""
        n = len(pieces)
        size = np.fromiter(map(len, pieces), np.int64, n)
        raw = np.frombuffer(b"".join(p.ljust(leaves, b"\0") for p in pieces), np.uint8).reshape(n, leaves)
        ids = np.full((n, leaves + 1), -1, np.int64)
        ids[:, :leaves] = np.where(np.arange(leaves) < size[:, None], self.byte_ids[raw], -1)
        after = np.tile(np.arange(1, leaves + 2), (n, 1))
        before = np.tile(np.arange(-1, leaves), (n, 1))
        tree = np.full((n, 2 * leaves), _NONE, np.int64)
        first = self.byte_pair[raw[:, :-1].astype(np.int64) << 8 | raw[:, 1:]]
        tree[:, leaves:-1] = np.where(np.arange(1, leaves) < size[:, None], first, _NONE)
        width = leaves
        while width > 1:
            half = width // 2
            level = tree[:, width : 2 * width]
            tree[:, half:width] = np.minimum(level[:, ::2], level[:, 1::2])
            width = half
        rows = np.flatnonzero(tree[:, 1] != _NONE)
        while len(rows):
            least = tree[rows, 1]
            node = np.ones(len(rows), np.int64)
            for _ in range(leaves.bit_length() - 1):
                node = 2 * node
                node += tree[rows, node] != least
            i = node - leaves
            gone = after[rows, i]
            ids[rows, i] = least
            k = np.minimum(after[rows, gone], leaves)
            ids[rows, gone] = -1
            after[rows, i], before[rows, k] = k, i
            p = before[rows, i]
            tree[rows, leaves + gone] = _NONE
            tree[rows, leaves + i] = self._pair_rank(ids[rows, i], ids[rows, k])
            has = np.flatnonzero(p >= 0)
            tree[rows[has], leaves + p[has]] = self._pair_rank(ids[rows[has], p[has]], ids[rows[has], i[has]])
            for at in (gone, i, np.where(p >= 0, p, i)):
                at = at + leaves
                for _ in range(leaves.bit_length() - 1):
                    at = at >> 1
                    tree[rows, at] = np.minimum(tree[rows, 2 * at], tree[rows, 2 * at + 1])
            rows = rows[tree[rows, 1] != _NONE]
        live = ids >= 0
        flat, ends = ids[live].tolist(), np.cumsum(live.sum(axis=1)).tolist()
        return [tuple(flat[a:b]) for a, b in zip([0, *ends], ends, strict=False)]

    def merge_all(self, pieces: set[str]) -> dict[str, tuple[int, ...]]:
        """The ids of each piece; those of up to 64 bytes are merged together by size, longer ones one by one."""
        out, alike, rank = {}, {}, self.ranks.get
        for piece in pieces:
            raw = piece.encode()
            if (whole := rank(raw)) is not None:
                out[piece] = (whole,)
            elif len(raw) > 64:
                out[piece] = merge_piece(raw, self.ranks)
            else:
                alike.setdefault(1 << (len(raw) - 1).bit_length(), []).append((piece, raw))
        for leaves, some in alike.items():
            for a in range(0, len(some), 4096):
                part = some[a : a + 4096]
                out.update(zip([p for p, _ in part], self._merge_alike([r for _, r in part], leaves), strict=True))
        return out

    def _cut(self, word: str) -> list[str]:
        """The pieces of a space and word; letters of the older Latin blocks, then at most one sign, are known to be one piece and one more."""
        if word.isalpha() and max(word) < "\u0250":
            return [" " + word]
        if word[:-1].isalpha() and word[-1] in ".,;:!?" and max(word) < "\u0250":
            return [" " + word[:-1], word[-1]]
        return self.pieces(" " + word)

    def encode_many(self, texts: list[str]) -> list[list[int]]:
        """Each text's ids. A text is cut at single spaces, and words not yet known are merged together; one with runs of white space is cut by the pattern as a whole."""
        known, white = self.word_ids, self.white
        cuts: list[tuple[list[str], bool]] = []
        words: set[str] = set()
        pieces: set[str] = set()
        for t in texts:
            cut = t.split(" ")
            new = set(cut[1:]).difference(known)
            plain = bool(cut[0]) and cut[0][-1] not in white and all(w and w[0] not in white and w[-1] not in white for w in new)
            if plain:
                words |= new
            else:
                cut = self.pieces(t)
                pieces.update(cut)
            cuts.append((cut, plain))
        split = {w: self._cut(w) for w in words}
        first = [self.pieces(cut[0]) if plain else [] for cut, plain in cuts]
        pieces.update(chain.from_iterable(split.values()), chain.from_iterable(first))
        of = self.merge_all(pieces).__getitem__
        known.update((w, tuple(chain.from_iterable(map(of, p)))) for w, p in split.items())
        word = known.__getitem__
        out = []
        for (cut, plain), start in zip(cuts, first, strict=True):
            if plain:
                ids = list(chain.from_iterable(map(of, start)))
                ids.extend(chain.from_iterable(map(word, cut[1:])))
            else:
                ids = list(chain.from_iterable(map(of, cut)))
            out.append(ids)
        if len(known) > REMEMBERED:
            for w in split:
                del known[w]
        return out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def runs(texts, size: int = 1 << 20) -> Iterator[list[str]]:
    """The texts, null as empty, in runs of about so many characters."""
    held, n = [], 0
    for t in texts:
        held.append(t or "")
        n += len(held[-1])
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """docs with an array<int> of ids. path: a file of ranks that every executor has. A null text counts as empty: no ids. A column named ids is replaced."""

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = codec(path, pattern)
        for s in texts:
            yield pd.Series([ids for some in runs(s) for ids in c.encode_many(some)], dtype=object)

    return docs.withColumn(ids, F.pandas_udf(run, "array<int>")(F.col(text)))


def decode(docs: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """docs with the bytes that ids stand for; null ids give null, an unknown id raises."""

    def run(lists: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = codec(path, pattern)
        for s in lists:
            yield pd.Series([None if x is None else c.decode(x.tolist()) for x in s], dtype=object)

    return docs.withColumn(out, F.pandas_udf(run, "binary")(F.col(ids)))


def round_trip(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of every row: encoded, decoded from the ids and digested in one pass over each batch."""
    schema = docs.select(key).schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            n, first, second = [], [], []
            for some in runs(t.as_py() for t in batch.column(1)):
                for ids in c.encode_many(some):
                    n.append(len(ids))
                    first.append(hashlib.sha256(str(ids)[1:-1].replace(" ", "").encode()).hexdigest())
                    second.append(hashlib.sha256(c.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string())], [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(key, text).mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
