"""Token ids as Arrow files of equal-length sequences.

Documents are range-partitioned by id and sorted; a task encodes them and writes the ids as one Arrow file whose batches are fixed-size
lists, ids and a mask, so a reader maps the file and reaches any sequence without copying. A second small Arrow file
tells where each document lies. Files get a name of their own for each attempt and only those in the manifest count, so
a task that is run again after a lost executor leaves no half-written file behind that is read."""

from __future__ import annotations

import json
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.llm.common import local_path, new_folder, unused, written

#: Pieces whose ids a worker remembers; the library encodes others each time.
REMEMBERED = 600_000
#: Texts of about so many bytes are encoded together.
RUN_BYTES = 2 << 20
MANIFEST = "part int, path string, documents long, tokens long"


# Classes of bytes: letters (ASCII, and both bytes of U+00C0 to U+027F), digits, signs, space, other white space, and all others.
_LETTER, _DIGIT, _SIGN, _SPACE, _WHITE, _OTHER = range(6)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[0x21:0x7F] = _SIGN
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0xC0), *range(0xC3, 0xCA)]] = _LETTER
_CLASS[0x30:0x3A] = _DIGIT
_CLASS[0x20] = _SPACE
_CLASS[0x09:0x0E] = _WHITE


def piece_starts(raw: np.ndarray, begin: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Where a piece begins among the bytes of texts that lie in a row from begin on, none of them empty.

    Pieces are those of the usual byte-level pattern: contractions, then letters, digits or signs with at most one space before them, then white
    space, whose last character is left to what follows. A text flagged whole, or with a byte of no simple class, is one piece."""
    kind = _CLASS[raw]
    n = len(raw)
    first = np.zeros(n + 1, bool)
    first[begin] = first[n] = True
    # × and ÷ are signs; C2 and what lies beyond U+027F are of class other.
    kind[1:][(raw[:-1] == 0xC3) & ((raw[1:] == 0x97) | (raw[1:] == 0xB7))] = _OTHER
    owner = np.repeat(np.arange(len(begin)), np.diff(begin, append=n))
    whole = whole.copy()
    whole[owner[kind == _OTHER]] = True
    white = kind >= _SPACE
    kind[white] = _SPACE
    starts = first[:-1].copy()
    starts[1:] |= (kind[1:] != kind[:-1]) & (white[1:] | (raw[:-1] != 0x20))
    starts[:-1] |= white[:-1] & ~white[1:] & ~first[1:-1]
    quote = np.flatnonzero((raw[:-2] == 0x27) & starts[:-2] & (kind[1:-1] == _LETTER) & ~first[1:-2]) if n > 2 else np.empty(0, np.int64)
    if n > 1 and raw[-2] == 0x27 and starts[-2] and not first[n - 1] and raw[-1] in b"stmd":
        starts[-1] = False
    x, y = raw[quote + 1], raw[quote + 2]
    two = ~first[quote + 2] & (((x == 0x72) | (x == 0x76)) & (y == 0x65) | (x == 0x6C) & (y == 0x6C))
    one = (x == 0x73) | (x == 0x74) | (x == 0x6D) | (x == 0x64)
    starts[quote[one | two] + 1] = False
    after = np.concatenate([quote[one] + 2, quote[two] + 3])
    after = after[after < n]
    starts[after[~first[after] & (kind[after] == _LETTER)]] = True
    starts[whole[owner]] = False
    starts[begin] = True
    return starts


class Encoder:
    """The tokenizers library, asked once for each piece of text a worker meets.

    Merges never cross the pieces of the byte-level pattern, so a text's ids are those of its pieces in turn. A text with unusual characters, or
    with a token that the library takes out before it cuts pieces (such as the end-of-text token), is encoded whole, and so is every text if
    the tokenizer isn't of this kind."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        cut = parts["pre_tokenizer"] or {}
        self.by_piece = parts["normalizer"] is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space", True)
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.known: dict[str, bytes] = {}

    def _ask(self, texts: list[str]) -> list[bytes]:
        code = "H" if self.kind is np.uint16 else "I"
        return [array(code, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null as empty) in a row, and how many each has."""
        texts = pa.concat_arrays([pc.fill_null(texts, "")])
        bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        full = np.flatnonzero(np.diff(bounds))
        number = np.zeros(len(texts), np.int64)
        if not len(full):
            return np.empty(0, self.kind), number
        raw = np.frombuffer(texts.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
        begin = bounds[full] - bounds[0]
        whole = np.full(len(full), not self.by_piece)
        for token in self.added:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)[full]
        at = np.append(np.flatnonzero(piece_starts(raw, begin, whole)), len(raw)).astype(np.int32)
        pieces = pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(raw)).dictionary_encode()
        named = pieces.dictionary.to_pylist()
        new = [w for w in named if w not in self.known]
        self.known.update(zip(new, self._ask(new), strict=True))
        entries = list(map(self.known.__getitem__, named))
        room = REMEMBERED - len(self.known) + len(new)
        for k, w in enumerate(new):
            if k >= room or len(w) > 64:
                del self.known[w]
        flat = np.frombuffer(b"".join(entries), self.kind)
        size = np.fromiter(map(len, entries), np.int64, len(entries)) // flat.itemsize
        index = pieces.indices.to_numpy()
        each = size[index]
        ends = np.cumsum(each)
        # Each id's place in flat: where its piece begins there, less where the piece begins in the result.
        shift = (np.cumsum(size) - size)[index] - (ends - each)
        ids = flat[np.arange(ends[-1]) + np.repeat(shift, each)]
        number[full] = np.add.reduceat(each, np.searchsorted(at, begin))
        return ids, number


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


def ended(enc: Encoder, texts: pa.Array, end_id: int, kind: type) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids of runs of texts of about RUN_BYTES, end_id behind those of each text, and how many each has."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64))
    a = 0
    while a < len(texts):
        z = max(a + 1, int(np.searchsorted(size, (size[a - 1] if a else 0) + RUN_BYTES)))
        ids, n = enc.encode(texts.slice(a, z - a))
        n = n + 1
        out = np.full(n.sum(), end_id, kind)
        inside = np.ones(len(out), bool)
        inside[np.cumsum(n) - 1] = False
        out[inside] = ids
        yield out, n
        a = z


def write(docs: DataFrame, folder: str, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = 0, length: int = 2048, rows: int = 256) -> DataFrame:
    """Writes docs in ascending key order under folder and returns the manifest (part, path, documents, tokens), itself a table there.

    path.seq.arrow: batches of up to rows sequences, ids fixed_size_list<uint16 or uint32>[length] and mask
    fixed_size_list<bool>[length], false in the padding of a file's last sequence. path.doc.arrow: key, start (in the
    file) and n_tokens of each document. A null text is empty, so end_id alone; null keys come first; equal keys are
    ordered by their text's hash and then by a number, by which they are also dealt to several files. An empty table gives a manifest
    without files. Columns other than key and text are left out."""
    spark = docs.sparkSession
    key_type = docs.schema[key].dataType
    arrow_key = pa.int64() if isinstance(key_type, T.LongType) else pa.int32() if isinstance(key_type, T.IntegerType) else pa.string()
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    at, top_folder = local_path(folder)
    at.create_dir(top_folder, recursive=True)

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        fs, top = local_path(folder)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        kind = np.uint16 if max(enc.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else np.uint32
        ids_type, mask_type = pa.list_(pa.from_numpy_dtype(kind), length), pa.list_(pa.bool_(), length)
        schema = pa.schema([("ids", ids_type), ("mask", mask_type)])
        doc_schema = pa.schema([(key, arrow_key), ("start", pa.int64()), ("n_tokens", pa.int64())])
        held: list[np.ndarray] = []
        held_n = done = count = 0
        seq = doc = None

        def flush(last: bool) -> None:
            nonlocal held, held_n
            flat = np.concatenate(held) if held else np.empty(0, kind)
            full = len(flat) // length if not last else -(-len(flat) // length)
            padded = np.zeros(full * length, kind)
            padded[: min(len(flat), full * length)] = flat[: full * length]
            mask = pa.array(np.arange(full * length) < len(flat))
            for a in range(0, full, rows):
                b = min(full, a + rows)
                lists = [pa.FixedSizeListArray.from_arrays(x[a * length : b * length], length) for x in (pa.array(padded), mask)]
                seq.write_batch(pa.RecordBatch.from_arrays(lists, schema=schema))
            held = [flat[full * length :]] if not last else []
            held_n = len(held[0]) if held else 0

        sink = []
        for batch in batches:
            if not batch.num_rows:
                continue
            if seq is None:
                sink = [fs.open_output_stream(f"{top}/{name}.{x}.arrow") for x in ("seq", "doc")]
                seq, doc = pa.ipc.new_file(sink[0], schema), pa.ipc.new_file(sink[1], doc_schema)
            a = 0
            for flat, n in ended(enc, batch.column(1), end_id, kind):
                held.append(flat)
                held_n += len(flat)
                if held_n >= length * rows:
                    flush(False)
                keys = batch.column(0).slice(a, len(n)).cast(arrow_key)
                doc.write_batch(pa.RecordBatch.from_arrays([keys, pa.array(done + np.cumsum(n) - n), pa.array(n)], schema=doc_schema))
                done += int(n.sum())
                count += len(n)
                a += len(n)
        if seq is not None:
            flush(True)
            for x in (seq, doc, *sink):
                x.close()
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([f"{folder}/{name}"]), pa.array([count], pa.int64()), pa.array([done], pa.int64())], ["part", "path", "documents", "tokens"])

    tie, row = unused("tie", [key, text]), unused("row", [key, text])
    order = [F.col(key).asc_nulls_first(), F.col(tie), F.col(row)]
    told = docs.select(key, text).withColumns({tie: F.xxhash64(text), row: F.monotonically_increasing_id()})
    ordered = told.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(key, text)
    return written(ordered.mapInArrow(save, MANIFEST), "sequences-manifest")


def read(manifest: DataFrame, key_type: str = "bigint", key: str = "doc_id", base: str = "base") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every document, from the files: start counts the ids of all documents before it,
    ids_crc32 is taken over the ids as little-endian unsigned 32-bit integers. Files are mapped where the storage can, and read batch by batch."""
    spark = manifest.sparkSession
    before = F.coalesce(F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    listed = manifest.withColumn(base, before).repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "part")

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, first in zip(b["path"], b[base], strict=True):
                fs, at = local_path(path)
                opened = [pa.memory_map(f"{at}.{x}.arrow") if fs.type_name == "local" else fs.open_input_file(f"{at}.{x}.arrow") for x in ("seq", "doc")]
                seq, doc = map(pa.ipc.open_file, opened)
                blocks = (seq.get_batch(k).column("ids").flatten().to_numpy() for k in range(seq.num_record_batches))
                rest = np.empty(0, np.uint16)
                for k in range(doc.num_record_batches):
                    d = doc.get_batch(k)
                    crcs = []
                    for n in d.column("n_tokens").to_pylist():
                        crc = 0
                        while n > len(rest):
                            crc, n = zlib.crc32(rest.astype("<u4").tobytes(), crc), n - len(rest)
                            rest = next(blocks)
                        crcs.append(zlib.crc32(rest[:n].astype("<u4").tobytes(), crc))
                        rest = rest[n:]
                    yield pd.DataFrame({key: d.column(0).to_pandas(types_mapper={pa.int64(): pd.Int64Dtype(), pa.int32(): pd.Int32Dtype()}.get), "start": d.column("start").to_numpy() + int(first), "n_tokens": d.column("n_tokens").to_numpy(), "ids_crc32": np.array(crcs, np.int64)})
                for x in opened:
                    x.close()

    return listed.mapInPandas(load, f"{key} {key_type}, start long, n_tokens long, ids_crc32 long")


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return read(write(docs, new_folder(spark, "sequences"), public_tokenizers.path("byte_bpe_50k.json")))
