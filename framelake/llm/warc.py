"""WARC archives compressed by a shared Zstandard dictionary.

The dictionary is trained on a bounded sample of the records to be archived and leads every file in a skippable frame
(magic 0x184D2A5D); each record is a Zstandard frame of its own, so any can be read alone. Of records with equal large
payloads one is stored, the others revisit it."""

from __future__ import annotations

import contextlib
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm.common import local_path, new_folder, written

DICT_FRAME = 0x184D2A5D
#: The sample the dictionary is trained on: so many records, those of least hashed id among payloads up to so many bytes.
SAMPLE_RECORDS = 400
SAMPLE_BYTES = 32_768
DICT_BYTES = 65_536
LEVEL = 3


def _record(page_id, url, payload: bytes | None, size: int, digest: str, refers_to, date: str) -> bytes:
    """One WARC/1.1 record; payload None makes it a revisit, whose block is the HTTP head alone."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = head + (payload or b"")
    target = "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in url) if url else "urn:x-page:none"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if payload is not None else 'revisit'}",
        f"WARC-Record-ID: <urn:x-page:{'none' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {size}",
    ]
    if payload is None:
        lines += [f"WARC-Refers-To: <urn:x-page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def train(pages: DataFrame, date: str) -> bytes:
    """A dictionary from the sample, of records as they are archived (of a payload its first SAMPLE_BYTES characters). With too few records, or too little in common among them, for
    the library to learn from, their own content is the dictionary. Only an empty table has none."""
    few = pages.select(F.xxhash64("page_id", "html").alias("h"), "page_id", "url", F.coalesce(F.substring("html", 1, SAMPLE_BYTES), F.lit("")).alias("html"))
    # The bound first, so that tasks send hashes to the driver and only the chosen records follow.
    bound = few.select("h").orderBy("h").limit(SAMPLE_RECORDS).agg(F.max("h")).first()[0]
    chosen = few.where(F.col("h") <= bound).groupBy("h").agg(F.min(F.struct("page_id", "html", "url")).alias("r")).orderBy("h").select("r.*") if bound is not None else few.limit(0)
    sample = [_record(r.page_id, r.url, r.html.encode(), len(r.html.encode()), hashlib.sha1(r.html.encode()).hexdigest(), None, date) for r in chosen.collect()]
    if len(sample) >= 8:
        with contextlib.suppress(zstandard.ZstdError):
            return zstandard.train_dictionary(DICT_BYTES, sample).as_bytes()
    return b"".join(sample)[-DICT_BYTES:]


def verdicts(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """(page_id, strong, payload_bytes, payload_digest, refers_to), strong being the payload's SHA-256: refers_to is the largest page_id of the equal payloads of at
    least least_bytes, null for that page itself and for smaller payloads. Only digests are shuffled. A null html is an
    empty payload; a page without an id is a revisit of the equal page of largest id, and a response where none has one."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    each = written(pages.select("page_id", F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha1(payload).alias("payload_digest"), F.sha2(payload, 256).alias("strong")), "warc-digests")
    groups = each.where(F.col("payload_bytes") >= least_bytes).groupBy("strong").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1 AND keeper IS NOT NULL").drop("n")
    out = each.join(groups, "strong", "left")
    return out.select("page_id", "strong", "payload_bytes", "payload_digest", F.when(~F.col("keeper").eqNullSafe(F.col("page_id")), F.col("keeper")).alias("refers_to"))


def write(pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", least_bytes: int = 1000, level: int = LEVEL) -> DataFrame:
    """Archives pages (page_id, url, html) as .warc.zst files under folder and returns their manifest (path, records).

    Rows that repeat a page_id are archived each; if the payload is that of the largest id, each of them is a response, as nothing but its
    id tells which one a revisit would refer to. Null urls get a placeholder target."""
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    dictionary = spark.sparkContext.broadcast(train(rows, date))
    judged = verdicts(rows, least_bytes)
    fs, top = local_path(folder)
    fs.create_dir(top, recursive=True)
    # By id and payload, as an id may repeat with other payloads; null is an id like others. Rows without a verdict are responses.
    known = judged.where("refers_to IS NOT NULL").groupBy(F.col("page_id").alias("known_id"), F.col("strong").alias("known_strong")).agg(F.max("refers_to").alias("refers_to"))
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    full = rows.withColumn("strong", F.sha2(payload, 256)).join(known, F.col("page_id").eqNullSafe(F.col("known_id")) & (F.col("strong") == F.col("known_strong")), "left").select("page_id", "url", "html", F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha1(payload).alias("payload_digest"), "refers_to")

    def save(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, folder_in = local_path(folder)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.zst"
        raw = dictionary.value
        pack = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(raw) if raw else None, write_checksum=True)
        out, n = None, 0
        for b in batches:
            for page_id, url, html, size, digest, refers_to in b[["page_id", "url", "html", "payload_bytes", "payload_digest", "refers_to"]].itertuples(index=False):
                if out is None:
                    out = at.open_output_stream(f"{folder_in}/{name}", compression=None)
                    out.write(struct.pack("<II", DICT_FRAME, len(raw)) + raw)
                page_id = None if pd.isna(page_id) else int(page_id)
                revisit = not pd.isna(refers_to)
                out.write(pack.compress(_record(page_id, url, None if revisit else (html or "").encode(), int(size), digest, int(refers_to) if revisit else None, date)))
                n += 1
        if out is not None:
            out.close()
            yield pd.DataFrame({"path": [f"{folder}/{name}"], "records": [n]})

    return written(full.mapInPandas(save, "path string, records long"), "warc-manifest")


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields by lower-cased name, block) of each record of a .warc.zst file, read frame by frame."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICT_FRAME:
        raise ValueError("no dictionary frame")
    raw = stream.read(size)
    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)
    held, more = b"", True
    frame = unpack.decompressobj()
    parts: list[bytes] = []
    while more or held:
        if not held:
            held = stream.read(1 << 20)
            more = bool(held)
            if not held:
                break
        parts.append(frame.decompress(held))
        held = b""
        if frame.eof:
            held = frame.unused_data
            record = b"".join(parts)
            head, _, block = record.partition(b"\r\n\r\n")
            fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in head.decode().split("\r\n")[1:])}
            yield fields, block[: int(fields["content-length"])]
            frame, parts = unpack.decompressobj(), []
    if any(parts):
        raise ValueError("the archive ends within a record")


def read(manifest: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every archived record, read from the files. A response whose payload doesn't have its digest raises."""
    spark = manifest.sparkSession
    paths = manifest.select("path").repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "path")

    def number(uri: str | None) -> int | None:
        last = (uri or "").strip("<>").rpartition(":")[2]
        return int(last) if last not in ("", "none") else None

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path in b["path"]:
                fs, at = local_path(path)
                rows = []
                with fs.open_input_stream(at, compression=None) as f:
                    for h, block in records(f):
                        digest = h["warc-payload-digest"].removeprefix("sha1:")
                        size = int(h["x-payload-length"])
                        if h["warc-type"] == "response":
                            payload = block.partition(b"\r\n\r\n")[2]
                            size = len(payload)
                            if hashlib.sha1(payload).hexdigest() != digest:
                                raise ValueError(f"payload of {h['warc-record-id']} in {path} doesn't have its digest")
                        rows.append((number(h["warc-record-id"]), size, digest, h["warc-type"], number(h.get("warc-refers-to"))))
                out = pd.DataFrame(rows, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
                yield out.astype({"page_id": "Int64", "refers_to": "Int64"})

    return paths.mapInPandas(load, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def query(spark, sf_dir: str) -> DataFrame:
    return read(write(spark.read.parquet(f"{sf_dir}/pages.parquet"), new_folder(spark, "warc")))


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, '')))::BIGINT AS n FROM pages),
q AS (SELECT page_id, n, sha1(h) AS d, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY h) ELSE page_id END AS k FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest, CASE WHEN k IS NULL OR k IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN k IS DISTINCT FROM page_id THEN k END AS refers_to FROM q
"""
