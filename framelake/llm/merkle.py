"""A Merkle manifest of a dataset: a tree a group of rows, a tree over the groups' roots, and proofs by multiproofs.

Digests alone are shuffled. A row's place in its group comes from range partitions and their counts, so no group has to meet in one task, and each
level is a grouping of at most ARITY digests. Proofs are made in blocks of consecutive leaves, as in an Octopus multiproof: a
block computes the fewest nodes that it lacks, fetches them with one join, derives all inner nodes that its leaves share, and expands a proof a leaf."""

from __future__ import annotations

import hashlib
import string
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.llm.common import unused, written

#: Children of an inner node, and consecutive leaves whose proofs are made together.
ARITY = 16
BLOCK = 4096
#: The tree over the groups' roots. Groups' names are "-" for null, else "s" and the group, which order as they have to: null first, then bytewise.
TOP = "^"


def field(value: Column) -> Column:
    """What a digest reads of a value: "-" for null, else its UTF-8 byte count, a colon and the value in text form."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest_of(*values: Column) -> Column:
    """Lower-case hex SHA-256 over the fields of values in turn."""
    return F.sha2(F.concat(*map(field, values)), 256)


def _hash(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def depth(n: int) -> int:
    """Levels above the n leaves of a tree; 0 for a lone leaf."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def missing(known: np.ndarray, n: int) -> list[tuple[int, int]]:
    """The fewest (level, index) of a tree of n leaves that, with the leaves known, give its root: siblings of what is known or derived that are neither."""
    out, level = [], 0
    known = np.unique(known)
    while n > 1:
        runs = np.unique(known // ARITY)
        children = (runs[:, None] * ARITY + np.arange(ARITY)).ravel()
        out += [(level, int(i)) for i in np.setdiff1d(children[children < n], known, assume_unique=True)]
        known, n, level = runs, -(-n // ARITY), level + 1
    return out


def ranked(df: DataFrame, tree: str, order: list[str], name: str) -> DataFrame:
    """df as a table with idx, a row's place from 0 in its tree by ascending order (nulls first), and n, the tree's rows.

    Rows are dealt by ranges of (tree, order, row), so equal rows and large trees are dealt too; then only counts by tree and range are summed."""
    spark = df.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    row = unused("row", df.columns)
    keys = [F.col(c).asc_nulls_first() for c in (tree, *order, row)]
    dealt = df.withColumn(row, F.monotonically_increasing_id()).repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop(row)
    each = written(dealt.withColumn("seq", F.monotonically_increasing_id()).withColumn("part", F.shiftright("seq", 33)), name)
    counts = each.groupBy(tree, "part").agg(F.min("seq").alias("first"), F.count("*").alias("rows"))
    counts.createOrReplaceTempView(view := f"v_{name.replace('-', '_')}")
    starts = spark.sql(f"""SELECT {tree}, part, sum(rows) OVER (PARTITION BY {tree} ORDER BY part) - rows - first AS shift, sum(rows) OVER (PARTITION BY {tree}) AS n FROM {view}""")
    out = each.join(starts, [tree, "part"]).withColumn("idx", F.col("seq") + F.col("shift")).drop("seq", "part", "shift")
    spark.catalog.dropTempView(view)
    return written(out, f"{name}-ranked")


def levels(leaves: DataFrame, name: str) -> Iterator[DataFrame]:
    """The levels (tree, level, idx, digest, n) of all trees at once, from leaves (tree, idx, digest, n) upwards, each a table; n is the nodes of the tree at that level."""
    at = leaves.select("tree", F.lit(0).alias("level"), "idx", "digest", "n")
    yield at
    for level in range(1, depth(leaves.agg(F.max("n")).first()[0] or 0) + 1):
        run = at.where("n > 1").groupBy("tree", F.expr(f"idx div {ARITY}").alias("up")).agg(F.array_sort(F.collect_list(F.struct("idx", "digest"))).alias("run"), F.max("n").alias("n"))
        up = run.select("tree", F.lit(level).alias("level"), F.col("up").alias("idx"), F.sha2(F.array_join(F.col("run.digest"), ""), 256).alias("digest"), F.ceil(F.col("n") / ARITY).alias("n"))
        at = written(up, f"{name}-{level}")
        yield at


def _all(tables: Iterator[DataFrame]) -> DataFrame:
    out = None
    for t in tables:
        out = t if out is None else out.unionByName(t)
    return out


def build(leaves: DataFrame, group: str, key: str) -> tuple[DataFrame, DataFrame]:
    """(leaves, nodes) of leaves with a group, a key and a digest.

    leaves gets tree, idx, n, top_idx and top_n: its place in its group's tree, by ascending key, equal keys by their digest, and the group's
    place in the tree of groups. nodes: (tree, level, idx, digest, n) of all trees, the root being that of tree TOP with n = 1. Null keys come first; repeated
    rows are leaves each. An empty table has no nodes."""
    tree = F.when(F.col(group).isNull(), F.lit("-")).otherwise(F.concat(F.lit("s"), F.col(group).cast("string")))
    placed = ranked(leaves.withColumn("tree", tree), "tree", [key, "digest"], "merkle-leaves")
    nodes = _all(levels(placed, "merkle-level"))
    roots = nodes.where("n = 1").select(F.lit(TOP).alias("tree"), F.col("tree").alias("of"), "digest")
    tops = ranked(roots, "tree", ["of"], "merkle-roots")
    nodes = nodes.unionByName(_all(levels(tops, "merkle-top")))
    return placed, nodes, tops.select(F.col("of").alias("tree"), F.col("idx").alias("top_idx"), F.col("n").alias("top_n"))


def _requests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The coordinates that each block lacks, and the root."""
    for b in batches:
        for r in b.itertuples(index=False):
            own = [(r.tree, level, i) for level, i in missing(np.arange(r.low, r.high + 1), r.n)]
            own += [(TOP, level, i) for level, i in missing(np.array([r.top_idx]), r.top_n)] + [(TOP, depth(r.top_n), 0)]
            out = pd.DataFrame(own, columns=["of", "level", "idx"])
            yield out.assign(tree=r.tree, block=r.block, n=r.n, top_idx=r.top_idx, top_n=r.top_n)


def _expanded(leaves: pd.DataFrame, fetched: pd.DataFrame, key: str) -> pd.DataFrame:
    """A block's proofs: inner nodes once, then each leaf's siblings, and the root folded from its changed digest."""
    meta = fetched.iloc[0]
    given: dict[tuple[str, int], dict[int, str]] = {}
    for of, level, idx, digest in fetched[["of", "level", "idx", "digest"]].itertuples(index=False):
        given.setdefault((of, level), {})[idx] = digest
    tree = str(leaves["tree"].iloc[0])
    own = dict(zip(leaves["idx"].tolist(), leaves["digest"], strict=True))
    runs: list[dict[int, list[str]]] = []
    for name, n in ((tree, int(meta["n"])), (TOP, int(meta["top_n"]))):
        if name == TOP:
            subroot = own[0]
            own = {int(meta["top_idx"]): subroot}
            turn = len(runs)
        level = 0
        while n > 1:
            have = given.get((name, level), {}) | own
            at = {r: [have[i] for i in range(r * ARITY, min(n, (r + 1) * ARITY))] for r in sorted({i // ARITY for i in own})}
            own = {r: _hash(x) for r, x in at.items()}
            runs.append(at)
            n, level = -(-n // ARITY), level + 1
    derived = next(iter(own.values()))
    root = given[TOP, depth(int(meta["top_n"]))][0]
    tails: dict[tuple[int, int], str] = {}

    def steps(i: int) -> Iterator[tuple[int, int, int]]:
        """(level, run, place in it) from leaf i to the root."""
        for level in range(len(runs)):
            i = int(meta["top_idx"]) if level == turn else i
            yield level, i // ARITY, i % ARITY
            i //= ARITY

    def tail(level: int, i: int) -> str:
        """The siblings from a level on, joined, of node i there."""
        if level == len(runs):
            return ""
        i = int(meta["top_idx"]) if level == turn else i
        if (level, i) not in tails:
            run = runs[level][i // ARITY]
            tails[level, i] = "".join(run[: i % ARITY] + run[i % ARITY + 1 :]) + tail(level + 1, i // ARITY)
        return tails[level, i]

    def folded(i: int, digest: str) -> str:
        for level, r, k in steps(i):
            run = runs[level][r]
            digest = _hash(run[:k] + [digest] + run[k + 1 :])
        return digest

    proofs, ends = [], []
    for i, digest, changed in leaves[["idx", "digest", "changed"]].itertuples(index=False):
        proofs.append(_hash([tail(0, i)]))
        tails.pop((0, i), None)
        ends.append(derived if changed is None or changed == digest else folded(i, changed))
    out = pd.DataFrame({key: leaves[key], "leaf": leaves["digest"], "subroot": subroot, "root": root, "proof_sha256": proofs, "folded_root": ends})
    return out.assign(verified=out["folded_root"] == out["root"])


def prove(leaves: DataFrame, nodes: DataFrame, tops: DataFrame, key: str) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) of each leaf of build(), which may have a digest "changed".

    proof_sha256 is taken over the siblings from the leaf to the root, in order; folded_root is what they give with changed, or where that is null, with the leaf."""
    blocked = leaves.withColumn("block", F.expr(f"idx div {BLOCK}"))
    blocks = blocked.groupBy("tree", "block").agg(F.min("idx").alias("low"), F.max("idx").alias("high"), F.max("n").alias("n")).join(tops, "tree")
    wanted = blocks.mapInPandas(_requests, "of string, level int, idx long, tree string, block long, n long, top_idx long, top_n long")
    fetched = wanted.join(nodes.select(F.col("tree").alias("of"), "level", "idx", "digest"), ["of", "level", "idx"])
    kind = leaves.schema[key].dataType.simpleString()
    out = f"`{key}` {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    expand: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame] = lambda a, b: _expanded(a, b, key)
    sent = blocked.select("tree", "block", "idx", "digest", "changed", key)
    return sent.groupBy("tree", "block").cogroup(fetched.groupBy("tree", "block")).applyInPandas(expand, out)


def manifest(docs: DataFrame, fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), group: str = "source", key: str = "doc_id", changed: Column | None = None) -> DataFrame:
    """prove() over the rows of docs: a leaf is the digest of fields. changed, if given, is the digest of a row as it is found now, null where it is the one of fields.

    Null fields and keys count as said at field() and build(); empty and long texts are rows as any; columns that aren't named don't count, whatever their names."""
    digests = docs.select(F.col(group).cast("string").alias("grp"), F.col(key).alias("key"), digest_of(*map(F.col, fields)).alias("digest"), (F.lit(None).cast("string") if changed is None else changed).alias("changed"))
    placed, nodes, tops = build(digests, "grp", "key")
    return prove(placed, nodes, tops, "key").withColumnRenamed("key", key)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    changed = F.when(hit, digest_of(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), lowered))
    return manifest(docs, changed=changed)


_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE octet_length(encode({0}::VARCHAR)) || ':' || {0} END"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars")) + " || " + _FIELD + ")"
_BYTES = "list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)"
_BITS = "list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
_CRC = f"xor(list_reduce(list_concat([4294967295::BIGINT], {_BYTES}), lambda a, b: {_BITS}), 4294967295)"
SQL = f"""
WITH RECURSIVE base AS (SELECT row_number() OVER () AS rid, doc_id, coalesce('s' || source, '-') AS tree, {_LEAF.format("text")} AS leaf,
    CASE WHEN {_CRC} % 5 = 0 THEN {_LEAF.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS changed FROM documents),
lf AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM base),
lv AS (SELECT tree, 0 AS level, idx, leaf AS d, count(*) OVER (PARTITION BY tree) AS n FROM lf
       UNION ALL SELECT tree, max(level) + 1, idx // 16, sha256(string_agg(d, '' ORDER BY idx)), (max(n) + 15) // 16 FROM lv WHERE n > 1 GROUP BY tree, idx // 16),
sub AS MATERIALIZED (SELECT tree, d, row_number() OVER (ORDER BY tree) - 1 AS idx FROM lv WHERE n = 1),
tp AS (SELECT 0 AS level, idx, d, count(*) OVER () AS n FROM sub
       UNION ALL SELECT max(level) + 1, idx // 16, sha256(string_agg(d, '' ORDER BY idx)), (max(n) + 15) // 16 FROM tp WHERE n > 1 GROUP BY idx // 16),
nodes AS MATERIALIZED (SELECT l.tree, l.level, l.idx, l.d, l.n FROM lv l UNION ALL SELECT s.tree, 1000 + tp.level, tp.idx, tp.d, tp.n FROM tp, sub s),
path AS (SELECT rid, tree, idx, 0 AS level, coalesce(changed, leaf) AS d FROM lf
         UNION ALL
         SELECT p.rid, p.tree, CASE WHEN max(s.n) = 1 THEN max(b.idx) ELSE p.idx // 16 END, CASE WHEN max(s.n) = 1 THEN 1000 ELSE p.level + 1 END,
           CASE WHEN max(s.n) = 1 THEN p.d ELSE sha256(string_agg(CASE WHEN s.idx = p.idx THEN p.d ELSE s.d END, '' ORDER BY s.idx)) END
         FROM path p JOIN nodes s ON s.tree = p.tree AND s.level = p.level AND s.idx // 16 = p.idx // 16 JOIN sub b ON b.tree = p.tree
         WHERE NOT (s.n = 1 AND p.level >= 1000) GROUP BY p.rid, p.tree, p.idx, p.level, p.d),
sib AS (SELECT p.rid, sha256(coalesce(string_agg(s.d, '' ORDER BY s.level, s.idx) FILTER (WHERE s.idx <> p.idx), '')) AS proof
        FROM path p JOIN nodes s ON s.tree = p.tree AND s.level = p.level AND s.idx // 16 = p.idx // 16 GROUP BY p.rid),
fin AS (SELECT rid, arg_max(d, level) AS folded FROM path GROUP BY rid)
SELECT lf.doc_id, lf.leaf, sub.d AS subroot, t.d AS root, sib.proof AS proof_sha256, fin.folded AS folded_root, fin.folded = t.d AS verified
FROM lf JOIN sub USING (tree) JOIN sib USING (rid) JOIN fin USING (rid), (SELECT d FROM tp WHERE n = 1) t
"""
