"""The manifest against a plain tree, and multiproofs against the fewest nodes."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from framelake.llm import merkle as M


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def tree(leaves):
    levels = [list(leaves)]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        a = i // 16 * 16
        out += level[a:i] + level[i + 1 : a + 16]
        i //= 16
    return out


def plain(rows, changed):
    """rows (key, group, text) -> the rows of manifest()."""
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r: sha("".join(map(enc, r)))
    groups = sorted({r[1] for r in rows}, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: sorted((r for r in rows if r[1] == g), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for g in groups}
    levels = {g: tree(map(leaf, rs)) for g, rs in trees.items()}
    top = tree([levels[g][-1][0] for g in groups])
    out = []
    for t, g in enumerate(groups):
        for i, r in enumerate(trees[g]):
            proof = siblings(levels[g], i) + siblings(top, t)
            d, j = leaf(changed(r)), i
            for at, lv in ((i, levels[g]), (t, top)):
                j = at
                for level in lv[:-1]:
                    run = level[j // 16 * 16 : j // 16 * 16 + 16]
                    run[j % 16] = d
                    d, j = sha("".join(run)), j // 16
            out.append((r[0], leaf(r), levels[g][-1][0], top[-1][0], sha("".join(proof)), d, d == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [[1], [16], [17], [300, 1, 16, 2, 257, 1], [1] * 40 + [33]])
def test_manifest_is_that_of_plain_trees(spark, monkeypatch, sizes):
    r = random.Random(len(sizes))
    rows = []
    for g, n in enumerate(sizes):
        name = [None, "", "é", "z", "Z"][g] if g < 5 else f"g{g}"
        rows += [(r.choice([None, r.randrange(200)]), name, r.choice(["A text", "a text", "", None, "É" * 9])) for _ in range(n)]
    rows += rows[:3] if len(sizes) > 1 else []
    low = lambda t: None if t is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    changed = lambda x: (x[0], x[1], low(x[2])) if x[0] is not None and zlib.crc32(str(x[0]).encode()) % 5 == 0 else x
    df = spark.createDataFrame([(*x, 1, "c") for x in rows], "doc_id long, source string, text string, idx int, tree string")
    now = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, M.digest_of(F.col("doc_id"), F.col("source"), F.translate("text", "ATÉ", "atÉ")))
    got = M.manifest(df, fields=("doc_id", "source", "text"), changed=now)
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows, changed)


def test_an_empty_table_and_no_change(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a")], "doc_id long, source string")
    assert M.manifest(df.limit(0), fields=("doc_id",)).count() == 0
    assert all(r.verified and r.folded_root == r.root for r in M.manifest(df, fields=("doc_id",)).collect())


def test_small_blocks_give_the_same_proofs(spark, monkeypatch):
    df = spark.range(700).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 600, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 20)).alias("source"))
    whole = sorted(map(tuple, M.manifest(df, fields=("doc_id",)).collect()))
    monkeypatch.setattr(M, "BLOCK", 32)
    assert sorted(map(tuple, M.manifest(df, fields=("doc_id",)).collect())) == whole


def test_multiproofs_are_enough_and_nothing_in_them_can_go():
    r = random.Random(6)
    for n in (1, 5, 16, 17, 40, 300, 4097):
        known = np.array(sorted(r.sample(range(n), min(n, r.randrange(1, 20)))))
        nodes = M.missing(known, n)

        def derives(given):
            have, m, level = set(known.tolist()), n, 0
            while m > 1:
                have |= {i for lv, i in given if lv == level}
                have = {p for p in {i // 16 for i in have} if all(i in have for i in range(16 * p, min(m, 16 * p + 16)))}
                m, level = -(-m // 16), level + 1
            return 0 in have

        assert derives(nodes) and len(set(nodes)) == len(nodes)
        assert not any(derives(nodes[:k] + nodes[k + 1 :]) for k in range(len(nodes)))
    assert list(itertools.chain(M.missing(np.array([0]), 1))) == []
