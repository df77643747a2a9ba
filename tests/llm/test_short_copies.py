"""Order min hashes of short texts: their recall, and pairs beside the bounds of what is short."""

import random

import numpy as np
import pyarrow as pa
import pytest

from framelake.llm import neardup
from framelake.llm.common import word_hashes

WORDS = [f"w{i}" for i in range(3000)]


def edited(r, n, spread):
    """A text of n words, and it with as many words changed as similarity 0.8 allows."""
    a = [r.choice(WORDS) for _ in range(n)]
    edits = int(0.2 * n + 1e-9)
    b = list(a)
    for i in [int((i + 0.5) * n / edits) for i in range(edits)] if spread else r.sample(range(n), edits):
        b[i] = f"x{r.randrange(10**6)}"
    return a, b


@pytest.mark.parametrize("n", [5, 6, 8, 10, 12, 15, 20, 25, 30, 39, 40, 50, 60])
@pytest.mark.parametrize("spread", [True, False])
def test_short_near_copies_share_a_hash(n, spread):
    r, met = random.Random(n), 0
    for _ in range(200):
        a, b = edited(r, n, spread)
        assert neardup.similar(a, b)
        met += bool(np.intersect1d(*(neardup.sketches_of(word_hashes(" ".join(x))) for x in (a, b))).size)
    assert met >= 190


def test_every_similar_pair_of_lengths_has_hashes_of_one_kind():
    for longer in range(1, 200):
        for shorter in range(int(np.ceil(0.8 * longer)), longer + 1):
            assert (longer <= neardup.SHORT and shorter <= neardup.SHORT) or (longer >= neardup.LONG and shorter >= neardup.LONG)


def test_hashes_line_up_by_function():
    texts = [" ".join(WORDS[:n]) for n in (1, 3, 39, 40, 60, 61, 200)]
    marks = [neardup.sketches_of(word_hashes(t)) for t in texts]
    n = np.array([1, 3, 39, 40, 60, 61, 200])
    out = neardup._aligned(pa.array([m.tolist() for m in marks]), n, neardup.SKETCHES)
    assert [set(m.tolist()) <= set(row.tolist()) for m, row in zip(marks, out, strict=True)] == [True] * 7
    assert len(np.unique(out[:3, : neardup.SKETCHES])) == 3 * neardup.SKETCHES and len(np.unique(out[5:, neardup.SKETCHES :])) == 2 * neardup.SHORT_SKETCHES


def test_classes_of_short_texts(spark):
    r = random.Random(8)
    pairs = [edited(r, n, True) for n in (5, 8, 15, 15, 30, 50) for _ in range(8)]
    texts = [t for p in pairs for t in p] + [["one", "two", "three", "four"], ["one", "two", "three", "four", "five"]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = {x.doc_id: x.class_id for x in neardup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    linked = sum(got[2 * i] == got[2 * i + 1] == 2 * i for i in range(len(pairs)))
    assert linked >= len(pairs) - 1 and got[len(texts) - 1] == len(texts) - 2
