"""The divergence audit against plain counting, with whole digests and with ones so narrow that most collide."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF
from pyspark.sql import functions as F

from framelake.llm import divergence as D

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def plain(rows, least, top):
    rows = [(t or "", lang or "", source or "") for t, lang, source in rows]
    docs = [(Counter(TERM.findall(lowered(t))), lang, source) for t, lang, source in rows]
    df = Counter((lang, w) for c, lang, _ in docs for w in c)
    kept = defaultdict(list)
    for (lang, w), n in df.items():
        if n >= least:
            kept[lang].append(w)
    n = defaultdict(Counter)
    for c, lang, source in docs:
        for w in kept[lang]:
            n[lang, source][w] += c[w]
            n[lang, None][w] += c[w]
    totals = {g: sum(c.values()) for g, c in n.items()}
    share = lambda g, w, lang: 1 + 10**9 * (n[g][w] + 5) // (totals.get(g, 0) + 5 * len(kept[lang]))
    out = []
    groups = {(lang, source) for _, lang, source in rows}
    for lang, source in groups:
        pair = [(sum(abs(share((lang, source), w, lang) - share((lang, o), w, lang)) for w in kept[lang]), o) for la, o in groups if la == lang and o != source]
        over = [(share((lang, source), w, lang) - share((lang, None), w, lang), w) for w in kept[lang] if n[lang, source][w] > 0]
        for part, items, most in (("pair", pair, None), ("term", [x for x in over if x[0] > 0], top)):
            items.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, w, f, k) for k, (f, w) in enumerate(items[:most], 1)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.mark.parametrize(("bits", "tile"), [(64, 128), (5, 12)])
def test_audit_is_plain_counting(spark, monkeypatch, bits, tile):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(None, "en", "src1"), ("", None, None), ("Éa é1a A-b a", "xx", None), ("Éa é1a A-b a", "xx", None), (None, "yy", "only"), ("a " * 100_000, "en", "src1"), ("12 !", "en", "numbers alone")]
    more = spark.createDataFrame([(*o, 1) for o in odd], "text string, lang string, source string, df int")
    both = docs.select("text", "lang", "source", F.lit(1).alias("df")).unionByName(more)
    monkeypatch.setattr(D, "TILE", tile)
    monkeypatch.setattr(D, "PAIR_ROWS", 5000)
    monkeypatch.setattr(D, "HELD", 500)
    want = plain([tuple(r)[:3] for r in both.collect()], 3, 7)
    assert len(want) > 500 and rows_of(D.audit(both, least=3, top=7, bits=bits)) == want


def test_an_empty_table_and_no_kept_term(spark):
    none = spark.createDataFrame([], "text string, lang string, source string")
    assert D.audit(none).count() == 0
    few = spark.createDataFrame([("a b", "x", "s"), ("a", "x", "t"), (None, "x", "u")], none.schema)
    assert rows_of(D.audit(few)) == sorted(("x", a, "pair", b, 0, k) for a in "stu" for k, b in enumerate(sorted(set("stu") - {a}), 1))


def test_terms_of_a_batch():
    texts = ["Ab é1x", "", "x", "-", "É", "a" * 70_000, "ab AB"]
    raw, begin, end, row, digest = D.terms(pa.array(texts).slice(1))
    got = [(int(r), raw[a:z].tobytes().decode()) for a, z, r in zip(begin, end, row, strict=True)]
    assert got == [(i, m) for i, t in enumerate(texts[1:]) for m in TERM.findall(lowered(t))]
    assert len(set(digest.tolist())) == len({w for _, w in got}) and digest[-1] == digest[-2]
    assert np.array_equal(D.terms(pa.array(texts))[4][-2:], digest[-2:])


def test_shares_are_exact_beyond_64_bits(spark):
    df = spark.createDataFrame([(10**15 + 1, 3 * 10**17 + 7, 10**6)], "n long, t long, v long").select(D.share(F.col("n"), F.col("t"), F.col("v")).alias("p"))
    assert df.first().p == 1 + 10**9 * (10**15 + 6) // (3 * 10**17 + 7 + 5 * 10**6)


def test_the_filter_passes_all_that_is_in_it(spark):
    df = spark.createDataFrame([(x * 2654435761 * 97 - 2**62,) for x in range(500)], "digest long")
    words = D.bit_filter(df)
    digests = np.array([r.digest for r in df.collect()])
    assert D._in_filter(digests, words).all() and D._in_filter(digests + 12345, words).sum() < 20
