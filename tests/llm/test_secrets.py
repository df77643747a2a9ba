"""Secret scans: patterns, features and Viterbi against brute force, and held-out recall of the model."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from conftest import SF

from framelake.llm import secrets as S

ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24])


ODD = [
    None, "", " \n", "token: abc", "tokén token='abcdef' é PASSWORD = \"x.y-z+/_=1\"", "AKIA" + "A" * 16 + " AKIAAAA AKIAAKIA" + "B" * 20, "é" * 50 + "deadbeef" * 3 + "g" + "0" * 23,
    "api_key=secret:abcdefg apikey : 'abcdef' API__KEY=abcdefg", "ſecret=abcdefg toKen=abcdefgh", "token==abcdefgh token=\"abc\ntoken=abcdef", "x" * 200_000 + " passwd=" + "q" * 40, "😀 secret=abcdef 😀 " + "a1" * 20,
]


def test_base_spans_are_those_of_the_patterns_over_characters():
    r = random.Random(4)
    bits = ["token", "Secret", "api_key", "apikey", "=", ":", " ", '"', "'", "abcdef", "AKIA", "ABCDEF0123456789", "0123456789abcdef", "é", "\n", "x", "-", "passwd"]
    for text in [t or "" for t in ODD] + ["".join(r.choice(bits) for _ in range(40)) for _ in range(2000)]:
        raw = text.encode()
        got = [(len(raw[:a].decode()), k, len(raw[:z].decode())) for a, k, z, _ in S.base_spans(raw)]
        assert got == plain(text)


def test_viterbi_is_the_best_of_all_paths_and_cuts_change_nothing():
    r = np.random.default_rng(5)
    for n in range(1, 8):
        crf = S.Crf(np.zeros((1, 3)), r.normal(0, 1.5, (3, 3)))
        scores = r.normal(0, 2, (n, 3))
        value = lambda p: sum(scores[i, y] for i, y in enumerate(p)) + sum(crf.transitions[a, b] for a, b in itertools.pairwise(p))  # noqa: B023, E731
        assert value(crf.viterbi(scores)) == pytest.approx(max(map(value, itertools.product(range(3), repeat=n))))
    for _ in range(200):
        n = int(r.integers(1, 60))
        crf = S.Crf(np.zeros((1, 3)), r.normal(0, 1, (3, 3)))
        scores = r.normal(0, 3, (n, 3)).astype(np.float32) + np.array([4, 0, 0], np.float32)
        row = np.sort(r.integers(0, 4, n))
        whole = np.concatenate([crf.viterbi(scores[row == k].astype(float)) for k in np.unique(row)])
        assert (crf.decode(scores, row) == whole).all()


def test_features_of_a_batch_are_those_of_each_text():
    texts = [t.encode() for t in (t or "" for t in ODD)]
    bounds = np.cumsum([0] + [len(t) for t in texts])
    begin, end, row, codes = S.features(np.frombuffer(b"".join(texts), np.uint8), bounds)
    assert (codes < np.array(list(S.TABLES.values()))).all()
    for i, t in enumerate(texts):
        b, e, _, c = S.features(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
        assert (begin[row == i] - bounds[i] == b).all() and (end[row == i] - bounds[i] == e).all() and (codes[row == i] == c).all()


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").where("text <> ''").distinct().collect()
    return sorted((int.from_bytes(hashlib.sha256(r.text.encode()).digest()[:7], "big"), r.text) for r in rows)


@pytest.fixture(scope="module")
def model(texts):
    return S.learn(list(S.training_windows(iter(texts[:500]))))


def test_gradients_lead_to_a_model_that_finds_held_out_credentials(model, texts):
    found = wanted = wrong = 0
    for cut, begins, ends in S.training_windows(iter(texts[500:])):
        begin, end, row, codes = S.features(np.frombuffer(cut, np.uint8), np.array([0, len(cut)]))
        tags = model.decode(model.scores(codes), row)
        gold = np.zeros(len(begin), bool)
        for a, z in zip(begins, ends, strict=True):
            gold |= (begin < z) & (end > a)
        found, wanted, wrong = found + (gold & (tags > 0)).sum(), wanted + gold.sum(), wrong + (~gold & (tags > 0)).sum()
    assert wanted > 300 and found > 0.95 * wanted and wrong < 0.05 * wanted


def test_scan_on_odd_rows(spark, model):
    rows = [(k, t, "clash", 7) for k, t in enumerate(ODD)] + [(None, "token=abcdefgh", "c", 1), (4, ODD[4], "clash", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, spans int")
    got = S.scan(docs, model).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.base) for r in got) == sorted((k is None, k or 0, S.joined(plain(t or ""))) for k, t, *_ in rows)
    for r in got:
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(r.base.split(",").count(None) or sum(s.startswith(k) for s in r.base.split(",")) for k in ("assign:", "access:", "hex:"))
        spans = [s for s in r.spans.split(",") if s]
        assert [s for s in spans if not s.startswith("crf:")] == [s for s in r.base.split(",") if s]
    more = spark.createDataFrame([(1, "the auth = 'ghp_0aB1cD2eF3gH4iJ5kL6mN7oP8qR9sT0uV1wX2y' was left here"), (2, "nothing of the kind is in this text of plain words, 12 of 30.")], "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in S.scan(more, model).collect()}
    assert spans[1].startswith("crf:") and spans[2] == ""
    assert S.scan(docs.limit(0), model).count() == 0
    assert all(r.spans == "" for r in S.scan(more, S.train(docs.where("doc_id IN (0, 1)"))).collect())


def test_training_and_query(spark):
    got = S.query(spark, SF)
    assert got.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    want = {r.doc_id: hashlib.sha256(S.joined(plain(r.text or "")).encode()).hexdigest() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r.doc_id: r.base_sha256 for r in got.collect()} == want
