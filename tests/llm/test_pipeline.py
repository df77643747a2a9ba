"""The pipeline's stages, each against a brute-force version of what it decides."""

import hashlib
import re

import corpus_pipeline
import pytest
from conftest import SF

from framelake.llm import decontam, neardup

W = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def tables(spark):
    from framelake.llm.common import written

    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(written(stage(spark, docs[-1], SF), f"test-{name}"))
    return docs


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_keep_the_columns_of_documents(tables):
    assert all(t.columns == tables[0].columns for t in tables[1:-1])


def test_languages(tables):
    a, b = rows(tables[0]), rows(tables[1])
    assert b.keys() <= a.keys() and len(b) > 0.9 * len(a)
    assert sum(b[k].lang == a[k].lang for k in b) > 0.97 * len(b)


def test_one_of_each_class_stays(tables):
    a, b = rows(tables[1]), rows(tables[2])
    words = {k: neardup.normal(r.text).split() for k, r in a.items()}
    root = {k: k for k in a}
    keys = sorted(a)
    for i in keys:
        for j in keys:
            if i < j and root[i] != root[j] and neardup.similar(words[i], words[j]):
                low, high = sorted((root[i], root[j]))
                root = {k: low if v == high else v for k, v in root.items()}
    assert set(b) == set(root.values())


def test_no_window_is_left_that_recurred(tables):
    a, b = rows(tables[2]), rows(tables[3])
    assert a.keys() == b.keys()
    seen: dict[tuple, int] = {}
    for r in a.values():
        w = W.findall(r.text or "")
        for i in range(len(w) - 34):
            seen[tuple(w[i : i + 35])] = seen.get(tuple(w[i : i + 35]), 0) + 1
    for k, r in a.items():
        w = W.findall(r.text or "")
        gone = [False] * len(w)
        for i in range(len(w) - 34):
            if seen[tuple(w[i : i + 35])] > 1:
                gone[i : i + 35] = [True] * 35
        assert W.findall(b[k].text) == [x for x, g in zip(w, gone, strict=True) if not g]
        assert any(gone) or b[k].text == r.text


def test_leaking_documents_go(tables, spark):
    items = [decontam.normal_words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    a, b = rows(tables[3]), rows(tables[4])
    leaking = {k for k, r in a.items() for p in items if p and decontam.best_match(p, decontam.normal_words(r.text), decontam.error_budget(len(p)))}
    assert set(b) == set(a) - leaking


def test_tokens_and_the_whole_run(tables, spark):
    last = rows(tables[5])
    assert {k: r.decoded_sha256 for k, r in last.items()} == {k: hashlib.sha256((r.text or "").encode()).hexdigest() for k, r in rows(tables[4]).items()}
    assert {tuple(r) for r in corpus_pipeline.run(spark, SF).collect()} == {tuple(r) for r in last.values()}


def test_rows_without_an_id_change_no_other_row_and_leak_nothing(spark):
    text = " ".join(f"word{i}" for i in range(60))
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 60").first().text
    texts = [(None, text), (5, text), (3, text.replace("word7 ", "other ")), (None, text.replace("word9 ", "more ")), (8, "On its own."), (None, f"Before it. {item} After it."), (9, f"Before this. {item} After this, too.")]
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in texts], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r.doc_id or 0, r.class_id) for r in neardup.classes(docs.where("text NOT LIKE 'Before%'")).collect()))
    assert got == [(0, 3), (0, 3), (3, 3), (5, 3), (8, 8)]
    kept = corpus_pipeline._one_of_each_class(spark, docs, SF)
    near = neardup.similar(*(neardup.normal(t).split() for k, t in texts if t.startswith("Before")))
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0] * (not near) + [3, 8, 9]
    assert sorted((r.doc_id or 0, r.text) for r in corpus_pipeline._without_leaks(spark, docs, SF).collect()) == sorted((k or 0, t) for k, t in texts[:5])
