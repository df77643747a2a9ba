"""Nulls, clashing names, repeated rows and small tables, operator by operator."""

import random

import corpus_pipeline
import pytest
from conftest import SF
from pyspark.sql import functions as F

from framelake.llm import bpe, common, decontam, langid, neardup, quality, substring, warc

DOC = "doc_id long, text string, lang string, source string, n_chars long"
VOCABULARY = [f"{a}{b}" for a in "kltmr" for b in ("an", "o", "ise", "u", "ent", "ax")]


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) for _ in range(n))


def test_quality_leaves_columns_of_its_own_names(spark):
    df = spark.createDataFrame([(1, "One. Two.", "w", 2, True)], "doc_id long, text string, _words string, _lines int, _good boolean")
    got = quality.clean_lines(df).first()
    assert (got["_words"], got["_lines"], got["_good"], got.n_words) == ("w", 2, True, 2)


def archived(spark, rows):
    manifest = warc.write(spark.createDataFrame(rows, "page_id long, url string, html string"), common.new_folder(spark, "warc"))
    return manifest, sorted(((r.page_id, r.record_type, r.refers_to) for r in warc.read(manifest).collect()), key=str)


def test_pages_without_an_id_revisit_the_largest(spark):
    a, b = "<p>" + "a" * 2000, "<p>" + "b" * 2000
    _, got = archived(spark, [(None, "u", a), (5, "u", a), (7, None, a), (7, "u", a), (None, "v", b), (None, "w", b), (3, "x", "short"), (4, "y", "short"), (9, "z", None), (10, "long", "c" * 200_000)])
    assert got == sorted([(None, "revisit", 7), (5, "revisit", 7), (7, "response", None), (7, "response", None), (None, "response", None), (None, "response", None), (3, "response", None), (4, "response", None), (9, "response", None), (10, "response", None)], key=str)


@pytest.mark.parametrize("rows", [[(i, f"u{i}", f"<html>{'same head ' * 200}{i}</html>") for i in range(5)], [(1, "u", None)], [(i, "u", "x" * 100_000 + str(i)) for i in range(12)]])
def test_small_tables_have_a_dictionary_too(spark, rows):
    manifest, got = archived(spark, rows)
    fs, path = common.local_path(manifest.first().path)
    with fs.open_input_stream(path, compression=None) as f:
        size = int.from_bytes(f.read(8)[4:], "little")
    assert size > 0 and len(got) == len(rows)


def places(words, item, k):
    """Whether the item is left anywhere in words with at most k edits: plain dynamic programming."""
    row = [0] * (len(words) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, v in enumerate(words, 1):
            new.append(min(row[j - 1] + (w != v), row[j] + 1, new[-1] + 1))
        row = new
    return min(row) <= k


@pytest.mark.parametrize("block_chars", [200, 10**6])
def test_every_place_of_an_item_is_told(spark, block_chars):
    r = random.Random(5)
    items = {i: [r.choice(VOCABULARY) + str(r.randrange(40)) for _ in range(n)] for i, n in enumerate((3, 6, 12, 25, 40))}
    rows, planted = [], 0
    for d in range(30):
        words = []
        for _ in range(r.randrange(1, 6)):
            words += prose(r.random(), r.randrange(5, 40)).split()
            i = r.randrange(5)
            own = list(items[i])
            for at in r.sample(range(len(own)), r.randrange(decontam.error_budget(len(own)) + 1)):
                own[at] = "edited"
            words += own
            planted += 1
        rows.append((d, " ".join(words)))
    rows += [(None, rows[0][1]), (0, rows[0][1]), (50, None), (51, ""), (52, prose(1, 50_000))]
    docs = spark.createDataFrame([(k, t, 1) for k, t in rows], "item_id long, text string, edits int")
    table = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()] + [(None, " "), (8, None)], "item_id long, text string")
    found = decontam.leaks(docs, table, key="item_id", block_chars=block_chars)
    assert found.columns == ["item_id", "item_id_", "edits", "begin_word", "end_word"]
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    got = found.collect()
    assert len(got) >= planted
    texts = {k: t for k, t in rows}
    for k, t in rows:
        words = decontam.normal_words(t)
        mine = [g for g in got if g[0] == k]
        for i, item in items.items():
            spans = sorted({(g.begin_word, g.end_word) for g in mine if g["item_id_"] == i})
            # What lies between the places told holds no other one.
            ends = [0, *(e for _, e in spans)]
            begins = [*(b for b, _ in spans), len(words)]
            assert len(words) > 10_000 or not any(places(words[a:b], item, decontam.error_budget(len(item))) for a, b in zip(ends, begins, strict=True)), (k, i)
    kept = decontam.clean(docs, table, block_chars=block_chars).select("item_id").collect()
    assert sorted(x.item_id for x in kept) == sorted({k for k in texts if k is not None} - {g[0] for g in got})


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, None), (2, ""), (3, " \n "), (None, prose(3, 40)), (4, prose(4, 3)), (4, prose(4, 3)), (5, prose(5, 20_000)), (6, prose(6, 90)), (7, prose(6, 90)), (None, None)]
    return spark.createDataFrame([(k, t, None, "s", 1) for k, t in rows], DOC)


@pytest.mark.parametrize("name", ["row", "text_hash", "words", "bag", "sketch", "id", "class_id", "value", "center", "component"])
def test_near_copies_with_clashing_columns(odd, name):
    more = odd.withColumn(name, F.lit("clash"))
    kept = neardup.one_of_each(more)
    assert kept.columns == more.columns and kept.where(f"`{name}` = 'clash'").count() == 8 and kept.where("doc_id = 7").count() == 0


@pytest.mark.parametrize("name", ["row", "sid", "n_words", "plain", "rid", "stid", "anchor", "spans", "pid"])
def test_passages_with_clashing_columns(odd, name):
    more = odd.withColumn(name, F.lit("clash"))
    out = substring.remove(more)
    assert out.columns == more.columns and {r.doc_id: r.text for r in out.where("doc_id > 5").collect()} == {6: "", 7: ""} and out.where(f"`{name}` = 'clash'").count() == 10


def test_languages_and_tokens_of_odd_rows(spark, odd):
    more = odd.withColumns({"score": F.lit("clash"), "languages": F.lit(1)})
    model = langid.fit(spark.read.parquet(f"{SF}/documents.parquet").select("text", "lang"))
    got = langid.predict(more, model)
    assert got.count() == 10 and got.where("lang_pred = 'und'").count() == 4
    assert langid.predict(more.limit(0), model).count() == 0
    p = pytest.importorskip("public_tokenizers")
    assert bpe.round_trip(more, p.path("byte_bpe_multi_50k.tiktoken"), p.PATTERN).count() == 10


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_and_empty_tables(spark, odd, stage):
    run = dict(corpus_pipeline.STAGES)[stage]
    table = odd.unionByName(spark.read.parquet(f"{SF}/documents.parquet").limit(60)) if stage == "language" else odd
    out = run(spark, table, SF)
    n = {"language": None, "near_duplicates": 8, "repeated_passages": 10, "benchmark_leaks": 10, "tokens": 10}[stage]
    assert out.count() == n if n else out.where("text IS NULL OR trim(text) = ''").count() == 0
    assert run(spark, odd.limit(0), SF).count() == 0


def test_passages_of_one_anchor_are_dealt_to_several_automata(spark):
    shared = prose(77, 36).split()
    rows = [(i, " ".join([*shared, *prose(1000 + i % 40, 30).split()])) for i in range(120)] + [(500, prose(9, 80)), (501, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    few = sorted(map(tuple, substring.digests(docs, shard_words=30).collect()), key=str)
    assert few == sorted(map(tuple, substring.digests(docs).collect()), key=str)
    by_id = {r[0]: r for r in few}
    assert by_id[5][2] == 66 and by_id[500][2] == 0
