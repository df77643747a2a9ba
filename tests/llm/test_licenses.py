"""Licence scans: every unit and window against brute force, line numbers, whole licences, odd rows."""

import random

import pytest
from conftest import SF
from pyspark.sql import functions as F

from framelake.llm import licenses as L

FILLER = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua".split()


def dice(a, b):
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0


def plain_spans(words, templates, least):
    found = []
    for name, text in templates:
        t = L._WORDS(text.lower())
        s = set(zip(t, t[1:], strict=False))
        if len(t) >= L.WINDOW_WORDS:
            for a in range(len(words) - len(t) + 1):
                w = words[a : a + len(t)]
                d = dice(set(zip(w, w[1:], strict=False)), s)
                if d >= least:
                    found.append((d, len(t), a, name))
    out = []
    for d, n, a, name in sorted(found, key=lambda x: (-x[0], -x[1], x[2])):
        if all(a + n <= x or y <= a for _, _, x, y in out):
            out.append((name, d, a, a + n))
    return sorted(out, key=lambda x: x[2])


def edited(r, words, share):
    return [r.choice(FILLER) if r.random() < share else w for w in words]


def test_windows_are_those_of_brute_force():
    r, scanner, hits = random.Random(7), L.Scanner(L.TEMPLATES, 0.8), 0
    for k in range(60):
        words = [r.choice(FILLER) for _ in range(r.randrange(60))]
        for _ in range(r.randrange(4)):
            t = L._WORDS(r.choice(L.TEMPLATES)[1].lower())
            words += edited(r, t, r.choice([0, 0.02, 0.05, 0.1])) + [r.choice(FILLER) for _ in range(r.randrange(20))]
        got, want = scanner.spans(words), plain_spans(words, L.TEMPLATES, 0.8)
        assert [(n, a, b) for n, _, a, b in got] == [(n, a, b) for n, _, a, b in want], k
        assert [x[1] for x in got] == pytest.approx([x[1] for x in want])
        hits += len(got)
    assert hits > 40 and scanner.spans([]) == [] == scanner.spans(["a"])


def plain_units(text):
    lines = text.split("\n")
    out = [("line", i, x) for i, x in enumerate(lines, 1)]
    blocks, at = [], []
    for i, x in enumerate([*lines, ""]):
        if x.strip(" \t\r"):
            at.append(i)
        elif at:
            blocks.append(at)
            at = []
    out += [("paragraph", b[0] + 1, "\n".join(lines[i] for i in b)) for b in blocks if len(b) > 1]
    return out + ([("document", 1, text)] if len(blocks) > 1 else [])


def test_all_units_against_brute_force(spark):
    r = random.Random(9)
    rows = []
    for i in range(60):
        parts = []
        for _ in range(r.randrange(1, 6)):
            t = edited(r, r.choice(L.TEMPLATES)[1].split(), r.choice([0, 0, 0.05, 0.2])) if r.random() < 0.5 else [r.choice(FILLER) for _ in range(30)]
            cuts = sorted(r.sample(range(len(t)), min(len(t) - 1, r.randrange(3))))
            parts.append("\n".join(" ".join(t[a:b]) for a, b in zip([0, *cuts], [*cuts, len(t)], strict=True)))
        rows.append((i, r.choice(["\n", "\n\n", "\n\n\n", "\n \t\n", "\n\n\n\n"]).join(parts)))
    rows += [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").where("text IS NOT NULL").collect()]
    sets = sorted(((n, L.bigrams(t)) for n, t in L.TEMPLATES), key=lambda x: len(x[1]))
    want = []
    for k, text in rows:
        for unit, line, x in plain_units(text):
            b = L.bigrams(x)
            best = max((dice(b, s) for _, s in sets), default=0) if b else 0
            if best >= 0.8:
                want.append((k, unit, line, next(n for n, s in sets if dice(b, s) == best), round(best, 9)))
    got = L.scan(spark.createDataFrame(rows, "doc_id long, text string")).where("unit != 'span'").select("doc_id", "unit", "line", "license", F.round("dice", 9)).collect()
    assert sorted(map(tuple, got)) == sorted(want) and {u for _, u, *_ in want} == {"line", "paragraph", "document"}


def test_lines_of_paragraphs_and_spans(spark):
    mit = next(t for n, t in L.TEMPLATES if n == "MIT" and len(t) > 500)
    wrapped = mit.replace(", ", ",\n", 6)
    cases = {
        1: "x\n\n\n" + wrapped, 2: "x\n\n" + wrapped, 3: "\n\n\n\n" + wrapped + "\n\n\ny", 4: "Some words before it on line one,\nand here " + mit + " " + " ".join(f"w{i}" for i in range(150)),
        5: "Notes.\nMore of them.\n" + " ".join(f"a{i}" for i in range(150)) + "\n" + wrapped + "\n" + " ".join(f"b{i}" for i in range(150)),
    }
    got = {}
    for r in L.scan(spark.createDataFrame(list(cases.items()), "doc_id long, text string")).where("license = 'MIT'").collect():
        got.setdefault(r.doc_id, set()).add((r.unit, r.line))
    assert ("paragraph", 4) in got[1] and ("paragraph", 3) in got[2] and ("paragraph", 5) in got[3] and got[4] == {("span", 2)} and ("span", 4) in got[5]


@pytest.mark.parametrize("name", ["MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Zlib", "BSL-1.0", "Unlicense", "Apache-2.0"])
def test_whole_licences(spark, name):
    text = max((t for n, t in L.TEMPLATES if n == name), key=len)
    wrapped = "Copyright (c) 2020 Somebody\n\n" + "\n".join(text[i : i + 70] for i in range(0, len(text), 70)).upper()
    assert name in {r.license for r in L.scan(spark.createDataFrame([(1, wrapped)], "doc_id long, text string")).collect()}


def test_odd_rows_and_names(spark):
    long = "word " * 200_000 + "\n" + "Released under the MIT License."
    rows = [(1, None), (2, ""), (3, " \n\t\n"), (None, "Licensed under CC BY 4.0."), (4, "Licensed under CC BY 4.0."), (4, "Licensed under CC BY 4.0."), (5, long)]
    df = spark.createDataFrame([(k, t, "c", 1) for k, t in rows], "line long, text string, license string, dice int")
    got = L.scan(df, key="line")
    assert got.columns == ["line", "unit", "line_", "license", "dice"]
    assert sorted((r[0] or 0, r[2], r.license) for r in got.collect()) == [(0, 1, "CC-BY-4.0"), (4, 1, "CC-BY-4.0"), (4, 1, "CC-BY-4.0"), (5, 2, "MIT")]
    assert L.scan(df.limit(0), key="line").count() == 0
