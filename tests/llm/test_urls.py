"""URL verdicts over aliases: the function, its SQL and plain Python on one table of random pages."""

import html as H
import random
import re
from urllib.parse import urldefrag, urljoin

import duckdb
import pytest
from pyspark.sql import functions as F

from framelake.llm import urls as U

HOSTS = ["a.com", "B.net", "c.org", "d.org", "example.com", "en.Example.net", "f.de", "example.net"]


def address(r):
    path = r.choice(["", "/", "/en/", "/de/x", "/fr/a/b", "/p", "/q/r/s"])
    return f"{r.choice(['http', 'HTTPS'])}://{r.choice(HOSTS)}{path}" + r.choice(["", "", "?a=1&b=2", "?x#y", "#z"])


def page(r):
    """(url, html); the markup names other addresses in many ways."""
    url, tags = address(r), []
    if r.random() < 0.25:
        tags.append(f'<base target="_top" href="{r.choice(["/base/dir/", "http://c.org/deep/er/", "../up/", "sub/"])}">')
    for _ in range(r.choice([0, 0, 1, 1, 2])):
        to = r.choice([address(r), "//d.org/p", "/fr/./x/../y", "rel/path", "../up", "?only=query", "../../..", "./", "#frag", "x&y?z=<1>", "&lt;"])
        coded = "".join(r.choice([f"&#{ord(c)};", f"&#x{ord(c):x};", c]) if r.random() < 0.1 and c not in "&<>" else H.escape(c) for c in to)
        if r.random() < 0.5:
            tags.append(r.choice([f'<link rel="canonical" href="{coded}">', f"<LINK href='{coded}' rel=canonical>", f'<link rel="alternate" href="{coded}">']))
        else:
            tags.append(f'<meta http-equiv="refresh" content="0; url={coded}">')
    return url, "<html><head>" + "".join(tags) + "</head></html>"


@pytest.fixture(scope="module")
def rows():
    r = random.Random(11)
    out = [(i, *page(r)) for i in range(250)]
    out += [(400, None, out[3][2]), (401, "no scheme/here", out[5][2]), (402, "http://c.org/q", '<link rel="canonical" href="http://d.org/p?a=1&amp;b=2">'), (403, "http://d.org/p?a=1&b=2", '<link rel="canonical" href="http://bad.net/">'), (404, "http://a.com/x", None), (405, "http://a.com/x", "")]
    return out + [(406, "http://z.org/" + "y" * 5_000, '<link rel="canonical" href="/' + "w" * 5_000 + '">'), (0, *out[0][1:]), (None, *out[1][1:])]


def node(u):
    m = re.match(r"(?s)(.*?)://([^/?#]*)([^#]*)", u or "")
    return f"{m[1].lower()}://{m[2].lower()}{m[3]}" if m else None


def test_judged_as_its_sql_does(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((tuple(r) for r in U.judge(df.select("page_id", "url"), U.alias_edges(df)).select("page_id", "host", "path", "rule", "verdict").collect()), key=str)
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    want = sorted((tuple(r) for r in con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({U.SQL}) q").fetchall()), key=str)
    assert got == want
    assert next(r for r in got if r[0] == 402)[4] == "block"


def test_judged_as_plain_python_does(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    edges = {tuple(r) for r in U.alias_edges(df).collect()}
    want = set()
    for _, url, text in rows:
        if not node(url):
            continue
        base = re.search(r'<base target="_top" href="([^"]*)"', text or "")
        own = urldefrag(urljoin(url, H.unescape(base[1])))[0] if base else url
        links = re.findall(r'<link rel="canonical" href="([^"]*)"', text or "") + re.findall(r"<LINK href='([^']*)' rel=canonical", text or "") + re.findall(r"url=([^\">]*)", text or "")
        for to in links:
            to = re.sub("#.*", "", H.unescape(to))
            if to and " " not in to and (d := node(urljoin(own, to))) and d != node(url):
                want.add((node(url), d))
    # Paths that climb over the root, empty ones and a last ; are written differently by the library.
    plain = lambda es: {(a, re.sub(r"(?<=[a-z])/(?=\?|$)", "", b.replace(";", ""))) for a, b in es if ".." not in b}
    assert len(want) > 80 and len(plain(edges) ^ plain(want)) <= 0.02 * len(want)
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        root[find(a)] = find(b)
    rule = lambda n: next((v for v, h, p in sorted(U.RULES, key=lambda r: -len(r[1] + r[2])) if (m := re.match(r"(?s)[^:]*://([^/?#]*)([^?#]*)", n)) and (m[1] == h or m[1].endswith("." + h)) and m[2].startswith(p)), None)
    blocked = {find(x) for e in edges for x in e if rule(x) == "block"}
    for r in U.judge(df, U.alias_edges(df)).collect():
        n = node(r.url)
        assert r.verdict == ((rule(n) or ("block" if n in root and find(n) in blocked else "allow")) if n else "allow")


def test_references_are_read_once(spark):
    cases = {"a&amp;b": "a&b", "&amp;lt;": "&lt;", "&#38;lt;": "&lt;", "&#x26;#60;": "&#60;", "&lt;&gt;&quot;&apos;": "<>\"'", "&#47;&#x2F;&#233;": "//é", "&#99999;": "&#99999;", "": "", "&nope;": "&nope;"}
    df = spark.createDataFrame(list(cases.items()), "v string, want string")
    assert all(r.got == r.want for r in df.select("want", U.decoded(F.col("v")).alias("got")).collect())


def test_clashing_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "http://x.net/", "a", 1, True, "n")], "page_id long, url string, verdict string, _own int, _alias boolean, _node string")
    none = spark.createDataFrame([], "src string, dst string")
    got = U.judge(df, none).first()
    assert (got.verdict, got["_own"], got["_alias"], got["_node"]) == ("block", 1, True, "n")
    assert U.judge(df.limit(0), none).count() == 0 == U.alias_edges(df.limit(0).withColumn("html", F.lit(""))).count()
