import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        p = f"{SF}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    return con


@pytest.fixture(scope="session")
def same(spark, duck):
    """Asserts that a query gives the rows of its SQL."""
    from collections import Counter

    def plain(v):
        if isinstance(v, float):
            return None if v != v else float(f"{v:.9g}")
        return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v

    def check(query, sql):
        df = query(spark, SF)
        r = duck.execute(sql)
        names = [c[0] for c in r.description]
        assert sorted(df.columns) == sorted(names)
        ours = Counter(tuple(plain(row[c]) for c in sorted(names)) for row in df.collect())
        order = sorted(range(len(names)), key=lambda i: names[i])
        theirs = Counter(tuple(plain(row[i]) for i in order) for row in r.fetchall())
        assert ours == theirs
        return sum(ours.values())

    return check
