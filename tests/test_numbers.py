"""Last bits: quantiles and rounding are those of DuckDB."""

import datetime
import random
from fractions import Fraction

import duckdb
import pytest
from pyspark.sql import functions as F

from framelake.functions.numbers import fused, rounded
from framelake.plans.all import ORACLE_SQL, QUERIES


def test_losses_on_a_rounding_border_are_those_of_the_sql(spark, tmp_path):
    rng, inf, nan = random.Random(18), float("inf"), float("nan")
    clips = [[rng.randint(1, 40000) / 100 for _ in range(rng.randint(1, 40))] for _ in range(400)] + [[rng.uniform(0, 300) for _ in range(20)] for _ in range(40)]
    clips += [[1.0], [10.01] * 7, [None, None], [-1.0, 0.0], [nan, 1.0, 2.0], [inf, inf, 1.0], [inf, inf, inf], [1.7e308, 1.6e308, 1e308], [5e-324, 1e-300]]
    start = datetime.datetime(2024, 1, 1)
    rows = [(k * 100 + i, start + datetime.timedelta(seconds=i), None if k == 7 else 3 * k - 30, "view", v, '{"k": 1}') for k, values in enumerate(clips) for i, v in enumerate(values)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")

    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    found = con.execute(ORACLE_SQL["agg_loss_stats"])
    names = [c[0] for c in found.description]
    theirs = sorted(repr(r) for r in found.fetchall())
    ours = sorted(repr(tuple(r[n] for n in names)) for r in QUERIES["agg_loss_stats"](spark, str(tmp_path)).collect())
    assert len(ours) == len(clips) and ours == theirs


@pytest.mark.parametrize("key", ["agg_stage_bench", "join_range_stage_samples"])
def test_stages_that_begin_at_once_and_borders_of_means_are_those_of_the_sql(spark, tmp_path, key):
    rng, start, rows = random.Random(11), datetime.datetime(2024, 1, 1), []

    def add(run, seconds, kind, value=1.0, k=0):
        rows.append((len(rows), start + datetime.timedelta(seconds=seconds), run, kind, value, f'{{"k": {k}}}'))

    for run in range(40):  # several events of a time, among them stages, dealt in any order
        for _ in range(6):
            for _ in range(rng.randint(1, 6)):
                at = rng.randint(0, 20) / 2
                for _ in range(rng.randint(1, 4)):
                    add(run, at, rng.choice(["signup", "view"]), rng.choice([None, rng.randint(0, 9000) / 100]), rng.randint(0, 99))
    for run in range(100, 160):  # a mean over 160 samples lies on the border of four digits
        add(run, 0, "signup", 1.0, 0)
        for i in range(159):
            add(run, 1 + i / 1000, "view", 2.0, rng.randint(0, 99))
        add(run, 2.5 + run % 4, "signup", 3.0, 0)
    rng.shuffle(rows)
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")

    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    found = con.execute(ORACLE_SQL[key])
    names = [c[0] for c in found.description]
    theirs = sorted(repr(r) for r in found.fetchall())
    ours = sorted(repr(tuple(r[n] for n in names)) for r in QUERIES[key](spark, str(tmp_path)).collect())
    assert len(theirs) > 100 and ours == theirs


def test_fused_product(spark):
    rng = random.Random(5)
    rows = [tuple(rng.uniform(-1, 1) * 2.0 ** rng.randint(-30, 30) for _ in range(3)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = df.select("*", fused(F.col("a"), F.col("b"), F.col("c")).alias("f")).collect()
    assert all(r.f == float(Fraction(r.a) * Fraction(r.b) + Fraction(r.c)) for r in got)
    x = spark.createDataFrame([(0.031955,), (-0.031955,), (0.000005,), (1e306,), (float("inf"),), (None,)], "x double")
    assert [r[0] for r in x.select(rounded(F.col("x"), 5)).collect()] == [0.03195, -0.03195, 0.00001, 1e306, float("inf"), None]
