import pytest
from conftest import SF

from framelake.plans.all import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_gives_the_rows_of_its_sql(key, same):
    assert same(QUERIES[key], ORACLE_SQL[key]) > 0


def test_streamed_one_euro_is_that_of_the_batch(spark):
    import pyspark.sql.functions as F

    from framelake.operators.smoothing import one_euro
    from framelake.plans.fixtures import Tables

    batch = one_euro(Tables(spark, SF).v_frames, "x").select("clip_id", "frame_idx", F.round("smooth", 9).alias("s"))
    stream = QUERIES["stream_one_euro"](spark, SF).select("clip_id", "frame_idx", F.round("smooth", 9).alias("s"))
    assert batch.exceptAll(stream).count() == 0 == stream.exceptAll(batch).count()


def test_entry_has_every_query(spark):
    import __spark_entry__ as e

    assert set(QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
