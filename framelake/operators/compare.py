"""Runs against golden runs, and clips against each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake import constants as K
from framelake.operators.audit import tolerance_of


def mask_of(key: str) -> str | None:
    """The mask that a channel is compared under, by the beginning of its name; none for a mask itself and for all other channels."""
    return None if key.endswith("_valid") else next((m for prefix, m in K.GOLDEN_MASKS if key.startswith(prefix)), None)


def difference(df: DataFrame, key: str, a: Column, b: Column) -> Column:
    """The greatest absolute difference of two values of a channel: numbers, arrays or arrays of arrays. One that isn't finite counts as infinite, as do arrays
    of different lengths and a value that only one side has; 0 where both have none, or empty arrays."""
    kind = df.schema[key].dataType.simpleString()
    while kind.startswith("array<array<"):
        a, b, kind = F.flatten(a), F.flatten(b), kind[6:-1]
    far = F.lit(float("inf"))
    if kind.startswith("array<"):
        a, b = a.cast("array<double>"), b.cast("array<double>")
        most = F.when(F.size(a) != F.size(b), far).otherwise(F.coalesce(F.array_max(F.zip_with(a, b, lambda x, y: F.coalesce(F.abs(x - y), F.when(x.isNull() & y.isNull(), 0.0).otherwise(far)))), F.lit(0.0)))
    else:
        most = F.abs(a.cast("double") - b.cast("double"))
    return F.when(a.isNull() & b.isNull(), 0.0).when(a.isNull() | b.isNull() | F.isnan(most), far).otherwise(most)


def compare_runs(new: DataFrame, golden: DataFrame, keys: list[str], wide: bool = False, agreement: float = K.GOLDEN_AGREEMENT) -> DataFrame:
    """(clip_id, key, error, limit, failed): a row for each clip and channel of keys, and one with key "frames".

    For a channel, error is the greatest difference() over the frames that both runs have and in which the golden run's mask holds (mask_of(); 0 if in none), and limit the
    tolerance of the first family that its name contains. For a mask (a name that ends in _valid) error is the share of frames in which the two disagree. For "frames" it is
    the number of frames that only one of the runs has. Whatever is over its limit has failed."""
    fields = list(dict.fromkeys([*keys, *(m for k in keys if (m := mask_of(k)))]))
    sides = [d.select("clip_id", "frame_idx", F.struct(*fields).alias(n)) for d, n in ((new, "_a"), (golden, "_b"))]
    both = sides[0].join(sides[1], ["clip_id", "frame_idx"], "full_outer")
    met = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    aggs = [F.struct(F.lit("frames").alias("key"), F.count_if(~met).cast("double").alias("error"), F.lit(0.0).alias("limit"))]
    for k in keys:
        a, b = F.col(f"_a.{k}"), F.col(f"_b.{k}")
        if k.endswith("_valid"):
            error, limit = F.coalesce(F.avg(F.when(met, F.when(a.eqNullSafe(b), 0.0).otherwise(1.0))), F.lit(0.0)), F.lit(round(1 - agreement, 9))
        else:
            shown = met & F.coalesce(F.col(f"_b.{mask_of(k)}").cast("boolean"), F.lit(False)) if mask_of(k) else met
            error, limit = F.coalesce(F.max(F.when(shown, difference(golden, k, a, b))), F.lit(0.0)), tolerance_of(F.lit(k), wide)
        aggs.append(F.struct(F.lit(k).alias("key"), error.alias("error"), limit.cast("double").alias("limit")))
    out = both.groupBy("clip_id").agg(*(x.alias(f"_{i}") for i, x in enumerate(aggs)))
    each = out.select("clip_id", F.explode(F.array(*(F.col(f"_{i}") for i in range(len(aggs))))).alias("r")).select("clip_id", "r.*")
    return each.withColumn("failed", F.col("error") > F.col("limit") + 1e-12)


def dyads(clips: DataFrame, by=("session", "condition")) -> DataFrame:
    """clips with the class of clips that each was filmed with, those of equal by: first_clip, its least clip_id, which names it; partners, the other clips in it; same_length, those
    of them with as many frames. Two clips of a class are a pair, so no row is made for one, however many clips a class has."""
    classes = clips.groupBy(*by).agg(F.count("*").alias("_n"), F.min("clip_id").alias("first_clip"))
    lengths = clips.groupBy(*by, "num_frames").agg(F.count("*").alias("_m"))
    out = clips.join(lengths, [*by, "num_frames"]).join(classes, list(by))
    return out.withColumns({"partners": F.col("_n") - 1, "same_length": F.col("_m") - 1}).drop("_n", "_m")
