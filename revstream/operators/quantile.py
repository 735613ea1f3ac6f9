"""Exact percentiles per group without holding or ordering a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Approximate quantiles are off by at most one in so many ranks.
ACCURACY = 10_000
# Bounds are copied so often, so that a group with most of the values meets them in as many tasks.
SPREAD = 64


def exact_percentiles(df: DataFrame, group: str, value: str, points: dict[str, float], accuracy: int = ACCURACY) -> DataFrame:
    """Interpolated percentiles (``points``: name to fraction) of ``value`` per ``group``.

    Approximate quantiles a little below and above each point give a band that surely holds its rank. One pass then
    counts the values below the band, in the tasks that read them, and keeps only the distinct values inside: some
    four in ``accuracy``. These alone are ordered. A group of few values is its own band. The pass fails rather
    than miss a rank, which whole numbers beyond 2**53 could cause: bounds are doubles.
    """
    known = df.filter(F.col(value).isNotNull()).select(F.col(group).alias("_group"), F.col(value).alias("_value"))
    margin = 2 / accuracy
    fractions = [min(max(p + side, 0.0), 1.0) for p in points.values() for side in (-margin, margin)]
    found = known.groupBy("_group").agg(
        F.percentile_approx("_value", F.array(*map(F.lit, fractions)), accuracy).alias("_at"),
        F.min("_value").alias("_low"), F.max("_value").alias("_high"), F.count(F.lit(1)).alias("_total"),
    )
    few = F.col("_total") <= 2 * accuracy
    bands = F.array(
        *[
            F.struct(
                F.lit(name).alias("point"),
                F.lit(p).alias("fraction"),
                F.when(few, F.col("_low")).otherwise(F.col("_at")[2 * i]).alias("low"),
                F.when(few, F.col("_high")).otherwise(F.col("_at")[2 * i + 1]).alias("high"),
                F.col("_total").alias("total"),
            )
            for i, (name, p) in enumerate(points.items())
        ]
    )
    copies = found.select("_group", bands.alias("_bands"), F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("_salt"))
    salted = known.withColumn("_salt", F.pmod(F.xxhash64("_value"), F.lit(SPREAD)).cast("int"))
    same = salted["_group"].eqNullSafe(copies["_group"]) & (salted["_salt"] == copies["_salt"])
    met = salted.join(copies, same).select(salted["_group"], "_value", F.explode("_bands").alias("_band")).filter(F.col("_value") <= F.col("_band.high"))
    inside = F.when(F.col("_value") >= F.col("_band.low"), F.col("_value"))  # NULL: below the band
    counts = met.groupBy("_group", "_band.point", "_band.fraction", "_band.total", inside.alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy("_group", "point").orderBy(F.col("_value").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumn("_upto", F.sum("_n").over(upto)).filter(F.col("_value").isNotNull())

    # A value covers the zero-based ranks [_upto - _n, _upto).
    rank = F.col("fraction") * (F.col("total") - 1)
    holds = lambda r: (r >= F.col("_upto") - F.col("_n")) & (r < F.col("_upto"))
    held = ranked.groupBy("_group", "point").agg(
        F.max(F.when(holds(F.floor(rank)), F.col("_value"))).alias("_lo"),
        F.max(F.when(holds(F.ceil(rank)), F.col("_value"))).alias("_hi"),
        F.max(rank - F.floor(rank)).alias("_part"),
    )
    lost = F.col("_lo").isNull() | F.col("_hi").isNull()
    between = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_part")
    answers = held.withColumn("_answer", F.when(lost, F.raise_error(F.lit("a percentile lies outside its band")).cast("double")).otherwise(between))
    return answers.groupBy(F.col("_group").alias(group)).agg(*[F.max(F.when(F.col("point") == name, F.col("_answer"))).alias(name) for name in points])
