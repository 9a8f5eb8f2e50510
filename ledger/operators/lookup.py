"""Shared building blocks: existence flags, newest row per key, distributed dense ranks.

None of them assumes that keys are spread evenly.  Joins are equi joins that Catalyst turns into a
broadcast join only when the measured side is below ``spark.sql.autoBroadcastJoinThreshold``;
otherwise AQE splits shuffle partitions that one key makes too large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def shuffled_apart(df: DataFrame, key: str) -> DataFrame:
    """Make the next join on the integer ``key`` shuffle ``df`` for itself.

    AQE splits a skewed join only if both inputs are shuffles.  A side that comes straight out of an
    aggregate on the same key is not: Spark reuses the aggregate's partitioning, and the hot key on the
    other side stays in one task.  Rewriting the key costs one more shuffle of the aggregated rows.
    """
    return df.withColumn(key, F.col(key).bitwiseXOR(F.lit(0)))


def with_match_flag(
    df: DataFrame, keys: DataFrame, key: str, column: str, flag: str, spread_by: str
) -> DataFrame:
    """Add boolean ``flag``: ``column`` is not null and occurs in ``keys[key]`` (unique there).

    Null values match nothing, yet a left join would send all of them to one partition; they are
    given a stand-in value hashed from ``spread_by`` instead.  A stand-in that happens to equal a
    real key does no harm, since the flag also asks for a non-null column.
    """
    stand_in = -F.pmod(F.xxhash64(spread_by), F.lit(1 << 40)) - 1
    side = shuffled_apart(keys.select(F.col(key).alias("_match")), "_match")
    return (
        df.withColumn("_probe", F.coalesce(F.col(column), stand_in))
        .join(side, F.col("_probe") == F.col("_match"), "left")
        .withColumn(flag, F.col(column).isNotNull() & F.col("_match").isNotNull())
        .drop("_probe", "_match")
    )


def newest_per_key(df: DataFrame, key: str | list[str], *order: Column) -> DataFrame:
    """The first row per key in ``order``.

    The filter on the row number becomes a limit inside each map task before the shuffle, so a key
    with very many rows sends one row per task.
    """
    window = Window.partitionBy(key).orderBy(*order)
    return (
        df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") == 1).drop("_rn")
    )


def with_older_flag(df: DataFrame, key: str, version: list[str], flag: str, row: str | None = None) -> DataFrame:
    """Add boolean ``flag``: another row with the same non-null key has a higher ``version``.

    Per key, the highest version is found by an aggregate that combines inside map tasks; only keys
    with several rows are then joined back, and all rows stay.  Nulls order lowest.  Where no two rows have the same
    version and ``row`` numbers them, the join compares that number, and the version stays out of its shuffle.
    """
    mark = F.col(row) if row else F.struct(*version)
    top = F.max(F.struct(*version, row))[row] if row else F.max(F.struct(*version))
    repeated = (
        df.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_match"))
        .agg(F.count(F.lit(1)).alias("_n"), top.alias("_top"))
        .filter(F.col("_n") > 1)
        .drop("_n")
    )
    repeated = shuffled_apart(repeated, "_match")
    stand_in = -F.pmod(F.xxhash64(mark), F.lit(1 << 40)) - 1
    return (
        df.withColumn("_probe", F.coalesce(F.col(key), stand_in))
        .join(repeated, F.col("_probe") == F.col("_match"), "left")
        .withColumn(
            flag,
            F.col(key).isNotNull() & F.col("_top").isNotNull()
            & ~mark.eqNullSafe(F.col("_top")),
        )
        .drop("_probe", "_match", "_top")
    )


#: Ranges that the distinct values of a rank are dealt into.
RANGES = 128


def with_dense_rank(df: DataFrame, value: str, rank: str, group: str | None = None) -> DataFrame:
    """Add ``rank``: dense rank of ``value``, highest first and null last, overall or within ``group``.

    Only distinct values are ranked.  They are dealt into ranges, numbered inside each range, and shifted
    by the number of distinct values in the higher ranges: a table of one row per range and group.  The ranges are cut at the values with
    the smallest hashes, a sample that tasks keep to its size and that comes out the same however often it is taken, so all parts of the plan agree
    on it without a written copy.  The cuts only steer the split; the ranks are exact wherever they fall.
    """
    by = [group] if group else []
    keys = [*by, value]
    values = df.select(*keys).distinct()
    sample = values.filter(F.col(value).isNotNull()).orderBy(F.xxhash64(value), *keys).limit(RANGES - 1)
    cuts = sample.agg(F.sort_array(F.collect_set(value)).alias("cuts")).scalar()
    band = F.when(F.col(value).isNull(), F.lit(RANGES)).otherwise(F.size(F.filter("_cuts", lambda c: c > F.col(value))))
    values = values.withColumn("_cuts", cuts).withColumn("_band", band).drop("_cuts")
    sizes = values.groupBy(*by, "_band").agg(F.count(F.lit(1)).alias("_size"))
    higher = Window.partitionBy(*by).orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        *[F.col(k).alias(f"_{k}") for k in by], F.col("_band").alias("_b"), F.coalesce(F.sum("_size").over(higher), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy(*by, "_band").orderBy(F.col(value).desc_nulls_last())
    ranked = (
        values.withColumn("_inside", F.row_number().over(inside))
        .join(shifts, on=[F.col("_band") == F.col("_b"), *[F.col(k).eqNullSafe(F.col(f"_{k}")) for k in by]])
        .select(*[F.col(k).alias(f"_of_{k}") for k in keys], (F.col("_inside") + F.col("_shift")).cast("bigint").alias(rank))
    )
    return df.join(ranked, on=[F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]).drop(*[f"_of_{k}" for k in keys])
