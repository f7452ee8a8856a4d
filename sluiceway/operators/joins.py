"""Joins by time that keep hot keys over many tasks: as-of and interval joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions.names import column
from sluiceway.sinks.staging import staging_folder

# How many times wider the bins of a level are than those of the level below.
LEVEL_STEP = 8
# The share of intervals that fit into the narrowest bins.
NARROWEST = 0.5


def asof_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, carry: Sequence[str]
) -> DataFrame:
    """Every row of `left` with columns `carry` of the latest row of `right` of the same keys, at or before its time.

    Two levels carry the values: all rows are sorted by ranges of key and time, whatever a key's share of them; the last
    value of each range is carried over the ranges after it, and within a range over its rows. So one key's rows lie in
    as many tasks as they fill ranges, and a window over ranges sees one row per range.

    Of rows of `right` with equal keys and times, the one with the largest carried values is taken. Rows of `left` with
    a NULL key or time, or without an earlier partner, get NULL; repeated rows stay. Rows of `right` with a NULL key or
    time are no partners. Carried columns that `left` has too must be renamed before.
    """
    clash = sorted(set(carry) & set(left.columns))
    if clash:
        raise ValueError(f"both sides have columns {clash}")
    key_of = [f"_key_{i}" for i in range(len(keys))]
    whole = F.struct(*map(column, left.columns))
    carried = F.struct(*map(column, carry))
    kinds = {"_row": T.StructType(left.schema.fields), "_carried": T.StructType([right.schema[c] for c in carry])}
    named = [column(k).alias(n) for k, n in zip(keys, key_of)]
    ours = left.select(*named, column(left_time).alias("_time"), F.lit(1).alias("_side"), whole.alias("_row"), F.lit(None).cast(kinds["_carried"]).alias("_carried"))
    theirs = right.select(*named, column(right_time).alias("_time"), F.lit(0).alias("_side"), F.lit(None).cast(kinds["_row"]).alias("_row"), carried.alias("_carried"))
    known = reduce(and_, [F.col(n).isNotNull() for n in (*key_of, "_time")])

    # Equal rows may fall into different ranges: the number of a row as it was read parts them.
    order = [*map(F.col, key_of), F.col("_time"), F.col("_side"), F.col("_carried")]
    both = ours.where(known).unionByName(theirs.where(known)).withColumn("_nr", F.monotonically_increasing_id())
    ranged = both.repartitionByRange(*order, F.col("_nr")).withColumn("_range", F.spark_partition_id()).drop("_nr")
    spark = left.sparkSession
    path = staging_folder(spark, "asof")
    ranged.write.parquet(path)
    ranged = spark.read.schema(ranged.schema).parquet(path)

    last = F.max(F.when(F.col("_side") == 0, F.struct("_time", "_carried")))
    ranges = ranged.groupBy(*key_of, "_range").agg(last.alias("_last"))
    before = Window.partitionBy(*key_of).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(*[F.col(n).alias(f"{n}_of") for n in key_of], F.col("_range").alias("_range_of"), F.last("_last", ignorenulls=True).over(before).alias("_before"))
    same = reduce(and_, [F.col(n) == F.col(f"{n}_of") for n in (*key_of, "_range")])
    within = Window.partitionBy(*key_of, "_range").orderBy("_time", "_side", "_carried").rowsBetween(Window.unboundedPreceding, 0)
    found = ranged.withColumn("_seen", F.last("_carried", ignorenulls=True).over(within)).where("_side = 1").join(ranges, same)
    value = F.coalesce("_seen", F.col("_before._carried"))
    joined = found.select(F.col("_row.*"), *[value.getField(c).alias(c) for c in carry])
    rest = left.where(~reduce(and_, [column(c).isNotNull() for c in (*keys, left_time)]))
    return joined.unionByName(rest.select(*map(column, left.columns), *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in carry]))


def _number(df: DataFrame, name: str) -> Column:
    """A place on a line: microseconds of times, days of dates, numbers as they are."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column(name).cast("timestamp")).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(column(name)).cast("double")
    if isinstance(kind, T.NumericType):
        return column(name).cast("double")
    raise TypeError(f"{name} is no time and no number")


def interval_join(
    left: DataFrame,
    right: DataFrame,
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    keys: Sequence[str] = (),
    step: int = LEVEL_STEP,
) -> DataFrame:
    """Pairs of rows whose closed intervals overlap and whose keys, if any, are equal: columns of both sides.

    The line is cut into bins at several levels. The narrowest are as wide as half of all intervals are long at most, and
    each further level is `step` times wider, up to the longest interval. An interval belongs to the first level whose
    bins are at least as wide as it is long, so that it touches two bins there, and two at each wider level. Two
    intervals meet at the wider level of both, in the first bin that both touch, and are compared there once. So the
    copies of a row are bounded by the number of levels, a logarithm of the range of lengths, and the join has equal keys.

    Rows with a NULL key or end, and intervals that end before they start, meet nothing. Repeated rows make pairs of
    their own. Key columns come from `left`; other columns that both sides have must be renamed before.
    """
    clash = sorted((set(left.columns) & set(right.columns)) - set(keys))
    if clash:
        raise ValueError(f"both sides have columns {clash}")

    def placed(df: DataFrame, span: tuple[str, str]) -> DataFrame:
        start, end = (_number(df, c) for c in span)
        good = reduce(and_, [column(k).isNotNull() for k in keys], start.isNotNull() & (end >= start))
        return df.where(good).withColumns({"_start": start, "_end": end, "_length": end - start})

    ours, theirs = placed(left, left_span), placed(right, right_span)
    lengths = ours.select("_length").union(theirs.select("_length"))
    narrow, longest = lengths.agg(F.percentile_approx("_length", NARROWEST), F.max("_length")).first()
    if longest is None:
        widths = [1.0]
    else:
        widths = [narrow or (longest / step if longest else 1.0)]
        while widths[-1] < longest:
            widths.append(widths[-1] * step)

    def in_bins(df: DataFrame, side: str) -> DataFrame:
        """A row per level from its own on and per bin touched there."""
        level = reduce(lambda found, nr: F.when(F.col("_length") <= widths[nr], nr).otherwise(found), reversed(range(len(widths) - 1)), F.lit(len(widths) - 1))
        levels = F.array(*[F.struct(F.lit(nr).alias("nr"), F.lit(w).alias("width")) for nr, w in enumerate(widths)])
        df = df.withColumn("_own", level).withColumn("_level", F.explode(levels)).where("_level.nr >= _own")
        first, last = (F.floor(F.col(c) / F.col("_level.width")) for c in ("_start", "_end"))
        df = df.withColumn("_first", first).withColumn("_bin", F.explode(F.sequence(first, last)))
        return df.select(
            *[column(c).alias(f"{side}{c}") if c in keys else column(c) for c in df.columns if not c.startswith("_")],
            *[F.col(c).alias(f"{side}{c}") for c in ("_start", "_end", "_own", "_first", "_bin")],
            F.col("_level.nr").alias(f"{side}_nr"),
        )

    a, b = in_bins(ours, "l"), in_bins(theirs, "r")
    same = [column(f"l{k}") == column(f"r{k}") for k in keys] + [F.col("l_nr") == F.col("r_nr"), F.col("l_bin") == F.col("r_bin")]
    meet = [
        F.col("l_nr") == F.greatest("l_own", "r_own"),
        F.col("l_bin") == F.greatest("l_first", "r_first"),
        F.col("l_start") <= F.col("r_end"),
        F.col("r_start") <= F.col("l_end"),
    ]
    pairs = a.join(b, reduce(and_, same + meet))
    return pairs.select(
        *[column(f"l{c}").alias(c) if c in keys else column(c) for c in left.columns], *[column(c) for c in right.columns if c not in keys]
    )
