"""Completeness and key checks, and the split into accepted and rejected rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions.names import column
from sluiceway.functions.types import WHOLE_TIMES

REASONS = "reject_reasons"

# A key with this many rows is set apart before the shuffle ...
HOT_ROWS = 100_000
# ... for at most this many keys, heaviest first, so that the broadcast stays
# under 1 MB (48 bytes a key).  A key beyond that rank holds less than 1/10000
# of the rows and goes through the ordinary join.
HOT_KEYS = 10_000

# Repeated keys are broadcast whole up to these counted sizes.
BROADCAST_KEYS = 500_000
BROADCAST_BYTES = 32 * 2**20


class RejectLimitExceeded(RuntimeError):
    """More rows were rejected than the job allows."""


@dataclass(frozen=True)
class QualityTotals:
    """Row counts of one quality check."""

    total: int
    rejected: int
    repeated_keys: int = 0
    repeated_bytes: int = 0

    @property
    def few_repeats(self) -> bool:
        """Whether the repeated keys, as counted, are small enough to broadcast."""
        return self.repeated_keys <= BROADCAST_KEYS and self.repeated_bytes <= BROADCAST_BYTES

    @property
    def accepted(self) -> int:
        return self.total - self.rejected

    def require_at_most(self, percent: float) -> None:
        """Fail when the rejected share is above the given percentage."""
        if 100 * self.rejected > percent * self.total:
            raise RejectLimitExceeded(
                f"{self.rejected} of {self.total} rows rejected, limit is {percent} percent"
            )


def _is_blank(df: DataFrame, name: str) -> Column:
    value = column(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return value.isNull() | (F.trim(value) == "")
    return value.isNull()


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(or_, conditions, F.lit(False))


def _key_is_null(keys: Sequence[str]) -> Column:
    return _any([column(k).isNull() for k in keys])


def _key_text(df: DataFrame, keys: Sequence[str]) -> Column:
    """A key as text that equal keys share and no others: whole times, and one zero for floating numbers."""

    def exact(name: str) -> Column:
        if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
            return (column(name) + F.lit(0.0)).alias(name)
        return column(name)

    return F.to_json(F.struct(*map(exact, keys)), WHOLE_TIMES)


def _digest(df: DataFrame, keys: Sequence[str]) -> Column:
    """A key of any width as 32 bytes that no two keys share."""
    return F.unhex(F.sha2(_key_text(df, keys), 256))


def _rows_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key without NULL; partial counts before the shuffle absorb hot keys."""
    return df.where(~_key_is_null(keys)).groupBy(*map(column, keys)).agg(F.count(F.lit(1)).alias("_rows"))


def mark_repeated_keys(
    df: DataFrame,
    keys: Sequence[str],
    name: str = "repeated",
    hot_rows: int = HOT_ROWS,
    hot_keys: int = HOT_KEYS,
    few_repeats: bool = False,
    long_keys: bool = False,
) -> DataFrame:
    """Add a boolean: does another row have the same key?  A NULL key repeats none.

    The repeated keys come from one pre-aggregated count and are joined back, so
    no task ever holds all rows of a key.

    ``few_repeats`` says that the repeated keys were counted and are few: they
    are broadcast, and the rows are not shuffled at all.  Otherwise the rows are
    shuffled by key.  Rows of the hottest keys are then known by a broadcast of
    bounded size; they, and rows with a NULL key, cross the join spread by input
    partition instead of by key.

    ``long_keys`` compares SHA-256 digests, so that text keys as long as whole
    documents are not shuffled themselves.
    """
    if long_keys:
        digested = df.withColumn("_long_key", F.when(~_key_is_null(keys), _digest(df, keys)))
        return mark_repeated_keys(
            digested, ["_long_key"], name, hot_rows, hot_keys, few_repeats
        ).drop("_long_key")
    counts = _rows_per_key(df, keys)
    places = [f"_key_{i}" for i in range(len(keys))]
    repeated = counts.where(F.col("_rows") > 1).select(
        *[column(k).alias(p) for k, p in zip(keys, places)], F.xxhash64(*map(column, keys)).alias("_repeat_place")
    )
    same_key = [column(k) == F.col(p) for k, p in zip(keys, places)]
    if few_repeats:
        return df.join(F.broadcast(repeated), reduce(and_, same_key), "left").select(
            *map(column, df.columns), F.col("_repeat_place").isNotNull().alias(name)
        )
    hot = (
        counts.where(F.col("_rows") >= F.lit(hot_rows))
        .where(F.col("_rows") > 1)
        .orderBy(F.desc("_rows"))
        .limit(hot_keys)
        .select(
            F.xxhash64(*map(column, keys)).alias("_hot_hash"),
            _digest(df, keys).alias("_hot_digest"),
        )
    )
    # Only the hash is a join key; the costlier digest is left to settle the few
    # rows the hash matches, hence a comparison Spark does not turn into a key.
    same_digest = F.array_contains(F.array("_hot_digest"), _digest(df, keys))
    is_hot = (F.xxhash64(*map(column, keys)) == F.col("_hot_hash")) & same_digest
    # A hot key is known to repeat, and a NULL key never does: their rows need no partner, and
    # lie wherever they were read. spark_partition_id gives a re-run task the same place,
    # unlike a random salt. All other rows lie at the hash of their key.
    hashed = F.xxhash64(*map(column, keys))
    place = F.when(
        F.col("_hot_hash").isNotNull() | _key_is_null(keys), F.spark_partition_id().cast("long")
    ).otherwise(hashed)
    rows = df.join(F.broadcast(hot), is_hot, "left").withColumn("_place", place)
    same_place = reduce(and_, same_key, F.col("_place") == F.col("_repeat_place"))
    return rows.join(repeated, same_place, "left").select(
        *map(column, df.columns),
        (F.col("_hot_hash").isNotNull() | F.col("_repeat_place").isNotNull()).alias(name),
    )


def flag_quality(
    df: DataFrame,
    keys: Sequence[str] = (),
    critical: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
    few_repeats: bool = False,
    long_keys: bool = False,
) -> DataFrame:
    """Add the array of reasons why a row is bad; empty means good.

    ``blank:<column>`` for a critical column that is NULL or blank, ``null_key``
    for a key with a NULL, ``repeated_key`` for a key that another row has too.
    """
    marked, reasons = df, [F.when(_is_blank(df, c), F.lit(f"blank:{c}")) for c in critical]
    if keys:
        marked = mark_repeated_keys(df, keys, "_repeated", hot_rows, few_repeats=few_repeats, long_keys=long_keys)
        reasons += [
            F.when(_key_is_null(keys), F.lit("null_key")),
            F.when(F.col("_repeated"), F.lit("repeated_key")),
        ]
    found = F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>")
    return marked.select(*map(column, df.columns), found.alias(REASONS))


def _totals(
    df: DataFrame, keys: Sequence[str], critical: Sequence[str], long_keys: bool = False
) -> DataFrame:
    blank = _any([_is_blank(df, c) for c in critical])
    if not keys:
        nothing = F.lit(0).cast("bigint")
        return df.agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(blank).alias("rejected"),
            nothing.alias("repeated_keys"),
            nothing.alias("repeated_bytes"),
        )
    if long_keys:
        digest = F.when(~_key_is_null(keys), _digest(df, keys)).alias("_long_key")
        df, keys = df.select(digest, blank.alias("_is_blank")), ["_long_key"]
        blank = F.col("_is_blank")
    per_key = df.groupBy(*map(column, keys)).agg(
        F.count(F.lit(1)).alias("_rows"), F.count_if(blank).alias("_blank")
    )
    repeated = ~_key_is_null(keys) & (F.col("_rows") > 1)
    whole = _key_is_null(keys) | (F.col("_rows") > 1)

    def added_up(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    return per_key.agg(
        added_up(F.col("_rows")).alias("total"),
        added_up(F.when(whole, F.col("_rows")).otherwise(F.col("_blank"))).alias("rejected"),
        F.count_if(repeated).alias("repeated_keys"),
        added_up(F.when(repeated, F.octet_length(_key_text(df, keys)))).alias("repeated_bytes"),
    )


def quality_counts(df: DataFrame, keys: Sequence[str] = (), critical: Sequence[str] = ()) -> DataFrame:
    """One row with total, rejected and accepted counts, without joining anything.

    Reads only key and critical columns; per key it carries a row count and a
    count of blank rows, which is all the totals need.
    """
    totals = _totals(df, keys, critical).select("total", "rejected")
    return totals.withColumn("accepted", F.col("total") - F.col("rejected"))


def check_quality(
    df: DataFrame, keys: Sequence[str] = (), critical: Sequence[str] = (), long_keys: bool = False
) -> QualityTotals:
    """The totals as a value; one row reaches the driver."""
    return QualityTotals(**_totals(df, keys, critical, long_keys).first().asDict())


def split_rejects(
    df: DataFrame,
    keys: Sequence[str] = (),
    critical: Sequence[str] = (),
    limit_percent: float | None = None,
    long_keys: bool = False,
) -> tuple[DataFrame, DataFrame, QualityTotals]:
    """Accepted rows, rejected rows with their reasons, and the totals.

    The limit is judged on the totals, before either side is computed.  The
    totals also tell whether the repeated keys can be broadcast.
    """
    totals = check_quality(df, keys, critical, long_keys)
    if limit_percent is not None:
        totals.require_at_most(limit_percent)
    flagged = flag_quality(df, keys, critical, few_repeats=totals.few_repeats, long_keys=long_keys)
    good = F.size(REASONS) == 0
    accepted = df if totals.rejected == 0 else flagged.where(good).drop(REASONS)
    return accepted, flagged.where(~good), totals
