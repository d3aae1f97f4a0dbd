"""Global order: running totals, row numbers, splits, ranks, samples.

A global order never goes through one task. Rows are range-partitioned on the ordering columns
and written once with their slice number and their running total inside it, or their sequence; to that comes
the total of all earlier slices, a table of at most one row per slice.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators import keyed
from riskloom.session import slice_count, written

#: Rows of a slice of a large table, and the least that are worth a slice of their own.
SLICE_ROWS, LEAST_ROWS = 1_000_000, 10_000
FEISTEL_ROUNDS = 4


def _local_totals(measures: Sequence[int], exact: Sequence[bool]):
    """Per task: the columns, the slice, and per measure the sum over the task's earlier rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, carry = TaskContext.get().partitionId(), [0 if e else 0.0 for e in exact]
        for batch in batches:
            if not batch.num_rows:
                continue
            before = []
            for k, (m, whole) in enumerate(zip(measures, exact)):
                own = batch.column(m).cast(pa.int64() if whole else pa.float64()).fill_null(0).to_numpy(zero_copy_only=False)
                sums = np.cumsum(own) + carry[k]
                before.append(pa.array(np.concatenate((sums[:1] * 0 + carry[k], sums[:-1]))))
                carry[k] = sums[-1]
            names = [*batch.schema.names, "_slice", *[f"_loc{k}" for k in range(len(measures))]]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(batch.num_rows, place, dtype=np.int32)), *before], names)
    return run


def running_totals(df: DataFrame, order_by: Sequence[str], measures: Sequence[str],
                   slices: int | None = None) -> DataFrame:
    """Add ``<m>_before``: the sum of ``m`` over all rows that come earlier in the order.

    ``order_by`` must identify rows (it does for pre-aggregated tables). Nulls come first; a null measure counts
    as 0. The table is written and its rows counted; they set the number of slices, so that a slice has about
    ``SLICE_ROWS`` rows at any size. One shuffle orders it, and sums inside a slice are carried along as the slice is
    written.
    """
    spark = df.sparkSession
    if slices is None:
        df = written(df)
        rows = df.count()
        slices = max(-(-rows // SLICE_ROWS), min(slice_count(spark), -(-rows // LEAST_ROWS)), 1)
    exact = [isinstance(df.schema[m].dataType, T.IntegralType) for m in measures]
    ordered = df.repartitionByRange(slices, *order_by).sortWithinPartitions(*order_by)
    kinds = [T.StructField("_slice", T.IntegerType())] + [
        T.StructField(f"_loc{k}", T.LongType() if e else T.DoubleType()) for k, e in enumerate(exact)]
    places = [df.columns.index(m) for m in measures]
    fixed = written(ordered.mapInArrow(_local_totals(places, exact), T.StructType([*df.schema.fields, *kinds])))
    # One row per slice, a millionth of the rows.
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = fixed.groupBy("_slice").agg(*[F.sum(m).alias(f"_{k}") for k, m in enumerate(measures)]).select(
        "_slice", *[F.coalesce(F.sum(f"_{k}").over(earlier), F.lit(0)).alias(f"_off{k}") for k in range(len(measures))])
    return fixed.join(F.broadcast(offsets), "_slice").select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[(F.col(f"_off{k}") + F.col(f"_loc{k}")).alias(f"{m}_before") for k, m in enumerate(measures)])


def row_index(df: DataFrame, order_by: Sequence[str], name: str = "row_pos", slices: int | None = None) -> DataFrame:
    """0-based position of each row in the global order of ``order_by`` (which must be unique)."""
    spark = df.sparkSession
    count = slices or slice_count(spark)
    fixed = written(
        df.repartitionByRange(count, *order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_slice", F.spark_partition_id())
        .withColumn("_seq", F.monotonically_increasing_id())
    )
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = fixed.groupBy("_slice").agg(F.count("*").alias("_n"), F.min("_seq").alias("_first")).select(
        "_slice", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift")
    )
    # The sequence is consecutive within a slice, so position = sequence + shift of the slice.
    return fixed.join(F.broadcast(offsets), "_slice").select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("_seq") + F.col("_shift")).alias(name)
    )


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    x = x + np.uint64(key * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permutations(df: DataFrame, position: str, n: int, seeds: Sequence[int], name: str = "permuted") -> DataFrame:
    """One row per row and seed, with ``seed`` and the image of a position 0..n-1 under that seed's permutation.

    Each seed gives a keyed pseudo-random permutation that is worked out from the position alone, so no order is
    needed. A Feistel network moves side * other cells, of which fewer than ``side``, the root of n, are no positions;
    what lands on one of those is moved on until it does not.
    """
    side = math.isqrt(max(n - 1, 0)) + 1
    other = max(1, -(-n // side))
    at = df.columns.index(position)

    def moved(x: np.ndarray, seed: int) -> np.ndarray:
        left, right = x % np.uint64(side), x // np.uint64(side)
        for k in range(seed * FEISTEL_ROUNDS, (seed + 1) * FEISTEL_ROUNDS):
            left = (left + _mixed(right, 2 * k + 1) % np.uint64(side)) % np.uint64(side)
            right = (right + _mixed(left, 2 * k + 2) % np.uint64(other)) % np.uint64(other)
        return right * np.uint64(side) + left

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(at).cast(pa.int64()).to_numpy(zero_copy_only=False).astype(np.uint64)
            for seed in seeds:
                x = moved(own, seed)
                while (outside := x >= n).any():
                    x[outside] = moved(x[outside], seed)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(np.full(len(x), seed, dtype=np.int64)), pa.array(x.astype(np.int64))],
                    [*batch.schema.names, "seed", name])

    kinds = [T.StructField("seed", T.LongType()), T.StructField(name, T.LongType())]
    return df.mapInArrow(run, T.StructType([*df.schema.fields, *kinds]))


def position_marks(df: DataFrame, positions: Sequence[int], time: str = "TransactionDT",
                   row_id: str = "TransactionID") -> dict[int, tuple]:
    """(time, id) of the rows at the given 0-based positions of the (time, id) order.

    Rows are counted per instant and only the instants that hold a position are looked into, so no
    row-level sort of the table takes place. Positions past the last dated row are left out.
    """
    steps = value_positions(df, time)
    n, before = F.col("n"), F.col("n_before")
    hit = None
    for p in sorted(set(positions)):
        test = (before <= p) & (before + n > p)
        hit = test if hit is None else hit | test
    if hit is None:
        return {}
    instants = sorted(steps.where(hit).select(time, "n", "n_before").collect(), key=lambda r: r["n_before"])
    if not instants:
        return {}
    kind = df.schema[time].dataType
    inside = df.where(F.col(time).isin([literal(r[time], kind) for r in instants])).select(time, row_id)
    start, places = 0, {}
    for r in instants:
        for p in positions:
            if r["n_before"] <= p < r["n_before"] + r["n"]:
                places[start + p - r["n_before"]] = p
        start += r["n"]
    found = row_index(inside, [time, row_id]).where(F.col("row_pos").isin(list(places))).collect()
    return {places[r["row_pos"]]: (r[time], r[row_id]) for r in found}


def literal(value, kind: T.DataType) -> Column:
    """A collected value as a column of its own type, whatever the time zone of the driver."""
    if isinstance(kind, T.TimestampNTZType):
        return F.lit(value.isoformat(sep=" ")).cast(kind)
    return F.lit(value).cast(kind)


def before_mark(df: DataFrame, mark: tuple | None, time: str = "TransactionDT", row_id: str = "TransactionID") -> Column:
    """True for rows earlier than the marked row in (time, id) order; undated rows come last."""
    if mark is None:
        return F.lit(True)
    at, first = literal(mark[0], df.schema[time].dataType), F.lit(mark[1])
    return F.coalesce((F.col(time) < at) | ((F.col(time) == at) & (F.col(row_id) < first)), F.lit(False))


def time_split(df: DataFrame, test_size: float = 0.2, time: str = "TransactionDT",
               row_id: str = "TransactionID") -> tuple[DataFrame, DataFrame]:
    """The first int(n * (1 - test_size)) rows in time order, and the rest; both are plain filters."""
    cut = int(df.count() * (1 - test_size))
    early = before_mark(df, position_marks(df, [cut], time, row_id).get(cut), time, row_id)
    return df.where(early), df.where(~early)


def value_positions(df: DataFrame, value: str, slices: int | None = None) -> DataFrame:
    """One row per distinct value: ``n`` rows with it and ``n_before`` rows with a smaller one."""
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"))
    return running_totals(counts, [value], ["n"], slices)


def average_rank(df: DataFrame, value: str, name: str = "rank", scaled: bool = False,
                 row_id: str = "TransactionID") -> DataFrame:
    """1-based rank with ties sharing their mean rank; ``scaled`` divides by the row count."""
    steps = value_positions(df, value)
    rank = F.col("n_before") + (F.col("n") + 1) / 2
    if scaled:
        rank = rank / df.where(F.col(value).isNotNull()).agg(F.count("*")).scalar()
    table = steps.select(F.lit("v").alias("name"), F.col(value).alias("key"), "n", rank.alias("rank"))
    return keyed.attach(df, {"v": F.col(value)}, keyed.key_table(table), {"v": {name: "rank"}}, row_id,
                        df.schema[value].dataType.simpleString())


def empirical_cdf(df: DataFrame, value: str) -> DataFrame:
    """Distinct values with the share of rows at or below each."""
    steps = value_positions(df, value)
    total = df.where(F.col(value).isNotNull()).agg(F.count("*")).scalar()
    return steps.select(value, F.col("n").alias("n_rows"), ((F.col("n_before") + F.col("n")) / total).alias("cdf"))


def top_k(df: DataFrame, by: str, k: int, tie_break: str) -> DataFrame:
    """The k rows with the largest ``by``; ties in the order of ``tie_break``."""
    return df.orderBy(F.col(by).desc_nulls_last(), F.col(tie_break)).limit(k)


def peak(df: DataFrame, name: str, score: str) -> DataFrame:
    """One row: ``name`` where ``score`` is largest and smallest; the smaller name wins a tie."""
    scored = df.where(F.col(score).isNotNull())
    low = F.min(F.struct(F.col(score), F.col(name)))
    high = F.min(F.struct((-F.col(score)).alias("neg"), F.col(name)))
    return scored.agg(high.alias("_h"), low.alias("_l")).select(
        F.col(f"_h.{name}").alias("max_at"), (-F.col("_h.neg")).alias("max_score"),
        F.col(f"_l.{name}").alias("min_at"), F.col(f"_l.{score}").alias("min_score"),
    )


def hash_number(row_id: str, seed: int) -> Column:
    """A fixed 32-bit number per (id, seed), the same on every engine that has md5."""
    digest = F.md5(F.concat_ws(":", F.col(row_id).cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def hash_sample(df: DataFrame, row_id: str, n: int, seed: int = 42) -> DataFrame:
    """A repeatable random sample of n rows: the n smallest hash numbers."""
    return df.withColumn("_h", hash_number(row_id, seed)).orderBy("_h", row_id).limit(n).drop("_h")
