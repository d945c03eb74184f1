"""Ranks and medians of groups of any size, without a window or a state that grows with a group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rigprep.functions.shared import materialize

#: Doubles are looked at so many bits at a time: a group's histogram has 65536 places at most.
DIGIT_BITS = 16


def with_rank(df: DataFrame, keys: list[str], order: list[str], name: str = "rank") -> DataFrame:
    """``df`` with ``name``, gapless from 1 in each group of ``keys``, by ``order`` (nulls first; columns of ``df``).

    Rows are dealt into sorted ranges, which end anywhere, so many tasks number one group. A row's
    rank is its place in its range plus the rows of its group in earlier ranges: only counts of ranges are
    added up. Rows that tie in all of ``order`` get different ranks, in no promised order.
    """
    placed = materialize(df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order).withColumn("__at", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("__at", 33)
    counts = placed.groupBy(*keys, part.alias("__part")).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(*[F.col(k).alias(f"__{k}") for k in keys], "__part", (before - F.col("__first") + 1).alias("__add"))
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys] + [part == F.col("__part")]
    return placed.join(starts, same).select(*df.columns, (F.col("__at") + F.col("__add")).alias(name))


def _digit(values: pa.Array, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """(digit, what lies above it) of doubles' bits, turned so that they sort as the numbers do."""
    bits = (values.to_numpy(zero_copy_only=False) + 0.0).view(np.int64)  # -0 is 0
    bits = np.where(bits < 0, ~bits, bits ^ np.int64(-(1 << 63))).view(np.uint64)
    above = bits >> np.uint64(shift + DIGIT_BITS) if shift + DIGIT_BITS < 64 else np.zeros(len(bits), dtype=np.uint64)
    return (bits >> np.uint64(shift) & np.uint64((1 << DIGIT_BITS) - 1)).astype(np.int64), above.astype(np.int64)


def _numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The doubles of turned bits (k, above)."""
    for batch in batches:
        bits = batch.column("above").to_numpy(zero_copy_only=False)
        bits = np.where(bits < 0, bits ^ np.int64(-(1 << 63)), ~bits)
        yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(bits.view(np.float64))], names=["k", "v"])


def exact_median(df: DataFrame, key: str, value: str) -> DataFrame:
    """``(key, median)`` of a double column by radix selection; nulls and groups without a number have none.

    Each of four passes counts one digit of 16 bits, in each task first, of the rows that still may be the
    middle; the digit in which the middle rank falls is fixed and the next pass goes on below it. Even
    groups have two middles and the mean of both. NaN counts as the largest number.
    """
    rows = df.where(F.col(value).isNotNull()).select(F.col(key).alias("k"), F.col(value).cast("double").alias("v"))
    kind = dict(rows.dtypes)["k"]
    found: DataFrame | None = None
    for shift in range(64 - DIGIT_BITS, -1, -DIGIT_BITS):

        def histogram(batches: Iterator[pa.RecordBatch], shift: int = shift) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                digit, above = _digit(batch.column("v"), shift)
                sent = batch
                if "above" in batch.schema.names:  # rows whose fixed bits are the wanted ones
                    keep = above == batch.column("above").to_numpy(zero_copy_only=False)
                    sent, digit, above = batch.filter(pa.array(keep)), digit[keep], above[keep]
                yield pa.RecordBatch.from_pydict({"k": sent.column("k"), "above": pa.array(above), "digit": pa.array(digit)})

        asked = rows if found is None else rows.join(found.select("k", "above").distinct(), "k")
        counts = asked.mapInArrow(histogram, f"k {kind}, above long, digit long").groupBy("k", "above", "digit").count()
        upto = F.sum("count").over(Window.partitionBy("k", "above").orderBy("digit"))
        counts = counts.withColumn("upto", upto)
        if found is None:
            n = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
            middles = F.array(F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2))
            found = n.select("k", F.lit(0).cast("long").alias("above"), F.posexplode(middles).alias("which", "left"))
        hit = found.join(counts, ["k", "above"]).where((F.col("left") < F.col("upto")) & (F.col("left") >= F.col("upto") - F.col("count")))
        low = F.shiftleft("above", DIGIT_BITS).bitwiseOR(F.col("digit"))
        found = materialize(hit.select("k", low.alias("above"), "which", (F.col("left") - F.col("upto") + F.col("count")).alias("left")), "digits")
    middles = found.select("k", "above").mapInArrow(_numbers, f"k {kind}, v double")
    return middles.groupBy("k").agg(F.avg("v").alias("median")).select(F.col("k").alias(key), "median")
