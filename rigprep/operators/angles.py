"""The widest angle among the rays of a track (M11), without a row for each pair of views."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rigprep.functions.shared import materialize, superseded

#: Tracks of so many views are packed in one row each; longer ones go by cells.
PACKED_VIEWS = 256
#: Cells a side of the first grid, and into how many each is cut on every further one.
FIRST_CELLS, FURTHER = 8, 4
#: Cells a side of the last grid: doubles part no further.
LAST_CELLS = 1 << 49
#: Pairs of cells that are left are opened once they hold so many pairs of directions together.
OPEN_PAIRS = 1_000_000
AXES = ("dx", "dy", "dz")


def farthest(points: np.ndarray) -> np.ndarray:
    """The largest squared distance inside each of m sets of n points (m, n, 3)."""
    most = np.zeros(len(points))
    for k in range(points.shape[1] - 1):
        away = points[:, k + 1 :] - points[:, k : k + 1]
        most = np.maximum(most, (away * away).sum(axis=2).max(axis=1))
    return most


def chords(values: np.ndarray, starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The largest squared distance inside each set: n points from place ``starts`` of the flat ``values`` on; sets of equal size are one array operation."""
    out = np.zeros(len(n))
    for size in np.unique(n):
        at = np.flatnonzero(n == size)
        for some in np.array_split(at, max(1, len(at) * int(size) // 200_000)):
            out[some] = farthest(values[starts[some][:, None] + np.arange(size * 3)].reshape(len(some), size, 3))
    return out


def angle_of(chord2: str) -> Column:
    """The angle, in degrees, of a squared distance of unit directions."""
    return F.degrees(2 * F.asin(F.least(F.sqrt(chord2) / 2, F.lit(1.0))))


def _packed(rays: DataFrame) -> DataFrame:
    """``(track, chord2)`` of short tracks."""
    sets = rays.groupBy("track").agg(F.collect_list(F.array(*AXES)).alias("d"))
    flat = sets.select("track", F.size("d").alias("n"), F.flatten("d").alias("d"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, d = batch.column("n").to_numpy(), batch.column("d")
            out = chords(d.values.to_numpy(), d.offsets.to_numpy()[:-1], n)
            yield pa.RecordBatch.from_arrays([batch.column("track"), pa.array(out)], names=["track", "chord2"])

    return flat.mapInArrow(run, f"track {dict(rays.dtypes)['track']}, chord2 double")


def _celled(points: DataFrame, each: int) -> DataFrame:
    """``points`` with ``cell``: its place in a grid with ``each`` cells a side of the track's box."""
    side = lambda x: F.floor((F.col(x) - F.col(f"lo_{x}")) / F.nullif(F.col(f"hi_{x}") - F.col(f"lo_{x}"), F.lit(0.0)) * each)
    return points.withColumn("cell", F.array(*[F.least(F.coalesce(side(x), F.lit(0)), F.lit(each - 1)).cast("long") for x in AXES]))


def _cells(points: DataFrame, each: int) -> DataFrame:
    """``(track, c)``: occupied cells, each with its box, one direction and how many."""
    box = [f(x).alias(f"{n}_{x}") for x in AXES for n, f in (("min", F.min), ("max", F.max))]
    cells = _celled(points, each).groupBy("track", "cell").agg(*box, F.min(F.struct(*AXES)).alias("one"), F.count(F.lit(1)).alias("n"))
    return cells.select("track", F.struct(*[c for c in cells.columns if c != "track"]).alias("c"))


def _kept(pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of cells that may still hold the farthest directions of their track.

    A pair's boxes bound the squared distance of its directions from above; one direction of each bounds the track's from below.
    """
    most, some = F.lit(0.0), F.lit(0.0)
    for x in AXES:
        reach = F.greatest(F.abs(F.col(f"a.max_{x}") - F.col(f"b.min_{x}")), F.abs(F.col(f"b.max_{x}") - F.col(f"a.min_{x}")))
        gap = F.col(f"a.one.{x}") - F.col(f"b.one.{x}")
        most, some = most + reach * reach, some + gap * gap
    bounded = materialize(pairs.select("track", "a", "b", most.alias("most"), some.alias("some")), "pairs")
    best = bounded.groupBy("track").agg(F.max("some").alias("best"))
    kept = materialize(bounded.join(best, "track").where(F.col("most") >= F.col("best")).select("track", "a", "b"), "kept")
    superseded(bounded)
    return kept


def _by_cells(rays: DataFrame) -> DataFrame:
    """``(track, chord2)`` of long tracks, exact: pairs of cells that cannot hold the farthest directions go.

    A cell's box, direction and count merge, so no task holds a track. Cells are cut finer until the pairs
    that are left hold few pairs of directions, which are then looked at.
    """
    box = rays.groupBy("track").agg(*[f(x).alias(f"{n}_{x}") for x in AXES for n, f in (("lo", F.min), ("hi", F.max))])
    points = materialize(rays.select("track", *AXES).distinct().join(box, "track"), "directions")
    each = FIRST_CELLS
    cells = materialize(_cells(points, each), "cells")
    kept = _kept(cells.toDF("track", "a").join(cells.toDF("track", "b"), "track").where(F.col("a.cell") <= F.col("b.cell")))
    while each < LAST_CELLS and (kept.agg(F.sum(F.col("a.n").cast("double") * F.col("b.n"))).first()[0] or 0) > OPEN_PAIRS:
        each *= FURTHER
        alive = kept.select("track", F.explode(F.array("a.cell", "b.cell")).alias("cell")).distinct()
        fine = _cells(points, each).withColumn("cell", F.transform("c.cell", lambda x: F.floor(x / FURTHER)))
        fine = materialize(fine.join(alive, ["track", "cell"]).select("track", "cell", "c"), "cells")
        old = kept.select("track", F.col("a.cell").alias("cell_a"), F.col("b.cell").alias("cell_b"))
        pairs = old.join(fine.toDF("track", "cell_a", "a"), ["track", "cell_a"]).join(fine.toDF("track", "cell_b", "b"), ["track", "cell_b"])
        new = _kept(pairs.where((F.col("cell_a") != F.col("cell_b")) | (F.col("a.cell") <= F.col("b.cell"))))
        superseded(kept, cells)
        kept, cells = new, fine
    held = _celled(points, each)
    side = lambda s: held.select("track", F.col("cell").alias(f"cell_{s}"), F.array(*AXES).alias(s))
    pairs = kept.select("track", F.col("a.cell").alias("cell_a"), F.col("b.cell").alias("cell_b")).join(side("a"), ["track", "cell_a"]).join(side("b"), ["track", "cell_b"])
    chord2: Column = F.aggregate(F.zip_with("a", "b", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda t, x: t + x)
    return pairs.groupBy("track").agg(F.max(chord2).alias("chord2"))


def widest_angles(rays: DataFrame) -> DataFrame:
    """``(track, angle)``: the widest angle, in degrees, between two rays (track, views, dx, dy, dz; unit length) of each track.

    Exact for tracks of any length; no table has a row for each pair of views.
    """
    found = _packed(rays.where(F.col("views") <= PACKED_VIEWS))
    long = materialize(rays.where(F.col("views") > PACKED_VIEWS).select("track", *AXES), "long")
    if long.limit(1).count():
        found = found.unionByName(_by_cells(long))
    return found.select("track", angle_of("chord2").alias("angle"))
