"""Tracks and triangulation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rigprep.functions.graph import connected_components
from rigprep.functions.shared import materialize
from rigprep.operators.angles import PACKED_VIEWS, angle_of, chords, widest_angles

RAY = ("cx", "cy", "cz", "dx", "dy", "dz", "f")
OUT = ("track", "views", "x", "y", "z", "error", "angle")


def build_tracks(matches: DataFrame) -> DataFrame:
    """(scene_id, image, kp_idx, track): connected components of keypoints over matches.

    track is the smallest keypoint name of the component; conflict is true for tracks with two
    keypoints of one image. Keypoints are numbered first: the rounds over edges carry two numbers a row and no names.
    ``copy0`` and ``copy1``, if there, tell images of one name apart, which then have keypoints of their own.
    """
    copy = ["copy"] if "copy0" in matches.columns else []
    end = lambda k: F.struct("scene_id", F.col(f"image{k}").alias("image"), F.col(f"kp{k}").alias("kp_idx"), *[F.col(f"{c}{k}").alias(c) for c in copy])
    m = matches.select(end(0).alias("x"), end(1).alias("y"))
    nodes = materialize(m.select(F.explode(F.array("x", "y")).alias("x")).distinct().select("x", F.monotonically_increasing_id().alias("n")), "nodes")
    edges = m.join(nodes.toDF("x", "src"), "x").join(nodes.toDF("y", "dst"), "y").select("src", "dst")
    found = connected_components(edges).join(nodes, F.col("node") == F.col("n"))
    name = F.concat_ws("|", "x.scene_id", "x.image", F.lpad(F.col("x.kp_idx").cast("string"), 8, "0"))
    rows = materialize(found.select("x.*", "component", name.alias("name")), "tracks")
    tracks = rows.groupBy("component").agg(F.min("name").alias("track"))
    sizes = rows.groupBy("component", "image", *copy).count().groupBy("component").agg((F.max("count") > 1).alias("conflict"))
    return rows.join(tracks.join(sizes, "component"), "component").select("scene_id", "image", "kp_idx", "track", "conflict")


def triangulate_tracks(rays: DataFrame, min_angle: float = 1.0, max_error: float = 4.0) -> DataFrame:
    """(track, views, x, y, z, error, angle) by least squares of rays with known poses.

    rays: track, the camera centre cx..cz, a unit direction dx..dz in the world and focal length f; or a row for each
    track with ``rays``, an array of structs of these, and how many they are as ``views``. A ray with a null is none.
    A point solves sum(I - dd')p = sum(I - dd')c in closed form. Tracks need two views, a widest
    angle of rays of at least min_angle degrees, and a largest error (pixels, f times the tangent of
    the angle between ray and point) of at most max_error. Own definition, not a bundle adjustment.
    A short track's rays meet in one row and go to tasks once; long tracks (over PACKED_VIEWS) go by sums and by cells.
    """
    if "rays" in rays.columns:
        long = None
        if rays.where(F.col("views") > PACKED_VIEWS).select("views").limit(1).count():
            long = rays.where(F.col("views") > PACKED_VIEWS).select("track", F.explode("rays").alias("r")).select("track", "r.*")
        bundles = rays.where(F.col("views") <= PACKED_VIEWS).select("track", "rays")
    else:
        counts = materialize(rays.groupBy("track").agg(F.count(F.lit(1)).alias("views")).where(F.col("views") > PACKED_VIEWS).select("track"), "counts")
        some = counts.limit(1).count()
        long = rays.join(counts, "track", "left_semi") if some else None
        short = rays.join(counts, "track", "left_anti") if some else rays
        bundles = short.groupBy("track").agg(F.collect_list(F.struct(*RAY)).alias("rays"))
    found = _short_tracks(bundles)
    if long is not None:
        found = found.unionByName(_long_tracks(materialize(long.select("track", *RAY), "rays")))
    return found.where((F.col("angle") >= min_angle) & (F.col("error") <= max_error))


def _solve(a: dict, b: list) -> tuple:
    """The determinant and x, y, z times it of the symmetric equations a p = b, on Columns or arrays."""
    g = lambda i, j: a[min(i, j), max(i, j)]
    co = {(i, j): g((i + 1) % 3, (j + 1) % 3) * g((i + 2) % 3, (j + 2) % 3) - g((i + 1) % 3, (j + 2) % 3) * g((i + 2) % 3, (j + 1) % 3) for i in range(3) for j in range(3)}
    return g(0, 0) * co[0, 0] + g(0, 1) * co[0, 1] + g(0, 2) * co[0, 2], [co[i, 0] * b[0] + co[i, 1] * b[1] + co[i, 2] * b[2] for i in range(3)]


def _terms(c: list, d: list) -> tuple[dict, list]:
    """What a ray adds to both sides of the equations."""
    m = {(i, j): (1.0 if i == j else 0.0) - d[i] * d[j] for i in range(3) for j in range(i, 3)}
    return m, [sum((m[min(i, j), max(i, j)] * c[j] for j in range(1, 3)), m[min(i, 0), max(i, 0)] * c[0]) for i in range(3)]


def _triangulated(track: pa.Array, n: np.ndarray, rays: np.ndarray) -> pa.RecordBatch:
    """Solved tracks of n rays each (two at least); ``rays`` (7, all rays) has them one after the other."""
    starts, (c, d, f) = np.cumsum(n) - n, (rays[:3], rays[3:6], rays[6])
    m, v = _terms(list(c), list(d))
    total = lambda x: np.add.reduceat(x, starts) if len(starts) else np.zeros(0)
    det, p = _solve({k: total(x) for k, x in m.items()}, [total(x) for x in v])
    known = np.abs(det) > 1e-12
    p = np.stack(p) / np.where(known, det, 1.0)
    to = np.repeat(p, n, axis=1) - c
    along = (to * d).sum(axis=0)
    off = np.sqrt(np.maximum((to * to).sum(axis=0) - along * along, 0.0))
    e = np.where(along > 0, f * off / np.where(along > 0, along, 1.0), np.inf)
    error = np.maximum.reduceat(e, starts) if len(starts) else np.zeros(0)
    columns = {"track": track, "views": n, "x": p[0], "y": p[1], "z": p[2], "error": error, "chord2": chords(d.T.ravel(), starts * 3, n)}
    return pa.RecordBatch.from_pydict({k: pa.array(x) if isinstance(x, np.ndarray) else x for k, x in columns.items()}).filter(pa.array(known))


def _short_tracks(bundles: DataFrame) -> DataFrame:
    """OUT of tracks (track, rays) whose rays lie in one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column("rays")
            values, track = held.flatten(), batch.column("track")
            n = pc.fill_null(pc.list_value_length(held), 0).to_numpy().astype(np.int64)
            named = dict(zip((x.name for x in values.type), values.flatten(), strict=True))
            fields = [named[c] for c in RAY]
            given = np.logical_and.reduce([x.is_valid().to_numpy(zero_copy_only=False) for x in fields])
            n = np.bincount(np.repeat(np.arange(len(n)), n)[given], minlength=len(n))
            many = n >= 2
            rays = np.stack([x.to_numpy(zero_copy_only=False).astype(float) for x in fields])[:, given]
            yield _triangulated(track.filter(pa.array(many)), n[many], rays[:, np.repeat(many, n)])

    kind = dict(bundles.dtypes)["track"]
    found = bundles.where(F.col("track").isNotNull()).select("track", "rays").mapInArrow(run, f"track {kind}, views long, x double, y double, z double, error double, chord2 double")
    return found.withColumn("angle", angle_of("chord2")).select(*OUT)


def _long_tracks(rays: DataFrame) -> DataFrame:
    """OUT of tracks of any length, by sums that merge; rays is a written table."""
    rays = rays.where(" and ".join(f"{c} is not null" for c in ("track", *RAY)))
    c, d = [F.col(x) for x in ("cx", "cy", "cz")], [F.col(x) for x in ("dx", "dy", "dz")]
    m, v = _terms(c, d)
    sums = [F.sum(x).alias(f"a{i}{j}") for (i, j), x in m.items()] + [F.sum(x).alias(f"b{i}") for i, x in enumerate(v)]
    s = rays.groupBy("track").agg(F.count(F.lit(1)).alias("views"), *sums).where("views >= 2")
    det, p = _solve({(i, j): F.col(f"a{i}{j}") for i, j in m}, [F.col(f"b{i}") for i in range(3)])
    points = materialize(s.where(F.abs(det) > 1e-12).select("track", "views", *[(x / det).alias(k) for k, x in zip("xyz", p, strict=True)]), "points")
    seen = rays.join(points, "track")
    to = [F.col(x) - q for x, q in zip("xyz", c, strict=True)]
    along = to[0] * d[0] + to[1] * d[1] + to[2] * d[2]
    off = F.sqrt(F.greatest(to[0] * to[0] + to[1] * to[1] + to[2] * to[2] - along * along, F.lit(0.0)))
    worst = seen.withColumn("e", F.when(along > 0, F.col("f") * off / along).otherwise(F.lit(float("inf")))).groupBy("track").agg(F.max("e").alias("error"))
    angle = widest_angles(rays.join(points.select("track", "views"), "track"))
    return points.join(worst, "track").join(angle, "track").select(*OUT)
