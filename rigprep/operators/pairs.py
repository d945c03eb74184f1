"""Image pairs, matches and keypoint geometry (M1-M4, M6-M9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rigprep.functions import rotation as rot
from rigprep.functions.shared import materialize

PAIR = ["scene_id", "image0", "image1"]
#: Wanted pairs (each in both orientations) that are broadcast, at most; more are joined by shuffles.
BROADCAST_PAIRS = 1_000_000


def exhaustive_pairs(images: DataFrame, keys: tuple[str, ...] = ("scene_id",), name: str = "name") -> DataFrame:
    """M1: all pairs image0 < image1 inside a scene (and frame): an equi-join with a residual."""
    a, b = images.select(*keys, F.col(name).alias("image0")), images.select(*keys, F.col(name).alias("image1"))
    return a.join(b, list(keys)).where("image0 < image1")


def cross_pairs(query: DataFrame, ref: DataFrame, keys: tuple[str, ...] = ("scene_id",), name: str = "name") -> DataFrame:
    """M2: each query with each reference image of its scene."""
    return query.select(*keys, F.col(name).alias("image0")).join(ref.select(*keys, F.col(name).alias("image1")), list(keys))


def new_pairs(pairs: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """M3: one row for each unordered pair, without pairs that are done in either orientation."""
    order = lambda df: df.where("image0 <> image1").select("scene_id", F.least("image0", "image1").alias("image0"), F.greatest("image0", "image1").alias("image1")).distinct()
    return order(pairs) if done is None else order(pairs).join(order(done), PAIR, "left_anti")


def pending_images(images: DataFrame, features: DataFrame, overwrite: bool = False) -> DataFrame:
    """M4: images that have no features yet, or all."""
    return images if overwrite else images.join(features.select("scene_id", F.col("image").alias("name")).distinct(), ["scene_id", "name"], "left_anti")


def sparse_matches(dense: DataFrame, pairs: DataFrame) -> DataFrame:
    """M6: matches of the wanted pairs from dense rows (kp1 = -1: none), in either orientation.

    Pairs are few and dense rows many: each pair asks in both orientations, so dense rows are read once and, unless
    pairs are too many to be broadcast, neither shuffled nor sorted.
    """
    end = lambda a, b, flip: F.struct(F.col(a).alias("image0"), F.col(b).alias("image1"), F.lit(flip).alias("flip"))
    both = F.explode(F.array(end("image0", "image1", False), end("image1", "image0", True))).alias("p")
    asked = materialize(pairs.select("scene_id", both).select("scene_id", "p.*"), "wanted")
    asked = F.broadcast(asked) if asked.count() <= BROADCAST_PAIRS else asked.hint("merge")
    found = dense.where("kp0 >= 0 and kp1 >= 0").join(asked, PAIR)
    turned = lambda a, b: F.when(F.col("flip"), F.col(b)).otherwise(F.col(a)).alias(a)
    return found.select("scene_id", turned("image0", "image1"), turned("image1", "image0"), turned("kp0", "kp1"), turned("kp1", "kp0"), "score")


def filter_matches(matches: DataFrame, min_score: float) -> DataFrame:
    """M7: scores strictly over a threshold."""
    return matches.where(F.col("score") > min_score)


def rescale_keypoints(features: DataFrame, images: DataFrame, resize_max: int, force: bool = False, detection_noise: float = 1.0) -> DataFrame:
    """M8: keypoints of resized images at full size (ox, oy), with the model's origin (mx, my) and the uncertainty of their places.

    images: scene_id, image, width, height. Images are resized so that the longer side is
    resize_max, if it is longer or if forced; sizes are rounded half to even. ``detection_noise`` is a keypoint's
    uncertainty in the resized image, in pixels.
    """
    longest = F.greatest("width", "height")
    resized = F.lit(force) | (longest > resize_max)
    new = {c: F.when(resized, F.bround(F.col(c) * (F.lit(float(resize_max)) / longest))).otherwise(F.col(c).cast("double")) for c in ("width", "height")}
    j = features.join(images.select("scene_id", "image", "width", "height"), ["scene_id", "image"])
    sx, sy = F.col("width") / new["width"], F.col("height") / new["height"]
    ox, oy = (F.col("x") + 0.5) * sx - 0.5, (F.col("y") + 0.5) * sy - 0.5
    return j.withColumns({"scale": (sx + sy) / 2, "uncertainty": detection_noise * (sx + sy) / 2, "ox": ox, "oy": oy, "mx": ox + 0.5, "my": oy + 0.5})


def epipolar_errors(matches: DataFrame, points: DataFrame, poses: DataFrame) -> DataFrame:
    """M9: distances of each match to its epipolar lines, err0 and err1, on normalised points.

    points: scene_id, image, kp_idx, x, y (normalised); poses: scene_id, image, qw..qz, tx..tz.
    """
    m = matches
    for k in "01":
        m = m.join(points.select("scene_id", F.col("image").alias(f"image{k}"), F.col("kp_idx").alias(f"kp{k}"), F.col("x").alias(f"x{k}"), F.col("y").alias(f"y{k}")), ["scene_id", f"image{k}", f"kp{k}"])
        m = m.join(poses.select("scene_id", F.col("image").alias(f"image{k}"), *[F.col(c).alias(c + k) for c in ("qw", "qx", "qy", "qz", "tx", "ty", "tz")]), ["scene_id", f"image{k}"])
    r0, r1 = (rot.quat_to_matrix(*[F.col(c + k) for c in ("qw", "qx", "qy", "qz")]) for k in "01")
    m = m.withColumns({"__r0": F.array(*r0), "__r1": F.array(*r1)})
    r0, r1 = ([F.get(f"__r{k}", F.lit(i)) for i in range(9)] for k in "01")
    m = m.withColumn("__r", F.array(*rot.product(r1, rot.transpose(r0))))
    r = [F.get("__r", F.lit(i)) for i in range(9)]
    t0, t1 = ([F.col(c + k) for c in ("tx", "ty", "tz")] for k in "01")
    t = [a - b for a, b in zip(t1, rot.apply(r, t0), strict=True)]
    skew = [rot.d(0), -t[2], t[1], t[2], rot.d(0), -t[0], -t[1], t[0], rot.d(0)]
    m = m.withColumn("__e", F.array(*rot.product(skew, r)))
    e = [F.get("__e", F.lit(i)) for i in range(9)]
    p0, p1 = [F.col("x0"), F.col("y0"), F.lit(1.0)], [F.col("x1"), F.col("y1"), F.lit(1.0)]
    line1, line0 = rot.apply(e, p0), rot.apply(rot.transpose(e), p1)
    off = F.abs(p1[0] * line1[0] + p1[1] * line1[1] + line1[2])
    norm = lambda a: F.nullif(F.sqrt(a[0] * a[0] + a[1] * a[1]), F.lit(0.0))
    return m.select(*PAIR, "kp0", "kp1", (off / norm(line0)).alias("err0"), (off / norm(line1)).alias("err1"))
