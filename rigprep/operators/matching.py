"""Nearest descriptors of image pairs (M5), by tiles of two image blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rigprep.functions.shared import materialize

#: Matcher presets.
PRESETS = {"NN-mutual": {"ratio": None, "distance": None}, "NN-ratio": {"ratio": 0.8, "distance": None}, "NN-superpoint": {"ratio": None, "distance": 0.7}}
PAIR = ["scene_id", "image0", "image1"]
#: Keypoints of one block. Two blocks' similarities, in doubles, are the largest matrix of a task.
BLOCK_KEYPOINTS = 2048
#: Bytes of descriptors of one strip; a task holds the blocks of two strips.
STRIP_BYTES = 32 << 20
#: Strips of a scene, unless they would be over STRIP_BYTES: a block is sent to one tile more than that, at most.
MAX_STRIPS = 32

NEAREST = "scene_id string, image0 string, image1 string, side int, kp int, other int, sim double, second double"


def two_best(sim: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id of the nearest, its similarity, the second similarity or nan) of each row; ids rise, ties go to the lower one."""
    rows = np.arange(len(sim))
    best = sim.argmax(axis=1)
    top = sim[rows, best]
    if sim.shape[1] == 1:
        return ids[best], top, np.full(len(sim), np.nan)
    sim[rows, best] = -np.inf
    second = sim.max(axis=1)
    sim[rows, best] = top
    return ids[best], top, second


def descriptor_blocks(features: DataFrame, block_keypoints: int = BLOCK_KEYPOINTS) -> DataFrame:
    """``(scene_id, image, block, kp, d)``: an image's keypoints in order of their id, and their descriptors in one array.

    A block has the ids of one range of ``block_keypoints``, so an image of any size is many rows of bounded size.
    """
    block = F.floor(F.col("kp_idx") / block_keypoints).cast("int")
    rows = F.array_sort(F.collect_list(F.struct("kp_idx", "descriptor")))
    packed = features.groupBy("scene_id", "image", block.alias("block")).agg(rows.alias("f"))
    return packed.select("scene_id", "image", "block", F.transform("f", lambda x: x["kp_idx"]).alias("kp"), F.flatten(F.transform("f", lambda x: x["descriptor"])).alias("d"))


def nearest_of(own: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray], size: int = BLOCK_KEYPOINTS) -> tuple[list, list]:
    """two_best of all rows of own among other, and of other among own; no matrix has more than size x size numbers."""
    found = [[], [None] * -(-len(other[0]) // size)]

    def better(old, new):
        if old is None:
            return new
        first = new[1] > old[1]
        lost = np.where(first, old[1], new[1])
        return np.where(first, new[0], old[0]), np.where(first, new[1], old[1]), np.fmax(np.fmax(old[2], new[2]), lost)

    for i in range(0, len(own[0]), size):
        mine, d = own[0][i : i + size], own[1][i : i + size].astype(float)
        best = None
        for k, j in enumerate(range(0, len(other[0]), size)):
            theirs = other[0][j : j + size]
            sim = d @ other[1][j : j + size].astype(float).T
            best = better(best, two_best(sim, theirs))
            found[1][k] = better(found[1][k], two_best(sim.T, mine))
        found[0].append(best)
    return tuple([np.concatenate(x) for x in zip(*f, strict=True)] for f in found)


def tile_nearest(blocks: DataFrame, pairs: DataFrame, strip_bytes: int = STRIP_BYTES) -> DataFrame:
    """``NEAREST``: for each keypoint of a pair, the two best of each strip of the other image.

    Blocks are dealt in order into strips of ``strip_bytes`` about, and a tile is two strips of a scene with the pairs
    between them. A block goes to each tile once and not to each pair: with s strips, at most s + 1 times. Strips are
    wider where a scene would have over MAX_STRIPS, so that what is sent and found grows with the keypoints and not with
    their square, up to STRIP_BYTES, which bounds a task. Only numbers of strips, not descriptors, meet pair by pair.
    side 0: kp is of image0.
    """
    width = dict(blocks.dtypes)["d"]
    size = (F.size("d") * (8 if width == "array<double>" else 4)).cast("long")
    sized = materialize(blocks.select("scene_id", "image", "block", size.alias("bytes")), "sizes")
    held_bytes = F.greatest(F.lit(strip_bytes), F.least(F.lit(max(strip_bytes, STRIP_BYTES)), F.ceil(F.sum("bytes") / MAX_STRIPS)), F.lit(1))
    widths = sized.groupBy("scene_id").agg(held_bytes.alias("width"))
    before = F.sum("bytes").over(Window.partitionBy("scene_id").orderBy("image", "block")) - F.col("bytes")
    placed = materialize(sized.withColumn("before", before).join(widths, "scene_id").select("scene_id", "image", "block", F.floor(F.col("before") / F.col("width")).alias("strip")), "strips")
    asked = pairs.select(*PAIR).distinct()
    for k in "01":
        asked = asked.join(placed.select("scene_id", "image", "strip").distinct().toDF("scene_id", f"image{k}", f"strip{k}"), ["scene_id", f"image{k}"])
    asked = materialize(asked.select(*PAIR, "strip0", "strip1", F.least("strip0", "strip1").alias("low"), F.greatest("strip0", "strip1").alias("high")), "asked")
    side = lambda k: asked.select("scene_id", "low", "high", F.col(f"image{k}").alias("image"), F.col(f"strip{k}").alias("strip"))
    sent = side(0).unionByName(side(1)).distinct().join(placed, ["scene_id", "image", "strip"]).join(blocks.hint("merge"), ["scene_id", "image", "block"])

    def run(held: pa.Table, wanted: pa.Table) -> pa.Table:
        parts: dict = {}
        for image, strip, block, kp, d in zip(*(held.column(c).combine_chunks() for c in ("image", "strip", "block", "kp", "d")), strict=True):
            ids = kp.values.to_numpy()
            parts.setdefault((image.as_py(), strip.as_py()), []).append((block.as_py(), ids, d.values.to_numpy().reshape(len(ids), -1)))
        kept = {}
        for key, of in parts.items():
            of.sort(key=lambda x: x[0])
            kept[key] = np.concatenate([x[1] for x in of]), np.concatenate([x[2] for x in of])
        names = [c.split()[0] for c in NEAREST.split(", ")]
        types = [pa.int32()] * 3 + [pa.float64()] * 2
        out = []
        for scene, a, b, i, j in zip(*(wanted.column(c).to_pylist() for c in (*PAIR, "strip0", "strip1")), strict=True):
            own, other = kept[a, i], kept[b, j]
            for s, ids, found in zip((0, 1), (own[0], other[0]), nearest_of(own, other), strict=True):
                n = len(ids)
                text = [pa.array([x], pa.string()).take(pa.array(np.zeros(n, dtype=np.int32))) for x in (scene, a, b)]
                out.append(pa.table([*text, *(pa.array(v, t, from_pandas=True) for v, t in zip((np.full(n, s), ids, *found), types, strict=True))], names=names))
        return pa.concat_tables(out)

    key = ["scene_id", "low", "high"]
    return sent.groupBy(*key).cogroup(asked.toDF(*asked.columns).groupBy(*key)).applyInArrow(run, NEAREST)


def merged_nearest(nearest: DataFrame) -> DataFrame:
    """One row for each pair, side and keypoint: the best of its strips' bests, and the best of what is left."""
    order = Window.partitionBy(*PAIR, "side", "kp").orderBy(F.desc("sim"), "other")
    two = nearest.withColumn("rank", F.row_number().over(order)).where("rank <= 2")
    first = F.max(F.when(F.col("rank") == 1, F.struct("other", "sim", "second")))
    out = two.groupBy(*PAIR, "side", "kp").agg(first.alias("top"), F.max(F.when(F.col("rank") == 2, F.col("sim"))).alias("next"))
    return out.select(*PAIR, "side", "kp", "top.other", "top.sim", F.greatest("top.second", "next").alias("second"))


def accepted(ratio: float | None, distance: float | None) -> Column:
    """Whether sim passes; the ratio test is off where an image of the pair has one keypoint."""
    ok = F.lit(True)
    if ratio is not None:
        ok &= (F.col("fewest") < 2) | (2 * (1 - F.col("sim")) <= ratio**2 * 2 * (1 - F.col("second")))
    return ok if distance is None else ok & (2 * (1 - F.col("sim")) <= distance**2)


def match_descriptors(pairs: DataFrame, features: DataFrame, preset: str = "NN-mutual", block_keypoints: int = BLOCK_KEYPOINTS, strip_bytes: int = STRIP_BYTES) -> DataFrame:
    """M5: matches (kp0, kp1, score) of each pair by mutual nearest descriptors.

    Similarities are matrix products of two blocks; the two best of each block merge inside a task and of each strip
    after it, so an image may span blocks and tasks. Where pairs stay inside frames, let scene_id name the scene and frame. Ties go to the lower
    keypoint. Images without keypoints give no rows, repeated pairs one match.
    """
    opt = PRESETS[preset]
    blocks = materialize(descriptor_blocks(features, block_keypoints), "blocks")
    best = merged_nearest(tile_nearest(blocks, pairs, strip_bytes))
    if opt["ratio"] is not None:
        n = blocks.groupBy("scene_id", "image").agg(F.sum(F.size("kp")).alias("n"))
        for k in "01":
            best = best.join(n.toDF("scene_id", f"image{k}", f"n{k}"), ["scene_id", f"image{k}"])
        best = best.withColumn("fewest", F.least("n0", "n1"))
    best = best.where(accepted(**opt))
    # a match is two rows, one of each side
    kp0, kp1 = (F.when(F.col("side") == s, F.col("kp")).otherwise(F.col("other")) for s in (0, 1))
    both = best.groupBy(*PAIR, kp0.alias("kp0"), kp1.alias("kp1")).agg(F.count(F.lit(1)).alias("sides"), F.max("sim").alias("sim"))
    return both.where("sides = 2").select(*PAIR, "kp0", "kp1", ((F.col("sim") + 1) / 2).alias("score"))
