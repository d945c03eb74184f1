"""Descriptor matching by tiles against whole matrices."""

import random

import numpy as np
import pytest

from rigprep.operators import matching

SCHEMA = "scene_id string, image string, kp_idx int, descriptor array<float>"


def brute(images, pairs, ratio, distance):
    """images: (scene, name) to {kp: descriptor}."""
    out = set()
    for scene, a, b in pairs:
        x, y = images.get((scene, a), {}), images.get((scene, b), {})
        if not x or not y:
            continue
        ids = [sorted(x), sorted(y)]
        sim = np.array([[float(np.dot(np.float64(x[i]), np.float64(y[j]))) for j in ids[1]] for i in ids[0]])
        test = ratio if min(sim.shape) > 1 else None

        def pick(s, test=test):
            best = []
            for row in s:
                order = np.argsort(-row, kind="stable")
                d0 = 2 * (1 - row[order[0]])
                ok = (test is None or d0 <= test**2 * 2 * (1 - row[order[1]])) and (distance is None or d0 <= distance**2)
                best.append(int(order[0]) if ok else -1)
            return best

        m0, m1 = pick(sim), pick(sim.T)
        out |= {(scene, a, b, ids[0][i], ids[1][j]) for i, j in enumerate(m0) if j >= 0 and m1[j] == i}
    return sorted(out)


def made(seed):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(40, 8))
    images = {}
    for scene in ("s", "t"):
        for k, n in enumerate((40, 25, 1, 7, 0)):
            kps = rng.choice(40, n, replace=False)
            images[scene, f"i{k}"] = {int(p) * 3: (v / np.linalg.norm(v)).astype(np.float32).tolist() for p in kps for v in [base[p] + rng.normal(size=8) * rng.choice([0.05, 0.3, 1.0])]}
    images["s", "i1"][119] = images["s", "i1"][min(images["s", "i1"])]  # a tie
    return images


@pytest.mark.parametrize("preset", sorted(matching.PRESETS))
@pytest.mark.parametrize(("block", "strip"), [(5, 200), (7, 1 << 20), (2048, 1), (2048, 1 << 20)])
def test_tiles_give_what_whole_matrices_give(spark, preset, block, strip):
    images = made(3)
    rows = [(*key, kp, d) for key, kps in images.items() for kp, d in kps.items()]
    random.Random(1).shuffle(rows)
    pairs = [(s, f"i{a}", f"i{b}") for s in "st" for a in range(5) for b in range(a + 1, 6)] + [("s", "i1", "i0"), ("s", "i0", "i0"), ("u", "i0", "i1")]
    asked = spark.createDataFrame(pairs + pairs[:3], "scene_id string, image0 string, image1 string")
    got = matching.match_descriptors(asked, spark.createDataFrame(rows, SCHEMA), preset, block, strip)
    rows = got.collect()
    assert sorted((r.scene_id, r.image0, r.image1, r.kp0, r.kp1) for r in rows) == brute(images, pairs, **matching.PRESETS[preset])
    assert len(rows) > 20
    for r in rows:
        x, y = (np.float64(images[r.scene_id, i][k]) for i, k in ((r.image0, r.kp0), (r.image1, r.kp1)))
        assert r.score == pytest.approx((float(x @ y) + 1) / 2)


def test_a_block_goes_to_tiles_and_not_to_pairs(spark):
    images = made(4)
    rows = [("s", f"i{k}", kp, d) for k in range(30) for kp, d in images["s", "i0"].items()]
    blocks = matching.descriptor_blocks(spark.createDataFrame(rows, SCHEMA)).cache()
    pairs = spark.createDataFrame([("s", f"i{a}", f"i{b}") for a in range(30) for b in range(a + 1, 30)], "scene_id string, image0 string, image1 string")
    near = matching.tile_nearest(blocks, pairs, strip_bytes=10 * 40 * 8 * 4)

    near.write.format("noop").mode("overwrite").save()
    sent = blocks.sparkSession.read.parquet(*[f for f in near.inputFiles() if "asked" in f]).selectExpr("low", "high", "explode(array(image0, image1)) as image").distinct().collect()
    assert max(sum(r.image == f"i{k}" for r in sent) for k in range(30)) <= 4


def test_nothing_to_match(spark):
    none = spark.createDataFrame([], SCHEMA)
    pairs = spark.createDataFrame([("s", "a", "b")], "scene_id string, image0 string, image1 string")
    assert matching.match_descriptors(pairs, none).count() == 0
    some = spark.createDataFrame([("s", "a", 1, [1.0, 0.0])], SCHEMA)
    assert matching.match_descriptors(pairs, some).count() == 0


def test_rows_grow_with_strips_and_strips_are_few(spark):
    """Blocks of two keypoints and strips of a byte: a keypoint has a row for each strip of the other image, not for each block."""
    rng = np.random.default_rng(5)
    rows = [("s", i, k, [float(x) for x in rng.normal(size=4)]) for i in "ab" for k in range(400)]
    feats = spark.createDataFrame(rows, "scene_id string, image string, kp_idx int, descriptor array<double>")
    pair = spark.createDataFrame([("s", "a", "b")], "scene_id string, image0 string, image1 string")
    blocks = matching.descriptor_blocks(feats, 2).cache()
    assert blocks.count() == 400
    assert 800 <= matching.tile_nearest(blocks, pair, 1).count() <= 800 * (matching.MAX_STRIPS // 2 + 2)
