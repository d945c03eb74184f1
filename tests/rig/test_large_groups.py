"""Operators whose groups may have any size, against brute force."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rigprep.functions.order import exact_median, with_rank
from rigprep.operators import angles, distortion, pairs, stats, tracks
from rigprep.plans import more  # noqa: F401
from rigprep.plans.queries import QUERIES, WHOLE


@pytest.fixture
def many_ranges(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_ranks_are_gapless_in_groups_that_span_ranges(spark, many_ranges):
    rng = random.Random(3)
    rows = [(rng.choice(["hot", "hot", "hot", "b", None]), rng.choice([None, *range(400)]), k) for k in range(3000)] + [("lone", 1, 0)]
    got = with_rank(spark.createDataFrame(rows, "g string, x int, id int"), ["g"], ["x"], "n").collect()
    assert sorted((r.g or "", r.id) for r in got) == sorted((g or "", k) for g, _, k in rows)
    by = defaultdict(list)
    for r in got:
        by[r.g].append((r.n, -1 if r.x is None else r.x))
    for of in by.values():
        of.sort()
        assert [n for n, _ in of] == list(range(1, len(of) + 1)) and [x for _, x in of] == sorted(x for _, x in of)
    assert with_rank(spark.createDataFrame([], "g string, x int"), ["g"], ["x"]).count() == 0


def test_medians_are_exact(spark):
    rng = random.Random(4)
    values = {
        "odd": [rng.gauss(0, 1e3) for _ in range(2001)], "even": [rng.uniform(-1, 1) for _ in range(1000)], "ties": [1.5] * 700 + [2.5] * 700, "tiny": [5e-324, -5e-324, 0.0, -0.0],
        "wide": [10.0**k * s for k in range(-300, 300, 7) for s in (1, -1)] + [3.0], "one": [-7.25], "two": [1.0, 2.0], "inf": [-math.inf, 4.0, math.inf], "near": [1 + k * 2**-52 for k in range(100)],
    }
    rows = [(k, v) for k, vs in values.items() for v in vs] + [("null", None), ("odd", None)]
    rng.shuffle(rows)
    got = {r.k: r["median"] for r in exact_median(spark.createDataFrame(rows, "k string, v double").repartition(6), "k", "v").collect()}
    assert got == {k: pytest.approx(float(np.median(v)), rel=0, abs=0) for k, v in values.items()}
    assert exact_median(spark.createDataFrame([], "k string, v double"), "k", "v").count() == 0


def shapes(rng):
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    t = rng.uniform(0, 2 * np.pi, 3000)
    ring = np.stack([np.cos(t) * 0.3, np.sin(t) * 0.3, np.ones_like(t)], axis=1)
    blobs = np.concatenate([rng.normal(size=(1500, 3)) * 1e-4 + [1, 0.1, 0], rng.normal(size=(1500, 3)) * 1e-4 + [1, -0.2, 0.3]])
    return {
        "sphere": unit(rng.normal(size=(3000, 3))), "cone": unit(rng.normal(size=(3000, 3)) * 0.05 + [0, 0, 1]), "ring": unit(ring), "blobs": unit(blobs),
        "same": np.tile([[0.6, 0.8, 0.0]], (500, 1)), "line": unit(np.stack([np.linspace(-1, 1, 700), np.zeros(700), np.ones(700)], axis=1)),
        "two": np.array([[1.0, 0, 0], [0, 1.0, 0]]), "short": unit(rng.normal(size=(7, 3))), "opposite": np.array([[0, 0, 1.0], [0, 0, -1.0], [0, 1.0, 0]]),
    }


@pytest.mark.parametrize("few", [50, 20_000])
def test_widest_angles_are_exact_for_any_length(spark, monkeypatch, few):
    monkeypatch.setattr(angles, "OPEN_PAIRS", few)
    sets = shapes(np.random.default_rng(6))
    rows = [(k, len(v), *map(float, d)) for k, v in sets.items() for d in v]
    random.Random(1).shuffle(rows)
    got = {r.track: r.angle for r in angles.widest_angles(spark.createDataFrame(rows, "track string, views long, dx double, dy double, dz double")).collect()}
    for k, v in sets.items():
        most = max(float(np.linalg.norm(v - d, axis=1).max()) for d in v)
        assert got[k] == pytest.approx(math.degrees(2 * math.asin(min(1.0, most / 2))), abs=1e-9), k
    assert set(got) == set(sets)


@pytest.mark.parametrize("method", ["bilinear", "nearest"])
def test_places_are_gathered_over_the_edges_of_tiles(spark, method):
    rng = np.random.default_rng(8)
    image = {f: rng.uniform(0, 255, (100, 150)) for f in (1, 2)}
    image[2][10, 10] = 0
    pixels = [("s", 0, f, u, v, None if (f, u, v) == (2, 10, 10) else float(x[v, u])) for f, x in image.items() for v in range(100) for u in range(150)]
    places = [(63.0, 63.0), (63.5, 63.5), (127.25, 64.0), (-0.5, 5.25), (-1.0, -1.0), (149.0, 99.0), (149.5, 99.75), (10.5, 10.5), (1e300, 3.0), (float("nan"), 3.0), (float("inf"), 1.0), (75.5, -0.25)]
    places += [(float(a), float(b)) for a, b in rng.uniform([-5, -5], [155, 105], (300, 2))]
    lookup = spark.createDataFrame([("s", 0, k % 140, k // 140 + 60, *p) for k, p in enumerate(places)] + [("s", 9, 0, 0, 1.0, 1.0)], "scene_id string, cam_idx int, u int, v int, su double, sv double")
    table = spark.createDataFrame(pixels, "scene_id string, cam_idx int, frame_id int, u int, v int, value double")
    got = {(r.frame_id, r.u, r.v): r.value for r in distortion.remap_pixels(table, lookup, method, ("frame_id",)).collect()}
    assert len(got) == 2 * len(places)
    for k, (x, y) in enumerate(places):
        for f in image:
            at = lambda u, v, f=f: float(image[f][v, u]) if 0 <= u < 150 and 0 <= v < 100 else 0.0
            if not (abs(x) < 1e9 and abs(y) < 1e9):
                want = 0.0
            elif method == "nearest":
                want = at(math.floor(x + 0.5), math.floor(y + 0.5))
            else:
                u, v = math.floor(x), math.floor(y)
                a, b = x - u, y - v
                want = (1 - a) * ((1 - b) * at(u, v) + b * at(u, v + 1)) + a * ((1 - b) * at(u + 1, v) + b * at(u + 1, v + 1))
            assert got[f, k % 140, k // 140 + 60] == pytest.approx(want, abs=1e-9)
    one = distortion.remap_pixels(table.where("frame_id = 1").drop("frame_id"), lookup, method)
    assert {r.value for r in one.where("cam_idx = 9").collect()} == {0.0} and one.count() == len(places) + 1


def test_no_exchange_has_a_row_for_a_pixel(spark):
    pixels = spark.range(64 * 64 * 6).selectExpr("'s' as scene_id", "0 as cam_idx", "cast(id % 192 as int) as u", "cast(id div 192 as int) as v", "cast(id as double) as value")
    lookup = pixels.selectExpr("scene_id", "cam_idx", "u", "v", "u + 0.5 as su", "v + 0.5 as sv")
    out = distortion.remap_pixels(pixels, lookup)
    tiles = [spark.read.parquet(f).count() for f in {x.rsplit("/", 1)[0] for x in out.inputFiles()}]
    assert sorted(tiles) == [6, 6] and out.count() == 64 * 64 * 6


def test_colours_are_counted_by_bitmaps(spark):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), rng.random(), 1.0, 2.0, *(rng.choice([0, 1, 128, 255]) for _ in range(3))) for _ in range(2000)] + [("a", 5.0, 1.0, 2.0, None, 1, 1), ("a", 5.0, 1.0, 2.0, 256, 1, 1), ("c", 0.0, 0.0, 0.0, None, None, None)]
    got = {r.scene_id: r for r in stats.cloud_stats(spark.createDataFrame(rows, "scene_id string, x double, y double, z double, r int, g int, b int")).collect()}
    for s in "ab":
        of = [r for r in rows if r[0] == s]
        assert got[s].points == len(of) and got[s].colors == len({r[4:] for r in of if r[4] is not None and r[4] < 256})
        assert (got[s].min_x, got[s].max_x) == (min(r[1] for r in of), max(r[1] for r in of))
    assert (got["c"].colors, got["c"].points) == (0, 1)


def test_uncertainty_grows_with_the_mean_scale(spark):
    feats = spark.createDataFrame([("s", "i", 0, 10.0, 20.0)], "scene_id string, image string, kp_idx int, x double, y double")
    sizes = spark.createDataFrame([("s", "i", 3000, 1001)], "scene_id string, image string, width int, height int")
    r = pairs.rescale_keypoints(feats, sizes, 1000, detection_noise=2.0).first()
    assert r.scale == pytest.approx((3000 / 1000 + 1001 / 334) / 2) and r.uncertainty == pytest.approx(2 * r.scale)


def test_a_points_rays_go_to_tasks_once(spark):
    """One exchange, of points, by which copies are numbered; none of rays."""
    for run in (QUERIES["m11_triangulate"], WHOLE["m11_triangulate_all"]):
        plan = run(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "Join" not in plan


@pytest.mark.parametrize("packed", [1, 4, 256])
def test_tracks_are_triangulated_alike_flat_in_rows_and_long(spark, monkeypatch, packed):
    monkeypatch.setattr(tracks, "PACKED_VIEWS", packed)
    rng, flat = np.random.default_rng(9), []
    for k, views in enumerate([1, 2, 3, 4, 5, 9, 300]):
        point, c = np.array([0.5 * k, 1.0, 6.0]), rng.normal(size=(views, 3))
        d = point - c
        flat += [(k, *map(float, (*x, *y)), 1000.0) for x, y in zip(c, d / np.linalg.norm(d, axis=1, keepdims=True), strict=True)]
    flat += [(2, None, *[0.0] * 6), (0, 1.0, *[0.0] * 4, 1.0, None), (None, *[0.0] * 5, 1.0, 1.0)]
    rays = spark.createDataFrame(flat, "track int, cx double, cy double, cz double, dx double, dy double, dz double, f double")
    bundled = rays.groupBy("track").agg(F.count(F.lit(1)).alias("views"), F.collect_list(F.struct("f", *tracks.RAY[:-1])).alias("rays"))
    for form in (rays, bundled):
        got = {r.track: r for r in tracks.triangulate_tracks(form).collect()}
        assert {k: r.views for k, r in got.items()} == {1: 2, 2: 3, 3: 4, 4: 5, 5: 9, 6: 300}
        for k, r in got.items():
            d = np.array([x[4:7] for x in flat if x[0] == k and None not in x])
            widest = max(float(np.linalg.norm(d - y, axis=1).max()) for y in d)
            assert (r.x, r.y, r.z, r.error) == pytest.approx((0.5 * k, 1.0, 6.0, 0.0), abs=1e-4) and r.angle == pytest.approx(math.degrees(2 * math.asin(widest / 2)))
