"""Scene names keep three digits, so scenes from 1000 on share the cameras of others; queries equal their SQL there too."""

import duckdb
import pytest

from rigprep.operators import calib, distortion, pairs, tracks
from rigprep.plans import more  # noqa: F401
from rigprep.plans.queries import ORACLES, QUERIES, WHOLE
from tests.rig.test_entry import TABLES, plain

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def repeated(tmp_path_factory):
    """A folder of tables whose suppliers are eight cameras of each of four scenes, three of which have one name."""
    folder = tmp_path_factory.mktemp("repeated")
    con = duckdb.connect()
    con.sql(f"""COPY (SELECT (scene * 20 + cam)::BIGINT AS s_suppkey, 'n' AS s_name, (cam % 25)::INTEGER AS s_nationkey, (scene + cam)::DOUBLE AS s_acctbal
        FROM (SELECT unnest([1, 100, 1000, 1001]) AS scene), (SELECT unnest(range(0, 8)) AS cam)) TO '{folder}/supplier.parquet'""")
    for t in TABLES[1:]:
        (folder / f"{t}.parquet").symlink_to(f"{SF}/{t}.parquet")
    return str(folder)


def equals_sql(spark, folder, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    df = QUERIES[name](spark, folder)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    return got == sorted((tuple(plain(v) for v in row) for row in con.sql(ORACLES[name]).select(*cols).fetchall()), key=repr)


@pytest.mark.parametrize("name", ["d4_remap_bilinear", "d4_remap_nearest"])
def test_repeated_cameras_are_remapped_as_joins_say(spark, repeated, name):
    assert equals_sql(spark, repeated, name)


JOINED = ["d4_crop_pixels", "d1_distort_points", "d2_undistort_points", "c9_corner_intrinsics", "c10_inner_rect", "c10_inner_rect_half", "c11_undistortion_quality", "c12_quality_distribution", "d3_undistort_new_camera"]
LISTED = ["s5_parse_model_images", "a3_align_names", "a3_align_policies", "a4_rename_images", "a6_verify_images", "g4_camera_usage", "m3_new_pairs", "m10_conflicting_tracks"]
RUNS = ["m10_build_tracks"]
TIED = ["c13_rewrite_calibration"]


@pytest.mark.parametrize("name", JOINED + LISTED + RUNS + TIED)
def test_repeated_cameras_equal_the_sql(spark, repeated, name):
    assert equals_sql(spark, repeated, name)


@pytest.mark.parametrize("name, order", [("k7_exchange_documents", "cam_idx, f, cx, cy, k1, k2"), ("s2_flatten_calibration", "cam_idx, f, ar, cx, cy")])
def test_cameras_that_tie_are_in_one_of_the_orders_of_the_sql(spark, repeated, monkeypatch, name, order):
    monkeypatch.setitem(ORACLES, name, ORACLES[name].replace("ORDER BY cam_idx", f"ORDER BY {order}"))
    assert equals_sql(spark, repeated, name)


@pytest.mark.parametrize("name", ["d4_remap_bilinear_all", "d4_remap_nearest_all"])
def test_tiles_are_never_broadcast(spark, repeated, name):
    assert "BroadcastHashJoin" not in WHOLE[name](spark, repeated)._jdf.queryExecution().executedPlan().toString()


def test_of_rows_of_the_first_image_the_first_by_then_counts(spark):
    old = spark.createDataFrame([("s", k, "z.png", 1.0, 1.0, *[0.0] * 7) for k in range(3)], "scene_id string, cam_idx int, img_name string, f double, ar double, cx double, cy double, k1 double, k2 double, k3 double, p1 double, p2 double")
    new = spark.createDataFrame([("s", "b.png", 1.0, 1), ("s", "a.png", 5.0, 9), ("s", "a.png", 7.0, 3), ("s", "a.png", 6.0, 4)], "scene_id string, img_name string, fx double, key int").selectExpr("*", "fx as fy", "0D as cx", "0D as cy")
    for then, want in ((("key",), 7.0), (("fx",), 5.0)):
        for parts in (1, 4):
            assert {r.f for r in calib.rewrite_calibration(old, new.repartition(parts), then).collect()} == {want}


def test_images_of_one_name_have_keypoints_of_their_own(spark):
    rows = [("s", "a", 1, "b", 2, 5, 5), ("s", "b", 2, "c", 4, 5, 5), ("s", "b", 3, "d", 5, 5, 5), ("s", "e", 6, "e", 7, 1, 1), ("s", "f", 8, "f", 8, 1, 2)]
    matches = spark.createDataFrame(rows, "scene_id string, image0 string, copy0 long, image1 string, copy1 long, kp0 int, kp1 int")
    found = sorted((r.image, r.kp_idx, r.track[2:3], r.conflict) for r in tracks.build_tracks(matches).collect())
    assert found == [("a", 5, "a", False), ("b", 5, "a", False), ("b", 5, "b", False), ("c", 5, "a", False), ("d", 5, "b", False), ("e", 1, "e", False), ("e", 1, "e", False), ("f", 1, "f", True), ("f", 2, "f", True)]


def test_every_repeated_pixel_counts(spark):
    pixels = spark.createDataFrame([("s", 0, 1, 1, 5.0), ("s", 0, 1, 1, 7.0), ("s", 0, 2, 1, None)], "scene_id string, cam_idx int, u int, v int, value double")
    lookup = spark.createDataFrame([("s", 0, 0, 0, 1.0, 1.0), ("s", 0, 0, 0, 1.5, 1.0), ("s", 0, 1, 0, 9.0, 9.0), ("s", 0, 2, 0, float("nan"), 1.0)], "scene_id string, cam_idx int, u int, v int, su double, sv double")
    rows = lambda *a, **k: sorted((r.u, r.value) for r in distortion.remap_pixels(pixels, lookup, *a, **k).collect())
    assert rows("nearest", repeated="all") == [(0, 0.0), (0, 5.0), (0, 7.0), (1, 0.0), (2, 0.0)]
    assert rows("bilinear", repeated="all") == [(0, 18.0), (1, 0.0), (2, 0.0)]
    assert rows("bilinear") == [(0, 3.5), (0, 7.0), (1, 0.0), (2, 0.0)]


def test_places_and_repeated_pixels_are_paired_by_spark(spark):
    pixels = spark.range(300).selectExpr("'s' as scene_id", "0 as cam_idx", "cast(id % 3 as int) as u", "1 as v", "cast(id as double) as value")
    lookup = spark.range(400).selectExpr("'s' as scene_id", "0 as cam_idx", "cast(id % 200 as int) as u", "cast(id as int) as v", "cast(id % 4 as double) as su", "1.0D as sv")
    out = distortion.remap_pixels(pixels, lookup, "nearest", repeated="all")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate explode(value") < plan.index("Generate explode(arrays_zip") < plan.index("FlatMapCoGroups")
    want = sorted((k % 200, k, x) for k in range(400) for x in ([float(i) for i in range(300) if i % 3 == k % 4] or [0.0]))
    assert sorted((r.u, r.v, r.value) for r in out.collect()) == want


def test_tiles_are_made_of_arrays_that_tasks_pack(spark, monkeypatch):
    monkeypatch.setattr(distortion, "PACKED_ROWS", 100)
    pixels = spark.range(2000).selectExpr("'s' as scene_id", "0 as cam_idx", "cast(id % 100 as int) as u", "cast(id div 100 as int) as v", "cast(if(id % 7 = 0, null, id) as double) as value")
    tiles = distortion.pixel_tiles(pixels.repartition(3), distortion.CAMERA)
    plan = tiles._jdf.queryExecution().executedPlan().toString()
    assert plan.index("ObjectHashAggregate") < plan.index("MapInArrow")
    found = {(r.tu, r.tv): dict(zip(r.at, r.value, strict=True)) for r in tiles.collect()}
    want = {k: {} for k in [(0, 0), (1, 0)]}
    for k in range(2000):
        want[k % 100 // 64, 0][k // 100 * 64 + k % 100 % 64] = 0.0 if k % 7 == 0 else float(k)
    assert found == want


def test_pixels_are_never_broadcast(spark, repeated, monkeypatch):
    plan = lambda: QUERIES["d4_crop_pixels"](spark, repeated)._jdf.queryExecution().executedPlan().toString()
    assert "BuildRight" in plan() and "BuildLeft" not in plan()
    monkeypatch.setattr(distortion, "BROADCAST_REGIONS", 0)
    assert "BroadcastHashJoin" not in plan()


def test_cameras_are_dealt_to_tasks_that_are_not_put_together(spark):
    camera = spark.createDataFrame([("s", k, 4, 3, 5.0, 5.0, 2.0, 1.0, *[0.0] * 5) for k in range(40)], "scene_id string, cam_idx int, width int, height int, fx double, fy double, cx double, cy double, k1 double, k2 double, k3 double, p1 double, p2 double")
    lookup = distortion.undistort_lookup(camera)
    assert lookup.count() == 480 and lookup.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism


def test_dense_matches_are_neither_shuffled_nor_sorted(spark, repeated, monkeypatch):
    plan = QUERIES["m6_sparse_matches"](spark, repeated)._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert equals_sql(spark, repeated, "m6_sparse_matches")
    monkeypatch.setattr(pairs, "BROADCAST_PAIRS", 0)
    assert equals_sql(spark, repeated, "m6_sparse_matches")


@pytest.mark.parametrize("few", [0, 100])
def test_wanted_pairs_ask_in_both_orientations(spark, monkeypatch, few):
    monkeypatch.setattr(pairs, "BROADCAST_PAIRS", few)
    dense = spark.createDataFrame([("s", "a", "b", 1, 2, 0.5), ("s", "a", "a", 3, 4, 0.5), ("s", "b", "c", 5, -1, 0.5), ("s", "c", "a", 6, 7, 0.5)], "scene_id string, image0 string, image1 string, kp0 int, kp1 int, score double")
    wanted = spark.createDataFrame([("s", "b", "a"), ("s", "b", "a"), ("s", "a", "a"), ("s", "b", "c"), ("t", "c", "a")], "scene_id string, image0 string, image1 string")
    assert sorted((r.image0, r.image1, r.kp0, r.kp1) for r in pairs.sparse_matches(dense, wanted).collect()) == [("a", "a", 3, 4), ("a", "a", 4, 3), ("b", "a", 2, 1), ("b", "a", 2, 1)]
