import math
import random

import pytest
from pyspark.sql import functions as F

from rigprep.functions import graph, lens
from rigprep.functions.graph import connected_components
from rigprep.functions.shared import materialize
from rigprep.operators import names, poses, sampling, tracks
from rigprep.plans import more  # noqa: F401
from rigprep.plans.queries import QUERIES, WHOLE
from rigprep.sources import readers, writers

DRAW = random.Random(17)
ANGLES = [(DRAW.uniform(-3, 3), DRAW.uniform(-1.5, 1.5), DRAW.uniform(-3, 3)) for _ in range(40)]


def test_rotations_go_round(spark):
    df = spark.createDataFrame([tuple(map(float, a)) for a in ANGLES], "rx double, ry double, rz double")
    q = poses.convert_rotation(df, "euler_zyx", "quaternion").select("qw", "qx", "qy", "qz", F.col("rx").alias("a"), F.col("ry").alias("b"), F.col("rz").alias("c"))
    for r in poses.convert_rotation(q, "quaternion", "euler_zyx").collect():
        assert (r.rx, r.ry, r.rz) == pytest.approx((r.a, r.b, r.c), abs=1e-9)
        assert r.qw**2 + r.qx**2 + r.qy**2 + r.qz**2 == pytest.approx(1)
    lock = spark.createDataFrame([(0.3, math.pi / 2, 0.0)], "rx double, ry double, rz double")
    m = poses.convert_rotation(poses.convert_rotation(lock, "euler_zyx", "matrix"), "matrix", "euler_zyx").first()
    assert m.ry == pytest.approx(math.pi / 2) and m.rx == pytest.approx(0.3)


def test_inverting_twice_gives_the_pose(spark):
    df = spark.createDataFrame([(0.9, 0.1, -0.3, 0.2, 1.0, 2.0, 3.0)], "qw double, qx double, qy double, qz double, tx double, ty double, tz double")
    inv = poses.invert_pose(df).select(F.col("inv_m").alias("m"), F.col("ix").alias("tx"), F.col("iy").alias("ty"), F.col("iz").alias("tz"))
    back = poses.invert_pose(inv, "matrix").first()
    assert (back.ix, back.iy, back.iz) == pytest.approx((1, 2, 3))


def test_two_line_records_with_blank_second_lines_and_spaces_in_names(spark):
    text = "# c\n1 1 0 0 0 0.5 0 2 1 cam000frame001.png\n\n2 0.5 0.5 0.5 0.5 0 1 0 2 name with space.png\n10.5 20.25 7 11 21 -1\n"
    rows = sorted(readers.parse_model_images(spark.createDataFrame([("s", text)], "scene_id string, content string")).collect(), key=lambda r: r.image_id)
    assert [(r.image_id, r.name, len(r.points2d)) for r in rows] == [(1, "cam000frame001.png", 0), (2, "name with space.png", 2)]
    assert rows[1].points2d[1].point3d_id == -1
    points = readers.parse_model_points(spark.createDataFrame([("s", "7 1.5 -2 3.25 255 0 10 0.75 1 4 2 9"), ("s", "8 0 0 0 1 2 3 0.5"), ("s", "")], "scene_id string, value string")).collect()
    assert {r.point_id: [tuple(t) for t in r.track] for r in points} == {7: [(1, 4), (2, 9)], 8: []}


def test_samples_rise_and_stay_in_the_window(spark):
    videos = spark.createDataFrame([("s", 1, 29.97, 100), ("s", 2, 0.0, 100), ("s", 3, 25.0, 10), ("s", 4, 24.0, 500)], "scene_id string, cam_num int, fps double, total_frames long")
    w = sampling.frame_window(videos, 1, 6)
    assert sorted(r.cam_num for r in w.collect()) == [1, 4]
    for r in sampling.sample_per_second(w, 4).groupBy("cam_num", "first_frame", "end_frame").agg(F.sort_array(F.collect_list("frame")).alias("f")).collect():
        assert r.f == sorted(set(r.f)) and r.first_frame <= r.f[0] and r.f[-1] < r.end_frame


def test_selectors_and_bad_ones(spark):
    req = spark.createDataFrame([("a", "3 1-2 2"), ("b", "5:1"), ("c", "x"), ("d", "1:7:3")], "scene_id string, spec string")
    good, bad = sampling.expand_selectors(req)
    assert sorted((r.scene_id, r.place, r.frame_id) for r in good.collect()) == [("a", 0, 3), ("a", 1, 1), ("a", 2, 2), ("d", 0, 1), ("d", 1, 4), ("d", 2, 7)]
    assert sorted(r.scene_id for r in bad.collect()) == ["b", "c"]
    with pytest.raises(ValueError):
        names.filter_frames(good, 3, 2)


def test_triangulation_drops_lone_views_and_narrow_angles(spark):
    def rays(track, x, y, z, centres):
        out = []
        for c in centres:
            d = (x - c, y, z)
            n = math.sqrt(sum(v * v for v in d))
            out.append((track, float(c), 0.0, 0.0, *(v / n for v in d), 1000.0))
        return out

    df = spark.createDataFrame(rays(1, 1.0, 2.0, 5.0, (0, 1, 2)) + rays(2, 0.0, 0.0, 4.0, (0,)) + rays(3, 0.0, 0.0, 500.0, (0, 1)), "track long, cx double, cy double, cz double, dx double, dy double, dz double, f double")
    (r,) = tracks.triangulate_tracks(df).collect()
    assert (r.track, r.views) == (1, 3) and (r.x, r.y, r.z) == pytest.approx((1, 2, 5)) and r.error == pytest.approx(0, abs=1e-4)


def test_components_of_chains_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in range(100, 130)} == {100} and got[201] == 200
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_a_star_is_settled_in_two_rounds(spark, monkeypatch):
    written = []
    monkeypatch.setattr(graph, "materialize", lambda df, name: (written.append(name), materialize(df, name))[1])
    got = connected_components(spark.range(1, 1001).selectExpr("id AS src", "0L AS dst")).groupBy("component").count().collect()
    assert [tuple(r) for r in got] == [(0, 1001)]
    assert written.count("edges") <= 3  # the given ones, and those that two rounds leave over


def test_undistortion_undoes_distortion(spark):
    df = spark.createDataFrame([(0.2, -0.1, 0.05, -0.01, 0.0, 0.001, 0.002)], "x double, y double, k1 double, k2 double, k3 double, p1 double, p2 double")
    dx, dy = lens.distort(F.col("x"), F.col("y"))
    r = df.withColumns({"dx": dx, "dy": dy}).withColumn("u", lens.undistort_iterated(F.col("dx"), F.col("dy"), 20)).first()
    assert (r.u.x, r.u.y) == pytest.approx((0.2, -0.1), abs=1e-12)


def test_files_are_catalogued_in_order_of_name(spark, tmp_path):
    for n in ("b/cam001frame001.PNG", "cam002.mp4", "x.txt", "a/z.mp4", "c/cam002.mp4", "0/cam002.MP4"):
        (tmp_path / "in" / n).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / n).write_bytes(b"1")
    rows = sorted(readers.file_catalog(spark, str(tmp_path / "in"), (".png", "mp4")).collect(), key=lambda r: r.place)
    assert [r.place for r in rows] == list(range(5)) and [r.path.rsplit("/in/", 1)[1] for r in rows] == ["b/cam001frame001.PNG", "0/cam002.MP4", "c/cam002.mp4", "cam002.mp4", "a/z.mp4"]


def test_a_large_scene_is_written_by_many_tasks_in_order(spark, tmp_path):
    rows = [("s", k, f"line {k}") for k in range(-1, 5000)] + [("t", k, f"t{k}") for k in range(3)]
    random.Random(2).shuffle(rows)
    writers.write_lines(spark.createDataFrame(rows, "scene_id string, place long, line string").repartition(7), str(tmp_path / "out"), files=6)
    files = sorted((tmp_path / "out/scene_id=s").glob("part-*"))
    assert len(files) >= 5 and "".join(f.read_text() for f in files) == "".join(f"line {k}\n" for k in range(-1, 5000))
    assert "".join(f.read_text() for f in sorted((tmp_path / "out/scene_id=t").glob("part-*"))) == "t0\nt1\nt2\n"


def test_an_exchange_document_is_written_for_each_scene(spark, tmp_path):
    from xml.etree import ElementTree

    from rigprep.plans.fixtures import table

    calib = table(spark, "/root/testdata/sf0.001", "fx_calib")
    writers.write_exchange(calib, str(tmp_path / "xml"))
    values = {(r.scene_id, r.cam_idx): r for r in writers.sensor_values(calib).collect()}
    for scene in {k[0] for k in values}:
        (file,) = (tmp_path / f"xml/scene_id={scene}").glob("part-*")
        doc = ElementTree.fromstring(file.read_text())
        cams = sorted(k[1] for k in values if k[0] == scene)
        sensors, cameras = doc.find("chunk/sensors"), doc.find("chunk/cameras")
        assert doc.tag == "document" and doc.get("version") == "2.0.0" and sensors.get("next_id") == cameras.get("next_id") == str(len(cams))
        assert doc.find("chunk").attrib == {"label": "Chunk 1", "enabled": "true"}
        assert [c.get("sensor_id") for c in cameras] == [s.get("id") for s in sensors] == [str(k) for k in range(len(cams))]
        for k, (s, c) in enumerate(zip(sensors, cameras, strict=True)):
            v = values[scene, cams[k]]
            assert (s.get("label"), s.get("type"), c.get("label")) == (f"sensor_{k + 1:03d}", "frame", f"{k + 1:03d}")
            assert s.find("resolution").attrib == s.find("calibration/resolution").attrib == {"width": str(v.width), "height": str(v.height)}
            assert s.find("calibration").attrib == {"class": "adjusted", "type": "frame"}
            assert [float(s.find(f"calibration/{x}").text) for x in ("f", "cx", "cy", "k1", "k2", "k3", "p1", "p2")] == [v.f, v.cx, v.cy, v.k1, v.k2, v.k3, v.p1, v.p2]
            assert [float(x) for x in c.find("transform").text.split()] == list(v.transform)


def test_lines_of_points_have_any_white_space_and_are_made_once(spark):
    values = ["1 2.5 3 4 5 6 7 0.5 8 9 10 11", "\t2  2.5 3\t4 5 6 7 0.5 8 9 10 ", " 3 1 1 1 1 1 1 1", "4 1 1 1 1 1 1 1 8", "# 5 a", "\t# 6", " \t ", "", None]
    got = {r.point_id: [tuple(x) for x in r.track] for r in readers.parse_model_points(spark.createDataFrame([("s", v) for v in values], "scene_id string, value string")).collect()}
    assert got == {1: [(8, 9), (10, 11)], 2: [(8, 9)], 3: [], 4: []}
    for run in (QUERIES["s6_parse_model_points"], WHOLE["s6_parse_model_points_all"]):
        plan = run(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("array_join") == 1
