"""Queries over whole tables against brute force."""

import math
from collections import Counter

import pytest

import __spark_entry__
from rigprep.plans.fixtures import table

SF = "/root/testdata/sf0.001"


def test_every_point_is_triangulated(spark):
    key = ("scene_id", "frame_id", "point_id")
    rows = lambda df, *c: sorted(tuple(r[x] for x in (*key, *c)) for r in df.collect())
    points = table(spark, SF, "fx_points3d")
    got = rows(__spark_entry__.queries()["m11_triangulate_all"](spark, SF), "x", "y", "z", "views")
    want = sorted((r.scene_id, r.frame_id, r.point_id, r.x / 10, r.y / 10, 4 + r.z, r.track_len) for r in points.collect())
    assert len({r[:2] for r in got}) == 60 and len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[:3] == w[:3] and g[6] == w[6] and g[3:6] == pytest.approx(w[3:6], abs=1e-6)


@pytest.mark.parametrize("name", ["d3_undistort_lookup_all", "d4_remap_bilinear_all", "d4_remap_nearest_all"])
def test_every_camera_is_remapped(spark, name):
    known = __spark_entry__.queries()
    got = known[name](spark, SF).collect()
    cameras = {(r.scene_id, r.cam_idx): (r.k1, r.k2, r.p1) for r in table(spark, SF, "fx_calib").collect()}
    assert len(got) == len({(r.scene_id, r.cam_idx, r.u, r.v) for r in got}) == len(cameras) * 64 * 36
    for r in got:
        (k1, k2, p1), x, y = cameras[r.scene_id, r.cam_idx], (r.u - 32) / 73, (r.v - 18) / 73
        q = x * x + y * y
        radial = 1 + k1 * q + k2 * q * q
        su, sv = (x * radial + 2 * p1 * x * y) * 73 + 32, (y * radial + p1 * (q + 2 * y * y)) * 73 + 18
        at = lambda u, v, c=r.cam_idx: (u * 3 + v * 5 + c) % 256 if 0 <= u < 64 and 0 <= v < 36 else 0
        if name.startswith("d3"):
            assert (r.su, r.sv) == pytest.approx((su, sv), abs=1e-6)
        elif name == "d4_remap_bilinear_all":
            u, v = math.floor(su), math.floor(sv)
            a, b = su - u, sv - v
            if min(a, 1 - a, b, 1 - b) > 1e-9:
                assert r.value == pytest.approx((1 - a) * ((1 - b) * at(u, v) + b * at(u, v + 1)) + a * ((1 - b) * at(u + 1, v) + b * at(u + 1, v + 1)), abs=1e-5)
        elif min(abs(su % 1 - 0.5), abs(sv % 1 - 0.5)) > 1e-9:
            assert r.value == at(math.floor(su + 0.5), math.floor(sv + 0.5))


def test_every_camera_and_point_is_printed_and_read(spark):
    known = __spark_entry__.queries()
    points = table(spark, SF, "fx_points3d").collect()
    frames = Counter(f"{r.scene_id}/{r.frame_id}" for r in points)
    want = sorted((f"{r.scene_id}/{r.frame_id}", r.point_id, math.floor(r.x) + 0.5, r.y, math.floor(r.z) + 0.25, r.r, r.b, math.floor(r.error) + 0.5, r.track_len, (r.point_id + r.track_len * 3) % 20 + 1) for r in points)
    assert len(frames) == 60 and sorted(map(tuple, known["s6_parse_model_points_all"](spark, SF).collect())) == want
    for name, heads in (("k3_format_points_all", 1), ("k4_format_ply_all", 10)):
        rows = known[name](spark, SF).collect()
        assert Counter(r.scene_id for r in rows) == {f: n + heads for f, n in frames.items()}
        assert Counter((r.scene_id, r.place) for r in rows if r.place >= 0) == Counter(w[:2] for w in want)
    cameras = table(spark, SF, "fx_model_cameras").collect()
    lines = {(r.scene_id, r.place): r.line.split() for r in known["k1_format_cameras_all"](spark, SF).collect()}
    for r in cameras:
        got = lines.pop((r.scene_id, r.camera_id))
        assert got[1] == r.model and list(map(float, got[4:])) == r.params
    assert {k[1] for k in lines} == {-1}
