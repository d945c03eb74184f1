"""One query for each operator on the derived tables, and its DuckDB SQL (part one: frames, calibration, poses)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rigprep.operators import calib, names, poses, sampling
from rigprep.plans.fixtures import oracle, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
#: Queries over whole tables, which have no SQL.
WHOLE: dict = {}


def query(name: str, sql: str):
    """Register a function of a table getter, with its SQL over {fx_...} tables."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda t: table(spark, sf_dir, t))

        QUERIES[name], ORACLES[name] = run, oracle(sql)
        return f

    return add


def whole(name: str):
    """Register a function of a table getter that has no SQL."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda t: table(spark, sf_dir, t))

        WHOLE[name] = run
        return f

    return add


def r6(df: DataFrame, *cols: str) -> DataFrame:
    """Doubles to six places, without a negative zero."""
    return df.withColumns({c: F.round(F.col(c), 6) + 0.0 for c in cols})


def cal(t, name: str = "fx_calib") -> DataFrame:
    """fx_calib with fx and fy."""
    return t(name).withColumns({"fx": F.col("f"), "fy": F.col("f") * F.col("ar")})


CAL = "(SELECT *, f AS fx, f * ar AS fy FROM {fx_calib})"
CAM = r"coalesce(TRY_CAST(nullif(regexp_extract(file_name, '(?i)^cam0*([0-9]+)', 1), '') AS INT), TRY_CAST(nullif(regexp_extract(file_name, '^0*([0-9]+)', 1), '') AS INT))"
FRAME = r"TRY_CAST(nullif(regexp_extract(name, '(?i)frame0*([0-9]+)\.png$', 1), '') AS INT)"
FRAMES = f"(SELECT *, {FRAME} AS frame_id FROM {{fx_frames}})"
WINDOW = "(SELECT *, greatest(0, least(CAST(floor(2e0 * fps) AS BIGINT), total_frames)) AS first_frame, greatest(0, least(CAST(floor(6e0 * fps) AS BIGINT), total_frames)) AS end_frame FROM {fx_videos} WHERE fps > 0)"
WIN = f"(SELECT * FROM {WINDOW} WHERE first_frame < end_frame)"
PERSEC = f"""(SELECT scene_id, cam_num, second, CAST(b0 + floor((i + 0.5::DOUBLE) * have / k) AS BIGINT) AS frame FROM (
    SELECT *, unnest(range(0, k)) AS i FROM (SELECT *, least(4, have) AS k FROM (SELECT *, b1 - b0 AS have FROM (
    SELECT *, greatest(CAST(floor(second * fps) AS BIGINT), first_frame) AS b0, least(CAST(floor((second + 1) * fps) AS BIGINT), end_frame) AS b1 FROM (
    SELECT *, unnest(range(CAST(floor(first_frame / fps) AS BIGINT), CAST(ceil(end_frame / fps) AS BIGINT) + 1)) AS second FROM {WIN}))) WHERE have > 0)))"""


def frames(t) -> DataFrame:
    return names.with_frame_id(t("fx_frames"))


def window(t) -> DataFrame:
    return sampling.frame_window(t("fx_videos"), 2, 6)


def per_second(t) -> DataFrame:
    return sampling.sample_per_second(window(t), 4).select("scene_id", "cam_num", F.col("second").cast("long").alias("second"), F.col("frame").cast("long").alias("frame"))


@query("f1_camera_id", f"SELECT scene_id, cam_num, {CAM} AS cam_id FROM {{fx_videos}}")
def _(t):
    return names.with_camera_id(t("fx_videos")).select("scene_id", "cam_num", "cam_id")


@query("f2_frame_id", f"SELECT scene_id, cam_num, frame_id, min(name) AS name FROM {FRAMES} WHERE frame_id IS NOT NULL GROUP BY ALL")
def _(t):
    return names.first_file_per_frame(frames(t))


@query("f3_filter_cameras", "SELECT scene_id, cam_num, file_name FROM {fx_videos} WHERE cam_num BETWEEN 3 AND 11")
def _(t):
    return names.filter_cameras(t("fx_videos"), 3, 11).select("scene_id", "cam_num", "file_name")


@query("f4_filter_frames", f"SELECT scene_id, cam_num, frame_id FROM {FRAMES} WHERE frame_id BETWEEN 2 AND 6")
def _(t):
    return names.filter_frames(frames(t), 2, 6).select("scene_id", "cam_num", "frame_id")


@query("f5_frame_window", f"SELECT scene_id, cam_num, first_frame, end_frame FROM {WIN}")
def _(t):
    return window(t).select("scene_id", "cam_num", "first_frame", "end_frame")


@query("f6_audit_names", f"""SELECT scene_id, CASE WHEN c IS NULL AND f IS NULL THEN 'no camera or frame' WHEN c IS NULL THEN 'no camera' WHEN f IS NULL THEN 'no frame' ELSE 'ok' END AS reason, count(*) AS names
    FROM (SELECT scene_id, {CAM.replace('file_name', 'name')} AS c, {FRAME} AS f FROM {{fx_frames}}) GROUP BY ALL""")
def _(t):
    return names.audit_names(t("fx_frames"))


@query("f7_validate_intrinsics", "SELECT scene_id, cam_idx, CASE WHEN NOT (fx > 0 AND fy > 0) THEN 'focal length' WHEN cx < 0 OR cy < 0 THEN 'principal point' END AS issue FROM (SELECT scene_id, cam_idx, f - 7050 AS fx, f * ar AS fy, cx - 2885 AS cx, cy FROM {fx_calib})")
def _(t):
    return calib.validate_intrinsics(cal(t).withColumns({"fx": F.col("f") - 7050, "cx": F.col("cx") - 2885})).select("scene_id", "cam_idx", "issue")


@query("p1_sample_stride", f"SELECT scene_id, cam_num, unnest(range(first_frame, end_frame, CASE WHEN 10e0 < fps THEN greatest(CAST(floor(fps / 10e0) AS BIGINT), 1) ELSE 1 END)) AS frame FROM {WIN}")
def _(t):
    return sampling.sample_stride(window(t), 10).select("scene_id", "cam_num", "frame")


@query("p2_sample_per_second", f"SELECT * FROM {PERSEC}")
def _(t):
    return per_second(t)


@query("p3_cap_frames", f"SELECT scene_id, cam_num, frame FROM {PERSEC} QUALIFY row_number() OVER (PARTITION BY scene_id, cam_num ORDER BY frame) <= 5")
def _(t):
    return sampling.cap_frames(per_second(t), 5).select("scene_id", "cam_num", "frame")


@query("p4_number_frames", f"""SELECT scene_id, cam_num, frame, CAST(n AS INT) AS out_id, 'cam' || lpad(cam_num::VARCHAR, 3, '0') || '/cam' || lpad(cam_num::VARCHAR, 3, '0') || 'frame' || lpad(n::VARCHAR, 3, '0') || '.png' AS out_path
    FROM (SELECT *, row_number() OVER (PARTITION BY scene_id, cam_num ORDER BY frame) AS n FROM {PERSEC})""")
def _(t):
    return sampling.number_frames(per_second(t)).select("scene_id", "cam_num", "frame", "out_id", "out_path")


@query("p5_first_frames", """SELECT s.scene_id, CAST(s.c AS INT) AS cam_num, min(v.file_name) AS file_name, min(v.file_name) IS NULL AS missing
    FROM (SELECT scene_id, unnest(range(0, 26)) AS c FROM (SELECT DISTINCT scene_id FROM {fx_videos})) s LEFT JOIN {fx_videos} v ON v.scene_id = s.scene_id AND v.cam_num = s.c GROUP BY s.scene_id, s.c""")
def _(t):
    return sampling.first_frames(t("fx_videos"), 0, 25)


def requests(t) -> DataFrame:
    spec = F.concat(F.lit("2-4 "), (F.col("n") % 7 + 1).cast("string"), F.lit(" 1:9:3"))
    return t("fx_videos").groupBy("scene_id").agg(F.count(F.lit(1)).alias("n")).select("scene_id", spec.alias("spec"))


SPEC = "(SELECT scene_id, list_value(2, 3, 4, count(*) % 7 + 1, 1, 4, 7) AS l FROM {fx_videos} GROUP BY scene_id)"


@query("p6_expand_selectors", f"SELECT scene_id, CAST(frame_id AS INT) AS frame_id FROM (SELECT DISTINCT scene_id, unnest(l) AS frame_id FROM {SPEC})")
def _(t):
    return sampling.expand_selectors(requests(t))[0].select("scene_id", "frame_id")


@query("p6_rejected_selectors", """SELECT scene_id, spec FROM (SELECT DISTINCT scene_id FROM {fx_videos}), (VALUES ('5:1'), ('x'), ('2 0'), ('4-2 7'), ('1-3:2'), ('1:9:0')) v(spec)""")
def _(t):
    specs = F.explode(F.array(*map(F.lit, ("5:1", "1-3", "x", "2 0", "4-2 7", "9", "1-3:2", "1:9:0", "1:9:2"))))
    return sampling.expand_selectors(t("fx_videos").select("scene_id").distinct().withColumn("spec", specs))[1]


SELECTED = f"""(SELECT c.scene_id, c.cam_num, CAST(s.frame_id AS INT) AS frame_id, min(f.name) AS name FROM (SELECT DISTINCT scene_id, cam_num FROM {{fx_frames}}) c
    JOIN (SELECT DISTINCT scene_id, unnest(l) AS frame_id FROM {SPEC}) s ON c.scene_id = s.scene_id
    LEFT JOIN (SELECT *, CASE WHEN max(frame_id) OVER (PARTITION BY scene_id, cam_num) IS NULL THEN row_number() OVER (PARTITION BY scene_id, cam_num ORDER BY name) ELSE frame_id END AS k FROM {FRAMES}) f
    ON f.scene_id = c.scene_id AND f.cam_num = c.cam_num AND f.k = s.frame_id GROUP BY ALL)"""


def selected(t) -> DataFrame:
    return sampling.select_frames(frames(t), sampling.expand_selectors(requests(t))[0])


@query("p7_select_frames", f"SELECT * FROM {SELECTED}")
def _(t):
    return selected(t).select("scene_id", "cam_num", "frame_id", "name")


@query("p8_selection_report", f"""SELECT scene_id, CAST(sum(found) AS BIGINT) AS found, CAST(sum(missing) AS BIGINT) AS missing, count(*) FILTER (found = 0) AS empty_cameras
    FROM (SELECT scene_id, cam_num, count(name) AS found, count(*) - count(name) AS missing FROM {SELECTED} GROUP BY ALL) GROUP BY scene_id""")
def _(t):
    return sampling.selection_report(selected(t))


# --- calibration --------------------------------------------------------------------------


@query("c1_normalize_calibration", """SELECT scene_id, cam_idx, CASE cam_idx % 3 WHEN 0 THEN 'nested' WHEN 1 THEN 'camera_parameters' ELSE 'flat' END AS variant, width, height, f AS fx, f * ar AS fy, cx, cy, CASE cam_idx % 3 WHEN 2 THEN 0e0 ELSE k1 END AS k1 FROM {fx_calib}""")
def _(t):
    c = t("fx_calib")
    nested = F.struct("f", "ar", "cx", "cy", "k1", "k2", "k3", "p1", "p2", "width", "height")
    flat = F.struct(F.col("f").alias("fx"), (F.col("f") * F.col("ar")).alias("fy"), "cx", "cy", F.lit(None).cast("double").alias("k1"), "k2", "k3", "p1", "p2", "width", "height")
    kind = F.col("cam_idx") % 3
    c = c.select("scene_id", "cam_idx", F.when(kind == 0, nested).alias("nested"), F.when(kind == 1, nested).alias("camera_parameters"), F.when(kind == 2, flat).alias("flat"))
    return calib.normalize_calibration(c).drop("k2", "k3", "p1", "p2")


@query("c2_default_calibration", """SELECT scene_id, cam_idx, CASE WHEN cam_idx % 5 = 0 THEN 5760 ELSE width END AS width, CASE WHEN cam_idx % 5 = 0 THEN 7000e0 ELSE f END AS f, CASE WHEN cam_idx % 5 = 0 THEN 2880e0 ELSE cx END AS cx, CASE WHEN cam_idx % 5 = 0 OR cam_idx % 7 = 0 THEN 0e0 ELSE k1 END AS k1, cam_idx % 5 = 0 AS is_default FROM {fx_calib}""")
def _(t):
    c = t("fx_calib").withColumns({"f": F.when(F.col("cam_idx") % 5 != 0, F.col("f")), "k1": F.when(F.col("cam_idx") % 7 != 0, F.col("k1"))})
    return calib.default_calibration(c).select("scene_id", "cam_idx", "width", "f", "cx", "k1", "is_default")


@query("c3_align_by_ordinal", """SELECT c.scene_id, c.cam_idx, i.name FROM (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY cam_idx) AS o FROM {fx_calib}) c
    JOIN (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY name) AS o FROM {fx_model_images}) i ON c.scene_id = i.scene_id AND c.o = i.o""")
def _(t):
    return calib.align_by_ordinal(t("fx_calib"), t("fx_model_images")).select("scene_id", "cam_idx", "name")


@query("c3_align_broadcast", """SELECT i.scene_id, c.cam_idx, i.name FROM (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY name) AS o, count(*) OVER (PARTITION BY scene_id) AS ni FROM {fx_model_images}) i
    JOIN (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY cam_idx) AS o, count(*) OVER (PARTITION BY scene_id) AS nc FROM {fx_calib}) c ON c.scene_id = i.scene_id AND c.o = CASE WHEN nc = ni THEN i.o ELSE 1 END""")
def _(t):
    return calib.align_by_ordinal(t("fx_calib"), t("fx_model_images"), "broadcast").select("scene_id", "cam_idx", "name")


@query("c3_align_number", "SELECT scene_id, cam_idx, lpad((row_number() OVER (PARTITION BY scene_id ORDER BY cam_idx))::VARCHAR, 3, '0') || '.png' AS name FROM {fx_calib}")
def _(t):
    return calib.align_by_ordinal(t("fx_calib"), t("fx_model_images"), "number").select("scene_id", "cam_idx", "name")


@query("c4_verify_dimensions", """SELECT c.scene_id, c.cam_idx, coalesce(actual_width, width) AS use_width, coalesce(actual_height, height) AS use_height, actual_width IS NOT NULL AND (actual_width <> width OR actual_height <> height) AS mismatch
    FROM {fx_calib} c LEFT JOIN {fx_image_meta} m ON m.scene_id = c.scene_id AND m.name = c.img_name""")
def _(t):
    return calib.verify_dimensions(t("fx_calib"), t("fx_image_meta")).select("scene_id", "cam_idx", "use_width", "use_height", "mismatch")


@query("c5_model_to_intrinsics", """SELECT scene_id, camera_id, CASE WHEN model <> 'FOV' THEN params[1] END AS fx, CASE WHEN model IN ('PINHOLE', 'OPENCV') THEN params[2] WHEN model <> 'FOV' THEN params[1] END AS fy,
    CASE WHEN model IN ('PINHOLE', 'OPENCV') THEN params[3] WHEN model <> 'FOV' THEN params[2] END AS cx, CASE WHEN model IN ('PINHOLE', 'OPENCV') THEN params[4] WHEN model <> 'FOV' THEN params[3] END AS cy,
    CASE model WHEN 'SIMPLE_RADIAL' THEN params[4] WHEN 'RADIAL' THEN params[4] WHEN 'OPENCV' THEN params[5] ELSE 0e0 END AS k1, CASE model WHEN 'RADIAL' THEN params[5] WHEN 'OPENCV' THEN params[6] ELSE 0e0 END AS k2, model <> 'FOV' AS supported FROM {fx_model_cameras}""")
def _(t):
    return calib.model_to_intrinsics(t("fx_model_cameras")).select("scene_id", "camera_id", "fx", "fy", "cx", "cy", "k1", "k2", "supported")


@query("c6_to_pinhole", """SELECT scene_id, camera_id, CASE model WHEN 'SIMPLE_RADIAL' THEN 'PINHOLE' ELSE model END AS model, CASE model WHEN 'SIMPLE_RADIAL' THEN params[1] ELSE params[2] END AS second, CAST(len(params) AS INT) AS n FROM {fx_model_cameras}""")
def _(t):
    return calib.to_pinhole(t("fx_model_cameras")).select("scene_id", "camera_id", "model", F.get("params", F.lit(1)).alias("second"), F.size("params").alias("n"))


@query("c6_pinhole_report", "SELECT scene_id, count(*) AS cameras, count(*) FILTER (model NOT IN ('PINHOLE', 'SIMPLE_RADIAL')) AS others, bool_and(model IN ('PINHOLE', 'SIMPLE_RADIAL')) AS all_pinhole FROM {fx_model_cameras} GROUP BY scene_id")
def _(t):
    return calib.pinhole_report(calib.to_pinhole(t("fx_model_cameras")))


@query("c7_scale_intrinsics", f"SELECT scene_id, cam_idx, round(fx * 1920 / width * 0.5::DOUBLE, 6) AS fx, round(fy * 1080 / height * 0.5::DOUBLE, 6) AS fy, round(cx * 1920 / width * 0.5::DOUBLE, 6) AS cx, round(cy * 1080 / height * 0.5::DOUBLE, 6) AS cy FROM {CAL}")
def _(t):
    return r6(calib.scale_intrinsics(cal(t), F.lit(1920), F.lit(1080), 0.5).select("scene_id", "cam_idx", "fx", "fy", "cx", "cy"), "fx", "fy", "cx", "cy")


@query("c7_pyramid", f"SELECT scene_id, cam_idx, CAST(l AS INT) AS level, CAST(width // l AS INT) AS width, CAST(height // l AS INT) AS height, round(fx / l, 6) AS fx, round(cy / l, 6) AS cy FROM (SELECT *, unnest([2, 4, 8]) AS l FROM {CAL})")
def _(t):
    return r6(calib.pyramid(cal(t)).select("scene_id", "cam_idx", "level", "width", "height", "fx", "cy"), "fx", "cy")


@query("c8_unify_intrinsics", f"SELECT scene_id, cam_idx, round(avg(fx) OVER w, 6) AS fx, round(avg(fy) OVER w, 6) AS fy, round(avg(cx) OVER w, 6) AS cx, round(avg(cy) OVER w, 6) AS cy FROM {CAL} WINDOW w AS (PARTITION BY scene_id)")
def _(t):
    return r6(calib.unify_intrinsics(cal(t)).select("scene_id", "cam_idx", "fx", "fy", "cx", "cy"), "fx", "fy", "cx", "cy")


def _dist(x: str, y: str, axis: str) -> str:
    r2 = f"({x} * {x} + {y} * {y})"
    radial = f"(1 + {r2} * (k1 + {r2} * (k2 + {r2} * k3)))"
    return f"({x} * {radial} + 2 * p1 * {x} * {y} + p2 * ({r2} + 2 * {x} * {x}))" if axis == "x" else f"({y} * {radial} + p1 * ({r2} + 2 * {y} * {y}) + 2 * p2 * {x} * {y})"


CORNER = f"""(SELECT scene_id, cam_idx, max(abs({_dist('x', 'y', 'x')})) AS mx, max(abs({_dist('x', 'y', 'y')})) AS my FROM (
    SELECT *, ((width - 1) * a - cx) / fx AS x, ((height - 1) * b - cy) / fy AS y FROM {CAL}, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(a, b)) GROUP BY ALL)"""


@query("c9_corner_intrinsics", f"SELECT c.scene_id, c.cam_idx, round(width / 2e0 / mx, 6) AS new_fx, round(height / 2e0 / my, 6) AS new_fy, width / 2e0 AS new_cx, height / 2e0 AS new_cy FROM {{fx_calib}} c JOIN {CORNER} m ON c.scene_id = m.scene_id AND c.cam_idx = m.cam_idx")
def _(t):
    return r6(calib.corner_intrinsics(cal(t)).select("scene_id", "cam_idx", "new_fx", "new_fy", "new_cx", "new_cy"), "new_fx", "new_fy")


UNDIST = f"""list_reduce(list_prepend({{'x': x0, 'y': y0}}, [{{'x': 0e0, 'y': 0e0}} for i in range({{n}})]), lambda s, i: {{'x': s.x - ({_dist('s.x', 's.y', 'x')} - x0), 'y': s.y - ({_dist('s.x', 's.y', 'y')} - y0)}})"""


def border_sql(alpha: str) -> str:
    """Rectangles of undistorted borders, intrinsics between them, and the region of whole pixels."""
    agg = ", ".join(f"{f}(s.{c}) FILTER (e = '{e}' AND i % 16 = 0) AS {n}, {f}(s.{c}) FILTER (e = '{e}') AS r{n}" for n, e, c, f in (("xa", "l", "x", "max"), ("xb", "r", "x", "min"), ("ya", "t", "y", "max"), ("yb", "b", "y", "min")))
    outer = ", ".join(f"{f}(s.{c}) FILTER (i % 16 = 0) AS o{c}{n}" for c in "xy" for n, f in (("a", "min"), ("b", "max")))
    new = ", ".join(f"({s} - 1e0) / ({c}b - {c}a) * (1 - {alpha}) + ({s} - 1e0) / (o{c}b - o{c}a) * {alpha} AS nf{c}, -({s} - 1e0) / ({c}b - {c}a) * {c}a * (1 - {alpha}) - ({s} - 1e0) / (o{c}b - o{c}a) * o{c}a * {alpha} AS nc{c}" for c, s in (("x", "width"), ("y", "height")))
    roi = ", ".join(f"CAST(greatest(ceil(r{c}a * nf{c} + nc{c} - 1e-6), 0) AS INT) AS roi_{c}, CAST(least(floor(r{c}b * nf{c} + nc{c} + 1e-6), {s} - 1) - greatest(ceil(r{c}a * nf{c} + nc{c} - 1e-6), 0) + 1 AS INT) AS roi_{s[0]}" for c, s in (("x", "width"), ("y", "height")))
    return f"""SELECT scene_id, cam_idx, round(nfx, 6) AS new_fx, round(nfy, 6) AS new_fy, round(ncx, 6) AS new_cx, round(ncy, 6) AS new_cy, roi_x, roi_y, roi_w, roi_h, round(ncx - roi_x, 6) AS crop_cx, round(ncy - roi_y, 6) AS crop_cy FROM (SELECT *, {roi} FROM (SELECT *, {new} FROM (
      SELECT scene_id, cam_idx, any_value(width) AS width, any_value(height) AS height, {agg}, {outer} FROM (SELECT *, {UNDIST.replace('{n}', '20')} AS s FROM (
        SELECT *, (CASE e WHEN 'l' THEN 0e0 WHEN 'r' THEN width - 1e0 ELSE i / 128e0 * (width - 1e0) END - cx) / fx AS x0, (CASE e WHEN 't' THEN 0e0 WHEN 'b' THEN height - 1e0 ELSE i / 128e0 * (height - 1e0) END - cy) / fy AS y0
        FROM {CAL}, range(0, 129) r(i), (VALUES ('l'), ('r'), ('t'), ('b')) v(e))) GROUP BY scene_id, cam_idx)))"""


def inner_rect(t, alpha: float) -> DataFrame:
    found = calib.inner_rect_intrinsics(cal(t), alpha=alpha)
    new = ("new_fx", "new_fy", "new_cx", "new_cy")
    cut = calib.crop_intrinsics(found.withColumn("whole", F.struct(*new))).withColumns({"crop_cx": F.col("new_cx"), "crop_cy": F.col("new_cy")} | {c: F.col(f"whole.{c}") for c in new})
    return r6(cut.select("scene_id", "cam_idx", *new, "roi_x", "roi_y", "roi_w", "roi_h", "crop_cx", "crop_cy"), *new, "crop_cx", "crop_cy")


@query("c10_inner_rect", border_sql("0e0"))
def _(t):
    return inner_rect(t, 0.0)


@query("c10_inner_rect_half", border_sql("0.5e0"))
def _(t):
    return inner_rect(t, 0.5)


CHANGE = f"""(SELECT c.*, abs(width / 2e0 / mx - fx) / fx * 100 AS d_fx, abs(height / 2e0 / my - fy) / fy * 100 AS d_fy, abs(k1) + abs(k2) AS severity FROM {CAL} c JOIN {CORNER} m ON c.scene_id = m.scene_id AND c.cam_idx = m.cam_idx)"""
GRADE = "CASE WHEN greatest(d_fx, d_fy) < 1 THEN 'EXCELLENT' WHEN greatest(d_fx, d_fy) < 3 THEN 'GOOD' WHEN greatest(d_fx, d_fy) < 8 THEN 'ACCEPTABLE' ELSE 'POOR' END"


def quality(t) -> DataFrame:
    return calib.undistortion_quality(calib.corner_intrinsics(cal(t)))


@query("c11_undistortion_quality", f"SELECT scene_id, cam_idx, round(d_fx, 6) AS d_fx, round(d_fy, 6) AS d_fy, severity, {GRADE} AS grade, greatest(d_fx, d_fy) > 5 AS warn FROM {CHANGE}")
def _(t):
    return r6(quality(t).select("scene_id", "cam_idx", "d_fx", "d_fy", "severity", "grade", "warn"), "d_fx", "d_fy")


@query("c12_quality_distribution", f"SELECT grade, count(*) AS cameras, count(*) FILTER (grade = 'POOR') AS poor FROM (SELECT {GRADE} AS grade FROM {CHANGE}) GROUP BY grade")
def _(t):
    return calib.quality_distribution(quality(t)).select("grade", "cameras", F.size("poor").cast("long").alias("poor"))


@query("c13_rewrite_calibration", f"""SELECT c.scene_id, c.cam_idx, coalesce(n.fx, g.fx) AS f, round(coalesce(n.fy, g.fy) / coalesce(n.fx, g.fx), 6) AS ar, coalesce(n.cx, g.cx) AS cx, 0e0 AS k1, c.rx FROM {{fx_calib}} c
    LEFT JOIN (SELECT * FROM {CAL} WHERE cam_idx % 3 = 0) n ON n.scene_id = c.scene_id AND n.img_name = c.img_name
    LEFT JOIN (SELECT * FROM {CAL} WHERE cam_idx % 3 = 0 QUALIFY row_number() OVER (PARTITION BY scene_id ORDER BY img_name) = 1) g ON g.scene_id = c.scene_id""")
def _(t):
    """Rows of one image tie in the SQL's order, where DuckDB takes the first of the table."""
    new = cal(t, "fx_calib_keyed").where("cam_idx % 3 = 0").select("scene_id", "img_name", "fx", "fy", "cx", "cy", "s_suppkey")
    return r6(calib.rewrite_calibration(t("fx_calib"), new, ("s_suppkey",)).select("scene_id", "cam_idx", "f", "ar", "cx", "k1", "rx"), "ar")


@query("c14_intrinsics_ranges", f"SELECT scene_id, count(*) AS cameras, min(fx) AS min_fx, max(fx) AS max_fx, round(min(fy), 6) AS min_fy, round(max(fy), 6) AS max_fy FROM {CAL} GROUP BY scene_id")
def _(t):
    return r6(calib.intrinsics_ranges(cal(t)), "min_fy", "max_fy")


# --- poses --------------------------------------------------------------------------------

POSE = "(SELECT *, qvec[1] AS w, qvec[2] AS x, qvec[3] AS y, qvec[4] AS z FROM {fx_model_images})"
MAT = f"""(SELECT *, 1 - 2 * (y * y + z * z) AS m0, 2 * (x * y - z * w) AS m1, 2 * (x * z + y * w) AS m2, 2 * (x * y + z * w) AS m3, 1 - 2 * (x * x + z * z) AS m4, 2 * (y * z - x * w) AS m5,
    2 * (x * z - y * w) AS m6, 2 * (y * z + x * w) AS m7, 1 - 2 * (x * x + y * y) AS m8 FROM {POSE})"""
INV = f"(SELECT *, -(m0 * tvec[1] + m3 * tvec[2] + m6 * tvec[3]) AS ix, -(m1 * tvec[1] + m4 * tvec[2] + m7 * tvec[3]) AS iy, -(m2 * tvec[1] + m5 * tvec[2] + m8 * tvec[3]) AS iz FROM {MAT})"


def posed(t) -> DataFrame:
    return poses.flat_pose(t("fx_model_images"))


@query("c15_calibration_from_model", f"""SELECT i.scene_id, i.image_id, TRY_CAST(regexp_extract(name, 'cam([0-9]+)', 1) AS INT) AS cam_id, params[1] AS fx, round(ix, 6) + 0e0 AS out_px, round(iy, 6) + 0e0 AS out_py, round(iz, 6) + 0e0 AS out_pz
    FROM {INV} i JOIN {{fx_model_cameras}} c ON c.scene_id = i.scene_id AND c.camera_id = i.camera_id WHERE model <> 'FOV'""")
def _(t):
    return r6(calib.calibration_from_model(t("fx_model_cameras"), t("fx_model_images"))[0].select("scene_id", "image_id", "cam_id", "fx", "out_px", "out_py", "out_pz"), "out_px", "out_py", "out_pz")


@query("c15_images_without_camera", "SELECT scene_id, image_id, name FROM {fx_model_images} WHERE camera_id % 7 = 3")
def _(t):
    return calib.calibration_from_model(t("fx_model_cameras").where("camera_id % 7 <> 3"), t("fx_model_images"))[1].select("scene_id", "image_id", "name")


@query("r1_detect_pose_format", "SELECT scene_id, cam_idx, CASE cam_idx % 4 WHEN 0 THEN 'c2w' WHEN 1 THEN 'tcw' WHEN 2 THEN 'w2c' ELSE 'c2w' END AS pose_format FROM {fx_calib}")
def _(t):
    k = F.col("cam_idx") % 4
    m = F.array(*[F.lit(float(v)) for v in (2, 0, 0, 1, 0, 1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1)])
    c = t("fx_calib").withColumns(
        {"position": F.when(k == 0, F.array("px", "py", "pz")), "rotation": F.when(k == 0, F.struct("rx", "ry", "rz")), "extrinsic": F.when(k == 1, m), "quaternion": F.when(k == 2, F.array(*[F.lit(1.0)] * 4)), "r": F.lit(None).cast("array<double>"), "t": F.lit(None).cast("array<double>")}
    )
    return poses.detect_pose_format(c).select("scene_id", "cam_idx", "pose_format")


@query("r2_to_camera_to_world", f"""SELECT scene_id, image_id, round(ix, 6) + 0e0 AS out_px, round(iz, 6) + 0e0 AS out_pz, round(-sin(asin(greatest(-1, least(1, m2)))), 6) + 0e0 AS sin_ry, TRUE AS valid FROM {INV}""")
def _(t):
    out = poses.to_camera_to_world(posed(t), "quaternion", "w2c").withColumn("sin_ry", F.sin("out_ry"))
    return r6(out.select("scene_id", "image_id", "out_px", "out_pz", "sin_ry", "valid"), "out_px", "out_pz", "sin_ry")


@query("r3_invert_pose", f"SELECT scene_id, image_id, round(m3, 6) + 0e0 AS inv1, round(ix, 6) + 0e0 AS ix, round(iy, 6) + 0e0 AS iy, round(iz, 6) + 0e0 AS iz FROM {INV}")
def _(t):
    return r6(poses.invert_pose(posed(t)).select("scene_id", "image_id", F.get("inv_m", F.lit(1)).alias("inv1"), "ix", "iy", "iz"), "inv1", "ix", "iy", "iz")


@query("r4_convert_rotation", """SELECT scene_id, cam_idx, round(s * (cx * cy * cz + sx * sy * sz), 6) + 0e0 AS qw, round(s * (sx * cy * cz - cx * sy * sz), 6) + 0e0 AS qx, round(s * (cx * sy * cz + sx * cy * sz), 6) + 0e0 AS qy, round(s * (cx * cy * sz - sx * sy * cz), 6) + 0e0 AS qz
    FROM (SELECT *, CASE WHEN cx * cy * cz + sx * sy * sz < 0 THEN -1 ELSE 1 END AS s FROM (SELECT scene_id, cam_idx, cos(rx / 2) AS cx, sin(rx / 2) AS sx, cos(ry / 2) AS cy, sin(ry / 2) AS sy, cos(rz / 2) AS cz, sin(rz / 2) AS sz FROM {fx_calib}))""")
def _(t):
    return r6(poses.convert_rotation(t("fx_calib"), "euler_zyx", "quaternion").select("scene_id", "cam_idx", "qw", "qx", "qy", "qz"), "qw", "qx", "qy", "qz")


@query("r4_rodrigues", """SELECT scene_id, cam_idx, round(CASE WHEN t < 1e-10 THEN 1 ELSE cos(t / 2) END, 6) + 0e0 AS qw, round(CASE WHEN t < 1e-10 THEN 0 ELSE rx / t * sin(t / 2) END, 6) + 0e0 AS qx FROM (SELECT *, sqrt(rx * rx + ry * ry + rz * rz) AS t FROM {fx_calib})""")
def _(t):
    return r6(poses.convert_rotation(t("fx_calib"), "rodrigues", "quaternion").select("scene_id", "cam_idx", "qw", "qx"), "qw", "qx")


@query("r5_check_quaternions", "SELECT scene_id, image_id, round(n, 6) AS norm, abs(n - 1) < 1e-6 AS is_unit, round(w / n, 6) + 0e0 AS n_qw FROM (SELECT *, sqrt(w * w + x * x + y * y + z * z) AS n FROM (SELECT scene_id, image_id, qvec[1] + 0.5 AS w, qvec[2] AS x, qvec[3] AS y, qvec[4] AS z FROM {fx_model_images}))")
def _(t):
    return r6(poses.check_quaternions(posed(t).withColumn("qw", F.col("qw") + 0.5)).select("scene_id", "image_id", "norm", "is_unit", "n_qw"), "norm", "n_qw")


@query("r6_pose_matrix", f"SELECT scene_id, image_id, round(m0, 6) + 0e0 AS a, round(m3, 6) + 0e0 AS b, round(ix, 6) + 0e0 AS c, round(m1, 6) + 0e0 AS d, 1e0 AS e FROM {INV}")
def _(t):
    m = poses.pose_matrix(posed(t))
    return r6(m.select("scene_id", "image_id", *[F.get("c2w", F.lit(i)).alias(c) for c, i in zip("abcde", (0, 1, 3, 4, 15), strict=True)]), *"abcde")


@query("r7_expand_poses", """SELECT f.scene_id, f.cam_num, f.name, i.image_id, CAST(row_number() OVER (PARTITION BY f.scene_id ORDER BY f.cam_dir, f.name) AS INT) AS new_image_id FROM {fx_frames} f JOIN {fx_model_images} i ON f.scene_id = i.scene_id AND f.cam_num = i.image_id - 1""")
def _(t):
    images = t("fx_model_images").select("scene_id", (F.col("image_id") - 1).alias("cam_num"), "image_id", "qvec", "tvec")
    return poses.expand_poses(images, t("fx_frames")).select("scene_id", "cam_num", "name", "image_id", "new_image_id")


@query("r8_pose_only_model", "SELECT scene_id, image_id, camera_id, name, 0 AS points FROM {fx_model_images}")
def _(t):
    return poses.pose_only_model(t("fx_model_images")).select("scene_id", "image_id", "camera_id", "name", F.size("points2d").alias("points"))
