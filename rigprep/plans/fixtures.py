"""Capture tables derived from the star schema, one text for both engines.

Four macros cover the dialects: DIV_ (integer division), ARRAY_ (array constructor), EXPLODE_
(one row for each integer of a range) and D0, D1, D5, D8 (doubles).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from rigprep.functions.shared import dealt

TABLES = {
    "fx_videos": """
SELECT concat('s', lpad(CAST(s_suppkey DIV_ 20 AS STRING), 3, '0')) AS scene_id,
       CAST(s_suppkey % 20 AS INT) AS cam_num,
       CASE s_suppkey % 4 WHEN 0 THEN concat('cam', lpad(CAST(s_suppkey % 20 AS STRING), 2, '0'), '.mp4')
                          WHEN 1 THEN concat('cam', lpad(CAST(s_suppkey % 20 AS STRING), 3, '0'), '.mp4')
                          WHEN 2 THEN concat(lpad(CAST(s_suppkey % 20 AS STRING), 3, '0'), '.mp4')
                          ELSE concat(CASE WHEN s_suppkey % 40 = 39 THEN 'take' ELSE 'cam' END, CAST(s_suppkey % 20 AS STRING), '.mp4') END AS file_name,
       CASE s_suppkey % 6 WHEN 0 THEN CAST(23.976 AS DOUBLE) WHEN 1 THEN CAST(24 AS DOUBLE) WHEN 2 THEN CAST(25 AS DOUBLE)
                          WHEN 3 THEN CAST(29.97 AS DOUBLE) WHEN 4 THEN CAST(60 AS DOUBLE) ELSE CAST(30 AS DOUBLE) END AS fps,
       CAST(100 + (s_suppkey * 37) % 400 AS BIGINT) AS total_frames
FROM {supplier}""",
    "fx_frames": """
SELECT scene_id, cam_num, CAST(fr AS INT) AS ordinal,
       concat('cam', lpad(CAST(cam_num AS STRING), 3, '0')) AS cam_dir,
       CASE WHEN cam_num = 19 THEN concat('img_', lpad(CAST(fr AS STRING), 4, '0'), '.png')
            ELSE concat('cam', lpad(CAST(cam_num AS STRING), 3, '0'), 'frame', lpad(CAST(fr AS STRING), 3, '0'), '.png') END AS name
FROM (SELECT scene_id, cam_num, EXPLODE_(1, 10 + cam_num % 3) AS fr FROM {fx_videos}) t
WHERE NOT (cam_num = 7 AND fr % 5 = 0)""",
    "fx_calib": """
SELECT concat('s', lpad(CAST(s_suppkey DIV_ 20 AS STRING), 3, '0')) AS scene_id,
       CAST(s_suppkey % 20 AS INT) AS cam_idx,
       concat('cam', lpad(CAST(s_suppkey % 20 AS STRING), 3, '0'), 'frame001.png') AS img_name,
       5760 AS width, 3240 AS height,
       CAST(7000 + s_suppkey % 97 AS DOUBLE) AS f, CAST(1 AS DOUBLE) + CAST(s_suppkey % 7 AS DOUBLE) / CAST(1024 AS DOUBLE) AS ar,
       CAST(2880 + s_suppkey % 13 AS DOUBLE) AS cx, CAST(1620 - s_suppkey % 11 AS DOUBLE) AS cy,
       CAST(s_suppkey % 9 - 4 AS DOUBLE) / CAST(64 AS DOUBLE) AS k1, CAST(s_suppkey % 5 - 2 AS DOUBLE) / CAST(256 AS DOUBLE) AS k2,
       CAST(0 AS DOUBLE) AS k3, CAST(s_suppkey % 3 - 1 AS DOUBLE) / CAST(256 AS DOUBLE) AS p1, CAST(0 AS DOUBLE) AS p2,
       CAST(s_suppkey * 31 % 200 - 100 AS DOUBLE) / CAST(128 AS DOUBLE) AS rx, CAST(s_suppkey * 17 % 180 - 90 AS DOUBLE) / CAST(128 AS DOUBLE) AS ry,
       CAST(s_suppkey * 53 % 300 - 150 AS DOUBLE) / CAST(128 AS DOUBLE) AS rz,
       s_acctbal / CAST(1000 AS DOUBLE) AS px, CAST(s_nationkey AS DOUBLE) AS py, CAST(s_suppkey % 29 AS DOUBLE) / CAST(4 AS DOUBLE) AS pz
FROM {supplier}""",
    "fx_model_cameras": """
SELECT scene_id, cam_idx + 1 AS camera_id,
       CASE cam_idx % 6 WHEN 0 THEN 'SIMPLE_PINHOLE' WHEN 1 THEN 'PINHOLE' WHEN 2 THEN 'SIMPLE_RADIAL' WHEN 3 THEN 'RADIAL' WHEN 4 THEN 'OPENCV' ELSE 'FOV' END AS model,
       width, height,
       CASE cam_idx % 6 WHEN 0 THEN ARRAY_(f, cx, cy) WHEN 1 THEN ARRAY_(f, f * ar, cx, cy) WHEN 2 THEN ARRAY_(f, cx, cy, k1)
            WHEN 3 THEN ARRAY_(f, cx, cy, k1, k2) WHEN 4 THEN ARRAY_(f, f * ar, cx, cy, k1, k2, p1, p2) ELSE ARRAY_(f, f * ar, cx, cy, k1) END AS params
FROM {fx_calib}""",
    "fx_model_images": """
SELECT scene_id, cam_idx + 1 AS image_id,
       CASE cam_idx % 4 WHEN 0 THEN ARRAY_(D1, D0, D0, D0) WHEN 1 THEN ARRAY_(D5, D5, D5, D5) WHEN 2 THEN ARRAY_(D0, D1, D0, D0) ELSE ARRAY_(D5, -D5, D5, -D5) END AS qvec,
       ARRAY_(CAST(cam_idx * 3 - 20 AS DOUBLE) / D8, CAST(cam_idx AS DOUBLE), CAST(cam_idx % 7 AS DOUBLE) / D8) AS tvec,
       cam_idx + 1 AS camera_id, img_name AS name
FROM {fx_calib} WHERE cam_idx <> 13""",
    "fx_points3d": """
SELECT concat('s', lpad(CAST(l_orderkey % 5 AS STRING), 3, '0')) AS scene_id,
       CAST(l_partkey % 12 + 1 AS INT) AS frame_id,
       (l_orderkey * 1000000 + l_partkey) * 1000 + l_suppkey * 8 + l_linenumber AS point_id,
       l_extendedprice / CAST(1000 AS DOUBLE) AS x, l_quantity AS y, l_discount * CAST(100 AS DOUBLE) AS z,
       CAST(l_partkey % 256 AS INT) AS r, CAST(l_suppkey % 256 AS INT) AS g, CAST(l_orderkey % 7 AS INT) AS b,
       l_tax * CAST(50 AS DOUBLE) AS error, CAST(2 + (l_orderkey + l_linenumber) % 5 AS INT) AS track_len
FROM {lineitem}""",
    "fx_observations": """
SELECT scene_id, frame_id, point_id, CAST((point_id + i * 3) % 20 + 1 AS INT) AS image_id, CAST(i AS INT) AS point2d_idx
FROM (SELECT scene_id, frame_id, point_id, EXPLODE_(1, track_len) AS i FROM {fx_points3d}) t""",
    "fx_features": """
SELECT 's000' AS scene_id, concat('cam', lpad(CAST(vec_id % 10 AS STRING), 3, '0'), 'frame001.png') AS image,
       CAST(vec_id DIV_ 10 AS INT) AS kp_idx, CAST(vec_id * 7919 % 5760 AS DOUBLE) AS x, CAST(vec_id * 104729 % 3240 AS DOUBLE) AS y,
       embedding AS descriptor
FROM {embeddings}""",
    "fx_dense_matches": """
SELECT scene_id, a AS image0, b AS image1, CAST(k AS INT) AS kp0,
       CASE WHEN (k + ia + ib) % 3 = 0 THEN -1 ELSE CAST((k * 7 + ia + ib) % 50 AS INT) END AS kp1, CAST(k AS DOUBLE) / CAST(64 AS DOUBLE) AS score
FROM (SELECT x.scene_id, x.name AS a, y.name AS b, x.image_id AS ia, y.image_id AS ib, EXPLODE_(0, 49) AS k
      FROM {fx_model_images} x JOIN {fx_model_images} y ON x.scene_id = y.scene_id AND x.image_id < y.image_id) t""",
    "fx_image_meta": """
SELECT scene_id, img_name AS name, CASE WHEN cam_idx % 10 = 3 THEN 2880 ELSE width END AS actual_width,
       CASE WHEN cam_idx % 10 = 3 THEN 1620 ELSE height END AS actual_height
FROM {fx_calib} WHERE cam_idx <> 5""",
    "fx_pixels_all": """
SELECT scene_id, cam_idx, CAST(u AS INT) AS u, CAST(v AS INT) AS v, CAST((u * 3 + v * 5 + cam_idx) % 256 AS DOUBLE) AS value
FROM (SELECT scene_id, cam_idx, u, EXPLODE_(0, 35) AS v
      FROM (SELECT scene_id, cam_idx, EXPLODE_(0, 63) AS u FROM {fx_calib}) t1) t2""",
    "fx_runs": """
SELECT concat('s', lpad(CAST(s_suppkey DIV_ 20 AS STRING), 3, '0')) AS scene_id,
       CASE s_suppkey % 2 WHEN 0 THEN 'sift' ELSE 'superpoint' END AS extractor,
       CASE s_suppkey % 3 WHEN 0 THEN 'nn-mutual' WHEN 1 THEN 'nn-ratio' ELSE 'graph' END AS matcher,
       CAST(s_suppkey AS INT) AS run_id, s_acctbal > 0 AS succeeded, CAST(s_suppkey * 911 % 20000 AS INT) AS points, CAST(s_suppkey % 37 AS INT) AS registered_images
FROM {supplier}""",
}

#: Calibrations with their supplier: the order of the rows, which ties go by. No SQL reads it.
TABLES["fx_calib_keyed"] = TABLES["fx_calib"].replace("SELECT ", "SELECT s_suppkey, ", 1)


def _needs(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", sql)))


def dialect(sql: str, duck: bool) -> str:
    for d, x in (("D0", "0"), ("D1", "1"), ("D5", "0.5"), ("D8", "8")):
        sql = re.sub(rf"\b{d}\b", f"CAST({x} AS DOUBLE)", sql)
    if duck:
        sql = sql.replace("DIV_", "//").replace("ARRAY_(", "list_value(")
        return re.sub(r"EXPLODE_\(((?:[^(),]|\([^()]*\))*), *((?:[^(),]|\([^()]*\))*)\)", r"unnest(range(\1, \2 + 1))", sql)
    return re.sub(r"EXPLODE_\(((?:[^(),]|\([^()]*\))*), *((?:[^(),]|\([^()]*\))*)\)", r"explode(sequence(\1, \2))", sql.replace("DIV_", "DIV").replace("ARRAY_(", "array("))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived or raw table; suppliers, each of which becomes thousands of rows, are dealt out to tasks first."""
    if name not in TABLES:
        raw = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        return raw.repartition(dealt(spark)) if name == "supplier" else raw
    sql = TABLES[name]
    return spark.sql(dialect(sql, duck=False), **{n: table(spark, sf_dir, n) for n in _needs(sql)})


def oracle(sql: str) -> str:
    """DuckDB SQL whose {fx_...} tables become common table expressions."""
    order: list[str] = []

    def add(name: str) -> None:
        if name in TABLES and name not in order:
            for n in _needs(TABLES[name]):
                add(n)
            order.append(name)

    for n in _needs(sql):
        add(n)
    plain = lambda s: re.sub(r"\{(\w+)\}", r"\1", s)
    ctes = ",\n".join(f"{n} AS ({plain(dialect(TABLES[n], duck=True))})" for n in order)
    sql = plain(dialect(sql, duck=True)).strip()
    if not ctes:
        return sql
    return f"WITH {ctes},\n{sql[5:]}" if sql.upper().startswith("WITH ") else f"WITH {ctes}\n{sql}"
