"""Sparse-model text, PLY, JSON, XML and layouts (K1-K9). Formatting gives lines; writing is thin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rigprep.operators.poses import flat_pose, pose_matrix


def plain(x: Column) -> Column:
    return x.cast("string")


def format_model_cameras(cameras: DataFrame) -> DataFrame:
    """K1: (scene_id, place, line): a header with the count, then a line for each camera."""
    head = cameras.groupBy("scene_id").agg(F.count(F.lit(1)).alias("n")).select("scene_id", F.lit(-1).cast("long").alias("place"), F.concat(F.lit("# Number of cameras: "), plain(F.col("n"))).alias("line"))
    body = cameras.select("scene_id", F.col("camera_id").cast("long").alias("place"), F.concat_ws(" ", plain(F.col("camera_id")), "model", plain(F.col("width")), plain(F.col("height")), F.array_join(F.transform("params", plain), " ")).alias("line"))
    return head.unionByName(body)


def format_model_images(images: DataFrame) -> DataFrame:
    """K2: a header with count and mean observations; a pose line and an observation line for each image."""
    body = _image_lines(images).select("scene_id", F.posexplode("lines").alias("k", "line"), "image_id")
    return _images_head(images).unionByName(body.select("scene_id", (F.col("image_id").cast("long") * 2 + F.col("k")).alias("place"), "line"))


def model_image_records(images: DataFrame) -> DataFrame:
    """K2 by records: (scene_id, place, record), an image's two lines in one row, so that images which share an id stay whole in any order."""
    body = _image_lines(images).select("scene_id", (F.col("image_id").cast("long") * 2).alias("place"), F.array_join("lines", "\n").alias("record"))
    return _images_head(images).withColumnRenamed("line", "record").unionByName(body)


def _images_head(images: DataFrame) -> DataFrame:
    head = images.groupBy("scene_id").agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("points2d")).alias("m"))
    return head.select("scene_id", F.lit(-1).cast("long").alias("place"), F.concat(F.lit("# Number of images: "), plain(F.col("n")), F.lit(", mean observations per image: "), F.format_string("%.6f", "m")).alias("line"))


def _image_lines(images: DataFrame) -> DataFrame:
    seven = [F.format_string("%.10f", F.get(c, F.lit(i))) for c, n in (("qvec", 4), ("tvec", 3)) for i in range(n)]
    pose = F.concat_ws(" ", plain(F.col("image_id")), *seven, plain(F.col("camera_id")), "name")
    obs = F.array_join(F.transform("points2d", lambda o: F.concat_ws(" ", plain(o["x"]), plain(o["y"]), plain(o["point3d_id"]))), " ")
    return images.select("scene_id", "image_id", F.array(pose, obs).alias("lines"))


def format_model_points(points: DataFrame, scenes: DataFrame | None = None) -> DataFrame:
    """K3: a header with count and mean track length, and a line for each point; scenes without points get the header."""
    head = points.groupBy("scene_id").agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("track")).alias("m"))
    if scenes is not None:
        head = scenes.select("scene_id").distinct().join(head, "scene_id", "left")
    head = head.select("scene_id", F.lit(-1).cast("long").alias("place"), F.concat(F.lit("# Number of points: "), plain(F.coalesce("n", F.lit(0))), F.lit(", mean track length: "), F.format_string("%.6f", F.coalesce("m", F.lit(0.0)))).alias("line"))
    track = F.array_join(F.transform("track", lambda t: F.concat_ws(" ", plain(t["image_id"]), plain(t["point2d_idx"]))), " ")
    body = F.concat_ws(" ", *[plain(F.col(c)) for c in ("point_id", "x", "y", "z", "r", "g", "b", "error")], F.nullif(track, F.lit("")))
    return head.unionByName(points.select("scene_id", F.col("point_id").alias("place"), body.alias("line")))


def format_ply(points: DataFrame) -> DataFrame:
    """K4: (scene_id, place, line) of an ASCII PLY file for each scene."""
    fields = [*(f"property float {c}" for c in "xyz"), *(f"property uchar {c}" for c in ("red", "green", "blue"))]
    n = points.groupBy("scene_id").agg(F.count(F.lit(1)).alias("n"))
    lines = F.array(F.lit("ply"), F.lit("format ascii 1.0"), F.concat(F.lit("element vertex "), plain(F.col("n"))), *map(F.lit, fields), F.lit("end_header"))
    head = n.select("scene_id", F.posexplode(lines).alias("k", "line")).select("scene_id", (F.col("k") - 10).cast("long").alias("place"), "line")
    return head.unionByName(points.select("scene_id", F.col("point_id").alias("place"), F.concat_ws(" ", *[plain(F.col(c)) for c in ("x", "y", "z", "r", "g", "b")]).alias("line")))


def write_lines(lines: DataFrame, path: str, files: int | None = None) -> None:
    """Write (scene_id, place, line) as text, in a folder for each scene.

    Lines are dealt into sorted ranges (``files`` of them, or as many as Spark deems right), so a large scene is
    many files by many tasks. Files are numbered by range: a scene's files in name order are its document.
    """
    ranges = lines.repartitionByRange(files, "scene_id", "place") if files else lines.repartitionByRange("scene_id", "place")
    ranges.sortWithinPartitions("scene_id", "place").select("scene_id", F.col("line").alias("value")).write.partitionBy("scene_id").text(path)


def assemble_transforms(cameras: DataFrame, images: DataFrame) -> DataFrame:
    """K5: transforms JSON of each scene: default intrinsics of camera 1 (or 1000 and 500) and its frames.

    cameras: scene_id, camera_id, fx, fy, cx, cy; images: scene_id, image_id, qvec, tvec, camera_id, name.
    """
    four = ("fx", "fy", "cx", "cy")
    base = cameras.where("camera_id = 1").select("scene_id", F.struct(*four).alias("base"))
    posed = pose_matrix(flat_pose(images)).join(cameras.select("scene_id", "camera_id", F.struct(*four).alias("own")), ["scene_id", "camera_id"], "left")
    row = F.struct("image_id", F.col("name").alias("file_path"), F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.slice("c2w", i * 4 + 1, 4)).alias("transform_matrix"), *[F.col(f"own.{c}").alias(c) for c in four])
    frames = posed.groupBy("scene_id").agg(F.sort_array(F.collect_list(row)).alias("frames"))
    default = {c: (1000.0 if c[0] == "f" else 500.0) for c in four}
    j = frames.join(base, "scene_id", "left").select("scene_id", *[F.coalesce(F.col(f"base.{c}"), F.lit(v)).alias(c) for c, v in default.items()], "frames")
    return j.withColumn("json", F.to_json(F.struct(*four, "frames")))


def assemble_camera_list(calib: DataFrame) -> DataFrame:
    """K6: camera-list JSON of each scene, ordered by camera."""
    row = F.struct(F.col("cam_idx").alias("id"), "img_name", "width", "height", "fx", "fy", "cx", "cy", F.array("px", "py", "pz").alias("position"), F.struct("rx", "ry", "rz").alias("rotation"))
    return calib.groupBy("scene_id").agg(F.sort_array(F.collect_list(row)).alias("cameras")).withColumn("json", F.to_json("cameras"))


def sensor_values(calib: DataFrame) -> DataFrame:
    """K7: what the exchange document says of each camera: intrinsics with the principal point from the image centre, distortion, and the 16 numbers of the camera-to-world matrix."""
    posed = pose_matrix(calib.withColumns({"tx": F.col("px"), "ty": F.col("py"), "tz": F.col("pz")}), "rodrigues")
    matrix = F.transform("c2w", lambda x: x + 0.0)
    return posed.select("scene_id", "cam_idx", "width", "height", "f", (F.col("cx") - F.col("width") / 2.0).alias("cx"), (F.col("cy") - F.col("height") / 2.0).alias("cy"), "k1", "k2", "k3", "p1", "p2", matrix.alias("transform"))


def exchange_documents(calib: DataFrame, document: str = "2.0.0", chunk: str = "Chunk 1") -> DataFrame:
    """K7: ``(scene_id, xml)``: one photogrammetry exchange document for each scene.

    A chunk has a sensor for each camera (resolution, adjusted calibration) and a camera that refers to its
    sensor and carries its transform. Ids count the scene's cameras from 0, labels from 1, in the order of cam_idx. A rig's
    cameras are one row: their number is that of real devices, as the document itself assumes.
    """
    size = F.struct(plain(F.col("width")).alias("_width"), plain(F.col("height")).alias("_height"))
    row = F.struct("cam_idx", size.alias("resolution"), *("f", "cx", "cy", "k1", "k2", "k3", "p1", "p2"), F.array_join(F.transform("transform", plain), " ").alias("transform"))
    rigs = sensor_values(calib).groupBy("scene_id").agg(F.sort_array(F.collect_list(row)).alias("c"))

    def sensor(x: Column, i: Column) -> Column:
        adjusted = F.struct(F.lit("adjusted").alias("_class"), F.lit("frame").alias("_type"), x["resolution"].alias("resolution"), *[x[c].alias(c) for c in ("f", "cx", "cy", "k1", "k2", "k3", "p1", "p2")])
        return F.struct(i.alias("_id"), F.format_string("sensor_%03d", i + 1).alias("_label"), F.lit("frame").alias("_type"), x["resolution"].alias("resolution"), adjusted.alias("calibration"))

    def camera(x: Column, i: Column) -> Column:
        return F.struct(i.alias("_id"), F.format_string("%03d", i + 1).alias("_label"), i.alias("_sensor_id"), x["transform"].alias("transform"))

    n = F.size("c").alias("_next_id")
    body = F.struct(F.lit(chunk).alias("_label"), F.lit("true").alias("_enabled"), F.struct(n, F.transform("c", sensor).alias("sensor")).alias("sensors"), F.struct(n, F.transform("c", camera).alias("camera")).alias("cameras"))
    return rigs.select("scene_id", F.to_xml(F.struct(F.lit(document).alias("_version"), body.alias("chunk")), {"rowTag": "document"}).alias("xml"))


def write_exchange(calib: DataFrame, path: str) -> None:
    """K7: a folder for each scene with its document."""
    exchange_documents(calib).select("scene_id", F.col("xml").alias("value")).write.partitionBy("scene_id").text(path)


def format_pairs(pairs: DataFrame) -> DataFrame:
    """K8: ``name0 name1`` lines."""
    return pairs.select("scene_id", F.concat_ws(" ", "image0", "image1").alias("line"))


def plan_layout(frames: DataFrame, name_col: str = "name") -> DataFrame:
    """K9: camXXXframeYYY.png goes to camXXX/; other names stay where they are."""
    cam = F.regexp_extract(name_col, r"^(cam[0-9]{3})frame[0-9]{3}\.png$", 1)
    return frames.withColumn("target", F.when(cam == "", F.col(name_col)).otherwise(F.concat(cam, F.lit("/"), F.col(name_col)))).withColumn("moved", cam != "")
