"""File catalogue, calibration JSON and sparse-model text.

Parsers take tables of text, (scene_id, content) for whole files or (scene_id, value) for lines,
so that the thin readers below and tests share them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rigprep.functions.order import with_rank

#: Camera models and how many parameters each has.
MODEL_PARAMS = {"SIMPLE_PINHOLE": 3, "PINHOLE": 4, "SIMPLE_RADIAL": 4, "RADIAL": 5, "OPENCV": 8, "OPENCV_FISHEYE": 8, "FULL_OPENCV": 12, "FOV": 5, "SIMPLE_RADIAL_FISHEYE": 4, "RADIAL_FISHEYE": 5, "THIN_PRISM_FISHEYE": 12}
PARAMETERS = ("f", "ar", "cx", "cy", "k1", "k2", "k3", "p1", "p2")

_VAL = T.StructType([T.StructField("val", T.DoubleType())])
_XYZ = T.StructType([T.StructField(c, T.DoubleType()) for c in "xyz"])
_ROT = T.StructType([T.StructField(c, T.DoubleType()) for c in ("rx", "ry", "rz")])
_SIZE = T.StructType([T.StructField(c, T.IntegerType()) for c in ("width", "height")])
_POSE = T.StructType([T.StructField("rotation", _ROT), T.StructField("translation", _XYZ)])
_DATA = T.StructType(
    [
        T.StructField("parameters", T.StructType([T.StructField(c, _VAL) for c in PARAMETERS])),
        T.StructField("CameraModelCRT", T.StructType([T.StructField("CameraModelBase", T.StructType([T.StructField("imageSize", _SIZE)]))])),
    ]
)
_MODEL = T.StructType([T.StructField("ptr_wrapper", T.StructType([T.StructField("data", _DATA)]))])
CALIBRATION = T.StructType([T.StructField("Calibration", T.StructType([T.StructField("cameras", T.ArrayType(T.StructType([T.StructField("model", _MODEL), T.StructField("transform", _POSE)])))]))])
CAMERA = T.StructType(
    [T.StructField("id", T.IntegerType()), T.StructField("img_name", T.StringType()), T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())]
    + [T.StructField(c, T.DoubleType()) for c in ("fx", "fy", "cx", "cy")]
    + [T.StructField("position", T.ArrayType(T.DoubleType())), T.StructField("rotation", _ROT)]
)


def file_catalog(spark: SparkSession, root: str, exts: tuple[str, ...]) -> DataFrame:
    """Path, name, length and place (from 0, in order of name, then path) of files below ``root`` with one of the endings, in any case; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length", "modificationTime")
    found = files.withColumn("name", F.substring_index("path", "/", -1)).where(F.lower(F.regexp_extract("name", r"\.([^.]*)$", 1)).isin([e.lower().lstrip(".") for e in exts]))
    return with_rank(found, [], ["name", "path"], "place").withColumn("place", F.col("place") - 1)


def whole_files(spark: SparkSession, path: str, scene: Column | None = None) -> DataFrame:
    """(scene_id, content) of text files; the scene is the file's folder unless given."""
    df = spark.read.text(path, wholetext=True)
    return df.select((scene if scene is not None else F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)).alias("scene_id"), F.col("value").alias("content"))


def flatten_calibration(docs: DataFrame) -> DataFrame:
    """One row for each camera of nested calibration JSON (scene_id, content); absent numbers are 0, ar 1."""
    cams = docs.select("scene_id", F.posexplode(F.from_json("content", CALIBRATION)["Calibration"]["cameras"]).alias("cam_idx", "c"))
    data = "c.model.ptr_wrapper.data"
    size = f"{data}.CameraModelCRT.CameraModelBase.imageSize"
    get = lambda path, default=0.0: F.coalesce(F.col(path), F.lit(default))
    values = [get(f"{data}.parameters.{p}.val", 1.0 if p == "ar" else 0.0).alias(p) for p in PARAMETERS if p != "f"]
    pose = [get(f"c.transform.rotation.{c}").alias(c) for c in ("rx", "ry", "rz")] + [get(f"c.transform.translation.{c}").alias(f"p{c}") for c in "xyz"]
    return cams.select("scene_id", "cam_idx", F.col(f"{size}.width").alias("width"), F.col(f"{size}.height").alias("height"), F.col(f"{data}.parameters.f.val").alias("f"), *values, *pose)


def read_calibration(spark: SparkSession, path: str) -> DataFrame:
    """S2 on files: each file is one scene's calibration."""
    return flatten_calibration(whole_files(spark, path))


def parse_camera_list(docs: DataFrame) -> DataFrame:
    """S3: one row for each camera of a bare list or of ``{"cameras": [...]}``."""
    bare = F.from_json("content", T.ArrayType(CAMERA))
    wrapped = F.from_json("content", T.StructType([T.StructField("cameras", T.ArrayType(CAMERA))]))["cameras"]
    first = F.substring(F.ltrim("content"), 1, 1)
    rows = docs.select("scene_id", F.posexplode(F.when(first == "[", bare).otherwise(wrapped)).alias("cam_idx", "c"))
    return rows.select("scene_id", "cam_idx", "c.*")


def read_camera_list(spark: SparkSession, path: str) -> DataFrame:
    return parse_camera_list(whole_files(spark, path))


def _lines(df: DataFrame) -> DataFrame:
    """Lines without comments and blanks, split at white space as w.

    Words come out of a generator: no filter moves below it, so a line that is itself an expression is made once. Lines
    with single spaces are split without a pattern.
    """
    odd = F.startswith("value", F.lit(" ")) | F.endswith("value", F.lit(" "))
    for space in ("  ", "\t", "\n", "\x0b", "\f", "\r"):
        odd |= F.contains("value", F.lit(space))
    words = F.when(odd, F.array_remove(F.split("value", r"\s+"), "")).otherwise(F.split("value", " "))
    return df.select("*", F.explode(F.array(words)).alias("w")).where((F.get("w", F.lit(0)) != "") & ~F.startswith(F.get("w", F.lit(0)), F.lit("#")))


def _at(i: int, kind: str) -> Column:
    return F.get("w", F.lit(i)).try_cast(kind)


def parse_model_cameras(lines: DataFrame) -> DataFrame:
    """Cameras of ``ID MODEL W H PARAMS...`` lines."""
    params = F.transform(F.slice("w", F.lit(5), F.greatest(F.size("w") - 4, F.lit(0))), lambda x: x.cast("double"))
    return _lines(lines).select("scene_id", _at(0, "int").alias("camera_id"), F.get("w", F.lit(1)).alias("model"), _at(2, "bigint").alias("width"), _at(3, "bigint").alias("height"), params.alias("params"))


def parse_model_images(docs: DataFrame) -> DataFrame:
    """Images of whole files of two-line records; the second line may be blank, names may hold spaces."""
    kept = F.filter(F.split("content", r"\r?\n"), lambda x: ~F.ltrim(x).startswith("#"))
    pairs = F.transform(F.sequence(F.lit(0), F.floor((F.size("k") + 1) / 2).cast("int") - 1), lambda i: F.struct(F.get("k", i * 2).alias("head"), F.coalesce(F.get("k", i * 2 + 1), F.lit("")).alias("points")))
    rows = docs.withColumn("k", kept).where(F.size("k") > 0).select("scene_id", F.explode(pairs).alias("p")).where(F.trim("p.head") != "")
    rows = rows.select("scene_id", F.split(F.trim("p.head"), r"\s+", 10).alias("w"), F.filter(F.split(F.trim("p.points"), r"\s+"), lambda x: x != "").alias("o"))
    part = lambda a, n: F.transform(F.slice("w", a, n), lambda x: x.cast("double"))
    n = F.floor(F.size("o") / 3).cast("int")
    obs = F.when(n == 0, F.array().cast("array<struct<x:double,y:double,point3d_id:bigint>>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: F.struct(F.get("o", i * 3).cast("double").alias("x"), F.get("o", i * 3 + 1).cast("double").alias("y"), F.get("o", i * 3 + 2).cast("bigint").alias("point3d_id")))
    )
    return rows.select("scene_id", _at(0, "int").alias("image_id"), part(2, 4).alias("qvec"), part(6, 3).alias("tvec"), _at(8, "int").alias("camera_id"), F.get("w", F.lit(9)).alias("name"), obs.alias("points2d"))


def parse_model_points(lines: DataFrame) -> DataFrame:
    """Points of ``ID X Y Z R G B ERROR (IMAGE_ID POINT2D_IDX)*`` lines."""
    n = F.greatest(F.floor((F.size("w") - 8) / 2), F.lit(0)).cast("int")
    ids = F.slice("w", F.lit(9), n * 2).cast("array<int>")
    rows = _lines(lines).select("scene_id", "w", F.explode(F.array(ids)).alias("ids"))
    side = lambda k: F.filter("ids", lambda _, i: i % 2 == k)
    track = F.arrays_zip(side(0).alias("image_id"), side(1).alias("point2d_idx"))
    return rows.select("scene_id", _at(0, "bigint").alias("point_id"), *[_at(i + 1, "double").alias(c) for i, c in enumerate("xyz")], *[_at(i + 4, "int").alias(c) for i, c in enumerate("rgb")], _at(7, "double").alias("error"), track.alias("track"))


def parse_pairs(lines: DataFrame) -> DataFrame:
    """``name0 name1`` lines."""
    return _lines(lines).select("scene_id", F.get("w", F.lit(0)).alias("image0"), F.get("w", F.lit(1)).alias("image1"))


def parse_image_list(lines: DataFrame, with_intrinsics: bool = False) -> DataFrame:
    """Image names, optionally with ``MODEL W H PARAMS...``."""
    rows = _lines(lines)
    out = [F.get("w", F.lit(0)).alias("name")]
    if with_intrinsics:
        out += [F.get("w", F.lit(1)).alias("model"), _at(2, "bigint").alias("width"), _at(3, "bigint").alias("height"), F.transform(F.slice("w", F.lit(5), F.greatest(F.size("w") - 4, F.lit(0))), lambda x: x.cast("double")).alias("params")]
    return rows.select("scene_id", *out)


def validate_model_arity(cameras: DataFrame) -> DataFrame:
    """Cameras whose model is unknown or has another number of parameters."""
    table = F.create_map(*[F.lit(x) for kv in MODEL_PARAMS.items() for x in kv])
    c = cameras.withColumn("expected", F.try_element_at(table, F.col("model"))).withColumn("given", F.size("params"))
    return c.where(F.col("expected").isNull() | (F.col("expected") != F.col("given"))).select("scene_id", "camera_id", "model", "expected", "given")
