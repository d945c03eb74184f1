"""Cameras and frames from file names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Patterns by rule, tried in order.
CAMERA_RULES = {
    "prefix": (r"(?i)^cam0*([0-9]+)", r"^0*([0-9]+)"),
    "anywhere": (r"cam([0-9]+)",),
    "directory": (r"^cam0*([0-9]+)$",),
    "stem": (r"^0*([0-9]+)\.[^.]*$",),
}
FRAME_RULES = {"suffix": (r"(?i)frame0*([0-9]+)\.png$",), "anywhere": (r"frame([0-9]+)",)}


def number(name: Column, patterns: tuple[str, ...]) -> Column:
    """The first pattern's number in ``name``, or null."""
    return F.coalesce(*[F.nullif(F.regexp_extract(name, p, 1), F.lit("")).try_cast("int") for p in patterns])


def with_camera_id(df: DataFrame, rule: str = "prefix", id_offset: int = 0, name_col: str = "file_name", fallback: Column | None = None) -> DataFrame:
    """column cam_id by a naming rule; null (or ``fallback``) where no pattern fits."""
    found = number(F.col(name_col), CAMERA_RULES[rule]) + id_offset
    return df.withColumn("cam_id", found if fallback is None else F.coalesce(found, fallback))


def with_frame_id(df: DataFrame, rule: str = "suffix", name_col: str = "name") -> DataFrame:
    """column frame_id by a naming rule."""
    return df.withColumn("frame_id", number(F.col(name_col), FRAME_RULES[rule]))


def first_file_per_frame(df: DataFrame, keys: tuple[str, ...] = ("scene_id", "cam_num"), name_col: str = "name") -> DataFrame:
    """of files with one frame id the first by name stays."""
    return df.where("frame_id is not null").groupBy(*keys, "frame_id").agg(F.min(name_col).alias(name_col))


def in_range(df: DataFrame, col: str, start: int | None, end: int | None) -> DataFrame:
    if start is not None:
        df = df.where(F.col(col) >= start)
    return df if end is None else df.where(F.col(col) <= end)


def filter_cameras(df: DataFrame, start: int | None = None, end: int | None = None, col: str = "cam_num") -> DataFrame:
    """an inclusive range of cameras, open where an end is null."""
    return in_range(df, col, start, end)


def filter_frames(df: DataFrame, start: int | None = None, end: int | None = None, col: str = "frame_id") -> DataFrame:
    """an inclusive range of frames; a start after the end is an error."""
    if start is not None and end is not None and start > end:
        raise ValueError(f"frame range starts at {start} after its end {end}")
    return in_range(df, col, start, end)


def audit_names(df: DataFrame, name_col: str = "name") -> DataFrame:
    """how many names of each scene have no camera, no frame, or both."""
    camera, frame = number(F.col(name_col), CAMERA_RULES["prefix"]), number(F.col(name_col), FRAME_RULES["suffix"])
    reason = F.when(camera.isNull() & frame.isNull(), "no camera or frame").when(camera.isNull(), "no camera").when(frame.isNull(), "no frame").otherwise("ok")
    return df.groupBy("scene_id", reason.alias("reason")).agg(F.count(F.lit(1)).alias("names"))
