"""Which frames of videos to extract (F5, P1-P8). Frames that are not wanted are never generated."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CAMERA = ("scene_id", "cam_num")


def frame_window(videos: DataFrame, start_s: float | None = None, end_s: float | None = None) -> DataFrame:
    """first_frame (inclusive) and end_frame (exclusive) of a stretch of seconds; empty ones go."""
    whole = F.col("total_frames")
    first = F.lit(0).cast("long") if start_s is None else F.floor(F.lit(float(start_s)) * F.col("fps"))
    end = whole if end_s is None else F.floor(F.lit(float(end_s)) * F.col("fps"))
    clamp = lambda c: F.greatest(F.lit(0), F.least(c, whole))
    return videos.where("fps > 0").withColumn("first_frame", clamp(first)).withColumn("end_frame", clamp(end)).where("first_frame < end_frame")


def sample_stride(windows: DataFrame, fps: float) -> DataFrame:
    """Every n-th frame of the window, n the whole ratio of the rates, 1 at least."""
    step = F.when(F.lit(float(fps)) < F.col("fps"), F.greatest(F.floor(F.col("fps") / float(fps)), F.lit(1))).otherwise(1)
    return windows.withColumn("frame", F.explode(F.sequence(F.col("first_frame"), F.col("end_frame") - 1, step.cast("long"))))


def sample_per_second(windows: DataFrame, n: int) -> DataFrame:
    """N frames spread evenly over each second of the clip, as far as the window has them."""
    second = F.explode(F.sequence(F.floor(F.col("first_frame") / F.col("fps")), F.ceil(F.col("end_frame") / F.col("fps"))))
    b = windows.withColumn("second", second)
    b = b.withColumn("b0", F.greatest(F.floor(F.col("second") * F.col("fps")), F.col("first_frame"))).withColumn("b1", F.least(F.floor((F.col("second") + 1) * F.col("fps")), F.col("end_frame")))
    b = b.withColumn("have", F.col("b1") - F.col("b0")).where("have > 0").withColumn("k", F.least(F.lit(n), F.col("have")))
    b = b.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)))
    frame = F.col("b0") + F.floor((F.col("i") + F.lit(0.5)) * F.col("have") / F.col("k"))
    return b.withColumn("frame", frame).drop("b0", "b1", "have", "k", "i")


def cap_frames(df: DataFrame, max_frames: int) -> DataFrame:
    """The first so many frames of each camera."""
    rank = F.row_number().over(Window.partitionBy(*CAMERA).orderBy("frame"))
    return df.withColumn("rank", rank).where(F.col("rank") <= max_frames).drop("rank")


def number_frames(df: DataFrame) -> DataFrame:
    """Frames of a camera are numbered from 1 and named camNNNframeNNN.png in camNNN/."""
    df = df.withColumn("out_id", F.row_number().over(Window.partitionBy(*CAMERA).orderBy("frame")))
    folder = F.format_string("cam%03d", "cam_num")
    return df.withColumn("out_path", F.concat(folder, F.lit("/"), folder, F.format_string("frame%03d.png", "out_id")))


def first_frames(videos: DataFrame, start: int, end: int) -> DataFrame:
    """P5: the file of each expected camera of a scene; null where the scene has no video of it."""
    wanted = videos.select("scene_id").distinct().withColumn("cam_num", F.explode(F.sequence(F.lit(start), F.lit(end))))
    have = videos.groupBy(*CAMERA).agg(F.min("file_name").alias("file_name"))
    return wanted.join(have, list(CAMERA), "left").withColumn("missing", F.col("file_name").isNull())


def expand_selectors(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(wanted, rejected) of requests (scene_id, spec): ``5``, ``1 4 7``, ``a-b`` or ``a:b[:step]``.

    wanted has a row for each frame (1-based, ends inclusive) and its first place in the spec.
    """
    part = F.explode(F.split(F.trim("spec"), r"\s+|,\s*"))
    p = requests.withColumn("part", part)
    grab = lambda k: F.nullif(F.regexp_extract("part", r"^([0-9]+)(?:[-:]([0-9]+)(?::([0-9]+))?)?$", k), F.lit("")).try_cast("int")
    p = p.withColumn("a", grab(1)).withColumn("b", F.coalesce(grab(2), grab(1))).withColumn("step", F.coalesce(grab(3), F.lit(1)))
    ok = F.col("a").isNotNull() & (F.col("a") >= 1) & (F.col("b") >= F.col("a")) & (F.col("step") >= 1) & ~F.col("part").rlike("-.*:")
    p = p.withColumn("ok", F.coalesce(ok, F.lit(False)))
    bad = p.groupBy("scene_id", "spec").agg(F.bool_and("ok").alias("all_ok")).where("not all_ok").select("scene_id", "spec")
    lists = p.groupBy("scene_id", "spec").agg(F.bool_and("ok").alias("all_ok"), F.collect_list(F.struct("a", "b", "step")).alias("parts")).where("all_ok")
    frames = F.array_distinct(F.flatten(F.transform("parts", lambda x: F.sequence(x["a"], x["b"], x["step"]))))
    return lists.select("scene_id", "spec", F.posexplode(frames).alias("place", "frame_id")), bad


def select_frames(frames: DataFrame, selector: DataFrame) -> DataFrame:
    """Each camera's file for each wanted frame (scene_id, frame_id), null where it has none.

    Files go by their frame id; if no name of a camera has one, by their place in name order.
    ``frames`` has scene_id, cam_num, name and frame_id (null where unparsable).
    """
    every = Window.partitionBy(*CAMERA)
    place = F.when(F.max("frame_id").over(every).isNull(), F.row_number().over(every.orderBy("name"))).otherwise(F.col("frame_id"))
    found = frames.withColumn("key", place).where("key is not null").groupBy(*CAMERA, "key").agg(F.min("name").alias("name"))
    wanted = frames.select(*CAMERA).distinct().join(selector.select("scene_id", "frame_id").distinct(), "scene_id")
    return wanted.join(found.withColumnRenamed("key", "frame_id"), [*CAMERA, "frame_id"], "left")


def selection_report(selected: DataFrame) -> DataFrame:
    """Found and missing files and cameras without any, for each scene."""
    cams = selected.groupBy(*CAMERA).agg(F.count("name").alias("found"), F.count_if(F.col("name").isNull()).alias("missing"))
    return cams.groupBy("scene_id").agg(F.sum("found").alias("found"), F.sum("missing").alias("missing"), F.count_if(F.col("found") == 0).alias("empty_cameras"))
