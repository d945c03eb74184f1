"""Alignment of names, completeness and integrity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rigprep.functions.order import with_rank
from rigprep.functions.shared import materialize
from rigprep.operators.names import CAMERA_RULES, number

#: Endings that are tried for a missing file, in this order.
ENDINGS = (".jpg", ".jpeg", ".PNG", ".JPG", ".JPEG")


def frame_index(frames: DataFrame, keep: str = "last") -> DataFrame:
    """A1: one name for each (scene, frame, camera): the last in name order, or the first."""
    return frames.groupBy("scene_id", "frame_id", "cam_num").agg((F.max if keep == "last" else F.min)("name").alias("name"))


def frame_completeness(frames: DataFrame, ref: DataFrame) -> DataFrame:
    """A2: cameras that a frame lacks or has too many against the scene's reference cameras."""
    f = frames.groupBy("scene_id", "frame_id").agg(F.sort_array(F.collect_set("cam_num")).alias("have"))
    r = ref.groupBy("scene_id").agg(F.sort_array(F.collect_set("cam_num")).alias("want"))
    j = f.join(r, "scene_id")
    return j.select("scene_id", "frame_id", F.array_except("want", "have").alias("missing"), F.array_except("have", "want").alias("extra")).withColumn("complete", (F.size("missing") == 0) & (F.size("extra") == 0))


def align_names(src: DataFrame, ref: DataFrame) -> DataFrame:
    """A3: (scene_id, src_name, ref_name, policy) of each scene's images.

    Equal sets map to themselves (``same``); unequal counts are an ``error`` row; unique and equal
    camera ids map by camera, all others by rank in name order. A name that a list has more than once is one image, and each
    of its rows is mapped. Sets are compared by how many of their members meet, and
    ranks go by ranges, so no task holds a scene's names.
    """
    cam = number(F.col("name"), CAMERA_RULES["anywhere"])

    def side(df: DataFrame, p: str) -> DataFrame:
        return with_rank(df.select("scene_id", F.col("name").alias(f"{p}_name"), cam.alias(f"{p}_cam")), ["scene_id"], [f"{p}_name"], f"{p}_rank")

    def facts(df: DataFrame, p: str) -> DataFrame:
        return df.groupBy("scene_id").agg(F.count(F.lit(1)).alias(f"{p}_n"), F.count_distinct(f"{p}_name").alias(f"{p}_names"), F.count_distinct(f"{p}_cam").alias(f"{p}_cams"), F.count(f"{p}_cam").alias(f"{p}_have"))

    def shared(c: str) -> DataFrame:
        one, two = (df.select("scene_id", F.col(f"{p}_{c}").alias("x")).distinct() for df, p in ((s, "src"), (r, "ref")))
        return one.join(two, ["scene_id", "x"]).groupBy("scene_id").agg(F.count(F.lit(1)).alias(f"{c}s"))

    s, r = side(src, "src"), side(ref, "ref")
    f = facts(s, "src").join(facts(r, "ref"), "scene_id").join(shared("name"), "scene_id", "left").join(shared("cam"), "scene_id", "left")
    same = (F.col("src_names") == F.col("ref_names")) & (F.col("src_names") == F.coalesce("names", F.lit(0)))
    one = [(F.col(f"{p}_cams") == F.col(f"{p}_names")) & (F.col(f"{p}_have") == F.col(f"{p}_n")) for p in ("src", "ref")]
    unique = one[0] & one[1] & (F.col("src_cams") == F.col("ref_cams")) & (F.col("src_cams") == F.coalesce("cams", F.lit(0)))
    policy = F.when(same, "same").when(F.col("src_n") != F.col("ref_n"), "error").when(unique, "camera").otherwise("rank")
    p = materialize(f.select("scene_id", policy.alias("policy")), "policies")
    ps = s.join(p, "scene_id")
    by = lambda pol, c: ps.where(F.col("policy") == pol).join(r.select("scene_id", "ref_name", F.col(f"ref_{c}").alias(f"src_{c}")).distinct(), ["scene_id", f"src_{c}"]).select("scene_id", "src_name", "ref_name", "policy")
    equal = ps.where("policy = 'same'").select("scene_id", "src_name", F.col("src_name").alias("ref_name"), "policy")
    errors = p.where("policy = 'error'").select("scene_id", F.lit(None).cast("string").alias("src_name"), F.lit(None).cast("string").alias("ref_name"), "policy")
    return equal.unionByName(by("camera", "cam")).unionByName(by("rank", "rank")).unionByName(errors)


def rename_images(images: DataFrame, mapping: DataFrame) -> DataFrame:
    """A4: names by a mapping (scene_id, src_name, ref_name), whose repeated rows count once; replaced tells which changed."""
    m = mapping.where("src_name <> ref_name").select("scene_id", F.col("src_name").alias("name"), "ref_name").distinct()
    j = images.join(m, ["scene_id", "name"], "left")
    return j.withColumn("replaced", F.col("ref_name").isNotNull()).withColumn("name", F.coalesce("ref_name", "name")).drop("ref_name")


def frame_image_plan(frames: DataFrame, ref: DataFrame) -> DataFrame:
    """A5: the source file of each frame and the reference name of the same camera."""
    return frames.select("scene_id", "frame_id", "cam_num", F.col("name").alias("source")).join(ref.select("scene_id", "cam_num", F.col("name").alias("target")), ["scene_id", "cam_num"])


def verify_images(calib: DataFrame, files: DataFrame) -> DataFrame:
    """The file of each referenced image, as named or with another ending, null if there is none; a row for each reference."""
    ending = F.regexp_extract("file", r"(\.[^.]*)$", 1)
    have = files.select("scene_id", F.col("name").alias("file")).distinct().withColumn("stem", F.regexp_replace("file", r"\.[^.]*$", "")).withColumn("ending", ending)
    want = calib.select("scene_id", "img_name").distinct().withColumn("stem", F.regexp_replace("img_name", r"\.[^.]*$", ""))
    j = want.join(have, ["scene_id", "stem"], "left")
    place = F.array_position(F.array(*map(F.lit, ENDINGS)), F.col("ending"))
    rank = F.when(F.col("file") == F.col("img_name"), 0).when(place > 0, place)
    j = j.withColumn("rank", rank)
    found = j.groupBy("scene_id", "img_name").agg(F.min_by(F.when(F.col("rank").isNotNull(), F.col("file")), "rank").alias("file"))
    return calib.select("scene_id", "img_name").join(found, ["scene_id", "img_name"], "left")


def integrity_report(images: DataFrame, cameras: DataFrame, points: DataFrame, scenes: DataFrame) -> DataFrame:
    """What each scene's training set lacks, and whether it is complete."""
    def count(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("scene_id").agg(F.count(F.lit(1)).alias(name))

    j = scenes.select("scene_id").distinct()
    for df, n in ((images, "images"), (cameras, "cameras"), (points, "points")):
        j = j.join(count(df, n), "scene_id", "left").withColumn(n, F.coalesce(n, F.lit(0)))
    issues = F.array_compact(F.array(F.when(F.col("images") == 0, "no images"), F.when(F.col("cameras") == 0, "no cameras"), F.when(F.col("points") == 0, "no points").when(F.col("points") < 1000, "few points")))
    return j.withColumn("issues", issues).withColumn("ok", F.size("issues") == 0)
