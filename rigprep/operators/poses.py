"""Camera poses (R1-R8). A pose is quaternion qw..qz and translation tx..tz, world to camera unless said."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rigprep.functions import rotation as rot
from rigprep.functions.order import with_rank

QUAT, TRANS, EULER = ("qw", "qx", "qy", "qz"), ("tx", "ty", "tz"), ("rx", "ry", "rz")


def flat_pose(images: DataFrame) -> DataFrame:
    """qvec and tvec arrays as the columns qw..qz and tx..tz."""
    return images.withColumns({c: F.get("qvec", F.lit(i)) for i, c in enumerate(QUAT)} | {c: F.get("tvec", F.lit(i)) for i, c in enumerate(TRANS)})


def _cols(names) -> list[Column]:
    return [F.col(c) for c in names]


def detect_pose_format(df: DataFrame) -> DataFrame:
    """pose_format of records with optional position, rotation, extrinsic (16 numbers, row by row), quaternion, r and t.

    A position with a rotation is camera to world; a 4 x 4 matrix world to camera unless its
    translation is not null and its determinant is not 1 (then ``tcw``); else world to camera where
    a quaternion or R and T are given, and camera to world by default.
    """
    e = [F.get("extrinsic", F.lit(i)) for i in range(16)]
    long = F.sqrt(e[3] * e[3] + e[7] * e[7] + e[11] * e[11]) >= 1e-3
    off = F.abs(rot.determinant([e[0], e[1], e[2], e[4], e[5], e[6], e[8], e[9], e[10]]) - 1) >= 1e-3
    form = (
        F.when(F.col("position").isNotNull() & F.col("rotation").isNotNull(), "c2w")
        .when(F.col("extrinsic").isNotNull(), F.when(long & off, "tcw").otherwise("w2c"))
        .when(F.col("quaternion").isNotNull() | (F.col("r").isNotNull() & F.col("t").isNotNull()), "w2c")
        .otherwise("c2w")
    )
    return df.withColumn("pose_format", form)


def rotation_matrix(kind: str) -> list[Column]:
    """The matrix of the row's rotation: columns rx..rz, qw..qz or array m, by kind."""
    if kind == "rodrigues":
        return rot.rodrigues_matrix(*_cols(EULER))
    if kind in ("euler_zyx", "euler_xyz"):
        return rot.euler_matrix(*_cols(EULER), kind[-3:])
    if kind == "quaternion":
        return rot.quat_to_matrix(*_cols(QUAT))
    if kind == "matrix":
        return [F.get("m", F.lit(i)) for i in range(9)]
    raise ValueError(f"unknown rotation kind {kind}")


def convert_rotation(df: DataFrame, src: str, dst: str) -> DataFrame:
    """Adds the rotation in another form: array m, columns qw..qz (w >= 0) or rx..rz of Rz Ry Rx."""
    m = rotation_matrix(src)
    if dst == "matrix":
        return df.withColumn("m", F.array(*m))
    keyed = df.withColumn("__m", F.array(*m))
    m = [F.get("__m", F.lit(i)) for i in range(9)]
    if dst == "quaternion":
        out = dict(zip(QUAT, rot.canonical(rot.matrix_to_quat(m)), strict=True))
    elif dst == "euler_zyx":
        out = dict(zip(EULER, rot.matrix_to_euler_zyx(m), strict=True))
    else:
        raise ValueError(f"unknown rotation kind {dst}")
    return keyed.withColumns(out).drop("__m")


def invert_pose(df: DataFrame, kind: str = "quaternion") -> DataFrame:
    """The other direction: inv_m is the transposed rotation, ix..iz the camera centre (or its world)."""
    back = rot.transpose(rotation_matrix(kind))
    moved = rot.apply(back, _cols(TRANS))
    return df.withColumns({"inv_m": F.array(*back), **{c: -x for c, x in zip(("ix", "iy", "iz"), moved, strict=True)}})


def to_camera_to_world(df: DataFrame, rotation_kind: str, direction: str) -> DataFrame:
    """R2: position px..pz and ZYX angles of any pose; direction is w2c or c2w. Unusable rows have valid false."""
    m = rotation_matrix(rotation_kind)
    if direction == "w2c":
        m = rot.transpose(m)
        moved = rot.apply(m, _cols(TRANS))
        place = [-x for x in moved]
    else:
        place = _cols(TRANS)
    angles = rot.matrix_to_euler_zyx(m)
    out = {c: x for c, x in zip(("out_px", "out_py", "out_pz", "out_rx", "out_ry", "out_rz"), [*place, *angles], strict=True)}
    valid = F.lit(True)
    for x in place + angles[:1]:
        valid = valid & x.isNotNull() & ~F.isnan(x)
    return df.withColumns(out | {"valid": valid})


def check_quaternions(df: DataFrame) -> DataFrame:
    """Norm, deviation from 1, is_unit, and the normalised quaternion with w >= 0 (zero: identity)."""
    q = _cols(QUAT)
    norm = F.sqrt(q[0] * q[0] + q[1] * q[1] + q[2] * q[2] + q[3] * q[3])
    unit = [F.when(norm > 0, c / norm).otherwise(1.0 if i == 0 else 0.0) for i, c in enumerate(q)]
    fixed = {f"n_{c}": x for c, x in zip(QUAT, rot.canonical(unit), strict=True)}
    return df.withColumns({"norm": norm, "deviation": F.abs(norm - 1), "is_unit": F.abs(norm - 1) < 1e-6} | fixed)


def pose_matrix(df: DataFrame, kind: str = "quaternion") -> DataFrame:
    """c2w, the 4 x 4 camera-to-world matrix of a world-to-camera pose, as 16 numbers row by row."""
    inv = invert_pose(df, kind)
    m = [F.get("inv_m", F.lit(i)) for i in range(9)]
    t = _cols(("ix", "iy", "iz"))
    return inv.withColumn("c2w", F.array(*m[0:3], t[0], *m[3:6], t[1], *m[6:9], t[2], *map(rot.d, (0, 0, 0, 1)))).drop("inv_m", "ix", "iy", "iz")


def expand_poses(images: DataFrame, frames: DataFrame) -> DataFrame:
    """Every frame gets its camera's pose and a dense new image id in (folder, name) order.

    images: scene_id, cam_num and the pose; frames: scene_id, cam_num, cam_dir, name. Frames of
    cameras that the model lacks are left out (count them with a left_anti join). Many tasks number one scene.
    """
    both = frames.join(images, ["scene_id", "cam_num"])
    return with_rank(both, ["scene_id"], ["cam_dir", "name"], "new_image_id").withColumn("new_image_id", F.col("new_image_id").cast("int"))


def pose_only_model(images: DataFrame) -> DataFrame:
    """Ids, poses, cameras and names without observations."""
    empty = F.array().cast("array<struct<x:double,y:double,point3d_id:bigint>>")
    return images.select("scene_id", "image_id", "qvec", "tvec", "camera_id", "name", empty.alias("points2d"))
