"""Rotations as Column expressions. Matrices are arrays of nine doubles, row by row; quaternions (w, x, y, z)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def d(x: float) -> Column:
    return F.lit(float(x))


def transpose(m: list[Column]) -> list[Column]:
    return [m[3 * j + i] for i in range(3) for j in range(3)]


def product(a: list[Column], b: list[Column]) -> list[Column]:
    return [sum((a[3 * i + k] * b[3 * k + j] for k in range(1, 3)), a[3 * i] * b[j]) for i in range(3) for j in range(3)]


def apply(m: list[Column], v: list[Column]) -> list[Column]:
    return [m[3 * i] * v[0] + m[3 * i + 1] * v[1] + m[3 * i + 2] * v[2] for i in range(3)]


def determinant(m: list[Column]) -> Column:
    return m[0] * (m[4] * m[8] - m[5] * m[7]) - m[1] * (m[3] * m[8] - m[5] * m[6]) + m[2] * (m[3] * m[7] - m[4] * m[6])


def quat_to_matrix(w: Column, x: Column, y: Column, z: Column) -> list[Column]:
    """The quaternion is normalised first; zero gives the identity."""
    n = F.sqrt(w * w + x * x + y * y + z * z)
    w, x, y, z = F.when(n > 0, w / n).otherwise(1.0), *(F.when(n > 0, c / n).otherwise(0.0) for c in (x, y, z))
    return [
        1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w),
        2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w),
        2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y),
    ]


def matrix_to_quat(m: list[Column]) -> list[Column]:
    """By the largest of the trace and the diagonal; the sign is not fixed."""
    trace = m[0] + m[4] + m[8]
    s0, s1, s2, s3 = (2 * F.sqrt(F.greatest(t, d(0))) for t in (trace + 1, 1 + m[0] - m[4] - m[8], 1 + m[4] - m[0] - m[8], 1 + m[8] - m[0] - m[4]))
    a, b, c = m[7] - m[5], m[2] - m[6], m[3] - m[1]
    e, f, g = m[1] + m[3], m[2] + m[6], m[5] + m[7]
    forms = [[s0 / 4, a / s0, b / s0, c / s0], [a / s1, s1 / 4, e / s1, f / s1], [b / s2, e / s2, s2 / 4, g / s2], [c / s3, f / s3, g / s3, s3 / 4]]
    pick = F.when(trace > 0, 0).when((m[0] > m[4]) & (m[0] > m[8]), 1).when(m[4] > m[8], 2).otherwise(3)
    return [F.when(pick == 0, forms[0][i]).when(pick == 1, forms[1][i]).when(pick == 2, forms[2][i]).otherwise(forms[3][i]) for i in range(4)]


def euler_matrix(rx: Column, ry: Column, rz: Column, order: str) -> list[Column]:
    """Product of the axis rotations, the first letter leftmost: ``zyx`` is Rz Ry Rx."""
    cx, sx, cy, sy, cz, sz = F.cos(rx), F.sin(rx), F.cos(ry), F.sin(ry), F.cos(rz), F.sin(rz)
    o, i = d(0), d(1)
    axis = {"x": [i, o, o, o, cx, -sx, o, sx, cx], "y": [cy, o, sy, o, i, o, -sy, o, cy], "z": [cz, -sz, o, sz, cz, o, o, o, i]}
    return product(product(axis[order[0]], axis[order[1]]), axis[order[2]])


def matrix_to_euler_zyx(m: list[Column]) -> list[Column]:
    """(rx, ry, rz) of Rz Ry Rx; at gimbal lock rz is 0."""
    s = F.sqrt(m[0] * m[0] + m[3] * m[3])
    free = s >= 1e-6
    return [F.when(free, F.atan2(m[7], m[8])).otherwise(F.atan2(-m[5], m[4])), F.atan2(-m[6], s), F.when(free, F.atan2(m[3], m[0])).otherwise(0.0)]


def rodrigues_matrix(rx: Column, ry: Column, rz: Column) -> list[Column]:
    """Of a rotation vector; under 1e-10 the identity."""
    t = F.sqrt(rx * rx + ry * ry + rz * rz)
    tiny = t < 1e-10
    kx, ky, kz = (F.when(tiny, 0.0).otherwise(c / F.when(tiny, 1.0).otherwise(t)) for c in (rx, ry, rz))
    c, s = F.cos(t), F.sin(t)
    v = 1 - c
    m = [c + kx * kx * v, kx * ky * v - kz * s, kx * kz * v + ky * s, ky * kx * v + kz * s, c + ky * ky * v, ky * kz * v - kx * s, kz * kx * v - ky * s, kz * ky * v + kx * s, c + kz * kz * v]
    return [F.when(tiny, d(1.0 if i % 4 == 0 else 0.0)).otherwise(x) for i, x in enumerate(m)]


def canonical(q: list[Column]) -> list[Column]:
    """The sign with w >= 0."""
    return [F.when(q[0] < 0, -c).otherwise(c) for c in q]
