"""Rotations as column expressions: no Python runs where these are used."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Left and right joints of the 24-joint body, and each joint's parent.
LEFT_RIGHT = ((1, 2), (4, 5), (7, 8), (10, 11), (13, 14), (16, 17), (18, 19), (20, 21), (22, 23))
PARENTS = (-1, 0, 0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 9, 9, 12, 13, 14, 16, 17, 18, 19, 20, 21)

Vec = list[Column]


def parts(v: Column, n: int) -> Vec:
    return [F.get(v, F.lit(i)) for i in range(n)]


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value made once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def rounded(value: Column, digits: int) -> Column:
    """A number to so many digits with its sign: what is negative becomes a negative zero, if any, and a zero a positive one.

    Twelve digits are taken first: what was worked out by matrices misses zeros and halves in the last ones.
    """
    return bound(F.round(value, 12), lambda v: F.round(F.abs(v), digits) * F.when(v < 0, -1.0).otherwise(1.0))


def dot(a: Vec, b: Vec) -> Column:
    out = a[0] * b[0]
    for x, y in zip(a[1:], b[1:], strict=True):
        out = out + x * y
    return out


def norm(a: Vec) -> Column:
    return F.sqrt(dot(a, a))


def cross(a: Vec, b: Vec) -> Vec:
    return [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]


def matrix_of_axis_angle(r: Column) -> Column:
    """Row-major 3x3 rotation of an axis-angle vector."""

    def made(v: Column) -> Column:
        x, y, z, a, b = parts(v, 5)
        return F.array(
            1 - b * (y * y + z * z), b * x * y - a * z, b * x * z + a * y,
            b * x * y + a * z, 1 - b * (x * x + z * z), b * y * z - a * x,
            b * x * z - a * y, b * y * z + a * x, 1 - b * (x * x + y * y),
        )

    def scales(angle: Column) -> Column:
        small = angle < 1e-8
        return F.array(F.when(small, 1.0).otherwise(F.sin(angle) / angle), F.when(small, 0.5).otherwise((1 - F.cos(angle)) / (angle * angle)))

    return bound(r, lambda v: bound(F.concat(v, bound(norm(parts(v, 3)), scales)), made))


def quaternion_of_matrix(m: Column) -> Column:
    """(w, x, y, z), from the largest of the trace and the diagonal, so nothing small is divided by."""
    return bound(m, _quaternion)


def _quaternion(m: Column) -> Column:
    m00, m01, m02, m10, m11, m12, m20, m21, m22 = parts(m, 9)
    t = m00 + m11 + m22

    def of(square: Column, pick) -> Column:
        return bound(2 * F.sqrt(square), lambda s: F.array(*pick(s)))

    w = of(1 + t, lambda s: (s / 4, (m21 - m12) / s, (m02 - m20) / s, (m10 - m01) / s))
    x = of(1 + m00 - m11 - m22, lambda s: ((m21 - m12) / s, s / 4, (m01 + m10) / s, (m02 + m20) / s))
    y = of(1 - m00 + m11 - m22, lambda s: ((m02 - m20) / s, (m01 + m10) / s, s / 4, (m12 + m21) / s))
    z = of(1 - m00 - m11 + m22, lambda s: ((m10 - m01) / s, (m02 + m20) / s, (m12 + m21) / s, s / 4))
    return F.when(t > 0, w).when((m00 >= m11) & (m00 >= m22), x).when(m11 >= m22, y).otherwise(z)


def axis_angle_of_matrix(m: Column) -> Column:
    return bound(quaternion_of_matrix(m), _axis_angle)


def _axis_angle(q: Column) -> Column:
    w, x, y, z = parts(q, 4)
    size = norm([x, y, z])
    sign = F.when(w < 0, -1.0).otherwise(1.0)
    angle = 2 * F.atan2(size, F.abs(w))
    k = F.when(size < 1e-12, F.lit(2.0)).otherwise(sign * angle / size)
    return F.array(x * k, y * k, z * k)


def matrix_of_six(v: Column) -> Column:
    """Rotation of the 6-d form: two vectors made orthonormal and their product, as columns."""
    a, b = parts(v, 6)[:3], parts(v, 6)[3:]
    na = norm(a)
    x = [c / na for c in a]
    d = dot(x, b)
    rest = [c - d * e for c, e in zip(b, x, strict=True)]
    nr = norm(rest)
    y = [c / nr for c in rest]
    z = cross(x, y)
    return F.array(x[0], y[0], z[0], x[1], y[1], z[1], x[2], y[2], z[2])


def euler_zyx_degrees(m: Column) -> Column:
    """Angles about Z, Y and X in degrees of a rotation applied in the order Z, Y, X."""
    m00, _, _, m10, _, _, m20, m21, m22 = parts(m, 9)
    return F.array(
        F.degrees(F.atan2(m10, m00)), F.degrees(F.atan2(-m20, F.sqrt(m00 * m00 + m10 * m10))), F.degrees(F.atan2(m21, m22))
    )


def rotate(q: Column, v: Column, *, inverse: bool = False) -> Column:
    """Vector turned by a quaternion (w, x, y, z)."""
    w, *u = parts(q, 4)
    if inverse:
        u = [-c for c in u]
    p = parts(v, 3)
    t = [2 * c for c in cross(u, p)]
    return F.array(*(a + w * b + c for a, b, c in zip(p, t, cross(u, t), strict=True)))


def mirror_pose(pose: Column, joints: int = 24) -> Column:
    """Axis-angle pose seen in a mirror: y and z negated, left and right joints exchanged."""
    swap = {a: b for pair in LEFT_RIGHT for a, b in (pair, pair[::-1])}
    order = F.array(*(F.lit(3 * swap.get(j, j) + c) for j in range(joints) for c in range(3)))
    return F.transform(order, lambda i: F.get(pose, i) * F.when(i % 3 == 0, 1.0).otherwise(-1.0))


def mirror_position(position: Column) -> Column:
    return F.transform(position, lambda v, i: F.when(i == 0, -v).otherwise(v))


def export_pose(pose: Column, left_hand: Column, right_hand: Column) -> Column:
    """The 156 slots of the exchange format: 22 body joints, then both hands, zeros where a hand is null."""
    zeros = F.array_repeat(F.lit(0.0), 45)
    return F.concat(F.slice(pose, 1, 66), F.coalesce(left_hand, zeros), F.coalesce(right_hand, zeros))


def axis_angle_of_six(v: Column) -> Column:
    return axis_angle_of_matrix(matrix_of_six(v))


def mirror_hand(hand: Column) -> Column:
    """A hand's 15 joints seen in a mirror, where it is the other hand; null stays null."""
    return F.transform(hand, lambda v, i: F.when(i % 3 == 0, v).otherwise(-v))


def mirror_mask(valid: Column) -> Column:
    """A mask of joints with left and right exchanged."""
    swap = {a: b for pair in LEFT_RIGHT for a, b in (pair, pair[::-1])}
    return F.when(valid.isNotNull(), F.transform(F.array(*(F.lit(swap.get(j, j)) for j in range(24))), lambda j: F.get(valid, j)))


def axis_angles(block: Column, joints: int | Callable[[Column], Column]) -> Column:
    """Axis-angles of so many joints out of axis-angles, 3x3 matrices or the 6-d form, told apart by their length; ``joints`` may depend on the block."""

    def made(b: Column) -> Column:
        n = joints(b) if callable(joints) else F.lit(joints)
        of = lambda size, use: F.flatten(F.transform(F.sequence(F.lit(0), n - 1), lambda j: use(F.slice(b, j * size + 1, size))))
        wrong = F.raise_error(F.concat(F.lit("no rotations of these joints: length "), F.size(b).cast("string"))).cast("array<double>")
        return F.when(F.size(b) == 3 * n, b).when(F.size(b) == 9 * n, of(9, axis_angle_of_matrix)).when(F.size(b) == 6 * n, of(6, axis_angle_of_six)).otherwise(wrong)

    return bound(block, made)


def body_pose(orient: Column, body: Column) -> Column:
    """The 72 numbers of a body: its orientation, and 23 joints, or 21 and two hands at rest; each in any form of ``axis_angles``."""
    joints = lambda b: F.when(F.size(b).isin(69, 138, 207), 23).otherwise(21)
    numbers = bound(axis_angles(body, joints), lambda b: F.when(F.size(b) == 69, b).otherwise(F.concat(b, F.array_repeat(F.lit(0.0), 6))))
    return F.concat(axis_angles(orient, 1), numbers)


def hand_pose(hand: Column) -> Column:
    """The 45 numbers of a hand, out of any form of ``axis_angles``."""
    return axis_angles(hand, 15)


def in_parent(parent: Column, world: Column) -> Column:
    """A world rotation as the parent's frame has it: the parent's transpose times it, both 3x3."""

    def product(both: Column) -> Column:
        p, w = parts(both, 18)[:9], parts(both, 18)[9:]
        return F.array(*(p[r] * w[c] + p[3 + r] * w[3 + c] + p[6 + r] * w[6 + c] for r in range(3) for c in range(3)))

    return bound(F.concat(parent, world), product)


def wrist_in_body(global_rotation: Column, joint: int, wrist: Column) -> Column:
    """A wrist's world axis-angle in the frame of its forearm, given the world rotations of all joints (9 numbers each)."""
    return axis_angle_of_matrix(in_parent(F.slice(global_rotation, 9 * PARENTS[joint] + 1, 9), matrix_of_axis_angle(wrist)))
