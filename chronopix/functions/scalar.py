"""Row-wise expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: gains of the four motion sensors, and half-open ranges of light power with their levels
GAINS = (0.66, 0.68, 0.68, 0.69)
POWER_LEVELS = ((-1.0, 0.02, 0), (0.02, 0.3, 1), (0.3, 0.7, 5), (0.7, 1.4, 10), (1.4, 2.5, 20))
# fixed values: mirror positions below which each body part lies, in rising order
BODY_PARTS = ((-1.15, "zero"), (-0.53, "front"), (-0.5, "head"), (-0.48, "cc"), (-0.45, "thorax"))


def tidy(x: Column, digits: int = 6) -> Column:
    """Rounded, without a negative zero."""
    return F.round(x, digits) + F.lit(0.0)


def velocities(s0x: Column, s0y: Column, s1x: Column, s1y: Column) -> dict[str, Column]:
    """Forward, sideways and turning speed from two sensors at 45 degrees."""
    c = math.cos(math.radians(45))
    return {"vel_forw": -(s0y + s1y) * c, "vel_side": (s0y - s1y) * c, "vel_turn": (s0x + s1x) / 2}


def power_level(power: Column) -> Column:
    """A power's level; null counts as zero, powers outside all ranges as -1."""
    p, level = F.coalesce(power, F.lit(0.0)), F.lit(-1)
    for lo, hi, n in POWER_LEVELS:
        level = F.when((p >= lo) & (p < hi), n).otherwise(level)
    return level


def body_part(position: Column) -> Column:
    """The first part whose limit lies above the position; the limit between front and
    head belongs to neither."""
    part = F.lit("back")
    for limit, name in reversed(BODY_PARTS):
        part = F.when(position < limit, name).otherwise(part)
    return F.when(position == BODY_PARTS[1][0], "error").otherwise(part)


def angle(ax: Column, ay: Column, bx: Column, by: Column, cx: Column, cy: Column) -> Column:
    """Degrees at b between a and c; null where a side has no length."""
    ux, uy, vx, vy = ax - bx, ay - by, cx - bx, cy - by
    size = F.sqrt(ux * ux + uy * uy) * F.sqrt(vx * vx + vy * vy)
    cosine = (ux * vx + uy * vy) / F.nullif(size, F.lit(0.0))
    return F.degrees(F.acos(F.greatest(F.least(cosine, F.lit(1.0)), F.lit(-1.0))))


def distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return F.sqrt((ax - bx) * (ax - bx) + (ay - by) * (ay - by))


def relative_change(value: Column, base: Column, scale: float = 1.0) -> Column:
    """(value - base) / base * scale; 0 where the base is 0."""
    return F.when(base != 0, (value - base) / F.nullif(base, F.lit(0.0)) * scale).otherwise(0.0)


def entropy(probabilities: Column) -> Column:
    """-sum p ln p of an array; zero probabilities add nothing."""
    return F.aggregate(probabilities, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log(p)).otherwise(0.0))


def circle_arc(x: Column, y: Column, r: Column, height: int, n: int = 12) -> Column:
    """n points on the part of a circle that an image of that height shows, from one end
    of the arc to the other, as an array of (x, y), truncated to integers."""
    first = F.asin((height - y) / r)
    last = 3 * F.pi() - first
    turn = lambda i: first + i * (last - first) / (n - 1)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.struct((x - F.cos(turn(i)) * r).cast("int").alias("x"), (y - F.sin(turn(i)) * r).cast("int").alias("y")))


def experiment(name: Column) -> dict[str, Column]:
    """Date, genotype and fly number of a recording's directory name, with defaults."""
    return {
        "date": F.coalesce(F.substring(name, 1, 6).try_cast("int"), F.lit(123456)),
        "genotype": F.when(F.length(name) > 7, F.substring(name, 8, 1000)).otherwise("param"),
        "fly": F.coalesce(F.right(name, F.lit(1)).try_cast("int"), F.lit(0)),
    }


def condition_label(name: Column) -> Column:
    """A cohort's condition by what its name holds, in order of priority."""
    return F.when(name.contains("high caff"), "high caff").when(name.contains("low caff"), "low caff").when(name.contains("sucr"), "sucr").when(name.contains("starv"), "starv").otherwise("none")


# fixed values: what notes of an experiment hold, in the order in which it counts, and the condition it means
CONDITIONS = (("high caff", "high caffeine"), ("low caff", "low caffeine"), ("sucr", "sucrose"), ("starv", "starved"))


def cohort_condition(notes: Column) -> Column:
    """The condition that notes tell, empty for none."""
    found = F.lit("")
    for word, condition in reversed(CONDITIONS):
        found = F.when(notes.contains(word), condition).otherwise(found)
    return found


def joined_each(paths: Column, *parts: str) -> Column:
    """Every path of a list with the same parts below it."""
    return F.transform(paths, lambda p: F.concat_ws("/", p, *map(F.lit, parts)))
