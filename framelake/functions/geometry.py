"""Boxes, cameras, eyes and gaze as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from framelake import constants as K
from framelake.functions.arrays import bound_to


def eye_aspect_ratio(points: Column, six: tuple[int, ...]) -> Column:
    """points: array of struct(x, y), counted from 0. 0 where the eye's width is under 1e-6."""
    p = [F.get(points, F.lit(i)) for i in six]
    gap = lambda a, b: F.sqrt((a["x"] - b["x"]) ** 2 + (a["y"] - b["y"]) ** 2)
    width = gap(p[0], p[3])
    return F.when(width < 1e-6, 0.0).otherwise((gap(p[1], p[5]) + gap(p[2], p[4])) / (2 * width))


def landmarks_to_px(points: Column, sx: Column, sy: Column, ox: Column | float = 0.0, oy: Column | float = 0.0) -> Column:
    return F.transform(points, lambda p: F.struct((p["x"] * sx + ox).alias("x"), (p["y"] * sy + oy).alias("y")))


def landmark_box(points: Column, margin: float = 0.15) -> Column:
    """struct(x1, y1, x2, y2) around the points, wider by margin of its sides."""

    def made(b: Column) -> Column:
        w, h = b["x2"] - b["x1"], b["y2"] - b["y1"]
        return F.struct((b["x1"] - margin * w).alias("x1"), (b["y1"] - margin * h).alias("y1"), (b["x2"] + margin * w).alias("x2"), (b["y2"] + margin * h).alias("y2"))

    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return bound_to(F.struct(F.array_min(xs).alias("x1"), F.array_min(ys).alias("y1"), F.array_max(xs).alias("x2"), F.array_max(ys).alias("y2")), made)


def expand_bbox(x1: Column, y1: Column, x2: Column, y2: Column, scale: float = K.BBOX_SCALE) -> tuple[Column, ...]:
    """About the centre."""
    cx, cy, w, h = (x1 + x2) / 2, (y1 + y2) / 2, (x2 - x1) * scale / 2, (y2 - y1) * scale / 2
    return cx - w, cy - h, cx + w, cy + h


def roi_from_bbox(x1: Column, y1: Column, x2: Column, y2: Column, w: Column, h: Column) -> Column:
    """struct of whole numbers: a square about the box, at least ROI_MIN_PX wide, cut at the frame; null if under 16 pixels."""
    cx, cy = (x1 + x2) / 2, (y1 + y2) / 2
    half = F.greatest(F.greatest(x2 - x1, y2 - y1) * K.ROI_SCALE, F.lit(K.ROI_MIN_PX)) / 2
    a, b = F.greatest(F.lit(0.0), cx - half).cast("int"), F.greatest(F.lit(0.0), cy - half).cast("int")
    c, d = F.least(w.cast("double"), cx + half).cast("int"), F.least(h.cast("double"), cy + half).cast("int")
    return F.when((c - a >= K.ROI_DEGENERATE) & (d - b >= K.ROI_DEGENERATE), F.struct(a.alias("x1"), b.alias("y1"), c.alias("x2"), d.alias("y2")))


def crop_geometry(x1: Column, y1: Column, x2: Column, y2: Column, w: Column, h: Column) -> Column:
    """struct: the square about the box, and how far it lies beyond each side of the frame."""
    size = F.greatest(x2 - x1, y2 - y1)
    a, b = ((x1 + x2) / 2 - size / 2).cast("int"), ((y1 + y2) / 2 - size / 2).cast("int")
    c, d = a + size.cast("int"), b + size.cast("int")
    zero = F.lit(0)
    return F.struct(a.alias("x1"), b.alias("y1"), c.alias("x2"), d.alias("y2"), F.greatest(zero, -a).alias("left"), F.greatest(zero, -b).alias("top"), F.greatest(zero, c - w).alias("right"), F.greatest(zero, d - h).alias("bottom"))


def decode_binned_angle(logits: Column, width: float = K.GAZE_WIDTH, offset: float = K.GAZE_OFFSET) -> Column:
    """Expectation of the softmax over bins, in radians."""

    def made(e: Column) -> Column:
        top = F.aggregate(F.transform(e, lambda x, i: x * i), F.lit(0.0), lambda a, x: a + x)
        return F.radians(top / F.aggregate(e, F.lit(0.0), lambda a, x: a + x) * width + offset)

    return bound_to(bound_to(logits, lambda v: F.transform(v, lambda x: F.exp(x - F.array_max(v)))), made)


def gaze_arrow_end(x: Column, y: Column, pitch: Column, yaw: Column, length: float = 150.0) -> tuple[Column, Column]:
    a, b = x.cast("int"), y.cast("int")
    return (a - length * F.sin(yaw) * F.cos(pitch)).cast("int"), (b - length * F.sin(pitch)).cast("int")


def ortho_to_persp(s: Column, tx: Column, ty: Column, box: tuple[Column, ...], focal: Column, w: Column, h: Column) -> tuple[Column, Column, Column]:
    """A weak-perspective camera over a box as a translation in the whole frame."""
    x1, y1, x2, y2 = box
    bs = F.greatest(x2 - x1, y2 - y1) * s + 1e-9
    return 2 * ((x1 + x2) / 2 - w / 2) / bs + tx / s, 2 * ((y1 + y2) / 2 - h / 2) / bs + ty / s, 2 * focal / bs


def project_point(x: Column, y: Column, z: Column, fx: Column, fy: Column, cx: Column, cy: Column) -> tuple[Column, Column]:
    """Null behind the camera."""
    return F.when(z > 0, x / z * fx + cx), F.when(z > 0, y / z * fy + cy)


def image_size_from_k(cx: Column, cy: Column) -> tuple[Column, Column]:
    return (2 * cx).cast("int"), (2 * cy).cast("int")
