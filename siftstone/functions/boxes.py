"""Geometry of boxes, struct<x0,y0,x1,y1> with the far edges exclusive, and of zooms: Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"))


def from_xywh(b: Column) -> Column:
    return box(b["x"], b["y"], b["x"] + b["w"], b["y"] + b["h"])


def gap(a: Column, b: Column) -> Column:
    """Euclidean distance of two boxes, 0 if they touch or overlap."""
    dx = F.greatest(F.lit(0), b["x0"] - a["x1"], a["x0"] - b["x1"])
    dy = F.greatest(F.lit(0), b["y0"] - a["y1"], a["y0"] - b["y1"])
    return F.sqrt((dx * dx + dy * dy).cast("double"))


def area(b: Column) -> Column:
    return (b["x1"] - b["x0"]) * (b["y1"] - b["y0"])


def iou(a: Column, b: Column) -> Column:
    w = F.greatest(F.lit(0), F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"]))
    h = F.greatest(F.lit(0), F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"]))
    union = area(a) + area(b) - w * h
    return F.when(union > 0, (w * h).cast("double") / union).otherwise(F.lit(0.0))


def clip(b: Column, width: Column, height: Column) -> Column:
    """Rounded half to even, then cut to the image."""
    inside = lambda v, most: F.least(F.greatest(F.bround(v).cast("int"), F.lit(0)), most)
    return box(inside(b["x0"], width), inside(b["y0"], height), inside(b["x1"], width), inside(b["y1"], height))


def expand(b: Column, width: Column, height: Column, up: float = 0.0, down: float = 0.0, left: float = 0.0, right: float = 0.0, pad: int = 0) -> Column:
    """Grown by shares of its own size and by pad pixels, then clipped."""
    w, h = b["x1"] - b["x0"], b["y1"] - b["y0"]
    return clip(box(b["x0"] - w * left - pad, b["y0"] - h * up - pad, b["x1"] + w * right + pad, b["y1"] + h * down + pad), width, height)


def zoom_window(scene_w: Column, scene_h: Column, z0: Column, z1: Column, cx: Column, cy: Column, n: Column, i: Column) -> Column:
    """struct<x,y,z>: the window that frame i of n shows, its zoom linear from z0 to z1, kept inside the scene."""
    z = z0 + (z1 - z0) * i / F.greatest(n - 1, F.lit(1))
    x = F.least(F.greatest(scene_w * cx - scene_w / z / 2, F.lit(0.0)), scene_w - scene_w / z)
    y = F.least(F.greatest(scene_h * cy - scene_h / z / 2, F.lit(0.0)), scene_h - scene_h / z)
    return F.struct(x.alias("x"), y.alias("y"), z.alias("z"))


def map_point(px: Column, py: Column, window: Column, scene_w: Column, scene_h: Column, out_w: int, out_h: int) -> Column:
    """Where a scene point lies in an output frame of the window."""
    return F.struct(((px - window["x"]) * window["z"] * out_w / scene_w).alias("x"), ((py - window["y"]) * window["z"] * out_h / scene_h).alias("y"))


def map_quad(quad: Column, window: Column, scene_w: Column, scene_h: Column, out_w: int, out_h: int) -> Column:
    """The corners (array of struct<x,y>) of a quad in an output frame of the window."""
    return F.transform(quad, lambda p: map_point(p["x"], p["y"], window, scene_w, scene_h, out_w, out_h))


def quad_box(quad: Column) -> Column:
    """The least box around a quad's corners."""
    x, y = F.transform(quad, lambda p: p["x"]), F.transform(quad, lambda p: p["y"])
    return box(F.array_min(x), F.array_min(y), F.array_max(x), F.array_max(y))


def floor_even(v: Column) -> Column:
    whole = F.floor(v).cast("long")
    return whole - F.pmod(whole, F.lit(2))


def fit_inside(iw: Column, ih: Column, w: Column, h: Column) -> Column:
    """struct<w,h>: the image scaled to fit w x h with its aspect kept, the other side rounded half up."""
    by_width = iw * h >= ih * w
    scaled = lambda a, b, c: F.floor((2 * a * b + c) / (2 * c)).cast("long")
    return F.struct(F.when(by_width, w).otherwise(scaled(iw, h, ih)).alias("w"), F.when(by_width, scaled(ih, w, iw)).otherwise(h).alias("h"))


def label_json(entries: DataFrame, name: str, frame: str, box: str, note: str) -> DataFrame:
    """(name, json) of entries: one document per name, its boxes under name@frame and again, in order, as _frames."""
    g = entries.groupBy(name).agg(F.array_sort(F.collect_list(F.struct(F.col(frame).alias("frame"), F.col(box).alias("box")))).alias("frames"))
    keyed = F.to_json(F.map_from_entries(F.transform("frames", lambda e: F.struct(F.concat(F.col(name), F.lit("@"), e["frame"].cast("string")), e["box"]))))
    head = F.to_json(F.struct(F.lit(note).alias("_note")))
    return g.select(name, F.concat(F.rtrim(head, F.lit("}")), F.lit(","), F.substr(keyed, F.lit(2), F.length(keyed) - 2), F.lit(',"_frames":'), F.to_json("frames"), F.lit("}")).alias("json"))
