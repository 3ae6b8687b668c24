"""End cards: where the product photo goes beside the watermark, and how far it is from it on finished frames."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftstone.functions import boxes as B
from siftstone.functions.parse import once
from siftstone.operators import images as I

# The card and what is on it, in pixels (boxes with far edges exclusive), and seconds.
WIDTH, HEIGHT, WATERMARK, LEAST_GAP, SPARE = 1080, 1920, (130, 260, 380, 370), 20, 2
PHOTO_WIDTH, PHOTO_HEIGHT, PHOTO_BOTTOM, CALL, CALL_CLEAR, CALL_ZONE, SMALLEST = 900, 1000, 1290, 1390, 90, 80, 50
COLOUR, COLOUR_NEAR, TOLERANCE, HALO, SPECK = (234, 244, 251), 8, 10, 4, 150
SETTLED, LOCKED = 0.9, 1.0


def _even(v: Column) -> Column:
    return F.floor(v / 2).cast("long") * 2


def _percent(v: Column, share: Column) -> Column:
    """share per cent of v, rounded half to even in whole numbers."""
    n = v * share
    q, r = F.floor(n / 100).cast("long"), n % 100
    return q + ((r > 50) | ((r == 50) & (q % 2 == 1))).cast("long")


def layout(photos: DataFrame, card_width: int = PHOTO_WIDTH, call: int = CALL, least_gap: int = LEAST_GAP, spare: int = SPARE) -> DataFrame:
    """photos (width, height and opaque: the box of what is not clear, in its pixels) with place: where each goes.

    In this order, the first that keeps the gap: as it would stand anyway, moved
    down as little as possible, or moved down to the call for action and shrunk
    by whole per cents.  The choices are an array in the row, so nothing is
    shuffled.  ok is false if not even half the size helps; the rest is null then.
    """
    need, (wx0, wy0, wx1, wy1) = least_gap + spare, WATERMARK
    watermark = B.box(*[F.lit(v).cast("long") for v in WATERMARK])
    o, iw, ih = F.col("opaque"), F.col("width").cast("long"), F.col("height").cast("long")
    size = B.fit_inside(iw, ih, F.lit(card_width).cast("long"), F.lit(PHOTO_HEIGHT).cast("long"))

    def put(w: Column, h: Column, y: Column, how: str, share: Column) -> Column:
        low = lambda v, to, of: F.floor(v * to / of).cast("long")
        high = lambda v, to, of: F.ceil(v * to / of).cast("long")
        box = lambda left: B.box(left + low(o["x0"], w, iw), y + low(o["y0"], h, ih), left + high(o["x1"], w, iw), y + high(o["y1"], h, ih))
        stood = lambda left, b: F.struct(F.lit(how).alias("how"), share.cast("int").alias("percent"), w.alias("w"), h.alias("h"), left.alias("x"), y.alias("y"), b.alias("box"), B.gap(b, watermark).alias("gap"))
        return once(_even(F.floor((WIDTH - w) / 2).cast("long")), lambda left: once(box(left), lambda b: stood(left, b)))

    apart = lambda b: F.greatest(F.lit(0), F.lit(wx0) - b["x1"], b["x0"] - F.lit(wx1))
    reach = lambda b: F.sqrt(F.greatest(F.lit(need * need) - apart(b) * apart(b), F.lit(0)).cast("double"))
    p = photos.withColumn("__s", once(size, lambda s: s)).withColumn("__a", put(F.col("__s.w"), F.col("__s.h"), _even(PHOTO_BOTTOM - F.col("__s.h")), "default", F.lit(100)))
    a = F.col("__a")
    floor = F.greatest(F.lit(call - CALL_CLEAR), a["box"]["y1"])
    down = a["y"] + F.ceil(wy1 + reach(a["box"]) - a["box"]["y0"]).cast("long")
    p = p.withColumn("__f", floor).withColumn("__m", once(down, lambda d: once(d + F.pmod(d, F.lit(2)), lambda y: put(a["w"], a["h"], y, "down", F.lit(100)))))

    def shrunk(k: Column) -> Column:
        at_least = lambda side: F.greatest(_percent(a[side], 100 - k), F.lit(1)).alias(side)
        top = lambda h: _even(F.col("__f") - F.ceil(o["y1"] * h / ih).cast("long"))
        return once(F.struct(at_least("w"), at_least("h")), lambda s: once(top(s["h"]), lambda y: put(s["w"], s["h"], y, "shrunk", 100 - k)))

    wide = lambda c: c["gap"] >= need
    moved = F.filter(F.array(F.col("__m")), lambda c: wide(c) & (c["box"]["y1"] <= F.col("__f")))
    smaller = F.filter(F.transform(F.sequence(F.lit(1), F.lit(100 - SMALLEST)), shrunk), wide)
    # Smaller sizes are tried only where the two others don't do.
    p = p.withColumn("__c", F.coalesce(F.when(wide(a), a), F.get(moved, F.lit(0)), F.get(smaller, F.lit(0))))
    c = F.col("__c")
    # While it bounces it may come as high as this.
    highest = F.when(apart(c["box"]) < need, _even(F.ceil(wy1 + reach(c["box"]) - (c["box"]["y0"] - c["y"])).cast("long") + 1))
    place = F.struct(c.isNotNull().alias("ok"), c["how"].alias("how"), c["percent"].alias("percent"), (c["y"] - a["y"]).alias("moved"), c["w"].alias("w"), c["h"].alias("h"), c["x"].alias("x"), c["y"].alias("y"), c["box"].alias("box"), c["gap"].alias("gap"), highest.alias("y_min"))
    return p.withColumn("place", place).drop("__s", "__a", "__f", "__m", "__c")


def opaque(rgb: np.ndarray, alpha: np.ndarray | None, keyed: bool) -> tuple[int, int, int, int] | None:
    """The box of what is not clear: not near white (keyed), or not transparent; None if all is."""
    if keyed:
        mask = np.sqrt(((rgb.astype(float) - 255) ** 2).sum(axis=2) / (3 * 255.0**2)) > 0.08
    else:
        mask = np.ones(rgb.shape[:2], bool) if alpha is None else alpha > 0
    ys, xs = np.flatnonzero(mask.any(axis=1)), np.flatnonzero(mask.any(axis=0))
    return (int(xs[0]), int(ys[0]), int(xs[-1]) + 1, int(ys[-1]) + 1) if len(ys) else None


def frame_gap(rgb: np.ndarray, call: int = CALL) -> dict:
    """status (ok, or why the frame is no settled card), box of the product and its gap to the watermark."""
    none = {"box": None, "gap": None}
    if rgb.shape[:2] != (HEIGHT, WIDTH):
        return {"status": "size", **none}
    bg = np.median(rgb.reshape(-1, 3), axis=0)
    if np.abs(bg - COLOUR).max() > COLOUR_NEAR:
        return {"status": "background", **none}
    x0, y0, x1, y1 = WATERMARK
    shown = np.abs(rgb - bg).max(axis=2) > TOLERANCE
    shown[max(0, y0 - HALO) : y1 + HALO, max(0, x0 - HALO) : x1 + HALO] = False
    parts = [s for s in I.components(shown)[1] if s["area"] >= SPECK]
    if any(s["x0"] == 0 or s["y0"] == 0 or s["x1"] == WIDTH or s["y1"] == HEIGHT for s in parts):
        return {"status": "edge", **none}
    product = [s for s in parts if s["y0"] < call - CALL_ZONE]
    if not product:
        return {"status": "no product", **none}
    b = min(s["x0"] for s in product), min(s["y0"] for s in product), max(s["x1"] for s in product), max(s["y1"] for s in product)
    return {"status": "ok", "box": b, "gap": float(np.hypot(max(0, x0 - b[2], b[0] - x1), max(0, y0 - b[3], b[1] - y1)))}


def card_verdicts(frames: DataFrame, key: str, least_gap: int = LEAST_GAP) -> DataFrame:
    """(key, verdict, gap, bounce_gap, warn) of frames (key, since: seconds from the card's start, status, gap).

    The frame at LOCKED decides: PASS, FAIL, or NONE if it can't be measured;
    those up to SETTLED, while the photo bounces, only warn.
    """
    hard = F.abs(F.col("since") - LOCKED) < 1e-6
    soft = (F.col("since") >= 0) & (F.col("since") <= SETTLED + 1e-6) & (F.col("status") == "ok")
    g = frames.groupBy(key).agg(F.min(F.when(hard & (F.col("status") == "ok"), F.col("gap"))).alias("gap"), F.count_if(hard & (F.col("status") != "ok")).alias("bad"), F.min(F.when(soft, F.col("gap"))).alias("bounce_gap"))
    verdict = F.when(F.col("gap").isNull() | (F.col("bad") > 0), "NONE").when(F.col("gap") >= least_gap, "PASS").otherwise("FAIL")
    return g.select(key, verdict.alias("verdict"), "gap", "bounce_gap", F.coalesce(F.col("bounce_gap") < least_gap, F.lit(False)).alias("warn"))
