"""Measures of product photos, as verdicts.rules and verdicts.delegated read them: numpy on one decoded image.

The parts of the foreground are told apart as rows of a frame (role: object,
strong or faint mark), and what the product is follows from the roles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from siftstone.operators import images as I

# What is an object, a mark, a character, a side face, a band or a bar.
ALPHA, TOLERANCE, OBJECT, SPECK, FAINT, MARK_GAP, CHAR_HEIGHT, LINE = 128, 14, 0.03, 12, 110, 4, (6, 0.12), 3
EDGE_SHARE, FACE_SPAN, FACE_STEP, FACE_FRAC, FACE_MARGIN = 0.04, 0.60, 15, 0.06, 0.04
BAND_DIFF, BAR_ROW, BAR_HEIGHT, BAR_TEXT, WIDER, WIDER_PX, BAND_HEIGHT, MARGIN = 60, 0.85, (0.02, 0.25), (0.02, 0.6), 0.03, 6, 0.30, 0.05
REPEAT_SIDE = 240
_SIDES = ("left", "above", "right", "below")


# ── masks ────────────────────────────────────────────────────────────────────
def dilate(mask: np.ndarray, k: int) -> np.ndarray:
    """By a k x k square (k odd), from sums over boxes."""
    s = np.pad(mask.astype(np.int32), k // 2).cumsum(0).cumsum(1)
    s = np.pad(s, ((1, 0), (1, 0)))
    return (s[k:, k:] - s[:-k, k:] - s[k:, :-k] + s[:-k, :-k]) > 0


def erode(mask: np.ndarray, k: int) -> np.ndarray:
    """What lies beyond the image takes nothing away."""
    return ~dilate(~mask, k)


def distance(mask: np.ndarray, ys: np.ndarray, xs: np.ndarray) -> np.ndarray:
    """Euclidean distance of points to the nearest pixel of mask: along each row first, then over the rows."""
    h, w = mask.shape
    at, far = np.arange(w), h + w + 1
    left = np.maximum.accumulate(np.where(mask, at, -far), axis=1)
    right = np.minimum.accumulate(np.where(mask, at, w + far)[:, ::-1], axis=1)[:, ::-1]
    along = np.minimum(at - left, right - at).astype(np.float64) ** 2
    rows, out = np.arange(h)[:, None], np.empty(len(ys))
    for i in range(0, len(ys), 256):
        out[i : i + 256] = np.sqrt((along[:, xs[i : i + 256]] + (rows - ys[i : i + 256]) ** 2).min(axis=0))
    return out


def spans(flags: np.ndarray, lo: int, hi: int) -> list[tuple[int, int]]:
    """Stretches of true flags within [lo, hi)."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags[lo:hi].astype(np.int8), [0]])))
    return [(lo + int(a), lo + int(b)) for a, b in zip(edge[::2], edge[1::2], strict=True)]


def sobel(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = np.pad(g.astype(np.float32), 1, mode="reflect" if min(g.shape) > 1 else "edge")
    down, across = p[:-2] + 2 * p[1:-1] + p[2:], p[:, :-2] + 2 * p[:, 1:-1] + p[:, 2:]
    return down[:, 2:] - down[:, :-2], across[2:] - across[:-2]


def gray(rgb: np.ndarray) -> np.ndarray:
    return np.rint(rgb @ np.array([0.299, 0.587, 0.114]))


# ── front view ───────────────────────────────────────────────────────────────
def outline(mask: np.ndarray) -> np.ndarray:
    """(x, y) of the border of the largest part, in order, by following neighbours clockwise."""
    labels, stats = I.components(mask)
    m = np.pad(labels == 1 + max(range(len(stats)), key=lambda k: stats[k]["area"]), 1)
    turn = [(0, 1), (1, 1), (1, 0), (1, -1), (0, -1), (-1, -1), (-1, 0), (-1, 1)]
    y, x = (int(v[0]) for v in np.nonzero(m))
    first, facing, path = None, 5, []
    while True:
        step = next((k % 8 for k in range(facing, facing + 8) if m[y + turn[k % 8][0], x + turn[k % 8][1]]), None)
        if step is None or (y, x, step) == first:  # a lone pixel, or round once
            return np.array(path or [(x - 1, y - 1)])
        first = first or (y, x, step)
        path.append((x - 1, y - 1))
        y, x, facing = y + turn[step][0], x + turn[step][1], step + 5


def corners(path: np.ndarray, slack: float) -> np.ndarray:
    """The points that a closed path keeps if none may move by more than slack."""
    n = len(path)
    ring = np.vstack([path, path[:1]]).astype(float)
    far = int(np.hypot(*(path - path[0]).T).argmax())
    keep, todo = {0, far}, [(0, far), (far, n)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        d, off = ring[b] - ring[a], ring[a + 1 : b] - ring[a]
        size = np.hypot(*d)
        away = np.abs(off[:, 0] * d[1] - off[:, 1] * d[0]) / size if size else np.hypot(*off.T)
        if away.max() > slack:
            k = a + 1 + int(away.argmax())
            keep.add(k)
            todo += [(a, k), (k, b)]
    return path[sorted(k % n for k in keep)]


def slant(mask: np.ndarray) -> float:
    """The largest angle to the axes, in degrees, of the long edges of the outline."""
    path = outline(mask)
    around = np.hypot(*(path - np.roll(path, 1, axis=0)).T).sum()
    p = corners(path, 0.01 * around)
    d = np.roll(p, -1, axis=0) - p
    angle = np.abs(np.degrees(np.arctan2(d[:, 1], d[:, 0]))) % 90
    long = np.hypot(d[:, 0], d[:, 1]) >= EDGE_SHARE * around
    return float(np.minimum(angle, 90 - angle)[long].max(initial=0.0))


def symmetry(mask: np.ndarray) -> float:
    """Overlap with the mirror image, intersection over union."""
    return float((mask & mask[:, ::-1]).sum() / max(1, (mask | mask[:, ::-1]).sum()))


def _through(inner: np.ndarray, g: np.ndarray, name: str) -> dict | None:
    """The strongest upright edge through the whole product, over all positions at once."""
    h, w = inner.shape
    win, total = max(4, int(min(h, w) * 0.03)), lambda v: np.concatenate([[0], v.sum(axis=0).cumsum()])
    light, count = total(g * inner), total(inner.astype(np.int64))
    grad = np.pad(np.abs(sobel(g)[0]), ((0, 0), (1, 1)))
    strong = np.maximum(np.maximum(grad[:, :-2], grad[:, 1:-1]), grad[:, 2:]) > 4 * FACE_STEP
    pos = np.arange(int(w * FACE_FRAC), int(w * (1 - FACE_FRAC)) + 1)
    pos = pos[(np.minimum(pos, w - pos) >= FACE_FRAC * w) & (pos < w)]
    a0, a1, b0, b1 = np.maximum(0, pos - win), np.maximum(1, pos - 2), np.minimum(w, pos + 2), np.minimum(w, pos + win)
    na, nb = count[a1] - count[a0], count[b1] - count[b0]
    step = np.abs((light[a1] - light[a0]) / np.maximum(na, 1) - (light[b1] - light[b0]) / np.maximum(nb, 1))
    span = (strong & inner)[:, pos].sum(axis=0) / h
    # A narrow face of more than 45 % is no side face.
    ok = (inner[:, pos].sum(axis=0) >= 0.5 * h) & (span >= FACE_SPAN) & (na > 0) & (nb > 0) & (step >= FACE_STEP) & (np.minimum(pos, w - pos) <= 0.45 * w)
    if not ok.any():
        return None
    k = int(np.where(ok, span * step, -1).argmax())
    return {"dir": name, "pos": int(pos[k]), "narrow": float(min(pos[k], w - pos[k]) / w), "span": float(span[k]), "diff": float(step[k])}


def second_face(mask: np.ndarray, g: np.ndarray) -> dict | None:
    """An edge through the product that parts it in two faces of different light; the strongest by span times difference."""
    margin = round(min(mask.shape) * FACE_MARGIN)
    inner = erode(mask, 2 * margin + 1) if margin else mask
    found = [f for f in (_through(inner, g, "upright"), _through(inner.T, g.T, "level")) if f]
    return max(found, key=lambda f: f["span"] * f["diff"], default=None)


# ── bands ────────────────────────────────────────────────────────────────────
def _inked(pixels: np.ndarray) -> float:
    """Share of the pixels that are far from the median colour."""
    return float((np.abs(pixels - np.median(pixels, axis=0)).max(axis=1) > BAND_DIFF).mean())


def protrusion(rgb: np.ndarray, mask: np.ndarray) -> dict | None:
    """A low band in the middle that stands out on both sides, as a strip of text across the outline does."""
    h, w = mask.shape
    rows = mask.any(axis=1)
    if rows.sum() < 10:
        return None
    left, right = mask.argmax(axis=1), w - 1 - mask[:, ::-1].argmax(axis=1)
    body = float(np.median(left[rows])), float(np.median(right[rows]))
    least = max(WIDER_PX, WIDER * w)
    out, lo, hi = rows & (left < body[0] - least) & (right > body[1] + least), int(h * MARGIN), int(h * (1 - MARGIN))
    ends = mask.copy()
    ends[:, int(body[0]) : int(body[1]) + 1] = False
    for a, b in spans(out, lo, hi):
        if a > lo and b < hi and b - a <= BAND_HEIGHT * h and ends[a:b].any():
            return {"y0": a, "y1": b, "out": int(min(body[0] - left[a:b].max(), right[a:b].min() - body[1])), "text": _inked(rgb[a:b][ends[a:b]].astype(int))}
    return None


def inner_bar(rgb: np.ndarray, mask: np.ndarray) -> dict | None:
    """A bar of another colour right across the product, with text in it."""
    h = len(mask)
    if not mask.any():
        return None
    other = (np.abs(rgb - np.median(rgb[mask], axis=0)).max(axis=2) > BAND_DIFF) & mask
    filled = mask.sum(axis=1)
    for a, b in spans((filled > 0) & (other.sum(axis=1) >= BAR_ROW * filled), int(h * MARGIN), int(h * (1 - MARGIN))):
        if BAR_HEIGHT[0] * h <= b - a <= BAR_HEIGHT[1] * h:
            text = _inked(rgb[a:b][mask[a:b]].astype(int))
            if BAR_TEXT[0] <= text <= BAR_TEXT[1]:
                return {"y0": a, "y1": b, "height": (b - a) / h, "text": text}
    return None


def repeat(g: np.ndarray, mask: np.ndarray) -> float:
    """Largest correlation of the edges with themselves, moved along an axis; large images are thinned by means of blocks."""
    k = -(-max(g.shape) // REPEAT_SIDE)
    if k > 1 and min(g.shape) >= 8 * k:
        h, w = g.shape[0] // k * k, g.shape[1] // k * k
        g = g[:h, :w].reshape(h // k, k, w // k, k).mean(axis=(1, 3))
        mask = mask[k // 2 : h : k, k // 2 : w : k]
    e, best = np.hypot(*sobel(g)) * mask, 0.0
    for m in (e, e.T):
        n = len(m)
        for lag in range(max(4, n // 8), n // 2 + 1):
            a, b = m[:-lag] - m[:-lag].mean(), m[lag:] - m[lag:].mean()
            size = np.sqrt((a * a).sum() * (b * b).sum())
            if size > 1e-6:
                best = max(best, float((a * b).sum() / size))
    return best


# ── marks and the product ────────────────────────────────────────────────────
def text_lines(boxes: np.ndarray) -> list[np.ndarray]:
    """Indices of boxes (x0, y0, x1, y1) that stand in one line: half of the lower height shared, gap up to 1.5 of the higher."""
    order = np.argsort(boxes[:, 0], kind="stable")
    b = boxes[order]
    tall = b[:, 3] - b[:, 1]
    until = np.searchsorted(b[:, 0], b[:, 2] + 1.5 * tall.max(initial=0), side="right")
    pairs = []
    for i in range(len(b)):
        j = np.arange(i + 1, max(until[i], i + 1))
        shared = np.minimum(b[i, 3], b[j, 3]) - np.maximum(b[i, 1], b[j, 1])
        j = j[(shared >= 0.5 * np.minimum(tall[i], tall[j])) & (b[j, 0] - b[i, 2] <= 1.5 * np.maximum(tall[i], tall[j]))]
        pairs.append(np.stack([np.full(len(j), i), j]))
    a, c = np.concatenate(pairs, axis=1) if pairs else np.empty((2, 0), int)
    root = I.joined(len(b), a.astype(int), c.astype(int))
    return [order[root == r] for r in np.unique(root)]


def _paint(kind: str, box: tuple, gap: int) -> dict:
    return {"kind": kind, "x0": int(box[0]), "y0": int(box[1]), "x1": int(box[2]), "y1": int(box[3]), "gap": gap}


_KINDS = {
    "path": "string", "readable": "boolean", "uniform": "double", "foreground": "long", "width": "int", "height": "int", "long_side": "int", "objects": "int", "solidity": "double", "at_edge": "boolean",
    "edges": "array<string>", "mark_gap": "int", "crosses_text": "boolean", "inner_text": "int", "bar": "double", "white": "double", "faint_marks": "int", "mark_sides": "int", "faint_gap": "int",
    "slant": "double", "rect": "double", "symmetry": "double", "second_face": "boolean", "inner_bar": "double", "repeat": "double", "paint": "array<struct<kind:string,x0:int,y0:int,x1:int,y1:int,gap:int>>",
}
MEASURES = ", ".join(f"`{n}` {k}" for n, k in _KINDS.items())


def flatten(rgb: np.ndarray, alpha: np.ndarray | None) -> tuple[np.ndarray, np.ndarray | None]:
    """The image on white; an alpha channel with nothing transparent in it is none."""
    if alpha is None or not (alpha <= ALPHA).any():
        return rgb, None
    a = alpha[..., None] / np.float32(255)
    return np.rint(rgb * a + 255 * (1 - a)).astype(np.uint8), alpha


def measure(path: str, rgb: np.ndarray | None, alpha: np.ndarray | None = None) -> dict:
    """The measures of one decoded image; None is unreadable.  What cannot be measured is null."""
    out = dict.fromkeys(_KINDS) | {"path": path, "readable": rgb is not None}
    if rgb is None:
        return out
    rgb, alpha = flatten(rgb, alpha)
    h, w = rgb.shape[:2]
    if alpha is None:
        bg, out["uniform"] = I.border_background(rgb, TOLERANCE)
        diff = np.abs(rgb.astype(int) - bg).max(axis=2)
        fg, near = I.foreground(rgb, bg, TOLERANCE), diff <= TOLERANCE
    else:
        fg = alpha > ALPHA
        diff, near = np.where(fg, 255, 0), ~fg
    total = out["foreground"] = int(fg.sum())
    if not total:
        return out

    labels, stats = I.components(fg)
    p = pd.DataFrame(stats, index=range(1, len(stats) + 1))
    p["diff"] = np.bincount(labels.ravel(), weights=diff.ravel())[1:] / p["area"]
    objects = p["area"] >= OBJECT * total
    if not objects.any():
        objects = p.index == p["area"].idxmax()
    o = p[objects]
    x0, y0, x1, y1 = o["x0"].min(), o["y0"].min(), o["x1"].max(), o["y1"].max()
    within = (p["x0"] >= x0) & (p["y0"] >= y0) & (p["x1"] <= x1) & (p["y1"] <= y1)
    marks = ~objects & (p["area"] >= SPECK)
    faint = marks & ~within & (p["diff"] <= FAINT) if alpha is None else marks & False
    strong = marks & ~faint
    tall = p["y1"] - p["y0"]
    chars = p[strong & (tall >= CHAR_HEIGHT[0]) & (tall <= CHAR_HEIGHT[1] * h)]

    box = ["x0", "y0", "x1", "y1"]
    sources, crossing, lined, inner = [], [], set(), 0
    for members in text_lines(chars[box].to_numpy()):
        if len(members) < LINE:
            continue
        c = chars.iloc[members]
        lined.update(c.index)
        line = int(c["x0"].min()), int(c["y0"].min()), int(c["x1"].max()), int(c["y1"].max())
        inside, beside = ((c["x0"] + c["x1"]) / 2).between(x0, x1), not y0 <= (line[1] + line[3]) / 2 <= y1
        if beside or not inside.any():
            sources.append(("text", line, list(c.index)))
        elif inside.all():
            inner += 1
        else:
            crossing += list(c.index)
    loose = p[strong & ~within & ~p.index.isin(list(lined))]
    sources += [("mark", tuple(int(r[b]) for b in box), [i]) for i, r in loose.iterrows()]

    keep = np.zeros(len(p) + 1, dtype=bool)
    keep[p.index[objects | (strong & (within | p.index.isin(crossing)))]] = True
    product = keep[labels]
    ys, xs = np.flatnonzero(product.any(axis=1)), np.flatnonzero(product.any(axis=0))
    x0, y0, x1, y1 = int(xs[0]), int(ys[0]), int(xs[-1]) + 1, int(ys[-1]) + 1
    area, (_, parts) = int(product.sum()), I.components(product)
    touched = [s for s, v in zip(_SIDES, (x0 <= 0, y0 <= 0, x1 >= w, y1 >= h), strict=True) if v]
    out |= {
        "width": x1 - x0, "height": y1 - y0, "long_side": max(x1 - x0, y1 - y0), "objects": sum(s["area"] >= OBJECT * area for s in parts), "solidity": area / max(I.hull_area(product), 1.0),
        "at_edge": bool(touched), "edges": touched, "crosses_text": bool(crossing), "inner_text": inner,
    }

    def gap(ids: list) -> int:
        """Clear pixels between the parts and the product."""
        return int(distance(product, *np.nonzero(np.isin(labels, ids))).min()) - 1

    paint, nearest = [], []
    for kind, b, ids in sources:
        g = gap(ids)
        nearest.append(g)
        if g >= MARK_GAP:
            e = min(3, (g - 1) // 2)
            wide = (max(0, b[0] - e), max(0, b[1] - e), min(w, b[2] + e), min(h, b[3] + e))
            paint.append(_paint(kind, b if product[wide[1] : wide[3], wide[0] : wide[2]].any() else wide, g))
    out["mark_gap"] = min(nearest, default=None)

    if alpha is None:
        out["white"] = float((near & product).sum() / area)
        f = p[faint]
        cx, cy = (f["x0"] + f["x1"]) / 2, (f["y0"] + f["y1"]) / 2
        out["faint_marks"], out["mark_sides"] = len(f), sum(bool(v.any()) for v in (cx < x0, cx > x1, cy < y0, cy > y1))
        if len(f):
            out["faint_gap"] = gap(list(f.index))
        if len(f) >= 6 and out["mark_sides"] < 3 and out["faint_gap"] >= MARK_GAP:
            paint.append(_paint("watermark", (f["x0"].min(), f["y0"].min(), f["x1"].max(), f["y1"].max()), out["faint_gap"]))
        elif len(f) < 6:
            spots = [(i, r, gap([i])) for i, r in f[f["area"] >= 0.0005 * h * w].iterrows()]
            paint += [_paint("pale spot", tuple(int(r[b]) for b in box), g) for i, r, g in spots if g >= MARK_GAP]
    out["paint"] = paint

    cut, mask, light = rgb[y0:y1, x0:x1], product[y0:y1, x0:x1], gray(rgb)[y0:y1, x0:x1]
    k = max(3, int(min(mask.shape) * 0.01) | 1)
    closed = erode(dilate(mask, k), k)
    band, bar = None if crossing else protrusion(cut, mask), inner_bar(cut, mask)
    return out | {
        "bar": band and band["text"], "inner_bar": bar and bar["height"], "slant": slant(closed), "rect": float(closed.mean()), "symmetry": symmetry(closed),
        "second_face": second_face(closed, light) is not None, "repeat": repeat(light, mask),
    }


def from_source(row) -> tuple[np.ndarray | None, np.ndarray | None]:
    """(rgb, alpha) of a row (height, width, channels, data) of Spark's image source, whose bytes are B, G, R and A."""
    if row.data is None or row.height is None or row.height <= 0 or row.channels not in (1, 3, 4):
        return None, None
    v = np.frombuffer(row.data, dtype=np.uint8).reshape(row.height, row.width, row.channels)
    rgb = np.repeat(v, 3, axis=2) if row.channels == 1 else v[..., 2::-1]
    return np.ascontiguousarray(rgb), v[..., 3] if row.channels == 4 else None


def measured(images: DataFrame, decode: Callable = from_source) -> DataFrame:
    """MEASURES of images (path and what decode reads of a row: by default readers.read_pixels()'s columns)."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([measure(r.path, *decode(r)) for r in b.itertuples()], columns=list(_KINDS))

    return images.mapInPandas(work, MEASURES)
