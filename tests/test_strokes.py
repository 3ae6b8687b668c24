import numpy as np
import pytest

from siftstone.operators import strokes as K
from siftstone.operators import tone as T

GLYPH = np.array([[1, 1, 1, 1, 1], [0, 0, 1, 0, 0], [1, 0, 1, 0, 1], [0, 1, 0, 1, 0], [1, 0, 0, 0, 1]], bool)


def written(image, x, y, n, scale=3, ink=20):
    glyph = np.kron(GLYPH, np.ones((scale, scale), bool))
    for k in range(n):
        part = image[y : y + len(glyph), x + k * (len(glyph) + 4) :][:, : len(glyph)]
        part[glyph] = ink
    return image


def test_strokes_against_definition():
    rng = np.random.default_rng(2)
    g = rng.integers(0, 256, (14, 17))
    least = lambda v: np.array([[v[max(0, y - 2) : y + 3, max(0, x - 2) : x + 3].min() for x in range(17)] for y in range(14)])
    most = lambda v: -least(-v)
    s = K.strokes(g, 5)
    assert (s["dark"] == least(most(g)) - g).all() and (s["light"] == g - most(least(g))).all()


def test_ghost_text():
    label = (200, 500, 500, 800)
    clean = np.full((1000, 700), 200, np.uint8)
    assert K.ghost_text(clean, label) == {"verdict": "PASS", "region": (125, 320, 575, 800), "lines": []}
    above = written(clean.copy(), 250, 400, 5)
    got = K.ghost_text(above, label)
    assert got["verdict"] == "FAIL" and max(f["n"] for f in got["lines"]) >= 3 and any(f["kind"] == "dark" and f["text"] for f in got["lines"])
    assert K.ghost_text(written(clean.copy(), 250, 600, 5), label)["verdict"] == "PASS"  # on the label
    assert K.ghost_text(written(clean.copy(), 250, 200, 5), label)["verdict"] == "PASS"  # beyond the region
    assert K.ghost_text(written(clean.copy(), 250, 400, 5, ink=165), label)["verdict"] == "PASS"  # too faint
    assert K.entropy(np.zeros((9, 9))) == 0 and K.entropy(np.tile([0, 0, 255, 255], (16, 8))) < 0.1


def test_chains(spark):
    boxes = np.array([[0, 0, 10, 10], [12, 1, 22, 11], [24, 0, 34, 10], [13, 40, 23, 50], [60, 0, 70, 10], [36, 0, 46, 30]])
    assert K.chains(boxes) == [[0, 1, 2], [3], [5], [4]] and K.chains(np.empty((0, 4))) == []
    rows = [(img, 10 * i, *map(int, b)) for img in (1, 2) for i, b in enumerate(boxes)] + [(3, 5, 0, 0, 1, 1)]
    got = K.chained(spark.createDataFrame(rows, "img long, id long, x0 int, y0 int, x1 int, y1 int").repartition(3)).collect()
    expected = {(0, 0, 0), (10, 0, 1), (20, 0, 2), (30, 30, 0), (50, 50, 0), (40, 40, 0)}
    assert {tuple(r) for r in got} == {(i, *e) for i in (1, 2) for e in expected} | {(3, 5, 5, 0)}


def test_tone_and_sharpness():
    rng = np.random.default_rng(4)
    rgb = rng.integers(0, 256, (30, 40, 3)).astype(np.uint8)
    assert np.abs(T.from_lab(T.to_lab(rgb)).astype(int) - rgb).max() <= 1
    assert T.to_lab(np.array([[[255, 255, 255], [0, 0, 0]]])) == pytest.approx(np.array([[[255, 128, 128], [0, 128, 128]]]), abs=0.1)
    every, dark = np.ones((30, 40), bool), (rgb // 4).astype(np.uint8)
    moved = T.match_tone(rgb, every, dark, every)
    before, after, wanted = (T.to_lab(v)[..., 0].mean() for v in (rgb, moved, dark))
    assert wanted < after < before and (T.match_tone(rgb, ~every, dark, every) == rgb).all()
    soft = np.rint(T.blur(rgb, 0.8)).astype(np.uint8)
    assert T.match_sharpness(rgb, every, soft, every)[1] == pytest.approx(0.8, abs=0.11) and T.match_sharpness(soft, every, rgb, every)[1] == 0
    assert T.grain(np.full((20, 20), 7.0)) == 0 and 4 < T.grain(rng.normal(100, 6, (80, 80))) < 8
    alpha = np.zeros((10, 10))
    alpha[2:8, 2:8] = 1
    out = T.paste(np.full((10, 10, 3), 9, np.uint8), alpha, np.full((30, 30, 3), 200, np.uint8), -4, 20)
    assert (out[:18] == 200).all() and (out[24, 1] == 9).all() and T.paste(out[:5, :5], np.ones((5, 5)), out, 90, 0).shape == out.shape
