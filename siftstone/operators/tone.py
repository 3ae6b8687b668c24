"""Light, colour and sharpness of a product that is set into a scene, on decoded images."""

from __future__ import annotations

import numpy as np

from siftstone.operators.photo import erode, gray

# How far light and colour follow the scene, by how much contrast may change, and how far blurring goes.
LIGHT, COLOUR, CONTRAST, BLUR, BLUR_STEP = 0.8, 0.6, (0.6, 1.4), 1.0, 0.1
# sRGB (D65) to XYZ.
_XYZ = np.array([[0.412453, 0.357580, 0.180423], [0.212671, 0.715160, 0.072169], [0.019334, 0.119193, 0.950227]])
_WHITE = _XYZ.sum(axis=1)


def to_lab(rgb: np.ndarray) -> np.ndarray:
    """CIE L*a*b*, scaled to 0-255 and centred on 128."""
    v = rgb / 255.0
    v = np.where(v > 0.04045, ((v + 0.055) / 1.055) ** 2.4, v / 12.92) @ _XYZ.T / _WHITE
    f = np.where(v > 0.008856, np.cbrt(v), 7.787 * v + 16 / 116)
    x, y, z = np.moveaxis(f, -1, 0)
    return np.stack([(116 * y - 16) * 2.55, 500 * (x - y) + 128, 200 * (y - z) + 128], axis=-1)


def from_lab(lab: np.ndarray) -> np.ndarray:
    y = (lab[..., 0] / 2.55 + 16) / 116
    f = np.stack([y + (lab[..., 1] - 128) / 500, y, y - (lab[..., 2] - 128) / 200], axis=-1)
    v = np.clip(np.where(f > 0.206893, f**3, (f - 16 / 116) / 7.787) * _WHITE @ np.linalg.inv(_XYZ).T, 0, 1)
    return np.rint(np.where(v > 0.0031308, 1.055 * v ** (1 / 2.4) - 0.055, 12.92 * v) * 255).astype(np.uint8)


def match_tone(rgb: np.ndarray, mask: np.ndarray, scene: np.ndarray, around: np.ndarray) -> np.ndarray:
    """rgb with mean and spread of its masked part moved part of the way to those of the scene around it."""
    if not mask.any() or not around.any():
        return rgb
    lab, to = to_lab(rgb), to_lab(scene)[around]
    mean, spread, amount = lab[mask].mean(axis=0), lab[mask].std(axis=0) + 1e-6, np.array([LIGHT, COLOUR, COLOUR])
    scale = 1 + amount * (np.clip((to.std(axis=0) + 1e-6) / spread, *CONTRAST) - 1)
    return from_lab(np.clip((lab - mean) * scale + mean + amount * (to.mean(axis=0) - mean), 0, 255))


def blur(v: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian, an axis at a time, mirrored at the edges."""
    if sigma <= 0:
        return v.astype(float)
    r = max(1, round(3 * sigma))
    weights = np.exp(-(np.arange(-r, r + 1) ** 2) / (2 * sigma**2))
    weights, v = weights / weights.sum(), v.astype(float)
    for axis in (0, 1):
        pad = [(r, r) if a == axis else (0, 0) for a in range(v.ndim)]
        n = v.shape[axis]
        p = np.pad(v, pad, mode="reflect" if n > r else "edge")
        v = sum(w * np.take(p, range(k, k + n), axis=axis) for k, w in enumerate(weights))
    return v


def detail(grey: np.ndarray, mask: np.ndarray | None = None) -> float:
    """Mean square of the second derivative (diagonal neighbours, doubled)."""
    p = np.pad(grey.astype(float), 1, mode="reflect")
    v = (2 * (p[:-2, :-2] + p[:-2, 2:] + p[2:, :-2] + p[2:, 2:]) - 8 * p[1:-1, 1:-1]) ** 2
    v = v if mask is None else v[mask]
    return float(v.mean()) if v.size else 0.0


def grain(grey: np.ndarray, mask: np.ndarray | None = None) -> float:
    """Spread of the noise, by the median absolute deviation, which edges move little."""
    v = grey - blur(grey, 1.2)
    v = v.ravel() if mask is None else v[mask]
    return float(1.4826 * np.median(np.abs(v - np.median(v)))) if v.size else 0.0


def match_sharpness(rgb: np.ndarray, mask: np.ndarray, scene: np.ndarray, around: np.ndarray) -> tuple[np.ndarray, float]:
    """(rgb blurred so that its detail is nearest the scene's, the width of the blur); outlines are left out of the measure."""
    inner, g = erode(mask, 5), gray(rgb)
    wanted = detail(gray(scene), erode(around, 5))
    widths = [0.0, *np.round(np.arange(0.2, BLUR + 1e-6, BLUR_STEP), 2)]
    best = min(widths, key=lambda s: abs(np.log((detail(blur(g, s), inner) + 1) / (wanted + 1))))
    return (np.rint(blur(rgb, best)).astype(np.uint8) if best else rgb), float(best)


def paste(rgb: np.ndarray, alpha: np.ndarray, scene: np.ndarray, x: int, y: int, feather: float = 0.8) -> np.ndarray:
    """The scene with the product on it, its edge softened; what lies outside of the scene is cut."""
    out, (h, w) = scene.astype(float), scene.shape[:2]
    x0, y0, x1, y1 = max(x, 0), max(y, 0), min(x + rgb.shape[1], w), min(y + rgb.shape[0], h)
    if x1 > x0 and y1 > y0:
        part = (slice(y0 - y, y1 - y), slice(x0 - x, x1 - x))
        a = np.clip(blur(alpha.astype(float), feather), 0, 1)[part][..., None]
        out[y0:y1, x0:x1] = rgb[part] * a + out[y0:y1, x0:x1] * (1 - a)
    return np.rint(out).astype(np.uint8)
