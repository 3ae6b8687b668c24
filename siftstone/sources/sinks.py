"""Sinks: CSV with a byte order mark, Markdown, JSON lines and text packages, written by tasks and committed as a whole (commit.py)."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftstone.sources import commit


def write_csv(df: DataFrame, path: str) -> None:
    """UTF-8 with a byte order mark, as spreadsheet programs want it."""
    commit.save(df, path, "csv")


def write_markdown(df: DataFrame, path: str, title: str) -> None:
    commit.save(df, path, "markdown", title=title)


def write_json_lines(df: DataFrame, path: str) -> None:
    commit.save(df.select("json"), path, "lines")


def write_package(files: DataFrame, folder: str, protected: str | None = None) -> int:
    """The texts of files (path, text) below folder, UTF-8 with plain line ends; a protected folder is never written to."""
    root = Path(folder).resolve()
    if protected and root.is_relative_to(Path(protected).resolve()):
        raise ValueError(f"{folder} lies in {protected}")
    for r in files.filter(F.col("path").rlike(r"^/|(^|/)\.\.(/|$)")).select("path").take(1):  # the tasks look again
        raise ValueError(f"{r['path']} leads out of {folder}")
    commit.save(files.select("path", "text"), str(root), "package")
    return files.count()


def remove_outputs(folder: str, names: Iterable[str]) -> None:
    """After a fatal error nothing of an earlier run is left to be taken for this one's."""
    for name in names:
        Path(folder, name).unlink(missing_ok=True)


def encode_png(rgb: np.ndarray) -> bytes:
    """An H x W x 3 (or 4) array as a PNG file, lossless."""
    h, w, c = rgb.shape
    chunk = lambda name, data: struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))
    rows = np.concatenate([np.zeros((h, 1), np.uint8), rgb.astype(np.uint8).reshape(h, w * c)], axis=1)
    head = struct.pack(">IIBBBBB", w, h, 8, {3: 2, 4: 6}[c], 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows.tobytes(), 6)) + chunk(b"IEND", b"")


def draw_box(rgb: np.ndarray, box: tuple[int, int, int, int], colour: tuple[int, int, int], thick: int = 2) -> np.ndarray:
    """A copy with the frame of a box (far edges exclusive), drawn inwards and cut to the image."""
    out, (h, w) = rgb.copy(), rgb.shape[:2]
    x0, y0, x1, y1 = (min(max(v, 0), most) for v, most in zip(box, (w, h, w, h), strict=True))
    for rows, columns in ((slice(y0, min(y0 + thick, y1)), slice(x0, x1)), (slice(max(y1 - thick, y0), y1), slice(x0, x1)), (slice(y0, y1), slice(x0, min(x0 + thick, x1))), (slice(y0, y1), slice(max(x1 - thick, x0), x1))):
        out[rows, columns] = colour
    return out
