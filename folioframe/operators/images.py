"""Image kernels on page scans: array functions, and the DataFrame operators that run them, one image at a time, inside Arrow batches.

A grey image is a row with ``height``, ``width`` and ``pixels`` (BINARY, one byte per pixel, row by row).
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Head of a portable grey or colour map.
_MAP = re.compile(rb"^P([56])\s+(?:#[^\n]*\n\s*)*(\d+)\s+(\d+)\s+(\d+)\s")


def _box_mean(gray: np.ndarray, size: int) -> np.ndarray:
    """Mean over a square of ``size`` pixels around each pixel, by summed areas."""
    pad = size // 2
    wide = np.pad(gray.astype(float), pad + 1, mode="edge")
    total = wide.cumsum(0).cumsum(1)
    a, b = size, gray.shape
    return (total[a : a + b[0], a : a + b[1]] - total[: b[0], a : a + b[1]] - total[a : a + b[0], : b[1]] + total[: b[0], : b[1]]) / (a * a)


def threshold(gray: np.ndarray, size: int = 31, less: float = 2.0) -> np.ndarray:
    """Black and white: white where a pixel is brighter than the mean around it less ``less``."""
    return np.where(gray > _box_mean(gray, size) - less, 255, 0).astype(np.uint8)


def denoise(gray: np.ndarray) -> np.ndarray:
    """Median of every pixel and its eight neighbours."""
    wide = np.pad(gray, 1, mode="edge")
    shifts = [wide[i : i + gray.shape[0], j : j + gray.shape[1]] for i in range(3) for j in range(3)]
    return np.median(shifts, axis=0).astype(np.uint8)


def contrast(gray: np.ndarray, tiles: int = 8, clip: float = 3.0) -> np.ndarray:
    """Equalised contrast per tile, with the histogram clipped at ``clip`` times its mean."""
    out = gray.copy()
    for rows in np.array_split(np.arange(gray.shape[0]), tiles):
        for cols in np.array_split(np.arange(gray.shape[1]), tiles):
            if len(rows) and len(cols):
                part = gray[np.ix_(rows, cols)]
                counts = np.bincount(part.ravel(), minlength=256).astype(float)
                top = clip * counts.mean()
                counts = np.minimum(counts, top) + np.maximum(counts - top, 0).sum() / 256
                scale = counts.cumsum() / counts.sum() * 255
                out[np.ix_(rows, cols)] = scale[part].astype(np.uint8)
    return out


def tilt(gray: np.ndarray) -> float:
    """Angle of the page in degrees, from the second moments of the dark pixels; 0 for an even page."""
    y, x = np.nonzero(gray < 128)
    if len(x) < 2:
        return 0.0
    c = np.cov(x, y)
    return float(np.degrees(0.5 * np.arctan2(2 * c[0, 1], c[0, 0] - c[1, 1])))


def deskew(gray: np.ndarray, least: float = 0.5) -> np.ndarray:
    """The page turned upright by its tilt; unchanged below ``least`` degrees or above 45."""
    angle = tilt(gray)
    if not least <= abs(angle) <= 45:
        return gray
    a = np.radians(angle)
    h, w = gray.shape
    yy, xx = np.mgrid[:h, :w]
    dx, dy = xx - w / 2, yy - h / 2
    sx = np.clip(np.rint(np.cos(a) * dx - np.sin(a) * dy + w / 2), 0, w - 1).astype(int)
    sy = np.clip(np.rint(np.sin(a) * dx + np.cos(a) * dy + h / 2), 0, h - 1).astype(int)
    return gray[sy, sx]


STEPS = {"denoise": denoise, "enhance": contrast, "deskew": deskew, "threshold": threshold}


def prepared(gray: np.ndarray, steps: tuple[str, ...] = ("denoise", "enhance", "deskew")) -> np.ndarray:
    """The steps in the order given; unknown names are skipped."""
    return reduce(lambda g, s: STEPS[s](g), [s for s in steps if s in STEPS], gray)


def picture_regions(gray: np.ndarray, text_boxes: list[tuple[int, int, int, int]], least: int = 3000) -> list[list[int]]:
    """Boxes of dark regions outside the text: at least ``least`` and at most half of the page in area, and not nearly the whole page."""
    h, w = gray.shape
    dark = gray < 240
    for x1, y1, x2, y2 in text_boxes:
        dark[max(0, y1) : min(h, y2), max(0, x1) : min(w, x2)] = False
    cell = 8
    grid = np.zeros((-(-h // cell), -(-w // cell)), bool)
    ys, xs = np.nonzero(dark)
    grid[ys // cell, xs // cell] = True
    seen = np.zeros_like(grid)
    found = []
    for start in zip(*np.nonzero(grid)):
        if seen[start]:
            continue
        seen[start] = True
        stack, cells = [start], []
        while stack:
            i, j = stack.pop()
            cells.append((i, j))
            for a in range(max(0, i - 1), min(grid.shape[0], i + 2)):
                for b in range(max(0, j - 1), min(grid.shape[1], j + 2)):
                    if grid[a, b] and not seen[a, b]:
                        seen[a, b] = True
                        stack.append((a, b))
        rows, cols = np.array(cells).T
        x1, y1 = int(cols.min() * cell), int(rows.min() * cell)
        x2, y2 = min(w, int((cols.max() + 1) * cell)), min(h, int((rows.max() + 1) * cell))
        area = (x2 - x1) * (y2 - y1)
        if least <= area <= 0.5 * h * w and not (x2 - x1 > 0.9 * w and y2 - y1 > 0.9 * h):
            found.append([x1, y1, x2, y2])
    return sorted(found)


def decode(content: bytes | None) -> np.ndarray | None:
    """The grey image in a file's bytes, or None where they can't be read. Portable maps are read here, other formats by Pillow where it is installed."""
    found = _MAP.match(content or b"")
    if found:
        depth, width, height = (3 if found[1] == b"6" else 1), int(found[2]), int(found[3])
        data = np.frombuffer(content, np.uint8, offset=found.end())
        if int(found[4]) > 255 or len(data) < width * height * depth:
            return None
        data = data[: width * height * depth].reshape(height, width, depth)
        return data[:, :, 0] if depth == 1 else np.rint(data @ np.array([0.299, 0.587, 0.114])).astype(np.uint8)
    try:
        from PIL import Image

        return np.asarray(Image.open(io.BytesIO(content)).convert("L"))
    except Exception:  # whatever a broken file makes the reader raise, it is an unreadable image
        return None


def _grey(height, width, pixels) -> np.ndarray | None:
    whole = pixels is not None and height and width and len(pixels) == height * width
    return np.frombuffer(pixels, np.uint8).reshape(height, width) if whole else None


def decoded(rows: DataFrame, key: str = "path", content: str = "content") -> DataFrame:
    """(key, height, width, pixels) of image files; all null but the key where a file can't be read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [decode(x) for x in batch.column(1).to_pylist()]
            size = lambda k: pa.array([None if g is None else g.shape[k] for g in found], pa.int32())
            pixels = pa.array([None if g is None else g.tobytes() for g in found], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), size(0), size(1), pixels], [key, "height", "width", "pixels"])

    return rows.select(key, content).mapInArrow(run, f"`{key}` {dict(rows.dtypes)[key]}, height int, width int, pixels binary")


def prepared_images(rows: DataFrame, key: str = "path", steps: tuple[str, ...] = ("denoise", "enhance", "deskew")) -> DataFrame:
    """The grey images of ``rows`` (key, height, width, pixels) after ``steps``, in their order; images that are null or of the wrong size are null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grey = [_grey(*x) for x in zip(*(c.to_pylist() for c in batch.columns[1:]))]
            out = [None if g is None else prepared(g, steps).tobytes() for g in grey]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.binary())], [key, "height", "width", "pixels"])

    return rows.select(key, "height", "width", "pixels").mapInArrow(run, f"`{key}` {dict(rows.dtypes)[key]}, height int, width int, pixels binary")


def regions(rows: DataFrame, key: str = "path", text_boxes: str = "text_boxes", least: int = 3000) -> DataFrame:
    """(key, pos, box) of the picture regions of grey images outside their ``text_boxes`` (ARRAY<ARRAY<INT>>); none for an unreadable image."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, pos, out = [], [], []
            for k, (height, width, pixels, boxes) in enumerate(zip(*(c.to_pylist() for c in batch.columns[1:]))):
                grey = _grey(height, width, pixels)
                found = [] if grey is None else picture_regions(grey, [b for b in boxes or [] if b and len(b) == 4 and None not in b], least)
                owner += [k] * len(found)
                pos += range(len(found))
                out += found
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner, pa.int64())), pa.array(pos, pa.int32()), pa.array(out, pa.list_(pa.int32()))], [key, "pos", "box"])

    return rows.select(key, "height", "width", "pixels", text_boxes).mapInArrow(run, f"`{key}` {dict(rows.dtypes)[key]}, pos int, box array<int>")
