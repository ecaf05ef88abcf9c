"""Image functions on Arrow batches: structural similarity, resizing, raw decoding, marker scans."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, FloatType, StringType

SIZE, SIGMA = 11, 1.5
C1, C2 = (0.01 * 255) ** 2, (0.03 * 255) ** 2


def _smooth(x: np.ndarray) -> np.ndarray:
    """Separable Gaussian of 11 taps over the last two axes, mirrored at the border without repeating the edge."""
    taps = np.exp(-((np.arange(SIZE) - SIZE // 2) ** 2) / (2 * SIGMA**2))
    taps /= taps.sum()
    for axis in (-1, -2):
        pad = [(0, 0)] * x.ndim
        pad[axis] = (SIZE // 2, SIZE // 2)
        wide = np.lib.stride_tricks.sliding_window_view(np.pad(x, pad, mode="reflect"), SIZE, axis=axis)
        x = wide @ taps
    return x


def ssim(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Mean structural similarity of stacks of frames (n, h, w), or of each channel (n, h, w, channels) in the mean."""
    if a.ndim == 4:
        return np.mean([ssim(a[..., c], b[..., c]) for c in range(a.shape[3])], axis=0)
    a, b = a.astype(np.float64), b.astype(np.float64)
    ma, mb = _smooth(a), _smooth(b)
    va, vb, cab = _smooth(a * a) - ma * ma, _smooth(b * b) - mb * mb, _smooth(a * b) - ma * mb
    score = (2 * ma * mb + C1) * (2 * cab + C2) / ((ma * ma + mb * mb + C1) * (va + vb + C2))
    return score.mean(axis=(1, 2))


def _tiles(vectors: pd.Series, side: int) -> np.ndarray:
    flat = np.stack([np.resize(np.asarray(v, np.float64), side * side) for v in vectors]) if len(vectors) else np.zeros((0, side * side))
    return np.clip(np.rint(128 + 40 * flat), 0, 255).reshape(-1, side, side)


def ssim_rows(vectors: DataFrame) -> DataFrame:
    """vec_id, ssim of each vector's tile and the tile moved by one column."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            a = _tiles(batch["embedding"], 16)
            yield pd.DataFrame({"vec_id": batch["vec_id"], "ssim": ssim(a, np.roll(a, 1, axis=2)).round(6)})

    return vectors.select("vec_id", "embedding").mapInPandas(run, "vec_id long, ssim double")


def crop(frames: np.ndarray, left: int, top: int, right: int, bottom: int) -> np.ndarray:
    """A tile of a mosaic, by pixels (see ``tile_bounds``)."""
    return frames[:, top:bottom, left:right]


def bilinear(frames: np.ndarray, height: int, width: int) -> np.ndarray:
    """Linear resize with pixel centres at halves, edges repeated; 8-bit frames are rounded half up."""

    def taps(size: int, new: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = (np.arange(new) + 0.5) * size / new - 0.5
        low = np.floor(at).astype(int)
        return np.clip(low, 0, size - 1), np.clip(low + 1, 0, size - 1), at - low

    (y0, y1, fy), (x0, x1, fx) = taps(frames.shape[1], height), taps(frames.shape[2], width)
    tail = (1,) * (frames.ndim - 3)
    x = frames.astype(np.float64)
    rows = x[:, y0] * (1 - fy).reshape(-1, 1, *tail) + x[:, y1] * fy.reshape(-1, 1, *tail)
    out = rows[:, :, x0] * (1 - fx).reshape(-1, *tail) + rows[:, :, x1] * fx.reshape(-1, *tail)
    return np.floor(out + 0.5).astype(np.uint8) if frames.dtype == np.uint8 else out.astype(frames.dtype)


def nearest(frames: np.ndarray, height: int, width: int) -> np.ndarray:
    h, w = frames.shape[1:3]
    rows = np.minimum((np.arange(height) * h / height).astype(int), h - 1)
    cols = np.minimum((np.arange(width) * w / width).astype(int), w - 1)
    return frames[:, rows][:, :, cols]


def letterbox(frames: np.ndarray, height: int, width: int, resize=nearest) -> np.ndarray:
    """Frames (n, h, w) or (n, h, w, channels) resized by one factor and centred on zeros; depth takes ``nearest``, colour ``bilinear``."""
    n, h, w = frames.shape[:3]
    scale = min(width / w, height / h)
    nh, nw = max(1, round(h * scale)), max(1, round(w * scale))
    out = np.zeros((n, height, width, *frames.shape[3:]), frames.dtype)
    top, left = (height - nh) // 2, (width - nw) // 2
    out[:, top : top + nh, left : left + nw] = resize(frames, nh, nw)
    return out


def crop_resize_rows(vectors: DataFrame) -> DataFrame:
    """vec_id, pixels, total of 8 x 8 tiles letterboxed to 12 x 20, and total of their middle 4 x 4 resized linearly to 6 x 6."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            tiles = _tiles(batch["embedding"], 8)
            out, middle = letterbox(tiles, 12, 20), bilinear(crop(tiles, 2, 2, 6, 6), 6, 6)
            yield pd.DataFrame({"vec_id": batch["vec_id"], "pixels": (out > 0).sum(axis=(1, 2)), "total": out.sum(axis=(1, 2)), "middle": middle.sum(axis=(1, 2)).round(6)})

    return vectors.select("vec_id", "embedding").mapInPandas(run, "vec_id long, pixels long, total double, middle double")


#: Raw colour encodings as channels and their places of red, green and blue.
COLOURS = {"rgb8": (3, (0, 1, 2)), "bgr8": (3, (2, 1, 0)), "rgba8": (4, (0, 1, 2)), "bgra8": (4, (2, 1, 0)), "mono8": (1, (0, 0, 0)), "8uc1": (1, (0, 0, 0))}


@F.pandas_udf(BinaryType())
def colour_image(data: pd.Series, encoding: pd.Series, height: pd.Series, width: pd.Series, step: pd.Series) -> pd.Series:
    """Raw images as red, green, blue bytes row by row; ``step`` is the bytes of a row (0: no padding).

    Null for other encodings, sizes that aren't positive, or too few bytes.
    """

    def one(raw, kind, h, w, row):
        channels, places = COLOURS.get(str(kind).lower(), (0, ()))
        if raw is None or not channels or not (h > 0 and w > 0):
            return None
        row = int(row) if row and row > 0 else int(w) * channels
        if row < w * channels or len(raw) != row * h:
            return None
        pixels = np.frombuffer(raw, np.uint8).reshape(int(h), row)[:, : int(w) * channels].reshape(int(h), int(w), channels)
        return np.ascontiguousarray(pixels[:, :, list(places)]).tobytes()

    return pd.Series([one(*r) for r in zip(data, encoding, height, width, step, strict=True)])


@F.pandas_udf(StringType())
def jpeg_subsampling(data: pd.Series) -> pd.Series:
    """Chroma subsampling by the luma factors of the frame header; unknown if there is none."""

    def one(raw: bytes | None) -> str:
        at = 2
        while raw is not None and at + 4 <= len(raw) and raw[at] == 0xFF:
            marker, size = raw[at + 1], int.from_bytes(raw[at + 2 : at + 4], "big")
            if marker in (0xC0, 0xC1, 0xC2) and at + 12 <= len(raw):
                h, v = raw[at + 11] >> 4, raw[at + 11] & 15
                return {(2, 2): "4:2:0", (2, 1): "4:2:2", (1, 1): "4:4:4"}.get((h, v), f"h{h}v{v}")
            at += 2 + size
        return "unknown"

    return data.map(one)


#: Depth encodings as number types and metres of a unit.
DEPTHS = {"16uc1": ("<u2", 0.001), "mono16": ("<u2", 0.001), "32fc1": ("<f4", 1.0), "64fc1": ("<f8", 1.0)}


@F.pandas_udf(ArrayType(FloatType()))
def depth_metres(data: pd.Series, encoding: pd.Series) -> pd.Series:
    """Depth images as metres: 16-bit millimetres, or floats; not finite or negative is 0, other encodings are null."""

    def one(raw: bytes | None, kind: str | None):
        number, scale = DEPTHS.get(str(kind).lower(), (None, 0.0))
        if raw is None or number is None or len(raw) % np.dtype(number).itemsize:
            return None
        x = np.frombuffer(raw, number).astype(np.float32) * np.float32(scale)
        return np.where(np.isfinite(x) & (x >= 0), x, np.float32(0))

    return pd.Series([one(r, k) for r, k in zip(data, encoding, strict=True)])
