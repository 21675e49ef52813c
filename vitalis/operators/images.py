"""Image rows: preparation for models and rotated copies.

Rows follow Spark's image schema (origin, height, width, nChannels, mode, data; colours stored
blue, green, red). One image is one row; pixel work runs on Arrow batches with NumPy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalis.plans import ranks


def to_array(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Height x width x channels, colours as red, green, blue."""
    pixels = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels).astype(np.float64)
    return pixels[:, :, ::-1] if channels == 3 else pixels[:, :, [2, 1, 0, 3]] if channels == 4 else pixels


def grey(pixels: np.ndarray) -> np.ndarray:
    """Brightness weights of the three colours (fixed values)."""
    if pixels.shape[2] == 1:
        return pixels
    return (pixels[:, :, :3] @ np.array([0.299, 0.587, 0.114]))[:, :, None]


def _shares(old: int, new: int) -> np.ndarray:
    """new x old matrix: how much of each old cell lies in each new cell."""
    edges = np.linspace(0, old, new + 1)
    left, right = edges[:-1, None], edges[1:, None]
    cells = np.arange(old)[None, :]
    overlap = np.clip(np.minimum(right, cells + 1) - np.maximum(left, cells), 0, None)
    return overlap / overlap.sum(axis=1, keepdims=True)


def resize(pixels: np.ndarray, height: int, width: int) -> np.ndarray:
    """Area mean onto a new grid; the aspect is not kept."""
    rows, columns = _shares(pixels.shape[0], height), _shares(pixels.shape[1], width)
    h, w, c = pixels.shape
    lines = (rows @ pixels.reshape(h, w * c)).reshape(height, w, c)  # two matrix products, one for each axis
    return np.matmul(columns, lines)


def rotate(pixels: np.ndarray, degrees: float) -> np.ndarray:
    """Rotate about the centre; places that fall outside take the nearest edge pixel."""
    h, w = pixels.shape[:2]
    turn = np.deg2rad(degrees)
    y, x = np.mgrid[0:h, 0:w]
    cy, cx = (h - 1) / 2, (w - 1) / 2
    sy = np.cos(turn) * (y - cy) - np.sin(turn) * (x - cx) + cy
    sx = np.sin(turn) * (y - cy) + np.cos(turn) * (x - cx) + cx
    return pixels[np.clip(np.rint(sy), 0, h - 1).astype(int), np.clip(np.rint(sx), 0, w - 1).astype(int)]


def prep_images(df: DataFrame, size: int, mode: str = "rgb") -> DataFrame:
    """Resize to ``size`` x ``size``, scale to [0, 1] and flatten; ``mode`` is ``rgb`` or ``grey``.

    ``df`` has a key, the label and an ``image`` struct; the result replaces it by height, width,
    channels and ``pixels``.
    """
    if mode not in ("rgb", "grey"):
        raise ValueError("mode must be 'rgb' or 'grey'")
    kept = [f for f in df.schema.fields if f.name != "image"]
    added = "height int, width int, channels int, pixels array<float>"
    schema = T.StructType([*kept, *T._parse_datatype_string(added).fields])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            flat, channels = [], []
            for data, h, w, c in zip(batch["_data"], batch["_h"], batch["_w"], batch["_c"]):
                pixels = to_array(data, h, w, c)
                pixels = grey(pixels) if mode == "grey" else pixels[:, :, :3]
                small = resize(pixels, size, size) / 255.0
                channels.append(small.shape[2])
                flat.append(small.ravel().astype(np.float32))
            yield batch[[f.name for f in kept]].assign(height=size, width=size, channels=channels, pixels=flat)

    parts = {"_data": "data", "_h": "height", "_w": "width", "_c": "nChannels"}
    return df.select(*[f.name for f in kept], *[F.col(f"image.{v}").alias(k) for k, v in parts.items()]).mapInPandas(run, schema)


def first_per_class(df: DataFrame, label: str, value: str, order: str, n: int) -> DataFrame:
    """All rows of the other classes and the first ``n`` rows (by ``order``) of one class.

    The cap is the operation itself: it balances one oversized class. Only its top ``n`` travel.
    """
    rest = df.filter(~F.col(label).eqNullSafe(F.lit(value)))
    capped = df.filter(F.col(label) == F.lit(value)).orderBy(order).limit(n)
    return rest.unionByName(capped)


def augment(df: DataFrame, key: str, copies: int, max_degrees: float, seed: str = "turn") -> DataFrame:
    """``copies`` randomly rotated versions of each prepared image (see ``prep_images``).

    The angle comes from the md5 of key, copy and seed.
    """
    many = df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    part = ranks.hash_fraction_bucket(ranks.hash_key([key, "copy"], seed)) / F.lit(10000.0)
    many = many.withColumn("degrees", (part * 2 - 1) * max_degrees)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            turned = [
                rotate(np.asarray(p).reshape(h, w, c), angle).ravel()
                for p, h, w, c, angle in zip(batch["pixels"], batch["height"], batch["width"], batch["channels"], batch["degrees"])
            ]
            yield batch.assign(pixels=turned)

    return many.mapInPandas(run, many.schema)
