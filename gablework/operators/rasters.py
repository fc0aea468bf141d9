"""Per-image work on pixels by numpy within tasks: warps, remaps, inpainting, and models behind an interface.

Images are rows (img, width, height, channels, data); each function handles one Arrow batch of images at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

IMAGE = "img long, width int, height int, channels int, data binary"
#: A model: an image (height, width, channels) in, one of the same size or masks (n, height, width) out.
Model = Callable[[np.ndarray], np.ndarray]


def pixels(row) -> np.ndarray:
    return np.frombuffer(row.data, np.uint8).reshape(row.height, row.width, row.channels)


def _row(img: int, a: np.ndarray) -> tuple:
    return img, a.shape[1], a.shape[0], a.shape[2], np.ascontiguousarray(a, np.uint8).tobytes()


def bilinear(image: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Values at places, 0 outside the image."""
    h, w = image.shape[:2]
    x0, y0 = np.floor(x).astype(int), np.floor(y).astype(int)
    out = np.zeros((*x.shape, image.shape[2]))
    for dx in (0, 1):
        for dy in (0, 1):
            u, v = x0 + dx, y0 + dy
            weight = (1 - np.abs(x - u)) * (1 - np.abs(y - v))
            ok = (u >= 0) & (u < w) & (v >= 0) & (v < h) & (weight > 0)
            out[ok] += image[v[ok], u[ok]] * weight[ok][:, None]
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def warp(images: DataFrame) -> DataFrame:
    """Images with a homography h (nine doubles) and the size of the target (to_width, to_height), warped by it."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for r in part.itertuples():
                inverse = np.linalg.inv(np.array(r.h, float).reshape(3, 3))
                x, y = np.meshgrid(np.arange(r.to_width), np.arange(r.to_height))
                u, v, w = np.tensordot(inverse, np.stack((x, y, np.ones_like(x))), 1)
                rows.append(_row(r.img, bilinear(pixels(r), u / w, v / w)))
            yield pd.DataFrame(rows, columns=["img", "width", "height", "channels", "data"])

    return images.mapInPandas(run, IMAGE)


def modelled(images: DataFrame, make: Callable[[], Model]) -> DataFrame:
    """Images through a model, which each task makes once."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for part in parts:
            yield pd.DataFrame([_row(r.img, model(pixels(r))) for r in part.itertuples()], columns=["img", "width", "height", "channels", "data"])

    return images.mapInPandas(run, IMAGE)


def instances(images: DataFrame, make: Callable[[], Model]) -> DataFrame:
    """Masks that a segmentation model finds, as pixels: img, instance, x, y. Empty masks vanish."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for part in parts:
            for r in part.itertuples():
                k, y, x = np.nonzero(np.asarray(model(pixels(r))) > 0.5)
                yield pd.DataFrame({"img": r.img, "instance": k, "x": x, "y": y})

    return images.mapInPandas(run, "img long, instance long, x long, y long")


def bright_segments() -> Model:
    """A stand-in for a segmentation model that needs weights: the bright and the dark pixels."""

    def run(image: np.ndarray) -> np.ndarray:
        gray = image.mean(axis=2)
        return np.stack((gray > gray.mean(), gray <= gray.mean()))

    return run


def flat_inpainter() -> Model:
    """A stand-in for an inpainting model: transparent pixels of an RGBA image get the median color of the others (180 if there are none)."""

    def run(image: np.ndarray) -> np.ndarray:
        out, hole = image.copy(), image[:, :, 3] == 0
        color = np.floor(np.median(image[~hole][:, :3], axis=0)) if (~hole).any() else np.full(3, 180)
        out[hole] = [*color, 255]
        return out

    return run
