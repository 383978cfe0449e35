"""Picture signatures: luminance, thumbnails, difference hash, pixel similarity.

Spark's image source gives blue, green, red bytes by rows. Luminance and thumbnails are integer arithmetic, as in the imaging library that the original data went through: 16-bit
weights of the colours, and a triangle filter as wide as the scale whose weights have 22 bits, with levels rounded to 8 bits after the pass across and again after the pass down. So
hashes are equal bit by bit. Decoding is Spark's; only small vectors leave these helpers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

THUMBNAIL = (32, 24)
HASH_SIZE = (9, 8)
#: Fixed values of the library: luminance weights of red, green and blue in 65,536ths, bits of a filter weight; the cut that takes the border off.
RED, GREEN, BLUE, WEIGHT_BITS = 19595, 38470, 7471, 22
INNER = (100, 100, 740, 612)
MIN_STD, MIN_CORRELATION, MAX_DIFFERENCE = 10.0, 0.95, 10.0
# types, not text: text is parsed by a session, which importing must not need
SIGNATURE = T.StructType([T.StructField("dhash", T.StringType()), T.StructField("pixels", T.ArrayType(T.DoubleType())), T.StructField("pixel_std", T.DoubleType())])
SIMILARITY = T.StructType([T.StructField(k, T.DoubleType()) for k in ("correlation", "mean_absolute_error", "left_std", "right_std")])


def luminance(data: bytes, width: int, height: int, channels: int) -> np.ndarray:
    """Grey levels of one picture of 1, 3 or 4 channels."""
    x = np.frombuffer(data, np.uint8).reshape(height, width, channels).astype(np.int64)
    if channels == 1:
        return x[:, :, 0]
    blue, green, red = x[:, :, channels - 3], x[:, :, channels - 2], x[:, :, channels - 1]
    if channels == 4:  # alpha comes first
        blue, green, red = x[:, :, 1], x[:, :, 2], x[:, :, 3]
    return (RED * red + GREEN * green + BLUE * blue + 0x8000) >> 16


def crop_region(grey: np.ndarray, left: int = INNER[0], top: int = INNER[1], right: int = INNER[2], bottom: int = INNER[3]) -> np.ndarray:
    """The region, black where it lies beyond the picture."""
    part = grey[top:bottom, left:right]
    return np.pad(part, ((0, bottom - top - part.shape[0]), (0, right - left - part.shape[1])))


@lru_cache(maxsize=256)
def filter_weights(size: int, target: int) -> np.ndarray:
    """Whole weights (target, size) of a triangle filter that widens with the scale when shrinking."""
    scale = size / target
    reach = max(scale, 1.0)
    centre = ((np.arange(target) + 0.5) * scale)[:, None]
    x = np.arange(size)[None, :]
    w = np.maximum(0.0, 1.0 - np.abs((x - centre + 0.5) * (1.0 / reach)))
    w[(x < np.maximum(0, np.trunc(centre - reach + 0.5))) | (x >= np.minimum(size, np.trunc(centre + reach + 0.5)))] = 0.0
    return np.floor(w / w.sum(1, keepdims=True) * (1 << WEIGHT_BITS) + 0.5).astype(np.int64)


def _rounded(sums: np.ndarray) -> np.ndarray:
    return np.clip((sums + (1 << (WEIGHT_BITS - 1))) >> WEIGHT_BITS, 0, 255)


def gray_thumbnail(grey: np.ndarray, width: int, height: int) -> np.ndarray:
    """Levels of the picture at another size: across first, then down; a side that stays is not filtered."""
    if grey.shape[1] != width:
        grey = _rounded(grey @ filter_weights(grey.shape[1], width).T)
    if grey.shape[0] != height:
        grey = _rounded(filter_weights(grey.shape[0], height) @ grey)
    return grey


def dhash(grey: np.ndarray) -> str:
    """64 comparisons of neighbours in a row, first one highest, as 16 hexadecimal digits."""
    t = gray_thumbnail(grey, *HASH_SIZE)
    bits = (t[:, 1:] > t[:, :-1]).ravel()
    return f"{int(''.join('1' if b else '0' for b in bits), 2):016x}"


def signature_of(box: tuple[int, int, int, int] = INNER) -> Callable[..., Column]:
    """A function of columns (data, width, height, channels, crop): hash, 768 thumbnail pixels and their standard deviation, of the region `box` where crop is true; nulls for pictures that weren't decoded."""

    @F.pandas_udf(SIGNATURE)
    def signature(data: pd.Series, width: pd.Series, height: pd.Series, channels: pd.Series, crop: pd.Series) -> pd.DataFrame:
        out = []
        for d, w, h, c, cut in zip(data, width, height, channels, crop, strict=True):
            if d is None or w <= 0 or h <= 0:
                out.append((None, None, None))
                continue
            grey = luminance(d, int(w), int(h), int(c))
            grey = crop_region(grey, *box) if cut else grey
            pixels = gray_thumbnail(grey, *THUMBNAIL).ravel().astype(float)
            out.append((dhash(grey), pixels, float(pixels.std())))
        return pd.DataFrame(out, columns=["dhash", "pixels", "pixel_std"])

    return signature


image_signature = signature_of()


@F.pandas_udf(SIMILARITY)
def pixel_similarity(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """Correlation (0 where one side is constant), mean absolute error and both population deviations."""
    for left, right in batches:
        if not len(left):
            yield pd.DataFrame({k: pd.Series(dtype="float64") for k in SIMILARITY.names})
            continue
        a, b = np.stack(left.to_numpy()).astype(float), np.stack(right.to_numpy()).astype(float)
        da, db = a - a.mean(1, keepdims=True), b - b.mean(1, keepdims=True)
        bottom = np.sqrt((da * da).sum(1) * (db * db).sum(1))
        with np.errstate(divide="ignore", invalid="ignore"):
            r = np.where(bottom > 0, (da * db).sum(1) / bottom, 0.0)
        yield pd.DataFrame({"correlation": r, "mean_absolute_error": np.abs(a - b).mean(1), "left_std": a.std(1), "right_std": b.std(1)})


def bits_to_hex(pixels: str, n: int = 16) -> Column:
    """The difference hash of an array column: n comparisons of neighbours as n/4 hexadecimal digits."""
    value = F.aggregate(F.sequence(F.lit(1), F.lit(n)), F.lit(0).cast("bigint"), lambda a, i: a * 2 + F.when(F.element_at(pixels, i + 1) > F.element_at(pixels, i), 1).otherwise(0))
    return F.lower(F.lpad(F.hex(value), n // 4, "0"))


def population_std(pixels: str) -> Column:
    """Population standard deviation of an array column, in one pass over it."""
    zero = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("q"))
    one = lambda a, x: F.struct((a["s"] + x).alias("s"), (a["q"] + x * x).alias("q"))
    n = F.size(pixels)
    return F.aggregate(pixels, zero, one, lambda a: F.sqrt(F.greatest(n * a["q"] - a["s"] * a["s"], F.lit(0.0))) / n)
