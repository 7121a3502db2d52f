"""Boxes on a 0-1000 grid as [y1, x1, y2, x2]: pixels, crops, percent rectangles. Built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def pixels(bbox: Column, width: Column, height: Column) -> Column:
    """Struct left, top, right, bottom in pixels; corners may be swapped; null if empty or malformed."""
    y1, x1, y2, x2 = (bbox[i] for i in range(4))
    left, right = F.bround(F.least(x1, x2) / 1000 * width).cast("int"), F.bround(F.greatest(x1, x2) / 1000 * width).cast("int")
    top, bottom = F.bround(F.least(y1, y2) / 1000 * height).cast("int"), F.bround(F.greatest(y1, y2) / 1000 * height).cast("int")
    box = F.struct(left.alias("left"), top.alias("top"), right.alias("right"), bottom.alias("bottom"))
    return F.when((F.size(bbox) == 4) & (right > left) & (bottom > top), box)


def crop(box: Column, width: Column, height: Column, pad_px: int = 22, pad_share: float = 0.028) -> Column:
    """A pixel box grown by the larger of a fixed pad and a share of the side, within the image."""
    pad_x = F.greatest(F.lit(pad_px), F.bround(width * pad_share).cast("int"))
    pad_y = F.greatest(F.lit(pad_px), F.bround(height * pad_share).cast("int"))
    return F.when(box.isNotNull(), F.struct(
        F.greatest(F.lit(0), box["left"] - pad_x).alias("left"), F.greatest(F.lit(0), box["top"] - pad_y).alias("top"),
        F.least(width, box["right"] + pad_x).alias("right"), F.least(height, box["bottom"] + pad_y).alias("bottom"),
    ))


def fit(width: Column, height: Column, longest: int) -> Column:
    """Struct width, height scaled down so that the longest side is at most `longest`."""
    scale = F.least(F.lit(1.0), F.lit(float(longest)) / F.greatest(width, height))
    return F.struct(F.greatest(F.lit(1), F.floor(width * scale).cast("int")).alias("width"), F.greatest(F.lit(1), F.floor(height * scale).cast("int")).alias("height"))


def percent(bbox: Column, least: float = 0.4) -> Column:
    """Struct left, top, width, height in percent of the page, sides of at least `least`."""
    y1, x1, y2, x2 = (bbox[i] for i in range(4))
    return F.when(F.size(bbox) == 4, F.struct(
        (F.least(x1, x2) / 10).alias("left"), (F.least(y1, y2) / 10).alias("top"),
        F.greatest(F.abs(x2 - x1) / 10, F.lit(least)).alias("width"), F.greatest(F.abs(y2 - y1) / 10, F.lit(least)).alias("height"),
    ))
