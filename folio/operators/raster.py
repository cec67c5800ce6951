"""Page rasters as rows (id, h, w, data): rules, gutters, thresholds."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DARK = 128


def _grey(row) -> np.ndarray:
    return np.frombuffer(bytes(row.data), np.uint8).reshape(row.h, row.w)


def longest_runs(ink: np.ndarray) -> np.ndarray:
    """The longest run of ink in each row."""
    n = np.zeros(ink.shape[0], int)
    best = n.copy()
    for column in ink.T:
        n = np.where(column, n + 1, 0)
        best = np.maximum(best, n)
    return best


def footnote_rule(grey: np.ndarray, lower: float = 0.5, wide: float = 0.10, thick: int = 8) -> int | None:
    """The first row of a thin line in the lower half with clear paper above it, or None."""
    ink = grey < DARK
    h, w = ink.shape
    line = (longest_runs(ink) >= wide * w) & (ink.mean(1) < 0.5)
    y = int(h * lower)
    while y < h:
        if not line[y]:
            y += 1
            continue
        end = y
        while end < h and line[end]:
            end += 1
        if end - y <= thick and ink[max(0, y - 4) : y].mean() < 0.05:
            return y
        y = end
    return None


def gutter(grey: np.ndarray, a: float, b: float, paper: float, sides: float, beyond: bool = False) -> int | None:
    """The emptiest column between shares a and b of the width, if it is nearly free of ink and both sides aren't: what is beside it, or beyond the shares."""
    if not grey.size:
        return None
    density = (grey < DARK).mean(0)
    w = len(density)
    lo, hi = int(w * a), max(int(w * b), int(w * a) + 1)
    at = lo + int(density[lo:hi].argmin())
    left, right = (lo, hi) if beyond else (at, at + 1)
    if density[at] > paper or density[:left].max(initial=0) < sides or density[right:].max(initial=0) < sides:
        return None
    return at


def inner_gutter(grey: np.ndarray) -> int | None:
    """Where a block's image is two columns: an empty column in its middle two fifths, and ink on both sides of those. Blocks narrower than 20 pixels have none."""
    w = grey.shape[1]
    if w < 20 or int(w * 0.7) - int(w * 0.3) < 3:
        return None
    return gutter(grey, 0.30, 0.70, 0.012, 0.08, beyond=True)


def merged_columns(grey: np.ndarray, boxes: list[tuple[float, float, float, float]]) -> list[int]:
    """Which boxes of a page, at least half as wide as it, hold several columns as one block: they need a review."""
    out = []
    for i, (x0, y0, x1, y1) in enumerate(boxes):
        if x1 - x0 >= 0.5 * grey.shape[1]:
            crop = grey[max(0, round(y0)) : max(0, round(y1)), max(0, round(x0)) : max(0, round(x1))]
            if crop.size and inner_gutter(crop) is not None:
                out.append(i)
    return out


def cuts(grey: np.ndarray, columns: int) -> list[int]:
    """The gutters near the bounds of so many equal columns."""
    found = [gutter(grey, k / columns - 0.14, k / columns + 0.14, 0.02, 0.04) for k in range(1, columns)]
    return [x for x in found if x is not None]


def profiles(images: DataFrame) -> DataFrame:
    """Per image: rule_y, inner_gutter, two_up (for wide ones), longest run."""

    def run(frames):
        for f in frames:
            out = []
            for row in f.itertuples():
                g = _grey(row)
                out.append((row.id, footnote_rule(g), inner_gutter(g), gutter(g, 0.35, 0.65, 0.01, 0.05) if row.w >= 1.15 * row.h else None, int(longest_runs(g < DARK).max())))
            yield pd.DataFrame(out, columns=["id", "rule_y", "inner_gutter", "two_up", "longest"]).astype({c: "Int64" for c in ("rule_y", "inner_gutter", "two_up")})

    return images.mapInPandas(run, "id long, rule_y long, inner_gutter long, two_up long, longest long")


def otsu(hist: DataFrame, by: list[str]) -> DataFrame:
    """hist(by, bin, n): the threshold bin with the largest variance between classes, the least of equals; sums run over 256 bins a group."""
    w = Window.partitionBy(*by).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*by)
    h = hist.withColumns({"wb": F.sum("n").over(w), "sb": F.sum(F.col("bin") * F.col("n")).over(w), "tn": F.sum("n").over(whole), "ts": F.sum(F.col("bin") * F.col("n")).over(whole)})
    wf = F.col("tn") - F.col("wb")
    diff = F.col("sb") / F.col("wb") - (F.col("ts") - F.col("sb")) / wf
    v = F.when(wf > 0, F.col("wb").cast("double") * wf * diff * diff)
    return h.withColumn("v", v).groupBy(*by).agg(F.min_by("bin", F.struct(-F.coalesce("v", F.lit(-1.0)), F.col("bin"))).alias("threshold"))
