"""Features of decoded frames in Arrow batches: sharpness, brightness, edges, motion and colour histograms.

Decoding belongs to the ingestion boundary; frames come as raw RGB bytes with their size.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

OUT = "video_id string, scene_id string, frame_index bigint, sharpness double, brightness double, edge_density double, motion double, histogram array<double>, flow array<double>"


def hsv(rgb: np.ndarray) -> np.ndarray:
    """Hue in half degrees (0-180), saturation and value (0-255) of an RGB image."""
    x = rgb.astype(np.float64)
    top, low = x.max(axis=2), x.min(axis=2)
    span = np.where(top > low, top - low, 1.0)
    r, g, b = x[..., 0], x[..., 1], x[..., 2]
    hue = np.where(top == r, (g - b) / span % 6, np.where(top == g, (b - r) / span + 2, (r - g) / span + 4))
    return np.stack([np.where(top > low, hue * 30, 0.0), np.where(top > 0, (top - low) / np.maximum(top, 1) * 255, 0.0), top], axis=2)


def features(rgb: np.ndarray, before: np.ndarray | None) -> tuple[float, float, float, float, list[float], list[float], np.ndarray]:
    """Variance of the Laplacian, mean luminance, share of strong gradients, motion against the frame before, 512-bin colour
    histogram (sum 1), and an 8-bin histogram of gradient directions weighted by the change since the frame before."""
    gray = rgb.astype(np.float64) @ np.array([0.299, 0.587, 0.114])
    pad = np.pad(gray, 1, mode="reflect" if min(gray.shape) > 1 else "edge")
    laplace = pad[:-2, 1:-1] + pad[2:, 1:-1] + pad[1:-1, :-2] + pad[1:-1, 2:] - 4 * gray
    dy, dx = np.gradient(gray) if min(gray.shape) > 1 else (np.zeros_like(gray), np.zeros_like(gray))
    size = np.hypot(dx, dy)
    colour = hsv(rgb).reshape(-1, 3)
    bins, _ = np.histogramdd(colour, bins=(8, 8, 8), range=((0, 180), (0, 256), (0, 256)))
    motion, flow = 0.0, [0.0] * 8
    if before is not None and before.shape == gray.shape:
        change = np.abs(gray - before)
        motion = float(np.percentile(change, 90))
        weight, _ = np.histogram(np.arctan2(dy, dx), bins=8, range=(-np.pi, np.pi), weights=change)
        flow = (weight / weight.sum()).tolist() if weight.sum() > 0 else flow
    return float(laplace.var()), float(gray.mean()), float((size > 50).mean()), motion, (bins / max(1.0, bins.sum())).ravel().tolist(), flow, gray


def frame_features(frames: DataFrame) -> DataFrame:
    """Features of ``video_id, scene_id, frame_index, height, width, rgb``; a scene is one group, its frames in order.

    Frames whose bytes do not fit their size are left out.
    """
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out, before = [], None
        for row in pdf.sort_values("frame_index").itertuples():
            if row.rgb is None or len(row.rgb) != row.height * row.width * 3 or not row.rgb:
                continue
            *values, before = features(np.frombuffer(row.rgb, np.uint8).reshape(int(row.height), int(row.width), 3), before)
            out.append((row.video_id, row.scene_id, row.frame_index, *values))
        return pd.DataFrame(out, columns=[c.split()[0] for c in OUT.split(", ")])

    return frames.groupBy("video_id", "scene_id").applyInPandas(run, OUT)

