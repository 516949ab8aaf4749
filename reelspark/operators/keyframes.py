"""Keyframe sampling, gating, scoring and selection over tables of frame features."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelspark.functions import scores as S


@dataclass(frozen=True)
class KeyframeSettings:
    """The defaults of the keyframe command; :data:`STAGED` has those of the staged pipeline."""

    sample_every_seconds: float = 8.0
    min_frames: int = 1
    max_frames: int = 8
    candidate_multiplier: int = 12
    edge_margin: float = 0.10
    short_scene_seconds: float = 5.0
    short_scene_strategy: str = "diverse"
    short_scene_candidates: int = 3
    min_sharpness: float = 35.0
    min_brightness: float = 25.0
    max_brightness: float = 235.0
    blur_ratio: float = 0.65
    blur_neighbours: int = 2
    reject_blur: bool = True
    mode: str = "flow"
    motion_weight: float = 0.55
    unique_color: float = 0.50
    unique_edge: float = 0.006
    unique_flow: float | None = 0.20
    cross_color: float = 0.25
    lookback: int = 8
    min_temporal_gap: float = 0.16
    skip_similar_scenes: bool = True
    diverse_windows: bool = True
    fill_duplicates: bool = False


STAGED = KeyframeSettings(sample_every_seconds=20.0, max_frames=2, candidate_multiplier=1, reject_blur=False, short_scene_strategy="first")


def frame_count(duration: Column, s: KeyframeSettings) -> Column:
    return F.greatest(F.lit(s.min_frames), F.least(F.lit(s.max_frames), F.ceil(duration / s.sample_every_seconds))).cast("bigint")


def sample_positions(first: Column, last: Column, count: Column) -> Column:
    """``count`` whole numbers evenly from first to last, both included, halves to even, each once."""
    step = F.when(count > 1, (last - first) / (count - 1)).otherwise(F.lit(0.0))
    return F.array_distinct(F.transform(F.sequence(F.lit(0).cast("bigint"), count - 1), lambda i: F.bround(first + step * i).cast("bigint")))


def sample_frames(scenes: DataFrame, s: KeyframeSettings | None = None) -> DataFrame:
    """``video_id, scene_id, target, frames``: which frames of each scene are looked at, and how many are to be chosen."""
    s = s or KeyframeSettings()
    start, end = F.col("start_frame"), F.col("end_frame")
    total = F.greatest(end - start, F.lit(1))
    lo = start + F.floor(total * s.edge_margin)
    hi = start + F.floor(total * (1.0 - s.edge_margin)) - 1
    empty = lo >= hi
    lo, hi = F.when(empty, start).otherwise(lo), F.when(empty, F.greatest(end - 1, start)).otherwise(hi)
    target = frame_count(F.col("duration_seconds"), s)
    short = F.col("duration_seconds") < s.short_scene_seconds
    one = {
        "first": F.array(start), "middle": F.array(start + F.floor(total / 2)),
        "diverse": sample_positions(start, F.greatest(end - 1, start), F.lit(max(1, s.short_scene_candidates)).cast("bigint")),
    }[s.short_scene_strategy]
    frames = F.when(short, one).otherwise(sample_positions(lo, hi, target * s.candidate_multiplier))
    return scenes.select("video_id", "scene_id", F.when(short, F.lit(1)).otherwise(target).cast("bigint").alias("target"), frames.alias("frames"))


def gate(frames: DataFrame, by: list[str], s: KeyframeSettings | None = None, film: DataFrame | None = None, duration: str | None = None) -> DataFrame:
    """Frames that are sharp and bright enough and no transition blur; all of a group of which none passes.

    A frame is a transition blur where it is less sharp than ``blur_ratio`` times the sharper of the frames
    ``blur_neighbours`` before and behind it, by frame number. ``film`` has ``by, frame_index, sharpness`` of the frames that
    can be neighbours, if others than the given ones. Frames of scenes shorter than ``short_scene_seconds`` by the column
    ``duration`` all pass. A frame without sharpness or brightness does not.
    """
    s = s or KeyframeSettings()
    bright = F.col("brightness").between(s.min_brightness, s.max_brightness)
    good = (F.col("sharpness") >= s.min_sharpness) & bright
    columns = frames.columns
    if s.reject_blur:
        # each frame's sharpness goes to the two frames that it neighbours: an equi-join on the frame number
        near = F.explode(F.array(F.col("frame_index") - s.blur_neighbours, F.col("frame_index") + s.blur_neighbours)).alias("frame_index")
        around = (film or frames).select(*by, near, F.col("sharpness").alias("__near")).groupBy(*by, "frame_index").agg(F.max("__near").alias("__around"))
        frames = frames.join(around, [*by, "frame_index"], "left")
        good = good & ~F.coalesce(F.col("sharpness") < F.col("__around") * s.blur_ratio, F.lit(False))
    if duration is not None:
        good = good | (F.col(duration) < s.short_scene_seconds)
    marked = frames.withColumn("__ok", F.coalesce(good, F.lit(False)))
    return marked.withColumn("__any", F.max("__ok").over(Window.partitionBy(*by))).filter("__ok or not __any").select(*columns)


def with_selection_scores(frames: DataFrame, by: list[str], s: KeyframeSettings | None = None) -> DataFrame:
    """``quality`` and ``selection_score`` by mode: flow, action, hybrid, or plain quality."""
    s = s or KeyframeSettings()
    w = Window.partitionBy(*by)
    frames = frames.withColumn("quality", S.frame_quality(F.col("sharpness"), F.col("brightness")))
    quality, motion = S.clamp_ratio(F.col("quality"), F.max("quality").over(w)), S.clamp_ratio(F.col("motion"), F.max("motion").over(w))
    score = {
        "flow": 0.75 * motion + 0.25 * quality, "action": s.motion_weight * motion + (1 - s.motion_weight) * quality,
        "hybrid": 0.5 * quality + 0.5 * s.motion_weight * motion,
    }.get(s.mode, F.col("quality"))
    return frames.withColumn("selection_score", F.round(score, 9))


def temporal_window(frame: Column, by: list[str], windows: int) -> Column:
    """The number of the equal-width window of its group's frame range that a frame falls into, from 0."""
    w = Window.partitionBy(*by)
    first, span = F.min(frame).over(w), F.greatest(F.max(frame).over(w) - F.min(frame).over(w) + 1, F.lit(1))
    return F.least(F.floor((frame - first) / span * windows), F.lit(windows - 1)).cast("int")


def _distances(h: np.ndarray, others: np.ndarray) -> np.ndarray:
    total = np.sqrt(h.sum() * others.sum(axis=1))
    with np.errstate(divide="ignore", invalid="ignore"):
        shared = np.where(total > 0, np.sqrt(h[None, :] * others).sum(axis=1) / total, 0.0)
    return np.sqrt(np.maximum(0.0, 1 - shared))


class _Frame:
    """One candidate with what the choice looks at."""

    def __init__(self, row) -> None:
        self.at, self.edge, self.score = int(row.frame_index), float(row.edge_density), float(row.selection_score)
        self.quality = float(getattr(row, "quality", row.selection_score))
        self.h = np.asarray(row.histogram, dtype=np.float64)
        self.f = np.asarray(row.flow if row.flow is not None else [], dtype=np.float64)


def _unlike(c: _Frame, chosen: list[_Frame], s: KeyframeSettings) -> bool:
    """True where a frame differs from all chosen ones in colour, or in edges and (if it counts) in flow."""
    if not chosen:
        return True
    alike = _distances(c.h, np.stack([x.h for x in chosen])) < s.unique_color
    same = alike & (np.abs(c.edge - np.array([x.edge for x in chosen])) < s.unique_edge)
    if s.unique_flow is not None and alike.any():
        flow = np.array([_distances(c.f, x.f[None, :])[0] if len(c.f) and len(x.f) else 1.0 for x in chosen])
        same |= alike & (flow < s.unique_flow)
    return not same.any()


def _spaced(c: _Frame, chosen: list[_Frame], span: int, s: KeyframeSettings) -> bool:
    return all(abs(c.at - x.at) >= max(1, int(span * s.min_temporal_gap)) for x in chosen)


def _by_score(part: pd.DataFrame) -> list[_Frame]:
    return sorted(map(_Frame, part.itertuples()), key=lambda c: (-c.score, c.at))


def _filled(mine: list[_Frame], ranked: list[_Frame], target: int, s: KeyframeSettings) -> list[_Frame]:
    """With ``fill_duplicates`` the next best frames, like or unlike, until the target is reached; in order of time."""
    if s.fill_duplicates:
        mine = mine + [c for c in ranked if c.at not in {x.at for x in mine}][: max(0, target - len(mine))]
    return sorted(mine, key=lambda c: c.at)


def select_in_scene(frames: DataFrame, s: KeyframeSettings | None = None) -> DataFrame:
    """``video_id, scene_id, frame_index, pick``: greedy choice within each scene alone.

    ``frames`` as for :func:`select_diverse`. First the best frame of each of ``target`` equal windows of the scene's range (with
    ``diverse_windows``), then the best of all, each unlike the choice so far and at its distance in time. Scenes are
    independent, so each is a group of its own.
    """
    s = s or KeyframeSettings()

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        ranked, target = _by_score(pdf), int(pdf["target"].iloc[0])
        first, last = min(c.at for c in ranked), max(c.at for c in ranked)
        mine: list[_Frame] = []
        take = lambda c: c.at not in {x.at for x in mine} and _unlike(c, mine, s) and _spaced(c, mine, last - first, s)
        if s.diverse_windows and target > 1:
            window = lambda c: min(int((c.at - first) / max(last - first + 1, 1) * target), target - 1)
            for w in range(target):
                mine += [c for c in ranked if window(c) == w and take(c)][:1]
        for c in ranked:
            if len(mine) < target and take(c):
                mine.append(c)
        mine = _filled(mine, ranked, target, s)
        return pd.DataFrame([(pdf["video_id"].iloc[0], pdf["scene_id"].iloc[0], c.at, k) for k, c in enumerate(mine)], columns=["video_id", "scene_id", "frame_index", "pick"])

    return frames.groupBy("video_id", "scene_id").applyInPandas(choose, "video_id string, scene_id string, frame_index bigint, pick int")


def select_diverse(frames: DataFrame, s: KeyframeSettings | None = None) -> DataFrame:
    """``video_id, scene_id, frame_index, pick``: greedy choice of frames unlike those chosen before.

    ``frames`` has ``video_id, scene_id, scene_order, target, frame_index, selection_score, edge_density, histogram,
    flow``, and ``quality`` if known. A scene's frames are taken by score if they differ from the scene's own choice in
    colour (or edges, or flow), keep their distance in time, and differ from the last ``lookback`` choices of the video. A scene
    that chooses nothing gets its first frame that is new to the video, or none where scenes alike are skipped; else the frame
    that is farthest from the last choices in colour, then in edges, then the best.

    The choice depends on the video's earlier choices only, so scenes are streamed in their order and no more is held than
    one scene's candidates and the last choices, however long the video.
    """
    s = s or KeyframeSettings()
    columns = ["video_id", "scene_id", "frame_index", "pick"]

    def scene_choice(part: pd.DataFrame, recent: list[_Frame]) -> list[_Frame]:
        ranked, target = _by_score(part), int(part["target"].iloc[0])
        span = max(c.at for c in ranked) - min(c.at for c in ranked)
        last = lambda chosen: chosen[-s.lookback :] if s.lookback > 0 else chosen

        def new_to(c: _Frame, chosen: list[_Frame]) -> bool:
            near = last(chosen)
            return not near or (bool((_distances(c.h, np.stack([x.h for x in near])) >= s.cross_color).all()) and _unlike(c, near, s))

        mine: list[_Frame] = []
        for c in ranked:
            if len(mine) == target:
                break
            if _unlike(c, mine, s) and _spaced(c, mine, span, s) and new_to(c, recent + mine):
                mine.append(c)
        if not mine:
            fallback = next((c for c in ranked if new_to(c, recent)), None)
            if fallback is None and not (recent and s.skip_similar_scenes):
                near = last(recent)
                edge = np.mean([x.edge for x in near]) if near else 0.0
                apart = lambda c: _distances(c.h, np.stack([x.h for x in near])).min() if near else 1.0
                fallback = max(ranked, key=lambda c: (apart(c), abs(c.edge - edge) if near else 0.0, c.quality, -c.at))
            mine = [fallback] if fallback else []
        return _filled(mine, ranked, target, s)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        video, recent, held = None, [], None  # the last choices of the present video, the frames of its present scene

        def done() -> pd.DataFrame:
            mine = scene_choice(held, recent)
            recent.extend(mine)
            if s.lookback > 0:
                del recent[: -s.lookback]
            return pd.DataFrame([(held["video_id"].iloc[0], held["scene_id"].iloc[0], c.at, k) for k, c in enumerate(mine)], columns=columns)

        for pdf in batches:
            for (v, _, _), part in pdf.groupby(["video_id", "scene_order", "scene_id"], sort=False):
                if held is not None and (held["video_id"].iloc[0], held["scene_id"].iloc[0]) == (v, part["scene_id"].iloc[0]):
                    held = pd.concat([held, part])
                    continue
                if held is not None:
                    yield done()
                if v != video:
                    video, recent = v, []
                held = part
        if held is not None:
            yield done()

    ordered = frames.filter("video_id is not null").repartition("video_id").sortWithinPartitions("video_id", "scene_order", "scene_id", "frame_index")
    return ordered.mapInPandas(run, "video_id string, scene_id string, frame_index bigint, pick int")


def segment(frames: DataFrame, by: str, at: str, score: str, threshold: float, min_length: int = 1) -> DataFrame:
    """``by, scene_no, start_at, end_at, n``: scenes between frames whose score jumps by more than ``threshold``.

    Gaps and islands: a running count of cuts numbers the scenes. A cut less than ``min_length`` rows after the last accepted
    one (or the beginning) is none. A group without cuts is one scene.
    """
    order = Window.partitionBy(by).orderBy(at)
    jump = F.abs(F.col(score) - F.lag(score).over(order)) > threshold
    return _cut(frames.filter(F.col(by).isNotNull() & F.col(at).isNotNull()), by, at, F.coalesce(jump, F.lit(False)), min_length)


def _cut(rows: DataFrame, by: str, at: str, cut: Column, min_length: int) -> DataFrame:
    order = Window.partitionBy(by).orderBy(at)
    rows = rows.withColumn("__n", F.row_number().over(order)).withColumn("__cut", cut)
    if min_length > 1:
        # which cuts are accepted depends on the last accepted one: a fold over the cuts alone, which are few beside the frames
        cuts = F.array_sort(F.collect_list(F.when(F.col("__cut"), F.col("__n"))))
        accepted = F.aggregate(
            "cuts", F.struct(F.lit(1).alias("last"), F.array().cast("array<int>").alias("kept")),
            lambda acc, n: F.when(n - acc["last"] >= min_length, F.struct(n.alias("last"), F.concat(acc["kept"], F.array(n)).alias("kept"))).otherwise(acc),
        )["kept"]
        kept = rows.groupBy(by).agg(cuts.alias("cuts")).select(by, F.explode(accepted).alias("__n"), F.lit(True).alias("__kept"))
        rows = rows.join(kept, [by, "__n"], "left").withColumn("__cut", F.coalesce("__kept", F.lit(False)))
    rows = rows.withColumn("scene_no", F.sum(F.col("__cut").cast("int")).over(order))
    return rows.groupBy(by, "scene_no").agg(F.min(at).alias("start_at"), F.max(at).alias("end_at"), F.count(F.lit(1)).alias("n"))


def segment_by_content(frames: DataFrame, by: str, at: str, score: str, threshold: float = 27.0, min_length: int = 15) -> DataFrame:
    """Scenes between frames whose content score (the change from the frame before) is at least ``threshold``; as :func:`segment`."""
    rows = frames.filter(F.col(by).isNotNull() & F.col(at).isNotNull())
    return _cut(rows, by, at, F.coalesce(F.col(score) >= threshold, F.lit(False)), min_length)


def segment_adaptive(frames: DataFrame, by: str, at: str, score: str, ratio: float = 3.0, window: int = 2, least: float = 15.0, min_length: int = 15) -> DataFrame:
    """Scenes between frames whose content score is at least ``ratio`` times the mean of the ``window`` frames before and
    behind it, and at least ``least``; where all of those are 0 a score of ``least`` is enough. As :func:`segment`.

    Frames without ``window`` neighbours on both sides are no cuts.
    """
    rows = frames.filter(F.col(by).isNotNull() & F.col(at).isNotNull())
    near = Window.partitionBy(by).orderBy(at).rowsBetween(-window, window)
    around = (F.sum(score).over(near) - F.col(score)) / (2.0 * window)
    whole = F.count(score).over(near) == 2 * window + 1
    times = F.when(F.abs(around) < 1e-5, F.when(F.col(score) >= least, F.lit(255.0)).otherwise(0.0)).otherwise(F.least(F.col(score) / around, F.lit(255.0)))
    return _cut(rows, by, at, F.coalesce(whole & (times >= ratio) & (F.col(score) >= least), F.lit(False)), min_length)


def segment_by_histogram(frames: DataFrame, by: str, at: str, histogram: str, threshold: float = 0.05, min_length: int = 15) -> DataFrame:
    """Scenes between frames whose histograms correlate less than 1 - ``threshold`` with the one before; as :func:`segment`."""
    rows = frames.filter(F.col(by).isNotNull() & F.col(at).isNotNull())
    before = F.lag(histogram).over(Window.partitionBy(by).orderBy(at))
    return _cut(rows, by, at, F.coalesce(S.correlation(F.col(histogram), before) <= 1.0 - threshold, F.lit(False)), min_length)
