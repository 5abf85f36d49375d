"""Optimal assignment of detections to tracks, video by video (J18 of the survey)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from framewell.operators.matching import cheapest_matching

# Fixed values, which results depend on: a match needs a cosine of 0.5 and a move of at most 0.5 for each frame since the
# track was seen; it costs 0.7 of the cosine distance and 0.3 of the move. A track is active for 3 frames without a match
# and lost for 10 more, from which a cosine of 0.6 brings it back. Half of the old look stays when a track is seen.
MATCH_COSINE, REVIVE_COSINE = 0.5, 0.6
LOOK_WEIGHT, MOVE_WEIGHT = 0.7, 0.3
MOVE_A_FRAME = 0.5
ACTIVE_FRAMES, LOST_FRAMES = 3, 10
OLD_LOOK = 0.5


@dataclass(frozen=True)
class Tracking:
    """What may be set otherwise than the fixed values."""

    match_cosine: float = MATCH_COSINE
    revive_cosine: float = REVIVE_COSINE
    weights: tuple[float, float] = (LOOK_WEIGHT, MOVE_WEIGHT)
    move: float = MOVE_A_FRAME
    frames: tuple[int, int] = (ACTIVE_FRAMES, LOST_FRAMES)
    old_look: float = OLD_LOOK


def _unit(x: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(x, axis=-1, keepdims=True)
    return x / np.where(size < 1e-8, 1.0, size)


class _View:
    """Tracks of one video that can still be met, one entry each in parallel arrays; others are forgotten."""

    def __init__(self, how: Tracking, width: int):
        self.how, self.next = how, 0
        self.track, self.last = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.look, self.centre = np.zeros((0, width)), np.zeros((0, 2))

    def frame(self, now: int, look: np.ndarray, centre: np.ndarray) -> np.ndarray:
        """Track numbers of the detections of frame ``now``; frames are numbered without gaps."""
        look = _unit(look)
        missed = now - self.last - 1
        keep = missed <= sum(self.how.frames)
        self.track, self.last, self.look, self.centre, missed = (a[keep] for a in (self.track, self.last, self.look, self.centre, missed))
        cosine = self.look @ look.T
        entry = np.full(len(look), -1)
        active = np.flatnonzero(missed <= self.how.frames[0])
        if len(active):
            move = np.linalg.norm(self.centre[active, None] - centre, axis=-1)
            allowed = (cosine[active] >= self.how.match_cosine) & (move <= self.how.move * (missed[active, None] + 1))
            one, other = cheapest_matching(self.how.weights[0] * (1 - cosine[active]) + self.how.weights[1] * move, allowed)
            entry[other] = active[one]
        lost = set(np.flatnonzero(missed > self.how.frames[0]).tolist())
        for d in np.flatnonzero(entry < 0):
            like = max(lost, key=lambda e: (cosine[e, d], -e), default=None)
            if like is not None and cosine[like, d] >= self.how.revive_cosine:
                entry[d] = like
                lost.remove(like)
        seen = np.flatnonzero(entry >= 0)
        at = entry[seen]
        self.look[at] = _unit(self.how.old_look * self.look[at] + (1 - self.how.old_look) * look[seen])
        self.centre[at], self.last[at] = centre[seen], now
        new = np.flatnonzero(entry < 0)
        entry[new] = len(self.track) + np.arange(len(new))
        self.track = np.concatenate([self.track, self.next + np.arange(len(new))])
        self.last = np.concatenate([self.last, np.full(len(new), now)])
        self.look, self.centre = np.concatenate([self.look, look[new]]), np.concatenate([self.centre, centre[new]])
        self.next += len(new)
        return self.track[entry]


def assign_tracks(df: DataFrame, video: str, frame: str, slot: str, vector: str, x: str, y: str, how: Tracking = Tracking()) -> DataFrame:
    """A track number for each detection of a video (J18): video, frame, slot, track.

    Frames are taken in order; the detections of a frame and the active tracks are matched at least total cost, as many
    as the gates allow. What is left revives the most similar lost track or starts one. Videos are the unit of
    parallelism: a video's frames depend on each other, and their number is bounded by its sampling. Rows without a
    vector or centre take no part.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        view, parts = None, []
        for at, (_, rows) in enumerate(pdf.sort_values([frame, slot]).groupby(frame, sort=True)):
            look = np.array(rows[vector].tolist(), float)
            view = view or _View(how, look.shape[1])
            parts.append(rows[[video, frame, slot]].assign(track=view.frame(at, look, rows[[x, y]].to_numpy(float))))
        return pd.concat(parts)

    kind = lambda c: df.schema[c].dataType.simpleString()
    rows = df.select(video, frame, slot, vector, x, y).dropna()
    return rows.groupBy(video).applyInPandas(run, f"{video} {kind(video)}, {frame} {kind(frame)}, {slot} {kind(slot)}, track long")
