"""The batch rule on one run of rows, as numpy helpers used inside Spark tasks.

A batch that starts at row p ends before the first row q where one of these holds:

* it already has ``max_items`` rows (closed by the last of them),
* its bytes with row q would exceed ``max_bytes``,
* row q is more than ``timeout_ms`` later than the previous cut.

Bytes are the row's own size plus its stream's size when the stream is new in the batch. The first
row is always taken. The ends of the batches that could start at each row are found for all rows at once
(``furthest``), without a loop over rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ITEMS, BYTES, DRAIN = "MAX_ITEMS", "MAX_BYTES", "DRAIN"
OPEN = ""


@dataclass(frozen=True)
class Limits:
    max_items: int
    max_bytes: int
    timeout_ms: int | None = None

    @property
    def clocks(self) -> int:
        """Variants of a batch start: the last cut was made by the row itself, or by the one before."""
        return 1 if self.timeout_ms is None else 2


class Run:
    """Consecutive rows of one shard in order. ``ts_before`` is the time of the row before them."""

    def __init__(self, own_bytes, streams, stream_bytes, ts=None, ts_before=None):
        self.own_bytes = np.asarray(own_bytes, dtype=np.int64)
        self.streams = np.asarray(streams)
        self.stream_bytes = np.asarray(stream_bytes, dtype=np.int64)
        self.ts = None if ts is None else np.asarray(ts, dtype=np.int64)
        self.ts_before = ts_before
        n = len(self.own_bytes)
        order = np.argsort(self.streams, kind="stable")
        same = self.streams[order[1:]] == self.streams[order[:-1]] if n else np.zeros(0, bool)
        # index of the previous row of the same stream, or -1
        self.previous = np.full(n, -1, dtype=np.int64)
        self.previous[order[1:][same]] = order[:-1][same]

    def __len__(self) -> int:
        return len(self.own_bytes)

    def clock(self, start: int, by_items: int) -> int:
        """Time of the cut that made ``start`` the first row of a batch."""
        if not by_items:
            return int(self.ts[start])
        return int(self.ts[start - 1] if start else self.ts_before)


def end_of_batch(run: Run, start: int, clock: int | None, limits: Limits, guess: int):
    """(end, condition) of the batch starting at ``start``; OPEN when the rows run out first."""
    n = len(run)
    full = min(start + limits.max_items, n)
    hi = min(start + max(guess, 1), full)
    while True:
        rows = slice(start, hi)
        cost = run.own_bytes[rows] + np.where(run.previous[rows] < start, run.stream_bytes[rows], 0)
        fits = max(1, int(np.searchsorted(np.cumsum(cost), limits.max_bytes, side="right")))
        end, why = start + fits, BYTES
        if limits.timeout_ms is not None:
            late = np.flatnonzero(run.ts[start + 1:hi] > clock + limits.timeout_ms)
            if len(late) and start + 1 + late[0] <= end:
                end, why = start + 1 + int(late[0]), DRAIN
        if end < hi:
            return end, why
        if hi == full:
            return full, ITEMS if full - start == limits.max_items else OPEN
        hi = min(start + (hi - start) * 4, full)


def batches(run: Run, start: int, until: int, clock: int | None, limits: Limits):
    """Yield (start, end, condition) of the batches that start before ``until``."""
    guess = 64
    while start < until:
        end, why = end_of_batch(run, start, clock, limits, guess)
        yield start, end, why
        if why == OPEN:
            return
        if limits.timeout_ms is not None:
            clock = int(run.ts[end - 1] if why == ITEMS or end == len(run) else run.ts[end])
        guess, start = (end - start) * 2, end


def furthest(run: Run, own: int, limits: Limits) -> np.ndarray:
    """End by items or bytes of a batch starting at each of the first ``own`` rows.

    The ends never move back, so a window that slides over the rows finds them. Many windows slide at
    once, each over a stretch of starts of its own: a step moves every window's end or its start by one
    row, whose cost follows from the rows before and behind it of the same stream.
    """
    n = len(run)
    by_items = np.minimum(np.arange(own) + limits.max_items, n)
    sums = np.concatenate([[0], np.cumsum(run.own_bytes)])
    firsts = run.stream_bytes[run.previous < 0].sum()
    if not own or (sums[by_items] - sums[:own]).max() + firsts <= limits.max_bytes:
        return by_items
    # rows a window holds at most, if none of its streams is new: about what each has to fill first
    width = max(1, int((np.searchsorted(sums, sums[:own:64] + limits.max_bytes) - np.arange(0, own, 64)).mean()))
    stretch = max(64, min(width, limits.max_items) // 2)
    following = np.full(n, n, dtype=np.int64)
    follows = np.flatnonzero(run.previous >= 0)
    following[run.previous[follows]] = follows
    # a row that never fits ends the table
    own_bytes, stream_bytes = np.append(run.own_bytes, 0), np.append(run.stream_bytes, 0)
    previous = np.append(run.previous, -1)
    out = np.empty(own, dtype=np.int64)
    p = np.arange(0, own, stretch)
    q, until, total = p.copy(), np.minimum(p + stretch, own), np.zeros(len(p), np.int64)
    while len(p):
        more = total + own_bytes[q] + np.where(previous[q] < p, stream_bytes[q], 0)
        grow = (q < by_items[p]) & ((more <= limits.max_bytes) | (q == p))
        out[p] = q
        less = total - own_bytes[p] - np.where(following[p] >= q, stream_bytes[p], 0)
        total = np.where(grow, more, less)
        q = q + grow
        p = p + ~grow
        done = p == until
        if done.any():
            left = ~done
            p, q, until, total = p[left], q[left], until[left], total[left]
    return out


def first_late(run: Run, clocks: np.ndarray, limit: np.ndarray, timeout_ms: int) -> np.ndarray:
    """First row after each start, before ``limit``, later than its clock by more than the timeout."""
    starts = np.arange(len(clocks))
    due = clocks + timeout_ms
    late = np.searchsorted(np.maximum.accumulate(run.ts), due, side="right")
    # where that row is not behind the start, mostly the very next one is late as well
    early = np.flatnonzero(late <= starts)
    after = np.minimum(early + 1, len(run) - 1)
    at_once = (after > early) & (run.ts[after] > due[early])
    late[early[at_once]] = after[at_once]
    # and otherwise times are out of order: look at the rows themselves
    for p in early[~at_once]:
        hits = np.flatnonzero(run.ts[p + 1:limit[p]] > due[p])
        late[p] = p + 1 + hits[0] if len(hits) else limit[p]
    return np.minimum(late, limit)


def transfer(run: Run, own: int, limits: Limits) -> tuple[np.ndarray, np.ndarray]:
    """What a stretch of ``own`` rows does to any batch start that may reach it.

    State ``offset * clocks + by_items`` is a batch starting ``offset`` rows into the stretch. For
    each of them: the state in which the next stretch is entered, and the batches started here.
    """
    limit = furthest(run, own, limits)
    starts = np.arange(own)
    ends, items = [], []
    for by_items in range(limits.clocks):
        end, full = limit, limit - starts == limits.max_items
        if limits.timeout_ms is not None:
            clocks = run.ts[:own]
            if by_items:
                before = run.ts[0] if run.ts_before is None else run.ts_before
                clocks = np.concatenate([[before], run.ts[: own - 1]])
            end = first_late(run, clocks, limit, limits.timeout_ms)
            full = full & (end == limit)
        ends.append(end)
        items.append(full.astype(np.int64) if limits.clocks == 2 else np.zeros(own, np.int64))
    size = own * limits.clocks
    target = np.stack(
        [end * limits.clocks + full for end, full in zip(ends, items)], axis=1
    ).reshape(size)
    count = np.ones(size, dtype=np.int64)
    inside = target < size
    while inside.any():
        jump = np.where(inside, target, 0)
        count = count + np.where(inside, count[jump], 0)
        target = np.where(inside, target[jump], target)
        inside = target < size
    states = limits.max_items * limits.clocks
    return target[:states] - size, count[:states]


def compose(tables) -> tuple[np.ndarray, np.ndarray]:
    """One transfer for consecutive stretches."""
    target = count = None
    for exits, counts in tables:
        if target is None:
            target, count = exits.copy(), counts.copy()
        else:
            count += counts[target]
            target = exits[target]
    return target, count
