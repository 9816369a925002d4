"""The technical panel of every date as the market saw it at that date's own release instant.

A correction of an earlier date becomes public between two release instants; the recurrences must then run anew from
the corrected date on. So each series is scanned once, in order of its dates: the values visible
so far are held in arrays beside the state of every recurrence, what became public since the last date is written into
them, and the states are brought up to date from the earliest date written. A date costs as many steps as the
corrections that it sees reach back. One of the states is the digest of what was read, so every row says what its own
instant saw.

Closes are summed as whole millionths, so a sum is the same however often it is resumed; prices of more than six
decimal places would be rounded to six in the moving averages.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.rounding import half_up_values
from tidemark.operators.metrics import METRICS, NEUTRAL_RSV, SERIES, WINDOWS, of_like_length, whole_series
from tidemark.operators.sizes import clustered

NAN = float("nan")
ALL = slice(None)
#: Versions of whole series that a task scans at once.
ROWS_AT_ONCE = 200_000
BARS = ("high", "low", "close", "volume")
#: Parts of one that averages of close and volume are summed in, as whole numbers.
UNITS = np.array([[1e6], [1.0]])
LENGTHS = np.array(WINDOWS)
#: Smoothing, adjustment and least number of values of the means that are stepped together: K, the fast and the slow
#: mean, gains and losses of both RSI; then those of the first ones' results, D and the signal line.
FIRST = [(1 / 3, False, 1), (2 / 13, False, 1), (2 / 27, False, 1)] + [(1 / p, True, p) for p in (6, 6, 12, 12)]
SECOND = [(1 / 3, False, 1), (2 / 10, False, 1)]


class RunningMeans:
    """Exponential means along series, with their states after every place (decay across gaps): a row a kind of mean."""

    def __init__(self, n: int, width: int, kinds: Sequence[tuple[float, bool, int]]):
        alpha, self.adjust, self.least = (np.array(k)[:, None] for k in zip(*kinds))
        self.keep, self.new = 1 - alpha, np.where(self.adjust, 1.0, alpha)
        self.mean, self.weight = np.full((n + 1, len(kinds), width), NAN), np.ones((n + 1, len(kinds), width))
        self.seen = np.zeros((n + 1, len(kinds), width), np.int32)

    def step(self, i: int, value: np.ndarray, cols: slice | np.ndarray = ALL) -> np.ndarray:
        """Take the values of place ``i`` of the series ``cols`` in; the means after it, nan below the least number of values."""
        mean, known = self.mean[i][:, cols], value == value
        started = mean == mean
        weight = self.weight[i][:, cols] * self.keep
        heavier = weight + self.new
        after = np.where(mean == value, mean, (weight * mean + self.new * value) / heavier)
        heavier = np.where(self.adjust, heavier, 1.0)
        if not (known & started).all():
            weight = np.where(started, weight, 1.0)
            after = np.where(known, np.where(started, after, value), mean)
            heavier = np.where(known & started, heavier, weight)
        seen = self.seen[i][:, cols] + known
        self.mean[i + 1][:, cols], self.seen[i + 1][:, cols], self.weight[i + 1][:, cols] = after, seen, heavier
        return np.where(seen >= self.least, after, NAN)


class Scan:
    """The visible values of ``width`` series of up to ``n`` dates and what is computed along them, a row a place and a
    column a series."""

    def __init__(self, n: int, width: int):
        self.bars = np.full((len(BARS), n, width), NAN)
        self.first, self.second = RunningMeans(n, width, FIRST), RunningMeans(n, width, SECOND)
        #: Running sums of close and volume, as whole numbers, and counts of the values that are there.
        self.sums, self.counts = np.zeros((n + 1, 2, width), np.int64), np.zeros((n + 1, 2, width), np.int32)
        self.last: list[np.ndarray] = []

    def step(self, i: int, cols: slice | np.ndarray = ALL) -> None:
        """Bring the states of place ``i`` of the series ``cols`` up to date, those before it being so."""
        value = self.bars[2:, i][:, cols]
        known = value == value
        self.sums[i + 1][:, cols] = self.sums[i][:, cols] + np.rint(np.where(known, value, 0.0) * UNITS).astype(np.int64)
        self.counts[i + 1][:, cols] = self.counts[i][:, cols] + known
        close = value[0]
        rsv = np.full(len(close), NEUTRAL_RSV)
        if i >= 8:
            high, low = self.bars[0, i - 8 : i + 1][:, cols].max(0), self.bars[1, i - 8 : i + 1][:, cols].min(0)
            rsv = np.where((close == close) & (high > low), (close - low) / (high - low) * 100, NEUTRAL_RSV)
        change = close - self.bars[2, i - 1][cols] if i else np.full(len(close), NAN)
        rise, fall = np.maximum(change, 0.0), np.maximum(-change, 0.0)
        means = self.first.step(i, np.stack([rsv, close, close, rise, fall, rise, fall]), cols)
        dif = means[1] - means[2]
        d, dea = self.second.step(i, np.stack([means[0], dif]), cols)
        gain, loss = means[3::2], means[4::2]
        rsi = np.where(loss == 0, np.where(gain > 0, 100.0, NAN), 100 - 100 / (1 + gain / loss))
        self.last = [means[0], d, *rsi, dif, dea, dif - dea]

    def row(self, i: int, out: np.ndarray) -> None:
        """Put the panels of place ``i``, whose states are the last computed, into ``out``: a row a metric."""
        before = np.maximum(i + 1 - LENGTHS, 0)
        whole = self.counts[i + 1] - self.counts[before] == LENGTHS[:, None, None]
        average = (self.sums[i + 1] - self.sums[before]) / UNITS / LENGTHS[:, None, None]
        n = len(LENGTHS)
        out[:n], out[n : 2 * n] = np.where(whole, average, NAN).swapaxes(0, 1)
        middle = out[WINDOWS.index(20)]
        width = 2 * np.std(self.bars[2, i - 19 : i + 1], axis=0, ddof=1) if i >= 19 else np.full(len(middle), NAN)
        for k, value in enumerate([*self.last, middle + width, middle, middle - width], 2 * n):
            out[k] = value


def read_digests(
    places: int, turns: Sequence[int], place: Sequence[int], items: Sequence[bytes]
) -> tuple[list[int], list[str]]:
    """The number and the digest of what each of a series' dates has read. Versions are written in order of ``turns``, the
    dates at which each is seen; ``place`` is each one's own date."""
    digests, inputs = [hashlib.sha256()] * (places + 1), [0] * (places + 1)
    held: list[bytes] = [b""] * places
    counts, prints, at, n = [], [], 0, len(turns)
    for i in range(places):
        start = i
        while at < n and turns[at] == i:
            p = place[at]
            held[p] = items[at]
            if p < start:
                start = p
            at += 1
        for j in range(start, i + 1):
            digest, count, item = digests[j], inputs[j], held[j]
            if item:
                digest = digest.copy()
                digest.update(b"," + item if count else item)
                count += 1
            digests[j + 1], inputs[j + 1] = digest, count
        counts.append(count)
        prints.append(digest.hexdigest())
    return counts, prints


def written(cell: np.ndarray, turns: np.ndarray, available: np.ndarray, recorded: np.ndarray) -> np.ndarray:
    """The versions that are ever seen, by their cell (a series' date) and turn: of those that a cell gets at one turn the
    last, and none that was recorded before one which became available earlier."""
    order = np.lexsort((recorded, available, cell))
    age = np.unique(recorded[order], return_inverse=True)[1]
    begins = np.r_[True, cell[order][1:] != cell[order][:-1]][: len(order)]
    age = age + np.cumsum(begins) * len(order)
    order = order[age == np.maximum.accumulate(age)]
    c, t = cell[order], turns[order]
    return order[np.r_[(c[1:] != c[:-1]) | (t[1:] != t[:-1]), True][: len(order)]]


def scan_series(
    dates: Sequence[np.ndarray],
    cutoffs: Sequence[np.ndarray],
    place: Sequence[np.ndarray],
    available: Sequence[np.ndarray],
    recorded: Sequence[np.ndarray],
    values: Sequence[np.ndarray],
    items: Sequence[Sequence[bytes]],
) -> list[tuple[np.ndarray, list[int], list[str]]]:
    """The panel rows of each series, with the number and the digest of what each has read: their ``dates`` with their
    ``cutoffs``, and versions with their date's place, instants, values and item of the digest.

    All series step together at each place; a correction of an earlier one is followed up to it in its own series."""
    sizes = np.array([len(d) for d in dates])
    width, longest = len(sizes), sizes.max()
    own = np.repeat(np.arange(width), [len(p) for p in place])
    seen = np.concatenate([np.searchsorted(c, a, "left") for c, a in zip(cutoffs, available)])
    place = np.concatenate(place)
    turns, shown = np.maximum(seen, place), np.flatnonzero(seen < sizes[own])
    instants = (np.concatenate(x)[shown] for x in (available, recorded))
    found = shown[written((own * longest + place)[shown], turns[shown], *instants)]
    found = found[np.lexsort((turns[found], own[found]))]
    names = [x for part in items for x in part]
    ends = np.searchsorted(own[found], np.arange(width + 1))
    marks = []
    for s in range(width):
        own_moves = found[ends[s] : ends[s + 1]]
        at = [names[v] for v in own_moves.tolist()]
        marks.append(read_digests(len(dates[s]), turns[own_moves].tolist(), place[own_moves].tolist(), at))
    found = found[np.argsort(turns[found], kind="stable")]
    ends = np.searchsorted(turns[found], np.arange(longest + 1))
    place, own, values = place[found], own[found], np.concatenate(values)[found].T
    scan, panels = Scan(longest, width), np.empty((longest, len(METRICS), width))
    with np.errstate(invalid="ignore", divide="ignore"):
        for i in range(longest):
            here = slice(ends[i], ends[i + 1])
            p, s = place[here], own[here]
            scan.bars[:, p, s] = values[:, here]
            late = p < i
            if late.any():
                since = np.full(width, i)
                np.minimum.at(since, s[late], p[late])
                for j in range(since.min(), i):
                    scan.step(j, np.flatnonzero(since <= j))
            scan.step(i)
            scan.row(i, panels[i])
    return [(panels[: len(dates[s]), :, s], *marks[s]) for s in range(width)]


def day_texts(days: np.ndarray) -> np.ndarray:
    """``yyyy-MM-dd`` of days since 1970, a row of ten bytes each."""
    kinds, which = np.unique(days, return_inverse=True)
    return np.datetime_as_string(kinds.astype("datetime64[D]")).astype("S10").view(np.uint8).reshape(-1, 10)[which]


def input_items(days: np.ndarray, recorded: np.ndarray) -> list[bytes]:
    """``date@recorded`` of versions (days since 1970, microseconds), instants in UTC to the microsecond, without a fraction
    where there is none."""
    day, rest = np.divmod(recorded, 86_400_000_000)
    seconds, micros = np.divmod(rest, 1_000_000)
    text = np.empty((len(days), 36), np.uint8)
    text[:] = np.frombuffer(b"0000-00-00@0000-00-00T00:00:00+00:00", np.uint8)
    text[:, :10], text[:, 11:21] = day_texts(days), day_texts(day)
    for at, unit, most in ((22, 36_000, 10), (23, 3_600, 10), (25, 600, 6), (26, 60, 10), (28, 10, 6), (29, 1, 10)):
        text[:, at] += (seconds // unit % most).astype(np.uint8)
    items = text.view("S36").ravel().tolist()
    for v in np.flatnonzero(micros).tolist():
        items[v] = items[v][:30] + b".%06d" % micros[v] + items[v][30:]
    return items


def rolling_panel(
    available: DataFrame,
    rule: Callable[[Column], Column],
    series: Sequence[str] = SERIES,
    date: str = "trade_date",
    places: Mapping[str, int] | None = None,
    dealt: bool = False,
) -> DataFrame:
    """The 22 metrics of every date from the versions public at its own release instant ``rule(date)``, with ``input_count``
    and ``input_fingerprint`` of the versions it read (E18: SHA-256 over their ``date@recorded``, comma-joined).

    ``available`` has the series, the date, recorded_at, available_at, high, low, close and volume. A task scans
    some hundred series at once; only what it needs is shuffled, and nothing if ``dealt``: every series lies in one partition.
    With ``places`` metrics are rounded half up where they are computed, as Spark's ``round`` does.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp_ntz").cast("timestamp"))
    own = F.unix_micros(rule(F.col(date)).cast("timestamp")).alias("__cutoff")
    rows = available if dealt else clustered(available, series)
    rows = rows.sortWithinPartitions(*series, date).select(
        *series,
        F.unix_date(date).alias("__d"),
        micros("recorded_at").alias("__r"),
        micros("available_at").alias("__a"),
        own,
        *[F.col(c).cast("double").alias(c) for c in BARS],
    )
    schema = T.StructType(
        [available.schema[c] for c in (*series, date)]
        + [T.StructField(m, T.DoubleType()) for m in METRICS]
        + [T.StructField("input_count", T.LongType()), T.StructField("input_fingerprint", T.StringType())]
    )
    digits = np.array([places[m] for m in METRICS]) if places else None

    def side_by_side(chunk: pd.DataFrame, begins: np.ndarray, ends: np.ndarray, kinds: pa.Schema) -> pa.RecordBatch:
        """Some series of a chunk, which lie from ``begins`` to ``ends``."""
        lengths = ends - begins
        starts = np.cumsum(lengths) - lengths
        rows = np.arange(lengths.sum()) + np.repeat(begins - starts, lengths)
        days, recorded, instants, cutoffs = (
            chunk[c].astype("int64").to_numpy()[rows] for c in ("__d", "__r", "__a", "__cutoff")
        )
        new = np.r_[True, days[1:] != days[:-1]]
        new[starts] = True
        number, heads = np.cumsum(new) - 1, np.flatnonzero(new)
        edges, firsts = starts[1:], number[starts]
        by_series = lambda x: np.split(x, edges)
        by_date = lambda x: np.split(x[heads], firsts[1:])
        names, z = input_items(days, recorded), np.append(edges, len(rows))
        scanned = scan_series(
            by_date(days),
            by_date(cutoffs),
            by_series(number - np.repeat(firsts, lengths)),
            by_series(instants),
            by_series(recorded),
            by_series(chunk[list(BARS)].to_numpy(float)[rows]),
            [names[a:b] for a, b in zip(starts, z)],
        )
        panels = np.concatenate([x[0] for x in scanned])
        if digits is not None:
            panels = half_up_values(panels, digits)
        sizes = np.diff(np.append(firsts, len(heads)))
        which = pa.array(np.repeat(np.arange(len(begins)), sizes))
        keys = [pa.array(chunk[c].to_numpy()[begins], kinds.field(c).type).take(which) for c in series]
        return pa.RecordBatch.from_arrays(
            [
                *keys,
                pa.array(days[heads].astype(np.int32)).cast(pa.date32()),
                *[pa.array(x, from_pandas=True) for x in np.ascontiguousarray(panels.T)],
                pa.array([n for x in scanned for n in x[1]], pa.int64()),
                pa.array([t for x in scanned for t in x[2]], pa.string()),
            ],
            names=schema.names,
        )

    def along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: list[pa.Schema] = []

        def frames() -> Iterator[pd.DataFrame]:
            for batch in batches:
                kinds[:] = [batch.schema]
                yield batch.to_pandas()

        for chunk, begins in whole_series(frames(), series, ROWS_AT_ONCE):
            ends = np.append(begins[1:], len(chunk))
            for part in of_like_length(ends - begins):
                yield side_by_side(chunk, begins[part], ends[part], kinds[0])

    return rows.mapInArrow(along, schema)
