"""Sampled windows of a series by a prefix scan over functions.

A sample starts with a record and closes a window later, or after so many records; where it starts depends on where the
one before started, and so on back to the first record. Yet what a chunk of records does to the sample that is open when
it begins is a function of that sample alone, and a simple one: the later the open sample started, the later the last
sample of the chunk starts. So every chunk is turned into a step function, all chunks at once; the functions are applied
one after the other, which moves one open sample along a small table; and then every chunk, knowing what it begins with,
sums its records up, again all at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.ordering import CHUNK_ROWS, range_chunks
from tidemark.session import by_value

# Default sampling.
SAMPLES = 2
SAMPLE_WINDOW_MS = 30_000

_CHUNK = "__chunk"

_STEPS = ("series {kind}, __chunk bigint, size bigint, through boolean, last_t bigint, end_t array<bigint>, end_place array<bigint>, "
          "start_t array<bigint>, start_place array<bigint>, start_order array<bigint>")
_OPEN = "series {kind}, __chunk bigint, open_t bigint, open_place bigint, open_order bigint"
_SUMS = "series {kind}, first bigint, start_ms bigint, n bigint, s double, lo double, hi double"


@dataclass
class Steps:
    """What some records in a row do to the sample that is open before them.

    An open sample has a start time and a start place; places count records from the first one here, so it is negative.
    If its window ends by ``end_t[i]``, or its records run out by ``end_place[i]``, for the first time at step ``i``, then
    the last sample of these records starts at ``start_t[i]``, ``start_place[i]`` (``start_order`` names that record).
    ``through`` says whether a sample may stay open past all of them; it does so beyond the last step.
    """

    size: int
    first_t: int
    through: bool
    end_t: np.ndarray
    end_place: np.ndarray
    start_t: np.ndarray
    start_place: np.ndarray
    start_order: np.ndarray

    @staticmethod
    def of(t: np.ndarray, order: np.ndarray, window: int, limit: int | None) -> Steps:
        """Steps of records in order; ``limit`` records at most are in a sample."""
        n = len(t)
        place = np.arange(n)
        after = np.searchsorted(t, t + window, "left")
        reach = int(np.searchsorted(t, t[0] + window, "left"))
        if limit is not None:
            after = np.minimum(after, place + limit)
            reach = min(reach, limit - 1)
        # Follow each start to the last one here, doubling the stride.
        last = np.where(after >= n, place, np.minimum(after, n - 1))
        while True:
            further = last[last]
            if (further == last).all():
                break
            last = further
        # Only records up to ``reach`` can be the first start after an open sample.
        last = last[:min(reach, n - 1) + 1]
        end = np.append(np.flatnonzero(last[1:] != last[:-1]), len(last) - 1)
        start = last[end]
        return Steps(n, int(t[0]), reach >= n, t[end], end, t[start], start, order[start])

    def find(self, start_t, start_place, window: int, limit: int | None) -> np.ndarray:
        """The step of open samples; as many as there are steps where they stay open."""
        step = np.searchsorted(self.end_t, start_t + window, "left")
        if limit is not None:
            step = np.minimum(step, np.searchsorted(self.end_place, start_place + limit, "left"))
        return step

    def then(self, other: Steps, window: int, limit: int | None) -> Steps:
        """These records and, right behind them, those of ``other``."""
        place = self.start_place - self.size
        step = other.find(self.start_t, place, window, limit)
        moved = step < len(other.end_t)
        at = np.minimum(step, len(other.end_t) - 1)
        start_t = np.where(moved, other.start_t[at], self.start_t)
        start_place = np.where(moved, other.start_place[at], place) + self.size
        start_order = np.where(moved, other.start_order[at], self.start_order)
        parts = [[self.end_t, self.end_place, start_t, start_place, start_order]]
        if self.through:
            parts.append([other.end_t, other.end_place + self.size, other.start_t, other.start_place + self.size, other.start_order])
        columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
        keep = np.append(columns[3][1:] != columns[3][:-1], True)
        both = Steps(self.size + other.size, self.first_t, True, *(c[keep] for c in columns))
        # No open sample started later than with the record before the first one here.
        last = int(both.find(self.first_t, -1, window, limit))
        if last < len(both.end_t):
            both = Steps(both.size, self.first_t, False, *(c[:last + 1] for c in (
                both.end_t, both.end_place, both.start_t, both.start_place, both.start_order)))
        return both


def _runs(*columns: list) -> list[tuple[int, int]]:
    """Begin and end of runs of equal keys."""
    keys = list(zip(*columns, strict=True))
    border = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
    return list(zip(border[:-1], border[1:], strict=True)) if keys else []


def _blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    held, count = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            held.append(batch.slice(at, rows))
            count += held[-1].num_rows
            if count >= rows:
                yield pa.Table.from_batches(held)
                held, count = [], 0
    if count:
        yield pa.Table.from_batches(held)


def _chunk_steps(rows: DataFrame, kind: str, window: int, limit: int | None, block_rows: int) -> DataFrame:
    """One function for each series in each chunk, put together from those of its blocks."""

    def run(batches):
        key, made, last_t = None, None, 0

        def out():
            lists = [pa.array([x], pa.list_(pa.int64())) for x in (made.end_t, made.end_place, made.start_t, made.start_place,
                                                                   made.start_order)]
            return pa.RecordBatch.from_arrays(
                [pa.array([key[1]]), pa.array([key[0]]), pa.array([made.size]), pa.array([made.through]), pa.array([last_t]),
                 *lists], names=["series", _CHUNK, "size", "through", "last_t", "end_t", "end_place", "start_t",
                                 "start_place", "start_order"])

        for block in _blocks(batches, block_rows):
            chunk, series = block.column(_CHUNK).to_pylist(), block.column("series").to_pylist()
            t, order = block.column("t").to_numpy(), block.column("o").to_numpy()
            for begin, end in _runs(chunk, series):
                steps = Steps.of(t[begin:end], order[begin:end], window, limit)
                if (chunk[begin], series[begin]) == key:
                    made = made.then(steps, window, limit)
                else:
                    if key:
                        yield out()
                    key, made = (chunk[begin], series[begin]), steps
                last_t = int(t[end - 1])
        if key:
            yield out()

    return rows.select("series", _CHUNK, "o", "t").mapInArrow(run, _STEPS.format(kind=kind))


def _open_samples(functions: DataFrame, kind: str, window: int, limit: int | None) -> DataFrame:
    """The sample that is open where each chunk of a series begins; null for the first one. One is held at a time."""

    def run(batches):
        series, sample = None, None
        for batch in batches:
            out = []
            lists = [batch.column(c) for c in ("end_t", "end_place", "start_t", "start_place", "start_order")]
            rows = zip(*(batch.column(c).to_pylist() for c in ("series", _CHUNK, "size", "through")), strict=True)
            for i, (name, chunk, size, through) in enumerate(rows):
                if name != series:
                    series, sample = name, None
                out.append((series, chunk, *(sample or (None, None, None))))
                steps = Steps(size, 0, through, *(c[i].values.to_numpy() for c in lists))
                step = int(steps.find(*sample[:2], window, limit)) if sample else 0
                if step < len(steps.end_t):
                    sample = (int(steps.start_t[step]), int(steps.start_place[step]), int(steps.start_order[step]))
                sample = (sample[0], sample[1] - steps.size, sample[2])
            names = ["series", _CHUNK, "open_t", "open_place", "open_order"]
            columns = list(zip(*out, strict=True))
            if columns:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0]), *(pa.array(c, pa.int64()) for c in columns[1:])], names=names)

    ordered = functions.repartition("series").sortWithinPartitions("series", _CHUNK)
    return ordered.mapInArrow(run, _OPEN.format(kind=kind))


def _chunk_sums(rows: DataFrame, kind: str, window: int, limit: int | None, block_rows: int) -> DataFrame:
    """Sums of each sample's records in each chunk; rows carry the sample that is open where their chunk begins."""

    def run(batches):
        key, sample = None, None
        for block in _blocks(batches, block_rows):
            chunk, series = block.column(_CHUNK).to_pylist(), block.column("series").to_pylist()
            t, order, n, s, lo, hi = (block.column(c).to_numpy() for c in ("t", "o", "n", "s", "lo", "hi"))
            out: dict[str, list] = {c: [] for c in ("series", "first", "start_ms", "n", "s", "lo", "hi")}
            for begin, end in _runs(chunk, series):
                if (chunk[begin], series[begin]) != key:
                    key = (chunk[begin], series[begin])
                    opened = [block.column(c)[begin].as_py() for c in ("open_t", "open_place", "open_order")]
                    sample = None if opened[0] is None else opened
                # Walk from start to start; places count from the first record of this run.
                own, at, heads = t[begin:end], 0, []
                while at < end - begin:
                    if sample is not None:
                        stop = int(np.searchsorted(own, sample[0] + window, "left"))
                        stop = stop if limit is None else min(stop, sample[1] + limit)
                        if stop > at:
                            heads.append((at, sample[2], sample[0]))
                            at = stop
                            continue
                    sample = [int(own[at]), at, int(order[begin + at])]
                if sample is not None:
                    sample = [sample[0], sample[1] - (end - begin), sample[2]]
                first = np.array([h[0] for h in heads]) + begin
                until = slice(0, end)
                out["series"] += [series[begin]] * len(heads)
                out["first"] += [h[1] for h in heads]
                out["start_ms"] += [h[2] for h in heads]
                for name, add, values in (("n", np.add, n), ("s", np.add, s), ("lo", np.minimum, lo), ("hi", np.maximum, hi)):
                    out[name] += add.reduceat(values[until], first).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["series"]), *(pa.array(out[c], pa.int64()) for c in ("first", "start_ms", "n")),
                 *(pa.array(out[c], pa.float64()) for c in ("s", "lo", "hi"))], names=list(out))

    return rows.select("series", _CHUNK, "o", "t", "n", "s", "lo", "hi", "open_t", "open_place", "open_order").mapInArrow(
        run, _SUMS.format(kind=kind))


def samples(df: DataFrame, series: str, order: str, time_ms: str, value: str, now_ms: int, n_samples: int = SAMPLES,
            window_ms: int = SAMPLE_WINDOW_MS, event_window: int | None = None, chunk_rows: int = CHUNK_ROWS,
            partitions: int | None = None) -> DataFrame:
    """Live samples of each series: (series, start_ms, count, sum, min, max).

    A sample starts with a record and closes ``window_ms`` later or after ``event_window`` records. Live are the newest
    ``n_samples`` of those that started less than ``n_samples`` windows before ``now_ms``. Times do not decrease along
    ``order``, an integer unique in the series; rows without a series, time, order or value are left out.

    The rows are dealt by ranges of series and order, so a hot series is cut into as many chunks as there are
    ``partitions``; a task looks at ``chunk_rows`` rows at a time.
    """
    keep_from = now_ms - n_samples * window_ms
    rows = df.select(F.col(series).alias("series"), F.col(order).cast("long").alias("o"), F.col(time_ms).cast("long").alias("t"),
                     F.col(value).cast("double").alias("v")).dropna()
    kind = rows.schema["series"].dataType.simpleString()
    if event_window is None:
        # Records of one millisecond never part, so they are summed before anything is ordered.
        rows = rows.groupBy("series", "t").agg(
            F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"), F.min("v").alias("lo"), F.max("v").alias("hi"),
            F.min("o").alias("o"))
    else:
        rows = rows.select("series", "t", F.lit(1).cast("long").alias("n"), F.col("v").alias("s"), F.col("v").alias("lo"),
                           F.col("v").alias("hi"), "o")
    chunked = range_chunks(rows, ["series", "o"], _CHUNK, partitions)
    ordered = chunked.sortWithinPartitions(_CHUNK, "series", "o")
    functions = _chunk_steps(ordered, kind, window_ms, event_window, chunk_rows)
    functions = functions.checkpoint()
    opened = _open_samples(functions, kind, window_ms, event_window)
    # Chunks that end before the retention hold no record of a live sample.
    live = functions.where(F.col("last_t") > keep_from).select("series", F.col(_CHUNK).alias("c")).join(
        opened.withColumnsRenamed({"series": "name", _CHUNK: "number"}),
        (F.col("series") == F.col("name")) & (F.col("c") == F.col("number"))).select(
        F.col("name"), F.col("number"), "open_t", "open_place", "open_order")
    wanted = chunked.join(live, (F.col("series") == F.col("name")) & (F.col(_CHUNK) == F.col("number"))).drop("name", "number")
    wanted = wanted.repartition("series", _CHUNK).sortWithinPartitions(_CHUNK, "series", "o")
    sums = _chunk_sums(wanted, kind, window_ms, event_window, chunk_rows)
    found = (sums.where(F.col("start_ms") > keep_from).groupBy("series", "first", "start_ms")
             .agg(F.sum("n").alias("count"), F.sum("s").alias("sum"), F.min("lo").alias("min"), F.max("hi").alias("max")))
    # Samples that close on a count within one millisecond share a start, so the first record tells them apart.
    newest = Window.partitionBy("series").orderBy(F.desc("first"))
    return found.withColumn("__rank", F.row_number().over(newest)).where(F.col("__rank") <= n_samples).select(
        "series", "start_ms", "count", "sum", "min", "max")


by_value(__name__)
