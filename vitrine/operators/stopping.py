"""Early stopping with a least improvement (WIN02, ``min_delta`` > 0).

A score improves when it beats the best one by more than ``min_delta``; the best
then moves to it.  That is no running maximum: which scores improve depends on
the best one before them.  Epochs are dealt by range over (run, epoch) and each
range is scanned for itself, for every state it can be entered with:

* entered with best ``b``, its first improvement is the first score above
  ``b + min_delta``, which must be a strict prefix maximum of the range;
* from there on the way is fixed: to the next score above that one by more than
  ``min_delta``, and so on, found from the back with a stack.

So a range returns one row per prefix maximum, and a pass over those rows, range
after range, carries (best, its epoch) through a run.  No task holds more than
one range's rows, whatever share of all rows a run has.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MAP = "part long, first_epoch long, last_epoch long, record double, record_epoch long, best double, best_epoch long, stop_epoch long"


def range_map(epochs: list[int], scores: list[float], patience: int, min_delta: float) -> list[tuple]:
    """(record, its epoch, best, its epoch, stop epoch) for each strict prefix
    maximum: where a scan that first improves there leaves the range, and where
    it stops on the way (``best`` is then the one at the stop)."""
    n = len(scores)
    out: list[tuple[float, int, int | None]] = [(0.0, 0, None)] * n
    stack: list[int] = []  # from the back: later scores that beat all between
    keys: list[float] = []  # their scores, descending towards the front
    for i in range(n - 1, -1, -1):
        # first later score above this one by more than min_delta
        at = bisect.bisect_left(keys, -(scores[i] + min_delta))
        nxt = stack[at - 1] if at else None
        if nxt is None:
            out[i] = (scores[i], epochs[i], None)
        elif epochs[nxt] - epochs[i] > patience:
            out[i] = (scores[i], epochs[i], epochs[i] + patience)
        else:
            out[i] = out[nxt]
        while keys and -keys[-1] <= scores[i]:
            keys.pop()
            stack.pop()
        keys.append(-scores[i])
        stack.append(i)
    records, top = [], None
    for i in range(n):
        if top is None or scores[i] > top:
            top = scores[i]
            records.append((scores[i], epochs[i], *out[i]))
    return records


def _map_batches(patience: int, min_delta: float, name_type: pa.DataType):
    """Rows (run, epoch, score), sorted -> each run's map in this range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        now, started, epochs, scores = None, False, [], []

        def flush() -> pa.RecordBatch:
            rows = [(now, part, epochs[0], epochs[-1], *r) for r in range_map(epochs, scores, patience, min_delta)]
            kinds = [name_type, pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names=[f"c{k}" for k in range(len(kinds))])

        for batch in batches:
            for name, epoch, score in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if started and name != now:
                    yield flush()
                    epochs, scores = [], []
                now, started = name, True
                epochs.append(epoch)
                scores.append(score)
        if started:
            yield flush()
    return run


def _join_batches(patience: int, min_delta: float, name_type: pa.DataType):
    """Maps of a run in order -> (run, stop, best epoch, best, last epoch)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        now, started = None, False
        best = best_epoch = stop = last = None
        part, taken = None, False

        def close() -> None:
            end = stop if stop is not None else best_epoch + patience if best_epoch + patience <= last else None
            done.append((now, end, best_epoch, best, last))

        for batch in batches:
            for name, p, _, last_epoch, record, record_epoch, exit_best, exit_epoch, exit_stop in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not started or name != now:
                    if started:
                        close()
                    now, started, best, best_epoch, stop, part = name, True, None, None, None, None
                if p != part:
                    part, taken = p, False
                last = last_epoch
                if stop is None and not taken and (best is None or record > best + min_delta):
                    taken = True  # later records of this range are on its way
                    if best is not None and record_epoch - best_epoch > patience:
                        stop = best_epoch + patience
                    else:
                        best, best_epoch, stop = exit_best, exit_epoch, exit_stop
        if started:
            close()
        kinds = [name_type, pa.int64(), pa.int64(), pa.float64(), pa.int64()]
        columns = list(zip(*done)) or [[]] * len(kinds)
        yield pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=[f"c{k}" for k in range(len(kinds))])
    return run


def early_stop_min_delta(log: DataFrame, patience: int = 3, min_delta: float = 0.0, name: str = "name", score: str = "val_f1", epoch: str = "epoch", mode: str = "max") -> DataFrame:
    """WIN02: per run the epoch at which training stops (NULL when it never
    does), the best epoch and score by then, and the number of epochs.

    Epochs are consecutive integers from 1 within a run; scores are not NULL.
    An empty log gives an empty result."""
    from pyspark.sql.pandas.types import to_arrow_type
    sign = {"max": 1.0, "min": -1.0}[mode]
    rows = log.select(F.col(name).alias("name"), F.col(epoch).cast("long").alias("epoch"), (F.col(score).cast("double") * sign).alias("score"))
    kind = rows.schema["name"].dataType
    spark = log.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    dealt = rows.repartitionByRange(n, "name", "epoch").sortWithinPartitions("name", "epoch")
    maps = dealt.mapInArrow(_map_batches(patience, min_delta, to_arrow_type(kind)), f"name {kind.simpleString()}, {_MAP}")
    joined = maps.repartition(n, "name").sortWithinPartitions("name", "part", "record")
    out = joined.mapInArrow(_join_batches(patience, min_delta, to_arrow_type(kind)),
                            f"name {kind.simpleString()}, stop_epoch long, best_epoch long, best_score double, n_epochs long")
    return out.select(F.col("name").alias(name), "stop_epoch", "best_epoch", (F.col("best_score") * sign).alias("best_score"), "n_epochs")
