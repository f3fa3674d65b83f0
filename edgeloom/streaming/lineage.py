"""Arrival latency of streams: a stateful operator with event-time timers, and a stream-stream join."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import timedelta
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from edgeloom.functions.measures import micros, micros_to_ms, slot_of, to_micros
from edgeloom.operators.lineage import MAX_WAIT_SECONDS


def stream_latency(
    runs: DataFrame,
    events: DataFrame,
    keys: Sequence[str] = ("run_id",),
    started: str = "started_at",
    arrived: str = "arrived_at",
    max_wait: float = MAX_WAIT_SECONDS,
    allowed_delay: str = "1 minute",
    salts: int = 1,
) -> DataFrame:
    """Final latency per run, in the columns of ``arrival_latency``, for append mode.

    A run is emitted once, when the watermark (the slower stream's newest time
    less ``allowed_delay``) has passed its start plus ``max_wait``: from then on
    no earlier arrival can come. Until then it is state, and so are the most
    recent runs when the input ends. Both sides carry a watermark and the time
    condition bounds the join from both ends, so state stays as large as the
    wait and the delay, not as the stream.

    A stream's join is not re-planned while it runs, so the work of a busy run
    is spread by its keys. As in ``arrival_latency`` the join is on the run and a
    time slot as wide as the wait, each run waiting in two slots: the events of
    one run lie in as many parts as they span waits. Should a single wait hold
    too many events of one run, ``salts`` deals them out further by all they hold,
    each run waiting in every part. The grouping by run takes the earliest.

    Runs without a start would wait forever and are left out. Watermarks need
    zoned timestamps; zone-less ones are read in the session zone.
    """
    def timed(stream: DataFrame, column: str) -> DataFrame:
        return stream.withColumn(column, F.col(column).cast("timestamp")).withWatermark(
            column, allowed_delay
        )

    wait_us = to_micros(max_wait)
    slot = slot_of(micros(F.col(started)), wait_us)
    # Maps cannot be hashed. Only events equal in all the rest share a part for sure.
    whole = [c for c, kind in events.dtypes if "map<" not in kind]
    parts = F.sequence(F.lit(0), F.lit(salts - 1))
    left = timed(
        runs.where(F.col(started).isNotNull())
        .select(*keys, started, F.explode(F.array(slot, slot + 1)).alias("slot"))
        .withColumn("part", F.explode(parts)),
        started,
    )
    right = timed(
        events.where(F.col(arrived).isNotNull()).select(
            *[F.col(k).alias(f"event_{k}") for k in keys], arrived,
            slot_of(micros(F.col(arrived)), wait_us).alias("event_slot"),
            F.pmod(F.xxhash64(*whole), F.lit(salts)).cast("int").alias("event_part"),
        ),
        arrived,
    )
    # A literal: the planner derives the state bound from it.
    wait = F.lit(timedelta(microseconds=wait_us))
    condition = (F.col(arrived) >= F.col(started)) & (F.col(arrived) < F.col(started) + wait)
    for key in (*keys, "slot", "part"):
        condition = condition & (F.col(key) == F.col(f"event_{key}"))
    first = (
        left.join(right, condition, "left_outer")
        .groupBy(*keys, started)
        .agg(F.min(arrived).alias(arrived))
    )
    latency = micros(F.col(arrived)) - micros(F.col(started))
    return first.select(
        *keys, started, arrived,
        latency.alias("latency_us"), micros_to_ms(latency).alias("latency_ms"),
    )


#: Earliest arrival of a run that has none yet.
NEVER = np.iinfo(np.int64).max
#: Rows of a bucket that are taken in at once, or as many as its state has.
AT_ONCE = 1 << 17


def stream_latency_timed(
    runs: DataFrame,
    events: DataFrame,
    keys: Sequence[str] = ("run_id",),
    started: str = "started_at",
    arrived: str = "arrived_at",
    max_wait: float = MAX_WAIT_SECONDS,
    allowed_delay: str = "1 minute",
    buckets: int = 64,
) -> DataFrame:
    """What ``stream_latency`` gives, from a state of one start and one arrival per open run.

    Both streams are one, dealt out by a hash of the keys into ``buckets``, each with a timer
    in event time. A bucket's state is a small table: of every open run its start and its
    earliest arrival so far; and the arrivals that no start explains yet, until the
    watermark has passed them, since from then on no start can. Later arrivals of an open
    run are forgotten at once. The timer goes off when the watermark passes the first start
    plus ``max_wait``; a run whose time has come is emitted and forgotten.

    A bucket is worked on as a whole, by columns, once per micro-batch in which it has rows or
    its time has come. Choose ``buckets`` so that the open runs of one fit a task; the number is
    part of the checkpoint. As in ``arrival_latency`` a run that is given several starts
    while it is open counts from the first. Runs without a start are left out, and so are
    events without a time; runs and events with a null key do not meet. Keys may be of any
    type whose text can be cast back. All events of one run go through one bucket: where one run
    may hold a large part of all events, ``stream_latency`` with ``salts`` spreads them.
    """
    wait = to_micros(max_wait)
    kinds = dict(runs.select(*keys).dtypes)
    names = [f"key_{i}" for i in range(len(keys))]

    def timed(stream: DataFrame, column: str, start: bool) -> DataFrame:
        return stream.where(F.col(column).isNotNull()).select(
            *[F.col(k).cast("string").alias(n) for k, n in zip(keys, names)],
            F.col(column).cast("timestamp").alias("time"), F.lit(start).alias("start"),
        ).withWatermark("time", allowed_delay).withColumn("us", micros(F.col("time")))

    known = events.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    both = timed(runs, started, True).union(timed(known, arrived, False)).withColumn(
        "bucket", F.pmod(F.xxhash64(*names), F.lit(buckets))
    )
    columns = ", ".join(f"{n} string" for n in names) + ", started bigint, arrived bigint"
    settled = both.groupBy("bucket").applyInPandasWithState(
        _bucket(names, wait), columns, "open binary", "append", GroupStateTimeout.EventTimeTimeout
    )
    latency = F.col("arrived") - F.col("started")
    return settled.select(
        *[F.col(n).cast(kinds[k]).alias(k) for k, n in zip(keys, names)],
        F.timestamp_micros("started").alias(started), F.timestamp_micros("arrived").alias(arrived),
        latency.alias("latency_us"), micros_to_ms(latency).alias("latency_ms"),
    )


def earliest_arrivals(
    open_runs: pd.DataFrame, loose: pd.DataFrame, keys: list[str], wait: int
) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Open runs (``keys, started, arrived``), one row each, and the arrivals that concern none.

    ``loose`` has ``keys, us``. A run's start is its first; its earliest arrival is the first
    one from then on, if within the wait. Arrivals from a run's start on are used up, earlier
    ones stay loose.
    """
    has_key = open_runs[keys].notna().all(axis=1).to_numpy()
    whole, others = open_runs[has_key], open_runs[~has_key]
    # One number per different key; from here on only whole numbers are compared.
    both = pd.concat([whole[keys], loose[keys]], ignore_index=True)
    if len(keys) == 1:
        code, found = pd.factorize(both[keys[0]])
        many = len(found)
    else:
        code = both.groupby(keys, sort=False, dropna=False).ngroup().to_numpy()
        many = int(code.max(initial=-1)) + 1
    of_run, of_event = code[:len(whole)], code[len(whole):]
    started, arrived = (np.full(many, NEVER) for _ in range(2))
    np.minimum.at(started, of_run, whole["started"].to_numpy(np.int64))
    # An arrival known under a later start is an arrival like any other.
    known = whole["arrived"].to_numpy(np.int64) != NEVER
    met = pd.concat([loose, whole.loc[known, [*keys, "arrived"]].rename(columns={"arrived": "us"})])
    us, of_event = met["us"].to_numpy(np.int64), np.append(of_event, of_run[known])
    start = started[of_event]
    used = us >= start
    inside = np.flatnonzero(used)
    inside = inside[us[inside] - start[inside] < wait]
    np.minimum.at(arrived, of_event[inside], us[inside])
    run, place = np.unique(of_run, return_index=True)
    first = whole[keys].iloc[place].assign(started=started[run], arrived=arrived[run])
    return pd.concat([first, others]), met.loc[~used, [*keys, "us"]]


def _bucket(keys: list[str], wait: int):
    def update(_, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark = state.getCurrentWatermarkMs() * 1000
        open_runs = pd.DataFrame({**{k: pd.Series(dtype=object) for k in keys},
                                  "started": pd.Series(dtype="int64"), "arrived": pd.Series(dtype="int64")})
        loose = open_runs[keys].assign(us=pd.Series(dtype="int64"))
        if state.exists:
            held = pa.ipc.open_stream(state.get[0]).read_all().to_pandas()
            is_run = held["started"] != NEVER
            open_runs = held[is_run]
            loose = held.loc[~is_run, [*keys, "arrived"]].rename(columns={"arrived": "us"})
        waiting, n = [], 0
        for part in chain(rows, [None]):
            if part is not None:
                waiting.append(part)
                n += len(part)
                # Parts are taken in once they are as many rows as the state has, so each row is
                # looked at a bounded number of times, and a busy run's events are not gathered.
                if n < max(AT_ONCE, len(open_runs) + len(loose)):
                    continue
            if waiting:
                new = pd.concat(waiting)
                is_start = new["start"].to_numpy(bool)
                starts = new.loc[is_start, [*keys, "us"]].rename(columns={"us": "started"})
                open_runs, loose = earliest_arrivals(
                    pd.concat([open_runs, starts.assign(arrived=NEVER)], ignore_index=True),
                    pd.concat([loose, new.loc[~is_start, [*keys, "us"]]], ignore_index=True), keys, wait,
                )
                waiting, n = [], 0
        over = open_runs["started"] + wait <= watermark
        final, open_runs = open_runs[over], open_runs[~over]
        loose = loose[loose["us"] >= watermark]
        kept = pd.concat([open_runs, loose.rename(columns={"us": "arrived"}).assign(started=NEVER)])
        if len(kept):
            table = pa.Table.from_pandas(kept[[*keys, "started", "arrived"]], schema=pa.schema(
                [(k, pa.string()) for k in keys] + [("started", pa.int64()), ("arrived", pa.int64())]
            ), preserve_index=False)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as out:
                out.write_table(table)
            state.update((sink.getvalue().to_pybytes(),))
            due = open_runs["started"].min() + wait if len(open_runs) else loose["us"].max() + 1000
            state.setTimeoutTimestamp(max(int(-(-due // 1000)), watermark // 1000 + 1))
        elif state.exists:
            state.remove()
        if len(final):
            yield final.assign(arrived=final["arrived"].where(final["arrived"] != NEVER).astype("Int64"))
    return update
