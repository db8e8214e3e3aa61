"""Taxonomy counters of every node as keyed state, across chunks."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from anemora.config import TaxonomyBands
from anemora.functions.scalars import continuity_band, coverage_band, micros

#: The state store that keyed state with timers and lists needs.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_COUNTS = "total bigint, steady bigint, short bigint, long bigint, most bigint, last bigint, late bigint"
OUTPUT = "node_id string, total_observations bigint, on_cadence_transitions bigint, short_gaps bigint, long_gaps bigint, max_gap_seconds bigint, late_rows bigint"


class GapCounters(StatefulProcessor):
    """Counts a node's gaps in event-time order.

    Times above the watermark wait in the state, sorted with what later chunks bring; those below it are
    counted for good and leave one row of sums.  A row later than the last counted time is
    counted as late and nowhere else.
    """

    def __init__(self, keep_ms: int | None = None):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getValueState("counts", _COUNTS, self.keep_ms)
        self.waiting = handle.getListState("waiting", "us bigint", self.keep_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.counts.get() or (0, 0, 0, 0, 0, None, 0)
        last = held[5]
        fresh = [int(us) for frame in rows for us in frame["us"]]
        late = 0 if last is None else sum(us < last for us in fresh)
        waiting = sorted([us for (us,) in self.waiting.get()] + [us for us in fresh if last is None or us >= last])
        mark = timerValues.getCurrentWatermarkInMs() * 1_000
        ready = [us for us in waiting if us < mark]
        rest = waiting[len(ready):]
        held = _count((*held[:6], held[6] + late), ready)
        self.counts.update(held)
        if rest:
            self.waiting.put([(us,) for us in rest])
        else:
            self.waiting.clear()
        whole = _count(held, rest)
        yield pd.DataFrame([[key[0], *whole[:5], whole[6]]], columns=[c.split()[0] for c in OUTPUT.split(", ")])

    def close(self) -> None:
        pass


def _count(held: tuple, times: list[int]) -> tuple:
    """Add times, in order, to the sums."""
    total, steady, short, long, most, last, late = held
    for us in times:
        seconds = None if last is None else round((us - last) / 1e6)
        steady += seconds is None or seconds == 1800
        short += seconds is not None and 1800 < seconds <= 7200
        long += seconds is not None and seconds > 7200
        most = max(most, seconds or 0)
        total, last = total + 1, us
    return total, steady, short, long, most, last, late


def taxonomy_stream(stream: DataFrame, lateness: str = "1 day", keep_ms: int | None = None, ts: str = "timestamp") -> DataFrame:
    """Counters of each node that a chunk touches, as they stand with that chunk; write it in update mode.

    The last row of a node equals the row of ``cadence.taxonomy`` over all rows that were not late.  ``keep_ms`` drops the state of nodes that send
    nothing for so long.  State lives in the RocksDB provider (set ``spark.sql.streaming.stateStore.providerClass`` to ``STATE_STORE``), and a batch that failed is run again from the state before it.
    """
    timed = stream.where(F.col(ts).isNotNull()).select("node_id", F.col(ts).cast("timestamp").alias("at"), micros(F.col(ts)).alias("us")).withWatermark("at", lateness)
    return timed.groupBy("node_id").transformWithStateInPandas(GapCounters(keep_ms), OUTPUT, "Update", "EventTime" if keep_ms is None else "ProcessingTime")


def with_bands(counters: DataFrame, bands: TaxonomyBands = TaxonomyBands()) -> DataFrame:
    """The columns of ``cadence.taxonomy`` from counters."""
    days = F.col("max_gap_seconds") / F.lit(86_400.0)
    low = (F.col("total_observations") < bands.low_coverage_observations) & (days > bands.low_coverage_gap_days)
    return counters.select(
        "node_id", "total_observations", "on_cadence_transitions", "short_gaps", "long_gaps", F.col("total_observations").alias("total_intervals"),
        days.alias("max_gap_days"), low.alias("low_coverage"), coverage_band(F.col("total_observations"), bands).alias("coverage_band"),
        continuity_band(days, bands).alias("continuity_band"))
