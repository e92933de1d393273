"""Overflow gaps as a stateful stream: the high-water mark of every profile is kept in the state store."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming import StreamingQuery

from playmart.streaming.gaps import PROFILE

GAPS = "profile_slug string, gap_start timestamp, gap_end timestamp, items_returned bigint, detected_at timestamp"
# Fixed value: the store that stateful processors need.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class MarkKeeper(StatefulProcessor):
    """A profile's newest play so far, and the captures that start after it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.mark = handle.getValueState("high_water_mark", "newest timestamp")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        """A batch's captures of one profile, in the order of their capture; a capture is a few dozen bytes."""
        pages = pd.concat(rows).dropna(subset=["oldest", "newest"])
        if pages.empty:
            return
        pages = pages.sort_values(["captured_at", "oldest", "newest"])
        before = pages["newest"].cummax().shift(1)
        if self.mark.exists():
            held = pd.Timestamp(self.mark.get()[0])
            before = before.fillna(held).clip(lower=held)
        found = pages.assign(gap_start=before)[pages["oldest"] > before]
        top = pages["newest"].max()
        self.mark.update((top if not self.mark.exists() else max(top, held),))
        yield pd.DataFrame({
            "profile_slug": key[0], "gap_start": found["gap_start"], "gap_end": found["oldest"],
            "items_returned": found["items_returned"], "detected_at": found["captured_at"],
        })

    def close(self) -> None:
        pass


def gap_stream(captures: DataFrame) -> DataFrame:
    """Gaps of a stream of captures (see `gaps.detect_gaps`), as captures arrive.

    State is one timestamp a profile, kept and recovered by the state store of the query's checkpoint; a
    profile seen for the first time in a late batch starts without a mark and so without a gap. A capture
    that arrives after a newer one of its profile cannot open a gap below the mark. Pages without plays
    prove nothing. The session must name `STORE` as its state store.
    """
    named = captures.filter("profile_slug is not null")
    return named.groupBy(PROFILE).transformWithStateInPandas(
        statefulProcessor=MarkKeeper(), outputStructType=GAPS, outputMode="append", timeMode="none")


def start_stateful_gaps(captures: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the gaps of a capture stream to `path`; the file sink's log makes a repeated batch count once."""
    spark = captures.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    return (
        gap_stream(captures).writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    )
