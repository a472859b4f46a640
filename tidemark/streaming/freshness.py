"""Keyed state whose values run out."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_COLUMNS = ["kind", "city", "ts", "value", "fresh"]


class Freshness(StatefulProcessor):
    """The latest value of a key until the watermark passes its time plus ``offsets[kind]`` seconds.

    Of values at one time the greatest counts.
    """

    def __init__(self, offsets: Mapping[str, int]):
        self._offsets = dict(offsets)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._latest = handle.getValueState("latest", "ts timestamp, value double")

    def _expiry(self, kind: str, ts: pd.Timestamp) -> int:
        """The first millisecond at which a value of that time is no longer fresh."""
        return int(ts.value // 1_000_000) + 1000 * self._offsets[kind] + 1

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        kind, city = key
        held = self._latest.get() if self._latest.exists() else None
        best = (pd.Timestamp(held[0]), float(held[1])) if held else None
        before = best
        for frame in rows:
            for ts, value in zip(frame["ts"], frame["value"]):
                if pd.isna(ts) or pd.isna(value):
                    continue
                if best is None or (ts, value) > best:
                    best = (pd.Timestamp(ts), float(value))
        if best is None or best == before:
            return
        if before is not None:
            self._handle.deleteTimer(self._expiry(kind, before[0]))
        self._latest.update((best[0].to_pydatetime(), best[1]))
        self._handle.registerTimer(self._expiry(kind, best[0]))
        yield pd.DataFrame([(kind, city, *best, True)], columns=_COLUMNS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self._latest.exists():
            return
        ts, value = self._latest.get()
        self._latest.clear()
        yield pd.DataFrame([(*key, pd.Timestamp(ts), float(value), False)], columns=_COLUMNS)

    def close(self) -> None:
        pass
