"""Keyed state with an expiry (D11) for D1, D3, D5, D6 and D9: ``transformWithState`` processors.

A key's state is one value state of a few scalars and the time it was last written: a key that stays
silent for longer than its time to live starts anew, whatever the trigger.  With ``evict`` the state
store drops such keys too; Spark then runs batches without data for ever, so that is for
processing-time triggers (``availableNow`` would not end).  Rows are taken from the iterator frame by frame and
results are given back frame by frame, so a key with very many rows in a micro-batch passes through
in bounded memory.  Rows of a frame are taken in ``order``; frames come in order of arrival.
"""

from __future__ import annotations

import datetime as _dt
import time
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

DAY = 86_400
YEARS = 2 * 366 * DAY       # a visitor who stays away for so long counts as new


class PerKey(StatefulProcessor):
    """A step over a key's rows: ``step(state, row) -> (state, output rows)``; the state is a tuple or None."""

    columns: list[str]
    state_schema: str

    evict = False

    def __init__(self, order: Sequence[str], ttl_s: float):
        self.order, self.ttl_ms = list(order), max(1, int(ttl_s * 1000))

    def init(self, handle: StatefulProcessorHandle) -> None:
        schema = f"{self.state_schema}, seen_ms long"
        self.held = handle.getValueState("held", schema, self.ttl_ms) if self.evict else handle.getValueState("held", schema)

    def step(self, key, state, row):
        raise NotImplementedError

    def frame(self, out: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(out, columns=self.columns)

    def handleInputRows(self, key, rows, timerValues):
        now, state = int(time.time() * 1000), None
        if self.held.exists():
            *values, seen = self.held.get()
            state = tuple(values) if now - seen < self.ttl_ms else None
        for pdf in rows:
            out = []
            for row in pdf.sort_values(self.order, kind="stable").itertuples(index=False):
                state, made = self.step(key[0], state, row)
                out.extend(made)
            yield self.frame(out)
        if state is not None:
            self.held.update((*state, now))

    def close(self) -> None:
        pass


def run_per_key(df: DataFrame, key: str, processor: PerKey, schema: str | StructType, evict: bool = False) -> DataFrame:
    processor.evict = evict
    return df.groupBy(key).transformWithStateInPandas(processor, schema, "Append", "ProcessingTime" if evict else "None")


class FirstVisit(PerKey):
    """The first visit date of a mid, fixed by its first row; a later ``is_new`` = 1 of another day becomes 0."""

    state_schema = "first_date string"

    def fixed(self, state, day, is_new):
        first = state[0] if state else (day if is_new == "1" else day - _dt.timedelta(days=1)).isoformat()
        return first, "0" if is_new == "1" and first != day.isoformat() else is_new


class FirstVisitRows(FirstVisit):
    columns = ["event_id", "mid", "visit_date", "is_new_raw", "is_new", "first_date"]

    def step(self, key, state, row):
        day = row.ts.date()
        first, is_new = self.fixed(state, day, row.is_new)
        return (first,), [(row.event_id, key, day.isoformat(), row.is_new, is_new, first)]


class FirstVisitRecords(FirstVisit):
    columns = ["line", "is_new_fixed"]

    def step(self, key, state, row):
        day = _dt.datetime.fromtimestamp(row.ts_ms / 1000, _dt.timezone.utc).date()
        first, is_new = self.fixed(state, day, row.is_new)
        return (first,), [(row.line, is_new)]


class DailyFirst(PerKey):
    """D3: 1 on the key's first row of each calendar day, else 0."""

    state_schema = "last_day string"

    def __init__(self, row_id: str, flag: str, ttl_s: float):
        super().__init__(["ts", row_id], ttl_s)
        self.row_id, self.columns = row_id, [row_id, flag]

    def step(self, key, state, row):
        day = row.ts.date().isoformat()
        return (day,), [(getattr(row, self.row_id), int(state is None or state[0] != day))]


class LoginDay(PerKey):
    """One row per user and day; ``back`` after ``back_days`` or more days away."""

    state_schema = "last_day string"
    columns = ["uid", "d", "ts", "event_id", "uu", "back"]

    def __init__(self, back_days: int, ttl_s: float):
        super().__init__(["ts", "event_id"], ttl_s)
        self.back_days = back_days

    def step(self, key, state, row):
        day, last = row.ts.date(), _dt.date.fromisoformat(state[0]) if state else None
        if day == last:
            return state, []
        back = int(last is not None and (day - last).days >= self.back_days)
        return (day.isoformat(),), [(key, day.isoformat(), row.ts, row.event_id, 1, back)]


class Retraction(PerKey):
    """Every version; a repeat first gives the previous amount negated."""

    def __init__(self, key: str, amount: str, kind: str, order: Sequence[str], ttl_s: float):
        super().__init__(order, ttl_s)
        self.amount, self.columns = amount, [key, "seq", "is_retraction", "amount"]
        self.state_schema = f"prev {kind}, seq long"

    def step(self, key, state, row):
        prev, seq = state or (None, 0)
        value = getattr(row, self.amount)
        out = [] if prev is None else [(key, seq + 1, 1, -prev)]
        return (value, seq + 1), [*out, (key, seq + 1, 0, value)]


class Monotone(PerKey):
    """A row passes only if its time is later than every earlier row's."""

    state_schema = "latest timestamp"

    def __init__(self, arrival: str, key: str, ts: str, ttl_s: float):
        super().__init__([arrival], ttl_s)
        self.ts, self.columns = ts, [arrival, key, ts]

    def step(self, key, state, row):
        at = getattr(row, self.ts)
        if state is not None and at <= pd.Timestamp(state[0]):
            return state, []
        return (at.to_pydatetime(),), [tuple(getattr(row, c) for c in self.columns)]
