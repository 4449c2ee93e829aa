"""Per-key state for streams.

Stream forms of the batch operators in ``strata.operators``.  Built-in stateful
operators are used where they exist (windowed aggregation, ``dropDuplicates*``,
stream-stream joins).  D1, D3, D5, D6 and D9 are the processors of ``keyed_state.py``, whose
state expires; the rest are ``applyInPandasWithState`` processors whose
state per key is a handful of scalars (a date, a running count, a value set
bounded by the column's domain).  Rows of one key inside one micro-batch are
processed in event order (ts, then id); across micro-batches arrival order
holds, as in the reference.
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Iterator, Sequence
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from strata.streaming import keyed_state as ks


def _rows(pdfs: Iterator[pd.DataFrame], order: Sequence[str]) -> pd.DataFrame:
    df = pd.concat(list(pdfs), ignore_index=True)
    return df.sort_values(list(order), kind="stable")


# ---- D1: new-visitor repair -------------------------------------------------------------------

def new_visitor_stream(logs: DataFrame, ttl_s: float = ks.YEARS) -> DataFrame:
    """D1 on a stream of (event_id, mid, ts, is_new): state = first visit date per mid; a mid silent for
    ``ttl_s`` starts anew (D11; the reference's 10 s would forget nearly every visitor)."""
    return ks.run_per_key(logs.select("event_id", "mid", "ts", "is_new"), "mid", ks.FirstVisitRows(["ts", "event_id"], ttl_s),
                          "event_id long, mid string, visit_date string, is_new_raw string, is_new string, first_date string")


# ---- D3: daily unique visitor flag --------------------------------------------------------------

def daily_first_flag_stream(df: DataFrame, key: str, row_id: str, flag: str = "uv", ttl_s: float = ks.DAY) -> DataFrame:
    """D3: emit every row with ``flag`` = 1 on the key's first row of each calendar day.  State
    (the last day seen) of a key silent for ``ttl_s`` (the reference: 86400) expires (D11)."""
    return ks.run_per_key(df.select(key, "ts", row_id), key, ks.DailyFirst(row_id, flag, ttl_s), f"{row_id} long, {flag} int")


# ---- D5: login uniqueness and return users -------------------------------------------------------

def login_stream(logins: DataFrame, back_days: int = 8, ttl_s: float = ks.YEARS) -> DataFrame:
    """D5 on (uid, ts, event_id): one row per user and day with uu=1 and back=1 when the
    previous login day is ``back_days`` or more days earlier; state = last login day."""
    return ks.run_per_key(logins.select("uid", "ts", "event_id"), "uid", ks.LoginDay(back_days, ttl_s),
                          "uid string, d string, ts timestamp, event_id long, uu int, back int")


# ---- D6: retraction by negation ----------------------------------------------------------------

def retraction_stream(changes: DataFrame, key: str, amount: str, order: Sequence[str], ttl_s: float = ks.DAY) -> DataFrame:
    """Per key, a repeat first emits the previous amount negated, then the new row.

    ``ttl_s`` bounds how long a repeat may come after the version before (D11): a later one is not
    netted.  The reference allows 10 s; the default is a day."""
    kind = dict(changes.dtypes)[amount]  # money stays decimal
    return ks.run_per_key(changes.select(key, amount, *order), key, ks.Retraction(key, amount, kind, order, ttl_s),
                          f"{key} string, seq long, is_retraction int, amount {kind}")


# ---- D9: monotone filter -------------------------------------------------------------------------

def monotone_stream(df: DataFrame, key: str, ts: str, arrival: str, ttl_s: float = 3600) -> DataFrame:
    """Pass a row only if its ``ts`` is later than every earlier row of the key.  A key silent
    for ``ttl_s`` (the reference: 3600) starts anew (D11)."""
    rows = df.select(arrival, key, ts)
    return ks.run_per_key(rows, key, ks.Monotone(arrival, key, ts, ttl_s), rows.schema)


# ---- A8: running profile -------------------------------------------------------------------------

def running_profile_stream(df: DataFrame, key: str, set_cols: Sequence[str], row_id: str = "event_id") -> DataFrame:
    """With each row, the key's running count and sorted comma-joined value sets (never reset)."""
    cols = list(set_cols)

    def fn(k, pdfs, state: GroupState):
        if state.exists:
            pv, blob = state.get
            sets = {c: set(v) for c, v in json.loads(blob).items()}
        else:
            pv, sets = 0, {c: set() for c in cols}
        out = []
        for r in _rows(pdfs, ["ts", row_id]).to_dict("records"):
            pv += 1
            for c in cols:
                if r[c] is not None and not (isinstance(r[c], float) and pd.isna(r[c])):
                    sets[c].add(r[c])
            out.append([r[row_id], k[0], pv] + [",".join(sorted(sets[c])) for c in cols])
        state.update((pv, json.dumps({c: sorted(v) for c, v in sets.items()})))
        yield pd.DataFrame(out, columns=[row_id, key, "pv"] + [f"{c}_set" for c in cols])

    schema = ", ".join([f"{row_id} long", f"{key} string", "pv long"] + [f"{c}_set string" for c in cols])
    return df.select(row_id, key, "ts", *cols).groupBy(key).applyInPandasWithState(
        fn, schema, "pv long, sets string", "append", GroupStateTimeout.NoTimeout)


# ---- built-in stateful forms ---------------------------------------------------------------------

def first_per_day_stream(df: DataFrame, key: str, ts: str = "ts", delay: str = "1 day") -> DataFrame:
    """First row per key and day, state kept until the watermark passes the day."""
    return (df.withWatermark(ts, delay).withColumn("__d", F.to_date(ts))
            .dropDuplicatesWithinWatermark([key, "__d"]).drop("__d"))


def key_ts_dedupe_stream(df: DataFrame, keys: Sequence[str], ts: str, delay: str = "10 minutes") -> DataFrame:
    """Exact de-duplication on (keys, ts) with state expiring behind the watermark."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark([*keys, ts])


def interval_join_stream(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
                         lower_s: int, upper_s: int, delay: str = "0 seconds") -> DataFrame:
    """J9 stream form: both sides watermarked, two-sided time condition so state is dropped.

    The result carries both times; a following interval join must keep only one
    event-time column (Spark allows one per stream)."""
    lw = left.withWatermark(left_ts, delay).alias("l")
    rw = right.withWatermark(right_ts, delay).alias("r")
    cond = (F.col(f"l.{key}") == F.col(f"r.{key}")) & \
        (F.col(f"r.{right_ts}") >= F.col(f"l.{left_ts}") + F.expr(f"INTERVAL {lower_s} SECONDS")) & \
        (F.col(f"r.{right_ts}") <= F.col(f"l.{left_ts}") + F.expr(f"INTERVAL {upper_s} SECONDS"))
    return lw.join(rw, cond, "inner").drop(F.col(f"r.{key}"))


# ---- D7: latest within a burst (event-time timer) -------------------------------------------------

def latest_in_burst_stream(df: DataFrame, key: str, ts: str, order: Sequence[str], burst_s: int,
                           delay: str = "0 seconds") -> DataFrame:
    """The first row of a key opens a burst of ``burst_s`` seconds; newer rows inside it
    replace the kept row; when the burst ends (event-time timer, watermark driven) the
    kept row is emitted and the state cleared.  Output: the input columns."""
    from pyspark.sql import types as T
    cols = df.columns
    schema = df.schema
    ts_cols = [f.name for f in schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    decimals = [f.name for f in schema.fields if isinstance(f.dataType, T.DecimalType)]
    burst = _dt.timedelta(seconds=burst_s)

    def frame(out):
        f = pd.DataFrame(out, columns=cols)
        for c in decimals:  # the state holds them as text
            f[c] = [None if v is None else Decimal(v) for v in f[c]]
        for c in ts_cols:
            f[c] = pd.to_datetime(f[c])
        return f

    def fn(k, pdfs, state: GroupState):
        out = []
        if state.hasTimedOut:
            out.append(json.loads(state.get[0]))
            state.remove()
            yield frame(out)
            return
        kept = json.loads(state.get[0]) if state.exists else None
        end = pd.Timestamp(state.get[1]) if state.exists else None
        for r in _rows(pdfs, order).to_dict("records"):
            if end is not None and r[ts] > end:
                out.append(kept)
                kept, end = None, None
            if kept is None:
                end = r[ts] + burst
            kept = {c: (v.isoformat() if isinstance(v, pd.Timestamp) else v) for c, v in r.items()}
        if kept is not None:
            state.update((json.dumps(kept, default=str), end.to_pydatetime()))
            state.setTimeoutTimestamp(int(end.timestamp() * 1000) + 1)
        yield frame(out)

    return df.withWatermark(ts, delay).groupBy(key).applyInPandasWithState(
        fn, schema, "row string, burst_end timestamp", "append", GroupStateTimeout.EventTimeTimeout)


# ---- W3: processing-time windows ------------------------------------------------------------------

def per_trigger_window(aggregate, sink):
    """W3 stream form: with a processing-time trigger equal to the window size, each
    micro-batch is one processing-time window; ``aggregate(batch)`` summarises it and the
    result is stamped with the batch's processing time before ``sink(result, epoch)``."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        res = aggregate(batch).withColumn("proc_time", F.current_timestamp())
        sink(res, epoch_id)
    return run


# ---- D5 as a transformWithState processor (chains into event-time windows) ---------------------

class LoginDays(StatefulProcessor):
    """D5 per user: one row per login day (uu=1) with back=1 after a gap of ``back_days``.
    State: the last login day."""

    def __init__(self, back_days: int = 8):
        self.back_days = back_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last_day", "d string")

    def handleInputRows(self, key, rows, timerValues):
        last = _dt.date.fromisoformat(self.last.get()[0]) if self.last.exists() else None
        out = []
        for r in _rows(rows, ["ts", "event_id"]).itertuples(index=False):
            d = r.ts.date()
            if last == d:
                continue
            back = 1 if (last is not None and (d - last).days >= self.back_days) else 0
            out.append((key[0], r.ts, r.event_id, 1, back))
            last = d
        if last is not None:
            self.last.update((last.isoformat(),))
        yield pd.DataFrame(out, columns=["uid", "ts", "event_id", "uu", "back"])

    def close(self) -> None:
        pass


class NetAmount(StatefulProcessor):
    """D6 per order line, grouped by order, as a transformWithState processor: every version is
    emitted, and a repeat first emits the line's previous version negated, so sums over any
    grouping of the output equal sums over the latest versions.  The order's first row
    carries ``orders`` = 1, every other 0, so a sum counts distinct orders without a set.
    State: the previous version of each line of the order.  Rows carry their event time
    (``create_time``) through, so event-time windows can follow."""

    def __init__(self, order: Sequence[str], carry: Sequence[str], line: str):
        self.order, self.carry, self.line = list(order), list(carry), line

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.prev = handle.getMapState("prev", "line long", "amount string, carry string")
        self.counted = handle.getValueState("counted", "counted boolean")

    def handleInputRows(self, key, rows, timerValues):
        new_order, touched, out = not self.counted.exists(), {}, []
        for r in _rows(rows, [*self.order, self.line]).to_dict("records"):
            line = int(r[self.line])
            if line not in touched and self.prev.containsKey((line,)):
                amount, carry = self.prev.getValue((line,))
                touched[line] = (Decimal(amount), json.loads(carry))
            if line in touched:
                amount, carry = touched[line]
                out.append({**carry, "amount": -amount, "is_retraction": 1, "orders": 0})
            carry = {c: r[c] for c in self.carry}
            out.append({**carry, "amount": r["amount"], "is_retraction": 0, "orders": int(new_order)})
            new_order = False
            touched[line] = (r["amount"], carry)
        for line, (amount, carry) in touched.items():
            self.prev.updateValue((line,), (str(amount), json.dumps(carry, default=str)))
        if touched:
            self.counted.update((True,))
        frame = pd.DataFrame(out, columns=[*self.carry, "amount", "is_retraction", "orders"])
        if "create_time" in frame:
            frame["create_time"] = pd.to_datetime(frame["create_time"])
        yield frame

    def close(self) -> None:
        pass


# ---- D1 carrying whole log records (for the log split job) --------------------------------------

def new_visitor_records_stream(records: DataFrame, ttl_s: float = ks.YEARS) -> DataFrame:
    """D1 over parsed log records (mid, ts_ms, is_new, line): every record passes through
    with ``is_new`` repaired; state per mid = first visit date."""
    return ks.run_per_key(records.select("mid", "ts_ms", "is_new", "line"), "mid", ks.FirstVisitRecords(["ts_ms", "line"], ttl_s),
                          "line string, is_new_fixed string")
