"""Structured Streaming versions of the ledger, budget and audit operators.

* G1 ``stream_consent_status`` — ``transformWithStateInPandas`` keyed by
  (subject, use case): the latest action as a value state, older ones ignored,
  event-time timers for expiring grants.
* G2 ``stream_budget_gate`` — ``transformWithStateInPandas`` keyed by hash
  buckets of budgets: operations wait as sorted blocks until the watermark
  closes their time slice, then pass the same kernel as the batch gate, in order.
* G3 ``stream_audit_counts`` — event-time tumbling windows with a
  watermark, append mode: a window is emitted once the watermark passes its
  end, later rows for it are dropped.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..operators.fold import greedy_admit_groups
from ..operators.ledger import GRANT


_EPOCH = pd.Timestamp("1970-01-01")


def _micros(ts: pd.Series) -> np.ndarray:
    """Microseconds since 1970 of a timestamp column (UTC)."""
    plain = ts.dt.tz_convert("UTC").dt.tz_localize(None) if ts.dt.tz is not None else ts
    return plain.to_numpy().astype("datetime64[us]").astype(np.int64)


class ConsentProcessor(StatefulProcessor):
    """Latest action of one (subject, use case); see :func:`stream_consent_status`."""

    def __init__(self, time_col: str, seq_col: str):
        self.time_col, self.seq_col = time_col, seq_col

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "ts long, seq long, action string, until long, n long, expired boolean")

    def _row(self, key, action, consented, n):
        return pd.DataFrame({"patient_pseudonym": [key[0]], "use_case_id": [key[1]], "last_action": [action],
                             "consented": [bool(consented)], "n_actions": [int(n)]})

    def handleInputRows(self, key, rows, timerValues):
        known = self.last.get()
        best = None if known is None else (known[0], known[1], known[2], known[3])
        n = 0 if known is None else known[4]
        before = best
        for pdf in rows:  # a chunk at a time: only its latest row matters
            n += len(pdf)
            ts, seq = _micros(pdf[self.time_col]), pdf[self.seq_col].to_numpy(dtype=np.int64)
            k = int(np.lexsort((seq, ts))[-1])
            if best is None or (ts[k], seq[k]) > best[:2]:
                day = pdf["expiry_date"].iat[k]
                # a grant holds through its expiry date
                until = -1 if pd.isna(day) else int((pd.Timestamp(day) - _EPOCH).days + 1) * 86_400_000
                best = (int(ts[k]), int(seq[k]), str(pdf["action"].iat[k]), until)
        now = timerValues.getCurrentWatermarkInMs()
        expired = known is not None and bool(known[5])
        if best != before:
            if before is not None and before[3] > now and before[2] == GRANT:
                self.handle.deleteTimer(before[3])
            expired = best[2] == GRANT and 0 <= best[3] <= now
            if best[2] == GRANT and best[3] > now:
                self.handle.registerTimer(best[3])
        self.last.update((*best, int(n), expired))
        yield self._row(key, best[2], best[2] == GRANT and not expired, n)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        ts, seq, action, until, n, _ = self.last.get()
        if action == GRANT and until == expiredTimerInfo.getExpiryTimeInMs():
            self.last.update((ts, seq, action, until, n, True))
            yield self._row(key, action, False, n)

    def close(self) -> None:
        pass


def stream_consent_status(requests: DataFrame, order=("timestamp", "request_seq"), delay: str = "1 hour") -> DataFrame:
    """G1: latest action per (pseudonym, use case), update mode.

    One value state per key holds the latest action, its place in ``order``
    (event time, then a sequence number) and the number of actions seen.  An
    action that arrives after a later one is counted but changes nothing, so
    any arrival order gives the batch status (E1).  A grant with an
    ``expiry_date`` sets an event-time timer; once the watermark (``delay``
    behind the latest event) passes the end of that day, the key is emitted
    again, no longer consented.  Rows behind the watermark are late and, as in
    every event-time operator, dropped.
    """
    time_col, seq_col = order
    out = "patient_pseudonym string, use_case_id string, last_action string, consented boolean, n_actions long"
    if "expiry_date" not in requests.columns:
        requests = requests.withColumn("expiry_date", F.lit(None).cast("date"))
    rows = (requests.withWatermark(time_col, delay)
            .select("patient_pseudonym", "use_case_id", time_col, seq_col, "action", "expiry_date"))
    return rows.groupBy("patient_pseudonym", "use_case_id").transformWithStateInPandas(
        ConsentProcessor(time_col, seq_col), out, "Update", "EventTime")


#: Rows of one sorted block of the gate's buffer.
BLOCK_ROWS = 2000
#: Keys of the gate's state; budgets are dealt over them by hash.
GATE_BUCKETS = 256


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(bytes(data))).read_all()


class GateProcessor(StatefulProcessor):
    """Ordered budget gate of the budgets of one bucket; see :func:`stream_budget_gate`."""

    def __init__(self, total: int, slice_ms: int, block_rows: int):
        self.total, self.slice_ms, self.block_rows = total, slice_ms, block_rows

    def init(self, handle) -> None:
        self.handle = handle
        self.used = handle.getValueState("used", "budgets binary")
        self.slices = handle.getMapState("slices", "start long", "blocks int")
        self.blocks = handle.getMapState("blocks", "start long, block int", "rows binary")

    def handleInputRows(self, key, rows, timerValues):
        have = {k[0]: v[0] for k, v in self.slices.iterator()}
        first, fresh = min(have, default=None), {}
        for pdf in rows:
            ts = _micros(pdf["ts"])
            seq, cost = (pdf[c].to_numpy(dtype=np.int64) for c in ("seq", "cost"))
            order = np.lexsort((cost, seq, ts))
            table = pa.table({"budget": pa.array(pdf["budget"], pa.string(), from_pandas=True), "ts": ts, "seq": seq,
                              "cost": cost}).take(pa.array(order))
            at = ts[order] // (self.slice_ms * 1000)
            cuts = (np.flatnonzero(np.diff(at)) + 1).tolist()
            for a, b in zip([0, *cuts], [*cuts, len(at)]):
                start = int(at[a])
                for k in range(a, b, self.block_rows):
                    n = fresh.get(start, have.get(start, 0))
                    self.blocks.updateValue((start, n), (_packed(table.slice(k, min(b - k, self.block_rows))),))
                    fresh[start] = n + 1
        for start, n in fresh.items():
            self.slices.updateValue((start,), (n,))
        if fresh and (first is None or min(fresh) < first):  # one timer waits, for the first open slice
            self.handle.registerTimer((min(fresh) + 1) * self.slice_ms)
        return iter(())

    def _slice(self, start: int, n: int) -> pa.Table:
        """Rows of a slice; they leave the state as they are read."""
        tables = []
        for block in range(n):
            tables.append(_unpacked(self.blocks.getValue((start, block))[0]))
            self.blocks.removeKey((start, block))
        self.slices.removeKey((start,))
        return pa.concat_tables(tables)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = timerValues.getCurrentWatermarkInMs()
        open_ = {k[0]: v[0] for k, v in self.slices.iterator()}
        due = sorted(start for start in open_ if (start + 1) * self.slice_ms <= now)
        if not due:
            return
        known = _unpacked(self.used.get()[0]) if self.used.exists() else None
        used = dict(zip(*(known[c].to_pylist() for c in ("budget", "micro")))) if known else {}
        for start in due:
            rows = self._slice(start, open_[start])
            coded = rows["budget"].combine_chunks().dictionary_encode("encode")
            names, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            ts, seq, cost = (rows[c].to_numpy() for c in ("ts", "seq", "cost"))
            order = np.lexsort((cost, seq, ts, code))
            code, ts, seq, cost = code[order], ts[order], seq[order], cost[order]
            starts = np.flatnonzero(np.diff(code, prepend=-1))
            budgets = [names[c] for c in code[starts].tolist()]
            before = np.array([used.get(b, 0) for b in budgets], np.int64)
            admitted, after, left = greedy_admit_groups(cost, starts, before, self.total, refuse_when_exhausted=True)
            used.update(zip(budgets, left.tolist()))
            yield pd.DataFrame({"budget": np.array(names, object)[code], "ts": pd.to_datetime(ts, unit="us"), "op_id": seq,
                                "epsilon_micro": cost, "allowed": admitted, "cumulative_micro": after})
        self.used.update((_packed(pa.table({"budget": pa.array(list(used), pa.string()),
                                            "micro": pa.array(list(used.values()), pa.int64())})),))
        rest = [start for start in open_ if start not in due]
        if rest:
            self.handle.registerTimer((min(rest) + 1) * self.slice_ms)

    def close(self) -> None:
        pass


def stream_budget_gate(ops: DataFrame, total_micro: int, time_col: str = "ts", seq_col: str = "op_id",
                       budget_col: str = "budget_id", cost_col: str = "epsilon_micro", delay: str = "1 hour",
                       slice_ms: int = 3_600_000, block_rows: int = BLOCK_ROWS, buckets: int = GATE_BUCKETS) -> DataFrame:
    """The budget gate (E4) in event-time order, append mode.

    An operation waits in the state until the watermark (``delay`` behind the
    latest event) has passed the end of its time slice, so operations that
    arrive out of order within the delay are judged in order, as the batch
    gate does; later ones are dropped.  Budgets are dealt over ``buckets``
    state keys by hash, so that the calls to the state grow with blocks of
    rows and not with budgets.  A bucket's state is what its budgets have
    consumed and, per open slice, blocks of at most ``block_rows`` sorted
    operations.  A bucket's slices are closed one by one by the gate's kernel:
    neither a bucket's micro-batch nor its backlog is ever one table in memory,
    but one of its slices is.  Operations at one time are ordered by ``seq_col``.

    Returns ``budget_id, ts, op_id, epsilon_micro, allowed,
    cumulative_micro``.  Needs the RocksDB state store.
    """
    rows = (ops.withColumn(time_col, F.col(time_col).cast("timestamp")).withWatermark(time_col, delay)
            .select(F.pmod(F.xxhash64(budget_col), F.lit(int(buckets))).cast("int").alias("bucket"),
                    F.col(budget_col).cast("string").alias("budget"), F.col(time_col).alias("ts"),
                    F.col(seq_col).cast("long").alias("seq"), F.col(cost_col).cast("long").alias("cost")))
    kind = ops.schema[budget_col].dataType
    out = "budget string, ts timestamp, op_id long, epsilon_micro long, allowed boolean, cumulative_micro long"
    gate = rows.groupBy("bucket").transformWithStateInPandas(
        GateProcessor(int(total_micro), slice_ms, block_rows), out, "Append", "EventTime")
    return gate.select(F.col("budget").cast(kind).alias("budget_id"), "ts", "op_id", "epsilon_micro", "allowed",
                       "cumulative_micro")


def stream_audit_counts(events: DataFrame, window: str = "1 day", delay: str = "1 hour",
                        ts_col: str = "timestamp", type_col: str = "event_type") -> DataFrame:
    """Closed tumbling-window counts per event type."""
    return (events.withWatermark(ts_col, delay)
            .groupBy(F.window(ts_col, window).alias("w"), type_col)
            .agg(F.count(F.lit(1)).alias("n_events"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    type_col, "n_events"))
