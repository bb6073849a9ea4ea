"""Sessions of a transaction stream with keyed state and event-time timers."""

from __future__ import annotations

import json
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.scalar import interval, micros
from tidemark.operators.windows import finish
from tidemark.schemas import HIGH_AMOUNT

# A cell of time holds the milliseconds in which records fell as the bits of one number.
CELL_MS = 60
_FIELDS = ("first", "last", "edge", "n", "total", "top", "low", "near", "anomalies", "highs", "categories", "merchants", "devices")
_DISTINCT = (("category", "categories"), ("merchant_id", "merchants"), ("device_type", "devices"))
_OUT = (
    "user_id string, first_us long, last_us long, txn_count long, txn_sum double, txn_max double, txn_min double, "
    "unique_categories long, unique_merchants long, unique_devices long, min_gap long, anomaly_count long, "
    "high_amount_count long"
)


def _least(*gaps: int | None) -> int | None:
    return min((g for g in gaps if g is not None), default=None)


class Sessions(StatefulProcessor):
    """Open sessions of a user.

    State: the numbers of each open session, an entry per distinct value of each, and the milliseconds of recent records
    as bits of cells. Records may still come in between others until the watermark has passed them; the least gap is
    taken from the cells once it has, and the cells are dropped. So state is bounded by the distinct values of open
    sessions and the cells of the last ``gap`` and lateness, however many records a session has and however long it lasts.
    All of it is one JSON value, read and written once per user and trigger: a call of the state store for each entry takes
    longer than the work on a record.
    """

    def __init__(self, gap_us: int, high_amount: float):
        self.gap, self.high = gap_us, high_amount

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("sessions", "json string")

    def _load(self) -> dict[int, dict]:
        kept = self.state.get()
        kept = {"open": [], "seen": [], "cells": [], "due": None} if kept is None else json.loads(kept[0])
        self.seen, self.cells = {(i, kind, value) for i, kind, value in kept["seen"]}, dict(kept["cells"])
        self.due = kept["due"]
        return {i: dict(zip(_FIELDS, v)) for i, v in kept["open"]}

    def _save(self, sessions: dict[int, dict]) -> None:
        if sessions:
            found = [(i, [s[f] for f in _FIELDS]) for i, s in sessions.items()]
            kept = {"open": found, "seen": list(self.seen), "cells": list(self.cells.items()), "due": self.due}
            self.state.update((json.dumps(kept),))
        else:
            self.state.clear()

    @staticmethod
    def _due(s: dict) -> int:
        """The session ends once the watermark, which lags by the gap, reaches its last record."""
        return -(-s["last"] // 1000)

    # -- records

    def _merge(self, sessions: dict[int, dict], kept: int, other: int) -> None:
        a, b = sessions[kept], sessions.pop(other)
        for f in ("n", "total", "anomalies", "highs"):
            a[f] += b[f]
        a["first"], a["last"] = min(a["first"], b["first"]), max(a["last"], b["last"])
        a["top"], a["low"] = max(a["top"], b["top"]), min(a["low"], b["low"])
        a["near"] = _least(a["near"], b["near"])
        edges = [s["edge"] for s in (a, b) if s["edge"] is not None]
        a["edge"] = max(edges, default=None)
        for key in [k for k in self.seen if k[0] == other]:
            self.seen.remove(key)
            self._note(kept, a, key[1], key[2])

    def _note(self, i: int, s: dict, kind: int, value: str) -> None:
        key = (i, kind, value)
        if key not in self.seen:
            self.seen.add(key)
            s[_DISTINCT[kind][1]] += 1

    def _mark(self, s: dict, ms: list[int]) -> None:
        for m in ms:
            cell, bit = divmod(m, CELL_MS)
            old = self.cells.get(cell, 0)
            if old >> bit & 1:
                s["near"] = 0
            self.cells[cell] = old | 1 << bit

    def _add(self, sessions: dict[int, dict], part: dict[str, np.ndarray]) -> int:
        """Records no further apart than the gap join the sessions they touch."""
        us, amount = part["event_us"], part["amount"]
        lo, hi = int(us[0]), int(us[-1])
        touched = [i for i, s in sessions.items() if s["first"] - self.gap <= hi and lo <= s["last"] + self.gap]
        if not touched:
            sessions[lo] = dict.fromkeys(_FIELDS, 0) | {"first": lo, "last": hi, "edge": None, "near": None, "total": 0.0,
                                                        "top": -np.inf, "low": np.inf}
            touched = [lo]
        kept = touched[0]
        for other in touched[1:]:
            self._merge(sessions, kept, other)
        s = sessions[kept]
        s["first"], s["last"] = min(s["first"], lo), max(s["last"], hi)
        s["n"] += len(us)
        s["total"] += float(amount.sum())
        s["top"], s["low"] = max(s["top"], float(amount.max())), min(s["low"], float(amount.min()))
        s["anomalies"] += int(part["is_anomaly"].sum())
        s["highs"] += int((amount > self.high).sum())
        for kind, (column, _) in enumerate(_DISTINCT):
            for value in set(part[column].tolist()):
                self._note(kept, s, kind, "" if value is None or value != value else f"={value}")
        self._mark(s, (us // 1000).tolist())
        return kept

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        sessions, changed = self._load(), set()
        for chunk in rows:
            if chunk.empty:
                continue
            us = chunk["event_us"].to_numpy()
            order = np.argsort(us, kind="stable")
            names = ("event_us", "amount", "is_anomaly", *(c for c, _ in _DISTINCT))
            held = {c: chunk[c].to_numpy()[order] for c in names}
            cuts = np.flatnonzero(np.diff(us[order]) > self.gap) + 1
            for a, b in zip([0, *cuts], [*cuts, len(us)]):
                changed.add(self._add(sessions, {c: x[a:b] for c, x in held.items()}))
        final = timerValues.getCurrentWatermarkInMs()
        changed = [sessions[i] for i in changed & set(sessions)]
        long = [s for s in changed if final - (s["first"] // 1000 if s["edge"] is None else s["edge"]) > self.gap // 1000]
        self._fold(long, final)
        self._set_timer(sessions)
        self._save(sessions)
        yield pd.DataFrame()

    # -- the watermark

    def _set_timer(self, sessions: dict[int, dict]) -> None:
        """One timer, for the session that ends first."""
        due = min((self._due(s) for s in sessions.values()), default=None)
        if due != self.due:
            if self.due is not None:
                self.handle.deleteTimer(self.due)
            if due is not None:
                self.handle.registerTimer(due)
        self.due = due

    def _fold(self, sessions: list[dict], final: int) -> None:
        """Takes the gaps between the records of sessions up to ``final`` and drops their cells."""
        if not sessions:
            return
        left, at = self.cells, sorted(self.cells)
        for s in sessions:
            lo, hi = s["first"] // 1000, min(final, s["last"] // 1000)
            times = [] if s["edge"] is None else [s["edge"]]
            for cell in at[bisect_left(at, lo // CELL_MS) : bisect_right(at, hi // CELL_MS)]:
                bits = [b for b in range(CELL_MS) if left[cell] >> b & 1 and lo <= cell * CELL_MS + b <= hi]
                times += [cell * CELL_MS + b for b in bits]
                left[cell] &= ~sum(1 << b for b in bits)
            s["near"] = _least(s["near"], *(b - a for a, b in zip(times, times[1:])))
            s["edge"] = times[-1] if times else None
        self.cells = {cell: mask for cell, mask in left.items() if mask}

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        final, sessions = timerValues.getCurrentWatermarkInMs(), self._load()
        ended = {i: s for i, s in sessions.items() if self._due(s) <= final}
        self._fold(list(ended.values()), final)
        self.seen = {k for k in self.seen if k[0] not in ended}
        left = {i: s for i, s in sessions.items() if i not in ended}
        if self.due is not None and self.due <= final:  # the timer that fired
            self.handle.deleteTimer(self.due)
            self.due = None
        self._set_timer(left)
        self._save(left)
        out = [(key[0], s["first"], s["last"], s["n"], s["total"], s["top"], s["low"], s["categories"], s["merchants"],
                s["devices"], s["near"], s["anomalies"], s["highs"]) for s in ended.values()]
        columns = [c.split()[0] for c in _OUT.split(", ")]
        yield pd.DataFrame(out, columns=columns).astype({"min_gap": "Int64"}) if out else pd.DataFrame()

    def close(self) -> None:
        pass


def stream_session_features(
    txns: DataFrame,
    gap: timedelta,
    label: str = "session",
    lateness: timedelta = timedelta(seconds=5),
    high_amount: float = HIGH_AMOUNT,
    computed_at: Column | None = None,
) -> DataFrame:
    """The window features per session of a stream: a user's records without a pause longer than ``gap``.

    A session is emitted once the watermark passes its end, ``gap`` after its last record; until then late records join
    it and may join two sessions. The watermark of the query lags by ``gap`` more than ``lateness``, so that exactly the
    records whose session could only be a closed one are dropped. Needs the RocksDB state store while the query starts.
    """
    if micros(gap) < 1000:
        raise ValueError("the gap of a session must be a millisecond or more")
    rows = txns.withWatermark("event_ts", interval(lateness + gap)).select(
        F.col("user_id").cast("string").alias("user_id"),
        "event_ts",
        F.unix_micros("event_ts").alias("event_us"),
        F.coalesce(F.col("amount").cast("double"), F.lit(0.0)).alias("amount"),
        F.coalesce("is_anomaly", F.lit(False)).alias("is_anomaly"),
        *[F.col(c).cast("string").alias(c) for c, _ in _DISTINCT],
    )
    closed = rows.groupBy("user_id").transformWithStateInPandas(
        Sessions(micros(gap), high_amount), outputStructType=_OUT, outputMode="Append", timeMode="EventTime"
    )
    closed = closed.withColumns({
        "window_start": F.timestamp_micros("first_us"), "window_end": F.timestamp_micros(F.col("last_us") + micros(gap)),
        "first_ms": F.floor(F.col("first_us") / 1000), "last_ms": F.floor(F.col("last_us") / 1000),
    })
    return finish(closed, label, computed_at)
