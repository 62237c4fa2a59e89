"""Exact trailing counts over a stream with ``transformWithState`` (T2, the twin of A1)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from gridlens.streaming.twins import _EPOCH, to_instant

#: What an event is to a slice: its own row, a time that only some of its rows count, or one that all of them do.
OWN, PARTIAL, WHOLE = 0, 1, 2


class TrailingCounts(StatefulProcessor):
    """State of one (keys, sub-slice): its rows, the earlier times that reach a part of it, and a count of those that reach all of it.

    Rows and times are list state, appended to and read once; the earlier
    events that every row counts are carried as one number.  An event-time
    timer at the end of the slice emits the rows and clears all three.
    """

    def __init__(self, keys: list[str], id_col: str, ts: str, n: int, span_us: int, sub_us: int, parts: int):
        self.keys, self.id_col, self.ts, self.n = keys, id_col, ts, n
        self.span_us, self.sub_us, self.parts = span_us, sub_us, parts

    def init(self, handle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", T.StructType([T.StructField("us", T.LongType()), T.StructField("id", T.StringType())]))
        self.times = handle.getListState("times", "us long")
        self.carried = handle.getValueState("carried", "n long")

    def handleInputRows(self, key, rows, timerValues):
        import pandas as pd

        carried = 0
        for pdf in rows:
            # by position: names with a leading underscore or a space do not reach this frame
            ids, us, kind = (pdf.iloc[:, i] for i in (-5, -3, -1))
            if (kind == OWN).any():
                self.rows.appendList(list(zip(us[kind == OWN].tolist(), ids[kind == OWN].tolist())))
            if (kind == PARTIAL).any():
                self.times.appendList([(x,) for x in us[kind == PARTIAL].tolist()])
            carried += int((kind == WHOLE).sum())
        if carried:
            self.carried.update(((self.carried.get()[0] if self.carried.exists() else 0) + carried,))
        self.handle.registerTimer((key[-1] // self.parts + 1) * self.parts * self.sub_us // 1000)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        import numpy as np
        import pandas as pd

        rows = list(self.rows.get()) if self.rows.exists() else []
        earlier = np.sort(np.array([us for us, in self.times.get()] if self.times.exists() else [], dtype=np.int64))
        carried = self.carried.get()[0] if self.carried.exists() else 0
        for state in (self.rows, self.times, self.carried):
            state.clear()
        us = np.array([r[0] for r in rows], dtype=np.int64)
        ids = np.array([r[1] for r in rows], dtype=object)
        order = np.argsort(us, kind="stable")
        us, ids = us[order], ids[order]
        count = (carried + np.searchsorted(us, us, side="right") - np.searchsorted(us, us - self.span_us, side="left")
                 + len(earlier) - np.searchsorted(earlier, us - self.span_us, side="left"))
        hit = count >= self.n
        out = pd.DataFrame({self.id_col: ids[hit].tolist(), self.ts: pd.to_datetime(us[hit], unit="us"), "n_in_window": count[hit].astype(np.int64)})
        for name, value in zip(self.keys, key):
            out[name] = value
        yield out[[*self.keys, self.id_col, self.ts, "n_in_window"]] if len(out) else pd.DataFrame()

    def close(self) -> None:
        pass


def stream_velocity_exact(ev: DataFrame, ts: str, keys: list[str], id_col: str, n: int, span_seconds: float,
                          slice_seconds: float | None = None, delay: str = "10 minutes", parts: int = 4) -> DataFrame:
    """T2 exact (twin of A1): per row the number of events of its keys in the
    trailing range, as the batch form counts them, for rows of closed slices.

    Time is cut into slices (by default as long as the range), and each into
    ``parts`` sub-slices, which hold state apart: a hot key is spread over them.
    An event goes to its own sub-slice, as a bare time to the one or two that
    its range reaches in part, and as a count to those it reaches as a whole.
    When the watermark passes the end of the slice, timers emit its rows and
    drop the state.  Files may arrive in any order within the delay.  State of
    a (keys, sub-slice) is at most its own rows, the times of about one
    sub-slice's length a range before it, and one number.  More parts mean
    less state in one place and more copies (parts + 2 per range).  Null keys
    are a key; rows without time are dropped.

    Needs the RocksDB state store, which ``run_available_now`` sets.
    """
    span_us = int(round(span_seconds * 1_000_000))
    slice_us = int(round((slice_seconds or span_seconds) * 1_000_000))
    parts = math.gcd(slice_us, parts)
    sub_us = slice_us // parts
    fields = {f.name: f for f in ev.schema.fields}
    # ids travel as text: a column of whole numbers with nulls would reach pandas as floats
    out_schema = T.StructType([*[fields[k] for k in keys], T.StructField(id_col, T.StringType()),
                               T.StructField(ts, T.TimestampNTZType()), T.StructField("n_in_window", T.LongType())])
    own, us = F.floor(F.col("_us") / F.lit(sub_us)).cast("long"), F.col("_us")
    s = (ev.where(F.col(ts).isNotNull()).select(*keys, id_col, ts).withColumn("_t", to_instant(ts)).withWatermark("_t", delay)
         .withColumn("_us", F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), F.col(ts)))
         .withColumn("_sub", F.explode(F.sequence(own, F.floor((us + span_us) / F.lit(sub_us)).cast("long")))))
    kind = F.when(F.col("_sub") == own, OWN).when(us + span_us >= (F.col("_sub") + 1) * sub_us - 1, WHOLE).otherwise(PARTIAL)
    s = s.select(*keys, F.when(F.col("_sub") == own, F.col(id_col).cast("string")).alias(id_col), "_t", "_us", "_sub", kind.alias("_kind"))
    processor = TrailingCounts(list(keys), id_col, ts, n, span_us, sub_us, parts)
    out = s.groupBy(*keys, "_sub").transformWithStateInPandas(processor, out_schema, "Append", "EventTime")
    return out.withColumn(id_col, F.col(id_col).cast(fields[id_col].dataType))
