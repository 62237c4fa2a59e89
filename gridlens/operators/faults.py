"""Fault windows on telemetry: interval join, severity profile, labels, episodes.

Unified fault-event schema (one row per fault or outage)::

    device, event_type, start_time (ntz), end_time (ntz, NULL = never repaired),
    shape ('abrupt' | 'linear' | 'intermittent'), max_severity double,
    ramp_seconds double, ramp_down_seconds double, ord int

Windows are half-open ``[start_time, end_time)``.  Times are wall clock, not
row positions, so the telemetry may be irregular or have gaps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlens.functions.exprs import epoch_s, severity_class
from gridlens.operators.sweep import chunks, join_chunks

DAY = 86400
# Fixed value that must equal the reference: the intermittent pattern repeats
# every 6*24*3 ten-minute steps = 3 days; its floor is 0.35 and swing 0.65.
INTERMITTENT_PERIOD_S = 3 * DAY

EVENT_SCHEMA = T.StructType([
    T.StructField("device", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("start_time", T.TimestampNTZType()),
    T.StructField("end_time", T.TimestampNTZType()),
    T.StructField("shape", T.StringType()),
    T.StructField("max_severity", T.DoubleType()),
    T.StructField("ramp_seconds", T.DoubleType()),
    T.StructField("ramp_down_seconds", T.DoubleType()),
    T.StructField("ord", T.IntegerType()),
])

# Default upper bound (bytes) for shipping the event table to every executor.
BROADCAST_LIMIT = 64 * 1024 * 1024
# Faults of one device up to which a row simply goes through all of them.
FAULTS_PER_DEVICE = 64


def severity_sql(dt: str = "_dt", dur: str = "_dur", shape: str = "shape",
                 mx: str = "max_severity", ramp: str = "ramp_seconds",
                 ramp_down: str = "ramp_down_seconds",
                 period: float = INTERMITTENT_PERIOD_S,
                 unknown: str = "NULL") -> str:
    """Severity of one fault at ``dt`` seconds after its start (0 <= dt < dur).

    abrupt: max.  linear: max*dt/ramp during the ramp (0 at the first
    instant), then max; optional ramp-down to 0 at the end.  intermittent:
    ramp, then max*(0.35 + 0.65*(1+sin(2*pi*k/period))/2).
    """
    rl = f"least(coalesce({ramp}, 0.0), coalesce({dur}, coalesce({ramp}, 0.0)))"
    ramp_part = f"{mx} * {dt} / {rl}"
    rd_start = f"greatest({rl}, {dur} - {ramp_down})"
    linear = (f"CASE WHEN {rl} > 0 AND {dt} < {rl} THEN {ramp_part} "
              f"WHEN coalesce({ramp_down}, 0) > 0 AND {dur} IS NOT NULL AND {dt} >= {rd_start} "
              f"THEN {mx} * ({dur} - {dt}) / ({dur} - {rd_start}) "
              f"ELSE {mx} END")
    inter = (f"CASE WHEN {rl} > 0 AND {dt} < {rl} THEN {ramp_part} "
             f"ELSE {mx} * (0.35 + 0.65 * 0.5 * (1.0 + sin(2.0 * pi() * ({dt} - greatest({rl}, 0.0)) / {float(period)!r}))) END")
    return (f"CASE WHEN {shape} = 'abrupt' THEN {mx} WHEN {shape} = 'linear' THEN {linear} "
            f"WHEN {shape} = 'intermittent' THEN {inter} ELSE {unknown} END")


def normalise_events(faults: DataFrame, site_start: str, outages: DataFrame | None = None,
                     step_seconds: float = 600.0) -> DataFrame:
    """Config rows (day offsets, hours) -> wall-clock fault events.

    faults: device, event_type, start_day, end_day (NULL = open), shape,
            max_severity, ramp_days, ramp_down_days, ord
    outages: device, start_day, hours, severity -> appended as 'downtime',
             ordered after every fault (the label puts downtime last).
    Outage length is wall clock (start + hours), see quirk Q4.
    """
    t0 = F.expr(f"TIMESTAMP_NTZ'{site_start}'")

    def at(days):
        return F.timestamp_add("SECOND", F.round(days.cast("double") * DAY).cast("long"), t0)

    ev = faults.select(
        F.col("device").cast("string"), F.col("event_type"),
        at(F.col("start_day")).alias("start_time"),
        F.when(F.col("end_day").isNotNull(), at(F.col("end_day"))).alias("end_time"),
        F.coalesce(F.col("shape"), F.lit("linear")).alias("shape"),
        F.coalesce(F.col("max_severity").cast("double"), F.lit(1.0)).alias("max_severity"),
        F.greatest(F.lit(float(step_seconds)),
                   F.coalesce(F.col("ramp_days").cast("double"), F.lit(1.0)) * DAY).alias("ramp_seconds"),
        (F.coalesce(F.col("ramp_down_days").cast("double"), F.lit(0.0)) * DAY).alias("ramp_down_seconds"),
        F.col("ord").cast("int"),
    )
    if outages is not None:
        start = at(F.col("start_day"))
        out = outages.select(
            F.col("device").cast("string"), F.lit("downtime").alias("event_type"),
            start.alias("start_time"),
            F.timestamp_add("SECOND", F.round(F.col("hours").cast("double") * 3600).cast("long"),
                           start).alias("end_time"),
            F.lit("abrupt").alias("shape"),
            F.coalesce(F.col("severity").cast("double"), F.lit(1.0)).alias("max_severity"),
            F.lit(None).cast("double").alias("ramp_seconds"),
            F.lit(0.0).alias("ramp_down_seconds"),
            F.lit(1 << 30).alias("ord"),
        )
        ev = ev.unionByName(out)
    return ev


def join_strategy(events: DataFrame, broadcast_limit: int | None = None, force: str | None = None) -> str:
    """How fault events meet telemetry.  One count per device (map-side
    combined) decides: 'sweep' where a device has more than ``faultsPerDevice``
    faults, else 'broadcast' when the table fits the limit, else 'bucketed'."""
    if force:
        return force
    from gridlens.operators.joins import row_bytes
    from gridlens.session import setting
    limit = broadcast_limit or setting(events.sparkSession, "broadcastLimitBytes", BROADCAST_LIMIT)
    ev = events.select("device", *EVENT_FIELDS)
    size = row_bytes(ev)
    got = ev.groupBy("device").agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("s")).agg(F.max("n"), F.sum("s")).first()
    if (got[0] or 0) > setting(events.sparkSession, "faultsPerDevice", FAULTS_PER_DEVICE):
        return "sweep"
    return "broadcast" if (got[1] or 0) <= limit else "bucketed"


EVENT_FIELDS = ["event_type", "start_time", "end_time", "shape", "max_severity", "ramp_seconds", "ramp_down_seconds", "ord"]


def with_active_events(tel: DataFrame, events: DataFrame, device: str = "device", time: str = "time",
                       broadcast_limit: int | None = None, force: str | None = None, need: str = "all",
                       period: float = INTERMITTENT_PERIOD_S) -> DataFrame:
    """Telemetry rows as they are, plus ``_active``: the fault events that hold at the row's time.

    Windows are half-open; a NULL end never ends.  Events come as one array per
    key, so a row is joined once and never multiplied.  Where every device has
    few faults, the arrays are keyed by device and broadcast (no shuffle of the
    telemetry) if the table passes the size check; otherwise bounded events are
    keyed by (device, day), which splits a hot device over its days, and open
    ones by device alone.  Where a device has many, its time line is swept into
    chunks (:mod:`gridlens.operators.sweep`).  ``need`` says what the events are
    for: ``all`` of them, ``any`` (whether there is one), or ``labels``, for
    which those suffice that decide a flag, label or greatest severity.  Each
    event carries ``dt`` / ``dur`` seconds for the severity expression.
    """
    one = F.collect_list(F.struct(*EVENT_FIELDS))
    ev = events.select(F.col("device").alias("_ev_device"), *EVENT_FIELDS)
    strategy = force or join_strategy(events, broadcast_limit)
    if strategy == "sweep":
        j = join_chunks(tel, chunks(events, EVENT_FIELDS, need, period), device, time, period)
    elif strategy == "broadcast":
        per = ev.groupBy("_ev_device").agg(one.alias("_all"))
        j = tel.join(F.broadcast(per), F.col(device) == F.col("_ev_device"), "left").drop("_ev_device")
    else:
        bounded = ev.where("end_time IS NOT NULL AND end_time > start_time").withColumn("_day", F.explode(F.sequence(
            F.col("start_time").cast("date"), (F.col("end_time") - F.expr("INTERVAL 1 MICROSECOND")).cast("date"))))
        by_day = bounded.groupBy("_ev_device", "_day").agg(one.alias("_all"))
        open_ = ev.where("end_time IS NULL").groupBy(F.col("_ev_device").alias("_op_device")).agg(one.alias("_open"))
        j = tel.join(by_day, (F.col(device) == F.col("_ev_device")) & (F.col(time).cast("date") == F.col("_day")), "left")
        j = j.join(open_, F.col(device) == F.col("_op_device"), "left").drop("_ev_device", "_op_device", "_day")
        none = F.array().cast(by_day.schema["_all"].dataType)
        j = j.withColumn("_all", F.concat(F.coalesce("_all", none), F.coalesce("_open", none))).drop("_open")
    seconds = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {}) / 1e6"
    t = f"`{time}`"
    active = (f"filter(_all, e -> {t} >= e.start_time AND (e.end_time IS NULL OR {t} < e.end_time))")
    fields = ", ".join(f"e.{f} AS {f}" for f in EVENT_FIELDS)
    return j.withColumn("_active", F.expr(
        f"transform(coalesce({active}, array()), e -> struct({fields}, "
        f"{seconds.format(t)} - {seconds.format('e.start_time')} AS dt, "
        f"{seconds.format('e.end_time')} - {seconds.format('e.start_time')} AS dur))")).drop("_all")


def active_severities(period: float = INTERMITTENT_PERIOD_S) -> F.Column:
    """``_active`` as structs of ord, event_type, max_severity and severity (L2)."""
    sev = severity_sql("e.dt", "e.dur", "e.shape", "e.max_severity", "e.ramp_seconds", "e.ramp_down_seconds", period,
                       "raise_error(concat('unknown fault shape: ', e.shape))")
    return F.expr("transform(_active, e -> struct(e.ord AS ord, e.event_type AS event_type, "
                  f"e.max_severity AS max_severity, CAST({sev} AS DOUBLE) AS severity))")


def attach_faults(tel: DataFrame, events: DataFrame, device: str = "device", time: str = "time",
                  how: str = "left", broadcast_limit: int | None = None, force: str | None = None) -> DataFrame:
    """Interval join telemetry x fault events (L1): telemetry columns, event
    columns, ``_dt`` / ``_dur`` seconds; ``how`` is left, inner, left_semi or
    left_anti.  See :func:`with_active_events` for the join."""
    some = how in ("left_semi", "left_anti")
    j = with_active_events(tel, events, device, time, broadcast_limit, force, "any" if some else "all")
    if some:
        return j.where(F.size("_active") > 0 if how == "left_semi" else F.size("_active") == 0).drop("_active")
    explode = F.explode if how == "inner" else F.explode_outer
    j = j.withColumn("_e", explode("_active")).drop("_active")
    return j.select(*tel.columns, *[F.col(f"_e.{f}").alias(f) for f in EVENT_FIELDS],
                    F.col("_e.dt").alias("_dt"), F.col("_e.dur").alias("_dur"))


def with_severity(joined: DataFrame, period: float = INTERMITTENT_PERIOD_S) -> DataFrame:
    """Adds ``severity`` (L2) to the output of :func:`attach_faults`."""
    return joined.withColumn(
        "severity",
        F.when(F.col("event_type").isNull(), F.lit(0.0)).otherwise(
            F.expr(severity_sql(period=period, unknown="raise_error(concat('unknown fault shape: ', shape))"))))


def label_telemetry(tel: DataFrame, events: DataFrame, fault_types: list[str],
                    device: str = "device", time: str = "time", keep: list[str] | None = None,
                    normalise: bool = False, **join_kw) -> DataFrame:
    """Ground-truth labels per telemetry row (L1 -> L2 -> L3 -> L4).

    One output row per input row, equal rows included, with: ``fault_<type>`` 0/1 per configured
    type, ``is_faulted``, ``fault_labels`` ('|'-joined types in event order,
    'downtime' last, 'healthy' when none), ``severity`` (max over active
    faults), ``fault_severity`` class, ``fault_start_time`` (earliest
    positive-severity time of the device, on all its rows) and
    ``time_since_fault`` (NULL before that start).
    """
    keep = keep or []
    j = with_active_events(tel.select(device, time, *keep), events, device, time, need="labels", **join_kw)
    j = j.withColumn("_sev", active_severities()).drop("_active")
    # a fault type of no severity counts as it is when normalised
    value = "s.severity / nullif(s.max_severity, 0)" if normalise else "s.severity"
    flags = [F.expr(f"CAST(exists(_sev, s -> s.severity > 0 AND s.event_type = '{t}') AS INT)").alias(f"fault_{t}")
             for t in [*fault_types, *([] if "downtime" in fault_types else ["downtime"])]]
    on = "filter(_sev, s -> s.severity > 0)"
    labels = F.expr(f"array_join(array_distinct(transform(array_sort(transform({on}, s -> struct(s.ord AS ord, s.event_type AS event_type))), "
                    "s -> s.event_type)), '|')")
    out = j.select(device, time, *keep, F.expr(f"coalesce(array_max(transform(_sev, s -> {value})), 0.0D)").alias("severity"), *flags,
                   F.expr(f"size({on}) > 0").alias("_on"), labels.alias("_lab"))
    out = (out.withColumn("is_faulted", (F.col("severity") > 0).cast("int"))
           .withColumn("fault_labels", F.when(F.col("_on"), F.col("_lab")).otherwise(F.lit("healthy")))
           .withColumn("fault_severity", severity_class(F.col("severity"))).drop("_on", "_lab"))
    # L4: earliest fault start per device, as a small aggregate joined back
    # (no device-wide window, so a hot device is not sorted in one task).
    starts = (out.where(F.col("is_faulted") == 1).groupBy(device)
              .agg(F.min(time).alias("fault_start_time")))
    # Derived per-device table: AQE broadcasts it at run time from its measured
    # size (no extra counting job); unused, the join is pruned away entirely.
    out = out.join(starts, device, "left")
    return out.withColumn(
        "time_since_fault",
        F.when(F.col(time) >= F.col("fault_start_time"),
               epoch_s(F.col(time)) - epoch_s(F.col("fault_start_time"))))


def fault_progress(tel: DataFrame, events: DataFrame, device: str = "device", time: str = "time",
                   **join_kw) -> DataFrame:
    """Per telemetry row and active fault: progress of the ramp 0..1 and time since start."""
    j = with_severity(attach_faults(tel.select(device, time), events, device, time, how="inner", **join_kw))
    rl = F.least(F.coalesce(F.col("ramp_seconds"), F.lit(0.0)), F.coalesce(F.col("_dur"), F.col("ramp_seconds"), F.lit(0.0)))
    prog = F.when(F.col("shape") == "abrupt", F.lit(1.0)).when(rl <= 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.col("_dt") / rl))
    return j.select(device, time, "event_type", F.col("_dt").alias("seconds_since_start"),
                    prog.alias("progress"), "severity")


def episodes(labelled: DataFrame, flag: str, device: str = "device", time: str = "time",
             tiebreak: list[str] | None = None, bucket_seconds: int | None = None) -> DataFrame:
    """Gaps-and-islands: consecutive rows with ``flag``=1 -> one episode.

    Where the fullest device is small, one sort per device does it; else rows
    are numbered inside (device, day) buckets and shifted by a prefix sum over
    the small bucket table, so no task holds a whole device.  Output: device, start_time,
    end_time (last flagged row), n_rows.
    """
    from pyspark.sql import Window

    from gridlens.operators.windows import auto_bucket_seconds, global_row_number, one_sort_per_key
    tiebreak = tiebreak or []
    src = labelled.select(device, time, flag, *tiebreak)
    if bucket_seconds is None and one_sort_per_key(src, [device]):
        # one sort: the island id is the number of unflagged rows so far
        w = Window.partitionBy(device).orderBy(time, *tiebreak).rowsBetween(Window.unboundedPreceding, 0)
        isl = src.withColumn("_island", F.count_if(F.coalesce(F.col(flag), F.lit(0)) != 1).over(w)).where(F.col(flag) == 1)
    else:
        # the flagged rows are a subset, so one width (measured on all rows) serves both numberings
        bucket_seconds = bucket_seconds or auto_bucket_seconds(src, [device], time)
        numbered = global_row_number(src, [device], time, tiebreak, bucket_seconds=bucket_seconds, out="_rn")
        fl = numbered.where(F.col(flag) == 1)
        # island id = row number among all rows - row number among flagged rows
        fl = global_row_number(fl, [device], time, tiebreak, bucket_seconds=bucket_seconds, out="_rf")
        isl = fl.withColumn("_island", F.col("_rn") - F.col("_rf"))
    return (isl.groupBy(device, "_island")
            .agg(F.min(time).alias("start_time"), F.max(time).alias("end_time"),
                 F.count(F.lit(1)).alias("n_rows"))
            .drop("_island"))
