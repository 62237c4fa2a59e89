"""Fault sets by a sweep over each device's fault bounds.

The bounds of a device's faults are ranked by time; every ``PER_CHUNK`` of them
begin a new chunk of its time line.  A fault is listed in the chunks that hold
its bounds.  The chunks it covers from end to end are a range of chunk numbers,
which falls into a few nodes of a binary tree over them (two a level at most);
faults are reduced per node, with map-side partial aggregation, and a chunk
takes what its ancestors hold.  A telemetry row then meets the one chunk of its
time (an as-of join by day), so its cost does not grow with the number of
faults of its device.

For labels a fault falls into pieces - ramp, steady, ramp down, wave - between
which its severity has one form.  Of pieces of one form that cover a whole
chunk only the ones that can be the greatest are kept: of steady ones the
highest, of equal ramps the earliest, of equal ramp downs the latest end, of
waves those of the nearest phases.  Kept faults travel whole, so a row's severity is computed
by the same expression as without the sweep.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlens.operators.windows import global_row_number
from gridlens.session import materialised, setting

#: Bounds that make a chunk of a device's time line.
PER_CHUNK = 16
#: Parts of the period of waves.
SLOTS = 64
#: Classes of days over which the rows after a device's last bound are dealt.
SALTS = 16
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _us(t: str) -> str:
    return f"timestampdiff(MICROSECOND, {_EPOCH}, {t})"


def _windows(events: DataFrame, fields: list[str]) -> DataFrame:
    """Faults with a device and a window, in microseconds (``_b`` null: open)."""
    ev = events.where("device IS NOT NULL AND start_time IS NOT NULL AND (end_time IS NULL OR end_time > start_time)")
    return ev.select(F.col("device").alias("_dev"), F.struct(*fields).alias("_fault"), F.expr(_us("start_time")).alias("_a"),
                     F.expr(_us("end_time")).alias("_b"), *[F.col(f).alias(f"_f_{f}") for f in fields])


def pieces(events: DataFrame, fields: list[str], need: str, period: float) -> DataFrame:
    """Pieces of the faults: _dev, _a, _b, _key (pieces of one key can replace each other), _best (the greatest one may), _fault.

    need: ``all`` (every fault), ``any`` (whether there is one), ``labels``."""
    w = _windows(events, fields)
    if need != "labels":
        one = F.struct(F.lit(need).alias("kind"))
        return w.select("_dev", "_a", "_b", one.alias("_key"), F.col("_a").cast("double").alias("_best"), "_fault")
    w = w.withColumn("_rl", F.expr("least(coalesce(_f_ramp_seconds, 0.0D), coalesce((_b - _a) / 1e6, coalesce(_f_ramp_seconds, 0.0D)))"))
    w = w.withColumn("_up", F.expr("_a + CAST(ceil(greatest(_rl, 0.0D) * 1e6) AS BIGINT)"))
    w = w.withColumn("_down", F.expr("CASE WHEN _f_shape = 'linear' AND _f_ramp_down_seconds > 0 AND _b IS NOT NULL THEN "
                                     "greatest(_up, _a + CAST(ceil(((_b - _a) / 1e6 - _f_ramp_down_seconds) * 1e6) AS BIGINT)) END"))

    def piece(a, b, kind, p="CAST(NULL AS DOUBLE)", q="CAST(NULL AS DOUBLE)", best="_f_max_severity"):
        return (f"struct({a} AS a, {b} AS b, '{kind}' AS kind, {p} AS p, {q} AS q, CAST({best} AS DOUBLE) AS best, CAST(NULL AS BIGINT) AS tag)")
    mx = "CAST(_f_max_severity AS DOUBLE)"
    ramp = piece("_a", "least(_up, coalesce(_b, _up))", "ramp", mx, "_rl", "-_a")
    steady = piece("_up", "coalesce(_down, _b)", "steady")
    down = piece("coalesce(_down, _b)", "_b", "down", mx, "least(_f_ramp_down_seconds, (_b - _a) / 1e6 - _rl)", "_b")
    wave = piece("_up", "_b", "wave", mx, f"pmod(_a + greatest(_rl, 0.0D) * 1e6, {float(period) * 1e6!r}D)")
    # faults of another shape, or whose severity can't grow with their greatest one, stand for themselves
    own = f"struct(_a AS a, _b AS b, 'own' AS kind, {mx} AS p, CAST(NULL AS DOUBLE) AS q, 0.0D AS best, xxhash64(_fault) AS tag)"
    kinds = (f"CASE WHEN NOT coalesce(_f_max_severity >= 0, false) THEN array({own}) "
             f"WHEN _f_shape = 'abrupt' THEN array({piece('_a', '_b', 'steady')}) "
             f"WHEN _f_shape = 'linear' THEN array({ramp}, {steady}, {down}) "
             f"WHEN _f_shape = 'intermittent' THEN array({ramp}, {wave}) ELSE array({own}) END")
    got = w.withColumn("_p", F.explode(F.expr(kinds))).where("_p.b IS NULL AND (_p.kind <> 'down') OR _p.b > _p.a")
    key = F.struct(F.col("_f_event_type").alias("type"), F.col("_f_ord").alias("ord"), "_p.kind", "_p.p", "_p.q", "_p.tag")
    return got.select("_dev", F.col("_p.a").alias("_a"), F.col("_p.b").alias("_b"), key.alias("_key"), F.col("_p.best").alias("_best"), "_fault")


def _cover(low: str, high: str, levels: int) -> str:
    """SQL of the tree nodes (level, idx) whose ranges make up the chunk numbers low..high."""
    left = f"shiftright({low} + shiftleft(1L, k) - 1, k)"
    right = f"(shiftright({high} + 1, k) - 1)"
    return (f"flatten(transform(sequence(0, {levels - 1}), k -> filter(array_distinct(array("
            f"CASE WHEN {left} <= {right} AND {left} % 2 = 1 THEN struct(k AS level, {left} AS idx) END, "
            f"CASE WHEN {left} <= {right} AND {right} % 2 = 0 THEN struct(k AS level, {right} AS idx) END)), x -> x IS NOT NULL)))")


def _slot(t: str, period: float) -> str:
    """SQL of the part of the period in which a wave of greatest severity at ``t`` (microseconds) has its phase."""
    p = float(period) * 1e6
    return f"CAST(floor(pmod({t} - {p / 4!r}D, {p!r}D) / {p / SLOTS!r}D) AS BIGINT)"


def _wave_faults(held: DataFrame, line: DataFrame, period: float) -> DataFrame:
    """(_dev, _c, _slot, _fault): the waves that can be the greatest of their kind while a chunk passes each slot of the period.

    A wave's severity falls with the distance of its phase from the row's slot
    position, so those of the slot itself and the nearest ones on either side,
    around the period, suffice."""
    w = float(period) * 1e6 / SLOTS
    group = F.struct("_key.type", "_key.ord", "_key.p")
    waves = held.where("_key.kind = 'wave'").select("_dev", "_c", group.alias("_g"), F.col("_key.q").alias("_q"), F.col("_x._fault").alias("_fault"))
    waves = waves.withColumn("_b", F.least(F.floor(F.col("_q") / F.lit(w)), F.lit(SLOTS - 1)).cast("long"))
    ends = waves.groupBy("_dev", "_c", "_g", "_b").agg(F.min(F.struct("_q", "_fault")).alias("lo"), F.max(F.struct("_q", "_fault")).alias("hi"))
    around = ends.groupBy("_dev", "_c", "_g").agg(F.array_sort(F.collect_list(F.struct(F.col("_b").alias("b"), F.col("lo._fault").alias("lo"), F.col("hi._fault").alias("hi")))).alias("_all"))
    span = f"({_us('_to')} - {_us('_from')})"
    first = f"floor(pmod({_us('_from')} - {w * SLOTS / 4!r}D, {w * SLOTS!r}D) / {w!r}D)"
    slots = (f"CASE WHEN _to IS NULL OR {span} >= {w * SLOTS!r}D THEN sequence(0L, {SLOTS - 1}L) ELSE array_distinct(transform(sequence("
             f"CAST({first} AS BIGINT), CAST(floor((pmod({_us('_from')} - {w * SLOTS / 4!r}D, {w * SLOTS!r}D) + {span}) / {w!r}D) AS BIGINT)), s -> s % {SLOTS})) END")
    chunk = line.select(F.col("_dev").alias("_sd"), F.col("_c").alias("_sc"), F.expr(slots).alias("_slots"))
    same = (F.col("_dev") == F.col("_sd")) & (F.col("_c") == F.col("_sc"))
    at = around.join(chunk, same).select("_dev", "_c", "_all", F.explode("_slots").alias("_slot"))
    side = at.select("_dev", "_c", "_slot", F.explode(F.expr(
        "array(coalesce(try_element_at(filter(_all, x -> x.b < _slot), -1), element_at(_all, -1)).hi, "
        "coalesce(get(filter(_all, x -> x.b > _slot), 0), _all[0]).lo)")).alias("_fault"))
    own = waves.join(chunk, same).where(F.array_contains("_slots", F.col("_b"))).select("_dev", "_c", F.col("_b").alias("_slot"), "_fault")
    return side.unionByName(own)


def chunks(events: DataFrame, fields: list[str], need: str, period: float) -> DataFrame:
    """Chunks of every device's time line: _ev_device, _from, _to (null: the last one), _slot, _faults that may hold in them.

    ``_slot`` is -1, or a part of the period for which the row holds (chunks
    with waves have a row for each part they touch).  The table, which has a
    few times as many rows as the fault table, is written to the shared folder."""
    per_chunk = setting(events.sparkSession, "boundsPerChunk", PER_CHUNK)
    p = pieces(events, fields, need, period)
    bounds = p.select("_dev", F.explode(F.array_compact(F.array("_a", "_b"))).alias("_t")).distinct()
    bounds = bounds.withColumn("_ts", F.timestamp_add("MICROSECOND", F.col("_t"), F.expr(_EPOCH)))
    numbered = global_row_number(bounds, ["_dev"], "_ts", out="_rn").select(
        "_dev", "_t", "_ts", F.expr(f"(_rn - 1) div {int(per_chunk)}").cast("long").alias("_c"))
    numbered = materialised(numbered, "fault-bounds")
    levels = max(1, (numbered.agg(F.max("_c")).first()[0] or 0).bit_length())  # of the tree over the chunk numbers
    line = numbered.groupBy("_dev", "_c").agg(F.min("_ts").alias("_from"))
    line = line.withColumn("_to", F.lead("_from").over(Window.partitionBy("_dev").orderBy("_c")))  # a row per chunk

    def at(name):
        return numbered.select(F.col("_dev").alias(f"_d{name}"), F.col("_t").alias(f"_t{name}"), F.col("_c").alias(f"_c{name}"))
    p = p.join(at("a"), (F.col("_dev") == F.col("_da")) & (F.col("_a") == F.col("_ta"))).drop("_da", "_ta")
    p = p.join(at("b"), (F.col("_dev") == F.col("_db")) & (F.col("_b") == F.col("_tb")), "left").drop("_db", "_tb")
    p = materialised(p, "fault-pieces")
    edge = p.select("_dev", F.explode(F.array_distinct(F.array_compact(F.array("_ca", "_cb")))).alias("_c"), "_fault")
    through = p.select("_dev", "_key", "_best", "_fault", F.explode(F.expr(_cover("(_ca + 1)", f"coalesce(_cb - 1, {(1 << levels) - 1}L)", levels))).alias("_n"))
    through = through.select("_dev", "_n.level", "_n.idx", "_key", F.struct("_best", "_fault").alias("_x"))
    up = line.select("_dev", "_c", F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("level"))
    up = up.select(F.col("_dev").alias("_ud"), "_c", F.col("level").alias("_ul"), F.expr("shiftright(_c, level)").alias("_ui"))
    if need != "all":
        through = through.groupBy("_dev", "level", "idx", "_key").agg(F.max("_x").alias("_x"))
    held = up.join(through, (F.col("_ud") == F.col("_dev")) & (F.col("_ul") == F.col("level")) & (F.col("_ui") == F.col("idx")))
    if need != "all":
        held = held.groupBy("_dev", "_c", "_key").agg(F.max("_x").alias("_x"))
    held = materialised(held.select("_dev", "_c", "_key", "_x"), "fault-held")
    gather = F.collect_list if need == "all" else F.collect_set  # of one chunk
    still = held.where("_key.kind <> 'wave'").select("_dev", "_c", F.col("_x._fault").alias("_fault"))
    base = edge.unionByName(still).groupBy("_dev", "_c").agg(gather("_fault").alias("_base"))
    own = line.select(F.col("_dev").alias("_ld"), F.col("_c").alias("_lc"), "_from", "_to")
    none = F.array().cast(base.schema["_base"].dataType)
    same = (F.col("_dev") == F.col("_ld")) & (F.col("_c") == F.col("_lc"))
    out = own.join(base, same, "left").drop("_dev", "_c")
    if need == "labels":
        waves = _wave_faults(held, line, period).groupBy("_dev", "_c", "_slot").agg(gather("_fault").alias("_waves"))
        out = out.join(waves, same, "left").drop("_dev", "_c")
        faults = F.array_union(F.coalesce("_base", none), F.coalesce("_waves", none))
        out = out.withColumn("_slot", F.coalesce("_slot", F.lit(-1).cast("long")))
    else:
        out, faults = out.withColumn("_slot", F.lit(-1).cast("long")), F.coalesce("_base", none)
    return materialised(out.select(F.col("_ld").alias("_ev_device"), "_from", "_to", "_slot", faults.alias("_faults")), "fault-chunks")


def join_chunks(tel: DataFrame, chunk_table: DataFrame, device: str, time: str, period: float) -> DataFrame:
    """``tel`` with ``_all``: the faults of the chunk (and slot) of each row's device and time (null: none).

    Chunks but a device's last are joined by (device, day), which splits a hot
    device over its days; the last, which has no end, by device."""
    ended = chunk_table.where("_to IS NOT NULL").withColumn("_day", F.explode(F.sequence(
        F.col("_from").cast("date"), (F.col("_to") - F.expr("INTERVAL 1 MICROSECOND")).cast("date"))))
    last = chunk_table.where("_to IS NULL").select(F.col("_ev_device").alias("_last_device"), F.col("_from").alias("_last_from"),
                                                   F.col("_slot").alias("_last_slot"), F.col("_faults").alias("_last"))
    last = last.withColumn("_last_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.datediff(F.col(time).cast("date"), F.lit("1970-01-01").cast("date")), F.lit(SALTS))
    t, slot = F.col(time), F.expr(_slot(_us(f"`{time}`"), period))
    fits = lambda c: (F.col(c) == -1) | (F.col(c) == slot)
    j = tel.join(ended, (F.col(device) == F.col("_ev_device")) & (t.cast("date") == F.col("_day")) & (t >= F.col("_from")) & (t < F.col("_to"))
                 & fits("_slot"), "left")
    j = j.join(last, (F.col(device) == F.col("_last_device")) & (salt == F.col("_last_salt")) & (t >= F.col("_last_from")) & fits("_last_slot"), "left")
    return j.withColumn("_all", F.coalesce("_faults", "_last")).drop(
        "_ev_device", "_day", "_from", "_to", "_slot", "_faults", "_last_device", "_last_from", "_last_slot", "_last_salt", "_last")
