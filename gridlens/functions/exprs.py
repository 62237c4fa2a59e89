"""Scalar column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- rounding ---------------------------------------------------------------
# For query results only (operators return raw doubles).  round(x*10^k + 0.001)
# / 10^k stays a double at any magnitude and is the same text in both engines
# (without decimals both round a half away from zero).  The boundary sits 0.001 units of the last kept digit below the exact half:
# averages of few-decimal data often land *exactly* on a half, and summation
# order noise would otherwise push the engines to opposite sides of it.
NUDGE = 0.001


def rk(x, k: int = 6) -> Column:
    s = float(10 ** k)
    return F.round(_c(x).cast("double") * F.lit(s) + F.lit(NUDGE), 0) / F.lit(s)


def r6(x) -> Column:
    return rk(x, 6)


def rounded(df, k: int = 6):
    """Every double column of a query's result rounded to ``k`` digits."""
    return df.select(*[rk(F.col(f"`{f.name}`"), k).alias(f.name) if f.dataType.typeName() == "double" else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def rk_sql(x: str, k: int = 6) -> str:
    s = f"{float(10 ** k):.1f}"
    return f"CAST(round(CAST(({x}) AS DOUBLE) * {s} + {NUDGE}, 0) / {s} AS DOUBLE)"


def r6_sql(x: str) -> str:
    return rk_sql(x, 6)


# --- arithmetic ---------------------------------------------------------------

def safe_div(a, b, default: float | None = 0.0) -> Column:
    """a / b, ``default`` when b is 0 or null (ANSI-safe)."""
    q = F.try_divide(_c(a).cast("double"), _c(b).cast("double"))
    return q if default is None else F.coalesce(q, F.lit(float(default)))


def clip(x, lo: float | None, hi: float | None) -> Column:
    c = _c(x)
    if lo is not None:
        c = F.greatest(F.lit(float(lo)), c)
    if hi is not None:
        c = F.least(F.lit(float(hi)), c)
    return c


# --- time -----------------------------------------------------------------------

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_s(ts) -> Column:
    """Seconds since epoch (double, microsecond precision) of a timestamp_ntz."""
    name = ts if isinstance(ts, str) else None
    if name is not None:
        return F.expr(f"timestampdiff(MICROSECOND, {_EPOCH}, `{name}`) / 1e6")
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), ts) / F.lit(1e6)


def epoch_s_sql(ts: str) -> str:
    return f"(epoch_us({ts}) / 1e6)"




# --- angles ---------------------------------------------------------------------

def wrap_deg(x) -> Column:
    return F.pmod(_c(x).cast("double"), F.lit(360.0))


def angle_diff(target, source) -> Column:
    """Signed shortest difference target - source in (-180, 180]."""
    return F.pmod(_c(target) - _c(source) + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)


def wrap_deg_sql(x: str) -> str:
    return f"((({x}) % 360.0) + 360.0) % 360.0"


def angle_diff_sql(t: str, s: str) -> str:
    return f"({wrap_deg_sql(f'({t}) - ({s}) + 180.0')} - 180.0)"


# --- severity classes -------------------------------------------------------------
# Fixed values that must equal the reference: class edges 0 / 0.33 / 0.66 and
# the class names none, low, medium, high.
SEVERITY_EDGES = (0.33, 0.66)


def severity_class_sql(x: str) -> str:
    lo, hi = SEVERITY_EDGES
    return (f"CASE WHEN ({x}) >= {hi} THEN 'high' WHEN ({x}) >= {lo} THEN 'medium' "
            f"WHEN ({x}) > 0 THEN 'low' ELSE 'none' END")


def severity_class(x) -> Column:
    lo, hi = SEVERITY_EDGES
    c = _c(x)
    return (F.when(c >= hi, "high").when(c >= lo, "medium").when(c > 0, "low")
            .otherwise("none"))
