"""Order-line parsing and sales measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed formats of the order lines: date 'MM/dd/yy HH:mm' and address
# '<number> <street>, <city>, <ST> <zip>'.
DATE_FMT = "MM/dd/yy HH:mm"
ADDR_RE = r", ([A-Za-z ]+), ([A-Z]{2}) ([0-9]{5})$"


def parse_sales(lines: DataFrame, date_col: str, addr_col: str, key: str) -> DataFrame:
    """Parse dates and split addresses; unparsable parts become NULL
    (``try_to_timestamp``/``regexp_extract`` + nullif), never an error."""
    def part(i):
        return F.expr(f"nullif(regexp_extract(`{addr_col}`, '{ADDR_RE}', {i}), '')")
    return lines.select(
        key,
        F.expr(f"try_to_timestamp(`{date_col}`, '{DATE_FMT}')").cast("timestamp_ntz").alias("order_time"),
        F.expr(f"nullif(regexp_extract(`{addr_col}`, '^([^,]+),', 1), '')").alias("street"),
        part(1).alias("city"), part(2).alias("state"), part(3).alias("zip"))


def rejected_lines(parsed: DataFrame) -> DataFrame:
    """Rows of :func:`parse_sales` that a report leaves out (no date or no city), by reason."""
    return parsed.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("order_time").isNull()).alias("n_no_date"),
                      F.count_if(F.col("city").isNull()).alias("n_no_city"),
                      F.count_if(F.col("order_time").isNull() | F.col("city").isNull()).alias("n_rejected"))


def sales_by(lines: DataFrame, keys: list, quantity: str, price: str) -> DataFrame:
    """Orders lines, units and revenue (quantity x price) by city, hour, product or any keys."""
    return lines.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_lines"), F.sum(quantity).cast("double").alias("units"),
                                    F.sum((F.col(quantity) * F.col(price)).cast("double")).alias("revenue"))
