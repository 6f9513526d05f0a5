"""Column helpers: every one returns a JVM-side ``Column`` expression, so plans stay
inside whole-stage codegen.  No Python UDF anywhere in this module."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean earth radius used by the great-circle distance (km).
EARTH_RADIUS_KM = 6371.0

ColumnOrName = Column | str


def c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_divide(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``SAFE_DIVIDE``: NULL instead of an error when the denominator is 0 or NULL."""
    return F.try_divide(c(num), c(den))


def count_where(pred: Column) -> Column:
    """``COUNTIF``: counts rows where ``pred`` is TRUE (NULL counts as false); bigint."""
    return F.count_if(pred)


def to_int(x: ColumnOrName) -> Column:
    """string -> double -> int.  Truncates toward zero ("12.9" -> 12, "-3.7" -> -3);
    anything unparseable, NaN or out of int range becomes NULL instead of failing.

    Empty strings (most of the cause / time columns of a real archive) short-cut to
    NULL: a failed ``try_cast`` costs an exception per value, ~2x the whole cast."""
    col = c(x)
    return F.when(col != "", col.try_cast("double").try_cast("int"))


def to_double(x: ColumnOrName) -> Column:
    """string -> double, NULL for empty / unparseable values (see ``to_int``)."""
    col = c(x)
    return F.when(col != "", col.try_cast("double"))


_ISO_DATE = "^[1-9][0-9]{3}-[0-9]{2}-[0-9]{2}$"


def parse_date(x: ColumnOrName, fmt: str = "yyyy-MM-dd") -> Column:
    """Strict date parse; malformed or impossible dates ("2019-02-30") give NULL.

    Plain ISO dates short-cut to a cast, which agrees with the formatter there and costs a
    fraction of it; every other text goes to the formatter."""
    slow = F.try_to_date(c(x), fmt)
    return slow if fmt != "yyyy-MM-dd" else F.when(c(x).rlike(_ISO_DATE), c(x).try_cast("date")).otherwise(slow)


def bucketize(x: ColumnOrName, cases: Sequence[tuple[Column, str]], default: str) -> Column:
    """CASE WHEN chain: first matching predicate wins, ``default`` for everything
    else -- including NULL inputs, exactly like an SQL ``ELSE``."""
    expr = None
    for pred, label in cases:
        expr = F.when(pred, F.lit(label)) if expr is None else expr.when(pred, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def haversine_km(lat1: ColumnOrName, lon1: ColumnOrName, lat2: ColumnOrName, lon2: ColumnOrName,
                 radius_km: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance between two points given in degrees."""
    p1, p2 = F.radians(c(lat1)), F.radians(c(lat2))
    dphi = (p2 - p1) / 2
    dlmb = (F.radians(c(lon2)) - F.radians(c(lon1))) / 2
    h = F.pow(F.sin(dphi), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb), 2)
    return F.lit(2 * radius_km) * F.asin(F.sqrt(h))


def month_start(x: ColumnOrName) -> Column:
    """``DATE_TRUNC(d, MONTH)`` as a DATE (``date_trunc`` would give a timestamp)."""
    return F.trunc(c(x), "MM")


def pct(num: Column, den: Column, digits: int = 2) -> Column:
    """ROUND(SAFE_DIVIDE(num, den) * 100, digits)."""
    return F.round(safe_divide(num, den) * 100, digits)
