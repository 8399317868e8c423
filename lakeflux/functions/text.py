"""String and date helpers (X1, X2, X5) as JVM-side Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the original results) ---------------------
# Operating-system names searched in a user-agent string, in this order; a
# later name in the list wins when several occur. Fallback label for no hit.
OS_NAMES = ["android", "iphone", "ubuntu", "windows", "macintosh"]
OS_FALLBACK = "Outro"
# Date formats of the zone object names: day folder and file stamp.
DAY_FORMAT = "yyyyMMdd"
STAMP_FORMAT = "yyyy-MM-dd_HH'h'mm'm'ss's'SSSSSS"
# ---------------------------------------------------------------------------


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def os_family(user_agent: str | Column) -> Column:
    """Classify a user-agent string by substring.

    The last matching name of ``OS_NAMES`` wins, so the ``when`` chain tests
    the names in reverse order. No hit gives ``OS_FALLBACK``; null stays null.
    """
    lowered = F.lower(_col(user_agent))
    expr = None
    for name in reversed(OS_NAMES):
        cond = lowered.contains(name)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return F.when(lowered.isNull(), F.lit(None).cast("string")).otherwise(
        expr.otherwise(F.lit(OS_FALLBACK))
    )


def day_folder(ts: str | Column) -> Column:
    """``yyyyMMdd`` of a timestamp."""
    return F.date_format(_col(ts), DAY_FORMAT)


def file_stamp(ts: str | Column) -> Column:
    """``yyyy-MM-dd_HHhMMmSSsffffff`` of a timestamp."""
    return F.date_format(_col(ts), STAMP_FORMAT)


def object_name(prefix: str, ts: str | Column, suffix: str = ".csv") -> Column:
    """``<prefix>/<yyyyMMdd>/<prefix>-<stamp><suffix>``."""
    return F.concat(
        F.lit(prefix + "/"), day_folder(ts), F.lit("/" + prefix + "-"), file_stamp(ts), F.lit(suffix)
    )
