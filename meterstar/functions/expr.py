"""Column -> Column helpers (FN-*). All are built-in Spark expressions: no Python UDF anywhere.

Every helper stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Money and distance columns. A bare NUMERIC/DECIMAL cast in Spark is decimal(10,0) and silently
# rounds 1.55 to 2, so the precision and scale are always given.
MONEY = "decimal(18,3)"

# The vendor code -> name dictionary of the vendor dimension (no ELSE branch).
VENDOR_NAMES = {
    1: "Creative Mobile Technologies",
    2: "VeriFone Inc.",
    4: "Unknown/Other",
}

# Marker the surrogate key writes for a NULL input.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"

TS_TEXT = "yyyy-MM-dd HH:mm:ss"


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_cast(c: ColumnOrName, to: str, via_double: bool = False) -> Column:
    """FN-2/FN-18: cast that yields NULL on failure instead of raising (ANSI is on).

    ``try_cast('1.0' AS INT)`` is NULL; with ``via_double`` the text is read as a number first,
    so '1.0' becomes 1 (NaN still becomes NULL).
    """
    c = _c(c)
    if via_double:
        d = c.try_cast("double")
        c = F.when(F.isnan(d), F.lit(None)).otherwise(d)
    return c.try_cast(to)


def money(c: ColumnOrName) -> Column:
    return _c(c).cast(MONEY)


def as_text(c: ColumnOrName) -> Column:
    """Text for hashing: a plain cast. TIMESTAMP_NTZ and the other types used here print alike in every
    session; a zone-dependent TIMESTAMP follows the session time zone (UTC by this library's defaults)."""
    c = _c(c)
    return c.cast("string")


def row_hash(cols: Sequence[ColumnOrName], sep: str = "", binary: bool = True) -> Column:
    """FN-6: MD5 over the coalesced text of ``cols``.

    ``sep=""`` reproduces the reference load (no separator, so ("1","23") equals ("12","3"));
    pass a separator to avoid that collision. ``binary`` returns the 16 digest bytes.
    """
    parts = [F.coalesce(as_text(c), F.lit("")) for c in cols]
    text = F.concat_ws(sep, *parts) if sep else F.concat(*parts)
    digest = F.md5(text)
    return F.unhex(digest) if binary else digest


def surrogate_key(cols: Sequence[ColumnOrName]) -> Column:
    """FN-7: hex MD5 of the columns joined with '-', NULL written as a fixed marker.

    ``concat_ws`` alone would skip NULLs and let (NULL, 'a') collide with ('a', NULL).
    """
    parts = [F.coalesce(as_text(c), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def map_values(c: ColumnOrName, mapping: Mapping, default=None) -> Column:
    """FN-8: CASE c WHEN k THEN v ... [ELSE default] END."""
    c = _c(c)
    out = None
    for k, v in mapping.items():
        out = F.when(c == F.lit(k), F.lit(v)) if out is None else out.when(c == F.lit(k), F.lit(v))
    if out is None:
        return F.lit(default)
    return out.otherwise(F.lit(default)) if default is not None else out


def vendor_name(c: ColumnOrName) -> Column:
    return map_values(c, VENDOR_NAMES)


def minute_boundaries(start: ColumnOrName, end: ColumnOrName) -> Column:
    """FN-9: number of minute boundaries crossed from ``start`` to ``end`` (bigint).

    This is the warehouse ``datediff(minute)`` meaning: 00:00:59 -> 00:01:01 is 1, whereas
    Spark's ``timestampdiff(MINUTE)`` counts elapsed whole minutes and gives 0.
    """
    s = F.date_trunc("minute", _c(start).cast("timestamp"))
    e = F.date_trunc("minute", _c(end).cast("timestamp"))
    return ((F.unix_seconds(e) - F.unix_seconds(s)) / 60).cast("bigint")


def month_start(c: ColumnOrName) -> Column:
    """FN-10: first day of the month as DATE."""
    return F.trunc(_c(c).cast("date"), "month")


def hours_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """FN-13: (unix_timestamp(end) - unix_timestamp(start)) / 3600 as double (whole seconds)."""
    return (F.unix_seconds(_c(end).cast("timestamp")) - F.unix_seconds(_c(start).cast("timestamp"))) / F.lit(3600.0)


def parse_ts(c: ColumnOrName, fmt: str = TS_TEXT, strict: bool = False) -> Column:
    """FN-14: text -> timestamp. Lenient form gives NULL for bad text, strict form raises."""
    c = _c(c)
    return F.to_timestamp(c, fmt) if strict else F.try_to_timestamp(c, F.lit(fmt))


def format_ts(c: ColumnOrName, fmt: str = TS_TEXT) -> Column:
    """FN-15."""
    return F.date_format(_c(c), fmt)


def round_money(c: ColumnOrName, scale: int = 3) -> Column:
    """FN-16: ROUND(x::numeric, s): to a wide decimal first (no intermediate rounding at a
    smaller scale, which would round twice), then one half-up rounding."""
    return F.round(_c(c).cast("decimal(38,10)"), scale)


def ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Double quotient, NULL on a zero denominator (ANSI would raise)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def mean(c: ColumnOrName) -> Column:
    """Average as exact sum converted to double over the non-null count.

    Written so a SQL engine computing ``cast(sum(x) as double) / count(x)`` gets the same bits.
    """
    return ratio(F.sum(_c(c)), F.count(_c(c)))


def day_range(c: ColumnOrName, first_day: str, last_day: str) -> Column:
    """FLT-3: DATE(c) BETWEEN first AND last, written half-open on the raw column so the
    predicate stays sargable (pushed to the scan, prunes partitions / row groups)."""
    c = _c(c)
    return (c >= F.lit(first_day).cast("date").cast("timestamp_ntz")) & (
        c < F.date_add(F.lit(last_day).cast("date"), 1).cast("timestamp_ntz"))


def on_day(c: ColumnOrName, day: str) -> Column:
    """FLT-5: DATE(c) = day, half-open on the raw column."""
    return day_range(c, day, day)


def half_open(c: ColumnOrName, start, end) -> Column:
    """FLT-2: start <= c < end."""
    c = _c(c)
    return (c >= F.lit(start).cast("timestamp_ntz")) & (c < F.lit(end).cast("timestamp_ntz"))
