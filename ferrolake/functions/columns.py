"""Column -> Column helpers: built-in expressions only, so everything stays inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for the same results.
SIZE_BAND_BOUNDS = [(50, "small"), (500, "medium"), (5000, "large")]  # else 'enterprise'
SIZE_BAND_OTHER = "enterprise"
ACTIVE_DAYS = 90
LAPSING_DAYS = 365
# Placeholder hashed in place of a NULL key, so the surrogate key itself is never NULL.
NULL_KEY_SENTINEL = "__null_key__"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_key(c) -> Column:
    """Identifiers are carried as strings from Silver on."""
    return _c(c).cast("string")


def money(c) -> Column:
    """EUR amount: decimal(18,2), rounded to cents. A malformed value becomes NULL (``try_cast``)."""
    return F.round(_c(c).try_cast("decimal(18,2)"), 2).cast("decimal(18,2)")


def norm_upper(c) -> Column:
    return F.upper(F.trim(_c(c).cast("string")))


def norm_lower(c) -> Column:
    return F.lower(F.trim(_c(c).cast("string")))


def norm_title(c) -> Column:
    """``initcap(trim(x))``: words break on whitespace only, the rest of each word is lowered."""
    return F.initcap(F.trim(_c(c).cast("string")))


def full_name(first, last) -> Column:
    """NULL when either part is NULL (``concat`` semantics)."""
    return F.concat(norm_title(first), F.lit(" "), norm_title(last))


def size_band(amount) -> Column:
    """Bucket an order amount; NULL falls through to the last band, as the CASE does."""
    a = _c(amount).try_cast("decimal(18,2)")
    expr = None
    for bound, label in SIZE_BAND_BOUNDS:
        expr = F.when(a < bound, label) if expr is None else expr.when(a < bound, label)
    return expr.otherwise(SIZE_BAND_OTHER)


def surrogate_key(*cols) -> Column:
    """Deterministic SHA-256 hex of the key column(s); NULL parts are replaced by a sentinel."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(NULL_KEY_SENTINEL)) for c in cols]
    return F.sha2(parts[0] if len(parts) == 1 else F.concat_ws("-", *parts), 256)


def email_hash(c) -> Column:
    """PII mask: SHA-256 hex of the e-mail; NULL stays NULL."""
    return F.sha2(_c(c), 256)


def customer_status(last_order_at, as_of) -> Column:
    """Recency cascade on timestamps, inclusive bounds: active, lapsing, churned, never_ordered."""
    last = _c(last_order_at)
    now = F.lit(as_of).cast("timestamp")
    return (F.when(last >= now - F.expr(f"INTERVAL {ACTIVE_DAYS} DAYS"), "active")
            .when(last >= now - F.expr(f"INTERVAL {LAPSING_DAYS} DAYS"), "lapsing")
            .when(last.isNotNull(), "churned")
            .otherwise("never_ordered"))


def safe_divide(numerator, denominator) -> Column:
    """NULL when the denominator is 0 or NULL, else the quotient (never raises under ANSI mode)."""
    d = _c(denominator)
    return F.when((d == 0) | d.isNull(), F.lit(None)).otherwise(F.try_divide(_c(numerator), d))


def days_between(start, end) -> Column:
    """Whole calendar days from the date of ``start`` to the date of ``end`` (bigint)."""
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start))).cast("bigint")


def days_since(ts, as_of) -> Column:
    """Days from the date of ``ts`` to the as-of date; NULL in, NULL out."""
    return F.datediff(F.to_date(F.lit(as_of).cast("timestamp")), F.to_date(_c(ts))).cast("bigint")


def rolling_sum(df: DataFrame, measure: str, date_col: str, days: int,
                partition_by: str = "customer_id", alias: str | None = None) -> DataFrame:
    """``sum(measure)`` over a range frame of ``days`` days up to the current row, per key.

    Rows on the same day are peers and share the value (RANGE, not ROWS). To keep a hot key from
    landing in one task with all its rows, the measure is first summed per (key, day) with
    map-side partial aggregation; the window then runs over at most one row per key and day,
    and the result is joined back on (key, day), NULL-safe so NULL days keep their peer value.
    """
    alias = alias or f"{measure}_rolling_{days}d"
    daily = df.groupBy(partition_by, date_col).agg(F.sum(measure).alias("__day_sum"))
    frame = (f"PARTITION BY `{partition_by}` ORDER BY `{date_col}` "
             f"RANGE BETWEEN INTERVAL {int(days)} DAYS PRECEDING AND CURRENT ROW")
    rolled = daily.select(F.col(partition_by).alias("__k"), F.col(date_col).alias("__d"),
                          F.expr(f"sum(__day_sum) OVER ({frame})").alias(alias))
    cond = (df[partition_by].eqNullSafe(rolled["__k"])) & (df[date_col].eqNullSafe(rolled["__d"]))
    return df.join(rolled, cond, "left").drop("__k", "__d")


def window_by(*keys: str) -> Window:
    return Window.partitionBy(*keys)
