"""Scalar, date and CASE functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fallback_title(primary="category_code", fallback="brand") -> Column:
    """``category_code`` if present, else ``brand``."""
    return F.coalesce(_col(primary), _col(fallback))


def ncf_score(event_type="event_type") -> Column:
    """purchase 2.0, cart 1.0, anything else 0.0."""
    e = _col(event_type)
    return (F.when(e == "purchase", F.lit(2.0)).when(e == "cart", F.lit(1.0))
             .otherwise(F.lit(0.0)))


def engagement_score(event_type="event_type") -> Column:
    """F8: purchase 3, cart 2, view 1, anything else NULL."""
    e = _col(event_type)
    return (F.when(e == "purchase", F.lit(3)).when(e == "cart", F.lit(2))
             .when(e == "view", F.lit(1)))


def to_double(c) -> Column:
    """string → number; malformed text gives NULL (Spark 4 ``cast`` would raise)."""
    return _col(c).try_cast("double")


def to_int(c) -> Column:
    return _col(c).try_cast("int")


def to_double_or_zero(c) -> Column:
    """Cast to double, NULL and malformed become 0."""
    return F.coalesce(_col(c).try_cast("double"), F.lit(0.0))


def event_date(c="event_time") -> Column:
    """timestamp → date."""
    return F.to_date(_col(c))


def parse_date(c, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """parse text with ``fmt`` into a date; bad text gives NULL."""
    return F.try_to_timestamp(_col(c), F.lit(fmt)).cast("date")


def recency_days(c="event_time", as_of=None) -> Column:
    """days from the event to ``as_of`` (default ``current_date()``)."""
    ref = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return F.datediff(ref, F.to_date(_col(c)))


def binarize(c, threshold: float) -> Column:
    """1 if value >= threshold else 0 (NULL stays NULL)."""
    return (_col(c) >= F.lit(threshold)).cast("int")


def round2(c) -> Column:
    """F23."""
    return F.round(_col(c), 2)


def presence(c) -> Column:
    """quantity → {0, 1}."""
    return F.when(_col(c) >= 1, F.lit(1)).otherwise(F.lit(0))


def now() -> Column:
    """F27."""
    return F.current_timestamp()
