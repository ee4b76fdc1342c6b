"""Column expressions shared by the plans. All are built-in Spark functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillstream.settings import TopicPlan

MONEY = "decimal(12,2)"
WEATHER = "decimal(8,2)"
RATE = "decimal(18,8)"

# Characters a text strip removes.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def is_blank(text: Column) -> Column:
    """Null, empty or only spaces."""
    return text.isNull() | (F.trim(text) == "")


def text_or(text: Column, default: str) -> Column:
    return F.coalesce(empty_to_null(text), F.lit(default))


def lenient_date(text: Column) -> Column:
    """Date of a text, null where it is none."""
    return text.try_cast("date")


def lenient_timestamp(text: Column) -> Column:
    return F.try_to_timestamp(text)


def topic_of(event_type: Column, topics: TopicPlan) -> Column:
    """Topic of an event type; unknown and missing types go to the default topic."""
    pairs = [F.lit(part) for pair in topics.by_type.items() for part in pair]
    return F.coalesce(F.create_map(*pairs)[F.lower(event_type)], F.lit(topics.default))


def cross_rate(eur_to_usd: Column, eur_to_brl: Column) -> Column:
    """USD per BRL; null when a leg is missing or the divisor is zero."""
    known = eur_to_usd.isNotNull() & eur_to_brl.isNotNull() & (eur_to_brl != 0)
    return F.when(known, eur_to_usd / eur_to_brl)


def order_value(paid: Column, gross: Column, freight: Column) -> Column:
    """Payments if there are any, else goods plus freight, else zero."""
    return F.coalesce(paid, gross + freight, F.lit(0).cast(MONEY))


def share_pct(condition: Column) -> Column:
    """Percentage of rows meeting ``condition``; a null condition counts as not met."""
    return F.avg(F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))) * 100


def count_of(condition: Column) -> Column:
    """Rows meeting ``condition``, zero on empty input."""
    return F.coalesce(F.count_if(condition), F.lit(0))


def period_start(unit: str, day: Column) -> Column:
    """First day of the ``day``, ``week`` (from Monday) or ``month``."""
    return F.trunc(day, unit) if unit != "day" else day.cast("date")


def batch_id(prefix: str, at: Column) -> Column:
    return F.concat(F.lit(f"{prefix}-"), F.date_format(at, "yyyyMMdd'T'HHmmss"))


def padded_id(prefix: str, width: int, number: Column) -> Column:
    return F.format_string(f"{prefix}-%0{width}d", number)
