"""Wall-clock text, instants and their renderings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.schemas import MARKET_ZONE

DATE_FORMAT = "dd-MM-yyyy"
LOCAL_FORMAT = "dd-MM-yyyy HH:mm:ss[.SSSSSSSSS]"
ISO_LOCAL_FORMAT = "yyyy-MM-dd'T'HH:mm[:ss[.SSSSSSSSS]]"
ISO_ZONED = r"(Z|[+-]\d{2}:?\d{2})$"


def date_text(text: Column) -> Column:
    """``dd-MM-yyyy`` text as a DATE; a day 29-31 past the month's end means its last day."""
    exact = F.to_date(F.try_to_timestamp(text, F.lit(DATE_FORMAT)))
    first = F.to_date(F.try_to_timestamp(F.concat(F.lit("01-"), F.substring(text, 4, 10)), F.lit(DATE_FORMAT)))
    clamped = F.when(text.rlike(r"^(29|30|31)-\d{2}-\d{4}$"), F.last_day(first))
    return F.coalesce(exact, clamped)


def parse_local(date: Column, time: Column) -> Column:
    """Wall-clock TIMESTAMP from date and time text, NULL when unparseable.

    The fraction has 0-9 digits (kept to the microsecond). ``24:00:00`` is the
    next midnight. The rare forms cost nothing on rows the plain pattern reads.
    """
    plain = F.try_to_timestamp(F.concat_ws(" ", date, time), F.lit(LOCAL_FORMAT))
    day = F.date_format(date_text(date), "dd-MM-yyyy")
    midnight = time.rlike(r"^24:00:00(\.0*)?$")
    clock = F.when(midnight, F.lit("00:00:00")).otherwise(time)
    rare = F.try_to_timestamp(F.concat_ws(" ", day, clock), F.lit(LOCAL_FORMAT))
    shifted = F.when(midnight, rare + F.expr("INTERVAL 1 DAY")).otherwise(rare)
    return F.coalesce(plain, F.when(day.isNotNull(), shifted))


def local_to_instant(local: Column, zone: str = MARKET_ZONE) -> Column:
    """Wall clock in ``zone`` → instant (earlier offset in overlaps, gaps shift forward)."""
    return F.to_utc_timestamp(local, zone)


def event_instant(text: Column, zone: str = MARKET_ZONE) -> Column:
    """ISO text → instant: text with an offset is absolute, text without is wall clock in ``zone``."""
    local = F.try_to_timestamp(text, F.lit(ISO_LOCAL_FORMAT))
    return F.when(text.rlike(ISO_ZONED), text.try_cast("timestamp")).otherwise(local_to_instant(local, zone))


def iso_local(local: Column) -> Column:
    """Wall-clock TIMESTAMP → ISO text with three to six fraction digits."""
    full = F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.regexp_replace(full, r"(\.\d{3}\d*?)0+$", "$1")


def wall_clock(instant: Column, pattern: str = "yyyy-MM-dd'T'HH:mm:ss.SSS", zone: str = MARKET_ZONE) -> Column:
    """Instant → wall-clock text in ``zone``, millisecond precision by default."""
    return F.date_format(F.from_utc_timestamp(instant, zone), pattern)


def epoch_millis(instant: Column) -> Column:
    return F.unix_millis(instant)
