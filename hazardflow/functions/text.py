"""Number and time text, and lenient parsing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def fixed_decimals(value: Column, digits: int) -> Column:
    """``%.nf`` text, rounded on the exact binary value with ties to even.

    ``format_string`` would round the shortest decimal form half up, so 6.35
    and 6.25 would both come out one tenth too high.
    """
    return F.translate(F.format_number(value, digits), ",", "")


def location_text(lat: Column, lon: Column) -> Column:
    return F.concat_ws(",", fixed_decimals(lat, 4), fixed_decimals(lon, 4))


def parse_iso(text: Column) -> Column:
    """ISO-8601 date or date-time, ``Z`` or offset allowed; anything else is NULL."""
    trimmed = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}($|[T ])"), text)
    return F.try_to_timestamp(trimmed)


def parse_epoch_millis(millis: Column) -> Column:
    """Epoch milliseconds to timestamp; NULL and 0 mean "no time"."""
    return F.when(millis != 0, F.timestamp_millis(millis))


def elapsed_text(since: Column, as_of: Column) -> Column:
    """'5 minutes ago' style text, in the largest whole unit."""
    minutes = F.floor((F.unix_timestamp(as_of) - F.unix_timestamp(since)) / 60)
    expr = F
    for bound, per_unit, unit in ((60, 1, "minutes"), (1440, 60, "hours")):
        count = F.floor(minutes / per_unit).cast("bigint").cast("string")
        expr = expr.when(minutes < bound, F.concat(count, F.lit(f" {unit} ago")))
    return expr.otherwise(
        F.concat(F.floor(minutes / 1440).cast("bigint").cast("string"), F.lit(" days ago"))
    )
