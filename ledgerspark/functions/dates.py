"""FN6 ``format_movement_date``: movement timestamps rendered ``dd/MM/yyyy HH:mm``.

Text input is stripped and parsed day-first (``d/M/yyyy[ H:mm[:ss]]``), month-first
where the second number can only be a day (``01/13/2024``), then as ISO
(``yyyy-MM-dd[ HH:mm[:ss]]``); anything else, or an impossible date, is null
instead of aborting the run (``intake_report`` counts those). Parsing and formatting
work on the wall-clock fields of ``TIMESTAMP_NTZ`` values, so the session time zone
never shifts a value (no daylight-saving gaps). Both paths are native expressions: one
test and one split of the text per layout.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.functions.keys import strip_text

# Accepted input layouts and the output layout.
CLOCK = r"(?:[ T]\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?)?$"
DAY_FIRST = r"^\d{1,2}/\d{1,2}/\d{4}" + CLOCK
ISO = r"^\d{4}-\d{1,2}-\d{1,2}" + CLOCK
OUTPUT_FORMAT = "dd/MM/yyyy HH:mm"


def parse_movement_timestamp(c: Column | str) -> Column:
    """Lenient day-first parse of a text timestamp -> TIMESTAMP_NTZ (null if unparseable)."""
    c = F.col(c) if isinstance(c, str) else c
    text = strip_text(c.cast("string"))
    parts = F.split(text, "[^0-9]+")

    def number(i: int) -> Column:
        return F.coalesce(F.get(parts, F.lit(i)).try_cast("int"), F.lit(0))

    clock = [number(3), number(4), number(5)]
    first, second = number(0), number(1)
    swapped = (second > 12) & (first <= 12)
    day, month = F.when(swapped, second).otherwise(first), F.when(swapped, first).otherwise(second)
    return (F.when(F.regexp_like(text, F.lit(DAY_FIRST)), F.try_make_timestamp_ntz(number(2), month, day, *clock))
            .when(F.regexp_like(text, F.lit(ISO)), F.try_make_timestamp_ntz(first, second, number(2), *clock)))


def render_timestamp(ts: Column) -> Column:
    """``dd/MM/yyyy HH:mm`` from the wall-clock fields (no time-zone conversion)."""
    def two(c: Column) -> Column:
        return F.lpad(c.cast("string"), 2, "0")

    return F.concat(two(F.dayofmonth(ts)), F.lit("/"), two(F.month(ts)), F.lit("/"),
                    F.lpad(F.year(ts).cast("string"), 4, "0"), F.lit(" "),
                    two(F.hour(ts)), F.lit(":"), two(F.minute(ts)))


def format_movement_date(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """Render a movement timestamp (timestamp or text column) as ``dd/MM/yyyy HH:mm``."""
    c = F.col(c) if isinstance(c, str) else c
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return render_timestamp(c)
    return render_timestamp(parse_movement_timestamp(c))
