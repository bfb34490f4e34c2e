"""Lenient timestamp parsing and calendar parts, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two forms found in the raw file.
FRACTION = "yyyy-MM-dd HH:mm:ss.SSSSSSSSS"
WHOLE_SECOND = "yyyy-MM-dd HH:mm:ss"

# Shapes of a date in mixed text, and the order of its parts: Y is four digits, n one or two, m a month's name.
# Where n/n/Y starts with more than a month, the day comes first.
DATE_SHAPES = {
    "Y-n-n": "ymd",
    "Y/n/n": "ymd",
    "n/n/Y": "mdy",
    "n-n-Y": "mdy",
    "n.n.Y": "dmy",
    "n m Y": "dmy",
    "n-m-Y": "dmy",
    "m n, Y": "mdy",
    "m n Y": "mdy",
}
MONTHS = (
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
)

# Sunday is day 1.
WEEKDAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")

_STRICT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,9})?\z"
_SIGNED = r"^[+-][0-9]"
# Date, hour, minute, second, fraction, half of the day, offset.
_PARTS = (
    r"^([0-9A-Za-z][0-9A-Za-z,./ -]*?)"
    r"(?:(?: |(?<=[0-9])T(?=[0-9]))([0-9]{1,2}):([0-9]{2})(?::([0-9]{2})(?:\.([0-9]{1,9}))?)?(?: ?([AaPp])[Mm])?"
    r"(?: ?(Z|[+-][0-9]{2}:?[0-9]{2}))?|(?<=[0-9])Z)?\z"
)
_ISO = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,9})?)?)?\z"


def _column(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def parse_timestamp(column: str | Column, *, zoned: bool = False) -> Column:
    """Text in either raw form to a timestamp, anything else to null.

    Gives what ``coalesce(try_to_timestamp(FRACTION), try_to_timestamp(WHOLE_SECOND))``
    gives.  Each text is parsed once: a pattern test picks the well-formed ones
    for the plain cast, so junk costs no exception.  Only years written with a
    sign reach the formatter, apart from the row's other columns: the parses of a wide row
    in one generated method would make it too long to be compiled.  Fraction digits past the sixth are cut off.

    The recorded time is wall-clock time, so the default type carries no zone
    and no session setting can shift it; ``zoned=True`` gives ``timestamp``.
    """
    text = _column(column)
    kind = "timestamp" if zoned else "timestamp_ntz"

    def signed(text: Column) -> Column:
        return F.when(
            F.contains(text, F.lit(".")), F.try_to_timestamp(text, F.lit(FRACTION))
        ).otherwise(F.try_to_timestamp(text, F.lit(WHOLE_SECOND)))

    return F.when(text.rlike(_STRICT), text.try_cast(kind)).when(
        text.rlike(_SIGNED), _let(text, signed).cast(kind)
    )


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, also where only a branch needs it."""
    return F.transform(F.array(value), use)[0]


def parse_timestamp_mixed(column: str | Column, *, utc: bool = False) -> Column:
    """Wider lenient parse, by shape: a text is cut into its parts once, and its date's shape tells their order.

    Taken are ISO texts, the ``DATE_SHAPES``, and dates of eight digits, each alone or with a 24-hour or 12-hour time;
    names of months are English, short or full, in any case.  Texts are trimmed, and T or a blank stands between date and time.  An
    offset (``Z``, ``+05:00``, ``-0330``) may follow a time: the clock time stands, or with ``utc`` what UTC clocks
    showed.  Anything else, and dates that do not exist, become null.  ISO texts without offset take the plain cast.
    """
    text = F.trim(_column(column))
    cells = F.split(F.regexp_replace(text, _PARTS, "$1|$2|$3|$4|$5|$6|$7"), r"\|")
    other = F.when(text.rlike(_PARTS), _let(cells, lambda c: _moment(c, utc)))
    return F.when(text.rlike(_ISO), text.try_cast("timestamp_ntz")).otherwise(other)


def _moment(cells: Column, utc: bool) -> Column:
    """The time that date, hour, minute, second, fraction, half and offset say, as texts; empty where there is none."""
    date = F.regexp_replace(cells[0], r"^([0-9]{4})([0-9]{2})([0-9]{2})\z", "$1-$2-$3")
    shape = F.regexp_replace(date, "[A-Za-z]+", "m")
    shape = F.regexp_replace(shape, "(?<![0-9])[0-9]{4}(?![0-9])", "Y")
    shape = F.regexp_replace(shape, "(?<![0-9])[0-9]{1,2}(?![0-9])", "n")
    orders = F.create_map(*[F.lit(x) for pair in DATE_SHAPES.items() for x in pair])
    number = lambda text: text.try_cast("int")
    half = F.lower(cells[5])
    hour = F.coalesce(number(cells[1]), F.lit(0))
    hour = F.when(half == "", hour).when(hour.between(1, 12), hour % 12 + F.when(half == "p", 12).otherwise(0))
    second = F.concat(F.coalesce(F.nullif(cells[3], F.lit("")), F.lit("0")), F.lit("."), F.rpad(F.substring(cells[4], 1, 6), 6, "0"))
    second = second.try_cast("decimal(8,6)")

    def made(known: Column) -> Column:
        parts, order = known["parts"], known["order"]
        # The month is more than twelve: the day-first reading of n/n/Y.
        swapped = (known["shape"] == "n/n/Y") & (number(parts[0]) > 12)
        order = F.when(swapped, F.lit("dmy")).otherwise(order)
        part = lambda letter: F.try_element_at(parts, F.instr(order, F.lit(letter)))
        name = F.lower(part("m"))
        names = F.create_map(*[F.lit(x) for i, m in enumerate(MONTHS) for k in dict.fromkeys((m, m[:3])) for x in (k, i + 1)])
        month = F.when(known["shape"].contains("m"), F.try_element_at(names, name)).otherwise(number(name))
        return F.when(
            second < 60,
            F.try_make_timestamp_ntz(number(part("y")), month, number(part("d")), hour, F.coalesce(number(cells[2]), F.lit(0)), second),
        )

    known = F.struct(
        F.split(date, "[^0-9A-Za-z]+").alias("parts"), shape.alias("shape"), F.try_element_at(orders, shape).alias("order")
    )
    moment = _let(known, lambda k: F.when(k["order"].isNotNull(), made(k)))
    if not utc:
        return moment
    offset = cells[6]
    minutes = number(F.substring(offset, 2, 2)) * 60 + number(F.right(offset, F.lit(2)))
    minutes = F.when(offset.isin("", "Z"), 0).when(F.left(offset, F.lit(1)) == "-", -minutes).otherwise(minutes)
    return moment - F.make_dt_interval(mins=minutes)


def weekday_name(number: str | Column) -> Column:
    """English weekday name of a day number, Sunday = 1."""
    return F.element_at(F.array(*[F.lit(day) for day in WEEKDAYS]), _column(number))


def time_parts(column: str | Column) -> dict[str, Column]:
    """Year, Month, Weekday, Weekday_Number and Hour of a timestamp."""
    moment = _column(column)
    return {
        "Year": F.year(moment),
        "Month": F.month(moment),
        "Weekday": weekday_name(F.dayofweek(moment)),
        "Weekday_Number": F.dayofweek(moment),
        "Hour": F.hour(moment),
    }


def timestamp_text(column: str | Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, with six fraction digits when there is a fraction."""
    text = _column(column).cast("string")
    return F.when(F.contains(text, F.lit(".")), F.rpad(text, 26, "0")).otherwise(text)
