"""Missing values, numbers and dates, with NULL as the only missing value."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from headingflow.functions.text import SPACES, literal, quoted

# Strings that a CSV reader takes as missing.
MISSING_STRINGS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def first_non_empty_sql(texts: list[str]) -> str:
    """First text that is not blank, trimmed; ``""`` when there is none."""
    trimmed = ", ".join(f"btrim({t}, {literal(SPACES)})" for t in texts)
    return f"coalesce(get(filter(array({trimmed}), t -> t <> ''), 0), '')"


def first_non_empty(*columns: str) -> Column:
    return F.expr(first_non_empty_sql([quoted(c) for c in columns]))


def number(value: Column, default: float | None = None) -> Column:
    """Double, with NaN and unreadable text as NULL or as the default."""
    parsed = F.nanvl(value.try_cast("double"), F.lit(None).cast("double"))
    return parsed if default is None else F.coalesce(parsed, F.lit(float(default)))


# Patterns of a day, and the replacement that gives year-month-day.
_CLOCK = r"([01]?\d|2[0-3]):[0-5]?\d:[0-5]?\d"
_ISO_CLOCK = r"([01]\d|2[0-3])(:?[0-5]\d(:?[0-5]\d([.,]\d+)?)?)?"
_ISO_ZONE = r"(Z|[+-]([01]\d|2[0-3])(:?[0-5]\d(:?[0-5]\d(\.\d+)?)?)?)?"
_ISO_TAIL = f"(.{_ISO_CLOCK}{_ISO_ZONE})?"
DAY_FORMATS = [
    (r"^(\d{4})([-/])(\d{1,2})\2(\d{1,2})$", "$1-$3-$4"),
    (r"^(\d{1,2})([-/])(\d{1,2})\2(\d{4})$", "$4-$3-$1"),
    (rf"^(\d{{4}})-(\d{{1,2}})-(\d{{1,2}})T{_CLOCK}(\.\d{{1,6}}Z)?$", "$1-$2-$3"),
    (rf"^(\d{{4}})-(\d{{2}})-(\d{{2}}){_ISO_TAIL}$", "$1-$2-$3"),
    (rf"^(\d{{4}})(\d{{2}})(\d{{2}}){_ISO_TAIL}$", "$1-$2-$3"),
]


def parse_day_sql(text: str) -> str:
    """Calendar day written in the text, whatever its time and zone; NULL when unreadable.

    Tried in order: year first with - or /, day first with - or /, date and time
    with an optional fraction and Z, then ISO 8601 in extended or basic form.
    Day first always wins over month first. The text is read as calendar
    fields, so the session time zone has no part in it.
    """
    tries = [
        f"case when d rlike {literal(p)} then try_cast(regexp_replace(d, {literal(p)}, '{ymd}') as date) end"
        for p, ymd in DAY_FORMATS
    ]
    # The one-element array binds the trimmed text, which every format reads.
    return f"transform(array(btrim({text}, {literal(SPACES)})), d -> coalesce({', '.join(tries)}))[0]"


def parse_day(column: str) -> Column:
    return F.expr(parse_day_sql(quoted(column)))
