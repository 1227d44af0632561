"""Column expressions.  All of them are built-in functions, so they stay in codegen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Blanks around a hyphen are not part of a name.
HYPHEN_WITH_BLANKS = r"\s*-\s*"
HYPHEN = "-"
BLANKS = " \t\n\x0b\f\r"  # what the pattern counts as blank


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_key(name: Column | str) -> Column:
    """Comparison key of a raw name: hyphens tightened, trimmed, lower case.

    Accents stay.  The regular expression only runs on names that hold a hyphen and
    an inner blank, as it costs more than the rest together.
    """
    trimmed = F.trim(_column(name))
    blank = reduce(lambda a, b: a | b, [F.contains(trimmed, F.lit(c)) for c in BLANKS])
    tight = F.when(
        F.contains(trimmed, F.lit(HYPHEN)) & blank,
        F.trim(F.regexp_replace(trimmed, HYPHEN_WITH_BLANKS, HYPHEN)),
    ).otherwise(trimmed)
    return F.lower(tight)


def two_digits(number: Column | str) -> Column:
    """``3`` -> ``"03"``; longer values keep their first two characters."""
    return F.lpad(_column(number).cast("string"), 2, "0")


def date_from_parts(year: Column | str, month: Column | str, day: Column | str) -> Column:
    """Date of three numbers; NULL if a part is missing or there is no such day."""
    text = F.concat(
        _column(year).cast("string"), F.lit("-"), two_digits(month), F.lit("-"), two_digits(day)
    )
    return F.try_to_date(text)


def year_from_filename(path: Column | str, pattern: str) -> Column:
    """Year held by the first group of ``pattern``; NULL where the path does not match."""
    found = F.regexp_extract(_column(path), pattern, 1)
    return F.nullif(found, F.lit("")).try_cast("int")


def safe_double(value: Column | str) -> Column:
    """Number of a text; NULL where it is none, with ANSI mode on or off."""
    return _column(value).try_cast("double")
