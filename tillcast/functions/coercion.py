"""Column expressions that turn raw text into typed values. Bad input gives NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as white space, as a number, and the representable dates (yyyymmdd).
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
BLANKS = f"[{WHITESPACE}]*+"
NUMBER_PATTERN = rf"^{BLANKS}([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?){BLANKS}$"
DIGITS_PATTERN = rf"^{BLANKS}([+-]?\d{{1,19}}){BLANKS}$"
PART_PATTERN = rf"^{BLANKS}(\d{{1,4}})(?:\.0*)?{BLANKS}$"
FIRST_DAY_NUMBER, LAST_DAY_NUMBER = 16770922, 22620411

LARGEST = 1.7976931348623157e308
LARGEST_LONG = 9.2e18


def trimmed(text: Column) -> Column:
    """Without white space at both ends; the slow search for rare blanks is left to texts that still end in one or in another odd character."""
    bare = F.trim(text)
    plain = F.substring(bare, 1, 1).between("!", "~") & F.substring(bare, -1, 1).between("!", "~")
    return F.when(plain, bare).otherwise(F.btrim(text, F.lit(WHITESPACE)))


def parsed_number(text: Column) -> Column:
    """Double of a decimal number text (infinite when too large), else NULL; reads the text once, blanks around it too."""
    return F.regexp_extract(text, NUMBER_PATTERN, 1).try_cast("double")


def finite(value: Column) -> Column:
    return F.when(F.abs(value) <= LARGEST, value)


def whole(value: Column) -> Column:
    """BIGINT of a double without fraction, else NULL."""
    return F.when((value == F.floor(value)) & (F.abs(value) < LARGEST_LONG), value.try_cast("bigint"))


def truncated(value: Column) -> Column:
    """BIGINT cut toward zero; 0 when there is no usable number."""
    return F.when(F.abs(value) < LARGEST_LONG, value.try_cast("bigint")).otherwise(F.lit(0).cast("bigint"))


def finite_number(text: Column) -> Column:
    """Double, or NULL when the text is not a finite decimal number."""
    return finite(parsed_number(text))


def plain_whole(text: Column) -> Column:
    """BIGINT of a text of digits only, which is exact; NULL for all else. Other texts reach the cast as empty ones."""
    return F.regexp_extract(text, DIGITS_PATTERN, 1).try_cast("bigint")


def whole_number(text: Column) -> Column:
    """BIGINT, or NULL when the text is not a whole number."""
    return F.coalesce(plain_whole(text), whole(parsed_number(text)))


def truncated_or_zero(text: Column) -> Column:
    return truncated(parsed_number(text))


def date_part(text: Column) -> Column:
    """INT of up to four digits, also written like ``2018.0``; reads the text once."""
    return F.regexp_extract(text, PART_PATTERN, 1).try_cast("int")


def date_of_parts(year: Column, month: Column, day: Column) -> Column:
    """DATE from INT parts; NULL for impossible dates and those outside the representable range.

    The range also bounds the length of any dense calendar built later.
    """
    text = F.concat_ws("-", year.cast("string"), month.cast("string"), day.cast("string"))
    in_range = (year * 10000 + month * 100 + day).between(FIRST_DAY_NUMBER, LAST_DAY_NUMBER)
    return F.when(in_range & month.between(1, 12) & day.between(1, 31), text.try_cast("date"))


def calendar_date(year: Column, month: Column, day: Column) -> Column:
    """DATE from text parts."""
    return date_of_parts(date_part(year), date_part(month), date_part(day))


def letter_prefix(invoice: Column) -> Column:
    return F.regexp_extract(invoice, "^[A-Za-z]*", 0)


def after_prefix(invoice: Column) -> Column:
    return F.substr(invoice, F.length(letter_prefix(invoice)) + 1)


def slug(name: Column) -> Column:
    return F.replace(F.lower(name), F.lit(" "), F.lit("_"))


def lookup_key(name: Column) -> Column:
    return F.lower(trimmed(name))
