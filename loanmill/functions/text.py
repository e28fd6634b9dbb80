"""Text clean-up and text-to-type coercion that yields NULL instead of failing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters the source system treats as white space, and the accepted text forms.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
INFINITY_FORM = r"^[+-]?inf(inity)?$"
# Usual forms: text that is one of these has nothing to strip and is read by the cast alone.
USUAL_NUMBER = r"^[+-]?[0-9]+([.][0-9]*)?(E-?[0-9]+)?\z"
USUAL_INTEGER = r"^[0-9]{1,9}\z"
USUAL_MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2})?)?\z"
FRACTION_FORM = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}[.][0-9]{1,9}$"


def _printable(code: Column) -> Column:
    return code.between(33, 126)


def strip(c: Column) -> Column:
    """Trim every kind of white space. Text that is plain ASCII at both ends after dropping blanks, which is
    nearly all of it, skips the slow search through the full character list."""
    short = F.trim(c)
    plain = _printable(F.ascii(short)) & _printable(F.ascii(F.substring(short, -1, 1)))
    return F.when(plain, short).otherwise(F.btrim(c, F.lit(WHITE_SPACE)))


def given(value: Column, body) -> Column:
    """`body(value)` with the value worked out once per row, however often the body looks at it: a lambda's argument
    is not replaced by its definition, as a projected column may be."""
    return F.transform(F.array(value), body)[0]


def is_blank(c: Column) -> Column:
    """True for NULL and for white space only; never NULL."""
    blank = F.btrim(c, F.lit(WHITE_SPACE)) == ""
    for begin in (F.ascii(F.trim(c)), F.ascii(c)):  # the second, which most text passes, is looked at first
        blank = F.when(_printable(begin), F.lit(False)).otherwise(blank)
    return F.coalesce(blank, F.lit(True))


def blank_to_null(c: Column) -> Column:
    return F.when(~is_blank(c), c)


def undecorated(c: Column) -> Column:
    """Drop `$` and `,`."""
    return F.when(c.contains(",") | c.contains("$"), F.translate(c, ",$", "")).otherwise(c)


def _usual_or(c: Column, form: str, kind: str, body) -> Column:
    """Text of the usual form by a cast alone, any other text by `body`, which is worked out for such rows only."""
    return F.when(c.rlike(form), c.try_cast(kind)).when(c != "", body)


def parse_number(c: Column) -> Column:
    """Number text with optional `$` and `,`; other text, including NaN and type suffixes, is NULL."""
    return _usual_or(c, USUAL_NUMBER, "double", given(strip(undecorated(c)), number_of))


def parse_integer(c: Column) -> Column:
    return _usual_or(c, USUAL_INTEGER, "int", given(strip(c), integer_of))


def parse_timestamp(c: Column) -> Column:
    return _usual_or(c, USUAL_MOMENT, "timestamp_ntz", given(strip(c), timestamp_of))


def _char(c: Column, position: int) -> Column:
    return F.substring(c, position, 1)


def _ends_in_digit(c: Column) -> Column:
    return F.ascii(_char(c, -1)).between(48, 57)


def number_of(text: Column) -> Column:
    """Decimal number text with optional sign, fraction and exponent.

    The checks before the cast keep out what the JVM would also read as a number (`1.0d`, `NaN`, hexadecimal)
    and most of what it would raise on; they cost a fraction of a pattern match.
    """
    first, last = F.ascii(text), F.ascii(_char(text, -1))
    starts = first.between(48, 57) | first.isin(43, 45, 46)  # digit + - .
    ends = last.between(48, 57) | (last == 46)
    decimal = starts & ends & ~text.contains("x") & ~text.contains("X")
    infinite = F.when(first == 45, F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    spelled = (last.isin(70, 89, 102, 121)) & F.lower(text).rlike(INFINITY_FORM)  # ends in f or y
    return F.when(decimal, text.try_cast("double")).when(spelled, infinite)


def integer_of(text: Column) -> Column:
    """Whole-number text (`360`, `360.0`); fractions and everything else are NULL."""
    number = number_of(text)
    return F.when((number == F.rint(number)) & (F.abs(number) < F.lit(2.0**31)), number.try_cast("int"))


def timestamp_of(text: Column) -> Column:
    """ISO date or date-time text without zone (minutes, seconds or fractions of them); impossible days and
    other forms are NULL.

    With the separators in place and a digit at the end, the cast itself rejects whatever else is wrong;
    only text with a fraction needs a pattern.
    """
    size = F.length(text)
    dated = (_char(text, 5) == "-") & (_char(text, 8) == "-") & _ends_in_digit(text)
    timed = _char(text, 11).isin(" ", "T") & (_char(text, 14) == ":")
    well_formed = (
        F.when(size == 10, dated)
        .when(size == 16, dated & timed)
        .when(size == 19, dated & timed & (_char(text, 17) == ":"))
        .when(size > 19, text.rlike(FRACTION_FORM))
    )
    return F.when(well_formed, text.try_cast("timestamp_ntz"))
