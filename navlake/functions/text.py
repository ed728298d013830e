"""Expressions that read one line of feed text."""

from pyspark.sql import Column, functions as F

# Fixed values of the feed formats.
FIELD_SEPARATOR = ";"
COLUMN_TITLE = "Scheme Code"
NAV_TITLE = "net asset value"
DATE_TITLE = "date"
SECTION_START = "Open Ended Schemes"
LABELLED_CODE_PREFIX = "SIF-"
COMPANY_SUFFIX = " mutual fund"

# Characters stripped from both ends of lines and fields, and those that
# end a line beside the \n, \r and \r\n the text source already splits on.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
OTHER_LINE_ENDS = "[\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_DATE = r"^[0-9]{1,2}-[A-Za-z]{3}-(?!0000)[0-9]{4}$"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def strip_line(line: Column) -> Column:
    """As ``strip``; most lines begin and end with a visible ASCII character and pass as they are."""
    return F.when(line.rlike(r"(?s)^[!-~](.*[!-~])?\z"), line).otherwise(strip(line))


def split_lines(text: Column) -> Column:
    """The lines of what the text source takes for one; most have no other line end in them."""
    return F.when(text.rlike(OTHER_LINE_ENDS), F.split(text, OTHER_LINE_ENDS)).otherwise(F.array(text))


def field(parts: Column, at: Column | int) -> Column:
    """A stripped field of a split line; null where the line is too short."""
    return strip(F.get(parts, F.lit(at) if isinstance(at, int) else at))


def title_labels(line: Column) -> Column:
    """The lower-case column labels of a stripped title line."""
    edge = f"[{WHITESPACE}]*"
    return F.split(F.lower(line), f"{edge}{FIELD_SEPARATOR}{edge}")


def feed_number(text: Column) -> Column:
    """A finite double, or null where the text is no plain decimal number."""
    value = text.try_cast("double")
    return F.when(text.rlike(_NUMBER) & (F.abs(value) < float("inf")), value)


def feed_date(text: Column) -> Column:
    """A ``01-Feb-2026`` date (month in any case), or null.

    Cast from its numbers, which takes less time than a date pattern.
    """
    numbers = F.create_map(*[F.lit(x) for i, m in enumerate(_MONTHS, 1) for x in (m, f"-{i}-")])
    month = F.try_element_at(numbers, F.lower(F.substring(text, -8, 3)))
    day = F.concat(F.substring(text, -4, 4), month, F.substring_index(text, "-", 1))
    return F.when(text.rlike(_DATE), day.try_cast("date"))


def feed_date_text(day: Column) -> Column:
    return F.date_format(day, "dd-MMM-yyyy")


def is_digits(text: Column) -> Column:
    return text.rlike("^[0-9]+$")


def is_labelled_code(text: Column) -> Column:
    return F.upper(text).startswith(LABELLED_CODE_PREFIX)


def is_section_header(line: Column) -> Column:
    return line.startswith(SECTION_START) & line.contains("(") & line.contains(")")


def section_category(line: Column) -> Column:
    """Text between the first ``(`` and the last ``)``, without its ``... - `` prefix."""
    inner = strip(F.regexp_extract(line, r"(?s)\((.*)\)", 1))
    return strip(F.regexp_replace(inner, r"(?s)^.*? - ", ""))


def without_company_suffix(lower_name: Column) -> Column:
    return F.regexp_replace(lower_name, f"{COMPANY_SUFFIX}$", "")
