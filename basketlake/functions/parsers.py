"""Lenient text parsers as column expressions (JVM side, NULL instead of errors)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a number or a date in an export file.
_NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
_DATE = r"^(\d{1,2})/(\d{1,2})/(\d{4})\s+(\d{1,2}):(\d{1,2})(?::(\d{1,2}))?$"


def parse_float(c: Column) -> Column:
    """Text to double; blank or malformed text becomes NULL."""
    return F.when(c.rlike(_NUMBER), F.trim(c).try_cast("double"))


def parse_int(c: Column, to: str = "int") -> Column:
    """Text to integer, fraction cut toward zero ('17850.0' is 17850).

    Plain digits are cast directly: integers above 2^53 stay exact, and the
    pattern is only tried on the texts that are not plain.
    """
    return F.coalesce(F.trim(c).try_cast(to), parse_float(c).try_cast(to))


def parse_decimal(c: Column, to: str = "decimal(10,2)") -> Column:
    """Text to decimal without a detour through double, rounded half up."""
    return F.when(c.rlike(_NUMBER), F.trim(c).try_cast(to))


def parse_invoice_date(c: Column) -> Column:
    """``M/d/yyyy H:mm`` with optional seconds to a timestamp without zone.

    The parts go through ``try_make_timestamp_ntz``: no session time zone is
    involved, so a wall-clock time inside a DST gap is kept as written. A text is matched once and split once:
    the lambda holds the parts.
    """

    def stamp(parts: Column) -> Column:
        part = lambda i: F.get(parts, F.lit(i)).try_cast("int")
        return F.try_make_timestamp_ntz(part(2), part(0), part(1), part(3), part(4), F.coalesce(part(5), F.lit(0)).cast("decimal(16,6)"))

    return F.when(c.rlike(_DATE), F.transform(F.array(F.split(c, r"[/:\s]+")), stamp)[0])


def strip_excel_eq(c: Column) -> Column:
    """Trim, drop one leading '=', and turn '' and 'nan' into NULL."""
    text = F.trim(F.regexp_replace(F.trim(c), r"^=", ""))
    return F.when((text != "") & (F.lower(text) != "nan"), text)
