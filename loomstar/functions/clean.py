"""Scalar cleaning rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values.
MASK = "***Masked***"
RUPEE = "₹"
THOUSANDS = ","
NUMBER_PATTERN = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf(inity)?))\s*$"
# All characters that count as white space at the ends of a text.
BLANKS = (
    "\t\n\u000b\u000c\r\u001c\u001d\u001e\u001f \u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# Runs of cased letters, and everything between them.
TITLE_RUNS = r"([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_text(c: Column | str, *tokens: str) -> Column:
    """Remove literal tokens from text."""
    out = _col(c)
    for token in tokens:
        out = F.replace(out, F.lit(token), F.lit(""))
    return out


def strip_thousands(c: Column | str) -> Column:
    return strip_text(c, THOUSANDS)


def currency(c: Column | str, symbol: str = RUPEE, strict: bool = True) -> Column:
    """Currency text to double. ``strict`` fails the job on bad text, else bad text becomes null."""
    bare = strip_text(_col(c).cast("string"), symbol, THOUSANDS)
    return bare.cast("double") if strict else bare.try_cast("double")


def to_number(c: Column | str) -> Column:
    """Text or number to double, null where it is not a number (``5d`` is not one, though Java says so)."""
    text = _col(c).cast("string")
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def to_whole(c: Column | str) -> Column:
    """Text or number to bigint, null where it is not a whole number; ``8.0`` and ``1e3`` are whole."""
    number = to_number(c)
    return F.coalesce(
        _col(c).cast("string").try_cast("bigint"),
        F.when(number == F.floor(number), number.try_cast("bigint")),
    )


def to_day(c: Column | str, strict: bool = True) -> Column:
    """Date part of a date, a timestamp or ISO text."""
    return _col(c).cast("date") if strict else _col(c).try_cast("date")


def month_of(c: Column | str) -> Column:
    return F.month(_col(c))


def year_of(c: Column | str) -> Column:
    return F.year(_col(c))


def days_before(batch_date: str, n: int) -> Column:
    return F.date_sub(F.lit(batch_date).cast("date"), n)


def day_after(c: Column | str, n: int = 1) -> Column:
    return F.date_add(to_day(c), n)


def capitalize(c: Column | str) -> Column:
    """First letter to title case, all others lower: ``McADAM x`` becomes ``Mcadam x``."""
    text = _col(c)
    return F.concat(F.initcap(F.substring(text, 1, 1)), F.lower(F.substr(text, F.lit(2))))


def title_case(c: Column | str) -> Column:
    """Upper-case the first letter of every run of letters: ``o'neil-smith`` becomes ``O'Neil-Smith``."""
    runs = F.regexp_extract_all(_col(c), F.lit(TITLE_RUNS), F.lit(1))
    return F.array_join(F.transform(runs, lambda run: F.initcap(run)), "")


def strip(c: Column | str) -> Column:
    """Text without white space of any kind at its ends."""
    return F.trim(_col(c), F.lit(BLANKS))


def masked() -> Column:
    return F.lit(MASK)


def round_to_int(c: Column | str) -> Column:
    """A fractional number stored in an integer column: half away from zero, not cut off."""
    return F.round(_col(c)).cast("int")


def fill(c: Column | str, value) -> Column:
    return F.coalesce(_col(c), F.lit(value))


def nan_to_null(c: Column | str) -> Column:
    return F.when(~F.isnan(_col(c)), _col(c))


def pieces(c: Column | str, sep: str = ",", trim: bool = False) -> Column:
    """Delimited text to an array; ``sep`` is literal and null text stays null."""
    # A single plain character is split without a regular expression.
    pattern = sep if len(sep) == 1 and (sep.isalnum() or sep in ",;:/ \t\n") else rf"\Q{sep}\E"
    parts = F.split(_col(c).cast("string"), pattern)
    return F.transform(parts, lambda part: strip(part)) if trim else parts
