"""Column expressions that turn raw cell text into values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell texts that mean "no value".
NULL_TEXTS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# The white space removed around a cell.
BLANKS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# What a number looks like. A bare cast would also take 72d, 72f and 0x1p3.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
INFINITE = r"^[+-]?(?i:inf(inity)?)$"

# Texts that mean "yes".
TRUE_TEXTS = ("true", "1")


def null_texts(cell: Column) -> Column:
    """Null for the texts that mean "no value", else the cell as it is."""
    return F.when(~cell.isin(*NULL_TEXTS), cell)


def strip(cell: Column) -> Column:
    return F.btrim(cell, F.lit(BLANKS))


def number(cell: Column, digits: Column | None = None) -> Column:
    """The text as a double, null when it is no number. The result is never NaN.

    0 and whole numbers of up to four digits, nearly every cell, are told without looking at the characters:
    a text of n bytes that reads as a number of n digits is nothing but digits. Of the others, plain decimals
    are told by their characters and cast as they are. Only other texts are stripped and matched.
    ``digits`` is the cell as a BIGINT where a frame holds it already; it is read twice here, so a column of its own saves a cast.
    """
    digits, size = cell.try_cast("bigint") if digits is None else digits, F.octet_length(cell)
    least = F.when(size == 3, 100).when(size == 2, 10).when(size == 1, 0).when(size == 4, 1000)
    plain = F.length(F.translate(cell, "0123456789.", "")) == 0
    text = strip(cell)
    other = F.when(text.rlike(f"{NUMBER}|{INFINITE}"), text.try_cast("double"))
    usual = F.when(cell == "0", F.lit(0.0)).when(digits >= least, digits.cast("double"))
    return usual.when(plain, cell.try_cast("double")).otherwise(other)


def whole(value: Column) -> Column:
    """The double as a BIGINT, null when it is not whole or does not fit."""
    cut = value.try_cast("bigint")
    return F.when(cut == value, cut)


def truth(cell: Column) -> Column:
    """True for a yes text, false for all else, also for null."""
    return F.coalesce(F.lower(cell.cast("string")).isin(*TRUE_TEXTS), F.lit(False))
