"""Cleaning of dirty text columns.

Every conversion is a ``try_cast``: text that is not a value becomes NULL and the job goes
on, also under ANSI mode. Text is cleaned first and cast second.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


# Currency signs, and what else stands around a number.
_SIGNS = "$¢£¥฿₩₪₫€₱₹₺₽%, \t\r\n"


def parse_decimal_comma(col: Column, precision: int = 3, scale: int = 2) -> Column:
    """``"4,2"`` -> 4.20; anything that is no number, or does not fit, -> NULL."""
    return F.replace(col, F.lit(","), F.lit(".")).try_cast(f"decimal({precision},{scale})")


def parse_count(col: Column) -> Column:
    """``"24,269"`` -> 24269 and ``"4.0"`` -> 4: in a count the comma groups thousands, and a part is no count."""
    return F.regexp_replace(F.replace(col, F.lit(","), F.lit("")), r"\.0*$", "").try_cast("bigint")


def _digits_and_dot(col: Column) -> Column:
    return F.nullif(F.regexp_replace(col, "[^0-9.]", ""), F.lit(""))


def parse_money(col: Column, precision: int = 10, scale: int = 2) -> Column:
    """Currency text -> decimal: everything but digits and the dot is dropped, blank -> NULL.

    That drops signs and exponents too, as amounts of the facts are defined; ``parse_number`` keeps them.
    """
    return _digits_and_dot(col).try_cast(f"decimal({precision},{scale})")


def parse_number(col: Column) -> Column:
    """``"-₹1,234.50"`` -> -1234.5, ``"5%"`` -> 5.0, ``"1.5E3"`` -> 1500.0; what is no number then -> NULL.

    Currency signs, percent signs, thousands commas and spaces are taken off; sign and exponent count.
    """
    bare = F.translate(col, _SIGNS, "")
    return F.when(~bare.rlike("[^0-9.eE+-]"), bare.try_cast("double"))


def numeric_or_null(col: Column) -> Column:
    """Text as a double when the whole of it is digits and dots, else NULL; numbers as they are."""
    text = col.cast("string")
    read = F.when(text.rlike("^[0-9.]+$"), text.try_cast("double"))
    return F.when(F.typeof(col) == "string", read).otherwise(col.try_cast("double"))


def is_blank(col: Column) -> Column:
    """True for text of spaces only; NULL stays NULL."""
    return F.trim(col) == ""


def pct(part: Column, whole: Column, digits: int | None = 2) -> Column:
    """``100 * part / whole``, rounded when ``digits`` is given; NULL when there is no whole."""
    share = F.when(whole != 0, F.lit(100.0) * part / whole)
    return share if digits is None else F.round(share, digits)


def default_text(col: Column, default: str = "N/A") -> Column:
    return F.coalesce(col, F.lit(default))
