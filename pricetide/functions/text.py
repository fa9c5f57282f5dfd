"""Name cleaning, price text and the three name searches."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricetide.functions.numeric import round_half_up
from pricetide.schemas import STORE_LABEL_PREFIX, UNKNOWN_NAME


def clean_name(name: Column, default: str = UNKNOWN_NAME) -> Column:
    """Strip spaces (not tabs); null becomes ``default``, an empty text stays empty."""
    return F.coalesce(F.trim(name), F.lit(default))


def store_label(store_id: Column, store_name: Column, prefix: str = STORE_LABEL_PREFIX) -> Column:
    """Known name, else prefix + id; a deal without a store id has no label."""
    label = F.coalesce(store_name, F.concat(F.lit(prefix), store_id))
    return F.when(store_id.isNotNull() & (store_id != ""), label)


def format_price(value: Column, currency: Column) -> Column:
    """``R$12.30`` for BRL, ``$12.30`` for anything else, an em dash for null."""
    amount = round_half_up(value, 2).cast("decimal(28,2)").cast("string")
    symbol = F.when(currency == "BRL", F.lit("R$")).otherwise(F.lit("$"))
    return F.coalesce(F.concat(symbol, amount), F.lit("—"))


def matches_regex(name: Column, pattern: str) -> Column:
    """Case-insensitive regular expression, beyond ASCII too; a null name does not match."""
    return F.coalesce(name.rlike("(?iu)" + pattern), F.lit(False))


def matches_like(name: Column, text: str) -> Column:
    """Case-insensitive LIKE with ``%`` and ``_`` in the text left live."""
    return name.ilike(f"%{text}%")


def matches_literal(name: Column, text: str) -> Column:
    """Case-insensitive substring, no wildcards."""
    return F.contains(F.lower(name), F.lower(F.lit(text)))


def natural_order(name: Column) -> Column:
    """A text that sorts by the numbers in ``name``: page 2 comes before page 10.

    Every run of digits is padded to 18 of them; of longer ones the last 18 count.
    """
    padded = F.regexp_replace(name, r"(\d+)", "0" * 18 + "$1")
    return F.regexp_replace(padded, r"\d*(\d{18})(?!\d)", "$1")
