"""Transaction lines to ``(basket_id, item)``, under three published rule sets.

They differ on purpose and are not averaged away:

========  =============================  ============================  =======================
profile   item                           quantity kept                 cancelled invoices
========  =============================  ============================  =======================
A         stock code as it is            > 0, or missing               dropped, text as it is
B         stock code, whitespace cut     > 0                           dropped after the cut
C         description as it is           > 0                           kept unless quantity ≤ 0
========  =============================  ============================  =======================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.text import strip, to_number
from basketry.sources.columns import require_columns

# The default columns of a retail file and the mark of a cancelled invoice.
BASKET_COLUMN = "InvoiceNo"
QUANTITY_COLUMN = "Quantity"
ITEM_COLUMNS = {"A": "StockCode", "B": "StockCode", "C": "Description"}
CANCELLED_PREFIX = "C"
NULL_BASKET_TEXT = "nan"


def _rules(
    lines: DataFrame, profile: str, basket_col: str, item_col: str | None, qty_col: str, null_basket: str
) -> tuple[Column, Column, Column]:
    """Which lines a profile keeps, and its basket and item."""
    if profile not in ITEM_COLUMNS:
        raise ValueError(f"unknown profile {profile!r}: expected one of A, B, C")
    if null_basket not in ("drop", "nan"):
        raise ValueError(f"unknown null_basket {null_basket!r}: expected drop or nan")
    item_col = item_col or ITEM_COLUMNS[profile]
    require_columns(lines, [basket_col, item_col, qty_col])

    basket = F.col(basket_col).cast("string")
    item = F.col(item_col).cast("string")
    raw_quantity = F.col(qty_col)
    quantity = to_number(raw_quantity, isinstance(lines.schema[qty_col].dataType, T.StringType))
    cancelled = F.startswith(basket, F.lit(CANCELLED_PREFIX))

    if profile == "A":
        keep = ((quantity > 0) | raw_quantity.isNull()) & ~cancelled
    elif profile == "B":
        item = strip(F.coalesce(item, F.lit("")))
        if null_basket == "nan":
            basket = F.coalesce(basket, F.lit(NULL_BASKET_TEXT))
        basket = strip(basket)
        cancelled = F.startswith(basket, F.lit(CANCELLED_PREFIX))
        keep = (F.coalesce(quantity, F.lit(0.0)) > 0) & (item != "") & ~cancelled
    else:
        keep = quantity > 0
    return keep & item.isNotNull() & basket.isNotNull(), basket, item


def kept_lines(
    lines: DataFrame,
    profile: str = "A",
    basket_col: str = BASKET_COLUMN,
    item_col: str | None = None,
    qty_col: str = QUANTITY_COLUMN,
    null_basket: str = "drop",
) -> DataFrame:
    """The lines a profile keeps, with all their columns as they are."""
    keep, _, _ = _rules(lines, profile, basket_col, item_col, qty_col, null_basket)
    return lines.filter(keep)


def clean_lines(
    lines: DataFrame,
    profile: str = "A",
    basket_col: str = BASKET_COLUMN,
    item_col: str | None = None,
    qty_col: str = QUANTITY_COLUMN,
    null_basket: str = "drop",
) -> DataFrame:
    """Filter and project to ``(basket_id, item)``; one scan, no shuffle, all inside code generation.

    ``null_basket="nan"`` keeps lines without an invoice in profile B as one basket called ``nan``.
    """
    keep, basket, item = _rules(lines, profile, basket_col, item_col, qty_col, null_basket)
    return lines.filter(keep).select(basket.alias("basket_id"), item.alias("item"))
