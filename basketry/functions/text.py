"""Text and number formatting as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The published text formats and label limits.
ITEM_SEPARATOR = ", "
REPORT_SEPARATOR = " + "
RULE_ARROW = " -> "
STRONG_CONFIDENCE = 0.70
USEFUL_LIFT = 1.00
# Every character a text strip removes at both ends, beyond the plain blank.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(col: Column) -> Column:
    """Remove all leading and trailing Unicode whitespace (``trim`` only knows the blank)."""
    return F.btrim(col, F.lit(WHITESPACE))


def to_number(col: Column, is_text: bool = True) -> Column:
    """Lenient number: null for anything that is not one.

    Java also reads ``1d`` and ``NaN``; neither is a number in a retail file, so both become null.
    """
    number = F.nanvl(col.try_cast("double"), F.lit(None).cast("double"))
    if not is_text:
        return number
    suffix = F.lower(F.right(F.rtrim(col), F.lit(1)))
    return F.when(~suffix.isin("d", "f"), number)


def itemset_text(items: Column, separator: str = ITEM_SEPARATOR) -> Column:
    return F.array_join(F.sort_array(items.cast("array<string>")), separator)


def rule_text(antecedent: Column, consequent: Column, separator: str = ITEM_SEPARATOR) -> Column:
    return F.concat(
        itemset_text(antecedent, separator), F.lit(RULE_ARROW), itemset_text(consequent, separator)
    )


def safe_double(col: Column) -> Column:
    return F.coalesce(col.try_cast("double"), F.lit(0.0))


def safe_count(col: Column) -> Column:
    return F.nanvl(safe_double(col), F.lit(0.0)).cast("long")


def fixed(col: Column, digits: int) -> Column:
    """``digits`` decimals as C prints them: the binary value decides ties, no thousands separator.

    Exact for values whose scaled size stays below 2^52; beyond, doubles have no decimals to settle and the
    shortest decimal text is filled with zeros. Infinity is ``inf``, no number ``nan``.
    """
    x, scale = F.abs(safe_double(col)), float(10**digits)
    product = x * scale
    # what the product lost in rounding, exactly: both factors are split in halves of 26 bits
    split = x * 134217729.0
    high = split - (split - x)
    low = x - high
    scale_high = scale * 134217729.0 - (scale * 134217729.0 - scale)
    lost = ((high * scale_high - product) + high * (scale - scale_high) + low * scale_high) + low * (
        scale - scale_high
    )
    whole = F.rint(product)
    beside = product - whole
    whole = F.when((beside == 0.5) & (lost > 0), whole + 1).when((beside == -0.5) & (lost < 0), whole - 1).otherwise(whole)
    number = F.when(product < float(1 << 52), whole.cast("decimal(38,0)").cast("string"))
    number = F.lpad(number, F.greatest(F.length(number), F.lit(digits + 1)), F.lit("0"))
    text = F.concat(F.substring(number, F.lit(1), F.length(number) - digits), F.lit("." if digits else ""), F.right(number, F.lit(digits)))
    large = F.call_function("format_number", x, F.lit("0." + "0" * digits if digits else "0"))
    sign = F.when(safe_double(col).cast("string").startswith("-"), "-").otherwise("")
    number = F.when(x == float("inf"), "inf").otherwise(F.coalesce(text, large))
    return F.when(F.isnan(x), "nan").otherwise(F.concat(sign, number))


def percent(col: Column) -> Column:
    return F.concat(fixed(safe_double(col) * 100, 2), F.lit("%"))


def fixed_with_percent(col: Column, digits: int = 4) -> Column:
    return F.concat(fixed(col, digits), F.lit(" ("), percent(col), F.lit(")"))


def interpretation(confidence: Column, lift: Column) -> Column:
    strength = F.when(safe_double(confidence) >= STRONG_CONFIDENCE, "strong").otherwise("weak")
    usefulness = F.when(safe_double(lift) > USEFUL_LIFT, "useful").otherwise("unuseful")
    return F.concat(strength, F.lit(REPORT_SEPARATOR), usefulness)


def levels_text(per_level: Column) -> Column:
    """``MAP<level, sets>`` as ``L1=33, L2=1,204``."""
    entries = F.sort_array(F.map_entries(per_level))
    parts = F.transform(
        entries,
        lambda e: F.concat(F.lit("L"), e["key"], F.lit("="), F.format_number(e["value"], 0)),
    )
    return F.array_join(parts, ITEM_SEPARATOR)
