"""Association rules and what is read off them.

Operation order is part of the result: support is ``count / n``, confidence ``support / support_x`` and
lift ``confidence / support_y``. Other orders shift the last bit, which decides ``lift > 1``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.text import (
    ITEM_SEPARATOR,
    STRONG_CONFIDENCE,
    USEFUL_LIFT,
    interpretation,
    itemset_text,
    rule_text,
)
from basketry.session import materialize, materialize_counted

# Default columns of the rule browser, and what it shows when none of the chosen exist.
BROWSER_COLUMNS = ("antecedents", "consequents", "support", "confidence", "lift")
BROWSER_FALLBACK = ("antecedents", "consequents", "confidence")


# Sets of up to so many items are split in all ways (62 for six); of longer ones consequents grow while they may pass.
SPLIT_WHOLE = 6
# Copies of the table of known sides for sides of one and two items, which a best seller shares among very many rules.
SIDE_COPIES = 16


def _side(bit: int) -> Column:
    """Items whose bit of the mask, from the first item on, is ``bit``."""
    return F.expr(f"filter(itemset, (item, i) -> (shiftright(mask, i) & 1) = {bit})")


def _known(itemsets: DataFrame, name: str) -> DataFrame:
    """Supports by the 64-bit key of a set and a copy number; single items and pairs stand there ``SIDE_COPIES`` times."""
    copies = F.when(F.col("k") <= 2, SIDE_COPIES).otherwise(1)
    return itemsets.filter(F.col("support") > 0).select(
        F.xxhash64("itemset").alias(f"{name}_key"),
        F.explode(F.sequence(F.lit(0), copies - 1)).alias(f"{name}_copy"),
        F.col("itemset").alias(f"{name}_set"),
        F.col("support").alias(f"{name}_support"),
    )


def _look_up(splits: DataFrame, itemsets: DataFrame, name: str) -> DataFrame:
    """Join the support of side ``name``: on 64 bits and a copy number, then the sets themselves are compared."""
    copy = F.when(F.size(name) <= 2, F.pmod(F.xxhash64("itemset", "mask"), F.lit(SIDE_COPIES))).otherwise(0)
    asked = splits.withColumns({f"{name}_key": F.xxhash64(name), f"{name}_copy": copy.cast("int")})
    found = asked.join(_known(itemsets, name), [f"{name}_key", f"{name}_copy"])
    # not a plain equality, which would become a join key
    found = found.filter(F.coalesce(F.col(name) == F.col(f"{name}_set"), F.lit(False)))
    return found.drop(f"{name}_key", f"{name}_copy", f"{name}_set")


def _grown_splits(whole: DataFrame, itemsets: DataFrame, min_confidence: float) -> DataFrame:
    """Splits of long sets that reach the confidence, consequents growing item by item.

    A larger consequent of the same set has a smaller antecedent, hence no higher confidence: once one fails, all that
    contain it fail. Masks mark the antecedent's items; a consequent grows from two that differ in their highest item.
    """
    numbered = materialize(whole.withColumn("number", F.monotonically_increasing_id()))
    all_bits = F.expr("shiftleft(1L, size(itemset)) - 1")
    tried = numbered.select("*", F.expr("explode(sequence(0, size(itemset) - 1))").alias("top"))
    tried = tried.select("*", F.expr("shiftleft(1L, top)").alias("out")).withColumn("rest", F.lit(0).cast("long"))
    passed, levels = None, []
    while True:
        splits = tried.withColumn("mask", all_bits - F.col("out")).filter("mask > 0").withColumn("antecedent", _side(1))
        confident = _look_up(splits, itemsets, "antecedent").filter(F.col("support") / F.col("antecedent_support") >= min_confidence)
        passed, n = materialize_counted(confident)
        if not n:
            break
        levels.append(passed)
        # rest: the consequent without its highest item
        other = passed.select("number", "rest", F.col("top").alias("other"))
        tried = (
            passed.drop("antecedent", "antecedent_support", "mask")
            .join(other, ["number", "rest"])
            .filter("top < other")
            .withColumns({"rest": F.col("out"), "out": F.expr("out | shiftleft(1L, other)"), "top": F.col("other")})
            .drop("other")
        )
    columns = [*whole.columns, "mask", "antecedent", "antecedent_support"]
    if not levels:
        return passed.select(*columns)
    return reduce(DataFrame.unionByName, levels).select(*columns)


def generate_rules(
    itemsets: DataFrame,
    levels: Sequence[int] | None = None,
    min_confidence: float | None = None,
    separator: str = ITEM_SEPARATOR,
) -> DataFrame:
    """Splits of frequent sets into antecedent and consequent, with their metrics: all, or those that reach a confidence.

    ``itemsets`` is the complete table of a mining run: each side of a rule is itself frequent, so the
    two lookups lose nothing. Sides are compared as arrays, never as text, but shuffled by a 64-bit key. With a threshold,
    long sets are not split in all their ways: see :func:`_grown_splits`.
    """
    whole = itemsets.filter(F.col("k") >= 2).select("k", "itemset", "count", "support")
    if levels is not None:
        whole = whole.filter(F.col("k").isin(list(levels)))
    grow = min_confidence is not None and min_confidence > 0
    short = whole.filter(F.col("k") <= SPLIT_WHOLE) if grow else whole
    # bit i of the mask puts item i on the left; all zeros and all ones are no rules
    masks = F.expr("explode(sequence(1L, shiftleft(1L, size(itemset)) - 2))").alias("mask")
    splits = short.select("*", masks).withColumn("antecedent", _side(1))
    rules = _look_up(splits, itemsets, "antecedent")
    if grow:
        rules = rules.filter(F.col("support") / F.col("antecedent_support") >= min_confidence)
        long = whole.filter(F.col("k") > SPLIT_WHOLE)
        if not long.isEmpty():
            rules = rules.unionByName(_grown_splits(long, itemsets, min_confidence))
    rules = _look_up(rules.withColumn("consequent", _side(0)), itemsets, "consequent")
    rules = rules.withColumn("confidence", F.col("support") / F.col("antecedent_support")).withColumn(
        "lift", F.col("confidence") / F.col("consequent_support")
    )
    if min_confidence is not None:
        rules = rules.filter(F.col("confidence") >= min_confidence)
    return rules.select(
        "k",
        "antecedent",
        "consequent",
        itemset_text(F.col("antecedent"), separator).alias("antecedent_text"),
        itemset_text(F.col("consequent"), separator).alias("consequent_text"),
        rule_text(F.col("antecedent"), F.col("consequent"), separator).alias("rule"),
        "count",
        "antecedent_support",
        "consequent_support",
        "support",
        "confidence",
        "lift",
    )


def unique_rules(rules: DataFrame) -> DataFrame:
    return rules.dropDuplicates(["antecedent", "consequent"])


def rank_order() -> list[Column]:
    """Best first; the rule text settles ties."""
    return [F.desc("confidence"), F.desc("lift"), F.desc("support"), F.asc("rule")]


def sort_rules(rules: DataFrame) -> DataFrame:
    return rules.orderBy(*rank_order())


def label_rules(rules: DataFrame) -> DataFrame:
    return rules.withColumn("interpretation", interpretation(F.col("confidence"), F.col("lift")))


def extended_metrics(rules: DataFrame) -> DataFrame:
    """Add the further interest measures of the common rule libraries."""
    s, a, c = F.col("support"), F.col("antecedent_support"), F.col("consequent_support")
    confidence = F.col("confidence")
    leverage = s - a * c
    spread = F.greatest(s * (1 - a), a * (c - s))
    return (
        rules.withColumn("representativity", F.lit(1.0))
        .withColumn("leverage", leverage)
        .withColumn(
            "conviction",
            F.when(confidence < 1.0, F.try_divide(1 - c, 1 - confidence)).otherwise(F.lit(float("inf"))),
        )
        .withColumn("zhangs_metric", F.when(spread == 0, 0.0).otherwise(F.try_divide(leverage, spread)))
        .withColumn("jaccard", s / (a + c - s))
        .withColumn("certainty", F.when(c == 1.0, 0.0).otherwise(F.try_divide(confidence - c, 1 - c)))
        .withColumn("kulczynski", (s / a + s / c) / 2)
    )


def library_names(rules: DataFrame, *others: str) -> DataFrame:
    """Rules under the column names of the common rule libraries, and ``others`` as they are."""
    return rules.select(
        F.col("antecedent_text").alias("antecedents"),
        F.col("consequent_text").alias("consequents"),
        F.col("antecedent_support").alias("antecedent support"),
        F.col("consequent_support").alias("consequent support"),
        "support",
        "confidence",
        "lift",
        "representativity",
        "leverage",
        "conviction",
        "zhangs_metric",
        "jaccard",
        "certainty",
        "kulczynski",
        *others,
    )


def library_rules(itemsets: DataFrame, min_confidence: float = 0.3) -> DataFrame:
    """Rules of all levels above a confidence, under the column names of the common rule libraries."""
    return library_names(extended_metrics(generate_rules(itemsets, min_confidence=min_confidence)))


def query_rules(
    rules: DataFrame,
    min_confidence: float = 0.30,
    min_lift: float = 1.0,
    keyword: str = "",
    columns: Sequence[str] | None = None,
    sort_by: str = "confidence",
    descending: bool = True,
    limit: int | None = 20,
) -> DataFrame:
    """The rule browser as a query over :func:`library_rules`.

    The keyword is literal and case-blind and may occur on either side. Unknown columns are left out;
    ties in the sort column are settled by the rule itself. An unknown sort column means the default order,
    confidence from high to low, and a limit of ``None`` all rules: their number beside that of a limited
    call is what a browser shows as shown and total.
    """
    view = rules.filter((F.col("confidence") >= min_confidence) & (F.col("lift") >= min_lift))
    term = keyword.strip().lower()
    if term:
        view = view.filter(
            F.lower("antecedents").contains(term) | F.lower("consequents").contains(term)
        )
    if sort_by not in rules.columns:
        sort_by, descending = "confidence", True
    key = F.col(f"`{sort_by}`")
    view = view.orderBy(key.desc() if descending else key.asc(), F.asc("antecedents"), F.asc("consequents"))
    chosen = [c for c in (columns or BROWSER_COLUMNS) if c in rules.columns] or list(BROWSER_FALLBACK)
    if limit is not None:
        view = view.limit(limit)
    return view.select(*[F.col(f"`{c}`") for c in chosen])


def is_valuable() -> Column:
    return (F.col("confidence") >= STRONG_CONFIDENCE) & (F.col("lift") > USEFUL_LIFT)
