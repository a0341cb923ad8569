"""Market-basket analytics on Spark DataFrames."""

from basketry.functions.thresholds import absolute_support
from basketry.operators.baskets import build_baskets, encode_baskets, item_counts, presence, transactions
from basketry.operators.clean import clean_lines
from basketry.operators.itemsets import mine_itemsets
from basketry.operators.rules import generate_rules, label_rules, library_rules, query_rules
from basketry.plans.sweep import sweep
from basketry.session import create_session

__all__ = [
    "absolute_support",
    "build_baskets",
    "clean_lines",
    "create_session",
    "encode_baskets",
    "generate_rules",
    "item_counts",
    "label_rules",
    "library_rules",
    "mine_itemsets",
    "presence",
    "query_rules",
    "sweep",
    "transactions",
]
