"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.text import itemset_text, levels_text
from basketry.functions.thresholds import absolute_support
from basketry.operators import baskets as bk
from basketry.operators import candidates as cd
from basketry.operators import itemsets as its
from basketry.operators import rules as rl
from basketry.operators import ruletable as rt
from basketry.operators import topn
from basketry.operators.clean import clean_lines, kept_lines
from basketry.plans import sweep as sw
from basketry.plans import tables as tb
from basketry.plans.summary import summary_metrics
from basketry.session import new_table_path
from basketry.sources import files
from basketry.sources.columns import require_columns
from workloads import views

Query = Callable[[SparkSession, str], DataFrame]

TYPE, BRAND, NAME = "StockCode", "Brand", "Description"
# columns of the wide presence matrix
TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
MODE_RATIOS = (0.05, 0.02, 0.01, 0.005, 0.002)
SWEEP = (0.005, 0.01, 0.02, 0.03, 0.05)
SWEEP_SIX = (0.005, 0.01, 0.02, 0.03, 0.05, 0.1)
CUSTOMER_SWEEP = (0.05, 0.2, 0.5, 0.9, 0.99)


def _lines(spark, sf_dir, profile="A", item=None) -> DataFrame:
    return clean_lines(views.invoice_lines(spark, sf_dir), profile, item_col=item)


def _tx(spark, sf_dir, profile="A", item=None) -> bk.Transactions:
    return bk.transactions(_lines(spark, sf_dir, profile, item))


def _mine(tx: bk.Transactions, ratio, mode="ceil", max_k=10) -> its.MiningResult:
    result = its.mine_itemsets(tx, absolute_support(tx.n, ratio, mode), max_k)
    tx.release()
    return result


def _mined(spark, sf_dir, ratio, profile="A", item=TYPE, mode="ceil", max_k=10) -> its.MiningResult:
    return _mine(_tx(spark, sf_dir, profile, item), ratio, mode, max_k)


def _mined_view(view, ratio, max_k=10) -> Callable:
    return lambda spark, sf_dir: _mine(bk.transactions(view(spark, sf_dir)), ratio, "ceil", max_k)


def _flat(itemsets: DataFrame) -> DataFrame:
    return itemsets.select("k", "itemset_text", "count", "support")


# --- cleaning, sources, baskets -------------------------------------------------------------------


def _clean(profile: str) -> Query:
    return lambda spark, sf_dir: clean_lines(
        views.invoice_lines(spark, sf_dir), profile, item_col=TYPE
    )


def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines written as CSV, read back as text, checked, cleaned."""
    lines = views.invoice_lines(spark, sf_dir)
    path = new_table_path(spark)
    lines.write.option("header", True).csv(path)
    text = files.read_lines(spark, path, columns=lines.columns, recursive=True)
    require_columns(text, ["InvoiceNo", "StockCode", "Quantity"])
    return clean_lines(text, "A")


def csv_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as CSV in a folder for each brand; the first file below is read and cleaned."""
    path = new_table_path(spark)
    lines = views.invoice_lines(spark, sf_dir).withColumn("folder", F.regexp_replace("Brand", "[^A-Za-z0-9]", "_"))
    lines.repartition("folder").write.option("header", True).partitionBy("folder").csv(path)
    text = files.read_lines(spark, files.first_csv(spark, path))
    return clean_lines(require_columns(text, ["InvoiceNo", "StockCode", "Quantity"]), "A")


def parquet_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_table_path(spark)
    files.write_parquet(views.invoice_lines(spark, sf_dir), path)
    return files.read_lines(spark, path, fmt="parquet")


def dataset_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = views.invoice_lines(spark, sf_dir)
    size = files.profile(lines)
    counts = bk.dataset_counts(clean_lines(lines, "A", item_col=TYPE))
    stack = "stack({n}, {pairs}) AS (metric, value)"

    def tall(df):
        pairs = ", ".join(f"'{c}', {c}" for c in df.columns)
        return df.selectExpr(stack.format(n=len(df.columns), pairs=pairs))

    return tall(size).unionByName(tall(counts))


def baskets_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bk.build_baskets(_lines(spark, sf_dir, item=TYPE)).select(
        "basket_id",
        itemset_text(F.col("items")).alias("items_text"),
        F.size("items").alias("n_items"),
    )


def presence_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bk.presence(_lines(spark, sf_dir, item=TYPE))


def presence_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir, item=TYPE)
    return bk.presence_matrix(lines, TYPES)


def presence_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The non-zeros of the sparse vectors, by name."""
    return bk.presence_vectors(_lines(spark, sf_dir, item=BRAND)).entries()


def threshold_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = bk.dataset_counts(_lines(spark, sf_dir, item=TYPE))
    return sw.threshold_modes(counts, MODE_RATIOS, ("ceil", "floor", "ratio"))


def item_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = _tx(spark, sf_dir, item=BRAND)
    counts = bk.item_counts(tx).filter(F.col("count") >= absolute_support(tx.n, 0.01))
    return bk.item_dictionary(counts)[0].select("id", "item", "count")


def encoded_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines to ids and back: the presence rows of the frequent items."""
    tx = _tx(spark, sf_dir, item=NAME)
    enough = F.col("count") >= absolute_support(tx.n, 0.05)
    dictionary, *_ = bk.item_dictionary(bk.item_counts(tx).filter(enough))
    ids = bk.encode_items(tx.presence, dictionary)
    return ids.join(dictionary, "id").select("basket_id", "item")


# --- levels ---------------------------------------------------------------------------------------


def _items(spark, sf_dir):
    tx = _tx(spark, sf_dir, item=NAME)
    return its.item_levels(tx, absolute_support(tx.n, 0.05))


def c1_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _items(spark, sf_dir)[0].select("itemset_text", "count", "support")


def l1_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _items(spark, sf_dir)[1].select("itemset_text", "count", "support")


def l1_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _items(spark, sf_dir)[2].select("itemset_text", "count")


def _encoded(spark, sf_dir, ratio, item=BRAND) -> bk.EncodedBaskets:
    tx = _tx(spark, sf_dir, item=item)
    return bk.encode_baskets(tx, absolute_support(tx.n, ratio))


def c2_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c2, _, _ = its.pair_level(_encoded(spark, sf_dir, 0.01))
    return c2.select("itemset_text", "count", "support")


def c2_absent_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2 with the pairs that never occur."""
    named = views.invoice_lines(spark, sf_dir).withColumn("Product", F.concat_ws(" ", "Brand", "StockCode"))
    tx = bk.transactions(clean_lines(named, "A", item_col="Product"))
    c2, _, _ = its.pair_level(bk.encode_baskets(tx, absolute_support(tx.n, 0.0002)), absent=True)
    return c2.select("itemset_text", "count", "support")


def l2_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, l2, _ = its.pair_level(_encoded(spark, sf_dir, 0.01))
    return l2.select("itemset_text", "count", "support")


def candidates_k3(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = _encoded(spark, sf_dir, 0.01)
    pairs = its.pair_level(encoded)[2]
    triples = cd.join_candidates(pairs, 3).select(F.array(*cd.positions(3)).alias("items"))
    decoded = bk.decode_itemsets(triples, encoded.dictionary, encoded.name_bytes)
    return decoded.select(itemset_text(F.col("itemset")).alias("itemset_text"))


def _triples(spark, sf_dir, ratio, level) -> DataFrame:
    encoded = _encoded(spark, sf_dir, ratio)
    return level(encoded, its.pair_level(encoded)[2])


def c3_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _triples(spark, sf_dir, 0.01, its.overlap_level).select("itemset_text", "count", "support")


def l3_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _triples(spark, sf_dir, 0.002, its.triple_level).select("itemset_text", "count", "support")


def _frequent(ratio, profile="A", item=TYPE, mode="ceil", max_k=10) -> Query:
    return lambda spark, sf_dir: _flat(
        _mined(spark, sf_dir, ratio, profile, item, mode, max_k).itemsets
    )


def level_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return its.level_funnel(_mined(spark, sf_dir, 0.01))


def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return its.run_totals(_mined(spark, sf_dir, 0.01)).select("max_k", "total_freq", "per_k_text")


# --- rules ----------------------------------------------------------------------------------------

_RULE = ("antecedent_text", "consequent_text", "rule", "support", "confidence", "lift")


def _type_rules(spark, sf_dir, levels=None, min_confidence=None) -> DataFrame:
    return rl.generate_rules(_mined(spark, sf_dir, 0.01).itemsets, levels, min_confidence)


def rules_l3(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = rl.unique_rules(_type_rules(spark, sf_dir, levels=(3,)))
    return rl.sort_rules(rules).select(*_RULE)


def rules_l2_l3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _type_rules(spark, sf_dir, levels=(2, 3)).select("k", *_RULE)


def rules_min_conf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _type_rules(spark, sf_dir, min_confidence=0.3).select(*_RULE)


_customers = _mined_view(views.customer_baskets, 0.05)
_users = _mined_view(views.user_events, 0.05)


def rules_extended(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rl.library_rules(_customers(spark, sf_dir).itemsets, min_confidence=0.3)


def _labelled(mine) -> Query:
    def run(spark, sf_dir):
        rules = rl.label_rules(rl.generate_rules(mine(spark, sf_dir).itemsets))
        return rules.select("rule", "confidence", "lift", "interpretation")

    return run


def query_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = rl.library_rules(_mined(spark, sf_dir, 0.01).itemsets, min_confidence=0.3)
    return rl.query_rules(rules, min_confidence=0.3, min_lift=0.9, keyword=" Promo ", limit=20)


def query_rules_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Other columns, rising sort on a metric that is not shown by default."""
    rules = rl.library_rules(_customers(spark, sf_dir).itemsets, min_confidence=0.3)
    columns = ["antecedents", "consequents", "consequent support", "leverage", "zhangs_metric", "none"]
    return rl.query_rules(
        rules, 0.9, 1.0, columns=columns, sort_by="leverage", descending=False, limit=15
    )


def query_rules_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same browser call over a stored rule table."""
    path = new_table_path(spark)
    rt.write_rule_table(_mined(spark, sf_dir, 0.01).itemsets, path, min_confidence=0.3)
    return rt.query_rule_table(spark, path, min_confidence=0.3, min_lift=0.9, keyword=" Promo ", limit=20)


def alias_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result tables under the other names that are accepted: a level, and rules whose sides are X and Y."""
    mined = _mined(spark, sf_dir, 0.01).itemsets
    level = mined.select(F.col("itemset").alias("Itemset"), F.col("count").alias("frequency"), F.col("support").alias("Support"))
    rules = rl.generate_rules(mined, levels=(2,)).select(
        F.col("antecedent").alias("X"),
        F.col("consequent").alias("Y"),
        # the plural names come after the short ones in a summary
        F.lit("unused").alias("antecedents"),
        F.lit("unused").alias("consequents"),
        "support",
        "confidence",
        "lift",
    )
    summary = tb.rule_summary_table(rules).select(
        F.col("Rule").alias("name"), F.lit(None).cast("long").alias("count"), F.col("support_pct").alias("support")
    )
    shown = tb.c1_table(level).select(F.col("Itemset").alias("name"), F.col("Count").alias("count"), F.col("Support").alias("support"))
    return shown.unionByName(summary)


# --- sweep ----------------------------------------------------------------------------------------


def _swept(tx: bk.Transactions, ratios) -> sw.Sweep:
    result = sw.sweep(tx, ratios, mode="floor", max_k=3)
    tx.release()
    return result


def _sweep(spark, sf_dir, ratios=SWEEP) -> sw.Sweep:
    return _swept(_tx(spark, sf_dir, "B", TYPE), ratios)


def _customer_sweep(spark, sf_dir) -> sw.Sweep:
    return _swept(bk.transactions(views.customer_baskets(spark, sf_dir)), CUSTOMER_SWEEP)


def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sw.sweep_summary(_sweep(spark, sf_dir))


def timed_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each published ratio mined on its own; the seconds differ from run to run and are left out."""
    runs = sw.time_thresholds(_tx(spark, sf_dir, item=TYPE), max_k=10)
    return runs.withColumn("per_k_text", levels_text(F.col("per_k"))).drop(
        "execution_time_sec", "per_k"
    )


def slowest_and_fastest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over a fixed execution table: the number of sets of a threshold stands for its seconds."""
    counts = sw.sweep_summary(_sweep(spark, sf_dir))
    total = (F.col("l1_count") + F.col("l2_count") + F.col("l3_count")).cast("double")
    return sw.slowest_and_fastest(counts.withColumn("execution_time_sec", total))


def first_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sw.first_thresholds(sw.sweep_summary(_sweep(spark, sf_dir, SWEEP_SIX)))


def sweep_itemsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sweep(spark, sf_dir).itemsets.select(
        "min_support", "abs_support_count", "k", "itemset_text", "count", "support"
    )


def correlated_itemsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sw.correlated_itemsets(_sweep(spark, sf_dir))


def valuable_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per threshold; no rule of this view is valuable, so the best rules stand in."""
    return sw.valuable_rules(sw.sweep_rules(_sweep(spark, sf_dir))).drop("list_pos")


def valuable_rules_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sw.valuable_rules(sw.sweep_rules(_customer_sweep(spark, sf_dir))).drop("list_pos")


def best_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = sw.sweep_rules(_customer_sweep(spark, sf_dir))
    return sw.best_threshold(sw.valuable_rules(rules)).select("min_support", "n_rules")


def best_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sw.best_rules(sw.valuable_rules(sw.sweep_rules(_customer_sweep(spark, sf_dir))))


# --- top-n and tables -----------------------------------------------------------------------------


def top_itemsets_per_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topn.top_itemsets_per_level(_mined(spark, sf_dir, 0.01).itemsets)


def top_itemsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(topn.top_itemsets(_mined(spark, sf_dir, 0.01).itemsets))


def top_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topn.top_rules(_type_rules(spark, sf_dir)).select(*_RULE)


def top_rules_by_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = rl.library_rules(_mined(spark, sf_dir, 0.01).itemsets, min_confidence=0.3)
    return topn.top_rules_by_confidence(rules).select(*rl.BROWSER_COLUMNS)


def top_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    c1, _, _ = _items(spark, sf_dir)
    return topn.top_itemsets(c1, by="count").select("itemset_text", "count", "support")


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = views.invoice_lines(spark, sf_dir)
    kept = kept_lines(raw, "C", item_col=TYPE)
    lines = clean_lines(raw, "C", item_col=TYPE)
    mined = _mine(bk.transactions(lines), 0.02, "ratio", None).itemsets
    return summary_metrics(kept, lines, mined, rl.library_rules(mined, min_confidence=0.3))


def table_c1(spark, sf_dir):
    return tb.c1_table(_items(spark, sf_dir)[0].drop("itemset_text"))


def table_c1_shown(spark, sf_dir):
    return topn.display_rows(tb.c1_table(_items(spark, sf_dir)[0]), topn.DISPLAY_ROWS)


def table_l1_dropped(spark, sf_dir):
    return tb.l1_dropped_table(_items(spark, sf_dir)[2])


def table_c2(spark, sf_dir):
    return tb.c2_table(its.pair_level(_encoded(spark, sf_dir, 0.01))[0])


def table_l2(spark, sf_dir):
    return tb.frequent_table(its.pair_level(_encoded(spark, sf_dir, 0.01))[1])


def table_c3(spark, sf_dir):
    return tb.c3_table(_triples(spark, sf_dir, 0.01, its.overlap_level))


def table_l3(spark, sf_dir):
    return tb.frequent_table(_triples(spark, sf_dir, 0.002, its.triple_level))


def table_rules_l3(spark, sf_dir):
    return tb.rules_table(rl.sort_rules(_type_rules(spark, sf_dir, levels=(3,))))


def table_rule_summary(spark, sf_dir):
    rules = rl.generate_rules(_customers(spark, sf_dir).itemsets, levels=(3,))
    return tb.rule_summary_table(rl.sort_rules(rules))


def table_execution_summary(spark, sf_dir):
    return tb.execution_table(sw.sweep_summary(_sweep(spark, sf_dir)))


def report_execution(spark, sf_dir):
    return tb.execution_detail_table(sw.sweep_summary(_sweep(spark, sf_dir)))


def report_top_rules(spark, sf_dir):
    return tb.top_rules_table(topn.top_rules(_type_rules(spark, sf_dir)))


def report_top_items(spark, sf_dir):
    c1, _, _ = _items(spark, sf_dir)
    return tb.top_items_table(topn.top_itemsets(c1, by="count"))


def report_correlated(spark, sf_dir):
    return tb.correlated_table(sw.correlated_itemsets(_sweep(spark, sf_dir)))


def report_valuable_rules(spark, sf_dir):
    return tb.valuable_table(best_rules(spark, sf_dir))


def report_itemsets(spark, sf_dir):
    mined = _mined(spark, sf_dir, 0.01).itemsets
    return tb.itemset_report(topn.top_itemsets_per_level(mined))


QUERIES: dict[str, Query] = {
    "clean_a": _clean("A"),
    "clean_b": _clean("B"),
    "clean_c": _clean("C"),
    "csv_ingest": csv_ingest,
    "csv_first": csv_first,
    "parquet_copy": parquet_copy,
    "dataset_profile": dataset_profile,
    "baskets_text": baskets_text,
    "presence_long": presence_long,
    "presence_matrix": presence_matrix,
    "presence_vectors": presence_vectors,
    "threshold_modes": threshold_modes,
    "item_dictionary": item_dictionary,
    "encoded_round_trip": encoded_round_trip,
    "c1_items": c1_items,
    "l1_items": l1_items,
    "l1_dropped": l1_dropped,
    "c2_pairs": c2_pairs,
    "c2_absent_pairs": c2_absent_pairs,
    "l2_pairs": l2_pairs,
    "candidates_k3": candidates_k3,
    "c3_triples": c3_triples,
    "l3_triples": l3_triples,
    "frequent_itemsets": _frequent(0.01),
    "frequent_itemsets_deep": _frequent(0.002),
    "frequent_itemsets_brand": _frequent(0.002, item=BRAND),
    "frequent_itemsets_profile_b": _frequent(0.01, "B"),
    "frequent_itemsets_floor": _frequent(0.01, item=BRAND, mode="floor"),
    "frequent_itemsets_maxk2": _frequent(0.002, item=BRAND, max_k=2),
    "itemsets_ratio_mode": _frequent(0.02, "C", mode="ratio", max_k=None),
    "itemsets_customers": lambda spark, sf_dir: _flat(_customers(spark, sf_dir).itemsets),
    "itemsets_customer_products": lambda spark, sf_dir: _flat(
        _mined_view(views.customer_products, 0.02, max_k=3)(spark, sf_dir).itemsets
    ),
    "itemsets_users": lambda spark, sf_dir: _flat(_users(spark, sf_dir).itemsets),
    "itemsets_user_days": lambda spark, sf_dir: _flat(
        _mined_view(views.user_day_events, 0.01)(spark, sf_dir).itemsets
    ),
    "level_funnel": level_funnel,
    "run_totals": run_totals,
    "rules_l3": rules_l3,
    "rules_l2_l3": rules_l2_l3,
    "rules_min_conf": rules_min_conf,
    "rules_extended": rules_extended,
    "rules_labelled": _labelled(_customers),
    "rules_labelled_users": _labelled(_users),
    "query_rules": query_rules,
    "query_rules_columns": query_rules_columns,
    "query_rules_stored": query_rules_stored,
    "alias_lookup": alias_lookup,
    "threshold_sweep": threshold_sweep,
    "first_thresholds": first_thresholds,
    "timed_thresholds": timed_thresholds,
    "slowest_and_fastest": slowest_and_fastest,
    "sweep_itemsets": sweep_itemsets,
    "correlated_itemsets": correlated_itemsets,
    "valuable_rules": valuable_rules,
    "valuable_rules_customers": valuable_rules_customers,
    "best_threshold": best_threshold,
    "best_rules": best_rules,
    "top_itemsets_per_level": top_itemsets_per_level,
    "top_itemsets": top_itemsets,
    "top_rules": top_rules,
    "top_rules_by_confidence": top_rules_by_confidence,
    "top_items": top_items,
    "summary_metrics": summary,
    "table_c1": table_c1,
    "table_c1_shown": table_c1_shown,
    "table_l1_dropped": table_l1_dropped,
    "table_c2": table_c2,
    "table_l2": table_l2,
    "table_c3": table_c3,
    "table_l3": table_l3,
    "table_rules_l3": table_rules_l3,
    "table_rule_summary": table_rule_summary,
    "table_execution_summary": table_execution_summary,
    "report_execution": report_execution,
    "report_top_rules": report_top_rules,
    "report_top_items": report_top_items,
    "report_correlated": report_correlated,
    "report_valuable_rules": report_valuable_rules,
    "report_itemsets": report_itemsets,
}
