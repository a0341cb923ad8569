"""SQL for each registered query: brute force over whole tables, written without the engine's shortcuts.

Every subset of every basket is counted by plain self-joins; thresholds, rules and rankings follow from
that. Floating-point operations keep the order the engine uses.
"""

from __future__ import annotations

INVOICE_LINES = """
SELECT CASE WHEN l_returnflag = 'R' THEN concat('C', CAST(l_orderkey AS VARCHAR)) ELSE CAST(l_orderkey AS VARCHAR) END AS "InvoiceNo",
       p_type AS "StockCode", p_brand AS "Brand", p_name AS "Description",
       CASE WHEN l_returnflag = 'R' THEN -l_quantity WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END AS "Quantity"
FROM lineitem JOIN part ON l_partkey = p_partkey"""

CUSTOMERS = """
SELECT CAST(o_custkey AS VARCHAR) AS basket_id, p_type AS item
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
WHERE l_returnflag <> 'R'"""

CUSTOMER_PRODUCTS = """
SELECT CAST(o_custkey AS VARCHAR) AS basket_id, p_brand || ' ' || p_type AS item
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
WHERE l_returnflag <> 'R'"""

USERS = "SELECT CAST(user_id AS VARCHAR) AS basket_id, event_type AS item FROM events"

USER_DAYS = """
SELECT concat(CAST(user_id AS VARCHAR), '|', CAST(CAST(ts AS DATE) AS VARCHAR)) AS basket_id, event_type AS item
FROM events"""


def clean(profile: str, item: str = "StockCode") -> str:
    rules = {
        "A": f"""SELECT "InvoiceNo" AS basket_id, "{item}" AS item FROM ({INVOICE_LINES})
WHERE "InvoiceNo" IS NOT NULL AND "{item}" IS NOT NULL AND NOT starts_with("InvoiceNo", 'C')
  AND ("Quantity" IS NULL OR "Quantity" > 0)""",
        "B": f"""SELECT trim("InvoiceNo") AS basket_id, trim(coalesce("{item}", '')) AS item FROM ({INVOICE_LINES})
WHERE coalesce("Quantity", 0) > 0 AND trim(coalesce("{item}", '')) <> ''
  AND "InvoiceNo" IS NOT NULL AND NOT starts_with(trim("InvoiceNo"), 'C')""",
        "C": f"""SELECT "InvoiceNo" AS basket_id, "{item}" AS item FROM ({INVOICE_LINES})
WHERE "{item}" IS NOT NULL AND "InvoiceNo" IS NOT NULL AND "Quantity" > 0""",
    }
    return rules[profile]


def threshold(ratio: float, mode: str) -> str:
    """Absolute threshold of a count ``n`` in scope."""
    product = f"CAST({ratio} AS DOUBLE) * n"
    if mode == "floor":
        return f"greatest(1, CAST(floor({product}) AS BIGINT))"
    if mode == "ceil":
        return f"greatest(1, CAST(ceil({product}) AS BIGINT))"
    # smallest count whose share reaches the ratio: look around the rounded product
    return (
        f"greatest(1, (SELECT min(c) FROM range(CAST(ceil({product}) AS BIGINT) - 2, CAST(ceil({product}) AS BIGINT) + 3) AS r(c)"
        f" WHERE c / CAST(n AS DOUBLE) >= CAST({ratio} AS DOUBLE)))"
    )


def mined(lines: str, ratio: float, mode: str = "ceil", depth: int = 6) -> str:
    """CTEs ``b`` (presence), ``t`` (n, m) and ``f`` (k, s, cnt, sup) up to sets of ``depth`` items."""
    ctes = [
        f"b AS MATERIALIZED (SELECT DISTINCT basket_id, item FROM ({lines}))",
        f"t AS MATERIALIZED (SELECT n, {threshold(ratio, mode)} AS m FROM (SELECT count(DISTINCT basket_id) AS n FROM b))",
        "o1 AS MATERIALIZED (SELECT basket_id, [item] AS s, item AS last_item FROM b)",
    ]
    for k in range(2, depth + 1):
        ctes.append(
            f"o{k} AS MATERIALIZED (SELECT o.basket_id, list_append(o.s, b.item) AS s, b.item AS last_item"
            f" FROM o{k - 1} o JOIN b ON b.basket_id = o.basket_id AND b.item > o.last_item)"
        )
    levels = " UNION ALL ".join(
        f"SELECT {k} AS k, s, count(*) AS cnt FROM o{k} GROUP BY s" for k in range(1, depth + 1)
    )
    ctes.append(f"a AS MATERIALIZED (SELECT k, s, cnt, CAST(cnt AS DOUBLE) / n AS sup FROM ({levels}), t)")
    ctes.append("f AS MATERIALIZED (SELECT a.* FROM a, t WHERE cnt >= m)")
    return "WITH " + ",\n".join(ctes)


RULES = """, r AS MATERIALIZED (
  SELECT x.k, x.cnt, x.s AS whole, l.s AS ante, c.s AS cons, l.sup AS sa, c.sup AS sc, x.sup AS sup,
         x.sup / l.sup AS conf, (x.sup / l.sup) / c.sup AS lift
  FROM f x JOIN f l ON l.k < x.k AND list_has_all(x.s, l.s)
           JOIN f c ON c.k = x.k - l.k AND list_has_all(x.s, c.s) AND NOT list_has_any(l.s, c.s))"""


def text(column: str, separator: str = ", ") -> str:
    return f"array_to_string({column}, '{separator}')"


def rule(separator: str = ", ") -> str:
    return f"{text('ante', separator)} || ' -> ' || {text('cons', separator)}"


RULE_COLUMNS = (
    f"{text('ante')} AS antecedent_text, {text('cons')} AS consequent_text, {rule()} AS rule,"
    " sup AS support, conf AS confidence, lift"
)
BEST_FIRST = f"conf DESC, lift DESC, sup DESC, {rule()}"
ITEMSETS = f"SELECT k, {text('s')} AS itemset_text, cnt AS \"count\", sup AS support FROM f"
LEVEL = f"SELECT {text('s')} AS itemset_text, cnt AS \"count\", sup AS support"
LABEL = (
    "concat(CASE WHEN conf >= 0.70 THEN 'strong' ELSE 'weak' END, ' + ',"
    " CASE WHEN lift > 1.00 THEN 'useful' ELSE 'unuseful' END)"
)


def fixed(column: str, digits: int) -> str:
    return f"printf('%.{digits}f', {column})"


def percent(column: str) -> str:
    return f"printf('%.2f%%', {column} * 100)"


A_TYPE, A_BRAND, A_NAME = clean("A"), clean("A", "Brand"), clean("A", "Description")
A_PRODUCT = A_BRAND.replace('"Brand" AS item', """"Brand" || ' ' || "StockCode" AS item""")
B_TYPE, C_TYPE = clean("B"), clean("C")

TYPE_1 = mined(A_TYPE, 0.01)
BRAND_1 = mined(A_BRAND, 0.01, depth=3)
BRAND_1_PAIRS = mined(A_BRAND, 0.01, depth=2)
PRODUCT_PAIRS = mined(A_PRODUCT, 0.0002, depth=2)
BRAND_02 = mined(A_BRAND, 0.002, depth=7)
NAME_5 = mined(A_NAME, 0.05, depth=1)
CUSTOMER_5 = mined(CUSTOMERS, 0.05)
USER_5 = mined(USERS, 0.05, depth=5)

# candidates: every pair of frequent items, every three-item union of two frequent pairs, and the
# three-item sets all of whose pairs are frequent
C2 = """, c2 AS (SELECT [x.s[1], y.s[1]] AS s FROM f x JOIN f y ON x.k = 1 AND y.k = 1 AND x.s[1] < y.s[1])"""
# triples as three columns, counted by joining presence on each of their items
C3_COUNTED = """, ends AS MATERIALIZED (
  SELECT s[1] AS shared, s[2] AS other FROM f WHERE k = 2 UNION ALL SELECT s[2], s[1] FROM f WHERE k = 2
), c3 AS MATERIALIZED (SELECT DISTINCT least(x.shared, x.other) AS i1,
         CASE WHEN x.shared < x.other THEN x.other WHEN x.shared > y.other THEN y.other ELSE x.shared END AS i2,
         greatest(x.shared, y.other) AS i3
  FROM ends x JOIN ends y ON x.shared = y.shared AND x.other < y.other
), u AS MATERIALIZED (SELECT x.item AS i1, y.item AS i2, z.item AS i3, count(*) AS cnt
  FROM b x JOIN b y ON y.basket_id = x.basket_id AND y.item > x.item
           JOIN b z ON z.basket_id = y.basket_id AND z.item > y.item GROUP BY ALL
), c3_counted AS (SELECT concat_ws(', ', c3.i1, c3.i2, c3.i3) AS itemset_text, coalesce(u.cnt, 0) AS "count",
         coalesce(CAST(u.cnt AS DOUBLE) / t.n, 0.0) AS support
  FROM c3 LEFT JOIN u ON u.i1 = c3.i1 AND u.i2 = c3.i2 AND u.i3 = c3.i3, t)"""
P3 = """, p3 AS (SELECT [x.s[1], x.s[2], y.s[2]] AS s FROM f x JOIN f y ON x.k = 2 AND y.k = 2
  AND x.s[1] = y.s[1] AND x.s[2] < y.s[2] JOIN f z ON z.k = 2 AND z.s[1] = x.s[2] AND z.s[2] = y.s[2])"""


def counted(candidates: str) -> str:
    return (
        f"SELECT {text('q.s')} AS itemset_text, coalesce(a.cnt, 0) AS \"count\","
        f" coalesce(a.sup, 0.0) AS support FROM {candidates} q LEFT JOIN a ON a.s = q.s"
    )


def occurring(candidates: str) -> str:
    return f"{counted(candidates)} WHERE a.cnt > 0"


def sweep(lines: str, ratios, depth: int = 3, mode: str = "floor") -> str:
    """CTEs up to ``h``: thresholds; ``g``: sets per threshold. ``f`` holds the lowest threshold."""
    rows = ", ".join(f"({pos}, CAST({r} AS DOUBLE))" for pos, r in enumerate(ratios))
    absolute = f"greatest(1, CAST({mode}(min_support * n) AS BIGINT))"
    return (
        mined(lines, min(ratios), mode, depth)
        + f", h AS MATERIALIZED (SELECT list_pos, min_support, {absolute} AS abs_support"
        + f" FROM (VALUES {rows}) AS v(list_pos, min_support), t)"
        + ", g AS MATERIALIZED (SELECT h.*, f.k, f.s, f.cnt, f.sup FROM h JOIN f ON f.cnt >= h.abs_support)"
    )


SWEEP = sweep(B_TYPE, (0.005, 0.01, 0.02, 0.03, 0.05))
SWEEP_SIX = sweep(B_TYPE, (0.005, 0.01, 0.02, 0.03, 0.05, 0.1))
CUSTOMER_SWEEP = sweep(CUSTOMERS, (0.05, 0.2, 0.5, 0.9, 0.99))

SUMMARY = """, y AS (SELECT h.min_support, h.abs_support AS abs_support_count,
  count(*) FILTER (g.k = 1) AS l1_count, count(*) FILTER (g.k = 2) AS l2_count, count(*) FILTER (g.k = 3) AS l3_count
  FROM h LEFT JOIN g ON g.list_pos = h.list_pos GROUP BY ALL)"""

CORRELATED = f""", top AS (SELECT *, row_number() OVER (PARTITION BY list_pos, k ORDER BY sup DESC, cnt DESC, {text('s', ' + ')}) AS rn
  FROM g WHERE k IN (2, 3)),
cor AS (SELECT {text('s', ' + ')} AS itemset, any_value(k) AS itemset_size, any_value(sup) AS support,
  any_value(cnt) AS "count", arg_min(min_support, list_pos) AS min_support
  FROM top WHERE rn <= 10 GROUP BY s ORDER BY support DESC, "count" DESC, itemset LIMIT 10)"""

VALUABLE = RULES + f""", w AS (SELECT h.list_pos, h.min_support, {rule(' + ')} AS rule, sup, conf, lift,
  conf >= 0.70 AND lift > 1.0 AS good FROM r JOIN h ON r.cnt >= h.abs_support WHERE r.k IN (2, 3)),
w2 AS (SELECT *, bool_or(good) OVER (PARTITION BY list_pos) AS any_good FROM w),
w3 AS (SELECT *, CAST(row_number() OVER (PARTITION BY list_pos ORDER BY conf DESC, lift DESC, sup DESC, rule) AS INTEGER) AS rn
  FROM w2 WHERE good OR NOT any_good),
v AS MATERIALIZED (SELECT list_pos, min_support, rn AS rank, rule, sup AS support, conf AS confidence, lift FROM w3 WHERE rn <= 10),
best AS (SELECT list_pos, min_support, count(*) AS n_rules FROM v GROUP BY ALL ORDER BY n_rules DESC, list_pos LIMIT 1)"""

BEST_RULES = "SELECT v.* EXCLUDE (list_pos) FROM v SEMI JOIN best ON v.list_pos = best.list_pos"

ORACLES: dict[str, str] = {
    "clean_a": A_TYPE,
    "clean_b": B_TYPE,
    "clean_c": C_TYPE,
    "csv_ingest": A_TYPE,
    "csv_first": A_TYPE.replace(f"({INVOICE_LINES})", f"""({INVOICE_LINES}
  AND regexp_replace(p_brand, '[^A-Za-z0-9]', '_', 'g') = (SELECT min(regexp_replace(p_brand, '[^A-Za-z0-9]', '_', 'g'))
      FROM lineitem JOIN part ON l_partkey = p_partkey))"""),
    "parquet_copy": INVOICE_LINES,
    "dataset_profile": f"""
SELECT 'n_rows' AS metric, count(*) AS value FROM ({INVOICE_LINES})
UNION ALL SELECT 'n_columns', 5
UNION ALL SELECT 'n_transactions', count(DISTINCT basket_id) FROM ({A_TYPE})
UNION ALL SELECT 'n_items', count(DISTINCT item) FROM ({A_TYPE})""",
    "baskets_text": f"""
SELECT basket_id, {text('list_sort(list(item))')} AS items_text, CAST(count(*) AS INTEGER) AS n_items
FROM (SELECT DISTINCT basket_id, item FROM ({A_TYPE})) GROUP BY basket_id""",
    "presence_long": f"SELECT DISTINCT basket_id, item FROM ({A_TYPE})",
    "presence_matrix": "SELECT basket_id, "
    + ", ".join(
        f"bool_or(item = '{t}') AS \"{t}\""
        for t in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
    )
    + f" FROM ({A_TYPE}) GROUP BY basket_id",
    "presence_vectors": f"SELECT DISTINCT basket_id, item FROM ({A_BRAND})",
    "threshold_modes": " UNION ALL ".join(
        f"SELECT CAST({r} AS DOUBLE) AS min_support, n AS n_transactions, {threshold(r, 'ceil')} AS abs_ceil,"
        f" {threshold(r, 'floor')} AS abs_floor, {threshold(r, 'ratio')} AS abs_ratio"
        f" FROM (SELECT count(DISTINCT basket_id) AS n FROM ({A_TYPE}))"
        for r in (0.05, 0.02, 0.01, 0.005, 0.002)
    ),
    "item_dictionary": mined(A_BRAND, 0.01, depth=1)
    + """ SELECT CAST(row_number() OVER (ORDER BY cnt DESC, s[1]) - 1 AS INTEGER) AS id, s[1] AS item, cnt AS "count" FROM f""",
    "encoded_round_trip": NAME_5 + " SELECT basket_id, item FROM b SEMI JOIN f ON f.s[1] = b.item",
    "c1_items": NAME_5 + LEVEL + " FROM a",
    "l1_items": NAME_5 + LEVEL + " FROM f",
    "l1_dropped": NAME_5 + f" SELECT {text('s')} AS itemset_text, cnt AS \"count\" FROM a, t WHERE cnt < m",
    "c2_pairs": BRAND_1 + C2 + occurring("c2"),
    "c2_absent_pairs": PRODUCT_PAIRS + C2 + counted("c2"),
    "l2_pairs": BRAND_1 + LEVEL + " FROM f WHERE k = 2",
    "candidates_k3": BRAND_1 + P3 + f" SELECT {text('s')} AS itemset_text FROM p3",
    "c3_triples": BRAND_1_PAIRS + C3_COUNTED + " SELECT * FROM c3_counted",
    "l3_triples": BRAND_02 + LEVEL + " FROM f WHERE k = 3",
    "frequent_itemsets": TYPE_1 + ITEMSETS,
    "frequent_itemsets_deep": mined(A_TYPE, 0.002) + ITEMSETS,
    "frequent_itemsets_brand": BRAND_02 + ITEMSETS,
    "frequent_itemsets_profile_b": mined(B_TYPE, 0.01) + ITEMSETS,
    "frequent_itemsets_floor": mined(A_BRAND, 0.01, "floor", 7) + ITEMSETS,
    "frequent_itemsets_maxk2": mined(A_BRAND, 0.002, depth=2) + ITEMSETS,
    "itemsets_ratio_mode": mined(C_TYPE, 0.02, "ratio") + ITEMSETS,
    "itemsets_customers": CUSTOMER_5 + ITEMSETS,
    "itemsets_customer_products": mined(CUSTOMER_PRODUCTS, 0.02, depth=3) + ITEMSETS,
    "itemsets_users": USER_5 + ITEMSETS,
    "itemsets_user_days": mined(USER_DAYS, 0.01, depth=5) + ITEMSETS,
    # a candidate of level k has all its (k-1)-subsets frequent; type sets that never occur cannot pass
    "level_funnel": TYPE_1
    + """, q AS (SELECT x.k + 1 AS k, list_append(x.s, y.s[x.k]) AS s FROM f x JOIN f y
  ON y.k = x.k AND y.s[1:x.k - 1] = x.s[1:x.k - 1] AND x.s[x.k] < y.s[x.k]),
q2 AS (SELECT q.k, q.s FROM q JOIN f ON f.k = q.k - 1 AND list_has_all(q.s, f.s) GROUP BY q.k, q.s HAVING count(*) = q.k),
c AS (SELECT k, count(*) AS n_candidates FROM q2 GROUP BY k), l AS (SELECT k, count(*) AS n FROM f GROUP BY k)
SELECT coalesce(c.k, l.k) AS k, n_candidates, coalesce(l.n, 0) AS n_frequent FROM l FULL JOIN c ON c.k = l.k""",
    "run_totals": TYPE_1
    + """, p AS (SELECT k, count(*) AS n FROM f GROUP BY k)
SELECT max(k) AS max_k, CAST(sum(n) AS BIGINT) AS total_freq,
  string_agg(format('L{}={:,}', k, n), ', ' ORDER BY k) AS per_k_text FROM p""",
    "rules_l3": TYPE_1 + RULES + f" SELECT {RULE_COLUMNS} FROM r WHERE k = 3",
    "rules_l2_l3": TYPE_1 + RULES + f" SELECT k, {RULE_COLUMNS} FROM r WHERE k IN (2, 3)",
    "rules_min_conf": TYPE_1 + RULES + f" SELECT {RULE_COLUMNS} FROM r WHERE conf >= 0.3",
    "rules_extended": CUSTOMER_5
    + RULES
    + f""" SELECT {text('ante')} AS antecedents, {text('cons')} AS consequents,
  sa AS "antecedent support", sc AS "consequent support", sup AS support, conf AS confidence, lift,
  CAST(1.0 AS DOUBLE) AS representativity, sup - sa * sc AS leverage,
  CASE WHEN conf < 1 THEN (1 - sc) / (1 - conf) ELSE CAST('inf' AS DOUBLE) END AS conviction,
  CASE WHEN greatest(sup * (1 - sa), sa * (sc - sup)) = 0 THEN 0.0
       ELSE (sup - sa * sc) / greatest(sup * (1 - sa), sa * (sc - sup)) END AS zhangs_metric,
  sup / (sa + sc - sup) AS jaccard,
  CASE WHEN sc = 1 THEN 0.0 ELSE (conf - sc) / (1 - sc) END AS certainty,
  (sup / sa + sup / sc) / 2 AS kulczynski
FROM r WHERE conf >= 0.3""",
    "rules_labelled": CUSTOMER_5
    + RULES
    + f" SELECT {rule()} AS rule, conf AS confidence, lift, {LABEL} AS interpretation FROM r",
    "rules_labelled_users": USER_5
    + RULES
    + f" SELECT {rule()} AS rule, conf AS confidence, lift, {LABEL} AS interpretation FROM r",
    "query_rules": TYPE_1
    + RULES
    + f""" SELECT {text('ante')} AS antecedents, {text('cons')} AS consequents, sup AS support, conf AS confidence, lift
FROM r WHERE conf >= 0.3 AND lift >= 0.9
  AND (contains(lower({text('ante')}), 'promo') OR contains(lower({text('cons')}), 'promo'))
ORDER BY conf DESC, antecedents, consequents LIMIT 20""",
    "query_rules_columns": CUSTOMER_5
    + RULES
    + f""" SELECT {text('ante')} AS antecedents, {text('cons')} AS consequents, sc AS "consequent support",
  sup - sa * sc AS leverage,
  CASE WHEN greatest(sup * (1 - sa), sa * (sc - sup)) = 0 THEN 0.0
       ELSE (sup - sa * sc) / greatest(sup * (1 - sa), sa * (sc - sup)) END AS zhangs_metric
FROM r WHERE conf >= 0.9 AND lift >= 1.0 ORDER BY leverage, antecedents, consequents LIMIT 15""",
    "threshold_sweep": SWEEP + SUMMARY + " SELECT * FROM y",
    "first_thresholds": SWEEP_SIX + SUMMARY + " SELECT * FROM y ORDER BY min_support LIMIT 5",
    # no SQL for slowest_and_fastest: it reports wall-clock seconds
    "slowest_and_fastest": SWEEP
    + SUMMARY
    + """, e AS (SELECT min_support, CAST(l1_count + l2_count + l3_count AS DOUBLE) AS sec FROM y)
SELECT (SELECT min_support FROM e ORDER BY sec DESC, min_support LIMIT 1) AS slowest_min_support, max(sec) AS slowest_sec,
  (SELECT min_support FROM e ORDER BY sec, min_support LIMIT 1) AS fastest_min_support, min(sec) AS fastest_sec FROM e""",
    "timed_thresholds": sweep(A_TYPE, (0.05, 0.02, 0.01, 0.005), 6, "ceil")
    + """ SELECT h.min_support, h.abs_support AS abs_support_count, count(*) FILTER (g.k = 1) AS l1_count,
  count(*) FILTER (g.k = 2) AS l2_count, count(*) FILTER (g.k = 3) AS l3_count, any_value(t.n) AS n_txn,
  max(g.k) AS max_k, count(g.k) AS total_freq,
  (SELECT string_agg(format('L{}={:,}', k, c), ', ' ORDER BY k)
   FROM (SELECT k, count(*) AS c FROM f WHERE f.cnt >= h.abs_support GROUP BY k)) AS per_k_text
  FROM t, h LEFT JOIN g ON g.list_pos = h.list_pos GROUP BY h.min_support, h.abs_support""",
    "sweep_itemsets": SWEEP
    + f""" SELECT min_support, abs_support AS abs_support_count, k, {text('s')} AS itemset_text,
  cnt AS "count", sup AS support FROM g""",
    "correlated_itemsets": SWEEP + CORRELATED + " SELECT * FROM cor",
    "valuable_rules": SWEEP + VALUABLE + " SELECT * EXCLUDE (list_pos) FROM v",
    "valuable_rules_customers": CUSTOMER_SWEEP + VALUABLE + " SELECT * EXCLUDE (list_pos) FROM v",
    "best_threshold": CUSTOMER_SWEEP + VALUABLE + " SELECT min_support, n_rules FROM best",
    "best_rules": CUSTOMER_SWEEP + VALUABLE + BEST_RULES,
    "top_itemsets_per_level": TYPE_1
    + f""", u AS (SELECT k, CAST(row_number() OVER (PARTITION BY k ORDER BY cnt DESC, {text('s')}) AS INTEGER) AS rank,
  {text('s')} AS itemset_text, cnt AS "count" FROM f) SELECT * FROM u WHERE rank <= 5""",
    "top_itemsets": TYPE_1 + ITEMSETS + " ORDER BY sup DESC, itemset_text LIMIT 10",
    "top_rules": TYPE_1 + RULES + f" SELECT {RULE_COLUMNS} FROM r ORDER BY {BEST_FIRST} LIMIT 10",
    "top_rules_by_confidence": TYPE_1
    + RULES
    + f""" SELECT {text('ante')} AS antecedents, {text('cons')} AS consequents, sup AS support, conf AS confidence, lift
FROM r WHERE conf >= 0.3 ORDER BY conf DESC, antecedents, consequents LIMIT 10""",
    "top_items": NAME_5 + LEVEL + ' FROM a ORDER BY cnt DESC, itemset_text LIMIT 10',
    "summary_metrics": mined(C_TYPE, 0.02, "ratio")
    + RULES
    + f""", z AS (SELECT * FROM r WHERE conf >= 0.3)
SELECT 'rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM ({INVOICE_LINES}) WHERE "Quantity" > 0 AND "StockCode" IS NOT NULL
UNION ALL SELECT 'columns', 5
UNION ALL SELECT 'transactions', n FROM t
UNION ALL SELECT 'unique_items', count(DISTINCT item) FROM b
UNION ALL SELECT 'frequent_itemsets', count(*) FROM f
UNION ALL SELECT 'avg_support', round_even(avg(sup), 4) FROM f
UNION ALL SELECT 'association_rules', count(*) FROM z
UNION ALL SELECT 'avg_confidence', coalesce(round_even(avg(conf), 4), 0) FROM z
UNION ALL SELECT 'avg_lift', coalesce(round_even(avg(lift), 4), 0) FROM z""",
    "table_c1": NAME_5
    + f' SELECT {text("s")} AS "Itemset", cnt AS "Count", {percent("sup")} AS "Support" FROM a',
    "table_c1_shown": NAME_5
    + f' SELECT {text("s")} AS "Itemset", cnt AS "Count", {percent("sup")} AS "Support" FROM a'
    + f" ORDER BY cnt DESC, {text('s')} LIMIT 5",
    "table_l1_dropped": NAME_5
    + f' SELECT {text("s")} AS "Dropped Itemset", cnt AS "Quantity" FROM a, t WHERE cnt < m',
    "table_c2": BRAND_1
    + C2
    + f' SELECT itemset_text AS itemsets, "count" AS "Count" FROM ({occurring("c2")})',
    "table_l2": BRAND_1
    + f' SELECT {text("s")} AS itemsets, cnt AS "Count", {percent("sup")} AS "Support" FROM f WHERE k = 2',
    "table_c3": BRAND_1_PAIRS
    + C3_COUNTED
    + f' SELECT itemset_text AS "Itemset", "count" AS "Count", {percent("support")} AS "Support" FROM c3_counted',
    "table_l3": BRAND_02
    + f' SELECT {text("s")} AS itemsets, cnt AS "Count", {percent("sup")} AS "Support" FROM f WHERE k = 3',
    "table_rules_l3": TYPE_1
    + RULES
    + f""" SELECT {rule()} AS "Rule", concat({fixed('conf', 4)}, ' (', {percent('conf')}, ')') AS "Confidence"
FROM r WHERE k = 3""",
    "table_rule_summary": CUSTOMER_5
    + RULES
    + f""" SELECT {rule()} AS "Rule", {fixed('sup', 4)} AS support_decimal, {percent('sup')} AS support_pct,
  {fixed('conf', 4)} AS confidence_decimal, {percent('conf')} AS confidence_pct, {fixed('lift', 2)} AS lift_decimal,
  {LABEL} AS "Interpretation" FROM r WHERE k = 3""",
    "table_execution_summary": SWEEP
    + SUMMARY
    + f""" SELECT {fixed('min_support', 4)} AS "Min Support", abs_support_count AS "Abs Support",
  CAST(NULL AS VARCHAR) AS "Execution Time (s)", l1_count AS "L1 Count", l2_count AS "L2 Count", l3_count AS "L3 Count" FROM y""",
    "report_execution": SWEEP
    + SUMMARY
    + f""" SELECT {fixed('min_support', 3)} AS min_support, abs_support_count, CAST(NULL AS VARCHAR) AS execution_time_sec,
  l1_count, l2_count, l3_count FROM y""",
    "report_top_rules": TYPE_1
    + RULES
    + f""" SELECT {rule()} AS "Rule", {fixed('sup', 4)} AS "Support", {fixed('conf', 4)} AS "Confidence",
  {fixed('lift', 2)} AS "Lift" FROM r ORDER BY {BEST_FIRST} LIMIT 10""",
    "report_top_items": NAME_5
    + f""" SELECT {text('s')} AS itemsets, cnt AS "count", {fixed('sup', 4)} AS support
FROM a ORDER BY cnt DESC, itemsets LIMIT 10""",
    "report_correlated": SWEEP
    + CORRELATED
    + f""" SELECT itemset, itemset_size, "count", {fixed('support', 4)} AS support,
  {fixed('min_support', 3)} AS min_support FROM cor""",
    "report_valuable_rules": CUSTOMER_SWEEP
    + VALUABLE
    + f""" SELECT rule, {fixed('support', 4)} AS support, {fixed('confidence', 4)} AS confidence,
  {fixed('lift', 2)} AS lift FROM ({BEST_RULES})""",
    "report_itemsets": TYPE_1
    + f""", u AS (SELECT k, row_number() OVER (PARTITION BY k ORDER BY cnt DESC, {text('s')}) AS rank,
  {text('s')} AS itemset, cnt AS "count" FROM f) SELECT k, itemset, "count" FROM u WHERE rank <= 5""",
}

ORACLES["query_rules_stored"] = ORACLES["query_rules"]
ORACLES["alias_lookup"] = (
    TYPE_1
    + RULES
    + f""" SELECT {text('s')} AS name, cnt AS "count", {percent('sup')} AS support FROM f
UNION ALL SELECT {rule()}, NULL, {percent('sup')} FROM r WHERE k = 2"""
)
