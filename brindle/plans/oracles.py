"""For each query the same result as plain SQL, for DuckDB on the same tables."""

from __future__ import annotations

from brindle.plans.catalog import EPOCHS, GAMMA_SEED, LEARNING_RATE

BRANDS = 25  # the SQL is written out step by step for the brands of the test tables; the query counts them

_BLOCK = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
_ROW_SUM = " + ".join(f"coalesce({c}, 0.0)" for c in _BLOCK)

_LINES = """
    SELECT l_orderkey AS order_id, l_partkey AS product_id, p_name, p_brand, p_type
    FROM lineitem JOIN part ON l_partkey = p_partkey
"""


def _by_row_sum(direction: str) -> str:
    return f"""
    SELECT round({_ROW_SUM}, 6) AS row_sum, l_orderkey, l_linenumber FROM lineitem
    ORDER BY round({_ROW_SUM}, 6) {direction} NULLS LAST,
        l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
    LIMIT 15"""


def _profile(table: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{name}' AS \"column\", "
        f"count({name}) AS non_null, '{dtype}' AS dtype FROM {table}"
        for i, (name, dtype) in enumerate(columns.items())
    )


def _itemsets(item: str, min_support: float, name: str = "itemsets") -> str:
    """CTEs ``pairs``, ``total`` and the itemsets, found by listing every subset of every basket."""
    return f"""
    pairs AS (SELECT DISTINCT order_id, {item} AS item FROM ({_LINES})),
    total AS (SELECT count(DISTINCT order_id) AS n FROM pairs),
    kept AS (
        SELECT order_id, item FROM pairs WHERE item IN (
            SELECT item FROM pairs GROUP BY item
            HAVING count(*) >= (SELECT ceil(CAST({min_support} AS DOUBLE) * n) FROM total))),
    subsets AS (
        SELECT order_id, [item] AS items, item AS top FROM kept
        UNION ALL
        SELECT s.order_id, list_append(s.items, k.item), k.item
        FROM subsets s JOIN kept k ON k.order_id = s.order_id AND k.item > s.top),
    {name} AS (
        SELECT items, count(*) AS freq FROM subsets GROUP BY items
        HAVING count(*) >= (SELECT ceil(CAST({min_support} AS DOUBLE) * n) FROM total))"""


def _rules(min_confidence: float) -> str:
    return f"""
    split AS (
        SELECT list_filter(items, lambda x: x <> gone) AS antecedent, gone AS consequent, freq
        FROM (SELECT items, freq, unnest(items) AS gone FROM itemsets WHERE len(items) > 1)),
    rules AS (
        SELECT s.antecedent, s.consequent, s.freq / a.freq AS confidence,
            (s.freq / a.freq) / (c.freq / n) AS lift, s.freq / n AS support
        FROM split s
        JOIN itemsets a ON a.items = s.antecedent
        JOIN itemsets c ON c.items = [s.consequent]
        CROSS JOIN total
        WHERE s.freq / a.freq >= {min_confidence})"""


def _itemset_query(item: str, min_support: float) -> str:
    return f"""
    WITH RECURSIVE {_itemsets(item, min_support)}
    SELECT array_to_string(items, ',') AS items, freq FROM itemsets"""


def _rule_query(item: str, min_support: float, min_confidence: float) -> str:
    return f"""
    WITH RECURSIVE {_itemsets(item, min_support)}, {_rules(min_confidence)}
    SELECT array_to_string(antecedent, ',') AS antecedent, consequent,
        round(confidence, 6) AS confidence, round(lift, 6) AS lift, round(support, 6) AS support
    FROM rules"""


def _count_query(min_support: float) -> str:
    return f"""
    SELECT * FROM (
        WITH RECURSIVE {_itemsets("p_type", min_support)}, {_rules(0.5)}
        SELECT 'itemsets' AS kind, CAST({min_support} AS DOUBLE) AS min_support, count(*) AS n
        FROM itemsets
        UNION ALL
        SELECT 'rules', CAST({min_support} AS DOUBLE), count(*) FROM rules)"""


def _predict_query(min_support: float) -> str:
    return f"""
    WITH RECURSIVE {_itemsets("p_type", min_support)}, {_rules(0.5)},
    whole AS (SELECT order_id, list(item ORDER BY item) AS items FROM pairs GROUP BY order_id),
    gained AS (
        SELECT DISTINCT order_id, consequent FROM whole
        JOIN rules ON list_has_all(items, antecedent) AND NOT list_contains(items, consequent))
    SELECT w.order_id, array_to_string(any_value(w.items), ',') AS items,
        coalesce(string_agg(consequent, ',' ORDER BY consequent), '') AS prediction
    FROM whole w LEFT JOIN gained g ON g.order_id = w.order_id GROUP BY w.order_id"""


_CELLS = """
    cells AS MATERIALIZED (
        SELECT l_suppkey + 1 AS r, l_partkey + 1 AS c, CAST(count(*) AS DOUBLE) AS a
        FROM lineitem GROUP BY ALL)"""

_BRAND_CELLS = """
    cells AS MATERIALIZED (
        SELECT l_suppkey + 1 AS r, CAST(split_part(p_brand, '#', 2) AS BIGINT) AS c, CAST(count(*) AS DOUBLE) AS a
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)"""

_V = """
    degree AS (SELECT r, sum(a) AS d FROM cells GROUP BY r),
    v AS MATERIALIZED (
        SELECT p.i, p.k, p.s / (CASE WHEN d = 0 THEN 1 ELSE d END) AS v
        FROM (SELECT x.r AS i, y.r AS k, sum(x.a * y.a) AS s
              FROM cells x JOIN cells y ON x.c = y.c GROUP BY ALL) p
        JOIN degree ON r = i)"""

_TRANSITION = f"{_CELLS}, {_V}"


_BITS = f"CAST('0x' || substr(md5(concat_ws(':', '{GAMMA_SEED}', r, c)), 1, 15) AS BIGINT)"

_SHAPE = """
    shape AS (SELECT (SELECT max(s_suppkey) + 1 FROM supplier) AS num_rows,
        (SELECT max(p_partkey) + 1 FROM part) AS num_cols),
    grid AS (
        SELECT s_suppkey + 1 AS r, p_partkey + 1 AS c FROM supplier CROSS JOIN part)"""

_BRAND_SHAPE = f"""
    shape AS (SELECT max(s_suppkey) + 1 AS num_rows, {BRANDS} AS num_cols FROM supplier),
    grid AS (
        SELECT s_suppkey + 1 AS r, c FROM supplier CROSS JOIN (SELECT unnest(range(1, {BRANDS + 1})) AS c))"""

_START = f"""
    bits AS (SELECT r, c, {_BITS} AS b FROM grid),
    g0 AS MATERIALIZED (
        SELECT r, c,
            sqrt(-2.0 * ln(((b >> 30) + 1) / 1073741824.0))
                * cos(2.0 * pi() * ((b & 1073741823) / 1073741824.0)) * 0.10 AS g
        FROM bits)"""

_GAMMA = f"{_SHAPE}, {_START}"


def _step(n: int, column: int) -> str:
    """CTEs of one gradient step: cell errors, their sums, the next weights."""
    return f"""
    e{n} AS MATERIALIZED (
        SELECT cells.r, cells.c, a,
            (CASE WHEN cells.c < num_cols
                THEN coalesce(v.v, 0.0) * a * coalesce(g, 0.0) ELSE 0.0 END) - a AS e
        FROM cells
        CROSS JOIN shape
        LEFT JOIN v ON v.i = cells.r AND v.k = cells.c
        LEFT JOIN g{n - 1} g ON g.r = cells.r AND g.c = cells.c),
    s{n} AS MATERIALIZED (
        SELECT num, ss, sqrt(ss) AS rmse,
            num / (CASE WHEN ss = 0 THEN 0.0001 ELSE sqrt(ss) * num_rows * num_cols END) AS part
        FROM (SELECT sum(CASE WHEN r = {column} THEN a * e ELSE 0.0 END) AS num,
                     sum(e * e) AS ss FROM e{n})
        CROSS JOIN shape),
    g{n} AS MATERIALIZED (
        SELECT g.r, g.c, CASE WHEN g.c = {column}
            THEN g.g - {LEARNING_RATE} * coalesce(v.v, 0.0) * part ELSE g.g END AS g
        FROM g{n - 1} g
        CROSS JOIN s{n}
        LEFT JOIN v ON v.i = g.r AND v.k = {column} AND g.c = {column})"""


def _descent(steps: int, select: str) -> str:
    chain = ",".join(_step(n, (n - 1) % 2 + 1) for n in range(1, steps + 1))
    return f"WITH {_TRANSITION}, {_GAMMA}, {chain} {select}"


def _brand_descent(select: str) -> str:
    chain = ",".join(_step(n, n) for n in range(1, BRANDS + 1))
    return f"WITH {_BRAND_CELLS}, {_V}, {_BRAND_SHAPE}, {_START}, {chain} {select}"


def _whole_descent(select: str) -> str:
    """All columns, one recursion step each; ``m`` holds how far each column with a row has moved along V."""
    return f"""
    WITH RECURSIVE {_TRANSITION}, {_GAMMA},
    e0 AS MATERIALIZED (
        SELECT cells.r, cells.c, a,
            (CASE WHEN cells.c < num_cols THEN coalesce(v.v, 0.0) * a ELSE 0.0 END) AS f, g, coalesce(v.v, 0.0) AS v
        FROM cells CROSS JOIN shape
        LEFT JOIN v ON v.i = cells.r AND v.k = cells.c
        JOIN g0 ON g0.r = cells.r AND g0.c = cells.c),
    walk AS (
        SELECT 0 AS n, list_transform(range(num_rows), lambda x: CAST(0 AS DOUBLE)) AS m,
            CAST(0 AS DOUBLE) AS num, CAST(0 AS DOUBLE) AS ss
        FROM shape
        UNION ALL
        SELECT n + 1,
            list_transform(m, lambda x, i: CASE WHEN i = n % num_cols + 1 THEN x + {LEARNING_RATE} * num /
                (CASE WHEN ss = 0 THEN 0.0001 ELSE sqrt(ss) * num_rows * num_cols END) ELSE x END),
            num, ss
        FROM (
            SELECT n, any_value(m) AS m, sum(CASE WHEN r = n % num_cols + 1 THEN a * e ELSE 0.0 END) AS num,
                sum(e * e) AS ss, any_value(num_rows) AS num_rows, any_value(num_cols) AS num_cols
            FROM (
                SELECT n, m, r, a, f * (g - v * coalesce(m[c], 0.0)) - a AS e, num_rows, num_cols
                FROM walk CROSS JOIN shape CROSS JOIN e0
                WHERE n < {EPOCHS} * num_cols)
            GROUP BY n)),
    moved AS (
        SELECT unnest(m) AS size, unnest(range(1, len(m) + 1)) AS c FROM walk ORDER BY n DESC LIMIT (SELECT num_rows FROM shape))
    {select}"""


_BRAND_HISTORY = " UNION ALL ".join(
    f'SELECT 1 AS epoch, {n} AS "column", '
    f"round(coalesce(num, 0), 6) AS num, round(ss / 1e6, 6) AS ss_millions, round(rmse, 6) AS rmse FROM s{n}"
    for n in range(1, BRANDS + 1)
)

_HISTORY = " UNION ALL ".join(
    f"SELECT CAST({(n + 1) // 2} AS INTEGER) AS epoch, "
    f"CAST({(n - 1) % 2 + 1} AS INTEGER) AS \"column\", "
    f"round(num, 6) AS num, round(ss, 6) AS ss, round(rmse, 6) AS rmse FROM s{n}"
    for n in range(1, 2 * EPOCHS + 1)
)

ORACLES: dict[str, str] = {
    "csv_scan": "SELECT * FROM part",
    "csv_scan_texts": "SELECT * FROM documents",
    "csv_scan_inferred": """
    SELECT p_partkey, p_name, p_brand, p_size, CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_retailprice END AS price,
        CASE WHEN p_size % 2 = 0 THEN 'y' ELSE 'n' END AS letter, CASE WHEN p_size % 2 = 0 THEN 't' ELSE 'f' END AS initial,
        lpad((p_size % 24)::VARCHAR, 2, '0') || ':30' AS clock, '2024-' || lpad((p_size % 12 + 1)::VARCHAR, 2, '0') AS month,
        p_size || 'd' AS days, CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_size % 2 = 0 END AS truth,
        CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_partkey END AS gaps
    FROM part""",
    "points_parse": """
    SELECT CAST(vec_id AS VARCHAR) AS id, CAST(pos - 1 AS INTEGER) AS pos,
        CAST(embedding[pos] AS DOUBLE) AS x
    FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS pos FROM embeddings)""",
    "matrix_unpivot": """
    SELECT l_partkey + 1 AS r, CAST(l_quantity AS BIGINT) AS c, CAST(count(*) AS DOUBLE) AS a
    FROM lineitem GROUP BY ALL""",
    "triples_parse": f"WITH {_CELLS} SELECT r, c, a FROM cells",
    "tsv_roundtrip": f"WITH {_TRANSITION} SELECT i, k, round(v, 6) AS v FROM v",
    "column_profile": _profile(
        "part",
        {
            "p_partkey": "bigint",
            "p_name": "string",
            "p_brand": "string",
            "p_type": "string",
            "p_size": "int",
            "p_retailprice": "double",
        },
    ),
    "global_means": """
    SELECT 'o_totalprice' AS "column", round(avg(o_totalprice), 6) AS mean FROM orders
    UNION ALL SELECT 'c_acctbal', round(avg(c_acctbal), 6) FROM customer""",
    "block_means": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(avg({c}), 6) AS mean FROM lineitem" for c in _BLOCK
    ),
    "group_count": """
    SELECT p_brand, count(p_partkey) AS n FROM part
    WHERE p_brand IS NOT NULL GROUP BY p_brand ORDER BY p_brand""",
    "topk_groups": """
    SELECT p_brand, count(p_partkey) AS n FROM part
    WHERE p_brand IS NOT NULL GROUP BY p_brand ORDER BY n DESC, p_brand LIMIT 10""",
    "aligned_count_add_three": """
    WITH part_no AS (
        SELECT CAST(split_part(p_brand, '#', 2) AS INTEGER) AS brand_no, p_size, CAST(length(p_name) AS INTEGER) AS name_length, p_name FROM part),
    x AS (SELECT brand_no AS key, count(p_name) AS n FROM part_no GROUP BY 1),
    y AS (SELECT p_size AS key, count(p_name) AS n FROM part_no GROUP BY 1),
    z AS (SELECT name_length AS key, count(p_name) AS n FROM part_no GROUP BY 1)
    SELECT key, x.n + y.n + z.n AS n FROM x FULL JOIN y USING (key) FULL JOIN z USING (key) ORDER BY key""",
    "aligned_count_add": """
    WITH part_no AS (
        SELECT CAST(split_part(p_brand, '#', 2) AS INTEGER) AS brand_no, p_size, p_name FROM part),
    x AS (SELECT brand_no AS key, count(p_name) AS n FROM part_no GROUP BY 1),
    y AS (SELECT p_size AS key, count(p_name) AS n FROM part_no GROUP BY 1)
    SELECT key, x.n + y.n AS n FROM x FULL JOIN y USING (key) ORDER BY key""",
    "topk_rows": """
    SELECT * FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 10""",
    "row_sum_block": f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round({_ROW_SUM}, 6) AS row_sum
    FROM lineitem""",
    "bottomk_rowsum": _by_row_sum("ASC"),
    "topk_rowsum": _by_row_sum("DESC"),
    "preview": "SELECT * FROM nation ORDER BY n_nationkey LIMIT 5",
    "min_distance": """
    WITH entries AS (
        SELECT label, pos, avg(CAST(embedding[pos] AS DOUBLE)) AS x
        FROM (SELECT label, embedding, unnest(range(1, len(embedding) + 1)) AS pos FROM embeddings)
        GROUP BY ALL),
    means AS (SELECT label, list(x ORDER BY pos) AS v FROM entries GROUP BY label)
    SELECT CAST(vec_id AS VARCHAR) AS s_id,
        round(min(list_distance(CAST(embedding AS DOUBLE[]), v)), 6) AS distance
    FROM embeddings CROSS JOIN means GROUP BY vec_id ORDER BY s_id""",
    "min_distance_merged": """
    WITH means AS (
        SELECT avg(l_quantity) AS q, avg(l_extendedprice) AS e, avg(l_discount) AS d,
            avg(l_tax) AS t
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand)
    SELECT CAST(l_orderkey AS VARCHAR) AS s_id,
        round(min(sqrt((l_quantity - q) ** 2 + (l_extendedprice - e) ** 2
            + (l_discount - d) ** 2 + (l_tax - t) ** 2)), 6) AS distance
    FROM lineitem CROSS JOIN means GROUP BY l_orderkey ORDER BY s_id""",
    "min_distance_embeddings": """
    SELECT CAST(a.vec_id AS VARCHAR) AS s_id,
        round(min(list_distance(CAST(a.embedding AS DOUBLE[]), CAST(list_reverse(b.embedding) AS DOUBLE[]))), 6) AS distance
    FROM embeddings a CROSS JOIN embeddings b GROUP BY a.vec_id ORDER BY s_id""",
    "min_distance_partitioned": """
    SELECT CAST(c_custkey AS VARCHAR) AS s_id,
        round(min(sqrt(CAST(c_nationkey - s_nationkey AS DOUBLE) ** 2
            + (c_acctbal - s_acctbal) ** 2)), 6) AS distance
    FROM customer CROSS JOIN supplier GROUP BY c_custkey ORDER BY s_id""",
    "basket_join": _LINES,
    "dedup_subset": f"SELECT DISTINCT order_id, product_id, p_name FROM ({_LINES})",
    "baskets": f"""
    SELECT order_id, string_agg(DISTINCT p_name, ',' ORDER BY p_name) AS items
    FROM ({_LINES}) GROUP BY order_id ORDER BY order_id""",
    "freq_itemsets_type": _itemset_query("p_type", 0.01),
    "freq_itemsets_brand": _itemset_query("p_brand", 0.001),
    "freq_itemsets_name": _itemset_query("p_name", 0.01),
    "assoc_rules_type": _rule_query("p_type", 0.01, 0.5),
    "assoc_rules_brand": _rule_query("p_brand", 0.001, 0.1),
    "itemset_counts": f"{_count_query(0.01)} UNION ALL {_count_query(0.001)}",
    "basket_predict": _predict_query(0.01),
    "basket_predict_joined": _predict_query(0.01),
    "basket_predict_low": _predict_query(0.001),
    "assoc_rules_low": _rule_query("p_type", 0.001, 0.5),
    "row_degree": f"""
    WITH {_CELLS}
    SELECT s_suppkey + 1 AS r, CASE WHEN coalesce(sum(a), 0.0) = 0 THEN 1.0
        ELSE sum(a) END AS degree
    FROM supplier LEFT JOIN cells ON r = s_suppkey + 1 GROUP BY 1""",
    "nbi_transition": f"WITH {_TRANSITION} SELECT i, k, round(v, 6) AS v FROM v",
    "nbi_gamma_init": f"WITH {_GAMMA} SELECT r, c, round(g, 6) AS g FROM g0",
    "nbi_rating_error": _descent(
        1,
        "SELECT r, c, round(CASE WHEN r = 1 THEN a * e ELSE 0.0 END, 6) AS num, "
        "round(e * e, 6) AS err2 FROM e1",
    ),
    "nbi_error_summary": _descent(
        1,
        "SELECT round(num, 6) AS num, round(ss, 6) AS ss, round(rmse, 6) AS rmse, "
        "round(part * 1e6, 6) AS part_millionths FROM s1",
    ),
    "nbi_gradient_step": _descent(1, "SELECT r, c, round(g, 6) AS g FROM g1"),
    "nbi_fit": _descent(2 * EPOCHS, f"SELECT r, c, round(g, 6) AS g FROM g{2 * EPOCHS}"),
    "nbi_fit_history": _descent(2 * EPOCHS, _HISTORY),
    "nbi_fit_all": _whole_descent(
        "SELECT g0.r, g0.c, round(g - coalesce(v.v, 0.0) * size, 6) AS g FROM g0 JOIN moved ON moved.c = g0.c "
        "LEFT JOIN v ON v.i = g0.r AND v.k = g0.c"
    ),
    "nbi_fit_all_history": _whole_descent(
        "SELECT CAST((n - 1) // num_cols + 1 AS INTEGER) AS epoch, CAST((n - 1) % num_cols + 1 AS INTEGER) AS \"column\", "
        "round(num, 6) AS num, round(ss / 1e6, 6) AS ss_millions, round(sqrt(ss), 6) AS rmse "
        "FROM walk CROSS JOIN shape WHERE n > 0"
    ),
    "nbi_fit_brands": _brand_descent(
        f"SELECT r, c, round(g, 6) AS g FROM g{BRANDS} CROSS JOIN shape WHERE c <= num_rows"
    ),
    "nbi_fit_brands_history": _brand_descent(_BRAND_HISTORY),
}
