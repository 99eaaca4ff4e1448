"""Every operator applied to whole test tables; one entry per query.

Arrays are returned as comma-joined sorted text and computed doubles are rounded
to six places, so that the results can be compared across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.operators import baskets as market
from brindle.operators import bipartite, nearest, table
from brindle.operators.joins import lookup_join
from brindle.scratch import materialize, scratch_path
from brindle.sources import (
    read_csv,
    read_matrix,
    read_points,
    read_triples,
    write_csv,
    write_tsv,
)

Query = Callable[[SparkSession, str], DataFrame]

GAMMA_SEED = 7
LEARNING_RATE = 1000.0
EPOCHS = 2


def _load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _r6(value: Column | str) -> Column:
    return F.round(value, 6)


def _joined(array: str) -> Column:
    return F.array_join(F.array_sort(array), ",")


# --- sources and sinks -----------------------------------------------------------------------


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _load(spark, sf_dir, "part")
    path = scratch_path(spark, "part-csv")
    write_csv(part, path)
    return read_csv(spark, path, part.schema, pandas_missing=True)


def csv_scan_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line breaks, commas and quotes through CSV and back."""
    documents = _load(spark, sf_dir, "documents")
    path = scratch_path(spark, "documents-csv")
    write_csv(documents, path)
    return read_csv(spark, path, documents.schema, multi_line=True)


def csv_scan_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types from the values: integers, numbers with gaps marked NA, truth values, and texts that only look like something else."""
    size = F.col("p_size")
    gap = F.when(size % 7 == 0, "NA").otherwise(F.col("p_retailprice").cast("string"))
    looks = {
        "letter": F.when(size % 2 == 0, "y").otherwise("n"),
        "initial": F.when(size % 2 == 0, "t").otherwise("f"),
        "clock": F.concat(F.lpad((size % 24).cast("string"), 2, "0"), F.lit(":30")),
        "month": F.concat(F.lit("2024-"), F.lpad((size % 12 + 1).cast("string"), 2, "0")),
        "days": F.concat(size.cast("string"), F.lit("d")),
        "truth": F.when(size % 5 == 0, "").when(size % 2 == 0, "True").otherwise("false"),
        "gaps": F.when(size % 3 == 0, "n/a").otherwise(F.col("p_partkey").cast("string")),
    }
    part = _load(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_size", gap.alias("price"), *[column.alias(name) for name, column in looks.items()]
    )
    path = scratch_path(spark, "part-csv")
    write_csv(part, path)
    read = read_csv(spark, path, pandas_missing=True)
    types = {f.name: f.dataType.simpleString() for f in read.schema.fields}
    assert (types["price"], types["truth"]) == ("double", "boolean") and {types[c] for c in ("letter", "initial", "clock", "month", "days")} == {"string"}
    # The width of whole numbers follows the values, and so the table's size.
    return read.withColumns({c: F.col(c).cast("bigint") for c in ("p_partkey", "gaps")})


def points_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    coordinates = F.col("embedding").cast("array<double>").cast("array<string>")
    lines = _load(spark, sf_dir, "embeddings").select(
        F.concat_ws(" ", F.col("vec_id").cast("string"), coordinates)
    )
    path = scratch_path(spark, "points")
    lines.write.text(path)
    points = read_points(spark, path)
    return points.select("id", F.posexplode("v").alias("pos", "x"))


def matrix_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matrix part x quantity: how many lines sold a part in that quantity; as wide as the largest one."""
    quantity = F.col("l_quantity")
    whole = quantity == F.floor(quantity)
    fault = F.raise_error(F.concat(F.lit("not a column number: "), quantity.cast("string")))
    lines = _load(spark, sf_dir, "lineitem").select(
        (F.col("l_partkey") + 1).alias("r"),
        F.when(whole & (quantity >= 1), quantity.cast("bigint")).otherwise(fault.cast("bigint")).alias("c"),
    )
    widest = lines.agg(F.max("c").alias("m")).first()["m"] or 1
    counts = lines.groupBy("r", "c").agg(F.count(F.lit(1)).alias("n"))
    cells = F.map_from_entries(F.collect_list(F.struct("c", "n")))
    # A line of text per row: the counts of its columns in order, 0 where there is none.
    found = counts.groupBy("r").agg(cells.alias("cells"))
    columns = F.sequence(F.lit(1).cast("bigint"), F.lit(widest).cast("bigint"))
    filled = F.transform(columns, lambda c: F.coalesce(F.try_element_at("cells", c), F.lit(0)).cast("string"))
    path = scratch_path(spark, "matrix")
    write_tsv(found.select("r", F.array_join(filled, "\t").alias("cells")), path, lists=["cells"])
    return read_matrix(spark, path, widest).cells


def triples_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "triples")
    write_tsv(_supply_cells(spark, sf_dir).select("r", "c", "a"), path)
    return read_triples(spark, path, ("r", "c", "a"))


def tsv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "v")
    write_tsv(bipartite.transition(_stored_cells(spark, sf_dir)), path, compression="gzip")
    return read_triples(spark, path).select("i", "k", _r6("v").alias("v"))


# --- table analytics -------------------------------------------------------------------------


def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table.column_profile(_load(spark, sf_dir, "part"))


def global_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = table.column_means(_load(spark, sf_dir, "orders"), ["o_totalprice"])
    balances = table.column_means(_load(spark, sf_dir, "customer"), ["c_acctbal"])
    return prices.union(balances).select("column", _r6("mean").alias("mean"))


def block_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = table.block_means(_load(spark, sf_dir, "lineitem"), 4, 8)
    return means.select("column", _r6("mean").alias("mean"))


def group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table.group_count(_load(spark, sf_dir, "part"), "p_brand", "p_partkey")


def topk_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table.top_groups(_load(spark, sf_dir, "part"), "p_brand", "p_partkey", 10)


def aligned_count_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _load(spark, sf_dir, "part").select(
        F.substring_index("p_brand", "#", -1).cast("int").alias("brand_no"), "p_size", "p_name"
    )
    return table.aligned_count_add(part, "brand_no", "p_size", "p_name")


def aligned_count_add_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts by brand number, by size and by length of the name, added up where all three have the number."""
    part = _load(spark, sf_dir, "part").select(
        F.substring_index("p_brand", "#", -1).cast("int").alias("brand_no"), "p_size", F.length("p_name").alias("name_length"), "p_name"
    )
    return table.aligned_counts_add(part, ["brand_no", "p_size", "name_length"], "p_name")


def topk_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table.top_rows(_load(spark, sf_dir, "orders"), "o_totalprice", 10, ["o_orderkey"])


def row_sum_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    summed = table.with_row_sum(_load(spark, sf_dir, "lineitem"), 4, 8, "row_sum")
    return summed.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", _r6("row_sum").alias("row_sum")
    )


def _by_row_sum(spark: SparkSession, sf_dir: str, ascending: bool) -> DataFrame:
    summed = table.with_row_sum(_load(spark, sf_dir, "lineitem"), 4, 8, "row_sum")
    unique = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    picked = table.top_rows(
        summed.withColumn("row_sum", _r6("row_sum")), "row_sum", 15, unique, ascending
    )
    return picked.select("row_sum", "l_orderkey", "l_linenumber")


def bottomk_rowsum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_row_sum(spark, sf_dir, True)


def topk_rowsum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_row_sum(spark, sf_dir, False)


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table.preview(_load(spark, sf_dir, "nation"), ["n_nationkey"])


# --- nearest reference point -----------------------------------------------------------------


def min_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding to the closest of the mean embeddings of the labels."""
    embeddings = _load(spark, sf_dir, "embeddings")
    means = (
        embeddings.select("label", F.posexplode("embedding").alias("pos", "x"))
        .groupBy("label", "pos")
        .agg(F.avg("x").alias("x"))
        .groupBy("label")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("entries"))
        .select(F.col("label").alias("id"), F.col("entries.x").alias("v"))
    )
    points = embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    found = nearest.min_distance(points, means)
    return found.select(F.col("id").alias("s_id"), _r6("distance").alias("distance"))


def min_distance_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order, its lines taken as one point set, to the closest brand average."""
    lines = _load(spark, sf_dir, "lineitem")
    values = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    brands = market.basket_lines(
        lines.select(F.col("l_partkey").alias("p_partkey"), *values),
        _load(spark, sf_dir, "part").select("p_partkey", "p_brand"),
        "p_partkey",
    )
    means = brands.groupBy("p_brand").agg(*[F.avg(c).alias(c) for c in values])
    found = nearest.min_distance(
        lines.select(F.col("l_orderkey").alias("id"), F.array(*values).alias("v")),
        means.select(F.col("p_brand").alias("id"), F.array(*values).alias("v")),
    )
    return found.select(F.col("id").alias("s_id"), _r6("distance").alias("distance"))


def min_distance_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer to the closest supplier by nation key and balance, nothing broadcast."""
    customers = _load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.array(F.col("c_nationkey").cast("double"), "c_acctbal").alias("v"),
    )
    suppliers = _load(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.array(F.col("s_nationkey").cast("double"), "s_acctbal").alias("v"),
    )
    found = nearest.min_distance(customers, suppliers, max_broadcast_bytes=0)
    return found.select(F.col("id").alias("s_id"), _r6("distance").alias("distance"))


def min_distance_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding to the closest of all embeddings read backwards, in all dimensions, nothing broadcast."""
    embeddings = _load(spark, sf_dir, "embeddings")
    points = embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    mirrored = embeddings.select(F.col("vec_id").alias("id"), F.reverse("embedding").alias("v"))
    found = nearest.min_distance(points, mirrored, max_broadcast_bytes=0, block_rows=512)
    return found.select(F.col("id").alias("s_id"), _r6("distance").alias("distance"))


# --- market baskets --------------------------------------------------------------------------


def _order_lines(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    lines = _load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id")
    )
    products = _load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), *columns
    )
    return market.basket_lines(lines, products, "product_id")


def _stored_baskets(spark: SparkSession, sf_dir: str, item: str) -> DataFrame:
    built = market.build_baskets(_order_lines(spark, sf_dir, item), "order_id", item)
    return materialize(built, "baskets")


def basket_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_lines(spark, sf_dir, "p_name", "p_brand", "p_type")


def dedup_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.dedup_lines(_order_lines(spark, sf_dir, "p_name"), "order_id", "product_id")


def baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = market.build_baskets(_order_lines(spark, sf_dir, "p_name"), "order_id", "p_name")
    return built.select("order_id", _joined("items").alias("items")).orderBy("order_id")


def _itemsets(item: str, min_support: float) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = market.frequent_itemsets(_stored_baskets(spark, sf_dir, item), min_support)
        return found.table.select(_joined("items").alias("items"), "freq")

    return query


def _rules(item: str, min_support: float, min_confidence: float) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = market.frequent_itemsets(_stored_baskets(spark, sf_dir, item), min_support)
        return market.association_rules(found, min_confidence).select(
            _joined("antecedent").alias("antecedent"),
            _joined("consequent").alias("consequent"),
            _r6("confidence").alias("confidence"),
            _r6("lift").alias("lift"),
            _r6("support").alias("support"),
        )

    return query


def itemset_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _stored_baskets(spark, sf_dir, "p_type")
    parts = []
    for support in (0.01, 0.001):
        found = market.frequent_itemsets(stored, support)
        rules = market.association_rules(found, 0.5)
        for kind, frame in (("itemsets", found.table), ("rules", rules)):
            parts.append(
                frame.agg(F.count(F.lit(1)).alias("n")).select(
                    F.lit(kind).alias("kind"), F.lit(support).alias("min_support"), "n"
                )
            )
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


def _predictions(min_support: float, **options) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        stored = _stored_baskets(spark, sf_dir, "p_type")
        found = market.frequent_itemsets(stored, min_support)
        rules = market.association_rules(found, 0.5)
        return market.predict(stored, rules, **options).select(
            "order_id", _joined("items").alias("items"), _joined("prediction").alias("prediction")
        )

    return query


# --- bipartite network inference -------------------------------------------------------------


def _supply_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matrix supplier x part: the number of order lines between the two."""
    return bipartite.link_counts(
        _load(spark, sf_dir, "lineitem"), F.col("l_suppkey") + 1, F.col("l_partkey") + 1
    )


def _stored_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(_supply_cells(spark, sf_dir), "cells")


def _supply_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load(spark, sf_dir, "supplier").select((F.col("s_suppkey") + 1).alias("r"))


def _shape(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    rows = _load(spark, sf_dir, "supplier").agg(F.max("s_suppkey").alias("m")).first()["m"]
    cols = _load(spark, sf_dir, "part").agg(F.max("p_partkey").alias("m")).first()["m"]
    return rows + 1, cols + 1


def _first_errors(spark: SparkSession, sf_dir: str, cells: DataFrame) -> DataFrame:
    _, num_cols = _shape(spark, sf_dir)
    return bipartite.rating_error(bipartite.cell_weights(cells), None, 1, num_cols, GAMMA_SEED)


def _gamma(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, num_cols = _shape(spark, sf_dir)
    return bipartite.init_gamma(_supply_rows(spark, sf_dir), num_cols, GAMMA_SEED)


def row_degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bipartite.row_degree(_supply_rows(spark, sf_dir), _supply_cells(spark, sf_dir))


def nbi_transition(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = bipartite.transition(_stored_cells(spark, sf_dir))
    return v.select("i", "k", _r6("v").alias("v"))


def nbi_gamma_init(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gamma(spark, sf_dir).select("r", "c", _r6("g").alias("g"))


def nbi_rating_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = _first_errors(spark, sf_dir, _stored_cells(spark, sf_dir))
    return errors.select("r", "c", _r6("num").alias("num"), _r6("err2").alias("err2"))


def nbi_error_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = _first_errors(spark, sf_dir, _stored_cells(spark, sf_dir))
    summary = bipartite.error_summary(errors, *_shape(spark, sf_dir))
    return summary.select(
        _r6("num").alias("num"), _r6("ss").alias("ss"), _r6("rmse").alias("rmse"),
        _r6(F.col("part") * 1e6).alias("part_millionths"),
    )


def nbi_gradient_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _stored_cells(spark, sf_dir)
    errors = _first_errors(spark, sf_dir, cells)
    part = bipartite.error_summary(errors, *_shape(spark, sf_dir)).first()["part"]
    _, num_cols = _shape(spark, sf_dir)
    moved = bipartite.gradient_step(
        None, _supply_rows(spark, sf_dir), cells, part, 1, LEARNING_RATE, num_cols, GAMMA_SEED
    )
    return moved.select("r", "c", _r6("g").alias("g"))


def _fitted(spark: SparkSession, sf_dir: str) -> bipartite.Fit:
    """The reference's test run, which stops after two columns; ``_fitted_all`` is the whole fit."""
    return bipartite.fit(
        _supply_rows(spark, sf_dir),
        _stored_cells(spark, sf_dir),
        EPOCHS,
        LEARNING_RATE,
        *_shape(spark, sf_dir),
        seed=GAMMA_SEED,
        columns=[1, 2],
    )


def _history(fitted: bipartite.Fit) -> DataFrame:
    return fitted.history.select(
        "epoch", "column", _r6("num").alias("num"), _r6("ss").alias("ss"),
        _r6("rmse").alias("rmse"),
    )


def _history_millions(fitted: bipartite.Fit) -> DataFrame:
    """The error sum in millions, so that six places are within a double's precision."""
    return fitted.history.select(
        "epoch", "column", _r6("num").alias("num"), _r6(F.col("ss") / 1e6).alias("ss_millions"), _r6("rmse").alias("rmse")
    )


def nbi_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fitted(spark, sf_dir).gamma.select("r", "c", _r6("g").alias("g"))


def nbi_fit_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(_fitted(spark, sf_dir))


def _fitted_all(spark: SparkSession, sf_dir: str) -> bipartite.Fit:
    """Matrix supplier x part, all columns moved."""
    return bipartite.fit(
        _supply_rows(spark, sf_dir), _stored_cells(spark, sf_dir), EPOCHS, LEARNING_RATE, *_shape(spark, sf_dir), seed=GAMMA_SEED
    )


def nbi_fit_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fitted_all(spark, sf_dir).gamma.select("r", "c", _r6("g").alias("g"))


def nbi_fit_all_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history_millions(_fitted_all(spark, sf_dir))


BRAND_CHUNK = 8


def _fitted_brands(spark: SparkSession, sf_dir: str) -> bipartite.Fit:
    """Matrix supplier x brand, all columns moved, in several chunks."""
    part = _load(spark, sf_dir, "part").select("p_partkey", "p_brand")
    lines = lookup_join(_load(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_partkey").alias("p_partkey")), part, "p_partkey")
    brand = F.substring_index("p_brand", "#", -1).cast("bigint")
    brands = part.agg(F.max(brand).alias("m")).first()["m"] or 1
    cells = materialize(bipartite.link_counts(lines, F.col("l_suppkey") + 1, brand), "cells")
    num_rows, _ = _shape(spark, sf_dir)
    return bipartite.fit(
        _supply_rows(spark, sf_dir), cells, 1, LEARNING_RATE, num_rows, brands, seed=GAMMA_SEED, chunk_columns=BRAND_CHUNK
    )


def nbi_fit_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fitted_brands(spark, sf_dir).gamma.select("r", "c", _r6("g").alias("g"))


def nbi_fit_brands_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history_millions(_fitted_brands(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "csv_scan": csv_scan,
    "csv_scan_texts": csv_scan_texts,
    "csv_scan_inferred": csv_scan_inferred,
    "points_parse": points_parse,
    "matrix_unpivot": matrix_unpivot,
    "triples_parse": triples_parse,
    "tsv_roundtrip": tsv_roundtrip,
    "column_profile": column_profile,
    "global_means": global_means,
    "block_means": block_means,
    "group_count": group_count,
    "topk_groups": topk_groups,
    "aligned_count_add": aligned_count_add,
    "aligned_count_add_three": aligned_count_add_three,
    "topk_rows": topk_rows,
    "row_sum_block": row_sum_block,
    "bottomk_rowsum": bottomk_rowsum,
    "topk_rowsum": topk_rowsum,
    "preview": preview,
    "min_distance": min_distance,
    "min_distance_merged": min_distance_merged,
    "min_distance_partitioned": min_distance_partitioned,
    "min_distance_embeddings": min_distance_embeddings,
    "basket_join": basket_join,
    "dedup_subset": dedup_subset,
    "baskets": baskets,
    "freq_itemsets_type": _itemsets("p_type", 0.01),
    "freq_itemsets_brand": _itemsets("p_brand", 0.001),
    "freq_itemsets_name": _itemsets("p_name", 0.01),
    "assoc_rules_type": _rules("p_type", 0.01, 0.5),
    "assoc_rules_brand": _rules("p_brand", 0.001, 0.1),
    "itemset_counts": itemset_counts,
    "basket_predict": _predictions(0.01),
    "basket_predict_joined": _predictions(0.01, max_rule_bytes=0),
    "basket_predict_low": _predictions(0.001),
    "assoc_rules_low": _rules("p_type", 0.001, 0.5),
    "row_degree": row_degree,
    "nbi_transition": nbi_transition,
    "nbi_gamma_init": nbi_gamma_init,
    "nbi_rating_error": nbi_rating_error,
    "nbi_error_summary": nbi_error_summary,
    "nbi_gradient_step": nbi_gradient_step,
    "nbi_fit": nbi_fit,
    "nbi_fit_history": nbi_fit_history,
    "nbi_fit_all": nbi_fit_all,
    "nbi_fit_all_history": nbi_fit_all_history,
    "nbi_fit_brands": nbi_fit_brands,
    "nbi_fit_brands_history": nbi_fit_brands_history,
}
