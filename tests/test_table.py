import pytest

from brindle.functions import column_block, nan_to_null
from brindle.operators import table

NAN = float("nan")


@pytest.fixture(scope="module")
def creatures(spark):
    rows = [
        (1, "a", "fire", "air", 10.0, 1.0, 0.5),
        (2, "b", "fire", None, 30.0, NAN, 2.0),
        (3, "c", "water", "fire", None, None, NAN),
        (4, None, None, "air", 20.0, 4.0, 0.25),
        (5, "e", "rock", "air", 30.0, 0.5, 0.5),
    ]
    schema = (
        "id INT, name STRING, type_1 STRING, type_2 STRING, "
        "total DOUBLE, against_x DOUBLE, against_y DOUBLE"
    )
    return nan_to_null(spark.createDataFrame(rows, schema)).cache()


def rows_of(frame):
    return [tuple(r) for r in frame.collect()]


def test_profile_counts_missing_values(creatures):
    assert sorted(rows_of(table.column_profile(creatures))) == [
        (0, "id", 5, "int"),
        (1, "name", 4, "string"),
        (2, "type_1", 4, "string"),
        (3, "type_2", 4, "string"),
        (4, "total", 4, "double"),
        (5, "against_x", 3, "double"),
        (6, "against_y", 4, "double"),
    ]


def test_means_skip_missing_values(creatures):
    assert rows_of(table.column_means(creatures, ["total"])) == [("total", 22.5)]
    means = dict(rows_of(table.block_means(creatures, 5, 7)))
    assert means == {"against_x": pytest.approx(5.5 / 3), "against_y": pytest.approx(3.25 / 4)}


def test_block_is_half_open(creatures):
    assert column_block(creatures, 4, 6) == ["total", "against_x"]


def test_group_count_drops_null_keys_and_null_values(creatures):
    counts = table.group_count(creatures, "type_1", "name")
    assert rows_of(counts) == [("fire", 2), ("rock", 1), ("water", 1)]
    counts = table.group_count(creatures, "type_2", "name")
    assert rows_of(counts) == [("air", 2), ("fire", 1)]


def test_aligned_add_is_null_unless_both_sides_have_the_key(creatures):
    added = table.aligned_count_add(creatures, "type_1", "type_2", "name")
    assert rows_of(added) == [("air", None), ("fire", 3), ("rock", None), ("water", None)]


def test_aligned_add_with_fill_value(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2)], "key STRING, n INT")
    right = spark.createDataFrame([("b", 5), ("c", 7)], "key STRING, n INT")
    assert rows_of(table.aligned_add(left, right, "key", "n", fill_value=0)) == [
        ("a", 1), ("b", 7), ("c", 7),
    ]


def test_row_sum_counts_missing_as_zero(creatures):
    summed = table.with_row_sum(creatures, 5, 7, "against_all")
    assert dict(rows_of(summed.select("id", "against_all"))) == {
        1: 1.5, 2: 2.0, 3: 0.0, 4: 4.25, 5: 1.0,
    }
    assert summed.columns[-1] == "against_all"


def test_row_sum_takes_nan_as_missing(spark):
    frame = spark.createDataFrame([(NAN, 2.0), (NAN, NAN)], "a DOUBLE, b DOUBLE")
    assert sorted(r["s"] for r in table.with_row_sum(frame, 0, 2, "s").collect()) == [0.0, 2.0]


def test_missing_values_sort_last_in_both_directions(creatures):
    down = table.top_rows(creatures, "total", 10, ["id"]).select("id")
    up = table.top_rows(creatures, "total", 10, ["id"], ascending=True).select("id")
    assert [r[0] for r in down.collect()] == [2, 5, 4, 1, 3]
    assert [r[0] for r in up.collect()] == [1, 4, 2, 5, 3]


def test_top_groups_break_ties_by_key(creatures):
    assert rows_of(table.top_groups(creatures, "type_1", "id", 2)) == [("fire", 2), ("rock", 1)]


def test_preview(creatures):
    assert [r["id"] for r in table.preview(creatures, ["id"], 2).collect()] == [1, 2]


def test_top_rows_plan_never_sorts_the_whole_table(creatures):
    plan = table.top_rows(creatures, "total", 3, ["id"])._jdf.queryExecution().toString()
    assert "TakeOrderedAndProject" in plan


def test_nan_is_missing_in_every_operator(spark):
    nan = float("nan")
    rows = spark.createDataFrame([(1.0, "a", 1), (nan, "a", 2), (None, "b", 3), (5.0, "b", 4)], "x DOUBLE, k STRING, n INT")
    assert [r["non_null"] for r in table.column_profile(rows).orderBy("position").collect()] == [2, 4, 4]
    assert {r["column"]: r["mean"] for r in table.column_means(rows, ["x", "n"]).collect()} == {"x": 3.0, "n": 2.5}
    assert [(r["k"], r["n"]) for r in table.group_count(rows, "k", "x").collect()] == [("a", 1), ("b", 1)]
    by_number = [(r["x"], r["n"]) for r in table.group_count(rows, "x", "n").collect()]
    assert by_number == [(1.0, 1), (5.0, 1)]
    for ascending, want in ((True, [1, 4, 2, 3]), (False, [4, 1, 2, 3])):
        assert [r["n"] for r in table.top_rows(rows, "x", 4, ["n"], ascending).collect()] == want


def test_several_counts_are_aligned_in_one_shuffle(spark):
    nan = float("nan")
    rows = [(1, 2.0, 1, "a"), (1, 1.0, 2, None), (2, nan, None, "b"), (None, 2.0, 1, "c"), (3, 1.0, 3, "d")]
    table_ = spark.createDataFrame(rows, "a int, b double, c bigint, t string")
    found = table.aligned_counts_add(table_, ["a", "b", "c"], "t")
    plan = found._jdf.queryExecution().executedPlan().toString()
    # 1: a has one name (of two rows), b one of two, c two; 2: b has two names, a and c one each, of which one is missing; b lacks 3
    assert [tuple(r) for r in found.collect()] == [(1.0, 4), (2.0, 3), (3.0, None)]
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert table.aligned_counts_add(table_.where("false"), ["a", "c"], "t").collect() == []
