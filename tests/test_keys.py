"""Surrogate keys against the plain window, and plans that must not change shape."""

import contextlib
import io
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchline.operators import keys, lookups


def plan_of(df):
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain("formatted")
    return out.getvalue()


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    names=st.lists(st.text(st.characters(codec="utf-8", exclude_characters="\x00"), max_size=4), unique=True, max_size=60),
    partitions=st.sampled_from([1, 3, 7]), offset=st.sampled_from([0, 5]),
)
def test_dense_key_equals_the_plain_window(spark, names, partitions, offset):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        df = spark.createDataFrame([(name,) for name in names], "name STRING")
        got = {tuple(row) for row in keys.dense_key(df, ["name"], "id", offset).collect()}
        number = (F.row_number().over(W.orderBy("name")) + offset).alias("id")
        assert got == {tuple(row) for row in df.select(number, "name").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)


def test_dense_key_orders_null_last_and_by_all_columns(spark):
    df = spark.createDataFrame([("b", 1), (None, 1), ("a", 2), ("a", None), ("a", 1)], "k STRING, v INT")
    got = {(row.k, row.v): row.id for row in keys.dense_key(df, ["k", "v"], "id").collect()}
    assert got == {("a", 1): 1, ("a", 2): 2, ("a", None): 3, ("b", 1): 4, (None, 1): 5}


def test_dense_key_has_no_single_task_sort(spark):
    df = spark.range(1000).select(F.col("id").alias("k"))
    plan = plan_of(keys.dense_key(df, ["k"], "id"))
    # The only window runs over slice sizes: one row per partition.
    assert plan.count("(1) Window") + plan.count(") Window [") <= 1 and "_size" in plan


def test_first_per_key_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    first = keys.first_per_key(df, ["k"], [F.col("id")])
    assert sorted(row.id for row in first.collect()) == list(range(7))
    plan = plan_of(first)
    assert plan.count("WindowGroupLimit") >= 2


def test_append_members(spark):
    dim = spark.createDataFrame([(1, "/a", "A"), (2, "/b", "B")], "id INT, href STRING, name STRING")
    names = spark.createDataFrame([("D",), ("C",)], "name STRING")
    assert sorted(tuple(r) for r in keys.append_members(dim, names, "name", "id").collect()) == [
        (3, None, "C"), (4, None, "D"),
    ]
    none = dim.where("id < 0")
    assert sorted(r.id for r in keys.append_members(none, names, "name", "id").collect()) == [1, 2]


def test_missing_members_ignore_nulls(spark):
    dim = spark.createDataFrame([("A",), (None,)], "name STRING")
    names = spark.createDataFrame([("A",), ("B",), ("B",), (None,)], "n STRING")
    missing = lookups.missing_members(names, dim, "name")
    assert [row.n for row in missing.collect()] == ["B"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert "SortMergeJoin LeftAnti" in plan_of(missing) or "SortMergeJoin" in plan_of(
            lookups.missing_members(names, dim, "name")
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_lookup_equals_the_plain_one(spark, how):
    # One key holds a third of the rows, one key has two partners, one has none.
    facts = spark.range(300).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 11).alias("fk")
    )
    dim = spark.createDataFrame([(k, f"n{k}") for k in range(10)] + [(3, "again")], "k BIGINT, name STRING")
    hot = lookups.hot_keys(facts, "fk")  # a third of the rows, over four partitions
    assert [tuple(row) for row in hot.collect()] == [("fk", "0", 7)]
    plain = lookups.lookup(facts, dim, "fk", "k", {"name": "name"}, how)
    spread = spark.createDataFrame(
        [("fk", "0", 8), ("fk", "3", 2), ("fk", "10", 3), ("other", "1", 5)], "column STRING, value STRING, ways INT"
    )
    for keys_ in (hot, spread):
        salted = lookups.lookup(facts, dim, "fk", "k", {"name": "name"}, how, hot=keys_)
        assert salted.columns == plain.columns
        assert sorted(map(tuple, salted.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_salting_spreads_the_hot_key(spark):
    facts = spark.range(3000).select("id", F.lit(7).cast("bigint").alias("fk"))
    dim = spark.createDataFrame([(7, "x")], "k BIGINT, name STRING")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        hot = lookups.hot_keys(facts, "fk")
        joined = lookups.lookup(facts, dim, "fk", "k", {"name": "name"}, hot=hot)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert sum(row["count"] for row in sizes) == 3000
        assert max(row["count"] for row in sizes) < 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", True)


def test_hot_keys_follow_the_number_of_partitions(spark):
    df = spark.range(1000).select((F.col("id") % 100).alias("a"), F.when(F.col("id") < 600, 1).alias("b"))
    assert [tuple(row) for row in lookups.hot_keys(df, "a", "b").collect()] == [("b", "1", 10)]
    spark.conf.set("spark.sql.shuffle.partitions", 200)
    try:
        found = lookups.hot_keys(df, "a", "b").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert {row.ways for row in found if row.column == "a"} == {8} and len(found) == 101
    assert {row.ways for row in found if row.column == "b"} == {480}


def test_dense_keys_are_long_unless_asked(spark):
    df = spark.createDataFrame([("x",)], "k STRING")
    assert keys.dense_key(df, ["k"], "id", 2**31).first().id == 2**31 + 1
    assert dict(keys.dense_key(df, ["k"], "id", kind="int").dtypes)["id"] == "int"


def test_collapse_takes_the_least_label_without_sorting_rows(spark):
    from touchline.operators.collapse import collapse

    rows = [(k % 5, k % 3, ["b", "a", None, "ab"][k % 4]) for k in range(60)] + [(9, None, None)]
    df = spark.createDataFrame(rows, "k INT, v INT, label STRING")
    got = collapse(df, ["k"], {"most": "v"}, {"least": "label"})
    assert "SortAggregate" not in plan_of(got)
    assert sorted(map(tuple, got.collect())) == [(k, "a", 2) for k in range(5)] + [(9, None, None)]


def _counted(spark, df):
    """df through a step that counts its rows each time they are computed."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(run, df.schema), seen


def test_dense_key_computes_its_rows_once(spark):
    rows, seen = _counted(spark, spark.range(500).selectExpr("cast(id * 7 % 500 as string) as name"))
    got = {(row.name, row.id) for row in keys.dense_key(rows, ["name"], "id").collect()}
    assert got == {(name, at + 1) for at, name in enumerate(sorted(str(n) for n in range(500)))}
    assert seen.value == 500


def test_collapse_computes_its_rows_once(spark):
    from touchline.operators.collapse import collapse, collapse_with_hot_keys

    source = spark.range(900).selectExpr("cast(id % 30 as string) k", "id % 7 v", "concat('l', id % 4) label")
    rows, seen = _counted(spark, source)
    once = sorted(map(tuple, collapse(rows, ["k"], {"most": "v"}, {"least": "label"}).collect()))
    assert seen.value == 900 and len(once) == 30
    out, hot = collapse_with_hot_keys(rows, ["k"], {"most": "v"}, ["k"], {"least": "label"})
    assert sorted(map(tuple, out.collect())) == once and hot is None and seen.value == 1800


def _exchanged(df):
    """The columns that the rows of a plan are dealt by, one entry per exchange."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)


def test_rows_collapsed_near_a_key_move_once(spark):
    from touchline.operators.collapse import collapse, collapse_near

    rows = spark.range(4000).selectExpr(
        "concat('k', id % 400) k", "id % 3 d", "id % 7 v", "nullif(concat('l', id % 4), 'l3') label", "concat('o', id % 5) o",
    )
    wanted = sorted(map(tuple, collapse(rows, ["k", "d"], {"most": "v"}, {"least": "label"}).collect()), key=repr)
    out, hot = collapse_near(rows, ["k", "d"], {"most": "v"}, "k", pick={"least": "label"})
    assert sorted(map(tuple, out.collect()), key=repr) == wanted and hot is None
    dim = spark.range(400).selectExpr("concat('k', id) key", "id as n")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        dealt = _exchanged(lookups.lookup(collapse_near(rows, ["k", "d"], {"most": "v"}, "k")[0], dim, "k", "key", {"n": "n"}))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(re.sub(r"#.*", "", by) for by in dealt) == ["_key", "k"]  # the dimension's rows and these


def test_a_hot_key_is_collapsed_before_it_is_dealt(spark):
    from touchline.operators.collapse import collapse, collapse_near

    rows = spark.range(4000).selectExpr("if(id % 2 = 0, 'hot', concat('k', id)) k", "id % 3 d", "id % 7 v")
    out, hot = collapse_near(rows, ["k", "d"], {"most": "v"}, "k")
    assert "k" not in [re.sub(r"#.*", "", by) for by in _exchanged(out)]
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, collapse(rows, ["k", "d"], {"most": "v"}).collect()))


def test_date_texts_are_read_once_each(spark):
    from touchline.functions.dates import cast_date
    from touchline.operators.collapse import date_feed, date_spine

    rows = spark.range(900).selectExpr("concat('2020-01-0', id % 9 + 1) day", "if(id % 2 = 0, 'x', '2020-01-02') other")
    feed = date_feed(rows, [F.col("day"), F.col("other")], None, cast_date)
    spine = date_spine([feed])
    assert sorted(row.date_id for row in spine.collect()) == [20200101 + day for day in range(9)]
    plan = spine._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan[plan.index("explode"):]  # below the rows' own aggregation no text is read


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_keys_sketched_while_rows_are_written_are_those_counted(spark, kind):
    key = F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") + 100).cast(kind)
    df, seen = _counted(spark, spark.range(3000).select("id", key.alias("fk")))
    table, hot = lookups.with_hot_keys(df, "rows", "fk", "id")
    assert seen.value == 3000  # no pass of its own
    assert [tuple(row) for row in hot.collect()] == [("fk", "5", 6)] == [tuple(row) for row in lookups.hot_keys(table, "fk").collect()]
    assert sorted(map(tuple, table.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)


def test_no_rows_have_no_hot_keys(spark):
    none = spark.range(10).join(spark.range(20, 30), "id").select("id")
    table, hot = lookups.with_hot_keys(none, "rows", "id")
    assert hot is None and table.count() == 0 and lookups.hot_keys(none, "id").count() == 0


def _joins(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"(\w+Join) \[", plan)


def test_many_rows_in_small_files_are_not_broadcast(spark):
    from touchline.sources.scratch import materialize

    def dim(n):
        rows = spark.range(n).selectExpr("id", "concat('/player/spieler/', id) href")
        return materialize(rows.repartitionByRange(4, "href"), "dim")

    facts = spark.range(300_000).selectExpr("id", "concat('/player/spieler/', id % 70000) fk")
    few, many = dim(1_000), dim(60_000)  # packed, both are far below Spark's limit of 10 MB
    for table, join in ((few, "BroadcastHashJoin"), (many, "SortMergeJoin")):
        found = lookups.lookup(facts, table, "fk", "href", {"player": "id"})
        assert _joins(found) == [join]
        assert found.where("fk = concat('/player/spieler/', player)").count() == facts.join(table, facts.fk == table.href).count()
        missing = lookups.missing_members(facts.select("fk"), table, "href")
        assert _joins(missing) == [join] and missing.columns == ["fk"]
        assert missing.count() == missing.distinct().count() == 70_000 - table.count()
    hot = spark.createDataFrame([("fk", "/player/spieler/5", 3)], "column string, value string, ways int")
    spread = lookups.lookup(facts, many, "fk", "href", {"player": "id"}, hot=hot)
    assert _joins(spread)[0] == "SortMergeJoin" and spread.count() == 4 * 60_000 + 20_000


def test_names_are_distinct_before_they_are_compared(spark):
    dim = spark.range(60_000).selectExpr("concat('n', id) name")
    names = spark.range(1_000).selectExpr("concat(' x', id % 10) name")
    missing = lookups.missing_members(names, dim, "name").selectExpr("trim(name) name").distinct()
    plan = missing._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [name" in plan[plan.index("LeftAnti"):].split("Range (0, 1000")[0]
    assert sorted(row.name for row in missing.collect()) == [f"x{n}" for n in range(10)]


def test_rows_are_known_where_tables_are_written(spark):
    from touchline.sources import scratch

    assert scratch.rows_of(keys.dense_key(spark.range(30).selectExpr("id k"), ["k"], "n")) == 30
    assert scratch.rows_of(scratch.materialize(spark.range(7), "some", watch={})) == 7
    assert scratch.rows_of(scratch.materialize(spark.range(7).where("id > 9"), "none", watch={})) == 0
    rows, seen = _counted(spark, spark.range(50))
    assert [scratch.rows_of(rows), scratch.rows_of(rows), seen.value] == [50, 50, 50]
