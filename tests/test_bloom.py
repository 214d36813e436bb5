"""Bloom filters of addresses, and the pages they keep from moving."""

from pyspark.sql import functions as F

from touchline.operators import bloom, frontier


def _shuffled(df):
    """What the exchanges of a plan move, as text."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line or "SortMergeJoin" in line]


def test_a_filter_holds_all_its_keys_and_few_others(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("https://site/"), "id").alias("url"))
    held = bloom.BloomFilter(keys, "url", 20_000)
    assert held.blocks == 10 and held.table.count() == 10
    asked = spark.range(60_000).select("id", F.concat(F.lit("https://site/"), "id").alias("url"))
    marked = held.mark(asked, "url", "may").cache()
    assert marked.columns == ["id", "url", "may"] and marked.count() == 60_000
    assert marked.where("id < 20000 and not may").count() == 0
    assert 0 < marked.where("id >= 20000 and may").count() < 40_000 / 200
    assert not _shuffled(held.mark(asked, "url", "may"))


def test_no_keys_null_keys_and_more_keys_than_blocks(spark, monkeypatch):
    asked = spark.createDataFrame([(1, "a"), (2, None), (3, "")], "id INT, url STRING")
    none = bloom.BloomFilter(asked.where("false"), "url", 0)
    assert [row.may for row in none.mark(asked, "url", "may").collect()] == [False] * 3
    some = bloom.BloomFilter(asked, "url", 3).mark(asked, "url", "may")
    assert {row.id: row.may for row in some.collect()} == {1: True, 2: False, 3: True}
    monkeypatch.setattr(bloom, "MOST_BLOCKS", 1)
    keys = spark.range(50_000).select(F.col("id").cast("string").alias("url"))
    full = bloom.BloomFilter(keys, "url", 50_000)
    assert full.blocks == 1 and full.mark(keys, "url", "may").where("not may").count() == 0


def test_only_repeated_pages_move(spark, monkeypatch):
    pages = spark.range(3_000).select(
        (F.col("id") % 2_900).cast("string").alias("url"), F.col("id").cast("string").alias("body"),
        F.timestamp_seconds("id").alias("fetched"),
    )
    moved = []
    plain = frontier.first_per_key
    monkeypatch.setattr(frontier, "first_per_key", lambda df, *rest: moved.append(df.count()) or plain(df, *rest))
    found = {row.url: row.body for row in frontier.one_page_per_url(pages).collect()}
    assert found == {str(n): str(n + 2_900 if n < 100 else n) for n in range(2_900)}
    assert 200 <= moved[0] < 200 + 2_800 / 100
    alone = pages.where("cast(body as int) < 2900")
    assert frontier.one_page_per_url(alone).count() == 2_900 and len(moved) == 1


def test_unwanted_pages_stay_out_of_the_join(spark):
    pages = spark.range(5_000).select(F.concat(F.lit("/p/"), "id").alias("url"), F.lit("body").alias("body"))
    wanted = pages.where("url like '%7'").select("url", F.lit("x").alias("href"))
    addresses, kept = frontier.wanted_pages(wanted.unionByName(wanted.limit(10)), pages)
    assert 500 <= kept.count() < 500 + 4_500 / 100
    assert not _shuffled(kept)
    assert frontier.with_pages(addresses, kept).count() == 510


def test_pages_are_not_broadcast_by_the_size_of_their_files(spark):
    from touchline.sources.scratch import materialize

    # A page of 20 KB takes a few bytes in a packed file: 100 MB that look like less than 10.
    pages = materialize(spark.range(5_000).select(
        F.concat(F.lit("/p/"), "id").alias("url"), F.repeat(F.lit("<td>page</td>"), 1_500).alias("body"),
    ), "pages")
    addresses = materialize(pages.selectExpr("url", "concat('/x', url) href"), "asked").where("url <> '/p/7'")
    found = frontier.with_pages(addresses, pages)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert found.columns == ["url", "href", "body"]
    assert found.agg(F.count("*"), F.sum(F.length("body")), F.min("href")).first()[:] == (4_999, 4_999 * 19_500, "/x/p/0")
