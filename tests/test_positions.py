"""Positions from partition counts, the page index, label tables."""

import random

import pytest
from pyspark.sql import functions as F

from strata.operators.features import index_categoricals
from strata.operators.labels import fit_label_tables, index_by_table
from strata.operators.ranking import with_positions
from strata.operators.serve import PageIndex, build_page_index, page
from tests.conftest import rows


def test_positions_within_groups(spark):
    rng = random.Random(1)
    data = [(rng.choice(["a", "hot", "hot", "hot", None, "z"]), rng.randrange(10_000), k) for k in range(3000)]
    df = spark.createDataFrame(data, "g string, v int, k int").repartition(7)
    out = with_positions(df, [F.col("v").desc(), F.col("k").asc()], ["g"], "pos", "size")
    assert out.columns == ["g", "v", "k", "pos", "size"]
    want = []
    for g in {d[0] for d in data}:
        own = sorted((d for d in data if d[0] == g), key=lambda d: (-d[1], d[2]))
        want += [(*d, i, len(own)) for i, d in enumerate(own)]
    assert sorted(rows(out), key=str) == sorted(want, key=str)


def test_a_hot_group_is_spread(spark):
    df = spark.range(40_000).selectExpr("CASE WHEN id % 3 = 0 THEN id % 50 ELSE -1 END AS g", "id")
    out = with_positions(df, [F.col("id").asc()], ["g"], "pos")
    assert out.filter("g = -1").agg(F.count_distinct("pos"), F.max("pos")).first() == (26666, 26665)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan  # the sorted rows are read from files


def test_positions_over_all_rows_and_none(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    assert all(r[0] == r[1] for r in rows(with_positions(df, [F.col("v").asc()], position="p"), "v", "p"))
    assert with_positions(df.limit(0), [F.col("v").asc()]).collect() == []


def test_pages_equal_sorted_pages(spark, tmp):
    df = spark.range(997).select(F.concat(F.lit("A-"), F.col("id")).alias("ID"), (F.col("id") * 2).alias("v"))
    index = build_page_index(df, f"{tmp}/pages", partitions=6)
    assert index.size() == 997 and index.page(0, 1).columns == ["ID", "v"]
    for offset, limit in [(0, 1), (0, 10), (5, 400), (990, 50), (100, 0), (996, 1), (0, 5000)]:
        want = rows(page(df, offset, limit)) if limit else []
        assert rows(index.page(offset, limit)) == want, (offset, limit)
    assert rows(PageIndex(spark, f"{tmp}/pages").page(2000, 10)) == []


def test_a_deep_page_reads_as_few_rows_as_the_first(spark, tmp):
    df = spark.range(1_200_000).selectExpr("id AS ID", "id * 3 AS v")
    index = build_page_index(df, f"{tmp}/pages", partitions=12)
    read = {}
    for offset in (0, 1_000_000):
        got = index.page(offset, 10)
        read[offset] = len(got.inputFiles())
        assert [r[0] for r in rows(got)] == list(range(offset, offset + 10))
        # the place reaches the scan, so row groups without it are skipped
        assert "PushedFilters: [IsNotNull(page_place), GreaterThanOrEqual(page_place" in \
            got._jdf.queryExecution().executedPlan().toString()
    assert read[0] <= 2 and read[1_000_000] <= 2


def test_an_index_can_be_rebuilt_and_can_be_empty(spark, tmp):
    df = spark.range(50).selectExpr("id AS ID", "id AS v")
    build_page_index(df, f"{tmp}/pages", partitions=5)
    index = build_page_index(df.limit(7), f"{tmp}/pages", partitions=2)
    assert index.size() == 7 and len(rows(index.page(0, 100))) == 7
    empty = build_page_index(df.limit(0), f"{tmp}/none")
    assert empty.size() == 0 and rows(empty.page(0, 5)) == [] and empty.page(0, 5).columns == ["ID", "v"]
    with pytest.raises(ValueError):
        build_page_index(df.withColumnRenamed("v", "page_part"), f"{tmp}/clash")


def test_label_tables_index_as_the_fitted_indexer(spark):
    rng = random.Random(4)
    words = ["HOT"] * 40 + ["a", "b", "B", "é", "\U0001F600", "～", "", " "] + [f"w{k}" for k in range(60)]
    df = spark.createDataFrame([(k, rng.choice(words), None if k % 9 else "rare") for k in range(2000)],
                               "id int, City string, Note string")
    fill = {"City": "UNKNOWN", "Note": "none"}
    want, _ = index_categoricals(df, ["City", "Note"], fill, drop_sources=False)
    got = df.na.fill(fill)
    for c, table in fit_label_tables(df, ["City", "Note"], fill).items():
        got = index_by_table(got, c, table, f"{c}_index")
    names = ["id", "City", "Note", "City_index", "Note_index"]
    assert sorted(rows(got, *names)) == sorted(rows(want, *names))


def test_null_and_unseen_labels(spark):
    seen = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "c string")
    table = fit_label_tables(seen, ["c"])["c"]
    new = spark.createDataFrame([("a", 1), ("zz", 2), (None, 3)], "c string, k int")
    assert sorted(rows(index_by_table(new, "c", table, "i"), "k", "i")) == [(1, 0.0), (2, 2.0), (3, 2.0)]
    assert rows(index_by_table(new, "c", table, "i", "skip"), "k", "i") == [(1, 0.0)]
    none = fit_label_tables(seen.limit(0), ["c"])["c"]
    assert sorted(rows(index_by_table(new, "c", none, "i"), "i")) == [(0.0,)] * 3


def test_two_million_labels_with_a_hot_one(spark, tmp):
    n = 2_000_000
    df = spark.range(n + n // 2).select("id", F.when(F.col("id") < n, F.concat(F.lit("L"), F.col("id")))
                                        .otherwise(F.lit("hot")).alias("c"))
    out = index_by_table(df, "c", fit_label_tables(df, ["c"])["c"], "i")
    out.write.parquet(f"{tmp}/indexed")
    back = spark.read.parquet(f"{tmp}/indexed")
    assert back.filter("c = 'hot'").agg(F.count(F.lit(1)), F.min("i"), F.max("i")).first() == (n // 2, 0.0, 0.0)
    got = back.filter("c <> 'hot'").orderBy("i").select("c").toPandas()["c"].tolist()
    assert got == sorted(f"L{k}" for k in range(n))


def test_hot_labels_do_not_meet_in_one_join_task(spark):
    df = spark.range(30_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL "
                                              "ELSE concat('l', id) END AS c")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        out = index_by_table(df, "c", fit_label_tables(df, ["c"])["c"], "i")
        sizes = [r[0] for r in out.groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sum(sizes) == 30_000 and max(sizes) < 1500  # 600 each were even
