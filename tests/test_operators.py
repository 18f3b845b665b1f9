"""De-duplication, matching, casts and keys on small literal frames."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from starmill.functions.casts import as_text, typed
from starmill.operators.dedup import keep_one, require
from starmill.operators import keys as key_rules
from starmill.operators.keys import Ranges, spread_key, surrogate_key
from starmill.operators.matching import keep_matching, orphan_keys


def test_keep_one_groups_null_keys(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), (None, 4), (None, 3)], "k string, v int")
    assert rows(keep_one(df, ["k"])) == [("a", 1), (None, 3)]


def test_keep_one_prefers(spark):
    df = spark.createDataFrame(
        [("a", None, 1), ("a", "o", 2), ("b", None, 1)], "k string, o string, n int"
    )
    assert rows(keep_one(df, ["k"], ["n"])) == [("a", None, 1), ("b", None, 1)]
    assert rows(keep_one(df, ["k"], [F.col("o").isNull()])) == [("a", "o", 2), ("b", None, 1)]


def test_keep_one_does_not_depend_on_row_order(spark):
    data = [(i % 7, random.Random(i).randrange(5), str(i % 11)) for i in range(500)]
    results = []
    for seed in range(3):
        shuffled = data[:]
        random.Random(seed).shuffle(shuffled)
        df = spark.createDataFrame(shuffled, "k int, a int, b string").repartition(3 + seed)
        results.append(rows(keep_one(df, ["k"], ["b"])))
    assert results[0] == results[1] == results[2]
    brute = {}
    for k, a, b in data:
        brute[k] = min(brute.get(k, (b, a)), (b, a))
    assert results[0] == sorted(((k, a, b) for k, (b, a) in brute.items()), key=str)


def test_require(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", None)], "k string, v int")
    assert rows(require(df, "k", "v")) == [("a", 1)]


def test_orphans_report_null(spark):
    left = spark.createDataFrame([("a",), (None,), ("b",), ("b",)], "k string")
    right = spark.createDataFrame([("a",), (None,)], "other string")
    assert rows(orphan_keys(left, right, "k", "other")) == [("b",), (None,)]


def test_keep_matching_never_multiplies(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    right = spark.createDataFrame([("a",), ("a",)], "k string")
    assert rows(keep_matching(left, right, "k")) == [("a", 1)]
    unique = right.distinct()
    assert rows(keep_matching(left, unique, "k")) == rows(left.join(unique, "k"))


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_unreadable_text_becomes_null(spark, settings, ansi):
    settings(spark__sql__ansi__enabled=ansi)
    df = spark.createDataFrame([("", "q", "junk", "1.5"), ("7", "2", "2018-01-02", "3")],
                               "i string, d string, t string, f string")
    result = typed(df, i="int", d="double", t="date", f="double")
    first, second = result.orderBy("f").collect()
    assert tuple(first) == (None, None, None, 1.5)
    assert tuple(second)[:2] == (7, 2.0) and str(second.t) == "2018-01-02"
    assert as_text(result).schema.simpleString() == "struct<i:string,d:string,t:string,f:string>"


@pytest.fixture(scope="module")
def many(spark):
    data = [(i * 7919 % 1000, str(i * 31 % 97), i) for i in range(3000)]
    data += [(None, str(i), -i) for i in range(50)]
    return spark.createDataFrame(data, "a int, b string, c int")


def test_ranged_key_equals_global_window(spark, settings, many):
    settings(
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="13",
    )
    keys = ["a", "b", "c"]
    ranged = surrogate_key(many.repartition(5), "sk", keys)
    spread = ranged.select(F.col("sk")).agg(F.min("sk"), F.max("sk"), F.count_distinct("sk"))
    assert tuple(spread.first()) == (1, 3050, 3050)
    assert rows(ranged) == rows(surrogate_key(many, "sk", keys, method="global"))


def test_ranged_key_spreads_a_frequent_leading_key(spark, settings):
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("a"),
        F.col("id").alias("b"),
    )
    keyed = surrogate_key(df, "sk", ["a", "b"])
    assert rows(keyed) == rows(surrogate_key(df, "sk", ["a", "b"], method="global"))
    placed = df.repartitionByRange("a", "b").withColumn("p", F.spark_partition_id())
    assert placed.where("a = 'hot'").select("p").distinct().count() > 1


def test_key_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "a string, b int")
    assert rows(surrogate_key(empty, "sk", ["a"])) == []


def test_key_keeps_wanted_columns(many):
    assert surrogate_key(many, "sk", ["a", "b", "c"], keep=["b"]).columns == ["sk", "b"]
    with pytest.raises(ValueError):
        surrogate_key(many, "sk", ["a"], method="other")


def test_text_and_numeric_order(spark):
    df = spark.createDataFrame([("1",), ("2",), ("10",)], "t string").withColumn(
        "n", F.col("t").cast("int")
    )
    by_text = surrogate_key(df, "sk", ["t"]).orderBy("sk")
    by_number = surrogate_key(df, "sk", ["n"]).orderBy("sk")
    assert [r.t for r in by_text.collect()] == ["1", "10", "2"]
    assert [r.t for r in by_number.collect()] == ["1", "2", "10"]


def ordered(spark, rows=20_000):
    """Rows with NULL, repeated and hot leading keys."""
    lead = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 11 > 0, (F.col("id") * 7919 % 997).cast("string"))
    return spark.range(rows).select(lead.alias("k"), (F.col("id") % 13).alias("n"), F.col("id").alias("w"))


@pytest.mark.parametrize("count", [1, 2, 7, 200])
def test_spread_keys_equal_one_window(spark, count):
    df = ordered(spark)
    ranges = Ranges.of(df, ["k", "n"], count)
    assert count // 2 < ranges.count <= count
    found, total = spread_key(df, "sk", ["k", "n", "w"], ranges, keep=["w"], first=5)
    expected = surrogate_key(df, "sk", ["k", "n", "w"], ["w"], method="global").withColumn("sk", F.col("sk") + 4)
    assert total == 20_000
    assert found.exceptAll(expected).count() == 0 and expected.exceptAll(found).count() == 0


def test_spread_keys_do_not_sample_or_stage_the_rows(spark, monkeypatch):
    """Ranges are fixed beforehand, and only counts are written."""
    staged = []
    write = key_rules.stage
    monkeypatch.setattr(key_rules, "stage", lambda df, *more: staged.append(df.columns) or write(df, *more))
    df = ordered(spark)
    found, _ = spread_key(df, "sk", ["k", "n", "w"], Ranges.of(df.select("k"), ["k"], 6))
    assert staged == [["k"], ["_range", "_rows"]]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and plan.count("REPARTITION_BY_NUM") == 1
    # A hot leading key makes a large range, never wrong keys.
    assert found.select("sk").distinct().count() == 20_000


def test_spread_keys_of_nothing(spark):
    df = ordered(spark).where("w < 0")
    found, total = spread_key(df, "sk", ["k", "w"], Ranges.of(df, ["k"], 4))
    assert found.collect() == [] and total == 0


def test_number_of_ranges(spark, monkeypatch):
    assert key_rules.range_count(spark, 0) == key_rules.range_count(spark, 100) == 1
    assert key_rules.range_count(spark, 10**12) == key_rules.MOST_RANGES
    monkeypatch.setattr(key_rules, "RANGE_ROWS", 1000)
    assert key_rules.range_count(spark, 50_000) == 50
