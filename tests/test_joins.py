"""Small and large sides give the same rows; no plan holds a product operator."""

from pyspark.sql import functions as F

from agrometry.operators.joins import fits_broadcast, join_checked, pair_all


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fits_broadcast_checks_rows_and_bytes(spark):
    df = spark.range(100).withColumn("text", F.repeat(F.lit("x"), 1000))
    assert fits_broadcast(df, 100)
    assert not fits_broadcast(df, 99)
    assert not fits_broadcast(df, 100, max_bytes=50_000)


def test_pair_all_small_and_large_agree(spark):
    left = spark.range(57).select(F.col("id").alias("a"), F.lit("same").alias("k"))
    right = spark.range(23).select(F.col("id").alias("b"), F.lit(None).cast("int").alias("n"))
    want = {(a, b) for a in range(57) for b in range(23)}
    for bound in (1000, 5):
        pairs = pair_all(left, right, max_rows=bound)
        assert pairs.columns == ["a", "k", "b", "n"]
        rows = pairs.collect()
        assert len(rows) == len(want) and {(r.a, r.b) for r in rows} == want
        text = plan(pairs)
        assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "BroadcastHashJoin" in plan(pair_all(left, right))


def test_large_pair_all_never_broadcasts_by_hint(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        pairs = pair_all(spark.range(1000).toDF("a"), spark.range(100).toDF("b"), max_rows=10)
        assert "Broadcast" not in plan(pairs)
        assert pairs.count() == 100_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_checked_joins_agree_with_a_hot_key(spark):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("key"), "id"
    ).union(spark.range(5).select(F.lit(None).cast("string"), "id"))
    right = spark.createDataFrame([("hot",), ("k1",), ("k7",), ("none",)], "key string")
    for how in ("left_anti", "left_semi", "inner", "left"):
        plain = sorted(map(tuple, left.join(right, "key", how).collect()), key=str)
        for bound in (100, 2):
            mine = join_checked(left, right, "key", how, max_rows=bound)
            assert mine.columns == ["key", "id"]
            assert sorted(map(tuple, mine.collect()), key=str) == plain, (how, bound)


def test_copied_sides_are_never_broadcast(spark):
    """With the default settings, as a user runs it."""
    pairs = pair_all(spark.range(40_000).toDF("a"), spark.range(100).toDF("b"), max_rows=10)
    assert "BroadcastExchange" not in plan(pairs) and "SortMergeJoin" in plan(pairs)
    checked = join_checked(spark.range(1000).toDF("k"), spark.range(50).toDF("k"), "k", "left_anti", max_rows=10)
    assert "BroadcastExchange" not in plan(checked) and "Generate" not in plan(checked)
    assert checked.count() == 950
