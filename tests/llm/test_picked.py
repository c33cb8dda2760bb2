"""The filter by which rows are dropped without shuffling them."""

from pyspark.sql import functions as F

from vigia.llm import textops


def test_few_innocent_rows_pass_whatever_the_number_of_lost_keys(spark):
    rows = spark.range(0, 200_000, 1, 4).select((F.col("id") * 2 + 1).alias("k"), F.lit("x").alias("_block"))
    for lost in (1, 1_000, 3_000_000):
        wanted = textops.materialize(spark.range(0, lost, 1, 8).select((F.col("id") * 2).alias("w")), "lost-keys")
        passed = textops.picked(rows, [rows["k"]], wanted, [wanted["w"]])
        assert passed.columns == ["k", "_block"] and passed.count() < 0.03 * 200_000
        textops.discard(wanted)


def test_every_wanted_row_passes_in_one_part_or_many(spark, monkeypatch):
    rows = spark.createDataFrame([(k if k % 7 else None, str(k % 11)) for k in range(30_000)], "k long, _words string")
    wanted = textops.materialize(rows.where("k is null or k % 3 = 0").select(F.col("k").alias("w"), F.col("_words").alias("v")), "wanted")
    expected = sorted(map(str, wanted.collect()))
    for most in (1 << 14, 2, 1):
        monkeypatch.setattr(textops, "PART_BLOCKS", most)
        key = [rows["k"], rows["_words"]], wanted, [wanted["w"], wanted["v"]]
        semi, anti = (textops.picked(rows, *key, how) for how in ("left_semi", "left_anti"))
        assert semi.columns == ["k", "_words"] and semi.count() + anti.count() == 30_000
        got = semi.collect()
        assert not set(expected) - {str(r).replace("k=", "w=").replace("_words=", "v=") for r in got} and len(got) < 1.05 * len(expected)
        left = textops.without(rows, wanted, *(key[0], key[2])).collect()  # rows with a null in the key stay
        assert sorted((r["k"] is not None, r["k"] or 0) for r in left) == sorted((k % 7 > 0, k if k % 7 else 0) for k in range(30_000) if k % 7 == 0 or k % 3)


def test_nothing_wanted(spark):
    rows = spark.range(10).withColumn("t", F.lit("a"))
    none = textops.materialize(rows.limit(0).select(F.col("id").alias("w")), "none")
    assert textops.without(rows, none, [rows["id"]], [none["w"]]).count() == 10
    plan = textops.picked(rows, [rows["id"]], none, [none["w"]], "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(id" not in plan


def test_rows_are_picked_before_they_are_shuffled(spark):
    """With a join too large to broadcast, what is shuffled of the rows is what the filter lets through."""
    rows = textops.materialize(spark.range(0, 50_000, 1, 4).select("id", F.concat(F.lit("text "), "id").alias("t")), "rows")
    lost = textops.materialize(spark.range(0, 500).select((F.col("id") * 7).alias("w")), "lost")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = textops.without(rows, lost, [rows["id"]], [lost["w"]])
        assert kept.count() == 49_500 and kept.columns == ["id", "t"]
        plan = kept._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    anti = plan.index("LeftAnti")
    assert "Inner" in plan[anti:] or "LeftOuter" in plan[anti:]  # the filter's join lies below the anti join
