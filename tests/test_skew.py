"""Joins in which one key, or no key, holds a third of all rows."""

from helpers import rows
from pyspark.sql import functions as F

from tidemark import names as n
from tidemark.operators.skew import hot_keys, skew_left_join
from tidemark.operators.update import update_where_in
from tidemark.plans.insurance import claim_detail


def skewed(spark, size=9000):
    i = F.col("id")
    key = F.when(i % 3 == 0, F.lit(7)).when(i % 3 == 1, F.lit(None)).otherwise(i)
    return spark.range(size).select("id", key.cast("long").alias("fk"))


def lookup(spark):
    return spark.range(0, 9000, 2).select(F.col("id").alias("pk"), F.concat(F.lit("p"), "id").alias("name")).union(
        spark.createDataFrame([(7, "p7")], "pk long, name string")
    )


def test_only_the_hot_key_is_found(spark):
    assert rows(hot_keys(skewed(spark), "fk")) == [(7,)]
    assert hot_keys(spark.range(0).withColumnRenamed("id", "fk"), "fk").count() == 0


def test_salted_join_equals_plain_join(spark):
    left, right = skewed(spark), lookup(spark)
    salted = skew_left_join(left, right, "fk", "pk", F.col("id"), salts=8)
    plain = left.join(right, F.col("fk") == F.col("pk"), "left")
    assert salted.columns == plain.columns
    assert salted.count() == 9000
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0


def test_salted_join_spreads_rows(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        out = skew_left_join(skewed(spark), lookup(spark), "fk", "pk", F.col("id"), salts=32)
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == 9000 and max(sizes) < 9000 / 3
        plain = skewed(spark).join(lookup(spark), F.col("fk") == F.col("pk"), "left")
        sizes = [r["n"] for r in plain.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert max(sizes) >= 9000 / 3
    finally:
        for key in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"):
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "2")


def test_claim_detail_with_a_hot_policy(spark):
    claims = skewed(spark, 3000).select(
        "id", F.col("fk").alias("policyid"), F.when(F.col("id") % 100 == 0, "Y").otherwise("N").alias(n.SOFT_DELETE)
    )
    policies = lookup(spark).select(F.col("pk").alias("id"), F.col("name").alias("policynumber"))
    plain, salted = claim_detail(claims, policies), claim_detail(claims, policies, salts=16)
    assert plain.count() == 2970
    assert plain.exceptAll(salted).count() == 0 and salted.exceptAll(plain).count() == 0


def test_salted_update_equals_plain_update(spark):
    target = skewed(spark, 3000).withColumn("state", F.lit("a"))
    keys = spark.createDataFrame([(7,), (2,), (7,), (None,)], "k long")
    args = (target, keys, [(F.col("fk"), F.col("k"))], {"state": F.lit("b")})
    plain, salted = update_where_in(*args), update_where_in(*args, salts=8)
    assert plain.filter("state = 'b'").count() == 1001
    assert plain.exceptAll(salted).count() == 0 and salted.exceptAll(plain).count() == 0
