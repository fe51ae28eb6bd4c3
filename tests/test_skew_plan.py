"""Look-ups against large dimensions leave hot keys to the adaptive planner: it splits them."""

from pyspark.sql import functions as F

from adflow.operators import sets as st

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


def test_hot_key_of_a_lookup_is_split(spark):
    old = {k: spark.conf.get(k, None) for k in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    try:
        facts = spark.range(0, 200_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("k"),
            F.md5(F.col("id").cast("string")).alias("payload"),
        )
        dim = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        for how in ("inner", "left"):
            joined = st.enrich(facts, [(dim, ["k"])], how)
            assert joined.count() == 200_000
            joined.collect()
            assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
        kept = st.semi(facts, dim, ["k"])
        kept.collect()
        assert "skew=true" in kept._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in old.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
