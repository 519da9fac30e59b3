"""References to a popular key are spread over tasks without adaptive execution."""

from pyspark.sql import functions as F

from tracewright.operators.popular import join_references


def test_a_key_with_a_third_of_all_references(spark):
    n = 30_000
    i = F.col("id")
    key = F.when(i % 3 == 0, "hot").when(i % 101 == 1, F.lit(None)).when(i % 7 == 2, "none").otherwise(F.concat(F.lit("k"), i % 5000))
    refs = spark.range(n).select(F.concat(F.lit("e"), i).alias("event_id"), key.alias("blob_id"))
    targets = spark.range(5000).select(F.concat(F.lit("k"), i).alias("blob_id"), F.concat(F.lit("text "), i).alias("p")).union(
        spark.createDataFrame([("hot", "hot text")], "blob_id string, p string"))
    names = ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")
    was = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in zip(names, ("false", "32", "-1")):
            spark.conf.set(k, v)
        got = join_references(refs, targets, "blob_id", "event_id").select("*", F.spark_partition_id().alias("part")).collect()
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert len(got) == n and len({r.event_id for r in got}) == n
    for r in got:
        assert r.p == ("hot text" if r.blob_id == "hot" else None if r.blob_id in (None, "none") else "text " + r.blob_id[1:])
    sizes = {}
    for r in got:
        if r.blob_id == "hot" or r.blob_id is None:
            sizes[r.part] = sizes.get(r.part, 0) + 1
    assert len(sizes) == 32 and max(sizes.values()) < 3 * sum(sizes.values()) / 32
