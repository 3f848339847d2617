"""Session helpers: cluster sizing, spreading thin scans, shared tables, checkpoints."""

from __future__ import annotations

from pyspark.sql import functions as F

from relevo.session import cluster_conf, materialize, shared_table, spread


def test_cluster_conf_sizes_partitions_from_input():
    conf = cluster_conf(100 * 2**40, 8000)
    # map and reduce partitions stay few enough for the driver to track
    assert int(conf["spark.sql.shuffle.partitions"]) == 50_000
    assert int(conf["spark.sql.files.maxPartitionBytes"]) == 1 << 30
    assert int(cluster_conf(10 * 2**40, 800)["spark.sql.shuffle.partitions"]) == 10_240
    assert conf["spark.sql.autoBroadcastJoinThreshold"] == "-1"
    assert int(conf["spark.sql.adaptive.autoBroadcastJoinThreshold"]) == 64 << 20
    assert conf["spark.sql.adaptive.forceOptimizeSkewedJoin"] == "true"
    # small inputs still get three waves of tasks
    assert int(cluster_conf(1 << 20, 64)["spark.sql.shuffle.partitions"]) == 192


def test_spread_only_repartitions_thin_inputs(spark):
    thin = spark.range(0, 100, numPartitions=1)
    wide = spark.range(0, 100, numPartitions=64)
    assert spread(thin, 8).rdd.getNumPartitions() == 8
    assert spread(wide, 8) is wide
    assert sorted(r.id for r in spread(thin, 8).collect()) == list(range(100))


def test_shared_table_round_trips_and_drops_partitioning(spark):
    df = spark.range(0, 1000).withColumn("k", F.col("id") % 7).repartition(4, "k")
    table = shared_table(df, "t")
    assert sorted(tuple(r) for r in table.collect()) == sorted(tuple(r) for r in df.collect())
    # read back from files the table carries no hash partitioning (a later join on k gets its own
    # exchange, which AQE can split); a checkpoint of a non-adaptive plan keeps the partitioning
    def partitioning(d):
        return d._jdf.queryExecution().executedPlan().outputPartitioning().toString()

    assert "hashpartitioning" not in partitioning(table)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plain = spark.range(0, 1000).withColumn("k", F.col("id") % 7).repartition(4, "k")
        assert "hashpartitioning" in partitioning(materialize(plain))
        assert "hashpartitioning" not in partitioning(shared_table(plain, "t2"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_materialize_checkpoints(spark):
    df = spark.range(0, 50).withColumn("x", F.col("id") * 2)
    out = materialize(df)
    assert out.count() == 50
    assert "ExistingRDD" in out._jdf.queryExecution().executedPlan().toString() or \
        "Scan" in out._jdf.queryExecution().executedPlan().toString()
