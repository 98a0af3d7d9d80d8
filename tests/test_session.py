from pollfold.session import TARGET_PARTITION_BYTES, shuffle_partitions, tune
from pollfold.sources.storage import cut_lineage, scratch_path, shared_folder


def test_partitions_follow_the_shuffle_size():
    assert shuffle_partitions(0, 8) == 16
    assert shuffle_partitions(1000 * TARGET_PARTITION_BYTES + 1, 8) == 1001


def test_tune(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    tune(spark)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_intermediate_tables_go_to_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == named.rstrip("/")
    assert scratch_path(spark, "x").startswith(named) and scratch_path(spark, "x") != scratch_path(spark, "x")
    assert named in spark.sparkContext.getCheckpointDir()
    assert cut_lineage(spark.range(3)).count() == 3
