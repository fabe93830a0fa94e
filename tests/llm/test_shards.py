import pytest
from pyspark.sql import functions as F

from flowquarry.llm.common import shared_folder
from flowquarry.llm.shards import CommitConflict, ShardStore, shard_arrivals


def test_compaction_keeps_rows_and_merges_files(spark):
    df = spark.range(0, 4000, 1, 4).selectExpr("id", "repeat(cast(id as string), 20) AS text")
    store = ShardStore(spark, shared_folder(spark), target=1 << 20, base=1 << 30)
    for k in range(5):
        store.append(df.where(f"id % 5 = {k}"))
    before = store.manifest()
    assert len(before) == 5 and sum(x.rows for x in before) == 4000
    version = store.compact()
    after = store.manifest()
    assert len(after) < 5 and sum(x.files for x in after) < sum(x.files for x in before)
    assert sorted(r.id for r in store.read().collect()) == list(range(4000))
    assert sorted(r.id for r in store.read(version - 1).collect()) == list(range(4000))  # old version still whole
    assert store.compact() is None
    assert store.vacuum() == 5 and store.versions() == [version] and store.read().count() == 4000


def test_commit_is_atomic(spark):
    folder = shared_folder(spark)
    one, two = ShardStore(spark, folder), ShardStore(spark, folder)
    one.append(spark.range(3).toDF("id"))
    with pytest.raises(CommitConflict):
        two._commit(0, [])
    assert one.read().count() == 3
    late = two._written(spark.range(9).toDF("id"))  # a writer that hasn't committed yet
    assert one.read().count() == 3 and one.vacuum() == 0
    one.append(spark.range(2).toDF("id"))
    two._added(late)  # it commits after another writer's version, and loses nothing
    assert one.read().count() == 14
    two._written(spark.range(9).toDF("id"))  # one that dies before its commit
    assert one.vacuum(grace=0) == 1 and one.read().count() == 14


def test_compaction_beside_other_writers(spark):
    folder = shared_folder(spark)
    one, two = (ShardStore(spark, folder, target=1 << 20, base=1 << 30) for _ in range(2))
    for k in range(4):
        one.append(spark.range(10 * k, 10 * k + 10).toDF("id"))
    commit = one._commit

    def overtaken(version, shards):
        one._commit = commit
        two.append(spark.range(100, 105).toDF("id"))
        commit(version, shards)

    one._commit = overtaken
    assert one.compact() is not None and sorted(r.id for r in two.read().collect()) == [*range(40), *range(100, 105)]
    for k in range(4):
        one.append(spark.range(200 + 10 * k, 210 + 10 * k).toDF("id"))

    def merged_first(version, shards):
        one._commit = commit
        two.compact()
        commit(version, shards)

    one._commit = merged_first
    assert one.compact() is None and one.read().count() == 85


def test_edge_rows(spark, edge_docs, empty_docs):
    store = shard_arrivals(edge_docs.withColumn("_arrival", F.lit(1)), F.coalesce(F.col("doc_id") % 2, F.lit(2)), 4, shared_folder(spark))
    assert "_arrival" in store.read().columns
    key = lambda df: sorted(map(str, df.collect()))
    assert key(store.read().select(edge_docs.columns)) == key(edge_docs)
    assert shard_arrivals(empty_docs, F.lit(0), 1, shared_folder(spark)).read().count() == 0
    with pytest.raises(ValueError):
        ShardStore(spark, shared_folder(spark)).read()
