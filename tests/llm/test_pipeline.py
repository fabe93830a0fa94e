import corpus_pipeline
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_stages_filter_and_pack(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.withColumn("score", F.lit("clash")).withColumn("row", F.lit(1))
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language ID", "quality rules", "n-gram Jaccard join", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, extra, SF)
        assert out.columns == extra.columns, name
        assert 0 < out.count() <= docs.count()
        assert stage(spark, extra.limit(0), SF).count() == 0
    packed = corpus_pipeline.run(spark, SF)
    assert packed.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m")).where("n <> m").count() == 0
    assert packed.select("doc_id").distinct().count() < docs.count()
