import corpus_pipeline
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_the_last_encodes_what_is_left(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, given = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, DATA).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns, name
        assert name == "mixing" or docs.count() > 0.5 * given, name
    out = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert out.count() == docs.count() and out.where(F.size("ids") > 0).count() > 0
