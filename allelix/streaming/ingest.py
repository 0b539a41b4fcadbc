"""Resumable ingest: files seen once are not read again, and a repeated batch changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from allelix.operators import aggregates as ag
from allelix.sources.sinks import upsert_points


def ingest_files(spark: SparkSession, incoming: str, schema, target: str, checkpoint: str) -> None:
    """Take in all new Parquet files under `incoming`, then stop. The checkpoint remembers files; the upsert makes a redo harmless."""
    stream = spark.readStream.schema(schema).parquet(incoming)
    query = stream.writeStream.foreachBatch(lambda batch, _: upsert_points(batch, target)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def refresh_genes(points: DataFrame, changed: DataFrame, published: DataFrame, scope=("dataset_type", "gene_id")) -> DataFrame:
    """Published counters with the genes of `changed` counted anew from all their points; summing batches would count variants twice."""
    genes = changed.select(*scope).distinct()
    new = ag.aggregate_variants(points.join(genes, list(scope), "left_semi"), list(scope))
    return published.join(genes, list(scope), "left_anti").select(new.columns).unionByName(new)
