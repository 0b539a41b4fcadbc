"""Fixed schemas: canonical records and association points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CANONICAL = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("dataset_id", "dataset_type", "source", "gene_id", "variant_id", "phenotype", "disease_category", "variation_type", "clinical_significance", "most_severe_consequence")]
    + [T.StructField("p_value", T.DoubleType()), T.StructField("pmid", T.StringType()), T.StructField("ancestry", T.MapType(T.StringType(), T.StringType())), T.StructField("metadata", T.StringType())]
)
POINTS = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("dataset_id", "dataset_type", "source", "gene_id", "variant_id", "phenotype", "disease_category", "variation_type", "clinical_significance", "most_severe_consequence")]
    + [T.StructField("p_value", T.DoubleType()), T.StructField("ancestry", T.StringType()), T.StructField("ancestry_af", T.DoubleType())]
    + [T.StructField(c, T.StringType()) for c in ("ancestry_source_code", "ancestry_source_label", "phenotype_key", "source_file")]
    + [T.StructField("ingested_at", T.TimestampType())]
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """`df` with exactly the schema's columns; missing ones are null, so older tables can be read."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
