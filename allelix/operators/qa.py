"""Quality and life cycle: field profiles, release registration, artifact reports, gene lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from allelix.functions import text as fn
from allelix.operators import records as rec
from allelix.sources import archives
from allelix.sources.store import Store, Upsert

# Fields that each kind of dataset requires or may have; (field, required, strategy, marker).
PROFILES = {
    "association": (("gene_id", True, "exclude", ""), ("variant_id", True, "exclude", ""), ("phenotype", True, "exclude", ""), ("p_value", False, "allow", ""), ("clinical_significance", False, "unknown", "Unknown"), ("most_severe_consequence", False, "unknown", "Unknown"), ("variation_type", False, "unknown", "Unknown")),
    "structural_variant": (("gene_id", True, "exclude", ""), ("variant_id", True, "exclude", ""), ("variation_type", True, "unknown", "Unknown"), ("phenotype", False, "unknown", "Unknown")),
    "expression": (("gene_id", True, "exclude", ""), ("phenotype", True, "unknown", "Unknown")),
    "single_cell": (("gene_id", True, "exclude", ""), ("metadata.cell_type", True, "exclude", ""), ("phenotype", False, "unknown", "Unknown")),
}


def validate_profile(df: DataFrame, profile: str) -> DataFrame:
    """`df` checked by a profile's policies; a dotted field is looked up in the JSON column before the dot."""
    flat, names = df, {}
    for field, *_ in PROFILES[profile]:
        head, _, rest = field.partition(".")
        if rest:
            names[field] = f"{head}_{rest.replace('.', '_')}"
            flat = flat.withColumn(names[field], F.get_json_object(head, f"$.{rest}"))
        elif field not in flat.columns:
            flat = flat.withColumn(field, F.lit(None).cast("string"))
    return rec.validate(flat, [(names.get(f, f), *rest) for f, *rest in PROFILES[profile]])


def row_ids(df: DataFrame, source: str, release: str) -> DataFrame:
    """`df` with row_id from source, release and the row's content; repeats of a row are numbered. The same rows get the same ids in any run
    and any partitioning, which a running number over the table would not give."""
    sha = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}), 256)
    rows = df.withColumn("__sha", sha)
    number = F.row_number().over(Window.partitionBy("__sha").orderBy(F.lit(1)))
    return rows.withColumn("row_id", F.concat_ws(":", F.lit(source), F.lit(release), "__sha", number.cast("string"))).drop("__sha")


def file_inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(file, name, bytes, sha256) of files. A file is digested as a stream in its task, so it may have any size; where only Spark can open the
    path its bytes are one row, of 2 GB at most."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    told = [F.col("path").alias("file"), F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes")]
    if not archives.opens(spark, path):
        return files.select(*told, F.sha2("content", 256).alias("sha256"))
    listed = files.select(*told)
    return listed.join(archives.digests(listed.repartition("file")), "file")


def release_tables(inventory: DataFrame, headers: DataFrame, source: str, release: str, modality: str, expected: Sequence[str] = (), groups: Sequence[Sequence[str]] = ()) -> dict[str, DataFrame]:
    """The registry row, file inventory and drift report of a release; `headers` is (file, delimiter, columns, fingerprint)."""
    key = [F.lit(source).alias("source_id"), F.lit(release).alias("release_id"), F.lit(modality).alias("modality")]
    drift = rec.drift_of_groups(headers, groups) if groups else rec.drift(headers, expected)
    files = inventory.join(headers, "file", "left")
    return {
        "release_registry": files.agg(F.count("*").alias("file_count"), F.sum("bytes").alias("bytes")).select(*key, "file_count", "bytes"),
        "file_inventory": files.select(*key, "file", "name", "bytes", "sha256", "columns", "fingerprint", "delimiter"),
        "drift_reports": drift.select(*key, "file", "status", "columns", "added", "removed"),
    }


RELEASE = ("source_id", "release_id", "modality")


def register_release(store: Store, tables: dict[str, DataFrame]) -> int:
    """Write a release's tables in one version; rows of the same source, release and modality are replaced in all of them, all others stay, also where
    the release now has no rows in a table."""
    commit = store.begin()
    own = commit.write("release_registry", Upsert(tables["release_registry"], RELEASE))
    for name, df in tables.items():
        if name != "release_registry":
            commit.write(name, Upsert(df, RELEASE, own.select(*RELEASE)))
    return commit.publish()


def catalog_summary(manifests: DataFrame) -> DataFrame:
    """(kind, name, n): sources by integration status and by category, blank categories as uncategorized, and in all."""
    status = manifests.groupBy(F.lit("status").alias("kind"), F.col("integration_status").alias("name")).agg(F.count("*").alias("n"))
    category = F.coalesce(F.nullif(fn.strip(F.col("data_category")), F.lit("")), F.lit("uncategorized"))
    by_category = manifests.groupBy(F.lit("category").alias("kind"), category.alias("name")).agg(F.count("*").alias("n"))
    return status.unionByName(by_category).unionByName(manifests.agg(F.count("*").alias("n")).select(F.lit("total").alias("kind"), F.lit("all").alias("name"), "n"))


def group_of(path: Column, root: str) -> Column:
    """The two folders below `root` that a payload file lies in, null if it lies elsewhere."""
    return F.nullif(F.regexp_extract(path, r"/\Q" + root.strip("/").rpartition("/")[2] + r"\E/([^/]+/[^/]+)/[^/]+$", 1), F.lit(""))


def artifact_report(files: DataFrame, group: Column, samples: int = 5) -> DataFrame:
    """(group, payload_count, total_bytes, sample_checksums): counts and sizes by group, checksums of the first files by name."""
    rows = files.withColumn("group", group).where("group is not null")
    first = rows.withColumn("__n", F.row_number().over(Window.partitionBy("group").orderBy("file"))).where(F.col("__n") <= samples)
    checks = first.groupBy("group").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("file", "sha256")))).alias("sample_checksums"))
    return rows.groupBy("group").agg(F.count("*").alias("payload_count"), F.sum("bytes").alias("total_bytes")).join(checks, "group")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of named tables, in one plan."""
    out = None
    for name, df in sorted(tables.items()):
        part = df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = part if out is None else out.unionByName(part)
    return out


def qa_report(artifacts: DataFrame, counts: DataFrame, catalog: DataFrame) -> DataFrame:
    """One row with the whole report as JSON: published groups, table sizes, source catalog."""
    listed = lambda df: df.agg(F.array_sort(F.collect_list(F.to_json(F.struct(*df.columns)))).alias("x")).select(F.concat(F.lit("["), F.array_join("x", ","), F.lit("]")).alias("x"))
    parts = [listed(df).withColumnRenamed("x", n) for n, df in (("published_outputs", artifacts), ("tables", counts), ("source_catalog", catalog))]
    row = parts[0].crossJoin(parts[1]).crossJoin(parts[2])
    return row.select(F.concat(*[F.lit(f'{"{" if i == 0 else ","}"{n}":') if x == 0 else F.col(n) for i, n in enumerate(("published_outputs", "tables", "source_catalog")) for x in (0, 1)], F.lit("}")).alias("report_json"))


def candidate_genes(tables: Sequence[DataFrame], columns: Sequence[str] = ("gene_id", "gene", "gene_symbol")) -> DataFrame:
    """(gene_id): distinct genes in upper case of the first table that has one of the columns, gene-like ones only."""
    for df in tables:
        for c in columns:
            if c in df.columns:
                return df.where(fn.is_gene(F.col(c))).select(F.upper(fn.strip(F.col(c))).alias("gene_id")).distinct()
    raise ValueError(f"no table has any of the columns {', '.join(columns)}")
