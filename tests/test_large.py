"""What large tables need, on small ones: how often inputs are read, what is shuffled, how large a row or a file may get."""

import json
import time
from pathlib import Path

from pyspark.sql import functions as F

from allelix.operators import publish as pub
from allelix.plans import registry
from allelix.sources import adapters, sinks
from allelix.sources.scratch import stored

DATA = "/root/testdata/sf0.001"


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")


def test_a_structural_merge_reads_the_folded_table_not_the_overlaps(spark):
    assert scans(registry.queries()["F25_structural_merge_content"](spark, DATA)) <= 4


def test_raw_points_are_folded_before_they_are_unpivoted(spark):
    """The groups of the first shuffle hold no ancestry, and rows without any frequency keep a point of their own with their own fields."""
    rows = [("rs1", "TTN", "x", "snp", "0.5", "0.25", None), ("rs1", "TTN", "x", "ins", "0.1", None, None), ("rs1", "TTN", "x", None, "0.9", "nan", "0.125")]
    df = spark.createDataFrame(rows, "MarkerID string, `snpeff.ann.gene_id` string, Phenotype string, `dbsnp.vartype` string, pval string, `gnomad_genome.af.af` string, `gnomad_genome.af.af_nfe` string").withColumn("source_file", F.lit("f"))
    found = adapters.raw_points(df, "CVD", ingested_at=F.lit(None).cast("timestamp"))
    told = {r.ancestry: (r.ancestry_af, r.variation_type, r.p_value) for r in found.collect()}
    assert told[None] == (None, "ins", 0.1) and told["Total"] == (0.25, "SNP", 0.1) and told["European"] == (0.125, "SNP", 0.1) and told["African"] == (None, "SNP", 0.1) and len(told) == 9
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("Aggregate [")


def test_raw_files_and_the_configured_job_write_as_many_files_as_there_are_partitions(spark, monkeypatch):
    """Nothing is drawn into one or two tasks."""
    asked, kind = [], type(spark.range(1))
    monkeypatch.setattr(kind, "coalesce", lambda self, n, f=kind.coalesce: asked.append((n, self.columns)) or f(self, n))
    for name in ("L1_raw_files", "N1_configured_run"):
        registry.queries()[name](spark, DATA)
    assert [x for x in asked if x[1] != ["a", "b"]] == []


def test_payloads_over_twenty_million_characters_are_read_whole(spark, tmp_path):
    rows = spark.range(2).select(F.lit("CVD").alias("dataset_type"), F.concat(F.lit("G"), F.col("id")).alias("gene_id"), F.repeat(F.lit("x"), (F.col("id") * 20_500_000 + 5).cast("int")).alias("payload_json"))
    sinks.write_payloads(rows, str(tmp_path / "p"))
    found = sinks.read_payloads(spark, str(tmp_path / "p")).select("gene_id", F.length("payload_json").alias("n")).collect()
    assert sorted(map(tuple, found)) == [("G0", 5), ("G1", 20_500_005)]


def test_a_gene_s_index_is_cut_where_it_is_too_large_for_a_row(spark, monkeypatch):
    monkeypatch.setattr(pub.chunked, "__defaults__", ("entry", 40, 8 << 20))
    from allelix.plans import jobs

    found = jobs.published(spark, DATA).payloads()["variant_index"].collect()
    sizes = [len(json.loads(r.payload_json)) for r in found]
    assert max(sizes) <= 40 and len(found) > 50
    whole = jobs.published(spark, DATA).index.count()
    assert sum(sizes) == whole


def test_a_publish_shuffles_and_writes_only_columns_that_it_reads(spark, tmp_path):
    from allelix.plans import jobs
    from allelix.plans.points import PRIORITY, points

    pub.unified(points(spark, DATA), PRIORITY, jobs.leaves(spark), jobs.paths.rollup_map(spark, jobs.TREE), jobs.meta.Manifest.of(jobs.MANIFEST), scratch=str(tmp_path / "kept"))
    columns = spark.read.parquet(str(tmp_path / "kept")).columns
    assert not {"messy", "list_text", "ancestry_text", "ancestry_source_code", "ancestry_source_label", "ci_text"} & set(columns) and {"dataset_id", "label_path", "parent_phenotype"} <= set(columns)


def test_what_is_stored_leaves_no_shuffle_files(spark):
    """Each write drops the shuffle files of its own query when it ends."""
    local = [Path(str(x)) for x in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()]
    files = lambda: {str(p) for at in local for p in at.glob("*/shuffle_*.data")}
    before, rows = files(), spark.range(9000).withColumn("k", F.col("id") % 97)
    kept = stored(rows.repartition(7, "k").groupBy("k").agg(F.sum("id").alias("n")), "small")
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert kept.count() == 97 and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert files() - before


def test_a_phenotype_map_does_not_deal_rows_by_phenotype(spark):
    """Label paths, roll-up and adapters meet their small tables where the rows lie; phenotypes are few, so by a shuffle few tasks would have all rows."""
    from allelix.operators import aggregates as ag
    from allelix.operators import paths
    from allelix.plans import jobs

    rows = spark.createDataFrame([("CVD", "1-URGENT", "c")], "dataset_type string, phenotype string, disease_category string")
    for found in (adapters.resolved(rows, jobs.types(spark)), paths.with_label_path(rows, jobs.leaves(spark)), ag.roll_up(rows, paths.rollup_map(spark, jobs.TREE))):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
