"""Readers, sinks and life cycle on small files."""

import gzip
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from allelix.operators import paths, qa, serving
from allelix.operators import publish as pub
from allelix.operators.meta import Bundles, Manifest, merge_names, merge_objects
from allelix.plans.jobs import MANIFEST, TREE
from allelix.plans.points import PRIORITY, points
from allelix.sources import adapters, files, sinks
from allelix.sources.store import Store

DATA = "/root/testdata/sf0.001"


def test_paths_and_listing(spark, tmp_path, monkeypatch):
    monkeypatch.setenv("PLACE", str(tmp_path))
    (tmp_path / "a.csv").write_text("x\n1\n")
    (tmp_path / "b.txt").write_text("no")
    assert files.expanded(["$PLACE", " ", "$PLACE"]) == [str(tmp_path)]
    assert [(r.name, r.bytes) for r in files.input_files(spark, "$PLACE").collect()] == [("a.csv", 4)]


def test_delimiter_of_each_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name\n1,"x;y"\n')
    (tmp_path / "b.csv").write_text("id;name;more\n2;z;m\n")
    rows = {r.id: (r.name, r.more) for r in files.sniffed(spark, str(tmp_path)).collect()}
    assert rows == {"1": ("x;y", None), "2": ("z", "m")}


def test_zip_json_maps_and_artifacts(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("in.csv", "﻿id\nä\n")
    assert [r.value for r in files.zipped_lines(spark, str(tmp_path)).collect()] == ["id", "ä"]
    (tmp_path / "e.json").write_text(json.dumps({"TTN": {"dcm": {"upregulated": 2}}, "A,B": {}}))
    rows = serving.expression_rows(files.expression_entries(spark, str(tmp_path / "e.json"))).collect()
    assert [(r.gene_id, json.loads(r.payload_json)) for r in rows] == [("TTN", {"dcm": {"up": 2.0, "down": 0.0}})]
    out = tmp_path / "art"
    out.mkdir()
    (out / "a%2Fb.json").write_text('{"v":1}')
    with gzip.open(out / "A%2FB.json.gz", "wt") as f:
        f.write('{"v":2}')
    (out / "metadata.json").write_text("{}")
    assert [(r.gene_id, r.gene_id_normalized, r.payload) for r in files.artifact_files(spark, str(out)).collect()] == [("A/B", "A/B", '{"v":2}')]
    for kind in ("cvd", "trait"):
        (tmp_path / "sga" / kind).mkdir(parents=True)
        (tmp_path / "sga" / kind / "big%20heart.json").write_text('{"G1": {"n": 1}}')
    assert sorted((r.gene_id, r.type, r["name"]) for r in files.shared_lists(spark, str(tmp_path / "sga")).collect()) == [("G1", "cvd", "big heart"), ("G1", "trait", "big heart")]
    (tmp_path / "iso.tsv").write_text("protein_id\tmax\nNP_1\t30\n\t9\n")
    assert [(r.protein_id, r.length_aa) for r in files.isoform_rows(spark, str(tmp_path / "iso.tsv")).collect()] == [("NP_1", 30)]
    (tmp_path / "seed.json").write_text('{"G1": {"gene_location": "1-2", "strand": -1, "biotype": ""}}')
    assert [tuple(r) for r in files.gene_seed(spark, str(tmp_path / "seed.json")).collect()] == [("G1", "1-2", -1, None, None)]


def test_long_layout_merges_ancestries(spark):
    rows = [
        ("G1", "rs1", "Big heart", "eur", "0.2", "0.5", "1.5", "0.9,1.1", "f"), ("G1", "rs1", "Big heart", "afr", None, "0.01", "2.5", "x", "f"), ("G1", "rs1", "Big heart", None, "0.3", None, None, None, "f"),
        ("G1", "rs1", "Big heart", "eur", "0.4", "0.5", "1.5", None, "g"),
    ]
    table = spark.createDataFrame(rows, "gene_symbol string, SNP_ID string, phenotype_description string, ancestry string, af string, pval string, `or` string, ci string, source_file string")
    found = {json.loads(r.metadata)["source_file"]: r for r in adapters.merged_long(adapters.long_rows(table)).collect()}
    meta = json.loads(found["f"].metadata)
    assert found["f"].p_value == 0.01 and found["f"].ancestry == {"European": "0.2"} and found["f"].dataset_type == "CVD" and found["f"].phenotype == "big_heart"
    assert meta["best_or"] == 2.5 and set(meta["by_ancestry"]) == {"European", "African"} and json.loads(meta["by_ancestry"]["European"]["ci"]) == {"lower": 0.9, "upper": 1.1}
    assert found["g"].ancestry == {"European": "0.4"}
    export = {r.rsid: r for r in adapters.prepared_export(adapters.merged_long(adapters.long_rows(table.where("source_file = 'f'")))).collect()}
    assert len(export["rs1"].__fields__) == 27 and json.loads(export["rs1"].ancestry_data) == {"European": {"change": "", "MAF": 0.2}} and export["rs1"].mvp_best_or == "2.5"


def test_structural_rows(spark):
    names = ["﻿Variant ID", "Study ID", "Chromosome", "Inner Start", "Start", "End", "Variant Region type", "Subject Phenotype"]
    table = spark.createDataFrame([("v1", "s", "chr07", None, "90", "10", "CNV", "a; n/a;b;a"), ("v2", "s", "1", None, None, "5", None, None)], ", ".join(f"`{n}` string" for n in names))
    (row,) = adapters.structural_rows(table).collect()
    assert (row.variant_id, row.chrom, row.start, row.end, row.variant_type, row.phenotypes) == ("v1", "7", 10, 90, "cnv", ["a", "b"])


def test_unified_publish_writes_and_serves(spark, tmp_path):
    leaves = paths.tree_tables(spark, TREE)[0]
    some = points(spark, DATA).where("gene_id in ('Brand#1', 'Brand#11', 'Brand#12')")
    found = pub.unified(some, PRIORITY, leaves, paths.rollup_map(spark, TREE), Manifest.of(MANIFEST))
    sinks.write_published(found, str(tmp_path))
    overall = spark.read.json(str(tmp_path / "final/overall"))
    payload = json.loads(overall.first().payload_json)
    assert set(payload["data"]) == {"vc", "msc", "cs", "ancestry"} and payload["pvals"] == {} and payload[pub.META_KEY]["manifest_id"] == "m1"
    association = spark.read.json(str(tmp_path / "final/association"))
    for r in association.collect():
        entries = json.loads(r.payload_json)
        key = "trait" if r.dataset_type == "TRAIT" else "disease"
        assert [e[key][-1] for e in entries] == sorted(e[key][-1] for e in entries) and all(p["data"] == sorted(p["data"], key=lambda x: x["rsid"]) for e in entries for p in e["ancestry"])
    tables = serving.build({"association": association, "overall": overall}, manifest=Manifest.of(MANIFEST))
    summary = json.loads(tables["association_summary_payloads"].first().payload_json)
    assert all("ancestry" not in e and "vc" in e and pub.META_KEY in e for e in summary)
    store = Store(spark, str(tmp_path / "serving"))
    serving.write_build(store, {k: v for k, v in tables.items() if k in ("association_gene_payloads", "overall_gene_payloads")})
    rows = spark.createDataFrame([("Brand#1", "{}"), ("NEW", "{}")], "gene_id string, payload_json string")
    for _ in range(2):
        catalog = serving.apply_secondary(store, "expression", serving.secondary_rows(rows), {"version": 2})
    assert {r.gene_id: r.has_cvd for r in catalog.where("has_expression").collect()} == {"Brand#1": True, "NEW": False} if overall.where("gene_id = 'Brand#1'").count() else True


def test_sinks_replace_and_reread(spark, tmp_path):
    record = spark.createDataFrame([("d", "CVD", "s", "G1", "rs1", "p", {"b": "1", "a": "2"})], "dataset_id string, dataset_type string, source string, gene_id string, variant_id string, phenotype string, ancestry map<string,string>")
    for _ in range(2):
        sinks.write_canonical(record, str(tmp_path / "c"))
    assert [r.ancestry for r in sinks.read_canonical(spark, str(tmp_path / "c")).collect()] == [{"a": "2", "b": "1"}]
    schema = "source string, source_file string, variant_id string"
    sinks.upsert_points(spark.createDataFrame([("s", "f1", "rs1"), ("t", "f1", "rs2"), ("s", "f2", "rs3")], schema), str(tmp_path / "p"))
    sinks.upsert_points(spark.createDataFrame([("s", "f1", "rs9")], schema), str(tmp_path / "p"))
    assert sorted(r.variant_id for r in sinks.read_points(spark, str(tmp_path / "p")).collect()) == ["rs2", "rs3", "rs9"]
    empty = adapters.prepared(spark.createDataFrame([], "MarkerID string"), "CVD", "x")
    sinks.write_prepared(empty, str(tmp_path / "e"))
    text = spark.read.option("header", True).csv(str(tmp_path / "e"))
    assert text.columns == list(adapters.PREPARED) and text.count() == 0
    sinks.write_artifacts(record.select("gene_id"), str(tmp_path / "art"), {"version": 2}, 0, 3)
    assert spark.read.json(str(tmp_path / "art/metadata.part001of003")).first().value == "2"


def test_release_registration_replaces_its_own_rows(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/a.csv").write_text("id,p\n1,2\n")
    from allelix.sources.readers import header_inventory

    registry = Store(spark, str(tmp_path / "reg"))
    for release in ("r1", "r2", "r1"):
        tables = qa.release_tables(qa.file_inventory(spark, str(tmp_path / "raw")), header_inventory(spark, str(tmp_path / "raw")), "s", release, "gwas", ["id"])
        qa.register_release(registry, tables)
    rows = registry.read("file_inventory").collect()
    assert sorted(r.release_id for r in rows) == ["r1", "r2"] and all(r.columns == ["id", "p"] and len(r.sha256) == 64 for r in rows)
    assert {r.status for r in registry.read("drift_reports").collect()} == {"compatible_with_additions"}
    report = qa.qa_report(qa.artifact_report(qa.file_inventory(spark, str(tmp_path / "raw")), F.lit("g")), qa.table_counts({"t": spark.range(3)}), qa.catalog_summary(spark.createDataFrame([("integrated", "x")], "integration_status string, data_category string")))
    found = json.loads(report.first().report_json)
    assert found["published_outputs"][0]["payload_count"] == 1 and found["tables"] == [{"table_name": "t", "row_count": 3}] and len(found["source_catalog"]) == 3


def test_manifest_configuration():
    assert merge_names(["a", " b"], ["a", "", "c"]) == ["a", "b", "c"]
    assert merge_objects([{"name": "x", "v": 1}, {}], [{"name": "x", "v": 2}, {"name": "y"}], "name") == [{"name": "x", "v": 2}, {"name": "y"}]
    found = Manifest.of(MANIFEST, {"version": 3, "promoted_fields": ["variant_id"]})
    assert found.version == 3 and found.missing(["gene_id", "dataset_id"]) == ["variant_id"]
    with pytest.raises(KeyError):
        Manifest.of({**MANIFEST, "derived_fields": [{"name": "x", "helper": "none"}]})
    own = Bundles()
    own.register("mine", lambda df, scope, params: df.groupBy(*scope).count())
    assert "mine" in own.available()


def test_labels_have_literal_values(spark):
    from allelix.functions import text as fn

    rows = spark.createDataFrame([("['Pathogenic, low penetrance', 'benign']", "xyz", "rs7-A"), ('["Likely_benign", "Pathogenic"]', " eur ", "1:5-A"), ("[drug response, association]", "", None)], "cs string, code string, marker string")
    found = rows.select(fn.significance_label(F.col("cs")), fn.ancestry_group(F.col("code")), fn.derive_rsid(F.lit(None).cast("string"), F.col("marker"))).collect()
    assert [tuple(r) for r in found] == [("benign", "XYZ", "rs7-A"), ("pathogenic", "European", "1:5"), ("association", None, None)]
    json_rows = spark.createDataFrame([('{"A": 0.5, "B": {"maf": 0.25}, "C": null, "D": {"MAF": "nan"}}',)], "j string")
    assert json_rows.select(fn.parse_ancestry(F.col("j"))).first()[0] == {"A": "0.5", "B": "0.25"}


def test_configured_ingestion_publishes(spark, tmp_path):
    from allelix.plans import ingestion

    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.csv").write_text('gene,rsid,phenotype,pval,var_class,clinical_significance,ancestry_data\nTTN,rs1,1-URGENT,0.5,snp,Benign,"{""African"": 0.25}"\nTTN,rs1,1-URGENT,0.1,indel,,\n12,rs2,x,,,,\n')
    manifests = {"prep": {"adapter": "legacy_csv", "delimiter": "comma", "default_params": {"source": "a", "dataset_id": "d"}}}
    sources = ingestion.with_defaults(manifests, [{"source": "prep", "paths": str(tmp_path / "in"), "params": {"dataset_id": "e"}}])
    assert sources[0]["params"] == {"source": "a", "dataset_id": "e"}
    leaves = paths.tree_tables(spark, TREE)[0]
    ingestion.run(spark, sources, str(tmp_path / "out"), None, leaves, paths.rollup_map(spark, TREE), priority=("a",))
    payload = json.loads(spark.read.json(str(tmp_path / "out/final/association")).first().payload_json)
    assert [e["disease"] for e in payload] == [["heart", "1-urgent"]] and payload[0]["vc"] == [{"name": "INDEL", "value": 1}]
    assert sinks.read_canonical(spark, str(tmp_path / "out/canonical")).count() == 2


def test_promoted_fields_that_points_lack_are_refused(spark):
    some = points(spark, DATA).limit(5)
    lacking = Manifest.of({**MANIFEST, "promoted_fields": ["gene_id", "cell_type"]})
    with pytest.raises(ValueError, match="cell_type"):
        pub.unified(some, PRIORITY, paths.tree_tables(spark, TREE)[0], paths.rollup_map(spark, TREE), lacking)


def test_the_variant_index_reads_each_table_once_and_deals_its_points_once(spark):
    from allelix.operators import aggregates as ag
    from allelix.operators import records as rec

    found = ag.variant_index(rec.dedup_by_source(rec.core_keys(points(spark, DATA)), PRIORITY), ["dataset_type", "gene_id", "phenotype"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 6


def test_chunks_of_a_hot_gene_are_bounded_and_whole(spark):
    """One gene with nearly all entries: chunks by number and by bytes, in order, with a footer."""
    rows = spark.range(3000).select(F.lit("CVD").alias("dataset_type"), F.when(F.col("id") < 2900, "HOT").otherwise("COLD").alias("gene_id"), F.col("id").alias("o"), F.to_json(F.struct("id", F.repeat(F.lit("x"), (F.col("id") % 50).cast("int")).alias("t"))).alias("entry"))
    for sizes in ({"per_chunk": 70}, {"chunk_bytes": 900}):
        found = pub.chunked(rows.repartition(7), ("o",), **sizes).collect()
        for gene, ids in (("HOT", range(2900)), ("COLD", range(2900, 3000))):
            chunks = sorted((r.chunk, r) for r in found if r.gene_id == gene and r.chunk >= 0)
            assert [n for n, _ in chunks] == list(range(len(chunks))) and len(chunks) > 1
            assert [e["id"] for _, r in chunks for e in json.loads(r.payload_json)] == list(ids)
            (footer,) = [r for r in found if r.gene_id == gene and r.chunk == -1]
            assert json.loads(footer.payload_json) == {"chunks": len(chunks), "entries": len(ids)}
            assert all(r.entries <= 70 if "per_chunk" in sizes else len(r.payload_json) <= 1100 for _, r in chunks)


def test_row_ids_stay_in_any_partitioning(spark):
    rows = [(f"g{i % 7}", f"rs{i % 11}", None if i % 5 else "x") for i in range(300)]
    df = spark.createDataFrame(rows, "gene string, rsid string, source_file string")
    ids = lambda x, n: sorted(r[0] for r in adapters.source_normalised(x, "s", "r").select("source_row_id").collect()) if n else sorted(r.row_id for r in qa.row_ids(x, "s", "r").collect())
    for n in (0, 1):
        assert ids(df.repartition(1), n) == ids(df.repartition(5, "rsid").sort("gene"), n) and len(set(ids(df, n))) == 300
        assert set(ids(df.where("gene = 'g1'"), n)) <= set(ids(df, n))


def test_checksums_are_streamed(spark, tmp_path):
    import hashlib

    body = bytes(range(256)) * 20_000
    (tmp_path / "big file.bin").write_bytes(body)
    (row,) = qa.file_inventory(spark, str(tmp_path)).collect()
    assert (row.sha256, row.bytes, row.name) == (hashlib.sha256(body).hexdigest(), len(body), "big file.bin")
    from allelix.sources import archives

    assert archives.digests(qa.file_inventory(spark, str(tmp_path)).drop("sha256"), block=1000).first().sha256 == row.sha256


def test_overlaps_of_any_length_are_those_of_all_pairs(spark):
    import random

    from allelix.operators import intervals as iv

    r = random.Random(1)
    one = lambda: (r.choice("ab"), s := r.randint(0, 3 * 10**8), s + r.choice([0, 1, 5000, 16383, 16384, 300_000, 5_000_000, 10**8, -1]))
    left, right = [(i, *one()) for i in range(250)], [(i, *one()) for i in range(250)]
    a = spark.createDataFrame(left, "i long, ca string, sa long, ea long")
    b = spark.createDataFrame(right, "j long, cb string, sb long, eb long")
    found = iv.overlap_join_of_any_length(a, b, ("ca", "cb"), ("sa", "sb"), ("ea", "eb"))
    expected = sorted((i, j) for i, c, s, e in left for j, d, t, f in right if c == d and s <= e and t <= f and s <= f and t <= e)
    assert sorted((x.i, x.j) for x in found.collect()) == expected and found.columns == [*a.columns, *b.columns]
    placed = iv._placed(a, "sa", "ea", "a", True).groupBy("i").count().agg(F.max("count")).first()[0]
    assert placed <= 2 * len(iv.LEVELS)
