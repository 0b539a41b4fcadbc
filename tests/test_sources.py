import gzip

from allelix.sources import adapters, readers, sinks
from allelix.streaming import ingest


def test_delimited_inventory_and_short_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text('MarkerID,pval,gene,Phenotype\nrs1-A,0.5,NEDD9,"x, y"\nrs2-C,,,z\nrs3\n')
    (tmp_path / "b.csv").write_text("MarkerID\tpval\tgene\tPhenotype\nrs4-A\t0.1\tTTN\tq\n")
    found = {r.delimiter: r for r in readers.header_inventory(spark, str(tmp_path)).collect()}
    assert set(found) == {",", "\t"} and found[","].columns == ["MarkerID", "pval", "gene", "Phenotype"]
    rows = adapters.gwas(readers.delimited(spark, [str(tmp_path / "a.csv")])).collect()
    assert [(r.variant_id, r.gene_id, r.p_value) for r in rows] == [("rs1", "NEDD9", 0.5)]


def test_gtf(spark, tmp_path):
    lines = '#!x\n1\tsrc\tgene\t5\t90\t.\t+\t.\tgene_id "G1.2"; gene_name "AA";\n1\tsrc\texon\t5\t9\t.\t-\t.\tgene_id "G1.2"; transcript_id "T1.1"; exon_number "2"; tag "a"; tag "b";\n'
    with gzip.open(tmp_path / "x.gtf.gz", "wt") as f:
        f.write(lines)
    rows = {r.feature: r for r in readers.gtf(spark, str(tmp_path / "x.gtf.gz")).collect()}
    assert rows["gene"].gene_id == "G1" and rows["exon"].tags == ["a", "b"] and rows["exon"].strand == -1 and rows["exon"].exon_number == 2


def test_upsert_and_stream_are_idempotent(spark, tmp_path):
    schema = "source string, source_file string, variant_id string, p_value double"
    out, incoming, state = (str(tmp_path / x) for x in ("out", "in", "state"))
    spark.createDataFrame([("s", "f1", "rs1", 0.5), ("s", "f2", "rs2", 0.1)], schema).write.parquet(incoming)
    for _ in range(2):
        ingest.ingest_files(spark, incoming, schema, out, state)
    assert sinks.read_points(spark, out).count() == 2
    sinks.upsert_points(spark.createDataFrame([("s", "f1", "rs9", 0.2)], schema), out)
    assert sorted(r.variant_id for r in sinks.read_points(spark, out).collect()) == ["rs2", "rs9"]
