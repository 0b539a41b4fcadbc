"""Versions, failures, repeats and batches: whatever is cut or killed, readers see what one whole run gives."""

import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from allelix.operators import paths, serving
from allelix.operators import publish as pub
from allelix.plans.jobs import MANIFEST, TREE
from allelix.operators.meta import Manifest
from allelix.plans.points import PRIORITY, points
from allelix.sources import adapters as ad
from allelix.sources import archives, files, readers
from allelix.sources.store import Append, Conflict, Drop, Replace, Store, Upsert
from allelix.streaming import staged

DATA = "/root/testdata/sf0.001"
SCHEMA = "f string, s string, n int"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).coalesce(1)


def test_upserts_replace_their_keys_and_nothing_else(spark, tmp_path):
    """Random upserts, appends, replacements and drops against a plain list; nulls are keys like others."""
    r, store, have = random.Random(5), Store(spark, str(tmp_path)), []
    assert store.read("t") is None and store.versions() == []
    for step in range(12):
        rows = [(r.choice(["a", "b", "c", None]), r.choice("xy"), step) for _ in range(r.randint(0, 5))]
        kind = r.choice(["upsert"] * 4 + ["append", "gone"]) if step else "replace"
        if kind == "upsert":
            have = [x for x in have if x[0] not in {y[0] for y in rows}] + rows
            store.commit({"t": Upsert(frame(spark, rows), ("f",), by=("s",))})
        elif kind == "gone":
            have = [x for x in have if x[0] not in {y[0] for y in rows} | {"a"}] + rows
            store.commit({"t": Upsert(frame(spark, rows), ("f",), frame(spark, [("a", "x", 0)]), ("s",))})
        elif kind == "append":
            have = have + rows
            store.commit({"t": Append(frame(spark, rows), ("s",))})
        else:
            have = list(rows)
            store.commit({"t": Replace(frame(spark, rows), ("s",))})
        assert sorted(map(tuple, store.read("t").collect()), key=str) == sorted(have, key=str), (step, kind)
        if step == 8:
            store.compact("t")
    old = store.read("t", store.versions()[0])
    assert old is not None and old.count() <= 5
    files_before = sum(1 for _ in tmp_path.rglob("*.parquet"))
    store.compact("t")
    assert store.vacuum(keep=1) > 0 and len(store.versions()) == 1 and sum(1 for _ in tmp_path.rglob("*.parquet")) < files_before
    assert sorted(map(tuple, store.read("t").collect()), key=str) == sorted(have, key=str)
    store.commit({"t": Drop()})
    assert store.read("t") is None


@pytest.mark.parametrize("step", ["first table", "second table", "manifest"])
def test_a_commit_that_dies_leaves_the_version_before(spark, tmp_path, monkeypatch, step):
    store = Store(spark, str(tmp_path))
    store.commit({"a": Replace(frame(spark, [("1", "x", 1)])), "b": Replace(frame(spark, [("1", "x", 1)]))})
    commit = store.begin()
    if step != "first table":
        commit.write("a", Upsert(frame(spark, [("1", "x", 2)]), ("f",)))
    if step == "manifest":
        commit.write("b", Replace(frame(spark, [("1", "x", 2)])))
        monkeypatch.setattr(Store, "_publish", lambda *_: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError, match="killed"):
            commit.publish()
        monkeypatch.undo()
    other = Store(spark, str(tmp_path))
    assert [other.read(t).first().n for t in "ab"] == [1, 1] and other.version().number == 1
    other.commit({"a": Replace(frame(spark, [("1", "x", 3)]))})
    assert [other.read(t).first().n for t in "ab"] == [3, 1]


def test_of_two_writers_the_second_fails_and_a_repeated_batch_changes_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    one, two = store.begin(), store.begin()
    for commit, n in ((one, 1), (two, 2)):
        commit.write("t", Replace(frame(spark, [("a", "x", n)])))
    assert one.publish() == 1
    with pytest.raises(Conflict):
        two.publish()
    assert store.read("t").first().n == 1
    for batch, n in ((0, 5), (0, 6), (1, 7), (0, 8)):
        store.commit({"t": Replace(frame(spark, [("a", "x", n)]))}, ("stream", batch))
    assert store.read("t").first().n == 7
    with pytest.raises(ValueError):
        store.commit({"t": Append(frame(spark, [("a", "x", 1)]), ("s",))})


def told(df):
    return sorted(json.dumps(r.asDict(recursive=True), sort_keys=True, default=str) for r in df.collect())


def test_batches_of_files_publish_what_one_run_publishes(spark, tmp_path):
    """Files in random batches, one of them first with other points: every payload table equals one whole publish, and a repeat changes nothing."""
    job = staged.Publishing(PRIORITY, paths.tree_tables(spark, TREE)[0], paths.rollup_map(spark, TREE), Manifest.of(MANIFEST))
    some = points(spark, DATA).where("gene_id in ('Brand#11', 'Brand#12', 'Brand#13', 'Brand#21')")
    store = Store(spark, str(tmp_path / "s"))
    wrong = some.where("source_file = 'file_3'").withColumns({"variation_type": F.lit("snp"), "gene_id": F.when(F.col("gene_id") == "Brand#11", "Brand#99").otherwise(F.col("gene_id"))})
    staged.publish_batch(store, wrong, job, ("p", 0))
    for n, part in enumerate(("source_file in ('file_1', 'file_5')", "source_file in ('file_3', 'file_0')", "source_file not in ('file_0', 'file_1', 'file_3', 'file_5')")):
        staged.publish_batch(store, some.where(part), job, ("p", n + 1))
    version = store.version().number
    assert staged.publish_batch(store, some, job, ("p", 2)) == version
    whole = pub.unified(staged._stored_points(some).drop("bucket"), PRIORITY, job.leaves, job.rollup, job.manifest)
    for kind, payloads in whole.payloads().items():
        assert told(store.read(kind)) == told(payloads), kind
    assert told(store.read("variant_index_table")) == told(whole.index)


def long_rows(spark, n):
    r = random.Random(9)
    one = lambda i: (f"G{r.randint(1, 3)}", f"rs{r.randint(1, 4)}", r.choice(["Big heart", "x"]), r.choice(["pk", None]), r.choice(["eur", "afr", "sas", None]), str(r.random()), r.choice(["0.5", "0.01", None]), r.choice("fg"))
    return spark.createDataFrame([one(i) for i in range(n)], "gene_symbol string, SNP_ID string, phenotype_description string, phenotype_key string, ancestry string, af string, pval string, source_file string")


def test_any_cut_of_the_long_layout_merges_alike(spark, tmp_path):
    rows = long_rows(spark, 240).withColumn("i", F.monotonically_increasing_id()).cache()
    for name, table in (("named", rows), ("nameless", rows.drop("source_file"))):
        store = Store(spark, str(tmp_path / name))
        for n, part in enumerate(("i % 5 = 0", "i % 5 in (1, 4)", "i % 5 in (2, 3)", "i % 5 = 3")):
            staged.merge_long_batch(store, table.where(part).drop("i"), seen=("l", n))
        assert told(store.read("records").drop("source_file", "merge_key")) == told(ad.merged_long(ad.long_rows(table.drop("i")))), name


def test_structural_files_in_any_batches_fold_alike(spark, tmp_path):
    r = random.Random(2)
    rows = [(f"v{r.randint(1, 30)}", "s", "1", a := r.randint(0, 9000), a + r.randint(1, 3000), "cnv", ["heart"], r.choice([None, "benign"]), "g38", f"f{i % 4}") for i in range(200)]
    variants = spark.createDataFrame(rows, "variant_id string, study_id string, chrom string, start long, end long, variant_type string, phenotypes array<string>, clinical_significance string, assembly_name string, source_file string")
    genes = spark.createDataFrame([(f"G{i}", f"S{i}", "1", i * 900, i * 900 + 500, 1, "coding") for i in range(9)], "gene_id string, gene_stable_id string, chrom string, start long, end long, strand int, biotype string")
    seed = spark.createDataFrame([("G1", "1-2", 1, "seeded", None)], "gene_id string, gene_location string, strand long, biotype string, canonical_transcript string")
    annotation = spark.createDataFrame([], "gene_stable_id string, start long, end long, strand int, biotype string, canonical_transcript string")
    from allelix.operators import structural as sv

    plain = sv.build(variants, genes, seed, annotation, ("heart",))[0]
    store = Store(spark, str(tmp_path / "s"))
    wrong = variants.where("source_file = 'f2'").withColumns({"start": F.col("start") + 700, "end": F.col("end") + 700})
    for n, part in enumerate((wrong, variants.where("source_file = 'f0'"), variants.where("source_file in ('f2', 'f3')"), variants.where("source_file = 'f1'"), variants)):
        staged.structural_batch(store, part, genes, seed, annotation, ("heart",), seen=("v", min(n, 3)))
    assert told(store.read("payloads")) == told(sv.gene_payloads(plain))
    assert store.read("counts").agg(F.sum("rows_seen")).first()[0] == variants.count() + wrong.count()


def test_secondary_apply_fails_as_a_whole(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    payload = spark.createDataFrame([("CVD", "G1", "[]")], "dataset_type string, gene_id string, payload_json string")
    serving.write_build(store, {k: serving.serving_rows(payload) for k in ("association_gene_payloads", "overall_gene_payloads")})
    rows = lambda g: serving.secondary_rows(spark.createDataFrame([(g, "{}")], "gene_id string, payload_json string"))
    serving.apply_secondary(store, "expression", rows("G1"), {"mode": "a"})
    monkeypatch.setattr(serving, "gene_catalog", lambda *_: (_ for _ in ()).throw(RuntimeError("broken")))
    with pytest.raises(RuntimeError, match="broken"):
        serving.apply_secondary(store, "expression", rows("G2"), {"mode": "b"})
    monkeypatch.undo()
    assert [r.gene_id for r in serving.current(store, "expression").collect()] == ["G1"]
    assert [(r.analysis_id, json.loads(r.metadata_json)) for r in store.read(serving.METADATA).collect()] == [("expression", {"mode": "a"})]
    catalog = serving.apply_secondary(store, "expression", rows("G2"))
    assert sorted((r.gene_id, r.has_expression) for r in catalog.collect()) == [("G1", False), ("G2", True)]
    assert store.read(serving.METADATA).count() == 1 and told(store.read("gene_catalog")) == told(catalog)


def test_raw_files_in_any_order_become_points_and_broken_ones_are_put_aside(spark, tmp_path):
    incoming = tmp_path / "in"
    incoming.mkdir()
    (incoming / "prep.csv").write_text('gene,rsid,phenotype,pval,ancestry_data\nTTN,rs1,x,0.5,"{""African"": 0.25}"\n')
    (incoming / "traits.csv").write_text("MarkerID;snpeff.ann.gene_id;Phenotype;pval;gnomad_genome.af.af\nrs5;ACTN2;y;0.1;0.5\n")
    store = Store(spark, str(tmp_path / "s"))

    def go():
        stream = staged.file_stream(spark, str(incoming), files_per_batch=1)
        staged.run(stream, lambda names, n: staged.raw_batch(store, names, ingested_at=F.lit(None).cast("timestamp"), seen=("raw", n)), str(tmp_path / "state"))

    go()
    with zipfile.ZipFile(incoming / "long.csv.zip", "w") as z:
        z.writestr("long.csv", "gene_symbol\tSNP_ID\tphenotype_description\tancestry\taf\tpval\nNEXN\trs7\tz\teur\t0.2\t0.3\n")
    (incoming / "odd.csv").write_text("a,b\n1,2\n")
    (incoming / "broken.csv.zip").write_bytes(b"no archive")
    go()
    go()
    found = {(r.gene_id, r.variant_id, r.dataset_type, r.ancestry, r.ancestry_af) for r in store.read("points").where("ancestry_af is not null").collect()}
    assert found == {("TTN", "rs1", "CVD", "African", 0.25), ("ACTN2", "rs5", "TRAIT", "Total", 0.5), ("NEXN", "rs7", "CVD", "European", 0.2)}
    assert sorted(r.file.rpartition("/")[2] for r in store.read("rejected").collect()) == ["broken.csv.zip", "odd.csv"]


def test_archives_are_tables_like_other_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,plain\n")
    (tmp_path / "notes.txt").write_text("no table\n")
    with zipfile.ZipFile(tmp_path / "b.csv.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("b.csv", '﻿id|name|more\n2|"x|\ny"|\n\n3|"say ""hi"""|m|too many\n4\n')
    rows = sorted((r.id, r.name, r.more, r.source_file.rpartition("/")[2]) for r in files.sniffed(spark, str(tmp_path)).collect())
    assert rows == [("1", "plain", None, "a.csv"), ("2", "x|\ny", None, "b.csv.zip"), ("3", 'say "hi"', "m", "b.csv.zip"), ("4", None, None, "b.csv.zip")]
    assert [r.id for r in files.sniffed(spark, str(tmp_path / "b.csv.zip"), keep_broken=False).collect()] == ["2"]
    with pytest.raises(Exception, match="4 fields under 3"):
        files.sniffed(spark, str(tmp_path / "b.csv.zip"), strict=True).collect()
    heads = {r.file.rpartition("/")[2]: (r.delimiter, r.columns) for r in readers.header_inventory(spark, str(tmp_path), readers.TABLES).collect()}
    assert heads == {"a.csv": (",", ["id", "name"]), "b.csv.zip": ("|", ["id", "name", "more"])}
    with zipfile.ZipFile(tmp_path / "two.zip", "w") as z:
        z.writestr("x/1.csv", "id\n5\n")
        z.writestr("2.csv", "id\n6\n")
    two = str(tmp_path / "two.zip")
    assert [r.id for r in archives.zipped_tables(spark, [(two, "2.csv", ",")], ["id"]).collect()] == ["6"]
    assert sorted(r.member for r in archives.archive_members(spark.createDataFrame([(two,)], "file string")).collect()) == ["2.csv", "x/1.csv"]
    with pytest.raises(ValueError, match="2 members"):
        files.sniffed(spark, two)
    with pytest.raises(FileNotFoundError):
        list(archives.records(two, "3.csv", ",", ["id"]))


def test_what_is_written_zipped_is_read_back(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a,"b"', None), (2, "", "ü\nz"), (3, None, "x")], "id int, t string, u string").repartition(2)
    names = archives.write_zipped(df, str(tmp_path / "z"), "part", "\t")
    assert names.count() == 2
    back = files.sniffed(spark, str(tmp_path / "z")).select(F.col("id").cast("int"), "t", "u")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_a_member_is_read_as_a_stream(tmp_path):
    """Half a million records are begun without reading them: the first comes after a few blocks."""
    at = tmp_path / "big.csv.zip"
    with zipfile.ZipFile(at, "w", zipfile.ZIP_DEFLATED) as z, z.open("big.csv", "w") as member:
        member.write(b"id,t\n" + b"".join(b"%d,%s\n" % (i, b"x" * 40) for i in range(500_000)))
    rows = archives.records(str(at), None, ",", ["id"])
    assert next(rows) == ["0"] and next(rows) == ["1"]
    rows.close()
    assert archives.first_line(str(at)) == "id,t"
