"""Registered queries of files, archives and stored tables: they write the given tables as files or in batches, and read back what must then be there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allelix.operators import intervals as iv
from allelix.operators import meta, paths, protein, qa, serving
from allelix.operators import publish as pub
from allelix.operators import structural as sv
from allelix.plans import ingestion, jobs
from allelix.plans import sqltext as q
from allelix.plans.points import PRIORITY, SQL, points, read
from allelix.sources import archives, files, readers, sinks
from allelix.sources.scratch import folder, stored
from allelix.sources.store import Append, Replace, Store, Upsert
from allelix.streaming import staged

QUERIES, ORACLES = {}, {}
c = F.col


def add(name: str, sql: str | None = None):
    def keep(query):
        QUERIES[name] = query
        if sql:
            ORACLES[name] = sql
        return query

    return keep


# delimited files: a third of part each as plain text with commas, gzipped with tabs, zipped with bars, with columns of their own
_THIRDS = {0: ("plain", ",", ["p_partkey", "p_name", "p_size"]), 1: ("gz", "\t", ["p_partkey", "p_type", "p_name"]), 2: ("zip", "|", ["p_name", "p_partkey", "p_brand"])}
_TEXT = "concat(p_name, CASE WHEN p_size % 3 = 0 THEN ', \"quoted\"' WHEN p_size % 3 = 1 THEN ' | ;' ELSE '' END)"


def part_files(spark: SparkSession, sf_dir: str) -> str:
    """The folder of part's thirds as files of three kinds."""
    root = folder(spark, "tables")
    rows = read(spark, sf_dir, "part").withColumn("p_name", F.expr(_TEXT))
    for third, (kind, delimiter, columns) in _THIRDS.items():
        own = rows.where(c("p_partkey") % 3 == third).select(*columns).coalesce(2)
        if kind == "zip":
            archives.write_zipped(own, root, "part", delimiter)
        else:
            own.write.mode("append").option("header", True).option("sep", delimiter).option("quote", '"').option("escape", '"').option("compression", "gzip" if kind == "gz" else "none").csv(root)
    return root


_PART_SQL = f"SELECT p_partkey, {_TEXT} AS p_name, CASE WHEN p_partkey % 3 = 0 THEN p_size END AS p_size, CASE WHEN p_partkey % 3 = 1 THEN p_type END AS p_type, CASE WHEN p_partkey % 3 = 2 THEN p_brand END AS p_brand FROM part"


@add("A2_tables_of_all_kinds", _PART_SQL)
def _(s, d):
    rows = files.sniffed(s, part_files(s, d))
    return rows.select(c("p_partkey").cast("bigint").alias("p_partkey"), "p_name", c("p_size").cast("int").alias("p_size"), "p_type", "p_brand")


@add("A21_zipped_tables", f"SELECT p_partkey, {_TEXT} AS p_name, p_brand FROM part WHERE p_partkey % 3 = 2")
def _(s, d):
    rows = files.sniffed(s, part_files(s, d) + "/*.zip")
    return rows.select(c("p_partkey").cast("bigint").alias("p_partkey"), "p_name", "p_brand")


_KINDS = "(VALUES ('csv', ',', 'p_partkey,p_name,p_size'), ('gz', chr(9), 'p_partkey,p_type,p_name'), ('zip', '|', 'p_name,p_partkey,p_brand')) AS k(kind, delimiter, columns)"
_FINGERPRINT = "sha256('[\"' || replace(columns, ',', '\",\"') || '\"]')"


@add("A1_listed_files", f"SELECT kind, true AS has_bytes FROM {_KINDS} WHERE (SELECT count(*) FROM part) > 0")
def _(s, d):
    found = files.input_files(s, part_files(s, d))
    return found.groupBy(F.element_at(F.split("name", "[.]"), -1).alias("kind")).agg((F.min("bytes") > 0).alias("has_bytes"))


@add("A3_delimiters", f"SELECT kind, delimiter FROM {_KINDS} WHERE (SELECT count(*) FROM part) > 0")
def _(s, d):
    return readers.header_inventory(s, part_files(s, d), readers.TABLES).select(F.element_at(F.split("file", "[.]"), -1).alias("kind"), "delimiter").distinct()


@add("A4_headers", f"SELECT kind, columns, {_FINGERPRINT} AS fingerprint FROM {_KINDS} WHERE (SELECT count(*) FROM part) > 0")
def _(s, d):
    found = readers.header_inventory(s, part_files(s, d), readers.TABLES)
    return found.select(F.element_at(F.split("file", "[.]"), -1).alias("kind"), F.array_join("columns", ",").alias("columns"), "fingerprint").distinct()


@add("A13_expression_map_file", "SELECT p_brand AS gene_id, count(*) AS n FROM part GROUP BY ALL")
def _(s, d):
    """Objects of one line each, one for each brand, read as an expression map."""
    root = folder(s, "expression")
    rows = read(s, d, "part").groupBy("p_brand").agg(F.count("*").alias("n"))
    rows.select(F.to_json(F.create_map("p_brand", "n")).alias("value")).write.text(root)
    return files.expression_entries(s, root, lines=True).select("gene_id", c("entry").cast("bigint").alias("n"))


# points in a store
_POINT = ["source_file", "source", "dataset_type", "gene_id", "variant_id", "phenotype", "ancestry", "p_value", "row_key"]


@add("B2_points_upsert", f"{SQL} SELECT {', '.join(_POINT)} FROM points")
def _(s, d):
    """Files in two batches, one file first with other genes, and an upsert that dies before its version is there."""
    store, rows = Store(s, folder(s, "points")), points(s, d)
    staged.upsert_points(store, rows.where("source_file < 'file_3'").withColumn("gene_id", F.lit("wrong")))
    staged.upsert_points(store, rows.where("source_file < 'file_5'"))
    dead = store.begin()
    dead.write("points", Upsert(staged._stored_points(rows.withColumn("gene_id", F.lit("dead"))), staged.FILE_KEY, by=("bucket",)))
    staged.upsert_points(store, rows.where("source_file >= 'file_5'"))
    return store.read("points").select(*_POINT)


def _publishing(s: SparkSession) -> staged.Publishing:
    return staged.Publishing(PRIORITY, jobs.leaves(s), paths.rollup_map(s, jobs.TREE), meta.Manifest.of(jobs.MANIFEST))


_PATH_KEY = "dataset_type, gene_id, path"
_ALL_KINDS = (
    f"{jobs.KEPT}, rolled AS (SELECT kept.*, concat_ws(',', {jobs._TREE_CATEGORY}, {jobs._TREE_LABEL}) AS path FROM kept LEFT JOIN {jobs._TREE_MAP} ON dataset_type = tm_type AND {jobs.SLUG} = tm_slug) "
    f"SELECT 'association' AS kind, {_PATH_KEY}, axis, name, value FROM (WITH h AS (SELECT * FROM pathed), {q.axes(_PATH_KEY, 'h')}) UNION ALL SELECT 'overall', dataset_type, gene_id, '', axis, name, value FROM (WITH h AS (SELECT * FROM pathed), {q.axes('dataset_type, gene_id', 'h')}) "
    f"UNION ALL SELECT 'association_rollup', {_PATH_KEY}, axis, name, value FROM (WITH h AS (SELECT * FROM rolled), {q.axes(_PATH_KEY, 'h')}) UNION ALL SELECT 'overall_rollup', dataset_type, gene_id, '', axis, name, value FROM (WITH h AS (SELECT * FROM rolled), {q.axes('dataset_type, gene_id', 'h')}) "
    "UNION ALL SELECT 'variant_index', dataset_type, gene_id, path, 'index', variant_id, count(*) FROM pathed GROUP BY ALL"
)


@add("L3_staged_publish_of_all_kinds", _ALL_KINDS)
def _(s, d):
    """Batches of files: the first with other labels in a file that the second replaces; then counters of all payload tables, and the flat index."""
    store, rows, job = Store(s, folder(s, "published")), points(s, d), _publishing(s)
    first = rows.where("source_file < 'file_4'").withColumn("variation_type", F.when(c("source_file") == "file_3", "odd").otherwise(c("variation_type")))
    staged.publish_batch(store, first, job, ("batches", 0))
    staged.publish_batch(store, rows.where("source_file >= 'file_3'"), job, ("batches", 1))
    out = store.read("variant_index_table").select(F.lit("variant_index").alias("kind"), *pub.GENE, F.array_join("label_path", ",").alias("path"), F.lit("index").alias("axis"), c("variant_id").alias("name"), c("record_count").alias("value"))
    for kind in ("association", "overall", "association_rollup", "overall_rollup"):
        counted = jobs._counted(store.read(kind), *((pub.association_summary, jobs._ENTRY) if kind.startswith("assoc") else (pub.overall_summary, jobs._TOTAL)))
        path = c("path") if kind.startswith("assoc") else F.lit("")
        out = out.unionByName(counted.select(F.lit(kind).alias("kind"), *pub.GENE, path.alias("path"), "axis", "name", "value"))
    return out


@add("N5_ancestry_of_payloads", f"{jobs.KEPT}, newest AS (SELECT dataset_type, gene_id, path, ancestry, variant_id, ancestry_af FROM pathed QUALIFY row_number() OVER (PARTITION BY dataset_type, gene_id, path, ancestry, variant_id ORDER BY ingested_at DESC, row_key DESC) = 1) SELECT dataset_type, gene_id, path, ancestry, variant_id, round(ancestry_af, 9) AS value FROM newest")
def _(s, d):
    """The ancestry points inside the association payloads of the whole publish, written and read again."""
    root = folder(s, "publish")
    found = jobs.published(s, d, digits=9)
    sinks.write_payloads(found.payloads()["association"], f"{root}/association")
    entry = "array<struct<trait:array<string>,disease:array<string>,ancestry:array<struct<name:string,data:array<struct<rsid:string,value:double>>>>>>"
    rows = sinks.read_payloads(s, f"{root}/association").select(*pub.GENE, F.explode(F.from_json("payload_json", entry)).alias("e"))
    each = rows.select(*pub.GENE, F.array_join(F.coalesce("e.trait", "e.disease"), ",").alias("path"), F.explode("e.ancestry").alias("a"))
    return each.select(*pub.GENE, "path", c("a.name").alias("ancestry"), F.explode("a.data").alias("p")).select(*pub.GENE, "path", "ancestry", c("p.rsid").alias("variant_id"), c("p.value").alias("value"))


# the long layout as a stream of batches that cut files anywhere
@add("L2_long_batches", jobs.ORACLES["F1_long_merge"])
def _(s, d):
    root = folder(s, "long")
    jobs._raw(s, d, jobs._LONG).withColumn("slice", F.pmod(F.xxhash64("SNP_ID", "ancestry", "pval"), F.lit(3))).write.partitionBy("slice").parquet(f"{root}/in")
    raw = s.read.parquet(f"{root}/in").drop("slice")
    store = Store(s, f"{root}/store")
    stream = s.readStream.schema(raw.schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 4).parquet(f"{root}/in")
    staged.run(stream, lambda batch, n: staged.merge_long_batch(store, batch, jobs.types(s), ("long", n)), f"{root}/state")
    found = store.read("records")
    people = F.array_join(F.array_sort(F.map_keys(F.from_json(F.get_json_object("metadata", "$.by_ancestry"), "map<string,string>"))), ",")
    return found.select("source_file", "dataset_type", "gene_id", "variant_id", c("merge_key").alias("k"), "p_value", people.alias("people"))


# structural variants, stopped and gone on with
@add(
    "L5_structural_batches",
    f"{jobs._SV} SELECT gene_id, string_agg(variant_id || ':' || study_id || ':' || v_start || '-' || v_end, ',' ORDER BY v_start, v_end, variant_id, study_id) AS variants, CASE WHEN bool_or(cast(substr(gene_id, 2) AS int) % 7 = 0) THEN 'seeded' END AS seeded FROM u GROUP BY ALL",
)
def _(s, d):
    seed = s.createDataFrame(jobs._SEED, "gene_id string, gene_location string, strand long, biotype string, canonical_transcript string")
    annotation = jobs._genes(s, d).limit(0).select("gene_stable_id", "start", "end", "strand", "biotype", F.lit(None).cast("string").alias("canonical_transcript"))
    rows = jobs._variants(s, d).withColumn("source_file", F.concat(F.lit("f"), (c("start") % 3).cast("string")))
    store, terms = Store(s, folder(s, "structural")), ("urgent", "low")
    moved = rows.where("source_file = 'f1'").withColumns({"start": c("start") + 9, "end": c("end") + 9})
    for n, batch in enumerate((moved, rows.where("source_file = 'f0'"), rows.where("source_file <> 'f0'"), rows)):
        staged.structural_batch(store, batch, jobs._genes(s, d), seed, annotation, terms, seen=("files", min(n, 2)))
    shape = "struct<biotype:string,variants:array<struct<variant_id:string,study_id:string,variant_region:string>>>"
    found = store.read("payloads").select("gene_id", F.from_json("payload_json", shape).alias("p"))
    listed = F.array_join(F.transform("p.variants", lambda v: F.concat_ws(":", v.variant_id, v.study_id, v.variant_region)), ",")
    return found.select("gene_id", listed.alias("variants"), F.when(c("p.biotype") == "seeded", "seeded").alias("seeded"))


# raw files of three layouts, dropped in turn
_PREPARED = {"gene": "p_brand", "rsid": "'rs' || cast(l_partkey AS varchar(20))", "phenotype": "o_orderpriority", "pval": "cast(l_tax AS varchar(20))", "ancestry_data": "concat('{\"African\": ', cast(l_linenumber AS varchar(4)), '}')"}


@add(
    "L1_raw_files",
    f"WITH {jobs._raw_sql(jobs._LEGACY)}, r AS ({jobs._LG}), x AS (SELECT *, 'Total' AS ancestry, t AS af FROM r UNION ALL SELECT *, 'European', e FROM r), "
    f"lr AS (SELECT * FROM ({jobs._raw_sql(jobs._LONG).removeprefix('raw AS ')})), "
    f"l AS (SELECT {jobs._LT} AS dataset_type, gene_symbol AS gene_id, \"SNP_ID\" AS variant_id, {q.slug('phenotype_description')} AS phenotype, coalesce({jobs._LC}, '') AS disease_category, CASE WHEN alt = 'T' THEN 'SNP' ELSE 'INDEL' END AS variation_type, {jobs._ANC} AS ancestry, upper(ancestry) AS code, cast(pval AS double) AS p, cast(af AS double) AS f FROM lr LEFT JOIN {jobs._TYPE_SQL} ON {q.slug('phenotype_description')} = pm_slug), "
    f"pr AS (SELECT * FROM ({jobs._raw_sql(_PREPARED).removeprefix('raw AS ')})) "
    "SELECT 'raw' AS layout, gene_id, variant_id, phenotype, ancestry, min(p) AS p_value, min(af) AS ancestry_af FROM x WHERE regexp_matches(gene_id, '[A-Za-z]') GROUP BY ALL HAVING min(af) IS NOT NULL "
    "UNION ALL SELECT 'long', gene_id, variant_id, phenotype, ancestry, p, f FROM (SELECT dataset_type, gene_id, variant_id, phenotype, disease_category, variation_type, ancestry, code, min(p) AS p, min(f) AS f FROM l WHERE NOT regexp_matches(gene_id, '^[0-9]+$') GROUP BY ALL) WHERE f IS NOT NULL "
    f"UNION ALL SELECT 'prepared', gene, rsid, {q.slug('phenotype')}, 'African', cast(pval AS double), cast(json_extract_string(ancestry_data, '$.African') AS double) FROM pr",
)
def _(s, d):
    root = folder(s, "raw")
    store = Store(s, f"{root}/store")

    def go() -> None:
        staged.run(staged.file_stream(s, f"{root}/in"), lambda names, n: staged.raw_batch(store, names, jobs.types(s), F.lit(None).cast("timestamp"), ("raw", n)), f"{root}/state")

    # points are one for each key of a file, so all rows of a variant go into one of the files
    archives.write_zipped(jobs._raw(s, d, jobs._LONG).drop("source_file").repartition("gene_symbol", "SNP_ID", "phenotype_description"), f"{root}/in", "long", "\t")
    go()
    jobs._raw(s, d, _PREPARED).write.mode("append").option("header", True).option("quote", '"').option("escape", '"').csv(f"{root}/in")
    s.createDataFrame([("1", "2")], "a string, b string").coalesce(1).write.mode("append").option("header", True).csv(f"{root}/in")
    go()
    jobs._raw(s, d, jobs._LEGACY).drop("source_file").repartition("MarkerID").write.mode("append").option("header", True).option("sep", ";").option("compression", "gzip").csv(f"{root}/in/trait")
    go()
    if store.read("rejected").count() != 1:
        raise ValueError("one file has no known layout, and only that one is to be put aside")
    layout = F.when(c("source") == "legacy_raw", "raw").when(c("source") == "legacy_csv", "prepared").otherwise("long")
    return store.read("points").where("ancestry_af is not null").select(layout.alias("layout"), "gene_id", "variant_id", "phenotype", "ancestry", "p_value", "ancestry_af")


# serving tables that change together
@add(
    "L6_secondary_apply",
    f"{SQL}, t AS ({jobs._PAIRS}), x AS (SELECT DISTINCT upper(p_brand) AS g FROM part WHERE p_size > 45) SELECT coalesce(upper(trim(t.gene_id)), g) AS gene_id_normalized, coalesce(bool_or(dataset_type = 'CVD'), false) AS has_cvd, bool_or(g IS NOT NULL) AS has_expression, (SELECT count(*) FROM x) AS expression_rows FROM t FULL JOIN x ON upper(trim(t.gene_id)) = g GROUP BY ALL",
)
def _(s, d):
    """A secondary table applied, applied again with other rows, and a third time by a run that dies: the second counts, with its catalog and metadata."""
    store = Store(s, folder(s, "serving"))
    serving.write_build(store, serving.build(jobs._payloads(s, d)))
    rows = lambda w: serving.secondary_rows(read(s, d, "part").where(w).select(c("p_brand").alias("gene_id"), F.lit("{}").alias("payload_json")).distinct())
    serving.apply_secondary(store, "expression", rows("p_size > 0"), {"mode": "all"})
    serving.apply_secondary(store, "expression", rows("p_size > 45"), {"mode": "some"})
    dead = store.begin()
    dead.write("expression_gene_payloads", Replace(rows("p_size < 0")))
    catalog, about = store.read("gene_catalog"), store.read(serving.METADATA)
    counted = about.where("analysis_id = 'expression' and metadata_json = '{\"mode\":\"some\"}'").select(c("row_count").alias("expression_rows"))
    return catalog.select("gene_id_normalized", "has_cvd", "has_expression").crossJoin(F.broadcast(counted))


@add("B8_stored_build", jobs.ORACLES["B8_serving_counts"])
def _(s, d):
    """The serving build written in one version; rows counted where they lie."""
    store = Store(s, folder(s, "serving"))
    serving.write_build(store, serving.build(jobs._payloads(s, d)))
    names = [n for n in store.version().tables if n != "build_metadata"]
    out = None
    for name in names:
        one = store.read(name).agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


# payloads of unbounded genes, releases, nested fragments, uneven intervals
@add(
    "B6_index_chunks",
    f"{jobs.KEPT}, i AS (SELECT DISTINCT dataset_type, gene_id, path, variant_id FROM pathed) SELECT dataset_type, gene_id, string_agg(variant_id || '@' || path, ';' ORDER BY string_split(path, ','), variant_id) AS entries, count(*) AS n, count(*) AS footer, true AS small FROM i GROUP BY ALL",
)
def _(s, d):
    """The variant index in chunks of at most 40 entries: joined in order they are the whole index, and the footer has its number of entries."""
    found = pub.index_chunks(stored(jobs.published(s, d).index, "index"), per_chunk=40)
    found = found.withColumn("x", F.from_json("payload_json", "array<struct<variant_id:string,phenotype_path:array<string>>>"))
    text = F.array_join(F.transform("x", lambda e: F.concat(e.variant_id, F.lit("@"), F.array_join(e.phenotype_path, ","))), ";")
    rows = found.select(*pub.GENE, "chunk", "entries", "payload_json", text.alias("text"))
    joined = rows.where("chunk >= 0").groupBy(*pub.GENE).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "text"))), lambda x: x.text), ";").alias("entries"), F.sum("entries").alias("n"), (F.max("entries") <= 40).alias("small"))
    footer = rows.where("chunk = -1").select(*pub.GENE, F.get_json_object("payload_json", "$.entries").cast("bigint").alias("footer"))
    return joined.join(footer, list(pub.GENE)).select(*pub.GENE, "entries", "n", "footer", "small")


@add("B3_association_chunks", jobs.ORACLES["N5_association_payloads"])
def _(s, d):
    """Counters of all associations, in chunks of at most 3 entries."""
    found = pub.association_chunks(jobs.pathed(s, d), per_chunk=3)
    if found.where("chunk >= 0 and entries > 3").count():
        raise ValueError("a chunk holds more entries than it may")
    return jobs._counted(found.where("chunk >= 0"), pub.association_summary, jobs._ENTRY)


@add("B4_population_chunks", f"{jobs.KEPT} SELECT dataset_type, gene_id, path, ancestry, variant_id, round(ancestry_af, 9) AS value FROM pathed QUALIFY row_number() OVER (PARTITION BY dataset_type, gene_id, path, ancestry, variant_id ORDER BY ingested_at DESC, row_key DESC) = 1")
def _(s, d):
    found = pub.population_chunks(jobs.pathed(s, d), digits=9, per_chunk=50)
    rows = found.where("chunk >= 0").select(*pub.GENE, F.explode(F.from_json("payload_json", "array<struct<path:array<string>,population:string,rsid:string,value:double>>")).alias("x"))
    return rows.select(*pub.GENE, F.array_join("x.path", ",").alias("path"), c("x.population").alias("ancestry"), c("x.rsid").alias("variant_id"), F.round("x.value", 9).alias("value"))


@add(
    "K5_releases",
    "SELECT release_id, n_nationkey, sha256(n_name || chr(10)) AS sha256, length(n_name) + 1 AS bytes FROM nation, (VALUES ('r1'), ('r2')) AS r(release_id) WHERE release_id = 'r2' OR n_nationkey % 2 = 0",
)
def _(s, d):
    """Two releases registered, the first twice with other files: its second registration counts, the other release stays. Checksums are streamed."""
    store, rows = Store(s, folder(s, "releases")), read(s, d, "nation")
    for release, part in (("r1", "n_nationkey < 20"), ("r2", "true"), ("r1", "n_nationkey % 2 = 0")):
        root = folder(s, "release")
        rows.where(part).select(c("n_name").alias("value"), "n_nationkey").write.partitionBy("n_nationkey").text(root)
        headers = readers.header_inventory(s, f"{root}/*", "part-*")
        qa.register_release(store, qa.release_tables(qa.file_inventory(s, root, "part-*"), headers, "nations", release, "text", ["n_name"]))
    found = store.read("file_inventory")
    return found.select("release_id", F.regexp_extract("file", "n_nationkey=([0-9]+)", 1).cast("int").alias("n_nationkey"), "sha256", "bytes")


_DEEP = (
    "concat('{\"metadata\":{\"accession\":\"', p_brand, '\"},\"other\":{\"start\":1,\"end\":2},\"matches\":[{\"start\":', cast(p_size AS varchar(12)), ',\"end\":', cast(p_size + 9 AS varchar(12)), ',\"representative\":{\"locations\":[[{\"fragments\":{\"proteins\":[{\"start\":', "
    "cast(p_partkey % 50 + 100 AS varchar(12)), ',\"end\":200,\"matches\":[]}]}}]]}},7,null,{\"fragments\":[{\"start\":5,\"end\":2},{\"start\":7}]}]}')"
)


@add(
    "J5_fragments_at_any_depth",
    f"WITH RECURSIVE e AS (SELECT DISTINCT p_type AS transcript_id, p_brand AS accession, cast({_DEEP} AS JSON) AS v FROM part), "
    "r AS (SELECT transcript_id, accession, v FROM e UNION ALL SELECT transcript_id, accession, x.v FROM (SELECT transcript_id, accession, unnest(CASE json_type(v) WHEN 'ARRAY' THEN from_json(v, '[\"JSON\"]') "
    "WHEN 'OBJECT' THEN list_filter([v->'fragments', v->'entry_protein_locations', v->'locations', v->'proteins', v->'matches', v->'representative'], lambda y: y IS NOT NULL) END) AS v FROM r) x WHERE json_type(x.v) IN ('ARRAY', 'OBJECT')) "
    "SELECT DISTINCT transcript_id, accession, least(a, b) AS start, greatest(a, b) AS end_ FROM (SELECT transcript_id, accession, cast(v->>'start' AS INTEGER) AS a, cast(v->>'end' AS INTEGER) AS b FROM r WHERE json_type(v) = 'OBJECT' AND json_exists(v, '$.start') AND json_exists(v, '$.end'))",
)
def _(s, d):
    entries = read(s, d, "part").selectExpr("p_type AS transcript_id", f"{_DEEP} AS entry").distinct()
    return protein.entry_fragments(entries).select("transcript_id", "accession", c("start").cast("int").alias("start"), c("end").cast("int").alias("end_"))


_UNEVEN = "(CASE {0} % 6 WHEN 0 THEN 0 WHEN 1 THEN 900 WHEN 2 THEN 20000 WHEN 3 THEN 700000 WHEN 4 THEN 9000000 ELSE 120000000 END)"
_U = f"WITH v AS (SELECT o_orderkey AS variant, o_custkey % 5 AS v_chrom, o_orderkey * 20011 AS v_start, o_orderkey * 20011 + {_UNEVEN.format('(o_orderkey * 7)')} * (o_custkey % 3) AS v_end FROM orders), g AS (SELECT p_partkey AS gene, p_partkey % 5 AS g_chrom, p_partkey * 90001 AS g_start, p_partkey * 90001 + {_UNEVEN.format('(p_partkey * 5)')} AS g_end FROM part)"


@add("E5_overlap_of_uneven_lengths", f"{_U} SELECT variant, gene FROM v JOIN g ON v_chrom = g_chrom AND v_start <= g_end AND g_start <= v_end")
def _(s, d):
    """Intervals of one position up to hundreds of millions."""
    v = read(s, d, "orders").selectExpr("o_orderkey AS variant", "o_custkey % 5 AS v_chrom", "o_orderkey * 20011 AS v_start", f"o_orderkey * 20011 + {_UNEVEN.format('(o_orderkey * 7)')} * (o_custkey % 3) AS v_end")
    g = read(s, d, "part").selectExpr("p_partkey AS gene", "p_partkey % 5 AS g_chrom", "p_partkey * 90001 AS g_start", f"p_partkey * 90001 + {_UNEVEN.format('(p_partkey * 5)')} AS g_end")
    return iv.overlap_join_of_any_length(v, g, ("v_chrom", "g_chrom"), ("v_start", "g_start"), ("v_end", "g_end")).select("variant", "gene")


# serving and structural payloads by their whole content
@add("C36_summaries_of_published", f"{jobs.KEPT}, a AS (WITH h AS (SELECT * FROM pathed), {q.axes('dataset_type, gene_id', 'h')}) SELECT dataset_type, gene_id, string_agg(axis || ':' || name || '=' || value, ';' ORDER BY axis, name) AS counters, false AS has_ancestry FROM a GROUP BY ALL")
def _(s, d):
    """Summaries of the overall payloads that a publish gives: all counters, no ancestry points."""
    found = serving.summaries(serving.serving_rows(jobs.published(s, d).payloads()["overall"]), "overall")
    rows = found.withColumn("p", F.from_json("payload_json", jobs._TOTAL))
    item = lambda a: F.transform(F.map_entries(F.col(f"p.data.{a}")), lambda e: F.concat(F.lit(f"{a}:"), e.key, F.lit("="), e.value.cast("string")))
    return rows.select(*pub.GENE, F.array_join(F.array_sort(F.concat(*[item(a) for a in pub.AXIS_KINDS])), ";").alias("counters"), F.contains("payload_json", F.lit("ancestry")).alias("has_ancestry"))


@add("L4_resumed_summaries", f"{SQL}, t AS (SELECT dataset_type, upper(trim(gene_id)) AS gene_id_normalized FROM points WHERE {q.GENE} GROUP BY ALL) SELECT *, 1 AS n FROM t ORDER BY dataset_type, gene_id_normalized LIMIT 24")
def _(s, d):
    """Three runs of at most 8 summaries each, appended to a store; one of them is handed over twice."""
    store, rows = Store(s, folder(s, "summaries")), serving.serving_rows(jobs.published(s, d).payloads()["overall"])
    store.commit({"full": Replace(rows), "summary": Replace(serving.summaries(rows.limit(0), "overall"))})
    for run in (0, 1, 1, 2):
        store.commit({"summary": Append(serving.pending_summaries(store.read("full"), store.read("summary"), "overall", 8))}, ("summaries", run))
    return store.read("summary").groupBy("dataset_type", "gene_id_normalized").agg(F.count("*").cast("int").alias("n"))


_VARIANTS = "string_agg(variant_id || ':' || study_id || ':' || v_start || '-' || v_end, ',' ORDER BY v_start, v_end, variant_id, study_id) AS variants"
_SHAPE = "struct<biotype:string,gene_location:string,strand:int,canonical_transcript:variant,variants:array<struct<variant_id:string,study_id:string,variant_region:string,phenotype:array<string>,assembly_name:string>>>"


def _structural(folded: DataFrame) -> DataFrame:
    rows = sv.gene_payloads(folded).select("gene_id", "payload_json", F.from_json("payload_json", _SHAPE).alias("p"))
    listed = F.array_join(F.transform("p.variants", lambda v: F.concat_ws(":", v.variant_id, v.study_id, v.variant_region)), ",")
    return rows.select("gene_id", listed.alias("variants"), F.when(c("p.biotype") == "seeded", c("p.gene_location")).alias("seeded_at"), F.forall("p.variants", lambda v: (v.assembly_name == "g38") & (F.size(v.phenotype) == 1)).alias("whole"), F.contains("payload_json", F.lit('"canonical_transcript":[]')).alias("no_transcript"))


_STRUCTURAL_SQL = f"{jobs._SV} SELECT gene_id, {_VARIANTS}, CASE WHEN bool_or(cast(substr(gene_id, 2) AS int) % 7 = 0) THEN any_value(substr(gene_id, 2) || '-' || (cast(substr(gene_id, 2) AS int) + 9)) END AS seeded_at, true AS whole, true AS no_transcript FROM u GROUP BY ALL"


@add("B7_structural_content", _STRUCTURAL_SQL)
def _(s, d):
    return _structural(jobs._folded(s, d))


@add("F25_structural_merge_content", _STRUCTURAL_SQL)
def _(s, d):
    """Half of each gene's variants without gene fields, merged with all of them."""
    whole = jobs.stored_folded(s, d)
    part = whole.withColumns({"variants": F.slice("variants", 1, 3), "biotype": F.lit(None).cast("string"), "gene_location": F.lit("")})
    return _structural(sv.merge_folded(part, whole))


# the configured job from files to published tables
_JOB = {"gene": "p_brand", "rsid": "'rs' || cast(l_partkey AS varchar(20))", "phenotype": "o_orderpriority", "pval": "cast(l_tax AS varchar(20))", "var_class": "p_type", "ancestry_data": "concat('{\"African\": ', cast(l_linenumber AS varchar(4)), '}')"}


@add(
    "N1_configured_run",
    f"WITH {jobs._raw_sql(_JOB)}, k AS (SELECT coalesce(pm_type, 'CVD') AS dataset_type, gene AS gene_id, rsid AS variant_id, {q.slug('phenotype')} AS phenotype, coalesce(pm_cat, '') AS disease_category, cast(pval AS double) AS p_value, cast(json_extract_string(ancestry_data, '$.African') AS double) AS af FROM raw LEFT JOIN {jobs._TYPE_SQL} ON {q.slug('phenotype')} = pm_slug) "
    f"SELECT dataset_type, gene_id, {jobs.PATH} AS path, variant_id, min(p_value) AS p_value, 'African' AS populations FROM k {jobs.LEAF_JOIN} GROUP BY ALL",
)
def _(s, d):
    """Prepared files in two folders, one zipped, by a configured source each, through validation and canonical records to the published index."""
    root = folder(s, "job")
    rows = jobs._raw(s, d, _JOB)
    archives.write_zipped(rows.where("rsid < 'rs2'"), f"{root}/in/a", "a", ";")
    rows.where("rsid >= 'rs2'").write.option("header", True).option("quote", '"').option("escape", '"').csv(f"{root}/in/b")
    manifests = {n: {"adapter": "legacy_csv", "default_params": {"source": n, "dataset_id": "d"}} for n in "ab"}
    sources = ingestion.with_defaults(manifests, [{"source": n, "paths": f"{root}/in/{n}/*.{'zip' if n == 'a' else 'csv'}"} for n in "ab"])
    ingestion.run(s, sources, f"{root}/out", jobs.types(s), jobs.leaves(s), paths.rollup_map(s, jobs.TREE), priority=("a", "b"))
    index = s.read.parquet(f"{root}/out/final/variant_index_table")
    return index.select("dataset_type", "gene_id", F.array_join("label_path", ",").alias("path"), "variant_id", "p_value", F.array_join(F.map_keys("ancestry"), ",").alias("populations"))


_GENES = f"{SQL}, t AS (SELECT dataset_type, gene_id FROM points WHERE {q.GENE} GROUP BY ALL)"


@add("B13_slim_of_written", f"{_GENES} SELECT dataset_type, gene_id, '/new/root/overall/dataset_type=' || dataset_type AS folder, true AS empty FROM t")
def _(s, d):
    """Overall payloads as a publish writes them, served without payload: their paths stand below the new root."""
    root = folder(s, "slim")
    sinks.write_payloads(jobs.published(s, d).payloads()["overall"], f"{root}/final/overall")
    rows = sinks.read_payloads(s, f"{root}/final/overall").withColumn("source_path", c("_metadata.file_path"))
    found = serving.slim(serving.serving_rows(rows), "/new/root")
    return found.select("dataset_type", "gene_id", F.regexp_replace("source_path", "/[^/]*$", "").alias("folder"), c("payload_json").isNull().alias("empty"))


@add(
    "N9_served_publish",
    f"{_GENES}, x AS (SELECT count(*) AS n FROM t) SELECT upper(trim(gene_id)) AS gene_id_normalized, bool_or(dataset_type = 'CVD') AS has_cvd_association, bool_or(dataset_type = 'TRAIT') AS has_trait_overall, any_value(n) AS payloads, any_value(n) AS summaries, true AS smaller FROM t, x GROUP BY ALL",
)
def _(s, d):
    """A publish written and served: full and summary tables of both kinds, catalog and counts in one version; summaries are smaller than payloads."""
    root, store = folder(s, "served"), Store(s, folder(s, "serving"))
    found = jobs.published(s, d).payloads()
    for kind in ("association", "overall"):
        sinks.write_payloads(found[kind], f"{root}/final/{kind}")
    serving.write_build(store, serving.build({k: sinks.read_payloads(s, f"{root}/final/{k}") for k in ("association", "overall")}))
    size = lambda n: store.read(n).agg(F.count("*").alias("n"), F.sum(F.length("payload_json")).alias("b"))
    full, short = size("association_gene_payloads"), size("association_summary_payloads")
    told = full.crossJoin(short.toDF("m", "c")).select(c("n").alias("payloads"), c("m").alias("summaries"), (c("c") < c("b")).alias("smaller"))
    return store.read("gene_catalog").select("gene_id_normalized", "has_cvd_association", "has_trait_overall").crossJoin(F.broadcast(told))
