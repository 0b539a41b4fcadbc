"""Protein features by isoform: hints, transcript choice, features of several sources in one shape, groups by class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from allelix.functions import text as fn
from allelix.operators import catalog as cat
from allelix.sources.scratch import folder

FEATURE = ("start", "end", "label", "type", "source", "accession", "description")
GROUPS = (*[name for name, _ in fn.FEATURE_CLASSES], "other_features")


def isoform_hints(rows: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, protein_id, row_count, length_aa) of isoform rows: how often an id occurs, its greatest positive length, most frequent first."""
    length = F.when(F.col("length_aa") > 0, F.col("length_aa"))
    return rows.groupBy(*by, "protein_id").agg(F.count("*").alias("row_count"), F.max(length).alias("length_aa")).orderBy(*by, F.col("row_count").desc(), "protein_id")


def coding_transcripts(transcripts: DataFrame) -> DataFrame:
    """Transcripts with a translation whose biotype is protein coding or not given."""
    kind = F.lower(fn.strip(F.coalesce("biotype", F.lit(""))))
    return transcripts.where(F.col("translation_id").isNotNull() & kind.isin("", "protein_coding"))


def hinted_transcripts(hints: DataFrame, xrefs: DataFrame) -> DataFrame:
    """(protein_id, transcript_id): transcripts of RefSeq hints by a table of cross references (name, id), the exact name or the one
    without version; ids without version."""
    refseq = hints.where(F.col("protein_id").rlike("^(NM_|XM_|NP_|XP_)")).select("protein_id", F.explode(F.array_distinct(F.array("protein_id", fn.without_version(F.col("protein_id"))))).alias("name"))
    known = xrefs.where(F.col("id").rlike("^(ENST|ENSP)")).select("name", fn.without_version(F.col("id")).alias("transcript_id"))
    return refseq.join(known, "name").select("protein_id", "transcript_id").distinct()


def with_hints(transcripts: DataFrame, hints: DataFrame, mapped: DataFrame) -> DataFrame:
    """`transcripts` with hinted: its id, its translation's or its name is a hint or mapped from one, versions apart."""
    ids = hints.select(fn.without_version(F.col("protein_id")).alias("id")).unionByName(mapped.select(F.col("transcript_id").alias("id"))).distinct()
    own = transcripts.select("transcript_id", F.explode(F.array_distinct(F.array(*[fn.without_version(F.col(c)) for c in ("transcript_id", "translation_id", "display_name") if c in transcripts.columns]))).alias("id"))
    hit = own.join(ids, "id", "left_semi").select("transcript_id").distinct().withColumn("hinted", F.lit(True))
    return transcripts.drop("hinted").join(hit, "transcript_id", "left").withColumn("hinted", F.coalesce("hinted", F.lit(False)))


def _text(df: DataFrame, *names: str) -> Column:
    return F.coalesce(*[F.nullif(fn.strip(F.col(n).cast("string")), F.lit("")) for n in names if n in df.columns], F.lit(""))


def _shaped(df: DataFrame, source: str, label: Column, kind: Column, accession: Column) -> DataFrame:
    place = fn.feature_range(*[F.col(c) for c in ("start", "begin") if c in df.columns], ends=tuple(F.col(c) for c in ("end", "stop", "end_position") if c in df.columns))
    shown = F.coalesce(F.nullif(label, F.lit("")), F.nullif(kind, F.lit("")), F.nullif(accession, F.lit("")), F.lit("Feature"))
    rows = df.select("transcript_id", place.alias("p"), shown.alias("label"), F.coalesce(F.nullif(kind, F.lit("")), F.lit("feature")).alias("type"), F.lit(source).alias("source"), accession.alias("accession"), _text(df, "description").alias("description"))
    return rows.where("p is not null").select("transcript_id", F.col("p.start").alias("start"), F.col("p.end").alias("end"), *FEATURE[2:])


def exon_features(df: DataFrame) -> DataFrame:
    """Translation exons (transcript_id, start, end, rank, id) in the common shape; ranges in order, rows without one dropped."""
    return _shaped(df, "ensembl_translation_exon", F.concat(F.lit("Exon "), _text(df, "rank", "exon_rank", "exon_number")), F.lit("translation_exon"), _text(df, "id", "exon_id"))


def protein_features(df: DataFrame) -> DataFrame:
    """Protein features (transcript_id, start, end, type, description, ids) in the common shape."""
    accession, kind = _text(df, "interpro_ac", "id", "hit_name"), _text(df, "type", "analysis")
    return _shaped(df, "ensembl_protein_feature", F.coalesce(*[F.nullif(x, F.lit("")) for x in (_text(df, "description", "hit_name"), accession, kind)]), kind, accession)


def ebi_features(df: DataFrame) -> DataFrame:
    """Features of the protein service (transcript_id, begin, end, type, description, accession) in the common shape."""
    accession, kind = _text(df, "accession", "id"), _text(df, "type", "category")
    return _shaped(df, "ebi_proteins", F.coalesce(*[F.nullif(x, F.lit("")) for x in (_text(df, "description", "alternativeSequence", "ligand"), accession, kind)]), kind, accession)


#: Keys below which fragments may lie.
NESTED = ("fragments", "entry_protein_locations", "locations", "proteins", "matches", "representative")


def nested_fragments(entries: DataFrame, entry: str = "entry", most_rounds: int = 100) -> DataFrame:
    """`entries` without `entry` (JSON), with fragment (variant): every object with a start and an end, at any depth below NESTED keys.

    One round opens all objects and lists of one depth and keeps what may hold fragments; rounds end when nothing is left, so their number is the
    greatest depth. Each round's rows are written and read again.
    """
    columns = [c for c in entries.columns if c != entry]
    spark = entries.sparkSession
    is_object, is_list = F.schema_of_variant("__v").startswith("OBJECT"), F.schema_of_variant("__v").startswith("ARRAY")
    open_ = entries.select(*columns, F.try_parse_json(F.col(entry)).alias("__v")).where(F.col("__v").isNotNull())
    out = None
    for _ in range(most_rounds):
        open_ = open_.withColumn("__kind", F.when(is_object, "o").when(is_list, "l")).where("__kind is not null")
        at = folder(spark, "fragments")
        open_.write.parquet(at)
        open_ = spark.read.parquet(at)
        if open_.isEmpty():
            break
        has = lambda k: F.array_contains(F.json_object_keys(F.to_json("__v")), k)
        found = open_.where((F.col("__kind") == "o") & has("start") & has("end")).select(*columns, F.col("__v").alias("fragment"))
        out = found if out is None else out.unionByName(found)
        items = open_.lateralJoin(spark.tvf.variant_explode(F.col("__v").outer()))
        open_ = items.where((F.col("__kind") == "l") | F.col("key").isin(*NESTED)).select(*columns, F.col("value").alias("__v"))
    else:
        raise ValueError(f"entries are nested more than {most_rounds} deep")
    return entries.select(*columns, F.parse_json(F.lit("{}")).alias("fragment")).limit(0) if out is None else out


def entry_fragments(entries: DataFrame) -> DataFrame:
    """(transcript_id, features in the common shape) of nested domain entries (transcript_id, entry as JSON): every fragment at any depth, once for
    each accession and range."""
    about = lambda k: F.get_json_object("entry", f"$.metadata.{k}").alias(k)
    rows = entries.select("transcript_id", *[about(k) for k in ("accession", "type", "name", "description")], "entry")
    inside = lambda k: F.try_variant_get("fragment", f"$.{k}", "string").alias(k)
    flat = nested_fragments(rows).select("transcript_id", "accession", "type", "name", "description", inside("start"), inside("end"))
    kind = F.coalesce(F.nullif("type", F.lit("")), F.lit("InterPro"))
    shaped = _shaped(flat, "interpro", F.coalesce("name", "accession", kind), kind, _text(flat, "accession"))
    return shaped.dropDuplicates(["transcript_id", "accession", "start", "end"])


def grouped_features(features: DataFrame) -> DataFrame:
    """(transcript_id, one array of features for each class): features once by source, range and accession, in order of place and label."""
    name = F.coalesce(F.nullif("accession", F.lit("")), F.col("label"))
    once = features.withColumn("__a", name).dropDuplicates(["transcript_id", "source", "start", "end", "__a"]).drop("__a")
    text = F.concat_ws(" ", "type", "label", "description")
    item = F.struct(*FEATURE[:3], "type", "source", "accession", "description")
    classed = once.withColumn("class", fn.feature_category(text, F.col("source")))
    return classed.groupBy("transcript_id").agg(*[F.array_sort(F.collect_list(F.when(F.col("class") == g, item))).alias(g) for g in GROUPS])


def protein_context(transcripts: DataFrame, hints: DataFrame, xrefs: DataFrame, features: DataFrame, n: int = 12) -> DataFrame:
    """The protein context job: (gene_id, payload_json) with the chosen isoforms of each gene, their lengths and grouped features."""
    mapped = hinted_transcripts(hints, xrefs)
    chosen = cat.top_isoforms(with_hints(coding_transcripts(transcripts), hints, mapped), n)
    length = hints.select(fn.without_version(F.col("protein_id")).alias("__id"), "length_aa").groupBy("__id").agg(F.max("length_aa").alias("hinted_length"))
    rows = chosen.join(grouped_features(features), "transcript_id", "left").join(length, fn.without_version(F.col("transcript_id")) == F.col("__id"), "left")
    own = [F.col("protein_length")] if "protein_length" in chosen.columns else []
    isoform = F.struct("rank", "transcript_id", F.col("is_canonical"), F.coalesce(*own, "hinted_length").alias("length_aa"), F.struct(*[F.coalesce(g, F.array()).alias(g) for g in GROUPS]).alias("features"))
    return rows.groupBy("gene_id").agg(F.to_json(F.struct(F.array_sort(F.collect_list(isoform)).alias("isoforms"))).alias("payload_json"))
