"""Published payloads: associations by label, overall totals, roll-ups and the variant index, as rows with JSON.

A payload is one row for each dataset type and gene. Counters are aggregated before anything is gathered into arrays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from allelix.functions import text as fn
from allelix.operators import aggregates as ag
from allelix.operators import paths
from allelix.operators import records as rec
from allelix.operators.meta import Manifest
from allelix.sources import scratch as held

GENE = ("dataset_type", "gene_id")
#: Key of a payload's provenance; set it to what the payloads' readers expect.
META_KEY = "_meta"
AXIS_KINDS = {"vc": "variation", "msc": "most_severe_consequence", "cs": "clinical_significance"}
_ITEMS = "array<struct<name:string,value:bigint>>"


def _by_axis(counters: DataFrame, scope: Sequence[str]) -> DataFrame:
    """(scope, vc, msc, cs): arrays of name and value in order of name."""
    item = F.struct("name", F.col("value").cast("bigint").alias("value"))
    return counters.groupBy(*scope).agg(*[F.array_sort(F.collect_list(F.when(F.col("axis") == a, item))).alias(a) for a in AXIS_KINDS])


def _populations(points: DataFrame, scope: Sequence[str], digits: int) -> DataFrame:
    """(scope, ancestry): array of population and its variants with their frequencies."""
    known = points.withColumn("ancestry", F.nullif(fn.strip(F.col("ancestry")), F.lit("")))
    rows = ag.ancestry_points(known, scope).select(*scope, F.col("ancestry").alias("name"), F.struct(F.col("variant_id").alias("rsid"), F.round("value", digits).alias("value")).alias("x"))
    each = rows.groupBy(*scope, "name").agg(F.array_sort(F.collect_list("x")).alias("data"))
    return each.groupBy(*scope).agg(F.array_sort(F.collect_list(F.struct("name", "data"))).alias("ancestry"))


def _empty(column: str, kind: str) -> Column:
    return F.coalesce(F.col(column), F.array().cast(kind)).alias(column)


def entries(points: DataFrame, scope: Sequence[str], digits: int = 6, unknown: bool = False, manifest: Manifest | None = None, overall: bool = False, people: bool = True) -> DataFrame:
    """(scope, vc, msc, cs, ancestry, meta) of every group of points; without `people` the ancestry is empty."""
    keys = points.select(*scope).distinct()
    out = keys.join(_by_axis(ag.aggregate_variants(points, scope, unknown), scope), list(scope), "left")
    out = out.join(_populations(points, scope, digits), list(scope), "left") if people else out.withColumn("ancestry", F.lit(None))
    populations = "array<struct<name:string,data:array<struct<rsid:string,value:double>>>>"
    if manifest:
        out = out.join(manifest.publish_meta(points, scope, overall), list(scope), "left")
    else:
        out = out.withColumn("meta", F.lit(None).cast("string"))
    return out.withColumn("ancestry", F.col("ancestry").cast(populations)).select(*scope, *[_empty(a, _ITEMS) for a in AXIS_KINDS], _empty("ancestry", populations), "meta")


def _with_meta(body: Column, meta: Column) -> Column:
    """A JSON object with the JSON `meta` at META_KEY, if there is any."""
    return F.when(meta.isNull(), body).otherwise(F.concat(F.substring(body, 1, F.length(body) - 1), F.lit(f',"{META_KEY}":'), meta, F.lit("}")))


def _association_entry(path: Column) -> Column:
    named = lambda name, kind: F.when((F.col("dataset_type") == "TRAIT") == F.lit(kind), path).alias(name)
    return _with_meta(F.to_json(F.struct("ancestry", "vc", "msc", "cs", named("trait", True), named("disease", False))), F.col("meta"))


def association_payloads(found: DataFrame, label: str = "label_path", order: Column | None = None) -> DataFrame:
    """(dataset_type, gene_id, payload_json): the gene's entries in order of the last part of their label."""
    path = F.col(label)
    rows = found.select(*GENE, F.struct((F.element_at(path, -1) if order is None else order).alias("o"), path.alias("p"), _association_entry(path).alias("j")).alias("x"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x.j), ",")
    return rows.groupBy(*GENE).agg(F.concat(F.lit("["), listed, F.lit("]")).alias("payload_json"))


def overall_payloads(found: DataFrame) -> DataFrame:
    """(dataset_type, gene_id, payload_json): totals as objects by name."""
    counts = [F.map_from_entries(a).alias(a) for a in AXIS_KINDS]
    people = F.map_from_entries(F.transform("ancestry", lambda p: F.struct(p["name"], F.map_from_entries(p["data"])))).alias("ancestry")
    body = F.to_json(F.struct(F.struct(*counts, people).alias("data"), F.create_map().cast("map<string,double>").alias("pvals")))
    return found.select(*GENE, _with_meta(body, F.col("meta")).alias("payload_json"))


def index_entry(label: str = "label_path") -> Column:
    """One entry of the variant index as JSON."""
    path, given = F.col(label), lambda c: F.when(F.size(c) > 0, F.col(c))
    metadata = F.when((F.size("source_files") > 0) | (F.size("phenotype_keys") > 0), F.struct(given("source_files").alias("source_files"), given("phenotype_keys").alias("phenotype_keys")))
    named = lambda name, kind: F.when((F.col("dataset_type") == "TRAIT") == F.lit(kind), path).alias(name)
    return F.to_json(F.struct(
        "variant_id", "gene_id", "dataset_type", F.element_at(path, -1).alias("phenotype"), path.alias("phenotype_path"),
        F.when(F.col("dataset_type") == "TRAIT", "trait").otherwise("disease").alias("label_key"), named("trait", True), named("disease", False),
        F.col("variation").alias("variation_type"), F.col("consequence").alias("most_severe_consequence"), F.col("significance").alias("clinical_significance"),
        "p_value", "ancestry", given("sources").alias("sources"), "source", metadata.alias("metadata"),
    ))


def index_payloads(index: DataFrame, label: str = "label_path") -> DataFrame:
    """(dataset_type, gene_id, chunk, payload_json) of the variant index, entries in order of path and variant. A gene with at most CHUNK_ENTRIES entries
    and CHUNK_BYTES bytes is one row, a larger one as many as it needs, numbered from 0: the index of one gene may be larger than any row. It is written
    aside when this is called."""
    return index_chunks(index, label).where("chunk >= 0").drop("entries")


#: Entries of one chunk of a gene's payload, and bytes after which a chunk is closed before that.
CHUNK_ENTRIES, CHUNK_BYTES = 5000, 8 << 20


def chunked(rows: DataFrame, order: Sequence[str], entry: str = "entry", per_chunk: int = CHUNK_ENTRIES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(dataset_type, gene_id, chunk, entries, payload_json) of rows (dataset_type, gene_id, order columns, entry as JSON): each gene's entries in order, in
    lists of at most `per_chunk` entries and about `chunk_bytes` bytes, however many a gene has; and a footer row (chunk -1) with the gene's numbers
    of chunks and entries.

    Rows are sorted by range, so a gene with a third of all rows lies in many tasks. An entry's number in its gene follows from its place in its range and the
    entries of the ranges before, one row for each gene and range; so chunks are the same however rows are dealt. `per_chunk` entries are one task's
    at most, which joins them as a stream and holds one chunk. The lists of a gene's chunks one after the other are its payload.
    """
    spark = rows.sparkSession
    dealt = rows.repartitionByRange(*GENE, *order).sortWithinPartitions(*GENE, *order)
    at = held.folder(spark, "chunks")
    placed = held.stored(dealt.select(*GENE, F.col(entry).alias("__entry"), F.spark_partition_id().alias("__range"), F.monotonically_increasing_id().alias("__at")), "chunks", at)
    ranges = placed.groupBy(*GENE, "__range").agg(F.min("__at").alias("__first"), F.count("*").alias("__count"))
    before = Window.partitionBy(*GENE).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    shift = ranges.select(*GENE, "__range", (F.coalesce(F.sum("__count").over(before), F.lit(0)) - F.col("__first")).alias("__shift"))
    numbered = placed.join(rec.broadcast_if_few(shift), [*GENE, "__range"]).withColumn("__n", F.col("__at") + F.col("__shift"))
    blocks = numbered.select(*GENE, F.floor(F.col("__n") / per_chunk).alias("__block"), "__n", "__entry")
    blocks = blocks.repartition(*GENE, "__block").sortWithinPartitions(*GENE, "__block", "__n")
    lists = held.stored(blocks.mapInArrow(_joined(chunk_bytes), "dataset_type string, gene_id string, __block bigint, __cut bigint, entries bigint, payload_json string"), "chunks")
    held.dropped(spark, at)
    place = [*GENE, "__block", "__cut"]
    number = lists.select(*place, (F.row_number().over(Window.partitionBy(*GENE).orderBy("__block", "__cut")) - 1).alias("chunk"))
    footer = lists.groupBy(*GENE).agg(F.lit(-1).alias("chunk"), F.sum("entries").alias("entries"), F.to_json(F.struct(F.count("*").alias("chunks"), F.sum("entries").alias("entries"))).alias("payload_json"))
    return lists.join(rec.broadcast_if_few(number), place).select(*GENE, "chunk", "entries", "payload_json").unionByName(footer)


def _joined(chunk_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sorted rows (dataset_type, gene_id, block, number, entry) to lists of the entries of each block, closed once they hold `chunk_bytes` bytes."""
    names = ["dataset_type", "gene_id", "__block", "__cut", "entries", "payload_json"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, cut, size, entries = None, 0, 0, []

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v], pa.string() if isinstance(v, str) or v is None else pa.int64()) for v in (*key, cut, len(entries), "[" + ",".join(entries) + "]")], names=names)

        for batch in batches:
            kinds, genes, blocks, _, texts = batch.columns
            for kind, gene, block, text, length in zip(kinds.to_pylist(), genes.to_pylist(), blocks.to_pylist(), texts.to_pylist(), pa.compute.binary_length(texts).to_pylist()):
                if key != (kind, gene, block) or size >= chunk_bytes:
                    if entries:
                        yield closed()
                    cut, key = (cut + 1 if key == (kind, gene, block) else 0), (kind, gene, block)
                    size, entries = 0, []
                entries.append(text)
                size += length
        if entries:
            yield closed()

    return run


def index_chunks(index: DataFrame, label: str = "label_path", **sizes: int) -> DataFrame:
    """The variant index as `chunked` payloads, entries in order of path and variant."""
    return chunked(index.select(*GENE, F.col(label).alias("__path"), F.col("variant_id").alias("__variant"), index_entry(label).alias("entry")), ("__path", "__variant"), **sizes)


def association_chunks(kept: DataFrame, manifest: Manifest | None = None, unknown: bool = False, **sizes: int) -> DataFrame:
    """The association entries of `kept_points` as `chunked` payloads in the order of `association_payloads`, with empty ancestries: the ancestry
    points, which grow with a gene's variants, are in `population_chunks`."""
    found = entries(kept, [*GENE, "label_path"], unknown=unknown, manifest=manifest, people=False)
    return chunked(found.select(*GENE, F.element_at("label_path", -1).alias("__last"), F.col("label_path").alias("__path"), _association_entry(F.col("label_path")).alias("entry")), ("__last", "__path"), **sizes)


def population_chunks(kept: DataFrame, digits: int = 6, **sizes: int) -> DataFrame:
    """The ancestry points of `kept_points` as `chunked` payloads: objects of path, population, rsid and value in this order."""
    known = kept.withColumn("ancestry", F.nullif(fn.strip(F.col("ancestry")), F.lit("")))
    found = ag.ancestry_points(known, [*GENE, "label_path"])
    entry = F.to_json(F.struct(F.col("label_path").alias("path"), F.col("ancestry").alias("population"), F.col("variant_id").alias("rsid"), F.round("value", digits).alias("value")))
    return chunked(found.select(*GENE, "label_path", "ancestry", "variant_id", entry.alias("entry")), ("label_path", "ancestry", "variant_id"), **sizes)


@dataclass(frozen=True)
class Published:
    """What the unified job publishes; every table is a plan, run when it is written."""

    entries: DataFrame
    overall: DataFrame
    rollup_entries: DataFrame
    rollup_overall: DataFrame
    index: DataFrame

    def payloads(self, index: DataFrame | None = None) -> Mapping[str, DataFrame]:
        """Payloads by kind, each planned when it is taken. `index`: the index where it has been written already, to be read from there."""
        return _Planned({
            "association": lambda: association_payloads(self.entries), "overall": lambda: overall_payloads(self.overall),
            "association_rollup": lambda: association_payloads(self.rollup_entries, "label_path", F.element_at("label_path", -1)), "overall_rollup": lambda: overall_payloads(self.rollup_overall),
            "variant_index": lambda: index_payloads(held.stored(self.index, "index") if index is None else index),
        })


class _Planned(Mapping):
    """Tables by name, each made when it is taken."""

    def __init__(self, makers: dict[str, Callable[[], DataFrame]]):
        self._makers = makers

    def __getitem__(self, name: str) -> DataFrame:
        return self._makers[name]()

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


#: Columns of the points that every publish reads.
_NEEDED = (
    *GENE, "variant_id", "phenotype", "disease_category", "parent_phenotype", "variation_type", "clinical_significance", "most_severe_consequence", "p_value",
    "row_key", "ancestry", "ancestry_af", "ancestry_source_code", "ingested_at", "source", "source_file", "phenotype_key",
)


def lean(points: DataFrame, manifest: Manifest | None = None) -> DataFrame:
    """Points with only the columns that a publish with this manifest reads."""
    more = manifest.columns() if manifest else set()
    return points if more is None else points.select(*[c for c in points.columns if c in _NEEDED or c in more])


def lean_kept_points(points: DataFrame, priority: Sequence[str], leaves: DataFrame, types: Sequence[str] = (), manifest: Manifest | None = None) -> DataFrame:
    """`kept_points` with only the columns that a publish with this manifest reads, a variant's points beside one another.

    A manifest whose promoted fields the points lack is refused before anything is computed.
    """
    if manifest and (lacking := manifest.missing(points.columns)):
        raise ValueError(f"promoted fields that the points lack: {', '.join(lacking)}")
    rows = rec.of_types(rec.core_keys(lean(points, manifest)), types)
    kept = paths.with_label_path(rec.dedup_by_source(rows, priority, by_variant=True), leaves)
    more = manifest.columns() if manifest else set()
    return kept if more is None or "ancestry_source_code" in more else kept.drop("ancestry_source_code")


def kept_points(points: DataFrame, priority: Sequence[str], leaves: DataFrame, types: Sequence[str] = ()) -> DataFrame:
    """Points with keys, de-duplicated by source priority, with their label path."""
    return paths.with_label_path(rec.dedup_by_source(rec.of_types(rec.core_keys(points), types), priority), leaves)


def of_kept(kept: DataFrame, rollup: DataFrame, manifest: Manifest | None = None, unknown: bool = False, digits: int = 6) -> Published:
    """Everything that is published, of points as `kept_points` gives them. Every table reads them anew, so let them be read from files.

    A manifest whose promoted fields the points lack is refused before anything is computed.
    """
    if manifest and (lacking := manifest.missing(kept.columns)):
        raise ValueError(f"promoted fields that the points lack: {', '.join(lacking)}")
    by_label = [*GENE, "label_path"]
    rolled = ag.roll_up(kept, rollup).withColumn("label_path", F.array("category", "label"))
    return Published(
        entries(kept, by_label, digits, unknown, manifest), entries(kept, GENE, digits, unknown, manifest, True),
        entries(rolled, by_label, digits, unknown), entries(rolled, GENE, digits, unknown), ag.variant_index(kept, by_label),
    )


def unified(points: DataFrame, priority: Sequence[str], leaves: DataFrame, rollup: DataFrame, manifest: Manifest | None = None, types: Sequence[str] = (), unknown: bool = False, digits: int = 6, scratch: str | None = None) -> Published:
    """The unified publish: source-priority de-duplication, then associations by label path, overall totals, roll-up and variant index.

    With `scratch`, a new folder that driver and executors share, the de-duplicated points are written there once and every table reads the files.
    """
    kept = lean_kept_points(points, priority, leaves, types, manifest)
    if scratch is not None:
        kept = held.stored(kept, "kept", scratch)
    return of_kept(kept, rollup, manifest, unknown, digits)


def index_backfill(points: DataFrame, priority: Sequence[str], leaves: DataFrame) -> DataFrame:
    """The variant index alone, from one best record for each key and the best frequency for each of its populations."""
    keys = ["dataset_type", "gene_id", "variant_id", "phenotype"]
    rows = rec.normalised_keys(rec.core_keys(points))
    best = rec.best_fields(rows, keys, ["row_key", "source", "source_file", "phenotype_key", "disease_category", "p_value", "variation_type", "clinical_significance", "most_severe_consequence", "ingested_at"], priority)
    people = rec.best_fields(rows.where("ancestry is not null and ancestry_af is not null"), [*keys, "ancestry"], ["ancestry_af"], priority)
    joined = best.join(people, keys, "left")
    return ag.variant_index(paths.with_label_path(joined, leaves), [*GENE, "label_path"])


# payload checks and shapes
def axis_violations(counters: DataFrame, scope: Sequence[str]) -> DataFrame:
    """(scope, axis, name, problem) of counters (axis, name, value): empty, negative, unknown, not canonical or repeated names."""
    label = F.lit(None).cast("string")
    for axis, kind in AXIS_KINDS.items():
        label = F.when(F.col("axis") == axis, fn.axis_label(F.col("name"), kind)).otherwise(label)
    times = counters.groupBy(*scope, "axis", "name").agg(F.count("*").alias("__times"), F.min("value").alias("__least"))
    problem = (
        F.when(F.coalesce(fn.strip(F.col("name")) == "", F.lit(True)), "empty").when(F.col("__least").isNull() | (F.col("__least") < 0), "negative")
        .when(label.isNull(), "unknown").when(label != F.col("name"), "not canonical").when(F.col("__times") > 1, "repeated")
    )
    return times.withColumn("problem", problem).where("problem is not null").select(*scope, "axis", "name", "problem")


def index_violations(index: DataFrame) -> DataFrame:
    """(dataset_type, gene_id, variant_id, problem) of a variant index with label_path: what must not be published."""
    axes = {"variation": "variation", "consequence": "most_severe_consequence", "significance": "clinical_significance"}
    off = [F.when(F.col(c).isNotNull() & ~fn.axis_label(F.col(c), kind).eqNullSafe(F.col(c)), F.lit(f"{c} not canonical")) for c, kind in axes.items()]
    blank = lambda x: F.coalesce(fn.strip(x) == "", F.lit(True))
    own = F.array(
        F.when(blank(F.col("variant_id")), "no variant_id"), F.when(F.coalesce(F.size("label_path"), F.lit(0)) <= 0, "no path"),
        F.when(F.exists(F.coalesce("label_path", F.array().cast("array<string>")), blank), "empty path segment"), *off,
    )
    single = index.select(*GENE, "variant_id", F.explode(F.filter(own, lambda x: x.isNotNull())).alias("problem"))
    twice = index.groupBy(*GENE, "variant_id", "label_path").count().where("count > 1").select(*GENE, "variant_id", F.lit("repeated path").alias("problem"))
    return single.unionByName(twice)


def normalised_counters(counters: DataFrame, scope: Sequence[str], unknown: bool = False) -> DataFrame:
    """Counters (axis, name, value) with canonical names, values of one name added; unknown ones are left out or counted as Unknown."""
    label = F.lit(None).cast("string")
    for axis, kind in AXIS_KINDS.items():
        label = F.when(F.col("axis") == axis, fn.axis_label(F.col("name"), kind)).otherwise(label)
    rows = counters.withColumn("name", F.coalesce(label, F.lit("Unknown")) if unknown else label).where("name is not null")
    return rows.groupBy(*scope, "axis", "name").agg(F.sum(F.coalesce("value", F.lit(0))).cast("bigint").alias("value"))


_ENTRY = (
    "array<struct<trait:array<string>,disease:array<string>,vc:array<struct<name:string,value:bigint>>,msc:array<struct<name:string,value:bigint>>,"
    f"cs:array<struct<name:string,value:bigint>>,pvals:map<string,string>,{META_KEY}:variant>>"
)
_TOTALS = f"struct<data:struct<vc:map<string,bigint>,msc:map<string,bigint>,cs:map<string,bigint>>,pvals:map<string,string>,{META_KEY}:variant>"


def association_summary(payload: Column) -> Column:
    """A payload of associations without its ancestry points: label, counters, p-values and provenance."""
    return F.to_json(F.from_json(payload, _ENTRY))


def overall_summary(payload: Column) -> Column:
    """An overall payload without its ancestry points."""
    return F.to_json(F.from_json(payload, _TOTALS))
