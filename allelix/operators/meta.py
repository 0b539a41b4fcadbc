"""Provenance of published payloads, and the export manifest that says which fields and bundles a payload carries."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from allelix.functions import text as fn

Bundle = Callable[[DataFrame, Sequence[str], dict], DataFrame]


def _listed(column: str) -> Column:
    return F.array_sort(F.collect_set(F.nullif(fn.strip(F.col(column).cast("string")), F.lit(""))))


def _column(df: DataFrame, name: str) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast("string"))


def source_provenance(df: DataFrame, scope: Sequence[str], params: dict | None = None) -> DataFrame:
    """(scope, provenance): sources, records of each source, families and the number of files. Records are counted by source first, so
    no group is gathered row by row."""
    rows = _column(_column(df, "source_family"), "source_file")
    counts = rows.groupBy(*scope, F.nullif(fn.strip(F.col("source")), F.lit("")).alias("source")).agg(F.count("*").alias("n")).where("source is not null")
    by_source = counts.groupBy(*scope).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", "n")))).alias("source_counts"))
    files = rows.groupBy(*scope).agg(_listed("source_family").alias("source_families"), F.count_distinct("source_file").alias("source_file_count"))
    found = files.join(by_source, list(scope), "left").withColumn("source_counts", F.coalesce("source_counts", F.create_map().cast("map<string,bigint>")))
    bundle = F.struct(F.map_keys("source_counts").alias("sources"), "source_counts", "source_families", "source_file_count")
    return found.select(*scope, bundle.alias("provenance"))


def ancestry_provenance(df: DataFrame, scope: Sequence[str], params: dict | None = None) -> DataFrame:
    """(scope, ancestry_provenance): ancestry groups, the sources' codes and their labels."""
    rows = _column(_column(df, "ancestry_source_code"), "ancestry_source_label")
    found = rows.groupBy(*scope).agg(_listed("ancestry").alias("canonical_groups"), _listed("ancestry_source_code").alias("source_codes"), _listed("ancestry_source_label").alias("source_labels"))
    return found.select(*scope, F.struct("canonical_groups", "source_codes", "source_labels").alias("ancestry_provenance"))


def coverage(df: DataFrame, scope: Sequence[str], params: dict | None = None) -> DataFrame:
    """(scope, coverage): what the figures cover and how many records stand behind them; coverage itself is not computed."""
    name = str((params or {}).get("scope", "association")).strip() or "association"
    kind = F.upper("dataset_type") if "dataset_type" in scope else F.lit("")
    found = df.groupBy(*scope).agg(F.count("*").alias("record_count"))
    return found.select(*scope, F.struct(F.lit("not_computed").alias("status"), F.lit(name).alias("scope"), "record_count", kind.alias("dataset_type")).alias("coverage"))


#: Columns of the points that each bundle reads.
_READ: dict[Bundle, tuple[str, ...]] = {source_provenance: ("source", "source_family", "source_file"), ancestry_provenance: ("ancestry", "ancestry_source_code", "ancestry_source_label"), coverage: ()}


class Bundles:
    """Named bundles that a manifest may refer to; users add their own."""

    def __init__(self):
        self._known: dict[str, Bundle] = {"source_provenance_bundle": source_provenance, "ancestry_provenance_bundle": ancestry_provenance, "coverage_stub": coverage}
        self._columns: dict[str, Callable[..., Column]] = {"normalized_clinical_significance": fn.significance_label, "canonical_phenotype_path": fn.label_path}

    def register(self, name: str, bundle: Bundle) -> None:
        if not name.strip():
            raise ValueError("a bundle needs a name")
        self._known[name.strip()] = bundle

    def get(self, name: str) -> Callable:
        found = self._known.get(name) or self._columns.get(name)
        if found is None:
            raise KeyError(f"no bundle {name!r}; there are {', '.join(self.available())}")
        return found

    def validate(self, names: Iterable[str]) -> None:
        for name in names:
            self.get(name)

    def available(self) -> list[str]:
        return sorted({*self._known, *self._columns})


def merge_names(base: Iterable[Any], more: Iterable[Any]) -> list[str]:
    """Both lists in order, each name once, blanks left out."""
    return list(dict.fromkeys(name for x in (*base, *more) if (name := str(x).strip())))


def merge_objects(base: Iterable[dict], more: Iterable[dict], key: str) -> list[dict]:
    """Both lists of objects in order of first appearance; of two with one key the later counts."""
    found: dict[str, dict] = {}
    for item in (*base, *more):
        if isinstance(item, dict) and (name := str(item.get(key, "")).strip()):
            found[name] = dict(item)
    return list(found.values())


@dataclass(frozen=True)
class Manifest:
    """What a published payload carries: promoted columns, metadata fields (source, target), bundles, and which go where."""

    manifest_id: str
    version: int
    promoted: tuple[str, ...]
    metadata: tuple[dict, ...]
    derived: dict[str, dict]
    entry_meta: tuple[str, ...] = ()
    overall_meta: tuple[str, ...] = ()
    serving_keys: tuple[str, ...] = ()
    bundles: Bundles = field(default_factory=Bundles)

    @classmethod
    def of(cls, base: dict, override: dict | None = None, bundles: Bundles | None = None) -> Manifest:
        """From configuration, a source's override merged in; a name without bundle is refused."""
        more = override or {}
        publish = [x.get("publish_fields", {}) for x in (base, more)]
        serving = [x.get("serving_fields", {}) for x in (base, more)]
        named = lambda key, k: merge_objects(base.get(key, ()), more.get(key, ()), k)
        found = cls(
            str(more.get("manifest_id") or base["manifest_id"]), int(more.get("version") or base["version"]),
            tuple(merge_names(base.get("promoted_fields", ()), more.get("promoted_fields", ()))), tuple(named("metadata_fields", "name")),
            {d["name"]: d for d in named("derived_fields", "name")}, *(tuple(merge_names(*(p.get(k, ()) for p in publish))) for k in ("entry_meta", "overall_meta")),
            tuple(merge_names(*(p.get("top_level_keys", ()) for p in serving))), bundles or Bundles(),
        )
        found.bundles.validate(d["helper"] for d in found.derived.values())
        unknown = [n for n in (*found.entry_meta, *found.overall_meta) if n not in ("manifest_id", "manifest_version") and n not in found.derived]
        if unknown:
            raise KeyError(f"publish fields without definition: {', '.join(unknown)}")
        return found

    def missing(self, columns: Sequence[str]) -> list[str]:
        """Promoted fields that a projection lacks."""
        return [name for name in self.promoted if name not in columns]

    def columns(self) -> set[str] | None:
        """Columns of the points that payloads with this manifest need, None for all of them, where a bundle is the user's own."""
        bundles = [self.bundles.get(self.derived[n]["helper"]) for n in (*self.entry_meta, *self.overall_meta) if n in self.derived]
        if any(b not in _READ for b in bundles):
            return None
        return {*self.promoted, *(c for b in bundles for c in _READ[b])}

    def metadata_json(self, columns: Sequence[str]) -> Column:
        """JSON of the metadata fields: `row.<column>` or `literal:<text>` at a dotted target, blanks left out."""
        values = {}
        for spec in self.metadata:
            kind, _, rest = spec["source"].partition("." if spec["source"].startswith("row.") else ":")
            if kind == "literal":
                values[spec["target"]] = F.lit(rest)
            elif kind == "row" and rest in columns:
                values[spec["target"]] = F.col(f"`{rest}`")
        return fn.nested_json(values) if values else F.lit(None).cast("string")

    def axis(self, name: str) -> Callable[[Column], Column]:
        """The label rule of an axis, a bundle's if the manifest names one for it."""
        for spec in self.derived.values():
            if spec.get("scope") == "axis" and spec.get("target") == name:
                return self.bundles.get(spec["helper"])
        return lambda c: fn.axis_label(c, name)

    def publish_meta(self, df: DataFrame, scope: Sequence[str], overall: bool = False) -> DataFrame:
        """(scope, meta): JSON with the manifest's name and version and the bundles that it lists for entries or for overall payloads."""
        parts, found = [], df.select(*scope).distinct()
        for name in self.overall_meta if overall else self.entry_meta:
            if name == "manifest_id":
                parts.append(F.lit(self.manifest_id).alias("manifest_id"))
            elif name == "manifest_version":
                parts.append(F.lit(self.version).alias("manifest_version"))
            else:
                spec = self.derived[name]
                bundle = self.bundles.get(spec["helper"])(df, scope, spec.get("params") or {})
                (value,) = (c for c in bundle.columns if c not in scope)
                target = spec["target"].removeprefix("meta.")
                found = found.join(bundle.withColumnRenamed(value, target), list(scope), "left")
                parts.append(F.col(target))
        return found.select(*scope, (F.to_json(F.struct(*parts)) if parts else F.lit(None).cast("string")).alias("meta"))


def merge_provenance(old: DataFrame, new: DataFrame, scope: Sequence[str]) -> DataFrame:
    """Two tables of (scope, provenance, ancestry_provenance, coverage) as one: sets united, counts added, the older status kept."""
    both = old.select(*scope, *[F.col(c).alias(f"__o_{c}") for c in _META]).join(new.select(*scope, *[F.col(c).alias(f"__n_{c}") for c in _META]), list(scope), "full")
    strings = lambda p: F.coalesce(p, F.array().cast("array<string>"))
    united = lambda c, f: F.array_sort(F.array_union(strings(F.col(f"__o_{c}.{f}")), strings(F.col(f"__n_{c}.{f}")))).alias(f)
    zero = lambda p: F.coalesce(p, F.lit(0).cast("bigint"))
    added = lambda c, f: (zero(F.col(f"__o_{c}.{f}")) + zero(F.col(f"__n_{c}.{f}"))).alias(f)
    none = F.create_map().cast("map<string,bigint>")
    counts = F.map_zip_with(F.coalesce("__o_provenance.source_counts", none), F.coalesce("__n_provenance.source_counts", none), lambda _, a, b: zero(a) + zero(b))
    ordered = F.map_from_entries(F.array_sort(F.map_entries(counts))).alias("source_counts")
    first = lambda f: F.coalesce(F.nullif(F.col(f"__o_coverage.{f}"), F.lit("")), F.col(f"__n_coverage.{f}"), F.lit("")).alias(f)
    return both.select(
        *scope,
        F.struct(united("provenance", "sources"), ordered, united("provenance", "source_families"), added("provenance", "source_file_count")).alias("provenance"),
        F.struct(*[united("ancestry_provenance", f) for f in ("canonical_groups", "source_codes", "source_labels")]).alias("ancestry_provenance"),
        F.struct(first("status"), first("scope"), added("coverage", "record_count"), first("dataset_type")).alias("coverage"),
    )


_META = ("provenance", "ancestry_provenance", "coverage")


def bundled(df: DataFrame, scope: Sequence[str]) -> DataFrame:
    """(scope, provenance, ancestry_provenance, coverage)."""
    found = source_provenance(df, scope).join(ancestry_provenance(df, scope), list(scope))
    return found.join(coverage(df, scope), list(scope))
