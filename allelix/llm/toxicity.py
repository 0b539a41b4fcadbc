"""Toxicity by compression distance: two zstandard dictionaries, one trained on ordinary and one on toxic text.

Both are trained by zstandard itself (train_dictionary), apart from each other: one on windows of ordinary documents, one on
the windows of toxic documents that hold a run of letters which toxic documents use far more often. A window is a word
with the blanks around it; every distinct window is compressed with both dictionaries, and its distance is how many
bytes fewer it takes with the toxic one. Words are short beside a compressor's cost for a match, so each byte is
written as a fixed code of STRETCH bytes first, in training as in scoring: a match then saves in proportion to its length.

A document's windows are counted by distance, and a logistic model calibrates the counts into a score, so that 0.5 is the
threshold. From a count goes first what a document of this length has by chance, as ordinary documents show. Dictionaries
are trained on a bounded sample of labelled documents, whole texts; the counts for the calibration come from dictionaries
of the other half of the sample, and the threshold from all labelled documents that are not held out.
"""

from __future__ import annotations

import math
import random
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allelix.llm.common import cut_lineage, in_small_batches, read_table, utf8, word_blocks

#: Bound of the labelled sample that the model is fitted on: toxic and ordinary documents, the first by a hash.
SAMPLE_TOXIC, SAMPLE_ORDINARY = 2000, 5000
#: About how many windows of that sample each dictionary is trained on at most, thinned evenly, and size of a dictionary.
SAMPLE_WINDOWS, DICTIONARY_BYTES = 150_000, 1 << 16
STRETCH, GRAM, WINDOW, LEVEL = 4, 5, 64, 3
#: Sizes of the segments and of the runs by which zstandard chooses a dictionary's content, of ordinary and of toxic text: the second, from
#: few words that come often, in long segments, each of which holds many of them.
SEGMENTS, RUN = (64, 2000), 8
#: How many times as often a run of letters is in toxic documents, at least (both rates with a standard deviation against it).
LIFT = 10.0
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Least distances, in bytes, at which windows are counted.
CELLS = (5, 7, 9, 11, 13, 15, 18)
#: Standard deviations above the chance count that are taken off, and steps for each unit of the sums that the threshold is chosen from.
ABOVE, STEPS = 2.0, 64
REMEMBERED = 150_000
_CODE = np.random.RandomState(7).randint(0, 256, (256, STRETCH)).astype(np.uint8)


def stretched(window: bytes) -> bytes:
    """A window with a blank on each side, each byte as its fixed code."""
    return _CODE[np.frombuffer(b" " + window + b" ", np.uint8)].tobytes()


def windows_of(text: bytes) -> Iterator[list[bytes]]:
    """Words, lower-cased, without marks around; longer ones in windows of WINDOW bytes."""
    for words, _ in word_blocks(text, 0):
        yield [w for x in words for y in [x.strip(MARKS)] for w in ([y] if len(y) <= WINDOW else [y[i : i + WINDOW] for i in range(0, len(y), WINDOW)]) if w]


def lowered(text: str | None) -> bytes:
    return (text or "").lower().encode()


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    frame = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
    if not content:
        return zstandard.ZstdCompressor(level=LEVEL, **frame)
    # what zstandard trained; without samples enough for that, the samples themselves
    trained = zstandard.DICT_TYPE_FULLDICT if content.startswith(b"\x37\xa4\x30\xec") else zstandard.DICT_TYPE_RAWCONTENT
    found = zstandard.ZstdCompressionDict(content, dict_type=trained)
    found.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=found, **frame)


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    weights: np.ndarray
    bias: float
    chance: np.ndarray

    def __post_init__(self):
        self.ready = False

    def __getstate__(self):
        return {k: getattr(self, k) for k in ("ordinary", "toxic", "weights", "bias", "chance")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.ready = False

    def prepare(self) -> None:
        if not self.ready:
            self.by_ordinary, self.by_toxic = _compressor(self.ordinary), _compressor(self.toxic)
            self.memory: dict[bytes, int] = {}
            self.ready = True

    def distance(self, window: bytes) -> int:
        """Bytes that a window takes fewer with the toxic dictionary than with the ordinary one."""
        body = stretched(window)
        return len(self.by_ordinary.compress(body)) - len(self.by_toxic.compress(body))

    def counts(self, text: bytes) -> np.ndarray:
        """Windows at each least distance, and in all."""
        self.prepare()
        out = np.zeros(len(CELLS) + 1)
        memory = self.memory
        for words in windows_of(text):
            out[-1] += len(words)
            if len(memory) > REMEMBERED:
                memory.clear()
            for w in set(words).difference(memory):
                memory[w] = self.distance(w)
            for gap, n in Counter(map(memory.__getitem__, words)).items():
                for i, least in enumerate(CELLS):
                    if gap >= least:
                        out[i] += n
        return out

    def sum(self, text: bytes) -> float:
        return float(features(self.counts(text), self.chance) @ self.weights)

    def score(self, text: bytes) -> float:
        z = self.sum(text) + self.bias
        return 1 / (1 + float(np.exp(-np.clip(z, -30, 30))))


def grams(word: bytes) -> set[bytes]:
    framed = b" " + word + b" "
    return {framed[i : i + GRAM] for i in range(len(framed) - GRAM + 1)}


def tells(toxic: int, ordinary: int, all_toxic: int, all_ordinary: int) -> bool:
    """Whether a run of letters, in as many toxic and ordinary documents, speaks for toxic text; one rule for samples of every size."""
    return (toxic - math.sqrt(toxic)) * all_ordinary > LIFT * (ordinary + math.sqrt(ordinary) + 1) * all_toxic


def train_dictionary(windows: list[bytes], segment: int) -> bytes:
    """A zstandard dictionary trained on windows (with repeats). Where they are too few for zstandard, the windows one after the other."""
    samples = [stretched(w) for w in windows]
    total = sum(map(len, samples))
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, total // 4)), samples, k=segment, d=RUN).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _per_batch(rows: DataFrame, of, names: list[str], schema: str) -> DataFrame:
    """What of(batch's rows, as tuples with the text as bytes) gives for each batch: lists, one for each column."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = of(zip(*(c.to_pylist() for c in batch.columns)))
            if found[0]:
                yield pa.RecordBatch.from_arrays([pa.array(found[0], pa.binary()), *(pa.array(c, pa.int64()) for c in found[1:])], names=names)

    return in_small_batches(rows).mapInArrow(run, schema)


def _gram_counts(rows) -> list[list]:
    seen: Counter = Counter()
    for toxic, half, text in rows:
        words = {w for part in windows_of(lowered(text.decode())) for w in part}
        for g in set().union(*map(grams, words)) if words else ():
            seen[g, toxic, half] += 1
    return [list(c) for c in zip(*((g, t, h, n) for (g, t, h), n in seen.items()))] or [[], [], [], []]


def _window_counts(marked: tuple[frozenset, frozenset, frozenset]):
    """Windows by (toxic, fold, documents): of toxic documents those with a run that is marked in the fold, of ordinary ones all. Fold 2
    is the whole sample."""
    def of(rows) -> list[list]:
        seen: Counter = Counter()
        for toxic, half, text in rows:
            for w in {w for part in windows_of(lowered(text.decode())) for w in part}:
                own = grams(w) if toxic else ()
                for fold in (half, 2):
                    if not toxic or not marked[fold].isdisjoint(own):
                        seen[w, toxic, fold] += 1
        return [list(c) for c in zip(*((w, t, f, n) for (w, t, f), n in seen.items()))] or [[], [], [], []]

    return of


def features(counts: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Of counts in cells and in all (last), the logarithm of what is above chance for that many windows."""
    usual = counts[..., -1:] * chance
    return np.log1p(np.maximum(0, counts[..., :-1] - usual - ABOVE * np.sqrt(usual)))


def calibrate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights that are not negative, by logistic regression with a small penalty, classes weighted alike."""
    share = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    w, b = np.zeros(len(CELLS)), 0.0
    for step in range(4000):
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))
        g = share * (p - y)
        w = np.maximum(0, w - 2.0 * (x.T @ g + 1e-4 * w))
        b -= 2.0 * g.sum()
    return w


def best_cut(steps: dict[int, list[int]]) -> float | None:
    """Of the cuts between the steps, each with its ordinary and toxic documents, the middle of the best by both classes' errors.

    None where the sums tell nothing: where even the best cut parts the classes no better than two samples of their sizes from one distribution may
    be parted (the Kolmogorov-Smirnov bound at 5 %).
    """
    at = sorted(steps)
    n = np.array([steps[i] for i in at], dtype=float).reshape(-1, 2)
    ordinary, toxic = n.sum(axis=0)
    if len(at) < 2 or not ordinary or not toxic:
        return None
    below = np.cumsum(n, axis=0)[:-1] / n.sum(axis=0)
    wrong = below[:, 1] + 1 - below[:, 0]
    if 1 - wrong.min() <= 1.36 * math.sqrt((ordinary + toxic) / (ordinary * toxic)):
        return None
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    i = int(best[len(best) // 2])
    return (at[i] + at[i + 1] + 1) / 2 / STEPS


def prior(steps: dict[int, list[int]]) -> float:
    """The log-odds of a toxic label, under even odds: what a score says where nothing but the labels' counts is known. It rejects nothing."""
    ordinary, toxic = (sum(n[i] for n in steps.values()) for i in (0, 1))
    return min(math.log((toxic + 1) / (ordinary + 1)), math.log(0.49 / 0.51))


def held_out(id: str = "doc_id"):
    """Whether crc32 of the id as text is divisible by 5; a row without id is not held out."""
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _mapped(rows: DataFrame, of, schema: str) -> DataFrame:
    """The columns of `rows` but the last, its text, and what of(row's columns, text) gives."""
    names = [*rows.columns[:-1], schema.split()[0]]
    fields = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [c.to_pylist() for c in batch.columns[:-1]]
            out = [of(row, x.as_py().decode()) for row, x in zip(zip(*own), batch.column(len(own)))]
            kind = pa.list_(pa.binary()) if "binary" in schema else pa.list_(pa.float64()) if "array" in schema else pa.float64()
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, kind)], names=names)

    return in_small_batches(rows).mapInArrow(run, ", ".join([*(f"`{c}` {fields[c]}" for c in names[:-1]), schema]))


def trained(rows: DataFrame) -> list[tuple[bytes, bytes]]:
    """(ordinary, toxic) dictionaries of each half of the sample and of all of it, from the table (toxic, half, text).

    Runs of letters are counted by documents in Spark; the driver gets those that speak for toxic text, and a bounded
    number of windows.
    """
    sizes = {(r.toxic, r.half): r["count"] for r in rows.groupBy("toxic", "half").count().collect()}
    size = lambda toxic, fold: sum(n for (t, h), n in sizes.items() if t == toxic and fold in (h, 2))
    counted = _per_batch(rows, _gram_counts, ["gram", "toxic", "half", "n"], "gram binary, toxic bigint, half bigint, n bigint")
    per = counted.groupBy("gram").agg(*[F.sum(F.when((F.col("toxic") == t) & (F.col("half") == h), F.col("n")).otherwise(0)).alias(f"n{t}{h}") for t in (0, 1) for h in (0, 1)])
    marked: tuple[set, set, set] = (set(), set(), set())
    for r in per.where("n10 + n11 >= 2").toLocalIterator():
        for fold, (t, o) in enumerate(((r.n10, r.n00), (r.n11, r.n01), (r.n10 + r.n11, r.n00 + r.n01))):
            if tells(t, o, size(1, fold), size(0, fold)):
                marked[fold].add(bytes(r.gram))
    sent = tuple(map(frozenset, marked))
    windows = _per_batch(rows, _window_counts(sent), ["window", "toxic", "fold", "n"], "window binary, toxic bigint, fold bigint, n bigint")
    windows = cut_lineage(windows.groupBy("toxic", "fold", "window").agg(F.sum("n").alias("n")))
    out = []
    for fold in range(3):
        pair = []
        for toxic, segment in enumerate(SEGMENTS):
            some = windows.where((F.col("toxic") == toxic) & (F.col("fold") == fold))
            rate = min(1.0, SAMPLE_WINDOWS / max(1, some.agg(F.sum("n")).first()[0] or 0))
            part = F.pmod(F.xxhash64(F.lit(17), "window"), F.lit(1 << 20)) / (1 << 20)
            some = some.select("window", F.floor(F.col("n") * rate + part).alias("n")).where("n > 0")
            chosen = sorted(bytes(r.window) for r in some.toLocalIterator() for _ in range(r.n))
            random.Random(toxic).shuffle(chosen)
            pair.append(train_dictionary(chosen, segment))
        out.append(tuple(pair))
    return out


def fitted(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> tuple[Model, DataFrame | None]:
    """The model, and (doc_id, sum) of every row of `docs` by it, written; None without labels of both kinds.

    Dictionaries and weights come from a bounded sample of the labelled documents (SAMPLE_TOXIC and SAMPLE_ORDINARY of
    them), the threshold from all of them. Only labels 0 and 1 of documents that are not held out are read, and whole
    texts; of different labels of one id the greater counts. The sample is the first by a hash of the id, equal texts of
    one label once. Of the sample bounded numbers of windows and the counts reach the driver, of all documents a
    histogram. Texts are never shuffled but for the sample: all rows are summed where they lie and the sums joined
    with the labels. Without labels of both kinds, or with an empty table, every score is 0; where windows do not tell the labels apart, every
    score is the share of toxic labels, under 0.5.
    """
    docs = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    known = labels.where("toxic in (0, 1) and doc_id is not null").where(~held_out()).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    order = F.xxhash64(F.lit(11), F.col("doc_id"))
    parts = []
    for kind, bound in ((1, SAMPLE_TOXIC), (0, SAMPLE_ORDINARY)):
        parts.append(known.where(F.col("toxic") == kind).orderBy(order, "doc_id").limit(bound))
    sample = cut_lineage(parts[0].unionByName(parts[1]))
    half = F.pmod(F.xxhash64(F.lit(13), F.col("text")), F.lit(2)).cast("int").alias("half")
    rows = docs.where("text is not null").join(F.broadcast(sample), "doc_id").withColumn("sum", F.sha2(F.col("text").cast("binary"), 256)).dropDuplicates(["toxic", "sum"])
    rows = cut_lineage(rows.select("toxic", half, utf8("text").alias("text")))
    nothing = np.zeros(len(CELLS))
    if rows.select("toxic").distinct().count() < 2:
        return Model(b"", b"", nothing, -30.0, nothing), None
    pairs = trained(rows)
    halves = [Model(*pair, nothing, 0.0, nothing) for pair in pairs[:2]]
    context = docs.sparkSession.sparkContext
    sent = context.broadcast(halves)
    found = _mapped(rows, lambda row, text: sent.value[1 - row[1]].counts(lowered(text)).tolist(), "counts array<double>").select("toxic", "counts").collect()
    counts, y = np.array([r.counts for r in found]), np.array([float(r.toxic) for r in found])
    chance = counts[y == 0, :-1].sum(axis=0) / max(1, counts[y == 0, -1].sum())
    w = calibrate(features(counts, chance), y)
    model = Model(*pairs[2], w, 0.0, chance)
    whole = context.broadcast([*(Model(h.ordinary, h.toxic, w, 0.0, chance) for h in halves), model])

    def sums(row: tuple, text: str) -> list[float]:
        """By the model, and for a row of the sample also by the half that has not seen it."""
        body = lowered(text)
        own = whole.value[2].sum(body)
        return [own, own if row[1] is None else whole.value[1 - row[1]].sum(body)]

    marked = docs.join(F.broadcast(sample.select("doc_id", F.lit(True).alias("sampled"))), "doc_id", "left")
    found = _mapped(marked.select("doc_id", F.when(F.col("sampled"), half).alias("half"), utf8("text").alias("text")), sums, "sums array<double>")
    found = cut_lineage(found.select("doc_id", F.col("sums")[0].alias("sum"), F.col("sums")[1].alias("judged")))
    steps: dict[int, list[int]] = {}
    for r in found.join(known, "doc_id").groupBy("toxic", F.floor(F.col("judged") * STEPS).cast("int").alias("step")).count().collect():
        steps.setdefault(r.step, [0, 0])[r.toxic] = r["count"]
    cut = best_cut(steps)
    if cut is None:
        return Model(model.ordinary, model.toxic, nothing, prior(steps), chance), found.select("doc_id", F.lit(0.0).alias("sum"))
    model.bias = -cut
    return model, found.select("doc_id", "sum")


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> Model:
    """The model alone, as `fitted` gives it."""
    return fitted(docs, labels, id, text)[0]


def score_documents(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`id` and score (0 to 1) of every row, from its whole text alone; a null text counts as the empty text.

    Repeated rows stay; no other column is read, whatever its name. The model, of bounded size, goes to every task.
    """
    kind, sent = docs.schema[id].dataType.simpleString(), docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            scores = [own.score(lowered(x.as_py().decode())) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=[id, "score"])

    return in_small_batches(docs.select(id, utf8(text).alias("__text"))).mapInArrow(run, f"`{id}` {kind}, score double")


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` whose score is under 0.5, with all their columns.

    A null or empty text is scored like any other, repeated rows share their fate, a row without doc_id is judged by its
    text, and an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            keep = [own.score(lowered(x.as_py())) < 0.5 for x in batch.column(at)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return in_small_batches(docs).mapInArrow(run, docs.schema)


def classified(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`id` and score (0 to 1) of every row, by a model of these documents' own labels.

    A null text counts as the empty text; repeated rows stay; a row without id is scored like any other. Only the two
    named columns are read, so others may have any name. An empty table gives no rows.
    """
    model, sums = fitted(docs, labels, id, text)
    if sums is None:
        return score_documents(docs, model, id, text)
    return sums.select(F.col("doc_id").alias(id), (1 / (1 + F.exp(-(F.col("sum") + F.lit(float(model.bias)))))).alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: doc_id, held_out, score and predicted of every row of documents, as `classified` defines them."""
    scored = classified(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
