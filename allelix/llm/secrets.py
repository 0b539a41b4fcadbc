"""Secret scans: base patterns, and a character convolutional network over candidates with their context.

A candidate is a base finding, a run without white space of 16 characters or more that holds a digit, or a part of a run
between delimiters that holds a digit or follows a word that speaks of secrets. The network reads every candidate whole, with
the characters before and after it and the zone that each is in: embedding, convolution, the greatest answer of each
filter over all places, and one output for each kind. A candidate of any length gives one set of answers, as the greatest
is taken piece by piece.

Labelled findings: base findings with their contexts, and the same findings rewritten in ways that the base patterns do not
know (other names of the key, other prefixes, upper-case hex). Labelled as no findings: other candidates of the texts, and
the contexts of findings with plain words in the finding's place. All distinct ones take part, dealt into shards by a hash of the
finding. Three quarters of them train the network: each round every shard goes on from the mean of all shards' networks, in numpy in its
own task, and their mean, by rows, is taken again. The other quarter calibrates the outputs and sets each kind's threshold, by counts of all its scores in steps of STEP:
halfway between the highest that still finds RECALL of its findings and the lowest of PRECISION, or that lowest one alone if it still finds LEAST of them, or
none. PRECISION of what scores over a threshold are then findings, in that part and, at that part's rate of errors, among the candidates of all texts. Candidates over a threshold become spans
too; base spans always stay.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allelix.llm.common import cut_lineage, in_small_batches, read_table, shuffle_width, utf8

KINDS = ("assign", "access", "hex")
#: Characters of context before and after; candidates are padded to multiples of INSIDE, and read in pieces of PIECE.
BEFORE, INSIDE, AFTER, PIECE = 24, 36, 12, 1024
LETTERS, DEPTH, FILTERS, SPAN = 100, 8, 24, 5
RECALL, LEAST, PRECISION = 0.99, 0.9, 0.9
#: Labelled windows, and bytes of them, of one shard in the mean: shards become more, not larger. Parts of one by which means are summed as whole numbers.
SHARD_ROWS, SHARD_BYTES, UNIT = 8192, 8 << 20, 1 << 24
#: Outputs of the network are counted in steps up to LIMIT either way.
STEP, LIMIT = 1 / 64, 64
#: Passes, and steps at least; the speed falls to a twentieth.
EPOCHS, STEPS, BATCH, SPEED = 12, 300, 128, 0.01
ASSIGN = re.compile("(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile("AKIA[A-Z0-9]+")
#: As many as a finding needs: runs are found whole, and shorter ones are none.
HEX = re.compile("[0-9a-f]{32,}")
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
LONG = re.compile(r"(?<!\S)\S{16,}")
PART = re.compile(r"[^\s\"'`=:;,&/|()\[\]{}<>]{8,}")
DIGIT = re.compile("[0-9]")
SPEAKS = re.compile(r"(?i:key|token|secret|passw|passphrase|pwd|credential|auth|bearer)[\w.-]*[\"'`]?\s*(?:[:=]|is)?\s*[\"'`]?$")
EDGES = "\"'`,.;:!?()[]{}<>"


def base_findings(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the base findings, by start, then kind."""
    out = []
    lower = text.lower()
    if any(w in lower for w in WORDS):
        out += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m.group(1)) >= 8]
    if "AKIA" in text:
        out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(out, key=lambda x: (x[0], x[2]))


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, kinds as bits) of the base findings, of long runs and of parts of runs; parts inside a base finding are left out."""
    kinds: dict[tuple[int, int], int] = {}
    for a, b, k in base:
        kinds[a, b] = kinds.get((a, b), 0) | 1 << k
    covered = [(a, b) for a, b, _ in sorted(base)]

    def inside(a: int, b: int) -> bool:
        return any(x <= a and b <= y for x, y in covered)

    for m in LONG.finditer(text):
        run = m.group()
        if DIGIT.search(run):
            bare = run.strip(EDGES)
            if len(bare) >= 16:
                a = m.start() + run.index(bare)
                if not inside(a, a + len(bare)):
                    kinds.setdefault((a, a + len(bare)), 0)
    for m in PART.finditer(text):
        a, b = m.span()
        bare = m.group().rstrip(".!?")
        b = a + len(bare)
        if len(bare) >= 8 and (DIGIT.search(bare) or SPEAKS.search(text, max(0, a - BEFORE), a)) and not inside(a, b):
            kinds.setdefault((a, b), 0)
    return [(a, b, k) for (a, b), k in sorted(kinds.items())]


def _codes(s: str) -> bytes:
    """One byte for each character, from 1 to LETTERS - 1; 0 is for no character."""
    return bytes(ord(c) - 31 if 32 <= ord(c) < 127 else 97 if c.isspace() else 98 if c.isalpha() else 99 for c in s)


def framed(before: str, inside: str, after: str) -> bytes:
    """A candidate whole, with BEFORE and AFTER places around; inside it is padded to a multiple of INSIDE."""
    size = -(-max(1, len(inside)) // INSIDE) * INSIDE
    return _codes(before[-BEFORE:]).rjust(BEFORE, b"\0") + _codes(inside).ljust(size, b"\0") + _codes(after[:AFTER]).ljust(AFTER, b"\0")


def window(text: str, a: int, b: int) -> bytes:
    return framed(text[max(0, a - BEFORE) : a], text[a:b], text[b : b + AFTER])


def zones(width: int) -> np.ndarray:
    return np.repeat([0, 1, 2], [BEFORE, width - BEFORE - AFTER, AFTER])


def _shown(codes: bytes) -> str:
    return "".join(chr(c + 31) if 0 < c < 96 else " " for c in codes if c)


# Names and prefixes by which findings are rewritten.
OTHER_KEYS = ("pwd", "passphrase", "auth", "credential", "client_secret_value", "bearer", "private_key", "pass")
OTHER_PREFIXES = ("ASIA", "AGPA", "AIDA", "AROA")
KEYED = re.compile("(?i:password|passwd|secret|token|api_?key)")


def rewritten(codes: bytes, kind: int, turn: int) -> bytes | None:
    """A finding of a kind in a form that its base pattern does not know; None where there is none."""
    before, inside, after = _shown(codes[:BEFORE]), _shown(codes[BEFORE:-AFTER]), _shown(codes[-AFTER:])
    if kind == 0:
        other = KEYED.sub(OTHER_KEYS[turn % len(OTHER_KEYS)], inside, count=1)
        name, sign, value = re.match(r"([\w]*[\"']?\s*)([:=])(.*)", other, re.S).groups() if re.match(r"[\w]*[\"']?\s*[:=]", other) else ("", "", "")
        if not value.strip(" \"'"):
            return None
        lead, bare = f"{before}{name}{sign if turn % 3 else ' is '}", value.lstrip(" \"'")
        return framed(lead, bare, after)
    if kind == 1:
        return framed(before, OTHER_PREFIXES[turn % len(OTHER_PREFIXES)] + inside[4:], after)
    return framed(before, inside.upper(), after) if inside.upper() != inside else None


def look_alike(codes: bytes, turn: int) -> bytes | None:
    """The context of a finding with plain words of that context in its place, joined as identifiers are; None without any."""
    before, after = _shown(codes[:BEFORE]), _shown(codes[-AFTER:])
    words = re.findall(r"[a-z]{3,}", (before + " " + after).lower())
    if not words:
        return None
    picked = [words[(turn + i) % len(words)] for i in range(2 + turn % 3)]
    return framed(before, "-_."[turn % 3].join(picked) + ("" if turn % 2 else str(turn % 100)), after)


@dataclass
class Network:
    letters: np.ndarray
    zones: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def fresh(cls) -> Network:
        r = np.random.default_rng(20240607)
        return cls(r.normal(0, 0.3, (LETTERS, DEPTH)), r.normal(0, 0.3, (3, DEPTH)), r.normal(0, 1 / np.sqrt(SPAN * DEPTH), (SPAN * DEPTH, FILTERS)), np.zeros(FILTERS), r.normal(0, 0.3, (FILTERS, len(KINDS))), np.zeros(len(KINDS)))

    def parameters(self) -> list[np.ndarray]:
        return [self.letters, self.zones, self.filters, self.bias, self.out, self.out_bias]

    def forward(self, x: np.ndarray) -> tuple:
        """For rows of one width: the places and the inputs of each filter's greatest answer, the answers, and the outputs."""
        zone = zones(x.shape[1])
        best, at = self.best_answers(x, zone)
        where = at[:, :, None] + np.arange(SPAN)
        near = x[np.arange(len(x))[:, None, None], where]
        chosen = (self.letters[near] + self.zones[zone[where]]).reshape(len(x), FILTERS, SPAN * DEPTH)
        hidden = np.maximum(best, 0)
        return near, zone[where], chosen, best, hidden, hidden @ self.out + self.out_bias

    def best_answers(self, codes: np.ndarray, zone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The greatest answer of each filter over all places of rows of one width, and its first place, piece by piece."""
        best, place = np.full((len(codes), FILTERS), -np.inf), np.zeros((len(codes), FILTERS), dtype=np.int64)
        for at in range(0, codes.shape[1] - SPAN + 1, PIECE):
            part = slice(at, at + PIECE + SPAN - 1)
            places = self.letters[codes[:, part]] + self.zones[zone[part]]
            wide = np.lib.stride_tricks.sliding_window_view(places, SPAN, axis=1).transpose(0, 1, 3, 2).reshape(len(codes), -1, SPAN * DEPTH)
            answer = wide @ self.filters
            first = answer.argmax(axis=1)
            most = np.take_along_axis(answer, first[:, None, :], axis=1)[:, 0]
            place = np.where(most > best, at + first, place)
            best = np.maximum(best, most)
        return best + self.bias, place

    def logits(self, windows: list[bytes]) -> np.ndarray:
        """Of candidates of any length: those of one width at once, in parts of bounded size."""
        out = np.zeros((len(windows), len(KINDS)))
        by_width: dict[int, list[int]] = {}
        for i, w in enumerate(windows):
            by_width.setdefault(len(w), []).append(i)
        for width, rows in by_width.items():
            step = max(1, 512 * 72 // min(width, PIECE))
            for at in range(0, len(rows), step):
                some = rows[at : at + step]
                codes = np.stack([np.frombuffer(windows[i], np.uint8) for i in some])
                out[some] = np.maximum(self.best_answers(codes, zones(width))[0], 0) @ self.out + self.out_bias
        return out

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        near, zone, chosen, best, hidden, z = self.forward(x)
        dz = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(x)
        dh = (dz @ self.out.T) * (best > 0)
        d_filters = np.einsum("nf,nfs->sf", dh, chosen)
        back = (dh[:, :, None] * self.filters.T[None]).reshape(len(x), FILTERS, SPAN, DEPTH)
        by = lambda rows, of: np.bincount((rows[..., None].astype(np.int64) * DEPTH + np.arange(DEPTH)).ravel(), back.ravel(), of.size).reshape(of.shape)
        return [by(near, self.letters), by(zone, self.zones), d_filters, dh.sum(axis=0), hidden.T @ dz, dz.sum(axis=0)]


@dataclass
class Model:
    network: Network
    slope: np.ndarray
    shift: np.ndarray
    #: Outputs of the network from which a candidate counts, by kind.
    thresholds: np.ndarray

    def scores(self, z: np.ndarray) -> np.ndarray:
        """Chances of outputs of the network."""
        return 1 / (1 + np.exp(-np.clip(z * self.slope + self.shift, -30, 30)))


def train(windows: list[bytes], y: np.ndarray, start: Network | None = None, epochs: int | None = None, seed: int = 1, speed: tuple[float, float] = (1, 0.05)) -> Network:
    """Adam over shuffled batches of windows of one width each, from `start` on; speed: its parts at the beginning and at the end."""
    net, r = start or Network.fresh(), np.random.default_rng(seed)
    first = [np.zeros_like(p) for p in net.parameters()]
    second = [np.zeros_like(p) for p in net.parameters()]
    by_width: dict[int, list[int]] = {}
    for i, w in enumerate(windows):
        by_width.setdefault(len(w), []).append(i)
    step, epochs = 0, epochs or max(EPOCHS, -(-STEPS * BATCH // max(1, len(windows))))
    for turn in range(epochs):
        batches = []
        for width, rows in by_width.items():
            size = min(BATCH, max(1, 64 * PIECE // width))
            batches += [[rows[i] for i in part] for part in np.array_split(r.permutation(len(rows)), -(-len(rows) // size))]
        for i, at in enumerate(r.permutation(len(batches))):
            rows = batches[at]
            rate = SPEED * (speed[0] + (speed[1] - speed[0]) * (turn + i / len(batches)) / epochs)
            x = np.stack([np.frombuffer(windows[i], np.uint8) for i in rows])
            step += 1
            for p, m, v, g in zip(net.parameters(), first, second, net.gradients(x, y[rows])):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def calibrate(net: Network, counts: np.ndarray, everywhere: np.ndarray) -> Model:
    """Platt scaling of each output, and the threshold of each kind; infinity where none is precise, or without findings.

    counts: windows by kind, step of the output, and what they are (no finding, one of another kind, one of this kind); everywhere: by kind and
    step, candidates of all texts without a base finding.
    """
    z = (np.arange(counts.shape[1]) + 0.5) * STEP - LIMIT
    slope, shift, thresholds = np.ones(len(KINDS)), np.zeros(len(KINDS)), np.full(len(KINDS), np.inf)
    for k in range(len(KINDS)):
        found, others = counts[k, :, 2], counts[k, :, 0] + counts[k, :, 1]
        n = found + others
        target = found * (found.sum() + 1) / (found.sum() + 2) + others / (others.sum() + 2)
        for _ in range(500):
            g = n / (1 + np.exp(-np.clip(z * slope[k] + shift[k], -30, 30))) - target
            slope[k] = max(0.01, slope[k] - 0.05 * (g * z).sum() / max(1, n.sum()))
            shift[k] -= 0.5 * g.sum() / max(1, n.sum())
        if found.sum():
            over = lambda n: np.cumsum(n[::-1])[::-1]
            # a finding of another kind is no error: each candidate becomes one span
            wrong, right = over(counts[k, :, 0]), over(found)
            fine = wrong <= (1 - PRECISION) * over(counts[k].sum(axis=1))
            fine &= wrong / max(1, counts[k, :, 0].sum()) * everywhere[k].sum() <= (1 - PRECISION) * np.maximum(1, over(everywhere[k]))
            most = np.flatnonzero(right >= np.ceil(RECALL * found.sum()))[-1]
            if fine[most]:
                thresholds[k] = z[(most + np.append(np.flatnonzero(~fine[:most]), -1).max() + 1) // 2] - STEP / 2
            elif (able := np.flatnonzero(fine & (right >= LEAST * found.sum()))).size:
                thresholds[k] = z[able[0]] - STEP / 2
    return Model(net, slope, shift, thresholds)


def _steps(z: np.ndarray) -> np.ndarray:
    """The step in which each output is counted."""
    return np.clip(np.floor((z + LIMIT) / STEP), 0, 2 * LIMIT / STEP - 1).astype(np.int64)


CANDIDATES = "array<struct<a:int,b:int,kinds:int,window:binary>>"


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, base (array<struct<a,b,kind>>) and candidates of every row; whole texts, null as the empty text. Repeated rows and null ids
    stay; no other column is read, whatever its name."""
    kind = docs.schema[id].dataType.simpleString()
    base_type = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("kind", pa.int32())]))
    type_ = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("kinds", pa.int32()), ("window", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, found = [], []
            for x in batch.column(1):
                body = x.as_py().decode()
                own = base_findings(body)
                base.append([{"a": a, "b": b, "kind": k} for a, b, k in own])
                found.append([{"a": a, "b": b, "kinds": k, "window": window(body, a, b)} for a, b, k in candidates(body, own)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, base_type), pa.array(found, type_)], names=["doc_id", "base", "candidates"])

    schema = f"doc_id {kind}, base array<struct<a:int,b:int,kind:int>>, candidates {CANDIDATES}"
    return in_small_batches(docs.select(F.col(id).alias("doc_id"), utf8(text).alias("__text"))).mapInArrow(run, schema)


def labelled(kinds: int, window: bytes) -> list[tuple[bytes, int]]:
    """(window, kinds) of a candidate as it is, of its findings rewritten, and of their look-alikes."""
    turn = int.from_bytes(hashlib.sha256(window).digest()[:4], "big")
    out = [(window, kinds)]
    for k in range(len(KINDS)):
        if kinds >> k & 1:
            out += [(rewritten(window, k, turn), 1 << k), (look_alike(window, turn), 0)]
    return [(w, k) for w, k in out if w is not None]


def _labels(kinds) -> np.ndarray:
    return (np.asarray(kinds, dtype=np.int64)[:, None] >> np.arange(len(KINDS)) & 1).astype(float)


def labelled_windows(rows: DataFrame) -> DataFrame:
    """(hash, aside, kinds, window) of all distinct candidates (kinds, window), as `labelled` gives them; aside tells those kept apart. All forms of one
    candidate have its hash and are kept apart together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = [(h, k, w) for h, kinds, window in zip(*(c.to_pylist() for c in batch.columns)) for w, k in labelled(kinds, window)]
            hashes, kinds, windows = zip(*forms) if forms else ((), (), ())
            aside = pa.array([h % 4 == 0 for h in hashes], pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), aside, pa.array(kinds, pa.int32()), pa.array(windows, pa.binary())], names=["hash", "aside", "kinds", "window"])

    distinct = rows.groupBy("window", "kinds").agg(F.xxhash64(F.lit(3), "window").alias("hash"))
    return in_small_batches(distinct.select("hash", "kinds", "window")).mapInArrow(run, "hash bigint, aside boolean, kinds int, window binary")


def train_on_all(forms: DataFrame) -> Network:
    """A network trained on all rows (hash, kinds, window): iterative parameter mixing over shards, each round one pass of each shard over its rows.

    Shards are dealt once. Their sizes are bounded in the mean, so they become more with the rows; one shard alone takes all its passes at once. Means are
    sums of whole numbers, so they do not hang on the order of tasks.
    """
    spark = forms.sparkSession
    n, size = forms.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("window")), F.lit(0))).first()
    shards = max(1, -(-n // SHARD_ROWS), -(-size // SHARD_BYTES))
    shard = F.pmod(F.shiftright("hash", 2), F.lit(shards)).alias("shard")  # the lowest bits tell what is kept apart
    dealt = forms.select(shard, "kinds", "window").repartition(min(shards, 4 * shuffle_width(forms)), "shard").sortWithinPartitions("shard", "window", "kinds")
    dealt = cut_lineage(dealt)
    shapes = [p.shape for p in Network.fresh().parameters()]
    net, rounds = Network.fresh(), 1 if shards == 1 else EPOCHS
    for turn in range(rounds):
        sent = spark.sparkContext.broadcast(net)

        def one(kinds: list, windows: list) -> np.ndarray:
            start = Network(*(p.copy() for p in sent.value.parameters()))
            speed = tuple(1 - 0.95 * (turn + x) / rounds for x in (0, 1))
            own = train(windows, _labels(kinds), start, None if rounds == 1 else 1, turn + 1, speed)
            return np.rint(np.concatenate([p.ravel() for p in own.parameters()]) * (UNIT * len(windows))).astype(np.int64)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, now, kinds, windows = None, None, [], []
            for batch in batches:
                for at, k, w in zip(*(c.to_pylist() for c in batch.columns)):
                    if at != now and windows:
                        total = one(kinds, windows) + (0 if total is None else total)
                        kinds, windows = [], []
                    now = at
                    kinds.append(k)
                    windows.append(w)
            if windows:
                total = one(kinds, windows) + (0 if total is None else total)
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], names=["at", "total"])

        sums = in_small_batches(dealt).mapInArrow(run, "at int, total bigint").groupBy("at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        means = np.zeros(sum(int(np.prod(x)) for x in shapes))
        for r in sums.collect():  # one row for each parameter
            means[r["at"]] = float(r["total"]) / (UNIT * n)
        ends = np.cumsum([int(np.prod(x)) for x in shapes])
        net = Network(*(part.reshape(x) for part, x in zip(np.split(means, ends[:-1]), shapes)))
    return net


def counted(net: Network, forms: DataFrame) -> np.ndarray:
    """Windows of all rows (kinds, window) by kind, step of the network's output, and what they are: 0 no finding, 1 one of another kind, 2 one of this kind."""
    sent, shape = forms.sparkSession.sparkContext.broadcast(net), (len(KINDS), int(2 * LIMIT / STEP), 3)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = _labels(batch.column(0).to_pylist())
            what = np.where(labels == 1, 2, labels.any(axis=1)[:, None])
            place = np.ravel_multi_index((np.arange(len(KINDS))[None, :], _steps(sent.value.logits(batch.column(1).to_pylist())), what.astype(np.int64)), shape)
            at, n = np.unique(place, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n)], names=["at", "n"])

    out = np.zeros(int(np.prod(shape)))
    for r in in_small_batches(forms.select("kinds", "window")).mapInArrow(run, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[r["at"]] = r["n"]
    return out.reshape(shape)


def fit(found: DataFrame) -> Model | None:
    """The model, from all distinct candidates of all texts; None if no candidate has a base finding.

    For thresholds, candidates without a base finding that score over one are counted over all texts, and as many of all candidates are taken for
    wrong as the part kept apart shows.
    """
    rows = found.where(F.size("candidates") > 0).select(F.explode("candidates").alias("c")).select("c.kinds", "c.window")
    forms = cut_lineage(labelled_windows(rows))
    findings = {r["aside"]: r["n"] for r in forms.groupBy("aside").agg(F.count_if(F.col("kinds") > 0).alias("n")).collect()}
    if not sum(findings.values()):
        return None
    parted = bool(findings.get(True) and findings.get(False))
    net = train_on_all(forms.where(~F.col("aside")) if parted else forms)
    check = counted(net, forms.where("aside") if parted else forms)
    return calibrate(net, check, counted(net, rows.where("kinds = 0"))[:, :, 0])


def find_secrets(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, base and spans (arrays of struct a, b, kind; by start, then kind) of every row; spans hold base.

    Null and empty texts have none; repeated rows stay; no other column is read. An empty table gives no rows.
    """
    found = cut_lineage(scan(docs, id, text))
    sent = docs.sparkSession.sparkContext.broadcast(fit(found))
    kind = docs.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            rows = batch.to_pylist()
            spans = [{(s["a"], s["kind"], s["b"]) for s in r["base"]} for r in rows]
            all_ = [(i, c) for i, r in enumerate(rows) for c in r["candidates"]]
            if all_ and model is not None:
                z = model.network.logits([c["window"] for _, c in all_])
                over = _steps(z) * STEP - LIMIT >= model.thresholds
                for (i, c), ok, p in zip(all_, over, model.scores(z)):
                    best = int(np.argmax(np.where(ok, p, -1.0)))
                    # what a base span covers is found already
                    if ok[best] and not c["kinds"]:
                        spans[i].add((c["a"], best, c["b"]))
            listed = [[{"a": a, "b": b, "kind": k} for a, k, b in sorted(s)] for s in spans]
            type_ = batch.schema.field(1).type
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(listed, type_)], names=["doc_id", "base", "spans"])

    plain = "array<struct<a:int,b:int,kind:int>>"
    return found.mapInArrow(run, f"doc_id {kind}, base {plain}, spans {plain}")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: counts, digest and all spans of every row of documents, as `find_secrets` defines them."""
    found = find_secrets(read_table(spark, sf_dir, "documents"))
    name = F.array(*[F.lit(k) for k in KINDS])
    written = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", F.get(name, s.kind), s.a.cast("string"), s.b.cast("string"))), ",")

    def number(k: int):
        return F.size(F.filter("base", lambda s: s.kind == k)).cast("long").alias(f"n_{KINDS[k]}")

    return found.select("doc_id", *[number(k) for k in range(len(KINDS))], F.sha2(written(F.col("base")).cast("binary"), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
