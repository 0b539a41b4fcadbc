"""Personal data: base patterns, and further spans chosen by gradient-boosted trees among overlapping candidates.

Everything that touches texts is a DataFrame expression. A pattern's matches get their places from the pieces between
them. Spans travel as longs that order by kind, then start. Generators with high recall propose candidates that may
overlap each other and the base spans; format and context of each make small integer features.

Labelled findings: a candidate that is a base span counts as positive for its kind, any other as negative. So that the trees
do not only learn the base patterns again, a bounded sample of base spans is rewritten in its own context, in forms that the
patterns do not know (a written-out sign, a number without plus, other separators), and candidates that cover the new form
count as positive too; look-alikes in the same context (a wrong check digit, parts over 255, too few digits) count as
negative. The trees are fitted on counts of candidates for each combination of features, over all documents, bounded by the
combinations of features, not by the documents. Documents whose crc32(doc_id) is divisible by 5 are kept apart; on them, for
each kind, the threshold is set to the least score at which PRECISION of the candidates are findings. Candidates at or over
it become spans too, unless a base span covers them, and the trees themselves become SQL expressions. Base spans always stay.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from allelix.llm.common import cut_lineage, read_table

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.9
ROUNDS, RATE, PENALTY = 24, 0.3, 1.0
#: Patterns of the base spans, written so that no text takes more than linear time: a run is tried at its start only,
#: or where the match before ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
#: A longest run of digits with single spaces or hyphens between, if it has 16 to 19 digits.
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Generators: mail-like with written-out signs, any longer number, phone-like and card-like parts of numbers, addresses with written-out dots.
LIKE_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]++)++"
LIKE_NUMBER = r"(?<![0-9])[+(]{0,2}[0-9](?:[\x20().-]{0,2}[0-9]){6,}+(?![0-9])"
LIKE_PHONE = r"(?<![0-9])(?:\+?[0-9]{1,3}[\x20.-]?)?\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"
LIKE_CARD = r"(?<![0-9])[0-9]{4}(?:[\x20.-]?[0-9]{4}){3}(?![0-9])"
LIKE_IP = r"(?<![0-9.])[0-9]{1,3}+(?:(?:\.|\[\.\]|\x20?\(dot\)\x20?)[0-9]{1,3}+){3}(?![0-9])"
#: Characters of context on each side, and base spans of each kind that are rewritten for training, the first by a hash.
AROUND, SAMPLE = 24, 4000
START_BITS = 30


def _let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def code(kind: int, start: Column, length: Column) -> Column:
    """A span as a long: kind, start, length; longs order as (kind, start)."""
    return F.lit(kind << (2 * START_BITS)).cast("long") + F.shiftleft(start.cast("long"), START_BITS) + length.cast("long")


def _sums(sizes: Column) -> Column:
    """For an array of lengths the sum before each place, in blocks, so that long arrays take near-linear time."""
    block = 256

    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0), lambda x, y: x + y)

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / block).cast("int")), lambda b: total(F.slice(sizes, b * block + 1, F.lit(block))))
    return _let(
        blocks,
        lambda bs: _let(
            F.transform(F.sequence(F.lit(0), F.size(bs) - 1), lambda b: F.when(b == 0, F.lit(0)).otherwise(total(F.slice(bs, F.lit(1), b)))),
            lambda before: F.transform(
                F.sequence(F.lit(0), F.size(sizes) - 1),
                lambda i: F.get(before, F.floor(i / block).cast("int")) + F.when(i % block == 0, F.lit(0)).otherwise(total(F.slice(sizes, (F.floor(i / block) * block + 1).cast("int"), (i % block).cast("int")))),
            ),
        ),
    )


def matches(text: Column, pattern: str, gate: Column) -> Column:
    """array<struct<start, text, before, after>> of a pattern's matches; places in code points, AROUND on each side for context."""
    empty = F.array().cast("array<struct<start:int,text:string,before:string,after:string>>")
    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("p"))

    def place(s: Column) -> Column:
        sizes = F.transform(s.m, lambda m, i: F.length(m) + F.length(F.get(s.p, i)))
        return _let(
            F.struct(s.m.alias("m"), s.p.alias("p"), _let(sizes, _sums).alias("at")),
            lambda t: F.transform(
                t.m,
                lambda m, i: F.struct(
                    (F.get(t.at, i) + F.length(F.get(t.p, i))).cast("int").alias("start"), m.alias("text"),
                    F.right(F.get(t.p, i), F.lit(AROUND)).alias("before"), F.left(F.get(t.p, i + 1), F.lit(AROUND)).alias("after"),
                ),
            ),
        )

    found = F.when(F.size(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))) > 0, _let(both, place))
    return F.when(gate & F.rlike(text, F.lit(pattern)), found).otherwise(empty)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _is_ip(text: Column) -> Column:
    def small(part: Column) -> Column:
        bare = F.regexp_replace(part, "^0+", "")
        return (F.length(bare) < 3) | ((F.length(bare) == 3) & (bare <= F.lit("255")))

    return F.forall(F.split(text, r"\."), small)


def _is_card(text: Column) -> Column:
    return _let(
        _digits(text),
        lambda d: F.aggregate(
            F.sequence(F.lit(1), F.length(d)),
            F.lit(0),
            lambda total, i: total
            + _let(F.substring(d, F.length(d) - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1), lambda x: F.when(x > 9, x - 9).otherwise(x)),
        )
        % 10
        == 0,
    )


def base_spans(text: Column) -> Column:
    """array<bigint>: the base spans of all kinds, in order."""
    has_digit = F.rlike(text, F.lit("[0-9]"))
    checks = (
        (EMAIL, F.contains(text, F.lit("@")), lambda m: F.lit(True)),
        (IP, has_digit, _is_ip),
        (CARD, has_digit, _is_card),
        (PHONE, F.contains(text, F.lit("+")), lambda m: F.length(_digits(m)).between(8, 15)),
    )

    def one(kind: int, pattern: str, gate: Column, ok) -> Column:
        return F.transform(F.filter(matches(text, pattern, gate), lambda s: ok(s.text)), lambda s: code(kind, s.start, F.length(s.text)))

    return F.concat(*[one(kind, *check) for kind, check in enumerate(checks)])


FEATURES = ("maker", "size", "plus", "paren", "dots", "dashes", "spaces", "runs", "longest", "before", "after", "says_phone", "says_card", "says_ip", "says_mail", "written", "luhn", "octets")


def candidates(text: Column) -> Column:
    """array<struct<start, length, features...>>: what all generators propose."""
    has_digit = F.rlike(text, F.lit("[0-9]{2}"))
    mail = F.contains(text, F.lit("@")) | F.rlike(text, F.lit(r"[(\[]at[)\]]"))
    makers = ((LIKE_EMAIL, mail), (LIKE_NUMBER, has_digit), (LIKE_PHONE, has_digit), (LIKE_CARD, has_digit), (LIKE_IP, has_digit))

    def count(s: Column, signs: str, most: int) -> Column:
        return F.least(F.length(F.regexp_replace(s, f"[^{signs}]", "")), F.lit(most))

    def step(n: Column, *ends: int) -> Column:
        return sum(((n >= e).cast("int") for e in ends), F.lit(0))

    def near(s: Column) -> Column:
        return F.when((F.length(s) == 0) | s.rlike(r"^\s$"), 0).when(s.rlike("^[A-Za-z]$"), 1).otherwise(2)

    def says(s: Column, words: str) -> Column:
        return F.rlike(s, F.lit(f"(?i)(?:{words})")).cast("int")

    def octets(t: Column) -> Column:
        parts = F.regexp_extract_all(t, F.lit("[0-9]+"), F.lit(0))
        return F.when(F.size(parts) == 4, F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= F.lit("255")))).cast("int")).otherwise(0)

    def describe(maker: int):
        return lambda s: F.struct(
            s.start.alias("start"), F.length(s.text).alias("length"), F.lit(maker).alias("maker"),
            step(F.length(_digits(s.text)), 8, 10, 11, 12, 14, 16, 17, 20).alias("size"),
            F.startswith(s.text, F.lit("+")).cast("int").alias("plus"), F.contains(s.text, F.lit("(")).cast("int").alias("paren"),
            count(s.text, ".", 4).alias("dots"), count(s.text, "-", 2).alias("dashes"), count(s.text, r"\x20", 3).alias("spaces"),
            F.least(F.size(F.regexp_extract_all(s.text, F.lit("[0-9]+"), F.lit(0))), F.lit(5)).alias("runs"),
            step(F.array_max(F.transform(F.split(s.text, "[^0-9]+"), lambda x: F.length(x))), 4, 5, 10).alias("longest"),
            near(F.right(s.before, F.lit(1))).alias("before"), near(F.left(s.after, F.lit(1))).alias("after"),
            says(s.before, "phone|tel|call|fax|mobile").alias("says_phone"), says(s.before, "card|visa|credit|paid").alias("says_card"),
            says(s.before, "ip|host|server|addr").alias("says_ip"), says(s.before, "mail|contact|write").alias("says_mail"),
            F.rlike(s.text, F.lit(r"[(\[](?:at|dot|\.)[)\]]|\x20?@\x20")).cast("int").alias("written"),
            F.when(F.length(_digits(s.text)).between(16, 19), _is_card(s.text).cast("int")).otherwise(0).alias("luhn"),
            octets(s.text).alias("octets"),
        )

    return F.concat(*[F.transform(matches(text, p, gate), describe(i)) for i, (p, gate) in enumerate(makers)])


@dataclass(frozen=True)
class Tree:
    """Splits on (feature >= cut): the first, then one on each side; four leaf values."""

    first: tuple[int, int]
    low: tuple[int, int]
    high: tuple[int, int]
    leaves: tuple[float, float, float, float]

    def value(self, get) -> Column:
        at = lambda s: get(FEATURES[s[0]]) >= s[1]
        a, b, c, d = (F.lit(x) for x in self.leaves)
        return F.when(at(self.first), F.when(at(self.high), d).otherwise(c)).otherwise(F.when(at(self.low), b).otherwise(a))

    def values(self, x: np.ndarray) -> np.ndarray:
        high = x[:, self.first[0]] >= self.first[1]
        side = np.where(high, x[:, self.high[0]] >= self.high[1], x[:, self.low[0]] >= self.low[1])
        return np.array(self.leaves)[2 * high + side]


@dataclass(frozen=True)
class Boosted:
    """Trees of one kind, and the score from which a candidate becomes a span."""

    start: float
    trees: tuple[Tree, ...]
    threshold: float

    def score(self, get) -> Column:
        return sum((t.value(get) for t in self.trees), F.lit(self.start))


def boost(x: np.ndarray, positive: np.ndarray, negative: np.ndarray) -> tuple[float, tuple[Tree, ...]]:
    """Gradient boosting with logistic loss over feature combinations and how often each was positive and negative."""
    total, n = positive + negative, len(x)
    start = float(np.log((positive.sum() + 0.5) / (negative.sum() + 0.5)))
    score, trees = np.full(n, start), []
    cuts = [(f, c) for f in range(x.shape[1]) for c in np.unique(x[:, f])[1:].tolist()]
    masks = np.array([x[:, f] >= c for f, c in cuts], dtype=float).reshape(len(cuts), n)

    def split(inside: np.ndarray, g: np.ndarray, h: np.ndarray) -> int:
        gi, hi = g * inside, h * inside
        gr, hr = masks @ gi, masks @ hi
        gl, hl = gi.sum() - gr, hi.sum() - hr
        return int(np.argmax(gr**2 / (hr + PENALTY) + gl**2 / (hl + PENALTY)))

    for _ in range(ROUNDS if cuts else 0):
        p = 1 / (1 + np.exp(-score))
        g, h = total * p - positive, total * p * (1 - p)
        first = split(np.ones(n), g, h)
        high, low = split(masks[first], g, h), split(1 - masks[first], g, h)
        leaves = []
        for side, second in ((1 - masks[first], low), (masks[first], high)):
            for part in (1 - masks[second], masks[second]):
                inside = side * part
                leaves.append(float(-RATE * (g * inside).sum() / ((h * inside).sum() + PENALTY)))
        trees.append(Tree(cuts[first], cuts[low], cuts[high], tuple(leaves)))
        score = score + trees[-1].values(x)
    return start, tuple(trees)


def _unsigned(span: Column) -> tuple[Column, Column, Column]:
    """Kind, start and length of a span code."""
    mask = F.lit((1 << START_BITS) - 1)
    return F.shiftright(span, 2 * START_BITS).cast("int"), F.shiftright(span, START_BITS).bitwiseAND(mask).cast("int"), span.bitwiseAND(mask).cast("int")


def rewritten(kind: Column, text: Column) -> Column:
    """array<struct<text, positive>>: a base span's other forms, and its look-alikes."""
    digits = _digits(text)
    swap = lambda x, a, b: F.replace(x, F.lit(a), F.lit(b))
    last = F.right(digits, F.lit(1)).cast("int")
    wrong = F.concat(F.left(digits, F.length(digits) - 1), ((last + 1) % 10).cast("string"))
    quads = lambda d, sign: F.regexp_replace(d, "([0-9]{4})(?=[0-9])", "$1" + sign)
    ten = F.right(digits, F.lit(10))
    cut = lambda a, n: F.substring(ten, a, n)
    forms = {
        0: ([swap(text, "@", " (at) "), swap(text, "@", "[at]"), swap(text, "@", " @ "), swap(swap(text, "@", " (at) "), ".", " (dot) ")], [F.element_at(F.split(text, "@"), 1), F.element_at(F.split(text, "@"), -1)]),
        1: ([swap(text, ".", "[.]"), swap(text, ".", " (dot) ")], [F.regexp_replace(text, r"^[0-9]+", "7300"), F.regexp_replace(text, r"\.[0-9]+$", ".2024"), swap(text, ".", "-")]),
        2: ([quads(digits, ".")], [wrong, quads(wrong, " "), quads(wrong, "-"), quads(wrong, ".")]),
        3: ([F.concat(F.lit("("), cut(1, 3), F.lit(") "), cut(4, 3), F.lit("-"), cut(7, 4)), F.concat_ws("-", cut(1, 3), cut(4, 3), cut(7, 4)), F.concat_ws(".", cut(1, 3), cut(4, 3), cut(7, 4))], [F.concat_ws("-", cut(4, 3), cut(7, 4)), F.concat_ws("-", F.lit("2024"), cut(1, 2), cut(3, 2)), F.concat_ws(".", cut(1, 2), cut(3, 2), cut(5, 4))]),
    }
    listed = lambda pair: F.array(*[F.struct(t.alias("text"), F.lit(good).alias("positive")) for good, ts in zip((True, False), pair) for t in ts])
    out = F.lit(None).cast("array<struct<text:string,positive:boolean>>")
    for k, pair in forms.items():
        out = F.when(kind == k, listed(pair)).otherwise(out)
    return out


def training_candidates(found: DataFrame, texts: DataFrame) -> DataFrame:
    """(apart, is_0 to is_3, features) of candidates in rewritten contexts of sampled base spans.

    found: (doc_id, base); texts: (doc_id, text). Of each kind the first SAMPLE spans by a hash are taken; only their documents' texts are read.
    """
    spans = found.where("doc_id is not null").select("doc_id", F.explode("base").alias("span")).withColumn("kind", _unsigned(F.col("span"))[0])
    order = F.xxhash64(F.lit(31), "doc_id", "span")
    parts = [spans.where(F.col("kind") == k).orderBy(order, "doc_id", "span").limit(SAMPLE) for k in range(len(KINDS))]
    sample = cut_lineage(parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).groupBy("doc_id").agg(F.collect_list("span").alias("spans")))
    own = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "text", F.explode("spans").alias("span"))
    kind, start, length = _unsigned(F.col("span"))
    around = own.select(
        _apart().alias("apart"), kind.alias("kind"), F.substring(F.col("text"), F.greatest(start - AROUND, F.lit(0)) + 1, F.least(start, F.lit(AROUND))).alias("before"),
        F.substring(F.col("text"), start + 1, length).alias("span"), F.substring(F.col("text"), start + length + 1, F.lit(AROUND)).alias("after"),
    )
    forms = around.select("apart", "kind", "before", "after", F.explode(rewritten(F.col("kind"), F.col("span"))).alias("form")).where("form.text <> ''")
    placed = forms.select("apart", "kind", "form.positive", F.length("before").alias("a"), F.length("form.text").alias("n"), candidates(F.concat("before", "form.text", "after")).alias("cs"))
    rows = placed.select("apart", "kind", "positive", "a", "n", F.explode("cs").alias("c"))
    shared = F.least(F.col("c.start") + F.col("c.length"), F.col("a") + F.col("n")) - F.greatest("c.start", "a")
    rows = rows.where(shared > 0)  # what else stands in the context is in the documents anyhow
    covers = F.col("positive") & (shared * 10 >= F.col("n") * 9) & (shared * 10 >= F.col("c.length") * 9)
    return rows.select("apart", *[(covers & (F.col("kind") == k)).cast("int").alias(f"is_{k}") for k in range(len(KINDS))], *[F.col(f"c.{f}").alias(f) for f in FEATURES])


def _apart() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(found: DataFrame, texts: DataFrame | None = None) -> tuple[Boosted | None, ...]:
    """The trees of each kind, from the tables (doc_id, base, candidates) and (doc_id, text); None for a kind without positives."""
    c = F.col("c")
    is_base = [F.array_contains("base", code(k, c.start, c.length)).cast("int") for k in range(len(KINDS))]
    rows = found.where(F.size("candidates") > 0).select(_apart().alias("apart"), "base", F.explode("candidates").alias("c"))
    rows = rows.select("apart", *[b.alias(f"is_{k}") for k, b in enumerate(is_base)], *[F.col(f"c.{f}").alias(f) for f in FEATURES])
    if texts is not None:
        rows = rows.unionByName(training_candidates(found.select("doc_id", "base"), texts))
    counts = rows.groupBy("apart", *FEATURES).agg(F.count("*").alias("n"), *[F.sum(f"is_{k}").alias(name) for k, name in enumerate(KINDS)])
    table = sorted(tuple(r) for r in counts.collect())
    if not table:
        return (None,) * len(KINDS)
    data = np.array([t[1:] for t in table], dtype=float)
    apart = np.array([t[0] for t in table])
    x, n = data[:, : len(FEATURES)].astype(int), data[:, len(FEATURES)]
    out: list[Boosted | None] = []
    for k in range(len(KINDS)):
        hits = data[:, len(FEATURES) + 1 + k]
        use = ~apart if hits[~apart].sum() else np.ones(len(x), dtype=bool)
        if not hits[use].sum():
            out.append(None)
            continue
        start, trees = boost(x[use], hits[use], (n - hits)[use])
        score = np.full(len(x), start) + sum((t.values(x) for t in trees), np.zeros(len(x)))
        test = apart if hits[apart].sum() else use
        order = np.argsort(-score[test], kind="stable")
        s, good, seen = score[test][order], np.cumsum(hits[test][order]), np.cumsum(n[test][order])
        last = np.append(s[:-1] != s[1:], True)  # equal scores stand or fall together
        fine = last & (good >= PRECISION * seen)
        out.append(Boosted(start, trees, float(s[fine].min()) - 1e-9 if fine.any() else float("inf")))
    return tuple(out)


def all_spans(model: Sequence[Boosted | None]) -> Column:
    """array<bigint>: the base spans and the candidates over their kind's threshold, in order, without repeats. A candidate inside a base span
    adds nothing, and of candidates of one kind that begin alike the longest stays."""
    mask = F.lit((1 << START_BITS) - 1)

    def chosen(k: int, m: Boosted) -> Column:
        inside = lambda c: F.exists("base", lambda b: (F.shiftright(b, START_BITS).bitwiseAND(mask) <= c.start) & (c.start + c.length <= F.shiftright(b, START_BITS).bitwiseAND(mask) + b.bitwiseAND(mask)))
        return F.transform(F.filter("candidates", lambda c: (m.score(lambda f: c[f]) >= m.threshold) & ~inside(c)), lambda c: code(k, c.start, c.length))

    parts = [chosen(k, m) for k, m in enumerate(model) if m is not None and m.threshold < float("inf")]
    new = F.array_sort(F.array_distinct(F.concat(F.array().cast("array<bigint>"), *parts)))
    longest = F.filter(new, lambda s, i: F.coalesce(F.shiftright(F.get(new, i + 1), START_BITS) != F.shiftright(s, START_BITS), F.lit(True)))
    return F.array_sort(F.array_distinct(F.concat("base", longest)))


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    mask = (1 << START_BITS) - 1
    name = F.array(*[F.lit(k) for k in KINDS])

    def one(s: Column) -> Column:
        start = F.shiftright(s, START_BITS).bitwiseAND(F.lit(mask))
        return F.concat_ws(":", F.get(name, F.shiftright(s, 2 * START_BITS).cast("int")), start.cast("string"), (start + s.bitwiseAND(F.lit(mask))).cast("string"))

    return F.array_join(F.transform(spans, one), ",")


def find_spans(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns `keep`, base and spans (arrays of span codes) of every row, whole texts.

    Null and empty texts have none; repeated rows stay; rows without doc_id train nothing but are searched. One of `keep` must be doc_id. The
    found spans, small beside the texts, are written to the checkpoint folder once. An empty table gives no rows.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    found = cut_lineage(docs.select(*keep, base_spans(body).alias("base"), candidates(body).alias("candidates")))
    return found.select(*keep, "base", all_spans(fit(found, docs.select("doc_id", body.alias("text")))).alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first by start counts, and
    what a later one adds goes with it."""
    mask = (1 << START_BITS) - 1
    name = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(F.shiftright(s, START_BITS).bitwiseAND(F.lit(mask)).alias("a"), (-(s.bitwiseAND(F.lit(mask)))).alias("n"), F.shiftright(s, 2 * START_BITS).cast("int").alias("k"))))
    start = F.struct(F.array().cast("array<string>").alias("parts"), F.lit(0).cast("long").alias("at"))

    def add(acc: Column, s: Column) -> Column:
        end = F.greatest(acc["at"], s.a - s.n)
        new = F.concat(F.substring(text, (acc["at"] + 1).cast("int"), F.greatest(s.a - acc["at"], F.lit(0)).cast("int")), F.get(name, s.k))
        return F.struct(F.when(s.a >= acc["at"], F.concat(acc["parts"], F.array(new))).otherwise(acc["parts"]).alias("parts"), end.cast("long").alias("at"))

    done = F.aggregate(ordered, start, add, lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substring(text, (acc["at"] + 1).cast("int"), F.lit(1 << 30))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def redact(docs: DataFrame) -> DataFrame:
    """`docs` with its columns, the spans in `text` redacted and n_chars, if there, counted anew; no row goes. Null texts stay null, repeated
    rows and rows without doc_id stay."""
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("__row"))
    found = find_spans(rows, ("doc_id", "__row"))
    found = found.select("__row", redacted(F.col("__row.text"), F.col("spans")).alias("__new"))
    new = {"text": F.col("__new"), "n_chars": F.length("__new")}
    return found.select(*[new.get(c, F.col(f"__row.`{c}`")).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: counts, digest and all spans of every row of documents, as `find_spans` defines them."""
    found = find_spans(read_table(spark, sf_dir, "documents"))
    number = lambda k: F.size(F.filter("base", lambda s: F.shiftright(s, 2 * START_BITS) == k)).cast("long").alias(f"n_{KINDS[k]}")
    return found.select("doc_id", *[number(k) for k in range(len(KINDS))], F.sha2(written(F.col("base")).cast("binary"), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
