"""Personal data by candidate spans and gradient-boosted trees.

Fixed patterns give the base spans. Besides, generators of high recall propose spans
that overlap freely: whatever stands around an at sign or its spelt-out forms, and from
each group of digits the spans to each of the next few groups. Boosted trees look at a candidate's format and its
context; candidates over their kind's threshold that touch no base span are added, the
best of overlapping ones first.

The trees learn, by Spark's GBTClassifier, on every document with an id and with at signs
or digits, of any length, in the half that a hash of the id gives. Base spans and
rewritten forms of them (spelt-out signs, other separators, no prefix) are the examples;
all other candidates are counter-examples, every one of them. Besides, at every size,
``PRIOR`` made-up spans of each kind, half in each half, are learnt, so that a kind which a
corpus hardly holds, or in one form only, is fitted as well. A kind's threshold is the
least score at which the other half shows ``PRECISION`` of what is chosen to be examples;
a kind without such a score adds nothing, which is logged. Spark finds the bin bounds of
the features from its own sample of the rows; the counts of the trees are of all rows.

Defined cases: a NULL text is the empty text; rows that repeat are reported each; ids may
repeat or be NULL (rows without one are searched, not fitted on); an empty table is fitted
on the made-up spans alone and gives an empty result; further columns are ignored; texts
of any length are read whole, in time linear in their length.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Row, Window

from fleetpulse.llm.boosting import BINS, DEPTH, LEAST_LEAF, RATE, TREES, BoostedTrees
from fleetpulse.llm.shared import by_value, keep, shared_path, table, whole_text

by_value(__name__)

log = logging.getLogger(__name__)

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.98
# Made-up spans of each kind, half of them for each half, and the characters of a text
# around one.
PRIOR = 80
PRIOR_AROUND = 200

# The base patterns of the contract. Spans are found leftmost first, without overlap;
# the look-behind and the possessive forms change speed only.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

Span = tuple[str, int, int]


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def is_octet(part: str) -> bool:
    bare = part.lstrip("0") or "0"
    return len(bare) <= 3 and int(bare) <= 255


def only_digits(text: str) -> str:
    return "".join(DIGIT.findall(text))


def base_spans(text: str) -> list[Span]:
    """The contract's spans by kind as listed, then start."""
    spans: list[Span] = [("email", *span) for span in emails(text)]
    if DIGIT.search(text) is None:
        return spans
    for match in IP.finditer(text):
        if all(map(is_octet, match.group().split("."))):
            spans.append(("ip", *match.span()))
    for match in CARD.finditer(text):
        if match.end() - match.start() <= 37:
            digits = only_digits(match.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", *match.span()))
    if "+" in text:
        for match in PHONE.finditer(text):
            if 9 <= len(only_digits(match.group())) <= 15:
                spans.append(("phone", *match.span()))
    return spans


SIGNS = ("@", "(at)", "[at]", " at ", "(AT)", "[AT]", " AT ")
NEAR_LOCAL = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?\Z")
NEAR_DOMAIN = re.compile(
    r" ?[A-Za-z0-9-]{1,63}(?:(?:\.| ?[\[(](?:dot|DOT)[\])] ?| dot | DOT )[A-Za-z0-9-]{1,63}){1,4}"
)
GROUP = re.compile(r"[0-9]+")
BETWEEN = re.compile(
    r"[ ().:/+-]{1,2}|\[\.\]| ?(?:\((?:dot|DOT)\)|\[(?:dot|DOT)\]) ?| (?:dot|DOT) "
)
NUMBER_DIGITS = (7, 19)
IP_DIGITS = (4, 12)


def numbers(text: str) -> Iterator[Span]:
    """From each group of digits to each of the next few, for each kind that has digits.

    With a plus before it a number is proposed both ways; an opening bracket belongs to
    it if its closing one does. At most 19 groups follow a start.
    """
    groups = [match.span() for match in GROUP.finditer(text)]
    for i, (start, _) in enumerate(groups):
        digits, last = 0, start
        for j in range(i, len(groups)):
            low, high = groups[j]
            if j > i and not BETWEEN.fullmatch(text, last, low):
                break
            digits, last = digits + high - low, high
            if digits > NUMBER_DIGITS[1]:
                break
            kinds = ["card", "phone"] if digits >= NUMBER_DIGITS[0] else []
            if j == i + 3 and IP_DIGITS[0] <= digits <= IP_DIGITS[1]:
                kinds.append("ip")
            if not kinds:
                continue
            body, first = text[start:high], start
            if body.count(")") > body.count("("):
                if text[start - 1 : start] != "(":
                    continue
                first = start - 1
            firsts = [first, first - 1] if first and text[first - 1] == "+" else [first]
            for kind in kinds:
                for at in firsts:
                    yield kind, at, high


def candidates(text: str) -> list[Span]:
    """Proposed spans, which overlap freely."""
    found: set[Span] = set()
    for sign in SIGNS:
        at = text.find(sign)
        while at >= 0:
            left = NEAR_LOCAL.search(text[max(at - 65, 0) : at])
            right = NEAR_DOMAIN.match(text, at + len(sign))
            if left and right:
                found.add(("email", at - len(left.group()), right.end()))
            at = text.find(sign, at + 1)
    found.update(numbers(text))
    return sorted(found)


CUES = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "server", "addr"),
    "card": ("card", "visa", "credit", "pay"),
    "phone": ("tel", "phone", "call", "mobile", "fax"),
}


PREFIXED = re.compile(r"\+[0-9][0-9 ().-]*\Z")


def features(text: str, span: Span) -> list[float]:
    """Format and context of a candidate."""
    kind, start, end = span
    body = text[start:end]
    digits = only_digits(body)
    groups = re.findall(r"[0-9]+", body)
    before, after = text[max(start - 24, 0) : start], text[end : end + 8]
    lowered = before.lower()
    return [
        len(body),
        len(digits),
        len(groups),
        max(map(len, groups), default=0),
        min(map(len, groups), default=0),
        float(luhn(digits)) if digits else 0.0,
        float(len(groups) == 4 and all(map(is_octet, groups))),
        body.count("."),
        body.count("-"),
        body.count(" "),
        body.count("(") + body.count(")"),
        body.count("["),
        len(set(re.findall(r"(?<=[0-9])[^0-9]+(?=[0-9])", body))),
        body.count(":") + body.count("/"),
        float(body.startswith("+")),
        float(body.startswith("(")),
        body.count("@"),
        sum(c.isalpha() for c in body),
        float("dot" in body.lower()),
        len(re.split(r"[^A-Za-z]+", body)[-1]),
        float(before[-1:].isalnum()),
        float(after[:1].isalnum()),
        float(before[-1:] in "=\"'#$_"),
        float(after[:1] in "=\"'%_"),
        float(any(c.isdigit() for c in before[-3:])),
        float(PREFIXED.search(before) is not None),
        float(any(c.isdigit() for c in after[:3])),
        float(any(cue in lowered for cue in CUES[kind])),
    ]


def rewritten(kind: str, body: str) -> list[str]:
    """Other forms in which people write what a base span holds."""
    digits = only_digits(body)
    if kind == "email":
        local, domain = body.split("@", 1)
        spelt = domain.replace(".", " dot ")
        return [f"{local} (at) {domain}", f"{local}[at]{domain}", f"{local} at {spelt}"]
    if kind == "ip":
        parts = body.split(".")
        return ["[.]".join(parts), " dot ".join(parts), "(dot)".join(parts), "[dot]".join(parts)]
    if kind == "card":
        return [".".join(digits[i : i + 4] for i in range(0, len(digits), 4))]
    if kind == "phone" and len(digits) >= 10:
        area, first, last = digits[-10:-7], digits[-7:-4], digits[-4:]
        return [f"({area}) {first}-{last}", f"{area}-{first}-{last}", f"{area}.{first}.{last}"]
    return []


def made_up(kind: str, number: int) -> str:
    """A base span of a kind, a different one for each number."""
    rng = np.random.default_rng([KINDS.index(kind), number])

    def name() -> str:
        return "".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 9)))

    def digits(size: int) -> str:
        return str(rng.integers(1, 10)) + "".join(map(str, rng.integers(0, 10, size - 1)))

    if kind == "email":
        local = name() + ("", ".", "_", "-")[number % 4] + name()
        return f"{local}@{name()}.{name()[:3]}"
    if kind == "ip":
        return ".".join(map(str, rng.integers(0, 256, 4)))
    if kind == "card":
        start = digits((12, 14, 15, 15)[number % 4])
        whole = next(start + str(last) for last in range(10) if luhn(start + str(last)))
        return ("", " ", "-")[number % 3].join(re.findall(".{1,4}", whole))
    area, first, last = digits(3), digits(3), digits(4)
    country = digits(1 + number % 2)
    return (
        f"+{country} ({area}) {first}-{last}",
        f"+{country}-{area}-{first}-{last}",
        f"+{country} {area} {first} {last}",
        f"+{country}{area}{first}{last}",
    )[number % 4]


def with_made_up(texts: list[str], kind: str, number: int) -> str:
    """The surroundings of a place in one of the texts, with a made-up span put there.

    A third of the spans has a number before it, another third one after it.
    """
    rng = np.random.default_rng([len(KINDS) + KINDS.index(kind), number])
    text = texts[rng.integers(len(texts))] if texts else ""
    at = text.find(" ", rng.integers(len(text) + 1))
    at = len(text) if at < 0 else at
    cue = CUES[kind][number % len(CUES[kind])] + " " if number % 2 else ""
    before, after = text[max(at - PRIOR_AROUND, 0) : at], text[at : at + PRIOR_AROUND]
    beside = str(rng.integers(1, 256))
    first, last = ((f"{beside} ", ""), ("", f" {beside}"), ("", ""))[number // 2 % 3]
    return f"{before} {cue}{first}{made_up(kind, number)}{last}{after}"


@dataclass(frozen=True)
class PiiModel:
    trees: dict[str, BoostedTrees]
    thresholds: dict[str, float]
    examples: int = 0


class Taken:
    """The places of a text that spans cover."""

    def __init__(self, size: int, spans: list[Span]):
        self.places = bytearray(size)
        for _, low, high in spans:
            self.add(low, high)

    def add(self, low: int, high: int) -> None:
        self.places[low:high] = b"\1" * (high - low)

    def overlaps(self, low: int, high: int) -> bool:
        return self.places.find(1, low, high) >= 0


def examples(text: str) -> Iterator[tuple[str, list[float], int]]:
    """Kind, features and label of the candidates of a text and of its rewritten forms.

    Candidates with other bounds than the base span they overlap are counter-examples.
    """
    base = base_spans(text)
    exact = {(low, high): kind for kind, low, high in base}
    taken = Taken(len(text), base)
    own: dict[str, Taken] = {
        k: Taken(len(text), [span for span in base if span[0] == k]) for k in KINDS
    }
    others: dict[str, list[Span]] = {k: [] for k in KINDS}
    for kind, low, high in candidates(text):
        if exact.get((low, high)) == kind:
            yield kind, features(text, (kind, low, high)), 1
        elif (
            (low, high) in exact
            or own[kind].overlaps(low, high)
            or not taken.overlaps(low, high)
        ):
            others[kind].append((kind, low, high))
    for spans in others.values():
        for span in spans:
            yield span[0], features(text, span), 0
    for kind, low, high in base:
        for body in rewritten(kind, text[low:high]):
            at = low - max(low - 24, 0)
            end = at + len(body)
            changed = text[low - at : low] + body + text[high : high + 8]
            yield kind, features(changed, (kind, at, end)), 1
            for span in candidates(changed):
                if span[0] == kind and span[1:] != (at, end) and span[1] < end and at < span[2]:
                    yield kind, features(changed, span), 0


EXAMPLES = "half INT, kind STRING, x ARRAY<DOUBLE>, label DOUBLE"


def labelled(texts: DataFrame) -> DataFrame:
    """``half``, ``kind``, features ``x`` and ``label`` of every example of the texts."""

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            rows = [
                (half, kind, x, float(y))
                for half, text in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                for kind, x, y in examples(text)
            ]
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = [pa.int32(), pa.string(), pa.list_(pa.float64()), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["half", "kind", "x", "label"],
            )

    return texts.select("half", "text").mapInArrow(run, EXAMPLES)


def made_up_texts(spark: SparkSession) -> DataFrame:
    """``half`` and ``text``: ``PRIOR`` made-up spans of each kind, half in each half."""
    rows = [(number % 2, with_made_up([], kind, number)) for kind in KINDS for number in range(PRIOR)]
    return spark.createDataFrame(rows, "half INT, text STRING")


def read_trees(spark: SparkSession, path: str) -> BoostedTrees:
    """The saved trees of a Spark GBT classifier, as complete trees of ``DEPTH`` levels.

    A leaf above the last level is reached through cuts that always go left; the weights and
    the factor 2 of Spark's logistic loss go into the leaf values.
    """
    saved = spark.read.parquet(f"{path}/treesMetadata").toDF("treeID", "metadata", "weights")
    weights = saved.orderBy("treeID").collect()
    nodes: dict[int, dict[int, Row]] = {}
    for row in spark.read.parquet(f"{path}/data").select("treeID", "nodeData").collect():
        nodes.setdefault(row.treeID, {})[row.nodeData.id] = row.nodeData
    inner = 2**DEPTH - 1
    features, cuts, leaves = [], [], []
    for meta in weights:
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        leaf = np.zeros(2**DEPTH)
        own = nodes[meta.treeID]
        stack = [(0, 0)]
        while stack:
            node_id, at = stack.pop()
            node = own[node_id]
            if node.leftChild < 0:
                while at < inner:
                    at = 2 * at + 1
                leaf[at - inner] = 2 * meta.weights * node.prediction
            else:
                feature[at] = node.split.featureIndex
                cut[at] = node.split.leftCategoriesOrThreshold[0]
                stack += [(node.leftChild, 2 * at + 1), (node.rightChild, 2 * at + 2)]
        features.append(feature)
        cuts.append(cut)
        leaves.append(leaf)
    if not weights:
        return BoostedTrees(0.0, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, 2**DEPTH)))
    return BoostedTrees(0.0, np.array(features), np.array(cuts), np.array(leaves))


def least_precise_score(scored: DataFrame) -> float | None:
    """The least score at which the examples from it up show ``PRECISION``; None if none."""
    at = scored.groupBy("score").agg(F.count("*").alias("n"), F.sum("label").alias("right"))
    down = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    at = at.select(
        "score",
        (F.sum("right").over(down) / F.sum("n").over(down)).alias("precision"),
    )
    return at.where(F.col("precision") >= PRECISION).agg(F.min("score")).first()[0]


def scores(examples: DataFrame, model: BoostedTrees) -> DataFrame:
    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), float).reshape(batch.num_rows, -1)
            got = model.score(x) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(got, pa.float64()), batch.column("label")], ["score", "label"]
            )

    return examples.select("x", "label").mapInArrow(run, "score DOUBLE, label DOUBLE")


def fit(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> PiiModel:
    """Trees fitted on the examples of every document with an id, scored on the other half."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text"))
    texts = texts.where(F.col("id").isNotNull() & F.col("text").rlike("[0-9@]"))
    texts = texts.select(F.pmod(F.xxhash64("id"), F.lit(2)).cast("int").alias("half"), "text")
    every = keep(labelled(texts.unionByName(made_up_texts(spark))), "pii-examples")
    trees, thresholds = {}, {}
    for kind in KINDS:
        own = every.where(F.col("kind") == kind)
        learnt = own.where(F.col("half") == 0).select(array_to_vector("x").alias("features"), "label")
        gbt = GBTClassifier(
            maxIter=TREES, maxDepth=DEPTH, stepSize=RATE, maxBins=BINS,
            minInstancesPerNode=LEAST_LEAF, seed=42,
        )
        path = shared_path(spark, f"pii-trees-{kind}")
        gbt.fit(learnt).write().save(path)
        model = read_trees(spark, path)
        least = least_precise_score(scores(own.where(F.col("half") == 1), model))
        if least is not None:
            trees[kind] = model
            thresholds[kind] = max(float(least), 0.5)
        else:
            log.warning("%s: no score is precise enough; only its pattern is used", kind)
    return PiiModel(trees, thresholds, every.count())


def added_spans(text: str, base: list[Span], model: PiiModel) -> list[Span]:
    if not model.trees:
        return []
    taken = Taken(len(text), base)
    free = [
        span
        for span in candidates(text)
        if span[0] in model.trees and not taken.overlaps(span[1], span[2])
    ]
    rated = []
    for kind in model.trees:
        own = [span for span in free if span[0] == kind]
        if own:
            scores = model.trees[kind].score(np.array([features(text, s) for s in own], float))
            rated += [
                (-score, span)
                for score, span in zip(scores.tolist(), own, strict=True)
                if score >= model.thresholds[kind]
            ]
    chosen: list[Span] = []
    for _, (kind, low, high) in sorted(rated):
        if not taken.overlaps(low, high):
            taken.add(low, high)
            chosen.append((kind, low, high))
    return chosen


def joined(spans: list[Span]) -> str:
    ordered = sorted(spans, key=lambda span: (KINDS.index(span[0]), span[1], span[2]))
    return ",".join(f"{kind}:{low}:{high}" for kind, low, high in ordered)


FOUND = (
    "doc_id BIGINT, n_email BIGINT, n_ip BIGINT, n_card BIGINT, n_phone BIGINT, "
    "base_sha256 STRING, spans STRING"
)


def find(docs: DataFrame, model: PiiModel, id_column: str = "doc_id", text_column: str = "text"):
    """One row per given row: base counts, their digest, and all spans."""
    names = [field.split()[0] for field in FOUND.split(", ")]

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            rows = []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                base = base_spans(text)
                counts = [sum(span[0] == kind for span in base) for kind in KINDS]
                every = joined(base + added_spans(text, base, model))
                rows.append((doc_id, *counts, sha256(joined(base).encode()).hexdigest(), every))
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
            )

    chosen = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text")
    )
    return chosen.mapInArrow(run, FOUND)


def redact(
    docs: DataFrame,
    model: PiiModel,
    mask: str = "[{kind}]",
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id`` and ``text`` with every span replaced by ``mask``.

    One row per given row, from that row's own text: ids may repeat or be NULL. A NULL
    text is empty.
    """

    def masked(text: str) -> str:
        base = base_spans(text)
        spans = base + added_spans(text, base, model)
        out, at = [], 0
        for low, high, kind in sorted((low, high, kind) for kind, low, high in spans):
            if high > at:
                out += [text[at : max(low, at)], mask.format(kind=kind)]
                at = high
        return "".join([*out, text[at:]])

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            texts = pa.array([masked(x) for x in batch.column("text").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts], ["doc_id", "text"])

    chosen = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text")
    )
    return chosen.mapInArrow(run, "doc_id BIGINT, text STRING")


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return find(docs, fit(docs))
