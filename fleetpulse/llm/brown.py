"""Scores by a class-based n-gram model with exchange clustering.

Every training word gets a class by exchange clustering over word pairs, which moves a
word to the class that raises the likelihood of the class pairs most. The most frequent
words, the seeds, are clustered on the driver, one at a time; all others start in
classes of the power of two of their count and are then moved by sweeps over the corpus,
all words of a sweep against the class pairs before it. The number of classes and of
seeds grows with the cube root of the vocabulary. A token's probability is that of its
class after the class before, times that of the word in its class; both are estimated
over all training tokens. Words never seen are one class: words seen once stand for it
in part, as words seen twice do for them.

Words are known by 64-bit hashes. Counts are exact over the whole corpus: parts send
each of their words once, with its count, to the word's bucket, and get the totals of
just these words back (see ``matches``); a sweep does the same with a word's counts by
class before and after it. The driver sees the seeds, their pair counts, and the class
pair counts.

Defined cases: a NULL text is the empty text, one end token; a NULL id is neither held
out nor learned from; rows that repeat count and are scored each; without training rows
all words are unseen; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm.matches import (
    PACKET,
    U64,
    as_batch,
    by_part,
    distinct_texts,
    packets,
)
from fleetpulse.llm.shared import by_value, delete, keep, partitions, table

by_value(__name__)

FOLDS, HELD_OUT = 7, 2
# At least so many seeds and classes; both grow with the vocabulary.
HEADS = 512
CLASSES = 48
CLASSES_BY_ROOT = 2.0
HEADS_BY_CLASS = 4
SWEEPS = 8
WORD_SWEEPS = 2
# The class of the end token; classes of head words follow, then those of counts.
END_CLASS = 0
COUNT_CLASSES = 64
# Weight, in tokens, of the unconditioned class share in a class's transitions.
PRIOR = 5.0
END_WORD = 0
END_MARK = b"\xff"
# Text whose tokens a task handles at once.
READ_BYTES = 4 << 20
READ_ROWS = 1024

TOTALS = "part INT, bucket INT, data BINARY"
PAIRS = "code BIGINT, n BIGINT"
TOLD = "part INT, data BINARY"
ENCODED = (
    "part INT, digest BINARY, trained BIGINT, n_tokens BIGINT, n_known BIGINT, "
    "base_score DOUBLE, emission DOUBLE, words BINARY"
)
CLASSED = (
    "digest BINARY, trained BIGINT, n_tokens BIGINT, n_known BIGINT, base_score DOUBLE, "
    "emission DOUBLE, classes BINARY"
)


def class_number(words: int, least: int = CLASSES) -> int:
    return max(least, math.ceil(CLASSES_BY_ROOT * words ** (1 / 3)))


def head_number(words: int, heads: int = HEADS, classes: int = CLASSES) -> int:
    return max(heads, HEADS_BY_CLASS * class_number(words, classes))


def held_out(id_column: str = "doc_id") -> Column:
    code = F.crc32(F.col(id_column).cast("string").cast("binary"))
    return F.coalesce(code % FOLDS == HELD_OUT, F.lit(False))


class Tokens(NamedTuple):
    """The tokens of some texts in a row, each text's end token included."""

    words: np.ndarray  # the hash of each different token
    at: np.ndarray  # each token's place among them
    each: np.ndarray  # tokens by text


def read_tokens(texts: list[bytes]) -> Iterator[Tokens]:
    """The texts' tokens, for as many texts at a time as hold ``READ_BYTES`` or so."""
    waiting: list[bytes] = []
    size = 0
    for text in texts:
        waiting.append(text)
        size += len(text)
        if size >= READ_BYTES:
            yield tokens_of(waiting)
            waiting, size = [], 0
    if waiting:
        yield tokens_of(waiting)


def tokens_of(texts: list[bytes]) -> Tokens:
    from xxhash import xxh64_intdigest

    # A text ends with a byte that is in no UTF-8 text, which stands for the end token.
    letters = np.frombuffer((END_MARK.join(texts) + END_MARK).lower(), np.uint8)
    ends = letters == END_MARK[0]
    inside = ~(ends | (letters == 32) | ((letters >= 9) & (letters <= 13)))
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, stops = edges[::2], edges[1::2]
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(stops - starts, out=offsets[1:])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(letters[inside])]
    found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), buffers)
    encoded = found.dictionary_encode()
    words = encoded.dictionary.to_pylist()
    hashes = np.fromiter(map(xxh64_intdigest, words), U64, len(words)) | U64(1)
    after = np.searchsorted(starts, np.flatnonzero(ends))
    at = np.insert(encoded.indices.to_numpy().astype(np.int64), after, len(words))
    return Tokens(np.append(hashes, U64(END_WORD)), at, np.diff(after, prepend=0) + 1)


def send_counts(texts: DataFrame) -> DataFrame:
    """Each part's words with their training counts, packed by bucket."""
    buckets = partitions(texts.sparkSession)

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            column, trained = batch.column("text"), batch.column("trained").to_numpy()
            for part, rows in by_part(batch):
                found, amounts, low = [], [], 0
                for tokens in read_tokens([column[int(i)].as_py() for i in rows]):
                    high = low + len(tokens.each)
                    weights = np.repeat(trained[rows[low:high]], tokens.each)
                    found.append(tokens.words)
                    amounts.append(np.bincount(tokens.at, weights, len(tokens.words)))
                    low = high
                keys, place = np.unique(np.concatenate(found), return_inverse=True)
                counts = np.bincount(place, np.concatenate(amounts), len(keys)).astype(np.int64)
                yield as_batch(packets(part, keys, buckets, counts), PACKET)

    return texts.select("part", "trained", "text").mapInArrow(run, PACKET)


def total_counts(sent: DataFrame, heads: int, classes: int) -> DataFrame:
    """For each part the totals of its words; under part -1 each bucket's summary.

    A summary holds the most frequent words with their counts, as many as there may be
    heads, then tokens and words by power of two of the count.
    """
    buckets = partitions(sent.sparkSession)

    def run(group: pa.Table) -> pa.Table:
        parts = group.column("part").to_numpy()
        each = [np.frombuffer(x.as_py(), U64).reshape(2, -1) for x in group.column("data")]
        bucket = group.column("bucket")[0].as_py()
        keys, counts = np.concatenate(each, axis=1)
        words, place = np.unique(keys, return_inverse=True)
        totals = np.bincount(place, counts.astype(float), len(words)).astype(np.int64)
        rows, at = [], 0
        for part, own in zip(parts.tolist(), each, strict=True):
            size = own.shape[1]
            told = totals[place[at : at + size]].view(U64)
            rows.append((part, bucket, own[0].tobytes() + told.tobytes()))
            at += size
        seen = totals > 0
        powers = np.floor(np.log2(totals[seen])).astype(np.int64)
        # Hashes are spread evenly: twice the bucket's share is more than the whole has.
        most = head_number(2 * buckets * len(words), heads, classes)
        top = np.lexsort((words[seen], -totals[seen]))[:most]
        summary = (
            words[seen][top].tobytes(),
            totals[seen][top].tobytes(),
            np.bincount(powers, totals[seen].astype(float), COUNT_CLASSES).astype(np.int64).tobytes(),
            np.bincount(powers, minlength=COUNT_CLASSES).astype(np.int64).tobytes(),
        )
        rows.append((-1, bucket, b"".join(summary)))
        return pa.Table.from_batches([as_batch(rows, TOTALS)])

    return sent.groupBy("bucket").applyInArrow(run, TOTALS)


@dataclass(frozen=True)
class Vocabulary:
    """Head words (sorted hashes and counts) and, by power of two, tokens and words."""

    words: np.ndarray
    counts: np.ndarray
    tokens_by_power: np.ndarray
    words_by_power: np.ndarray

    @property
    def tokens(self) -> int:
        return int(self.tokens_by_power.sum())

    @property
    def size(self) -> int:
        return int(self.words_by_power.sum())


def read_vocabulary(totals: DataFrame, heads: int, classes: int) -> Vocabulary:
    def spread(batches: Iterator) -> Iterator:
        for batch in batches:
            rows = []
            for data in batch.column(0).to_pylist():
                values = np.frombuffer(data, np.int64)
                top, powers = values[: -2 * COUNT_CLASSES], values[-2 * COUNT_CLASSES :]
                half = len(top) // 2
                rows += zip([0] * half, top[:half].tolist(), top[half:].tolist(), strict=True)
                rows += [(1, i, n) for i, n in enumerate(powers.tolist()) if n]
            yield as_batch(rows, "kind INT, code BIGINT, n BIGINT")

    summaries = totals.where("part = -1").select("data")
    rows = keep(summaries.mapInArrow(spread, "kind INT, code BIGINT, n BIGINT"), "summaries")
    powers = np.zeros(2 * COUNT_CLASSES, np.int64)
    for row in rows.where("kind = 1").groupBy("code").agg(F.sum("n").alias("n")).collect():
        powers[row.code] = row.n
    heads = head_number(int(powers[COUNT_CLASSES:].sum()), heads, classes)
    top = rows.where("kind = 0").orderBy(F.desc("n"), "code").limit(heads).collect()
    words = np.array([row.code for row in top], np.int64).view(U64)
    order = np.argsort(words)
    counts = np.array([row.n for row in top], np.int64)[order]
    return Vocabulary(words[order], counts, powers[:COUNT_CLASSES], powers[COUNT_CLASSES:])


def places_in(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The place of each hash in the sorted ``words``, or their number if it is absent."""
    if not len(words):
        return np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
    return np.where(words[at] == hashes, at, len(words))


def pair_rows(totals: np.ndarray) -> Iterator[pa.RecordBatch]:
    codes = np.flatnonzero(totals)
    yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(totals[codes])], ["code", "n"])


def count_pairs(frame: DataFrame, size: int, codes) -> np.ndarray:
    """The matrix of adjacent pairs in the training rows, each text after an end.

    ``codes`` gives the codes of some rows' tokens in a row, how many each row has, and
    the code of the end before the first.
    """

    def run(batches: Iterator) -> Iterator:
        totals = np.zeros(size * size, np.int64)
        for batch in batches:
            trained = batch.column("trained").to_numpy()
            used, low = np.flatnonzero(trained), 0
            for own, each, first in codes([batch.column(1)[int(i)].as_py() for i in used]):
                weights = np.repeat(trained[used[low : low + len(each)]], each)
                low += len(each)
                # Every row ends with the end, so that is what the next one follows.
                before = np.append(first, own[:-1])
                pairs = np.bincount(before * size + own, weights, size * size)
                totals += pairs.astype(np.int64)
        yield from pair_rows(totals)

    summed = frame.mapInArrow(run, PAIRS).groupBy("code").agg(F.sum("n").alias("n"))
    matrix = np.zeros(size * size, np.int64)
    rows = summed.toPandas()
    matrix[rows.code.to_numpy(np.int64)] = rows.n.to_numpy(np.int64)
    return matrix.reshape(size, size)


def exchange(pairs: np.ndarray, classes: int, sweeps: int = SWEEPS) -> np.ndarray:
    """The class of each head word, 0 to ``classes - 1``.

    ``pairs`` counts adjacent words; its last two rows and columns, for all other words
    and the end, are classes of their own that nothing joins.
    """
    heads = len(pairs) - 2

    def f(x: np.ndarray) -> np.ndarray:
        return x * np.log(np.maximum(x, 1))

    size = classes + 2
    order = np.argsort(-pairs[:heads].sum(axis=1), kind="stable")
    own = np.empty(heads + 2, np.int64)
    own[order] = np.arange(heads) % classes
    own[heads:] = classes, classes + 1
    member = np.zeros((heads + 2, size))
    member[np.arange(heads + 2), own] = 1
    left_of = np.einsum("ij,ik->jk", pairs.astype(float), member)  # word by class before it
    right_of = np.einsum("ij,jk->ik", pairs.astype(float), member)
    between = np.einsum("ij,ik->jk", member, right_of)
    mass = between.sum(axis=1)
    for _ in range(sweeps):
        moved = 0
        for word in order:
            self_pairs = float(pairs[word, word])
            a = own[word]
            left, right = left_of[word].copy(), right_of[word].copy()
            left[a] -= self_pairs
            right[a] -= self_pairs
            amount = right.sum() + self_pairs
            between[a] -= right
            between[:, a] -= left
            between[a, a] -= self_pairs
            mass[a] -= amount
            rows = f(between + right) - f(between)
            columns = f(between + left[:, None]) - f(between)
            inside = np.diagonal(between)
            gain = (
                rows.sum(axis=1)
                - np.diagonal(rows)
                + columns.sum(axis=0)
                - np.diagonal(columns)
                + f(inside + left + right + self_pairs)
                - f(inside)
                - 2 * (f(mass + amount) - f(mass))
            )[:classes]
            b = int(gain.argmax()) if gain.max() > gain[a] + 1e-9 else a
            between[b] += right
            between[:, b] += left
            between[b, b] += self_pairs
            mass[b] += amount
            if b != a:
                moved += 1
                own[word] = b
                left_of[:, a] -= pairs[word]
                left_of[:, b] += pairs[word]
                right_of[:, a] -= pairs[:, word]
                right_of[:, b] += pairs[:, word]
        if not moved:
            break
    return own[:heads]


@dataclass(frozen=True)
class WordClasses:
    """What gives every word its class and its log10 probability in it."""

    vocabulary: Vocabulary
    head_class: np.ndarray
    class_tokens: np.ndarray
    unseen: float
    once: float

    @property
    def size(self) -> int:
        return len(self.class_tokens)

    def describe(self, hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first_count_class = self.size - COUNT_CLASSES
        power = np.floor(np.log2(np.maximum(counts, 1))).astype(np.int64)
        head = places_in(self.vocabulary.words, hashes)
        known = np.append(self.head_class, -1)[head]
        classes = np.where(known >= 0, known, first_count_class + power)
        total = np.maximum(self.class_tokens[classes], 1)
        emission = np.log10(np.maximum(counts, 1) / total)
        rare = (known < 0) & (counts < 2)
        emission = np.where(rare, np.where(counts > 0, self.once, self.unseen), emission)
        return classes, emission


def word_classes(vocabulary: Vocabulary, pairs: np.ndarray, classes: int) -> WordClasses:
    heads = len(vocabulary.words)
    is_end = vocabulary.words == U64(END_WORD)
    # The end is a class of its own: last row and column, like the other words before it.
    order = np.append(np.flatnonzero(~is_end), [heads, *np.flatnonzero(is_end)]).astype(np.int64)
    chosen = pairs[np.ix_(order, order)]
    if not is_end.any():
        chosen = np.pad(chosen, ((0, 1), (0, 1)))
    classes = max(min(classes, heads - int(is_end.sum())), 1)
    head_class = np.zeros(heads, np.int64)
    head_class[~is_end] = exchange(chosen, classes) + 1
    head_class[is_end] = END_CLASS
    power = np.floor(np.log2(np.maximum(vocabulary.counts, 1))).astype(np.int64)
    by_power = vocabulary.tokens_by_power - np.bincount(
        power, vocabulary.counts.astype(float), COUNT_CLASSES
    ).astype(np.int64)
    by_head = np.bincount(head_class, vocabulary.counts.astype(float), classes + 1)
    tokens = np.concatenate([by_head.astype(np.int64), by_power])
    # Words seen once stand for what comes unseen as words seen twice do for them.
    words_by_power = vocabulary.words_by_power - np.bincount(power, minlength=COUNT_CLASSES)
    once, more = int(words_by_power[0]), 2 * int(words_by_power[1])
    unseen = np.log10((once + 0.5) / (once + more + 1))
    each = np.log10((more + 0.5) / (once + more + 1) / max(once, 1))
    return WordClasses(vocabulary, head_class, tokens, float(unseen), float(each))


def unseen_share(vocabulary: Vocabulary) -> float:
    """How much of a word seen once stands for words never seen."""
    once, more = int(vocabulary.words_by_power[0]), 2 * int(vocabulary.words_by_power[1])
    return (once + 0.5) / (once + more + 1)


def encode(texts: DataFrame, totals: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Each text as places among its part's words, with what needs no classes added up.

    The last bit of a place tells whether the word was seen once.
    """
    floor = np.log10(vocabulary.tokens + vocabulary.size + 1)
    own_share = 1 - unseen_share(vocabulary)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        told = [np.frombuffer(x.as_py(), U64).reshape(2, -1) for x in right.column("data")]
        known = np.concatenate([np.zeros((2, 0), U64), *told], axis=1)
        keys, first = np.unique(known[0], return_index=True)
        counts = known[1][first].astype(np.int64)
        base = np.log10(counts + 1) - floor
        emission = np.log10(np.where(counts == 1, own_share, np.maximum(counts, 1)))
        rows, number = [], 0
        ids = [left.column(name).to_pylist() for name in ("part", "digest", "trained")]
        texts = left.column("text")
        for tokens in read_tokens([texts[i].as_py() for i in range(left.num_rows)]):
            places = np.searchsorted(keys, tokens.words)[tokens.at]
            first = np.cumsum(tokens.each) - tokens.each
            n_known, of_base, of_emission = (
                np.add.reduceat(values[places], first).tolist()
                for values in ((counts > 0).astype(np.int64), base, emission)
            )
            coded = (2 * places + (counts == 1)[places]).astype(np.uint32)
            for n, low in enumerate(first.tolist()):
                size = int(tokens.each[n])
                told = (size, n_known[n], of_base[n], of_emission[n], coded[low : low + size].tobytes())
                rows.append((*(column[number] for column in ids), *told))
                number += 1
        return pa.Table.from_batches([as_batch(rows, ENCODED)])

    own = totals.where("part >= 0").select("part", "data")
    chosen = texts.select("part", "digest", "trained", "text")
    return chosen.groupBy("part").cogroup(own.groupBy("part")).applyInArrow(run, ENCODED)


def told_classes(keys: np.ndarray, classes: np.ndarray) -> bytes:
    return keys.tobytes() + classes.astype(np.uint16).tobytes()


def read_told(answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """A part's words, sorted, and their classes."""
    keys, classes = [np.zeros(0, U64)], [np.zeros(0, np.uint16)]
    for answer in answers.column("data"):
        data = answer.as_py()
        keys.append(np.frombuffer(data, U64, len(data) // 10))
        classes.append(np.frombuffer(data, np.uint16, offset=len(data) // 10 * 8))
    words, first = np.unique(np.concatenate(keys), return_index=True)
    return words, np.concatenate(classes)[first].astype(np.int64)


def first_classes(totals: DataFrame, words: WordClasses) -> DataFrame:
    """For each part and bucket its words and their classes before the sweeps."""

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            rows = []
            for part, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keys, counts = np.frombuffer(data, U64).reshape(2, -1)
                classes, _ = words.describe(keys, counts.astype(np.int64))
                rows.append((part, told_classes(keys, classes)))
            yield as_batch(rows, TOLD)

    return totals.where("part >= 0").select("part", "data").mapInArrow(run, TOLD)


def summed(values: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values in order and the weights of each; most weights are 1."""
    single = weights == 1
    found = np.sort(values[single])
    first = np.flatnonzero(np.diff(found, prepend=-1))
    ones = np.diff(np.append(first, len(found)))
    found = np.concatenate([found[first], values[~single]])
    different, at = np.unique(found, return_inverse=True)
    amounts = np.bincount(at, np.concatenate([ones, weights[~single]]), len(different))
    return different, amounts.astype(np.uint64)


def send_neighbours(
    encoded: DataFrame, told: DataFrame, vocabulary: Vocabulary, size: int
) -> DataFrame:
    """Each part's words with their class and counts by class before and after.

    Codes up to ``size`` are classes before, up to twice that classes after, and the
    next is the word itself. Seeds stay and send none. Bucket -1 gets the class pairs.
    """
    buckets = partitions(encoded.sparkSession)
    codes = 2 * size + 1

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        keys, classes = read_told(right)
        texts = [np.frombuffer(x.as_py(), np.uint32) >> 1 for x in left.column("words")]
        trained = left.column("trained").to_numpy()
        used = np.flatnonzero(trained)
        after = np.concatenate([np.zeros(0, np.int64), *(texts[i] for i in used)]).astype(np.int64)
        each = np.array([len(texts[i]) for i in used], np.int64)
        weight = np.repeat(trained[used], each).astype(float)
        before = np.empty_like(after)
        before[1:] = after[:-1]
        # The end is the least hash, so each part has it first; each text follows it.
        before[np.cumsum(each) - each] = 0
        pairs = np.bincount(classes[before] * size + classes[after], weight, size * size)
        found = np.flatnonzero(pairs)
        own = left.column("part")[0].as_py() if len(left) else -1
        data = found.astype(np.int64).tobytes() + pairs[found].astype(np.int64).tobytes()
        rows = [(-1, own, data)]
        free = places_in(vocabulary.words, keys) == len(vocabulary.words)
        same = before == after
        places = [
            (after * codes + classes[before])[free[after] & ~same],
            (before * codes + size + classes[after])[free[before] & ~same],
            (after * codes + 2 * size)[free[after] & same],
        ]
        weights = [
            weight[free[after] & ~same],
            weight[free[before] & ~same],
            weight[free[after] & same],
        ]
        entries, amounts = summed(np.concatenate(places), np.concatenate(weights))
        counts = np.bincount(entries // codes, minlength=len(keys))
        edges = np.array([(i << 64) // buckets for i in range(1, buckets)], U64)
        cuts = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
        ends = np.concatenate([[0], np.cumsum(counts)])
        for bucket, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if high > low:
                chosen = slice(ends[low], ends[high])
                pieces = (
                    np.array([high - low], U64),
                    keys[low:high],
                    counts[low:high].astype(np.uint32),
                    classes[low:high].astype(np.uint16),
                    (entries[chosen] % codes).astype(np.uint16),
                    amounts[chosen].astype(np.uint64),
                )
                rows.append((bucket, own, b"".join(x.tobytes() for x in pieces)))
        return pa.Table.from_batches([as_batch(rows, PACKET)])

    chosen = encoded.select("part", "trained", "words")
    return chosen.groupBy("part").cogroup(told.groupBy("part")).applyInArrow(run, PACKET)


def class_pairs(sent: DataFrame, size: int) -> np.ndarray:
    def spread(batches: Iterator) -> Iterator:
        totals = np.zeros(size * size, np.int64)
        for batch in batches:
            for data in batch.column(0).to_pylist():
                codes, counts = np.frombuffer(data, np.int64).reshape(2, -1)
                totals[codes] += counts
        yield from pair_rows(totals)

    summed = sent.where("bucket = -1").select("data").mapInArrow(spread, PAIRS)
    rows = summed.groupBy("code").agg(F.sum("n").alias("n")).toPandas()
    matrix = np.zeros(size * size, np.int64)
    matrix[rows.code.to_numpy(np.int64)] = rows.n.to_numpy(np.int64)
    return matrix.reshape(size, size)


class Mover:
    """Finds words' best classes among ``1`` to ``classes``, the class pairs held fixed.

    A word is taken out of its own class before classes are compared, as in ``exchange``.
    """

    TABLES = 8
    WORDS = 2048
    ENTRIES = 8192
    STEPS = 48

    def __init__(self, pairs: np.ndarray, classes: int):
        self.pairs, self.classes, self.size = pairs.astype(float), classes, len(pairs)
        inner = slice(1, classes + 1)
        # By code: how often each class comes after (or before) the neighbour's class.
        self.met = np.concatenate([self.pairs[:, inner], self.pairs[inner].T])
        self.base = self.f(self.met)
        self.tables = np.concatenate(
            [self.f(self.met + n) - self.base for n in range(1, self.TABLES + 1)]
        )
        self.mass = self.pairs.sum(axis=1)

    @staticmethod
    def f(x: np.ndarray) -> np.ndarray:
        return x * np.log(np.maximum(x, 1))

    def rises(self, codes: np.ndarray, amounts: np.ndarray) -> np.ndarray:
        n = np.minimum(amounts, self.TABLES).astype(np.int64) - 1
        out = self.tables.take(n * (2 * self.size) + codes, axis=0, mode="clip")
        more = np.flatnonzero(amounts > self.TABLES)
        if len(more):
            out[more] = self.f(self.met[codes[more]] + amounts[more][:, None]) - self.base[codes[more]]
        return out

    def add_rises(self, gain, word, codes, amounts) -> None:
        """Add up the rises of each word's entries, the n-th entry of all words at once.

        Words come by how many entries they have, so those with an n-th one are in front.
        """
        first = np.flatnonzero(np.diff(word, prepend=-1))
        each = np.diff(np.append(first, len(word)))
        order = np.argsort(-each, kind="stable")
        first, each = first[order], each[order]
        many = int(np.count_nonzero(each > self.STEPS))
        for low, count in zip(first[:many], each[:many], strict=True):
            for at in range(low, low + count, self.ENTRIES):
                part = slice(at, min(at + self.ENTRIES, low + count))
                gain[word[low]] += self.rises(codes[part], amounts[part]).sum(axis=0)
        first, each = first[many:], each[many:]
        total = np.zeros((len(first), self.classes))
        for n in range(int(each[0]) if len(each) else 0):
            front = int(np.searchsorted(-each, -n, side="left"))
            total[:front] += self.rises(codes[first[:front] + n], amounts[first[:front] + n])
        gain[word[first]] += total

    def gains(self, own, word, codes, amounts) -> np.ndarray:
        """Each word's gain by class; entries are sorted by ``word``, places in ``own``."""
        f, pairs, size, classes = self.f, self.pairs, self.size, self.classes
        every = np.arange(len(own))
        beside = np.zeros((len(own), 2 * size + 1))
        beside[word, codes] = amounts
        left, right, alone = beside[:, :size], beside[:, size : 2 * size], beside[:, 2 * size]
        amount = left.sum(axis=1) + alone
        gain = np.zeros((len(own), classes))
        plain = np.flatnonzero(codes < 2 * size)
        self.add_rises(gain, word[plain], codes[plain], amounts[plain])
        inside = self.mass[1 : classes + 1]
        sizes, at = np.unique(amount, return_inverse=True)
        gain -= 2 * (f(inside + sizes[:, None]) - f(inside))[at]
        # Pairs inside a class are met from both sides.
        low, high = left[:, 1 : classes + 1], right[:, 1 : classes + 1]
        w, c = np.nonzero(((low > 0) & (high > 0)) | (alone > 0)[:, None])
        d, x, y = pairs[c + 1, c + 1], low[w, c], high[w, c]
        gain[w, c] += f(d + x + y + alone[w]) - f(d + x) - f(d + y) + f(d)
        # Pairs with the word's own class are fewer once the word is out of it.
        to_own, from_own = right[every, own], left[every, own]
        w, c = np.nonzero((low > 0) & (to_own > 0)[:, None])
        d, x, y = pairs[c + 1, own[w]], low[w, c], to_own[w]
        gain[w, c] += f(d - x + y) - f(d - x) - f(d + y) + f(d)
        w, c = np.nonzero((high > 0) & (from_own > 0)[:, None])
        d, x, y = pairs[own[w], c + 1], high[w, c], from_own[w]
        gain[w, c] += f(d - x + y) - f(d - x) - f(d + y) + f(d)
        inner = np.flatnonzero((own > 0) & (own <= classes))
        gain[inner, own[inner] - 1] = self.staying(own, word, codes, amounts, beside)[inner]
        return gain

    def staying(self, own, word, codes, amounts, beside) -> np.ndarray:
        """What is lost by taking each word out of its class."""
        f, pairs, size = self.f, self.pairs, self.size
        a, code = own[word], codes % size
        outside = (codes < 2 * size) & (code != a)
        d = np.where(codes < size, pairs[code, a], pairs[a, code])
        lost = np.bincount(word, np.where(outside, f(d) - f(d - amounts), 0), len(own))
        every = np.arange(len(own))
        inside = beside[every, own] + beside[every, size + own] + beside[:, 2 * size]
        d, amount = pairs[own, own], beside[:, :size].sum(axis=1) + beside[:, 2 * size]
        mass = self.mass[own]
        return lost + f(d) - f(d - inside) - 2 * (f(mass) - f(mass - amount))

    def move(self, own, word, codes, amounts) -> np.ndarray:
        """The best class of each word that has entries; the others stay."""
        new = own.copy()
        cuts = np.searchsorted(word, np.arange(0, len(own) + self.WORDS, self.WORDS))
        for i, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if high == low:
                continue
            chosen = np.unique(word[low:high])
            place = np.searchsorted(chosen, word[low:high])
            now, n = own[chosen], amounts[low:high].astype(float)
            gain = self.gains(now, place, codes[low:high], n)
            best = gain.argmax(axis=1)
            inner = (now > 0) & (now <= self.classes)
            place = np.where(inner, now - 1, 0)
            stay = np.where(inner, gain[np.arange(len(now)), place], -np.inf)
            new[chosen] = np.where(gain.max(axis=1) > stay + 1e-9, best + 1, now)
        return new


def move_words(sent: DataFrame, pairs: np.ndarray, classes: int) -> DataFrame:
    """For each part and bucket its words and their classes after one sweep."""
    codes = 2 * len(pairs) + 1

    def run(group: pa.Table) -> pa.Table:
        parts = group.column("part").to_pylist()
        keys, sizes, own, entries, amounts = [], [], [], [], []
        for packet in group.column("data"):
            data = packet.as_py()
            count = int(np.frombuffer(data, U64, 1)[0])
            keys.append(np.frombuffer(data, U64, count, 8))
            sizes.append(np.frombuffer(data, np.uint32, count, 8 + 8 * count))
            own.append(np.frombuffer(data, np.uint16, count, 8 + 12 * count))
            at, total = 8 + 14 * count, int(sizes[-1].sum())
            entries.append(np.frombuffer(data, np.uint16, total, at))
            amounts.append(np.frombuffer(data, np.uint64, total, at + 2 * total))
        words, first, place = np.unique(
            np.concatenate(keys), return_index=True, return_inverse=True
        )
        word = np.repeat(place, np.concatenate(sizes)).astype(np.int64)
        found, at = np.unique(word * codes + np.concatenate(entries), return_inverse=True)
        counts = np.bincount(at, np.concatenate(amounts).astype(float), len(found))
        now = np.concatenate(own)[first].astype(np.int64)
        new = Mover(pairs, classes).move(now, found // codes, found % codes, counts)
        rows, low = [], 0
        for part, each in zip(parts, keys, strict=True):
            rows.append((part, told_classes(each, new[place[low : low + len(each)]])))
            low += len(each)
        return pa.Table.from_batches([as_batch(rows, TOLD)])

    return sent.where("bucket >= 0").groupBy("bucket").applyInArrow(run, TOLD)


def classed(encoded: DataFrame, told: DataFrame, size: int) -> DataFrame:
    """Each text as classes; a word seen once has its class plus ``size``."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        _, classes = read_told(right)
        packed = []
        for words in left.column("words"):
            places = np.frombuffer(words.as_py(), np.uint32)
            packed.append((classes[places >> 1] + size * (places & 1)).astype(np.uint16).tobytes())
        kept = left.drop_columns(["part", "words"])
        return kept.append_column("classes", pa.array(packed, pa.binary()))

    return encoded.groupBy("part").cogroup(told.groupBy("part")).applyInArrow(run, CLASSED)


def shared_with_unseen(counts: np.ndarray, unseen: int, share: float) -> np.ndarray:
    """Class pairs in which words seen once count by ``share`` as the unseen class."""
    size = len(counts) // 2
    plain = np.eye(size)
    once = (1 - share) * plain
    once[:, unseen] += share
    fold = np.concatenate([plain, once])
    return fold.T @ counts @ fold


def release(kept: DataFrame) -> None:
    """Delete the files of a kept result that is of no more use."""
    for path in {file.rsplit("/", 1)[0] for file in kept.inputFiles()}:
        delete(kept.sparkSession, path)


def transitions(counts: np.ndarray) -> np.ndarray:
    """log10 of each class's probability after each class."""
    share = (counts.sum(axis=0) + 1) / (counts.sum() + len(counts))
    after = (counts + PRIOR * share) / (counts.sum(axis=1, keepdims=True) + PRIOR)
    return np.log10(after)


def perplexity(scores: DataFrame) -> DataFrame:
    """The model's perplexity per token, over the given rows of ``score_texts``."""
    mean = -F.sum("score") / F.sum("n_tokens")
    return scores.groupBy("held_out").agg(F.pow(F.lit(10.0), mean).alias("perplexity"))


def score_texts(
    docs: DataFrame, heads: int = HEADS, classes: int = CLASSES, **columns: str
) -> DataFrame:
    """One row per given row, with the contract's columns of ``op9_brown_scores``."""
    learned = ~held_out("doc_id") & F.col("doc_id").isNotNull()
    rows, texts = distinct_texts(docs, F.count_if(learned).alias("trained"), **columns)
    totals = keep(total_counts(send_counts(texts), heads, classes), "totals")
    vocabulary = read_vocabulary(totals, heads, classes)

    def heads_of(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        for tokens in read_tokens(texts):
            places = places_in(vocabulary.words, tokens.words)
            yield places[tokens.at], tokens.each, int(places[-1])

    trained = texts.where("trained > 0").select("trained", "text")
    pairs = count_pairs(trained, len(vocabulary.words) + 1, heads_of)
    words = word_classes(vocabulary, pairs, class_number(vocabulary.size, classes))
    size, unseen = words.size, words.size - COUNT_CLASSES
    encoded = keep(encode(texts, totals, vocabulary), "encoded")
    told = keep(first_classes(totals, words), "classes")
    release(totals)
    release(texts)
    for _ in range(WORD_SWEEPS):
        sent = keep(send_neighbours(encoded, told, vocabulary, size), "neighbours")
        release(told)
        told = keep(move_words(sent, class_pairs(sent, size), unseen - 1), "classes")
        release(sent)
    final = keep(classed(encoded, told, size), "classed")

    def classes_of(rows: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        for low in range(0, len(rows), READ_ROWS):
            part = [np.frombuffer(packed, np.uint16).astype(np.int64) for packed in rows[low : low + READ_ROWS]]
            own = np.concatenate(part)
            # The end is one class, also where it was seen once.
            yield own, np.array([len(x) for x in part]), END_CLASS

    counts = count_pairs(
        final.where("trained > 0").select("trained", "classes"), 2 * size, classes_of
    )
    counts = shared_with_unseen(counts, unseen, unseen_share(vocabulary))
    mass = counts.sum(axis=0)
    mass[unseen] = 1
    after = transitions(counts) - np.log10(np.where(mass > 0, mass, 1))

    def add_up(batches: Iterator) -> Iterator:
        for batch in batches:
            sums = []
            for packed, emission in zip(*(c.to_pylist() for c in batch.columns[-2:]), strict=True):
                own = np.frombuffer(packed, np.uint16).astype(np.int64) % size
                sums.append(emission + float(after[np.append(END_CLASS, own[:-1]), own].sum()))
            columns = [*batch.columns[:-2], pa.array(sums, pa.float64())]
            yield pa.RecordBatch.from_arrays(
                columns, ["digest", "n_tokens", "n_known", "base_score", "score"]
            )

    scored = final.select("digest", "n_tokens", "n_known", "base_score", "classes", "emission")
    results = scored.mapInArrow(
        add_up,
        "digest BINARY, n_tokens BIGINT, n_known BIGINT, base_score DOUBLE, score DOUBLE",
    )
    return rows.join(keep(results, "scores"), "digest").select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def op9_brown_scores(spark: SparkSession, folder: str) -> DataFrame:
    return score_texts(table(spark, folder, "documents"))
