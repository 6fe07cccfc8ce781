"""Suffix-array dedup: maximal repeat groups from common-prefix interval trees.

A repeat is a string of at least ``LENGTH`` bytes that starts at two places. Suffixes
that share so long a prefix share its minimizer, the least hashed ``GRAM`` in it, so
suffixes are dealt out by minimizer: each *context* is the run of places that have one
minimizer in common, with the bytes their prefixes reach and the byte before. Only
contexts whose minimizer occurs elsewhere move, each distinct one once per part, with
its number.

A passage that very many parts hold has a context of its own wherever it stands in other
surroundings. Where a minimizer is so *crowded*, each start is sent as a context without
surroundings, of which a part has few different ones, and dealt out by its bytes: no
bucket gathers what grows with the number of occurrences.

A bucket builds an enhanced suffix array over its contexts: the starts in the order of
their suffixes, the common prefix of each with the one before, and the byte to its left.
A stack scan over the common prefixes finds the intervals of the tree; an interval whose
occurrences do not all follow one byte (or stand at the edge of their context) is a
maximal repeat group, and every start in it an occurrence. Groups tell lengths up to the
context's end; longer repeats come as groups that overlap in the text. Covering all
occurrences with their lengths yields the bytes to remove.

Defined cases: a NULL text is empty; a text occurring several times repeats itself, so
all of it goes if it has ``LENGTH`` bytes; shorter texts never change; rows that repeat
count as occurrences; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm.matches import (
    ANSWER,
    CROWD,
    U64,
    among,
    as_batch,
    covered,
    crowded_answers,
    distinct_texts,
    joined_answers,
    live_anchors,
    mixed,
    window_hashes,
)
from fleetpulse.llm.shared import by_value, keep, partitions, table

by_value(__name__)

LENGTH = 200
# Longer than most lines that pages share, so that those alone start no comparison.
GRAM = 96
BASE = 0x9E3779B97F4A7C15
# Bits of a minimizer's value that give its place; texts are scanned in strips below that.
PLACE_BITS = 24
STRIP = 1 << 22
# A bucket's contexts are compared in portions of whole minimizers of about this size.
PORTION = 1 << 20
# Bytes of contexts whose prefixes are hashed at a time.
SLICE = 1 << 20
# Starts that are put in order at a time, by whole classes of one prefix.
STARTS = 1 << 18
# Prefixes that are compared byte by byte at a time.
COMPARED = 1 << 13

CONTEXT = (
    "bucket INT, part INT, number INT, gram BIGINT, lead INT, starts INT, left INT, "
    "weight INT, bytes BINARY"
)
MARKED = (
    "part INT, digest BINARY, copies BIGINT, n_bytes BIGINT, kept_sha256 STRING, text BINARY"
)
LISTED = "group_id STRING, length INT, part INT, number INT, start INT"
HELD = "part INT, number INT, digest BINARY, low BIGINT"
RESULT = (
    "digest BINARY, n_bytes BIGINT, n_removed BIGINT, n_spans BIGINT, kept_sha256 STRING"
)


def gram_hashes(text: bytes) -> np.ndarray:
    values = mixed(np.arange(1, 257, dtype=U64))[np.frombuffer(text, np.uint8)]
    return window_hashes(values, GRAM, BASE)


def least_in_runs(values: np.ndarray, length: int) -> np.ndarray:
    """The least of each run of ``length`` values."""
    size, block = 1, values
    while 2 * size <= length:
        block = np.minimum(block[:-size], block[size:])
        size *= 2
    rest = length - size
    return np.minimum(block[: len(block) - rest], block[rest:]) if rest else block


def minimizers(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of window starts with one minimizer: first start, its place, its hash."""
    count = len(text) - length + 1
    runs = []
    for low in range(0, max(count, 0), STRIP):
        high = min(low + STRIP, count)
        hashes = gram_hashes(text[low : high + length - 1])
        places = np.arange(len(hashes), dtype=U64)
        ranked = (hashes >> U64(PLACE_BITS) << U64(PLACE_BITS)) | places
        best = least_in_runs(ranked, length - GRAM + 1)
        first = np.flatnonzero(np.concatenate([[True], best[1:] != best[:-1]]))
        place = (best[first] & U64((1 << PLACE_BITS) - 1)).astype(np.int64)
        runs.append((first + low, place + low, hashes[place]))
    if not runs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64)
    first, place, hashes = (np.concatenate(x) for x in zip(*runs, strict=True))
    # The least of many hashes are all small: spread anew, so that buckets are even.
    return first, place, mixed(hashes)


Live = tuple[np.ndarray, np.ndarray]  # live minimizers, and the crowded ones among them


def told(answers: pa.Table) -> Live:
    return joined_answers(answers), crowded_answers(answers)


def contexts_of(text: bytes, length: int, live: Live) -> list[tuple]:
    """Contexts with a live minimizer: first start, starts, gram, lead, left, bytes.

    ``lead`` is the minimizer's distance from the first start; ``left`` the byte before
    it, or -1 at the text's start. Where a minimizer is crowded every start is a context
    of its own, without a byte to spare.
    """
    known, crowded = live
    first, place, hashes = minimizers(text, length)
    ends = np.append(first[1:], len(text) - length + 1)
    found = []
    single = among(hashes | U64(1), crowded)
    for i in np.flatnonzero(among(hashes | U64(1), known)):
        first_start, end = int(first[i]), int(ends[i])
        step = 1 if single[i] else end - first_start
        for low in range(first_start, end, step):
            left = text[low - 1] if low else -1
            context = text[low : low + step - 1 + length]
            found.append((low, step, int(hashes[i]), int(place[i]) - low, left, context))
    return found


def numbered(texts: pa.Table, live: Live, length: int):
    """A part's texts in one order, its distinct contexts as numbered, and who has them."""
    text_rows = sorted(texts.to_pylist(), key=lambda row: row["digest"])
    contexts: dict[tuple, list[int]] = {}
    holders: list[list[tuple[int, int]]] = []
    for row in text_rows:
        own = []
        for low, starts, gram, lead, left, data in contexts_of(row["text"], length, live):
            entry = contexts.setdefault((gram, lead, starts, left, data), [len(contexts), 0])
            # A text with copies is in the table as often: two stand for any number.
            entry[1] += min(row["copies"], 2)
            own.append((low, entry[0]))
        holders.append(own)
    return text_rows, contexts, holders


def mark(texts: DataFrame, live: DataFrame, length: int) -> DataFrame:
    """Every text's size and digest; the text itself only where it has a live minimizer."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        from hashlib import sha256

        known, rows = joined_answers(right), []
        for row in left.to_pylist():
            text = row["text"]
            hit = row["copies"] > 1 or among(minimizers(text, length)[2] | U64(1), known).any()
            rows.append(
                (
                    row["part"],
                    row["digest"],
                    row["copies"],
                    len(text),
                    sha256(text).hexdigest(),
                    text if hit else None,
                )
            )
        return pa.Table.from_batches([as_batch(rows, MARKED)])

    chosen = texts.select("part", "copies", "digest", "text")
    return chosen.groupBy("part").cogroup(live.groupBy("part")).applyInArrow(run, MARKED)


def prepared(docs: DataFrame, length: int, crowd: int = CROWD, **columns: str):
    """All rows, the marked texts (kept) and the live minimizers (kept)."""
    rows, texts = distinct_texts(docs, **columns)

    def anchors(text: bytes, copies: int) -> np.ndarray:
        hashes = minimizers(text, length)[2]
        return np.concatenate([hashes, hashes]) if copies > 1 else hashes

    live = keep(live_anchors(texts, anchors, crowd), "live")
    return rows, keep(mark(texts, live, length), "marked"), live


def send_contexts(marked: DataFrame, live: DataFrame, length: int) -> DataFrame:
    buckets = partitions(marked.sparkSession)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.Table.from_batches([as_batch([], CONTEXT)])
        from xxhash import xxh64_intdigest

        live_here = told(right)
        crowded = set(live_here[1].tolist())
        _, contexts, _ = numbered(left, live_here, length)
        part = left.column("part")[0].as_py()
        out = [
            (
                ((xxh64_intdigest(data) if gram | 1 in crowded else gram) * buckets) >> 64,
                part,
                number,
                gram - (1 << 64) if gram >> 63 else gram,
                lead,
                starts,
                left_byte,
                min(weight, 2),
                data,
            )
            for (gram, lead, starts, left_byte, data), (number, weight) in contexts.items()
        ]
        return pa.Table.from_batches([as_batch(out, CONTEXT)])

    chosen = repeated(marked)
    return chosen.groupBy("part").cogroup(live.groupBy("part")).applyInArrow(run, CONTEXT)


def repeated(marked: DataFrame) -> DataFrame:
    return marked.where("text IS NOT NULL").select("part", "copies", "digest", "text")


def portions(group: pa.Table) -> Iterator[pa.Table]:
    """A bucket's contexts by whole minimizers, about ``PORTION`` bytes at a time."""
    gram = group.column("gram").to_numpy()
    order = np.argsort(gram, kind="stable")
    size = np.array([len(x.as_py()) for x in group.column("bytes")], np.int64)[order]
    portion = (np.cumsum(size) - size) // PORTION
    first = np.concatenate([[True], gram[order][1:] != gram[order][:-1]])
    portion = portion[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
    for number in np.unique(portion):
        yield group.take(pa.array(order[portion == number]))


def prefix_hashes(data: list[bytes], starts: np.ndarray, length: int) -> np.ndarray:
    """A hash of the first ``length`` bytes at every start, a slice at a time."""
    table = mixed(np.arange(1, 257, dtype=U64))
    found, low = [np.zeros(0, U64)], 0
    while low < len(data):
        high, size = low, 0
        while high < len(data) and (high == low or size < SLICE):
            size += len(data[high])
            high += 1
        own = starts[low:high]
        base = np.cumsum([0, *map(len, data[low : high - 1])])
        place = np.repeat(base - (np.cumsum(own) - own), own) + np.arange(own.sum())
        values = table[np.frombuffer(b"".join(data[low:high]), np.uint8)]
        found.append(window_hashes(values, length, BASE)[place])
        low = high
    return np.concatenate(found)


def suffix_arrays(
    data: list[bytes],
    lead: np.ndarray,
    starts: np.ndarray,
    left: np.ndarray,
    length: int,
    most: int = STARTS,
) -> Iterator[SuffixArray]:
    """The suffix array of all contexts, in parts of whole classes.

    A class is the starts with one prefix of ``length`` bytes; starts of different
    classes are never compared, and starts alone in their class are left out. Prefixes
    meet by hash and are told apart by their bytes. A part has about ``most`` starts, or
    one larger class.
    """
    prefix = prefix_hashes(data, starts, length)
    order = np.argsort(prefix, kind="stable")
    same = prefix[order[1:]] == prefix[order[:-1]]
    again = np.zeros(len(order), bool)
    again[1:] = same
    again[:-1] |= same
    chosen = order[again]
    prefix = prefix[chosen]
    del order, same, again
    # Within a class all suffixes agree up to their minimizer, so what follows it gives
    # their order: contexts are sorted by that once.
    tails = [x[at:] for x, at in zip(data, lead.tolist(), strict=True)]
    rank = np.empty(len(data), np.int64)
    rank[sorted(range(len(data)), key=tails.__getitem__)] = np.arange(len(data))
    del tails
    sizes = np.array([len(x) for x in data], np.int64)
    text = np.frombuffer(b"".join(data), np.uint8)
    first = np.flatnonzero(np.concatenate([[True], prefix[1:] != prefix[:-1]])[: len(prefix)])
    cuts = first[np.flatnonzero(np.diff(first // most, prepend=-1))]
    for low, high in itertools.pairwise([*cuts, len(prefix)]):
        own = slice(low, high)
        yield SuffixArray(chosen[own], prefix[own], starts, sizes, rank, text, left, length)


def classes(text: np.ndarray, place: np.ndarray, prefix: np.ndarray, length: int) -> np.ndarray:
    """For the start at each place the first one with the same ``length`` bytes.

    Starts come in the order of ``prefix``, a hash of those bytes: each is compared with
    the first of its hash, those that differ with the first of them, and so on.
    """
    count = len(prefix)
    new = np.concatenate([[True], prefix[1:] != prefix[:-1]])[:count]
    first = np.maximum.accumulate(np.where(new, np.arange(count), 0))
    strings = np.lib.stride_tricks.sliding_window_view(text, length) if count else text
    asked = np.flatnonzero(~new)
    while len(asked):
        differ = [np.zeros(0, np.int64)]
        for low in range(0, len(asked), COMPARED):
            own = asked[low : low + COMPARED]
            equal = strings[place[own]] == strings[place[first[own]]]
            differ.append(own[~equal.all(axis=1)])
        asked = np.concatenate(differ)
        _, at, member = np.unique(first[asked], return_index=True, return_inverse=True)
        first[asked] = asked[at][member]
        asked = asked[first[asked] != asked]
    return first


class SuffixArray:
    """Starts that share a prefix of ``length`` bytes with another, class by class.

    ``context`` and ``offset`` name each start; those of a class stand together, in the
    order of their suffixes; ``common`` is the common prefix with the start before (0
    where a new class begins); ``left`` the byte before the start, -1 for none.
    """

    def __init__(self, chosen, prefix, starts, sizes, rank, text, left, length):
        base, before = np.cumsum(sizes) - sizes, np.cumsum(starts) - starts
        context = np.searchsorted(before, chosen, "right") - 1
        kind = classes(text, base[context] + chosen - before[context], prefix, length)
        order = np.lexsort((rank[context], kind))
        self.context, kind = context[order], kind[order]
        self.offset = chosen[order] - before[self.context]
        place = base[self.context] + self.offset
        same = np.zeros(len(place), bool)
        same[1:] = kind[1:] == kind[:-1]
        ends = base[self.context] + sizes[self.context]
        self.left = np.where(
            self.offset > 0, text[np.maximum(place - 1, 0)].astype(np.int64), left[self.context]
        )
        self.length = length
        self.common = np.zeros(len(place), np.int32)
        pairs = np.flatnonzero(same)
        self.common[pairs] = self._common(text, place, ends, pairs)

    def _common(self, text, place, ends, pairs) -> np.ndarray:
        limit = np.minimum(ends[pairs] - place[pairs], ends[pairs - 1] - place[pairs - 1])
        common = np.full(len(pairs), self.length, np.int64)
        padded = np.concatenate([text, np.zeros(8, np.uint8)])
        words = np.lib.stride_tricks.sliding_window_view(padded, 8)
        going = np.flatnonzero(common < limit)
        while len(going):
            a, b = place[pairs[going]], place[pairs[going] - 1]
            equal = words[a + common[going]] == words[b + common[going]]
            step = np.where(equal.all(axis=1), 8, equal.argmin(axis=1))
            common[going] = np.minimum(common[going] + step, limit[going])
            going = going[(step == 8) & (common[going] < limit[going])]
        return common

    def intervals(self) -> Iterator[tuple[int, int, int]]:
        """A stack scan: (common prefix, first, last) of each interval, inner ones first."""
        common = self.common.tolist()
        stack: list[tuple[int, int]] = []
        for i in range(len(common) + 1):
            now, first = common[i] if i < len(common) else 0, i - 1
            while stack and stack[-1][0] > now:
                depth, first = stack.pop()
                yield depth, first, i - 1
            if now and (not stack or stack[-1][0] < now):
                stack.append((now, first))

    def groups(self) -> Iterator[tuple[int, int, int]]:
        """The intervals with more than one left extension, or at their context's edge."""
        change = np.concatenate([[0], np.cumsum(self.left[1:] != self.left[:-1])])
        edge = np.concatenate([[0], np.cumsum((self.offset == 0) | (self.left < 0))])
        for depth, first, last in self.intervals():
            if change[last] > change[first] or edge[last + 1] > edge[first]:
                yield depth, first, last

    def longest(self) -> np.ndarray:
        """For each start the length of the longest group it occurs in, or 0."""
        longest = np.zeros(len(self.context), np.int32)
        for depth, first, last in self.groups():  # inner ones first
            own = longest[first : last + 1]
            own[own == 0] = depth
        return longest


def bucket_arrays(group: pa.Table, length: int) -> tuple[Iterator[SuffixArray], np.ndarray]:
    """The suffix array of a bucket's contexts, and the context each row stands for.

    A context that several parts hold, or one part several times, stands in it twice:
    its starts then have each other for neighbours.
    """
    seen: dict[tuple, list[int]] = {}
    columns = [group.column(c).to_pylist() for c in ("gram", "lead", "starts", "left", "bytes")]
    weight = group.column("weight").to_pylist()
    for i, key in enumerate(zip(*columns, strict=True)):
        seen.setdefault(key, []).append(i)
    chosen = [
        rows[0]
        for rows in seen.values()
        for _ in range(min(2, sum(weight[i] for i in rows)))
    ]
    stands_for = np.empty(group.num_rows, np.int64)
    at = 0
    for rows in seen.values():
        stands_for[rows] = at
        at += min(2, sum(weight[i] for i in rows))
    _, lead, starts, left, data = ([column[i] for i in chosen] for column in columns)
    numbers = (np.array(x, np.int64) for x in (lead, starts, left))
    return suffix_arrays(data, *numbers, length), stands_for


def occurrences(contexts: DataFrame, length: int) -> DataFrame:
    """For each part the starts of its contexts that occur in a group, and how long.

    Packed per part: context number, start within it and length, as 32-bit numbers.
    """

    def hits(group: pa.Table, packed: dict[int, list[bytes]]) -> None:
        arrays, stands_for = bucket_arrays(group, length)
        found = [np.zeros((3, 0), np.int32)]
        for array in arrays:
            longest = array.longest()
            hit = longest > 0
            found.append(
                np.stack([array.context[hit], array.offset[hit], longest[hit]]).astype(np.int32)
            )
        owner, offset, size = np.concatenate(found, axis=1)
        order = np.lexsort((offset, owner))
        owner, offset, size = owner[order], offset[order], size[order]
        part, number = (group.column(c).to_numpy() for c in ("part", "number"))
        low = np.searchsorted(owner, stands_for)
        high = np.searchsorted(owner, stands_for, "right")
        for i in np.flatnonzero(high > low):
            rows = slice(low[i], high[i])
            values = np.empty((3, high[i] - low[i]), np.int32)
            values[0], values[1], values[2] = number[i], offset[rows], size[rows]
            packed.setdefault(int(part[i]), []).append(values.T.tobytes())

    def run(group: pa.Table) -> pa.Table:
        packed: dict[int, list[bytes]] = {}
        for portion in portions(group):
            hits(portion, packed)
        rows = [(p, b"".join(x)) for p, x in packed.items()]
        return pa.Table.from_batches([as_batch(rows, ANSWER)])

    return contexts.groupBy("bucket").applyInArrow(run, ANSWER)


def repeat_groups(
    docs: DataFrame, length: int = LENGTH, crowd: int = CROWD, **columns: str
) -> DataFrame:
    """The maximal repeat groups and all their occurrences among distinct texts.

    ``group_id``, ``length``, ``text_sha256`` and ``start``: one row per occurrence. An
    interval's occurrences also are those of the intervals around it, as the tree has it.
    """
    _, marked, live = prepared(docs, length, crowd, **columns)
    contexts = keep(send_contexts(marked, live, length), "contexts")

    def list_groups(group: pa.Table) -> pa.Table:
        bucket, rows, count = group.column("bucket")[0].as_py(), [], 0
        for portion in portions(group):
            arrays, stands_for = bucket_arrays(portion, length)
            part, number = (portion.column(c).to_pylist() for c in ("part", "number"))
            holders: dict[int, list[int]] = {}
            for row, at in enumerate(stands_for.tolist()):
                holders.setdefault(at, []).append(row)
            found = ((array, *group) for array in arrays for group in array.groups())
            for array, depth, first, last in found:
                count += 1
                for i in range(first, last + 1):
                    for row in holders.get(int(array.context[i]), ()):
                        start = int(array.offset[i])
                        rows.append((f"{bucket}:{count}", depth, part[row], number[row], start))
        return pa.Table.from_batches([as_batch(rows, LISTED)])

    def list_holders(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, _, holders = numbered(left, told(right), length)
        out = [
            (row["part"], number, row["digest"], low)
            for row, own in zip(rows, holders, strict=True)
            for low, number in own
        ]
        return pa.Table.from_batches([as_batch(out, HELD)])

    found = contexts.groupBy("bucket").applyInArrow(list_groups, LISTED)
    ours = repeated(marked).groupBy("part").cogroup(live.groupBy("part"))
    held = ours.applyInArrow(list_holders, HELD)
    return found.join(held, ["part", "number"]).select(
        "group_id",
        "length",
        F.lower(F.hex("digest")).alias("text_sha256"),
        (F.col("low") + F.col("start")).alias("start"),
    )


def remove(marked: DataFrame, live: DataFrame, found: DataFrame, length: int) -> DataFrame:
    """What is left of the marked texts when all occurrences are covered."""
    answers = live.select("part", "data", F.lit(0).alias("kind")).union(
        found.select("part", "data", F.lit(1))
    )

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        from hashlib import sha256

        kind = right.column("kind").to_numpy()
        minimizers_told = told(right.filter(pa.array(kind == 0)))
        found = [np.zeros((0, 3), np.int32)] + [
            np.frombuffer(x.as_py(), np.int32).reshape(-1, 3)
            for x in right.filter(pa.array(kind == 1)).column("data")
        ]
        hits_of = np.concatenate(found)
        hits_of = hits_of[np.argsort(hits_of[:, 0], kind="stable")]
        text_rows, contexts, holders = numbered(left, minimizers_told, length)
        cuts = np.searchsorted(hits_of[:, 0], np.arange(len(contexts) + 1))
        out = []
        for row, own in zip(text_rows, holders, strict=True):
            text, removed, spans = row["text"], 0, 0
            kept = text
            if own:
                hits = [hits_of[cuts[number] : cuts[number + 1]] for _, number in own]
                at = np.concatenate([x[:, 1] + low for x, (low, _) in zip(hits, own, strict=True)])
                lost = covered(at, np.concatenate([x[:, 2] for x in hits]), len(text))
                removed = int(lost.sum())
                spans = int(lost[0]) + int((lost[1:] & ~lost[:-1]).sum())
                kept = np.frombuffer(text, np.uint8)[~lost].tobytes()
            out.append((row["digest"], len(text), removed, spans, sha256(kept).hexdigest()))
        return pa.Table.from_batches([as_batch(out, RESULT)])

    ours = repeated(marked).groupBy("part").cogroup(answers.groupBy("part"))
    return ours.applyInArrow(run, RESULT)


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, crowd: int = CROWD, **columns: str
) -> DataFrame:
    """One row per given row: what its text loses and the digest of what it keeps."""
    rows, marked, live = prepared(docs, length, crowd, **columns)
    found = keep(occurrences(send_contexts(marked, live, length), length), "occurrences")
    zero = F.lit(0).cast("long")
    same = marked.where("text IS NULL").select(
        "digest", "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"), "kept_sha256"
    )
    results = keep(same.union(remove(marked, live, found, length)), "results")
    return rows.join(results, "digest").select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


def op2_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents"))
