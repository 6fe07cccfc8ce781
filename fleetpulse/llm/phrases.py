"""Phrase collocation mining by mergeable Misra-Gries summaries.

Every run of one to ``LONGEST`` words within a piece of text is an occurrence of an
n-gram. A first pass deals the hashes of all occurrences out over hash partitions,
combined in the task and packed; each partition merges what it gets into a Misra-Gries
summary. Its capacity is ``SLACK`` times its mass divided by the threshold, so that what
the summary loses of any count is under the threshold divided by ``SLACK``: every
frequent n-gram survives. Equal hashes only add up, which drops nothing either.

The survivors set bits of a map of fixed size, which is all that is broadcast. A second
pass counts the n-grams with their bit set as words, not hashes, in the task and then by
hash partition: the counts are exact, whatever got past the map by chance. Scores, the drop of phrases
inside longer ones and the ranking are DataFrame operations on the frequent phrases.

Where the map fills up (far beyond ``MAP_BITS`` / 10 frequent n-grams) it holds back less
and the second pass moves more rows; the result is the same.

Defined cases: a NULL text is the empty one and has no words; a NULL language is ``und``;
rows that repeat count again; a text or piece without words counts nothing; texts of any
length are read in blocks that overlap by what an n-gram needs; an empty table gives no
rows; equal scores are ordered by count, then phrase in UTF-8 byte order. Further
columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetpulse.llm.shared import by_value, keep, once, partitions, table, whole_text

by_value(__name__)

THRESHOLD = 30
LONGEST = 4
TOP = 2000
INSIDE = 80  # percent of a phrase's occurrences inside a longer one that drop it
UNKNOWN = "und"
SLACK = 4
MAP_BITS = 27
# Text that one hash partition is made for, and what tasks handle at once.
PARTITION_BYTES = 8 << 20
BLOCK_BYTES = 4 << 20
CHUNK = 4 << 20
WORDS = 1 << 19
PLACES = 1 << 20
WAITING = 1 << 20
PIECES = b".,;:!?\n\x0b\x0c\r"
BREAK = b"\xff"  # in no UTF-8 text
STEP = np.uint64(0x9E3779B97F4A7C15)
SPREAD = np.uint64(0xD6E8FEB86659FD93)
LETTERS = bytes(
    255 if b in PIECES else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256)
)


def slices(data: bytes) -> Iterator[bytes]:
    """``data`` in parts of about ``BLOCK_BYTES`` that end where a word ends."""
    at = 0
    while at < len(data):
        end = at + BLOCK_BYTES
        ends = [x for x in (data.find(b" ", end), data.find(BREAK, end)) if x >= 0]
        end = min(ends, default=len(data))
        yield data[at:end]
        at = end


def split_words(data: bytes) -> tuple[object, np.ndarray, int]:
    """The words, dictionary-encoded, the number of breaks before each, and all breaks."""
    import pyarrow as pa

    letters = np.frombuffer(data, np.uint8)
    breaks = letters == BREAK[0]
    inside = ~(breaks | (letters == 32))
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(letters[inside])]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), buffers)
    passed = np.cumsum(breaks, dtype=np.int64)
    return words.dictionary_encode(), passed[starts], int(passed[-1]) if len(passed) else 0


class Block(NamedTuple):
    """Words of one language in a row; n-grams do not leave a piece."""

    lang: str
    seed: int
    ids: np.ndarray  # the words' numbers, from 1
    pieces: np.ndarray  # the number of each word's piece
    carried: int  # how many words at the front were in the block before


def ngram_hashes(
    block: Block, hashes: np.ndarray, longest: int = LONGEST
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per length: the starts of the n-grams that end among the fresh words, and hashes."""
    word = hashes[block.ids] ^ np.uint64(block.seed)
    mixed = word
    for length in range(1, longest + 1):
        if length > 1:
            mixed = (mixed[:-1] ^ (mixed[:-1] >> np.uint64(29))) * STEP + word[length - 1 :]
        last = length - 1
        whole = block.pieces[: len(mixed)] == block.pieces[last:]
        whole[: max(block.carried - last, 0)] = False
        starts = np.flatnonzero(whole)
        code = mixed[starts]
        code = (code ^ (code >> np.uint64(32))) * SPREAD
        yield length, starts, code ^ (code >> np.uint64(31))


class Reader:
    """Turns the batches of a task into numbered words, language by language."""

    def __init__(self) -> None:
        self.renew()

    def renew(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.words, self.hashes = [b""], np.zeros(1, np.uint64)

    def blocks(self, batches: Iterator) -> Iterator[Block | None]:
        """None says that the words are about to be numbered anew."""
        waiting: dict[str, list[bytes]] = {}
        size = 0
        for batch in batches:
            for k in range(batch.num_rows):
                lang, text = (column[k].as_py() for column in batch.columns)
                data = text.encode().translate(LETTERS)
                waiting.setdefault(lang, []).append(data)
                size += len(data)
                if size >= BLOCK_BYTES:
                    yield from self.numbered(waiting)
                    waiting, size = {}, 0
                    if len(self.words) > WORDS:
                        yield None
                        self.renew()
        yield from self.numbered(waiting)

    def numbered(self, waiting: dict[str, list[bytes]]) -> Iterator[Block]:
        from xxhash import xxh64_intdigest

        for lang, texts in waiting.items():
            seed, passed = xxh64_intdigest(lang.encode(), 1), 0
            before = np.zeros(0, np.int64), np.zeros(0, np.int64)
            for data in slices(BREAK.join(texts)):
                encoded, pieces, breaks = split_words(data)
                known = self.known(encoded.dictionary.to_pylist())
                ids = np.concatenate([before[0], known[encoded.indices.to_numpy()]])
                pieces = np.concatenate([before[1], pieces + passed])
                yield Block(lang, seed, ids, pieces, len(before[0]))
                passed += breaks
                before = ids[-(LONGEST - 1) :], pieces[-(LONGEST - 1) :]

    def known(self, words: list[bytes]) -> np.ndarray:
        """The numbers of distinct words, new ones included."""
        from xxhash import xxh64_intdigest

        numbers, fresh = self.numbers, []
        for word in words:
            if word not in numbers:
                numbers[word] = len(self.words)
                self.words.append(word)
                fresh.append(xxh64_intdigest(word))
        self.hashes = np.concatenate([self.hashes, np.array(fresh, np.uint64)])
        return np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))


def combined(codes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order and the sum of their counts."""
    if counts is None:
        codes = np.sort(codes)
    else:
        order = np.argsort(codes, kind="stable")
        codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else codes[:0].astype(np.int64)
    if counts is None:
        return codes[first], np.diff(np.append(first, len(codes)))
    return codes[first], np.add.reduceat(counts, first) if len(first) else counts


def packed(codes: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted 32-bit codes and their counts, as compressed differences."""
    import zstandard

    steps = np.diff(codes, prepend=np.uint32(0)).astype(np.uint32)
    planes = np.stack([steps, np.minimum(counts, 2**32 - 1).astype(np.uint32)])
    data = np.ascontiguousarray(planes.view(np.uint8).reshape(2, -1, 4).transpose(0, 2, 1))
    return zstandard.ZstdCompressor(level=1).compress(data.tobytes())


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(2, 4, -1)
    steps, counts = np.ascontiguousarray(planes.transpose(0, 2, 1)).view(np.uint32)[..., 0]
    return np.cumsum(steps, dtype=np.uint32), counts.astype(np.int64)


class Summary:
    """A Misra-Gries summary of the codes of one hash partition.

    ``lost`` bounds what any code's count is short of; it stays at or under the mass
    divided by the capacity, however the mass comes in parts.
    """

    def __init__(self, mass: int, threshold: int = THRESHOLD, slack: int = SLACK) -> None:
        self.capacity = slack * mass // threshold + 1
        self.threshold, self.lost = threshold, 0
        self.codes, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def merge(self, codes: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((codes, counts))
        self.size += len(codes)
        if self.size >= self.capacity:
            self.settle()

    def settle(self) -> None:
        codes, counts = zip((self.codes, self.counts), *self.waiting)
        self.codes, self.counts = combined(np.concatenate(codes), np.concatenate(counts))
        self.waiting, self.size = [], 0
        if len(self.codes) > self.capacity:
            # The largest count that does not fit goes from all, and what is used up goes.
            rank = len(self.counts) - self.capacity - 1
            cut = int(np.partition(self.counts, rank)[rank])
            self.counts -= cut
            self.lost += cut
            held = self.counts > 0
            self.codes, self.counts = self.codes[held], self.counts[held]

    def survivors(self) -> np.ndarray:
        self.settle()
        return self.codes[self.counts + self.lost >= self.threshold]


def partition_bits(size: int) -> int:
    """The binary digits of the number of hash partitions for texts of ``size`` bytes."""
    return min(max(math.ceil(math.log2(max(size, 1) / PARTITION_BYTES)), 0), 30)


def _batch(columns: list, names: list[str], types: list) -> object:
    import pyarrow as pa

    arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names)


def hash_packets(texts: DataFrame, bits: int) -> DataFrame:
    """``bucket``, ``turn`` (0: its ``mass``, 1: ``data``) of each task's n-grams."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names, types = ["bucket", "turn", "mass", "data"], [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        masses: dict[int, int] = {}

        def emit(parts: list[np.ndarray]) -> Iterator:
            codes = np.concatenate(parts)
            parts.clear()
            codes, counts = combined(codes)
            owner = (codes >> np.uint64(63 - bits)) >> np.uint64(1)
            ends = np.flatnonzero(np.diff(owner.astype(np.int64), prepend=-1))
            for low, high in zip(ends, np.append(ends[1:], len(codes)), strict=True):
                bucket = int(owner[low])
                masses[bucket] = masses.get(bucket, 0) + int(counts[low:high].sum())
                # 32 bits below the partition's; equal ones only add up.
                short = ((codes[low:high] << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)
                yield _batch([[bucket], [1], [0], [packed(*combined(short, counts[low:high]))]], names, types)

        reader = Reader()
        parts, size = [], 0
        for block in reader.blocks(batches):
            if block is None:
                continue
            for _, _, code in ngram_hashes(block, reader.hashes):
                parts.append(code)
                size += len(code)
            if size >= CHUNK:
                yield from emit(parts)
                parts, size = [], 0
        if size:
            yield from emit(parts)
        if masses:
            yield _batch([list(masses), [0] * len(masses), list(masses.values()), [None] * len(masses)], names, types)

    return texts.mapInArrow(run, "bucket long, turn long, mass long, data binary")


def survivor_map(packets: DataFrame, bits: int, threshold: int = THRESHOLD) -> np.ndarray:
    """The bits of the n-grams that survive, as bytes: 2 ** MAP_BITS bits in all.

    Each hash partition owns a stretch of the map and sends it compressed.
    """
    digits = max(MAP_BITS, bits + 3)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import zstandard

        names, types = ["bucket", "data"], [pa.int64(), pa.binary()]

        def stretch(bucket: int, summary: Summary) -> object:
            slots = summary.survivors() >> np.uint32(32 - (digits - bits))
            held = np.zeros(1 << (digits - bits), np.uint8)
            held[slots] = 1
            data = zstandard.ZstdCompressor().compress(np.packbits(held, bitorder="little").tobytes())
            return _batch([[bucket], [data]], names, types)

        at, mass, summary = None, 0, None
        for batch in batches:
            for k in range(batch.num_rows):
                bucket, turn, more, data = (column[k].as_py() for column in batch.columns)
                if bucket != at:
                    if summary is not None:
                        yield stretch(at, summary)
                    at, mass, summary = bucket, 0, None
                if turn == 0:
                    mass += more
                else:
                    summary = summary or Summary(mass, threshold)
                    summary.merge(*unpacked(data))
        if summary is not None:
            yield stretch(at, summary)

    import zstandard

    dealt = packets.repartition(partitions(packets.sparkSession), "bucket")
    found = dealt.sortWithinPartitions("bucket", "turn").mapInArrow(run, "bucket long, data binary")
    held = np.zeros(1 << (digits - 3), np.uint8)
    width = 1 << (digits - bits - 3)
    for bucket, data in found.collect():
        raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(data)), np.uint8)
        held[bucket * width : (bucket + 1) * width] = raw
    return held


class Counts:
    """Exact counts of a task's n-grams, each told by language and word numbers.

    An n-gram is counted in its place of a table if that holds it or nothing yet. The
    others wait and are combined by sorting. Hashes only lead to the place or into
    order; what is equal is decided by the words.
    """

    def __init__(self) -> None:
        self.codes = np.zeros(PLACES, np.uint64)
        self.keys = np.zeros((PLACES, LONGEST + 1), np.int32)
        self.counts = np.zeros(PLACES, np.int64)
        self.clear()

    def clear(self) -> None:
        self.counts[:] = 0
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, codes: np.ndarray, keys: np.ndarray) -> None:
        place = (codes & np.uint64(PLACES - 1)).astype(np.int64)
        free = self.counts[place] == 0
        self.codes[place[free]], self.keys[place[free]] = codes[free], keys[free]
        own = self.codes[place] == codes
        own[own] = (self.keys[place[own]] == keys[own]).all(axis=1)
        np.add.at(self.counts, place[own], 1)
        rest = int(len(own) - np.count_nonzero(own))
        if rest:
            self.waiting.append((codes[~own], keys[~own], np.ones(rest, np.int64)))
            self.size += rest

    def settle(self) -> None:
        """Combine what waits."""
        if not self.size:
            return
        codes, keys, counts = map(np.concatenate, zip(*self.waiting))
        order = np.argsort(codes, kind="stable")
        codes, keys, counts = codes[order], keys[order], counts[order]
        differ = np.append(True, (keys[1:] != keys[:-1]).any(axis=1))
        if (differ & np.append(False, codes[1:] == codes[:-1])).any():
            # Different words under one hash: order by the words instead.
            order = np.lexsort(keys.T)
            codes, keys, counts = codes[order], keys[order], counts[order]
            differ = np.append(True, (keys[1:] != keys[:-1]).any(axis=1))
        starts = np.flatnonzero(differ)
        self.waiting = [(codes[starts], keys[starts], np.add.reduceat(counts, starts))]
        self.size = len(starts)

    def all(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes, keys and counts; an n-gram may be there twice."""
        self.settle()
        used = np.flatnonzero(self.counts)
        parts = [(self.codes[used], self.keys[used], self.counts[used]), *self.waiting]
        codes, keys, counts = map(np.concatenate, zip(*parts))
        return codes, keys, counts


def phrase_packets(texts: DataFrame, held: np.ndarray, bits: int) -> DataFrame:
    """Exact counts of the n-grams with a bit in the map, by task.

    A row has all of a task that one hash partition gets of one ``lang``: ``data`` with
    counts and phrases, or, in partition 0, the number of its ``words``.
    """
    digits = int(math.log2(len(held))) + 3
    shared = texts.sparkSession.sparkContext.broadcast(held.tobytes())
    name = f"survivors-{uuid.uuid4().hex}"

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import zstandard

        there = once(name, lambda: np.frombuffer(shared.value, np.uint8))
        names = ["bucket", "lang", "words", "data"]
        types = [pa.int64(), pa.string(), pa.int64(), pa.binary()]
        reader, counts = Reader(), Counts()
        langs: dict[str, int] = {}
        totals: dict[str, int] = {}

        def rows() -> Iterator:
            codes, keys, numbers = counts.all()
            if not len(codes):
                return
            owner = ((codes >> np.uint64(63 - bits)) >> np.uint64(1)).astype(np.int64)
            order = np.lexsort((owner, keys[:, 0]))
            keys, numbers, owner = keys[order], numbers[order], owner[order]
            apart = (np.diff(owner) != 0) | (np.diff(keys[:, 0]) != 0)
            starts = np.flatnonzero(np.append(True, apart))
            listed, words = list(langs), reader.words
            for low, high in zip(starts, np.append(starts[1:], len(order)), strict=True):
                phrases = [b" ".join([words[i] for i in key if i]) for key in keys[low:high, 1:].tolist()]
                raw = numbers[low:high].tobytes() + b"\n".join(phrases)
                data = zstandard.ZstdCompressor(level=1).compress(raw)
                yield _batch([[int(owner[low])], [listed[keys[low, 0]]], [high - low], [data]], names, types)
            counts.clear()

        for block in reader.blocks(batches):
            if block is None:
                yield from rows()
                continue
            number = langs.setdefault(block.lang, len(langs))
            totals[block.lang] = totals.get(block.lang, 0) + len(block.ids) - block.carried
            for length, starts, code in ngram_hashes(block, reader.hashes):
                slot = code >> np.uint64(64 - digits)
                bit = there[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)
                chosen = np.flatnonzero(bit & 1)
                keys = np.zeros((len(chosen), LONGEST + 1), np.int32)
                keys[:, 0] = number
                for k in range(length):
                    keys[:, k + 1] = block.ids[starts[chosen] + k]
                counts.add(code[chosen], keys)
            if counts.size >= WAITING:
                counts.settle()
                if counts.size >= WAITING // 2:
                    yield from rows()
        yield from rows()
        if totals:
            yield _batch([[0] * len(totals), list(totals), list(totals.values()), [None] * len(totals)], names, types)

    return texts.mapInArrow(run, "bucket long, lang string, words long, data binary")


def summed(packets: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``lang``, ``phrase``, its ``size`` in words and count ``n``, if frequent.

    Size 0 has the language's words. A task holds the phrases of one hash partition.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import zstandard

        names, types = ["lang", "phrase", "size", "n"], [pa.string(), pa.binary(), pa.int32(), pa.int64()]

        def frequent(lang: str, found: dict[bytes, int], words: int) -> object:
            chosen = [(p, n) for p, n in found.items() if n >= threshold]
            sizes = [p.count(b" ") + 1 for p, _ in chosen]
            if words:
                chosen, sizes = [*chosen, (b"", words)], [*sizes, 0]
            phrases, counts = zip(*chosen) if chosen else ((), ())
            batch = _batch([[lang] * len(chosen), phrases, sizes, counts], names, types)
            return batch.set_column(1, "phrase", batch.column(1).cast(pa.string()))

        at, found, words = None, {}, 0
        for batch in batches:
            for k in range(batch.num_rows):
                bucket, lang, more, data = (column[k].as_py() for column in batch.columns)
                if (bucket, lang) != at:
                    if at is not None:
                        yield frequent(at[1], found, words)
                    at, found, words = (bucket, lang), {}, 0
                if data is None:
                    words += more
                    continue
                raw = zstandard.ZstdDecompressor().decompress(data)
                counts = np.frombuffer(raw, np.int64, more).tolist()
                for phrase, n in zip(raw[8 * more :].split(b"\n"), counts, strict=True):
                    found[phrase] = found.get(phrase, 0) + n
        if at is not None:
            yield frequent(at[1], found, words)

    dealt = packets.repartition(partitions(packets.sparkSession), "bucket")
    return dealt.sortWithinPartitions("bucket", "lang").mapInArrow(
        run, "lang string, phrase string, size int, n long"
    )


def frequent_phrases(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """All n-grams with at least ``threshold`` occurrences and their counts, kept.

    ``lang``, ``phrase``, ``size``, ``n``; size 0 has the language's words.
    """
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN))
    texts = docs.select(lang.alias("lang"), whole_text().cast("string").alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = partition_bits(size)
    held = survivor_map(hash_packets(texts, bits), bits, threshold)
    return keep(summed(phrase_packets(texts, held, bits), threshold), "phrases")


def exact(value: Column) -> Column:
    return value.cast("decimal(20,0)")


def scored(phrases: DataFrame) -> DataFrame:
    """Phrases of two words and more with the cut that scores lowest."""
    known = phrases.where("size > 0").select(F.col("lang").alias("of_lang"), F.col("phrase").alias("part"), F.col("n").alias("of"))
    cuts = phrases.where("size > 1").select(
        "lang", "phrase", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    )
    cuts = cuts.withColumn("left", F.expr("substring_index(phrase, ' ', k)"))
    cuts = cuts.withColumn("right", F.expr("substr(phrase, length(left) + 2)"))
    for side, name in (("left", "l"), ("right", "r")):
        same = (F.col("lang") == F.col("of_lang")) & (F.col(side) == F.col("part"))
        cuts = cuts.join(known, same).withColumnRenamed("of", name).drop("of_lang", "part", side)
    score = F.call_function("div", exact(F.col("a")) * F.lit(2_000_000).cast("decimal(7,0)"), exact(F.col("l")) + exact(F.col("r")))
    best = F.min(F.struct(score.cast("long").alias("score"), "k", "l", "r")).alias("best")
    return cuts.groupBy("lang", "phrase", "a").agg(best).select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def inside_longer(phrases: DataFrame) -> DataFrame:
    """``of_lang``, ``part`` and the largest count ``most`` of a longer phrase around it."""
    words = F.split("phrase", " ")
    longer = phrases.where("size > 2").select(
        "lang", "n", "size", words.alias("words"), F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("length")
    )
    placed = longer.select("lang", "n", "words", "length", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)).alias("at"))
    part = F.concat_ws(" ", F.slice("words", F.col("at"), F.col("length")))
    return placed.groupBy(F.col("lang").alias("of_lang"), part.alias("part")).agg(F.max("n").alias("most"))


def collocations(docs: DataFrame, threshold: int = THRESHOLD, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language by score."""
    phrases = frequent_phrases(docs, threshold)
    covers = (
        (F.col("lang") == F.col("of_lang"))
        & (F.col("phrase") == F.col("part"))
        & (exact(F.col("most")) * 100 >= exact(F.col("a")) * INSIDE)
    )
    open_phrases = scored(phrases).join(inside_longer(phrases), covers, "left_anti")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = open_phrases.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= top)
    totals = phrases.where("size = 0").select(F.col("lang").alias("of_lang"), F.col("n").alias("all"))
    found = first.join(totals, F.col("lang") == F.col("of_lang"))
    return found.select("lang", "rank", "phrase", "a", "l", "r", F.col("all").alias("n"), "score")


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PARTS = " UNION ALL ".join(
    f"SELECT lang, {n} AS s, unnest(list_transform(range(1, len(w) - {n - 2}), "
    f"lambda i: array_to_string(w[i:i + {n - 1}], ' '))) AS p FROM w"
    for n in range(1, LONGEST + 1)
)
_CUTS = " UNION ALL ".join(
    f"SELECT lang, p, a, {k} AS k, array_to_string(w[:{k}], ' ') AS lp, "
    f"array_to_string(w[{k + 1}:], ' ') AS rp FROM c WHERE s > {k}"
    for k in range(1, LONGEST)
)
_INSIDE = " UNION ALL ".join(
    f"SELECT lang, a, unnest(list_transform(range(1, s - {n - 2}), "
    f"lambda i: array_to_string(w[i:i + {n - 1}], ' '))) AS p FROM c WHERE s > {n}"
    for n in range(2, LONGEST)
)
SQL = rf"""
    WITH d AS (
      SELECT coalesce(lang, '{UNKNOWN}') AS lang,
        unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
    t AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY 1),
    g AS ({_PARTS}),
    f AS (SELECT lang, s, p, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= {THRESHOLD}),
    c AS (SELECT *, string_split(p, ' ') AS w FROM f WHERE s > 1),
    k AS ({_CUTS}),
    o AS (
      SELECT k.*, x.a AS l, y.a AS r,
        CAST(CAST(2000000 AS HUGEINT) * k.a // (CAST(x.a AS HUGEINT) + y.a) AS BIGINT) AS score
      FROM k JOIN f x ON x.lang = k.lang AND x.p = lp JOIN f y ON y.lang = k.lang AND y.p = rp),
    b AS (
      SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, k) AS cut FROM o),
    i AS (SELECT lang, p, max(a) AS m FROM ({_INSIDE}) GROUP BY 1, 2),
    q AS (
      SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, b.p) AS rank
      FROM b LEFT JOIN i ON i.lang = b.lang AND i.p = b.p
      WHERE cut = 1 AND NOT coalesce(100 * CAST(m AS HUGEINT) >= {INSIDE} * CAST(b.a AS HUGEINT), FALSE))
    SELECT q.lang, rank, p AS phrase, a, l, r, n, score FROM q JOIN t ON t.lang = q.lang
    WHERE rank <= {TOP}
"""
