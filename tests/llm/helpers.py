"""Small tables with every odd case, and brute-force versions of the operators."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from hashlib import sha256

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
FOLDER = "/root/testdata/sf0.001"

# Names that the operators use inside; a table may have them too.
CLASHES = ("digest", "row", "part", "fp", "key_id", "words", "batch", "document", "at", "data")


def documents(spark, rows, clashing=False):
    """A documents table of (doc_id, text) rows, with extra columns if asked for."""
    data = [(i, t, "en", None, None if t is None else len(t)) for i, t in rows]
    frame = spark.createDataFrame(data, COLUMNS)
    if clashing:
        frame = frame.selectExpr("*", *(f"'own {name}' AS {name}" for name in CLASHES))
    return frame


def sample(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    return [(row.doc_id, row.text) for row in rows]


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def digest(data: bytes) -> str:
    return sha256(data).hexdigest()


def held_out(doc_id, folds, remainder):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds == remainder


def byte_repeats(rows, length):
    """(n_bytes, n_removed, n_spans, digest) per row, as the contract of operator 2."""
    texts = [(t or "").encode() for _, t in rows]
    counts = Counter(t[k : k + length] for t in texts for k in range(len(t) - length + 1))
    out = []
    for text in texts:
        lost = bytearray(len(text))
        for k in range(len(text) - length + 1):
            if counts[text[k : k + length]] > 1:
                lost[k : k + length] = b"\1" * length
        kept = bytes(b for b, gone in zip(text, lost) if not gone)
        spans = sum(1 for k, gone in enumerate(lost) if gone and (k == 0 or not lost[k - 1]))
        out.append((len(text), sum(lost), spans, digest(kept)))
    return out


def word_repeats(rows, window):
    """(n_words, n_removed, digest) per row, as the contract of operator 10."""
    least = {}
    rank = lambda doc_id: 2**63 if doc_id is None else doc_id
    for doc_id, text in rows:
        own = words(text)
        for k in range(len(own) - window + 1):
            key = tuple(own[k : k + window])
            least[key] = min(least.get(key, rank(doc_id)), rank(doc_id))
    out = []
    for doc_id, text in rows:
        own = words(text)
        lost = [False] * len(own)
        for k in range(len(own) - window + 1):
            if least[tuple(own[k : k + window])] < rank(doc_id):
                lost[k : k + window] = [True] * window
        kept = b" ".join(w for w, gone in zip(own, lost) if not gone)
        out.append((len(own), sum(lost), digest(kept)))
    return out


def fingerprint(text):
    from xxhash import xxh64_intdigest

    own = words(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [own[k : k + 4] for k in range(max(len(own) - 3, 1))] if own else []
    hashes = [xxh64_intdigest(b" ".join(s), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_components(prints, distance=4):
    """The index of the first member of each one's component."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


def item_words(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def contaminated(rows, items, window=10):
    """(n_words, n_hit, n_items, items digest) per row, as the contract of operator 7."""
    windows = {}
    for item_id, text in items:
        own = item_words(text)
        size = min(len(own), window)
        for k in range(len(own) - size + 1 if own else 0):
            windows.setdefault(tuple(own[k : k + size]), set()).add(str(item_id))
    sizes = {len(w) for w in windows}
    out = []
    for _, text in rows:
        own = item_words(text)
        hit, found = set(), set()
        for size in sizes:
            for k in range(len(own) - size + 1):
                if (key := tuple(own[k : k + size])) in windows:
                    hit |= set(range(k, k + size))
                    found |= windows[key]
        listed = ",".join(sorted(found))
        out.append((len(own), len(hit), len(found), digest(listed.encode())))
    return out
