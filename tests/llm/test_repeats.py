from __future__ import annotations

import random

import pytest

from fleetpulse.llm import anchors, repeats
from tests.llm.helpers import byte_repeats, documents, sample, word_repeats

random.seed(5)
PASSAGE = " ".join(f"w{random.randrange(500)}" for _ in range(120))


def odd_rows():
    filler = lambda n: " ".join(f"f{random.randrange(10**6)}" for _ in range(n))
    rows = [
        (1, None), (2, ""), (3, "short"), (4, PASSAGE), (5, f"{filler(40)} {PASSAGE} {filler(9)}"),
        (6, f"{filler(3)} {PASSAGE[:600]}{filler(30)}"), (7, "ab " * 400), (8, "aaaa" * 300),
        (9, f"{PASSAGE}\n\n{filler(5)}  {PASSAGE}"), (10, PASSAGE), (11, "é" * 250 + filler(60)),
        (12, "é" * 250), (None, PASSAGE), (13, filler(3000)), (14, "one two " * 30),
    ]
    return rows + [(30 + i, f"{filler(i)} {PASSAGE[i : 700 + i]} {filler(20)}") for i in range(12)]


@pytest.mark.parametrize(("clashing", "crowd"), [(False, 64), (True, 0), (False, 1)])
def test_bytes_removed_equal_brute_force(spark, clashing, crowd):
    rows = odd_rows()
    found = repeats.remove_repeats(documents(spark, rows, clashing), crowd=crowd).collect()
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found)
    assert got == sorted((i or 0, *x) for (i, _), x in zip(rows, byte_repeats(rows, 200)))


def test_words_removed_equal_brute_force(spark):
    rows = odd_rows()
    found = anchors.remove_repeats(documents(spark, rows, clashing=True)).collect()
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed, r.kept_sha256) for r in found)
    assert got == sorted((i or 0, *x) for (i, _), x in zip(rows, word_repeats(rows, 50)))


def test_queries_equal_brute_force_on_the_table(spark):
    from tests.llm.helpers import FOLDER

    rows = sample(spark)
    bytes_found = {r.doc_id: tuple(r)[1:] for r in repeats.op2_suffix_array_dedup(spark, FOLDER).collect()}
    assert bytes_found == {i: x for (i, _), x in zip(rows, byte_repeats(rows, 200))}
    words_found = {r.doc_id: tuple(r)[1:] for r in anchors.op10_substring_dedup(spark, FOLDER).collect()}
    assert words_found == {i: x for (i, _), x in zip(rows, word_repeats(rows, 50))}


def test_empty_tables(spark):
    assert repeats.remove_repeats(documents(spark, [])).count() == 0
    assert anchors.remove_repeats(documents(spark, [])).count() == 0


def test_one_document_under_a_repeated_id_is_one(spark):
    rows = [(1, PASSAGE), (1, PASSAGE)]
    found = anchors.remove_repeats(documents(spark, rows)).collect()
    assert [r.n_removed for r in found] == [0, 0]


def test_groups_list_all_occurrences(spark):
    rows = [(1, "x" * 3 + PASSAGE), (2, PASSAGE + "tail"), (3, "other " + PASSAGE)]
    found = repeats.repeat_groups(documents(spark, rows)).collect()
    texts = {}
    from hashlib import sha256

    for _, text in rows:
        texts[sha256(text.encode()).hexdigest()] = text.encode()
    groups: dict[str, list] = {}
    for r in found:
        groups.setdefault(r.group_id, []).append(r)
    assert groups
    for members in groups.values():
        strings = {texts[r.text_sha256][r.start : r.start + r.length] for r in members}
        assert len(strings) == 1 and len(strings.pop()) >= 200
        assert len({(r.text_sha256, r.start) for r in members}) >= 2
    first = [m for m in groups.values() if {r.start for r in m} == {3, 0, 6}]
    assert first, "the passage's own start is a group of three occurrences"


def test_cover_reaches_every_shift():
    shifts = {(a - b) % anchors.PERIOD for a in anchors.COVER for b in anchors.COVER}
    assert shifts == set(range(anchors.PERIOD))


def test_suffix_array_equals_plain_sorting():
    import numpy as np

    texts = [b"abcabcabcabc", b"xabcabcabc", b"abcabcabcabd"]
    (array,) = repeats.suffix_arrays(
        texts, np.zeros(3, int), np.array([len(t) - 3 for t in texts]), np.full(3, -1), 4
    )
    found = [texts[c][o:] for c, o in zip(array.context, array.offset)]
    for i in range(1, len(found)):
        both = zip(found[i - 1], found[i])
        common = next((k for k, (a, b) in enumerate(both) if a != b), min(map(len, found[i - 1 : i + 1])))
        assert (array.common[i] or 0) == (common if common >= 4 else 0)


def test_prefixes_of_one_hash_are_told_apart(monkeypatch):
    import numpy as np

    texts = [b"abcabcabcabc", b"xabcabcabc", b"abcabcabcabd", b"zzzzabca"]
    sizes = np.array([len(t) - 3 for t in texts])
    monkeypatch.setattr(repeats, "prefix_hashes", lambda data, starts, _: np.zeros(starts.sum(), np.uint64))
    (array,) = repeats.suffix_arrays(texts, np.zeros(4, int), sizes, np.full(4, -1), 4)
    found = [texts[c][o : o + 4] for c, o in zip(array.context, array.offset)]
    assert sorted(found) == sorted(t[i : i + 4] for t in texts for i in range(len(t) - 3))
    assert len(set(found)) == 1 + sum(a != b for a, b in zip(found, found[1:]))
    assert [x == y for x, y in zip(found, found[1:])] == [c > 0 for c in array.common[1:]]


def test_minimizers_spread_over_buckets():
    import numpy as np

    text = np.random.default_rng(1).integers(0, 256, 60_000, np.uint8).tobytes()
    hashes = repeats.minimizers(text, 200)[2]
    per_bucket = np.bincount((hashes >> np.uint64(60)).astype(int), minlength=16)
    assert per_bucket.min() > len(hashes) / 32 and per_bucket.max() < len(hashes) / 8


def test_contexts_without_repeats_have_no_suffix_array():
    import numpy as np

    texts = [b"abcdefgh", b"ijklmnop"]
    sizes = np.array([len(t) - 3 for t in texts])
    assert not list(repeats.suffix_arrays(texts, np.zeros(2, int), sizes, np.full(2, -1), 4))
