from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from fleetpulse.llm import boosting, brown, pii, quality
from tests.llm.helpers import FOLDER, digest, documents, held_out, sample, words

# The contract's own patterns.
PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)
TEXTS = [
    None, "", "a@b.c", "a@@b.c x@y", "a@b.c@d.e.f", "@b.c", "é.x@y-.z.", "1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1",
    "001.02.3.255 1.2.3", "4111 1111 1111 1111", "4111-1111-1111-1112", "4111  1111 1111 1111",
    "+1 (555) 555-0100.", "+12 ", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "++1-234-567-890", "ü+49 30 1234567é",
    "1" * 5000, "a" * 30_000, ("1.2." * 9000), "+" * 5000 + "1 2", "x@" * 4000, "1 " * 9000, "a.b@c." * 3000,
]


def plain_spans(text):
    def passes(kind, body):
        digits = re.sub("[^0-9]", "", body)
        if kind == "ip":
            return all((p.lstrip("0") or "0").isdigit() and len(p.lstrip("0")) < 4 and int(p) < 256
                       for p in body.split("."))
        if kind == "phone":
            return 9 <= len(digits) <= 15
        if kind == "card":
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            return 13 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0
        return True

    return [
        (kind, m.start(), m.end())
        for kind, pattern in PATTERNS
        for m in re.finditer(pattern, text or "")
        if passes(kind, m.group())
    ]


SLOW = {"1.2." * 9000, "a" * 30_000}


@pytest.mark.parametrize("number", range(len(TEXTS)))
def test_base_spans_equal_the_patterns(number):
    text = TEXTS[number] or ""
    if text in SLOW:  # the plain patterns take minutes here
        text = text[:2000]
        assert len(pii.base_spans(TEXTS[number])) >= 0
    assert pii.base_spans(text) == plain_spans(text)


def test_random_texts_equal_the_patterns():
    random.seed(2)
    for _ in range(3000):
        text = "".join(random.choice("12 3.4@a-b+(5)") for _ in range(random.randrange(60)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_found_spans(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS) if t not in SLOW] + [(None, "a@b.c"), (2, "a@b.c")]
    docs = documents(spark, rows, clashing=True)
    found = pii.find(docs, pii.fit(docs)).collect()
    assert len(found) == len(rows)
    expected = Counter((i, digest(pii.joined(plain_spans(t)).encode())) for i, t in rows)
    assert Counter((r.doc_id, r.base_sha256) for r in found) == expected
    assert pii.find(documents(spark, []), pii.PiiModel({}, {})).count() == 0


def test_added_spans_are_other_forms_of_personal_data(spark):
    random.seed(7)
    rows = []
    for i in range(600):
        a, b, c = random.randrange(200, 999), random.randrange(200, 999), random.randrange(1000, 9999)
        rows += [
            (4 * i, f"call me on +1 ({a}) {b}-{c} before noon"),
            (4 * i + 1, f"write to user{i}.{a}@mail{i % 9}.example.com today"),
            (4 * i + 2, f"order {a}{b}{c}{a}{b} of 20{i % 30:02d}-0{i % 9 + 1}-11 10:30:{i % 60:02d}"),
            (4 * i + 3, f"section {a}.{b} and {a} - {b} words, version 1.{i}.{a}"),
        ]
    model = pii.fit(documents(spark, rows))
    assert {"phone", "email"} <= set(model.trees)
    fresh = [
        (1, "call me on (415) 555-0132 before noon"), (2, "write to jane.roe7 (at) mail3.example.com today"),
        (3, "order 5552213321555 of 2021-04-11 10:30:12"), (4, "nothing here"),
    ]
    spans = {r.doc_id: r.spans for r in pii.find(documents(spark, fresh), model).collect()}
    assert spans == {1: "phone:11:25", 2: "email:9:41", 3: "", 4: ""}
    shared = [(1, fresh[0][1]), (1, "mail a@b.org"), (None, fresh[0][1]), (2, None), (2, "é 10.0.0.1.")]
    redacted = pii.redact(documents(spark, shared, clashing=True), model).collect()
    phone = "call me on [phone] before noon"
    assert sorted((r.doc_id or 0, r.text) for r in redacted) == sorted(
        [(1, phone), (1, "mail [email]"), (0, phone), (2, ""), (2, "é [ip].")]
    )
    assert pii.redact(documents(spark, []), model).count() == 0


@pytest.mark.parametrize(
    ("text", "wanted"),
    [
        ("Suite 200 (415) 555-0132", ["(415) 555-0132"]),
        ("(415) 555-0132 (415) 555-0133", ["(415) 555-0132", "(415) 555-0133"]),
        ("2024 415 555 0132", ["415 555 0132"]),
        ("1 " * 40 + "+1 415 555 0132", ["+1 415 555 0132"]),
    ],
)
def test_numbers_beside_numbers_are_candidates(text, wanted):
    proposed = {text[low:high] for kind, low, high in pii.candidates(text) if kind == "phone"}
    assert set(wanted) <= proposed
    assert ("ip", 3, 10) in pii.candidates("at 1.2.3.4")


def test_kinds_that_few_documents_hold_are_fitted(spark):
    rows = [(i, f"row {i} of {i * 7 % 1000} at 10:{i % 60:02d}") for i in range(4000)]
    rows += [(5000 + i, f"call +1 (415) 555-{1000 + 37 * i} or a{i}@b{i}.example.org") for i in range(16)]
    assert {"phone", "email"} <= set(pii.fit(documents(spark, rows)).trees)


@pytest.fixture(scope="module")
def pii_model(spark):
    return pii.fit(documents(spark, sample(spark)))


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "a@b.org"), (None, "1.2.3.4"), (1, "")]])
def test_every_kind_is_fitted_at_every_size(spark, rows):
    assert set(pii.fit(documents(spark, rows)).trees) == set(pii.KINDS)


@pytest.mark.parametrize("kind", pii.KINDS)
def test_made_up_spans_are_base_spans(kind):
    for number in range(1000):
        body = pii.made_up(kind, number)
        assert (kind, 0, len(body)) in pii.base_spans(body), body


@pytest.mark.parametrize("kind", pii.KINDS)
def test_recall_of_planted_forms(spark, pii_model, kind):
    texts = [text or "" for _, text in sample(spark)]
    caught = Counter()
    for number in range(5000, 5100):
        for form, body in enumerate(pii.rewritten(kind, pii.made_up(kind, number))):
            lead = texts[number % len(texts)][:150] + " "
            text = f"{lead}{body} and more"
            base = pii.base_spans(text)
            every = base + pii.added_spans(text, base, pii_model)
            caught[form] += (kind, len(lead), len(lead) + len(body)) in every
    assert caught and min(caught.values()) >= 90, caught


def test_added_spans_equal_one_by_one_choice(spark, pii_model):
    for number, (_, text) in enumerate(sample(spark)):
        kind = pii.KINDS[number % 4]
        body = pii.rewritten(kind, pii.made_up(kind, number))[0]
        text = f"{(text or '')[:3000]} {body} {body}1 2"
        base = pii.base_spans(text)
        rated = []
        for span in pii.candidates(text):
            x = np.array([pii.features(text, span)], float)
            score = float(pii_model.trees[span[0]].score(x)[0])
            if score >= pii_model.thresholds[span[0]]:
                rated.append((-score, span))
        chosen = list(base)
        for _, (k, low, high) in sorted(rated):
            if all(high <= a or b <= low for _, a, b in chosen):
                chosen.append((k, low, high))
        assert sorted(chosen) == sorted(base + pii.added_spans(text, base, pii_model))


def test_pii_query_finds_what_the_patterns_find(spark):
    found = {r.doc_id: r for r in pii.op6_pii(spark, FOLDER).collect()}
    for doc_id, text in sample(spark):
        base = plain_spans(text)
        r = found[doc_id]
        assert r.base_sha256 == digest(pii.joined(base).encode())
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(r.spans.split(","))
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(
            sum(k == kind for k, _, _ in base) for kind in pii.KINDS
        )


def test_boosted_trees_learn_a_rule():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.5)).astype(float)
    model = boosting.fit_trees(x[:1000], y[:1000])
    assert ((model.score(x[1000:]) > 0.5) == y[1000:]).mean() > 0.95
    assert boosting.fit_trees(x[:20], np.zeros(20)).score(x[:5]).max() < 0.1


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_quality_learns_from_its_rows_alone(spark):
    table = spark.read.parquet(f"{FOLDER}/labels.parquet")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    chosen = quality.training_rows(docs, table).count()
    known = [r.doc_id for r in table.collect() if not held_out(r.doc_id, 3, 1)]
    assert chosen == len(known)


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    found = quality.op3_quality(spark, folder).collect()
    assert len(found) == 1000 and all(0 <= r.score <= 1 for r in found)
    assert all(r.predicted == int(r.score >= 0.5) for r in found)
    assert all(r.held_out == held_out(r.doc_id, 3, 1) for r in found)
    right = [r.predicted == truth[r.doc_id] for r in found if r.held_out and r.doc_id in truth]
    assert len(right) > 80 and np.mean(right) > 0.93


@pytest.mark.parametrize("known", [[], [(1, 1, 0), (2, None, 0), (None, 0, 0), (3, 7, 1)]])
def test_quality_without_both_classes(spark, known):
    rows = [(1, "fine text"), (2, None), (3, ""), (None, "x"), (1, "fine text"), (4, "y" * 200_000)]
    docs = documents(spark, rows, clashing=True)
    model = quality.fit(docs, labels(spark, known))
    scores = docs.select(quality.score(model, quality.whole_text()).alias("s")).collect()
    assert len({r.s for r in scores}) == 1 and 0.5 <= scores[0].s < 1
    assert quality.keep_good(docs, labels(spark, known)).columns == docs.columns
    assert quality.keep_good(documents(spark, []), labels(spark, known)).count() == 0


def test_quality_prior_is_that_of_all_labels(spark, monkeypatch):
    rows = [(i, "the same words in every text") for i in range(1800)]
    docs, known = documents(spark, rows), labels(spark, [(i, int(i % 6 > 0), 0) for i, _ in rows])
    monkeypatch.setattr(quality, "PER_CLASS", 60)
    score = docs.select(quality.score(quality.fit(docs, known), quality.whole_text()).alias("s"))
    assert abs(score.first().s - 5 / 6) < 0.03


def brute_scores(rows):
    tokens = [[*(w.lower() for w in words(t)), None] for _, t in rows]
    learned = [i is not None and not held_out(i, 7, 2) for i, _ in rows]
    counts = Counter(w for own, use in zip(tokens, learned) if use for w in own)
    total = sum(counts.values())
    return total, [
        (
            len(own),
            sum(w in counts for w in own),
            sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in own),
        )
        for own in tokens
    ]


BROWN_ROWS = [
    (1, None), (2, ""), (3, "a b a b"), (4, "A b É é"), (None, "a unseen"), (3, "a b a b"),
    (5, "z " * 60_000), (6, "c d"), (7, "c d e"), (8, "\t"), (9, "new words only here"),
]


def test_base_scores_equal_brute_force(spark):
    total, expected = brute_scores(BROWN_ROWS)
    found = brown.score_texts(documents(spark, BROWN_ROWS, clashing=True)).collect()
    assert {r.train_tokens for r in found} == {total}
    got = sorted((r.doc_id or 0, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in found)
    assert got == sorted((i or 0, n, k, round(b, 6)) for (i, _), (n, k, b) in zip(BROWN_ROWS, expected))
    assert all(r.held_out == held_out(r.doc_id, 7, 2) for r in found)
    assert all(-1e7 < r.score < 0 for r in found)


def test_nothing_to_learn_from(spark):
    assert brown.score_texts(documents(spark, [])).count() == 0
    found = brown.score_texts(documents(spark, [(None, "a b"), (None, "")])).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 for r in found)
    assert all(math.isfinite(r.score) for r in found)


def test_model_beats_the_base_on_held_out_rows(spark):
    found = brown.op9_brown_scores(spark, "/root/testdata/sf0.01").collect()
    unseen = [r for r in found if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def likelihood(pairs, own, classes):
    every = np.append(own, [classes, classes + 1])
    between = np.zeros((classes + 2, classes + 2))
    for a, row in enumerate(pairs):
        np.add.at(between[every[a]], every, row)
    f = lambda x: (x * np.log(np.maximum(x, 1))).sum()
    return f(between) - 2 * f(between.sum(axis=1))


@pytest.mark.parametrize("seed", range(4))
def test_no_single_exchange_improves_the_classes(seed):
    rng = np.random.default_rng(seed)
    own = rng.integers(0, 3, 24)
    pairs = np.zeros((26, 26), np.int64)
    for a in range(24):
        pairs[a, :24] = rng.poisson(np.where(own == (own[a] + 1) % 3, 40, 1))
    pairs[:24, 24] = pairs[24, :24] = 5
    found = brown.exchange(pairs, 3, sweeps=50)
    best = likelihood(pairs, found, 3)
    for word in range(24):
        for other in range(3):
            moved = found.copy()
            moved[word] = other
            assert likelihood(pairs, moved, 3) <= best + 1e-6


@pytest.mark.parametrize("seed", range(3))
def test_gains_of_a_sweep_equal_the_likelihood(seed):
    rng = np.random.default_rng(seed)
    classes, n = 4, 14
    size = 1 + classes + 2
    own = np.append(0, rng.integers(1, size, n - 1))
    text = np.append(0, rng.integers(0, n, 600))
    pairs = np.zeros((n, n))
    np.add.at(pairs, (text, np.append(text[1:], 0)), 1)

    def of(own):
        member = np.eye(size)[own]
        between = member.T @ pairs @ member
        f = lambda x: (x * np.log(np.maximum(x, 1))).sum()
        return between, f(between) - 2 * f(between.sum(axis=1))

    between, now = of(own)
    word, codes, amounts = [], [], []
    for w in range(1, n):
        beside = np.zeros(2 * size + 1)
        others = np.arange(n) != w
        np.add.at(beside, own[others], pairs[others, w])
        np.add.at(beside, size + own[others], pairs[w, others])
        beside[2 * size] = pairs[w, w]
        found = np.flatnonzero(beside)
        word += [w - 1] * len(found)
        codes += found.tolist()
        amounts += beside[found].tolist()
    word, codes, amounts = np.array(word), np.array(codes), np.array(amounts)
    mover = brown.Mover(between, classes)
    gains = mover.gains(own[1:], word, codes, amounts)
    best = mover.move(own[1:], word, codes, amounts)
    for w in range(1, n):
        expected = [of(np.where(np.arange(n) == w, c, own))[1] for c in range(1, classes + 1)]
        assert np.allclose(np.diff(gains[w - 1]), np.diff(expected))
        assert expected[best[w - 1] - 1] >= max(expected) - 1e-6


def test_words_below_the_head_get_classes_by_their_neighbours(spark):
    rows, kinds = [], {"a": "go left", "b": "turn right"}
    for i in range(4 * 300):
        rows += [(2 * i + j, f"{kinds[k]} {k}{i % 300}") for j, k in enumerate(kinds)]
    rows = [(i, t) for i, t in rows if not held_out(i, 7, 2)]
    usual, crossed = ([f"go left {k}{n}" for n in range(300)] for k in kinds)

    def scores(texts):
        docs = documents(spark, rows + [(None, t) for t in texts])
        return [r.score for r in brown.score_texts(docs, 4, 4).collect() if r.doc_id is None]

    assert min(scores(usual)) - max(scores(crossed)) > 1
    assert brown.class_number(10**6) > brown.class_number(10**5) > brown.CLASSES


def test_probabilities_of_the_next_token_add_up():
    counts = np.array([[3, 5, 0], [2, 0, 9], [0, 1, 1]])
    assert np.allclose((10.0 ** brown.transitions(counts)).sum(axis=1), 1.0)
    vocabulary = brown.Vocabulary(
        np.array([0, 11, 21], np.uint64), np.array([4, 9, 8]),
        np.bincount([2, 3, 3, 0, 1], [4, 9, 8, 5, 6], 64).astype(np.int64),
        np.bincount([2, 3, 3, 0, 0, 0, 0, 0, 1, 1, 1], minlength=64),
    )
    pairs = np.ones((4, 4), np.int64)
    model = brown.word_classes(vocabulary, pairs, 2)
    hashes = np.array([0, 11, 21, *range(31, 39), 99], np.uint64)
    classes, emission = model.describe(hashes, np.array([4, 9, 8, 1, 1, 1, 1, 1, 2, 2, 2, 0]))
    sums = np.bincount(classes, 10.0**emission)
    assert np.allclose(sums[sums > 0], 1.0)


def test_tokens_are_read_alike_in_any_portions():
    from xxhash import xxh64_intdigest

    texts = ["a B  a", "", " \t\n", "é\x1cx É", "\x00 \x0b\x0c\r", "end"]
    data = [t.encode() for t in texts]
    words = [[w for w in re.findall(rb"[^\x20\x09-\x0D]+", t.lower())] for t in data]
    for size in (1, 6, 1 << 20):
        brown.READ_BYTES, before = size, brown.READ_BYTES
        try:
            found = list(brown.read_tokens(data))
        finally:
            brown.READ_BYTES = before
        hashes = [h for tokens in found for h in tokens.words[tokens.at].tolist()]
        assert hashes == [h for own in words for h in [*(xxh64_intdigest(w) | 1 for w in own), brown.END_WORD]]
        assert [n for tokens in found for n in tokens.each.tolist()] == [len(own) + 1 for own in words]


def test_gains_are_those_of_one_word_at_a_time():
    rng = np.random.default_rng(4)
    classes, size = 6, 9
    pairs = rng.integers(0, 50, (size, size))
    mover = brown.Mover(pairs, classes)
    entries = np.unique(rng.integers(0, 400 * 2 * size, 3_000))
    word, codes = entries // (2 * size), entries % (2 * size)
    amounts = rng.integers(1, 14, len(entries)).astype(float)
    total = np.zeros((400, classes))
    for steps in (0, 3, 100):
        mover.STEPS = steps
        gain = np.zeros((400, classes))
        mover.add_rises(gain, word, codes, amounts)
        if not steps:
            for w, c, n in zip(word, codes, amounts):
                total[w] += mover.f(mover.met[c] + n) - mover.f(mover.met[c])
        assert np.allclose(gain, total, rtol=1e-12, atol=1e-9)


def test_fit_learns_from_every_document(spark):
    rows = [(i, f"mail u{i}@m{i % 7}.example.org or call +1 (415) 555-{1000 + i}") for i in range(900)]
    rows += [(2000, "x " * 20_000 + "see 10.1.2.3 and 4111 1111 1111 1111"), (None, "a@b.org")]
    made_up = [with_kind for kind in pii.KINDS for with_kind in
               (pii.with_made_up([], kind, number) for number in range(pii.PRIOR))]
    wanted = sum(1 for _, text in rows[:-1] for _ in pii.examples(text))
    wanted += sum(1 for text in made_up for _ in pii.examples(text))
    assert pii.fit(documents(spark, rows)).examples == wanted
