import random

import numpy as np
import pytest

from loamline.llm.spans import SharedSpans, _least, kmers, shared_spans, starts_of_tokens

DOCS = "rec_id bigint, text string, rep string, h bigint, off int"


def frame(spark, docs):
    return spark.createDataFrame([(*d, "x", 1, 2) for d in docs], DOCS)


def brute(docs, n):
    texts = {d: t for d, t in docs if t and d is not None}
    where = {}
    for d, t in texts.items():
        for k in range(len(t) - n + 1):
            where.setdefault(t[k : k + n], set()).add(d)
    return {(a, b) for s in where.values() for a in s for b in s if a < b}


def corpus(seed):
    rng = random.Random(seed)
    alphabets = ["abcdefghij  ,.\n", "0123456789abcdefABCDEF+/", "漢字仮名交文日本語、。", "aab "]

    def text(n):
        a = rng.choice(alphabets)
        return "".join(rng.choice(a) for _ in range(n))

    docs = []
    for d in range(60):
        t = text(rng.randint(50, 900))
        if docs and rng.random() < 0.7:
            other = rng.choice(docs)[1]
            at = rng.randint(0, len(other))
            t = t[: rng.randint(0, len(t))] + other[at : at + rng.choice([399, 400, 401, 380, 500])] + t[rng.randint(0, len(t)) :]
        docs.append((d, t))
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_pairs_against_brute_force(spark, seed):
    docs = corpus(seed)
    docs += docs[:3] + [(800, None), (801, ""), (802, docs[0][1]), (None, docs[1][1])]
    expected = brute(docs, 400)
    assert len(expected) > 4
    assert {tuple(x) for x in SharedSpans(frame(spark, docs)).pairs().collect()} == expected


def test_text_that_repeats_itself(spark):
    block = "the quick brown fox jumps over the lazy dog, again. "
    a, b, c = block * 40, "x " + block * 12 + " y", block[5:] * 3 + "z"
    expected = brute([(1, a), (2, b), (3, c)], 400)
    assert expected == {(1, 2)}
    assert {tuple(x) for x in SharedSpans(frame(spark, [(1, a), (2, b), (3, c)])).pairs().collect()} == expected
    assert SharedSpans(frame(spark, [(1, a)])).pairs().count() == 0


@pytest.mark.parametrize("lengths", [(300, 500, 300), (300, 300, 450, 300, 300)])
def test_long_stretch_between_short_ones_of_a_diagonal(spark, lengths):
    rng = random.Random(7)
    parts = ["".join(rng.choice("abcdefghij  ,.") for _ in range(n)) for n in lengths]
    docs = [(1, "0".join(parts)), (2, "1".join(parts))]
    assert brute(docs, 400) == {(1, 2)}
    assert [tuple(x) for x in SharedSpans(frame(spark, docs)).pairs().collect()] == [(1, 2)]


def test_shares(spark):
    rng = random.Random(3)
    part = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    one, two = part(500), part(450)
    docs = [(1, part(100) + "#" + one + "#" + part(50)), (2, "%" + one + "%" + part(30) + "%" + two + "%"), (3, part(70) + "&" + two + "&"), (4, part(600)), (5, "short"), (7, part(420)), (8, "")]
    docs.append((9, docs[5][1]))
    shares = {x["rec_id"]: x for x in SharedSpans(frame(spark, docs)).shares().collect()}
    assert (shares[1]["shared_chars"], shares[2]["shared_chars"], shares[3]["shared_chars"], shares[4]["shared_chars"]) == (500, 950, 450, 0)
    assert shares[7]["shared"] == 1.0 and shares[9]["text_class"] == 7 and 5 not in shares


def test_paths_are_compacted(spark):
    rng = random.Random(9)
    body = "".join(rng.choice("abcdefgh ") for _ in range(4000))
    docs = [(1, "1" + body + "1"), (2, "2 " + body + "2"), (3, "3  " + body[:2000])]
    search = SharedSpans(frame(spark, docs))
    _, nodes = search.graph()
    paths = search.paths().collect()
    assert sum(x["kmers"] for x in paths) == nodes.count() and len(paths) < 8 and max(x["kmers"] for x in paths) > 20


def test_empty_and_very_long(spark):
    assert SharedSpans(frame(spark, [(1, "x")]).limit(0)).pairs().count() == 0
    assert SharedSpans(frame(spark, [(1, "x")]).limit(0)).shares().count() == 0
    rng = random.Random(2)
    long = "".join(rng.choice("abcdefghijk ") for _ in range(600_000))
    assert [tuple(x) for x in SharedSpans(frame(spark, [(1, long), (2, "q" + long[300_000:300_400])])).pairs().collect()] == [(1, 2)]


def test_kmers_of_a_shared_span_meet():
    rng = random.Random(1)
    size, window = 176, 160
    for alphabet in ("abc def ", "0123456789ABCDEFabcdef", "漢字、仮名", "a", "abcdefghijklmnop qrstuvwxyzabcdef"):
        for _ in range(30):
            mid = "".join(rng.choice(alphabet) for _ in range(400))
            a = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 200))) + mid + "".join(rng.choice(alphabet) for _ in range(100))
            b = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 200))) + mid
            row, off, h = kmers([a, "", b], size, window)
            assert set(h[row == 0].tolist()) & set(h[row == 2].tolist()) and not (row == 1).any()
            for r, t in ((0, a), (2, b)):  # a text beside others gives what it gives alone
                alone = kmers([t], size, window)
                assert off[row == r].tolist() == alone[1].tolist() and h[row == r].tolist() == alone[2].tolist()
                assert (np.diff(alone[1]) <= size).all()  # a k-mer reaches the next one
    assert starts_of_tokens(np.frombuffer("ab, c".encode("utf-32-le"), np.uint32)).tolist() == [0, 2, 3, 4]
    assert SharedSpans.__doc__


def test_least_is_the_first_smallest():
    rng = np.random.default_rng(3)
    h = rng.integers(0, 9, 300).astype(np.uint64)
    counts = np.minimum(rng.integers(1, 40, 300), 300 - np.arange(300))
    assert _least(h, counts).tolist() == [k + int(h[k : k + n].argmin()) for k, n in enumerate(counts.tolist())]


def test_whole_spans(spark):
    rng = random.Random(11)
    part = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    one, two = part(900), part(400)
    docs = [(1, "(" + one + ")" + part(300) + "[" + two + "]"), (2, "<" + two + ">" + part(50) + "{" + one + "}")]
    got = {(x["start_x"], x["start_y"], x["chars"]) for x in SharedSpans(frame(spark, docs)).spans().collect()}
    assert got == {(1, docs[1][1].index(one), 900), (docs[0][1].index(two), 1, 400)}


def test_spans_of_two_texts():
    a, b = "x" * 10 + "common part" * 40, "yy" + "common part" * 40 + "zz"
    assert (10, 2, 440) in shared_spans(a, b, [(30, 22)], 400)


def test_shares_against_brute_force(spark):
    docs = [d for d in corpus(7) if d[1]]
    texts = dict(docs)
    where = {}
    for d, t in docs:
        for k in range(len(t) - 399):
            where.setdefault(t[k : k + 400], set()).add(t)
    got = {x["rec_id"]: x["shared_chars"] for x in SharedSpans(frame(spark, docs)).shares().collect()}
    for d, t in texts.items():
        covered = set()
        for k in range(len(t) - 399):
            if len(where[t[k : k + 400]]) > 1:
                covered.update(range(k, k + 400))
        if len(t) >= 400 and sum(x == t for x in texts.values()) == 1:
            assert got[d] == len(covered)
    assert any(got.values())
