import random

import numpy as np
import pytest

from loamline.llm.common import words
from loamline.llm.neardups import BKForest, NearDuplicates, components, minima, odd_sketches, runs_of, search

DOCS = "rec_id bigint, text string, rep string, shard int, same string"


def frame(spark, docs):
    return spark.createDataFrame([(*d, "x", 1, "y") for d in docs], DOCS)


def brute(docs, similarity, n=3, least=40):
    sets = {}
    for d, t in docs:
        w = words(t or "")
        s = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
        if len(s) >= least and d is not None:
            sets[d] = s
    ids = sorted(sets)
    return {(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b])}


def corpus(n=120, seed=3):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)]
    docs = []
    for d in range(n):
        base = words(rng.choice(docs)[1]) if docs and rng.random() < 0.6 else rng.choices(vocab, k=rng.randint(45, 160))
        for _ in range(rng.randint(0, 6)):
            at = rng.randrange(len(base))
            base[at : at + rng.randint(0, 2)] = rng.choices(vocab, k=rng.randint(0, 2))
        docs.append((d, " ".join(base).title() + "."))
    return docs


def test_pairs_against_brute_force(spark):
    docs = corpus() + [(900, None), (901, " "), (902, "too short"), (None, "x " * 90)]
    docs += docs[:5]  # delivered twice
    expected = brute(docs, 0.6)
    assert len(expected) > 20
    assert {tuple(x) for x in NearDuplicates(frame(spark, docs)).pairs().collect()} == expected


def test_large_shards_are_searched_block_by_block(spark):
    rng = random.Random(5)
    base = [f"w{k}" for k in range(150)]
    docs = []
    for d in range(60):
        own = list(base)
        own[rng.randrange(150)] = f"v{d}"
        docs.append((d, " ".join(own)))
    expected = brute(docs, 0.6)
    assert len(expected) == 60 * 59 // 2
    assert {tuple(x) for x in NearDuplicates(frame(spark, docs), block_rows=7).pairs().collect()} == expected


def test_copies_enter_once_and_groups_name_their_smallest_id(spark):
    text = " ".join(f"w{k}" for k in range(80))
    edited = text.replace("w40", "v40")
    docs = [(5, text), (3, text.upper()), (9, edited), (7, " ".join(f"u{k}" for k in range(80)))]
    search = NearDuplicates(frame(spark, docs))
    assert [tuple(x)[:2] for x in search.links().collect()] == [(3, 9)]
    assert sorted((x["rec_id"], x["group_id"], x["links"], x["copies"]) for x in search.groups().collect()) == [(3, 3, 1, 2), (5, 3, 1, 2), (7, 7, 0, 1), (9, 3, 1, 1)]


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(50)] + [(100, k) for k in range(101, 130)]
    random.Random(2).shuffle(edges)
    labels = {x["node"]: x["label"] for x in components(spark.createDataFrame(edges, "x bigint, y bigint")).collect()}
    assert labels == {k: 0 for k in range(51)} | {k: 100 for k in range(100, 130)}
    assert components(spark.createDataFrame([], "x bigint, y bigint")).count() == 0


def test_groups_give_a_row_for_each_record(spark):
    docs = [(1, None), (2, ""), (3, "Yes, sir."), (4, "yes sir"), (5, "no"), (5, "no"), (None, "no")]
    got = sorted(tuple(x) for x in NearDuplicates(frame(spark, docs), similarity=0.8, run_words=5, min_runs=1).groups().collect())
    assert got == [(1, 1, 0, 1), (2, 2, 0, 1), (3, 3, 0, 2), (4, 3, 0, 2), (5, 5, 0, 1)]


def test_bk_forest_finds_what_a_scan_finds():
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 1 << 63, (300, 4)).astype(np.uint64)
    prints[150:] = prints[:150] ^ (rng.integers(0, 1 << 63, (150, 4)) & rng.integers(0, 1 << 63, (150, 4)) & rng.integers(0, 1 << 63, (150, 4))).astype(np.uint64)
    prints[7] = prints[3]
    root = np.where(np.arange(300) < 200, 0, 200)  # two trees
    forest = BKForest(prints, root, np.full(300, 256))
    asked = np.arange(0, 300, 7)
    q, at, d, visited = forest.within(prints[asked], root[asked], np.full(len(asked), 60), np.full(len(asked), 256))
    assert visited <= len(asked) * 200
    for k, a in enumerate(asked):
        far = np.bitwise_count(prints ^ prints[a]).sum(axis=1)
        assert sorted(at[q == k]) == np.flatnonzero((far <= 60) & (root == root[a])).tolist()
    # The tree is the one that putting rows in one after another gives.
    children = [{} for _ in range(200)]
    for k in range(1, 200):
        node = 0
        while (e := int(np.bitwise_count(prints[node] ^ prints[k]).sum())) in children[node]:
            node = children[node][e]
        children[node][e] = k
    assert {(int(k) // forest.span, int(k) % forest.span, int(c)) for k, c in zip(forest.keys, forest.children) if c < 200} == {(p, e, c) for p, es in enumerate(children) for e, c in es.items()}


def test_distance_of_sketches_is_never_more_than_the_runs_apart():
    rng = np.random.default_rng(4)
    for n, other in ((50, 50), (300, 40), (5000, 5000)):
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.r_[a[: n // 2], rng.integers(0, 1 << 63, other).astype(np.uint64)])
        two = odd_sketches(np.r_[a, b], np.repeat([0, 1], [len(a), len(b)]), 2, 1024)
        assert np.bitwise_count(two[0] ^ two[1]).sum() <= len(np.setxor1d(a, b))


@pytest.mark.parametrize("most, part, false", [(400, 0.35, 0), (1500, 0.3, 0), (4000, 0.35, 100)])
def test_trees_prune_records_of_other_sizes(most, part, false):
    """2,000 unrelated records of 40 runs and more in one shard: a part of the nodes is visited.

    Sketches of some thousands of runs are nearly full, so a few of the 2 million pairs are false candidates for the exact check.
    """
    rng = np.random.default_rng(6)
    sizes = np.sort(np.exp(rng.uniform(np.log(40), np.log(most), 2000)).astype(np.int64))
    runs = rng.integers(0, 1 << 63, int(sizes.sum())).astype(np.uint64)
    prints = odd_sketches(runs, np.repeat(np.arange(2000), sizes), 2000, 4096)
    left, _, visited = search(prints, sizes, np.zeros(2000, np.int64), np.zeros(2000, bool), 0.6)
    assert len(left) <= false and visited < part * 2000 * 2000


def test_very_long_and_empty(spark):
    rng = random.Random(1)
    long = " ".join(f"w{rng.randrange(10**6)}" for _ in range(200_000))
    docs = [(1, long), (2, long + " end"), (3, "x")]
    assert [tuple(x) for x in NearDuplicates(frame(spark, docs)).pairs().collect()] == [(1, 2)]
    assert NearDuplicates(frame(spark, docs).limit(0)).pairs().count() == 0
    assert NearDuplicates(frame(spark, docs).limit(0)).groups().count() == 0
    runs, ends = runs_of([words(long), [], words("a b"), words("a b c a b c")], 3)
    assert ends.tolist() == [ends[0], ends[0], ends[0], ends[0] + 3] and minima(runs, np.array([0, ends[0]]), 64, 1).shape == (64, 2)


def test_beyond_the_size_for_a_broadcast_joins_do_it(spark, monkeypatch):
    from loamline.llm import common, neardups

    docs = corpus(60, 8)
    monkeypatch.setattr(neardups, "small", lambda df: common.small(df, 3))
    assert {tuple(x) for x in NearDuplicates(frame(spark, docs)).pairs().collect()} == brute(docs, 0.6)
