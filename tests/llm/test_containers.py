import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loamline.llm.containers import VOCABULARY, count_tokens, encoder, fill, measure, pack


def check(sizes, capacity):
    bins = fill(sizes, capacity)
    pieces = {}
    for b in bins:
        assert sum(n for _, _, n in b) <= capacity
        assert sum(n * 3 > capacity for _, _, n in b) <= 2 or all(n * 3 <= capacity for _, _, n in b)
        for i, piece, n in b:
            pieces.setdefault(i, []).append((piece, n))
    assert set(pieces) == set(range(len(sizes)))
    for i, n in enumerate(sizes):
        own = sorted(pieces[i])
        assert sum(x for _, x in own) == n and [p for p, _ in own] == list(range(len(own)))
        assert len(own) == max(1, -(-n // capacity))
    return bins


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 70), max_size=60), st.integers(1, 30))
def test_every_item_lies_whole_in_one_container_unless_it_is_larger(sizes, capacity):
    check(sizes, capacity)


def test_large_items_are_matched_and_gaps_are_filled():
    assert len(check([60, 40, 55, 45, 20, 20, 20, 20, 20], 100)) == 3
    bins = check([70, 30, 10, 20], 100)
    assert len(bins) == 2 or len(bins) == 1 + (130 > 100)


def test_little_room_is_left():
    rng = random.Random(1)
    sizes = [int(rng.lognormvariate(5.5, 1)) + 1 for _ in range(5000)]
    bins = check(sizes, 4096)
    assert sum(sizes) / (len(bins) * 4096) > 0.99


def test_pack_over_shards(spark):
    rows = [(k, (k * 37) % 90) for k in range(400)] + [(5000, 250), (5000, 250), (None, 3), (None, 3), (5001, None)]
    out = pack(spark.createDataFrame(rows, "doc_id bigint, size bigint"), capacity=100, shard_rows=50).collect()
    assert len({x["shard"] for x in out}) > 1
    assert sorted(x["piece"] for x in out if x["doc_id"] == 5000) == [0, 1, 2] and {x["n_pieces"] for x in out if x["doc_id"] == 5000} == {3}
    assert sum(x["doc_id"] is None for x in out) == 2
    assert [x["tokens"] for x in out if x["doc_id"] == 5001] == [0]
    full = {}
    for x in out:
        full[x["shard"], x["container"]] = full.get((x["shard"], x["container"]), 0) + x["tokens"]
    assert max(full.values()) <= 100
    assert {x["doc_id"] for x in out} == {r[0] for r in rows}


def test_measure(spark):
    docs = spark.createDataFrame([("a", "one two three", 1), ("b", None, 2), ("c", "", 3), ("d", "日本語のテキスト <|endoftext|>", 4)], "doc_id string, text string, size int")
    sizes = {x["doc_id"]: x["size"] for x in measure(docs).collect()}
    assert sizes["a"] == 3 and sizes["b"] == sizes["c"] == 0 and sizes["d"] > 5
    assert pack(measure(docs.limit(0))).count() == 0


def test_very_long_texts():
    enc = encoder(VOCABULARY)
    assert count_tokens(" " * 1_000_000, enc) > 0
    assert count_tokens("ab " * 300_000, enc) >= 300_000
    assert count_tokens("a" * 50_000, enc) > 0
    # The count doesn't depend on what stands around a run of blanks.
    assert count_tokens("one" + " " * 2_000_000 + "two", enc) == count_tokens("one", enc) + 200 * count_tokens(" " * 10_000, enc) + count_tokens("two", enc)


def test_other_scripts_are_not_inflated():
    russian = "Проверьте настройки маршрутизатора и перезапустите устройство, прежде чем обращаться в поддержку. " * 20
    assert count_tokens(russian, encoder(VOCABULARY)) < 0.4 * len(russian)


def test_fill_is_near_the_bound():
    rng = random.Random(4)
    for sizes in ([rng.randint(1, 9000) for _ in range(3000)], [rng.randint(1, 1300) for _ in range(3000)], [rng.randint(1500, 2500) for _ in range(3000)]):
        bins = check(sizes, 4096)
        least = max(-(-sum(sizes) // 4096), sum(n > 2048 for n in sizes), -(-sum(n * 3 > 4096 for n in sizes) // 2))
        assert len(bins) <= 1.02 * least + 2


def test_capacity_must_be_positive(spark):
    with pytest.raises(ValueError):
        pack(spark.createDataFrame([(1, 1)], "doc_id bigint, size bigint"), capacity=0)
