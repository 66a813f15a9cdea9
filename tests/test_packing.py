import random

from hypothesis import given, settings
from hypothesis import strategies as st

from loamline.operators.packing import assign_bins, first_fit_decreasing, first_fit_shuffled, next_fit, packed_rows, rejoin


def groups(own):
    out = {}
    for i, b in enumerate(own):
        out.setdefault(b, []).append(i)
    return [out[b] for b in sorted(out)]


def test_worked_examples():
    assert groups(first_fit_decreasing([6, 5, 4, 3, 2], 10)) == [[0, 2], [1, 3, 4]]
    assert groups(next_fit([6, 5, 4, 3, 2], 10)) == [[0], [1, 2], [3, 4]]
    assert first_fit_decreasing([9], 4) == [0] and first_fit_decreasing([], 4) == []


def plain_first_fit(order, lengths, capacity):
    room, own = [], [0] * len(lengths)
    for i in order:
        n = min(lengths[i], capacity)
        b = next((b for b, r in enumerate(room) if r >= n), None)
        if b is None:
            room.append(capacity)
            b = len(room) - 1
        room[b] -= n
        own[i] = b
    return own


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=50), st.integers(1, 15))
def test_first_fit_is_first_fit(lengths, capacity):
    order = sorted(range(len(lengths)), key=lambda i: -min(lengths[i], capacity))
    assert first_fit_decreasing(lengths, capacity) == plain_first_fit(order, lengths, capacity)
    random.Random(5).shuffle(mixed := list(range(len(lengths))))
    assert first_fit_shuffled(lengths, capacity, 5) == plain_first_fit(mixed, lengths, capacity)


def test_bins_over_shards(spark):
    rows = [(k % 3, k, (k * 7) % 40 + 1) for k in range(200)]
    out = assign_bins(spark.createDataFrame(rows, "s int, k bigint, n int"), "s", "k", "n", 32, shard_rows=30).collect()
    assert len(out) == 200
    load = {}
    for r in out:
        load[r["s"], r["part"], r["bin"]] = load.get((r["s"], r["part"], r["bin"]), 0) + r["n"]
    assert max(load.values()) <= 32 and len({r["part"] for r in out}) > 1


def test_packed_rows_shift_masks_and_cut(spark):
    seqs = spark.createDataFrame([(0, 1, [1, 2, 3], [0, 1, 1]), (0, 2, [4, 5], [1, 1]), (0, 3, [6], [1]), (0, 4, list(range(9)), [1] * 9)], "s int, k int, t array<int>, m array<tinyint>")
    bins = spark.createDataFrame([(0, 1, 0, 0), (0, 2, 0, 0), (0, 3, 0, 0), (0, 4, 0, 1)], "s int, k int, part int, bin int")
    rows = {r["bin"]: r for r in packed_rows(seqs, bins, "s", "k", "t", "m", 6).collect()}
    assert rows[0]["input_ids"] == [1, 2, 3, 4, 5, 6] and rows[0]["loss_mask"] == [1, 1, 0, 1, 0, 0] and rows[0]["seq_start_id"] == [0, 3, 5]
    assert rows[1]["input_ids"] == [0, 1, 2, 3, 4, 5]


def test_rejoin(spark):
    df = spark.createDataFrame([("a", 0, "x", 2), ("a", 1, "y", 2), ("a", 2, "z", 9), ("a", 3, "w", 1), ("b", 0, None, 1)], "o string, p int, t string, n int")
    assert sorted(tuple(r) for r in rejoin(df, "o", "p", "t", "n", 4).collect()) == [("a", 0, "x\ny", 4), ("a", 1, "z", 9), ("a", 2, "w", 1)]
    assert sorted(r["text"] for r in rejoin(df, "o", "p", "t", "n", 4, alone=False).collect()) == ["w", "x\ny"]
