import pytest

from loamline.llm.blending import blend_mix, blend_plan, blend_records, blend_shares

BLEND = "name string, path string, subset string, weight double, block int, rate double"
RECORDS = "record_id bigint, path string, subset string, n_tokens bigint, place string, name string"


def tables(spark, blend, records):
    return (
        spark.createDataFrame([(*b, 1, 1.0) for b in blend], BLEND),  # columns of the operator's own names
        spark.createDataFrame([(*r, "x", "y") for r in records], RECORDS),
    )


def test_places_agree_but_for_case_blanks_and_slashes(spark):
    b, r = tables(spark, [("a", " HF://X/Y/ ", None, 1.0), ("b", "hf://x/z", "S", 1.0)], [(1, "hf://x/y", "", 5), (2, "hf://X/Y//", None, 5), (3, "hf://x/z", "s ", 5), (4, "hf://x/y", "s", 5), (5, None, "s", 5)])
    assert sorted(map(tuple, blend_records(b, r).collect())) == [("a", 1, 5), ("a", 2, 5), ("b", 3, 5)]


def test_plan_counts_rows_once_and_skips_what_does_not_count(spark):
    b, r = tables(
        spark,
        [("big", "p", None, 1.0), ("big", "p", None, 1.0), ("small", "q", None, 9.0), ("gone", "r", None, 0.0), ("none", "s", None, None), ("nan", "t", None, float("nan")), ("bare", "u", None, 2.0)],
        [(1, "p", None, 60), (1, "p", None, 60), (2, "p", None, 30), (3, "q", None, 10), (4, "q", None, None), (5, "q", None, -3), (6, "r", None, 99)],
    )
    plan = {x["name"]: x for x in blend_plan(b, r).collect()}
    assert set(plan) == {"big", "small", "bare"}
    assert (plan["big"]["tokens"], plan["small"]["tokens"], plan["bare"]["tokens"]) == (90, 10, 0)
    assert plan["small"]["over_cap"] and plan["small"]["rate"] == 4.0  # wants 75 tokens and has 10
    assert plan["bare"]["over_cap"] and plan["bare"]["rate"] is None
    assert not plan["big"]["over_cap"] and plan["big"]["rate"] == pytest.approx(100 / 12 / 90)


@pytest.mark.parametrize("block_rows", [7, 100_000])
def test_systematic_sampling_gives_rate_times_rows(spark, block_rows):
    records = [(k, "p", None, 1 + k % 5) for k in range(500)] + [(1000 + k, "q", None, 3) for k in range(40)]
    b, r = tables(spark, [("a", "p", None, 0.55), ("b", "q", None, 0.45)], records)
    plan = {x["name"]: x for x in blend_plan(b, r).collect()}
    mix = blend_mix(b, r, block_rows=block_rows).collect()
    for name in plan:
        rows = [x for x in mix if x["name"] == name]
        assert abs(len(rows) - plan[name]["rate"] * plan[name]["n_records"]) <= 1
        copies = {}
        for x in rows:
            copies[x["record_id"]] = max(copies.get(x["record_id"], 0), x["copy"])
        assert max(copies.values()) <= -(-plan[name]["rate"] // 1) <= 4
        assert sum(copies.values()) == len(rows)  # copies are numbered without gaps
    assert mix and sorted(map(tuple, mix)) == sorted(map(tuple, blend_mix(b, r, block_rows=block_rows).collect()))


def test_shares_are_those_of_the_mix(spark):
    b, r = tables(spark, [("a", "p", None, 1.0), ("b", "q", None, 1.0), ("c", "z", None, 1.0)], [(k, "pq"[k % 2], None, 10) for k in range(200)])
    shares = {x["name"]: x for x in blend_shares(b, r).collect()}
    assert shares["a"]["share"] == pytest.approx(0.5, abs=0.01) and shares["c"]["share"] == 0 and shares["c"]["over_cap"]


def test_empty_tables(spark):
    b, r = tables(spark, [("a", "p", None, 1.0)], [(1, "p", None, 10)])
    assert blend_mix(b.limit(0), r).count() == 0 and blend_plan(b.limit(0), r).count() == 0
    assert blend_mix(b, r.limit(0)).count() == 0
    assert [x["share"] for x in blend_shares(b, r.limit(0)).collect()] == [0.0]


def test_null_ids_stay(spark):
    b, r = tables(spark, [("a", "p", None, 1.0)], [(None, "p", None, 10), (None, "p", None, 10)])
    assert blend_records(b, r).count() == 2 and blend_mix(b, r).count() == 2


def test_refill_gives_what_capped_sources_lack(spark):
    sizes = {"a": 10, "b": 40, "c": 300, "d": 650}
    blend, records = [(n, n, None, w) for n, w in zip("abcd", (4.0, 3.0, 2.0, 1.0))], [(1000 * k + j, n, None, 1) for k, n in enumerate(sizes) for j in range(sizes[n])]
    b, r = tables(spark, blend, records)
    plan = {x["name"]: x["rate"] * x["tokens"] for x in blend_plan(b, r, refill=True).collect()}
    # a and b run out at 40 and 160 tokens; the other 800 go to c and d as 2 to 1.
    assert plan == pytest.approx({"a": 40, "b": 160, "c": 800 * 2 / 3, "d": 800 / 3})
    shares = {x["name"]: x for x in blend_shares(b, r, refill=True).collect()}
    assert sum(x["tokens"] for x in shares.values()) == pytest.approx(1000, abs=3)
    assert {n for n, x in shares.items() if x["over_cap"]} == {"a", "b"} == {x["name"] for x in blend_plan(b, r).where("over_cap").collect()}
    # All run out: everything comes as often as it may.
    b, r = tables(spark, [("a", "a", None, 1.0), ("b", "b", None, 1.0)], [(1, "a", None, 5), (2, "c", None, 5)])
    assert {x["name"]: x["rate"] for x in blend_plan(b, r, refill=True).collect()} == {"a": 1.0, "b": None}


def test_shortfall_is_read_from_what_was_drawn(spark):
    b, r = tables(spark, [("a", "a", None, 4.0), ("b", "b", None, 6.0)], [(k, "a", None, 10) for k in range(10)] + [(100 + k, "b", None, 10) for k in range(90)])
    got = {x["name"]: x for x in blend_shares(b, r).collect()}
    assert not got["a"]["over_cap"] and got["a"]["emitted"] == 40 and got["a"]["tokens"] == 400  # exactly at the cap
