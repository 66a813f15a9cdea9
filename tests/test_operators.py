import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamline.functions import text as T
from loamline.functions.tokens import tokenize, tokenizer
from loamline.operators import dedup, joins, runs, splits, synthesis
from loamline.operators.aggregates import weighted_percentiles
from loamline.operators.ann import HyperplaneIndex
from loamline.operators.graph import components
from loamline.operators.scoring import domains, language_score, repaired
from loamline.plans.q_joins import top_k
from loamline.tables import load


def values(df, column):
    return [r[column] for r in df.collect()]


def test_windows_and_chunks(spark):
    df = spark.createDataFrame([("abcdefghij",), ("ab",), ("abcdefgh",)], "t string")
    made = values(df.select(T.windows_of(F.col("t"), 4).alias("w")), "w")
    assert [[tuple(x)[1:] for x in w] for w in made] == [[("abcd", 0, 4), ("efghij", 4, 10)], [("ab", 0, 4)], [("abcd", 0, 4), ("efgh", 4, 8)]]
    assert values(df.select(T.chunks_of(F.col("t"), 4, 1).alias("w")), "w") == [["abcd", "defg", "ghij"], ["ab"], ["abcd", "defg", "gh"]]
    with pytest.raises(ValueError):
        T.chunks_of(F.col("t"), 4, 4)


def test_text_functions(spark):
    df = spark.createDataFrame([("# Head\n**bold** [a](b) `c`\n* item", 'x: "quoted"', '```json\n{"a": {"b": 1}}\n``` rest')], "m string, q string, j string")
    row = df.select(T.without_markdown(F.col("m")).alias("m"), T.without_lines(F.col("m"), r"^\*").alias("l"), T.after(F.col("q"), "x:").alias("a"), T.without_quotes(T.after(F.col("q"), "x:")).alias("q"), T.json_part(F.col("j")).alias("j")).first()
    assert row["m"] == "Head\nbold a c\n* item" and row["l"] == "# Head" and row["a"] == '"quoted"' and row["q"] == "quoted" and row["j"] == '{"a": {"b": 1}}'


def test_weighted_percentiles(spark):
    df = spark.createDataFrame([(0.1, 10), (0.2, 20), (0.3, 30), (0.4, 40), (None, 5), (0.9, None)], "v double, w bigint")
    got = {r["p"]: r["threshold"] for r in weighted_percentiles(df, "v", "w", list(range(5, 100, 5))).collect()}
    assert [got[p] for p in (5, 10, 15, 30, 35, 60, 65, 95)] == [0.1, 0.1, 0.2, 0.2, 0.3, 0.3, 0.4, 0.4]
    rng = random.Random(1)
    rows = [(float(rng.randrange(500)), rng.randrange(1, 50)) for _ in range(4000)]
    got = {r["p"]: r["threshold"] for r in weighted_percentiles(spark.createDataFrame(rows, "v double, w bigint"), "v", "w", [1, 25, 50, 99]).collect()}
    total = sum(w for _, w in rows)
    for p, t in got.items():
        upto = lambda x: sum(w for v, w in rows if v <= x)
        assert upto(t) * 100 >= p * total > upto(t - 1) * 100


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 120)]
    random.Random(2).shuffle(edges)
    assert {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "x bigint, y bigint")).collect()} == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 120)}
    assert components(spark.createDataFrame([], "x bigint, y bigint")).count() == 0


def test_fuzzy_groups_find_near_copies(spark):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa"]) + str(rng.randrange(1000)) for _ in range(n))
    docs = []
    for k in range(30):
        t = text(120)
        docs += [(k, t), (100 + k, t + " end"), (200 + k, text(120))]
    docs += [(500, None), (501, "short"), (None, "x" * 50)]
    groups = {r["doc_id"]: r["group"] for r in dedup.fuzzy_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"), "doc_id", "text").collect()}
    assert groups == {k: k for k in range(30)} | {100 + k: k for k in range(30)}


def test_fuzzy_groups_keep_short_texts_apart(spark):
    """Pairs of 100 to 300 characters at Jaccard 0.4 to 0.6: 20 bands of 13 link 0.01 to 2.6 % of them."""
    rng = random.Random(4)
    text = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    docs = []
    for k in range(300):
        size, share = (100, 200, 300)[k % 3], rng.uniform(0.4, 0.6)
        runs = size - 23
        common = text(round(2 * runs * share / (1 + share)) + 23)
        docs += [(k, common + text(size - len(common))), (1000 + k, common + text(size - len(common)))]
    linked = dedup.fuzzy_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"), "doc_id", "text").where("doc_id <> `group`").count()
    assert linked <= 9


def test_minima_agree_as_sets_do():
    rng = np.random.default_rng(5)
    permutations = dedup._permutations(260, 42)
    for union, share in ((120, 0.5), (300, 0.7), (2000, 0.8), (50_000, 0.6)):
        agree = []
        for _ in range(20):
            u = rng.integers(0, 1 << 64, union, dtype=np.uint64)
            both, own = round(union * share), (union - round(union * share)) // 2
            a, b = dedup._minima(u[: both + own], permutations), dedup._minima(np.r_[u[:both], u[both + own :]], permutations)
            agree.append((a == b).mean())
        assert abs(np.mean(agree) - share) < 0.04


def test_repeated_ranges(spark):
    df = spark.createDataFrame([(1, list("abcdefgh")), (2, list("xxcdefyy")), (3, list("ab"))], "k int, w array<string>")
    ranges = dedup.repeated_ranges(df, "k", "w", 3)
    assert [tuple(r) for r in ranges.collect()] == [(2, 2, 6)]
    assert {r["k"]: "".join(r["w"]) for r in dedup.without_ranges(df, ranges, "k", "w").collect()} == {1: "abcdefgh", 2: "xxyy", 3: "ab"}


def test_index_recall(spark):
    sf = "/root/testdata/sf0.01"
    e = load(spark, sf, "embeddings")
    asked = e.where("vec_id % 100 = 0").select(F.col("vec_id").alias("q"), "embedding")
    found = {(r["q"], r["vec_id"]) for r in HyperplaneIndex(e, "vec_id", "embedding").search(asked, "q", 10).collect()}
    true = {(r["vec_id"], r["other"]) for r in top_k(spark, sf, 10).collect()}
    assert len(found & true) >= 0.9 * len(true)


def test_nearest_ties_nulls_and_parts(spark):
    rows = [(k, [1.0, float(k // 3)]) for k in range(12)] + [(99, None)]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    asked = df.where("id IN (0, 5)").withColumnRenamed("id", "q")
    for most in (50_000, 1):
        got = sorted(tuple(r) for r in joins.nearest(asked, df, "q", "id", "v", 2, most_queries=most).select("q", "id", "rank").collect())
        assert got == [(0, 1, 1), (0, 2, 2), (5, 9, 1), (5, 10, 2)]
    assert joins.nearest(asked, df.limit(0), "q", "id", "v", 2).count() == 0


def test_range_join_and_clip(spark):
    rng = random.Random(4)
    a = [(k % 3, k, s := rng.randrange(300), s + rng.randrange(1, 60)) for k in range(60)]
    b = [(k % 3, k, s := rng.randrange(300), s + rng.randrange(1, 60)) for k in range(60)]
    left = spark.createDataFrame(a, "key int, a int, start int, end int")
    right = spark.createDataFrame(b, "key int, b int, start int, end int")
    got = sorted((r["a"], r["b"]) for r in joins.range_join(left, right, "key", 16).collect())
    assert got == sorted((x[1], y[1]) for x in a for y in b if x[0] == y[0] and x[2] < y[3] and y[2] < x[3])
    one = joins.clip(spark.createDataFrame([(3, 61, 0, 112)], "s int, e int, lo int, hi int"), "s", "e", "lo", "hi", 2, 10).first()
    assert (one["clip_start"], one["clip_end"]) == (4, 60)


def test_as_of(spark):
    left = spark.createDataFrame([(1, "a", 5), (2, "a", 1), (3, "b", 9)], "id int, k string, t int")
    right = spark.createDataFrame([(7, "a", 5, 50.0), (8, "a", 3, 30.0), (9, "b", 10, 1.0)], "id int, k string, t int, v double")
    assert {r["id"]: r["v"] for r in joins.as_of(left, right, "k", "t", "v", "id").collect()} == {1: 50.0, 2: None, 3: None}


def test_mark_and_drop_with_nulls(spark):
    df, listed = spark.createDataFrame([(1,), (2,), (None,)], "k int"), spark.createDataFrame([(2,), (2,), (None,)], "k int")
    assert {r["k"]: r["listed"] for r in joins.mark_listed(df, listed, "k").collect()} == {1: False, 2: True, None: False}
    assert {r["k"] for r in joins.drop_listed(df, listed, "k").collect()} == {1, None}


def test_said_sizes():
    from loamline.functions.text import say

    units, counts = ("B", "KB", "MB", "GB", "TB", "PB"), ("", "K", "M", "B", "T")
    assert [say(n, 1024, units, "EB") for n in (268435456, 1073741824, 1500000000, 0, -2048, 2**60)] == ["256MB", "1GB", "1.4GB", "0B", "-2KB", "1.0EB"]
    assert [say(n, 1000, counts, "T") for n in (500, 1500, 1500000, 2300000000, 5600000000000)] == ["500", "1.5K", "1.5M", "2.3B", "5.6T"]


def test_runs(spark):
    assert runs.balance([("a", 5), ("b", 4), ("c", 3), ("d", 2)], 2) == {"a": 0, "b": 1, "c": 1, "d": 0}
    assert runs.balance([("b", 0), ("a", 0), ("c", 0)], 2) == {"a": 0, "b": 1, "c": 0}
    files = spark.createDataFrame([("d", "x", 70), ("d", "y", 30)], "d string, f string, n bigint")
    assert {r["f"]: r["share"] for r in runs.apportioned(files, "d", "f", "n", 5).collect()} == {"x": 4, "y": 1}
    many = [("a", f"f{k:02d}", 1) for k in range(12)] + [("a", "big", 500), ("a", "mid", 90)] + [("b", f"g{k}", 0) for k in range(3)]
    shares = {(r["d"], r["f"]): r["share"] for r in runs.apportioned(files.sparkSession.createDataFrame(many, "d string, f string, n bigint"), "d", "f", "n", 16).collect()}
    assert sum(v for (d, _), v in shares.items() if d == "a") == 16 and min(shares.values()) == 1 and shares["a", "big"] == 3 and shares["a", "mid"] == 1
    assert sorted(v for (d, _), v in shares.items() if d == "b") == [5, 5, 6]
    chain = spark.createDataFrame([(k, k - 1) for k in range(1, 30)] + [(0, 29)], "c int, p int")  # a cycle
    made = runs.made_from(chain, "c", "p").collect()
    assert len(made) == 30 * 29 and max(r["depth"] for r in made) == 29


def test_splits(spark):
    df = spark.createDataFrame([(k, k // 4) for k in range(400)], "id int, g int")
    rows = splits.group_splits(df, "g", 0.8, 0.1, seed=1).collect()
    assert len({(r["g"], r["split"]) for r in rows}) == 100 and sum(r["split"] == "train" for r in rows) == 320 and sum(r["split"] == "val" for r in rows) == 40
    pool = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "n string, w double")
    draws = splits.weighted_draws(spark.range(200), "id", pool, "n", "w", 10, seed=2).collect()
    assert len(draws) == 2000 and 0.7 < sum(r["n"] == "b" for r in draws) / 2000 < 0.8


def test_scores():
    assert synthesis.bleu_score("a b c d e", "a b c d e") == pytest.approx(100) and synthesis.bleu_score("", "a") == 0
    assert synthesis.chrf_score("abc", "abc") == pytest.approx(100) and synthesis.chrf_score("abc", "xyz") == 0
    assert synthesis.ter_score("a b c", "a x c d") == 50


@pytest.mark.parametrize("kind, name", [("tiktoken", "byte_bpe_50k.tiktoken"), ("huggingface", "byte_bpe_50k.json"), ("sentencepiece", "piece_bpe_32k.model")])
def test_tokenizers(spark, kind, name):
    path = f"/opt/tokenizers/{name}"
    assert len(tokenizer(kind, path)("Hello there, world")) >= 3
    rows = {r["id"]: r for r in tokenize(spark.createDataFrame([(1, "a b"), (2, None), (3, "")], "id int, t string"), "id", "t", kind, path, end=7).collect()}
    assert rows[1]["tokens"][-1] == 7 and rows[2]["tokens"] is None and rows[2]["error"] is None and rows[3]["tokens"] == [7]


def test_language_and_repair(spark):
    df = spark.createDataFrame([(1, "The cat and the dog had not been there for a while"), (2, "Der Hund und die Katze sind nicht da und das ist schade"), (3, None), (4, "")], "id int, t string")
    assert {r["id"]: r["l"]["code"] for r in df.select("id", language_score("t").alias("l")).collect()} == {1: "EN", 2: "DE", 3: "", 4: ""}
    odd = spark.createDataFrame([("cafÃ©",), ("plain\x00",), (None,), ("é",)], "t string")
    assert values(odd.select(repaired("t").alias("f")), "f") == ["café", "plain", None, "é"]


def test_domains(spark):
    known = spark.createDataFrame([(k, "money bank loan" if k % 2 else "cell atom gene", "bank" if k % 2 else "bio") for k in range(20)], "id int, t string, y string")
    asked = spark.createDataFrame([(1, "a loan from the bank"), (2, "gene and atom"), (3, None)], "id int, t string")
    assert {r["id"]: r["domain"] for r in domains(known, asked, "id", "t", "y").collect()} == {1: "bank", 2: "bio"}


def test_semantic_duplicates_block_by_block(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    base = rng.standard_normal((40, 8))
    v = np.concatenate([base, base[:25] + 0.02 * rng.standard_normal((25, 8)), base[:3]])
    rows = [(k, k % 40 % 3 if k < 65 else (k - 65) % 3, x.tolist()) for k, x in enumerate(v)] + [(500, 0, None), (501, 0, [0.0] * 8), (502, 0, [0.0] * 8)]
    df = spark.createDataFrame(rows, "id int, c int, v array<double>")
    unit = v / np.linalg.norm(v, axis=1)[:, None]
    expected = {}
    for k in range(len(v)):
        near = [(-round(float(unit[k] @ unit[j]), 6), j) for j in range(k) if rows[j][1] == rows[k][1] and round(float(unit[k] @ unit[j]), 6) >= 0.99]
        if near:
            expected[k] = min(near)[1]
    assert len(expected) == 28
    for size in (4_000, 7):
        assert {r["id"]: r["other"] for r in dedup.semantic_duplicates(df, "id", "v", "c", 0.01, size).collect()} == expected


def test_recursive_chunks():
    text = "One two three. " * 30 + "\n\n" + "x" * 95 + "\n" + "Four five. " * 20
    made = T.recursive_chunks(text, 80, 20)
    assert max(map(len, made)) <= 80 and "".join("".join(made).split()).startswith("Onetwothree.") and any("Four" in c for c in made)
    assert sum(c.count("x") for c in made) >= 95
    assert T.recursive_chunks("", 10, 2) == T.recursive_chunks("  ", 10, 2) == [] and T.recursive_chunks("short", 10, 2) == ["short"]
    assert T.recursive_chunks("ab cd ef", 5, 3) == ["ab cd", "cd ef"]


def test_a_pool_to_draw_from_is_bounded(spark, monkeypatch):
    from loamline.operators import splits

    queries, pool = spark.range(3).withColumnRenamed("id", "q"), spark.range(5).selectExpr("id AS item", "1.0 AS w")
    assert splits.weighted_draws(queries, "q", pool, "item", "w", 2, 1).count() == 6
    monkeypatch.setattr(splits, "MOST_ITEMS", 4)
    with pytest.raises(ValueError):
        splits.weighted_draws(queries, "q", pool, "item", "w", 2, 1)
