import random

from loamline.llm.common import words
from loamline.llm.leaks import leaked, passages

DOCS = "doc_id bigint, text string, item string, field string, start int"
ITEMS = "question_id string, question string, cot_content string, said string"


def frames(spark, docs, items):
    return spark.createDataFrame([(*d, "x", "y", 1) for d in docs], DOCS), spark.createDataFrame([(*i, "z") for i in items], ITEMS)


def brute(docs, items, n=13):
    out = set()
    for d, text in docs:
        w = words(text or "")
        runs = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
        for q, *fields in items:
            for f in fields:
                v = words(f or "")
                if any(tuple(v[k : k + n]) in runs for k in range(len(v) - n + 1)):
                    out.add((d, q))
    return out


def cases():
    rng = random.Random(4)
    vocab = [f"w{k}" for k in range(60)]
    items = [(f"q{k}", " ".join(rng.choices(vocab, k=rng.randint(5, 40))), rng.choice([None, "", " ".join(rng.choices(vocab, k=30))])) for k in range(30)]
    docs = []
    for d in range(200):
        body = rng.choices(vocab, k=30)
        q = rng.choice(items)
        source = words(rng.choice([q[1], q[2] or q[1]]))
        at, n = rng.randint(0, max(0, len(source) - 5)), rng.randint(8, 18)
        cut = source[at : at + n]
        sep = rng.choice([" ", "\n> ", ", ", " “"])
        docs.append((d, " ".join(body[:10]) + " " + sep.join(w.upper() if rng.random() < 0.2 else w for w in cut) + " " + " ".join(body[10:])))
    return docs + [(1000, None), (1001, " "), (1002, "")], items


def test_against_brute_force(spark):
    docs, items = cases()
    d, i = frames(spark, docs, items)
    expected = brute(docs, items)
    assert expected and {tuple(x) for x in leaked(d, i).collect()} == expected
    # Many items are read in parts.
    assert {tuple(x) for x in leaked(d, i, max_item_words=300).collect()} == expected


def test_offsets_are_those_of_the_text(spark):
    docs, items = cases()
    d, i = frames(spark, docs, items)
    texts, said = dict(docs), {(q, f): t for q, a, b in items for f, t in (("question", a), ("cot_content", b))}
    found = passages(d, i).collect()
    assert found
    for x in found:
        own = words(texts[x["doc_id"]][x["start"] : x["end"]])
        other = words(said[x["question_id"], x["field"]])
        assert own == other[x["first_word"] : x["first_word"] + x["n_words"]] and len(own) >= 13


def test_nulls_repeats_and_empty_tables(spark):
    run = " ".join(f"a{k}" for k in range(13))
    d, i = frames(spark, [(1, run), (1, run), (2, run[:-1])], [("q", run, None), ("q", run, None), (None, run, None), ("s", None, None)])
    assert [tuple(x) for x in leaked(d, i).collect()] == [(1, "q")]
    assert leaked(d.limit(0), i).count() == 0 and leaked(d, i.limit(0)).count() == 0


def test_a_very_long_text(spark):
    run = " ".join(f"a{k}" for k in range(20))
    d, i = frames(spark, [(1, "x y " * 400_000 + run + " z" * 100_000)], [("q", run, None)])
    assert passages(d, i).first()["n_words"] == 20
