import pytest
from pyspark.sql import functions as F

from loamline.operators.receipts import Receipts
from loamline.plans.pipelines import curate, packed_chats, run_hash, token_dataset
from loamline.tables import load

BPE = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def test_receipts_let_a_run_go_on(spark, tmp_path):
    r = Receipts(spark, str(tmp_path / "r"))
    assert not r.done("p", "1") and r.table().count() == 0
    with pytest.raises(ZeroDivisionError):
        r.once("p", "1", lambda: 1 / 0)
    assert not r.done("p", "1") and r.table().first()["status"] == "failed"
    assert r.once("p", "1", lambda: '{"n": 1}') and not r.once("p", "1", lambda: 1 / 0)
    assert r.done("p", "1") and not r.done("q", "1")


def test_run_hash():
    assert run_hash(a=1, b="x") == run_hash(b="x", a=1) != run_hash(a=2, b="x")


def test_token_dataset(spark, tmp_path):
    docs = spark.createDataFrame([(1, "one two three four"), (2, None), (3, "x"), (4, "five six")], "id int, text string")
    made = token_dataset(docs, "id", "text", str(tmp_path), "tiktoken", BPE, min_chars=2, max_tokens=3, end=50256)
    assert (made["sequences"], made["errors"], made["cut"]) == (2, 0, 1)
    assert spark.read.format("binidx").load(made["path"]).agg(F.sum(F.size("tokens"))).first()[0] == made["tokens"] == 6
    assert token_dataset(docs.limit(0), "id", "text", str(tmp_path), "tiktoken", BPE, min_chars=2, max_tokens=3, end=50256) == made  # was done before


def test_packed_chats(spark):
    kind = "id int, messages array<struct<role:string,content:string,reasoning_content:string>>"
    chats = spark.createDataFrame([(k, [("user", "What is it?", None), ("assistant", "A thing " * (k + 1), None)]) for k in range(20)], kind)
    rows = packed_chats(chats, "id", "messages", "tiktoken", BPE, 128, shards=2).collect()
    assert sum(len(r["seq_start_id"]) for r in rows) == 20
    for r in rows:
        assert len(r["input_ids"]) == len(r["loss_mask"]) <= 128 and r["seq_start_id"][0] == 0 and sum(r["loss_mask"]) > 0
        assert all(r["loss_mask"][s - 1] == 0 for s in [*r["seq_start_id"][1:], len(r["loss_mask"])])


def test_curate(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "text", "lang")
    out = curate(docs, "doc_id", "text").cache()
    assert 0 < out.count() <= docs.count() and out.select("text").distinct().count() == out.count()
    assert out.where("bucket < 0 OR bucket > 19").isEmpty()
