import re
import struct
import zipfile

import pytest

from loamline.sources import binidx, files, tars, warc


def test_binidx_round_trip(spark, tmp_path):
    binidx.register(spark)
    rows = [(k, list(range(k % 7))) for k in range(50)]
    df = spark.createDataFrame(rows, "id int, t array<int>").repartition(3)
    df.select("t").write.format("binidx").option("dtype", "uint16").mode("append").save(str(tmp_path))
    back = spark.read.format("binidx").option("rowsPerPartition", "4").load(str(tmp_path)).collect()
    assert sorted(r["tokens"] for r in back) == sorted(t for _, t in rows)
    index = next(tmp_path.glob("*.idx"))
    head = index.read_bytes()
    assert head[:9] == b"MMIDIDX\x00\x00" and struct.unpack("<QB", head[9:18]) == (1, 8)
    df.limit(5).select("t").write.format("binidx").mode("overwrite").save(str(tmp_path))
    assert spark.read.format("binidx").load(str(tmp_path)).count() == 5
    assert not [p for p in tmp_path.iterdir() if p.name.startswith(".")]


def test_tokens_that_do_not_fit(spark, tmp_path):
    binidx.register(spark)
    with pytest.raises(Exception, match="fit"):
        spark.createDataFrame([([70_000],)], "t array<int>").write.format("binidx").option("dtype", "uint16").mode("append").save(str(tmp_path))
    assert not list(tmp_path.glob("part-*"))


def test_tars(spark, tmp_path):
    rows = spark.createDataFrame([("a", "txt", b"1"), ("a", "json", b"{}"), ("b", "txt", None), ("c", "txt", b"x" * 2000)], "key string, extension string, content binary")
    made = tars.write_tars(rows.coalesce(1), str(tmp_path), "train")
    assert [n for n, _ in made] == ["train-shard-000000.tar"]
    back = tars.read_tars(spark, str(tmp_path))
    assert {(r["key"], r["extension"], bytes(r["content"])) for r in back.collect()} == {("a", "txt", b"1"), ("a", "json", b"{}"), ("c", "txt", b"x" * 2000)}
    index = tars.member_index(back, spark.createDataFrame(made, "archive string, bytes bigint")).orderBy("offset").collect()
    assert [r["key"] for r in index] == ["a", "c"] and sum(r["bytes"] for r in index) == made[0][1]


def test_zips_and_formats(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "q.zip", "w") as z:
        z.writestr("d/x.json", "{}")
    assert [(r["member"], bytes(r["content"])) for r in files.read_zips(spark, str(tmp_path)).collect()] == [("d/x.json", b"{}")]
    (tmp_path / "a.jsonl").write_text('{"a": 1}\n\n{"a": 2}\nbroken\n')
    listed = files.discover(spark, str(tmp_path))
    assert files.one_format(listed) == "json"
    assert files.read_json_lines(spark, str(tmp_path / "a.jsonl"), "a int", drop_broken=True).count() == 2
    (tmp_path / "b.parquet").write_bytes(b"x")
    with pytest.raises(ValueError):
        files.one_format(files.discover(spark, str(tmp_path)))


def test_archives_and_main_text():
    page = "<html><head><title>T</title></head><body><nav><a href='x'>one link</a> <a>two</a></nav><p>This is a paragraph that is long enough.</p><script>no()</script><div>tiny</div><p>Short one.</p></body></html>"
    assert warc.extract(page) == "This is a paragraph that is long enough.\nShort one."
    assert warc.extract(None) is None and warc.extract("") == "" and warc.extract("<p>unclosed and long enough to be kept") == "unclosed and long enough to be kept"
    body = b"HTTP/1.1 200 OK\r\n\r\nx"
    content = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n" % len(body) + body + b"\r\n\r\n"
    assert [(h["warc-type"], b) for h, b in warc.records(content * 2)] == [("response", body)] * 2
    with pytest.raises(ValueError):
        list(warc.records(b"nothing"))


def test_main_text_of_lines_entities_markup_and_scripts(spark, tmp_path):
    page = (
        "<html><body><p>First line\nsecond &amp; third &lt;b&gt; caf&eacute;, long enough.</p><h1>短い。</h1><p>Это достаточно длинный русский абзац</p>"
        "<p>これは<b>太字</b>を含む段落です。</p><p>one<br>two lines of prose, long enough here</p><p>x</p></body></html>"
    )
    warc.write_pages(spark.createDataFrame([("w", "http://u", page)], "warc_id string, url string, html string"), str(tmp_path))
    got = warc.read_pages(spark, str(tmp_path)).select("warc_id", "url", warc.main_text("html").alias("text")).collect()
    text = "First line second & third <b> café, long enough.\n短い。\nЭто достаточно длинный русский абзац\nこれは太字を含む段落です。\ntwo lines of prose, long enough here"
    assert [tuple(r) for r in got] == [("w", "http://u", text)]


def test_every_document_with_a_url_is_a_page(spark, sf):
    from loamline.plans import q_scans

    def said(text):
        text = re.sub(r"\s+", " ", text or "").strip()
        return text if len(text) >= 25 or text[-1:] and text[-1] in ".!?。！？" else ""

    docs = spark.read.parquet(f"{sf}/documents.parquet").where("url IS NOT NULL").collect()
    got = sorted(tuple(r) for r in q_scans.registry.queries["scan12_all_pages"](spark, sf).collect())
    assert got == sorted((d["warc_id"], d["url"], said(d["text"])) for d in docs)
    assert any("<" in t or "&" in t for *_, t in got) and any(not t.isascii() for *_, t in got)


def test_only_mounted_folders():
    from loamline.sources.blobs import mounted

    assert mounted("file:///x/y") == mounted("file:/x/y") == mounted("/x/y") == "/x/y"
    with pytest.raises(ValueError):
        mounted("hdfs://host/x")


def test_package_is_sent_where_workers_do_not_find_it(tmp_path, monkeypatch):
    import zipfile
    from types import SimpleNamespace

    from loamline.session import ship

    sent = []
    context = SimpleNamespace(master="spark://host", addPyFile=sent.append)
    monkeypatch.delenv("PYTHONPATH", raising=False)
    for _ in range(2):
        ship(SimpleNamespace(sparkContext=context))
    assert len(sent) == 1 and "loamline/session.py" in zipfile.ZipFile(sent[0]).namelist()
