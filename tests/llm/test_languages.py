import numpy as np
import pytest
from pyspark.sql import functions as F

from loamline.llm.languages import Filter, Scorer, _hashes, fit, grams, languages, named, segments, units

CODES = [("en", "eng", "English"), ("de", "deu", "German"), ("ja", "jpn", "Japanese"), ("zh", "zho", "Chinese")]
EN = ["The keeper of the archive copied the old ledger and put the new pages back on the shelf before noon.", "After the rain had stopped, two clerks carried the heavy boxes to the third floor without a word.", "Nobody knew who had left the window open, but the papers were wet and had to be dried by hand."]
DE = ["Der Wächter des Archivs schrieb das alte Buch ab und legte die neuen Seiten vor Mittag wieder ins Regal.", "Nachdem der Regen aufgehört hatte, trugen zwei Schreiber die schweren Kisten ohne ein Wort in den dritten Stock.", "Niemand wusste, wer das Fenster offen gelassen hatte, aber die Papiere waren nass und mussten getrocknet werden."]
JA = ["番人は古い帳簿を写して、新しい頁を昼までに棚へ戻した。", "雨がやんだ後で、二人の書記は重い箱を黙って三階まで運んだ。", "誰が窓を開けたままにしたのか分からなかったが、紙は濡れていて手で乾かさなければならなかった。"]
ZH = ["管理员抄写了旧账本，并在中午之前把新的页面放回了架子上。", "雨停了以后，两个书记员一声不响地把沉重的箱子搬到了三楼。", "没有人知道是谁让窗户开着，但是纸都湿了，只好用手一张一张弄干。"]


def text(part, k, n=4):
    return " ".join(part[(k + j) % 3] for j in range(n))


def corpus():
    docs = []
    for k in range(30):
        docs += [(k, text(EN, k), " EN "), (100 + k, text(DE, k), "de_AT"), (200 + k, text(JA, k, 6), "Japanese"), (300 + k, text(ZH, k, 6), "zho")]
    docs += [(400 + k, text(EN, k), "de") for k in range(45)]  # more wrong labels than right ones
    docs += [(500, text(EN, 1) + "\n" + text(DE, 0) + "\n" + text(EN, 0), "en"), (501, text(JA, 0, 6) + text(EN, 1), None), (502, text(EN, 0) + " “das alte Buch” " + text(EN, 1), "en")]
    docs += [(600, None, None), (601, " ", "en"), (602, "short", None), (603, text(DE, 0), "??"), (604, text(EN, 2).upper(), "eng"), (605, text(EN, 0) + " 123" * 20, "en-US")]
    return docs


@pytest.fixture(scope="module")
def frames(spark):
    return spark.createDataFrame([(*d, "x", 1.0) for d in corpus()], "doc_id bigint, text string, lang string, said string, confidence double"), spark.createDataFrame(CODES, "code string, iso3 string, english_name string")


def test_labels(spark, frames):
    said = spark.createDataFrame([(x,) for x in ["en", " EN", "en_US", "pt-BR", "deu", "German ", "unknown", "", None, "??", "zh-Hans"]], "l string").select(named(F.col("l"), frames[1]).alias("c"))
    assert [x["c"] for x in said.collect()] == ["en", "en", "en", None, "de", "de", None, None, None, None, "zh"]


def test_languages_of_documents(frames):
    docs, codes = frames
    found = {}
    for x in languages(docs, codes).collect():
        found.setdefault(x["doc_id"], set()).add(x["lang"])
        assert 0.5 <= x["confidence"] <= 1
    for low, code in ((0, "en"), (100, "de"), (200, "ja"), (300, "zh")):
        assert all(found[low + k] == {code} for k in range(30))
    assert all(found[400 + k] == {"en"} for k in range(45))
    assert found[500] == {"en", "de"} and found[501] == {"ja", "en"} and found[502] == {"en"}
    assert found[603] == {"de"} and found[604] == {"en"} and found[605] == {"en"}
    assert not {600, 601, 602} & set(found)


def test_segments_lie_where_they_are(frames):
    docs, codes = frames
    said = dict((d, t) for d, t, _ in corpus())
    got = sorted((x["start"], x["end"], x["lang"]) for x in segments(docs.where("doc_id = 500"), fit(docs, codes)).collect())
    assert [g[2] for g in got] == ["en", "de", "en"]
    assert said[500][got[1][0] : got[1][1]].startswith("Der W") and "getrocknet" in said[500][got[1][0] : got[1][1]]


def test_no_labels_and_no_rows(frames):
    docs, codes = frames
    assert languages(docs.withColumn("lang", F.lit(None).cast("string")), codes).count() == 0
    assert languages(docs.limit(0), codes).count() == 0
    assert languages(docs, codes.limit(0)).count() == 0


def test_a_very_long_text(frames):
    docs, codes = frames
    long = docs.sparkSession.createDataFrame([(1, text(EN, 0) * 2500 + text(DE, 0))], "doc_id bigint, text string")
    assert sorted(x["lang"] for x in segments(long, fit(docs, codes)).collect()) == ["de", "en"]


@pytest.mark.parametrize("n", [4, 40, 150])
def test_filter_holds_what_was_put_in(n):
    rng = np.random.default_rng(1)
    h, spoken = rng.integers(0, 1 << 63, 5000).astype(np.uint64), rng.random((5000, n)) < 2 / n
    f = Filter(h, spoken, n)
    assert f.spoken(h)[spoken].all()
    other = f.spoken(rng.integers(0, 1 << 63, 20_000).astype(np.uint64)).mean(axis=0)
    assert other.shape == (n,) and abs(other - f.chance).max() < 0.01


def test_a_short_stretch_in_a_very_long_text(frames):
    docs, codes = frames
    german = " ".join(text(DE, 0).split()[:30])
    long = docs.sparkSession.createDataFrame([(1, text(EN, 0) * 2500 + " " + german + " " + text(EN, 1) * 2500)], "doc_id bigint, text string")
    assert sorted({x["lang"] for x in segments(long, fit(docs, codes)).collect()}) == ["de", "en"]


def test_text_in_an_unknown_language(frames):
    docs, codes = frames
    korean = "기록 보관소의 관리인은 오래된 장부를 베껴서 정오 전에 새 종이를 선반에 다시 올려놓았다 그는 아무 말도 하지 않았다 "
    some = docs.sparkSession.createDataFrame([(1, korean * 20), (2, korean * 20 + text(EN, 0) + " " + korean * 20), (3, korean * 20 + "the old ledger " + korean * 20)], "doc_id bigint, text string")
    assert sorted((x["doc_id"], x["lang"]) for x in segments(some, fit(docs, codes)).collect()) == [(2, "en")]


def test_forty_languages(spark):
    import random

    rng = random.Random(5)
    vocab = [["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 8))) for _ in range(60)] for _ in range(40)]
    said = lambda k: " ".join(rng.choices(vocab[k], k=60))
    codes = spark.createDataFrame([(f"l{k:02d}", f"lan{k:02d}", f"Language {k}") for k in range(40)], "code string, iso3 string, english_name string")
    docs = spark.createDataFrame([(100 * k + j, said(k), f"l{k:02d}") for k in range(40) for j in range(6)], "doc_id bigint, text string, lang string")
    found = {x["doc_id"]: x["lang"] for x in languages(docs, codes).collect()}
    assert found == {100 * k + j: f"l{k:02d}" for k in range(40) for j in range(6)}


def test_too_long_a_table_is_an_error(spark, frames):
    many = spark.range(10_001).selectExpr("concat('c', id) AS code", "concat('d', id) AS iso3", "concat('e', id) AS english_name")
    with pytest.raises(ValueError):
        fit(frames[0], many)


def test_units_and_grams():
    assert units("The Cat 12") == ["the", "cat", "12"] and units("日本 x") == ["日本", "本", "x"]
    assert grams("12") == [] and grams("of") == ["^of$"] and grams("cats") == ["^cat", "cats", "ats$"]
    s = Scorer(["en"], Filter(_hashes(["^of$"]), np.array([[True]]), 1))
    assert s.table[s.look_up(["of"])[0], 0] > 0.9
