import base64
import random
import re

import pytest

from loamline.llm.quality import CLASSES, PROFILES, divergence, kinds, nearest, shares, statistics

PROSE = {
    "en": "The archive keeper was not sure that the old records had been copied, but after a long talk with the auditors they agreed to wait. In the end it was the weather that made up their minds for them.",
    "de": "Der Wächter des Archivs war nicht sicher, dass die alten Akten kopiert worden waren, aber nach einem langen Gespräch mit den Prüfern wollte er noch warten. Am Ende hat das Wetter für sie entschieden.",
    "fr": "Le gardien des archives ne savait pas si les vieux dossiers avaient été copiés, mais après une longue discussion avec les contrôleurs il a décidé d'attendre. À la fin, c'est le temps qui a décidé pour eux.",
    "pl": "Strażnik archiwum nie był pewien, czy stare akta zostały skopiowane, ale po długiej rozmowie z kontrolerami postanowił jeszcze poczekać. W końcu to pogoda zdecydowała za nich.",
    "ru": "Хранитель архива не был уверен, что старые записи были скопированы, но после долгого разговора с проверяющими он решил подождать. В конце концов за них всё решила погода.",
    "ja": "資料館の番人は古い記録が写されたかどうか分からなかったが、調査の人たちと長く話した後で待つことにした。最後は天気が決めてしまったのである。",
    "zh": "档案管理员不确定旧的记录是否已经被复制，但是在和审计人员长谈之后，他还是决定再等一等。最后是天气替他们做了决定。",
}


@pytest.mark.parametrize("code", PROSE)
def test_prose_in_any_language_and_layout(code):
    text = PROSE[code]
    wrapped = re.sub(r"(.{30,44}) ", r"\1\n", text * 3)
    for t in (text, text * 4, wrapped, text.upper(), text + "\n\n- one thing\n- other thing\n\n" + text, "\n".join(text.split(". "))):
        assert nearest(t)[0] == "prose", (code, t)


OTHERS = {
    "ko": "기록 보관소의 관리인은 오래된 기록이 복사되었는지 확신할 수 없었지만, 감사관들과 오랫동안 이야기한 뒤에 조금 더 기다리기로 했다. 결국 날씨가 그들을 대신해 결정을 내렸다.",
    "ar": "لم يكن أمين الأرشيف متأكدا من أن السجلات القديمة قد نسخت، لكنه قرر الانتظار بعد حديث طويل مع المراجعين. وفي النهاية كان الطقس هو الذي اتخذ القرار.",
    "el": "Ο φύλακας του αρχείου δεν ήταν σίγουρος αν τα παλιά έγγραφα είχαν αντιγραφεί, αλλά μετά από μια μακρά συζήτηση με τους ελεγκτές αποφάσισε να περιμένει. Στο τέλος αποφάσισε ο καιρός.",
    "hi": "अभिलेखागार के रखवाले को यकीन नहीं था कि पुराने दस्तावेज़ों की नकल हो चुकी है, लेकिन जाँचकर्ताओं से लंबी बातचीत के बाद उसने इंतज़ार करने का फैसला किया। अंत में मौसम ने ही फैसला कर दिया।",
    "th": "ผู้ดูแลหอจดหมายเหตุไม่แน่ใจว่าเอกสารเก่าถูกคัดลอกแล้วหรือไม่ แต่หลังจากพูดคุยกับผู้ตรวจสอบเป็นเวลานานเขาก็ตัดสินใจรอต่อไป ในที่สุดสภาพอากาศก็ตัดสินแทนพวกเขา",
    "fi": "Arkiston hoitaja ei ollut varma, oliko vanhat asiakirjat jo kopioitu, mutta keskusteltuaan pitkään tarkastajien kanssa hän päätti vielä odottaa. Lopulta sää ratkaisi asian heidän puolestaan.",
    "tr": "Arşiv görevlisi eski kayıtların kopyalanıp kopyalanmadığından emin değildi, ancak denetçilerle uzun bir konuşmadan sonra biraz daha beklemeye karar verdi. Sonunda kararı onların yerine hava verdi.",
    "he": "שומר הארכיון לא היה בטוח שהרשומות הישנות הועתקו, אבל אחרי שיחה ארוכה עם המבקרים החליט לחכות עוד קצת. בסופו של דבר מזג האוויר החליט במקומם.",
}


@pytest.mark.parametrize("code", OTHERS)
def test_prose_in_languages_without_word_lists(code):
    text = OTHERS[code]
    for t in (text, text * 3, text + "\n\n" + text):
        assert nearest(t)[0] == "prose", (code, nearest(t))


@pytest.mark.parametrize("items", [["红色木椅", "旧账本复印件", "水泵", "花园软管", "备用轮胎", "老式收音机"], ["赤色木製椅子", "古い帳簿", "水道ポンプ", "庭用ホース", "予備タイヤ", "旧式ラジオ"]])
def test_lists_without_blanks(items):
    for mark in ("- ", "• ", ""):
        assert nearest("\n".join(mark + x for x in items))[0] == "list"
    wrapped = {"ja": PROSE["ja"], "zh": PROSE["zh"]}
    for t in wrapped.values():
        assert nearest("\n".join((t * 2)[k : k + 18] for k in range(0, 2 * len(t), 18)))[0] == "prose"


def test_lists_tables_and_junk():
    rng = random.Random(1)
    items = ["red wooden chair", "Copy the long ledger", "water pump (32)", "Garden hose", "lamp, broken", "spare wheel", "Check tyres", "old radio"]
    for mark in ("- ", "* ", "• ", "[ ] ", ""):
        assert nearest("Contents\n" + "\n".join(mark + x for x in items))[0] == "list"
    assert nearest("\n".join(f"{k}. {x}" for k, x in enumerate(items, 1)))[0] == "list"
    rows = [[str(rng.randrange(10**5)), f"{rng.random() * 100:.2f}", "open", "", "2021-03-04"] for _ in range(12)]
    for sep in (",", ";", "\t", " | "):
        assert nearest("id" + sep + "share" + sep + "state\n" + "\n".join(sep.join(r) for r in rows))[0] == "table"
    assert nearest("\n".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows))[0] == "table"
    junk = [
        base64.encodebytes(rng.randbytes(600)).decode(),
        " ".join("".join(rng.choice("qwrtpsdfghjklzxcvbnmaeiou") for _ in range(rng.randint(2, 11))) for _ in range(80)),
        "".join(rng.choice("#$%&/()=?*+~<>|{}[]^_-.,:;!@\\ ") for _ in range(400)),
        "cheap offer 77 ! " * 60,
        "mixed inequality 2741 " * 13,
        "\n".join(f"http://h{rng.randrange(10**6)}.example/{rng.randrange(10**6):x}?s={rng.randrange(10**9):x}" for _ in range(12)),
        "".join(rng.choice("���Âã¤¶ aent.,") for _ in range(400)),
    ]
    for t in junk:
        assert nearest(t)[0] == "junk", t[:60]


def test_blank_texts_have_no_kind():
    assert nearest(None) is nearest("") is nearest(" \n\t") is None
    assert shares("  ") is None


def test_shares_add_up_and_divergence_is_a_divergence():
    for t in (*PROSE.values(), "a,b;c|d\n1\t2", "​", "x" * 100_000, "😀" * 40):
        v = shares(t)
        assert v is not None and abs(v.sum() - 1) < 1e-9 and (v >= -1e-9).all() and len(v) == len(CLASSES)
    a, b = PROFILES[0][1], PROFILES[-1][1]
    assert divergence(a, a) == 0 and 0 < divergence(a, b) == divergence(b, a) <= 1


def test_frames(spark):
    docs = spark.createDataFrame([(1, PROSE["en"], "x"), (1, PROSE["en"], "x"), (2, None, "x"), (3, " ", "x"), (4, "x,1\n" * 50_000, "x"), (None, "a b", "y")], "rec_id bigint, text string, kind string")
    found = {(x["rec_id"], x["kind"]) for x in kinds(docs).collect()}
    assert {(1, "prose"), (4, "table")} <= found and not {2, 3} & {k for k, _ in found}
    stats = {x["rec_id"]: x for x in statistics(docs).collect()}
    assert len(stats) == 5 and stats[2]["n_words"] == 0 and stats[3]["mean_word"] == 0.0
    assert stats[1]["n_words"] == len(re.findall(r"\w+", PROSE["en"])) and stats[1]["ended_lines"] == 1.0
    assert kinds(docs.limit(0)).count() == statistics(docs.limit(0)).count() == 0
