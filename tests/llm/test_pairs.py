import pytest

from loamline.llm.languages import Scorer, fit
from loamline.llm.pairs import Judge, defects, ended, refuses, responses, shortened, signs
from loamline.tables import load

Q = "How do I copy the old ledger before noon?"
A = "Start with the first page and leave the rest for the evening. The second page can wait."


@pytest.fixture(scope="module")
def model(spark):
    return fit(load(spark, "/root/testdata/sf0.1", "documents"), load(spark, "/root/testdata/sf0.1", "lang_codes"))


@pytest.fixture(scope="module")
def defect(model):
    return Judge(Scorer(*model)).defect


@pytest.mark.parametrize("r", [None, "", " \n", "N/A", "n/a.", "none.", "null", "...", "…", "-", "--", "​", "<p></p>", "<empty>", "[no answer]", "(no response)", "{}", '""', "TBD", "Response:"])
def test_empty(defect, r):
    assert defect(Q, r) == "empty"


@pytest.mark.parametrize("r", [Q, Q.upper(), Q.lower().rstrip("?"), f"“{Q}”", "Q: " + Q, "You asked: " + Q, f"  {Q} {Q}", Q + "!!"])
def test_copy(defect, r):
    assert defect(Q, r) == "copy"


@pytest.mark.parametrize(
    "r",
    [
        "I'm sorry, but I can't help with that request.", "As a language model, I must refuse to discuss it. Please ask something else.", "Sorry, I won’t be able to provide that.", "Answering this would go against my guidelines.",
        "You would like to know more about the ledger. I am unable to comply.", "I'd rather not go into that. Let me know if you have a different question!",
    ],
)
def test_refusal(defect, r):
    assert defect(Q, r) == "refusal"


@pytest.mark.parametrize(
    "q, r",
    [
        ("Wie prüfe ich die Tabellen?", "Tut mir leid, dabei kann ich nicht helfen."), ("Comment vérifier le contrat ?", "Je préfère ne pas répondre."), ("¿Cómo puedo revisar el manual?", "Lo siento, no puedo ayudarte con eso."),
        ("Come posso controllare il catalogo?", "Mi dispiace, non posso aiutarti con questa richiesta."), ("Como posso revisar o contrato?", "Desculpe, não posso ajudar com esse pedido."), ("Hoe controleer ik het verslag?", "Sorry, daar kan ik niet bij helpen."),
        ("Hur granskar jag rapporten?", "Tyvärr kan jag inte hjälpa till med det."), ("Jak sprawdzić raport?", "Przykro mi, nie mogę pomóc w tej sprawie."), ("Как проверить журнал?", "Извините, я не могу помочь с этим запросом."), ("怎样检查合同？", "抱歉，我无法回答这个问题。"), ("契約書を確認する方法を教えてください。", "申し訳ありませんが、そのご質問にはお答えできません。"),
    ],
)
def test_refusal_in_other_languages(defect, q, r):
    assert defect(q, r) == "refusal"


@pytest.mark.parametrize("r", ["I can't stress enough how old the ledger is, so copy it twice.", "I apologize for the delay. " + A, "Unfortunately the ledger is not complete, yet you are able to copy it.", "You cannot copy a ledger that is wet, but you can dry it.", "It is against the house rules to copy ledgers at noon, so wait until one."])
def test_an_answer_is_no_refusal(defect, r):
    assert defect(Q, r) is None


@pytest.mark.parametrize("r", [A + " However, it", A + " The third page was left on the ta", A + "\n```sql\nselect count(*) from", "Steps:\n1. Open it.\n2. Copy it.\n3. Then", "Steps:\n1. Open it.\n2. Copy it.\n3.", A + " Compare Fig.", A + " such as e.g.", A + " and then the -", A + " turned out …[cut"])
def test_truncated(defect, r):
    assert defect(Q, r) == "truncated"


@pytest.mark.parametrize("r", [A, "87", "About 39 ledgers", "Yes, by copying the index", "Only the auditor.", A + " :)", A + " 👍", A + "\n\n---", "(" + A + ")", A + "\n```\nsort -u a.txt > b.txt\n```", "Do this:\n- copy the red book\n- burn the old book\n- write a new one", "12,500"])
def test_whole(defect, r):
    assert defect(Q, r) is None


def test_other_language(defect):
    german = "Die Redaktion verwarf die Tabellen ohne großen Aufwand, damit keine Lücke entsteht. Die Abteilung kürzte das Protokoll."
    assert defect(Q, german) == "other_language"
    assert defect("Please answer in German. " + Q, german) is None and defect("Translate into German: The ledger is old.", german) is None
    assert defect("Translate into French: The ledger is old.", german) == "other_language"
    assert defect("Warum ersetzt man den Entwurf nach der dritten Runde?", A) == "other_language"
    assert defect("为什么需要替换这些数据？", "研究室は一週間以内に古い請求書を集めた。文章が長すぎたからである。") == "other_language"
    assert defect(Q, A + " The older form says “die Testfragen”.") is None


def test_questions_that_are_blank_have_no_case(defect):
    assert defect(None, None) is defect(" ", "") is None


def test_language_says_nothing_about_too_little(model):
    assert Judge(Scorer(*model)).languages(["9", "", A, "Waarom vervangt men de handleiding na de derde poging?"]) == [None, None, "en", "nl"]


@pytest.mark.parametrize(
    "r",
    [
        "기록 보관소의 관리인은 오래된 장부를 베껴서 정오 전에 새 종이를 선반에 다시 올려놓았다.",
        "قام أمين الأرشيف بنسخ الدفتر القديم ووضع الأوراق الجديدة على الرف قبل الظهر.",
        "Arkiston hoitaja kopioi vanhan kirjan ja laittoi uudet sivut takaisin hyllylle ennen puoltapäivää.",
        "Ο φύλακας του αρχείου αντέγραψε το παλιό βιβλίο και έβαλε τις νέες σελίδες στο ράφι.",
    ],
)
def test_languages_that_the_filter_does_not_know(defect, r):
    assert defect(Q, r) == "other_language"


def test_refusal_of_any_length(defect):
    assert defect(Q, "My guidelines prevent me from answering.") == "refusal"
    long = "I'm sorry, but I can't help with that request. " + "I know that you may have hoped for more from me, and I understand that my reply is not what you wanted to read today. " * 9
    assert len(long) > 1000 and defect(Q, long.strip()) == "refusal"
    assert defect(Q, "I'm sorry, but I can't help with the blue ledger. " + A + " " + A) is None and not refuses(A)


def test_ended():
    assert ended("Yes.") and ended('He said "no."') and not ended("Yes") and not ended("```\nx")


def test_frames(spark, model):
    sft = spark.createDataFrame([(1, Q, A, "x"), (1, Q, A, "x"), (2, Q, None, "x"), (3, None, None, "x"), (4, Q, "word " * 300_000, "x"), (None, Q, "", "x")], "row_id bigint, user_query string, assistant_response string, field string")
    pref = spark.createDataFrame([(7, Q, Q, A)], "pref_id bigint, prompt string, response_a string, response_b string")
    rows = responses([("sft", sft, "row_id", "user_query", ["assistant_response"]), ("pref", pref, "pref_id", "prompt", ["response_a", "response_b"])])
    assert {tuple(x) for x in defects(rows, model).drop("sign").collect()} == {("sft", 2, "assistant_response", "empty"), ("sft", 4, "assistant_response", "truncated"), ("sft", None, "assistant_response", "empty"), ("pref", 7, "response_a", "copy")}
    assert defects(rows.limit(0), model).count() == 0


def test_shortened_versions_and_length_limits(spark, model):
    whole = "Do the following things in this order, as was agreed upon last week:\n- copy the red book\n- burn the old paper book\n- write a new report"
    short = whole[:-4]
    rows = [("t", 1, "r", Q, whole), ("t", 2, "r", Q, short)]
    limited = [("t", 100 + k, "s", Q, (f"Do this for number {k:03d} now, and do not forget anything that was said:\n- copy the red book\n- burn the old book and the new paper that was left on the table in the hall of the house")[:150]) for k in range(40)]
    spread = [("t", 200 + k, "s", Q, f"Do this for number {k:03d} now, and nothing else that was said before:\n- copy book\n- burn it {'y' * k}") for k in range(10)]
    found = {(x["row_id"], x["defect"]) for x in defects(spark.createDataFrame(rows + limited + spread, "tbl string, row_id bigint, field string, question string, response string"), model).collect()}
    assert (2, "truncated") in found and (1, "truncated") not in found
    assert {(100 + k, "truncated") for k in range(40)} <= found and not any(r >= 200 for r, _ in found)


def test_a_short_text_can_be_a_shortened_version(spark, model):
    whole = "Copy the red book and leave the rest where it is."
    rows = [("t", 1, "r", Q, whole), ("t", 2, "r", Q, whole[:40]), ("t", 3, "r", Q, "13"), ("t", 4, "r", Q, "137"), ("t", 5, "r", Q, "Yes, by copying the index"), ("t", 6, "r", Q, "Yes, by copying the index cards")]
    found = {x["row_id"]: x["sign"] for x in defects(spark.createDataFrame(rows, "tbl string, row_id bigint, field string, question string, response string"), model).collect()}
    assert found == {2: "shortened"}
    assert shortened("Open the doo", "Open the door") and not shortened("Open the door", "Open the door of the house") and not shortened("x", None)


def test_neighbours_meet_across_tasks_and_shared_openings(spark, model):
    """A third of the rows have one text, all have one opening, and there are more tasks than different texts."""
    opening = "Here is what was agreed upon after a long talk with the keepers of the archive and the auditors: "
    texts = [opening + "copy book number %d and leave the rest." % k for k in range(6)]
    short = [t[:-9] for t in texts]
    rows = [("t", k, "r", Q, texts[0]) for k in range(60)] + [("t", 1000 + k, "r", Q, t) for k, t in enumerate(texts[1:] + short)] + [("t", 2000 + k, "r", Q, short[0]) for k in range(40)]
    frame = spark.createDataFrame(rows, "tbl string, row_id bigint, field string, question string, response string")
    for tasks in ("4", "40"):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", tasks)
        try:
            got = {x["row_id"] for x in signs(frame, model).where("shortened").collect()}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
        assert got == {1005 + k for k in range(6)} | {2000 + k for k in range(40)}
