"""Problem 4: defective responses in prompt and response pairs.

The responses are sorted by text first. Two signs come out of the sorted table as a whole:

* a *shortened version*: the next different text in sorted order goes on where this one ends (all texts that begin
  with a text follow it directly, so the common prefix with the neighbour settles it). It counts where the longer
  text has the end that the shorter one lacks, or where the shorter one stops inside a word.
* a *length limit*: among texts of several sentences or lines without an end mark, far more end at one
  length than at the lengths around it.

Rules add to them, and each response gets at most one defect, in this order:

* ``empty``: null, blank, or a stand-in for nothing (no letters or digits at all, an empty element, a
  word such as "none" or "n/a").
* ``copy``: nothing but the question, once or more often, apart from quotes, case and a few words before it.
* ``refusal``: a sentence that declines, in any of twelve languages, with at most two sentences before it and
  two after it that speak of the matter and not of those who ask and answer. A refusal of any length is one;
  an apology that is followed by an answer is none.
* ``truncated``: one of the two signs, an open code block, a text that ends without the end of a sentence, in
  an abbreviation that calls for more, or in the bare number of the next step. Short answers (a number, a few
  words) and lists whose items have no end marks are whole.
* ``other_language``: not in the language that the question asks for, or else not in its own. Languages
  are told by the n-gram filter of problem 8; a response in a language that the filter doesn't know is in
  another one than a question that it knows.

Sorting is by range of the text and then of the id, so a text or an opening that very many responses share is
split over tasks; neighbours across the borders of tasks are compared afterwards, from three texts of
each task. The ranges come from Spark's sample of 100 keys a task.

Cases: rows with a null or blank question have no defect. Rows delivered twice count once. Texts of any
length are used whole. Languages that can't be told from a short question give no ``other_language``.
Empty tables give empty results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loamline.llm.common import WORD, blank
from loamline.llm.languages import Filter, Scorer, fit, scorer_of, shared
from loamline.registry import Registry
from loamline.session import cut
from loamline.tables import load

registry = Registry()

NOTHING = set("na none null nil empty tbd todo nan undefined blank response answer noresponse noanswer notavailable notapplicable pending placeholder output assistant reply".split())

#: Declining, as regular expressions over lower-cased text with plain apostrophes, each with stems of which one must occur.
REFUSALS = [
    (stems, re.compile(pattern))
    for stems, pattern in (
        (("can't", "cannot", "can not", "could not", "couldn't", "won't", "will not"), r"\b(?:i|we) (?:am|'m|are|'re)? ?(?:sorry,? but )?(?:i|we)? ?(?:cannot|can't|can not|could not|couldn't|won't|will not)(?: be able to)? (?:help|assist|answer|provide|comply|respond|fulfil|fulfill|do that|discuss|engage|share|support|complete)\b"),
        (("unable to", "not able to", "not allowed to", "not permitted to", "not in a position to", "forbidden to"), r"\b(?:i am|i'm|we are|i was) (?:unable|not able|not allowed|not permitted|not in a position|forbidden) to (?:comply|help|answer|assist|respond|provide|discuss|do)\b"),
        (("against my",), r"\bgo(?:es)? against my (?:guidelines|rules|policy|principles)\b"),
        (("refuse", "decline"), r"\bi (?:must|have to|need to) (?:refuse|decline)\b|\bsomething i (?:have to|must|need to) (?:decline|refuse)\b"),
        (("outside",), r"\boutside (?:of )?what i am allowed\b|\boutside what i'm allowed\b"),
        (("rather not", "prefer not"), r"\bi(?:'d| would) (?:rather|prefer) not\b|\bi(?:'d| would) prefer not to\b"),
        (("comfortable",), r"\bi (?:don't|do not) feel comfortable\b|\bi'm not comfortable\b|\bi am not comfortable\b"),
        (("no answer can", "my rules forbid"), r"\bno answer can be given\b|\bmy rules forbid\b"),
        (("my guidelines", "my rules", "my policy", "my policies", "my instructions", "my principles", "my programming"), r"\bmy (?:guidelines|rules|policy|policies|instructions|principles|programming) (?:prevents?|forbids?|prohibits?|stops?|keeps?|(?:does|do) not (?:allow|permit)|don't (?:allow|permit))\b"),
        (("nicht", "ablehnen"), r"\btut mir leid, (?:aber )?(?:ich|dabei|damit|da)\b.{0,40}\bnicht\b|\bdarf ich\b.{0,30}\bnicht beantworten\b|\bmuss ich diese (?:anfrage|frage)\b.{0,20}\bablehnen\b|\bich kann\b.{0,40}\bnicht (?:helfen|beantworten)\b|\bdarauf möchte ich\b.{0,20}\bnicht\b|\bmöchte ich (?:lieber )?nicht (?:antworten|beantworten)\b|\bich möchte\b.{0,25}\bnicht (?:antworten|beantworten)\b"),
        (("je ne ", "je préfère", "je dois", "je n'ai"), r"\bje ne (?:peux|suis) pas\b.{0,60}\b(?:aider|répondre|mesure)\b|\bje préfère ne pas\b|\bje dois (?:refuser|décliner)\b|\bje n'ai pas le droit de répondre\b|\bje ne suis pas autoris"),
        (("no puedo", "rechazar", "prefiero", "no me está", "no tengo", "no estoy"), r"\bno puedo\b.{0,20}\b(?:ayudar|ayudarte|ayudarle|responder|contestar)\b|\bdebo rechazar\b|\bprefiero no (?:responder|contestar)\b|\bno (?:me está permitido|tengo permitido|tengo permiso|estoy autorizad[oa])\b|\bno estoy en condiciones de responder\b"),
        (("non posso", "non sono", "non mi", "preferisco", "rifiutare", "declinare"), r"\bnon (?:posso|sono in grado)\b.{0,25}\b(?:aiutar\w*|rispondere)\b|\bnon mi è consentito\b|\bpreferisco non rispondere\b|\bdevo (?:rifiutare|declinare)\b"),
        (("não ", "recusar"), r"\bnão posso\b.{0,20}\b(?:ajudar|responder)\b|\bnão tenho permissão\b|\bprefiro não responder\b|\b(?:devo|tenho de|tenho que|preciso) recusar\b|\bnão (?:me é permitido|estou em condições)\b"),
        (("niet", "weigeren", "afwijzen", "liever"), r"\bkan ik (?:u |je |jou )?(?:niet|helaas niet)\b.{0,20}\b(?:helpen|beantwoorden)\b|\bmag ik\b.{0,20}\bniet beantwoorden\b|\b(?:moet ik)\b.{0,30}\b(?:weigeren|afwijzen)\b|\bik (?:geef|wil)\b.{0,20}\bliever (?:geen|niet)\b|\bik kan\b.{0,30}\bniet (?:helpen|beantwoorden)\b"),
        (("inte", "avböja", "avslå", "neka"), r"\bkan jag (?:tyvärr )?inte\b.{0,20}\b(?:hjälpa|svara)\b|\bjag (?:kan|får|vill) (?:tyvärr |helst )?inte\b.{0,20}\b(?:hjälpa|svara|besvara)\b|\bmåste jag (?:avböja|avslå|neka)\b|\bfår jag (?:tyvärr )?inte (?:svara|besvara)\b"),
        (("nie mogę", "odmówić", "nie wolno", "wolę nie", "nie jestem"), r"\bnie mogę\b.{0,25}\b(?:pomóc|odpowiedzieć|udzielić)\b|\bmuszę odmówić\b|\bnie wolno mi\b|\bwolę nie odpowiadać\b|\bnie jestem w stanie odpowiedzieć\b"),
        (("не могу", "вынужден", "мне не ", "предпоч", "не буду", "не имею", "должен"), r"не могу\b.{0,25}(?:помочь|ответить|отвечать)|вынужден\w* отказать|мне не (?:разрешено|позволено)|предпоч\w+ не отвечать|не буду отвечать|не имею права отвечать|должен отклонить|должен отказать"),
        (("无法", "不能", "拒绝", "不便", "不允许", "不愿", "帮不了"), r"无法回答|不能回答|无法提供|无法帮助|不能帮助|无法协助|必须拒绝|不便回答|拒绝回答|不允许回答|不愿回答|帮不了"),
        (("お答え", "お手伝い", "回答でき", "お断り", "お応え", "答える", "許可", "控え"), r"お答えできません|お答えすることはできません|お手伝いできません|回答できません|お断り|お応えできません|答えることはできません|許可されていません|控えさせて"),
    )
]
#: Words of those who ask and answer (first and second person, wishes, rules), by which a sentence beside a refusal is told from an answer.
ABOUT_US = re.compile(
    r"\b(?:i|i'm|i'd|i'll|me|my|we|our|us|you|your|yours|sorry|thanks|thank|please|request|guidelines|policy|policies|assistant|model"
    r"|ich|mir|mich|mein\w*|wir|sie|ihnen|ihre?\w*|du|dir|bitte|leid|je|j'\w+|me|mon|ma|mes|nous|vous|votre|vos|désolée?|yo|mi|mis|usted|su|tu|lo siento|io|mio|mia|lei|scusa|spiace|eu|meu|minha|você|seu|sua|desculpe"
    r"|ik|mij|mijn|wij|we|u|uw|jij|je|jou\w*|jag|mig|min|mina|ni|er|du|din|tyvärr|ja|mnie|mój|moje|mi|pan\w*|twoj\w*|przykro|я|мне|мой|мои|вы|вам|ваш\w*|извините)\b"
    r"|我|您|你|抱歉|申し訳|ご質問|ください|ません"
)
#: Abbreviations that don't end a sentence.
OPEN_ENDS = re.compile(r"(?:^|[\s(])(?:e\.g|i\.e|fig|approx|cf|vs|incl|z\.b|d\.h|bzw|p\.ej|p\.ex|bijv|t\.ex|т\.е)\.$", re.I)
LANGUAGES = ("English", "German", "French", "Spanish", "Italian", "Portuguese", "Dutch", "Swedish", "Polish", "Russian", "Chinese", "Japanese")
CODES = ("en", "de", "fr", "es", "it", "pt", "nl", "sv", "pl", "ru", "zh", "ja")
_ASKED = re.compile(r"\b(?:in|into|to)\s+(" + "|".join(LANGUAGES) + r")\b")
_END = ".!?…。！？"
_ITEM = re.compile(r"\s*(?:[-*•→]|\d+[.)]|[a-z]\))\s+")
SHORT_WORDS, SHORT_WIDE = 7, 12
ASIDE_SENTENCES = 2


def _bare(text: str) -> str:
    return "".join(WORD.findall(text.lower()))


_TRAILER = re.compile(r"(?:\s*(?:-{3,}|\*{3,}|:-?[)(D]|;-?\))|[\s\"'”’»›」』\])*_>​]|[☀-➿\U0001f000-\U0001faff️])+$")


def ended(text: str) -> bool:
    """Whether a text closes with the end of a sentence, of a block or of an element."""
    if text.count("```") % 2:
        return False
    t = text.rstrip()
    if t.endswith("```"):
        return True
    while t and t[-1] not in _END and (m := _TRAILER.search(t[-80:])):  # a look at the end costs the same for any text
        t = t[: len(t) - len(m[0])]
    return bool(t) and t[-1] in _END and not OPEN_ENDS.search(t) and not re.search(r"(?:^|\n)\s*\d+[.)]$", t)


def whole_without_end(text: str) -> bool:
    """Whether a text that has no end mark is whole all the same: a short answer, or a list without marks."""
    t = text.strip()
    if text.count("```") % 2 or OPEN_ENDS.search(t) or t[-1:] in ",:;(-|":
        return False
    lines = [x for x in t.split("\n") if x.strip()]
    if len(lines) > 1 and _ITEM.match(lines[-1]):
        items = [x for x in lines if _ITEM.match(x)]
        least = min(len(x.split()) for x in items)
        return len(items) > 1 and not any(x.rstrip()[-1] in _END + ";" for x in items[:-1]) and len(items[-1].split()) >= max(2, least - 1)
    wide = any("぀" <= c <= "鿿" for c in t)
    return not any(c in _END for c in t[:-1] if c != ".") and not re.search(r"\.\s", t) and (len(t) <= SHORT_WIDE if wide else len(t.split()) <= SHORT_WORDS)


def refuses(response: str) -> bool:
    """Whether a response declines and gives no answer."""
    plain = response.lower().replace("’", "'")
    tried = [p for stems, p in REFUSALS if any(x in plain for x in stems)]
    if not any(p.search(plain) for p in tried):
        return False
    before = after = 0
    declined = False
    for sentence in re.split(r"(?<=[.!?。！？])\s*", plain.strip()):
        if any(p.search(sentence) for p in tried):
            declined = True
        elif sentence and not ABOUT_US.search(sentence):
            before, after = before + (not declined), after + declined
    return before <= ASIDE_SENTENCES and after <= ASIDE_SENTENCES


def early(question: str, response: str | None) -> str | None:
    """``empty``, ``copy`` or ``refusal``, or None."""
    bare = _bare(re.sub(r"</?[A-Za-z]+ ?/?>", "", response)) if response is not None else ""
    if not bare or bare in NOTHING:
        return "empty"
    asked = _bare(question)
    if asked and asked in bare and len(bare.replace(asked, "")) <= max(12, len(asked) // 8):
        return "copy"
    if _ASKED.search(question) and len(bare) > 12 and bare in asked:
        return "copy"
    return "refusal" if refuses(response) else None


def shortened(text: str, following: str | None) -> bool:
    """Whether ``text`` is a shortened version of the text that follows it in sorted order."""
    if following is None or not following.startswith(text) or len(following) == len(text) or ended(text) or not any(c.isalpha() for c in text):
        return False
    return ended(following) or (text[-1].isalpha() and following[len(text)].isalpha())


def several(text: str) -> bool:
    """Whether a text has more than one sentence or line; a length limit can only be seen on such texts."""
    return bool(re.search(r"[.!?。！？\n].*\w", text, re.S))


class Judge:
    """Rules over pairs of question and response, with the language filter of problem 8."""

    QUESTION_MARGIN, RESPONSE_MARGIN = 2.0, 3.0
    UNKNOWN_SCORE, UNKNOWN_UNITS = 0.2, 5.0

    def __init__(self, scorer: Scorer) -> None:
        self.scorer = scorer
        self.number = {c: k for k, c in enumerate(scorer.codes)}

    def languages(self, questions: list[str]) -> list[str | None]:
        """The language of each text, or None if it can't be told."""
        says, _, _ = self.scorer.likelihoods(questions)
        if says.shape[1] < 2:
            return [None] * len(questions)
        two = np.sort(np.partition(says, -2, axis=1)[:, -2:], axis=1)
        best = says.argmax(axis=1)
        return [self.scorer.codes[b] if a1 - a0 >= self.QUESTION_MARGIN else None for b, (a0, a1) in zip(best.tolist(), two.tolist())]

    def foreign(self, questions: list[str], answers: list[str]) -> list[bool]:
        """Whether each answer is in another language than its question calls for."""
        asked = [_ASKED.search(q) for q in questions]
        own = self.languages(questions)
        wanted = [self.number.get(CODES[LANGUAGES.index(m[1])] if m else own[k], -1) for k, m in enumerate(asked)]
        if not self.scorer.codes:
            return [False] * len(questions)
        says, mean, weight = self.scorer.likelihoods(answers)
        at = np.array(wanted, np.int64)
        behind = says.max(axis=1) - says[np.arange(len(at)), np.maximum(at, 0)]
        unknown = (mean < self.UNKNOWN_SCORE) & (weight >= self.UNKNOWN_UNITS)
        return ((at >= 0) & ((behind >= self.RESPONSE_MARGIN) | unknown)).tolist()

    def defect(self, question: str | None, response: str | None) -> str | None:
        """The defect of one response by itself."""
        if question is None or not question.strip():
            return None
        if found := early(question, response):
            return found
        if not ended(response) and not whole_without_end(response):
            return "truncated"
        return "other_language" if self.foreign([question], [response])[0] else None


def responses(tables: list[tuple[str, DataFrame, str, str, list[str]]]) -> DataFrame:
    """(tbl, row_id, field, question, response) of tables given as (name, rows, key, question, response columns)."""
    parts = None
    for name, rows, key, question, fields in tables:
        said = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"`{f}`").alias("response")) for f in fields)))
        part = rows.select(F.lit(name).alias("tbl"), F.col(key).cast("bigint").alias("row_id"), F.col(question).alias("question"), said.alias("r")).select("tbl", "row_id", "question", "r.*")
        parts = part if parts is None else parts.unionByName(part)
    return parts


_JUDGED = "tbl string, row_id bigint, field string, chars int, early string, unended boolean, cut boolean, other boolean, several boolean, shortened boolean, open string, edge string"


def _judge(held):
    """For rows in falling order of the response: a row for each response, and three border texts of each task as ``edge``."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(scorer_of(held))
        text = following = first = None
        row = None
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                keys = list(zip(*(b.column(k).to_pylist() for k in range(3))))
                questions, answers = b.column(3).to_pylist(), b.column(4).to_pylist()
                kept, out = [], []
                for k, (key, q, r) in enumerate(zip(keys, questions, answers)):
                    if (key, r) == row and key[1] is not None:
                        continue  # delivered twice
                    row = (key, r)
                    if r is not None and r != text:
                        text, following = r, text
                        first = r if first is None else first
                    kept.append(k)
                    e = early(q, r)
                    whole_ = bool(r) and (ended(r) or whole_without_end(r))
                    without = bool(r) and not ended(r)
                    own = without and e is None
                    out.append((
                        len(r) if r else 0, e, without, e is None and not whole_, own and several(r), own and shortened(r, following),
                        hashlib.md5(r.encode("utf-8", "surrogatepass")).hexdigest() if own and r == first else None,
                    ))
                judged = [k for k, o in zip(kept, out) if o[1] is None]
                other = dict(zip(judged, judge.foreign([questions[k] for k in judged], [answers[k] for k in judged]))) if judged else {}
                types = (pa.int32(), pa.string(), pa.bool_(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string())
                chars, e, without, cut_, sev, short, open_ = (pa.array([o[n] for o in out], t) for n, t in enumerate(types))
                index = pa.array(kept, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(k).take(index) for k in range(3)), chars, e, without, cut_, pa.array([other.get(k, False) for k in kept], pa.bool_()), sev, short, open_, pa.nulls(len(kept), pa.string())],
                    names=[c.split()[0] for c in _JUDGED.split(", ")],
                )
        edges = list({x for x in (first, text, following) if x is not None})
        if edges:
            none = lambda t: pa.nulls(len(edges), t)
            yield pa.RecordBatch.from_arrays(
                [none(pa.string()), none(pa.int64()), none(pa.string()), none(pa.int32()), none(pa.string()), *(none(pa.bool_()) for _ in range(5)), none(pa.string()), pa.array(edges, pa.string())],
                names=[c.split()[0] for c in _JUDGED.split(", ")],
            )

    return run


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    for b in batches:
        found = [hashlib.md5(t.encode("utf-8", "surrogatepass")).hexdigest() for t, f in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if shortened(t, f)]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["open"])


def signs(rows: DataFrame, model: tuple[list[str], Filter], limit_rows: int = 20, limit_times: int = 8) -> DataFrame:
    """(tbl, row_id, field, chars, early, cut, other, shortened, at_limit): what each response shows."""
    spark = rows.sparkSession
    live = rows.where(~blank(F.col("question"))).select("tbl", "row_id", "field", "question", "response")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    falling = [F.col(c).desc() for c in ("response", "tbl", "field", "row_id")]
    judged = cut(live.repartitionByRange(parts, *falling).sortWithinPartitions(*falling).mapInArrow(_judge(shared(spark, model)), _JUDGED))
    found = judged.where("edge IS NULL").drop("edge")
    # Neighbours across the borders of tasks: the window goes over three texts of a task.
    edges = judged.where("edge IS NOT NULL").select("edge").distinct().withColumn("following", F.lead("edge").over(Window.partitionBy(F.lit(1)).orderBy("edge")))
    across = edges.mapInArrow(_across, "open string").withColumn("beyond", F.lit(True))
    # Length limits: many more texts end at one length than at those around it.
    lengths = found.where("several AND unended").groupBy("tbl", "field", "chars").agg(F.count("*").alias("n"))
    around = Window.partitionBy("tbl", "field").orderBy("chars").rangeBetween(-16, 16)
    limits = lengths.withColumn("others", (F.sum("n").over(around) - F.col("n")) / 32).where((F.col("n") >= limit_rows) & (F.col("n") >= limit_times * F.col("others"))).select("tbl", "field", "chars", F.lit(True).alias("limit"))
    return (
        found.join(across, "open", "left").join(limits, ["tbl", "field", "chars"], "left")
        .withColumn("shortened", F.col("shortened") | F.coalesce("beyond", F.lit(False)))
        .withColumn("at_limit", F.coalesce("limit", F.lit(False)) & F.col("several"))
        .select("tbl", "row_id", "field", "chars", "early", "cut", "other", "shortened", "at_limit")
    )


def defects(rows: DataFrame, model: tuple[list[str], Filter], limit_rows: int = 20, limit_times: int = 8) -> DataFrame:
    """(tbl, row_id, field, defect, sign): a row for each defective response, with the sign that told it."""
    sign = F.coalesce("early", F.when(F.col("shortened"), "shortened").when(F.col("at_limit"), "length limit").when(F.col("cut"), "end").when(F.col("other"), "other_language"))
    defect = F.coalesce("early", F.when(F.col("shortened") | F.col("at_limit") | F.col("cut"), "truncated").when(F.col("other"), "other_language"))
    return signs(rows, model, limit_rows, limit_times).withColumns({"defect": defect, "sign": sign}).where("defect IS NOT NULL").select("tbl", "row_id", "field", "defect", "sign")


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses(
        [
            ("rl_pref", load(spark, sf_dir, "rl_pref"), "pref_id", "prompt", ["response_a", "response_b"]),
            ("sft_default", load(spark, sf_dir, "sft_default"), "row_id", "user_query", ["assistant_response"]),
        ]
    )


def _found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return defects(_rows(spark, sf_dir), fit(load(spark, sf_dir, "documents"), load(spark, sf_dir, "lang_codes")))


@registry.add("p4_found")
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(spark, sf_dir).select("tbl", "row_id", "field", "defect")


@registry.add("p4_rates")
def p4_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many responses of each column have each defect, by the sign that told it."""
    return _found(spark, sf_dir).groupBy("tbl", "field", "defect", "sign").agg(F.count("*").alias("n"))
