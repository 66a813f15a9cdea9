"""Problem 3: text statistics of each record, and whether it is prose, a list, a table or junk.

A text becomes a distribution of its characters over classes: function words, other words, odd words
(no vowels, letters mixed with digits or capitals, the same words over and over), numbers, blanks,
ends of sentences, soft punctuation, marks between cells, symbols, line breaks and the words of items
(short lines with no end of a sentence, no cells and at most one function word). The share of
function words is taken for each language, and the distribution is held against profiles of prose (one
for languages with blanks, two for those without), of lists, of tables and of junk by the
Jensen-Shannon divergence; the nearest profile gives the kind. A mixed text is nearest to what most of
its characters are.

Cases: null and blank texts have no kind and empty statistics. Rows delivered twice count once. Texts
of any length are used whole. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.llm.common import blank, once
from loamline.registry import Registry
from loamline.tables import load

registry = Registry()

#: Frequent function words, without accents, by language.
FUNCTION_WORDS = {
    "en": "the of and to in a is that it was for on are as with his they at be this from have or by one had not but what all were when we there can an your which their said if do will each about how up out them then she many some so these would other into has more her two him than been who its only while because after before since without between both until had must you why i me my our no",
    "de": "der die das und in zu den von ist mit sich des auf fur im dem nicht ein eine einer einem einen als auch es an werden aus er hat dass sie nach wird bei um am sind noch wie uber so zum war haben nur oder aber vor zur bis mehr durch man weil damit obwohl ohne wahrend denn sobald unter wenn wir ich warum wer was dann trotz bevor kein keine niemand",
    "fr": "le la les de des du un une et a en que qui dans pour pas sur plus par ce avec il est au aux se ne sont ont ou mais comme sans sous apres avant pendant bien parce car afin dont leur cette ces son sa ses nous vous je tu elle on ete avait etaient etait malgre l d qu n s c alors que tres trop",
    "es": "el la los las de del un una y a en que por con para no se su al lo como mas pero sus le ya o porque aunque sin sobre despues antes durante mientras muy cuando hasta desde entre era fue eran es son ha han habia nadie ningun todo tras mi me yo",
    "it": "il lo la i gli le di del della dei delle un una e a in che per con non si su al alla da dal come piu ma anche perche dopo prima senza sotto mentre ha hanno era erano sono stato molto troppo nel nella sulla dello degli ai l cui se o nessuno finche appena quando questo",
    "pt": "o a os as de do da dos das um uma e em que por com para nao se no na ao mais como mas foi era eram sem sob apos depois antes durante enquanto porque ainda muito quando ate entre pelo pela seu sua nos nas ou ja ninguem nenhum pois assim embora",
    "nl": "de het een en van in te dat is op voor met zijn niet aan er om ook als maar bij door uit naar nog over dan was werd omdat hoewel zodat zonder onder na tijdens terwijl zodra want geen niemand die deze dit heeft hebben had waren ze we ik hoe waarom wie tot",
    "sv": "och i att det som en ett pa ar av for med till den de inte om har han hon var vid men sa fran efter innan utan under medan eftersom trots fast nar over an kan sig ingen inga detta dessa hade vi jag hur varfor vem sedan ska att mellan sina",
    "pl": "i w na z do ze nie sie o to jest za po przez od dla jak ale oraz przed pod bez gdy choc poniewaz aby zeby bo czy juz tylko jego jej ich byl byla bylo byly tym tej tego ktory ktora zanim podczas nikt zadna zadnej wiec mimo u a",
    "ru": "и в не на что с по как из у за от о к для это но же то при до без под так после перед чтобы потому хотя когда пока уже был была было были он она они его ее их мы я вы ни или только если над во со кто никто ее однако затем",
}
#: Characters that carry grammar in Chinese text.
CHINESE = set("的了在是和不有这那为与上中到就也把被以及对之或但而前后时候因所没很都让给从等")
#: The share of function words in the letters of prose, by the first profile.
FUNCTION_SHARE = 0.23
VOWELS = set("aeiouyıæøœəаеиоуыэюяёіїєαεηιουω")
#: The letters of the scripts whose vowels are known, without accents.
_VOWELLED = re.compile("[a-zа-яёіїєα-ω]")
#: Marks that belong to the letter before them.
MARKS = "".join(chr(c) for c in range(0x300, 0x20000) if unicodedata.category(chr(c)) in ("Mn", "Mc"))

#: The classes, and profiles over them: mean shares of texts of known structure.
CLASSES = ("function", "word", "odd", "number", "blank", "end", "soft", "cell", "symbol", "break", "item")
PROFILES = tuple(
    (kind, np.array(v + [0] * (len(CLASSES) - len(v))) / sum(v))
    for kind, *v in (
        ("prose", 0.188, 0.617, 0, 0.009, 0.164, 0.010, 0.009, 0, 0, 0.004),
        ("prose", 0.180, 0.610, 0, 0.010, 0.156, 0.011, 0.013, 0, 0, 0.020),
        ("prose", 0.075, 0.745, 0, 0.012, 0.130, 0.012, 0.012, 0, 0, 0.003),  # languages that inflect
        ("prose", 0.070, 0.685, 0, 0.012, 0.125, 0.012, 0.012, 0, 0, 0.020, 0.05),
        ("prose", 0.526, 0.405, 0, 0.004, 0.002, 0.050, 0.009, 0, 0, 0.009),  # Japanese
        ("prose", 0.187, 0.722, 0, 0.004, 0.002, 0.047, 0.033, 0, 0, 0.013),  # Chinese
        ("list", 0.020, 0.120, 0, 0.030, 0.126, 0.007, 0.065, 0, 0, 0.051, 0.578),
        ("table", 0, 0.057, 0.001, 0.703, 0.002, 0.005, 0.099, 0.098, 0.002, 0.030),
        ("table", 0.001, 0.091, 0.003, 0.452, 0.198, 0.017, 0.061, 0.145, 0.008, 0.025),
        ("table", 0.004, 0.506, 0.003, 0.295, 0.042, 0.011, 0.016, 0.088, 0.006, 0.028),
        ("table", 0.004, 0.232, 0.008, 0.546, 0.010, 0, 0.063, 0.104, 0, 0.033),
        ("table", 0.005, 0.198, 0.004, 0.542, 0.009, 0.037, 0.045, 0.112, 0.019, 0.029),
        ("table", 0.003, 0.313, 0.003, 0.264, 0.199, 0.013, 0.040, 0.136, 0.007, 0.023),
        ("table", 0.001, 0.145, 0.002, 0.299, 0.022, 0.005, 0.034, 0.475, 0.003, 0.014),
        ("table", 0, 0.004, 0, 0.469, 0.015, 0.007, 0.058, 0.422, 0.004, 0.021),
        ("table", 0.001, 0.273, 0.002, 0.175, 0.029, 0.012, 0, 0.485, 0.006, 0.017),
        ("table", 0.002, 0.067, 0.002, 0.264, 0.005, 0.010, 0.018, 0.612, 0.005, 0.014),
        ("junk", 0.003, 0.594, 0.272, 0, 0.132, 0, 0, 0, 0, 0),  # random letters
        ("junk", 0, 0.006, 0.603, 0.199, 0.158, 0.007, 0.012, 0, 0, 0.015),  # dumps of bytes
        ("junk", 0, 0, 0.983, 0, 0, 0, 0, 0, 0.001, 0.016),  # encoded data, addresses
        ("junk", 0, 0, 0.780, 0.050, 0.160, 0.005, 0, 0, 0.005, 0),  # one phrase over and over
        ("junk", 0, 0, 0, 0.589, 0.121, 0.057, 0.133, 0.041, 0.059, 0),  # random digits
        ("junk", 0, 0, 0, 0, 0.032, 0.102, 0.256, 0.097, 0.514, 0),  # random symbols
        ("junk", 0.094, 0.250, 0.010, 0, 0.036, 0.037, 0.003, 0.038, 0.531, 0),
        ("junk", 0.131, 0.164, 0.236, 0.007, 0.048, 0.005, 0.029, 0, 0.379, 0),  # broken encodings
        ("junk", 0.214, 0.134, 0.055, 0.009, 0.016, 0.001, 0.015, 0, 0.557, 0),
    )
)

_TOKEN = re.compile(r"https?://\S+|</?[a-zA-Z][^<>\n]{0,80}>|[^\W\d_]+(?:[\d+/=&?_" + MARKS + r"]+[^\W\d_]*)*|\d+(?:[^\W_]*[a-zA-Z][^\W_]*)?|[  　]+|.|\n", re.S)
_ENDS = set(".!?…。！？")
_SOFT = set(",;:'\"()-–—«»„“”‘’、，；：（）「」『』[]*•→")
_BY_WORD = {w: sum(1 << k for k, ws in enumerate(FUNCTION_WORDS.values()) if w in ws.split()) for ws in FUNCTION_WORDS.values() for w in ws.split()}


def _plain(word: str) -> str:
    return word if word.isascii() else "".join(c for c in unicodedata.normalize("NFKD", word) if not unicodedata.combining(c))


def _odd(token: str, low: str) -> bool:
    if len(token) < 3:
        return False
    if any(c.isdigit() or c in "+/=&?_" for c in token):
        return True
    if not token.isupper() and sum(c.isupper() for c in token[1:]) > 1:
        return True
    if not _VOWELLED.match(low):  # another script: nothing is known of its vowels or of the length of its words
        return False
    run = most = 0
    vowels = 0
    for c in low:
        if c in VOWELS:
            run, vowels = 0, vowels + 1
        else:
            run += 1
            most = max(most, run)
    return not vowels or most >= 6 or len(low) > 30


def _look(token: str) -> tuple[str, tuple[int, ...], bool, bool]:
    """A word in its plain form, the languages that it is a function word of, whether it is odd, and whether its script has no word list."""
    low = _plain(token.lower())
    mask = _BY_WORD.get(low, 0)
    return low, tuple(j for j in range(len(FUNCTION_WORDS)) if mask >> j & 1), not mask and _odd(token, low), not _VOWELLED.match(low)


#: What a token is: a word, one of a script without blanks, or a class by itself.
_WORD, _WIDE, _PLAIN = range(3)
_known: dict[str, tuple] = {}
MOST_KNOWN, KNOWN_CHARS = 1 << 17, 40  # tokens kept in a process, and how long they may be


def _token(t: str) -> tuple:
    """What a token is wherever it stands; tokens are looked up once in a process."""
    c, size = t[0], len(t)
    if c.isalpha() and not t.startswith(("http://", "https://")):
        o = ord(c)
        if 0x3040 <= o <= 0x30FF or 0x3400 <= o <= 0x9FFF:
            return _WIDE, size, c, sum("぀" <= x <= "ゟ" for x in t), sum(x in CHINESE for x in t)
        low, spoken_in, odd, apart = _look(t)
        return _WORD, size, c, low, spoken_in, "odd" if odd else "word", size if apart and not odd else 0
    if c.isdigit():
        kind = "odd" if size > 3 and not t.isdigit() else "number"
    elif c in "  　":
        kind = "blank"
    elif c in "\t|" or t.startswith("<"):
        kind = "cell"
    elif c in _ENDS:
        kind = "end"
    elif c in _SOFT:
        kind = "soft"
    else:
        kind = "odd" if size > 1 else "symbol"
    return _PLAIN, size, c, kind


class _Line:
    """What makes a line an item."""

    __slots__ = ("size", "words", "function", "last", "cells", "wide", "kana", "chinese")

    def __init__(self) -> None:
        self.size = self.words = self.function = 0
        self.wide = self.kana = self.chinese = 0  # of the line's words, characters of scripts without blanks
        self.last, self.cells = "", False

    def item(self) -> int:
        numbered = self.last in ".;"  # an item may end in one of these all the same, if it is very short
        return self.words if self.size <= (45 if not numbered else 40) and self.last not in "!?…。！？," and not self.cells and self.function <= 1 else 0


def shares(text: str) -> np.ndarray | None:
    """The distribution over ``CLASSES``; None if there is nothing to see."""
    if not text.strip():
        return None
    tokens = _TOKEN.findall(text)
    n = dict.fromkeys(CLASSES, 0)
    by_language = [0] * len(FUNCTION_WORDS)
    spoken: list[str] = []
    before = "\n"
    unlisted = blanks = 0
    line, lines = _Line(), []
    if len(_known) > MOST_KNOWN:
        _known.clear()
    for k, t in enumerate(tokens):
        if t == " ":
            blanks += 1
            line.size += 1
            before = t
            continue
        if t == "\n":
            n["break"] += 1
            lines.append(line)
            line = _Line()
            before = t
            continue
        is_ = _known.get(t)
        if is_ is None:
            is_ = _token(t)
            if is_[1] <= KNOWN_CHARS:
                _known[t] = is_
        size, c = is_[1], is_[2]
        if is_[0] == _WORD:
            _, _, _, low, spoken_in, kind, apart = is_
            spoken.append(low)
            line.size += size
            if spoken_in:
                line.function += 1
                for j in spoken_in:
                    by_language[j] += size
            else:
                line.words += size
            n[kind] += size
            unlisted += apart
            line.last = c
        elif is_[0] == _WIDE:
            line.kana += is_[3]
            line.chinese += is_[4]
            line.wide += size
            line.size += 2 * size
            line.words += size
            line.last = c
        else:
            kind = is_[3]
            line.size += size
            if not c.isspace():
                line.last = c
            if kind == "blank":
                kind = "cell" if size > 1 and before != "\n" else "blank"
            elif c in ",;" and k + 1 < len(tokens) and not tokens[k + 1][0].isspace() and tokens[k + 1][0] not in _SOFT:
                kind = "cell"
            if kind == "cell":
                line.cells = True
            n[kind] += size
        before = c
    n["blank"] += blanks
    lines.append(line)
    most = max(by_language)
    wide, kana, chinese = (sum(getattr(x, c) for x in lines) for c in ("wide", "kana", "chinese"))
    n["word"] += wide
    # Too many function words, or characters of grammar, for items: narrow lines of prose.
    prose = most >= 0.12 * (n["word"] - wide) if n["word"] > wide else True
    wide_prose = kana >= 0.4 * wide or chinese >= 0.12 * wide
    if len(lines) > 1:
        for x in lines:
            if x.item() and not (wide_prose if x.wide > x.words - x.wide else prose):
                n["item"] += x.words
                wide, kana, chinese = wide - x.wide, kana - x.kana, chinese - x.chinese
    grammar = max(kana, chinese) if wide else 0
    # Function words of scripts without word lists aren't known: they are taken for as many as elsewhere.
    grammar += FUNCTION_SHARE * min(unlisted, n["word"] - n["item"] - most - grammar)
    n["word"] -= n["item"] + most + grammar
    n["function"] += most + grammar
    if len(spoken) >= 12:
        triples = set(zip(spoken, spoken[1:], spoken[2:]))
        if len(triples) < max(5, 0.2 * (len(spoken) - 2)):
            n["odd"] += n["word"] + n["function"] + n["item"]
            n["word"] = n["function"] = n["item"] = 0
    v = np.array([n[c] for c in CLASSES], float)
    return v / v.sum() if v.sum() else None


def nearest(text: str | None) -> tuple[str, float] | None:
    """The kind of a text, and how much nearer its profile is than that of any other kind."""
    v = shares(text) if text else None
    if v is None:
        return None
    best: dict[str, float] = {}
    for (kind, _), d in zip(PROFILES, divergence(v, _MATRIX).tolist()):
        best[kind] = min(best.get(kind, 9.0), d)
    first, second = sorted(best.items(), key=lambda x: x[1])[:2]
    return first[0], second[1] - first[1]


_MATRIX = np.array([p for _, p in PROFILES])


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon divergence in bits, of distributions or of rows of them."""
    m = np.maximum((p + q) / 2, 1e-300)
    part = lambda x: (x * np.log2(np.maximum(x, 1e-300) / m)).sum(axis=-1)
    return (part(p) + part(q)) / 2


def kinds(docs: DataFrame, key: str = "rec_id", text: str = "text") -> DataFrame:
    """(key, kind, margin): prose, list, table or junk for each text that isn't blank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [nearest(t) for t in b.column(1).to_pylist()]
            kept = pa.array([i for i, x in enumerate(found) if x], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(kept), pa.array([x[0] for x in found if x], pa.string()), pa.array([x[1] for x in found if x], pa.float64())], names=[key, "kind", "margin"])

    kind = docs.schema[key].dataType.simpleString()
    rows = once(docs.where(~blank(F.col(text))).select(key, text), key)
    return rows.mapInArrow(run, f"`{key}` {kind}, kind string, margin double")


def statistics(docs: DataFrame, key: str = "rec_id", text: str = "text", common: tuple[str, ...] = tuple(FUNCTION_WORDS["en"].split())) -> DataFrame:
    """(key, n_chars, n_words, mean_word, symbols, ended_lines, common_words): shares are rounded to 6 digits."""
    t = F.coalesce(F.col(text), F.lit(""))
    ws = F.filter(F.split(F.lower(t), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"\S"))
    part = lambda n, of: F.round(F.when(of > 0, n / of).otherwise(0.0), 6)
    n, k, chars = F.size("ws"), F.size("lines"), F.char_length("t")
    return (
        once(docs.select(key, text), key)
        .select(key, t.alias("t"), ws.alias("ws"), lines.alias("lines"))
        .select(
            key,
            chars.cast("bigint").alias("n_chars"),
            n.cast("bigint").alias("n_words"),
            part(F.aggregate("ws", F.lit(0), lambda a, w: a + F.char_length(w)), n).alias("mean_word"),
            part(F.char_length(F.regexp_replace("t", r"[\p{L}\p{N}\s]+", "")), chars).alias("symbols"),
            part(F.size(F.filter("lines", lambda x: x.rlike(r"[.!?。！？]\s*$"))), k).alias("ended_lines"),
            part(F.size(F.filter("ws", lambda w: w.isin(*common))), n).alias("common_words"),
        )
    )


@registry.add("p3_found")
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kinds(load(spark, sf_dir, "tiny")).where("kind <> 'prose'").select("rec_id", "kind")


_WORDS = ", ".join(f"'{w}'" for w in FUNCTION_WORDS["en"].split())


@registry.add(
    "p3_statistics",
    rf"""
WITH d AS (SELECT DISTINCT rec_id, coalesce(text, '') AS t FROM tiny),
s AS (SELECT rec_id, t, list_filter(regexp_split_to_array(lower(t), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '\S')) AS ls FROM d)
SELECT rec_id, length(t) AS n_chars, len(ws) AS n_words,
  round(CASE WHEN len(ws) > 0 THEN list_sum(list_transform(ws, lambda w: length(w))) / len(ws) ELSE 0 END, 6) AS mean_word,
  round(CASE WHEN length(t) > 0 THEN length(regexp_replace(t, '[\p{{L}}\p{{N}}\s]+', '', 'g')) / length(t) ELSE 0 END, 6) AS symbols,
  round(CASE WHEN len(ls) > 0 THEN len(list_filter(ls, lambda x: regexp_matches(x, '[.!?。！？]\s*$'))) / len(ls) ELSE 0 END, 6) AS ended_lines,
  round(CASE WHEN len(ws) > 0 THEN len(list_filter(ws, lambda w: w IN ({_WORDS}))) / len(ws) ELSE 0 END, 6) AS common_words
FROM s""",
)
def p3_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics(load(spark, sf_dir, "tiny"))
