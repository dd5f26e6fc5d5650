"""Broken prompt and response pairs, each with its kind of defect.

Checks of a pair alone: an answer that is empty or a filler, that only repeats its question, or
that is written in another language. Checks against all answers:

* Refusals. The clauses of all answers, names and numbers blanked, are clustered by MinHash of
  their word shingles, and clusters verified by the shingles themselves: these are the templates.
  A template that recurs over unrelated prompts, while the answers it stands in bring no name or
  number that their prompt lacks, says nothing on any prompt; an answer that is made of such
  templates only declines. Whether prompts are unrelated is told by how often two of them have a
  MinHash value of their words in common, which counts give for any number of prompts. No phrase
  and no list of words takes part.
* Breaking off. For every beginning of a sentence it is counted how often sentences end there,
  with and without a full stop, or go on. An answer without a full stop is broken off if what
  it begins with, or failing that its last words, mostly goes on elsewhere.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.batches import steps
from sievework.llm.components import connected_components
from sievework.operators.deliveries import without_older
from sievework.session import broadcast_if_small, cut, skew_join

DEFECTS = ("empty", "copied_question", "other_language", "refusal", "truncated")
#: Words of a shingle; least similarity in a cluster; bands, and MinHash rows of each; members of a band that all others are compared with at first.
SHINGLE, SIMILAR, BANDS, BAND_ROWS, HEADS = 5, 0.8, 10, 3, 16
#: Words of an answer up to which its last words alone don't tell that it breaks off.
BRIEF = 6
#: Bytes of answers read at a time; words over which counts are combined before they are sent on.
STEP_BYTES, STEP_WORDS = 6_000_000, 1_000_000

#: Prompts over which a template must recur; least words of an answer that declines; MinHash values of a prompt.
MANY, SENTENCE, PRINTS = 3, 4, 12
#: Prompts are unrelated if on average they share at most this part of their words; or twice what any two
#: prompts of the table share, up to the second figure.
UNRELATED, RELATED = 0.15, 0.5

_TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_][^\W_]*(?:['’][^\W_]+)*|[.!?。](?=[\s\"”’')\]]|$)|[,;:](?=\s|$)")
_PLAIN = re.compile(r"[^\W_]+")
_MARKUP = re.compile(r"<[^<>]*>|&(?:[a-z]+|#\d+);", re.I)
_QUOTED = re.compile(r"[\"“„«]([^\"“”„«»]{1,80})[\"”“»]|(?<!\w)['‘]([^'‘’]{1,80})['’](?!\w)")
_QUOTE = re.compile(r"[\"'“„«‘’]")

#: Words that stand for no answer.
FILLERS = frozenset(
    "none null nil nan na n/a n.a. tbd tba tbc todo empty blank missing undefined void unknown unspecified nothing pending placeholder "
    "answer response reply text a q #value! #ref! #n/a #name? #null! #div/0! no_answer no-answer noanswer xxx xx x lorem ipsum".split()
) | {"no answer", "no response", "no reply", "no data", "no value", "not available", "not applicable", "to be done", "to be added", "to be defined", "to be determined", "to be confirmed", "answer here", "your answer here", "insert answer here", "see above", "keine antwort", "sans réponse", "sin respuesta", "kein text"}

_FILLER_STARTS = {f.split()[0].strip(".,;") for f in FILLERS}

#: Frequent words of languages, for telling them apart.
COMMON = {
    "en": "the of and to in is that it for was on are as with by at be this have from or had not but what all were when we there can an your which their if do will each about how up out them then she many some so these would other into has more her two him see could no than been who its now find made may after under over until must where why does did before near every between only much should they while against whether takes",
    "de": "der die das und ist nicht ein eine einen einem einer den dem des mit auf für von zu sich im auch es an werden aus er hat dass sie nach wird bei noch wie über so zum haben nur oder aber vor zur bis mehr durch man sein wurde sind wenn ihre gibt lässt stehen je wer wann welche wieviel viel gemeinsam danach muss soll seine ihrer diese dieser kann kein keine gegen unter ohne zwischen meist tage wochen",
    "fr": "le la les des est et un une du dans que qui pour pas sur au aux avec par ce cette il elle ne se sont plus ou mais leur ses ont été être sa son comme nous vous tout aussi leurs faut puis près après avant quel quelle combien où quand souvent on peut doit sans entre chez pendant jours semaines ans est-ce",
    "es": "el los las una es y del que se por con para su al lo como más pero sus le ya este sí porque esta entre cuando muy sin sobre también me hasta hay donde quien desde todo nos durante todos uno les ni contra otros ese eso ante ellos cerca después antes qué cuánto cuántos cuánta cuándo cómo dónde cuál casi siempre luego tras junto debe puede días semanas",
    "pt": "os um uma do da dos das em no na nos nas não com por mais ao à às pelo pela são foi também só seu sua seus suas ou quando muito já eu ele isso depois antes até sem mesmo aos ter qual quem onde como quantos quanto dias semanas deve pode cada entre após perto recomendam",
    "it": "il lo gli di che è per una non sono con si da del della dei delle nel nella dal dalla al alla ai agli come più anche ma se questo questa ha o poi viene prima dopo quanto quanti quale quando dove chi fra tra ogni presso giorni settimane deve può senza essere stato all nell dell",
    "nl": "het een van en is dat op te voor met zijn er niet aan ook als dan naar bij uit wordt worden door nog maar om hij zij ze deze dit wat hoe hoeveel wanneer waar welke wie moet kan na daarna gaat dagen weken geen onder tussen elke tegen zonder hun heeft hebben over tot",
    "pl": "się na nie jest że do od po za przed przez dla jak ale czy oraz lub tylko już są być był była było które który która ich jego jej tym tego ten ta te potem dni tygodni ile kiedy gdzie kto jaki jaka jakie każdy między bez pod nad przy może musi co z w i o",
    "sw": "ya na wa kwa ni za la cha katika kuwa hii huo hiyo kama baada kabla kisha watu siku wiki kila yake wake lake zake hadi pia si ndani nini nani lini wapi vipi gani ngapi kiasi lakini au",
    "da": "og det er en et af til på med for som ikke den der de har kan skal fra efter før hvor hvad hvem hvornår dage uger mellem ved blev bliver også eller",
    "ro": "și este nu un o la de în pe cu pentru din care se mai după înainte sunt fost zile săptămâni cât când unde cine fără între prin lui ale",
    "tr": "ve bir bu için ile olarak gün hafta sonra önce ne kadar nasıl nerede kim her daha çok olan değil da de en gibi kadar",
    "id": "yang dan di dari untuk dengan pada ini itu adalah oleh ke dalam tidak akan setelah sebelum hari minggu setiap berapa kapan siapa mana bagaimana juga atau",
}
_LANGS = tuple(COMMON)
_WEIGHT: dict[str, tuple[tuple[int, float], ...]] = {}
for _w in sorted({w for s in COMMON.values() for w in s.split()}):
    _in = [i for i, name in enumerate(_LANGS) if _w in COMMON[name].split()]
    _WEIGHT[_w] = tuple((i, 1.0 / len(_in)) for i in _in)
_ONLY = {w: x[0][0] for w, x in _WEIGHT.items() if len(x) == 1}
#: Letters and signs that few languages use.
MARKS = {"de": "ßü", "fr": "œùêçè", "es": "ñ¿¡", "pt": "ãõ", "it": "ìò", "pl": "ąćęłńśźż", "ro": "șță", "tr": "ğış", "da": "øåæ"}
_MARK = {c: _LANGS.index(name) for name, cs in MARKS.items() for c in cs}
_NO_END = frozenset(
    "the a an of to and or is are was were because which with by for from at as than into onto per via if while when whose until unless "
    "der die das und oder ein eine einen dem den des mit von zu für weil le la les des du et ou un une de pour avec par que qui el los las y o del con para por una "
    "il lo gli di e che per os uma do da em het een van en op voor na w z i do od".split()
) - {"when", "in", "as", "if"}

def _bare(text: str | None) -> str:
    """Without markup, invisible characters and white space at the ends."""
    t = text or ""
    if "<" in t or "&" in t:
        t = _MARKUP.sub(" ", t)
    if not t.isascii():
        t = "".join(c for c in t if unicodedata.category(c) != "Cf")
    return t.strip()


def _is_filler(t: str) -> bool:
    if not any(c.isalnum() for c in t):
        return True
    if len(t) > 40:  # placeholder text, or one filler again and again
        if t.split(None, 1)[0].lower().strip(".,;") not in _FILLER_STARTS:
            return False
        words = t.lower().split()
        return words[:2] == ["lorem", "ipsum"] or 3 * len(each := dict.fromkeys(words)) <= len(words) and " ".join(each).strip(" .,;") in FILLERS
    core = t.strip(" \t\r\n()[]{}<>\"'“”‘’*_-–—.:;,=|").lower()
    return core in FILLERS or t.lower() in FILLERS or f"#{core}" in FILLERS or bool(re.fullmatch(r"(?:answer|response|reply|a)\s*[:=\-]+\s*(?:none|null|n/?a)?", t, re.I))


def is_empty(answer: str | None) -> bool:
    """Null, blank, or only a filler that stands for no answer."""
    return _is_filler(_bare(answer))


def is_copy(question: str | None, answer: str, extra: int = 6) -> bool:
    """Only repeats the question: its words in order, once or more, and at most ``extra`` others around."""
    if not question or 4 * len(answer) < 3 * len(question):
        return False
    q = _PLAIN.findall(_bare(question).lower())
    if len(q) < 3 or q[-1] not in (low := _bare(answer).lower()):
        return False
    whole, a = f" {' '.join(q)} ", f" {' '.join(_PLAIN.findall(low))} "
    return whole in a and len(a.replace(whole, " ").replace(whole, " ").split()) <= extra


def _script(text: str) -> str:
    counts: dict[str, int] = {}
    for c in text:
        if c.isalpha() and not c.isascii():
            name = unicodedata.name(c, "LATIN").split()[0]
            counts[name] = counts.get(name, 0) + 1
    if not counts:
        return "LATIN"
    top = max(counts, key=counts.get)
    return top if top != "LATIN" and counts[top] > sum(c.isascii() and c.isalpha() for c in text) + counts.get("LATIN", 0) else "LATIN"


class _Tokens(dict):
    """What is known of a token, kept while there are not too many: kind (0 number, 1 word, 2 end of a
    sentence, 3 of a clause), lower-cased, random number, whether it looks like a name, its weights for
    languages, the languages it is of alone, the number of its plain words, and itself."""

    def __missing__(self, token: str) -> tuple:
        if len(self) > 200_000:
            self.clear()
        low = token.lower()
        c = token[0]
        kind = 1 if c.isalpha() else 0 if c.isalnum() else 2 if c in ".!?。" else 3
        parts = _PLAIN.findall(low) if kind < 2 else []
        weights = tuple(x for w in parts for x in _WEIGHT.get(w, ()))
        only = tuple(_ONLY[w] for w in parts if w in _ONLY)
        name = kind == 1 and c.isupper() and len(token) > 2 and token[1] not in "'’"
        got = self[token] = (kind, low if kind else "#", xxhash.xxh64_intdigest(low if kind else "#"), name, weights, only, len(parts), token)
        return got


_KNOWN = _Tokens()


def _tokens(text: str) -> list[tuple]:
    return [_KNOWN[t] for t in _TOKEN.findall(text)]


def _language_scores(tokens: list[tuple], text: str) -> tuple[str, list[float], int]:
    scores, n = [0.0] * len(_LANGS), 0
    for _, _, _, _, weights, _, parts, _ in tokens:
        n += parts
        for i, x in weights:
            scores[i] += x
    if text.isascii():
        return "LATIN", scores, n
    for c in text:
        i = _MARK.get(c)
        if i is not None:
            scores[i] += 0.5
    return _script(text), scores, n


def _unquoted(text: str) -> str:
    return _QUOTED.sub(" ", text) if _QUOTE.search(text) else text


def language_scores(text: str) -> tuple[str, list[float], int]:
    """Script, a score per language of COMMON, and the number of words; quoted phrases and names are left out."""
    t = _unquoted(text)
    return _language_scores(_tokens(t), t)


def _speaks(tokens: list[tuple], language: int, enough: int = 3) -> bool:
    """Whether some words of one language alone turn up."""
    seen = 0
    for x in tokens:
        if x[5] and language in x[5]:
            seen += 1
            if seen == enough:
                return True
    return False


def _other_language(q: str, asked: list[tuple], answer: str, said: list[tuple], end: int) -> tuple[bool, int]:
    """other_language() of a pair that is cut into tokens, and the answer's likeliest language."""
    bare = _unquoted(answer)
    if end == -1:  # what comes right before the break may be anything
        bare = _unquoted(" ".join(answer.split()[:-3]))
    s, a, n = _language_scores(said if bare is answer else _tokens(bare), bare)
    top = max(a)
    best = a.index(top)
    if s != "LATIN" and q and _script(q) != s:  # by letters, as some scripts set no spaces
        return sum(map(str.isalpha, bare)) >= 4 and any(c.isalpha() for c in q), best
    if end < 1 and n < 7:  # the beginning of a sentence tells too little
        return False, best
    if s == "LATIN" and top < 1.5:
        return bool(q) and not q.isascii() and _script(q) != s and n >= 2, best
    if s == "LATIN" and _speaks(asked, best):
        return False, best
    bare = _unquoted(q)
    qs, b, _ = _language_scores(asked if bare is q else _tokens(bare), bare)
    if s != qs:
        return n >= 2 and any(c.isalpha() for c in q), best
    if s != "LATIN":
        return False, best
    own = max(range(len(b)), key=b.__getitem__)
    if b[own] < 1.5 or best == own or b[best] >= 0.8 * b[own]:  # the question may be in that language as well
        return False, best
    return a[own] <= 0.7 * top and top - a[own] >= 0.9 and top / max(n, 1) >= 0.1, best


def other_language(question: str | None, answer: str) -> bool:
    """Whether the answer is in another language than the question, by its frequent words or its script."""
    q = question or ""
    return _other_language(q, _tokens(q), answer, _tokens(answer), stopped(answer))[0]


def read_tokens(tokens: list[tuple], shouted: bool, names: set[str], question: str = "", blank: bool = True) -> tuple[list[str], list[int], list[int], bool, bool]:
    """Words of a text for comparison, the number of words up to the end of each sentence and of each
    clause, whether the last sentence has an end, and whether a number or name is not in the question.

    Numbers become #; names of the question, and words with a capital within a sentence, become @
    (the latter only if ``blank``, and only then can be told whether they are new); all others are lower-cased.
    """
    out: list[str] = []
    ends: list[int] = []
    clauses: list[int] = []
    first, new, at, last = True, False, 0, 0
    blank = blank and not shouted
    for kind, low, _, name, _, _, _, token in tokens:
        if kind == 1:
            if low in names:
                out.append("@")
            elif name and blank and not first:
                out.append("@")
                new = new or token not in question
            else:
                out.append(low)
            first = False
        elif kind == 0:
            out.append("#")
            first = False
            new = new or token not in question
        else:
            size = len(out)
            if size > at:
                clauses.append(size)
                at = size
            if kind == 2:
                first = True
                if size > last:
                    ends.append(size)
                    last = size
    size = len(out)
    whole = bool(ends) and last == size
    if size > at:
        clauses.append(size)
    if size > last:
        ends.append(size)
    return out, ends, clauses, whole, new


def stopped(answer: str) -> int:
    """1 if the answer ends as a sentence does, -1 if it plainly breaks off, 0 if its words must tell."""
    t = answer.rstrip("*_`| ")
    end = t.rstrip("\"”’'»")
    if end.endswith(("…", "...", ",", ";", ":", "-", "–", "—", "(", "[", "“", "„", "/", "&")):
        return -1
    tail = t[max(t.rfind(x) for x in (". ", "! ", "? ", "\n")) + 1 :]
    if tail.count("(") > tail.count(")") or tail.count("[") > tail.count("]"):
        return -1
    if tail.count("„") > tail.count("“") if "„" in tail else tail.count("“") > tail.count("”"):
        return -1
    if end.endswith((".", "!", "?", "。", "؟")) or t.endswith(")") and end[-2:-1] in ".!?":
        return 1
    words = _PLAIN.findall(end[-40:])
    return -1 if len(words) > 1 and words[-1] in _NO_END else 0


_PAIR = pa.schema([("kind", pa.int8()), ("id", pa.int64()), ("flag", pa.int8()), ("answerable", pa.bool_()), ("clauses", pa.list_(pa.int64())), ("prints", pa.binary()), ("aside", pa.bool_()), ("keys", pa.list_(pa.int64())), ("word", pa.string()), ("key", pa.int64()), ("stops", pa.int64()), ("halts", pa.int64()), ("goes_on", pa.int64())])
_DDL = "kind tinyint, id bigint, flag tinyint, answerable boolean, clauses array<bigint>, prints binary, aside boolean, keys array<bigint>, word string, key bigint, stops bigint, halts bigint, goes_on bigint"


def _batch(**columns: object) -> pa.RecordBatch:
    types = {f.name: f.type for f in _PAIR}
    made = {k: v if isinstance(v, pa.Array) else pa.array(v, types[k]) for k, v in columns.items()}
    n = len(next(iter(made.values())))
    return pa.record_batch([made.get(f.name, pa.nulls(n, f.type)) for f in _PAIR], schema=_PAIR)


_POS = np.array([xxhash.xxh64_intdigest(f"at {i}") | 1 for i in range(4096)], np.uint64)
_FIRST, _BLANK = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x5851F42D4C957F2D)
_G3, _G2 = (np.array([xxhash.xxh64_intdigest(f"{g} {i}") | 1 for i in range(g)], np.uint64) for g in (3, 2))


def _keys(h: np.ndarray, pos: np.ndarray, first: np.ndarray, name: int) -> list[np.ndarray]:
    """At every word: a key of its sentence up to here, of that with the first word blanked, of the
    last three words, and of the last two (0: not so many). First sentences have keys of their own."""
    mult = _POS[pos % len(_POS)] * (pos.astype(np.uint64) // np.uint64(len(_POS)) + np.uint64(1))
    run = np.cumsum(h * mult)
    start = np.arange(len(h)) - pos
    begin = run - np.where(start > 0, run[start - 1], np.uint64(0))
    begin = np.where(first, begin * _FIRST, begin)
    blank = np.where(first & (pos > 0), begin - (h[start] - np.uint64(name)) * _POS[0] * _FIRST, np.uint64(0)) ^ _BLANK
    blank[~(first & (pos > 0))] = 0
    g2, g3 = np.zeros(len(h), np.uint64), np.zeros(len(h), np.uint64)
    g2[1:] = np.where(pos[1:] >= 1, h[1:] * _G2[0] + h[:-1] * _G2[1], np.uint64(0))
    g3[2:] = np.where(pos[2:] >= 2, h[2:] * _G3[0] + h[1:-1] * _G3[1] + h[:-2] * _G3[2], np.uint64(0))
    return [begin, blank, g3, g2]


_SALT = np.array([xxhash.xxh64_intdigest(f"print {i}") | 1 for i in range(PRINTS)], np.uint64)


def prompt_prints(codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """MinHash values, of 16 bits, of prompts with so many words each (one at least); a row a prompt."""
    starts = np.cumsum(sizes) - sizes
    out = np.empty((len(sizes), PRINTS), "<u2")
    for j in range(PRINTS):
        h = codes * _SALT[j]
        h ^= h >> np.uint64(32)
        h *= _FIRST
        out[:, j] = np.minimum.reduceat(h, starts) >> np.uint64(32) & np.uint64(0xFFFF) if len(sizes) else 0
    return out


def _lead(tokens: list[tuple]) -> int:
    """Tokens of what may lead in a first sentence: up to four words and a comma, or "note that"."""
    for i, x in enumerate(tokens[:5]):
        if x[0] != 1:
            return i + 1 if i and x[1] == "," and len(tokens) > i + 1 else 0
    return 2 if [x[1] for x in tokens[:2]] == ["note", "that"] and len(tokens) > 2 else 0


class _Counts:
    """What is counted over the answers of a task, until it is sent on."""

    def __init__(self) -> None:
        self.hashes: list[np.ndarray] = []  # keys of words and what came after each
        self.slots: list[np.ndarray] = []
        self.words: Counter[str] = Counter()
        self.clauses: dict[str, list[int]] = {}  # text: number, uses, and those in answers that bring nothing
        self.prints: list[np.ndarray] = []
        self.size = 0

    def send(self) -> Iterator[pa.RecordBatch]:
        """Kind 1: counts of keys. Kind 2: words. Kind 3: clauses. Kind 4: MinHash values of prompts."""
        if self.hashes:
            every, slots = np.concatenate(self.hashes), np.concatenate(self.slots)
            unique, back = np.unique(every, return_inverse=True)
            counts = [pa.array(np.bincount(back[slots == k], minlength=len(unique)).astype(np.int64)) for k in range(3)]
            yield _batch(kind=pa.array(np.ones(len(unique), np.int8)), key=pa.array(unique.view(np.int64)), stops=counts[0], halts=counts[1], goes_on=counts[2])
        if self.words:
            yield _batch(kind=pa.array(np.full(len(self.words), 2, np.int8)), word=list(self.words), stops=list(self.words.values()))
        if self.clauses:
            numbers, n, asides = zip(*self.clauses.values())
            yield _batch(kind=pa.array(np.full(len(n), 3, np.int8)), word=list(self.clauses), key=numbers, stops=n, halts=asides)
        if self.prints:
            every = np.concatenate(self.prints).astype(np.int64) + (np.arange(PRINTS) << 16)
            value, n = np.unique(every, return_counts=True)
            yield _batch(kind=pa.array(np.full(len(n), 4, np.int8)), key=value, stops=n.astype(np.int64))
        self.__init__()


def _number(clause: str) -> int:
    n = xxhash.xxh64_intdigest(clause)
    return n - (1 << 64) if n >> 63 else n


class _Codes(dict):
    """Random numbers of the words that read_tokens() gives, kept while there are not too many."""

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        n = self[word] = xxhash.xxh64_intdigest(word)
        return n


def _copies(q: str, asked: list[tuple], t: str) -> bool:
    """is_copy(), tried only where the question's last word turns up in the answer."""
    if 4 * len(t) < 3 * len(q):
        return False
    last = next((x[1] for x in reversed(asked) if x[0] < 2), "")
    return (not last.isalpha() or last in t.lower()) and is_copy(q, t)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kind 0: a pair with what can be said of it alone (stops: words of its answer). Other kinds: see _Counts."""
    counts, known, code_of = _Counts(), _KNOWN, _Codes()
    name_code = code_of["@"]
    german = _LANGS.index("de")
    for batch in steps(batches, 2, STEP_BYTES):
        ids, questions, answers, able = (batch.column(i).to_pylist() for i in range(4))
        flags, clauses, asides, last_words, lengths, asked_at = [], [], [], [], [], []
        said_all: list[str] = []
        sentence: list[int] = []  # words of each sentence
        opening: list[bool] = []  # whether it is its answer's first
        stop: list[int] = []  # 0 if it ends with a stop, 1 if it just ends
        codes: list[int] = []
        sizes: list[int] = []
        seen_clauses = counts.clauses
        for row, (q, a) in enumerate(zip(questions, answers)):
            flag, own, aside, word, length = -1, None, False, None, None
            q = q or ""
            t = _bare(a)
            asked = [known[x] for x in _TOKEN.findall(q)]
            names = set() if q.isupper() else {x[1] for x in asked[1:] if x[3]}
            before = len(codes)
            codes += [x[2] for x in asked if x[0] == 1 and x[1] not in names]
            sizes.append(len(codes) - before)
            if _is_filler(t):
                flag = 0
            elif _copies(q, asked, t):
                flag = 1
            else:
                said = [known[x] for x in _TOKEN.findall(t)]
                end = stopped(t)
                other, language = _other_language(q, asked, t, said, end)
                if other:
                    flag = 2
            if flag < 0:
                shouted = t.isupper()
                tokens, ends, cuts, whole, new = read_tokens(said, shouted, names, q)
                if tokens:
                    parts = tokens
                    if language == german:  # names can't be told there
                        parts, _, _, _, new = read_tokens(said, shouted, names, q, False)
                    aside = not new and len(tokens) >= SENTENCE
                    stops = aside and end == 1
                    own, low = [], 0
                    for c in cuts:
                        clause = " ".join(parts[low:c])
                        seen = seen_clauses.get(clause)
                        if seen is None:
                            seen = seen_clauses[clause] = [_number(clause), 0, 0]
                        seen[1] += 1
                        seen[2] += stops
                        own.append(seen[0])
                        low = c
                    lead = _lead(said)
                    if lead:
                        tokens, ends, cuts, whole, _ = read_tokens(said[lead:], shouted, names)
                if tokens:
                    said_all += tokens
                    low = 0
                    for e in ends:
                        sentence.append(e - low)
                        opening.append(not low)
                        stop.append(0)
                        low = e
                    if not whole:
                        stop[-1] = 1
                if end == -1:
                    flag = 4
                elif end == 0 and tokens:
                    word, length = tokens[-1], len(tokens)
                    asked_at.append((row, len(said_all) - 1))
            flags.append(flag)
            clauses.append(own)
            last_words.append(word)
            lengths.append(length)
            asides.append(aside)
        keys: list[list[int] | None] = [None] * len(ids)
        if said_all:
            n = np.array(sentence, np.int64)
            after = np.cumsum(n)
            p = np.arange(len(said_all)) - np.repeat(after - n, n)
            s = np.full(len(said_all), 2, np.int8)
            s[after - 1] = stop
            kinds = _keys(np.fromiter(map(code_of.__getitem__, said_all), np.uint64, len(said_all)), p, np.repeat(np.array(opening, bool), n), name_code)
            ago = [np.where(p > 0, np.r_[np.zeros(1, np.uint64), k[:-1]], np.uint64(0)) for k in kinds]
            for row, i in asked_at:  # what is said up to the last word, and up to the one before
                keys[row] = np.array([*(k[i] for k in kinds), *(k[i] for k in ago)], np.uint64).view(np.int64).tolist()
            counts.hashes += [k[k != 0] for k in kinds]
            counts.slots += [s[k != 0] for k in kinds]
            counts.words.update(said_all)
            counts.size += len(said_all)
        n = np.array(sizes, np.int64)
        made = prompt_prints(np.array(codes, np.uint64), n[n > 0])
        counts.prints.append(made)
        raw, at = made.tobytes(), iter(range(len(made)))
        prints = [None if not k else raw[(i := next(at)) * 2 * PRINTS : (i + 1) * 2 * PRINTS] for k in sizes]
        yield _batch(kind=pa.array(np.zeros(len(ids), np.int8)), id=ids, answerable=able, flag=flags, clauses=clauses, prints=prints, aside=asides, keys=keys, word=last_words, stops=lengths)
        if counts.size > STEP_WORDS:
            yield from counts.send()
    yield from counts.send()


def _clusters(clauses: DataFrame) -> DataFrame:
    """``key, cluster``: verified MinHash clusters of distinct clauses ``key, word``, named by their least key.

    Shingles of five words; of shorter clauses, the whole. In a band, the clauses are compared
    with up to HEADS of them; then with some of those that were not similar, four times as many each round,
    until every one is similar to one that it was compared with. Links are followed to their end.
    """
    w = F.split("word", " ")
    n = F.greatest(F.size(w) - SHINGLE + 1, F.lit(1))
    shingles = F.array_distinct(F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(F.array_join(F.slice(w, i, SHINGLE), " "))))
    sets = cut(clauses.select("key", shingles.alias("s")))
    salted = lambda j: lambda x: F.xxhash64(F.lit(j), x)  # noqa: E731 - a second parameter would be taken for the place in the array
    mins = [F.array_min(F.transform("s", salted(j))) for j in range(BANDS * BAND_ROWS)]
    bands = F.array(*[F.xxhash64(F.lit(b), *mins[b * BAND_ROWS : (b + 1) * BAND_ROWS]) for b in range(BANDS)])
    rows = sets.select("key", "s", F.explode(bands).alias("band"))
    several = rows.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1").select("band")
    rows = cut(rows.join(broadcast_if_small(cut(several)), "band", "left_semi"))
    links, left, many = None, rows, HEADS
    while not left.isEmpty():
        lot = F.pmod(F.xxhash64("key", "band"), F.lit(many))
        heads = cut(left.groupBy("band", lot.alias("lot")).agg(F.min_by("s", "key").alias("hs"), F.min("key").alias("head")).drop("lot"))
        many *= 4
        common = F.size(F.array_intersect("s", "hs"))
        alike = F.col("key").eqNullSafe(F.col("head")) | (common >= SIMILAR * (F.size("s") + F.size("hs") - common))
        found = cut(skew_join(rows, heads, ["band"]).filter(alike).select("key", "head", "band"))
        links = found if links is None else links.unionByName(found)
        left = cut(left.join(found.select("key", "band"), ["key", "band"], "left_anti"))
    edges = clauses.select("key", F.col("key").alias("head"))
    if links is not None:
        edges = links.select("key", "head").distinct().unionByName(edges)
    return connected_components(edges, "key", "head").select(F.col("node").alias("key"), F.col("component").alias("cluster"))


def templates(read: DataFrame) -> DataFrame:
    """``cluster, key, word, uses, prompts, shared, recurs``: the clauses of answers that bring nothing,
    their clusters, and how much of their words the prompts of a cluster share on average.

    The mean similarity of a cluster's prompts is how often two of them have equal MinHash
    values, which follows from counts of the values; no pairs are made.
    """
    # asides of clauses: uses in answers that bring nothing and end as a sentence does
    clauses = cut(read.filter("kind = 3").groupBy("key", "word").agg(F.sum("stops").alias("uses"), F.sum("halts").alias("asides")))
    idle = cut(clauses.filter("2 * asides >= uses"))
    member = cut(idle.join(_clusters(idle.select("key", "word")), "key"))
    rows = read.filter("kind = 0 and clauses is not null and prints is not null")
    used = skew_join(rows.select("prints", F.explode(F.array_distinct("clauses")).alias("key")), member.select("key", "cluster"), ["key"])
    digits = F.hex("prints")
    values = F.posexplode(F.array(*[F.substring(digits, 4 * j + 1, 4) for j in range(PRINTS)])).alias("at", "value")
    counted = used.select("cluster", values).groupBy("cluster", "at", "value").agg(F.count("*").alias("n"))
    shared = counted.groupBy("cluster").agg(F.sum(F.col("n") * (F.col("n") - 1)).alias("equal"), (F.sum("n") / PRINTS).cast("bigint").alias("prompts"))
    shared = shared.withColumn("shared", F.col("equal") / F.lit(PRINTS) / F.nullif(F.col("prompts") * (F.col("prompts") - 1), F.lit(0)))
    every = read.filter("kind = 4").groupBy("key").agg(F.sum("stops").cast("double").alias("n"))
    n, equal = every.agg(F.coalesce(F.sum("n"), F.lit(0.0)), F.coalesce(F.sum(F.col("n") * (F.col("n") - 1)), F.lit(0.0))).first()
    n /= PRINTS
    usual = equal / PRINTS / (n * (n - 1)) if n > 1 else 0.0
    limit = max(UNRELATED, min(RELATED, 2 * usual))
    recurs = (F.col("prompts") >= MANY) & (F.col("shared") <= limit)
    named = member.join(broadcast_if_small(cut(shared.select("cluster", "prompts", "shared", F.coalesce(recurs, F.lit(False)).alias("recurs")))), "cluster")
    return named.select("cluster", "key", "word", "uses", "prompts", "shared", "recurs")


def refusals(read: DataFrame) -> DataFrame:
    """``id`` of answers that are made of templates only that recur over unrelated prompts, and bring nothing."""
    recurring = cut(templates(read).filter("recurs").select("key"))
    asides = read.filter("kind = 0 and aside and answerable").select("id", F.array_distinct("clauses").alias("clauses"))
    parts = asides.select("id", F.xxhash64("clauses").alias("said"), F.size("clauses").alias("n"), F.explode("clauses").alias("key"))
    return skew_join(parts, recurring, ["key"]).groupBy("id", "said", "n").agg(F.count("*").alias("found")).filter("found % n = 0").select("id").distinct()


def _breaks(at: int, otherwise: Column) -> Column:
    """Whether sentences go on after key ``at`` rather than end; ``otherwise`` where too little tells."""
    s, h, g = (F.col(f"{c}{at}") for c in "shg")
    enough = (s + h + g >= 2) | (g == 0) & (s + h >= 1) if at < 2 else s + h + g >= 2
    return F.when((g >= 2) & (g > 4 * s) & (g > 4 * h), True).when(enough & ((4 * s >= g) | (2 * h >= g) | (g >= 8)), False).otherwise(otherwise)


def broken_off(read: DataFrame) -> DataFrame:
    """``id`` of answers without a full stop whose words go on elsewhere."""
    asked = read.filter("kind = 0 and keys is not null").select("id", "word", F.col("stops").alias("length"), F.posexplode("keys").alias("at", "key")).filter("key <> 0")
    wanted = cut(asked.select("key").distinct())
    counted = read.filter("kind = 1").select("key", "stops", "halts", "goes_on").join(broadcast_if_small(wanted), "key", "left_semi")
    counts = cut(counted.groupBy("key").agg(F.sum("stops").alias("s"), F.sum("halts").alias("h"), F.sum("goes_on").alias("g")))
    words = cut(read.filter("kind = 2").groupBy("word").agg(F.sum("stops").alias("n")))
    known = cut(words.filter("n >= 3").select("word", "n", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.length("word") - 1, F.lit(1))), lambda i: F.substring("word", F.lit(1), i))).alias("part")).filter("part <> word").groupBy("part").agg(F.sum("n").alias("longer")))
    wide = asked.join(broadcast_if_small(counts), "key", "left")
    n = lambda at, c, less=0: F.greatest(F.coalesce(F.max(F.when(F.col("at") == at, F.col(c))) - less, F.lit(0)), F.lit(0))
    # the answer itself was counted as halting
    row = wide.groupBy("id", "word", "length").agg(*[n(i, c, int(c == "h" and i < 4)).alias(f"{c}{i}") for i in range(8) for c in "shg"])
    row = row.join(broadcast_if_small(known), F.col("word") == F.col("part"), "left").join(broadcast_if_small(words.join(known.select(F.col("part").alias("word")), "word", "left_semi")), "word", "left")
    rare = (F.col("s0") + F.col("g0") + F.col("s2") + F.col("g2") == 0) & (F.coalesce("n", F.lit(0)) * 10 < F.col("longer"))
    within_word = rare & (F.col("longer") >= 3) & (F.greatest("g4", "g5", "g6", "g7") >= 3)
    ends = (F.col("s2") >= 10) & (F.col("s2") > 10 * F.col("g2"))  # the last three words end sentences
    verdict = F.when(within_word, True).when(ends, False).otherwise(_breaks(0, _breaks(1, F.when(F.col("length") > BRIEF, _breaks(2, F.lit(False))).otherwise(False))))
    return row.filter(verdict).select("id").distinct()


def read_pairs(df: DataFrame, id_col: str, question: str, answer: str, answerable: Column, delivered: Column | None = None) -> DataFrame:
    """What find_defects() reads from the pairs, in one pass over their texts."""
    pairs = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{question}`").cast("string").alias("q"), F.col(f"`{answer}`").cast("string").alias("a"), F.coalesce(answerable, F.lit(True)).alias("able"), (F.lit(0) if delivered is None else delivered).alias("late")).filter("id is not null")
    if delivered is not None:
        pairs = without_older(pairs, "id", F.col("late"))
    return cut(pairs.drop("late").mapInArrow(_read, _DDL))


def find_defects(df: DataFrame, id_col: str, question: str, answer: str, answerable: Column, *, delivered: Column | None = None) -> DataFrame:
    """``pair_id, defect``: the pairs that are broken, each id once, with the first kind that applies.

    Order of kinds: empty, copied_question, other_language, refusal, truncated. A refusal
    is a defect only where ``answerable`` is true or null. Null answers are empty; a null
    question has no words, so nothing copies it and nothing is in another language. Rows of
    one id that come again give one row; ids that are null are left out. An empty table gives
    an empty result. Answers are read whole. Other columns of ``df`` are never looked at.

    Of an id that comes again the latest row by ``delivered`` holds; without that, every row
    counts and the first kind of all of them is given.
    """
    read = read_pairs(df, id_col, question, answer, answerable, delivered)
    broken = cut(broken_off(read))
    # flags are the places of DEFECTS
    alone = read.filter("kind = 0 and flag >= 0").select("id", "flag")
    found = alone.unionByName(refusals(read).select("id", F.lit(3).cast("tinyint").alias("flag"))).unionByName(broken.select("id", F.lit(4).cast("tinyint").alias("flag")))
    names = F.array(*[F.lit(d) for d in DEFECTS])
    return found.groupBy("id").agg(F.min("flag").alias("flag")).select(F.col("id").alias("pair_id"), F.element_at(names, F.col("flag").cast("int") + 1).alias("defect"))
