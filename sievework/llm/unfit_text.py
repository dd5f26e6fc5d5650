"""Abusive, hateful and sexual text: a linear classifier on character n-grams.

After Wang and Manning, "Baselines and Bigrams: Simple, Good Sentiment and Topic
Classification" (ACL 2012): the count of each n-gram in a sentence is scaled by its naive Bayes
log-count ratio, and sentences to unit length, before a regularised logistic regression. Labels
stand for documents, of which mostly one sentence is unfit; so a document labelled with a category
gives the sentence that the last round's model finds most like it (at first: the sum of log-count
ratios), and documents labelled as fit give a fifth of their sentences, by lot, and all that the
last round finds somewhat unfit. A document scores as its worst sentence.

Before that, disguises are undone: letters of other scripts that look Latin, digits and signs
for letters, letters set apart, invisible characters, and letters repeated.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.session import broadcast_if_small, cut

CATEGORIES = ("abusive", "hateful", "sexual")
FIT = "none"
#: Labelled documents that a model is fitted on, chosen by the least hash of their id.
MAX_LABELLED = 20_000
#: Characters of their texts at most; documents beyond are left out of the fit, in the same order.
MAX_FIT_CHARS = 40_000_000
#: One in so many sentences of fit documents takes part from the beginning, at any size; all that score so much join.
FIT_SHARE, SOMEWHAT = 5, 0.1
#: Hashed n-grams; lengths of n-grams; characters that a step scores at a time.
BITS, ORDERS, STEP_CHARS = 18, (3, 4, 5), 1_000_000
#: A document's label is doubted if its best sentence scores as low as so large a share of the fit documents does.
DOUBTFUL = 0.97
#: Parts of the labelled documents; each is looked at by a model of the others.
FOLDS = 5

#: Cyrillic and Greek letters that look like Latin ones.
_LOOK = str.maketrans("аеорсухіјѕԁһԛԝкмнтвզαειοκνρτυχ", "aeopcyxijsdhqwkmhtbzaeioknptux")
#: Digits and signs that stand for letters.
_LEET = str.maketrans("013457@$!", "oieastasi")
_APART = re.compile(r"(?<![^\W\d_])[^\W\d_](?:([ .\-_*·])[^\W\d_])(?:\1[^\W\d_])+(?![^\W\d_])")
_REPEATED = re.compile(r"([^\W\d_])\1{2,}")
_MIXED = re.compile(r"[\w@$!]*[^\W\d_][\w@$!]*")
#: Classes of ASCII bytes: letters, and what may stand for one; letters, and all else.
_SIGNS = bytes(97 if chr(i).isalpha() and i < 128 else 48 if chr(i) in "0123456789@$!_" else 32 for i in range(256))
_LETTERS = bytes(97 if chr(i).isalpha() and i < 128 else 32 for i in range(256))
#: Whether digits or signs stand beside letters.
_MAYBE = re.compile(r"[0-9@$!_][^\W\d_]|[^\W\d_][@$]")
_FOREIGN = re.compile("[Ͱ-֏]")
#: Invisible and combining characters.
_UNSEEN = re.compile("[" + "".join(re.escape(c) for c in map(chr, range(0x10000)) if c not in "\t\n" and unicodedata.category(c) in ("Cf", "Mn", "Cc")) + "]")
_DIGITS = re.compile(r"\d[\d.,]*")


def _unleet(m: re.Match) -> str:
    w = m.group(0)
    core = w.rstrip("!")
    if core.isalpha() or core.rstrip("0123456789").isalpha():  # a word, or a name with a number
        return w
    return core.translate(_LEET) + w[len(core) :]


def _undisguised(text: str) -> str:
    """A text without disguises, lower-cased, numbers as #; line ends stay."""
    s = text.lower()
    if s.isascii():  # the patterns are tried only where they may match
        raw = s.encode()
        apart = b" a a a " in b" %b " % raw.translate(_LETTERS)
        mixed = b"0a" in (signs := raw.translate(_SIGNS)) or b"a0" in signs and ("@" in s or "$" in s)
        c = np.frombuffer(raw, np.uint8)
        repeated = bool(((c[2:] == c[1:-1]) & (c[1:-1] == c[:-2]) & (c[2:] > 96)).any())
    else:
        s = _UNSEEN.sub("", unicodedata.normalize("NFKC", text).lower())
        if _FOREIGN.search(s):
            s = s.translate(_LOOK)
        apart = repeated = True
        mixed = bool(_MAYBE.search(s))
    if apart:
        s = _APART.sub(lambda m: m.group(0).replace(m.group(1), ""), s)
    if mixed:
        s = _MIXED.sub(_unleet, s)
    if repeated:
        s = _REPEATED.sub(r"\1", s)
    return _DIGITS.sub("#", s)


def normalise(sentence: str) -> str:
    """A sentence without disguises, lower-cased, numbers as #."""
    return " ".join(_undisguised(sentence).split())


def sentences(text: str | None) -> list[str]:
    """Normalised sentences of a whole text, without empty ones."""
    if not text:
        return []
    lines = "\n".join([" ".join(x.split()) for x in text.splitlines()])
    parts = lines.replace(". ", ".\n").replace("! ", "!\n").replace("? ", "?\n")
    return [n for s in _undisguised(parts).split("\n") if (n := " ".join(s.split()))]


def _grams(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams at every character of the sentences (rows: ORDERS; 1 << BITS where one would
    reach into the next sentence), and where each sentence begins."""
    joined = "\n " + " \n ".join(parts) + " \n"
    code = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    starts = np.flatnonzero(code == 10)
    size = len(code)
    to_end = np.empty(size, np.int64)  # characters up to the end of the sentence
    to_end[: starts[-1]] = np.repeat(starts[1:], np.diff(starts))
    to_end[starts[-1] :] = 0
    to_end -= np.arange(size)
    to_end[starts] = 0
    out = np.full((len(ORDERS), size), 1 << BITS, np.int32)
    h = np.zeros(size, np.uint32)
    for n in range(1, ORDERS[-1] + 1):
        left = size - n + 1
        if left < 1:
            break
        h = (h[:left] ^ code[n - 1 :]) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        if n in ORDERS:
            mixed = h * np.uint32(0x85EBCA6B + 2 * n) >> np.uint32(32 - BITS)
            out[ORDERS.index(n), :left] = np.where(to_end[:left] >= n, mixed, 1 << BITS)
    return out, starts[:-1]


def features(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all sentences, sorted by sentence, and the sentence of each."""
    grams, starts = _grams(parts)
    of = np.repeat(np.arange(len(starts), dtype=np.int32), np.diff(np.r_[starts, grams.shape[1]]))
    flat, rows = grams.T.ravel(), np.repeat(of, len(ORDERS))
    real = flat < 1 << BITS
    return flat[real], rows[real]


def _ratio(cols: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Naive Bayes log-count ratio of every n-gram."""
    dim = 1 << BITS
    p, q = np.bincount(cols[pos], minlength=dim) + 1.0, np.bincount(cols[~pos], minlength=dim) + 1.0
    return np.log((p / p.sum()) / (q / q.sum())).astype(np.float32)


class _Entries:
    """Counts of n-grams in sentences, sorted by sentence and also by n-gram, for quick sums either way.

    N-grams of a single sentence are left out, as they tell nothing of another.
    """

    def __init__(self, cols: np.ndarray, rows: np.ndarray, n: int) -> None:
        key, times = np.unique(rows.astype(np.int64) << BITS | cols, return_counts=True)
        row, col = (key >> BITS).astype(np.int32), (key & (1 << BITS) - 1).astype(np.int32)
        keep = np.bincount(col, minlength=1 << BITS)[col] > 1
        self.row, self.times, self.n = row[keep], times[keep].astype(np.float32), n
        self.used, self.col = np.unique(col[keep], return_inverse=True)
        self.col = self.col.astype(np.int32)
        self.by_col = np.argsort(self.col, kind="stable").astype(np.int32)
        self.row_c = self.row[self.by_col]
        self.row_at, self.col_at = np.flatnonzero(np.r_[True, np.diff(self.row) > 0])[: len(self.row)], np.flatnonzero(np.r_[True, np.diff(self.col[self.by_col]) > 0])[: len(self.row)]

    def row_sums(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(self.n, np.float32)
        if len(self.row):
            out[self.row[self.row_at]] = np.add.reduceat(values, self.row_at)
        return out

    def col_sums(self, values_by_col: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values_by_col, self.col_at) if len(self.row) else np.zeros(len(self.used), np.float32)


def _fit(e: _Entries, y: np.ndarray, r: np.ndarray, steps: int = 13, l2: float = 0.01) -> tuple[np.ndarray, float]:
    """Weights (of the n-grams used) and bias of one category: logistic regression by AdaGrad on scaled n-grams."""
    x = r[e.col] * e.times
    size = np.sqrt(e.row_sums(x * x)) + 1e-6
    x /= size[e.row]  # unit length
    xc = x[e.by_col]
    n_pos, n_neg = max(int(y.sum()), 1), max(int((~y).sum()), 1)
    cost = np.where(y, min(n_neg / n_pos, 4.0), 1.0).astype(np.float32)
    w, b = np.zeros(len(e.used), np.float32), float(np.log(n_pos / n_neg))
    gw, gb = np.full(len(e.used), 1e-8, np.float32), 1e-8
    for _ in range(steps):
        z = e.row_sums(x * w[e.col]) + np.float32(b)
        error = cost * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y).astype(np.float32)
        grad = e.col_sums(xc * error[e.row_c]) + np.float32(l2) * w
        gw += grad * grad
        total = float(error.sum())
        gb += total**2
        w -= grad / np.sqrt(gw)
        b -= 0.5 * total / gb**0.5
    return w * r, b


class Model:
    """Per category: weights of n-grams (log-count ratio included), their ratios, and a bias."""

    def __init__(self, weights: np.ndarray, ratios: np.ndarray, bias: np.ndarray) -> None:
        self.weights, self.ratios, self.bias = weights, ratios, bias
        # one row an n-gram: weights, and squares of ratios for the length; the last row for none
        self.table = np.zeros((weights.shape[1] + 1, 2 * len(bias)), np.float32)
        self.table[:-1, : len(bias)], self.table[:-1, len(bias) :] = weights.T, (ratios * ratios).T

    def sentence_scores(self, parts: list[str]) -> np.ndarray:
        """Probability of each category (columns) for each sentence (rows)."""
        k = len(self.bias)
        if not parts:
            return np.zeros((0, k))
        grams, starts = _grams(parts)
        at = self.table[grams[0]]
        for g in grams[1:]:
            at += self.table[g]
        sums = np.add.reduceat(at, starts, axis=0)
        z = sums[:, :k] / (np.sqrt(sums[:, k:]) + 1e-6) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _no_model() -> Model:
    k, dim = len(CATEGORIES), 1 << BITS
    return Model(np.zeros((k, dim), np.float32), np.zeros((k, dim), np.float32), np.full(k, -30.0))


def _fit_all(cols: np.ndarray, rows: np.ndarray, truth: np.ndarray) -> Model:
    """A model of the sentences whose truth is not -1; len(CATEGORIES) means fit."""
    model = _no_model()
    used = truth >= 0
    if not used.any():
        return model
    pick = used[rows]
    cols, rows, truth = cols[pick], (np.cumsum(used) - 1)[rows[pick]], truth[used]
    e = _Entries(cols, rows, len(truth))
    for c in range(len(CATEGORIES)):
        y = truth == c
        if y.any() and not y.all():
            r = _ratio(cols, y[rows])
            model.ratios[c][e.used] = r[e.used]
            model.weights[c][e.used], model.bias[c] = _fit(e, y, r[e.used])
    return Model(model.weights, model.ratios, model.bias)


def _by_lot(docs: np.ndarray) -> np.ndarray:
    """Which sentences of fit documents take part from the beginning: one in FIT_SHARE, by document and place."""
    place = np.arange(len(docs)) - np.searchsorted(docs, docs)
    return np.array([zlib.crc32(f"{d} {i}".encode()) % FIT_SHARE == 0 for d, i in zip(docs.tolist(), place.tolist())], bool)


def train(texts: list[str | None], labels: list[str], rounds: int = 1) -> Model:
    """Fit a model on whole documents and their labels."""
    rows = [(i, label, s) for i, (t, label) in enumerate(zip(texts, labels)) for s in sentences(t)]
    return train_on_sentences([r[2] for r in rows], np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], object), rounds)


def _scores(model: Model, parts: list[str], at: np.ndarray) -> np.ndarray:
    """Scores of the sentences at some places, taken in steps."""
    out = np.zeros((len(at), len(CATEGORIES)))
    ends = np.cumsum([len(parts[i]) + 1 for i in at.tolist()])
    low = 0
    while low < len(at):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + STEP_CHARS, "right")))
        out[low:high] = model.sentence_scores([parts[i] for i in at[low:high].tolist()])
        low = high
    return out


def train_on_sentences(parts: list[str], doc: np.ndarray, label: np.ndarray, rounds: int = 1) -> Model:
    """Fit a model on normalised sentences, the document of each and that document's label.

    Each round looks at every fifth of the documents by a model of the others, as some labels are
    wrong: a document's sentence counts only if that model finds it more like the
    category than the worst sentences of nearly all fit documents. Fit documents give a share of
    their sentences by lot, and all that such a model finds somewhat unfit.
    """
    k = len(CATEGORIES)
    if not len(parts) or not (label == FIT).any():
        return _no_model()
    order = np.argsort(doc, kind="stable")
    parts, doc, label = [parts[i] for i in order.tolist()], doc[order], label[order]
    fit_rows = label == FIT
    base = np.zeros(len(parts), bool)
    base[fit_rows] = _by_lot(doc[fit_rows])
    if not base.any():
        base = fit_rows.copy()
    scores = np.zeros((len(parts), k))
    at = np.flatnonzero(base | np.isin(label, CATEGORIES))  # first: sums of log-count ratios, whole documents against whole documents
    cols, rows = features([parts[i] for i in at.tolist()])
    size = np.sqrt(np.bincount(rows, minlength=len(at)) + 1)
    for c, name in enumerate(CATEGORIES):
        own = label[at] == name
        use = own[rows] | base[at][rows]
        r = _ratio(cols[use], own[rows[use]])
        scores[at, c] = np.bincount(rows, r[cols], len(at)) / size
    fold = np.array([zlib.crc32(str(d).encode()) % FOLDS for d in doc.tolist()], np.int64)
    fit_starts = np.flatnonzero(np.r_[True, np.diff(doc[fit_rows]) != 0])
    for step in range(rounds + 1):
        truth = np.full(len(parts), -1)
        truth[base | fit_rows & (scores.max(1) > SOMEWHAT) if step else base] = k
        for c, name in enumerate(CATEGORIES):
            own = np.flatnonzero(label == name)
            if not len(own):
                continue
            order = own[np.lexsort((own, -scores[own, c], doc[own]))]
            first = order[np.r_[True, doc[order][1:] != doc[order][:-1]]]
            if step:
                usual = np.quantile(np.maximum.reduceat(scores[fit_rows, c], fit_starts), DOUBTFUL)
                first = first[scores[first, c] > usual]
            truth[first] = c
            if step:
                truth[own[scores[own, c] > 0.9]] = c
        at = np.flatnonzero(truth >= 0)
        cols, rows = features([parts[i] for i in at.tolist()])
        if step == rounds:
            return _fit_all(cols, rows, truth[at])
        other = np.zeros_like(scores)
        for f in range(FOLDS):
            model = _fit_all(cols, rows, np.where(fold[at] != f, truth[at], -1))
            rest = np.flatnonzero(fold == f)
            other[rest] = _scores(model, parts, rest)
        scores = other


def clean_labels(labels: DataFrame) -> DataFrame:
    """``doc_id, category`` where all raters of a document agree; unknown and null labels are left out."""
    name = F.lower(F.regexp_replace("category", F.lit(r"(?U)^\s+|\s+\z"), F.lit("")))
    known = labels.select("doc_id", name.alias("category")).filter(F.col("category").isin(*CATEGORIES, FIT) & F.col("doc_id").isNotNull())
    return known.groupBy("doc_id").agg(F.min("category").alias("category"), F.max("category").alias("other")).filter("category = other").drop("other")


def fit_model(docs: DataFrame, labels: DataFrame, *, max_labelled: int = MAX_LABELLED, max_chars: int = MAX_FIT_CHARS) -> Model:
    """Fit a model on at most ``max_labelled`` labelled documents with at most ``max_chars`` characters.

    These are the first by a hash of their id. Their sentences are taken apart in many tasks;
    one task fits the model.
    """
    chosen = clean_labels(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    texts = cut(docs.select("doc_id", "text").join(broadcast_if_small(cut(chosen)), "doc_id").groupBy("doc_id").agg(F.max("text").alias("text"), F.max("category").alias("category")))
    sizes = texts.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("n")).orderBy(F.xxhash64("doc_id"), "doc_id").toPandas()  # at most max_labelled rows
    within = sizes["n"].cumsum() <= max_chars
    if not within.all():
        texts = texts.join(F.broadcast(docs.sparkSession.createDataFrame([(int(i),) for i in sizes["doc_id"][within]], "doc_id bigint")), "doc_id", "left_semi")

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(d, c, s) for d, t, c in zip(pdf["doc_id"], pdf["text"], pdf["category"]) for s in sentences(t)]
            yield pd.DataFrame(rows, columns=["doc_id", "category", "sentence"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = list(batches)
        pdf = pd.concat(got).sort_values(["doc_id", "sentence"]) if got else pd.DataFrame({"doc_id": [], "category": [], "sentence": []})
        m = train_on_sentences(pdf["sentence"].tolist(), pdf["doc_id"].to_numpy(np.int64), pdf["category"].to_numpy(object))
        for c, name in enumerate(CATEGORIES):
            yield pd.DataFrame({"category": [name], "weights": [m.weights[c].tobytes()], "ratios": [m.ratios[c].tobytes()], "bias": [float(m.bias[c])]})

    apart = texts.mapInPandas(parts, "doc_id bigint, category string, sentence string").repartition(1)
    rows = {r.category: r for r in apart.mapInPandas(run, "category string, weights binary, ratios binary, bias double").collect()}
    if not rows:  # no document is labelled
        return _no_model()
    stack = lambda k: np.stack([np.frombuffer(rows[c][k], np.float32) for c in CATEGORIES])
    return Model(stack("weights"), stack("ratios"), np.array([rows[c].bias for c in CATEGORIES]))


def score_documents(docs: DataFrame, model: Model, threshold: float = 0.75) -> DataFrame:
    """``doc_id``, a score per category, and ``category``: the highest, if it is at least ``threshold``.

    Whole texts are scored, by their worst sentence; null and empty texts score 0. Rows with a
    null id are left out, an id that comes again gives a row each time. An empty table gives
    an empty result. Other columns of ``docs`` are never looked at.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = sent.value
        for pdf in batches:
            best = np.zeros((len(pdf), len(CATEGORIES)))
            parts: list[str] = []
            of: list[int] = []
            chars = 0

            def flush() -> None:
                if parts:
                    np.maximum.at(best, np.array(of), model.sentence_scores(parts))

            for i, t in enumerate(pdf["text"].tolist()):
                for s in sentences(t):
                    parts.append(s)
                    of.append(i)
                    chars += len(s)
                    if chars > STEP_CHARS:
                        flush()
                        parts, of, chars = [], [], 0
            flush()
            top = best.argmax(1)
            names = [CATEGORIES[c] if best[i, c] >= threshold else None for i, c in enumerate(top)]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], **{c: best[:, j] for j, c in enumerate(CATEGORIES)}, "category": names})

    whole = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").filter("doc_id is not null")
    return whole.mapInPandas(run, "doc_id bigint, " + ", ".join(f"{c} double" for c in CATEGORIES) + ", category string")
