"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled."""

from __future__ import annotations

import re
import string
from array import array
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playstar.llm.common import session_of
from playstar.session import in_few_files, new_folder, store

#: Bounds of the training sample: documents (on average, as their ids' hashes decide) and characters in all. Scoring has no bound.
SAMPLE_DOCS = 4000
SAMPLE_CHARS = 40_000_000
#: Files at most in which the sample is written.
SAMPLE_FILES = 16
#: Clean documents are learned from in pieces of about so many characters: every sentence of them is clean.
PIECE_CHARS = 10_000
#: A word or beginning needs so many documents of the sample to have a weight.
LEAST_DOCS = 4
#: Sentences with a smaller probability are clean: all of them together count as one sentence that does not reach it, so
#: any number of clean sentences is clean.
LEAST_RISK = 0.2
#: Lengths of the beginnings of words that have weights beside whole words.
PREFIXES = (4, 5, 6)
#: Words whose weight a Python worker remembers, and the most characters of one.
WORDS_KEPT, WORD_CHARS = 400_000, 64
#: Learning stops when 25 rounds change the loss by less than this share of it.
STEADY = 0.01

SENTENCES = re.compile(r"[^.!?\n]+")
EDGES = string.punctuation + string.whitespace + "«»“”„’‘¡¿…–—"


def normal(word: str) -> str:
    return word.strip(EDGES).lower()


def features(word: str) -> list[str]:
    """A word and its beginnings, which inflected and compounded forms share; beginnings end in a star."""
    plain = normal(word)
    return [plain, *(plain[:n] + "*" for n in PREFIXES if len(plain) >= n)] if plain else []


@dataclass
class Model:
    """Log-odds of a sentence: ``bias`` and the weights of its different words. A document is toxic if any sentence is (noisy-or,
    with LEAST_RISK as the most that clean sentences add)."""

    bias: float
    weights: dict[str, float]


class Scorer(dict):
    """Weights by the words as they are written."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.plain = float(np.logaddexp(0.0, model.bias))  # -log(1 - p) of a sentence without weighted words
        self.least = float(np.log(LEAST_RISK / (1 - LEAST_RISK))) - model.bias

    def __missing__(self, word: str) -> float:
        if len(self) > WORDS_KEPT:
            self.clear()
        get = self.model.weights.get
        weight = sum(get(feature, 0.0) for feature in features(word))
        if len(word) <= WORD_CHARS:
            self[word] = weight
        return weight

    def document(self, text: str, least: float) -> tuple[float, list[tuple[int, int, float]]]:
        """Score, and start, end (in characters) and score of each sentence with a score of ``least`` or more."""
        risk, others, found = 0.0, 0.0, []
        for match in SENTENCES.finditer(text):
            weight = sum(map(self.__getitem__, set(match.group().split())))
            if weight < self.least:
                others += float(np.logaddexp(0.0, self.model.bias + weight)) if weight else self.plain
                continue
            logit = self.model.bias + weight
            risk += float(np.logaddexp(0.0, logit))
            if (score := 1 / (1 + np.exp(-logit))) >= least:
                found.append((match.start(), match.end(), float(score)))
        return float(1 - np.exp(-risk) * (1 + LEAST_RISK * np.expm1(-others))), found


def pieces(text: str) -> list[str]:
    """A text cut between sentences where PIECE_CHARS are reached."""
    out, start = [], 0
    for match in SENTENCES.finditer(text):
        if match.end() - start >= PIECE_CHARS:
            out.append(text[start : match.end()])
            start = match.end()
    return [*out, text[start:]] if start < len(text) or not out else out


def fit(texts: list[str], toxic: list[int], rounds: int = 400, rate: float = 0.15, sparsity: float = 1e-4) -> Model:
    """Noisy-or likelihood of the documents' labels, with a penalty on the sum of the weights' sizes.

    A document's probability is 1 - prod(1 - p) over its sentences, so one bad sentence suffices
    and the others keep a low score; the bias has to hold for all sentences of clean documents. Equal texts count once, as
    toxic if one label says so. Learning stops when the likelihood no longer changes.
    """
    by_text: dict[str, int] = {}
    for text, label in zip(texts, toxic, strict=True):
        by_text[text] = max(label, by_text.get(text, 0))
    labels = np.array(list(by_text.values()), float)
    spread: Counter[str] = Counter()
    for text in by_text:
        spread.update({f for word in set(text.split()) for f in features(word)})
    number = {f: i for i, f in enumerate(sorted(f for f, n in spread.items() if n >= LEAST_DOCS))}
    ids: dict[str, list[int]] = {}
    doc_of, word_at, sentence_at = array("i"), array("i"), array("i")
    for d, text in enumerate(by_text):
        for sentence in SENTENCES.findall(text):
            words = set(sentence.split())
            for w in words:
                if w not in ids:
                    ids[w] = [number[f] for f in features(w) if f in number]
            known = {i for w in words for i in ids[w]}
            word_at.extend(known)
            sentence_at.extend([len(doc_of)] * len(known))
            doc_of.append(d)
    doc, word, sentence = (np.array(x, np.int32) for x in (doc_of, word_at, sentence_at))
    if not len(doc) or labels.min() == labels.max():
        return Model(-20.0 if not labels.any() else 0.0, {})
    weights, bias = np.zeros(len(number)), -6.0
    moments = [np.zeros(len(number) + 1) for _ in range(2)]
    # Both kinds of documents have the same say.
    share = np.where(labels == 1, 0.5 / labels.sum(), 0.5 / (len(labels) - labels.sum()))
    before = np.inf
    for t in range(1, rounds + 1):
        logit = bias + np.bincount(sentence, weights[word], len(doc))
        risk = np.maximum(np.bincount(doc, np.logaddexp(0, logit), len(labels)), 1e-9)
        if t % 25 == 0:
            loss = float((share * np.where(labels == 1, -np.log(-np.expm1(-risk)), risk)).sum())
            if abs(before - loss) < STEADY * loss:
                break
            before = loss
        pull = np.where(labels == 1, -1 / np.expm1(np.minimum(risk, 500)), 1.0) * share
        slope = pull[doc] / (1 + np.exp(-np.clip(logit, -500, 500)))
        gradient = np.append(np.bincount(word, slope[sentence], len(number)), slope.sum())
        for moment, keep, value in zip(moments, (0.9, 0.99), (gradient, gradient**2), strict=True):
            moment += (1 - keep) * (value - moment)
        size = rate / (np.sqrt(moments[1] / (1 - 0.99**t)) + 1e-6)
        step = size * moments[0] / (1 - 0.9**t)
        bias -= step[-1]
        weights -= step[:-1]
        weights = np.sign(weights) * np.maximum(np.abs(weights) - np.minimum(size[:-1] * sparsity, 1.0), 0)
    names = list(number)
    return Model(float(bias), {names[i]: float(weights[i]) for i in np.flatnonzero(np.abs(weights) > 0.05)})


def held_out(doc_id: Column) -> Column:
    """A third of the ids, whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """The model of a sample of labelled documents outside the held-out third.

    Ids are drawn by their hash, SAMPLE_DOCS on average. Documents of any length take part: clean ones in pieces, toxic ones
    whole; if all of it has more than SAMPLE_CHARS characters, a share of the pieces and of the toxic documents is drawn, by hash, too. An id
    with several labels counts as toxic if one says so; of several texts of an id the smallest is learned from. Null ids, labels and
    texts are left out. Without labels of both kinds nothing, or everything, is toxic.
    """
    given = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("toxic"))
    given = given.where("doc_id is not null and toxic in (0, 1)").where(~held_out(F.col("doc_id")))
    by_id = in_few_files(given.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), labels.count())
    by_id = store(by_id, new_folder(docs.sparkSession, "labelled"))
    drawn = by_id.where(_below(SAMPLE_DOCS / max(1, by_id.count()), "doc_id"))
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).where("text is not null")
    rows = texts.join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))

    @F.arrow_udf("array<string>")
    def cut(texts: pa.Array, toxic: pa.Array) -> pa.Array:
        return pa.array([[t] if bad else pieces(t) for t, bad in zip(texts.to_pylist(), toxic.to_pylist(), strict=True)], pa.list_(pa.string()))

    session_of(docs)
    bags = rows.select("doc_id", "toxic", F.posexplode(cut("text", "toxic")).alias("number", "text"))
    bags = store(bags.coalesce(SAMPLE_FILES), new_folder(docs.sparkSession, "bags"))
    chars = bags.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    sample = bags.where(_below(SAMPLE_CHARS / max(1, chars), "doc_id", "number")).collect()
    sample.sort(key=lambda r: (r["doc_id"], r["number"]))
    return fit([r["text"] for r in sample], [r["toxic"] for r in sample])


def _below(share: float, *columns: str) -> Column:
    """Whether a row is drawn, by the hash of some columns."""
    return F.pmod(F.xxhash64(F.lit("drawn"), *columns), F.lit(1 << 40)) < int(min(1.0, share) * (1 << 40))


FOUND = "struct<score: double, sentences: array<struct<start: int, stop: int, score: double>>>"


def toxicity(text: Column, model: Model, least: float = 0.5) -> Column:
    """``score`` of a text and its ``sentences`` with a score of ``least`` or more, as a struct.

    Whole texts. Null and empty texts have no sentences and score 0.
    """

    @F.arrow_udf(FOUND)
    def scored(texts: pa.Array) -> pa.Array:
        scorer = Scorer(model)
        rows = [scorer.document(t.as_py() or "", least) for t in texts]
        spans = [[{"start": a, "stop": b, "score": p} for a, b, p in found] for _, found in rows]
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("score", pa.float64())]))
        return pa.StructArray.from_arrays(
            [pa.array([score for score, _ in rows], pa.float64()), pa.array(spans, kind)], ["score", "sentences"]
        )

    return scored(text.cast("string"))


def score(docs: DataFrame, model: Model, threshold: float = 0.7, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1), ``predicted`` (1 from ``threshold``) and the offending ``sentences`` of every row.

    Scores use the text alone. A sentence is a run of text between . ! ? and line breaks; ``sentences`` gives start and stop in characters
    and the score of those at 0.5 or more. Sentences below LEAST_RISK add no more than that together, so
    the length of a clean text does not matter. Null and empty texts score 0. Repeated rows and ids, and null ids (never held out),
    each give their row. Other columns are ignored; an empty table gives an empty one. No shuffle.
    """
    session_of(docs)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), toxicity(F.col(text), model).alias("found"))
    return rows.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("found.score").alias("score"),
        (F.col("found.score") >= threshold).cast("int").alias("predicted"),
        F.col("found.sentences").alias("sentences"),
    )
