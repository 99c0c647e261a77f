"""Toxicity by multiple-instance learning.

Only documents are labelled. Each sentence gets a probability from its words, and a document is
toxic if any sentence is: 1 - product(1 - p), the noisy-or. The weights are fitted through that
formula, so the blame settles on the sentences that toxic documents have and others lack, and the
fitted scores point these out.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seekframe.llm.tables import Example, labelled_sample
from seekframe.session import spread

THRESHOLD = 0.3
FLOOR = 0.05  # sentences less likely toxic than this do not add up, so length makes no text toxic
SENTENCE = re.compile(r"[^.!?\n]+[.!?\n]*|[.!?\n]+")
WORD = re.compile(r"\w+")
STEMS = (4, 5)  # letters of the word beginnings that are features beside the word itself
# Chosen on a quarter of the learnable rows kept apart, after a first try on held-out ones.
LEAST_DOCUMENTS = 2  # learned documents a feature must occur in
FEATURES = 40_000  # of the learned sample at most, which bounds the model; the most frequent are kept
KEPT_WORDS = 300_000  # words a worker remembers the weight of
ROUNDS = 90
RATE = 0.3
PENALTY = 1e-4


def features(word: str) -> list[str]:
    """The word, and its beginnings marked as such, so unseen forms of a known stem count."""
    return [word, *["^" + word[:n] for n in STEMS if len(word) >= n]]


@dataclass(frozen=True)
class Model:
    """Logistic weights of words and stems, over a bias per sentence."""
    weights: dict[str, float]
    bias: float
    known: dict[str, float] = field(default_factory=dict, compare=False)

    def __getstate__(self):
        return {"weights": self.weights, "bias": self.bias, "known": {}}

    def __setstate__(self, state):
        self.__dict__.update(state)

    def words(self, text: str) -> float:
        """Weight of all words of lower-cased text; a word counts once."""
        total, known = 0.0, self.known
        for word in set(WORD.findall(text)):
            weight = known.get(word)
            if weight is None:
                weight = sum(self.weights.get(f, 0.0) for f in features(word))
                if len(known) >= KEPT_WORDS:
                    known.clear()
                known[word] = weight
            total += weight
        return total

    def score(self, text: str | None) -> float:
        """Probability of the document: noisy-or of its likely sentences or, without one, that of
        its likeliest. Null and empty texts have no sentence and score 0."""
        floor, log_clean, likeliest = math.log(FLOOR / (1 - FLOOR)), 0.0, -math.inf
        for sentence in SENTENCE.findall((text or "").lower()):
            logit = self.bias + self.words(sentence)
            likeliest = max(likeliest, logit)
            if logit >= floor:
                log_clean -= _softplus(logit)
        if log_clean == 0.0 and likeliest > -math.inf:
            log_clean = -_softplus(likeliest)
        return -math.expm1(log_clean)

    def offending(self, text: str | None, threshold: float = 0.5) -> list[tuple[int, int, float]]:
        """(start, end, probability) of the sentences at or above the threshold."""
        out = []
        for found in SENTENCE.finditer(text or ""):
            logit = self.bias + self.words(found[0].lower())
            p = 1 / (1 + math.exp(-max(-700.0, min(700.0, logit))))
            if p >= threshold:
                out.append((*found.span(), p))
        return out


def _softplus(x: float) -> float:
    return max(x, 0.0) + math.log1p(math.exp(-abs(x)))


def fit(examples: Iterable[Example]) -> Model:
    """Fit by Adam on the whole sample. Without toxic examples every score is near zero."""
    examples = list(examples)
    if not any(e.label for e in examples):
        return Model({}, -20.0)
    spread_over: Counter = Counter()
    for e in examples:
        spread_over.update({f for w in set(WORD.findall(e.text.lower())) for f in features(w)})
    common = [f for f, n in spread_over.most_common(FEATURES) if n >= LEAST_DOCUMENTS]
    index = {f: i for i, f in enumerate(common)}
    del spread_over
    word, sentence, document = array("i"), array("i"), array("i")
    for d, e in enumerate(examples):
        for part in SENTENCE.findall(e.text.lower()):
            known = [index[f] for w in set(WORD.findall(part)) for f in features(w) if f in index]
            word.extend(known)
            sentence.extend([len(document)] * len(known))
            document.append(d)
    word, sentence, document = (np.frombuffer(x, dtype=np.int32) if x else np.zeros(0, np.int32)
                                for x in (word, sentence, document))
    label = np.array([e.label for e in examples])
    weight = np.array([e.weight for e in examples])
    weight = weight / weight.sum()
    x = np.zeros(len(index) + 1)
    x[-1] = -4.0
    mean, square = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, ROUNDS + 1):
        z = x[-1] + np.bincount(sentence, x[:-1][word], len(document))
        p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        clean = np.exp(-np.bincount(document, np.logaddexp(0, z), len(examples)))
        blame = np.where(label == 1, -clean / np.maximum(1 - clean, 1e-9), 1.0) * weight
        slope = p * blame[document]
        grad = np.append(np.bincount(word, slope[sentence], len(index)), slope.sum())
        grad[:-1] += PENALTY * x[:-1]
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad ** 2
        x -= RATE * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-7)
    return Model({w: float(x[i]) for w, i in index.items() if abs(x[i]) > 1e-3}, float(x[-1]))


def learn(documents: DataFrame, labels: DataFrame, **bounds) -> Model:
    """Fit on a bounded sample of the labelled documents that are not held out; ``bounds`` are
    those of ``labelled_sample``."""
    return fit(labelled_sample(documents, labels, "toxic", **bounds))


def score(text: str | Column, model: Model) -> Column:
    """The toxicity of each whole text, 0 to 1; 0 for null and empty ones."""
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t if isinstance(t, str) else None) for t in texts],
                         dtype="float64")
    return F.pandas_udf(scored, T.DoubleType())(text)


def sentences(docs: DataFrame, model: Model, threshold: float = 0.5, id_column: str = "doc_id",
              text: str = "text") -> DataFrame:
    """``(id, start, end, probability)`` of the offending sentences of every document."""
    def spans(texts: pd.Series) -> pd.Series:
        found = [model.offending(t if isinstance(t, str) else None, threshold) for t in texts]
        return pd.Series([[dict(zip(("start", "end", "probability"), s)) for s in f] for f in found],
                         dtype=object)
    kind = T._parse_datatype_string("array<struct<start: long, end: long, probability: double>>")
    listed = spread(docs).select(F.col(id_column), F.pandas_udf(spans, kind)(text).alias("_spans"))
    return listed.select(id_column, F.explode("_spans").alias("_span")).select(id_column, "_span.*")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD,
               text: str = "text") -> DataFrame:
    """The documents that score below the threshold; same columns. Null and empty texts stay."""
    return spread(docs).filter(score(text, model) < threshold)
