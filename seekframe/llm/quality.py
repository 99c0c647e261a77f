"""Quality by a byte-level convolutional network, written in numpy.

Bytes are embedded; filters run over overlapping chunks of ``WIDTH`` bytes, one every ``STRIDE``
bytes to the end of the document; each filter keeps its largest answer, and these are combined into
one probability. For scoring, embedding and filters are multiplied out into one table per place of
the chunk, so a chunk costs ``WIDTH`` look-ups.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seekframe.llm.tables import Example, labelled_sample
from seekframe.session import spread

THRESHOLD = 0.7
WIDTH, STRIDE = 16, 8
EMBEDDING, FILTERS = 8, 24
EPOCHS, BATCH, RATE = 10, 32, 0.01
LEARN_ROWS, LEARN_CHARS = 2400, 16_000
BLOCK = 4096  # chunks held at once


def _bytes(text: str | None) -> np.ndarray:
    """The whole text, filled with zeros to the end of its last chunk."""
    raw = (text or "").encode("utf-8", "replace")
    chunks = max(0, -(-(len(raw) - WIDTH) // STRIDE)) + 1
    return np.frombuffer(raw.ljust((chunks - 1) * STRIDE + WIDTH, b"\0"), dtype=np.uint8)


def _chunks(data: np.ndarray) -> np.ndarray:
    return np.lib.stride_tricks.sliding_window_view(data, WIDTH)[::STRIDE]


@dataclass(frozen=True)
class Model:
    """Filter answers by place and byte, their bias, and the combination of the pooled answers."""
    tables: np.ndarray  # WIDTH x 256 x filters
    bias: np.ndarray
    combine: np.ndarray
    offset: float

    def pooled(self, text: str | None) -> np.ndarray:
        data = _bytes(text)
        chunks = _chunks(data)
        best = np.full(len(self.bias), -np.inf, dtype=np.float32)
        for at in range(0, len(chunks), BLOCK):
            part = chunks[at:at + BLOCK]
            answer = self.tables[0][part[:, 0]]
            for place in range(1, WIDTH):
                answer += self.tables[place][part[:, place]]
            np.maximum(best, answer.max(axis=0), out=best)
        return np.maximum(best + self.bias, 0)

    def score(self, text: str | None) -> float:
        logit = float(self.pooled(text) @ self.combine) + self.offset
        return float(1 / (1 + np.exp(-np.clip(logit, -50, 50))))


def fit(examples: Iterable[Example], seed: int = 7) -> Model:
    """Fit by Adam on shuffled batches; gradients flow through the largest answers only.

    Without examples of both classes the network is flat at the share of label 1.
    """
    examples = list(examples)
    draw = np.random.default_rng(seed)
    shape = {"embedding": (256, EMBEDDING), "filters": (WIDTH * EMBEDDING, FILTERS),
             "bias": (FILTERS,), "combine": (FILTERS,), "offset": (1,)}
    x = {name: np.zeros(size, dtype=np.float32) for name, size in shape.items()}
    if len({e.label for e in examples}) < 2:
        share = np.clip(np.mean([e.label for e in examples] or [0.5]), 0.01, 0.99)
        return Model(np.zeros((WIDTH, 256, FILTERS), dtype=np.float32), x["bias"], x["combine"],
                     float(np.log(share / (1 - share))))
    x["embedding"] = draw.normal(0, 0.5, shape["embedding"]).astype(np.float32)
    x["filters"] = draw.normal(0, 1 / np.sqrt(WIDTH * EMBEDDING / 2),
                               shape["filters"]).astype(np.float32)
    x["combine"] = draw.normal(0, 0.3, FILTERS).astype(np.float32)
    x["bias"] -= 0.5
    mean = {n: np.zeros_like(v) for n, v in x.items()}
    square = {n: np.zeros_like(v) for n, v in x.items()}
    data = [_bytes(e.text) for e in examples]
    label = np.array([e.label for e in examples], dtype=np.float32)
    weight = np.array([e.weight for e in examples], dtype=np.float32)
    step = 0
    for _ in range(EPOCHS):
        order = draw.permutation(len(data))
        for start in range(0, len(order), BATCH):
            batch = order[start:start + BATCH]
            pooled = np.zeros((len(batch), FILTERS), dtype=np.float32)
            chosen = np.zeros((len(batch), FILTERS, WIDTH), dtype=np.uint8)
            for i, d in enumerate(batch):
                chunks = _chunks(data[d])
                seen = x["embedding"][chunks].reshape(len(chunks), -1) @ x["filters"]
                top = seen.argmax(axis=0)
                pooled[i], chosen[i] = seen[top, np.arange(FILTERS)], chunks[top]
            active = np.maximum(pooled + x["bias"], 0)
            logit = active @ x["combine"] + x["offset"]
            wrong = (1 / (1 + np.exp(-np.clip(logit, -50, 50))) - label[batch]) \
                * weight[batch] / len(batch)
            back = wrong[:, None] * x["combine"] * (active > 0)
            inputs = x["embedding"][chosen].reshape(len(batch), FILTERS, -1)
            grad = {"combine": wrong @ active, "offset": wrong.sum(keepdims=True),
                    "bias": back.sum(axis=0),
                    "filters": np.einsum("df,dfk->kf", back, inputs)}
            down = (back[:, :, None] * x["filters"].T).reshape(-1, EMBEDDING)
            grad["embedding"] = np.zeros_like(x["embedding"])
            np.add.at(grad["embedding"], chosen.reshape(-1), down)
            step += 1
            for name, value in x.items():
                g = grad[name] + 1e-5 * value
                mean[name] = 0.9 * mean[name] + 0.1 * g
                square[name] = 0.99 * square[name] + 0.01 * g * g
                value -= RATE * (mean[name] / (1 - 0.9 ** step)) \
                    / (np.sqrt(square[name] / (1 - 0.99 ** step)) + 1e-7)
    places = x["filters"].reshape(WIDTH, EMBEDDING, FILTERS)
    tables = np.stack([x["embedding"] @ places[w] for w in range(WIDTH)]).astype(np.float32)
    return Model(tables, x["bias"], x["combine"], float(x["offset"][0]))


def learn(documents: DataFrame, labels: DataFrame, rows: int = LEARN_ROWS,
          chars: int = LEARN_CHARS) -> Model:
    """Fit on at most ``rows`` labelled documents of at most ``chars`` characters, none held out."""
    return fit(labelled_sample(documents, labels, "quality", rows, chars))


def score(text: str | Column, model: Model) -> Column:
    """The quality of each whole text, 0 to 1; null counts as empty."""
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t if isinstance(t, str) else None) for t in texts],
                         dtype="float64")
    return F.pandas_udf(scored, T.DoubleType())(text)


def drop_poor(docs: DataFrame, model: Model, threshold: float = THRESHOLD,
              text: str = "text") -> DataFrame:
    """The documents that score at least the threshold; same columns. Null texts are judged as
    empty ones."""
    return spread(docs).filter(score(text, model) >= threshold)
