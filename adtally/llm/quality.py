"""Quality classifier on averaged subword embeddings.

Words, character n-grams of words (their borders included) and pairs of neighbouring words are hashed to rows
of one embedding table. A document is the mean of its rows; a softmax layer turns the mean into the two
classes. Table and layer are learned by stochastic gradient descent in numpy. A word that follows itself
counts as the same pair whatever the word, so that runs of one word look alike.

As layer and mean are linear, a score needs one number per table row: the row's vector times the difference
of the two output vectors. Scoring looks these numbers up for whole texts.

Learning takes about `sample` labelled rows, chosen by a hash of their id, and needs only their counts of
hashed features on the driver. Rows with a null label teach nothing; of several labels of one row the
majority holds, and 1 on a tie.

Defined results: null, empty and blank texts score what the layer's bias says; without labels every score is
0.5, with labels of one class the score leans to it. Repeated rows repeat, an empty table gives an empty
table, and only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.llm.common import chunks_by_size, map_texts, uniform
from adtally.llm.rolling import Words

ROWS = 1 << 16
GRAMS = (3, 4)
SAMPLE = 2500
CACHE_CHARS = 100_000  # characters hashed at once: their arrays stay in the processor's cache
REPEAT = 0  # the row of a word that follows itself


def rows_of(hashes: np.ndarray, kind: int) -> np.ndarray:
    """The upper 16 bits of a product with an odd number: another one for each kind of feature."""
    return ((hashes * np.uint64(0x9E3779B97F4A7C15 + 2 * kind * 0x5851F42D4C957F2D & (1 << 64) - 1)) >> np.uint64(48)).astype(np.int64)


def hashed_features(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs (table row, number of the text) for every feature of a batch."""
    words = Words(texts)
    if not len(words.starts):
        return []
    owner = np.searchsorted(words.offsets, words.starts, side="right") - 1
    found = [(rows_of(words.hashes, 1), owner)]
    follows = owner[1:] == owner[:-1]
    pair = rows_of(words.hashes[:-1] * np.uint64(3) + words.hashes[1:], 2)
    pair[words.hashes[:-1] == words.hashes[1:]] = REPEAT
    found.append((pair[follows], owner[1:][follows]))
    blanks = np.zeros(len(words.blank) + 1, dtype=np.int64)
    np.cumsum(words.blank, out=blanks[1:])
    places = np.repeat(np.arange(len(texts)), np.diff(words.offsets))
    for size in GRAMS:
        hashed = words.rolling.windows(size)
        inner = blanks[size - 1 : size - 1 + len(hashed)] - blanks[1 : 1 + len(hashed)]
        inside = inner == 0
        found.append((rows_of(hashed[inside], 10 + size), places[: len(hashed)][inside]))
    return found


@dataclass
class QualityModel:
    weights: np.ndarray  # per table row: its vector times the difference of the output vectors
    bias: float

    def score(self, texts: list[str]) -> np.ndarray:
        total, number = np.zeros(len(texts)), np.zeros(len(texts))
        for start, end in chunks_by_size(texts, CACHE_CHARS):
            for rows, owner in hashed_features(texts[start:end]):
                total[start:end] += np.bincount(owner, weights=self.weights[rows], minlength=end - start)
                number[start:end] += np.bincount(owner, minlength=end - start)
        return 1 / (1 + np.exp(-np.clip(total / np.maximum(number, 1) + self.bias, -60, 60)))


def train(
    examples: Sequence[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, *, size: int = 8, epochs: int = 6,
    rate: float = 0.5, seed: int = 5,
) -> QualityModel:
    """Stochastic gradient descent, one document a step, over (table rows, counts) examples."""
    if not len(labels):
        return QualityModel(np.zeros(ROWS), 0.0)
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / size, 1 / size, (ROWS, size))
    layer, bias = np.zeros((2, size)), np.zeros(2)
    steps, done = epochs * len(labels), 0
    for _ in range(epochs):
        for i in rng.permutation(len(labels)):
            rows, counts = examples[i]
            step = rate * (1 - done / steps)
            done += 1
            share = counts / max(counts.sum(), 1)
            mean = share @ table[rows]
            logits = layer @ mean + bias
            odds = np.exp(logits - logits.max())
            odds /= odds.sum()
            odds[labels[i]] -= 1
            back = odds @ layer
            layer -= step * np.outer(odds, mean)
            bias -= step * 0.1 * odds
            # Scaled by the number of distinct rows: a document's rows move together by about one step.
            table[rows] -= (step * len(rows) ** 0.5) * share[:, None] * back
    return QualityModel((table @ (layer[1] - layer[0])).astype(np.float64), float(bias[1] - bias[0]))


def learn(
    docs: DataFrame, labels: DataFrame, teach: Column, *, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", sample: int = SAMPLE, seed: int = 13,
) -> QualityModel:
    """A model from about `sample` labelled rows for which `teach`, a condition on the id, holds."""
    usable = labels.filter(teach & F.col(label_col).isNotNull()).select(id_col, label_col)
    total = usable.count()
    if not total:
        return train([], np.zeros(0))
    drawn = usable.filter(uniform(seed, F.col(id_col)) < sample / total)
    drawn = drawn.groupBy(id_col).agg((F.avg(label_col) >= 0.5).cast("int").alias("is_good"))
    # About `sample` rows of an id and a number.
    texts = docs.select(id_col, text_col).join(F.broadcast(drawn), id_col)
    texts = texts.select(F.xxhash64(id_col, text_col).alias("key"), "is_good", F.col(text_col).alias("text"))

    def count(batch: list[str]) -> dict:
        found = hashed_features(batch)
        rows = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int64)
        owner = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.int64)
        keys, counts = np.unique(owner * ROWS + rows, return_counts=True)
        cuts = np.searchsorted(keys, np.arange(len(batch) + 1) * ROWS)
        pairs = [(keys[a:b] % ROWS, counts[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
        return {
            "rows": [r.astype(np.uint16).tobytes() for r, _ in pairs],
            "counts": [np.minimum(c, 65535).astype(np.uint16).tobytes() for _, c in pairs],
        }

    counted = map_texts(
        texts, keep=("key", "is_good"), text_col="text", outputs={"rows": "binary", "counts": "binary"}, compute=count
    )
    found = sorted(counted.collect(), key=lambda r: r["key"])
    examples = [
        (np.frombuffer(r["rows"], np.uint16).astype(np.int64), np.frombuffer(r["counts"], np.uint16).astype(float))
        for r in found
    ]
    return train(examples, np.array([r["is_good"] for r in found], dtype=np.int64))


def score(
    docs: DataFrame, model: QualityModel, *, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text"
) -> DataFrame:
    """The columns of `keep` and `score`, the odds (0 to 1) of label 1, per row of `docs`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size: one number per table row

    def compute(texts: list[str]) -> dict:
        return {"score": shared.value.score(texts)}

    return map_texts(docs, keep=keep, text_col=text_col, outputs={"score": "double"}, compute=compute)
