"""Language identification by error-correcting output codes.

Each language gets a codeword of bits. Binary classifiers over hashed letter n-grams predict the bits of a
text; the language is the one whose codeword loses least, each bit weighted by how well its classifier did
in training. A text whose two best codewords lose nearly the same is flagged as ambiguous.

Learning takes about `sample` rows per language, chosen by a hash of their id, and needs only their feature
vectors on the driver, of fixed size whatever the length of the texts. Rows with a null language or text
teach nothing. Prediction reads whole texts.

Defined results: null, empty and letterless texts are `und` with score 0 and not ambiguous; with no language
learned every text is `und`; with one, every text with a letter has it. Repeated rows repeat, an empty table
gives an empty table, and only the named columns are read.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.llm.common import chunks_by_size, code_points, map_texts, uniform
from adtally.llm.rolling import Rolling

FEATURES = 4096
SIZES = (1, 2, 3)
SAMPLE = 400
UNKNOWN = "und"


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """The lower-case letter of every code point; 32 for what is no letter."""
    table = np.full(0x110000, 32, dtype=np.uint32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            table[point] = ord(char.lower()[0])
    return table


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Root relative frequencies of hashed letter n-grams per text, and whether it has a letter."""
    out = np.zeros((len(texts), FEATURES), dtype=np.float32)
    has = np.zeros(len(texts), dtype=bool)
    for start, end in chunks_by_size(texts, 200_000):
        points, offsets = code_points([f" {t} " for t in texts[start:end]])
        points = _letters()[points]
        owner = np.repeat(np.arange(end - start, dtype=np.int64), np.diff(offsets))
        letter = points != 32
        has[start:end] = np.add.reduceat(letter, offsets[:-1], dtype=np.int64) > 0
        # Runs of non-letters count as one border.
        keep = letter.copy()
        keep[0] = True
        keep[1:] |= letter[:-1] | (owner[1:] != owner[:-1])
        points, owner = points[keep], owner[keep]
        rolling = Rolling(points)
        counts = np.zeros((end - start) * FEATURES, dtype=np.float64)
        for size in SIZES:
            hashed = rolling.windows(size)
            if not len(hashed):
                continue
            within = owner[: len(hashed)] == owner[size - 1 :]
            if size == 1:
                within &= points != 32
            slot = ((hashed * np.uint64(0xD6E8FEB86659FD93 + 2 * size)) >> np.uint64(52)).astype(np.int64)
            counts += np.bincount((owner[: len(hashed)] * FEATURES + slot)[within], minlength=len(counts))
        counts = counts.reshape(end - start, FEATURES)
        total = np.maximum(counts.sum(axis=1, keepdims=True), 1)
        out[start:end] = np.sqrt(counts / total)
    return out, has


def codebook(classes: int, seed: int = 7) -> np.ndarray:
    """Codewords of -1 and 1, one row per class: all splits of few classes, else the best spread random ones."""
    if classes < 2:
        return np.ones((classes, 1), dtype=np.float32)
    if classes <= 4:
        splits = np.arange(1, 1 << (classes - 1))
        return (((splits[None, :] >> np.arange(classes)[:, None]) & 1) * 2 - 1).astype(np.float32)
    rng, bits = np.random.default_rng(seed), 15 * int(np.ceil(np.log2(classes)))
    best, spread = None, -1.0
    for _ in range(40):
        code = rng.choice([-1.0, 1.0], size=(classes, bits)).astype(np.float32)
        code[0, np.abs(code.sum(axis=0)) == classes] *= -1
        distance = (bits - code @ code.T) / 2 + bits * np.eye(classes)
        if distance.min() > spread:
            best, spread = code, distance.min()
    return best


@dataclass
class LanguageModel:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # features x bits
    bias: np.ndarray
    trust: np.ndarray  # weight of each bit in the decoding

    def predict(self, texts: list[str], margin: float) -> tuple[list[str], np.ndarray, np.ndarray]:
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), dtype=bool)
        x, has = features(texts)
        outputs = x @ self.weights + self.bias
        loss = np.logaddexp(0, -outputs[:, None, :] * self.code[None]) @ self.trust
        order = np.argsort(loss, axis=1, kind="stable")
        rows = np.arange(len(texts))
        share = np.exp(loss.min(axis=1, keepdims=True) - loss)
        share /= share.sum(axis=1, keepdims=True)
        best = order[:, 0]
        score = share[rows, best]
        ambiguous = np.zeros(len(texts), dtype=bool)
        if len(self.languages) > 1:
            ambiguous = has & (loss[rows, order[:, 1]] - loss[rows, best] < margin)
        names = [self.languages[b] if h else UNKNOWN for b, h in zip(best, has)]
        return names, np.where(has, score, 0.0).astype(np.float64), ambiguous


def train(x: np.ndarray, labels: list[str], *, steps: int = 300, rate: float = 0.5, decay: float = 1e-5) -> LanguageModel:
    """Logistic classifiers of all bits at once, by full-batch gradient steps with momentum scaling (Adam)."""
    languages = sorted(set(labels))
    code = codebook(len(languages))
    if not languages:
        return LanguageModel([], code, np.zeros((FEATURES, 1), np.float32), np.zeros(1), np.ones(1))
    number = {name: i for i, name in enumerate(languages)}
    own = np.array([number[name] for name in labels])
    target = code[own]
    each = (len(labels) / (len(languages) * np.bincount(own, minlength=len(languages))))[own][:, None]
    w, b = np.zeros((FEATURES, code.shape[1]), np.float64), np.zeros(code.shape[1])
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)]
    for step in range(1, steps + 1):
        slope = -target / (1 + np.exp(np.clip(target * (x @ w + b), -60, 60))) * each / len(labels)
        for value, grad, at in ((w, x.T @ slope + decay * w, 0), (b, slope.sum(axis=0), 2)):
            moments[at] = 0.9 * moments[at] + 0.1 * grad
            moments[at + 1] = 0.99 * moments[at + 1] + 0.01 * grad**2
            value -= rate * moments[at] / (1 - 0.9**step) / (np.sqrt(moments[at + 1] / (1 - 0.99**step)) + 1e-9)
    right = ((x @ w + b) * target > 0).mean(axis=0)
    trust = np.maximum(right - 0.5, 1e-3)
    return LanguageModel(languages, code, w.astype(np.float32), b, trust / trust.sum())


def learn(
    docs: DataFrame, teach: Column, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    sample: int = SAMPLE, seed: int = 11,
) -> LanguageModel:
    """A model from about `sample` rows of each language for which `teach` holds."""
    known = docs.filter(teach & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = known.groupBy(F.col(lang_col).alias("lang")).agg(F.count(F.lit(1)).alias("n")).collect()
    if not counts:
        return train(np.zeros((0, FEATURES)), [])
    share = F.create_map(*[F.lit(v) for row in counts for v in (row["lang"], sample / row["n"])])
    drawn = known.filter(uniform(seed, F.col(id_col), F.lit("lang")) < share[F.col(lang_col)])

    def vectors(texts: list[str]) -> dict:
        x, has = features(texts)
        return {"x": [row.astype(np.float16).tobytes() if h else None for row, h in zip(x, has)]}

    pairs = drawn.select(F.xxhash64(id_col, text_col).alias("key"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    found = map_texts(pairs, keep=("key", "lang"), text_col="text", outputs={"x": "binary"}, compute=vectors)
    rows = found.filter("x is not null").collect()
    rows.sort(key=lambda r: (r["lang"], r["key"]))
    x = np.frombuffer(b"".join(r["x"] for r in rows), dtype=np.float16).reshape(len(rows), FEATURES).astype(np.float64)
    return train(x, [r["lang"] for r in rows])


def predict(
    docs: DataFrame, model: LanguageModel, *, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text",
    margin: float = 0.02, prefix: str = "",
) -> DataFrame:
    """The columns of `keep`, `lang_pred`, `score` and `ambiguous`, per row of `docs`.

    With a `prefix` the three new names begin with it, so that they cannot clash with kept columns.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size: features x bits

    def decide(texts: list[str]) -> dict:
        lang, score, unsure = shared.value.predict(texts, margin)
        return {f"{prefix}lang_pred": lang, f"{prefix}score": score, f"{prefix}ambiguous": unsure}

    outputs = {f"{prefix}lang_pred": "string", f"{prefix}score": "double", f"{prefix}ambiguous": "boolean"}
    return map_texts(docs, keep=keep, text_col=text_col, outputs=outputs, compute=decide)
