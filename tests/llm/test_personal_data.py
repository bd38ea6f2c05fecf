from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from adtally.llm import personal_data as pii
from adtally.llm.queries import op3_personal_data
from adtally.llm.tagger import Tagger
from tests.llm.helpers import awkward, documents, empty

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text: str) -> list:
    out = []
    for kind, pattern in PATTERNS.items():
        for hit in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", hit.group())
            fine = kind == "email"
            fine |= kind == "ip" and all(int(p) <= 255 for p in hit.group().split("."))
            fine |= kind == "card" and 12 <= len(digits) <= 19 and pii.luhn(digits)
            fine |= kind == "phone" and 9 <= len(digits) <= 15
            if fine:
                out.append((kind, hit.start(), hit.end()))
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_base_against_the_patterns():
    rng = random.Random(5)
    for letters in ("a@.1+-23 (9)é%", "4 -1", "a@.", "+1 2()", "1.25"):
        for _ in range(3000):
            text = "".join(rng.choices(letters, k=rng.randint(1, 60)))
            assert pii.base_spans(text) == brute(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+1" * 150_000, "+1" + " " * 300_000, "a@" * 150_000):
        pii.base_spans(text)
        pii.tag_texts(None, [text])


def test_slopes_of_the_tagger():
    tagger, rng = Tagger.fresh(2, hidden=3, width=4), np.random.default_rng(0)
    symbols = rng.integers(0, 100, (3, 7))
    tags = np.array([[0, 1, 2, 0, 3, 4, 4], [0] * 7, [1, 2, 2, 2, 0, 3, 0]])
    _, slopes = tagger.loss_and_slopes(symbols, tags)
    for name, values in tagger.values.items():
        place = (int(symbols[0, 1]), 1) if name == "e" else tuple(rng.integers(0, n) for n in values.shape)
        kept, losses = values[place], []
        for step in (1e-5, -1e-5):
            values[place] = kept + step
            losses.append(tagger.loss_and_slopes(symbols, tags)[0])
        values[place] = kept
        assert abs((losses[0] - losses[1]) / 2e-5 - slopes[name][place]) < 1e-5, name


@pytest.fixture(scope="module")
def tagger():
    rng, symbols, tags = random.Random(8), [], []
    words = "the tion heerth er and of onea ing wh".split()
    for _ in range(700):
        number = "".join(rng.choices("0123456789", k=4))
        piece = rng.choice([f"{''.join(rng.choices('abcdef', k=6))}.{number[:2]}@mail{number[2]}.example.com",
                            f"{number[:2]}.1{number[1]}.{number[2]}.2{number[3]}", f"+1 (5{number[:2]}) 555-{number}", number])
        own = pii._training_windows(" ".join([*rng.choices(words, k=rng.randint(1, 9)), piece, *rng.choices(words, k=9)]))
        symbols.append(own[0])
        tags.append(own[1])
    return Tagger.fresh(4).fit(np.concatenate(symbols), np.concatenate(tags))


def test_tagger_adds_spans_and_keeps_the_base(tagger):
    text = "the heerth josé.12@mail3.example.com and of 27.109.211.155 onea"
    [(base, spans)] = pii.tag_texts(tagger, [text])
    assert set(base) <= set(spans) and base == brute(text)
    assert any(kind == "email" and text[a:b].endswith("@mail3.example.com") for kind, a, b in spans)
    [(base, spans)] = pii.tag_texts(tagger, ["the tion of and er " * 50])
    assert base == spans == []


def test_reconciling_is_best_without_overlap():
    rng = random.Random(9)
    for _ in range(300):
        base = [("ip", 10, 14)] if rng.random() < 0.5 else []
        options = [("card", a, a + rng.randint(1, 5), rng.random()) for a in rng.choices(range(20), k=7)]
        got = pii.reconcile(base, options)
        best = 0.0
        for mask in range(1 << len(options)):
            chosen = [o for i, o in enumerate(options) if mask >> i & 1]
            spans = sorted([o[1:3] for o in chosen] + [b[1:3] for b in base])
            if all(x[1] <= y[0] for x, y in zip(spans, spans[1:])):
                best = max(best, sum(o[3] for o in chosen))
        weights = {}
        for o in options:
            weights[o[:3]] = max(o[3], weights.get(o[:3], 0))
        assert abs(sum(weights[s] for s in got if s not in base) - best) < 1e-9
        assert set(base) <= set(got)


def test_query(spark, folder):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op3_personal_data(spark, folder).collect()
    assert len(rows) == len(texts)
    for row in rows:
        base = [f"{k}:{a}:{b}" for k, a, b in brute(texts[row["doc_id"]])]
        spans = [s for s in row["spans"].split(",") if s]
        assert row["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(spans)
        for kind in pii.KINDS:
            assert row[f"n_{kind}"] == sum(s.startswith(f"{kind}:") for s in spans)


def test_the_query_counts_base_spans_only(spark, tagger, tmp_path, monkeypatch):
    texts = ["of 1 (512) 555-1234 er", "of and 999.12.3.21 er", "of heerth abcdef.12@mail3 example.com er", "of 27.109.211.155 the ip: card:", None]
    documents(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(pii, "learn", lambda docs: tagger)
    rows = op3_personal_data(spark, str(tmp_path)).collect()
    added = 0
    for row in rows:
        base = brute(texts[row["doc_id"]] or "")
        added += row["spans"].count(":") // 2 - len(base)
        assert [row[f"n_{kind}"] for kind in pii.KINDS] == [sum(b[0] == kind for b in base) for kind in pii.KINDS]
        assert row["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
    assert len(rows) == len(texts) and added >= 3


def test_awkward_and_empty(spark):
    df = awkward(spark)
    assert pii.find(df, pii.learn(df)).count() == df.count()
    assert pii.learn(empty(spark)) is None
    assert pii.find(empty(spark), None).count() == 0
    row = pii.find(documents(spark, ["a@b.c"]), None).first()
    assert row["spans"] == "email:0:5" and row["n_email"] == 1
