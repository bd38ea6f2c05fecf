from __future__ import annotations

import random
import re
from dataclasses import replace

import pytest

from adtally.llm import shingle_join
from adtally.llm.queries import op5_shingle_join
from tests.llm.helpers import awkward, documents, empty

LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text: str | None) -> frozenset:
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows: list[tuple]) -> list[tuple]:
    """Component ids by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    part = list(range(len(rows)))

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and min(len(sets[i]), len(sets[j])) * 100 >= 80 * max(len(sets[i]), len(sets[j])):
                both = len(sets[i] & sets[j])
                if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    part[root(i)] = root(j)
    least: dict = {}
    for i, (doc, _) in enumerate(rows):
        known = [d for d in (least.get(root(i)), doc) if d is not None]
        least[root(i)] = min(known) if known else None
    return sorted(((d, len(s), least[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def result(df) -> list[tuple]:
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in shingle_join.join_similar(df).collect()), key=str)


def edited(rng: random.Random, words: list[str], share: float) -> list[str]:
    out = list(words)
    for _ in range(int(len(words) * share) + 1):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return out[: len(out) - rng.randrange(3)] if len(out) > 8 else out


def made(seed: int) -> list[str]:
    rng, texts = random.Random(seed), []
    common = [f"common{i}" for i in range(40)]
    for size in [1, 2, 4, 5, 6, 7, 8, 9, 10, 12, 14, 16, 20, 30, 45, 80, 150, 300]:
        for _ in range(3):
            base = [f"w{rng.randrange(3000)}" for _ in range(size)]
            if rng.random() < 0.5 and size > 60:
                base[10:50] = common
            texts += [" ".join(edited(rng, base, rng.choice([0, 0.005, 0.01, 0.02, 0.03]))) for _ in range(6)]
            texts += [" ".join(base), " ".join(base).upper()]
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_components_against_all_pairs(spark, seed):
    texts = made(seed)
    random.Random(seed).shuffle(texts)
    df = documents(spark, texts).repartition(6)
    assert result(df) == brute(list(enumerate(texts)))


@pytest.mark.parametrize("rounds", [1, 6])
def test_large_group_and_chains(spark, monkeypatch, rounds):
    """Copies of copies: neighbours link, the ends do not; long lists, several hubs, or one and then positions."""
    monkeypatch.setattr(shingle_join, "STAR_ROUNDS", rounds)
    monkeypatch.setattr(shingle_join, "STILL_FALLING", 2.0)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(120)]
    texts = []
    for _ in range(150):
        words = list(words)
        words[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    texts += ["a b c d e f g", "zz"]
    rng.shuffle(texts)
    assert result(documents(spark, texts).repartition(4)) == brute(list(enumerate(texts)))


def test_long_lists_pass_through(spark, monkeypatch):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(edited(rng, words, 0.01)) for _ in range(60)] + ["other words stand here alone now"]
    given = shingle_join.token_order
    monkeypatch.setattr(shingle_join, "token_order", lambda *a: replace(given(*a), long_list=20))
    assert result(documents(spark, texts)) == brute(list(enumerate(texts)))


@pytest.mark.parametrize("boundary", [0, 8, 500])
def test_any_boundary_gives_all_links(spark, monkeypatch, boundary):
    monkeypatch.setattr(shingle_join, "cheapest_boundary", lambda sizes, length: boundary)
    texts = made(3)[::2]
    assert result(documents(spark, texts)) == brute(list(enumerate(texts)))


@pytest.mark.parametrize("boundary", [0, 500])
def test_strangers_sharing_a_passage_make_few_pairs(spark, monkeypatch, boundary):
    """2,000 texts of which most is one passage, and 200 copies: compared pairs stay a small multiple of the texts."""
    monkeypatch.setattr(shingle_join, "cheapest_boundary", lambda sizes, length: boundary)
    rng, compared = random.Random(9), []
    given = shingle_join.linked
    monkeypatch.setattr(shingle_join, "linked", lambda pairs, sets: compared.append(pairs.count()) or given(pairs, sets))
    passage = [f"passage{i}" for i in range(60)]
    texts = []
    for i in range(2000):
        own = [f"own{rng.randrange(10**9)}" for _ in range(rng.randrange(12, 25))]
        texts.append(" ".join(own[:6] + passage + own[6:]))
    texts += [texts[i] + " and one more" for i in range(0, 2000, 10)]
    got = result(documents(spark, texts).repartition(4))
    assert [c for _, _, c in sorted(got)] == [*range(2000), *range(0, 2000, 10)]
    assert sum(compared) <= 5 * len(texts)


def test_boundary_follows_the_cost():
    assert shingle_join.cheapest_boundary({}, 1.0) == 0
    assert shingle_join.cheapest_boundary({300: 10}, 1.0) == 0
    few, many = shingle_join.cheapest_boundary({n: 10 for n in range(2, 100)}, 1.0), shingle_join.cheapest_boundary({n: 10 for n in range(2, 100)}, 20.0)
    assert 0 < few <= many


def test_query(spark, folder):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    rows = [tuple(r) for r in op5_shingle_join(spark, folder).select("doc_id", "n_shingles", "component_id").collect()]
    assert sorted(rows, key=str) == brute(docs)


def test_awkward_and_empty(spark):
    df = awkward(spark)
    assert result(df) == brute([(r["doc_id"], r["text"]) for r in df.collect()])
    assert shingle_join.join_similar(empty(spark)).count() == 0
    assert result(documents(spark, [None, "", " \n"])) == [(0, 0, 0), (1, 0, 1), (2, 0, 2)]
