"""Personal data: patterns with checks as a base, and a character tagger that adds spans.

The base finds e-mail and IP addresses, card and phone numbers by their contracts. The tagger, a bidirectional
LSTM with CRF transitions, learns from base spans in windows of a bounded sample of texts. It reads windows
that overlap by half around every digit and `@`: no kind can do without one. The spans of all windows of a
text are reconciled together: base spans stay, spans touching them or cut by a window's edge go, and of the
rest the set without overlaps that has the highest total margin is kept.

Defined results: null texts count as empty; texts without digits and `@` have no spans; a training sample
without spans gives a tagger that adds none. Repeated rows repeat, an empty table gives an empty table, and
only the named columns are read. Texts of any length are read whole, in time linear in their length.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.llm.common import code_points, map_texts, uniform
from adtally.llm.tagger import Tagger, symbols_of

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE, CONTEXT = 64, 32, 24
SAMPLE = 8000  # texts read for training, about
WINDOWS_EACH = 6  # training windows of one text at most
MARGIN = 0.5  # least mean margin of an added span over the tag `outside`
WINDOW_BATCH = 2048

SIGNAL = re.compile("[0-9@]")
# Fixed by the contract. Possessive: what follows a run can never be part of it.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
ADDRESS = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Every `@` in turn: the run of local characters before it, as far as the last match, and the domain after it."""
    done = 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in LOCAL:
            begin -= 1
        domain = DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            yield begin, domain.end()
            done = domain.end()
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The contract's spans, by start, then kind as listed."""
    found = []
    if "@" in text:
        found += [("email", a, b) for a, b in _emails(text)]
    if SIGNAL.search(text):
        for hit in ADDRESS.finditer(text):
            if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in hit.group().split(".")):
                found.append(("ip", hit.start(), hit.end()))
        for hit in CARD.finditer(text):
            if hit.end() - hit.start() <= 40:
                digits = re.sub("[ -]", "", hit.group())
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append(("card", hit.start(), hit.end()))
        if "+" in text:
            for hit in PHONE.finditer(text):
                if 9 <= len(re.sub("[^0-9]", "", hit.group())) <= 15:
                    found.append(("phone", hit.start(), hit.end()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def windows_of(text: str) -> list[tuple[int, bool, bool]]:
    """Starts of windows around all signals, and whether a neighbour overlaps on the left and on the right."""
    out, reach = [], -1
    regions: list[list[int]] = []
    for hit in SIGNAL.finditer(text):
        begin, end = max(0, hit.start() - CONTEXT), min(len(text), hit.end() + CONTEXT)
        if begin <= reach and regions:
            regions[-1][1] = end
        else:
            regions.append([begin, end])
        reach = end
    for begin, end in regions:
        starts = [begin]
        while starts[-1] + WINDOW < end:
            starts.append(starts[-1] + STRIDE)
        out += [(s, s != begin, s != starts[-1]) for s in starts]
    return out


def window_symbols(points: np.ndarray, starts: list[int]) -> np.ndarray:
    padded = np.concatenate([symbols_of(points), np.full(WINDOW, 95)])
    return padded[np.asarray(starts)[:, None] + np.arange(WINDOW)]


def plausible(kind: str, text: str) -> bool:
    digits = sum(c.isdigit() for c in text)
    if kind == "email":
        return "@" in text.strip("@") and len(text) >= 5
    if kind == "ip":
        return text.count(".") == 3 and digits >= 4
    return (12 <= digits <= 19 and luhn(re.sub("[^0-9]", "", text))) if kind == "card" else 9 <= digits <= 15


def reconcile(base: list[tuple[str, int, int]], candidates: list[tuple[str, int, int, float]]) -> list[tuple[str, int, int]]:
    """Base spans and the candidates of highest total weight that overlap neither them nor each other."""
    taken = sorted((a, b) for _, a, b in base)
    starts = [a for a, _ in taken]
    reach = np.maximum.accumulate([b for _, b in taken]) if taken else np.zeros(0)
    free = {}
    for kind, a, b, weight in candidates:
        place = bisect.bisect_left(starts, b)
        if not place or reach[place - 1] <= a:
            free[a, b, kind] = max(weight, free.get((a, b, kind), 0))
    options = sorted((b, a, kind, weight) for (a, b, kind), weight in free.items())
    ends = [o[0] for o in options]
    best, choice = [0.0], []
    for i, (_, a, _, weight) in enumerate(options):
        before = bisect.bisect_right(ends, a, 0, i)
        choice.append((before, best[before] + weight > best[i]))
        best.append(max(best[i], best[before] + weight))
    chosen, i = [], len(options)
    while i:
        before, used = choice[i - 1]
        if used:
            chosen.append((options[i - 1][2], options[i - 1][1], options[i - 1][0]))
        i = before if used else i - 1
    return sorted([*base, *chosen], key=lambda s: (s[1], KINDS.index(s[0])))


def tag_texts(tagger: Tagger | None, texts: list[str]) -> list[tuple[list, list]]:
    """Base spans and all spans of each text."""
    base = [base_spans(t) for t in texts]
    if tagger is None:
        return [(b, b) for b in base]
    places, rows = [], []
    for number, text in enumerate(texts):
        if SIGNAL.search(text):
            found = windows_of(text)
            places += [(number, *w) for w in found]
            rows.append(window_symbols(code_points([text])[0], [w[0] for w in found]))
    candidates: list[list] = [[] for _ in texts]
    symbols = np.concatenate(rows) if rows else np.zeros((0, WINDOW), np.int64)
    for begin in range(0, len(symbols), WINDOW_BATCH):
        tags, margin = tagger.decode(symbols[begin : begin + WINDOW_BATCH])
        for w, at in zip(*np.nonzero(tags % 2 == 1)):
            number, start, left, right = places[begin + w]
            kind, end = (tags[w, at] - 1) // 2, at + 1
            while end < WINDOW and tags[w, end] == 2 * kind + 2:
                end += 1
            if (left and at == 0) or (right and end == WINDOW) or start + end > len(texts[number]):
                continue
            weight = float(margin[w, at:end].mean())
            if weight >= MARGIN and plausible(KINDS[kind], texts[number][start + at : start + end]):
                candidates[number].append((KINDS[kind], start + int(at), start + int(end), weight * (end - at)))
    return [(b, reconcile(b, c)) for b, c in zip(base, candidates)]


def _training_windows(text: str) -> tuple[np.ndarray, np.ndarray]:
    starts = [w[0] for w in windows_of(text)][:WINDOWS_EACH]
    if not starts:
        return np.zeros((0, WINDOW), np.int64), np.zeros((0, WINDOW), np.int64)
    tags = np.zeros(len(text) + WINDOW, dtype=np.int64)
    for kind, a, b in base_spans(text):
        if not tags[a:b].any():
            tags[a:b] = 2 * KINDS.index(kind) + 2
            tags[a] -= 1
    own = tags[np.asarray(starts)[:, None] + np.arange(WINDOW)]
    cut = own[:, 0]  # a span cut by the window's edge begins there
    own[:, 0] = np.where((cut > 0) & (cut % 2 == 0), cut - 1, cut)
    return window_symbols(code_points([text])[0], starts), own


def learn(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, seed: int = 37) -> Tagger | None:
    """A tagger from the base spans in about `sample` texts; None if they have none."""
    total = docs.count()
    if not total:
        return None
    drawn = docs.filter(uniform(seed, F.col(id_col)) < sample / total).filter(F.col(text_col).rlike("[0-9@]"))

    def cut(texts: list[str]) -> dict:
        pairs = [_training_windows(t) for t in texts]
        return {"symbols": [p[0].astype(np.uint8).tobytes() for p in pairs], "tags": [p[1].astype(np.uint8).tobytes() for p in pairs]}

    keyed = drawn.select(F.xxhash64(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    made = map_texts(keyed, keep=("key",), text_col="text", outputs={"symbols": "binary", "tags": "binary"}, compute=cut)
    rows = sorted(made.collect(), key=lambda r: (r["key"], bytes(r["symbols"])))
    read = lambda name: np.frombuffer(b"".join(r[name] for r in rows), np.uint8).reshape(-1, WINDOW).astype(np.int64)
    symbols, tags = read("symbols"), read("tags")
    return Tagger.fresh(len(KINDS)).fit(symbols, tags) if tags.any() else None


def find(docs: DataFrame, tagger: Tagger | None, *, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The columns of `keep`, `base` and `spans` (kind:start:end, comma-joined), and the number of spans by kind."""
    shared = docs.sparkSession.sparkContext.broadcast(tagger)  # of fixed size

    def compute(texts: list[str]) -> dict:
        found = tag_texts(shared.value, texts)
        write = lambda spans: ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        counts = {f"n_{kind}": [sum(s[0] == kind for s in spans) for _, spans in found] for kind in KINDS}
        return {"base": [write(b) for b, _ in found], "spans": [write(s) for _, s in found], **counts}

    outputs = {"base": "string", "spans": "string", **{f"n_{kind}": "long" for kind in KINDS}}
    return map_texts(docs, keep=keep, text_col=text_col, outputs=outputs, compute=compute)
