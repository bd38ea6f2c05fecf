"""A bidirectional FM-index over delimited words, searched in numpy for many queries at once."""

from __future__ import annotations

import numpy as np

END, DELIMITER, FIRST_CODE = 0, 1, 2
QUERIES_AT_ONCE = 4_096


def suffix_array(codes: np.ndarray) -> np.ndarray:
    """Order of all suffixes by prefix doubling; the first step ranks as many codes as fit into 62 bits."""
    n = len(codes)
    bits = max(1, int(codes.max(initial=1)).bit_length())
    width = max(1, 62 // bits)
    key = np.zeros(n, dtype=np.int64)
    for i in range(min(width, n)):
        key[: n - i] |= codes[i:].astype(np.int64) << (bits * (width - 1 - i))
    while True:
        order = np.argsort(key, kind="stable")
        steps = np.concatenate([[0], (np.diff(key[order]) != 0).cumsum()])
        if steps[-1] == n - 1:
            return order
        rank = np.empty(n, dtype=np.int64)
        rank[order] = steps
        later = np.zeros(n, dtype=np.int64)
        if width < n:
            later[: n - width] = rank[width:] + 1
        key = rank * (n + 1) + later
        width *= 2


class _Direction:
    """The index of one reading direction. `step` narrows suffix-rank intervals by one code to the left."""

    def __init__(self, codes: np.ndarray):
        self.n = len(codes)
        self.order = suffix_array(codes)
        before = codes[self.order - 1]
        # Sorted (code, rank) pairs: the place of (c, i) is the number of smaller codes plus the c's before rank i.
        self.places = np.sort(before.astype(np.int64) * self.n + np.arange(self.n))

    def step(self, low: np.ndarray, high: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        base = code.astype(np.int64) * self.n
        return np.searchsorted(self.places, base + low), np.searchsorted(self.places, base + high)


class WordIndex:
    """Index of distinct words, joined by delimiters (U+0000, which no word may hold), in both reading directions."""

    def __init__(self, words: list[str]):
        points = np.frombuffer("\x00".join(["", *words, ""]).encode("utf-32-le"), dtype=np.uint32)
        # The delimiter is the smallest code point of all, so its code is DELIMITER.
        self.letters, codes = np.unique(points, return_inverse=True)
        text = np.concatenate([codes + DELIMITER, [END]])
        self.n = len(text)
        self.delimiters = np.flatnonzero(text == DELIMITER)
        self.forward = _Direction(text)
        self.backward = _Direction(np.concatenate([text[-2::-1], [END]]))
        self.codes = np.arange(len(self.letters) + 1)

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all words in one array (a delimiter at its end), and each word's offset; -1 for unknown letters."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        at = np.minimum(np.searchsorted(self.letters, points), len(self.letters) - 1)
        codes = np.where(self.letters[at] == points, at + DELIMITER, -1)
        return np.append(codes, DELIMITER), np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)

    def _left_both(self, low, size, mirror, code):
        """Extend matches to the left by one code, keeping the interval of the mirrored text in step."""
        count, kinds = len(low), len(self.codes)
        starts, ends = self.forward.step(np.repeat(low, kinds), np.repeat(low + size, kinds), np.tile(self.codes, count))
        sizes = (ends - starts).reshape(count, kinds)
        smaller = np.cumsum(sizes, axis=1) - sizes
        rows, at = np.arange(count), np.maximum(code, 0)
        return starts.reshape(count, kinds)[rows, at], np.where(code >= 0, sizes[rows, at], 0), mirror + smaller[rows, at]

    def _first_halves(self, halves: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Suffix-rank intervals, in the mirrored text, of a delimiter followed by each half."""
        codes, offsets = self._encode(halves)
        lengths = np.diff(offsets)
        low, mirror = np.zeros(len(halves), np.int64), np.zeros(len(halves), np.int64)
        size = np.full(len(halves), self.n)
        for place in range(int(lengths.max(initial=-1)) + 1):
            now = np.flatnonzero((place <= lengths) & (size > 0))
            at = offsets[now + 1] - 1 - place
            code = np.where(place == lengths[now], DELIMITER, codes[at])
            low[now], size[now], mirror[now] = self._left_both(low[now], size[now], mirror[now], code)
        return mirror, mirror + size

    def _second_halves(self, halves: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Suffix-rank intervals of each half followed by a delimiter."""
        codes, offsets = self._encode(halves)
        lengths = np.diff(offsets)
        every = np.full(len(halves), DELIMITER)
        low, high = self.forward.step(np.zeros(len(halves), np.int64), np.full(len(halves), self.n), every)
        for place in range(int(lengths.max(initial=0))):
            now = np.flatnonzero((place < lengths) & (high > low))
            low[now], high[now] = self.forward.step(low[now], high[now], codes[offsets[now + 1] - 1 - place])
        return low, high

    def near(self, words: list[str], *, first_half: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (position in `words`, position in the index) exactly one edit apart.

        With `first_half` the pairs whose indexed word begins with the first half of the other one; without, those whose
        indexed word ends with the second half.
        """
        found = [
            self._near(words[start : start + QUERIES_AT_ONCE], start, first_half)
            for start in range(0, len(words), QUERIES_AT_ONCE)
        ]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([pair[0] for pair in found]), np.concatenate([pair[1] for pair in found])

    def _near(self, words: list[str], start: int, first_half: bool) -> tuple[np.ndarray, np.ndarray]:
        cuts = np.array([len(w) // 2 for w in words])
        codes, offsets = self._encode(words)
        halves = [w[:cut] if first_half else w[cut:] for w, cut in zip(words, cuts, strict=True)]
        distinct = sorted(set(halves))
        place_of = {half: i for i, half in enumerate(distinct)}
        which = np.array([place_of[half] for half in halves])
        if first_half:
            low, high = self._first_halves(distinct)
            lengths = np.diff(offsets) - cuts
            query, rank = _one_edit(self.backward, self.codes[FIRST_CODE:], low[which], high[which], codes, offsets[:-1] + cuts, lengths, 1)
            # The mirrored match begins at the delimiter behind the word.
            word = np.searchsorted(self.delimiters, self.n - 2 - self.backward.order[rank]) - 1
        else:
            low, high = self._second_halves(distinct)
            query, rank = _one_edit(self.forward, self.codes[FIRST_CODE:], low[which], high[which], codes, offsets[:-1] + cuts - 1, cuts, -1)
            word = np.searchsorted(self.delimiters, self.forward.order[rank])
        pairs = np.unique(query * np.int64(self.n) + word)
        return pairs // self.n + start, pairs % self.n


def _one_edit(direction, letters, low, high, codes, offsets, lengths, step):
    """Matches extended across each query's other half with exactly one edit and then by the delimiter.

    The other half of query q is read from codes[offsets[q]], in steps of `step`. Gives (query, rank) of every match.
    """

    def wanted(query: np.ndarray, place: int) -> tuple[np.ndarray, np.ndarray]:
        ended = place == lengths[query]
        return ended, np.where(ended, DELIMITER, codes[np.where(ended, -1, offsets[query] + step * place)])

    query = np.flatnonzero(high > low)
    exact = (query, low[query], high[query])
    edited = tuple(np.zeros(0, dtype=np.int64) for _ in range(3))
    hits = [(edited[0], edited[1])]
    place = 0
    while len(exact[0]) or len(edited[0]):
        q, lo, hi = exact
        ended, code = wanted(q, place)
        # Every letter that may follow: the wanted one, one in its place, or one put in before it.
        kinds = len(letters)
        starts, ends = direction.step(np.repeat(lo, kinds), np.repeat(hi, kinds), np.tile(letters, len(q)))
        some = np.flatnonzero(ends > starts)
        owner = some // kinds
        put_in = (q[owner], starts[some], ends[some])
        same = letters[some % kinds] == code[owner]
        exact = tuple(part[same] for part in put_in)
        replaced = tuple(part[~same & ~ended[owner]] for part in put_in)
        left_out = tuple(part[~ended] for part in (q, lo, hi))
        # Matches that have their edit go on exactly.
        q, lo, hi = (np.concatenate(parts) for parts in zip(edited, put_in, strict=True))
        ended, code = wanted(q, place)
        lo, hi = direction.step(lo, hi, code)
        some = hi > lo
        hits.append((q[some & ended], lo[some & ended]))
        going = some & ~ended
        edited = tuple(np.concatenate(parts) for parts in zip((q[going], lo[going], hi[going]), replaced, left_out, strict=True))
        place += 1
    return np.concatenate([hit[0] for hit in hits]), np.concatenate([hit[1] for hit in hits])
