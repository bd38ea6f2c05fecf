"""BPE encoding by dynamic programming over prefixes, and decoding.

Every prefix of a word has exactly one encoding, so it has exactly one last token. An automaton over the
vocabulary lists the tokens that end at a position; a token is the last one of that prefix if the encoding
of what stands before it ends in a token it is compatible with. Following the stored last tokens back from
the end gives the ids, in time linear in the word, without simulating merges over the text.

Two neighbouring tokens are compatible if no merge across their border comes before the merges that build
them. The test walks the two inner edges of their merge trees and is remembered per pair.

Texts are normalised and split as the tokenizer file says: NFC, white space runs to one space, lower case,
then contractions, letter runs, single numbers and other runs. Strings of special tokens become their ids.

Null texts count as empty: no ids, an empty decoded text. Empty and blank texts have no ids. Rows are
independent, so repeated rows repeat, and an empty table gives an empty table. Only the named columns are
read, so further columns cannot clash. A text of any length is encoded whole.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from adtally.llm.common import BATCH_ROWS, chunks_by_size, give_back

NEVER = 1 << 60
CACHED_WORDS = 150_000
CACHED_LENGTH = 48
ENCODED_CHARS = 500_000  # characters of one output batch
DECODED_ROWS = 200
# Below this code point composition changes nothing and all Unicode versions agree.
SIMPLE_END = 0x250


def beyond_simple() -> re.Pattern:
    """Finds what the simple pattern cannot split: other code points, and capitals whose lower case is one of them.

    The separators 28 to 31 are white space to Python but not to the file.
    """
    simple = (chr(c) for c in range(SIMPLE_END) if not 28 <= c < 32)
    return re.compile("[^" + "".join(re.escape(c) for c in simple if max(map(ord, c.lower())) < SIMPLE_END) + "]")


BEYOND = beyond_simple()


def simple_pattern() -> re.Pattern:
    """The file's word pattern (contractions, letters, one number, others) with classes spelled out for simple texts."""
    kinds = {c: unicodedata.category(c)[0] for c in map(chr, range(SIMPLE_END))}
    letters, numbers = ("".join(re.escape(c) for c in kinds if kinds[c] == k) for k in "LN")
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^\t-\r \x85\xa0{letters}{numbers}]+")


PIECE = simple_pattern()


def byte_symbols() -> list[str]:
    """The printable symbol of each byte: itself where printable, else the next free code point above 255."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class Remembered(dict):
    """Packed ids by string. When full, the entries become the old generation, from which used ones come back."""

    def __init__(self, compute: Callable[[str], bytes]) -> None:
        super().__init__()
        self.compute, self.old = compute, {}

    def __missing__(self, key: str) -> bytes:
        packed = self.old.get(key)
        if packed is None:
            packed = self.compute(key)
            if len(key) > CACHED_LENGTH:
                return packed
        if len(self) >= CACHED_WORDS:
            self.old = dict(self)
            self.clear()
        self[key] = packed
        return packed


class WordBpe:
    """A vocabulary with word ends, from a tokenizers JSON file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.ending = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = sorted(self.special, key=len, reverse=True)
        self.special_pattern = re.compile("|".join(re.escape(n) for n in names)) if names else None
        self.bytes = byte_symbols()
        self.end_bytes = [chr(0xE000 + ord(s)) for s in self.bytes]
        self._read_merges(model["merges"])
        self._build_automaton()
        self.pairs: dict[int, bool] = {}
        self.words = Remembered(lambda word: array("i", self.word_ids(word)).tobytes())
        self.runs = Remembered(lambda run: b"".join(map(self.words.__getitem__, PIECE.findall(run))))
        self.fallback = self._library_splitter(path)

    @staticmethod
    def _library_splitter(path: str):
        """The file's own normaliser and splitter, for texts beyond the simple range."""
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)

        def split(text: str) -> list[str]:
            normal = tokenizer.normalizer.normalize_str(text)
            symbols = {s: b for b, s in enumerate(byte_symbols())}
            pieces = tokenizer.pre_tokenizer.pre_tokenize_str(normal)
            return [bytes(symbols[c] for c in piece).decode("utf-8") for piece, _ in pieces]

        return split

    def _read_merges(self, merges: list) -> None:
        self.rank: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        for order, merge in enumerate(merges):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pair = self.vocab[left], self.vocab[right]
            self.rank.setdefault(pair, order)
            self.halves.setdefault(self.vocab[left + right], pair)

    def _edge(self, token: int, right: bool) -> list[tuple[int, int]]:
        """The tokens along one outer edge of a merge tree, innermost first, each with the rank that absorbs it."""
        chain = [(token, NEVER)]
        while (pair := self.halves.get(chain[-1][0])) is not None:
            chain.append((pair[1] if right else pair[0], self.rank[pair]))
        return chain[::-1]

    def compatible(self, left: int, right: int, goal: int = NEVER) -> bool:
        """Whether `left` and `right` stay apart while they are built; `goal` is the rank of a merge that may follow."""
        ends, starts = self._edge(left, True), self._edge(right, False)
        i = j = 0
        while True:
            (a, a_until), (b, b_until) = ends[i], starts[j]
            across = self.rank.get((a, b), NEVER)
            if a_until == b_until == NEVER:
                return across == goal
            # Equal ranks merge from the left: the left neighbour's merge wins over this one, this one over the right's.
            if across < a_until and across <= b_until:
                return False
            if a_until <= b_until:
                i += 1
            else:
                j += 1

    def _build_automaton(self) -> None:
        """All tokens that are the encoding of their own text. Symbols ending a word are characters of their own."""
        sound: dict[int, bool] = {}
        for _, number in sorted(self.vocab.items(), key=lambda x: len(x[0])):
            pair = self.halves.get(number)
            sound[number] = pair is None or (
                sound[pair[0]] and sound[pair[1]] and self.compatible(*pair, goal=self.rank[pair])
            )
        self.automaton = ahocorasick.Automaton()
        for name, number in self.vocab.items():
            if sound[number]:
                core = name.removesuffix(self.ending)
                key = core[:-1] + chr(0xE000 + ord(core[-1])) if core != name else core
                self.automaton.add_word(key, (len(key), number))
        self.automaton.make_automaton()

    def word_ids(self, word: str) -> list[int]:
        raw = word.encode("utf-8", "replace")
        symbols = "".join([self.bytes[b] for b in raw[:-1]]) + self.end_bytes[raw[-1]]
        size, pairs = len(symbols), self.pairs
        last, start = [-1] * size, [0] * size
        for at, (length, token) in self.automaton.iter(symbols):
            if last[at] >= 0:
                continue
            before = at - length
            if before >= 0:
                key = last[before] << 20 | token
                if key not in pairs:
                    pairs[key] = self.compatible(last[before], token)
                if not pairs[key]:
                    continue
            last[at], start[at] = token, before
        ids, at = [], size - 1
        while at >= 0:
            ids.append(last[at])
            at = start[at]
        ids.reverse()
        return ids

    def forget(self) -> None:
        """At the end of a task: what is remembered goes, since the worker process waits on through other operators."""
        for words in (self.words, self.runs):
            words.clear()
            words.old.clear()
        self.pairs.clear()

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text."""
        if self.special_pattern and any(name in text for name in self.special):
            parts, at = [], 0
            for hit in self.special_pattern.finditer(text):
                parts += [self._plain(text[at : hit.start()]), np.int32(self.special[hit.group()]).tobytes()]
                at = hit.end()
            packed = b"".join([*parts, self._plain(text[at:])])
        else:
            packed = self._plain(text)
        return np.frombuffer(packed, dtype=np.int32)

    def _plain(self, text: str) -> bytes:
        """Words never span white space, so whole runs between white space are remembered too."""
        if len(self.pairs) > 4 * CACHED_WORDS:
            self.pairs.clear()
        if BEYOND.search(text):
            return b"".join(map(self.words.__getitem__, self.fallback(text)))
        return b"".join(map(self.runs.__getitem__, text.lower().split()))


@functools.lru_cache(maxsize=4)
def token_names(path: str) -> pa.Array:
    """The name of every id of a tokenizers file; all that decoding needs."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    numbered = {n: name for name, n in spec["model"]["vocab"].items()}
    numbered |= {t["id"]: t["content"] for t in spec["added_tokens"]}
    return pa.array([numbered.get(i) for i in range(max(numbered) + 1)], type=pa.string())


def decode_ids(ids: pa.ListArray, names: pa.Array) -> pa.Array:
    """The names of each row's tokens joined by one space: the file names no decoder. Null for null ids."""
    lists = pa.ListArray.from_arrays(pc.subtract(ids.offsets, ids.offsets[0]), names.take(ids.flatten()))
    return pc.if_else(ids.is_valid(), pc.binary_join(lists, " "), None)


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> WordBpe:
    """One per worker process."""
    made = WordBpe(path)
    give_back()  # what reading the file left
    return made


def encode(df: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id_col` and the token ids of each text, as `ids` (array of int)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            for begin in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(begin, BATCH_ROWS)
                texts = [t or "" for t in part.column(1).to_pylist()]
                for start, end in chunks_by_size(texts, ENCODED_CHARS):
                    found = [bpe.encode(t) for t in texts[start:end]]
                    offsets = np.zeros(len(found) + 1, dtype=np.int32)
                    np.cumsum([len(x) for x in found], out=offsets[1:])
                    ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)))
                    yield pa.RecordBatch.from_arrays([part.column(0).slice(start, end - start), ids], ["key", "ids"])
        bpe.forget()
        give_back()

    key_type = df.schema[id_col].dataType.simpleString()
    out = df.select(id_col, text_col).mapInArrow(run, f"key {key_type}, ids array<int>")
    return out.withColumnRenamed("key", id_col)


def decode(df: DataFrame, path: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """`id_col`, the ids and their decoded text, as `decoded`. Null ids decode to an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = token_names(path)
        for batch in batches:
            for start in range(0, batch.num_rows, DECODED_ROWS):
                part = batch.slice(start, DECODED_ROWS)
                text = pc.fill_null(decode_ids(part.column(1), names), "")
                yield pa.RecordBatch.from_arrays([*part.columns, text], ["key", "ids", "decoded"])
        give_back()

    key_type = df.schema[id_col].dataType.simpleString()
    out = df.select(id_col, ids_col).mapInArrow(run, f"key {key_type}, ids array<int>, decoded string")
    return out.withColumnsRenamed({"key": id_col, "ids": ids_col})
