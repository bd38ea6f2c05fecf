"""Spelling variants: words one edit apart, grouped under the more frequent form.

Words are counted over all texts, then each word looks for its near words: those that differ by exactly one
inserted, deleted or replaced code point. One edit leaves the first or the second half of a word as it is, so a
bidirectional FM-index over the delimited vocabulary is searched by two schemes: match one half exactly, then
extend the suffix-rank interval across the other half, allowing one edit. Pairs that both schemes find are
kept from the first only.

The vocabulary is cut into blocks of neighbouring words, once in the order of the words for the first scheme
and once in the order of their mirror images for the second. The words that begin (end) with a half lie
together in that order, so a word is sent to the one or few blocks that hold them. Blocks
asked by very many words are indexed by several tasks, each for a part of the asking words. The driver holds the first
word of every block.

Defined results: a null text has no words, a null id reads as an empty one, repeated rows count each time. Words
below the least length or count are left out, both as words and as forms. Ties for the form go to the smallest
word in code-point order. An empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.llm.common import chunks_by_size
from adtally.llm.fm_index import WordIndex
from adtally.sources.staging import release, stage

# Fixed by the contract: the letters of a word, and the rule by which single letters are dropped.
LETTERS = "a-zÀ-ÿ"
DROP_ONE_IN = 199

COUNTED_AT_ONCE = 100_000  # distinct words a task holds before it hands them on
BLOCK_WORDS = 20_000
ASKED_AT_ONCE = 60_000  # words that one task looks up in a block
BEYOND = "\U0010ffff"


def _altered(key: bytes, word: str) -> str:
    h = zlib.crc32(word.encode(), zlib.crc32(key + b":"))
    if h % DROP_ONE_IN:
        return word
    place = h % len(word)
    return word[:place] + word[place + 1 :]


def count_words(
    df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6, least_count: int = 5
) -> DataFrame:
    """(word, n) of all words of at least `least_length` code points and `least_count` occurrences."""
    # Dropping a letter only shortens: shorter runs cannot become words.
    run_of_letters = re.compile(f"[{LETTERS}]{{{least_length},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def handed_on() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])
            counts.clear()
            return made

        for batch in batches:
            keys, texts = (batch.column(i).to_pylist() for i in range(2))
            for start, end in chunks_by_size(texts):
                for key, text in zip(keys[start:end], texts[start:end], strict=True):
                    # Bytes are lower-cased within A-Z only.
                    lowered = text.encode().lower().decode()
                    prefix = key.encode()
                    for word, times in Counter(run_of_letters.findall(lowered)).items():
                        made = _altered(prefix, word)
                        if len(made) >= least_length:
                            counts[made] += times
                    if len(counts) > COUNTED_AT_ONCE:
                        yield handed_on()
        yield handed_on()

    key = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    given = df.select(key.alias("key"), F.col(f"`{text_col}`").alias("text")).filter("text is not null")
    return given.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _block_starts(words: DataFrame, blocks: int) -> list[str]:
    """First keys of `blocks` ranges of about equally many words, in order."""
    ranged = words.select("key").repartitionByRange(blocks, "key").groupBy(F.spark_partition_id().alias("part"))
    return sorted(row["first"] for row in ranged.agg(F.min("key").alias("first")).collect())


def _routed(words: DataFrame, starts: list[str], *, first_half: bool) -> DataFrame:
    """(block, word, n, asks): every word in its block, with its count, and as a question to the blocks of its half."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks, words, counts, asks = [], [], [], []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                key = word if first_half else word[::-1]
                half = key[: len(word) // 2 if first_half else len(word) - len(word) // 2]
                own = max(0, bisect_right(starts, key) - 1)
                asked = range(max(0, bisect_right(starts, half) - 1), max(0, bisect_right(starts, half + BEYOND) - 1) + 1)
                blocks += [own, *asked]
                words += [word] * (1 + len(asked))
                counts += [n] * (1 + len(asked))
                asks += [False] + [True] * len(asked)
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int32()), pa.array(words, pa.string()), pa.array(counts, pa.int64()), pa.array(asks, pa.bool_())],
                ["block", "word", "n", "asks"],
            )

    return words.select("word", "n").mapInArrow(run, "block int, word string, n long, asks boolean")


def _searcher(first_half: bool) -> Callable[[pa.Table], pa.Table]:
    """Looks up a block's asking words in an index of its own words."""

    def search(table: pa.Table) -> pa.Table:
        words, counts, asks = (table.column(name).to_pylist() for name in ("word", "n", "asks"))
        indexed = [(w, n) for w, n, a in zip(words, counts, asks, strict=True) if not a]
        asking = [w for w, a in zip(words, asks, strict=True) if a]
        found = WordIndex([w for w, _ in indexed]).near(asking, first_half=first_half)
        pairs = [(asking[i], *indexed[j]) for i, j in zip(*(part.tolist() for part in found), strict=True)]
        if not first_half:
            pairs = [pair for pair in pairs if not pair[1].startswith(pair[0][: len(pair[0]) // 2])]
        kinds = {"word": pa.string(), "near": pa.string(), "near_n": pa.int64()}
        return pa.table({name: pa.array([pair[i] for pair in pairs], kind) for i, (name, kind) in enumerate(kinds.items())})

    return search


def near_words(words: DataFrame, *, block_words: int = BLOCK_WORDS, asked_at_once: int = ASKED_AT_ONCE) -> DataFrame:
    """(word, near, near_n): every ordered pair of words one edit apart, once. `words` has distinct words and their n."""
    blocks = max(1, -(-words.count() // block_words))
    found = []
    for first_half in (True, False):
        key = F.col("word") if first_half else F.reverse("word")
        starts = _block_starts(words.withColumn("key", key), blocks) if blocks > 1 else [""]
        routed = stage(_routed(words, starts, first_half=first_half), "routed")
        # One row per block. Parts of a block's questions are told by a hash of the word.
        parts = routed.groupBy("block").agg((F.floor(F.count_if("asks") / asked_at_once) + 1).cast("int").alias("parts"))
        sized = routed.join(parts, "block")
        own = F.array(F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
        part = F.explode(F.when(F.col("asks"), own).otherwise(F.sequence(F.lit(0), F.col("parts") - 1)))
        dealt = sized.select("block", part.alias("part"), "word", "n", "asks")

        found.append(dealt.groupBy("block", "part").applyInArrow(_searcher(first_half), "word string, near string, near_n long"))
    return found[0].unionByName(found[1])


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word with a form: the last form on the way, by doubling the steps."""
    current = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = current.select(F.col("word").alias("passed"), F.col("root").alias("next"))
        joined = current.join(ahead, F.col("root") == F.col("passed"), "left")
        stepped = stage(joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        release(current)
        current = stepped
        # A form has several times the occurrences of its word, so the ways are short and have no cycles.
        if current.filter("moved").isEmpty():
            return current.select("word", "root")


def spelling_forms(
    df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6, least_count: int = 5, times: int = 5
) -> DataFrame:
    """word, form, root, n, n_near, form_n for every counted word.

    `form` is the most frequent near word if it has at least `times` the occurrences, `root` the end of the forms' way.
    """
    if times < 2:
        raise ValueError("a form must be at least twice as frequent as its word")
    words = stage(count_words(df, id_col=id_col, text_col=text_col, least_length=least_length, least_count=least_count), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("minus_n"), F.col("near"))).alias("best")
    near = near_words(words).groupBy(F.col("word").alias("of")).agg(F.count(F.lit(1)).alias("n_near"), best)
    enough = -F.col("best.minus_n") >= F.col("n") * times
    listed = stage(
        words.join(near, F.col("word") == F.col("of"), "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.minus_n")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(listed.filter("form is not null")).withColumnRenamed("word", "of")
    joined = listed.join(roots, F.col("word") == F.col("of"), "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
