"""The corpus pipeline: documents to token ids, each stage written and read again.

Stages work on every row their predecessor kept; all but the last return the columns of documents.

* language: rows without a letter and rows whose language is ambiguous go.
* lines: recurring lines are cut from the texts; rows stay, `n_chars` follows the text.
* near_duplicates: of each group of linked documents the one with the smallest id stays, once; documents
  without words and rows with a null id stay.
* mixture: a document stands in the mix as often as its share of taken words says; repeats are repeated rows.
* bpe: token ids and the text they decode to.

No SQL equivalent: the language model is fitted and the tokenizer's merges have no SQL form.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.llm import bpe, language_id, line_templates, mixture, shingle_join
from adtally.llm.common import WORD, fold
from adtally.sources.staging import delete_tables, recorded, shared_folder, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Ids sent to every task: 16 bytes each. Beyond that both sides of a join are partitioned by id.
MAX_BROADCAST_IDS = 2_000_000


_staged: dict[str, list[str]] = {}


def _released(step: Stage) -> Stage:
    """A stage's intermediate tables go when the session's next stage begins: by then its result has been written."""

    @wraps(step)
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        session = spark.sparkContext.applicationId
        delete_tables(spark, _staged.pop(session, []))
        with recorded() as paths:
            result = step(spark, docs, sf_dir)
        _staged[session] = paths
        return result

    return run_step


def _free(docs: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of the documents begins with them."""
    longest = max(map(len, docs.columns), default=0)
    return [name.ljust(longest + 1, "_") if any(c.startswith(name) for c in docs.columns) else name for name in names]


def _checked(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if ids.count() <= MAX_BROADCAST_IDS else ids


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.learn(docs, fold("doc_id", 3) != 1)
    (prefix,) = _free(docs, "language_stage_")
    found = language_id.predict(docs, model, keep=tuple(docs.columns), prefix=prefix)
    known = F.col(f"{prefix}lang_pred") != language_id.UNKNOWN
    return found.filter(known & ~F.col(f"{prefix}ambiguous")).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = line_templates.drop_recurring_lines(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    gone_id, once = _free(docs, "gone_id", "only_once")
    found = stage(shingle_join.join_similar(docs), "components")
    gone = found.filter("doc_id != component_id").select(F.col("doc_id").alias(gone_id)).distinct()
    gone = _checked(stage(gone, "gone"))
    kept = docs.join(gone, F.col("doc_id") == F.col(gone_id), "left_anti")
    repeated = found.filter("node is not null and doc_id is not null").groupBy("doc_id", "node").count().filter("count > 1")
    if repeated.isEmpty():
        return kept
    # Rows with an id and words stand once per text; all others stay as they are.
    named = F.col("doc_id").isNotNull() & F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    single = kept.filter(named).withColumn(once, F.xxhash64("text")).dropDuplicates(["doc_id", once]).select(*docs.columns)
    return single.unionByName(kept.filter(~named))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mix_id, mix_times, mix_copy = _free(docs, "mix_id", "mix_times", "mix_copy")
    rows = mixture.mix_sources(docs).documents
    times = F.max(mixture.copies(F.col("size"), F.col("taken"), "doc_id")).alias(mix_times)
    times = stage(rows.groupBy(F.col("doc_id").alias(mix_id)).agg(times).filter(F.col(mix_times) > 0), "copies")
    met = docs.join(_checked(times), F.col("doc_id").eqNullSafe(F.col(mix_id)))
    return met.withColumn(mix_copy, F.explode(F.sequence(F.lit(1), F.col(mix_times)))).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.decode(bpe.encode(docs, path), path)


STAGES: list[tuple[str, Stage]] = [
    ("language", _released(language)),
    ("lines", _released(lines)),
    ("near_duplicates", _released(near_duplicates)),
    ("mixture", _released(mixed)),
    ("bpe", _released(tokens)),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over the documents of a folder."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, step in STAGES:
        path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        # What the stage read is not needed any more.
        delete_tables(spark, before)
        before = [path]
    return docs
