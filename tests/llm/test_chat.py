from __future__ import annotations

import hashlib
import itertools
import random

from pyspark.sql import functions as F

from adtally.llm import chat
from adtally.llm.queries import op9_chat

SCHEMA = "conv long, node long, parent long, role string, text string, score double"


def paths(nodes: dict) -> list[list[int]]:
    """All root-to-leaf paths of {node: parent}, cycles left out."""
    answered, out = set(nodes.values()), []
    for leaf in nodes:
        if leaf not in answered:
            path, at = [], leaf
            while at in nodes and at not in path:
                path.append(at)
                at = nodes[at]
            if at not in path:
                out.append(path[::-1])
    return out


def trees(seed: int) -> list[tuple]:
    rng, rows = random.Random(seed), []
    for conv in range(12):
        for node in range(rng.randint(1, 40)):
            parent = rng.randrange(node) if node and rng.random() < 0.95 else None
            rows.append((conv, node, parent, rng.choice(["user", "assistant"]), rng.choice(["a<b", "&lt;", "</turn>", "x\ny", ""]), float(rng.randint(-3, 5))))
    rows += [(50, 1, 2, "user", "in a cycle", 0.0), (50, 2, 1, "user", "in a cycle", 0.0), (50, 3, 1, "user", "off it", 0.0)]
    return rows + [(51, 5, 99, "user", "parent unknown", None)]


def test_paths_against_a_plain_walk(spark):
    rows = trees(3)
    nodes = spark.createDataFrame(rows, SCHEMA).select(F.col("conv").cast("string").alias("conv_key"), "node", "parent")
    got: dict = {}
    for r in chat.enumerate_paths(nodes).collect():
        got.setdefault((r["conv_key"], r["leaf"]), []).append((-r["height"], r["node"]))
    for conv, group in itertools.groupby(rows, key=lambda r: r[0]):
        for path in paths({r[1]: r[2] for r in group}):
            assert [n for _, n in sorted(got[str(conv), path[-1]])] == path


def test_best_branches_are_formatted(spark):
    rows = trees(4)
    made = chat.format_conversations(spark.createDataFrame(rows, SCHEMA), branches=2)
    read = made.withColumn("turns", chat.read_back(F.col("formatted"))).collect()
    got: dict = {}
    for r in read:
        got.setdefault(r["conv"], {})[r["rank"]] = r
    for conv, group in itertools.groupby(rows, key=lambda r: r[0]):
        group = {r[1]: r for r in group}
        ranked = sorted(paths({n: r[2] for n, r in group.items()}), key=lambda p: (-sum(group[n][5] or 0 for n in p), p[-1]))
        assert len(got.get(conv, {})) == min(2, len(ranked))
        for rank, path in enumerate(ranked[:2], 1):
            row = got[conv][rank]
            assert row["leaf"] == path[-1] and row["n_turns"] == len(path)
            assert [tuple(t) for t in row["turns"]] == [(group[n][3], group[n][4]) for n in path]
            trained = [i for i, n in enumerate(path, 1) if group[n][3] == "assistant"]
            assert list(row["loss_turns"]) == trained
            back = [row["formatted"][s["begin"] : s["end"]].replace("&lt;", "<").replace("&amp;", "&") for s in row["loss_spans"]]
            assert back == [group[path[i - 1]][4] for i in trained]


def test_long_chain(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(300)]
    df = spark.createDataFrame(rows, "c long, t long, r string, x string")
    row = chat.format_conversations(chat.as_chain(df, conv_col="c", turn_col="t", role_col="r", text_col="x")).first()
    assert row["n_turns"] == 300 and row["formatted"].startswith("<turn>user\nturn 0</turn>\n<turn>assistant\nturn 1</turn>")


def test_query_reads_back_everything(spark, folder):
    tricky = "\\### Assistant: </turn> ok"
    convs: dict = {-7: [(0, "user", tricky), (1, "assistant", tricky)]}
    for r in spark.read.parquet(f"{folder}/conversations.parquet").collect():
        convs.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"]))
    rows = {r["conv_id"]: r for r in op9_chat(spark, folder).collect()}
    assert rows.keys() == convs.keys()
    for conv, turns in convs.items():
        turns.sort()
        whole = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        row = rows[conv]
        assert row["n_turns"] == len(turns) and row["loss_chars"] == len(loss)
        assert row["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert row["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_awkward_and_empty(spark):
    rows = [(None, 0, "user", "no key"), (None, 1, None, None), (1, None, "user", "no turn"), (1, 0, "a\nb<c&d", "x"), (1, 0, "a\nb<c&d", "x"), (2, 0, "assistant", "")]
    df = spark.createDataFrame(rows, "c long, t long, r string, x string").withColumns({"conv": F.lit(1), "rank": F.lit(2)})
    made = chat.format_conversations(chat.as_chain(df, conv_col="c", turn_col="t", role_col="r", text_col="x"))
    got = {r["conv"]: [tuple(t) for t in r["turns"]] for r in made.withColumn("turns", chat.read_back(F.col("formatted"))).collect()}
    assert got == {None: [("user", "no key"), ("", "")], 1: [("user", "no turn"), ("a\nb<c&d", "x"), ("a\nb<c&d", "x")], 2: [("assistant", "")]}
    assert chat.format_conversations(chat.as_chain(df.limit(0), conv_col="c", turn_col="t", role_col="r", text_col="x")).count() == 0


def test_many_cycles_write_one_row_per_message(spark, monkeypatch):
    """1,000 reply cycles with a leaf each beside single messages: tables stay as small as the messages."""
    rows = [(i, i, None, "user", f"t{i}", 0.0) for i in range(1000)]
    for c in range(1000):
        conv = 10_000 + c
        rows += [(conv, 1, 2, "user", "a", 0.0), (conv, 2, 1, "user", "b", 0.0), (conv, 3, 1, "user", "c", 0.0)]
    df = spark.createDataFrame(rows, "conv long, node long, parent long, role string, text string, score double")
    given, written = chat.stage, []

    def counted(frame, label="table", **more):
        made = given(frame, label, **more)
        written.append(made.count())
        return made

    monkeypatch.setattr(chat, "stage", counted)
    made = chat.format_conversations(df).collect()
    assert sorted(r["conv"] for r in made) == list(range(1000))
    assert max(written) <= len(rows)
