"""Chat formatting over reply trees.

Messages point to the message they answer. Self-joins on jump tables, doubled each round, first carry every
message's score sum up to its root, in as many rounds as the depth has binary digits, one row per message.
Branches of one conversation are ranked by the sum of their messages' scores, ties to the smaller leaf. Only the
best ones are then enumerated from leaf to root, by the same doubling, and written as one text.

The template puts every message between `<turn>` and `</turn>`, its role on the first line. `&`, `<` and, in
roles, line breaks are escaped, so no text can hold a control string, and reading back gives every role and
text unchanged. The loss mask lists the spans of assistant texts in code points of the formatted text.

Defined results: null roles and texts count as empty; a null conversation key is a conversation of its own;
a parent that is null or missing makes a root; messages that only lead into a cycle of replies have no root
and are left out; of several messages with one id each is a node of its own under `as_chain`, while reply
trees need ids unique in their conversation. A conversation without rows does not appear, an empty table
gives an empty table, and only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adtally.sources.staging import stage

OPEN, CLOSE = "<turn>", "</turn>\n"
TRAINED = "assistant"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("&br;"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("&br;"), F.lit("\n")))


def as_chain(rows: DataFrame, *, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Rows by turn as reply trees without branches: each row answers the one before it."""
    clean = rows.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
        F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"),
    )
    place = F.row_number().over(Window.partitionBy("conv").orderBy("turn", "role", "text"))
    placed = clean.withColumn("node", place.cast("long"))
    parent = F.when(F.col("node") > 1, F.col("node") - 1)
    return placed.select("conv", "node", parent.alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def _longest(messages: DataFrame) -> int:
    """The number of messages of the largest conversation: no path is longer."""
    return messages.groupBy("conv_key").count().agg(F.max("count")).first()[0] or 0


def sums_to_root(messages: DataFrame, longest: int) -> DataFrame:
    """Rows (conv_key, node, path_score, depth) of the messages that have a root, with the scores' sum from it.

    One row per message and round. What still has a message above it after as many steps as the largest conversation
    has messages leads into a cycle.
    """
    known = messages.select("conv_key", F.col("node").alias("parent"), F.lit(True).alias("is_known"))
    first = messages.select("conv_key", "node", "parent", "score").join(known, ["conv_key", "parent"], "left")
    above = F.when(F.col("is_known"), F.col("parent")).alias("above")
    reach = stage(first.select("conv_key", "node", above, F.col("score").alias("path_score"), F.lit(1).cast("long").alias("depth")), "reach")
    # Only messages still on their way are joined; those that have arrived are looked up.
    arrived, on_way, span = reach.filter("above is null"), reach.filter("above is not null"), 1
    while span <= longest and not on_way.isEmpty():
        further = arrived.unionByName(on_way).select(
            "conv_key", F.col("node").alias("above"), F.col("above").alias("top"), F.col("path_score").alias("more"), F.col("depth").alias("steps")
        )
        later = on_way.join(further, ["conv_key", "above"]).select(
            "conv_key", "node", F.col("top").alias("above"), (F.col("path_score") + F.col("more")).alias("path_score"),
            (F.col("depth") + F.col("steps")).alias("depth"),
        )
        later = stage(later, "reach")
        arrived, on_way = arrived.unionByName(later.filter("above is null")), later.filter("above is not null")
        span *= 2
    return arrived.select("conv_key", "node", "path_score", "depth")


def _leaves(messages: DataFrame) -> DataFrame:
    """(conv_key, node) of the messages that no other one answers."""
    answered = messages.filter("parent is not null").select("conv_key", F.col("parent").alias("node")).distinct()
    return messages.select("conv_key", "node").join(answered, ["conv_key", "node"], "left_anti")


def enumerate_paths(messages: DataFrame, leaves: DataFrame | None = None, longest: int | None = None) -> DataFrame:
    """Rows (conv_key, leaf, node, height): every message on the paths of the leaves, height 0 at the leaf.

    `messages` has conv_key, node and parent, `leaves` conv_key and node (all leaves, if not given). All tables are written each round, so plans stay small and a
    lost executor costs a reread.
    """
    leaves = _leaves(messages) if leaves is None else leaves
    longest = _longest(messages) if longest is None else longest
    edges = messages.select("conv_key", "node", "parent")
    known = edges.select("conv_key", F.col("node").alias("parent"))
    jumps = stage(edges.join(known, ["conv_key", "parent"]).select("conv_key", "node", F.col("parent").alias("above")), "jumps")
    paths = stage(leaves.select("conv_key", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("height")), "paths")
    found, span = [paths], 1
    while span <= longest:
        so_far = found[0]
        for part in found[1:]:
            so_far = so_far.unionByName(part)
        higher = so_far.join(jumps, ["conv_key", "node"]).select(
            "conv_key", "leaf", F.col("above").alias("node"), (F.col("height") + span).alias("height")
        )
        higher = stage(higher, "paths")
        if higher.isEmpty():
            break
        found.append(higher)
        further = jumps.select("conv_key", F.col("node").alias("above"), F.col("above").alias("top"))
        jumps = stage(
            jumps.join(further, ["conv_key", "above"]).select("conv_key", "node", F.col("top").alias("above")), "jumps"
        )
        span *= 2
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def format_conversations(messages: DataFrame, *, branches: int = 1) -> DataFrame:
    """The best `branches` paths of every conversation, each as one text.

    `messages` has conv, node, parent, role, text and score. The result has conv, leaf, rank, path_score,
    n_turns, formatted, loss_spans (arrays of begin and end, end exclusive) and loss_turns (from 1).
    """
    key = F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit("null")).alias("conv_key")
    nodes = stage(
        messages.select(
            key, "conv", "node", "parent", F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"), F.coalesce("score", F.lit(0.0)).alias("score"),
        ),
        "messages",
    )
    longest = _longest(nodes)
    leaves = sums_to_root(nodes, longest).join(_leaves(nodes), ["conv_key", "node"], "left_semi")
    best = Window.partitionBy("conv_key").orderBy(F.desc("path_score"), "leaf")
    ranked = leaves.withColumnRenamed("node", "leaf").withColumn("rank", F.row_number().over(best))
    top = (F.col("depth") - 1).alias("top")
    chosen = stage(ranked.filter(F.col("rank") <= branches).select("conv_key", "leaf", "path_score", "rank", top), "chosen")
    paths = enumerate_paths(nodes, chosen.select("conv_key", F.col("leaf").alias("node")), longest)
    head = F.concat(F.lit(OPEN), escaped_role(F.col("role")), F.lit("\n"))
    steps = (
        paths.join(chosen, ["conv_key", "leaf"])
        .join(nodes.select("conv_key", "conv", "node", "role", "text"), ["conv_key", "node"])
        .select(
            "conv_key", "leaf", "conv", "rank", "path_score", (F.col("top") - F.col("height")).alias("place"),
            F.concat(head, escaped(F.col("text")), F.lit(CLOSE)).alias("piece"),
            F.length(head).cast("long").alias("ahead"), F.length(escaped(F.col("text"))).cast("long").alias("inside"),
            (F.col("role") == TRAINED).alias("trained"),
        )
    )
    before = Window.partitionBy("conv_key", "leaf").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum(F.length("piece").cast("long")).over(before), F.lit(0)) + F.col("ahead")
    return (
        steps.withColumn("begin", begin)
        .groupBy("conv_key", "leaf")
        .agg(
            F.first("conv").alias("conv"), F.first("rank").alias("rank"), F.first("path_score").alias("path_score"),
            F.count(F.lit(1)).alias("n_turns"),
            F.array_sort(F.collect_list(F.struct("place", "piece", "begin", "inside", "trained"))).alias("steps"),
        )
        .select(
            "conv", "leaf", "rank", "path_score", "n_turns",
            F.array_join(F.col("steps.piece"), "").alias("formatted"),
            F.transform(
                F.filter("steps", lambda s: s["trained"]),
                lambda s: F.struct(s["begin"].alias("begin"), (s["begin"] + s["inside"]).alias("end")),
            ).alias("loss_spans"),
            F.transform(F.filter("steps", lambda s: s["trained"]), lambda s: s["place"] + 1).alias("loss_turns"),
        )
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted text: an array of role and text."""
    parts = F.slice(F.split(formatted, OPEN), 2, F.greatest(F.size(F.split(formatted, OPEN)) - 1, F.lit(0)))

    def turn(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        skip = F.length(role) + 1
        text = F.substr(part, skip + 1, F.length(part) - skip - len(CLOSE))
        return F.struct(unescaped_role(role).alias("role"), unescaped(text).alias("text"))

    return F.transform(parts, turn)
