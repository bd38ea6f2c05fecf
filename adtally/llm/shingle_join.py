"""Size-aware similarity join of documents on word shingles: light sets by subsets, heavy sets by inverted lists.

A document's set are its distinct runs of five words. Two sets link if their Jaccard similarity is at least
80 percent. Of a set of n shingles, a linked partner lacks at most d(n) = n - ceil(0.8 n). Under any order of
all shingles, linked sets therefore share at least k shingles among the first d + k of each.

* Light sets, of at most `boundary` shingles, give all pairs among their first d + 2 shingles as keys: few, as
  d is small, and a key of two shingles brings together far fewer strangers than one shingle.
* Heavy sets, and the largest light ones that can link to them, give their first d + k shingles as keys of
  inverted lists, k a fifth of the set. A set of which fewer than its share of keys are shared has no partner
  among them; dropping such sets leaves others with fewer shared keys, so this is done a few times over.
* The boundary is the size for which the estimated work is least: keys written, and list entries read at the
  mean length of a list.

Shingles are ordered by how many sets have them, rare ones first, and by hash. For that all shingles are
counted; those of at least HOT sets keep their count, the others are alike. The table of hot shingles holds at
most MAX_HOT entries (the most frequent; the order is a matter of speed, any order gives all links).

Sets that share a key are candidates. Not all pairs of a list are formed: each member is first compared with
one hub of the list, the set found in most lists, and with further hubs as long as that connects much. Members
already connected need no comparison. The sets of lists that still hold several components are then compared
across them by position: if a key is the first that two sets share, both can share at most what follows it in
either, and a linked pair passes this bound at its first shared key. So no link between components is missed,
while texts that only share what is frequent have too many rare shingles before it. Of a list, the
sets outside its largest component meet the others, by bands of size. Every comparison is exact, on the sorted
shingle hashes of both sets.

Defined results: equal sets are one node. Null, empty and blank texts have no shingles and link with nothing;
texts of fewer than five words have one shingle. A null id never is a component's id unless all its members'
ids are null. Repeated rows repeat, an empty table gives an empty table, and only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.llm.common import chunks_by_size, give_back, map_texts, mix64
from adtally.llm.rolling import Words
from adtally.sources.staging import release, stage

SHINGLE = 5
NEED, OF = 80, 100
HOT = 16
MAX_HOT = 1_000_000
LONG_LIST = 50_000  # lists above this many sets are not gathered by one task
BUCKET_TOKENS = 2_000_000  # shingles counted by one group
MAX_BROADCAST_IDS = 2_000_000
MAX_LIGHT = 512  # sizes the boundary is searched in
PEELS = 4
STAR_ROUNDS = 6
BAND = 1.001 * math.log(OF / NEED)  # width of a band of sizes, a little above what linked sets differ by
POSITIONED_AT_ONCE = 512  # sets whose keys make one output batch
STILL_FALLING = 0.7  # further hubs are tried while what is apart falls below this share of what it was
_FACTORS = mix64(np.arange(1, SHINGLE + 1, dtype=np.uint64)) | np.uint64(1)


def slack(size: int) -> int:
    """How many shingles a linked partner may lack."""
    return size - -(-NEED * size // OF)


def depth(size: int) -> int:
    """How many shared keys a heavy set offers beyond its slack."""
    return max(1, size // 5)


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = Words(texts, lower_ascii=True)
    hashes = words.hashes
    windows = np.zeros(max(len(hashes) - SHINGLE + 1, 0), dtype=np.uint64)
    for k in range(SHINGLE):
        windows += hashes[k : k + len(windows)] * _FACTORS[k]
    windows = mix64(windows)
    out = []
    for a, b in zip(words.first[:-1], words.first[1:]):
        if b - a >= SHINGLE:
            out.append(np.unique(windows[a : b - SHINGLE + 1]))
        else:
            short = (hashes[a:b] * _FACTORS[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)
            out.append(mix64(short) if b > a else hashes[:0])
    return out


def set_name(tokens: np.ndarray) -> int:
    """One number per set, equal for equal sets."""
    total = mix64(tokens ^ np.uint64(0x6A09E667F3BCC909)).sum(dtype=np.uint64, keepdims=True)
    return int(mix64(total + np.uint64(len(tokens))).astype(np.int64)[0])


def _bucket(tokens: np.ndarray, buckets: int) -> np.ndarray:
    return ((tokens >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _short(tokens: np.ndarray) -> np.ndarray:
    return (tokens & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _known(tokens: np.ndarray, buckets: int) -> np.ndarray:
    """What counting tells apart: the bucket and 32 bits. As buckets grow with the corpus, so do the bits."""
    return (_bucket(tokens, buckets) << np.uint64(32)) | (tokens & np.uint64(0xFFFFFFFF))


def _by_bucket(buckets: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    order = np.argsort(buckets, kind="stable")
    buckets, columns = buckets[order], [c[order] for c in columns]
    edges = np.flatnonzero(np.diff(buckets)) + 1
    for a, b in zip([0, *edges], [*edges, len(buckets)]):
        if b > a:
            yield (int(buckets[a]), *(c[a:b].tobytes() for c in columns))


def _distinct_sets(texts: list[str]) -> list[np.ndarray]:
    """The sets of a batch, each once, without empty ones."""
    return list({set_name(s): s for s in shingle_sets(texts) if len(s)}.values())


def count_tokens(texts: DataFrame, buckets: int) -> DataFrame:
    """Rows (token, sets) of hot shingles, and of kind 1 the numbers of distinct shingles and of entries.

    Tasks send each bucket one row per batch: the shingles met once, and those met more often with counts.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [t or "" for t in batch.column(0).to_pylist()]
            for start, end in chunks_by_size(rows):
                sets = _distinct_sets(rows[start:end])
                if not sets:
                    continue
                tokens, counts = np.unique(np.concatenate(sets), return_counts=True)
                single = counts == 1
                parts = {b: [x, b"", b""] for b, x in _by_bucket(_bucket(tokens[single], buckets), _short(tokens[single]))}
                more = tokens[~single]
                for b, x, n in _by_bucket(_bucket(more, buckets), _short(more), counts[~single].astype(np.uint32)):
                    parts.setdefault(b, [b"", b"", b""])[1:] = [x, n]
                columns = [pa.array(list(parts), pa.int32()), *(pa.array([p[i] for p in parts.values()], pa.binary()) for i in range(3))]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "ones", "many", "counts"])
        give_back()

    def add(table: pa.Table) -> pa.Table:
        read = lambda name: np.frombuffer(b"".join(table.column(name).to_pylist()), np.uint32)
        ones = read("ones")
        tokens, place = np.unique(np.concatenate([ones, read("many")]), return_inverse=True)
        weights = np.concatenate([np.ones(len(ones)), read("counts")])
        counts = np.bincount(place, weights=weights, minlength=len(tokens)).astype(np.int64)
        hot = counts >= HOT
        bucket = np.uint64(table.column("bucket")[0].as_py())
        found = ((bucket << np.uint64(32)) | tokens[hot].astype(np.uint64)).astype(np.int64)
        return pa.table({
            "kind": pa.array(np.append(np.zeros(len(found)), 1).astype(np.int32)),
            "token": pa.array(np.append(found, len(tokens))), "sets": pa.array(np.append(counts[hot], counts.sum())),
        })

    sent = texts.mapInArrow(send, "bucket int, ones binary, many binary, counts binary")
    return sent.groupBy("bucket").applyInArrow(add, "kind int, token long, sets long")


def cheapest_boundary(sizes: dict[int, int], list_length: float) -> int:
    """The largest size of light sets for which keys written and entries read are fewest."""
    light = {n: f * (slack(n) + 2) * (slack(n) + 1) / 2 for n, f in sizes.items() if n > 1}
    heavy = {n: f * (slack(n) + depth(n)) * (1 + list_length) for n, f in sizes.items() if n > 1}
    best, least = 0, float("inf")
    for x in range(0, MAX_LIGHT + 1):
        work = sum(c for n, c in light.items() if n <= x) + sum(c for n, c in heavy.items() if OF * n > NEED * x)
        if work < least:
            best, least = x, work
    return best


@dataclass
class Order:
    """The order of shingles, and the boundary between light and heavy sets."""

    tokens: np.ndarray  # hot shingles, sorted
    sets: np.ndarray
    buckets: int
    boundary: int
    long_list: int = LONG_LIST

    def _first(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first shingles of a set, rare ones first, and the number of sets each is known to be in."""
        size = len(tokens)
        known = _known(tokens, self.buckets)
        place = np.minimum(np.searchsorted(self.tokens, known), max(len(self.tokens) - 1, 0))
        often = np.where(self.tokens[place] == known, self.sets[place], 0) if len(self.tokens) else np.zeros(size, np.int64)
        order = np.argsort(often, kind="stable")[: slack(size) + max(2, depth(size))]
        return tokens[order], often[order]

    def positions(self, tokens: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, bool]]:
        """The keys that can be the first a set shares with a linked one, for each its place in the set, and if single."""
        size, lack = len(tokens), slack(len(tokens))
        if size < 2:
            return []
        first, _ = self._first(tokens)
        out = []
        if size <= self.boundary:
            a, b = np.triu_indices(min(len(first), lack + 2), 1)
            out.append((mix64(first[a] * np.uint64(3) + first[b]), b, False))
        if OF * size > NEED * self.boundary:
            out.append((first[: lack + 1], np.arange(len(first[: lack + 1])), True))
        return out

    def keys(self, tokens: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, bool]]:
        """The keys of a set, for each the number of sets its rarest shingle is known to be in, and if single."""
        size, lack = len(tokens), slack(len(tokens))
        if size < 2:  # links only with equal sets
            return []
        first, often = self._first(tokens)
        out = []
        if size <= self.boundary:
            a, b = np.triu_indices(min(len(first), lack + 2), 1)
            out.append((mix64(first[a] * np.uint64(3) + first[b]), often[a], False))
        if OF * size > NEED * self.boundary:
            out.append((first[: lack + depth(size)], often[: lack + depth(size)], True))
        return out


def shared_keys(texts: DataFrame, order: Order) -> DataFrame:
    """Rows (key, node, single) of keys that at least two sets have; `single` if the key is one shingle.

    Lists are gathered by bucket. A list known to be long is not: its entries pass through any bucket.
    """
    shared = texts.sparkSession.sparkContext.broadcast(order)  # at most MAX_HOT pairs of numbers
    buckets = order.buckets

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [t or "" for t in batch.column(0).to_pylist()]
            for start, end in chunks_by_size(rows):
                found = [(set_name(s), *k) for s in _distinct_sets(rows[start:end]) for k in shared.value.keys(s)]
                made = []
                for single in (False, True):
                    own = [f for f in found if f[3] == single]
                    if not own:
                        continue
                    keys = np.concatenate([k for _, k, _, _ in own])
                    nodes = np.repeat(np.array([n for n, _, _, _ in own], dtype=np.int64), [len(k) for _, k, _, _ in own])
                    long = np.concatenate([o for _, _, o, _ in own]) >= shared.value.long_list
                    rest = keys[~long]
                    for b, k, n in _by_bucket(_bucket(rest, buckets), _short(rest), nodes[~long]):
                        made.append((b, single, False, k, n))
                    if long.any():
                        any_bucket = int(mix64(keys[:1])[0] % np.uint64(buckets))
                        made.append((any_bucket, single, True, keys[long].tobytes(), nodes[long].tobytes()))
                kinds = (pa.int32(), pa.bool_(), pa.bool_(), pa.binary(), pa.binary())
                columns = [pa.array([m[i] for m in made], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "single", "is_long", "keys", "nodes"])
        give_back()

    def gather(table: pa.Table) -> pa.Table:
        long = table.column("is_long").to_numpy()
        bucket = np.uint64(table.column("bucket")[0].as_py())
        read = lambda name, own, kind: np.frombuffer(b"".join(x for x, o in zip(table.column(name).to_pylist(), own) if o), kind)
        keys, nodes = read("keys", ~long, np.uint32), read("nodes", ~long, np.int64)
        order = np.lexsort((nodes, keys))
        keys, nodes = keys[order], nodes[order]
        new = np.ones(len(keys), dtype=bool)
        new[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
        keys, nodes = keys[new], nodes[new]
        same = keys[1:] == keys[:-1]
        common = np.append(same, False) | np.append(False, same) if len(keys) else np.zeros(0, bool)
        full = ((bucket << np.uint64(32)) | keys[common].astype(np.uint64)).astype(np.int64)
        all_keys = np.append(full, read("keys", long, np.int64))
        single = bool(table.column("single")[0].as_py())
        return pa.table({
            "key": pa.array(all_keys), "node": pa.array(np.append(nodes[common], read("nodes", long, np.int64))),
            "single": pa.array(np.full(len(all_keys), single)),
        })

    sent = texts.mapInArrow(send, "bucket int, single boolean, is_long boolean, keys binary, nodes binary")
    return sent.groupBy("bucket", "single").applyInArrow(gather, "key long, node long, single boolean")


def few(nodes: DataFrame, number: int) -> DataFrame:
    """Sent to every task only where few; else both sides of the join are partitioned by node."""
    return F.broadcast(nodes) if number <= MAX_BROADCAST_IDS else nodes


def peeled(lists: DataFrame, nodes: DataFrame) -> DataFrame:
    """The lists without sets that share too few of their keys to have a partner.

    Linked sets share as many single keys as the smaller one offers, and that has at least 80 percent of the
    size of the larger. Sets with a shared pair of shingles stay. Ends when few sets go.
    """
    least = F.greatest(F.lit(1), F.floor(F.ceil(F.col("size") * NEED / OF) / 5))
    for step in range(PEELS):
        had = lists
        if step:
            shared = lists.groupBy("key", "single").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1").drop("sets")
            had = lists.join(shared, ["key", "single"], "left_semi")
        had = had.groupBy("node").agg(F.count_if("single").alias("singles"), F.count_if(~F.col("single")).alias("pairs"))
        stays = (F.col("pairs") > 0) | (F.col("singles") >= least)
        kept = stage(had.join(nodes.select("node", "size"), "node").select("node", stays.alias("stays")), "kept")
        number, gone = kept.agg(F.count_if("stays"), F.count_if(~F.col("stays"))).first()
        if gone * 10 < number + gone:
            break
        less = stage(lists.join(few(kept.filter("stays").select("node"), number), "node", "left_semi"), "lists")
        release(lists, kept)
        lists = less
    return lists


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (node, hub) whose sets, rows (name, tokens), are similar enough."""
    members = pairs.join(sets.select(F.col("name").alias("node"), F.col("tokens").alias("a")), "node")
    both = members.join(sets.select(F.col("name").alias("hub"), F.col("tokens").alias("b")), "hub").select("node", "hub", "a", "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for a, b in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                place = np.minimum(np.searchsorted(y, x), len(y) - 1)
                inside = int((y[place] == x).sum())
                good.append(OF * inside >= NEED * (len(x) + len(y) - inside))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))
        give_back()

    return both.mapInArrow(compare, "node long, hub long")


def connected(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """Rows (node, part): the smallest node reachable by links. Labels are written each round."""
    both = links.select(F.col("node").alias("a"), F.col("hub").alias("b"))
    both = stage(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = stage(nodes.select("node", F.col("node").alias("part")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("part").alias("near"))
        lower = labels.join(near, "node", "left").select("node", "part", F.least("part", "near").alias("to"))
        lower = stage(lower, "lower")
        if lower.filter("to < part").isEmpty():
            release(both, lower)
            return labels
        # Each label then jumps to the label of the node it names.
        jump = lower.select(F.col("node").alias("to"), F.col("to").alias("further"))
        jumped = stage(lower.join(jump, "to").select("node", F.col("further").alias("part")), "labels")
        release(labels, lower)
        labels = jumped


def join_similar(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_shingles, node, component_id), one per row of `docs`."""
    texts = docs.select(text_col)

    def describe(batch: list[str]) -> dict:
        sets = shingle_sets(batch)
        return {"n_shingles": [len(s) for s in sets], "node": [set_name(s) if len(s) else None for s in sets]}

    outputs = {"n_shingles": "long", "node": "long"}
    named = map_texts(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), keep=("doc_id",), text_col="text", outputs=outputs, compute=describe)
    named = stage(named, "named")
    nodes = stage(
        named.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("least_id"), F.max("n_shingles").alias("size")), "nodes"
    )
    entries = nodes.agg(F.sum("size")).first()[0]
    if not entries:
        return named.withColumn("component_id", F.col("doc_id"))
    buckets = max(1, -(-entries // BUCKET_TOKENS))
    counted = stage(count_tokens(texts, buckets), "counts")
    order = token_order(nodes, counted, buckets)
    lists = peeled(stage(shared_keys(texts, order), "lists"), nodes)
    parts = resolve(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), nodes, lists, order)
    least = nodes.join(parts, "node").groupBy("part").agg(F.min("least_id").alias("component_id"))
    of_node = parts.join(least, "part").select("node", "component_id")
    own = nodes.join(of_node, "node", "left").select("node", F.coalesce("component_id", "least_id").alias("component_id"))
    joined = named.join(own, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "n_shingles", "node", component.alias("component_id"))


def token_order(nodes: DataFrame, counted: DataFrame, buckets: int) -> Order:
    """The hot shingles and the boundary, from the counts."""
    hot = counted.filter("kind = 0")
    distinct, entries = counted.filter("kind = 1").agg(F.sum("token"), F.sum("sets")).first()
    least = HOT
    while hot.filter(F.col("sets") >= least).count() > MAX_HOT:
        least *= 2
    table = hot.filter(F.col("sets") >= least).select("token", "sets").toArrow()
    tokens = table.column("token").to_numpy().astype(np.uint64)
    by_token = np.argsort(tokens)
    sizes = nodes.filter(F.col("size") <= 2 * MAX_LIGHT).groupBy("size").count().collect()
    boundary = cheapest_boundary({r["size"]: r["count"] for r in sizes}, entries / max(distinct, 1))
    return Order(tokens[by_token], table.column("sets").to_numpy()[by_token], buckets, boundary)


def resolve(docs: DataFrame, nodes: DataFrame, lists: DataFrame, order: Order) -> DataFrame:
    """Rows (node, part) for all nodes of the lists.

    Star rounds look at every eighth key only: they are there to connect what is alike cheaply. What is still apart
    in any list is then compared by position.
    """
    met = stage(lists.groupBy("node").agg(F.count(F.lit(1)).alias("degree")).join(nodes, "node"), "met")
    number = met.count()
    sets = stage(sets_of(docs, met, number), "sets")
    parts = stage(met.select("node", F.col("node").alias("part")), "parts")
    links = tested = None

    def compared(pairs: DataFrame) -> None:
        nonlocal links, tested, parts
        if tested is not None:
            pairs = pairs.join(tested, ["node", "hub"], "left_anti")
        pairs = stage(pairs, "pairs")
        found = stage(linked(pairs, sets), "found")
        links = found if links is None else links.unionByName(found)
        tested = pairs if tested is None else tested.unionByName(pairs)
        if not found.isEmpty():
            before, parts = parts, connected(met.select("node"), links)
            release(before)

    crossing = None
    for step in range(STAR_ROUNDS + 1):
        info = stage(met.select("node", "degree", "size").join(parts, "node"), "info")
        placed = lists.join(few(info, number), "node")
        # In the first round everything is apart.
        if step:
            ends = placed.groupBy("key", "single").agg(F.min("part").alias("low"), F.max("part").alias("high"))
            apart = stage(ends.filter("low < high").drop("high"), "apart")
            shares = placed.join(apart, ["key", "single"]).groupBy("key", "single").agg(
                F.count(F.lit(1)).alias("sets"), F.count_if(F.col("part") != F.col("low")).alias("others")
            )
            before, crossing = crossing, shares.agg(F.sum(F.col("sets") * F.col("others"))).first()[0]
            open_lists = placed.join(apart, ["key", "single"])
            if not crossing or step == STAR_ROUNDS or (before is not None and crossing > STILL_FALLING * before):
                break
        else:
            open_lists = placed.withColumn("low", F.lit(None).cast("long"))
        open_lists = open_lists.filter(F.pmod(F.xxhash64("key"), F.lit(8)) == 0)
        # First the set found in most lists, which an original is; then any of those not in the first part.
        rank = F.col("degree") if not step else F.xxhash64("node", F.lit(step))
        pool = open_lists if not step else open_lists.filter("part != low")
        best = F.max(F.struct(rank.alias("rank"), "node", "part", "size")).alias("h")
        hubs = pool.groupBy("key", "single").agg(best).select(
            "key", "single", F.col("h.node").alias("hub"), F.col("h.part").alias("hub_part"), F.col("h.size").alias("hub_size")
        )
        met_pairs = open_lists.join(hubs, ["key", "single"]).filter((F.col("part") != F.col("hub_part")) & _fitting())
        compared(met_pairs.select(F.least("node", "hub").alias("node"), F.greatest("node", "hub").alias("hub")).distinct())
        release(info, *([apart] if step else []))
    if crossing:
        still = stage(open_lists.select("node", "part").distinct(), "still")
        compared(_pairs_apart(sets, still, order))
        release(still)
    release(sets, lists, met)
    return parts


def _pairs_apart(sets: DataFrame, still: DataFrame, order: Order) -> DataFrame:
    """Pairs (node, hub) of sets of `still` (node, part) that are in different parts, share a key and pass its bound."""
    shared = sets.sparkSession.sparkContext.broadcast(order)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, parts = (batch.column(i).to_numpy() for i in range(2))
            for start in range(0, len(nodes), POSITIONED_AT_ONCE):
                made = []
                for i in range(start, min(start + POSITIONED_AT_ONCE, len(nodes))):
                    tokens = np.frombuffer(batch.column(2)[i].as_buffer(), np.uint64)
                    made += [(nodes[i], parts[i], len(tokens), *k) for k in shared.value.positions(tokens)]
                lengths = [len(m[3]) for m in made]
                column = lambda i: np.repeat(np.array([m[i] for m in made], dtype=np.int64), lengths)
                keys, at = (np.concatenate([m[i] for m in made] or [np.zeros(0, np.int64)]) for i in (3, 4))
                single = np.repeat(np.array([m[5] for m in made], dtype=bool), lengths)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.astype(np.int64)), pa.array(single), pa.array(column(0)), pa.array(column(1)),
                     pa.array(column(2).astype(np.int32)), pa.array(at.astype(np.int32))],
                    ["key", "single", "node", "part", "size", "at"],
                )

    whole = still.join(sets, F.col("node") == F.col("name")).select("node", "part", "tokens")
    entries = stage(whole.mapInArrow(keyed, "key long, single boolean, node long, part long, size int, at int"), "entries")
    counts = entries.groupBy("key", "single", "part").agg(F.count(F.lit(1)).alias("sets"))
    tops = counts.groupBy("key", "single").agg(F.max(F.struct("sets", "part")).alias("top"), F.count(F.lit(1)).alias("parts"))
    tops = tops.filter("parts > 1").select("key", "single", F.col("top.part").alias("top"))
    entries = entries.join(tops, ["key", "single"]).withColumn("band", F.floor(F.log("size") / F.lit(BAND)))
    # Sizes of linked sets lie in the same or in neighbouring bands.
    others = entries.filter("part != top").withColumn("band", F.explode(F.array(*[F.col("band") + d for d in (-1, 0, 1)])))
    all_sets = entries.select(
        "key", "single", "band", F.col("node").alias("hub"), F.col("part").alias("hub_part"), F.col("size").alias("hub_size"), F.col("at").alias("hub_at")
    )
    first = F.when(F.col("single"), 1).otherwise(2)
    most = first + F.least(F.col("size") - F.col("at"), F.col("hub_size") - F.col("hub_at")) - 1
    # Of two sets outside the largest part, one order of the two suffices.
    once = (F.col("hub_part") == F.col("top")) | (F.col("node") < F.col("hub"))
    met = others.join(all_sets, ["key", "single", "band"]).filter(
        (F.col("part") != F.col("hub_part")) & once & _fitting() & (most * (OF + NEED) >= NEED * (F.col("size") + F.col("hub_size")))
    )
    return met.select(F.least("node", "hub").alias("node"), F.greatest("node", "hub").alias("hub")).distinct()


def _fitting():
    """Sets of too different size cannot link."""
    return F.least("size", "hub_size") * OF >= F.greatest("size", "hub_size") * NEED


def sets_of(docs: DataFrame, met: DataFrame, number: int) -> DataFrame:
    """Rows (name, tokens) of the nodes of `met`, read from the document of the least id that has the set."""
    wanted = few(met.select("least_id").distinct(), number)
    chosen = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("least_id")), "left_semi")

    def read(batch: list[str]) -> dict:
        sets = shingle_sets(batch)
        return {"name": [set_name(s) if len(s) else None for s in sets], "tokens": [s.tobytes() for s in sets]}

    made = map_texts(chosen, keep=(), text_col="text", outputs={"name": "long", "tokens": "binary"}, compute=read)
    # Rows of one id may have several texts, and several rows the same.
    return made.join(few(met.select(F.col("node").alias("name")), number), "name", "left_semi").dropDuplicates(["name"])
