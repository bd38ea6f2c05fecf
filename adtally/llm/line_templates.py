"""Line deduplication by a log-template tree of fixed depth.

A line's words containing digits become `<*>`. Lines of one word count that begin with the same words share a
leaf. In leaves whose lines recur, templates are made in two passes over the places after the leading words.
First the most common word of each place makes the leaf's main template; places without a common word become
`<*>` too, and the lines that agree with it in enough places, one of them a word and not `<*>`, belong to it.
The other lines are generalised each by itself: words that enough texts of these lines have at that place
stay, all others become `<*>`, and lines that come out equal, with enough words left, share a template.
A template found in enough distinct texts is boilerplate: its lines are dropped from every document but the
first (the smallest id, then the smallest text hash) that has it. Lines without a template stand for themselves.

How many texts are enough falls with the length of the line, as a long line does not recur by chance: 10 for
lines of under 10 words, 5 from 10 words, 3 from 20 and 2 from 50 (`NEEDED`). A given `min_docs` holds for all.

Copies of one text count once, exact or edited, whatever their number: they are for the near-duplicate stage.
A text of a group is a copy if it shares half of what both hold besides the line, by runs of `RUN` words, with an
earlier text of the group. As only earlier texts matter, a group is settled once its first texts hold enough that are no copies. Texts meet by their `KEYS` smallest hashes of runs outside the line; each is compared with the
first text of every key, by the `SKETCH` smallest hashes of either. The compared share is an estimate with a standard error of at
most 0.5 / sqrt(SKETCH), some 0.045. With a given `min_docs` texts count as they are.

Defined results: null texts stay null; blank lines are never dropped; repeated rows are treated alike; a
document may become empty but its row stays; an empty table gives an empty table. Further columns are kept,
inside one struct, so their names cannot clash; a column named `n_dropped` is replaced.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adtally.llm.common import SPACES
from adtally.sources.staging import release, stage

MIN_DOCS = 10
NEEDED = ((50, 2), (20, 3), (10, 5))  # from so many words on, so many texts are enough; MIN_DOCS for shorter lines
RUN = 5
SKETCH = 128
KEYS = 16
FIRST = 2  # times the texts needed: so many first texts of a group are compared before all of them
SAME = 0.5  # share of common runs from which two texts are copies of each other
LEADING = 3
COMMON = 0.5  # share of a leaf's lines that makes a place's word part of the template, one half at least
AGREE = 0.6  # share of places after the leading ones in which a line must agree with it
ANY = "<*>"
OTHERS = "\t\x0b\x0c\r"  # white space besides spaces and line breaks

MAX_BROADCAST_SPOTS = 400_000  # of 48 bytes each, or keys of fewer; beyond that both sides of a join are partitioned


def _sent_whole(rows: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """`rows`, to be broadcast if they, or what they were grouped from, are few."""
    counted = rows if counted is None else counted
    return F.broadcast(rows) if counted.count() <= MAX_BROADCAST_SPOTS else rows


def _masked(line: Column) -> Column:
    """A line whose words with digits are masked. Anchored at the words' first letters, a word without digits is read once."""
    word = f"(?<![^{SPACES}])[^{SPACES}0-9]*+[0-9][^{SPACES}]*+"
    return F.when(line.rlike("[0-9]"), F.regexp_replace(line, word, ANY)).otherwise(line)


def _holds_any(text: Column, parts: str) -> Column:
    """Whether a text holds one of some characters; a search for each is faster than a pattern."""
    return reduce(or_, [F.contains(text, F.lit(part)) for part in parts])


def _split(text: Column) -> Column:
    """The words of a text. Where only spaces and line breaks part them, they need no pattern."""
    plain = F.array_remove(F.split(F.replace(text, F.lit("\n"), F.lit(" ")), " "), "")
    spaced = F.array_remove(F.split(text, f"[{SPACES}]+"), "")
    return F.when(_holds_any(text, OTHERS), spaced).otherwise(plain)


def _lines(docs: DataFrame) -> DataFrame:
    """One row per line that is not blank: id, version (hash of the text), place, and hashes and number of its words."""
    # White space but line breaks becomes spaces; words are then parted by one space each, and a line's text stands for them.
    text = F.col("line_text")
    text = F.when(_holds_any(text, OTHERS), F.translate(text, OTHERS, " " * len(OTHERS))).otherwise(text)
    each = docs.select("line_doc", "line_version", F.posexplode(F.split(text, "\n")).alias("place", "line"))
    each = each.filter(F.trim("line") != "").withColumn("line", F.trim(_masked(F.col("line"))))
    single = F.when(F.contains("line", F.lit("  ")), F.regexp_replace("line", " +", " ")).otherwise(F.col("line"))
    each = each.withColumn("line", single)
    each = each.withColumn("size", 1 + F.octet_length("line") - F.octet_length(F.replace("line", F.lit(" "), F.lit(""))))
    leaf = F.xxhash64("size", F.substring_index("line", " ", LEADING))
    return each.select("line_doc", "line_version", "place", leaf.alias("leaf"), F.xxhash64("line").alias("body"), "size")


def _needed(size: Column, min_docs: int | None) -> Column:
    """The number of distinct texts a line of `size` words must be found in."""
    if min_docs is not None:
        return F.lit(min_docs)
    needed = F.lit(MIN_DOCS)
    for words, texts in reversed(NEEDED):
        needed = F.when(size >= words, texts).otherwise(needed)
    return needed


def _crowded(lines: DataFrame, min_docs: int | None) -> DataFrame:
    """The lines of leaves with as many lines as a template needs texts: no others can be dropped."""
    leaves = lines.groupBy("leaf").agg(F.count(F.lit(1)).alias("rows"), F.min("size").alias("size"))
    leaves = stage(leaves.filter(F.col("rows") >= _needed(F.col("size"), min_docs)).select("leaf"), "crowded")
    crowded = stage(lines.join(_sent_whole(leaves), "leaf", "left_semi").select(*lines.columns), "lines")
    release(lines, leaves)
    return crowded


def _hashed_runs(hashes: Column) -> Column:
    """The hash of the run at every place of some words' hashes; fewer words are one run."""
    run = lambda x, i: F.xxhash64(x, *[F.get(hashes, i + k) for k in range(1, RUN)])
    return F.slice(F.transform(hashes, run), 1, F.greatest(F.size(hashes) - (RUN - 1), F.lit(1)))


def _runs(words: Column) -> Column:
    """The distinct hashes of the runs among some words; fewer words are one run."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    # Bound as a lambda's variable, the words are hashed once.
    return F.array_distinct(F.get(F.transform(F.array(hashes), _hashed_runs), F.lit(0)))


def _read_spots(docs: DataFrame, spots: DataFrame, payload: list[str]) -> DataFrame:
    """The documents that hold some spots (line_version, spot_doc, and the columns of `payload`), with their spots.

    Repeated rows are all returned.
    """
    wanted = spots.groupBy("line_version", "spot_doc").agg(F.collect_list(F.struct(*payload)).alias("spots"))
    wanted = wanted.withColumnsRenamed({"line_version": "spot_version"})
    wanted = _sent_whole(wanted, spots)
    same = (docs["line_version"] == wanted["spot_version"]) & docs["line_doc"].eqNullSafe(wanted["spot_doc"])
    return docs.join(wanted, same)


def _unlike_texts(docs: DataFrame, texts: DataFrame, seen: DataFrame) -> DataFrame:
    """The number of texts of each group (leaf, template, size) that are no copies of an earlier one: `unlike`.

    `texts` has a row (leaf, template, size, body, line_version, line_doc, place) per text, `seen` the words of bodies that
    differ inside a template.
    """
    spots = texts.withColumnRenamed("line_doc", "spot_doc")
    read = _read_spots(docs, spots, ["leaf", "template", "size", "body", "place"])
    read = read.select("line_version", "spot_doc", "line_text", "spots", _runs(_split(F.col("line_text"))).alias("runs"))
    least = F.slice(F.sort_array("runs"), 1, SKETCH).alias("s")
    read = read.select("line_version", "spot_doc", "line_text", "spots", F.size("runs").alias("n"), least)
    # The smallest runs outside the line: of the sketch enough is left where the line is not most of the text.
    keys = lambda line: F.slice(F.array_except("s", _runs(_split(line))), 1, KEYS)
    keyed_spot = lambda x, rows: F.struct(
        x["leaf"], x["template"], x["size"], x["body"], keys(F.get(rows, x["place"])).alias("keys")
    )
    # Bound as a lambda's variable, the text is split into lines once.
    rows = F.array(F.split("line_text", "\n"))
    keyed = F.get(F.transform(rows, lambda r: F.transform("spots", lambda x: keyed_spot(x, r))), F.lit(0))
    read = read.select("line_version", "spot_doc", "n", "s", keyed.alias("spots"))
    # Repeated rows were read as often; their sketches are shorter than their texts.
    read = stage(read.dropDuplicates(["line_version", "spot_doc"]), "sketches")
    # Hashes are never null; where Spark knows it, it sorts them as plain numbers.
    sketches = read.select("line_version", "n", F.array_compact("s").alias("s")).dropDuplicates(["line_version"])
    met = read.select("line_version", "spot_doc", F.explode("spots").alias("x")).select("line_version", "spot_doc", "x.*")
    keyed = met.select("leaf", "template", F.explode("keys").alias("key"), "line_version", "spot_doc", "body", "size")
    # A bucket of one key holds the texts of a group that share a run; each meets the first of them.
    order = F.struct("spot_doc", "line_version", "body")
    first = keyed.groupBy("leaf", "template", "key").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("texts"))
    first = first.filter("texts > 1").select(
        "leaf", "template", "key", F.col("first.line_version").alias("a"), F.col("first.body").alias("a_body")
    )
    pairs = keyed.join(first, ["leaf", "template", "key"]).filter("line_version != a").select(
        "leaf", "template", "size", "a", "a_body", F.col("line_version").alias("b"), F.col("body").alias("b_body")
    )
    pairs = stage(pairs.distinct(), "met")
    # The runs that the two lines share; all, if they are equal.
    bodies = pairs.filter("a_body != b_body").select("leaf", "a_body", "b_body").distinct()
    used = bodies.select("leaf", F.explode(F.array("a_body", "b_body")).alias("body")).distinct()
    used = seen.select("leaf", "body", "words").join(_sent_whole(used), ["leaf", "body"], "left_semi")
    for side in ("a", "b"):
        words = used.select("leaf", F.col("body").alias(f"{side}_body"), _runs(F.col("words")).alias(f"{side}_runs"))
        bodies = bodies.join(words, ["leaf", f"{side}_body"])
    shared = F.size(F.array_intersect("a_runs", "b_runs")).alias("shared")
    bodies = bodies.select("leaf", "a_body", "b_body", shared)
    left = sketches.select(F.col("line_version").alias("a"), F.col("n").alias("a_n"), F.col("s").alias("a_s"))
    right = sketches.select(F.col("line_version").alias("b"), F.col("n").alias("b_n"), F.col("s").alias("b_s"))
    compared = pairs.select("a", "b").distinct().join(left, "a").join(right, "b")
    least = F.slice(F.sort_array(F.array_union("a_s", "b_s")), 1, SKETCH)
    both = F.array_intersect(least, F.array_intersect("a_s", "b_s"))
    # A share that cannot be null is not evaluated again for a check of the join.
    share = F.coalesce(F.size(both) / F.size(least), F.lit(0.0))
    compared = compared.select("a", "b", "a_n", "b_n", share.alias("share"))
    # The runs of both and of either, without those inside the lines.
    common = F.col("share") / (1 + F.col("share")) * (F.col("a_n") + F.col("b_n"))
    inside = F.greatest(F.col("size") - RUN + 1, F.lit(1))
    shared = F.coalesce("shared", inside)
    alike = common - shared >= SAME * (F.col("a_n") + F.col("b_n") - common - (2 * inside - shared))
    copies = pairs.join(bodies, ["leaf", "a_body", "b_body"], "left").join(compared, ["a", "b"]).filter(alike)
    copies = stage(copies.select("leaf", "template", F.col("b").alias("line_version")).distinct(), "copies")
    release(pairs, read)
    return texts.join(copies, ["leaf", "template", "line_version"], "left_anti").groupBy("leaf", "template").agg(
        F.count(F.lit(1)).alias("unlike"), F.min("size").alias("size")
    )


def _unlike_groups(docs: DataFrame, texts: DataFrame, counted: DataFrame, seen: DataFrame) -> DataFrame:
    """The groups (leaf, template) with enough texts that are no copies of an earlier one."""
    needed, group = _needed(F.col("size"), None), ["leaf", "template"]
    rank = F.row_number().over(Window.partitionBy(*group).orderBy("line_doc", "line_version"))
    # The number alone lets each task leave out the other texts before they are sent.
    early = texts.withColumn("rank", rank).filter((F.col("rank") <= FIRST * MIN_DOCS) & (F.col("rank") <= FIRST * needed))
    early = stage(early.drop("rank"), "early")
    settled = stage(_unlike_texts(docs, early, seen).filter(F.col("unlike") >= needed).select(*group), "settled")
    # What a text is follows from earlier ones: the settled groups would be found again, the others may hold more texts.
    more = counted.filter(F.col("texts") > FIRST * needed).select(*group).join(settled, group, "left_anti")
    late = stage(texts.join(more, group, "left_semi"), "late")
    if late.isEmpty():
        return settled
    return settled.unionByName(_unlike_texts(docs, late, seen).filter(F.col("unlike") >= needed).select(*group))


def _one_of_each(docs: DataFrame, bodies: DataFrame) -> DataFrame:
    """Rows (leaf, body, texts, size, leaf_texts, words) of some bodies, the words read where a line is first found."""
    kept = ["leaf", "body", "texts", "size", "leaf_texts"]
    met = _read_spots(docs, bodies, [*kept, "place"]).select(F.split("line_text", "\n").alias("rows"), "spots")
    met = met.select("rows", F.explode("spots").alias("x"))
    met = met.select(*[f"x.{c}" for c in kept], _masked(F.get("rows", F.col("x.place"))).alias("line"))
    # Repeated rows were read as often.
    return met.dropDuplicates(["leaf", "body"]).select(*kept, _split(F.col("line")).alias("words"))


def _marked(rows: DataFrame, needed: Column) -> DataFrame:
    """Lines with their places marked: the words (at, word) that rule their place, and those enough texts have there.

    `leaf_texts` is the number of texts of the leaf's lines, and so of the votes at each of its places.
    """
    words = rows.select("leaf", "body", "texts", "size", "leaf_texts", F.posexplode("words").alias("at", "word"))
    words = words.filter(F.col("at") >= LEADING)
    votes = words.groupBy("leaf", "at", "word").agg(
        F.sum("texts").alias("votes"), F.min("size").alias("size"), F.min("leaf_texts").alias("leaf_texts")
    )
    # A place and its word go as one hash.
    mark, constant, often = F.xxhash64("leaf", "at", "word").alias("mark"), F.col("word") != ANY, F.col("votes") >= needed
    share = COMMON * F.col("leaf_texts")
    # Lines whose words neither rule nor stand often have no template. Two words can share the first rank only with half the votes each.
    marks = votes.filter((F.col("votes") >= share) | often).select(
        mark, constant.alias("constant"), (F.col("votes") >= share).alias("rules"), often.alias("often"),
        F.when(2 * F.col("votes") == F.col("leaf_texts"), F.struct("leaf", "at", "word")).alias("half"),
    )
    marks = stage(marks, "marks")
    lower = marks.filter("half is not null").select("half.*").groupBy("leaf", "at").agg(
        F.min("word").alias("word"), F.count(F.lit(1)).alias("words")
    )
    lower = lower.filter("words > 1").select(mark, F.lit(True).alias("lower"))
    rules = F.col("rules") & F.col("lower").isNull()
    marks = marks.join(lower, "mark", "left").select("mark", "constant", rules.alias("rules"), "often").filter("rules or often")
    # A mark stands in one row, so its side is small in every task.
    marks = marks.hint("shuffle_hash")
    return words.select("leaf", "body", "texts", "size", mark).join(marks, "mark").groupBy("leaf", "body", "texts", "size").agg(
        F.count_if("rules").alias("agree"), F.count_if(F.col("rules") & F.col("constant")).alias("constants"),
        F.count_if("often").alias("often"), F.count_if(F.col("often") & F.col("constant")).alias("often_constants"),
        # The marks of a line differ, so their sum in bits does not depend on their order.
        F.xxhash64(F.bit_xor(F.when(F.col("often"), F.col("mark"))), F.count_if("often")).alias("form"),
    )


def _enough(members: DataFrame, by: list[str], needed: Column) -> DataFrame:
    """The members of groups that hold enough texts."""
    groups = members.groupBy(*by).agg(F.sum("texts").alias("all_texts"), F.min("size").alias("size"))
    return members.join(groups.filter(F.col("all_texts") >= needed).select(*by), by, "left_semi")


def _templates(seen: DataFrame, min_docs: int | None) -> DataFrame:
    """Rows (leaf, body, template) of the lines that belong to a template found in enough texts."""
    needed, agreed = _needed(F.col("size"), min_docs), AGREE * (F.col("size") - LEADING)
    lines = stage(_marked(seen, needed), "agreeing")
    member = (F.col("agree") >= agreed) & (F.col("constants") > 0)
    main = stage(_enough(lines.filter(member), ["leaf"], needed).select("leaf", "body", F.col("leaf").alias("template")), "main")
    # Only lines with words enough that enough texts have can share a generalised form.
    rest = lines.filter(F.col("often") >= agreed).select("leaf", "body").join(main, ["leaf", "body"], "left_anti")
    rest = stage(seen.join(_sent_whole(rest), ["leaf", "body"], "left_semi"), "rest")
    formed = stage(_marked(rest, needed).filter((F.col("often") >= agreed) & (F.col("often_constants") > 0)), "formed")
    formed = _enough(formed, ["leaf", "form"], needed).select("leaf", "body", F.xxhash64("leaf", "form").alias("template"))
    found = stage(main.unionByName(formed), "members")
    return found


def recurring_lines(docs: DataFrame, *, min_docs: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The lines of crowded leaves as hashes, and the recurring templates' lines: leaf, body, template, first document."""
    lines = _crowded(stage(_lines(docs), "all_lines"), min_docs)
    # Equal texts have a line at equal places. A null id comes first.
    least = F.when(~F.bool_or(F.col("line_doc").isNull()), F.min("line_doc")).alias("line_doc")
    holders = lines.groupBy("leaf", "body", "line_version").agg(F.min("size").alias("size"), least, F.min("place").alias("place"))
    holders = stage(holders, "holders")
    # Any one text shows the words of a body: the first that is met.
    spot = [F.first(c).alias(c) for c in ("line_version", "line_doc", "place")]
    bodies = holders.groupBy("leaf", "body").agg(F.count(F.lit(1)).alias("texts"), F.min("size").alias("size"), *spot)
    bodies = stage(bodies.withColumnRenamed("line_doc", "spot_doc"), "bodies")
    # Leaves with several different lines and enough of them for a template.
    leaves = bodies.groupBy("leaf").agg(
        F.sum("texts").alias("texts"), F.count(F.lit(1)).alias("kinds"), F.min("size").alias("size")
    )
    enough = F.col("texts") >= _needed(F.col("size"), min_docs)
    varied = leaves.filter(enough & (F.col("kinds") > 1)).select("leaf", F.col("texts").alias("leaf_texts"))
    unread = stage(bodies.join(varied, "leaf"), "varied")
    seen = stage(_one_of_each(docs, unread), "seen")
    member = _templates(seen, min_docs)
    # Lines without a template are their own.
    named = holders.join(member, ["leaf", "body"], "left").withColumn("template", F.coalesce("template", "body"))
    named = stage(named.drop("texts"), "named")
    # Lines of one template in one text count once.
    counted = named.groupBy("leaf", "template", "line_version").agg(F.min("size").alias("size"))
    counted = counted.groupBy("leaf", "template").agg(F.count(F.lit(1)).alias("texts"), F.min("size").alias("size")).filter(enough)
    counted = stage(counted, "counted")
    held = named.join(counted.select("leaf", "template"), ["leaf", "template"], "left_semi")
    held = held.groupBy("leaf", "template", "line_version").agg(
        F.min(F.struct("line_doc", "place", "body")).alias("spot"), F.min("size").alias("size")
    )
    held = stage(held.select("leaf", "template", "line_version", "size", "spot.line_doc", "spot.place", "spot.body"), "held")
    firsts = held.groupBy("leaf", "template").agg(F.min(F.struct("line_doc", "line_version")).alias("first"))
    groups = stage(counted.join(firsts, ["leaf", "template"]), "groups")
    release(named)
    if min_docs is None:
        groups = groups.join(_unlike_groups(docs, held, counted, seen), ["leaf", "template"], "left_semi")
    groups = groups.select("leaf", "template", "first")
    members = bodies.select("leaf", "body").join(member, ["leaf", "body"], "left")
    found = members.withColumn("template", F.coalesce("template", "body")).join(groups, ["leaf", "template"])
    found = stage(found, "recurring")
    release(holders, unread)
    return lines, found


def drop_recurring_lines(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_docs: int | None = None
) -> DataFrame:
    """The rows of `docs` with recurring lines cut from the text, and `n_dropped`, the number of lines cut.

    Without `min_docs` the number of texts a line must be found in follows from its length.
    """
    # The given columns travel in one struct.
    given = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("line_row"), F.col(f"`{id_col}`").alias("line_doc"),
        F.xxhash64(F.col(f"`{text_col}`")).alias("line_version"), F.col(f"`{text_col}`").alias("line_text"),
    )
    source = given.select("line_doc", "line_version", "line_text")
    lines, found = recurring_lines(source, min_docs=min_docs)
    hits = lines.join(found, ["leaf", "body"]).filter(
        ~(F.col("line_doc").eqNullSafe(F.col("first.line_doc")) & (F.col("line_version") == F.col("first.line_version")))
    )
    cuts = hits.groupBy(F.col("line_doc").alias("cut_doc"), F.col("line_version").alias("cut_version")).agg(
        F.collect_set("place").alias("cut_places")
    )
    cuts = stage(cuts, "cuts")
    same = F.col("line_doc").eqNullSafe(F.col("cut_doc")) & (F.col("line_version") == F.col("cut_version"))
    # The text goes once, inside the struct.
    met, text = given.drop("line_text").join(cuts, same, "left"), F.col("line_row").getField(text_col)
    kept = F.filter(F.split(text, "\n"), lambda _, i: ~F.array_contains("cut_places", i))
    text = F.when(F.col("cut_places").isNull(), text).otherwise(F.array_join(kept, "\n"))
    dropped = F.when(F.col("cut_places").isNull(), F.lit(0)).otherwise(F.size("cut_places")).cast("long")
    own = [c for c in docs.columns if c != "n_dropped"]
    return met.select(*[text.alias(c) if c == text_col else F.col("line_row").getField(c).alias(c) for c in own], dropped.alias("n_dropped"))
