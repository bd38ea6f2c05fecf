"""Document fingerprints from spot signatures.

A spot is a common word (an anchor) followed by a content word. Its signature is the chain of the next
`chain` content words, anchors between them skipped, as a 32-bit hash; at a text's end chains may be shorter.
A fingerprint is the sorted set of a text's signatures. Texts with words but no spot have one signature, that
of all their words. Fingerprints are compared by Jaccard similarity; as it cannot exceed the ratio of the
sets' lengths, sets of too different length are told apart without looking at their members.

Everything is built from column expressions. Neighbours by id are found inside ranges of ids of about
`range_rows` rows each, whose borders follow the ids' distribution; the first row of a range is repeated as
the last of the one before, so no window spans the table.

Defined results: null texts count as empty; texts without words have an empty fingerprint, two of which are
alike (1), one of which is unlike any other (0). Null ids come first; rows of one id follow each other by
text. The next of the last row is the first, also if it is the only one. Repeated rows repeat, an empty table
gives an empty table, and only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adtally.sources.staging import stage

# Common words of four languages.
ANCHORS = (
    "a an and are as at be but by for from had has have he her his i in is it not of on or she that the their "
    "there they this to was we were which with you "
    "als am auf aus das dem den der des die ein eine einem einen einer es für ich im ist mit nicht noch sich sie "
    "sind und von war wie zu zum zur über "
    "au aux avec ce ces dans de du elle en est et il la le les mais ne nous ou par pas pour qui que sa se son sur "
    "un une "
    "al como con del el ella esta lo los las más no para pero por su una y"
).split()
CHAIN = 3
RANGE_ROWS = 1000
CUTS = 64
MAX_BROADCAST_RANGES = 1_000_000  # of two numbers each
NOT_WORDS = "[^\\p{L}\\p{N}]+"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def signatures(text: Column, *, chain: int = CHAIN) -> Column:
    """The sorted distinct signatures of a text, as an array of long."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORDS), lambda w: w != "")

    def of_words(w: Column) -> Column:
        common = F.transform(w, lambda x: x.isin(*ANCHORS))
        return _let(common, lambda c: of_marks(w, c))

    def of_marks(w: Column, c: Column) -> Column:
        content = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: ~F.get(c, i))
        return _let(content, lambda p: of_places(w, c, p))

    def of_places(w: Column, c: Column, p: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(p) - 1), lambda j: (F.get(p, j) > 0) & F.get(c, F.get(p, j) - 1)
        )
        links = lambda j: [F.get(w, F.get(p, j + k)) for k in range(chain)]
        spots = F.transform(starts, lambda j: _short(F.xxhash64(*links(j))))
        usable = F.when(F.size(p) > 0, spots).otherwise(F.array().cast("array<bigint>"))
        return F.when(F.size(usable) > 0, usable).otherwise(F.array(_short(F.xxhash64(w))))

    found = _let(words, lambda w: F.when(F.size(w) > 0, of_words(w)).otherwise(F.array().cast("array<bigint>")))
    return F.array_sort(F.array_distinct(found))


def _short(hashed: Column) -> Column:
    return F.shiftrightunsigned(hashed, 32)


def as_text(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda h: F.lower(F.hex(h))), ",")


def likeness(left: Column, right: Column, *, floor: float = 0.0) -> Column:
    """Jaccard similarity of two signature sets; 0 without a look at them if their lengths rule out `floor`."""
    a, b = F.size(left), F.size(right)
    both = F.size(F.array_intersect(left, right))
    bound = F.least(a, b) / F.greatest(a, b, F.lit(1))
    return F.when((a == 0) & (b == 0), 1.0).when((bound < floor) | (bound == 0), 0.0).otherwise(both / (a + b - both))


def with_next_row(df: DataFrame, key: str, order: str, columns: dict[str, str], *, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Add columns of the next row by (`key`, `order`), for a whole-number key; the last row is followed by the first.

    `columns` maps new names to existing ones.
    """
    cuts = [i / CUTS for i in range(CUTS)]
    number, lows, high = df.agg(F.count(F.lit(1)), F.percentile_approx(key, cuts, 1000), F.max(key)).first()
    if not number:
        return df.withColumns({new: F.col(old) for new, old in columns.items()})
    lows = sorted(set(lows or []))
    steps = [max(1, (hi - lo) * CUTS * range_rows // number) for lo, hi in zip(lows, [*lows[1:], (high or 0) + 1])] if lows else []
    part = F.lit(-1).cast("long")
    for place, (low, step) in enumerate(zip(lows, steps)):
        part = F.when(F.col(key) >= low, place * (1 << 40) + F.floor((F.col(key) - low) / step)).otherwise(part)
    ranged = df.withColumn("range_no", part)
    firsts = ranged.groupBy("range_no").agg(F.min(F.struct(key)).alias("first"))
    firsts = firsts.select("range_no", F.col(f"first.{key}").alias("first_key"))
    # One row per range of about `range_rows` rows.
    order_of = Window.orderBy("range_no")
    before = F.lag("range_no").over(order_of)
    last = F.max("range_no").over(Window.partitionBy(F.lit(0)))
    firsts = firsts.select("first_key", F.coalesce(before, last).alias("goes_to"))
    firsts = stage(firsts, "firsts")
    # A task needs the few first ids only; beyond the limit both sides are partitioned by id.
    firsts = F.broadcast(firsts) if firsts.count() <= MAX_BROADCAST_RANGES else firsts
    heads = df.join(firsts, F.col(key).eqNullSafe(F.col("first_key"))).withColumn("range_no", F.col("goes_to"))
    heads = heads.drop("first_key", "goes_to").withColumn("is_head", F.lit(1))
    rows = ranged.withColumn("is_head", F.lit(0)).unionByName(heads)
    ahead = Window.partitionBy("range_no").orderBy("is_head", F.asc_nulls_first(key), F.asc_nulls_first(order))
    found = rows.withColumns({new: F.lead(old).over(ahead) for new, old in columns.items()})
    return found.filter("is_head = 0").drop("is_head", "range_no")


def fingerprint_neighbours(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", chain: int = CHAIN, floor: float = 0.0
) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how like they and the next row's are.

    The edited text ends in as much of the next text as a quarter of its own length.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("marks", signatures(F.col("text"), chain=chain))
    pairs = with_next_row(own, "doc_id", "text", {"next_text": "text", "next_marks": "marks"})
    length = F.length("text")
    cut = F.floor(length / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), length - cut), F.substring("next_text", F.lit(1), cut))
    pairs = pairs.withColumn("edited", edited)
    pairs = pairs.withColumn("edited_marks", signatures(F.col("edited"), chain=chain))
    return pairs.select(
        "doc_id", "text", "edited", length.cast("long").alias("n_chars"), "marks", "edited_marks",
        as_text(F.col("marks")).alias("fingerprint"), as_text(F.col("edited_marks")).alias("edited_fingerprint"),
        likeness(F.col("marks"), F.col("edited_marks"), floor=floor).alias("near_edited"),
        likeness(F.col("marks"), F.col("next_marks"), floor=floor).alias("near_next"),
    )
