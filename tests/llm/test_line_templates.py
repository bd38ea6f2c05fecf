from __future__ import annotations

import re

from pyspark.sql import functions as F

from adtally.llm import line_templates
from tests.llm.helpers import awkward, documents, empty


def brute(texts: dict, min_docs: int) -> dict:
    """The documented rules, over a dictionary of texts by id."""
    split = lambda line: [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[^\x20\x09-\x0d]*[0-9][^\x20\x09-\x0d]*", "<*>", line)) if w]
    leaves: dict = {}
    for doc, text in texts.items():
        for line in (text or "").split("\n") if text is not None else []:
            words = tuple(split(line))
            if words:
                leaves.setdefault((len(words), words[:3]), {}).setdefault(words, set()).add((text, doc))
    template = {}
    for leaf, kinds in leaves.items():
        count = {k: len({t for t, _ in v}) for k, v in kinds.items()}
        if len(kinds) > 1 and sum(count.values()) >= min_docs:
            ruling = []
            for at in range(leaf[0]):
                votes: dict = {}
                for k, n in count.items():
                    votes[k[at]] = votes.get(k[at], 0) + n
                top = max((n, w.encode()) for w, n in votes.items())
                ruling.append(top[1].decode() if top[0] >= 0.5 * sum(votes.values()) else None)
            for k in kinds:
                if sum(a == b for a, b in zip(k, ruling)) >= 0.6 * len(k):
                    template[k] = (leaf, 0)
    groups: dict = {}
    for leaf, kinds in leaves.items():
        for k, holders in kinds.items():
            groups.setdefault(template.get(k, k), set()).update(holders)
    first = {g: min(d for _, d in h) for g, h in groups.items() if len({t for t, _ in h}) >= min_docs}
    out = {}
    for doc, text in texts.items():
        if text is None:
            out[doc] = None
            continue
        keep = []
        for line in text.split("\n"):
            words = tuple(split(line))
            group = template.get(words, words)
            if not words or group not in first or first[group] == doc:
                keep.append(line)
        out[doc] = "\n".join(keep)
    return out


def made() -> list[str]:
    texts = []
    for i in range(60):
        lines = [f"own line {'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]} of this document", "All rights are reserved by us", ""]
        lines += [f"Page {i} of 60 printed on day {i * 7}", f"The report of month {'xyzuvw'[i % 6]} is here for you all"]
        texts.append("\n".join(lines if i % 4 else lines[:1]))
    return texts + [texts[1]] * 30


def test_against_brute_force(spark):
    texts = made()
    for min_docs in (2, 10, 200):
        rows = line_templates.drop_recurring_lines(documents(spark, texts), min_docs=min_docs).collect()
        expected = brute(dict(enumerate(texts)), min_docs)
        assert {r["doc_id"]: r["text"] for r in rows} == expected


def test_variable_fields_are_one_template(spark):
    rows = {r["doc_id"]: r for r in line_templates.drop_recurring_lines(documents(spark, made())).collect()}
    assert "Page 1 of 60" in rows[1]["text"] and "Page 2 of" not in rows[2]["text"]
    assert "own line" in rows[2]["text"] and rows[0]["n_dropped"] == 0


def test_whole_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = line_templates.drop_recurring_lines(docs, min_docs=3)
    assert rows.columns == [*docs.columns, "n_dropped"]
    assert {r["doc_id"]: r["text"] for r in rows.collect()} == brute(texts, 3)


def test_awkward_and_empty(spark):
    df = awkward(spark)
    rows = line_templates.drop_recurring_lines(df, min_docs=2)
    assert rows.count() == df.count()
    assert rows.filter("text is null").count() == df.filter("text is null").count()
    assert line_templates.drop_recurring_lines(empty(spark)).count() == 0


def passage(words: int, name: str) -> str:
    return " ".join(f"{name}{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(words))


def shared_by(count: int, words: int, name: str, own: int = 40) -> list[str]:
    return ["\n".join([passage(own, f"{name}own{'abcdefghij'[i]}"), passage(words, name), f"end of {name}{'abcdefghij'[i]}"]) for i in range(count)]


def test_default_follows_length(spark):
    """A long passage goes from 2 and from 5 texts on, also where it is most of the text; a short line needs 10."""
    cases = {"two": (2, 60), "five": (5, 55), "half": (2, 30), "three": (3, 30), "short": (5, 6), "mid": (4, 12), "mids": (5, 12)}
    texts = [t for name, (count, words) in cases.items() for t in shared_by(count, words, name)]
    texts += shared_by(2, 60, "brief", own=6)
    rows = line_templates.drop_recurring_lines(documents(spark, texts)).collect()
    left = {name: sum(f"{passage(words, name)}\n" in r["text"] for r in rows) for name, (_, words) in cases.items()}
    assert left == {"two": 1, "five": 1, "half": 2, "three": 1, "short": 5, "mid": 4, "mids": 1}
    assert sum(passage(60, "brief") in r["text"] for r in rows) == 1


def test_edited_copies_count_once(spark):
    one = [passage(60, name) for name in ("first", "second", "third", "fourth")]
    texts = ["\n".join(one), "\n".join([*one[:3], one[3].replace("fourthak", "changed")])]
    rows = line_templates.drop_recurring_lines(documents(spark, texts)).collect()
    assert {r["doc_id"]: r["text"] for r in rows} == dict(enumerate(texts))
    rows = line_templates.drop_recurring_lines(documents(spark, [*texts, f"another text\n{one[1]}"])).collect()
    assert [r["n_dropped"] for r in sorted(rows, key=lambda r: r["doc_id"])] == [0, 1, 1]


def test_default_on_the_whole_table(spark, folder):
    """Planted passages go from all but their first documents, and nothing else changes by them."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{folder}/documents.parquet").filter("text is not null")
    plain = {r["doc_id"]: r for r in line_templates.drop_recurring_lines(docs).collect()}
    ids = sorted(plain)
    holders = {ids[3]: "two", ids[150]: "two", **{ids[i]: "five" for i in (10, 40, 70, 100, 130)}}
    mark = F.lit("")
    for doc, name in holders.items():
        mark = F.when(F.col("doc_id") == doc, "\n" + passage(60, name)).otherwise(mark)
    rows = {r["doc_id"]: r for r in line_templates.drop_recurring_lines(docs.withColumn("text", F.concat("text", mark))).collect()}
    first = {ids[3], ids[10]}
    for doc, row in rows.items():
        kept = f"\n{passage(60, holders[doc])}" if doc in first else ""
        assert row["text"] == plain[doc]["text"] + kept
        assert row["n_dropped"] == plain[doc]["n_dropped"] + (doc in holders and doc not in first)


def test_templates_need_a_constant_after_the_leading_words(spark):
    texts = [f"We are all {w}\nThis is my {w} {passage(1, w)}" for w in passage(12, "own").split()]
    rows = line_templates.drop_recurring_lines(documents(spark, texts)).collect()
    assert {r["doc_id"]: r["text"] for r in rows} == dict(enumerate(texts))


def test_several_templates_in_a_leaf(spark):
    """Two templates with a variable word among ordinary lines that outnumber them."""
    lead, names = "Some leading words", passage(12, "name").split()
    one = [f"{lead} please call our office {n} before noon" for n in names]
    two = [f"{lead} never send your password to {n} again" for n in names]
    ordinary = [f"{lead} {passage(7, f'plain{a}{b}')}" for a in "abcdef" for b in "ghijklmn"]
    texts = [*one, *two, *ordinary]
    rows = {r["doc_id"]: r["text"] for r in line_templates.drop_recurring_lines(documents(spark, texts), min_docs=10).collect()}
    gone = {*range(1, 12), *range(13, 24)}
    assert rows == {i: "" if i in gone else t for i, t in enumerate(texts)}


def edited(text: str, k: int) -> str:
    """A copy whose k-th word of the second and third line is another one: of the runs besides a line three quarters stay."""
    first, second, third, *rest = text.split("\n")
    change = lambda line: " ".join("other" + "abcdefghijklmnopqrstuvwxyz"[k] if i == k else w for i, w in enumerate(line.split()))
    return "\n".join([first, change(second), change(third), *rest])


def test_edited_copies_keep_their_lines_at_every_number(spark):
    """9, 12 and 25 near copies of one document: their lines are not boilerplate, whatever their number."""
    for count in (9, 12, 25):
        text = "\n".join([passage(60, "body"), *[passage(30, f"line{c}") for c in "abcde"]])
        texts = [edited(text, k) for k in range(count)]
        rows = line_templates.drop_recurring_lines(documents(spark, texts)).collect()
        assert {r["doc_id"]: r["text"] for r in rows} == dict(enumerate(texts)), count
    others = [f"a text of {w} own words\n{passage(60, 'body')}" for w in passage(3, "quite").split()]
    rows = line_templates.drop_recurring_lines(documents(spark, [*texts, *others])).collect()
    assert sum(r["n_dropped"] for r in rows if r["doc_id"] >= len(texts)) == 3


def test_no_column_name_clashes(spark):
    from pyspark.sql import functions as F

    names = ("line_doc", "line_version", "line_text", "line_row", "cut_places", "cut_doc", "cut_version", "leaf", "body", "place", "first", "n_dropped")
    df = documents(spark, made())
    plain = {(r["doc_id"], r["text"], r["n_dropped"]) for r in line_templates.drop_recurring_lines(df).collect()}
    more = line_templates.drop_recurring_lines(df.withColumns({name: F.lit("x") for name in names}))
    assert more.columns == [*df.columns, *names[:-1], "n_dropped"]
    rows = more.collect()
    assert {(r["doc_id"], r["text"], r["n_dropped"]) for r in rows} == plain
    assert {r[name] for r in rows for name in names[:-1]} == {"x"}


def test_lines_of_equal_words_are_one(spark):
    """White space of every kind parts words; a word with a digit is masked as a whole, whatever stands beside it."""
    ways = ["the ab1cd words of one line", "  the\tab1cd words  of one line ", "the x9 words\x0bof \x0cone line\r", "the 7z-words words of one line"]
    one = line_templates._lines(_given(documents(spark, ["\n".join(["", " \t", *ways]), None, ""]))).collect()
    assert sorted((r["place"], r["size"]) for r in one) == [(i + 2, 6) for i in range(4)]
    assert len({(r["leaf"], r["body"]) for r in one}) == 1
    words = line_templates._split(line_templates._masked(F.col("line")))
    split = spark.createDataFrame([(w,) for w in ways], "line string").select(words.alias("words")).collect()
    assert {tuple(r["words"]) for r in split} == {("the", "<*>", "words", "of", "one", "line")}


def test_runs_are_hashes_of_five_words(spark):
    for text in ("a", "a b c d", "a b c d e", "a b c d e f a b c d e g"):
        words = text.split()
        expected = [" ".join(words[i : i + 5]) for i in range(max(len(words) - 4, 1))]
        row = spark.createDataFrame([(words, [e.split() for e in dict.fromkeys(expected)])], "w array<string>, r array<array<string>>")
        hashed = F.transform("r", lambda run: F.xxhash64(F.transform(run, lambda w: F.xxhash64(w))))
        got, want = row.select(line_templates._runs(F.col("w")), hashed).first()
        assert got == want, text


def test_line_steps_need_few_sorts(spark):
    """The pass over all lines and the votes aggregate by hash; before, three of them sorted every line."""
    docs = _given(documents(spark, made()))
    kept, plans = line_templates.stage, {}
    try:
        line_templates.stage = lambda df, label="table", **more: plans.setdefault(label, df._jdf.queryExecution().sparkPlan().toString()) and kept(df, label, **more)
        line_templates.recurring_lines(docs)
    finally:
        line_templates.stage = kept
    assert not [name for name in ("holders", "bodies", "counted") if "SortAggregate" in plans[name]]
    assert "ObjectHashAggregate" not in plans["agreeing"]


def _staged_rows(call) -> dict:
    """The rows of each intermediate table that a call writes, by label."""
    kept, rows = line_templates.stage, {}

    def stage(df, label="table", **more):
        staged = kept(df, label, **more)
        rows.setdefault(label, []).append(staged.count())
        return staged

    try:
        line_templates.stage = stage
        call()
    finally:
        line_templates.stage = kept
    return rows


def test_first_texts_settle_a_group(spark):
    """A short line needs 10 texts: of 60, the first 20 are compared; before, all of them were."""
    line = "All rights of this page are ours alone"
    texts = [f"{passage(40, w)}\n{line}" for w in passage(60, "own").split()]
    got = []
    rows = _staged_rows(lambda: got.extend(line_templates.drop_recurring_lines(documents(spark, texts)).collect()))
    assert rows["sketches"] == [20]
    assert {r["doc_id"]: r["text"] for r in got} == {i: t if i == 0 else t.split("\n")[0] for i, t in enumerate(texts)}


def test_other_texts_are_compared_where_the_first_are_copies(spark):
    """The first 25 holders are copies of each other, the last two are not; rows stand twice."""
    text = "\n".join([passage(60, "body"), *[passage(30, f"line{c}") for c in "abcde"]])
    texts = [edited(text, k) for k in range(25)] + [f"a text of {w} own words\n{passage(60, 'body')}" for w in ("quite", "rather")]
    df = documents(spark, texts)
    got = []
    rows = _staged_rows(lambda: got.extend(line_templates.drop_recurring_lines(df.unionAll(df)).collect()))
    first, every = rows["sketches"]
    assert first < every == len(texts) and len(got) == 2 * len(texts)
    dropped = {(r["doc_id"], r["n_dropped"]) for r in got}
    assert len(dropped) == len(texts) and sum(n for _, n in dropped) == 26


def test_lines_of_small_leaves_are_left_out_early(spark):
    """A leaf of fewer lines than a template needs texts cannot hold one; before, its lines went through every step."""
    texts = [f"{passage(8, w)}\n{passage(12, 'shared')}" for w in passage(6, "own").split()]
    rows = _staged_rows(lambda: line_templates.recurring_lines(_given(documents(spark, texts))))
    assert rows["holders"] == [6] and rows["recurring"] == [1]


def test_equal_votes_go_to_the_larger_word(spark):
    lines = [(1, body, 5, 6, 10, f"a b c {word} p q".split()) for body, word in ((1, "x"), (2, "y"))]
    rows = spark.createDataFrame(lines, "leaf long, body long, texts long, size int, leaf_texts long, words array<string>")
    marked = line_templates._marked(rows, F.lit(6)).collect()
    assert {r["body"]: (r["agree"], r["often"]) for r in marked} == {1: (2, 2), 2: (3, 2)}


def _given(docs):
    return docs.select(F.col("doc_id").alias("line_doc"), F.xxhash64("text").alias("line_version"), F.col("text").alias("line_text"))
