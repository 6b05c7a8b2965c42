"""What the shared inputs of the registered queries must keep to at scale."""

import time

from pyspark.sql import functions as F

from lexframe.functions import text as X
from lexframe.operators import curate as C, layout as L, notes as N
from lexframe.plans import base as B
from lexframe.sources import payload as P, readers as R

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


def test_filters_on_words_stay_above_their_grouping(spark):
    """A condition on what is derived from a word is asked once per distinct word, not at each of its places."""
    kana = B.kana_words(spark, FOLDER).where(F.col("annotated").rlike("部") & (F.length("reading") > 3))
    plan = "".join(plan_of(kana))
    assert "Generate" not in plan and "Aggregate" not in plan
    assert B.vocabulary(spark, FOLDER).agg(F.sum("freq")).first()[0] == B.words(spark, FOLDER).count()


def test_mined_examples_of_long_notes(one):
    """A long run without a reading is given up once, not from each of its characters; examples stay the same."""
    long = "木" * 5000
    start = time.time()
    got = one(N.mined_examples, long, f"［{long}］＝許容字体", "木木，木山県⇔木", "木a木（やま）県，［木］", "a（やま），木（やま）", "「木」などと使う。", "（や）木（や）")
    assert got == [[long], [], ["木木", "木山県"], ["［木］"], [], ["木"], []]
    assert one(N.strip_references, "木（や）県x木（や）", "x木（や）木（や）x", "木。木（や）") == ["", "x", "木。"]
    assert time.time() - start < 20


def test_lines_are_cleaned_once(spark):
    """Filters on cleaned lines or items do not clean them again."""
    lines = spark.createDataFrame([(1, 1, " ぶ "), (1, 2, "部（わ）"), (1, 3, "※ x"), (1, 4, "部　科"), (1, 5, None)], "doc int, n int, text string")
    entries = N.parse_references(lines, ["doc"], "n", "text")
    assert not any("Filter" in x and "regexp_replace" in x for x in plan_of(entries))
    assert sorted(map(tuple, entries.collect())) == [(1, 1, "ぶ", 0, "部"), (1, 1, "ぶ", 1, "部科")]
    lists = spark.createDataFrame([(1, " a , b(c),,a(x)"), (2, None), (3, "")], "n int, text string")
    items = R.parse_alternates(lists, ["n"], "text")
    assert not any("Filter" in x and "regexp_replace" in x for x in plan_of(items))
    assert sorted(map(tuple, items.collect())) == [(1, 0, "a", None), (1, 1, "b", "c")]


def test_bulk_update_judges_once(spark):
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, pos int, value string")
    given = spark.createDataFrame([(1, 1, " *a* "), (1, 2, "*b"), (2, 1, "*c*")], "k int, pos int, line string")
    good, bad = C.bulk_update(rows, given, ["k"], "marks")
    assert not any("FullOuter" in x for x in plan_of(good) + plan_of(bad))
    assert [tuple(r) for r in good.collect()] == [(2, 1, "*c*")] and [tuple(r) for r in bad.collect()] == [(1, 2, "unpaired marks")]


def test_strip_reads_the_ends_only(spark, one):
    odd = [" a\u3000", "\x1c\x85a b\u2028\n", "\u200ba\u200b", "", " \n\t", None, "a \r\n", "\ufeffa", "\x1ba\x0b", "日　本　"]
    assert one(X.strip, *odd) == one(lambda c: F.regexp_replace(c, f"^{X._SPACE}+|{X._SPACE}+$", ""), *odd)
    every = spark.range(0x3100).select(F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c"))
    assert every.where((X.strip(F.col("c")) == "") != F.col("c").rlike(f"^{X._SPACE}$")).count() == 0
    assert "regexp" not in "".join(plan_of(spark.range(1).select(F.col("id").cast("string").alias("c")).select(X.strip(F.col("c")))))


def test_cells_are_opened_behind_the_exchange(spark):
    """Equal cells are opened once, at their first place; ties of the order go to the first gloss."""
    rows = spark.createDataFrame([(2, "ab", "x|y"), (1, "ab", "x|y"), (1, "a", "y|z|x"), (3, "ab", "x|y"), (4, " ", "x"), (5, "a", None)], "n int, k string, c string")
    out = R.parse_multi_gloss(rows, ["n"], "k", "c")
    plan = plan_of(out)
    opened = max(i for i, x in enumerate(plan) if "Generate" in x)
    assert any("Aggregate" in x for x in plan[opened:])
    wanted = [("a", 1, 0, "x"), ("a", 1, 0, "y"), ("a", 1, 1, "z"), ("b", 1, 0, "x"), ("b", 1, 1, "y")]
    assert sorted(map(tuple, out.collect())) == wanted
    two = R.parse_multi_gloss(rows.withColumn("m", -F.col("n")), ["m", "n"], "k", "c")
    assert sorted(r[1:3] for r in two.where("key = 'b'").collect()) == [(-3, 3), (-3, 3)]


def test_tokens_are_not_joined_to_their_lines(spark):
    """Anchors are carried between the tokens of a page, which are dealt once."""
    rows = [(p, y, w) for p, y, w in [(1, 1.0, "a"), (1, 1.0, "b"), (1, 6.0, "c"), (1, 6.5, "d"), (1, 30.0, "e"), (2, 3.0, "f"), (None, 1.0, "g"), (1, None, "h"), (1, float("nan"), "i")]]
    placed = L.cluster_lines(spark.createDataFrame(rows, "page int, y double, w string"), ["page"], "y", 5)
    assert not any("Join" in x for x in plan_of(placed))
    assert {r.w: str(r.line_y) for r in placed.collect()} == {"a": "1.0", "b": "1.0", "c": "1.0", "d": "6.5", "e": "30.0", "f": "3.0", "i": "nan"}


def test_blocks_of_payloads_are_read_once(spark):
    """Numbers run on over the blocks without a window over the records; repeated keys over blocks are refused."""
    texts = [(1, 0, '{"b":{"t":"x"},"a":{"t":"y"}}'), (1, 3000, '{"c":{"t":"z"}}'), (2, 0, '{"a":{}}'), (2, 1, '{"a":{}}'), (3, 0, "{"), (3, 1, '{"q":{}}'), (4, 0, "{}"), (4, 1, '{"a":{"t":"v"}}'), (5, 0, None)]
    records, refused = P.flatten_blocks(spark.createDataFrame(texts, "payload int, block int, raw string"), "raw", "struct<t:string>")
    assert sorted((r.payload, r.ord, r.key, r.record.t) for r in records.collect()) == [(1, 0, "b", "x"), (1, 1, "a", "y"), (1, 2, "c", "z"), (4, 0, "a", "v")]
    assert sorted(r[0] for r in refused.collect()) == [2, 3, 5]
    # the records come out of the last step: nothing is dealt or counted behind them
    plan = plan_of(records)
    opened = min(i for i, x in enumerate(plan) if "Generate" in x)
    assert not any("Window" in x or "Join" in x or "Aggregate" in x for x in plan[:opened])
