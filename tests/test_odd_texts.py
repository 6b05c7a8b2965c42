"""Registered queries against their SQL on small tables of odd texts."""

import os
import shutil
import time

from pyspark.sql import functions as F

import __spark_entry__ as entry
from lexframe.functions import text as X
from tests.compare import TABLES, compare, connect

SMALL = os.environ.get("LEXFRAME_SF_DIR", "/root/testdata/sf0.001")


def same_as_sql(spark, folder, name, texts):
    """The query agrees with its SQL where ``documents`` holds just these texts."""
    for table in TABLES:
        if table != "documents":
            shutil.copy(f"{SMALL}/{table}.parquet", f"{folder}/{table}.parquet")
    rows = [(i, t, ("en", "de")[i % 2], f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts, 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).toPandas().to_parquet(f"{folder}/documents.parquet")
    same, note = compare(spark, connect(str(folder)), str(folder), name, entry.queries()[name], entry.oracle_sql()[name])
    assert same, note


def test_accented_letters_of_two_sounds(spark, tmp_path):
    """Seven plain letters of two sounds and an accented one: 256 combinations, which the SQL has."""
    same_as_sql(spark, tmp_path, "sound_combinations", ["fürchpfchst bdfhjln bdfhjlnp", "üèà tür"])


def test_marks_in_chunks(one):
    """The pattern says what the edges of the chunks say."""
    texts = ["*夏(なつ)*の", "夏(な*つ)の*", "漢*字(かんじ)*", "*漢字*(かんじ)", "漢*字*かな", "漢字*(*かん", "*(か)*", "漢(字(か)*)*", "漢(か)*字(じ)*", "々*漢漢*漢(か", "a*b*", "**", ""]
    plain = [t.replace("*", "") for t in texts]
    edges = one(X.chunk_edges, *plain)
    offsets = one(X.mark_offsets, *texts)
    assert one(X.mark_in_chunk, *texts) == [any(o not in e for o in at) for e, at in zip(edges, offsets)]


def test_running_sums(spark):
    df = spark.range(1).select(*[X.running_sums(F.array_repeat(F.lit(2), n))[n - 1].alias(f"n{n}") for n in (1, 255, 256, 257, 70_000)])
    assert list(df.first()) == [2, 510, 512, 514, 140_000]
    assert spark.sql("select cast(array() as array<int>) v, cast(null as array<int>) w").select(X.running_sums(F.col("v")), X.running_sums(F.col("w"))).first()[:] == ([], None)


def test_long_sentence_in_chunks(one):
    """Four times the sentence takes about four times as long, not sixteen times."""
    def seconds(n):
        start = time.time()
        assert one(lambda c: F.size(X.chunk_edges(F.repeat(c, F.lit(n)))), "a") == [n + 1]
        return time.time() - start

    seconds(1_000)
    assert seconds(400_000) < 20


def test_grammar_of_a_long_sentence(spark, tmp_path):
    same_as_sql(spark, tmp_path, "grammar_dataset", ["one. two. " + "three " * 3_000 + ". four. five. six", "a*b. c(d)e. f(g. h)i*", None, ""])


def test_gate_works_out_an_annotation_once(spark):
    """The template of a word is built once in the plan of its attempt, not once for each check of it."""
    plan = entry.queries()["template_gate"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("(READ") <= 4, plan.count("(READ")


def test_sentences_are_not_dealt_by_word(spark):
    """The few best words go to the sentences, however large Spark takes them to be."""
    names = [f"spark.sql.{a}autoBroadcastJoinThreshold" for a in ("", "adaptive.")]
    try:
        for name in names:
            spark.conf.set(name, "-1")
        plan = entry.queries()["flagship_examples"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in names:
            spark.conf.unset(name)
    assert "LeftSemi" in plan and not any("SortMergeJoin" in row and "LeftSemi" in row for row in plan.splitlines())


def test_senses_are_described_once(spark, tmp_path):
    """What a sense is compared by stands once in the plan, before the pairs."""
    plan = entry.queries()["audit_redundancy"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_distinct") + plan.count("[0-9") <= 2
    same_as_sql(spark, tmp_path, "audit_redundancy", ["a, b, a(c), d. no, not, on. x1,x. abcd e, abcde. (a), (b), (). ab, c ab. , ,. one", None, "q, 1, 22, q"])
