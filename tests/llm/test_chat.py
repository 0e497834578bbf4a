from __future__ import annotations

from pyspark.sql import functions as F

from chartloom.llm.chat import branch_paths, format_branches, linear_messages, op1_chat, read_back

MESSAGES = "tree string, message long, parent long, score double, role string, text string"


def chats(spark, rows, **options):
    found = format_branches(spark.createDataFrame(rows, MESSAGES), **options)
    return {
        (r["tree"], r["leaf"]): [(t["role"], t["text"]) for t in r["turns"]]
        for r in found.withColumn("turns", read_back(F.col("formatted"))).collect()
    }


def test_best_branch_of_a_tree_and_ties(spark):
    rows = [
        ("t", 1, None, 0.0, "user", "q"),
        ("t", 2, 1, 0.2, "assistant", "bad"),
        ("t", 3, 1, 0.9, "assistant", "good"),
        ("t", 4, 3, 0.5, "user", "more"),
        ("t", 5, 3, 0.5, "user", "tie"),
    ]
    assert chats(spark, rows) == {("t", 4): [("user", "q"), ("assistant", "good"), ("user", "more")]}
    assert set(chats(spark, rows, per_tree=9)) == {("t", 2), ("t", 4), ("t", 5)}


def test_control_strings_come_back(spark):
    texts = ["\\", "<", "</turn>\n", "\\l\\b\\n", "<turn>user\nhi</turn>\n", "", "a\nb", "é\\\\<<"]
    rows = [("t", i, i - 1 if i else None, 1.0, f"ro\\le<\n{i}", text) for i, text in enumerate(texts)]
    assert chats(spark, rows) == {("t", 7): [(f"ro\\le<\n{i}", text) for i, text in enumerate(texts)]}


def test_odd_links(spark):
    rows = [
        ("t", 1, 99, None, None, None),  # parent missing: a root
        ("t", 2, 1, None, "user", "x"),
        ("t", 2, 1, None, "user", "x"),  # repeated
        ("c", 1, 2, 1.0, "user", "cycle"),
        ("c", 2, 1, 1.0, "user", "cycle"),
        ("c", 3, 2, 1.0, "user", "below it"),
        ("s", 1, 1, 1.0, "user", "answers itself"),
    ]
    assert chats(spark, rows) == {("t", 2): [("", ""), ("user", "x")]}
    assert chats(spark, []) == {}


def test_long_chain_in_few_rounds(spark):
    links = spark.range(300).select(
        F.lit("t").alias("tree"), F.col("id").alias("message"), F.when(F.col("id") > 0, F.col("id") - 1).alias("parent")
    )
    rows = branch_paths(links).collect()
    assert sorted((r["height"], r["message"]) for r in rows) == [(i, 299 - i) for i in range(300)]


def test_odd_turns(spark, tables):
    schema = "conv_id long, turn long, role string, text string, tree string, formatted int"
    rows = [(1, 0, "user", None, "", 1), (1, 0, "user", "b", "", 1), (1, None, None, "a", None, None), (None, 2, "assistant", "x<", "", 1)]
    found = op1_chat(spark, tables(conversations=spark.createDataFrame(rows, schema))).collect()
    assert {(r["conv_id"], r["n_turns"], r["loss_chars"]) for r in found} == {(1, 3, 0), (None, 1, 2), (-7, 2, 26)}
    ordered = linear_messages(spark.createDataFrame(rows, schema)).where("tree = '1'").orderBy("message")
    assert [r["text"] for r in ordered.collect()] == ["a", None, "b"]


def test_empty_table_has_only_the_probe(spark, tables):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert [r["conv_id"] for r in op1_chat(spark, tables(conversations=none)).collect()] == [-7]
