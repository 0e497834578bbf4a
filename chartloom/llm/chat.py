r"""Chat formatting of reply trees.

Messages name the message they answer. Root-to-leaf paths come from self-joins that double
their reach: after round k every message knows its ancestor 2**k steps up, and every path
its 2**k lowest messages, so the rounds are the logarithm of the longest path. Paths
("branches") are ranked in their tree by score, and each chosen path becomes one
conversation: text segments with a loss flag, and their concatenation.

Template, for each turn: ``<turn>`` role, newline, text, ``</turn>``, newline. Inside roles
and texts a backslash becomes ``\b`` and ``<`` becomes ``\l`` (and in roles a line break
``\n``). So no escaped text holds ``<``, every backslash starts a code, and
``unescape`` gives back the exact text. The loss mask covers the escaped texts of the
assistant, without markers.

Defined cases: null text or role is empty; a message whose parent is missing or null is a
root; messages on or below a cycle have no root and form no path; a repeated (tree,
message) is one message, the smallest (parent, score, role, text) of it; ties in score go
to the smaller leaf; extra columns are ignored; an empty table gives an empty result. In tables of plain turns every turn
answers the one before it; equal turn numbers are ordered by role and text, null first; a
null conversation id is a conversation of its own.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartloom.llm.common import stage, table

# Fixed values
OPEN, CLOSE = "<turn>", "</turn>\n"
LOSS_ROLE = "assistant"
PROBE_ID, PROBE_TEXT = -7, "\\### Assistant: </turn> ok"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def branch_paths(messages: DataFrame) -> DataFrame:
    """(tree, leaf, message, height) for every leaf and every message on its path.

    ``messages`` has (tree, message, parent), with unique (tree, message). ``height`` counts
    from the leaf up. Rows are as many as the paths are long.
    """
    nodes = messages.select("tree", "message")
    links = (
        messages.where(F.col("parent").isNotNull())
        .join(nodes.select("tree", F.col("message").alias("parent")), ["tree", "parent"], "left_semi")
        .select("tree", "message", F.col("parent").alias("above"))
    )
    links = stage(links, "reply-links")
    leaves = nodes.join(links.select("tree", F.col("above").alias("message")), ["tree", "message"], "left_anti")
    paths = stage(
        leaves.select("tree", F.col("message").alias("leaf"), "message", F.lit(0).cast("long").alias("height")),
        "branch-ends",
    )
    most = ceil(log2(max(2, messages.count()))) + 1
    jumps = links
    for k in range(most):
        if jumps.isEmpty():
            return paths
        # The links of this round reach 2**k up; paths hold 2**k messages, where there are as many.
        longer = paths.join(jumps, ["tree", "message"]).select(
            "tree", "leaf", F.col("above").alias("message"), (F.col("height") + 2**k).alias("height")
        )
        paths = stage(paths.unionByName(longer), "branches")
        further = jumps.alias("a").join(
            jumps.alias("b"), (F.col("a.tree") == F.col("b.tree")) & (F.col("a.above") == F.col("b.message"))
        )
        jumps = stage(further.select("a.tree", "a.message", "b.above"), "reply-links")
    # What still has an ancestor after so many doublings leads into a cycle.
    endless = jumps.select("tree", F.col("message").alias("leaf")).distinct()
    return paths.join(endless, ["tree", "leaf"], "left_anti")


def ranked_branches(paths: DataFrame, messages: DataFrame) -> DataFrame:
    """(tree, leaf, branch_score, branch_rank): the mean score of a path's messages; best first."""
    scored = paths.join(messages.select("tree", "message", "score"), ["tree", "message"])
    branches = scored.groupBy("tree", "leaf").agg(F.avg(F.coalesce("score", F.lit(0.0))).alias("branch_score"))
    best_first = Window.partitionBy("tree").orderBy(F.desc("branch_score"), "leaf")
    return branches.withColumn("branch_rank", F.row_number().over(best_first))


def format_branches(messages: DataFrame, per_tree: int = 1) -> DataFrame:
    """The best ``per_tree`` paths of each tree as conversations.

    ``messages`` has (tree, message, parent, score, role, text). Returns (tree, leaf,
    branch_rank, branch_score, segments, formatted): ``segments`` are the pieces of
    ``formatted`` in order, each with its loss flag.
    """
    messages = messages.groupBy("tree", "message").agg(
        F.min(F.struct("parent", "score", F.coalesce("role", F.lit("")).alias("role"),
                       F.coalesce("text", F.lit("")).alias("text"))).alias("m")
    ).select("tree", "message", "m.*")
    paths = branch_paths(messages)
    chosen = ranked_branches(paths, messages).where(F.col("branch_rank") <= per_tree)
    turns = (
        paths.join(chosen, ["tree", "leaf"])
        .join(messages.select("tree", "message", "role", "text"), ["tree", "message"])
        .groupBy("tree", "leaf", "branch_rank", "branch_score")
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("height")).alias("depth"), "role", "text"))).alias("turns"))
    )

    def pieces(turn: Column) -> Column:
        return F.array(
            F.struct(F.concat(F.lit(OPEN), escape_role(turn["role"]), F.lit("\n")).alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(turn["text"]).alias("text"), (turn["role"] == LOSS_ROLE).alias("loss")),
            F.struct(F.lit(CLOSE).alias("text"), F.lit(False).alias("loss")),
        )

    return turns.select(
        "tree", "leaf", "branch_rank", "branch_score",
        F.flatten(F.transform("turns", pieces)).alias("segments"),
    ).withColumn("formatted", F.array_join(F.col("segments.text"), ""))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text)."""
    turns = F.split(formatted, CLOSE)
    whole = F.slice(turns, 1, F.size(turns) - 1)

    def turn(piece: Column) -> Column:
        inner = F.substring(piece, len(OPEN) + 1, 2**31 - 1)
        role = F.substring_index(inner, "\n", 1)
        text = F.substr(inner, F.char_length(role) + 2)
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(whole, turn)


def linear_messages(turns: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) as messages that each answer the one before."""
    tree = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    place = F.row_number().over(Window.partitionBy("tree").orderBy("turn", "role", "text"))
    return (
        turns.select(tree.alias("tree"), "turn", "role", "text")
        .withColumn("message", place.cast("long"))
        .withColumn("parent", F.when(F.col("message") > 1, F.col("message") - 1))
        .withColumn("score", F.lit(1.0))
        .drop("turn")
    )


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the probe, read back from what was formatted."""
    probe = spark.range(2).select(
        F.lit(PROBE_ID).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit(LOSS_ROLE)).alias("role"),
        F.lit(PROBE_TEXT).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    chats = format_branches(stage(linear_messages(turns), "messages"))
    told = F.transform(read_back(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join(
        F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), ""
    )
    return chats.select(
        F.col("tree").try_cast("long").alias("conv_id"),
        F.size(told).cast("long").alias("n_turns"),
        F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


#: The digests straight from the turns; the length from the template's rule.
OP1_SQL = r"""
with probe as (
    select -7::bigint conv_id, t::bigint turn, case t when 0 then 'user' else 'assistant' end "role",
           '\### Assistant: </turn> ok' "text" from range(0, 2) r(t)),
turns as (
    select conv_id, turn, "role" as kind_or_null, "text" as text_or_null, coalesce("role", '') kind, coalesce("text", '') said
    from (select conv_id, turn, "role", "text" from conversations union all select * from probe))
select conv_id, count(*)::bigint as n_turns,
       sha256(string_agg(kind || chr(10) || said || chr(10), '' order by turn nulls first, kind_or_null nulls first, text_or_null nulls first)) as turns_sha256,
       coalesce(sum(length(said)) filter (kind = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(said, '' order by turn nulls first, kind_or_null nulls first, text_or_null nulls first) filter (kind = 'assistant'), '')) as loss_sha256,
       sum(15 + length(kind) + length(said)
           + length(kind || said) - length(replace(replace(kind || said, '\', ''), '<', ''))
           + (length(kind) - length(replace(kind, chr(10), ''))))::bigint as formatted_chars
from turns group by conv_id
"""
