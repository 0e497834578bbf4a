"""Line deduplication: repeated runs of lines, found by a suffix array over line ids.

Documents are sequences of the ids of their lines that have a word. The suffixes of all
sequences are ranked by prefix doubling: the first ranks order suffixes by one line, and each
round doubles the lines that count, from the pair of ranks at a place and as many lines
further on; a rank is the number of suffixes before it that can still have equals. Suffixes
whose first lines are unlike all others leave at once, so every round works on
what repeats.

Suffixes with equal first lines form the longest-common-prefix intervals. A run counts from
50 words on. From each line the shortest run of 50 words is fixed by the lines
themselves, forwards and backwards, and two overlapping stretches whose lengths are a power
of two cover it: their two ranks name the interval. Of an interval the first
run (by document id, then place) stays, later ones go. The union of these runs is the union of
all repeated runs of 50 words or more, at their full length: what is deleted is the
maximal later copies. Fifty words are at most fifty lines, so six rankings suffice at any size.

Only narrow rows are shuffled until the last join with the texts. Ranks are joined and
counted by key with partial sums in each task; joins on the rank of a very frequent line
are split by adaptive execution.

Defined cases: null text stays null and has no lines; lines without a word are never
deleted and do not part a run; a repeat inside one document goes only if it does not overlap the
first; of equal rows (id and text) all but one lose every line that has a word if these
have 50 words or more; a null id comes first in order; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartloom.llm.common import stage, table, words_by_space

MIN_WORDS = 50  # of a run
RANK_BITS = 14  # leading bits of a line's hash that part the first ranking
HAS_WORD = r"[^\x20\x09-\x0D]"


def _shortest(counts: Column, min_words: int) -> Column:
    """How many of the counts, in order, add up to ``min_words``; null if all do not."""
    start = F.struct(F.lit(0).cast("long").alias("words"), F.lit(0).alias("lines"))

    def add(seen: Column, n: Column) -> Column:
        more = F.struct((seen["words"] + n).alias("words"), (seen["lines"] + 1).alias("lines"))
        return F.when(seen["words"] >= min_words, seen).otherwise(more)

    return F.aggregate(counts, start, add, lambda seen: F.when(seen["words"] >= min_words, seen["lines"]))


def line_table(docs: DataFrame, key: str, text: str, min_words: int) -> DataFrame:
    """(doc, place, line, forward, backward) for each line with a word of each different row.

    ``line`` identifies the text of the line; ``forward`` and ``backward`` are the lines of the
    shortest run of ``min_words`` words that begins or ends there.
    """
    wordy = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: F.rlike(x, F.lit(HAS_WORD)))
    each = (
        docs.select(
            F.struct(F.col(key).alias("id"), F.xxhash64(F.col(text)).alias("digest")).alias("doc"), wordy.alias("wordy")
        )
        .withColumn("counts", F.transform("wordy", lambda x: F.size(words_by_space(x)).cast("long")))
        .withColumn("backwards", F.reverse("counts"))
    )

    def entry(line: Column, i: Column) -> Column:
        rest = F.slice(F.col("counts"), i + 1, F.lit(min_words))
        before = F.slice(F.col("backwards"), F.size("wordy") - i, F.lit(min_words))
        identity = F.struct(F.xxhash64(line).alias("h"), F.hash(line).alias("g"), F.octet_length(line).alias("size"))
        return F.struct(
            i.alias("place"),
            identity.alias("line"),
            _shortest(rest, min_words).alias("forward"),
            _shortest(before, min_words).alias("backward"),
        )

    lines = each.select("doc", F.explode(F.transform("wordy", entry)).alias("e")).select("doc", "e.*")
    return lines.groupBy("doc", "place").agg(*[F.first(c).alias(c) for c in ("line", "forward", "backward")])


def first_ranks(lines: DataFrame) -> DataFrame:
    """(doc, place, rank) of lines that occur twice or more: suffixes ranked by one line."""
    repeated = lines.groupBy("line").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    bucket = F.call_function("shiftrightunsigned", F.col("line.h"), F.lit(64 - RANK_BITS))
    repeated = stage(repeated.withColumn("bucket", bucket), "repeated-lines")
    totals = repeated.groupBy("bucket").agg(F.sum("n").alias("total"))
    before = F.sum("total").over(Window.orderBy("bucket")) - F.col("total")  # at most 2**RANK_BITS rows
    starts = totals.select("bucket", before.alias("start"))
    inside = F.sum("n").over(Window.partitionBy("bucket").orderBy("line")) - F.col("n")
    ranks = repeated.withColumn("inside", inside).join(F.broadcast(starts), "bucket")
    ranked = ranks.select("line", (F.col("start") + F.col("inside")).alias("rank"))
    return lines.select("doc", "place", "line").join(ranked, "line").select("doc", "place", "rank")


def doubled(ranks: DataFrame, reach: int) -> DataFrame:
    """Ranks by twice ``reach`` lines, of the suffixes that still have equals."""
    further = ranks.select("doc", (F.col("place") - reach).alias("place"), F.col("rank").alias("next"))
    pairs = ranks.join(further, ["doc", "place"])
    counted = pairs.groupBy("rank", "next").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    inside = F.sum("n").over(Window.partitionBy("rank").orderBy("next")) - F.col("n")
    renamed = counted.select("rank", "next", (F.col("rank") + inside).alias("new"))
    return pairs.join(renamed, ["rank", "next"]).select("doc", "place", F.col("new").alias("rank"))


def later_runs(runs: DataFrame, ranks: DataFrame, reach: int) -> DataFrame:
    """The runs (doc, start, length) of ``reach`` to 2 * ``reach`` - 1 lines with an earlier equal."""
    at_end = F.col("start") + F.col("length") - reach
    here = runs.where((F.col("length") >= reach) & (F.col("length") < 2 * reach))
    named = (
        here.join(ranks.select("doc", F.col("place").alias("start"), F.col("rank").alias("head")), ["doc", "start"])
        .withColumn("place", at_end)
        .join(ranks.select("doc", "place", F.col("rank").alias("tail")), ["doc", "place"])
        .drop("place")
    )
    interval = ["length", "head", "tail"]
    firsts = named.groupBy(*interval).agg(F.min(F.struct("doc", "start")).alias("first"), F.count(F.lit(1)).alias("n"))
    found = named.join(firsts.where("n > 1"), interval)
    same = F.col("first.doc") == F.col("doc")
    later = ~same | (F.col("first.start") + F.col("length") <= F.col("start"))
    return found.where(later).select("doc", "start", "length")


def repeated_runs(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, start, length): later copies of runs; their union is what goes."""
    forward = lines.where("forward is not null").select("doc", F.col("place").alias("start"), F.col("forward").alias("length"))
    backward = lines.where("backward is not null").select(
        "doc", (F.col("place") - F.col("backward") + 1).alias("start"), F.col("backward").alias("length")
    )
    ranks = stage(first_ranks(lines), "ranks")
    heads = ranks.select("doc", F.col("place").alias("start"))
    runs = stage(forward.unionByName(backward).distinct().join(heads, ["doc", "start"], "left_semi"), "runs")
    found, reach = None, 1
    while True:
        level = stage(later_runs(runs, ranks, reach), "later-runs")
        found = level if found is None else found.unionByName(level)
        if 2 * reach > min_words:
            return found
        ranks = stage(doubled(ranks, reach), "ranks")
        reach *= 2


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, copy, n_lines, n_deleted, deleted_lines, text): a row for each row of ``docs``.

    ``copy`` counts equal rows from 1; ``deleted_lines`` are line numbers from 0.
    """
    lines = stage(line_table(docs, key, text, min_words), "lines")
    runs = repeated_runs(lines, min_words)
    deleted = (
        runs.select("doc", F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("place"))
        .groupBy("doc")
        .agg(F.sort_array(F.collect_set("place")).alias("places"))
    )
    doc = F.struct(F.col(key).alias("id"), F.xxhash64(F.col(text)).alias("digest"))
    rows = docs.groupBy(doc.alias("doc")).agg(F.first(text).alias("text"), F.count(F.lit(1)).alias("n"))
    numbers = F.filter(
        F.transform("lines", lambda x, i: F.when(F.rlike(x, F.lit(HAS_WORD)), i)), lambda i: i.isNotNull()
    )
    enough = F.size(words_by_space(F.col("text"))) >= min_words
    of_copy = F.when(
        F.col("copy") == 1, F.transform(F.coalesce("places", F.array().cast("array<int>")), lambda p: F.get("numbers", p))
    ).when(enough, F.col("numbers")).otherwise(F.array().cast("array<int>"))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("deleted_lines"))
    return (
        rows.join(deleted, "doc", "left")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
        .withColumn("lines", F.split(F.coalesce("text", F.lit("")), "\n"))
        .withColumn("numbers", numbers)
        .withColumn("deleted_lines", of_copy)
        .select(
            F.col("doc.id").alias("doc_id"),
            "copy",
            F.when(F.col("text").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"),
            F.size("deleted_lines").cast("long").alias("n_deleted"),
            "deleted_lines",
            F.when(F.col("text").isNotNull(), F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n")).alias("text"),
        )
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What went from every document, and what is left of it."""
    found = dedup_lines(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_lines", "n_deleted", F.array_join(F.transform("deleted_lines", lambda i: i.cast("string")), ",").alias("deleted_lines"),
        "text", F.sha2("text", 256).alias("text_sha256"),
    )


#: The shortest runs of 50 words from and up to each line, compared by their text.
OP10_SQL = r"""
with docs as (select row_number() over (order by doc_id nulls first, text) r, doc_id, text, string_split(coalesce(text, ''), chr(10)) ls from documents),
numbered as (select r, unnest(range(len(ls))) no, unnest(ls) line from docs),
wordy as (
    select r, no, line, row_number() over (partition by r order by no) - 1 place,
        len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) words
    from numbered where regexp_matches(line, '[^\x20\x09-\x0D]')),
summed as (select *, sum(words) over (partition by r order by place) upto from wordy),
runs as (
    select a.r, a.place low, min(b.place) high from summed a join summed b
        on a.r = b.r and b.place between a.place and a.place + 49 and b.upto - a.upto + a.words >= 50 group by all
    union
    select b.r, max(a.place), b.place from summed a join summed b
        on a.r = b.r and a.place between b.place - 49 and b.place and b.upto - a.upto + a.words >= 50 group by all),
told as (
    select u.r, low, high, string_agg(line, chr(10) order by place) said
    from runs u join wordy w on u.r = w.r and w.place between u.low and u.high group by all),
firsts as (select said, min({'r': r, 'low': low}) f from told group by said),
later as (
    select t.r, low, high from told t join firsts using (said)
    where f.r < t.r or f.r = t.r and f.low + (high - low + 1) <= low),
gone as (select distinct w.r, w.no from later l join wordy w on w.r = l.r and w.place between l.low and l.high),
listed as (select r, count(*) n, string_agg(no::varchar, ',' order by no) nos from gone group by r),
left_over as (
    select n.r, string_agg(n.line, chr(10) order by n.no) said
    from numbered n left join gone g on n.r = g.r and n.no = g.no where g.r is null group by n.r)
select doc_id, case when text is null then 0 else len(ls) end::bigint as n_lines, coalesce(l.n, 0)::bigint as n_deleted,
    coalesce(l.nos, '') as deleted_lines,
    case when text is not null then coalesce(o.said, '') end as text,
    sha256(case when text is not null then coalesce(o.said, '') end) as text_sha256
from docs d left join listed l using (r) left join left_over o using (r)
"""
