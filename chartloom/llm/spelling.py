"""Spelling variants: words one edit apart, found by an index of grams of variable length.

1. Words are counted, by text first, then over all texts.
2. The gram dictionary: all grams of two characters (of words with marks at both ends), and the
   extensions, up to five characters, of those grams that more than a set number of words have. That number grows
   with the vocabulary, so that the extended grams never exceed ``DICTIONARY_GRAMS``: they
   travel to the tasks, which is all that does.
3. A word is decomposed into the longest gram of the dictionary from each place. What such a gram is
   depends on its own characters only, so an edit touches just the grams that cover its place. The
   largest number that cover one place is the word's bound: two words one edit apart share all but so many of
   the grams of either.
4. So they share one of each other's rarest bound + 1 grams. Only these lists are merged, by
   length (equal, or one more), and each pair that meets is verified by its edit distance.
5. Each word's form is its most frequent near word if that is frequent enough; forms of forms are
   followed by doubling steps to the root.

Joins on grams take both sides from staged tables, so that lists of frequent grams are split.

Defined cases: null and empty texts have no words; a null id is hashed as an empty one; rows of one id
are texts of their own; repeated rows count as often as they occur; a word without a near word has
no form and is its own root; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.llm.common import stage, table

# Fixed values
WORD = re.compile("[A-Za-zÀ-ÿ]+")
LEAST_LENGTH, LEAST_COUNT, FORM_TIMES = 6, 5, 5
PLANTED_EVERY = 199

SHORTEST, LONGEST = 2, 5  # grams
BEGIN, END = "<", ">"  # around a word
LIST_WORDS = 50  # a gram of more places is extended
DICTIONARY_GRAMS = 200_000  # extended grams at most
HELD_WORDS = 200_000  # counted in a task before they are handed on


def _count_rows(batches: Iterator[pa.RecordBatch], least_length: int, change: Callable | None) -> Iterator[pa.RecordBatch]:
    held: Counter[str] = Counter()

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"]
        )

    for batch in batches:
        for doc, data in zip(batch.column("doc"), batch.column("data")):
            words = Counter(WORD.findall(data.as_py().lower().decode()))
            doc = doc.as_py()
            for word, n in words.items():
                if change is not None:
                    word = change(doc, word)
                if len(word) >= least_length:
                    held[word] += n
            if len(held) > HELD_WORDS:
                yield rows()
                held.clear()
    yield rows()


def word_counts(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    change: Callable[[object, str], str] | None = None,
) -> DataFrame:
    """(word, n) of the words that are long and frequent enough; ``change`` may alter a text's words by its key."""
    given = docs.select(F.col(key).alias("doc"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("data"))
    rows = given.mapInArrow(lambda batches: _count_rows(batches, least_length, change), "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def extended_grams(words: DataFrame, list_words: int = LIST_WORDS) -> set[str]:
    """The grams, short of the longest, that so many words have that the dictionary extends them."""
    marked = F.concat(F.lit(BEGIN), "word", F.lit(END))
    places = words.select(marked.alias("s"), F.explode(F.sequence(F.lit(1), F.length("word") + 1)).alias("at"))
    lengths = F.array(*[F.lit(n) for n in range(SHORTEST, LONGEST)])
    grams = places.select("s", "at", F.explode(lengths).alias("n")).where("at + n - 1 <= length(s)")
    total = words.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    # Every place counts once for each length, so no more grams than this can pass.
    least = max(list_words, -(-total * (LONGEST - SHORTEST) // DICTIONARY_GRAMS))
    counted = grams.groupBy(F.expr("substr(s, at, n)").alias("gram")).agg(F.count(F.lit(1)).alias("n"))
    return {row["gram"] for row in counted.where(F.col("n") > least).select("gram").collect()}


def decomposed(word: str, extended: set[str]) -> tuple[list[str], int]:
    """(grams, bound): the longest gram of the dictionary from each place, and how many one edit touches at most.

    A gram that a word has again is numbered, so that the grams are a set.
    """
    s = BEGIN + word + END
    cover, seen, grams = [0] * len(s), {}, []
    for at in range(len(s) - 1):
        n = SHORTEST
        while n < LONGEST and at + n < len(s) and s[at : at + n] in extended:
            n += 1
        gram = s[at : at + n]
        seen[gram] = again = seen.get(gram, -1) + 1
        grams.append(f"{gram}{again}" if again else gram)
        for i in range(at, at + n):
            cover[i] += 1
    return grams, max(cover[1:-1])


def _gram_rows(batches: Iterator[pa.RecordBatch], extended: set[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [decomposed(word, extended) for word in batch.column("word").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("word"), batch.column("n"), pa.array([g for g, _ in found], pa.list_(pa.string())),
             pa.array([b for _, b in found], pa.int32())],
            ["word", "n", "grams", "bound"],
        )


def near_words(words: DataFrame, list_words: int = LIST_WORDS) -> DataFrame:
    """(a, n_a, b, n_b): the pairs of words (word, n) one edit apart, each once."""
    # Executors get the grams as a broadcast, once each.
    sent = words.sparkSession.sparkContext.broadcast(extended_grams(words, list_words))
    grams = stage(
        words.mapInArrow(
            lambda batches: _gram_rows(batches, sent.value), "word string, n long, grams array<string>, bound int"
        ),
        "grams",
    )
    listed = grams.select("word", "n", "bound", F.explode("grams").alias("gram"))
    lengths = stage(listed.groupBy("gram").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "gram-lists")
    # A gram that no other word has counts against the bound but meets nobody.
    alone = F.size("grams") - F.size("lists")
    rarest = F.slice("lists", 1, F.greatest(F.col("bound") + 1 - alone, F.lit(0)))
    kept = stage(
        listed.join(lengths, "gram")
        .groupBy("word")
        .agg(F.sort_array(F.collect_list(F.struct("size", "gram"))).alias("lists"))
        .join(grams.select("word", "n", "bound", "grams"), "word")
        .select("word", "n", F.length("word").alias("len"), F.explode(rarest).alias("list"))
        .select("word", "n", "len", F.col("list.gram").alias("gram")),
        "rare-grams",
    )
    index = kept.select("gram", "len", F.col("word").alias("b"), F.col("n").alias("n_b"))
    asked = kept.select(
        "gram", F.col("word").alias("a"), F.col("n").alias("n_a"), F.col("len").alias("len_a"),
        F.explode(F.array("len", F.col("len") + 1)).alias("len"),
    )
    met = asked.join(index, ["gram", "len"]).where((F.col("len") > F.col("len_a")) | (F.col("a") < F.col("b")))
    return met.where(F.levenshtein("a", "b", 1) == 1).select("a", "n_a", "b", "n_b").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words with a form: each round doubles the steps that are taken."""
    steps = stage(forms, "forms")
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = stage(
            steps.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "roots",
        )
        steps = longer.select("word", "root")
        if longer.where("moved").isEmpty():
            return steps


def spelling_variants(words: DataFrame, times: int = FORM_TIMES, list_words: int = LIST_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n): one row for each word of ``words`` (word, n)."""
    words = stage(words, "words")
    pairs = stage(near_words(words, list_words), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("n_other")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("n_other"))
    )
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n_other")).alias("rank"), "other")).alias("best")
    )
    enough = -F.col("best.rank") >= times * F.col("n")
    formed = stage(
        words.join(best, "word", "left").select(
            "word", F.when(enough, F.col("best.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(enough, -F.col("best.rank")).alias("form_n"),
        ),
        "formed",
    )
    roots = _roots(formed.where("form is not null").select("word", F.col("form").alias("root")))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def misspelt(doc_id: object, word: str) -> str:
    """The word without one of its characters, for one in 199 words of a document."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
    if h % PLANTED_EVERY:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word with its most likely right spelling."""
    return spelling_variants(word_counts(table(spark, sf_dir, "documents"), change=misspelt))
