"""Line-first cleaning of documents.

Every line is judged by punctuation, navigation, symbol and boilerplate rules; lines that
fail go, lines without a word stay. A document is rejected when more than a third of its
words went, and also when its whole text fails the base tests: fewer than ten words, or
over a fifth of its words in five-word windows that occur twice or more in it.

Everything is one projection of built-in functions over the scan: no shuffle, no state
across rows, so skew of any column has no effect. Repeated windows are found by sorting the
windows' hashes inside the row, only for texts in which one occurs twice.

Defined cases: null text is a text without words (base test failed, not kept, cleaned text
null); an empty text likewise, cleaned text empty; equal rows get equal results; an empty
table gives an empty result; input columns named like the added ones, in any case, are replaced.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.llm.common import every, table, words_by_space

# Fixed values
SYMBOLS = r"[#*$%&|<>]"
HAS_WORD = r"[^\x20\x09-\x0D]"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20

# Rules of this method
MAX_LOST_PERCENT = 33  # of a document's words
SHORT_LINE_WORDS = 4  # a line up to this long with no sentence end looks like navigation
MAX_SYMBOL_PERCENT = 5  # of a line's characters
LINE_END = 12  # characters in which a sentence end and closing marks are looked for first
ENDS_SENTENCE = r"[.!?:;…。！？][\"'’”»)\]\s]*$"
MENU_MARK = r"[|»›>•·]"
MENU_MARKS = r"(^|\s)[|»›>•·](\s|$)"
BOILERPLATE = (
    r"(?i)(all rights reserved|terms (of (use|service)|and conditions)|privacy policy|cookie|"
    r"javascript|lorem ipsum|subscribe to|sign (in|up)\b|log ?in\b|click here|read more|share (this|on)|"
    r"©|\(c\) ?(19|20)\d\d|licensed under|released under|copyright|general public license|"
    r"powered by|skip to (main )?content)"
)
#: Lower-case texts of which every match of BOILERPLATE has one.
BOILERPLATE_SIGNS = (
    "all rights reserved", "terms of ", "terms and conditions", "privacy policy", "cookie", "javascript",
    "lorem ipsum", "subscribe to", "sign in", "sign up", "login", "log in", "click here", "read more", "share this",
    "share on", "©", "(c)", "licensed under", "released under", "copyright", "general public license", "powered by",
    "skip to ",
)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), 0)


def repeated_windows_words(words: Column) -> Column:
    """Words that lie in a five-word window found twice or more in the same text.

    Hashes are sorted together with their places, so repeated windows are neighbours with equal
    hashes of 64 bits at any length. Each such window covers the words up to the next one, at most five.
    """
    count = F.size(words) - (WINDOW - 1)

    def window_hash(i: Column) -> Column:
        return F.xxhash64(*[F.get(words, i + step) for step in range(WINDOW)])

    def repeats(keys: Column) -> Column:
        def agrees(key: Column, other: Column) -> Column:
            return F.coalesce(key["hash"] == other["hash"], F.lit(False))

        twice = F.filter(
            keys, lambda key, i: agrees(key, F.get(keys, i + 1)) | ((i > 0) & agrees(key, F.get(keys, i - 1)))
        )
        return F.sort_array(F.transform(twice, lambda key: key["place"]))

    def covered(begins: Column) -> Column:
        return F.aggregate(
            begins,
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).cast("long").alias("last")),
            lambda seen, at: F.struct(
                (seen["n"] + F.least(at - seen["last"], F.lit(WINDOW).cast("long"))).alias("n"), at.alias("last")
            ),
            lambda seen: seen["n"],
        )

    def of(hashes: Column) -> Column:
        keys = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("hash"), i.cast("long").alias("place"))))
        once = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(once, F.lit(0).cast("long")).otherwise(bound(keys, lambda k: covered(repeats(k))))

    windows = F.transform(F.sequence(F.lit(0), count - 1), window_hash)
    return F.when(F.size(words) <= WINDOW, F.lit(0).cast("long")).otherwise(bound(windows, of))


def line_fails(line: Column) -> Column:
    """True for a line with words that breaks one of the rules.

    Cheap tests come first: a sentence end near the line's end, signs of menus and boilerplate.
    What they leave open is decided on the whole line.
    """
    n_words = F.size(F.split(F.btrim(line), r"\s+"))
    symbols = F.length(line) - F.length(F.regexp_replace(line, SYMBOLS + "+", ""))
    bare_end = ~F.rlike(F.substring(line, -LINE_END, LINE_END), F.lit(ENDS_SENTENCE))
    bare = ~F.rlike(line, F.lit(ENDS_SENTENCE))
    signs = bound(F.lower(line), lambda low: reduce(or_, [F.contains(low, F.lit(sign)) for sign in BOILERPLATE_SIGNS]))
    return F.rlike(line, F.lit(HAS_WORD)) & (
        (bare_end & (n_words <= SHORT_LINE_WORDS) & bare)
        | (symbols * 100 > F.length(line) * MAX_SYMBOL_PERCENT)
        | (F.rlike(line, F.lit(MENU_MARK)) & F.rlike(line, F.lit(MENU_MARKS)))
        | (signs & F.rlike(line, F.lit(BOILERPLATE)))
    )


def clean_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with counts, the cleaned text and the verdict of the line rules.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    n_lines, n_bad_lines, n_lost_words, cleaned_text and kept.
    """
    added = (
        "words lines judged n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed"
        " n_lines n_bad_lines n_lost_words cleaned_text kept"
    ).split()
    docs = docs.select(*every([c for c in docs.columns if c.lower() not in added]))
    names = every(docs.columns)
    content = F.coalesce(F.col(text), F.lit(""))
    wordy = F.filter(F.col("lines"), lambda line: F.rlike(line, F.lit(HAS_WORD)))
    bad = F.filter(F.col("judged"), lambda j: j["bad"])
    lost = F.array_join(F.transform(bad, lambda j: j["line"]), "\n")
    left = F.transform(F.filter(F.col("judged"), lambda j: ~j["bad"]), lambda j: j["line"])
    counted = (
        docs.withColumn("words", words_by_space(F.col(text)))
        .withColumn("lines", F.split(content, "\n"))
        .withColumn("judged", F.transform("lines", lambda line: F.struct(line.alias("line"), line_fails(line).alias("bad"))))
        .select(
            *names,
            F.size("words").cast("long").alias("n_words"),
            F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
            (F.length(content) - F.length(F.regexp_replace(content, SYMBOLS + "+", ""))).cast("long").alias("n_symbols"),
            (F.size(wordy) - F.size(F.array_distinct(wordy))).cast("long").alias("n_dup_lines"),
            repeated_windows_words(F.col("words")).cast("long").alias("n_repeat_words"),
            F.size("lines").cast("long").alias("n_lines"),
            F.size(bad).cast("long").alias("n_bad_lines"),
            F.size(words_by_space(lost)).cast("long").alias("n_lost_words"),
            F.when(F.col(text).isNotNull(), F.array_join(left, "\n")).alias("cleaned_text"),
        )
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    kept = ~F.col("base_failed") & (100 * F.col("n_lost_words") <= MAX_LOST_PERCENT * F.col("n_words"))
    return counted.withColumn("base_failed", failed).withColumn("kept", kept)


def op5_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts for every document."""
    cleaned = clean_lines(table(spark, sf_dir, "documents"))
    return cleaned.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_bad_lines", "n_lost_words", F.length("cleaned_text").cast("long").alias("cleaned_chars"),
    )


_BOILERPLATE_SQL = BOILERPLATE.replace(r"©", "©").replace("'", "''")
#: Windows are grouped by their words here; rules and counts are written out in DuckDB's terms.
OP5_SQL = rf"""
with numbered as (select row_number() over () as r, doc_id, text, coalesce(text, '') as body from documents),
worded as (
    select *, regexp_extract_all(body, '[^\x20\x09-\x0D]+') ws, string_split(body, chr(10)) ls from numbered),
windows as (
    select r, i, array_to_string(ws[i : i + 4], ' ') win
    from (select r, ws, unnest(range(1, len(ws) - 3)) i from worded where len(ws) >= 5)),
twice as (select r, i from (select r, i, count(*) over (partition by r, win) n from windows) where n > 1),
covered as (
    select r, count(distinct spot) n
    from (select r, unnest(range(i, i + 5)) spot from twice) group by r),
judged as (
    select *, list_filter(ls, lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) wordy,
        list_transform(ls, lambda l: regexp_matches(l, '[^\x20\x09-\x0D]') and (
            (not regexp_matches(l, '[.!?:;\x{{2026}}\x{{3002}}\x{{FF01}}\x{{FF1F}}]["''\x{{2019}}\x{{201D}}\x{{00BB}})\]\s]*$')
                and len(regexp_extract_all(trim(l), '[^\x20\x09-\x0D]+')) <= {SHORT_LINE_WORDS})
            or (length(l) - length(regexp_replace(l, '[#*$%&|<>]', '', 'g'))) * 100 > length(l) * {MAX_SYMBOL_PERCENT}
            or regexp_matches(l, '(^|\s)[|\x{{00BB}}\x{{203A}}>\x{{2022}}\x{{00B7}}](\s|$)')
            or regexp_matches(l, '{_BOILERPLATE_SQL}'))) bad
    from worded),
counted as (
    select j.doc_id, len(ws)::bigint n_words, length(array_to_string(ws, ''))::bigint word_chars,
        (length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')))::bigint n_symbols,
        (len(wordy) - len(list_distinct(wordy)))::bigint n_dup_lines,
        coalesce(c.n, 0)::bigint n_repeat_words,
        len(list_filter(bad, lambda b: b))::bigint n_bad_lines,
        len(regexp_extract_all(array_to_string(list_transform(list_filter(list_zip(ls, bad), lambda z: z[2]), lambda z: z[1]), chr(10)), '[^\x20\x09-\x0D]+'))::bigint n_lost_words,
        case when text is not null then
            length(array_to_string(list_transform(list_filter(list_zip(ls, bad), lambda z: not z[2]), lambda z: z[1]), chr(10))) end::bigint cleaned_chars
    from judged j left join covered c using (r)),
based as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from counted)
select *, not base_failed and 100 * n_lost_words <= {MAX_LOST_PERCENT} * n_words as kept from based
"""
