r"""Benchmark decontamination with a positional inverted index.

The index stores, for every term in use and every document, the term's positions. Test
texts are cut into windows; each window asks for its rarest terms (by their number of
occurrences in all documents), and the terms' posting lists are intersected after taking
each term's offset from its positions. What is left is compared word for word. Besides
exact phrases the index answers proximity: rarest terms close together, in any order.

The passes over the documents are two scans that look words up in a table of terms: one
counts, one stores postings. Their results, not texts, are shuffled. Term tables grow with
the benchmark and are broadcast only when a count proves them small, else the words are
shuffled to them. Texts of candidate documents alone are read again for the comparison.

A word that fills documents gets long lists only if a window has no rarer ones; lists are
kept by (term, document), so no task holds a term's whole list.

Defined cases: null or wordless texts have no words, hits or items; equal rows get equal
results, one each; without a near match the least span is 0; a null doc_id is an id like any other; a null item_id is an item with
an empty name; equal items count once; an empty benchmark hits nothing; extra columns of
either table are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartloom.llm.common import BROADCAST_ROWS, LOWER, UPPER, ascii_lower, bounded_broadcast, stage, table

# Fixed values
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW_WORDS = 13
HIT_SHARE = 20  # contaminated: at least one word in so many is hit

RAREST = 3  # lists that a window intersects
SLACK = 7  # words that a near match may be longer than its window
BROADCAST_BYTES = 64 << 20  # of tables with terms, phrases or lists
LENGTH_TERM = "\u0001"  # no word; its one position in a document is the number of words


def words(text: Column) -> Column:
    """Lower-cased runs of digits, letters and characters beyond ASCII; none for null."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BREAKS), "")


def keyed_words(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, words): equal rows share the key, rows that differ have different ones."""
    return docs.select(
        F.struct(F.col(key).alias("id"), F.xxhash64(F.col(text)).alias("digest")).alias("doc"),
        words(F.col(text)).alias("words"),
    )


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n): occurrences of the given terms; each task adds up its own first."""
    spoken = docs.select(F.explode("words").alias("term"))
    return spoken.join(bounded_broadcast(terms, BROADCAST_ROWS, BROADCAST_BYTES), "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, doc, positions) for the given terms, and each document's length under LENGTH_TERM.

    A document that occurs n times has n entries under LENGTH_TERM.
    """
    wanted = terms.unionByName(terms.sparkSession.createDataFrame([(LENGTH_TERM,)], "term string"))
    ended = docs.select("doc", F.posexplode(F.concat("words", F.array(F.lit(LENGTH_TERM)))).alias("position", "term"))
    postings = ended.join(bounded_broadcast(wanted, BROADCAST_ROWS, BROADCAST_BYTES), "term", "left_semi")
    return postings.groupBy("term", "doc").agg(F.sort_array(F.collect_list("position")).alias("positions"))


def item_windows(items: DataFrame, counts: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """(item, item_id, start, length, phrase, anchors) of all windows whose words all occur.

    ``items`` has (item, item_id, words). ``anchors`` are the rarest places of a window,
    rarest first: structs of n, term and offset in the item.
    """
    places = items.select("item", "item_id", F.size("words").alias("total"), F.posexplode("words").alias("offset", "term"))
    counted = places.join(counts, "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    ahead = Window.partitionBy("item").orderBy("offset").rowsBetween(0, size - 1)
    framed = counted.withColumn("frame", F.collect_list(F.struct("n", "term", "offset")).over(ahead))
    length = F.least(F.col("total"), F.lit(size))
    return (
        framed.where(F.col("offset") <= F.col("total") - length)
        .select(
            "item",
            "item_id",
            F.col("offset").alias("start"),
            length.alias("length"),
            F.col("frame.term").alias("phrase"),
            F.slice(F.sort_array("frame"), 1, RAREST).alias("anchors"),
        )
        .where(F.col("anchors")[0]["n"] > 0)
        # One window for each phrase of an item: repeats inside it would only find the same places.
        .withColumn("place", F.row_number().over(Window.partitionBy("item", "phrase").orderBy("start")))
        .where("place = 1")
        .drop("place")
    )


def candidate_windows(index: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc, item, start, at): places where all anchors of a window stand as in the window."""
    anchors = windows.select("item", F.explode("anchors").alias("a")).select("item", "a.term", "a.offset").distinct()
    adjusted = index.join(bounded_broadcast(anchors, 200_000, BROADCAST_BYTES), "term").select(
        "doc", "item", "offset", F.explode(F.array_distinct("positions")).alias("position")
    )
    lists = adjusted.groupBy("doc", "item", (F.col("position") - F.col("offset")).alias("shift")).agg(
        F.collect_set("offset").alias("offsets")
    )
    asked = windows.select(
        "item", "start", F.col("anchors.offset").alias("needed"), F.col("anchors")[0]["offset"].alias("rarest")
    )
    return (
        lists.withColumn("rarest", F.explode("offsets"))
        .join(bounded_broadcast(asked, 200_000, BROADCAST_BYTES), ["item", "rarest"])
        .where(F.size(F.array_except("needed", "offsets")) == 0)
        .select("doc", "item", "start", (F.col("shift") + F.col("start")).alias("at"))
        .where("at >= 0")
    )


def exact_hits(candidates: DataFrame, docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc, item, item_id, start, low, high): candidates whose words are the window's, [low, high)."""
    asked = candidates.join(
        bounded_broadcast(windows.select("item", "start", "length"), 200_000), ["item", "start"]
    )
    by_doc = stage(
        asked.groupBy("doc").agg(F.collect_list(F.struct("item", "start", "at", "length")).alias("asked")), "asked"
    )
    texts = docs.join(bounded_broadcast(by_doc.select("doc"), 500_000, BROADCAST_BYTES), "doc", "left_semi")

    def seen(ask: Column) -> Column:
        spoken = F.slice(F.col("words"), ask["at"] + 1, ask["length"])
        return F.struct(ask["item"].alias("item"), ask["start"].alias("start"), ask["at"].alias("low"), spoken.alias("phrase"))

    found = texts.join(by_doc, "doc").select("doc", F.explode(F.transform("asked", seen)).alias("w")).select("doc", "w.*")
    truth = bounded_broadcast(
        windows.select("item", "item_id", "start", "length", "phrase"), 200_000, BROADCAST_BYTES
    )
    return found.join(truth, ["item", "start", "phrase"]).select(
        "doc", "item", "item_id", "start", "low", (F.col("low") + F.col("length")).alias("high")
    )


def near_matches(index: DataFrame, windows: DataFrame, slack: int = SLACK) -> DataFrame:
    """(doc, item, item_id, span): documents with all rarest terms of one of an item's windows close by.

    ``span`` is the fewest words that hold all of them, in any order, at most the window's
    length plus ``slack``, over all windows of the item; windows with the same terms are one.
    Lists are brought together by document and terms; where all terms are there, a pass over
    their places, in order, keeps the last place of each term.
    """
    sets = windows.select(
        "item", "item_id", "length", F.array_sort(F.array_distinct("anchors.term")).alias("terms")
    ).distinct()
    asked = sets.select(F.explode("terms").alias("term"), "terms").distinct()
    met = (
        index.join(bounded_broadcast(asked, 200_000, BROADCAST_BYTES), "term")
        .groupBy("doc", "terms")
        .agg(F.collect_list(F.struct("term", "positions")).alias("lists"))
        .where(F.size("lists") == F.size("terms"))
    )

    def placed(one: Column) -> Column:
        slot = F.array_position(F.col("terms"), one["term"]).cast("int") - 1
        return F.transform(
            F.array_distinct(one["positions"]), lambda p: F.struct(p.alias("position"), slot.alias("slot"))
        )

    def step(state: Column, place: Column) -> Column:
        lasts = [
            F.when(place["slot"] == slot, place["position"]).otherwise(state[f"last{slot}"]).alias(f"last{slot}")
            for slot in range(RAREST)
        ]
        # A window of fewer terms has no last place in the later slots.
        in_use = [F.when(F.lit(slot) >= F.size("terms"), place["position"]).otherwise(last) for slot, last in enumerate(lasts)]
        complete = F.least(*[F.coalesce(last, F.lit(-1)) for last in in_use]) >= 0
        span = F.when(complete, place["position"] - F.least(*in_use) + 1)
        return F.struct(*lasts, F.least(state["span"], span).alias("span"))

    nothing = F.struct(*[F.lit(None).cast("int").alias(c) for c in [*(f"last{i}" for i in range(RAREST)), "span"]])
    spans = met.select(
        "doc",
        "terms",
        F.aggregate(
            F.array_sort(F.flatten(F.transform("lists", placed))), nothing, step, lambda state: state["span"]
        ).alias("span"),
    )
    return (
        spans.join(bounded_broadcast(sets, 200_000, BROADCAST_BYTES), "terms")
        .where(F.col("span") <= F.col("length") + slack)
        .groupBy("doc", "item", "item_id")
        .agg(F.min("span").alias("span"))
    )


def prepare(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS) -> tuple[DataFrame, DataFrame]:
    """The stored index over ``docs`` (doc, words) and the windows of the benchmark."""
    items = stage(
        benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words(F.col("text")).alias("words"))
        .distinct()
        .where(F.size("words") > 0)
        .withColumn("item", F.monotonically_increasing_id()),
        "items",
    )
    terms = items.select(F.explode("words").alias("term")).distinct()
    counts = stage(term_counts(docs, terms), "term-counts")
    windows = stage(item_windows(items, counts, size), "windows")
    anchors = windows.select(F.explode("anchors.term").alias("term")).distinct()
    return stage(build_index(docs, anchors), "positional-index"), windows


def contamination(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc, n_rows, n_words, n_hit, items, n_near_items, least_span): for each different row, its hits, the items
    hit, the number of items (by id) with near matches, and the fewest words that hold one (0: none)."""
    texts = keyed_words(docs, key, text)
    index, windows = prepare(texts, benchmark)
    hits = exact_hits(candidate_windows(index, windows), texts, windows)
    # Hit words: each interval adds what reaches beyond the intervals that began before it.
    before = Window.partitionBy("doc").orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("high").over(before), F.lit(0))
    counted = (
        hits.select("doc", "item_id", "low", "high")
        .withColumn("fresh", F.greatest(F.col("high") - F.greatest("low", reached), F.lit(0)))
        .groupBy("doc")
        .agg(F.sum("fresh").alias("n_hit"), F.sort_array(F.collect_set("item_id")).alias("items"))
    )
    lengths = index.where(F.col("term") == LENGTH_TERM).select(
        "doc", F.size("positions").alias("n_rows"), F.col("positions")[0].cast("long").alias("n_words")
    )
    near = (
        near_matches(index, windows)
        .groupBy("doc")
        .agg(F.count_distinct("item_id").alias("n_near_items"), F.min("span").cast("long").alias("least_span"))
    )
    return lengths.join(counted, "doc", "left").join(near, "doc", "left").select(
        "doc",
        "n_rows",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("n_near_items", F.lit(0)).cast("long").alias("n_near_items"),
        F.coalesce("least_span", F.lit(0)).alias("least_span"),
    )


def is_contaminated() -> Column:
    return (F.col("n_hit") > 0) & (HIT_SHARE * F.col("n_hit") >= F.col("n_words"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and items of every document, against the whole benchmark."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("doc.id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
        "n_near_items",
        "least_span",
        F.explode(F.sequence(F.lit(1), F.col("n_rows"))).alias("row"),
    ).drop("row")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the contaminated rows; all columns, equal rows alike."""
    bad = stage(contamination(docs, benchmark, key, text).where(is_contaminated()).select("doc"), "contaminated")
    marked = docs.withColumn(
        "__doc", F.struct(F.col(key).alias("id"), F.xxhash64(F.col(text)).alias("digest"))
    )
    bad = bounded_broadcast(bad.withColumnRenamed("doc", "__doc"), BROADCAST_ROWS, BROADCAST_BYTES)
    return marked.join(bad, "__doc", "left_anti").drop("__doc")


#: Every window of every document against every window of every item, by their words; near matches by the places of
#: each window's rarest terms in every document.
OP8_SQL = rf"""
with docs as (
    select row_number() over () r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws
    from documents),
items as (
    select coalesce(item_id::varchar, '') item_id,
        regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws
    from benchmark),
starts as (
    select item_id, ws, least(13, len(ws)) w, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) s
    from items where len(ws) > 0),
wins as (select distinct item_id, w, array_to_string(ws[s : s + w - 1], ' ') p from starts),
spoken as (
    select r, ws, w, unnest(range(1, len(ws) - w + 2)) s
    from docs, (select distinct w from wins) where len(ws) >= w),
hits as (
    select distinct r, item_id, s, w
    from (select r, w, s, array_to_string(ws[s : s + w - 1], ' ') p from spoken) join wins using (w, p)),
covered as (select r, count(distinct i) n from (select r, unnest(range(s, s + w)) i from hits) group by r),
named as (
    select r, count(*) n, sha256(string_agg(item_id, ',' order by item_id)) h
    from (select distinct r, item_id from hits) group by r),
placed as (select r, unnest(ws) term, unnest(range(0, len(ws))) p from docs),
counted as (select term, count(*) n from placed group by term),
places as (
    select item, item_id, unnest(ws) term, unnest(range(0, len(ws))) place, len(ws) total
    from (select row_number() over () item, item_id, ws from (select distinct item_id, ws from items))),
frames as (
    select item_id, place, total, least(total, {WINDOW_WORDS}) length,
        list({{'n': coalesce(n, 0), 'term': term, 'place': place}}) over (
            partition by item order by place rows between current row and {WINDOW_WORDS - 1} following) frame
    from places left join counted using (term)),
sets as (
    select distinct item_id, length, list_sort(list_distinct(list_transform(rarest, lambda a: a.term))) terms
    from (select *, list_sort(frame)[1:{RAREST}] rarest from frames where place <= total - length)
    where rarest[1].n > 0),
met as (
    select r, item_id, length, terms, p, list_position(terms, term) slot
    from (select *, unnest(terms) term from sets) join placed using (term)),
lasts as (
    select *, max(case when slot = 1 then p end) over so_far a,
        case when len(terms) < 2 then p else max(case when slot = 2 then p end) over so_far end b,
        case when len(terms) < 3 then p else max(case when slot = 3 then p end) over so_far end c
    from met window so_far as (partition by r, item_id, length, terms order by p, slot rows unbounded preceding)),
near as (
    select r, count(distinct item_id) n, min(p - least(a, b, c) + 1) span
    from lasts
    where a is not null and b is not null and c is not null and p - least(a, b, c) + 1 <= length + {SLACK} group by r)
select doc_id, len(ws)::bigint as n_words, coalesce(c.n, 0)::bigint as n_hit, coalesce(i.n, 0)::bigint as n_items,
    coalesce(i.h, sha256('')) as items_sha256,
    coalesce(c.n, 0) > 0 and 20 * coalesce(c.n, 0) >= len(ws) as contaminated,
    coalesce(m.n, 0)::bigint as n_near_items, coalesce(m.span, 0)::bigint as least_span
from docs d left join covered c using (r) left join named i using (r) left join near m using (r)
"""
