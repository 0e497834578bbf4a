"""Similarity join of documents on word n-grams: T-occurrence search with DivideSkip.

A document's set holds the hashes of its distinct shingles of ``width`` words; two documents
link when 100 * intersection >= percent * union: four words and 85 percent in op9, other
values where a caller gives them. Documents with equal sets are one class, named by the
least id, and only classes are compared.

1. The range of hashes is cut into parts, 1.25 for each member by which linked sets of a band of sizes can
   differ at most. A difference touches one part, so linked sets agree in the whole content of a fifth of the
   parts or more (``PartScheme``). A class with too few parts that another class has, too, has no link and
   leaves. Ordinary texts leave here at any size of the table, also where most of their shingles occur elsewhere:
   a part holds about four members, and all must be the same. So do texts that share a common line or passage.
2. The rarest parts of the rest, so many that linked classes must share one, tie classes to the
   least class with the same part. Components of these ties hold every link.
3. Inside a component (in blocks of bounded size, and pairs of blocks where it is larger)
   a T-occurrence search finds the links: a query's short inverted lists are merged by
   counting, its longest lists are only probed by binary search for documents whose count
   can still reach the threshold. Of all links a task returns a spanning forest.
4. Components of the forests are the result.

Parts travel once, as rows of two numbers, to be counted; a part that is frequent comes once for each class with
it, which is one row of many that a class has. A component beyond a block costs the square of its
blocks in comparisons; each pair of blocks is dealt out by itself, so they spread over all tasks, and a
task's memory and what it returns stay in proportion to a block.

Defined cases: null, empty and blank texts have an empty set and link with nothing; fewer
words than a shingle has are one; rows of one id are one document that links through any of
its rows; rows without id are in no component (null); extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, GroupedData, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom.llm.common import bounded_broadcast, every, stage, stage_for_now, table
from chartloom.llm.components import connected_components

# Fixed values of op9
SHINGLE_WORDS = 4
PERCENT = 85  # of the union

LISTED_MORE, LISTED_LEAST = 5, 64  # percent of a set's hashes that are listed beyond what it may lack, and how many at least
BLOCK_HASHES = 1_500_000  # set members that a task compares at a time
BANDS = 64  # bands of sizes at most, a power of two
LATER_ROWS = 4_000_000  # numbers of later rows of a class that are broadcast
LONG_LISTS = 0.1  # a query's lists that are probed, as a share of its threshold

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, width: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    width = min(width, len(words))
    mixed = np.full(len(words) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        mixed = mixed * _MULTIPLIER + hashes[i : len(hashes) - width + 1 + i]
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def threshold(n: np.ndarray | int, percent: int = PERCENT):
    """The overlap that a set of n needs with any set it links with."""
    return -(-percent * n // 100)


# The bound for single low hashes. Parts took their place in the join: most single hashes of a large table come again.


def _listed_share(percent: int) -> int:
    return 100 - percent + LISTED_MORE


def _listed(n: int, percent: int = PERCENT) -> int:
    return min(n, max(LISTED_LEAST, -(-_listed_share(percent) * n // 100)))


def _shared(n: int, percent: int = PERCENT) -> int:
    """Listed hashes that a set of n surely shares with a linked set that lists as many."""
    return _listed(n, percent) - (n - threshold(n, percent))


def needed(n: int, percent: int = PERCENT, _known: dict[tuple[int, int], int] = {}) -> int:  # noqa: B006
    """Listed hashes that a set of n shares with any linked set, whatever its size.

    Beyond the sizes where the least number listed matters, fewer hashes are shared by
    smaller sets, so the smallest partner decides.
    """
    if (n, percent) not in _known:
        smallest, largest = threshold(n, percent), 100 * n // percent
        flat = 100 * LISTED_LEAST // _listed_share(percent) + 20
        sizes = range(smallest, min(largest, max(flat, n)) + 1) if smallest <= flat else (smallest, smallest + 1, n)
        _known[n, percent] = min(_shared(m, percent) for m in sizes) - (2 if smallest > flat else 0)
    return max(1, _known[n, percent])


class PartScheme:
    """Parts of sets by bands of their sizes, for one percentage.

    Band i holds the sizes above ``tops[i - 1]`` up to ``tops[i]`` and cuts the range of hashes into ``parts[i]`` parts.
    A set is cut for its own band and for those of larger partners, so linked sets are cut alike for the band of the larger.
    Sets of n and m that link differ in at most (n + m) * (100 - percent) / (100 + percent) members.
    """

    def __init__(self, percent: int) -> None:
        self.percent = percent
        self.tops = [16]
        while self.tops[-1] < 2**40:
            self.tops.append(self.tops[-1] * 8 // 5)
        most = [self._apart(2 * top) for top in self.tops]
        self.parts = [k + k // 4 + 2 for k in most]
        self._bounds: dict[int, np.ndarray] = {}

    def _apart(self, both: int) -> int:
        return both * (100 - self.percent) // (100 + self.percent)

    def largest(self, n: int) -> int:
        """The largest set that one of n can link with."""
        return 100 * n // self.percent

    def bands(self, n: int) -> range:
        """The bands that a set of n is cut for; none if it links with no other set."""
        if not self._apart(n + self.largest(n)):
            return range(0)
        return range(bisect_left(self.tops, n), bisect_left(self.tops, self.largest(n)) + 1)

    def shared(self, n: int, band: int) -> int:
        """Parts that a set of n has in common with any set it links with in the band."""
        return self.parts[band] - self._apart(n + min(self.largest(n), self.tops[band]))

    def shared_column(self, n: Column, band: Column) -> Column:
        """``shared`` of columns of whole numbers."""
        of_band = lambda values: F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), (band + 1).cast("int"))
        largest = F.call_function("div", 100 * n, F.lit(self.percent))
        both = n + F.least(largest, of_band(self.tops))
        return of_band(self.parts) - F.call_function("div", both * (100 - self.percent), F.lit(100 + self.percent))

    def tokens(self, members: np.ndarray) -> np.ndarray:
        """A number for each part of a set: of its content and place, with the band in the low bits."""
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(members, dtype=np.uint64)))
        found = [np.empty(0, np.uint64)]
        for band in self.bands(len(members)):
            parts = self.parts[band]
            if band not in self._bounds:
                self._bounds[band] = np.array([-(-(i << 64) // parts) for i in range(1, parts)], dtype=np.uint64)
            ends = np.concatenate(([0], np.searchsorted(members, self._bounds[band]), [len(members)]))
            token = np.diff(sums[ends]) + np.arange(1, parts + 1, dtype=np.uint64) * _MULTIPLIER
            token ^= token >> np.uint64(32)
            token *= np.uint64(0xD6E8FEB86659FD93)
            token ^= token >> np.uint64(32)
            found.append(token & ~np.uint64(BANDS - 1) | np.uint64(band))
        return np.concatenate(found)


def _set_rows(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    scheme = PartScheme(percent)
    for batch in batches:
        sets = [shingles(text, width) for text in batch.column("text").to_pylist()]
        marks = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
        halves = np.frombuffer(b"".join(marks), dtype=np.int64).reshape(-1, 2)
        tokens = [scheme.tokens(s).view(np.int64) for s in sets]
        ends = np.concatenate(([0], np.cumsum([len(x) for x in tokens]))).astype(np.int32)
        listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *tokens])))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(halves[:, 0]),
                pa.array(halves[:, 1]),
                listed,
            ],
            names=["doc_id", "n", "d1", "d2", "tokens"],
        )


def document_sets(docs: DataFrame, width: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n, d1, d2, tokens): size, identity and parts of every set."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(
        lambda batches: _set_rows(batches, width, percent),
        "doc_id long, n long, d1 long, d2 long, tokens array<long>",
    )


def candidate_classes(sets: DataFrame, classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc, part): classes that may have a link, with the component of their ties.

    ``sets`` has (row, doc_id, tokens) of all rows, ``classes`` (doc, n, row) with one row of each class.
    """
    some = sets.where("doc_id is not null and size(tokens) > 0")
    later = stage(some.select("row").join(classes.select("row"), "row", "left_anti"), "later-rows")
    first = some.join(bounded_broadcast(later, LATER_ROWS), "row", "left_anti")
    tokens = first.select(F.col("doc_id").alias("doc"), F.explode("tokens").alias("token"))
    several = tokens.withColumn("n_docs", F.count(F.lit(1)).over(Window.partitionBy("token"))).where("n_docs > 1")
    band = F.col("token").bitwiseAND(F.lit(BANDS - 1)).alias("band")
    rare_first = F.sort_array(F.collect_list(F.struct("n_docs", "token")))
    lists = several.repartition("doc").groupBy("doc", band).agg(rare_first.alias("lists"))
    sizes = classes.groupBy("doc").agg(F.max("n").alias("n"))
    needed_here = F.greatest(PartScheme(percent).shared_column(F.col("n"), F.col("band")), F.lit(1))
    remaining = lists.join(sizes, "doc").withColumn("needed", needed_here.cast("int")).where(F.size("lists") >= F.col("needed"))
    rarest = F.slice("lists", F.lit(1), F.size("lists") - F.col("needed") + 1)
    asked = remaining.select("doc", F.explode(rarest.getField("token")).alias("token"))
    asked, discard = stage_for_now(asked, "rare-parts")
    least = asked.groupBy("token").agg(F.min("doc").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    ties = asked.join(least, "token").select(F.col("doc").alias("a"), F.col("least").alias("b"))
    found = connected_components(ties).select(F.col("node").alias("doc"), F.col("component").alias("part"))
    discard()
    return found


class _Forest:
    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i


def search_links(
    sets: list[np.ndarray], sides: np.ndarray | None = None, percent: int = PERCENT
) -> list[tuple[int, int]]:
    """A spanning forest of the links among the sets (across the two sides, if given).

    Queries go through the sets by size; a query's partners come before it and are at least
    ``percent`` percent as large, so its threshold is that share of its own size.
    """
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    sizes = np.array([len(sets[i]) for i in order], dtype=np.int64)
    side = None if sides is None else np.asarray(sides)[order]
    members = np.concatenate([sets[i] for i in order])
    owners = np.repeat(np.arange(len(order)), sizes)
    _, token, count = np.unique(members, return_inverse=True, return_counts=True)
    several = count[token] > 1
    token, owners = token[several], owners[several]
    by_token = np.argsort(token, kind="stable")
    postings, sorted_token = owners[by_token], token[by_token]
    list_start = np.searchsorted(sorted_token, np.arange(len(count)))
    list_size = np.searchsorted(sorted_token, np.arange(len(count)), side="right") - list_start
    own_start = np.searchsorted(owners, np.arange(len(order) + 1))
    forest, links = _Forest(len(order)), []
    for q in range(1, len(order)):
        need = int(threshold(sizes[q], percent))
        asked = token[own_start[q] : own_start[q + 1]]
        if len(asked) < need:
            continue
        first = int(np.searchsorted(sizes[:q], need))
        if first >= q:
            continue
        asked = asked[np.argsort(list_size[asked], kind="stable")]
        n_long = min(int(LONG_LISTS * need), need - 1)
        short, long = asked[: len(asked) - n_long], asked[len(asked) - n_long :]
        # Merge the short lists: how often each earlier document of fitting size occurs.
        lengths = list_size[short]
        at = np.repeat(list_start[short] - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
        met = postings[at + np.arange(len(at))]
        met = met[(met >= first) & (met < q)]
        seen = np.bincount(met - first, minlength=q - first)
        found = np.flatnonzero(seen >= max(1, need - n_long))
        if side is not None:
            found = found[side[found + first] != side[q]]
        if not len(found):
            continue
        # Probe the long lists for the few that are left.
        total = seen[found]
        for t in long:
            inverted = postings[list_start[t] : list_start[t] + list_size[t]]
            place = np.searchsorted(inverted, found + first)
            total = total + (inverted[np.minimum(place, len(inverted) - 1)] == found + first)
        union = sizes[q] + sizes[found + first] - total
        for r in (found + first)[100 * total >= percent * union]:
            here, there = forest.root(q), forest.root(int(r))
            if here != there:
                forest.up[here] = there
                links.append((order[q], order[int(r)]))
    return links


def _block_links(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links of one block, or between two."""
    sets = [np.sort(np.asarray(s, dtype=np.int64).view(np.uint64)) for s in rows["members"]]
    one_block = rows["low_block"].iat[0] == rows["high_block"].iat[0]
    docs = rows["doc"].to_numpy()
    links = search_links(sets, None if one_block else rows["block"].to_numpy(), percent)
    return pd.DataFrame([(docs[a], docs[b]) for a, b in links], columns=["a", "b"]).astype("int64")


def _member_rows(batches: Iterator[pd.DataFrame], width: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if not len(batch):
            continue
        yield pd.DataFrame(
            {"doc": batch["doc_id"], "members": [shingles(text, width).view(np.int64) for text in batch["text"]]}
        )


def class_links(
    docs: DataFrame, candidates: DataFrame, width: int = SHINGLE_WORDS, percent: int = PERCENT
) -> DataFrame:
    """(a, b): links between candidate classes that connect all that are linked."""
    keys = bounded_broadcast(candidates.select(F.col("doc").alias("doc_id")), 4_000_000)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(keys, "doc_id", "left_semi")
    sets = texts.mapInPandas(
        lambda batches: _member_rows(batches, width), "doc long, members array<long>"
    ).join(candidates, "doc")
    sets = stage(sets, "sets")
    parts = stage(
        sets.groupBy("part")
        .agg(F.sum(F.size("members")).alias("total"), F.count(F.lit(1)).alias("docs"))
        .where("docs > 1")
        .select("part", F.ceil(F.col("total") / BLOCK_HASHES).cast("int").alias("blocks")),
        "parts",
    )
    placed = sets.join(parts, "part").withColumn("block", F.pmod(F.hash("doc"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pairs = placed.select("part", "doc", "members", "block", other.alias("other")).select(
        "part",
        F.least("block", "other").alias("low_block"),
        F.greatest("block", "other").alias("high_block"),
        "doc",
        "block",
        "members",
    )
    return by_block_pair(pairs).applyInPandas(lambda rows: _block_links(rows, percent), "a long, b long")


def by_block_pair(pairs: DataFrame) -> GroupedData:
    """Rows grouped by pair of blocks, each pair dealt by itself.

    The key is one value made of all three numbers: rows that come dealt by component alone do not satisfy it, so
    the pairs of one component are shuffled to as many tasks as there are.
    """
    return pairs.groupBy(F.concat_ws(":", "part", "low_block", "high_block").alias("pair"))


def link_components(docs: DataFrame, width: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id): one row for each row of ``docs`` (doc_id, text)."""
    numbered = document_sets(docs, width, percent).withColumn("row", F.monotonically_increasing_id())
    sets_with_parts, discard = stage_for_now(numbered, "document-sets")
    sets = stage(sets_with_parts.drop("tokens"), "set-names")
    filled = sets.where("n > 0 and doc_id is not null")
    first = F.min(F.struct("doc_id", "row")).alias("first")
    classes = stage(
        filled.groupBy("n", "d1", "d2").agg(first).select("n", "d1", "d2", F.col("first.doc_id").alias("doc"), "first.row"),
        "classes",
    )
    candidates = stage(candidate_classes(sets_with_parts, classes, percent), "candidates")
    discard()
    components = stage(connected_components(class_links(docs, candidates, width, percent)), "components")
    named = (
        classes.select("n", "d1", "d2", "doc")
        .join(components.withColumnRenamed("node", "doc"), "doc", "left")
        .select("n", "d1", "d2", F.coalesce("component", "doc").alias("class_component"))
    )
    found = sets.select("doc_id", "n", "d1", "d2").join(named, ["n", "d1", "d2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("class_component", "doc_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document."""
    return link_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


def one_of_each_component(docs: DataFrame, width: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component: the one with the least id, the first by content.

    Rows without id stay. Where ids repeat or are no whole numbers, each different text of an id is
    judged by itself: a text goes only if it, not another row of its id, is linked with one that stays.
    """
    given = docs.where("doc_id is not null")
    if isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        repeated = given.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        if repeated.isEmpty():
            found = link_components(docs.select("doc_id", "text"), width, percent)
            gone = stage(found.where("component_id < doc_id").select(F.col("doc_id").alias("__doc")), "later-copies")
            return docs.join(bounded_broadcast(gone), F.col("doc_id") == F.col("__doc"), "left_anti")
    # Equal rows are counted as one; numbers in their order name the texts.
    row = F.struct(*every(docs.columns))
    single = given.select(F.col("doc_id").alias("__id"), "text", F.md5("text").alias("__digest"), row.alias("__row"))
    single = single.groupBy("__id", "__digest").agg(F.min("text").alias("text"), F.min("__row").alias("__row"))
    numbered = stage(single.withColumn("__number", F.monotonically_increasing_id()), "numbered-rows")
    found = link_components(numbered.select(F.col("__number").alias("doc_id"), "text"), width, percent)
    parts = stage(found.select(F.col("doc_id").alias("__number"), "component_id"), "row-components")
    first = F.min(F.struct("__id", "__digest", "__number")).alias("first")
    firsts = numbered.join(parts, "__number").groupBy("component_id").agg(first)
    kept = stage(firsts.select(F.col("first.__number").alias("__number")), "first-rows")
    rows = numbered.join(kept, "__number", "left_semi").select("__row.*")
    return rows.unionByName(docs.where("doc_id is null"))


#: All pairs of different sets that share a shingle, and their closure.
OP9_SQL = r"""
with recursive worded as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') ws
    from documents),
sets as (
    select doc_id, list_sort(list_distinct(case when len(ws) = 0 then [] when len(ws) < 4 then [array_to_string(ws, ' ')]
        else list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i : i + 3], ' ')) end)) s
    from worded),
classes as (select s, min(doc_id) doc, len(s) n from sets where len(s) > 0 group by s),
lists as (select doc, n, unnest(s) g from classes),
pairs as (
    select a.doc a, b.doc b from lists a join lists b on a.g = b.g and a.doc < b.doc
    group by a.doc, a.n, b.doc, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
links as (select a, b from pairs union all select b, a from pairs),
reached as (select doc node, doc at_doc from classes union select r.node, l.b from reached r join links l on r.at_doc = l.a),
least as (select node, min(at_doc) component from reached group by node)
select d.doc_id, len(d.s)::bigint as n_shingles, coalesce(l.component, d.doc_id) as component_id
from sets d left join classes c on d.s = c.s and len(d.s) > 0 left join least l on l.node = c.doc
"""
