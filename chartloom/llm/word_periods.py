"""Periodic runs of words, as maximal pairs of an LCP-interval tree.

Of each text the word sequence is ranked by prefix doubling. A run of period q, at least four
periods long, repeats itself at distance q over three periods, so a stretch of two to three
periods comes again at that distance and no sooner: places whose next equal stretch of m
words is at most m / 2 words away (m = 4, 6, 8, 12, 16, ...) are the only ones a run can start at, and
most texts have none.

The suffixes from these places are sorted, and the tree of their LCP intervals is walked from
below. Each interval keeps its places in ordered lists by the word to their left; where two
children meet at a common prefix of l words, places of unlike left words are paired if they are
at most l / 3 apart. Such a maximal pair (i, i + q) is the run of l + q words from i. Pairs at a
multiple of the period find the same stretch, which keeps its smallest period.

Everything happens row by row in one scan: no shuffle, and memory in proportion to one text
and the batch it came in.

Defined cases: null, empty and blank texts have no words, no runs and an empty collapsed text; a null
id is kept; equal rows and rows of one id are each their own; of words that several runs contain, each run
drops what comes after its first period; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.llm.common import table

# Fixed values of a run
PERIODS, LEAST_WORDS = 4, 6

Run = tuple[int, int, int]  # start, length, period
BATCH_BYTES = 8 << 20  # of text that is handed on at a time


def _numbered(words: list[bytes]) -> np.ndarray:
    """Words as numbers from 1 in the order of their first place."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known) + 1) for w in words), dtype=np.int64, count=len(words))


def _ranked(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Dense ranks, from 1, of pairs."""
    return np.unique(first * (int(second.max()) + 1) + second, return_inverse=True)[1] + 1


def _shifted(ranks: np.ndarray, by: int) -> np.ndarray:
    """Ranks of the suffixes further on; 0 beyond the end."""
    moved = np.zeros_like(ranks)
    moved[: max(0, len(ranks) - by)] = ranks[by:]
    return moved


def _four_words(ids: np.ndarray) -> np.ndarray:
    two = _ranked(ids, _shifted(ids, 1))
    return _ranked(two, _shifted(two, 2))


def _repeated(first: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ranks, places, distances) of pairs of ranks ``gap`` apart that occur again: ranks are 0 elsewhere.

    Distances lead from each such place to the next equal one; 0 from the last.
    """
    ranks = np.zeros_like(first)
    at = np.flatnonzero((first > 0) & (_shifted(first, gap) > 0)) if gap else np.flatnonzero(first)
    if not len(at):
        return ranks, at, at
    keys = first[at] * (int(first.max()) + 1) + (first[at + gap] if gap else 0)
    order = np.argsort(keys, kind="stable")
    at, keys = at[order], keys[order]
    same = keys[1:] == keys[:-1]
    several = np.concatenate((same, [False])) | np.concatenate(([False], same))
    distance = np.where(np.concatenate((same, [False])), np.concatenate((at[1:], [0])) - at, 0)
    ranks[at[several]] = np.cumsum(np.concatenate(([True], ~same)))[several]
    return ranks, at[several], distance[several]


def run_places(four: np.ndarray) -> np.ndarray:
    """Places, in order, of equal stretches so near to each other that a run may go from one to the other."""
    width, found = 4, []
    n = len(four)
    ranks = four.copy()
    ranks[max(0, n - 3) :] = 0  # fewer than four words
    ranks, at, distance = _repeated(ranks, 0)
    while len(at):
        near = (distance > 0) & (2 * distance <= width)
        found += [at[near], at[near] + distance[near]]
        _, at, distance = _repeated(ranks, width // 2)
        near = (distance > 0) & (4 * distance <= 3 * width)
        found += [at[near], at[near] + distance[near]]
        ranks, at, distance = _repeated(ranks, width)
        width *= 2
    return np.unique(np.concatenate(found)) if found else np.empty(0, dtype=np.int64)


def _suffix_ranks(ids: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by 1, 2, 4, ... words, until all differ."""
    levels = [ids]
    while len(levels) == 1 or int(levels[-1].max()) < len(ids):
        levels.append(_ranked(levels[-1], _shifted(levels[-1], 2 ** (len(levels) - 1))))
    return levels


def _common_words(levels: list[np.ndarray], one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Length of the common prefix of suffixes, by halving steps."""
    n, length = len(levels[0]), np.zeros(len(one), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        a, b = one + length, other + length
        inside = (a < n) & (b < n)
        equal = inside.copy()
        equal[inside] = levels[k][a[inside]] == levels[k][b[inside]]
        length[equal] += 2**k
    return length


class _Interval:
    """An LCP interval: places in order by the word to their left."""

    __slots__ = ("common", "lists", "size")

    def __init__(self, common: int, lists: dict[int, list[int]], size: int) -> None:
        self.common, self.lists, self.size = common, lists, size


def _met(one: _Interval, other: _Interval, common: int, found: dict[tuple[int, int], int]) -> _Interval:
    """Both intervals' places in one, after noting the runs among pairs of unlike left words."""
    few, many = (one, other) if one.size <= other.size else (other, one)
    limit = common // (PERIODS - 1)
    for left, places in few.lists.items():
        for their_left, theirs in many.lists.items():
            if their_left == left:
                continue
            for place in places:
                k = bisect_left(theirs, place - limit)
                while k < len(theirs) and theirs[k] <= place + limit:
                    period = abs(theirs[k] - place)
                    if common + period >= LEAST_WORDS:
                        start = min(place, theirs[k])
                        span = (start, start + period + common)
                        found[span] = min(period, found.get(span, period))
                    k += 1
    for left, places in few.lists.items():
        theirs = many.lists.get(left)
        if theirs is None:
            many.lists[left] = places
        elif len(places) == 1:
            insort(theirs, places[0])
        else:
            theirs += places
            theirs.sort()
    many.common, many.size = common, few.size + many.size
    return many


def maximal_pairs(suffixes: np.ndarray, common: np.ndarray, left: np.ndarray) -> dict[tuple[int, int], int]:
    """(start, end) -> smallest period of each run, from sorted suffixes with the common prefixes of neighbours."""
    found: dict[tuple[int, int], int] = {}
    least = LEAST_WORDS - 1  # a run of period 1 repeats itself over so many words
    open_: list[_Interval] = []
    places, lefts, shared = suffixes.tolist(), left.tolist(), [*common.tolist()[1:], 0]
    for place, its_left, length in zip(places, lefts, shared):
        last = _Interval(0, {its_left: [place]}, 1)
        while open_ and open_[-1].common > length:
            top = open_.pop()
            last = _met(top, last, top.common, found)
        if length < least:
            open_.clear()
        elif open_ and open_[-1].common == length:
            open_[-1] = _met(open_[-1], last, length, found)
        else:
            last.common = length
            open_.append(last)
    return found


def word_runs(words: list[bytes]) -> list[Run]:
    """All runs (start, length, period) by start, then period."""
    if len(words) < LEAST_WORDS:
        return []
    ids = _numbered(words)
    places = run_places(_four_words(ids))
    if not len(places):
        return []
    levels = _suffix_ranks(ids)
    suffixes = places[np.argsort(levels[-1][places])]
    common = np.concatenate(([0], _common_words(levels, suffixes[:-1], suffixes[1:])))
    left = np.where(suffixes > 0, ids[suffixes - 1], 0)
    found = maximal_pairs(suffixes, common, left)
    return sorted((start, end - start, period) for (start, end), period in found.items())


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words left when each run keeps its first period, joined by blanks."""
    kept = bytearray(b"\1" * len(words))
    for start, length, period in runs:
        kept[start + period : start + length] = bytes(length - period)
    return b" ".join(w for w, k in zip(words, kept) if k)


def _run_rows(batches: Iterator[pa.RecordBatch], prepare: Callable | None) -> Iterator[pa.RecordBatch]:
    whole = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    names = ["doc", "n_words", "runs", "collapsed"]
    for batch in batches:
        ids, begin, size = batch.column("doc"), 0, 0
        counts, runs, left = [], [], []
        for k, (doc, text) in enumerate(zip(ids, batch.column("data"))):
            words = text.as_py().split()
            if prepare is not None:
                words = prepare(doc.as_py(), words)
            found = word_runs(words)
            counts.append(len(words))
            runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
            left.append(collapsed(words, found) if found else b" ".join(words))
            size += len(left[-1])
            if size > BATCH_BYTES or k + 1 == len(ids):
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(begin, len(counts)), pa.array(counts, pa.int64()), pa.array(runs, whole),
                     pa.array(left, pa.binary()).cast(pa.string())],
                    names,
                )
                begin, size, counts, runs, left = k + 1, 0, [], [], []


def periodic_runs(
    docs: DataFrame, key: str = "doc_id", text: str = "text", prepare: Callable[[object, list[bytes]], list[bytes]] | None = None
) -> DataFrame:
    """(doc, n_words, runs, collapsed) of each row of ``docs``.

    ``runs`` are structs (start, length, period) by start and period. ``prepare`` may change the words
    (UTF-8) of a row, given its key, before they are looked at.
    """
    given = docs.select(F.col(key).alias("doc"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("data"))
    kind = docs.schema[key].dataType.simpleString()
    return given.mapInArrow(
        lambda batches: _run_rows(batches, prepare),
        f"doc {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string",
    )


def repeat_planted(doc_id: object, words: list[bytes]) -> list[bytes]:
    """The words of every tenth document, by its hash, with a periodic end."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    start = g % n
    period = 1 + (n - start) // (3 + g % 8)
    return [w if i < start else words[start + (i - start) % period] for i, w in enumerate(words)]


def op12_word_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of runs, the longest one, and digests of all runs and of the collapsed text."""
    found = periodic_runs(table(spark, sf_dir, "documents"), prepare=repeat_planted)
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    )
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("longest", longest).select(
        F.col("doc").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.expr("(1000 * longest.length) div -longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
