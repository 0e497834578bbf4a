"""Exact substring deduplication by a suffix array of anchors, sorted deep-shallow.

A byte goes if a string of ``min_bytes`` (400) bytes around it also starts anywhere else. Each
such string (a window) has one anchor, the 64 bytes of least hash in it, so equal windows have equal
anchors at the same place. Neighbouring windows with one anchor make a stretch, and only
stretches whose anchor occurs elsewhere go on.

1. One pass finds the stretches; narrow rows (anchor, digest, place) are counted by anchor.
   If all stretches of an anchor are the same string, their windows all repeat and nothing
   is left to sort. Equal stretches of the others are counted, and one of each is sorted.
2. The suffixes that start behind an anchor, and the reversed prefixes that end before it, are sorted:
   a multikey quicksort looks at the first 32 bytes, in words of eight; groups that still agree
   are ordered by blind tries. The longest common prefixes of neighbours give, for
   each place of a window around the anchor, the groups of stretches that agree on both sides
   as far as the window reaches.
3. An anchor with more than ``hot_members`` different stretches is no group of one task: its
   windows are told apart one by one by 128-bit digests, counted with partial sums.

Stretches travel to the tasks with their text, at most ``bucket_bytes`` and one anchor's
stretches together. Texts are fetched by a join with the lists of stretches by text.

Defined cases: null and empty texts have no bytes and nothing goes; texts shorter than
``min_bytes`` stay whole; equal rows are copies of each other, so all their bytes go if there are
enough; a repeat may overlap itself; null or repeated ids change nothing, since texts are named by
their content; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.llm.common import stage, table

# Fixed values
MIN_BYTES = 400

ANCHOR_BYTES = 64  # a power of two
CHUNK = 1 << 20  # windows of one text that are looked at together
PLACE_BITS = 21  # of a hash, for the place in a chunk: the first of equal anchors counts
SHALLOW_WORDS = 4  # of eight bytes, that the quicksort looks at
BUCKET_BYTES = 8 << 20  # text of stretches in a task's group
HOT_MEMBERS = 20_000  # different stretches of one anchor that a task sorts
BROADCAST_BYTES = 32 << 20  # of lists of places by text

_FACTOR = 0x9E3779B97F4A7C15
_ENDS = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_BYTE_HASHES = _mixed((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(_FACTOR))


def _anchor_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``ANCHOR_BYTES`` bytes from each place, by doubling."""
    hashes, width, factor = _BYTE_HASHES[data], 1, _FACTOR
    while width < ANCHOR_BYTES:
        hashes = hashes[:-width] * np.uint64(factor) + hashes[width:]
        width, factor = 2 * width, factor * factor & int(_ENDS)
    return _mixed(hashes)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours: minima up to and from the ends of blocks."""
    blocks = np.full((-(-len(values) // width), width), _ENDS)
    blocks.reshape(-1)[: len(values)] = values
    upto = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    onward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    n = len(values) - width + 1
    return np.minimum(onward[:n], upto[width - 1 : width - 1 + n])


def stretches(data: bytes, min_bytes: int = MIN_BYTES) -> tuple[np.ndarray, ...]:
    """(first window, number of windows, place of the anchor, its hash) of every stretch."""
    found = []
    all_bytes = np.frombuffer(data, dtype=np.uint8)
    for begin in range(0, len(data) - min_bytes + 1, CHUNK):
        part = all_bytes[begin : begin + CHUNK + min_bytes - 1]
        hashes = _anchor_hashes(part)
        places = np.arange(len(hashes), dtype=np.uint64)
        ranked = (hashes >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | places
        least = _sliding_min(ranked, min_bytes - ANCHOR_BYTES + 1)
        at = (least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        count = np.diff(np.concatenate((first, [len(at)])))
        found.append((first + begin, count, at[first] + begin, hashes[at[first]].view(np.int64)))
    if not found:
        return tuple(np.empty(0, dtype=np.int64) for _ in range(4))
    return tuple(np.concatenate(columns) for columns in zip(*found))


def _merged(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of the spans, as spans in order that do not touch."""
    if not len(begin):
        return begin, end
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    new = np.concatenate(([True], begin[1:] > reach[:-1]))
    return begin[new], reach[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(reach) - 1]))]


_STRETCH = "name binary, low int, n int, offset int, anchor long, digest long, copies int"


def _stretch_rows(batches: Iterator[pa.RecordBatch], min_bytes: int) -> Iterator[pa.RecordBatch]:
    """One row for each different stretch of a text; further copies inside it are sure spans (no anchor)."""
    kinds = [pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
    names = [field.split(" ")[0] for field in _STRETCH.split(", ")]
    for batch in batches:
        columns: list[list] = [[] for _ in names]
        for name, data in zip(batch.column("name"), batch.column("data")):
            data = data.as_py()
            low, n, at, anchor = stretches(data, min_bytes)
            if not len(low):
                continue
            lows, ends = low.tolist(), (low + n + min_bytes - 1).tolist()
            digests = np.fromiter(
                (xxhash.xxh3_64_intdigest(data[a:b]) for a, b in zip(lows, ends)), dtype=np.uint64, count=len(lows)
            ).view(np.int64)
            _, first, copies = np.unique(digests, return_index=True, return_counts=True)
            again = np.ones(len(low), dtype=bool)
            again[first] = False
            sure_low, sure_end = _merged(low[again], (low + n + min_bytes - 1)[again])
            sure = len(sure_low)
            name = name.as_py()
            columns[0] += [name] * (len(first) + sure)
            columns[1] += low[first].tolist() + sure_low.tolist()
            columns[2] += n[first].tolist() + (sure_end - sure_low - min_bytes + 1).tolist()
            columns[3] += (at - low)[first].tolist() + [None] * sure
            columns[4] += anchor[first].tolist() + [None] * sure
            columns[5] += digests[first].tolist() + [None] * sure
            columns[6] += copies.tolist() + [2] * sure
            if len(columns[0]) > 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
                columns = [[] for _ in names]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


# Sorting ------------------------------------------------------------------------------------


def multikey_quicksort(words: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, label): rows sorted by group and words; rows of one label agree in all of them.

    All segments are parted at once: around the word of their middle row into less, equal
    and greater; equal rows go on with the next word.
    """
    order = np.argsort(group, kind="stable")
    label = np.cumsum(np.concatenate(([0], np.diff(group[order]) != 0)))
    depth = np.zeros(len(order), dtype=np.int64)
    while True:
        size = np.bincount(label)
        open_ = np.flatnonzero((size[label] > 1) & (depth < words.shape[1]))
        if not len(open_):
            return order, label
        segment, rows = label[open_], order[open_]
        word = words[rows, depth[open_]]
        starts = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1])))
        length = np.diff(np.concatenate((starts, [len(segment)])))
        pivot = np.repeat(word[starts + length // 2], length)
        side = (word > pivot).astype(np.int64) - (word < pivot) + 1
        parted = np.argsort(3 * segment + side, kind="stable")
        order[open_] = rows[parted]
        depth[open_] = depth[open_][parted] + (side[parted] == 1)
        keys = 3 * label
        keys[open_] = (3 * segment + side)[parted]
        label = np.cumsum(np.concatenate(([0], np.diff(keys) != 0)))


def _common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    a, b = a[:n], b[:n]
    if a == b:
        return n
    return n - ((int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).bit_length() + 7) // 8


def blind_trie_order(strings: list[bytes]) -> list[int]:
    """Order of the strings by a trie whose nodes know only where strings part.

    A new string is led down blindly by the bytes at the nodes' depths; one comparison with the leaf
    it meets tells at which depth it parts. Ends sort before all bytes.
    """

    def byte(s: bytes, depth: int) -> int:
        return s[depth] if depth < len(s) else -1

    root: list = [None, [0]]  # a leaf: [None, rows]; a node: [depth, {byte: child}]
    for row in range(1, len(strings)):
        s, node = strings[row], root
        while node[0] is not None:
            child = node[1].get(byte(s, node[0]))
            node = child if child is not None else next(iter(node[1].values()))
        other = strings[node[1][0]]
        if s == other:
            node[1].append(row)
            continue
        depth, above, node = _common(s, other), None, root
        while node[0] is not None and node[0] < depth:
            above, node = node, node[1][byte(s, node[0])]
        if node[0] == depth:
            node[1][byte(s, depth)] = [None, [row]]
            continue
        parted = [depth, {byte(other, depth): node, byte(s, depth): [None, [row]]}]
        if above is None:
            root = parted
        else:
            above[1][byte(s, above[0])] = parted
    order, open_ = [], [root]
    while open_:
        depth, below = open_.pop()
        if depth is None:
            order += below
        else:
            open_ += [below[b] for b in sorted(below, reverse=True)]
    return order


def deep_shallow_sort(strings: list[bytes], group: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, lcp): strings sorted inside their groups, and what each shares with the one before it.

    The first string of a group shares -1. No string is longer than ``width``.
    """
    wide = -(-max(width, 8 * SHALLOW_WORDS) // 8) * 8
    padded = np.frombuffer(b"".join(s.ljust(wide, b"\0") for s in strings), dtype=np.uint8).reshape(len(strings), wide)
    length = np.fromiter(map(len, strings), dtype=np.int64, count=len(strings))
    words = np.ascontiguousarray(padded[:, : 8 * SHALLOW_WORDS]).view(">u8").astype(np.uint64)
    order, label = multikey_quicksort(words, group)
    starts = np.flatnonzero(np.concatenate(([True], np.diff(label) != 0)))
    sizes = np.diff(np.concatenate((starts, [len(label)])))
    for start, size in zip(starts[sizes > 1], sizes[sizes > 1]):
        rows = order[start : start + size].copy()
        order[start : start + size] = rows[blind_trie_order([strings[r] for r in rows])]
    unlike = padded[order[1:]] != padded[order[:-1]]
    shared = np.where(unlike.any(axis=1), unlike.argmax(axis=1), wide)
    shared = np.minimum(shared, np.minimum(length[order[1:]], length[order[:-1]]))
    shared[group[order[1:]] != group[order[:-1]]] = -1
    return order, np.concatenate(([-1], shared))


def _neighbours(order: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """The most that each row shares with any other of its group."""
    most = np.empty(len(order), dtype=np.int64)
    most[order] = np.maximum(lcp, np.concatenate((lcp[1:], [-1])))
    return most


def _agreeing(order: np.ndarray, lcp: np.ndarray, depth: int) -> np.ndarray:
    """A number for each row, the same for rows of a group that share ``depth`` bytes."""
    named = np.empty(len(order), dtype=np.int64)
    named[order] = np.cumsum(lcp < depth)
    return named


def repeated_windows(
    texts: list[bytes], offset: np.ndarray, n: np.ndarray, anchor: np.ndarray, min_bytes: int = MIN_BYTES
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, begin, end): spans, from the start of each different stretch, whose windows another one has too.

    A window that begins ``back`` bytes before the anchor repeats if two stretches agree in so many
    bytes before the anchor and in the rest behind it.
    """
    reach = min_bytes - ANCHOR_BYTES
    group = np.unique(anchor, return_inverse=True)[1]
    behind = deep_shallow_sort([t[o + ANCHOR_BYTES :] for t, o in zip(texts, offset)], group, reach)
    before = deep_shallow_sort([t[:o][::-1] for t, o in zip(texts, offset)], group, reach)
    share_behind, share_before = _neighbours(*behind), _neighbours(*before)
    hit = np.zeros((len(texts), reach + 2), dtype=bool)
    for back in range(reach + 1):
        rows = np.flatnonzero(
            (back <= offset) & (back > offset - n) & (share_before >= back) & (share_behind >= reach - back)
        )
        if len(rows) > 1:
            pair = _agreeing(*before, back)[rows] * len(texts) + _agreeing(*behind, reach - back)[rows]
            _, which, count = np.unique(pair, return_inverse=True, return_counts=True)
            hit[rows[count[which] > 1], back + 1] = True
    change = np.diff(np.pad(hit, ((0, 0), (0, 1))).astype(np.int8), axis=1)
    row, low = np.nonzero(change == 1)
    high = np.nonzero(change == -1)[1]  # windows that begin low .. high - 1 bytes before the anchor
    return row, offset[row] - high + 1, offset[row] - low + min_bytes


def _sort_bucket(members: pa.Table, min_bytes: int) -> pa.Table:
    key = np.stack([members.column(c).to_numpy() for c in ("anchor", "digest")], axis=1)
    members = members.take(pa.array(np.unique(key, axis=0, return_index=True)[1]))
    offset, n, anchor, low = (members.column(c).to_numpy().astype(np.int64) for c in ("offset", "n", "anchor", "low"))
    row, begin, end = repeated_windows(members.column("piece").to_pylist(), offset, n, anchor, min_bytes)
    return pa.table(
        {
            "name": members.column("name").take(pa.array(row)),
            "begin": pa.array(begin + low[row], pa.int32()),
            "end": pa.array(end + low[row], pa.int32()),
        }
    )


def _piece_rows(batches: Iterator[pa.RecordBatch], min_bytes: int) -> Iterator[pa.RecordBatch]:
    """The text of every listed stretch; a text that comes again is left out."""
    seen: set[bytes] = set()
    for batch in batches:
        for name, data, listed in zip(batch.column("name"), batch.column("data"), batch.column("listed")):
            name, data = name.as_py(), data.as_py()
            if name in seen:
                continue
            seen.add(name)
            rows = listed.values
            low, n = (rows.field(c).to_pylist() for c in ("low", "n"))
            pieces = [data[a : a + k + min_bytes - 1] for a, k in zip(low, n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(low), pa.binary()), *(rows.field(c) for c in ("low", "n", "offset", "anchor", "digest", "hot")),
                 pa.array(pieces, pa.binary())],
                ["name", "low", "n", "offset", "anchor", "digest", "hot", "piece"],
            )


def _window_rows(batches: Iterator[pa.RecordBatch], min_bytes: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, low, n, piece in zip(*(batch.column(c) for c in ("name", "low", "n", "piece"))):
            piece, n, low = piece.as_py(), n.as_py(), low.as_py()
            digests = [xxhash.xxh3_128_digest(piece[i : i + min_bytes]) for i in range(n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([name.as_py()] * n, pa.binary()), pa.array(range(low, low + n), pa.int32()), pa.array(digests, pa.binary())],
                ["name", "begin", "window"],
            )


def _kept_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans, kept = [], []
        for data, listed in zip(batch.column("data"), batch.column("listed")):
            data = data.as_py()
            if not listed.is_valid:
                spans.append([])
                kept.append(data)
                continue
            begin, end = (listed.values.field(c).to_numpy(zero_copy_only=False) for c in ("begin", "end"))
            begin, end = (x.tolist() for x in _merged(begin, end))
            spans.append([{"begin": a, "end": b} for a, b in zip(begin, end)])
            kept.append(b"".join(data[a:b] for a, b in zip([0, *end], [*begin, len(data)])))
        kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), pa.array([len(d.as_py()) for d in batch.column("data")], pa.int64()),
             pa.array(spans, kind), pa.array(kept, pa.binary())],
            ["doc", "n_bytes", "spans", "kept"],
        )


# Jobs ---------------------------------------------------------------------------------------


def _joined(texts: DataFrame, lists: DataFrame, entry_bytes: int, how: str) -> DataFrame:
    """Texts with their lists; the lists are broadcast if they prove small, else both sides are shuffled."""
    total = lists.agg(F.sum(F.size("listed") * entry_bytes + 64)).first()[0] or 0
    return texts.join(F.broadcast(lists) if total <= BROADCAST_BYTES else lists, "name", how)


def repeated_spans(texts: DataFrame, min_bytes: int = MIN_BYTES, hot_members: int = HOT_MEMBERS,
                   bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(name, begin, end): spans of every text of ``texts`` (name, data) whose windows repeat; they may overlap."""
    rows = stage(texts.mapInArrow(lambda batches: _stretch_rows(batches, min_bytes), _STRETCH), "stretches")
    counted = rows.where("anchor is not null").groupBy("anchor").agg(
        F.sum("copies").alias("total"), (F.min("digest") == F.max("digest")).alias("alike")
    ).where("total > 1")
    # Staged, so that the joins with what was counted by the same key can be split where one is frequent.
    counted = stage(counted.select("anchor", "alike"), "repeated-anchors")
    met = stage(rows.join(counted, "anchor"), "met-stretches")
    end = F.col("low") + F.col("n") + F.lit(min_bytes - 1)

    def whole(found: DataFrame) -> DataFrame:
        return found.select("name", F.col("low").alias("begin"), end.alias("end"))

    # Different stretches of one anchor: equal ones are settled by their number, one of each is sorted.
    mixed = met.where("not alike")
    classes = stage(
        mixed.groupBy("anchor", "digest").agg(
            F.sum("copies").alias("total"), F.min(F.struct("name", "low", "n", "offset")).alias("first")
        ),
        "stretch-classes",
    )
    several = classes.where("total > 1").select("anchor", "digest")
    hot = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > hot_members)
    hot = stage(hot.select("anchor", F.lit(True).alias("hot")), "hot-anchors")
    listed = stage(
        classes.join(hot, "anchor", "left")
        .select("first.*", "anchor", "digest", F.coalesce("hot", F.lit(False)).alias("hot"))
        .groupBy("name")
        .agg(F.collect_list(F.struct("low", "n", "offset", "anchor", "digest", "hot")).alias("listed")),
        "sorted-stretches",
    )
    members = _joined(texts, listed, 40, "inner").mapInArrow(
        lambda batches: _piece_rows(batches, min_bytes),
        "name binary, low int, n int, offset int, anchor long, digest long, hot boolean, piece binary",
    )
    size = classes.agg(F.sum(F.col("first.n") + F.lit(min_bytes))).first()[0] or 0
    buckets = max(1, -(-size // bucket_bytes))
    bucket = F.pmod(F.xxhash64("anchor"), F.lit(buckets)).alias("bucket")
    no_hot = hot.isEmpty()
    found = (
        (members if no_hot else members.where("not hot"))
        .groupBy(bucket)
        .applyInArrow(lambda bucket: _sort_bucket(bucket, min_bytes), "name binary, begin int, end int")
    )
    spans = (
        whole(rows.where("anchor is null"))
        .unionByName(whole(met.where("alike")))
        .unionByName(whole(mixed.join(several, ["anchor", "digest"])))
        .unionByName(found)
    )
    if no_hot:
        return spans
    windows = stage(
        members.where("hot").mapInArrow(lambda b: _window_rows(b, min_bytes), "name binary, begin int, window binary"), "windows"
    )
    # A text that two tasks met is here twice: places are counted, not rows.
    seen = windows.distinct().groupBy("window").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    of_hot = windows.join(stage(seen.select("window"), "repeated-windows"), "window").select("name", "begin", (F.col("begin") + min_bytes).alias("end"))
    return spans.unionByName(of_hot)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", min_bytes: int = MIN_BYTES, **sizes) -> DataFrame:
    """(doc, n_bytes, spans, kept): removed spans [begin, end) of each row, and its bytes without them."""
    data = F.coalesce(F.col(text), F.lit(""))
    given = docs.select(F.col(key).alias("doc"), F.unhex(F.md5(data)).alias("name"), data.cast("binary").alias("data"))
    spans = repeated_spans(given.select("name", "data"), min_bytes, **sizes)
    lists = stage(spans.groupBy("name").agg(F.collect_set(F.struct("begin", "end")).alias("listed")), "spans")
    kind = docs.schema[key].dataType.simpleString()
    return _joined(given, lists, 8, "left").mapInArrow(
        _kept_rows, f"doc {kind}, n_bytes long, spans array<struct<begin:int,end:int>>, kept binary"
    )


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What went from every document, and a digest of what is left."""
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("doc").alias("doc_id"),
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
