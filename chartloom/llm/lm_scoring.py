"""Language-model scores: cross-entropy difference of a target and a background model.

Both models are matched in everything but their text: one vocabulary (every word of all
documents, and one place for a word never seen), the same smoothing, and equal mass (every
count of a model is scaled so that both have as many words). A model's loss of a word is
the mean of two losses in nats: that of the word by itself, smoothed by a small count for
every word of the vocabulary, and that of the word after the one before it, smoothed by a
fixed mass spread evenly over the vocabulary, so that after a word never seen all words are
equally likely. Both sum to one over the vocabulary. A row's own words are left out of
every count that its loss is made of. A document's score is the mean over its words of
target loss minus background loss: the lower, the more it reads like the target.

Every word and every pair is counted; the counts grow with the corpus. Words go by their
64-bit hash, pairs by a 64-bit hash of both. Losses are logarithms of sums, taken apart:

* what depends on a word's count is added up where the text is read, with the most frequent
  words at hand (a fixed number at most); the others' occurrences are joined to their counts;
* what depends on a pair's count needs all its occurrences in one place: every task deals
  its pairs into buckets by their hash, many in one row, and nothing but the hash, the row and
  the number of times travels, once. Buckets are as many as keep one to some million
  pairs; sums by row leave it. Pairs too frequent for a bucket (both words must be so, which
  the words' counts tell) are counted before, carried to the tasks and settled there.

Three scans of the documents; no text is shuffled while the target's ids, counted first, are
few enough to broadcast. Losses are added up as whole numbers, so sums do not depend on
their order.

Defined cases: null and blank texts have no words, and null losses and score; equal rows get
equal results; a document counts as target once for each of its rows if any label row names
its id; without target rows the target model is uniform over the vocabulary; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.llm.common import bounded_broadcast, stage, table

ADDED = 0.1  # to every word's count
CONTEXT_MASS = 10.0  # spread over the vocabulary after every word

CARRIED_WORDS = 1 << 21  # most frequent words that tasks hold, at most: 40 bytes each
BUCKET_PAIRS = 4_000_000  # pairs in a bucket, about
LEAST_BUCKETS = 32  # of at least BUCKET_PAIRS / 16
MOST_HOT_PAIRS = 1 << 20  # carried pairs are at least this share of all words
CHUNK_WORDS = 500_000  # words that a task works on at a time, or one text
UNIT = float(1 << 30)  # of a nat, in which losses are added up

_BEGIN = np.uint64(xxhash.xxh3_64_intdigest(""))  # before the first word of a text
_MIX = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)]

MODELS = ("target", "background")


def tokens(text: str | None) -> list[str]:
    return (text or "").lower().split()


class _Chunk:
    """Some texts: their words as places in ``known`` (hashes), and the words' pairs."""

    def __init__(self, at: int, hashes: list[np.ndarray]) -> None:
        self.at, self.lengths = at, np.array([len(h) for h in hashes], dtype=np.int64)
        self.known, place = np.unique(np.concatenate([*hashes, [_BEGIN]]).astype(np.uint64), return_inverse=True)
        self.word, begin = place[:-1].astype(np.int64), int(place[-1])
        self.before = np.concatenate(([begin], self.word[:-1]))[: len(self.word)]
        starts = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))
        self.before[starts[self.lengths > 0]] = begin
        self.text = np.repeat(np.arange(len(self.lengths)), self.lengths)

    def names(self, before: np.ndarray, word: np.ndarray) -> np.ndarray:
        return pair_names(self.known[before], self.known[word])


def pair_names(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """64-bit names of pairs of hashes."""
    mixed = before * _MIX[0] + word
    for factor in _MIX[1:]:
        mixed = (mixed ^ (mixed >> np.uint64(33))) * factor
    return (mixed ^ (mixed >> np.uint64(33))).view(np.int64)


def _chunks(texts: list[str | None]) -> Iterator[_Chunk]:
    at, hashes, size = 0, [], 0
    for i, text in enumerate(texts):
        words = tokens(text)
        if size and size + len(words) > CHUNK_WORDS:
            yield _Chunk(at, hashes)
            at, hashes, size = i, [], 0
        hashes.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words)))
        size += len(words)
    if hashes:
        yield _Chunk(at, hashes)


def _table(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], names=list(columns))


def _flags(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("is_target").to_numpy(zero_copy_only=False).astype(bool)


def count_words(docs: DataFrame) -> DataFrame:
    """(word, background, target, before_background, before_target): occurrences as a word, and before one."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags = _flags(batch)
            for c in _chunks(batch.column("text").to_pylist()):
                mine, size = flags[c.at + c.text], len(c.known)
                yield _table({
                    "word": c.known.view(np.int64),
                    "background": np.bincount(c.word, minlength=size),
                    "target": np.bincount(c.word[mine], minlength=size),
                    "before_background": np.bincount(c.before, minlength=size),
                    "before_target": np.bincount(c.before[mine], minlength=size),
                })

    columns = ["background", "target", "before_background", "before_target"]
    counted = docs.select("text", "is_target").mapInArrow(count, "word long, " + ", ".join(f"{c} long" for c in columns))
    return counted.groupBy("word").agg(*[F.sum(c).alias(c) for c in columns])


def count_hot_pairs(docs: DataFrame, hot_words: np.ndarray, least: int) -> DataFrame:
    """(pair, background, target): all pairs of two of the given words (sorted) that occur at least so often."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags = _flags(batch)
            for c in _chunks(batch.column("text").to_pylist()):
                hot = np.isin(c.known, hot_words)
                both = hot[c.before] & hot[c.word]
                pairs, place, n = np.unique(
                    c.before[both] * len(c.known) + c.word[both], return_inverse=True, return_counts=True
                )
                mine = flags[c.at + c.text[both]]
                yield _table({
                    "pair": c.names(pairs // len(c.known), pairs % len(c.known)),
                    "background": n,
                    "target": np.bincount(place[mine], minlength=len(pairs)),
                })

    counted = docs.select("text", "is_target").mapInArrow(count, "pair long, background long, target long")
    return (
        counted.groupBy("pair")
        .agg(F.sum("background").alias("background"), F.sum("target").alias("target"))
        .where(F.col("background") >= least)
    )


def carried_from(words: DataFrame, most: int) -> int:
    """The least count that so few words reach that tasks can hold them."""
    rows, least = 0, None
    for n, found in sorted(words.groupBy("n").count().collect(), reverse=True):
        rows += found
        if rows > most:
            return n + 1
        least = n
    return least or 1


class Models:
    """Sizes of both models, and the parts of a loss, in units. The formulas take numbers, arrays and columns."""

    def __init__(self, size: int, target: int, background: int) -> None:
        mass = float(target or background)
        self.places = size + 1
        self.total = {"target": float(target), "background": float(background)}
        self.scale = {m: mass / n if n else 1.0 for m, n in self.total.items()}
        self.floor = CONTEXT_MASS / self.places

    def of_text(self, model: str, own: np.ndarray) -> np.ndarray:
        """For each word of a text that has ``own`` words in the model."""
        whole = np.log(self.scale[model] * (self.total[model] - own) + ADDED * self.places)
        return np.rint((whole - np.log(self.floor)) / 2 * UNIT).astype(np.int64)

    def as_word(self, model: str, others):
        return self.scale[model] * others + ADDED

    def as_before(self, model: str, others):
        return self.scale[model] * others + CONTEXT_MASS

    def of_pair(self, model: str, others: np.ndarray) -> np.ndarray:
        """What occurrences of a pair in other rows take from its loss."""
        return np.rint(np.log1p(self.scale[model] * others / self.floor) / 2 * UNIT).astype(np.int64)


def _units(value: np.ndarray) -> np.ndarray:
    return np.rint(np.log(value) / 2 * UNIT).astype(np.int64)


def _at(sorted_names: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the asked names, and which of them are there."""
    if not len(sorted_names):
        return np.zeros(len(asked), dtype=np.int64), np.zeros(len(asked), dtype=bool)
    place = np.minimum(np.searchsorted(sorted_names, asked), len(sorted_names) - 1)
    return place, sorted_names[place] == asked


# What a task deals out: one row for each bucket with the pairs of a chunk of texts, text by text (``sizes`` of them
# in each of ``rows``), and one for the chunk itself, with sums by text and the words that are not carried.
DEALT = (
    "bucket long, rows array<long>, flags array<boolean>, sizes array<long>, pairs array<long>, n array<int>,"
    " ids array<{kind}>, lengths array<long>, target array<long>, background array<long>,"
    " rare_sizes array<long>, rare array<long>, as_word array<int>, as_before array<int>"
)
# What leaves a bucket: sums by row, and the words that are not carried with their number of times in the row.
SUMS = "row long, doc_id {kind}, word long, is_target boolean, n_tokens long, as_word long, as_before long, target long, background long"


def _deal(models: Models, words: dict[str, np.ndarray], hot: dict[str, np.ndarray], buckets: int, kind: pa.DataType):
    """The function that deals out chunks of texts."""

    def lists(values: list) -> pa.Array:
        arrays = [v if isinstance(v, pa.Array) else pa.array(v) for v in values]
        offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.concat_arrays(arrays))

    def settle(c: _Chunk, flags: np.ndarray) -> tuple[dict, dict, list[tuple]]:
        """(sums by model, words that are not carried, (bucket, text, pair, n) sorted by bucket and text)."""
        texts, size = len(c.lengths), len(c.known)
        sums = {m: c.lengths * models.of_text(m, c.lengths * (flags if m == "target" else 1)) for m in MODELS}
        # Words of each text, as a word and as one before.
        both, n = np.unique(np.concatenate((c.text * size + c.word, c.text * size + c.before)), return_counts=True)
        spoken = np.bincount(np.searchsorted(both, c.text * size + c.word), minlength=len(both))
        ahead = n - spoken
        text, word = both // size, both % size
        place, there = _at(words["word"], c.known.view(np.int64))
        is_carried = there[word]
        in_text, at = text[is_carried], place[word[is_carried]]
        for m in MODELS:
            own = flags[in_text] if m == "target" else np.ones(len(in_text), dtype=np.int64)
            k_word, k_before = spoken[is_carried], ahead[is_carried]
            part = k_before * _units(models.as_before(m, words[f"before_{m}"][at] - own * k_before))
            part -= k_word * _units(models.as_word(m, words[m][at] - own * k_word))
            np.add.at(sums[m], in_text, part)
        other = ~is_carried
        rare = {
            "rare_sizes": np.bincount(text[other], minlength=texts),
            "rare": c.known[word[other]].view(np.int64),
            "as_word": spoken[other].astype(np.int32),
            "as_before": ahead[other].astype(np.int32),
        }
        # Pairs of each text.
        pairs, pair = np.unique(c.before * size + c.word, return_inverse=True)
        names = c.names(pairs // size, pairs % size)
        cells, n = np.unique(c.text * max(len(pairs), 1) + pair, return_counts=True)
        text, name = cells // max(len(pairs), 1), names[cells % max(len(pairs), 1)]
        place, known = _at(hot["pair"], name)
        for m in MODELS:
            own = flags[text[known]] if m == "target" else 1
            np.add.at(sums[m], text[known], -n[known] * models.of_pair(m, hot[m][place[known]] - own * n[known]))
        text, name, n = text[~known], name[~known], n[~known]
        bucket = (name.view(np.uint64) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
        parts = [(b, order[low:high]) for b, (low, high) in enumerate(zip(ends, ends[1:])) if high > low]
        return sums, rare, [(b, text[o], name[o], n[o].astype(np.int32)) for b, o in parts]

    none = np.zeros(0, dtype=np.int64)
    fields = [f.strip().split(" ")[0] for f in DEALT.split(", ")]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_flags, rows = _flags(batch).astype(np.int64), batch.column("row").to_numpy()
            ids = batch.column("doc_id")
            for c in _chunks(batch.column("text").to_pylist()):
                texts = len(c.lengths)
                flags, own_rows = all_flags[c.at : c.at + texts], rows[c.at : c.at + texts]
                sums, rare, parts = settle(c, flags)
                empty = {f: none for f in fields} | {
                    "n": none.astype(np.int32), "as_word": none.astype(np.int32), "as_before": none.astype(np.int32),
                    "flags": none.astype(bool), "ids": ids.slice(0, 0),
                }
                out = [empty | {
                    "bucket": int(own_rows[0]) % buckets, "rows": own_rows, "flags": flags.astype(bool),
                    "sizes": np.zeros(texts, dtype=np.int64),
                    "ids": ids.slice(c.at, texts), "lengths": c.lengths, **sums, **rare,
                }]
                for bucket, text, name, n in parts:
                    sizes = np.bincount(text, minlength=texts)
                    held = sizes > 0
                    out.append(empty | {
                        "bucket": bucket, "rows": own_rows[held], "flags": flags[held].astype(bool), "sizes": sizes[held],
                        "pairs": name, "n": n,
                    })
                arrays = [pa.array([o["bucket"] for o in out], pa.int64())]
                arrays += [lists([o[f] for o in out]) for f in fields[1:]]
                yield pa.RecordBatch.from_arrays(arrays, names=fields)

    return deal


def _settle_bucket(models: Models, kind: pa.DataType):
    """The function that counts a bucket's pairs and adds up by row what they take from the losses."""

    def flat(dealt: pa.Table, name: str) -> np.ndarray:
        return pa.concat_arrays(dealt.column(name).chunks).flatten().to_numpy(zero_copy_only=False)

    def settle(dealt: pa.Table) -> pa.Table:
        rows, flags, sizes = flat(dealt, "rows"), flat(dealt, "flags").astype(np.int64), flat(dealt, "sizes")
        name, n = flat(dealt, "pairs"), flat(dealt, "n").astype(np.int64)
        known_rows, place = np.unique(rows, return_inverse=True)
        row, own = np.repeat(place.astype(np.int32), sizes), np.repeat(flags.astype(bool), sizes)
        order = np.argsort(name)
        name, n, row, own = name[order], n[order], row[order], own[order]
        first = np.concatenate(([True], name[1:] != name[:-1]))[: len(name)]
        which = np.cumsum(first) - 1
        sums = {}
        for m in MODELS:
            mine = n * own if m == "target" else n
            of_pair = np.zeros(int(first.sum()), dtype=np.int64)
            np.add.at(of_pair, which, mine)
            others = of_pair[which] - mine
            held = others > 0
            total = np.zeros(len(known_rows), dtype=np.int64)
            np.add.at(total, row[held], -n[held] * models.of_pair(m, others[held]))
            sums[m] = total
        changed = (sums["target"] != 0) | (sums["background"] != 0)
        # The chunks' own sums, and their words that are not carried.
        whole = dealt.filter(pa.compute.greater(pa.compute.list_value_length(dealt.column("ids")), 0))
        w_rows = flat(whole, "rows") if whole.num_rows else rows[:0]
        w_flags = flat(whole, "flags").astype(bool) if whole.num_rows else flags[:0].astype(bool)
        w_ids = pa.concat_arrays(whole.column("ids").chunks).flatten() if whole.num_rows else pa.nulls(0, kind)
        rare_sizes = flat(whole, "rare_sizes") if whole.num_rows else sizes[:0]
        whole_or_none = (lambda f: flat(whole, f).astype(np.int64)) if whole.num_rows else (lambda f: sizes[:0])
        rare = whole_or_none("rare")
        n_sums, n_texts, n_rare = int(changed.sum()), len(w_rows), len(rare)

        def column(*parts, type=pa.int64()) -> pa.Array:
            return pa.concat_arrays([pa.nulls(p, type) if isinstance(p, int) else pa.array(p, type) for p in parts])

        return pa.table({
            "row": column(known_rows[changed], w_rows, np.repeat(w_rows, rare_sizes)),
            "doc_id": pa.concat_arrays([pa.nulls(n_sums, kind), w_ids.cast(kind), pa.nulls(n_rare, kind)]),
            "word": column(n_sums, n_texts, rare),
            "is_target": column(n_sums, w_flags, np.repeat(w_flags, rare_sizes), type=pa.bool_()),
            "n_tokens": column(n_sums, whole_or_none("lengths"), n_rare),
            "as_word": column(n_sums, n_texts, whole_or_none("as_word")),
            "as_before": column(n_sums, n_texts, whole_or_none("as_before")),
            "target": column(sums["target"][changed], whole_or_none("target"), n_rare),
            "background": column(sums["background"][changed], whole_or_none("background"), n_rare),
        })

    return settle


def _sorted_arrays(df: DataFrame, key: str, columns: list[str]) -> dict[str, np.ndarray]:
    """A table of a proven bound as arrays, sorted by its key."""
    rows = df.select(key, *columns).toArrow()
    order = np.argsort(rows.column(key).to_numpy())
    return {c: rows.column(c).to_numpy()[order] for c in (key, *columns)}


def score_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, score) for every row of ``docs`` (doc_id, text, is_target)."""
    counts = ["target", "background", "before_target", "before_background"]
    words = stage(count_words(docs).withColumn("n", F.col("background") + F.col("before_background")), "words")
    size, target, background = words.agg(
        F.count_if(F.col("background") > 0), F.sum("target"), F.sum("background")
    ).first()
    models = Models(size, target or 0, background or 0)
    total = background or 0

    least = carried_from(words, CARRIED_WORDS)
    carried = _sorted_arrays(words.where(F.col("n") >= least), "word", counts)
    often = max(BUCKET_PAIRS // 16, total // MOST_HOT_PAIRS, 1)
    hot_words = words.where((F.col("background") >= often) | (F.col("before_background") >= often)).select("word").toArrow()
    hot_pairs = count_hot_pairs(docs, np.sort(hot_words.column("word").to_numpy().view(np.uint64)), often)
    hot = _sorted_arrays(hot_pairs, "pair", list(MODELS))
    buckets = max(-(-total // BUCKET_PAIRS), min(LEAST_BUCKETS, -(-total * 16 // BUCKET_PAIRS)), 1)

    field = docs.select("doc_id").schema["doc_id"].dataType
    kind, arrow_kind = field.simpleString(), docs.select("doc_id").limit(0).toArrow().schema.field("doc_id").type
    dealt = docs.select("row", "doc_id", "text", "is_target").mapInArrow(
        _deal(models, carried, hot, buckets, arrow_kind), DEALT.format(kind=kind)
    )
    settled = dealt.groupBy("bucket").applyInArrow(_settle_bucket(models, arrow_kind), SUMS.format(kind=kind))
    by_row = stage(
        settled.groupBy("row", "word").agg(
            F.max("doc_id").alias("doc_id"),
            F.max("is_target").alias("is_target"),
            *[F.sum(c).alias(c) for c in ("n_tokens", "as_word", "as_before", *MODELS)],
        ),
        "losses",
    )

    # Words that are not carried: the same formulas, joined to their counts.
    def rare_part(model: str) -> Column:
        own = F.col("is_target").cast("long") if model == "target" else F.lit(1)

        def units(value: Column) -> Column:
            return F.rint(F.log(value) / 2 * UNIT).cast("long")

        before = models.as_before(model, F.col(f"c_before_{model}") - own * F.col("as_before"))
        alone = models.as_word(model, F.col(f"c_{model}") - own * F.col("as_word"))
        return (F.col("as_before") * units(before) - F.col("as_word") * units(alone)).alias(model)

    rare_words = words.where(F.col("n") < least).select("word", *[F.col(c).alias(f"c_{c}") for c in counts])
    rare = by_row.where("word is not null").join(rare_words, "word").select("row", *map(rare_part, MODELS))
    summed = (
        by_row.where("word is null").select("row", "doc_id", "n_tokens", *MODELS)
        .unionByName(rare, allowMissingColumns=True)
        .groupBy("row")
        .agg(F.max("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in ("n_tokens", *MODELS)])
    )

    def mean(units: Column) -> Column:
        return F.when(F.col("n_tokens") > 0, units / (F.col("n_tokens") * F.lit(UNIT)))

    return summed.select(
        "doc_id",
        "n_tokens",
        *[mean(F.col(m)).alias(f"{m}_loss") for m in MODELS],
        mean(F.col("target") - F.col("background")).alias("score"),
    )


def cross_entropy_difference(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    """Scores of all ``docs`` (doc_id, text) towards the documents named in ``target_ids``."""
    wanted = target_ids.where("doc_id is not null").select(F.col("doc_id").alias("target_id")).distinct()
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    marked = numbered.join(bounded_broadcast(wanted, 2_000_000), F.col("doc_id") == F.col("target_id"), "left")
    return score_documents(marked.select("row", "doc_id", "text", F.col("target_id").isNotNull().alias("is_target")))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents towards those labelled to be of quality."""
    good = table(spark, sf_dir, "labels").where("quality = 1")
    found = cross_entropy_difference(table(spark, sf_dir, "documents"), good.select("doc_id"))
    rounded = [F.round(c, 6).alias(c) for c in ("target_loss", "background_loss", "score")]
    return found.select("doc_id", "n_tokens", *rounded)
