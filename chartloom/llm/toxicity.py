"""Toxicity scores by weak supervision.

1. Terms (words and word beginnings) that labelled training rows tie to toxicity are mined
   from a bounded sample of them and dealt to lexicon voters (words) and pattern voters
   (beginnings); fixed lists of common insults and of insulting phrases vote too.
2. A generative label model explains how often each pattern of votes occurs in *all*
   documents: every voter fires with one probability in toxic and another in clean
   documents, estimated by expectation maximisation. Correlations that remain between
   voters within a class discount their votes, so that voters who say the same thing do not
   count twice. Labelled training rows anchor the two classes.
3. A linear classifier over the terms is trained on the label model's posteriors of the
   sampled rows, and scores every whole text. If no sampled row has one of the phrases, their
   weight is what the label model gives their voter.

Passes over the documents: one for the sample's terms, one that turns every document into
a vote pattern (at most 2**14 different ones, counted in each task first), and the scoring
scan. No document, key or source gathers in a task; the driver sees term counts of at most
``terms`` mined terms, the pattern counts and the sample's term numbers.

Labels come only from rows whose crc32 of the id is not divisible by 5. Ids, languages and
sources are no inputs.

Defined cases: null and empty texts have no terms and get the score of a text without any;
labels that are null or have no document are ignored; a document labelled twice is toxic if
one label says so; rows with equal texts get equal scores; a null id is not held out;
without usable labels the fixed lists alone decide; an empty table gives an empty result;
extra columns are ignored, or replaced where the result needs their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom.llm.common import every, stage, table

# Fixed values
FOLDS, HELD_OUT = 5, 0

# Parameters
SAMPLE_ROWS = 20_000  # labelled rows that terms and classifier are fitted on, at most
TERMS = 1_000  # mined terms, at most
MIN_TOXIC, MIN_PRECISION = 6, 0.75  # toxic sample rows of a mined term, and its share of them
PREFIX_LENGTHS = (3, 4, 5, 6, 7)
MINED_VOTERS = 6  # of each kind

# Common insults
INSULTS = frozenset(
    "idiot idiots moron morons stupid dumb trash garbage pathetic disgusting worthless loser losers clown scum"
    " imbecile bastard retard filth vermin arsehole asshole fuck fucking shit bitch"
    " dummkopf arschloch abschaum idiota imbécil estúpido basura connard salope ordure abruti".split()
)
PHRASES = re.compile(
    r"\b(?:shut\s+up|drop\s+dead|kill\s+yourself|go\s+to\s+hell|hate\s+you|piece\s+of\s+(?:trash|garbage|shit)"
    r"|you(?:\s+are|'re)?\s+(?:all\s+)?(?:an?\s+)?(?:idiot|moron|loser|clown|scum|trash|pathetic|stupid|worthless))\b"
)
#: Words of which every phrase has one.
PHRASE_WORDS = frozenset(
    "shut dead yourself hell hate piece idiot moron loser clown scum trash pathetic stupid worthless".split()
)
WORDS = re.compile(r"\w+")


@dataclass
class Terms:
    """Numbered terms, and the voter that each belongs to."""

    words: dict[str, int]
    prefixes: dict[str, int]
    voters: np.ndarray  # voter of each term number

    def __post_init__(self) -> None:
        self.starts = {p[: PREFIX_LENGTHS[0]] for p in self.prefixes}

    @property
    def size(self) -> int:
        return len(self.voters)

    def of(self, text: str | None) -> set[int]:
        """The numbers of the terms in a text."""
        said = (text or "").lower()
        found, spoken = set(), set(WORDS.findall(said))
        for word in spoken:
            if word in self.words:
                found.add(self.words[word])
            if word[: PREFIX_LENGTHS[0]] in self.starts:
                for n in PREFIX_LENGTHS:
                    if word[:n] in self.prefixes:
                        found.add(self.prefixes[word[:n]])
        if not spoken.isdisjoint(PHRASE_WORDS) and PHRASES.search(said):
            found.add(self.size - 1)  # the phrases are the last term
        return found

    def votes(self, found: set[int]) -> int:
        """Bits of the voters that fire."""
        mask = 0
        for term in found:
            mask |= 1 << int(self.voters[term])
        return mask


def make_terms(mined_words: list[str], mined_prefixes: list[str]) -> Terms:
    """Voters: mined words and beginnings dealt out in turn, then insults, then phrases."""
    words, prefixes, voters = {}, {}, []
    for kind, terms, numbers in ((0, mined_words, words), (1, mined_prefixes, prefixes)):
        for place, term in enumerate(terms):
            numbers[term] = len(voters)
            voters.append(kind * MINED_VOTERS + place % MINED_VOTERS)
    for word in sorted(INSULTS - set(words)):
        words[word] = len(voters)
        voters.append(2 * MINED_VOTERS)
    voters.append(2 * MINED_VOTERS + 1)
    return Terms(words, prefixes, np.array(voters))


def held_out(key: Column) -> Column:
    """Rows whose labels are never learned from."""
    rest = F.crc32(key.cast("string").cast("binary")) % FOLDS
    return F.coalesce(rest == HELD_OUT, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(text, toxic) of at most ``rows`` labelled training rows, taken by a hash of the id, then of the text."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = (
        usable.groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    texts = docs.select("doc_id", "text").join(F.broadcast(stage(chosen, "labelled")), "doc_id")  # at most ``rows``
    texts = stage(texts.select("text", "toxic"), "labelled-texts")
    if texts.limit(rows + 1).count() <= rows:
        return texts
    # Ids that repeat bring more rows: those of least hash stay, and of the last hash as many as fit.
    hashed = texts.withColumn("hash", F.xxhash64("text", "toxic"))
    last = hashed.select("hash").orderBy("hash").limit(rows).agg(F.max("hash")).first()[0]
    below = hashed.where(F.col("hash") < last)
    ties = hashed.where(F.col("hash") == last).limit(rows - below.count())
    return stage(below.unionByName(ties).drop("hash"), "labelled-sample")


def _count_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of the sample with each word and beginning, by label, added up for the task."""
    counts: Counter[tuple[str, bool, int]] = Counter()
    for batch in batches:
        for text, toxic in zip(batch["text"], batch["toxic"]):
            words = set(WORDS.findall((text or "").lower()))
            counts.update((word, False, toxic) for word in words)
            counts.update((p, True, toxic) for p in {w[:n] for w in words for n in PREFIX_LENGTHS if len(w) >= n})
    found = [(term, prefix, toxic, n) for (term, prefix, toxic), n in counts.items()]
    if found:
        yield pd.DataFrame(found, columns=["term", "prefix", "toxic", "n"])


def mine_terms(sample: DataFrame, limit: int = TERMS) -> Terms:
    """The terms most tied to toxicity; ties in strength are ordered by the term."""
    counted = sample.mapInPandas(_count_terms, "term string, prefix boolean, toxic int, n long")
    both = counted.groupBy("term", "prefix").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"), F.sum("n").alias("n")
    )
    strong = both.where((F.col("toxic") >= MIN_TOXIC) & (F.col("toxic") >= MIN_PRECISION * F.col("n")))
    strength = F.col("toxic") * F.col("toxic") / F.col("n")
    top = strong.orderBy(F.desc(strength), "prefix", "term").limit(limit).collect()
    return make_terms([r["term"] for r in top if not r["prefix"]], [r["term"] for r in top if r["prefix"]])


def vote_patterns(texts: DataFrame, terms: Terms) -> DataFrame:
    """(votes, ...) for every row: the bits of the voters that fire; other columns stay."""

    @F.pandas_udf(T.IntegerType())
    def votes(series: pd.Series) -> pd.Series:
        return series.map(lambda text: terms.votes(terms.of(text)), na_action=None).astype("int32")

    return texts.withColumn("votes", votes(F.coalesce("text", F.lit("")))).drop("text")


@dataclass
class LabelModel:
    """Posterior of toxicity given the voters that fire."""

    prior: float
    fires: np.ndarray  # (2, voters): probability to fire in clean and in toxic documents
    correlation: np.ndarray  # (voters, voters): what remains within the classes
    weight: np.ndarray  # discount of each voter for saying what others say

    def worth(self) -> np.ndarray:
        """What each voter adds to the log-odds when it fires."""
        one = np.log(self.fires[1]) - np.log(self.fires[0])
        none = np.log1p(-self.fires[1]) - np.log1p(-self.fires[0])
        return (one - none) * self.weight

    def posterior(self, fired: np.ndarray) -> np.ndarray:
        one = np.log(self.fires[1]) - np.log(self.fires[0])
        none = np.log1p(-self.fires[1]) - np.log1p(-self.fires[0])
        odds = np.log(self.prior) - np.log1p(-self.prior) + fired @ (one * self.weight) + (1 - fired) @ (none * self.weight)
        return 1.0 / (1.0 + np.exp(-np.clip(odds, -40, 40)))


def bits(masks: np.ndarray, voters: int) -> np.ndarray:
    return (masks[:, None] >> np.arange(voters) & 1).astype(float)


def fit_label_model(
    patterns: tuple[np.ndarray, np.ndarray], labelled: tuple[np.ndarray, np.ndarray, np.ndarray], voters: int
) -> LabelModel:
    """Expectation maximisation over pattern counts, anchored by counts of labelled patterns.

    ``patterns`` is (masks, counts) of all documents, ``labelled`` is (masks, labels, counts).
    """
    fired, counts = bits(patterns[0], voters), patterns[1].astype(float)
    known, truth, n_known = bits(labelled[0], voters), labelled[1].astype(float), labelled[2].astype(float)
    # A fire is worth more in toxic documents: the pseudo-counts that stand in for labels.
    base = np.array([np.full(voters, 0.02), np.full(voters, 0.3)]) * 2.0

    def estimate(share: np.ndarray) -> tuple[float, np.ndarray]:
        totals = np.zeros(2)
        sums = base.copy()
        for y in (0, 1):
            mass = counts * (share if y else 1 - share)
            own = n_known * (truth == y)
            totals[y] = mass.sum() + own.sum()
            sums[y] += mass @ fired + own @ known
        fires = np.clip(sums / (totals[:, None] + 2.0), 1e-5, 1 - 1e-5)
        return float(np.clip((totals[1] + 0.1) / (totals.sum() + 1.0), 1e-4, 0.5)), fires

    none = np.zeros(len(counts))
    anchor_counts, counts = counts, np.zeros(len(counts))
    prior, fires = estimate(none)  # from the labels alone
    counts = anchor_counts
    model = LabelModel(prior, fires, np.eye(voters), np.ones(voters))
    for _ in range(30):
        share = model.posterior(fired)
        prior, fires = estimate(share)
        left = np.zeros((voters, voters))
        for y in (0, 1):
            mass = counts * (share if y else 1 - share)
            off = fired - fires[y]
            left += off.T @ (off * mass[:, None])
        spread = np.sqrt(np.maximum(np.diag(left), 1e-9))
        correlation = left / np.outer(spread, spread)
        others = np.clip(correlation, 0, 1).sum(axis=1) - 1
        model = LabelModel(prior, fires, correlation, 1.0 / (1.0 + np.maximum(others, 0)))
    return model


def fit_classifier(rows: list[np.ndarray], targets: np.ndarray, size: int, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels: gradient steps with momentum and a ridge penalty."""
    n = len(rows)
    weights, bias = np.zeros(size), -2.0
    if not n:
        return np.full(size, 3.0), bias
    row = np.repeat(np.arange(n), [len(r) for r in rows])
    term = np.concatenate([*rows, np.empty(0, dtype=np.int64)]).astype(np.int64)
    scale = 1.0 / np.sqrt(np.maximum(np.bincount(term, minlength=size), 1.0))  # rare terms step further
    speed, speed_bias = np.zeros(size), 0.0
    for _ in range(rounds):
        odds = bias + np.bincount(row, weights[term], minlength=n)
        miss = targets - 1.0 / (1.0 + np.exp(-np.clip(odds, -40, 40)))
        pull = np.bincount(term, miss[row], minlength=size) * scale - 0.01 * weights
        speed = 0.9 * speed + 0.05 * pull
        speed_bias = 0.9 * speed_bias + 0.5 * miss.mean()
        weights, bias = weights + speed, bias + speed_bias
    return weights, float(bias)


@dataclass
class ToxicityModel:
    terms: Terms
    label_model: LabelModel
    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        odds = self.bias + sum(self.weights[term] for term in self.terms.of(text))
        return float(1.0 / (1.0 + np.exp(-np.clip(odds, -40, 40))))


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Mine terms, fit the label model on all documents, and the classifier on its posteriors."""
    sample = training_sample(docs, labels, rows)
    terms = mine_terms(sample)
    voters = 2 * MINED_VOTERS + 2
    counted = vote_patterns(docs.select("text"), terms).groupBy("votes").count().collect()
    known = vote_patterns(sample, terms).groupBy("votes", "toxic").count().collect()
    as_array = lambda values: np.array(list(values), dtype=np.int64)
    label_model = fit_label_model(
        (as_array(r["votes"] for r in counted), as_array(r["count"] for r in counted)),
        (as_array(r["votes"] for r in known), as_array(r["toxic"] for r in known), as_array(r["count"] for r in known)),
        voters,
    )

    def numbers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield pd.DataFrame({"terms": [sorted(terms.of(text)) for text in batch["text"]]})

    rows_of_terms = [
        np.array(r["terms"], dtype=np.int64) for r in sample.select("text").mapInPandas(numbers, "terms array<int>").collect()
    ]
    masks = as_array(terms.votes(set(r)) for r in rows_of_terms)
    targets = label_model.posterior(bits(masks, voters)) if len(masks) else np.empty(0)
    weights, bias = fit_classifier(rows_of_terms, targets, terms.size)
    if len(masks) and not (masks >> (voters - 1)).any():
        weights[-1] = label_model.worth()[voters - 1]
    return ToxicityModel(terms, label_model, weights, bias)


def score_documents(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on)."""

    @F.pandas_udf(T.DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        return texts.map(model.score, na_action=None).astype("float64")

    kept = every([c for c in docs.columns if c.lower() not in ("score", "predicted")])
    scored = docs.select(*kept, score(F.coalesce(F.col(text), F.lit(""))).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score_documents(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows predicted to be toxic."""
    model = train(docs, labels)

    @F.pandas_udf(T.BooleanType())
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: model.score(text) < 0.5, na_action=None).astype("bool")

    return docs.where(clean(F.coalesce("text", F.lit(""))))
