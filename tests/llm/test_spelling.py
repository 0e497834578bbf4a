"""Spelling variants against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from llm_frames import documents

from chartloom.llm import spelling as sp


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def deletions(word):
    return {word[:i] + word[i + 1 :] for i in range(len(word))}


def brute_force(counts):
    by_part = {}
    for w in counts:
        for part in {*((i, w[:i], w[i + 1 :]) for i in range(len(w)))} | {(d,) for d in deletions(w) | {w}}:
            by_part.setdefault(part, []).append(w)
    partners = {w: set() for w in counts}
    for words in by_part.values():
        for a in words:
            partners[a].update(b for b in words if near(a, b))
    form = {}
    for w, theirs in partners.items():
        best = min(theirs, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best and counts[best] >= 5 * counts[w] else None
    rows = {}
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        rows[w] = (form[w], root, counts[w], len(partners[w]), counts[form[w]] if form[w] else None)
    return rows


def rows(found):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in found.collect()}


@pytest.mark.parametrize("list_words", [2, 50])
def test_same_as_brute_force(spark, list_words):
    rng = random.Random(8)
    counts = Counter()
    for _ in range(150):
        word = "".join(rng.choice("abeéno") for _ in range(rng.randrange(6, 14)))
        counts[word] += rng.randrange(5, 40_000)
        for _ in range(rng.randrange(6)):
            at = rng.randrange(len(word))
            word = rng.choice((word[:at] + word[at + 1 :], word[:at] + rng.choice("abéz") + word[at:], word[:at] + "z" + word[at + 1 :]))
            if len(word) >= 6:
                counts[word] += rng.randrange(5, 300)
    counts["a" * 6] = counts["a" * 7] = 9
    table = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    assert rows(sp.spelling_variants(table, list_words=list_words)) == brute_force(counts)


def test_whole_query(spark, small):
    counts = Counter()
    for row in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", row["text"] or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{row['doc_id']}:{word}".encode())
            if h % 199 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= 6:
                counts[word] += 1
    counts = Counter({w: n for w, n in counts.items() if n >= 5})
    found = rows(sp.op13_spelling(spark, small))
    assert found == brute_force(counts) and any(row[0] for row in found.values())


def test_bounds_of_single_edits():
    rng = random.Random(9)
    extended = {"<a", "an", "ana", "na", "nan", "anan", "n>"}
    for _ in range(2_000):
        word = "".join(rng.choice("anb") for _ in range(rng.randrange(6, 12)))
        at = rng.randrange(len(word) + 1)
        other = rng.choice((word[:at] + "n" + word[at:], word[:at] + word[at + 1 :], word[:at] + "a" + word[at + 1 :]))
        (grams, bound), (others, _) = sp.decomposed(word, extended), sp.decomposed(other, extended)
        assert len(grams) == len(word) + 1 and len(set(grams) & set(others)) >= len(grams) - bound


def test_odd_rows(spark, odd, none, clashing):
    assert sp.spelling_variants(sp.word_counts(none)).collect() == []
    found = rows(sp.spelling_variants(sp.word_counts(clashing, least_count=1)))
    assert found == {"without": (None, "without", 1, 0, None), "enough": (None, "enough", 1, 0, None)}
    repeated = documents(spark, [(1, "Étable étable ÉTABLE stable" + " stable" * 30)] * 2)
    assert rows(sp.spelling_variants(sp.word_counts(repeated))) == {"stable": (None, "stable", 62, 0, None)}
