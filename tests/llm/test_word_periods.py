"""Periodic runs of words against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from chartloom.llm import word_periods as wp


def brute_force(words):
    """Stretches that no neighbour extends, by every period."""
    runs, n = set(), len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q):
                same = lambda p: all(words[k] == words[k + p] for k in range(i, i + length - p))  # noqa: B023, E731
                if not any(same(p) for p in range(1, q)):
                    runs.add((i, length, q))
            i = j + 1
    return sorted(runs, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=90))
def test_runs_of_few_words(words):
    assert wp.word_runs(words) == brute_force(words)


def test_runs_that_touch_and_nest():
    rng = random.Random(7)
    for _ in range(150):
        words = []
        for _ in range(rng.randrange(1, 6)):
            unit = [rng.choice("abcdexyz") for _ in range(rng.randrange(1, 30))]
            words += unit * rng.randrange(1, 7) + unit[: rng.randrange(len(unit) + 1)]
        words = [w.encode() for w in words]
        assert wp.word_runs(words) == brute_force(words)


def expected(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    runs = brute_force(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    sha = lambda data: hashlib.sha256(data).hexdigest()
    return (
        len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
        sha("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()),
        sha(b" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def test_whole_query(spark, small):
    names = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    found = {r["doc_id"]: tuple(r[c] for c in names) for r in wp.op12_word_periods(spark, small).collect()}
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    some = [r for r in docs if len(r["text"].split()) < 300]
    some += [r for r in docs if zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0 and 300 <= len(r["text"].split()) < 1_200]
    assert len(found) == len(docs) and len(some) > 100
    assert {r["doc_id"]: expected(r["doc_id"], r["text"]) for r in some}.items() <= found.items()
    assert any(row[0] for row in found.values())


def test_odd_rows(spark, odd, none, clashing):
    found = wp.periodic_runs(clashing).collect()
    assert len(found) == odd.count()
    by_id = {r["doc"]: r for r in found if r["doc"] is not None}
    assert [tuple(r) for r in by_id[4]["runs"]] == [(0, 30_000, 1)] and by_id[4]["collapsed"] == "word end."
    assert all(by_id[i]["collapsed"] == "" and by_id[i]["runs"] == [] for i in (1, 2, 3))
    assert wp.periodic_runs(none).collect() == []
    assert wp.op12_word_periods.__doc__ and wp.repeat_planted(None, [b"x"]) == [b"x"]
