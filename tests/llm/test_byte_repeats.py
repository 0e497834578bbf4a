"""Repeated byte strings against brute force, and the sorts by themselves."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from llm_frames import LONG, documents

from chartloom.llm import byte_repeats as br


def brute_force(texts, min_bytes=400):
    data = [(t or "").encode() for t in texts]
    counts = Counter(d[i : i + min_bytes] for d in data for i in range(len(d) - min_bytes + 1))
    found = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - min_bytes + 1):
            if counts[d[i : i + min_bytes]] > 1:
                gone[i : i + min_bytes] = b"\1" * min_bytes
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(b for b, g in zip(d, gone) if not g)
        found.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return found


def awkward_texts(seed):
    """Copies, near copies, passages that texts share at different places, periodic and foreign text."""
    rng = random.Random(seed)
    word = lambda: rng.choice(("été", "w", "über", "x" * 9)) + str(rng.randrange(3000))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, base = prose(120), prose(500).split(" ")
    texts = [prose(rng.randrange(1, 300)) for _ in range(20)]
    texts += [prose(rng.randrange(40)) + passage + prose(rng.randrange(40)) for _ in range(6)]
    texts += [prose(10) + passage[rng.randrange(200) : rng.randrange(420, 800)] + prose(9) for _ in range(30)]
    for _ in range(30):
        own = list(base)
        for _ in range(rng.randrange(1, 9)):
            own[rng.randrange(len(own))] = word()
        texts.append(" ".join(own))
    texts += [" ".join(base)] * 3
    texts += ["-" * 900, "=" * 399, "=" * 400, "ab" * 700, passage + prose(5) + passage, prose(300) + "\0" * 500, "\0" * 450 + "end"]
    texts += ["y" * 399 + "z" * 30, "y" * 399, None, "", "short"]
    return texts


def rows(found):
    listed = found.collect()
    return {
        r["doc"]: (
            r["n_bytes"], sum(s["end"] - s["begin"] for s in r["spans"]), len(r["spans"]), hashlib.sha256(bytes(r["kept"])).hexdigest()
        )
        for r in listed
    }


@pytest.mark.parametrize(("seed", "sizes"), [(1, {}), (2, {"hot_members": 4}), (3, {"bucket_bytes": 5_000})])
def test_same_as_brute_force(spark, seed, sizes):
    texts = awkward_texts(seed)
    docs = documents(spark, list(enumerate(texts))).repartition(5)
    assert rows(br.remove_repeats(docs, **sizes)) == dict(enumerate(brute_force(texts)))


def test_whole_query(spark, small):
    texts = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    wanted = dict(zip([r["doc_id"] for r in texts], brute_force([r["text"] for r in texts])))
    names = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert {r["doc_id"]: tuple(r[c] for c in names) for r in br.op11_suffix_dedup(spark, small).collect()} == wanted


def test_odd_rows(spark, odd, none, clashing):
    found = br.remove_repeats(clashing).collect()
    assert len(found) == odd.count() and found[0].asDict().keys() == {"doc", "n_bytes", "spans", "kept"}
    long = next(r for r in found if r["doc"] == 4)
    assert long["n_bytes"] == len(LONG) and bytes(long["kept"]) == LONG[-max(4, len(LONG) - long["spans"][0]["end"]) :].encode()
    assert all(not r["spans"] for r in found if r["doc"] != 4)
    assert br.remove_repeats(none).collect() == []


def test_texts_longer_than_a_chunk(monkeypatch):
    rng = random.Random(5)
    passage = bytes(rng.randrange(97, 123) for _ in range(3000))
    data = passage + bytes(rng.randrange(97, 123) for _ in range(2000)) + passage
    whole = {(int(a), int(h)) for a, h in zip(*br.stretches(data)[2:])}
    monkeypatch.setattr(br, "CHUNK", 700)
    low, n, at, anchor = br.stretches(data)
    assert {(int(a), int(h)) for a, h in zip(at, anchor)} == whole
    assert low[0] == 0 and list(low[1:]) == list((low + n)[:-1]) and low[-1] + n[-1] == len(data) - 399


def test_sorts_with_equal_and_ending_strings():
    rng = random.Random(6)
    strings = [bytes(rng.choice(b"\0ab") for _ in range(rng.randrange(60))) for _ in range(300)]
    strings += [b"q" * 40 + s for s in strings[:150]] + [b"", b"", b"q" * 40, b"\0" * 7, b"\0" * 8]
    assert [strings[i] for i in br.blind_trie_order(strings)] == sorted(strings)
    group = np.array([rng.randrange(3) for _ in strings])
    order, shared = br.deep_shallow_sort(strings, group, 100)
    assert [(group[i], strings[i]) for i in order] == sorted(zip(group, strings))
    common = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    for place, (i, j) in enumerate(zip(order, order[1:]), 1):
        assert shared[place] == (common(strings[i], strings[j]) if group[i] == group[j] else -1)
