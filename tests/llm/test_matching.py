"""Decontamination, similarity join, line runs, components, and the pipeline."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from llm_frames import LONG, documents
from pyspark.sql import functions as F

import corpus_pipeline
from chartloom.llm import components, ngram_join
from chartloom.llm import decontamination as dc
from chartloom.llm.components import connected_components
from chartloom.llm.line_runs import dedup_lines
from chartloom.llm.ngram_join import by_block_pair, link_components, needed, one_of_each_component, search_links, shingles, threshold

ITEMS = "item_id long, text string, words int"


def closure(pairs, nodes):
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in pairs:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def test_components(spark):
    random.seed(3)
    pairs = [(random.randrange(300), random.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 480)]
    found = connected_components(spark.createDataFrame(pairs + [(None, 3)], "a long, b long")).collect()
    linked = {n for a, b in pairs if a != b for n in (a, b)}
    assert {r["node"]: r["component"] for r in found} == closure(pairs, linked)
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_components_around_crowded_nodes(spark, monkeypatch):
    monkeypatch.setattr(components, "MANY_NEIGHBOURS", 20)
    rng = random.Random(5)
    pairs = [(500, i) for i in range(501, 900)] + [(3, i) for i in range(1_000, 1_100)] + [(899, 950), (950, 1_050), (1_099, 2)]
    pairs += [(rng.randrange(2_000, 2_300), rng.randrange(2_000, 2_300)) for _ in range(150)] + [(i, i + 1) for i in range(3_000, 3_040)]
    pairs += [(i, 2_500) for i in range(2_501, 2_540)] + pairs[:50]
    rng.shuffle(pairs)
    found = connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in found} == closure(pairs, {n for a, b in pairs if a != b for n in (a, b)})
    assert len(found) == len({r["node"] for r in found})


def test_edges_of_a_crowded_node_stay_apart(spark):
    """Of a node with most edges, no task of the join by hash gets any."""
    edges = spark.range(5_000).select(F.col("id").alias("b"), F.when(F.col("id") % 10 < 8, 10_000).otherwise(F.col("id") + 20_000).alias("a"))
    plan = components._star(edges, False, 1_000)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and plan.count("strategy=broadcast") >= 2
    found = {(r["a"], r["b"]) for r in components._star(edges, False, 1_000).collect()}
    assert found == {(r["a"], r["b"]) for r in components._star(edges, False, 1_000_000).collect()}


def near_copies(seed, n_groups=6, copies=9):
    """Groups of texts that differ in a few words, and texts with a common passage."""
    rng = random.Random(seed)
    word = lambda: f"v{rng.randrange(4000)}"
    common = [word() for _ in range(40)]
    texts = []
    for _ in range(n_groups):
        base = [word() for _ in range(rng.choice((30, 90, 400)))]
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 40))):
                own[rng.randrange(len(own))] = word()
            texts.append(" ".join(own))
    texts += [" ".join(common + [word() for _ in range(rng.randrange(5, 60))]) for _ in range(20)]
    texts += [" ".join(word() for _ in range(rng.randrange(1, 12))) for _ in range(20)]
    return texts


def brute_links(texts):
    sets = {i: frozenset(shingles(t).tolist()) for i, t in texts.items()}
    return [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_join_finds_all_links(spark, seed):
    texts = dict(enumerate(near_copies(seed)))
    found = link_components(documents(spark, list(texts.items()))).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == closure(brute_links(texts), texts)


def test_blocks_give_the_same_components(spark, monkeypatch):
    texts = dict(enumerate(near_copies(5, n_groups=2, copies=25)))
    monkeypatch.setattr("chartloom.llm.ngram_join.BLOCK_HASHES", 1_000)
    found = link_components(documents(spark, list(texts.items()))).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == closure(brute_links(texts), texts)


def test_search_is_a_forest_of_all_links():
    texts = dict(enumerate(near_copies(9)))
    sets = [shingles(t) for t in texts.values()]
    links = search_links(sets)
    assert closure(links, texts) == closure(brute_links(texts), texts) and len(links) < len(texts)


def test_common_shingles_alone_tie_nothing(spark, monkeypatch):
    """Texts of few words share most shingles, as those of a large table do; only near copies are compared."""
    rng = random.Random(11)
    text = lambda: [f"w{rng.randrange(9)}" for _ in range(150)]
    texts = [text() for _ in range(300)]
    texts += [[*t[:i], "other", *t[i + 1 :]] for t in texts[:20] for i in (5, 140)]
    rows = {i: " ".join(t) for i, t in enumerate(texts)}
    seen, links = [], ngram_join.class_links

    def counted(docs, candidates, *rest):
        seen.append(candidates.count())
        return links(docs, candidates, *rest)

    monkeypatch.setattr(ngram_join, "class_links", counted)
    found = link_components(documents(spark, list(rows.items()))).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == closure(brute_links(rows), rows)
    assert 60 <= seen[0] < 80


@pytest.mark.parametrize("percent", [50, 80, 85, 100])
def test_linked_sets_share_parts(percent):
    """Also where all differences meet in as many parts as they can, and in bands of different sizes."""
    rng = random.Random(percent)
    scheme = ngram_join.PartScheme(percent)
    for n in [*range(1, 80), 163, 164, 260, 261, 400]:
        own = sorted(rng.getrandbits(64) for _ in range(n))
        for m in {-(-percent * n // 100), n, 100 * n // percent}:
            both = n + m
            overlap = -(-percent * both // (100 + percent))
            if not 0 < overlap <= min(n, m) or overlap == n == m:
                continue
            members = sorted(rng.sample(own, overlap) + [rng.getrandbits(64) for _ in range(m - overlap)])
            tokens = [np.array(x, dtype=np.uint64) for x in (own, members)]
            tokens = [scheme.tokens(x).tolist() for x in tokens]
            band = max(scheme.bands(n)[0], scheme.bands(m)[0])
            assert band in scheme.bands(n) and band in scheme.bands(m)
            shared = sum(t % ngram_join.BANDS == band for t in set(tokens[0]) & set(tokens[1]))
            assert shared >= scheme.shared(n, band) > 0 and shared >= scheme.shared(m, band) > 0


def test_shared_parts_by_column(spark):
    scheme = ngram_join.PartScheme(85)
    rows = [(n, band) for n in [6, 7, 16, 17, 100, 1_000, 123_456] for band in scheme.bands(n)]
    found = spark.createDataFrame(rows, "n long, band long").select("*", scheme.shared_column(F.col("n"), F.col("band")).alias("shared"))
    assert [r["shared"] for r in found.orderBy("n", "band").collect()] == [scheme.shared(*r) for r in sorted(rows)]
    assert len(scheme.tops) <= ngram_join.BANDS


def test_needed_is_the_least_over_all_partners():
    shared = lambda n: min(n, max(64, -(-n // 5))) - (n - threshold(n))
    for n in [*range(1, 700), 1_000, 1_777, 5_000, 12_345]:
        partners = range(threshold(n), 100 * n // 85 + 1)
        assert 1 <= needed(n) <= max(1, min(map(shared, partners)))


def test_odd_rows_in_the_join(spark, odd, none, clashing):
    found = sorted(((r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in link_components(clashing).collect()), key=repr)
    assert (5, 12, 5) in found and found.count((5, 12, 5)) == 2 and (6, 12, 5) in found
    assert (1, 0, 1) in found and (2, 0, 2) in found and (3, 0, 3) in found and (7, 1, 7) in found
    assert (4, 2, 4) in found and len(found) == odd.count() and all(c is None for i, _, c in found if i == 0)
    assert link_components(none).collect() == []
    kept = one_of_each_component(clashing)
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 0, 1, 2, 3, 4, 5, 7] and kept.columns == clashing.columns


def brute_runs(docs, min_words):
    """Lines to delete: in any run of enough words with an earlier equal one, by trying them all."""
    rows = []
    for key, text in docs:
        lines = (text or "").split("\n")
        places = [i for i, line in enumerate(lines) if line.split()]
        rows.append((key, [lines[i] for i in places], places))
    first, gone = {}, [set() for _ in rows]
    for d, (_, lines, places) in enumerate(rows):
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                run = tuple(lines[a:b])
                if sum(len(x.split()) for x in run) >= min_words:
                    at = first.setdefault(run, (d, a))
                    if at[0] < d or at[1] + len(run) <= a:
                        gone[d].update(places[a:b])
    return {key: sorted(g) for (key, _, _), g in zip(rows, gone)}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_runs_against_trying_all(spark, seed):
    rng = random.Random(seed)
    pool = [" ".join(f"w{rng.randrange(9)}" for _ in range(rng.randrange(1, 9))) for _ in range(12)] + ["", "  "]
    shared = [[rng.choice(pool) for _ in range(rng.randrange(2, 14))] for _ in range(5)]
    docs = []
    for key in range(30):
        lines = []
        for _ in range(rng.randrange(0, 4)):
            lines += rng.choice(shared) if rng.random() < 0.6 else [rng.choice(pool) for _ in range(rng.randrange(5))]
        docs.append((key, "\n".join(lines)))
    found = dedup_lines(documents(spark, docs), min_words=20).collect()
    assert {r["doc_id"]: r["deleted_lines"] for r in found} == brute_runs(docs, 20)
    texts = dict(docs)
    for r in found:
        lines = texts[r["doc_id"]].split("\n")
        assert r["text"] == "\n".join(x for i, x in enumerate(lines) if i not in r["deleted_lines"])


def test_odd_rows_by_line_runs(spark, odd, none, clashing):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(1, passage), (1, passage), (2, f"own\n{passage}\nend"), (None, passage), (3, None), (3, None), (4, "")]
    found = sorted(((r["doc_id"] or 0, r["copy"], r["n_deleted"], r["text"]) for r in dedup_lines(documents(spark, rows)).collect()), key=repr)
    assert found == sorted([(0, 1, 0, passage), (1, 1, 1, ""), (1, 2, 1, ""), (2, 1, 1, "own\nend"), (3, 1, 0, None), (3, 2, 0, None), (4, 1, 0, "")], key=repr)
    assert dedup_lines(none).collect() == [] and dedup_lines(clashing).count() == odd.count()


def bench(spark, rows):
    return spark.createDataFrame([(i, t, 1) for i, t in rows], ITEMS)


def test_phrases_and_near_matches(spark):
    item = " ".join(f"q{i}" for i in range(20))
    scattered = "q3 then q1 filler q2 here q0 and q4 q5 q6 q7 q8 q9 q10 q11 q12"
    docs = documents(spark, [(1, f"so {item.upper()} it goes"), (2, scattered), (3, item.replace("q7", "x")), (4, "q0 " * 40)])
    texts = dc.keyed_words(docs, "doc_id", "text")
    index, windows = dc.prepare(texts, bench(spark, [(9, item)]))
    hits = dc.exact_hits(dc.candidate_windows(index, windows), texts, windows)
    assert {(r["doc"]["id"], r["start"]) for r in hits.collect()} == {(1, s) for s in range(8)}
    near = {r["doc"]["id"]: r["span"] for r in dc.near_matches(index, windows).collect()}
    assert set(near) >= {1, 2} and 4 not in near


def test_contamination_odd_rows(spark, odd, none, clashing):
    item = "the same words again and again here they stand twice over for all"
    found = dc.contamination(clashing, bench(spark, [(1, item), (1, item), (None, "one"), (2, None), (3, "")])).collect()
    by_id = {r["doc"]["id"]: r for r in found if r["doc"]["id"]}
    assert (by_id[5]["n_rows"], by_id[5]["n_hit"], by_id[5]["items"]) == (2, 13, ["1"])
    assert (by_id[7]["n_hit"], by_id[7]["items"], by_id[1]["n_words"], by_id[4]["n_words"]) == (1, [""], 0, 30_001)
    assert sum(r["n_rows"] for r in found) == odd.count()
    assert dc.contamination(none, bench(spark, [(1, item)])).collect() == []
    assert all(r["n_hit"] == 0 for r in dc.contamination(odd, bench(spark, [])).collect())
    kept = dc.without_contaminated(clashing, bench(spark, [(1, item)]))
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 0, 1, 2, 3, 4, 7] and kept.columns == clashing.columns


def test_pipeline_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    before = None
    for name, function in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(function(spark, docs, small), f"test-{name}")
        ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert ids and (before is None or ids <= before)
        assert docs.columns[: len(columns)] == columns
        before = ids
    given = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    assert docs.select("doc_id", "text").distinct().exceptAll(given).isEmpty()


def test_pipeline_with_clashing_names(spark, small, tables):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    more = docs.select("*", *[F.concat(F.lit("own "), F.col("doc_id").cast("string")).alias(c) for c in ("Shard", "copy", "rate", "place", "__doc1")])
    rest = {name: spark.read.parquet(f"{small}/{name}.parquet") for name in ("labels", "benchmark")}
    found = corpus_pipeline.run(spark, tables(documents=more, **rest))
    assert found.columns == [*docs.columns, "copy", "rate", "place", "__doc1", "shard", "slot"]
    rows = found.collect()
    assert rows and all(r["copy"] == r["rate"] == r["place"] == f"own {r['doc_id']}" for r in rows)


def test_texts_of_one_id_are_judged_apart(spark):
    same, clean = "a b c d e f g h i j k l", "q r s t u v w x y z 1 2 3"
    docs = documents(spark, [(1, same), (2, same), (2, clean), (2, clean), (3, clean + " 4"), (None, same)])
    kept = [(r["doc_id"], r["text"]) for r in one_of_each_component(docs).collect()]
    assert sorted(kept, key=str) == sorted([(1, same), (2, clean), (None, same)], key=str)  # 3 is near 2's other text
    named = docs.withColumn("doc_id", F.concat(F.lit("id"), F.col("doc_id").cast("string")))
    assert sorted(r["doc_id"] for r in one_of_each_component(named).where("doc_id is not null").collect()) == ["id1", "id2"]


def test_block_pairs_of_one_component_use_many_tasks(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
                "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        sets = spark.range(300).select(F.lit(1).cast("long").alias("part"), F.col("id").alias("doc"), (F.col("id") % 30).cast("int").alias("block"))
        placed = sets.join(sets.select("part").distinct(), "part")
        pairs = placed.select("*", F.explode(F.sequence(F.lit(0), F.lit(29))).alias("other")).select(
            "part", F.least("block", "other").alias("low_block"), F.greatest("block", "other").alias("high_block"), "doc"
        )

        def where(rows):
            import pandas as pd
            from pyspark import TaskContext

            return pd.DataFrame({"task": [TaskContext.get().partitionId()], "pairs": [rows[["low_block", "high_block"]].drop_duplicates().shape[0]]})

        found = by_block_pair(pairs).applyInPandas(where, "task int, pairs int").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(found) == 465 and all(r["pairs"] == 1 for r in found) and len({r["task"] for r in found}) == 16


def test_pipeline_of_odd_and_empty_tables(spark, odd, none, tables):
    labels = spark.createDataFrame([(5, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    items = bench(spark, [(1, LONG)])
    folder = tables(documents=odd, labels=labels, benchmark=items)
    found = corpus_pipeline.run(spark, folder)
    assert {r["doc_id"] for r in found.collect()} <= {r["doc_id"] for r in odd.collect()} - {6, 4}
    assert corpus_pipeline.run(spark, tables(documents=none, labels=labels, benchmark=items)).collect() == []


def test_near_duplicates_at_five_words_and_80_percent(spark):
    rng = random.Random(4)
    texts = []
    for _ in range(8):
        base = [f"v{rng.randrange(4000)}" for _ in range(rng.choice((60, 300, 700)))]
        texts.append(" ".join(base))
        for share in (8, 6, 5, 4):  # an added paragraph: a passage of so many parts of a hundred, three times
            texts.append(" ".join(base + [f"n{rng.randrange(10**6)}" for _ in range(len(base) * share * 3 // 100)]))
    sets = {i: frozenset(shingles(t, 5).tolist()) for i, t in enumerate(texts)}
    shares = {(a, b): 100 * len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in sets for b in sets if a < b}
    links = [pair for pair, share in shares.items() if share >= 80]
    assert any(80 <= share < 84 for share in shares.values())
    docs = documents(spark, list(enumerate(texts)))
    found = link_components(docs, 5, 80).collect()
    wanted = closure(links, sets)
    assert {r["doc_id"]: r["component_id"] for r in found} == wanted
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert {r["doc_id"] for r in kept.collect()} == set(wanted.values())


def test_needed_at_80_percent():
    shared = lambda n: min(n, max(64, -(-n // 4))) - (n - threshold(n, 80))
    for n in [*range(1, 700), 1_000, 1_777, 5_000, 12_345]:
        partners = range(threshold(n, 80), 100 * n // 80 + 1)
        assert 1 <= needed(n, 80) <= max(1, min(map(shared, partners)))


def test_near_matches_of_every_window(spark):
    item = [f"q{i}" for i in range(60)]
    late = " ".join(item[43:46] + ["x", "y"] + item[40:43] + item[46:56])  # reordered, from the item's end
    docs = documents(spark, [(1, late), (2, " ".join(item)), (3, " ".join(f"{w} {'z ' * 30}" for w in item[40:56]))])
    index, windows = dc.prepare(dc.keyed_words(docs, "doc_id", "text"), bench(spark, [(9, " ".join(item))]))
    near = {r["doc"]["id"]: r["span"] for r in dc.near_matches(index, windows).collect()}
    assert set(near) == {1, 2} and all(span <= 20 for span in near.values())


def test_near_matches_against_every_stretch(spark):
    rng = random.Random(3)
    word = lambda: f"v{min(int(rng.expovariate(0.12)), 40)}"
    texts = {i: [word() for _ in range(rng.choice([0, 3, 20, 80]))] for i in range(40)}
    items = {i: [word() for _ in range(rng.choice([1, 2, 5, 13, 20]))] for i in range(12)}
    counts = Counter(w for t in texts.values() for w in t)
    sets = set()  # item, length, rarest terms
    for i, t in items.items():
        size = min(len(t), dc.WINDOW_WORDS)
        for start in range(len(t) - size + 1):
            rarest = sorted((counts[t[k]], t[k], k) for k in range(start, start + size))[: dc.RAREST]
            if rarest[0][0]:
                sets.add((i, size, frozenset(w for _, w, _ in rarest)))
    wanted = {}
    for d, t in texts.items():
        for item, size, terms in sets:
            for length in range(1, size + dc.SLACK + 1):
                if any(terms <= set(t[k : k + length]) for k in range(len(t) - length + 1)):
                    wanted[d, str(item)] = min(length, wanted.get((d, str(item)), length))
                    break
    docs = documents(spark, [(i, " ".join(t)) for i, t in texts.items()])
    benchmark = bench(spark, [(i, " ".join(t)) for i, t in items.items()])
    index, windows = dc.prepare(dc.keyed_words(docs, "doc_id", "text"), benchmark)
    found = {(r["doc"]["id"], r["item_id"]): r["span"] for r in dc.near_matches(index, windows).collect()}
    assert found == wanted and len(wanted) > 20
    rows = {r["doc"]["id"]: r for r in dc.contamination(docs, benchmark).collect()}
    for d in texts:
        own = [span for (doc, _), span in wanted.items() if doc == d]
        assert (rows[d]["n_near_items"], rows[d]["least_span"]) == (len(own), min(own, default=0))
