"""Line rules, page text, scores."""

from __future__ import annotations

import math
import random
import time
from collections import Counter

import numpy as np
import pytest
from llm_frames import LONG, documents
from pyspark.sql import functions as F

from chartloom.llm import lm_scoring
from chartloom.llm.html_text import extract_main_text, main_text
from chartloom.llm.line_rules import clean_lines
from chartloom.llm.toxicity import held_out, op4_toxicity, score_documents, train, without_toxic

PROSE = "This is a plain sentence that has some words in it. And here is another one, of use."


def repeats(text):
    words = text.split()
    counts = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    return len({i + k for i in range(len(words) - 4) if counts[tuple(words[i : i + 5])] > 1 for k in range(5)})


def test_repeated_windows(spark):
    texts = ["a b c d e a b c d e", "a a a a a", "a a a a a a", "a b c d e f g h", LONG, "x " * 7 + "y " * 9, "p q r s t u p q r s t v q r s t u"]
    found = clean_lines(documents(spark, list(enumerate(texts)))).orderBy("doc_id").collect()
    assert [r["n_repeat_words"] for r in found] == [repeats(t) for t in texts]


def test_bad_lines_go_and_rejected_documents(spark):
    more = "Other words stand in this one, and they say nothing that was said above it, at all."
    menu = f"Home | About | News\n{PROSE}\nAll rights reserved.\n{more}"
    junk = "buy ### now $$$ here *** and\nthere %%% is\nmore\nto\nsee"
    rows = clean_lines(documents(spark, [(1, menu), (2, junk), (3, PROSE)])).orderBy("doc_id").collect()
    assert [r["kept"] for r in rows] == [True, False, True]
    assert rows[0]["cleaned_text"].split("\n") == menu.split("\n")[1::2] and rows[0]["n_bad_lines"] == 2


def test_odd_rows_by_line(spark, odd, none, clashing):
    found = {r["doc_id"]: r for r in clean_lines(odd).where("doc_id is not null").collect()}
    assert (found[1]["n_words"], found[1]["cleaned_text"], found[1]["kept"]) == (0, None, False)
    assert (found[2]["cleaned_text"], found[3]["cleaned_text"]) == ("", " \n\t ")
    assert found[4]["base_failed"] and not found[4]["kept"] and found[5]["kept"]
    assert clean_lines(none).collect() == []
    assert clean_lines(clashing).select("n_words", "kept").count() == odd.count()


def test_main_text():
    page = (
        "<html><head><title>T</title><script>var a='<p>no</p>'</script></head><body><header>Site</header>"
        "<nav><ul><li><a href=x>Menu</a></li></ul></nav><div class='side-bar'>Other news, and more, of it.</div>"
        "<article><h1>Head</h1><p>First &amp; <b>bold</b>  text, with words.<p>Second&nbsp;one.<br>Third.</article>"
        "<form>Name</form><section id=comments><p>I think, that this, is wrong.</p></section><footer>&copy; x</footer>"
    )
    assert main_text(page) == "Head First & bold text, with words. Second one. Third."
    assert [main_text(x) for x in (None, "", "<p>", "<!-- x", "<script>x", "a < b", "<p>x &lt; y")] == ["", "", "", "", "", "a < b", "x < y"]
    deep = "<div>" * 3_000 + "<p>Down here, at last.</p>"
    assert main_text(deep) == "Down here, at last."
    assert main_text("<p>" + LONG) == LONG


def test_odd_pages(spark):
    rows = [(1, "u", None, "n"), (1, "u", None, "n"), (None, None, "<p>Text here, of words.</p>", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, Text string")
    found = extract_main_text(pages).collect()
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in found) == [(0, "Text here, of words.", 20), (1, "", 0), (1, "", 0)]
    assert extract_main_text(pages.limit(0)).collect() == []


@pytest.fixture(scope="module")
def labelled(spark):
    rows, labels = [], []
    for i in range(600):
        bad = i % 4 == 0
        words = [f"w{(i * 7 + k * k) % 97}" for k in range(40)]
        if bad:
            words[5::9] = [f"grob{(i + k) % 30}" for k in range(4)]
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_is_learned_from_training_rows(spark, labelled):
    docs, labels = labelled
    flipped = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    model = train(docs, flipped)  # labels that must not matter
    found = score_documents(docs, model).join(labels, "doc_id").where(held_out(F.col("doc_id"))).collect()
    assert len(found) > 60
    assert np.mean([(r["predicted"] == r["toxic"]) for r in found]) > 0.98
    assert without_toxic(docs, labels).count() == pytest.approx(450, abs=6)


def test_odd_rows_by_toxicity(spark, odd, none, clashing, labelled, tables):
    model = train(*labelled)
    scores = {r["doc_id"]: r["score"] for r in score_documents(odd, model).where("doc_id is not null").collect()}
    assert scores[1] == scores[2] == scores[3] < 0.5 and scores[5] == scores[6]
    assert score_documents(clashing, model).count() == odd.count()
    no_labels = spark.createDataFrame([(None, 1, 1), (5, None, None), (99, 1, 1)], "doc_id long, quality int, toxic int")
    found = op4_toxicity(spark, tables(documents=odd, labels=no_labels)).collect()
    assert len(found) == odd.count() and all(0 <= r["score"] <= 1 for r in found)
    assert op4_toxicity(spark, tables(documents=none, labels=no_labels)).collect() == []


def plain_models(texts, targets):
    """For a text left out: each model's probability of a word by itself, and after another one."""
    vocabulary = {w for t in texts.values() for w in t}
    mass = sum(len(texts[i]) for i in targets) or sum(map(len, texts.values()))

    def model(members, out):
        whole = sum(len(texts[i]) for i in members)
        scale = mass / whole if whole else 1.0
        words, before, pairs = Counter(), Counter(), Counter()
        for i in members:
            if i != out:
                words.update(texts[i])
                before.update([None, *texts[i]][: len(texts[i])])
                pairs.update(zip([None, *texts[i]], texts[i]))
        places, total = len(vocabulary) + 1, sum(words.values())
        alone = lambda y: (scale * words[y] + 0.1) / (scale * total + 0.1 * places)
        after = lambda x, y: (scale * pairs[x, y] + 10 / places) / (scale * before[x] + 10)
        return alone, after

    return vocabulary, lambda out: (model(targets, out), model(list(texts), out))


def plain_losses(texts, targets, asked=None):
    _, of = plain_models(texts, targets)
    return {
        i: tuple(
            -sum(math.log(alone(y)) + math.log(after(x, y)) for x, y in zip([None, *t], t)) / 2 / len(t) if t else None
            for alone, after in of(i)
        )
        for i, t in ((i, texts[i]) for i in asked or texts)
    }


ROWS = [(1, "a b a b c"), (2, "a b b"), (3, "c c A"), (4, None), (5, " "), (6, "a b a b c"), (7, "z y")]


@pytest.mark.parametrize("targets", [[2], [1, 2, 6], []])
def test_losses_against_plain_counts(spark, targets):
    docs = documents(spark, ROWS)
    rows = lm_scoring.cross_entropy_difference(docs, docs.where(F.col("doc_id").isin(targets)).select("doc_id")).collect()
    texts = {i: (t or "").lower().split() for i, t in ROWS}
    wanted = plain_losses(texts, targets)
    assert len(rows) == len(ROWS)
    for r in rows:
        want = wanted[r["doc_id"]]
        assert (r["target_loss"], r["background_loss"]) == tuple(w if w is None else pytest.approx(w) for w in want)
        assert (r["score"] is None) == (r["n_tokens"] == 0)


def test_model_probabilities_sum_to_one():
    texts = {i: (t or "").lower().split() for i, t in ROWS}
    vocabulary, of = plain_models(texts, [1, 2])
    for alone, after in of(1):
        words = [*vocabulary, "never seen"]
        assert sum(map(alone, words)) == pytest.approx(1)
        assert all(sum(after(x, y) for y in words) == pytest.approx(1) for x in [None, *words])
        assert len({after("never seen", y) for y in words}) == 1


def test_odd_rows_by_model(spark, odd, none, clashing):
    ids = odd.select("doc_id")
    found = lm_scoring.cross_entropy_difference(clashing, ids)
    assert found.count() == odd.count() and found.where("n_tokens = 0 and score is null").count() == 4
    assert lm_scoring.cross_entropy_difference(none, ids).collect() == []
    assert lm_scoring.cross_entropy_difference(odd, ids.limit(0)).where("score is not null").count() == 6


@pytest.mark.parametrize(("carried", "bucket"), [(0, 1_000), (50, 2_000), (1 << 21, 500), (1 << 21, 4_000_000)])
def test_every_word_and_pair_has_its_own_count(spark, monkeypatch, carried, bucket):
    monkeypatch.setattr(lm_scoring, "CARRIED_WORDS", carried)
    monkeypatch.setattr(lm_scoring, "BUCKET_PAIRS", bucket)
    monkeypatch.setattr(lm_scoring, "CHUNK_WORDS", bucket)
    texts = {i: [f"w{i * 60 + k}" for k in range(100)] + ["the", "end"] * 3 for i in range(200)}
    docs = documents(spark, [(i, " ".join(words)) for i, words in texts.items()])
    rows = lm_scoring.cross_entropy_difference(docs, docs.where("doc_id < 20").select("doc_id")).collect()
    found = {r["doc_id"]: (r["target_loss"], r["background_loss"]) for r in rows}
    assert len(rows) == len(texts)
    for i, want in plain_losses(texts, range(20), range(0, 200, 23)).items():
        assert found[i] == tuple(map(pytest.approx, want))
    again = lm_scoring.cross_entropy_difference(docs.repartition(5), docs.where("doc_id < 20").select("doc_id"))
    assert {r["doc_id"]: (r["target_loss"], r["background_loss"]) for r in again.collect()} == found


def test_line_rules_read_whole_lines(spark):
    notice = PROSE + " " + "It may be used by all who want to, in any way they like to use it. " * 3
    long = [notice + sign + " and more words." for sign in ("Copyright of the firm,", "(C) 1999,", "Please Log in", "Terms of use apply,")]
    texts = ["\n".join([PROSE, line]) for line in long] + [f"{PROSE}\nIt ends here.{' ' * 20}", f"{PROSE}\n{notice}"]
    rows = clean_lines(documents(spark, list(enumerate(texts)))).orderBy("doc_id").collect()
    assert [r["n_bad_lines"] for r in rows] == [1, 1, 1, 1, 0, 0]
    assert [r["cleaned_text"] for r in rows[:4]] == [PROSE] * 4


def test_phrases_vote_alone(spark, labelled):
    phrases = ["shut up", "Drop\ndead", "kill  yourself", "go to\thell", "I hate you"]
    model = train(*labelled)
    assert all(model.terms.of(f"now {p}.") == {model.terms.size - 1} for p in phrases)
    assert model.terms.of("shut the door, up there; hate, you say") == set()
    assert all(model.score(f"now {p}.") > model.score("now.") for p in phrases)
    plain = documents(spark, [(i, f"now {p}.") for i, p in enumerate([*phrases, "then"])])
    no_labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["predicted"] for r in score_documents(plain, train(plain, no_labels)).orderBy("doc_id").collect()] == [1] * 5 + [0]


def test_layout_names_do_not_cost_the_article():
    words = "<p>First text, with words.</p><p>Second text, with more words.</p>"
    said = "First text, with words. Second text, with more words."
    for name in ("no-sidebar", "content has-sidebar", "content-sidebar-wrap", "sidebar"):
        assert main_text(f"<body><div class='{name}'>{words}</div></body>") == said
    side = "<div class='box ad'><p>Buy this, and that, now.</p></div>"
    assert main_text(f"<div class='search'><article>{words}{side}</article></div>") == said
    assert main_text(f"<div id=main>{words}<p>Third<span class=ad> Buy, buy</span>, at last.</p>{side}</div>") == said + " Third, at last."


def test_repeated_words_of_a_very_long_text(spark):
    from chartloom.llm.line_rules import clean_lines

    words = [f"w{i}" for i in range(300_000)]
    words[150_000:150_020] = ["again"] * 20
    found = clean_lines(documents(spark, [(1, " ".join(words))])).first()
    assert found["n_repeat_words"] == 20


def test_sample_is_bounded_by_rows(spark):
    from chartloom.llm.toxicity import training_sample

    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(1, 40)], "doc_id long, quality int, toxic int")
    docs = documents(spark, [(2, "the same text")] * 300 + [(i, f"text {i}") for i in range(1, 40)])
    for rows in (10, 100):
        assert training_sample(docs, labels, rows).count() <= rows


def test_links_of_an_article_are_its_own():
    words = "<p>First text, with words.</p><p>Second text, with more words.</p>"
    links = "<ul><li><a href=x>See this source, and that</a></li></ul>"
    assert main_text(f"<article>{words}{links}</article>{links}") == (
        "First text, with words. Second text, with more words. See this source, and that"
    )
    assert main_text(f"<div>{words}{links}</div>") == "First text, with words. Second text, with more words."


@pytest.mark.parametrize(
    ("page", "n_chars"),
    [
        ("<div>x, y. " * 100_000, 599_999),
        ("<b><div>x. " * 30_000 + "</b>" * 30_000, 89_999),
        ("<div>" * 50_000 + "</i>x" * 50_000, 50_000),
        ("<p>x<i>" * 50_000, 99_999),
        ("<a " * 100_000, 299_999),
        ("<!-- " * 50_000, 0),
    ],
)
def test_broken_pages_take_time_by_their_length(page, n_chars):
    begin = time.process_time()
    assert len(main_text(page)) == n_chars and time.process_time() - begin < 5


def test_path_ratios_by_the_definition():
    rng = random.Random(5)
    for _ in range(40):
        blocks = []  # (path, text)
        page = ""
        for outer in range(rng.randint(1, 4)):
            shell = rng.choice(["div", "section"])
            page += f"<{shell}>"
            for _ in range(rng.randint(1, 5)):
                tag = rng.choice(["p", "h2", "pre", "blockquote"])
                text = " ".join(rng.choice(["word", "two,", "end.", "x"]) for _ in range(rng.choice([1, 2, 5, 60])))
                page += f"<{tag}>{text}</{tag}>"
                blocks.append((f"{shell}/{tag}", text))
            page += f"</{shell}>"

        def mean(path, values):
            own = [v for (p, _), v in zip(blocks, values) if p == path]
            return sum(own) / len(own)

        length = [len(t) for _, t in blocks]
        marks = [sum(t.count(m) for m in ",.") for _, t in blocks]
        fused = [mean(p, length) * (1 + mean(p, marks)) for p, _ in blocks]
        laid = []
        for i in range(len(blocks)):
            near = [(w, fused[i + d]) for d, w in zip(range(-2, 3), (1, 2, 4, 2, 1)) if 0 <= i + d < len(blocks)]
            laid.append(sum(w * f for w, f in near) / sum(w for w, _ in near))
        for i in range(len(blocks) - 2, -1, -1):
            if blocks[i][0].endswith("h2"):
                laid[i] = max(laid[i], laid[i + 1])
        score = [mean(p, laid) for p, _ in blocks]
        assert main_text(page) == " ".join(t for (_, t), s in zip(blocks, score) if s >= 0.08 * max(score))
