"""Toxicity: folding, exceptions, held-out accuracy, awkward rows."""

import os
import random
import time

import pytest

from landledger.llm import toxicity as t
from tests.llm import cases

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001").replace("0.001", "0.01")


@pytest.mark.parametrize("text,words", [
    ("IDIOT", ["idiot"]), ("1d10t", ["idiot"]), ("m0r0n!", ["moron"]), ("ѕсum", ["scum"]),
    ("ｔｒａｓｈ", ["trash"]), ("id​iot", ["idiot"]), ("$tupid", ["stupid"]),
    ("in 2024 or 3.5", ["in", "2024", "or", "3", "5"]), ("Straße über", ["straße", "über"])])
def test_folding(text, words):
    assert t.folded(text) == words


def score(model, *texts):
    automaton = t._automaton(model)
    return [t._density(t.folded(x), automaton[0])[0] for x in texts]


def test_exceptions_beginnings_and_length():
    model = {"entries": {"trash ": 4.0, "clown ": 3.0, "lowe": 5.0, "lowei": 5.5},
             "exceptions": ("trash can",), "curve": (-4.0, 4.0)}
    can, trash, both, word = score(model, "a trash can here", "a trash heap here",
                                   "trash can, trash", "Loweixyz")
    assert can == 0 < trash and both > 0 and word > trash
    assert score(model, "yellowei trashy clowns") == [0]
    assert score(model, "trash " + "word " * 10, "trash " + "word " * 5000) == sorted(
        score(model, "trash " + "word " * 10, "trash " + "word " * 5000), reverse=True)


def test_matches_outside_exceptions():
    rng = random.Random(6)
    for _ in range(300):
        best = {rng.randint(0, 40): 1.0 for _ in range(rng.randint(0, 12))}
        excused = [(a := rng.randint(0, 40), a + rng.randint(0, 9)) for _ in range(rng.randint(1, 6))]
        assert t._outside(best, excused) == {
            s: 1.0 for s in best if not any(a <= s < b for a, b in excused)}


def test_many_exceptions_take_linear_time():
    model = {"entries": {"trash ": 4.0}, "exceptions": ("trash can",), "curve": (-4.0, 4.0)}
    start = time.perf_counter()
    assert score(model, "trash can " * 200_000, "trash " * 200_000 + "trash can")[0] == 0
    assert time.perf_counter() - start < 15


def invented(spark, n=600):
    """Word salad; toxic rows hold made-up words with a common beginning."""
    rng = random.Random(3)
    words = ["".join(rng.choice(["ba", "do", "ki", "lu", "mer", "sta"])
                     for _ in range(rng.randint(1, 3))) for _ in range(200)]
    texts, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(5, 80))]
        toxic = int(i % 5 == 0)
        if toxic:
            for _ in range(2):
                text.insert(rng.randint(0, len(text)), "zorq" + rng.choice(words))
        texts.append(" ".join(text))
        labels.append((i, None, toxic))
    return cases.documents(spark, texts).drop("toxicity"), cases.labels(spark, labels)


def test_beginnings_are_learned_and_hold_for_unseen_words(spark):
    docs, labels = invented(spark)
    rows = t.report(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert 60 < len(rows) < 200
    assert all(r.predicted == r.toxic for r in rows)


def test_held_out_rows_do_not_matter(spark):
    docs, labels = invented(spark, 200)
    from pyspark.sql import functions as F
    flipped = labels.withColumn("toxic", F.when(t.held_out(), 1 - F.col("toxic")).otherwise(
        F.col("toxic")))
    assert t.fit(docs, labels) == t.fit(docs, flipped)


def test_sample_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    rows = t.report(docs, labels).join(labels, "doc_id").collect()
    clean = [r for r in rows if r.toxic == 0]
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)


def test_awkward_rows(spark):
    docs = cases.awkward(spark)
    rows = t.report(docs.drop("toxicity"), cases.labels(spark, [(3, 1, None), (3, 1, 1), (None, 1, 1)]))
    found = rows.collect()
    assert len(found) == 10 and all(r.predicted == 0 and 0 <= r.score < 0.5 for r in found)
    kept = t.clean(docs, cases.labels(spark))
    assert cases.pairs(kept, *docs.columns) == cases.pairs(docs, *docs.columns)
    assert t.clean(cases.none(spark), cases.labels(spark)).count() == 0


def test_held_out_accuracy_on_the_sample(spark):
    """On rows no model has seen: few clean ones are called toxic, most toxic ones are."""
    folder = SF.replace("0.01", "0.1")
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    rows = t.report(docs, labels).where("held_out").join(labels, "doc_id").where("toxic in (0, 1)").collect()
    toxic, clean = ([r for r in rows if r.toxic == label] for label in (1, 0))
    assert len(toxic) > 60 and len(clean) > 500
    assert sum(r.predicted for r in clean) <= 0.01 * len(clean)
    assert sum(r.predicted for r in toxic) >= 0.85 * len(toxic)


def test_evidence_decides_by_itself(spark):
    """One clean text does not strike out an entry with many toxic ones; a few toxic texts
    alone do not make one."""
    texts = ["zorqa bad word"] * 60 + ["zorqa fine"] + ["rareword here"] * 2 + ["plain text of words"] * 300
    docs = cases.documents(spark, texts).withColumnRenamed("toxicity", "other")
    training = docs.selectExpr("text", "cast(doc_id < 60 or doc_id in (61, 62) as int) toxic")
    found = t._lexicon(training)
    assert any(e.startswith("zorq") for e in found)
    assert not any(e.startswith("rare") for e in found)
