"""Collocations against a plain miner and against SQL."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest

from landledger.llm import collocations as c
from landledger.llm import sql
from tests.compare import _rows
from tests.llm import cases

WORDS = "New York city the the the of Éta müller 日本 a b c d e f".split(" ")
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, longest=3, least=10, share=50, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                f[lang].update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        frequent = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        found = []
        for phrase, a in frequent.items():
            if any(len(q) > len(phrase) and 100 * b >= share * a and any(
                    q[i:i + len(phrase)] == phrase for i in range(len(q))) for q, b in frequent.items()):
                continue
            score, _, l, r = min(
                (10 ** 6 * a * a // (counts[phrase[:k]] * counts[phrase[k:]]), k,
                 counts[phrase[:k]], counts[phrase[k:]]) for k in range(1, len(phrase)))
            found.append((-score, -a, " ".join(phrase).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out, key=repr)


def corpus(seed, n=120):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        words = [rng.choice(WORDS) + rng.choice(["", "", "", "", ",", ".\n", "\t"])
                 for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.5:
            words.insert(0, "ad hoc ipso facto;")
        rows.append((rng.choice(["en", "en", "de", None, "und", ""]), " ".join(words)))
    return [*rows, ("en", None), ("en", ""), (None, " \t,,. ")]


def frame(spark, rows):
    return spark.createDataFrame([(i, *r, 1) for i, r in enumerate(rows)],
                                 "doc_id long, lang string, text string, prefix int").repartition(4)


@pytest.mark.parametrize("options", [
    {}, {"held": 50}, {"longest": 2}, {"longest": 5, "least": 4}, {"share": 90, "top": 7}])
def test_equals_a_plain_miner(spark, options):
    rows = corpus(3)
    found = c.collocations(frame(spark, rows), **options)
    assert found.columns == COLUMNS
    want = brute(rows, **{k: v for k, v in options.items() if k != "held"})
    assert len(want) > 10 and cases.pairs(found, *COLUMNS) == want


def test_equals_sql(spark):
    rows = corpus(5, 300)
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["lang", "text"]))
    want = con.execute(sql.COLLOCATIONS)
    names = [x[0] for x in want.description]
    found = c.collocations(frame(spark, rows))
    assert _rows(found.columns, [tuple(r) for r in found.collect()]) == _rows(
        names, want.fetchall())


def test_exact_beyond_64_bits(spark):
    a, l, r = 3_000_000_019, 3_000_000_021, 3_000_000_087
    counts = spark.createDataFrame([("x", "p q", a), ("x", "p", l), ("x", "q", r)],
                                   "lang string, phrase string, f long")
    candidates = spark.createDataFrame([("x", "p q", a, ["p", "q"])],
                                       "lang string, phrase string, a long, words array<string>")
    assert [x.score for x in c._scored(candidates, counts).collect()] == [10 ** 6 * a * a // (l * r)]


def test_a_full_field_of_bits_changes_nothing(spark, monkeypatch):
    rows = corpus(8)
    monkeypatch.setattr(c, "_frequent", lambda _: b"\xff" * (c.BITS // 8))
    assert cases.pairs(c.collocations(frame(spark, rows)), *COLUMNS) == brute(rows)


def test_rare_phrases_are_not_counted_further(spark):
    rows = [("en", "a b c " * 20 + "x y z q")]  # one task, so its stripes are whole
    words = spark.createDataFrame([("en", w, 60) for w in "abc"], "lang string, phrase string, f long")
    found = c.merged(frame(spark, rows), 2, c._frequent(words)).collect()
    assert {(r.prefix, r.next) for r in found} == {("a", "b"), ("b", "c"), ("c", "a")}


def test_stripes_are_dealt_out_once(spark):
    plan = c.merged(frame(spark, [("en", "a b c")]), 2)._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    assert physical.count("Exchange hashpartitioning(lang") == 1


@pytest.mark.parametrize("spread", [4, 4096])
def test_frequent_prefixes_are_dealt_out_in_parts(spark, monkeypatch, spread):
    monkeypatch.setattr(c, "SPREAD", spread)
    rows = [("en", " ".join(f"the w{i % 40}" for i in range(600)))] * 3
    words = spark.createDataFrame([("en", "the", 1800), ("en", "w1", 45)],
                                  "lang string, phrase string, f long")
    hashes, parts = c._spread(words, 3600)
    assert dict(zip(hashes, parts)) == ({c.phrase_hash("en", "the"): 3} if spread == 4 else {
        c.phrase_hash("en", "the"): 2049, c.phrase_hash("en", "w1"): 52})
    holder = c._Holder("en", 2, np.full(c.BITS // 8, 255, np.uint8),
                       (np.array(hashes, np.uint64), np.array(parts, np.uint64)))
    holder.add(" ".join(f"the v{i % 500} . x y ." for i in range(1000)).encode())
    made = [r for columns in holder.stripes() for r in zip(*(x.to_pylist() for x in columns))]
    the = [r for r in made if r[1] == "the"]
    assert len(the) == len({r[2] for r in the}) > 2
    found = {(r[1], w): n for r in made for w, n in zip(r[3].split(" "), r[4])}
    assert found == {("the", f"v{i}"): 2 for i in range(500)} | {("x", "y"): 1000}
    assert cases.pairs(c.collocations(frame(spark, rows)), *COLUMNS) == brute(rows)


def test_phrases_across_chunks_and_handed_on_stripes(spark, monkeypatch):
    monkeypatch.setattr(c, "CHUNK", 50)
    monkeypatch.setattr(c, "VOCABULARY", 6)
    rows = [*corpus(12, 60), ("en", "one long piece without any mark in it " * 30)]
    for longest in (2, 3, 5):
        found = c.collocations(frame(spark, rows), longest=longest)
        assert cases.pairs(found, *COLUMNS) == brute(rows, longest)


def test_awkward_and_empty_tables(spark):
    found = c.collocations(cases.awkward(spark))
    rows = [(r.lang, r.text) for r in cases.awkward(spark).collect()]
    assert cases.pairs(found, *COLUMNS) == brute(rows)
    assert c.collocations(cases.none(spark)).collect() == []
    with pytest.raises(ValueError):
        c.collocations(cases.none(spark), longest=1)
