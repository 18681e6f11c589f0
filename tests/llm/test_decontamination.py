"""Benchmark decontamination against its SQL and against plain search."""

import hashlib
import random
import re

import duckdb
import pandas as pd
import pytest

from landledger.llm import decontamination as d
from landledger.llm import sql
from tests.compare import _rows
from tests.llm import cases

WORDS = "alpha beta gamma delta, Éta ... THETA x1 日本".split(" ")


def corpus(seed, n=60):
    rng = random.Random(seed)
    items = [" ".join(rng.choice(WORDS) for _ in range(rng.choice((0, 2, 9, 10, 11, 25))))
             for _ in range(12)] + [None, "", "...", "solo"]
    texts = []
    for _ in range(n):
        parts = [" ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 30)))]
        if rng.random() < 0.6:
            parts.insert(rng.randint(0, 1), rng.choice(items) or "")
        texts.append("\n".join(parts))
    return items, [*texts, None, "", "solo", "Solo.SOLO"]


def brute(texts, items):
    def words(t):
        t = re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
    out = []
    for text in texts:
        w, hit, found = words(text), set(), set()
        for number, item in enumerate(items):
            v = words(item)
            for i in range(max(1, len(v) - 9) if v else 0):
                window = v[i:i + 10]
                for j in range(len(w) - len(window) + 1):
                    if w[j:j + len(window)] == window:
                        hit.update(range(j, j + len(window)))
                        found.add(number)
        out.append((len(w), len(hit), sorted(found)))
    return out


@pytest.mark.parametrize("block_bytes", [d.BLOCK_BYTES, 300])
def test_equals_plain_search_in_one_or_many_blocks(spark, block_bytes):
    items, texts = corpus(1)
    found = d.contamination(cases.documents(spark, texts),
                            cases.benchmark(spark, enumerate(items)), ["doc_id"],
                            block_bytes=block_bytes)
    rows = sorted(found.collect())
    assert [(r[1].n_words, r[1].n_hit, r[1]["items"]) for r in rows] == brute(texts, items)


def test_report_equals_sql(spark):
    items, texts = corpus(2)
    docs = cases.documents(spark, texts).select("doc_id", "text")
    got = d.report(d.contamination(docs, cases.benchmark(spark, enumerate(items)))).toPandas()
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": range(len(texts)), "text": texts}))
    con.register("benchmark", pd.DataFrame({"item_id": range(len(items)), "text": items}))
    cursor = con.execute(sql.DECONTAMINATION)
    names = [c[0] for c in cursor.description]
    mine = [tuple(x.item() if hasattr(x, "item") else x for x in r)
            for r in got.itertuples(index=False)]
    assert _rows(list(got.columns), mine) == _rows(names, cursor.fetchall())


def test_spans_point_into_the_original(spark):
    docs = cases.documents(spark, ["é, One  TWO!three four"]).drop("contamination")
    found = d.contamination(docs, cases.benchmark(spark, [(7, "one two three")])).first()
    assert [(s.start, s.end) for s in found.contamination.spans] == [(3, 17)]


def test_awkward_rows_and_empty_tables(spark):
    items = cases.benchmark(spark, [(1, "a b c d e f g h i j"), (None, "one"), (2, None)])
    found = cases.pairs(d.report(d.contamination(
        cases.awkward(spark), items, ["doc_id"])), "doc_id", "n_words", "n_hit", "n_items")
    assert (None, 14, 10, 1) in found and found.count((None, 14, 10, 1)) == 2
    assert found.count((3, 1, 0, 0)) == 2 and (0, 0, 0, 0) in found and len(found) == 10
    kept = d.clean(cases.awkward(spark), items)
    assert kept.columns == cases.awkward(spark).columns and kept.count() == 8
    assert d.clean(cases.awkward(spark), cases.benchmark(spark)).count() == 10
    assert d.clean(cases.none(spark), items).count() == 0
    with pytest.raises(ValueError):
        d.contamination(cases.awkward(spark), items)


@pytest.mark.parametrize("block_bytes", [d.BLOCK_BYTES, 300])
def test_item_ids_of_any_type(spark, block_bytes):
    items = [("b", "alpha beta gamma"), ("a", "Beta gamma"), (None, "alpha"), ("10", "delta")]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    docs = cases.documents(spark, ["x alpha beta gamma delta", "beta", None])
    found = d.contamination(docs, benchmark, ["doc_id"], block_bytes=block_bytes)
    assert {r.doc_id: r.contamination["items"] for r in found.collect()} == {0: ["10", "a", "b"], 1: [], 2: []}
    digests = {r.doc_id: r.items_sha256 for r in d.report(found).collect()}
    assert digests[0] == hashlib.sha256(b"10,a,b").hexdigest()


def test_blocks_leave_the_driver_one_by_one(spark, monkeypatch):
    """Of many blocks one at a time is held; copies of a text are found once each."""
    items, texts = corpus(4)
    live, real = [], d.Windows.block

    def block(self, number):
        live.append(number)
        return real(self, number)
    monkeypatch.setattr(d.Windows, "block", block)
    found = d.contamination(cases.documents(spark, texts * 3).withColumnRenamed("bits", "key"),
                            cases.benchmark(spark, enumerate(items)), block_bytes=200, out="found")
    rows = sorted(found.collect(), key=lambda r: r.doc_id)
    assert len(live) > 5 and live == sorted(live)
    assert [(r["found"].n_words, r["found"].n_hit, r["found"]["items"]) for r in rows] == brute(texts, items) * 3
