"""Ranked search against a plain scorer and against SQL."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest

from landledger.llm import lexical_search as s
from landledger.llm import sql
from tests.compare import _rows
from tests.llm import cases

WORDS = "alpha beta gamma delta eps Éta THETA x1 日本 the the the of".split(" ")


def terms(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in found]


def brute(docs, items, top):
    """docs and items as (id, text); a list of rows per item."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n = sum(bool(b) for _, b in bags)
    length = sum(b.total() for _, b in bags)
    df = Counter(w for _, b in bags for w in b)
    out = []
    for item, text in items:
        rows = []
        for doc, bag in bags:
            m = 75 + (25 * bag.total() * n) // max(1, length)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1)))
                        * ((10 ** 9 * bag[w]) // (1000 * bag[w] + 12 * m)) for w in terms(text))
            if score > 0:
                rows.append((-score, math.inf if doc is None else doc, doc))
        out += [(item, rank, doc, -score) for rank, (score, _, doc) in
                enumerate(sorted(rows, key=lambda r: r[:2])[:top], 1)]
    return sorted(out, key=repr)


def corpus(seed, n=150):
    rng = random.Random(seed)
    made = [" ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 6))) for _ in range(n // 2)]
    made += [" ".join(rng.choice(WORDS) for _ in range(rng.randint(5, 90))) for _ in range(n // 2)]
    made += ["beta gamma"] * 40 + ["Beta, GAMMA!"] * 9 + [None, "", "..."]
    rng.shuffle(made)
    items = [" ".join(rng.choice(WORDS) for _ in range(rng.choice((1, 2, 5, 30))))
             for _ in range(9)] + ["beta", "beta", None, "", "??", "unseen word"]
    return list(enumerate(made)), list(enumerate(items))


@pytest.mark.parametrize("top, block_bytes", [(20, s.BLOCK_BYTES), (3, 6000), (1000, 2500)])
def test_equals_a_plain_scorer_in_one_or_many_blocks(spark, top, block_bytes):
    docs, items = corpus(top)
    found = s.search(cases.documents(spark, [t for _, t in docs]).repartition(5),
                     cases.benchmark(spark, items), top, block_bytes)
    assert cases.pairs(found, "item_id", "rank", "doc_id", "score") == brute(docs, items, top)


def test_members_of_one_class_come_back_by_ascending_id(spark):
    docs = [(900 - i, "beta beta x") for i in range(300)] + [(5000, "beta beta y")]
    frame = cases.documents(spark, [t for _, t in docs], [i for i, _ in docs])
    found = s.search(frame, cases.benchmark(spark, [(1, "beta")]), 20).orderBy("rank").collect()
    assert [r.doc_id for r in found] == list(range(601, 621))
    assert len({r.score for r in found}) == 1


def test_small_slices_and_inexact_doubles_give_the_same(spark, monkeypatch):
    docs, items = corpus(9)
    want = brute(docs, items, 5)
    for name, value in (("CELLS", 40), ("ADDITIONS", 30), ("_EXACT", 1)):
        monkeypatch.setattr(s, name, value)
        found = s.search(cases.documents(spark, [t for _, t in docs]),
                         cases.benchmark(spark, items), 5)
        assert cases.pairs(found, "item_id", "rank", "doc_id", "score") == want


def test_classes_that_share_a_hash_stay_apart(spark, monkeypatch):
    docs, items = corpus(4)
    monkeypatch.setattr(s.F, "xxhash64", lambda *_: s.F.lit(7).cast("bigint"))
    found = s.search(cases.documents(spark, [t for _, t in docs]), cases.benchmark(spark, items))
    assert cases.pairs(found, "item_id", "rank", "doc_id", "score") == brute(docs, items, 20)


def test_awkward_rows(spark):
    ids = [0, 1, 2, 3, 3, 5, 6, 6, None, None]
    items = [(1, "One ipsum"), (1, "one"), (2, None), (None, "a b 日本語"), (None, "a b 日本語")]
    found = s.search(cases.awkward(spark).withColumnRenamed("bits", "bag"),
                     cases.benchmark(spark, items))
    assert cases.pairs(found, "item_id", "rank", "doc_id", "score") == brute(
        list(zip(ids, cases.TEXTS)), items, 20)


def test_empty_tables(spark):
    one = cases.benchmark(spark, [(1, "one")])
    for docs, items in ((cases.none(spark), one), (cases.awkward(spark), cases.benchmark(spark))):
        found = s.search(docs, items)
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and not found.collect()


def test_equals_sql(spark):
    docs, items = corpus(2)
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(docs, columns=["doc_id", "text"]))
    con.register("benchmark", pd.DataFrame(items, columns=["item_id", "text"]))
    want = con.execute(sql.LEXICAL_SEARCH)
    names = [c[0] for c in want.description]
    found = s.search(cases.documents(spark, [t for _, t in docs]), cases.benchmark(spark, items))
    assert _rows(found.columns, [tuple(r) for r in found.collect()]) == _rows(
        names, want.fetchall())


def test_best_keeps_what_a_full_sort_keeps():
    rng = np.random.default_rng(1)
    best, rows = s._Best(3, 4), []
    for _ in range(12):
        scores, first = rng.integers(0, 6, (25, 3)).astype(float), rng.integers(0, 90, 25)
        best.add(scores, first, lambda chosen, f=first: [int(f[i]) for i in chosen])
        rows += [(q, -scores[i, q], first[i]) for i in range(25) for q in range(3)]
    want = [r for q in range(3) for r in sorted(r for r in rows if r[0] == q and r[1] < 0)[:4]]
    assert list(zip(best.query, -best.score, best.first)) == want
    assert [best.kept[i] for i in best.slot] == [f for *_, f in want] and len(best.kept) <= 12
