"""SimHash near-duplicates against all pairs."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
import xxhash

from landledger.llm import simhash
from landledger.llm.components import components
from tests.llm import cases


def brute_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), seed=42)
              for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, bits=2):
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in itertools.combinations(sorted(values), 2):
        if (a ^ b).bit_count() <= bits:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {v: find(v) for v in values}


def test_fingerprint():
    rng = random.Random(3)
    for text in [None, "", " \n", "One", "one two", "É A b c\x0bD",
                 " ".join(rng.choice("abcdefg") for _ in range(300))]:
        assert simhash.fingerprint(text.encode() if text else None) == brute_fingerprint(text)


def test_every_close_segment_shares_a_codeword():
    rng = np.random.default_rng(1)
    decoder = simhash._decoder()
    words = rng.integers(0, 1 << 23, 200)
    which, index, nearest = simhash.codewords(words, decoder)
    assert nearest.sum() == 200
    sets = [set(index[which == i]) for i in range(200)]
    for flip in range(23):
        _, other, main = simhash.codewords(words ^ (1 << flip), decoder)
        assert all(x in s for x, s in zip(other[main], sets))


@pytest.mark.parametrize("small_bucket", [0, 3, 10_000])
def test_links_lose_nothing(spark, small_bucket):
    """A crowd around one fingerprint, chains, and strangers, whatever the bucket size."""
    rng = random.Random(5)
    values, centre = set(), rng.getrandbits(64)
    for _ in range(120):
        values.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))))
    for _ in range(15):
        v = rng.getrandbits(64)
        for _ in range(8):
            values.add(v)
            v ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
    values |= {0, 1, 3, (1 << 64) - 1}
    frame = spark.createDataFrame([(simhash._signed(v),) for v in values], "bits long")
    edges = simhash.links(frame, small_bucket)
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 2 for a, b in edges.collect())
    found = {n & (1 << 64) - 1: r & (1 << 64) - 1 for n, r in components(edges).collect()}
    groups = {}
    for value, root in brute_components(values).items():
        groups.setdefault(root, set()).add(value)
    for group in groups.values():
        assert len({found.get(v, v) for v in group}) == 1
    assert len({found.get(v, v) for v in values}) == len(groups)


def test_components_of_long_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 120)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    shuffled = random.Random(2).sample([(b, a) for a, b in chain + star], len(chain + star))
    edges = spark.createDataFrame(shuffled + [(5000, 5000)], "a long, b long")
    found = dict(components(edges).collect())
    assert {found[i] for i in range(121)} == {0} and {found[1000 + i] for i in range(200)} == {1000}
    assert components(edges.where("false")).count() == 0


def test_near_duplicates_and_awkward_rows(spark):
    docs = cases.awkward(spark)
    found = cases.pairs(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id")
    assert len(found) == 10
    print_of = {i: f"{brute_fingerprint(t):016x}" for i, t in enumerate(cases.TEXTS)}
    assert (0, "0" * 16, 0) in found and (1, "0" * 16, 0) in found and (2, "0" * 16, 0) in found
    assert found.count((3, print_of[3], 3)) == 2
    assert found.count((None, print_of[8], None)) == 2  # equal but for case, no id
    assert simhash.near_duplicates(cases.none(spark)).count() == 0


def test_keep_first(spark):
    docs = cases.awkward(spark)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in kept.collect()) == [-1, 0, 3, 5, 6]
    assert simhash.keep_first(cases.none(spark)).count() == 0


def test_rounds_do_not_grow_with_a_chain(spark, monkeypatch):
    """A chain of nodes in order: one round of hooks and the steps that halve the way."""
    from landledger.llm import components as c

    written = []
    real = c.Scratch.keep
    monkeypatch.setattr(c.Scratch, "keep", lambda self, df, name="": written.append(1) or real(self, df, name))
    counts = []
    for n in (50, 400):
        written.clear()
        edges = spark.range(n - 1).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
        found = c.components(edges).collect()
        assert len(found) == n and {r.root for r in found} == {0}
        counts.append(len(written))
    assert counts[1] <= counts[0] + 4 <= 20
