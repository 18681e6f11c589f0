"""The Kneser-Ney classifier against a plain implementation."""

import math
import random
from collections import Counter, defaultdict

import pytest

from landledger.llm import quality
from tests.llm import cases


class Plain:
    """Interpolated modified Kneser-Ney, one dictionary per order."""

    def __init__(self, texts, order):
        self.order = order
        grams = Counter(g for t in texts for g in self.grams(t))
        self.counts = {order: grams}
        for n in range(order - 1, 0, -1):
            self.counts[n] = Counter(g[1:] for g in self.counts[n + 1])
        self.discounts, self.contexts = {}, {}
        for n, counts in self.counts.items():
            of = Counter(counts.values())
            if of[1] and of[2] and of[3]:
                y = of[1] / (of[1] + 2 * of[2])
                raw = (1 - 2 * y * of[2] / of[1], 2 - 3 * y * of[3] / of[2],
                       3 - 4 * y * of[4] / of[3])
                d = [min(max(x, 0.05), i - 0.05) for i, x in enumerate(raw, 1)]
            else:
                d = [0.5, 1.0, 1.5]
            self.discounts[n] = d
            held, total = defaultdict(float), defaultdict(int)
            for gram, c in counts.items():
                total[gram[:-1]] += c
                held[gram[:-1]] += d[min(c, 3) - 1]
            self.contexts[n] = (total, held)

    def grams(self, text):
        x = [0] * (self.order - 1) + quality.symbols(text.encode()).tolist()
        return [tuple(x[i:i + self.order]) for i in range(len(x) - self.order + 1)]

    def p(self, gram):
        n = len(gram)
        total, held = (c[gram[:-1]] for c in self.contexts[n])
        if n == 1:
            lower = 1 / (len(self.counts[1]) + 1)
        else:
            lower = self.p(gram[1:])
        if not total:
            return lower
        c = self.counts[n][gram]
        own = c - self.discounts[n][min(c, 3) - 1] if c else 0
        return own / total + held / total * lower

    def perplexity(self, text):
        grams = self.grams(text)
        return math.exp(-sum(math.log(self.p(g)) for g in grams) / len(grams))


@pytest.mark.parametrize("pack_bytes", [quality.PACK_BYTES, 200])
def test_equals_the_plain_model(spark, monkeypatch, pack_bytes):
    monkeypatch.setattr(quality, "PACK_BYTES", pack_bytes)
    rng = random.Random(1)
    texts = ["".join(rng.choice("aabbbcd éß日") for _ in range(rng.randint(1, 90)))
             for _ in range(40)] + ["zzz", "😀q"]
    labels = cases.labels(spark, [(i, int(i % 3 > 0), 0) for i in range(30)])
    model = Plain([t for i, t in enumerate(texts[:30]) if i % 3 > 0], quality.ORDER)
    found = quality.perplexities(cases.documents(spark, texts), labels).collect()
    assert len(found) == len(texts)
    for row in found:
        assert row.trusted == (row.doc_id < 30 and row.doc_id % 3 > 0)
        assert row.perplexity == pytest.approx(model.perplexity(texts[row.doc_id]), rel=1e-9)


def test_probabilities_of_a_context_sum_to_one(spark):
    texts = ["abracadabra", "abrakadabra", "cabra"]
    model = Plain(texts, 3)
    seen = sorted({g[-1] for g in model.counts[1]})
    for context in [(0, 0), (98, 99), (seen[0], seen[1])]:
        known = sum(model.p((*context, s)) for s in seen)
        assert known + model.p((*context, 20_000)) == pytest.approx(1)


def test_thresholds_and_awkward_rows(spark):
    good = ["the cat sat on the mat and the dog lay on the rug"] * 31
    docs = cases.documents(spark, [*good, "%%$$ ##!! QQZZ@@", None, ""]).withColumn(
        "lang", cases_lang())
    labels = cases.labels(spark, [(i, 1, 0) for i in range(30)] + [(None, 1, 0), (31, 0, 0)])
    rows = {r.doc_id: r for r in quality.classified(docs, labels).collect()}
    assert all(rows[i].keep for i in range(31)) and not rows[31].keep
    assert rows[32].perplexity is None and not rows[32].keep and not rows[33].keep
    assert rows[30].threshold == rows[0].threshold  # an unknown language takes the overall one
    awkward = quality.classified(cases.awkward(spark), cases.labels(spark))
    assert awkward.count() == 10 and awkward.where("keep").count() == 8
    assert awkward.where("threshold is not null").count() == 0
    assert quality.classified(cases.none(spark), labels).count() == 0


def cases_lang():
    from pyspark.sql import functions as F
    return F.when(F.col("doc_id") == 30, "xx").otherwise("en")


def test_many_labels_take_the_shuffled_way(spark, monkeypatch):
    monkeypatch.setattr(quality, "broadcast_if_small", lambda df, row_bytes: df)
    labels = cases.labels(spark, [(3, 1, 0), (3, 1, 0), (8, 1, 0)])
    rows = quality.perplexities(cases.documents(spark), labels).collect()
    assert len(rows) == 10 and {r.doc_id for r in rows if r.trusted} == {3, 8}


def test_the_cut_comes_from_labels_of_unseen_rows(spark):
    rng = random.Random(7)
    words = "the cat dog sat lay on a mat rug and house garden tree".split()
    def prose():
        return " ".join(rng.choice(words) for _ in range(40))
    def junk():
        return "".join(rng.choice("QXZJK#%&$@!") for _ in range(150))
    texts = [prose() for _ in range(190)] + [junk() for _ in range(10)] + [
        junk() for _ in range(40)] + [junk(), prose()]
    labels = cases.labels(spark, [(i, int(i < 200), 0) for i in range(240)])  # 10 wrong ones
    docs = cases.documents(spark, texts).drop("lang").selectExpr("*", "'en' as lang")
    keep = {r.doc_id: r.keep for r in quality.classified(docs, labels).collect()}
    assert all(keep[i] for i in range(190)) and keep[241]
    assert not any(keep[i] for i in range(190, 241))


def scored(spark, rows):
    """Rows of (lang, quality, log of the perplexity), none seen by the model."""
    return spark.createDataFrame([(i, lang, False, q, 1, math.exp(p)) for i, (lang, q, p) in enumerate(rows)],
                                 "doc_id long, lang string, trusted boolean, quality int, n_symbols long, "
                                 "perplexity double").repartition(3)


def plain_thresholds(rows):
    """The definition, bin by bin."""
    bins = [(lang, q, math.floor(p * quality.BINS)) for lang, q, p in rows]
    def share(rows_, q, at):
        mine = [b for _, label, b in rows_ if label == q]
        return sum(b <= at for b in mine), len(mine)
    every = sorted({b for *_, b in bins})
    overall = {at: [(n / of if of else 0.0) for n, of in (share(bins, q, at) for q in (1, 0))] for at in every}
    best = max((b for b in every if overall[b][0] > 0), key=lambda b: (overall[b][0] - overall[b][1], -b))
    def edge(at, known):
        return math.exp((at + 1 + min((b for b in known if b > at), default=at + 1)) / 2 / quality.BINS)
    out = {None: edge(best, every)}
    for lang in {lang for lang, *_ in bins if lang is not None}:
        mine = [r for r in bins if r[0] == lang]
        known = {b for *_, b in mine} | {best}
        def gain(at):
            good, bad = ((n + quality.PRIOR * o) / (of + quality.PRIOR) for (n, of), o in zip(
                (share(mine, q, at) for q in (1, 0)), overall[at]))
            return good - bad
        out[lang] = edge(max(known, key=lambda b: (round(gain(b), 12), -b)), known)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_thresholds_follow_one_rule_at_every_size(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["en"] * 6 + ["de", "de", None]), q, rng.gauss(2 if q else 3, 0.4))
            for q in [1] * 200 + [0] * 40 for _ in range(1)] + [("few", 1, 2.2), ("bad", 0, 3.5)]
    by_lang, overall = quality._thresholds(scored(spark, rows))
    want = plain_thresholds(rows)
    assert overall == pytest.approx(want.pop(None))
    assert {r.of: r.threshold for r in by_lang.collect()} == pytest.approx(want)


def test_no_row_is_dealt_by_language_alone(spark):
    plan = quality._thresholds(scored(spark, [("en", 1, 2.0), (None, 0, 3.0)]))[0]._jdf.queryExecution().toString()
    assert "Pandas" not in plan


def test_input_that_differs_when_read_again(spark):
    """What may differ when read again is written first, what does not is not."""
    from pyspark.sql import functions as F
    plain = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert quality.reads_alike(plain.where("length(text) > 3").select("doc_id", "text"))
    texts = [f"abc {i} def" for i in range(50)]
    for docs in (cases.documents(spark, texts).where(F.rand() < 0.5), cases.documents(spark, texts).repartition(5),
                 cases.documents(spark, texts).sample(0.5), plain.limit(20)):
        assert not quality.reads_alike(docs)
        found = quality.perplexities(docs, cases.labels(spark, [(1, 1, 0)])).collect()
        assert all(r.perplexity > 0 for r in found)


class ByCodePoint(Plain):
    def grams(self, text):
        x = [0] * (self.order - 1) + [ord(c) + 1 for c in text]
        return [tuple(x[i:i + self.order]) for i in range(len(x) - self.order + 1)]


def test_all_code_points_are_different_symbols(spark):
    rng = random.Random(3)
    alphabet = [chr(c) for c in (97, 40_000, 40_767, 44_032, 44_799, 0xFFFD, 0x1F600, 0x1F8FF, 0x10FFFF)]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(30)]
    labels = cases.labels(spark, [(i, 1, 0) for i in range(20)])
    model = ByCodePoint(texts[:20], quality.ORDER)
    for row in quality.perplexities(cases.documents(spark, texts), labels).collect():
        assert row.perplexity == pytest.approx(model.perplexity(texts[row.doc_id]), rel=1e-9)
