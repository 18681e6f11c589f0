"""Token counts against the library's own on whole texts."""

import json
import random

import pytest

from landledger.llm import token_counts as t
from landledger.llm.queries import TOKENIZER, op13_token_counts
from tests.llm import cases

PARTS = ["the ", "word", " it's", "'re", " ", "   ", "\n\n", "\t", "don't", "1234567", "é日本", "😀😀",
         "<|endoftext|>", "<|endof", "text|>", "...", "?!", "x", " you'll", "ü" * 7, "  "]


def description():
    return t.read_tokenizer(TOKENIZER)


def plain(texts):
    library = t._build(description())
    return [(len((x or "").encode()), len(library.encode(x or "", add_special_tokens=False).ids))
            for x in texts]


def texts(seed, n=40):
    rng = random.Random(seed)
    made = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 400))) for _ in range(n)]
    runs = ["a" * 3000, " " * 900 + "x" + " " * 900, "abc " * 50 + "q" * 700 + " end" * 60,
            "<|endoftext|>" * 90, "'" * 500 + "re", "1 " * 800]
    return [*made, *runs, *runs[:2], None, "", "x"]


@pytest.mark.parametrize("fragment, span", [(24, 2), (40, 3), (150, 2), (t.FRAGMENT, t.SPAN)])
def test_equals_the_library_on_whole_texts(spark, fragment, span):
    rows = texts(fragment)
    found = t.counted(cases.documents(spark, rows).repartition(3), description(), ["doc_id"],
                      fragment=fragment, span=span).collect()
    assert [tuple(r.tokens) for r in sorted(found)] == plain(rows)


def test_a_run_longer_than_overlap_and_chunk_widens(spark, monkeypatch):
    rounds, real = [], t._spliced
    monkeypatch.setattr(t, "_spliced", lambda *a: rounds.append(a[2]) or real(*a))
    rows = ["ab" * 5000, "some words " * 300]
    found = t.counted(cases.documents(spark, rows), description(), ["doc_id"],
                      fragment=32, span=4).collect()
    assert [tuple(r.tokens) for r in sorted(found)] == plain(rows)
    assert rounds == [32 * 4 ** i for i in range(len(rounds))] and 3 <= len(rounds) <= 6


def test_awkward_rows_and_clashing_names(spark):
    docs = cases.awkward(spark).withColumnRenamed("bits", "key").withColumnRenamed("secrets", "kind")
    found = t.counted(docs, description(), fragment=1000, span=8)
    assert found.columns == [*docs.columns, "tokens"]
    assert sorted((r.text or "", *r.tokens) for r in found.collect()) == sorted(
        (x or "", *c) for x, c in zip(cases.TEXTS, plain(cases.TEXTS)))
    with pytest.raises(ValueError):
        t.counted(docs, description(), out="KIND")


def test_empty_table(spark):
    assert t.report(cases.none(spark), description()).collect() == []


def test_report(spark):
    docs = cases.documents(spark, ["a b " * 256, "a b " * 257, None])
    assert cases.pairs(t.report(docs, description()), "n_bytes", "n_tokens", "over_limit") == sorted(
        [(1024, 513, True), (1028, 515, True), (0, 0, False)], key=repr)


def test_query_on_the_sample_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = op13_token_counts(spark, folder).collect()
    assert len(found) == len(rows)
    want = dict(zip(rows, plain([r.text for r in rows.values()])))
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in found} == want
    assert all(r.over_limit == (r.n_tokens > 512) for r in found)


def test_what_may_be_spliced():
    own = json.loads(description())
    assert t.margin(description()) == 4 + len("<|endoftext|>")
    own["normalizer"] = {"type": "Lowercase"}
    assert t.margin(json.dumps(own)) is None
    own["normalizer"] = None
    own["added_tokens"].append({"content": ">x<"})
    assert t.margin(json.dumps(own)) is None


def test_a_tokenizer_that_lowers_is_used_on_whole_texts(spark):
    described = t.read_tokenizer(TOKENIZER.replace("byte_bpe_50k", "word_bpe_49k"))
    rows = ["Some WORDS here " * 40, "", None]
    library = t._build(described)
    found = t.counted(cases.documents(spark, rows), described, ["doc_id"], fragment=16, span=2)
    assert [r.tokens.n_tokens for r in sorted(found.collect())] == [
        len(library.encode(x or "", add_special_tokens=False).ids) for x in rows]
