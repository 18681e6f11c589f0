"""SentencePiece coding against the library and against plain search."""

import os
import random

import numpy as np
import pandas as pd
import pytest
import sentencepiece

from landledger.llm import sentencepieces as s
from landledger.llm.queries import PIECES
from tests.llm import cases

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def model(library):
    return s.describe(library)


def ids(codec, text):
    return np.frombuffer(codec.encode(text), np.int32).tolist()


def strange(n):
    rng = random.Random(1)
    letters = "ab e▁ theéñ日本😀\n\t.,0123xyz<>'-"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_equals_the_library(library, model):
    codec, speller = s.Codec(model), s.Speller(model)
    texts = pd.read_parquet(f"{SF}/documents.parquet").text.tolist() + strange(2000)
    for text in texts:
        assert ids(codec, text) == library.encode(text)
        assert speller.decode(ids(codec, text)) == library.decode(library.encode(text))
    for some in ([3, 4, 200, 201, 259], [0, 5], [1, 2, 300], []):
        assert speller.decode(some) == library.decode(some)


def small(merged=False):
    """Pieces with made-up log-probabilities, as a unigram model has."""
    pieces = {"▁": -3.0, "a": -4.1, "b": -4.2, "c": -4.3, "ab": -5.0, "bc": -5.5, "abc": -8.2,
              "▁a": -5.1, "▁ab": -6.2, "ca": -6.0, "cab": -7.7, "bca": -9.0, ".": -4.0}
    names = ["<unk>", *pieces]
    return {"merged": merged, "prefix": True, "unknown": 0, "pieces": names,
            "scores": [0.0, *pieces.values()], "byte": [False] * len(names),
            "silent": [False] * len(names), "usable": [False] + [True] * len(pieces)}


def best_sum(text, pieces, unknown):
    best = [0.0] + [float("-inf")] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(end):
            score = pieces.get(text[start:end], unknown if end - start == 1 else float("-inf"))
            best[end] = max(best[end], best[start] + score)
    return best[-1]


def test_unigram_scores_reach_the_best_sum():
    model, rng = small(), random.Random(2)
    codec, speller = s.Codec(model), s.Speller(model)
    pieces = dict(zip(model["pieces"][1:], model["scores"][1:]))
    lowest = min(pieces.values()) - 10
    for _ in range(500):
        text = "".join(rng.choice("abc .d") for _ in range(rng.randint(1, 30)))
        found = ids(codec, text)
        total = sum(model["scores"][i] if i else lowest for i in found)
        assert total == pytest.approx(best_sum("▁" + text.replace(" ", "▁"), pieces, lowest))
        if 0 not in found:
            assert speller.decode(found) == text


def test_memory_is_bounded(monkeypatch, library, model):
    monkeypatch.setattr(s, "REMEMBERED", 50)
    monkeypatch.setattr(s, "NEIGHBOURS", 50)
    codec = s.Codec(model)
    for text in strange(300):
        assert ids(codec, text) == library.encode(text)
        assert max(map(len, (codec.remembered, codec.older, codec.neighbours))) <= 50


def test_operator_on_awkward_rows(spark, library, model):
    docs = cases.documents(spark, cases.TEXTS)
    rows = s.report(docs, model).orderBy("doc_id").collect()
    for row, text in zip(rows, cases.TEXTS):
        assert row.ids == library.encode(text or "") and row.n_tokens == len(row.ids)
        assert row.round_trip
    assert s.report(cases.awkward(spark), model).count() == 10
    assert s.report(cases.none(spark), model).count() == 0
    marked = s.report(cases.documents(spark, ["a▁b"]), model).first()
    assert not marked.round_trip
    back = s.decode(spark.createDataFrame([(None,), ([],)], "ids array<int>"), model, "ids", [])
    assert [r.decoded.text for r in back.collect()] == ["", ""]
