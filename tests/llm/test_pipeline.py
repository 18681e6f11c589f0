"""The corpus pipeline against the plain forms of its stages."""

import itertools

import sentencepiece

import corpus_pipeline
from landledger.llm import secrets, simhash, toxicity
from landledger.llm.queries import PIECES
from tests.llm import cases
from tests.llm.test_decontamination import brute as brute_hits
from tests.llm.test_simhash import brute_fingerprint

ITEM = "what is the capital city of a very small island far away"
TEXTS = [
    "a plain text about nothing much at all", "A Plain text about nothing much at all",
    "you idiot and moron, you are worthless scum and trash",
    f"see {ITEM} for more", "token = 0123456789abcdef0123456789abcdef and some more words",
    "another text, quite different from the others here", "", None]


def written(spark, tmp_path, texts):
    cases.documents(spark, texts).select("doc_id", "text", "lang", "source", "n_chars") \
        .write.parquet(f"{tmp_path}/documents.parquet")
    cases.benchmark(spark, [(1, ITEM)]).write.parquet(f"{tmp_path}/benchmark.parquet")
    cases.labels(spark, [(0, 1, 0), (2, 0, 1)]).write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_stages_take_effect(spark, tmp_path):
    folder = written(spark, tmp_path, TEXTS)
    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    model = toxicity.fit(spark.read.parquet(f"{folder}/documents.parquet"),
                         spark.read.parquet(f"{folder}/labels.parquet"))
    automaton, (base, slope) = toxicity._automaton(model)
    kept = [(i, x) for i, x in enumerate(TEXTS)
            if base + slope * toxicity._density(toxicity.folded(x or ""), automaton)[0] < 0]
    assert 2 not in dict(kept) and len(kept) == 7
    prints = {i: brute_fingerprint(x) for i, x in kept}
    root = {i: i for i in prints}
    for a, b in itertools.combinations(prints, 2):
        if (prints[a] ^ prints[b]).bit_count() <= 2:
            low, high = sorted((root[a], root[b]))
            root = {i: low if r == high else r for i, r in root.items()}
    kept = [(i, x) for i, x in kept if root[i] == i]
    hits = brute_hits([x for _, x in kept], [ITEM])
    kept = [(i, x) for (i, x), (_, hit, _) in zip(kept, hits) if not hit]
    assert sorted(rows) == [i for i, _ in kept] == [0, 4, 5, 6]
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for i, text in kept:
        text = "[SECRET] and some more words" if i == 4 else text
        assert rows[i].ids == library.encode(text or "") and rows[i].round_trip


def test_stages_keep_the_columns_and_take_empty_tables(spark, tmp_path):
    folder = written(spark, tmp_path, [])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).schema == docs.schema
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_awkward_rows_pass(spark, tmp_path):
    folder = written(spark, tmp_path, TEXTS)
    docs = cases.awkward(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == cases.awkward(spark).columns
    assert docs.count() == 5
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == 5
    assert simhash.keep_first(secrets.masked(docs)).count() == 5
