"""The operators as queries over the sample tables, and their SQL where it exists."""

from __future__ import annotations

from landledger.llm import (collocations, decontamination, extraction, lexical_search,
                            neighbours, pseudonyms, quality, repeats, secrets, sentencepieces,
                            simhash, sql, token_counts, toxicity)
from landledger.llm.common import table

#: The model file of the token queries, a vocabulary found on the machine.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
#: The tokenizer file of the token counts.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
#: The key of the sample query; a real one comes from a key store.
SAMPLE_KEY = b"a key for samples only"


def op1_pii_pseudonyms(spark, sf_dir):
    return pseudonyms.report(table(spark, sf_dir, "documents"), SAMPLE_KEY)


def op2_simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_nearest_neighbours(spark, sf_dir):
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op4_html_extraction(spark, sf_dir):
    return extraction.report(table(spark, sf_dir, "pages"))


def op5_benchmark_decontamination(spark, sf_dir):
    return decontamination.report(decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"]))


def op6_toxicity(spark, sf_dir):
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_suffix_array_dedup(spark, sf_dir):
    return repeats.deduplicated(table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark, sf_dir):
    return quality.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_secret_scans(spark, sf_dir):
    return secrets.report(secrets.scan(table(spark, sf_dir, "documents"), keep=["doc_id"]))


def op10_sentencepiece(spark, sf_dir, pieces=PIECES):
    return sentencepieces.report(table(spark, sf_dir, "documents"),
                                 sentencepieces.read_model(pieces))


def op11_lexical_search(spark, sf_dir):
    return lexical_search.search(table(spark, sf_dir, "documents"),
                                 table(spark, sf_dir, "benchmark"))


def op12_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_token_counts(spark, sf_dir, tokenizer=TOKENIZER):
    return token_counts.report(table(spark, sf_dir, "documents"),
                               token_counts.read_tokenizer(tokenizer))


QUERIES = {f.__name__: f for f in (
    op1_pii_pseudonyms,
    op2_simhash_near_dedup,
    op3_nearest_neighbours,
    op4_html_extraction,
    op5_benchmark_decontamination,
    op6_toxicity,
    op7_suffix_array_dedup,
    op8_quality_classifier,
    op9_secret_scans,
    op10_sentencepiece,
    op11_lexical_search,
    op12_collocations,
    op13_token_counts,
)}

SQL = {
    "op5_benchmark_decontamination": sql.DECONTAMINATION,
    "op9_secret_scans": sql.SECRET_SCANS,
    "op11_lexical_search": sql.LEXICAL_SEARCH,
    "op12_collocations": sql.COLLOCATIONS,
}
