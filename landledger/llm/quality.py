"""Quality by the perplexity of a Kneser-Ney model of trusted text.

The model is an interpolated modified Kneser-Ney model over characters.  Counts of
the highest order come from all trusted documents; a lower order counts in how many
contexts a sequence continues.  Every count is a row, spread over the cluster by
its sequence; contexts, discounts and probabilities are joins and aggregates over
these rows, for exactly the sequences that occur in the documents.

Documents are read in packs of bounded size.  A pack asks once for each of its
different sequences, the join answers, and the pack is scored with its own answers;
so what moves is one row per pack and sequence, and each text once, compressed.
A pack is named by its content, and documents are read a second time to be scored.  An
input that may come in another order or with other rows then (one that was shuffled,
sampled or computed by a function) is written first.

A document is kept if its perplexity is at most the threshold of its language, a
quantile of the trusted documents that the model has not seen (a fifth of all, chosen
by a hash of the id).  Which quantile the labels say: the one where the share of such
documents below it less the share of documents labelled bad below it is greatest.  To
the documents of a language the shares of all languages are added like ``PRIOR`` more
documents, so a language with few labels leans on all of them and one with many on
its own, by one rule for every size.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from landledger.llm.common import (Scratch, broadcast_if_small, checkpointed, map_rows, release,
                                   utf8)

ORDER = 4
#: Documents that the shares of all languages count for in a language's own.
PRIOR = 20
#: One trusted document of so many is kept out of the model.
FOLDS = 5
#: Bins of a unit of log-perplexity in which documents are counted.
BINS = 200
#: Bytes of text in a pack.
PACK_BYTES = 16 << 20
#: Bits of a symbol, enough for every code point.
BITS = 21
#: A sequence of up to four symbols: its last two, and the ones before these.
KEY = ["front", "gram"]

_PACKED = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("trusted", pa.bool_()),
                     ("quality", pa.int32()), ("text", pa.binary())])


def symbols(text: bytes) -> np.ndarray:
    """The code point of every character plus one."""
    code = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    return code.astype(np.int64) + 1


def sequences(text: bytes, order: int = ORDER) -> np.ndarray:
    """For every character, it and the ones before it, the character in the lowest
    bits; before the text stand zeros.  The front is the real part and the last two
    symbols the imaginary one: 42 bits each, which floats hold exactly, and numpy sorts
    such pairs."""
    if not 1 <= order <= 4:
        raise ValueError("the order must be from 1 to 4")
    x = symbols(text)
    out = np.zeros(len(x), np.complex128)
    for part, backs in ((out.imag, range(min(order, 2))), (out.real, range(2, order))):
        for place, back in enumerate(backs):
            part[back:] += x[:len(x) - back] << (BITS * place)
    return out


def _as_sequences(front, gram) -> np.ndarray:
    out = np.empty(len(gram), np.complex128)
    out.real, out.imag = front, gram
    return out


def _packs(batches):
    """Tables of documents, each up to PACK_BYTES of text or a single document."""
    held, size = [], 0
    for batch in batches:
        doc_ids, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for row in zip(doc_ids, langs, batch.column(2).to_pylist(), batch.column(3).to_pylist(),
                       utf8(batch.column(4))):
            if held and size + len(row[-1] or b"") > PACK_BYTES:
                yield held
                held, size = [], 0
            held.append(row)
            size += len(row[-1] or b"")
    if held:
        yield held


def _name(rows) -> int:
    """A number from a pack's content.  Packs that share one share their answers."""
    digest = xxhash.xxh3_64()
    for doc_id, *_, text in rows:
        digest.update(repr((doc_id, len(text or b""))).encode() + (text or b""))
    return digest.intdigest() - (1 << 63)


def _asked(batches, order):
    """One row per pack: its different sequences and how often trusted texts hold them."""
    for rows in _packs(batches):
        found, counts = np.empty(0, np.complex128), np.empty(0, np.int64)
        for i in range(0, len(rows), 256):
            parts, weight = [found], [counts]
            for trusted in (False, True):
                texts = [sequences(r[-1], order) for r in rows[i:i + 256] if r[-1] and r[2] == trusted]
                if texts:
                    values, n = np.unique(np.concatenate(texts), return_counts=True)
                    parts.append(values)
                    weight.append(n if trusted else np.zeros(len(n), np.int64))
            found, place = np.unique(np.concatenate(parts), return_inverse=True)
            counts = np.bincount(place, np.concatenate(weight), len(found)).astype(np.int64)
        yield [[_name(rows)], *([zstandard.compress(x.tobytes(), 1)] for x in (
            found.real.astype(np.int64), found.imag.astype(np.int64), counts))]


def _rows_of(batches):
    for batch in batches:
        for pack, *arrays in zip(*(c.to_pylist() for c in batch.columns)):
            arrays = [np.frombuffer(zstandard.decompress(a), np.int64) for a in arrays]
            for i in range(0, len(arrays[0]), 65536):
                parts = [a[i:i + 65536] for a in arrays]
                yield [np.full(len(parts[0]), pack), *parts]


def _compressed(batches):
    for rows in _packs(batches):
        table = pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows), _PACKED)], schema=_PACKED)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _PACKED) as writer:
            writer.write_batch(table)
        yield [[_name(rows)], [zstandard.compress(sink.getvalue().to_pybytes(), 3)]]


def _scored(answers, packs, order):
    """Mean log-probability of the documents of a pack from its answers."""
    grams = _as_sequences(answers["front"], answers["gram"])
    place = np.argsort(grams, kind="stable")
    grams, logs = grams[place], answers["log"].to_numpy(float)[place]
    out = []
    for blob in packs["blob"]:
        table = pa.ipc.open_stream(zstandard.decompress(blob)).read_all()
        for doc_id, lang, trusted, quality, text in zip(*(c.to_pylist() for c in table.columns)):
            mean, n = None, 0
            if text:
                x = sequences(text, order)
                at = np.minimum(np.searchsorted(grams, x), max(0, len(grams) - 1))
                if not len(grams) or (grams[at] != x).any():
                    raise RuntimeError("a pack was read differently the second time")
                mean, n = float(logs[at].mean()), len(x)
            out.append((doc_id, lang, trusted, quality, n, mean))
    return pd.DataFrame(out, columns=["doc_id", "lang", "trusted", "quality", "n_symbols",
                                      "mean"]).astype(
        {"doc_id": "Int64", "quality": "Int32", "n_symbols": "int64", "mean": "float64"})


def _last(column, n):
    return F.col(column).bitwiseAND(F.lit((1 << (BITS * n)) - 1).cast("long"))


def _low(order, names=KEY):
    """The last ``order`` symbols of a sequence, as columns with these names."""
    return [_last("front", max(order - 2, 0)).alias(names[0]),
            _last("gram", min(order, 2)).alias(names[1])]


def _before(names):
    """A sequence without its last symbol, as columns with these names."""
    return [F.shiftright("front", BITS).alias(names[0]),
            F.shiftright("gram", BITS).bitwiseOR(F.shiftleft(_last("front", 1), BITS))
            .alias(names[1])]


def _counts(rows: DataFrame, order: int) -> list[DataFrame]:
    """Per order from 1: gram and a, the count of the highest order or the number
    of different symbols before a shorter sequence."""
    highest = checkpointed(rows.where("n > 0").groupBy(*KEY).agg(F.sum("n").alias("a")))
    levels = [highest]
    for n in range(order - 1, 0, -1):
        levels.append(checkpointed(levels[-1].groupBy(*_low(n))
                                   .agg(F.count("*").alias("a"))))
    return levels[::-1]


def _discounts(counts: DataFrame) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and more from the counts of
    counts; where these are missing, fixed ones."""
    n = counts.agg(*(F.sum((F.col("a") == i).cast("long")).alias(f"n{i}")
                     for i in range(1, 5))).first()
    n1, n2, n3, n4 = (x or 0 for x in n)
    if not (n1 and n2 and n3):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    raw = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
    return tuple(min(max(d, 0.05), i - 0.05) for i, d in enumerate(raw, 1))


def _held_back(d):
    """What the discounts take from the counts of a context."""
    return sum(d[i] * F.sum((F.col("a") == i + 1 if i < 2 else F.col("a") > 2).cast("long"))
               for i in range(3))


def _discounted(d):
    a = F.col("a")
    return a - F.when(a == 1, d[0]).when(a == 2, d[1]).otherwise(d[2])


def probabilities(grams: DataFrame, rows: DataFrame, order: int = ORDER) -> DataFrame:
    """front, gram and log (the natural logarithm of the last symbol's probability
    after the others) for the distinct ``grams``, under the model of the counts in
    ``rows`` (front, gram, n)."""
    levels = _counts(rows, order)
    d = _discounts(levels[0])
    total, held, kinds = levels[0].agg(
        F.sum("a"), _held_back(d), F.count("*")).first()
    # unseen symbols share what the discounts leave, as one more symbol
    rest = F.lit(held / total / (kinds + 1) if total else 1.0)
    asked = checkpointed(grams.select(*_low(1)).distinct())
    known = asked.join(levels[0], KEY, "left").select(*KEY, (
        F.coalesce(_discounted(d) / F.lit(float(total or 1)), F.lit(0.0)) + rest).alias("p"))
    context, shorter = ["c_front", "c_gram"], ["s_front", "s_gram"]
    for n in range(2, order + 1):
        d = _discounts(levels[n - 1])
        contexts = checkpointed(levels[n - 1].groupBy(*_before(context)).agg(
            F.sum("a").alias("total"), _held_back(d).alias("held")))
        asked = grams if n == order else grams.select(*_low(n)).distinct()
        lower = checkpointed(known).toDF(*shorter, "q")
        known = (asked.select(*KEY, *_before(context), *_low(n - 1, shorter))
                 .join(lower, shorter).join(contexts, context, "left")
                 .join(levels[n - 1], KEY, "left")
                 .select(*KEY, F.when(F.col("total").isNull(), F.col("q")).otherwise(
                     F.coalesce(_discounted(d), F.lit(0.0)) / F.col("total")
                     + F.col("held") / F.col("total") * F.col("q")).alias("p")))
    return known.select(*KEY, F.log("p").alias("log"))


def reads_alike(df: DataFrame) -> bool:
    """Whether every reading of ``df`` gives the same rows in the same order: plain scans,
    filters, projections and joins with broadcast sides do."""
    execution = df._jdf.queryExecution()
    moving = re.search(r"(?<!Broadcast)Exchange|Sample|Limit|Python|Arrow|Pandas|MapElements|MapPartitions",
                       execution.executedPlan().toString())
    return moving is None and execution.analyzed().deterministic()


def _with_trust(docs: DataFrame, labels: DataFrame, hold_out: bool) -> DataFrame:
    """doc_id, lang, trusted, quality (the label), text, in rows that every reading gives
    alike.  Few labels are broadcast and move no document."""
    marks = labels.where("quality in (0, 1) and doc_id is not null").groupBy(
        F.col("doc_id").alias("of")).agg(F.max("quality").cast("int").alias("quality"))
    good = F.coalesce(F.col("quality") == 1, F.lit(False))
    if hold_out:
        good &= F.crc32(F.col("of").cast("string")) % FOLDS != 0
    small = broadcast_if_small(marks, 24)
    rows = docs.select("doc_id", "lang", "text").join(
        small, F.col("doc_id") == F.col("of"), "left").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        F.coalesce(good, F.lit(False)).alias("trusted"), "quality", "text")
    return rows if small is not marks and reads_alike(docs) else Scratch(docs.sparkSession).keep(rows)


def perplexities(docs: DataFrame, labels: DataFrame, order: int = ORDER,
                 hold_out: bool = False) -> DataFrame:
    """doc_id, lang, trusted, quality, n_symbols and perplexity of every document.

    Trusted are the documents that ``labels`` give quality 1; with ``hold_out`` one
    of FOLDS of them, chosen by a hash of the id, is not.  A null or empty text has no
    perplexity.  One row per row of ``docs``, repeated rows included.
    """
    rows = _with_trust(docs, labels, hold_out)
    asked = checkpointed(map_rows(rows, "pack bigint, fronts binary, grams binary, counts binary",
                                  functools.partial(_asked, order=order)))
    each = map_rows(asked, "pack bigint, front bigint, gram bigint, n bigint", _rows_of)
    grams = checkpointed(each.groupBy(*KEY).agg(F.sum("n").alias("n")))
    model = checkpointed(probabilities(grams.select(*KEY), grams, order))
    # counts and contexts have served: their tables and shuffle files can go
    del grams
    release(docs.sparkSession)
    answers = each.select("pack", *KEY).join(model, KEY)
    packs = map_rows(rows, "pack bigint, blob binary", _compressed)
    scored = answers.groupBy("pack").cogroup(packs.groupBy("pack")).applyInPandas(
        lambda a, p: _scored(a, p, order),
        "doc_id bigint, lang string, trusted boolean, quality int, n_symbols bigint, mean double")
    return scored.select("doc_id", "lang", "trusted", "quality", "n_symbols",
                         F.exp(-F.col("mean")).alias("perplexity"))


def _below(column: str, by=()) -> Column:
    """Rows counted in this bin and those before it."""
    return F.sum(column).over(W.partitionBy(*(by or [F.lit(0)])).orderBy("bin"))


def _whole(column: str, by=()) -> Column:
    return F.sum(column).over(W.partitionBy(*(by or [F.lit(0)])))


def _thresholds(scored: DataFrame) -> tuple[DataFrame, float | None]:
    """of (a language) and threshold, and the one of all languages (None without a
    trusted document that the model has not seen).  Rows are counted in bins of
    log-perplexity first, of which there are few, so no language is a large group."""
    unseen = scored.where("not trusted and quality is not null and perplexity is not null")
    counted = checkpointed(unseen.groupBy("lang", F.floor(F.log("perplexity") * BINS).alias("bin")).agg(
        F.sum("quality").alias("good"), F.sum(1 - F.col("quality")).alias("bad")))
    share = lambda c: F.coalesce(_below(c) / F.nullif(_whole(c), F.lit(0)), F.lit(0.0))
    shares = checkpointed(counted.groupBy("bin").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
                          .select("bin", share("good").alias("all_good"), share("bad").alias("all_bad")))
    best = shares.where("all_good > 0").orderBy(F.desc(F.col("all_good") - F.col("all_bad")), "bin").first()
    empty = counted.select(F.col("lang").alias("of"), F.lit(0.0).alias("threshold")).limit(0)
    if best is None:
        return empty, None
    above = shares.where(F.col("bin") > best["bin"]).agg(F.min("bin")).first()[0]

    def edge(low, high):
        """Halfway from the end of a bin to the next counted one."""
        return F.exp((low + 1 + F.coalesce(high, low + 1)) / 2 / BINS)
    overall = shares.sparkSession.range(1).select(edge(
        F.lit(best["bin"]), F.lit(above).cast("bigint"))).first()[0]
    # every language is also asked about the bin that is best for all
    own = counted.where("lang is not null")
    own = own.unionByName(own.select("lang").distinct().select(
        "lang", F.lit(best["bin"]).alias("bin"), F.lit(0).cast("bigint").alias("good"),
        F.lit(0).cast("bigint").alias("bad"))).groupBy("lang", "bin").agg(
        F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    mixed = lambda c: (_below(c, ["lang"]) + PRIOR * F.col(f"all_{c}")) / (
        _whole(c, ["lang"]) + PRIOR)
    judged = own.join(shares, "bin").select("lang", "bin", (mixed("good") - mixed("bad")).alias("gain"),
                                            F.lead("bin").over(W.partitionBy("lang").orderBy("bin")).alias("next"))
    chosen = judged.groupBy("lang").agg(F.max(F.struct("gain", -F.col("bin"), "next")).alias("m"))
    return chosen.select(F.col("lang").alias("of"), edge(-F.col("m.col2"), F.col("m.next")).alias(
        "threshold")), overall


def classified(docs: DataFrame, labels: DataFrame, order: int = ORDER) -> DataFrame:
    """The perplexities with the threshold of the document's language and ``keep``.

    A language without labelled documents outside the model, and a null language, take
    the threshold of all languages; if there is no trusted document outside the model
    at all, everything with a text is kept.  Documents without text are not kept.
    """
    scored = checkpointed(perplexities(docs, labels, order, hold_out=True))
    by_lang, overall = _thresholds(scored)
    by_lang = checkpointed(by_lang)
    return scored.join(broadcast_if_small(by_lang, 64), F.col("lang") == F.col("of"), "left").select(
        "doc_id", "lang", "n_symbols", "perplexity",
        F.coalesce("threshold", F.lit(overall).cast("double")).alias("threshold")).withColumn(
        "keep", F.col("perplexity").isNotNull() & F.coalesce(
            F.col("perplexity") <= F.col("threshold"), F.lit(True)))
