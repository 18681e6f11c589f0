"""Ranked lexical search of queries over all documents, by deduplicated bags.

A document matters to a set of queries only through the counts of the queries'
terms in it (its bag) and its length factor m.  So each document is first reduced
to these; documents with the same bag and m are one class, found by a hash and
verified by comparing the bags.  Classes are scored once: tasks hold the queries as
postings and keep the best classes per query, Spark merges the tasks' lists.  Of a
query's classes, ordered by score and smallest member, the first ``top`` hold its
``top`` documents; their members come back by ascending id, ``top`` of each at most.

Queries are taken in blocks of bounded size, one after the other; equal texts are
one query.  Collection statistics cover all documents.  Every number is a whole
number but the logarithm in a term's weight, which is taken once, on the driver.
"""

from __future__ import annotations

import functools
import math
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from landledger.llm.common import Once, Scratch, map_rows, slices, utf8
from landledger.llm.decontamination import words

TOP = 20
#: Bytes of queries that are searched at a time, and what each query counts besides
#: its text (its list of best classes in every task).
BLOCK_BYTES, QUERY_BYTES = 8 << 20, 1 << 10
#: Scores, and additions, that a task holds at a time.
CELLS, ADDITIONS = 2 << 20, 2 << 20
#: Sums of doubles below this are exact whole numbers.
_EXACT = 1 << 53
#: Statistics that travel as two more terms.
_DOCUMENTS, _LENGTH = -1, -2
#: Stands for a null id, which ranks behind all others.
_LAST_ID = (1 << 63) - 1


class Block:
    """Vocabulary and postings of some queries, built on the driver and in tasks."""

    def __init__(self, texts: list[bytes]):
        self.bags = [Counter(words(t)) for t in texts]
        self.terms = {t: i for i, t in enumerate(sorted(set().union(*self.bags)))}
        entries = sorted((self.terms[t], q, c) for q, bag in enumerate(self.bags)
                         for t, c in bag.items())
        terms, self.query, self.repeats = (
            np.array(entries, np.int64).reshape(-1, 3).T)
        self.start = np.searchsorted(terms, np.arange(len(self.terms) + 1))
        self.size = len(texts)
        self.longest = max((bag.total() for bag in self.bags), default=0)


def _bags(batches, *, block):
    """Per document its number of terms and the counts of the queries' terms, as
    pairs of 32-bit numbers in the order of the terms."""
    number = block.get().terms.get
    for batch in slices(batches):
        lengths, bags = [], []
        for text in utf8(batch.column(1)):
            found = words(text)
            counts = Counter(map(number, found))
            counts.pop(None, None)
            lengths.append(len(found))
            bags.append(np.array(sorted(counts.items()), "<i4").tobytes())
        yield [batch.column(0), lengths, bags]


def _pairs(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and count of every entry of a column of bags."""
    raw = column.to_pylist()
    pairs = np.frombuffer(b"".join(raw), "<i4").reshape(-1, 2).astype(np.int64)
    rows = np.repeat(np.arange(len(raw)), [len(b) // 8 for b in raw])
    return rows, pairs[:, 0], pairs[:, 1]


def _statistics(batches, *, size):
    """Documents that hold each term; documents with terms, and their lengths."""
    holding, documents, length = np.zeros(size, np.int64), 0, 0
    for batch in slices(batches):
        holding += np.bincount(_pairs(batch.column(1))[1], minlength=size)
        lengths = batch.column(0).to_numpy()
        documents, length = documents + int((lengths > 0).sum()), length + int(lengths.sum())
    seen = np.flatnonzero(holding)
    yield [[*seen.tolist(), _DOCUMENTS, _LENGTH], [*holding[seen].tolist(), documents, length]]


def _weights(spark_rows, size) -> tuple[list[int], int, int]:
    counts = dict(map(tuple, spark_rows))
    n = counts.pop(_DOCUMENTS, 0)
    length = counts.pop(_LENGTH, 0)
    return [math.floor(1000 * math.log((2 * n + 2) / (2 * counts.get(t, 0) + 1)))
            for t in range(size)], n, length


class _Best:
    """The best classes of every query seen by a task."""

    def __init__(self, size: int, top: int):
        self.top, self.least = top, np.ones(size)
        self.query = self.score = self.first = self.slot = np.zeros(0, np.int64)
        self.kept: list[tuple] = []

    def add(self, scores: np.ndarray, first: np.ndarray, classes) -> None:
        """``scores`` by row and query; ``classes(rows)`` gives what names them."""
        least = self.least
        if len(scores) > self.top:
            least = np.maximum(least, np.partition(scores, -self.top, axis=0)[-self.top])
        row, query = np.nonzero(scores >= least)
        if not len(row):
            return
        new = np.unique(row)
        base = len(self.kept)
        self.kept.extend(classes(new))
        joined = [np.concatenate(pair) for pair in (
            (self.query, query), (self.score, scores[row, query].astype(np.int64)),
            (self.first, first[row]), (self.slot, base + np.searchsorted(new, row)))]
        order = np.lexsort((joined[2], -joined[1], joined[0]))
        joined = [column[order] for column in joined]
        starts = np.searchsorted(joined[0], joined[0])
        place = np.arange(len(order)) - starts
        self.query, self.score, self.first, self.slot = (c[place < self.top] for c in joined)
        full = place == self.top - 1
        self.least[joined[0][full]] = joined[1][full]
        used, self.slot = np.unique(self.slot, return_inverse=True)
        self.kept = [self.kept[i] for i in used]


def _scores(rows, terms, values, n_rows, block, exact):
    """Scores by row and query: postings of the terms, weighted and summed."""
    many = block.start[terms + 1] - block.start[terms]
    entry = np.repeat(np.arange(len(terms)), many)
    posting = np.arange(len(entry)) + np.repeat(
        block.start[terms] - (np.cumsum(many) - many), many)
    cell = rows[entry] * block.size + block.query[posting]
    added = values[entry] * block.repeats[posting]
    if exact:
        sums = np.bincount(cell, weights=added, minlength=n_rows * block.size)
    else:
        sums = np.zeros(n_rows * block.size, np.int64)
        np.add.at(sums, cell, added)
    return sums.reshape(n_rows, block.size)


def _search(batches, *, block, weights, top):
    """The best classes of this task for every query."""
    block = block.get()
    weights = np.array(weights, np.int64)
    # a term adds less than a million times its weight
    exact = int(weights.max(initial=0)) * 10 ** 6 * block.longest < _EXACT
    best = _Best(block.size, top)
    for batch in slices(batches, max(1, CELLS // max(1, block.size))):
        digest, m, bag, first = (batch.column(i) for i in range(4))
        rows, terms, counts = _pairs(bag)
        factor = m.to_numpy()
        values = weights[terms] * ((10 ** 9 * counts) // (1000 * counts + 12 * factor[rows]))
        smallest = first.to_numpy()
        cost = np.bincount(rows, weights=block.start[terms + 1] - block.start[terms],
                           minlength=len(batch))
        group = (np.cumsum(cost) // ADDITIONS).astype(int)
        for g in np.unique(group):
            low, high = np.searchsorted(group, [g, g + 1])
            a, b = np.searchsorted(rows, [low, high])
            found = _scores(rows[a:b] - low, terms[a:b], values[a:b], high - low, block, exact)

            def classes(chosen, low=low):
                return [(digest[i].as_py(), m[i].as_py(), bag[i].as_py())
                        for i in (chosen + low).tolist()]
            best.add(found, smallest[low:high], classes)
    names = [best.kept[i] for i in best.slot.tolist()]
    yield [best.query, best.score, best.first, *(list(c) for c in zip(*names))] if names else [
        [], [], [], [], [], []]


def _block_results(docs: DataFrame, texts: list[bytes], top: int, scratch: Scratch) -> DataFrame:
    """query (place in ``texts``), rank, doc_id and score."""
    spark = docs.sparkSession
    block, once = Block(texts), Once(spark, texts, Block)
    kind = docs.schema["doc_id"].dataType.simpleString()
    bags = scratch.keep(map_rows(docs.select("doc_id", "text"),
                                 f"doc_id {kind}, n bigint, bag binary",
                                 functools.partial(_bags, block=once)))
    size = len(block.terms)
    counts = (map_rows(bags.select("n", "bag"), "term bigint, n bigint",
                       functools.partial(_statistics, size=size))
              .groupBy("term").agg(F.sum("n").alias("n")).collect())  # the terms of one block
    weights, n, length = _weights(counts, size)
    members = bags.where(F.octet_length("bag") > 0).select(
        "doc_id", F.xxhash64("bag").alias("digest"),
        (F.lit(75).cast("bigint") + F.expr(f"(25L * n * {n}L) div {max(1, length)}L")).alias("m"),
        "bag")
    name = ["digest", "m", "bag"]
    order_id = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST_ID))
    classes = members.groupBy(*name).agg(F.min(order_id).alias("first"))
    parts = map_rows(classes.select("digest", "m", "bag", "first"),
                     "query bigint, score bigint, first bigint, digest bigint, m bigint, bag binary",
                     functools.partial(_search, block=once, weights=weights, top=top))
    ranked = W.partitionBy("query").orderBy(F.desc("score"), "first", *name)
    best = scratch.keep(parts.withColumn("place", F.row_number().over(ranked))
                        .where(F.col("place") <= top).select("query", "score", *name))
    inside = W.partitionBy(*name).orderBy(order_id)
    # digests of bounded number: at most ``top`` a query, queries by their bytes
    wanted = F.broadcast(best.select("digest", "m").distinct())
    chosen = (members.join(wanted, ["digest", "m"], "left_semi")
              .withColumn("place", F.row_number().over(inside)).where(F.col("place") <= top))
    final = W.partitionBy("query").orderBy(F.desc("score"), order_id)
    return (best.join(chosen, name)
            .withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= top)
            .select("query", "rank", "doc_id", "score"))


def search(docs: DataFrame, items: DataFrame, top: int = TOP,
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the ``top`` documents with a score
    above 0 of every row of ``items`` (item_id, text).

    Every row of ``docs`` is a document, also where ids or rows repeat; documents of
    equal score rank by ascending id, null ids last, rows that share an id in any
    order.  Null and empty texts have no terms: such documents are not counted, such
    items have no rows.  Items that repeat, or share an id, are answered row by row.
    Empty tables give an empty result.  Other columns have no influence.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    key = F.sha2(F.col("text").cast("binary"), 256)
    texts = items.where("text is not null").select(key.alias("key"), "text").distinct()
    total = texts.agg(F.sum(F.octet_length("text") + QUERY_BYTES)).first()[0] or 0
    n = max(1, math.ceil(total / block_bytes))
    answers = []
    for number in range(n):
        block = texts.where(F.pmod(F.xxhash64("key"), F.lit(n)) == number).orderBy("key").collect()
        if not block:
            continue
        found = _block_results(docs, [r["text"].encode() for r in block], top, scratch)
        keys = spark.createDataFrame([(i, r["key"]) for i, r in enumerate(block)],
                                     "query bigint, key string")
        answers.append(scratch.keep(found.join(keys, "query").drop("query")))
    ids = items.select("item_id", key.alias("key"))
    if not answers:
        kind = docs.schema["doc_id"].dataType
        return ids.where(F.lit(False)).select(
            "item_id", F.lit(0).alias("rank"), F.lit(None).cast(kind).alias("doc_id"),
            F.lit(0).cast("bigint").alias("score"))
    return ids.join(functools.reduce(DataFrame.union, answers), "key").select(
        "item_id", "rank", "doc_id", "score")
