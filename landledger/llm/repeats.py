"""Removal of repeated byte strings by counted hashes of growing lengths.

A byte goes if a string of ``THRESHOLD`` bytes covering it also starts earlier.  This
takes the place of prefix doubling: no ranks are made from pairs of earlier ranks, as
ranking every position moves hundreds of times the text (README).  Neighbouring starts
are ranked together instead, by the hash of what all their strings have in common.
Equality is by hashes, not compared byte by byte: of two equal strings the anchors agree
in 64 bits and the rest in another 64, in the last round the whole string in 128.  A
collision would need equal anchors first, so only strings that share 40 bytes can be
mistaken for each other.

* Every string of THRESHOLD bytes holds THRESHOLD - FIRST + 1 strings of FIRST
  bytes; the one with the smallest hash (the leftmost of equals) is its anchor.
  Equal strings have equal anchors at equal distances.  Starts that share an anchor
  are a run, its rank the hash of the anchor, its cover the hash of all bytes that
  its strings cover.
* A round sorts the rows by rank.  A rank met once is done: none of the strings
  repeats.  Of rows with one rank and one cover all but the first are done as well:
  every string starts earlier.  Only the first of each cover goes on, and only if
  its rank has several covers.
* The next round cuts these runs into groups of ``GROUP`` starts, counted from the
  anchor, and ranks them by the THRESHOLD - GROUP + 1 bytes that the strings of a
  group share; the last ranks single starts by their THRESHOLD bytes, with a second
  hash of these as cover.  What is then
  met again has reached the threshold: the smallest place keeps its string.

Spans of a document are merged and cut out of its bytes.  Texts are shuffled once,
compressed; after that only those of documents with a repeat are kept.  Rounds end
in checkpoints, and the shuffle files behind them are given back.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landledger.llm.common import Scratch, checkpointed, map_rows, release, utf8, with_result

THRESHOLD = 100
FIRST, GROUP = 40, 8
#: Starts that are worked on at a time, so that a long text needs no more memory.
CHUNK, _PLACE_BITS = 1 << 20, 21

# Odd multipliers for the running sums of both hashes and one for mixing.
_BASE, _SECOND, _MIX = 6364136223846793005, 0xDA942042E4DD58B5, 0x9E3779B97F4A7C15


def _powers(base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, for a whole chunk."""
    def table(base):
        out = np.full(CHUNK + THRESHOLD, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)
    return table(base), table(pow(base, -1, 1 << 64))


class Hashes:
    """Hashes of any stretch of a piece of text, from running sums (modulo 2**64);
    equal stretches have equal hashes wherever they stand."""

    def __init__(self, piece: bytes, powers):
        up, self.down = powers
        codes = np.frombuffer(piece, np.uint8).astype(np.uint64) + np.uint64(1)
        self.n = len(piece)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(
            codes * up[:self.n], dtype=np.uint64)])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        x = (self.sums[end] - self.sums[start]) * self.down[start]
        x ^= x >> np.uint64(31)
        x *= np.uint64(_MIX)
        return x ^ (x >> np.uint64(29))

    def all(self, size: int) -> np.ndarray:
        start = np.arange(max(0, self.n - size + 1))
        return self.of(start, start + size)


def _anchors(x: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest value (by its high bits; the leftmost of equals) in
    every window of ``width`` values."""
    place = np.uint64((1 << _PLACE_BITS) - 1)
    best = (x & ~place) | np.arange(len(x), dtype=np.uint64)
    size = 1
    while size < width:  # windows double, the last two halves overlap
        step = min(size, width - size)
        best = np.minimum(best[:-step], best[step:])
        size += step
    return (best & place).astype(np.int64)


class Block:
    """Pieces of many documents side by side, so that arrays stay long.  A start is
    good if its whole string lies in its piece."""

    def __init__(self, pieces, powers, second=None):
        keys, parts, offsets, texts = zip(*pieces)
        size = np.array([len(t) for t in texts])
        end = np.cumsum(size)
        starts = size - THRESHOLD + 1  # good ones, the first of each piece
        self.piece = np.repeat(np.arange(len(size)), starts)
        within = np.arange(len(self.piece)) - np.repeat(np.cumsum(starts) - starts, starts)
        self.good = (end - size)[self.piece] + within
        self.place = np.array(offsets)[self.piece] + within
        self.keys, self.parts = np.array(keys)[self.piece], np.array(parts)[self.piece]
        self.hashes = Hashes(b"".join(texts), powers)
        self.second = Hashes(b"".join(texts), second) if second else None

    def rows(self, group: int | None):
        """Rank, cover, key, part and place of every run or group of starts; start
        and length are packed into the place."""
        good, of = self.good, self.hashes.of
        if group == 1:
            ranks = of(good, good + THRESHOLD)
            covers = self.second.of(good, good + THRESHOLD)
            first, n = np.arange(len(good)), 1
        else:
            grams = self.hashes.all(FIRST)
            anchor = _anchors(grams, THRESHOLD - FIRST + 1)[good]
            number = (anchor - good) // (group or THRESHOLD)
            first = np.concatenate([[0], np.flatnonzero(
                np.diff(anchor) | np.diff(number) | np.diff(self.piece)) + 1])
            last = np.concatenate([first[1:], [len(good)]]) - 1
            covers, n = of(good[first], good[last] + THRESHOLD), last - first + 1
            if group is None:
                ranks = grams[anchor[first]]
            else:  # what all strings of a full group share, wherever this one is cut off
                latest = anchor[first] - number[first] * group
                ranks = of(latest, latest - group + 1 + THRESHOLD)
        return [ranks.view(np.int64), covers.view(np.int64), self.keys[first], self.parts[first],
                self.place[first] << 8 | n]


def _blocked(pieces, group):
    """Rows of all pieces (key, part, offset, bytes), a chunk at a time."""
    powers, held, size = (_powers(), _powers(_SECOND) if group == 1 else None), [], 0
    with np.errstate(over="ignore"):
        for key, part, offset, text in pieces:
            for at in range(0, len(text) - THRESHOLD + 1, CHUNK):
                piece = text[at:at + CHUNK + THRESHOLD - 1]
                if held and size + len(piece) > CHUNK + THRESHOLD - 1:
                    yield Block(held, *powers).rows(group)
                    held, size = [], 0
                held.append((key, part, offset + at, piece))
                size += len(piece)
        if held:
            yield Block(held, *powers).rows(group)


def _runs(batches):
    def pieces():
        for batch in batches:
            for key, part, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                       utf8(batch.column(2))):
                yield key, part, 0, text or b""
    return _blocked(pieces(), None)


def _packed(texts):
    texts = [t or b"" for t in utf8(texts)]
    compress = zstandard.ZstdCompressor(level=3).compress
    return [[len(t) for t in texts], [hashlib.sha256(t).hexdigest() for t in texts],
            [compress(t) for t in texts]]


def _merged(spans: np.ndarray) -> np.ndarray:
    """Disjoint ranges with the same bytes, in order."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    first = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    last = np.concatenate([np.flatnonzero(first)[1:] - 1, [len(spans) - 1]])
    return np.column_stack([spans[first, 0], reach[last]])


def _finer(batches, group):
    """Rows of the next round for the open runs of each document."""
    def pieces():
        for batch in batches:
            for key, part, blob, runs in zip(*(c.to_pylist() for c in batch.columns)):
                text, runs = zstandard.decompress(blob), np.array(runs, np.int64)
                for a, b in _merged(np.column_stack(
                        [runs >> 8, (runs >> 8) + (runs & 255)])).tolist():
                    yield key, part, a, text[a:b + THRESHOLD - 1]
    return _blocked(pieces(), group)


def _cut(blobs, digests, runs):
    """Bytes removed, spans and digest of what is left, by document."""
    out = [[], [], []]
    for blob, digest, places in zip(*(c.to_pylist() for c in (blobs, digests, runs))):
        removed = spans = 0
        if places:
            text, places = zstandard.decompress(blob), np.array(places, np.int64)
            start, n = places >> 8, places & 255
            kept, at = [], 0
            covered = _merged(np.column_stack([start, start + n - 1 + THRESHOLD])).tolist()
            for a, b in covered:
                kept.append(text[at:a])
                at = b
            left = b"".join([*kept, text[at:]])
            removed, spans = len(text) - len(left), len(covered)
            digest = hashlib.sha256(left).hexdigest()
        for column, value in zip(out, (removed, spans, digest)):
            column.append(value)
    return out


def _keyed(docs: DataFrame, unique: bool) -> DataFrame:
    """The documents with their place in the order: key (a null id comes last) and
    part, which tells different texts under one id apart."""
    part = F.lit(0).cast("bigint") if unique else F.xxhash64("text")
    return docs.select("doc_id", F.coalesce(F.col("doc_id").cast("bigint"), F.lit((1 << 63) - 1))
                       .alias("key"), part.alias("part"), "text")


_PLACE = ["key", "part", "place"]
_ROW = "rank bigint, cover bigint, key bigint, part bigint, place bigint"


def _round(scratch: Scratch, rows: DataFrame, name: str, last: bool = False):
    """The places whose strings all start earlier, and those that go on."""
    spark, place = rows.sparkSession, F.struct(*_PLACE)
    again = scratch.keep(rows.groupBy("rank").agg(F.count("*").alias("n"))
                         .where("n > 1").select("rank"), "again")
    release(spark)
    rows = scratch.keep(rows.join(again, "rank", "left_semi"), "rows")
    release(spark)
    kinds = scratch.keep(rows.groupBy("rank", "cover").agg(
        F.min(place).alias("first"), F.count("*").alias("n")), "kinds")
    release(spark)
    later = scratch.keep(
        rows.join(kinds.where("n > 1").select("rank", "cover", "first"), ["rank", "cover"])
        .where(place != F.col("first")).select(*_PLACE), f"later_{name}")
    release(spark)
    open_ = None
    if not last:
        several = scratch.keep(kinds.groupBy("rank").agg(F.count("*").alias("kinds"))
                               .where("kinds > 1").select("rank"), "several")
        open_ = scratch.keep(kinds.join(several, "rank", "left_semi").select("first.*"),
                             f"open_{name}")
    scratch.drop("again", "rows", "kinds", "several")
    release(spark)
    return later, open_


def _by_document(places: DataFrame, name: str) -> DataFrame:
    """The places of each document as one list, which its length bounds."""
    return places.groupBy("key", "part").agg(F.collect_list("place").alias(name))


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 for every row of ``docs``.

    A null or empty text has no bytes.  A null doc_id comes after all others.  Rows
    that agree in id and text are judged as one document; different texts under one
    id are different documents, in the order of a hash of their text.
    """
    document = ["key", "part"]
    unique = docs.groupBy("doc_id").count().where("count > 1").isEmpty()
    keyed = _keyed(docs, unique)
    judged = keyed.select("key", "part", "text")
    if not unique:
        judged = judged.dropDuplicates(document)
    scratch = Scratch(docs.sparkSession)
    later, open_ = _round(scratch, map_rows(judged, _ROW, _runs), "runs")
    touched = later.select(document).union(open_.select(document)).distinct()
    packed = with_result(keyed, ["text"], ["doc_id", "key", "part"], "packed",
                         "n_bytes bigint, digest string, blob binary", _packed)
    table = checkpointed(
        packed.join(touched.withColumn("touched", F.lit(True)), document, "left").select(
            "doc_id", "key", "part", "packed.n_bytes", "packed.digest",
            F.when(F.col("touched"), F.col("packed.blob")).alias("blob")))
    release(docs.sparkSession)
    texts = table.where("blob is not null").select("key", "part", "blob")
    if not unique:
        texts = texts.dropDuplicates(document)
    covered = later
    for group in (GROUP, 1):
        asked = texts.join(_by_document(open_, "open"), document).select(
            "key", "part", "blob", "open")
        # written first: the texts move once a round
        rows = scratch.keep(map_rows(asked, _ROW, functools.partial(_finer, group=group)), "finer")
        release(docs.sparkSession)
        later, open_ = _round(scratch, rows, f"groups_{group}", last=group == 1)
        covered = covered.union(later)
    covered = checkpointed(_by_document(covered, "covered"))
    scratch.close()
    release(docs.sparkSession)
    found = table.join(covered, document, "left")
    result = with_result(found, ["blob", "digest", "covered"], ["doc_id", "n_bytes"], "cut",
                         "n_removed bigint, n_spans bigint, kept_sha256 string", _cut)
    return result.select("doc_id", "n_bytes", "cut.*")
