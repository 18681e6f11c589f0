"""Phrase collocations by the stripes pattern.

Every prefix (of none, one, ... words) keys an associative counter of the words
that come next, its stripe.  A task fills stripes while it reads whole texts and
hands on what it has when they grow large.  Spark deals the stripes out by prefix
and adds up equal elements.  A stripe may hold a large share of all elements, so that
of a prefix with more than one in ``SPREAD`` of all words is dealt out in parts by its
next words, as many as keep each part below that share; such prefixes are known from
the counts of the shorter phrases and number fewer than ``SPREAD``.

The merged stripes are all there is to know.  An element is the count f of a phrase,
prefix and next word; the stripe of the empty prefix holds the words, and its total is
n.  The counts of a candidate's parts are elements of shorter prefixes' stripes, and
the largest count of a longer phrase around a candidate is a maximum over the elements
of its own stripe (words added behind) and of those whose prefix and word end with it
(words added before).

A phrase is at most as frequent as its parts.  So stripes are read off the texts by
length of their prefix, the shorter first, and a phrase is left out where its first
or its last words are surely too rare.  What is frequent goes to the tasks as bits of
hashes, a field of fixed size: a rare phrase that it lets pass only costs time, its
exact count is dropped after the merge.

Inside a task words are numbers and phrases rows of an array; sorting them gives the
stripes, one after the other.
"""

from __future__ import annotations

import functools
import itertools
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from landledger.llm.common import Scratch, map_rows, slices, utf8

LONGEST, LEAST, SHARE, TOP = 3, 10, 50, 2000
#: Stands for a null language.
NO_LANGUAGE = "und"
#: Phrases and different words that a task holds before it hands its stripes on.
HELD, VOCABULARY = 1_500_000, 300_000
#: Bytes of text that are cut into words at a time.
CHUNK = 1 << 20
#: A part of a stripe holds at most about one in so many of all words.
SPREAD = 4096
#: Parts of the stripe of the empty prefix, which holds a vocabulary.
WORD_PARTS = 256
#: Bits of the field of frequent phrases, and those of one aggregated bitmap.
BITS, _BITMAP = 1 << 26, 1 << 15
_UNIT = 1_000_000
_TURN = 21

# A-Z become a-z, marks and line ends the mark of a piece's end, tabs blanks
_TABLE = bytes(b + 32 if 65 <= b <= 90 else 46 if b in b".,;:!?\n\v\f\r" else 32 if b == 9 else b
               for b in range(256))
_END = b"."


def _turned(h):
    """A 64-bit hash turned by some bits, so that the order of words matters."""
    return (h << np.uint64(_TURN)) | (h >> np.uint64(64 - _TURN))


def phrase_hash(lang: str, phrase: str) -> int:
    """The hash of a phrase: those of its words one after the other."""
    h = np.uint64(xxh64_intdigest(lang.encode(), 42))
    for word in phrase.split(" "):
        h = _turned(h) ^ np.uint64(xxh64_intdigest(word.encode(), 42))
    return int(h)


def _chunks(texts):
    """Texts as bytes that end at a blank, about ``CHUNK`` at a time."""
    waiting, size = [], 0
    for text in texts:
        waiting.append((text or b"").translate(_TABLE))
        size += len(waiting[-1])
        if size >= CHUNK:
            whole = b". ".join(waiting) + b". "
            at = 0
            while at < len(whole):
                end = whole.find(b" ", min(at + CHUNK, len(whole) - 1)) + 1
                yield whole[at:end]
                at = end
            waiting, size = [], 0
    yield b". ".join(waiting) + b". "


class _Holder:
    """The phrases of one language that a task has read since it last handed on."""

    def __init__(self, lang: str, size: int, bits: np.ndarray, spread: tuple):
        self.lang, self.size, self.bits, self.spread = lang, size, bits, spread
        self.seed = np.uint64(xxh64_intdigest(lang.encode(), 42))
        self.tail = np.zeros(0, np.int64)
        self.clear()

    def clear(self) -> None:
        carried = [self.names[i] for i in self.tail.tolist()] if len(self.tail) else []
        self.ids = defaultdict()
        self.ids.default_factory = self.ids.__len__
        self.ids[_END]
        self.names, self.hashes, self.held, self.n = [], np.zeros(0, np.uint64), [], 0
        self.tail = np.array([self.ids[w] for w in carried], np.int64)

    def _know(self) -> None:
        """Names and hashes of the words met so far, in the order of their numbers."""
        new = list(itertools.islice(self.ids, len(self.names), None))
        self.names += new
        self.hashes = np.concatenate([self.hashes, np.array(
            [xxh64_intdigest(w, 42) for w in new], np.uint64)])

    def _phrase_hashes(self, words: np.ndarray) -> np.ndarray:
        h = np.full(len(words), self.seed)
        for column in words.T:
            h = _turned(h) ^ self.hashes[column]
        return h

    def add(self, chunk: bytes) -> None:
        ids = self.ids
        found = np.array([ids[w] for w in chunk.replace(_END, b" . ").split()], np.int64)
        self._know()
        if self.size == 1:
            rows = found[found != 0][:, None]
        else:
            # phrases that began in the chunk before
            found = np.concatenate([self.tail, found])
            self.tail = found[-(self.size - 1):]
            if len(found) < self.size:
                return
            parts = np.lib.stride_tricks.sliding_window_view(found, self.size - 1)
            open_ = (parts != 0).all(axis=1)
            place = self._phrase_hashes(parts) % np.uint64(BITS)
            open_ &= (self.bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)
                      & 1).astype(bool)
            rows = np.lib.stride_tricks.sliding_window_view(found, self.size)[open_[:-1] & open_[1:]]
        self.held.append(rows.astype(np.int32))
        self.n += len(rows)

    def full(self, held: int) -> bool:
        return self.n >= held or len(self.ids) >= VOCABULARY

    def stripes(self):
        """lang, prefix, part, words and counts of every stripe, some rows at a time."""
        rows = np.concatenate(self.held) if self.held else np.zeros((0, self.size), np.int32)
        if not len(rows):
            return
        code, many = rows[:, 0].astype(np.int64), len(self.names)
        for column in rows.T[1:]:
            if code.max() >= (1 << 62) // many:
                code = np.unique(code, return_inverse=True)[1]
            code = code * many + column
        _, first, counts = np.unique(code, return_index=True, return_counts=True)
        rows = rows[first]
        part = self._parts(rows)
        prefix = rows[:, :-1]
        if part.any():
            group = np.cumsum(np.r_[0, (prefix[1:] != prefix[:-1]).any(axis=1)])
            order = np.lexsort((part, group))
            rows, counts, part = rows[order], counts[order], part[order]
            prefix = rows[:, :-1]
        starts = np.flatnonzero(np.r_[True, (prefix[1:] != prefix[:-1]).any(axis=1)
                                      | (part[1:] != part[:-1])])
        names = pa.array(self.names, pa.binary()).view(pa.string())
        for at in range(0, len(starts), 20_000):
            chosen = starts[at:at + 20_000]
            end = starts[at + 20_000] if at + 20_000 < len(starts) else len(rows)
            offsets = pa.array(np.r_[chosen, end] - chosen[0], pa.int32())
            yield [pa.array([self.lang] * len(chosen), pa.string()), self._prefixes(names, prefix[chosen]),
                   pa.array(part[chosen], pa.int32()),
                   pc.binary_join(pa.ListArray.from_arrays(
                       offsets, names.take(pa.array(rows[chosen[0]:end, -1]))), " "),
                   pa.ListArray.from_arrays(
                       offsets, pa.array(counts[chosen[0]:end], pa.int32()),
                       type=pa.list_(pa.field("element", pa.int32())))]

    @staticmethod
    def _prefixes(names: pa.Array, prefix: np.ndarray) -> pa.Array:
        n, size = prefix.shape
        if not size:
            return pa.array([""] * n, pa.string())
        return pc.binary_join(pa.ListArray.from_arrays(
            pa.array(np.arange(n + 1) * size, pa.int32()),
            names.take(pa.array(np.ascontiguousarray(prefix).ravel()))), " ")

    def _parts(self, rows: np.ndarray) -> np.ndarray:
        """The part of its stripe that every element belongs to, by its next word."""
        word = self.hashes[rows[:, -1]]
        if self.size == 1:
            return (word % np.uint64(WORD_PARTS)).astype(np.int64)
        hot, many = self.spread
        if not len(hot):
            return np.zeros(len(rows), np.int64)
        h = self._phrase_hashes(rows[:, :-1])
        at = np.minimum(np.searchsorted(hot, h), len(hot) - 1)
        return np.where(hot[at] == h, word % many[at], np.uint64(0)).astype(np.int64)


def _stripes(batches, *, size, held, known):
    """The stripes of a task: lang, prefix, part, words and counts."""
    bits, spread = known.value
    bits, spread = np.frombuffer(bits, np.uint8), tuple(np.array(x, np.uint64) for x in spread)
    holders = {}
    for batch in slices(batches):
        by_lang = {}
        for lang, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
            by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            if lang not in holders:
                holders[lang] = _Holder(lang, size, bits, spread)
            for chunk in _chunks(texts):
                holders[lang].add(chunk)
                if holders[lang].full(held // len(holders)):
                    yield from holders[lang].stripes()
                    holders[lang].clear()
    for holder in holders.values():
        yield from holder.stripes()


def merged(docs: DataFrame, size: int, bits: bytes = b"", spread: tuple = ((), ()),
           held: int = HELD) -> DataFrame:
    """lang, prefix, next and f: the stripes of the phrases of ``size`` words.  Adding
    up takes place where a prefix and part lie, so stripes are shuffled once and as
    stripes."""
    rows = docs.select(F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"), "text")
    known = docs.sparkSession.sparkContext.broadcast((bits, spread))
    dealt = map_rows(rows, "lang string, prefix string, part int, words string, counts array<int>",
                     functools.partial(_stripes, size=size, held=held, known=known)
                     ).repartition("lang", "prefix", "part")
    elements = F.arrays_zip(F.split("words", " ").alias("next"), F.col("counts").alias("n"))
    return (dealt.select("lang", "prefix", "part", F.inline(elements))
            .groupBy("lang", "prefix", "part", "next")
            .agg(F.sum("n").alias("f")).drop("part"))


def _frequent(phrases: DataFrame) -> bytes:
    """``phrases`` as a field of bits, ``BITS`` at any size."""
    h = F.aggregate(F.split("phrase", " "), F.xxhash64("lang"), lambda h, word: F.shiftleft(
        h, _TURN).bitwiseOR(F.shiftrightunsigned(h, 64 - _TURN)).bitwiseXOR(F.xxhash64(word)))
    place = F.pmod(h, F.lit(BITS))
    rows = (phrases.select(place.alias("place")).groupBy(F.expr(f"place div {_BITMAP}").alias("i"))
            .agg(F.bitmap_construct_agg(F.col("place") % _BITMAP).alias("bits")).collect())
    field = bytearray(BITS // 8)
    for i, bits in rows:
        field[i * _BITMAP // 8:(i + 1) * _BITMAP // 8] = bits
    return bytes(field)


def _spread(phrases: DataFrame, total: int) -> tuple[list[int], list[int]]:
    """Hashes and parts of the stripes that hold more than one in ``SPREAD`` of ``total``
    words: fewer than ``SPREAD`` entries, as a phrase occurs at most once per word."""
    many = sorted((phrase_hash(r["lang"], r["phrase"]), 1 + r["f"] * SPREAD // total)
                  for r in phrases.where(F.col("f") * SPREAD > total).collect())
    return [h for h, _ in many], [n for _, n in many]


def _phrase(prefix, following):
    return F.when(prefix == "", following).otherwise(F.concat_ws(" ", prefix, following))


def _joined(words, start, size):
    return F.array_join(F.slice(words, start, size), " ")


def _subsumption(candidates: DataFrame, longest: int) -> DataFrame:
    """lang, phrase and the largest count of a longer candidate around it."""
    size = F.size("words")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda n: F.transform(
        F.sequence(F.lit(1), size - n + 1), lambda i: _joined(F.col("words"), i, n))))
    return (candidates.where(size > 2).select(
        "lang", "a", F.explode(F.array_distinct(inner)).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("a").alias("around")))


def _scored(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """The candidates with l, r and score of their lowest cut."""
    size, words = F.size("words"), F.col("words")
    cuts = candidates.select("lang", "phrase", "a", F.explode(F.transform(
        F.sequence(F.lit(1), size - 1), lambda k: F.struct(
            k.alias("k"), _joined(words, F.lit(1), k).alias("left"),
            _joined(words, k + 1, size - k).alias("right")))).alias("cut"))
    for side, count in (("left", "l"), ("right", "r")):
        part = counts.select("lang", F.col("phrase").alias("part"), F.col("f").alias(count))
        cuts = (cuts.withColumn("part", F.col(f"cut.{side}")).join(part, ["lang", "part"])
                .drop("part"))
    # the square of a count can pass 64 bits: 38 digits hold it, times a million, for
    # counts up to 10 ** 16
    big = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r")}
    whole = (big["a"] * big["a"]).cast("decimal(31,0)") * F.lit(_UNIT).cast("decimal(7,0)")
    bottom = (big["l"] * big["r"]).cast("decimal(38,0)")
    cuts = cuts.withColumn("whole", whole).withColumn("bottom", bottom).withColumn(
        "score", F.expr("whole div bottom"))
    best = F.min(F.struct("score", F.col("cut.k").alias("k"), "l", "r")).alias("best")
    return cuts.groupBy("lang", "phrase", "a").agg(best).select(
        "lang", "phrase", "a", *(F.col(f"best.{c}").alias(c) for c in ("l", "r", "score")))


def _first_rows(batches, *, top):
    """The first rows of every language; a partition comes in order."""
    lang, taken = None, 0
    for batch in batches:
        langs = batch.column(0).to_pylist()
        keep = []
        for value in langs:
            lang, taken = (lang, taken + 1) if value == lang else (value, 1)
            keep.append(taken <= top)
        yield batch.filter(pa.array(keep, pa.bool_())).columns


def _best_of_tasks(scored: DataFrame, top: int) -> DataFrame:
    """The rows that may be among a language's ``top``, so the last ranking sees few: those
    of the highest thousandths of the score that hold ``top`` rows together, and of
    them every partition's first ``top``."""
    band = F.expr(f"score div {_UNIT // 1000}")
    bands = scored.groupBy("lang", band.alias("band")).agg(F.count("*").alias("rows"))
    # at most a thousand and one bands a language
    above = F.sum("rows").over(W.partitionBy("lang").orderBy(F.desc("band")).rowsBetween(
        W.unboundedPreceding, -1))
    lowest = (bands.withColumn("above", F.coalesce(above, F.lit(0))).where(F.col("above") < top)
              .groupBy("lang").agg(F.min("band").alias("lowest")))
    scored = scored.join(lowest, "lang").where(band >= F.col("lowest")).select(*scored.columns)
    ordered = scored.sortWithinPartitions("lang", F.desc("score"), F.desc("a"), "phrase")
    return map_rows(ordered, ", ".join(f"{f.name} {f.dataType.simpleString()}"
                                       for f in scored.schema),
                    functools.partial(_first_rows, top=top))


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST,
                 share: int = SHARE, top: int = TOP, held: int = HELD) -> DataFrame:
    """Per language the ``top`` phrases of 2 to ``longest`` words that occur at least
    ``least`` times: lang, rank, phrase, its count a, the counts l and r of the parts
    of its lowest cut, the words n of the language, and the score a*a/(l*r) in
    millionths.  Phrases inside a longer one with ``share`` percent of their count are
    left out.

    A null text counts as empty, a null language as ``und`` (together with rows that
    say so).  Repeated rows and ids count as often as they occur.  Equal scores rank by
    count, then by phrase in the order of its bytes.  An empty table, or one without
    frequent phrases, gives an empty result.  Other columns have no influence.
    """
    if longest < 2:
        raise ValueError("a phrase has at least two words")
    scratch, levels, bits, spread = Scratch(docs.sparkSession), [], b"", ((), ())
    for size in range(1, longest + 1):
        found = merged(docs, size, bits, spread, held).select(
            "lang", _phrase(F.col("prefix"), F.col("next")).alias("phrase"), "f",
            F.lit(size == 1).alias("single"))
        if size == 1:
            words = scratch.keep(found)
            totals = scratch.keep(words.groupBy("lang").agg(F.sum("f").alias("n")))
            total = totals.agg(F.sum("n")).first()[0] or 0
            levels.append(words.where(F.col("f") >= least))
        else:
            levels.append(scratch.keep(found.where(F.col("f") >= least)))
        if size < longest:
            bits, spread = _frequent(levels[-1]), _spread(levels[-1], total)
    counts = functools.reduce(DataFrame.union, levels)
    candidates = counts.where(~F.col("single")).select(
        "lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))
    around = _subsumption(candidates, longest)
    kept = candidates.join(around, ["lang", "phrase"], "left").where(
        F.col("around").isNull() | (100 * F.col("around") < share * F.col("a"))).drop("around")
    best = _best_of_tasks(scratch.keep(_scored(kept, counts)), top)
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
