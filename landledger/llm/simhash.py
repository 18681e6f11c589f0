"""SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint's 64 bits are cut into three segments.  If two fingerprints differ
in at most two bits, then by the pigeonhole principle some segment is equal and
the segment after it (in a circle) differs in at most one bit: of (2,0,0) and its
turns the two equal segments are neighbours in one direction, of (1,1,0) and its
turns the equal one is followed by one with a single error.

The binary Golay code (23,12) has exactly one codeword within three bits of any
word.  A segment is decoded to the indices of all codewords within four bits,
5.3 on average; the nearest one is its primary key.  One error moves a word by
one bit, so the primary codeword of either segment is among the codewords of the
other.  The key is the equal segment's bits and a codeword index.

Copies share a fingerprint and count once.  Keys held by one fingerprint are
dropped by a count; members of a small bucket are joined and their bits compared.
In a larger bucket every member is written once under itself and under each of
the 64 fingerprints one bit away: two members meet exactly if at most two bits
differ, at most 65 meet in one place, and each is linked with the smallest there,
so nothing is lost and no bucket is expanded into its pairs.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landledger.llm.common import (Once, Scratch, broadcast_if_small, checkpointed, free_name,
                                   map_rows, utf8, with_result)
from landledger.llm.components import components

SHINGLE = 3
MAX_BITS = 2
#: Members of a bucket that are compared pair by pair.
SMALL_BUCKET = 16

# fixed values: generator polynomial of the binary Golay code (23,12), and the
# places and widths of the three segments
GENERATOR = 0b110001110101
SEGMENTS = ((0, 22), (22, 21), (43, 21))

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The 64 bits of a text; 0 if it has no words."""
    w = text.translate(_LOWER).split() if text else []
    if not w:
        return 0
    line = b" ".join(w)
    starts = np.cumsum([0, *(len(x) + 1 for x in w)])
    ends = (starts[1:] - 1)[shingle - 1:].tolist() or [len(line)]
    digest = functools.partial(xxhash.xxh64_intdigest, seed=42)
    hashes = np.array([digest(line[a:b]) for a, b in zip(starts.tolist(), ends)], np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65536):
        part = hashes[i:i + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _fingerprints(texts, shingle):
    return [[_signed(fingerprint(t, shingle)) for t in utf8(texts)]]


def with_fingerprint(docs: DataFrame, keep: list[str], out: str, shingle: int = SHINGLE):
    """``keep`` and the struct ``out`` with the fingerprint as a signed long."""
    return with_result(docs, ["text"], keep, out, "bits bigint",
                       functools.partial(_fingerprints, shingle=shingle))


def _decoder(_=None):
    """Syndromes of the low 12 and high 11 bits of a word, and by syndrome all
    error patterns of up to four bits, the lightest first."""
    def remainder(word):
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= GENERATOR << (bit - 11)
        return word
    low = np.array([remainder(x) for x in range(1 << 12)], np.int64)
    high = np.array([remainder(x << 12) for x in range(1 << 11)], np.int64)
    by_syndrome = [[] for _ in range(1 << 11)]
    for weight in range(5):
        for places in itertools.combinations(range(23), weight):
            pattern = sum(1 << p for p in places)
            by_syndrome[remainder(pattern)].append(pattern)
    first = np.cumsum([0, *map(len, by_syndrome)])
    return low, high, first, np.array(list(itertools.chain(*by_syndrome)), np.int64)


def codewords(words: np.ndarray, decoder):
    """For 23-bit words: which word, the index of a codeword within four bits of
    it, and whether that is the nearest."""
    low, high, first, patterns = decoder
    syndrome = low[words & 4095] ^ high[words >> 12]
    count = first[syndrome + 1] - first[syndrome]
    which = np.repeat(np.arange(len(words)), count)
    within = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    return which, (words[which] ^ patterns[first[syndrome[which]] + within]) >> 11, within == 0


def _keys(batches, decoder):
    for batch in batches:
        bits = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = [(bits.view(np.uint64) >> np.uint64(at)).astype(np.int64) & ((1 << width) - 1)
                for at, width in SEGMENTS]
        for i in range(3):
            which, index, nearest = codewords(part[(i + 1) % 3], decoder.get())
            yield [i << 34 | part[i][which] << 12 | index, bits[which], nearest]


def _apart(a, b):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def links(bits: DataFrame, small_bucket: int = SMALL_BUCKET) -> DataFrame:
    """Pairs (a, b) that connect every two of the distinct fingerprints ``bits``
    with at most two bits between them, directly or through others that are as
    close."""
    decoder = Once(bits.sparkSession, None, _decoder)
    keys = map_rows(bits, "key bigint, bits bigint, nearest boolean",
                    functools.partial(_keys, decoder=decoder))
    sizes = checkpointed(keys.groupBy("key").agg(F.count("*").alias("members"))
                         .where("members > 1"))
    shared = checkpointed(keys.join(sizes, "key"))
    few = shared.where(F.col("members") <= small_bucket)
    pairs = (few.where("nearest").select("key", F.col("bits").alias("a"))
             .join(few.select("key", F.col("bits").alias("b")), "key")
             .where((F.col("a") != F.col("b")) & (_apart("a", "b") <= MAX_BITS))
             .select("a", "b"))
    crowd = shared.where(F.col("members") > small_bucket).select("bits").distinct()
    flips = F.array(F.lit(0).cast("bigint"),
                    *(F.lit(_signed(1 << i)).cast("bigint") for i in range(64)))
    near = crowd.select("bits", F.explode(flips).alias("flip")).select(
        "bits", F.col("bits").bitwiseXOR(F.col("flip")).alias("place"))
    smallest = near.groupBy("place").agg(F.min("bits").alias("b"), F.count("*").alias("n"))
    stars = (near.join(smallest.where("n > 1"), "place")
             .select(F.col("bits").alias("a"), "b").where("a != b"))
    return pairs.union(stars).distinct()


def _groups(rows: DataFrame) -> DataFrame:
    """By fingerprint: the smallest fingerprint and smallest id of its component.
    ``rows``: a checkpointed table of (doc_id, bits)."""
    classes = checkpointed(rows.groupBy("bits").agg(F.min("doc_id").alias("first_id")))
    roots = components(links(classes.select("bits"))).withColumnRenamed("node", "bits")
    least = checkpointed(roots.join(classes, "bits").groupBy("root")
                         .agg(F.min("first_id").alias("component_id")))
    linked = roots.join(least, "root").select("bits", "root", "component_id")
    return checkpointed(classes.join(linked, "bits", "left").select(
        "bits", F.coalesce("root", "bits").alias("root"),
        F.coalesce("component_id", "first_id").alias("component_id")))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id for every row.

    A component is what links of at most two differing bits connect; its id is
    its smallest doc_id (null if it has none).  Null, empty and blank texts have
    fingerprint zero and are linked like any other.  Repeated rows and ids are
    kept, each row by its own fingerprint.
    """
    rows = checkpointed(with_fingerprint(docs, ["doc_id"], "f", shingle)
                        .select("doc_id", F.col("f.bits").alias("bits")))
    return rows.join(_groups(rows), "bits", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row of ``docs`` per component, its columns unchanged: the one with the
    smallest doc_id (a null id counts as largest, then the smaller fingerprint).
    Of rows that agree in both, one stays."""
    out = free_name(docs, "f")
    # written beside the documents: a fingerprint costs far more than reading it again
    scratch = Scratch(docs.sparkSession)
    stored = scratch.keep(with_fingerprint(docs, docs.columns, out, shingle), "tagged")
    # a reading of its own, so that columns of both are told apart
    tagged = docs.sparkSession.read.schema(stored.schema).parquet(f"{scratch.folder}/tagged")
    rows = checkpointed(stored.groupBy("doc_id", F.col(f"{out}.bits").alias("bits"))
                        .agg(F.count("*").alias("copies")))
    groups = _groups(rows).select("bits", "root")
    member = checkpointed(rows.join(groups, "bits"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "bits")
    chosen = checkpointed(member.groupBy("root").agg(F.min(order).alias("m")))
    member = (member.join(chosen, "root")
              .select("doc_id", "bits", "copies", (
                  F.col("doc_id").eqNullSafe(F.col("m.doc_id"))
                  & (F.col("bits") == F.col("m.bits"))).alias("stays")))
    same = lambda m: (tagged["doc_id"].eqNullSafe(m["doc_id"])
                      & (tagged[f"{out}.bits"] == m["bits"]))
    gone = checkpointed(member.where("not stays").select("doc_id", "bits"))
    repeated = checkpointed(member.where("stays and copies > 1").select("doc_id", "bits"))
    gone, many = broadcast_if_small(gone, 16), broadcast_if_small(repeated, 16)
    kept = tagged.join(gone, same(gone), "left_anti")
    if not repeated.isEmpty():
        again = (tagged.join(many, same(many), "left_semi")
                 .dropDuplicates(["doc_id", out]))
        kept = kept.join(many, same(many), "left_anti").union(again)
    return kept.select(*docs.columns)
