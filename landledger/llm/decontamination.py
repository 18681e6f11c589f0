"""Benchmark decontamination: which words of a document repeat a test item.

The normalised windows of all items form one Aho-Corasick automaton; every
document is normalised the same way and scanned once.  Words are compared, not
substrings: windows and documents are joined with single blanks and a window is
looked for with a blank at both ends.

The windows are written to the shared folder in blocks of up to ``BLOCK_BYTES``, by
their hash.  One block at a time is read by the driver, broadcast, scanned for, and
let go, so memory stays bounded however long the benchmark is.  One block is scanned
for in a single pass that carries the documents along.  Of several, every scan writes
what it has found, by a digest of the text and only where there is something; the
findings are put together at the end.  Documents are never shuffled for a scan.
"""

from __future__ import annotations

import functools
import hashlib
import math
import re

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landledger.llm.common import (Once, Scratch, free_name, map_rows, slices, utf8,
                                   with_result)

WINDOW = 10
BLOCK_BYTES = 8 << 20

_RANGES = "array<struct<start: bigint, end: bigint>>"


def _result(kind: str) -> str:
    """The fields of a finding; items have the type of the benchmark's ids."""
    return f"n_words bigint, n_hit bigint, items array<{kind}>, ranges {_RANGES}, spans {_RANGES}"


# A-Z become a-z; digits, a-z and the bytes of non-ASCII characters stay; every
# other ASCII byte separates words
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
               for b in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


def windows(text: bytes | None, size: int = WINDOW) -> set[bytes]:
    """All runs of ``size`` words; a shorter text is one window, no words none."""
    w = words(text)
    return {b" ".join(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def _item_windows(batches, size):
    for batch in batches:
        items, found = [], []
        for item, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
            for window in windows(text, size):
                items.append(item)
                found.append(window)
        yield [items, found]


def _automaton(rows):
    """A window's value is its length in words and its items."""
    owners: dict[bytes, set[int]] = {}
    for item, window in rows:
        owners.setdefault(window, set()).add(item)
    found = ahocorasick.Automaton()
    for window, items in owners.items():
        found.add_word(f" {window.decode('latin-1')} ", (window.count(b" ") + 1, tuple(items)))
    if len(found):
        found.make_automaton()
    return found


class Windows:
    """The windows of a benchmark in blocks, written below the shared folder."""

    def __init__(self, benchmark: DataFrame, size: int, block_bytes: int, scratch: Scratch):
        self.kind = benchmark.schema["item_id"].dataType.simpleString()
        found = map_rows(
            benchmark.select("item_id", "text").where("item_id is not null"),
            f"item_id {self.kind}, phrase binary", functools.partial(_item_windows, size=size))
        found = scratch.keep(found.distinct(), "all_windows")
        total = found.agg(F.sum(F.length("phrase") + 16)).first()[0] or 0
        self.n = max(1, math.ceil(total / block_bytes))
        self.spark, self.path = benchmark.sparkSession, f"{scratch.folder}/windows"
        found.withColumn("block", F.pmod(F.xxhash64("phrase"), F.lit(self.n))).write.partitionBy(
            "block").parquet(self.path)
        self.schema = T.StructType([*found.schema, T.StructField("block", T.IntegerType())])

    def block(self, number: int) -> Once:
        """One block, of bounded size, for the tasks."""
        rows = self.spark.read.schema(self.schema).parquet(self.path).where(
            F.col("block") == number).select("item_id", "phrase").collect()
        return Once(self.spark, [(r[0], bytes(r[1])) for r in rows], _automaton)


def _occurrences(text, automaton):
    """Ranges of words covered by windows, and the items the windows are from."""
    w = words(text)
    ranges, items, blanks = [], set(), None
    if w and len(automaton):
        line = f" {b' '.join(w).decode('latin-1')} "
        for end, (size, owners) in automaton.iter(line):
            if blanks is None:
                blanks = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
            last = int(np.searchsorted(blanks, end))
            ranges.append((last - size, last))
            items.update(owners)
    return len(w), ranges, items


def _merged(ranges):
    """Disjoint ranges with the same words, in order."""
    out: list[list[int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def _characters(text: bytes, ranges):
    """Code point ranges of the original text that hold the ranges of words."""
    if not ranges:
        return []
    at = [m.span() for m in _WORD.finditer(text)]
    length = lambda end: len(text[:end].decode("utf-8", "replace"))
    return [{"start": length(at[a][0]), "end": length(at[b - 1][1])} for a, b in ranges]


def _lists(w_and_found):
    """Columns of a result from (text, words, ranges, items) per document."""
    out = [[], [], [], [], []]
    for text, n, ranges, items in w_and_found:
        ranges = _merged(ranges)
        for column, value in zip(out, (
                n, sum(b - a for a, b in ranges), sorted(items),
                [{"start": a, "end": b} for a, b in ranges], _characters(text, ranges))):
            column.append(value)
    return out


def _scan(texts, *, block):
    automaton = block.get()
    return _lists((t, *_occurrences(t, automaton)) for t in utf8(texts))


def _found(batches, *, block):
    """Ranges and items of the texts in which a block has windows, by their digest."""
    automaton = block.get()
    for batch in slices(batches):
        rows = [(hashlib.sha256(t).digest(), *_occurrences(t, automaton))
                for t in utf8(batch.column(0)) if t]
        rows = [r for r in rows if r[2]]
        yield [[r[0] for r in rows],
               [[{"start": a, "end": b} for a, b in _merged(r[2])] for r in rows],
               [sorted(r[3]) for r in rows]]


def _together(texts, parts):
    """The findings of all blocks as one."""
    return _lists((
        t, len(words(t)), [(r["start"], r["end"]) for p in ps or [] for r in p["ranges"]],
        {i for p in ps or [] for i in p["items"]}) for t, ps in zip(utf8(texts), parts.to_pylist()))


def _in_blocks(docs: DataFrame, windows: Windows, scratch: Scratch, keep: list[str], out: str):
    """All blocks, one after the other."""
    found = []
    for number in range(windows.n):
        once = windows.block(number)
        found.append(scratch.keep(
            map_rows(docs.select("text"), f"key binary, ranges {_RANGES}, items array<{windows.kind}>",
                     functools.partial(_found, block=once)).dropDuplicates(["key"])))
        once.data.destroy()
    names = [free_name(docs, name) for name in ("key", "parts")]
    parts = functools.reduce(DataFrame.union, found).groupBy(F.col("key").alias(names[0])).agg(
        F.collect_list(F.struct("ranges", "items")).alias(names[1]))  # one per block at most
    keyed = docs.withColumn(names[0], F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    return with_result(keyed.join(parts, names[0], "left"), ["text", names[1]], keep, out,
                       _result(windows.kind), _together)


def contamination(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None,
                  out: str = "contamination", window: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``keep`` columns of ``docs`` (all by default) and a struct ``out``:
    words, words hit, sorted items with occurring windows, hit ranges of words,
    and the same ranges as code points of the original text.

    One row per row of ``docs``, repeated rows and ids included.  A null or empty
    text has no words and no hits.  Items without id or words match nothing; an
    item repeated under one id counts once, equal items under two ids twice.  Ids
    may be of any type.  Columns of ``docs`` with any other name are carried along; one
    called ``out`` among ``keep`` is an error.
    """
    keep = docs.columns if keep is None else keep
    if out.lower() in {c.lower() for c in keep}:
        raise ValueError(f"{out} is a column already; choose another name for the result")
    scratch = Scratch(docs.sparkSession)
    windows = Windows(benchmark, window, block_bytes, scratch)
    if windows.n > 1:
        return _in_blocks(docs, windows, scratch, keep, out)
    return with_result(docs, ["text"], keep, out, _result(windows.kind),
                       functools.partial(_scan, block=windows.block(0)))


def report(found: DataFrame, out: str = "contamination") -> DataFrame:
    """One line per document: counts, a digest of its items, and the verdict."""
    items = F.concat_ws(",", F.sort_array(F.col(f"{out}.items").cast("array<string>")))
    return found.select(
        "doc_id", F.col(f"{out}.n_words").alias("n_words"), F.col(f"{out}.n_hit").alias("n_hit"),
        F.size(f"{out}.items").cast("bigint").alias("n_items"),
        F.sha2(items.cast("binary"), 256).alias("items_sha256"),
        (F.col(f"{out}.n_hit") > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that repeat no window of ``benchmark``."""
    out = free_name(docs, "contamination")
    return (contamination(docs, benchmark, out=out)
            .where(F.col(f"{out}.n_hit") == 0).select(*docs.columns))
