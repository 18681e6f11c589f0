"""Token counts of whole texts, huge ones in overlapping chunks.

Texts of ordinary length are encoded as they are.  A huge text is cut into
fragments of ``FRAGMENT`` characters; a chunk is ``SPAN`` fragments and the first
one of the next chunk, so neighbours overlap by one fragment.  Chunks are rows, so
the chunks of one text are encoded by many tasks.

Two neighbours are spliced at a place where both start a new word.  A byte-level
tokenizer finds special strings first, then words from left to right without
looking back, and merges only inside words.  So from a common word start on, both
chunks see the same words, up to the last ``_MARGIN`` characters of the earlier
one, whose words may depend on what follows.  By induction from the start of the
text the words before the splice are true in the earlier chunk and those behind it
in the later one.  Counts are then sums: the tokens of all chunks, less, for every
overlap, those of the earlier chunk behind the splice and of the later one before.

An overlap without a common word start (one word longer than the overlap) widens:
the text is taken again with four fragments as one, until it fits or is one chunk.
"""

from __future__ import annotations

import functools
import json
import os

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from landledger.llm.common import Once, Scratch, free_name, map_rows, utf8

#: Characters of a fragment, and fragments that a chunk owns.
FRAGMENT, SPAN = 4096, 16
#: How many fragments become one where an overlap was too short.
WIDER = 4
#: Texts encoded by one call.
BATCH = 128
#: Characters a word's end may depend on: a contraction and the sign after blanks.
_LOOKAHEAD = 4


def read_tokenizer(path: str) -> str:
    """The description of a ``.json`` tokenizer, read on the driver."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def _borders_overlap(specials: list[str]) -> bool:
    """Whether an end of one special string is the beginning of one."""
    return any(a.endswith(b[:n]) for a in specials for b in specials
               for n in range(1, len(b) + (a != b)) if n < max(len(a), len(b)))


def margin(description: str) -> int | None:
    """The characters before a chunk's end that are not to be trusted, or None for a
    tokenizer whose texts must stay whole: only byte-level words without text
    normalisation, with special strings that cannot overlap, may be spliced."""
    parts = json.loads(description)
    words, specials = parts["pre_tokenizer"] or {}, parts.get("added_tokens") or []
    plain = (parts.get("normalizer") is None and words.get("type") == "ByteLevel"
             and not words.get("add_prefix_space") and words.get("use_regex", True)
             and not any(s.get("lstrip") or s.get("rstrip") or s.get("single_word")
                         for s in specials)
             and not _borders_overlap([s["content"] for s in specials]))
    return _LOOKAHEAD + max((len(s["content"]) for s in specials), default=0) if plain else None


def _build(description: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    tokenizer = Tokenizer.from_str(description)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _decoded(text: bytes | None) -> str:
    return (text or b"").decode("utf-8", "replace")


def _first_pass(batches, *, once, schema, carried, chunk, fragment):
    """One row per text: its tokens, or a key where it is huge.  Huge texts also
    give their fragments, as rows without carried columns."""
    tokenizer = once.get()
    types = to_arrow_schema(schema)
    for whole in batches:
        for batch in (whole.slice(at, BATCH) for at in range(0, len(whole), BATCH)):
            texts = utf8(batch.column("text"))
            decoded = [_decoded(t) for t in texts]
            huge = [chunk is not None and len(t) > chunk for t in decoded]
            counts = iter(tokenizer.encode_batch_fast(
                [t for t, h in zip(decoded, huge) if not h], add_special_tokens=False))
            tokens = [None if h else len(next(counts)) for h in huge]
            keys = batch.column("key").to_pylist()
            none = [None] * len(texts)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carried)]
                + [pa.array(c, type=f.type) for c, f in zip(
                    ([len(t or b"") for t in texts], tokens, keys,
                     [int(h) for h in huge], none, none, none), list(types)[len(carried):])],
                schema=types)
            for text, key, is_huge in zip(decoded, keys, huge):
                if is_huge:
                    yield from _fragments(text, key, fragment, types, len(carried))


def _fragments(text, key, fragment, types, n_carried):
    """The fragments of a text, some at a time."""
    places = range(0, len(text), fragment)
    for first in range(0, len(places), 64):
        starts = places[first:first + 64]
        n = len(starts)
        columns = [[None] * n, [None] * n, [key] * n, [2] * n, [s // fragment for s in starts],
                   [text[s:s + fragment] for s in starts], [s == places[-1] for s in starts]]
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(n, f.type) for f in list(types)[:n_carried]]
            + [pa.array(c, type=f.type) for c, f in zip(columns, list(types)[n_carried:])],
            schema=types)


def word_starts(encoding) -> list[tuple[int, int]]:
    """Places (in characters) where a new word starts, and the tokens before each."""
    words, found, before = encoding.word_ids, [], object()
    for i, (word, (start, _)) in enumerate(zip(words, encoding.offsets)):
        if word != before:
            found.append((start, i))
            before = word
    return found


def _encode_chunks(batches, *, once, fragment, span, margin):
    """Per chunk its tokens, and for each of its two overlaps the trusted word
    starts there with the tokens before them."""
    tokenizer = once.get()
    for batch in batches:
        for key, number, pieces in zip(*(batch.column(c).to_pylist() for c in range(3))):
            pieces.sort(key=lambda p: p["place"])
            text = "".join(p["piece"] for p in pieces)
            encoding = tokenizer.encode(text, add_special_tokens=False)
            n, starts = len(encoding), word_starts(encoding)
            ends = pieces[-1]["last"]
            if ends:
                starts.append((len(text), n))
            origin, rows = number * span * fragment, [(None, None, None, None, n)]
            if number:
                head = [s for s in starts if 0 < s[0] <= fragment]
                rows.append((number, False, [origin + s for s, _ in head],
                             [i for _, i in head], n))
            if len(pieces) > span:
                limit = len(text) if ends else len(text) - margin
                tail = [s for s in starts if span * fragment < s[0] <= limit]
                rows.append((number + 1, True, [origin + s for s, _ in tail],
                             [i for _, i in tail], n))
            yield [[key] * len(rows), *map(list, zip(*rows))]


def _spliced(fragments: DataFrame, once: Once, fragment: int, span: int, margin: int) -> DataFrame:
    """key, tokens and whether every overlap had a common word start."""
    chunk = F.expr(f"place div {span}")
    shared = (F.col("place") % span == 0) & (F.col("place") > 0)
    chunks = (fragments.select("key", "place", "piece", "last", F.explode(
        F.when(shared, F.array(chunk - 1, chunk)).otherwise(F.array(chunk))).alias("chunk"))
        .groupBy("key", "chunk").agg(F.collect_list(F.struct("place", "piece", "last"))
                                     .alias("pieces")))  # at most span + 1 of them
    parts = map_rows(
        chunks, "key binary, seam bigint, earlier boolean, at array<bigint>, "
                "before array<bigint>, tokens bigint",
        functools.partial(_encode_chunks, once=once, fragment=fragment, span=span, margin=margin))
    seams = parts.groupBy("key", "seam").agg(
        F.sum(F.when(F.col("seam").isNull(), F.col("tokens"))).alias("tokens"),
        *(F.first(F.when(F.col("earlier") == side, F.struct("at", "before", "tokens")),
                  ignorenulls=True).alias(name)
          for side, name in ((True, "left"), (False, "right"))))
    at = F.array_min(F.array_intersect("left.at", "right.at"))

    def before(side):
        return F.element_at(F.col(f"{side}.before"),
                            F.array_position(F.col(f"{side}.at"), F.col("splice")).cast("int"))
    twice = F.when(F.col("splice").isNotNull(),
                   F.col("left.tokens") - before("left") + before("right"))
    return (seams.withColumn("splice", at).groupBy("key").agg(
        (F.sum(F.coalesce("tokens", F.lit(0))) - F.sum(F.coalesce(twice, F.lit(0))))
        .cast("bigint").alias("tokens"),
        F.every(F.col("seam").isNull() | F.col("splice").isNotNull()).alias("whole")))


def _widened(fragments: DataFrame) -> DataFrame:
    """``WIDER`` neighbouring fragments as one."""
    pieces = F.array_sort(F.collect_list(F.struct("place", "piece")))
    return (fragments.groupBy("key", F.expr(f"place div {WIDER}").alias("wide"))
            .agg(F.array_join(F.transform(pieces, lambda p: p["piece"]), "").alias("piece"),
                 F.max("last").alias("last"))
            .select("key", F.col("wide").alias("place"), "piece", "last"))


def counted(docs: DataFrame, description: str, keep: list[str] | None = None,
            out: str = "tokens", fragment: int = FRAGMENT, span: int = SPAN) -> DataFrame:
    """``keep`` columns of ``docs`` (all by default) and the struct ``out``: bytes of
    the UTF-8 text (n_bytes) and its tokens (n_tokens), without added special tokens;
    special strings inside a text count as one token each.

    One row per row of ``docs``, repeated rows and ids included.  A null text counts
    as empty and has neither bytes nor tokens.  An empty table gives an empty result.
    Equal huge texts are encoded once.  A kept column called ``out`` is an error, any
    other name is carried along.
    """
    keep = docs.columns if keep is None else keep
    if out.lower() in {c.lower() for c in keep}:
        raise ValueError(f"{out} is a column already; choose another name for the result")
    if span < 2:
        raise ValueError("a chunk must own at least two fragments, or its overlaps meet")
    if fragment <= _LOOKAHEAD:
        raise ValueError("a fragment must be longer than what a word's end may depend on")
    spark = docs.sparkSession
    once, trusted, scratch = Once(spark, description, _build), margin(description), Scratch(spark)
    # carried columns get names of their own, so none can clash
    carried = [f"c{i}" for i in range(len(keep))]
    chunk = None if trusted is None else fragment * span
    text = F.col("text")
    # at least as many bytes as characters, so only long texts are hashed
    key = (F.when(F.octet_length(text) > chunk, F.unhex(F.sha2(text.cast("binary"), 256)))
           if chunk else F.lit(None).cast("binary"))
    frame = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(keep, carried)),
                        text, key.alias("key"))
    nullable = T.StructType([T.StructField(f.name, f.dataType, True)
                             for f in frame.select(*carried).schema])
    schema = T.StructType([*nullable, *T.StructType.fromDDL(
        "n_bytes bigint, n_tokens bigint, key binary, kind int, place bigint, piece string, "
        "last boolean")])
    stored = frame.mapInArrow(functools.partial(
        _first_pass, once=once, schema=schema, carried=carried, chunk=chunk, fragment=fragment),
        schema)
    path = f"{scratch.folder}/first"
    stored.write.partitionBy("kind").parquet(path)
    first = spark.read.schema(schema).parquet(path)
    rows = [F.col(n).alias(c) for c, n in zip(keep, carried)]

    def result(df):
        return df.select(*rows, F.struct("n_bytes", "n_tokens").alias(out))
    done = result(first.where("kind = 0"))
    fragments = (first.where("kind = 2").select("key", "place", "piece", "last")
                 .dropDuplicates(["key", "place"]))
    if trusted is None or fragments.isEmpty():
        return done
    solved, size = [], fragment
    while True:
        found = scratch.keep(_spliced(fragments, once, size, span, trusted))
        solved.append(found.where("whole").select("key", F.col("tokens").alias("n_tokens")))
        torn = found.where(~F.col("whole")).select("key")
        if torn.isEmpty():
            break
        fragments = scratch.keep(_widened(fragments.join(torn, "key", "left_semi")))
        size *= WIDER
    tokens = functools.reduce(DataFrame.union, solved)
    huge = first.where("kind = 1").drop("n_tokens").join(tokens, "key")
    return done.union(result(huge))


def report(docs: DataFrame, description: str, limit: int = 512) -> DataFrame:
    """doc_id, bytes, tokens, and whether the tokens are more than ``limit``; rows
    and special cases as in :func:`counted`."""
    out = free_name(docs, "tokens")
    return counted(docs, description, ["doc_id"], out).select(
        "doc_id", F.col(f"{out}.n_bytes").alias("n_bytes"),
        F.col(f"{out}.n_tokens").alias("n_tokens"),
        (F.col(f"{out}.n_tokens") > limit).alias("over_limit"))
