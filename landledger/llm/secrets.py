"""Secret scans with built-in functions only: three patterns, and a sliding-window
entropy over candidate strings.

Positions come from cutting a text at the matches of a pattern: the lengths of the
pieces and of the matches add up to every start, in code points.

A candidate is a run of at least ``WINDOW`` letters, digits and ``+/_=-`` with a
letter and a digit in it.  The parts of a run, between ``/``, ``=``, ``_`` and ``-``,
that hold a word of the allow-list are cut out first; what stands around them is
judged on its own.  Its class, hexadecimal or general, sets the bits a window needs.
One fold walks over the characters and keeps the last ``WINDOW`` of them: a new
character comes in, the oldest goes out, and the sum of c*log2(c) over the counts in
the window moves by two differences.  Sums are whole numbers (millionths of a bit),
so a window is judged the same everywhere.  Qualifying windows that overlap are one
span.  Spans that lie inside a span already found by a pattern are left out.

Time is linear in a text: sums along an array are taken in groups, since a fold that
adds to an array copies it every time, and a long run is walked in blocks whose
windows are joined afterwards.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landledger.llm.common import free_name

# The kinds in their order, their patterns, the group that is
# measured and its least length.
_KEYS = "|".join(("password", "passwd", "secret", "token", "api_?key"))
_ANY_CASE = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in _KEYS)
PATTERNS = (
    ("assign", f"(?:{_ANY_CASE})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 8),
    ("access", "(AKIA[A-Z0-9]+)", 1, 16),
    ("hex", "([0-9a-f]+)", 1, 32),
)
KINDS = (*(p[0] for p in PATTERNS), "entropy")

WINDOW = 20
CANDIDATE = f"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
#: Least bits per character of a window, by class.
HEX_BITS, GENERAL_BITS = 3.0, 3.8
#: c*log2(c) in millionths for c = 0..WINDOW.
WEIGHTS = [round(1e6 * c * math.log2(c)) if c else 0 for c in range(WINDOW + 1)]

#: Words (in any case) of samples; the part of a run that holds one is let go.
ALLOWED = ("example", "sample", "placeholder", "changeme", "your", "dummy", "xxxx", "0123456789")
_ALLOWED = f"(?i:{'|'.join(ALLOWED)})"
#: Such a part, found from its beginning only.
ALLOWED_PART = f"(?<![^/=_-])[^/=_-]*?{_ALLOWED}[^/=_-]*+"
#: A candidate of this form is let go.
UUID = "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"

#: Elements that are summed up in one fold, characters (no fewer than a window) that are walked in
#: one, and characters of a text that are cut off at a time.
GROUP, BLOCK, PIECE = 256, 1000, 512

_SPANS = "array<struct<start:int,kind:int,stop:int>>"


def ceiling(bits: float) -> int:
    """The sum of c*log2(c) up to which a window has at least ``bits`` a character."""
    return math.floor(1e6 * WINDOW * (math.log2(WINDOW) - bits))


def _none() -> Column:
    return F.array().cast(_SPANS)


def _span(start, kind: int, stop) -> Column:
    return F.struct(start.cast("int").alias("start"), F.lit(kind).alias("kind"),
                    stop.cast("int").alias("stop"))


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _earlier(numbers: Column, join) -> Column:
    """For every number of an array the join of all numbers before it, from 0 on."""
    def running(values, first):
        return F.aggregate(values, F.array(first), lambda made, x: F.concat(
            made, F.array(join(F.element_at(made, -1), x))))

    def of(groups):
        totals = F.transform(groups, lambda g: F.aggregate(g, F.lit(0), join))
        firsts = F.slice(running(totals, F.lit(0)), F.lit(1), F.size(groups))
        return F.flatten(F.zip_with(groups, firsts, lambda g, first: F.slice(
            running(g, first), F.lit(1), F.size(g))))
    return F.when(F.size(numbers) > 0, _let(F.transform(
        F.sequence(F.lit(1), F.size(numbers), F.lit(GROUP)),
        lambda i: F.slice(numbers, i, F.lit(GROUP))), of)).otherwise(F.array().cast("array<int>"))


def _located(text: Column, pattern: str, group: int = 0) -> Column:
    """What stands before every match, the match, its group and its start, in order;
    the last element is what follows the last match."""
    parts = F.arrays_zip(F.split(text, pattern, -1),
                         F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                         F.regexp_extract_all(text, F.lit(pattern), F.lit(group)))

    def placed(parts):
        sizes = F.transform(parts, lambda p: F.length(p["0"])
                            + F.coalesce(F.length(p["1"]), F.lit(0)))
        return F.zip_with(parts, _let(sizes, lambda n: _earlier(n, lambda a, b: a + b)),
                          lambda p, at: F.struct(
                              p["0"].alias("before"), p["1"].alias("match"),
                              p["2"].alias("value"),
                              (at + F.length(p["0"])).alias("start")))
    return _let(parts, placed)


def _pattern_spans(text: Column, kind: int) -> Column:
    _, pattern, group, least = PATTERNS[kind]
    found = F.filter(_located(text, pattern, group), lambda m: F.length(m["value"]) >= least)
    return F.transform(found, lambda m: _span(m["start"], kind, m["start"] + F.length(m["match"])))


def _windows(chars: Column, start: Column, bits: float) -> Column:
    """Spans of the windows of a block with enough entropy; ``start`` is where the
    block begins."""
    weight, kind = F.array(*map(F.lit, WEIGHTS)), KINDS.index("entropy")
    zero = F.struct(F.lit("").alias("window"), F.lit(0).alias("sum"), start.alias("at"),
                    _none().alias("spans"))

    def times(window, char):
        return F.length(window) - F.length(F.replace(window, char, F.lit("")))

    def step(state, char):
        window = state["window"]
        full = F.length(window) == WINDOW
        kept = F.when(full, F.substring(window, 2, WINDOW - 1)).otherwise(window)
        # a window that is not full loses nothing: weights of 0 and 1 are both 0
        out = F.when(full, times(window, F.substring(window, 1, 1))).otherwise(F.lit(1))
        had = times(kept, char)
        total = state["sum"] + weight[had + 1] - weight[had] + weight[out - 1] - weight[out]
        at = state["at"] + 1
        first = at - WINDOW
        last = F.try_element_at(state["spans"], F.lit(-1))
        spans = (
            F.when((F.length(kept) < WINDOW - 1) | (total > ceiling(bits)), state["spans"])
            .when(last["stop"] >= first, F.concat(
                F.slice(state["spans"], F.lit(1), F.size(state["spans"]) - 1),
                F.array(_span(last["start"], kind, at))))
            .otherwise(F.concat(state["spans"], F.array(_span(first, kind, at)))))
        return F.struct(F.concat(kept, char).alias("window"), total.alias("sum"), at.alias("at"),
                        spans.alias("spans"))
    return F.aggregate(chars, zero, step, lambda state: state["spans"])


def _islands(spans: Column) -> Column:
    """Spans in order, those that overlap or touch as one; stops are in order too."""
    begins = F.filter(spans, lambda s, i: (i == 0) | (s["start"] > F.get(spans, i - 1)["stop"]))
    ends = F.filter(spans, lambda s, i: (i == F.size(spans) - 1)
                    | (F.get(spans, i + 1)["start"] > s["stop"]))
    return F.zip_with(begins, ends, lambda a, b: _span(
        a["start"], KINDS.index("entropy"), b["stop"]))


def _entropy_spans(word: Column, start: Column, bits: float) -> Column:
    """Spans of the windows of ``word`` with enough entropy."""
    def walked(blocks):
        # a block also holds the beginning of the next one, for the windows across
        return F.flatten(F.transform(blocks, lambda b, i: _windows(
            F.split(F.concat(b, F.coalesce(F.substring(
                F.get(blocks, i + 1), 1, WINDOW - 1), F.lit(""))), ""),
            start + i * BLOCK, bits)))
    blocks = F.regexp_extract_all(word, F.lit(f".{{1,{BLOCK}}}"), F.lit(0))
    return _let(_let(blocks, walked), _islands)


def _segments(run: Column, start: Column) -> Column:
    """The candidates of a run and where they start: what is left beside the parts
    that hold a word of the allow-list."""
    whole = F.array(F.struct(run.alias("word"), start.alias("start")))
    around = F.transform(_located(run, ALLOWED_PART), lambda p: F.struct(
        p["before"].alias("word"), (start + p["start"] - F.length(p["before"])).alias("start")))
    return F.when(run.rlike(_ALLOWED), around).otherwise(whole)


def _candidate_spans(text: Column) -> Column:
    def spans_of(c):
        word, start = c["word"], c["start"]
        return (F.when((F.length(word) < WINDOW) | ~word.rlike("[0-9]")
                       | ~word.rlike("[A-Za-z]") | word.rlike(UUID), _none())
                .when(word.rlike("^[0-9a-fA-F]+$"),
                      _entropy_spans(F.lower(word), start, HEX_BITS))
                .otherwise(_entropy_spans(word, start, GENERAL_BITS)))
    runs = F.filter(_located(text, CANDIDATE), lambda m: m["match"].isNotNull())
    return F.flatten(F.transform(runs, lambda m: F.flatten(F.transform(
        _segments(m["match"], m["start"]), spans_of))))


def _uncovered(base: Column, added: Column) -> Column:
    """Both kinds of spans in order, less the added ones inside a base span."""
    entropy = KINDS.index("entropy")

    def kept(spans):
        stops = F.transform(spans, lambda s: F.when(s["kind"] == entropy, F.lit(0))
                            .otherwise(s["stop"]))
        return _let(_let(stops, lambda n: _earlier(n, lambda a, b: F.greatest(a, b))), lambda reach: F.filter(
            spans, lambda s, i: (s["kind"] < entropy) | (F.get(reach, i) < s["stop"])))
    return _let(F.array_sort(F.concat(base, added)), kept)


def scan(docs: DataFrame, keep: list[str] | None = None, out: str = "secrets") -> DataFrame:
    """``keep`` columns (all by default) and the struct ``out``: the spans of the
    patterns (base), and those with the spans of the entropy scan (spans), each
    ordered by start and kind; kinds are places in ``KINDS``, stops exclusive, in
    code points.

    One row per row of ``docs``.  A null or empty text has no spans.  A kept column
    called ``out`` is an error, any other name is carried along.  A quick look for
    each pattern goes first, so only texts with a match are cut up.
    """
    keep = docs.columns if keep is None else keep
    if out.lower() in {c.lower() for c in keep}:
        raise ValueError(f"{out} is a column already; choose another name for the result")
    words = [F.col(c) for c in keep]
    text = F.coalesce(F.col("text"), F.lit(""))
    guards = (text.rlike(f"(?:{_ANY_CASE})[\"']?\\x20*[:=]"), text.contains("AKIA"),
              text.rlike("[0-9a-f]{32}"))
    base = F.array_sort(F.concat(*(
        F.when(guard, _pattern_spans(text, kind)).otherwise(_none())
        for kind, guard in enumerate(guards))))
    first = free_name(docs, "base")
    frame = docs.select(*dict.fromkeys([*keep, "text"]), base.alias(first))
    spans = F.when(text.rlike(CANDIDATE), _let(_candidate_spans(text), lambda added: F.when(
        F.size(added) > 0, _uncovered(F.col(first), added)).otherwise(F.col(first)))).otherwise(
        F.col(first))
    return frame.select(*words, F.struct(
        F.col(first).alias("base"), spans.alias("spans")).alias(out))


def _written(spans) -> Column:
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", name[s["kind"]], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def report(found: DataFrame, out: str = "secrets") -> DataFrame:
    base = F.col(f"{out}.base")

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint")
    counts = [count(kind).alias(f"n_{name}") for kind, (name, *_) in enumerate(PATTERNS)]
    return found.select("doc_id", *counts,
                        F.sha2(_written(base).cast("binary"), 256).alias("base_sha256"),
                        _written(F.col(f"{out}.spans")).alias("spans"))


def _cut(blocks: Column, start: Column, stop: Column) -> Column:
    """Characters from ``start`` to ``stop`` of a text in blocks of ``PIECE``."""
    first, last = (F.floor(x / PIECE).cast("int") for x in (start, stop))
    begin, end = start % PIECE, stop % PIECE
    return F.when(first == last, F.substring(
        F.coalesce(F.get(blocks, first), F.lit("")), begin + 1, end - begin)).otherwise(
        F.concat(F.substring(F.get(blocks, first), begin + 1, F.lit(PIECE)),
                 F.array_join(F.slice(blocks, first + 2, last - first - 1), ""),
                 F.substring(F.coalesce(F.get(blocks, last), F.lit("")), F.lit(1), end)))


def _masked(text: Column, spans: Column, mark: str) -> Column:
    """The text between the spans, joined by marks; a span that starts inside an
    earlier one gets no mark of its own."""
    def gaps(reach):
        marked = F.zip_with(spans, reach, lambda s, before: F.struct(
            before.alias("start"), s["start"].alias("stop")))
        fresh = F.filter(marked, lambda g: g["start"] <= g["stop"])
        end = F.array_max(F.transform(spans, lambda s: s["stop"]))
        return F.concat(fresh, F.array(F.struct(end.alias("start"), F.length(text).alias("stop"))))

    def joined(blocks):
        reach = _let(F.transform(spans, lambda s: s["stop"]),
                     lambda stops: _earlier(stops, lambda a, b: F.greatest(a, b)))
        return F.array_join(F.transform(_let(reach, gaps), lambda g: _cut(
            blocks, g["start"], g["stop"])), mark)
    return _let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)), joined)


def masked(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced by ``mark``; overlapping spans share one.
    ``n_chars``, where present, follows the new text; a text without spans and a
    null text stay as they are."""
    out = free_name(docs, "secrets")
    text, spans = F.col("text"), F.col(f"{out}.spans")
    frame = scan(docs, out=out).withColumn("text", F.when(
        F.size(spans) > 0, _masked(text, spans, mark)).otherwise(text))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        frame = frame.withColumn("n_chars", F.when(
            F.size(spans) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return frame.select(*docs.columns)
