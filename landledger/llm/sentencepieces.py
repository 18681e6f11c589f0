"""SentencePiece encoding and decoding.

An Aho-Corasick automaton over the pieces reports, at every position, all pieces
that end there (a state's own piece, then its output links).  One pass over the
text relaxes the best score of each position with them; the back pointers give
the segmentation with the highest sum of scores.  Of equal sums the one whose
last piece is longer wins.  A character that is no piece costs ten more than the
worst piece and, where the model has byte pieces, is written as its bytes.

Where no piece has a word mark after another character, holds a line end, or has a
certain sign after a letter, no piece can cross those places: the best segmentation
of a text is that of its chunks side by side.  Chunks repeat, so each worker
remembers a bounded number.

A model trained by byte-pair merging has minus the rank as score, and the highest
sum alone is not what its merges give.  For such a model the search gets a
transition rule: a piece may only follow one beside which the merges would leave
it, that is, the merges turn the two pieces' text into just these two.  The same
pass then gives the ids of the merges, as the library does.

The model file is read on the driver; its pieces are the broadcast data.
"""

from __future__ import annotations

import functools
import re
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landledger.llm.common import Once, utf8, with_result

#: The mark that stands for a blank.
MARK = "▁"
#: Chunks, and neighbouring pieces, that a worker remembers.
REMEMBERED, NEIGHBOURS = 300_000, 400_000
_UNKNOWN_PENALTY = 10.0
_LETTER = r"[^\W\d_]"


def read_model(path: str) -> dict:
    """Pieces, scores and kinds of a model file without text normalisation."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return describe(model)


def describe(model) -> dict:
    probe = "ﬁ①Å  x "
    prefix, body = model.normalize("a")[:1] == MARK, probe.replace(" ", MARK)
    if model.normalize(probe) != MARK * prefix + body:
        raise ValueError("only models that leave the text as it is are supported")
    ids = range(model.vocab_size())
    ranked = [model.get_score(i) for i in ids if not (
        model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    return {"merged": all(x == int(x) <= 0 for x in ranked) and len(set(ranked)) > 1,
            "prefix": prefix, "unknown": model.unk_id(),
            "pieces": [model.id_to_piece(i) for i in ids],
            "scores": [model.get_score(i) for i in ids],
            "byte": [model.is_byte(i) for i in ids],
            "silent": [model.is_control(i) for i in ids],
            "usable": [not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)
                            or model.is_unused(i)) for i in ids]}


def spelling(model: dict) -> list[bytes]:
    """The bytes that each id stands for."""
    out = [b"" if silent else bytes([int(p[3:5], 16)]) if byte else p.replace(MARK, " ").encode()
           for p, silent, byte in zip(model["pieces"], model["silent"], model["byte"])]
    out[model["unknown"]] = " ⁇ ".encode()
    return out


class Codec:
    """Encoder of one worker."""

    def __init__(self, model: dict):
        self.prefix, self.unknown = model["prefix"], model["unknown"]
        self.automaton, self.single = ahocorasick.Automaton(), set()
        scores = []
        crossing = line_end = False
        after_letter = set()
        for i, (piece, score) in enumerate(zip(model["pieces"], model["scores"])):
            if not model["usable"][i]:
                continue
            self.automaton.add_word(piece, (len(piece), score, i))
            scores.append(score)
            if len(piece) == 1:
                self.single.add(piece)
            crossing |= re.search(f"[^{MARK}]{MARK}", piece) is not None
            line_end |= "\n" in piece
            after_letter.update(re.findall(f"(?<={_LETTER}).", piece))
        if scores:
            self.automaton.make_automaton()
        self.unknown_score = min(scores, default=0.0) - _UNKNOWN_PENALTY
        by_byte = {int(p[3:5], 16): i for i, p in enumerate(model["pieces"]) if model["byte"][i]}
        self.bytes = [by_byte[b] for b in range(256)] if len(by_byte) == 256 else None
        self.chunks = None if crossing else self._cutter(line_end, after_letter)
        self.spelled = spelling(model)
        self.remembered: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # those remembered before
        self.pieces = model["pieces"]
        self.ranks = ({p: s for p, s, use in zip(self.pieces, model["scores"], model["usable"])
                       if use} if model["merged"] else None)
        self.neighbours: dict[int, bool] = {}

    @staticmethod
    def _cutter(line_end: bool, after_letter: set[str]):
        """Finds the chunks of a text: up to a mark or line end, or up to a sign that
        follows a letter in no piece."""
        stop = MARK if line_end else MARK + r"\n"
        signs = "".join(re.escape(c) for c in "!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~"
                        if c not in after_letter)
        word = f"{MARK}*(?:(?!{_LETTER})[^{stop}])*{_LETTER}+(?![^{stop}{signs}])"
        return re.compile(("" if line_end else r"\n|") + f"{word}|{MARK}+[^{stop}]*|[^{stop}]+"
                          ).findall

    def _stays(self, left: str, right: str) -> bool:
        """Whether the merges turn the text of two pieces into just these two: the
        highest score first, of equal ones the leftmost."""
        parts, border = [*left, *right], len(left)
        while len(parts) > 2:
            found = [(-self.ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:]))
                     if a + b in self.ranks]
            if not found:
                return False
            i = min(found)[1]
            if i + 1 == border:
                return False
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            border -= i < border
        return border == 1 and left + right not in self.ranks

    def _may_follow(self, left: int, right: int) -> bool:
        found = left == self.unknown or self._stays(self.pieces[left], self.pieces[right])
        if len(self.neighbours) >= NEIGHBOURS:
            self.neighbours.clear()
        self.neighbours[left << 32 | right] = found
        return found

    def best(self, chunk: str) -> list[int]:
        """Piece ids of the segmentation with the highest sum of scores."""
        n, lowest, ruled = len(chunk), float("-inf"), self.ranks is not None
        single, known = self.single, self.neighbours.get
        strange = not single.issuperset(chunk)  # some character is no piece
        score, back, last = [0.0] + [lowest] * n, [0] * (n + 1), [self.unknown] * (n + 1)
        at = 0  # ends below are final

        def settle(upto):
            for end in range(at, upto):
                if chunk[end] not in single:
                    other = score[end] + self.unknown_score
                    if other > score[end + 1]:
                        score[end + 1], back[end + 1], last[end + 1] = other, end, self.unknown
        if single:
            for end, (length, value, piece) in self.automaton.iter(chunk):
                if strange and end > at:
                    settle(end)
                    at = end
                end += 1
                if ruled and back[end]:
                    continue  # under the rule only one piece can end here
                start = end - length
                other = score[start] + value
                if other > score[end]:
                    if ruled and start:
                        follows = known(last[start] << 32 | piece)
                        if follows is None:
                            follows = self._may_follow(last[start], piece)
                        if not follows:
                            continue
                    score[end] = other
                    back[end] = start
                    last[end] = piece
        if strange:
            settle(n)
        ids, end = [], n
        while end:
            start, piece = back[end], last[end]
            if piece == self.unknown and self.bytes:
                ids.extend(self.bytes[b] for b in reversed(chunk[start:end].encode()))
            else:
                ids.append(piece)
            end = start
        return ids[::-1]

    def _ids(self, chunk: str) -> bytes:
        found = self.remembered.get(chunk)
        if found is None:
            found = self.older.get(chunk)
            if found is None:
                found = array("i", self.best(chunk)).tobytes()
            if len(chunk) <= 64:
                if len(self.remembered) >= REMEMBERED:
                    self.older, self.remembered = self.remembered, {}
                self.remembered[chunk] = found
        return found

    def encode(self, text: str) -> bytes:
        """Ids as consecutive 32-bit integers."""
        if not text:
            return b""
        text = MARK * self.prefix + text.replace(" ", MARK)
        return b"".join(map(self._ids, self.chunks(text) if self.chunks else [text]))


class Speller:
    """Decoder of one worker."""

    def __init__(self, model: dict):
        self.prefix, self.spelled = model["prefix"], spelling(model)
        self.marked = [p.startswith(MARK) for p in model["pieces"]]

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.spelled.__getitem__, ids)).decode("utf-8", "replace")
        first = next((i for i in ids if self.spelled[i]), None)
        return text[1:] if self.prefix and first is not None and self.marked[first] else text


def _lists(parts: list[bytes]) -> pa.Array:
    """Consecutive 32-bit integers as an Arrow list column."""
    offsets = np.cumsum([0, *(len(p) // 4 for p in parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(
        pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), np.int32)),
        type=pa.list_(pa.field("element", pa.int32())))


def _encode(texts, coder):
    coder = coder.get()
    parts = [coder.encode((t or b"").decode("utf-8", "replace")) for t in utf8(texts)]
    return [_lists(parts), [len(p) // 4 for p in parts]]


def _there_and_back(texts, coder, speller):
    coder, speller = coder.get(), speller.get()
    parts, same = [], []
    for raw in utf8(texts):
        text = (raw or b"").decode("utf-8", "replace")
        parts.append(coder.encode(text))
        same.append(speller.decode(np.frombuffer(parts[-1], np.int32).tolist()) == text)
    return [_lists(parts), [len(p) // 4 for p in parts], same]


def _decode(ids, speller):
    speller = speller.get()
    return [[speller.decode(x or []) for x in ids.to_pylist()]]


def encode(docs: DataFrame, model: dict, keep: list[str] | None = None,
           out: str = "tokens") -> DataFrame:
    """``keep`` columns (all by default) and the struct ``out``: piece ids and
    their number.  One row per row; a null or empty text has no ids."""
    return with_result(docs, ["text"], docs.columns if keep is None else keep, out,
                       "ids array<int>, n bigint", functools.partial(
                           _encode, coder=Once(docs.sparkSession, model, Codec)))


def decode(rows: DataFrame, model: dict, ids: str, keep: list[str] | None = None,
           out: str = "decoded") -> DataFrame:
    """``keep`` columns and the struct ``out`` with the text of the ``ids`` column.
    Bytes that are no UTF-8 become U+FFFD; null ids give an empty text.  A word
    mark that was in the original text comes back as a blank."""
    return with_result(rows, [ids], rows.columns if keep is None else keep, out, "text string",
                       functools.partial(_decode, speller=Once(rows.sparkSession, model, Speller)))


def report(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, n_tokens, ids and round_trip (whether decoding gives the text back), one row
    per row of ``docs``, repeated rows and ids included.  A null or empty text has no ids
    and comes back as the empty text; an empty table gives an empty result.  Other columns
    have no influence."""
    spark = docs.sparkSession
    return with_result(
        docs, ["text"], ["doc_id"], "tokens", "ids array<int>, n bigint, same boolean",
        functools.partial(_there_and_back, coder=Once(spark, model, Codec),
                          speller=Once(spark, model, Speller))).select(
        "doc_id", F.col("tokens.n").alias("n_tokens"), F.col("tokens.ids").alias("ids"),
        F.col("tokens.same").alias("round_trip"))
