"""Removal of repeated byte strings against plain search."""

import hashlib
import random

import numpy as np
import pytest

from landledger.llm import repeats
from tests.llm import cases


def brute(texts):
    """Expected rows of texts in order of their id."""
    seen, out = set(), []
    for text in texts:
        b = (text or "").encode()
        covered = bytearray(len(b))
        for i in range(len(b) - 99):
            if b[i:i + 100] in seen:
                covered[i:i + 100] = b"\1" * 100
            seen.add(b[i:i + 100])
        spans = sum(c and not p for p, c in zip(bytes([0]) + bytes(covered), covered))
        kept = bytes(x for x, c in zip(b, covered) if not c)
        out.append((len(b), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)

    def some(n, letters="abcdefgh é"):
        return "".join(rng.choice(letters) for _ in range(n))
    passages = [some(n) for n in (40, 99, 100, 101, 130, 400)]
    texts = []
    for _ in range(40):
        texts.append("".join(rng.choice([
            some(rng.randint(0, 120)), rng.choice(passages), rng.choice(passages),
            "x" * rng.randint(50, 300), "ab" * rng.randint(40, 90)])
            for _ in range(rng.randint(0, 5))))
    near = texts[7] + some(200)
    return [*texts, texts[3], texts[3], near, near[:90] + "#" + near[91:], "", "x" * 99, "x" * 100]


def rows(df):
    return [tuple(r)[1:] for r in df.orderBy("doc_id").collect()]


@pytest.mark.parametrize("chunk", [repeats.CHUNK, 150])
def test_equals_plain_search(spark, monkeypatch, chunk):
    monkeypatch.setattr(repeats, "CHUNK", chunk)
    texts = corpus(1)
    assert rows(repeats.deduplicated(cases.documents(spark, texts))) == brute(texts)


def test_anchors_are_the_smallest_of_every_window():
    x = np.random.default_rng(1).integers(0, 1 << 63, 300).astype(np.uint64)
    for width in (1, 2, 7, 61):
        found = repeats._anchors(x, width)
        assert [int(np.argmin(x[i:i + width])) + i for i in range(300 - width + 1)] == found.tolist()


def test_awkward_rows(spark):
    docs = cases.awkward(spark).where("doc_id is null or doc_id != 6")
    found = cases.pairs(repeats.deduplicated(docs), "doc_id", "n_bytes", "n_removed")
    assert len(found) == 8 and found.count((3, 3, 0)) == 2 and (0, 0, 0) in found
    assert repeats.deduplicated(cases.none(spark)).count() == 0
    rng = random.Random(3)
    long = "".join(rng.choice("abcdef ") for _ in range(500))
    other = long[:250]
    docs = cases.documents(spark, [long, long, other, long], [1, 1, 1, None])
    found = cases.pairs(repeats.deduplicated(docs), "doc_id", "n_bytes", "n_removed")
    one, null = [f for f in found if f[0] == 1], [f for f in found if f[0] is None]
    assert null == [(None, 500, 500)]
    # rows equal in id and text are one document; of the two texts the later one loses
    assert one in ([(1, 250, 0), (1, 500, 250), (1, 500, 250)],
                   [(1, 250, 250), (1, 500, 0), (1, 500, 0)])


def test_the_last_round_has_a_second_hash():
    weak = repeats._powers(1)  # sums only: the order of bytes does not count
    a, b = bytes(range(100)), bytes(reversed(range(100)))
    pieces = [(0, 0, 0, a), (1, 0, 0, b), (2, 0, 0, a)]
    with np.errstate(over="ignore"):
        ranks, covers, *_ = repeats.Block(pieces, weak, repeats._powers(repeats._SECOND)).rows(1)
    assert len(set(ranks.tolist())) == 1
    assert covers[0] == covers[2] != covers[1]
