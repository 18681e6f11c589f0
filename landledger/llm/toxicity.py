"""Toxicity by a weighted lexicon.

A text is folded (compatibility forms, accents kept, look-alike letters of other
scripts and digits inside words mapped to Latin letters) and every entry of the
lexicon is found in one Aho-Corasick scan.  Entries are whole words or beginnings
of words.  Weights of matched entries are summed, matches inside exception
phrases left out, and the sum is divided by the logarithm of the length; a
logistic curve turns it into a score.

The lexicon holds a fixed seed list and the word beginnings that set labelled
toxic documents apart.  An entry is learned if the lower end of the usual interval
around its log-odds is high enough, and that end is its weight: so a few texts weigh
less than many, one clean text does not strike out an entry, and no count decides by
itself.  The curve is fitted on rows that the lexicon was not learned from.  Both use a
bounded, documented sample of the labelled rows; every document is then scored whole
in one pass.
"""

from __future__ import annotations

import functools
import math
import re
import unicodedata
from collections import Counter

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landledger.llm.common import Once, free_name, map_rows, utf8, with_result

#: Labelled rows of each class that the model is fitted on, chosen by a hash of their id.
TRAIN_ROWS = 10_000
#: One training row in so many is kept for the curve.
CURVE_FOLDS = 3
#: Shortest and longest learned beginning of a word, in characters.
BEGINNING = (4, 8)
#: Least weight of a learned entry, and that of a seed entry without evidence.
LEAST_WEIGHT, SEED_WEIGHT = 2.5, 4.0
#: Standard errors between the log-odds of an entry and its weight.
CAUTION = 1.0
#: Cut-off of the sum over ln(e + words) above which a text counts as toxic.
FALLBACK = (-4.0, 4.0)

# Words of abuse in the corpus's languages that are weighted before
# any label is seen.
SEEDS = tuple("""
    arschloch asshole bastard bastardo bitch blöd cabrón clown connard connasse crétin cretin
    depp dickhead disgusting douchebag dumbass dumm dummkopf enculé estúpido fuck gilipollas
    hijodeputa hurensohn idiot idiota idiote imbécil imbecile jackass loser maldito merde miststück
    moron motherfucker mierda nutte pathetic pendejo putain puta salaud salope scheiße scum
    scumbag shit shithead slut stupid trash trottel vollidiot whore wichser worthless
""".split())

# Phrases in which an entry is no abuse.
EXCEPTIONS = tuple(p.strip() for p in """
    clown fish, clown car, class clown, idiot proof, trash can, trash bag, trash bin,
    trash collection, sore loser, loser bracket, stupid simple, pond scum, scum line
""".split(","))

# Letters of other scripts that look like Latin ones.
LOOKALIKES = dict(zip(
    "аеорсухіјѕԁһкмтвнгАЕОРСУХІЈЅКМТВНαεικνορτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧıł",
    "aeopcyxijsdhkmtbhraeopcyxijskmtbhaeikvoptuxabezhikmnoptyxil"))

# Digits and signs that stand for letters inside a word.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
               "@": "a", "$": "s", "!": "i", "|": "l", "€": "e"}

_FOLD = str.maketrans(LOOKALIKES)
_LEET = str.maketrans(SUBSTITUTES)
_MIXED = re.compile(r"[^\W\d_]+[0-9@$!|€](?:[^\W_]|[@$!|€])*[^\W\d_]|"
                    r"[0-9@$|€]+[^\W\d_](?:[^\W_]|[@$!|€])*")
_WORD = re.compile(r"[^\W_]+")
_INVISIBLE = dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF])
# quick looks that spare most texts the slower steps
_HAS_INVISIBLE = re.compile(f"[{''.join(map(chr, _INVISIBLE))}]").search
_HAS_LOOKALIKE = re.compile(f"[{''.join(LOOKALIKES)}]").search
_HAS_SUBSTITUTE = re.compile(r"[0-9@$!|€][^\W_]|[^\W_][0-9@$!|€]").search


def folded(text: str) -> list[str]:
    """The words of a text as the lexicon sees them."""
    if not text.isascii():
        if _HAS_INVISIBLE(text):
            text = text.translate(_INVISIBLE)
        if not unicodedata.is_normalized("NFKC", text):
            text = unicodedata.normalize("NFKC", text)
        if _HAS_LOOKALIKE(text):
            text = text.translate(_FOLD)
    text = text.lower()
    if _HAS_SUBSTITUTE(text):
        text = _MIXED.sub(lambda m: m.group().translate(_LEET), text)
    return _WORD.findall(text)


def _line(words: list[str]) -> str:
    return f" {' '.join(words)} "


def _features(words: list[str]) -> set[str]:
    """Whole words (with a blank at the end) and beginnings of words."""
    shortest, longest = BEGINNING
    found = set()
    for word in set(words):
        found.add(word + " ")
        found.update(word[:n] for n in range(shortest, min(longest, len(word)) + 1))
    return found


def _texts(column) -> list[str]:
    return [(t or b"").decode("utf-8", "replace") for t in utf8(column)]


def _count_features(batches):
    toxic, clean = Counter(), Counter()
    for batch in batches:
        for text, label in zip(_texts(batch.column(0)), batch.column(1).to_pylist()):
            (toxic if label else clean).update(_features(folded(text)))
        if len(toxic) + len(clean) > 1_000_000:
            yield _counted(toxic, clean)
            toxic, clean = Counter(), Counter()
    yield _counted(toxic, clean)


def _counted(toxic, clean):
    names = list(toxic.keys() | clean.keys())
    return [names, [toxic[n] for n in names], [clean[n] for n in names]]


def _automaton(model):
    entries, exceptions = model["entries"], model["exceptions"]
    found = ahocorasick.Automaton()
    for phrase in exceptions:
        found.add_word(_line(folded(phrase)), (0.0, len(_line(folded(phrase)))))
    for entry, weight in entries.items():
        found.add_word(" " + entry, (weight, 1 + len(entry)))
    if len(found):
        found.make_automaton()
    return found, model["curve"]


def _density(words: list[str], automaton) -> tuple[float, int]:
    """Sum of the matched weights over ln(e + words), and the number of matches.
    At one start only the heaviest entry counts, none inside an exception."""
    if not words or not len(automaton):
        return 0.0, 0
    best: dict[int, float] = {}
    excused: list[tuple[int, int]] = []
    for end, (weight, size) in automaton.iter(_line(words)):
        start = end - size + 1
        if weight:
            best[start] = max(weight, best.get(start, weight))
        else:
            excused.append((start, end))
    if excused:
        best = _outside(best, excused)
    return sum(best.values()) / math.log(math.e + len(words)), len(best)


def _outside(best: dict[int, float], excused: list[tuple[int, int]]) -> dict[int, float]:
    """The matches that start in no exception; both lists are walked once, in order."""
    kept, reach, phrases = {}, -1, iter(sorted(excused))
    phrase = next(phrases, None)
    for start in sorted(best):
        while phrase and phrase[0] <= start:
            reach, phrase = max(reach, phrase[1]), next(phrases, None)
        if start >= reach:
            kept[start] = best[start]
    return kept


def _score(texts, model):
    automaton, (base, slope) = model.get()
    scores, matches = [], []
    for text in _texts(texts):
        x, n = _density(folded(text), automaton)
        scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, base + slope * x)))))
        matches.append(n)
    return [scores, matches]


def _densities(batches, model):
    automaton, _ = model.get()
    for batch in batches:
        yield [[_density(folded(t), automaton)[0] for t in _texts(batch.column(0))],
               batch.column(1).to_pylist()]


def held_out(doc_id: str = "doc_id"):
    """Rows that no model may learn from; a null id counts as held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _training(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """text and label of at most ``rows`` labelled documents of each class, and whether
    the row is kept for the curve.  The chosen ids are few by construction, so they are broadcast and no text moves."""
    known = (labels.where(~held_out() & F.col("toxic").isin(0, 1))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    order = F.xxhash64(F.col("doc_id"))
    chosen = functools.reduce(DataFrame.union, (
        known.where(F.col("toxic") == label).orderBy(order, "doc_id").limit(rows)
        for label in (0, 1)))
    chosen = chosen.select(F.col("doc_id").alias("id"), "toxic", (
        F.pmod(F.xxhash64("doc_id", F.lit("curve")), F.lit(CURVE_FOLDS)) == 0).alias("curve"))
    return (docs.select("doc_id", "text")
            .join(F.broadcast(chosen), F.col("doc_id") == F.col("id"))
            .select("text", "toxic", "curve"))


def _lexicon(training: DataFrame) -> dict[str, float]:
    """Weights of the seeds and of learned entries, as many as the evidence in the
    bounded ``training`` rows carries.  A beginning is left out if a shorter one is as
    telling, so the entries cover unseen words."""
    sizes = dict(training.groupBy("toxic").count().collect())
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return {seed + " ": SEED_WEIGHT for seed in SEEDS}
    counts = map_rows(training.select("text", "toxic"),
                      "entry string, toxic bigint, clean bigint", _count_features)
    toxic, clean = F.col("toxic") + 0.5, F.col("clean") + 0.5
    weight = (F.log(toxic / (n_toxic + 1)) - F.log(clean / (n_clean + 1))
              - CAUTION * F.sqrt(1 / toxic + 1 / clean))
    totals = (counts.groupBy("entry").agg(F.sum("toxic").alias("toxic"),
                                          F.sum("clean").alias("clean"))
              .withColumn("weight", weight).where(F.col("weight") >= LEAST_WEIGHT))
    found = {r["entry"]: r["weight"] for r in totals.toLocalIterator()}
    kept = {}
    for entry in sorted(found, key=lambda e: (len(e), e)):
        shorter = max((kept[entry[:n]] for n in range(BEGINNING[0], len(entry))
                       if entry[:n] in kept), default=None)
        if shorter is None or found[entry] > shorter + 1:
            kept[entry] = found[entry]
    for seed in SEEDS:
        kept.setdefault(seed + " ", SEED_WEIGHT)
    return kept


def _curve(densities: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the label on one number, with a small penalty on
    the slope (Newton's method)."""
    if len(set(labels.tolist())) < 2 or not densities.any():
        return FALLBACK
    x = np.column_stack([np.ones(len(densities)), densities])
    beta, ridge = np.zeros(2), np.array([1e-3, 1e-1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (labels - p) - ridge * beta
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hessian, gradient)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return (float(beta[0]), float(beta[1])) if beta[1] > 0 else FALLBACK


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS,
        exceptions: tuple[str, ...] = EXCEPTIONS) -> dict:
    """Lexicon, exception phrases and score curve.  Without labels of both
    classes the seeds and a fixed curve are used."""
    training = _training(docs, labels, rows)
    model = {"entries": _lexicon(training.where(~F.col("curve"))), "exceptions": exceptions,
             "curve": FALLBACK}
    once = Once(docs.sparkSession, model, _automaton)
    seen = map_rows(training.where("curve").select("text", "toxic"), "density double, toxic bigint",
                    functools.partial(_densities, model=once)).toPandas()
    model["curve"] = _curve(seen["density"].to_numpy(float), seen["toxic"].to_numpy(int))
    return model


def scored(docs: DataFrame, model: dict, keep: list[str] | None = None,
           out: str = "toxicity") -> DataFrame:
    """``keep`` columns (all by default) and the struct ``out``: score in 0..1 and
    number of matched entries.  One row per row of ``docs``; a null or empty text
    has no match.  Columns other than the text have no influence."""
    once = Once(docs.sparkSession, model, _automaton)
    return with_result(docs, ["text"], docs.columns if keep is None else keep, out,
                       "score double, matches bigint", functools.partial(_score, model=once))


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score below one half."""
    out = free_name(docs, "toxicity")
    return (scored(docs, fit(docs, labels), out=out)
            .where(F.col(f"{out}.score") < 0.5).select(*docs.columns))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted, one row per row of ``docs``, repeated rows
    and ids included.  A null or empty text has the score of a text without matches; a null
    id counts as held out.  Without labels of both classes the seeds and a fixed curve
    score; empty tables give an empty result."""
    return scored(docs, fit(docs, labels), ["doc_id"]).select(
        "doc_id", held_out().alias("held_out"), F.col("toxicity.score").alias("score"),
        (F.col("toxicity.score") >= 0.5).cast("int").alias("predicted"))
