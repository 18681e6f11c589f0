"""Approximate nearest neighbours by learned partitions.

Index: a bounded sample is linked to its nearest neighbours; the graph is cut into
equally large parts by recursive bisection (the second eigenvector, split at the
median, then swaps that cut fewer links); a small neural network learns to tell
from a vector how its neighbours spread over the parts.  Every vector goes to its
most probable part, every query to as many of its most probable parts as held-out
sample vectors needed for the wanted recall; the vectors there are ranked by their
exact inner product in double precision.

The network has one hidden layer; it, and the parts, are all that is broadcast.
Equal vectors are one item: of those only the smallest ids can be among the
nearest, so at most one more than asked for are kept.  A part is cut into blocks
of bounded size, and a block's queries are taken in slices, so a crowded part is
more blocks, not a bigger task.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landledger.llm.common import Once, checkpointed, map_rows

#: Rows the index is fitted on, chosen by a hash of their id.
SAMPLE = 4096
#: Recall that held-out sample vectors must reach when the number of parts to
#: search is chosen.
WANTED = 0.96
#: Vectors per part aimed at, most parts, most vectors in a block and queries in a slice.
PART_ROWS, MOST_PARTS, BLOCK, SLICE = 256, 64, 4096, 1024
LINKS, HIDDEN, EPOCHS = 12, 128, 60


def _nearest(x: np.ndarray, k: int) -> np.ndarray:
    """Places of the k rows with the largest inner product, other than itself."""
    out = np.empty((len(x), k), np.int64)
    for i in range(0, len(x), 512):
        scores = x[i:i + 512] @ x.T
        scores[np.arange(len(scores)), np.arange(i, i + len(scores))] = -np.inf
        out[i:i + 512] = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    return out


def _bisect(places, a, b, random):
    """Two equal halves of ``places`` that cut few of the links a-b among them."""
    n = len(places)
    degree = np.bincount(a, minlength=n) + 1e-9
    vector, trivial = random.standard_normal(n), np.sqrt(degree) / np.sqrt(degree.sum())
    weight = 1 / np.sqrt(degree[a] * degree[b])
    for _ in range(60):
        vector -= trivial * (trivial @ vector)
        vector = vector + np.bincount(a, weight * vector[b], n)
        vector /= np.linalg.norm(vector)
    side = np.zeros(n, bool)
    side[np.argsort(vector / np.sqrt(degree), kind="stable")[n // 2:]] = True
    for _ in range(10):  # swap the vertices that would gain most by the other side
        crossing = np.bincount(a, side[a] != side[b], n)
        gain = 2 * crossing - np.bincount(a, minlength=n)
        left, right = np.flatnonzero(~side), np.flatnonzero(side)
        left, right = left[np.argsort(-gain[left])], right[np.argsort(-gain[right])]
        m = min(len(left), len(right))
        swap = np.flatnonzero(gain[left[:m]] + gain[right[:m]] > 2)[:max(1, n // 50)]
        if not len(swap):
            break
        side[left[swap]], side[right[swap]] = True, False
    return side


def _parts(near: np.ndarray, parts: int, random) -> np.ndarray:
    """Balanced parts (a power of two) of the graph with links to ``near``."""
    n, k = near.shape
    a, b = np.repeat(np.arange(n), k), near.ravel()
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    label = np.zeros(n, np.int64)
    for _ in range(int(math.log2(parts))):
        new = label * 2
        inner = label[a] == label[b]
        order = np.argsort(label, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(label[order])) + 1):
            place = np.full(n, -1)
            place[part] = np.arange(len(part))
            mine = inner & (place[a] >= 0)
            new[part] += _bisect(part, place[a[mine]], place[b[mine]], random)
        label = new
    return label


def probabilities(x: np.ndarray, net) -> np.ndarray:
    w1, b1, w2, b2 = net
    z = np.maximum(x @ w1 + b1, 0) @ w2 + b2
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def _train(x, spread, random):
    """One hidden layer, cross-entropy to the spread of neighbours over parts (Adam)."""
    d, parts = x.shape[1], spread.shape[1]
    net = [random.standard_normal((d, HIDDEN)) * math.sqrt(2 / d), np.zeros(HIDDEN),
           random.standard_normal((HIDDEN, parts)) * math.sqrt(1 / HIDDEN), np.zeros(parts)]
    mean, square = [np.zeros_like(p) for p in net], [np.zeros_like(p) for p in net]
    step = 0
    for _ in range(EPOCHS):
        for rows in np.array_split(random.permutation(len(x)), max(1, len(x) // 128)):
            hidden = np.maximum(x[rows] @ net[0] + net[1], 0)
            z = hidden @ net[2] + net[3]
            z = np.exp(z - z.max(axis=1, keepdims=True))
            error = (z / z.sum(axis=1, keepdims=True) - spread[rows]) / len(rows)
            back = (error @ net[2].T) * (hidden > 0)
            step += 1
            for i, g in enumerate((x[rows].T @ back, back.sum(0), hidden.T @ error, error.sum(0))):
                mean[i] += 0.1 * (g - mean[i])
                square[i] += 0.001 * (g * g - square[i])
                net[i] -= 2e-3 * (mean[i] / (1 - 0.9 ** step)) / (
                    np.sqrt(square[i] / (1 - 0.999 ** step)) + 1e-8)
    return tuple(net)


def learn(x: np.ndarray, rows: int, k: int, wanted: float = WANTED) -> dict:
    """Router and number of parts to search for an index of ``rows`` vectors, from
    the sample ``x`` of distinct vectors."""
    random = np.random.default_rng(7)
    scale = float(np.sqrt((x * x).sum(axis=1).mean())) if len(x) else 1.0
    unit = x / scale
    parts = 2 ** max(0, min(int(math.log2(MOST_PARTS)), round(math.log2(max(1, rows / PART_ROWS)))))
    parts = min(parts, 2 ** max(0, int(math.log2(max(1, len(x) // 32)))))
    if parts == 1 or len(x) <= 2 * LINKS:
        return {"net": None, "scale": scale, "parts": 1, "search": 1}
    near = _nearest(x, min(LINKS, len(x) - 1))
    label = _parts(near, parts, random)
    spread = np.zeros((len(x), parts))
    for column in near.T:
        spread[np.arange(len(x)), label[column]] += 1
    spread[np.arange(len(x)), label] += 1
    spread /= spread.sum(axis=1, keepdims=True)
    held = random.random(len(x)) < 0.2
    net = _train(unit[~held], spread[~held], random)
    chance = probabilities(unit, net)
    home = chance.argmax(axis=1)
    order = np.argsort(-chance, axis=1)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(parts)[None, :], axis=1)
    true = _nearest(x, min(k, len(x) - 1))[held]
    found_at = np.take_along_axis(place[held], home[true], axis=1)
    recall = (found_at[:, :, None] <= np.arange(parts)).mean(axis=(0, 1))
    return {"net": net, "scale": scale, "parts": parts,
            "search": int(np.argmax(recall >= min(wanted, recall[-1]))) + 1}


def _matrix(column) -> np.ndarray:
    """The vectors of an Arrow list column as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(
        len(column), -1)


def _routed(batches, model, search):
    """Each row with its most probable parts, as many as asked for."""
    for batch in batches:
        if not len(batch):
            continue
        net = model.data.value
        if net["net"] is None:
            part = np.zeros((len(batch), 1), np.int64)
        else:
            chance = probabilities(_matrix(batch.column(2)) / net["scale"], net["net"])
            part = np.argsort(-chance, axis=1, kind="stable")[:, :search]
        for i in range(part.shape[1]):
            yield [batch.column(0), batch.column(1), batch.column(2), batch.column(3), part[:, i]]


def _ranked(candidates, queries, k):
    """The k nearest ids of every query among a block's candidates.  Products are
    summed in one fixed order, so equal vectors get equal scores everywhere."""
    if not len(candidates) or not len(queries):
        return pd.DataFrame({"h1": [], "h2": [], "vec_id": [], "score": []})
    ids = candidates["ids"].tolist()
    x = np.stack(candidates["vector"].to_numpy()).astype(np.float64)
    y = np.stack(queries["vector"].to_numpy()).astype(np.float64)
    rows, found, scores = [], [], []
    for i in range(0, len(y), 128):
        rough = y[i:i + 128] @ x.T
        slack = 1e-9 * (1 + np.abs(rough).max())
        least = np.partition(rough, -min(k, len(x)), axis=1)[:, -min(k, len(x))] - slack
        for j, (line, bound) in enumerate(zip(rough, least)):
            near = np.flatnonzero(line >= bound)
            exact = (x[near] * y[i + j]).sum(axis=1)
            best = sorted((-s, v) for s, c in zip(exact.tolist(), near.tolist()) for v in ids[c])
            rows += [i + j] * len(best[:k])
            found += [v for _, v in best[:k]]
            scores += [-s for s, _ in best[:k]]
    chosen = queries.iloc[rows]
    return pd.DataFrame({"h1": chosen["h1"].to_numpy(), "h2": chosen["h2"].to_numpy(),
                         "vec_id": found, "score": scores})


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (doubles): no null id, vector or component, only finite
    components, not all zero, and of the length that most vectors have (of equally
    common ones the shorter)."""
    v = F.col("vector")
    whole = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("vector")).where(
        F.col("vec_id").isNotNull() & (F.size(v) > 0)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(v, lambda x: x != 0))
    common = (whole.groupBy(F.size(v).alias("n")).count()
              .orderBy(F.desc("count"), "n").select("n").first())
    return whole.where(F.size(v) == (common["n"] if common else 0))


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, sample: int = SAMPLE,
            wanted: float = WANTED) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest other vectors found for
    every vector whose id ``every`` divides; ties go to the smaller id.

    Rows that ``usable`` rejects take no part.  Rows with one id are one item that
    scores with the best of its vectors; they are never their own neighbours.  If
    there are at most ``k`` others, all are returned as far as they are searched.
    """
    spark, keep = vectors.sparkSession, k + 1
    vector = F.col("vector")
    rows = usable(vectors).withColumns({
        "h1": F.xxhash64(vector), "h2": F.xxhash64(F.lit(1), vector)})
    first = Window.partitionBy("h1", "h2").orderBy("vec_id")
    items = checkpointed(
        rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= keep)
        .groupBy("h1", "h2").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"),
                                 F.first("vector").alias("vector")))
    queries = rows.where(F.col("vec_id") % every == 0).select("vec_id", "h1", "h2")
    asked = queries.select("h1", "h2").distinct()
    total = items.count()
    seen = (items.orderBy(F.xxhash64("h1"), "h1", "h2").limit(sample)
            .select("vector").toPandas()["vector"])
    model = learn(np.stack(seen.to_numpy()) if len(seen) else np.zeros((0, 1)), total, k, wanted)
    router = Once(spark, model, None)

    ddl = "h1 bigint, h2 bigint, vector array<double>, ids array<bigint>, part bigint"
    columns = ["h1", "h2", "vector", "ids"]
    homes = checkpointed(map_rows(items.select(columns), ddl, functools.partial(
        _routed, model=router, search=1)))
    counts = dict(homes.groupBy("part").count().collect())  # at most MOST_PARTS rows
    blocks = F.array(*(F.lit(math.ceil(counts.get(i, 0) / BLOCK))
                       for i in range(model["parts"])))[F.col("part").cast("int")]
    homes = homes.withColumn("block", F.pmod(F.xxhash64("h2", "h1"), blocks))
    slices = math.ceil(asked.count() * model["search"] / model["parts"] / SLICE)
    homes = homes.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(max(0, slices - 1)))))
    searched = (map_rows(items.join(asked, ["h1", "h2"], "left_semi").select(columns), ddl,
                         functools.partial(_routed, model=router, search=model["search"]))
                .drop("ids").where(blocks > 0)
                .withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
                .withColumn("slice", F.pmod(F.xxhash64("h2", "h1"), F.lit(max(1, slices)))))
    task = ["part", "block", "slice"]

    found = (searched.withColumn("block", F.col("block").cast("bigint"))
             .groupBy(*task).cogroup(homes.withColumn("slice", F.col("slice").cast("bigint"))
                                     .groupBy(*task))
             .applyInPandas(lambda q, c: _ranked(c, q, keep),
                            "h1 bigint, h2 bigint, vec_id bigint, score double"))
    best = Window.partitionBy("h1", "h2").orderBy(F.desc("score"), "vec_id")
    found = checkpointed(
        found.groupBy("h1", "h2", "vec_id").agg(F.max("score").alias("score"))
        .withColumn("n", F.row_number().over(best)).where(F.col("n") <= keep).drop("n"))
    pairs = (queries.withColumnRenamed("vec_id", "query_id").join(found, ["h1", "h2"])
             .where("query_id != vec_id")
             .groupBy("query_id", "vec_id").agg(F.max("score").alias("score")))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
