"""Toxicity: a linear classifier of character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.shared import slices, stored

#: Lengths of the n-grams in bytes, and bits of their hash.
ORDERS, BITS = (4, 6, 8), 19
#: Labelled rows of each class that the classifier is fitted on, at most: those with the smallest hash of the id.
ROWS_PER_CLASS = 4_000
#: The rows are fitted in so many parts; every step returns one gradient from each.
PARTS = 4
STEPS, MEMORY, PENALTY = 15, 6, 1e-4
#: N-grams in fewer fitted rows weigh nothing.
LEAST_ROWS = 3
#: One labelled row in so many is kept out of the fit, to turn margins into probabilities.
CALIBRATION = 5


def grams(column: pa.Array, last: np.ndarray) -> Iterator[np.ndarray]:
    """The distinct hashed n-grams of each text; `last` is scratch of 2^BITS places. White space and case are folded."""
    byte = np.arange(256, dtype=np.uint64)
    byte[65:91] += np.uint64(32)
    byte[9:14] = 32
    code = (byte + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    odd, turn = np.uint64(0xD6E8FEB86659FD93), np.uint64(29)
    texts = [t.encode("utf-8", "surrogatepass") if t else b"" for t in column.to_pylist()]
    # A space on either side lets n-grams see where a text starts and ends.
    own = code[np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)]
    h, hashed = own, {}
    for n in range(2, max(ORDERS) + 1):
        h = (h[:-1] ^ (h[:-1] >> turn)) * odd + own[n - 1:] if len(h) > 1 else h[:0]
        if n in ORDERS:
            hashed[n] = (((h ^ (h >> np.uint64(32))) * odd) >> np.uint64(64 - BITS)).astype(np.int32)
    start = 0
    for t in texts:
        end = start + len(t) + 2
        ids = np.concatenate([hashed[n][start:max(start, end - n + 1)] for n in ORDERS])
        place = np.arange(len(ids), dtype=np.int32)
        last[ids] = place
        yield ids[last[ids] == place]
        start = end - 1


@dataclass
class Model:
    """Weights of the hashed n-grams with the log-count ratios multiplied in; without both classes only `share`."""
    weights: np.ndarray | None
    slope: float
    bias: float
    share: float

    def score(self, ids: np.ndarray) -> float:
        if self.weights is None:
            return self.share
        z = self.slope * float(self.weights[ids].sum(dtype=np.float64)) + self.bias
        return float(1 / (1 + np.exp(-min(max(z, -40.0), 40.0))))


def sums_over(rows: DataFrame, step, size: int, prepare=iter) -> tuple[np.ndarray, np.ndarray]:
    """Run `step(label, weight, ids, vector)` over the parts, as `prepare` makes them, and add up its two numbers and
    its vector of `size`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector, numbers = np.zeros(size), np.zeros(2)
        for batch in prepare(batches):
            for label, weight, ids in zip(*(batch.column(c).to_pylist() for c in ("label", "weight", "ids"))):
                numbers += step(label, weight, np.frombuffer(ids, np.int32), vector)
        yield pa.RecordBatch.from_pydict({"numbers": [numbers.tolist()], "vector": [vector.astype(np.float32).tobytes()]})
    numbers, vector = np.zeros(2), np.zeros(size)
    for part in rows.mapInArrow(run, "numbers array<double>, vector binary").collect():  # one row per part
        numbers += part["numbers"]
        vector += np.frombuffer(part["vector"], np.float32)
    return numbers, vector


def objective(rows: DataFrame, ratio: np.ndarray):
    """Weighted logistic loss of the scaled features with an L2 penalty, and its gradient; the bias is the last place."""
    def evaluate(v: np.ndarray) -> tuple[float, np.ndarray]:
        scaled, bias = (v[:-1] * ratio).astype(np.float32), float(v[-1])

        def step(label, weight, ids, vector):
            z = float(scaled[ids].sum(dtype=np.float64)) + bias
            error = weight * (1 / (1 + np.exp(-min(max(z, -40.0), 40.0))) - label)
            vector[ids] += error
            return np.array([weight * (np.logaddexp(0, z) - label * z), error])

        (total, up), grad = sums_over(rows, step, len(ratio))
        w = v[:-1]
        return total + PENALTY * float(w @ w) / 2, np.append(grad * ratio + PENALTY * w, up)
    return evaluate


def minimise(evaluate, size: int) -> np.ndarray:
    """Limited-memory BFGS with step halving."""
    v, past = np.zeros(size), []
    value, grad = evaluate(v)
    for _ in range(STEPS):
        way, back = -grad, []
        for s, y in reversed(past):
            a = (s @ way) / (s @ y)
            back.append(a)
            way = way - a * y
        way = way * ((past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1]) if past else 1 / max(1.0, np.linalg.norm(grad)))
        for (s, y), a in zip(past, reversed(back)):
            way = way + s * (a - (y @ way) / (s @ y))
        size_of_step, slope = 1.0, float(grad @ way)
        while True:
            near, new = evaluate(v + size_of_step * way)
            if near <= value + 1e-4 * size_of_step * slope or size_of_step < 0.05:
                break
            size_of_step /= 2
        if near >= value:
            break
        s, y = size_of_step * way, new - grad
        v, small = v + s, value - near < 1e-4 * abs(value)
        value, grad = near, new
        if s @ y > 1e-12:
            past = [*past, (s, y)][-MEMORY:]
        if small:
            break
    return v


def platt(margins: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and bias that make margins of rows kept out of the fit into probabilities (Newton steps, smoothed labels)."""
    ones, zeros = weights[labels == 1].sum(), weights[labels == 0].sum()
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    scale = max(float(np.abs(margins).mean()), 1e-9)
    x = np.stack([margins / scale, np.ones(len(margins))], 1)
    theta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        grad = x.T @ (weights * (p - target)) + 1e-3 * theta
        hess = (x * (weights * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        theta = theta - np.clip(np.linalg.solve(hess, grad), -2, 2)
    return max(float(theta[0]), 1e-6) / scale, float(theta[1])


def train(docs: DataFrame, labels: DataFrame, allowed: Column, key: str = "doc_id", text: str = "text",
          label: str = "toxic") -> Model:
    """Fit on at most ROWS_PER_CLASS labelled rows per class for which `allowed` (an expression of the key) holds.

    Ratios: log of the smoothed share of rows of class 1 against class 0 that have an n-gram. Weights: logistic
    regression on presence times ratio, both classes weighing alike; one row in CALIBRATION then sets slope and bias.
    Labels other than 0 and 1, NULL keys and keys without a document are ignored; of repeated keys the largest label
    counts. Without rows of both classes the share of class 1 is all there is to learn (0 without any row).
    """
    spark = docs.sparkSession
    rows = (labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull() & allowed)
            .groupBy(F.col(key).alias("id")).agg(F.max(label).cast("int").alias("label")))
    rows = stored(rows, "labels")
    totals = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}  # two rows
    picked = None
    for value in (0, 1):
        some = rows.filter(F.col("label") == value).orderBy(F.xxhash64("id"), "id").limit(ROWS_PER_CLASS)
        picked = some if picked is None else picked.unionByName(some)
    picked = F.broadcast(picked)  # at most 2 * ROWS_PER_CLASS rows of two numbers

    found = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(picked, "id")
    # Class weights: alike in the fit; as often as in all labelled rows for the probabilities.
    found = stored(found.withColumn("test", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(CALIBRATION)) == 0)
                   .withColumn("weight", F.lit(1.0)).repartition(PARTS, "id"), "sample")
    counts = {(r["test"], r["label"]): r["count"] for r in found.groupBy("test", "label").count().collect()}  # four rows
    n = sum(totals.values())
    if not all(counts.get((test, value)) for test in (False, True) for value in (0, 1)):
        return Model(None, 0.0, 0.0, totals.get(1, 0) / (n + 1))

    def weighted(test: bool, total: dict[int, float]) -> DataFrame:
        share = F.when(F.col("label") == 1, total[1] / counts[test, 1]).otherwise(total[0] / counts[test, 0])
        return found.filter(F.col("test") == test).withColumn("weight", share).coalesce(PARTS)

    def features(place: np.ndarray | None = None):
        """To label, weight and n-grams of sampled rows, the n-grams renumbered if `place` is given."""
        def run(batches):
            last = np.zeros(1 << BITS, np.int32)
            for part in slices(batches, "text"):
                ids = list(grams(part.column("text"), last))
                if place is not None:
                    ids = [x[x >= 0] for x in (place[x] for x in ids)]
                yield pa.RecordBatch.from_arrays([part.column("label"), part.column("weight"),
                                                  pa.array([x.tobytes() for x in ids], pa.binary())], ["label", "weight", "ids"])
        return run

    def count(label, weight, ids, vector):
        vector[ids + (label << BITS)] += 1
        return np.array([label, 1 - label])

    fit = weighted(False, {0: 0.5, 1: 0.5})
    _, seen = sums_over(fit, count, 2 << BITS, features())
    clean, toxic = seen[:1 << BITS], seen[1 << BITS:]
    used = np.flatnonzero(clean + toxic >= LEAST_ROWS)
    place = np.full(1 << BITS, -1, np.int32)
    place[used] = np.arange(len(used))

    fit = stored(fit.mapInArrow(features(place), "label int, weight double, ids binary"), "features").coalesce(PARTS)
    clean, toxic = clean[used] + 1, toxic[used] + 1
    ratio = np.log(toxic / toxic.sum()) - np.log(clean / clean.sum())
    v = minimise(objective(fit, ratio), len(ratio) + 1)
    weights = np.zeros(1 << BITS, np.float32)
    weights[used] = v[:-1] * ratio

    prepared = features()

    def margin(batches):
        for batch in prepared(batches):
            z = [float(weights[np.frombuffer(ids, np.int32)].sum(dtype=np.float64)) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(z), batch.column("label"), batch.column("weight")], ["z", "label", "weight"])

    size = {value: (counts[True, 0] + counts[True, 1]) * totals[value] / n for value in (0, 1)}
    held = weighted(True, size).mapInArrow(margin, "z double, label int, weight double").toPandas()  # bounded as the sample
    slope, bias = platt(held["z"].to_numpy(), held["label"].to_numpy(), held["weight"].to_numpy())
    return Model(weights, slope, bias, 0.0)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of every row, over whole texts; NULL texts count as empty."""
    def run(batches):
        last = np.zeros(1 << BITS, np.int32)
        for part in slices(batches, "text", 1 << 20):
            values = [model.score(ids) for ids in grams(part.column("text"), last)]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(values, pa.float64())], ["id", "score"])
    kind = docs.schema[key].dataType.simpleString()
    return (docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
            .mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", key))
