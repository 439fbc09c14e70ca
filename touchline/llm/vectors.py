"""Embedding near-duplicates by spherical-cap filters whose directions form a random product code."""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.shared import components, small_side, stored

THRESHOLD = 0.95
#: Filters that a vector passes on average, and at least; recall in the tests and the README is measured with these.
LIST_SIZE, LEAST_LIST = 16, 4
#: Vectors per filter aimed at: the number of filters grows with the table.
PER_FILTER = 256
#: Filters with more vectors are compared chunk against chunk, each pair of chunks in a task group of its own.
CHUNK = 1_024
SEED = 11


def code_words(vectors: int) -> tuple[int, int]:
    """Blocks and words per block of the product code for so many vectors."""
    filters = max(64, vectors * LIST_SIZE // PER_FILTER)
    blocks = 2 if filters <= 1 << 20 else 3
    return blocks, max(2, round(filters ** (1 / blocks)))


def product_code(dim: int, blocks: int, words: int) -> tuple[np.ndarray, list[np.ndarray], float]:
    """A random rotation, unit code words for each block of coordinates, and the height of the caps."""
    rng = np.random.default_rng([SEED, dim, blocks, words])
    blocks = min(blocks, dim)
    rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    parts = [rng.standard_normal((words, len(x))) for x in np.array_split(np.arange(dim), blocks)]
    parts = [p / np.linalg.norm(p, axis=1, keepdims=True) / blocks ** 0.5 for p in parts]
    share = min(0.5, LIST_SIZE / words ** blocks)
    if dim >= 32:
        return rotation, parts, NormalDist().inv_cdf(1 - share) / dim ** 0.5
    v = rng.standard_normal((256, dim))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    direction = np.concatenate([p[rng.integers(0, words, 4096)] for p in parts], axis=1)
    return rotation, parts, float(np.quantile(v @ direction.T, 1 - share))


def list_decode(unit: np.ndarray, code: tuple) -> Iterator[np.ndarray]:
    """For each unit vector the sorted numbers of all directions that it exceeds the cap height with.

    Block by block, a partial choice of words is given up when even the best words of the later blocks leave it below
    the height. Vectors with too short a list get lower caps, nine tenths as high each time.
    """
    rotation, parts, height = code
    words = len(parts[0])
    turned = unit @ rotation
    ends = np.cumsum([0, *(p.shape[1] for p in parts)])
    scores = [turned[:, a:b] @ p.T for a, b, p in zip(ends[:-1], ends[1:], parts)]
    best = [s.max(axis=1) for s in scores]
    rest = [sum(best[k + 1:], np.zeros(len(unit))) for k in range(len(parts))]
    for i in range(len(unit)):
        least = height
        while True:
            number, total = np.zeros(1, np.int64), np.zeros(1)
            for k in range(len(parts)):
                sums = total[:, None] + scores[k][i]
                at, word = np.nonzero(sums >= least - rest[k][i])
                number, total = number[at] * words + word, sums[at, word]
            if len(number) >= min(LEAST_LIST, words ** len(parts)):
                break
            least = least * 0.9 - 0.01
        yield np.sort(number)


def decoded(blocks: int, words: int, payload: bool):
    """Rows per vector and filter: filter alone, or with everything that the comparison needs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[int, tuple] = {}
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                ids, copies = batch.column("id").to_numpy(), batch.column("copies").to_numpy()
                by_dim: dict[int, list[int]] = {}
                for i, n in enumerate(batch.column("v").value_lengths().to_pylist()):
                    by_dim.setdefault(n, []).append(i)
                for dim, rows in by_dim.items():
                    raw = np.array(batch.column("v").take(pa.array(rows)).flatten().to_numpy(), np.float64).reshape(-1, dim)
                    unit = raw / np.linalg.norm(raw, axis=1, keepdims=True)
                    if dim not in codes:
                        codes[dim] = product_code(dim, blocks, words)
                    lists = list(list_decode(unit, codes[dim]))
                    size = [len(x) for x in lists]
                    flat = np.concatenate(lists)
                    out = {"dim": pa.array(np.full(len(flat), dim)), "filter": pa.array(flat)}
                    if payload:
                        at = np.repeat(rows, size)
                        out |= {"id": pa.array(ids[at]), "copies": pa.array(copies[at]),
                                "unit": pa.array([u.tobytes() for u, n in zip(unit, size) for _ in range(n)], pa.binary()),
                                "filters": pa.array([x.tobytes() for x in lists for _ in range(len(x))], pa.binary())}
                    yield pa.RecordBatch.from_pydict(out)
    return run, "dim long, filter long" + ", id long, copies long, unit binary, filters binary" * payload


def compare(threshold: float):
    """Groups of rows (dim, filter, i, j) in order: verified links of each vector, each pair counted once, and a forest.

    A pair that shares several filters is counted in the smallest of them only, which the rows tell by their lists.
    """
    def block(rows: pa.Table):
        filter_, i, j = (rows.column(c)[0].as_py() for c in ("filter", "i", "j"))
        ids, copies, chunk = (rows.column(c).to_numpy() for c in ("id", "copies", "chunk"))
        unit = np.frombuffer(b"".join(rows.column("unit").to_pylist())).reshape(len(ids), -1)
        close = unit @ unit.T >= threshold
        np.fill_diagonal(close, False)
        if i != j:
            close &= chunk[:, None] != chunk
        used = np.flatnonzero(close.any(axis=1))
        if not len(used):
            return None
        close, ids, copies = close[np.ix_(used, used)], ids[used], copies[used]
        lists = rows.column("filters").to_pylist()
        lists = [(x := np.frombuffer(lists[k], np.int64))[x < filter_] for k in used]
        names, code, often = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
        member = np.zeros((len(used), len(names)), np.float32)
        member[np.repeat(np.arange(len(used)), [len(x) for x in lists]), code] = 1
        member = member[:, often > 1]
        new = close & ~(member @ member.T > 0.5)
        links = new @ copies
        order = np.argsort(ids)
        label = np.empty(len(ids), np.int64)
        label[order] = np.arange(len(ids))
        while True:
            low = np.minimum(label, np.where(close, label, len(ids)).min(axis=1))
            low = np.minimum(low, low[order[low]])
            if (low == label).all():
                break
            label = low
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links.astype(np.int64)), pa.array(ids[order[label]])], ["id", "links", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        keys = None
        for batch in batches:
            cols = np.stack([batch.column(c).to_numpy() for c in ("dim", "filter", "i", "j")], 1)
            cuts = [0, *(np.flatnonzero((cols[1:] != cols[:-1]).any(axis=1)) + 1).tolist(), len(cols)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                own = tuple(cols[a])
                if own != keys and held:
                    if (out := block(pa.Table.from_batches(held).combine_chunks())) is not None:
                        yield out
                    held = []
                keys = own
                held.append(batch.slice(a, b - a))
        if held and (out := block(pa.Table.from_batches(held).combine_chunks())) is not None:
            yield out
    return run


def near_vectors(table: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """One row per vector: key, n_links, component_id, kept.

    Vectors link if their cosine in double precision is at least `threshold`; every link found is verified, and the
    share found depends on the caps (see the README). Equal vectors are compared once and always linked. Vectors that
    are NULL, zero or hold NULL or non-finite components link with nothing, nor do vectors of different lengths or rows
    with a NULL key; they are components of their own. Rows that repeat a key are vectors of their own in the counts.
    An empty table gives no rows. Other columns are not read.

    `n_links` is the number of other vectors linked directly. No pair is written: comparisons return counts and a
    spanning forest per group, and crowded filters are split into pairs of chunks.
    """
    spark = table.sparkSession
    rows = table.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("v", lambda x: x != 0)
    # Adding zero makes -0.0 equal to 0.0.
    rows = rows.withColumn("v", F.when(F.col("id").isNotNull() & ~odd & some, F.transform("v", lambda x: x + F.lit(0.0))))
    rows = rows.withColumn("h", F.when(F.col("v").isNotNull(), F.xxhash64("v"))).withColumn("g", F.hash("v", F.size("v")))
    classes = rows.filter("v IS NOT NULL").groupBy("h", "g").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
    classes = stored(classes, "classes")
    n = classes.count()
    blocks, words = code_words(n)
    firsts = rows.select("id", "v", "h", "g").join(classes.select("id", "h", "g", "copies"), ["id", "h", "g"]).dropDuplicates(["id", "h", "g"])
    firsts = stored(firsts.select("id", "copies", "v"), "firsts")
    spread = firsts.repartition("id") if n > CHUNK else firsts
    crowded = stored(spread.mapInArrow(*decoded(blocks, words, False)).groupBy("dim", "filter").count()
                     .filter(F.col("count") > CHUNK).select("dim", "filter", F.ceil(F.col("count") / CHUNK).cast("int").alias("k")), "crowded")
    held = spread.mapInArrow(*decoded(blocks, words, True)).join(small_side(crowded, crowded.count()), ["dim", "filter"], "left")
    k = F.coalesce("k", F.lit(1))
    held = held.withColumn("chunk", F.pmod(F.xxhash64("id"), k).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), k - 1))).drop("k")
    held = held.select("*", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j")).drop("other")
    where = ["dim", "filter", "i", "j"]
    found = stored(held.repartition(*where).sortWithinPartitions(*where)
                   .mapInArrow(compare(threshold), "id long, links long, root long"), "links")
    roots = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    classes = (classes.join(links, "id", "left").join(roots, "id", "left")
               .select("h", "g", F.coalesce("root", "id").alias("component_id"),
                       (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    out = rows.select("id", "h", "g").join(classes, ["h", "g"], "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
