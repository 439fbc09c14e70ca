"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.shared import components, forest, slices, stored

SHINGLE, RADIUS, SEED, PREFIX = 4, 4, 42, 16
#: Fingerprints whose variants are expanded together in memory.
CHUNK = 40_000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text: bit set if set in over half of the hashes of its word shingles; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        digests = xxhash.xxh64_digest(joined, SEED)
    else:
        size = np.fromiter(map(len, words), np.int64, len(words))
        start = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
        ends = (start + size)[shingle - 1:].tolist()
        digest = xxhash.xxh64_digest
        digests = b"".join([digest(joined[s:e], SEED) for s, e in zip(start.tolist(), ends)])
    bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1)
    counts = np.add.reduce(bits, axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * counts > len(bits)).tobytes(), "big")


def masks(width: int, most: int, shift: int = 0) -> list[np.ndarray]:
    """All masks over `width` bits from bit `shift` on, by the number of set bits from 0 to `most`."""
    return [np.array([sum(1 << (shift + i) for i in bits) for bits in combinations(range(width), k)], np.uint64)
            for k in range(most + 1)]


def spread(prefix: int, half: int):
    """Send each fingerprint to the prefixes of all its variants: 1 + 16 + 120 rows stand for its 2,081 variants."""
    flips = np.concatenate(masks(prefix, half, 64 - prefix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(whole), 4096):
                fp = whole[at:at + 4096]
                bucket = ((fp[:, None] ^ flips) >> np.uint64(64 - prefix)).astype(np.int32).ravel()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket), pa.array(np.repeat(fp, len(flips)).view(np.int64))], ["bucket", "fp"])
    return run


def meet(prefix: int, half: int, radius: int):
    """Expand the variants inside each bucket, link fingerprints that share one, keep a spanning forest of the links."""
    low = 64 - prefix
    by_flips = masks(low, half)
    near = [np.concatenate(by_flips[:k + 1]) for k in range(half + 1)]
    keep_low = np.uint64((1 << low) - 1)

    def links(bucket: np.ndarray, fp: np.ndarray):
        head = bucket.astype(np.uint64) << np.uint64(low)
        used = np.bitwise_count((fp ^ head) >> np.uint64(low))
        center = head | (fp & keep_low)
        variants, owners = [], []
        for spent in range(half + 1):
            at = np.flatnonzero(used == spent)
            mask = near[half - spent]
            variants.append((center[at][:, None] ^ mask).ravel())
            owners.append(np.repeat(at, len(mask)))
        variant, owner = np.concatenate(variants), np.concatenate(owners)
        order = np.argsort(variant)
        variant, owner = variant[order], owner[order]
        same = np.flatnonzero(variant[1:] == variant[:-1])
        a, b = fp[owner[same]], fp[owner[same + 1]]
        sure = (np.bitwise_count(a ^ b) <= radius) & (a != b)
        if not sure.any():
            return None
        pairs = np.unique(np.stack([a[sure], b[sure]]).view(np.int64), axis=1)
        members, roots = forest(pairs[0], pairs[1])
        return pa.RecordBatch.from_arrays([pa.array(members), pa.array(roots)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append((batch.column("bucket").to_numpy(), batch.column("fp").to_numpy().view(np.uint64)))
            rows += batch.num_rows
            if rows < CHUNK:
                continue
            bucket, fp = (np.concatenate(x) for x in zip(*held))
            whole = np.searchsorted(bucket, bucket[-1])  # the last bucket may go on
            at = 0
            while at < whole:
                end = min(at + CHUNK, whole)
                end = np.searchsorted(bucket, bucket[end - 1], "right") if end < whole else whole
                if (out := links(bucket[at:end], fp[at:end])) is not None:
                    yield out
                at = end
            held, rows = [(bucket[whole:], fp[whole:])], len(bucket) - whole
        if rows:
            bucket, fp = (np.concatenate(x) for x in zip(*held))
            at = 0
            while at < len(bucket):
                end = np.searchsorted(bucket, bucket[min(at + CHUNK, len(bucket)) - 1], "right")
                if (out := links(bucket[at:end], fp[at:end])) is not None:
                    yield out
                at = end
    return run


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp) of every row; NULL texts count as empty."""
    def run(batches):
        for part in slices(batches, "text"):
            values = [fingerprint(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(np.array(values, np.uint64).view(np.int64))], ["id", "fp"])
    kind = docs.schema[key].dataType.simpleString()
    return (docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
            .mapInArrow(run, f"id {kind}, fp long"))


def ball_links(prints: DataFrame, radius: int = RADIUS, prefix: int = PREFIX) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints `fp` at most `radius` bits apart.

    Two fingerprints within the radius have a common variant within half of it from both. All variants of a
    fingerprint that agree in their first `prefix` bits meet in the same bucket, so a fingerprint is shuffled once per
    prefix and its variants are expanded behind the shuffle. Equal variants prove a distance within the radius, hence
    a run of equal variants is linked as a chain, never as all pairs, and each chunk returns a spanning forest.
    """
    half = radius // 2
    assert radius == 2 * half, "an odd radius has no middle"
    return (prints.select("fp").distinct().mapInArrow(spread(prefix, half), "bucket int, fp long")
            .repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(meet(prefix, half, radius), "a long, b long"))


def simhash_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row per document: key, fingerprint (16 hex digits), component_id (smallest key reachable by links).

    Fingerprints link at `radius` or fewer differing bits. Copies share a fingerprint and are never paired. NULL and
    empty texts have fingerprint zero and link like any other. NULL keys stay as rows and are no component's id, unless
    all its keys are NULL. Repeated rows repeat. An empty table gives no rows. Other columns are not read.
    """
    prints = stored(fingerprints(docs, key, text), "prints")
    firsts = prints.groupBy("fp").agg(F.min("id").alias("first"))
    roots = components(ball_links(prints, radius)).select(F.col("id").alias("fp"), "root")
    firsts = firsts.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    firsts = stored(firsts, "firsts")
    least = firsts.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = stored(firsts.join(least, "root").select("fp", "component_id"), "classes")
    return prints.join(classes, "fp").select(
        F.col("id").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """Keep one document of each group: the one whose key is the component's id, with all its columns.

    Documents without words are one group like any other. Rows that repeat the key that stays all stay, and so do rows
    with a NULL key, which nothing could tell apart.
    """
    groups = simhash_groups(docs, key, text, radius)
    lost = groups.filter(F.col(key) != F.col("component_id")).select(key)
    return docs.join(lost.distinct(), key, "left_anti").select(docs.columns)
