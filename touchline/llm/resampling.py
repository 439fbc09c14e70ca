"""Importance resampling towards a target: documents that look like the target table are drawn more often.

Words come from Arrow kernels (`ascii_lower`, `split_pattern_regex`, `list_flatten`, `dictionary_encode`), features are
runs of one to three words made by shifting the dictionary indices, and the crc32 of a feature is put together once per
distinct pair of a shorter feature and a word. A bucket's gain is the log ratio of its shares in both tables.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.shared import slices, stored
from touchline.operators.skew import MAX_GROUP_ROWS, number_hot_rows

BUCKETS = 10_000
LONGEST = 3
#: Documents with fewer words are never drawn.
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
# What is no word is ASCII without letters and digits (text is in small letters by then); the crc32 polynomial.
APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
POLYNOMIAL = 0xEDB88320


def _byte_steps() -> np.ndarray:
    """crc32 of each byte value, the register's step over a zero byte."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> np.uint32(1)) ^ np.uint32(POLYNOMIAL), step >> np.uint32(1))
    return step


def shift_tables(bits: int) -> list[np.ndarray]:
    """Per bit k, four tables of 256 that push a crc32 over 2^k zero bytes (the step is linear over its bits)."""
    step, values = _byte_steps(), np.arange(256, dtype=np.uint32)
    table = np.stack([(crc >> np.uint32(8)) ^ step[crc & 255] for crc in (values << np.uint32(8 * byte) for byte in range(4))])
    out = [table]
    while len(out) < bits:
        out.append(np.stack([_push(out[-1], out[-1][byte]) for byte in range(4)]))
    return out


def _push(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0][crc & 255] ^ table[1][crc >> 8 & 255] ^ table[2][crc >> 16 & 255] ^ table[3][crc >> 24]


def joined_crc(left: np.ndarray, right: np.ndarray, length: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    """crc32 of two byte strings put together, from their crc32 and the second one's length."""
    crc = left.copy()
    for bit in range(int(length.max(initial=0)).bit_length()):
        if bit == len(tables):
            tables.append(np.stack([_push(tables[-1], tables[-1][byte]) for byte in range(4)]))
        moved = np.flatnonzero(length >> bit & 1)
        crc[moved] = _push(tables[bit], crc[moved])
    return crc ^ right


def features(texts: pa.Array, tables: list[np.ndarray]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Words per text and, for each length, (bucket per distinct feature, feature per occurrence, text per occurrence)."""
    rows = pc.split_pattern_regex(pc.ascii_lower(texts), pattern=APART)
    words, text = pc.list_flatten(rows), pc.list_parent_indices(rows)
    real = pc.greater(pc.binary_length(words), 0)
    coded = words.filter(real).dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    text = text.filter(real).to_numpy(zero_copy_only=False)
    spelled = [w.encode("utf-8", "surrogatepass") for w in coded.dictionary.to_pylist()]
    crc = np.array([zlib.crc32(w) for w in spelled], np.uint32)
    tail = np.array([zlib.crc32(b" " + w) for w in spelled], np.uint32)
    length = np.array([len(w) + 1 for w in spelled], np.int64)
    counts, out, run = np.bincount(text, minlength=len(texts)), [(crc % BUCKETS, index, text)], index
    for n in range(1, LONGEST):
        whole = text[:-n] == text[n:] if len(text) > n else np.zeros(0, bool)
        pairs = pa.array(run[:len(whole)] * len(spelled) + index[n:n + len(whole)]).dictionary_encode()
        pair = pairs.dictionary.to_numpy()
        crc = joined_crc(crc[pair // max(1, len(spelled))], tail[pair % max(1, len(spelled))],
                         length[pair % max(1, len(spelled))], tables)
        run = pairs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        out.append((crc % BUCKETS, run[whole], text[:len(whole)][whole]))
    return counts, out


def _counted(text_column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, tables = np.zeros(BUCKETS, np.int64), shift_tables(6)
        for batch in slices(batches, text_column):
            for bucket, feature, _ in features(batch.column(text_column), tables)[1]:
                total += np.bincount(bucket[feature], minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": used.astype(np.int32), "n": total[used]})
    return run


def bucket_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(bucket, n): features of all texts by bucket; a task sends at most one row per bucket."""
    rows = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(_counted("text"), "bucket int, n long")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, text: str = "text", target_text: str = "text") -> DataFrame:
    """(bucket, gain) of every bucket: the floor of 1000 times the log ratio of target and source, one added to each."""
    s, t = bucket_counts(docs, text), bucket_counts(target, target_text)
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    both = (every.join(s.withColumnRenamed("n", "s"), "bucket", "left").join(t.withColumnRenamed("n", "t"), "bucket", "left")
                 .fillna(0, ["s", "t"]))
    both = stored(both, "bucket-counts")
    all_s, all_t = both.agg(F.sum("s"), F.sum("t")).first()
    more = lambda c: (F.col(c) + 1).cast("double")
    ratio = more("t") * F.lit(float(all_s + BUCKETS)) / (more("s") * F.lit(float(all_t + BUCKETS)))
    return both.select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain"))


def _weighed(gain: np.ndarray, keep: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shift_tables(6)
        for batch in slices(batches, "_text"):
            counts, lengths = features(batch.column("_text"), tables)
            n_features, weight = np.zeros(len(counts), np.int64), np.zeros(len(counts), np.int64)
            for bucket, feature, text in lengths:
                sums = np.concatenate([[0], np.cumsum(gain.take(bucket).take(feature))])
                border = np.searchsorted(text, np.arange(len(counts) + 1))
                weight += sums[border[1:]] - sums[border[:-1]]
                n_features += np.diff(border)
            columns = [*batch.columns[:keep], *(pa.array(a.astype(np.int64)) for a in (counts, n_features, weight))]
            yield pa.RecordBatch.from_arrays(columns, names=[f"_{i}" for i in range(len(columns))])
    return run


def weigh(docs: DataFrame, gains: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The `keep` columns of every document, its words, features and the sum of their gains; other columns are left out.

    The gains are one number per bucket, a table of fixed size that goes to the tasks.
    """
    gain = np.zeros(BUCKETS, np.int64)
    for row in gains.collect():
        gain[row["bucket"]] = row["gain"]
    held = docs.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(keep)], F.col(text).cast("string").alias("_text"))
    names = [*keep, "n_words", "n_features", "weight"]
    fields = [(f"_{i}", held.schema[f"_{i}"].dataType.simpleString()) for i in range(len(keep))]
    fields += [(f"_{len(keep) + i}", "bigint") for i in range(3)]
    schema = ", ".join(f"{n} {t}" for n, t in fields)
    return held.mapInArrow(_weighed(gain, len(keep)), schema).toDF(*names)


def noise(doc_id: str = "doc_id", seed: int = SEED) -> Column:
    """A Gumbel number of each id in thousandths, from the first 32 bits of a sha256; a NULL id counts as no text."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
             percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED, keep: Sequence[str] = ()) -> DataFrame:
    """Every document with its weight, its score and its rank in the draw (NULL: not drawn).

    The score is the weight plus Gumbel noise, so that taking the highest scores draws documents without replacement in
    proportion to their importance. `percent` of the documents with at least `least_words` words are drawn; ties go to the
    smaller id, then to the content of the rows. Ranks come from sorted slices and their lengths, never from one task.

    NULL and empty texts have no words, weight 0 and no rank; rows with one id are ranked one by one; a NULL id comes
    before others in ties; an empty table gives no rows, an empty target gains that only count the source. Columns other
    than the id, `keep` (for example the text) and the new ones are left out, so their names cannot clash.
    """
    gains = bucket_gains(docs, target, text, target_text)
    scored = weigh(docs, gains, text, [doc_id, *keep]).withColumn("score", F.col("weight") + noise(doc_id, seed))
    scored = stored(scored, "weights")
    long_enough = F.col("n_words") >= least_words
    n = scored.filter(long_enough).count()
    drawn = n * percent // 100
    order = [F.col("score").desc(), F.col(doc_id).asc_nulls_first()]
    ranked = number_hot_rows(scored.filter(long_enough), [], order, n, "rank", MAX_GROUP_ROWS)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return ranked.unionByName(scored.filter(~long_enough).withColumn("rank", F.lit(None).cast("long")))


def draw(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents themselves, with their text and rank."""
    return resample(docs, target, keep=["text"], **options).filter(F.col("rank").isNotNull())
