"""Line deduplication by a deletion-neighbourhood join over the words of lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.shared import BROADCAST_ROWS, bounded_batches, slices, stored
from touchline.llm.wordhash import Words, mix, words_of

#: Lines of at least so many words may differ by one word (one edit in five: a similarity of 0.8); shorter ones must be equal.
LEAST_WORDS = 5
LAST = (1 << 63) - 1
#: Text whose words are hashed at once; the sums take some 40 bytes for each of its bytes.
TEXT_AT_ONCE = 1 << 20


def runs(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """First word of each line that has words, and the end of the last."""
    if not len(words.hash):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.flatnonzero((np.diff(words.text) != 0) | (np.diff(words.line) != 0)) + 1
    return np.concatenate([[0], new]), np.concatenate([new, [len(words.hash)]])


def finish(sums: np.ndarray, length: np.ndarray | int, kind: int) -> np.ndarray:
    """A signed key from a polynomial sum, its number of words and the kind of key."""
    return mix(sums + np.uint64(0x9E3779B97F4A7C15) * (np.atleast_1d(length).astype(np.uint64) * np.uint64(8) + np.uint64(kind))).view(np.int64)


def halves(words: Words, a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
    """Four keys of each line; lines one edit apart have one in common.

    Cut a line of n words in the middle. A substitution leaves one half of both lines alike, and a deletion leaves alike
    one half of the shorter line: the longer line has it as its first or last words.
    """
    n = b - a
    half, less = n // 2, (n - 1) // 2
    return [finish(words.poly(a, a + half), n, 1), finish(words.poly(a + half, b), n, 2),
            finish(words.poly(a, a + less), n - 1, 1), finish(words.poly(b - (n - 1 - less), b), n - 1, 2)]


def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each distinct line of each document with its first place: hash, words, document, line number, keys of its halves."""
    for part in slices(batches, "text", TEXT_AT_ONCE):
        words = words_of(part.column("text"))
        a, b = runs(words)
        if not len(a):
            continue
        text, n = words.text[a], b - a
        h = finish(words.poly(a, b), n, 0)
        _, kept = np.unique(np.stack([text, h]), axis=1, return_index=True)
        keys = halves(words, a, b)
        doc = part.column("id").fill_null(LAST).to_numpy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[kept]) for x in (h, n.astype(np.int32), doc[text], words.line[a].astype(np.int32), *keys)],
            ["h", "n", "doc", "line", "k0", "k1", "k2", "k3"])


def variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The chosen lines of each document: hash, words as 64-bit hashes, and the key of the line without each word."""
    for part in slices(batches, "text", TEXT_AT_ONCE):
        words = words_of(part.column("text"))
        a, b = runs(words)
        lines = [set(x) for x in part.column("lines").to_pylist()]
        wanted = np.array([k for k in range(len(a)) if words.line[a[k]] in lines[words.text[a[k]]]], np.int64)
        out = {"h": [], "n": [], "words": [], "keys": []}
        for k in wanted.tolist():
            start, end = int(a[k]), int(b[k])
            p = np.arange(start, end)
            left = words.poly(np.full(len(p), start), p)
            # The words behind the gap move up by one place: they continue where those before it end.
            right = (words.sums[end] - words.sums[p + 1]) * words.inverse[start + 1]
            n = end - start
            out["h"].append(int(finish(words.poly(np.array([start]), np.array([end])), n, 0)[0]))
            out["n"].append(n)
            out["words"].append(words.hash[start:end].tobytes())
            out["keys"].append(finish(left + right, n - 1, 0))
        if out["h"]:
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["h"], pa.int64()), pa.array(out["n"], pa.int32()), pa.array(out["words"], pa.binary()),
                 pa.array(out["keys"], pa.list_(pa.int64()))], ["h", "n", "words", "keys"])


def within_one(a: bytes, b: bytes) -> bool:
    """Whether two sequences of 64-bit words are at most one edit apart."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if len(x) < len(y):
        x, y = y, x
    if len(x) - len(y) > 1:
        return False
    same = x[:len(y)] == y
    start = len(y) if same.all() else int(np.argmin(same))
    return bool((x[start + 1:] == y[start + (len(x) == len(y)):]).all())


def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sure = [within_one(x, y) for x, y in zip(batch.column("words").to_pylist(), batch.column("other_words").to_pylist())]
        yield batch.filter(pa.array(sure, pa.bool_())).select(["h"])


def few(table: DataFrame, rows: int | None = None) -> DataFrame:
    """A stored table, broadcast if it has few rows (counted), else built into hash tables of a shuffle join."""
    rows = table.count() if rows is None else rows
    return F.broadcast(table) if rows <= BROADCAST_ROWS else table.hint("shuffle_hash")


def near_earlier(classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Hashes `h` of the distinct lines that are one edit from an earlier one.

    Lines that share half of their words (or are one word longer than such a half's line) send the keys of all their
    variants; every key keeps its earliest line, and every line its earliest partner: no pairs are formed within a key.
    Substitutions meet at the same key and gap, deletions where a variant of one line is the other line.
    """
    tagged = (classes.filter(F.col("n") >= LEAST_WORDS - 1)
              .select("h", F.explode(F.array("k0", "k1", "k2", "k3")).alias("key")))
    shared = tagged.groupBy("key").agg(F.min("h").alias("low"), F.max("h").alias("high")).filter("low <> high").select("key")
    shared = stored(shared, "shared")
    chosen = tagged.join(few(shared), "key", "left_semi").select("h").distinct()
    chosen = stored(chosen.join(classes.select("h", "doc", "line"), "h"), "chosen")
    n_chosen = chosen.count()
    chosen = few(chosen, n_chosen)
    by_doc = chosen.groupBy("doc").agg(F.collect_list("line").alias("lines"))
    found = (docs.join(few(stored(by_doc, "places"), n_chosen), F.coalesce(docs["id"], F.lit(LAST)) == F.col("doc")).select("text", "lines")
             .mapInArrow(variants, "h long, n int, words binary, keys array<long>"))
    found = stored(found.join(chosen, "h").select("h", "n", "words", "keys", F.struct("doc", "line", "h").alias("own")), "variants")
    gaps = found.filter(F.col("n") >= LEAST_WORDS).select("own", F.posexplode("keys").alias("gap", "key"))
    # Lines of one length that differ in the word at the gap: each is near the earliest of them.
    first = gaps.groupBy("key", "gap").agg(F.min("own").alias("first"), F.max("own").alias("last")).filter("first < last")
    first = few(stored(first.select("key", "gap", "first"), "first"))
    alike = gaps.join(first, ["key", "gap"]).filter("first < own").select("own", F.col("first").alias("other"))
    # Lines that are another one without a word: the later of both is near the other.
    whole = few(found.select(F.col("h").alias("key"), F.col("own").alias("whole")), n_chosen)
    longer = stored(gaps.join(whole, "key").select("own", "whole"), "longer")
    best = (alike.unionByName(longer.select(F.greatest("own", "whole").alias("own"), F.least("own", "whole").alias("other")))
            .groupBy(F.col("own.h").alias("h")).agg(F.min("other").alias("other")).select("h", F.col("other.h").alias("other")))
    best = few(stored(best, "best"))
    texts = found.select("h", "words")
    pairs = texts.join(best, "h")
    pairs = texts.select(F.col("h").alias("other"), F.col("words").alias("other_words")).join(pairs.hint("shuffle_hash"), "other")
    return pairs.select("h", "words", "other_words").mapInArrow(verified, "h long").distinct()


def lines_to_drop(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with lines that an earlier document has: key (LAST for NULL) as `doc`, hashes as `lost`."""
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    seen = stored(rows.mapInArrow(occurrences, "h long, n int, doc long, line int, k0 long, k1 long, k2 long, k3 long"), "lines")
    first = F.min(F.struct("doc", "line")).alias("first")
    classes = seen.groupBy("h").agg(first, *[F.min(c).alias(c) for c in ("n", "k0", "k1", "k2", "k3")])
    classes = stored(classes.select("h", "n", "first.doc", "first.line", "k0", "k1", "k2", "k3"), "classes")
    near = near_earlier(classes, rows).withColumn("near", F.lit(True))
    marks = stored(classes.select("h", F.col("doc").alias("first_doc")).join(near, "h", "left"), "marks")
    lost = seen.select("h", "doc").join(marks, "h").filter(F.col("near") | (F.col("doc") != F.col("first_doc")))
    return lost.groupBy("doc").agg(F.collect_set("h").alias("lost"))


def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Take the lost lines out of each text, and repeats of a line inside it."""
    for part in slices(batches, "text", TEXT_AT_ONCE):
        words = words_of(part.column("text"))
        a, b = runs(words)
        h = finish(words.poly(a, b), b - a, 0).tolist()
        lost, texts = part.column("lost").to_pylist(), part.column("text").to_pylist()
        gone: dict[int, set[int]] = {}
        seen: set[tuple[int, int]] = set()
        for k, t, line in zip(h, words.text[a].tolist(), words.line[a].tolist()):
            again = (t, k) in seen
            seen.add((t, k))
            if again or lost[t] and k in lost[t]:
                gone.setdefault(t, set()).add(line)
        for t, numbers in gone.items():
            texts[t] = "\n".join([x for i, x in enumerate(texts[t].split("\n")) if i not in numbers])
        yield part.drop_columns(["text", "lost"]).append_column("text", pa.array(texts, pa.string())).append_column(
            "n_lost", pa.array([len(gone.get(t, ())) for t in range(len(texts))], pa.int32()))


def drop_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns of `docs` with the lines that came before taken out of `text`, and `n_lost` of each row.

    Lines are compared by their words (what white space separates, capitals A-Z as small letters). Of equal lines the
    earliest stays, by key and place, and a line that is one edit of a word from an earlier line goes as well if the
    longer of both has LEAST_WORDS words. Being near is judged against all earlier lines, also those that go themselves.
    Lines without words stay. Documents that lose all lines stay with an empty text. NULL texts stay NULL. NULL keys
    come last and count as one document. Rows that repeat a key and text are one document: they lose the same lines.
    An empty table gives no rows. Columns named like helpers ("id", "lost" and so on) are not touched.
    """
    bounded_batches(docs.sparkSession)
    lost = lines_to_drop(docs, key, text)
    packed = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("row"))
    joined = packed.join(lost.hint("shuffle_hash"), F.coalesce("id", F.lit(LAST)) == F.col("doc"), "left").select("row", "text", "lost")
    kind = joined.schema["row"].dataType.simpleString()
    out = joined.mapInArrow(cut, f"row {kind}, text string, n_lost int")
    return out.select(*[F.col("text").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns], "n_lost")
