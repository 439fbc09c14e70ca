"""Periodic runs of words: stretches that repeat with some period, found by recompression.

The words of a batch of texts become one sequence of numbers. Two rounds take turns over it until no symbol comes twice:
equal neighbours become one block with a count, and pairs of a left and a right symbol become one symbol. The levels are a
run-length grammar in which equal stretches are cut alike but for a few symbols at their ends, so the longest common
extension of two places is read off by going up the levels while symbols agree and down again where they differ, with
exact comparisons and no hashes of texts. Every run of period p holds two equal words p apart at one of the places
0, g, 2g, ... with g = p (more for periods that are short beside the least length); such a harmonic grid has
n ln n places, of which those with different words drop out at once and the others are extended both ways.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.shared import slices

LEAST_LENGTH = 12
#: Grid places looked at together.
PLACES_AT_ONCE = 1 << 20
#: Sequences of at most so many symbols are tested for repeats after every round.
FEW_SYMBOLS = 4096
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


@dataclass
class Level:
    """Symbols of one level and how they are put together for the next: parent of each, first child and children of each parent."""
    symbols: np.ndarray
    parent: np.ndarray | None = None
    first: np.ndarray | None = None
    count: np.ndarray | None = None
    blocks: bool = False

    def rest(self, at: np.ndarray, parent: np.ndarray, step: int) -> np.ndarray:
        """Children of the parent from a place on in the given direction, itself included."""
        place = at - self.first[parent]
        return self.count[parent] - place if step > 0 else place + 1


class Grammar:
    """Levels of the recompression of a sequence; its first and last symbol may come nowhere else in it."""

    def __init__(self, sequence: np.ndarray):
        self.levels: list[Level] = []
        symbols, fresh, turn = sequence.astype(np.int64), int(sequence.max(initial=0)) + 1, 0
        while not (len(symbols) <= FEW_SYMBOLS and len(np.unique(symbols)) == len(symbols)):
            level = Level(symbols, blocks=turn % 2 == 0)
            head = np.ones(len(symbols), bool)
            if level.blocks:
                head[1:] = symbols[1:] != symbols[:-1]
            else:
                right = _side(symbols, turn)
                head[1:] = right[:-1] | ~right[1:]
            turn += 1
            if head.all():
                continue
            level.first = np.flatnonzero(head)
            level.count = np.diff(level.first, append=len(symbols))
            level.parent = np.cumsum(head) - 1
            many = np.flatnonzero(level.count > 1)
            base = symbols[level.first[many]]
            other = level.count[many] if level.blocks else symbols[level.first[many] + 1]
            names, code = np.unique(base * (int(other.max()) + 1) + other, return_inverse=True)
            symbols = symbols[level.first]
            symbols[many] = fresh + code
            fresh += len(names)
            self.levels.append(level)
        self.levels.append(Level(symbols))

    def extend(self, i: np.ndarray, j: np.ndarray, step: int) -> np.ndarray:
        """How many symbols agree from places i and j on (i other than j), forward (step 1) or backward (step -1)."""
        a, b, ids, differ = i.copy(), j.copy(), np.arange(len(i)), []
        for level in self.levels:
            same = level.symbols[a] == level.symbols[b]
            apart = [(ids[~same], a[~same], b[~same])]
            differ.append(apart)
            ids, a, b = ids[same], a[same], b[same]
            if not len(ids):
                break
            over, under = level.parent[a], level.parent[b]
            left, right = level.rest(a, over, step), level.rest(b, under, step)
            whole = (left == level.count[over]) & (right == level.count[under])
            move = step * np.where(whole, 0, np.minimum(left, right))
            a, b = a + move, b + move
            cut = ~whole & (left != right)
            apart.append((ids[cut], a[cut], b[cut]))
            ids, a, b = ids[~cut], level.parent[a[~cut]], level.parent[b[~cut]]
        out = np.zeros(len(i), np.int64)
        ids = a = b = np.zeros(0, np.int64)
        for level, apart in zip(reversed(self.levels[:len(differ)]), reversed(differ), strict=True):
            if len(ids):
                most = np.minimum(level.count[a], level.count[b]) if level.blocks else 1
                inside = (0, 0) if step > 0 else (level.count[a] - 1, level.count[b] - 1)
                a, b = level.first[a] + inside[0], level.first[b] + inside[1]
                move = step * np.where(level.symbols[a] == level.symbols[b], most, 0)
                a, b = a + move, b + move
            ids, a, b = (np.concatenate([own, *more]) for own, more in zip((ids, a, b), zip(*apart, strict=True), strict=True))
        out[ids] = np.abs(a - i[ids])
        return out


def _side(symbols: np.ndarray, turn: int) -> np.ndarray:
    """A coin per symbol and round: True for symbols that may only be the right half of a pair."""
    mixed = (symbols.astype(np.uint64) + np.uint64(turn) * np.uint64(0x9E3779B9)) * np.uint64(0xD6E8FEB86659FD93)
    mixed = (mixed ^ mixed >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(63)).astype(bool)


def grid(starts: np.ndarray, sizes: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) of the grids of all periods of some stretches, short periods first, so many at a time."""
    most = np.where(sizes >= least, sizes // 2, 0)
    owner = np.repeat(np.arange(len(sizes)), most)
    period = np.arange(len(owner)) - np.repeat(np.cumsum(most) - most, most) + 1
    order = np.argsort(period, kind="stable")
    owner, period = owner[order], period[order]
    gap = np.maximum(least - period, period)
    places = -(-(sizes[owner] - period) // gap)
    total = np.cumsum(places)
    begin = 0
    while begin < len(owner):
        end = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + PLACES_AT_ONCE, "right")))
        pair = np.repeat(np.arange(begin, end), places[begin:end])
        nth = np.arange(len(pair)) - np.repeat(total[begin:end] - places[begin:end] - (total[begin - 1] if begin else 0), places[begin:end])
        yield starts[owner[pair]] + nth * gap[pair], period[pair]
        begin = end


def sequence_runs(sequence: np.ndarray, starts: np.ndarray, sizes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, smallest period) of all runs in the given stretches of a sequence, in the order of start and period.

    Stretches must be kept apart, and the sequence closed, by symbols that come once. Places inside a known run whose
    period divides theirs would only give that run again and are passed over.
    """
    grammar = None
    found = np.zeros((0, 3), np.int64)
    reach, known = np.zeros(len(sequence), np.int64), np.ones(len(sequence), np.int64)
    for place, period in grid(starts, sizes, least):
        hit = sequence[place] == sequence[place + period]
        hit[hit] = (place[hit] + period[hit] >= reach[place[hit]]) | (period[hit] % known[place[hit]] != 0)
        place, period = place[hit], period[hit]
        if not len(place):
            continue
        grammar = grammar or Grammar(sequence)
        end = place + period + grammar.extend(place, place + period, 1)
        start = place - grammar.extend(place - 1, place + period - 1, -1)
        real = end - start >= np.maximum(least, 2 * period)
        rows = np.column_stack([start[real], end[real], period[real]])
        rows = np.unique(rows, axis=0)
        for s, e, p in rows.tolist():
            # The first period of an interval is its smallest one: shorter periods come first.
            if reach[s] != e or p % known[s]:
                reach[s:e], known[s:e] = e, p
        found = np.concatenate([found, rows])
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    fresh = np.ones(len(found), bool)
    fresh[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    found = found[fresh]
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    return found[:, 0], found[:, 1], found[:, 2]


def text_runs(texts: pa.Array, least: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Words, runs and the text without repeats of each text."""
    rows = pc.ascii_split_whitespace(texts)
    words, text = pc.list_flatten(rows), pc.list_parent_indices(rows)
    real = pc.greater(pc.binary_length(words), 0)
    words, text = words.filter(real), text.filter(real).to_numpy(zero_copy_only=False)
    coded = words.dictionary_encode()
    sizes = np.bincount(text, minlength=len(texts))
    firsts = np.cumsum(sizes) - sizes
    # One separator before every text and one at the end, each a number of its own.
    starts = firsts + np.arange(len(texts)) + 1
    sequence = np.empty(len(words) + len(texts) + 1, np.int64)
    apart = np.append(starts - 1, len(sequence) - 1)
    inside = np.ones(len(sequence), bool)
    inside[apart] = False
    sequence[inside] = coded.indices.to_numpy(zero_copy_only=False)
    sequence[apart] = len(coded.dictionary) + np.arange(len(apart))
    start, end, period = sequence_runs(sequence, starts, sizes, least)
    owner = np.searchsorted(starts, start, "right") - 1
    depth = np.zeros(len(sequence) + 1, np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, end, -1)
    kept = np.cumsum(depth[:-1])[inside] == 0
    borders = np.concatenate([[0], np.cumsum(np.bincount(text[kept], minlength=len(texts)))])
    left = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(borders, pa.int64()), words.filter(pa.array(kept))), " ")
    fields = pa.StructArray.from_arrays([pa.array(start - starts[owner]), pa.array(end - start), pa.array(period)],
                                        ["start", "length", "period"])
    borders = np.searchsorted(owner, np.arange(len(texts) + 1))
    return pa.array(sizes.astype(np.int64)), pa.ListArray.from_arrays(pa.array(borders, pa.int32()), fields), left


def _found(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            yield pa.RecordBatch.from_arrays([batch.column(0), *text_runs(batch.column(1), least)],
                                             names=["_id", "n_words", "runs", "collapsed"])
    return run


def find_runs(docs: DataFrame, doc_id: str = "doc_id", text: str | Column = "text", least: int = LEAST_LENGTH) -> DataFrame:
    """Per document its id, `n_words`, `runs` (start, length, period in words, by start, then period) and `collapsed`.

    Words are what ASCII white space separates. A run is a stretch of at least `least` words and two periods that keeps its
    smallest period and that no neighbouring word extends. `collapsed` is the text with its words joined by one space and
    without those that lie in a run after the run's first period.

    NULL and empty texts have no words, no runs and an empty `collapsed`; repeated rows and NULL ids are kept as they are;
    an empty table gives no rows. Columns other than the id and the text are not read, so their names cannot clash. A long
    text takes memory in proportion to its words (about 200 bytes each), its grid is worked through in parts.
    """
    if least < 2:
        raise ValueError("a run has two words at least")
    held = docs.select(F.col(doc_id).alias("_id"), (F.col(text) if isinstance(text, str) else text).cast("string").alias("_text"))
    kind = held.schema["_id"].dataType.simpleString()
    found = held.mapInArrow(_found(least), f"_id {kind}, n_words bigint, runs {RUNS}, collapsed string")
    return found.withColumnRenamed("_id", doc_id)


def repeated(text: Column, start: Column, period: Column) -> Column:
    """The words of a text, joined by one space, with all words from `start` on replaced by the first `period` of them again."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    rest = F.size(words) - start
    copies = F.flatten(F.array_repeat(F.slice(words, start + 1, period), F.ceil(rest / period).cast("int")))
    return F.array_join(F.concat(F.slice(words, F.lit(1), start), F.slice(copies, F.lit(1), rest)), " ")


def word_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), ""))
