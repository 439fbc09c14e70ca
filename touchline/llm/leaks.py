"""Benchmark decontamination by latent semantic retrieval and checks of the common subsequence and the answer."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.shared import slices, stored
from touchline.llm.wordhash import words_of

#: Terms are hashed into so many buckets; the latent space has RANK directions, found with OVERSAMPLE more.
TERM_BITS, RANK, OVERSAMPLE = 15, 128, 32
#: Documents are cut into blocks of so many words; windows are 1, 2 or 4 of them, one block apart.
BLOCK, WINDOWS = 8, (1, 2, 4)
#: Cosine from which a window is compared with a passage word by word.
COSINE = 0.6
#: A window whose part in the latent space is shorter than this share of the passage's has too few of its words.
LEAST_SHARE = 0.3
#: Windows the latent space does not find are compared, too, if they have this part of the words a leak needs at least,
#: counted over the rarest words of the item, of which every leak has so many.
RARE_PART = 1 / 4
#: Share of an item's words, in order, that a leak has: alone, or together with the whole answer.
LEAK, PARAPHRASE, ANSWER = 0.8, 0.6, 0.9
#: Passages searched for at once; more are searched in further passes over the documents.
PASSAGES_AT_ONCE = 20_000
SEED = 7


def buckets(column: pa.Array):
    """Words of texts, and the term bucket of each."""
    words = words_of(column, letters_only=True)
    return words, (words.hash >> np.uint64(64 - TERM_BITS)).astype(np.int64)


def add_up(rows: DataFrame, run, size: int) -> np.ndarray:
    """Sum of the vectors of `size` doubles that `run` makes of each partition, added block by block in Spark."""
    step = 1 << 16

    def parts(batches):
        total = np.zeros(size)
        for batch in batches:
            run(batch, total)
        for at in range(0, size, step):
            yield pa.RecordBatch.from_pydict({"at": [at], "v": [total[at:at + step].tobytes()]})

    def together(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v) for v in table.column("v").to_pylist())
        return pa.table({"at": [table.column("at")[0].as_py()], "v": [total.tobytes()]})

    few = rows.sparkSession.conf.get("spark.sql.shuffle.partitions")
    partial = rows.mapInArrow(parts, "at long, v binary")
    if rows.rdd.getNumPartitions() > 4 * int(few):  # add up in two steps, so that no task gathers all parts
        partial = (partial.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(64))).groupBy("part", "at")
                   .applyInArrow(together, "at long, v binary"))
    out = np.zeros(size)
    # A vector whose size does not depend on the rows; as Arrow it is held once less on its way than as rows.
    for batch in partial.groupBy("at").applyInArrow(together, "at long, v binary").toArrow().to_batches():
        for at, v in zip(batch.column("at").to_pylist(), batch.column("v")):
            out[at:at + step] = np.frombuffer(v.as_buffer())
    return out


def document_frequency(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents the terms of each bucket occur, and how many documents have words; all are counted."""
    size = 1 << TERM_BITS

    def run(batch, total):
        for part in slices(iter([batch]), "text"):
            words, term = buckets(part.column("text"))
            # One number per document and bucket; sorting is cheaper here than a set per document.
            own = np.sort(words.text.astype(np.int64) << TERM_BITS | term)
            own = own[np.diff(own, prepend=-1) != 0]
            total[:size] += np.bincount(own & (size - 1), minlength=size)
            total[size] += np.count_nonzero(np.diff(words.text, prepend=-1))

    counts = add_up(docs.select("text"), run, size + 1)
    return counts[:-1], int(counts[-1])


@dataclass
class Latent:
    """Weights of all terms, the projection of weighted terms to the latent space, and the terms of its rows (None: all)."""
    idf: np.ndarray
    projection: np.ndarray
    terms: np.ndarray | None = None


def weighted(words, term: np.ndarray, idf: np.ndarray, texts: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Terms and TF-IDF weights of each text, of length one."""
    cuts = np.searchsorted(words.text, np.arange(texts + 1))
    for a, b in zip(cuts[:-1], cuts[1:]):
        ids, n = np.unique(term[a:b], return_counts=True)
        w = n * idf[ids]
        size = np.linalg.norm(w)
        yield ids, w / size if size else w


def row_blocks(rows: int, step: int = 1 << 12) -> Iterator[slice]:
    return (slice(at, min(at + step, rows)) for at in range(0, rows, step))


def noise(terms: np.ndarray, width: int) -> np.ndarray:
    """The rows of `terms` of a random matrix of all terms, the same in every task, so that nobody has to send it."""
    rng, out = np.random.default_rng(SEED), np.empty((len(terms), width))
    for block in row_blocks(1 << TERM_BITS):
        part = rng.standard_normal((block.stop - block.start, width))
        some = slice(*np.searchsorted(terms, (block.start, block.stop)))
        out[some] = part[terms[some] - block.start]
    return out


def orthonormal(tall: np.ndarray) -> np.ndarray:
    """An orthonormal basis of the columns, written over them without a copy; zeros for columns that depend on others."""
    r = np.zeros((1, tall.shape[1]))
    for block in row_blocks(len(tall)):
        r = np.linalg.qr(np.concatenate([r, tall[block]]), mode="r")
    _, size, turn = np.linalg.svd(r, full_matrices=False)
    turn = turn.T * np.divide(1, size, out=np.zeros_like(size), where=size > 1e-10 * size[0])
    for block in row_blocks(len(tall)):
        tall[block] = tall[block] @ turn
    return tall


def latent_space(passages: DataFrame, idf: np.ndarray, n: int) -> Latent:
    """Truncated singular value decomposition of the TF-IDF matrix of all passages by random projection.

    The first pass over the passages multiplies their matrix and its transpose with a random matrix that the tasks draw
    themselves, the second one sends them an orthonormal basis of that product. The driver gets one narrow matrix, with a
    row for each term of the passages (the rows of all others are zero), and a square one of its few columns; the size of
    neither depends on the number of passages.
    """
    known = np.flatnonzero(document_frequency(passages)[0])
    width = max(1, min(RANK + OVERSAMPLE, n, len(known)))

    def images(batch, narrow: np.ndarray):
        words, term = buckets(batch.column("text"))
        for ids, w in weighted(words, term, idf, batch.num_rows):
            ids = np.searchsorted(known, ids)
            yield ids, w, w @ narrow[ids]

    def product(batch, total):
        out = total.reshape(len(known), width)
        for ids, w, image in images(batch, noise(known, width)):
            out[ids] += np.outer(w, image)

    def square(batch, total):
        out = total.reshape(width, width)
        for _, _, image in images(batch, basis):
            out += np.outer(image, image)

    texts = passages.select("text")
    basis = orthonormal(add_up(texts, product, len(known) * width).reshape(-1, width))
    values, turn = np.linalg.eigh(add_up(texts, square, width * width).reshape(width, width))
    best = np.argsort(values)[::-1][:min(RANK, width)]
    best = best[values[best] > 1e-9]
    projection = np.empty((len(known), len(best)), np.float32)
    for block in row_blocks(len(known)):
        projection[block] = (basis[block] @ turn[:, best]) * idf[known[block], None]
    return Latent(idf, projection, known)


def cut_items(items: DataFrame, key: str, text: str, length: int) -> DataFrame:
    """Passages (item, text) of at most `length` words of each item, each half a passage after the last."""
    words = F.filter(F.split(F.col(text), r"\s+"), lambda w: w != "")
    rows = items.filter(F.col(text).isNotNull()).select(F.col(key).alias("item"), words.alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("w") - F.lit(length // 2) - 1), F.lit(length // 2))
    return rows.select("item", F.explode(starts).alias("at"), "w").select("item", F.array_join(F.slice("w", F.col("at") + 1, length), " ").alias("text"))


def places_of(words: list[int]) -> dict[int, int]:
    """The places of each word of a sequence, as the bits of a number."""
    places: dict[int, int] = {}
    for i, w in enumerate(words):
        places[w] = places.get(w, 0) | 1 << i
    return places


def subsequence(places: dict[int, int], size: int, b: list[int], least: float = 0) -> int:
    """Length of the longest common subsequence of b and `size` words at `places`, one step on long integers per word
    that both have; 0 if those alone show that it is below `least`."""
    hits = [places[w] for w in b if w in places]
    if len(hits) < least:
        return 0
    full = (1 << size) - 1
    rest = full
    for places_of_word in hits:
        hit = rest & places_of_word
        rest = (rest + hit | rest - hit) & full
    return size - rest.bit_count()


def answer_start(text: str) -> int:
    """How many characters come before the answer of an item: its last sentence, or what follows the last "?" or ":"."""
    body = text.rstrip().rstrip(".!?;:\n\t |*$&%#")
    return max([body.rfind(mark) + 1 for mark in (". ", "? ", ": ", "! ", "\n")], default=0)


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
          item_text: str = "text") -> DataFrame:
    """The leaks found: key, item_id, cosine, common (share of the item's words found in order), answer (of its answer's).

    All documents are counted for the term weights and searched as a whole. Windows whose cosine with a passage of an item
    in the latent space is at least COSINE are compared with the item by their longest common subsequence of words, with
    as many words on either side as the item has. So are all windows, whatever their cosine, that have with these words on
    either side as many of the item's rarest words as every leak must have; so no leak depends on the latent space, the
    number of items or their length. A document leaks an item with LEAK of its words, or with PARAPHRASE of
    them and ANSWER of its answer. Words are runs of letters and digits, so that case and punctuation do not matter. One
    row per document and item, the best window. Texts that share an item's id (or have none) are searched one by one and
    reported under it; equal texts are searched once and reported under each of their ids. NULL, empty and wordless texts and items match nothing; items of fewer
    words than a block are searched in windows of one. NULL keys stay NULL. Empty tables give no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    counts, n_docs = document_frequency(texts)
    idf = np.log((n_docs + 1) / (counts + 1)) + 1e-3
    length = BLOCK * WINDOWS[-1]
    ids = benchmark.select(F.col(item).alias("item_id"), F.xxhash64(F.col(item_text)).alias("item"), F.col(item_text).alias("text"))
    ids = ids.filter(F.col("text").isNotNull())
    benchmark, item, item_text = ids.select("item", "text").dropDuplicates(["item"]), "item", "text"
    passages = stored(cut_items(benchmark, item, item_text, length), "passages")
    n = passages.count()
    if not n or not n_docs:
        return spark.createDataFrame([], "doc_id long, item_id long, cosine double, common double, answer double").withColumnRenamed("doc_id", key)
    space = latent_space(passages, idf, n)
    found = None
    blocks = -(-n // PASSAGES_AT_ONCE)
    for k in range(blocks):
        some = passages if blocks == 1 else passages.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k)
        held = {r["item"] for r in some.select("item").distinct().collect()} if blocks > 1 else None
        rows = some.collect()  # a block of the query set: about PASSAGES_AT_ONCE passages of bounded length
        whole = benchmark.filter(F.col(item_text).isNotNull()).select(F.col(item).alias("item"), F.col(item_text).alias("text"))
        if held is not None:
            whole = whole.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k)
        hits = texts.mapInArrow(search(space, rows, {r["item"]: r["text"] for r in whole.collect()}),
                                "id long, item long, cosine double, common double, answer double")
        found = hits if found is None else found.unionByName(hits)
    best = found.groupBy("id", "item").agg(F.max(F.struct("common", "answer", "cosine")).alias("b"))
    # Stored, since a join may look at its inputs twice and the search is what costs time; it holds the leaks found only.
    best = stored(best, "found-leaks").join(ids.select("item_id", "item").distinct(), "item").groupBy("id", "item_id").agg(F.max("b").alias("b"))
    return best.select(F.col("id").alias(key), "item_id", "b.cosine", "b.common", "b.answer")


class Rare:
    """The rarest words of items, to find the windows that may hold a leak by the words they share.

    A leak has t of the m words of an item, so it lacks m - t at most; of the rarest m - t + l it has at least l.
    """

    def __init__(self, sequence: dict[int, list[int]], idf: np.ndarray):
        self.items = [i for i, x in sequence.items() if x]
        self.size = np.array([len(sequence[i]) for i in self.items], np.int64)
        need = np.ceil(PARAPHRASE * self.size - 1e-9).astype(np.int64)
        self.least = np.maximum(1, (RARE_PART * need).astype(np.int64))
        self.width = BLOCK * np.array(WINDOWS)[np.searchsorted(BLOCK * np.array(WINDOWS), self.size).clip(max=len(WINDOWS) - 1)]
        word, owner = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for k, i in enumerate(self.items):
            all_words = np.array(sequence[i], np.uint64)
            rarity = idf[(all_words >> np.uint64(64 - TERM_BITS)).astype(np.int64)]
            some = np.unique(all_words[np.argsort(-rarity, kind="stable")[:self.size[k] - need[k] + self.least[k]]])
            word.append(some)
            owner.append(np.full(len(some), k))
        word, owner = np.concatenate(word), np.concatenate(owner)
        order = np.argsort(word, kind="stable")
        self.words, first = np.unique(word[order], return_index=True)
        self.owner, self.first = owner[order], np.append(first, len(word))
        self.known = np.zeros(1 << TERM_BITS, bool)
        self.known[(self.words >> np.uint64(64 - TERM_BITS)).astype(np.int64)] = True

    def places(self, words, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of items and the places of their rarest words, in this order."""
        at = np.flatnonzero(self.known[term])
        code = np.searchsorted(self.words, words.hash[at]).clip(max=max(0, len(self.words) - 1))
        same = self.words[code] == words.hash[at]
        at, code = at[same], code[same]
        many = self.first[code + 1] - self.first[code]
        ends = np.cumsum(many)
        k = self.owner[np.arange(many.sum()) - np.repeat(ends - many - self.first[code], many)]
        at = np.repeat(at, many)
        order = np.argsort(k, kind="stable")
        return k[order], at[order]

    def enough(self, places: tuple[np.ndarray, np.ndarray], size: int, k: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether items have as many of their rarest words from a to before b, of `size` words, as every leak has."""
        sorted_places = places[0] * (size + 1) + places[1]
        return np.searchsorted(sorted_places, k * (size + 1) + b) - np.searchsorted(sorted_places, k * (size + 1) + a) >= self.least[k]

    def windows(self, words, places: tuple[np.ndarray, np.ndarray], cuts: np.ndarray, number: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, first and last block at which they start) of all windows that, with the words on either side, have enough."""
        k, at = places
        if not len(at):
            return
        last = np.arange(len(k)) + self.least[k] - 1
        inside = last < len(k)
        first, last = np.flatnonzero(inside), last[inside]
        k, a, b, owner = k[first], at[first], at[last], k[last]
        fits = (k == owner) & (words.text[a] == words.text[b]) & (b - a < 2 * self.size[k] + self.width[k])
        k, a, b = k[fits], a[fits], b[fits]
        low = np.maximum(cuts[words.text[a]], b - self.width[k] - self.size[k] + 1)
        high = np.minimum(cuts[words.text[a] + 1] - 1, a + self.size[k])
        low, high = number[low], number[np.maximum(low, high)]
        count = high - low + 1
        ends = np.cumsum(count)
        if not len(ends):
            return
        block = np.arange(ends[-1]) - np.repeat(ends - count - low, count)
        blocks = int(number[-1]) + 1
        k, block = np.divmod(np.unique(np.repeat(k, count) * blocks + block), blocks)
        apart = (np.diff(k) != 0) | (np.diff(block) != 1) | (np.diff(doc[block]) != 0)
        first = np.append(0, np.flatnonzero(apart) + 1)
        for k, low, high in zip(k[first].tolist(), block[first].tolist(), block[np.append(first[1:], len(block)) - 1].tolist()):
            yield self.items[k], low, high


def search(space: Latent, passages: list, items: dict[int, str]):
    """Windows of documents against a block of passages, each passage against windows of its length."""
    words, term = buckets(pa.array([p["text"] for p in passages]))
    sizes = np.bincount(words.text, minlength=len(passages))
    # The row behind the last is zero: it stands for terms of no passage, and for the words that a block lacks.
    nothing = len(space.projection)
    projection = np.concatenate([space.projection, np.zeros((1, space.projection.shape[1]), np.float32)])
    row_of = np.full(1 << TERM_BITS, nothing, np.int32)
    row_of[slice(None) if space.terms is None else space.terms] = np.arange(nothing)
    vectors = np.zeros((len(passages), projection.shape[1]), np.float32)
    np.add.at(vectors, words.text, projection[row_of[term]])
    norm = np.linalg.norm(vectors, axis=1)
    vectors = vectors / np.maximum(norm, 1e-9)[:, None]
    scale = np.searchsorted(BLOCK * np.array(WINDOWS), sizes).clip(max=len(WINDOWS) - 1)
    groups = {s: np.flatnonzero((scale == s) & (norm > 1e-9)) for s in range(len(WINDOWS))}
    owner = [p["item"] for p in passages]
    sequence, answers = {}, {}
    for i, t in items.items():
        sequence[i] = words_of(pa.array([t]), letters_only=True).hash.tolist()
        answers[i] = words_of(pa.array([t[answer_start(t):]]), letters_only=True).hash.tolist() or sequence[i]
    item_places = {i: places_of(x) for i, x in sequence.items()}
    answer_places = {i: places_of(x) for i, x in answers.items()}
    rare = Rare(sequence, space.idf)
    item_number = {i: k for k, i in enumerate(rare.items)}
    owner_number = np.array([item_number.get(i, -1) for i in owner], np.int64)
    own: dict[int, list[int]] = {}
    for k, i in enumerate(owner):
        own.setdefault(i, []).append(k)

    def check(i: int, window: list[int]) -> tuple[float, float]:
        size = len(sequence[i])
        share = subsequence(item_places[i], size, window, PARAPHRASE * size) / max(1, size)
        if share < PARAPHRASE:
            return share, 0.0
        return share, subsequence(answer_places[i], len(answers[i]), window) / max(1, len(answers[i]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 1 << 20):
            words, term = buckets(part.column("text"))
            if not len(term):
                continue
            # Blocks start anew in each document.
            cuts = np.searchsorted(words.text, np.arange(part.num_rows + 1))
            inside = np.arange(len(term)) - cuts[words.text]
            starts = np.flatnonzero(inside % BLOCK == 0)
            doc = words.text[starts]
            number = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(term)))
            grid = np.full((len(starts), BLOCK), nothing)
            grid[number, inside % BLOCK] = row_of[term]
            block = np.zeros((len(starts), projection.shape[1]), np.float32)
            for k in range(BLOCK):
                block += projection[grid[:, k]]
            best: dict[tuple[int, int], tuple] = {}
            places = rare.places(words, term)
            for s, size in enumerate(WINDOWS):
                if not len(groups[s]):
                    continue
                window = block.copy()
                for k in range(1, size):
                    same = doc[k:] == doc[:-k] if k < len(doc) else np.zeros(0, bool)
                    window[:len(doc) - k][same] += block[k:][same]
                high = np.linalg.norm(window, axis=1)
                some = np.flatnonzero(high >= LEAST_SHARE * norm[groups[s]].min())
                for at in range(0, len(some), 4096):
                    rows = some[at:at + 4096]
                    part_windows = window[rows]
                    part_windows /= high[rows, None]
                    near = part_windows @ vectors[groups[s]].T
                    w, p = np.divmod(np.flatnonzero(near >= COSINE), near.shape[1])
                    long = high[rows[w]] >= LEAST_SHARE * norm[groups[s][p]]
                    w, p = w[long], p[long]
                    row, passage = rows[w], groups[s][p]
                    k, first = owner_number[passage], starts[row]
                    a = np.maximum(cuts[doc[row]], first - rare.size[k])
                    b = np.minimum(cuts[doc[row] + 1], first + size * BLOCK + rare.size[k])
                    # Without enough of the rarest words the comparison can only fail.
                    found = rare.enough(places, len(term), k, a, b)
                    for cosine, d, first, passage, a, b, may in zip(*(x.tolist() for x in (near[w, p], doc[row], first, passage, a, b, found))):
                        i = owner[passage]
                        place = (d, i, first // (2 * BLOCK))
                        if place not in best:
                            best[place] = (*check(i, words.hash[a:b].tolist()), cosine) if may else (0.0, 0.0, cosine)
            for i, low, high in rare.windows(words, places, cuts, number, doc):
                reach, d, width = len(sequence[i]), int(doc[low]), BLOCK * WINDOWS[scale[own[i][0]]]
                start, stop = int(cuts[d]), int(cuts[d + 1])
                around = lambda a, b: words.hash[max(start, int(starts[a]) - reach):min(stop, int(starts[b]) + width + reach)].tolist()  # noqa: B023, E731
                if low < high and check(i, around(low, high))[0] < PARAPHRASE:
                    continue  # no part of a stretch has more than the whole
                for at in range(low, high + 1):
                    share, answer = check(i, around(at, at))
                    if share >= LEAK or share >= PARAPHRASE and answer >= ANSWER:
                        first = int(starts[at])
                        window = projection[row_of[term[first:min(stop, first + width)]]].sum(axis=0)
                        cosine = float((vectors[own[i]] @ window).max() / max(1e-9, np.linalg.norm(window)))
                        best[d, i, -1 - first] = (share, answer, cosine)
            kept = [(d, i, *v) for (d, i, _), v in best.items() if v[0] >= LEAK or v[0] >= PARAPHRASE and v[1] >= ANSWER]
            if kept:
                ids = part.column("id").take(pa.array([x[0] for x in kept]))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([x[1] for x in kept], pa.int64()), pa.array([x[4] for x in kept], pa.float64()),
                     pa.array([x[2] for x in kept], pa.float64()), pa.array([x[3] for x in kept], pa.float64())],
                    ["id", "item", "cosine", "common", "answer"])
    return run


def drop_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id") -> DataFrame:
    """The documents without a leak, all columns as they are; NULL keys stay."""
    return docs.join(leaks(docs, benchmark, key).select(key).distinct(), key, "left_anti").select(docs.columns)
