"""SentencePiece encoding over a relational lattice of pieces, and decoding."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs, parquet
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.shared import bounded_batches, slices, stored, text_bytes
from touchline.llm.tokens import opened
from touchline.session import scratch_dir

SPACE = "▁"
#: Units up to so many characters go through the lattice, whose fold keeps their borders as the bits of a number.
LATTICE_CHARS = 60
#: Most frequent units that tasks hold in memory, at most (about 20 bytes each); the others are joined.
HOT_UNITS = 1_500_000
#: Distinct units of some runs of text that are added up before they leave a task.
COUNT_AT_ONCE = 300_000
#: Text cut at once: units that recur in it are looked up once.
TEXT_AT_ONCE = 2 << 20
#: Pairs of characters that are looked up in a table of bytes.
TABLE_PAIRS = 4 << 20
#: Distinct units whose edges one task groups.
UNITS_AT_ONCE = 50_000


@dataclass
class Vocabulary:
    """The piece table: text and score of each id; ids of the 256 bytes, if unknown characters fall back to them."""
    pieces: list[tuple[int, str, float]]
    bytes: list[int]
    unknown: int
    size: int
    merges: bool

    @cached_property
    def scores(self) -> dict[str, tuple[float, int]]:
        return {p: (s, i) for i, p, s in self.pieces}

    @property
    def longest(self) -> int:
        return max((len(p) for _, p, _ in self.pieces), default=1)

    @property
    def pairs(self) -> set[str]:
        """Neighbouring characters inside pieces; between any others a text may be cut without changing its pieces."""
        return {p[i:i + 2] for _, p, _ in self.pieces for i in range(len(p) - 1)}

    def texts(self) -> list[bytes]:
        out = [b""] * self.size
        for i, p, _ in self.pieces:
            out[i] = p.replace(SPACE, " ").encode()
        for value, i in enumerate(self.bytes):
            out[i] = bytes([value])
        out[self.unknown] = out[self.unknown] or " ⁇ ".encode()
        return out


def load(path: str) -> Vocabulary:
    """Read a model file. Only models that leave texts as they are, but for a space before them, are understood."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as schema
    model = schema.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    rules = model.normalizer_spec
    assert not rules.precompiled_charsmap and rules.add_dummy_prefix and not rules.remove_extra_whitespaces, "texts would be normalised"
    p = sentencepiece.SentencePieceProcessor(model_file=path)
    n = p.get_piece_size()
    plain = [(i, p.id_to_piece(i), p.get_score(i)) for i in range(n) if not (p.is_byte(i) or p.is_control(i) or p.is_unknown(i) or p.is_unused(i))]
    inner = [x for _, x, _ in plain if SPACE in x.lstrip(SPACE)]
    assert not inner, "a piece goes on behind a space"
    own = {int(p.id_to_piece(i)[3:5], 16): i for i in range(n) if p.is_byte(i)}
    return Vocabulary(plain, [own[k] for k in range(256)] if len(own) == 256 else [], p.unk_id(), n, model.trainer_spec.model_type == 2)


class Cutter:
    """Texts to units by arrays: a text with its space marks is cut where no piece has both neighbouring characters."""

    def __init__(self, pairs: set[str]):
        chars = sorted({ord(c) for p in pairs for c in p})
        #: Number of each character that is in a pair; 0 for all others, which the last place stands for.
        self.number = np.zeros(max(chars, default=0) + 2, np.int32)
        self.number[chars] = np.arange(1, len(chars) + 1)
        self.width = len(chars) + 1
        pairs_inside = np.array(sorted(self.width * int(self.number[ord(p[0])]) + int(self.number[ord(p[1])]) for p in pairs), np.int64)
        #: Whether pieces have a pair, by its number; sorted numbers for alphabets too large for a table.
        self.table, self.pairs = None, pairs_inside
        if self.width ** 2 <= TABLE_PAIRS:
            self.table = np.zeros(self.width ** 2, bool)
            self.table[pairs_inside] = True

    def inside(self, codes: np.ndarray) -> np.ndarray:
        """Whether a piece has both, for each two neighbours of some characters."""
        number = self.number[np.minimum(codes, len(self.number) - 1)]
        if self.table is not None:
            pair = number[:-1] * np.int32(self.width)
            pair += number[1:]
            return self.table[pair]
        return np.isin(number[:-1].astype(np.int64) * self.width + number[1:], self.pairs)

    def __call__(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The units of all texts one after another, and where those of each text start (NULL and empty texts have none)."""
        some = pa.compute.not_equal(texts, "").fill_null(False)
        marked = pa.compute.binary_join_element_wise("", pa.compute.replace_substring(texts, " ", SPACE), SPACE)
        data, offsets = text_bytes(pa.compute.if_else(some, marked, ""))
        chars = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        cut = np.ones(len(chars), bool)
        if len(codes):
            cut[1:-1] = ~self.inside(codes)
        first = np.searchsorted(chars, offsets)
        cut[first] = True
        edges = np.flatnonzero(cut)
        units = pa.LargeStringArray.from_buffers(len(edges) - 1, pa.py_buffer(chars[edges].astype(np.int64)), pa.py_buffer(data.tobytes()))
        return units, np.searchsorted(edges, first)


def gather(pool: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of `pool` that start at `first` and have `size` items, one after another."""
    stop = np.cumsum(size)
    at = np.repeat(first - (stop - size), size)
    at += np.arange(len(at))
    return pool[at]


def count_units(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """Distinct units of all texts and how often they occur (added up in each task first)."""
    pairs = vocabulary.pairs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, held = Cutter(pairs), []

        def added() -> pa.RecordBatch:
            sums = pa.concat_tables(held).group_by("unit", use_threads=False).aggregate([("n", "sum")]).combine_chunks()
            held.clear()
            return pa.RecordBatch.from_arrays([sums.column(x).combine_chunks().cast(kind) for x, kind in
                                               (("unit", pa.string()), ("n_sum", pa.int64()))], ["unit", "n"])
        for part in slices(batches, "text", TEXT_AT_ONCE):
            units, _ = cutter(part.column("text"))
            coded = units.dictionary_encode()
            held.append(pa.table({"unit": coded.dictionary, "n": np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))}))
            if sum(map(len, held)) > COUNT_AT_ONCE:
                yield added()
        if held:
            yield added()
    return docs.select(F.col(text).alias("text")).mapInArrow(run, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))


#: An edge of the merge fold as one number: order of its piece, start, end (6 bits each), id.
ID_BITS, PLACE_BITS = 24, 6


def bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), at)


def lattice(units: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(unit, n, ids) of distinct units of at most LATTICE_CHARS characters.

    All substrings no longer than the longest piece are joined with the piece table (its size is that of the model, so it
    is broadcast), the edges found are grouped by unit and folded from best to worst.

    Models with merges: an edge is taken if exactly two tokens so far make it up; the borders of tokens are the bits of a
    number. One pass is exact, since the parts of a piece rank before it. Unigram models: a Viterbi fold in the order of
    the ends of edges keeps the best score and path up to every place.
    """
    spark = units.sparkSession
    order = {x: k for k, x in enumerate(sorted({-score for *_, score in vocabulary.pieces}))}
    table = spark.createDataFrame([(*p, order[-p[2]]) for p in vocabulary.pieces], "id int, piece string, score double, place int")
    n = F.char_length("unit")
    # Dealt out by unit first, so edges are grouped where they were found, a bounded number of units at a time.
    parts = max(1, -(-units.count() // UNITS_AT_ONCE))
    spans = (units.repartition(parts, "unit").withColumn("uid", F.monotonically_increasing_id())
             .select("uid", "unit", "n", F.explode(F.sequence(F.lit(0), n - 1)).alias("s"))
             .select("uid", "unit", "n", "s", F.explode(F.sequence(F.lit(1), F.least(F.lit(vocabulary.longest), n - F.col("s")))).alias("k"))
             .select("uid", "unit", "n", "s", (F.col("s") + F.col("k")).alias("e"), F.substring("unit", F.col("s") + 1, F.col("k")).alias("piece")))
    edges = spans.join(F.broadcast(table), "piece", "left")
    if vocabulary.merges:
        assert max(i for i, *_ in vocabulary.pieces) < 1 << ID_BITS, "too many pieces to pack"
        # Single characters need no edge; the first one stands for its unit in case there are no edges at all.
        edges = edges.filter((F.col("id").isNotNull() & (F.col("e") > F.col("s") + 1)) | (F.col("e") == 1))
        kind = F.col("place").cast("long")
        for part, bits in ((F.col("s"), PLACE_BITS), (F.col("e"), PLACE_BITS), (F.col("id"), ID_BITS)):
            kind = F.call_function("shiftleft", kind, F.lit(bits)).bitwiseOR(part.cast("long"))
        kind = F.when(F.col("e") > 1, kind)  # collect_list leaves NULLs out
    else:
        edges = edges.filter(F.col("id").isNotNull() | (F.col("e") == F.col("s") + 1))
        low = min((x for *_, x in vocabulary.pieces), default=0.0) - 10.0
        kind = F.struct("e", "s", F.coalesce("score", F.lit(low)).alias("score"), "id")
    grouped = edges.groupBy("uid", "unit").agg(F.first("n").alias("n"), F.collect_list(kind).alias("edges"))
    grouped = grouped.select("unit", "n", (merged(n, vocabulary) if vocabulary.merges else viterbi(n)).alias("path"))
    if vocabulary.bytes:
        ids = F.array(*[F.lit(i) for i in vocabulary.bytes])

        def single(t: Column) -> Column:
            code = F.hex(F.encode(F.substring(F.col("unit"), t["s"] + 1, F.lit(1)), "UTF-8"))
            return F.transform(F.sequence(F.lit(0), (F.length(code) / 2 - 1).cast("int")), lambda k: F.element_at(
                ids, F.conv(F.substring(code, (2 * k + 1).cast("int"), F.lit(2)), 16, 10).cast("int") + 1))
    else:
        def single(t: Column) -> Column:
            return F.array(F.lit(vocabulary.unknown))
    plain = F.transform("path", lambda t: t["id"])
    wide = F.flatten(F.transform("path", lambda t: F.when(t["id"].isNotNull(), F.array(t["id"])).otherwise(single(t))))
    return grouped.select("unit", "n", F.when(F.exists("path", lambda t: t["id"].isNull()), wide).otherwise(plain).alias("ids"))


def merged(n: Column, vocabulary: Vocabulary) -> Column:
    """The tokens (s, id) after taking edges in order of piece and start wherever exactly two tokens make them up.

    Characters that stay alone are looked up in a text of all single characters.
    """
    alone = sorted(((p, i) for i, p, _ in vocabulary.pieces if len(p) == 1), key=lambda x: (x[0] != SPACE, x[0]))
    alphabet, numbers = F.lit("".join(p for p, _ in alone)), F.array(*[F.lit(i) for _, i in alone])

    def start(x: Column) -> Column:
        return F.shiftright(x, ID_BITS + PLACE_BITS).bitwiseAND(F.lit(63)).cast("int")

    def end(x: Column) -> Column:
        return F.shiftright(x, ID_BITS).bitwiseAND(F.lit(63)).cast("int")

    def ends(x: Column) -> Column:
        return bit(start(x)).bitwiseOR(bit(end(x)))

    def span(borders: Column, x: Column) -> Column:
        return borders.bitwiseAND(bit(end(x) + 1) - bit(start(x)))

    def take(borders: Column, x: Column) -> Column:
        # Both ends are borders, and one more between them goes.
        return F.when((borders.bitwiseAND(ends(x)) == ends(x)) & (F.bit_count(span(borders, x)) == 3),
                      borders - span(borders, x) + ends(x)).otherwise(borders)

    def by_itself(s: Column) -> Column:
        place = F.call_function("locate", F.substring(F.col("unit"), s + 1, F.lit(1)), alphabet)
        return F.struct(s.alias("s"), F.when(place > 0, F.element_at(numbers, place)).alias("id"))

    def tokens(borders: Column) -> Column:
        joined = F.transform(F.filter("edges", lambda x: span(borders, x) == ends(x)), lambda x: F.struct(
            start(x).alias("s"), x.bitwiseAND(F.lit((1 << ID_BITS) - 1)).cast("int").alias("id")))
        lone = F.filter(F.sequence(F.lit(0), n - 1), lambda s: F.call_function("shiftright", borders, s).bitwiseAND(F.lit(3)) == 3)
        return F.sort_array(F.concat(joined, F.transform(lone, by_itself)))
    borders = F.aggregate(F.sort_array("edges"), bit(n + 1) - 1, take)
    return F.transform(F.array(borders), tokens)[0]


def viterbi(n: Column) -> Column:
    """The tokens (s, id) of the path with the best sum of scores; of equal sums the one whose last token is longer."""
    start = F.array(F.struct(F.lit(0.0).alias("score"), F.expr("cast(array() as array<struct<s:int,id:int>>)").alias("path")))

    def best_to(states: Column, end: Column) -> Column:
        steps = F.transform(F.filter("edges", lambda x: x["e"] == end), lambda x: F.struct(
            (F.element_at(states, x["s"] + 1)["score"] + x["score"]).alias("score"), (-x["s"]).alias("near"), x["s"].alias("s"), x["id"].alias("id")))
        top = F.transform(F.array(F.array_max(steps)), lambda t: F.struct(t["score"].alias("score"), F.array_append(
            F.element_at(states, t["s"] + 1)["path"], F.struct(t["s"].alias("s"), t["id"].alias("id"))).alias("path")))
        return F.concat(states, top)
    return F.element_at(F.aggregate(F.sequence(F.lit(1), n), start, best_to), -1)["path"]


def by_heap(unit: str, vocabulary: Vocabulary) -> list[int]:
    """Pieces of a unit too long for the lattice: the best neighbours are joined first (merges), or the best path is kept."""
    import heapq
    score = vocabulary.scores
    single = lambda c: [score[c][1]] if c in score else [vocabulary.bytes[b] for b in c.encode()] or [vocabulary.unknown] \
        if vocabulary.bytes else [vocabulary.unknown]
    if not vocabulary.merges:
        low = min((s for _, _, s in vocabulary.pieces), default=0.0) - 10.0
        best = [(0.0, 0, [])] + [None] * len(unit)
        for e in range(1, len(unit) + 1):
            for s in range(max(0, e - vocabulary.longest), e):
                got = score.get(unit[s:e]) or ((low, None) if e == s + 1 else None)
                if got and (best[e] is None or best[s][0] + got[0] > best[e][0]):
                    best[e] = (best[s][0] + got[0], s, None)
        out, e = [], len(unit)
        while e:
            s = best[e][1]
            out[:0] = [score[unit[s:e]][1]] if unit[s:e] in score else single(unit[s:e])
            e = s
        return out
    after, before, end = list(range(1, len(unit) + 1)), list(range(-1, len(unit) - 1)), list(range(1, len(unit) + 1))
    heap: list[tuple[float, int, int]] = []

    def offer(a: int) -> None:
        if a >= 0 and after[a] < len(unit):
            got = score.get(unit[a:end[after[a]]])
            if got:
                heapq.heappush(heap, (-got[0], a, end[after[a]]))
    for a in range(len(unit)):
        offer(a)
    alive = [True] * len(unit)
    while heap:
        _, a, e = heapq.heappop(heap)
        if not alive[a] or after[a] >= len(unit) or end[after[a]] != e or end[a] >= e:
            continue
        b = after[a]
        alive[b], end[a], after[a] = False, e, after[b]
        if after[a] < len(unit):
            before[after[a]] = a
        offer(a)
        offer(before[a])
    return [i for a in range(len(unit)) if alive[a] for i in ([score[unit[a:end[a]]][1]] if unit[a:end[a]] in score else single(unit[a:end[a]]))]


def encode_units(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """The table (unit, n, ids) of all distinct units."""
    units = stored(count_units(docs, vocabulary, text), "counts")
    short = lattice(units.filter(F.char_length("unit") <= LATTICE_CHARS), vocabulary)

    def run(batches):
        for batch in batches:
            ids = [by_heap(u, vocabulary) for u in batch.column("unit").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("unit"), batch.column("n"), pa.array(ids, pa.list_(pa.int32()))], ["unit", "n", "ids"])
    long = units.filter(F.char_length("unit") > LATTICE_CHARS).mapInArrow(run, "unit string, n long, ids array<int>")
    return stored(short.unionByName(long), "units")


@dataclass
class Hot:
    """Frequent units in the order of their hashes: hash, a second hash, and their ids one after another."""
    hash: np.ndarray
    check: np.ndarray
    ends: np.ndarray
    ids: np.ndarray

    def find(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each unit is here, where its ids start and how many there are."""
        if not len(units) or not len(self.hash):
            return (np.zeros(len(units), bool), *np.zeros((2, len(units)), np.int64))
        data = units.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        h = np.frombuffer(b"".join([xxhash.xxh64_digest(x, 42) for x in data]), ">u8").astype(np.uint64)
        check = np.fromiter(map(zlib.crc32, data), np.uint32, len(data))
        at = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        known = (self.hash[at] == h) & (self.check[at] == check)
        return known, self.ends[at], np.where(known, self.ends[at + 1] - self.ends[at], 0)


def hot_units(table: DataFrame, limit: int | None = None) -> tuple[Hot, DataFrame]:
    """The units that occur most often, as many whole classes of similar counts as fit into `limit`, and the table of all others."""
    level = F.floor(F.log2("n") * 8)  # some hundreds of classes at most
    room, least = HOT_UNITS if limit is None else limit, None
    for row in sorted(table.groupBy(level.alias("level")).count().collect(), reverse=True):
        room -= row["count"]
        if room < 0:
            break
        least = row["level"]
    if least is None:
        return Hot(np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(0, np.uint16)), table
    got = table.filter(level >= least).select(F.xxhash64("unit").alias("h"), F.crc32(F.encode("unit", "UTF-8")).alias("c"), "ids").toArrow()
    h = got.column("h").to_numpy().view(np.uint64)  # at most `limit` rows
    lists = got.column("ids").combine_chunks()
    size = lists.value_lengths().to_numpy()
    flat = lists.flatten().to_numpy()
    order = np.argsort(h)
    starts = np.concatenate([[0], np.cumsum(size)])[:-1]
    ends = np.concatenate([[0], np.cumsum(size[order])])
    take = np.repeat(starts[order] - ends[:-1], size[order]) + np.arange(len(flat))
    kind = np.uint16 if len(flat) == 0 or flat.max() < 1 << 16 else np.int32
    return Hot(h[order], got.column("c").to_numpy().astype(np.uint32)[order], ends, flat[take].astype(kind)), table.filter(level < least)


class Assembler:
    """Texts to ids with the hot units and the rare ones of a task's rows; a unit in neither is merged by itself. Nothing
    is kept between calls."""

    def __init__(self, hot: Hot, vocabulary: Vocabulary):
        self.hot, self.cutter, self.lone = hot, Cutter(vocabulary.pairs), lambda unit: by_heap(unit, vocabulary)
        # The library gives one id for a run of unknown characters, unless they fall back to bytes.
        self.merge_id = None if vocabulary.bytes else vocabulary.unknown

    def rare(self, texts: pa.Array) -> pa.Array:
        """The distinct units of the texts that are not hot."""
        distinct = self.cutter(texts)[0].dictionary_encode().dictionary
        return distinct.filter(pa.array(~self.hot.find(distinct)[0], pa.bool_()))

    def ids(self, texts: pa.Array, rare: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another and where those of each text start; `rare` is a table (unit, ids)."""
        units, starts = self.cutter(texts)
        coded = units.dictionary_encode()
        known, first, size = self.hot.find(coded.dictionary)
        pool, first = gather(self.hot.ids, first, size).astype(np.int32), np.cumsum(size) - size
        if not known.all():
            names, lists = rare.column("unit").combine_chunks(), rare.column("ids").combine_chunks()
            others = coded.dictionary.filter(pa.array(~known))
            at = pa.compute.index_in(others, names)
            if at.null_count:
                more = others.filter(at.is_null())
                names = pa.concat_arrays([names, more])
                lists = pa.concat_arrays([lists, pa.array([self.lone(u) for u in more.to_pylist()], lists.type)])
                at = pa.compute.index_in(others, names)
            at = at.to_numpy()
            many = lists.value_lengths().to_numpy().astype(np.int64)
            first[~known], size[~known] = len(pool) + (np.cumsum(many) - many)[at], many[at]
            pool = np.concatenate([pool, lists.flatten().to_numpy().astype(np.int32)])
        place = coded.indices.to_numpy()
        ids = gather(pool, first[place], size[place])
        ends = np.concatenate([[0], np.cumsum(size[place])])[starts]
        if self.merge_id is not None and len(ids):
            again = np.concatenate([[False], (ids[1:] == self.merge_id) & (ids[:-1] == self.merge_id)])
            again[ends[:-1][ends[:-1] < len(ids)]] = False
            ids, ends = ids[~again], ends - np.concatenate([[0], np.cumsum(again)])[ends]
        return ids, ends


def rare_units(folder: str | None) -> pa.Table:
    """The rare units (unit, ids) of one part of the rows; none if there is no such folder."""
    schema = pa.schema([("unit", pa.large_string()), ("ids", pa.large_list(pa.int32()))])
    if folder is None:
        return schema.empty_table()
    disk, path = opened(folder)
    if disk.get_file_info(path).type != fs.FileType.Directory:
        return schema.empty_table()
    files = [f.path for f in disk.get_file_info(fs.FileSelector(path)) if f.path.endswith(".parquet")]
    tables = []
    for f in files:
        with disk.open_input_file(f) as file:
            tables.append(parquet.read_table(file, columns=["unit", "ids"]).cast(schema))
    return pa.concat_tables([schema.empty_table(), *tables])


def decoder(texts: list[bytes]):
    """Ids to text: pieces in order, bytes put together, the space before the text taken off; NULL ids are skipped."""
    def decode(ids) -> str:
        whole = b"".join([texts[i] for i in ids if i is not None]).decode("utf-8", "replace")
        return whole[1:] if whole[:1] == " " else whole
    return decode


def encode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_tokens, ids, round_trip (whether the decoded ids are the text).

    Every distinct unit of the corpus is encoded once in the lattice; units are the words of texts, cut where no piece has
    both neighbouring characters. The most frequent units go to the tasks in a table of bounded size, the others are
    joined with the units of each part of the rows and read by the task of that part. Should the rows be dealt otherwise
    the second time, units that a task lacks are merged in it, to the same ids. Ids are those of the sentencepiece library. NULL and empty texts have no ids. Rows that repeat a key stay
    rows; rows with NULL keys are encoded too. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    vocabulary = load(model)
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    table = encode_units(rows, vocabulary)
    frequent, others = hot_units(table)
    hot = spark.sparkContext.broadcast((frequent.hash, frequent.check, frequent.ends, frequent.ids))
    texts, folder = vocabulary.texts(), scratch_dir(spark, "rare")

    def scarce(batches):
        maker, task = Assembler(Hot(*hot.value), vocabulary), TaskContext.get().partitionId()
        for part in slices(batches, "text", TEXT_AT_ONCE):
            units = maker.rare(part.column("text"))
            if len(units):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(units), task, np.int32)), units.cast(pa.string())], ["task", "unit"])

    all_hot = len(frequent.hash) == table.count()
    if not all_hot:
        # The rare units of each part of the rows, with their ids, go to a folder of their own: texts are not shuffled. One
        # that comes again in a later run of text of the part is there again.
        seen = rows.select("text").mapInArrow(scarce, "task int, unit string").join(others.select("unit", "ids"), "unit")
        seen.repartition("task").write.partitionBy("task").parquet(folder)

    def put_together(batches):
        maker = Assembler(Hot(*hot.value), vocabulary)
        rare = rare_units(None if all_hot else f"{folder}/task={TaskContext.get().partitionId()}")
        spelt = np.frombuffer(b"".join(texts), np.uint8)
        length = np.array([len(t) for t in texts], np.int64)
        begin = np.cumsum(length) - length
        for part in slices(batches, "text", TEXT_AT_ONCE):
            ids, ends = maker.ids(part.column("text"), rare)
            # Back to text: the bytes of all pieces, compared text by text behind the space that was put in front.
            back = gather(spelt, begin[ids], length[ids]).tobytes()
            stops = np.concatenate([[0], np.cumsum(length[ids])])[ends].tolist()
            data, at = text_bytes(part.column("text"))
            whole, at = data.tobytes(), at.tolist()
            same = [back[a + (a < b and back[a] == 32):b] == whole[c:d] for a, b, c, d in zip(stops[:-1], stops[1:], at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(np.diff(ends).astype(np.int32)), pa.ListArray.from_arrays(
                pa.array(ends.astype(np.int32)), pa.array(ids)), pa.array(same, pa.bool_())], ["id", "n_tokens", "ids", "round_trip"])
    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(put_together, f"id {kind}, n_tokens int, ids array<int>, round_trip boolean").withColumnRenamed("id", key)


def decode(encoded: DataFrame, model: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """All rows and columns with the text of `ids` added; NULL lists give NULL, empty ones an empty text."""
    pieces = decoder(load(model).texts())

    @F.pandas_udf("string")
    def texts(column):
        return column.map(lambda x: None if x is None else pieces(x))
    return encoded.withColumn(text, texts(F.col(ids)))
