"""Token ids in binary shards whose document boundaries are Elias-Fano encoded."""

from __future__ import annotations

import re
import struct
import sys
import uuid
import zlib
from collections.abc import Iterable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.shared import slices
from touchline.session import scratch_dir

MAGIC = b"EFTOK1\0\0"
HEADER = "<8sQQQBB6x"
#: One select sample for so many set bits.
SAMPLE = 64
#: Words whose ids a worker remembers before it starts anew.
CACHE_WORDS, WORDS_AT_ONCE = 400_000, 10_000
#: Text encoded at once: words that recur in it are looked up once.
TEXT_AT_ONCE = 4 << 20
#: Text that makes one file, about.
SHARD_TEXT_BYTES = 64 << 20
#: Letters that signs end (apostrophes aside): the pre-tokenizer cuts between them, so both are looked up by themselves.
TAILED = re.compile(r"([A-Za-zÀ-ÖØ-öø-ɏ]+)([!-&(-/:-@\[-`{-~]+)").fullmatch

#: White space other than single spaces and line feeds between words.
ODD_SPACES = "[\t\v\f\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]|[ \n][ \n]|^[ \n]|[ \n]$"


class EliasFano:
    """A non-decreasing sequence of n integers below 2^63 in about 2 + log2(max / n) bits each, with select."""

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.width, self.low, self.high, self.samples = n, width, low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        width = max(0, (top // n).bit_length() - 1) if n else 0
        bits = ((values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        low = np.packbits(bits.ravel(), bitorder="little")
        places = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        flags = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        flags[places] = 1
        # A sample holds the byte of every 64th set bit and the set bits before that byte.
        high = np.packbits(flags, bitorder="little")
        before = np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.int64)])
        byte = places[::SAMPLE] >> 3
        return cls(n, width, low, high, np.stack([byte, before[byte]], 1).astype("<u4"))

    def select(self, i: int) -> int:
        """The i-th value: the place of the i-th set bit, less i, above its low bits."""
        byte, seen = (int(x) for x in self.samples[i // SAMPLE])
        while seen + (count := int(self.high[byte]).bit_count()) <= i:
            seen, byte = seen + count, byte + 1
        left, bit = i - seen, int(self.high[byte])
        for _ in range(left):
            bit &= bit - 1
        place = 8 * byte + (bit & -bit).bit_length() - 1
        return (place - i) << self.width | self._low(i)

    def _low(self, i: int) -> int:
        first = i * self.width
        data = int.from_bytes(self.low[first >> 3:(first + self.width + 7 >> 3)].tobytes(), "little")
        return data >> (first & 7) & (1 << self.width) - 1

    def all(self) -> np.ndarray:
        """All values at once, for a scan."""
        places = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        high = (places - np.arange(self.n)).astype(np.uint64) << np.uint64(self.width)
        bits = np.unpackbits(self.low, bitorder="little")[:self.n * self.width].reshape(self.n, self.width)
        return high | (bits.astype(np.uint64) << np.arange(self.width, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def to_bytes(self) -> bytes:
        parts = self.low.tobytes(), self.high.tobytes(), self.samples.tobytes()
        return struct.pack("<QBQQQ", self.n, self.width, *map(len, parts)) + b"".join(parts)

    @classmethod
    def from_bytes(cls, data: memoryview) -> tuple[EliasFano, int]:
        """The sequence at the start of `data` and the bytes it takes."""
        n, width, *sizes = struct.unpack_from("<QBQQQ", data)
        at = struct.calcsize("<QBQQQ")
        low = np.frombuffer(data, np.uint8, sizes[0], at)
        high = np.frombuffer(data, np.uint8, sizes[1], at + sizes[0])
        samples = np.frombuffer(data, "<u4", sizes[2] // 4, at + sizes[0] + sizes[1]).reshape(-1, 2)
        return cls(n, width, low, high, samples), at + sum(sizes)


def shard_bytes(keys: np.ndarray, known: np.ndarray, lengths: np.ndarray, ids: bytes, item: int) -> bytes:
    """One file: header, keys (NULL ones are flagged), boundaries, then the ids as `item`-byte little-endian integers."""
    bounds = EliasFano.encode(np.concatenate([[0], np.cumsum(lengths)])).to_bytes()
    keys = keys.astype("<i8").tobytes() + np.packbits(known).tobytes()
    return struct.pack(HEADER, MAGIC, len(lengths), len(bounds), len(ids), item, 0) + keys + bounds + ids


class Shard:
    """A file read back: `ids(i)` by select, `bounds` for a scan."""

    def __init__(self, data: bytes):
        magic, self.n, bound_size, _, item, _ = struct.unpack_from(HEADER, data)
        assert magic == MAGIC, "not a token file"
        view, at = memoryview(data), struct.calcsize(HEADER)
        self.keys = np.frombuffer(view, "<i8", self.n, at)
        at += 8 * self.n
        flags = (self.n + 7) // 8
        self.known = np.unpackbits(np.frombuffer(view, np.uint8, flags, at), count=self.n).astype(bool)
        at += flags
        self.bounds, _ = EliasFano.from_bytes(view[at:at + bound_size])
        self.data = np.frombuffer(view, f"<u{item}", offset=at + bound_size)

    def ids(self, i: int) -> np.ndarray:
        return self.data[self.bounds.select(i):self.bounds.select(i + 1)]


class Encoder:
    """Byte-level BPE with a bounded memory of words; texts become ids of `item` little-endian bytes.

    The pre-tokenizer ends every piece before a space and puts a single line feed on its own. So texts whose only white
    space are single spaces and line feeds are looked up word by word. Words not seen yet are encoded together, one to a
    line, letters apart from the punctuation behind them. Texts with other white space are encoded whole. With `added_tokens` the text of an added token (such as
    <|endoftext|>) becomes its id, as the library does by default, and texts that hold one are encoded whole, too; without
    it special tokens are text like any other.
    """

    def __init__(self, path: str, item: int, added_tokens: bool = False):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added_tokens
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if added_tokens else []
        assert not any("\n" in t for t in self.added), "words are encoded one to a line"
        self.kind = f"<u{item}"
        self.line = np.array(self.fresh("\n"), self.kind)
        assert len(self.line) == 1, "a line feed must be one id"
        #: Ids of words at the start of a line and behind a space, kept for later tasks of the same worker: those used
        #: lately, and those used before them.
        worker = sys.modules.setdefault("touchline_words", ModuleType("touchline_words")).__dict__
        self.known = worker.setdefault((path, item), [[{}, {}], [{}, {}]])
        self.tails: dict[str, bytes] = {}

    def fresh(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def recall(self, words: Iterable[str], spaced: int) -> list[str]:
        """Move what the older memory knows of these words to the newer one; return the others."""
        words, (known, before) = list(words), self.known[spaced]
        old = list(map(before.get, words))
        known.update(pair for pair in zip(words, old) if pair[1] is not None)
        return [w for w, x in zip(words, old) if x is None]

    def learn(self, words: list[str], spaced: int) -> None:
        """Put words that are not in the newer memory there."""
        known = self.known[spaced][0]
        new = self.recall(words, spaced)
        tailed = {w: m.groups() for w in new if not w[-1].isalpha() and (m := TAILED(w))}
        letters = self.recall({letters for letters, _ in tailed.values()} - known.keys(), spaced)
        self.look_up(list(dict.fromkeys([w for w in new if w not in tailed] + letters)), known, spaced)
        self.look_up(list({tail for _, tail in tailed.values()} - self.tails.keys()), self.tails, 0)
        known.update((w, known[letters] + self.tails[tail]) for w, (letters, tail) in tailed.items())

    def look_up(self, words: list[str], into: dict[str, bytes], spaced: int) -> None:
        """Ids of words by the library, one word to a line."""
        for at in range(0, len(words), WORDS_AT_ONCE):
            some = words[at:at + WORDS_AT_ONCE]
            ids = np.array(self.fresh("\n".join([" " + w for w in some] if spaced else some)), self.kind)
            cut = np.flatnonzero(ids == self.line[0])
            data, size = ids.tobytes(), ids.itemsize
            for w, start, end in zip(some, [0, *(size * (cut + 1)).tolist()], [*(size * cut).tolist(), len(data)], strict=True):
                into[w] = data[start:end]

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        for words in self.known:
            if len(words[0]) > CACHE_WORDS:
                words[:] = {}, words[0]
        column = pa.array(texts, pa.large_string())
        plain = pa.compute.and_(pa.compute.not_equal(column, ""), pa.compute.invert(pa.compute.match_substring_regex(column, ODD_SPACES)))
        plain = [bool(p) and not any(a in t for a in self.added) for t, p in zip(texts, plain.to_pylist())]
        by_words = iter(self.by_words(column.filter(pa.array(plain, pa.bool_()))))
        return [next(by_words) if p else np.array(self.fresh(t), self.kind).tobytes() if t else b"" for t, p in zip(texts, plain)]

    def by_words(self, texts: pa.Array) -> list[bytes]:
        """Ids of texts with plain spaces: distinct words are looked up once, then their ids are gathered in text order."""
        if not len(texts):
            return []
        lines = pa.compute.split_pattern(texts, "\n")
        words = pa.compute.split_pattern(lines.flatten(), " ")
        text_lines, line_words = lines.offsets.to_numpy(), words.offsets.to_numpy()
        coded = words.flatten().dictionary_encode()
        distinct, place = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        # A word behind a space has the number of the distinct word, one at the start of a line that plus their count.
        place[line_words[:-1]] += len(distinct)
        used = np.zeros(2 * len(distinct) + 1, bool)
        used[place] = True
        ids: list[bytes] = []
        for spaced, some in ((1, used[:len(distinct)]), (0, used[len(distinct):-1])):
            names = distinct.filter(pa.array(some)).to_numpy(zero_copy_only=False).tolist()
            got = list(map(self.known[spaced][0].get, names))
            if None in got:
                self.learn([w for w, x in zip(names, got) if x is None], spaced)
                got = map(self.known[spaced][0].__getitem__, names)
            ids += got
        ids.append(self.line.tobytes())
        used[-1] = True
        # The line feed goes before every line but the first of a text.
        inner = np.ones(len(line_words) - 1, bool)
        inner[text_lines[:-1]] = False
        number = np.cumsum(used) - 1
        order = number[np.insert(place, line_words[:-1][inner], len(used) - 1)]
        feeds = np.concatenate([[0], np.cumsum(inner)])
        cuts = line_words[text_lines] + feeds[text_lines]
        out = pa.array(ids, pa.large_binary()).take(pa.array(order))
        ends, data = np.frombuffer(out.buffers()[1], np.int64)[cuts], memoryview(out.buffers()[2])
        return [data[a:b].tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}" if uri.startswith("/") else uri.replace("file:/", "file:///", 1))


def write_tokens(docs: DataFrame, vocabulary: str, folder: str | None = None, key: str = "doc_id", text: str = "text",
                 end_id: int = 0, id_bytes: int = 2, added_tokens: bool = False) -> DataFrame:
    """Write the ids of all texts in ascending key order; return the manifest: shard, path, docs, ids.

    The rows are dealt out by ranges of key and text, so shard k holds keys before those of shard k + 1 and no task sees more
    than its range; there are as many ranges as the measured length of all texts asks for. Each text is followed by `end_id`; NULL texts are empty; NULL keys come first; rows with equal keys are
    in the order of their texts. Every attempt of a task writes a file of its own and the manifest names the one that
    counted, so lost executors leave unused files at most. An empty table has an empty manifest. With `added_tokens` texts
    of added tokens become their ids.
    """
    folder = folder or scratch_dir(docs.sparkSession, "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, keys, known, lengths, parts = Encoder(vocabulary, id_bytes, added_tokens), [], [], [], []
        end = np.array([end_id], f"<u{id_bytes}").tobytes()
        for part in slices(batches, "text", TEXT_AT_ONCE):
            keys.append(part.column("id").fill_null(0).to_numpy())
            known.append(part.column("id").is_valid().to_numpy(zero_copy_only=False))
            for ids in encode(part.column("text").to_pylist()):
                lengths.append(len(ids) // id_bytes + 1)
                parts += ids, end
        if not lengths:
            return
        shard = TaskContext.get().partitionId()
        disk, base = opened(folder)
        disk.create_dir(base, recursive=True)
        path = f"{base}/{shard:06d}-{uuid.uuid4().hex}.tok"
        with disk.open_output_stream(path) as out:
            out.write(shard_bytes(np.concatenate(keys), np.concatenate(known), np.array(lengths), b"".join(parts), id_bytes))
        yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [path], "docs": [len(lengths)], "ids": [sum(lengths)]})

    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_TEXT_BYTES))
    # The first characters of the text part the rows of one key and do not contradict the order of whole texts.
    ranged = rows.repartitionByRange(shards, "id", F.substring("text", 1, 32)).sortWithinPartitions("id", "text")
    written = ranged.mapInArrow(run, "shard long, path string, docs long, ids long").collect()  # one row per file
    return spark.createDataFrame(sorted(written), "shard long, path string, docs long, ids long").coalesce(1) if written else \
        spark.createDataFrame([], "shard long, path string, docs long, ids long")


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """Read the files back: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    Starts inside a file come from the encoded boundaries, those of the files from the sums over the manifest.
    """
    files, start = [], 0
    for f in sorted(manifest.collect()):  # one row per file
        files.append((f["path"], start))
        start += f["ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        disk, _ = opened(folder)
        for batch in batches:
            for path, first in zip(batch.column("path").to_pylist(), batch.column("first").to_pylist()):
                with disk.open_input_stream(path) as stream:
                    shard = Shard(stream.read())
                bounds = shard.bounds.all().astype(np.int64)
                crcs = [zlib.crc32(shard.data[a:b].astype("<u4").tobytes()) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.keys, mask=~shard.known), pa.array(first + bounds[:-1]), pa.array(np.diff(bounds)),
                     pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    spark = manifest.sparkSession
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not files:
        return spark.createDataFrame([], schema)
    return (spark.createDataFrame(files, "path string, first long").repartition(len(files), "path")
            .mapInArrow(run, schema))
