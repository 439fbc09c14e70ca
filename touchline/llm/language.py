"""Language identification by compression with one zstandard dictionary per language."""

from __future__ import annotations

import re
from functools import cached_property

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchline.llm.shared import bounded_batches, slices

#: Raw text of each language that becomes its dictionary, and the documents it is taken from, at most.
DICTIONARY_BYTES, SAMPLE_DOCS, SAMPLE_CHARS = 256 << 10, 400, 4_000
#: Dictionaries of all languages together take so many bytes at most.
ALL_BYTES = 64 << 20
#: Texts are encoded in pieces, so that what a long text has said before does not replace the dictionary.
PIECE_BYTES = 4_096
LEVEL = 6
#: Texts of at most so many bytes are encoded with more effort, which finds matches of three bytes.
SHORT_BYTES, SHORT_LEVEL = 400, 19
#: They follow so many bytes of the dictionary, which cost next to nothing: alone they might be stored as they are.
LEAD_BYTES = 512
#: A document is rejected if the second smallest encoding is larger by less than this share.
MARGIN = 0.005
UNKNOWN = "und"


NOT_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str) -> bytes:
    """The words of a text in small letters, one space between them: what the dictionaries and encoders see."""
    return f" {NOT_LETTERS.sub(' ', text.lower()).strip()} ".encode("utf-8", "surrogatepass")


class Languages:
    """The dictionaries, most frequent language first; carried to the tasks as bytes, digested once in each."""

    def __init__(self, texts: dict[str, bytes]):
        self.names = list(texts)
        self.texts = [texts[n] for n in self.names]

    def __getstate__(self):
        return {"names": self.names, "texts": self.texts}

    @cached_property
    def compressors(self) -> dict[int, list[zstandard.ZstdCompressor]]:
        out = {}
        for level in (LEVEL, SHORT_LEVEL):
            for text in self.texts:
                words = zstandard.ZstdCompressionDict(text, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                words.precompute_compress(level=level)
                out.setdefault(level, []).append(zstandard.ZstdCompressor(
                    dict_data=words, write_content_size=False, write_checksum=False, write_dict_id=False))
        return out

    def sizes(self, data: bytes) -> list[int]:
        """Bytes that the whole text takes with each dictionary."""
        if len(data) <= SHORT_BYTES:
            return [len(c.compress(text[-LEAD_BYTES:] + data)) for c, text in zip(self.compressors[SHORT_LEVEL], self.texts)]
        pieces = [data[i:i + PIECE_BYTES] for i in range(0, len(data), PIECE_BYTES)]
        return [sum([len(c.compress(p)) for p in pieces]) for c in self.compressors[LEVEL]]

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language with the smallest encoding and how much larger the next is, as a share from 0 to 1.

        Texts without a letter are unknown with 0; with a single language it is that, with 1; ties go to the
        language with more training rows.
        """
        if not text or not self.names or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        if len(self.names) == 1:
            return self.names[0], 1.0
        ranked = sorted(zip(self.sizes(letters(text)), range(len(self.names))))
        return self.names[ranked[0][1]], (ranked[1][0] - ranked[0][0]) / max(1, ranked[1][0])


def learn(docs: DataFrame, allowed: Column, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Languages:
    """One dictionary per value of `lang`, from a bounded sample of the rows for which `allowed` holds.

    Taken are texts with a letter, those of at most SAMPLE_CHARS characters first and among them those with the smallest
    hash of the key, until DICTIONARY_BYTES; of longer ones SAMPLE_CHARS characters from their first letter on. So every
    language with a letter in some allowed row is learned. Rows with NULL text, language or key teach nothing. Equal texts
    count once.
    """
    rows = docs.filter(allowed & F.col(text).isNotNull() & F.col(lang).isNotNull() & F.col(key).isNotNull())
    by_hash = W.partitionBy("lang").orderBy("long", F.xxhash64("id"), "id")
    # Long texts are cut from their first letter on, so that every slice has one.
    start = F.regexp_replace("text", r"^\P{L}+", "")
    fit = (rows.select(F.col(key).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
           .filter(F.col("text").rlike(r"\p{L}")).withColumn("long", F.length("text") > SAMPLE_CHARS)
           .withColumn("text", F.when(F.col("long"), F.substring(start, 1, SAMPLE_CHARS)).otherwise(F.col("text")))
           .withColumn("n", F.row_number().over(by_hash)).filter(F.col("n") <= SAMPLE_DOCS))
    texts: dict[str, list[bytes]] = {}
    for row in fit.orderBy("lang", "n").select("lang", "text").collect():  # SAMPLE_DOCS texts of bounded length per language
        texts.setdefault(row["lang"], []).append(letters(row["text"]))
    room = min(DICTIONARY_BYTES, ALL_BYTES // max(1, len(texts)))
    counts = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}  # one row per language
    return Languages({name: filled(list(dict.fromkeys(texts[name])), room) for name in sorted(texts, key=lambda n: (-counts[n], n))})


def filled(texts: list[bytes], room: int) -> bytes:
    """Whole texts while there is room, at least one."""
    out, size = [], 0
    for t in texts:
        if out and size + len(t) + 1 > room:
            continue
        out.append(t)
        size += len(t) + 1
    return b"".join(out)


def identify(docs: DataFrame, languages: Languages, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score) of every row over its whole text; the score is the margin."""
    def run(batches):
        for part in slices(batches, "text"):
            found = [languages.predict(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([x[0] for x in found], pa.string()),
                                              pa.array([x[1] for x in found], pa.float64())], ["id", "lang_pred", "score"])
    kind = docs.schema[key].dataType.simpleString()
    return (docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
            .mapInArrow(run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", key))


def keep_known(docs: DataFrame, languages: Languages, text: str = "text", margin: float = MARGIN) -> DataFrame:
    """The rows whose text has a language: not unknown and with at least `margin`. All columns stay as they are."""
    def run(batches):
        for part in slices(batches, text):
            found = [languages.predict(t) for t in part.column(text).to_pylist()]
            kept = part.filter(pa.array([name != UNKNOWN and score >= margin for name, score in found], pa.bool_()))
            if kept.num_rows:
                yield kept
    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
