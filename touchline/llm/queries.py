"""The registered queries of the operators, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.chats import as_log, digests, format_log
from touchline.llm.language import identify, learn
from touchline.llm.leaks import leaks
from touchline.llm.lines import drop_lines
from touchline.llm.pages import extract
from touchline.llm.pieces import encode
from touchline.llm.privacy import pseudonymise
from touchline.llm.resampling import resample
from touchline.llm.runs import find_runs, repeated, word_count
from touchline.llm.shared import crc32_of_id, read, stored
from touchline.llm.simhash import simhash_groups
from touchline.llm.tokens import read_tokens, write_tokens
from touchline.llm.toxicity import score, train
from touchline.llm.vectors import near_vectors
from touchline.session import scratch_dir

#: A key that is no secret; users of the operator pass their own.
DEMONSTRATION_KEY = b"demonstration key"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op7_token_files(spark, sf_dir):
    folder = scratch_dir(spark, "tokens")
    manifest = write_tokens(read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), folder, added_tokens=True)
    return read_tokens(manifest, folder)


@query
def op9_simhash(spark, sf_dir):
    return simhash_groups(read(spark, sf_dir, "documents"))


@query
def op10_toxicity(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    model = train(docs, read(spark, sf_dir, "labels"), crc32_of_id() % 5 != 0)
    return score(docs, model).select("doc_id", (crc32_of_id() % 5 == 0).alias("held_out"), "score",
                                     (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op5_language(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    languages = learn(docs, crc32_of_id() % 3 != 1)
    return identify(docs, languages).select("doc_id", (crc32_of_id() % 3 == 1).alias("held_out"), "lang_pred", "score")


@query
def op3_near_vectors(spark, sf_dir):
    return near_vectors(read(spark, sf_dir, "embeddings"))


@query
def op1_main_text(spark, sf_dir):
    return extract(read(spark, sf_dir, "pages"))


@query
def op8_line_dedup(spark, sf_dir):
    out = drop_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lost", F.md5("text").alias("text_md5"), F.length("text").alias("n_chars"), "text")


@query
def op6_leaks(spark, sf_dir):
    return leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op2_pieces(spark, sf_dir):
    return encode(read(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query
def op4_pseudonyms(spark, sf_dir):
    out = pseudonymise(read(spark, sf_dir, "documents").select("doc_id", "text"), DEMONSTRATION_KEY)
    return out.select("doc_id", "n_values", "text")


@query
def op12_resampling(spark, sf_dir):
    out = resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def planted_repeats(docs: DataFrame) -> DataFrame:
    """About one document in ten, by the crc32 of its id, repeats its last words with some period."""
    h, n = F.col("_h"), F.col("_n")
    g = F.floor(h / 10)
    start, period = (g % n).cast("int"), (1 + F.floor((n - g % n) / (3 + g % 8))).cast("int")
    some = docs.select("doc_id", "text", crc32_of_id().alias("_h"))
    some = some.withColumn("_n", F.when(h % 10 == 0, word_count(F.col("text"))).otherwise(0).cast("long"))
    return some.select("doc_id", F.when(n > 0, repeated(F.col("text"), start, period)).otherwise(F.col("text")).alias("text"))


@query
def op11_runs(spark, sf_dir):
    found = find_runs(planted_repeats(read(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"),
                                                              (-r["period"]).alias("period"))))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return (found.withColumn("_best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_best.start")).alias("start"), "_best.length",
                    (-F.col("_best.period")).alias("period"),
                    F.expr("1000 * _best.length div -_best.period").alias("exponent_milli"),
                    F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
                    F.sha2("collapsed", 256).alias("collapsed_sha256")))


@query
def op13_chats(spark, sf_dir):
    control = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], "conv_id long, turn long, role string, text string")
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    return digests(stored(format_log(as_log(rows)), "chats"))
