"""Token files and pieces against the libraries, Viterbi against brute force, and the pipeline's stages."""

import itertools
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from touchline.llm import pieces, queries, tokens
from touchline.session import scratch_dir

TEXTS = ["Hello there  world", "a\n\nb \n c", " lead", "trail ", "tab\there", "", None, "<|endoftext|> <s> ▁ x", "ça va? 日本語 😀 ².",
         "one", "x" * 3_000, "word " * 20_000, "one", "a\x85b\xa0c\x1cd", "'tis don't 12,345.67\r\nend\n"]


def test_elias_fano():
    rng = np.random.default_rng(1)
    for values in ([0], [0, 0, 0], [5], [0, 1 << 40], np.cumsum(rng.integers(0, 5000, 3000)), np.repeat([3, 9, 1000], 200)):
        coded, size = tokens.EliasFano.from_bytes(memoryview(tokens.EliasFano.encode(np.array(values)).to_bytes()))
        assert [coded.select(i) for i in range(len(values))] == list(values) == coded.all().tolist()
    n, top = 3000, 7_500_000
    coded = tokens.EliasFano.encode(np.sort(rng.integers(0, top, n)))
    assert 8 * (len(coded.low) + len(coded.high)) < n * (2 + np.log2(top / n)) + n
    assert tokens.EliasFano.encode(np.zeros(0, np.int64)).all().tolist() == []


def test_token_files_equal_the_library(spark):
    from tokenizers import Tokenizer
    path = queries.vocabulary("byte_bpe_50k.json")
    rows = [(100 - i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "null key", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, id string").repartition(3)
    folder = scratch_dir(spark, "test")
    manifest = tokens.write_tokens(frame, path, folder)
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in tokens.read_tokens(manifest, folder).collect()}
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    start, want = 0, {}
    for key, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        want[key] = start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert got == want
    disk, name = tokens.opened(folder)
    first = manifest.orderBy("shard").first()
    with disk.open_input_stream(first["path"]) as stream:
        shard = tokens.Shard(stream.read())
    assert [len(shard.ids(i)) for i in range(shard.n)] == np.diff(shard.bounds.all().astype(int)).tolist()
    assert tokens.read_tokens(tokens.write_tokens(frame.limit(0), path, folder), folder).count() == 0


def test_token_query_equals_the_library_as_it_is(spark, tmp_path):
    from tokenizers import Tokenizer
    texts = [*TEXTS, "x <|endoftext|> y", "a<|endoftext|>b\nc", "<|endoftext", "plain words"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in queries.QUERIES["op7_token_files"](spark, str(tmp_path)).collect()}
    library, start, want = Tokenizer.from_file(queries.vocabulary("byte_bpe_50k.json")), 0, {}
    assert library.encode("x <|endoftext|> y", add_special_tokens=False).ids == [87, 220, 50256, 331]
    for key, text in enumerate(texts):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        want[key] = start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert got == want


@pytest.mark.parametrize("hot", [pieces.HOT_UNITS, 3])
def test_pieces_equal_the_library(spark, monkeypatch, hot):
    import sentencepiece
    monkeypatch.setattr(pieces, "HOT_UNITS", hot)
    path = queries.vocabulary("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = list(enumerate(TEXTS)) + [(None, "null key"), (3, TEXTS[3])]
    frame = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, n int").repartition(3)
    out = pieces.encode(frame, path)
    got = sorted(((r["doc_id"], list(r["ids"]), r["n_tokens"]) for r in out.collect()), key=str)
    want = sorted(((k, library.encode(t or ""), len(library.encode(t or ""))) for k, t in rows), key=str)
    assert got == want
    if hot > 3:
        back = pieces.decode(out, path).collect()
        assert all(r["text"] == (TEXTS[r["doc_id"]] or "") for r in back if r["doc_id"] is not None and "▁" not in (TEXTS[r["doc_id"]] or ""))
        assert all(r["round_trip"] for r in back if r["doc_id"] != 7)
        assert pieces.encode(frame.limit(0), path).count() == 0


def test_units_are_cut_where_no_piece_goes_on():
    import pyarrow as pa
    rng = random.Random(5)
    pairs = {"▁a", "▁▁", "ab", "é日", "\U0001f600b", "b\n"}
    texts = ["".join(rng.choices("ab é日\U0001f600\nz▁", k=rng.randint(0, 12))) for _ in range(300)] + [None, "", " ", "  "]
    want = []
    for t in texts:
        marked = "▁" + t.replace(" ", "▁") if t else ""
        cuts = [i for i in range(len(marked)) if not i or marked[i - 1:i + 1] not in pairs]
        want.append([marked[a:b] for a, b in zip(cuts, [*cuts[1:], len(marked)])])
    units, starts = pieces.Cutter(pairs)(pa.array(texts).slice(0))
    got = units.to_pylist()
    assert [got[a:b] for a, b in zip(starts[:-1], starts[1:])] == want
    units, starts = pieces.Cutter(set())(pa.array(texts[5:9], pa.string()))
    assert units.to_pylist() == list("".join("▁" + t.replace(" ", "▁") if t else "" for t in texts[5:9])) and starts[-1] == len(units)
    units, starts = pieces.Cutter(pairs)(pa.array([None, ""], pa.string()))
    assert len(units) == 0 and starts.tolist() == [0, 0, 0]


@pytest.mark.parametrize("hot", [0, 2, 9])
def test_texts_are_put_together_from_hot_and_rare_units(hot):
    import pyarrow as pa
    ids = {"▁a": [5, 0], "▁b": [0], "▁": [7], "▁c": [], "z": [0, 0]}
    pairs, texts = {"▁a", "▁b", "▁c"}, ["a b", None, "", "b az", "c", "zz b"]
    held_units = [u.encode() for u in sorted(ids, key=lambda u: pieces.xxhash.xxh64_intdigest(u.encode(), 42)) if len(ids) <= hot or u in list(ids)[:hot]]
    held = pieces.Hot(np.array([pieces.xxhash.xxh64_intdigest(u, 42) for u in held_units], np.uint64), np.array([zlib.crc32(u) for u in held_units], np.uint32),
                      np.cumsum([0, *[len(ids[u.decode()]) for u in held_units]]), np.array([i for u in held_units for i in ids[u.decode()]], np.uint16))
    table = pieces.Vocabulary([(i, p, 0.0) for i, p in enumerate(sorted(pairs))], [], 0, 9, True)
    maker, column = pieces.Assembler(held, table), pa.array(texts)
    maker.lone = ids.__getitem__
    rare = maker.rare(column).to_pylist()
    assert set(rare) == set(ids) - set(list(ids)[:hot])
    plain = [[i for u in pieces.Cutter(pairs)(pa.array([t]))[0].to_pylist() for i in ids[u]] if t else [] for t in texts]
    kind = pa.schema([("unit", pa.large_string()), ("ids", pa.large_list(pa.int32()))])
    for given in (rare, rare[1:], []):  # units that a task lacks are merged by itself
        lists = pa.table({"unit": given, "ids": [ids[u] for u in given]}, kind)
        for merge_id in (None, 0):
            maker.merge_id = merge_id
            got, ends = maker.ids(column, lists)
            want = [[i for k, i in enumerate(x) if merge_id is None or i or not k or x[k - 1]] for x in plain]
            assert [got[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == want


@pytest.mark.parametrize("known_bytes", [[], list(range(100, 356))])
def test_viterbi_equals_all_segmentations(spark, known_bytes):
    rng = random.Random(3)
    names = sorted({"".join(rng.choices("abc", k=rng.randint(1, 4))) for _ in range(30)} | {"a", "b"})
    table = pieces.Vocabulary([(i, p, -rng.random() * len(p)) for i, p in enumerate(names)], known_bytes, 99, 400, False)
    units = sorted({"".join(rng.choices("abc", k=rng.randint(1, 9))) for _ in range(40)} | {"azb", "é"})
    frame = spark.createDataFrame([(u, 1) for u in units], "unit string, n long")
    got = {r["unit"]: list(r["ids"]) for r in pieces.lattice(frame, table).collect()}
    score, low = {p: s for _, p, s in table.pieces}, min(s for *_, s in table.pieces) - 10

    def total(ids, unit):
        by_id = {i: (p, s) for i, p, s in table.pieces}
        if known_bytes:
            plain = [i for i in ids if i < 100]
            strange = [c for c in unit if c not in score]
            return sum(by_id[i][1] for i in plain) + low * len(strange)
        return sum(by_id[i][1] if i in by_id else low for i in ids)
    for u in units:
        best = max(sum(score.get(u[a:b], low) for a, b in zip((0, *cut), (*cut, len(u))))
                   for k in range(len(u)) for cut in itertools.combinations(range(1, len(u)), k)
                   if all(u[a:b] in score or b == a + 1 for a, b in zip((0, *cut), (*cut, len(u)))))
        assert total(got[u], u) == pytest.approx(best)
        assert total(pieces.by_heap(u, table), u) == pytest.approx(best)


def test_stages_keep_clean_documents_and_their_columns(spark, tmp_path):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(2, 8)))
    text = lambda n: "\n".join(" ".join(word() for _ in range(12)) for _ in range(n))
    item = " ".join(word() for _ in range(40))
    clean = [(i, text(8), "en", "s", 0) for i in range(40)]
    bad = [(100, clean[3][1], "en", "s", 0), (101, f"{text(3)} {item} {text(3)}", "en", "s", 0), (102, "123 !!", "en", "s", 0), (103, None, None, None, None)]
    spark.createDataFrame(clean + bad, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns, name
        docs = docs.checkpoint()
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert {i: kept[i] for i, *_ in clean} == {i: t for i, t, *_ in clean}
    assert {101, 102, 103}.isdisjoint(kept) and kept.get(100, "") == ""
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in out.select("doc_id").collect()} == set(kept)
    assert out.filter(~F.col("round_trip")).count() == 0


def test_cutting_takes_little_memory(monkeypatch):
    pairs, texts = {"ab", "bc", "ca"}, pa.array(["abc cab xyz " * 100_000, "é", None])
    tracemalloc.start()
    units, starts = pieces.Cutter(pairs)(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 33 * len(texts[0].as_py())  # bytes for each byte of text
    monkeypatch.setattr(pieces, "TABLE_PAIRS", 0)
    again, same = pieces.Cutter(pairs)(texts)
    assert again.equals(units) and (same == starts).all()
