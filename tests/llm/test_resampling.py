"""Importance resampling against a brute-force version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from touchline.llm import queries, resampling

TEXTS = ["Hello, wörld! hello", None, "", "---", "a", "a b", "x\x00y\x7fz É 日本語 12", "Word " * 40, "w" * 5_000 + " tail " * 30]


def words(text):
    small = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", small)


def grams(text):
    w = words(text)
    return [" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute(docs, target):
    s, t = Counter(), Counter()
    for table, count in ((docs, s), (target, t)):
        for _, text in table:
            count.update(zlib.crc32(g.encode()) % 10_000 for g in grams(text))
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for key, text in docs:
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000))))
                     for b in (zlib.crc32(g.encode()) % 10_000 for g in grams(text)))
        h = int(hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(grams(text)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = [r for r, (_, text) in zip(out, docs, strict=True) if len(words(text)) >= 20]
    able.sort(key=lambda r: (-r[3], r[0] is not None, r[0]))
    for rank, row in enumerate(able[:5 * len(able) // 100], 1):
        row[4] = rank
    return sorted(map(tuple, out), key=lambda r: (r[0] is not None, r[0], str(r)))


def tables(spark, tmp_path, docs, target):
    rows = [(*d, "clash", 1) for d in docs]
    spark.createDataFrame(rows, "doc_id long, text string, weight string, rank int").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(target, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = queries.QUERIES["op12_resampling"](spark, str(tmp_path))
    assert [t for _, t in got.dtypes] == ["bigint"] * 5 and got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return sorted(map(tuple, got.collect()), key=lambda r: (r[0] is not None, r[0], str(r)))


def test_resampling_equals_brute_force(spark, tmp_path):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)] + ["É", "naïve", "ß"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.choice([0, 5, 19, 20, 21, 80, 400]))) for _ in range(300)]
    docs = list(enumerate([*TEXTS, *texts])) + [(None, "no key " * 12), (5, "a b"), (5, "a b")]
    target = [(i, " ".join(rng.choices(vocabulary[:40], k=30))) for i in range(20)] + [(None, None)]
    assert tables(spark, tmp_path, docs, target) == brute(docs, target)


def test_empty_tables(spark, tmp_path):
    assert tables(spark, tmp_path / "a", [], [(1, "a")]) == []
    docs = [(i, f"some words {i} " * 10) for i in range(40)]
    got = tables(spark, tmp_path / "b", docs, [])
    assert got == brute(docs, []) and sum(r[4] is not None for r in got) == 2


def test_ranks_from_many_slices(spark, monkeypatch):
    monkeypatch.setattr(resampling, "MAX_GROUP_ROWS", 20)
    docs = [(i, "the same text " * 10) for i in range(400)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    out = resampling.draw(frame, frame.limit(1), percent=50).collect()
    assert sorted(r["rank"] for r in out) == list(range(1, 201)) and all(r["text"] for r in out)
    assert [r["score"] for r in sorted(out, key=lambda r: r["rank"])] == sorted((r["score"] for r in out), reverse=True)


def test_joined_crc():
    rng = np.random.default_rng(5)
    for size in (0, 1, 2, 7, 64, 1000, 70_000):
        a, b = rng.bytes(20), rng.bytes(size)
        got = resampling.joined_crc(np.array([zlib.crc32(a)], np.uint32), np.array([zlib.crc32(b)], np.uint32),
                                    np.array([size]), resampling.shift_tables(6))
        assert int(got[0]) == zlib.crc32(a + b)
