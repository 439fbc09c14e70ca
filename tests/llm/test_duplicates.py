"""SimHash, lines, vectors and components against brute force, with odd rows."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from touchline.llm import lines, shared, simhash, vectors

WORDS = [f"w{i}" for i in range(60)]


def texts(n, seed=3):
    """Sentences, near copies of them and odd texts."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        words = rng.choices(WORDS, k=rng.randint(5, 60))
        out.append(" ".join(words))
        if rng.random() < 0.5:
            words[rng.randrange(len(words))] = "other"
            out.append(" ".join(words))
    return out + [out[0], out[0].upper(), "", " \n ", None, None, "one", "x " * 30_000, "é" * 2_000]


def groups_of(nodes, linked):
    label = {x: x for x in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            for x in (a, b):
                if label[x] != low:
                    label[x], changed = low, True
    return label


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (7, 7)]
    edges += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(70)]
    rng.shuffle(edges)
    frame = spark.createDataFrame([*edges, (None, 3), (5, None)], "a long, b long")
    got = {r["id"]: r["root"] for r in shared.components(frame).collect()}
    want = groups_of({x for e in edges for x in e}, edges)
    assert got == {x: r for x, r in want.items() if x != r}
    assert shared.components(frame.limit(0)).count() == 0


def print_of(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def test_simhash_equals_brute_force(spark):
    rows = [(i, t, "x") for i, t in enumerate(texts(40))]
    frame = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.simhash_groups(frame).collect()}
    prints = {i: print_of(t) for i, t, _ in rows}
    near = [(a, b) for a in prints for b in prints if (prints[a] ^ prints[b]).bit_count() <= 4]
    roots = groups_of(prints, near)
    assert got == {i: (f"{prints[i]:016x}", roots[i]) for i in prints}
    kept = simhash.drop_near_copies(frame)
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(roots.values()))


def test_ball_finds_all_pairs_within_the_radius(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(30)]
    prints = set(base)
    for f in base:
        for flips in (1, 2, 3, 4, 5):
            prints.add(f ^ sum(1 << b for b in rng.sample(range(64), flips)))
    signed = [(p - (1 << 64) * (p >> 63),) for p in prints]
    links = simhash.ball_links(spark.createDataFrame(signed, "fp long"))
    got = {r["id"]: r["root"] for r in shared.components(links).collect()}
    near = [(a[0], b[0]) for a in signed for b in signed if ((a[0] ^ b[0]) & (1 << 64) - 1).bit_count() <= 4]
    want = groups_of([s[0] for s in signed], near)
    assert got == {x: r for x, r in want.items() if x != r}


def test_simhash_with_null_keys_and_without_rows(spark):
    frame = spark.createDataFrame([(None, "a b"), (3, "a b"), (3, "a b"), (None, None)], "doc_id long, text string")
    got = sorted(map(tuple, simhash.simhash_groups(frame).select("doc_id", "component_id").collect()), key=str)
    assert got == [(3, 3), (3, 3), (None, 3), (None, None)]
    assert simhash.simhash_groups(frame.limit(0)).count() == 0
    assert simhash.drop_near_copies(frame).count() == 4


def words_of(line):
    fold = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    return tuple(w for w in re.split(r"[ \t\n\r\x0b\x0c]+", line.translate(fold)) if w)


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) < lines.LEAST_WORDS or len(a) - len(b) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(a[:k] + a[k + 1:] == b for k in range(len(a)))


def cut_by_hand(docs):
    first = {}
    for d, t in docs:
        for i, line in enumerate((t or "").split("\n")):
            first.setdefault(words_of(line), (d, i))
    first.pop((), None)
    near = {a for a in first for b in first if first[b] < first[a] and one_edit(a, b)}
    out = {}
    for d, t in docs:
        seen, kept = set(), []
        for line in (t or "").split("\n"):
            w = words_of(line)
            if w and (w in near or first[w][0] != d or w in seen):
                continue
            seen.add(w)
            kept.append(line)
        out[d] = None if t is None else "\n".join(kept)
    return out


def some_lines(n, seed):
    rng = random.Random(seed)
    pool = [rng.choices(WORDS[:12], k=rng.choice([1, 2, 4, 5, 5, 6, 9])) for _ in range(40)]
    docs = []
    for d in range(n):
        own = []
        for _ in range(rng.randint(0, 6)):
            line = list(rng.choice(pool))
            k = rng.randrange(len(line))
            change = rng.random()
            if change < 0.2:
                line[k] = rng.choice(WORDS[:12])
            elif change < 0.3:
                del line[k]
            elif change < 0.4:
                line.insert(k, rng.choice(WORDS[:12]))
            own.append(rng.choice([" ", "  "]).join(line) if rng.random() < 0.9 else " ".join(line).upper())
        docs.append((d, "\n".join(own)))
    return [*docs, (n, None), (n + 1, ""), (n + 2, "\n\n \n"), (n + 3, "a b c d e f\na b c d e f\na b x d e f"), (n + 4, "z " * 20_000)]


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_equal_brute_force(spark, seed):
    docs = some_lines(60, seed)
    frame = spark.createDataFrame([(d, t, 5, "k") for d, t in docs], "doc_id long, text string, id int, lost string")
    out = lines.drop_lines(frame)
    assert out.columns == [*frame.columns, "n_lost"]
    assert {r["doc_id"]: r["text"] for r in out.collect()} == cut_by_hand(docs)


def test_lines_with_equal_keys_null_keys_and_without_rows(spark):
    frame = spark.createDataFrame([(1, "a\nb"), (1, "a\nb"), (None, "a\nc"), (None, "c")], "doc_id long, text string")
    got = sorted((r["doc_id"] or 99, r["text"], r["n_lost"]) for r in lines.drop_lines(frame).collect())
    assert got == [(1, "a\nb", 0), (1, "a\nb", 0), (99, "c", 0), (99, "c", 1)]
    assert lines.drop_lines(frame.limit(0)).count() == 0


def test_many_survivors_take_the_shuffle_join(spark, monkeypatch):
    monkeypatch.setattr(lines, "BROADCAST_ROWS", 0)
    docs = some_lines(30, 7)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in lines.drop_lines(frame).collect()} == cut_by_hand(docs)


def test_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vectors, "CHUNK", 64)  # crowded filters, so that chunks meet in pairs
    rng = np.random.default_rng(2)
    base = rng.standard_normal((300, 24))
    near = base[0] + 0.12 * rng.standard_normal((250, 24))
    pairs = base[1:60] + 0.2 * rng.standard_normal((59, 24))
    rows = [[float(x) for x in v] for v in np.concatenate([base, near, pairs, base[5:9], base[5:9]])]
    n = len(rows)
    odd = [None, [0.0] * 24, [float("nan")] + [1.0] * 23, [float("inf")] * 24, [None] + [1.0] * 23, [1.0, 2.0], [2.0, 4.0], []]
    table = spark.createDataFrame([(i, v, "a") for i, v in enumerate(rows + odd)] + [(None, rows[5], "b")],
                                  "vec_id long, embedding array<double>, copies string")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vectors.near_vectors(table).collect()}
    unit = np.array(rows) / np.linalg.norm(rows, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.95
    links = [(int(a), int(b)) for a, b in zip(*np.nonzero(close)) if a != b] + [(n + 5, n + 6), (n + 6, n + 5)]
    want = groups_of(range(n + len(odd)), links)
    count = np.bincount([a for a, _ in links], minlength=n + len(odd))
    found = sum(got[i][0] for i in range(n + len(odd))) / len(links)
    assert found >= 0.99 and all(got[i][0] <= count[i] for i in range(n + len(odd)))
    assert np.mean([got[i][1] == want[i] for i in want]) >= 0.99
    assert all(got[i] == (0, i, True) for i in (n, n + 1, n + 2, n + 3, n + 4, n + 7)) and got[n + 6][:2] == (1, n + 5)
    assert got[None] == (0, None, True)
    assert vectors.near_vectors(table.limit(0)).count() == 0


def test_list_decoding_finds_all_directions_above_the_height():
    rng = np.random.default_rng(4)
    unit = rng.standard_normal((20, 40))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    rotation, parts, height = code = vectors.product_code(40, 2, 30)
    cut = parts[0].shape[1]
    turned = unit @ rotation
    for v, got in zip(turned, vectors.list_decode(unit, code)):
        score = (parts[0] @ v[:cut])[:, None] + parts[1] @ v[cut:]
        want = np.flatnonzero(score.ravel() >= height)
        assert len(got) >= vectors.LEAST_LIST and (len(want) < vectors.LEAST_LIST or got.tolist() == want.tolist())


def test_batches_are_cut_by_bytes(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(key)
    docs = spark.range(0, 3000, 1, 1).selectExpr("id AS doc_id", "repeat(concat('w', id), 600) AS text")
    lines.drop_lines(docs)
    sizes = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"size": [b.nbytes]}) for b in batches), "size long").collect()
    assert 1 < len(sizes) and max(r["size"] for r in sizes) <= shared.SLICE_BYTES
    spark.conf.set(key, "123456")
    lines.drop_lines(docs)
    assert spark.conf.get(key) == "123456"
    spark.conf.unset(key)
