"""Pages, languages, toxicity, personal data and leaks, with odd rows."""

import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from touchline.llm import language, leaks, pages, privacy, toxicity, wordhash
from touchline.llm.shared import crc32_of_id


def page(body, head=""):
    return f"<!doctype html><html><head><title>T</title>{head}</head><body>{body}</body></html>"


def test_declared_article():
    lines = pages.parse(page("""<nav><a href=/x>Menu</a></nav><header><h1>Site</h1></header><div class="cookie-notice">ok?</div>
        <article><header><h1>Big &amp; small&nbsp;<i>news</i></h1></header><p>One <b>two<br>three <p>four &lt;x&gt; <script>var a="</p>";</script>
        <div class="share-buttons">Share</div><aside>Beside</aside><ul><li>a<li>b</ul><!-- <p>no</p> --><form>Mail <input></form></article>
        <section id="comments"><p>Nice</p></section><footer>&copy; us</footer>""", "<style>p{}</style>"))
    assert pages.main_text(lines, []) == "Big & small news\nOne two three\nfour <x>\na\nb"


def test_neighbours_take_shared_lines_away_but_copies_do_not():
    own = [(0, x) for x in ("Home", "News", "My story", "It goes on", "Contact")]
    other = [(0, x) for x in ("Home", "News", "Another one", "Contact")]
    assert pages.main_text(own, [other]) == "My story\nIt goes on"
    assert pages.main_text(own, [own]) == "\n".join(t for _, t in own)
    assert pages.main_text(own, []) == "\n".join(t for _, t in own)


def test_common_lines_are_a_longest_subsequence():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(9))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        places = pages.common(a, b)
        rest = iter(b)
        assert len(places) == best[-1][-1] and places == sorted(places) and all(a[i] in rest for i in places)


def test_pages_are_paired_across_ranges(spark):
    rows = [(i, f"http://h.example/{i:04d}", page(f"<p>Menu<p>Story {i}<p>More of {i}<p>Foot")) for i in range(200)]
    rows += [(900, None, page("<p>Menu<p>Alone")), (901, "http://other.example/a", None), (902, "http://other.example/b", ""),
             (None, "mailto:x", "text only"), (5, rows[5][1], rows[5][2])]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = {(r["page_id"], r["url"]): (r["text"], r["n_chars"]) for r in pages.extract(frame).collect()}
    for i in range(200):
        text = f"Story {i}\nMore of {i}"
        assert got[i, rows[i][1]] == (text, len(text))
    assert got[900, None][0] == "Menu\nAlone" and got[901, "http://other.example/a"] == ("", 0)
    assert got[None, "mailto:x"][0] == "text only"
    assert pages.extract(frame).count() == len(rows) and pages.extract(frame.limit(0)).count() == 0


ALPHABETS = {"aa": "abcdefghil", "bb": "mnopqrtuvz", "cc": "eaklmnorst"}
LEXICON = {lang: ["".join(random.Random(i).choices(letters, k=2 + i % 8)) for i in range(150)] for lang, letters in ALPHABETS.items()}


def speech(lang, rng, n):
    return " ".join(rng.choices(LEXICON[lang], k=n))


def test_language_held_out(spark):
    rng = random.Random(1)
    rows = [(i, speech(lang := rng.choice(list(ALPHABETS)), rng, rng.randint(3, 80)), lang, 1) for i in range(400)]
    odd = [(1000, None, "aa", 1), (1001, "", "aa", 1), (1002, "12 !?", "bb", 1), (None, "some", None, 1), (1003, speech("bb", rng, 20_000), "bb", 1)]
    frame = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, score int")
    known = language.learn(frame, crc32_of_id() % 3 != 1)
    assert sorted(known.names) == ["aa", "bb", "cc"]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(frame, known).collect()}
    held = [(i, lang) for i, _, lang, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([got[i][0] == lang for i, lang in held]) > 0.97
    assert all(got[i] == ("und", 0.0) for i in (1000, 1001, 1002)) and got[1003][0] == "bb"
    assert all(0 <= s <= 1 for _, s in got.values())
    kept = language.keep_known(frame, known)
    assert kept.columns == frame.columns and {1000, 1001, 1002}.isdisjoint(r["doc_id"] for r in kept.collect())
    nobody = language.learn(frame.limit(0), F.lit(True))
    assert nobody.names == [] and nobody.predict("abc") == ("und", 0.0)
    assert language.keep_known(frame.limit(0), known).count() == 0


def test_language_with_long_documents_only(spark):
    rng = random.Random(2)
    rows = [(i, speech("aa", rng, 60), "aa") for i in range(30)] + [(100 + i, "1 2 " * 2_000 + speech("bb", rng, 3_000), "bb") for i in range(3)]
    known = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    assert sorted(known.names) == ["aa", "bb"]
    assert [known.predict(speech(lang, rng, 40))[0] for lang in ("aa", "bb")] == ["aa", "bb"]


def test_toxicity_held_out(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "BITS", 14)
    monkeypatch.setattr(toxicity, "STEPS", 6)
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(300):
        toxic = i % 4 == 0
        words = rng.choices(["good", "day", "river", "stone", "walks", "green"], k=rng.randint(5, 30))
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["stupid", "idiot", "trash"])
        rows.append((i, " ".join(words), "en"))
        labels.append((i, int(toxic)))
    rows += [(500, None, "en"), (501, "", "en"), (None, "you idiot", None), (502, "good " * 40_000, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string")
    labels = spark.createDataFrame([*labels, (0, 1), (None, 1), (7, None), (999, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, crc32_of_id() % 5 != 0)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i] >= 0.5) == (i % 4 == 0) for i in held]) > 0.95
    assert got[500] == got[501] < 0.5 < got[None] and all(0 <= s <= 1 for s in got.values())
    one = toxicity.train(docs, labels.filter("toxic = 0"), F.lit(True))
    assert {r["score"] for r in toxicity.score(docs, one).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), toxicity.train(docs, labels.limit(0), F.lit(True))).count() == 0


def test_grams_are_distinct_and_stay_inside_a_text():
    import pyarrow as pa
    last = np.zeros(1 << toxicity.BITS, np.int32)
    alone = [next(toxicity.grams(pa.array([t]), last)) for t in ("ABC abc abc", "", "zz")]
    together = list(toxicity.grams(pa.array(["ABC abc abc", None, "zz"]), last))
    assert [sorted(x.tolist()) for x in alone] == [sorted(x.tolist()) for x in together]
    assert all(len(set(x.tolist())) == len(x) for x in together)


VALUES = ["joe.72@mail3.example.com", "+1 (728) 555-4515", "4041894974608795", "4041-8949-7460-8795", "42.144.35.254", "123-45-6789",
          "2024-02-29", "31/12/1999", "2/29/2000", "12 March 2020", "GB82 WEST 1234 5698 7654 32",
          "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde", "(017) 555-7713", "+491701234567"]


@pytest.mark.parametrize("value", VALUES)
def test_pseudonyms_keep_their_format_and_can_be_undone(value):
    p = privacy.Permuter(b"key")
    text = f"so {value}, and"
    new, n = privacy.replace(text, p)
    assert n == 1 and value not in new
    assert new == privacy.replace(text, privacy.Permuter(b"key"))[0] != privacy.replace(text, privacy.Permuter(b"other"))[0]
    again, m = privacy.replace(new, p, -1)
    assert m == 1 and (again == text or "/" in value)
    if value[0] not in "g2+1":
        assert [c.isdigit() for c in new][:4] == [c.isdigit() for c in text][:4]


def test_numbers_that_fail_their_check_stay():
    p = privacy.Permuter(b"key")
    for text in ("4041894974608796", "999.1.1.1", "000-12-3456", "2023-02-30", "GB82 WEST 1234 5698 7654 33", "version 3.0", "12345", "a@b"):
        assert privacy.replace(text, p) == (text, 0)


@pytest.mark.parametrize("value, beside", [
    ("4111 1111 1111 1111", " 12/25"), ("4111111111111111", " 123"), ("4111 1111 1111 1111", " 123 x"), ("BE68 5390 0754 7034", " EUR 5"),
    ("BE68 5390 0754 7034", " BANK OK"), ("GB82 WEST 1234 5698 7654 32", " GBP")])
def test_values_with_a_group_behind_them(value, beside):
    p = privacy.Permuter(b"key")
    alone, _ = privacy.replace(value, p)
    assert alone != value and privacy.replace(f"pay {value}{beside}", p) == (f"pay {alone}{beside}", 1)
    assert privacy.replace(f"no 12 {value}, {value}{beside}", p) == (f"no 12 {alone}, {alone}{beside}", 2)


def test_groups_of_a_number_that_fails_are_no_telephone_numbers():
    for text in ("4041 8949 7460 8796", "GB82 WEST 1234 5698 7654 33", "4041 8949 7460 8796 12/25"):
        assert privacy.replace(text, privacy.Permuter(b"key")) == (text, 0)


def test_permutations_move_every_number():
    p = privacy.Permuter(b"key")
    for n in (2, 3, 10, 97, 260):
        moved = [p.move(x, n, "t") for x in range(n)]
        assert sorted(moved) == list(range(n)) and all(a != b for a, b in enumerate(moved))
        assert [p.move(x, n, "t", -1) for x in moved] == list(range(n))


def test_pseudonyms_link_documents(spark):
    rows = [(1, "call (017) 555-7713", 1.5), (2, "again (017) 555-7713!", None), (3, None, 2.0), (None, "", 1.0), (4, "none " * 30_000, 0.0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_values double")
    out = privacy.pseudonymise(frame, b"key")
    got = {r["doc_id"]: r for r in out.collect()}
    assert got[1]["text"][5:] == got[2]["text"][6:-1] != "(017) 555-7713"
    assert [got[k]["n_values"] for k in (1, 2, 3, None, 4)] == [1, 1, 0, 0, 0] and got[3]["text"] is None and got[4]["text"] == rows[4][1]
    assert privacy.pseudonymise(frame.limit(0), b"key").count() == 0


def test_runs_of_words_hash_alike_wherever_they_are():
    import pyarrow as pa
    w = wordhash.words_of(pa.array(["the Cat sat", None, "x\n\nthe cat  SAT down", ""]))
    a, b = np.array([0, 4]), np.array([3, 7])
    assert len(set(w.poly(a, b).tolist())) == 1 and w.text.tolist() == [0, 0, 0, 2, 2, 2, 2, 2] and w.line.tolist() == [0, 0, 0, 0, 2, 2, 2, 2]


def sentence(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 7))) for _ in range(n))


def test_leaks_found_and_clean_documents_left_alone(spark):
    rng = random.Random(3)
    items = [(i, sentence(rng, rng.choice([10, 20, 35, 60])) + ". " + sentence(rng, 6) + ".") for i in range(20)]
    docs, leaked = [], {}
    for d in range(200):
        text = sentence(rng, rng.randint(20, 300))
        if d % 4 == 0:
            i = rng.randrange(20)
            words = items[i][1].split()
            if d % 8 == 0:
                for _ in range(len(words) // 10):
                    words[rng.randrange(len(words) - 8)] = "changed"
            text = f"{text[:150]} {' '.join(words).upper() if d % 12 == 0 else ', '.join(words)} {text[150:]}"
            leaked[d] = i
        docs.append((d, text))
    docs += [(500, None), (501, ""), (502, "word"), (None, items[3][1]), (503, "long " * 20_000 + items[4][1])]
    leaked |= {503: 4, None: 3}
    frame = spark.createDataFrame([(d, t, "c", 0) for d, t in docs], "doc_id long, text string, item string, id int")
    bench = spark.createDataFrame([*items, (90, None), (91, ""), (92, " . ")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in leaks.leaks(frame, bench).collect()}
    assert got == set(leaked.items())
    kept = leaks.drop_leaks(frame, bench)
    assert kept.columns == frame.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _ in docs} - set(leaked) | {None}
    assert leaks.leaks(frame, bench.limit(0)).count() == leaks.leaks(frame.limit(0), bench).count() == 0


@pytest.mark.parametrize("known", [0, 1])
def test_leaks_below_the_cosine(known):
    """Paraphrases with 62 % of the words and the whole answer, and short items, whatever the latent space says of them."""
    rng, terms = random.Random(5), 1 << leaks.TERM_BITS
    weight = [1 / (k + 1) for k in range(3_000)]
    speak = lambda n: [f"w{k}x" for k in rng.choices(range(3_000), weight, k=n)]
    items, docs = {}, []
    for i in range(300):
        body, answer = speak(rng.randint(20, 50) if i % 2 else rng.randint(3, 5)), speak(3)
        items[i] = f"{' '.join(body)}. {' '.join(answer)}."
        if i % 2:  # other words take the place of some
            size = len(body) + 3
            lost = set(rng.sample(range(len(body)), size - -(-62 * size // 100)))
            body = [f"other{rng.randrange(10 ** 6)}" if k in lost else w for k, w in enumerate(body)]
        docs.append(" ".join(speak(rng.randint(0, 300)) + body + answer + speak(rng.randint(0, 300))))
    rows = [{"item": i, "text": t} for i, t in items.items()]
    basis = np.random.default_rng(1).standard_normal((terms, 4)).astype(np.float32) * known
    space = leaks.Latent(np.ones(terms), basis)
    batch = pa.RecordBatch.from_pydict({"id": list(range(300)), "text": docs})
    found = [r for out in leaks.search(space, rows, items)(iter([batch])) for r in out.to_pylist()]
    assert {(i, i) for i in range(300)} <= {(r["id"], r["item"]) for r in found}
    assert all(r["common"] >= leaks.LEAK or r["common"] >= leaks.PARAPHRASE and r["answer"] >= leaks.ANSWER for r in found)


def test_more_passages_than_a_block_holds(spark, monkeypatch):
    monkeypatch.setattr(leaks, "PASSAGES_AT_ONCE", 5)
    rng = random.Random(6)
    items = [(i, sentence(rng, 25)) for i in range(12)]
    docs = spark.createDataFrame([(i, f"{sentence(rng, 30)} {t} {sentence(rng, 30)}") for i, t in items], "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in leaks.leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(i, i) for i in range(12)}


def test_subsequence():
    rng = random.Random(4)
    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(12))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        got = leaks.subsequence(leaks.places_of(a), len(a), b)
        assert got == best[-1][-1] and leaks.subsequence(leaks.places_of(a), len(a), b, got) == got


ARTICLE = "<p>Some body text of the article.</p>"
KEPT_PAGES = [
    f"<article style='overflow:hidden'>{ARTICLE}</article>", f"<article class='overflow-hidden'>{ARTICLE}</article>",
    f"<article aria-hidden='false'>{ARTICLE}</article>", f"<div class='content has-sidebar'>{ARTICLE}</div>",
    f"<div class='content no-sidebar'><article>{ARTICLE}</article></div>", f"<div class='post comments-open'>{ARTICLE}</div>",
    f"<div id='social-science-101'>{ARTICLE}</div>", f"<main>{ARTICLE}</main><article class=card>teaser</article>",
    f"<div>{ARTICLE}{ARTICLE}</div><article class=card>teaser</article>", f"<div class=modal>{ARTICLE}</div>",
]


@pytest.mark.parametrize("page", KEPT_PAGES)
def test_no_article_is_dropped_for_a_name(page):
    assert "Some body text of the article." in pages.main_text(pages.parse(f"<html><body>{page}</body></html>"), [])


def test_main_keeps_its_title_and_sides_stay_out():
    def text(body):
        return pages.main_text(pages.parse(f"<body>{body}</body>"), [])
    assert text(f"<main><h1>Title</h1><article>{ARTICLE}</article></main>") == "Title\nSome body text of the article."
    assert text(f"<main>{ARTICLE}</main><article class=card>teaser</article>") == "Some body text of the article."
    for name in ("sidebar", "site-footer", "cookie-banner", "main-nav", "ad-slot", "social-share", "related-posts", "commentList", "newsletter_form"):
        assert text(f"<article>{ARTICLE}</article><div class='{name}'>beside</div>") == "Some body text of the article.", name
    for side in ("hidden", "aria-hidden=true", "style='display: none'"):
        assert text(f"<article>{ARTICLE}<p {side}>beside</p></article>") == "Some body text of the article.", side


def test_broken_markup_is_read_in_linear_time():
    import time
    for page in ("<a " * 340_000, "<div>" * 100_000 + "</span>" * 100_000, "<select>" * 100_000, "<![CDATA[" * 100_000, "<p><div>" * 100_000, "<! " * 300_000):
        start = time.time()
        pages.parse(page)
        assert time.time() - start < 4, page[:10]


def test_leaks_of_items_that_share_an_id(spark):
    rng = random.Random(12)
    texts = [sentence(rng, 30) for _ in range(8)]
    bench = spark.createDataFrame([(1, texts[0]), (1, texts[1]), (None, texts[2]), (None, texts[3]), (4, texts[4]), (5, texts[4])], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"{sentence(rng, 40)} {t} {sentence(rng, 40)}") for i, t in enumerate(texts)], "doc_id long, text string")
    got = [(r["doc_id"], r["item_id"]) for r in leaks.leaks(docs, bench).collect()]
    assert sorted(got, key=str) == sorted([(0, 1), (1, 1), (2, None), (3, None), (4, 4), (4, 5)], key=str)


def test_windows_without_the_rare_words_of_an_item_are_not_compared(monkeypatch):
    size = 1 << leaks.TERM_BITS
    item = [f"item{k}" for k in range(20)]
    # A space of one direction: every window is as near to every passage as can be.
    search = leaks.search(leaks.Latent(np.ones(size), np.ones((size, 1), np.float32)), [{"item": 1, "text": " ".join(item)}], {1: " ".join(item)})
    compared, plain = [], leaks.subsequence
    monkeypatch.setattr(leaks, "subsequence", lambda *args: compared.append(args) or plain(*args))

    def found(words):
        compared.clear()
        rows = pa.RecordBatch.from_pydict({"id": [7], "text": [" ".join(words)]})
        return [r["common"] for batch in search(iter([rows])) for r in batch.to_pylist()]
    assert found([f"other{k}" for k in range(200)]) == [] and not compared
    other = [f"other{k}" for k in range(40)]
    assert max(found(other + item + other)) == 1.0 and compared


def test_latent_space_is_exact_and_small_in_the_driver(spark):
    """As many directions as passages keep all cosines, repeated passages too; the driver holds rows of their terms only."""
    rng, words = random.Random(7), [f"w{k}" for k in range(900)]
    texts = [" ".join(rng.choices(words, k=32)) for _ in range(100)]
    texts = texts + texts[:30] + ["?", "one"]
    size = 1 << leaks.TERM_BITS
    idf = np.random.default_rng(3).uniform(1, 5, size)
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    tracemalloc.start()
    space = leaks.latent_space(frame, idf, len(texts))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 << 20, peak
    found, term = leaks.buckets(pa.array(texts))
    exact, latent = np.zeros((len(texts), size)), np.zeros((len(texts), space.projection.shape[1]))
    row = {t: k for k, t in enumerate(range(size) if space.terms is None else space.terms.tolist())}
    for t, k in zip(found.text, term):
        exact[t, k] += idf[k]
        latent[t] += space.projection[row[k]]
    assert np.abs(exact @ exact.T - latent @ latent.T).max() < 1e-4 * (exact ** 2).sum(axis=1).max()
    assert latent.shape[1] == 101


def test_latent_space_of_passages_without_words(spark):
    space = leaks.latent_space(spark.createDataFrame([("?",), ("",)], "text string"), np.ones(1 << leaks.TERM_BITS), 2)
    assert space.projection.shape == (0, 0)
    docs = spark.createDataFrame([(1, "? one two three")], "doc_id long, text string")
    assert leaks.leaks(docs, spark.createDataFrame([(1, "?!"), (2, "...")], "item_id long, text string")).count() == 0
