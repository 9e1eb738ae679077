"""The ten operators against brute force, planted cases and awkward rows."""
import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from railyard.llm import (class_lm, fingerprints, html_text, language_id, line_dedup, ngram_join, packing, queries,
                          quality_rules, source_mix, tokens, toxicity)
from tests.conftest import SMOKE

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars int"


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def smoke(spark):
    return spark.read.parquet(f"{SMOKE}/documents.parquet")


def awkward(spark):
    """Nulls in every column, empty, blank, tiny and long texts, repeated rows, clashing column names."""
    long = " ".join(f"word{i % 977} next{i}" for i in range(6000))
    rows = [(1, None, None, None, None), (None, "lonely text without an id", "en", "a", 3), (2, "", "en", "a", 0),
            (3, " \t\n ", "en", "a", 4), (4, "x", "en", "b", 1), (5, long, "en", "b", len(long)),
            (6, "one two three four five six", "fr", "c", 1), (6, "one two three four five six", "fr", "c", 1),
            (7, "One  two\r\nthree four five six", "fr", None, 1), (8, "née\n\nnée\nnée é", "fr", "c", 2)]
    return (spark.createDataFrame(rows, DOCS).withColumn("id", F.lit(1)).withColumn("row", F.lit("r"))
            .withColumn("kept", F.lit("k")).withColumn("_t", F.lit(0)).withColumn("score", F.lit("s")))


def empty(spark):
    return spark.createDataFrame([], DOCS)


# --- shared hashing ------------------------------------------------------------------
def test_words_and_shingles_equal_python():
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("ab É\t\n\x0b .Z") for _ in range(rnd.randrange(60))) for _ in range(400)] + [None, ""]
    seen = {}
    for i, k, buf, off in tokens.text_chunks(pa.array(texts), 300):
        starts, ends, at = tokens.word_spans(buf, off)
        low = tokens.word_hashes(buf, starts, ends)
        for d in range(k):
            words = WORD.findall(lower(texts[i + d]))
            assert at[d + 1] - at[d] == len(words)
            for h, w in zip(low[at[d]:at[d + 1]].tolist(), words):
                assert seen.setdefault(w, h) == h
        h, at = tokens.text_shingles(buf, off, 3)
        for d in range(k):
            words = WORD.findall(lower(texts[i + d]))
            want = {tuple(words[j:j + 3]) for j in range(max(1, len(words) - 2))} if words else set()
            assert at[d + 1] - at[d] == len(want)
    assert len(set(seen.values())) == len(seen)


# --- 1 -------------------------------------------------------------------------------
def components(rows, n, num, den):
    sets = []
    for _, t in rows:
        w = WORD.findall(lower(t))
        sets.append(frozenset(tuple(w[j:j + n]) for j in range(max(1, len(w) - n + 1))) if w else frozenset())
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    held = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            held[x].append(i)
    for i, s in enumerate(sets):
        for j, both in Counter(j for x in s for j in held[x] if j < i).items():
            if den * both >= num * (len(s) + len(sets[j]) - both):
                up[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[find(i)] = min(doc, low.get(find(i), doc))
    return sorted(((d, len(s), low.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))),
                  key=str)


def near_copies(seed=3, bases=6, copies=14):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for size in (3, 7, 12, 30, 80, 200)[:bases]:
        base = [rnd.choice(vocabulary) for _ in range(size)]
        for c in range(copies):
            w = base[:]
            for _ in range(rnd.choice([0, 0, 1, 2, 4, size // 10])):
                w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
            if rnd.random() < 0.3:
                w = w + [rnd.choice(vocabulary)] * rnd.randrange(4)
            rows.append(" ".join(w))
    rnd.shuffle(rows)
    return [(100 + i, t) for i, t in enumerate(rows)]


def test_ngram_join_equals_all_pairs(spark):
    for n, num, den in ((4, 85, 100), (2, 4, 5)):
        rows = near_copies(n)
        got = ngram_join.link_documents(spark.createDataFrame(rows, "doc_id long, text string"), n, num, den)
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str) \
            == components(rows, n, num, den)


def test_ngram_join_awkward_and_empty(spark):
    df = awkward(spark)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = ngram_join.link_documents(df, 4, 85, 100).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == components(rows, 4, 85, 100)
    assert ngram_join.link_documents(empty(spark)).count() == 0


def test_bands_cover_and_plans_are_exact():
    b = ngram_join.Bands(85, 100, 5000)
    rnd = random.Random(1)
    for _ in range(300):
        x = rnd.randrange(7, 4000)
        y = min(5000, rnd.randrange(x, x * 100 // 85 + 1))
        if 100 * x >= 85 * y:
            assert any(lo <= x and y <= hi for lo, hi in zip(b.lo, b.hi))
    for lo, hi, m, deletions, skips in zip(b.lo, b.hi, b.m, b.deletions, b.skips):
        h = b.difference(2 * hi)
        if h:
            assert (2 if deletions else 1) * (m - 2 * skips) > h


# --- 2 -------------------------------------------------------------------------------
def test_source_mix_targets_and_words(spark):
    df = smoke(spark)
    rows = source_mix.take(df).collect()
    sizes, taken, target = Counter(), Counter(), {}
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 2 * r.size and r.taken % max(r.size, 1) == 0
    # repeated resharing by weight
    order = sorted(sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    want, open_, left = {}, set(order), 1.5 * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > 2 * sizes[s]}
        for s in over or open_:
            want[s] = 2.0 * sizes[s] if over else weight[s] * level
        left -= sum(want[s] for s in over)
        open_ = open_ - over if over else set()
    assert all(math.isclose(want[s], target[s], rel_tol=1e-9) for s in order)
    assert all(r.source_size == sizes[r.source] for r in rows)
    again = {(r.doc_id if "doc_id" in r else r.id): r.taken for r in source_mix.take(df.repartition(5)).collect()}
    assert again == {r.id: r.taken for r in rows}
    assert sum(abs(taken[s] - target[s]) for s in order) < 0.15 * sum(target.values())


def test_source_mix_awkward(spark):
    rows = source_mix.take(awkward(spark)).collect()
    assert len(rows) == 10 and all(r.size == 0 and r.taken == 0 for r in rows if r.id in (1, 2, 3))
    assert source_mix.take(empty(spark)).count() == 0
    mixed = source_mix.mix(awkward(spark))
    assert mixed.columns == awkward(spark).columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter(
        i for r in rows for i in [r.id] * r.copies)


# --- 3 -------------------------------------------------------------------------------
def base_counts(t):
    t = t or ""
    w = WORD.findall(t)
    at = defaultdict(list)
    for i in range(len(w) - 2):
        at[tuple(w[i:i + 3])].append(i)
    again = {i + j for v in at.values() if len(v) > 1 for i in v for j in (0, 1, 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again))


def test_quality_counts_and_verdicts(spark):
    extra = spark.createDataFrame([(9000, "a b c a b c a b c d", None, None, None), (9001, "# x\nx y\nx y\n\n\n#", "", "", 1)], DOCS)
    for df in (smoke(spark).unionByName(extra), awkward(spark)):
        texts = Counter((r.doc_id, base_counts(r.text)) for r in df.collect())
        got = quality_rules.judge(df).collect()
        assert texts == Counter((r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words))
                                for r in got)
        for r in got:
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
            assert not (r.base_failed and r.kept)
    assert quality_rules.judge(empty(spark)).count() == 0


def test_quality_agrees_with_labels(spark):
    where = "/root/testdata/sf0.01"
    got = quality_rules.judge(spark.read.parquet(f"{where}/documents.parquet").select("doc_id", "text"))
    rows = got.where("NOT base_failed").join(spark.read.parquet(f"{where}/labels.parquet"), "doc_id").collect()
    assert np.mean([r.kept == bool(r.quality) for r in rows]) > 0.97


# --- 4 -------------------------------------------------------------------------------
def test_line_dedup_small_cases(spark):
    p = "alpha one\nbeta two\ngamma three\ndelta four"
    rows = [(1, p), (2, "own line\n" + p + "\n\nmore here"), (3, p), (4, "solo"), (5, "solo"), (6, None), (7, ""),
            (8, "s\ns\ns\ns\ns"), (9, "beta two\ngamma three")]
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup.drop_repeats(
        spark.createDataFrame(rows, "doc_id long, text string").withColumn("covered", F.lit(1))).collect()}
    assert got[1] == (p, 4, 0) and got[2] == ("own line\n\nmore here", 6, 4) and got[3] == ("", 4, 4)
    assert got[4] == ("solo", 1, 0) and got[5] == ("", 1, 1) and got[6] == (None, 0, 0) and got[7] == ("", 0, 0)
    assert got[8] == ("s", 5, 4) and got[9][0] == "beta two\ngamma three"
    assert line_dedup.drop_repeats(empty(spark)).count() == 0
    assert line_dedup.drop_repeats(awkward(spark)).columns == awkward(spark).columns + ["n_lines", "n_removed"]


# --- 5 -------------------------------------------------------------------------------
def check_packing(got, texts, capacity):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(packing.vocabulary())
    t.encode_special_tokens = True
    want = Counter()
    for doc, text in texts:
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        first = (len(ids) - 1) % capacity + 1
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for v in places.values():
        at = 0
        for offset, length in sorted(v):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r.length for r in got)
    assert len(places) <= 1.25 * total / capacity + 1


def test_packing(spark, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_ROWS", 40)  # several rank buckets
    df = smoke(spark).where("doc_id < 120")
    for capacity in (2048, 300):
        check_packing(packing.pack(df, capacity=capacity).collect(), [(r.doc_id, r.text) for r in df.collect()], capacity)
    df = awkward(spark)
    check_packing(packing.pack(df).collect(), [(r.doc_id, r.text) for r in df.collect()], 2048)
    assert packing.pack(empty(spark)).count() == 0


def test_encoder_white_space():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(packing.vocabulary())
    t.encode_special_tokens = True
    rnd = random.Random(2)
    texts = ["".join(rnd.choice(" \n\tab'1.é　 ") for _ in range(rnd.randrange(30))) for _ in range(1500)]
    texts += ["x <|endoftext|> y", "it's\nwe'll  go", " a", "a\n"]
    e = packing.Encoder(packing.vocabulary())
    for i, k, buf, off in tokens.text_chunks(pa.array(texts), 2000):
        ids, at = e.encode(buf, off)
        for d in range(k):
            assert ids[at[d]:at[d + 1]].tolist() == t.encode(texts[i + d], add_special_tokens=False).ids, texts[i + d]


def test_plan_is_gapless():
    for seed in range(20):
        rnd = random.Random(seed)
        histogram = [(x, rnd.choice([1, 2, 7, 900])) for x in rnd.sample(range(1, 101), rnd.choice([1, 5, 60]))]
        slots, n = packing.plan(histogram, 100)
        fill, ranks = defaultdict(list), Counter()
        for length, rank, count, each, first, offset in slots:
            assert rank == ranks[length]
            ranks[length] += count * each
            for q in range(count):
                fill[first + q].append((offset, each * length))
        assert ranks == dict(histogram) and len(fill) == n
        for v in fill.values():
            at = 0
            for offset, length in sorted(v):
                assert offset == at
                at += length
            assert at <= 100


# --- 6 -------------------------------------------------------------------------------
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header><a href=/>Site</a></header><nav><ul><li><a href=a>Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies on this site to please you, dear reader, day by day.</div>
<div id="content"><h1>Head &amp; line</h1><p>First&nbsp;para with <b>bo</b>ld text, long enough to count as text.
<p>Second one, <a href=x>with a link</a>, unclosed and also long enough for that.<br>New line.
<form><input><button>Send</button></form><aside>Related things</aside><!-- hidden --></div>
<section class="comments"><p>Great article, thank you so much for writing it, I liked it.</p></section>
<div class="ad">Buy now</div><footer>&copy; me</footer></body></html>"""


def test_html_text():
    assert html_text.main_text(PAGE) == (
        "Head & line First para with bold text, long enough to count as text. Second one, with a link, "
        "unclosed and also long enough for that. New line.")
    for text, want in ((None, ""), ("", ""), ("<", "<"), ("a < b", "a < b"), ("<p>x", "x"), ("<!-- open", ""),
                       ("<script>x", ""), ("</p></p>y", "y"), ("<form><div>all in a form</div></form>", "all in a form"),
                       ("<form><h1>Head</h1><p>and text</p><nav>x</nav></form>", "Head and text"), ("<div><div>" * 3000 + "deep", "deep")):
        assert html_text.main_text(text) == want


def test_html_text_keeps_named_sections_of_the_article():
    long = "Dense text of the article that goes on for a while without any link, as such paragraphs do in general. "
    page = ("<body><nav><a href=/>Home</a></nav><div class='comments'><p>" + "Not from the article. " * 4 + "</p></div>"
            "<article><h1>Head</h1><p>" + long * 6 + "</p>{}</article></body>")
    whole = " ".join(("Head " + long * 6).split())
    for part, text in ((f"<section id='social-life'><h2>Social</h2><p>{long}</p></section>", f"Social {long}"),
                       ("<section id=social-life><p>Short but its own.</p></section>", "Short but its own."),
                       ("<h2 id='related-work'>Related work</h2>", "Related work"),
                       (f"<div id=header-files class='reply'><p>{long * 2}</p><div class=share>Share this</div></div>", long * 2),
                       ("<div class=related><p><a href=a>One more page to read</a> <a href=b>" + long + "</a></p></div>", ""),
                       ("<div class='ad'>Buy now</div>", ""), (f"<aside class=x><p>{long}</p></aside>", ""),
                       (f"<div hidden class=share><p>{long}</p></div>", "")):
        assert html_text.main_text(page.format(part)) == " ".join((whole + " " + text).split())


@pytest.mark.parametrize("piece", ["<div>{i}</p>", "<b><div>x</b></i></div>", "<li><div>{i}</span>", "<h1>t</h1><div>",
                                   "<a href='x", "<td><td></tr><i>", "<header><p>y<div>", "</div><p>z", '<a "><p>'])
def test_html_text_takes_linear_time(piece):
    """A megabyte of nested, stray and broken tags."""
    import time
    page = "<body><article><p>" + "Some text of the article. " * 40 + "</p>"
    page += "".join(piece.format(i=i) for i in range(1_000_000 // len(piece)))
    began = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - began < 30


def test_html_text_over_pages(spark):
    import html
    df = spark.read.parquet(f"{SMOKE}/pages.parquet").withColumn("text", F.lit("clash"))
    for r, p in zip(html_text.extract(df).orderBy("page_id").collect(), df.orderBy("page_id").collect()):
        inner = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        inner = re.sub(r"<br>|</?(p|h\d|ul|li|div)[^>]*>", " ", re.sub(r"<!--.*?-->", "", inner, flags=re.S))
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", "", inner)).split())
        assert (r.text, r.n_chars) == (want, len(want))
    none = spark.createDataFrame([(1, None, None)], "page_id long, url string, html string")
    assert [(r.text, r.n_chars) for r in html_text.extract(none).collect()] == [("", 0)]
    assert html_text.extract(none.limit(0)).count() == 0


# --- 7 -------------------------------------------------------------------------------
def longest_phrases(codes, sample):
    text, n, i = "".join(map(chr, codes)), 0, 0
    known = "".join(map(chr, sample))
    while i < len(text):
        j = i + 1
        while j <= len(text) and text[i:j] in known:
            j += 1
        i, n = max(i + 1, j - 1), n + 1
    return n


def test_cross_parsing_equals_search():
    rnd = random.Random(4)
    for _ in range(25):
        sample = np.array([rnd.randrange(4) for _ in range(rnd.randrange(1, 120))], np.uint8)
        table = language_id.automaton(sample, 5)
        texts = [np.array([rnd.randrange(5) for _ in range(rnd.randrange(0, 40))], np.uint8) for _ in range(6)]
        start = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        got = language_id.phrases(np.concatenate(texts), start, table, 5, block=10)
        for t, n in zip(texts, got):
            assert n == sum(longest_phrases(t[k:k + 10], sample) for k in range(0, len(t), 10))


def test_language_id_held_out_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = queries.op7_language_id(spark, "/root/testdata/sf0.01").join(df.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang == r.lang_pred for r in rows if r.held_out]) > 0.95
    model = language_id.learn(language_id.sample(df))
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(awkward(spark), model).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[4][0] != "und" and len(got) == 9
    assert language_id.identify(empty(spark), model).count() == 0
    nothing = language_id.learn(language_id.sample(empty(spark)))
    assert {r.lang_pred for r in language_id.identify(awkward(spark), nothing).collect()} == {"und"}


def test_language_id_keeps_every_alphabet(spark):
    """More letters than symbols: five alphabets, two of them rare, and one with thousands of letters."""
    scripts = {"en": range(97, 123), "ru": range(0x430, 0x450), "el": range(0x3B1, 0x3CA), "ka": range(0x10D0, 0x10F1),
               "hy": range(0x561, 0x587), "zh": range(0x4E00, 0x5600)}
    rnd = random.Random(2)
    rows = []
    for lang, letters in scripts.items():
        words = ["".join(chr(rnd.choice(letters)) for _ in range(rnd.randrange(2, 8))) for _ in range(120)]
        for _ in range(12 if lang in ("ka", "hy") else 120):
            rows.append((len(rows), " ".join(rnd.choices(words, k=40)), lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.learn(language_id.sample(docs))
    alphabet = model[1]
    seen = {}
    for c in {c for t in language_id.sample(docs).values() for c in t if c.isalpha()}:
        code = tuple(alphabet.codes(np.array([ord(c)]), np.array([0, 1]))[0].tolist())
        assert 0 not in code and seen.setdefault(code, c) == c
    codes = set(seen)
    assert not any(c[:k] in codes for c in codes for k in range(1, len(c)))
    got = language_id.identify(docs, model).collect()
    assert all(r.lang_pred == r.lang for r in got)


def test_language_sample_takes_copies_once_and_any_part(spark):
    rows = [(i, f"text number {i} " + "".join(chr(97 + (i * 7 + j * j) % 26) for j in range(300)), "en") for i in range(40)]
    rows += [(100 + i, rows[k][1], "en") for k in range(10) for i in range(k * 60, k * 60 + 60)]
    long = " ".join(f"w{j:05d}" for j in range(2000))
    rows += [(1000 + i, f"{i:02d} {long}", "fr") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language_id.sample(df)
    assert language_id.sample(df.repartition(7)) == got
    train = {t for i, t, g in rows if g == "en" and zlib.crc32(str(i).encode()) % 5}
    assert Counter(got["en"][1:].split("\n")) == Counter(train)
    parts = got["fr"][1:].split("\n")
    assert {len(x) for x in parts} == {language_id.SAMPLE_ROW_CHARS}
    assert all(any(x in t for _, t, _ in rows) for x in parts) and sum("w00000" in x for x in parts) < len(parts) / 2


# --- 8 -------------------------------------------------------------------------------
def test_entropy_classes_equal_counting():
    rnd = np.random.default_rng(0)
    x = rnd.integers(97, 112, 400).astype(np.uint8)
    got = fingerprints.entropy_classes(x)
    for i in range(0, len(got), 7):
        total = sum(int(fingerprints._F[n]) for n in Counter(x[i:i + fingerprints.WINDOW].tolist()).values())
        assert got[i] == (fingerprints._MOST - total) * (fingerprints.CLASSES - 1) // fingerprints._MOST


def test_features_near_a_change_equal_all_features():
    rnd = random.Random(12)
    words = ["".join(rnd.choice("abcdefghijklmnop é") for _ in range(rnd.randrange(2, 9))) for _ in range(300)]
    rank = fingerprints.ranks(np.random.default_rng(3).integers(0, 1000, fingerprints.CLASSES))
    for _ in range(120):
        text, nxt = (" ".join(rnd.choices(words, k=rnd.randrange(5, 400))) for _ in range(2))
        if rnd.random() < 0.2:
            text = text[:40] * 30
        cut = len(text) // 3
        same = text[:len(text) - cut].encode()
        edited = same + nxt[:cut].encode()
        got = fingerprints.changed_hashes(edited, len(same), fingerprints.window_hashes(text.encode(), rank), rank)
        want = fingerprints.window_hashes(edited, rank)
        assert got[0].tolist() == want[0].tolist() and got[1] == want[1]


@pytest.fixture
def many_ranges(spark):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")  # small ranges stay apart
    yield spark
    spark.conf.set(key, before)


def test_fingerprints_of_neighbours(many_ranges):
    spark = many_ranges
    df = smoke(spark)
    rank = fingerprints.corpus_ranks(df)
    rows = {r.doc_id: r for r in fingerprints.neighbours(df).collect()}
    texts = sorted(((r.doc_id, r.text) for r in df.collect()), reverse=True)
    for (i, t), (_, after) in zip(texts, texts[1:] + texts[:1]):
        r, cut = rows[i], len(t) // 3
        edited = t[:len(t) - cut] + after[:cut]
        own, other, follow = (fingerprints.digest(x.encode(), rank) for x in (t, edited, after))
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == fingerprints.text_of(own) and r.edited_fingerprint == fingerprints.text_of(other)
        assert r.near_edited == fingerprints.likeness(own, other) == fingerprints.likeness(other, own)
        assert r.near_next == fingerprints.likeness(own, follow)
    assert np.median([r.near_edited for r in rows.values()]) > 0.4 > 0.2 > np.median([r.near_next for r in rows.values()])


def test_fingerprints_of_text_ids_and_many_null_ids(many_ranges):
    """String ids and as many rows without one, over several ranges, some rows equal."""
    spark = many_ranges
    rows = [(f"k{i:03d}", f"text {i} " * (i % 9 + 3)) for i in range(150)] + [("k007", "another")] * 3
    rows += [(None, f"nobody {i % 90} " * 9) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id string, text string").repartition(4)
    got = fingerprints.neighbours(df).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    texts = {i: t for i, t in rows if i is not None and i != "k007"}
    ids = sorted(texts, reverse=True)
    edited = {r.doc_id: r.edited_sha256 for r in got}
    for i, after in zip(ids, ids[1:]):
        if "k007" not in (i, after) and not i == "k008":
            cut = len(texts[i]) // 3
            assert edited[i] == hashlib.sha256((texts[i][:len(texts[i]) - cut] + texts[after][:cut]).encode()).hexdigest()
    # every row has exactly one next row: the edited texts of rows without an id end in such rows, or in the first of all
    nobody = {t for i, t in rows if i is None} | {texts[ids[0]]}
    want = {hashlib.sha256((t[:len(t) - len(t) // 3] + n[:len(t) // 3]).encode()).hexdigest()
            for t in nobody for n in nobody}
    assert all(r.edited_sha256 in want for r in got if r.doc_id is None)


def test_fingerprints_awkward(spark):
    got = fingerprints.neighbours(awkward(spark)).collect()
    assert Counter(r.doc_id for r in got) == Counter([1, None, 2, 3, 4, 5, 6, 6, 7, 8])
    by = {r.doc_id: r for r in got}
    assert by[1].fingerprint == by[2].fingerprint == "" and by[2].near_next == 1.0 and by[2].n_chars == 0
    assert fingerprints.neighbours(empty(spark)).count() == 0


# --- 9 -------------------------------------------------------------------------------
def check_lm(spark, df, rows):
    got = class_lm.score(df).collect()
    split = {i: [WORD.findall(lower(t)) + ["\0"] for j, t in rows if j == i] for i, _ in rows}
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i in split}
    c = Counter(w for i, ts in split.items() if not held[i] for t in ts for w in t)
    n, v = sum(c.values()), len(c)
    assert len(got) == len(rows)
    for r in got:
        w = split[r.doc_id][0]
        base = sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (
            len(w), sum(c[x] > 0 for x in w), n, held[r.doc_id])
        assert math.isclose(r.base_score, base, rel_tol=1e-9, abs_tol=1e-9) and r.score <= 1e-9
    return got


def test_class_lm(spark, monkeypatch):
    monkeypatch.setattr(class_lm, "HEAD", 800)  # most words take the join
    monkeypatch.setattr(class_lm, "CLUSTERED", 60)
    df = smoke(spark)
    got = check_lm(spark, df, [(r.doc_id, r.text) for r in df.collect()])
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    df = awkward(spark)
    check_lm(spark, df, [(r.doc_id, r.text) for r in df.collect()])
    assert class_lm.score(empty(spark)).count() == 0


def test_exchange_separates_alternating_words():
    rnd = np.random.default_rng(1)
    n = 12 + class_lm.SHAPES + 2
    counts = np.zeros((n, n), int)
    for a in range(5):
        for b in range(5, 12):  # words of one kind follow the other kind
            counts[a, b], counts[b, a] = rnd.integers(5, 40, 2)
    cls = class_lm.exchange(counts, 12, clusters=2)
    assert len(set(cls[:5])) == len(set(cls[5:12])) == 1 and cls[0] != cls[5]


def test_class_lm_learns_classes_of_rare_words(spark, monkeypatch):
    monkeypatch.setattr(class_lm, "CLUSTERED", 8)
    monkeypatch.setattr(class_lm, "CLUSTERS", 2)
    rnd = random.Random(6)
    often = [[f"{k}o{i}" for i in range(4)] for k in "ab"]
    rare = [[f"{k}{i:03d}" for i in range(150)] for k in "ab"]  # all of one shape
    words = [often[j % 2][rnd.randrange(4)] if rnd.random() < 0.7 else rare[j % 2][rnd.randrange(150)]
             for j in range(12000)]
    rows = [(i, " ".join(words[40 * i:40 * i + 40])) for i in range(300)]
    pairs = [(rnd.choice(rare[0]), rnd.choice(rare[1])) for _ in range(20)]
    rows += [(1000, " ".join(f"{a} {b}" for a, b in pairs)), (1001, " ".join(f"{a} {c}" for a, c in zip(
        [a for a, _ in pairs[:10]] + [b for _, b in pairs[:10]], [a for a, _ in pairs[10:]] + [b for _, b in pairs[10:]])))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = []
    for head in (8, 100, class_lm.HEAD):  # rare words met by joins, in part, and by broadcast
        monkeypatch.setattr(class_lm, "HEAD", head)
        got.append({r.doc_id: (r.base_score, r.score) for r in class_lm.score(df).collect()})
    assert math.isclose(got[0][1000][0], got[0][1001][0], rel_tol=1e-9)
    assert got[0][1000][1] > got[0][1001][1] + 5  # rare words follow the other kind
    for other in got[1:]:
        assert all(np.allclose(got[0][i], other[i], rtol=1e-9) for i in got[0])


def test_score_equals_plain_formula_for_given_classes(spark, monkeypatch):
    """Every token's class transition and word probability, recomputed word by word."""
    from railyard.llm.tokens import text_chunks

    def classes(train, words, seeds, clusters):
        return words.where(F.col("h") != int(class_lm.END_HASH)).select(
            "h", "c", "shape", F.pmod("h", F.lit(3)).cast("int").alias("cls")), 3

    monkeypatch.setattr(class_lm, "learn_classes", classes)
    monkeypatch.setattr(class_lm, "HEAD", 300)
    rows = [(r.doc_id, r.text) for r in smoke(spark).collect()]
    got = {r.doc_id: r.score for r in class_lm.score(smoke(spark)).collect()}
    texts = {}
    for i, text in rows:
        ((_, _, buf, off),) = text_chunks(pa.array([text or ""]), 1 << 30)
        h, shape, _ = class_lm._words(buf, off)
        texts[i] = list(zip(h.tolist(), shape.tolist()))
    train = {i for i in texts if zlib.crc32(str(i).encode()) % 10}
    count, kind = Counter(), {}
    for i in sorted(train):
        for h, k in texts[i]:
            count[h] += 1
            kind[h] = min(k, kind.get(h, k))
    of = {h: h % 3 for h in count}
    tokens_of, words_of, n1, n2, once = Counter(), Counter(), Counter(), Counter(), Counter()
    for h, c in count.items():
        tokens_of[of[h]] += c
        words_of[of[h]] += 1
        n1[of[h]] += c == 1
        n2[of[h]] += c == 2
        once[kind[h], of[h]] += c == 1
    d = {k: min(0.9, max(0.05, (n1[k] + 0.5) / (n1[k] + 2 * n2[k] + 1))) for k in range(3)}
    total = [sum(once[s, k] for k in range(3)) for s in range(class_lm.SHAPES)]
    most = max(range(3), key=lambda k: (d[k] * words_of[k], -k))
    unseen = [max(range(3), key=lambda k: (once[s, k], -k)) if total[s] else most for s in range(class_lm.SHAPES)]
    share = [t + 0.5 for t in total]
    held = {k: sum(x for x, u in zip(share, unseen) if u == k) for k in range(3)}
    d = {k: d[k] if held[k] else 0.0 for k in d}
    end, start = 3, 4
    pairs = Counter()
    for i in train:
        seq = [start] + [of[h] for h, _ in texts[i]] + [end]
        pairs.update(zip(seq, seq[1:]))
    into = Counter()
    for (_, b), n in pairs.items():
        into[b] += n
    whole = sum(into[b] + 1 for b in range(4))
    out = Counter()
    for (a, _), n in pairs.items():
        out[a] += n
    for i, words in texts.items():
        want, before = 0.0, start
        for h, k in [*words, (None, None)]:
            now = end if h is None else of.get(h, unseen[k] if k is not None else None)
            back = class_lm.BACKOFF * (into[now] + 1) / whole
            want += math.log10((pairs[before, now] + back) / (out[before] + class_lm.BACKOFF))
            if h in count:
                want += math.log10((count[h] - d[now]) / tokens_of[now])
            elif h is not None:
                want += math.log10(d[now] * words_of[now] / tokens_of[now] * share[k] / held[now])
            before = now
        assert math.isclose(got[i], want, rel_tol=1e-9, abs_tol=1e-6), i


def test_contexts_equal_counting():
    """Word contexts of a piece, and their merge over rows of several batches."""
    rnd = np.random.default_rng(2)
    h = rnd.integers(0, 30, 2000)
    cls = rnd.integers(0, 6, 30)[h]
    ph, ch = np.append(-9, h), np.append(h, -8)
    pc, cc = np.append(7, cls), np.append(cls, 6)
    moving = np.arange(10, 30)
    want = Counter()
    for a, x, b, y in zip(ph.tolist(), pc.tolist(), ch.tolist(), cc.tolist()):
        if a == b and a >= 10:
            want[a - 10, 16] += 1
            continue
        if a >= 10:
            want[a - 10, y] += 1
        if b >= 10:
            want[b - 10, 8 + x] += 1
    word, ctx, n = class_lm.contexts(ph, pc, ch, cc, 8, moving)
    assert {(w, c): k for w, c, k in zip(word.tolist(), ctx.tolist(), n.tolist())} == want
    rows = sorted((int(w), i, int(c) | int(k) << 16) for i, (w, c, k) in enumerate(zip(word, ctx, n)))

    class Held:
        value = (rnd.integers(0, 50, (8, 8)).astype(float), 6)

    def batch(part):
        return pa.RecordBatch.from_arrays(
            [pa.array([w for w, _, _ in part], pa.int64()), pa.array([1] * len(part), pa.int64()),
             pa.array([0] * len(part), pa.int32()), pa.array([[e] for _, _, e in part], pa.list_(pa.int64()))],
            ["h", "c", "shape", "near"])

    whole = [b.to_pylist() for b in class_lm._classes(Held)(iter([batch(rows)]))]
    cut = [b.to_pylist() for b in class_lm._classes(Held)(iter([batch(rows[i:i + 7]) for i in range(0, len(rows), 7)]))]
    assert sum(whole, []) == sum(cut, []) and len(sum(whole, [])) == 20


def test_best_classes_equal_full_likelihood():
    rnd = np.random.default_rng(3)
    clusters, size = 3, 5
    counts = rnd.integers(0, 9, (6, 6))  # units: four words, an end, a start
    cls = np.array([0, 1, 2, 1, 3, 4])

    def likelihood(of):
        member = np.eye(size)[of]
        t = member.T @ counts @ member
        x = lambda v: (v * np.log(np.maximum(v, 1.0))).sum()
        return x(t) - x(t[:clusters].sum(1)) - x(t[:, :clusters].sum(0)), t

    table = likelihood(cls)[1]
    w = 3
    entries = Counter()
    for u in range(6):
        if u != w:
            entries[cls[u]] += counts[w, u]
            entries[size + cls[u]] += counts[u, w]
    entries[2 * size] += counts[w, w]
    ctx = np.array(sorted(entries))
    n = np.array([entries[c] for c in ctx])
    without = counts.copy()
    without[w], without[:, w] = 0, 0
    member = np.eye(size)[cls]
    got = class_lm.best_classes(member.T @ without @ member, clusters, np.array([-1]), np.zeros(len(ctx), int), ctx, n)
    want = max(range(clusters), key=lambda k: likelihood(np.where(np.arange(6) == w, k, cls))[0])
    assert got[0] == want and table.sum() == counts.sum()


# --- 10 ------------------------------------------------------------------------------
def test_toxicity_on_planted_words(spark):
    rnd = random.Random(8)
    plain = [f"w{int(rnd.paretovariate(0.8)) % 900}" for _ in range(4000)]
    rows, labels = [], []
    for i in range(500):
        toxic = i % 5 == 0
        w = [rnd.choice(plain) for _ in range(rnd.randrange(30, 120))]
        if toxic:
            for _ in range(3 + len(w) // 25):
                w[rnd.randrange(len(w))] = rnd.choice(["idiot,", "Scum", "moron."])
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality long, toxic long")
    model = toxicity.fit(docs, marks)
    got = toxicity.score(docs.where(~toxicity.in_training("doc_id")), model).collect()
    truth = {i: t for i, _, t in labels}
    assert len(got) > 60 and np.mean([r.predicted == truth[r.doc_id] for r in got]) > 0.97
    assert all(r.predicted == int(r.score >= 0.5) for r in got)
    odd = {r.doc_id: r for r in toxicity.score(awkward(spark), model).collect()}
    assert odd[1].score == odd[2].score == odd[3].score < 0.5 and len(odd) == 9
    assert toxicity.score(empty(spark), model).count() == 0
    none = toxicity.fit(docs, marks.limit(0))
    assert {r.predicted for r in toxicity.score(docs, none).collect()} == {0}


def test_toxicity_ratios_equal_plain_counting(spark):
    """Continuation counts, clear expressions, their log-ratios and a text's statistic, by hand."""
    rnd = random.Random(3)
    rows, labels = [], []
    for i in range(240):
        toxic = i % 3 == 0
        w = [f"w{rnd.randrange(60)}" for _ in range(40)]
        for _ in range(6 if toxic else 0):
            w[rnd.randrange(len(w))] = rnd.choice(["bad", "worse"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic long")
    model = toxicity.fit(docs, marks)
    count_on, _ = toxicity._sample(docs, marks, "doc_id", "text", "toxic", 5, toxicity.SAMPLE, toxicity.CALIBRATION)
    text = dict(rows)
    triples = {(t, *x) for i, t in count_on for w in [["", ""] + text[i].split()] for x in zip(w, w[1:], w[2:])}
    pairs = Counter((t, v, w) for t, _, v, w in triples)
    words = Counter((t, w) for t, _, w in pairs)

    def clear(counts, names):
        m = [sum(n for (t, *_), n in counts.items() if t == k) for k in (False, True)]
        out, least = {}, min(m)
        for x in names:
            x0, x1 = counts[(False, *x)], counts[(True, *x)]
            share = (x0 + x1) / sum(m)
            if abs(x1 / m[1] - x0 / m[0]) >= toxicity.CLEAR * math.sqrt(share * (1 / m[0] + 1 / m[1])):
                out[x] = math.log((x1 / m[1] * least + toxicity.FLOOR) / (x0 / m[0] * least + toxicity.FLOOR))
        return out

    of_words = clear(words, {(w,) for _, w in words})
    of_pairs = clear(pairs, {(v, w) for _, v, w in pairs})
    assert set(of_words) >= {("bad",), ("worse",)}
    assert np.allclose(sorted(model.of_words), sorted(of_words.values()))
    assert np.allclose(sorted(model.of_pairs), sorted(of_pairs.values()))
    held = spark.sparkContext.broadcast(model)
    for r in toxicity.statistic(docs.limit(40), held).collect():
        w = ["", *text[r.doc_id].split()]
        want = sum(of_pairs.get((a, b), of_words.get((b,), 0.0)) for a, b in zip(w, w[1:])) / (len(w) - 1)
        assert math.isclose(r.statistic, want, rel_tol=1e-9, abs_tol=1e-12)


# --- registered queries against SQL ----------------------------------------------------
@pytest.mark.parametrize("key", sorted(queries.oracle_sql()))
def test_matches_sql(spark, key):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMOKE}/{table}.parquet')")
    res = con.execute(queries.oracle_sql()[key])
    names = [d[0] for d in res.description]

    def norm(row):
        return tuple(round(x, 6) if isinstance(x, float) else x for x in row)

    want = Counter(norm(r) for r in res.fetchall())
    got = Counter(norm(r) for r in queries.queries()[key](spark, SMOKE).select(*names).collect())
    assert got == want


def test_every_operator_is_registered():
    names = queries.queries()
    assert [sum(re.match(rf"op{n}_", k) is not None for k in names) for n in range(1, 14)] == [1] * 13
    assert not os.path.exists("/root/testdata/sf0.001/_temporary")
