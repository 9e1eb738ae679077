"""Lexical search, spelling variants and personal data against brute force."""
import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from railyard.llm import lexical_search, personal_data, queries, spelling
from tests.llm.test_operators import awkward, empty, lower, smoke

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
RUN = re.compile("[A-Za-zÀ-ÿ]+")
TABLE = "/root/testdata/sf0.1/documents.parquet"


# --- 12 ------------------------------------------------------------------------------
def ranked(docs, items, k=10):
    """(item, rank, doc, score) by the contract, over all rows."""
    tfs = [Counter(TERM.findall(lower(t))) for _, t in docs]
    sizes = [sum(c.values()) for c in tfs]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for c in tfs for t in c)
    asked = defaultdict(set)
    for item, text in items:
        asked[item] |= set(TERM.findall(lower(text)))
    out = []
    for item, terms in asked.items():
        found = []
        for (doc, _), c, size in zip(docs, tfs, sizes):
            if size:
                m = 10 + (90 * size * n) // total
                score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                            * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if t in c)
                if score > 0:
                    found.append((-score, doc is None, doc or 0, doc))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(found)[:k])]
    return Counter(out)


def corpus(seed, n=400):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(120)] + ["É9", "naïve", "x"]
    rows = [(i, rnd.choice([" ", "-", "\n"]).join(rnd.choices(words, [1 / (1 + j) for j in range(len(words))],
                                                             k=rnd.randrange(0, 60)))) for i in range(n)]
    return rows + [(n + i, rows[7][1] + " W3") for i in range(40)]  # ties over more than k documents


def test_search_equals_full_ranking(spark):
    docs = corpus(1)
    rnd = random.Random(2)
    items = [(i, " ".join(rnd.choices([t for t in " ".join(t for _, t in docs[:60]).split()] + ["absent"], k=8)))
             for i in range(25)] + [(25, ""), (26, None), (None, "w1 W2"), (3, "naïve x")]
    index = lexical_search.build(spark.createDataFrame(docs, "doc_id long, text string").repartition(5))
    got = lexical_search.search(index, spark.createDataFrame(items, "item_id long, text string"))
    assert Counter(tuple(r) for r in got.select("item_id", "rank", "doc_id", "score").collect()) == ranked(docs, items)


def test_search_takes_large_query_sets_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "ROUND_TERMS", 40)
    docs = corpus(3, 120)
    items = [(i, t) for i, t in docs[:30]]
    index = lexical_search.build(spark.createDataFrame(docs, "doc_id long, text string"))
    got = lexical_search.search(index, spark.createDataFrame(items, "item_id long, text string"), k=4)
    assert Counter(tuple(r) for r in got.select("item_id", "rank", "doc_id", "score").collect()) \
        == ranked(docs, items, 4)


def test_search_awkward_and_empty(spark):
    df = awkward(spark)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    items = [(1, "one text six"), (2, "x née lonely"), (3, "word1 next1 word2")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = lexical_search.search(lexical_search.build(df), asked)
    assert Counter(tuple(r) for r in got.select("item_id", "rank", "doc_id", "score").collect()) == ranked(rows, items)
    assert lexical_search.search(lexical_search.build(empty(spark)), asked).count() == 0
    assert lexical_search.search(lexical_search.build(df), asked.limit(0)).count() == 0
    named = df.selectExpr("concat('d', doc_id) AS doc_id", "text")  # ids of another type
    got = lexical_search.search(lexical_search.build(named), asked)
    assert Counter((r.item_id, r.doc_id, r.score) for r in got.collect()) == \
        Counter((i, None if d is None else f"d{d}", s) for (i, _, d, s) in ranked(rows, items).elements())


def test_blocks_round_trip_and_are_rejected_before_decoding():
    rnd = np.random.default_rng(4)
    sizes = rnd.integers(1, 80, 3000)
    terms = [np.minimum(rnd.zipf(1.3, s), 4000).astype(np.uint64) for s in sizes]
    for i in (50, 900, 2500):  # a few documents hold three rare terms often
        terms[i] = np.concatenate([terms[i], np.repeat(np.array([9001, 9002, 9003], np.uint64), 9)])
        sizes[i] += 27
    n, total = len(sizes), int(sizes.sum())
    rows = lexical_search._shard_rows(7, pa.array(range(n)), sizes, np.concatenate(terms), n, total).to_pylist()
    norms = np.frombuffer(rows[-1]["norms"], np.int64)
    lists, want = {}, [Counter(t.tolist()) for t in terms]
    for r in rows[:-1]:
        t = r["term"]
        p = lexical_search._Postings(lexical_search.weight(n, r["df"]),
                                     *(r[c] for c in ("df", "top", "last", "tops", "widths", "data")))
        doc, tf = p.blocks(range(len(p.last)))
        assert dict(zip(doc.tolist(), tf.tolist())) == {d: c[t] for d, c in enumerate(want) if t in c}
        lists[t] = p
    work: list = []
    for query in ([1, 2, 3, 9001, 9002, 9003], [1, 2], [5, 60, 700], [9001, 1, 4, 8]):
        mine = [lists[t] for t in query if t in lists]
        scores = sorted(((sum(lists[t].weight * int(lexical_search.impact(c[t], norms[d]))
                              for t in query if t in c), -d) for d, c in enumerate(want)), reverse=True)[:3]
        doc, got = lexical_search.top_of_shard(mine, norms, 3, 0, work)
        assert sorted(zip(got.tolist(), (-doc).tolist()), reverse=True) == scores
        doc, got = lexical_search.top_of_shard(mine, norms, 3, scores[2][0], work)
        assert sorted(zip(got.tolist(), (-doc).tolist()), reverse=True) == scores
    assert work[1][0] < work[1][1] / 3  # of the frequent lists only few blocks are decoded


# --- 11 ------------------------------------------------------------------------------
def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(a == b[:i] + b[i + 1:] for i in range(len(b)))


def spelling_rows(counts, factor=10):
    near = defaultdict(list)
    for a, b in itertools.combinations(sorted(counts), 2):
        if abs(len(a) - len(b)) < 2 and one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        if best and counts[best] >= factor * n:
            form[w] = best
    out = set()
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), counts[form[w]] if w in form else None))
    return out


def counted(docs, letters=7, least=2):
    words = Counter()
    for doc, text in docs:
        for run in RUN.findall(text or ""):
            w = lower(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % 31 == 0:
                p = h % len(w)
                w = w[:p] + w[p + 1:]
            words[w] += len(w) >= letters
    return {w: n for w, n in words.items() if n >= least}


def test_spelling_words_and_variants_of_texts(spark):
    rows = [(r.doc_id, r.text) for r in smoke(spark).collect()]
    words = counted(rows)
    assert {r.word: r.n for r in spelling.word_counts(smoke(spark)).collect()} == words
    got = {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n"))
           for r in queries.queries()["op11_spelling"](spark, "/root/testdata/sf0.001").collect()}
    assert got == spelling_rows(words) and any(r[1] for r in got)


def test_near_words_in_tiles_equal_all_pairs(spark):
    rnd = random.Random(8)
    words = {"".join(rnd.choice("abcé") for _ in range(rnd.randrange(7, 10))): 1 for _ in range(700)}
    words |= {w[:3] + "z" + w[4:]: 1 for w in list(words)[:60]}
    want = {(a, b) for a in words for b in words if a != b and abs(len(a) - len(b)) < 2 and one_edit(a, b)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    for tile, groups in ((1024, 5), (6, 5), (9, 3)):
        got = [(r.word, r.near) for r in spelling.near_words(df, tile, groups).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_spelling_follows_long_chains(spark):
    words = {"abcdefgh": 10 ** 6, "abcdefgx": 10 ** 5, "abcdefyx": 10 ** 4, "abcdeuyx": 10 ** 3, "abcdvuyx": 100,
             "abcwvuyx": 10, "abbwvuyx": 1, "lonelyword": 5, "abcdefghi": 10 ** 5 + 1, "tiedwordb": 50,
             "tiedworda": 50, "tiedwordc": 5}
    got = {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n"))
           for r in spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    assert got == spelling_rows(words)
    assert {r[2] for r in got if r[0] == "abbwvuyx"} == {"abcdefgh"} and {r[1] for r in got if r[0] == "tiedwordc"} == \
        {"tiedworda"}


def test_spelling_awkward_and_empty(spark):
    df = awkward(spark)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    for least in (1, 2):
        assert {r.word: r.n for r in spelling.word_counts(df, least=least).collect()} == counted(rows, least=least)
    words = {w: n for w, n in counted(rows, letters=4, least=1).items()}
    got = {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n"))
           for r in spelling.variants(spelling.word_counts(df, letters=4, least=1)).collect()}
    assert got == spelling_rows(words)
    assert spelling.variants(spelling.word_counts(empty(spark))).count() == 0


def test_continued_crc():
    rnd = random.Random(1)
    words = [bytes(rnd.randrange(256) for _ in range(rnd.randrange(0, 12))) for _ in range(200)]
    buf = np.frombuffer(b"".join(words), np.uint8)
    size = np.array([len(w) for w in words])
    state = np.array([zlib.crc32(b"%d:" % i) for i in range(200)], np.uint32)
    got = spelling.continued_crc(state, buf, np.cumsum(size) - size, size)
    assert got.tolist() == [zlib.crc32(b"%d:" % i + w) for i, w in enumerate(words)]


# --- 13 ------------------------------------------------------------------------------
def plain_base(text):
    """The base spans, spelt out once more."""
    out = []
    for kind, pattern in enumerate((r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
                                    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
                                    r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text or ""):
            d = [int(c) for c in m[0] if c in "0123456789"]
            doubled = [x if i % 2 == 0 else (2 * x) // 10 + (2 * x) % 10 for i, x in enumerate(d[::-1])]
            if (kind == 0 or kind == 1 and max(map(int, m[0].split("."))) <= 255
                    or kind == 2 and 14 <= len(d) <= 19 and sum(doubled) % 10 == 0 or kind == 3 and 10 <= len(d) <= 15):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def joined(spans):
    return ",".join(f"{personal_data.KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def test_base_spans_equal_patterns():
    rnd = random.Random(6)
    bits = ["a.b+c@d-e.f.g", "4111 1111 1111 1111", "4111111111111112", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1",
            "+1 (980) 555-2833", "+12", "+", "@", "x@y", " ", "0", "-", ".", "é", "+1234567890123456", "\n", "00.0.0.0"]
    for _ in range(3000):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randrange(9)))
        assert personal_data.base_spans(text) == plain_base(text)


def test_gradient_and_paths_equal_enumeration():
    rnd = np.random.default_rng(3)
    model = personal_data._start(5, 2)
    model = personal_data.Model(*[(x + rnd.normal(0, 0.4, x.shape)).astype(np.float64) for x in model])
    steps, n = 4, 2
    chars = rnd.integers(0, personal_data.CLASSES, (steps, n)).astype(np.uint8)
    allowed, tags = personal_data.ALLOWED, range(personal_data.TAGS)
    ways = [p for p in itertools.product(tags, repeat=steps) if all(allowed[a, b] for a, b in zip(p, p[1:]))]
    score = personal_data.emissions(personal_data.Model(*[x.astype(np.float32) for x in model]), chars)
    gold = np.array([ways[i] for i in rnd.integers(0, len(ways), n)]).T

    def value(path, w):
        return sum(score[t, path[t], w] for t in range(steps)) + sum(model.moves[a, b] for a, b in zip(path, path[1:]))

    totals = [np.array([value(p, w) for p in ways]) for w in range(n)]
    best = personal_data.best_paths(model, score)
    for w in range(n):
        assert tuple(best[:, w]) == ways[int(totals[w].argmax())]
        if tuple(best[:, w]) != (0,) * steps:
            assert w in personal_data.undecided(model, score)
    loss, grad = personal_data._learn(model, chars, gold)
    want = np.mean([np.logaddexp.reduce(totals[w]) - value(gold[:, w], w) for w in range(n)])
    assert abs(loss - want) < 1e-3
    for k, (x, g) in enumerate(zip(model, grad)):
        for at in [tuple(rnd.integers(0, d) for d in x.shape) for _ in range(12)]:
            if k == 4 and not allowed[at]:
                continue
            sides = []
            for step in (1e-3, -1e-3):
                y = x.copy()
                y[at] += step
                sides.append(personal_data._learn(personal_data.Model(*[*model[:k], y, *model[k + 1:]]), chars, gold)[0])
            assert abs((sides[0] - sides[1]) / 2e-3 - g[at]) < 0.02


def test_reconcile_takes_the_best_set():
    rnd = random.Random(9)
    for _ in range(300):
        found = [(s, rnd.randrange(2), s + rnd.randrange(1, 9), rnd.uniform(1, 20), False, False)
                 for s in (rnd.randrange(30) for _ in range(rnd.randrange(8)))]

        def total(pick):
            pick = sorted(pick)
            return sum(x[3] for x in pick) if all(a[2] <= b[0] for a, b in zip(pick, pick[1:])) else -1

        best = max(total(p) for r in range(len(found) + 1) for p in itertools.combinations(found, r))
        got = personal_data.reconcile(found)
        odds = {}
        for s, k, e, o, _, _ in found:
            odds[s, k, e] = max(o, odds.get((s, k, e), 0))
        assert sum(odds[x] for x in got) <= best + 1e-9
        small = sum(o for o in odds.values() if o < personal_data.ODDS)
        assert sum(odds[x] for x in got) >= best - small - 1e-9
    assert personal_data.reconcile([(0, 0, 40, 9.0, False, True), (30, 0, 60, 9.0, True, False)]) == [(0, 0, 60)]


@pytest.fixture(scope="module")
def model(spark):
    return personal_data.fit(spark.read.parquet(TABLE).where("doc_id % 2 = 0"))


def test_tagger_on_texts_it_has_not_seen(spark, model):
    """Spans rewritten in forms that the patterns miss, in documents outside the sample; plain prose stays alone."""
    docs = spark.read.parquet(TABLE).where("text IS NOT NULL")
    seen = docs.where("doc_id % 2 = 0").select("text")
    new = docs.where("doc_id % 2 = 1").select("text").distinct().join(seen, "text", "left_anti")
    marked = [r.text for r in new.where(new.text.rlike(personal_data.MARK)).orderBy("text").limit(150).collect()]
    texts = marked + [r.text for r in new.where(~new.text.rlike("[0-9@]")).orderBy("text").limit(300).collect()]
    rnd = np.random.default_rng(1)
    hit, of = Counter(), Counter()
    for text in texts:
        for s, kind, e in personal_data.base_spans(text):
            for _ in range(6):
                new = personal_data.rewritten(rnd, kind, text[s:e])
                near = text[max(0, s - 300):s] + new + text[e:e + 300]
                at = min(s, 300)
                got = personal_data.spans_of([near], model)[0]
                if not any(b and x < at + len(new) and y > at for x, _, y, b in got):
                    of[kind] += 1
                    hit[kind] += (at, kind, at + len(new), False) in got
    assert sum(of.values()) > 100 and sum(hit.values()) >= 0.75 * sum(of.values())
    clean = [t for t in texts if not re.search("[0-9@]", t)]
    assert len(clean) > 100 and not any(personal_data.spans_of(clean, model))


def test_spans_do_not_depend_on_windows(model):
    """A span found alone is found, once and whole but for a character or two at
    its edge, wherever a long text's windows cut it."""
    word = "lorem ipsum dolor sit amet consectetur "
    span = "jo.doe [at] mail7 [dot] example [dot] com"
    alone = [x for x in personal_data.spans_of([word * 3 + span + " " + word * 3], model)[0]]
    if len(alone) != 1:
        pytest.skip("the small sample did not teach this form")
    for k in range(0, 2 * personal_data.WINDOW, 97):
        text = (word * 40)[:k] + " " + word * 3 + span + " " + word * 30
        got = personal_data.spans_of([text], model)[0]
        at = text.index(span)
        assert len(got) == 1 and abs(got[0][0] - at) <= 2 and abs(got[0][2] - at - len(span)) <= 2, k


def test_personal_data_awkward_and_empty(spark, model):
    df = awkward(spark)
    got = personal_data.digest(personal_data.find(df, model)).collect()
    want = Counter((r.doc_id, joined(plain_base(r.text))) for r in df.collect())
    assert Counter((r.doc_id, r.spans) for r in got) == want
    long = "é" * 700 + " a@b.cc " + "x" * 3000 + " 10.0.0.1 +1 (980) 555-2833 " + "y 7 " * 900
    rows = spark.createDataFrame([("k", long), ("k", long), (None, "1.2.3.4"), ("z", None)], "doc_id string, text string")
    for r in personal_data.digest(personal_data.find(rows, model)).collect():
        text = {"k": long, None: "1.2.3.4", "z": ""}[r.doc_id]
        base = joined(plain_base(text))
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(base.split(",")) <= set(r.spans.split(",")) and r.n_added == r.spans.count(":") // 2 - base.count(":") // 2
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == \
            [sum(k == kind for _, k, _ in plain_base(text)) for kind in range(4)]
    assert personal_data.find(empty(spark), model).count() == 0
    none = personal_data.fit(empty(spark))
    assert Counter((r.doc_id, r.spans) for r in personal_data.digest(personal_data.find(df, none)).collect()) == want
