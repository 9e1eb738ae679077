"""Language-model scores: Brown class-based bigrams over the whole corpus.

Training text is counted in full, and every word of it belongs to a class that
exchange found; the end of a text is a class of its own.  The probability of a
text is the product, over its tokens, of the class transition and of the word
given its class.  Each class keeps absolute-discounted mass for words that were
never seen; an unseen word takes the class in which most of the words seen once
have its shape (length and last character), and its shape's part of that mass.

Clustering: the ``CLUSTERED`` most frequent words (the seeds) are exchanged on
the driver in several sweeps, on a bigram table of fixed size in which every
other word stands for its shape.  Then Spark moves every other word, however
rare, to the class with the best gain in likelihood, given its (class after)
and (class before) counts, where a neighbour counts by class if it is a seed
and by shape if not.  Transitions are counted afterwards from the classes of
all tokens.

Counting is distributed.  For the exchange every piece of text gives one row per
distinct word, with its contexts; rows of a word meet by one shuffle and a sort.
Seeds need no contexts, so no word with more than 1 / ``CLUSTERED`` of all
tokens takes part in it.  Classes reach the texts once: the ``HEAD`` most frequent
words are looked up in a broadcast table of that fixed size, the distinct
rarer words of a text meet the full word table in a shuffle join, which yields
the exact count and class of every token.  The texts then are rows of class
pairs, from which transitions are counted and texts are scored.

Words are identified by a 64-bit hash.

Defined cases: null text is empty and has one token, its end; an empty
training set gives every token probability one; repeated rows are scored (and
trained on) each; equal gains go to the class of smaller number; null ids hash
as an empty text; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railyard.llm.staging import Stage
from railyard.llm.tokens import U64, text_chunks, word_hashes, word_spans

CLUSTERED = 512
CLUSTERS = 32
HEAD = 262_144
SWEEPS = 6
#: Weight of the class unigram in a transition.
BACKOFF = 5.0
_LENGTHS = np.array([2, 3, 5, 8, 12])  # bounds of the byte lengths of shapes
SHAPES = 4 * (len(_LENGTHS) + 1)
END_HASH = np.int64(0x454E44)
_START_HASH = np.int64(0x5354)
#: Word contexts that are weighed at once; text bytes whose words give their contexts together.
_ENTRIES = 1 << 16
_PIECE = 1 << 22

_LAST = np.full(256, 3, np.int64)  # kind of the last byte: letters and beyond ASCII, .!?, ,;: and the rest
_LAST[[*range(97, 123), *range(65, 91), *range(128, 256)]] = 0
_LAST[[33, 46, 63]] = 1
_LAST[[44, 58, 59]] = 2


def in_training(id_col: str, parts: int = 10) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % parts != 0


def _words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, shape, texts' offsets) of the words."""
    starts, ends, at = word_spans(buf, off)
    h = word_hashes(buf, starts, ends).view(np.int64)
    shape = _LAST[buf[ends - 1]] * (len(_LENGTHS) + 1) + np.searchsorted(_LENGTHS, ends - starts) if len(h) \
        else np.zeros(0, np.int64)
    return h, shape, at


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for _, k, buf, off in text_chunks(b.column(0)):
            h, shape, _ = _words(buf, off)
            u, first, n = np.unique(h, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(u, END_HASH)), pa.array(np.append(n, k)),
                 pa.array(np.append(shape[first], -1).astype(np.int32))], ["h", "c", "shape"])


def _lookup(table: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in the ascending table, whether it is there)."""
    if not len(table):
        return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
    at = np.searchsorted(table, h)
    at[at == len(table)] = 0
    return at, table[at] == h


def _sequence(unit: np.ndarray, at: np.ndarray, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Previous and current units of all tokens, the end of each text included."""
    n, k = len(at) - 1, np.diff(at)
    cur = np.full(len(unit) + n, end, np.int64)
    text = np.repeat(np.arange(n), k)
    cur[np.arange(len(unit)) + text] = unit
    prev = np.empty(len(cur), np.int64)
    prev[1:] = cur[:-1]
    prev[at[:-1] + np.arange(n)] = start
    return prev, cur


def _bigrams(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = held.value  # ascending hashes of the clustered words
        n = len(words) + SHAPES + 2
        total = np.zeros(n * n, np.int64)
        for b in batches:
            for _, _, buf, off in text_chunks(b.column(0)):
                h, shape, at = _words(buf, off)
                place, hit = _lookup(words, h)
                prev, cur = _sequence(np.where(hit, place, len(words) + shape), at, n - 1, n - 2)
                total += np.bincount(prev * n + cur, minlength=n * n)
        code = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(total[code])], ["code", "n"])
    return run


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def exchange(counts: np.ndarray, words: int, clusters: int = CLUSTERS, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each unit: the first ``words`` units are moved between
    ``clusters`` classes while the class bigram likelihood grows; every other
    unit keeps a class of its own."""
    n = len(counts)
    clusters = max(1, min(clusters, words))
    order = np.argsort(-counts[:words].sum(1), kind="stable")
    cls = np.concatenate([np.zeros(words, np.int64), clusters + np.arange(n - words)])
    cls[order] = np.arange(words) % clusters
    size = clusters + n - words
    b = counts.astype(float)
    member = np.zeros((n, size))
    member[np.arange(n), cls] = 1
    table = member.T @ b @ member
    for _ in range(sweeps):
        moved = 0
        for w in order:
            a = cls[w]
            member[w, a] = 0
            row, col, own = b[w] @ member, b[:, w] @ member, b[w, w]
            table[a] -= row
            table[:, a] -= col
            table[a, a] -= own
            k = np.arange(clusters)
            t_row, t_col, diag = table[:clusters], table[:, :clusters].T, table[k, k]
            gain = (_f(t_row + row) - _f(t_row)).sum(1) + (_f(t_col + col) - _f(t_col)).sum(1)
            gain -= _f(diag + row[k]) - _f(diag) + _f(diag + col[k]) - _f(diag)
            gain += _f(diag + row[k] + col[k] + own) - _f(diag)
            out, into = t_row.sum(1), t_col.sum(1)
            gain -= _f(out + row.sum() + own) - _f(out) + _f(into + col.sum() + own) - _f(into)
            best = int(gain.argmax())
            best = int(a) if gain[best] <= gain[a] + 1e-9 else best
            moved += best != a
            cls[w] = best
            member[w, best] = 1
            table[best] += row
            table[:, best] += col
            table[best, best] += own
        if not moved:
            break
    return cls


def contexts(ph, pc, ch, cc, size: int, moving: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, context, times), ascending, of the words ``moving`` (ascending)
    in pairs of tokens: ``c`` stands for class ``c`` after the word, ``size + c``
    for before it, ``2 * size`` for the word itself after it.  Words come as
    places in ``moving``."""
    first, is_first = _lookup(moving, ph)
    second, is_second = _lookup(moving, ch)
    own = (ph == ch) & is_first
    width = 2 * size + 1
    code, n = np.unique(np.concatenate([
        first[is_first & ~own] * width + cc[is_first & ~own],
        second[is_second & ~own] * width + size + pc[is_second & ~own],
        first[own] * width + 2 * size]), return_counts=True)
    return code // width, code % width, n


def _lists(at: np.ndarray, values: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values, kind))


def _word_contexts(held):
    """(word, times, shape, contexts) of the words of each piece that are no seeds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds, of_seeds, shapes, start, end = held.value
        for b in batches:
            for _, _, buf, off in text_chunks(b.column(0), _PIECE):
                h, shape, at = _words(buf, off)
                place, hit = _lookup(seeds, h)
                pc, cc = _sequence(np.where(hit, of_seeds[place], shapes + shape), at, start, end)
                ph, ch = _sequence(h, at, _START_HASH, END_HASH)
                words, where, times = np.unique(h[~hit], return_index=True, return_counts=True)
                if not len(words):
                    continue
                word, ctx, n = contexts(ph, pc, ch, cc, start + 1, words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words), pa.array(times), pa.array(shape[~hit][where].astype(np.int32)),
                     _lists(np.searchsorted(word, np.arange(len(words) + 1)), n << 16 | ctx, pa.int64())],
                    ["h", "c", "shape", "near"])
    return run


def best_classes(table: np.ndarray, clusters: int, was: np.ndarray, word: np.ndarray, ctx: np.ndarray,
                 n: np.ndarray) -> np.ndarray:
    """Class of the best gain for each word, the class bigrams ``table`` held
    fixed.  ``was``: class whose counts in the table hold the word's (-1: none of
    the clusters); (``word``, ``ctx``, ``n``): contexts in order of the words."""
    size, m = len(table), len(was)
    table, n = table.astype(float), n.astype(float)
    gain = np.zeros((m, clusters))
    beside = np.zeros((2, m, size))
    own = np.bincount(word[ctx == 2 * size], weights=n[ctx == 2 * size], minlength=m)
    inside = np.flatnonzero(was >= 0)
    for side, t in ((0, table[:clusters].T), (1, table[:, :clusters])):
        part = np.flatnonzero(ctx // size == side)
        if not len(part):
            continue
        c, x, w = ctx[part] % size, n[part], word[part]
        beside[side][w, c] = x
        g = _f(t[c] + x[:, None]) - _f(t)[c]
        i = np.flatnonzero(was[w] >= 0)
        held = t[c[i], was[w[i]]]
        g[i, was[w[i]]] = _f(held) - _f(np.maximum(held - x[i], 0))
        i = np.flatnonzero(c < clusters)
        g[i, c[i]] = 0  # the class beside itself: below
        first = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
        gain[w[first]] += np.add.reduceat(g, first, axis=0)
    k = np.arange(clusters)
    more = beside[0][:, :clusters] + beside[1][:, :clusters] + own[:, None]
    rest = np.tile(table[k, k], (m, 1))
    rest[inside, was[inside]] -= more[inside, was[inside]]
    rest = np.maximum(rest, 0)
    gain += _f(rest + more) - _f(rest)
    for side, whole in ((0, table[:clusters].sum(1)), (1, table[:, :clusters].sum(0))):
        more = (beside[side].sum(1) + own)[:, None]
        rest = np.tile(whole, (m, 1))
        rest[inside, was[inside]] -= more[inside, 0]
        rest = np.maximum(rest, 0)
        gain -= _f(rest + more) - _f(rest)
    return gain.argmax(1)


def _classes(held):
    """(h, c, shape, cls) of rows of ``_word_contexts`` sorted by word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, clusters = held.value
        wait = None  # the last word so far, its rows merged

        def settled(h, c, shape, at, ctx, n) -> pa.RecordBatch:
            cls, i, none = np.empty(len(h), np.int64), 0, np.full(len(h), -1)
            while i < len(h):
                j = max(i + 1, int(np.searchsorted(at, at[i] + _ENTRIES, side="right")) - 1)
                j = min(j, i + _ENTRIES // 64)
                cls[i:j] = best_classes(table, clusters, none[i:j], np.repeat(np.arange(j - i), np.diff(at[i:j + 1])),
                                        ctx[at[i]:at[j]], n[at[i]:at[j]])
                i = j
            return pa.RecordBatch.from_arrays([pa.array(h), pa.array(c), pa.array(shape), pa.array(cls.astype(np.int32))],
                                              ["h", "c", "shape", "cls"])

        for b in batches:
            h, c, shape = (b.column(i).to_numpy() for i in range(3))
            size, near = _flat(b.column(3))
            near = near.to_numpy()
            if wait is not None:
                h, c, shape = (np.concatenate([x, y]) for x, y in zip(wait[:3], (h, c, shape)))
                size, near = np.append(len(wait[3]), size), np.concatenate([wait[3], near])
            if not len(h):
                continue
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            word = np.repeat(np.cumsum(np.concatenate([[0], h[1:] != h[:-1]])), size)
            code = word << 16 | near & 65535
            order = np.argsort(code, kind="stable")
            code, n = code[order], near[order] >> 16
            new = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, int)
            code, n = code[new], np.add.reduceat(n, new) if len(new) else n
            h, c, shape = h[first], np.add.reduceat(c, first), np.minimum.reduceat(shape, first)
            at = np.searchsorted(code >> 16, np.arange(len(h) + 1))
            k, m = len(h) - 1, at[-2]
            wait = (h[k:], c[k:], shape[k:], n[m:] << 16 | code[m:] & 65535)
            if k:
                yield settled(h[:k], c[:k], shape[:k], at[:-1], code[:m] & 65535, n[:m])
        if wait is not None:
            yield settled(*wait[:3], np.array([0, len(wait[3])]), wait[3] & 65535, wait[3] >> 16)
    return run


class Model:
    """What scoring needs where the texts are; size bounded by HEAD."""

    def __init__(self, head_h, head_c, head_cls, emission, base, start, end):
        self.head_h, self.head_c, self.head_cls = head_h, head_c, head_cls
        self.emission = emission  # log10
        self.base, self.start, self.end = base, start, end  # base: (N, V, count of the end)


def _sums(of: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(of, weights=values, minlength=n).astype(float)


def _score(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = held.value
        total, vocabulary, c_end = m.base
        bottom = np.log10(total + 0.1 * (vocabulary + 1))
        for b in batches:
            for i, k, buf, off in text_chunks(b.column(2)):
                h, shape, at = _words(buf, off)
                place, hit = _lookup(m.head_h, h)
                text = np.repeat(np.arange(k), np.diff(at))
                base = _sums(text[hit], np.log10(m.head_c[place[hit]] + 0.1) - bottom, k)
                base += np.log10(c_end + 0.1) - bottom
                emit = _sums(text[hit], m.emission[place[hit]], k)
                # distinct rarer words of each text
                rare = np.flatnonzero(~hit)
                rare = rare[np.lexsort((h[rare], text[rare]))]
                th, tt, ts = h[rare], text[rare], shape[rare]
                new = np.ones(len(th), bool)
                new[1:] = (th[1:] != th[:-1]) | (tt[1:] != tt[:-1])
                where = np.flatnonzero(new)
                tf = np.diff(np.append(where, len(th)))
                lists = np.searchsorted(tt[where], np.arange(k + 1)).astype(np.int32)
                # classes; a rarer word is -1 less its place in its text's list
                cls = m.head_cls[place] if len(m.head_h) else np.zeros(len(h), np.int64)
                cls[rare] = lists[tt] - np.cumsum(new)
                units = _sequence(cls, at, m.start, m.end)[1]
                known = np.bincount(text[hit], minlength=k) + (c_end > 0)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, k), b.column(1).slice(i, k), pa.array(np.diff(at) + 1), pa.array(known),
                     pa.array(base), pa.array(emit), _lists(lists, th[where], pa.int64()),
                     _lists(lists, tf * 64 + ts[where], pa.int64()),
                     _lists(at + np.arange(k + 1), units.astype(np.int32), pa.int32())],
                    ["id", "train", "n_tokens", "known", "base", "model", "tail_h", "tail_k", "units"])
    return run


def _flat(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(lengths, values) of a list column."""
    at = column.offsets.to_numpy()
    return np.diff(at), column.flatten()


def _pairs(start: int):
    """The last two columns (units, classes of the rarer words by place) become
    the class pairs of the text: (class before) * (start + 1) + (class)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            (size, units), (rare, got) = (_flat(c) for c in b.columns[-2:])
            first, at = np.cumsum(rare) - rare, np.concatenate([[0], np.cumsum(size)])
            classes = np.zeros(len(got), np.int64)
            classes[np.repeat(first, rare) + got.field(0).to_numpy()] = got.field(1).to_numpy()
            x = units.to_numpy().astype(np.int64)
            open_ = np.flatnonzero(x < 0)
            x[open_] = classes[first[np.searchsorted(at, open_, side="right") - 1] - x[open_] - 1]
            before = np.empty_like(x)
            before[1:] = x[:-1]
            before[at[:-1]] = start  # every text has its end, so none is empty
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], _lists(at, before * (start + 1) + x, pa.int32())],
                                             [*b.schema.names[:-2], "pairs"])
    return run


def _pair_counts(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for b in batches:
            total += np.bincount(_flat(b.column(0))[1].to_numpy(), minlength=size * size)
        code = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(total[code])], ["code", "n"])
    return run


def _steps(held):
    """The last column (class pairs) becomes the sum of their transitions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transition = held.value
        for b in batches:
            size, pairs = _flat(b.columns[-1])
            owner = np.repeat(np.arange(len(b)), size)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(_sums(owner, transition[pairs.to_numpy()], len(b)))],
                                             [*b.schema.names[:-1], "steps"])
    return run


def class_stats(classed: DataFrame, clusters: int) -> tuple[np.ndarray, ...]:
    """(tokens, discount, class of an unseen word of each shape, log10 of an
    unseen word of each shape in that class) of the classes."""
    stats = classed.groupBy("cls", "shape").agg(
        F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"), F.sum(F.expr("CAST(c = 1 AS BIGINT)")).alias("n1"),
        F.sum(F.expr("CAST(c = 2 AS BIGINT)")).alias("n2")).collect()  # at most clusters * SHAPES rows
    mass, kinds, twice, once = np.zeros(clusters), np.zeros(clusters), np.zeros(clusters), np.zeros((clusters, SHAPES))
    for r in stats:
        mass[r["cls"]] += r["n"]
        kinds[r["cls"]] += r["v"]
        twice[r["cls"]] += r["n2"]
        once[r["cls"], r["shape"]] += r["n1"]
    n1 = once.sum(1)
    discount = np.clip((n1 + 0.5) / (n1 + 2 * twice + 1), 0.05, 0.9)
    share = once.sum(0) + 0.5
    unseen = np.where(once.sum(0) > 0, once.argmax(0), int((discount * kinds).argmax()))
    in_class = np.bincount(unseen, weights=share, minlength=clusters)
    discount[in_class == 0] = 0.0  # nothing unseen falls here
    mass = np.maximum(mass, 1.0)
    kept = np.where(kinds > 0, discount * kinds / mass, 1.0)[unseen]
    return mass, discount, unseen, np.log10(kept * share / in_class[unseen])


def transitions(table: np.ndarray, start: int) -> np.ndarray:
    """log10 of the smoothed transitions of class bigrams ``table``."""
    unigram = table.sum(0) + 1.0
    unigram[start] = 0
    unigram /= unigram.sum()
    return np.log10(np.maximum((table + BACKOFF * unigram) / (table.sum(1, keepdims=True) + BACKOFF), 1e-300))


def _square(rows: DataFrame, size: int) -> np.ndarray:
    """The table of (code, n) rows, at most size * size of them."""
    out = np.zeros(size * size)
    for r in rows.groupBy("code").agg(F.sum("n").alias("n")).collect():
        out[r["code"]] = r["n"]
    return out.reshape(size, size)


def _arrays(df: DataFrame) -> list[np.ndarray]:
    """Columns of a table of bounded size, on the driver."""
    found = df.toArrow()
    return [found.column(i).to_numpy() for i in range(found.num_columns)]


def learn_classes(train: DataFrame, words: DataFrame, seeds: np.ndarray, clusters: int) -> tuple[DataFrame, int]:
    """(h, c, shape, cls) of all words of the texts ``train``, and the number of
    classes; ``seeds``: ascending hashes of the words exchanged on the driver."""
    send = train.sparkSession.sparkContext.broadcast
    n, clusters = len(seeds) + SHAPES + 2, max(1, min(clusters, len(seeds)))
    counts = _square(train.mapInArrow(_bigrams(send(seeds)), "code bigint, n bigint"), n)
    of_seeds = exchange(counts, len(seeds), clusters)
    member = np.zeros((n, clusters + n - len(seeds)))
    member[np.arange(n), of_seeds] = 1
    table, of_seeds = member.T @ counts @ member, of_seeds[:len(seeds)]
    near = train.mapInArrow(_word_contexts(send((seeds, of_seeds, clusters, clusters + SHAPES + 1, clusters + SHAPES))),
                            "h bigint, c bigint, shape int, near array<bigint>")
    field = "h bigint, c bigint, shape int, cls int"
    others = near.repartition("h").sortWithinPartitions("h").mapInArrow(_classes(send((table, clusters))), field)
    cls = train.sparkSession.createDataFrame(list(zip(seeds.tolist(), of_seeds.tolist())), "h bigint, cls int")
    own = words.join(F.broadcast(cls), "h").select("h", "c", "shape", "cls")  # CLUSTERED rows
    return others.unionByName(own), clusters


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int = 10,
          clusters: int = CLUSTERS) -> DataFrame:
    """(id_col, held_out, n_tokens, n_known, train_tokens, base_score, score)."""
    spark = docs.sparkSession
    st = Stage(spark, "class-lm")
    send = spark.sparkContext.broadcast
    train = docs.where(in_training(id_col, parts)).select(F.col(text_col).alias("text"))
    words = st.stage(train.mapInArrow(_count, "h bigint, c bigint, shape int")
                     .groupBy("h").agg(F.sum("c").alias("c"), F.min("shape").alias("shape")), "words")
    # the most frequent words: as many classes of counts as hold at most HEAD words in all
    level = F.floor(F.log2("c") * 8).cast("int")
    cut, held_words = None, 0
    for r in sorted(words.groupBy(level.alias("level")).count().collect(), reverse=True):  # at most 8 * 64 rows
        held_words += r["count"]
        if held_words > HEAD:
            break
        cut = r["level"]
    no_end = F.col("h") != int(END_HASH)
    often = (level >= cut if cut is not None else F.lit(False)) & no_end
    c_end = words.where(~no_end).agg(F.max("c")).first()[0] or 0
    seeds = np.sort(_arrays(words.where(no_end).orderBy(F.desc("c"), "h").limit(CLUSTERED).select("h"))[0])
    if len(seeds):
        classed, clusters = learn_classes(train, words, seeds, clusters)
    else:
        classed, clusters = words.where(no_end).withColumn("cls", F.lit(0)), 1
    classed = st.stage(classed, "classes")
    end, start = clusters, clusters + 1
    size = clusters + 2
    mass, discount, unseen_class, unknown = class_stats(classed, clusters)
    total, vocabulary = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    head_h, head_c, head_cls = _arrays(classed.where(often).select("h", "c", "cls").orderBy("h"))  # at most HEAD rows
    head_c = head_c.astype(np.float64)
    emission = np.log10((head_c - discount[head_cls]) / mass[head_cls]) if len(head_h) else np.zeros(0)
    shared = send(Model(head_h, head_c, head_cls, emission, (total, vocabulary, c_end), start, end))
    kind = docs.schema[id_col].dataType.simpleString()
    sums_of = f"id {kind}, train boolean, n_tokens bigint, known bigint, base double, model double"
    rows = (docs.select(F.col(id_col).alias("id"), in_training(id_col, parts).alias("train"), F.col(text_col))
            .mapInArrow(_score(shared), f"{sums_of}, tail_h array<bigint>, tail_k array<bigint>, units array<int>")
            .withColumn("row", F.monotonically_increasing_id()))
    rows = st.stage(rows, "rows")
    tail = (rows.where(F.size("tail_h") > 0)
            .select("row", F.posexplode(F.arrays_zip("tail_h", "tail_k")).alias("pos", "x"))
            .select("row", "pos", F.col("x.tail_h").alias("h"), F.shiftright("x.tail_k", 6).alias("tf"),
                    F.col("x.tail_k").bitwiseAND(63).cast("int").alias("k")))

    def listed(values: np.ndarray, at: Column) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values.tolist()]), at + 1)

    found = tail.join(classed.where(~often).select("h", "c", "cls"), "h", "left")
    c, seen = F.coalesce("c", F.lit(0)), F.col("c").isNotNull()
    sums = found.groupBy("row").agg(
        F.sum(F.col("tf") * F.log10(c + 0.1)).alias("base_tail"), F.sum("tf").alias("tf"),
        F.sum(F.when(seen, F.col("tf")).otherwise(0)).alias("known_tail"),
        F.sum(F.col("tf") * F.when(~seen, listed(unknown, F.col("k"))).otherwise(
            F.log10((F.col("c") - listed(discount, F.col("cls"))) / listed(mass, F.col("cls"))))).alias("model_tail"),
        F.collect_list(F.struct("pos", F.coalesce("cls", listed(unseen_class.astype(np.int64), F.col("k"))).cast("int")
                                .alias("cls"))).alias("got"))
    zero = F.lit(0.0)
    bottom = F.lit(float(np.log10(total + 0.1 * (vocabulary + 1))))
    none = F.expr("CAST(array() AS array<struct<pos: int, cls: int>>)")
    whole = (rows.drop("tail_h", "tail_k").join(sums, "row", "left")
             .select("id", "train", "n_tokens", (F.col("known") + F.coalesce("known_tail", F.lit(0))).alias("known"),
                     (F.col("base") + F.coalesce("base_tail", zero) - F.coalesce("tf", F.lit(0)) * bottom).alias("base"),
                     (F.col("model") + F.coalesce("model_tail", zero)).alias("model"), "units",
                     F.coalesce("got", none).alias("got")))
    whole = st.stage(whole.mapInArrow(_pairs(start), f"{sums_of}, pairs array<int>"), "pairs")
    st.discard(rows)
    table = _square(whole.where("train").select("pairs").mapInArrow(_pair_counts(size), "code bigint, n bigint"), size)
    return (whole.mapInArrow(_steps(send(transitions(table, start).ravel())), f"{sums_of}, steps double")
            .select(F.col("id").alias(id_col), (~F.col("train")).alias("held_out"), "n_tokens",
                    F.col("known").cast("long").alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
                    F.col("base").alias("base_score"), (F.col("model") + F.col("steps")).alias("score")))
