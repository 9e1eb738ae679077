"""Spelling variants by blocked Gram matrices of letter counts.

``word_counts`` takes the words of all texts.  Two words are near when one
inserted, deleted or replaced letter turns one into the other.  Then their
letter counts x and y differ by at most 1 in at most two letters, and their
squared distance |x|^2 + |y|^2 - 2 x.y is 1 or 2.

Blocks: the letters are dealt to ``GROUPS`` groups of about equal frequency; the
counts of near words agree on all letters of at least ``GROUPS - 2`` groups, so
words meet under a key for each choice of that many groups.  Inside a key the
words lie in blocks by length, and NumPy multiplies the letter-count matrix of
each length with those of the same and of the next length; pairs at most two
apart are compared letter by letter.  A pair that shares several keys counts
under the first of them only.  A key with more than ``TILE`` words is cut into
tiles, and every pair of tiles is a task's work of its own, so no group grows
without bound in one place and nothing is left out.

``variants`` takes each word's form, its near word of largest count if that is
at least ``FACTOR`` times its own, and the root at the end of its chain of
forms.  Counts grow along a chain by that factor, so few rounds of pointer
doubling (set by the largest count) reach the end.

Defined cases: null texts have no words; a null id counts as an empty string;
repeated rows each count; an empty table gives an empty result; ties between
forms go to the word first in code-point order.  Other columns are ignored.
Within a task runs are grouped by 64-bit hashes; words meet as strings.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.llm.staging import Stage, reach
from railyard.llm.tokens import text_chunks, word_hashes

MIN_LETTERS, MIN_COUNT, FACTOR = 7, 2, 10
#: One run in so many loses a letter.
DROP_EVERY = 31
GROUPS = 5
#: Words of a key that are multiplied at once; rows of small keys handled together.
TILE, PACK = 1024, 256
#: Text bytes whose runs are counted together.
CHUNK = 1 << 22
#: ``[A-Za-z]`` and the 64 characters U+00C0 to U+00FF, in UTF-8 the byte C3 and one more.
LEAD = 0xC3

_ASCII = np.zeros(256, bool)
_ASCII[65:91] = _ASCII[97:123] = True


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> np.uint32(1)) ^ np.uint32(0xEDB88320), c >> np.uint32(1))
    return c


_CRC = _crc_table()


def run_spans(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of the letter runs of all texts."""
    lead = buf == LEAD
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = _ASCII[buf] | lead
    inside[2:-1] |= lead[:-1]
    starts = np.flatnonzero((inside[1:-1] == 1) & (inside[:-2] == 0))
    ends = np.flatnonzero((inside[1:-1] == 1) & (inside[2:] == 0)) + 1
    cut = off[1:-1]
    cut = cut[(cut > 0) & (cut < len(buf))]
    cut = np.unique(cut[(inside[cut] == 1) & (inside[cut + 1] == 1)])
    if len(cut):
        starts, ends = np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))
    return starts, ends


def continued_crc(state: np.ndarray, buf: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """crc32 after the bytes of each run; ``state``: crc32 of what precedes it."""
    c = state ^ np.uint32(0xFFFFFFFF)
    order = np.argsort(-sizes, kind="stable")
    c, at, left = c[order], starts[order], sizes[order]
    for k in range(int(sizes.max(initial=0))):
        n = int(np.searchsorted(-left, -k, side="left"))  # runs longer than k come first
        c[:n] = _CRC[(c[:n] ^ buf[at[:n] + k]) & 255] ^ (c[:n] >> np.uint32(8))
    out = np.empty_like(c)
    out[order] = c ^ np.uint32(0xFFFFFFFF)
    return out


def _strings(buf: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    at = np.concatenate([[0], np.cumsum(sizes)])
    take = np.arange(at[-1]) + np.repeat(starts - at[:-1], sizes)
    return pa.Array.from_buffers(pa.large_string(), len(starts), [
        None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(buf[take]))]).cast(pa.string())


def _count(letters: int):
    """(word, n) of the runs of a piece of the texts, equal words of a piece together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, k, raw, off in text_chunks(b.column(1), CHUNK):
                if not len(raw):
                    continue
                buf = raw.copy()
                upper = (buf >= 65) & (buf <= 90)
                buf[upper] += 32
                starts, ends = run_spans(buf, off)
                # C3 and its next byte are one letter
                points = np.concatenate([np.zeros(1, np.int32), np.cumsum(buf != LEAD, dtype=np.int32)])
                size = points[ends] - points[starts]
                starts, ends, size = (x[size >= letters] for x in (starts, ends, size))
                if not len(starts):
                    continue
                ids = b.column(0).slice(i, k).to_pylist()
                before = np.array([zlib.crc32(b"%s:" % (b"" if d is None else str(d).encode())) for d in ids], np.uint32)
                doc = np.searchsorted(off, starts, side="right") - 1
                h = continued_crc(before[doc], buf, starts, ends - starts)
                cut = h % DROP_EVERY == 0
                keys = word_hashes(buf, starts, ends, lower=False)
                _, first, n = np.unique(keys[~cut], return_index=True, return_counts=True)
                whole = _strings(buf, starts[~cut][first], (ends - starts)[~cut][first])
                short = []
                for s, e, points_of, hh in zip(starts[cut].tolist(), ends[cut].tolist(), size[cut].tolist(),
                                               h[cut].tolist()):
                    if points_of > letters:
                        w = buf[s:e].tobytes().decode()
                        p = hh % points_of
                        short.append(w[:p] + w[p + 1:])
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([whole, pa.array(short, pa.string())]),
                     pa.concat_arrays([pa.array(n, pa.int64()), pa.array([1] * len(short), pa.int64())])], ["word", "n"])
    return run


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", letters: int = MIN_LETTERS,
                least: int = MIN_COUNT) -> DataFrame:
    """(word, n): words of at least ``letters`` letters found at least ``least`` times."""
    reach(docs.sparkSession)
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(_count(letters), "word string, n bigint")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least))


def _letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(letter, times it occurs in words) of each batch."""
    for b in batches:
        points = np.frombuffer("".join(b.column(0).to_pylist()).encode("utf-32-le"), np.uint32)
        letter, n = np.unique(points, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(letter, pa.int32()), pa.array(n, pa.int64())], ["letter", "n"])


def deal(letters: dict[int, int], groups: int = GROUPS) -> dict[int, int]:
    """Letter to group: the most frequent ones one to each group, back and forth."""
    order = sorted(letters, key=lambda c: (-letters[c], c))
    return {c: (r % groups if r // groups % 2 == 0 else groups - 1 - r % groups) for r, c in enumerate(order)}


class Alphabet:
    """Letters of the words as columns, and their groups."""

    def __init__(self, group: dict[int, int], groups: int = GROUPS):
        self.known = np.array(sorted(group), np.uint32)
        self.group = np.array([group[c] for c in sorted(group)], np.int64)
        self.groups = groups
        self.choices = list(combinations(range(groups), max(1, groups - 2)))

    def spell(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sizes, letter columns (padded by -1) and letter counts of the words."""
        size = np.array([len(w) for w in words], np.int64)
        at = np.searchsorted(self.known, np.frombuffer("".join(words).encode("utf-32-le"), np.uint32))
        row = np.repeat(np.arange(len(words)), size)
        place = np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)
        spelt = np.full((len(words), int(size.max(initial=0)) + 1), -1, np.int16)
        spelt[row, place] = at
        counts = np.zeros((len(words), len(self.known)), np.float32)
        np.add.at(counts, (row, at), 1)
        return size, spelt, counts

    def keys(self, counts: np.ndarray) -> np.ndarray:
        """Of each word, a 64-bit key of its counts on the letters of each choice of groups."""
        rnd = np.random.default_rng(20011)
        factor = rnd.integers(1, 1 << 62, len(self.known), np.int64)
        salt = rnd.integers(1, 1 << 62, len(self.choices), np.int64)
        whole = counts.astype(np.int64)
        sums = np.stack([(whole * (self.group == g)) @ factor for g in range(self.groups)], 1)
        with np.errstate(over="ignore"):
            return np.stack([sums[:, c] @ rnd.integers(1, 1 << 62, len(c), np.int64) + s
                             for c, s in zip(map(list, self.choices), salt)], 1)

    def first_choice(self, touched: np.ndarray) -> np.ndarray:
        """First choice that avoids the groups marked in each row of ``touched``."""
        free = np.stack([~touched[:, list(c)].any(1) for c in self.choices], 1)
        return free.argmax(1)


def _keyed(alphabet: Alphabet):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            keys = alphabet.keys(alphabet.spell(b.column(0).to_pylist())[2])
            at = pa.array(np.arange(0, keys.size + 1, keys.shape[1]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.ListArray.from_arrays(at, pa.array(keys.ravel()))], ["word", "n", "keys"])
    return run


def one_edit(spelt: np.ndarray, size: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether words i and j, j as long as i or one letter longer, are one edit apart."""
    a, b = spelt[i], spelt[j]
    same = size[i] == size[j]
    differ = a != b
    replaced = differ.sum(1) == 1
    lead = np.where(differ.any(1), differ.argmax(1), a.shape[1])
    shifted = (a[:, :-1] == b[:, 1:]) | (np.arange(a.shape[1] - 1) < lead[:, None])
    inserted = (shifted | (np.arange(a.shape[1] - 1) >= size[i][:, None])).all(1)
    return np.where(same, replaced, inserted & (size[j] == size[i] + 1))


def close_pairs(group: np.ndarray, tile: np.ndarray, cross: np.ndarray, choice: np.ndarray, words: list[str],
                alphabet: Alphabet) -> tuple[np.ndarray, np.ndarray]:
    """Near pairs within equal ``group``: products of the letter counts of each
    length with those of the same and the next length."""
    size, spelt, counts = alphabet.spell(words)
    square = np.einsum("ij,ij->i", counts, counts)
    firsts, seconds = [], []
    for s in np.unique(size):
        rows = np.flatnonzero(size == s)
        more = np.concatenate([rows, np.flatnonzero(size == s + 1)])
        distance = square[rows][:, None] + square[more][None, :] - 2 * (counts[rows] @ counts[more].T)
        i, j = np.nonzero((distance < 2.5) & (distance > 0.5))
        keep = (j >= len(rows)) | (i < j)
        i, j = rows[i[keep]], more[j[keep]]
        keep = (group[i] == group[j]) & (~cross[i] | (tile[i] != tile[j]))
        firsts.append(i[keep])
        seconds.append(j[keep])
    i, j = np.concatenate(firsts), np.concatenate(seconds)
    keep = one_edit(spelt, size, i, j)
    i, j = i[keep], j[keep]
    changed = counts[i] != counts[j]
    touched = np.stack([(changed & (alphabet.group == g)).any(1) for g in range(alphabet.groups)], 1)
    keep = alphabet.first_choice(touched) == choice[i]
    return i[keep], j[keep]


def _near(alphabet: Alphabet):
    """Near pairs, both ways, of rows sorted by key and pair of tiles."""
    def answer(cols: list[np.ndarray]) -> pa.RecordBatch:
        key, low, high, tile, choice, words, n = cols
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        i, j = close_pairs(np.cumsum(new), tile, low != high, choice, words.tolist(), alphabet)
        a, b = np.concatenate([i, j]), np.concatenate([j, i])
        return pa.RecordBatch.from_arrays([pa.array(words[a], pa.string()), pa.array(words[b], pa.string()),
                                           pa.array(n[b], pa.int64())], ["word", "near", "near_n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wait = None
        for b in batches:
            cols = [b.column(c).to_numpy(zero_copy_only=False)
                    for c in ("key", "low", "high", "tile", "choice", "word", "n")]
            if wait is not None:
                cols = [np.concatenate(x) for x in zip(wait, cols)]
            key, low, high = cols[:3]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
            starts = np.flatnonzero(new)
            begin = 0
            for k in range(1, len(starts)):  # whole groups, up to PACK rows together
                nxt = starts[k + 1] if k + 1 < len(starts) else len(key)
                if nxt - begin > PACK:
                    if starts[k] - begin > 1:
                        yield answer([c[begin:starts[k]] for c in cols])
                    begin = starts[k]
            wait = [c[begin:] for c in cols]
        if wait is not None and len(wait[0]) > 1:
            yield answer(wait)
    return run


def near_words(words: DataFrame, tile: int = TILE, groups: int = GROUPS) -> DataFrame:
    """(word, near, near_n): all pairs one edit apart, both ways; ``words``: (word, n), each word once."""
    reach(words.sparkSession)
    found = {r["letter"]: r["n"] for r in words.select("word").mapInArrow(_letters, "letter int, n bigint")
             .groupBy("letter").agg(F.sum("n").alias("n")).collect()}  # a row for each letter of the alphabet
    alphabet = Alphabet(deal(found, groups), groups)
    keyed = (words.mapInArrow(_keyed(alphabet), "word string, n bigint, keys array<bigint>")
             .select("word", "n", F.posexplode("keys").alias("choice", "key")))
    large = keyed.groupBy("key").count().where(F.col("count") > tile).withColumnRenamed("key", "large")
    tiles = F.when(F.col("large").isNull(), 1).otherwise(F.ceil(F.col("count") / tile)).cast("int")
    at = F.col("tile")
    cells = (keyed.join(large, F.col("key") == F.col("large"), "left")
             .withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
             .select("key", F.least(at, "other").alias("low"), F.greatest(at, "other").alias("high"), "tile", "choice",
                     "word", "n"))
    cells = cells.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    return cells.mapInArrow(_near(alphabet), "word string, near string, near_n bigint")


def variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of ``words`` (word, n), each word once."""
    st = Stage(words.sparkSession, "spelling")
    words = st.stage(words, "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    near = (near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best")))
    big = F.col("n_near").isNotNull() & (-F.col("best.less") >= factor * F.col("n"))
    found = st.stage(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(big, F.col("best.form")).alias("form"), F.when(big, -F.col("best.less")).alias("form_n")), "forms")
    most = found.agg(F.max("form_n")).first()[0] or 1
    steps = max(1, math.ceil(math.log(most, factor)))  # a chain has no more forms than this
    chain = found.where("form IS NOT NULL").select("word", F.col("form").alias("to"))
    for _ in range(max(0, math.ceil(math.log2(steps)))):
        nxt = chain.select(F.col("word").alias("to"), F.col("to").alias("then"))
        chain = st.stage(chain.join(nxt, "to", "left").select("word", F.coalesce("then", "to").alias("to")), "chain")
    return (found.join(chain, "word", "left")
            .select("word", "form", F.coalesce("to", "word").alias("root"), "n", "n_near", "form_n"))


def oracle_sql(letters: int = MIN_LETTERS, least: int = MIN_COUNT, factor: int = FACTOR) -> str:
    """crc32 byte by byte over the UTF-8 codes; near words by shared one-letter deletions."""
    low = "translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    code = "unicode(substr(s, i::INT, 1))"
    return rf"""
WITH RECURSIVE bits AS (SELECT i, i::BIGINT AS c, 0 AS k FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS tab FROM bits WHERE k = 8),
runs AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
kinds AS (SELECT coalesce(doc_id::VARCHAR, '') AS d, {low} AS w, count(*) AS k FROM runs
          WHERE length(run) >= {letters} GROUP BY ALL),
hashed AS (SELECT w, k, length(w) AS len, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(flatten(list_transform(range(1, length(d || ':' || w) + 1),
      lambda i: CASE WHEN unicode(substr(d || ':' || w, i::INT, 1)) < 128
                     THEN [unicode(substr(d || ':' || w, i::INT, 1))::BIGINT]
                     ELSE [192 + unicode(substr(d || ':' || w, i::INT, 1)) // 64,
                           128 + unicode(substr(d || ':' || w, i::INT, 1)) % 64] END)), lambda b: b::BIGINT)),
    lambda c, b: xor(c // 256, tab[xor(c % 256, b) + 1]))) AS h FROM kinds, crc),
cut AS (SELECT CASE WHEN h % {DROP_EVERY} = 0 THEN substr(w, 1, (h % len)::INT) || substr(w, (h % len)::INT + 2)
               ELSE w END AS word, k FROM hashed),
words AS (SELECT word, sum(k)::BIGINT AS n FROM cut WHERE length(word) >= {letters} GROUP BY word
          HAVING sum(k) >= {least}),
parts AS (SELECT word, n, length(word) AS len, unnest(range(1, length(word) + 1)) AS p FROM words),
dels AS (SELECT word, n, len, p, substr(word, 1, p::INT - 1) || substr(word, p::INT + 1) AS rest FROM parts),
one AS (SELECT a.word, b.word AS near, b.n AS near_n FROM dels a JOIN dels b
          ON a.rest = b.rest AND a.p = b.p AND a.len = b.len AND a.word <> b.word
        UNION SELECT a.word, b.word, b.n FROM dels a JOIN words b ON a.rest = b.word
        UNION SELECT b.word, a.word, a.n FROM dels a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*)::BIGINT AS n_near, max(near_n) AS most FROM one GROUP BY word),
first AS (SELECT o.word, min(near) AS form FROM one o JOIN best b ON b.word = o.word AND o.near_n = b.most GROUP BY 1),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
                 CASE WHEN most >= {factor} * w.n THEN form END AS form,
                 CASE WHEN most >= {factor} * w.n THEN most END AS form_n
          FROM words w LEFT JOIN best USING (word) LEFT JOIN first USING (word)),
walk AS (SELECT word, word AS at, form AS nxt, 0 AS k FROM forms
  UNION ALL SELECT w.word, f.word, f.form, k + 1 FROM walk w JOIN forms f ON f.word = w.nxt)
SELECT f.word, f.form, r.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN walk r ON r.word = f.word AND r.nxt IS NULL"""
