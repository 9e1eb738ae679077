"""Ranked lexical search with Block-Max MaxScore over document shards.

Terms are runs of digits, letters and all characters beyond ASCII; A-Z are
lowered.  ``build`` indexes every document: shards of bounded size, each with
one row per term that holds the term's postings in compressed blocks, the last
document and the largest impact of each block, and one row with the shard's
document ids.  A posting's impact is (10^9 tf) div (1000 tf + 8 m); a document
scores the sum of weight x impact over the distinct terms of a query.

``search`` takes the queries in blocks of bounded vocabulary.  In each shard the
lists of a query are ordered by their bound (weight x largest impact).  Lists
are read whole, largest bound first, until the bounds of the rest together
cannot reach the k-th best score: these rest lists are non-essential, and a
document met in none of the others is out.  For the documents that remain, the
block maxima of the non-essential lists reject before anything is decompressed;
only blocks that still hold a candidate are decoded.  The k-th score carries
over from shard to shard of a task, and the heaps of the tasks are merged.  No
step leaves out a document that could be among the best k, ties included.

Defined cases: null or empty texts have no term and are never found; a query
without terms has no rows; rows of one item id are one query with the terms of
all of them (null is an id like others); rows with equal document ids are
ranked apart; equal scores go by ascending id, null ids last; an empty table
gives an empty result.  Terms are known by 64-bit hashes.  Other columns of
either table are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railyard.llm.staging import Stage, reach
from railyard.llm.tokens import text_chunks, word_hashes

#: Postings in a block.
BLOCK = 128
#: A shard ends with the document that reaches either bound.
SHARD_DOCS = 8192
SHARD_TERMS = 1 << 21
#: Distinct (query, term) pairs searched at once; larger query sets take several rounds.
ROUND_TERMS = 1 << 18

_TERM = np.zeros(256, bool)
_TERM[48:58] = _TERM[65:91] = _TERM[97:123] = _TERM[128:] = True

INDEX = ("shard bigint, term bigint, df int, top int, last binary, tops binary, widths binary, data binary, "
         "norms binary")


class Index(NamedTuple):
    """Term and shard rows, the documents with a term, their terms."""
    rows: DataFrame
    documents: int
    terms: int
    id_type: str


def term_spans(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of all terms and the number of terms before each text."""
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = _TERM[buf]
    starts = np.flatnonzero((inside[1:-1] == 1) & (inside[:-2] == 0))
    ends = np.flatnonzero((inside[1:-1] == 1) & (inside[2:] == 0)) + 1
    cut = off[1:-1]  # a term never runs from one text into the next
    cut = cut[(cut > 0) & (cut < len(buf))]
    cut = np.unique(cut[(inside[cut] == 1) & (inside[cut + 1] == 1)])
    if len(cut):
        starts, ends = np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))
    return starts, ends, np.searchsorted(starts, off)


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(documents with a term, their terms) of each batch."""
    for b in batches:
        docs = terms = 0
        for _, _, buf, off in text_chunks(b.column(0)):
            k = np.diff(term_spans(buf, off)[2])
            docs, terms = docs + int((k > 0).sum()), terms + int(k.sum())
        yield pa.RecordBatch.from_arrays([pa.array([docs]), pa.array([terms])], ["docs", "terms"])


def norm(n: np.ndarray | int, documents: int, terms: int):
    """m of documents with ``n`` terms."""
    return 100 - 90 + (90 * n * documents) // max(1, terms)


def impact(tf, m):
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _binaries(data: np.ndarray, at: np.ndarray) -> pa.Array:
    """Byte strings data[at[i]:at[i + 1]]."""
    return pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [
        None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data, np.uint8))]).cast(pa.binary())


def _write(out: np.ndarray, at: np.ndarray, value: np.ndarray, width: np.ndarray) -> None:
    """Little-endian ``value`` of ``width`` bytes at ``at``."""
    for k in range(int(width.max(initial=0))):
        has = width > k
        out[at[has] + k] = (value[has] >> (8 * k)) & 255


def _width(v: np.ndarray) -> np.ndarray:
    return np.where(v < 1 << 8, 1, np.where(v < 1 << 16, 2, 4)).astype(np.int64)


def _shard_rows(shard: int, ids: pa.Array, sizes: np.ndarray, hashes: np.ndarray, documents: int, terms: int
                ) -> pa.RecordBatch:
    """Index rows of one shard; ``hashes`` are the terms of its documents, in order.
    Documents are numbered by ascending id, null last."""
    order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    ids, norms = ids.take(pa.array(order)), norm(sizes[order].astype(np.int64), documents, terms)
    bits = max(1, int(len(order) - 1).bit_length())
    names, code = np.unique(hashes, return_inverse=True)
    pairs, tf = np.unique((code.astype(np.int64) << bits) | np.repeat(place, sizes), return_counts=True)
    code, doc = pairs >> bits, pairs & ((1 << bits) - 1)
    q = impact(tf.astype(np.int64), norms[doc])
    first = np.searchsorted(code, np.arange(len(names) + 1))  # postings of each term
    df = np.diff(first)
    within = np.arange(len(code)) - np.repeat(first[:-1], df)
    starts = np.flatnonzero(within % BLOCK == 0)
    n = np.diff(np.append(starts, len(code)))
    block = np.repeat(np.arange(len(starts)), n)
    delta = doc.copy()
    delta[1:] -= doc[:-1]
    delta[starts] = doc[starts]
    wide_doc = _width(np.maximum.reduceat(delta, starts)) if len(starts) else np.zeros(0, np.int64)
    wide_tf = _width(np.maximum.reduceat(tf, starts)) if len(starts) else np.zeros(0, np.int64)
    begin = np.concatenate([[0], np.cumsum(n * (wide_doc + wide_tf))])
    data = np.zeros(begin[-1], np.uint8)
    inner = np.arange(len(code)) - starts[block]
    _write(data, begin[block] + inner * wide_doc[block], delta, wide_doc[block])
    _write(data, begin[block] + n[block] * wide_doc[block] + inner * wide_tf[block], tf, wide_tf[block])
    blocks = np.concatenate([[0], np.cumsum(-(-df // BLOCK))])  # blocks of each term
    tops = (np.maximum.reduceat(q, starts) if len(starts) else np.zeros(0)).astype(np.int32)
    last = doc[starts + n - 1].astype(np.int32)
    top = np.maximum.reduceat(q, first[:-1]).astype(np.int32) if len(names) else np.zeros(0, np.int32)
    count, none = len(names), pa.scalar(None, pa.binary())

    def column(values: np.ndarray, kind) -> pa.Array:
        return pa.concat_arrays([pa.array(values, kind), pa.nulls(1, kind)])

    def bytes_of(x: np.ndarray, at: np.ndarray) -> pa.Array:
        return pa.concat_arrays([_binaries(x, at), pa.nulls(1, pa.binary())])

    rows = [pa.array(np.full(count + 1, shard), pa.int64()), column(names.view(np.int64), pa.int64()),
            pa.concat_arrays([pa.array(df, pa.int32()), pa.array([len(ids)], pa.int32())]), column(top, pa.int32()),
            bytes_of(last.view(np.uint8), 4 * blocks), bytes_of(tops.view(np.uint8), 4 * blocks),
            bytes_of((wide_doc * 16 + wide_tf).astype(np.uint8), blocks), bytes_of(data, begin[blocks]),
            pa.concat_arrays([pa.array([none.as_py()] * count, pa.binary()), pa.array([norms.tobytes()], pa.binary())])]
    held = pa.ListArray.from_arrays(pa.array(np.append(np.zeros(count + 1), len(ids)), pa.int32()), ids)
    return pa.RecordBatch.from_arrays([*rows, held], [*(c.split()[0] for c in INDEX.split(", ")), "ids"])


def _index(documents: int, terms: int):
    """Shards of the documents of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        ids, sizes, hashes, docs, held = [], [], [], 0, 0

        def flush():
            nonlocal ids, sizes, hashes, docs, held, base
            row = _shard_rows(base, pa.concat_arrays(ids), np.concatenate(sizes), np.concatenate(hashes),
                              documents, terms)
            ids, sizes, hashes, docs, held, base = [], [], [], 0, 0, base + 1
            return row

        for b in batches:
            for i, k, buf, off in text_chunks(b.column(1)):
                starts, ends, at = term_spans(buf, off)
                size = np.diff(at)
                with_term = pa.array(np.flatnonzero(size > 0) + i)
                if not len(with_term):
                    continue
                ids.append(b.column(0).take(with_term))
                sizes.append(size[size > 0])
                hashes.append(word_hashes(buf, starts, ends))
                docs, held = docs + len(with_term), held + len(starts)
                if docs >= SHARD_DOCS or held >= SHARD_TERMS:
                    yield flush()
        if docs:
            yield flush()
    return run


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """Index of all documents, staged in the shared folder."""
    st = Stage(docs.sparkSession, "lexical")
    total = (docs.select(text_col).mapInArrow(_term_counts, "docs bigint, terms bigint")
             .agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms")).first())
    n, size = total["docs"] or 0, total["terms"] or 0
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _index(n, size), f"{INDEX}, ids array<{kind}>")
    return Index(st.stage(rows, "shards"), n, size, kind)


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i, k, buf, off in text_chunks(b.column(1)):
            starts, ends, at = term_spans(buf, off)
            row = np.repeat(np.arange(k), np.diff(at)) + i
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row, pa.int64())),
                 pa.array(word_hashes(buf, starts, ends).view(np.int64))], ["item", "term"])


class _Postings:
    """One term of one shard; blocks are decoded when asked for."""
    __slots__ = ("weight", "bound", "df", "last", "tops", "widths", "data", "begin")

    def __init__(self, weight: int, df: int, top: int, last: bytes, tops: bytes, widths: bytes, data: bytes):
        self.weight, self.bound, self.df, self.data = weight, weight * top, df, data
        self.last, self.tops = np.frombuffer(last, np.int32), np.frombuffer(tops, np.int32)
        self.widths = np.frombuffer(widths, np.uint8)
        wide = (self.widths >> 4).astype(np.int64) + (self.widths & 15)
        self.begin = np.concatenate([[0], np.cumsum(wide * BLOCK)])

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and their counts."""
        n = min(BLOCK, self.df - b * BLOCK)
        wide, wide_tf = int(self.widths[b] >> 4), int(self.widths[b] & 15)
        doc = np.frombuffer(self.data, f"<u{wide}", n, int(self.begin[b]))
        tf = np.frombuffer(self.data, f"<u{wide_tf}", n, int(self.begin[b]) + n * wide)
        return np.cumsum(doc, dtype=np.int64), tf.astype(np.int64)

    def blocks(self, which) -> tuple[np.ndarray, np.ndarray]:
        parts = [self.block(b) for b in which]
        return (parts[0] if len(parts) == 1 else
                (np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])))


def top_of_shard(lists: list[_Postings], norms: np.ndarray, k: int, floor: int, work: list | None = None
                 ) -> tuple[np.ndarray, np.ndarray]:
    """Documents of one shard that may be among the best ``k`` of a query, with
    their scores; ``floor``: the k-th best score so far (0: none).  ``work``
    gets the number of blocks decoded and of blocks there are."""
    lists = sorted((p for p in lists if p.bound > 0), key=lambda p: -p.bound)
    rest = np.append(np.cumsum([p.bound for p in lists][::-1])[::-1], 0) if lists else np.zeros(1, np.int64)
    scores = np.zeros(len(norms), np.int64)
    decoded, met = 0, 0
    for cut, p in enumerate(lists):
        if met >= k and (cut % 4 == 0 or rest[cut] < 2 * floor):
            floor = max(floor, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
        if rest[cut] < floor:  # this list and those after it are non-essential
            break
        doc, tf = p.blocks(range(len(p.last)))
        scores[doc] += p.weight * impact(tf, norms[doc])
        decoded, met = decoded + len(p.last), met + len(doc)
    else:
        cut = len(lists)
    found = np.flatnonzero(scores)
    got = scores[found]
    if cut < len(lists):
        if len(found) > k:
            floor = max(floor, int(np.partition(got, len(got) - k)[len(got) - k]))
        keep = got + rest[cut] >= floor
        found, got = found[keep], got[keep]
        at = [np.searchsorted(p.last, found) for p in lists[cut:]]
        tops = np.stack([np.append(p.tops.astype(np.int64), 0)[a] * p.weight for p, a in zip(lists[cut:], at)])
        keep = got + tops.sum(0) >= floor
        found, got, tops, at = found[keep], got[keep], tops[:, keep], [a[keep] for a in at]
        left = tops.sum(0)
        for j, p in enumerate(lists[cut:]):
            which = np.unique(at[j])
            which = which[which < len(p.last)]
            left = left - tops[j]
            if len(which):
                doc, tf = p.blocks(which)
                decoded += len(which)
                i = np.minimum(np.searchsorted(doc, found), len(doc) - 1)
                got = got + np.where(doc[i] == found, p.weight * impact(tf[i], norms[found]), 0)
            keep = got + left >= floor
            if not keep.all():
                found, got, left, tops = found[keep], got[keep], left[keep], tops[:, keep]
                at = [a[keep] for a in at]
    if len(found) > k:  # the k-th best and all that tie with it; ids decide among these, documents are in order of id
        best = np.argsort(-got, kind="stable")[:k]
        found, got = found[best], got[best]
    if work is not None:
        work.append((decoded, sum(len(p.last) for p in lists)))
    return found, got


def _search(items: list, weights: dict[int, int], k: int):
    """Best ``k`` documents of a task for each item (its number and its terms)."""
    wanted = set(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: list[list] = [[] for _ in items]
        kind = None

        def answer(rows: dict, docs: tuple) -> None:
            ids, norms = docs
            lists = {t: _Postings(weights[t], *r) for t, r in rows.items()}
            for i, terms in enumerate(items):
                mine = [lists[t] for t in terms if t in lists]
                if not mine:
                    continue
                heap = heaps[i]
                doc, score = top_of_shard(mine, norms, k, heap[-1][0] if len(heap) == k else 0)
                if len(doc):
                    got = ids.take(pa.array(doc)).to_pylist()
                    heap += zip(score.tolist(), got)
                    heap.sort(key=lambda x: (-x[0], x[1] is None, 0 if x[1] is None else x[1]))
                    del heap[k:]

        shard, rows, docs = None, {}, None
        for b in batches:
            kind = b.schema.field("ids").type.value_type
            col = {c: b.column(c) for c in b.schema.names}
            shards, terms = col["shard"].to_numpy(), col["term"].to_pylist()
            for i in range(b.num_rows):
                if shards[i] != shard:
                    if docs:
                        answer(rows, docs)
                    shard, rows, docs = shards[i], {}, None
                if terms[i] is None:
                    docs = (col["ids"][i].values, np.frombuffer(col["norms"][i].as_py(), np.int64))
                elif terms[i] in wanted:
                    rows[terms[i]] = tuple(col[c][i].as_py() for c in ("df", "top", "last", "tops", "widths", "data"))
        if docs:
            answer(rows, docs)
        out = [(i, d, s) for i, heap in enumerate(heaps) for s, d in heap]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()),
                                              pa.array([x[1] for x in out], kind),
                                              pa.array([x[2] for x in out], pa.int64())], ["item", "doc", "score"])
    return run


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def search(index: Index, queries: DataFrame, k: int = 10, item_col: str = "item_id", text_col: str = "text",
           id_name: str = "doc_id") -> DataFrame:
    """(item_col, rank, id_name, score): the ``k`` best documents of each item."""
    spark = reach(queries.sparkSession)
    st = Stage(spark, "search")
    kind = queries.schema[item_col].dataType.simpleString()
    asked = st.stage(queries.select(F.col(item_col).alias("item"), text_col)
                     .mapInArrow(_query_terms, f"item {kind}, term bigint").distinct(), "terms")
    rounds = max(1, -(-asked.count() // ROUND_TERMS))
    turn = F.pmod(F.xxhash64("item"), F.lit(rounds))
    found = []
    for r in range(rounds):
        now = asked.where(turn == r)
        terms: dict = {}
        for item, term in now.collect():  # ROUND_TERMS rows on average; an item's terms stay together
            terms.setdefault(item, []).append(term)
        if not terms:
            continue
        vocabulary = now.select("term").distinct()
        dfs = (index.rows.select("term", "df").join(vocabulary, "term", "left_semi")
               .groupBy("term").agg(F.sum("df").alias("df")).collect())
        weights = {t: weight(index.documents, df) for t, df in dfs}
        rows = (index.rows.where("term IS NOT NULL").join(vocabulary, "term", "left_semi").select(*index.rows.columns)
                .unionByName(index.rows.where("term IS NULL"))
                .repartition("shard").sortWithinPartitions("shard"))
        best = rows.mapInArrow(_search([terms[i] for i in terms], weights, k),
                               f"item int, doc {index.id_type}, score bigint")
        numbers = spark.createDataFrame(list(enumerate(terms)), f"item int, item_name {kind}")
        found.append(_merge(st.stage(best, f"heaps{r}"), k).join(numbers, "item")
                     .select(F.col("item_name").alias(item_col), "rank", F.col("doc").alias(id_name), "score"))
    if not found:
        return spark.createDataFrame([], f"{item_col} {kind}, rank int, {id_name} {index.id_type}, score bigint")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _merge(heaps: DataFrame, k: int) -> DataFrame:
    """The tasks' heaps to one per item: first within 64 parts of an item, then over the parts."""
    order = [F.desc("score"), F.asc_nulls_last("doc")]
    part = F.pmod(F.xxhash64("doc"), F.lit(64))
    some = (heaps.withColumn("part", part)
            .withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order)))
            .where(F.col("rank") <= k))
    return (some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
            .where(F.col("rank") <= k).select("item", "rank", "doc", "score"))


def oracle_sql(k: int = 10) -> str:
    terms = (r"unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS run")
    low = "translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
runs AS (SELECT r, {terms} FROM rows),
tfs AS (SELECT r, {low} AS term, count(*)::BIGINT AS tf FROM runs GROUP BY ALL),
sizes AS (SELECT r, sum(tf)::BIGINT AS n FROM tfs GROUP BY r),
total AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes),
asked AS (SELECT DISTINCT item_id, {low} AS term FROM (SELECT item_id, {terms} FROM benchmark)),
dfs AS (SELECT term, count(*)::BIGINT AS df FROM tfs GROUP BY term),
weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM dfs, total),
scored AS (
  SELECT a.item_id, t.r,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked a JOIN tfs t USING (term) JOIN weights USING (term) JOIN sizes s ON s.r = t.r, total
  GROUP BY a.item_id, t.r),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, r)::INT AS rank, doc_id, score
  FROM scored JOIN rows USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {k}"""
