"""N-gram Jaccard join by universe partitioning and the pigeonhole principle.

Each text becomes its set of distinct ``n``-word shingles.  Sizes are cut into
overlapping bands so that every pair that can reach the threshold shares a
band.  Within a band two such sets differ in at most ``H`` shingles.  The hash
universe of the shingles is cut into ``m`` segments; a set enters each band of
its size with one signature per segment (the sum of the remixed shingles of
that segment) and, in bands whose plan says so, also with the signatures of
its one-deletion neighbourhoods.  A segment may count 0 (left out by this
set), 1 (an equal segment is found) or 2 (segments that differ in one shingle
are found as well); as long as the counts of a pair add up to more than ``H``,
a linked pair must share a signature.  The plan of a band is the cheapest
(segments, deletions, segments left out) that satisfies this; each set leaves
out its least selective segments.

Sets that share a signature are candidates.  Before any pair is made, sets
that cannot have a link go: a shingle that no other candidate set holds is in
no intersection, so a set shares at most its other shingles with any partner.  Then the sets of a signature are
compared with the signature's most central set (star), linked sets are joined
to components, and the pairs that still connect different components and can
reach the threshold are all verified.  Verification intersects the exact
shingle sets of both texts.  No candidate, partner or bucket is capped.

The nodes of the join are classes of equal shingle sets (64-bit key of the
set), so copies cost one row per map task and never form pairs.

Defined cases: null or word-less text has no shingles, ``n_shingles`` 0, and
is its own component; rows with equal sets link; repeated ids are one node per
row; a null id yields the smallest non-null id of its component, or null.
Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.llm.staging import Stage
from railyard.llm.tokens import U64, mix64, set_keys, text_chunks, text_shingles

#: Rows that one badly selective segment may cost, in the choice of a plan.
_SPURIOUS = 40.0
#: Signatures of a set that are remembered to make each of its pairs once.
_LISTED = 24


class Bands:
    """Size bands and their plans for the threshold ``num / den``."""

    def __init__(self, num: int, den: int, largest: int, width: float = 0.5):
        self.num, self.den = num, den
        lo, self.lo, self.hi, plans = 1, [], [], []
        while lo <= max(1, largest):
            hi = max(lo, math.floor(lo * math.exp(width)))
            self.lo.append(lo)
            self.hi.append(hi)
            plans.append(self.plan(lo, hi))
            # every partner of a set above hi has at least this size
            lo = max(lo + 1, -(-(hi + 1) * num // den))
        self.lo, self.hi = np.array(self.lo), np.array(self.hi)
        self.m, self.deletions, self.skips = (np.array(x) for x in zip(*plans))

    def difference(self, total):
        """Largest symmetric difference of linked sets of ``total`` members."""
        return total * (self.den - self.num) // (self.den + self.num)

    def plan(self, lo: int, hi: int) -> tuple[int, int, int]:
        """(segments, 1 if deletions are indexed, segments left out)."""
        h = self.difference(2 * hi)
        if h == 0:
            return 0, 0, 0  # only equal sets link, and those are one class
        best = None
        for deletions in (0, 1):
            for skips in range(0, 4 + h // 8):
                # counts: m - 2 skips > h, or 2 m - 4 skips > h
                m = h + 1 + 2 * skips if not deletions else (h + 2) // 2 + 2 * skips
                lam = lo / m
                # segments that say nothing: empty, or empty after one deletion
                poor = m * math.exp(-lam) * (1 + lam if deletions else 1)
                rows = m - skips + deletions * hi
                cost = rows + _SPURIOUS * max(0.0, poor - skips)
                if best is None or cost < best[0]:
                    best = cost, m, deletions, skips
        return best[1:]

    def entries(self, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(set, band) for each band that holds the set's size."""
        first = np.searchsorted(self.hi, sizes, side="left")
        past = np.searchsorted(self.lo, sizes, side="right")
        k = np.where(sizes > 0, past - first, 0)
        which = np.repeat(np.arange(len(sizes)), k)
        band = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k) + first[which]
        keep = self.m[band] > 0
        return which[keep], band[keep]


def signatures(h: np.ndarray, at: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """(signature, set) rows of some sets given as ascending hashes."""
    sizes = np.diff(at)
    which, band = bands.entries(sizes)
    if not len(which):
        return np.zeros(0, U64), np.zeros(0, np.int64)
    m, n = bands.m[band], sizes[which]
    base = np.concatenate([[0], np.cumsum(m)])
    start = np.concatenate([[0], np.cumsum(n)])
    entry = np.repeat(np.arange(len(which)), n)
    x = h[np.arange(start[-1]) - start[entry] + at[which][entry]]
    segment = base[entry] + (((x >> U64(32)) * m[entry].astype(U64)) >> U64(32)).astype(np.int64)
    count = np.bincount(segment, minlength=base[-1])
    ends = np.cumsum(count)
    y = mix64(x)
    total = np.concatenate([np.zeros(1, U64), np.cumsum(y, dtype=U64)])
    owner = np.repeat(np.arange(len(which)), m)
    salt = mix64((band[owner].astype(U64) << U64(32)) + (np.arange(base[-1]) - base[owner]).astype(U64) + U64(1))
    full = total[ends] - total[ends - count] + salt
    # each entry leaves out its segments of fewest members
    order = np.argsort(owner * (1 << 22) + np.minimum(count, (1 << 22) - 1), kind="stable")
    used = np.ones(base[-1], bool)
    used[order[np.arange(base[-1]) - base[owner] < bands.skips[band][owner]]] = False
    out, of = [mix64(full[used])], [which[owner[used]]]
    near = bands.deletions[band][entry].astype(bool)
    near[near] = used[segment[near]]
    if near.any():
        out.append(mix64(full[segment[near]] - y[near]))
        of.append(which[entry[near]])
    return np.concatenate(out), np.concatenate(of)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _describe(n: int):
    """(id, size, class, first copy in this task) of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, k, buf, off in text_chunks(b.column(1)):
                h, at = text_shingles(buf, off, n)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, k), pa.array(np.diff(at)), _signed(set_keys(h, at))],
                    ["id", "n_shingles", "cls"])
    return run


def _first_copies(key: np.ndarray, seen: set) -> np.ndarray:
    fresh = np.zeros(len(key), bool)
    for i, x in enumerate(key.tolist()):
        if x and x not in seen:
            seen.add(x)
            fresh[i] = True
    return fresh


def _sign(n: int, bands: Bands):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for b in batches:
            for _, _, buf, off in text_chunks(b.column(0)):
                h, at = text_shingles(buf, off, n)
                key = set_keys(h, at)
                new = _first_copies(key, seen)
                size = np.where(new, np.diff(at), 0)
                h = h[np.repeat(new, np.diff(at))]
                sig, of = signatures(h, np.concatenate([[0], np.cumsum(size)]), bands)
                yield pa.RecordBatch.from_arrays([_signed(sig), _signed(key[of])], ["sig", "cls"])
    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in order of (sig, cls): those whose signature two classes share."""
    sig0, cls0, told = np.zeros(0, np.int64), np.zeros(0, np.int64), True
    for b in batches:
        sig = np.concatenate([sig0, b.column(0).to_numpy()])
        cls = np.concatenate([cls0, b.column(1).to_numpy()])
        if len(sig) == 0:
            continue
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (cls[1:] != cls[:-1])
        sig, cls = sig[new], cls[new]
        same = sig[1:] == sig[:-1]
        keep = np.zeros(len(sig), bool)
        keep[1:] |= same
        keep[:-1] |= same
        last_kept = keep[-1] or (len(sig) == 1 and len(sig0) == 1 and told)
        if len(sig0) and told:
            keep[0] = False  # went out with the batch before
        sig0, cls0, told = sig[-1:], cls[-1:], bool(last_kept)
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(sig[keep]), pa.array(cls[keep])], ["sig", "cls"])


def _texts(n: int):
    """(class, size, text) of the first copy of each class in a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for b in batches:
            for i, k, buf, off in text_chunks(b.column(0)):
                h, at = text_shingles(buf, off, n)
                key = set_keys(h, at)
                new = np.flatnonzero(_first_copies(key, seen))
                yield pa.RecordBatch.from_arrays(
                    [_signed(key[new]), pa.array(np.diff(at)[new]),
                     b.column(0).slice(i, k).take(pa.array(new)).cast(pa.string())], ["cls", "size", "text"])
    return run


def _members(n: int):
    """(shingle, class) rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cls = b.column(0).to_numpy()
            for i, k, buf, off in text_chunks(b.column(1)):
                h, at = text_shingles(buf, off, n)
                yield pa.RecordBatch.from_arrays(
                    [_signed(h), pa.array(np.repeat(cls[i:i + k], np.diff(at)))], ["h", "cls"])
    return run


def _sets_of(column: pa.Array, n: int) -> list[np.ndarray]:
    out = []
    for _, k, buf, off in text_chunks(column):
        h, at = text_shingles(buf, off, n)
        out += [h[at[j]:at[j + 1]] for j in range(k)]
    return out


def _verify(n: int, num: int, den: int):
    """Linked pairs (a, b) of rows (a, b, text_a, text_b)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a = b.column(0).to_numpy()
            if not len(a):
                continue
            head = np.concatenate([[True], a[1:] != a[:-1]])  # rows of a pivot come together
            left = _sets_of(b.column(2).filter(pa.array(head)), n)
            right = _sets_of(b.column(3), n)
            of = np.cumsum(head) - 1
            ok = np.zeros(len(a), bool)
            for i, y in enumerate(right):
                x = left[of[i]]
                if len(x) and len(y):
                    at = np.searchsorted(x, y)
                    at[at == len(x)] = 0
                    both = int(np.count_nonzero(x[at] == y))
                    ok[i] = den * both >= num * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(ok))
    return run


def components(links: DataFrame, st: Stage) -> DataFrame:
    """(node, comp): the smallest node reachable, for the ends of ``links``
    (a, b).  Each round takes the smallest label of the neighbours and then
    the label of that label, so paths shorten as they grow."""
    edges = st.stage(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    labels = st.stage(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("comp")),
                      "labels")
    while True:
        near = (edges.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("comp").alias("near")))
        low = (labels.join(near, F.col("node") == F.col("a"))
               .select("node", F.col("comp").alias("was"), F.least("comp", "near").alias("comp")))
        step = st.stage(low, "low")
        jump = step.select(F.col("node").alias("via"), F.col("comp").alias("far"))
        new = st.stage(step.join(jump, F.col("comp") == F.col("via"))
                       .select("node", "was", F.least("comp", "far").alias("comp")), "labels")
        changed = new.where("comp <> was").limit(1).count()
        st.discard(step, labels)
        labels = new
        if not changed:
            st.discard(edges)
            return labels.select("node", "comp")


def link_documents(docs: DataFrame, n: int = 5, num: int = 4, den: int = 5,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, n_shingles, component_id, class_key): components of the
    links with Jaccard similarity ``num / den`` or more of ``n``-word shingle
    sets.  One output row per input row."""
    spark = docs.sparkSession
    st = Stage(spark, "ngram-join")
    texts_in = docs.select(F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = st.stage(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
                    .mapInArrow(_describe(n), f"id {kind}, n_shingles bigint, cls bigint"), "rows")
    bands = Bands(num, den, rows.agg(F.max("n_shingles")).first()[0] or 1)

    def shared(pairs: DataFrame) -> DataFrame:
        return (pairs.select("sig", "cls").repartition(F.col("sig")).sortWithinPartitions("sig", "cls")
                .mapInArrow(_shared, "sig bigint, cls bigint"))

    found = st.stage(shared(texts_in.mapInArrow(_sign(n, bands), "sig bigint, cls bigint")), "found")
    st.settle()
    wanted = found.select("cls").distinct()
    texts = st.stage(texts_in.mapInArrow(_texts(n), "cls bigint, size bigint, text string")
                     .join(wanted, "cls", "left_semi").dropDuplicates(["cls"]), "texts")
    st.settle()
    # shingles that no other candidate holds
    alone = (texts.select("cls", "text").mapInArrow(_members(n), "h bigint, cls bigint")
             .groupBy("h").agg(F.count(F.lit(1)).alias("k"), F.min("cls").alias("cls"))
             .where("k = 1").groupBy("cls").agg(F.count(F.lit(1)).alias("own")))
    open_ = st.stage(texts.select("cls", "size").join(alone, "cls", "left")
                     .withColumn("own", F.coalesce("own", F.lit(0))).where(F.col("own") * den <= F.col("size") * (den - num)), "open")
    left = st.stage(shared(found.join(open_.select("cls"), "cls", "left_semi"))
                    .join(open_, "cls"), "left")
    st.discard(found)

    def can(x: str, y: str):
        """What both share fits into the shingles that are not theirs alone."""
        shared_most = F.least(F.col(f"{x}.size") - F.col(f"{x}.own"), F.col(f"{y}.size") - F.col(f"{y}.own"))
        total = F.col(f"{x}.size") + F.col(f"{y}.size")
        return ((shared_most * (den + num) >= total * num)
                & (F.least(f"{x}.size", f"{y}.size") * den >= F.greatest(f"{x}.size", f"{y}.size") * num))

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        t = texts.select("cls", "text")
        both = (pairs.join(t.select(F.col("cls").alias("b"), F.col("text").alias("tb")), "b")
                .join(t.select(F.col("cls").alias("a"), F.col("text").alias("ta")), "a")
                .sortWithinPartitions("a").select("a", "b", "ta", "tb"))
        return st.stage(both.mapInArrow(_verify(n, num, den), "a bigint, b bigint"), name)

    # star: the most central set of each signature against the others
    centre = left.groupBy("sig").agg(F.min(F.struct("own", "cls", "size")).alias("c"))
    centre = centre.select("sig", F.col("c.cls").alias("cls"), F.col("c.own").alias("own"),
                           F.col("c.size").alias("size"))
    star = (left.alias("y").join(centre.alias("x"), "sig").where(F.col("x.cls") != F.col("y.cls"))
            .where(can("x", "y")).select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b")).distinct())
    star = st.stage(star, "star")
    links = verified(star, "links")
    comp = components(links, st)
    # what still connects different components
    labelled = (left.join(comp, F.col("cls") == F.col("node"), "left")
                .select("sig", "cls", "size", "own", F.coalesce("comp", "cls").alias("comp")))
    # rows of one component hold nothing against each other: a shingle that only one component holds
    # is in no intersection that still matters
    def still_mixed(rows: DataFrame) -> DataFrame:
        mixed = rows.groupBy("sig").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 < c1")
        return rows.join(mixed.select("sig"), "sig", "left_semi")

    rest = st.stage(still_mixed(labelled), "rest")
    nodes = rest.select("cls", "comp", "size").distinct()
    held = st.stage(texts.join(nodes.select("cls"), "cls", "left_semi").select("cls", "text")
                    .mapInArrow(_members(n), "h bigint, cls bigint").join(nodes.select("cls", "comp"), "cls"), "held")
    inner = held.groupBy("h").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 = c1")
    apart = held.join(inner.select("h"), "h", "left_semi").groupBy("cls").agg(F.count(F.lit(1)).alias("own"))
    now = (nodes.join(apart, "cls", "left").withColumn("own", F.coalesce("own", F.lit(0)))
           .where(F.col("own") * den <= F.col("size") * (den - num)).select("cls", "own"))
    last = st.stage(still_mixed(rest.drop("own").join(now, "cls")), "last")
    # a pair is made at the first of its signatures; one that is found earlier in both lists is left to that place
    lists = last.groupBy("cls").agg(F.slice(F.sort_array(F.collect_list("sig")), 1, _LISTED).alias("early"))
    last = st.stage(last.join(lists, "cls").withColumn("early", F.expr("filter(early, v -> v < sig)")), "listed")
    pairs = (last.alias("x").join(last.alias("y"), "sig")
             .where((F.col("x.cls") < F.col("y.cls")) & (F.col("x.comp") != F.col("y.comp")) & can("x", "y")
                    & ~F.arrays_overlap("x.early", "y.early"))
             .select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b")).distinct())
    more = verified(pairs.join(star, ["a", "b"], "left_anti"), "more")
    if more.limit(1).count():
        comp = components(links.unionByName(more), st)
    st.discard(texts, left, rest, star, open_, held, last)
    # from classes back to rows
    named = rows.join(comp, F.col("cls") == F.col("node"), "left").withColumn("comp", F.coalesce("comp", "cls"))
    first = named.where("cls <> 0").groupBy("comp").agg(F.min("id").alias("component_id"))
    return (named.join(first, "comp", "left")
            .select(F.col("id").alias(id_col), "n_shingles",
                    F.when(F.col("cls") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
                    F.col("cls").alias("class_key")))


def oracle_sql(n: int, num: int, den: int) -> str:
    """All pairs that share a shingle, their links and components, for DuckDB."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
                            '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, w[i:i + {n - 1}] AS gram FROM (
    SELECT doc_id, w, unnest(range(1, greatest(len(w) - {n - 2}, 2))) AS i FROM d WHERE len(w) > 0)),
z AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_ FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id <> b.doc_id
      GROUP BY ALL),
l AS MATERIALIZED (SELECT x, y FROM p JOIN z zx ON zx.doc_id = x JOIN z zy ON zy.doc_id = y
      WHERE {den} * both_ >= {num} * (zx.size + zy.size - both_)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.y FROM r JOIN l ON r.b = l.x)
SELECT documents.doc_id, coalesce(z.size, 0)::BIGINT AS n_shingles, c.component_id
FROM documents LEFT JOIN z USING (doc_id) JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) c ON c.a = documents.doc_id"""
