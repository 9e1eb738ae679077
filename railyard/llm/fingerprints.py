"""Document fingerprints: improbable-feature digests.

Every window of ``WINDOW`` bytes of a text has an entropy class.  The classes
are ranked by how rare they are over all windows of the corpus (classes of
almost constant or fully mixed windows rank last).  A window is a feature when
it is the rarest in at least ``POPULAR`` of the ``WINDOW`` consecutive
neighbourhoods that hold it.  Features, hashed to five positions each, go into
a chain of Bloom filters of ``BITS`` bits; a filter takes ``PER_FILTER``
features before the next one opens.  Two digests are compared filter by
filter: the overlap of set bits above what chance gives, over the most that is
possible, best match per filter, averaged over the shorter chain.

Window entropies need no loop over bytes: counts of equal bytes at each
distance inside the window give the change of the entropy sum from one window
to the next, and its running sum the entropy itself, in integers.

``neighbours`` pairs each document with the next one in descending id.  Spark
deals the documents by ranges of (id, hash of the text, place in the input) and
sorts each range, so a text moves once and rows of one id, or of none, spread
over ranges like others.  The last document of a range is finished afterwards:
the ends of the ranges, two rows each, meet in a join.

Defined cases: null text is empty; an empty text has the empty digest, which
is 1.0 like another empty one and 0.0 like any other; a text of fewer bytes
than a window is one feature; equal texts have equal digests; equal ids are
ordered by a hash of the text, equal rows by their place; null ids come last; a table of one row is its
own next document.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.llm.staging import Stage, reach

WINDOW = 64
POPULAR = 16
BITS = 1024
PER_FILTER = 80
CLASSES = 256
#: Bytes of text handled at once; a window never crosses texts.
BLOCK_BYTES = 1 << 17

_F = np.zeros(WINDOW + 2, np.int64)
_F[1:] = np.round(np.arange(1, WINDOW + 2) * np.log2(np.arange(1, WINDOW + 2)) * 65536).astype(np.int64)
_STEP = np.diff(_F)  # growth of the sum when a byte's count goes up by one
_MOST = int(_F[WINDOW])


def entropy_classes(x: np.ndarray) -> np.ndarray:
    """Entropy class (0 .. CLASSES - 1) of each window of the bytes ``x``."""
    n, w = len(x), WINDOW
    if n < w:
        return np.zeros(0, np.uint16)
    back = np.zeros(n, np.uint8)   # equal bytes among the w - 1 before
    ahead = np.zeros(n, np.uint8)  # equal bytes among the w - 1 after
    for d in range(1, w):
        same = x[d:] == x[:-d]
        back[d:] += same.view(np.uint8)
        ahead[:-d] += same.view(np.uint8)
    total = np.empty(n - w + 1, np.int64)
    counts = np.bincount(x[:w], minlength=256)
    total[0] = _F[counts].sum()
    if n > w:
        # the window drops x[i] (its count there: 1 + ahead) and takes x[i + w]
        gone, new = ahead[:n - w].astype(np.int64), back[w:].astype(np.int64)
        total[1:] = total[0] + np.cumsum(_STEP[new] - _STEP[gone])
    # entropy = log2 w - total / w; as a share of the largest
    return ((_MOST - total) * (CLASSES - 1) // _MOST).astype(np.uint16)


def class_counts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    out = np.zeros(CLASSES, np.int64)
    for s, e in zip(off[:-1], off[1:]):
        for at in range(s, e, BLOCK_BYTES):
            out += np.bincount(entropy_classes(data[at:min(e, at + BLOCK_BYTES + WINDOW - 1)]), minlength=CLASSES)
    return out


def ranks(counts: np.ndarray) -> np.ndarray:
    """Rank of each entropy class: rarest first; classes without information
    (the lowest eighth and what no window has) last."""
    order = sorted(range(CLASSES), key=lambda c: (c < CLASSES // 8 or counts[c] == 0, counts[c], c))
    out = np.zeros(CLASSES, np.int64)
    out[order] = np.arange(CLASSES)
    return out


def features(x: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Start positions of the selected windows of a text."""
    r = rank[entropy_classes(x)]
    n = len(r)
    if n == 0:
        return np.zeros(0, np.int64)
    key = (r << np.int64(40)) | np.arange(n)  # the first of equals wins
    low, have = key, 1
    while have < min(WINDOW, n):  # minimum over ``have`` consecutive windows, doubled up
        step = min(have, min(WINDOW, n) - have)
        low = np.minimum(low[:len(low) - step], low[step:])
        have += step
    at, votes = np.unique(low & np.int64((1 << 40) - 1), return_counts=True)
    dull = r[at] >= rank_limit(rank)
    return at[(votes >= min(POPULAR, len(low))) & ~dull]


def rank_limit(rank: np.ndarray) -> int:
    return CLASSES - CLASSES // 8


def window_hashes(raw: bytes, rank: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Start positions of the features of a text and their hashes."""
    x, places, hashes = np.frombuffer(raw, np.uint8), [], []
    for at in range(0, max(1, len(x) - WINDOW + 1), BLOCK_BYTES):
        found = features(x[at:at + BLOCK_BYTES + WINDOW - 1], rank) + at
        places.append(found)
        hashes += [hashlib.sha1(raw[p:p + WINDOW]).digest() for p in found.tolist()]
    return np.concatenate(places), hashes


def changed_hashes(raw: bytes, same: int, before: tuple[np.ndarray, list[bytes]], rank: np.ndarray
                   ) -> tuple[np.ndarray, list[bytes]]:
    """``window_hashes`` of ``raw``, whose first ``same`` bytes it shares with a
    text that has ``before``: a window is chosen by the windows less than
    ``WINDOW`` before and after it, so only those near the change are looked at."""
    if len(raw) > BLOCK_BYTES or same < 4 * WINDOW or len(raw) - same < WINDOW:
        return window_hashes(raw, rank)
    first = same - 2 * WINDOW + 2  # the first window that a changed byte can sway
    begin = first - WINDOW + 1
    kept = int(np.searchsorted(before[0], first))
    found = features(np.frombuffer(raw, np.uint8)[begin:], rank) + begin
    found = found[found >= first]
    return (np.concatenate([before[0][:kept], found]),
            before[1][:kept] + [hashlib.sha1(raw[p:p + WINDOW]).digest() for p in found.tolist()])


def filters(raw: bytes, hashes: list[bytes]) -> np.ndarray:
    """Chain of filters of a text with these features, one row of bytes each."""
    if not raw:
        return np.zeros((0, BITS // 8), np.uint8)
    # a text of nothing but dull windows is one feature
    found = dict.fromkeys(hashes) if len(raw) >= WINDOW and hashes else {hashlib.sha1(raw).digest(): None}
    hashes = np.frombuffer(b"".join(found), ">u4").reshape(-1, 5)
    places = (hashes % BITS).astype(np.int64)
    chain = np.arange(len(places)) // PER_FILTER
    bits = np.zeros((chain[-1] + 1, BITS), np.uint8)
    bits[np.repeat(chain, 5), places.ravel()] = 1
    return np.packbits(bits, axis=1)


def digest(raw: bytes, rank: np.ndarray) -> np.ndarray:
    """Chain of filters; no row for an empty text."""
    return filters(raw, window_hashes(raw, rank)[1] if len(raw) >= WINDOW else [])


_POP = np.array([bin(i).count("1") for i in range(256)], np.int64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1; symmetric."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if a.shape == b.shape and (a == b).all():
        return 1.0
    na, nb = _POP[a].sum(1), _POP[b].sum(1)
    if (len(b), int(nb.sum()), b.tobytes()) < (len(a), int(na.sum()), a.tobytes()):
        a, b, na, nb = b, a, nb, na
    total = 0.0
    for row, k in zip(a, na):
        both = _POP[row & b].sum(1)
        least = np.minimum(k, nb)
        chance = k * nb / BITS
        score = (both - chance) / np.maximum(least - chance, 1e-9)
        total += float(np.clip(score, 0, 1).max())
    return total / len(a)


def text_of(chain: np.ndarray) -> str:
    return base64.b64encode(chain.tobytes()).decode()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(CLASSES, np.int64)
    for b in batches:
        for t in b.column(0):
            raw = t.as_buffer()
            if raw is not None and raw.size:
                x = np.frombuffer(raw, np.uint8)
                total += class_counts(x, np.array([0, len(x)]))
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), pa.array(total)], ["cls", "n"])


def corpus_ranks(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Rank table from the entropy classes of all windows of all texts."""
    reach(docs.sparkSession)
    rows = (docs.select(F.coalesce(text_col, F.lit("")).alias("t")).mapInArrow(_count, "cls bigint, n bigint")
            .groupBy("cls").agg(F.sum("n").alias("n")).collect())  # CLASSES rows
    counts = np.zeros(CLASSES, np.int64)
    for r in rows:
        counts[r["cls"]] = r["n"]
    return ranks(counts)


def fingerprint(docs: DataFrame, rank: np.ndarray, text_col: str = "text") -> DataFrame:
    """``docs`` with the text replaced by ``fingerprint``."""
    reach(docs.sparkSession)
    rest = [c for c in docs.columns if c != text_col]
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*rest).schema)

    def run(batches):
        for b in batches:
            out = [text_of(digest((t.as_py() or "").encode(), rank)) for t in b.column(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(out, pa.string())],
                                             [*b.schema.names[:-1], "fingerprint"])

    return docs.select(*rest, text_col).mapInArrow(run, ", ".join(filter(None, [kept, "fingerprint string"])))


class _Doc:
    """A text with its features and digest."""
    __slots__ = ("id", "text", "raw", "seen", "own")

    def __init__(self, i, text: str, rank: np.ndarray):
        self.id, self.text, self.raw = i, text, text.encode()
        long = len(self.raw) >= WINDOW
        self.seen = window_hashes(self.raw, rank) if long else (np.zeros(0, np.int64), [])
        self.own = filters(self.raw, self.seen[1])


def _row(doc: _Doc, nxt: _Doc, rank: np.ndarray) -> tuple:
    """Result of a document, given the next one."""
    i, text, own, other_own = doc.id, doc.text, doc.own, nxt.own
    k = len(text)
    cut = k // 3
    same = text[:k - cut].encode()
    edited = same + nxt.text[:cut].encode()
    if len(doc.raw) <= BLOCK_BYTES and len(edited) >= WINDOW:
        other = filters(edited, changed_hashes(edited, len(same), doc.seen, rank)[1])
    else:
        other = digest(edited, rank)
    return (i, k, hashlib.sha256(edited).hexdigest(), text_of(own), text_of(other), likeness(own, other),
            likeness(own, other_own))


RESULT = "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, " \
         "near_next double"
_NAMES = ["id", *(c.split()[0] for c in RESULT.split(", "))]


def _batch(rows: list[tuple], kind: pa.DataType, more: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    kinds = [kind, pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2, *(k for _, k in more)]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                      [*_NAMES, *(n for n, _ in more)])


def _compare(rank: np.ndarray):
    """Results of a sorted range.  Its first row also carries its text (head);
    its last one waits with its text for the next range (open)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        more = [("part", pa.int32()), ("open", pa.bool_()), ("own", pa.string()), ("head", pa.string())]
        part, last, head, kind = TaskContext.get().partitionId(), None, None, pa.null()
        for b in batches:
            kind, out = b.schema.field(0).type, []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                doc = _Doc(i, text, rank)
                if last is not None:
                    out.append((*_row(last, doc, rank), part, False, None, head))
                    head = None
                else:
                    head = text
                last = doc
            if out:
                yield _batch(out, kind, more)
        if last is not None:
            yield _batch([(last.id, *[None] * 6, part, True, last.text, head)], kind, more)
    return run


def _finish(rank: np.ndarray):
    """Open rows (id, text, text of the next document) to results."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [_row(_Doc(i, text, rank), _Doc(None, nxt, rank), rank)
                    for i, text, nxt in zip(*(c.to_pylist() for c in b.columns))]
            if rows:
                yield _batch(rows, b.schema.field(0).type, [])
    return run


def neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next): see the module text; the edited text has its last
    third replaced by the beginning of the next document.  The number of ranges
    is the session's number of shuffle partitions."""
    spark = docs.sparkSession
    st = Stage(spark, "fingerprints")
    rank = corpus_ranks(docs, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    d = (docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
         .select("id", "text", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("place")))
    order = [F.desc_nulls_last("id"), F.desc("tie"), F.asc("place")]
    ranged = d.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")
    rows = st.stage(ranged.mapInArrow(_compare(rank), f"id {kind}, {RESULT}, part int, open boolean, own string, "
                                                      "head string"), "rows")
    parts = sorted(r[0] for r in rows.where("open").select("part").collect())  # one number per range
    after = spark.createDataFrame([(p, q) for p, q in zip(parts, parts[1:] + parts[:1])], "part int, next int")
    heads = rows.where("head IS NOT NULL").select(F.col("part").alias("next"), F.col("head").alias("next_text"))
    ends = rows.where("open").select("id", "own", "part").join(after, "part").join(heads, "next")
    return (rows.where("NOT open").select(*_NAMES)
            .unionByName(ends.select("id", "own", "next_text").mapInArrow(_finish(rank), f"id {kind}, {RESULT}"))
            .withColumnRenamed("id", id_col))
