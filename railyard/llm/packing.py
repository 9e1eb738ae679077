"""Best-fit packing planned over a histogram of lengths.

Documents become token ids (a public byte-level BPE, then an end id); those
longer than a sequence are cut into full pieces, the first of which may be
shorter.  Packing looks at the histogram of piece lengths alone, which has at
most ``capacity`` rows whatever the corpus: best-fit decreasing places all
pieces of a length at once into groups of sequences with equal free space, so
the plan is a short list of slot ranges ``(length, first rank, sequences,
pieces per sequence, first sequence, offset)``.  Pieces then take their slots
by rank within their length.

Ranks need no single task per length: pieces are dealt into buckets by a hash
of their identity, buckets are counted, and a piece's rank is the number of
pieces in lower buckets of its length plus its row number within its bucket.

The vocabulary file is a parameter; each Python worker loads it once and
remembers the ids of chunks: words with the blank or newline before them.  The
tokenizer never joins these with their neighbours, so the ids are those of the
whole text; texts with other white space are encoded whole.

Defined cases: null text is empty and yields the end id alone; rows with equal
ids each get their own pieces (``row`` tells them apart); an empty table packs
into nothing.  Extra columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railyard.llm.staging import Stage
from railyard.llm.tokens import U64, mix64, text_chunks, word_hashes, word_spans

CAPACITY = 2048
#: Distinct chunks that a worker remembers before it starts again.
REMEMBERED = 1_500_000
#: Pieces per rank bucket that the number of buckets aims at.
BUCKET_ROWS = 20_000


def vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


_NEWLINE = 198
_SEED = U64(0x8BB84B93962EACC9)
#: Ends of the UTF-8 forms of white space beyond ASCII: what may follow each two-byte beginning.
_WIDE = {(0xE1, 0x9A): {0x80}, (0xE2, 0x81): {0x9F}, (0xE3, 0x80): {0x80},
         (0xE2, 0x80): {*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF}}


def _odd_texts(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Texts that must be encoded whole: white space other than single blanks
    and single newlines between other characters."""
    n = len(buf)
    space = (buf == 32) | (buf == 10)
    odd = (buf == 9) | ((buf >= 11) & (buf <= 13))
    if n > 1:
        odd[1:] |= space[1:] & space[:-1]
        odd[:-1] |= (buf[:-1] == 0xC2) & ((buf[1:] == 0x85) | (buf[1:] == 0xA0))
        for first, second in _WIDE:
            for at in np.flatnonzero((buf[:-1] == first) & (buf[1:] == second)):
                odd[at] |= at + 2 < n and int(buf[at + 2]) in _WIDE[first, second]
    full = off[:-1][np.diff(off) > 0]
    odd[full] |= space[full]
    last = off[1:][np.diff(off) > 0] - 1
    odd[last] |= space[last]
    before = np.concatenate([[0], np.cumsum(odd)])
    return before[off[1:]] > before[off[:-1]]


class Encoder:
    """Token ids of texts given as UTF-8 buffers.

    Chunks are words with what stands before them (a blank, a newline or the
    beginning of a text).  Their ids are kept in one flat pool, found by a
    64-bit hash, so encoding a text is a gather over its words."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, U64)
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.filled = np.zeros(1 << 16, np.uint32), 0

    def _add(self, ids: np.ndarray) -> None:
        if self.filled + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool[:self.filled], np.zeros(self.filled + 2 * len(ids), np.uint32)])
        self.pool[self.filled:self.filled + len(ids)] = ids
        self.filled += len(ids)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, keys: np.ndarray, chunks: list[str], leads: np.ndarray) -> None:
        """Ids of chunks by their leads (0 none, 1 blank, 2 newline); one call
        encodes many chunks between newlines."""
        first, count = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
        for lead, open_ in ((0, ""), (1, " "), (2, "")):
            which = np.flatnonzero(leads == lead)
            groups = [which[i:i + 64] for i in range(0, len(which), 64)]
            coded = self._encode(["\n" + "\n".join([open_ + chunks[k] for k in g]) + "\n" for g in groups])
            for g, ids in zip(groups, coded):
                ids = np.array(ids, np.uint32)
                at = np.flatnonzero(ids == _NEWLINE)
                if len(at) != len(g) + 1:  # not expected of chunks without white space
                    parts = [np.array(x, np.uint32) for x in self._encode([open_ + chunks[k] for k in g])]
                    ids = np.concatenate([np.append(np.uint32(_NEWLINE), x) for x in parts] + [[np.uint32(_NEWLINE)]])
                    at = np.cumsum([0] + [len(x) + 1 for x in parts])
                # a newline belongs to the chunk after it
                first[g] = self.filled + at[:-1] + (lead != 2)
                count[g] = np.diff(at) - (lead != 2)
                self._add(ids)
        keys, first, count = (np.concatenate(x) for x in ((self.keys, keys), (self.first, first), (self.count, count)))
        order = np.argsort(keys)
        self.keys, self.first, self.count = keys[order], first[order], count[order]

    def encode(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of the texts)."""
        if len(self.keys) > REMEMBERED:
            self.forget()
        odd = _odd_texts(buf, off)
        starts, ends, at = word_spans(buf, off)
        lead = np.where(buf[np.maximum(starts - 1, 0)] == 10, 2, 1)
        lead[at[:-1][np.diff(at) > 0]] = 0
        if odd.any():  # their words are left out
            use = np.repeat(~odd, np.diff(at))
            starts, ends, lead = starts[use], ends[use], lead[use]
            at = np.concatenate([[0], np.cumsum(np.where(odd, 0, np.diff(at)))])
        key = mix64(word_hashes(buf, starts, ends, lower=False) + lead.astype(U64) * _SEED)
        kinds, seen, of = np.unique(key, return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, kinds)
        there = np.zeros(len(kinds), bool)
        inside = place < len(self.keys)
        there[inside] = self.keys[place[inside]] == kinds[inside]
        if not there.all():
            new = np.flatnonzero(~there)
            spans = zip(starts[seen[new]].tolist(), ends[seen[new]].tolist())
            raw = buf.tobytes()
            self._learn(kinds[new], [raw[s:e].decode() for s, e in spans], lead[seen[new]])
            place = np.searchsorted(self.keys, kinds)
        at_pool, size = self.first[place][of], self.count[place][of]
        total = np.concatenate([[0], np.cumsum(size)])
        ids = self.pool[np.repeat(at_pool - total[:-1], size) + np.arange(total[-1])]
        bounds = total[at]
        if not odd.any():
            return ids, bounds
        whole = dict(zip(np.flatnonzero(odd).tolist(), self._encode(
            [buf[off[k]:off[k + 1]].tobytes().decode() for k in np.flatnonzero(odd)])))
        parts = [np.array(whole[k], np.uint32) if k in whole else ids[bounds[k]:bounds[k + 1]]
                 for k in range(len(odd))]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """One encoder per Python worker, kept from task to task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _pieces(path: str, capacity: int, end_id: int, with_ids: bool):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for b in batches:
            for i, docs, buf, off in text_chunks(b.column(2)):
                of, piece, start, length, crc, raw = [], [], [], [], [], []
                ids, bounds = encoder.encode(buf, off)
                codes = ids.astype("<u4", copy=False).tobytes()
                for d in range(docs):
                    code = codes[4 * bounds[d]:4 * bounds[d + 1]] + end
                    n = len(code) // 4
                    at = 0
                    for k in range(-(-n // capacity)):
                        size = (n - 1) % capacity + 1 if k == 0 else capacity
                        cut = code[4 * at:4 * (at + size)]
                        of.append(i + d)
                        piece.append(k)
                        start.append(at)
                        length.append(size)
                        crc.append(zlib.crc32(cut))
                        if with_ids:
                            raw.append(cut)
                        at += size
                of = pa.array(of, pa.int64())
                out = [b.column(0).take(of), b.column(1).take(of), pa.array(piece, pa.int32()),
                       pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["id", "row", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    out, names = out + [pa.array(raw, pa.binary())], names + ["ids"]
                yield pa.RecordBatch.from_arrays(out, names)
    return run


def tokenize(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id",
             text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, row, piece, start, length, ids_crc32[, ids]) of all pieces; ids are
    little-endian 32-bit."""
    kind = docs.schema[id_col].dataType.simpleString()
    fields = f"id {kind}, row bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    return (docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.col(text_col))
            .mapInArrow(_pieces(path, capacity, end_id, with_ids), fields + ", ids binary" * with_ids))


def plan(histogram: list[tuple[int, int]], capacity: int = CAPACITY) -> tuple[list[tuple], int]:
    """Slot ranges (length, first rank, sequences, pieces per sequence, first
    sequence, offset) by best-fit decreasing, and the number of sequences."""
    free: dict[int, list[tuple[int, int]]] = {}  # free space: runs (first sequence, sequences)
    spaces: list[int] = []
    slots, opened = [], 0

    def put(space: int, first: int, count: int) -> None:
        if space > 0 and count > 0:
            if space not in free:
                bisect.insort(spaces, space)
            free.setdefault(space, []).append((first, count))

    for length, left in sorted(histogram, reverse=True):
        rank = 0
        while left:
            k = bisect.bisect_left(spaces, length)
            if k < len(spaces):
                space = spaces[k]
                first, count = free[space].pop()
                if not free[space]:
                    del free[space], spaces[k]
            else:
                space, first = capacity, opened
                count = -(-left // (capacity // length))
                opened += count
            each = space // length
            whole = min(count, left // each)
            if whole:
                slots.append((length, rank, whole, each, first, capacity - space))
                put(space - each * length, first, whole)
                rank, left = rank + whole * each, left - whole * each
                first, count = first + whole, count - whole
            if count and left:  # fewer than fill one sequence
                slots.append((length, rank, 1, left, first, capacity - space))
                put(space - left * length, first, 1)
                rank, left, first, count = rank + left, 0, first + 1, count - 1
            put(space, first, count)
    return slots, opened


def _place(slots: list[tuple]):
    """Adds (sequence_id, offset) to rows with a length and a rank."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.array(sorted(slots), np.int64).reshape(-1, 6)
        lengths, first = np.unique(table[:, 0], return_index=True)
        last = np.append(first[1:], len(table))
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            at = np.empty(len(b), np.int64)
            for x in np.unique(length):
                k, here = np.searchsorted(lengths, x), length == x
                ranks = table[first[k]:last[k], 1]
                at[here] = first[k] + np.searchsorted(ranks, rank[here], side="right") - 1
            t = table[at]
            inside = rank - t[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(t[:, 4] + inside // t[:, 3]),
                 pa.array(t[:, 5] + inside % t[:, 3] * length)], [*b.schema.names, "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = 0,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id_col, piece, start, length, ids_crc32, sequence_id, offset[, ids]),
    a row per piece."""
    spark = docs.sparkSession
    st = Stage(spark, "packing")
    pieces = st.stage(tokenize(docs, path or vocabulary(), capacity, end_id, id_col, text_col, with_ids), "pieces")
    histogram = [(r[0], r[1]) for r in pieces.groupBy("length").count().collect()]  # at most ``capacity`` rows
    slots, _ = plan(histogram, capacity)
    buckets = 1 + sum(n for _, n in histogram) // BUCKET_ROWS
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("id", "row", "piece"), F.lit(buckets)))
    before = (dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("bucket"))
                          - F.col("n")).drop("n"))
    number = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("id", "row", "piece")) - 1
    ranked = (dealt.withColumn("k", number).join(before, ["length", "bucket"])
              .withColumn("rank", F.col("before") + F.col("k")).drop("bucket", "k", "before"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema)
    placed = ranked.mapInArrow(_place(slots), fields + ", sequence_id bigint, offset bigint")
    return placed.select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset",
                         *["ids"] * with_ids)
