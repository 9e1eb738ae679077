"""Language identification by cross-parsing against suffix automata.

For each language a bounded sample of labelled text (``SAMPLE_CHARS``
normalised characters, a documented parameter; copies of a text count once) is
turned into its suffix automaton, which accepts exactly the substrings of the sample.  A text is
parsed greedily into the longest phrases that occur in a language's sample;
the language that needs fewest phrases per character wins (cross-parsing
entropy).  Every text is parsed whole, in blocks of ``BLOCK`` characters that
each start a new phrase.

The automata are dense tables whose missing transitions already point to the
state that starts the next phrase, with a mark that a phrase ended.  So the
parse of a batch is one table lookup per character and language, done for all
blocks of the batch in step.

Normalisation: lower case; digits, punctuation and letters that occur in no
sample become one blank class; runs of it count once.  Every letter of every
sample keeps an identity of its own: the ``ALPHABET`` classes of the tables are
symbols, the most frequent letters are one symbol each and the others two to
four (``Alphabet``), so no language loses its letters to more frequent ones.
Sample and block lengths count symbols.

Defined cases: null text and text without a letter are ``und`` with score 0;
ties go to the language first in code-point order; without any labelled text
every text is ``und``; repeated rows are judged alike; extra
columns stay, but those with the name of a result column are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railyard.llm.staging import reach

#: Bounds of the training sample, per language.
SAMPLE_CHARS = 40_000
SAMPLE_ROWS = 400
SAMPLE_ROW_CHARS = 1_000
#: Symbols of the tables: the blank, letters of one symbol, and symbols that open letters of two, three and four.
ALPHABET = 62
LEADS = (8, 6, 2)
BLOCK = 1_024
_END = np.int32(-(1 << 31))


def held_out(id_col: str, parts: int = 5) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % parts == 0


def sample(docs: DataFrame, label_col: str = "lang", id_col: str = "doc_id", text_col: str = "text",
           parts: int = 5) -> dict[str, str]:
    """A bounded sample per label of the distinct texts that are not held out, in
    an order given by a hash of the text: a stretch of each, which starts where
    the hash says.  At most ``SAMPLE_ROWS`` rows of ``SAMPLE_ROW_CHARS``
    characters per label reach the driver."""
    length, start = F.length(text_col), F.pmod(F.shiftright("h", 8), F.col("n") - SAMPLE_ROW_CHARS + 1)
    rows = (docs.where(~held_out(id_col, parts) & F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
            .where(length > 0)
            .select(F.col(label_col).alias("label"), F.xxhash64(text_col).alias("h"), length.alias("n"),
                    F.col(text_col).alias("t"))
            .select("label", "h", F.when(F.col("n") <= SAMPLE_ROW_CHARS, F.col("t")).otherwise(
                F.substring("t", start.cast("int") + 1, F.lit(SAMPLE_ROW_CHARS))).alias("t")))
    # copies count once; the smallest hashes, first within 64 parts of each label and then over the parts
    rows = rows.groupBy("label", "h").agg(F.min("t").alias("t"))
    part = Window.partitionBy("label", F.pmod("h", F.lit(64))).orderBy("h")
    last = Window.partitionBy("label").orderBy("h")
    rows = (rows.withColumn("k", F.row_number().over(part)).where(F.col("k") <= SAMPLE_ROWS // 8)
            .withColumn("k", F.row_number().over(last)).where(F.col("k") <= SAMPLE_ROWS))
    for_driver = rows.orderBy("label", "h")
    out: dict[str, str] = {}
    for r in for_driver.collect():
        out[r["label"]] = out.get(r["label"], "") + "\n" + r["t"]
    return out


class Alphabet:
    """Symbols of characters: 0 is the blank; a letter is one to four symbols,
    by its frequency over all samples (no code begins another)."""

    def __init__(self, texts: list[str], size: int):
        common = Counter()
        for t in texts:
            common.update(c for c in t.lower() if c.isalpha())
        letters = [c for c, _ in sorted(common.items(), key=lambda x: (-x[1], x[0]))]
        self.size, follow = size, size - 1
        single = follow - sum(LEADS)
        codes = [(0,)] + [(k,) for k in range(1, single + 1)]
        lead = single + 1
        for length, n in enumerate(LEADS, 2):
            for k in range(min(n * follow ** (length - 1), max(0, len(letters) + 1 - len(codes)))):
                code = []
                for _ in range(length - 1):
                    k, low = divmod(k, follow)
                    code.append(1 + low)
                codes.append((lead + k, *code))
            lead += n
        self.rank = np.zeros(0x110000, np.int32)
        self.length = np.array([len(c) for c in codes], np.int64)
        self.symbols = np.array([c + (0,) * (4 - len(c)) for c in codes], np.uint8)
        for k, c in enumerate(letters, 1):
            self.rank[ord(c)] = k
            for big in {c.upper(), c.title()}:
                if len(big) == 1:
                    self.rank[ord(big)] = k

    def codes(self, points: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of code points without repeated blanks, and the new starts of the texts."""
        x = self.rank[points]
        keep = np.ones(len(x), bool)
        keep[1:] = (x[1:] != 0) | (x[:-1] != 0)
        first = start[:-1][start[:-1] < len(x)]
        keep[first] = True
        x, start = x[keep], np.concatenate([[0], np.cumsum(keep)])[start]
        size = self.length[x]
        if size.max(initial=1) == 1:
            return self.symbols[x, 0], start
        return (self.symbols[x][np.arange(4) < size[:, None]], np.concatenate([[0], np.cumsum(size)])[start])


def automaton(codes: np.ndarray, size: int) -> np.ndarray:
    """Flat transition table of the suffix automaton of ``codes``: the entry of
    (state, class) is the next state times ``size``, negative when a new phrase
    starts with the class.  The last state stands before any phrase."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes.tolist():
        cur = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = cur
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    # after a phrase: what starts the next one; a class that the sample lacks is a phrase of its own
    begin = np.full(size, len(moves) * size, np.int64)
    for c, t in moves[0].items():
        begin[c] = t * size
    table = np.tile(begin + int(_END), (len(moves) + 1, 1))
    for s, m in enumerate(moves):
        for c, t in m.items():
            table[s, c] = t * size
    return table.astype(np.int32).ravel()


def learn(texts: dict[str, str], size: int = ALPHABET, chars: int = SAMPLE_CHARS):
    """(languages, alphabet, tables) in code-point order of the languages."""
    langs = sorted(k for k, t in texts.items() if any(c.isalpha() for c in t))
    alphabet = Alphabet([texts[k] for k in langs], size)
    tables = []
    for k in langs:
        points = np.frombuffer(texts[k].encode("utf-32-le", "replace"), np.uint32)
        codes, _ = alphabet.codes(points, np.array([0, len(points)]))
        tables.append(automaton(codes[:chars], size))
    return langs, alphabet, tables


def phrases(codes: np.ndarray, start: np.ndarray, table: np.ndarray, classes: int = ALPHABET,
            block: int = BLOCK) -> np.ndarray:
    """Phrases that each text needs against one automaton."""
    size = np.diff(start)
    texts, before = len(size), len(table) - classes
    blocks = -(-size // block)
    owner = np.repeat(np.arange(len(size)), blocks)
    nth = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    at = start[:-1][owner] + nth * block
    left = np.minimum(size[owner] - nth * block, block)
    order = np.argsort(-left, kind="stable")
    at, left, owner = at[order], left[order], owner[order]
    state = np.full(len(at), before, np.int32)
    begun = np.zeros(len(at), np.int32)
    # number of blocks still running after each step
    running = np.searchsorted(-left, -np.arange(1, block + 1), side="right")
    for step in range(block):
        n = running[step]
        if n == 0:
            break
        state[:n] += codes[at[:n] + step]
        np.take(table, state[:n], out=state[:n], mode="clip")
        begun[:n] -= state[:n] >> 31
        state[:n] &= 0x7FFFFFFF
    return np.bincount(owner, weights=begun, minlength=texts)


def _predict(model):
    langs, alphabet, tables = model.value if hasattr(model, "value") else model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            i = 0
            texts = b.column(b.num_columns - 1)
            while i < len(b):
                part, n = [], 0
                while i + len(part) < len(b) and n < 4 << 20:
                    part.append(texts[i + len(part)].as_py() or "")
                    n += len(part[-1])
                # characters beyond the table's last plane do not exist; lone surrogates cannot occur in Arrow text
                points = np.frombuffer("".join(part).encode("utf-32-le"), np.uint32)
                start = np.concatenate([[0], np.cumsum([len(t) for t in part])])
                codes, start = alphabet.codes(points, start)
                size = np.maximum(np.diff(start), 1)
                cost = np.stack([phrases(codes, start, t, alphabet.size) / size for t in tables]) if tables else np.ones((1, len(part)))
                best = cost.argmin(0)
                # share of the winner when phrases weigh as bits: 2 ** (-phrases) summed over languages
                weight = np.exp2(-np.minimum((cost - cost.min(0)) * np.minimum(size, 256), 60))
                score = 1.0 / weight.sum(0)
                known = np.array([any(map(str.isalpha, t)) for t in part]) & bool(langs)
                names = [langs[k] if ok else "und" for k, ok in zip(best, known)]
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(i, len(part)) for c in b.columns[:-1]), pa.array(names, pa.string()),
                     pa.array(np.where(known, score, 0.0)), pa.array(np.where(known, cost.min(0), np.nan))],
                    [*b.schema.names[:-1], "lang_pred", "score", "phrases_per_char"])
                i += len(part)
    return run


def identify(docs: DataFrame, model, text_col: str = "text") -> DataFrame:
    """``docs`` with the text replaced by (lang_pred, score, phrases_per_char)."""
    reach(docs.sparkSession)
    rest = [c for c in docs.columns if c != text_col and c.lower() not in ("lang_pred", "score", "phrases_per_char")]
    held = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*rest).schema)

    def run(batches):
        yield from _predict(held)(batches)

    return docs.select(*rest, text_col).mapInArrow(
        run, ", ".join(filter(None, [kept, "lang_pred string, score double, phrases_per_char double"])))
