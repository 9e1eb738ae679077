"""Toxicity by class-conditional counts with shared backoff: a lexicon of
log-ratios of continuation counts.

**Not a Kneser-Ney model:** no discount and no P(w | v) is computed; the README
says with figures what the full models reached.  What is kept of the method: an
expression (a word or a bigram) counts by its continuations, the distinct words
before it, so a passage that is copied a thousand times counts once; toxic and
ordinary labelled texts are counted apart; and rare expressions are smoothed
through counts that both classes share.  A class has its own probability of an
expression only where the two classes' continuation counts differ by ``CLEAR``
standard errors; every other expression takes, in both classes, the probability
of its shared backoff counts: a bigram that of its word, a word that of all
texts.  What both share cancels, so a text's statistic, the difference of the
two log-likelihoods per token, is a sum over clear expressions.  A logistic
curve fitted on labelled texts outside the counted sample turns it into a
probability.

The sample is bounded: ``SAMPLE`` texts per class and ``CALIBRATION`` texts of
either class, taken in the order of a hash of the id.  Counting runs on Spark;
the tables that scoring needs are bounded by the sample and broadcast.  Every
text is scored whole.

Defined cases: null, empty and word-less texts have statistic 0 (the score of
a text without evidence); without labels of both classes every score is the
share of toxic labels, or 0; repeated rows are scored alike; several labels of
one id count each, labels without an id none; equal hashes of the id go by id,
then label; extra columns stay, but those with the name of a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.llm.staging import Stage, reach
from railyard.llm.tokens import U64, mix64, text_chunks, word_hashes, word_spans

SAMPLE = 4_000
CALIBRATION = 4_000
#: Standard errors between the classes that give an expression counts of its own.
CLEAR = 4.0
#: Added to continuation counts, on the scale of the smaller class.
FLOOR = 0.25

#: Punctuation ends a word here, so that it does not hide one.
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 32


def in_training(id_col: str, parts: int = 5):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % parts != 0


def _tokens(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of (word before, word) and the texts' offsets; 0 stands before
    the first word."""
    plain = _PLAIN[buf]
    starts, ends, at = word_spans(plain, off)
    w = word_hashes(plain, starts, ends)
    v = np.zeros(len(w), U64)
    v[1:] = w[:-1]
    v[at[:-1][np.diff(at) > 0]] = 0
    return v, w, at


def _triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(two before, word before, word, toxic) of all tokens."""
    for b in batches:
        toxic = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for i, k, buf, off in text_chunks(b.column(1)):
            v, w, at = _tokens(buf, off)
            u = np.zeros(len(w), U64)
            u[1:] = np.where(v[1:] != 0, v[:-1], U64(0))
            t = np.repeat(toxic[i:i + k], np.diff(at))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x.view(np.int64)) for x in (u, v, w)), pa.array(t)], ["u", "v", "w", "t"])


def _pair_key(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix64(v * U64(0x9E3779B97F4A7C15) + w)


class Model:
    """Log-ratios (toxic over ordinary) of the clear words and bigrams."""

    def __init__(self, words: np.ndarray, of_words: np.ndarray, pairs: np.ndarray, of_pairs: np.ndarray):
        by, also = np.argsort(words), np.argsort(pairs)
        self.words, self.of_words = words[by], of_words[by]
        self.pairs, self.of_pairs = pairs[also], of_pairs[also]
        self.slope, self.bias = 1.0, 0.0

    def statistic(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        v, w, at = _tokens(buf, off)
        ratio = np.zeros(len(w))
        for table, logs, key in ((self.words, self.of_words, w), (self.pairs, self.of_pairs, _pair_key(v, w))):
            place, hit = _find(table, key)
            ratio[hit] = logs[place[hit]]
        total = np.concatenate([[0.0], np.cumsum(ratio)])
        return (total[at[1:]] - total[at[:-1]]) / np.maximum(np.diff(at), 1)


def _find(table: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
    at = np.searchsorted(table, x)
    at[at == len(table)] = 0
    return at, table[at] == x


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, parts: int,
            sample: int, calibration: int) -> tuple[list, list]:
    """Ids (with label) to count and to calibrate on; bounded lists."""
    known = (labels.where(in_training(id_col, parts) & F.col(label_col).isNotNull())
             .select(F.col(id_col).alias("id"), (F.col(label_col) != 0).alias("toxic"),
                     F.xxhash64(F.lit("toxicity"), F.col(id_col)).alias("h")).where(F.col("id").isNotNull()))
    counted = F.pmod("h", F.lit(4)) != 0
    take = []
    for cond, n in ((counted & F.col("toxic"), sample), (counted & ~F.col("toxic"), sample), (~counted, calibration)):
        take.append([(r["id"], r["toxic"]) for r in known.where(cond).orderBy("h", "id", "toxic").limit(n).collect()])
    return take[0] + take[1], take[2]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        parts: int = 5, sample: int = SAMPLE, calibration: int = CALIBRATION) -> Model:
    spark = docs.sparkSession
    st = Stage(spark, "toxicity")
    count_on, adjust_on = _sample(docs, labels, id_col, text_col, label_col, parts, sample, calibration)
    kind = labels.schema[id_col].dataType.simpleString()
    chosen = spark.createDataFrame([(i, t, True) for i, t in count_on] + [(i, t, False) for i, t in adjust_on],
                                   f"_id {kind}, toxic boolean, counted boolean")
    # at most 2 * SAMPLE + CALIBRATION rows
    texts = st.stage(docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("text"))
                     .join(F.broadcast(chosen), "_id"), "texts")
    triples = (texts.where("counted").select("toxic", "text")
               .mapInArrow(_triples, "u bigint, v bigint, w bigint, t bigint").distinct())
    # continuation counts: distinct words before the expression, per class
    pairs = st.stage(triples.groupBy("v", "w").agg(F.sum(1 - F.col("t")).alias("x0"), F.sum("t").alias("x1")), "pairs")
    words = st.stage(pairs.groupBy("w").agg(*[F.sum(F.expr(f"CAST(x{k} > 0 AS BIGINT)")).alias(f"x{k}")
                                              for k in (0, 1)]), "words")

    def clear(table: DataFrame):
        """Log-ratios of the expressions whose classes clearly differ."""
        m0, m1 = [float(x or 0) for x in table.agg(F.sum("x0"), F.sum("x1")).first()]
        if not m0 or not m1:
            return None
        share = (F.col("x0") + F.col("x1")) / (m0 + m1)
        error = F.sqrt(share * (1 / m0 + 1 / m1))
        s = min(m0, m1)
        logs = F.log((F.col("x1") / m1 * s + FLOOR) / (F.col("x0") / m0 * s + FLOOR))
        # at most (tokens of the sample) / CLEAR ** 2 rows: fewer continuations are never clear
        return (table.withColumn("x", logs).where(F.abs(F.col("x1") / m1 - F.col("x0") / m0) >= CLEAR * error)
                .drop("x0", "x1").toPandas())

    none = np.zeros(0, U64), np.zeros(0)
    parts_ = []
    for rows in (clear(words), clear(pairs)):
        if rows is None:
            parts_ += none
        else:
            w = rows["w"].to_numpy(np.int64).view(U64)
            parts_ += [_pair_key(rows["v"].to_numpy(np.int64).view(U64), w) if "v" in rows else w,
                       rows["x"].to_numpy(float)]
    m = Model(*parts_)
    stats, toxic = [], []
    held = spark.sparkContext.broadcast(m)
    for r in statistic(texts.where("NOT counted").select("toxic", "text"), held).collect():  # CALIBRATION rows
        stats.append(r["statistic"])
        toxic.append(bool(r["toxic"]))
    m.slope, m.bias = logistic(np.array(stats), np.array(toxic, float))
    return m


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 60) -> tuple[float, float]:
    """Slope and bias of P(y = 1) by Newton's method with a light penalty."""
    share = y.mean() if len(y) else 0.0
    if share in (0.0, 1.0):
        return 0.0, 40.0 * (1 if share else -1)
    scale = x.std() or 1.0
    z = np.stack([x / scale, np.ones(len(x))], 1)
    beta = np.array([0.0, np.log(share / (1 - share))])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -40, 40)))
        grad = z.T @ (p - y) + np.array([1e-2, 0]) * beta
        hess = (z * (p * (1 - p))[:, None]).T @ z + np.diag([1e-2, 1e-9])
        step = np.linalg.solve(hess, grad)
        beta = beta - np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])


def statistic(docs: DataFrame, held, text_col: str = "text") -> DataFrame:
    """``docs`` with the text replaced by ``statistic``."""
    reach(docs.sparkSession)
    rest = [c for c in docs.columns if c != text_col and c.lower() not in ("statistic", "score", "predicted")]
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*rest).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, k, buf, off in text_chunks(b.column(b.num_columns - 1)):
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(i, k) for c in b.columns[:-1]), pa.array(held.value.statistic(buf, off))],
                    [*b.schema.names[:-1], "statistic"])

    return docs.select(*rest, text_col).mapInArrow(run, ", ".join(filter(None, [kept, "statistic double"])))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with the text replaced by ``score`` (0 to 1) and ``predicted``."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    out = statistic(docs, held, text_col)
    logit = F.col("statistic") * model.slope + model.bias
    return (out.withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))).drop("statistic")
            .withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0)))
