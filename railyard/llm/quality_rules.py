"""Quality rules as weak supervision, with DataFrame functions only.

Each rule looks at one count of a text and votes good (1), bad (-1) or
abstains (0).  No rule decides: expectation-maximisation over the table of
vote patterns (at most ``3 ** len(RULES)`` rows, whatever the corpus size)
estimates how often each rule votes bad on good and on bad documents and how
common good documents are, without labels.  A document is kept when its
posterior probability of being good is at least one half and the hard base
rule does not fail it.

The counts come from one pass without a shuffle: windows of a text are hashed
and compared inside its row.  Votes and counts are staged once; each EM round
is one aggregate over the pattern table whose result is a single row.

Defined cases: null or empty text has no words, counts 0 and fails the base;
ties at one half keep the document; repeated rows are judged alike; on an
empty table the result is empty.  Extra columns stay.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railyard.llm.staging import Stage

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[^#*$%&|<>]+"
ROUNDS = 12

#: (name, measured share, good when low .. high, bad below, bad above).
#: Between the limits the rule abstains.
RULES = [
    ("word_length", "word_chars / n_words", 3.0, 9.0, 2.0, 14.0),
    ("symbols", "n_symbols / n_words", 0.0, 0.02, -1.0, 0.1),
    ("repeated_lines", "n_dup_lines / greatest(n_lines, 1)", 0.0, 0.1, -1.0, 0.3),
    ("repeated_words", "n_repeat_words / n_words", 0.0, 0.1, -1.0, 0.3),
    ("capitals", "n_capitals / greatest(word_chars, 1)", 0.0, 0.15, -1.0, 0.35),
    ("shouting", "n_marks / n_words", 0.0, 0.05, -1.0, 0.3),
    ("letters", "n_letters / greatest(word_chars, 1)", 0.88, 1.0, 0.8, 2.0),
    ("marked_words", "n_marked / n_words", 0.0, 0.03, -1.0, 0.2),
    ("digits", "n_digits / greatest(word_chars, 1)", 0.0, 0.05, -1.0, 0.3),
]


def counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the base counts and the counts that rules look at."""
    text = F.coalesce(F.col(text_col), F.lit(""))

    def left(pattern: str) -> Column:
        return F.length(F.regexp_replace("_t", pattern, "")).cast("long")

    out = (docs.withColumn("_t", text)
           .withColumn("_w", F.regexp_extract_all("_t", F.lit(WORD), F.lit(0)))
           .withColumn("_l", F.filter(F.split("_t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
           .withColumn("n_words", F.size("_w").cast("long"))
           .withColumn("_h", F.expr("""
               CASE WHEN size(_w) < 3 THEN array()
                    ELSE transform(sequence(0, size(_w) - 3),
                                   i -> xxhash64(get(_w, i), get(_w, i + 1), get(_w, i + 2))) END""")))
    # words inside windows that occur again: neighbours in the order of hashes
    again = F.expr("""
        CASE WHEN size(array_distinct(_h)) = size(_h) THEN 0L ELSE
        cast(get(transform(array(sort_array(transform(_h, (x, i) -> struct(x AS x, i AS i)))), s ->
            size(array_distinct(flatten(transform(
                filter(s, (e, j) -> coalesce(get(s, j - 1).x = e.x, false) OR coalesce(get(s, j + 1).x = e.x, false)),
                e -> array(e.i, e.i + 1, e.i + 2)))))), 0) AS bigint) END""")
    return (out.withColumn("word_chars", F.length(F.array_join("_w", "")).cast("long"))
            .withColumn("n_symbols", left(SYMBOL))
            .withColumn("n_dup_lines", (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"))
            .withColumn("n_lines", F.size("_l").cast("long"))
            .withColumn("n_repeat_words", again)
            .withColumn("n_capitals", left("[^A-Z]+"))
            .withColumn("n_marks", left("[^!?]+"))
            .withColumn("n_digits", left("[^0-9]+"))
            .withColumn("n_letters", left(r"\P{L}+"))
            .withColumn("n_marked", F.regexp_count("_t", F.lit(r"[#*$%&|<>](?=[\x20\x09-\x0D]|\z)")).cast("long"))
            .withColumn("base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words"))
            .drop("_t", "_w", "_l", "_h"))


def vote(rule: tuple) -> Column:
    _, share, low, high, under, over = rule
    x = f"(CASE WHEN n_words > 0 THEN ({share}) END)"
    return F.expr(f"CASE WHEN {x} BETWEEN {low} AND {high} THEN 1 "
                  f"WHEN {x} < {under} OR {x} > {over} THEN -1 ELSE 0 END").cast("int")


def _good(prior: float, bad_if_good: list[float], bad_if_bad: list[float]) -> Column:
    """Posterior probability of a good document, from its votes."""
    logit = F.lit(math.log(prior / (1 - prior)))
    for (name, *_), g, b in zip(RULES, bad_if_good, bad_if_bad):
        logit = logit + (F.when(F.col(f"v_{name}") < 0, math.log(g / b))
                         .when(F.col(f"v_{name}") > 0, math.log((1 - g) / (1 - b))).otherwise(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def fit(votes: DataFrame, st: Stage, rounds: int = ROUNDS) -> tuple[float, list[float], list[float]]:
    """(prior, P(bad vote | good), P(bad vote | bad)) by EM over vote patterns."""
    names = [f"v_{r[0]}" for r in RULES]
    patterns = st.stage(votes.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).coalesce(1), "patterns")
    model = (0.8, [0.05] * len(RULES), [0.4] * len(RULES))
    for _ in range(rounds):
        w = patterns.withColumn("g", _good(*model))
        sums = [F.sum(F.expr("n * g")), F.sum(F.expr("n * (1 - g)"))]
        for v in names:
            for weight in ("g", "(1 - g)"):
                sums += [F.sum(F.expr(f"CASE WHEN {v} < 0 THEN n * {weight} ELSE 0 END")),
                         F.sum(F.expr(f"CASE WHEN {v} <> 0 THEN n * {weight} ELSE 0 END"))]
        row = w.agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()
        x = [v or 0.0 for v in row]
        # pseudo-counts keep every probability inside (0, 1) and a bad vote on the side of bad
        model = ((x[0] + 8) / (x[0] + x[1] + 10),
                 [(x[2 + 4 * j] + 0.5) / (x[3 + 4 * j] + 10) for j in range(len(names))],
                 [(x[4 + 4 * j] + 4) / (x[5 + 4 * j] + 10) for j in range(len(names))])
    st.discard(patterns)
    return model


def judge(docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS, keep_text: bool = False) -> DataFrame:
    """``docs`` with the counts, votes, ``posterior`` and ``kept``; the text
    only with ``keep_text``.  Input columns with the name of a result column
    are replaced.  Without the text, texts are read once and the result reads the
    staged counts; with it they are read and counted twice, so that no copy of
    the corpus is staged."""
    st = Stage(docs.sparkSession, "quality-rules")
    bare = counts(docs.select(F.col(text_col).alias("_text")), "_text").columns[1:]
    votes = [f"v_{r[0]}" for r in RULES]
    new = {c.lower() for c in [*bare, *votes, "posterior", "kept", text_col]}
    carried = [c for c in docs.columns if c.lower() not in new]
    packed = docs.select(F.struct(F.lit(0).alias("_"), *carried).alias("_row"), F.col(text_col).alias("_text"))
    counted = counts(packed, "_text")
    for rule in RULES:
        counted = counted.withColumn(f"v_{rule[0]}", vote(rule))
    counted = counted.select(*[F.col("_row")[c].alias(c) for c in carried],
                             *[F.col("_text").alias(text_col)] * keep_text, *bare, *votes)
    if keep_text:
        # a filter on the verdict must not be pushed below the counts, where it would evaluate them anew
        counted = counted.withColumn("_once", F.monotonically_increasing_id())
    else:
        counted = st.stage(counted, "counts").withColumn("_once", F.lit(0))
    model = fit(counted, st, rounds)
    verdict = ~F.col("base_failed") & (F.col("posterior") >= 0.5) & (F.col("_once") >= 0)
    return counted.withColumn("posterior", _good(*model)).withColumn("kept", verdict).drop("_once")


def oracle_sql(rounds: int = ROUNDS) -> str:
    """The same counts, votes and EM rounds for DuckDB."""
    names = [r[0] for r in RULES]

    def vote_sql(rule):
        _, share, low, high, under, over = rule
        x = f"(CASE WHEN n_words > 0 THEN ({share}) END)"
        return f"CASE WHEN {x} BETWEEN {low} AND {high} THEN 1 WHEN {x} < {under} OR {x} > {over} THEN -1 ELSE 0 END"

    def good_sql(model):
        terms = "".join(f" + CASE WHEN v_{n} < 0 THEN ln({model}.g_{n} / {model}.b_{n}) WHEN v_{n} > 0 "
                        f"THEN ln((1 - {model}.g_{n}) / (1 - {model}.b_{n})) ELSE 0 END" for n in names)
        return f"1 / (1 + exp(-(ln({model}.prior / (1 - {model}.prior)){terms})))"

    steps = ["m0 AS (SELECT 0.8::DOUBLE AS prior, "
             + ", ".join(f"0.05::DOUBLE AS g_{n}, 0.4::DOUBLE AS b_{n}" for n in names) + ")"]
    for k in range(1, rounds + 1):
        sums = ", ".join(
            f"(sum(CASE WHEN v_{n} < 0 THEN n * g ELSE 0 END) + 0.5) / (sum(CASE WHEN v_{n} <> 0 THEN n * g ELSE 0 END) + 10)"
            f" AS g_{n}, (sum(CASE WHEN v_{n} < 0 THEN n * (1 - g) ELSE 0 END) + 4) / "
            f"(sum(CASE WHEN v_{n} <> 0 THEN n * (1 - g) ELSE 0 END) + 10) AS b_{n}" for n in names)
        steps.append(f"m{k} AS MATERIALIZED (SELECT (sum(n * g) + 8) / (sum(n * g) + sum(n * (1 - g)) + 10) AS prior, {sums} "
                     f"FROM (SELECT p.*, {good_sql(f'm{k - 1}')} AS g FROM patterns p, m{k - 1}))")
    votes = ", ".join(f"{vote_sql(r)} AS v_{r[0]}" for r in RULES)
    return rf"""
WITH d AS MATERIALIZED (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
u AS (SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM d),
tri AS (SELECT doc_id, i, [w, lead(w) OVER s, lead(w, 2) OVER s] AS win, lead(w, 2) OVER s IS NOT NULL AS full_win FROM u
        WINDOW s AS (PARTITION BY doc_id ORDER BY i)),
twice AS (SELECT doc_id, i FROM tri WHERE full_win QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
c AS MATERIALIZED (SELECT d.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines)::BIGINT AS n_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words, length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS n_capitals,
         length(regexp_replace(t, '[^!?]+', '', 'g')) AS n_marks, length(regexp_replace(t, '[^0-9]+', '', 'g')) AS n_digits,
         length(regexp_replace(t, '\P{{L}}+', '', 'g')) AS n_letters,
         len(list_filter(words, lambda x: regexp_matches(x, '[#*$%&|<>]$'))) AS n_marked
  FROM d LEFT JOIN rep USING (doc_id)),
v AS MATERIALIZED (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {votes} FROM c),
patterns AS MATERIALIZED (SELECT {", ".join(f"v_{n}" for n in names)}, count(*) AS n FROM v GROUP BY ALL),
{", ".join(steps)}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {good_sql(f"m{rounds}")} >= 0.5 AS kept
FROM v, m{rounds}"""
