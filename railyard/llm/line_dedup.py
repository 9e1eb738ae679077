"""Line dedup by overlapping three-line windows.

Every text is cut at newlines; lines without a word are no lines for this
purpose and always stay.  Each run of ``window`` consecutive lines is hashed
(two 64-bit hashes); a text of fewer lines is one window of all its lines.
Over the whole corpus the first occurrence of a window, in order of document
id and position, stays.  Every later occurrence covers its lines; the covered
positions of a document are merged and those lines are removed.

Only hashes and positions are shuffled for the search; the first occurrence
is a map-side combined minimum, so a window that a third of all documents
hold costs one row per map task there.  Texts move once, to meet their own
covered positions.

Defined cases: null text has no lines and stays null; of rows with equal ids
the one that Spark's hash of the text puts first counts as earlier, and exact
repeats of a row count as one row; a document all of whose lines are covered
gets an empty text; an empty table gives no rows.  Extra columns stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.llm.staging import Stage

_HAS_WORD = "[^ \t\n\x0b\x0c\r]"


def windows(docs: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """(id, tie, at, n, h1, h2): windows starting at line number ``at``."""
    # ``l`` is bound once per row; inside the inner lambda it is a variable, not an expression
    found = F.expr(f"""get(transform(array(filter(split(coalesce(_t, ''), '\n', -1), x -> x RLIKE '{_HAS_WORD}')), l ->
        transform(sequence(0, greatest(size(l) - {window}, 0)), i -> struct(
            i AS at, least(size(l), {window}) AS n, xxhash64(slice(l, i + 1, {window})) AS h1,
            xxhash64(1, slice(l, i + 1, {window})) AS h2))), 0)""")
    return (docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("tie"), F.col(text_col).alias("_t"))
            .select("id", "tie", F.inline(found)).where("n > 0"))


def covered(docs: DataFrame, window: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, tie, covered): merged line numbers of later occurrences."""
    found = Stage(docs.sparkSession, "line-dedup").stage(windows(docs, window, id_col, text_col), "windows")
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "tie", "at")
    first = (found.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("times"), F.min(place).alias("first"))
             .where("times > 1"))
    later = found.join(first, ["h1", "h2"]).where(place != F.col("first"))
    return (later.groupBy("id", "tie").agg(F.collect_set(F.struct("at", "n")).alias("hits"))
            .withColumn("covered", F.array_distinct(F.flatten(F.transform(
                "hits", lambda x: F.sequence(x["at"], x["at"] + x["n"] - 1)))))
            .select("id", "tie", "covered"))


def drop_repeats(docs: DataFrame, window: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with later occurrences removed from the text, plus ``n_lines``
    and ``n_removed`` (which replace input columns of that name)."""
    hits = covered(docs, window, id_col, text_col)
    hits = hits.select(F.col("id").alias("_id"), F.col("tie").alias("_of"), "covered")
    carried = [c for c in docs.columns if c != text_col and c.lower() not in ("n_lines", "n_removed")]
    keyed = docs.select(F.struct(F.lit(0).alias("_"), *carried).alias("_row"), F.col(id_col).alias("_key"),
                        F.col(text_col).alias("_text"), F.xxhash64(text_col).alias("_tie"))
    joined = keyed.join(hits, F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_tie") == F.col("_of")), "left")
    numbered = (joined.withColumn("n_lines", F.size(F.filter(
        F.split(F.coalesce("_text", F.lit("")), "\n", -1), lambda x: x.rlike(_HAS_WORD))).cast("long"))
                .withColumn("n_removed", F.when(F.col("covered").isNull(), F.lit(0))
                            .otherwise(F.size("covered")).cast("long")))
    # ``l``: all lines, ``a``: places of those with a word, which covered line numbers count
    kept = F.expr(f"""get(transform(array(split(coalesce(_text, ''), '\n', -1)), l ->
        get(transform(array(filter(sequence(0, size(l) - 1), i -> get(l, i) RLIKE '{_HAS_WORD}')), a ->
            array_join(transform(array_except(sequence(0, size(l) - 1), transform(covered, c -> get(a, c))),
                                 i -> get(l, i)), '\n')), 0)), 0)""")
    text = (F.when(F.col("covered").isNull(), F.col("_text"))
            .when(F.size("covered") == F.col("n_lines"), F.lit("")).otherwise(kept))
    columns = [text.alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in docs.columns
               if c == text_col or c in carried]
    return numbered.select(*columns, "n_lines", "n_removed")


def oracle_sql() -> str:
    return r"""
WITH l AS (SELECT doc_id, list_filter(string_split(coalesce(text, ''), chr(10)),
                  lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
w AS (SELECT doc_id, spot, lines[spot + 1:spot + least(len(lines), 3)] AS win, least(len(lines), 3) AS n
      FROM (SELECT doc_id, lines, unnest(range(0, len(lines) - least(len(lines), 3) + 1)) AS spot
            FROM l WHERE len(lines) > 0)),
f AS (SELECT *, row_number() OVER (PARTITION BY win ORDER BY doc_id, spot) AS k FROM w),
c AS (SELECT doc_id, list_distinct(flatten(list(range(spot, spot + n)))) AS covered FROM f WHERE k > 1 GROUP BY doc_id),
i AS (SELECT doc_id, x, pos, sum(CASE WHEN regexp_matches(x, '[^\x20\x09-\x0D]') THEN 1 ELSE 0 END)
             OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS num, regexp_matches(x, '[^\x20\x09-\x0D]') AS has
      FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x,
                   generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)),
k AS (SELECT i.doc_id, string_agg(x, chr(10) ORDER BY pos) FILTER (WHERE NOT (has AND list_contains(covered, num))) AS kept
      FROM i JOIN c USING (doc_id) GROUP BY i.doc_id)
SELECT d.doc_id, CASE WHEN c.covered IS NULL THEN d.text WHEN len(c.covered) = len(l.lines) THEN '' ELSE k.kept END AS text,
       len(l.lines)::BIGINT AS n_lines, coalesce(len(c.covered), 0)::BIGINT AS n_removed
FROM documents d JOIN l USING (doc_id) LEFT JOIN c USING (doc_id) LEFT JOIN k USING (doc_id)"""
