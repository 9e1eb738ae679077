"""The corpus pipeline against a plain Python pipeline, and on awkward rows."""
import hashlib
import itertools
from collections import Counter, defaultdict

from pyspark.sql import functions as F

import corpus_pipeline
from railyard.llm import quality_rules
from tests.conftest import SMOKE
from tests.llm.test_operators import DOCS, WORD, awkward, check_packing, components, empty


def plain_lines(docs):
    """Later occurrences of three-line windows go; (doc_id, source, text) rows in order of id."""
    seen, out = set(), []
    for i, source, text in sorted(docs):
        lines = text.split("\n")
        at = [k for k, x in enumerate(lines) if WORD.search(x)]
        n = min(3, len(at))
        gone = set()
        for k in range(len(at) - n + 1):
            window = tuple(lines[j] for j in at[k:k + n])
            if window in seen:
                gone |= set(at[k:k + n])
            seen.add(window)
        if len(gone) < len(at) or not at:
            out.append((i, source, "\n".join(x for k, x in enumerate(lines) if k not in gone)))
    return out


def draws(i):
    digits = "".join(hashlib.sha256(f"mix{k}:{i}".encode()).hexdigest() for k in (0, 1))
    return [int(digits[8 * k:8 * k + 8], 16) / 2**32 for k in range(16)]


def plain_mix(docs):
    size = {i: len(WORD.findall(t)) for i, _, t in docs}
    whole = Counter()
    for i, s, _ in docs:
        whole[s] += size[i]
    order = sorted(whole)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target, open_, left = {}, set(order), 1.5 * sum(whole.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if 2 * whole[s] <= weight[s] * level}
        for s in over or open_:
            target[s] = 2.0 * whole[s] if over else weight[s] * level
        left -= sum(target[s] for s in over)
        open_ = open_ - over if over else set()
    out = []
    for s in order:
        rate = target[s] / whole[s]
        own = [d for d in docs if d[1] == s]
        misses = [abs(sum(size[i] for i, _, _ in own if draws(i)[k] < rate % 1) + int(rate) * whole[s] - target[s])
                  for k in range(16)]
        best = misses.index(min(misses))
        for d in own:
            out += [d] * (int(rate) + (draws(d[0])[best] < rate % 1))
    return out


def test_pipeline_equals_plain_python(spark):
    df = spark.read.parquet(f"{SMOKE}/documents.parquet")
    kept = {r.doc_id for r in quality_rules.judge(df).where("kept").collect()}
    docs = plain_lines([(r.doc_id, r.source, r.text) for r in df.collect() if r.doc_id in kept])
    first = {c for _, _, c in components([(i, t) for i, _, t in docs], 5, 4, 5)}
    docs = plain_mix([d for d in docs if d[0] in first])
    got = corpus_pipeline.run(spark, SMOKE).collect()
    check_packing(got, [(i, t) for i, _, t in docs], 2048)


def test_stages_keep_columns_and_rows(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "source_mix",
                                                     "best_fit_packing"]
    text = " ".join("".join(x) + "o" for x in itertools.permutations("aeiourst", 4))[:900]
    clean = spark.createDataFrame([(50, text, None, None, len(text)), (51, text, "en", "z", len(text))], DOCS)
    odd = awkward(spark)
    for df in (odd, odd.limit(0), empty(spark)):
        docs = df
        if df is odd:
            for c in ("id", "row", "kept", "_t", "score"):
                clean = clean.withColumn(c, odd.schema[c].dataType.simpleString() and F.lit(None).cast(odd.schema[c].dataType))
            docs = df.unionByName(clean)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SMOKE)
            if name != "best_fit_packing":
                assert out.columns == docs.columns
                path = corpus_pipeline.Stage(spark, "test")
                docs = path.stage(out, name)
                ids = Counter(r.doc_id for r in docs.select("doc_id").collect())
                if df is odd:
                    if name == "quality_rules":
                        assert ids[50] == ids[51] == 1 and 2 not in ids
                    if name == "line_dedup":
                        assert ids[50] == 1 and 51 not in ids  # an exact copy has no line of its own
            else:
                assert out.count() >= (df is odd)
                assert defaultdict(int, Counter(out.columns))["sequence_id"] == 1
