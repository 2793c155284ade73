"""The pipeline's stages on a small table: each keeps its contract and its decisions take effect."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from chronoweave.llm import store
from chronoweave.llm.store import settle


#: Names that stages might give to columns of their own.
CLASHING = ["extra", "pieces", "findings", "_found", "_copies", "_copy", "_row", "_more", "_did", "_k1", "_lang_pred", "_LANG_SCORE", "rank", "size", "source_size", "target", "copies", "length"]


@pytest.fixture(scope="module")
def docs(spark, small):
    table = spark.read.parquet(f"{small}/documents.parquet")
    key = "4f9d1c0e7ab35268f1e09b7dd8c4a6355e2f7b10"
    odd = [(10**6, None, "en", "src0", 0), (10**6 + 1, "", None, None, 0), (10**6 + 2, f'The token = "{key}" of the thing and that with it', "en", None, 60), (10**6 + 3, "### 123", "en", "src1", 7)]
    return table.unionByName(spark.createDataFrame(odd, table.schema)).unionByName(table.limit(3)).withColumns({c: F.concat(F.lit("own "), "doc_id") for c in CLASHING})


def test_stages(spark, docs, small):
    held, counts = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = held
        held = settle(stage(spark, before, small), name)
        assert held.columns == docs.columns
        assert held.filter(" or ".join(f"`{c}` <> concat('own ', doc_id)" for c in CLASHING)).count() == 0
        counts[name] = (before, held)
    before, after = counts["language_id"]
    gone = {r.doc_id for r in before.join(after, "doc_id", "left_anti").collect()}
    assert gone == {10**6, 10**6 + 1, 10**6 + 3}
    before, after = counts["near_dedup"]
    assert after.count() == after.select("doc_id").distinct().count() <= before.select("doc_id").distinct().count()
    _, after = counts["secret_scan"]
    assert "[SECRET]" in after.filter(f"doc_id = {10**6 + 2}").first().text
    assert after.filter("n_chars <> length(text)").count() == 0
    before, after = counts["mixing"]
    assert max(Counter(r.doc_id for r in after.collect()).values()) <= 2
    packed = corpus_pipeline.STAGES[-1][1](spark, held, small)
    assert packed.filter("piece = 0").count() == held.count()
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 4096").count() == 0


def test_near_duplicates_by_brute_force(spark, small):
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i * 7 % 26)}" for i in range(400)]
    # Each change of one word takes five shingles of 196: 4 leave 176 of 216 alike, 5 leave 171 of 221.
    texts = []
    for n in range(8):
        own = words[n * 25 : n * 25 + 200]
        texts.append(own)
        texts.append([f"x{n}" if i in range(10, 10 + 20 * (n + 1), 20) else w for i, w in enumerate(own)])
    rows = [(i, " ".join(t), "en", "src0", 0) for i, t in enumerate(texts)]
    sets = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in texts]
    alike = lambda a, b: len(a & b) / len(a | b)
    assert any(0.8 <= alike(a, b) < 0.85 for a in sets for b in sets)
    least = list(range(len(rows)))
    for _ in rows:
        least = [min(least[j] for j in range(len(rows)) if alike(sets[i], sets[j]) >= 0.8) for i in range(len(rows))]
    table = spark.read.parquet(f"{small}/documents.parquet")
    kept = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, table.schema), small)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least))


def test_empty(spark, docs, small):
    held = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        held = stage(spark, held, small)
    assert held.count() == 0


def test_clear(spark):
    df = settle(spark.range(3), "three")
    assert df.count() == 3 and store._MADE
    path = df.inputFiles()[0].removeprefix("file://")
    store.clear(spark)
    assert not os.path.exists(path) and not store._MADE
