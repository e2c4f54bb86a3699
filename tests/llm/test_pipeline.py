from __future__ import annotations

from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from depotline.llm import quality
from depotline.session import RUNTIME_SETTINGS, store
from test_jaccard import brute as brute_components
from test_packing import check as check_packing
from test_secrets import brute as brute_spans


def masked(text, spans):
    """Spans of all rules replaced; only the base rules are known here, so others must not occur in the text."""
    out, at = "", 0
    for start, _, _, end in spans:
        out += text[at:start] if start >= at else ""
        out += "[REDACTED]" if start >= at else ""
        at = max(at, end)
    return out + text[at:]


def test_stages_equal_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    planted = F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit("\nsecret: "), F.md5(F.col("doc_id").cast("string")))).otherwise(F.col("text"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("text", planted).withColumn("n_chars", F.length("text").cast("long"))
    columns = docs.columns
    rows = {r.doc_id: r for r in docs.collect()}

    good = store(corpus_pipeline.keep_good(spark, docs, sf_dir), "t")
    assert good.columns == columns and all(rows[r.doc_id] == r for r in good.collect())
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = {r.doc_id for r in good.collect()}
    right = [(i in kept) == (q == 1) for i, q in labels.items()]
    assert sum(right) / len(right) > 0.95 and sum(i in kept for i, q in labels.items() if q == 1) >= 0.97 * sum(labels.values())
    scored = quality.score(docs, quality.fit(docs, quality.learnable(spark.read.parquet(f"{sf_dir}/labels.parquet"))))
    assert kept == {r.record.doc_id for r in scored.collect() if r.score >= 0.7}

    single = store(corpus_pipeline.keep_one_of_each_group(spark, good, sf_dir), "t")
    groups = brute_components([(i, rows[i].text) for i in sorted(kept)])
    assert single.columns == columns
    assert Counter(r.doc_id for r in single.collect()) == Counter({i for i, n, c in groups if n == 0 or c == i})

    clean = store(corpus_pipeline.mask_secrets(spark, single, sf_dir), "t")
    assert clean.columns == columns and clean.count() == single.count()
    changed = 0
    for r in clean.collect():
        before = rows[r.doc_id]
        spans = brute_spans(before.text)
        if not spans and r.text != before.text:
            assert "[REDACTED]" in r.text  # a rule beyond the base
        elif "://" not in before.text:
            assert r.text == masked(before.text, spans) and r.n_chars == len(r.text)
        changed += r.text != before.text
    assert changed

    texts = [(r.doc_id, r.text) for r in clean.collect()]
    check_packing(corpus_pipeline.pack(spark, clean, sf_dir).collect(), texts)


def test_run_is_the_stages_and_takes_empty_tables(spark, table):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    sf_dir = table([(1, "a b c"), (2, "A b c"), (3, "token=abcdef1 d"), (4, None)], labels=labels)
    pieces = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in pieces) == [1, 3, 4]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "secrets", "packing"]


def test_run_on_nothing(spark, table):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert corpus_pipeline.run(spark, table([], labels=labels)).collect() == []


def test_killed_run_resumes(spark, table, monkeypatch):
    """The third stage fails; a restart under the same name builds neither of the first two again, one without a name all."""
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    sf_dir = table([(1, "a b c"), (2, "A b c"), (3, "token=abcdef1 d"), (4, None)], labels=labels)
    plain = sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect()))
    built = []

    def noting(name, stage):
        def run(spark, docs, sf_dir):
            built.append(name)
            if name == "secrets" and built.count(name) == 1:
                raise RuntimeError("killed")
            return stage(spark, docs, sf_dir)

        return run

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(name, noting(name, stage)) for name, stage in corpus_pipeline.STAGES])
    with pytest.raises(RuntimeError, match="killed"):
        corpus_pipeline.run(spark, sf_dir, corpus_pipeline.resumable(spark, sf_dir, "pipeline-test"))
    job = corpus_pipeline.resumable(spark, sf_dir, "pipeline-test")
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir, job).collect())) == plain
    assert built == ["quality", "near_duplicates", "secrets", "secrets", "packing"]
    assert job.close()
    corpus_pipeline.run(spark, sf_dir)
    assert built[5:] == ["quality", "near_duplicates", "secrets", "packing"]


@pytest.mark.parametrize("place", range(4))
def test_stages_called_alone_run_under_the_runtime_settings(spark, tmp_path, place):
    words = "the depot keeps its stock in order and the night train brings more".split()
    rows = [(i, " ".join(words[(i + j) % len(words)] for j in range(20 + i)), "depot") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    for key in ("spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize"):
        spark.conf.unset(key)
    try:
        corpus_pipeline.STAGES[place][1](spark, docs, str(tmp_path)).collect()
        assert {key: spark.conf.get(key) for key in RUNTIME_SETTINGS} == RUNTIME_SETTINGS
    finally:
        for key, value in RUNTIME_SETTINGS.items():
            spark.conf.set(key, value)
