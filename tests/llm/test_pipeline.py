"""The pipeline: each stage against its operator and plain versions, and odd inputs."""

import corpus_pipeline as C
import pytest
from test_mixing import count, plain_mix
from test_pairs import brute_classes
from test_row_operators import brute_hits

from clauselens.llm import quality_classifier, sharding


@pytest.fixture(scope="module")
def results(spark, sf, docs, tmp_path_factory):
    """Each stage's input and result, written and read as run() does."""
    folder, out = tmp_path_factory.mktemp("stages"), []
    for n, (_, stage) in enumerate(C.STAGES):
        stage(spark, docs, sf).write.parquet(f"{folder}/{n}")
        result = spark.read.parquet(f"{folder}/{n}")
        out.append((docs, result))
        docs = result
    return out


def ids(frame):
    return sorted(r.doc_id for r in frame.select("doc_id").collect())


def test_columns(results):
    for before, after in results[:-1]:
        assert after.columns == before.columns and after.dtypes == before.dtypes
    assert results[-1][1].columns == [*results[-1][0].columns, "slot", "shard"]


def test_quality(spark, sf, results):
    before, after = results[0]
    scores = quality_classifier.score_quality(before, spark.read.parquet(f"{sf}/labels.parquet"), keep=["doc_id"]).collect()
    assert ids(after) == sorted(r.doc.doc_id for r in scores if r.score >= 0.5)
    bad = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 0").collect()}
    good = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").collect()}
    assert len(bad & set(ids(after))) <= 0.1 * len(bad) and len(good - set(ids(after))) <= 0.02 * len(good)


def test_near_duplicates(results):
    before, after = results[1]
    texts = {r.doc_id: r.text for r in before.collect()}
    assert ids(after) == sorted(i for i, (c, _) in brute_classes(texts).items() if c == i)


def test_decontamination(spark, sf, results):
    before, after = results[2]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    hits = {r.doc_id: brute_hits(r.text, items) for r in before.collect()}
    assert ids(after) == sorted(i for i, (n, h, _) in hits.items() if not (h and 20 * h >= n))


def test_mixing_and_sharding(results):
    before, after = results[3]
    rows = before.select("doc_id", "source", "text").collect()
    sizes = {r.doc_id: count(r.text) for r in rows}
    served = plain_mix([(r.doc_id, r.source, r.text) for r in rows])
    assert ids(after) == sorted(i for (i, _), words in served.items() if 2 * words > sizes[i])
    last = results[4][1].collect()
    owners = sharding.fill_table(C.SHARD_NAMES)
    assert len(last) == after.count() and all(r.shard == C.SHARD_NAMES[owners[r.slot]] for r in last)


def test_run(spark, sf, results):
    rows = C.run(spark, sf)
    assert sorted(map(repr, rows.collect())) == sorted(map(repr, results[-1][1].collect()))


def test_cases(spark, sf, odd_docs, no_docs):
    docs = odd_docs.withColumnRenamed("slot", "shard")
    for docs in (docs, no_docs):
        for name, stage in C.STAGES:
            result = stage(spark, docs, sf)
            rows = result.collect()
            if name == "near duplicates" and rows:
                kept = [r.doc_id for r in rows]
                assert kept.count(5) == 1 and kept.count(None) == 2 and 1 not in kept and 9 not in kept and 6 not in kept and 4 not in kept
                assert {0, 2, 3, 7, 8} <= set(kept)
            if name != C.STAGES[-1][0]:
                assert result.columns == docs.columns
        assert len(rows) == docs.count()


def test_one_row_of_an_id_in_any_order(spark, sf):
    rows = [(1, "one text", "b"), (1, "another text", "a"), (1, "one text", "a"), (2, "alone", "x"), (2, "alone", "x"), (None, "no id", "y")]
    kept = []
    for part in (rows, rows[::-1]):
        docs = spark.createDataFrame(part, "doc_id long, text string, source string")
        kept.append(sorted(map(tuple, C.near_duplicates(spark, docs, sf).collect()), key=repr))
    assert kept[0] == kept[1] and len(kept[0]) == 3 and (2, "alone", "x") in kept[0]
    assert kept[0][0] in [(1, "one text", "a"), (1, "another text", "a")]
