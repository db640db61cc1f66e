"""Quality classifier: held-out accuracy, determinism, calibration and odd inputs."""

import zlib

import numpy as np

from clauselens.llm import quality_classifier as Q
from clauselens.llm.queries import QUERIES


def labels_of(spark, folder):
    return {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in QUERIES["op7_quality_classifier"](spark, folder).collect()}
    known = labels_of(spark, folder)
    assert len(rows) == 1000
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    for label in (0, 1):
        held = [rows[i].predicted == label for i, y in known.items() if y == label and rows[i].held_out]
        assert len(held) > 5 and np.mean(held) >= 0.95
    again = {r.doc_id: r.score for r in QUERIES["op7_quality_classifier"](spark, folder).collect()}
    assert again == {i: r.score for i, r in rows.items()}


def test_held_out_labels_do_not_matter(spark, sf, docs):
    known = spark.read.parquet(f"{sf}/labels.parquet")
    turned = known.withColumn("quality", Q.F.when(Q.held_out(Q.F.col("doc_id")), 1 - Q.F.col("quality")).otherwise(Q.F.col("quality")))
    a, b = ({r.doc.doc_id: r.score for r in Q.score_quality(docs, k, keep=["doc_id"]).collect()} for k in (known, turned))
    assert a == b


def test_tokens_are_words_with_their_shape():
    word, shape, document = Q.tokens([b"The the THE", b"", b" \n", "été été&&& 12".encode()])
    assert document.tolist() == [0, 0, 0, 3, 3, 3]
    assert word[0] == word[1] == word[2] and word[3] == word[4] != word[5]
    assert len({*shape[:3].tolist()}) == 3 and shape[3] != shape[4]
    assert word.min() >= Q.SHAPES > shape.max()


def test_contexts_are_sums_of_neighbours():
    index = Q.index_vectors()
    sums = np.zeros((Q.SLOTS, Q.DIM))
    Q.count_contexts([b"ab cd ab", b"cd"], index, sums)
    word, shape, _ = Q.tokens([b"ab cd ab", b"cd"])
    expected = np.zeros_like(sums)
    for a, b in ((0, 1), (1, 2)):
        expected[word[a]] += index[word[b]]
        expected[word[b]] += index[word[a]]
        expected[shape[a]] += index[shape[b]]
    for w, s in zip(word, shape):
        expected[w] += index[s]
        expected[s] += index[w]
    assert np.allclose(sums, expected)


def test_temperature_makes_probabilities_honest():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 6))
    y = (rng.random(3000) < Q.sigmoid(2 * x[:, 0])).astype(int)
    net = Q.train(x, y)
    p = net.score(rng.normal(size=(1, 6)).repeat(3, 0))
    assert np.ptp(p) == 0
    scores = net.score(x)
    for lo in (0.2, 0.5, 0.7):
        part = (scores > lo) & (scores < lo + 0.15)
        assert abs(scores[part].mean() - y[part].mean()) < 0.1


def test_cases(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    one = spark.createDataFrame([(0, 1), (0, 1), (None, 0), (2, None), (99, 0)], "doc_id long, quality int")
    for labels, expected in ((none, 0.5), (one, None)):
        rows = Q.score_quality(odd_docs, labels).collect()
        assert len(rows) == 13 and all(0 <= r.score <= 1 for r in rows)
        assert expected is None or {round(r.score, 6) for r in rows} == {expected}
    assert Q.score_quality(no_docs, one).collect() == []


def test_repeated_documents_teach_once(spark, sf, docs):
    """Every document 8 times, in any order: the same model, with more labels than the sample holds."""
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    some = docs.where("doc_id < 120").select("doc_id", "text")
    often = some.crossJoin(spark.range(8)).drop("id")
    models = [Q.fit(d, labels, most=20) for d in (often.orderBy("doc_id"), often.orderBy(Q.F.xxhash64("text")), often.repartition(5))]
    for vectors, prior, net in models[1:]:
        assert np.array_equal(vectors, models[0][0]) and np.array_equal(prior, models[0][1]) and np.array_equal(net.w1, models[0][2].w1)
