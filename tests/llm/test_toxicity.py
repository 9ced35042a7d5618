import random

import numpy as np
import pytest

from clicklake.llm import toxicity as t
from tests.llm.helpers import documents

LABELS = "doc_id long, quality int, toxic int"


def corpus(n, seed):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        words = ["".join(draw.choices("etaoinshrd", k=4)) for _ in range(draw.randint(10, 200))]
        toxic = int(i % 4 == 0)
        if toxic:
            words[:: max(1, len(words) // 4)] = [draw.choice(t.INSULTS + t.CONTEMPT) for _ in words[:: max(1, len(words) // 4)]]
        out.append((" ".join(words), toxic))
    return out


def fitted(rows):
    marks = np.array([t.mark_categories(text, toxic) for text, toxic in rows], float)
    return t.fit([t.distinct_words(text) for text, _ in rows], marks, t.CATEGORIES, np.arange(len(rows)) % t.FOLDS)


@pytest.fixture(scope="module")
def chain():
    return fitted(corpus(400, 0))


def test_unseen_toxic_documents_are_caught(chain):
    rows = corpus(400, 1)
    found = chain.probabilities([text for text, _ in rows])[:, -1] >= t.THRESHOLD
    truth = np.array([toxic for _, toxic in rows], bool)
    assert found[truth].mean() > 0.95 and found[~truth].mean() < 0.02


def test_each_link_sees_the_probabilities_before_it(chain):
    assert [len(d) for d in chain.dense] == [1, 2, 3]
    text = [f"{t.INSULTS[0]} word {t.CONTEMPT[1]}"]
    linear, got = chain.linear(text)[0], chain.probabilities(text)[0]
    expected = []
    for j, dense in enumerate(chain.dense):
        expected.append(float(t.probability(linear[j] + dense[0] + np.dot(dense[1:], expected))))
    assert np.allclose(got, expected)


def test_links_learn_from_out_of_fold_predictions():
    """With labels by chance, a link that saw its training predictions would trust them; unseen ones are worth nothing."""
    draw = random.Random(5)
    words = [{"".join(draw.choices("abcdefgh", k=6)) for _ in range(20)} | {f"common{i}" for i in range(3)} for i in range(300)]
    chance = np.array([[draw.randint(0, 1)] * 2 for _ in words], float)
    rare, t_rare = t.RARE, 1
    t.RARE = t_rare
    try:
        out = t.fit(words, chance, ["first", "second"], np.arange(300) % t.FOLDS)
    finally:
        t.RARE = rare
    assert abs(out.dense[1][1]) < 5


def test_word_sums_equal_feature_sums(chain):
    text = "idiot idiots plain Idiot! other"
    held = t.distinct_words(text)
    total = sum((chain.weights.get(f, np.zeros(3)) for w in held for f in t.features(w)), np.zeros(3))
    assert np.allclose(chain.linear([text])[0], total / len(held) ** 0.5, atol=1e-4)


def test_held_out_documents_of_the_corpus(spark):
    folder = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{folder}/documents.parquet").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    train = [(r["text"], r["toxic"]) for r in rows if r["doc_id"] % 3]
    test = [(r["text"], r["toxic"]) for r in rows if r["doc_id"] % 3 == 0]
    scores = fitted(train).probabilities([x for x, _ in test])[:, -1]
    bad, good = ([s for s, (_, y) in zip(scores, test) if y == k] for k in (1, 0))
    assert np.mean([a > b for a in bad for b in good]) > 0.8


def test_query_scores_every_document(spark):
    folder = "/root/testdata/sf0.001"
    got = t.op3_toxicity(spark, folder)
    assert got.columns == ["doc_id", "p_insult", "p_contempt", "p_toxic", "toxic"]
    rows = got.collect()
    assert len(rows) == 200 and all(r["toxic"] == (r["p_toxic"] >= t.THRESHOLD) for r in rows)


def test_odd_rows(spark, chain):
    texts = [None, "", "...", "idiot", "idiot", "clean words " * 100_000]
    docs = documents(spark, *texts).selectExpr("nullif(doc_id, 5) doc_id", "text", "size toxic", "key p_toxic")
    rows = {r["doc_id"]: r for r in t.score(docs, chain).collect()}
    assert rows[0]["p_toxic"] == rows[1]["p_toxic"] == rows[2]["p_toxic"]
    assert rows[3]["p_toxic"] == rows[4]["p_toxic"] and rows[3]["toxic"] and not rows[None]["toxic"]
    assert t.score(docs.limit(0), chain).count() == 0


def test_labels_of_one_kind_or_none(spark):
    docs = documents(spark, "a b", "c d")
    for rows, share in (([], 0.5), ([(0, 1, 1), (1, 1, 1), (1, None, None), (None, 1, 1)], 1.0)):
        chain = t.train(docs, spark.createDataFrame(rows, LABELS))
        assert {round(r["p_toxic"], 3) for r in t.score(docs, chain).collect()} == {share}
