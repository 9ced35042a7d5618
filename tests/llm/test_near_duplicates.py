import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from clicklake.llm import near_duplicates as nd
from clicklake.llm.common import WORD, WordHashes
from clicklake.llm.components import components
from tests.llm.helpers import as_rows, documents


def bag(text):
    words = WORD.findall(text.lower())
    width = min(5, len(words))
    return Counter(tuple(words[i : i + width]) for i in range(len(words) - width + 1)) if words else Counter()


def brute_classes(docs):
    """Smallest id of each connected component of all pairs with a weighted Jaccard similarity of 0.8."""
    bags = {i: bag(t) for i, t in docs.items() if t is not None}
    df = Counter(s for b in bags.values() for s in b)
    idf = lambda s: 1 + 0.5 * math.log(min(max(len(docs) / df[s], 1), 100)) / math.log(100)
    weight = {i: {s: n * idf(s) for s, n in b.items()} for i, b in bags.items()}
    parent = {i: i for i in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    held = defaultdict(list)
    for i, b in bags.items():
        for s in b:
            held[s].append(i)
    for i in bags:
        for j in {j for s in bags[i] for j in held[s] if j > i}:
            shared = sum(min(w, weight[j][s]) for s, w in weight[i].items() if s in weight[j])
            if shared >= nd.THRESHOLD * (sum(weight[i].values()) + sum(weight[j].values()) - shared) - 1e-9:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    first = {}
    for i, t in docs.items():
        if t is not None and not bags[i]:
            parent[i] = first.setdefault(t, i)
    return {i: root(i) for i in docs}


def edited(words, rate, draw):
    return [f"new{draw.random()}"[:9] if draw.random() < rate else w for w in words]


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_match_all_pairs(spark, seed):
    draw = random.Random(seed)
    texts = [None, None, "", "", " . ", "two words", "two words!", "two other", "x " * 300]
    for n in (8, 60, 200, 3000):
        base = ["".join(draw.choices("abcdefghij", k=4)) for _ in range(n)]
        texts.append(" ".join(base))
        for rate in (0.0, 0.002, 0.01, 0.02, 0.04, 0.1):
            texts += [" ".join(edited(base, rate, draw)).capitalize() for _ in range(4)]
    docs = documents(spark, *texts)
    expected = brute_classes(dict(enumerate(texts)))
    rows = nd.classes(docs).collect()
    got = {r["doc_id"]: r["class_id"] for r in rows}
    assert len(rows) == len(texts) and got == expected
    sizes = Counter(expected.values())
    assert all(r["class_size"] == sizes[r["class_id"]] for r in rows)
    kept = nd.distinct(docs)
    assert kept.columns == docs.columns
    assert as_rows(kept) == as_rows(docs.where(docs.doc_id.isin(sorted(set(expected.values())))))


def test_the_corpus_matches_all_pairs(spark):
    folder = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert {r["doc_id"]: r["class_id"] for r in nd.op8_near_duplicates(spark, folder).collect()} == brute_classes(docs)


def test_many_near_copies_are_split_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(nd, "SIDE", 8)
    draw = random.Random(9)
    base = ["".join(draw.choices("abcdefghij", k=4)) for _ in range(150)]
    texts = [" ".join(edited(base, draw.choice([0.01, 0.03, 0.06]), draw)) for _ in range(120)]
    expected = brute_classes(dict(enumerate(texts)))
    assert 1 < len(set(expected.values())) < 110
    assert {r["doc_id"]: r["class_id"] for r in nd.classes(documents(spark, *texts)).collect()} == expected


def test_repeated_and_null_ids(spark):
    text = "one two three four five six seven"
    rows = [(1, text), (1, text), (1, "quite another text with enough words in it"), (None, text), (None, "alone here, without any copy at all"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = as_rows(nd.classes(docs))
    own = {r[1] for r in got if r[1] and r[1] >= 1 << 62}
    assert len(own) == 2  # one of the two texts with id 1, and the one without an id
    assert Counter((r[0], r[2]) for r in got) == {(1, 3): 2, (None, 3): 1, (1, 1): 1, (None, 1): 2}
    assert len({r[1] for r in got}) == 4
    assert as_rows(nd.distinct(docs)) == sorted([rows[0], rows[2], rows[4], rows[5]], key=str)


def test_empty_table(spark):
    docs = documents(spark, "a").limit(0)
    assert nd.classes(docs).count() == 0 and nd.distinct(docs).count() == 0
    assert as_rows(nd.classes(documents(spark, None))) == [(0, 0, 1)]


def test_samples_agree_as_often_as_sets_are_similar():
    draw = np.random.default_rng(4)
    names = draw.integers(0, 1 << 62, 1000, np.uint64)
    common = np.sort(names[:100])
    weights = nd.Weights(common, np.full(100, 50), 100)
    one = np.sort(names[:700]), draw.integers(1, 4, 700)
    other = np.sort(names[200:1000]), draw.integers(1, 4, 800)
    left, right = (dict(zip(h.tolist(), weights(h) * c)) for h, c in (one, other))
    shared = sum(min(w, right[h]) for h, w in left.items() if h in right)
    truth = shared / (sum(left.values()) + sum(right.values()) - shared)
    a, b = nd.samples([one, other], weights)
    assert abs((a == b).mean() - truth) < 4 * math.sqrt(truth * (1 - truth) / len(a))


def test_lossy_counts_keep_their_bound():
    draw = np.random.default_rng(1)
    held, truth = nd.LossyCounts(0.01), Counter()
    for _ in range(30):
        sets = [np.unique(np.minimum(draw.geometric(0.02, 30), 400)).astype(np.uint64) for _ in range(100)]
        held.add(sets)
        truth.update(int(x) for s in sets for x in s)
    found = dict(zip(*(x.tolist() for x in held.frequent())))
    for name, count in truth.items():
        assert found.get(name, 0) <= count
        if count > 0.01 * 3000:
            assert found[name] >= count - 0.01 * 3000


def test_common_shingles_are_counted_exactly(spark):
    texts = [f"the same five words here but {i} differs from all others now" for i in range(150)] + ["quite alone is this text now"]
    weights = nd.common_shingles(documents(spark, *texts).repartition(3), len(texts))
    hashes = nd.shingle_set(texts[0], WordHashes())[0]
    df = Counter(s for t in texts for s in bag(t))
    expected = sorted(1 + 0.5 * math.log(min(len(texts) / df[s], 100)) / math.log(100) for s in bag(texts[0]))
    assert np.allclose(sorted(weights(hashes)), expected)


def test_block_similarities_equal_single_ones():
    texts = ["a b c d e f g a b c d e f g", "a b c d e f g h", "a b c d e f g a b c d e x", "q"]
    weights = nd.Weights(nd.shingle_set(texts[1], WordHashes())[0][:2], np.array([3, 4]), 4)
    sets = [nd.elements(t, weights) for t in texts]
    found = nd.similarities(sets[:2], sets)
    assert np.allclose(found, [[nd.similarity(a, b) for b in sets] for a in sets[:2]])
    assert found[0][0] == found[1][1] == 1


def test_components_match_a_search(spark):
    draw = random.Random(3)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1060)]
    got = dict(as_rows(components(spark.createDataFrame(edges, "a long, b long"))))
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    for start in near:
        seen, todo = {start}, [start]
        while todo:
            todo += [m for m in near[todo.pop()] if m not in seen and not seen.add(m)]
        assert got[start] == min(seen)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pairs_that_share_one_band_of_a_mixed_bucket_are_compared(spark, monkeypatch):
    """A hot bucket of unlike nodes, with planted copies that share no other band; also more nodes than a block holds."""
    monkeypatch.setattr(nd, "SIDE", 16)
    draw = np.random.default_rng(3)
    rows, copies = [], []
    for node in range(300):
        short = draw.integers(0, 1 << 16, nd.BANDS * nd.ROWS).astype(np.uint16)
        if node % 10 == 9:  # near the one before
            short[:48] = np.frombuffer(rows[-1][2], np.uint16)[:48]
            copies.append((node - 1, node))
        rows.append((node, [7, *(1000 + node * nd.BANDS + k for k in range(1, nd.BANDS))], short.tobytes()))
    found = nd.candidate_edges(spark.createDataFrame(rows, "node long, bands array<long>, short binary"))
    assert sorted({(min(r), max(r)) for r in found.collect()}) == copies
