import random

import pytest

from clicklake.llm import decontamination as d
from tests.llm.helpers import as_rows, documents

ITEMS = "item_id long, text string"


def words(n, seed):
    draw = random.Random(seed)
    return ["".join(draw.choices("abcdefghij", k=5)) for _ in range(n)]


def brute(texts, items):
    found = []
    for i, text in enumerate(texts):
        for j, item in enumerate(items):
            width = min(5, len(d.WORD.findall((item or "").lower())))
            wanted = set(d.shingles(item, width)) if width else set()
            held = set(d.shingles(text, width)) if width else set()
            if wanted and len(wanted & held) >= 0.8 * len(wanted):
                found.append((i, j, len(wanted & held), len(wanted), len(wanted & held) / len(wanted)))
    return sorted(found, key=str)


def test_items_are_found_whatever_the_sizes(spark):
    items = [" ".join(words(n, n)) for n in (5, 6, 12, 13, 40, 70, 300)] + ["too short here", "", None]
    texts = []
    for i, item in enumerate(items[:7]):
        for length in (0, 30, 3000):
            around = words(length, 1000 + i)
            cut = random.Random(i).randrange(length + 1)
            texts.append(" ".join([*around[:cut], item.upper(), *around[cut:]]))
    part = items[4].split()
    texts += [" ".join(part[:36]), " ".join(part[:20]), "too short here", "", None, items[0], items[0]]
    expected = brute(texts, items)
    assert len(expected) > 22
    got = d.find(documents(spark, *texts), spark.createDataFrame(list(enumerate(items)), ITEMS))
    assert as_rows(got) == expected


def test_tables_of_this_corpus(spark):
    folder = "/root/testdata/sf0.001"
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    wanted = {r["item_id"]: r["text"] for r in items.collect()}
    keys, names = list(texts), list(wanted)
    expected = [(keys[i], names[j]) for i, j, *_ in brute(list(texts.values()), list(wanted.values()))]
    assert as_rows(d.op2_decontamination(spark, folder), "doc_id", "item_id") == sorted(expected, key=str)


def test_more_items_than_a_block_holds(spark, monkeypatch):
    monkeypatch.setattr(d, "ITEM_BLOCK", 2)
    items = [" ".join(words(20, n)) for n in range(7)]
    got = d.find(documents(spark, *items), spark.createDataFrame(list(enumerate(items)), ITEMS))
    assert as_rows(got, "doc_id", "item_id") == [(i, i) for i in range(7)]


@pytest.mark.parametrize("text", ["a b c d e f g", None])
def test_empty_tables(spark, text):
    none = spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, text)], ITEMS)
    docs = documents(spark, text)
    assert d.find(docs, none).count() == 0
    assert d.find(docs.limit(0), some).count() == 0
    assert as_rows(d.remove(docs, none)) == as_rows(docs)


def test_remove_keeps_clean_rows_with_all_columns(spark):
    item = " ".join(words(20, 1))
    docs = documents(spark, f"x {item} y", None, "", "clean text of a few words more", item.lower(), "clean text of a few words more")
    got = d.remove(docs, spark.createDataFrame([(1, item), (2, None)], ITEMS))
    assert got.schema == docs.schema
    assert as_rows(got) == as_rows(docs.where("doc_id in (1, 2, 3, 5)"))


def test_items_of_few_words_are_never_missed():
    items = [" ".join(words(5 + n % 2, 50_000 + n)) for n in range(2000)]
    texts = [" ".join([item, *words(24, n)]) for n, item in enumerate(items)]
    assert [p[:2] for p in d.ItemIndex(items).matches(texts, d.THRESHOLD)] == [(n, n) for n in range(2000)]


def test_items_of_one_to_four_words_are_found(spark):
    items = ["alpha", "Beta gamma", "delta-epsilon zeta", "one two three four", "one two", "!?", "absent word", "word"]
    texts = ["before alpha after", "ALPHA", "beta  gamma", "beta, x gamma", "a delta epsilon zeta b c d e f", "one two three four five", "one", "", None]
    expected = brute(texts, items)
    assert {(i, j) for i, j, *_ in expected} == {(0, 0), (1, 0), (2, 1), (4, 2), (5, 3), (5, 4)}
    got = d.find(documents(spark, *texts), spark.createDataFrame(list(enumerate(items)), ITEMS))
    assert as_rows(got) == expected
    kept = d.remove(documents(spark, *texts), spark.createDataFrame(list(enumerate(items)), ITEMS))
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 6, 7, 8]


def test_blocks_of_items_are_removed_one_after_the_other(spark, monkeypatch):
    monkeypatch.setattr(d, "ITEM_BLOCK", 2)
    items = [" ".join(words(20, n)) for n in range(7)]
    docs = documents(spark, *items, "a clean text of six words", None)
    kept = d.remove(docs, spark.createDataFrame(list(enumerate(items)), ITEMS))
    assert as_rows(kept) == as_rows(docs.where("doc_id >= 7"))
