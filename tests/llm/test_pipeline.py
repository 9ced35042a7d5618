"""The pipeline against its stages' rules, worked out in plain Python on the smallest tables."""

import random
from collections import Counter

import corpus_pipeline
from clicklake.llm import decontamination, quality
from clicklake.llm.common import stored
from tests.llm.helpers import as_rows, documents
from tests.llm.test_mixing import WORD
from tests.llm.test_near_duplicates import brute_classes
from tests.llm.test_token_files import expected, tokenizer  # noqa: F401

FOLDER = "/root/testdata/sf0.001"


def test_every_stage_by_brute_force(spark, tokenizer):  # noqa: F811
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, after = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, FOLDER), name)
        after[name] = docs
        if name != "token_output":
            assert docs.columns == columns
    start = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    items = [r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]

    net = quality.train(spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet"))
    good = {i: t for i, t in start.items() if round(float(net.scores([t])[0]), 4) >= 0.3}
    assert sorted(r["doc_id"] for r in after["quality_filter"].collect()) == sorted(good)

    classes = brute_classes(good)
    single = {i: t for i, t in good.items() if classes[i] == i}
    assert dict(as_rows(after["near_dedup"], "doc_id", "text")) == single and 0 < len(single) < len(good)

    clean = {}
    for i, text in single.items():
        held = set(decontamination.shingles(text))
        if not any(w and len(w & held) >= 0.8 * len(w) for w in (set(decontamination.shingles(x)) for x in items)):
            clean[i] = text
    assert dict(as_rows(after["decontaminate"], "doc_id", "text")) == clean and len(clean) < len(single)

    mixed = after["mix_sources"].collect()
    size = {i: len(WORD.findall(t)) for i, t in clean.items()}
    taken = Counter()
    for r in mixed:
        taken[r["doc_id"]] += len(WORD.findall(r["text"]))
    assert all(n <= 3 * size[i] for i, n in taken.items())
    assert abs(sum(taken.values()) - sum(size.values())) <= 0.03 * sum(size.values())

    got = after["token_output"].orderBy("start").collect()
    wanted = expected(tokenizer, [(r["doc_id"], r["text"]) for r in mixed])
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == sorted((r[0], r[2], r[3]) for r in wanted)
    assert [r["doc_id"] for r in got] == sorted(r["doc_id"] for r in got)


def test_run_is_repeatable(spark):
    first = as_rows(corpus_pipeline.run(spark, FOLDER))
    assert first and as_rows(corpus_pipeline.run(spark, FOLDER)) == first


def test_odd_rows_pass_every_stage(spark):
    draw = random.Random(1)
    words = lambda n: " ".join("".join(draw.choices("etaoinshr", k=5)) for _ in range(n))
    docs = documents(spark, None, "", words(40), words(40), words(3000), "x", sources=["a", None, "a", None, "b", "b"])
    docs = docs.unionAll(docs.where("doc_id in (1, 2)"))
    for table_ in (docs, docs.limit(0)):
        held = table_
        for name, stage in corpus_pipeline.STAGES[1:]:
            held = stored(stage(spark, held, FOLDER), name)
        assert held.count() == 0 or {r["doc_id"] for r in held.collect()} <= {2, 3, 4, 5}


def test_quality_filter_takes_odd_rows(spark):
    docs = documents(spark, None, "", "same words here", "same words here", "x" * 50_000, "### %%%").selectExpr(
        "nullif(doc_id, 3) doc_id", "text", "lang", "source", "n_chars", "1 AS score", "true AS held_out", "'q' AS quality"
    )
    docs = docs.unionAll(docs.where("doc_id in (1, 2)"))
    kept = corpus_pipeline.quality_filter(spark, docs, FOLDER)
    assert kept.schema == docs.schema
    held, all_rows = Counter(as_rows(kept)), Counter(as_rows(docs))
    assert not held - all_rows
    # equal texts are judged alike, whatever their id
    by_text = {}
    for row, n in all_rows.items():
        by_text.setdefault(row[1], set()).add(held[row] == n)
    assert all(len(judged) == 1 for judged in by_text.values())
    assert corpus_pipeline.quality_filter(spark, docs.limit(0), FOLDER).count() == 0
