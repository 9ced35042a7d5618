import zlib

import numpy as np
import pytest

from clicklake.llm import language_id as li
from clicklake.llm.common import mix
from tests.llm.helpers import as_rows, documents

WORDS = {
    "en": "the and of this that with from house water under light morning people".split(),
    "de": "der die und nicht über straße haus wasser licht morgen leute schön mit".split(),
    "fr": "le la et les être maison eau lumière matin gens avec très où".split(),
    "es": "el los y ser casa agua luz mañana gente con muy dónde niño".split(),
}
ODD = [None, "", " ", "12 34 ² !?", "é", "a", "THE Water!! 12 and... light", "\x00\x00the", "漢字 かな", "ⅷ ½", "the " * 3000, "İstanbul the"]


def texts(seed, count):
    draw = np.random.default_rng(seed)
    out = []
    for i in range(count):
        language = sorted(WORDS)[i % 4]
        out.append((" ".join(draw.choice(WORDS[language], draw.integers(3, 30))) + ".", language))
    return out


@pytest.fixture(scope="module")
def model():
    return li.fit(*zip(*texts(1, 200)))


def brute_margins(model, text):
    """Run by run, as the module's docstring says."""
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    if not words:
        return None
    codes = [ord(c) for c in " " + " ".join(words) + " "]
    total, count = np.zeros(model.weights.shape[1]), 0
    for i in range(len(codes)):
        hashed = 0
        for k in range(min(li.ORDERS, len(codes) - i)):
            value = int(mix(np.array([codes[i + k]], np.uint64))[0]) & 0xFFFFFFFF
            hashed = ((hashed ^ value) * 0x9E3779B1) & 0xFFFFFFFF
            place = (((hashed ^ (hashed >> 15)) * 0x85EBCA6B) & 0xFFFFFFFF) >> (32 - 13)
            total += model.weights[place]
            count += 1
    return (total / count * li.SCALE + li.BIAS * model.weights[-1]) / li.UNIT


@pytest.mark.parametrize("window", [5, 1 << 17])
def test_margins_match_a_run_by_run_sum(model, monkeypatch, window):
    monkeypatch.setattr(li, "WINDOW", window)
    some = [t for t in ODD if not t or len(t) < 500] + [t for t, _ in texts(2, 12)]
    margins, lettered = model.margins(some)
    for text, row, there in zip(some, margins, lettered):
        expected = brute_margins(model, text)
        assert there == (expected is not None)
        if there:
            assert np.allclose(row, expected)


def test_frequencies_are_those_of_the_margins(model):
    some = [t for t, _ in texts(3, 8)] + ["a"]
    weights = np.delete(model.weights, li.DIMENSIONS, axis=0)
    assert np.allclose(li.frequencies(some) @ weights / li.UNIT, model.margins(some)[0], atol=1e-4)


def test_answers_do_not_depend_on_the_batch(model):
    some = [*ODD, *(t for t, _ in texts(4, 20))]
    names, scores = model.predict(some)
    single = [model.predict([t]) for t in some]
    assert names == [n[0] for n, _ in single] and scores.tolist() == [s[0] for _, s in single]
    assert ((scores >= 0) & (scores <= 1)).all()
    assert [n for t, n in zip(some, names) if not any(c.isalpha() for c in t or "")] == ["und"] * 5
    assert "und" not in [n for t, n in zip(some, names) if any(c.isalpha() for c in t or "")]


def test_family_first_then_pairs_within_it(model):
    assert model.families == [["de", "en"], ["es", "fr"]] and model.pairs == [("de", "en"), ("es", "fr")]
    names, _ = model.predict([t for t, _ in texts(5, 200)])
    assert np.mean([n == x for n, (_, x) in zip(names, texts(5, 200))]) > 0.97
    # three of one family vote pair by pair; a language that no family names stands alone
    three = li.fit(["aa bb", "cc dd", "ee ff", "gg hh"] * 5, ["ro", "es", "fr", "tlh"] * 5)
    assert three.families == [["es", "fr", "ro"], ["tlh"]] and len(three.pairs) == 3
    assert three.predict(["aa", "cc", "ee", "gg"])[0] == ["ro", "es", "fr", "tlh"]


def test_few_languages(spark):
    assert li.fit([], []).predict(["a", None]) [0] == ["und", "und"]
    assert li.fit(["x y"], ["fr"]).predict(["any", "1"])[0] == ["fr", "und"]


def crc(key):
    return zlib.crc32(("" if key is None else str(key)).encode()) % 4


def test_query_on_odd_rows(spark, tmp_path):
    known = texts(6, 240)
    rows = [(i, t, x, "s", 1) for i, (t, x) in enumerate(known)]
    rows += [(1000 + i, t, None if i % 2 else "", "s", 1) for i, t in enumerate(ODD)]
    rows += [(None, "the people and the light", None, None, None), (3, "le matin et la maison", "fr", "s", 1)]
    # held-out labels are wrong on purpose: whoever learned from them would answer "xx"
    rows = [(k, t, "xx" if crc(k) == 2 and x else x, s, n) for k, t, x, s, n in rows]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string, held_out int").repartition(3)
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    got = li.op11_language_id(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    assert all(r.held_out == (crc(r.doc_id) == 2) for r in got)
    right = [r.lang_pred == known[r.doc_id][1] for r in got if r.doc_id is not None and r.doc_id < 240 and r.held_out]
    assert len(right) > 30 and np.mean(right) > 0.95
    assert {r.lang_pred for r in got} == {"de", "en", "es", "fr", "und"}
    learned = [(t, x) for k, t, x, *_ in rows if x and crc(k) != 2]
    assert len(learned) < li.LABELLED
    frame.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert as_rows(li.op11_language_id(spark, str(tmp_path / "none"))) == []


def test_training_is_bounded_and_even(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(li, "fit", lambda t, x, families: seen.update(texts=t, languages=x))
    docs = documents(spark, *[f"text {i}" for i in range(400)]).selectExpr("doc_id", "text", "if(doc_id % 20 = 0, 'fr', 'en') lang")
    li.train(docs, limit=24)
    assert len(seen["texts"]) == 24 and 10 <= seen["languages"].count("fr") <= 12
