import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from clicklake.llm import fill_in_middle as fim
from clicklake.llm.common import byte_slices, text_bytes, text_column
from tests.llm.helpers import as_rows, documents

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
ODD = [
    None, "", " ", " \n\t", "a", " a", "a ", "a  b", "one two three four five", "tail \r\n", "é 漢字  x 😀", "a <P> b", "a <S> b c",
    "x<M>", "<P", "<", "<X> a <p>", "P> S> M>", "< P> <S", "\x1c a \x85 b", "word " * 5000, "x" * 9000, "one two three four five",
]


def brute(key, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    parts = ["".join(units[:a]), "".join(units[a:b]), "".join(units[b:])]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return len(units), "spm", len(parts[0]), len(parts[1]), f"<S>{parts[2]}<P>{parts[0]}<M>{parts[1]}"
    return len(units), "psm", len(parts[0]), len(parts[1]), f"<P>{parts[0]}<S>{parts[2]}<M>{parts[1]}"


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


@pytest.fixture(params=[7, 1 << 20])
def window(monkeypatch, request):
    monkeypatch.setattr(fim, "WINDOW", request.param)


def test_scatter_and_gather_match_plain_strings(window):
    draw = random.Random(3)
    texts = ["".join(draw.choices([" ", "\n", "a", "bc", "é", "😀", "<", "P>", "S>"], k=draw.randrange(12))) for _ in range(300)]
    texts = [t if not any(m in t for m in ("<P>", "<S>", "<M>")) else "" for t in texts]
    data, offsets = text_bytes(pa.array(texts))
    units = fim.Units(data, offsets)
    cut = [UNIT.findall(t) for t in texts]
    assert units.count.tolist() == [len(u) for u in cut]
    ends = np.sort([[draw.randrange(len(u) + 1) for u in cut] for _ in range(2)], axis=0)
    form = np.array([draw.randrange(3) for _ in texts])
    cuts = np.column_stack([units.cut(e) for e in ends])
    out, places = fim.scatter(data, offsets, cuts, form)
    expected = []
    for u, a, b, f in zip(cut, *ends, form):
        p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
        expected.append([p + m + s, f"<P>{p}<S>{s}<M>{m}", f"<S>{s}<P>{p}<M>{m}"][f])
    assert text_column(out, places).to_pylist() == expected
    assert text_column(*fim.gather(out, places, form)).to_pylist() == texts


def test_outputs_without_their_markers_are_refused():
    for text in ("no marker", "<P>a<M>b<S>c", "<P>a<S>b<M>c<M>"):
        with pytest.raises(ValueError):
            fim.gather(*text_bytes(pa.array([text])), np.array([fim.PSM]))


def test_slices_are_bounded_in_bytes():
    batch = pa.RecordBatch.from_pydict({"t": ["aaaa", None, "b" * 50, "", "cc", "dd"]})
    assert [b.column(0).to_pylist() for b in byte_slices([batch], 0, 2, 10)] == [["aaaa", None], ["b" * 50], ["", "cc"], ["dd"]]
    assert list(byte_slices([batch.slice(0, 0)], 0, 2, 10)) == []


def test_transform_matches_brute_force(spark):
    docs = documents(spark, *ODD * 4).repartition(3)
    done = fim.transform(docs)
    expected = sorted([(i, *brute(i, t)) for i, t in enumerate(ODD * 4)], key=str)
    assert as_rows(done, "doc_id", "n", "form", "prefix_chars", "middle_chars", "output") == expected
    assert {r[2] for r in expected} == {"plain", "psm", "spm"}
    told = fim.restore(done, "doc_id")
    assert as_rows(told, "doc_id", "restored") == sorted([(i, t or "") for i, t in enumerate(ODD * 4)], key=str)


def test_odd_tables(spark, tmp_path):
    rows = [(None, "one two three"), (None, None), (5, "x y"), (5, "x y"), (5, "other text")]
    frame = spark.createDataFrame([(k, t, 1, "z") for k, t in rows], "doc_id long, text string, n int, form string")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    got = as_rows(fim.op12_fill_in_middle(spark, str(tmp_path)))
    want = []
    for key, text in rows:
        n, form, prefix, middle, output = brute(key, text)
        want.append((key, n, form, prefix, middle, sha(output), sha(text)))
    assert got == sorted(want, key=str)
    frame.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert as_rows(fim.op12_fill_in_middle(spark, str(tmp_path / "none"))) == []
