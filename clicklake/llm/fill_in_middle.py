"""Fill-in-the-middle transformation by displacement scatter.

A text is a row of units, a word with the white space in front of it (or the white space at the end), and is cut at two of
their ends into prefix, middle and suffix, which are written in another order behind markers. Both cuts and the form come
from a hash of seed and document id, so reruns agree. A batch of texts is handled as one row of bytes: cuts are found by a
scan for the ends of words; a difference array holds at each part's first byte by how much its shift differs from the
part before; its cumulative sum is every byte's way to its place in the output, and one scatter moves them all. The
inverse finds the markers in the outputs, builds the difference array of the restored texts from them alone, and gathers.

Both directions work through windows of ``WINDOW`` bytes with the shift carried on, so a text of any length takes a few bytes
of memory for each of its own.

Defined cases: a null or empty text is plain, and its output empty; a text that holds a marker is plain, so that outputs can
be undone; a null id hashes as the empty text; rows that are equal or share an id are each transformed, alike if their texts
are; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklake.llm.common import byte_slices, table, text_bytes, text_column

SEED = 42
#: Per cent of documents that are transformed, and of those the share with the suffix first.
RATE, SUFFIX_FIRST = 50, 80
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
WINDOW = 1 << 20
ROWS, SIZE = 2048, 1 << 22
PLAIN, PSM, SPM = 0, 1, 2
FORMS = np.array(["plain", "psm", "spm"])
#: The order of the parts (0 prefix, 1 middle, 2 suffix) in the output of each form.
ORDER = {PSM: (0, 2, 1), SPM: (2, 0, 1)}
MARKERS = (PREFIX, MIDDLE, SUFFIX)
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


class Units:
    """Where the units of a batch of texts end."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.offsets = offsets
        space = SPACE[data]
        last = np.append(space[1:], True)
        filled = np.flatnonzero(np.diff(offsets))
        last[offsets[filled + 1] - 1] = True
        self.ends = np.flatnonzero(~space & last) + 1
        first, after = np.searchsorted(self.ends, offsets[:-1], "right"), np.searchsorted(self.ends, offsets[1:], "right")
        self.first, self.words = first, after - first
        self.count = self.words.copy()
        self.count[filled] += space[offsets[filled + 1] - 1]

    def cut(self, units: np.ndarray) -> np.ndarray:
        """The place after so many units of each text."""
        out = np.where(units >= self.count, self.offsets[1:], self.offsets[:-1])
        inside = (units > 0) & (units <= self.words)
        out[inside] = self.ends[(self.first + units - 1)[inside]]
        return out


def markers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where markers begin, and in which text."""
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    letters = np.zeros(256, bool)
    letters[[m[1] for m in MARKERS]] = True
    places = np.flatnonzero((data[:-2] == PREFIX[0]) & letters[data[1:-1]] & (data[2:] == PREFIX[2]))
    owner = np.searchsorted(offsets, places, "right") - 1
    inside = places + len(PREFIX) <= offsets[owner + 1]
    return places[inside], owner[inside]


def _shifts(starts: np.ndarray, shifts: np.ndarray, size: int):
    """Windows (first, last) over ``size`` bytes and the shift of each byte: parts begin at ``starts``, in rising order."""
    change = np.diff(shifts, prepend=0)
    carried = 0
    for a in range(0, size, WINDOW):
        b = min(a + WINDOW, size)
        some = slice(*np.searchsorted(starts, [a, b]))
        difference = np.zeros(b - a, np.int64)
        np.add.at(difference, starts[some] - a, change[some])
        difference[0] += carried
        moved = np.cumsum(difference)
        carried = moved[-1]
        yield a, b, moved


def scatter(data: np.ndarray, offsets: np.ndarray, cuts: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Outputs of texts cut at ``cuts`` (two places each): their bytes and offsets."""
    starts = np.stack([offsets[:-1], cuts[:, 0], cuts[:, 1]], axis=1)
    sizes = np.diff(np.column_stack([starts, offsets[1:]]), axis=1)
    mark = np.where(form == PLAIN, 0, len(PREFIX))
    places = np.concatenate([[0], np.cumsum(np.diff(offsets) + 3 * mark)])
    out = np.empty(places[-1], np.uint8)
    target = np.empty_like(starts)
    target[:] = places[:-1, None] + np.cumsum(sizes, axis=1) - sizes
    for kind, order in ORDER.items():
        rows = np.flatnonzero(form == kind)
        at = places[:-1][rows]
        for part in order:
            out[at[:, None] + np.arange(len(PREFIX))] = np.frombuffer(MARKERS[part], np.uint8)
            target[rows, part] = at + len(PREFIX)
            at = at + len(PREFIX) + sizes[rows, part]
    for a, b, moved in _shifts(starts.ravel(), (target - starts).ravel(), len(data)):
        out[np.arange(a, b) + moved] = data[a:b]
    return out, places


def gather(data: np.ndarray, offsets: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts of such outputs, from their bytes and forms alone."""
    marks, owner = markers(data, offsets)
    own = form[owner] != PLAIN
    marks, owner = marks[own], owner[own]
    changed = np.flatnonzero(form != PLAIN)
    if not np.array_equal(owner, np.repeat(changed, 3)):
        raise ValueError("an output that is not plain has exactly three markers")
    marks = marks.reshape(-1, 3)
    begin = np.repeat(offsets[:-1, None], 3, axis=1)
    end = np.column_stack([offsets[1:]] * 3)
    begin[form == PLAIN, 1:] = offsets[1:][form == PLAIN, None]
    upto = np.column_stack([marks[:, 1:], offsets[1:][changed]])
    for kind, order in ORDER.items():
        some = form[changed] == kind
        for turn, part in enumerate(order):
            if (data[marks[some, turn] + 1] != MARKERS[part][1]).any():
                raise ValueError("markers in another order than the form's")
            begin[changed[some], part] = marks[some, turn] + len(PREFIX)
            end[changed[some], part] = upto[some, turn]
    sizes = end - begin
    places = np.concatenate([[0], np.cumsum(sizes.sum(axis=1))])
    starts = places[:-1, None] + np.cumsum(sizes, axis=1) - sizes
    out = np.empty(places[-1], np.uint8)
    for a, b, moved in _shifts(starts.ravel(), (begin - starts).ravel(), len(out)):
        out[a:b] = data[np.arange(a, b) + moved]
    return out, places


def characters(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Code points between neighbouring places, which rise."""
    if not len(data):
        return np.zeros(len(places) - 1, np.int64)
    begins = np.append((data & 0xC0) != 0x80, False)
    return np.where(np.diff(places) > 0, np.add.reduceat(begins, places[:-1], dtype=np.int64), 0)


def transform(
    docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED, rate: int = RATE,
    suffix_first: int = SUFFIX_FIRST,
) -> DataFrame:
    """key, n (units), form, prefix_chars, middle_chars (null if plain), output: a row for each document."""

    def run(batches):
        for batch in byte_slices(batches, 1, ROWS, SIZE):
            data, offsets = text_bytes(batch.column(1))
            h = np.stack([batch.column(i).to_numpy() for i in range(2, 6)])
            units = Units(data, offsets)
            n = units.count
            ends = np.sort(h[:2] % (n + 1), axis=0)
            cuts = np.column_stack([units.cut(ends[0]), units.cut(ends[1])])
            form = np.where(h[3] % 100 < suffix_first, SPM, PSM)
            form[markers(data, offsets)[1]] = PLAIN
            form[(np.diff(offsets) == 0) | (h[2] % 100 >= rate)] = PLAIN
            out, places = scatter(data, offsets, cuts, form)
            parts = characters(data, np.append(np.column_stack([offsets[:-1], cuts]).ravel(), len(data))).reshape(-1, 3)
            plain = form == PLAIN
            columns = [
                batch.column(0), pa.array(n), pa.array(FORMS[form]), pa.array(parts[:, 0], mask=plain),
                pa.array(parts[:, 1], mask=plain), text_column(out, places).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(
                columns, names=[key, "n", "form", "prefix_chars", "middle_chars", "output"]
            )

    kind = docs.schema[key].dataType.simpleString()
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    numbers = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"), *numbers)
    return rows.mapInArrow(
        run, f"`{key}` {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    )


def restore(transformed: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep``, output and restored: the text that each output was made of, by output and form."""
    columns = [*keep, "output", "form"]

    def run(batches):
        for batch in byte_slices(batches, len(keep), ROWS, SIZE):
            data, offsets = text_bytes(batch.column(len(keep)))
            form = np.searchsorted(FORMS, batch.column(len(keep) + 1).to_numpy(zero_copy_only=False).astype(str))
            text = text_column(*gather(data, offsets, form)).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], text], names=[*columns[:-1], "restored"])

    schema = transformed.select(*keep, "output", F.lit("").alias("restored")).schema
    return transformed.select(*columns).mapInArrow(run, schema)


def op12_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    done = transform(table(spark, sf_dir, "documents")).withColumn("shape", F.col("form"))
    told = restore(done, "doc_id", "n", "shape", "prefix_chars", "middle_chars")
    return told.select(
        "doc_id", "n", F.col("shape").alias("form"), "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )


SQL = r"""
WITH hashed AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
        regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
    FROM documents
), drawn AS (
    SELECT doc_id, text, units, len(units) AS n, ('0x' || h[1:8])::BIGINT % (len(units) + 1) AS a,
        ('0x' || h[9:16])::BIGINT % (len(units) + 1) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR ('0x' || h[17:24])::BIGINT % 100 >= 50 THEN 'plain'
            WHEN ('0x' || h[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM hashed
), cut AS (
    SELECT doc_id, text, n, form, array_to_string(units[1:least(a, b)], '') AS prefix,
        array_to_string(units[least(a, b) + 1:greatest(a, b)], '') AS middle,
        array_to_string(units[greatest(a, b) + 1:], '') AS suffix
    FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM cut
"""
