"""WARC derivatives: responses converted into linked metadata and plain-text records.

For each response record two records are made: ``metadata``, a JSON block with the source's headers, digests, title
and links, and ``conversion``, the payload as plain text. Both name the response in ``WARC-Refers-To``, keep its
``WARC-Target-URI`` and ``WARC-Date``, and carry the digest of their own block; the metadata block also keeps the
response's block and payload digests, so each derivative can be traced to the bytes that it was made from. Record
identifiers are name-based UUIDs of the response's identifier and the kind, so a rerun gives the same records.

Every response is converted on its own: one pass, no shuffle.

Defined cases: a null payload is an empty one, and gives both records with empty text; a null target stays without
the header; equal responses give equal records; payloads of any length are converted whole; undecodable numbers in
entities become U+FFFD; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import json
import re
import uuid

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklake.llm.common import slices, stored, table

VERSION = "WARC/1.1"
#: The pages have no fetch date of their own.
FETCHED = "2024-01-01T00:00:00Z"
NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

#: Comments, elements whose content is not text, and tags.
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript)\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?/]?[a-z][^>]*(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
BLOCKS = frozenset(
    "address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head "
    "header hr html li main nav ol p pre section table tbody td tfoot th thead title tr ul".split()
)
TAG_NAME = re.compile(r"</?([a-z][a-z0-9]*)", re.IGNORECASE)
#: What holds no title and no link. A tag without an end reaches to the end of the page.
UNSEEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b[^>]*(?:>.*?(?:</\1\s*>|\Z)|\Z)", re.IGNORECASE | re.DOTALL)
TITLE, TITLE_END = re.compile(r"<title\b", re.IGNORECASE), re.compile(r"</title\s*>", re.IGNORECASE)
ANCHOR = re.compile(r"<a\b", re.IGNORECASE)
HREF = re.compile(r"\shref\s*=\s*", re.IGNORECASE)
VALUE = re.compile(r"\"([^\"]*)\"|'([^']*)'|([^\s>]+)")
SPACES = re.compile(r"[^\S\n]+")
LINES = re.compile(r" ?\n[ \n]*")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*names: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMES, ' '.join(names))}>"


def _between(match: re.Match) -> str:
    name = TAG_NAME.match(match.group())
    return "\n" if name and name.group(1).lower() in BLOCKS else ""


def plain_text(payload: str) -> str:
    """The text of an HTML page: a line for each block, no markup, entities resolved."""
    text = SPACES.sub(" ", html.unescape(MARKUP.sub(_between, payload)))
    return LINES.sub("\n", text).strip()


def title(seen: str) -> str | None:
    """What stands between the first title tag and the end tag after it. One scan: no later title can have an end if the first has none."""
    begin = TITLE.search(seen)
    start = seen.find(">", begin.end()) if begin else -1
    end = TITLE_END.search(seen, start + 1) if start >= 0 else None
    return SPACES.sub(" ", html.unescape(MARKUP.sub("", seen[start + 1 : end.start()]))).strip() if end else None


def links(seen: str) -> list[str]:
    """The targets of all anchors, in order, by one scan: where a tag holds no target, neither does a tag that begins within it."""
    out, at, end = [], 0, -1
    while anchor := ANCHOR.search(seen, at):
        if end < anchor.end():
            end = seen.find(">", anchor.end())
            end = end if end >= 0 else len(seen)
        at = end
        for href in HREF.finditer(seen, anchor.end(), end):
            if value := VALUE.match(seen, href.end()):
                out.append(html.unescape(next((g for g in value.groups() if g is not None), "")))
                at = value.end()
                break
    return out


def described(payload: str) -> dict:
    """Title and link targets of an HTML page, without what stands in comments and scripts."""
    seen = UNSEEN.sub("", payload)
    return {"title": title(seen), "links": links(seen)}


def block(headers: list[tuple[str, str]], content: bytes) -> bytes:
    """A whole WARC record."""
    lines = [VERSION, *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(content)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + content + b"\r\n\r\n"


RESPONSE = "record_id string, target_uri string, date string, http_headers string, payload string, block_digest string, payload_digest string"
RECORD = (
    "type string, record_id string, refers_to string, target_uri string, date string, content_type string, "
    "content_length long, block_digest string, source_digest string, content string"
)


def responses(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """Pages as response records, with their key."""

    def make(batches):
        for batch in slices(batches, 256):
            rows = []
            for number, target, payload in zip(*(batch.column(i).to_pylist() for i in range(3))):
                data = (payload or "").encode()
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(data)}\r\n\r\n"
                found = digest(data)
                rows.append([
                    record_id("response", str(number), target or "", found), target, FETCHED, head, payload or "",
                    digest(head.encode() + data), found,
                ])
            columns = [pa.array(c, pa.string()) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[key, *_names(RESPONSE)])

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(key, url, body).mapInArrow(make, f"`{key}` {kind}, {RESPONSE}")


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def derivatives(row: dict) -> list[list]:
    """The metadata and the conversion record of one response, as rows of ``RECORD``."""
    source = {name.strip(): value.strip() for name, _, value in (
        line.partition(":") for line in (row["http_headers"] or "").split("\r\n")[1:]) if name.strip()}
    payload = row["payload"] or ""
    text = plain_text(payload)
    about = {
        "source": {
            "record-id": row["record_id"], "block-digest": row["block_digest"],
            "payload-digest": row["payload_digest"], "headers": source,
        },
        **described(payload),
        "conversion-id": record_id("conversion", row["record_id"] or ""),
    }
    out = []
    for kind, mime, content in (
        ("metadata", "application/json", json.dumps(about, ensure_ascii=False, sort_keys=True)),
        ("conversion", "text/plain; charset=utf-8", text),
    ):
        data = content.encode()
        out.append([
            kind, record_id(kind, row["record_id"] or ""), row["record_id"], row["target_uri"], row["date"], mime,
            len(data), digest(data), row["payload_digest"], content,
        ])
    return out


def derive(sources: DataFrame, key: str = "page_id") -> DataFrame:
    """Two derived records for each response: key and the columns of ``RECORD``."""
    names = [key, *_names(RESPONSE)]

    def make(batches):
        for batch in slices(batches, 256):
            columns = [batch.column(i).to_pylist() for i in range(1, batch.num_columns)]
            rows = [r for values in zip(*columns) for r in derivatives(dict(zip(names[1:], values)))]
            keys = batch.column(0).take(pa.array([i // 2 for i in range(len(rows))], pa.int64()))
            types = [pa.int64() if n == "content_length" else pa.string() for n in _names(RECORD)]
            arrays = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
            yield pa.RecordBatch.from_arrays([keys, *arrays], names=[key, *_names(RECORD)])

    kind = sources.schema[key].dataType.simpleString()
    return sources.select(*names).mapInArrow(make, f"`{key}` {kind}, {RECORD}")


def headers(row: dict) -> list[tuple[str, str]]:
    """The named fields of a derived record, in the order that they are written."""
    fields = [
        ("WARC-Type", row["type"]), ("WARC-Record-ID", row["record_id"]), ("WARC-Refers-To", row["refers_to"]),
        ("WARC-Target-URI", row["target_uri"]), ("WARC-Date", row["date"]),
        ("WARC-Block-Digest", row["block_digest"]), ("WARC-Source-Payload-Digest", row["source_digest"]),
        ("Content-Type", row["content_type"]),
    ]
    return [(k, re.sub(r"[\r\n]+", " ", v)) for k, v in fields if v is not None]


def write_records(records: DataFrame, folder: str) -> DataFrame:
    """Writes derived records as gzip members, a file for each task; returns the manifest: file, records."""
    names = _names(RECORD)

    def write(batches):
        from pyarrow import fs

        name = f"{folder}/part-{TaskContext.get().partitionId():06d}-{TaskContext.get().taskAttemptId()}.warc.gz"
        filesystem, path = fs.FileSystem.from_uri(name)
        sink, count = None, 0
        for batch in batches:
            if sink is None:
                filesystem.create_dir(path.rsplit("/", 1)[0], recursive=True)
                sink = filesystem.open_output_stream(path, compression=None)
            for row in batch.to_pylist():
                sink.write(gzip.compress(block(headers(row), (row["content"] or "").encode()), 6, mtime=0))
                count += 1
        if sink is not None:
            sink.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "records": [count]})

    return stored(records.select(*names).mapInArrow(write, "file string, records long"), "warc-manifest")


def op4_warc(spark, sf_dir: str) -> DataFrame:
    return derive(responses(table(spark, sf_dir, "pages").select(F.col("page_id"), "url", "html")))
