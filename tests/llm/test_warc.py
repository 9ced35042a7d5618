import base64
import gzip
import hashlib
import html
import json
import random
import re
import time
from html.parser import HTMLParser

import pytest

from clicklake.llm import warc
from tests.llm.helpers import as_rows

PAGES = "page_id long, url string, html string, record_id string, content string"


class Reader(HTMLParser):
    """The text of well-formed HTML by the standard parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "template", "noscript"):
            self.skip += 1
        elif tag in warc.BLOCKS:
            self.out.append("\n")

    def handle_endtag(self, tag):
        if tag in ("script", "style", "template", "noscript"):
            self.skip -= 1
        elif tag in warc.BLOCKS:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.skip:
            self.out.append(data)


def parsed(payload):
    reader = Reader()
    reader.feed(payload)
    reader.close()
    lines = ["".join(reader.out)]
    lines = [re.sub(r"[^\S\n]+", " ", line).strip() for line in "".join(lines).split("\n")]
    return "\n".join(line for line in lines if line)


def test_whole_table_against_the_standard_parser(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = warc.op4_warc(spark, "/root/testdata/sf0.001").collect()
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    assert len(rows) == 2 * len(html)
    for row in rows:
        data = row["content"].encode()
        assert row["block_digest"] == "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert row["content_length"] == len(data)
        payload = html[row["page_id"]].encode()
        assert row["source_digest"] == "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if row["type"] == "conversion":
            assert row["content"] == parsed(html[row["page_id"]])
        else:
            about = json.loads(row["content"])
            assert about["source"]["record-id"] == row["refers_to"]
            assert about["source"]["headers"]["Content-Length"] == str(len(payload))


def test_both_records_refer_to_the_response(spark):
    pages = spark.createDataFrame([(1, "http://a.b/", "<title>T &amp; U</title><a href='/x?a&amp;b'>l</a>", "r", "c")], PAGES)
    source = warc.responses(pages).collect()[0]
    rows = {r["type"]: r for r in warc.derive(warc.responses(pages)).collect()}
    assert {r["refers_to"] for r in rows.values()} == {source["record_id"]}
    about = json.loads(rows["metadata"]["content"])
    assert about["conversion-id"] == rows["conversion"]["record_id"]
    assert about["source"]["block-digest"] == source["block_digest"]
    assert (about["title"], about["links"]) == ("T & U", ["/x?a&b"])
    assert rows["conversion"]["content"] == "T & U\nl"


def test_odd_pages(spark):
    odd = [
        None, "", "plain", "<p>a<br>b", "<!-- <p>no</p> -->yes", "<script>var t='</p>'</script>z", "&#x41;&#0;&amp;lt;",
        "<p>open <!-- never closed", "a < b and c > d", "<b>x</b>y", "<style>p{}", "x" * 200_000,
    ]
    rows = [(i if i else None, None if i == 1 else "u", h, None, None) for i, h in enumerate(odd)] * 2
    got = warc.derive(warc.responses(spark.createDataFrame(rows, PAGES)))
    texts = as_rows(got.where("type = 'conversion'"), "page_id", "content")
    expected = [
        "", "", "plain", "a\nb", "yes", "z", "A\ufffd&lt;", "open", "a < b and c > d", "xy", "", "x" * 200_000,
    ]
    assert texts == sorted([(i if i else None, t) for i, t in enumerate(expected)] * 2, key=str)
    assert warc.derive(warc.responses(spark.createDataFrame([], PAGES))).count() == 0


def test_written_files_hold_the_records(spark, tmp_path):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").repartition(3)
    records = warc.derive(warc.responses(pages))
    manifest = warc.write_records(records, f"file://{tmp_path}/warc").collect()
    assert sum(r["records"] for r in manifest) == records.count()
    written = []
    for row in manifest:
        data = gzip.open(row["file"].removeprefix("file://")).read()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            fields = dict(line.split(": ", 1) for line in lines[1:])
            length = int(fields["Content-Length"])
            assert lines[0] == "WARC/1.1" and rest[length : length + 4] == b"\r\n\r\n"
            written.append((fields["WARC-Record-ID"], fields["WARC-Refers-To"], rest[:length].decode()))
            data = rest[length + 4 :]
    assert sorted(written) == as_rows(records, "record_id", "refers_to", "content")


OLD_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.IGNORECASE | re.DOTALL)
OLD_LINK = re.compile(r"<a\b[^>]*?\shref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)


def test_scans_agree_with_plain_patterns():
    draw = random.Random(5)
    parts = ["<a ", "<A", " href=", "href =", "'", '"', "x", ">", "<", "/", "</a>", "<title>", "<title ", "</title>", "</TITLE >", " ", "\n", "&amp;", "<b>"]
    for _ in range(4000):
        page = "".join(draw.choices(parts, k=draw.randrange(25)))
        found = OLD_TITLE.search(page)
        inner = warc.SPACES.sub(" ", html.unescape(warc.MARKUP.sub("", found.group(1)))).strip() if found else None
        assert warc.title(page) == inner
        assert warc.links(page) == [html.unescape(a or b or c) for a, b, c in OLD_LINK.findall(page)], page


@pytest.mark.parametrize(
    "part", ["<a ", "<title>", "<title ", "<script ", "<style>", "<!--", "<a href=", "<a href='", "</title ", "&", "<", "<p", " \n", "<a href=x"]
)
def test_long_broken_pages_take_linear_time(part):
    page = part * (5_000_000 // len(part))
    begun = time.process_time()
    warc.plain_text(page)
    warc.described(page)
    assert time.process_time() - begun < 4
