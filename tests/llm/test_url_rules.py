import itertools

from clicklake.llm.url_rules import PATTERN_RULES, SITE_RULES, Rule, build_index, judge, token_counts
from tests.llm.helpers import as_rows

URLS = [
    None, "", "no scheme", "http://", "http://net", "http://net/", "HTTP://A.NET/x", "http://a.net", "http://anet/",
    "http://x.example.net/en/", "http://x.example.net/en", "http://x.example.net/EN/a", "http://Example.Net/en/a?b=/de/",
    "http://example.com/de/", "http://badexample.com/de/", "http://a.example.com/de/1#top", "http://q.org/fr/1",
    "http://org/fr/", "http://q.org?/fr/", "http://spam-farm.example.org/fr/1", "http://spam-farm.example.org/en/1",
    "http://a.b/?u=http://x.net/", "ftp://u@h.net:21/x", "http://h.net:21/x", "http://a.net//", "x://é.net/ü",
    "http://cheap-pills.casino-win.example.com/", "http://a.b/casino-win.html", "http://a.net\n/x", "http://a.net/x",
]


def plain(url):
    """The rules tried one by one, without an index or expressions."""
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in url or "")
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = "".join(itertools.takewhile(lambda c: c not in "/?#", rest))
        path = "".join(itertools.takewhile(lambda c: c not in "?#", rest[len(host) :]))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fitting = []
    for rule in SITE_RULES:
        name, _, rest = rule.text.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fitting.append(rule)
    patterns = [r for r in PATTERN_RULES if r.text in lower]
    longest = lambda rules: min(rules, key=lambda r: (-len(r.text), r.text), default=None)
    site = longest(fitting)
    pattern = None if site else longest(patterns)
    decided = site or pattern
    return host, path, site and site.text, decided.action if decided else "allow", pattern and pattern.text


def test_verdicts_match_trying_every_rule(spark):
    pages = spark.createDataFrame([(i, u, "h", "p") for i, u in enumerate(URLS)], "page_id long, url string, host string, rule string")
    got = judge(pages, SITE_RULES + PATTERN_RULES)
    assert as_rows(got) == sorted([(i, *plain(u)) for i, u in enumerate(URLS)], key=str)


def test_empty_table_repeated_rows_and_null_keys(spark):
    schema = "page_id long, url string"
    assert judge(spark.createDataFrame([], schema), SITE_RULES).count() == 0
    twice = spark.createDataFrame([(None, "http://a.net/"), (None, "http://a.net/")], schema)
    assert as_rows(judge(twice, SITE_RULES)) == [(None, "a.net", "/", "net/", "block", None)] * 2


def test_rules_are_filed_under_their_rarest_token(spark):
    pages = spark.createDataFrame([(1, "http://a.example.net/en/"), (2, "http://b.example.net/en/"), (3, "http://c.net/")], "page_id long, url string")
    rule = Rule("example.net/en/", "allow")
    assert rule.tokens() == {"example", "net", "en"}
    counts = token_counts(pages, "url", sorted(rule.tokens()))
    assert counts == {"example": 2, "net": 3, "en": 2}
    index, rest = build_index([rule, Rule("*", "block", "pattern")], counts)
    assert list(index) == ["en"] and [r.text for r in rest] == ["*"]


def test_tokens_cut_by_wildcards_or_open_ends_do_not_index():
    assert Rule("ads*track/pix", "block", "pattern").tokens() == set()
    assert Rule("/ads/x*", "block", "pattern").tokens() == {"ads"}
    assert Rule("org/fr", "allow").tokens() == {"org"}


def test_ties_go_to_the_blocking_rule(spark):
    pages = spark.createDataFrame([(1, "http://a.b/cd/")], "page_id long, url string")
    got = judge(pages, [Rule("/cd/", "allow", "pattern"), Rule("a.b/", "block", "pattern")])
    assert as_rows(got, "verdict", "pattern") == [("block", "a.b/")]
