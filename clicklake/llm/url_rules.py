"""URL filters: rules indexed by their rarest literal token.

A *site rule* is ``host/path``: it fits the host and all its subdomains when the URL's path starts with the
rule's path. A *pattern rule* is a text that may occur anywhere in the URL, with ``*`` for any characters. Every
rule is compiled to a regular expression and filed under the one of its literal tokens that fewest URLs of the
corpus hold. A URL's tokens fetch candidate rules; only those run their expressions. Rules without a token that
is sure to show up whole in a matching URL stand in a list that is always tried.

The longest fitting site rule decides; ties go to blocking rules, then to the smaller text. Where none fits, a
fitting pattern rule decides in the same way, and else the verdict is ``allow``.

Defined cases: a null URL, or one without ``://``, has the empty host and path, so that no site rule fits it; an
empty table gives no rows; equal rows are judged alike; columns beside the key and the URL are not looked at. Rules
are a parameter, and so is their number: they travel to the executors with the task.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklake.llm.common import ascii_lower, table

TOKEN = "[a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    text: str
    action: str
    kind: str = "site"

    def expression(self) -> str:
        """Over host + path for a site rule, over the URL with A-Z lower-cased for a pattern rule."""
        if self.kind == "site":
            host, slash, path = self.text.partition("/")
            return rf"(?:[^/]*\.)?{re.escape(host)}{re.escape(slash + path)}"
        return "(?s:.*)" + "(?s:.*)".join(re.escape(part) for part in self.text.split("*"))

    def tokens(self) -> set[str]:
        """Tokens that every fitting URL holds whole: letters and digits between literal delimiters."""
        text = _lower(self.text)
        found = set()
        for match in re.finditer(TOKEN, text):
            start, end = match.span()
            opened = text[start - 1] != "*" if start else self.kind == "site"
            closed = end < len(text) and text[end] != "*"
            if opened and closed:
                found.add(match.group())
        return found


def _lower(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def split_url(url):
    """Columns host and path of a URL column."""
    host = F.regexp_extract(url, "://([^/?#]*)", 1)
    path = F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def token_counts(pages: DataFrame, url: str, tokens: Sequence[str]) -> dict[str, int]:
    """In how many URLs of the table each of the given tokens occurs."""
    if not tokens:
        return {}
    held = F.array_distinct(F.regexp_extract_all(ascii_lower(F.col(url)), F.lit(TOKEN), F.lit(0)))
    asked = F.array(*map(F.lit, tokens))
    rows = pages.select(F.explode(F.array_intersect(held, asked)).alias("token")).groupBy("token").count().collect()
    return dict.fromkeys(tokens, 0) | {r["token"]: r["count"] for r in rows}


def build_index(rules: Iterable[Rule], counts: dict[str, int]) -> tuple[dict[str, list[Rule]], list[Rule]]:
    """Rules by their rarest token, and those without one."""
    index: dict[str, list[Rule]] = {}
    rest = []
    for rule in rules:
        if tokens := rule.tokens():
            index.setdefault(min(tokens, key=lambda t: (counts.get(t, 0), t)), []).append(rule)
        else:
            rest.append(rule)
    return index, rest


def judge(pages: DataFrame, rules: Sequence[Rule], key: str = "page_id", url: str = "url") -> DataFrame:
    """key, host, path, rule (null when no site rule fits), verdict, pattern (the pattern rule that decided)."""
    tokens = sorted(set().union(*(r.tokens() for r in rules)))
    index, rest = build_index(rules, token_counts(pages, url, tokens))
    index = {token: [(r, re.compile(r.expression())) for r in held] for token, held in index.items()}
    rest = [(r, re.compile(r.expression())) for r in rest]
    split = re.compile(TOKEN)

    def best(fitting):
        return min(fitting, key=lambda r: (-len(r.text), r.action != "block", r.text), default=None)

    def verdicts(batches):
        import pyarrow as pa

        for batch in batches:
            chosen, patterns, words = [], [], []
            for link, host, path in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                link = _lower(link or "")
                candidates = [pair for t in set(split.findall(link)) for pair in index.get(t, ())] + rest
                site = best(
                    r for r, fits in candidates if r.kind == "site" and fits.match(host + path) and (host or path)
                )
                pattern = None if site else best(r for r, fits in candidates if r.kind != "site" and fits.match(link))
                chosen.append(site and site.text)
                patterns.append(pattern and pattern.text)
                words.append((site or pattern).action if site or pattern else "allow")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3)]
                + [pa.array(x, pa.string()) for x in (chosen, words, patterns)],
                names=[key, "host", "path", "rule", "verdict", "pattern"],
            )

    host, path = split_url(F.col(url))
    rows = pages.select(F.col(key), F.col(url).alias("_url"), host.alias("_host"), path.alias("_path"))
    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(
        verdicts, f"`{key}` {kind}, host string, path string, rule string, verdict string, pattern string"
    )


#: What the query asks for: the four site rules of its contract, and patterns for names of unwanted sites.
SITE_RULES = [
    Rule("net/", "block"),
    Rule("example.net/en/", "allow"),
    Rule("example.com/de/", "block"),
    Rule("org/fr/", "allow"),
]
PATTERN_RULES = [
    Rule(f"{name}.", "block", "pattern")
    for name in ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
]

SQL = """
WITH split AS (
  SELECT page_id, url,
    coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path,
    translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered
  FROM pages
), ruled AS (
  SELECT *,
    CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/')
           THEN 'example.net/en/'
         WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/')
           THEN 'example.com/de/'
         WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
         WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/'
    END AS rule,
    CASE WHEN contains(lowered, 'cheap-pills.') THEN 'cheap-pills.'
         WHEN contains(lowered, 'casino-win.') THEN 'casino-win.'
         WHEN contains(lowered, 'ads-track.') THEN 'ads-track.'
         WHEN contains(lowered, 'free-bets.') THEN 'free-bets.'
         WHEN contains(lowered, 'spam-farm.') THEN 'spam-farm.'
         WHEN contains(lowered, 'adult-x.') THEN 'adult-x.'
    END AS matched
  FROM split
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
       WHEN rule IS NOT NULL THEN 'allow'
       WHEN matched IS NOT NULL THEN 'block'
       ELSE 'allow' END AS verdict,
  CASE WHEN rule IS NULL THEN matched END AS pattern
FROM ruled
"""


def op1_url_filters(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), SITE_RULES + PATTERN_RULES)
