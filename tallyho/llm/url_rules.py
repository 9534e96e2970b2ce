"""URL filters: pattern rules indexed by their rarest literal token.

A rule is either a host/path rule (``UrlRule.site``: the host and its
subdomains, path prefix) or a pattern (``UrlRule.pattern``: a regular
expression over the lower-cased url). Each rule is compiled to one regular
expression and filed under one literal token that every url it fits must hold
as a whole token: the one found in the fewest urls of the table (counted over
all rows). A url's own tokens fetch the candidate rules, and only those run
their expressions. Rules without a usable token are candidates of every url.

The rules are an argument (a list), so their size is the caller's; the only
thing gathered from the table is one count per rule token. Judging is
row-local: no shuffle, no join, whatever host is hot.

Defined cases: a null url, or one without ``://``, has an empty host and path
and fits no site rule; an empty table gives an empty result; repeated rows
are judged one by one; columns other than the id and the url are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = "[a-z0-9]+"


@dataclass(frozen=True)
class UrlRule:
    name: str
    verdict: str          # allow or block
    regex: str            # for a site rule over host + / + path, else over the lower-cased url
    tokens: tuple[str, ...]  # literal tokens in every url that the rule fits
    site: bool

    @staticmethod
    def for_site(verdict: str, rule: str) -> UrlRule:
        """``host/path``: the host and all its subdomains; the url's path starts with the path."""
        host, slash, path = rule.partition("/")
        regex = rf"(?:[^/]*\.)?{re.escape(host)}/{re.escape(slash + path)}"
        # the path's last token may go on in the url, unless the rule ends it
        text = f"{host}/{slash}{path}"
        open_end = len(text) - len(re.search("[A-Za-z0-9]*$", text)[0]) if path else len(text)
        return UrlRule(rule, verdict, regex, tuple(dict.fromkeys(re.findall(TOKEN, text[:open_end].lower()))), True)

    @staticmethod
    def for_pattern(verdict: str, name: str, regex: str, *tokens: str) -> UrlRule:
        return UrlRule(name, verdict, regex, tokens, False)


#: The rules of the query (fixed values of its contract).
SITE_RULES = (
    UrlRule.for_site("allow", "org/"),
    UrlRule.for_site("block", "example.org/es/"),
    UrlRule.for_site("block", "example.org/en/1"),
    UrlRule.for_site("allow", "com/fr/"),
    UrlRule.for_site("block", "com/de/"),
)

#: What the method blocks where no site rule fits: hosts that advertise,
#: track, farm links or gamble, by words of their own name.
PATTERN_RULES = (
    UrlRule.for_pattern("block", "ads", r"://[^/?#]*\bads\b", "ads"),
    UrlRule.for_pattern("block", "adserver", r"://[^/?#]*\badservers?\b", "adserver"),
    UrlRule.for_pattern("block", "tracking", r"://[^/?#]*\btrack\b", "track"),
    UrlRule.for_pattern("block", "tracker", r"://[^/?#]*\btracker\b", "tracker"),
    UrlRule.for_pattern("block", "spam", r"://[^/?#]*\bspam\b", "spam"),
    UrlRule.for_pattern("block", "link farm", r"://[^/?#]*\blink-farm\b", "link", "farm"),
    UrlRule.for_pattern("block", "casino", r"://[^/?#]*\bcasino\b", "casino"),
    UrlRule.for_pattern("block", "betting", r"://[^/?#]*\bbet(?:ting)?-win\b", "win"),
    UrlRule.for_pattern("block", "porn", r"://[^/?#]*\bporn\b", "porn"),
)


def split_url(url: str | None) -> tuple[str, str]:
    """(host with A-Z lower-cased, path); both empty without ``://``."""
    if url is None:
        return "", ""
    _, mark, rest = url.partition("://")
    if not mark:
        return "", ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host):])[0]
    return lower_ascii(host), path


_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def lower_ascii(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(_LOWER)


def token_counts(urls: DataFrame, url: str, tokens: set[str]) -> dict[str, int]:
    """In how many rows each of ``tokens`` occurs: one row a token comes back."""
    if not tokens:
        return {}
    found = (urls.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower(F.col(url)), F.lit(f"({TOKEN})"), 1))).alias("t"))
             .where(F.col("t").isin(sorted(tokens))).groupBy("t").count())
    return {r["t"]: r["count"] for r in found.collect()}


def index_rules(rules: tuple[UrlRule, ...], counts: dict[str, int]) -> dict[str | None, list[UrlRule]]:
    """Rules by their rarest token (ties: alphabetically first); None: no token."""
    index: dict[str | None, list[UrlRule]] = {}
    for r in rules:
        key = min(r.tokens, key=lambda t: (counts.get(t, 0), t), default=None)
        index.setdefault(key, []).append(r)
    return index


def judge(url: str | None, index: dict[str | None, list[UrlRule]], compiled: dict[str, re.Pattern]):
    """(host, path, rule, verdict, pattern, number of expressions run) of one url."""
    host, path = split_url(url)
    low = lower_ascii(url) if url is not None else ""
    place = f"{host}/{path}"
    rule = pattern = None
    tried = 0
    for key in (None, *set(re.findall(TOKEN, low))):
        for r in index.get(key, ()):
            tried += 1
            if r.site:
                if host and compiled[r.regex].match(place) and (rule is None or (len(r.name), r.name) > (len(rule.name), rule.name)):
                    rule = r
            elif compiled[r.regex].search(low) and (pattern is None or r.name < pattern.name):
                pattern = r
    by = rule or pattern
    return host, path, rule and rule.name, by.verdict if by else "allow", pattern and pattern.name, tried


def judge_urls(pages: DataFrame, id_col: str, url: str, rules: tuple[UrlRule, ...]) -> DataFrame:
    """(id, host, path, rule, verdict, pattern, n_tried) for every row."""
    counts = token_counts(pages, url, {t for r in rules for t in r.tokens})
    index = index_rules(rules, counts)
    schema = pages.select(id_col).schema.add("host", "string").add("path", "string").add("rule", "string") \
        .add("verdict", "string").add("pattern", "string").add("n_tried", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = {r.regex: re.compile(r.regex) for rs in index.values() for r in rs}
        for b in batches:
            out = [judge(u, index, compiled) for u in b.column(1).to_pylist()]
            cols = list(zip(*out)) if out else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.string()) for c in cols[:5]), pa.array(cols[5], pa.int32())],
                [id_col, "host", "path", "rule", "verdict", "pattern", "n_tried"])

    return pages.select(id_col, url).mapInArrow(run, schema)


ORACLE = r"""
WITH u AS (SELECT page_id, url, CASE WHEN url IS NOT NULL AND position('://' IN url) > 0
                  THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, url, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
p AS (SELECT page_id, url,
             translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
r AS (SELECT *, CASE
        WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
        WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
        WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
        WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
        WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule FROM p),
m AS (SELECT *, regexp_matches(lower(coalesce(url, '')),
        '://[^/?#]*\b(ads|adservers?|track|tracker|spam|link-farm|casino|bet(ting)?-win|porn)\b') AS bad FROM r)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN bad THEN 'block' ELSE 'allow' END AS verdict
FROM m
"""


def query(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return (judge_urls(table(spark, sf_dir, "pages"), "page_id", "url", SITE_RULES + PATTERN_RULES)
            .select("page_id", "host", "path", "rule", "verdict"))
