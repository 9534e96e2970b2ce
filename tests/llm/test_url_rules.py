from hypothesis import given, settings
from hypothesis import strategies as st

from tallyho.llm import url_rules as U

RULES = U.SITE_RULES + U.PATTERN_RULES
SITES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def brute(url):
    """The contract's rules one by one."""
    if url is None or "://" not in url:
        host, path = "", ""
    else:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:]
        path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(h + p, v) for h, p, v in SITES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, key=lambda f: len(f[0]), default=(None, None))
    return host, path, *best


PARTS = ["http", "https", "://", "/", "?", "#", ".", "org", "com", "example", "ORG", "Example", "en", "es", "1", "12", "de", "fr", "ads", "-", "x", "é", " ", "\n", ":80", "spam"]
URLS = st.none() | st.lists(st.sampled_from(PARTS), max_size=12).map("".join) | st.builds(
    lambda h, p: f"https://{h}{p}", st.sampled_from(["a.example.org", "example.org", "notexample.org", "b.com", "com", "ORG", "x.ads-y.net"]),
    st.sampled_from(["", "/", "/es/", "/es", "/en/1", "/en/123?x", "/EN/1", "/fr/x", "/de/#a", "/en/2"]))


@settings(max_examples=600, deadline=None)
@given(URLS, st.dictionaries(st.sampled_from(["org", "com", "example", "es", "en", "fr", "de"]), st.integers(0, 9)))
def test_equals_brute_force_whatever_token_is_rarest(url, counts):
    import re

    index = U.index_rules(RULES, counts)
    compiled = {r.regex: re.compile(r.regex) for r in RULES}
    host, path, rule, verdict, pattern, _ = U.judge(url, index, compiled)
    want = brute(url)
    assert (host, path, rule) == want[:3]
    hit = next((r.name for r in sorted(U.PATTERN_RULES, key=lambda r: r.name) if re.search(r.regex, U.lower_ascii(url or ""))), None)
    assert pattern == hit
    assert verdict == (want[3] or ("block" if hit else "allow"))


def test_only_candidates_run():
    import re

    index = U.index_rules(RULES, {"org": 5, "example": 100, "es": 2, "en": 50, "com": 9, "fr": 3, "de": 1})
    compiled = {r.regex: re.compile(r.regex) for r in RULES}
    assert set(index) >= {"org", "es", "fr", "de"} and None not in index
    assert U.judge("https://plain.net/page", index, compiled)[-1] == 0
    assert U.judge("https://a.example.org/es/1", index, compiled)[-1] <= 3


def test_an_open_last_token_is_no_index():
    assert U.UrlRule.for_site("block", "example.org/en/1").tokens == ("example", "org", "en")
    assert U.UrlRule.for_site("block", "example.org/es/").tokens == ("example", "org", "es")
    assert U.UrlRule.for_site("allow", "org/").tokens == ("org",)


def test_operator_on_awkward_rows(spark):
    urls = [None, "", "nothing", "https://ads.example.net/x", "https://a.b.org/", "https://spam-farm.example.org/es/?q", "https://x.com/de/"]
    rows = [(i, u, "h", 1) for i, u in enumerate(urls)] + [(None, urls[3], "h", 1), (6, urls[6], "h", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, n_tried int")
    out = U.judge_urls(pages, "page_id", "url", RULES).collect()
    assert sorted((repr(r.page_id), r.rule, r.verdict) for r in out if r.rule is None) == sorted(
        [("0", None, "allow"), ("1", None, "allow"), ("2", None, "allow"), ("3", None, "block"), ("None", None, "block")])
    assert sorted((r.rule, r.verdict) for r in out if r.rule) == [("com/de/", "block"), ("com/de/", "block"), ("example.org/es/", "block"), ("org/", "allow")]
    assert U.judge_urls(pages.limit(0), "page_id", "url", RULES).collect() == []
    assert {r.verdict for r in U.judge_urls(pages, "page_id", "url", ()).collect()} == {"allow"}
