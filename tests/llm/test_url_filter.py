import random
import re

import pytest

from retailscope.llm import url_filter as U

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
ODD = [
    None, "", "no scheme", "://", "http://", "http://Example.COM", "http://example.com/en/", "http://www.EXAMPLE.com/en/x?y#z",
    "http://badexample.com/en/1", "http://a.www.example.com/en/", "https://x.net/es/q", "https://net/fr/", "https://x.net/es",
    "https://x.net?/es/", "http://u://v/w", "http://h\nost.com/\n", "http://example.com:80/en/", "http://caKe.com/", "http://x.org/casino",
    "http://x.org/casinos", "http://x.org/a-casino.b", "http://spam-farm.org", "http://x.org/Casino", "http://example.com/EN/", "//a.com/",
]


def brute(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(h + p, a) for h, p, a in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        rule, verdict = max(fits, key=lambda f: len(f[0]))
        return host, path, rule, verdict
    blocked = any(re.search(rf"(?<![a-z0-9]){w}(?![a-z0-9])", re.sub("[A-Z]", lambda m: m[0].lower(), host + path)) for w in U.BLOCKED_WORDS)
    return host, path, None, "block" if blocked else "allow"


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id bigint, url string, html string, rule string")


def test_same_as_trying_every_rule(spark):
    draw = random.Random(1)
    urls = ODD * 2 + [
        f"http{draw.choice(['', 's'])}://{draw.choice(['', 'www.', 'a.'])}{draw.choice(['example.com', 'x.net', 'net', 'b.org', 'com', 'casino.org'])}"
        f"{draw.choice(['', '/', '/en/', '/es/a', '/fr/b/c', '/en', '/xxx/free-download'])}{draw.choice(['', '?q=/en/', '#f'])}"
        for _ in range(400)
    ]
    got = {r["page_id"]: tuple(r)[1:] for r in U.judge_urls(pages(spark, urls)).collect()}
    assert [got[i] for i in range(len(urls))] == [brute(u) for u in urls]


def test_rules_are_filed_under_their_rarest_token():
    rules = [U.host_rule("example.com", "/en/", "block"), U.word_rule("free-download", "block"), U.Rule("x+", "block", ())]
    by_token, always = U.token_index(rules, {"com": 90, "example": 50, "en": 7, "free": 2, "download": 1})
    assert by_token == {"en": [0], "download": [1]} and always == [2]
    assert U.host_rule("a.com", "/en", "block").tokens == ("a", "com")


def test_only_fetched_rules_run(spark):
    rules = [U.word_rule(f"word{i}", "block") for i in range(500)] + [U.Rule("[", "block", ("absent",))]
    got = U.judge_urls(pages(spark, ["http://a.org/word7", "http://a.org/x", "http://a.org/word77x"]), rules).collect()
    assert [r["verdict"] for r in sorted(got)] == ["block", "allow", "allow"]


LIST = """! a filter list
# comment

||ads.example.org^
@@||ads.example.org/fair
||Tracker.net/p/
*/banner/*.gif*
@@*/banner/ours/*
Casino
free-download
"""


def test_a_list_of_thousands_of_rules(spark, tmp_path):
    path = tmp_path / "list.txt"
    path.write_text(LIST + "".join(f"||host{i}.example.org/x{i % 7}/\n*/part{i}/*end{i}.js*\nword-{i}\n" for i in range(1500)))
    rules = U.read_rules(spark, str(path))
    assert len(rules) == 7 + 4500
    urls = {
        "http://a.ads.example.org/x": "block", "http://ads.example.org/fair/1": "allow", "http://tracker.net/p/1": "block", "http://tracker.net/P/1": "allow",
        "http://b.org/banner/1.gif": "block", "http://b.org/banner/ours/1.gif": "allow", "http://b.org/BANNER/1.GIF": "block",
        "http://b.org/CASINO": "block", "http://b.org/casinos": "allow", "http://host77.example.org/x0/": "block", "http://host77.example.org/x1/": "allow",
        "http://b.org/part9/a/end9.js": "block", "http://b.org/part9/a/end8.js": "allow", "http://b.org/a/word-1499": "block", "http://b.org/word-1500": "allow",
    }
    got = U.judge_urls(pages(spark, list(urls)), rules).collect()
    assert {list(urls)[r["page_id"]]: r["verdict"] for r in got} == urls
    counts = U.token_counts(spark.createDataFrame([("b.org", "/part9/end8.js"), ("b.org", "/other")], "host string, path string"), ["org", "part9", "end9"])
    assert counts == {"org": 2, "part9": 1}
    by_token, always = U.token_index(rules, {"example": 9, "org": 9, "x0": 5})
    assert max(map(len, by_token.values())) < 300 and not always
    with pytest.raises(ValueError):
        U.read_rules(spark, str(path), most_bytes=1000)


def test_very_long_urls_are_judged_whole(spark):
    urls = ["http://a.org/" + "x/" * 100_000 + "casino", "http://a.org/" + "y" * 300_000]
    assert [r["verdict"] for r in sorted(U.judge_urls(pages(spark, urls)).collect())] == ["block", "allow"]


def test_no_pages(spark):
    assert U.judge_urls(pages(spark, [])).count() == 0
