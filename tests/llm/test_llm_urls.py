import random
import re

import duckdb
import llm_data as D
import pyarrow as pa

from saleswh.llm import queries, urls


def pattern(glob):
    parts = re.split(r"(\*+)", glob)
    return re.compile("".join((".*" if len(p) > 1 else "[^/]*") if p.startswith("*") else re.escape(p) for p in parts), re.S)


def test_automaton_equals_regex():
    rng = random.Random(4)
    globs = ["*.ab/c**", "**/a/**", "a*b", "**", "*", "", "abc", "*a**b*", "ab**", "**ba", "***a"] + ["".join(rng.choice("ab/*.") for _ in range(rng.randrange(1, 9))) for _ in range(60)]
    texts = ["", "é/a/é"] + ["".join(rng.choice("ab/.c") for _ in range(rng.randrange(14))) for _ in range(400)] + ["ab" * 3000, "a" * 5000 + "/"]
    got = urls.WildcardAutomaton(globs).fits(pa.array(texts))
    for k, g in enumerate(globs):
        p = pattern(g)
        assert [bool(p.fullmatch(t)) for t in texts] == got[:, k].tolist(), g


def host_path(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return (m[1].translate(lower), m[2]) if m else ("", "")


def brute(url):
    host, path = host_path(url)
    fits = [(len(h + p), v == "block", h + p, v) for v, h, p in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[2], max(fits)[3]
    return host, path, None, "block" if any(pattern(g).fullmatch(f".{host}{path}") for g in urls.BLOCK_GLOBS) else "allow"


CASES = [None, "", "no scheme/org/", "http://example.org/es/1", "http://EXAMPLE.org/en/1234", "http://notexample.org/es/", "http://a.b.example.org/es", "https://x.org",
         "https://x.org/", "http://org/", "http://x.com/fr/1?q=/de/", "http://x.com/de/#x", "http://x.com/?a/fr/", "http://x.com#/fr/", "ftp://h://y.org/z", "http://ads-track.example.com/q",
         "http://a.ads-x.net/", "http://net/ads/1", "http://net/x.example.org/es/", "http://x.net/" + "a" * 20000, "http://é.org/ü", "HTTP://X.ORG:80/a", "http://u@x.org/a", "http://x.adserver.io/"]


def test_verdicts_equal_brute_force(spark):
    rows = [(i, u) for i, u in enumerate(CASES)] + [(3, CASES[3])]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'mine' as rule", "1 as host", "2 as extra")
    got = urls.judged(pages, queries.URL_RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == brute(r.url) and r.extra == 2
    assert urls.judged(pages.limit(0), queries.URL_RULES).count() == 0
    assert {r.verdict for r in urls.judged(pages, [], []).collect()} == {"allow"}


def test_oracle(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{D.SMALL}/pages.parquet')")
    want = sorted(con.sql(queries.ORACLE_SQL["op5_url_filters"]).fetchall())
    assert sorted(tuple(r) for r in queries.QUERIES["op5_url_filters"](spark, D.SMALL).collect()) == want
