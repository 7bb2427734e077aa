from __future__ import annotations

import random

from pyspark.sql import functions as F

from weirflow.llm.queries import URL_RULES
from weirflow.llm.url_reputation import domain_of, host_reputation, judge_urls, name_of, page_outcome, suffix_of

PAGES = "page_id long, url string, good boolean, host string, verdict string"


def judged(spark, rows):
    given = spark.createDataFrame([(i, u, g, "h", "v") for i, u, g in rows], PAGES)
    return {r.page_id: r for r in judge_urls(given, F.col("good"), URL_RULES).collect()}


def test_hosts_paths_and_rules(spark):
    cases = {
        "http://A.Example.NET/en/x?y#z": ("a.example.net", "/en/x", "example.net/en/", "allow"),
        "https://example.net/fr/": ("example.net", "/fr/", "net/", "block"),
        "ftp://a.example.com/de/1": ("a.example.com", "/de/1", "example.com/de/", "block"),
        "x://b.org/fr/#q": ("b.org", "/fr/", "org/fr/", "allow"),
        "x://notexample.net": ("notexample.net", "", None, "allow"),
        "x://net/": ("net", "/", "net/", "block"),
        "x://fakenet/": ("fakenet", "/", None, "allow"),
        "a://b://c/d": ("b:", "//c/d", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "h://ÉX.com?a://b": ("Éx.com", "", None, "allow"),
    }
    got = judged(spark, [(i, u, None) for i, u in enumerate(cases)])
    for i, (url, want) in enumerate(cases.items()):
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == want, url


def test_only_hosts_with_clear_evidence_are_blocked(spark):
    rows = [(i, f"h://bad.site.com/{i}", False) for i in range(60)]
    rows += [(100 + i, f"h://good{i % 9}.fine.com/", True) for i in range(300)]
    rows += [(900, "h://once.other.com/", False), (901, "h://www.unknown.com/", None), (900, "h://once.other.com/", False)]
    got = judged(spark, rows)
    assert got[0].verdict == "block" and got[100].verdict == "allow"
    assert got[900].verdict == "allow" and got[901].verdict == "allow"
    assert judged(spark, []) == {}


def test_posteriors_lie_between_data_and_prior(spark):
    rows = [("a.x.com", True)] * 8 + [("a.x.com", False)] * 2 + [("b.x.com", None), ("c.y.org", False), ("1.2.3.4", True)]
    table = {r.host: r for r in host_reputation(spark.createDataFrame(rows, "host string, good boolean")).collect()}
    assert (table["a.x.com"].pages, table["a.x.com"].good) == (10, 8)
    # No page of its own: near the domain's other host. One bad page: between 0 and the other domains.
    assert 0.5 < table["b.x.com"].mean < 0.9
    assert 0.0 < table["c.y.org"].mean < 9 / 11
    assert all(r.low <= r.mean <= r.high for r in table.values())


def test_domains_and_suffixes(spark):
    want = {
        "a.b.example.com": ("example.com", "com"), "x.co.uk": ("x.co.uk", "co.uk"), "a.x.co.uk": ("x.co.uk", "co.uk"),
        "x.com.tr": ("x.com.tr", "com.tr"), "me.a.github.io": ("a.github.io", "github.io"), "t.co": ("t.co", "co"),
        "10.0.0.1": ("10.0.0.1", ""), "[::1]": ("[::1]", ""), "localhost": ("localhost", "localhost"), "": ("", ""),
    }
    told = [F.col("h"), domain_of(F.col("h")).alias("d"), suffix_of(F.col("h")).alias("s")]
    df = spark.createDataFrame([(h,) for h in want], "h string").select(*told)
    assert {r.h: (r.d, r.s) for r in df.collect()} == want
    own = df.where("h = 'a.b.example.com'").select(domain_of(F.col("h"), ["example.com"]).alias("d"))
    assert own.first().d == "b.example.com"


def test_ports_user_info_and_final_dots_make_no_other_host(spark):
    hosts = ["www.example.com:8080", "me:pw@www.example.com", "www.example.com.", "www.example.com:", "10.0.0.1:80", "[::1]:80", "@"]
    names = spark.createDataFrame([(h,) for h in hosts], "h string").select(name_of(F.col("h")).alias("n")).collect()
    assert [r.n for r in names] == ["www.example.com"] * 4 + ["10.0.0.1", "[::1]", ""]
    rows = [(i, f"h://{hosts[i % 4]}/{i}", False) for i in range(60)] + [(100, "h://www.example.com/", None)]
    rows += [(200 + i, f"h://site{i}.org/", True) for i in range(300)]
    got = judged(spark, rows)
    assert got[100].verdict == "block" and got[0].host == "www.example.com:8080" and got[200].verdict == "allow"


def by_hand(rows):
    """(pages, good, a, b) per host, level by level, in plain Python."""

    def counted(names):
        table = {}
        for name, good in names:
            pages, well = table.get(name, (0, 0))
            table[name] = (pages + (good is not None), well + (good is True))
        return table

    def strength(groups):
        groups = [(n, g) for n, g in groups if n]
        p, g = sum(n for n, _ in groups), sum(g for _, g in groups)
        if len(groups) < 2:
            return 10.0
        m = g / p
        over = sum(n * (g / n) ** 2 for n, g in groups) / p - m * m - m * (1 - m) * len(groups) / p
        return 1000.0 if over <= 0 else min(max(m * (1 - m) / over - 1, 1.0), 1000.0)

    def shrunk(table, above, parent):
        found = {}
        for name, (n, g) in table.items():
            a, b = above[parent(name)]
            s = strength([v for k, v in table.items() if parent(k) == parent(name)])
            mean = (a - g) / (a + b - n)
            found[name] = (g + mean * s, n - g + (1 - mean) * s)
        return found

    domain = lambda h: ".".join(h.split(".")[-2:])
    suffix = lambda h: h.split(".")[-1]
    n, g = counted(("", good) for _, good in rows)[""]
    by_suffix = shrunk(counted((suffix(h), x) for h, x in rows), {"": (g + 1, n - g + 1)}, lambda _: "")
    by_domain = shrunk(counted((domain(h), x) for h, x in rows), by_suffix, suffix)
    hosts = counted(rows)
    return {h: (*hosts[h], *ab) for h, ab in shrunk(hosts, by_domain, domain).items()}


def test_posteriors_match_plain_python(spark):
    random.seed(4)
    rows = []
    for d in range(12):
        share = random.random()
        for h in range(random.randint(1, 4)):
            rows += [(f"h{h}.d{d}.{random.choice(['com', 'org']) if d > 2 else 'net'}", random.choice([None, random.random() < share])) for _ in range(random.randint(1, 40))]
    want = by_hand(rows)
    got = host_reputation(spark.createDataFrame(rows, "host string, good boolean")).collect()
    assert len(got) == len(want)
    for r in got:
        pages, good, a, b = want[r.host]
        sd = (a * b / ((a + b) ** 2 * (a + b + 1))) ** 0.5
        assert (r.pages, r.good) == (pages, good)
        assert abs(r["mean"] - a / (a + b)) < 1e-9 and abs(r.high - min(1, a / (a + b) + 1.645 * sd)) < 1e-9


def test_planted_bad_hosts_are_blocked_by_their_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    spam = "<p>" + "BUY!! NOW$$$ CHEAP&&& " * 20 + "</p><script>never closed"
    planted = [(10**9 + i, f"https://u:p@shop{i % 3}.spam-farm{i % 2}.xyz:8443/{i}", spam) for i in range(90)]
    both = pages.unionByName(spark.createDataFrame(planted, pages.schema))
    got = judge_urls(both, page_outcome(F.col("html"))).collect()
    assert {r.verdict for r in got if r.page_id >= 10**9} == {"block"}
    assert {r.verdict for r in got if r.page_id < 10**9} == {"allow"}


def test_outcome_is_told_by_the_text(spark):
    pages = ["<p>A quiet page of words.</p><script>$$$$ !!!!</script>", "<p>BUY!! NOW$$$ CHEAP&&& pills</p>", "<b></b>", None]
    df = spark.createDataFrame([(p,) for p in pages], "h string").select(page_outcome(F.col("h")).alias("g"))
    assert [r.g for r in df.collect()] == [True, False, None, None]
