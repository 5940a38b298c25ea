import re
from collections import Counter, defaultdict

import pytest
from llm_data import SF

from duelframe.llm import queries
from duelframe.llm import url_filter as U


def split(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host = "".join(c.lower() if c.isascii() else c for c in m[1]) if m else ""
    return host, m[2] if m else ""


def by_rule(host, path, rules=U.RULES):
    fits = [(len(r), r, v) for r, v in rules for h, _, p in [r.partition("/")]
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return max(fits)[1:] if fits else (None, None)


def brute(pages, rounds=200):
    """pages of (url, html) -> (host, path, rule, verdict)."""
    rows = [(*split(u), h) for u, h in pages]
    weight, names = Counter(), {h for h, _, _ in rows if h}
    for host, _, html in rows:
        for dst in {"".join(c.lower() if c.isascii() else c for c in d) for d in re.findall(U.LINK, html or "")}:
            if host and dst != host:
                weight[host, dst] += 1
                names.add(dst)
    pairs = set()
    for n in names:
        parts = n.split(".")
        for i in range(len(parts) - 2):
            pairs.add((".".join(parts[i:]), ".".join(parts[i + 1:])))
    for a, b in pairs:
        weight[a, b] += 1
        weight[b, a] += 1
    seeds = {"allow": Counter(), "block": Counter()}
    for host, path, _ in rows:
        verdict = by_rule(host, path)[1]
        if host and verdict:
            seeds[verdict][host] += 1

    def flow(edges, start):
        out = Counter()
        for (a, _), w in edges.items():
            out[a] += w
        total = sum(start.values())
        base = {h: n / total for h, n in start.items()}
        mass = dict(base)
        for _ in range(rounds):
            new = defaultdict(float)
            for (a, b), w in edges.items():
                new[b] += U.DAMPING * mass.get(a, 0.0) * w / out[a]
            for h, m in base.items():
                new[h] += (1 - U.DAMPING) * m
            mass = new
        return mass

    trust = flow(weight, seeds["allow"])
    distrust = flow({(b, a): w for (a, b), w in weight.items()}, seeds["block"])
    out = []
    for host, path, _ in rows:
        rule, verdict = by_rule(host, path)
        bad = distrust.get(host, 0) > U.THRESHOLD * (trust.get(host, 0) + distrust.get(host, 0))
        out.append((host, path, rule, verdict or ("block" if bad else "allow")))
    return out


SCHEMA = "page_id long, url string, html string, host string, rule string"
PAGES = [
    ("http://good.example.org/a?x#y", '<a href="http://friend.net/x">'), ("HTTPS://EXAMPLE.ORG/es/1", None),
    ("http://x.example.org/en/12", ""), ("http://x.example.org/en/2", ""), ("ftp://shop.com/de/1", ""),
    ("http://shop.com/de", ""), ("http://shop.com/fr/2", ""), ("http://a.b.shop.com/de/x", ""),
    ("http://farm.net/1", "<a href='https://shop.com/de/'> <a href=//A.B.shop.com>"), ("http://friend.net/", ""),
    ("http://notorg/x", ""), ("http://org/", ""), ("http://org", ""), ("no scheme", None), ("", None), (None, None),
    ("http:///path", ""), ("a://b://c/d", ""), ("http://Ü.Org/é?", ""), ("http://alone.net/\n#", ""), ("x\n://q.org/y", ""),
    ("http://spam.example.org/es/3", '<a href="http://good.example.org">'), ("http://farm.net/1", None), ("http://farm.net/1", None),
]


def test_matches_brute_force(spark):
    rows = [(i, u, h, "clash", "clash") for i, (u, h) in enumerate(PAGES)]
    got = U.judge(spark.createDataFrame(rows, SCHEMA)).orderBy("page_id").collect()
    assert [(r["host"], r["path"], r["rule"], r["verdict"]) for r in got] == brute(PAGES)
    verdict = {r["url"]: r["verdict"] for r in got}
    assert verdict["http://farm.net/1"] == "block" and verdict["http://friend.net/"] == "allow"


def test_query_matches_brute_force(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").orderBy("page_id").collect()
    got = queries.op7_url_filter(spark, SF).orderBy("page_id").collect()
    assert [tuple(r)[1:] for r in got] == brute([(p["url"], p["html"]) for p in pages])
    assert [r["page_id"] for r in got] == [p["page_id"] for p in pages]


@pytest.mark.parametrize("pages", [[], [(None, None)], [("http://a.net/", "")]])
def test_without_seeds_or_rows(spark, pages):
    rows = [(i, u, h, None, None) for i, (u, h) in enumerate(pages)]
    got = U.judge(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [r["verdict"] for r in got] == ["allow"] * len(pages)


def test_a_long_chain_is_judged_to_its_end(spark):
    pages = [(f"http://h{i}.net/", f'<a href="http://h{i + 1}.net/">') for i in range(45)] + [("http://h45.net/", '<a href="http://a.com/de/">')]
    pages += [("http://a.com/de/x", ""), ("http://b.com/fr/x", '<a href="http://c0.net">')]
    pages += [(f"http://c{i}.net/", f'<a href="http://c{i + 1}.net/">') for i in range(45)]
    rows = [(i, u, h, None, None) for i, (u, h) in enumerate(pages)]
    got = U.judge(spark.createDataFrame(rows, SCHEMA)).orderBy("page_id").collect()
    assert [(r["host"], r["path"], r["rule"], r["verdict"]) for r in got] == brute(pages)
    assert [r["verdict"] for r in got] == ["block"] * 47 + ["allow"] * 46


def test_plan_has_no_python(spark):
    plan = queries.op7_url_filter(spark, SF)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "InArrow"))


def test_rounds_of_a_small_graph_make_one_file(spark):
    """Shuffle partitions that suit pages are not taken for a few hosts."""
    held = {"spark.sql.shuffle.partitions": "23", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in held}
    edges = spark.createDataFrame([(f"h{i}", f"h{i + 1}", 1.0) for i in range(20)], "src string, dst string, weight double")
    seeds = spark.createDataFrame([("h0", 1, 0), ("h20", 0, 1)], "host string, allowed long, blocked long")
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        scores = U.propagated(edges, seeds, settled=0.5)
        assert len(scores.inputFiles()) == 1 and scores.count() == 21
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
