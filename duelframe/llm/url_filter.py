"""URL filter: path rules first, then trust and distrust propagated over the host graph.

Rules (host/path, allow or block) judge the pages that they fit; the longest
fitting rule wins.  The other pages follow their host:

* Host edges are absolute links in a page's HTML (its host -> the linked
  host), and the domain tree (a host and its parent domain vouch for each
  other), since a subdomain is run by its domain.
* Trust is a personalised PageRank that starts at hosts with allowed pages and
  flows along the edges; distrust starts at hosts with blocked pages and flows
  against them: who links to a bad host is bad.  The seeds' weights are their
  numbers of allowed and blocked pages.
* A host is blocked if distrust makes up more than ``threshold`` of its trust
  and distrust together.  Hosts that neither reaches are allowed.

Only DataFrame functions are used.  Pages are reduced to hosts and distinct,
weighted host edges first, combined map-side, so a host with a third of all
pages is one row.  Each round is a join and a sum over host edges, trust and
distrust together; a table is written to the shared folder every few rounds.  The
tasks of a round follow the rows of edges and seeds: with the session's shuffle
partitions, a number that suits pages, each of some 90 rounds would write that many shuffle
files for a few thousand hosts.  Rounds go
on until a table holds no host that the one before lacks and their masses, one
of trust and one of distrust in all, differ by at most ``SETTLED`` in sum; a
round shrinks that by the damping.  Mass at a host without edges onwards is
lost.
The hosts' verdicts are written and joined back to the pages: broadcast where
their real size allows, else by a sort-merge join that splits crowded hosts.

Defined results: a null URL, or one without ``://``, has empty host and path,
fits no rule and is allowed; a null html has no links; repeated rows count as
pages of their own; without seeds everything else is allowed.  Columns named host, path,
rule or verdict are replaced by the results; all others but html pass through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (rule, verdict): a rule is a host and a path.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
         ("com/fr/", "allow"), ("com/de/", "block"))
DAMPING, SETTLED, ROUNDS_PER_TABLE, THRESHOLD = 0.85, 1e-6, 8, 0.5
ROWS_PER_TASK = 50_000
LINK = r"""(?i)(?:href|src|action)\s*=\s*["']?(?:https?:)?//([^/?#"'\s<>]+)"""


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _fits(rule: str, host: Column, path: Column) -> Column:
    of, slash, rest = rule.partition("/")
    return ((host == of) | host.endswith("." + of)) & path.startswith(slash + rest)


def parsed(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, url: str = "url",
           by_rule: str = "by_rule") -> DataFrame:
    """``pages`` with host, path, the rule that decides and, in ``by_rule``, its verdict (null where none fits)."""
    rows = pages.withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    rule = verdict = F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # the longest is asked first
        fits = _fits(text, F.col("host"), F.col("path"))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rows.withColumn("rule", rule).withColumn(by_rule, verdict)


def host_edges(pages: DataFrame, html: str = "html") -> DataFrame:
    """(src, dst, weight) over different hosts; ``pages`` has a column host."""
    linked = F.transform(F.regexp_extract_all(F.col(html), F.lit(LINK), F.lit(1)),
                         lambda host: F.translate(host, UPPER, LOWER))
    links = (pages.select(F.col("host").alias("src"), F.explode(F.array_distinct(linked)).alias("dst"))
             .where("src <> dst and src <> ''").groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight")))
    names = pages.select("host").union(links.select("dst")).where("host <> ''").distinct()
    # every domain above a host, two labels at least, with the one below it
    labels = F.split("host", r"\.")
    steps = F.transform(F.sequence(F.lit(1), F.size(labels) - 2),
                        lambda i: F.struct(F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("low"),
                                           F.array_join(F.slice(labels, i + 1, F.size(labels)), ".").alias("high")))
    tree = (names.where(F.size(labels) > 2).select(F.explode(steps).alias("s")).select("s.low", "s.high").distinct())
    both = tree.select(F.col("low").alias("src"), F.col("high").alias("dst")).union(tree.select("high", "low"))
    return (links.union(both.withColumn("weight", F.lit(1.0)))
            .groupBy("src", "dst").agg(F.sum("weight").alias("weight")))


def propagated(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, settled: float = SETTLED) -> DataFrame:
    """(host, trust, distrust) from edges (src, dst, weight) and seeds (host, allowed, blocked)."""
    edges, seeds = written(edges, "edges"), written(seeds.where("allowed + blocked > 0"), "seeds")
    tasks = max(1, -(-(edges.count() + seeds.count()) // ROWS_PER_TASK))

    def dealt(df: DataFrame) -> DataFrame:
        few = tasks < int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return df.coalesce(tasks) if few else df

    way = [edges.select(F.lit(kind).alias("kind"), F.col(a).alias("src"), F.col(b).alias("dst"), "weight")
           for kind, a, b in (("trust", "src", "dst"), ("distrust", "dst", "src"))]
    ways = way[0].union(way[1])
    out = ways.groupBy("kind", "src").agg(F.sum("weight").alias("all"))
    ways = dealt(written(dealt(ways.join(out, ["kind", "src"]).select(
        F.col("kind").alias("way"), "src", "dst", (F.col("weight") / F.col("all")).alias("share"))), "host-edges"))
    start = seeds.select("host", F.expr("stack(2, 'trust', allowed, 'distrust', blocked) as (kind, n)")).where("n > 0")
    total = start.groupBy("kind").agg(F.sum("n").alias("total"))  # two rows
    start = dealt(written(dealt(start.join(F.broadcast(total), "kind").select(
        "kind", "host", (F.col("n") / F.col("total")).alias("mass"))), "start"))
    mass, change, fresh = start, 1.0, 1
    while fresh or change > settled:
        before = mass
        for _ in range(ROUNDS_PER_TABLE):
            at = mass.select("kind", "host", "mass")
            sent = (at.join(ways, (F.col("kind") == F.col("way")) & (F.col("host") == F.col("src")))
                    .select("kind", F.col("dst").alias("host"), (F.col("mass") * F.col("share") * damping).alias("mass")))
            mass = dealt(sent.union(start.select("kind", "host", (F.col("mass") * (1 - damping)).alias("mass")))
                         .groupBy("kind", "host").agg(F.sum("mass").alias("mass")))
        mass = dealt(written(mass, "trust"))
        old = before.select("kind", "host", F.col("mass").alias("old"))
        change, fresh = mass.join(old, ["kind", "host"], "left").agg(  # hosts never leave
            F.coalesce(F.sum(F.abs(F.col("mass") - F.coalesce("old", F.lit(0.0)))), F.lit(0.0)),
            F.count_if(F.col("old").isNull())).first()
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("mass")).otherwise(0.0)).alias(kind)
    return mass.groupBy("host").agg(of("trust"), of("distrust"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, url: str = "url", html: str = "html",
          threshold: float = THRESHOLD, settled: float = SETTLED) -> DataFrame:
    """``pages`` without html, with host, path, rule and verdict, which replace columns of these names."""
    told, bad_host = free_name(pages.columns, "by_rule"), free_name(pages.columns, "__bad")
    marked = parsed(pages.drop(*{"host", "path", "rule", "verdict"} - {url, html}), rules, url, told)
    seeds = marked.where("host <> ''").groupBy("host").agg(
        F.count_if(F.col(told) == "allow").alias("allowed"), F.count_if(F.col(told) == "block").alias("blocked"))
    scores = propagated(host_edges(marked, html), seeds, settled=settled)
    bad = written(scores.where(F.col("distrust") > F.lit(threshold) * (F.col("trust") + F.col("distrust")))
                  .select(F.col("host").alias(bad_host)), "bad-hosts")
    judged = marked.drop(html).join(bad, F.col("host") == F.col(bad_host), "left")
    by_host = F.when(F.col(bad_host).isNotNull(), "block").otherwise("allow")
    return judged.withColumn("verdict", F.coalesce(told, by_host)).drop(bad_host, told)
