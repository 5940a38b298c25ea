"""Site-relative line dedup: drop lines that stand on too large a share of a host's pages.

Per host, the pages that hold a line (trimmed of spaces, blank lines apart)
are divided by the host's pages in all.  A line above ``ratio`` is boilerplate
and is dropped from every page of that host; all other lines stay, in order.
On a small host a single page exceeds any ratio, so there the ratio rises to
``min_pages`` of the host's pages, to all of them on a host with fewer, and two
pages at least.

Only DataFrame functions are used.  Counting shuffles one digest per distinct
line of a page, combined map-side, so a host with a third of all pages, or a
line on all of them, is no hot spot.  At most ``lines per page / ratio`` lines
of a host can be boilerplate (each takes up a share ``ratio`` of its pages),
so one short array per host is joined back to the pages.  That table is
written first; Spark broadcasts it where its real size allows and otherwise
runs a sort-merge join, whose crowded hosts it splits.

Defined results: a null text stays null and has no lines; an empty text stays
empty; pages without a host form a host of their own; a repeated row counts as
a page of its own; a line that repeats within a page counts once and all its
copies go; a text whose lines all go becomes empty.  Extra columns of any name pass
through; a column named like the two counts is refused until they get other names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, written

RATIO = 0.05
MIN_PAGES = 5


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _keys(lines: Column) -> Column:
    """A 128-bit digest of every trimmed line; the empty string for blank ones."""
    return F.transform(lines, lambda line: F.when(F.trim(line) == "", "").otherwise(F.md5(F.trim(line))))


def boilerplate(docs: DataFrame, host: str = "source", text: str = "text",
                ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, drop): the digests of each host's boilerplate lines."""
    pages = docs.select(F.col(host).alias("host"), F.col(text).alias("text"))
    total = pages.groupBy("host").agg(F.count("*").alias("pages"))
    line = pages.select("host", F.explode(F.array_distinct(_keys(_lines(F.col("text"))))).alias("key"))
    seen = (line.where("key <> ''").groupBy("host", "key").agg(F.count("*").alias("n"))
            .where(F.col("n") >= min(min_pages, 2)))
    total = written(total, "host-pages").select(F.col("host").alias("of"), "pages")
    return (seen.join(total, F.col("host").eqNullSafe(F.col("of")))
            .where(F.col("n") > F.lit(ratio) * F.col("pages"))
            .where(F.col("n") >= F.least(F.lit(min_pages), F.col("pages")))
            .groupBy("host").agg(F.collect_set("key").alias("drop")))


def drop_boilerplate(docs: DataFrame, host: str = "source", text: str = "text",
                     ratio: float = RATIO, min_pages: int = MIN_PAGES,
                     n_lines: str = "n_lines", n_dropped: str = "n_dropped") -> DataFrame:
    """``docs`` with ``text`` cleaned, and the numbers of lines it had and lost."""
    if clash := {n_lines.lower(), n_dropped.lower()} & {c.lower() for c in docs.columns}:
        raise ValueError(f"the input already has {sorted(clash)}: pass other names")
    of, gone, lines, keys, hit, left = (free_name(docs.columns, n) for n in (
        "__of", "__drop", "__lines", "__keys", "__hit", "__kept"))
    drop = written(boilerplate(docs, host, text, ratio, min_pages), "boilerplate").select(
        F.col("host").alias(of), F.col("drop").alias(gone))
    keyed = (docs.join(drop, F.col(host).eqNullSafe(F.col(of)), "left")
             .withColumn(lines, _lines(F.col(text))).withColumn(keys, _keys(F.col(lines)))
             .withColumn(hit, F.array_intersect(keys, F.coalesce(gone, F.array().cast("array<string>")))))
    stay = F.filter(F.arrays_zip(lines, keys), lambda x: ~F.array_contains(F.col(hit), x[keys]))
    kept = F.when(F.size(hit) == 0, F.col(lines)).otherwise(F.transform(stay, lambda x: x[lines]))
    own = [F.col(f"`{c}`") for c in docs.columns]
    return (keyed.withColumn(left, kept)
            .select(*[F.array_join(left, "\n").alias(text) if c == text else col
                      for c, col in zip(docs.columns, own)],
                    F.coalesce(F.size(lines), F.lit(0)).cast("long").alias(n_lines),
                    F.coalesce(F.size(lines) - F.size(left), F.lit(0)).cast("long").alias(n_dropped)))
