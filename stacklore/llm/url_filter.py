"""Judge URLs by host and path rules and, where none fits, by a tree of path templates per host.

The tree grows one path segment a round, over the distinct (host, path) pairs with their row
and label counts. Below each template of a host, segments fall into classes by shape (numbers,
numbers with an extension, hexadecimal ids, mixed, words):

* a class of at least MANY values is variable: a value with fewer than FEW rows becomes the
  class's wildcard;
* any other value is compared with the rest of its class by a G-test of clean against rejected
  labels; branches that do not differ at the 5 % level merge into the wildcard, the others and
  the only value of a class stay literal;
* what lies below DEPTH segments is one wildcard of its own, so rounds are bounded.

A template's purity is its share of clean labels, smoothed by STRENGTH rows of its host's
share, which is itself smoothed by the share of all hosts. Templates below PURITY are rejected.
Labels are the rows that a rule decides, or a boolean column the caller names.

Each round is two aggregates with map-side combine and one join whose lookup side has one row
per key, so the adaptive plan can split a host with a third of all rows; a round is written, as
the next reads it twice. Two label totals come to the driver.

Defined cases: a null url and one without `://` have empty host and path and are judged by the
template of that host; repeated rows are judged alike and each counts; null ids are kept; with
no label at all nothing is rejected; an empty table gives no rows; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stacklore.session import materialise

DEPTH = 8
MANY = 8
FEW = 4
G_LIMIT = 3.841
STRENGTH = 4.0
PURITY = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Shapes of a path segment; the first that fits counts.
SHAPES = (
    ("number", r"\A[0-9]+\z"),
    ("file", r"\A[0-9]+\.[A-Za-z0-9]+\z"),
    ("hex", r"\A(?=[^0-9]*[0-9])[0-9A-Fa-f-]{8,}\z"),
    ("mixed", r"[0-9]"),
)


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """Between the first `://` and the next `/`, `?`, `#` or the end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting(rules: Iterable[Rule], host: Column, path: Column, field: str) -> Column:
    """`field` of the longest rule that fits, null when none does; of equal lengths the first given."""
    found = F.lit(None).cast("string")
    for rule in sorted(reversed(list(rules)), key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(getattr(rule, field))).otherwise(found)
    return found


def shape_of(segment: Column) -> Column:
    shape = F.lit("word")
    for name, pattern in reversed(SHAPES):
        shape = F.when(segment.rlike(pattern), F.lit(name)).otherwise(shape)
    return shape


def g_statistic(clean: Column, bad: Column, all_clean: Column, all_bad: Column) -> Column:
    """G of one branch against the rest of its class, 0 where a margin is empty."""
    total = (all_clean + all_bad).cast("double")
    sum_of = F.lit(0.0)
    for row_clean, row_bad in ((clean, bad), (all_clean - clean, all_bad - bad)):
        row = (row_clean + row_bad).cast("double")
        for seen, column in ((row_clean, all_clean), (row_bad, all_bad)):
            expected = row * column / F.when(total > 0, total)
            sum_of = sum_of + F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    return 2 * sum_of


def templates(urls: DataFrame) -> DataFrame:
    """(host, path, template, rows, clean, bad) of distinct `urls` (host, path, rows, clean, bad)."""
    tree = materialise(
        urls.withColumn("segments", F.slice(F.split("path", "/"), 2, 1 << 30)).withColumn("template", F.lit("")),
        "url-tree",
    )
    deepest = tree.agg(F.max(F.size("segments"))).first()[0] or 0
    sums = [F.sum(c).alias(c) for c in ("rows", "clean", "bad")]
    for level in range(min(deepest, DEPTH)):
        segment = F.get("segments", F.lit(level))
        placed = tree.withColumn("segment", segment).withColumn("shape", shape_of(F.col("segment")))
        branch = placed.filter("segment is not null").groupBy("host", "template", "shape", "segment").agg(*sums)
        of_class = branch.groupBy("host", "template", "shape").agg(
            F.count(F.lit(1)).alias("values"), F.sum("clean").alias("all_clean"), F.sum("bad").alias("all_bad")
        )
        variable = (F.col("values") >= MANY) & (F.col("rows") < FEW)
        alike = g_statistic(F.col("clean"), F.col("bad"), F.col("all_clean"), F.col("all_bad")) < G_LIMIT
        merged = branch.join(of_class, ["host", "template", "shape"]).select(
            "host", "template", "segment", ((F.col("values") > 1) & (variable | alike)).alias("merged")
        )
        step = F.when(F.col("merged"), F.concat(F.lit("/*"), "shape")).otherwise(F.concat(F.lit("/="), "segment"))
        grown = placed.join(merged, ["host", "template", "segment"], "left").select(
            *[c for c in tree.columns if c != "template"],
            F.when(F.col("segment").isNull(), F.col("template"))
            .otherwise(F.concat("template", step)).alias("template"),
        )
        tree = materialise(grown, "url-tree")
    rest = F.when(F.size("segments") > DEPTH, F.concat("template", F.lit("/**"))).otherwise(F.col("template"))
    return tree.select("host", "path", rest.alias("template"), "rows", "clean", "bad")


def purities(found: DataFrame) -> DataFrame:
    """(host, template, rows, labelled, purity) of every template."""
    total = found.agg(F.sum("clean"), F.sum("bad")).first()
    clean, bad = total[0] or 0, total[1] or 0
    overall = clean / (clean + bad) if clean + bad else 1.0
    by_template = found.groupBy("host", "template").agg(
        *[F.sum(c).alias(c) for c in ("rows", "clean", "bad")]
    )
    by_host = found.groupBy("host").agg(F.sum("clean").alias("host_clean"), F.sum("bad").alias("host_bad")).select(
        "host",
        ((F.col("host_clean") + STRENGTH * overall) / (F.col("host_clean") + F.col("host_bad") + STRENGTH)).alias("host_purity"),
    )
    labelled = F.col("clean") + F.col("bad")
    return by_template.join(by_host, "host").select(
        "host", "template", "rows", labelled.alias("labelled"),
        ((F.col("clean") + STRENGTH * F.col("host_purity")) / (labelled + STRENGTH)).alias("purity"),
    )


def judge(
    pages: DataFrame, rules: Iterable[Rule], label: Column | None = None, id_column: str = "page_id", url: str = "url"
) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity), one row per page.

    `label` is true for rows known to be clean, false for rejected ones, null for others;
    without it the rows a rule decides are the labels.
    """
    rules = list(rules)
    known = (F.lit(None) if label is None else label).cast("boolean")
    named = pages.select(
        pages[id_column].alias("page_id"), host_of(pages[url]).alias("host"), path_of(pages[url]).alias("path"),
        known.alias("label"),
    )
    ruled = named.select(
        "*", fitting(rules, F.col("host"), F.col("path"), "name").alias("rule"),
        fitting(rules, F.col("host"), F.col("path"), "verdict").alias("by_rule"),
    )
    if label is None:
        ruled = ruled.withColumn("label", F.col("by_rule") == "allow")
    urls = ruled.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("label").alias("clean"), F.count_if(~F.col("label")).alias("bad")
    )
    found = templates(urls)
    lookup = found.select("host", "path", "template").join(
        purities(found).select("host", "template", "purity"), ["host", "template"]
    )
    by_method = F.when(F.col("purity") < PURITY, F.lit("block")).otherwise(F.lit("allow"))
    return ruled.join(lookup, ["host", "path"]).select(
        "page_id", "host", "path", "rule", F.coalesce("by_rule", by_method).alias("verdict"), "template", "purity"
    )
