"""URL filter: longest rule first, then trust and distrust that spread over the host graph.

A rule is a host followed by the beginning of a path. It fits its host and all subdomains; of the
rules that fit, the longest wins. Hosts with pages that rules allow are trusted seeds, hosts with
pages that rules block are distrusted seeds, weighted by the number of these pages. Edges lead from a
page's host to the hosts of its absolute links, weighted by how many links a host has to another;
links within a host count for nothing. Personalised PageRank from the trusted seeds follows the
edges, from the distrusted seeds it goes against them: who links to spam is suspect. A host's share
of distrust is compared with its share of trust: a url without a rule is blocked if its host's
distrust is above ``THRESHOLD`` times its trust, else allowed. A host that neither reaches is allowed.

Rounds go on until no host's share has changed by more than ``TOLERANCE`` of itself. A host reached for
the first time counts as wholly changed, so every host that links lead to gets its share, however far it
lies; the number of rounds is at most about that distance and log(TOLERANCE) / log(DAMPING) more.

Hosts are few against pages, but nothing of the graph comes to the driver, only each round's largest
change: a round is a join and an aggregate over written tables, and a page gets its host's verdict by a
join that Spark can split.

Rows: a null url, or one without ``://``, has empty host and path, no rule, and is allowed; null html
has no links; repeated rows are judged alike; a null page_id is passed on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactlens.llm import common as c

DAMPING = 0.85
TOLERANCE = 1e-4
THRESHOLD = 2.0


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = [
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
]

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def host_of(url: str) -> str:
    return _LOWER.format(f"regexp_extract({url}, '^.*?://([^/?#]*)', 1)")


def with_host_and_path(pages: DataFrame) -> DataFrame:
    """Adds host and path; DOTALL patterns, as a url may hold line breaks."""
    pattern = "'(?s)^.*?://([^/?#]*)([^?#]*)'"
    return pages.selectExpr(
        "*",
        _LOWER.format(f"coalesce(regexp_extract(url, {pattern}, 1), '')") + " AS host",
        f"coalesce(regexp_extract(url, {pattern}, 2), '') AS path",
    )


def with_rule(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds rule and rule_verdict; rules are a short list, so they are one expression."""
    cases = [
        f"WHEN (host = '{r.host}' OR endswith(host, '.{r.host}')) AND startswith(path, '{r.path}')"
        for r in sorted(rules, key=lambda r: (-len(r.name), r.name))
    ]
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.name))
    name = " ".join(f"{w} THEN '{r.name}'" for w, r in zip(cases, ordered, strict=True))
    verdict = " ".join(f"{w} THEN '{r.verdict}'" for w, r in zip(cases, ordered, strict=True))
    return pages.selectExpr("*", f"CASE {name} END AS rule", f"CASE {verdict} END AS rule_verdict")


def host_edges(pages: DataFrame) -> DataFrame:
    """(source, target, weight) between different hosts, from the links in ``html``."""
    found = "regexp_extract_all(html, '(?is)\\\\b(?:href|src)\\\\s*=\\\\s*[\"\\']?\\\\s*((?:https?:)?//[^\"\\'\\\\s>]+)', 1)"
    links = pages.selectExpr("host AS source", f"explode({found}) AS link")
    target = _LOWER.format("regexp_extract(link, '//([^/?#]*)', 1)")
    return (
        links.selectExpr("source", f"{target} AS target")
        .where("source <> '' AND target <> '' AND source <> target")
        .groupBy("source", "target")
        .agg(F.count("*").cast("double").alias("weight"))
    )


def spread(
    edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE
) -> DataFrame:
    """(host, share): personalised PageRank from ``seeds`` (host, share) along (source, target, weight).

    What reaches a host without outgoing edges goes back to the seeds. That only makes all shares larger by
    one factor, so a round adds what walks of one more link bring, and the sums are scaled to 1 at the end.
    ``tolerance`` is the largest addition of the last round to any host, as a part of its sum.
    """
    out = edges.groupBy("source").agg(F.sum("weight").alias("total"))
    steps = c.kept_table(
        edges.join(out, "source").selectExpr("source", "target", "weight / total AS part"), "steps"
    )
    if steps.isEmpty():
        return seeds
    now, i, change = seeds.withColumn("new", F.col("share")), 0, 1.0
    while change > tolerance:
        moved = now.where("new > 0").join(steps, now["host"] == steps["source"])
        moved = moved.selectExpr("target AS host", f"{damping!r}D * new * part AS new")
        now = c.kept_table(
            moved.selectExpr("host", "new AS share", "new")
            .unionByName(now.selectExpr("host", "share", "0D AS new"))
            .groupBy("host")
            .agg(F.sum("share").alias("share"), F.sum("new").alias("new")),
            f"shares-{i}",
        )
        largest = now.where("new > 0").agg(F.max(F.expr("new / share")).alias("change")).first()
        i, change = i + 1, largest["change"] or 0.0
    total = now.agg(F.sum("share").alias("total"))  # one row
    return now.crossJoin(F.broadcast(total)).selectExpr("host", "share / total AS share")


def _seeds(hosts: DataFrame, pages: str) -> DataFrame:
    own = hosts.where(f"{pages} > 0")
    total = own.agg(F.sum(pages).alias("total"))  # one row
    return own.crossJoin(F.broadcast(total)).selectExpr("host", f"{pages} / total AS share")


def host_verdicts(
    pages: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE, threshold: float = THRESHOLD
) -> DataFrame:
    """(host, trust, distrust, host_verdict) from pages with host, rule_verdict and html."""
    hosts = c.kept_table(
        pages.where("host <> ''")
        .groupBy("host")
        .agg(
            F.sum(F.expr("CASE WHEN rule_verdict = 'allow' THEN 1 ELSE 0 END")).alias("allowed"),
            F.sum(F.expr("CASE WHEN rule_verdict = 'block' THEN 1 ELSE 0 END")).alias("blocked"),
        ),
        "hosts",
    )
    edges = c.kept_table(host_edges(pages), "host-edges")
    against = edges.selectExpr("target AS source", "source AS target", "weight")
    trust = spread(edges, _seeds(hosts, "allowed"), damping, tolerance)
    distrust = spread(against, _seeds(hosts, "blocked"), damping, tolerance)
    return (
        hosts.select("host")
        .join(trust.withColumnRenamed("share", "trust"), "host", "left")
        .join(distrust.withColumnRenamed("share", "distrust"), "host", "left")
        .na.fill(0.0, ["trust", "distrust"])
        .withColumn("host_verdict", F.expr(f"CASE WHEN distrust > {threshold} * trust THEN 'block' ELSE 'allow' END"))
    )


def judged_urls(pages: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, and the host's trust and distrust."""
    rows = with_rule(with_host_and_path(c.pick(pages, "page_id", "url", "html")), rules or RULES)
    verdicts = c.kept_table(host_verdicts(rows), "host-verdicts")
    return (
        rows.select("page_id", "host", "path", "rule", "rule_verdict")
        .join(verdicts, "host", "left")
        .selectExpr(
            "page_id", "host", "path", "rule",
            "coalesce(rule_verdict, host_verdict, 'allow') AS verdict", "trust", "distrust",
        )
    )
