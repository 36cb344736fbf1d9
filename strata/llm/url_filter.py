"""URL filter: host reputation by empirical Bayes, with list rules on top (operator 9, DataFrame only).

Labelled page outcomes (bad or not) are counted per host.  Each host's bad rate
is shrunk towards its registered domain, the domain towards its suffix and the
suffix towards the whole corpus: at each level the parent's posterior mean is
the mean of a beta prior whose strength comes from the level's own spread
(method of moments).  A host is blocked when the lower bound of its posterior
exceeds ``threshold``.  List rules (host plus path prefix) override that.

Defined results: a NULL url, or one without ``://``, has an empty host and
path, and gets the verdict of the empty host; a page without an outcome counts
for nothing; a corpus without outcomes has the bad rate 0.5 and no narrow
bound, so nothing is blocked; repeated rows count as often as they occur;
other columns pass through, those named like an added one give way.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut, quoted

# Suffixes of more than one label under which names are registered.
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au",
                 "co.jp", "ne.jp", "or.jp", "com.br", "co.in", "co.nz", "co.za", "com.cn", "com.tr")

STRENGTH_MIN, STRENGTH_MAX = 1.0, 1000.0
MADE = ("host", "path", "n", "k", "mean", "bound", "rule", "verdict")


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; only A-Z are lowered."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_levels(host: Column, long_suffixes: Sequence[str] = LONG_SUFFIXES) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host; a port is not part of either."""
    name = F.regexp_replace(host, r":[0-9]*$", "")
    last = [F.substring_index(name, ".", -i) for i in (1, 2, 3)]
    is_long = last[1].isin(*long_suffixes)
    return F.when(is_long, last[2]).otherwise(last[1]), F.when(is_long, last[1]).otherwise(last[0])


def _strength(nodes: DataFrame) -> float:
    """Prior strength of one level from the spread of its rates around their parents' means.

    Under a beta-binomial, E[n (k/n - m)^2] = m (1-m) (1 + (n-1) rho) with
    rho = 1 / (strength + 1); summing over the level and solving gives rho.
    """
    m = F.col("parent_mean")
    q, v, w = nodes.filter("n > 0").agg(
        F.sum(F.col("n") * F.pow(F.col("k") / F.col("n") - m, 2)),
        F.sum(m * (1 - m)), F.sum(m * (1 - m) * (F.col("n") - 1))).first()
    if not w:
        return STRENGTH_MAX
    rho = min(max((q - v) / w, 1 / (STRENGTH_MAX + 1)), 1 / (STRENGTH_MIN + 1))
    return 1 / rho - 1


def _posterior(nodes: DataFrame) -> DataFrame:
    s = _strength(nodes)
    return (nodes.withColumn("a", F.col("k") + s * F.col("parent_mean"))
            .withColumn("total", F.col("n") + s)
            .withColumn("mean", F.col("a") / F.col("total")))


def host_reputation(outcomes: DataFrame, z: float = 1.645,
                    long_suffixes: Sequence[str] = LONG_SUFFIXES) -> DataFrame:
    """One row per host of ``outcomes`` (host, bad): n, k, posterior mean and its lower bound.

    ``bad`` is 1, 0 or NULL (not labelled).  Only one-row totals come to the driver.
    """
    domain, suffix = host_levels(F.col("host"), long_suffixes)
    hosts = cut(outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("bigint").alias("k"))
                .withColumns({"domain": domain, "suffix": suffix}), "host-counts")
    counts = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    n, k = hosts.agg(*counts).first()
    top = ((k or 0) + 0.5) / ((n or 0) + 1)
    suffixes = _posterior(hosts.groupBy("suffix").agg(*counts).withColumn("parent_mean", F.lit(top)))
    domains = _posterior(hosts.groupBy("domain", "suffix").agg(*counts)
                         .join(suffixes.select("suffix", F.col("mean").alias("parent_mean")), "suffix"))
    leaf = _posterior(hosts.join(domains.select("domain", "suffix", F.col("mean").alias("parent_mean")),
                                 ["domain", "suffix"]))
    sd = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("total") + 1))
    return leaf.select("host", "n", "k", "mean", (F.col("mean") - z * sd).alias("bound"))


def rule_table(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules ``(verdict, host, path)`` as a table; the printed rule is host plus path."""
    rows = [(h + p, h, p, v, len(h + p)) for v, h, p in rules]
    return spark.createDataFrame(rows, "rule string, rule_host string, rule_path string, rule_verdict string, rule_len int")


def rules_by_host(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """For each host the rules of the host itself and of the domains above it (an equi-join on host endings)."""
    labels = F.split(F.col("host"), r"\.")
    endings = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."))
    return (hosts.select("host", F.explode(endings).alias("rule_host")).join(rules, "rule_host")
            .groupBy("host").agg(F.collect_set(F.struct("rule_len", "rule", "rule_path", "rule_verdict")).alias("rules")))


def filter_urls(pages: DataFrame, outcome: Column, rules: Sequence[tuple[str, str, str]],
                url: str = "url", threshold: float = 0.5, z: float = 1.645) -> DataFrame:
    """``pages`` plus host, path, the host's outcomes (n, k bad), posterior mean and bound, rule and verdict.

    ``outcome`` is a column over ``pages``: 1 bad, 0 good, NULL unlabelled.
    A hot host is one row of the reputation table, which is written with the
    host's rules; pages, which are many, meet it in a join of plain tables
    that can split them.
    """
    rest = [c for c in pages.columns if c.lower() not in MADE]
    # Apart, not as one struct: a column that nobody asks for is then not computed on this side.
    held = [c.alias(f"__page{i}") for i, c in enumerate(quoted(rest))]
    named = pages.select(*held, url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"), outcome.cast("bigint").alias("bad"))
    rep = cut(host_reputation(named.select("host", "bad"), z), "host-reputation")
    listed = rules_by_host(rep.select("host"), rule_table(pages.sparkSession, rules))
    known = cut(rep.join(listed, "host", "left"), "host-rules")
    fits = F.filter("rules", lambda r: F.startswith(F.col("path"), r["rule_path"]))
    best = F.array_max(F.transform(fits, lambda r: F.struct(r["rule_len"], r["rule"], r["rule_verdict"])))
    return (named.join(known, "host", "left").withColumn("best", best)
            .select(*[F.col(f"__page{i}").alias(c) for i, c in enumerate(rest)], "host", "path", "n", "k", "mean", "bound", F.col("best.rule").alias("rule"),
                    F.coalesce(F.col("best.rule_verdict"), F.when(F.col("bound") > threshold, "block").otherwise("allow")).alias("verdict")))


def junk_outcome(html: Column, share: float = 0.25) -> Column:
    """A weak label from the page itself: 1 when junk marks follow at least ``share`` of its words.

    Marks are runs of three of one of ``% $ * #`` or three ``&amp;``.  NULL html is unlabelled.
    """
    marks = F.regexp_count(html, F.lit(r"%%%|\$\$\$|\*\*\*|###|&amp;&amp;&amp;"))
    words = F.regexp_count(html, F.lit(" ")) + 1
    return F.when(html.isNotNull(), (marks >= share * words).cast("bigint"))


def oracle(rules: Sequence[tuple[str, str, str]], share: float = 0.25, z: float = 1.645, threshold: float = 0.5) -> str:
    """``filter_urls`` over ``pages`` with ``junk_outcome`` as the label, as DuckDB SQL."""
    long_suffixes = ", ".join(f"'{s}'" for s in LONG_SUFFIXES)
    values = ", ".join(f"('{h + p}', '{h}', '{p}', '{v}')" for v, h, p in rules)

    def level(name: str, nodes: str) -> str:
        """Posterior of one level; ``nodes`` gives node, n, k and the parent's mean m."""
        return f"""
{name}_n AS ({nodes}),
{name}_s AS (SELECT CASE WHEN w IS NULL OR w = 0 THEN {STRENGTH_MAX}
                         ELSE 1 / least(greatest((q - v) / w, 1 / {STRENGTH_MAX + 1}), 1 / {STRENGTH_MIN + 1}) - 1 END AS s
  FROM (SELECT sum(n * pow(k / n - m, 2)) AS q, sum(m * (1 - m)) AS v, sum(m * (1 - m) * (n - 1)) AS w FROM {name}_n WHERE n > 0)),
{name} AS (SELECT *, (k + s * m) / (n + s) AS mean, n + s AS total FROM {name}_n, {name}_s)"""

    return f"""
WITH p AS (SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
    CASE WHEN html IS NOT NULL THEN CAST(len(regexp_extract_all(html, '%%%|\\$\\$\\$|\\*\\*\\*|###|&amp;&amp;&amp;'))
      >= {share} * (len(html) - len(replace(html, ' ', '')) + 1) AS BIGINT) END AS bad FROM pages),
h0 AS (SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS k, string_split(regexp_replace(host, ':[0-9]*$', ''), '.') AS parts FROM p GROUP BY host),
h1 AS (SELECT *, array_to_string(parts[-1:], '.') AS l1, array_to_string(parts[-2:], '.') AS l2, array_to_string(parts[-3:], '.') AS l3 FROM h0),
hosts AS (SELECT host, n, k, CASE WHEN l2 IN ({long_suffixes}) THEN l3 ELSE l2 END AS domain,
                 CASE WHEN l2 IN ({long_suffixes}) THEN l2 ELSE l1 END AS suffix FROM h1),
root AS (SELECT (coalesce(sum(k), 0) + 0.5) / (coalesce(sum(n), 0) + 1) AS m FROM hosts),
{level("sfx", "SELECT suffix, sum(n) AS n, sum(k) AS k, any_value(m) AS m FROM hosts, root GROUP BY suffix")},
{level("dom", "SELECT d.*, x.mean AS m FROM (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY ALL) d JOIN sfx x USING (suffix)")},
{level("hst", "SELECT h.*, x.mean AS m FROM hosts h JOIN dom x USING (domain, suffix)")},
rep AS (SELECT host, mean, mean - {z} * sqrt(mean * (1 - mean) / (total + 1)) AS bound FROM hst),
rules AS (SELECT * FROM (VALUES {values}) t(rule, rule_host, rule_path, rule_verdict)),
best AS (SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule, arg_max(rule_verdict, length(rule)) AS rule_verdict
  FROM (SELECT DISTINCT page_id, host, path FROM p)
  JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY ALL)
SELECT p.page_id, p.host, p.path, best.rule,
       coalesce(best.rule_verdict, CASE WHEN rep.bound > {threshold} THEN 'block' ELSE 'allow' END) AS verdict,
       round(rep.mean, 6) AS bad_rate, round(rep.bound, 6) AS bad_bound
FROM p JOIN rep USING (host) LEFT JOIN best ON p.page_id IS NOT DISTINCT FROM best.page_id AND p.host = best.host AND p.path = best.path
"""
