"""URL rules by hashed expressions, in DataFrame functions only.

Every URL is expanded into host-suffix x path-prefix expressions, but only of the shapes that
occur among the rules (label counts of hosts, lengths of paths).  Expressions meet the rules in
an equi-join on a short prefix of their SHA-256; the full digests then confirm a hit, and the
longest confirmed rule decides.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Hex digits of the digest that the join compares.
PREFIX_DIGITS = 8
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]] = RULES) -> DataFrame:
    """(host, path, verdict) rules as a frame of literals."""
    rows = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules]
    if not rows:
        return spark.range(0).select(*[F.lit("").alias(c) for c in ("host", "path", "verdict")])
    return spark.range(1).select(F.inline(F.array(*rows)))


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def judge_urls(pages: DataFrame, rules: DataFrame, id_column: str = "page_id", url_column: str = "url", default: str = "allow") -> DataFrame:
    """``id_column``, ``host``, ``path``, ``rule`` and ``verdict`` of every row.

    A rule fits its host and all subdomains if the path starts with the rule's path; the longest
    rule (host + path) wins, then the longer host, then ``block``.  URLs that no rule fits, null
    URLs and texts without ``://`` get no rule and the ``default`` verdict.  Repeated rows and null
    ids stay; other columns are not read.  Rules with a null field or an empty host fit nothing.

    Hosts and paths are expanded once per distinct pair, so a hot URL or host does not multiply
    the join; the verdicts then come back by (host, path), where AQE splits a hot pair.
    """
    host, path = split_url(F.col(f"`{url_column}`").cast("string"))
    urls = pages.select(F.col(f"`{id_column}`").alias(id_column), host.alias("host"), path.alias("path"))
    known = rules.select("host", "path", "verdict").where(
        F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("verdict").isNotNull() & (F.col("host") != "")
    )
    # Shapes are numbers bounded by the longest host and path among the rules.
    shapes = known.agg(F.collect_set(F.size(F.split("host", r"\."))), F.collect_set(F.length("path"))).first()
    if not shapes[0]:
        return urls.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})

    # Each shape gives an expression only where the URL has it: enough labels, a long enough path.
    labels, expressions = F.size(F.split("host", r"\.")), []
    for n in sorted(shapes[0]):
        for length in sorted(shapes[1]):
            fits = (labels >= n) & (F.length("path") >= length)
            expressions.append(F.when(fits, F.concat(F.substring_index("host", ".", -n), F.substring("path", 1, length))))
    expanded = (
        urls.where(F.col("host") != "")
        .select("host", "path")
        .distinct()
        .select("host", "path", F.explode(F.array_compact(F.array(*expressions))).alias("expression"))
        .select("host", "path", F.sha2("expression", 256).alias("digest"))
        .withColumn("short", F.substring("digest", 1, PREFIX_DIGITS))
    )
    keyed = known.select(
        F.sha2(F.concat("host", "path"), 256).alias("rule_digest"),
        F.concat("host", "path").alias("rule"),
        F.length("host").alias("host_length"),
        F.col("verdict").alias("rule_verdict"),
    ).withColumn("short", F.substring("rule_digest", 1, PREFIX_DIGITS))
    ranked = F.struct(F.length("rule"), "host_length", (F.col("rule_verdict") == "block").alias("blocks"), "rule", "rule_verdict")
    found = (
        expanded.join(keyed, "short")
        .where(F.col("digest") == F.col("rule_digest"))
        .groupBy("host", "path")
        .agg(F.max(ranked).alias("best"))
        .select(F.col("host").alias("found_host"), F.col("path").alias("found_path"), "best.rule", "best.rule_verdict")
    )
    same = (F.col("host") == F.col("found_host")) & (F.col("path") == F.col("found_path"))
    return urls.join(found, same, "left").select(id_column, "host", "path", "rule", F.coalesce("rule_verdict", F.lit(default)).alias("verdict"))


SQL = """
    WITH rules(rule_host, rule_path, rule, rule_verdict) AS (VALUES
        ('net', '/', 'net/', 'block'), ('example.net', '/en/', 'example.net/en/', 'allow'),
        ('example.com', '/de/', 'example.com/de/', 'block'), ('org', '/fr/', 'org/fr/', 'allow')),
    cut AS (
        SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    urls AS (
        SELECT row_number() OVER () AS k, page_id,
               translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path
        FROM cut),
    best AS (
        SELECT k, arg_max(rule, length(rule)) AS rule, arg_max(rule_verdict, length(rule)) AS rule_verdict
        FROM urls JOIN rules
          ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        GROUP BY k)
    SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict
    FROM urls LEFT JOIN best USING (k)
"""
