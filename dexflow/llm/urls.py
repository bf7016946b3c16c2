"""URL filters: host-suffix and path-prefix expressions joined with rules on short hash prefixes.

Native: DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: First group: host, second group: path.
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://`` or for null."""
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """Rules given as (``host/path``, ``allow`` or ``block``) as a table ``rule, verdict``."""
    rows = [F.struct(F.lit(r).alias("rule"), F.lit(v).alias("verdict")) for r, v in rules]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*") if rows else \
        spark.range(0).select(F.lit("").alias("rule"), F.lit("").alias("verdict"))


def prepared_rules(rules: DataFrame) -> DataFrame:
    """Rules with host, path, and digests. A rule is ``host`` or ``host/dir/.../``.

    The path must be empty or end in ``/`` (a rule speaks for a directory); a
    null rule or one of another form raises ValueError. The same rule given twice with
    different verdicts blocks.
    """
    r = rules.select(F.col("rule"), F.col("verdict")).groupBy("rule").agg(F.max("verdict").alias("verdict"))
    at = F.locate("/", F.col("rule"))
    r = (r.withColumn("rule_host", F.when(at > 0, F.substring_index("rule", "/", 1)).otherwise(F.col("rule")))
         .withColumn("rule_path", F.when(at > 0, F.expr("substring(rule, locate('/', rule))")).otherwise(F.lit(""))))
    bad = r.where("rule is null or rule_host = '' or verdict is null or verdict not in ('allow', 'block') "
                  "or not (rule_path = '' or rule_path like '%/')").limit(1).collect()
    if bad:
        raise ValueError(f"not a rule: {bad[0]['rule']!r} {bad[0]['verdict']!r}")
    lowered = F.concat(F.translate("rule_host", UPPER, LOWER), F.col("rule_path"))
    return r.withColumn("digest", F.sha2(lowered, 256)).withColumn("short", F.substring("digest", 1, 8))


def expressions(urls: DataFrame, labels: int, depth: int) -> DataFrame:
    """``url, digest, short`` for every host suffix joined with every path prefix of each url.

    Suffixes have at most ``labels`` labels and prefixes at most ``depth``
    slashes: the most that any rule has, so nothing a rule could match is left out, and
    a url of ten thousand slashes does not make ten thousand prefixes.
    """
    parts = urls.select("url", F.split(url_host(F.col("url")), r"\.", -1).alias("host"),
                        F.split(url_path(F.col("url")), "/", -1).alias("dirs"))
    hosts = F.expr(f"transform(sequence(greatest(1, size(host) - {labels - 1}), size(host)),"
                   " i -> array_join(slice(host, i, size(host)), '.'))")
    paths = F.expr(f"concat(array(''), case when size(dirs) < 2 or {depth} = 0 then array() else "
                   f"transform(sequence(1, least({depth}, size(dirs) - 1)),"
                   " i -> concat(array_join(slice(dirs, 1, i), '/'), '/')) end)")
    out = (parts.select("url", F.explode(hosts).alias("h"), paths.alias("paths"))
           .select("url", F.explode("paths").alias("p"), "h")
           .select("url", F.sha2(F.concat("h", "p"), 256).alias("digest")))
    return out.withColumn("short", F.substring("digest", 1, 8))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict for each ``url``.

    A rule fits its host and all its subdomains, if the url's path starts with the rule's
    path. The longest rule that fits gives the verdict, ``default`` where none
    fits (rule null). Expressions are made once per distinct url and meet the
    rules on eight hex digits of their SHA-256; the full digest then confirms. Columns of
    ``pages`` named host, path, rule or verdict are replaced, others kept. A null or
    malformed url has empty host and path and fits no rule; repeated rows stay, each with
    its verdict; empty tables give no rows.
    """
    r = prepared_rules(rules)
    most = r.agg(F.max(F.size(F.split("rule_host", r"\."))).alias("labels"),
                 F.max(F.size(F.split("rule_path", "/")) - 1).alias("depth")).first()
    names = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    base = pages.select(*names).withColumns({"host": url_host(F.col("url")), "path": url_path(F.col("url"))})
    if most["labels"] is None:
        return base.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    seen = base.where("host <> ''").select("url").distinct()
    r = r.select("rule", "verdict", F.col("digest").alias("full"), F.col("short"))
    hits = (expressions(seen, most["labels"], most["depth"]).join(r, "short").where("digest = full")
            .groupBy("url").agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict")).alias("best")))
    hits = saved(hits.select("url", "best.rule", "best.verdict"), "url-hits")
    # Both sides grow with the input, so the join is the same at every size: never a broadcast.
    return base.join(hits.hint("merge"), "url", "left").select(
        *names, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
