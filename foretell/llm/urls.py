"""URL verdicts from rules and from a path-template tree for each host.

The tree grows level by level on counts of distinct (host, path) branches, not on pages:
a segment with a digit, or one of very many rare ones under its parent, becomes a wildcard
``*``. Below ``LEVELS`` it goes on as long as a template has several branches; what is left
of a single one folds into ``**``. Sibling templates of a parent whose share
of blocked pages does not differ by two standard errors are merged. Labels are the pages
that a rule judges and the urls given as labelled. A host's share of blocked pages is smoothed towards its domain's (last
two names), the domain's towards that of all pages, and a template's towards the middle
between its host's and one half: other branches of a host are a hint, but without labels
of its own no template reaches ``THRESHOLD``, from which it is rejected.

Cases: a null url and one without ``://`` have an empty host and path, which no rule fits;
they share one template. Repeated rows get equal verdicts; null ids keep their rows. An
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foretell.llm.common import stored

LEVELS, STRENGTH, THRESHOLD, ERRORS = 3, 5.0, 0.8, 2.0
#: Children of a parent from which on rare ones, with less than the share, are wildcards.
MANY, RARE = 20, 0.05


def host_of(url: Column) -> Column:
    """Behind the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z in lower case."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """Behind the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule (host, path, verdict) that fits; nulls without one.

    ``rules`` is a short list written in the job; it becomes part of the expression.
    """
    rule = verdict = F.lit(None).cast("string")
    for name, start, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        rule = F.when(fits, name + start).otherwise(rule)
        verdict = F.when(fits, says).otherwise(verdict)
    return rule, verdict


def template_tree(branches: DataFrame) -> DataFrame:
    """host, path, template for rows host, path, n (pages)."""
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    level = branches.select("host", "path", "n", segments.alias("segments"), F.lit("").alias("template"))
    for depth in range(LEVELS):
        level = _next_level(level, depth)
    level, depth = stored(level, "templates"), LEVELS
    out = level.where(F.size("segments") <= depth).select("host", "path", "template")
    growing = level.where(F.size("segments") > depth)
    while not growing.isEmpty():
        lone = growing.groupBy("host", "template").agg((F.count("*") == 1).alias("lone"))
        growing = growing.join(lone, ["host", "template"])
        folded = growing.where("lone").select("host", "path", F.concat("template", F.lit("/**")).alias("template"))
        level, depth = stored(_next_level(growing.where("not lone").drop("lone"), depth), "templates"), depth + 1
        out = out.unionByName(folded).unionByName(level.where(F.size("segments") <= depth).select("host", "path", "template"))
        growing = level.where(F.size("segments") > depth)
    return out


def _next_level(level: DataFrame, depth: int) -> DataFrame:
    """The rows with the next segment, or a wildcard for it, at the end of their templates."""
    own = F.get("segments", F.lit(depth))
    level = level.withColumn("segment", F.when(own.isNull(), "").when(own.rlike("[0-9]"), "*").otherwise(own))
    parent = Window.partitionBy("host", "template")
    children = (
        level.groupBy("host", "template", "segment")
        .agg(F.sum("n").alias("pages"))
        .withColumns({"children": F.count("*").over(parent), "all_pages": F.sum("pages").over(parent)})
    )
    rare = (F.col("children") > MANY) & (F.col("pages") < RARE * F.col("all_pages")) & (F.col("segment") != "")
    named = children.select("host", "template", "segment", F.when(rare, "*").otherwise(F.col("segment")).alias("name"))
    return level.join(named, ["host", "template", "segment"]).withColumn(
        "template", F.when(F.col("name") == "", F.col("template")).otherwise(F.concat("template", F.lit("/"), "name"))
    ).drop("segment", "name")


def _share(blocked: Column, labelled: Column, prior: Column) -> Column:
    return (blocked + STRENGTH * prior) / (labelled + STRENGTH)


def template_shares(counts: DataFrame) -> DataFrame:
    """host, template, branch (smallest of the merged templates), share (smoothed, blocked).

    ``counts``: host, template, labelled, blocked.
    """
    sums = (F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    domain = F.substring_index("host", ".", -2)
    total = counts.agg(*sums).select(
        _share(F.coalesce("blocked", F.lit(0)), F.coalesce("labelled", F.lit(0)), F.lit(0.5)).alias("all_share")
    )
    domains = (
        counts.groupBy(domain.alias("domain"))
        .agg(*sums)
        .crossJoin(F.broadcast(total))  # one row
        .select("domain", _share(F.col("blocked"), F.col("labelled"), F.col("all_share")).alias("domain_share"))
    )
    hosts = (
        counts.groupBy("host")
        .agg(*sums)
        .withColumn("domain", domain)
        .join(domains, "domain")
        .select("host", _share(F.col("blocked"), F.col("labelled"), F.col("domain_share")).alias("host_share"))
    )
    hinted = counts.join(hosts, "host").withColumn("prior", (F.col("host_share") + 0.5) / 2)
    own = hinted.withColumns(
        {
            "parent": F.regexp_replace("template", r"/[^/]*$", ""),
            "own_share": _share(F.col("blocked"), F.col("labelled"), F.col("prior")),
        }
    )
    own = own.withColumn("error", F.sqrt(F.col("own_share") * (1 - F.col("own_share")) / (F.col("labelled") + STRENGTH)))
    siblings = Window.partitionBy("host", "parent").orderBy("own_share", "template")
    apart = (F.col("own_share") - F.lag("own_share").over(siblings)) > ERRORS * F.sqrt(
        F.pow("error", F.lit(2)) + F.pow(F.lag("error").over(siblings), F.lit(2))
    )
    merged = own.withColumn("apart", F.coalesce(apart.cast("int"), F.lit(0))).withColumn(
        "group", F.sum("apart").over(siblings.rowsBetween(Window.unboundedPreceding, 0))
    )
    branch = Window.partitionBy("host", "parent", "group")
    return merged.select(
        "host",
        "template",
        F.min("template").over(branch).alias("branch"),
        _share(F.sum("blocked").over(branch), F.sum("labelled").over(branch), F.col("prior")).alias("share"),
    )


def judge(
    pages: DataFrame,
    rules: list[tuple[str, str, str]],
    id_col: str = "page_id",
    url_col: str = "url",
    labelled: DataFrame | None = None,
) -> DataFrame:
    """page_id, host, path, rule, verdict, template, branch, block_share for each row.

    ``labelled``: urls (``url_col``) with ``blocked``, 0 or 1, that the tree learns from besides
    the pages that a rule judges; they need not be among the pages, other values are no label.
    """
    url = F.col(url_col)
    parsed = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    parsed = parsed.select("*", rule.alias("rule"), says.alias("says"))
    # all counting is on distinct branches
    branches = parsed.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.count("says").alias("labelled"), F.count_if(F.col("says") == "block").alias("blocked")
    )
    if labelled is not None:
        given = F.col("blocked").cast("int")
        told = labelled.where(given.isin(0, 1)).select(
            host_of(url).alias("host"), path_of(url).alias("path"),
            F.lit(0).alias("n"), F.lit(1).alias("labelled"), given.alias("blocked"),
        )
        branches = (
            branches.unionByName(told)
            .groupBy("host", "path")
            .agg(*(F.sum(c).alias(c) for c in ("n", "labelled", "blocked")))
        )
    tree = template_tree(branches)
    counts = (
        branches.join(tree, ["host", "path"])
        .groupBy("host", "template")
        .agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    )
    found = tree.join(template_shares(counts), ["host", "template"])
    method = F.when(F.col("share") >= THRESHOLD, "block").otherwise("allow")
    return parsed.join(found, ["host", "path"]).select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("says", method).alias("verdict"),
        "template",
        "branch",
        F.col("share").alias("block_share"),
    )
