"""URL filter by path-template trees.

A url is cut into host and path. Longest-prefix rules (host suffix and path
beginning) decide first. Every host has a tree of path templates: a segment of
a fixed kind (number, date, hexadecimal or uuid; with its file extension)
becomes that kind's wildcard, a position with many different values for its
urls becomes ``*``, and a branch whose blocked share does not differ
significantly from its siblings' is merged with them into one wildcard branch.
Urls that a rule decides are the labels, and labels alone are evidence: a branch
without any falls to the wildcard, a branch whose siblings have none stays. A template is rejected by its smoothed purity::

    (blocked + PRIOR * the parent's purity) / (labelled + PRIOR)

from the host down, segment by segment; the host's parent has the blocked share
of all labelled urls. So a template with few labels follows its parent. Urls of
a host without any label are allowed: nothing is known of it.

Trees are built level by level from counts of (host, template, segment), which
are aggregated before any shuffle; a hot host's urls meet only in sums, never
in one task.

Defined results: a null url or one without ``://`` has an empty host and path,
no rule fits, and the (empty) host's template decides like any other; rows
count as often as they are repeated; an empty table gives no rows; extra
columns are ignored. Segments beyond ``DEPTH`` form one tail segment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stash

#: (verdict, host, path beginning), the operator's default rules.
RULES = (
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
)
DEPTH = 6
#: A position is variable from this many different values on, if they are this share of its urls.
VARIABLE_VALUES, VARIABLE_SHARE = 20, 0.3
#: Largest z of a branch's blocked share of labels against its siblings' at which it is merged with them.
MERGE_Z = 1.96
PRIOR, PURITY = 4.0, 0.8

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(/[^?#]*)", 1), F.lit(""))


def apply_rules(host: Column, path: Column, rules=RULES) -> Column:
    """struct(verdict, rule) of the longest fitting rule, or null. A rule's
    length is that of its host and path; a tie goes to the first in the list."""
    best = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = (F.concat(F.lit("."), host).endswith("." + rule_host)) & path.startswith(rule_path)
        best = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule_host + rule_path).alias("rule"))).otherwise(best)
    return best


def typed(segment: Column) -> Column:
    """The segment with its variable part as a typed wildcard."""
    kinds = ((r"\d{4}-\d{2}(-\d{2})?", "{date}"), (r"\d+", "{number}"),
             (r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", "{uuid}"), (r"(?=[^.]*\d)[0-9a-fA-F]{8,}", "{hex}"))
    out = segment
    for pattern, kind in reversed(kinds):
        out = F.when(segment.rlike(rf"^{pattern}(\.[A-Za-z0-9]{{1,5}})?$"),
                     F.concat(F.lit(kind), F.regexp_extract(segment, r"(\.[A-Za-z0-9]{1,5})$", 1))).otherwise(out)
    return out


def segments(path: Column) -> Column:
    """Typed segments, without empty ones; beyond DEPTH one tail."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    kept = F.transform(F.slice(parts, 1, DEPTH), typed)
    return F.when(F.size(parts) > DEPTH, F.concat(kept, F.array(F.lit("**")))).otherwise(kept)


def template_counts(judged: DataFrame) -> DataFrame:
    """Urls of one host and typed path as one row: host, segs, urls, blocked,
    labelled. All later work is on these."""
    return judged.groupBy("host", F.array_join("segs", "/").alias("typed_path"), "segs").agg(
        F.count("*").alias("urls"), F.sum((F.col("decided.verdict") == "block").cast("long")).alias("blocked"),
        F.count("decided").alias("labelled")).withColumn("blocked", F.coalesce("blocked", F.lit(0))).drop("typed_path")


def grow_tree(counts: DataFrame) -> DataFrame:
    """Template of every row of ``counts``: the columns host, segs, template,
    urls, blocked, labelled. One level of the tree per step."""
    rows = counts.withColumn("template", F.lit("")).withColumn("done", F.lit(0))
    deepest = counts.agg(F.max(F.size("segs"))).first()[0] or 0
    for level in range(1, deepest + 1):
        here = rows.where(F.size("segs") >= level).withColumn("seg", F.element_at("segs", level))
        branch = here.groupBy("host", "template", "seg").agg(
            F.sum("urls").alias("n"), F.sum("blocked").alias("b"), F.sum("labelled").alias("l"))
        total = branch.groupBy("host", "template").agg(
            F.count("*").alias("values"), F.sum("n").alias("tn"), F.sum("b").alias("tb"), F.sum("l").alias("tl"))
        joined = branch.join(total, ["host", "template"])
        variable = (F.col("values") >= VARIABLE_VALUES) & (F.col("values") >= VARIABLE_SHARE * F.col("tn"))
        # Two-proportion test of a branch's labels against its siblings'. Without own labels it falls to the wildcard.
        rest_l, rest_b, pooled = F.col("tl") - F.col("l"), F.col("tb") - F.col("b"), F.try_divide("tb", "tl")
        error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1), "l") + F.try_divide(F.lit(1), rest_l)))
        z = F.when(error > 0, F.try_divide(F.abs(F.try_divide("b", "l") - F.try_divide(rest_b, rest_l)), error)).otherwise(0.0)
        alike = (F.col("values") > 1) & ((F.col("l") == 0) | ((rest_l > 0) & (z <= MERGE_Z))) & ~F.col("seg").startswith("{")
        step = joined.select("host", "template", "seg", F.when(variable | alike, F.lit("*")).otherwise(F.col("seg")).alias("as_seg"))
        grown = (here.join(step, ["host", "template", "seg"])
                 .withColumn("template", F.concat("template", F.lit("/"), "as_seg")).drop("seg", "as_seg"))
        rows = stash(grown.unionByName(rows.where(F.size("segs") < level)), "url-tree")
    return rows.drop("done")


def judge_templates(tree: DataFrame) -> DataFrame:
    """(host, template, purity, known): purity smoothed along the template's
    parents, and whether its host has labels."""
    prefixes = F.transform(F.sequence(F.lit(0), F.size("segs")), lambda k: F.array_join(F.slice(F.split("template", "/"), 1, k + 1), "/"))
    parts = tree.select("host", "template", F.posexplode(prefixes).alias("depth", "prefix"), "blocked", "labelled")
    sums = parts.groupBy("host", "prefix").agg(F.sum("blocked").alias("b"), F.sum("labelled").alias("l"))
    every = sums.where("prefix = ''").agg(F.coalesce(F.try_divide(F.sum("b"), F.sum("l")), F.lit(0.0)).alias("share"))
    # At most DEPTH + 2 sums a template.
    chains = parts.select("host", "template", "depth", "prefix").distinct().join(sums, ["host", "prefix"]).groupBy("host", "template").agg(
        F.sort_array(F.collect_list(F.struct("depth", "b", "l"))).alias("chain"))
    purity = F.aggregate("chain", F.col("share"), lambda parent, x: (x["b"] + PRIOR * parent) / (x["l"] + PRIOR))
    return chains.crossJoin(F.broadcast(every)).select("host", "template", purity.alias("purity"), (F.get("chain", 0)["l"] > 0).alias("known"))  # one row


def filter_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, template, purity."""
    cut = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = cut.withColumn("decided", apply_rules(F.col("host"), F.col("path"), rules)).withColumn("segs", segments(F.col("path")))
    tree = grow_tree(stash(template_counts(judged), "url-counts"))
    templates = judge_templates(tree)
    verdicts = tree.select("host", "segs", "template").join(templates, ["host", "template"])
    out = judged.join(verdicts, ["host", "segs"])
    return out.select("page_id", "host", "path", F.col("decided.rule").alias("rule"),
                      F.coalesce(F.col("decided.verdict"), F.when(F.col("known") & (F.col("purity") >= PURITY), "block").otherwise("allow")).alias("verdict"),
                      "template", "purity")


def op9_urls(pages: DataFrame) -> DataFrame:
    return filter_urls(pages)
