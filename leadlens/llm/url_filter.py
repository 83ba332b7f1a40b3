"""URL filter: host rules, then a path-template tree with smoothed labelled purity.

Rules (a host with all its subdomains, and a path prefix) judge a url first; the longest one wins.
The rest is judged by templates learned from all urls, where the urls under a rule are the labelled
ones. Per host, paths are read segment by segment. A segment stays literal when enough urls share it
and their labels (blocked, allowed, none) differ significantly from those of its siblings; rare
segments and branches that look like their siblings are merged into the wildcard ``*``. The purity of
a template is the blocked share of its labelled urls, smoothed by ``prior`` allowed ones, which alone
guards against thin evidence: a template is rejected when its purity reaches ``reject``, however many of
its urls are unlabelled.

Everything is aggregated by (host, path) before it is shuffled, and each level by (host, template,
segment), so a hot host costs rows of counts only and no group is collected.

Edge cases: a null url, or one without ``://``, has empty host and path and is allowed; below
``max_depth`` segments only prefixes that hold blocked and unlabelled urls are read on, as no other can get
another verdict, and the tail of the others is ``**``; repeated urls are judged alike; an empty table gives
an empty result; only id and url are read, so other columns cannot clash.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, stored

# The rules as stated, in the stated order.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))


@dataclass(frozen=True)
class UrlFilter:
    rules: tuple = RULES
    max_depth: int = 8
    min_urls: int = 5          # fewer urls than that make a segment variable
    differs: float = 5.99      # chi-square, two degrees of freedom, 5 %
    prior: float = 2.0         # allowed urls that the smoothing adds
    reject: float = 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    tail = F.substring(rest, F.length(raw) + 1, F.length(rest))
    return ascii_lower(raw), F.regexp_extract(tail, r"^[^?#]*", 0)


def rule_of(host: Column, path: Column, rules: tuple) -> tuple[Column, Column]:
    """Longest fitting rule and its verdict, both null where none fits (rules are constants of the job)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):  # later, that is longer, ones win
        name, _, rest = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(f"/{rest}"))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def chi_square(part: list[Column], whole: list[Column]) -> Column:
    """Statistic of the 2 x k table (branch, siblings) over label classes."""
    n, total = sum(part[1:], part[0]), sum(whole[1:], whole[0])
    rest = total - n
    cells = []
    for a, t in zip(part, whole, strict=True):
        e1, e2 = t * n / total, t * rest / total
        cells.append(F.when((t > 0) & (rest > 0), F.pow(a - e1, 2) / e1 + F.pow(t - a - e2, 2) / e2).otherwise(0.0))
    return sum(cells[1:], cells[0])


def templates(paths: DataFrame, spec: UrlFilter) -> DataFrame:
    """Adds ``template`` to rows of (host, path, blocked, allowed, unlabelled)."""
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    cur = stored(paths.withColumn("segs", segments).withColumn("template", F.lit("")), "url-paths")
    depth = cur.agg(F.max(F.size("segs"))).first()[0] or 0
    classes, done = ["blocked", "allowed", "unlabelled"], []
    for d in range(depth):
        if d >= spec.max_depth:
            deep = F.size("segs") > d
            mixed = (cur.filter(deep).groupBy("host", "template").agg(*[F.sum(c).alias(c) for c in classes])
                     .filter("blocked > 0 AND unlabelled > 0")
                     .select(F.col("host").alias("k_host"), F.col("template").alias("k_template")))
            split = stored(cur.join(mixed, (F.col("host") == F.col("k_host")) & (F.col("template") == F.col("k_template")), "left")
                           .withColumn("on", deep & F.col("k_host").isNotNull()).drop("k_host", "k_template"), f"url-deep-{d}")
            tail = F.when(deep, F.concat("template", F.lit("/**"))).otherwise(F.col("template"))
            done.append(split.filter(~F.col("on")).withColumn("template", tail).drop("on"))
            cur = split.filter("on").drop("on")
            if cur.isEmpty():
                break
        seg = F.get("segs", F.lit(d))
        child = (cur.filter(F.size("segs") > d).groupBy("host", "template", seg.alias("seg"))
                 .agg(*[F.sum(c).alias(c) for c in classes]))
        whole = child.groupBy("host", "template").agg(*[F.sum(c).alias(f"all_{c}") for c in classes])
        part = [F.col(c) for c in classes]
        total = [F.col(f"all_{c}") for c in classes]
        n, all_n = sum(part[1:], part[0]), sum(total[1:], total[0])
        literal = (n >= spec.min_urls) & ((n == all_n) | (chi_square(part, total) >= spec.differs))
        kept = (child.join(whole, ["host", "template"]).filter(literal)
                .select(F.col("host").alias("k_host"), F.col("template").alias("k_template"), F.col("seg").alias("k_seg")))
        nxt = cur.join(kept, (F.col("host") == F.col("k_host")) & (F.col("template") == F.col("k_template"))
                       & (seg == F.col("k_seg")), "left")
        step = F.when(F.size("segs") > d, F.concat(F.col("template"), F.lit("/"), F.coalesce("k_seg", F.lit("*"))))
        cur = stored(nxt.withColumn("template", F.coalesce(step, F.col("template"))).drop("k_host", "k_template", "k_seg"),
                     f"url-level-{d}")
    for part in done:
        cur = cur.unionByName(part)
    return cur.drop("segs")


def judge(pages: DataFrame, spec: UrlFilter = UrlFilter(), id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per row: id, host, path, rule, verdict, template and the purity that decided."""
    host, path = host_and_path(F.col(url_col))
    df = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), spec.rules)
    df = df.withColumns({"rule": rule, "ruled": verdict})
    paths = df.groupBy("host", "path", "ruled").agg(F.count(F.lit(1)).alias("n"))
    paths = (paths.groupBy("host", "path")
             .agg(F.sum(F.when(F.col("ruled") == "block", F.col("n")).otherwise(0)).alias("blocked"),
                  F.sum(F.when(F.col("ruled") == "allow", F.col("n")).otherwise(0)).alias("allowed"),
                  F.sum(F.when(F.col("ruled").isNull(), F.col("n")).otherwise(0)).alias("unlabelled")))
    learned = templates(paths, spec)
    tree = learned.groupBy("host", "template").agg(F.sum("blocked").alias("bad"), F.sum("allowed").alias("good"))
    labelled = F.col("bad") + F.col("good")
    tree = tree.select("host", "template", (F.col("bad") / (labelled + F.lit(spec.prior))).alias("purity"))
    chosen = (learned.select("host", "path", "template").join(tree, ["host", "template"])
              .withColumnsRenamed({"host": "c_host", "path": "c_path"}))
    out = df.join(chosen, (F.col("host") == F.col("c_host")) & (F.col("path") == F.col("c_path")), "left")
    bad = (F.col("host") != "") & (F.col("purity") >= spec.reject)
    own = F.when(bad, F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", "rule", F.coalesce(F.col("ruled"), own).alias("verdict"),
                      "template", "purity")
