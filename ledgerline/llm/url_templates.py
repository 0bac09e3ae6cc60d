"""URL filters: given rules, and a path-template tree for each host that judges what no rule decides.

Segments of a path that vary by their shape (numbers, hexadecimal strings, mixed codes, more than 40
characters) become wildcards, `*`; so do all segments below a branch that has more than `max_children`
children; what lies below `depth` segments becomes one `**`. Pages with equal templates meet in one row, so
that the tree is built on templates, not on pages.

Labels are the rules' verdicts. Branches below one node are merged if what lies below them is alike: the shares of their pages that go
on by each segment, or end, differ by no more than Hoeffding's bound for their numbers of pages, and so do, where both have labels, the blocked shares of
these. Branches of so few pages that no difference could exceed the bound aren't merged; branches without labels are like any other. Likeness is tested between every two of a node's branches, some 16 at most, and
carries on from one to the next; merged branches bear a plus and the least of their segments. A template's purity is the share of
blocked pages among the labelled ones of all templates that it was merged with, smoothed towards what the branches above it say. There
each branch with labels has one smoothed vote, from the root down to the template's own level. A template of at least `purity` is rejected.

All of it is DataFrame operations on the main path.

Defined cases: a null url, or one without `://`, has an empty host and path, which no rule fits and the
method allows; a null page_id stays null; repeated rows each give a row; an empty table gives an empty
result; other columns are ignored; the length of a url is not limited.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (verdict, rule) with the rule's host before its first slash and its path from there.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COUNTS = ("pages", "blocked", "decided")


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def ruled(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        domain, slash, below = text.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit(slash + below))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def generalised(path: Column, depth: int) -> Column:
    """The path's segments with those that vary by shape as wildcards, an extension kept, and one for all below `depth`."""
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    varies = r"^(?:[0-9][0-9.,_-]*|[0-9a-fA-F]{8,}|[A-Za-z_-]*[0-9]+[A-Za-z_-]+[0-9]+[0-9A-Za-z_-]*|.{41,})(\.[A-Za-z]{1,5})?$"
    shaped = F.transform(F.slice(segments, 1, depth), lambda s: F.when(s.rlike(varies), F.concat(F.lit("*"), F.regexp_extract(s, varies, 1))).otherwise(s))
    return F.when(F.size(segments) > depth, F.concat(shaped, F.array(F.lit("**")))).otherwise(shaped)


def templates(known: DataFrame, max_children: int) -> DataFrame:
    """host, shaped (segments after shapes), template (after crowded branches) and COUNTS."""
    tallied = known.groupBy("host", "shaped").agg(F.count("*").alias("pages"), F.count(F.when(F.col("ruling") == "block", 1)).alias("blocked"), F.count("ruling").alias("decided"))
    steps = tallied.select("host", "shaped", F.posexplode("shaped").alias("at", "segment"))
    steps = steps.where(~F.startswith("segment", F.lit("*"))).withColumn("above", F.slice("shaped", F.lit(1), F.col("at")))
    crowded = steps.select("host", "above", "segment").distinct().groupBy("host", "above").count().where(F.col("count") > max_children).select("host", "above")
    opened = steps.join(crowded, ["host", "above"]).groupBy("host", "shaped").agg(F.collect_set("at").alias("open"))
    template = F.transform("shaped", lambda s, i: F.when(F.array_contains(F.coalesce("open", F.array().cast("array<int>")), i), "*").otherwise(s))
    return tallied.join(opened, ["host", "shaped"], "left").withColumn("template", template).drop("open")


def bound(confidence: float) -> float:
    """Hoeffding's bound on the difference of two shares is this by the sum of one over the square root of either number."""
    return math.sqrt(0.5 * math.log(2 / confidence))


def merged_siblings(leaves: DataFrame, confidence: float) -> DataFrame:
    """host, branch (the segments down to it) and as: its segment, or a plus and the least segment of the branches it is merged with."""
    steps = leaves.select("host", "template", *COUNTS, F.posexplode("template").alias("at", "segment"))
    steps = steps.withColumns({"above": F.slice("template", F.lit(1), F.col("at")), "child": F.coalesce(F.get("template", F.col("at") + 1), F.lit(""))})
    below = steps.groupBy("host", "above", "segment", "child").agg(*[F.sum(c).alias(c) for c in COUNTS])
    # a branch has as many children here as it has segments below, a node as many branches: some 16 each
    branches = below.groupBy("host", "above", "segment").agg(F.sum("pages").alias("n"), F.sum("blocked").alias("blocked"), F.sum("decided").alias("decided"), F.array_sort(F.collect_list(F.struct("child", "pages"))).alias("children"))
    nodes = branches.groupBy("host", "above").agg(F.array_sort(F.collect_list(F.struct("segment", "n", "blocked", "decided", "children"))).alias("kin"))
    kin, size = F.col("kin"), F.size("kin")

    def share(branch: Column, child: Column) -> Column:
        found = F.get(F.filter(branch["children"], lambda c: c["child"] == child), 0)["pages"]
        return F.coalesce(found, F.lit(0)) / branch["n"]

    def most_for(x: Column, y: Column, number: str) -> Column:
        return F.lit(bound(confidence)) * (1 / F.sqrt(x[number]) + 1 / F.sqrt(y[number]))

    def alike(x: Column, y: Column) -> Column:
        most, labelled = most_for(x, y, "n"), (x["decided"] > 0) & (y["decided"] > 0)
        contradict = labelled & (F.abs(F.try_divide(x["blocked"], x["decided"]) - F.try_divide(y["blocked"], y["decided"])) > most_for(x, y, "decided"))
        return (most <= 1) & ~F.coalesce(contradict, F.lit(False)) & F.forall(F.concat(x["children"], y["children"]), lambda c: F.abs(share(x, c["child"]) - share(y, c["child"])) <= most)

    def partners(x: Column, i: Column) -> Column:
        after = F.filter(F.sequence(F.lit(0), size - 1), lambda j: (j > i) & alike(x, F.get(kin, j)))
        return F.transform(after, lambda j: F.struct(i.alias("a"), j.alias("b")))

    pairs = F.flatten(F.transform(kin, partners))

    def joined(classes: Column, pair: Column) -> Column:
        a, b = F.get(classes, pair["a"]), F.get(classes, pair["b"])
        return F.transform(classes, lambda c: F.when(c == F.greatest(a, b), F.least(a, b)).otherwise(c))

    found = nodes.withColumn("pairs", pairs).withColumn("classes", F.aggregate("pairs", F.sequence(F.lit(0), size - 1), joined))
    each = found.select("host", "above", "kin", "classes", F.posexplode("classes").alias("place", "class"))
    several = F.size(F.filter("classes", lambda c: c == F.col("class"))) > 1
    own, first = F.get("kin", F.col("place"))["segment"], F.get("kin", F.col("class"))["segment"]
    return each.select("host", F.concat("above", F.array(own)).alias("branch"), F.when(several, F.concat(F.lit("+"), first)).otherwise(own).alias("as"))


def verdicts(tree: DataFrame, prior: float, purity: float, confidence: float) -> DataFrame:
    """host, template, what it was merged to, its purity and judgement."""
    leaves = tree.groupBy("host", "template").agg(*[F.sum(c).alias(c) for c in COUNTS])
    steps = leaves.select("host", "template", "blocked", "decided", F.posexplode("template").alias("at", "_")).drop("_")
    steps = steps.withColumns({"above": F.slice("template", F.lit(1), F.col("at")), "branch": F.slice("template", F.lit(1), F.col("at") + 1)})
    branches = steps.groupBy("host", "above", "branch").agg(F.sum("blocked").alias("blocked"), F.sum("decided").alias("decided"))
    vote = F.when(F.col("decided") > 0, (F.col("blocked") + prior) / (F.col("decided") + 2 * prior))
    together = branches.groupBy("host", "above").agg(F.count(vote).alias("voters"), F.coalesce(F.sum(vote), F.lit(0.0)).alias("votes"))
    rated = branches.join(together, ["host", "above"]).join(merged_siblings(leaves, confidence), ["host", "branch"]).select("host", "branch", "as", "voters", "votes")
    # a template has as many rows here as segments
    ways = steps.select("host", "template", "at", "branch").join(rated, ["host", "branch"]).groupBy("host", "template").agg(F.array_sort(F.collect_list(F.struct("at", "as", "voters", "votes"))).alias("way"))
    way = F.coalesce("way", F.array().cast("array<struct<at:int,as:string,voters:bigint,votes:double>>"))
    told = F.aggregate("way", F.lit(0.5), lambda p, x: (x["votes"] + 2 * prior * p) / (x["voters"] + 2 * prior))
    rated = leaves.join(ways, ["host", "template"], "left").withColumn("way", way).withColumns({"merged": F.transform("way", lambda x: x["as"]), "told": told}).drop("way")
    pooled = rated.groupBy("host", "merged").agg(F.sum("blocked").alias("all_blocked"), F.sum("decided").alias("all_decided"))
    clean = F.round((F.col("all_blocked") + 2 * prior * F.col("told")) / (F.col("all_decided") + 2 * prior), 6)
    judged = rated.join(pooled, ["host", "merged"]).withColumn("purity", clean)
    return judged.select("host", "template", "merged", "purity", F.when(F.col("purity") >= purity, "block").otherwise("allow").alias("judgement"))


def filtered(pages: DataFrame, rules: tuple = RULES, max_children: int = 16, depth: int = 8, prior: float = 1.0, purity: float = 0.8, confidence: float = 0.05, labelled: Column | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity and judgement (the method's verdict) of every page.

    Where `labelled` is given, only its pages' rules are labels: so the others measure the method.
    """
    host, path = host_and_path(F.col("url"))
    use = (F.lit(True) if labelled is None else labelled).alias("use")
    known = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"), use)
    rule, ruling = ruled(F.col("host"), F.col("path"), rules)
    known = known.withColumns({"rule": rule, "says": ruling, "shaped": generalised(F.col("path"), depth)}).withColumn("ruling", F.when(F.col("use"), F.col("says")))
    tree = templates(known, max_children)
    judged = tree.select("host", "shaped", "template").join(verdicts(tree, prior, purity, confidence), ["host", "template"])
    judged = judged.select("host", "shaped", F.concat(F.lit("/"), F.array_join("merged", "/")).alias("template"), "purity", "judgement")
    # a template that many pages share is a large key on one side only, which adaptive execution splits
    out = known.join(judged, ["host", "shaped"], "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("says", "judgement").alias("verdict"), "template", "purity", "judgement")


def allowed(pages: DataFrame, **settings: float) -> DataFrame:
    """The rows of `pages` that are allowed, as they are; rows that repeat a page_id go if any of them is blocked."""
    blocked = filtered(pages, **settings).where("verdict = 'block'").select(F.col("page_id").alias("_blocked")).distinct()
    return pages.join(blocked, pages["page_id"] == blocked["_blocked"], "left_anti")
