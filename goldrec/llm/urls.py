"""URL filters: given rules first, then a tree of path templates per host.

The rules name the verdict of the URLs they fit; those URLs are the labels from
which the rest is judged.

1. *Classes.*  Numbers and identifiers in a path become ``{n}`` and ``{id}``;
   equal shapes are counted together before anything is shuffled.
2. *Variable segments.*  Level by level, if a parent's children are many and
   nearly all different, they become the wildcard ``*``.
3. *Similar branches.*  Of the children that have labels, those whose share of
   blocked labels does not differ from that of their labelled siblings by more
   than chance are merged into ``*``.  Children without labels show no similarity
   and stay branches of their own.
4. *Purity.*  A template's share of blocked labels is smoothed towards its
   host's, that towards its domain's, that towards ``BASE``; templates above
   ``reject`` are blocked.  A label that a rule gave for a path says nothing of the
   host's other paths, so only labels of rules for whole hosts count there, and a
   template without labels goes by these or else by ``BASE``.

Segments beyond ``depth`` levels are one tail, kept whole as a last segment, so
every path has a template.  Defined results: a null URL, or one without
``://``, has empty host and path, which is a host like any other; repeated rows
each return; an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldrec.llm.common import Scratch, lower_ascii

# Verdict, host, path.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
DEPTH = 4
MANY = 8  # children from which a parent may have a wildcard
NEW = 0.3  # children per row from which they count as variable
SIGMAS = 1.96
PRIOR = 10.0  # rows that a parent's share weighs
BASE = 0.25  # share of blocked URLs where nothing is known
REJECT = 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = lower_ascii(F.regexp_extract(rest, "^([^/?#]*)", 1))
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...]) -> Column:
    """The longest rule that fits, as struct(rule, verdict); null if none does."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        chosen = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def classes(path: Column, depth: int) -> Column:
    """The path's segments with numbers and identifiers generalised; segments beyond ``depth`` joined to one."""
    segments = F.transform(
        F.array_remove(F.split(path, "/"), ""),
        lambda s: F.when(s.rlike("^[0-9]+$"), "{n}")
        .when(s.rlike(r"^[0-9]+\.[A-Za-z]{1,5}$"), F.regexp_replace(s, "^[0-9]+", "{n}"))
        .when(s.rlike("^[0-9A-Za-z_-]{12,}$") & s.rlike("[0-9]"), "{id}")
        .otherwise(s),
    )
    tail = F.concat_ws("/", F.slice(segments, depth, F.greatest(F.size(segments) - depth + 1, F.lit(1))))
    return F.when(F.size(segments) > depth, F.concat(F.slice(segments, 1, depth - 1), F.array(tail))).otherwise(segments)


def domain_of(host: Column) -> Column:
    return F.regexp_extract(host, r"([^.]*\.)?[^.]*$", 0)


def path_templates(shapes: DataFrame, depth: int, scratch: Scratch) -> DataFrame:
    """``shapes`` (host, segs, n, labelled, blocked, ...) with ``template``, level by level."""
    tree = shapes.withColumn("template", F.lit(""))
    for level in range(1, depth + 1):
        tree = tree.withColumn("seg", F.try_element_at("segs", F.lit(level)))
        children = tree.where("seg is not null").groupBy("host", "template", "seg")
        children = children.agg(*[F.sum(c).alias(c) for c in ("n", "labelled", "blocked")])
        children = scratch.save(children, "children")
        parents = children.groupBy("host", "template").agg(
            F.count("*").alias("p_children"), *[F.sum(c).alias(f"p_{c}") for c in ("n", "labelled", "blocked")]
        )
        parents = scratch.save(parents, "parents")
        # a labelled child against its labelled siblings
        others = F.col("p_labelled") - F.col("labelled")
        share = (F.col("p_blocked") - F.col("blocked") + 1) / (others + 2)
        chance = SIGMAS * F.sqrt(share * (1 - share) / F.greatest("labelled", F.lit(1)))
        variable = (F.col("p_children") >= MANY) & (F.col("p_children") >= NEW * F.col("p_n"))
        alike = (F.col("labelled") > 0) & (others > 0) & (F.abs((F.col("blocked") / F.greatest("labelled", F.lit(1))) - share) <= chance)
        literal = ~F.col("seg").startswith("{")  # classes are general already
        named = children.join(parents, ["host", "template"])
        named = named.select("host", "template", "seg", F.when((variable | alike) & literal, "*").otherwise(F.col("seg")).alias("name"))
        tree = tree.join(scratch.save(named, "named"), ["host", "template", "seg"], "left")
        step = F.when(F.col("name").isNotNull(), F.concat("template", F.lit("/"), F.col("name"))).otherwise(F.col("template"))
        tree = scratch.save(tree.withColumn("template", step).drop("seg", "name"), "tree")
    return tree


def _smoothed(rows: DataFrame, keys: list[str], labelled: str, blocked: str, prior: DataFrame | None) -> DataFrame:
    """Share of blocked labels by ``keys`` as p, drawn by PRIOR rows towards the share ``prior`` by ``keys`` but the last, or BASE."""
    own = rows.groupBy(*keys).agg(F.sum(labelled).alias("labelled"), F.sum(blocked).alias("blocked"))
    own = own.withColumn("up", F.lit(BASE)) if prior is None else own.join(prior.withColumnRenamed("p", "up"), keys[:-1])
    return own.select(*keys, ((F.col("blocked") + PRIOR * F.col("up")) / (F.col("labelled") + PRIOR)).alias("p"))


def filter_urls(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, depth: int = DEPTH) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) for every row."""
    scratch = Scratch(pages.sparkSession)
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("given", rule_of(F.col("host"), F.col("path"), rules)).withColumn("segs", classes(F.col("path"), depth))
    rows = scratch.save(rows, "urls")
    blocks, wide = F.col("given.verdict") == "block", F.col("given.rule").endswith("/") & ~F.col("given.rule").rlike("/.")
    shapes = rows.groupBy("host", "segs").agg(
        F.count("*").alias("n"), F.count("given").alias("labelled"), F.count_if(blocks).alias("blocked"),
        F.count_if(wide).alias("w_labelled"), F.count_if(wide & blocks).alias("w_blocked"),
    )
    tree = path_templates(scratch.save(shapes, "shapes"), depth, scratch).withColumn("domain", domain_of(F.col("host")))
    domains = scratch.save(_smoothed(tree, ["domain"], "w_labelled", "w_blocked", None), "domains")
    hosts = scratch.save(_smoothed(tree, ["domain", "host"], "w_labelled", "w_blocked", domains), "hosts")
    templates = scratch.save(_smoothed(tree, ["domain", "host", "template"], "labelled", "blocked", hosts), "templates")
    judged = scratch.save(tree.join(templates, ["domain", "host", "template"]).select("host", "segs", "template", F.col("p").alias("purity")), "judged")
    verdict = F.coalesce(F.col("given.verdict"), F.when(F.col("purity") > REJECT, "block").otherwise("allow"))
    return rows.join(judged, ["host", "segs"]).select("page_id", "host", "path", F.col("given.rule").alias("rule"), verdict.alias("verdict"), "template", "purity")
