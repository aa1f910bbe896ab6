"""URL verdicts from rules and from a tree of path templates per host.

Rules decide first. The pages they decide are the labelled ones, from which the
templates learn. Every path is cut into segments. Segments that vary by their
form (numbers, hexadecimal names, dates) become ``*`` at once; the paths that are
left are counted per host, and the tree is walked down from its root:

* a node whose children are mostly different (at least ``min_children`` of them,
  fewer than ``least_repeats`` pages each) is variable: its children become ``*``;
* of the other children those are merged into ``+`` that are like the rest of
  their siblings: what follows them is (a chi-square test of the pages by next segment, end
  of path included, at ``z``), and, where both have labels, so is their share of
  blocked pages (test of two shares at ``z``). Children without labels are merged by
  what follows them, so the labels of a template reach them;
* a path that no other one shares its node with keeps the rest of its segments.

A round of the walk takes one level of all hosts, so there are as many rounds as segments that
two paths of a host share at most.

A template is rejected if its smoothed purity reaches ``reject_from``. Rules do not label pages at
random, so a page without a label counts as half a blocked one, and ``strength`` further pages
do: (blocked + (unlabelled + strength) / 2) / (pages + strength). One without labels has 0.5.

A null url or one without ``://`` has empty host and path and is allowed unless
a rule fits. Of rules of equal length the last by verdict, domain and path wins. Urls of any
length and depth are judged whole. Repeated rows are kept, also those of null ids; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.session import cut_lineage

RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
VARIABLE = r"^(?:[0-9][0-9._:-]*|[0-9a-fA-F-]*[0-9][0-9a-fA-F-]{7,}|.*[0-9]{4,}.*)(?:\.[A-Za-z0-9]{1,5})?$"


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.contains(url, F.lit("://")), F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), ascii_uppercase, ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null if none does."""
    rule = verdict = None
    for says, domain, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(start)
        name = F.when(fits, F.lit(domain + start))
        said = F.when(fits, F.lit(says))
        rule = name if rule is None else name.otherwise(rule)
        verdict = said if verdict is None else said.otherwise(verdict)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def _alike(z: float) -> Column:
    """Whether a child is like the rest of its node, from the counts of both."""
    rest = F.col("_n") - F.col("n")
    # The statistic of a table of two rows, child and rest, over what follows.
    apart = F.col("_n") * F.col("_n") / (F.col("n") * rest) * (F.col("_fit") - F.col("n") * F.col("n") / F.col("_n"))
    free = F.greatest(F.col("_kinds") - 1, F.lit(1)).cast("double")
    third = 1 - 2 / (9 * free) + z * F.sqrt(2 / (9 * free))  # Wilson and Hilferty
    follows = apart <= free * third * third * third
    unseen = F.col("_labelled") - F.col("labelled")
    both = (F.col("labelled") > 0) & (unseen > 0)
    here, there = F.greatest("labelled", F.lit(1)), F.greatest(unseen, F.lit(1))
    pooled = F.col("_blocked") / F.greatest("_labelled", F.lit(1))
    gap = F.col("blocked") / here - (F.col("_blocked") - F.col("blocked")) / there
    differ = both & (F.abs(gap) > z * F.sqrt(pooled * (1 - pooled) * (1 / here + 1 / there)))
    return F.when(rest > 0, follows & ~differ).otherwise(False)


def templates(paths: DataFrame, min_children: int, least_repeats: float, z: float) -> DataFrame:
    """``paths`` (host, form, n, labelled, blocked) with the ``template`` of each form.

    One level of the tree at a time, in aggregations and joins of narrow rows.
    """
    segments = F.filter(F.split("form", "/"), lambda s: s != "")
    rows = paths.withColumn("_segments", segments).withColumn("template", F.lit(""))
    counts, node_key = ("n", "labelled", "blocked"), ["host", "template"]
    done, depth = [], 0
    while True:
        step, following = (F.try_element_at("_segments", F.lit(depth + i)) for i in (1, 2))
        rows = rows.withColumns({"_step": step, "_next": F.coalesce(following, F.lit(""))})
        done.append(rows.filter(F.col("_step").isNull()).select(*paths.columns, "template"))
        live = rows.filter(F.col("_step").isNotNull())
        if live.isEmpty():
            return reduce(DataFrame.unionByName, done)
        after = live.groupBy(*node_key, "_step", "_next").agg(
            *[F.sum(c).alias(c) for c in counts], F.count(F.lit(1)).alias("forms")
        )
        kinds = after.groupBy(*node_key, "_next").agg(F.sum("n").alias("_of_kind"))
        child = after.join(kinds, [*node_key, "_next"]).groupBy(*node_key, "_step").agg(
            *[F.sum(c).alias(c) for c in (*counts, "forms")],
            F.sum(F.col("n") * F.col("n") / F.col("_of_kind")).alias("_fit"),
        )
        node = child.groupBy(*node_key).agg(
            F.count(F.lit(1)).alias("_children"), *[F.sum(c).alias(f"_{c}") for c in (*counts, "forms")]
        )
        node = node.join(kinds.groupBy(*node_key).agg(F.count(F.lit(1)).alias("_kinds")), node_key)
        varies = (F.col("_children") >= min_children) & (F.col("_n") < least_repeats * F.col("_children"))
        name = F.when((F.col("_step") == "*") | varies, "*").when(_alike(z), "+").otherwise(F.col("_step"))
        names = child.join(node, node_key).select(
            F.col("host").alias("_h"), F.col("template").alias("_t"), F.col("_step").alias("_s"),
            name.alias("_name"), (F.col("_forms") == 1).alias("_alone"),
        )
        here = (F.col("host") == F.col("_h")) & (F.col("template") == F.col("_t")) & (F.col("_step") == F.col("_s"))
        walked = live.join(names, here)
        tail = F.concat_ws("/", F.slice("_segments", F.lit(depth + 1), F.size("_segments")))
        further = F.concat("template", F.lit("/"), F.when(F.col("_alone"), tail).otherwise(F.col("_name")))
        walked = cut_lineage(walked.withColumn("template", further).select(*paths.columns, "_segments", "template", "_alone"))
        done.append(walked.filter("_alone").select(*paths.columns, "template"))
        rows, depth = walked.filter("NOT _alone").drop("_alone"), depth + 1


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    key: str = "page_id",
    url: str = "url",
    min_children: int = 8,
    least_repeats: float = 2.0,
    z: float = 1.96,
    strength: float = 4.0,
    reject_from: float = 0.8,
) -> DataFrame:
    """Per page ``key``, host, path, rule, template, purity and verdict (allow or block)."""
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(key).alias("_key"), host.alias("host"), path.alias("path"))
    rule, said = matching_rule(F.col("host"), F.col("path"), rules)
    form = F.array_join(
        F.transform(F.split("path", "/"), lambda s: F.when(s.rlike(VARIABLE), "*").otherwise(s)), "/"
    )
    rows = rows.withColumns({"rule": rule, "_said": said, "form": form})
    counted = rows.groupBy("host", "form").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("_said").alias("labelled"),
        F.count(F.when(F.col("_said") == "block", 1)).alias("blocked"),
    )
    named = cut_lineage(templates(cut_lineage(counted), min_children, least_repeats, z))
    tree = named.groupBy("host", "template").agg(
        *[F.sum(c).alias(f"_{c}") for c in ("n", "labelled", "blocked")]
    )
    undecided = F.col("_n") - F.col("_labelled") + strength
    purity = (F.col("_blocked") + undecided / 2) / (F.col("_n") + strength)
    tree = tree.select("host", "template", purity.alias("purity"))
    known = named.select("host", "form", "template").join(tree, ["host", "template"])
    known = known.select(F.col("host").alias("_h"), F.col("form").alias("_f"), "template", "purity")
    found = rows.join(known, (F.col("host") == F.col("_h")) & (F.col("form") == F.col("_f")))
    own = F.when(F.col("purity") >= reject_from, "block").otherwise("allow")
    return found.select(
        F.col("_key").alias(key), "host", "path", "rule", "template", "purity", F.coalesce("_said", own).alias("verdict")
    )
