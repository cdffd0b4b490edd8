"""URL filter: rules first, else the smoothed purity of the URL's path template.

Templates form a tree per host, built level by level (a segment of the path each). A segment stays literal
if enough of its parent's URLs have it; any other is a wildcard of its shape: number, hexadecimal, word,
other. Levels go on until no branch has enough URLs for a literal; what follows are wildcards, one for each
segment. Sibling branches whose share of blocked labels does
not differ significantly are merged; a template without labels is a branch of its own. A template's purity is
the share of blocked labels of its branch, smoothed towards the same template on all hosts, that towards all
labels. From ``REJECT`` on it is rejected.

Labels are the verdicts of the rules themselves: URLs that a rule judges teach the templates of the rest.

Defined results: null URLs and URLs without ``://`` have empty host and path, no rule, and the template of
the empty path. Repeated rows count as often as they occur and each get a verdict. Without labels the purity
is the prior (``PRIOR``), which allows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import materialise

# host and path of a rule, and what it says
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
# levels with literals; deeper ones are wildcards, segment by segment
LEVELS = 32
# a literal segment has this share of its parent's URLs, and so many at least
LITERAL_SHARE, LITERAL_ROWS = 0.02, 8
# labels that the next wider level counts for, share of blocked labels before any is seen
WEIGHT, PRIOR = 5.0, 0.3
REJECT = 0.5
# siblings differ if their shares are so many standard errors apart
SIGNIFICANT = 2.58
LOWER_FROM, LOWER_TO = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: str) -> tuple[Column, Column]:
    """Host, A-Z in lower case, and path."""
    after = F.substr(F.col(url), F.position(F.lit("://"), F.col(url)) + 3)
    has = F.coalesce(F.col(url).contains("://"), F.lit(False))
    bare = F.regexp_extract(after, r"^(?s)([^?#]*)", 1)
    host = F.translate(F.regexp_extract(bare, r"^(?s)([^/]*)", 1), LOWER_FROM, LOWER_TO)
    path = F.regexp_extract(bare, r"^(?s)[^/]*(.*)$", 1)
    return F.when(has, host).otherwise(""), F.when(has, path).otherwise("")


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for own, start, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == own) | F.endswith(host, F.lit("." + own))) & F.startswith(path, F.lit(start))
        rule, verdict = F.when(fits, own + start).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def shape(segment: Column) -> Column:
    """What a wildcard stands for; a file ending stays."""
    stem = F.regexp_replace(segment, r"\.[A-Za-z]{1,5}$", "")
    ending = F.regexp_extract(segment, r"(\.[A-Za-z]{1,5})$", 1)
    kind = (
        F.when(stem == "", "{}").when(stem.rlike(r"^[0-9]+$"), "{number}").when(stem.rlike(r"^[0-9a-fA-F-]{8,}$"), "{hex}").when(stem.rlike(r"^[\p{L}_-]+$"), "{word}").otherwise("{other}")
    )
    return F.concat(kind, ending)


def with_templates(urls: DataFrame) -> DataFrame:
    """Adds ``template``. ``urls``: host, path.

    A level's counts combine before the shuffle; the literals of a level are at most 1 / LITERAL_SHARE per
    parent, so the table joined to the URLs is small, and a host with a third of them is a hot key of an
    ordinary join, which the planner splits.
    """
    segments = F.split(F.regexp_replace("path", "^/", ""), "/", -1)
    rows = urls.withColumn("_segments", segments).withColumn("template", F.lit(""))
    level = 0
    while level < LEVELS:
        segment = F.get("_segments", F.lit(level))
        parents = rows.where(segment.isNotNull()).groupBy("host", "template").agg(F.count("*").alias("_all"))
        parents = parents.where(F.col("_all") >= LITERAL_ROWS)
        if parents.isEmpty():
            break
        rows = rows.withColumn("_segment", segment)
        counts = rows.where("_segment IS NOT NULL").groupBy("host", "template", "_segment").agg(F.count("*").alias("_n"))
        counts = counts.where(~F.col("_segment").rlike("^[0-9]+$"))
        literal = counts.join(parents, ["host", "template"]).where((F.col("_n") >= LITERAL_ROWS) & (F.col("_n") >= LITERAL_SHARE * F.col("_all")))
        literal = literal.select(F.col("host").alias("_h"), F.col("template").alias("_t"), F.col("_segment").alias("_s"))
        rows = rows.join(literal, (F.col("host") == F.col("_h")) & (F.col("template") == F.col("_t")) & (F.col("_segment") == F.col("_s")), "left")
        name = F.when(F.col("_s").isNotNull(), F.col("_segment")).otherwise(shape(F.col("_segment")))
        rows = rows.withColumn("template", F.when(F.col("_segment").isNull(), F.col("template")).otherwise(F.concat("template", F.lit("/"), name)))
        rows = materialise(rows.drop("_h", "_t", "_s", "_segment"), "templates")
        level += 1
    rest = F.transform(F.slice("_segments", F.lit(level + 1), F.greatest(F.size("_segments") - level, F.lit(0))), lambda s: F.concat(F.lit("/"), shape(s)))
    return rows.withColumn("template", F.concat("template", F.array_join(rest, ""))).drop("_segments")


def branched(known: DataFrame) -> DataFrame:
    """Adds ``branch``, counted within ``_family``. Siblings come in order, and a task holds one branch's sums only.

    Templates without labels have nothing that could differ: they come last, each in a branch of its own.
    """
    schema = f"{', '.join(f'`{n}` {t}' for n, t in known.dtypes)}, branch int"

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family, branch, labels, share = None, 0, 0, 0.0
        for batch in batches:
            found = []
            columns = (batch.column(c).to_pylist() for c in ("_family", "n", "_share"))
            for own, n, p in zip(*columns, strict=True):
                if own != family:
                    family, branch, labels, share = own, 0, n, p
                elif not n or significant(labels, share, n, p):
                    branch, labels, share = branch + 1, n, p
                else:
                    labels, share = labels + n, (share * labels + p * n) / (labels + n)
                found.append(branch)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int32())], [*batch.schema.names, "branch"])

    ordered = known.repartition("_family").sortWithinPartitions("_family", F.col("n") == 0, "_share", "template")
    return ordered.mapInArrow(numbered, schema)


def significant(n: int, low: float, m: int, high: float) -> bool:
    """Whether the share ``high`` of m labels is significantly above the share ``low`` of n."""
    pooled = (low * n + high * m) / (n + m)
    return high - low > SIGNIFICANT * math.sqrt(pooled * (1 - pooled) * (1 / n + 1 / m))


def purities(rows: DataFrame) -> DataFrame:
    """``host``, ``template``, ``branch`` (number among merged siblings), ``purity``. ``rows``: host, template, label.

    Siblings are the templates of a host that differ in one segment only by its literal: they have the same
    parent and the same shapes below. Ordered by their share of blocked labels, each is held against the labels
    of the branch so far, and a significant difference begins a new branch.
    """
    blocked = F.sum(F.when(F.col("label") == "block", 1).otherwise(0))
    counts = rows.groupBy("host", "template").agg(F.count("label").alias("n"), blocked.alias("bad"))
    counts = materialise(counts, "templates")
    every = counts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    overall = ((every.bad or 0) + WEIGHT * PRIOR) / ((every.n or 0) + WEIGHT)
    anywhere = counts.groupBy("template").agg(((F.sum("bad") + WEIGHT * overall) / (F.sum("n") + WEIGHT)).alias("_prior"))

    depth = F.size(F.split("template", "/"))
    family = F.concat_ws("\n", "host", depth.cast("string"), F.regexp_replace("template", r"/[^/{}]+", "/*"))
    known = counts.join(anywhere, "template").withColumn("_share", (F.col("bad") + WEIGHT * F.col("_prior")) / (F.col("n") + WEIGHT)).withColumn("_family", family)
    known = materialise(branched(known), "templates")
    merged = known.groupBy("_family", "branch").agg(F.sum("n").alias("_n"), F.sum("bad").alias("_bad"))
    purity = ((F.col("_bad") + WEIGHT * F.col("_prior")) / (F.col("_n") + WEIGHT)).alias("purity")
    return known.join(merged, ["_family", "branch"]).select("host", "template", "branch", purity)


def verdicts(pages: DataFrame, url: str = "url", rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Per page: host, path, rule, verdict, template, branch and purity."""
    host, path = parts(url)
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, says = rule_for(F.col("host"), F.col("path"), rules)
    rows = with_templates(rows.withColumn("rule", rule).withColumn("label", says))
    judged = rows.join(purities(rows), ["host", "template"])
    by_template = F.when(F.col("purity") >= REJECT, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("label", by_template).alias("verdict"), "template", "branch", "purity")
