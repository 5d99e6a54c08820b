"""URL filter by a path-template tree (DataFrame functions only).

Per host, paths form a tree of segments.  A segment stays literal where it has
pages enough (``MIN_SUPPORT``, whatever its share).  Where values are an open
set (of ``n`` pages ``NEW_SHARE`` or more show a value that no other page
shows, which estimates the chance that a further page brings a new one), as
with ids and titles, it must also have ``MIN_SUPPORT`` times the pages of a mean value: a
popular item is no branch of its own, a section beside the items is.  The
others are variable and become a wildcard (``*``, with the file extension if any).  That
goes on as deep as any path with enough pages.  Then, from the leaves up, a
branch whose share of bad labels is not significantly off its parent's is
merged into the parent.  What remains are templates; one is rejected if its smoothed
share of good labels is under ``MIN_PURITY``.  Listed rules (host, path) go
before the method, the longest first.

All counts are partial aggregates keyed by (host, prefix, segment).  They are
joined back by that key and a path's lot (``SALTS``); a count stands once for each
lot that it comes from.  So a segment on a third of all paths is pre-aggregated
and its paths are dealt over several tasks.

Nulls: a null url, or one without ``://``, has an empty host and path and is
allowed unless its (empty) template is rejected.  Rows may repeat; each gets
a verdict.  Without labels nothing is rejected by the method.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import lower_ascii

MIN_SUPPORT = 3  # pages of a literal segment
NEW_SHARE = 0.1  # of pages whose value no other page has: an open set of values
SALTS = 16  # lots in which the paths through one place of the tree are dealt out
SIMILAR_Z = 1.96
SMOOTHING = 10.0  # labels' worth of the overall share
MIN_PURITY = 0.5

#: (verdict, rule): a rule is a host, then a path from its first ``/`` on.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def host_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.lit(2_147_483_647)))
    host = F.coalesce(lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.lit(""))
    return host, F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def listed(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        h, slash, p = text.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + p)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _wild(segment: Column) -> Column:
    return F.concat(F.lit("*"), F.regexp_extract(segment, r"(\.[A-Za-z]{1,5})$", 1))


def _prefix(text: str, segments: Column) -> Column:
    """The first so many segments of a path that starts with ``/``."""
    return F.call_function("substring_index", F.col(text), F.lit("/"), (segments + 1).cast("int"))


def _joined(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: F.concat(F.lit("/"), s)), "")


def _lot() -> Column:
    return F.pmod(F.xxhash64("no"), F.lit(SALTS)).cast("int").alias("lot")


def _maybe_literal(t: DataFrame) -> DataFrame:
    """``segments`` with ``canon``: the wildcard for a segment that has too few
    pages on its host, counted at its depth under any template."""
    rows = t.select("no", _lot(), "host", "n", F.posexplode("segments").alias("k", "segment"))
    common = rows.groupBy("host", "k", "segment").agg(F.sum("n").alias("pages"), F.collect_set("lot").alias("lots"))
    common = common.where((F.col("pages") >= MIN_SUPPORT) & (F.col("segment") != _wild(F.col("segment"))))
    common = common.select("host", "k", "segment", F.explode("lots").alias("lot"))
    may = rows.join(common, ["host", "k", "segment", "lot"], "left_semi").groupBy("no").agg(F.collect_list("k").alias("may"))
    canon = F.transform("segments", lambda s, i: F.when(F.array_contains("may", i), s).otherwise(_wild(s)))
    t = t.join(may, "no", "left").withColumn("may", F.coalesce("may", F.array().cast("array<int>")))
    return t.withColumn("canon", canon).drop("may")


def templates(paths: DataFrame) -> DataFrame:
    """Add ``template`` to distinct (host, path, n, ...) rows.

    A round takes each path over all segments that stay literal and over those
    that cannot be literal under any template.  It halts behind a variable
    segment only where some of the segments at that place of the tree may have
    been literal but are not: those pages are then counted together.  So there
    are as many rounds as such places on one way, not as segments."""
    t = paths.withColumn("segments", F.filter(F.split("path", "/"), lambda s: s != ""))
    t = _maybe_literal(cut_lineage(t.withColumn("no", F.monotonically_increasing_id())))
    t, further = cut_lineage(t.withColumn("template", F.lit(""))), True
    while further:
        rows = t.select("no", "host", "n", "template", "canon", F.posexplode(F.arrays_zip("segments", "canon")).alias("k", "s"))
        segment, parent = F.col("s.segments"), F.concat("template", _joined(F.slice("canon", F.lit(1), F.col("k"))))
        may = (F.col("s.canon") == segment) & (segment != _wild(segment))
        rows = rows.select("no", _lot(), "host", "n", "k", parent.alias("parent"), segment.alias("segment"), may.alias("may"))
        values = rows.groupBy("host", "parent", "segment").agg(F.sum("n").alias("pages"), F.max("may").alias("may"), F.collect_set("lot").alias("lots"))
        places = values.groupBy("host", "parent").agg(F.count(F.lit(1)).alias("d"), F.sum("pages").alias("n"), F.count_if(F.col("pages") == 1).alias("once"))
        opened = places.where(F.col("once") >= NEW_SHARE * F.col("n")).select("host", "parent", (MIN_SUPPORT * F.col("n") / F.col("d")).alias("least"))
        asked = values.where("may").join(opened, ["host", "parent"], "left")
        stays = F.col("pages") >= F.greatest(F.lit(float(MIN_SUPPORT)), F.coalesce("least", F.lit(0.0)))
        asked = cut_lineage(asked.select("host", "parent", "segment", "lots", stays.alias("stays")))
        halting = asked.where("not stays").select("host", "parent").distinct().withColumn("lot", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        literal = asked.where("stays").select("host", "parent", "segment", F.explode("lots").alias("lot"))
        variable = rows.join(literal, ["host", "parent", "segment", "lot"], "left_anti")
        halted = variable.join(halting, ["host", "parent", "lot"]).groupBy("no").agg(F.min("k").alias("k"))
        size = F.size("segments")
        t = t.join(halted, "no", "left").withColumn("k", F.coalesce("k", size))
        behind = F.when(F.col("k") < size, F.concat(F.lit("/"), _wild(F.get("segments", F.col("k"))))).otherwise("")
        t = t.withColumn("template", F.concat("template", _joined(F.slice("canon", F.lit(1), F.col("k"))), behind))
        t = cut_lineage(t.withColumns({c: F.slice(c, F.col("k") + 2, size) for c in ("segments", "canon")}).drop("k"))
        further = not t.where(F.size("segments") > 0).isEmpty()
    return t.drop("segments", "canon", "no")


def merged(stats: DataFrame) -> DataFrame:
    """(host, template, node, labelled, bad): the node that each template
    ends in after merging similar branches into their parents.

    Only where labelled templates part is there anything to compare: a branch
    without a sibling has its parent's share.  So the tree is worked off by
    the forks on the way to a template, from the last to the first, in as many
    rounds as there are forks on one way; a template without labels goes with
    the nearest branch above it that stays apart."""
    known = stats.where("labelled > 0")
    depth = F.size(F.split("template", "/")) - 1
    way = known.select("host", "template", F.explode(F.when(depth > 0, F.sequence(F.lit(0), depth - 1)).otherwise(F.array().cast("array<int>"))).alias("at"))
    way = way.withColumn("parent", _prefix("template", F.col("at"))).withColumn("child", _prefix("template", F.col("at") + 1))
    forks = way.groupBy("host", "parent").agg(F.min("child").alias("a"), F.max("child").alias("b")).where("a <> b").select("host", "parent")
    met = way.join(forks, ["host", "parent"]).groupBy("host", "template").agg(F.array_sort(F.collect_list("at")).alias("forks"))
    t = known.join(met, ["host", "template"], "left").withColumn("forks", F.coalesce("forks", F.array().cast("array<int>")))
    t = cut_lineage(t.withColumn("node", F.lit(None).cast("string")))
    most = t.agg(F.max(F.size("forks"))).first()[0] or 0
    for k in range(most - 1, -1, -1):
        here = F.col("node").isNull() & (F.size("forks") > k)
        at = F.get("forks", F.lit(k))
        t = t.withColumn("child", F.when(here, _prefix("template", at + 1))).withColumn("parent", F.when(here, _prefix("template", at)))
        nodes = t.where("child is not null").groupBy("host", "parent", "child").agg(F.sum("labelled").alias("nl"), F.sum("bad").alias("nb"))
        pooled = nodes.groupBy("host", "parent").agg(F.sum("nl").alias("pl"), F.sum("nb").alias("pb"))
        rate = F.col("pb") / F.greatest(F.col("pl"), F.lit(1))
        off = F.abs(F.col("nb") - F.col("nl") * rate) > SIMILAR_Z * F.sqrt(F.col("nl") * rate * (1 - rate))
        apart = nodes.join(pooled, ["host", "parent"]).where(off).select("host", "child", F.lit(True).alias("apart"))
        t = t.join(apart, ["host", "child"], "left").withColumn("node", F.when(F.col("apart"), F.col("child")).otherwise(F.col("node")))
        t = cut_lineage(t.drop("apart", "child", "parent"))
    stay = t.where("node is not null").select("host", "node").distinct()
    others = stats.where("labelled = 0").withColumn("at", F.explode(F.sequence(F.lit(0), depth)))
    others = others.withColumn("node", _prefix("template", F.col("at"))).join(stay, ["host", "node"])
    above = others.groupBy("host", "template").agg(F.max_by("node", "at").alias("node"))
    rest = stats.where("labelled = 0").join(above, ["host", "template"], "left")
    columns = ["host", "template", F.coalesce("node", F.lit("")).alias("node"), "labelled", "bad"]
    return t.select(*columns).unionByName(rest.select(*columns))


def judge_urls(pages: DataFrame, labels: DataFrame, rules=RULES, *, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page.  ``labels``:
    (host, path, bad 0/1), any number for a path."""
    host, path = host_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    marks = labels.where("bad is not null").groupBy("host", "path").agg(F.count(F.lit(1)).alias("labelled"), F.sum("bad").alias("bad"))
    paths = rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n")).join(marks, ["host", "path"], "left").fillna(0, ["labelled", "bad"])
    t = cut_lineage(templates(cut_lineage(paths)))
    stats = cut_lineage(t.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")))
    nodes = merged(stats)
    total = nodes.agg(F.try_divide(F.sum("bad"), F.sum("labelled")).alias("share"))
    judged = nodes.groupBy("host", "node").agg(F.sum("labelled").alias("nl"), F.sum("bad").alias("nb")).crossJoin(F.broadcast(total))
    prior = F.coalesce(1 - F.col("share"), F.lit(1.0))
    purity = (F.col("nl") - F.col("nb") + SMOOTHING * prior) / (F.col("nl") + SMOOTHING)
    rejected = judged.where((purity < MIN_PURITY) & (F.col("nl") > 0)).select("host", "node")
    bad_paths = t.join(nodes.join(rejected, ["host", "node"]).select("host", "template"), ["host", "template"]).select("host", "path", F.lit("block").alias("method"))
    rule, listed_verdict = listed(F.col("host"), F.col("path"), rules)
    out = rows.join(bad_paths, ["host", "path"], "left")
    return out.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(listed_verdict, F.col("method"), F.lit("allow")).alias("verdict"))
