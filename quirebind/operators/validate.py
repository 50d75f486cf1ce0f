"""Bundle checks: required files and links that resolve."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirebind import fixed
from quirebind.functions import names
from quirebind.functions.text import bind


def links(index_md: Column) -> Column:
    """Targets of the links to Markdown files, in order, with repeats."""
    return F.regexp_extract_all(index_md, F.lit(fixed.LINK_PATTERN), 1)


def dead_links(targets: Column, paths: Column) -> Column:
    """Links that are none of ``paths``, in order, with repeats.

    The set difference is hashed and nearly always empty; the scan per link
    then looks at nothing.
    """
    both = F.struct(targets.alias("all"), paths.alias("paths"))
    return bind(
        both,
        lambda s: bind(
            F.struct(s["all"], F.array_except(s["all"], s["paths"]).alias("dead")),
            lambda d: F.filter(d["all"], lambda x: F.array_contains(d["dead"], x)),
        ),
    )


def entry_dedup(entries: DataFrame, keep: str = "last") -> DataFrame:
    """One entry per bundle and path: the one with the highest ('last') or
    lowest ('first') ordinal.  Combines before the shuffle, so a name repeated
    in very many rows arrives as one row per task."""
    pick = F.max_by if keep == "last" else F.min_by
    return (
        entries.groupBy("bundle_id", "path")
        .agg(pick(F.struct("ordinal", "content"), F.col("ordinal")).alias("e"))
        .select("bundle_id", "path", "e.ordinal", "e.content")
    )


def index_links(entries: DataFrame) -> DataFrame:
    """Links of every index: bundle_id, pos (from 1), target."""
    found = entries.filter(F.col("path") == fixed.INDEX_FILE).select(
        "bundle_id", F.posexplode_outer(links(F.col("content"))).alias("pos", "target")
    )
    return found.filter("pos is not null").select(
        "bundle_id", (F.col("pos") + 1).alias("pos"), "target"
    )


def broken_links(entries: DataFrame) -> DataFrame:
    """Links whose target is no entry of the same bundle.

    Joined on bundle and path together, so a large bundle spreads over tasks.
    """
    targets = entries.select("bundle_id", F.col("path").alias("target"))
    return index_links(entries).join(targets, ["bundle_id", "target"], "left_anti").select(
        "bundle_id", "pos", "target"
    )


def verdict_errors(has_index: Column, has_log: Column, dead: Column) -> Column:
    missing = F.array_compact(
        F.array(F.when(~has_index, fixed.NO_INDEX), F.when(~has_log, fixed.NO_LOG))
    )
    broken = F.transform(dead, lambda x: names.fill(fixed.BROKEN_LINK, x))
    # A bundle without its two files is not looked into any further.
    return F.when(has_index & has_log, broken).otherwise(missing)


def validate_bundles(entries: DataFrame) -> DataFrame:
    """Verdict per bundle: is_valid, has_warns, errors, warnings.

    One pass and no join: every entry gives its own name, an index its links
    too, and names and links meet by (bundle, name), so that a bundle with very
    many entries spreads over tasks.  The second grouping combines before its
    shuffle; the only list in it is that of broken links, all of which stood in
    one index cell.  Where entries have an ``ordinal``, the last of a repeated name
    counts.
    """
    if "ordinal" in entries.columns:
        entries = entry_dedup(entries, "last")
    is_index = F.col("path") == fixed.INDEX_FILE
    linked = F.transform(
        F.when(is_index, links(F.col("content"))),
        lambda x, i: F.struct(x.alias("name"), (i + 1).alias("pos")),
    )
    own = F.array(F.struct(F.col("path").alias("name"), F.lit(None).cast("int").alias("pos")))
    given = entries.select(
        "bundle_id", F.inline_outer(F.when(is_index, F.concat(own, linked)).otherwise(own))
    )
    met = given.groupBy("bundle_id", "name").agg(
        F.max(F.col("pos").isNull()).alias("exists"), F.collect_list("pos").alias("links")
    )
    name = F.col("name")
    broken = F.when(
        ~F.col("exists"), F.transform("links", lambda p: F.struct(p.alias("pos"), name.alias("name")))
    )
    bundles = met.groupBy("bundle_id").agg(
        F.max(F.col("exists") & (name == fixed.INDEX_FILE)).alias("has_index"),
        F.max(F.col("exists") & (name == fixed.LOG_FILE)).alias("has_log"),
        F.sum(F.size("links")).alias("link_count"),
        F.sort_array(F.flatten(F.collect_list(broken))).alias("broken"),
    )
    dead = F.transform("broken", lambda b: b["name"])
    unlinked = F.col("has_index") & F.col("has_log") & (F.col("link_count") == 0)
    no_text = F.expr("cast(array() as array<string>)")
    return bundles.withColumn(
        "errors", verdict_errors(F.col("has_index"), F.col("has_log"), dead)
    ).select(
        "bundle_id",
        (F.size("errors") == 0).alias("is_valid"),
        unlinked.alias("has_warns"),
        "errors",
        F.when(unlinked, F.array(F.lit(fixed.NO_LINKS))).otherwise(no_text).alias("warnings"),
    )
