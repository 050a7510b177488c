"""URL filters over time: was a capture listed when it was fetched?

Block lists are given as dated entries ("added on", "removed on"). They become validity
intervals, and every capture is joined as of its fetch time with the intervals of its
host, the domains above it and the directories of its path.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DOMAIN, PREFIX = "domain", "prefix"


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and a final dot; empty if there is none."""
    return F.rtrim(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]*)", 1), F.lit("."))


def path_of(url: Column) -> Column:
    """The path without query and fragment; empty if there is none."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)


def validity_intervals(entries: DataFrame) -> DataFrame:
    """``entries`` (``list``, ``kind``, ``entry``, ``day``, ``listed``) as intervals.

    Gives ``list, kind, entry, valid_from, valid_to``: the entry is listed from the day
    ``valid_from`` up to, but without, ``valid_to`` (null: still listed). ``kind`` is
    ``domain`` (a host and all below it) or ``prefix`` (``host/dir/...`` and all below).
    Of several entries of one day an addition wins; additions of what is listed and
    removals of what is not change nothing. Rows with a null in any column are no entries.
    """
    names = ["list", "kind", "entry", "day", "listed"]
    days = (
        entries.select(*(entries[c] for c in names))
        .na.drop()
        .groupBy("list", "kind", F.lower("entry").alias("entry"), F.col("day").cast("date").alias("day"))
        .agg(F.max(F.col("listed").cast("int")).alias("listed"))
    )
    history = Window.partitionBy("list", "kind", "entry").orderBy("day")
    changes = days.withColumn("before", F.lag("listed", 1, 0).over(history)).where("listed <> before")
    ended = changes.withColumn("valid_to", F.lead("day").over(history)).where("listed = 1")
    return ended.select("list", "kind", "entry", F.col("day").alias("valid_from"), "valid_to")


def _keys(url: Column) -> Column:
    """What a capture can be listed under: (kind, entry) of its domains and directories."""
    labels = F.split(host_of(url), r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.struct(F.lit(DOMAIN).alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("entry")))
    steps = F.filter(F.split(F.lower(path_of(url)), "/"), lambda s: s != "")
    prefixes = F.transform(steps, lambda s, i: F.struct(F.lit(PREFIX).alias("kind"), F.concat(host_of(url), F.lit("/"), F.array_join(F.slice(steps, 1, i + 1), "/")).alias("entry")))
    return F.when(host_of(url) != "", F.concat(domains, prefixes))


def filter_captures(captures: DataFrame, entries: DataFrame, url: str = "url", at: str = "fetched_at") -> DataFrame:
    """The captures with ``blocked``, ``lists`` (sorted names of the lists that held them at
    the time) and ``first_entry`` (``valid_from``, ``kind``, ``entry``, ``list`` of the
    earliest listing among them; null if none).

    Captures without a host or a time are on no list; repeated captures stay repeated. The
    three columns replace any of these names in the input.

    Each distinct (url, time) is looked up once. Intervals are laid out by month between
    the first and the last capture, and both sides meet on (kind, entry, month): a host
    with a third of all captures is spread over its months and split further by the
    adaptive skew join, and an entry that comes and goes daily meets only its month.
    """
    out = [c for c in captures.columns if c not in ("blocked", "lists", "first_entry")]
    names = [f"c{i}" for i in range(len(out))]
    plain = captures.select(*(captures[c].alias(n) for c, n in zip(out, names, strict=True)), captures[url].alias("url_"), captures[at].cast("timestamp").alias("at_"))
    looked = plain.select("url_", "at_").where("url_ is not null and at_ is not null").distinct()
    span = looked.agg(F.min("at_").alias("first"), F.max("at_").alias("last")).first()
    first, last = (F.lit(x).cast("date") for x in (span["first"], span["last"]))
    months = F.sequence(F.trunc(F.greatest("valid_from", first), "MM"), F.least(F.coalesce("valid_to", last), last), F.expr("interval 1 month"))
    intervals = (
        validity_intervals(entries)
        .where((F.col("valid_from") <= last) & (F.col("valid_to").isNull() | (F.col("valid_to") > first)))
        .withColumn("month", F.explode(months))
    )
    keyed = looked.select("url_", "at_", F.trunc("at_", "MM").alias("month"), F.explode(_keys(F.col("url_"))).alias("key"))
    keyed = keyed.select("url_", "at_", "month", "key.kind", "key.entry")
    held = (
        keyed.join(intervals, ["kind", "entry", "month"])
        .where("at_ >= valid_from and (valid_to is null or at_ < valid_to)")
        .groupBy("url_", "at_")
        .agg(F.sort_array(F.collect_set("list")).alias("lists"), F.min(F.struct("valid_from", "kind", "entry", "list")).alias("first_entry"))
    )
    found = plain.join(held, ["url_", "at_"], "left")
    return found.select(
        *(F.col(n).alias(c) for c, n in zip(out, names, strict=True)),
        F.col("lists").isNotNull().alias("blocked"),
        F.coalesce("lists", F.array().cast("array<string>")).alias("lists"),
        "first_entry",
    )
