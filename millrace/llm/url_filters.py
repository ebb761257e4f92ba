"""URL filters with dated lists, in DataFrame operations only.

A list changes over time: an entry names a pattern and is added or removed at a date.  Dated
entries become validity intervals; every capture is judged by the entries active when it was
fetched.  Kinds of patterns: ``host`` (that host), ``domain`` (it and its subdomains),
``prefix`` (host and leading path segments).

Joining as of a time works in cells of one month.  A pattern's events are ordered within
their cell; between cells only the state at a cell's end is carried on, to the months in which a
capture shows the pattern, so intervals follow entries and captures and not the span of time
between them, were one capture in the year 9999.  A capture shows its host, the domains above
it and the prefixes of its path, and meets the intervals of the same pattern and month by an
equality join with a time condition.  So neither a host with a third of all captures nor a
pattern with a third of all entries is ever one group: events are grouped by pattern and
month, captures are only joined, which Spark can split at hot keys.

Captures are judged once per (url, time), whatever the number of rows.

Rules: of events of a pattern at one instant a removal wins; an entry holds from its own
instant on; events without pattern, kind or time are no entries; patterns and hosts compare
in lower case.  Edge cases: captures without url or time are not blocked; urls that are none
have an empty host and match nothing; null and repeated ids stay rows of their own; empty
lists or captures are fine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.common import written

_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def host(url: Column) -> Column:
    """Host in lower case; empty where there is none."""
    return F.lower(F.regexp_extract(url, _HOST, 1))


def path(url: Column) -> Column:
    return F.regexp_extract(url, _PATH, 1)


def patterns(url: Column) -> Column:
    """All (kind, pattern) that could name a url."""
    labels, segments = F.split(host(url), r"\."), F.array_remove(F.split(path(url), "/"), "")

    def item(kind: str, pattern: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), pattern.alias("pattern"))

    one = F.array(item("host", host(url)))
    above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: item("domain", F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    below = F.when(F.size(segments) == 0, F.array().cast("array<struct<kind:string,pattern:string>>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(segments)), lambda n: item("prefix", F.lower(F.concat(host(url), F.lit("/"), F.array_join(F.slice(segments, 1, n), "/")))))
    )
    return F.when(host(url) != "", F.concat(one, above, below))


def intervals(entries: DataFrame, cells: DataFrame) -> DataFrame:
    """(list, kind, pattern, cell, start, stop): when an entry holds, cut at month borders.

    ``entries`` has list, kind, pattern, action ("add" or "remove") and at.  Between its events an
    entry is written out only for the months of ``cells`` (kind, pattern, cell), those asked for.
    """
    key = ["list", "kind", "pattern"]
    known = entries.select("list", "kind", F.lower("pattern").alias("pattern"), "action", "at", F.trunc("at", "month").alias("cell")).dropna()
    events = known.groupBy(*key, "cell", "at").agg((F.max("action") == "add").alias("on"))
    inside = events.withColumn("stop", F.lead("at").over(Window.partitionBy(*key, "cell").orderBy("at")))
    end = F.add_months("cell", 1).cast("timestamp")
    own = inside.where("on").select(*key, "cell", F.col("at").alias("start"), F.coalesce("stop", end).alias("stop"))
    ends = events.groupBy(*key, "cell").agg(F.max_by("on", "at").alias("on"), F.min("at").alias("first"))
    asked = cells.join(ends.select(*key).distinct(), ["kind", "pattern"]).select(*key, "cell", F.lit(True).alias("asked"))
    before = Window.partitionBy(*key).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.join(asked, [*key, "cell"], "full").withColumn("held", F.last("on", ignorenulls=True).over(before))
    held = carried.where("asked and held").select(*key, "cell", F.col("cell").cast("timestamp").alias("start"), F.coalesce("first", end).alias("stop"))
    return own.unionByName(held).where("start < stop")


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``id``, blocked, n_lists and lists (sorted, joined by commas) of every row of ``captures`` (id, url, fetched_at)."""
    single = captures.select("url", "fetched_at").dropna().distinct()
    shown = single.select("url", "fetched_at", F.trunc("fetched_at", "month").alias("cell"), F.explode(patterns(F.col("url"))).alias("p")).select("url", "fetched_at", "cell", "p.*")
    active = written(intervals(entries, shown.select("kind", "pattern", "cell").distinct()), "intervals")
    met = shown.join(active, ["kind", "pattern", "cell"]).where((F.col("start") <= F.col("fetched_at")) & (F.col("fetched_at") < F.col("stop")))
    found = written(met.groupBy("url", "fetched_at").agg(F.array_sort(F.collect_set("list")).alias("lists")), "judged")
    lists = F.coalesce("lists", F.array().cast("array<string>"))
    return captures.join(found, ["url", "fetched_at"], "left").select(
        "id", (F.size(lists) > 0).alias("blocked"), F.size(lists).cast("long").alias("n_lists"), F.array_join(lists, ",").alias("lists")
    )


def _number(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 6), 16, 10).cast("long")


def _at(days: Column, seconds: Column | int = 0) -> Column:
    return F.timestamp_add("SECOND", days * 86400 + seconds, F.lit("2022-01-01").cast("timestamp"))


def captures_of(pages: DataFrame) -> DataFrame:
    """Pages as captures; the table has no time, so it is read off a digest of id and url."""
    n = _number(F.concat_ws("|", "page_id", "url"))
    return pages.select(F.col("page_id").alias("id"), "url", _at(n % 1000, n % 86400).alias("fetched_at"))


def lists_of(pages: DataFrame) -> DataFrame:
    """Dated entries of three lists, read off digests of the hosts, domains and first path segments that occur."""
    url = F.col("url")
    parts = pages.where(host(url) != "").select(
        host(url).alias("host"), F.array_join(F.slice(F.split(host(url), r"\."), -2, 2), ".").alias("domain"),
        F.lower(F.concat(host(url), F.lit("/"), F.regexp_extract(path(url), "^/([^/]+)", 1))).alias("prefix"),
    ).where(F.size(F.split("host", r"\.")) > 1)

    def dated(name: str, kind: str, every: int) -> DataFrame:
        n = _number(F.concat(F.lit(name), F.col(kind)))
        steps = F.array(*[
            F.struct(F.lit(action).alias("action"), _at(n % 500 + days).alias("at"), when.alias("valid"))
            for action, days, when in (("add", F.lit(0), n % every == 0), ("remove", n % 150 + 1, n % 2 == 0), ("add", n % 150 + 200, n % 4 == 0), ("remove", n % 150 + 200, n % 8 == 0))
        ])
        return parts.select(kind).distinct().where(n % every == 0).select(F.lit(name).alias("list"), F.lit(kind).alias("kind"), F.col(kind).alias("pattern"), F.explode(steps).alias("s")).where("s.valid").select("list", "kind", "pattern", "s.action", "s.at")

    return dated("spam", "host", 3).unionByName(dated("adult", "domain", 2)).unionByName(dated("malware", "prefix", 5))
