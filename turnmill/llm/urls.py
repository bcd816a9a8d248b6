"""URL filters by dated lists: an as-of join of captures with list entries.

Lists change: an entry says that a pattern was added to a list, or removed from it, on some
day. The entries of a pattern become validity intervals, and a capture is judged by the
entries that were valid on the day it was fetched, not by those of today.

Patterns are of three kinds: ``domain`` covers a host and all below it, ``host`` one host,
``url`` one address (without scheme, fragment and closing slash). Only DataFrame functions
are used. A host that a third of all captures share does no harm: hosts are judged once per
day on which they were fetched, and captures pick up the verdict by (host, day). The
intervals of a pattern never overlap in a list, so that a join by pattern finds at most one
of each list.

Edge cases: captures with a null, empty or unreadable URL, or without a day, match nothing
and are kept with ``blocked`` false; entries with a null list, kind, pattern or day are
ignored; if a pattern is added and removed on one day, it is removed from that day on;
repeated entries count once; repeated captures each get their row; further columns are
carried along; empty tables give no rows, or no blocked ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
_ADDRESS = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?[^/?#]*([^#]*)"


def host_of(url: Column) -> Column:
    """Host in lower case; null if there is none."""
    host = F.lower(F.regexp_extract(url, _HOST, 1))
    return F.when(host != "", F.regexp_replace(host, r"\.$", ""))


def address_of(url: Column) -> Column:
    """Host and path with query, the form that ``url`` patterns have."""
    path = F.regexp_replace(F.regexp_extract(url, _ADDRESS, 1), "/$", "")
    return F.concat(host_of(url), path)


def domains_of(host: Column) -> Column:
    """The host and every domain above it, down to two labels."""
    labels = F.split(host, r"\.")
    upto = F.greatest(F.size(labels) - 1, F.lit(1))
    return F.transform(F.sequence(F.lit(1), upto), lambda i: F.array_join(
        F.slice(labels, i, F.size(labels) - i + 1), "."))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, kind, pattern, valid_from, valid_to): when a pattern was on a list.

    ``entries`` holds (list, kind, pattern, action, day); the end is not part of the
    interval, and null while it lasts.
    """
    days = (
        entries.where("list is not null and kind is not null and pattern is not null and day is not null")
        .groupBy("list", "kind", "pattern", "day").agg(F.bool_and(F.col("action") == "add").alias("on"))
    )
    history = Window.partitionBy("list", "kind", "pattern").orderBy("day")
    return (
        days.withColumn("valid_to", F.lead("day").over(history)).where(F.coalesce("on", F.lit(False)))
        .select("list", "kind", "pattern", F.col("day").alias("valid_from"), "valid_to")
    )


def _active(keys: DataFrame, valid: DataFrame, by: list[str]) -> DataFrame:
    """Per ``by``: the lists that hold one of its patterns on its day, and the first entry."""
    entry = F.struct("list", "kind", "pattern", "valid_from")
    lasting = F.col("valid_to").isNull() | (F.col("day") < F.col("valid_to"))
    return (
        keys.join(valid, ["kind", "pattern"]).where((F.col("day") >= F.col("valid_from")) & lasting)
        .groupBy(*by).agg(F.sort_array(F.collect_set("list")).alias("lists"), F.min(entry).alias("entry"))
    )


def judged(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Every capture with ``blocked``, ``lists`` and ``entry``, the first of the entries that
    hold on its day. ``captures`` has ``url`` and ``day``."""
    valid = intervals(entries)
    names = [c for c in captures.columns if c not in ("blocked", "lists", "entry")]
    keyed = captures.select(*names, host_of(F.col("url")).alias("_host"), address_of(F.col("url")).alias("_address"))
    host_days = keyed.where("_host is not null and day is not null").select("_host", "day").distinct()
    kinds = F.concat(
        F.array(F.struct(F.lit("host").alias("kind"), F.col("_host").alias("pattern"))),
        F.transform(domains_of(F.col("_host")), lambda d: F.struct(F.lit("domain").alias("kind"), d.alias("pattern"))))
    of_host = _active(host_days.select("_host", "day", F.inline(kinds)), valid.where("kind <> 'url'"), ["_host", "day"])
    pages = keyed.where("_address is not null and day is not null").select(
        "_address", "day", F.lit("url").alias("kind"), F.col("_address").alias("pattern")).distinct()
    of_page = _active(pages, valid.where("kind = 'url'"), ["_address", "day"])
    both = (
        keyed.join(of_host.withColumnsRenamed({"lists": "_hl", "entry": "_he"}), ["_host", "day"], "left")
        .join(of_page.withColumnsRenamed({"lists": "_pl", "entry": "_pe"}), ["_address", "day"], "left")
    )
    none = F.array().cast("array<string>")
    lists = F.array_sort(F.array_union(F.coalesce("_hl", none), F.coalesce("_pl", none)))
    return both.select(
        *names, (F.size(lists) > 0).alias("blocked"), lists.alias("lists"), F.least("_he", "_pe").alias("entry"))


# ---------------------------------------------------------------------------
# The query: captures and lists derived from the pages
# ---------------------------------------------------------------------------

_START = "2024-01-01"


def _hash(x: Column) -> Column:
    return F.conv(F.substring(F.md5(x), 1, 8), 16, 10).cast("long")


def _day(number: Column) -> Column:
    return F.date_add(F.to_date(F.lit(_START)), number.cast("int"))


def captures_of(pages: DataFrame) -> DataFrame:
    """Pages as captures: each with the day it was fetched."""
    return pages.select("page_id", "url", _day(_hash(F.col("page_id").cast("string")) % 365).alias("day"))


def entries_of(pages: DataFrame) -> DataFrame:
    """Dated lists over the hosts, the sites and the addresses of the pages."""
    hosts = pages.select(host_of(F.col("url")).alias("host")).where("host is not null").distinct()
    sites = hosts.select(F.regexp_extract("host", r"^[^.]+\.([^.]+\..+)$", 1).alias("host")).where("host <> ''").distinct()
    addresses = pages.select(address_of(F.col("url")).alias("host")).where("host is not null").distinct()

    def listed(rows, name, kind, share, changes):
        h = F.col("h")
        each = F.array(*[F.struct(F.lit(a).alias("action"), _day(h % span + lag).alias("day"), F.lit(every).alias("every"))
                         for a, span, lag, every in changes])
        return rows.withColumn("h", _hash(F.col("host"))).where(h % share == 0).select(
            F.lit(name).alias("list"), F.lit(kind).alias("kind"), F.col("host").alias("pattern"), "h",
            F.inline(each)).where(h % F.col("every") == 0).select("list", "kind", "pattern", "action", "day")

    changes = [("add", 120, 0, 1), ("remove", 120, 90, 1), ("add", 120, 200, 2)]
    return (
        listed(hosts, "malware", "host", 5, changes)
        .union(listed(sites, "adult", "domain", 7, changes[:2]))
        .union(listed(addresses, "spam", "url", 11, [("add", 300, 0, 1)]))
    )


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judged(captures_of(pages), entries_of(pages)).select(
        "page_id", "url", "day", "blocked", F.array_join("lists", ",").alias("lists"),
        F.col("entry.kind").alias("kind"), F.col("entry.pattern").alias("pattern"),
        F.col("entry.valid_from").alias("valid_from"))


def _sql_hash(x: str) -> str:
    return f"(('0x' || substr(md5({x}), 1, 8))::bigint)"


def _sql_entries(source: str, name: str, kind: str, share: int, changes) -> str:
    return " union all ".join(
        f"select '{name}' as list, '{kind}' as kind, host as pattern, '{action}' as action,"
        f" date '{_START}' + (h % {span} + {lag})::int as day"
        f" from (select host, {_sql_hash('host')} as h from {source}) where h % {share} = 0 and h % {every} = 0"
        for action, span, lag, every in changes)


_CHANGES = [("add", 120, 0, 1), ("remove", 120, 90, 1), ("add", 120, 200, 2)]
OP3_SQL = rf"""
with p as (
  select page_id, url, date '{_START}' + ({_sql_hash('page_id::varchar')} % 365)::int as day,
         regexp_replace(lower(regexp_extract(url, '{_HOST}', 1)), '\.$', '') as host,
         regexp_replace(regexp_extract(url, '{_ADDRESS}', 1), '/$', '') as path
  from pages),
hosts as (select distinct host from p where host <> ''),
sites as (
  select distinct regexp_extract(host, '^[^.]+\.([^.]+\..+)$', 1) as host from hosts
  where regexp_matches(host, '^[^.]+\.([^.]+\..+)$')),
addresses as (select distinct host || path as host from p where host <> ''),
e as ({_sql_entries('hosts', 'malware', 'host', 5, _CHANGES)}
  union all {_sql_entries('sites', 'adult', 'domain', 7, _CHANGES[:2])}
  union all {_sql_entries('addresses', 'spam', 'url', 11, [('add', 300, 0, 1)])}),
d as (select list, kind, pattern, day, bool_and(action = 'add') as is_on from e group by list, kind, pattern, day),
v as (
  select list, kind, pattern, day as valid_from, valid_to
  from (select *, lead(day) over (partition by list, kind, pattern order by day) as valid_to from d) where is_on),
m as (
  select page_id, list, kind, pattern, valid_from
  from p join v on p.day >= v.valid_from and (v.valid_to is null or p.day < v.valid_to) and (
       (v.kind = 'host' and p.host = v.pattern)
    or (v.kind = 'domain' and (p.host = v.pattern or ends_with(p.host, '.' || v.pattern)))
    or (v.kind = 'url' and p.host || p.path = v.pattern))),
r as (
  select page_id, kind, pattern, valid_from,
         row_number() over (partition by page_id order by list, kind, pattern, valid_from) as n from m),
l as (
  select page_id, string_agg(list, ',' order by list) as lists
  from (select distinct page_id, list from m) group by page_id)
select p.page_id, p.url, p.day, l.lists is not null as blocked, coalesce(l.lists, '') as lists,
       r.kind, r.pattern, r.valid_from
from p left join l using (page_id) left join (select * from r where n = 1) r using (page_id)"""
