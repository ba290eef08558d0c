"""URL filters by link-graph propagation.

Rules (block or allow, host, path) judge urls first: a rule fits its host and all subdomains where the url's path starts with
the rule's, and the longest wins.  All other urls get their host's verdict.

Hosts that rules judge are seeds: a host's seed of trust is the share of its pages that rules allow, its seed of distrust
the share that they block.  Trust spreads along links by personalised PageRank (a host passes ``DAMPING`` of what it has on to
the hosts it links to, in equal parts), distrust against them (to the hosts that link to it).  Neither is scaled, so a
host has its own seeds in full and the thresholds mean the same on any number of hosts; every path of
up to ``ROUNDS`` links counts, and what reaches a host without further links ends there.  A host is blocked when its
distrust is above ``THRESHOLD`` (that of a host with so large a share of blocked pages) and above its trust.

A round joins what the last one brought with the edges; only that is written, to the shared folder, and a round that brings
nothing ends it.  Links are the ``href`` of ``a`` elements to another host, absolute or from ``//``, each pair of hosts once;
all others stay on their host.  Hub hosts are summed before the shuffle, and in joins the adaptive plan splits them.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?``, ``#`` or the end.
A null url, or one without ``://``, has neither, fits no rule and is allowed; null pages have no links; repeated rows and null ids stay as
they are (and count as pages); an empty table gives an empty result.  DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discarded, table, written

#: The rules of the query, as verdict, host and path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
DAMPING, ROUNDS, THRESHOLD = 0.85, 20, 0.5
#: Host of a link to elsewhere; ``[^<>]`` ends a broken tag at the next one.
HREF_HOST = r"""(?i)<a\s(?:[^<>]*?\s)?href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rule = tuple[str, str, str]


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def ruled(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule (as ``hostpath``) and its verdict, or nulls; at one length the first listed."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for told, own_host, own_path in reversed(sorted(rules, key=lambda r: -len(r[1] + r[2]))):
        if told not in ("allow", "block"):
            raise ValueError("a rule allows or blocks")
        fits = ((host == own_host) | F.endswith(host, F.lit(f".{own_host}"))) & F.startswith(path, F.lit(own_path))
        rule, verdict = F.when(fits, own_host + own_path).otherwise(rule), F.when(fits, told).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """``a, b``: the hosts whose pages (``url, html``) link to another host, each pair once."""
    found = pages.select(host_of(F.col("url")).alias("a"), F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(HREF_HOST), 1))).alias("b"))
    return found.withColumn("b", F.translate("b", UPPER, LOWER)).where("a <> '' and a <> b").distinct()


def _shares(edges: DataFrame) -> DataFrame:
    """``kind, from, to, share``: trust along the links, distrust against them, each in equal parts of its source."""

    def one(kind: str, source: str, target: str) -> DataFrame:
        degrees = edges.groupBy(source).agg((F.lit(1.0) / F.count(F.lit(1))).alias("share"))
        return edges.join(degrees, source).select(F.lit(kind).alias("kind"), F.col(source).alias("from"), F.col(target).alias("to"), "share")

    return one("trust", "a", "b").union(one("distrust", "b", "a"))


def propagated(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """``host, trust, distrust`` of every host that has any, from ``edges`` (``a, b``) and ``seeds`` (``host, trust, distrust``, one row a host)."""
    shares = written(_shares(edges), "shares")
    kinds = F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).cast("double").alias("value")) for k in ("trust", "distrust")]))
    brought = [written(seeds.select("host", kinds).where("value > 0"), "seeds")]
    for _ in range(rounds):
        last = brought[-1].select("kind", F.col("host").alias("from"), "value")
        passed = last.join(shares, ["kind", "from"]).groupBy("kind", F.col("to").alias("host")).agg((damping * F.sum(F.col("value") * F.col("share"))).alias("value"))
        new = written(passed.select("host", "kind", "value"), "trust")
        if new.isEmpty():
            discarded(new)
            break
        brought.append(new)
    total = lambda k: F.sum(F.when(F.col("kind") == k, F.col("value")).otherwise(0.0)).alias(k)
    out = written(reduce(DataFrame.union, brought).groupBy("host").agg(total("trust"), total("distrust")), "hosts")
    discarded(shares, *brought)
    return out


def with_verdicts(pages: DataFrame, rules: Sequence[Rule] = RULES, threshold: float = THRESHOLD, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """All rows and columns of ``pages`` (``url, html, ...``) with ``host, path, rule, verdict, trust, distrust``, which replace columns of those names.

    The rules go into the plan one by one, so they are for lists of some hundreds.  Columns whose names begin with ``__url_`` are reserved.
    """
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    own = pages.select("url").select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).select("host", verdict.alias("verdict"))
    share = lambda v: (F.count_if(F.col("verdict") == v) / F.count(F.lit(1)))
    seeds = own.where("host <> ''").groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust"))
    edges = written(host_edges(pages), "edges")
    hosts = propagated(edges, seeds, damping, rounds).select(F.col("host").alias("__url_host"), F.col("trust").alias("__url_trust"), F.col("distrust").alias("__url_distrust"))
    discarded(edges)
    made = ("host", "path", "rule", "verdict", "trust", "distrust")
    named = pages.drop(*made).withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    joined = named.join(hosts, F.col("host") == F.col("__url_host"), "left").withColumns({"trust": F.coalesce("__url_trust", F.lit(0.0)), "distrust": F.coalesce("__url_distrust", F.lit(0.0))})
    by_host = F.when((F.col("distrust") > threshold) & (F.col("distrust") > F.col("trust")), "block").otherwise("allow")
    return joined.withColumns({"rule": rule, "verdict": F.coalesce(verdict, by_host)}).drop("__url_host", "__url_trust", "__url_distrust")


def op13_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict by its rule, else by its host's trust and distrust."""
    judged = with_verdicts(table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict", F.round("trust", 6).alias("trust"), F.round("distrust", 6).alias("distrust"))


ORACLE = r"""
with recursive r as (
  select page_id, html, coalesce(case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) end, '') rest from pages),
h as (
  select page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) path from r),
j as (
  select *, case when (host = 'example.net' or host like '%.example.net') and path like '/en/%' then 'example.net/en/'
    when (host = 'example.com' or host like '%.example.com') and path like '/de/%' then 'example.com/de/'
    when (host = 'org' or host like '%.org') and path like '/fr/%' then 'org/fr/'
    when (host = 'net' or host like '%.net') and path like '/%' then 'net/' end as rule from h),
v as (select *, case when rule in ('example.net/en/', 'org/fr/') then 'allow' when rule is not null then 'block' end told from j),
e as (
  select distinct host a, b from (
    select host, translate(unnest(regexp_extract_all(html, '(?i)<a\s(?:[^<>]*?\s)?href\s*=\s*["'']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"''\s<>]+)', 1)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') b from v)
  where host <> '' and host <> b),
shares as (
  select 'trust' kind, a source, b target, 1.0::double / count(*) over (partition by a) share from e union all
  select 'distrust', b, a, 1.0::double / count(*) over (partition by b) from e),
seeds as (
  select 'trust' kind, host, count(*) filter (told = 'allow') / count(*)::double as worth from v where host <> '' group by host union all
  select 'distrust', host, count(*) filter (told = 'block') / count(*)::double from v where host <> '' group by host),
brought as (
  select 0 step, kind, host, worth from seeds where worth > 0 union all
  select step + 1, s.kind, target, 0.85::double * sum(worth * share) from brought b join shares s on s.kind = b.kind and s.source = b.host where step < 20 group by step, s.kind, target),
hosts as (select host, coalesce(sum(worth) filter (kind = 'trust'), 0) trust, coalesce(sum(worth) filter (kind = 'distrust'), 0) distrust from brought group by host)
select page_id, host, path, rule, coalesce(told, case when distrust > 0.5 and distrust > trust then 'block' else 'allow' end) verdict, round(coalesce(trust, 0), 6) trust, round(coalesce(distrust, 0), 6) distrust
from v left join hosts using (host)
"""
