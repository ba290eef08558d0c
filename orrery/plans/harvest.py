"""Queries of link harvesting, counting and file grouping."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import crawl, extract, links
from ..sources import shared
from .catalog import load, query

HREFS = r'(?is)<a\s[^>]*?href="([^"]*)"'
LINKS_SQL = rf"""
with found as (select page_id, regexp_extract(url, '^([a-z]+://[^/]+)', 1) root, regexp_extract_all(html, '{HREFS}', 1) l from pages),
flat as (select page_id, unnest(range(0, len(l)))::int pos, root, unnest(l) href from found),
links as (select page_id, pos, case when href like '/%' then root || href else href end url from flat)
"""
ARTICLE_SQL = "select 'https://j' || (o_custkey % 10) || '.example.org/articles/' || (o_orderkey % 7) || '/' || (o_orderkey % 5) || '/' || year(o_orderdate) || '/' url, 'j' || (o_custkey % 10) journal from orders"
YEARS_SQL = f"with a as ({ARTICLE_SQL}), y as (select journal, cast(regexp_extract(url, '/(\\d{{4}})/$', 1) as int) as year, count(*) articles from a group by all)"
FIXTURES = (
    "https://acp.example.org/articles/24/1/2024/", "https://acp.example.org/articles/24/1/2024", "https://acp.example.org/articles/24/1/2024/x.pdf",
    "javascript:void(0)", "mailto:a@b", "https://x", "https://x/", "1/2/", "https://acp.example.org", "https://esd.example.org/articles/",
    "https://www.acp.example.org/", "https://meetings.example.org/", "https://acp.example.org/about", "https://acp.example.org/articles/issue12.html",
)


def _article_urls(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    journal = F.concat(F.lit("j"), (F.col("o_custkey") % 10).cast("string"))
    url = F.concat(F.lit("https://"), journal, F.lit(".example.org/articles/"), F.concat_ws("/", F.col("o_orderkey") % 7, F.col("o_orderkey") % 5, F.year("o_orderdate")), F.lit("/"))
    return o.select(url.alias("url")).withColumn("journal", T.journal_name(F.col("url")))


@query(LINKS_SQL + "select page_id, pos, url from links")
def page_links(spark, sf_dir):
    return links.hrefs(load(spark, sf_dir, "pages"), exclude_images=False)


@query(LINKS_SQL + r"select page_id, count(*) links, count(*) filter (not regexp_matches(lower(url), '\.(png|jpg)$')) kept from links group by page_id")
def image_filter(spark, sf_dir):
    found = links.hrefs(load(spark, sf_dir, "pages"), exclude_images=False)
    return found.groupBy("page_id").agg(F.count(F.lit(1)).alias("links"), F.count_if(~T.is_image(F.col("url"))).alias("kept"))


@query(
    "with u as (select url from pages union all select unnest([" + ", ".join(f"'{x}'" for x in FIXTURES) + r"""]) url),
s as (select url, string_split(url, '//')[2] host, string_split(url, '/') p from u),
q as (select *, list_slice(p, greatest(1, len(p) - 3), len(p) - 1) t from s)
select url,
  coalesce((host like '%.example.org' or host like '%.example.org/' or host like '%articles/') and host not like '%www%' and host not like '%meetings%', false) journal,
  url like '%article%' and url like '%issue%' and url not like '%.pdf%' issue,
  len(list_filter(t, lambda x: not regexp_full_match(x, '\d+'))) = 0 article, url = 'javascript:void(0)' void,
  case when regexp_full_match(string_split(trim(url, '/'), '/')[-1], '\d{4}') then cast(string_split(trim(url, '/'), '/')[-1] as int) end as year,
  string_split(string_split(url, '//')[-1], '.')[1] || '-' || array_to_string(t, '-') || '.pdf' as file,
  case when url like '%articles%' then url else url || '/articles/' end crawl
from q"""
)
def link_predicates(spark, sf_dir):
    u = F.col("url")
    fixtures = spark.createDataFrame([(x,) for x in FIXTURES], "url string")
    found = load(spark, sf_dir, "pages").select("url").unionAll(fixtures)
    return found.select("url", T.is_journal(u, ".example.org").alias("journal"), T.is_issue(u).alias("issue"), T.is_article(u).alias("article"), T.is_void(u).alias("void"), T.year(u).alias("year"), T.download_name(u, "pdf").alias("file"), T.crawl_url(u).alias("crawl"))


@query(f"with a as ({ARTICLE_SQL}) select journal, count(*) articles from a group by journal")
def journal_counts(spark, sf_dir):
    return links.articles_per_journal(_article_urls(spark, sf_dir))


@query(YEARS_SQL + "select * from y")
def journal_year_counts(spark, sf_dir):
    return links.articles_per_year(_article_urls(spark, sf_dir))


@query(YEARS_SQL + "select * from y where year between 1994 and 1996 and articles >= 10")
def year_filter(spark, sf_dir):
    return links.in_years(links.articles_per_year(_article_urls(spark, sf_dir)), 1994, 1996, 10)


@query(YEARS_SQL + "select min(year) min_year, max(year) max_year, min(articles) min_articles, max(articles) max_articles from y")
def count_bounds(spark, sf_dir):
    return links.bounds(links.articles_per_year(_article_urls(spark, sf_dir)))


@query(f"with a as ({ARTICLE_SQL}) select count(*) total, count(distinct journal) journals from a")
def grand_total(spark, sf_dir):
    per = links.articles_per_journal(_article_urls(spark, sf_dir))
    return per.agg(F.sum("articles").alias("total"), F.count(F.lit(1)).alias("journals"))


@query(LINKS_SQL + "select page_id, pos, url from links where page_id % 2 = 0 and url not in (select url from links where page_id % 2 = 1)")
def new_links(spark, sf_dir):
    """The links of even pages as a scrape, those of odd pages as what is there."""
    found = links.hrefs(load(spark, sf_dir, "pages"), exclude_images=False)
    return links.new_links(found.where("page_id % 2 = 0"), found.where("page_id % 2 = 1")).select("page_id", "pos", "url")


@query(f"with a as (select distinct url from ({ARTICLE_SQL})), f as (select url, 'j' || regexp_extract(url, 'j(\\d+)', 1) || '-' || replace(regexp_extract(url, 'articles/(.*)/$', 1), '/', '-') || '.pdf' as file from a) select url, file from f where file not like '%-1995.pdf'")
def download_list(spark, sf_dir):
    """Articles whose file isn't in the folder yet (those of one year are)."""
    urls = _article_urls(spark, sf_dir).select("url").distinct()
    present = urls.where(T.year(F.col("url")) == 1995).select(T.download_name(F.col("url"), "pdf").alias("file"))
    return links.to_download(urls, present, "pdf").select("url", "file")


@query("select distinct url from (select regexp_extract(url, '^([a-z]+://[^/]+)', 1) url from pages order by page_id limit 2000)")
def limit_then_distinct(spark, sf_dir):
    hosts = load(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", r"^([a-z]+://[^/]+)", 1).alias("url"))
    return links.first_then_distinct(hosts, 2000, "page_id")


GROUPS_SQL = """
with pdf as (select 'doc' || doc_id stem, 'pdf/doc' || doc_id || '.v1.pdf' pdf_path, text pdf_text from documents where doc_id % 3 <> 0),
xml as (select 'doc' || doc_id stem, 'xml/doc' || doc_id || '.xml' xml_path, case when doc_id % 4 = 0 then '' else text end xml_text, lang xml_abstract from documents where doc_id % 2 = 0),
g as (select * from pdf full join xml using (stem))
"""


def _listings(spark, sf_dir):
    d = load(spark, sf_dir, "documents")
    path = lambda kind, end: F.concat(F.lit(f"{kind}/doc"), F.col("doc_id").cast("string"), F.lit(end)).alias("path")
    return d.where("doc_id % 3 <> 0").select(path("pdf", ".v1.pdf"), F.col("text").alias("pdf_text")), d.where("doc_id % 2 = 0").select(path("xml", ".xml"), F.when(F.col("doc_id") % 4 == 0, "").otherwise(F.col("text")).alias("xml_text"), F.col("lang").alias("xml_abstract"))


@query(GROUPS_SQL + "select stem, pdf_path, xml_path from g")
def file_groups(spark, sf_dir):
    pdf, xml = _listings(spark, sf_dir)
    return extract.file_groups(pdf, xml)


@query(GROUPS_SQL + """
select stem, case when xml_path is not null then xml_abstract when pdf_path is not null then '' end abstract_text,
  case when xml_path is not null and (xml_text <> '' or pdf_path is null) then xml_text else pdf_text end text,
  case when xml_path is not null and (xml_text <> '' or pdf_path is null) then 'xml' else 'pdf' end text_source from g""")
def source_fallback(spark, sf_dir):
    pdf, xml = _listings(spark, sf_dir)
    groups = extract.file_groups(pdf, xml).join(pdf.withColumnRenamed("path", "pdf_path"), "pdf_path", "left").join(xml.withColumnRenamed("path", "xml_path"), "xml_path", "left")
    return extract.chosen_source(groups)


@query("select 'd' || d.doc_id filename, coalesce('q' || l.quality || 't' || l.toxic, '') abstract from documents d left join labels l using (doc_id)")
def abstract_enrich(spark, sf_dir):
    name = F.concat(F.lit("d"), F.col("doc_id").cast("string"))
    articles = load(spark, sf_dir, "documents").select(name.alias("filename"))
    labels = load(spark, sf_dir, "labels").select(F.concat(name, F.lit(".xml")).alias("filename"), F.concat(F.lit("q"), "quality", F.lit("t"), "toxic").alias("abstract"), F.lit(0).alias("pos"))
    return extract.with_abstracts(articles, labels)


#: Anchors of the ``pages`` table as links of a site that has one address per page.
SITE_SQL = LINKS_SQL + """, n as (select max(page_id) + 1 n from pages),
site as (select page_id, pos, cast((page_id * 3 + pos * 7 + length(url)) % n as bigint) target from links cross join n),
"""


def _site(spark, sf_dir):
    """The pages table as a site: each page's anchors point to pages that follow from their place and length."""
    p = load(spark, sf_dir, "pages")
    n = p.agg((F.max("page_id") + 1).alias("n"))
    found = links.hrefs(p, exclude_images=False).crossJoin(F.broadcast(n))  # one row
    at = lambda k: F.concat(F.lit("https://site.example.org/p/"), k.cast("string"))
    each = found.groupBy("page_id").agg(F.sort_array(F.collect_list(F.struct("pos", ((F.col("page_id") * 3 + F.col("pos") * 7 + F.length("url")) % F.col("n")).alias("target")))).alias("l"))
    html = F.concat(F.lit("<html><body>"), F.array_join(F.transform("l", lambda x: F.concat(F.lit('<p><a class="x" href="'), at(x["target"]), F.lit('">go</a><img src="a.png">'))), ""), F.lit("</body></html>"))
    return p.select("page_id").join(each, "page_id", "left").select(at(F.col("page_id")).alias("url"), F.coalesce(html, F.lit("<html></html>")).alias("html"))


@query(SITE_SQL.replace("with found", "with recursive found", 1) + """w as (
  select page_id, 0 as level from pages where page_id % 100 = 7 union
  select target, level + 1 from w join site using (page_id) where level < 4),
s as (select page_id, min(level)::int as level from w group by page_id),
k as (select page_id, count(*) n from site group by page_id)
select 'https://site.example.org/p/' || page_id url, level, coalesce(n, 0)::int n_links from s left join k using (page_id)""")
def crawl_levels(spark, sf_dir):
    """Four steps from every hundredth page; each page at the first level that reaches it."""
    site = _site(spark, sf_dir)
    roots = load(spark, sf_dir, "pages").where("page_id % 100 = 7").select(F.concat(F.lit("https://site.example.org/p/"), F.col("page_id").cast("string")).alias("url"))
    folder = shared.shared_folder(spark, "walk")
    known = shared.written(site, "site")
    n = crawl.walked(roots, crawl.from_table(known), [crawl.Level()] * 4, folder)
    shared.discarded(known)
    return crawl.seen(spark, folder, n).select("url", "level", F.size("links").alias("n_links"))


PRESS = "https://www.example.org/press/"


def _press(spark, sf_dir):
    """A publisher's site from the pages table: front pages of 50 journals, journals of 50 issues, an issue's articles from a page's anchors."""
    k = F.col("page_id")
    whole = lambda n: F.floor(k / n).cast("string")
    journal = F.concat(F.lit("https://j"), whole(50), F.lit(".example.org"))
    issue = F.concat(journal, F.lit("/articles/issue"), k.cast("string"), F.lit(".html"))
    front = F.concat(F.lit(PRESS), whole(2500))
    p = load(spark, sf_dir, "pages").select("page_id", journal.alias("journal"), issue.alias("issue"), front.alias("front"))
    a = lambda url: F.concat(F.lit('<a href="'), url, F.lit('">x</a>'))
    page = lambda urls: F.concat(F.lit('<html><a href="/about">a</a><a href="javascript:void(0)">b</a><a href="https://www.j1.example.org">c</a>'), F.array_join(F.transform(F.sort_array(urls), a), " "), F.lit("</html>"))
    fronts = p.select("front", "journal").distinct().groupBy("front").agg(F.collect_list("journal").alias("l")).select(F.col("front").alias("url"), page(F.col("l")).alias("html"))
    lists = p.groupBy("journal").agg(F.collect_list("issue").alias("l")).select(F.concat("journal", F.lit("/articles/")).alias("url"), page(F.concat("l", F.transform("l", lambda x: F.concat(x, F.lit(".pdf"))))).alias("html"))
    found = links.hrefs(load(spark, sf_dir, "pages"), exclude_images=False).groupBy("page_id").agg(F.collect_list(F.struct("pos", F.length("url").alias("n"))).alias("l"))
    url = lambda x: F.concat(F.col("journal"), F.lit("/articles/"), x["n"].cast("string"), F.lit("/"), x["pos"].cast("string"), F.lit("/"), (1990 + k % 10).cast("string"), F.lit("/"))
    issues = p.join(found, "page_id").select(F.col("issue").alias("url"), page(F.transform("l", url)).alias("html"))
    return fronts.unionByName(lists).unionByName(issues), fronts.select("url")


@query(LINKS_SQL + """, a as (
  select 'j' || (page_id // 50) journal, 'https://j' || (page_id // 50) || '.example.org/articles/' i, page_id, pos, length(url) n from links)
select journal, i || 'issue' || page_id || '.html' issue, i || n || '/' || pos || '/' || (1990 + page_id % 10) || '/' url, cast(1990 + page_id % 10 as int) as year from a""")
def crawl_articles(spark, sf_dir):
    """The walk from front pages over journals and issues to articles."""
    site, roots = _press(spark, sf_dir)
    folder = shared.shared_folder(spark, "walk")
    known = shared.written(site, "site")
    crawl.walked(roots, crawl.from_table(known), crawl.journal_levels(".example.org"), folder)
    shared.discarded(known)
    found = crawl.article_links(spark, folder, roots, ".example.org")
    return found.select("journal", "issue", "url", T.year(F.col("url")).alias("year"))
