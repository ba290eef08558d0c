"""The walk over linked pages against a plain walk, with failures, repeats and a new start half-way."""

import collections

import pytest

from orrery.operators import crawl
from orrery.sources import files

SITE = {
    "https://p.example.org/": ["https://a.example.org", "https://b.example.org/articles/", "https://www.c.example.org", "/about", "https://a.example.org"],
    "https://a.example.org/articles/": ["/articles/issue1.html", "/articles/issue2.html", "/articles/issue1.pdf", "/articles/issue9.html", "x.PNG"],
    "https://b.example.org/articles/": ["https://a.example.org/articles/issue1.html", "https://p.example.org/"],
    "https://a.example.org/articles/issue1.html": ["/articles/1/2/2020/", "/articles/1/2/2020/", "javascript:void(0)", "/about/us/", "/articles/1/3/2021/"],
    "https://a.example.org/articles/issue2.html": ["/articles/2/2/2022/", "/articles/issue1.html"],
}


class Counting:
    """Pages of SITE from the driver's table of them; issue 9 fails."""

    def fetch(self, url):
        if "issue9" in url:
            raise OSError("gone")
        return "<html>" + "".join(f'<a href="{x}">x</a>' for x in SITE.get(url, []))


def roots(spark, *urls):
    return spark.createDataFrame([(u,) for u in urls], "url string")


def test_articles_by_the_way_they_were_reached(spark, tmp_path):
    start = roots(spark, "https://p.example.org/", None)
    levels = crawl.journal_levels(".example.org")
    assert crawl.walked(start, crawl.by_network(Counting(), tries=2, wait=(0, 0)), levels, str(tmp_path)) == 3
    pages = {(r.level, r.url): r for r in crawl.seen(spark, str(tmp_path), 3).collect()}
    assert {k for k in pages} == {(0, "https://p.example.org/"), (1, "https://a.example.org/articles/"), (1, "https://b.example.org/articles/"), *((2, f"https://a.example.org/articles/issue{i}.html") for i in (1, 2, 9))}
    failed = pages[2, "https://a.example.org/articles/issue9.html"]
    assert failed.links == [] and failed.attempts == 2 and failed.error == "OSError: gone"
    found = collections.Counter((r.journal, r.issue.rpartition("/")[2], r.url.partition(".org")[2]) for r in crawl.article_links(spark, str(tmp_path), start, ".example.org").collect())
    one = [("issue1.html", "/articles/1/2/2020/"), ("issue1.html", "/articles/1/2/2020/"), ("issue1.html", "/articles/1/3/2021/")]
    want = collections.Counter()
    for _ in range(2):  # the front page links journal a twice
        want.update([("a", *x) for x in [*one, ("issue2.html", "/articles/2/2/2022/")]])
    want.update([("b", *x) for x in one])
    assert found == want


def test_a_walk_goes_on_after_its_last_whole_level(spark, tmp_path):
    asked = []

    def get(known):
        def fetch(urls):
            asked.append(sorted(r.url for r in urls.collect()))
            return crawl.from_table(spark.createDataFrame([(u, "<a href='%s'>" % "'><a href='".join(x)) for u, x in SITE.items()], "url string, html string"))(urls)

        return fetch

    everywhere = [crawl.Level()] * 3
    assert crawl.walked(roots(spark, "https://p.example.org/"), get(SITE), everywhere[:1], str(tmp_path)) == 2
    (tmp_path / "level=1" / "_SUCCESS").unlink()  # as if it had been broken off
    assert crawl.walked(roots(spark, "https://p.example.org/"), get(SITE), everywhere, str(tmp_path)) >= 3
    assert [len(x) for x in asked[:3]] == [1, 4, 4] and asked[1] == asked[2]
    urls = [r.url for r in crawl.seen(spark, str(tmp_path), 4).collect()]
    assert len(urls) == len(set(urls))
    missing = [r.error for r in crawl.level(spark, str(tmp_path), 1).collect() if r.url not in SITE]
    assert missing and set(missing) == {"no such page"}


def test_nothing_to_walk(spark, tmp_path):
    assert crawl.walked(roots(spark).where("false"), crawl.by_network(Counting()), [crawl.Level()], str(tmp_path)) == 0
    assert files.exists(spark, f"{tmp_path}/level=0/_SUCCESS")


@pytest.mark.parametrize("follow", [True, False])
def test_only_links_that_are_followed(spark, tmp_path, follow):
    level = crawl.Level(lambda u: u.contains("about") if follow else u.isNull())
    n = crawl.walked(roots(spark, "https://p.example.org/"), crawl.by_network(Counting(), wait=(0, 0)), [level], str(tmp_path))
    assert n == (2 if follow else 1)


def test_the_command_walks_and_goes_on(spark, tmp_path):
    from orrery import __main__ as cli

    (tmp_path / "roots.csv").write_text("https://p.example.org/\n")
    args = ["crawl", "--input", f"{tmp_path}/roots.csv", "--walk", f"{tmp_path}/walk", "--domain", ".example.org", "--provider", "tests.test_crawl:Quick"]
    for out in ("one", "two"):
        cli.main([*args, "--output", f"{tmp_path}/{out}"], spark)
    one, two = ([tuple(r) for r in spark.read.parquet(f"{tmp_path}/{out}").collect()] for out in ("one", "two"))
    assert sorted(one) == sorted(two) and len(one) == 11


class Quick(Counting):
    """Pages of SITE, issue 9 empty, so that nothing waits."""

    def fetch(self, url):
        return "" if "issue9" in url else super().fetch(url)
