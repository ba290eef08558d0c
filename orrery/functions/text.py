"""Text expressions: cleaning, page tests, markers and links as Catalyst columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns that decide what is kept.
HYPHEN_BREAK = r"([\p{L}\p{N}_]+)-\n([\p{L}\p{N}_]+)"
WHITE_SPACE = r"(?U)[\s\x1c-\x1f]+"
ABSTRACT_START = r"(?:\n|^)Abstract(?:\:|\.)?\s?"
END_MARKERS = (
    r"(?:\n|^)Appendix ?\S*(?:\n|\:)",
    r"(?:\n|^)Acknowledgements\.",
    r"(?:\n|^)Author contributions\.",
    r"(?:\n|^)References\s*\n",
    r"(?:\n|^)\d?\s?(?:Data|Code|Code and data) availability",
)
LIGATURES = (("ﬂ", "fl"), ("ﬁ", "fi"))
SPARSE_LINES = 12


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def clean(text: Column) -> Column:
    """Join words cut at a line end, then make every run of white space one space."""
    return F.regexp_replace(F.regexp_replace(text, HYPHEN_BREAK, "$1$2"), WHITE_SPACE, " ")


def without_ligatures(text: Column) -> Column:
    for bad, good in LIGATURES:
        text = F.replace(text, F.lit(bad), F.lit(good))
    return text


def is_sparse_page(text: Column) -> Column:
    """Twelve lines or fewer."""
    return F.size(F.split(text, "\n")) <= SPARSE_LINES


def after_abstract(text: Column) -> Column:
    """What follows the first abstract heading; null without one."""
    found = F.regexp_extract(text, "(?s)" + ABSTRACT_START + "(.*)", 1)
    return F.when(text.rlike(ABSTRACT_START), found)


def before_end_marker(text: Column) -> Column:
    """The text up to the first end section; null without one."""
    marker = "|".join(END_MARKERS)
    return F.when(text.rlike(marker), F.regexp_extract(text, f"(?s)^(.*?)(?:{marker})", 1))


def stem(path: Column) -> Column:
    """File name up to its first dot."""
    return F.substring_index(F.element_at(F.split(path, "/"), -1), ".", 1)


def l2_normalized(vector: Column, least: float = 1e-12) -> Column:
    """The vector divided by its norm (or by ``least`` if that is larger)."""
    square = F.aggregate(vector, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return F.transform(vector, lambda x: x.cast("double") / F.greatest(F.sqrt(square), F.lit(least)))


def squared_distance(a: Column, b: Column) -> Column:
    terms = F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2.0)))
    return F.aggregate(terms, F.lit(0.0), lambda s, v: s + v)


# --- links -----------------------------------------------------------------


def tail_parts(url: Column) -> Column:
    """The up to three path parts before the last one, in order (a short list is clamped)."""
    return F.reverse(F.slice(F.reverse(F.split(url, "/")), 2, 3))


def is_image(url: Column) -> Column:
    return F.lower(url).rlike(r"\.(png|jpg)$")


def is_journal(url: Column, domain: str) -> Column:
    host = F.get(F.split(url, "//"), F.lit(1))
    ends = host.endswith(domain) | host.endswith(domain + "/") | host.endswith("articles/")
    return F.coalesce(ends & ~host.contains("www") & ~host.contains("meetings"), F.lit(False))


def is_issue(url: Column) -> Column:
    return url.contains("article") & url.contains("issue") & ~url.contains(".pdf")


def is_article(url: Column) -> Column:
    """All of the three parts before the last are digits; true where there are none."""
    return F.forall(tail_parts(url), lambda p: p.rlike(r"^\d+$"))


def is_void(url: Column) -> Column:
    return url == "javascript:void(0)"


def journal_name(url: Column) -> Column:
    return F.substring_index(F.substring_index(url, "//", -1), ".", 1)


def crawl_url(url: Column) -> Column:
    return F.when(url.contains("articles"), url).otherwise(F.concat(url, F.lit("/articles/")))


def year(url: Column) -> Column:
    last = F.try_element_at(F.split(F.trim(url, F.lit("/")), "/"), F.lit(-1))
    return F.when(last.rlike(r"^\d{4}$"), last).cast("int")


def download_name(url: Column, fmt: str) -> Column:
    return F.concat(journal_name(url), F.lit("-"), F.array_join(tail_parts(url), "-"), F.lit("." + fmt))


def resolved(base: Column, href: Column) -> Column:
    """A root-relative or absolute ``href`` against ``base`` (for other forms see ``sources.html``)."""
    root = F.regexp_extract(base, r"^([a-z]+://[^/]+)", 1)
    return F.when(href.startswith("/"), F.concat(root, href)).otherwise(href)
