"""HTML and XML with the standard library's parsers, in Arrow batches."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class _Anchors(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.found: list[str] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "a":
            self.found += [v for k, v in attrs if k == "href" and v is not None][:1]


def anchors(html: str | None, base: str | None, exclude_images: bool = True) -> list[str]:
    """Absolute targets of all anchors in document order; none for a page that wasn't fetched."""
    if html is None:
        return []
    parser = _Anchors()
    parser.feed(html)
    links = [urljoin(base or "", x) for x in parser.found]
    return [x for x in links if not x.lower().endswith((".png", ".jpg"))] if exclude_images else links


def page_links(pages: DataFrame, exclude_images: bool = True) -> DataFrame:
    """``page_id, pos, url`` of every anchor of ``pages`` (``page_id, url, html``), any form of target."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(i, k, u) for i, b, h in zip(pdf["page_id"], pdf["url"], pdf["html"]) for k, u in enumerate(anchors(h, b, exclude_images))]
            yield pd.DataFrame(rows, columns=["page_id", "pos", "url"])

    return pages.select("page_id", "url", "html").mapInPandas(run, "page_id long, pos int, url string")


def _local(tag: object) -> str:
    return tag.rpartition("}")[2] if isinstance(tag, str) else ""


# Elements of a body that are left out.
LEFT_OUT = ("fig", "table-wrap")


def _texts(node: ET.Element, left_out: tuple[str, ...]) -> Iterator[str]:
    yield node.text or ""
    for child in node:
        if _local(child.tag) not in left_out:
            yield from _texts(child, left_out)
        yield child.tail or ""


def _stripped(node: ET.Element, left_out: tuple[str, ...] = ()) -> str:
    return "".join(t.strip() for t in _texts(node, left_out))


def _paragraphs(node: ET.Element) -> Iterator[ET.Element]:
    for child in node:
        if _local(child.tag) not in LEFT_OUT:
            if _local(child.tag) == "p":
                yield child
            yield from _paragraphs(child)


class _Lenient(HTMLParser):
    """Elements of XML that isn't well-formed: stray ampersands are text, what is left open ends with its parent."""

    CDATA_CONTENT_ELEMENTS = ()

    def __init__(self) -> None:
        super().__init__()
        self.root = ET.Element("document")
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.open.append(ET.SubElement(self.open[-1], tag))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        ET.SubElement(self.open[-1], tag)

    def handle_endtag(self, tag: str) -> None:
        at = next((i for i in range(len(self.open) - 1, 0, -1) if self.open[i].tag == tag), None)
        if at is not None:
            del self.open[at:]

    def handle_data(self, data: str) -> None:
        node = self.open[-1]
        if len(node):
            node[-1].tail = (node[-1].tail or "") + data
        else:
            node.text = (node.text or "") + data


def parsed(content: bytes) -> ET.Element:
    """The root of an XML document; one that isn't well-formed is read as far as it makes sense."""
    try:
        return ET.fromstring(content)
    except (ET.ParseError, ValueError):
        parser = _Lenient()
        parser.feed(content.decode("utf-8", "replace"))
        parser.close()
        return parser.root


def xml_abstract(content: bytes) -> str:
    """First paragraph of the first abstract, each text node stripped; empty if there is none."""
    root = parsed(content)
    abstract = next((e for e in root.iter() if _local(e.tag) == "abstract"), None)
    paragraph = next((e for e in abstract.iter() if _local(e.tag) == "p"), None) if abstract is not None else None
    return "" if paragraph is None else _stripped(paragraph)


def xml_body(content: bytes) -> str:
    """Paragraphs of the first body without figures and table wrappers, joined by blank lines; a nested one counts again."""
    root = parsed(content)
    body = next((e for e in root.iter() if _local(e.tag) == "body"), None)
    if body is None:
        return ""
    return "\n\n".join(_stripped(p, LEFT_OUT) for p in _paragraphs(body))


def xml_articles(files: DataFrame) -> DataFrame:
    """``path, xml_abstract, xml_text`` of XML files (``path, content``)."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"path": pdf["path"], "xml_abstract": pdf["content"].map(xml_abstract), "xml_text": pdf["content"].map(xml_body)})

    return files.select("path", F.col("content")).mapInPandas(run, "path string, xml_abstract string, xml_text string")
