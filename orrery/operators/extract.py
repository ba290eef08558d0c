"""From raw files and pages to one text per article."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import pages as P
from ..functions import text as T
from .providers import PdfReader

#: Points clipped at the top of the first page, at the top of the others, and at the foot.
HEADER_FIRST, HEADER, FOOTER = 100.0, 50.0, 50.0


def paths_per_stem(files: DataFrame) -> DataFrame:
    """``stem, paths``: the files (``path``) of each stem, in order."""
    return files.groupBy(T.stem(F.col("path")).alias("stem")).agg(F.sort_array(F.collect_list("path")).alias("paths"))


def file_groups(pdf: DataFrame, xml: DataFrame) -> DataFrame:
    """``stem, pdf_path, xml_path``: one row for each stem of either listing (``path``); of several files of a kind the first by name."""
    left = pdf.groupBy(T.stem(F.col("path")).alias("stem")).agg(F.min("path").alias("pdf_path"))
    right = xml.groupBy(T.stem(F.col("path")).alias("stem")).agg(F.min("path").alias("xml_path"))
    return left.join(right, "stem", "full_outer")


def pdf_pages(files: DataFrame, reader: PdfReader) -> DataFrame:
    """``stem, page_num, text, error`` of PDF files (``path, content``): the lines between header and footer.

    A file that can't be read has one row with its error and no text.
    """

    def body(number: int, height: float, lines: list[tuple[float, str]]) -> str:
        top = HEADER_FIRST if number == 0 else HEADER
        return "\n".join(x for y, x in lines if top <= y <= height - FOOTER)

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows: list[tuple] = []
            for stem, content in zip(pdf["stem"], pdf["content"]):
                try:
                    rows += [(stem, i, body(i, h, lines), None) for i, (h, lines) in enumerate(reader.pages(bytes(content)))]
                except Exception as e:  # a reader's own errors are unknown here
                    rows.append((stem, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["stem", "page_num", "text", "error"]).astype({"page_num": "Int32"})

    return files.select(T.stem(F.col("path")).alias("stem"), "content").mapInPandas(run, "stem string, page_num int, text string, error string")


def chosen_source(groups: DataFrame) -> DataFrame:
    """``stem, abstract_text, text, text_source`` from ``pdf_path, xml_path, pdf_text, xml_text, xml_abstract``.

    XML wins unless it is empty and there is a PDF; an article with a PDF only has an empty abstract.
    """
    has_xml, has_pdf = F.col("xml_path").isNotNull(), F.col("pdf_path").isNotNull()
    source = F.when(has_xml & ((F.coalesce("xml_text", F.lit("")) != "") | ~has_pdf), F.lit("xml")).when(has_pdf, F.lit("pdf"))
    abstract = F.when(has_xml, F.coalesce("xml_abstract", F.lit(""))).when(has_pdf, F.lit(""))
    text = F.when(source == "xml", F.coalesce("xml_text", F.lit(""))).when(source == "pdf", F.coalesce("pdf_text", F.lit("")))
    return groups.select("stem", abstract.alias("abstract_text"), text.alias("text"), source.alias("text_source"))


def with_abstracts(articles: DataFrame, abstracts: DataFrame) -> DataFrame:
    """``articles`` (``filename``) with ``abstract``; a miss is empty, and of repeated keys the last (``pos``) wins."""
    last = abstracts.groupBy(F.substring_index("filename", ".", 1).alias("filename")).agg(F.max_by("abstract", "pos").alias("abstract"))
    return articles.join(last, "filename", "left").withColumn("abstract", F.coalesce("abstract", F.lit("")))


def document_texts(pages: DataFrame, keep_prefix: bool = False) -> DataFrame:
    """``stem, text`` of ``stem, page_num, text``: the page automaton over each document's pages.

    A document's pages are one group; they are bounded by the document.
    """
    ordered = F.array_sort(F.collect_list(F.struct("page_num", "text")))
    return pages.groupBy("stem").agg(F.transform(ordered, lambda p: p["text"]).alias("pages")).select("stem", P.document_text(F.col("pages"), keep_prefix).alias("text"))


def with_document_text(df: DataFrame, pages: str, to: str = "text", keep_prefix: bool = False) -> DataFrame:
    """``df`` with the text of the document whose pages, in order, are in the array column; no shuffle."""
    return df.withColumn(to, P.document_text(F.col(pages), keep_prefix))


def without_tables(pages: DataFrame, keep_prefix: bool = False) -> DataFrame:
    """``pages`` with the tables removed from ``text``."""
    return pages.withColumn("text", P.remove_tables(F.col("text"), keep_prefix))
