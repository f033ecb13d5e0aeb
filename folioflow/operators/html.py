"""Pages of a repository: meta tags, label and value rows, links and listing tables, as rows."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_VOID = frozenset(("meta", "link", "br", "img", "hr", "input"))


class Page(HTMLParser):
    """Collects (kind, name, value, row, column): meta tags, the title, links with their text, and cells of
    tables, each by its own innermost table."""

    def __init__(self, base: str) -> None:
        super().__init__(convert_charrefs=True)
        self.base, self.rows = base, []
        self.text: list[str] = []
        self.href: str | None = None
        self.link: list[str] = []
        self.tables: list[list[int]] = []
        self.cell: list[list[str]] = []
        self.seen = 0
        self.title = False
        self.hidden = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        a = {k: v or "" for k, v in attrs}
        if tag == "meta" and (a.get("name") or a.get("property")):
            self.rows.append(("meta", a.get("name") or a.get("property"), a.get("content", ""), None, None))
        elif tag == "a" and "href" in a:
            self.href, self.link = urljoin(self.base, a["href"].strip()), []
        elif tag == "title":
            self.title = True
        elif tag == "table":
            self.seen += 1
            self.tables.append([self.seen, -1, -1])
        elif tag == "tr" and self.tables:
            self.tables[-1][1:] = [self.tables[-1][1] + 1, -1]
        elif tag in ("td", "th") and self.tables:
            self.tables[-1][2] += 1
            self.cell.append([])
        elif tag in ("script", "style"):
            self.hidden += 1

    def handle_endtag(self, tag: str) -> None:
        if tag == "a" and self.href is not None:
            self.rows.append(("link", self.href, " ".join("".join(self.link).split()), None, None))
            self.href = None
        elif tag == "title":
            self.title = False
        elif tag in ("td", "th") and self.tables and self.cell:
            table, row, column = self.tables[-1]
            self.rows.append(("cell", str(table), " ".join("".join(self.cell.pop()).split()), row, column))
        elif tag == "table" and self.tables:
            self.tables.pop()
        elif tag in ("script", "style"):
            self.hidden = max(0, self.hidden - 1)

    def handle_data(self, data: str) -> None:
        if self.hidden:
            return
        if self.title:
            self.rows.append(("title", "title", data.strip(), None, None))
        if self.href is not None:
            self.link.append(data)
        if self.cell:
            self.cell[-1].append(data)


def page_rows(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, n, kind, name, value, row, column) of every page, in document order; a null page has none."""
    kind = pages.schema[key].dataType.simpleString()
    ddl = f"key {kind}, n int, kind string, name string, value string, row int, column int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for k, u, h in zip(*(c.to_pylist() for c in b.columns)):
                p = Page(u or "")
                p.feed(h or "")
                out += [(k, n, *r) for n, r in enumerate(p.rows)]
            types = [b.schema.types[0], pa.int32(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)] if out else [pa.array([], t) for t in types], ["key", "n", "kind", "name", "value", "row", "column"])

    return pages.select(F.col(key).alias("key"), url, html).mapInArrow(run, ddl).withColumnRenamed("key", key)


def metadata(rows: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, name, values): meta tags and label and value table rows under one lower-case name, values in
    order without repeats; a table row goes before a tag of the same name."""
    tags = rows.where("kind = 'meta'").select(key, F.lower("name").alias("name"), "value", F.lit(1).alias("late"), "n")
    cells = rows.where("kind = 'cell'")
    label = cells.where("column = 0").select(key, F.col("name").alias("t"), "row", F.lower(F.regexp_replace("value", r"\s*:\s*$", "")).alias("name"))
    value = cells.where("column = 1").select(key, F.col("name").alias("t"), "row", "value", "n")
    pairs = label.join(value, [key, "t", "row"]).where("name <> '' and value <> ''").select(key, "name", "value", F.lit(0).alias("late"), "n")
    both = pairs.unionByName(tags).groupBy(key, "name").agg(F.array_sort(F.collect_list(F.struct("late", "n", "value"))).alias("v"))
    return both.select(key, "name", F.array_distinct(F.transform("v", lambda x: x["value"])).alias("values"))


def file_links(rows: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, n, url, label): links to files, the first of each address."""
    links = rows.where((F.col("kind") == "link") & F.lower("name").rlike(r"(/bitstream/|\.pdf($|\?)|viewfile)"))
    return links.groupBy(key, F.col("name").alias("url")).agg(F.min("n").alias("n"), F.min_by("value", "n").alias("label"))


def listing_rows(rows: DataFrame, least: int = 4, key: str = "page_id") -> DataFrame:
    """(key, table, row, cells): table rows of ``least`` cells or more, as arrays."""
    cells = rows.where("kind = 'cell'").groupBy(key, F.col("name").alias("table"), "row").agg(F.array_sort(F.collect_list(F.struct("column", "value"))).alias("c"))
    return cells.where(F.size("c") >= least).select(key, "table", "row", F.transform("c", lambda x: x["value"]).alias("cells"))


# How labels, titles and file names say the language of a file.
HINDI = r"(?i)(हिन्दी|हिंदी|\bhindi\b|[_\-]h(in)?\.pdf$)"
ENGLISH = r"(?i)(\benglish\b|\beng\b|[_\-]e(ng)?\.pdf$)"


def link_language(label: str = "label", url: str = "url"):  # noqa: ANN201
    """hi, en or undetermined for a file, evidence of Hindi first, then of English."""
    said = F.concat_ws(" ", label, url)
    return F.when(said.rlike(HINDI) | F.col(label).rlike(r"[ऀ-ॿ]"), "hi").when(said.rlike(ENGLISH), "en").otherwise("undetermined")


def the_english_file(links: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, url, refusal): the one English file of each page, or why there is none to take."""
    en = F.col("language") == "en"
    per = links.groupBy(key).agg(F.count_if(en).alias("n"), F.min(F.when(en, F.col("url"))).alias("url"), F.count_if(F.col("language") == "hi").alias("hi"))
    return per.select(key, F.when(F.col("n") == 1, F.col("url")).alias("url"), F.when(F.col("n") > 1, "several English files").when((F.col("n") == 0) & (F.col("hi") > 0), "only Hindi").when(F.col("n") == 0, "undetermined").alias("refusal"))
