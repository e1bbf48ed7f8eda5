"""Pages in Spark SQL: a data source that reads all pages of a list, and a table function that parses one page.

The source reads a folder that holds page n of a list under `page=n/`, as files whose contents together are the page. The first
page's pager says how many there are; each page is a partition, read and parsed by the task that gets it. Filters on the house and on dates are
applied before rows leave the task. A page that is missing, broken or another than asked for gives no rows; where a folder for
failures is named, the task writes the reason there. Folders are reached by pyarrow's file systems.
"""

from __future__ import annotations

import codecs
import datetime as dt
import pickle
import re
import tempfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult
from pyspark.sql.types import StructType

from . import html, pages

SCHEMAS = {
    "listing": "page int, house string, date date, url string, title string, session_type string",
    "members": f"page int, {pages.MEMBER}",
}
#: Bytes of a page that are read at once, and rows that a task holds in memory.
PIECE, HELD = 1 << 20, 10_000
# The shape of a listing's titles.
TITLE = re.compile(r"(\w+day),?\s+(\d{1,2})(?:st|nd|rd|th)?,?\s+([A-Za-z]+),?\s+(\d{4})\s*-\s*(.+)", re.S)


def _system(path: str):
    """The file system of a path or URI, and the path in it."""
    from pyarrow.fs import FileSystem, LocalFileSystem

    if re.match(r"\w+:", path):
        return FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return LocalFileSystem(), path


def page(path: str, n: int) -> Iterator[str]:
    """The text of page n, in pieces."""
    from pyarrow.fs import FileSelector

    fs, root = _system(path)
    files = sorted(f.path for f in fs.get_file_info(FileSelector(f"{root}/page={n}")) if f.base_name[0] not in "._")
    if not files:
        raise FileNotFoundError(f"page {n}")
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    for f in files:
        with fs.open_input_stream(f) as stream:
            while data := stream.read(PIECE):
                yield decoder.decode(data)
        yield decoder.decode(b"", True)


def listed(x: dict) -> tuple | None:
    """house, date, url, title, session_type of a link of a listing page; None if its title has no date."""
    m = TITLE.search(x["title"])
    try:
        date = dt.datetime.strptime(f"{m[2]} {m[3].capitalize()} {m[4]}", "%d %B %Y").date() if m else None
    except ValueError:
        date = None
    return ("Senate" if x["position"] else "National Assembly", date, x["url"], x["title"], m[5].strip()) if date else None


class SavedPages(DataSource):
    """spark.read.format("saved_pages").option("path", ...); options: kind (listing, members), failures (a folder)."""

    @classmethod
    def name(cls) -> str:
        return "saved_pages"

    def schema(self) -> str:
        return SCHEMAS[self.options.get("kind", "listing")]

    def reader(self, schema: StructType) -> DataSourceReader:
        return SavedPagesReader(dict(self.options), schema.names)


class SavedPagesReader(DataSourceReader):
    KEPT = {EqualTo: lambda x, y: x == y, GreaterThan: lambda x, y: x > y, GreaterThanOrEqual: lambda x, y: x >= y, LessThan: lambda x, y: x < y, LessThanOrEqual: lambda x, y: x <= y}

    def __init__(self, options: dict, names: list[str]):
        self.path, self.kind, self.failures = options["path"], options.get("kind", "listing"), options.get("failures")
        self.names, self.tests = names, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes comparisons of house, date and page; the others stay with Spark."""
        for f in filters:
            if type(f) in self.KEPT and f.attribute[0] in ("house", "date", "page") and f.attribute[0] in self.names:
                self.tests.append((self.names.index(f.attribute[0]), type(f), f.value))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        first = html.Saved("pager")
        for _ in first.rows(page(self.path, 1)):
            pass
        info = first.info
        if not info:
            raise pages.PageOutOfRange("page 1 has no pager")
        wanted = [n for n in range(1, info["last"] + 1) if all(self.KEPT[test](n, value) for at, test, value in self.tests if self.names[at] == "page")]
        return [InputPartition(n) for n in wanted] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        n = partition.value
        if n is None:
            return
        saved = html.Saved(self.kind)
        with tempfile.TemporaryFile() as held:  # a page gives no rows until all of it has been read
            try:
                rows, count = [], 0
                for x in saved.rows(page(self.path, n)):
                    row = listed(x) if self.kind == "listing" else (x["name"], x["url"], x["role"], x["constituency"])
                    if row and all((n, *row)[at] is not None and self.KEPT[test]((n, *row)[at], value) for at, test, value in self.tests):
                        rows.append((n, *row))
                    if len(rows) == HELD:
                        pickle.dump(rows, held)
                        rows, count = [], count + 1
                if not saved.info:
                    raise pages.PageOutOfRange(f"page {n} has no pager")
                pages.check_page(n, saved.info["current"], saved.info["last"])
            except Exception as e:  # noqa: BLE001  one page costs no other
                self._failed(n, f"{type(e).__name__}: {e}")
                return
            held.seek(0)
            for _ in range(count):
                yield from pickle.load(held)
            yield from rows

    def _failed(self, n: int, why: str) -> None:
        if self.failures:
            fs, root = _system(self.failures)
            fs.create_dir(root, recursive=True)
            with fs.open_output_stream(f"{root}/page-{n}.txt") as out:  # the same file again, if a task is
                out.write(why.encode())


def register(spark: SparkSession) -> None:
    """Makes the source and the table function known to a session."""
    spark.dataSource.register(SavedPages)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.udtf.register("parse_page", page_function())


def all_pages(spark: SparkSession, path: str, kind: str = "listing", failures: str | None = None) -> DataFrame:
    """Rows of all pages of a list, by its pager."""
    register(spark)
    reader = spark.read.format("saved_pages").option("path", path).option("kind", kind)
    return (reader.option("failures", failures) if failures else reader).load()


def failures(spark: SparkSession, path: str) -> DataFrame:
    """page, error of what failed; empty where nothing has."""
    from pyarrow.fs import FileType

    fs, root = _system(path)
    if fs.get_file_info(root).type != FileType.Directory:
        return spark.createDataFrame([], "page int, error string")
    rows = spark.read.text(path, wholetext=True).select("_metadata.file_name", F.col("value").alias("error"))
    return rows.select(F.regexp_extract("file_name", r"page-(\d+)", 1).cast("int").alias("page"), "error")


def write_pages(rows: DataFrame, path: str, *order: str) -> None:
    """Saves pages (page, html) in the layout that the source reads. order: html is of parts of pages, as lines in this order, and
    a page is written by all tasks, without being whole anywhere."""
    if order:
        rows = rows.repartitionByRange(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "page", *order).sortWithinPartitions("page", *order)
    else:
        rows = rows.repartition("page")
    rows.select("html", "page").write.partitionBy("page").text(path)


KINDS = {
    "sitting": (html.current_sitting, pages.SITTING),
    "listing": (html.listing_links, "position int, url string, title string"),
    "members": (html.members, pages.MEMBER),
    "bills": (html.bills, pages.BILL),
    "votes": (html.votes, pages.VOTE),
    "activity": (html.activity, pages.ACTIVITY),
    "profile": (html.profile, pages.PROFILE),
    "links": (html.links, "href string, label string"),
}


def page_function():
    """The table function of a session: select * from pages, lateral parse_page(html, 'sitting'). Its rows are those of the page and, for
    one that cannot be parsed, a row with nothing but the error. The kind is one of KINDS."""
    types = {kind: StructType.fromDDL(f"{schema}, error string") for kind, (_, schema) in KINDS.items()}  # needs the session

    class ParsePage:
        @staticmethod
        def analyze(page: AnalyzeArgument, kind: AnalyzeArgument) -> AnalyzeResult:
            if not kind.isConstantExpression or kind.value not in types:
                raise ValueError(f"the kind is one of {', '.join(types)}")
            return AnalyzeResult(types[kind.value])

        def eval(self, page: str, kind: str):
            names = types[kind].names[:-1]
            if not (page or "").strip():
                return
            try:
                made = KINDS[kind][0](page)
            except Exception as e:  # noqa: BLE001  told in the row
                yield (*[None] * len(names), f"{type(e).__name__}: {e}"[:500])
                return
            for row in made if isinstance(made, list) else [made] if made else []:
                yield (*[row[c] for c in names], None)

    return F.udtf(ParsePage)
