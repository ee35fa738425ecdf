"""Payment sheets: a reader of the first sheet of an .xlsx by the standard library, and its typed rows.

`spark.dataSource.register(SheetSource)` makes `spark.read.format("sheet").load(path)` return row (int) and
cells (map of column letters to text).  A workbook is one partition, as its parts are one zip.
"""

from __future__ import annotations

import io
import re
import zipfile
from xml.etree import ElementTree

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader

from docledger.functions import text as x


def _tag(element) -> str:
    return element.tag.rpartition("}")[2]


def _texts(element) -> str:
    return "".join(e.text or "" for e in element.iter() if _tag(e) == "t")


def sheet_cells(content: bytes) -> list[tuple[int, dict[str, str]]]:
    """(row number, cells by column letters) of the first sheet; shared and inline strings are resolved."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = z.namelist()
        shared: list[str] = []
        if "xl/sharedStrings.xml" in names:
            shared = [_texts(e) for e in ElementTree.fromstring(z.read("xl/sharedStrings.xml")) if _tag(e) == "si"]
        sheets = sorted((n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.search(r"\d+", n.rpartition("/")[2])[0]))
        root = ElementTree.fromstring(z.read(sheets[0]))
    rows = []
    for row in (e for e in root.iter() if _tag(e) == "row"):
        cells = {}
        for c in (e for e in row if _tag(e) == "c"):
            value = next((e.text or "" for e in c if _tag(e) == "v"), "")
            kind = c.get("t")
            letters = re.match("[A-Z]+", c.get("r", ""))[0]
            cells[letters] = shared[int(value)] if kind == "s" else _texts(c) if kind == "inlineStr" else value
        rows.append((int(row.get("r")), cells))
    return rows


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def read(self, partition):
        with open(self.path, "rb") as f:
            yield from sheet_cells(f.read())


class SheetSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sheet"

    def schema(self) -> str:
        return "row int, cells map<string,string>"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])


def read_sheets(spark, path: str) -> DataFrame:
    """path, row, cells of workbooks in any store that Spark reads."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def parsed(batches):
        import pyarrow as pa

        for b in batches:
            out = [(p, r, list(c.items())) for p, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for r, c in sheet_cells(content)]
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.int32()), pa.array([o[2] for o in out], pa.map_(pa.string(), pa.string()))], ["path", "row", "cells"])

    return files.mapInArrow(parsed, "path string, row int, cells map<string,string>")


#: Columns of a payment sheet.
COLUMNS = {"A": "account", "B": "origin", "C": "date_text", "D": "month", "E": "amount_raw", "F": "concept"}


def payment_rows(cells: DataFrame, header_row: int = 1) -> tuple[DataFrame, DataFrame]:
    """(typed rows, stated totals) of a sheet; blank rows are skipped, a row whose account says total is one."""
    values = [F.nullif(F.btrim(F.try_element_at("cells", F.lit(k))), F.lit("")).alias(v) for k, v in COLUMNS.items()]
    rows = cells.where(F.col("row") > header_row).select(F.col("row").alias("excel_row"), *values)
    rows = rows.where(F.coalesce(*COLUMNS.values()).isNotNull()).withColumn("p", x.parse_amount(F.col("amount_raw")))
    rows = rows.select(*[c for c in rows.columns if c != "p"], F.col("p.amount").alias("amount"), F.col("p.status").alias("amount_status"))
    is_total = x.fold(F.coalesce("account", F.lit(""))).startswith("TOTAL")
    return rows.where(~is_total), rows.where(is_total).select(F.col("amount").alias("stated_total"))


def header_faults(cells: DataFrame, expected: dict[str, str], header_row: int = 1) -> DataFrame:
    """Columns whose folded header lacks the expected word."""
    row = cells.where(F.col("row") == header_row)
    told = F.array(*[F.struct(F.lit(k).alias("column"), F.lit(v).alias("expected"), F.try_element_at("cells", F.lit(k)).alias("found")) for k, v in expected.items()])
    return row.select(F.explode(told).alias("h")).select("h.*").where(~x.fold(F.coalesce("found", F.lit(""))).contains(F.upper("expected")))
