"""Scans and sinks: document files, state rows, word tables, logs, tables, CSV and JSON."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The JSON row of a file's state.
STATE = (
    "id string, archivo_original string, ruta_relativa string, nombre string, tamano long, hash_original string, paginas_original int, estado string, "
    "fecha_inicio timestamp, fecha_fin timestamp, duracion_segundos double, codigo_salida int, mensaje_error string, archivo_resultado string, archivo_texto string, "
    "hash_resultado string, hash_texto string, paginas_resultado int, caracteres_extraidos long, tamano_resultado long"
)


def discover(spark: SparkSession, root: str, suffix: str = ".pdf", with_hash: bool = True) -> DataFrame:
    """path, size, modified and hash of the files below a folder whose name ends so, in either case."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    files = files.where(F.lower("path").endswith(suffix))
    content = [F.sha2("content", 256).alias("hash")] if with_hash else []  # without it the contents aren't read
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"), *content)


def _form_feeds(content: bytes) -> list[str]:
    """The pages of a plain text: parted by form feeds, a last one that closes the text aside."""
    pages = content.decode("utf-8", "replace").split("\f")
    return pages[:-1] if len(pages) > 1 and not pages[-1].strip() else pages


def read_pages(spark: SparkSession, path: str, suffix: str = ".txt", parse: Callable[[bytes], list[str]] = _form_feeds) -> DataFrame:
    """path, page_number (from 1), text of the documents below a folder whose name ends so, in either case.

    `parse` makes a document's page texts of its bytes and runs on the executors, a file at a time: give one that reads the
    format at hand.  An empty file or a document without pages gives no rows; one that `parse` fails on fails the read.
    """

    def paged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column("path").to_pylist(), b.column("content")):
                texts = parse(content.as_py())
                columns = [pa.array([name] * len(texts), pa.string()), pa.array(range(1, len(texts) + 1), pa.int32()), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["path", "page_number", "text"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.where(F.lower("path").endswith(suffix)).select("path", "content").mapInArrow(paged, "path string, page_number int, text string")


def state_rows(rows: DataFrame) -> DataFrame:
    """Typed state of (id, data) rows whose data is JSON."""
    return rows.select(F.from_json("data", STATE).alias("s")).select("s.*").orderBy("id")


def word_rows(spark: SparkSession, path: str) -> DataFrame:
    """Words of tab-separated reader output: level 5, not blank, no quoting."""
    rows = spark.read.csv(path, sep="\t", quote="", header=True)
    box = [F.col(c).cast("double") for c in ("left", "top", "width", "height")]
    return rows.where((F.col("level") == "5") & (F.btrim("text") != "")).select("text", F.col("conf").cast("double").alias("confidence"), F.array(box[0], box[1], box[0] + box[2], box[1] + box[3]).alias("box"))


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.col("value").alias("line"), F.input_file_name().alias("document_id"))


def read_json(spark: SparkSession, path: str, schema=None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).json(path, multiLine=True)


def save_table(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Parquet, replaced whole; the committer makes it appear at once."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def save_csv(df: DataFrame, path: str, empty_note: str | None = None, mark: bool = True) -> None:
    """A report: one CSV file with a header; nested columns as JSON; an empty one may say so in a row.

    `mark` leads the file with the byte order mark that spreadsheets look for; Spark's own reader passes over it.
    """
    flat = df.select(*[F.to_json(c).alias(c) if t.startswith(("array", "map", "struct")) else F.col(c) for c, t in df.dtypes])
    if empty_note and flat.isEmpty():
        flat = df.sparkSession.createDataFrame([(empty_note,)], "estado string")
    if mark:
        first, *rest = flat.columns
        flat = flat.toDF(chr(0xFEFF) + first, *rest)
    flat.coalesce(1).write.mode("overwrite").csv(path, header=True)


def save_json(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)


_SCRIPT = """const rows = [...document.querySelectorAll('tbody tr')], search = document.querySelector('input'), picks = [...document.querySelectorAll('select')];
function show() {
  const asked = search.value.toLowerCase();
  let n = 0;
  for (const row of rows) {
    const fits = row.textContent.toLowerCase().includes(asked) && picks.every(p => !p.value || row.cells[p.dataset.column].textContent === p.value.slice(1));
    row.hidden = !fits;
    n += fits;
  }
  document.querySelector('output').textContent = n;
}
search.addEventListener('input', show);
picks.forEach(p => p.addEventListener('change', show));
show();"""


def html_report(df: DataFrame, title: str, filters: tuple[str, ...] = (), links: tuple[str, ...] = (), limit: int = 5000) -> str:
    """A page for reading: a table with a search field, a choice of values for each of `filters`, and `links` to follow.

    Everything is escaped.  Only file and web addresses become links; others stay text.  The page holds `limit` rows, in
    the order of `df`; where there are more it says how many, so none is left out unsaid.
    """
    from html import escape

    names = df.columns
    found = df.limit(limit + 1).collect()
    rows, more = found[:limit], df.count() - limit if len(found) > limit else 0
    text = lambda v: "" if v is None else str(v)

    def cell(name: str, v) -> str:
        shown = escape(text(v))
        if name in links and text(v).startswith(("file://", "https://", "http://")):
            shown = f"<a href='{shown}'>{shown}</a>"
        return f"<td>{shown}</td>"

    def choice(name: str) -> str:
        values = sorted({text(r[name]) for r in rows})
        options = "".join(f"<option value='={escape(v)}'>{escape(v)}</option>" for v in values)
        return f"<label>{escape(name)} <select data-column='{names.index(name)}'><option value=''></option>{options}</select></label> "

    head = "".join(f"<th>{escape(n)}</th>" for n in names)
    body = "".join(f"<tr>{''.join(cell(n, v) for n, v in zip(names, r))}</tr>" for r in rows)
    left = f"<p>{more} more rows are not on this page.</p>" if more else ""
    tools = f"<p><input type='search'> {''.join(map(choice, filters))}<output>{len(rows)}</output> / {len(rows)}</p>"
    table = f"<table><thead><tr>{head}</tr></thead><tbody>{body}</tbody></table>"
    return f"<!doctype html><meta charset='utf-8'><title>{escape(title)}</title><h1>{escape(title)}</h1>{left}{tools}{table}<script>{_SCRIPT}</script>"
