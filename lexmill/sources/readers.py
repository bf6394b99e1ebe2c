"""Readers.  Each gives (id, source, text[, title]) and leaves the paths to Spark."""

from __future__ import annotations

import io
import lzma
import tarfile
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SOURCE_ORDER, TEXT_COLUMNS
from ..functions.text import strip
from ..operators.ranks import with_running


def text_column(df: DataFrame, preset: str = "corpus") -> str:
    """The first of the preset's names that is there, or else the first column whose name has ``text`` in it."""
    for name in TEXT_COLUMNS[preset]:
        if name in df.columns:
            return name
    for name in df.columns:
        if "text" in name.lower() and preset != "web":
            return name
    raise ValueError(f"no text column among {df.columns}")


def _identified(df: DataFrame, source: str) -> DataFrame:
    """Ids from the file and the row's place in it, so that they repeat neither over files nor over runs."""
    key = F.sha2(F.concat_ws("|", F.col("_metadata.file_path"), F.col("_metadata.row_index").cast("string")), 256)
    return df.select(F.concat(F.lit(f"{source}_"), F.substring(key, 1, 16)).alias("id"), F.lit(source).alias("source"), "text")


def read_parquet(spark: SparkSession, path: str, source: str, preset: str = "corpus", column: str | None = None) -> DataFrame:
    """Parquet below ``path``; only the text column is read, broken files are skipped."""
    df = spark.read.option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "true").parquet(path)
    name = column or text_column(df, preset)
    return _identified(df.select(F.col(name).cast("string").alias("text"), "_metadata").filter(strip(F.col("text")) != ""), source)


def read_wiki(spark: SparkSession, path: str, source: str = "wikipedia", prefix: str = "wp") -> DataFrame:
    """A MediaWiki dump (also bz2): articles that are neither empty nor redirects."""
    schema = "title string, ns long, id long, revision struct<text:struct<_VALUE:string>>"
    pages = spark.read.format("xml").option("rowTag", "page").schema(schema).load(path)
    text = F.col("revision.text._VALUE")
    kept = pages.filter((F.col("ns") == 0) & (F.coalesce(strip(text), F.lit("")) != "") & ~F.lower(strip(text)).startswith("#redirect"))
    return kept.select(F.concat(F.lit(f"{prefix}_"), F.col("id").cast("string")).alias("id"), F.lit(source).alias("source"), text.alias("text"), "title")


def read_wikisource(spark: SparkSession, path: str) -> DataFrame:
    return read_wiki(spark, path, "wikisource", "ws")


def _dealt(rows: Iterator[tuple], schema: pa.Schema, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Rows whose last value is a text, in batches of about ``limit`` characters."""
    own: list[tuple] = []
    chars = 0
    for row in rows:
        own.append(row)
        chars += len(row[-1])
        if chars >= limit:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in own], schema)
            own, chars = [], 0
    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in own], schema)


def _files(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    for batch in batches:
        yield from zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True)


def _unxz(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each file: runs of lines that aren't blank; the file is decompressed as it is read."""

    def documents():
        for path, content in _files(batches):
            raw = io.BytesIO(content)
            own: list[str] = []
            n = 0
            for line in chain(io.TextIOWrapper(lzma.open(raw) if path.endswith(".xz") else raw, encoding="utf-8", errors="replace"), ["\n"]):
                if line.strip():
                    own.append(line.rstrip("\n"))
                elif own:
                    n += 1
                    yield path, n, "\n".join(own)
                    own = []

    yield from _dealt(documents(), pa.schema([("path", pa.string()), ("n", pa.int64()), ("text", pa.string())]))


def read_zstd_lines(spark: SparkSession, path: str, max_bytes: int | None = None) -> DataFrame:
    """(path, line_no, line) of zstd files, lines from 1; of each file up to the line that reaches ``max_bytes`` decompressed bytes, that one included.

    Frames with long windows and several frames in a file are read too; nothing behind the limit is decompressed.
    """

    def lines(batches):
        import zstandard

        def each():
            for name, content in _files(batches):
                read = 0
                with zstandard.ZstdDecompressor(max_window_size=1 << 31).stream_reader(content, read_across_frames=True) as stream:
                    for no, raw in enumerate(io.BufferedReader(stream, 1 << 20), 1):
                        read += len(raw)
                        yield name, no, raw.rstrip(b"\r\n").decode("utf-8", "replace")
                        if max_bytes is not None and read >= max_bytes:
                            break

        yield from _dealt(each(), pa.schema([("path", pa.string()), ("line_no", pa.int64()), ("line", pa.string())]))

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInArrow(lines, "path string, line_no long, line string")


def read_blank_separated(spark: SparkSession, path: str, source: str = "cc100") -> DataFrame:
    """Text or xz files in which blank lines separate documents."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    docs = files.mapInArrow(_unxz, "path string, n long, text string")
    key = F.substring(F.sha2(F.col("path"), 256), 1, 8)
    return docs.select(F.concat(F.lit(f"{source}_"), key, F.lit("_"), F.col("n").cast("string")).alias("id"), F.lit(source).alias("source"), "text")


def paragraphs(lines: DataFrame) -> DataFrame:
    """(doc, text) of lines (line_no, line): the same rule on lines that are rows already."""
    blank = (strip(F.col("line")) == "").cast("int")
    own = with_running(lines.select("line_no", "line"), [F.col("line_no")], blank, "_b").filter(strip(F.col("line")) != "")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda s: s["line"]), "\n")
    return own.groupBy("_b").agg(F.min("line_no").alias("doc"), joined.alias("text")).drop("_b")


def read_books(spark: SparkSession, path: str, source: str = "gallica") -> DataFrame:
    """A text file for each document, UTF-8 or else Latin-1."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(path)
    raw = F.col("content").cast("string")
    text = F.when(F.is_valid_utf8(raw), raw).otherwise(F.decode("content", "ISO-8859-1"))
    stem = F.regexp_extract("path", r"([^/]+)\.txt$", 1)
    return files.select(F.concat(F.lit(f"{source}_"), stem).alias("id"), F.lit(source).alias("source"), text.alias("text")).filter(strip(F.col("text")) != "")


LEGAL_TAGS = ("CONTENU", "TEXTE", "BLOC_TEXTUEL", "NOTA")


def _untar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def members():
        for _, content in _files(batches):
            try:
                with tarfile.open(fileobj=io.BytesIO(content), mode="r:*") as tar:
                    for member in tar:
                        tar.members = []  # else all headers stay in memory
                        if member.isfile() and member.name.endswith(".xml"):
                            try:
                                root = ET.fromstring(tar.extractfile(member).read())
                            except ET.ParseError:
                                continue
                            parts = [el.text.strip() for tag in LEGAL_TAGS for el in root.iter(tag) if el.text and el.text.strip()]
                            yield member.name, "\n\n".join(parts)
            except (tarfile.TarError, EOFError, OSError):  # what was read before the break stays
                pass

    yield from _dealt(members(), pa.schema([("member", pa.string()), ("text", pa.string())]))


def read_legal(spark: SparkSession, path: str, source: str = "legifrance", least: int = 100) -> DataFrame:
    """Tar archives of XML: the text of the legal elements, in the order of the tags."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    docs = files.mapInArrow(_untar, "member string, text string").filter(F.length("text") >= least)
    return docs.select(F.concat(F.lit("legi_"), F.substring(F.md5(F.col("member").cast("binary")), 1, 12)).alias("id"), F.lit(source).alias("source"), "text")


def json_text(raw: Column, names: Sequence[str] = TEXT_COLUMNS["json"]) -> Column:
    """The first field of the names that is a text and not empty."""
    get = lambda k: F.get_json_object(raw, f"$.{k}")
    return F.coalesce(*(F.when(get(k) != "", get(k)) for k in names))


def read_jsonl(spark: SparkSession, path: str, source: str | None = None) -> DataFrame:
    """Lines of JSON, also compressed; blank lines, broken ones and those without a text are left out."""
    raw = spark.read.option("recursiveFileLookup", "true").text(path).filter(F.try_parse_json("value").isNotNull() & strip(F.col("value")).startswith("{"))
    get = lambda k: F.get_json_object("value", f"$.{k}")
    own = get("source") if source is None else F.lit(source)
    return raw.select(get("id").alias("id"), own.alias("source"), json_text(F.col("value")).alias("text")).filter("text is not null")


def read_token_shards(spark: SparkSession, path: str) -> DataFrame:
    """(file, at, token) of flat little-endian uint16 files; a file of an odd size is an error."""
    sizes = spark.read.format("binaryFile").load(path).select("path", "length")
    if not sizes.filter("length % 2 = 1").isEmpty():
        raise ValueError(f"a token file of {path} has an odd number of bytes")

    def unpack(batches):
        import numpy as np

        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                tokens = np.frombuffer(content, dtype="<u2").astype(np.int32)
                for a in range(0, len(tokens), 1 << 18):
                    part = tokens[a : a + (1 << 18)]
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(part)), pa.array(np.arange(a, a + len(part), dtype=np.int64)), pa.array(part)], names=["file", "at", "token"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(unpack, "file string, at long, token int")


READERS: dict[str, Callable[..., DataFrame]] = {
    "wikipedia": read_wiki, "wikisource": read_wikisource, "cc100": read_blank_separated, "gallica": read_books, "legifrance": read_legal,
    "pleia_books": lambda s, p: read_parquet(s, p, "pleia_books", "books"), "pleia_news": lambda s, p: read_parquet(s, p, "pleia_news", "books"), "hplt": lambda s, p: read_parquet(s, p, "hplt", "web"),
}


def read_source(spark: SparkSession, source: str, path: str) -> DataFrame:
    if source not in READERS:
        raise ValueError(f"no reader for {source}; there are {sorted(READERS)}")
    return READERS[source](spark, path)


def source_ranks(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """(source, source_rank): the known order, then the others by name."""
    known = [s for s in SOURCE_ORDER if s in names]
    return spark.createDataFrame(list(enumerate([*known, *sorted(set(names) - set(known))])), "source_rank int, source string").select("source", "source_rank")


def discover(spark: SparkSession, root: str, suffix: str = "_cleaned.jsonl") -> list[tuple[str, str]]:
    """(source, path) for each folder below ``root`` with an output: the one named as the folder, or else the first by name; in the known order, then by name."""
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = {}
    for folder in fs.listStatus(top):
        if folder.isDirectory():
            name = folder.getPath().getName()
            outputs = {f.getPath().getName(): f.getPath().toString() for f in fs.listStatus(folder.getPath()) if f.getPath().getName().endswith(suffix)}
            if outputs:
                found[name] = outputs.get(name + suffix) or outputs[min(outputs)]
    known = [s for s in SOURCE_ORDER if s in found]
    return [(s, found[s]) for s in [*known, *sorted(set(found) - set(known))]]
