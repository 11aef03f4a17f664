"""Raw JSON scans: ZIP archives of JSON and plain JSON documents, one row per record.

A document is an object with a ``results`` list or a bare list. It may be a gigabyte when unpacked, so its
records are cut out one by one while it is read, and leave Python as text; parsing them is left to Spark.
"""

from __future__ import annotations

import codecs
import io
import json
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.utils import AnalysisException

from faultline.schemas import RAW_RECORD, empty

_CHUNK = 1 << 20
_ROWS = 2_000
_RECORD = to_arrow_schema(RAW_RECORD)
_DECODER = json.JSONDecoder()


class _Text:
    """A window over a UTF-8 stream that grows on demand and forgets what was read."""

    def __init__(self, stream: io.BufferedIOBase):
        self.stream, self.text, self.at, self.ended = stream, "", 0, False
        self.decode = codecs.getincrementaldecoder("utf-8-sig")().decode

    def more(self) -> bool:
        if self.ended:
            return False
        # Doubles with the pending text, so a long value is not scanned again for every chunk.
        data = self.stream.read(max(_CHUNK, len(self.text) - self.at))
        self.ended = not data
        self.text = self.text[self.at :] + self.decode(data, self.ended)
        self.at = 0
        return True

    def peek(self) -> str:
        while True:
            while self.at < len(self.text) and self.text[self.at] in " \t\r\n":
                self.at += 1
            if self.at < len(self.text):
                return self.text[self.at]
            if not self.more():
                return ""

    def value(self) -> tuple[object, str]:
        """Next JSON value and its text."""
        self.peek()
        while True:
            try:
                value, end = _DECODER.raw_decode(self.text, self.at)
                # A number may go on in the next chunk.
                if end < len(self.text) or self.ended:
                    source = self.text[self.at : end]
                    self.at = end
                    return value, source
            except json.JSONDecodeError:
                if self.ended:
                    raise
            self.more()

    def elements(self) -> Iterator[str]:
        """Texts of the objects in the list that starts here."""
        self.at += 1
        while self.peek() not in ("]", ""):
            if self.text[self.at] == ",":
                self.at += 1
                continue
            value, source = self.value()
            if isinstance(value, dict):
                yield source
        self.at += 1


def _records(stream: io.BufferedIOBase, bare_object: bool = False) -> Iterator[str]:
    """Records of one document. ``bare_object``: an object without ``results`` is a table by columns."""
    text = _Text(stream)
    start = text.peek()
    if start == "[":
        yield from text.elements()
    elif start == "{":
        text.at += 1
        columns: dict[str, object] = {}
        while text.peek() not in ("}", ""):
            if text.text[text.at] == ",":
                text.at += 1
                continue
            key, _ = text.value()
            text.peek()
            text.at += 1  # the colon
            if key == "results" and text.peek() == "[":
                yield from text.elements()
                columns, bare_object = {}, False
            else:
                value, _ = text.value()
                if bare_object and key != "results":
                    columns[key] = value
                elif key == "results":
                    columns, bare_object = {}, False
        if bare_object:
            lists = {k: v for k, v in columns.items() if isinstance(v, list)}
            for row in range(max(map(len, lists.values()), default=0)):
                yield json.dumps({k: v[row] if row < len(v) else None for k, v in lists.items()}, ensure_ascii=False)


def _documents(content: bytes, zipped: bool) -> Iterator[io.BufferedIOBase]:
    if not zipped:
        yield io.BytesIO(content)
        return
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        for name in archive.namelist():
            if name.endswith(".json"):
                with archive.open(name) as member:
                    yield member


def _cut(batches: Iterator[pa.RecordBatch], zipped: bool, bare_object: bool) -> Iterator[pa.RecordBatch]:
    """Rows of RAW_RECORD. Those of small files go out together: a batch for each file costs more than reading it."""
    rows: list[tuple[str, int, int, str]] = []

    def packed() -> pa.RecordBatch:
        columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _RECORD, strict=True)]
        rows.clear()
        return pa.RecordBatch.from_arrays(columns, schema=_RECORD)

    for batch in batches:
        for name, content in zip(batch.column("path"), batch.column("content"), strict=True):
            path, pos = name.as_py(), 0
            for member, document in enumerate(_documents(content.as_py(), zipped)):
                for record in _records(document, bare_object):
                    rows.append((path, member, pos, record))
                    pos += 1
                    if len(rows) == _ROWS:
                        yield packed()
    if rows:
        yield packed()


def read_records(files: DataFrame, *, zipped: bool, bare_object: bool = False) -> DataFrame:
    """Records of ``binaryFile`` rows as (file, member, pos, record); pos counts on through a file."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _cut(batches, zipped, bare_object)

    return files.select("path", "content").mapInArrow(cut, RAW_RECORD)


def _files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    return reader.option("recursiveFileLookup", "true").load(folder)


def scan_zips(spark: SparkSession, folder: str, pattern: str = "*.zip") -> DataFrame:
    """Records of all ZIP archives in a folder; none if the folder is missing."""
    return _scan(spark, folder, pattern, zipped=True)


def scan_documents(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Records of all JSON documents below a folder whose names fit, e.g. ``recalls_*.json``."""
    return _scan(spark, folder, pattern, zipped=False)


def _scan(spark: SparkSession, folder: str, pattern: str, *, zipped: bool) -> DataFrame:
    try:
        return read_records(_files(spark, folder, pattern), zipped=zipped)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return empty(spark, RAW_RECORD)


def scan_single_document(spark: SparkSession, path: str) -> DataFrame:
    """Records of one JSON document; a missing file is an error."""
    return read_records(spark.read.format("binaryFile").load(path), zipped=False, bare_object=True)


def parsed(records: DataFrame, fields: str) -> DataFrame:
    """The fields of every record, with its place (_file, pos). Absent fields and JSON nulls are null.

    A record is parsed once, into just these fields: it comes out of a generator, below which no later filter can copy
    the parsing. A field that may be a list, a string or missing is declared as a variant.
    """
    return records.select(file_order(F.col("file")).alias("_file"), "pos", F.inline(F.array(F.from_json("record", fields))))


def file_order(path: Column) -> Column:
    """Sort key that orders paths folder by folder: the separator sorts before any other character."""
    return F.translate(path, "/", "\u0001")
