"""Archives and workbooks as rows: made of the files' bytes, one file at a time in its task.

Files come from Spark's binaryFile source, so any store that Spark reads will do; nothing is unpacked to
disk. What can't be read becomes a row that says so, and the other members are still read.
"""

from __future__ import annotations

import functools
import io
import itertools
import re
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree
from xml.parsers import expat
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Archives in archives that are opened, and bytes of a member beyond which it is told as broken.
NESTED = 8
LARGEST = 1 << 30
#: Rows and bytes at which a batch of rows made of contents goes back to Spark.
ROWS, BYTES = 8192, 1 << 24


def _members(content: bytes, name: str = "", depth: int = 0) -> Iterator[tuple]:
    """(member, content, error) of the files in a ZIP archive; those of archives in it as "inner.zip/name".
    Content that is no archive is one member without a name."""
    if content[:2] != b"PK" or depth > NESTED:
        yield (name or None), content, None
        return
    try:
        archive = zipfile.ZipFile(io.BytesIO(content))
        entries = [e for e in archive.infolist() if not e.is_dir()]
    except Exception as e:
        yield (name or None), None, f"{type(e).__name__}: {e}"
        return
    for entry in entries:
        path = f"{name}/{entry.filename}" if name else entry.filename
        try:
            if entry.file_size > LARGEST:
                raise ValueError(f"{entry.file_size} bytes")
            inner = archive.read(entry)
        except Exception as e:
            yield path, None, f"{type(e).__name__}: {e}"
            continue
        if inner[:2] == b"PK" and entry.filename.lower().endswith(".zip"):
            yield from _members(inner, path, depth + 1)
        else:
            yield path, inner, None


def _column(values: tuple, kind: pa.DataType) -> pa.Array:
    """An Arrow array; lists are made of their flat values, which takes a tenth of the time."""
    if not pa.types.is_list(kind):
        return pa.array(values, kind)
    ends = itertools.accumulate((len(v) if v else 0 for v in values), initial=0)
    starts = [None if v is None else at for v, at in zip(values, ends)] + [sum(len(v) for v in values if v)]
    flat = pa.array(list(itertools.chain.from_iterable(v for v in values if v)), kind.value_type)
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), flat, type=kind)


def _generated(found: DataFrame, read: Callable[[bytes], Iterator[tuple]], columns: str, weight: Callable[[tuple], int]) -> DataFrame:
    """found with content replaced by the columns of the rows that read makes of it. Rows of many small
    contents go back in one Arrow batch; a batch ends at so many rows or bytes, by the rows' weight."""
    kept = [c for c in found.columns if c != "content"]
    made = T.StructType.fromDDL(columns)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [to_arrow_type(f.dataType) for f in made]

        def batch(source: pa.RecordBatch, places: list[int], out: list[tuple]) -> pa.RecordBatch:
            beside = source.take(pa.array(places, pa.int64())).columns
            return pa.RecordBatch.from_arrays([*beside, *[_column(c, k) for c, k in zip(zip(*out), kinds)]], names=[*kept, *made.names])

        for found_batch in batches:
            source, contents = found_batch.select(kept), found_batch.column("content")
            places: list[int] = []
            out: list[tuple] = []
            size = 0
            for i, content in enumerate(contents):
                if not content.is_valid:
                    continue
                for row in read(content.as_py()):
                    places.append(i)
                    out.append(row)
                    size += weight(row)
                    if len(out) >= ROWS or size >= BYTES:
                        yield batch(source, places, out)
                        places, out, size = [], [], 0
            if out:
                yield batch(source, places, out)

    schema = T.StructType([*[found.schema[c] for c in kept], *made.fields])
    return found.select(*kept, "content").mapInArrow(rows, schema)


def files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, modified, size, content; content is read only where it is used."""
    read = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return read.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"), "content")


def members(found: DataFrame) -> DataFrame:
    """found with content replaced by member, content and error of each file in its archives."""
    return _generated(found, _members, "member string, content binary, error string", lambda r: len(r[1] or b""))


def documents(found: DataFrame, pattern: str = r"(?i)\.xml$") -> DataFrame:
    """The members whose names fit, and files that are no archive, as text in UTF-8."""
    rows = members(found).where(F.col("error").isNull() & (F.col("member").isNull() | F.col("member").rlike(pattern)))
    return rows.select(*[c for c in rows.columns if c not in ("content", "error")], F.decode("content", "UTF-8").alias("text"))


_SPACE = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_COLUMN = re.compile(r"[A-Z]+")


def _position(ref: str) -> int:
    """0 for A, 26 for AA."""
    n = 0
    for c in _COLUMN.match(ref).group():
        n = n * 26 + ord(c) - 64
    return n - 1


def _text(element) -> str:
    """Of a string with or without runs; phonetic hints are left out."""
    return "".join(t.text or "" for part in element for t in ([part] if part.tag == f"{_SPACE}t" else part.iter(f"{_SPACE}t") if part.tag == f"{_SPACE}r" else []))


@functools.lru_cache(maxsize=64)
def _tabs(book: bytes, links: bytes) -> list[tuple[str, str]]:
    """Names and parts of a workbook's sheets, in order; workbooks of one maker mostly have the same ones."""
    targets = {e.get("Id"): e.get("Target") for e in ElementTree.fromstring(links)}
    return [(e.get("name"), targets[e.get(_LINK)].lstrip("/")) for e in ElementTree.fromstring(book).iter(f"{_SPACE}sheet")]


_ROW, _CELL, _VALUE, _INLINE, _PIECE, _PHONETIC = (f"{_SPACE[1:]}{t}" for t in ("row", "c", "v", "is", "t", "rPh"))


def _parsed_rows(part, shared: list[str]) -> Iterator[tuple[int, list[str | None]]]:
    """(row, cells) of a sheet's XML, piece by piece; what comes before an error is handed on before it."""
    done: list[tuple[int, list[str | None]]] = []
    cells: list[str | None] = []
    number, at, kind, text, reading, read, phonetic = 0, 0, None, None, False, False, False

    def start(tag, attributes):
        nonlocal cells, number, at, kind, text, reading, read, phonetic
        if tag == _CELL:
            ref, kind = attributes.get("r"), attributes.get("t")
            at = _position(ref) if ref else len(cells)
            text, read = None, False
        elif tag == _PIECE:
            reading = kind == "inlineStr" and text is not None and not phonetic
        elif tag == _INLINE:
            text = "" if kind == "inlineStr" and text is None else text
        elif tag == _VALUE:
            reading = kind != "inlineStr" and not read
        elif tag == _ROW:
            number, cells = int(attributes.get("r") or number + 1), []
        elif tag == _PHONETIC:
            phonetic = True

    def characters(piece):
        nonlocal text
        if reading:
            text = piece if text is None else text + piece

    def end(tag):
        nonlocal reading, read, phonetic
        if tag == _CELL:
            if at > len(cells):
                cells.extend([None] * (at - len(cells)))
            value = shared[int(text)] if kind == "s" and text is not None else text
            if at == len(cells):
                cells.append(value)
            else:
                cells[at] = value
        elif tag == _PIECE:
            reading = False
        elif tag == _VALUE:
            reading, read = False, True
        elif tag == _ROW:
            done.append((number, cells))
        elif tag == _PHONETIC:
            phonetic = False

    parser = expat.ParserCreate(namespace_separator="}")
    parser.buffer_text = True
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, characters
    try:
        while True:
            piece = part.read(CHUNK)
            parser.Parse(piece, not piece)
            yield from done
            done.clear()
            if not piece:
                return
    except Exception:
        yield from done
        raise


#: Bytes of a sheet's XML that are parsed at a time; smaller sheets are looked through as a whole.
CHUNK = 1 << 16
_SAID = r"([^<&\r\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]*)"
_TOKEN = re.compile(
    rf'<c(?: r="([A-Z]+)[0-9]+")?(?: s="[0-9]+")?(?: t="([A-Za-z]+)")?(/>|>(?:<v>{_SAID}</v>|<is><t(?: xml:space="preserve")?>{_SAID}</t></is>)?</c>)|(<row)(?: r="([0-9]+)")?(?: spans="[0-9: ]*")?>|(</row>)'
)


@functools.lru_cache(maxsize=256)
def _framed(head: str, tail: str) -> bool:
    """Whether what stands around a sheet's rows is well-formed, in UTF-8, and has no cells of its own."""
    seen, plain = [], []
    parser = expat.ParserCreate(namespace_separator="}")
    parser.StartElementHandler = lambda tag, _: seen.append(tag)
    parser.StartDoctypeDeclHandler = lambda *_: plain.append("doctype")
    parser.XmlDeclHandler = lambda version, encoding, alone: plain.append("encoding") if encoding and encoding.lower() != "utf-8" else None
    try:
        parser.Parse(head.encode(), False)
        inside = seen[-1:] == [f"{_SPACE[1:]}sheetData"]
        parser.Parse(tail.encode(), True)
    except expat.ExpatError:
        return False
    return inside and not plain and not {_ROW, _CELL, _VALUE, _INLINE, _PIECE, _PHONETIC} & set(seen)


def _simple_rows(xml: bytes, shared: list[str]) -> list[tuple[int, list[str | None]]] | None:
    """As _parsed_rows, of a sheet that has nothing but plain rows and cells, which one pattern finds in a third of the
    time; None where anything else stands between them or there is an error, so that it is parsed."""
    try:
        text = xml.decode()
        at, to = text.find("<sheetData>") + 11, text.rfind("</sheetData>")
        if not 11 <= at <= to or "]]>" in text or at + len(text) - to > 1 << 13 or not _framed(text[:at], text[to:]):
            return None
        found = _TOKEN.split(text[at:to])
        if any(found[::9]):
            return None
        done: list[tuple[int, list[str | None]]] = []
        number, cells = 0, None
        for ref, kind, close, value, inline, row, r, end in zip(*(found[i::9] for i in range(1, 9))):
            if close:
                if kind == "inlineStr":
                    value = inline
                else:
                    value = value or None
                    if kind == "s" and value is not None:
                        value = shared[int(value)]
                if ref:
                    place = _position(ref)
                    if place < len(cells):
                        cells[place] = value
                        continue
                    cells.extend([None] * (place - len(cells)))
                cells.append(value)
            elif row:
                if cells is not None:
                    return None
                number, cells = int(r or number + 1), []
            else:
                if cells is None:
                    return None
                done.append((number, cells))
                cells = None
        return done if cells is None else None
    except Exception:
        return None


def sheet_rows(content: bytes) -> Iterator[tuple[str, int, list[str | None]]]:
    """(sheet, row from 1, cells as text) of a workbook, row by row; numbers as they are written, empty cells null."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        names = book.NameToInfo
        shared: list[str] = []
        if "xl/sharedStrings.xml" in names:
            for _, e in ElementTree.iterparse(book.open("xl/sharedStrings.xml")):
                if e.tag == f"{_SPACE}si":
                    shared.append(_text(e))
                    e.clear()
        for sheet, target in _tabs(book.read("xl/workbook.xml"), book.read("xl/_rels/workbook.xml.rels")):
            place = target if target in names else f"xl/{target}"
            with book.open(place) as part:
                xml = part.read(CHUNK) if names[place].file_size <= CHUNK else None
                rows = None if xml is None else _simple_rows(xml, shared)
                for row, cells in rows if rows is not None else _parsed_rows(part if xml is None else io.BytesIO(xml), shared):
                    yield sheet, row, cells


def _read_workbook(content: bytes) -> Iterator[tuple]:
    """The rows of a workbook's sheets; one row with the error where it can't be read further."""
    try:
        for sheet, row, cells in sheet_rows(content):
            yield sheet, row, cells, None
    except Exception as e:
        yield None, None, None, f"{type(e).__name__}: {e}"


def workbook_rows(found: DataFrame) -> DataFrame:
    """found with content replaced by sheet, row, cells and error; a task reads a file at a time."""
    return _generated(found, _read_workbook, "sheet string, row int, cells array<string>, error string", lambda r: 64 * len(r[2] or ()))


_BLANKS = re.compile(r"[ \t\n\x0b\f\r]+")


@functools.lru_cache(maxsize=4096)
def _one_line(cell: str | None) -> str | None:
    return cell and _BLANKS.sub(" ", cell).strip(" ")


def workbook_tables(found: DataFrame, first: list[str]) -> DataFrame:
    """As workbook_rows, of the rows under the first row of each sheet that begins with one of the cells first; with
    names, that row's cells, each as one line. Sheets without such a row have no rows."""
    def read(content: bytes) -> Iterator[tuple]:
        tab, at, names = None, 0, None
        for sheet, row, cells, error in _read_workbook(content):
            if sheet != tab:
                tab, names = sheet, None
            if error is not None:
                yield sheet, row, cells, None, error
            elif names is not None:
                if row > at:
                    yield sheet, row, cells, names, None
            elif cells and _one_line(cells[0]) in first:
                at, names = row, [_one_line(c) for c in cells]

    return _generated(found, read, "sheet string, row int, cells array<string>, names array<string>, error string", lambda r: 64 * len(r[2] or ()))


def row_xml(*cells: Column) -> Column:
    """A sheet's row as XML: strings are texts, other types numbers; null is an empty cell."""

    def cell(c: Column) -> Column:
        said = c.cast("string")
        kept = F.replace(F.replace(F.replace(said, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
        text = F.concat(F.lit('<c t="inlineStr"><is><t xml:space="preserve">'), kept, F.lit("</t></is></c>"))
        return F.coalesce(F.when(F.typeof(c) == "string", text).otherwise(F.concat(F.lit("<c><v>"), said, F.lit("</v></c>"))), F.lit("<c/>"))

    return F.concat(F.lit("<row>"), *[cell(c) for c in cells], F.lit("</row>"))


def rows_xml(rows: list[list]) -> str:
    """As row_xml, of rows of texts and numbers; None is an empty cell."""

    def cell(x) -> str:
        if x is None:
            return "<c/>"
        if isinstance(x, str):
            return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(x)}</t></is></c>'
        return f"<c><v>{x!r}</v></c>"

    return "".join(f"<row>{''.join(map(cell, r))}</row>" for r in rows)


def workbook(sheets: dict[str, list[list] | str]) -> bytes:
    """The bytes of a workbook with those sheets, of rows of texts and numbers or of their XML."""
    main = _SPACE.strip("{}")
    links = _LINK.rsplit("}", 1)[0].strip("{")
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        tabs = "".join(f'<sheet name={quoteattr(name)} sheetId="{i}" r:id="r{i}"/>' for i, name in enumerate(sheets, 1))
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{links}"><sheets>{tabs}</sheets></workbook>')
        rels = "".join(f'<Relationship Id="r{i}" Type="{links}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{rels}</Relationships>')
        for i, rows in enumerate(sheets.values(), 1):
            body = rows if isinstance(rows, str) else rows_xml(rows)
            book.writestr(f"xl/worksheets/sheet{i}.xml", f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>')
    return out.getvalue()
