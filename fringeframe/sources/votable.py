"""XML tables as a data source: the columns come from the file's own FIELD elements.

``spark.read.format("votable").load(path)`` reads one document or a folder of them. A FIELD's UCD
says which component column it is and in which unit that column is kept; a FIELD without a known
UCD keeps its name. Documents of a folder may hold their fields in different orders. A document is
read in byte ranges, one a task; a row belongs to the range in which it starts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import escape
from xml.etree import ElementTree

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.skymodel import index_components
from .catalogue import UNITS

#: UCD of a component field, its column, and the unit in which the column is kept.
UCDS = {
    "meta.id;meta.main": ("component_id", ""),
    "pos.eq.ra;meta.main": ("ra", "deg"),
    "pos.eq.dec;meta.main": ("dec", "deg"),
    "stat.error;pos.eq.ra": ("ra_err", "arcsec"),
    "stat.error;pos.eq.dec": ("dec_err", "arcsec"),
    "em.freq": ("freq", "MHz"),
    "phot.flux.density;stat.max;em.radio;stat.fit": ("flux_peak", "mJy/beam"),
    "stat.error;phot.flux.density;stat.max;em.radio;stat.fit": ("flux_peak_err", "mJy/beam"),
    "phot.flux.density;em.radio;stat.fit": ("flux_int", "mJy"),
    "stat.error;phot.flux.density;em.radio;stat.fit": ("flux_int_err", "mJy"),
    "phys.angsize.smajaxis;em.radio;stat.fit": ("maj_axis", "arcsec"),
    "phys.angsize.sminaxis;em.radio;stat.fit": ("min_axis", "arcsec"),
    "phys.angsize;pos.posang;em.radio;stat.fit": ("pos_ang", "deg"),
    "spect.index;em.radio": ("spectral_index", ""),
}
#: Datatypes of fields, and units without a dimension.
TYPES = {"char": "string", "unicodechar": "string", "double": "double", "float": "float", "long": "long", "int": "int", "short": "int", "boolean": "boolean"}
NO_UNIT = ("", "--", "none")
#: Factors of the units that a column may come in, by the unit in which it is kept.
SCALES = {"deg": {u: UNITS[u] for u in ("deg", "rad")} | {"arcsec": 1 / 3600, "arcmin": 1 / 60}, "arcsec": {"arcsec": 1.0, "arcmin": 60.0, "deg": 3600.0},
          "MHz": {"MHz": 1.0, "GHz": 1e3, "kHz": 1e-3, "Hz": 1e-6}, "mJy": {"mJy": 1.0, "Jy": 1e3, "uJy": 1e-3},
          "mJy/beam": {"mJy/beam": 1.0, "Jy/beam": 1e3, "uJy/beam": 1e-3}}
_ARROW = {"string": pa.string(), "double": pa.float64(), "float": pa.float32(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}

STEP = 1 << 24  # bytes of a range


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """File system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def documents(path: str) -> tuple[fs.FileSystem, list[tuple[str, int]]]:
    """(file system, [(file, bytes)]) of a document or of all documents below a folder."""
    system, root = file_system(path)
    info = system.get_file_info(root)
    found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(root, recursive=True))
    return system, sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and f.base_name[0] not in "._" and f.size)


def header(system: fs.FileSystem, file: str) -> tuple[list[dict], int]:
    """The FIELD attributes of a document in order, and the byte at which its rows begin."""
    parser, fields, size, tail = ElementTree.XMLPullParser(["start"]), [], 0, b""
    with system.open_input_stream(file) as f:
        while chunk := f.read(1 << 16):
            text = tail + chunk
            at = re.search(rb"<(?:\w+:)?TABLEDATA[^>]*>", text)
            if at:
                parser.feed(text[len(tail) : at.end()] if at.end() > len(tail) else b"")
                size += at.end() - len(tail)
                break
            parser.feed(chunk)
            size, tail = size + len(chunk), text[-256:]
        else:
            raise ValueError(f"no TABLEDATA in {file}")
    for _, e in parser.read_events():
        if e.tag.rsplit("}", 1)[-1] == "FIELD":
            fields.append(dict(e.attrib))
    return fields, size


def column(field: dict) -> tuple[str, str, float]:
    """(column, type, factor) of a FIELD; a unit that does not fit its UCD is an error."""
    kind = field.get("datatype", "").lower()
    if kind not in TYPES:
        raise ValueError(f"field {field.get('name')}: unknown datatype {kind!r}")
    known = UCDS.get(field.get("ucd", "").lower())
    if known is None:
        return field["name"], TYPES[kind], 1.0
    name, unit = known
    given = field.get("unit", "")
    if unit == "" and given in NO_UNIT:
        return name, TYPES[kind], 1.0
    for u, factor in SCALES.get(unit, {}).items():
        if u.lower() == given.lower():
            return name, TYPES[kind], factor
    raise ValueError(f"field {field.get('name')}: unit {given!r} where {unit!r} is kept")


class _Range(InputPartition):
    def __init__(self, file: str, start: int, end: int):
        self.file, self.start, self.end = file, start, end


class _Reader(DataSourceReader):
    def __init__(self, path: str, columns: list[tuple[str, str]], step: int):
        self.path, self.columns, self.step = path, columns, step

    def partitions(self) -> list[InputPartition]:
        _, files = documents(self.path)
        return [_Range(f, a, min(a + self.step, size)) for f, size in files for a in range(0, size, self.step)]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        system, _ = file_system(self.path)
        fields, first = header(system, partition.file)
        places = {}
        for i, f in enumerate(fields):
            name, kind, factor = column(f)
            places[name] = (i, kind, factor)
        for rows in _rows(system, partition.file, max(first, partition.start), partition.end):
            yield pa.RecordBatch.from_arrays([_values(rows, *places[n], _ARROW[t]) if n in places else pa.nulls(len(rows), _ARROW[t]) for n, t in self.columns], [n for n, _ in self.columns])


def _rows(system: fs.FileSystem, file: str, start: int, end: int) -> Iterator[list[list[str | None]]]:
    """Cells of the rows that start in [start, end), in batches."""
    begins = re.compile(rb"<TR[\s>/]")
    with system.open_input_file(file) as f:
        f.seek(start)
        buffer, at, done = b"", start, start >= end  # ``at``: the byte of the file where the buffer starts
        while not done:
            chunk = f.read(1 << 20)
            buffer += chunk
            cut = buffer.rfind(b"</TR>") + 5 if b"</TR>" in buffer else 0
            if not chunk:
                done = True
            starts = [m.start() for m in begins.finditer(buffer[:cut])]
            mine = [s for s in starts if at + s < end]
            if len(mine) < len(starts) or at + cut >= end and not begins.search(buffer[cut : max(cut, end - at)]):
                done = True
            if mine:
                stop = buffer.find(b"</TR>", mine[-1]) + 5
                tree = ElementTree.fromstring(b"<t>" + buffer[mine[0] : stop] + b"</t>")
                yield [[td.text for td in tr if td.tag.rsplit("}", 1)[-1] == "TD"] for tr in tree]
            at, buffer = at + cut, buffer[cut:]


def _values(rows: list[list[str | None]], i: int, kind: str, factor: float, target: pa.DataType) -> pa.Array:
    """One column of text cells as its type; empty cells are null, a cell that is no such value is an error."""
    cells = [r[i] if i < len(r) else None for r in rows]
    if kind == "string":
        return pa.array([(c or "").strip() for c in cells], pa.string())
    cells = [c.strip() if c and c.strip() else None for c in cells]
    if kind == "boolean":
        return pa.array([None if c is None else c.lower() in ("t", "true", "1") for c in cells], target)
    if kind in ("long", "int"):
        return pa.array([None if c is None else int(c) for c in cells], target)
    return pa.array([None if c is None else float(c) * factor for c in cells], pa.float64()).cast(target)


class VOTableSource(DataSource):
    """Format ``votable``. Option ``step``: bytes of a range. The schema is that of the folder's first document."""

    @classmethod
    def name(cls) -> str:
        return "votable"

    def schema(self) -> str:
        system, files = documents(self.options["path"])
        if not files:
            raise ValueError(f"no documents in {self.options['path']}")
        fields = [column(f) for f in header(system, files[0][0])[0]]
        return ", ".join(f"`{n}` {t}" for n, t, _ in fields)

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], [(f.name, {"bigint": "long", "tinyint": "int"}.get(f.dataType.simpleString(), f.dataType.simpleString())) for f in schema.fields],
                       int(self.options.get("step", STEP)))


def read(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The rows of an XML table, with columns by its FIELDs."""
    spark.dataSource.register(VOTableSource)
    return spark.read.format("votable").options(**options).load(path)


def load(spark: SparkSession, components: str, polarisation: str | None = None) -> DataFrame:
    """Components with their pixel index, and the polarisation of those that a second table names."""
    c = index_components(read(spark, components), "ra", "dec")
    return c if polarisation is None else c.join(read(spark, polarisation), "component_id", "left")


def write(df: DataFrame, path: str, fields: dict[str, dict]) -> None:
    """Write ``df`` as a folder of XML tables, a document a task; ``fields`` gives each column's FIELD attributes, in order."""
    head = "".join(f"<FIELD {' '.join(f'{k}=\"{escape(v)}\"' for k, v in {'name': n, **a}.items())}/>" for n, a in fields.items())
    head = f'<?xml version="1.0"?><VOTABLE version="1.3"><RESOURCE><TABLE>{head}<DATA><TABLEDATA>'

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([head])], ["value"])
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(["<TR>" + "".join(f"<TD>{escape(v)}</TD>" if v is not None else "<TD/>" for v in row) + "</TR>"
                                                        for row in zip(*[b.column(i).to_pylist() for i in range(b.num_columns)])], pa.string())], ["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["</TABLEDATA></DATA></TABLE></RESOURCE></VOTABLE>"])], ["value"])

    df.select(*[F.col(n).cast("string") for n in fields]).mapInArrow(lines, "value string").write.text(path)
