"""Vehicle positions: daily archives of XML snapshots to rows.

`sources.archives` reads the archives as a Spark source; here the documents are taken apart and positions are stored and
read by day. A parser says whether a document holds together. Activities mostly have the same tags in the same order, and
are then taken out by a pattern of these; documents for which that may not hold are taken apart element by element.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple
from xml.etree import ElementTree
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual import schemas
from punctual.functions.geo import in_area
from punctual.settings import GREATER_MANCHESTER, Area
from punctual.sources.archives import TASK_BYTES, Archives, read_archives

# Fixed value: the XML namespace of the feed.
NAMESPACE = "http://www.siri.org.uk/siri"

# Where each column of a position sits inside one activity element.
ACTIVITY_FIELDS = {
    "recorded_at": "RecordedAtTime",
    "line_ref": "MonitoredVehicleJourney.LineRef",
    "direction_ref": "MonitoredVehicleJourney.DirectionRef",
    "operator_ref": "MonitoredVehicleJourney.OperatorRef",
    "origin_ref": "MonitoredVehicleJourney.OriginRef",
    "destination_ref": "MonitoredVehicleJourney.DestinationRef",
    "origin_aimed_departure": "MonitoredVehicleJourney.OriginAimedDepartureTime",
    "dated_vehicle_journey_ref": "MonitoredVehicleJourney.FramedVehicleJourneyRef.DatedVehicleJourneyRef",
    "data_frame_ref": "MonitoredVehicleJourney.FramedVehicleJourneyRef.DataFrameRef",
    "vehicle_ref": "MonitoredVehicleJourney.VehicleRef",
    "longitude": "MonitoredVehicleJourney.VehicleLocation.Longitude",
    "latitude": "MonitoredVehicleJourney.VehicleLocation.Latitude",
}

LONGITUDE, LATITUDE = (list(ACTIVITY_FIELDS).index(axis) for axis in ("longitude", "latitude"))


def archive_path(directory: str, date: str) -> str:
    return f"{directory}/sirivm-{date}.zip"


def every_nth(rows: DataFrame, n: int, ordinal: str = "ordinal") -> DataFrame:
    """Systematic sample: rows 0, n, 2n, … by their ordinal."""
    return rows if n <= 1 else rows.where(F.col(ordinal) % n == 0)


def damaged_per_day(snapshots: DataFrame) -> DataFrame:
    """Snapshots of each day as `read_archives` gives them, and how many of them could not be unpacked."""
    return snapshots.groupBy("source_date").agg(
        F.count(F.lit(1)).alias("snapshots"), F.count("damage").alias("damaged")
    )


def _fields() -> dict:
    """ACTIVITY_FIELDS as a tree: a tag leads to further tags, or to the number of a column."""
    space, tree = "{" + NAMESPACE + "}", {}
    for number, where in enumerate(ACTIVITY_FIELDS.values()):
        *steps, last = (space + step for step in where.split("."))
        node = tree
        for step in steps:
            node = node.setdefault(step, {})
        node[last] = number
    return tree


def _walk(element: ElementTree.Element, fields: dict, values: list[str | None]) -> None:
    """One look at each child. Of an element that comes twice the first counts."""
    for child in element:
        found = fields.get(child.tag)
        if found.__class__ is dict:
            _walk(child, found, values)
        elif found is not None and values[found] is None:
            values[found] = child.text or ""


_ATTRIBUTES = r"""(?:\s++[^\s=<>"'/]++\s*+=\s*+(?:"[^"<]*+"|'[^'<]*+'))*+\s*+"""
_HEAD = re.compile(rf"(?:<\?xml\s([^<>?]*+)\?>)?\s*+<[^\s<>/!?]++({_ATTRIBUTES})>")
_SPACE = re.compile(r"""\sxmlns(?::([^\s=]+))?\s*=\s*(?:"([^"]*)"|'([^']*)')""")
_UTF_8 = re.compile(r"""encoding\s*=\s*["']utf-8["']""", re.IGNORECASE)
_TAG = re.compile(rf"<(/?)([^\s<>/!?]++)({_ATTRIBUTES})(/?)>([^<]*+)")
_NAME = r"[A-Za-z_][A-Za-z0-9_.-]*"
# Entities, and what the parser changes or refuses in a text.
_CHANGED = r"&\x00-\x08\x0b-\x1f\ufffe\uffff\ud800-\udfff"
_ODD = re.compile(f"[{_CHANGED}]|<[!?]")
_TEXT = f"[^<{_CHANGED}]"
_GONE = "<\0>"  # where an activity was: no document has it, and no pattern matches across it
SHAPES = 64  # that a worker remembers


class _Shape(NamedTuple):
    """Activities of the same tags in the same order."""

    pattern: re.Pattern  # with a group for each text that is a column's
    columns: list[int]
    plain: bool  # no attributes: what matches holds together


_SHAPES: dict[str, list[_Shape]] = {}


def _shape(activity: str, prefix: str) -> _Shape | None:
    """The shape of an activity; None if it doesn't hold together.

    Where this one has no attributes or no text the others have none, and where it has some they do, but for texts that are
    a column's: so the pattern is mostly fixed text. Of an element that comes twice the first counts.
    """
    pattern, columns, seen, plain = [], [], set(), True
    above: list[tuple[str, dict | int | None]] = [("", {f"{prefix}VehicleActivity": _bare(_fields(), prefix)})]
    for closes, name, attributes, empty, text in _TAG.findall(activity):
        if not re.fullmatch(f"(?:{re.escape(prefix)})?{_NAME}", name):
            return None
        taken, inside = False, ""
        if closes:
            if above.pop()[0] != name:
                return None
        else:
            here = above[-1][1]
            found = here.get(name) if isinstance(here, dict) else None
            taken = isinstance(found, int) and found not in seen
            if taken:
                seen.add(found)
            if taken := taken and not empty:
                columns.append(found)
            if not empty:
                above.append((name, found))
        if attributes:
            blank = attributes.isspace()
            inside, plain = (r"[ \t\n]++" if blank else rf"(?=\s){_ATTRIBUTES}"), plain and blank
        pattern.append(rf"<{closes}{re.escape(name)}{inside}{empty}>" + (f"({_TEXT}*+)" if taken else f"{_TEXT}++" if text else ""))
    found = re.compile("".join(pattern))
    return _Shape(found, columns, plain) if len(above) == 1 and found.fullmatch(activity) else None


def _bare(fields: dict, prefix: str) -> dict:
    """Fields by tags as a document with this prefix writes them."""
    return {prefix + tag.partition("}")[2]: _bare(x, prefix) if isinstance(x, dict) else x for tag, x in fields.items()}


Columns = list[list[str | None]]


def _by_shape(document: str | bytes) -> Columns | None:
    """As `_activities` gives them, by patterns of whole activities; None for a document that patterns may get wrong.

    Taken are documents of one namespace, declared at the root, without entities, and without comments and the like before
    the end of the last activity: there each `<` begins a tag, and a prefix tells the feed's tags from others. Whether it
    is well-formed is still the parser's to say: of a document in which plain activities are replaced by empty elements.
    """
    text = document
    if isinstance(document, bytes):
        try:
            text = document.decode()
        except UnicodeDecodeError:
            return None
    head = _HEAD.match(text)
    if head is None or text.count("xmlns") != 1 or (space := _SPACE.search(head[2])) is None or "&" in head[2]:
        return None
    if isinstance(document, bytes) and "encoding" in (head[1] or "") and not _UTF_8.search(head[1]):
        return None
    if (space[2] or space[3]) != NAMESPACE:
        return [[] for _ in ACTIVITY_FIELDS]
    prefix = f"{space[1]}:" if space[1] else ""
    tag = f"{prefix}VehicleActivity"
    end = text.find(">", last) + 1 if (last := text.rfind(f"</{tag}")) >= 0 else head.end()
    rest = text[head.end() : end]
    if "]]>" in rest or "\0" in rest:
        return None
    known, out, plain = _SHAPES.setdefault(prefix, []), [[] for _ in ACTIVITY_FIELDS], True
    for shape in list(known):
        if f"<{tag}" not in rest:
            break
        rest, some = _take(shape, rest, out)
        if some:
            plain &= shape.plain
            # the next document is likely of the same kind
            known.remove(shape)
            known.insert(0, shape)
    while (begins := rest.find(f"<{tag}")) >= 0:
        ends = rest.find(">", rest.find(f"</{tag}", begins)) + 1
        shape = _shape(rest[begins:ends], prefix)
        if shape is None or sum(map(len, _SHAPES.values())) >= SHAPES:
            return None
        known.append(shape)
        rest, _ = _take(shape, rest, out)
        plain &= shape.plain
    rest = rest.replace(_GONE, "<a/>")
    if _ODD.search(rest):
        return None
    try:
        left = f"{text[: head.end()]}{rest}{text[end:]}" if plain else document
        expat.ParserCreate(None, "}").Parse(left, True)
    except (expat.ExpatError, LookupError, ValueError):
        return [[] for _ in ACTIVITY_FIELDS]
    return out


def _take(shape: _Shape, text: str, out: Columns) -> tuple[str, bool]:
    """The text without activities of this shape, and whether there were any; the values of those with a place go to `out`."""
    parts = shape.pattern.split(text)
    step = len(shape.columns) + 1
    n = len(parts) // step
    if n and LONGITUDE in shape.columns and LATITUDE in shape.columns:
        for column, values in enumerate(out):
            if column in shape.columns:
                values += [value.strip() or None for value in parts[1 + shape.columns.index(column) :: step]]
            else:
                values += [None] * n
    return (_GONE.join(parts[::step]), True) if n else (text, False)


def _activities(document: str | bytes) -> Columns:
    """The values of the activities with a place, by column as in ACTIVITY_FIELDS; none of a malformed document."""
    found = _by_shape(document)
    return _parsed(document) if found is None else found


def _parsed(document: str | bytes) -> Columns:
    """The same for any document, element by element.

    An activity is emptied as soon as it is read. That the document holds together shows only at its end.
    """
    fields, tag = _fields(), "{" + NAMESPACE + "}VehicleActivity"
    parser, rows = ElementTree.XMLPullParser(["end"]), []
    try:
        for start in range(0, len(document), 1 << 18):
            parser.feed(document[start : start + (1 << 18)])
            for _, element in parser.read_events():
                if element.tag == tag:
                    values: list[str | None] = [None] * len(ACTIVITY_FIELDS)
                    _walk(element, fields, values)
                    element.clear()
                    if values[LONGITUDE] and values[LATITUDE]:
                        rows.append([(value or "").strip() or None for value in values])
        parser.close()
    except (ElementTree.ParseError, LookupError, ValueError):
        rows = []
    return [list(column) for column in zip(*rows, strict=True)] if rows else [[] for _ in ACTIVITY_FIELDS]


def explode_activities(documents: DataFrame, xml: str = "xml", area: Area = GREATER_MANCHESTER) -> DataFrame:
    """One row per vehicle activity inside the area; all columns but the document are kept.

    Documents are text or bytes; bytes say themselves how they are encoded. Tolerant: an empty or malformed
    document gives nothing, nor does an activity without a usable place; any other absent or empty element
    is NULL. Activities are found at any depth, under whatever prefix has the feed's namespace.
    """
    kept = [f for f in documents.schema.fields if f.name != xml]

    def taken_apart(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            others = [batch.column(f.name) for f in kept]
            found, owners = [[] for _ in ACTIVITY_FIELDS], []
            for i, document in enumerate(batch.column(xml).to_pylist()):
                if document:
                    values = _activities(document)
                    for column, more in zip(found, values, strict=True):
                        column += more
                    owners += [i] * len(values[LONGITUDE])
                if len(owners) > 20_000 or i == batch.num_rows - 1:
                    at = pa.array(owners, pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [c.take(at) for c in others] + [pa.array(c, pa.string()) for c in found],
                        [f.name for f in kept] + [f"_{name}" for name in ACTIVITY_FIELDS],
                    )
                    found, owners = [[] for _ in ACTIVITY_FIELDS], []

    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"`_{name}` string" for name in ACTIVITY_FIELDS]
    )
    values = {name: F.col(f"_{name}") for name in ACTIVITY_FIELDS}
    for axis in ("longitude", "latitude"):
        values[axis] = values[axis].try_cast("double")
    rows = documents.select(*(f.name for f in kept), xml).mapInArrow(taken_apart, schema)
    return rows.select(*(f.name for f in kept), *(value.alias(name) for name, value in values.items())).where(
        in_area(F.col("latitude"), F.col("longitude"), area)
    )


def load_positions(
    spark: SparkSession,
    archives: Archives,
    sample_every_nth: int = 1,
    area: Area = GREATER_MANCHESTER,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """Positions of whole days, without a shuffle: archives are unpacked and taken apart where they are read.

    `archives` maps a service date to the path of its archive, or to several. What could not be unpacked is left
    out here; `damaged_per_day(read_archives(...))` counts it.
    """
    snapshots = read_archives(spark, archives, every_nth=sample_every_nth, task_bytes=task_bytes)
    documents = snapshots.select("source_date", "snapshot_file", "xml")
    return explode_activities(documents, area=area).select(*schemas.POSITIONS.fieldNames())


def read_positions(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Stored positions. The schema is given because a partition value such as 20260701 would otherwise
    come back as a number."""
    schema = schemas.POSITIONS
    if columns is not None:
        schema = type(schema)([f for f in schema.fields if f.name in columns])
    return spark.read.schema(schema).parquet(path)
