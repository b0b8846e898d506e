"""File sources.

Schemas are given, never inferred: inference costs a pass over the files and
mis-types columns with stray texts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clean import wall_clock

CORRUPT_ROW = "corrupt_row"
SWEEP_SCHEMA = (
    "path string, site_lat double, site_lon double, azimuth double, "
    "first_gate double, gate_width double, gates array<double>, error string"
)
SWEEP_FIELDS = ("path", "site_lat", "site_lon", "azimuth", "first_gate", "gate_width", "gates", "error")


def read_csv(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, *, skip_bad: bool = False
) -> DataFrame:
    """CSV with a header row.

    A malformed row or an unreadable file ends the job.  With ``skip_bad``,
    corrupt or vanished files are passed over, and every malformed row stays:
    its text is in an added column ``corrupt_row``, null for readable rows, so
    that the caller can count and drop them.
    """
    reader = spark.read.option("header", True)
    if not skip_bad:
        return reader.schema(schema).option("mode", "FAILFAST").csv(path)
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    kept = T.StructType([*schema.fields, T.StructField(CORRUPT_ROW, T.StringType())])
    return (
        reader.schema(kept)
        .option("columnNameOfCorruptRecord", CORRUPT_ROW)
        .option("ignoreCorruptFiles", True)
        .option("ignoreMissingFiles", True)
        .csv(path)
    )


def read_keys(spark: SparkSession, path: str) -> DataFrame:
    """First column of a headed CSV as ``key``: the list of objects to process."""
    lines = spark.read.option("header", True).option("enforceSchema", True).schema("key string").csv(path)
    return lines.filter(F.col("key").isNotNull())


def read_binary(spark: SparkSession, path: str, pattern: str = "*.gz", *, skip_bad: bool = False) -> DataFrame:
    """Whole binary files (path, modificationTime, length, content).

    An unreadable or vanished file ends the job; with ``skip_bad`` it is passed
    over.  Radar files are a few megabytes each, so a row per file is small; the
    number of tasks follows from the file sizes.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .option("ignoreCorruptFiles", skip_bad)
        .option("ignoreMissingFiles", skip_bad)
        .load(path)
    )


def file_inventory(spark: SparkSession, path: str, store: str, pattern: str = "*") -> DataFrame:
    """(path, length) of the files under ``path``, kept in the folder ``store``.

    Taken before files are read, it tells afterwards which of them gave nothing; a list made
    later would lack what has vanished meanwhile.  Contents are not read.
    """
    _listed(spark, path, pattern).write.mode("overwrite").parquet(store)
    return spark.read.parquet(store)


def _listed(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    files = read_binary(spark, path, pattern, skip_bad=True)
    return files.select(F.col("_metadata.file_path").alias("path"), "length")


def skipped_files(spark: SparkSession, inventory: DataFrame, path: str, read: DataFrame, pattern: str = "*") -> DataFrame:
    """(path, length, reason) of the files of an inventory that gave no row.

    ``read`` holds the paths of rows that were read, in its first column, for example
    ``read_csv(..., skip_bad=True).select("_metadata.file_path")``.  The reason is 'vanished'
    or 'no readable row'.  A compressed file that breaks off after some rows is not among
    them (see :func:`broken_gzip`), and neither is an empty file, which Spark never lists.
    """
    seen = read.select(F.col(read.columns[0]).alias("path")).distinct()
    now = _listed(spark, path, pattern).select("path", F.lit(True).alias("_there"))
    reason = F.when(F.col("_there").isNull(), "vanished").otherwise("no readable row")
    return inventory.join(seen, "path", "left_anti").join(now, "path", "left").select("path", "length", reason.alias("reason"))


def broken_gzip(files: DataFrame) -> DataFrame:
    """(path, reason) of the gzip files of ``read_binary`` whose content is no whole gzip stream.

    Each file is inflated once in pieces of a megabyte, so a task holds a file and one piece.
    """

    def reason(content: bytes) -> str | None:
        """None for a whole stream."""
        rest = content
        while rest:
            inflate = zlib.decompressobj(31)
            try:
                while not inflate.eof and rest:
                    inflate.decompress(rest, 1 << 20)
                    rest = inflate.unconsumed_tail or inflate.unused_data
            except zlib.error as problem:
                return str(problem)
            if not inflate.eof:
                return "breaks off"
            rest = rest.lstrip(b"\0")  # padding after the last member
        return None

    def check(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                found = reason(content.as_py())
                if found:
                    yield pa.RecordBatch.from_pydict({"path": [path.as_py()], "reason": [found]})

    return files.select("path", "content").mapInArrow(check, "path string, reason string")


def decode_sweeps(files: DataFrame, decode: Callable[[str, bytes], Sequence[dict] | None]) -> DataFrame:
    """Apply a caller's decoder to (path, content).

    ``decode`` returns the rays of a file as dicts of ``SWEEP_SCHEMA`` (without
    ``path`` and ``error``), or None for a file without rays.  It runs in the
    tasks, one file at a time.  A file on which it raises gives one row with
    ``path`` and ``error`` alone; rays have a null ``error``.
    """
    fields = SWEEP_FIELDS

    def to_rays(batches):
        import pyarrow as pa

        number = pa.float64()
        kinds = {"path": pa.string(), "gates": pa.list_(number), "error": pa.string()}
        schema = pa.schema([(name, kinds.get(name, number)) for name in fields])
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                path = path.as_py()
                try:
                    rays = decode(path, content.as_py())
                except Exception as problem:
                    rays = [{"error": f"{type(problem).__name__}: {problem}"}]
                if rays:
                    yield pa.RecordBatch.from_pylist([{"path": path, **ray} for ray in rays], schema=schema)

    return files.select("path", "content").mapInArrow(to_rays, SWEEP_SCHEMA)


def is_product(path: Column | str, pattern: str) -> Column:
    """File-kind filter by name, for example ``'DAALOT'``."""
    return (F.col(path) if isinstance(path, str) else path).rlike(pattern)


def time_from_name(path: Column | str) -> Column:
    """Timestamp written as yyyyMMdd_HHmmss inside a file name."""
    path = F.col(path) if isinstance(path, str) else path
    text = F.regexp_extract(path, r"\d{8}_\d{6}", 0)
    shape = r"(\d{4})(\d{2})(\d{2})_(\d{2})(\d{2})(\d{2})"
    return wall_clock(F.regexp_replace(text, shape, "$1-$2-$3 $4:$5:$6"))


def _features(spark: SparkSession, path: str, properties: str, lines: bool, start: str | None) -> DataFrame:
    """(pos, f) per GeoJSON feature, coordinates as JSON text.

    ``lines``: one feature per line, as ``write_features`` writes; a file is read by several
    tasks.  Otherwise a file is one document with a list of features, which one task parses,
    unless ``start`` gives the text every feature begins with, exactly as written, such as
    ``{"type":"Feature",``: the document is then cut where it occurs, by several tasks, and
    each piece is parsed by itself.  The text must occur nowhere else; a piece that is no
    feature ends the job.
    """
    geometry = "struct<type: string, coordinates: string>"
    one = f"struct<properties: struct<{properties}>, geometry: {geometry}>"
    if lines:
        found = spark.read.schema(f"properties struct<{properties}>, geometry {geometry}").json(path)
        return found.select(F.monotonically_increasing_id().alias("pos"), F.struct("properties", "geometry").alias("f"))
    if start is not None:
        cut = spark.read.option("lineSep", start).text(path)
        head = ~F.col("value").contains('"geometry"')  # what stands before the first feature
        kept = cut.select(F.monotonically_increasing_id().alias("pos"), "value").filter(~head)
        return kept.select("pos", F.from_json(F.concat(F.lit(start), "value"), one, {"mode": "FAILFAST"}).alias("f"))
    found = spark.read.schema(f"features array<{one}>").option("multiLine", True).json(path)
    return found.select(F.posexplode("features").alias("pos", "f"))


def read_feature_properties(spark: SparkSession, path: str, properties: str, *, lines: bool = False, start: str | None = None) -> DataFrame:
    """Properties of every GeoJSON feature; ``properties`` is DDL such as 'id: string'."""
    return _features(spark, path, properties, lines, start).select("f.properties.*")


def read_feature_points(spark: SparkSession, path: str, properties: str, *, lines: bool = False, start: str | None = None) -> DataFrame:
    """Properties plus ``lat`` and ``lon`` of every GeoJSON point feature."""
    place = F.from_json("f.geometry.coordinates", "array<double>")
    return _features(spark, path, properties, lines, start).select(
        "f.properties.*", F.get(place, F.lit(1)).alias("lat"), F.get(place, F.lit(0)).alias("lon")
    )


def polygon_parts(kind: Column, coordinates: Column) -> Column:
    """Parts, each a list of rings, of a Polygon's or MultiPolygon's coordinates in JSON text.

    No geometry gives null; another kind of geometry is an error.
    """
    ring = "array<array<double>>"
    one = F.array(F.from_json(coordinates, f"array<{ring}>"))
    many = F.from_json(coordinates, f"array<array<{ring}>>")
    other = F.raise_error(F.concat(F.lit("not a polygon: "), kind)).cast(f"array<array<{ring}>>")
    listed = F.when(kind == "Polygon", one).when(kind == "MultiPolygon", many).when(kind.isNotNull(), other)

    def point(p: Column) -> Column:
        return F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))

    return F.transform(listed, lambda part: F.transform(part, lambda r: F.transform(r, point)))


def read_polygons(
    spark: SparkSession, path: str, id_field: str = "id", *, lines: bool = False, start: str | None = None
) -> DataFrame:
    """(zone, pos, parts) per GeoJSON polygon or multi-polygon, holes included, in file order."""
    listed = _features(spark, path, f"`{id_field}`: string", lines, start)
    parts = polygon_parts(F.col("f.geometry.type"), F.col("f.geometry.coordinates"))
    return listed.select(F.col("f.properties")[id_field].alias("zone"), "pos", parts.alias("parts"))


def read_text_whole(spark: SparkSession, path: str) -> DataFrame:
    """One row per text file: (path, value)."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), "value"
    )


def text_blocks(texts: DataFrame, text: str, lines: int, names: Sequence[str]) -> DataFrame:
    """Cut a text into blocks of ``lines`` lines, one column per line.

    Adds ``block`` and the named columns; a trailing block that lacks lines has
    nulls.  Blocks are sliced out of the text's own row, so nothing is shuffled.
    """
    split = F.split(F.regexp_replace(F.col(text), "\r", ""), "\n")
    blocks = F.sequence(F.lit(0), F.floor((F.size("_lines") - 1) / lines).cast("int"))
    cut = texts.withColumn("_lines", split).withColumn("block", F.explode(blocks))
    columns = {
        name: F.get("_lines", F.col("block") * lines + i) for i, name in enumerate(names)
    }
    return cut.withColumns(columns).drop("_lines")


# The character references that occur in report tables.
_REFERENCES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def html_text(fragment: Column) -> Column:
    """Text of an HTML fragment: tags out, character references in, ends trimmed."""
    text = F.regexp_replace(fragment, "<[^>]*>", "")
    for reference, character in _REFERENCES:
        text = F.replace(text, F.lit(reference), F.lit(character))
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def has_attribute(tag: Column, name: str, value: str) -> Column:
    """True where an opening tag has the attribute with that value, quoted or not."""
    shape = rf"(?i)\s{re.escape(name)}\s*=\s*([\"']?){re.escape(value)}\1(?=[\s/>])"
    return tag.rlike(shape)


def html_elements(
    pages: DataFrame, html: str, tag: str, name: str, value: str, out: str = "element", *, nested: bool = False
) -> DataFrame:
    """One row per element ``<tag name=value>`` of a page, in page order: ``element_no`` and ``out``.

    An element reaches to the end tag of its own depth, or to the page's end without one.
    Elements of the same tag inside of it are cut out, so that the rows of an outer table are
    its own; ``nested`` leaves them in.  A chosen element inside a chosen one is no row of its
    own.  The page is cut at the tag's start and end tags, and depth is a running sum over the
    pieces within the row: nothing is shuffled.  A page without such an element, or a null one,
    gives no row.
    """
    start = rf"(?i)^<{tag}(?=[\s/>])[^>]*>"
    pieces = F.split(F.col(html), rf"(?i)(?=<{tag}[\s/>])|(?<=</{tag}\s{{0,9}}>)")
    fresh = F.array().cast("array<string>")
    state = F.struct(
        F.lit(0).alias("depth"), F.lit(0).alias("at"), fresh.alias("text"), fresh.alias("found")
    )

    def step(state: Column, piece: Column) -> Column:
        opening = F.regexp_extract(piece, start, 0)
        depth = state["depth"] + F.when(opening != "", 1).otherwise(0)
        begins = (state["at"] == 0) & has_attribute(opening, name, value)
        at = F.when(begins, depth).otherwise(state["at"])
        inside = (at > 0) if nested else (at > 0) & (depth == at)
        text = F.when(inside, F.concat(state["text"], F.array(piece))).otherwise(state["text"])
        after = F.greatest(depth - F.when(piece.rlike(rf"(?i)</{tag}\s{{0,9}}>$"), 1).otherwise(0), F.lit(0))
        ends = (at > 0) & (after < at)
        return F.struct(
            after.alias("depth"),
            F.when(ends, 0).otherwise(at).alias("at"),
            F.when(ends, fresh).otherwise(text).alias("text"),
            F.when(ends, F.concat(state["found"], F.array(F.array_join(text, "")))).otherwise(state["found"]).alias("found"),
        )

    def finish(state: Column) -> Column:
        return F.when(state["at"] > 0, F.concat(state["found"], F.array(F.array_join(state["text"], "")))).otherwise(state["found"])

    return pages.select("*", F.posexplode(F.aggregate(pieces, state, step, finish)).alias("element_no", out))


def html_rows(pages: DataFrame, html: str, row: str, cell: str) -> DataFrame:
    """Rows of an HTML table: adds ``row_no`` and ``cells`` (array of texts).

    ``row`` and ``cell`` are patterns whose first group is the content, for
    example ``TABLE_ROW`` and ``TABLE_CELL``.
    """
    rows = F.regexp_extract_all(F.col(html), F.lit(row), F.lit(1))
    found = pages.select("*", F.posexplode(rows).alias("row_no", "_row"))
    cells = F.transform(F.regexp_extract_all(F.col("_row"), F.lit(cell), F.lit(1)), html_text)
    return found.withColumn("cells", cells).drop("_row")


TABLE_ROW = r"(?s)<tr[^>]*valign=[\"']top[\"'][^>]*>(.*?)</tr>"
TABLE_CELL = r"(?s)<div[^>]*>(.*?)</div>"
