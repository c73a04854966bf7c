"""CSV and JSON readers.

All readers declare their schema or read text only; nothing is inferred, so
identifiers keep leading zeros and a scan never reads the data twice.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scopewise.operators.scoping import load_fact, trim_headers
from scopewise.session import materialize, ship_package
from scopewise.spec import DEFAULT_SPEC, FactSpec

# Cell texts that count as missing in a lenient scan.
MISSING_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

UTF8, CP1252, LATIN1 = "utf-8-sig", "cp1252", "latin-1"


def _cp1252_repairs() -> tuple[str, str, str]:
    """Latin-1 characters that code page 1252 reads otherwise, their
    replacements, and the characters that the code page does not define."""
    wrong, right, undefined = [], [], []
    for byte in range(0x80, 0xA0):
        try:
            right.append(codecs.decode(bytes([byte]), "cp1252"))
            wrong.append(chr(byte))
        except UnicodeDecodeError:
            undefined.append(chr(byte))
    return "".join(wrong), "".join(right), "".join(undefined)


_WRONG, _RIGHT, _UNDEFINED = _cp1252_repairs()


def _read(spark: SparkSession, path, what: str, **options: str) -> DataFrame:
    """A header CSV as text columns, with doubled quotes as escape.

    The headers of all files must agree.
    """
    try:
        reader = spark.read.options(header=True, escape='"', enforceSchema=False, **options)
        return reader.csv(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"{what}: nothing to read at {path}") from error
        raise


def has_open_quotes(spark: SparkSession, path, what: str = "Dataset") -> bool:
    """Whether a quoted cell goes on in the next line of some file."""
    return not block_profile(spark, path, what).where("odd_lines > 0 OR bare_returns").isEmpty()


def _lines(spark: SparkSession, path, what: str) -> DataFrame:
    """Lines as they stand between line feeds, with their file and the start of their block of it."""
    try:
        lines = spark.read.text(path, lineSep="\n")
        return lines.select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
        )
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"{what}: nothing to read at {path}") from error
        raise


def keep_blanks(df: DataFrame) -> DataFrame:
    """Empty cells as empty text; Spark reads them as null."""
    return df.select(*[F.coalesce(_cell(c), F.lit("")).alias(c) for c in df.columns])


def _cell(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def block_profile(spark: SparkSession, path, what: str = "Dataset") -> DataFrame:
    """What one pass over all lines tells about every block of every file; stored, one row per block.

    ``odd_lines``: lines with an odd number of quotes, after each of which the text is inside a quoted cell
    if it was outside before, and the other way round.  ``bare_returns``: carriage returns inside lines.
    ``not_utf8`` and ``undefined`` tell encodings apart.
    """
    value = F.col("value")
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    as_latin1 = F.decode(value.cast("binary"), "ISO-8859-1")
    found = _lines(spark, path, what).groupBy("file", "block").agg(
        F.count_if(quotes % 2 == 1).alias("odd_lines"),
        F.bool_or(as_latin1.rlike("\\r[^\\r]")).alias("bare_returns"),
        F.bool_or(~F.is_valid_utf8("value")).alias("not_utf8"),
        F.bool_or(as_latin1.rlike(f"[{_UNDEFINED}]")).alias("undefined"),
    )
    return materialize(found, "blocks")


def inside_blocks(profile: DataFrame) -> DataFrame:
    """Blocks that begin inside a quoted cell: ``file``, ``block`` and ``opener``, the block that opened it.

    A running sum of odd lines over the blocks of a file says which; only one row per block takes part.
    """
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    return profile.select(
        "file",
        "block",
        F.sum("odd_lines").over(before).alias("odd_before"),
        F.max(F.when(F.col("odd_lines") > 0, F.col("block"))).over(before).alias("opener"),
    ).where("odd_before % 2 = 1").select("file", "block", "opener")


#: What Spark's reader trims before it looks for blank lines.
_BLANK = bytes(range(33))
_PIECES = "file string, opener long, block long, first boolean, value binary"


def assemble_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of blocks (file, block, opener, value), in order, as records.

    ``opener`` is given for lines of blocks that begin inside a cell.  Records that lie in one block come out
    whole, without ``opener``; the parts of others have that of the block in which they begin.
    """
    place, opener, held, first, empty = (None, None), None, [], False, False
    schema = pa.schema(
        [("file", pa.string()), ("opener", pa.int64()), ("block", pa.int64()), ("first", pa.bool_()), ("value", pa.binary())]
    )
    rows: list[tuple] = []

    def end_block() -> None:
        if held:
            rows.append((place[0], place[1] if opener is None else opener, place[1], first, b"\n".join(held)))
        elif empty:  # the block has been read, though it has blank lines only
            rows.append((*place, place[1], False, None))

    def batch() -> pa.RecordBatch:
        arrays = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
        rows.clear()
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    inside = False
    for lines in batches:
        columns = [lines.column(c).to_pylist() for c in ("file", "block", "opener", "value")]
        for file, block, from_block, value in zip(*columns, strict=True):
            if (file, block) != place:
                end_block()
                place, opener, held, first, empty = (file, block), from_block, [], block == 0, True
                inside = opener is not None
            odd = value.count(b'"') % 2 == 1
            if inside or odd:
                held.append(value)
            elif not value.strip(_BLANK):
                continue
            if inside == odd:
                empty = False
                rows.append((file, opener, block, first, b"\n".join(held) if inside else value))
                inside, opener, held, first = False, None, [], False
            else:
                inside = True
        if rows:
            yield batch()
    end_block()
    if rows:
        yield batch()


def read_records(
    spark: SparkSession, path, what: str = "Dataset", profile: DataFrame | None = None, max_broadcast: int = 50_000
) -> DataFrame:
    """All CSV records as bytes, quoted line breaks inside; blank lines are left out.

    Columns: ``file``, ``block`` in which the record begins, ``id`` (rising inside a block without gaps),
    ``first`` (of its file) and ``value``.  Blocks of one file are read by different tasks.  Each learns from
    the profile whether it begins inside a quoted cell; only the parts of records that cross blocks are
    brought together.  The few blocks that begin inside a cell go to all tasks; should they be more than
    ``max_broadcast``, lines are shuffled by block instead.
    """
    ship_package(spark)
    profile = block_profile(spark, path, what) if profile is None else profile
    for _ in range(3):
        inner = materialize(inside_blocks(profile), "inside-blocks")
        lines = _lines(spark, path, what)
        if inner.count() <= max_broadcast:
            lines = lines.join(F.broadcast(inner), ["file", "block"], "left")
        else:
            numbered = lines.withColumn("_line", F.monotonically_increasing_id())
            by_block = numbered.join(inner, ["file", "block"], "left").repartition("file", "block")
            lines = by_block.sortWithinPartitions("file", "block", "_line")
        lines = lines.select("file", "block", "opener", F.col("value").cast("binary").alias("value"))
        pieces = lines.mapInArrow(assemble_records, _PIECES).withColumn("id", F.monotonically_increasing_id())
        pieces = materialize(pieces, "records")
        # A session that has gained or lost executors in between may split the files in another way.
        blocks = pieces.select("file", "block").distinct()
        known = profile.select("file", "block")
        if blocks.exceptAll(known).isEmpty() and known.exceptAll(blocks).isEmpty():
            break
        profile = block_profile(spark, path, what)
    else:
        raise RuntimeError(f"{what}: the files at {path} were split differently by every scan")
    own = pieces.where("value IS NOT NULL")
    crossing = (
        own.where("opener IS NOT NULL")
        .groupBy("file", "opener")
        .agg(
            F.sort_array(F.collect_list(F.struct("block", "value"))).alias("parts"),
            F.bool_or("first").alias("first"),
            F.min_by("id", "block").alias("id"),
        )
        .select("file", F.col("opener").alias("block"), "id", "first", _join_lines(F.col("parts.value")).alias("value"))
    )
    return own.where("opener IS NULL").select("file", "block", "id", "first", "value").unionByName(crossing)


def _join_lines(parts: Column) -> Column:
    """Binary parts with a line feed between them."""
    line_feed = F.lit(b"\n")
    rest = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    return F.aggregate(rest, F.element_at(parts, 1), lambda whole, part: F.concat(whole, line_feed, part))


_PLACE = ("_file", "_block", "_id")


def _parse_records(records: DataFrame, text: Column, names: list[str]) -> DataFrame:
    """Records as text columns, with ``_PLACE``.  The first record of every file must be the header."""
    line = F.regexp_replace(text, "\\r$", "")
    line = F.when(F.col("first"), F.regexp_replace(line, "^(\ufeff|\u00ef\u00bb\u00bf)", "")).otherwise(line)
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    place = [F.col(c.removeprefix("_")).alias(c) for c in _PLACE]
    parsed = records.select("first", *place, F.from_csv(line, schema, {"escape": '"', "multiLine": "true"}).alias("cells"))
    same = F.lit(True)
    for i, name in enumerate(names):
        cell, name = F.coalesce(F.col(f"cells.c{i}"), F.lit("")), name.removeprefix("\ufeff").removeprefix("\u00ef\u00bb\u00bf")
        # Spark numbers names that repeat and columns without a name.
        same &= (cell == name) | (F.concat(cell, F.lit(i)) == name) | ((cell == "") & F.lit(name == f"_c{i}"))
    wrong = F.raise_error(F.lit("The CSV header of a file does not conform to that of the others.")).cast("boolean")
    rows = parsed.where(F.when(~F.col("first"), True).when(same, False).otherwise(wrong))
    return rows.select(*[F.col(f"cells.c{i}").alias(name) for i, name in enumerate(names)], *_PLACE)


def _read_rows(spark: SparkSession, path, what: str, profile: DataFrame, encoding: str = "UTF-8") -> DataFrame:
    """Text columns and ``_PLACE``; blank cells are null.

    Without line breaks in cells Spark reads the files as they are.  Otherwise lines are put together to
    records first, by many tasks per file.  Lone carriage returns leave no choice but one task per file.
    """
    odd, returns = profile.agg(F.sum("odd_lines"), F.bool_or("bare_returns")).first()
    if not odd or returns:
        rows = _read(spark, path, what, encoding=encoding, multiLine=str(bool(returns)).lower())
        file, block = F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")
        return rows.select("*", file, block, F.monotonically_increasing_id().alias("_id"))
    names = _read(spark, path, what, encoding=encoding, multiLine="true").columns
    records = read_records(spark, path, what, profile)
    text = F.col("value").cast("string") if encoding == "UTF-8" else F.decode("value", encoding)
    return _parse_records(records, text, names)


def read_strict_text(
    spark: SparkSession, path, what: str = "Dataset", multiline: bool | None = None
) -> DataFrame:
    """All columns as text, empty cells kept, header names trimmed.

    Line breaks inside quoted cells are read right, by many tasks per file: one pass finds out which blocks
    begin inside a cell.  ``multiline=False`` promises that there are none and saves that pass.
    """
    if multiline is False:
        return trim_headers(keep_blanks(_read(spark, path, what)))
    rows = _read_rows(spark, path, what, block_profile(spark, path, what))
    return trim_headers(keep_blanks(rows.drop(*_PLACE)))


def read_strict_fact(
    spark: SparkSession, path, spec: FactSpec = DEFAULT_SPEC, multiline: bool | None = None
) -> DataFrame:
    """Strict scan, parse and full rule suite."""
    return load_fact(read_strict_text(spark, path, multiline=multiline), spec)


def detect_encodings(spark: SparkSession, path, profile: DataFrame | None = None) -> DataFrame:
    """Encoding per file: ``file``, ``encoding``.

    Every line is tested where it lies, so one big file is tested by many
    tasks.  Valid UTF-8 wins; otherwise code page 1252 unless a file holds one
    of the bytes it does not define; Latin-1 takes the rest.
    """
    profile = block_profile(spark, path, "Aggregate source") if profile is None else profile
    found = profile.groupBy("file").agg(F.bool_or("not_utf8").alias("not_utf8"), F.bool_or("undefined").alias("undefined"))
    encoding = (
        F.when(~F.col("not_utf8"), F.lit(UTF8))
        .when(~F.col("undefined"), F.lit(CP1252))
        .otherwise(F.lit(LATIN1))
    )
    return found.select("file", encoding.alias("encoding"))


def as_cp1252_bytes(column: Column) -> Column:
    """Text whose bytes in Latin-1 are those of ``column`` in code page 1252."""
    return F.translate(column, _RIGHT, _WRONG)


def _decoded(column: Column, encoding: Column) -> Column:
    """Text that was read byte by byte as Latin-1, in the encoding of its file.

    The code page differs from Latin-1 in a few characters only.
    """
    return (
        F.when(encoding == UTF8, F.decode(F.encode(column, "ISO-8859-1"), "UTF-8"))
        .when(encoding == CP1252, F.translate(column, _WRONG, _RIGHT))
        .otherwise(column)
    )


def _header_name(name: str) -> str:
    """A column name that was read as Latin-1, without a byte order mark."""
    try:
        return name.encode("latin-1").decode("utf-8-sig").strip()
    except UnicodeError:
        return name.translate(str.maketrans(_WRONG, _RIGHT)).strip()


def read_lenient_rows(spark: SparkSession, path, profile: DataFrame | None = None) -> DataFrame:
    """Text columns with missing words as null, and ``_encoding`` of the row's file.

    Files of different encodings may lie in one folder.  All are read as bytes
    in one scan and decoded cell by cell with the encoding of their file, which
    a join brings: no file name passes through the driver.
    """
    profile = block_profile(spark, path, "Aggregate source") if profile is None else profile
    found = materialize(detect_encodings(spark, path, profile), "encodings")
    raw = _read_rows(spark, path, "Aggregate source", profile, "ISO-8859-1")
    columns = [c for c in raw.columns if c not in _PLACE]
    names = [_header_name(name) for name in columns]
    rows = raw.join(found.withColumnsRenamed({"file": "_file", "encoding": "_encoding"}), "_file")
    cells = [_decoded(_cell(c), F.col("_encoding")).alias(n) for c, n in zip(columns, names)]
    text = rows.select(*cells, "_encoding")
    cleaned = [F.when(~_cell(n).isin(*MISSING_WORDS), _cell(n)).alias(n) for n in names]
    return text.select(*cleaned, "_encoding")


def read_lenient_text(spark: SparkSession, path) -> tuple[DataFrame, list[str]]:
    """Text columns with missing words as null, and the encodings found (three at most)."""
    profile = block_profile(spark, path, "Aggregate source")
    rows = read_lenient_rows(spark, path, profile)
    encodings = detect_encodings(spark, path, profile).select("encoding").distinct().collect()
    return rows.drop("_encoding"), sorted(r["encoding"] for r in encodings)


def read_metrics(spark: SparkSession, path, spec: FactSpec = DEFAULT_SPEC, fmt: str = "parquet") -> DataFrame:
    """Re-read written metrics under their declared schema."""
    schema = spec.metrics_schema()
    options = {"header": True, "escape": '"', "enforceSchema": False} if fmt == "csv" else {}
    table = spark.read.schema(schema).options(**options).format(fmt).load(path)
    # Columns that split the folders come last in the scan.
    return table.select(*schema.names)


def written_positions(spark: SparkSession, path, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """Metrics as Parquet with ``file_number`` (of the scope's files, by name), ``row_index`` in the file and
    ``written_position``, the place of the row among those of its scope in the order of files and rows.

    Only one row per scope and file takes part in the running sums.
    """
    rows = read_metrics(spark, path, spec).select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("row_index")
    )
    keys = [*spec.scope_keys, "_file"]
    in_scope = W.partitionBy(*spec.scope_keys).orderBy("_file")
    files = rows.groupBy(*keys).agg(F.count("*").alias("_rows")).select(
        *keys,
        F.row_number().over(in_scope).alias("file_number"),
        F.coalesce(F.sum("_rows").over(in_scope.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
    )
    found = rows.join(files, keys).withColumn("written_position", F.col("_before") + F.col("row_index") + 1)
    return found.drop("_file", "_before")


# The names in a qualification record.
QUALIFICATION_SCHEMA = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "source_id",
            "source_url",
            "licence",
            "retrieval_date",
            "source_sha256",
            "qualification_status",
            "privacy_classification",
            "source_as_of_date",
        )
    ]
)


def read_qualifications(spark: SparkSession, path) -> DataFrame:
    """Qualification documents, one JSON object per file, one row each.

    ``fields`` lists the names that a document has; a name that is there with
    a null value is not missing.
    """
    try:
        documents = spark.read.text(path, wholetext=True)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"No qualification record at {path}") from error
        raise
    record = F.from_json("value", QUALIFICATION_SCHEMA)
    parsed = documents.select(record.alias("record"), F.json_object_keys("value").alias("fields"))
    return parsed.select("record.*", "fields")


# The columns of a source registry.
REGISTRY_COLUMNS = (
    "source_id",
    "publisher",
    "dataset_name",
    "source_url",
    "priority",
    "expected_use",
    "access_date",
    "source_as_of_date",
    "licence",
    "fields_used",
    "transformation",
    "status",
    "notes",
)


def read_registry(spark: SparkSession, path) -> DataFrame:
    """The source registry as text with blank cells kept and a ``row_no``.

    ``row_no`` is the number of the row in the file, header counted.  Rows are
    numbered inside their block of the file and shifted by the blocks before.
    """
    what = "Source registry"
    raw = _read_rows(spark, path, what, block_profile(spark, path, what))
    names = [c for c in raw.columns if c not in _PLACE]
    # Stored, because a second scan might split the files differently.
    blocks = materialize(
        raw.select(*[F.coalesce(_cell(c), F.lit("")).alias(c.strip()) for c in names], *_PLACE), "registry"
    )
    sizes = blocks.groupBy("_file", "_block").agg(
        F.min("_id").alias("_first"), F.count("*").alias("_rows")
    )
    earlier = W.partitionBy("_file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    shifts = sizes.select("_file", "_block", (before - F.col("_first") + 2).alias("_shift"))
    numbered = blocks.join(shifts, ["_file", "_block"])
    return numbered.select(
        *[_cell(c.strip()) for c in names], (F.col("_id") + F.col("_shift")).alias("row_no")
    )
