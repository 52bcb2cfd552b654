"""Reading tables and landing CSV files as Parquet."""

from __future__ import annotations

import csv
import re
from collections import Counter, defaultdict
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from pathlib import PurePosixPath
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallychain.functions.dates import month_label
from tallychain.operators.frames import pick_first, union_all

MALFORMED = "_malformed"
#: Columns of a landed table beside the declared ones.
CELLS, BAD, LANDED_AS = "rejected_cells", "rejected_columns", "landed_as"
#: Lines at the head of a file that may be blank.
BLANK_LINES = 64


def scan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def table_name_clean(path: str) -> str:
    """Table name for a file: its stem with everything but letters and digits as '_'."""
    return re.sub(r"[^A-Za-z0-9]", "_", PurePosixPath(path).stem)


@dataclass(frozen=True)
class Landed:
    """The rows of CSV files, and those that could not be read as declared."""

    rows: DataFrame
    #: the declared columns as text, ``source_file`` and ``bad_columns``
    rejects: DataFrame


def _first_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line): the first of the leading lines of each file that is not blank.

    One job for any number of files: each file is one task, in which Spark numbers the
    lines from 0. Lines are only told apart here; cells are parsed once, later.
    """
    own = spark.newSession()
    for key in ("maxPartitionBytes", "openCostInBytes"):  # a file to a task
        own.conf.set(f"spark.sql.files.{key}", str(1 << 40))
    number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    lines = own.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("value"), number.alias("number")
    )
    head = lines.where((F.col("number") < BLANK_LINES) & (F.btrim("value") != ""))
    return head.groupBy("file").agg(F.min_by("value", "number").alias("line"))


def header_columns(line: str) -> tuple[str, ...]:
    """Column names of a header line; nameless and repeated ones are told apart by their place."""
    cells = next(csv.reader([line]))
    repeats = Counter(c.lower() for c in cells)
    return tuple(
        f"_c{i}" if not c.strip() else f"{c}{i}" if repeats[c.lower()] > 1 else c
        for i, c in enumerate(cells)
    )


def _layouts(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Paths by header: files of one table need not agree on columns or their order."""
    found = defaultdict(list)
    for row in _first_lines(spark, path).collect():
        found[header_columns(row.line)].append(unquote(row.file))
    # Files that agree are read by the pattern they were given by.
    return {header: [path] if len(found) == 1 else sorted(names) for header, names in found.items()}


def _as_text(
    spark: SparkSession, header: tuple[str, ...], names: list[str], multi_line: bool = False
) -> DataFrame:
    """All cells as text. Rows with more or fewer cells than the header carry ``MALFORMED``."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*header, MALFORMED)])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("columnNameOfCorruptRecord", MALFORMED)
        .option("columnPruning", False)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .csv(names)
        .withColumn("source_file", F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))))
    )


def _named(name: str) -> str:
    return name.strip().lstrip("\ufeff").strip().lower()


def _bind(
    df: DataFrame, header: tuple[str, ...], fields: list[T.StructField], aliases: dict[str, str]
) -> DataFrame:
    """Declared columns by header name, whatever their place; a missing one is an error."""
    own = {aliases.get(_named(c), _named(c)): c for c in header}
    missing = [f.name for f in fields if _named(f.name) not in own]
    if missing:
        raise ValueError(f"columns {missing} are not in the header {list(header)}")
    cells = [F.col(f"`{own[_named(f.name)]}`").alias(f.name) for f in fields]
    return df.select(*cells, MALFORMED, "source_file")


def _parsed(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None,
    aliases: dict[str, str] | None,
    multi_line: bool,
) -> tuple[DataFrame, list[str]]:
    """One parse of all files, and the names of the declared columns.

    The columns in their declared types, null in a row that is rejected; ``CELLS`` has
    the text of a rejected row, ``BAD`` its bad columns.
    """
    layouts = _layouts(spark, path)
    if schema is None:
        fields = [T.StructField(c, T.StringType()) for header in layouts for c in header]
        fields = list({f.name: f for f in fields}.values())
    else:
        struct = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        fields = struct.fields
    if layouts:
        parts = [
            _bind(_as_text(spark, header, names, multi_line), header, fields, aliases or {})
            for header, names in layouts.items()
        ]
    else:
        names = [*(f.name for f in fields), MALFORMED, "source_file"]
        parts = [spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in names]))]
    cells = {f.name: F.col(f"`{f.name}`") for f in fields}
    typed = {
        f.name: cells[f.name]
        if isinstance(f.dataType, T.StringType)
        else F.nullif(F.btrim(cells[f.name]), F.lit("")).try_cast(f.dataType)
        for f in fields
    }
    bad = F.array_compact(
        F.array(
            F.when(F.col(MALFORMED).isNotNull(), F.lit("*")),
            *[
                F.when((F.btrim(cells[f.name]) != "") & typed[f.name].isNull(), F.lit(f.name))
                for f in fields
            ],
        )
    )
    text = F.struct(*cells.values(), F.col("source_file"))
    checked = union_all(parts).select(
        F.struct(*[typed[n].alias(n) for n in typed]).alias("row"), text.alias(CELLS), bad.alias(BAD)
    )
    rejected = F.size(BAD) > 0
    return (
        checked.select(
            *[F.when(~rejected, F.col(f"row.`{n}`")).alias(n) for n in typed],
            F.when(rejected, F.col(CELLS)).alias(CELLS),
            F.when(rejected, F.col(BAD)).alias(BAD),
            F.when(rejected, F.lit("reject")).otherwise(F.lit("row")).alias(LANDED_AS),
        ),
        list(typed),
    )


def _landed(parsed: DataFrame, names: list[str]) -> Landed:
    columns = [F.col(f"`{n}`") for n in names]
    return Landed(
        parsed.where(F.col(LANDED_AS) == "row").select(*columns),
        parsed.where(F.col(LANDED_AS) == "reject").select(f"{CELLS}.*", F.col(BAD).alias("bad_columns")),
    )


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    aliases: dict[str, str] | None = None,
    multi_line: bool = False,
) -> Landed:
    """CSV with a header; a schema is bound by column name, not by position.

    Names match without regard to case; ``aliases`` maps other spellings (lower
    case) to declared names. Columns that are not declared are left out. A row goes
    to ``rejects`` as a whole if a cell can't be read as its declared type or the
    row has more or fewer cells than the header, so no amount turns into null
    unseen. Without a schema every column stays text: types are never guessed.

    Headers are found in one job, whatever the number of files. ``multi_line`` takes
    line breaks inside quoted cells as part of the cell; a file is then read by one
    task, so ask for it only where files have them.
    """
    return _landed(*_parsed(spark, path, schema, aliases, multi_line))


def csv_load(
    spark: SparkSession,
    path: str,
    out_root: str,
    table: str | None = None,
    schema: T.StructType | str | None = None,
    aliases: dict[str, str] | None = None,
    multi_line: bool = False,
) -> Landed:
    """Replace table ``table`` below ``out_root`` with the rows of the CSV file(s) at ``path``.

    Files are parsed once: rows and rejects are written together, as two partitions of
    the table, and ``open_landed`` gives either without opening the other.
    """
    target = f"{out_root.rstrip('/')}/{table or table_name_clean(path)}"
    parsed, names = _parsed(spark, path, schema, aliases, multi_line)
    parsed.write.mode("overwrite").partitionBy(LANDED_AS).parquet(target)
    return _landed(spark.read.schema(parsed.schema).parquet(target), names)


def open_landed(spark: SparkSession, target: str) -> Landed:
    """A table that ``csv_load`` wrote, as its rows and its rejects."""
    parsed = spark.read.parquet(target)
    return _landed(parsed, [c for c in parsed.columns if c not in (CELLS, BAD, LANDED_AS)])


def csv_load_all(
    spark: SparkSession,
    patterns: dict[str, str],
    out_root: str,
    schemas: dict[str, str] | None = None,
    aliases: dict[str, str] | None = None,
) -> dict[str, Landed]:
    """One load per table; each pattern may match any number of files. Small tables don't wait for large ones."""
    known = schemas or {}

    def load(item: tuple[str, str]) -> Landed:
        table, pattern = item
        return csv_load(spark, pattern, out_root, table, known.get(table), aliases)

    with ThreadPoolExecutor(max_workers=4) as pool:
        return dict(zip(patterns, pool.map(load, patterns.items())))


def load_report(landed: dict[str, Landed]) -> DataFrame:
    """Loaded and rejected rows of each table."""
    return union_all(
        [
            part.rows.agg(F.count("*").alias("loaded"))
            .withColumn("table_name", F.lit(name))
            .withColumn("rejected", part.rejects.agg(F.count("*")).scalar())
            .select("table_name", "loaded", "rejected")
            for name, part in landed.items()
        ]
    )


def add_source_month(df: DataFrame, date_col: str, file_name: bool = True) -> DataFrame:
    """Month label, and the name of the file the row came from."""
    extra = ["_metadata.file_name AS source_file"] if file_name else []
    return df.selectExpr("*", f"{month_label(date_col)} AS source_month", *extra)


def dedupe_on_load(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """One row per key. ``order`` makes the surviving row the same on every run."""
    return pick_first(df, keys, *order) if order else df.dropDuplicates(keys)
