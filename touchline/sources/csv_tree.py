"""Trees of CSV files with differing headers, read as text.

One scan binds cells by position to generic columns; each row then takes its
names from the header of its own file, so any mix of headers is one job. Everything
is read by Spark's own readers. A file that cannot be read ends the job; one that has
nothing to load is listed with the reason.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterable, Sequence
from urllib.parse import urlparse

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from touchline import config
from touchline.session import materialise
from touchline.sources.csv_records import SCAN as _SCAN, csv_records, decoded as _decoded, file_id, parsed
from touchline.sources.tables import align_schema, append_bronze

LINEAGE = ("_SOURCE_FILE", "_LEAGUE", "_TEAM", "_PLAYER_TYPE", "_BATCH_ID", "_INGEST_TS")


def scan_csv_tree(spark: SparkSession, root: str) -> DataFrame:
    """file_path, file_name, league, team and length of every CSV below `root`.

    League and team are the first two folders of files at least that deep. Only
    the listing is read, no file content. Spark's scan leaves out files of no bytes;
    these come from the listing, which the driver has made for the scan.
    """
    listed = spark.read.format("binaryFile").options(**_SCAN).load(root)
    every = spark.createDataFrame([(f,) for f in listed.inputFiles()], "path string")
    full = listed.select(_decoded("path", False).alias("_at"), "length")
    files = (
        every.select(_decoded("path").alias("path")).distinct()
        .join(full, F.col("path") == F.col("_at"), "left")
        .select("path", F.coalesce("length", F.lit(0)).alias("length"))
    )
    below = urlparse(root).path.rstrip("/") + "/"
    start = F.instr(F.col("path"), F.lit(below)) + len(below)
    parts = F.split(F.expr("path").substr(start, F.length("path")), "/")
    deep = F.size(parts) >= 3
    return files.select(
        F.col("path").alias("file_path"),
        F.element_at(parts, -1).alias("file_name"),
        F.when(deep, parts[0]).otherwise(config.UNKNOWN_LEAGUE).alias("league"),
        F.when(deep, parts[1]).otherwise(config.UNKNOWN_TEAM).alias("team"),
        "length",
    )


def _first_records(batches: Iterable[pd.DataFrame]):
    for batch in batches:
        texts = [(t or "").lstrip("\ufeff") for t in batch.pop("text")]
        yield batch.assign(header=[next(csv.reader(io.StringIO(t)), []) if t.strip() else [] for t in texts])


def stripped(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def normalise_header(name: Column) -> Column:
    upper = F.regexp_replace(F.upper(stripped(name)), "[^A-Z0-9_]", "_")
    return F.regexp_replace(F.regexp_replace(upper, "_+", "_"), "^_|_$", "")


def stage_records(spark: SparkSession, root: str, multi_line: bool = True) -> DataFrame:
    """(file, record, first) of the whole tree, stored: the text is parsed from here, and
    headers are the records marked `first`. Where no cell holds a line break,
    `multi_line=False` takes lines as they are, in one pass."""
    if multi_line:
        return materialise(csv_records(spark, root), "records")
    lines = (
        spark.read.options(**_SCAN).text(root)
        .select(
            file_id(_decoded("_metadata.file_path")).alias("file"), F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"), F.col("value").alias("record"),
        ).where("record <> ''")
    )
    lines = materialise(lines, "lines")
    firsts = lines.where("block = 0").groupBy("file").agg(F.min("at").alias("at")).withColumn("first", F.lit(True))
    marked = lines.join(firsts, ["file", "at"], "left").withColumn("record", F.regexp_replace("record", "^\ufeff", ""))
    return materialise(marked.select("file", "record", F.coalesce("first", F.lit(False)).alias("first")), "records")


def check_headers(
    spark: SparkSession, root: str, files: DataFrame, required: Sequence[str] = (), records: DataFrame | None = None
) -> DataFrame:
    """Adds the raw `header`, normalised `columns` and `problem` of each file: why it
    cannot be loaded, else null. `records` are those stored of the tree, if they are."""
    records = stage_records(spark, root) if records is None else records
    texts = records.where("first").select(F.col("file").alias("_file"), F.col("record").alias("text"))
    own = file_id(_decoded("file_path", False))
    found = files.withColumn("_file", own).join(texts, "_file", "left").drop("_file")
    schema = ", ".join(f"{name} {kind}" for name, kind in files.dtypes)
    found = found.mapInPandas(_first_records, f"{schema}, header array<string>").withColumn(
        "columns", F.transform("header", normalise_header)
    )
    problem = F.when(F.col("length") == 0, "empty").when(F.size("header") == 0, "no header")
    for name in required:
        problem = problem.when(~F.array_contains("columns", name), f"no column {name}")
    return found.withColumn("problem", problem)


def read_headers(
    spark: SparkSession, root: str, files: DataFrame, required: Sequence[str] = (), records: DataFrame | None = None
) -> DataFrame:
    """The files that can be loaded, with `header` and `columns`."""
    return check_headers(spark, root, files, required, records).where("problem is null").drop("problem")


def read_csv_groups(
    records: DataFrame,
    headers: DataFrame,
    null_tokens: Sequence[str] = config.NULL_TOKENS,
) -> DataFrame:
    """All rows of the tree as stripped text under the union of all columns, with
    `_SOURCE_FILE`, `_LEAGUE` and `_TEAM`, from its stored records. A column absent from
    a file is null there."""
    shape = headers.select(F.explode("columns").alias("column")).agg(F.sort_array(F.collect_set("column"))).first()[0]
    names = [c for c in shape or [] if c]
    raw = parsed(records)
    # Where each column of the union stands in a file is worked out once per file.
    order = F.transform(
        F.split(F.lit("\n".join(names)), "\n"),
        lambda n: F.nullif(F.array_position("columns", n), F.lit(0)).cast("int"),
    )
    rows = raw.join(
        headers.select(
            file_id(_decoded("file_path", False)).alias("file"), _decoded("file_path", False).alias("file_path"),
            order.alias("order"), "league", "team",
        ),
        "file",
    )
    # Null tokens count as written; only 'nan' is also one after stripping.
    value = lambda c: F.when(~c.isin(*null_tokens) & (stripped(c) != "nan"), stripped(c))
    rows = rows.withColumn("values", F.transform("order", lambda i: value(F.try_element_at("cells", i))))
    return rows.select(
        *[F.col("values")[k].alias(name) for k, name in enumerate(names)],
        F.col("file_path").alias("_SOURCE_FILE"),
        F.col("league").alias("_LEAGUE"),
        F.col("team").alias("_TEAM"),
    )


def classify_files(
    df: DataFrame,
    headers: DataFrame,
    position: str = "PLAYER_POSITION",
    words: Sequence[str] = config.KEEPER_WORDS,
    markers: Sequence[str] = config.KEEPER_HEADERS,
) -> DataFrame:
    """file_path, player_type and rows: goalkeeper if any position names one, or else
    if the header holds a keeper column; outfield otherwise."""
    plain = F.transform("header", lambda h: F.lower(stripped(h)))
    by_header = headers.select(
        _decoded("file_path", False).alias("file_path"),
        F.arrays_overlap(plain, F.array(*[F.lit(m) for m in markers])).alias("by_header"),
    )
    position_cell = F.lower(position) if position in df.columns else F.lit(None).cast("string")
    named = F.max(F.coalesce(position_cell.rlike("|".join(words)), F.lit(False)))
    by_value = df.groupBy(F.col("_SOURCE_FILE").alias("file_path")).agg(named.alias("by_value"), F.count(F.lit(1)).alias("rows"))
    keeper = F.coalesce("by_value", F.lit(False)) | F.col("by_header")
    return by_header.join(by_value, "file_path", "left").select(
        "file_path", F.when(keeper, "goalkeeper").otherwise("outfield").alias("player_type"), F.coalesce("rows", F.lit(0)).alias("rows")
    )


def add_lineage(df: DataFrame, types: DataFrame, batch_id: str) -> DataFrame:
    """Player type per file, batch id and load time."""
    named = types.select(F.col("file_path").alias("_SOURCE_FILE"), "player_type")
    typed = df.join(named, "_SOURCE_FILE", "left")
    return typed.withColumnRenamed("player_type", "_PLAYER_TYPE").withColumns(
        {"_BATCH_ID": F.lit(batch_id), "_INGEST_TS": F.current_timestamp()}
    )


def ingest_csv_tree(
    spark: SparkSession,
    root: str,
    batch_id: str,
    required: Sequence[str] = (),
    null_tokens: Sequence[str] = config.NULL_TOKENS,
    multi_line: bool = True,
) -> DataFrame:
    """Bronze rows of a whole tree: its records are stored once, from which headers come,
    and then its rows, of which the classifier reads just two columns."""
    records = stage_records(spark, root, multi_line)
    headers = materialise(read_headers(spark, root, scan_csv_tree(spark, root), required, records), "headers")
    rows = materialise(read_csv_groups(records, headers, null_tokens), "rows")
    return add_lineage(rows, classify_files(rows, headers), batch_id)


def load_csv_tree(
    spark: SparkSession,
    root: str,
    path: str,
    batch_id: str,
    required: Sequence[str] = (),
    null_tokens: Sequence[str] = config.NULL_TOKENS,
    multi_line: bool = True,
    columns: Sequence[str] = (),
) -> dict:
    """Append a whole tree to the bronze table at `path`, whose `columns` come first, and
    return the load's statistics: files processed and skipped, rows loaded.

    Rows are observed as they are written, and the classifier counts them by file as it
    looks for positions: no pass over the table is needed to know what came in.
    """
    files = materialise(scan_csv_tree(spark, root), "files")
    records = stage_records(spark, root, multi_line)
    headers = materialise(read_headers(spark, root, files, required, records), "headers")
    rows = materialise(read_csv_groups(records, headers, null_tokens), "rows")
    types = materialise(classify_files(rows, headers), "types")
    seen = Observation(f"load {batch_id}")
    bronze = align_schema(add_lineage(rows, types, batch_id), columns)
    append_bronze(bronze.observe(seen, F.count(F.lit(1)).alias("loaded")), path)
    processed = types.where("rows > 0").count()
    return {"batch": batch_id, "processed": processed, "skipped": files.count() - processed, "loaded": seen.get["loaded"]}


def load_stats(bronze: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Files and rows loaded per batch; with `files`, also how many were skipped."""
    stats = bronze.groupBy("_BATCH_ID").agg(
        F.countDistinct("_SOURCE_FILE").alias("processed"), F.count(F.lit(1)).alias("loaded")
    )
    if files is None:
        return stats
    listed = files.agg(F.count(F.lit(1))).scalar()
    return stats.withColumn("skipped", listed - F.col("processed"))
