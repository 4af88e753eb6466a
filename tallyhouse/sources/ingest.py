"""Raw files into bronze: discovery, headers, contracts, batch and incremental loads."""

from __future__ import annotations

import csv
import io
import re
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tallyhouse.config import CONTRACTS, Contract
from tallyhouse.operators.harmonize import sanitize_columns

FILES_PER_TRIGGER = 1000


def discover(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Files below a folder: ``path, file_name, length``. Contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return found.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"), "length")


def with_lineage(df: DataFrame) -> DataFrame:
    """Add the file a row came from and the time it was loaded."""
    return df.withColumns({"_source_file": F.col("_metadata.file_path"), "_load_timestamp": F.current_timestamp()})


# --- headers ----------------------------------------------------------------------------------

#: Lines that a header with line breaks inside quotes may have.
HEADER_LINES = 16


def _uri(path: Column) -> Column:
    """One spelling of a path that Spark's readers give in several: decoded, with one slash after the scheme."""
    return F.regexp_replace(F.url_decode(F.regexp_replace(path, r"\+", "%2B")), r"^([A-Za-z][\w+.-]*):/+", "$1:/")


def _text(spark: SparkSession, paths: str | list[str], glob: str | None, whole: bool = False) -> DataFrame:
    """Lines (or whole files) below the paths, with ``path`` and the place ``at`` where the piece of the file begins."""
    found = spark.read.text(paths, wholetext=whole, recursiveFileLookup=True, pathGlobFilter=glob)
    return found.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"))


def _named(headers: DataFrame) -> DataFrame:
    return headers.select("path", F.url_decode(F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\+", "%2B")).alias("file_name"), "columns")


def _first_record(text: pd.Series) -> pd.Series:
    """The cells of the first CSV record of each text."""
    return text.map(lambda t: next(csv.reader(io.StringIO(t.removeprefix("\ufeff"), newline="")), []))


def csv_headers(spark: SparkSession, paths: str | list[str], glob: str | None = None) -> DataFrame:
    """``path, file_name, columns`` of every CSV file that has a line, on any store that Spark reads (which lists no empty files).

    Spark's text reader reads the files; of each only the lines of its first piece are kept, and of these the first ones.
    Tasks number their lines and drop all but ``HEADER_LINES`` of a file before anything is moved.
    """
    lines = _text(spark, paths, glob).where("at = 0").withColumn("n", F.monotonically_increasing_id())
    first = lines.withColumn("nth", F.row_number().over(Window.partitionBy("path").orderBy("n"))).where(F.col("nth") <= HEADER_LINES)
    heads = first.groupBy("path").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("nth", "value"))), lambda x: x["value"]), "\n").alias("head"))
    return _named(heads.select("path", F.pandas_udf(_first_record, "array<string>")("head").alias("columns")))


def _records(spark: SparkSession, paths: str | list[str], glob: str | None, multi_line: bool) -> DataFrame:
    """JSON records as VARIANT ``v`` and, of objects, as a map ``all``; both are NULL for text that is no JSON."""
    texts = _text(spark, paths, glob, multi_line).where(F.trim("value") != "").withColumn("v", F.try_parse_json("value"))
    if multi_line:
        texts = texts.withColumn("v", F.explode(F.coalesce(F.try_variant_get("v", "$", "array<variant>"), F.array("v"))))
    return texts.withColumn("all", F.try_variant_get("v", "$", "map<string,variant>"))


def json_headers(spark: SparkSession, paths: str | list[str], glob: str | None = None, multi_line: bool = False) -> DataFrame:
    """``path, file_name, columns`` of every JSON file: the names of all fields that any of its records has, sorted.

    Files have one record per line, or hold one record or an array of records (``multi_line``). A broken record has no names.
    """
    records = _records(spark, paths, glob, multi_line)
    names = records.select("path", F.explode_outer(F.map_keys("all")).alias("name")).distinct()
    return _named(names.groupBy("path").agg(F.sort_array(F.collect_set("name")).alias("columns")))


def contract_check(headers: DataFrame, contracts: tuple[Contract, ...] = CONTRACTS, run_id: str | None = None, run_at: Column | None = None) -> DataFrame:
    """Check the columns of every file against the contract of its entity.

    The entity is the first one whose name occurs in the file's path. Expects ``path,
    file_name, columns``; files of no entity are left out. Every row carries the id and time of the run.
    """
    texts = lambda values: F.array(*[F.lit(v) for v in values]).cast("array<string>")
    listed = F.array(*[
        F.struct(F.lit(c.entity).alias("entity"), texts(c.key_variants).alias("key_variants"), texts(c.required).alias("required"), F.lit(c.min_cols).alias("min_cols"))
        for c in contracts
    ])
    names = F.transform("columns", lambda c: F.lower(c))
    spotted = headers.withColumns({
        "names": names,
        "c": F.get(F.filter(listed, lambda c: F.lower("path").contains(c["entity"])), F.lit(0)),
    }).where("c IS NOT NULL")
    n = F.size("names")
    key_ok, min_ok = F.arrays_overlap("names", "c.key_variants"), n >= F.col("c.min_cols")
    gone = F.array_except("c.required", "names")
    req_ok = F.size(gone) == 0
    verdict = lambda ok: F.when(ok, "PASS").otherwise("WARN")
    issues = F.concat_ws(
        "; ",
        F.when(~min_ok, F.concat(F.lit("too narrow: "), n, F.lit(" of at least "), F.col("c.min_cols"), F.lit(" columns"))),
        F.when(~key_ok, F.concat(F.lit("no key among "), F.array_join("c.key_variants", ", "))),
        F.when(~req_ok, F.concat(F.lit("absent: "), F.array_join(gone, ", "))),
    )
    return spotted.select(
        "file_name", "c.entity", F.col("path").alias("file_path"), verdict(min_ok & key_ok & req_ok).alias("status"),
        n.alias("data_columns"), F.array_join(F.sort_array("names"), ", ").alias("columns_found"),
        verdict(key_ok).alias("key_check"), verdict(req_ok).alias("required_check"), verdict(min_ok).alias("min_columns_check"),
        F.when(issues == "", "None").otherwise(issues).alias("issues"),
        F.lit(run_id or uuid.uuid4().hex).alias("run_id"), (F.current_timestamp() if run_at is None else run_at).alias("checked_at"),
    )


def drift_report(headers: DataFrame, expected: list[str]) -> DataFrame:
    """Columns every file adds to, or lacks from, an expected layout."""
    want = F.array(*[F.lit(c) for c in expected])
    have = F.transform("columns", lambda c: F.lower(c))
    return headers.select(
        "file_name", F.array_join(F.sort_array(F.array_except(have, want)), ", ").alias("added_columns"),
        F.array_join(F.sort_array(F.array_except(want, have)), ", ").alias("missing_columns"),
        F.when((F.size(F.array_except(have, want)) == 0) & (F.size(F.array_except(want, have)) == 0), "SAME").otherwise("DRIFT").alias("status"))


# --- batch loads ------------------------------------------------------------------------------


def read_csv_files(headers: DataFrame, broken: str | None = None) -> DataFrame:
    """Read CSV files of differing layouts by column name.

    One reader maps columns by position, so files are read per distinct header and then
    combined by name; every column is text. What reaches the driver is the list of files, which Spark's file index
    holds there anyway. With ``broken``, a column of that name has the text of lines that do not fit their file's header.
    """
    spark = headers.sparkSession
    layouts: dict[tuple[str, ...], list[str]] = {}
    for path, columns in headers.where(F.size("columns") > 0).select(_uri(F.col("path")), "columns").collect():
        layouts.setdefault(tuple(columns), []).append(path)
    out = None
    for columns, paths in sorted(layouts.items()):
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, *([broken] if broken else [])]])
        reader = spark.read.schema(schema).option("header", "true").option("enforceSchema", "true")
        part = sanitize_columns(with_lineage((reader.option("columnNameOfCorruptRecord", broken) if broken else reader).csv(paths)))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise FileNotFoundError("no files to read")
    return out


def ingest_csv(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    return read_csv_files(csv_headers(spark, path, glob))


def ingest_json(spark: SparkSession, path: str, glob: str = "*.json", schema: T.StructType | str | None = None, multi_line: bool = True) -> DataFrame:
    """JSON files; fields meet by name, types are inferred unless given."""
    reader = spark.read.option("multiLine", str(multi_line).lower()).option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    return sanitize_columns(with_lineage((reader.schema(schema) if schema else reader).json(path)))


def _plain(path: str) -> str:
    """A path without scheme, with one leading slash."""
    return "/" + re.sub(r"^[A-Za-z][\w+.-]*:", "", path).strip("/")


def load_folder(spark: SparkSession, path: str, database: str | None = None, multi_line: bool = True) -> dict[str, DataFrame]:
    """One frame per file or folder directly below a folder, by name without extension; saved as tables on request.

    CSV files of an entry meet by column name, whatever the order of their columns; JSON files of the same entry join
    them by name. Other files are left out.
    """
    inner = F.element_at(F.split(F.regexp_replace("path", r"^[A-Za-z][\w+.-]*:/*", "/"), re.escape(_plain(path) + "/"), 2), -1)
    entry = F.regexp_replace(F.substring_index(inner, "/", 1), r"\.(csv|json)$", "")
    files = discover(spark, path).withColumns({"entry": entry, "kind": F.regexp_extract("path", r"\.(csv|json)$", 1)}).where("kind <> ''")
    found: dict[str, dict[str, DataFrame]] = {}
    for name, kind in sorted(tuple(r) for r in files.select("entry", "kind").distinct().collect()):
        own = [r["path"] for r in files.where((F.col("entry") == name) & (F.col("kind") == kind)).select("path").collect()]
        if kind == "csv":
            frame = read_csv_files(csv_headers(spark, own)).drop("source_file", "load_timestamp")
        else:
            frame = spark.read.option("multiLine", str(multi_line).lower()).json(own)
        found.setdefault(name, {})[kind] = frame
    frames = {}
    for name, kinds in found.items():
        frames[name] = next(iter(kinds.values())) if len(kinds) == 1 else kinds["csv"].unionByName(kinds["json"], allowMissingColumns=True)
        if database:
            frames[name].write.mode("overwrite").saveAsTable(f"{database}.{name}")
    return frames


def rescue(df: DataFrame, known: list[str], out: str = "_rescued_data") -> DataFrame:
    """Keep unknown columns as one JSON text; NULL when a row has none of them."""
    kept = [c for c in df.columns if c in known]
    unknown = [c for c in df.columns if c not in known]
    if not unknown:
        return df.select(*kept, F.lit(None).cast("string").alias(out))
    filled = F.coalesce(*[F.col(f"`{c}`").cast("string") for c in unknown]).isNotNull()
    return df.select(*kept, F.when(filled, F.to_json(F.struct(*[F.col(f"`{c}`") for c in unknown]))).alias(out))


def read_csv_rescued(spark: SparkSession, path: str, schema: T.StructType | str, glob: str = "*.csv", out: str = "_rescued_data") -> DataFrame:
    """CSV files of differing layouts with the columns and types of ``schema``; whatever does not fit is kept.

    ``out`` is a JSON object of the texts that have no place: columns that the schema does not name, and values that
    are not of their column's type (which is NULL then). Of a line with more or fewer cells than its file's header, it is
    ``{"_line": text}`` and all columns are NULL. It is NULL for a row without loss. Column names are compared in lower case.
    """
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    rows = read_csv_files(csv_headers(spark, path, glob), "_line")
    texts = {c.lower(): F.col(f"`{c}`") for c in rows.columns if c not in (LINE, "source_file", "load_timestamp")}
    whole = F.col(LINE).isNull()
    typed, kept = [], []
    for f in fields:
        text = texts.pop(f.name.lower(), F.lit(None).cast("string"))
        value = text.try_cast(f.dataType)
        typed.append(F.when(whole, value).alias(f.name))
        kept += [F.lit(f.name), F.when(whole & value.isNull(), text)]
    for name, text in texts.items():
        kept += [F.lit(name), F.when(whole, text)]
    lost = F.map_filter(F.create_map(*kept, F.lit("_line"), F.col(LINE)), lambda _, v: v.isNotNull())
    return rows.select(*typed, F.when(F.size(lost) > 0, F.to_json(lost)).alias(out), "source_file", "load_timestamp")


#: The column of a broken line, after column names were put in order.
LINE = "line"


def read_json_rescued(spark: SparkSession, path: str, schema: T.StructType | str, glob: str = "*.json", multi_line: bool = False, out: str = "_rescued_data") -> DataFrame:
    """JSON records with the columns and types of ``schema``; whatever does not fit is kept, as in ``read_csv_rescued``.

    Records are parsed to VARIANT. ``out`` keeps unknown fields and values of the wrong type as they are, with nested
    parts; of text that is no JSON object it is ``{"_line": text}``. A JSON null is NULL and no loss. Field names are
    compared as they are. Blank lines are no records.
    """
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    parsed = _records(spark, path, glob, multi_line)
    typed = {f.name: F.try_variant_get(F.try_element_at("all", F.lit(f.name)), "$", f.dataType.simpleString()) for f in fields}
    names = F.array(*[F.lit(n) for n in typed]).cast("array<string>")
    filled = F.array_compact(F.array(*[F.when(value.isNotNull(), F.lit(n)) for n, value in typed.items()])).cast("array<string>")
    lost = F.map_filter("all", lambda name, value: ~F.array_contains(names, name) | (~F.array_contains(filled, name) & ~F.is_variant_null(value)))
    line = F.to_json(F.create_map(F.lit("_line"), F.coalesce(F.to_json("v"), "value")))
    kept = F.when(F.col("all").isNull(), line).when(F.size(lost) > 0, F.to_json(lost))
    return parsed.select(*[v.alias(n) for n, v in typed.items()], kept.alias(out), F.col("path").alias("source_file"), F.current_timestamp().alias("load_timestamp"))


# --- incremental loads -------------------------------------------------------------------------


def _new_files(spark: SparkSession, path: str, glob: str, files_per_trigger: int) -> DataFrame:
    """A stream of the paths of new files; contents are not read."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
    return files.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_trigger).load(path).select("path")


def ingest_csv_stream(spark: SparkSession, path: str, target: str, checkpoint: str, glob: str = "*.csv", files_per_trigger: int = FILES_PER_TRIGGER) -> None:
    """Load files that have not been loaded before, whatever their layout, and stop.

    The stream tracks file names only; each batch reads its new files per header. A batch that
    is repeated after a failure overwrites its own folder, so nothing is loaded twice. Columns
    that turn up later simply appear in the later files of the table.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            paths = [r["path"] for r in batch.collect()]  # at most files_per_trigger
            read_csv_files(csv_headers(spark, paths)).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    _new_files(spark, path, glob, files_per_trigger).writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def ingest_json_stream(
    spark: SparkSession, path: str, target: str, checkpoint: str, schema: T.StructType | str | None = None, glob: str = "*.json", multi_line: bool = True,
    files_per_trigger: int = FILES_PER_TRIGGER,
) -> None:
    """Load JSON files that have not been loaded before, whatever their fields, and stop.

    Fields of ``schema`` have its types; all other fields that a batch's files hold are kept too, single values as text, so
    that batches agree. As with CSV, a repeated batch overwrites its own folder.
    """
    given = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema or T.StructType()

    def load(batch: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in batch.collect()]  # at most files_per_trigger
        if not paths:
            return
        reader = spark.read.option("multiLine", str(multi_line).lower()).option("primitivesAsString", "true")
        more = [f for f in reader.json(paths).schema if f.name not in given.names]
        rows = reader.schema(T.StructType([*given, *more])).json(paths)
        sanitize_columns(with_lineage(rows)).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    _new_files(spark, path, glob, files_per_trigger).writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def read_table(spark: SparkSession, name: str, stream: bool = False) -> DataFrame:
    return spark.readStream.table(name) if stream else spark.table(name)


def read_bronze(spark: SparkSession, target: str) -> DataFrame:
    """Everything loaded so far, with the columns of all batches."""
    return spark.read.option("mergeSchema", "true").parquet(target).drop("batch")


def file_label(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)
