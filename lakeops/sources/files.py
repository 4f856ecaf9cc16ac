"""Incremental file sources: CSV, JSON lines, Parquet and binary files.

All are file streams over a folder and the folders in it; the checkpoint of the query that
reads them records the files seen. Data that does not fit the schema is kept in
`_rescued_data` as a JSON object of texts, so a bad field never fails a file.
"""

import json
import re
from collections.abc import Callable, Iterator, Mapping
from functools import reduce
from itertools import islice
from operator import add, and_, or_

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.streaming.ingest import drain_batches

RESCUED = "_rescued_data"
BAD_LINE = "_corrupt_record"
METADATA = ("_ingested_filename", "_ingestion_time")
# Fixed value: the columns of Spark's binary file source.
BINARY_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def _folder(reader, options: Mapping[str, str] | None):
    """A reader or a stream reader of all files below a folder."""
    return reader.options(**(options or {})).option("recursiveFileLookup", True)


def infer_schema(
    spark: SparkSession, path: str, fmt: str, options: Mapping[str, str] | None = None
) -> T.StructType:
    """Schema of a folder, in one distributed pass over all files that its stream will read."""
    reader = _folder(spark.read.format(fmt), options)
    option = "mergeSchema" if fmt == "parquet" else "inferSchema"
    try:
        schema = reader.option(option, True).load(path).schema
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        schema = T.StructType()
    except (PySparkException, Py4JJavaError) as e:
        if fmt != "parquet" or not _types_differ(e):
            raise
        schema = _common_schema(spark, path, options or {})
    fields = [f for f in schema if f.name != BAD_LINE]
    if not fields:
        raise ValueError(f"no files to infer a schema from in {path}")
    return T.StructType(fields)


def _types_differ(e: Exception) -> bool:
    """Whether footers of Parquet files could not be merged; only the message tells it."""
    return "CANNOT_MERGE" in str(e)


def _common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """A type that values of both fit: a wider number, or text."""
    whole, number = T.IntegralType, (T.IntegralType, T.FloatType, T.DoubleType)
    if a == b:
        return a
    if isinstance(a, whole) and isinstance(b, whole):
        return T.LongType()
    if isinstance(a, number) and isinstance(b, number):
        return T.DoubleType()
    return T.StringType()


def _common_schema(spark: SparkSession, path: str, options: Mapping[str, str]) -> T.StructType:
    """All columns of a folder's Parquet files, whose types may differ."""
    names = _listed(spark, path, options).toLocalIterator()
    fields: dict[str, T.StructField] = {}
    while some := [r.path for r in islice(names, AT_ONCE)]:
        for _, schema in _alike(spark, some):
            for f in schema:
                before = fields.setdefault(f.name.lower(), f)
                dtype = _common_type(before.dataType, f.dataType)
                fields[f.name.lower()] = T.StructField(before.name, dtype)
    return T.StructType(list(fields.values()))


def _agree(a: T.StructType, b: T.StructType) -> bool:
    """Whether columns of one name have one type."""
    types = {f.name.lower(): f.dataType for f in a}
    return all(types.get(f.name.lower(), f.dataType) == f.dataType for f in b)


def _with_new(a: T.StructType, b: T.StructType) -> T.StructType:
    names = {f.name.lower() for f in a}
    return T.StructType([*a, *[f for f in b if f.name.lower() not in names]])


def _alike(spark: SparkSession, names: list[str]) -> list[tuple[list[str], T.StructType]]:
    """Parquet files in groups that agree in types, with their columns.

    Footers are merged in a distributed job; files that do not agree are halved.
    """
    try:
        return [(names, spark.read.option("mergeSchema", True).parquet(*names).schema)]
    except (PySparkException, Py4JJavaError) as e:
        if len(names) == 1 or not _types_differ(e):
            raise
    half = len(names) // 2
    groups: list[tuple[list[str], T.StructType]] = []
    for some, schema in _alike(spark, names[:half]) + _alike(spark, names[half:]):
        at = next((i for i, (_, known) in enumerate(groups) if _agree(known, schema)), None)
        if at is None:
            groups.append((some, schema))
        else:
            groups[at] = (groups[at][0] + some, _with_new(groups[at][1], schema))
    return groups


def with_hints(schema: T.StructType, hints: str | None) -> T.StructType:
    """The schema with the hinted columns replaced, or added where they are missing."""
    hinted = {f.name.lower(): f for f in T.StructType.fromDDL(hints)} if hints else {}
    kept = [
        T.StructField(f.name, hinted.pop(f.name.lower(), f).dataType, True) for f in schema
    ]
    fields = [*kept, *hinted.values()]
    return T.StructType(
        [
            T.StructField(f.name, T.StringType() if f.dataType == T.NullType() else f.dataType)
            for f in fields
        ]
    )


# Mark of a column that only the hints name.
HINTED_ONLY = "hinted_only"


def _marked(schema: T.StructType, inferred: T.StructType) -> T.StructType:
    """The schema with a mark on the columns that were not inferred."""
    there = {f.name.lower() for f in inferred}
    marks = [{} if f.name.lower() in there else {HINTED_ONLY: True} for f in schema]
    return T.StructType([T.StructField(f.name, f.dataType, True, m) for f, m in zip(schema, marks)])


def load_schema(spark: SparkSession, location: str) -> T.StructType | None:
    """The schema kept at a location, if any."""
    try:
        row = spark.read.text(location, wholetext=True).first()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return T.StructType.fromJson(json.loads(row.value)) if row else None


def save_schema(spark: SparkSession, schema: T.StructType, location: str) -> None:
    row = spark.range(1).select(F.lit(schema.json()).alias("value"))
    row.write.mode("overwrite").text(location)


def resolve_schema(
    spark: SparkSession,
    path: str,
    fmt: str,
    location: str,
    options: Mapping[str, str] | None = None,
    hints: str | None = None,
) -> T.StructType:
    """Infer once, overlay the hints, keep the result and use it on later runs.

    Columns of CSV files go by their place, so those that only the hints name are marked.
    """
    schema = load_schema(spark, location)
    if schema is None:
        inferred = infer_schema(spark, path, fmt, options)
        schema = with_hints(inferred, hints)
        if fmt == "csv":
            schema = _marked(schema, inferred)
        save_schema(spark, schema, location)
    return schema


_COMPLEX = (T.ArrayType, T.MapType, T.StructType)
_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)


# Options of the readers by which texts become dates and times.
FORMATS = ("dateFormat", "timestampFormat", "timestampNTZFormat", "locale", "timeZone")


def _formats(options: Mapping[str, str] | None) -> dict[str, str]:
    wanted = {f.lower(): f for f in FORMATS}
    return {wanted[k.lower()]: v for k, v in (options or {}).items() if k.lower() in wanted}


def _typed(raw: Column, dtype: T.DataType, formats: Mapping[str, str] | None = None) -> Column:
    """A text as the given type, null where it does not fit."""
    formats = formats or {}
    if isinstance(dtype, T.StringType):
        return raw
    if isinstance(dtype, _COMPLEX):
        return F.from_json(raw, dtype, dict(formats))
    if isinstance(dtype, T.DateType) and "dateFormat" in formats:
        return F.try_to_timestamp(raw, F.lit(formats["dateFormat"])).cast(dtype)
    if isinstance(dtype, T.TimestampType) and "timestampFormat" in formats:
        return F.try_to_timestamp(raw, F.lit(formats["timestampFormat"]))
    if isinstance(dtype, T.TimestampNTZType) and "timestampNTZFormat" in formats:
        return F.try_to_timestamp(raw, F.lit(formats["timestampNTZFormat"])).cast(dtype)
    return raw.try_cast(dtype)


def _has_fields(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _has_fields(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return _has_fields(dtype.valueType)
    return isinstance(dtype, T.StructType)


def _fits(raw: Column, dtype: T.DataType, formats: Mapping[str, str]) -> Column:
    """Whether a text holds nothing but what the type has a place for, at any depth."""

    def each(items: Column, inner: T.DataType) -> Column:
        every = F.forall(items, lambda x: x.isNull() | _fits(x, inner, formats))
        return items.isNotNull() & every

    if isinstance(dtype, T.ArrayType):
        return each(F.from_json(raw, "array<string>"), dtype.elementType)
    texts = F.from_json(raw, "map<string,string>")
    if isinstance(dtype, T.MapType):
        return each(F.map_values(texts), dtype.valueType)
    if isinstance(dtype, T.StructType):
        known = F.array(*[F.lit(f.name) for f in dtype])
        inside = [
            texts.getItem(f.name).isNull() | _fits(texts.getItem(f.name), f.dataType, formats)
            for f in dtype
        ]
        no_more = F.size(F.array_except(F.map_keys(texts), known)) == 0
        return F.coalesce(reduce(and_, inside, no_more), F.lit(False))
    return F.coalesce(_typed(raw, dtype, formats).isNotNull(), F.lit(False))


def _present(entries: Mapping[str, Column]) -> Column:
    """Map of the texts that are not null."""
    pairs = [F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in entries.items()]
    if not pairs:
        return F.create_map().cast("map<string,string>")
    return F.map_from_entries(F.filter(F.array(*pairs), lambda e: e["value"].isNotNull()))


def _any(conditions: list[Column]) -> Column:
    return reduce(or_, conditions, F.lit(False))


def rescue_json(
    df: DataFrame,
    schema: T.StructType,
    value: str = "value",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Parse a column of JSON texts; replaces it by the fields and `_rescued_data`.

    A text that fits is parsed by its types, and its keys are looked over. Only one that does
    not, that has fields the schema does not know, or that has nested fields, is parsed again
    as a map of texts. A nested field that fits in part keeps that part, and its whole text is
    rescued.
    """
    line, formats = F.col(value), _formats(options)
    known = F.array(*[F.lit(f.name) for f in schema])
    with_bad = T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())])
    parsed = df.withColumn(
        "__typed", F.from_json(line, with_bad, {**formats, "columnNameOfCorruptRecord": BAD_LINE})
    )
    bad = F.col("__typed").getField(BAD_LINE).isNotNull()
    unknown = F.size(F.array_except(F.json_object_keys(line), known)) > 0
    nested = _any([F.col("__typed").getField(f.name).isNotNull() for f in schema if _has_fields(f.dataType)])
    texts = parsed.withColumn(
        "__texts", F.when(bad | unknown | nested, F.from_json(line, "map<string,string>"))
    )

    text = {f.name: F.col("__texts").getItem(f.name) for f in schema}
    refitted = {f.name: _typed(text[f.name], f.dataType, formats) for f in schema}
    new = F.map_filter("__texts", lambda k, v: ~F.array_contains(known, k) & v.isNotNull())

    def misfit(f: T.StructField) -> Column:
        if _has_fields(f.dataType):
            return ~_fits(text[f.name], f.dataType, formats)
        return refitted[f.name].isNull()

    misfits = _present(
        {
            f.name: F.when(text[f.name].isNotNull() & misfit(f), text[f.name])
            for f in schema
            if not isinstance(f.dataType, T.StringType)
        }
    )
    # A column of its own: it is used twice below and costly to build.
    kept = texts.withColumn("__kept", F.when(F.col("__texts").isNotNull(), F.map_concat(new, misfits)))
    rescued = (
        F.when(F.col("__texts").isNotNull(), F.when(F.size("__kept") > 0, F.to_json("__kept")))
        .when(bad, F.to_json(F.create_map(F.lit(BAD_LINE), line)))
    )
    others = [c for c in df.columns if c != value]
    return kept.select(
        *[
            F.when(bad, refitted[f.name])
            .otherwise(F.col("__typed").getField(f.name))
            .alias(f.name)
            for f in schema
        ],
        rescued.alias(RESCUED),
        *others,
    )


def _same_type(df: DataFrame, f: T.StructField) -> bool:
    return df.schema[f.name].dataType.simpleString() == f.dataType.simpleString()


def _cast(df: DataFrame, f: T.StructField, formats: Mapping[str, str]) -> Column:
    """A stored column as the type of the schema, null where it does not fit."""
    column, stored = F.col(f.name), df.schema[f.name].dataType
    if _same_type(df, f):
        return column
    alike = any(
        isinstance(stored, family) and isinstance(f.dataType, family)
        for family in (T.NumericType, _TIMES)
    )
    return column.try_cast(f.dataType) if alike else _typed(_text(df, f.name), f.dataType, formats)


def _text(df: DataFrame, name: str) -> Column:
    complex_type = isinstance(df.schema[name].dataType, _COMPLEX)
    return F.to_json(name) if complex_type else F.col(name).cast("string")


def rescue_texts(
    df: DataFrame,
    schema: T.StructType,
    bad_line: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Cast columns to the schema; adds `_rescued_data`.

    Columns that the schema does not know are rescued whole. `bad_line` names a column
    with the text of lines that have more or fewer fields than the schema.
    """
    known, formats = {f.name for f in schema}, _formats(options)
    meta = [c for c in df.columns if c in METADATA]
    extra = [c for c in df.columns if c not in {*known, *meta, bad_line}]
    stored = [f for f in schema if f.name in df.columns]

    misfit = {
        f.name: F.col(f.name).isNotNull() & _cast(df, f, formats).isNull()
        for f in stored
        if not _same_type(df, f)
    }
    kept = {name: F.when(m, _text(df, name)) for name, m in misfit.items()}
    kept |= {c: _text(df, c) for c in extra}
    if bad_line:
        kept[BAD_LINE] = F.col(bad_line)
    aside = [F.col(c).isNotNull() for c in (*extra, *([bad_line] if bad_line else []))]
    return df.select(
        *[
            (_cast(df, f, formats) if f in stored else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema
        ],
        F.when(_any([*misfit.values(), *aside]), F.to_json(_present(kept))).alias(RESCUED),
        *meta,
    )


def _with_file(df: DataFrame) -> DataFrame:
    values = (F.col("_metadata.file_path"), F.current_timestamp())
    return df.withColumns(dict(zip(METADATA, values)))


def _other_order(header: Column, names: list[str]) -> Column:
    """Whether a header, an array of names, has the columns in another order: at least half of
    the column names, and two, stand elsewhere in it."""
    lower = [n.lower() for n in names]
    named = [n for n in lower if not re.fullmatch(r"_c\d+", n)]
    texts = [F.lower(F.get(header, F.lit(i))) for i in range(len(names))]
    in_order = ~_any([F.coalesce(t != n, F.lit(False)) for t, n in zip(texts, lower)])
    elsewhere = reduce(add, [F.when(t.isin(named), 1).otherwise(0) for t in texts])
    return ~in_order & (elsewhere >= max(2, (len(named) + 1) // 2))


# Files whose footers or headers are read at once.
AT_ONCE = 1000


def _listed(spark: SparkSession, path: str, options: Mapping[str, str]) -> DataFrame:
    """Path and time of the files below a folder that are not empty."""
    glob = {k: v for k, v in options.items() if k.lower() == "pathglobfilter"}
    there = _folder(spark.read.format("binaryFile"), glob).load(path)
    return there.filter("length > 0").select("path", "modificationTime")


def new_files(
    spark: SparkSession, path: str, options: Mapping[str, str], location: str, at_once: int = AT_ONCE
) -> Iterator[list[str]]:
    """Names of the files that the record at `location` does not have, some at a time.

    They are recorded when the next ones are asked for, or at the end.
    """
    there = _listed(spark, path, options)
    try:
        there = there.join(spark.read.parquet(location), ["path", "modificationTime"], "left_anti")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    new = there.toLocalIterator()
    while some := list(islice(new, at_once)):
        yield [r.path for r in some]
        spark.createDataFrame(some, there.schema).coalesce(1).write.mode("append").parquet(location)


def _literal(path: str) -> str:
    """A path for a reader that takes patterns."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


# Files up to this size are read as a whole for their first line.
SMALL_FILE = 1 << 20
# Files of which each has a scan of its own in one job.
SCANS_AT_ONCE = 100


def first_lines(spark: SparkSession, paths: list[str]) -> Iterator[DataFrame]:
    """`file` and its first `line`, whatever it says, some files at a time.

    Small files are read together. Of a larger one a scan with a limit takes one row and stops,
    so what is read of it is a buffer, however large it is.
    """
    session = spark.newSession()
    for key in ("maxPartitionBytes", "openCostInBytes"):
        session.conf.set(f"spark.sql.files.{key}", str(1 << 60))
    literal = [_literal(p) for p in paths]
    sizes = spark.read.format("binaryFile").load(literal).select("path", "length").collect()
    columns = (F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    small = [_literal(r.path) for r in sizes if r.length <= SMALL_FILE]
    if small:
        lines = spark.read.text(small).select(*columns, F.col("_metadata.file_block_start").alias("block"))
        lines = lines.withColumn("place", F.monotonically_increasing_id()).filter("block = 0")
        yield lines.groupBy("file").agg(F.min_by("line", "place").alias("line"))
    large = iter(r.path for r in sizes if r.length > SMALL_FILE)
    while some := list(islice(large, SCANS_AT_ONCE)):
        yield reduce(
            DataFrame.unionAll, [session.read.text(_literal(p)).select(*columns).limit(1) for p in some]
        )


def file_in_other_order(
    spark: SparkSession, paths: list[str], names: list[str], options: Mapping[str, str]
) -> str | None:
    """A file, if any, whose header has the columns in another order."""
    csv = {k: v for k, v in options.items() if k.lower() in ("sep", "delimiter", "quote", "escape")}
    fields = F.from_csv("line", ", ".join(f"c{i} string" for i in range(len(names))), csv)
    header = F.array(*[fields.getField(f"c{i}") for i in range(len(names))])
    for lines in first_lines(spark, paths):
        wrong = lines.filter(_other_order(header, names)).select("file").first()
        if wrong:
            return wrong.file
    return None


def check_headers(
    spark: SparkSession, path: str, names: list[str], options: Mapping[str, str], location: str
) -> None:
    """Stop if a file that came since the last check has its columns in another order."""
    for some in new_files(spark, path, options, location):
        wrong = file_in_other_order(spark, some, names, options)
        if wrong:
            raise ValueError(f"columns in another order than the schema: {wrong}")


def stored_schema(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    options: Mapping[str, str],
    location: str,
) -> tuple[T.StructType, list[str]]:
    """The columns that Parquet files have, from the footers of those that came since last time,
    and the names of the files that have other types.

    What was found before is kept at `location`. Files with other types are read by their own
    and written to `{location}_cast` as the stream hands them on, one folder for each, which a
    run that was cut off replaces. The list of them grows with such files alone.
    """
    found, names = load_schema(spark, location) or T.StructType(), f"{location}_other"
    for some in new_files(spark, path, options, f"{location}_files"):
        for group, own in sorted(_alike(spark, some), key=lambda g: -len(g[0])):
            if _agree(found, own):
                found = _with_new(found, own)
                save_schema(spark, found, location)
                continue
            rows, file = spark.read.schema(own).parquet(*group), F.col("_metadata.file_path")
            rows.select(file.alias("file")).distinct().write.mode("append").parquet(names)
            rows = rescue_texts(rows.withColumn(METADATA[0], file), schema, options=options)
            rows = rows.withColumn("file", F.sha2(METADATA[0], 256))
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                "file"
            ).parquet(f"{location}_cast")
    try:
        other = [r.file for r in spark.read.parquet(names).distinct().collect()]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        other = []
    return found, other


def _has_fields_of(n: int, options: Mapping[str, str]) -> Column:
    """Whether a line that does not fit the reader's schema has just `n` fields."""
    csv = {k: v for k, v in options.items() if k.lower() not in ("header", "mode")}
    csv |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE}
    ddl = ", ".join([*(f"c{i} string" for i in range(n)), f"{BAD_LINE} string"])
    return F.from_csv(BAD_LINE, ddl, csv).getField(BAD_LINE).isNull()


def _csv_rows(reader, path: str | list[str], schema: T.StructType, options: Mapping[str, str]):
    """Lines of CSV files as the schema has them. Columns that only the hints name come last, and
    a line that ends before them is whole: files need not have them."""
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    lines = _with_file(
        _folder(reader.format("csv"), options)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_LINE)
        .schema(texts.add(BAD_LINE, T.StringType()))
        .load(path)
    )
    own = [f for f in schema if HINTED_ONLY not in f.metadata]
    if len(own) < len(schema.fields):
        bad = F.col(BAD_LINE)
        lines = lines.withColumn(BAD_LINE, F.when(bad.isNotNull() & ~_has_fields_of(len(own), options), bad))
    return rescue_texts(lines, schema, BAD_LINE, options)


def stream_csv(
    spark: SparkSession, path: str, schema: T.StructType, options: Mapping[str, str]
) -> DataFrame:
    """CSV lines by the position of their fields, as the header of the inferred schema has them.

    With the option `header`, the first line of every file is dropped by its place, and
    `check_headers` tells whether it has the columns in the order of the schema.
    """
    return _csv_rows(spark.readStream, path, schema, options)


def stream_json(
    spark: SparkSession, path: str, schema: T.StructType, options: Mapping[str, str]
) -> DataFrame:
    lines = _folder(spark.readStream.format("text"), options).load(path)
    return rescue_json(_with_file(lines.filter(F.trim("value") != "")), schema, options=options)


def stream_parquet(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    options: Mapping[str, str],
    location: str,
) -> DataFrame:
    """Parquet files as they are stored, then cast to the schema.

    Columns that came after the schema was kept are rescued too. `location` is where the
    stored columns are kept, so that footers are read once, and the rows of files whose types
    differ from those of the first ones; these files are left out where they are.
    """
    cast = T.StructType(
        [*schema, T.StructField(RESCUED, T.StringType()), T.StructField(METADATA[0], T.StringType())]
    )
    spark.createDataFrame([], cast).write.mode("ignore").parquet(f"{location}_cast")
    stored, other = stored_schema(spark, path, schema, options, location)
    rows = _folder(spark.readStream.format("parquet"), options).schema(stored).load(path)
    if other:
        rows = rows.filter(~F.col("_metadata.file_path").isin(other))
    rows = rescue_texts(_with_file(rows), schema, options=options)
    limit = {k: v for k, v in options.items() if k.lower() == "maxfilespertrigger"}
    more = _folder(spark.readStream.format("parquet"), limit).schema(cast).load(f"{location}_cast")
    return rows.unionByName(more.withColumn(METADATA[1], F.current_timestamp()))


def stream_binary(spark: SparkSession, path: str, options: Mapping[str, str]) -> DataFrame:
    files = _folder(spark.readStream.format("binaryFile"), options).schema(BINARY_SCHEMA)
    return _with_file(files.load(path))


# Files in a micro-batch unless the options say otherwise.
FILES_PER_BATCH = "10000"
# Options that say which files there are, not how they are read.
LISTING = ("maxfilespertrigger", "maxbytespertrigger", "pathglobfilter", "latestfirst", "maxfileage")


def read_file_stream(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema_location: str,
    options: Mapping[str, str] | None = None,
    hints: str | None = None,
) -> DataFrame:
    """A stream of the new files of a folder and the folders in it, with their name and the time
    of ingestion."""
    options = {"maxFilesPerTrigger": FILES_PER_BATCH, **(options or {})}
    if fmt == "binaryFile":
        return stream_binary(spark, path, options)
    if fmt not in ("csv", "json", "parquet"):
        raise ValueError(f"unknown file format: {fmt!r}")
    schema = resolve_schema(spark, path, fmt, schema_location, options, hints)
    if fmt == "csv" and _has_header(options):
        names = [f.name for f in schema]
        check_headers(spark, path, names, options, f"{schema_location}_headers")
    if fmt == "parquet":
        return stream_parquet(spark, path, schema, options, f"{schema_location}_stored")
    return {"csv": stream_csv, "json": stream_json}[fmt](spark, path, schema, options)


def _has_header(options: Mapping[str, str]) -> bool:
    return str(options.get("header", "false")).lower() == "true"


def _read_files(
    spark: SparkSession, paths: list[str], fmt: str, schema: T.StructType, options: Mapping[str, str]
) -> DataFrame:
    """CSV or Parquet files as one frame, each group of Parquet files by its own types."""
    if fmt == "csv":
        names = [f.name for f in schema]
        wrong = file_in_other_order(spark, paths, names, options) if _has_header(options) else None
        if wrong:
            raise ValueError(f"columns in another order than the schema: {wrong}")
        return _csv_rows(spark.read, [_literal(p) for p in paths], schema, options)
    groups = []
    for some, own in _alike(spark, [_literal(p) for p in paths]):
        rows = _with_file(_folder(spark.read.schema(own), options).parquet(*some))
        groups.append(rescue_texts(rows, schema, options=options))
    return reduce(DataFrame.unionByName, groups)


def drain_files(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema_location: str,
    checkpoint: str,
    write: Callable[[DataFrame, int], None],
    name: str,
    options: Mapping[str, str] | None = None,
    hints: str | None = None,
) -> T.StructType:
    """Give the files that are new below a folder to `write`, batch by batch; returns the columns.

    For CSV and Parquet the stream is one of file names, and the files of a batch are read
    together, after their headers or footers have been looked at: Parquet files whose types
    differ are read by their own, where they are. All a driver holds are the names of a batch,
    `maxFilesPerTrigger` at most, and the checkpoint is the only record of what was seen.
    A batch with a header in another order stops before any of it is written.
    """
    options = {"maxFilesPerTrigger": FILES_PER_BATCH, **(options or {})}
    if fmt not in ("csv", "parquet"):
        rows = read_file_stream(spark, path, fmt, schema_location, options, hints)
        drain_batches(rows, write, checkpoint, name)
        return rows.schema
    schema = resolve_schema(spark, path, fmt, schema_location, options, hints)
    listing = {k: v for k, v in options.items() if k.lower() in LISTING}
    reading = {k: v for k, v in options.items() if k.lower() not in LISTING}
    found = _folder(spark.readStream.format("binaryFile"), listing).schema(BINARY_SCHEMA).load(path)
    found = found.filter("length > 0").select("modificationTime", "path", F.current_timestamp().alias("at"))

    def read_and_write(batch: DataFrame, number: int) -> None:
        files = sorted(batch.collect())
        if files:
            # By time, as files of one kind come together.
            rows = _read_files(batch.sparkSession, [f.path for f in files], fmt, schema, reading)
            write(rows.withColumn(METADATA[1], F.lit(files[0].at)), number)

    drain_batches(found, read_and_write, checkpoint, name)
    texts = [T.StructField(c, T.StringType()) for c in (RESCUED, METADATA[0])]
    return T.StructType([*schema, *texts, T.StructField(METADATA[1], T.TimestampType())])
