"""Readers for the log, metadata, behaviour, lookup and instance files.

No schema is inferred from data: every entity has a declared schema, and
header-carrying files are matched to it by column name, so a file whose
columns come in another order still reads correctly and ids keep their
leading zeros.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from .. import schemas as S

CSV_OPTIONS = {"quote": '"', "escape": '"'}


def _cast(col: str, dtype: T.DataType):
    c = F.col(col)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType)):
        # integers exported through a float column arrive as "123.0" (F11)
        return c.cast("double").cast(dtype)
    if isinstance(dtype, T.LongType):
        # exact for plain integers; "123.0" goes through double
        return F.coalesce(c.try_cast(dtype), c.cast("double").cast(dtype))
    return c.cast(dtype)


def _cast_by_name(df: DataFrame, schema: T.StructType) -> DataFrame:
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}")
    return df.select(*[_cast(f.name, f.dataType).alias(f.name) for f in schema.fields])


def cast_known(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the columns ``schema`` declares (by name); other columns pass through as read."""
    types = {f.name: f.dataType for f in schema.fields}
    return df.select(*[_cast(c, types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def read_useraction(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Every ``*.csv`` under ``path``: no header, five positional columns."""
    return (spark.read.options(**CSV_OPTIONS).option("header", False).option("multiLine", multi_line)
            .option("pathGlobFilter", "*.csv").schema(S.USERACTION).csv(path))


#: the column that holds a line which does not fit the schema
REJECTED = "_rejected"


def csv_lines(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """K1 as text: the other columns and ``value``, the CSV record of ``columns`` (default: all); breaks stay inside quotes."""
    chosen = list(columns) if columns is not None else df.columns
    rest = [c for c in df.columns if c not in chosen]
    return df.select(*rest, F.to_csv(F.struct(*chosen), CSV_OPTIONS).alias("value"))


def parse_csv_lines(lines: DataFrame, schema: T.StructType = S.USERACTION, column: str = "value") -> DataFrame:
    """S1 on text: each record as typed columns, and ``_rejected``: the whole record where it doesn't fit ``schema``.

    A record of the wrong number of fields or with a field of the wrong type
    has nulls in every column but ``_rejected``; it is neither dropped nor
    half read. Other columns of ``lines`` stay.
    """
    wanted = T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())])
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wanted.fields)
    record = F.from_csv(F.col(column), ddl, {**CSV_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECTED})
    rest = [c for c in lines.columns if c != column]
    parsed = lines.select(*rest, F.col(column).alias("_line"), record.alias("_r"))
    bad = F.col(f"_r.{REJECTED}").isNotNull()
    fields = [F.when(~bad, F.col(f"_r.{f.name}")).alias(f.name) for f in schema.fields]
    return parsed.select(*rest, *fields, F.when(bad, F.col("_line")).alias(REJECTED))


def read_useraction_with_rejects(spark: SparkSession, path: str) -> DataFrame:
    """S1 with one record a line: the log's columns and ``_rejected`` (see ``parse_csv_lines``)."""
    return parse_csv_lines(spark.read.option("pathGlobFilter", "*.csv").text(path))


def read_csv_with_header(spark: SparkSession, path: str, schema: T.StructType | None = None,
                         glob: str | None = None, multi_line: bool = False) -> DataFrame:
    """Header CSV file(s); columns cast by name to ``schema`` (strings when none)."""
    reader = spark.read.options(**CSV_OPTIONS).option("header", True).option("multiLine", multi_line)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.csv(path)
    return _cast_by_name(df, schema) if schema is not None else df


def read_metadata(spark: SparkSession, path: str, entity: str | None = None) -> DataFrame:
    """A metadata CSV; ``entity`` picks the declared schema (see ``schemas.METADATA``).

    Without a registered entity the column types are inferred (one extra pass
    over the file), which can turn codes like ``00012`` into numbers.
    """
    if entity:
        return read_csv_with_header(spark, path, S.METADATA[entity])
    return spark.read.options(**CSV_OPTIONS).option("header", True).option("inferSchema", True).csv(path)


def first_lines(spark: SparkSession, uris: Iterable[str]) -> list[tuple[str, str | None]]:
    """(path, first line) of each file; None for an empty one. Only the first line is read, a buffer at a time."""
    jvm, conf, out = spark._jvm, spark._jsc.hadoopConfiguration(), []
    for uri in uris:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(path.getFileSystem(conf).open(path), "UTF-8"))
        try:
            out.append((path.toString(), reader.readLine()))
        finally:
            reader.close()
    return out


def read_csv_parts(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """S3: all ``*.csv`` parts of a directory with headers, as one DataFrame.

    Parts are aligned by column name: files are grouped by their header line,
    each group is read with its own header, and U1 puts the groups together, so
    every file is read once. Of the headers only each file's first line is
    opened beforehand, through the same file system that Spark lists.
    """
    groups: dict[str, list[str]] = {}
    for file, head in first_lines(spark, spark.read.option("pathGlobFilter", "*.csv").text(path).inputFiles()):
        if head is not None:  # an empty file has no columns
            groups.setdefault(head, []).append(file)
    if len(groups) < 2:
        return read_csv_with_header(spark, path, schema, glob="*.csv")
    reader = spark.read.options(**CSV_OPTIONS).option("header", True)
    df = union_by_name([reader.csv(sorted(files)) for _, files in sorted(groups.items())])
    return _cast_by_name(df, schema) if schema is not None else df


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """Concatenate frames by column name; missing columns become null."""
    frames = list(frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def read_behaviours(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Orders or clicks with declared types, optionally a column subset."""
    df = read_csv_with_header(spark, path, S.BEHAVIOUR)
    return df.select(*columns) if columns else df


# The size band of one export's log parts that hold orders (13 MiB < size <= 17 MiB).
ORDER_PARTS_MIN_BYTES, ORDER_PARTS_MAX_BYTES = 13 * 2 ** 20, 17 * 2 ** 20


def extract_orders(log: DataFrame, min_bytes: int | None = None, max_bytes: int | None = None, action: str = "O",
                   size_col: str = "_metadata.file_size") -> DataFrame:
    """Log rows whose action type starts with ``action``.

    Every file counts unless the caller names a band: then only files of
    ``min_bytes < size <= max_bytes`` (``ORDER_PARTS_*`` is the band that
    selects one export's parts).

    ``size_col`` is the file size: the hidden ``_metadata.file_size`` of a file
    source, or a column carrying it.
    """
    df = log.where(F.col(S.ACTION_TYPE).startswith(action))
    size = F.col(size_col)
    if min_bytes is not None:
        df = df.where(size > min_bytes)
    if max_bytes is not None:
        df = df.where(size <= max_bytes)
    return df.select(*[c for c in log.columns if c != size_col])


def extract_search_words(log: DataFrame, distinct: bool = True) -> DataFrame:
    """Non-empty search keywords of the log (one column ``word``)."""
    words = log.where(F.col(S.SEARCH_KEYWORD).isNotNull() & (F.col(S.SEARCH_KEYWORD) != "")) \
        .select(F.col(S.SEARCH_KEYWORD).alias("word"))
    return words.distinct() if distinct else words


def read_lines(spark: SparkSession, path: str, strip: bool = True, drop_empty: bool = False) -> DataFrame:
    """One value per line (column ``value``), optionally whitespace-stripped.

    Blank lines are kept unless ``drop_empty``: a blank blacklist line is an
    empty pattern, and a blank word-list line is the empty word.
    """
    df = spark.read.text(path)
    if strip:
        df = df.select(F.trim(F.col("value")).alias("value"))
    return df.where(F.col("value") != "") if drop_empty else df


def read_patterns(spark: SparkSession, path: str) -> list[str]:
    """S7 for small configuration lists (blacklist globs): returned to the driver."""
    return [r.value for r in read_lines(spark, path).collect()]


def numbered_lines(spark: SparkSession, path: str, name: str = "value") -> DataFrame:
    """(line, ``name``): every line with its 0-based number; files follow one another by path.

    A block of a file is read in order by one task, so a line's place in its
    block is its distance from the block's least id; a running sum over one
    row per block gives each block's first number.
    """
    rows = spark.read.text(path).select(F.col("value").alias(name), F.col("_metadata.file_path").alias("_file"),
                                        F.col("_metadata.file_block_start").alias("_at"), F.monotonically_increasing_id().alias("_row"))
    blocks = rows.groupBy("_file", "_at").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = Window.orderBy("_file", "_at").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return rows.join(starts, ["_file", "_at"]).select((F.col("_start") + F.col("_row") - F.col("_first")).alias("line"), name)


def read_lookup(spark: SparkSession, ids_path: str, titles_path: str | None = None,
                vectors_path: str | None = None) -> DataFrame:
    """Line-aligned ids / titles / vectors files as one keyed table.

    Lines are matched by line number (see ``numbered_lines``); when an id repeats, its last line wins.
    Returns ``(prod_no, title?, vector?)``.
    """
    df = numbered_lines(spark, ids_path, "_id").select("line", F.trim("_id").cast("int").alias(S.PRODUCT_NO))
    if titles_path:
        df = df.join(numbered_lines(spark, titles_path, "title")
                     .select("line", F.trim("title").alias("title")), on="line", how="left")
    if vectors_path:
        vec = numbered_lines(spark, vectors_path, "_v").select(
            "line", F.transform(F.split(F.trim("_v"), r"\s+"), lambda x: x.cast("double")).alias("vector"))
        df = df.join(vec, on="line", how="left")
    rest = [c for c in df.columns if c not in ("line", S.PRODUCT_NO)]
    last = F.max_by(F.struct(*rest), F.col("line")) if rest else None
    if last is None:
        return df.select(S.PRODUCT_NO).distinct()
    return df.groupBy(S.PRODUCT_NO).agg(last.alias("_r")).select(S.PRODUCT_NO, "_r.*")


def read_vectors_tsv(spark: SparkSession, path: str) -> DataFrame:
    """S8, keyed: the lines that ``sinks.export_vectors_tsv`` writes, as ``(prod_no, title, vector)``."""
    parts = F.split("value", "\t", -1)
    return spark.read.text(path).select(
        parts[0].cast("int").alias(S.PRODUCT_NO), parts[1].alias("title"),
        F.transform(F.slice(parts, F.lit(3), F.size(parts) - 2), lambda x: x.cast("double")).alias("vector"))


def read_instances(spark: SparkSession, path: str, with_clicks: bool = False, split: str | None = None,
                   first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    """Saved instances (orders, label, optionally clicks); a split, or days of incremental output, are pruned by partition."""
    df = spark.read.parquet(path)
    if split is not None:
        df = df.where(F.col("split") == split)
    if first_day is not None:
        df = df.where(F.col("day") >= F.lit(first_day).cast("date"))
    if last_day is not None:
        df = df.where(F.col("day") <= F.lit(last_day).cast("date"))
    cols = [c for c in df.columns if c not in ("clicks",)] if not with_clicks else df.columns
    return df.select(*cols)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """A saved user or item index table."""
    return spark.read.parquet(path)


def read_valid_products(spark: SparkSession, path: str) -> DataFrame:
    """The single-column list of valid products."""
    return read_csv_with_header(spark, path, S.VALID_PRODUCTS)
