"""Writers (K1-K8). All write directories of part files from the executors;
a single output file is opt-in because it funnels all rows through one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import schemas as S
from ..functions.time import DAY_SPLIT_OFFSET, local_day
from .readers import CSV_OPTIONS


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    """K1: CSV directory, quote and escape ``"``."""
    df.write.options(**CSV_OPTIONS).option("header", header).mode(mode).csv(path)


def write_single_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """K2: one CSV part (for small prepared metadata; one task writes it all)."""
    write_csv(df.coalesce(1), path, header)


def write_sql(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
              mode: str = "append") -> None:
    """K3: append to a SQL table over JDBC (driver jar must be on the classpath)."""
    df.write.jdbc(url, table, mode=mode, properties=properties or {})


# Store table per prepared entity.
SQL_TABLES = {"user": "user", "product": "product", "category": "category",
              "deal_item": "deal_item", "prod_category": "prod_category"}


def save_instances(instances: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K4: instances partitioned by split (read back one split with partition pruning)."""
    instances.write.partitionBy("split").mode(mode).parquet(path)


def save_new_instances(instances: DataFrame, path: str, ts_col: str = S.TIMESTAMP, offset: int = DAY_SPLIT_OFFSET) -> None:
    """K4, incremental: instances partitioned by split and local day of their label; only the partitions that occur are replaced.

    Give whole days: a day's new instances take the place of its old ones. Days
    and splits that do not occur keep theirs.
    """
    day = F.date_from_unix_date(local_day(ts_col, offset).cast("int"))
    (instances.withColumn("day", day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("split", "day").parquet(path))


def save_index(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K5: user or item index table."""
    df.write.mode(mode).parquet(path)


def save_stats(stats: DataFrame, path: str) -> None:
    """K6: the small run-statistics table as one CSV part."""
    write_single_csv(stats, path)


def save_case_report(report: DataFrame, path: str) -> None:
    """K7: case texts as JSON lines under ``outcome=positives|negatives``."""
    report.write.partitionBy("outcome").mode("overwrite").json(path)


def export_vectors_tsv(items: DataFrame, path: str, id_col: str = S.PRODUCT_NO, title_col: str = "title",
                       vector_col: str = "vector") -> None:
    """K8: ``id <TAB> title <TAB> v1 <TAB> v2 ...`` lines (one text record per item).

    Tabs and line breaks inside a title become spaces, so every item is one line.
    """
    vec = F.array_join(F.transform(vector_col, lambda x: x.cast("string")), "\t")
    line = F.concat_ws("\t", F.col(id_col).cast("string"), F.regexp_replace(F.coalesce(F.col(title_col), F.lit("")), r"[\t\r\n]", " "), vec)
    items.select(line.alias("value")).write.mode("overwrite").text(path)
