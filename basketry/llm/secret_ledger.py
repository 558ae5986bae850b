"""Secret scans: an incremental ledger of content-addressed blobs.

Every historical version of a path is addressed by the sha256 of its text, so
a text kept under many paths or in many versions is one blob. ``update`` scans
only the (blob, rule version) pairs that the ledger does not hold yet, appends
them to it, and joins the ledger's findings back to all paths. Changing a rule
means giving it a new version; only that rule is scanned again.

Only DataFrame and SQL functions run here. Copies are reduced to one blob by a
map-side ``first`` before the shuffle, so a text with a third of all rows
crosses it once per task. The ledger is Parquet in the shared folder, one
appended directory per update. Every attempt writes a directory of its own
name, which counts once Spark has marked it as complete: an update that dies
can simply be run again, and a ledger opened on an earlier one's path goes on
from there. One process updates a ledger at a time.

Defined cases: a null text is an empty blob without findings; a null path is
kept as a path; a repeated row gives a row each; empty input appends no rows;
only the path and text columns are read, so others may have any name.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import EMPTY_SPANS, found, scratch, whole


@dataclass(frozen=True)
class Rule:
    """``hint`` is a cheap test that any text with a match passes; ``keep`` judges a match ``x``."""

    kind: str
    version: int
    pattern: str
    hint: str
    keep: str = "true"

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: The fixed kinds in their order, then the rules that the library adds.
RULES = (
    Rule("assign", 1, ASSIGN, r"text rlike '(?i:password|passwd|secret|token|api_?key)'",
         "length(regexp_extract(x.m, '" + ASSIGN.replace("'", "\\'").replace("\\x", "\\\\x") + "', 2)) >= 6"),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}+", "contains(text, 'AKIA')"),
    Rule("hex", 1, r"[0-9a-f]{24,}+", "true"),
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", "contains(text, 'PRIVATE KEY-----')"),
    Rule("bearer", 1, r"(?:ghp|gho|ghs|ghr)_[A-Za-z0-9]{36,}+", "text rlike 'gh[pors]_'"),
)


def scan(blobs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Findings of each blob (blob_id, text, todo: rule keys): one row per pair, with the spans."""
    each = [
        f"named_struct('rule', '{r.key}', 'kind', '{r.kind}', 'spans', case when array_contains(todo, '{r.key}') and {r.hint} "
        f"then transform(filter({found('text', r.pattern)}, x -> {r.keep}), x -> named_struct('s', x.s, 'e', x.e)) end)"
        for r in rules
    ]
    return (
        blobs.select("blob_id", "todo", F.expr(f"array({', '.join(each)})").alias("each"))
        .select("blob_id", F.expr("filter(each, x -> array_contains(todo, x.rule))").alias("each"))
        .select("blob_id", F.explode_outer("each").alias("x"))
        .select("blob_id", "x.rule", "x.kind", F.coalesce("x.spans", F.expr("cast(array() as array<struct<s:int,e:int>>)")).alias("spans"))
    )


class Ledger:
    """Scanned (blob, rule version) pairs and their findings under one shared path."""

    SCHEMA = "blob_id string, rule string, kind string, spans array<struct<s:int,e:int>>"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.parts = self.committed()

    def committed(self) -> list[str]:
        """The directories of completed updates, oldest first."""
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        files = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        done = files.globStatus(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, "update-*/_SUCCESS"))
        return sorted(str(f.getPath().getParent().toString()) for f in done or [])

    def rows(self) -> DataFrame:
        if not self.parts:
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(*self.parts)

    def update(self, versions: DataFrame, rules: Sequence[Rule] = RULES, path_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Scan what is new, then return (path, blob_id, findings) for every given row.

        ``findings`` holds one (kind, rank, s, e) per match of the given rules.
        """
        read = versions.select(F.col(path_col).alias("path"), whole(F.col(text_col)).alias("text")).withColumn("blob_id", F.sha2("text", 256))
        blobs = read.groupBy("blob_id").agg(F.first("text").alias("text"))
        keys = [r.key for r in rules]
        if self.parts:
            seen = self.rows().groupBy("blob_id").agg(F.collect_set("rule").alias("seen"))
            blobs = blobs.join(seen, "blob_id", "left").withColumn("todo", F.array_except(F.array(*map(F.lit, keys)), F.coalesce("seen", F.expr("cast(array() as array<string>)"))))
        else:
            blobs = blobs.withColumn("todo", F.array(*map(F.lit, keys)))
        part = f"{self.path}/update-{len(self.parts):06d}-{uuid.uuid4().hex}"
        scan(blobs.where(F.size("todo") > 0), rules).write.parquet(part)
        self.parts.append(part)
        rank = F.create_map(*[F.lit(v) for i, k in enumerate(keys) for v in (k, i)])
        findings = (
            self.rows().where(F.col("rule").isin(keys) & (F.size("spans") > 0))
            .select("blob_id", F.explode("spans").alias("x"), "kind", rank[F.col("rule")].alias("rank"))
            .groupBy("blob_id").agg(F.collect_list(F.struct(F.col("x.s").alias("s"), "rank", F.col("x.e").alias("e"), "kind")).alias("findings"))
        )
        none = F.expr("cast(array() as array<struct<s:int,rank:int,e:int,kind:string>>)")
        return (read.select("path", "blob_id").join(findings, "blob_id", "left")
                .select("path", "blob_id", F.sort_array(F.coalesce("findings", none)).alias("findings")))


def secret_digest(scanned: DataFrame) -> DataFrame:
    """Counts and span strings, by start and then by rule order."""
    joined = lambda kept: F.expr(f"array_join(transform({kept}, x -> concat(x.kind, ':', x.s, ':', x.e)), ',')")
    count = lambda k: F.expr(f"cast(size(filter(findings, x -> x.kind = '{k}')) as bigint)").alias(f"n_{k}")
    return scanned.select(
        F.col("path").alias("doc_id"), count("assign"), count("access"), count("hex"),
        F.sha2(joined("filter(findings, x -> x.rank < 3)"), 256).alias("base_sha256"),
        joined("findings").alias("spans"))


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """One update of a new ledger over ``docs``, as a digest per document."""
    spark = docs.sparkSession
    return secret_digest(Ledger(spark, scratch(spark, "secrets")).update(docs, rules, id_col, text_col))


__all__ = ["EMPTY_SPANS", "RULES", "Ledger", "Rule", "scan", "secret_digest", "secret_scan"]
