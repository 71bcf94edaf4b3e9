"""Secret scans over a ledger of content-addressed blobs.

Every version of every path is named by the SHA-256 of its text. The ledger remembers which rules (name and version)
have seen which blob and what they found; a run scans only the pairs that are not in it, each blob once however many
paths hold it, adds what it found, and joins the findings back to all paths.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evalspark.llm.order import stored

_FINDING = "struct<rule: string, kind: string, start: int, end: int>"
ROW = f"blob string, rules array<string>, findings array<{_FINDING}>"
#: The ledger is filed by the first digits of the digest, so that a small run opens a few of its 256 parts.
PREFIX_DIGITS = 2
LEDGER = f"{ROW}, prefix string"


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and non-overlapping, that pass ``holds``. A changed rule needs a new version."""

    kind: str
    pattern: str
    version: int = 1
    holds: Callable[[re.Match], bool] = field(default=lambda m: True, compare=False)

    @property
    def id(self) -> str:
        return f"{self.kind}@{self.version}"


BASE_RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        holds=lambda m: len(m[2]) >= 8,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", holds=lambda m: len(m[0]) >= 16),
    Rule("hex", r"[0-9a-f]{32,}"),  # the greedy run itself, which shorter runs fail
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("bearer", r"[Bb]earer\x20+[A-Za-z0-9+/_.~-]{20,}=*"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,20}://[^\x00-\x20/:@]{1,100}:[^\x00-\x20/:@]{1,100}@"),
)
RULES = BASE_RULES + MORE_RULES


def blob_of(text: str = "text") -> Column:
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


def _scan(rules: tuple[Rule, ...]):
    compiled = [(r.id, r.kind, re.compile(r.pattern, re.ASCII), r.holds) for r in rules]
    kind = pa.list_(pa.struct([("rule", pa.string()), ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text, todo in zip(batch.column("text"), batch.column("rules").to_pylist(), strict=True):
                text, todo = text.as_py() or "", set(todo)
                found.append(
                    [
                        {"rule": name, "kind": kind_, "start": m.start(), "end": m.end()}
                        for name, kind_, pattern, holds in compiled
                        if name in todo
                        for m in pattern.finditer(text)
                        if holds(m)
                    ]
                )
            yield pa.record_batch([batch.column("blob"), batch.column("rules"), pa.array(found, kind)], names=["blob", "rules", "findings"])

    return run


def read_ledger(spark: SparkSession, path: str, blobs: DataFrame | None = None) -> DataFrame | None:
    """The ledger, or what it has of some ``blobs`` (blob, without repeats): only their parts are opened, and rows of other
    blobs are left out before anything is put together."""
    try:
        rows = spark.read.schema(LEDGER).parquet(path)
        if blobs is None:
            return rows
        parts = [r[0] for r in blobs.select(F.left("blob", F.lit(PREFIX_DIGITS))).distinct().collect()]  # at most 256
        return rows.filter(F.col("prefix").isin(parts)).join(blobs, "blob", "left_semi")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def scan(versions: DataFrame, ledger: str, *, keep: tuple[str, ...] = ("doc_id",), text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per version: the columns ``keep``, blob, and findings (kind, start, end in code points, end exclusive),
    sorted by start, then in the order of ``rules``.

    Only blobs that some rule has not seen are scanned; what was found is added to ``ledger`` (Parquet) before the
    result is made. A null text is an empty one. Copies share a blob and its findings; repeated rows are rows of the
    result each. An empty table adds nothing and gives no rows. Other columns are ignored. A run that is broken off
    leaves the ledger as it was or with all its blobs; two runs at once may scan a blob twice, which changes nothing. A run
    over few versions costs what they cost, and the parts of the ledger that their blobs are filed in.
    """
    spark = versions.sparkSession
    names = [r.id for r in rules]
    keys = [f"__k{i}" for i in range(len(keep))]
    rows = versions.select(*[F.col(c).alias(k) for c, k in zip(keep, keys, strict=True)], F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("blob", blob_of())
    todo = F.array(*[F.lit(n) for n in names])
    past = read_ledger(spark, ledger)
    if past is not None:
        blobs = stored(rows.select("blob").distinct(), "blobs")
        past = read_ledger(spark, ledger, blobs)
    if past is None:
        unseen = rows.select("blob", "text").dropDuplicates(["blob"]).withColumn("rules", todo)
    else:
        seen = past.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_set("rules"))).alias("seen"))
        open_ = blobs.join(seen, "blob", "left")
        left = F.when(F.col("seen").isNull(), todo).otherwise(F.array_except(todo, F.col("seen")))
        open_ = open_.select("blob", left.alias("rules")).filter(F.size("rules") > 0)
        # Texts are joined after copies are gone; few open blobs become a broadcast at run time.
        unseen = rows.select("blob", "text").join(open_.select("blob"), "blob", "left_semi").dropDuplicates(["blob"]).join(open_, "blob")
    found = unseen.select("blob", "text", "rules").mapInArrow(_scan(rules), ROW).withColumn("prefix", F.left("blob", F.lit(PREFIX_DIGITS)))
    found.hint("rebalance", F.col("prefix")).write.mode("append").partitionBy("prefix").parquet(ledger)

    known = read_ledger(spark, ledger, None if past is None else blobs).filter(F.size("findings") > 0).select("blob", F.explode("findings").alias("f"))
    order = F.array_position(F.lit(names), F.col("f.rule"))
    known = known.withColumn("at", order).filter(F.col("at") > 0)
    found = F.sort_array(F.collect_set(F.struct(F.col("f.start").alias("start"), F.col("at").alias("at"), F.col("f.end").alias("end"), F.col("f.kind").alias("kind"))))
    known = known.groupBy("blob").agg(found.alias("findings"))
    none = F.array().cast("array<struct<start: int, at: bigint, end: int, kind: string>>")
    joined = rows.drop("text").join(known, "blob", "left").withColumn("findings", F.coalesce("findings", none))
    return joined.select(*[F.col(k).alias(c) for k, c in zip(keys, keep, strict=True)], "blob", "findings")
