"""Secret scan with an incremental blob ledger (operator 2).

Every text version is content-addressed by its SHA-256.  The ledger remembers
which (blob, rule, rule version) triples were scanned and what was found, so a
run scans each distinct text once, and only with rules it has not met.
Findings are then joined back to every path that holds the blob.

Defined results: a NULL text is scanned as an empty one; copies share one blob;
repeated rows are each reported; other columns pass through, those named
``blob_id`` or ``spans`` give way.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut, quoted
from strata.session import ship_package


@dataclass(frozen=True)
class Rule:
    """A pattern, and how long one of its groups must be for a match to count."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int
    any_case: bool = False

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The three base rules, in the order in which ties are listed.
RULES = (
    Rule("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", 1, r"[0-9a-f]+", 0, 16),
)

MADE = ("blob_id", "spans")
LEDGER_SCHEMA = "blob_id binary, rule string, found array<struct<s:int,e:int>>"


def compiled(rule: Rule) -> re.Pattern:
    # ASCII case folding only: the Unicode one would also take letters such as the Kelvin sign.
    if rule.group == 0 and rule.pattern.endswith("]+"):
        # A pattern that is a run to its end: a run too short for the limit is dropped whole
        # either way, so the limit can sit in the pattern and spare a match object per short run.
        head = rule.pattern[: rule.pattern.rindex("[")]
        return re.compile(rule.pattern[:-1] + "{%d,}" % max(1, rule.least - len(head)), re.ASCII)
    return re.compile(rule.pattern, re.ASCII | (re.IGNORECASE if rule.any_case else 0))


def spans(rule: Rule, pattern: re.Pattern, text: str) -> list[tuple[int, int]]:
    """Code point spans of the rule's matches, left to right, without overlap."""
    return [m.span() for m in pattern.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def _scan(rules: tuple[Rule, ...]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by_key = {r.key: (r, compiled(r)) for r in rules}
        for batch in batches:
            out = [(blob, key, spans(*by_key[key], text))
                   for blob, text, todo in zip(batch["blob_id"], batch["text"], batch["todo"]) for key in todo]
            yield pd.DataFrame(out, columns=["blob_id", "rule", "found"])
    return run


def _ledger(spark, path: str) -> DataFrame | None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return None
    return spark.read.schema(LEDGER_SCHEMA + ", run string").option("basePath", path).parquet(path).drop("run")


def blob_id(text):
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def update_ledger(texts: DataFrame, ledger_path: str, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """Scan what the ledger has not seen, append the outcome, and return the ledger.

    Texts are made distinct with a map-side combine first, so a text with a
    million copies is shuffled about once per map task and scanned once.  A
    run is one folder: a job that fails half-way leaves none.
    """
    spark = texts.sparkSession
    ship_package(spark)
    keys = F.array(*[F.lit(r.key) for r in rules])
    blobs = texts.select(F.coalesce(F.col(text), F.lit("")).alias("text")).distinct().select(blob_id(F.col("text")).alias("blob_id"), "text")
    known = _ledger(spark, ledger_path)
    if known is None:
        todo = blobs.withColumn("todo", keys)
    else:
        seen = known.groupBy("blob_id").agg(F.collect_set("rule").alias("seen"))
        todo = (blobs.join(seen, "blob_id", "left")
                .withColumn("todo", F.when(F.col("seen").isNull(), keys).otherwise(F.array_except(keys, F.col("seen"))))
                .filter(F.size("todo") > 0).drop("seen"))
    todo.mapInPandas(_scan(rules), LEDGER_SCHEMA).write.parquet(f"{ledger_path.rstrip('/')}/run={uuid.uuid4().hex}")
    return _ledger(spark, ledger_path)


def findings(paths: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``paths`` without the text, plus ``blob_id`` and ``spans``: array of (start, order, kind, end) of the blob it holds.

    The spans of a blob are written first: a blob that a third of all rows
    hold then meets them in a join of plain tables, which can split it.
    """
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.key), F.struct(F.lit(i).alias("i"), F.lit(r.kind).alias("kind")))])
    hits = (ledger.filter((F.size("found") > 0) & F.col("rule").isin(*[r.key for r in rules])).distinct()
            .select("blob_id", order[F.col("rule")].alias("r"), F.explode("found").alias("f"))
            .groupBy("blob_id").agg(F.array_sort(F.collect_list(F.struct(
                F.col("f.s").alias("start"), F.col("r.i").alias("i"), F.col("r.kind").alias("kind"), F.col("f.e").alias("end")))).alias("spans")))
    hits = cut(hits, "blob-spans")
    rest = [c for c in paths.columns if c != text and c.lower() not in MADE]
    held = paths.select(F.struct(*quoted(rest)).alias("__path") if rest else F.lit(0).alias("__path"), blob_id(F.col(text)).alias("blob_id"))
    return held.join(hits, "blob_id", "left").select(
        *(["__path.*"] if rest else []), "blob_id", F.coalesce("spans", F.array().cast(hits.schema["spans"].dataType)).alias("spans"))
