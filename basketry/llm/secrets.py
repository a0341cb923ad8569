"""Secret scans over all versions of all files, with an incremental ledger of blobs.

Each version's text is addressed by its SHA-256, the *blob*. A ledger, two Parquet tables in a folder, records which
blob was scanned under which rule (``scans``: ``blob``, ``rule``) and what was found (``findings``: ``blob``, ``rule``,
``kind``, ``start``, ``stop``, in code points, end exclusive). A run scans only pairs of blob and rule that the ledger does
not hold, each blob once however many paths or versions carry it, and joins the findings back to all of them. A
rule's name in the ledger contains a digest of its definition, so a changed rule is a new one.

Everything is DataFrame functions: matches come from ``regexp_extract_all``, their places from the lengths of the
pieces that ``split`` leaves between them. Null texts are empty texts; null paths are paths like others; repeated
rows are kept and share one blob. Columns other than those named are ignored; an empty table gives empty results.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.session import materialize


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds leftmost non-overlapping matches; those whose ``group`` is shorter than ``least`` drop."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def name(self) -> str:
        definition = f"{self.kind}\n{self.pattern}\n{self.group}\n{self.least}"
        return f"{self.kind}-{hashlib.sha256(definition.encode()).hexdigest()[:16]}"


def either_case(word: str) -> str:
    """A pattern for ``word`` with its ASCII letters in either case."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)


KEYWORDS = "password|passwd|secret|token|api_?key"
ASSIGN = f"({either_case(KEYWORDS)})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
#: fixed kinds, in the order in which spans of one start are listed
BASE = (
    Rule("assign", ASSIGN, 2, 6),
    # at most one match starts in a run, at its first AKIA, and a run of hex digits matches as a whole:
    # a least length inside the pattern finds what dropping short matches would leave
    Rule("access", "AKIA[A-Z0-9]{16,}", 0, 20),
    Rule("hex", "[0-9a-f]{24,}", 0, 24),
)
_SCANS, _FINDINGS = "blob binary, rule string", "blob binary, rule string, kind string, start long, stop long"


def _ledger(spark: SparkSession, folder: str, part: str, schema: str) -> DataFrame:
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(f"{folder}/{part}")
    if not path.getFileSystem(context._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{folder}/{part}")


def _hits(text: Column, rule: Rule) -> Column:
    """Pieces between the matches, and the matches with the group that is measured; null without a match."""
    pattern = F.lit(rule.pattern)
    return F.when(
        F.array_contains("rules", rule.name) & text.rlike(rule.pattern),
        F.struct(
            F.lit(rule.name).alias("rule"),
            F.lit(rule.kind).alias("kind"),
            F.lit(rule.least).alias("least"),
            F.arrays_zip(
                F.split(text, rule.pattern, -1).alias("gap"),
                F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"),
                F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("measured"),
            ).alias("hits"),
        ),
    )


def scan(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Findings in ``blobs`` (``blob``, ``text``, ``rules``: the names of the rules still to be applied)."""
    found = blobs.select("blob", F.explode(F.array_compact(F.array(*[_hits(F.col("text"), r) for r in rules]))).alias("f"))
    pieces = found.select("blob", "f.rule", "f.kind", "f.least", F.posexplode("f.hits").alias("at", "hit"))
    # the piece after the last match has no match beside it
    pieces = pieces.select(
        "blob",
        "rule",
        "kind",
        "least",
        "at",
        F.length("hit.gap").alias("gap"),
        F.length("hit.match").alias("match"),
        F.length("hit.measured").alias("measured"),
    ).where("match IS NOT NULL")
    so_far = Window.partitionBy("blob", "rule").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    placed = pieces.withColumn("stop", F.sum(F.col("gap") + F.col("match")).over(so_far))
    return placed.where("measured >= least").select(
        "blob", "rule", "kind", (F.col("stop") - F.col("match")).alias("start"), "stop"
    )


def scan_versions(
    versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = BASE
) -> tuple[DataFrame, DataFrame]:
    """Bring the ledger up to date with ``versions`` (``path``, ``version``, ``text``).

    Returns the addressed versions (``path``, ``version``, ``blob``) and the findings of the rules for all blobs in the
    ledger. Findings are written before the scans, so a run that was cut off is repeated, never skipped; what a repeated
    scan finds again is read once.
    """
    spark = versions.sparkSession
    names = [r.name for r in rules]
    text = F.coalesce("text", F.lit(""))
    blob = F.unhex(F.sha2(text, 256)).alias("blob")
    addressed = materialize(versions.select("path", "version", blob))

    wanted = addressed.select("blob").distinct().select("blob", F.explode(F.array(*map(F.lit, names))).alias("rule"))
    unseen = wanted.join(_ledger(spark, ledger, "scans", _SCANS), ["blob", "rule"], "left_anti")
    unseen = materialize(unseen.groupBy("blob").agg(F.collect_set("rule").alias("rules")))
    # equal texts: any row's will do, and a task sends one of each on
    texts = versions.select(blob, text.alias("text")).dropDuplicates(["blob"])
    scan(texts.join(unseen, "blob"), rules).write.mode("append").parquet(f"{ledger}/findings")
    unseen.select("blob", F.explode("rules").alias("rule")).write.mode("append").parquet(f"{ledger}/scans")

    findings = _ledger(spark, ledger, "findings", _FINDINGS).where(F.col("rule").isin(names)).distinct()
    return addressed, findings


def spans_by_version(addressed: DataFrame, findings: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """Per version: ``path``, ``version``, ``spans`` (array of ``start, order, stop, kind``, sorted; empty without a finding)."""
    order = F.array_position(F.array(*map(F.lit, kinds)), F.col("kind"))
    spans = findings.groupBy("blob").agg(
        F.array_sort(F.collect_list(F.struct("start", order.alias("order"), "stop", "kind"))).alias("spans")
    )
    none = F.from_json(F.lit("[]"), spans.schema["spans"].dataType.simpleString())
    joined = addressed.join(materialize(spans), "blob", "left")
    return joined.select("path", "version", F.coalesce("spans", none).alias("spans"))


def span_digests(spans: DataFrame, kinds: tuple[str, ...] = tuple(r.kind for r in BASE)) -> DataFrame:
    """``doc_id, n_<kind>…, base_sha256, spans`` from :func:`spans_by_version`."""

    def text(array: Column) -> Column:
        return F.array_join(F.transform(array, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")

    def of(*wanted: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*wanted))

    base = [r.kind for r in BASE]
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in kinds]
    return spans.select(
        F.col("path").alias("doc_id"),
        *counts,
        F.sha2(text(of(*base)), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    )
