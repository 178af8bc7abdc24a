"""Operator 6: secret scan with an incremental blob ledger.

Every text is a version of a path (its doc_id) and is addressed by the SHA-256 of its content. Every rule has a version,
a hash of its pattern. The ledger says for each blob which rule versions have scanned it, also where nothing was found;
a run scans a blob with just those rules that have not, appends what it did, and joins the findings of the current rules
back to all paths. Rows of one blob are merged when the ledger is read, so any number of runs, also at once and blind to
each other, leave one result per blob, and a new rule is the only one that is run again.

Null text is the empty blob. Repeated rows and copies share a blob, are scanned once and all get its findings; rows with
a null doc_id keep it. Every rule takes time in proportion to the text, whatever the text. Columns other than doc_id and
text are not read. An empty table adds nothing to the ledger.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator, Sequence
from functools import cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm.common import per_batch, scratch

# The base rules; group and shortest length of what counts.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
BASE_KINDS = ("assign", "access", "hex")


class Rule(NamedTuple):
    """Matches of ``pattern`` whose ``group`` has at least ``shortest`` characters, in texts that hold ``sign``."""

    kind: str
    pattern: str
    sign: str
    group: int = 0
    shortest: int = 0
    any_case: bool = False

    @property
    def name(self) -> str:
        """Kind and version: a rule that says something else has another name."""
        return f"{self.kind}@{hashlib.sha256(repr(tuple(self)).encode()).hexdigest()[:12]}"

    def spans(self, text: str) -> Iterator[tuple[int, int]]:
        if self.sign in text:
            for match in _compiled(self.pattern, self.any_case).finditer(text):
                if len(match[self.group]) >= self.shortest:
                    yield match.span()


@cache
def _compiled(pattern: str, any_case: bool) -> re.Pattern:
    return re.compile(pattern, re.IGNORECASE | re.ASCII if any_case else 0)  # ASCII: no other letter folds to these


RULES = (
    Rule("assign", ASSIGN, "", 2, 6, any_case=True),
    Rule("access", ACCESS, "AKIA", shortest=20),
    Rule("hex", r"[0-9a-f]{24,}", ""),  # the base pattern's matches of that length: whole runs
    # Rules that the method adds. A token is tried once, where it begins, so that no run is read from each of its places.
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", "-----BEGIN "),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+", "eyJ"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}+", "gh"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}+", "xox"),
    Rule("bearer", r"Bearer\x20[A-Za-z0-9._~+/=-]{20,}+", "Bearer "),
)
#: Without one of these no assignment can match; a scan for them is much faster than the rule itself.
_ASSIGN_SIGN = re.compile(r"[:=]")

LEDGER = pa.schema(
    [("blob", pa.string()), ("rules", pa.list_(pa.string())),
     ("spans", pa.list_(pa.struct([("rule", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))]
)
LEDGER_DDL = "blob string, rules array<string>, spans array<struct<rule:string,start:long,end:long>>"


def find_spans(text: str, rules: Sequence[Rule] = RULES) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the rules, by start, then kind as listed."""
    places = {rule.kind: place for place, rule in enumerate(rules)}
    spans = [
        (rule.kind, start, end)
        for rule in rules
        if rule.kind != "assign" or _ASSIGN_SIGN.search(text)
        for start, end in rule.spans(text)
    ]
    return sorted(spans, key=lambda span: (span[1], places[span[0]], span[2]))


def with_blob(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.sha2(text.cast("binary"), 256).alias("blob"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """(blob, rules, spans), one row per blob however many runs have written of it; no rows where none has."""
    try:
        rows = spark.read.schema(LEDGER_DDL).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], LEDGER_DDL)
    merged = [F.array_distinct(F.flatten(F.collect_list(name))).alias(name) for name in ("rules", "spans")]
    return rows.groupBy("blob").agg(*merged)


def unseen_blobs(docs: DataFrame, ledger: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(blob, missing, text): a text of each blob that the ledger lacks a rule version of, with the names it lacks.

    The choice of one holder per blob moves addresses only, with map-side minima, so thousands of copies are one row
    per task; then each chosen text moves once.
    """
    blobs = with_blob(docs)
    holder = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    chosen = blobs.groupBy("blob").agg(F.min(holder).alias("chosen_holder"))
    scanned = F.coalesce("rules", F.array().cast("array<string>"))
    missing = F.array_except(F.array(*[F.lit(rule.name) for rule in rules]), scanned)
    chosen = chosen.join(ledger.select("blob", "rules"), "blob", "left").withColumn("missing", missing)
    chosen = chosen.where(F.size("missing") > 0).select(F.col("blob").alias("chosen_blob"), "chosen_holder", "missing")
    same = (F.col("blob") == F.col("chosen_blob")) & (holder == F.col("chosen_holder"))
    return blobs.join(chosen.hint("shuffle_hash"), same).select("blob", "missing", "text")


def update_ledger(docs: DataFrame, path: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Scan what the ledger at ``path`` lacks, append it, and return the ledger."""
    named = {rule.name: rule for rule in rules}
    names = {rule.kind: rule.name for rule in rules}

    def rows(blobs: Iterable, missing: Iterable, texts: Iterable) -> Iterator[tuple]:
        for blob, lacking, text in zip(blobs, missing, texts):
            found = find_spans(text, [named[name] for name in lacking])
            yield blob, lacking, [{"rule": names[kind], "start": start, "end": end} for kind, start, end in found]

    spark = docs.sparkSession
    found = per_batch(unseen_blobs(docs, read_ledger(spark, path), rules), LEDGER, LEDGER_DDL, rows)
    found.write.mode("append").parquet(path)
    return read_ledger(spark, path)


def findings(ledger: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(held_blob, counts of the base kinds, base_sha256, spans) by the given rules."""
    place = F.create_map(*[F.lit(value) for i, rule in enumerate(rules) for value in (rule.name, i)])
    kind = F.create_map(*[F.lit(value) for rule in rules for value in (rule.name, rule.kind)])
    mine = F.filter("spans", lambda span: F.element_at(place, span["rule"]).isNotNull())
    listed = F.transform(
        mine,
        lambda span: F.struct(
            span["start"], F.element_at(place, span["rule"]).alias("place"), span["end"],
            F.element_at(kind, span["rule"]).alias("kind"),
        ),
    )
    ordered = ledger.select(F.col("blob").alias("held_blob"), F.sort_array(listed).alias("found"))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of_kind(name: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")

    base = F.filter("found", lambda s: s["kind"].isin(*BASE_KINDS))
    return ordered.select(
        "held_blob",
        *[of_kind(name) for name in BASE_KINDS],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )


def scan_secrets(docs: DataFrame, ledger_path: str | None = None, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Findings per document. Without a path the ledger starts empty in the shared folder.

    A blob that a third of all documents share is one ledger row; its documents are a skewed side of the join, which
    adaptive execution splits.
    """
    path = ledger_path or scratch(docs.sparkSession, "secret-ledger")
    found = findings(update_ledger(docs, path, rules), rules)
    paths = with_blob(docs).select("doc_id", "blob")
    return paths.join(found, paths["blob"] == found["held_blob"]).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "blob"
    )
