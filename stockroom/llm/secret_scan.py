"""Secret scan with an incremental blob ledger.

Every version of every path is content-addressed (SHA-256 of its text). The ledger is a Parquet
table with one row per scan: the blob, the rule versions applied and what they found. A scan
asks the ledger by address before it moves a text, takes each distinct blob once, applies only the rule versions its ledger rows lack, appends the
findings, and joins them back to all paths by blob address.

Defined results: a null text is the empty blob; repeated rows and equal texts share one scan and
all get its findings; rules see whole texts; an empty table gives an empty result; extra columns
are left alone. Spans are code points, end exclusive, leftmost and non-overlapping per rule.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.session import checkpoint_dir, read_parquet_or_none

from .shared import kept, map_texts, table


@dataclass(frozen=True)
class Rule:
    """A pattern and the least length of the checked group; ``base`` rules feed the counts."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False

    @property
    def version(self) -> str:
        return hashlib.sha256(repr((self.kind, self.pattern, self.group, self.least)).encode()).hexdigest()[:16]


# Fixed values.
RULES = (
    Rule("assign", r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
         2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    Rule("hex", r"[0-9a-f]+", 0, 24, True),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
    Rule("url_login", r"://[^\s/:@]+:[^\s/:@]{3,}@"),
)
FINDINGS = "array<struct<rule:string,kind:string,start:int,end:int>>"


def scan_text(text: str, rules) -> list[tuple[str, str, int, int]]:
    """(rule version, kind, start, end) of each accepted match, rule by rule."""
    out = []
    for version, kind, pattern, group, least in rules:
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                out.append((version, kind, m.start(), m.end()))
    return out


def compiled(rules):
    """Patterns ready to run. A run of hex digits shorter than its least length can never pass,
    so that rule asks for the length in the pattern (the same accepted matches)."""
    out = []
    for r in rules:
        p = r.pattern.removesuffix("+") + f"{{{r.least},}}" if r.pattern == "[0-9a-f]+" else r.pattern
        out.append((r.version, r.kind, re.compile(p), r.group, r.least))
    return out


def blob_id(text="text"):
    return F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)


#: Up to this many unseen blobs are sent to the texts (as 64-bit keys, some 50 MB); beyond it the texts are shuffled.
BROADCAST_BLOBS = 2_000_000


def unseen(versions: DataFrame, seen: DataFrame | None, rules: list[str]) -> DataFrame:
    """blob, text, __need (rule versions to apply) of each distinct blob that lacks a rule version in the
    ledger rows ``seen``. The ledger is asked by address first; only texts of unseen blobs are moved."""
    addressed = versions.select(blob_id().alias("blob"), F.coalesce("text", F.lit("")).alias("text"))
    wanted = F.array(*[F.lit(v) for v in rules])
    if seen is None:
        return addressed.groupBy("blob").agg(F.first("text").alias("text")).withColumn("__need", wanted)
    had = seen.groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("__had"))
    todo = kept(addressed.select("blob").distinct().join(had, "blob", "left")
                         .withColumn("__need", F.array_except(wanted, F.coalesce("__had", F.array().cast("array<string>"))))
                         .filter(F.size("__need") > 0).select("blob", "__need"), "unseen-blobs")
    if todo.count() <= BROADCAST_BLOBS:
        addressed = addressed.join(F.broadcast(todo.select(F.xxhash64("blob").alias("__k")).distinct()), F.xxhash64("blob") == F.col("__k"), "left_semi")
    return addressed.groupBy("blob").agg(F.first("text").alias("text")).join(todo, "blob")


def scan(versions: DataFrame, ledger: str, rules=RULES) -> DataFrame:
    """Scan ``versions`` (path, text; one row per historical version) against the ledger at
    ``ledger`` and return ``path, blob, findings`` for every version. Only unseen pairs of blob
    and rule version are scanned; the ledger gains one row per blob scanned."""
    spark = versions.sparkSession
    every = [r.version for r in rules]
    by_version = {v: (v, k, p, g, n) for v, k, p, g, n in compiled(rules)}
    seen = read_parquet_or_none(spark, ledger)
    blobs = unseen(versions, seen, every)
    # texts that need the same rules go through the same call: the list of needs leads the text
    needy = blobs.select("blob", F.col("__need").alias("rules"),
                         F.concat_ws("\n", F.array_join("__need", ","), "text").alias("text"))

    def run(texts):
        found = []
        for t in texts:
            need, _, text = t.decode("utf-8", "replace").partition("\n")
            found.append(scan_text(text, [by_version[v] for v in need.split(",")]))
        return None, {"findings": [[dict(zip(("rule", "kind", "start", "end"), f)) for f in x] for x in found]}

    map_texts(needy, ["blob", "rules"], run, f"findings {FINDINGS}").write.mode("append").parquet(ledger)
    rows = spark.read.parquet(ledger).select("blob", F.filter("findings", lambda f: f["rule"].isin(every)).alias("findings"))
    if seen is not None:
        rows = rows.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("findings"))).alias("findings"))
    return (versions.select("path", blob_id().alias("blob")).join(rows, "blob", "left")
                    .select("path", "blob", F.coalesce("findings", F.array().cast(FINDINGS)).alias("findings")))


def span_list(findings, kinds: list[str]):
    """kind:start:end of the findings of ``kinds`` by start, then kind as listed, joined by commas."""
    rank = lambda f: F.array_position(F.array(*[F.lit(k) for k in kinds]), f["kind"])
    picked = F.filter(findings, lambda f: f["kind"].isin(kinds))
    ordered = F.array_sort(F.transform(picked, lambda f: F.struct(f["start"].alias("s"), rank(f).alias("r"), f["end"].alias("e"), f["kind"].alias("k"))))
    return F.array_join(F.transform(ordered, lambda f: F.concat_ws(":", f["k"], f["s"], f["e"])), ",")


def count_of(findings, kind: str):
    return F.size(F.filter(findings, lambda f: f["kind"] == kind)).cast("long")


def digest(found: DataFrame, key: str, rules=RULES) -> DataFrame:
    """The counts and span lists of scanned versions, one row per version."""
    base = [r.kind for r in rules if r.base]
    f = F.col("findings")
    return found.select(
        F.col("path").alias(key),
        *[count_of(f, k).alias(f"n_{k}") for k in base],
        F.sha2(span_list(f, base).cast("binary"), 256).alias("base_sha256"),
        span_list(f, [r.kind for r in rules]).alias("spans"))


def op1_secret_scan(spark, sf_dir: str) -> DataFrame:
    """All documents as versions (path: doc_id) against a ledger that starts empty."""
    import uuid
    ledger = f"{checkpoint_dir(spark)}/ledger-{uuid.uuid4().hex[:12]}"
    docs = table(spark, sf_dir, "documents")
    return digest(scan(docs.select(F.col("doc_id").alias("path"), "text"), ledger), "doc_id")
