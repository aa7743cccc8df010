"""Secret scans over an incremental blob ledger.

A blob is a distinct text, named by the SHA-256 of its UTF-8 bytes; the paths
(documents, versions) that hold it are joined back at the end.  The ledger is a
Parquet table of (blob, rules, findings).  A scan

1. hashes every text and keeps one compressed copy of each blob and task,
2. drops the blobs that the ledger already has under the current rules,
3. exchanges the rest once by blob and scans each blob once,
4. appends the findings to the ledger, and
5. joins the ledger's findings to all paths.

A blob that a third of all documents share arrives at most once per task.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_dir

BASE = ("assign", "access", "hex")
ADDED = ("pem", "github", "slack", "google", "jwt")
KINDS = BASE + ADDED

#: Words of an assignment, lower-cased; a text without any has no assignment.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
#: kind -> (what a text must hold, pattern); published token formats (fixed values).
FORMATS = {
    "pem": ("-----BEGIN ", re.compile(
        r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----[A-Za-z0-9+/=\s]*-----END [A-Z ]{0,40}PRIVATE KEY-----")),
    "github": ("gh", re.compile(r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{22,})")),
    "slack": ("xox", re.compile(r"\bxox[abprs]-[A-Za-z0-9-]{10,}")),
    "google": ("AIza", re.compile(r"\bAIza[A-Za-z0-9_-]{35}")),
    "jwt": ("eyJ", re.compile(r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
}


def rules_version() -> str:
    """Changes with any pattern, so that a ledger never answers for other rules."""
    every = [ASSIGN.pattern, ACCESS.pattern, HEX.pattern, *(f"{k}{w}{p.pattern}" for k, (w, p) in FORMATS.items())]
    return hashlib.sha256("\n".join(every).encode()).hexdigest()[:16]


def find_secrets(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind as listed."""
    if not text:
        return []
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    for kind, (needs, pattern) in FORMATS.items():
        if needs in text:
            found += [(kind, *m.span()) for m in pattern.finditer(text)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


FINDINGS = "array<struct<kind:string,start:int,end:int>>"
LEDGER = f"blob string, rules string, findings {FINDINGS}"


def pack_blobs(batches):
    """Texts -> (blob, compressed text), each blob once a task."""
    seen: set[bytes] = set()
    for batch in batches:
        names, texts = [], []
        for value in batch.column(0):
            data = (value.as_py() or "").encode("utf-8")
            name = hashlib.sha256(data).digest()
            if name not in seen:
                seen.add(name)
                names.append(name.hex())
                texts.append(zlib.compress(data, 1))
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.binary())],
                                         names=["blob", "packed"])


def scan_blobs(rules: str):
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        seen: set[str] = set()
        for batch in batches:
            names, found = [], []
            for name, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                if name not in seen:
                    seen.add(name)
                    names.append(name)
                    found.append([dict(zip(("kind", "start", "end"), s))
                                  for s in find_secrets(zlib.decompress(packed.as_py()).decode("utf-8"))])
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([rules] * len(names), pa.string()), pa.array(found, kind)],
                names=["blob", "rules", "findings"])
    return run


def read_ledger(spark, ledger: str) -> DataFrame | None:
    """The ledger's rows, or None if there is no such table yet."""
    try:
        return spark.read.schema(LEDGER).parquet(ledger)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def scan(docs: DataFrame, ledger: str | None = None, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """``id_col``, ``blob`` and ``findings`` (array of kind, start, end in code
    points, end exclusive) of every row; new blobs are added to ``ledger``, a
    folder that all executors share (default: a new one in the shared folder).

    Null and empty texts are the same blob, without findings.  Null ids and
    repeated rows are kept.  An empty table gives no rows and leaves the ledger as
    it is.  Other columns are not read."""
    spark = docs.sparkSession
    ledger = ledger or shared_dir(spark)
    rules = rules_version()
    text = F.col(f"`{text_col}`")
    copies = docs.select(text.alias("text")).mapInArrow(pack_blobs, "blob string, packed binary") \
        .repartition("blob")
    known = read_ledger(spark, ledger)
    if known is not None:
        copies = copies.join(known.where(F.col("rules") == rules).select("blob"), "blob", "left_anti")
    copies.mapInArrow(scan_blobs(rules), LEDGER).write.mode("append").parquet(ledger)
    known = spark.read.schema(LEDGER).parquet(ledger).where(F.col("rules") == rules) \
        .groupBy("blob").agg(F.min("findings").alias("findings"))  # scans at the same time may each add a blob
    paths = docs.select(F.col(f"`{id_col}`"),
                        F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256).alias("blob"))
    return paths.join(known, "blob").select(f"`{id_col}`", "blob", "findings")


def redact_column(text, findings):
    """A text with every span replaced by ``[kind]`` (overlapping spans: by the first)."""
    state = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    done = F.aggregate(
        findings, state,
        lambda s, x: F.when(x["start"] < s["at"], F.struct(s["out"].alias("out"),
                                                           F.greatest(s["at"], x["end"]).alias("at")))
        .otherwise(F.struct(
            F.concat(s["out"], F.substring(text, s["at"] + 1, x["start"] - s["at"]),
                     F.lit("["), x["kind"], F.lit("]")).alias("out"), x["end"].alias("at"))),
        lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(findings) > 0, done).otherwise(text)
