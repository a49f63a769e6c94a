r"""Secret scan with corpus-wide ownership frequency.

1. Each whole text is searched for the kinds below, left to right and without
   overlap within a kind.  ``assign``, ``access`` and ``hex`` are the base;
   the further kinds are well-known token formats.
2. Every value found is hashed, and the corpus says for each hash in how many
   rows, distinct repositories and distinct owners it stands.
3. A value with ``COPIED_OWNERS`` owners or more is a widely copied example.
   Of the others, those that look drawn at random (length, entropy, kinds of
   characters, no placeholder word) are live-looking; the rest are weak.

Only hashes leave the scan, never values.  A hot value is reduced to its
distinct owners and repositories within each task before any shuffle, and the
join back to the documents is one that AQE can split.

A null text is empty; a null owner or repository counts as one of its own.
Repeated rows are rows of their own.  An empty table gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlens.llm.common import materialized

COPIED_OWNERS = 3
LEAST_LENGTH, LEAST_BITS = 12, 2.8

#: kind, pattern, group that holds the value, least length of that group.
KINDS = (
    ("assign", re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                          re.A), 1, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]{24,}"), 0, 24),  # a run of 24 or more is found whole, as [0-9a-f]+ finds it
    ("jwt", re.compile(r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+"), 0, 0),
    ("pem", re.compile(r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----[A-Za-z0-9+/=\s]*"), 0, 0),
    ("forge", re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}"), 0, 0),
    ("chat", re.compile(r"xox[abprs]-[A-Za-z0-9-]{10,}"), 0, 0),
)
BASE = ("assign", "access", "hex")
PLACEHOLDER = re.compile(r"example|changeme|placeholder|your|dummy|sample|xxxx|1234567|abcdef|(.)\1{5}", re.I)


def bits(value: str) -> float:
    """Entropy of the characters, in bits each."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def looks_live(value: str) -> bool:
    kinds = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]"))
    return (len(value) >= LEAST_LENGTH and kinds >= 2 and bits(value) >= LEAST_BITS
            and not PLACEHOLDER.search(value))


def spans_of(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value), by start, then kind as listed."""
    found = []
    for order, (kind, pattern, group, least) in enumerate(KINDS):
        found += [(m.start(), order, kind, m.end(), m[group]) for m in pattern.finditer(text) if len(m[group]) >= least]
    return [(kind, start, end, value) for start, _, kind, end, value in sorted(found)]


def joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end, _ in spans)


SCANNED = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
           "owner string, repo string, found array<struct<hash:binary,live:boolean>>")


def scan(docs: DataFrame, owner: Column, repo: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with its spans and the hashes of its values."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       owner.cast("string").alias("owner"), repo.cast("string").alias("repo"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()),
                        ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string()),
                        ("owner", pa.string()), ("repo", pa.string()),
                        ("found", pa.list_(pa.struct([("hash", pa.binary()), ("live", pa.bool_())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, own, rep in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                spans = spans_of(text or "")
                base = [s for s in spans if s[0] in BASE]
                n = Counter(s[0] for s in spans)
                out.append({"doc_id": doc_id, **{f"n_{k}": n[k] for k in BASE},
                            "base_sha256": hashlib.sha256(joined(base).encode()).hexdigest(), "spans": joined(spans),
                            "owner": own, "repo": rep,
                            "found": [{"hash": hashlib.blake2b(v.encode("utf-8", "surrogatepass"), digest_size=16).digest(),
                                       "live": looks_live(v)} for v in sorted({s[3] for s in spans})]})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return rows.mapInArrow(run, SCANNED)


def ownership(values: DataFrame) -> DataFrame:
    """(hash, n_rows, n_repos, n_owners, verdict) per value of ``values(hash, live, owner, repo)``."""
    # A row per value, owner and repository first: partial sums take a hot value's rows within each task.
    pairs = values.groupBy("hash", "owner", "repo").agg(F.count(F.lit(1)).alias("n_rows"),
                                                        F.max("live").alias("live"))
    owners = pairs.groupBy("hash", "owner").agg(F.sum("n_rows").alias("n_rows"), F.count(F.lit(1)).alias("n_repos"),
                                                F.max("live").alias("live"))
    whole = owners.groupBy("hash").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_repos").alias("n_repos"),
                                       F.count(F.lit(1)).alias("n_owners"), F.max("live").alias("live"))
    return whole.withColumn("verdict", F.when(F.col("n_owners") >= COPIED_OWNERS, "copied")
                            .when(F.col("live"), "live").otherwise("weak"))


def secret_scan(docs: DataFrame, owner: Column, repo: Column, id_col: str = "doc_id",
                text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents with spans and counts by verdict, values with their frequency)."""
    scanned = materialized(scan(docs, owner, repo, id_col, text_col)
                           .withColumn("row_no", F.monotonically_increasing_id()), "secret-spans")
    values = scanned.where(F.size("found") > 0).select("row_no", "owner", "repo", F.explode("found").alias("f")).select(
        "row_no", "owner", "repo", "f.hash", "f.live")
    known = materialized(ownership(values), "secret-values")
    per_row = values.select("row_no", "hash").join(known.select("hash", "verdict"), "hash").groupBy("row_no").agg(
        *[F.count_if(F.col("verdict") == v).alias(f"n_{v}") for v in ("live", "copied", "weak")])
    docs_out = scanned.drop("owner", "repo", "found").join(per_row, "row_no", "left").drop("row_no")
    return docs_out.fillna(0, ["n_live", "n_copied", "n_weak"]), known
