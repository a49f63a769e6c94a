"""Exact dedup by content-defined chunk recipes.

Every text is normalised (each run of ASCII white space becomes one space) and
cut into chunks where its own content says so: after at least ``MIN_CHUNK``
characters at the first cut mark (every other one of eleven characters is
ASCII with a code of 1 modulo 4, once in a thousand characters or so), or
after ``MAX_CHUNK``.  An edit therefore changes the chunks around it and
leaves the others as they are.

1. *Catalogue.*  The distinct chunks of the corpus are gathered once, grouped
   by their own text.  This is the only time that text moves; a chunk that is
   copied a million times is reduced within each task first.
2. *Verified identifiers.*  A chunk's identifier is its 64-bit hash, its
   length and an ordinal.  The catalogue shows which hashes stand for several
   texts; only the chunks of those get an ordinal above 0.  So two chunks have
   one identifier if and only if their texts are equal.
3. *Recipes.*  A document is the ordered list of its identifiers.  Equal texts
   are equal lists: documents are grouped by list, and only lists move.

Nulls count as empty texts; empty texts are equal to each other.  A null id
sorts last.  Of rows that share the smallest id one stays.  An empty table
gives an empty result.  Extra columns are ignored.

The main path is DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlens.llm.common import broadcast_if_small, keep_rows, materialized

MIN_CHUNK = 256
MAX_CHUNK = 8192
#: Texts of collided chunks up to this number are broadcast (some 8 MB at most); more are joined by shuffle.
MAX_BROADCAST_CHUNKS = 1000


def cut_mark(residue: int = 1, modulus: int = 4) -> str:
    """Regex class of the printable ASCII characters with this residue."""
    return "[" + "".join(f"\\x{c:02X}" for c in range(0x20, 0x7F) if c % modulus == residue) + "]"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def chunks_of(norm: Column) -> Column:
    """Array of chunks whose concatenation is ``norm``; a short text is one chunk."""
    mark = ".".join([cut_mark()] * 6)
    pattern = f"(?s).{{{MIN_CHUNK - 11},{MAX_CHUNK - 11}}}?{mark}|.{{1,{MAX_CHUNK}}}"
    return (F.when(F.octet_length(norm) <= MIN_CHUNK, F.array(norm))
            .otherwise(F.regexp_extract_all(norm, F.lit(pattern), F.lit(0))))


def chunk_hash(chunk: Column, hash_bits: int) -> Column:
    h = F.xxhash64(chunk)
    return h if hash_bits >= 64 else F.pmod(h, F.lit(1 << hash_bits).cast("long"))


def ordinals(docs: DataFrame, text_col: str, hash_bits: int) -> DataFrame | None:
    """(h, n, chunk, k): every chunk text that is not the first one of its hash and length.

    None if no hash stands for two texts, which is what a 64-bit hash gives on
    all but enormous corpora.
    """
    norm = docs.select(normalised(F.col(text_col)).alias("norm"))
    catalogue = (norm.select(F.explode(chunks_of(F.col("norm"))).alias("chunk"))
                 .groupBy("chunk").agg(F.count(F.lit(1)).alias("uses")))
    keyed = catalogue.select(chunk_hash(F.col("chunk"), hash_bits).alias("h"), F.length("chunk").alias("n"), "chunk")
    clashes = materialized(keyed.groupBy("h", "n").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1"),
                           "chunk-clashes")
    if clashes.isEmpty():
        return None
    rank = F.row_number().over(Window.partitionBy("h", "n").orderBy("chunk")) - 1
    texts = keyed.join(clashes.select("h", "n"), ["h", "n"], "left_semi").withColumn("k", rank)
    return materialized(texts.where("k > 0"), "chunk-ordinals")


def recipes(docs: DataFrame, id_col: str, text_col: str, hash_bits: int = 64) -> DataFrame:
    """One stored row per document with its list of verified chunk identifiers."""
    later = ordinals(docs, text_col, hash_bits)
    base = docs.select(
        F.monotonically_increasing_id().alias("row_no"), F.col(id_col).alias("doc_id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("raw_hash"),
        normalised(F.col(text_col)).alias("norm"))
    base = base.select("row_no", "doc_id", "raw_hash", F.sha2("norm", 256).alias("text_sha256"),
                       chunks_of(F.col("norm")).alias("chunks"))
    own = ["row_no", "doc_id", "raw_hash", "text_sha256"]
    if later is None:
        listed = base.select(*own, F.transform("chunks", lambda c: F.struct(
            chunk_hash(c, hash_bits).alias("h"), F.length(c).alias("n"), F.lit(0).alias("k"))).alias("recipe"))
    else:
        parts = base.select(*own, F.posexplode("chunks").alias("pos", "chunk")).withColumns({
            "h": chunk_hash(F.col("chunk"), hash_bits), "n": F.length("chunk")})
        parts = parts.join(broadcast_if_small(later, MAX_BROADCAST_CHUNKS), ["h", "n", "chunk"], "left")
        listed = parts.groupBy(*own).agg(F.sort_array(F.collect_list(
            F.struct("pos", "h", "n", F.coalesce("k", F.lit(0)).alias("k")))).alias("parts")).select(
            *own, F.transform("parts", lambda p: F.struct(p["h"].alias("h"), p["n"].alias("n"),
                                                          p["k"].alias("k"))).alias("recipe"))
    return materialized(listed, "recipes")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_bits: int = 64) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, raw_hash.

    ``hash_bits`` below 64 makes hashes collide, for tests of the verification.
    """
    listed = recipes(docs, id_col, text_col, hash_bits)
    groups = materialized(listed.groupBy("recipe").agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("copies"),
        F.coalesce(F.min_by("row_no", "doc_id"), F.min("row_no")).alias("keep_row")).where("copies > 1"), "copies")
    # Only texts that occur again need a partner.  Both sides are stored, so AQE can split the rows of a hot group.
    joined = listed.join(groups, "recipe", "left")
    return joined.select(
        "doc_id",
        F.when(F.col("copies").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("copies", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("row_no") == F.col("keep_row"), F.lit(True)).alias("kept"),
        "text_sha256", "raw_hash")


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that stay."""
    kept = exact_dedup(docs, id_col, text_col).where("kept")
    keep = materialized(kept.select(F.col("doc_id").alias("keep_id"), F.col("raw_hash").alias("keep_text")), "kept")
    return keep_rows(docs, keep, id_col, text_col)
