"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

Both tokenizers encode a space and the text.  A text is cut into chunks, in
front of spaces at which tokens of both sides begin, and each distinct chunk
that a task meets is encoded and aligned once (so long as it keeps it); a
document has the sums of its chunks.  Within a batch of chunks the tokens of
each side lie end to end on one line of bytes, keyed by chunk.  Two
``pandas.merge_asof`` calls find, for the start of each token, the other
side's token that covers it; the union of both directions are the links
(pairs of tokens whose byte ranges overlap), where a pair with equal starts is
found twice and counted once.  Offsets at which tokens of both sides end cut
the text into groups.

An id pair's count is the number of links in the whole corpus that hold it.
Tasks store their documents in blocks of about ``BLOCK_CHARS`` characters,
each with its distinct id pairs once and the links as places in that list, in
two bytes each where the list is short enough.
Spark adds up the pairs over all blocks, finds the highest count of each B id,
and sends each block the counts of its own pairs by joins on pair and block:
no table of all pairs is broadcast or held by one task, and a frequent pair
arrives once a block.

Longer texts are handled in pieces of about ``PIECE_CHARS`` characters, cut
between chunks.  A null or empty text, and one that either side's tokens do
not spell, has no tokens: zeros and an empty ``groups_sha256``.  Repeated rows
count each; null ids stay.  An empty table gives an empty result.  Extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlens.llm.common import materialized
from leadlens.llm.encoding import Ragged, SpelledEncoder, byte_encoder, per_worker, piece_encoder, pieces, spaced_chunks
from leadlens.sources.tables import settings

PIECE_CHARS = 1 << 19
BLOCK_CHARS = 1 << 20
#: Chunks that a task keeps from block to block, at some 300 bytes each; with more it begins anew.
MOST_CHUNKS = 200_000
#: Documents that a worker gets at a time, and blocks that a task of the last step handles.
BATCH_ROWS, TASK_BLOCKS, MAX_TASKS = 500, 4, 20_000

COUNTS = ("n_a", "n_b", "n_groups", "n_links")
DOCS = ("array<struct<doc_id:bigint,n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,groups_sha256:string>>")
BLOCKS = f"block string, docs {DOCS}, pairs array<bigint>, counts array<bigint>, links binary"
ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
           "groups_sha256 string")


class Side:
    """One tokenizer: its encoder, the length of each id in bytes, and each id as text with the signs behind it."""

    def __init__(self, encoder: SpelledEncoder):
        self.encoder, self.sizes = encoder, encoder.bytes.sizes
        n = range(len(encoder.spelled))
        self.comma, self.bar, self.semicolon = (np.array([f"{i}{s}" for i in n], object) for s in ",|;")


class Tokens:
    """The tokens of one side in a batch of pieces: ids, and byte ranges on one line over all pieces."""

    def __init__(self, side: Side, ids: np.ndarray, n: np.ndarray):
        self.n, self.ids = n, ids.astype(np.int64)
        self.end = np.cumsum(side.sizes[self.ids])
        self.start = self.end - side.sizes[self.ids]
        self.piece = np.repeat(np.arange(len(n)), n)

    def frame(self) -> pd.DataFrame:
        return pd.DataFrame({"start": self.start, "piece": self.piece, "token": np.arange(len(self.ids))})


def links_of(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """All (A token, B token) whose byte ranges overlap, ordered by A token and then B token."""
    left, right = a.frame(), b.frame()
    over_a = pd.merge_asof(left[["start", "piece"]], right, on="start", by="piece")["token"].to_numpy(np.int64)
    over_b = pd.merge_asof(right[["start", "piece"]], left, on="start", by="piece")["token"].to_numpy(np.int64)
    new = a.start[over_b] != b.start  # equal starts are in the first direction
    pairs_a = np.concatenate([left["token"].to_numpy(), over_b[new]])
    pairs_b = np.concatenate([over_a, right["token"].to_numpy()[new]])
    # A's tokens ascend with B's along the text, so one number orders the links.
    order = np.argsort(pairs_a + pairs_b, kind="stable")
    return pairs_a[order], pairs_b[order]


def group_texts(a: Tokens, b: Tokens, one: Side, two: Side) -> tuple[np.ndarray, list[str]]:
    """(number of groups, ``a1,a2|b1;a3|b2,b3`` with a last ``;``) of each piece."""
    ends_a = np.isin(a.end, b.end, assume_unique=True)
    ends_b = np.isin(b.end, a.end, assume_unique=True)
    last_a, last_b = np.flatnonzero(ends_a), np.flatnonzero(ends_b)
    group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
    out = np.empty(len(a.ids) + len(b.ids), object)
    out[np.arange(len(a.ids)) + np.r_[0, last_b + 1][group_a]] = np.where(ends_a, one.bar[a.ids], one.comma[a.ids])
    out[np.arange(len(b.ids)) + last_a[group_b] + 1] = np.where(ends_b, two.semicolon[b.ids], two.comma[b.ids])
    ends = np.cumsum(a.n + b.n).tolist()
    signs = out.tolist()
    texts = ["".join(signs[s:e]) for s, e in zip([0, *ends], ends, strict=False)]
    return np.bincount(a.piece[ends_a], minlength=len(a.n)), texts


class Numbers(dict):
    """The number of each chunk, in the order they are met; ``waiting`` has those met since it was emptied."""

    def __init__(self):
        super().__init__()
        self.waiting: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self.waiting.append(chunk)
        self[chunk] = n = len(self)
        return n


class Numbers(dict):
    """The number of each chunk, in the order they are met; ``waiting`` has those met since it was emptied."""

    def __init__(self):
        super().__init__()
        self.waiting: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self.waiting.append(chunk)
        self[chunk] = n = len(self)
        return n


class Doc:
    """A document and the numbers of its chunks, piece by piece."""

    def __init__(self, doc_id: int | None):
        self.doc_id, self.sha256 = doc_id, ""
        self.n = dict.fromkeys(COUNTS, 0)
        self.chunks: list[np.ndarray] = []

    def row(self) -> dict:
        return {"doc_id": self.doc_id, **self.n, "groups_sha256": self.sha256}


class Chunks:
    """Distinct chunks of texts, each aligned once however often it occurs."""

    def __init__(self, one: Side, two: Side):
        self.one, self.two, self.numbers = one, two, Numbers()
        self.texts: list[str] = []
        self.plain, self.n, self.pairs = np.zeros(0, bool), np.zeros((len(COUNTS), 0), np.int64), np.zeros(0, np.int64)

    def numbered(self, text: str) -> np.ndarray:
        chunks = spaced_chunks(text)
        return np.fromiter(map(self.numbers.__getitem__, chunks), np.int32, len(chunks))

    def align(self) -> None:
        """Align the chunks met since the last call; on both sides the tokens of a chunk begin and end in it."""
        chunks, self.numbers.waiting = self.numbers.waiting, []
        if not chunks:
            return
        (ids_a, n_a, plain), (ids_b, n_b, plain_b) = self.one.encoder.each(chunks), self.two.encoder.each(chunks)
        plain &= plain_b
        good = np.flatnonzero(plain)
        n, texts = np.zeros((len(COUNTS), len(chunks)), np.int64), [""] * len(chunks)
        if len(good):
            a = Tokens(self.one, ids_a[np.repeat(plain, n_a)], n_a[good])
            b = Tokens(self.two, ids_b[np.repeat(plain, n_b)], n_b[good])
            left, right = links_of(a, b)
            groups, own = group_texts(a, b, self.one, self.two)
            n[:, good] = a.n, b.n, groups, np.bincount(a.piece[left], minlength=len(good))
            self.pairs = np.concatenate([self.pairs, a.ids[left] << 32 | b.ids[right]])
            if len(good) == len(chunks):
                texts = own
            else:
                for i, text in zip(good.tolist(), own, strict=True):
                    texts[i] = text
        self.texts += texts
        self.plain, self.n = np.concatenate([self.plain, plain]), np.concatenate([self.n, n], 1)

    def block(self, docs: list[Doc]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(distinct pairs, how many links hold each, each link's place among them) of the documents, which are filled in."""
        met = []
        for doc in docs:
            # A text that either side's tokens don't spell has no tokens.
            if not all(self.plain[x].all() for x in doc.chunks):
                continue
            digest = hashlib.sha256()
            for k, x in enumerate(doc.chunks):
                for name, v in zip(COUNTS, self.n[:, x].sum(1).tolist(), strict=True):
                    doc.n[name] += v
                digest.update(f"{';' * (k > 0)}{''.join(map(self.texts.__getitem__, x.tolist()))[:-1]}".encode())
                met.append(x)
            if doc.chunks:
                doc.sha256 = digest.hexdigest()
        chunks = np.concatenate(met) if met else np.zeros(0, np.int32)
        held = np.zeros(len(self.texts), bool)
        held[chunks] = True
        of = self.n[COUNTS.index("n_links")]
        own, which = np.unique(Ragged.of(self.pairs, of).taken(np.flatnonzero(held))[0], return_inverse=True)
        links = Ragged.of(which.astype(np.int32), of[held]).taken((np.cumsum(held) - 1)[chunks])[0]
        return own, np.bincount(links, minlength=len(own)), links


def place_type(n_pairs: int) -> str:
    """How the links of a block with so many distinct pairs are packed."""
    return "<u2" if n_pairs <= 1 << 16 else "<i4"


def aligned_blocks(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
                   block_chars: int = BLOCK_CHARS, piece_chars: int = PIECE_CHARS, most_chunks: int = MOST_CHUNKS) -> DataFrame:
    """A row per block: its documents, its distinct id pairs and their counts, and the links as places among them."""
    fields = [("doc_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("groups_sha256", pa.string())]
    schema = pa.schema([("block", pa.string()), ("docs", pa.list_(pa.struct(fields))), ("pairs", pa.list_(pa.int64())),
                        ("counts", pa.list_(pa.int64())), ("links", pa.binary())])

    def stored(found: list[Doc], chunks: Chunks) -> pa.RecordBatch:
        chunks.align()
        pairs, counts, links = chunks.block(found)
        return pa.RecordBatch.from_arrays([
            pa.array([uuid.uuid4().hex]), pa.array([[d.row() for d in found]], schema.field("docs").type),
            pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), pa.array(pairs, pa.int64())),
            pa.ListArray.from_arrays(pa.array([0, len(counts)], pa.int32()), pa.array(counts, pa.int64())),
            pa.array([links.astype(place_type(len(pairs))).tobytes()], pa.binary())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = per_worker(f"A {path_a}", lambda: Side(byte_encoder(path_a)))
        two = per_worker(f"B {path_b}", lambda: Side(piece_encoder(path_b)))
        found, chunks, chars, held = [], Chunks(one, two), 0, 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py() or ""
                doc = Doc(doc_id)
                found.append(doc)
                chars += len(text)
                for p in pieces(" " + text, piece_chars) if text else ():
                    doc.chunks.append(chunks.numbered(p))
                    held += len(p)
                    if held >= piece_chars:
                        chunks.align()
                        held = 0
                if chars >= block_chars:
                    yield stored(found, chunks)
                    found, chars, held = [], 0, 0
                    if len(chunks.numbers) > most_chunks:
                        chunks = Chunks(one, two)
        if found:
            yield stored(found, chunks)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # Batches of Spark's default size would hold tens of MB of text, in the JVM and in the worker.
    with settings(docs.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_ROWS}):
        return materialized(rows.mapInArrow(run, BLOCKS), "aligned-blocks")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, count, best): pair is A id << 32 | B id; best where no pair of the same B id has a higher count."""
    own = blocks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p")).select("p.pairs", "p.counts")
    known = materialized(own.groupBy(F.col("pairs").alias("pair")).agg(F.sum("counts").alias("count")), "pair-counts")
    low = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    highest = known.groupBy(low.alias("b")).agg(F.max("count").alias("highest"))
    return known.join(highest, low == F.col("b")).select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
            block_chars: int = BLOCK_CHARS, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each document."""
    blocks = aligned_blocks(docs, path_a, path_b, id_col, text_col, block_chars, piece_chars)
    known = materialized(pair_counts(blocks), "pair-best")
    asked = blocks.select("block", F.posexplode("pairs").alias("place", "pair"))
    # Each block gets its pairs' counts in the order of its list; so many tasks that each handles a few blocks.
    parts = min(MAX_TASKS, max(1, math.ceil(blocks.count() / TASK_BLOCKS)))
    answers = asked.join(known, "pair").select("block", "place", "count", "best").repartition(parts, "block").groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("place", "count", "best"))).alias("known"))
    rows = blocks.repartition(parts, "block").join(answers, "block", "left").select("docs", "links", F.col("known.count").alias("count"), F.col("known.best").alias("best"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, links, count, best in zip(*batch.columns, strict=True):
                own = pa.RecordBatch.from_struct_array(own.values) if len(own) else None
                if own is None:
                    continue
                at = np.frombuffer(links.as_py(), place_type(len(count) if count.is_valid else 0))
                n = own.column("n_links").to_numpy()
                sums = [np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)]
                if len(at):
                    has = np.flatnonzero(n)
                    starts = (np.cumsum(n) - n)[has]
                    for total, values in zip(sums, (best, count), strict=True):
                        values = values.values.to_numpy(zero_copy_only=False).astype(np.int64)
                        total[has] = np.add.reduceat(values[at], starts)
                yield pa.RecordBatch.from_arrays([
                    own.column("doc_id"), *(own.column(c) for c in COUNTS), pa.array(sums[0]), pa.array(sums[1]),
                    own.column("groups_sha256")],
                    names=["doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256"])

    return rows.mapInArrow(run, ALIGNED)
