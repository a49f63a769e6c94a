"""Token ids in a binary format that is compressed by a Re-Pair grammar and decodes at any place.

Encoding: each task turns its texts into ids and appends the end id to each
document; they are stored and shuffled in two bytes an id where all ids of the
tokenizer fit.  The documents are then dealt out by ranges of (id, text hash) and
sorted, and each task writes one file of blocks.  A block holds whole
documents of about ``BLOCK_TOKENS`` ids (or one longer one).  In it, frequent
pairs of neighbouring symbols are replaced by new symbols, round after round:
a round counts all pairs, takes those of at least a sixteenth of the greatest
count, replaces them by descending count where they overlap, and the rounds
end when no pair occurs ``LEAST_COUNT`` times or ``MOST_RULES`` are made (both
only weigh size against time: decoding gives the ids back in any case).  No
rule reaches over the end of a document.

A block stores its rules (two symbols each), the number of ids each expands
to, its symbols, and for each document its id, its first symbol, its number
of ids and their CRC-32.  So any stretch of any document is decoded from its
own symbols: a running sum of the expansion lengths finds them.

Spark stores an index row per block (file, offset, length, part, block,
documents, tokens), so only files of committed task attempts are referenced.
Positions in the whole corpus are running sums over parts and blocks.

A null text counts as empty and has the end id only.  A null id sorts first
and stays null.  Rows that repeat an id are ordered by text hash and ids; equal
rows stay, each with ids of its own.  A hot id is split by the hash.  An empty
table gives an empty index and result.  Extra columns are ignored.
"""

from __future__ import annotations

import math
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadlens.llm.common import materialized
from leadlens.llm.encoding import PIECE_CHARS, json_tokenizer, per_worker, pieces, word_encoder
from leadlens.session import checkpoint_dir

BLOCK_TOKENS = 1 << 21
MOST_RULES = 16_000
LEAST_COUNT = 8
#: A round takes the pairs of at least this part of the greatest count.
STEP = 16
SLOT_BITS = 18
#: From this share of positions on at which no pair can be replaced any more, the others are handled by themselves.
MOST_BARRED = 0.4
#: That needs tables of its own, which so few symbols don't repay.
LEAST_LINKED = 1 << 14
#: Bytes of ids that a task sorts and writes.
PART_BYTES = 16 << 20
#: Bytes of text that are split at once; each byte takes some 20 in memory meanwhile.
GROUP_BYTES = 4 << 20
#: So many such groups share their distinct words; each byte takes some 3 more in memory meanwhile.
GROUPS = 4
MAGIC = b"RPG1"
HEAD = "<4sIQIIB"  # magic, documents, symbols, rules, first rule's symbol, bytes of a symbol

INDEX = "file string, offset long, length long, part int, block int, n_docs long, n_tokens long"
TOKENS = "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"


# The grammar of a block.

#: Places are always within their array; told to clip, numpy takes them at once instead of checking them first.
take = partial(np.take, mode="clip")

def slots(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hash slot of each pair of neighbours."""
    mixed = left * np.uint32(0x9E3779B1)
    mixed += right
    mixed *= np.uint32(0x85EBCA6B)
    mixed >>= np.uint32(32 - SLOT_BITS)
    return mixed.astype(np.int64)


def frequent_pairs(seq: np.ndarray, barred: np.ndarray, slot: np.ndarray, bound: np.ndarray, least: int,
                   most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pairs, positions, their ranks): pairs of at least one part in ``STEP`` of the greatest count, most frequent first.

    ``slot`` has the slot of each pair and ``bound`` how many each slot has: upper bounds, and only pairs in slots with
    enough of them are counted one by one.  No pair begins at a symbol that is ``barred``; pairs that are counted here and
    occur less than ``least`` times are barred as well, since a pair of symbols that exist never becomes more frequent.
    """
    want = max(least, int(bound.max(initial=0)) // STEP)
    free = np.flatnonzero(~barred[:len(slot)])
    own = take(slot, free)
    while True:
        at = take(free, np.flatnonzero(take(bound >= want, own)))
        pairs, n, places = counted(take(seq, at), take(seq, at + 1), at)
        barred[places[np.repeat(n < least, n)]] = True
        if len(n) and n.max() >= want:
            break
        if want == least:
            return pairs[:0], at[:0], at[:0]
        want = max(least, want // STEP)
    return ranked(pairs, n, places, want, most)


def ranked(pairs: np.ndarray, n: np.ndarray, places: np.ndarray, want: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pairs, positions, their ranks): those that occur ``want`` times, most frequent first; positions in order."""
    order = np.lexsort((pairs, -n))
    order = order[n[order] >= want][:most]
    of = np.full(len(pairs), -1, np.int32)
    of[order] = np.arange(len(order))
    rank = np.repeat(of, n)
    size = int(places.max(initial=-1)) + 1
    if len(places) * 8 > size:
        # So many are in order sooner by a table of all positions.
        of = np.full(size, -1, np.int32)
        of[places] = rank
        at = np.flatnonzero(of >= 0)
        return pairs[order], at, take(of, at)
    wanted = np.flatnonzero(rank >= 0)
    # One sort of (place, rank) as numbers brings the places back in order.
    both = take(places, wanted)
    both <<= 20
    both |= take(rank, wanted)
    both.sort()
    return pairs[order], both >> 20, both & ((1 << 20) - 1)


def counted(left: np.ndarray, right: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct pairs of ``left`` and ``right``, which are at ``at``, how often each occurs, the places pair by pair)."""
    narrow = at.max(initial=0) < 1 << 31 and max(left.max(initial=0), right.max(initial=0)) < 1 << 16
    if narrow:
        # Pair and place fit in one number, which sorts far faster than the places by their pairs.
        both = left.astype(np.int64)
        both <<= 16
        both |= right
        both <<= 31
        both |= at
        both.sort()
        key, places = both >> 31, both & ((1 << 31) - 1)
    else:
        key = left.astype(np.uint64) << np.uint64(32) | right
        order = np.argsort(key, kind="stable")
        key, places = key[order], at[order]
    begins = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    pairs = key[begins].astype(np.uint64)
    if narrow:
        pairs = pairs >> np.uint64(16) << np.uint64(32) | pairs & np.uint64(0xFFFF)
    return pairs, np.diff(np.r_[begins, len(key)]), places


def chosen(at: np.ndarray, rank: np.ndarray, behind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions to replace and their ranks: none overlap, the more frequent pair wins, in a run of one symbol every second.

    ``behind`` has the position of the second symbol of each.
    """
    same = np.flatnonzero((at[1:] == behind[:-1]) & (rank[1:] == rank[:-1])) + 1
    if len(same):
        # Places behind the first of a run: the first, third and so on of them go.
        run = np.arange(len(same))
        begins = np.maximum.accumulate(np.where(np.diff(same, prepend=-1) == 1, 0, run))
        stay = np.ones(len(at), bool)
        stay[same[(run - begins) % 2 == 0]] = False
        stay = np.flatnonzero(stay)
        at, rank, behind = take(at, stay), take(rank, stay), take(behind, stay)
    taken = []
    while len(at):
        near = np.flatnonzero(at[1:] == behind[:-1])
        more = take(rank, near) < take(rank, near + 1)
        # No two neighbours have the same rank any more.
        best = np.ones(len(at), bool)
        best[near[~more]] = False
        best[near[more] + 1] = False
        which = np.flatnonzero(best)
        taken.append((take(at, which), take(rank, which)))
        gone = best.copy()
        gone[near] |= best[near + 1]
        gone[near + 1] |= best[near]
        which = np.flatnonzero(~gone)
        at, rank, behind = take(at, which), take(rank, which), take(behind, which)
    if not taken:
        return at, rank
    return np.concatenate([x for x, _ in taken]), np.concatenate([x for _, x in taken])


def grammar(ids: np.ndarray, ends: np.ndarray, most: int = MOST_RULES,
            least: int = LEAST_COUNT) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(symbols, document of each symbol's end as positions, rules, first new symbol) for ``ids`` and documents' ends.

    ``ends`` holds the number of ids up to each document's end; the second result the same in symbols.
    """
    seq, last = ids.astype(np.uint32), np.zeros(len(ids), bool)
    last[ends - 1] = True
    first = int(ids.max(initial=0)) + 1
    rules: list[np.ndarray] = []
    made = 0
    slot = slots(seq[:-1], seq[1:])
    bound = np.bincount(slot, minlength=1 << SLOT_BITS)
    # Where no pair begins that can be replaced, now or later: at documents' ends and at pairs known to be too rare.
    barred = last.copy()
    barred[:-1] |= take(bound < least, slot)
    while made < most and len(seq) > 1 and (len(seq) < LEAST_LINKED or np.count_nonzero(barred) < MOST_BARRED * len(seq)):
        pairs, at, rank = frequent_pairs(seq, barred, slot, bound, least, most - made)
        pairs, at, name = worthwhile(pairs, *chosen(at, rank, at + 1))
        if not len(pairs):
            break
        rules.append(pairs)
        seq[at] = first + made + name
        last[at] = last[at + 1]
        stay = np.ones(len(seq), bool)
        stay[at + 1] = False
        stay = np.flatnonzero(stay)
        # Only the pairs that begin at a replaced symbol, in front of it or behind it have another slot now.
        new = np.zeros(len(seq), bool)
        new[at] = new[at + 1] = new[np.maximum(at - 1, 0)] = True
        bound -= np.bincount(take(slot, np.flatnonzero(new[:-1])), minlength=1 << SLOT_BITS)
        # By place, which is several times as fast as by a mask.
        seq, last, barred = take(seq, stay), take(last, stay), take(barred, stay)
        slot = take(slot, stay[:len(seq) - 1])
        new = np.flatnonzero(take(new, stay[:len(seq) - 1]))
        slot[new] = own = slots(seq[new], seq[new + 1])
        bound += np.bincount(own, minlength=1 << SLOT_BITS)
        barred[new] = last[new] | take(bound < least, own)
        made += len(pairs)
    else:
        seq, last, more = linked_rounds(seq, last, np.flatnonzero(~barred[:-1]), first + made, least, most - made)
        rules += more
    return seq, np.flatnonzero(last) + 1, np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32), first


def worthwhile(pairs: np.ndarray, at: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rules, positions, the number of the rule at each): the pairs that have two positions left."""
    worth = np.bincount(rank, minlength=len(pairs)) >= 2
    which = np.flatnonzero(take(worth, rank))
    name = np.cumsum(worth) - 1
    rules = np.stack([pairs[worth] >> np.uint64(32), pairs[worth] & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32)
    return rules, take(at, which), take(name, take(rank, which)).astype(np.uint32)


def linked_rounds(seq: np.ndarray, last: np.ndarray, free: np.ndarray, first: int, least: int,
                  most: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(symbols, whether each ends a document, rules) after further rounds, for few positions ``free`` where pairs to replace begin.

    Symbols stay where they are and are linked, so that a round handles the free positions only, whose pairs it counts exactly.
    """
    behind, before, gone = np.arange(1, len(seq) + 1), np.arange(-1, len(seq) - 1), np.zeros(len(seq), bool)
    rules: list[np.ndarray] = []
    made = 0
    while made < most and len(free):
        pairs, n, places = counted(take(seq, free), take(seq, take(behind, free)), free)
        if n.max() < least:
            break
        free = np.zeros(len(seq), bool)
        free[places[np.repeat(n >= least, n)]] = True
        pairs, at, rank = ranked(pairs, n, places, max(least, int(n.max()) // STEP), most - made)
        pairs, at, name = worthwhile(pairs, *chosen(at, rank, take(behind, at)))
        if not len(pairs):
            break
        rules.append(pairs)
        right = take(behind, at)
        far = take(behind, right)
        seq[at], last[at], behind[at], gone[right] = first + made + name, take(last, right), far, True
        inner = np.flatnonzero(far < len(seq))
        before[far[inner]] = at[inner]
        new = np.concatenate([at, before[at]])
        new = new[new >= 0]
        free[right] = False
        free[new] = ~last[new]
        free = np.flatnonzero(free)
        made += len(pairs)
    stay = np.flatnonzero(~gone)
    return take(seq, stay), take(last, stay), rules


def lengths(rules: np.ndarray, first: int) -> np.ndarray:
    """How many ids each rule expands to."""
    out: list[int] = []
    for a, b in rules.tolist():
        out.append((out[a - first] if a >= first else 1) + (out[b - first] if b >= first else 1))
    return np.array(out, np.int64)


def expansions(rules: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids of all rules one after the other, where each rule's begin, how many it has)."""
    out: list[bytes] = []
    for a, b in rules.tolist():
        out.append((out[a - first] if a >= first else a.to_bytes(4, "little")) + (out[b - first] if b >= first else b.to_bytes(4, "little")))
    n = np.array([len(x) // 4 for x in out], np.int64)
    return np.frombuffer(b"".join(out), "<u4"), np.cumsum(n) - n, n


def write_block(doc_ids: list[int | None], docs: list[np.ndarray]) -> bytes:
    """A block of documents, given as arrays of ids (none empty)."""
    sizes = np.array([len(d) for d in docs], np.int64)
    ids = np.concatenate(docs)
    seq, ends, rules, first = grammar(ids, np.cumsum(sizes))
    n = lengths(rules, first)
    width = 2 if first + len(rules) <= 1 << 16 else 4
    known = np.array([d is not None for d in doc_ids], np.uint8)
    crcs = np.array([zlib.crc32(d.astype("<u4", copy=False)) for d in docs], "<u4")
    return b"".join([struct.pack(HEAD, MAGIC, len(docs), len(seq), len(rules), first, width),
                     np.array([d or 0 for d in doc_ids], "<i8").tobytes(), known.tobytes(), ends.astype("<i8").tobytes(),
                     sizes.astype("<i8").tobytes(), crcs.tobytes(), rules.astype("<u4").tobytes(),
                     n.astype("<i8").tobytes(), seq.astype(f"<u{width}").tobytes()])


class Block:
    """A stored block; documents are numbered as they were written."""

    def __init__(self, raw: bytes):
        magic, docs, symbols, rules, self.first, width = struct.unpack_from(HEAD, raw)
        if magic != MAGIC:
            raise ValueError("not a block of token ids")
        at = struct.calcsize(HEAD)

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, n, at)
            at += out.nbytes
            return out

        ids, known = take("<i8", docs), take("u1", docs)
        self.doc_ids = [i if k else None for i, k in zip(ids.tolist(), known.tolist(), strict=True)]
        self.ends, self.sizes, self.crcs = take("<i8", docs), take("<i8", docs), take("<u4", docs)
        self.rules, self.lengths = take("<u4", 2 * rules).reshape(-1, 2), take("<i8", rules)
        self.symbols = take(f"<u{width}", symbols)
        self.spelled = None

    def sizes_of(self, symbols: np.ndarray) -> np.ndarray:
        """The number of ids behind each symbol."""
        out = np.ones(len(symbols), np.int64)
        made = symbols >= self.first
        out[made] = self.lengths[symbols[made].astype(np.int64) - self.first]
        return out

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        if self.spelled is None:
            flat, begins, _ = expansions(self.rules, self.first)
            # The ids below the first rule's symbol stand for themselves.
            at = np.concatenate([np.arange(self.first), self.first + begins, [self.first + len(flat)]]) * 4
            data = np.concatenate([np.arange(self.first, dtype="<u4"), flat])
            self.spelled = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(data)])
        found = self.spelled.take(pa.array(symbols))
        _, at, data = found.buffers()
        size = int(np.frombuffer(at, np.int64)[len(found)]) if len(found) else 0
        return np.frombuffer(data or b"", "<u4", size // 4)

    def own(self, doc: int) -> np.ndarray:
        return self.symbols[self.ends[doc - 1] if doc else 0:self.ends[doc]]

    def ids(self, doc: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """The ids ``start`` to ``stop`` of a document, from the symbols that cover them alone."""
        symbols = self.own(doc)
        stop = int(self.sizes[doc]) if stop is None else min(stop, int(self.sizes[doc]))
        if start >= stop:
            return np.zeros(0, np.uint32)
        ends = np.cumsum(self.sizes_of(symbols))
        a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
        before = int(ends[a - 1]) if a else 0
        return self.expand(symbols[a:b])[start - before:stop - before]

    def documents(self) -> Iterator[tuple[int | None, np.ndarray, int]]:
        """(document id, ids, their CRC-32) of each document; raises if the ids aren't what was written."""
        whole, at = self.expand(self.symbols), 0
        for doc_id, n, crc in zip(self.doc_ids, self.sizes.tolist(), self.crcs.tolist(), strict=True):
            ids = whole[at:at + n]
            at += n
            if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
                raise ValueError(f"damaged ids of document {doc_id}")
            yield doc_id, ids, crc


# Spark.

def id_type(tokenizer: str, end_id: int) -> str:
    """How ids are packed between encoding and writing: two bytes each where the vocabulary allows."""
    return "<u2" if max(json_tokenizer(tokenizer).get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"


def token_ids(docs: DataFrame, tokenizer: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, row_key, ids: the ids of each whole text and the end id as ``id_type``, by the tokenizer file at ``tokenizer``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"),
                       F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("row_key"))
    schema = pa.schema([("doc_id", pa.int64()), ("row_key", pa.int64()), ("ids", pa.binary())])
    kind = id_type(tokenizer, end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker(f"words {tokenizer}", lambda: word_encoder(tokenizer))
        for batch in batches:
            sizes = pc.binary_length(batch.column(1)).to_numpy()
            # Runs of rows of so many bytes; a longer text is a run of its own, taken in pieces.
            run_of = (np.cumsum(sizes) - sizes) // GROUP_BYTES + np.cumsum(np.r_[0, (sizes > PIECE_CHARS)[:-1]] | (sizes > PIECE_CHARS))
            cuts = [0, *(np.flatnonzero(np.diff(run_of)) + 1).tolist(), len(sizes)] if len(sizes) else [0]
            held = []
            for i, j in zip(cuts, cuts[1:]):
                if sizes[i] > PIECE_CHARS:
                    parts = [encoder.joined(pa.array([p], pa.string()))[0].astype(kind) for p in pieces(batch.column(1)[i].as_py())]
                    ids = np.concatenate(parts)
                    yield packed(batch, i, j, ids, np.array([len(ids)]))
                    continue
                held.append((i, j))
                if len(held) == GROUPS:
                    yield from encoded(encoder, batch, held)
                    held = []
            if held:
                yield from encoded(encoder, batch, held)

    def encoded(encoder, batch: pa.RecordBatch, held: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
        groups = encoder.together([batch.column(1).slice(i, j - i) for i, j in held])
        for (i, j), (ids, upto) in zip(held, groups, strict=True):
            yield packed(batch, i, j, ids.astype(kind), upto)

    def packed(batch: pa.RecordBatch, i: int, j: int, ids: np.ndarray, upto: np.ndarray) -> pa.RecordBatch:
        ids = np.insert(ids, upto, end_id)  # behind each text
        ends = np.r_[0, upto + np.arange(1, len(upto) + 1)] * ids.itemsize
        return pa.RecordBatch.from_arrays([
            batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i),
            pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(ids)])], schema=schema)

    return rows.mapInArrow(run, "doc_id long, row_key long, ids binary")


def write_ids(tokens: DataFrame, folder: str, kind: str, block_tokens: int = BLOCK_TOKENS, part_bytes: int = PART_BYTES) -> DataFrame:
    """Write stored ``tokens(doc_id, row_key, ids)``, packed as ``kind``, in ascending id order; return the stored index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = pafs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        name, part = f"ids-{uuid.uuid4().hex}.rpg", TaskContext.get().partitionId()
        out, at, block, doc_ids, docs, held = None, 0, 0, [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal out, at, block, doc_ids, docs, held
            if out is None:
                out = store.open_output_stream(f"{path}/{name}", compression=None)
            raw = write_block(doc_ids, docs)
            out.write(raw)
            row = {"file": name, "offset": at, "length": len(raw), "part": part, "block": block, "n_docs": len(docs), "n_tokens": held}
            at, block, doc_ids, docs, held = at + len(raw), block + 1, [], [], 0
            return pa.RecordBatch.from_pylist([row], schema=schema)

        schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("part", pa.int32()),
                            ("block", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])
        try:
            for batch in batches:
                for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    own = np.frombuffer(ids.as_py(), kind).astype(np.uint32)
                    if docs and held + len(own) > block_tokens:
                        yield flush()
                    doc_ids.append(doc_id)
                    docs.append(own)
                    held += len(own)
            if docs:
                yield flush()
        finally:
            if out is not None:
                out.close()

    size = tokens.agg(F.coalesce(F.sum(F.octet_length("ids")), F.lit(0))).first()[0]
    parts = max(1, math.ceil(size / part_bytes))
    order = [F.col("doc_id").asc_nulls_first(), "row_key", "ids"]
    dealt = tokens.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), "row_key").sortWithinPartitions(*order)
    return materialized(dealt.select("doc_id", "ids").mapInArrow(run, INDEX), "ids-index")


def with_starts(index: DataFrame) -> DataFrame:
    """``index`` with ``start``: the number of ids before each block, by parts and the blocks within."""
    parts = index.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # A row per task that wrote; blocks of a part are that task's own.
    before = parts.select("part", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    own = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("part").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    return index.withColumn("own", own).join(before, "part").select(*index.columns, (F.col("own") + F.col("before")).alias("start"))


def read_ids(index: DataFrame, folder: str, ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids, packed) of every document in the blocks that ``index`` names.

    ``ids=False`` leaves the ids themselves out of the result; they are decoded and checked all the same.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = pafs.FileSystem.from_uri(folder)
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                            ("ids_crc32", pa.int64()), ("ids", pa.binary())])
        for batch in batches:
            for r in batch.to_pylist():
                with store.open_input_file(f"{path}/{r['file']}") as source:
                    source.seek(r["offset"])
                    block = Block(source.read(r["length"]))
                rows, at = [], r["start"]
                for doc_id, own, crc in block.documents():
                    rows.append((doc_id, at, len(own), crc, own.astype("<u4").tobytes() if ids else None))
                    at += len(own)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)],
                                                 schema=schema)

    rows = with_starts(index).select("file", "offset", "length", "start")
    # As many tasks as files: their rows are tiny, so that Spark would join them into one.
    out = rows.repartition(max(1, index.select("file").distinct().count()), "file", "offset").mapInArrow(run, TOKENS)
    return out if ids else out.drop("ids")


def ids_folder(spark: SparkSession) -> str:
    """A fresh folder in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/ids/{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"


def stored_and_read(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the files it was written to."""
    folder = ids_folder(docs.sparkSession)
    index = write_ids(materialized(token_ids(docs, tokenizer, end_id), "token-ids"), folder, id_type(tokenizer, end_id))
    return read_ids(index, folder, ids=False)
