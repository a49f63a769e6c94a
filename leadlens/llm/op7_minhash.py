"""Near duplicates by a signature-coordinate inverted join.

1. *Classes.*  Documents with the same shingle set are one class with one
   representative; only classes are compared.
2. *Signatures.*  ``COORDINATES`` minima per set.  A signature is a set of
   (coordinate, value) tokens, and each token has a posting list of the
   classes that hold it.
3. *Prefix and skip.*  Two signatures that agree in ``LEAST_MATCHES`` tokens
   share one within the ``COORDINATES - LEAST_MATCHES + 1`` rarest tokens of
   each, under any one order of all tokens.  Only this prefix is posted; the
   frequent tokens' lists are skipped.  The order is by frequency over all
   classes, then by a hash.  Frequencies are run lengths of the sorted tokens,
   up to ``COUNTED``, so that no run is held whole; a token that only one
   class holds takes its place in the prefix and needs no posting.
4. *Merging.*  Lists are merged in order of token.  A list of up to ``SHORT``
   classes gives its pairs.  A longer list pairs each class with the list's
   first one, so a group of thousands of copies gives one pair each.
5. *Counting.*  Collisions of a pair are summed up over its lists, the
   skipped coordinates are counted from the signatures, and pairs with at
   least ``LEAST_MATCHES`` stay.  They are confirmed on the full sets.
6. *Long lists.*  Where the classes of a long list are still in different
   components, pairs across components are counted in blocks of ``BLOCK``
   classes; a pair counts only in the list of the first coordinate that both
   prefixes share.  First, in up to ``ROUNDS`` rounds over the lists of the
   first ``ROUND_COORDINATES`` coordinates, each class names its ``BEST``
   closest ones in other components, which joins a group of copies within a
   few rounds.  Then all pairs that still lie across components are confirmed,
   so no partner is given up.  There can be many such pairs just below the
   similarity.  They are packed by tiles (two buckets of up to ``BUCKET``
   classes that share lists), and each set moves once per tile, not per pair.

With 64 coordinates a pair at a similarity of exactly 0.8 is missed with a
chance of some 1e-5.  ``links`` compares integers: 100 * intersection >=
percent * union.

Sets of at most 3 shingles link only to equal sets (3/4 < 0.8).  Empty and
null texts have no shingles and are linked with nothing.  Of rows that share
the smallest id of a component one is kept; a null id sorts last.  An empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlens.llm.common import keep_rows, materialized
from leadlens.llm.components import connected_components
from leadlens.llm.shingles import chunks, set_digest, shingle_sets

COORDINATES, LEAST_MATCHES = 64, 37
PREFIX = COORDINATES - LEAST_MATCHES + 1
#: Frequencies from here on count as equal.
COUNTED = 1000
SHORT, BLOCK, BUCKET = 16, 4096, 512
ROUNDS, ROUND_COORDINATES, BEST = 2, 12, 2

_rng = np.random.default_rng(20240608)
MULTIPLY = _rng.integers(0, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _rng.integers(0, 2**63, COORDINATES, dtype=np.uint64)


def signatures(sets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """(documents, COORDINATES) minima; zeros for empty sets."""
    out = np.zeros((len(counts), COORDINATES), dtype=np.uint32)
    full = np.flatnonzero(counts)
    if len(full):
        starts = (np.cumsum(counts) - counts)[full]
        for k in range(COORDINATES):
            out[full, k] = np.minimum.reduceat((sets * MULTIPLY[k] + ADD[k]) >> np.uint64(32), starts)
    return out


def described(docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """Stored: row_no, doc_id, raw_hash, n, digest, sig per document."""
    schema = pa.schema([("doc_id", pa.int64()), ("raw_hash", pa.int64()), ("n", pa.int64()),
                        ("digest", pa.binary()), ("sig", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, raw, starts in chunks(batch.column(2)):
                sets, counts = shingle_sets(raw, starts, words)
                ends = np.cumsum(counts)
                marks = [set_digest(sets[e - c:e]) for c, e in zip(counts.tolist(), ends.tolist(), strict=True)]
                sig = signatures(sets, counts).view(np.int32)
                flat = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, sig.size + 1, COORDINATES, dtype=np.int32)), pa.array(sig.ravel()))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i).cast(pa.int64()), batch.column(1).slice(i, j - i),
                    pa.array(counts.astype(np.int64)), pa.array(marks, pa.binary()), flat], schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("raw_hash"),
                       F.col(text_col).alias("text"))
    found = rows.mapInArrow(run, "doc_id long, raw_hash long, n long, digest binary, sig array<int>")
    return materialized(found.withColumn("row_no", F.monotonically_increasing_id()), "minhash")


def shared_tokens(reps: DataFrame) -> DataFrame:
    """(token, node, uses) of the tokens that several classes hold; uses is at most COUNTED."""
    tokens = reps.select("node", F.posexplode("sig").alias("k", "v")).select(
        (F.shiftleft(F.col("k").cast("long"), 32) + F.col("v").cast("long").bitwiseAND(0xFFFFFFFF)).alias("token"), "node")
    schema = pa.schema([("token", pa.int64()), ("node", pa.int64()), ("uses", pa.int32())])

    def rows(token, node, uses):
        return pa.RecordBatch.from_arrays([pa.array(token), pa.array(node), pa.array(uses.astype(np.int32))], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = node = np.zeros(0, np.int64)
        open_token = None  # of a run that has more than COUNTED rows
        for batch in batches:
            token, node = (np.concatenate([old, new.to_numpy()]) for old, new in zip((token, node), batch.columns, strict=True))
            if not len(token):
                continue
            starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
            sizes = np.diff(np.r_[starts, len(token)])
            if token[0] == open_token:
                sizes[0] = max(sizes[0], COUNTED)
            goes_on = sizes[-1] < COUNTED  # the last run may grow in the next batch
            upto = int(starts[-1]) if goes_on else len(token)
            if not goes_on:
                open_token = int(token[-1])
            uses = np.repeat(np.minimum(sizes, COUNTED), np.diff(np.r_[starts, len(token)]))[:upto]
            shared = uses > 1
            yield rows(token[:upto][shared], node[:upto][shared], uses[shared])
            token, node = token[upto:], node[upto:]
        if len(token):
            uses = np.full(len(token), COUNTED if token[0] == open_token else len(token))
            if uses[0] > 1:
                yield rows(token, node, uses)

    ordered = tokens.repartition("token").sortWithinPartitions("token").select("token", "node")
    return ordered.mapInArrow(run, "token long, node long, uses int")


def postings(reps: DataFrame) -> DataFrame:
    """Stored: (token, node, n): of each representative's PREFIX rarest tokens those that others hold too."""
    ranked = shared_tokens(reps).groupBy("node").agg(F.sort_array(F.collect_list(
        F.struct("uses", F.xxhash64("token").alias("h"), "token"))).alias("tokens"))
    # Tokens that no other class holds are the rarest and come first.
    room = F.greatest(F.lit(0), F.lit(PREFIX - COORDINATES) + F.size("tokens"))
    chosen = ranked.select("node", F.explode(F.slice("tokens", 1, room)).alias("t")).select("node", "t.token")
    return materialized(chosen.join(reps.select("node", "n"), "node").select("token", "node", "n"), "postings")


def prefix_masks(posted: DataFrame, reps: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, mask, sig) of ``nodes``: which coordinates are posted, a bit each."""
    masks = posted.join(nodes, "node", "left_semi").groupBy("node").agg(
        F.bit_or(F.expr("shiftleft(1L, cast(shiftright(token, 32) as int))")).alias("mask"))
    return masks.join(reps.select("node", "sig"), "node")


def merged_lists(posted: DataFrame, percent: int) -> DataFrame:
    """Stored: (long_list, x, y, n): pairs of nodes, and (token, node, n) of the long lists."""
    schema = pa.schema([("long_list", pa.bool_()), ("x", pa.int64()), ("y", pa.int64()), ("n", pa.int64())])

    def rows(long_list, x, y, n):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(x), long_list)), pa.array(x), pa.array(y),
                                           pa.array(n)], schema=schema)

    def pairs(token, node, n):
        """All pairs of the short runs that can reach the similarity by their sizes."""
        xs, ys = [], []
        for d in range(1, SHORT):
            i = np.flatnonzero(token[d:] == token[:-d]) if d < len(token) else np.zeros(0, np.int64)
            if not len(i):
                break
            small, large = np.minimum(n[i], n[i + d]), np.maximum(n[i], n[i + d])
            i = i[100 * small >= percent * large]
            xs.append(node[i])
            ys.append(node[i + d])
        x, y = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (xs, ys))
        return rows(False, x, y, np.zeros(len(x), np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = node = n = np.zeros(0, np.int64)
        open_token, hub = None, None  # of a long list that goes on
        for batch in batches:
            token, node, n = (np.concatenate([old, new.to_numpy()]) for old, new in
                              zip((token, node, n), batch.columns, strict=True))
            if not len(token):
                continue
            if open_token is not None:
                m = int(np.searchsorted(token, open_token, side="right"))
                yield rows(True, token[:m], node[:m], n[:m])
                yield rows(False, np.full(m, hub), node[:m], np.zeros(m, np.int64))
                token, node, n = token[m:], node[m:], n[m:]
                if not len(token):
                    continue
                open_token = None
            starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
            sizes = np.diff(np.r_[starts, len(token)])
            whole = len(starts) - 1  # the last run may go on in the next batch
            is_long = sizes > SHORT
            member = np.repeat(is_long, sizes)
            upto = int(starts[whole])
            yield pairs(token[:upto][~member[:upto]], node[:upto][~member[:upto]], n[:upto][~member[:upto]])
            for r in np.flatnonzero(is_long).tolist():
                a, b = int(starts[r]), int(starts[r] + sizes[r])
                yield rows(True, token[a:b], node[a:b], n[a:b])
                yield rows(False, np.full(b - a - 1, node[a]), node[a + 1:b], np.zeros(b - a - 1, np.int64))
            if is_long[whole]:
                open_token, hub = int(token[-1]), int(node[upto])
                token = node = n = np.zeros(0, np.int64)
            else:
                token, node, n = token[upto:], node[upto:], n[upto:]
        if len(token):
            yield pairs(token, node, n)

    ordered = posted.repartition("token").sortWithinPartitions("token", "node").select("token", "node", "n")
    return materialized(ordered.mapInArrow(run, "long_list boolean, x long, y long, n long"), "merged")


def matched(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures agree in LEAST_MATCHES coordinates."""
    left = reps.select(F.col("node").alias("a"), F.col("sig").alias("sig_a"))
    right = reps.select(F.col("node").alias("b"), F.col("sig").alias("sig_b"))
    same = F.size(F.filter(F.zip_with("sig_a", "sig_b", lambda p, q: p == q), lambda hit: hit))
    return pairs.join(left, "a").join(right, "b").where(same >= LEAST_MATCHES).select("a", "b")


def full_sets(nodes: DataFrame, reps: DataFrame, docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """Stored: (node, hashes) of ``nodes(node)``: the sorted shingle hashes as bytes, from the whole texts again."""
    nodes = materialized(reps.join(nodes, "node", "left_semi").select(
        "node", F.col("doc_id").alias("own_id"), F.col("digest").alias("own_digest")), "candidate-docs")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    texts = texts.join(nodes.select("own_id"), F.col("doc_id").eqNullSafe(F.col("own_id")), "left_semi")
    schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("hashes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, raw, starts in chunks(batch.column(1)):
                sets, counts = shingle_sets(raw, starts, words)
                ends = np.cumsum(counts)
                own = [sets[e - c:e] for c, e in zip(counts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i),
                                                  pa.array([set_digest(s) for s in own], pa.binary()),
                                                  pa.array([s.tobytes() for s in own], pa.binary())], schema=schema)

    sets = texts.mapInArrow(run, "doc_id long, digest binary, hashes binary").join(
        nodes, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("digest") == F.col("own_digest")))
    return materialized(sets.select("node", "hashes"), "candidate-sets")


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, for sorted distinct hashes."""
    if len(x) > len(y):
        x, y = y, x
    if 100 * len(x) < percent * len(y):
        return False
    common = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def confirmed(pairs: DataFrame, sets_of, percent: int) -> DataFrame:
    """Stored: the pairs whose full sets reach the similarity; ``sets_of`` gives the sets of nodes."""
    pairs = materialized(pairs, "candidates")
    sets = sets_of(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct())
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("hashes").alias("y")), "b").select("a", "b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                    for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return materialized(both.mapInArrow(run, "a long, b long"), "near-links")


def buckets(long_rows: DataFrame) -> DataFrame:
    """Stored: (node, bucket): nodes whose lists have a first node in common, in buckets of about BUCKET."""
    hubs = long_rows.groupBy("token").agg(F.min("node").alias("hub"))
    near = long_rows.join(hubs, "token").groupBy("node").agg(F.min("hub").alias("hub"))
    near = materialized(near, "list-hubs")
    sizes = near.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / BUCKET).alias("parts"))
    return materialized(near.join(sizes, "hub").select(
        "node", F.xxhash64("hub", F.pmod(F.xxhash64("node"), F.col("parts"))).alias("bucket")), "list-buckets")


def tiles_confirmed(tiles: DataFrame, sets_of, percent: int) -> DataFrame:
    """Stored: the pairs packed in ``tiles(p, q, pairs)`` whose full sets reach the similarity."""
    schema = pa.schema([("p", pa.int64()), ("q", pa.int64()), ("node", pa.int64()), ("data", pa.binary()),
                        ("kind", pa.int32())])

    def with_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row (kind 0) for each node of a tile, next to the tile's pairs (kind 1)."""
        key, seen = None, set()
        for batch in batches:
            out = []
            for p, q, pairs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (p, q) != key:
                    key, seen = (p, q), set()
                fresh = set(np.frombuffer(pairs, np.int64).tolist()) - seen
                seen |= fresh
                out += [(p, q, n, None, 0) for n in fresh]
                out.append((p, q, None, pairs, 1))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)]
                                             if out else [pa.array([], f.type) for f in schema], schema=schema)

    ordered = tiles.repartition("p", "q").sortWithinPartitions("p", "q").select("p", "q", "pairs")
    tiles = materialized(ordered.mapInArrow(with_nodes, "p long, q long, node long, data binary, kind int"), "tiles")
    nodes = tiles.where("kind = 0")
    sets = sets_of(nodes.select("node").distinct())
    rows = nodes.drop("data").join(sets, "node").select("p", "q", "node", F.col("hashes").alias("data"), "kind")
    rows = rows.unionByName(tiles.where("kind = 1"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, {}
        for batch in batches:
            out = []
            for p, q, node, data, kind in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (p, q) != key:
                    key, held = (p, q), {}
                if kind == 0:
                    held[node] = np.frombuffer(data, np.uint64)
                else:
                    out += [ab for ab in np.frombuffer(data, np.int64).reshape(-1, 2).tolist()
                            if similar(held[ab[0]], held[ab[1]], percent)]
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()),
                                              pa.array([b for _, b in out], pa.int64())], ["a", "b"])

    ordered = rows.repartition("p", "q").sortWithinPartitions("p", "q", "kind").select("p", "q", "node", "data", "kind")
    return materialized(ordered.mapInArrow(run, "a long, b long"), "near-links")


def across(long_rows: DataFrame, labels: DataFrame, masks: DataFrame, percent: int, best: int | None) -> DataFrame:
    """Pairs of long lists that lie in different components and agree in LEAST_MATCHES coordinates, packed by tile.

    Rows are (p, q, pairs): two buckets and the int64 nodes (a, b) of any
    number of pairs between them.  ``best`` keeps that many closest ones of
    each class in each block; None keeps all.  A list is dealt into blocks;
    each pair of blocks is compared in one place, which holds two blocks at
    most.
    """
    named = materialized(long_rows.join(labels, "node", "left").withColumn(
        "component", F.coalesce("component", "node")), "long-lists")
    lists = named.groupBy("token").agg(F.count(F.lit(1)).alias("m"), F.min("component").alias("low"),
                                       F.max("component").alias("high")).where("low <> high")
    lists = materialized(lists.select("token", F.ceil(F.col("m") / BLOCK).alias("blocks")), "open-lists")
    parts = named.join(lists, "token").withColumn(
        "own", F.pmod(F.xxhash64("node"), F.col("blocks"))).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    parts = parts.select("token", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                         (F.col("own") <= F.col("other")).alias("first"), "node", "n", "component")
    parts = parts.join(masks, "node").select("token", "i", "j", "first", "node", "n", "component", "mask", "bucket", "sig")
    schema = pa.schema([("p", pa.int64()), ("q", pa.int64()), ("pairs", pa.binary())])

    def compare(key, held):
        first, node, n, comp, mask, bucket = (np.array([r[c] for r in held]) for c in range(6))
        sig = np.array([r[6] for r in held], dtype=np.int32)
        mask = mask.astype(np.int64).view(np.uint64)
        here = np.uint64(1) << np.uint64(key[0] >> 32)
        same_block = key[1] == key[2]
        none = np.zeros(0, np.int64)
        xs, ys = [none], [none]
        for r in range(len(node)) if same_block or best else np.flatnonzero(first).tolist():
            ok = (comp != comp[r]) & (100 * np.minimum(n, n[r]) >= percent * np.maximum(n, n[r]))
            if not same_block:
                ok &= first != first[r]
            elif not best:
                ok &= node > node[r]
            at = np.flatnonzero(ok)
            equal = sig[at] == sig[r]
            shared = np.packbits(equal, axis=1, bitorder="little").view(np.uint64)[:, 0] & mask[at] & mask[r]
            hits = equal.sum(axis=1)
            chosen = (hits >= LEAST_MATCHES) & (shared & (~shared + np.uint64(1)) == here)
            at, hits = at[chosen], hits[chosen]
            if best and len(at) > best:
                at = at[np.argsort(-hits, kind="stable")[:best]]
            xs.append(np.full(len(at), r))
            ys.append(at)
        x, y = np.concatenate(xs), np.concatenate(ys)
        p, q = np.minimum(bucket[x], bucket[y]), np.maximum(bucket[x], bucket[y])
        order = np.lexsort((q, p))
        x, y, p, q = x[order], y[order], p[order], q[order]
        if not len(x):
            return pa.RecordBatch.from_arrays([pa.array([], f.type) for f in schema], schema=schema)
        cuts = np.flatnonzero(np.r_[True, (p[1:] != p[:-1]) | (q[1:] != q[:-1])])
        nodes = np.stack([node[x], node[y]], axis=1).astype(np.int64)
        return pa.RecordBatch.from_arrays([
            pa.array(p[cuts], pa.int64()), pa.array(q[cuts], pa.int64()),
            pa.array([nodes[a:b].tobytes() for a, b in zip(cuts, [*cuts[1:], len(p)], strict=True)], pa.binary())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            for t, i, j, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (t, i, j) != key:
                    if len(held) > 1:
                        yield compare(key, held)
                    key, held = (t, i, j), []
                held.append(row)
        if len(held) > 1:
            yield compare(key, held)

    ordered = parts.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
    return ordered.mapInArrow(run, "p long, q long, pairs binary")


def joined_long_lists(links: DataFrame, long_rows: DataFrame, posted: DataFrame, reps: DataFrame, percent: int,
                      sets_of) -> DataFrame:
    """Components of ``links`` and of all further links within long lists."""
    labels = connected_components(links)
    if long_rows.isEmpty():
        return labels
    bucket_of = buckets(long_rows)
    masks = materialized(prefix_masks(posted, reps, bucket_of.select("node")).join(bucket_of, "node"), "prefix-masks")
    few = long_rows.where(F.shiftright("token", 32) < ROUND_COORDINATES)
    found = True
    for best in [BEST] * ROUNDS + [None]:
        if best is None or found:  # a round without a new link is followed by the last one
            rows = few if best else long_rows
            more = tiles_confirmed(across(rows, labels, masks, percent, best), sets_of, percent)
            found = not more.isEmpty()
            if found:
                links = links.unionByName(more)
                labels = connected_components(links)
    return labels


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, raw_hash."""
    whole = described(docs, words, id_col, text_col)
    classes = materialized(whole.where("n > 0").groupBy("digest").agg(
        F.coalesce(F.min_by("row_no", "doc_id"), F.min("row_no")).alias("node"), F.min("doc_id").alias("low_id"),
        F.count(F.lit(1)).alias("copies")), "classes")
    # A set links to another one only if one shingle more or less is little enough.
    reps = materialized(whole.join(classes.select(F.col("node").alias("row_no")), "row_no", "left_semi").where(
        100 * F.col("n") >= percent * (F.col("n") + 1)).withColumnRenamed("row_no", "node"), "representatives")

    def sets_of(nodes):
        return full_sets(nodes, reps, docs, words, id_col, text_col)

    posted = postings(reps)
    merged = merged_lists(posted, percent)
    pairs = merged.where("not long_list").groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(
        F.count(F.lit(1)).alias("collisions")).select("a", "b")
    links = confirmed(matched(pairs, reps), sets_of, percent)
    long_rows = merged.where("long_list").select(F.col("x").alias("token"), F.col("y").alias("node"), "n")
    labels = joined_long_lists(links, long_rows, posted, reps, percent, sets_of)

    named = materialized(classes.join(labels, "node", "left").withColumn(
        "component", F.coalesce("component", "node")), "class-components")
    groups = named.groupBy("component").agg(
        F.min("low_id").alias("component_id"), F.coalesce(F.min_by("node", "low_id"), F.min("node")).alias("keep_row"),
        F.sum("copies").alias("members")).where("members > 1")
    named = named.select("digest", "component").join(groups, "component").select("digest", "component_id", "keep_row")
    out = whole.select("row_no", "doc_id", "raw_hash", "n", F.when(F.col("n") > 0, F.col("digest")).alias("digest"))
    return out.join(named, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("keep_row").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce(F.col("row_no") == F.col("keep_row"), F.lit(True)).alias("kept"), "raw_hash")


def drop_near_copies(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that stay: one of each component."""
    kept = near_duplicates(docs, words, percent, id_col, text_col).where("kept")
    keep = materialized(kept.select(F.col("doc_id").alias("keep_id"), F.col("raw_hash").alias("keep_text")), "kept")
    return keep_rows(docs, keep, id_col, text_col)
