r"""Benchmark decontamination by a prefix-filtered set join.

Words are runs of ``[0-9a-z]`` and of characters beyond ASCII, after A-Z have
been lower-cased.  A window is ``WINDOW`` consecutive words of an item; a
shorter item is one window.  A document contains a window if the words follow
each other in it.

1. *Rarity.*  The frequency of every item word is counted over all documents.
2. *Prefix.*  Whoever contains a window contains each of its words, so one
   word is a sufficient prefix: the rarest.  Neighbouring windows mostly share
   it, which leaves a few key positions per item.
3. *Bounds.*  Document words that equal a key word give candidates (document
   position, item position).  Length and position say how far a window can
   reach to either side; candidates without room for a whole window go.
4. *Verification.*  The words to both sides are compared, at most a window's
   length each way.  A run as long as a window is exactly the union of the
   contained windows around this position; its words are hit.

A key carries the words around it, at most a window's length each way.  The
items' vocabulary and keys are broadcast while their bytes in memory allow.  For
a larger benchmark the document words are narrowed to key words first (by a
broadcast of the distinct key words, or by a shuffle of single words with their
positions and one of the texts beyond its bound); only these positions, with the
words around them, are shuffled to the keys, where AQE splits frequent words.

The prefix is a word and not a shingle of several: counting shingles would move
and hold a text's whole shingle set, while the words of an item are few, and the
bounds and the comparison settle what a frequent word lets through.

Null texts have no words.  Items without words never occur.  A null item id
counts as one item and is written as nothing.  Rows that repeat id and text
have equal results.  Empty tables give no hits, or no rows.  Extra columns
are ignored.

The main path is DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlens.llm.common import ascii_lower, drop_rows, materialized
from leadlens.operators.joins import bounded_broadcast, fits_broadcast

WINDOW = 10
#: What stands between words, before and after lower-casing.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Item words (or key words), and key positions with the words around, are broadcast up to so many bytes in memory.
MAX_BROADCAST_WORDS, MAX_BROADCAST_KEYS = 64 << 20, 64 << 20


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BETWEEN), "")


def items_of(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Stored: item_no, item_id, words of the items that have words."""
    return materialized(benchmark.select(
        F.monotonically_increasing_id().alias("item_no"), F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item_id"),
        words_of(F.col(text_col)).alias("item_words")).where(F.size("item_words") > 0), "items")


def key_positions(items: DataFrame, docs: DataFrame, text_col: str, window: int) -> DataFrame:
    """Stored: item_id, word, item_size, item_before, item_behind: the rarest word of each window and the words around it."""
    vocabulary = materialized(items.select(F.explode("item_words").alias("word")).distinct(), "item-vocabulary")
    # The outer form keeps Catalyst from splitting each text once more to see whether it has words.
    found = docs.select(F.explode_outer(words_of(F.col(text_col))).alias("word"))
    uses = found.join(bounded_broadcast(vocabulary, max_bytes=MAX_BROADCAST_WORDS), "word").groupBy("word").agg(
        F.count(F.lit(1)).alias("uses"))
    placed = items.select("item_no", F.posexplode("item_words").alias("p", "word")).join(uses, "word", "left")
    # A word that no document has settles its windows: nothing can contain them, and the join finds nothing.
    ranked = placed.groupBy("item_no").agg(F.sort_array(F.collect_list(F.struct(
        "p", F.struct(F.coalesce("uses", F.lit(0)).alias("uses"), "word", "p").alias("rank")))).alias("ranks"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("ranks") - window + 1, F.lit(1)))
    keys = ranked.select("item_no", F.explode(F.array_distinct(F.transform(
        starts, lambda s: F.array_min(F.transform(F.slice("ranks", s, window), lambda r: r["rank"]))))).alias("k"))
    before, behind = around("item_words", "p", window)
    return materialized(keys.select("item_no", "k.p", "k.word").join(items, "item_no").select(
        "item_id", "word", F.size("item_words").alias("item_size"), before.alias("item_before"), behind.alias("item_behind")),
        "item-keys")


def around(words: str, at: str, window: int) -> tuple[Column, Column]:
    """The words before and behind a position, fewer than a window each."""
    reach = F.lit(window - 1)
    left, right = F.least(at, reach), F.least(F.size(words) - 1 - F.col(at), reach)
    return F.slice(words, F.col(at) - left + 1, left), F.slice(words, F.col(at) + 2, right)


def positions(rows: DataFrame, keys: DataFrame, window: int) -> DataFrame:
    """doc_id, raw_hash, q, before, behind and the columns of ``keys``, from ``rows(doc_id, raw_hash, words)``."""
    before, behind = (c.alias(n) for c, n in zip(around("words", "q", window), ("before", "behind"), strict=True))
    own = ["doc_id", "raw_hash", "q"]
    placed = rows.select("doc_id", "raw_hash", "words", F.posexplode_outer("words").alias("q", "word"))
    if fits_broadcast(keys, max_bytes=MAX_BROADCAST_KEYS):
        # The scan stays one generated loop; words are cut out for candidates only.
        return placed.join(F.broadcast(keys), "word").select(*own, before, behind, *[c for c in keys.columns if c != "word"])
    key_words = materialized(keys.select("word").distinct(), "key-words")
    if fits_broadcast(key_words, max_bytes=MAX_BROADCAST_WORDS):
        placed = placed.join(F.broadcast(key_words), "word", "left_semi")
    else:
        found = placed.drop("words").join(key_words, "word", "left_semi").groupBy("doc_id", "raw_hash").agg(
            F.collect_set(F.struct("q", "word")).alias("found")).withColumnsRenamed({"doc_id": "d", "raw_hash": "h"})
        placed = rows.join(found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("raw_hash") == F.col("h"))).select(
            "doc_id", "raw_hash", "words", F.inline("found"))
    return placed.select(*own, "word", before, behind).join(keys, "word").drop("word")


def same_run(left: Column, right: Column, length: Column) -> Column:
    """How many leading elements are equal, of ``length``."""
    differs = F.array_position(F.zip_with(left, right, lambda a, b: a == b), False)
    return F.when(differs == 0, length).otherwise((differs - 1).cast("int"))


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Stored: (doc_id, raw_hash, item_id, low, high): word ranges that windows of an item cover."""
    items = items_of(benchmark, item_col, item_text_col)
    keys = key_positions(items, docs, text_col, window)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("raw_hash"),
                       words_of(F.col(text_col)).alias("words"))
    room_left, room_right = F.least(F.size("before"), F.size("item_before")), F.least(F.size("behind"), F.size("item_behind"))
    need = F.least("item_size", F.lit(window))
    near = positions(rows, keys, window).where(room_left + room_right + 1 >= need)
    near = materialized(near.select(
        "doc_id", "raw_hash", "item_id", "q", need.alias("need"), room_left.alias("room_left"), room_right.alias("room_right"),
        F.slice("before", F.size("before") - room_left + 1, room_left).alias("before"),
        F.slice("item_before", F.size("item_before") - room_left + 1, room_left).alias("item_before"),
        F.slice("behind", F.lit(1), room_right).alias("behind"),
        F.slice("item_behind", F.lit(1), room_right).alias("item_behind")), "item-candidates")
    found = near.withColumns({
        "run_left": same_run(F.reverse("before"), F.reverse("item_before"), F.col("room_left")),
        "run_right": same_run(F.col("behind"), F.col("item_behind"), F.col("room_right"))})
    found = found.where(F.col("run_left") + F.col("run_right") + 1 >= F.col("need"))
    return materialized(found.select(
        "doc_id", "raw_hash", "item_id", (F.col("q") - F.col("run_left")).alias("low"),
        (F.col("q") + F.col("run_right")).alias("high")).distinct(), "item-hits")


def hit_documents(found: DataFrame) -> DataFrame:
    """Stored: hit_id, hit_hash, n_hit, n_items, items_sha256 per document that ``hits`` names."""
    own = ["doc_id", "raw_hash"]
    before = F.max("high").over(Window.partitionBy(*own).orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("high") - F.greatest(F.col("low") - 1, F.coalesce(before, F.lit(-1))))
    covered = found.select(*own, "low", "high").distinct().withColumn("fresh", fresh).groupBy(*own).agg(
        F.sum("fresh").alias("n_hit"))
    named = found.select(*own, "item_id").distinct().groupBy(*own).agg(
        F.sort_array(F.collect_list("item_id")).alias("ids"))
    joined = covered.join(named.withColumnsRenamed({"doc_id": "d", "raw_hash": "h"}),
                          F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("raw_hash") == F.col("h")))
    return materialized(joined.select(
        F.col("doc_id").alias("hit_id"), F.col("raw_hash").alias("hit_hash"), "n_hit",
        F.size("ids").cast("long").alias("n_items"), F.sha2(F.array_join("ids", ","), 256).alias("items_sha256")),
        "hit-documents")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    known = hit_documents(hits(docs, benchmark, window, id_col, text_col))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("raw_hash"),
                       F.regexp_count(text, F.lit(WORD_ANY_CASE)).cast("long").alias("n_words"))
    joined = rows.join(known, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("raw_hash") == F.col("hit_hash")), "left")
    return joined.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that contain no window."""
    known = hit_documents(hits(docs, benchmark, window, id_col, text_col))
    return drop_rows(docs, known.select(F.col("hit_id").alias("bad_id"), F.col("hit_hash").alias("bad_text")),
                     id_col, text_col)
