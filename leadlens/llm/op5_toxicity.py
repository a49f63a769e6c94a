"""Toxicity: boosted trees over dense features, calibrated.

1. *Lexicon.*  From labelled rows, words and word beginnings that toxic texts
   use and others don't, with their log odds.  Nothing is listed by hand but
   second-person pronouns.
2. *Features* of every whole text: densities and weights of lexicon words and
   beginnings, how near they stand to a second-person word, shares of
   capitals and punctuation, and rates of obfuscation (signs or digits inside
   words, letters repeated three times).  Disguised words are read as plain ones as
   well.
3. *Trees* on the fitting rows, *isotonic calibration* on others of the
   labelled rows.

Rows whose crc32(id as text) mod 4 is 2 are held out: neither lexicon, trees
nor calibration see their labels.  Remainder 3 calibrates, 0 and 1 fit.  At
most ``MAX_LABELLED`` labelled rows (by a hash of the id) are used.  The
lexicon keeps every entry that passes the least numbers and ratio below.

Null texts are empty; an empty text has the features of no words.  Labels
that repeat count once, with the largest value; null labels count not at all.
Without any toxic label every score is 0.  Repeated rows are scored each.  An empty
table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlens.llm.boosted import Boosted
from leadlens.llm.common import drop_rows, materialized

MAX_LABELLED = 40_000
THRESHOLD = 0.3
#: Lengths of word beginnings; a word has to be longer.
BEGINNINGS = (4, 5, 6)
#: Least number, and share, of toxic texts that have an entry; least ratio of its frequency there to that elsewhere.
LEAST_TEXTS, LEAST_SHARE, LEAST_RATIO = 3, 0.004, 12.0

#: Second-person words in English, German, French and Spanish.
SECOND_PERSON = frozenset(
    "you your yours yourself u ya du dich dir dein deine deinen ihr euch euer sie tu te toi ton ta tes vous votre vos "
    "usted ustedes tú ti tus vosotros vuestro".encode().split())
#: Signs and digits that stand for letters.
PLAIN = bytes.maketrans(b"013457@$!", b"oieastasi")

#: Texts are read as lower-cased UTF-8; all bytes beyond ASCII count as letters.
WORD = re.compile(rb"[a-z\x80-\xff]+")
INSIDE = re.compile(rb"[*@$#!0-9.\-_]{1,2}[a-z\x80-\xff]")
DISGUISED = re.compile(rb"(?<![a-z\x80-\xff])[a-z\x80-\xff]++(?:[*@$#!0-9.\-_]{1,2}[a-z\x80-\xff]++)+")
MARK = np.zeros(128, dtype=bool)
MARK[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
N_FEATURES = 16


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(4))


def lowered(text: str) -> bytes:
    return text.lower().encode("utf-8", "surrogatepass")


def tokens_of(text: str) -> set[bytes]:
    """Distinct words, and their beginnings marked by a dash."""
    low = lowered(text)
    words = set(WORD.findall(low)) | plain_words(low)
    return words | {w[:k] + b"-" for w in words for k in BEGINNINGS if len(w) > k}


def disguised(low: bytes) -> list[bytes]:
    return DISGUISED.findall(low) if INSIDE.search(low) else []


def plain_words(low: bytes) -> set[bytes]:
    """Words read out of disguise: signs read as letters, or left out."""
    return {b"".join(WORD.findall(x)) for w in disguised(low) for x in (w, w.translate(PLAIN))}


class Lexicon:
    """Weights of words and of beginnings (``abcd-``)."""

    def __init__(self, weights: dict[bytes, float]):
        self.words = {t: x for t, x in weights.items() if not t.endswith(b"-")}
        self.begun = {t[:-1]: x for t, x in weights.items() if t.endswith(b"-")}
        self.first = frozenset(t[:min(BEGINNINGS)] for t in self.begun)
        self.keys = frozenset(self.words)


def features_of(text: str, lexicon: Lexicon) -> list[float]:
    low = lowered(text)
    words = WORD.findall(low)
    n = max(len(words), 1)
    distinct = set(words)
    whole = {w: lexicon.words[w] for w in distinct & lexicon.keys}
    least = min(BEGINNINGS)
    begun = {}
    for w in [w for w in distinct if w[:least] in lexicon.first]:
        found = [x for k in BEGINNINGS if len(w) > k and (x := lexicon.begun.get(w[:k])) is not None]
        if found:
            begun[w] = max(found)
    signs = disguised(low)
    hidden = [lexicon.words[w] for w in (plain_words(low) - distinct) & lexicon.keys] if signs else []
    marked = {**begun, **whole}
    you = distinct & SECOND_PERSON
    near, count = 0.0, Counter()
    if marked:
        last_you, last_hit = -10**9, -10**9
        for i, w in enumerate(words):
            if w in marked:
                last_hit = i
                count[w] += 1
            elif w in you:
                last_you = i
            else:
                continue
            near = max(near, 1.0 / (1 + abs(last_hit - last_you)))
    codes = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    plain = codes[codes < 128]
    same = codes[1:] == codes[:-1]
    runs = np.flatnonzero(same[1:] & same[:-1])
    letters = max(sum(map(len, words)), 1)
    return [
        sum(c for w, c in count.items() if w in whole) / n, float(len(whole)),
        sum(c for w, c in count.items() if w in begun) / n, float(len(begun)),
        max(marked.values(), default=0.0), sum(marked.values()), sum(marked.values()) / n,
        float(len(hidden)), sum(hidden),
        near, sum(map(words.count, you)) / n,
        float(((codes >= 65) & (codes <= 90)).sum()) / letters, (text.count("!") + text.count("?")) / n,
        float(MARK[plain].sum()) / max(len(codes), 1),
        len(signs) / n, float(((codes[runs] | 32) - 97 < 26).sum()) / n,
    ]


def labelled_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, limit: int) -> DataFrame:
    """Stored: label, fold, text of at most about ``limit`` labelled rows that aren't held out."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    known = materialized(known.where(fold(F.col("doc_id")) != 2), "toxic-labels")
    total = known.count()
    if total > limit:
        part = F.pmod(F.xxhash64(F.lit("toxic"), "doc_id"), F.lit(1_000_000))
        known = known.where(part < int(1_000_000 * limit / total))
    side = F.broadcast(known.select(F.col("doc_id").alias("label_id"), "label"))  # limit rows
    own = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return materialized(own.join(side, F.col("doc_id") == F.col("label_id")).select(
        F.when(F.col("label") > 0, 1).otherwise(0).alias("label"), fold(F.col("doc_id")).alias("fold"), "text"),
        "toxic-rows")


def learned_lexicon(rows: DataFrame) -> dict[bytes, float]:
    """Log odds of words and beginnings (``abcd-``) that mark toxic texts."""
    n = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    toxic, other = n.get(1, 0), n.get(0, 0)
    if not toxic:
        return {}

    def counted(wanted):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                count = Counter()
                for text in batch.column(0).to_pylist():
                    found = tokens_of(text)
                    count.update(found if wanted is None else found & wanted)
                yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.binary()),
                                                  pa.array(list(count.values()), pa.int64())], ["token", "n"])
        return run

    least = max(LEAST_TEXTS, math.ceil(LEAST_SHARE * toxic))
    often = rows.where("label = 1").select("text").mapInArrow(counted(None), "token binary, n long").groupBy(
        "token").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    # An entry has to be in LEAST_SHARE of the toxic texts, which bounds their number by that of words in 250 texts.
    inside = {bytes(r["token"]): r["n"] for r in often.collect()}
    outside = {bytes(r["token"]): r["n"] for r in rows.where("label = 0").select("text").mapInArrow(
        counted(frozenset(inside)), "token binary, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()}
    odds = {t: (k / toxic) / ((outside.get(t, 0) + 0.5) / (other + 1)) for t, k in inside.items()}
    return {t: math.log(o) for t, o in odds.items() if o >= LEAST_RATIO}


def featured(rows: DataFrame, lexicon: Lexicon, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``features`` of ``rows``, which has ``text``."""
    out = rows.select(*keep, "text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields if f.name != "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features_of(t or "", lexicon) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(found, pa.list_(pa.float64()))], [*keep, "features"])

    return out.mapInArrow(run, f"{fields}, features array<double>")


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             limit: int = MAX_LABELLED) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, raw_hash."""
    rows = labelled_rows(docs, labels, id_col, text_col, limit)
    lexicon = Lexicon(learned_lexicon(rows.where("fold in (0, 1)")))
    known = materialized(featured(rows, lexicon, ["label", "fold"]), "toxic-features")
    model = Boosted(known.where("fold in (0, 1)"), known.where("fold = 3"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    every = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("raw_hash"), text.alias("text"))
    scored = model.score(featured(every, lexicon, ["doc_id", "raw_hash"]))
    return scored.select("doc_id", (fold(F.col("doc_id")) == 2).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "raw_hash")


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that aren't predicted toxic."""
    bad = toxicity(docs, labels, id_col, text_col).where("predicted = 1")
    bad = materialized(bad.select(F.col("doc_id").alias("bad_id"), F.col("raw_hash").alias("bad_text")), "toxic")
    return drop_rows(docs, bad, id_col, text_col)
