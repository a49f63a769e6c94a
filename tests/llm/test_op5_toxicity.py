import random
import zlib

import pytest
from pyspark.sql import functions as F

from leadlens.llm import op5_toxicity as T
from tests.llm.helpers import AWKWARD, docs_of, prose

BAD = ["scumbag", "vileworm", "grubling"]


def corpus(n=240):
    rng = random.Random(3)
    texts, toxic = [], []
    for i in range(n):
        words = prose(1000 + i, 60, 900).split()
        toxic.append(int(i % 3 == 0))
        if toxic[-1]:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(BAD + ["slimo" + rng.choice(["ra", "tek", "bun", "gil"])]))
        texts.append(" ".join(words))
    return texts, toxic


def labels_of(spark, pairs):
    return spark.createDataFrame([(i, 1, t) for i, t in pairs], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def scored(spark):
    texts, toxic = corpus()
    docs = docs_of(spark, texts)
    out = T.toxicity(docs, labels_of(spark, enumerate(toxic))).orderBy("doc_id").collect()
    return docs, toxic, out


def test_held_out_rows_are_told_apart(scored):
    _, toxic, out = scored
    assert [r.held_out for r in out] == [zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in out]
    held = [(r, toxic[r.doc_id]) for r in out if r.held_out]
    assert len(held) > 40 and sum(r.predicted == t for r, t in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)


def test_labels_of_held_out_rows_are_never_used(spark, scored):
    docs, toxic, out = scored
    turned = [(r.doc_id, 1 - toxic[r.doc_id] if r.held_out else toxic[r.doc_id]) for r in out]
    again = T.toxicity(docs, labels_of(spark, turned)).orderBy("doc_id").collect()
    assert [r.score for r in again] == [r.score for r in out]


def test_disguise_and_features():
    lexicon = T.Lexicon({b"loser": 4.0, b"slim-": 3.0, b"slimor-": 2.0})
    assert b"loser" in T.plain_words(b"what a l0s3r") and b"loser" in T.plain_words(b"l*o*s*e*r")
    plain, none = T.features_of("You LOSER!!", lexicon), T.features_of("", lexicon)
    assert len(plain) == len(none) == T.N_FEATURES and plain[9] == 0.5 and plain[4] == 4.0 and not any(none)
    assert T.features_of("slimora", lexicon)[3:5] == [1.0, 3.0] and T.features_of("slim", lexicon)[3] == 0.0
    assert T.features_of("a l0ser", lexicon)[7:9] == [1.0, 4.0] and T.features_of("sooo baaad 111", lexicon)[15] > 0


def test_awkward_rows_and_missing_labels(spark):
    texts, toxic = corpus(60)
    pairs = [*enumerate(toxic), (0, 1), (5, None), (None, 1)]
    docs = docs_of(spark, [*texts, *[(1000 + i, t) for i, t in enumerate(AWKWARD)], (None, "x"), (None, "x")], extra=True)
    out = T.toxicity(docs, labels_of(spark, pairs))
    assert out.count() == 60 + len(AWKWARD) + 2 and out.where("score is null or not score between 0 and 1").count() == 0
    kept = T.drop_toxic(docs, labels_of(spark, pairs))
    assert kept.columns == docs.columns and kept.where(F.col("doc_id") >= 1000).count() == len(AWKWARD)
    nothing = T.toxicity(docs, labels_of(spark, [(0, 0), (1, 0)]))
    assert nothing.where("predicted = 1").count() == 0
    assert T.toxicity(docs_of(spark, []), labels_of(spark, [])).count() == 0
