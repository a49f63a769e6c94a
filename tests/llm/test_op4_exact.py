import hashlib
import random
import re

import pytest

from leadlens.llm import op4_exact_dedup as D
from tests.llm.helpers import AWKWARD, docs_of, prose


def normal(t):
    return re.sub("[\x20\x09-\x0D]+", " ", t or "")


def check(out, rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(normal(t), []).append(i)
    kept = {}
    for r in out:
        text = next(t for t in groups if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
        ids = groups[text]
        assert r.doc_id in ids and r.group_size == len(ids)
        assert r.keep_id == min((x for x in ids if x is not None), default=None)
        kept[text] = kept.get(text, 0) + r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert len(out) == len(rows) and set(kept.values()) <= {1}


LONG = prose(1, 3000)
ROWS = [*enumerate(AWKWARD), (50, LONG), (41, LONG.replace(" ", "\n\t")), (42, LONG + "x"), (43, "y" + LONG), (44, LONG[:-1]),
        (None, "only null ids"), (None, "only null ids"), (None, LONG), (60, "twice"), (60, "twice"), (61, "twice"),
        *[(100 + i, f"doc {i % 4} " + prose(i % 4, 400)) for i in range(40)]]


@pytest.mark.parametrize("bits", [64, 2, 0])
def test_equals_grouping_by_text_even_if_all_hashes_collide(spark, bits):
    # Same lengths in other words, so that few bits collide.
    rows = ROWS + [(200 + i, "".join("ab"[i >> k & 1] for k in range(5))) for i in range(32)]
    check(D.exact_dedup(docs_of(spark, rows), hash_bits=bits).collect(), rows)


def test_chunks_join_to_the_text_and_resist_edits(spark):
    rng = random.Random(5)
    text = " ".join("".join(rng.choices("abcdefghiklmnoprstu", k=rng.randrange(1, 9))) for _ in range(20_000))
    one, two = (spark.createDataFrame([(t,)], "t string").select(D.chunks_of(D.normalised("t")).alias("c")).first().c
                for t in (text, "an edit " + text))
    assert "".join(one) == text and max(map(len, one)) <= D.MAX_CHUNK
    assert len(one) > 10 and len(set(one) & set(two)) >= len(one) - 4


def test_rows_that_stay(spark):
    docs = docs_of(spark, ROWS, extra=True)
    kept = D.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    texts = [normal(r.text) for r in kept.collect()]
    assert sorted(texts) == sorted({normal(t) for _, t in ROWS})
    unique = docs_of(spark, ["a b", "a  b", "c"])
    assert sorted(r.doc_id for r in D.drop_exact_copies(unique).collect()) == [0, 2]
    assert D.drop_exact_copies(docs_of(spark, [])).count() == 0 and D.exact_dedup(docs_of(spark, [])).count() == 0


def test_plan_has_no_python(spark, capsys):
    D.exact_dedup(docs_of(spark, ["a", "a"])).explain()
    assert "Python" not in (text := capsys.readouterr().out) and "Arrow" not in text
