import hashlib
import random
import re

import pytest

from leadlens.llm import op6_decontaminate as D
from tests.llm.helpers import AWKWARD, docs_of, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall((t or "").translate(LOWER))


def plain(doc, items):
    d, hit, ids = words(doc), set(), set()
    for item_id, text in items:
        w = words(text)
        n = min(10, len(w))
        for s in range(len(w) - n + 1) if w else ():
            for q in range(len(d) - n + 1):
                if d[q:q + n] == w[s:s + n]:
                    hit |= set(range(q, q + n))
                    ids.add("" if item_id is None else str(item_id))
    return len(d), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)


ITEMS = [(1, prose(1, 30, 6)), (2, "Ünï Codé"), (3, None), (4, "?!"), (10, prose(2, 10, 50)), (11, prose(3, 25, 50).upper()),
         (12, "w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1"), (None, "lone item"), (11, "w2 w2"), (13, "É")]


def texts():
    rng = random.Random(1)
    out = [*AWKWARD, "w1 " * 40, "w1-w1.w1 " * 4, "ünï codé", "ÜNÏ codé; Ünï CODÉ", "é É", "a lone ITEM here", ITEMS[4][1]]
    for i in range(60):
        w = prose(100 + i, 40, 6).split()
        item = words(rng.choice(ITEMS)[1])
        at, s = rng.randrange(len(w)), rng.randrange(max(1, len(item)))
        w[at:at] = item[s:s + rng.choice([9, 10, 11, 20])]
        out.append(rng.choice([" ", "\n", ", "]).join(w))
    return out


@pytest.mark.parametrize("broadcast", [True, False])
def test_equals_every_window_at_every_position(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(D, "MAX_BROADCAST_WORDS", 0)
        monkeypatch.setattr(D, "MAX_BROADCAST_KEYS", 0)
    rows = [*enumerate(texts()), (7, "lone item"), (7, "lone item"), (None, ITEMS[4][1]), (None, "nothing")]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted((str(r[0]), *r[1:]) for r in D.contamination(docs_of(spark, rows, extra=True), items).collect())
    assert got == sorted((str(i), *plain(t, ITEMS)) for i, t in rows)


def test_rows_that_stay_and_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = docs_of(spark, ["a lone item", "clean", "clean", None, (1, "clean")], extra=True)
    kept = D.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 1, 2, 3]
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.contaminated for r in D.contamination(docs, none).collect()] == [False] * 5
    assert D.contamination(docs_of(spark, []), items).count() == 0


def test_plan_has_no_python(spark, capsys):
    D.contamination(docs_of(spark, ["a"]), spark.createDataFrame(ITEMS, "item_id long, text string")).explain()
    assert "Python" not in (text := capsys.readouterr().out) and "Arrow" not in text


def test_keys_by_shuffle_and_key_words_by_broadcast(spark, monkeypatch):
    monkeypatch.setattr(D, "MAX_BROADCAST_KEYS", 0)
    rows = [*enumerate(texts()), (7, "lone item"), (7, "lone item"), (None, ITEMS[4][1])]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted((str(r[0]), *r[1:]) for r in D.contamination(docs_of(spark, rows), items).collect())
    assert got == sorted((str(i), *plain(t, ITEMS)) for i, t in rows)
