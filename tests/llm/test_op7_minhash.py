import random

import numpy as np
import pyarrow as pa
import pytest

from leadlens.llm import op7_minhash as M
from leadlens.llm import shingles as S
from leadlens.llm.components import connected_components
from tests.llm.helpers import AWKWARD, docs_of


def shingle_set(text, words):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < words else [tuple(w[i:i + words]) for i in range(len(w) - words + 1)])


def components(links, nodes):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def plain(rows, words, percent=80):
    """(set size, component) by row number."""
    sets = [shingle_set(t, words) for _, t in rows]
    links = []
    for i, s in enumerate(sets):
        for j in range(i):
            both = len(s & sets[j])
            if both and 100 * both >= percent * (len(s) + len(sets[j]) - both):
                links.append((j, i))
    return [len(s) for s in sets], components(links, range(len(rows)))


def check(out, rows, words):
    sizes, comp = plain(rows, words)
    want = {}
    for i, (doc_id, _) in enumerate(rows):
        low = min((rows[j][0] for j in comp if comp[j] == comp[i] and rows[j][0] is not None), default=None)
        want.setdefault((str(doc_id), sizes[i], str(low)), []).append(comp[i])
    got = [(str(r.doc_id), r.n_shingles, str(r.component_id)) for r in out]
    assert sorted(got) == sorted(k for k, v in want.items() for _ in v)
    assert sum(r.kept for r in out) == len(set(comp.values()))
    assert all(r.doc_id == r.component_id for r in out if r.kept)


def family(seed, members, words=60, edits=5):
    rng = random.Random(seed)
    base = [f"f{seed}x{k}" for k in range(words)]
    for _ in range(members):
        w = list(base)
        for _ in range(rng.randrange(edits)):
            w[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        yield " ".join(w)


def corpus():
    rng = random.Random(9)
    texts = [*AWKWARD, "One two", "one TWO", "one", "two", "a b c d e", "a b c d e f", "a b c d e f", "q r s t u v", "q r s t u w"]
    for k, m in enumerate((2, 3, 40, 7)):
        texts += family(k, m)
    texts += [" ".join(rng.choices("abcdefgh", k=rng.randrange(1, 14))) for _ in range(60)]
    # A passage that many different texts share.
    texts += [" ".join([f"p{j}" for j in range(30)] + [f"u{i}v{j}" for j in range(rng.randrange(3, 60))]) for i in range(60)]
    return texts


@pytest.mark.parametrize(("words", "short", "block", "rounds"), [(2, 16, 1024, 1), (2, 2, 7, 0), (5, 3, 8, 2)])
def test_equals_all_pairs(spark, monkeypatch, words, short, block, rounds):
    monkeypatch.setattr(M, "SHORT", short)
    monkeypatch.setattr(M, "BLOCK", block)
    monkeypatch.setattr(M, "ROUNDS", rounds)
    monkeypatch.setattr(M, "BUCKET", block)
    monkeypatch.setattr(M, "COUNTED", 5 if block < 8 else 1000)
    rows = [*enumerate(corpus(), 10), (3, "one two three four five six"), (3, "one two three four five six"), (None, "null id"),
            (None, "null id"), (5, "one two three four five six")]
    check(M.near_duplicates(docs_of(spark, rows, extra=True), words=words).collect(), rows, words)


def test_rows_that_stay_and_empty_tables(spark):
    docs = docs_of(spark, [*family(1, 6), None, "", "lone words here"], extra=True)
    kept = M.drop_near_copies(docs, words=2)
    assert kept.columns == docs.columns and kept.count() == len(set(plain([(r.doc_id, r.text) for r in docs.collect()], 2)[1].values()))
    assert M.near_duplicates(docs_of(spark, [])).count() == 0
    assert M.near_duplicates(docs_of(spark, [None, ""])).where("kept").count() == 2


@pytest.mark.parametrize("words", [1, 2, 5])
def test_shingle_sets_equal_plain_sets(monkeypatch, words):
    monkeypatch.setattr(S, "CHUNK_BYTES", 50)
    texts = [t for t in corpus() if len(t or "") < 3000] + ["", "é ü\tÄ x", " lead", "trail "]
    hashes = {}
    sizes = []
    for _, _, raw, starts in S.chunks(pa.array(texts)):
        sets, counts = S.shingle_sets(raw, starts, words)
        sizes += [sets[e - c:e].tolist() for c, e in zip(counts, np.cumsum(counts), strict=True)]
    for t, got in zip(texts, sizes, strict=True):
        want = shingle_set(t, words)
        assert len(got) == len(want)
        hashes.setdefault(want, set()).add(tuple(got))
    assert all(len(v) == 1 for v in hashes.values()) and len({v.pop() for v in hashes.values()}) == len(hashes)


def test_components_of_chains_stars_and_rings(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(100, 160)] + [(200, i) for i in range(201, 230)] + [(300, 301), (301, 302), (302, 300)]
    links += [(rng.randrange(400, 440), rng.randrange(400, 440)) for _ in range(30)]
    names = list(range(500))
    rng.shuffle(names)
    links = [(names[a], names[b]) for a, b in links]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert set(got) == nodes and got == components([x for x in links if x[0] != x[1]], nodes)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
