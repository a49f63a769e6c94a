import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from leadlens.llm import encoding as E
from leadlens.llm import op11_repair_ids as R
from leadlens.llm.common import materialized, table
from leadlens.llm.queries import QUERIES
from tests.llm.helpers import AWKWARD, docs_of, prose

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [*AWKWARD, "Don't  STOP now　x", "a\x1cb \x1d", "<|endoftext|> in <|startoftext|>text", "\x01 \x01a\x01", "é é  Σ"]


def plain_ids(texts, end_id=1):
    t = E.json_tokenizer(PATH)
    return [[*t.encode(x or "", add_special_tokens=False).ids, end_id] for x in texts]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def expected(rows):
    """doc_id, start, n_tokens, ids_crc32 by encoding each text by itself; rows are (id, text) with ids of their own."""
    out, at = [], 0
    for (doc_id, _), ids in zip(rows, plain_ids([t for _, t in rows]), strict=True):
        out.append((doc_id, at, len(ids), crc(ids)))
        at += len(ids)
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5), min_size=1, max_size=60), min_size=1, max_size=8))
def test_blocks_give_every_stretch_back(docs):
    block = R.Block(R.write_block(list(range(len(docs))), [np.array(d, np.uint32) for d in docs]))
    assert [(i, x.tolist()) for i, x, _ in block.documents()] == list(enumerate(docs))
    for k, d in enumerate(docs):
        for a, b in ((0, len(d)), (len(d) // 3, len(d) // 2), (len(d) - 1, len(d) + 5), (3, 1)):
            assert block.ids(k, a, b).tolist() == d[a:b]


def test_grammar_replaces_frequent_pairs_within_documents():
    rng = random.Random(3)
    docs = [np.array([rng.randrange(4) for _ in range(rng.randrange(1, 400))], np.uint32) for _ in range(30)] + [np.zeros(1000, np.uint32)]
    ids = np.concatenate(docs)
    seq, ends, rules, first = R.grammar(ids, np.cumsum([len(d) for d in docs]))
    assert len(rules) > 20 and len(seq) < len(ids) / 3 and first == 4
    block = R.Block(R.write_block([0] * len(docs), docs))
    for k, d in enumerate(docs):  # each document's own symbols expand to it alone
        assert block.expand(seq[ends[k - 1] if k else 0:ends[k]]).tolist() == d.tolist()
    # A pair is counted exactly: the first rule is a most frequent pair or one of a sixteenth of its count.
    pairs, n = np.unique(np.stack([ids[:-1], ids[1:]], 1), axis=0, return_counts=True)
    of = {tuple(p): c for p, c in zip(pairs.tolist(), n.tolist(), strict=True)}
    assert of[tuple(rules[0].tolist())] * R.STEP >= max(of.values())


def test_a_run_of_one_id_halves():
    seq, _, rules, _ = R.grammar(np.full(64, 7, np.uint32), np.array([64]))
    assert rules.tolist()[:2] == [[7, 7], [8, 8]] and len(seq) <= 8


def test_damage_is_noticed():
    raw = bytearray(R.write_block([1], [np.arange(50, dtype=np.uint32)]))
    raw[-1] ^= 1
    with pytest.raises((ValueError, IndexError)):
        list(R.Block(bytes(raw)).documents())


def test_ids_starts_and_order(spark):
    texts = [(i * 3, t) for i, t in enumerate(ODD)] + [(-5, prose(1, 900)), (1000, prose(1, 900))]
    rows = sorted(texts)
    random.Random(0).shuffle(texts)
    frame = docs_of(spark, texts, extra=True).repartition(5)
    folder = R.ids_folder(spark)
    index = R.write_ids(materialized(R.token_ids(frame, PATH), "t"), folder, R.id_type(PATH, 1), block_tokens=700, part_bytes=4_000)
    assert index.count() > 5 and index.select("part").distinct().count() > 2
    got = sorted(R.read_ids(index, folder).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got] == expected(rows)
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in got] == plain_ids([t for _, t in rows])


def test_null_and_repeated_ids_and_an_empty_table(spark):
    rows = [(None, "b c"), (4, "same"), (4, "same"), (4, "other text"), (None, None)]
    got = sorted(R.stored_and_read(docs_of(spark, rows), PATH).collect(), key=lambda r: r.start)
    sizes = sorted((str(i), *p) for (i, _), p in zip(rows, ((len(x), crc(x)) for x in plain_ids([t for _, t in rows])), strict=True))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sizes
    assert [r.doc_id for r in got] == [None, None, 4, 4, 4]
    assert [r.start for r in got] == [sum(r.n_tokens for r in got[:k]) for k in range(5)]
    assert R.stored_and_read(docs_of(spark, []), PATH).count() == 0


def test_pieces_of_a_very_long_text():
    text = prose(2, 40_000) + " " * 9 + "x" * 5_000
    assert "".join(E.pieces(text, 1_000)) == text
    encoder = E.word_encoder(PATH)
    whole = np.frombuffer(encoder.of([E.word_chunks(text)])[0][0], "<u4").tolist()
    assert [x for p in E.pieces(text, 1_000) for x in np.frombuffer(encoder.of([E.word_chunks(p)])[0][0], "<u4")] == whole
    assert whole == plain_ids([text])[0][:-1]


def test_whole_texts_by_their_distinct_words_equal_plain_encoding():
    texts = [*ODD, "", "\x00 \x00a", "e\u0301 H\u0331 \u03a3\u0391\u03a3.", "a\u00a0b \u00a0 ", "Isn't IT 12ab?!", *[prose(i, 300) for i in range(8)]]
    for most in (600_000, 3):  # kept words, and none to speak of
        encoder = E.word_encoder(PATH, most_words=most)
        ids, upto = encoder.joined(pa.array([None, *texts]).slice(1))
        starts = [0, *upto.tolist()]
        assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == [x[:-1] for x in plain_ids(texts)]
    assert encoder.joined(pa.array([], pa.string()))[1].tolist() == [] and encoder.joined(pa.array([""]))[1].tolist() == [0]


def test_long_texts_between_short_ones_are_taken_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(R, "PIECE_CHARS", 200)
    monkeypatch.setattr(R, "GROUP_BYTES", 150)
    rows = [(i, prose(i, n)) for i, n in enumerate((3, 400, 5, 300, 300, 2, 1, 30, 9))] + [(90, None), (91, "")]
    kind = R.id_type(PATH, 1)
    got = {r.doc_id: np.frombuffer(r.ids, kind).tolist() for r in R.token_ids(docs_of(spark, rows), PATH).collect()}
    assert got == dict(zip([i for i, _ in rows], plain_ids([t for _, t in rows]), strict=True))


def test_a_full_cache_changes_nothing():
    encoder = E.word_encoder(PATH)
    encoder.most = 50
    texts = [prose(i, 40) for i in range(20)]
    got = [np.frombuffer(x, "<u4").tolist() for i in range(0, 20, 3) for x in encoder.of([E.word_chunks(t) for t in texts[i:i + 3]])[0]]
    assert got == [x[:-1] for x in plain_ids(texts)] and len(encoder.known) <= 150


def test_query_equals_plain_encoding(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").select("doc_id", "text").orderBy("doc_id").collect()]
    got = QUERIES["op11_repair_ids"](spark, sf).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == expected(rows)


def test_slots_follow_the_replaced_pairs(monkeypatch):
    rng = random.Random(8)
    ids = np.array([rng.choice((2, 3, 3, 4, 5)) for _ in range(3_000)] + [7] * 50, np.uint32)
    ends, seen, inner = np.array([700, 701, 2_000, len(ids)]), [], R.frequent_pairs

    def watched(seq, last, slot, bound, least, most):
        seen.append(len(seq))
        assert slot.tolist() == R.slots(seq[:-1], seq[1:]).tolist()
        assert bound.tolist() == np.bincount(slot, minlength=1 << R.SLOT_BITS).tolist()
        return inner(seq, last, slot, bound, least, most)

    monkeypatch.setattr(R, "frequent_pairs", watched)
    R.grammar(ids, ends)
    assert len(seen) > 2


def test_words_go_to_the_model_as_their_bytes():
    words = ["and", "été", "\x00\x01", "\x7f", "'s", "!?", "7", "ÿß", "x" * 300]
    assert [np.frombuffer(x, "<u4").tolist() for x in E.word_encoder(PATH).ids_of_words(words)] == [x[:-1] for x in plain_ids(words)]


def test_rounds_over_linked_symbols_give_every_document_back(monkeypatch):
    monkeypatch.setattr(R, "LEAST_LINKED", 0)
    inner, seen = R.linked_rounds, []
    monkeypatch.setattr(R, "linked_rounds", lambda seq, *a: seen.append(len(seq)) or inner(seq, *a))
    rng = random.Random(5)
    for barred in (0.0, 0.4):  # linked from the first round on, or after some
        monkeypatch.setattr(R, "MOST_BARRED", barred)
        docs = [np.array([rng.randrange(6) for _ in range(rng.randrange(1, 300))], np.uint32) for _ in range(40)] + [np.zeros(999, np.uint32)]
        ids = np.concatenate(docs)
        seq, ends, rules, first = R.grammar(ids, np.cumsum([len(d) for d in docs]))
        assert len(rules) > 20 and len(seq) < len(ids) / 2 and len(ends) == len(docs) and ends[-1] == len(seq)
        block = R.Block(R.write_block([0] * len(docs), docs))
        for k, d in enumerate(docs):
            assert block.expand(seq[ends[k - 1] if k else 0:ends[k]]).tolist() == d.tolist()
        # No pair is left that occurs often enough, but where occurrences overlap.
        pairs, n = np.unique([p for a, b in zip([0, *ends[:-1]], ends) for p in zip(seq[a:b - 1], seq[a + 1:b])], axis=0, return_counts=True)
        assert all(a == b for (a, b), k in zip(pairs.tolist(), n.tolist(), strict=True) if k >= 2 * R.LEAST_COUNT)
    assert len(seen) >= 3


def test_linked_rounds_count_no_symbol_but_the_free_ones():
    """Positions known to be too rare are never counted again: on this block most are, after one round."""
    rng = np.random.default_rng(1)
    ids = np.concatenate([rng.integers(0, 60_000, 40_000), np.tile([1, 2, 3, 4], 5_000)]).astype(np.uint32)
    handled, inner = [], R.counted
    R.counted = lambda left, right, at: handled.append(len(at)) or inner(left, right, at)
    try:
        seq, ends, rules, first = R.grammar(ids, np.array([len(ids)]))
    finally:
        R.counted = inner
    assert len(rules) >= 3 and sum(handled) < 2 * len(ids) and handled[-1] < len(ids) / 20


def test_chunks_that_several_groups_have_are_encoded_once():
    encoder, seen = E.word_encoder(PATH), []
    inner = encoder.words.of
    encoder.words.of = lambda wanted: seen.append(sorted(wanted)) or inner(wanted)
    texts = [["the cat, The", "Été 12"], ["", "cat, don't <|endoftext|> ×"], ["THE été"]]
    got = list(encoder.together([pa.array(t) for t in texts]))
    assert [[ids[a:b].tolist() for a, b in zip([0, *upto.tolist()], upto.tolist())] for ids, upto in got] == [
        [x[:-1] for x in plain_ids(t)] for t in texts]
    assert seen[0] == sorted(["the", "cat", ",", "été", "1", "2"])
