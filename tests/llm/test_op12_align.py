import hashlib
import random
from collections import Counter

import public_tokenizers
import sentencepiece

from leadlens.llm import encoding as E
from leadlens.llm import op12_align as A
from leadlens.llm.common import table
from leadlens.llm.queries import QUERIES
from tests.llm.helpers import AWKWARD, docs_of, prose

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [*AWKWARD, " lead", "trail ", "two  spaces   three", "tab\t x\n\ny", "sign ▁ in text", "<s> <unk> <|endoftext|>", "　wide  x",
       "éé \U0001f600\U0001f468‍\U0001f469", "\x01 \x01x", "don't I'll 1234 !?", "\x1c x"]


def brute(rows):
    """The result by comparing all byte ranges of a text, one text at a time."""
    one = E.json_tokenizer(PATHS[0], plain_specials=True)
    two = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    bytes_a, bytes_b = E.byte_encoder(PATHS[0]).spelled, E.piece_encoder(PATHS[1]).spelled
    found, counts = [], Counter()
    for doc_id, text in rows:
        a = one.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = two.encode(text) if text else []
        whole = (" " + (text or "")).encode()
        if not text or b"".join(bytes_a[i] for i in a) != whole or b"".join(bytes_b[i] for i in b) != whole:
            a, b = [], []
        spans = []
        for ids, spelled in ((a, bytes_a), (b, bytes_b)):
            at, own = 0, []
            for i in ids:
                own.append((at, at + len(spelled[i]), i))
                at += len(spelled[i])
            spans.append(own)
        links = []
        j = 0
        for s, e, i in spans[0]:
            while j and spans[1][j - 1][1] > s:
                j -= 1
            while j < len(b) and spans[1][j][0] < e:
                if spans[1][j][1] > s:
                    links.append((i, spans[1][j][2]))
                j += 1
        counts.update(links)
        both = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, begin = [], 0
        x = y = 0
        for end in both:
            own = [[], []]
            while x < len(a) and spans[0][x][1] <= end:
                own[0].append(str(spans[0][x][2]))
                x += 1
            while y < len(b) and spans[1][y][1] <= end:
                own[1].append(str(spans[1][y][2]))
                y += 1
            groups.append(",".join(own[0]) + "|" + ",".join(own[1]))
            begin = end
        assert begin == (len(whole) if a else 0)
        found.append((doc_id, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [(d, na, nb, ng, len(ls), sum(counts[p] == best[p[1]] for p in ls), sum(counts[p] for p in ls), sha)
            for d, na, nb, ng, ls, sha in found]


def result(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_awkward_texts_equal_brute_force(spark):
    rng = random.Random(4)
    signs = list("abAB'' \t\n1.,!é") + ["  ", "　", "▁", "\U0001f600", " the", "ing"]
    rows = list(enumerate([*ODD, *["".join(rng.choice(signs) for _ in range(rng.randrange(60))) for _ in range(300)], prose(5, 700)]))
    rows += [(None, "null id"), (7, "repeated"), (7, "repeated")]
    want = sorted(brute(rows), key=str)
    frame = docs_of(spark, rows, extra=True)
    # One block and piece, and many of each: where texts are cut changes nothing.
    assert result(A.aligned(frame.repartition(3), *PATHS)) == want
    assert result(A.aligned(frame.repartition(2), *PATHS, block_chars=500, piece_chars=90)) == want


def test_an_empty_table_and_no_text(spark):
    assert A.aligned(docs_of(spark, []), *PATHS).count() == 0
    assert result(A.aligned(docs_of(spark, [None, ""]), *PATHS)) == [(0, *[0] * 6, ""), (1, *[0] * 6, "")]


def test_a_long_text_with_one_odd_piece_has_no_tokens(spark):
    text = prose(1, 3_000) + " ▁ " + prose(2, 3_000)
    got = result(A.aligned(docs_of(spark, [text, "plain words"]), *PATHS, piece_chars=1_000))
    assert got == sorted(brute([(0, text), (1, "plain words")]), key=str) and got[0][1:] == (0, 0, 0, 0, 0, 0, "")


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    assert result(QUERIES["op12_align"](spark, sf)) == sorted(brute(rows), key=str)


def test_links_are_stored_in_two_bytes_and_blocks_stay_small(spark):
    blocks = A.aligned_blocks(docs_of(spark, [prose(i, 3_000) for i in range(120)]).repartition(1), *PATHS).collect()
    assert len(blocks) > 1
    for b in blocks:
        assert len(b.links) == 2 * sum(d.n_links for d in b.docs) <= 2 * (A.BLOCK_CHARS + 100_000)
    assert A.place_type(1 << 16) == "<u2" and A.place_type((1 << 16) + 1) == "<i4"


def test_a_chunk_is_encoded_once_in_a_task_however_often_it_occurs():
    one, two = A.Side(E.byte_encoder(PATHS[0])), A.Side(E.piece_encoder(PATHS[1]))
    rows, met = [(i, t) for i, t in enumerate([prose(1, 400), "a ▁ b", prose(1, 200), *ODD, "a b"])], []
    encode = one.encoder.encode
    one.encoder.encode = lambda chunks: met.extend(chunks) or encode(chunks)
    chunks = A.Chunks(one, two)
    for _ in range(2):  # two blocks
        docs = []
        for doc_id, text in rows:
            docs.append(A.Doc(doc_id))
            docs[-1].chunks = [chunks.numbered(p) for p in E.pieces(" " + text, 300)] if text else []
            chunks.align()
        pairs, counts, links = chunks.block(docs)
        got = [tuple(d.row().values()) for d in docs]
        assert got == [(*x[:5], x[7]) for x in brute(rows)]
        assert counts.sum() == len(links) == sum(d.n["n_links"] for d in docs) and counts.min() > 0 and links.max() + 1 == len(pairs)
    assert len(met) == len(set(met))


def test_a_task_that_keeps_few_chunks_gives_the_same_blocks(spark):
    frame = docs_of(spark, [*ODD, *[prose(i % 7, 50) for i in range(30)]]).repartition(1)
    found = []
    for most in (1, A.MOST_CHUNKS):
        blocks = A.aligned_blocks(frame, *PATHS, block_chars=400, most_chunks=most).collect()
        assert len(blocks) > 3
        found.append(sorted((str(b.docs), b.pairs, b.counts, bytes(b.links)) for b in blocks))
    assert found[0] == found[1]
