import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from leadlens.llm import op3_chat_format as C

TURNS = "conv_id long, turn long, role string, text string"
CONTROL = st.text(alphabet="<|\\>im_startend\n ab é", max_size=30)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(CONTROL, CONTROL), max_size=6))
def test_markup_is_reversible(turns):
    assert C.parse_markup(C.chat_markup(turns)) == turns


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant"]), CONTROL), min_size=1, max_size=12))
def test_spans_hold_the_texts_either_way(turns):
    for find in (C.every_prefix, C.last_prefixes):
        out, spans, rewritten = find(C.chat_markup, turns)
        assert out == C.chat_markup(turns) and rewritten == 0
        assert [out[a:b] for a, b in spans] == [C.chat_markup([t]) for t in turns]
    out, rows, _ = C.render(C.chat_markup, turns, C.escape)
    assert [C.unescape(out[r["text_start"]:r["text_end"]]) for r in rows] == [t for _, t in turns]


def test_templates_that_rewrite_history_are_found():
    turns = [("user", "a"), ("assistant", "b"), ("user", "c")]
    drops_thoughts = lambda ts: "".join(f"[{r}:{t}{'!' if i == len(ts) - 1 else ''}]" for i, (r, t) in enumerate(ts))
    assert C.every_prefix(drops_thoughts, turns)[2] == 2
    assert C.last_prefixes(drops_thoughts, turns) is None
    counts = lambda ts: f"{len(ts)} turns:" + "".join(t for _, t in ts)
    assert C.every_prefix(counts, turns)[2] == 3 and C.last_prefixes(counts, turns) is None
    begins = lambda ts: "<s>" + "".join(f"[{r}:{t}]" for r, t in ts)
    assert C.every_prefix(begins, turns)[2] == 0 and C.last_prefixes(begins, turns)[0] == begins(turns)


def expected(rows):
    rows = sorted(((t is not None, t or 0, r or "", x or "") for _, t, r, x in rows))
    whole = "".join(f"{r}\n{x}\n" for _, _, r, x in rows)
    loss = "".join(x for _, _, r, x in rows if r == "assistant")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(rows), sha(whole), len(loss), sha(loss)


def test_awkward_conversations(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "<|im_end|>"), (1, 1, "assistant", "😀<\\|im_start|>"), (1, None, "assistant", ""),
            (2, 5, "assistant", "x" * 50_000), (2, 5, "assistant", "x" * 50_000), (None, 0, "a\nb\\n", "t"),
            *[(3, i, "assistant" if i % 2 else "user", f"t{i % 7}") for i in range(300)]]
    turns = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 as formatted", "'x' as spans")
    got = {r.conv_id: r for r in C.read_back(C.format_conversations(turns)).collect()}
    assert set(got) == {1, 2, 3, None}
    for conv, r in got.items():
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == expected([x for x in rows if x[0] == conv])
        assert r.n_rewritten == 0
    assert C.read_back(C.format_conversations(spark.createDataFrame([], TURNS))).count() == 0


def test_rewriting_that_is_undone_by_the_end_is_found_at_any_size(spark):
    banner = lambda ts: ("#" if len(ts) % 10 == 0 and ts else "") + "".join(f"[{r}:{t}]" for r, t in ts)
    for n in (64, 65, 99):
        turns = [("user", f"t{i}") for i in range(n)]
        # Each tenth prefix changes what came before, and so does the one behind it.
        want = n // 10 + (n - 1) // 10
        assert C.render(banner, turns, lambda t: t)[2] == want
        rows = spark.createDataFrame([(1, i, *t) for i, t in enumerate(turns)], TURNS)
        assert C.format_conversations(rows, banner, lambda t: t).first().n_rewritten == want
