import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from leadlens.llm import op10_pii as P
from tests.llm.helpers import AWKWARD, docs_of

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base(t):
    out = [("email", m) for m in EMAIL.finditer(t)]
    out += [("ip", m) for m in IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out += [("card", m) for m in CARD.finditer(t) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [("phone", m) for m in PHONE.finditer(t) if 8 <= len(digits(m)) <= 15]
    return [f"{k}:{m.start()}:{m.end()}" for k, m in out]


def found(t):
    return P.spans_text([(k, a, b) for k, a, b, ok in P.proposals(t) if ok])


@settings(max_examples=800, deadline=None)
@given(st.text(alphabet="a@.-+%0129 ()é", max_size=60))
def test_base_spans_equal_the_plain_patterns(t):
    assert found(t) == ",".join(base(t))


CARDS = ["4111 1111 1111 1111", "4111-1111-1111-1112", "4111111111111111", "378282246310005", "6011000990139424"]


def texts(n=160):
    rng = random.Random(4)
    out = []
    for i in range(n):
        number = "".join(rng.choices("0123456789", k=rng.choice([7, 9, 16])))
        out.append(rng.choice([
            f"call phone +1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)} now", f"mail me at u{i}@mail.example.com, please",
            f"host {rng.randrange(300)}.{rng.randrange(300)}.7.9 is up", f"order {number} shipped", f"card {rng.choice(CARDS)} paid",
            f"phone (0{rng.randrange(20, 99)}) 5551 {rng.randrange(1000, 9999)} home", f"mail bob(at)mail{i}(dot)example.com soon"]))
    return out


def test_base_spans_stay_and_added_ones_are_wider_kinds(spark):
    rows = [*AWKWARD, *texts(), "+" + "1" * 3000, "1" * 3000, "a" * 3000, "1.2.3.4.5.6.7.8 a@b.c@d.e"]
    out = {r.doc_id: r for r in P.personal_data(docs_of(spark, rows, extra=True)).collect()}
    for i, t in enumerate(rows):
        want, got = base(t or ""), out[i].spans.split(",") if out[i].spans else []
        assert out[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert (out[i].n_email, out[i].n_ip, out[i].n_card, out[i].n_phone) == tuple(
            sum(s.startswith(k) for s in want) for k in P.BASE)
        added = [s for s in got if s not in want]
        assert [s for s in got if s in want] == want and len(added) == out[i].n_added
        assert all(s.split(":")[0] not in P.BASE for s in added)


def test_prose_and_dates_are_implausible():
    kind = {k: i for i, k in enumerate(P.KINDS)}
    for name, text, want in [("email_words", "bob(at)mail(dot)example.com", True), ("email_words", "bob at mail dot org", True),
                             ("email_words", "look at it. That", False), ("email_words", "up at home.now", False),
                             ("number_groups", "2021-03-04", False), ("number_groups", "123-45-6789", True),
                             ("phone_local", "(030) 5551 2345", True), ("phone_local", "123 456 78", False)]:
        assert P.plausible(kind[name], text) is want, text


def test_prose_gets_no_added_span(spark):
    prose = [f"they met at w{i}. Then w{i} left at noon. It rained on 2021-0{1 + i % 9}-11." for i in range(80)]
    out = P.personal_data(docs_of(spark, [*texts(), *prose])).collect()
    assert all(r.n_added == 0 for r in out if r.doc_id >= 160)


def test_best_of_overlapping_spans():
    spans = [dict(score=s, start=a, end=b, kind=5) for s, a, b in ((0.9, 0, 5), (0.9, 0, 8), (0.99, 20, 22), (0.5, 21, 30), (0.5, 30, 31))]
    assert sorted(P.chosen(spans)) == [(5, 0, 8), (5, 20, 22), (5, 30, 31)]


def test_no_examples_null_ids_and_empty_table(spark):
    out = P.personal_data(docs_of(spark, [(None, "a@b.c"), (None, "a@b.c"), (1, "none")])).collect()
    assert sorted(r.spans for r in out) == ["", "email:0:5", "email:0:5"]
    assert P.personal_data(docs_of(spark, [])).count() == 0


def test_wider_forms_are_proposed_as_their_kind():
    for kind, own in ((0, "u7.x@mail.example.com"), (0, "a@b.c"), (2, CARDS[0]), (3, "+1 (555) 123-4567"), (1, "10.20.30.40")):
        forms = P.wider_forms(kind, own)
        assert forms and all((k, 0, len(form), False) in P.proposals(form) for k, form, _ in forms)
    assert any(P.KINDS[k] == "email_words" for k, _, _ in P.wider_forms(0, "bob@mail.example.com"))


def test_planted_wider_spans_are_added_and_prose_and_dates_are_not(spark):
    planted = [("mail bob(at)mail(dot)example.com soon", 5, 32), ("write ann [at] mail [dot] org today", 6, 29),
               ("her ssn 123-45-6789 is", 8, 19), ("phone 030 5551 2345 home", 6, 19), ("call (030) 5551 2345 now", 5, 20)]
    rest = [x for i in range(80) for x in (
        f"they met at w{i}. Then w{i} left at noon. It rained on 2021-0{1 + i % 9}-11.", f"ticket 4111-1111-1111-{1000 + 3 * i} lost")]
    rest = [x for x in rest if not base(x)]
    base_only = [x for x in texts(400) if "(at)" not in x and "(0" not in x]
    rows = [*[t for t, _, _ in planted], *rest, *base_only]
    out = {r.doc_id: r for r in P.personal_data(docs_of(spark, rows)).collect()}
    for i, (text, a, b) in enumerate(planted):
        assert out[i].n_added == 1 and out[i].spans.split(":")[1:] == [str(a), str(b)], (text, out[i].spans)
    assert [r.spans for r in out.values() if r.doc_id >= len(planted) and r.n_added] == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(1, 12), st.floats(0, 1)), max_size=25))
def test_searches_in_ranges_equal_comparing_all(drawn):
    spans = [(a, a + n) for a, n, _ in drawn]
    ranges = P.Ranges(spans)
    for a in range(0, 50, 3):
        for b in range(a + 1, 54, 4):
            assert ranges.cover(a, b) is any(x <= a and b <= y for x, y in spans)
            assert ranges.meet(a, b) is any(x < b and a < y for x, y in spans)
    rows = [dict(score=s, start=a, end=a + n, kind=5) for a, n, s in drawn]
    want = []
    for r in sorted(rows, key=lambda r: (-r["score"], r["start"] - r["end"], r["start"], r["end"])):
        if all(r["end"] <= x or y <= r["start"] for _, x, y in want):
            want.append((5, r["start"], r["end"]))
    assert P.chosen(rows) == sorted(want, key=lambda x: x[1])


def test_numbers_of_parts_orders_and_rows_are_not_added(spark):
    rng = random.Random(9)
    number = lambda *n: [str(rng.randrange(10 ** (k - 1), 10 ** k)) for k in n]
    other = [*["part no " + "-".join(number(3, 4, 6)) + " fits" for _ in range(60)], *["totals were " + " ".join(number(3, 4, 3)) + " in all" for _ in range(60)],
             *["order " + "-".join(number(3, 3, 4)) + " left" for _ in range(60)], *["row 3: 12 " + " ".join(number(3, 4, 4)) + " end" for _ in range(60)]]
    own = [*["call (0" + number(2)[0] + ") " + " ".join(number(4, 4)) + " now" for _ in range(30)], *["her ssn " + "-".join(number(3, 2, 4)) + " is" for _ in range(30)]]
    base_only = [x for x in texts(400) if "(at)" not in x and "(0" not in x]
    out = {r.doc_id: r for r in P.personal_data(docs_of(spark, [*other, *own, *base_only])).collect()}
    assert sum(out[i].n_added > 0 for i in range(len(other))) < 0.05 * len(other)
    assert sum(out[i].n_added == 1 for i in range(len(other), len(other) + len(own))) > 0.9 * len(own)


def test_a_long_text_takes_time_in_proportion(spark):
    import time
    text = "1.2.3.4 123-45-6789 " * 100_000
    at = time.time()
    row = P.scan(docs_of(spark, [text]), "doc_id", "text").selectExpr("n_ip", "size(proposed) AS n").first()
    assert row.n_ip == 100_000 and row.n > 100_000 and time.time() - at < 60


def test_every_taught_proposal_is_learned_or_calibrated(spark, monkeypatch):
    docs = docs_of(spark, [(i, " ".join(f"write to u{i}x{j}@mail.example.com or +4930{i:03d}{j:04d} now" for j in range(60))) for i in range(120)])
    seen = []

    class Recorded(P.Boosted):
        def __init__(self, fit, calibrate, **kw):
            seen.append(fit.count() + calibrate.count())
            super().__init__(fit, calibrate, **kw)

    monkeypatch.setattr(P, "Boosted", Recorded)
    assert P.personal_data(docs).count() == 120
    taught = P.scan(docs, "doc_id", "text").select(F.explode("proposed").alias("p")).where("p.taught").count()
    assert taught > 40_000 and seen == [taught]
