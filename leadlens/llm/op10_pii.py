r"""Personal data: candidate boosting.

1. *Generators* with high recall propose spans in every whole text; their
   spans may overlap.  Those of the base kinds (email, ip, card, phone) are
   found left to right without overlap within a kind, and are final where
   they pass their check (parts up to 255, 16 to 19 digits and Luhn, 8 to 15
   digits).  The others (disguised mail, local phone numbers, grouped numbers)
   are wider; those that read as prose, as a date or as a card number with a
   wrong check digit are implausible.
2. *Features* of a proposal: its wider kind, its format (lengths, digits,
   groups, separators, check digit) and its context (neighbouring characters,
   words before it that announce personal data).
3. *Boosted trees* learn from base proposals, for which the check says whether
   they are personal data, from implausible wider ones, which aren't, and from
   base spans rewritten to wider forms (an address with (at) and (dot), a
   number without its country code or in groups), in place and alone, which are.  The
   same rewritten numbers behind words for parts, orders, sums and measures or in
   rows of figures (``ELSEWHERE``) are none: the kind of negative that is judged.  A
   base proposal that fails its check says nothing where a plausible wider one
   covers it.  They learn on the proposals of all documents but a quarter (by a
   hash of the id), which only calibrates.  The threshold is the lowest
   calibrated score that keeps ``PRECISION`` on the wider kinds in that quarter.
4. *Selection.*  Plausible wider proposals that reach the threshold and don't
   overlap a base span are added, the highest score first among overlapping
   ones.  Base spans always stay.

A null text is empty.  Without examples of both labels nothing is added.
Repeated rows are rows of their own, null ids allowed.  An empty table gives
an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlens.llm.boosted import Boosted
from leadlens.llm.common import materialized

PRECISION = 0.98
CONTEXT = 40

LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A number that begins within a run of digits would have begun with it, so only whole runs are tried.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
BASE = ("email", "ip", "card", "phone")
#: Wider generators.
WIDER = (
    ("email_words", re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}[\x20]?(?:\(at\)|\[at\]|\{at\}|\x20at\x20)[\x20]?"
                               r"[A-Za-z0-9-]{1,63}(?:[\x20]?(?:\.|\(dot\)|\[dot\]|\x20dot\x20)[\x20]?[A-Za-z0-9-]{1,63}){1,4}")),
    ("phone_local", re.compile(r"(?<![0-9+])(?:\([0-9]{2,5}\)|0[0-9]{1,4}|[0-9]{3})[\x20./-][0-9]{3,4}[\x20.-]?[0-9]{3,5}(?![0-9])")),
    ("number_groups", re.compile(r"(?<![0-9])[0-9]{2,4}(?:-[0-9]{2,6}){2,3}(?![0-9])")),
)
KINDS = BASE + tuple(k for k, _ in WIDER)
ANNOUNCED = (re.compile(r"e-?mail|mail|correo|courriel", re.I), re.compile(r"phone|tel|call|mobile|fax|handy", re.I),
             re.compile(r"card|karte|carte|tarjeta|visa|iban|account|konto", re.I),
             re.compile(r"\bip\b|address|adresse|host|server", re.I),
             re.compile(r"name|contact|kontakt|write|ssn|passport", re.I))

#: Words that announce other numbers, and a number that goes before: rows of figures.
OTHER = (re.compile(r"\b(?:part|item|sku|model|serial|order|invoice|ticket|ref|batch|lot|version|build|article|bestell|pedido|commande)", re.I),
         re.compile(r"\b(?:totals?|sums?|prices?|costs?|amounts?|figures|counts?|weighs?|measures?|sizes?|width|height|rows?|values?)\b", re.I),
         re.compile(r"[0-9][\x20,;|\t]+\Z"))
#: What stands before a number of personal form that isn't personal data; the trees learn against such numbers.
ELSEWHERE = ("part no ", "the part number is ", "item ", "sku ", "serial no. ", "order ", "your order no. ", "invoice ", "ticket ", "ref. ",
             "batch ", "version ", "totals were ", "the sum of ", "prices of ", "amounts to ", "it measures ", "size ", "row 12 ", "values: ",
             "12.5 207 ", "4, 18, 260, ", "1 22 333 ")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Spans of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, found from each @ outwards.

    The part before the @ reaches back to the first character that isn't of
    its class, or to the last match, as the pattern would from the left; but
    long runs without an @ cost nothing.
    """
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        right = DOMAIN.match(text, at + 1) if start < at else None
        if right:
            yield start, right.end()
            done = right.end()
        else:
            done = max(done, at + 1)  # no match reaches over this @
        at = text.find("@", max(at + 1, done))


DATE = re.compile(r"(?:19|20)[0-9]{2}-[01]?[0-9]-[0-3]?[0-9]|[0-3]?[0-9]-[01]?[0-9]-(?:[0-9]{2}){1,2}")


def plausible(kind: int, own: str) -> bool:
    """Whether a wider proposal can be what its kind says, by its own text."""
    name = KINDS[kind]
    if name == "email_words":
        spoken = " at " in own
        return ". " not in own and " ." not in own and (not spoken or " dot " in own)
    digits = sum(c in "0123456789" for c in own)
    if name == "number_groups":  # a card number with a right check digit is a base span
        return not DATE.fullmatch(own) and not 16 <= digits <= 19
    return digits >= 9


#: How @ and the dots of an address are disguised, without and with spaces around.
DISGUISES = [(f"{p}{at}{p}", f"{p}{dot}{p}") for at, dot in (("(at)", "(dot)"), ("[at]", "[dot]"), ("{at}", "(dot)")) for p in ("", " ")]
DISGUISES += [("(at)", "."), ("[at]", "."), ("{at}", "."), (" at ", " dot "), (" at ", " dot "), (" (at) ", ".")]
#: Group lengths and what stands around the groups.
LOCAL_FORMS = ("({:3}) {:3}-{:4}", "({:3}) {:4} {:4}", "0{:2} {:4} {:4}", "0{:3}/{:3}-{:4}", "{:3}-{:3}-{:4}", "{:3} {:3} {:4}", "{:3}.{:3}.{:4}")
GROUP_FORMS = ("{:3}-{:2}-{:4}", "{:3}-{:3}-{:4}", "{:2}-{:4}-{:4}", "{:4}-{:4}-{:4}")


def in_form(form: str, digits: str) -> str:
    """``digits`` in the groups of ``form``."""
    left = iter(digits)
    return re.sub(r"\{:(\d)\}", lambda m: "".join(next(left) for _ in range(int(m[1]))), form)


def wider_forms(kind: int, own: str) -> list[tuple[int, str, bool]]:
    """(wider kind, text, whether it stands alone) of what a base span could have been instead; a hash of it draws the forms.

    Forms in the span's place learn its context, those that stand alone that the form may do without.
    """
    draw = zlib.crc32(own.encode("utf-8", "surrogatepass"))
    # The last digits, so without a country code; drawn ones where the span has too few.
    digits = "".join(re.findall(r"[0-9]", own))[-10:]
    numbers = {"phone_local": LOCAL_FORMS[draw // 2 % len(LOCAL_FORMS)], "number_groups": GROUP_FORMS[draw // 2 % len(GROUP_FORMS)]}
    placed = ("phone_local", "number_groups")[draw % 2]
    found = []
    for name, form in numbers.items():
        alone = name != placed
        drawn = f"{zlib.crc32(own[::-1].encode('utf-8', 'surrogatepass')):010d}{draw:010d}"
        found.append((name, in_form(form, (drawn[::-1] if alone else digits + drawn)[:12]), alone))
    if KINDS[kind] == "email":
        local, domain = own.split("@")
        for alone in (False, True):
            at, dot = DISGUISES[(draw // 2 + 5 * alone) % len(DISGUISES)]
            # In every third only the first dot is disguised.
            found.append(("email_words", local + at + domain.replace(".", dot, 1 if draw % 3 == 0 else -1), alone))
    out = [(KINDS.index(k), form, alone) for k, form, alone in found]
    return [x for x in out if WIDER[x[0] - len(BASE)][1].fullmatch(x[1]) and plausible(*x[:2])]


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def proposals(text: str) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, whether a base check passes), by kind as listed, then start."""
    found = [(0, a, b, True) for a, b in emails(text)]
    for m in IP.finditer(text):
        found.append((1, m.start(), m.end(), all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))))
    for m in CARD.finditer(text):
        digits = re.sub(r"[\x20-]", "", m[0])
        found.append((2, m.start(), m.end(), 16 <= len(digits) <= 19 and luhn(digits)))
    for m in PHONE.finditer(text):
        found.append((3, m.start(), m.end(), 8 <= sum(c in "0123456789" for c in m[0]) <= 15))
    for order, (_, pattern) in enumerate(WIDER, len(BASE)):
        found += [(order, m.start(), m.end(), False) for m in pattern.finditer(text)]
    return found


def features_of(text: str, kind: int, start: int, end: int) -> list[float]:
    return described(kind, text[start:end], text[max(0, start - CONTEXT):start], text[end:end + 8])


def described(kind: int, own: str, before: str, after: str) -> list[float]:
    digits = [c for c in own if c in "0123456789"]
    groups = re.findall(r"[0-9]+", own)
    letters = sum(c.isalpha() for c in own)
    n = len(own)
    return [
        float("@" in own), float(n), float(len(digits)), len(digits) / n, float(letters), float(len(groups)),
        float(max(map(len, groups), default=0)), float(min(map(len, groups), default=0)),
        float(own.count(".")), float(own.count("-")), float(own.count(" ")), float(own.startswith("+")),
        float(any(c in "([{" for c in own)), float(len(digits) >= 12 and luhn("".join(digits))),
        float(max((int(g[:6]) for g in groups), default=0)), float(len(set(digits))),
        float(before[-1:].isspace() or not before), float(after[:1].isspace() or not after),
        float(before[-1:].isalnum()), float(after[:1].isalnum()), *[float(kind == k) for k in range(len(BASE), len(KINDS))],
        *[float(bool(p.search(before))) for p in (*ANNOUNCED, *OTHER)],
    ]


class Ranges:
    """Spans by start, with the furthest end so far: questions about all of them take one search."""

    def __init__(self, spans):
        self.starts, self.ends, furthest = [], [], 0
        for a, b in sorted(spans):
            furthest = max(furthest, b)
            self.starts.append(a)
            self.ends.append(furthest)

    def cover(self, a: int, b: int) -> bool:
        """Whether one of them holds all of a to b."""
        i = bisect_right(self.starts, a)
        return i > 0 and self.ends[i - 1] >= b

    def meet(self, a: int, b: int) -> bool:
        """Whether one of them overlaps a to b."""
        i = bisect_left(self.starts, b)
        return i > 0 and self.ends[i - 1] > a


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


SCANNED = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, "
           "proposed array<struct<kind:int,start:int,end:int,label:int,taught:boolean,free:boolean,features:array<double>>>")


def scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document: base spans, and proposals with features.

    A proposal teaches if it is of a base kind or implausible, but not one that
    fails its check where a plausible wider one covers it.  The wider forms of
    base spans teach, too.  A proposal is free if it is of a wider
    kind, plausible, and overlaps no base span.
    """
    proposed = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("label", pa.int32()),
                                   ("taught", pa.bool_()), ("free", pa.bool_()), ("features", pa.list_(pa.float64()))]))
    schema = pa.schema([("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in BASE], ("base_sha256", pa.string()),
                        ("base", pa.string()), ("proposed", proposed)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = text or ""
                found = proposals(text)
                base = [(k, a, b) for k, a, b, ok in found if ok]
                joined, n = spans_text(base), Counter(k for k, _, _ in base)
                ranges = Ranges((a, b) for _, a, b in base)
                rows = []
                covers = Ranges((a, b) for k, a, b, _ in found if k >= len(BASE) and plausible(k, text[a:b]))
                for k, a, b, ok in found:
                    wide = k >= len(BASE)
                    if wide:
                        teaches = not plausible(k, text[a:b])
                    else:
                        teaches = b - a > 6 and (ok or not covers.cover(a, b))
                    free = wide and not teaches and not ranges.meet(a, b)
                    if free or teaches:
                        rows.append({"kind": k, "start": a, "end": b, "label": int(ok), "taught": teaches, "free": free,
                                     "features": features_of(text, k, a, b)})
                    if ok and teaches:
                        before, after = text[max(0, a - CONTEXT):a], text[b:b + 8]
                        taught = {"start": a, "end": b, "taught": True, "free": False}
                        for w, form, alone in wider_forms(k, text[a:b]):
                            around = ("", "") if alone else (before, after)
                            rows.append({"kind": w, "label": 1, "features": described(w, form, *around), **taught})
                            if KINDS[w] != "email_words":
                                other = ELSEWHERE[zlib.crc32(form.encode()) % len(ELSEWHERE)]
                                rows.append({"kind": w, "label": 0, "features": described(w, form, other, after), **taught})
                out.append({"doc_id": doc_id, **{f"n_{k}": n[i] for i, k in enumerate(BASE)},
                            "base_sha256": hashlib.sha256(joined.encode()).hexdigest(), "base": joined, "proposed": rows})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCANNED)


def threshold_of(model: Boosted, rows: DataFrame, precision: float) -> float | None:
    """Lowest score (to 1/1000) from which the share of label 1 is at least ``precision``; None if there is none."""
    counts = model.score(rows).groupBy(F.floor(F.col("score") * 1000).alias("g")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("good")).collect()
    best, n, good = None, 0, 0
    for r in sorted(counts, key=lambda r: -r["g"]):
        n, good = n + r["n"], good + r["good"]
        if good >= precision * n:
            best = r["g"] / 1000
    return best


def chosen(spans: list) -> list[tuple[int, int, int]]:
    """Of overlapping added spans the best: highest score, then longest, then first."""
    out: list[tuple[int, int, int]] = []  # by start; they don't overlap
    for _, _, a, b, k in sorted((-s["score"], s["start"] - s["end"], s["start"], s["end"], s["kind"]) for s in spans):
        i = bisect_left(out, a, key=lambda o: o[1])
        if (i == 0 or out[i - 1][2] <= a) and (i == len(out) or b <= out[i][1]):
            out.insert(i, (k, a, b))
    return out


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", precision: float = PRECISION) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added per document."""
    scanned = materialized(scan(docs, id_col, text_col).withColumn("row_no", F.monotonically_increasing_id()), "pii-scan")
    single = scanned.where(F.size("proposed") > 0).select("row_no", "doc_id", F.explode("proposed").alias("p")).select(
        "row_no", "doc_id", "p.*")
    fold = F.pmod(F.xxhash64(F.lit("pii"), "doc_id"), F.lit(4))
    taught = materialized(single.where("taught").select("kind", "label", "features", fold.alias("fold")), "pii-taught")
    model = Boosted(taught.where("fold <> 3"), taught.where("fold = 3"), rounds=12)
    held = taught.where((F.col("fold") == 3) & (F.col("kind") >= len(BASE)))
    least = threshold_of(model, held, precision) if model.trees is not None else None
    out = scanned.drop("proposed")
    if least is None:
        return out.select(*[c for c in out.columns if c not in ("row_no", "base")], F.col("base").alias("spans"),
                          F.lit(0).cast("long").alias("n_added"))
    good = model.score(single.where("free")).where(F.col("score") >= least)
    added = good.groupBy("row_no").agg(F.collect_list(F.struct("score", "start", "end", "kind")).alias("more"))
    joined = out.join(added, "row_no", "left").drop("row_no")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = list(KINDS)
        for batch in batches:
            cols = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            spans, count = [], []
            for base, more in zip(cols["base"].to_pylist(), cols["more"].to_pylist(), strict=True):
                extra = chosen(more or [])
                own = [(names.index(k), int(a), int(b)) for k, a, b in (s.split(":") for s in base.split(",") if s)]
                spans.append(spans_text(own + extra) if extra else base)
                count.append(len(extra))
            keep = [n for n in cols if n not in ("base", "more")]
            yield pa.RecordBatch.from_arrays([*[cols[n] for n in keep], pa.array(spans, pa.string()),
                                              pa.array(count, pa.int64())], [*keep, "spans", "n_added"])

    return joined.mapInArrow(merge, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                                    "base_sha256 string, spans string, n_added long")
