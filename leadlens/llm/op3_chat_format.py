r"""Chat formatting by incremental black-box rendering.

A template is any function from a list of turns (role, text) to one string;
nothing else is known about it.  The prefixes of a conversation are rendered
one after the other.  Where the next output begins with the previous one, the
turn's span is what has been added; where it does not, the template has
rewritten history, and the turn is counted in ``n_rewritten``.  The turn's
text is then looked up in its span, which gives the loss mask.

Rendering every prefix costs the square of the number of turns.  It is done
at all sizes unless the caller declares the template prefix-stable (a longer
prefix's rendering always begins with a shorter one's), as ``chat_markup`` is
by its form.  For a declared template each step beyond ``WHOLE_PREFIXES`` turns
renders the last ``CONTEXT`` turns with and without the new one, and the joined
spans are compared with one rendering of the whole conversation; if they
differ, all prefixes are rendered.

The template ``chat_markup`` marks turns with ``<|im_start|>`` and
``<|im_end|>``.  Inside a text each ``<``, any backslashes, ``|`` gets one
backslash more, so that no text holds a mark and the step can be undone.

Rows are ordered by turn, then role, then text; nulls come first and read as
empty.  Repeated rows are turns of their own.  A null conversation id is one
conversation.  An empty table gives the added conversation only, extra
columns are ignored.  A conversation is one output string, so it has to fit
into one row; rows reach their task sorted, and one conversation is held at a
time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

START, END = "<|im_start|>", "<|im_end|>"
WHOLE_PREFIXES = 64
CONTEXT = 8
ROWS_OUT = 500

FORMATTED = ("conv_id long, formatted string, spans array<struct<role:string,start:int,end:int,"
             "text_start:int,text_end:int>>, n_rewritten int")


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def chat_markup(turns: list[Turn]) -> str:
    return "".join(f"{START}{escape_role(role)}\n{escape(text)}{END}\n" for role, text in turns)


def common_prefix(a: str, b: str) -> int:
    """Length of the longest common prefix, by halving."""
    if b.startswith(a):
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid - 1)
    return low


def every_prefix(template: Template, turns: list[Turn]) -> tuple[str, list[tuple[int, int]], int]:
    """(output, span of each turn, turns whose rendering changed what came before)."""
    out, spans, rewritten = template([]), [], 0
    for k in range(1, len(turns) + 1):
        now = template(turns[:k])
        at = common_prefix(out, now)
        rewritten += at < len(out)
        spans.append((at, len(now)))
        out = now
    return out, spans, rewritten


def last_prefixes(template: Template, turns: list[Turn]) -> tuple[str, list[tuple[int, int]], int] | None:
    """The same from the last turns only; None if that isn't what the template gives."""
    whole, at, spans = template(turns), 0, []
    out = template([])
    if not whole.startswith(out):
        return None
    at = len(out)
    for k in range(1, len(turns) + 1):
        before, now = template(turns[max(0, k - 1 - CONTEXT):k - 1]), template(turns[max(0, k - 1 - CONTEXT):k])
        if not now.startswith(before) or not whole.startswith(now[len(before):], at):
            return None
        spans.append((at, at := at + len(now) - len(before)))
    return (whole, spans, 0) if at == len(whole) else None


def render(template: Template, turns: list[Turn], inside: Callable[[str], str], stable: bool = False):
    """(formatted, rows of spans, n_rewritten); ``inside`` is how the template writes a text."""
    found = last_prefixes(template, turns) if stable and len(turns) > WHOLE_PREFIXES else None
    out, spans, rewritten = found or every_prefix(template, turns)
    rows = []
    for (role, text), (start, end) in zip(turns, spans, strict=True):
        shown = inside(text)
        # From the right: a role may hold the same string as the text.
        at = out.rfind(shown, start, end - len(END) - 1 if out.startswith(END, end - len(END) - 1) else end)
        rows.append({"role": role, "start": start, "end": end, "text_start": at,
                     "text_end": at + len(shown) if at >= 0 else -1})
    return out, rows, rewritten


def format_conversations(turns: DataFrame, template: Template = chat_markup,
                         inside: Callable[[str], str] = escape, stable: bool | None = None) -> DataFrame:
    """(conv_id, formatted, spans, n_rewritten), one row per conversation.

    ``stable`` declares the template prefix-stable; None: only ``chat_markup`` is.
    """
    stable = template is chat_markup if stable is None else stable
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("spans", pa.list_(pa.struct([
            ("role", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("text_start", pa.int32()),
            ("text_end", pa.int32())]))), ("n_rewritten", pa.int32())])
        done: list[dict] = []
        conv, held, any_held = None, [], False

        def close():
            out, spans, rewritten = render(template, held, inside, stable)
            done.append({"conv_id": conv, "formatted": out, "spans": spans, "n_rewritten": rewritten})

        for batch in batches:
            cols = batch.to_pydict()
            for c, role, text in zip(cols["conv_id"], cols["role"], cols["text"], strict=True):
                if any_held and c != conv:
                    close()
                    held = []
                    if len(done) >= ROWS_OUT:
                        yield pa.RecordBatch.from_pylist(done, schema=schema)
                        done = []
                conv, any_held = c, True
                held.append((role, text))
        if any_held:
            close()
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=schema)

    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, FORMATTED)


def parse_markup(formatted: str) -> list[Turn]:
    """The turns that ``chat_markup`` has written."""
    found = re.findall(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", formatted, re.S)
    return [(unescape_role(role), unescape(text)) for role, text in found]


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what stands in the formatted text and under its loss mask (assistant texts)."""
    schema = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
              "formatted_chars long, n_rewritten long")

    def run(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                turns = parse_markup(r["formatted"])
                whole, loss, chars = hashlib.sha256(), hashlib.sha256(), 0
                for role, text in turns:
                    whole.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                for s in r["spans"]:
                    if s["role"] == "assistant":
                        own = unescape(r["formatted"][s["text_start"]:s["text_end"]])
                        chars += len(own)
                        loss.update(own.encode("utf-8", "surrogatepass"))
                rows.append({"conv_id": r["conv_id"], "n_turns": len(turns), "turns_sha256": whole.hexdigest(),
                             "loss_chars": chars, "loss_sha256": loss.hexdigest(),
                             "formatted_chars": len(r["formatted"]), "n_rewritten": r["n_rewritten"]})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
                ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                ("n_rewritten", pa.int64())]))

    return formatted.mapInArrow(run, schema)
