"""Token ids of whole texts from public tokenizer files, each distinct chunk of text encoded once a worker.

A chunk ends where the tokenizer's own rules end a token for certain, so the
ids of a text are those of its chunks one after the other:

* word tokenizers that drop white space: a run without white space;
* byte-level and piece tokenizers, for texts that begin with a space: a space
  and what stands behind it, up to the next space that follows no white
  space.  Their split pattern takes white space only in front of a token, and
  no piece has a space behind another character.

Words and chunks of the word tokenizer that were met are kept, up to a bound in
number; it bounds memory and has no effect on the ids.  A Python worker keeps
its encoders from task to task.
"""

from __future__ import annotations

import os
import re
import sys
import types
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: What the split patterns call white space (Unicode's White_Space).
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: SentencePiece's sign for a space.
PIECE_SPACE = "\u2581"
#: A space behind a character that no tokenizer takes for one: all of them end a token in front of it.
CUT = re.compile(f"(?<=[^{SPACES}{PIECE_SPACE}]) ")
#: Longer texts are handled in pieces of about so many characters.
PIECE_CHARS = 1 << 21
#: Python's ``split`` takes these for white space as well.
SEPARATORS = "\x1c\x1d\x1e\x1f"
WORD = re.compile(f"[^{SPACES}]+")


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """``text`` in pieces of ``size`` characters or somewhat more, each but the first beginning at a cut; none for ''."""
    start = 0
    while start < len(text):
        found = CUT.search(text, start + size) if start + size < len(text) else None
        end = found.start() if found else len(text)
        yield text[start:end]
        start = end


#: Texts of these alone (ASCII and Latin-1 letters) are the same under NFC and get lower case letter by letter.
SIMPLE = re.compile("[\x00-\x7f\xc0-\xd6\xd8-\xf6\xf8-\xff]*")
#: The split of the word tokenizer, as its file has it, for such texts in lower case.
SIMPLE_WORD = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^\t-\r a-z\xdf-\xf6\xf8-\xff0-9]+")

#: What each byte of an ASCII or Latin-1 text in UTF-8 is in terms of that split; 0: never part of one.
LETTER, DIGIT, SIGN = 1, 2, 3
BYTE_KIND = np.zeros(256, np.uint8)
BYTE_KIND[:128] = SIGN
BYTE_KIND[[0xC3, *range(0x80, 0xC0), *range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1)]] = LETTER
BYTE_KIND[ord("0"):ord("9") + 1] = DIGIT


def word_chunks(text: str) -> list[str]:
    """The runs of a text without white space, in lower case where that can't differ from the tokenizer's own."""
    if any(c in text for c in SEPARATORS):
        return WORD.findall(text)
    return text.lower().split() if text.isascii() and "<|" not in text else text.split()


#: Where an ASCII text has none of these, each of its spaces is a cut.
NO_CUTS = [f"{c} " for c in "\t\n\v\f\r "]


def spaced_chunks(text: str) -> list[str]:
    """The chunks of a text that begins with a space, each without its first space."""
    if text.isascii() and not any(s in text for s in NO_CUTS):
        return text[1:].split(" ")
    return CUT.split(text[1:])


#: A control character that is one token of its own in all the tokenizers here; it stands between chunks.
MARK = "\x01"


def by_mark(chunks: list[str], encode: Callable[[list[str]], list[list[int]]], single: Callable[[str], list[int]],
            before: str, after: str, mark_id: int, group: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """(the ids of all chunks one after the other, the number of each): far cheaper than a call for each.

    Groups are encoded with a mark between, ``before`` and ``after`` on both sides of it.  Chunks that hold the mark, end in
    white space (which would be cut in another way before a mark) or are empty are encoded alone.
    """
    alone = [i for i, c in enumerate(chunks) if not c or c[-1].isspace() or MARK in c]
    apart = set(alone)
    plain = [c for i, c in enumerate(chunks) if i not in apart] if alone else chunks
    joined = [after + f"{before}{MARK}{after}".join(plain[i:i + group]) for i in range(0, len(plain), group)]
    flat = []
    for found in encode(joined) if joined else ():
        flat += [np.array(found, "<u4"), np.array([mark_id], "<u4")]
    ids = np.concatenate(flat) if flat else np.zeros(0, "<u4")
    marks = np.flatnonzero(ids == mark_id)
    sizes, ids = np.diff(marks, prepend=-1) - 1, ids[ids != mark_id]
    if not alone:
        return ids, sizes
    own = [single(chunks[i]) for i in alone]
    both = Ragged.of(np.concatenate([ids, *(np.array(x, "<u4") for x in own)]), np.r_[sizes, np.array([len(x) for x in own], np.int64)])
    order = np.empty(len(chunks), np.int64)
    order[np.delete(np.arange(len(chunks)), alone)] = np.arange(len(sizes))
    order[alone] = np.arange(len(sizes), len(chunks))
    return both.taken(order)[0], both.sizes[order]


def packed(ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    raw, ends = ids.tobytes(), (np.cumsum(sizes) * 4).tolist()
    return [raw[i:j] for i, j in zip([0, *ends], ends, strict=False)]


class SpelledEncoder:
    """``encode`` gives the ids of a list of chunks as ``by_mark`` does, ``spelled`` has the bytes of each id."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], spelled: list[bytes]):
        self.encode, self.spelled = encode, spelled
        self.bytes = Ragged.of(np.frombuffer(b"".join(spelled), np.uint8), np.array([len(x) for x in spelled], np.int64))

    def each(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all chunks one after the other, the number of each, whether they spell a space and the chunk)."""
        ids, sizes = self.encode(chunks)
        whole = " " + " ".join(chunks)
        lengths = map(len, chunks) if whole.isascii() else (len(c.encode("utf-8", "surrogatepass")) for c in chunks)
        want = Ragged.of(np.frombuffer(whole.encode("utf-8", "surrogatepass"), np.uint8), np.fromiter(lengths, np.int64, len(chunks)) + 1)
        found, upto = self.bytes.taken(ids)
        ends = upto[np.cumsum(sizes)]
        got = Ragged.of(found, np.diff(ends, prepend=0))
        plain = got.sizes == want.sizes
        same = np.flatnonzero(plain)
        differ = np.flatnonzero(got.taken(same)[0] != want.taken(same)[0])
        plain[same[np.searchsorted(np.cumsum(want.sizes[same]), differ, "right")]] = False
        return ids, sizes, plain


class ChunkEncoder:
    """``encode`` gives the packed ids of each of a list of distinct chunks."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], most: int = 800_000, longest: int = 64):
        self.encode, self.most, self.longest = encode, most, longest
        self.known: dict[str, bytes] = {}

    def of(self, texts: list[list[str]]) -> tuple[list[bytes]]:
        """The packed ids of each text, given as its chunks."""
        flat = list(chain.from_iterable(texts))
        parts = list(map(self.known.get, flat))
        missing = [i for i, ids in enumerate(parts) if ids is None]
        new = list({flat[i] for i in missing})
        if new:
            if len(self.known) + len(new) > self.most:
                self.known, missing = {}, range(len(flat))
                new = list(set(flat))
            self.known.update(zip(new, self.encode(new), strict=True))
            for i in missing:
                parts[i] = self.known[flat[i]]
        out, at = [], 0
        for chunks in texts:
            out.append(b"".join(parts[at:at + len(chunks)]))
            at += len(chunks)
        for c in new:
            if len(c) > self.longest:
                del self.known[c]
        return (out,)


def per_worker(key: str, build: Callable):
    """``build()``, made once in a Python worker: functions that travel with tasks lose their module's state."""
    kept = sys.modules.setdefault("leadlens_per_worker", types.ModuleType("leadlens_per_worker")).__dict__
    if key not in kept:
        kept[key] = build()
    return kept[key]


def json_tokenizer(path: str, plain_specials: bool = False):
    """A tokenizer of the tokenizers library; ``plain_specials`` takes special strings inside texts as text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.encode_special_tokens = plain_specials
    return found


def encode_json(t) -> Callable[[list[str]], list[list[int]]]:
    return lambda texts: [e.ids for e in t.encode_batch_fast(texts, add_special_tokens=False)]


def word_encoder(path: str, most_words: int = 600_000) -> "WordEncoder":
    """For ``word_chunks``."""
    t = json_tokenizer(path)
    encode = encode_json(t)
    (mark_id,) = encode([f" {MARK} "])[0]
    # Lower-case words of simple signs need neither the normalizer nor the split pattern: the model takes their bytes.
    tokenize, sign_of = t.model.tokenize, np.zeros(256, "<u4")
    for c, value in byte_values().items():
        sign_of[value] = ord(c)
    sign_of[ord("\n")] = ord("\n")  # between words; no word has one

    def by_model(own: list[str]) -> tuple[list[int], list[int]]:
        ids, sizes = [], []
        for w in sign_of[np.frombuffer("\n".join(own).encode(), np.uint8)].tobytes().decode("utf-32-le").split("\n"):
            found = tokenize(w)
            ids += [x.id for x in found]
            sizes.append(len(found))
        return ids, sizes

    words = KnownWords(by_model, most_words)

    def all_chunks(chunks: list[str]) -> list[bytes]:
        # Chunks of simple signs are split as the tokenizer would, so that a word is encoded once, whatever stands behind it.
        split = {c: SIMPLE_WORD.findall(c.lower()) for c in chunks if SIMPLE.fullmatch(c) and "<|" not in c}
        distinct = list(set(chain.from_iterable(split.values())))
        of = dict(zip(distinct, packed(*words.of(distinct)), strict=True))
        out = {c: b"".join([of[w] for w in own]) for c, own in split.items()}
        rest = [c for c in chunks if c not in out]
        out.update(zip(rest, packed(*by_mark(rest, encode, lambda c: encode([c])[0], " ", " ", mark_id)), strict=True))
        return [out[c] for c in chunks]

    return WordEncoder(all_chunks, words, most=most_words)


class Ragged:
    """Arrays of ids one after the other, number ``i`` at ``starts[i]`` with ``sizes[i]`` ids."""

    def __init__(self, packed: list[bytes]):
        self.flat = np.frombuffer(b"".join(packed), "<u4")
        self.sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        self.starts = np.cumsum(self.sizes) - self.sizes

    @classmethod
    def of(cls, flat: np.ndarray, sizes: np.ndarray) -> Ragged:
        out = cls([])
        out.flat, out.sizes, out.starts = flat, sizes, np.cumsum(sizes) - sizes
        return out

    def taken(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the arrays that ``codes`` name one after the other, their number of ids up to each of them, from 0)."""
        n = self.sizes[codes]
        upto = np.zeros(len(n) + 1, np.int64)
        np.cumsum(n, out=upto[1:])
        at = np.repeat(self.starts[codes] - upto[:-1], n)
        at += np.arange(len(at))
        return self.flat[at], upto


class KnownWords:
    """The ids of words, kept up to ``most`` words; ``encode`` gives those of distinct words and the number of each."""

    def __init__(self, encode: Callable[[list[str]], tuple[list[int], list[int]]], most: int, group: int = 1 << 15):
        self.encode, self.most, self.group = encode, most, group
        self.number: dict[str, int] = {}
        self.kept = Ragged([])

    def of(self, wanted: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all ``wanted``, which are distinct, one after the other, the number of each)."""
        new = [w for w in wanted if w not in self.number]
        if len(self.number) + len(new) > self.most:
            # Those that are wanted now stay.
            old = [w for w in wanted if w in self.number]
            codes = np.fromiter(map(self.number.__getitem__, old), np.int64, len(old))
            self.number.clear()
            self.number.update(zip(old, range(len(old)), strict=True))
            self.kept = Ragged.of(self.kept.taken(codes)[0], self.kept.sizes[codes])
        if new:
            ids, sizes = [self.kept.flat], [self.kept.sizes]
            for i in range(0, len(new), self.group):
                for all_of, own, kind in zip((ids, sizes), self.encode(new[i:i + self.group]), ("<u4", np.int64), strict=True):
                    all_of.append(np.array(own, kind))
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new)), strict=True))
            self.kept = Ragged.of(np.concatenate(ids), np.concatenate(sizes))
        codes = np.fromiter(map(self.number.__getitem__, wanted), np.int64, len(wanted))
        return self.kept.taken(codes)[0], self.kept.sizes[codes]


def buffers(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(where each of ``strings``, none null, begins and the last ends, from 0, the bytes of all)."""
    _, offsets, data = strings.buffers()
    at = np.frombuffer(offsets, np.int32, len(strings) + 1, 4 * strings.offset) if len(strings) else np.zeros(1, np.int32)
    return at - at[0], np.frombuffer(data or b"", np.uint8)[at[0]:at[-1]]


def arrow(kind: pa.DataType, at: np.ndarray, data: np.ndarray) -> pa.Array:
    """``buffers`` the other way round."""
    return pa.Array.from_buffers(kind, len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data)])


class WordEncoder(ChunkEncoder):
    """A chunk encoder that also takes whole texts as Arrow has them: Arrow splits them and finds the distinct words."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], words: KnownWords, **kw):
        super().__init__(encode, **kw)
        self.words = words

    def ids_of_words(self, wanted: list[str]) -> list[bytes]:
        """The packed ids of distinct lower-case words of simple signs."""
        return packed(*self.words.of(wanted))

    def joined(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all ``texts``, none null, one after the other; their number up to each text's end)."""
        return next(self.together([texts]))

    def together(self, groups: list[pa.Array]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``joined`` of each of ``groups``; chunks that several of them have are encoded once."""
        coded, ends = [], []
        for texts in groups:
            # Chunks are the runs without ASCII white space; there are empty ones at both ends of a text.
            runs = pc.ascii_split_whitespace(texts)
            coded.append(runs.flatten().dictionary_encode())
            ends.append(runs.offsets.to_numpy()[1:] - runs.offsets[0].as_py())
        coded = pa.chunked_array(coded).unify_dictionaries().chunks
        ids = self.distinct(coded[0].dictionary)
        for own, upto in zip(coded, ends, strict=True):
            at, data = buffers(ids.take(own.indices))
            yield data.view("<u4"), at[upto] // 4

    def distinct(self, chunks: pa.Array) -> pa.Array:
        """The packed ids of each of the distinct ``chunks``."""
        at, data = buffers(chunks)
        # Chunks of other signs, with a special string or with an apostrophe, at which the split has further rules.
        odd = (BYTE_KIND[data] == 0) | (data == ord("'"))
        odd[1:] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7)) | (data[:-1] == ord("<")) & (data[1:] == ord("|"))
        odd = np.diff(np.r_[np.int32(0), np.cumsum(odd, dtype=np.int32)][at]) > 0
        simple, rest = chunks.filter(pa.array(~odd)), chunks.filter(pa.array(odd)).to_pylist()
        at, data = buffers(simple)
        kind = BYTE_KIND[data]
        begins = kind == DIGIT
        begins[1:] |= kind[1:] != kind[:-1]
        begins[at[:-1][np.diff(at) > 0]] = True
        capital = (data >= ord("A")) & (data <= ord("Z"))
        capital[1:] |= (data[:-1] == 0xC3) & (data[1:] < 0x9F)
        words = arrow(pa.string(), np.r_[np.flatnonzero(begins), len(data)], data + 32 * capital.astype(np.uint8)).dictionary_encode()
        # Taken out of Arrow as one string, which is far faster than one by one.
        at_word, spelled = buffers(words.dictionary)
        distinct = np.insert(spelled, at_word[1:-1], ord("\n")).tobytes().decode().split("\n") if len(spelled) else []
        ids, sizes = self.words.of(distinct)
        at_id, ids = buffers(arrow(pa.binary(), np.r_[0, np.cumsum(sizes)] * 4, ids).take(words.indices))
        known = arrow(pa.binary(), at_id[np.r_[np.int32(0), np.cumsum(begins, dtype=np.int32)][at]], ids)
        if not rest:
            return known
        order = np.empty(len(chunks), np.int64)
        order[np.flatnonzero(~odd)] = np.arange(len(known))
        order[np.flatnonzero(odd)] = np.arange(len(known), len(chunks))
        return pa.concat_arrays([known, pa.array(self.of([[c] for c in rest])[0], pa.binary())]).take(pa.array(order))


def byte_values() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable ones stand for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_encoder(path: str) -> SpelledEncoder:
    """For ``spaced_chunks``; special strings inside texts are plain text."""
    t, of = json_tokenizer(path, plain_specials=True), byte_values()
    names = {i: s for s, i in t.get_vocab(with_added_tokens=True).items()}
    sign = {s for s, b in of.items() if b == ord(MARK)}
    if any(sign & set(s) and s not in sign for s in names.values()):
        raise ValueError(f"the mark between chunks is part of other tokens of {path}")
    entries = [names.get(i, "") for i in range(max(names) + 1)]
    spelled = [bytes(of[c] for c in s) if of.keys() >= set(s) else s.encode() for s in entries]
    encode = encode_json(t)
    (mark_id,) = encode([MARK])[0]
    return SpelledEncoder(lambda chunks: by_mark(chunks, encode, lambda c: encode([" " + c])[0], "", " ", mark_id), spelled)


def piece_encoder(path: str) -> SpelledEncoder:
    """For ``spaced_chunks`` and a SentencePiece model that adds a space in front."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    if any(PIECE_SPACE in s.lstrip(PIECE_SPACE) or MARK in s and s != MARK for s in names):
        raise ValueError(f"{path} has pieces that reach over the end of a chunk")
    spelled = [bytes([int(s[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", s)
               else s.replace(PIECE_SPACE, " ").encode() for s in names]
    space, mark_id = sp.piece_to_id(PIECE_SPACE), sp.encode(MARK)[-1]

    def single(c: str) -> list[int]:
        # The model adds the first space itself, but none to no text at all.
        return sp.encode(c, num_threads=1) if c else [space]

    def encode(texts: list[str]) -> list[list[int]]:
        return sp.encode([t[1:] for t in texts], num_threads=1)

    return SpelledEncoder(lambda chunks: by_mark(chunks, encode, single, "", " ", mark_id), spelled)
