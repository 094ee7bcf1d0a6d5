"""Token ids of whole texts by the tokenizers library, with ids of repeated words remembered.

Neither vocabulary joins text across the end of a run of non-blank characters, nor across the border
between a Latin letter and a mark, so a text's ids are those of its pieces between such ends and
borders. Pieces are cut by numpy from the bytes of many texts at once, dictionary-encoded by Arrow,
and each distinct piece is looked up once; the ids of all pieces are taken from those of the distinct
ones. The library encodes each new piece once per worker. A new word of Latin letters is one word to
a byte-level vocabulary too, so it goes straight to the library's model, past the steps that would
find the words; for other vocabularies such words are encoded as one text and told apart by the
tokens that end or begin a word.

Texts with blanks beyond ASCII are cut by a pattern instead; texts with a special token's string go
to the library whole.
"""

from __future__ import annotations

import os
import re

import numpy as np
import public_tokenizers
import pyarrow as pa

#: Default vocabulary files; every operator takes the path as a parameter.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
#: Ends each document.
END_ID = 2
#: Pieces a worker remembers, and the length beyond which it doesn't.
REMEMBERED = 1_000_000
REMEMBERED_LENGTH = 64
#: Words that are encoded as one text.
TOGETHER = 2000
#: Characters of text that are cut at a time.
SLICE = 2_000_000

# Fixed: blank characters as the library has them; Python also counts 0x1c-0x1f. Latin letters are
# those that no normalisation takes apart.
_BLANK = r"[^\S\x1c-\x1f]"
_SOLID = r"[\S\x1c-\x1f]"
_LATIN = "[A-Za-zÀ-ÖØ-öø-ÿ]"
_MARK = r"[!-/:-@\[-`{-~]"
_MARK_BUT_APOSTROPHE = r"[!-&(-/:-@\[-`{-~]"
#: What ends where a Latin word meets a mark or a blank, else all up to the next blank. An
#: apostrophe stays with what follows it, as in contractions.
_PARTS = [
    f"{_LATIN}+(?!(?!{_MARK}){_SOLID})",
    f"{_MARK}*{_MARK_BUT_APOSTROPHE}(?={_LATIN})",
    f"{_MARK}+(?!{_SOLID})",
    f"{_SOLID}+",
]
#: By the kind of vocabulary: one that keeps blanks, one that drops them.
_PIECES = {
    True: re.compile("|".join([*(f" ?{p}" for p in _PARTS), f"{_BLANK}+(?!{_SOLID})|{_BLANK}+"])),
    False: re.compile("|".join(_PARTS)),
}
#: Words of one token run each.
_LATIN_BYTES = rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+"
_PLAIN = {True: re.compile(b" " + _LATIN_BYTES).fullmatch, False: re.compile(_LATIN_BYTES).fullmatch}
#: Words that a byte-level vocabulary's model may get, and the characters in them.
_WORD = re.compile(b" ?" + _LATIN_BYTES).fullmatch
_WORD_CHARACTERS = re.findall(f" |{_LATIN}", "".join(map(chr, range(256))))
#: A blank that is none of ASCII's.
_ODD = re.compile(r"[^\S\t-\r\x1c-\x20]").search
#: Where a text may be cut whatever follows.
_EDGE = re.compile(r"(?<=[^\t-\r ])[\t-\r ]").search

# Classes of bytes; bytes beyond ASCII, digits and controls are 0.
_SPACE, _OTHER_BLANK, _LETTER, _APOSTROPHE, _OTHER_MARK = 1, 2, 3, 4, 5
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[0x09:0x0E] = _OTHER_BLANK
_CLASS[0x20] = _SPACE
for _from, _to in ((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E)):
    _CLASS[_from : _to + 1] = _OTHER_MARK
_CLASS[0x27] = _APOSTROPHE
for _from, _to in ((0x41, 0x5A), (0x61, 0x7A)):
    _CLASS[_from : _to + 1] = _LETTER
# Latin letters beyond ASCII are the first of these bytes and another, but for two signs.
_LATIN_LEAD, _TIMES, _DIVIDED = 0xC3, 0x97, 0xB7


def _lower(text: str) -> str:
    """In lower case where Python and the library agree on it."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text.lower()


def _starts(data: np.ndarray, begin: np.ndarray, blanks: bool) -> np.ndarray:
    """Where pieces begin, as flags; `begin` is where texts do, each of them one byte at least."""
    kind = _CLASS[data]
    blank = (kind == _SPACE) | (kind == _OTHER_BLANK)
    mark = kind >= _APOSTROPHE
    starts = np.zeros(len(data), dtype=bool)
    before = slice(None, -1)
    # Where a letter begins and where it ends.
    first = kind == _LETTER
    last = first.copy()
    beyond = (data[before] == _LATIN_LEAD) & (data[1:] != _TIMES) & (data[1:] != _DIVIDED)
    first[before] |= beyond
    last[1:] |= beyond
    starts[1:] = ~blank[before] & blank[1:]
    starts[1:] |= last[before] & mark[1:]
    starts[1:] |= (kind[before] == _OTHER_MARK) & first[1:]
    if blanks:
        # A space belongs to what follows it; any other blank does not. Either way the last of some
        # blanks is apart from those before it, unless the text ends there.
        starts[1:] |= (kind[before] == _OTHER_BLANK) & ~blank[1:]
        follows = ~blank
        follows[begin] = False
        starts[1:-1] |= blank[:-2] & blank[1:-1] & follows[2:]
    else:
        starts[1:] |= blank[before] & ~blank[1:]
    starts[begin] = True
    return starts


class Encoder:
    """Encodes texts to arrays of ids without adding special tokens.

    A special token's string in a text is that token, as the library has it; with
    `special_as_text` it is ordinary text.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        special = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [] if special_as_text else [t.content for t in special]
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.blanks = bool(self.tokenizer.encode(" ", add_special_tokens=False).ids)
        # Tokens at which a word begins (with its blank) or ends.
        self.turns = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.turns[i] = token.startswith("Ġ") if self.blanks else token.endswith("</w>")
        # The model of a byte-level vocabulary, and the characters that stand for a word's bytes.
        self.model, by_bytes = None, self.tokenizer.pre_tokenizer
        if (
            isinstance(by_bytes, pre_tokenizers.ByteLevel)
            and self.tokenizer.normalizer is None
            and by_bytes.use_regex
            and not by_bytes.add_prefix_space
        ):
            self.model = self.tokenizer.model
            self.as_bytes = {ord(c): by_bytes.pre_tokenize_str(c)[0][0] for c in _WORD_CHARACTERS}
        # Two generations: when the younger is full, what the older alone has is forgotten.
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(f.ids, dtype=self.kind) for f in found]

    def _together(self, words: list[bytes]) -> list[bytes] | None:
        """Ids of plain words from one encoding, if it can be taken apart."""
        (ids,) = self._ids([(b"" if self.blanks else b" ").join(words).decode()])
        turn = np.flatnonzero(self.turns[ids])
        if len(turn) != len(words):
            return None
        cuts = turn if self.blanks else turn + 1
        ends = [*cuts[1:].tolist(), len(ids)] if self.blanks else cuts.tolist()
        raw, size = ids.tobytes(), self.kind.itemsize
        return [raw[a * size : b * size] for a, b in zip([0, *ends], ends)]

    def _words(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of Latin letters by the model of a byte-level vocabulary."""
        ids, ends, tokenize = [], [0], self.model.tokenize
        for word in b"\n".join(words).decode().translate(self.as_bytes).split("\n"):
            ids += [token.id for token in tokenize(word)]
            ends.append(len(ids))
        raw, size = np.array(ids, dtype=self.kind).tobytes(), self.kind.itemsize
        return [raw[a * size : b * size] for a, b in zip(ends, ends[1:])]

    def _learn(self, new: list[bytes]) -> None:
        is_plain = _WORD if self.model else _PLAIN[self.blanks]
        plain = [piece for piece in new if is_plain(piece)]
        other = [piece for piece in new if not is_plain(piece)] if len(plain) < len(new) else []
        for at in range(0, len(plain), TOGETHER):
            some = plain[at : at + TOGETHER]
            found = self._words(some) if self.model else self._together(some)
            if found is None:
                other += some
            else:
                self.known.update(zip(some, found))
        for piece, ids in zip(other, self._ids([piece.decode() for piece in other])):
            self.known[piece] = ids.tobytes()

    def _look_up(self, pieces: list[bytes]) -> list[bytes]:
        if len(self.known) + len(pieces) > REMEMBERED // 2:
            self.known, self.older = {}, self.known
        found = list(map(self.known.get, pieces))
        missing = [k for k, ids in enumerate(found) if ids is None]
        new = []
        for k in missing:
            ids = self.older.get(pieces[k])
            if ids is None:
                new.append(pieces[k])
            else:
                self.known[pieces[k]] = ids
        self._learn(new)
        for k in missing:
            found[k] = self.known[pieces[k]]
        for piece in new:
            if len(piece) > REMEMBERED_LENGTH:
                del self.known[piece]
        return found

    def _cut(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """The pieces of texts without odd blanks, and the number of pieces before each text."""
        raw = [(t if self.blanks else _lower(t)).encode() for t in texts]
        data = b"".join(raw)
        begin = np.cumsum([0, *map(len, raw)])
        own = begin[begin < len(data)]
        starts = np.flatnonzero(_starts(np.frombuffer(data, dtype=np.uint8), own, self.blanks))
        offsets = np.append(starts, len(data)).astype(np.int32)
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data)]
        return pa.Array.from_buffers(pa.binary(), len(starts), buffers), np.searchsorted(starts, begin)

    def _encode(self, texts: list[str], odd: bool) -> list[np.ndarray]:
        """Ids of texts that are cut alike."""
        if not any(texts):
            return [np.zeros(0, dtype=self.kind) for _ in texts]
        if odd:
            cut = [_PIECES[self.blanks].findall(t if self.blanks else _lower(t)) for t in texts]
            begin = np.cumsum([0, *map(len, cut)])
            pieces = pa.array([p.encode() for own in cut for p in own], pa.binary())
        else:
            pieces, begin = self._cut(texts)
        coded = pieces.dictionary_encode()
        known = self._look_up(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        _, end, flat = pa.array(known, pa.binary()).take(coded.indices).buffers()
        end = np.frombuffer(end, dtype=np.int32)[begin] // self.kind.itemsize
        ids = np.frombuffer(flat, dtype=self.kind)
        return [ids[a:b] for a, b in zip(end[:-1].tolist(), end[1:].tolist())]

    def _slices(self, text: str) -> list[str]:
        cuts = [0]
        while len(text) - cuts[-1] > SLICE:
            edge = _EDGE(text, cuts[-1] + SLICE)
            if edge is None or _ODD(text):
                break
            cuts.append(edge.start())
        return [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)])]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; long ones are cut in slices, so that memory follows SLICE."""
        found: list[list[np.ndarray]] = [[] for _ in texts]
        some: list[tuple[int, str]] = []
        size = 0

        def close():
            odd = _ODD("".join(t for _, t in some)) is not None
            groups = [[x for x in some if bool(_ODD(x[1])) == o] for o in (False, True)] if odd else [some]
            for own, is_odd in zip(groups, (False, True)):
                for (k, _), ids in zip(own, self._encode([t for _, t in own], is_odd)):
                    found[k].append(ids)
            some.clear()

        for k, text in enumerate(texts):
            if any(token in text for token in self.special):
                found[k].append(self._ids([text])[0])
                continue
            for part in self._slices(text):
                some.append((k, part))
                size += len(part)
                if size >= SLICE:
                    close()
                    size = 0
        close()
        empty = np.zeros(0, dtype=self.kind)
        return [parts[0] if len(parts) == 1 else np.concatenate([empty, *parts]) for parts in found]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder for a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def with_end(ids: np.ndarray) -> np.ndarray:
    return np.append(ids, np.array([END_ID], dtype=ids.dtype))


def groups_of(texts: list, characters: int = SLICE):
    """Ranges of a list of texts of about so many characters, one text at least."""
    start, total = 0, 0
    for i, text in enumerate(texts):
        total += len(text)
        if total >= characters:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
