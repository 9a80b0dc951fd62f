"""Token ids of whole texts by the ``tokenizers`` library, each distinct piece of text once.

The library's pre-tokenizers never join text across white space, nor a run of Latin letters
with the punctuation next to it, so a text's ids are its pieces' ids in a row. The texts of a batch
are laid end to end as bytes and cut at once; pieces are named by 64-bit hashes, each different one is
looked up once a batch, and the ids are gathered by their places. A Python worker keeps the ids of the
pieces it has met (at most ``CACHE`` of them) from task to task. A text that holds one of the tokenizer's
added tokens, or white space in a form that the cut does not take, goes to the library as a whole.
"""

from __future__ import annotations

import os
import re

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from footfall.llm.textops import spans_hashed

CACHE, CACHE_IDS = 1_000_000, 16_000_000
LONGEST = 64
# The names of the tokenizers whose white space is dropped, and of those that keep it.
CUTS = {"word_bpe_49k.json": True, "byte_bpe_50k.json": False}
#: Classes of bytes: white space, letters, marks but the apostrophe, all else. The letters of Latin-1 are two bytes, the first 0xC3.
WHITE, LETTER, MARK, OTHER = range(4)
CLASS = np.full(256, OTHER, np.uint8)
CLASS[list(b"\t\n\x0b\x0c\r ")] = WHITE
CLASS[[b for b in range(128) if chr(b).isalpha()]] = LETTER
CLASS[[b for b in range(33, 127) if not chr(b).isalnum() and b != 39]] = MARK
_wide_space = re.compile(r"[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]").search
_word = re.compile(" ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+").fullmatch
#: Byte-level models spell a byte by the character of its own number where that prints, and by those from 256 on in turn otherwise.
PRINTED = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
SPELLED = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in set(PRINTED))}
BLANK = chr(SPELLED[32])

_encoders: dict[str, TextEncoder] = {}


class TextEncoder:
    """Ids of texts as little-endian unsigned 16-bit values (the vocabularies are smaller than 65,536)."""

    def __init__(self, name: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError(f"{name} has ids of more than 16 bits")
        self.drops_space = CUTS[name]
        #: The model alone, for single words spelled as the library would spell them.
        self.model = Tokenizer(self.tokenizer.model)
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(added)).search if added else lambda text: None
        self._forget()

    def _forget(self) -> None:
        #: Hashes of the pieces that are known, sorted, and each one's place in ``at`` and ``size``: a dict would take seven times as much.
        self.known, self.places = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.ids, self.at, self.size = np.zeros(1 << 20, np.uint16), np.zeros(1 << 18, np.int64), np.zeros(1 << 18, np.int64)
        self.pieces = self.filled = 0

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def _learn(self, pieces: list[str]) -> np.ndarray:
        """The places of pieces that are not known yet."""
        out = np.zeros(len(pieces), np.int64)
        single = [bool(_word(p)) for p in pieces]
        words = [i for i, s in enumerate(single) if s]
        rest = [i for i, s in enumerate(single) if not s]
        spelled = [pieces[i].lower() if self.drops_space else pieces[i] for i in words]
        spelled = [w.replace(" ", BLANK, 1) if w.isascii() else w.encode().decode("latin-1").translate(SPELLED) for w in spelled]
        for tokenizer, places, texts in ((self.model, words, spelled), (self.tokenizer, rest, [pieces[i] for i in rest])):
            found = tokenizer.encode(texts, is_pretokenized=True, add_special_tokens=False)
            ids, n = np.array(found.ids, np.uint16), np.bincount(np.array(found.word_ids, np.int64), minlength=len(places))
            first, last = self.pieces, self.pieces + len(places)
            while last > len(self.at):
                self.at, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.at, self.size))
            while self.filled + len(ids) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            self.size[first:last] = n
            self.at[first:last] = self.filled + np.cumsum(n) - n
            self.ids[self.filled : self.filled + len(ids)] = ids
            out[places] = np.arange(first, last)
            self.pieces, self.filled = last, self.filled + len(ids)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        odd = [bool(self.special(t)) or not (self.drops_space or t.isascii() or not _wide_space(t)) for t in texts]
        raw = [b"" if o else t.encode() for o, t in zip(odd, texts)]
        data, begin, irregular = laid_out(raw, self.drops_space)
        starts, ends = cut(data, begin, self.drops_space)
        hashes = spans_hashed(data, starts, ends)
        names, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) + len(names) > CACHE or self.filled > CACHE_IDS:
            self._forget()
        at = np.searchsorted(self.known, names)
        places, here = np.zeros(len(names), np.int64), np.flatnonzero(at < len(self.known))
        here = here[self.known[at[here]] == names[here]]
        places[here] = self.places[at[here]]
        new = np.setdiff1d(np.arange(len(names)), here, assume_unique=True)
        if len(new):
            whole = data.tobytes()
            where = first[new]
            pieces = [whole[a:b].decode() for a, b in zip(starts[where].tolist(), ends[where].tolist())]
            places[new] = self._learn(pieces)
            kept = new[np.fromiter(map(len, pieces), np.int64, len(pieces)) <= LONGEST]  # long pieces rarely come again
            self.known, self.places = np.insert(self.known, at[kept], names[kept]), np.insert(self.places, at[kept], places[kept])
        of_piece = places[inverse]
        n = self.size[of_piece]
        until = np.cumsum(n)
        out = self.ids[np.repeat(self.at[of_piece] - (until - n), n) + np.arange(until[-1] if len(n) else 0)].astype("<u2").tobytes()
        cuts = 2 * np.append(0, until)[np.searchsorted(starts, begin)]
        return [
            self.whole(t) if o or bad else out[a:b]
            for t, o, bad, a, b in zip(texts, odd, irregular.tolist(), cuts.tolist(), cuts[1:].tolist())
        ]


def laid_out(raw: list[bytes], drops_space: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts with a line break after each, where each begins (one more than texts), and which have white space side by side.

    The latter only matters where white space is kept; their places stay empty.
    """
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    begin = np.append(0, np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1))
    irregular = np.zeros(len(raw), bool)
    if not drops_space:
        white = CLASS[data] == WHITE
        white[begin[1:] - 1] = False
        pairs = np.flatnonzero(white[:-1] & white[1:])
        irregular[np.searchsorted(begin, pairs, "right") - 1] = True
    return data, begin, irregular


def cut(data: np.ndarray, begin: np.ndarray, drops_space: bool) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every piece.

    Words are what stands between white space. One of letters and marks alone is cut where these meet. Where white space
    is kept, one blank belongs to the word after it, and any other white space is a piece.
    """
    kind = CLASS[data]
    lead = np.flatnonzero(data == 0xC3)
    kind[lead] = kind[lead + 1] = np.where((data[lead + 1] == 0x97) | (data[lead + 1] == 0xB7), OTHER, LETTER)
    white = kind == WHITE
    first, last = white.copy(), white.copy()
    first[0], first[1:] = ~white[0], white[:-1] & ~white[1:]  # of words
    last[0], last[1:] = False, ~white[:-1] & white[1:]  # the byte after them
    others = np.append(0, np.cumsum(kind == OTHER))
    a, b = np.flatnonzero(first), np.flatnonzero(last)
    plain = others[a] == others[b]
    number = np.cumsum(first) - 1
    meet = np.flatnonzero((kind[1:] != kind[:-1]) & ~white[1:] & ~white[:-1]) + 1
    meet = meet[plain[number[meet]]]
    last[meet] = True
    if drops_space:
        first[meet] = True
        return np.flatnonzero(first), np.flatnonzero(last)
    separator = np.zeros(len(data), bool)
    separator[begin[1:] - 1] = True
    led = a[(a > 0) & (data[a - 1] == 32) & ~separator[a - 1]]
    own = white & ~separator
    own[led - 1] = False
    first[led] = False
    first[led - 1] = True
    first[meet] = True
    alone = np.flatnonzero(own)
    first[alone] = True
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    return starts, np.sort(np.concatenate([ends, alone + 1]))


def encoder(name: str) -> TextEncoder:
    if name not in _encoders:
        _encoders[name] = TextEncoder(name)
    return _encoders[name]
