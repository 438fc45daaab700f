"""Token ids of texts by a public tokenizer file, with the ids of words kept for the next text.

The tokenizers library spends most of its time on words it has met before. A text is therefore cut where no token can
lie across, before single spaces and after single line feeds. Every distinct word has a number, under which its ids
stand in a table; new words go through the library in one call, and the ids of texts are gathered from the table as
arrays. Texts in which such cuts would not be safe go through the library whole.
"""

import os
import re
import zlib
from collections import defaultdict
from itertools import chain, count, islice

import numpy as np

#: Words remembered by one Python worker before those met once are forgotten, their ids, and the longest of them in characters.
REMEMBERED, IDS, LONGEST = 1_000_000, 8 << 20, 64
#: Texts encoded together, and their characters.
TEXTS, CHARACTERS = 4_000, 8 << 20

#: Stands before a word that follows no space. Texts that hold it are not cut.
_JOINED = "\r"
# A cut beside any of these may not be safe: white space other than a space or line feed, characters beyond Latin-1
# letters (other letters, combining marks, other white space), marks of special tokens.
_UNSAFE_WORD = re.compile(r"[\t\r\x0b\x0c\x1c-\x1f\x80-\xbf]|[^\x00-\xff]|<\|")
# Letters, and marks behind them, if any: no token lies across. No apostrophe, which may join letters, and nothing of special tokens.
_PLAIN_WORD = re.compile(r"(\r?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([!\"#$%&()*+,\-./:;=?@\[\\\]^_`{}~]*\n?)")


def _unsafe(text: str) -> bool:
    """White space in runs or at an end of the text, or the mark."""
    return ("  " in text or " \n" in text or "\n " in text or "\n\n" in text or _JOINED in text
            or text[:1].isspace() or text[-1:].isspace())


def _places(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs, one run after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(begins - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


class Encoder:
    """Ids of texts as the library's ``encode(text, add_special_tokens=False)`` gives them.

    ``path`` is a tokenizer file whose pre-tokenizer splits at white space and at changes between letters and
    punctuation. Strings of special tokens in a text get the special ids, as in the library. So many
    ``words`` are remembered, REMEMBERED if not given.
    """

    def __init__(self, path: str, words: int | None = None):
        from tokenizers import Tokenizer
        self.library, self.words = Tokenizer.from_file(path), words
        # ``ids[begins[n] : begins[n + 1]]`` belong to the word with number n.
        self.numbers: defaultdict[str, int] = defaultdict(count().__next__)
        self.begins, self.ids = np.zeros(1, dtype=np.int64), np.zeros(0, dtype="<u4")
        self.unsafe, self.uses = np.zeros(0, dtype=bool), np.zeros(0, dtype=np.int64)

    def _forget(self) -> None:
        """Forget the words that were not met again, or all if that leaves too many."""
        again = self.uses > 1
        kept = [(w, n) for w, n in self.numbers.items() if again[n]]
        old = np.array([n for _, n in kept], dtype=np.int64)
        sizes = self.begins[old + 1] - self.begins[old]
        if len(kept) > (self.words or REMEMBERED) // 2 or sizes.sum() > IDS // 2:
            kept, old, sizes = [], old[:0], sizes[:0]
        begins = np.concatenate(([0], np.cumsum(sizes)))
        self.ids = self.ids[_places(self.begins[old], sizes)]
        self.begins, self.unsafe, self.uses = begins, self.unsafe[old], np.zeros(len(old), dtype=np.int64)
        self.numbers = defaultdict(count(len(kept)).__next__, {w: i for i, (w, _) in enumerate(kept)})

    def batch(self, texts: list[str], characters: int = CHARACTERS) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts after each other, and where each text's begin (one more entry for the end)."""
        values, sizes, at = [], [], 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and end - at < TEXTS and (end == at or size + len(texts[end]) <= characters):
                size += len(texts[end])
                end += 1
            ids, own = self._together(texts[at:end])
            values.append(ids)
            sizes.append(own)
            at = end
        starts = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum(np.concatenate(sizes) if sizes else [], out=starts[1:])
        return np.concatenate(values) if values else np.zeros(0, dtype="<u4"), starts

    def _together(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.unsafe) > (self.words or REMEMBERED) or len(self.ids) > IDS:
            self._forget()
        cut = [[_JOINED + t] if _unsafe(t) else (_JOINED + t.replace("\n", f"\n {_JOINED}")).split(" ") for t in texts]
        known = len(self.unsafe)
        codes, bounds = self._numbered(cut)
        hit = np.concatenate(([0], np.cumsum(self.unsafe[codes])))
        unsafe = [i for i in np.flatnonzero(hit[bounds[1:]] > hit[bounds[:-1]]).tolist() if len(cut[i]) > 1]
        if unsafe:
            for i in unsafe:
                cut[i] = [_JOINED + texts[i]]  # in one piece nothing is cut, so nothing is unsafe
            codes, bounds = self._numbered(cut)
        for word in [w for w in islice(reversed(self.numbers), len(self.unsafe) - known) if len(w) > LONGEST]:
            del self.numbers[word]  # its number is not given again
        self.uses = np.bincount(codes, minlength=len(self.unsafe)) + np.pad(self.uses, (0, len(self.unsafe) - len(self.uses)))
        begins = self.begins[codes]
        each = self.begins[codes + 1] - begins
        ends = np.concatenate(([0], np.cumsum(each)))
        return self.ids[_places(begins, each)], np.diff(ends[bounds])

    def _numbered(self, cut: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The number of each word, and where each text's begin; ids of new words go into the table."""
        bounds = np.cumsum([0, *map(len, cut)])
        codes = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(cut)), dtype=np.int64, count=bounds[-1])
        new = list(islice(reversed(self.numbers), max(0, codes.max(initial=-1) + 1 - len(self.unsafe))))[::-1]
        if new:
            self._learn(new)
        return codes, bounds

    def _learn(self, new: list[str]) -> None:
        """Enter the ids of new words. A word with marks behind it has its own ids and then those of the marks, so it goes
        through the library once, whatever marks follow it."""
        known, pieces, bounds, unsafe = len(self.unsafe), [], [0], []
        for word in new:
            plain = _PLAIN_WORD.fullmatch(word)
            if plain is None:
                pieces.append(word)
                unsafe.append(_UNSAFE_WORD.search(word, word[:1] == _JOINED) is not None)
            else:
                pieces.append(plain[1])
                if plain[2]:
                    pieces.append(_JOINED + plain[2])
                unsafe.append(False)
            bounds.append(len(pieces))
        # Pieces that the table does not hold yet are numbered as if they stood behind it.
        fresh: defaultdict[str, int] = defaultdict(count(known).__next__)
        held = self.numbers.get
        rows = np.array([n if (n := held(p, known)) < known else fresh[p] for p in pieces], dtype=np.int64)
        wanted, old = list(fresh), rows[rows < known]
        sizes = [self.begins[old + 1] - self.begins[old]]
        found = [self.ids[_places(self.begins[old], sizes[0])]]
        for at in range(0, len(wanted), 20_000):
            words = [w[1:] if w[0:1] == _JOINED else " " + w for w in wanted[at : at + 20_000]]
            lists = [done.ids for done in self.library.encode_batch_fast(words, add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, lists), dtype=np.int64, count=len(lists)))
            found.append(np.fromiter(chain.from_iterable(lists), dtype="<u4", count=sizes[-1].sum()))
        # Of these, in this order, each piece is one.
        which = np.where(rows < known, np.cumsum(rows < known) - 1, rows + (len(old) - known))
        each = np.concatenate(sizes)
        ids = np.concatenate(found)[_places((np.cumsum(each) - each)[which], each[which])]
        ends = np.concatenate(([0], np.cumsum(each[which])))[bounds[1:]]
        self.begins = np.concatenate((self.begins, self.begins[-1] + ends))
        self.ids = np.concatenate((self.ids, ids))
        self.unsafe = np.concatenate((self.unsafe, unsafe))


_ENCODERS: dict[tuple[str, int | None], Encoder] = {}


def encoder(path: str, words: int | None = None) -> Encoder:
    """One encoder per Python worker, file and number of remembered words."""
    if (path, words) not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[path, words] = Encoder(path, words)
    return _ENCODERS[path, words]


def crc32(ids: np.ndarray) -> int:
    """CRC of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4"))
