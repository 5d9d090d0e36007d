"""Cutting a text into pieces whose byte-level BPE codes do not depend on
their surroundings, so that codes can be kept per piece.

The split pattern gives a single space to the token after it and cuts only
at changes of character class, so in a text whose white space is single
characters between words, every space-separated piece (with the space before
it) is coded alone. Any other text is cut by its caller's general path.
"""

from __future__ import annotations

from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space for str.split but not for the pattern.
_ODD = ("\x1c", "\x1d", "\x1e", "\x1f")
#: All white space of str.split but the space and the line feed.
_OTHER = tuple(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")
_OTHER_ASCII = tuple(c for c in _OTHER if c.isascii())
#: ASCII marks that the pattern cuts from letters and numbers before them (an apostrophe may begin a contraction).
_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")


def single_spaced(text: str) -> bool:
    """Whether the text's white space is single characters between words."""
    if not any(c in text for c in (_OTHER_ASCII if text.isascii() else _OTHER)):  # spaces and line feeds only
        return not (not text or text[0] in " \n" or text[-1] in " \n" or "  " in text or "\n\n" in text or " \n" in text or "\n " in text)
    words = text.split()
    return bool(words) and len(text) - sum(map(len, words)) == len(words) - 1 and not any(c in text for c in _ODD)


def simple_pieces(text: str) -> list[str] | None:
    """Pieces between single spaces, or None if the text needs the general path.

    All pieces but the first have a space before them.
    """
    return text.split(" ") if single_spaced(text) else None


def _values(codes: dict[str, bytes], pieces: list[str]):
    return itemgetter(*pieces)(codes) if len(pieces) > 1 else [codes[w] for w in pieces]


class PieceCodes:
    """Codes of pieces seen lately, as bytes of little-endian 32-bit ids.

    Two generations of at most ``limit`` pieces: a full one becomes the old
    one, from which pieces still in use are taken over. A comma or full stop
    after a letter or number is coded alone, so such a piece is composed of
    what comes before it and the mark.
    """

    def __init__(self, encode, limit: int = 400_000, longest: int = 64):
        self._encode = encode  # list of strings -> list of bytes
        self._limit, self._longest = limit, longest
        self._first: dict[str, bytes] = {}
        self._later: dict[str, bytes] = {}
        self._old: tuple[dict[str, bytes], dict[str, bytes]] = ({}, {})
        self._marks = dict(zip(",.", encode([",", "."])))

    def code(self, texts: list[list[str]]) -> list[bytes]:
        """The joined codes of each list of pieces."""
        if len(self._first) + len(self._later) > self._limit:
            self._old = self._first, self._later
            self._first, self._later = {}, {}
        first, later, old = self._first, self._later, self._old
        tails = [p[1:] for p in texts]
        unseen = {p[0] for p in texts if p}.difference(first), set().union(*tails).difference(later)
        todo, composed = [], []
        for kept, before, pieces in zip((first, later), old, unseen):
            again = pieces.intersection(before)
            kept.update((w, before[w]) for w in again)
            pieces = pieces - again
            marked = [w for w in pieces if w[-1:] in self._marks and w[-2:-1].isalnum()]
            composed.append(marked)
            pieces.difference_update(marked)
            pieces.update(w for w in (m[:-1] for m in marked) if w not in kept)
            todo.append(list(pieces))
        codes = self._encode([*todo[0], *(" " + w for w in todo[1])]) if any(todo) else []
        first.update(zip(todo[0], codes))
        later.update(zip(todo[1], codes[len(todo[0]):]))
        for kept, marked in zip((first, later), composed):
            kept.update((w, kept[w[:-1]] + self._marks[w[-1]]) for w in marked)
        out = [first[p[0]] + b"".join(_values(later, tail)) if p else b"" for p, tail in zip(texts, tails)]
        for kept, pieces in zip((first, later, first, later), (*todo, *composed)):
            for w in pieces:
                if len(w) > self._longest:
                    del kept[w]
        return out


class TextCodes:
    """Codes of whole texts, put together from those of their distinct pieces.

    A run of texts is cut and its distinct pieces are found in Arrow; only
    those are looked up among the pieces seen lately (two generations, as in
    ``PieceCodes``), and the ids of all pieces are gathered at once. Pieces
    also begin at line feeds, which the pattern codes alone between words: a
    piece is a line feed and what follows it, or stands for a space and
    itself. The first of a text gets a line feed, whose codes are dropped
    again. Marks at the end of a piece, after a letter or number, are coded
    alone, so such a piece is composed of what comes before them and them.
    """

    def __init__(self, whole, sizes: np.ndarray, limit: int = 400_000, longest: int = 64):
        self._whole = whole  # list of strings -> list of bytes, little-endian 32-bit ids
        self._sizes = sizes  # bytes of each token
        self._limit, self._longest = limit, longest
        self._codes: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._marks: dict[str, bytes] = {}
        self._feed = len(whole(["\n"])[0]) // 4

    def code(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; all are ``single_spaced``."""
        if not texts:
            return []
        cut = pc.split_pattern(pa.array(["\n" + t.replace("\n", " \n") for t in texts], pa.large_string()), " ")
        coded = cut.flatten().dictionary_encode()
        found = self._find(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, found), np.int64, len(found)) >> 2
        flat, starts = np.frombuffer(b"".join(found), "<i4"), np.cumsum(sizes) - sizes
        at = coded.indices.to_numpy(zero_copy_only=False)
        n = sizes[at]
        ends = np.concatenate([[0], np.cumsum(n)])
        ids = flat[np.repeat(starts[at] - ends[:-1], n) + np.arange(ends[-1])]
        bounds = ends[cut.offsets.to_numpy() - cut.offsets[0].as_py()].tolist()
        return [ids[a + self._feed:b] for a, b in zip(bounds, bounds[1:])]

    def _find(self, pieces: list[str]) -> list[bytes]:
        """The codes of distinct pieces."""
        if len(self._codes) > self._limit:
            self._old, self._codes = self._codes, {}
        codes, old = self._codes, self._old
        found = list(map(codes.get, pieces))
        places = [i for i, c in enumerate(found) if c is None]
        if not places:
            return found
        todo, composed, heads, marks = {}, [], [], []
        for w in map(pieces.__getitem__, places):
            if w in old:
                codes[w] = old[w]
                continue
            head = w.rstrip(_MARKS)
            if head == w or not head[-1:].isalnum():
                todo[w] = None
                continue
            composed.append(w)
            heads.append(head)
            marks.append(w[len(head):])
            if head in old:
                codes[head] = old[head]
            elif head not in codes:
                todo[head] = None
        self._encode(list(todo))
        if len(self._marks) > self._limit:
            self._marks = {}
        new = list(set(marks).difference(self._marks))
        self._marks.update(zip(new, self._whole(new)))
        for w, head, mark in zip(composed, heads, marks):
            codes[w] = codes[head] + self._marks[mark]
        for i in places:
            found[i] = codes[pieces[i]]
        for kept, seen in ((codes, todo), (codes, composed), (codes, heads), (self._marks, new)):
            for w in seen:
                if len(w) > self._longest:
                    kept.pop(w, None)
        return found

    def _encode(self, pieces: list[str]) -> None:
        """Take up the codes of pieces: encoded as one text and cut apart again by the bytes of their tokens."""
        if not pieces:
            return
        text = "".join([w if w[0] == "\n" else " " + w for w in pieces])
        raw = np.frombuffer(text.encode(), np.uint8)
        ids = self._whole([text])[0]
        ends = np.append(np.flatnonzero((raw == 32) | (raw == 10))[1:], len(raw))
        cuts = (4 * np.searchsorted(np.cumsum(self._sizes[np.frombuffer(ids, "<i4")]), ends, side="left") + 4).tolist()
        self._codes.update(zip(pieces, [ids[a:b] for a, b in zip([0, *cuts[:-1]], cuts)]))


def groups(texts: list[str], size: int = 2_000_000):
    """Consecutive runs of texts of about ``size`` characters."""
    i = 0
    while i < len(texts):
        j, total = i, 0
        while j < len(texts) and (j == i or total + len(texts[j]) <= size):
            total += len(texts[j])
            j += 1
        yield i, j
        i = j
