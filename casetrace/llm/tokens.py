"""Token ids of whole texts through the ``tokenizers`` library.

Both vocabularies cut a text into *pieces* before any merge (letter runs,
punctuation runs, white space), and merges never cross a piece.  So the ids of
a text are the ids of its pieces one after the other: of every word that is
letters and then punctuation, the letters and the punctuation; of any other
word, the word as a whole.  A worker runs the library once per distinct piece,
many pieces a call, and keeps their ids in arrays ordered by the piece's hash.
Texts with unusual white space go through the library whole.

The memo is bounded and emptied when full, so memory does not grow with the
corpus.  It is keyed by a 64-bit hash of the piece and does not compare the
bytes: two pieces in one memo are confused with a probability of about 2**-64.

Ids travel as little-endian unsigned 32-bit bytes (4 bytes per id).
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

from casetrace.llm.words import Slice, find_words, hash_spans, text_slices

MEMO_PIECES = 2_000_000
_JOIN = 4_000

# Bytes of the letters A-Z, a-z, and of the ASCII punctuation
# that is one piece when it follows letters (the quotes and _ are not).
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[list(b"!#$%&()*+,-./:;<=>?@[\\]^`{|}~")] = True
# tags that tell a piece after a line break, and a tail, from the same bytes elsewhere
_OPENS, _TAIL = np.uint64(0xA5A5A5A5A5A5A5A5), np.uint64(0x5C5C5C5C5C5C5C5C)


def id_bytes(ids: Sequence[int]) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


class WordEncoder:
    """Ids of whole texts, word by word, for one ``tokenizers`` file.

    ``keeps_space`` is True for the byte-level vocabulary (a word's ids depend
    on the space or line break before it), False for the vocabulary that drops
    white space.
    """

    def __init__(self, path: str, memo_pieces: int = MEMO_PIECES):
        from tokenizers import Tokenizer

        self._tok = Tokenizer.from_file(path)
        self._tok.encode_special_tokens = True  # their strings are ordinary text
        self._limit = memo_pieces
        vocab = self._tok.get_vocab(with_added_tokens=True)
        size = max(vocab.values()) + 1
        self._opens = np.zeros(size, dtype=bool)   # token starts with the space mark
        self._closes = np.zeros(size, dtype=bool)  # token ends a piece
        for token, i in vocab.items():
            self._opens[i] = token.startswith("Ġ")
            self._closes[i] = token.endswith("</w>")
        self.keeps_space = not self._closes.any()
        self._break = self._plain(["\n"])[0] if self.keeps_space else np.zeros(0, "<u4")
        self._forget()

    def _forget(self) -> None:
        """Hashes of known pieces in order, and where their ids lie."""
        self._keys, self._at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._size, self._ids = np.zeros(0, np.int64), np.zeros(1 << 16, "<u4")
        self._used = 0

    def _keep(self, ids: np.ndarray) -> int:
        """Add ids to the memo's store; returns where they start."""
        at, self._used = self._used, self._used + len(ids)
        if self._used > len(self._ids):
            grown = np.zeros(2 * self._used, "<u4")
            grown[:at] = self._ids[:at]
            self._ids = grown
        self._ids[at:self._used] = ids
        return at

    def _plain(self, texts: Sequence[str]) -> list[np.ndarray]:
        return [np.asarray(e.ids, "<u4")
                for e in self._tok.encode_batch_fast(list(texts), add_special_tokens=False)]

    def _learn_letters(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                       lead: str) -> tuple[np.ndarray, np.ndarray]:
        """Places and numbers of the ids of letter runs, each after ``lead``
        (a space or a line break, whose own id is left out)."""
        ats, sizes = [], []
        for k in range(0, len(starts), _JOIN):
            s, e = starts[k:k + _JOIN], ends[k:k + _JOIN]
            bounds = np.concatenate(([0], np.cumsum(e - s + 1)))  # a lead before each
            body = np.full(bounds[-1], ord(lead), np.uint8)
            inside = np.ones(bounds[-1], bool)
            inside[bounds[:-1]] = False
            body[inside] = data[np.repeat(s - np.cumsum(e - s) + (e - s), e - s)
                                + np.arange(bounds[-1] - len(s))]
            ids = self._plain([body.tobytes().decode()])[0]
            if not self.keeps_space:
                last = np.flatnonzero(self._closes[ids]) + 1
                first = np.concatenate(([0], last[:-1]))
            elif lead == " ":
                first = np.flatnonzero(self._opens[ids])
                last = np.append(first[1:], len(ids))
            else:
                brk = np.flatnonzero(ids == self._break[0])
                first, last = brk + 1, np.append(brk[1:], len(ids))
            if len(first) != len(s):  # not one piece each after all
                at, size = self._learn_whole(data, s, e, lead)
            else:
                at, size = self._keep(ids) + first, last - first
            ats.append(at)
            sizes.append(size)
        return (np.concatenate([np.zeros(0, np.int64), *ats]),
                np.concatenate([np.zeros(0, np.int64), *sizes]))

    def _learn_whole(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                     lead: str) -> tuple[np.ndarray, np.ndarray]:
        """The same for any pieces, one text each."""
        skip = len(self._break) if lead == "\n" else 0
        found = [i[skip:] for i in self._plain(
            [lead + data[a:b].tobytes().decode() for a, b in zip(starts.tolist(), ends.tolist())])]
        size = np.fromiter(map(len, found), np.int64, len(found))
        at = self._keep(np.concatenate([np.zeros(0, "<u4"), *found]))
        return at + np.cumsum(size) - size, size

    @staticmethod
    def _cut(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """End of the letters that each word begins with, or its own end where
        it is no letters-then-punctuation; and whether it is."""
        letter = _LETTER[data]
        pair = np.flatnonzero(data[:-1] == 0xC3)  # two-byte letters of Latin-1
        second = data[pair + 1]
        pair = pair[(second >= 0x80) & (second <= 0xBF) & (second != 0x97) & (second != 0xB7)]
        letter[pair] = letter[pair + 1] = True
        stops = np.append(np.flatnonzero(~letter), len(data))
        core = np.minimum(stops[np.searchsorted(stops, starts)], ends)
        puncts = np.concatenate(([0], np.cumsum(_PUNCT[data])))
        fits = (core > starts) & (puncts[ends] - puncts[core] == ends - core)
        return np.where(fits, core, ends), fits

    def _odd_documents(self, part: Slice, starts: np.ndarray, ends: np.ndarray,
                       first_word: np.ndarray) -> np.ndarray:
        """Documents whose white space is not just one space or line break
        between words (only these matter to the byte-level vocabulary)."""
        data, offsets = part.data, part.offsets
        if not self.keeps_space:
            return np.zeros(len(offsets) - 1, bool)
        # other than single gaps: words and bytes do not add up
        word_bytes = np.concatenate(([0], np.cumsum(ends - starts)))[first_word]
        n_words = np.diff(first_word)
        odd = np.diff(offsets) != np.diff(word_bytes) + np.maximum(n_words - 1, 0)
        follows = np.ones(len(starts), bool)  # has a word of its document before it
        follows[first_word[:-1][n_words > 0]] = False
        gap = data[np.maximum(starts - 1, 0)]
        marks = [starts[follows & (gap != 32) & (gap != 10)]]
        # white space that other definitions know, by its UTF-8 bytes
        marks.append(np.flatnonzero((data >= 0x1C) & (data <= 0x1F)))
        lead = np.flatnonzero(np.isin(data[:-1], (0xC2, 0xE1, 0xE2, 0xE3)))
        second = data[lead + 1]
        third = data[np.minimum(lead + 2, len(data) - 1)]
        first = data[lead]
        marks.append(lead[(first == 0xC2) & ((second == 0x85) | (second == 0xA0))
                          | (first == 0xE1) & (second == 0x9A)
                          | (first == 0xE2) & (second == 0x80)
                          & ((third <= 0x8A) | np.isin(third, (0xA8, 0xA9, 0xAF)))
                          | (first == 0xE2) & (second == 0x81) & (third == 0x9F)
                          | (first == 0xE3) & (second == 0x80) & (third == 0x80)])
        at = np.concatenate(marks)
        docs = np.searchsorted(offsets, at, "right") - 1
        odd[docs[docs < len(odd)]] = True
        return odd

    def _known(self, data: np.ndarray, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray,
               kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and numbers of the ids of distinct pieces, given in the order
        of their keys; new ones are learnt.  Kinds: 0 letters, 1 letters after
        a break, 2 other, 3 other after a break, 4 punctuation."""
        if len(self._keys) + len(keys) > self._limit:
            self._forget()
        place = np.searchsorted(self._keys, keys)
        new = np.ones(len(keys), bool)
        inside = place < len(self._keys)
        new[inside] = self._keys[place[inside]] != keys[inside]
        at, size = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        at[~new], size[~new] = self._at[place[~new]], self._size[place[~new]]
        for kind, lead, learn in ((0, " ", self._learn_letters), (1, "\n", self._learn_letters),
                                  (2, " ", self._learn_whole), (3, "\n", self._learn_whole),
                                  (4, "", self._learn_whole)):
            some = np.flatnonzero(new & (kinds == kind))
            at[some], size[some] = learn(data, starts[some], ends[some], lead)
        self._keys = np.insert(self._keys, place[new], keys[new])
        self._at = np.insert(self._at, place[new], at[new])
        self._size = np.insert(self._size, place[new], size[new])
        return at, size

    def _encode_slice(self, part: Slice) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a slice's documents one after the other, and their bounds."""
        data, offsets = part.data, part.offsets
        n_docs = len(offsets) - 1
        starts, ends, first_word = find_words(part)
        odd = (self._odd_documents(part, starts, ends, first_word) if len(data)
               else np.zeros(n_docs, bool))
        if not len(starts):
            return self._with_whole(part, odd, np.zeros(0, "<u4"), np.zeros(n_docs + 1, np.int64))
        follows = np.ones(len(starts), bool)  # has a word of its document before it
        follows[first_word[:-1][np.diff(first_word) > 0]] = False
        # a line break has an id of its own before the word
        breaks = self.keeps_space & follows & (data[np.maximum(starts - 1, 0)] == 10)
        opens = breaks | (self.keeps_space & ~follows)
        core, fits = self._cut(data, starts, ends)
        tail = core < ends
        piece = np.concatenate(([0], np.cumsum(1 + tail)))  # first piece of each word
        begin, end = np.empty(piece[-1], np.int64), np.empty(piece[-1], np.int64)
        kinds = np.full(piece[-1], 4, np.int8)
        head = piece[:-1]
        begin[head], end[head] = starts, core
        kinds[head] = np.where(fits, 0, 2) + opens
        begin[head[tail] + 1], end[head[tail] + 1] = core[tail], ends[tail]
        keys = hash_spans(data, begin, end)
        keys ^= np.where(kinds == 4, _TAIL, np.where(kinds % 2 == 1, _OPENS, np.uint64(0)))
        distinct, where, back = np.unique(keys, return_index=True, return_inverse=True)
        at, size = self._known(data, distinct, begin[where], end[where], kinds[where])
        lead = np.zeros(len(begin), np.int64)
        lead[head] = breaks
        sizes = size[back]
        bounds = np.concatenate(([0], np.cumsum(sizes + lead)))
        ids = np.empty(bounds[-1], "<u4")
        put = np.ones(bounds[-1], bool)
        put[bounds[:-1][lead == 1]] = False
        if self.keeps_space:
            ids[~put] = self._break[0]
        take = np.repeat(at[back] - (np.cumsum(sizes) - sizes), sizes)
        ids[put] = self._ids[take + np.arange(len(take))]
        return self._with_whole(part, odd, ids, bounds[piece[first_word]])

    def _with_whole(self, part: Slice, odd: np.ndarray, ids: np.ndarray,
                    bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``ids`` with those of odd documents taken from their whole texts."""
        if not odd.any():
            return ids, bounds
        parts, at = [], 0
        sizes = np.diff(bounds)
        for d in np.flatnonzero(odd).tolist():
            text = part.data[part.offsets[d]:part.offsets[d + 1]].tobytes().decode()
            whole = self._plain([text])[0]
            parts += [ids[at:bounds[d]], whole]
            at, sizes[d] = bounds[d + 1], len(whole)
        return (np.concatenate([*parts, ids[at:]]),
                np.concatenate(([0], np.cumsum(sizes))))

    def encode_slices(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first document, ids, bounds of its documents) slice by slice."""
        for part in text_slices(texts):
            yield (part.first, *self._encode_slice(part))

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of each whole text (null: none), in order, without special tokens."""
        for _, ids, bounds in self.encode_slices(texts):
            raw, cuts = ids.tobytes(), (bounds * 4).tolist()
            for a, b in zip(cuts[:-1], cuts[1:]):
                yield raw[a:b]


@functools.lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """One encoder per worker process and file."""
    return WordEncoder(path)
