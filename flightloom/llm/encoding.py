"""Token ids of whole texts by the tokenizers library, each different chunk of text encoded once."""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import islice

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism

import numpy as np  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

KNOWN_CHUNKS = 600_000  # of them kept in a worker process, about 100 MB
KEPT_CHUNKS = 400_000  # of them kept when it is full: the first ones met, which are the common ones
LONGEST_CHUNK = 80  # characters; longer chunks are not remembered
CHARACTERS_AT_ONCE = 500_000  # of the texts that are cut up together
WORDS_AT_ONCE = 5_000  # given to the tokenizer in one string: it needs many times their size while it works
MARKS = ".,!|;:?"
LATIN = "ɏ"


def parts(words: list[str]) -> Iterator[list[str]]:
    """The words by as many as are encoded in one string."""
    for i in range(0, len(words), WORDS_AT_ONCE):
        yield words[i : i + WORDS_AT_ONCE]


class ChunkEncoder:
    """``encode`` gives each text's ids, exactly those of the tokenizer on the whole text.

    A text is cut at single spaces and newlines. That is safe where the tokenizer's own word splitting
    puts a boundary there: with ``space_joins_next`` a space belongs to the word that follows it and a
    newline between words is a piece of its own (byte-level BPE), else white space is dropped. Texts in
    which a cut would touch further white space are encoded whole. Ids are little-endian unsigned numbers of ``width`` bytes.
    """

    def __init__(self, path: str, space_joins_next: bool, width: int = 4):
        self.tokenizer = Tokenizer.from_file(path)
        self.space = " " if space_joins_next else ""
        self.dtype = np.dtype(f"<u{width}")
        # between chunks: a piece that no chunk contains and that joins with none
        self.between = "\n" if space_joins_next else " <|startoftext|> "
        self.mark = self.between.strip() or self.between
        self.mark_id = self._ids([self.mark])[0][0]
        self.known: dict[str, bytes | None] = {}
        self.newline = self._bytes(["\n"])[0] if space_joins_next else b""
        self.marks = {m: self._bytes([m])[0] for m in MARKS}
        self.ends, self.plain = self._word_ends()
        self.starts = self._word_starts()

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _bytes(self, texts: list[str]) -> list[bytes]:
        return [np.array(ids, self.dtype).tobytes() for ids in self._ids(texts)]

    def _word_ends(self) -> tuple[np.ndarray, frozenset[str]]:
        """Which ids end a word, and the letters whose words are told apart by these ids alone and whose case does
        not count. None if a space belongs to the word that follows or the tokenizer has no such ids."""
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        ends = np.zeros(self.tokenizer.get_vocab_size() if suffix and not self.space else 0, bool)
        if not ends.size:
            return ends, frozenset()
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            ends[i] = token.endswith(suffix)
        letters = [c for c in map(chr, range(ord(LATIN) + 1)) if c.isalpha() and len(c.lower()) == 1]
        both = zip(letters, self._ids(letters), self._ids([c.lower() for c in letters]))
        return ends, frozenset(c for c, ids, small in both if ids == small and ends[ids].nonzero()[0].tolist() == [len(ids) - 1])

    def _word_starts(self) -> np.ndarray:
        """Which ids begin with a space. Empty if a space does not belong to the word that follows."""
        if not self.space:
            return np.zeros(0, bool)
        space = self.tokenizer.id_to_token(self._ids([" "])[0][0])  # as the tokenizer writes it
        starts = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            starts[i] = token.startswith(space)
        return starts

    def _spaced(self, words: list[str]) -> None:
        """Learns words without white space, each with the space before it, and cuts before the ids that begin with one."""
        if not words:
            return
        ids = np.array(self._ids([" " + " ".join(words)])[0], self.dtype)
        bounds = [*(np.flatnonzero(self.starts[ids]) * self.dtype.itemsize).tolist(), ids.nbytes]
        data = ids.tobytes()
        self.known.update((w, data[a:b]) for w, a, b in zip(words, bounds[:-1], bounds[1:], strict=True))

    def _spell(self, words: list[str]) -> None:
        """Learns words of plain letters, each spelling once whatever its case, and cuts behind the ids that end words."""
        known, small = self.known, [w.lower() for w in words]
        new = list({w for w in small if w not in known})
        found: dict[str, bytes] = {}
        if new:
            ids = np.array(self._ids([" ".join(new)])[0], self.dtype)
            bounds = ((np.flatnonzero(self.ends[ids]) + 1) * self.dtype.itemsize).tolist()
            data = ids.tobytes()
            found = {w: data[a:b] for w, a, b in zip(new, [0, *bounds[:-1]], bounds, strict=True)}
        for w, s in zip(words, small):
            known[w] = found[s] if s in found else known[s]

    def _together(self, pieces: list[str], lead: str, head: bytes = b"") -> None:
        """Learns many chunks, each lead + piece, from one encoded string."""
        if not pieces:
            return
        text = self.between.join((lead if lead != "\n" else "") + p for p in pieces)
        ids = np.array(self._ids([text])[0], self.dtype)
        bounds = np.r_[-1, np.flatnonzero(ids == self.mark_id), ids.size]
        size, data, known = self.dtype.itemsize, ids.tobytes(), self.known
        name = "\n" if lead == "\n" else ""
        for p, a, b in zip(pieces, ((bounds[:-1] + 1) * size).tolist(), (bounds[1:] * size).tolist()):
            known[name + p] = head + data[a:b]

    def _learn(self, chunks: set[str]) -> None:
        known, marks = self.known, self.marks
        lines: set[str] = set()
        words: set[str] = set()
        lined, ending, apart = [], [], []
        for c in chunks:
            if c.isalnum() and len(c) <= LONGEST_CHUNK:  # most of them
                words.add(c)
            elif self.space and c[:1] == "\n":  # the start of a line: no space before it
                body = c[1:]
                if not body or len(body.split()) != 1 or body[0].isspace() or body[-1].isspace():
                    known[c] = None
                elif body[-1] in marks and body[:-1].isalpha() and max(body) <= LATIN:
                    lines.add(body[:-1])
                    lined.append(c)
                elif "<|" in body or len(body) > LONGEST_CHUNK:
                    apart.append(c)
                else:
                    lines.add(body)
            elif c[-1:] in marks and c[:-1].isalpha() and max(c) <= LATIN:
                words.add(c[:-1])
                ending.append(c)
            elif self.space and (not c or c[0].isspace() or c[-1].isspace()):
                known[c] = None
            elif "<|" in c or len(c) > LONGEST_CHUNK or len(c.split()) != 1:
                apart.append(c)
            else:
                words.add(c)
        unknown = [w for w in words if w not in known]
        if self.plain:
            spelled = self.plain.issuperset
            for some in parts([w for w in unknown if spelled(w)]):
                self._spell(some)
            unknown = [w for w in unknown if w not in known]
        for some in parts(unknown):
            if self.space:
                self._spaced(some)
            else:
                self._together(some, self.space)
        for some in parts([w for w in lines if "\n" + w not in known]):
            self._together(some, "\n", self.newline)
        known.update(zip(apart, self._bytes([c if self.space and c[0] == "\n" else self.space + c for c in apart])))
        for c in ending + lined:
            known[c] = known[c[:-1]] + marks[c[-1]]

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        group: list[str] = []
        size = 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size >= CHARACTERS_AT_ONCE:
                out += self._encode(group)
                group, size = [], 0
        return out + self._encode(group)

    def _encode(self, texts: list[str]) -> list[bytes]:
        if self.space:
            # a text starts like a line, but without the newline's id
            split = [("\n" + t).replace("\n", " \n")[1:].split(" ") for t in texts]
        else:
            split = [t.replace("\n", " ").split(" ") for t in texts]
        new = set().union(*split).difference(self.known)
        self._learn(new)
        get, skip, out = self.known.__getitem__, len(self.newline), []
        for text, chunks in zip(texts, split):
            try:
                if self.space and " \n" in text:
                    raise TypeError
                out.append(b"".join(map(get, chunks))[skip:])
            except TypeError:  # a chunk without ids of its own
                out.append(self._bytes([text])[0])
        for c in new:
            if len(c) > LONGEST_CHUNK:
                self.known.pop(c, None)
        if len(self.known) > KNOWN_CHUNKS:
            self.known = dict(islice(self.known.items(), KEPT_CHUNKS))
        return out


_encoders: dict[tuple, ChunkEncoder] = {}


def encoder(path: str, space_joins_next: bool, width: int = 4) -> ChunkEncoder:
    """One encoder per worker process, kept between tasks."""
    key = (path, space_joins_next, width)
    if key not in _encoders:
        _encoders[key] = ChunkEncoder(*key)
    return _encoders[key]
