"""Token ids of whole texts by a public tokenizer file, a fragment at a time.

A text is cut before every space that follows a non-space; both tokenizer kinds used
here never join characters over such a place, nor a letter with punctuation after it.
Fragments repeat a lot, so each is encoded once and then looked up. The table of fragments
is kept in two generations: when the young one is full the old one goes. That changes the
time, never the ids.
"""

from __future__ import annotations

import os
import re
from array import array
from itertools import chain

_SPACES = re.compile(r" (?<=\s )")
_PLACES = re.compile(r"(?<=\S)(?= )")
# Punctuation that ends words; both tokenizers cut between a letter and a run of it.
_ENDINGS = ".,;:!?)%*#$&"
# Letters of Latin-1: single code points that lower-casing and NFC leave single.
_LETTERS = re.compile(r" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch
# Byte-level tokenizers spell a byte by its printable Latin-1 character, and the others, in
# order, by the code points from 256.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_SPELLING = {
    b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _PRINTABLE)
}
_SPACE = chr(_SPELLING[0x20])
# Line ends, each between two characters that are no white space.
_LINES = re.compile(r"\s?\S+(?:\n\S+)+").fullmatch
_encoders: dict[tuple[str, int], FragmentEncoder] = {}


class FragmentEncoder:
    """Encodes lists of texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str, most_fragments: int = 250_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._most = most_fragments
        self._known: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._characters = 0
        self._endings: dict[str, bytes] = {}
        self._tokenize = self._tokenizer.model.tokenize
        # A lower-casing tokenizer drops the space, the other one spells it as a letter.
        probe = self._tokenizer.encode(" A", add_special_tokens=False).tokens
        self._lowers = probe == ["a</w>"]
        if not self._lowers and probe != ["\u0120A"]:
            self._word = lambda word: None

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [_fragments(t) for t in texts]
        known = self._known
        new = set(chain.from_iterable(cut)).difference(known)
        if len(known) + len(new) > self._most or self._characters > 32 * self._most:
            self._old, self._known, self._characters = known, {}, 0
            known = self._known
            new = set(chain.from_iterable(cut))
        self._learn(new)
        return [b"".join(map(known.__getitem__, fragments)) for fragments in cut]

    def forget(self) -> None:
        """Empty the table of fragments."""
        self._known, self._old, self._characters = {}, {}, 0
        self._endings.clear()

    def _learn(self, new: set[str]) -> None:
        """Add fragments: from the old generation, by their parts, or encoded whole."""
        known, old, rest = self._known, self._old, []
        self._characters += sum(map(len, new))
        again = old.keys() & new
        known.update(zip(again, map(old.__getitem__, again)))
        for fragment in new - again:
            if "\n" in fragment and _LINES(fragment):
                ids = self._by_lines(fragment)
            else:
                ids = self._by_word(fragment)
            if ids is None:
                rest.append(fragment)
            else:
                known[fragment] = ids
        for at in range(0, len(rest), 1024):
            some = rest[at : at + 1024]
            done = self._tokenizer.encode_batch_fast(some, add_special_tokens=False)
            for fragment, encoding in zip(some, done, strict=True):
                known[fragment] = array("I", encoding.ids).tobytes()

    def _by_word(self, fragment: str) -> bytes | None:
        """Ids of Latin letters and the punctuation that follows them; of nothing else."""
        word = fragment.rstrip(_ENDINGS)
        if len(word) == len(fragment):
            return self._word(word)
        if not _LETTERS(word):
            return None
        known = self._known
        if (ids := known.get(word) or self._old.get(word) or self._word(word)) is None:
            return None
        known[word] = ids
        return ids + self._ending(fragment[len(word) :])

    def _by_lines(self, fragment: str) -> bytes | None:
        """Ids of lines of such words; both tokenizers cut at a line's end between other characters."""
        known, old = self._known.get, self._old.get
        lines = fragment.split("\n")
        found = [known(line) or old(line) or self._by_word(line) for line in lines]
        return None if None in found else self._ending("\n").join(found)

    def _word(self, word: str) -> bytes | None:
        """Ids of Latin letters, with or without a space before them; of nothing else.

        Such a word is what the tokenizer itself would hand to its model.
        """
        if not _LETTERS(word):
            return None
        if self._lowers:
            word = word.lstrip(" ").lower()
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_SPELLING)
        elif word[0] == " ":
            word = _SPACE + word[1:]
        return array("I", [t.id for t in self._tokenize(word)]).tobytes()

    def _ending(self, ending: str) -> bytes:
        if ending not in self._endings:
            if len(self._endings) > 10_000:
                self._endings.clear()
            encoding = self._tokenizer.encode(ending, add_special_tokens=False)
            self._endings[ending] = array("I", encoding.ids).tobytes()
        return self._endings[ending]


def _fragments(text: str) -> list[str]:
    if "\0" in text or _SPACES.search(text):
        return _PLACES.split(text)
    return text.replace(" ", "\0 ").split("\0")


def encoder(path: str, most_fragments: int = 250_000) -> FragmentEncoder:
    """The encoder of a tokenizer file, kept for the life of the worker process.

    Two generations of `most_fragments` take some fifty megabytes for each 100,000.
    """
    key = (path, most_fragments)
    if key not in _encoders:
        _encoders[key] = FragmentEncoder(path, most_fragments)
    return _encoders[key]
