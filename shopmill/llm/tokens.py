"""Token ids of whole texts by a public byte-level BPE vocabulary, as little-endian bytes.

The tokenizer splits a text into words, runs of punctuation and white space
before it merges bytes. Where such a split is certain, a text can be cut and
the ids of its parts put together: after a run of letters before a blank or
ASCII punctuation, after ASCII punctuation before a blank, letter or digit, and
before a blank or line break that follows no white space. The parts repeat, so
each goes to the tokenizers library once per process and is looked up later. A
text with a part that ends in another white space character (a tab, a no-break
space) has no certain split there and goes to the library whole. Added tokens
that a text holds literally (``<|endoftext|>``) get their own ids, as by the
library's default; the text is split there first.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np

_LETTER = "A-Za-zÀ-ÖØ-öø-ɏ"
_MARK = r".,!?;:$%&*#|()\"+=/<>{}~_\-"
PARTS = re.compile(
    rf" ?[{_LETTER}]++(?=[ \n{_MARK}]|\Z)"
    rf"| ?[{_MARK}]++(?=[ \n{_LETTER}0-9]|\Z)"
    rf"|\n(?=[{_LETTER}{_MARK}0-9])"
    r"|[ \n]*[^ \n]+|[ \n]+"
)
#: A part that is a single word or run of punctuation to the tokenizer.
SINGLE = re.compile(rf" ?(?:[{_LETTER}]+|[{_MARK}]+)")
#: Entries and characters of an entry that a process keeps; others are encoded again.
KEPT_PARTS, KEPT_LENGTH = 500_000, 24
#: Characters of a text that are cut into parts at once.
SECTION = 1 << 20


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The printable character by which a byte-level vocabulary writes each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in set(plain))
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class NoCut(Exception):
    """The split after a part is not certain."""


class Parts(dict):
    """Ids by part; a missing one is encoded and, if there is room, kept."""

    def __init__(self, tokenizer, kind: str):
        super().__init__()
        self.tokenizer, self.kind = tokenizer, kind
        self.letters = _byte_letters()

    def __missing__(self, part: str) -> bytes:
        bare = part[1:] if part[0] == " " else part
        if bare.isalpha() or SINGLE.fullmatch(part):
            if part.isascii():
                word = part if bare is part else "Ġ" + bare
            else:
                word = part.encode().decode("latin-1").translate(self.letters)
            ids = array(self.kind, [t.id for t in self.tokenizer.model.tokenize(word)]).tobytes()
        elif part[-1].isspace() and part[-1] not in " \n":
            raise NoCut
        else:
            found = self.tokenizer.encode(part, add_special_tokens=False)
            ids = array(self.kind, found.ids).tobytes()
        if len(part) <= KEPT_LENGTH and len(self) < KEPT_PARTS:
            self[part] = ids
        return ids


class Encoder:
    """Ids of texts, as the library gives them by default; added tokens in a text are tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        # Tokens that match words only, take blanks with them or are sought in normalized text are the library's business.
        self.plain = all(not (t.single_word or t.lstrip or t.rstrip or t.normalized) for t in added.values())
        self.added = [t.content for t in added.values()]
        # At one place the longest of several tokens counts.
        longest = sorted(self.added, key=len, reverse=True)
        self.splits = re.compile("|".join(map(re.escape, longest)) or r"(?!)")
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.ids = {t.content: np.asarray([i], self.dtype).tobytes() for i, t in added.items()}
        self.parts = Parts(self.tokenizer, "H" if size <= 1 << 16 else "I")

    def whole(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, from the library's encoder at one go."""
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [np.asarray(e.ids, self.dtype).tobytes() for e in found]

    def encode(self, text: str | None) -> bytes:
        """Ids of a text, through its parts; none for a null."""
        text = text or ""
        if not self.plain:
            return self.whole([text])[0]
        if not any(t in text for t in self.added):
            return b"".join(map(self._section, _sections(text)))
        # What lies between added tokens is text of its own to the library.
        ids, at = [], 0
        for found in self.splits.finditer(text):
            ids += map(self._section, _sections(text[at : found.start()]))
            ids.append(self.ids[found.group()])
            at = found.end()
        ids += map(self._section, _sections(text[at:]))
        return b"".join(ids)

    def _section(self, text: str) -> bytes:
        try:
            return b"".join(map(self.parts.__getitem__, PARTS.findall(text)))
        except NoCut:
            return self.whole([text])[0]


def _sections(text: str):
    """A long text in sections, each cut before a blank that follows no white space."""
    begin = 0
    while len(text) - begin > SECTION:
        cut = begin + SECTION
        while cut < len(text) and (text[cut] not in " \n" or text[cut - 1].isspace()):
            cut += 1
        yield text[begin:cut]
        begin = cut
    if begin < len(text) or not text:
        yield text[begin:]


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """The process's encoder for a vocabulary file."""
    return Encoder(path)
