"""Token ids of whole texts by the tokenizers library, with a cache of what was encoded.

A byte-level splitter never joins white space to a character before it, so a text can be cut in front of every space or
line break that follows another character, and the parts encoded alone. Parts repeat a lot; each worker keeps the ids
of about CACHE_PARTS of them. A word of Latin letters is one piece for the splitter and goes straight to the
library's BPE model. With any other kind of tokenizer, texts are encoded whole.

An encoder with ``added`` set reads the strings of added tokens (``<|endoftext|>``) as those tokens, as the library does by
itself; a text that holds one is encoded whole. Without it they are ordinary text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from struct import pack

import numpy as np

CACHE_PARTS = 2_000_000  # about 300 MB a worker
_SPACE_RUN = re.compile(r"[\s\x1c-\x1f] ")
_OTHER_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
# Latin letters, then ASCII marks: two pieces for the splitter.
_WORD_AND_MARKS = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-/:-@\[-`{-~]*)\Z")
# How byte-level models write bytes: visible Latin characters as they are, the others from 256 on.
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LETTERS = {b: 256 + k for k, b in enumerate(sorted(set(range(256)) - set(_VISIBLE)))}
_SPACE_LETTER = chr(_BYTE_LETTERS[32])


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids, as bytes."""

    def __init__(self, path: str, added: bool = False):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if added or not t.special]
        self.added = re.compile("|".join(map(re.escape, marks))) if marks else None
        self.model = self.tokenizer.model
        self.cache: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {"": b""}
        self.byte_level = (self.tokenizer.normalizer is None and type(self.tokenizer.pre_tokenizer).__name__ == "ByteLevel"
                           and type(self.model).__name__ == "BPE")
        self.line_break = self._whole("\n")

    def drop_cache(self) -> None:
        self.cache.clear()
        self.marks = {"": b""}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()

    @staticmethod
    def parts(text: str) -> list[str]:
        """The text cut in front of spaces; all parts but the first begin with the space that they lost."""
        cut = text.split(" ")
        if _SPACE_RUN.search(text) is None and cut[0]:
            return cut
        joined = [cut[0]]
        for part in cut[1:]:
            if joined[-1] and not joined[-1][-1].isspace():
                joined.append(part)
            else:
                joined[-1] += " " + part
        return joined

    def _encode_part(self, part: str, space: bool) -> bytes:
        """Ids of ``part``, with a space before it or not."""
        pieces = _WORD_AND_MARKS.match(part)
        if pieces is None:
            return self._whole(" " + part if space else part)
        letters, marks = pieces.groups()
        if marks not in self.marks:
            self.marks[marks] = self._whole(marks)
        known = self.cache.get(letters) if space and marks else None
        if known is not None:
            return known + self.marks[marks]
        if not letters.isascii():
            letters = letters.encode().decode("latin1").translate(_BYTE_LETTERS)
        tokens = self.model.tokenize(_SPACE_LETTER + letters if space else letters)
        return pack(f"<{len(tokens)}I", *[t.id for t in tokens]) + self.marks[marks]

    def _of(self, parts: list[str]) -> list[bytes]:
        """Ids of parts that lost the space before them; those that begin with a line break had none."""
        known = self.cache
        found = [known.get(p) for p in parts]
        if None in found:
            if len(known) > CACHE_PARTS:
                known.clear()
            for k, ids in enumerate(found):
                if ids is None:
                    part = parts[k]
                    ids = known.get(part)
                    if ids is None:
                        ids = known[part] = (self.line_break + self._encode_part(part[1:], False) if part[:1] == "\n"
                                             else self._encode_part(part, True))
                    found[k] = ids
        return found

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text; a null text has none."""
        for text in texts:
            if not text or not self.byte_level or self.added is not None and self.added.search(text):
                yield self._whole(text) if text else b""
                continue
            rest = text.replace("\n", " \n").split(" ")
            if "" not in rest and "\n" not in rest and not any(c in text for c in _OTHER_SPACES):
                # Words with one space or line break between them.
                first = rest.pop(0)
                yield self._encode_part(first, False) + b"".join(self._of(rest))
            else:
                first, *rest = self.parts(text)
                yield self._whole(first) + b"".join([
                    self._whole(" " + part) if part[:1] == "\n" else ids
                    for part, ids in zip(rest, self._of(rest), strict=True)])


@lru_cache(2)
def encoder(path: str, added: bool = False) -> Encoder:
    return Encoder(path, added)
