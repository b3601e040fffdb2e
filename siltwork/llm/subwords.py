"""Subword ids of whole texts, word by word.

Tokens of the tokenizer used here never span white space, so a text's ids are
those of its words in turn. Words repeat, so their ids are kept: up to ``MOST_BYTES``
in a process, its own bookkeeping included, after which it starts anew.
"""

from __future__ import annotations

import codecs
import string
import sys
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
MOST_BYTES = 160_000_000
#: What a word takes besides its letters and ids: two byte strings and a place in a table.
_ENTRY = 190
_MARKS = string.punctuation
_AFTER_LATIN = "\u0250"
# Byte-level tokens write a byte as the Latin-1 character of its number where that
# is printable, and the others, in order, as the characters from 256 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_OTHERS = [b for b in range(256) if b not in _PRINTABLE]
_SPELLED = "".join(chr(b if b in _PRINTABLE else 256 + _OTHERS.index(b)) for b in range(256))


class _Known(dict):
    """Ids of words; a word not seen yet is encoded when it is looked up."""

    def __init__(self, encode: Callable[[bytes | str], bytes], most_bytes: int):
        super().__init__()
        self._encode = encode
        self._most = most_bytes
        self._held = 0

    def __missing__(self, word: bytes | str) -> bytes:
        ids = self._encode(word)
        self._held += _ENTRY + len(word) + len(ids)
        if self._held > self._most:
            self.clear()
            self._held = 0
        self[word] = ids
        return ids


def _packed(ids: list[int]) -> bytes:
    made = array("I", ids)
    if sys.byteorder == "big":
        made.byteswap()
    return made.tobytes()


def _folded(text: bytes) -> bytes:
    """``text`` with A-Z in lower case, where that cannot change its ids.

    The normalizer composes marks before it lower-cases, and some letters, as j with a
    caron, are composed in lower case only; marks from U+0300 on begin with this byte.
    The tokenizer's own tokens, as ``<|endoftext|>``, are looked for before that.
    """
    return text if b"\xcc" in text or b"<|" in text else text.lower()


class Subwords:
    """Ids of texts by the tokenizer in the file at ``path``, as little-endian uint32."""

    def __init__(self, path: str = TOKENIZER):
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        self._model = self.tokenizer.model
        self._known = _Known(self._ids, MOST_BYTES * 3 // 4)
        # Words of letters are met with many marks after them, so they have their own table.
        self._plain = _Known(self._letters, MOST_BYTES // 4)
        self._marks = _Known(self._alone, MOST_BYTES // 64)

    def ends(self) -> np.ndarray:
        """For each id 1 if it ends a word, else 0."""
        found = np.zeros(self.size, dtype=np.int64)
        for token, number in self.tokenizer.get_vocab().items():
            found[number] = token.endswith("</w>")
        return found

    def _alone(self, word: str) -> bytes:
        return _packed(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def _letters(self, word: str) -> bytes:
        """Ids of a word of Latin letters, which its normalizer only lower-cases."""
        spelled = word.lower()
        if not spelled.isascii():
            spelled = codecs.charmap_decode(spelled.encode(), "strict", _SPELLED)[0]
        return _packed([token.id for token in self._model.tokenize(spelled)])

    def _ids(self, word: bytes) -> bytes:
        """Ids of one word; letters and the ASCII marks after them never share a token."""
        text = word.decode()
        core = text.rstrip(_MARKS)
        if not core.isalpha():
            return self._alone(text)
        if not core.isascii() and (max(core) >= _AFTER_LATIN or "\u0130" in core):
            return self._alone(text)
        marks = text[len(core) :]
        return self._plain[core] + self._marks[marks] if marks else self._plain[core]

    def words(self, texts: list[str | None]) -> list[list[bytes]]:
        """Per text, the ids of its words; None counts as empty."""
        of = self._known.__getitem__
        return [list(map(of, _folded((text or "").encode("utf-8", "replace")).split())) for text in texts]

    def distinct(self, words: list[bytes]) -> list[bytes]:
        """Ids of words that are asked for once, so that whole words are not kept."""
        return [self._ids(_folded(word)) for word in words]

    def ids(self, texts: list[str | None]) -> list[np.ndarray]:
        """Per text, its ids."""
        return [np.frombuffer(b"".join(words), dtype="<u4") for words in self.words(texts)]


_made: dict[str, Subwords] = {}


def subwords(path: str = TOKENIZER) -> Subwords:
    """The tokenizer of this process for ``path``; tasks of a process share it."""
    if path not in _made:
        _made[path] = Subwords(path)
    return _made[path]


def small_slices(batches, text: str, chars: int = 1_000_000) -> Iterator:
    """Slices of Arrow batches with about ``chars`` bytes of text, a row at least."""
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for row, size in enumerate(sizes.tolist()):
            if total + size > chars and row > start:
                yield batch.slice(start, row - start)
                start, total = row, 0
            total += size
        if batch.num_rows > start:
            yield batch.slice(start)
