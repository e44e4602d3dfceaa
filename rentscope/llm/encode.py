"""Token ids of whole texts, word by word, for the word-end BPE tokenizer.

Its vocabulary drops white space, so no token crosses a space and a text's ids
are those of its space-separated words in order.  A worker keeps the ids of the
words it has met (bounded caches); a new word is normalised, cut into pieces,
and each new piece is merged by the tokenizer's model.  ``tests/llm`` compares
the result with the tokenizer's own encoding of whole texts.
"""

from __future__ import annotations

import re
import struct

CACHE_WORDS = 500_000   # words of a cache generation; two generations are kept
END_ID = 1
# Words of printable ASCII and Latin letters are normalised and cut here; all
# others by the tokenizer's own normaliser and pre-tokenizer.
_PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]*").fullmatch
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u017f]+|[0-9]"
                     "|[^a-z0-9\u00df-\u00f6\u00f8-\u017f]+").findall


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE writes a byte that has no visible Latin-1 character as
    the next letter from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(256 + k) for k, b in enumerate(hidden)}


_LETTERS = _byte_letters()


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Memory(dict):
    """A dictionary that works out missing values and, once full, starts anew
    beside its previous generation."""

    def __init__(self) -> None:
        super().__init__()
        self.older: dict = {}

    def __missing__(self, key: str) -> bytes:
        found = self.older.get(key)
        if found is None:
            found = self.work_out(key)
        self[key] = found
        return found

    def bound(self) -> None:
        if len(self) > CACHE_WORDS:
            self.older = dict(self)
            self.clear()


class _Pieces(_Memory):
    """Byte-level piece -> ids."""

    def __init__(self, model):
        super().__init__()
        self.tokenize = model.tokenize

    def work_out(self, piece: str) -> bytes:
        return _packed([t.id for t in self.tokenize(piece)])


class _Words(_Memory):
    """Word (no space, no line feed) -> ids."""

    def __init__(self, tok):
        super().__init__()
        self.tok = tok
        self.pieces = _Pieces(tok.model)
        self.marks = [t.content for t in tok.get_added_tokens_decoder().values()]

    def work_out(self, word: str) -> bytes:
        if "<|" in word and any(m in word for m in self.marks):  # spelled-out special tokens
            return _packed(self.tok.encode(word, add_special_tokens=False).ids)
        if word.isascii() and word.isprintable() or _PLAIN(word):
            low = word.lower()
            parts = [low] if low.isalpha() else _PIECES(low)
            if not low.isascii():
                parts = [p.encode().decode("latin-1").translate(_LETTERS) for p in parts]
        else:
            plain = self.tok.normalizer.normalize_str(word)
            parts = [p for p, _ in self.tok.pre_tokenizer.pre_tokenize_str(plain)]
        return b"".join(map(self.pieces.__getitem__, parts))


class WordEncoder:
    """ids of texts as little-endian unsigned 32-bit bytes."""

    _held: dict[str, WordEncoder] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.words = _Words(Tokenizer.from_file(path))

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        """One encoder per worker process and tokenizer file."""
        if path not in cls._held:
            cls._held[path] = cls(path)
        return cls._held[path]

    def encode(self, text: str | None) -> bytes:
        """The ids of a text, in order; null is empty."""
        if not text:
            return b""
        self.words.bound()
        self.words.pieces.bound()
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))
