"""Ids of a public byte-level BPE vocabulary, one bounded cache of words per task.

The pre-tokeniser of this vocabulary never joins characters across a place
where a non-space is followed by white space, and a single space goes to the
word after it. So a text whose lines are words with single spaces between
them can be encoded word by word (`` word``, or ``word`` at the start of a
line, and a newline id between lines); any other text is encoded as a whole.
"""

from __future__ import annotations

import base64
import json
import re

import numpy as np

CACHE_WORDS = 300_000     # cached words per task and kind: about 60 MB


def load_encoding(path: str | None = None):
    """A ``tiktoken`` encoding of the rank file (default: ``byte_bpe_50k.tiktoken``)."""
    import public_tokenizers
    import tiktoken

    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


def added_tokens(path: str | None = None) -> dict[str, int]:
    """Added tokens of a ``tokenizers`` file (default: ``byte_bpe_50k.json``) and their ids."""
    import public_tokenizers

    with open(path or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}


class _Cache(dict):
    def __init__(self, encode, prefix: str, limit: int):
        super().__init__()
        self._encode, self._prefix, self._limit = encode, prefix, limit

    def __missing__(self, word: str) -> bytes:
        ids = np.array(self._encode(self._prefix + word), "<u4").tobytes()
        if len(self) < self._limit:
            self[word] = ids
        return ids


class Encoder:
    """Whole texts to ids as little-endian unsigned 32-bit integers.

    ``added``: strings that are a token of their own wherever they stand in a text (none: all is plain text).
    """

    def __init__(self, path: str | None = None, cache_words: int = CACHE_WORDS, added: dict[str, int] | None = None):
        self._added = {s: np.array([i], "<u4").tobytes() for s, i in (added or {}).items()}
        longest = sorted(self._added, key=len, reverse=True)
        self._apart = re.compile(f"({'|'.join(map(re.escape, longest))})") if longest else None
        self._encode = load_encoding(path).encode_ordinary
        self._inner = _Cache(self._encode, " ", cache_words)
        self._first = _Cache(self._encode, "", cache_words // 10)
        self._newline = np.array(self._encode("\n"), "<u4").tobytes()

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self._apart and self._apart.search(text):
            return b"".join(self._added.get(part) or self._plain(part) for part in self._apart.split(text))
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        if not text:
            return b""
        lines = text.split("\n")
        parts: list[bytes] = []
        for i, line in enumerate(lines):
            found = line.split(" ")
            # Irregular white space: an empty word, or one that starts or
            # ends with a space character of another kind.
            if not all(found) or line.strip() != line or any(
                    w[0].isspace() or w[-1].isspace() for w in found if not (w[0].isascii() and w[-1].isascii())
                    or w[0] < "!" or w[-1] < "!"):
                return np.array(self._encode(text), "<u4").tobytes()
            if i:
                parts.append(self._newline)
            parts.append(self._first[found[0]])
            parts.extend(map(self._inner.__getitem__, found[1:]))
        return b"".join(parts)
