"""Encoding of whole texts by cached parts, and the ``tokenizers`` library.

A byte-level BPE pre-tokenizer starts a new piece at every run of white
space, so a text cut before each run encodes to the joined encodings of its
parts. Parts repeat, and a bounded cache keeps their encodings per worker.
"""

from __future__ import annotations

import base64
import os
import re
import sys
from array import array

CACHE_PARTS = 600_000
CACHE_CHARS = 48
_PARTS = re.compile(r"\s*\S+|\s+")
# white space for Python but not for the tokenizer: such texts are not cut
_ODD = re.compile("[\x1c-\x1f]")


class NotCut(Exception):
    """The text has white space that single blanks do not describe."""


class PartCache(dict):
    """part -> ``pack(ids of " " + part)``, computed when first asked for."""

    def __init__(self, encode, pack):
        super().__init__()
        self.encode, self.pack = encode, pack
        self.first: dict = {}

    def whole(self, text: str):
        """``pack`` of a part as it stands (no blank before it)."""
        return self.pack(self.encode(text))

    def __missing__(self, part: str):
        if not part or part[0].isspace() or part[-1].isspace() or _ODD.search(part):
            raise NotCut
        value = self.whole(" " + part)
        if len(part) <= CACHE_CHARS:
            if len(self) >= CACHE_PARTS:
                self.clear()
            self[part] = value
        return value

    def _first(self, part: str):
        value = self.first.get(part)
        if value is None:
            if not part or part[-1].isspace():
                raise NotCut
            value = self.whole(part)
            if len(part) <= CACHE_CHARS:
                if len(self.first) >= CACHE_PARTS // 10:
                    self.first.clear()
                self.first[part] = value
        return value

    def parts(self, text: str) -> list:
        """Packed encodings of consecutive parts of ``text``."""
        if not text:
            return []
        if _ODD.search(text):
            return [self.whole(text)]
        try:
            head, *rest = text.split(" ")
            return [self._first(head), *map(self.__getitem__, rest)]
        except NotCut:
            return [self.whole(p) for p in _PARTS.findall(text)]


def little_endian(ids) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


_loaded: dict = {}


def tokenizer(path: str):
    """The tokenizer file, loaded once per worker; without truncation or padding."""
    if path not in _loaded:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        _loaded[path] = tok
    return _loaded[path]


def part_cache(path: str, pack) -> PartCache:
    """Parts encoded by the tokenizer file at ``path``."""
    key = (path, pack)
    if key not in _loaded:
        tok = tokenizer(path)
        _loaded[key] = PartCache(lambda text: tok.encode(text, add_special_tokens=False).ids, pack)
    return _loaded[key]


# up to here both libraries agree on which characters are letters, digits and white space
_FAR = re.compile("[^\x00-\u024f]")


def fast_ids(path: str, ranks_path: str, pattern: str):
    """A function text -> ids of the tokenizer file as a numpy array. The same
    vocabulary as ranks is encoded several times faster; texts with characters
    beyond Latin letters go to the tokenizer file itself."""
    key = (path, ranks_path, pattern)
    if key not in _loaded:
        import numpy as np
        import tiktoken

        tok = tokenizer(path)
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
        special = {t.content: i for i, t in tok.get_added_tokens_decoder().items()}
        same = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)

        def ids(text: str):
            if text.isascii() or not _FAR.search(text):
                return same.encode_to_numpy(text, allowed_special="all")
            return np.asarray(tok.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

        _loaded[key] = ids
    return _loaded[key]
