"""Token ids of the public byte-level BPE vocabulary.

The ids are those of the ``tokenizers`` library for ``byte_bpe_50k.json``.
Texts that hold only common characters (ASCII and Latin letters, on which all
Unicode versions agree) are encoded from the same vocabulary's rank file with
``tiktoken``, several times as fast and equal there (tested); all others go
through ``tokenizers`` itself.  Special strings inside a text get their special
id, as that library does by default.
"""

from __future__ import annotations

import base64
import re
from array import array
from functools import lru_cache

import numpy as np

#: Characters whose class is the same in every Unicode version: tab, newlines,
#: printable ASCII and the Latin letters with their signs.
COMMON = re.compile("[\t\n\r\x20-\x7e¡-ſ]*")

BETWEEN = re.compile(r"(?<=\S) (?=\S)")
#: Characters that are encoded at once.
LONG = 1 << 20


class ByteIds:
    def __init__(self, json_path: str | None = None, rank_path: str | None = None):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(json_path or public_tokenizers.path("byte_bpe_50k.json"))
        self.exact.no_truncation()
        self.exact.no_padding()
        with open(rank_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, f)}
        special = {t.content: i for i, t in self.exact.get_added_tokens_decoder().items()}
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.fast = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                      special_tokens={})

    def packed(self, text: str) -> bytes:
        """The ids as little-endian unsigned 16-bit numbers."""
        if not COMMON.fullmatch(text) or (self.special and self.special.search(text)):
            return array("H", self.exact.encode(text, add_special_tokens=False).ids).tobytes()
        if len(text) < LONG:
            return array("H", self.fast.encode_ordinary(text)).tobytes()
        # The vocabulary's pattern starts a piece at a single space between two
        # words, so a long text may be cut there.
        out, at = [], 0
        while at < len(text):
            cut = BETWEEN.search(text, at + LONG)
            end = cut.start() if cut else len(text)
            out.append(array("H", self.fast.encode_ordinary(text[at:end])).tobytes())
            at = end
        return b"".join(out)

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.packed(text), np.uint16)


@lru_cache(maxsize=1)
def byte_ids() -> ByteIds:
    """The encoder of this worker."""
    return ByteIds()
