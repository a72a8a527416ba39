"""Token ids of a byte-level BPE file, exact, at the speed of a merge-only encoder.

The ids are those of the ``tokenizers`` library.  For texts in common letters the
same vocabulary and merges run in the leaner encoder of ``tiktoken``, built from
the same file.  Other characters could be split otherwise by the two libraries'
Unicode tables, so a text with any of them goes to ``tokenizers`` as a whole.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np

# Fixed value: the split that byte-level files of this kind apply before the merges.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# ASCII, Latin letters, general punctuation without its spaces, the euro sign.
NOT_PLAIN = re.compile("[^\t\n\r -~À-ɏ‐-‧€]")


class ByteBpe:
    """Ids of texts by one tokenizer file of the ``tokenizers`` library."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        alphabet = _byte_alphabet()
        ranks = {
            bytes(alphabet[c] for c in token): i
            for token, i in spec["model"]["vocab"].items()
            if token not in self.special
        }
        plain = tiktoken.Encoding("plain", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.plain = plain.encode_ordinary

    def ids(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids of a text; none for an empty or null one."""
        if not text:
            return b""
        if NOT_PLAIN.search(text) or any(s in text for s in self.special):
            ids = self.exact.encode(text, add_special_tokens=False).ids
        else:
            ids = self.plain(text)
        return np.asarray(ids, dtype="<u4").tobytes()


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


def default_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def _byte_alphabet() -> dict[str, int]:
    """Byte-level files write printable Latin-1 bytes as themselves, others from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
