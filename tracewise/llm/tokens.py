"""Byte-level BPE vocabularies: loading files, encoders per Python worker, pre-tokens.

Paths are parameters; files are read on the driver and shipped as one broadcast of
fixed size (a vocabulary), since executors need not have the driver's files.
"""

from __future__ import annotations

import base64
import functools
import json
import re
import unicodedata

def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> id of a rank file (one base64 token and its id per line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: character -> byte."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    out = {chr(b): b for b in shown}
    hidden = [b for b in range(256) if b not in set(shown)]
    return out | {chr(256 + i): b for i, b in enumerate(hidden)}


def read_json_vocabulary(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Token bytes -> id, and special strings -> id, of a byte-level BPE json file.

    The file's merges must be listed in the order of the ids they make, so that the
    id is the merge's rank; otherwise ValueError.
    """
    with open(path, encoding="utf-8") as f:
        whole = json.load(f)
    alphabet, vocab = byte_alphabet(), whole["model"]["vocab"]
    special = {t["content"]: t["id"] for t in whole["added_tokens"]}
    made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in whole["model"]["merges"]]
    if made != sorted(made):
        raise ValueError("merges are not in the order of their ids")
    return {bytes(alphabet[c] for c in t): i for t, i in vocab.items() if t not in special}, special


USUAL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def latin_pattern() -> re.Pattern:
    """USUAL_PATTERN with its classes listed for the Latin-1 characters."""
    kinds = {chr(i): unicodedata.category(chr(i))[0] for i in range(256)}
    letters, numbers = ("".join(c for c in kinds if kinds[c] == k) for k in "LN")
    blank = "".join(c for c in kinds if c.isspace() and not "\x1c" <= c <= "\x1f")
    out = USUAL_PATTERN.replace(r"[^\s\p{L}\p{N}]", f"[^{blank}{letters}{numbers}]").replace(r"\p{L}", f"[{letters}]")
    return re.compile(out.replace(r"\p{N}", f"[{numbers}]").replace(r"\S", f"[^{blank}]").replace(r"\s", f"[{blank}]"))


class Vocabulary:
    """What tasks need of a vocabulary; the encoder is built once in each Python worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, special: dict[str, int] | None = None):
        self.ranks, self.pattern, self.special = ranks, pattern, special or {}

    def __getstate__(self):
        return {"ranks": self.ranks, "pattern": self.pattern, "special": self.special}

    @functools.cached_property
    def encoder(self):
        import tiktoken
        return tiktoken.Encoding("given", pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens=self.special)

    @functools.cached_property
    def splitter(self):
        """Pre-tokens of a text as a list.

        The library's pattern is run by ``regex``. For its usual form, texts of
        Latin-1 characters alone go through ``re``, whose classes are written out for
        those 256 characters; that is twice as fast and gives the same pieces.
        """
        import regex
        every = regex.compile(self.pattern).findall
        if self.pattern != USUAL_PATTERN:
            return every
        latin = latin_pattern().findall

        def split(text: str) -> list[str]:
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return every(text)
            return latin(text)

        return split

    @functools.cached_property
    def decimals(self) -> dict[int, bytes]:
        return {i: b"%d" % i for i in self.token_bytes}

    @functools.cached_property
    def token_bytes(self) -> dict[int, bytes]:
        return {i: t for t, i in self.ranks.items()} | {i: s.encode() for s, i in self.special.items()}


def json_vocabulary(path: str | None = None, pattern: str | None = None) -> Vocabulary:
    """Byte-level BPE of a json file, special strings in a text being special tokens."""
    import public_tokenizers
    ranks, special = read_json_vocabulary(path or public_tokenizers.path("byte_bpe_50k.json"))
    return Vocabulary(ranks, pattern or public_tokenizers.PATTERN, special)


def rank_vocabulary(path: str | None = None, pattern: str | None = None) -> Vocabulary:
    """Byte-level BPE of a rank file, without special tokens."""
    import public_tokenizers
    return Vocabulary(read_ranks(path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")),
                      pattern or public_tokenizers.PATTERN)
