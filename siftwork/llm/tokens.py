"""Token ids of whole texts, equal to what the ``tokenizers`` library gives.

A byte-level BPE file splits a text into pretokens and merges bytes within each.  ``tiktoken`` does the same several
times faster, with the file's own vocabulary as ranks.  It is used only if the merges come in the order of their ids and
every entry of the vocabulary encodes to itself, for then both merge alike.  Texts with characters that the libraries'
Unicode tables could class differently, and files of other kinds, go through ``tokenizers`` itself.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

# The splitting patterns and the byte alphabet of byte-level BPE.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]

# Outside these ranges, and for the digits and spaces left out of them, the library does the splitting.
UNSAFE = re.compile("[^\\x00-\\x1b\\x20-\\x84\\x86-\\xb1\\xb4-\\xb8\\xba\\xbb\\xbf-\\u024f\\u2010-\\u2027\\u2030-\\u205e]")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the vocabulary."""
    rest = iter(range(256, 512))
    kept = set(PRINTABLE)
    return {b: chr(b) if b in kept else chr(next(rest)) for b in range(256)}


class ByteTokenizer:
    """Ids for a ``tokenizers`` file; ``by_piece`` says whether it is byte-level BPE of the plain kind."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        before = spec.get("pre_tokenizer") or {}
        model = spec.get("model") or {}
        added = spec.get("added_tokens") or []
        self.by_piece = (
            before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and spec.get("normalizer") is None
            and model.get("type") == "BPE"
            and not model.get("dropout")
            and not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added)
        )
        self.size = self.library.get_vocab_size()
        self.specials = {t["content"]: t["id"] for t in added}
        found = "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True)))
        self._cut = re.compile(f"({found})") if found else None
        self._letters = byte_letters()
        self._fast = self._ranks(model) if self.by_piece else None

    def _ranks(self, model: dict):
        """A ``tiktoken`` encoding of the same vocabulary, or nothing if it could differ."""
        import tiktoken

        vocab, merges = model["vocab"], [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        made = [vocab[a + b] for a, b in merges]
        if any(x >= y for x, y in zip(made, made[1:])) or len(merges) + 256 != len(vocab):
            return None
        if any(len(self.library.model.tokenize(word)) != 1 for word in vocab):
            return None
        byte = {letter: b for b, letter in self._letters.items()}
        ranks = {bytes(byte[c] for c in word): i for word, i in vocab.items()}
        return tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def letters(self, piece: str) -> str:
        return piece.encode("utf-8").decode("latin-1").translate(self._letters)

    def segments(self, text: str) -> list[tuple[str, bool]]:
        """The text cut at special strings; true marks a special one."""
        if self._cut is None or not self._cut.search(text):
            return [(text, False)] if text else []
        return [(s, i % 2 == 1) for i, s in enumerate(self._cut.split(text)) if s]

    def pieces(self, text: str) -> list[str]:
        """Pretokens of a text without special strings."""
        if not UNSAFE.search(text):
            return PIECES.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def ids(self, text: str) -> np.ndarray:
        """Ids of the whole text as unsigned 32-bit numbers, special strings as the library takes them by default."""
        if self._fast is None or UNSAFE.search(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")
        parts = [
            np.array([self.specials[part]], "<u4") if special else self._fast.encode_to_numpy(part, disallowed_special=())
            for part, special in self.segments(text)
        ]
        return (parts[0] if len(parts) == 1 else np.concatenate(parts or [np.empty(0, "<u4")])).astype("<u4", copy=False)


@lru_cache(maxsize=4)
def byte_tokenizer(path: str) -> ByteTokenizer:
    """One per worker process and file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return ByteTokenizer(path)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """The file's place on the machine that asks; to be called inside tasks, where the file is read."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)
