"""Exact token counts at every prefix of a text, by dynamic programming over its pretokens.

Within a pretoken, the encoding of the first ``j`` bytes ends in one token ``t``, and what precedes it is the encoding
of the first ``j - len(t)`` bytes; ``t`` is the only ending that stays apart from the token before it.  So one sweep
fills last token and count for every prefix, each entry from an earlier one, and no prefix is encoded on its own.  The
counts at the ends of pretokens add up, which gives the count at every prefix of the whole text.

Null texts count as empty and have 0 tokens.  Repeated ids or rows are counted each by itself; other columns may hold
nulls or any names.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from siftwork.llm.common import slices, text_of
from siftwork.llm.tokens import ByteTokenizer, byte_tokenizer, tokenizer_path

MEMORY = 400_000
SPACES = re.compile(r"\s+\Z")
# A contraction cut short is an apostrophe and a letter of its own.
CUT_SHORT = {"'re", "'ve", "'ll"}


class PrefixTable:
    """Token counts of all prefixes of pretokens, kept per worker; the memory is bounded and refilled at need."""

    def __init__(self, tokenizer: ByteTokenizer):
        import ahocorasick

        self.tokenizer = tokenizer
        vocab = tokenizer.library.get_vocab(with_added_tokens=False)
        self.letters = {i: word for word, i in vocab.items()}
        self.size = max(self.letters, default=0) + 1
        # Finds all vocabulary entries that end at each byte, longest first.
        self.endings = ahocorasick.Automaton()
        for word, i in vocab.items():
            self.endings.add_word(word, (i, len(word)))
        self.endings.make_automaton()
        self._apart: dict[int, bool] = {}
        self._counts: dict[str, tuple[int, ...]] = {}
        self._totals: dict[str, int] = {}

    def _stays_apart(self, before: int, token: int) -> bool:
        if len(self._apart) >= 4 * MEMORY:
            self._apart.clear()
        both = self.tokenizer.library.model.tokenize(self.letters[before] + self.letters[token])
        known = self._apart[before * self.size + token] = len(both) == 2 and both[0].id == before
        return known

    def _fill(self, piece: str) -> list[int]:
        word = self.tokenizer.letters(piece)
        last, count, size, apart = [0], [0], self.size, self._apart
        filled = 0
        for end, (token, length) in self.endings.iter(word):
            if end < filled:
                continue
            start = end + 1 - length
            if start:
                known = apart.get(last[start] * size + token)
                if known is None:
                    known = self._stays_apart(last[start], token)
                if not known:
                    continue
            last.append(token)
            count.append(count[start] + 1)
            filled += 1
        return count

    def counts(self, piece: str) -> tuple[int, ...]:
        """Tokens of the first 0, 1, ... bytes of a pretoken."""
        found = self._counts.get(piece)
        if found is None:
            if len(self._counts) >= MEMORY // 8:
                self._counts.clear()
            found = self._counts[piece] = tuple(self._fill(piece))
        return found

    def total(self, piece: str) -> int:
        """Tokens of a whole pretoken: the last entry of its table."""
        found = self._totals.get(piece)
        if found is None:
            if len(self._totals) >= MEMORY:
                self._totals.clear()
            found = self._totals[piece] = self._fill(piece)[-1]
        return found

    def tokens(self, text: str) -> int:
        """Tokens of a whole text: the sum of the tables' ends, a special string counting one."""
        known, n = self._totals, 0
        for part, special in self.tokenizer.segments(text):
            if special:
                n += 1
            else:
                n += sum([known.get(p) or self.total(p) for p in self.tokenizer.pieces(part)])
        return n

    def prefixes(self, text: str) -> np.ndarray:
        """Tokens of the first 0, 1, ... characters of a text, each as if the text ended there."""
        out, done = [0], 0
        for part, special in self.tokenizer.segments(text):
            if special:
                # Within a special string the prefix holds ordinary text, which no table of a later text covers.
                start = len(out) - 1
                out.extend(len(self.tokenizer.ids(text[: start + k])) for k in range(1, len(part)))
                done += 1
                out.append(done)
                continue
            space_from, space_base = None, 0
            for piece in self.tokenizer.pieces(part):
                table, at = self.counts(piece), 0
                start = len(out) - 1
                for k, character in enumerate(piece, 1):
                    at += len(character.encode("utf-8"))
                    if character.isspace() and not "\x1c" <= character <= "\x1f":
                        # White space at the end of a text is one pretoken, however it is cut in the middle.
                        if space_from is None:
                            space_from, space_base = start + k - 1, out[-1]
                        out.append(space_base + self.counts(text[space_from : start + k])[-1])
                        continue
                    space_from = None
                    n = table[at]
                    if k == 2 and piece in CUT_SHORT:
                        n = self.counts("'")[-1] + self.counts(piece[1])[-1]
                    out.append(done + n)
                done += table[-1]
        return np.array(out, np.int32)


@lru_cache(maxsize=2)
def _table(path: str) -> PrefixTable:
    return PrefixTable(byte_tokenizer(path))


@lru_cache(maxsize=2)
def _pieces_model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def _counts(texts: list[str], path: str) -> list[int]:
    if path.endswith(".model"):
        return [len(x) for x in _pieces_model(path).encode(texts, num_threads=1)]
    tokenizer = byte_tokenizer(path)
    if not tokenizer.by_piece:
        return [len(tokenizer.ids(x)) for x in texts]
    table = _table(path)
    return [table.tokens(x) for x in texts]


def token_counts(
    df: DataFrame, *, key: str = "doc_id", text: str = "text", tokenizer: str = "byte_bpe_50k.json", limit: int = 1024
) -> DataFrame:
    """Per row: key, bytes, tokens, and whether the tokens exceed ``limit``.

    ``tokenizer`` is an absolute path, or the name of a public file that every worker has.  The tables serve byte-level
    BPE files; other kinds of files have no such recurrence and are counted by their library.  One pass, no shuffle.
    """

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path = tokenizer_path(tokenizer)
        for frame in slices(frames, "body"):
            yield pd.DataFrame({"id": frame["id"], "bytes": frame["bytes"], "tokens": _counts(frame["body"].tolist(), path)})

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(f"`{key}`").alias("id"), F.octet_length(text_of(text)).cast("long").alias("bytes"), text_of(text).alias("body"))
    return rows.mapInPandas(count, f"id {kind}, bytes long, tokens long").select(
        F.col("id").alias(key),
        F.col("bytes").alias("n_bytes"),
        F.col("tokens").alias("n_tokens"),
        (F.col("tokens") > limit).alias("over_limit"),
    )


def prefix_tables(df: DataFrame, *, key: str = "doc_id", text: str = "text", tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    """Per row: key and ``prefix_tokens``, the exact count at every prefix (entry p: of the first p characters).

    For byte-level BPE files only; the others raise ``ValueError`` in the task.
    """

    def fill(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path = tokenizer_path(tokenizer)
        if not byte_tokenizer(path).by_piece:
            raise ValueError("prefix tables need a byte-level BPE file")
        for frame in slices(frames, "body", 500_000):
            yield pd.DataFrame({"id": frame["id"], "prefix_tokens": [_table(path).prefixes(x) for x in frame["body"]]})

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(f"`{key}`").alias("id"), text_of(text).alias("body"))
    return rows.mapInPandas(fill, f"id {kind}, prefix_tokens array<int>").withColumnRenamed("id", key)


def longest_within(tables: DataFrame, budget: int, column: str = "prefix_tokens") -> DataFrame:
    """Adds ``fitting_chars``: characters of the longest prefix whose count is within ``budget``, from the tables alone."""
    last = f"array_max(transform(`{column}`, (n, p) -> IF(n <= {int(budget)}, p, 0)))"
    return tables.withColumn("fitting_chars", F.coalesce(F.expr(last), F.lit(0)))
