"""Language identification by unigram pieces, summed over all segmentations.

The vocabulary is a public one, given by its file; only its piece strings are used.  A word is a run of letters in lower
case, led by the mark of a word's beginning; a language gives every piece a probability, and a word the sum over all ways
to cut it into pieces of the product of theirs.  The forward algorithm computes it place by place.  A text's likelihood is
the product over its words, so every distinct word of a task is scored once, for all languages together.

Probabilities are learnt by expectation maximisation on the words of all documents with a known language outside the
held-out fold: Spark counts distinct words per language, each round sums the expected uses of pieces (forward and backward)
in one aggregate, and only a number per language and piece comes to the driver.  Expectations are rounded to millionths
per distinct word and summed as whole numbers, so a model doesn't depend on partitions or order.

Characters outside the vocabulary count as its unknown piece.  Null texts and texts without letters are ``und`` with score
0, as is everything when no document has a known language; empty training texts add nothing.  Null ids are never learnt
from.  Repeated ids or rows are each scored by their own text; ties between languages go to the first by name.  Long
runs of letters are scored as a whole, with rescaling.  An empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from siftwork.llm.common import slices, text_of
from siftwork.sources.shared import stage

FOLDS, HELD_OUT = 5, 0
RUN = re.compile(r"[^\W\d_]+")
BEGIN = "▁"
UNIT = 1_000_000
SHORT = 48  # longer runs are rescaled on the way, so that no probability vanishes
MEMORY = 400_000
CHUNK = 20_000


class Vocabulary:
    """Numbers of the pieces that words can hold, number 0 being the unknown character, and the same as a tree in arrays.

    The child of a node by a character's class is the slot ``base[node] + class``, if ``parent`` has the node there;
    ``piece`` is the number of the piece that ends at a slot, or -1.  So many words go down the tree in one step.
    """

    def __init__(self, pieces: dict[str, int]):
        self.pieces = pieces
        self.classes = np.zeros(0x110000, np.int32)
        letters = sorted({c for p in pieces for c in p})
        self.classes[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        children: dict[str, list[str]] = {}
        for head in sorted({p[:n] for p in pieces for n in range(1, len(p) + 1)}):
            children.setdefault(head[:-1], []).append(head)
        slots = 2 * sum(map(len, children.values())) + 2 * len(letters) + 2
        self.base, self.parent, self.piece = np.zeros(slots, np.int32), np.full(slots, -1, np.int32), np.full(slots, -1, np.int32)
        free = np.ones(slots, bool)
        free[0] = False
        slot, places = {"": 0}, {}
        room = slots - len(letters) - 1
        # Nodes with many children first, each at the first displacement at which all its slots are free.
        for node in sorted(children, key=lambda h: (-len(children[h]), h)):
            own = self.classes[[ord(h[-1]) for h in children[node]]]
            fits = free[own[0] : own[0] + room].copy()
            for c in own[1:]:
                fits &= free[c : c + room]
            start = int(np.argmax(fits))
            free[start + own] = False
            slot.update(zip(children[node], (start + own).tolist()))
            places[node] = start
        for node, heads in children.items():
            self.base[slot[node]] = places[node]
            for head in heads:
                self.parent[slot[head]] = slot[node]
                self.piece[slot[head]] = pieces.get(head, -1)

    @property
    def size(self) -> int:
        return len(self.pieces) + 1

    def spelt(self, words: list[str]) -> np.ndarray:
        """Classes of the characters of marked words of one length."""
        marked = np.array([BEGIN + w for w in words])
        return self.classes[marked.view(np.uint32).reshape(len(words), -1)]


@lru_cache(maxsize=2)
def vocabulary(name: str) -> Vocabulary:
    """The file's pieces in its order, lower case letters with or without the mark; read where it is needed."""
    import sentencepiece

    if not os.path.isabs(name):
        import public_tokenizers

        name = public_tokenizers.path(name)
    model = sentencepiece.SentencePieceProcessor(model_file=name)
    found: dict[str, int] = {}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        body = piece.removeprefix(BEGIN)
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)) and (not body or RUN.fullmatch(body)) and body == body.lower():
            found.setdefault(piece, len(found) + 1)
    return Vocabulary(found)


def runs_of(text: str | None) -> Counter:
    """The runs of letters and numerals of a text, in lower case."""
    return Counter(RUN.findall(text.lower())) if text else Counter()


def is_word(run: str) -> bool:
    """Runs of numerals alone aren't words."""
    return run.isascii() or any(map(str.isalpha, run))


def words_of(text: str | None) -> Counter:
    return Counter({w: n for w, n in runs_of(text).items() if is_word(w)})


def lattice(words: list[str], vocab: Vocabulary) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """All pieces that fit words of one length: (end, start, words, pieces), by end and start."""
    spelt = vocab.spelt(words)
    span = spelt.shape[1]
    out = []
    for start in range(span):
        at, node = np.arange(len(words)), np.zeros(len(words), np.int32)
        for end in range(start + 1, span + 1):
            slot = vocab.base[node] + spelt[at, end - 1]
            held = vocab.parent[slot] == node
            lost, at, node = at[~held], at[held], slot[held]
            piece = vocab.piece[node]
            known = piece >= 0
            if end == start + 1:
                # A character that isn't a piece is the unknown one.
                strange = np.concatenate([lost, at[~known]])
                if len(strange):
                    out.append((end, start, strange, np.zeros(len(strange), np.int32)))
            if not len(at):
                break
            if known.any():
                out.append((end, start, at[known], piece[known]))
    return sorted(out, key=lambda e: e[:2])


def forward(edges: list, words: int, length: int, weights: np.ndarray) -> np.ndarray:
    """Sums over all segmentations of the first places: (place, word, language); ``weights`` by piece and language."""
    alpha = np.zeros((length + 1, words, weights.shape[1]))
    alpha[0] = 1.0
    for end, start, w, p in edges:
        alpha[end, w] += alpha[start, w] * weights[p]
    return alpha


def long_word(word: str, vocab: Vocabulary, weights: np.ndarray) -> np.ndarray:
    """Log probability per language of one long run, with the sums rescaled at every place."""
    marked = BEGIN + word
    ahead: dict[int, np.ndarray] = {0: np.ones(weights.shape[1])}
    logs = np.zeros(weights.shape[1])
    for start in range(len(marked)):
        here = ahead.pop(start)
        # Everything ahead is relative to the sum at this place.
        logs += np.log(here)
        for k in ahead:
            ahead[k] = ahead[k] / here
        if marked[start] not in vocab.pieces:
            ahead[start + 1] = ahead.get(start + 1, 0) + weights[0]
        node = 0
        for end in range(start + 1, len(marked) + 1):
            slot = int(vocab.base[node] + vocab.classes[ord(marked[end - 1])])
            if vocab.parent[slot] != node:
                break
            node = slot
            if vocab.piece[node] >= 0:
                ahead[end] = ahead.get(end, 0) + weights[vocab.piece[node]]
    return logs + np.log(ahead[len(marked)])


def log_likelihoods(words: list[str], vocab: Vocabulary, weights: np.ndarray) -> np.ndarray:
    """Log probability of each word in each language."""
    out = np.empty((len(words), weights.shape[1]))
    by_length: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by_length.setdefault(len(w), []).append(i)
    for n, members in by_length.items():
        if n > SHORT:
            for i in members:
                out[i] = long_word(words[i], vocab, weights)
            continue
        for k in range(0, len(members), CHUNK):
            some = members[k : k + CHUNK]
            edges = lattice([words[i] for i in some], vocab)
            out[some] = np.log(forward(edges, len(some), n + 1, weights)[-1])
    return out


def expectations(words: list[str], times: np.ndarray, vocab: Vocabulary, weights: np.ndarray) -> np.ndarray:
    """Expected uses of every piece in the words of one language, in whole millionths; ``weights`` by piece."""
    out = np.zeros(vocab.size, np.int64)
    by_length: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        # Long runs are rare; for learning they are cut, for nothing is lost but the pieces across the cuts.
        for k in range(0, len(w), SHORT):
            by_length.setdefault(min(SHORT, len(w) - k), []).append((i, k))
    for n, members in by_length.items():
        for k in range(0, len(members), CHUNK):
            some = members[k : k + CHUNK]
            edges = lattice([words[i][s : s + n] for i, s in some], vocab)
            counts = times[[i for i, _ in some]]
            alpha = forward(edges, len(some), n + 1, weights[:, None])[:, :, 0]
            beta = np.zeros_like(alpha)
            beta[n + 1] = counts / alpha[n + 1]
            for end, start, w, p in sorted(edges, key=lambda e: (-e[1], -e[0])):
                beta[start, w] += beta[end, w] * weights[p]
            for end, start, w, p in edges:
                uses = np.rint(alpha[start, w] * weights[p] * beta[end, w] * UNIT).astype(np.int64)
                np.add.at(out, p, uses)
    return out


@dataclass(frozen=True)
class Model:
    """Languages in the order of their names, and weights by piece and language."""

    languages: list[str]
    weights: np.ndarray
    vocab: str

    def judge(self, texts: list[str | None], memory: Memory) -> tuple[list[str], list[float]]:
        """Best language and its posterior per text; ``memory`` keeps words met before."""
        names, scores = ["und"] * len(texts), [0.0] * len(texts)
        if not self.languages:
            return names, scores
        counted = [runs_of(t) for t in texts]
        memory.learn(counted, lambda words: log_likelihoods(words, vocabulary(self.vocab), self.weights))
        for i, found in enumerate(counted):
            # In the order of the text, so that sums don't depend on what else a task has read.
            at = np.fromiter(map(memory.places.__getitem__, found), np.int64, count=len(found))
            times = np.fromiter(found.values(), np.float64, count=len(found))[at > 0]
            if len(times):
                total = (memory.logs[at[at > 0]] * times[:, None]).sum(axis=0)
                best = int(np.argmax(total))
                names[i] = self.languages[best]
                scores[i] = min(1.0, 1.0 / float(np.exp(total - total[best]).sum()))
        return names, scores


class Memory:
    """Log probabilities of words met before; place 0 is for runs that aren't words."""

    def __init__(self, languages: int):
        self.places: dict[str, int] = {}
        self.logs, self.size = np.zeros((1, languages)), 1

    def learn(self, counted: list[Counter], judge) -> None:
        if self.size > MEMORY:
            self.places.clear()
            self.size = 1
        new = list(dict.fromkeys(w for found in counted for w in found if w not in self.places))
        words = [w for w in new if is_word(w)]
        self.places.update(dict.fromkeys(new, 0))
        if not words:
            return
        self.places.update(zip(words, range(self.size, self.size + len(words))))
        need = self.size + len(words)
        if need > len(self.logs):
            self.logs = np.concatenate([self.logs, np.zeros((max(need, 2 * len(self.logs)) - len(self.logs), self.logs.shape[1]))])
        self.logs[self.size : need] = judge(words)
        self.size = need


def fold_of(key: str):
    """crc32 of the id as text, by the number of folds; row held out where it is 0."""
    return F.crc32(F.col(f"`{key}`").cast("string").cast("binary")) % FOLDS


def training_words(df: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """Distinct words per language with their number, over all documents that may be learnt from."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[str, Counter] = {}

        def rows() -> pd.DataFrame:
            out = pd.concat([pd.DataFrame({"lang": k, "word": list(c), "times": list(c.values())}) for k, c in found.items()])
            found.clear()
            return out

        for frame in slices(frames, "body"):
            for name, bodies in frame.groupby("lang")["body"]:
                own = found.setdefault(name, Counter())
                for body in bodies:
                    own.update(words_of(body))
            if sum(map(len, found.values())) > MEMORY:
                yield rows()
        if found:
            yield rows()

    known = df.where(F.col(f"`{lang}`").isNotNull() & F.col(f"`{key}`").isNotNull() & (fold_of(key) != HELD_OUT))
    rows = known.select(F.col(f"`{lang}`").cast("string").alias("lang"), text_of(text).alias("body"))
    return rows.mapInPandas(count, "lang string, word string, times long").groupBy("lang", "word").agg(F.sum("times").alias("times"))


def fit(
    df: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", vocab: str = "piece_bpe_32k.model", rounds: int = 3, smoothing: float = 0.1
) -> Model:
    """Learns the pieces' probabilities per language; ``smoothing`` is added to every piece's expected uses."""
    words = stage(training_words(df, key, text, lang), "language-words")
    languages = sorted(r["lang"] for r in words.select("lang").distinct().collect())
    size = vocabulary(vocab).size
    # Short pieces start out likelier, as in a text of independent characters.
    start = np.full(size, 1e-6)
    for piece, i in vocabulary(vocab).pieces.items():
        start[i] = 30.0 ** -len(piece.removeprefix(BEGIN))
    weights = np.repeat((start / start.sum())[:, None], max(1, len(languages)), axis=1)
    place = {name: i for i, name in enumerate(languages)}
    for _ in range(rounds if languages else 0):
        used = np.full(weights.shape, smoothing)
        for r in expected(words, vocab, place, weights).collect():
            used[r["piece"], place[r["lang"]]] += r["used"] / UNIT
        weights = used / used.sum(axis=0)
    return Model(languages, weights, vocab)


def expected(words: DataFrame, vocab: str, place: dict[str, int], weights: np.ndarray) -> DataFrame:
    """Expected uses per language and piece, summed over all words."""
    sent = words.sparkSession.sparkContext.broadcast(weights)

    def uses(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = vocabulary(vocab)
        totals: dict[str, np.ndarray] = {}
        for frame in frames:
            for name, rows in frame.groupby("lang"):
                own = np.ascontiguousarray(sent.value[:, place[name]])
                got = expectations(rows["word"].tolist(), rows["times"].to_numpy(np.float64), pieces, own)
                totals[name] = totals.get(name, 0) + got
        for name, got in totals.items():
            at = np.flatnonzero(got)
            yield pd.DataFrame({"lang": name, "piece": at, "used": got[at]})

    found = words.mapInPandas(uses, "lang string, piece int, used long")
    return found.groupBy("lang", "piece").agg(F.sum("used").alias("used"))


def identify(df: DataFrame, model: Model, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, whether it is held out, ``lang_pred`` and its posterior ``score``.  One pass, no shuffle."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memory = Memory(len(sent.value.languages))
        for frame in slices(frames, "body"):
            names, scores = sent.value.judge(frame["body"].tolist(), memory)
            yield pd.DataFrame({"id": frame["id"], "lang_pred": names, "score": scores})

    rows = df.select(F.col(f"`{key}`").alias("id"), text_of(text).alias("body"))
    out = rows.mapInPandas(run, f"id {df.schema[key].dataType.simpleString()}, lang_pred string, score double")
    held = F.coalesce(F.crc32(F.col("id").cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))
    return out.select(F.col("id").alias(key), held.alias("held_out"), "lang_pred", "score")
