"""Token counts under a unigram model, by dynamic programming over a trie of pre-tokens.

A vocabulary file gives the pieces and their order; the probability of a piece follows Zipf's law in that order,
bytes, which every text falls back to, coming last. A task puts each distinct pre-token into a trie once. A node
holds the best score of any segmentation of its prefix, and that segmentation's number of tokens, worked out once
for all pre-tokens that share the prefix; a pre-token's count is read off its last node.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import slices, valid

#: Where the vocabularies of public tokenizers lie.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: how the rank files' tokenizers split text before they look pieces up.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A trie is begun anew when it has so many nodes; bytes of longer pre-tokens are segmented without being kept.
MOST_NODES = 500_000
LONGEST_KEPT = 256


def scores(path: str = VOCABULARY) -> dict[bytes, float]:
    """Log probabilities of the pieces of a rank file, one `base64 rank` a line; all bytes are pieces."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    longer = sorted((p for p in ranks if len(p) > 1), key=ranks.get)
    order = {p: i + 1 for i, p in enumerate(longer)}
    order.update({bytes([b]): len(longer) + 1 for b in range(256)})
    norm = log(sum(1 / r for r in order.values()))
    return {p: -log(r) - norm for p, r in order.items()}


class Counts(dict):
    """Counts of pre-tokens by their text; one that is missing is worked out and, unless it is very long, kept."""

    def __init__(self, trie: Trie) -> None:
        self.trie = trie

    def __missing__(self, word: str) -> int:
        n = self.trie.work_out(word)
        if len(word) <= LONGEST_KEPT:
            self.trie.known[word] = n
        return n


class Trie:
    """Best segmentations of byte strings, shared by prefix. Of equal scores the one with the shorter last piece counts."""

    def __init__(self, pieces: dict[bytes, float], most: int = MOST_NODES) -> None:
        self.pieces, self.most, self.longest = pieces, most, max(map(len, pieces))
        self.clear()

    def clear(self) -> None:
        self.next: dict[int, int] = {}
        self.best, self.tokens = [0.0], [0]
        self.known = Counts(self)

    def count(self, word: str) -> int:
        """The number of tokens of a pre-token."""
        return self.known[word]

    def total(self, words: list[str]) -> int:
        return sum(map(self.known.__getitem__, words))

    def work_out(self, word: str) -> int:
        if len(self.best) > self.most:
            self.clear()
        b = word.encode("utf-8", "surrogatepass")
        return self._insert(b) if len(b) <= LONGEST_KEPT else self._alone(b)

    def _step(self, b: bytes, i: int, best: list[float], tokens: list[int]) -> tuple[float, int]:
        """Score and tokens of b[:i], given those of all shorter prefixes."""
        top, n, get = float("-inf"), 0, self.pieces.get
        for k in range(1, min(i, self.longest) + 1):
            if (s := get(b[i - k : i])) is not None and best[i - k] + s > top:
                top, n = best[i - k] + s, tokens[i - k] + 1
        return top, n

    def _insert(self, b: bytes) -> int:
        path, best, tokens = 0, [0.0], [0]
        for i in range(1, len(b) + 1):
            edge = path << 8 | b[i - 1]
            node = self.next.get(edge)
            if node is None:
                score, n = self._step(b, i, best, tokens)
                node = self.next[edge] = len(self.best)
                self.best.append(score)
                self.tokens.append(n)
            path = node
            best.append(self.best[node])
            tokens.append(self.tokens[node])
        return tokens[-1]

    def _alone(self, b: bytes) -> int:
        best, tokens = [0.0], [0]
        for i in range(1, len(b) + 1):
            score, n = self._step(b, i, best, tokens)
            best.append(score)
            tokens.append(n)
        return tokens[-1]


def count(docs: DataFrame, keep: list[Column], text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """The columns in `keep` with n_pretokens and n_tokens of the whole text; null and empty texts have none,
    bytes that aren't UTF-8 count as U+FFFD, and rows that repeat give the same counts each.

    Tasks count on their own, so that no pre-token moves, however common. The vocabulary, of a fixed size, is read
    by the driver and sent to all tasks.
    """
    shared = docs.sparkSession.sparkContext.broadcast(scores(vocabulary))
    rows = docs.select(*keep, valid(F.col(text)).alias("text_"))
    names = rows.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        find, trie = regex.compile(PATTERN).findall, Trie(shared.value)
        for b in slices(batches, "text_"):
            words, total = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
            for r, text in enumerate(b.column("text_").to_pylist()):
                if text:
                    found = find(text)
                    words[r], total[r] = len(found), trie.total(found)
            yield pa.RecordBatch.from_arrays([*(b.column(x) for x in names), pa.array(words), pa.array(total)], [*names, "n_pretokens", "n_tokens"])

    return rows.mapInArrow(run, rows.drop("text_").schema.add("n_pretokens", "long").add("n_tokens", "long"))
