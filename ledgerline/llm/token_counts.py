"""Token counts under a unigram model, computed on a trie of distinct pre-tokens.

A pre-token is a word with the word mark in front. Its best segmentation follows
from the forward scores of its prefixes, and those depend on nothing but the
prefix. So the distinct pre-tokens are put into a trie, each node gets its score
once however many words share it, and the end of a word stores the word's count.
Pieces that end at a node are found from the last letter backwards, as far as some
piece ends that way. Each task builds its trie while it reads; nothing is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
NODES = 500_000  # a task's trie starts afresh beyond this
LONG = 256  # code points; longer words share no prefix worth keeping and stay out of the trie
_PART = 4096  # words between two looks at the trie's size


def unigram_scores(model: bytes) -> dict[str, float]:
    """Log probability of each piece of a sentencepiece model.

    The pieces of a BPE model are ordered by frequency, so they get the
    probabilities of Zipf's law: proportional to 1 / (rank + 1).
    """
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
    plain = [
        pieces.id_to_piece(i)
        for i in range(pieces.get_piece_size())
        if not (pieces.is_control(i) or pieces.is_unknown(i) or pieces.is_byte(i))
    ]
    total = math.log(sum(1 / (rank + 1) for rank in range(len(plain))))
    return {piece: -math.log(rank + 1) - total for rank, piece in enumerate(plain)}


class PrefixTrie:
    """Forward scores of prefixes; ``counts`` holds the token count of every word seen."""

    def __init__(self, scores: dict[str, float]) -> None:
        self.longest = max(map(len, scores), default=1)
        # Every ending of a piece; those that are no piece score nothing but lead on.
        self.endings = dict.fromkeys((piece[i:] for piece in scores for i in range(len(piece))), -math.inf)
        self.endings.update(scores)
        # A character that is no piece falls back to its bytes, each less likely than any piece.
        self.byte_score = min(scores.values(), default=0.0) - 1.0
        self.clear()

    def clear(self) -> None:
        self.node = {"": 0}  # by prefix
        self.parent = [0]
        self.best = [0.0]  # by node: score of the best segmentation of its prefix
        self.tokens = [0]  # and how many tokens that has, the fewest among equals
        self.counts: dict[str, int] = {}
        self.held = 0  # code points of long words

    def total(self, words: list[str]) -> int:
        """Tokens of all words together."""
        found = 0
        for first in range(0, len(words), _PART):
            part = words[first : first + _PART]
            if len(self.best) + self.held > NODES:
                self.clear()
            for word in {*part}.difference(self.counts):
                self.add(word)
            found += sum(map(self.counts.__getitem__, part))
        return found

    def add(self, word: str) -> None:
        text = MARK + word
        if len(text) > LONG:
            self.counts[word] = self._without_nodes(text)
            self.held += len(text)
            return
        nodes, parent, bests, tokens, score_of = self.node, self.parent, self.best, self.tokens, self.endings.get
        known = len(text)
        while text[:known] not in nodes:  # few letters are new, so from the end
            known -= 1
        node = nodes[text[:known]]
        for end in range(known + 1, len(text) + 1):
            n_bytes = self._bytes(text[end - 1])
            best, fewest = bests[node] + n_bytes * self.byte_score, tokens[node] + n_bytes
            before, start = node, end - 1
            while start >= 0 and (score := score_of(text[start:end])) is not None:
                total = bests[before] + score
                if total > best or (total == best and tokens[before] + 1 < fewest):
                    best, fewest = total, tokens[before] + 1
                before, start = parent[before], start - 1
            parent.append(node)
            node = nodes[text[:end]] = len(bests)
            bests.append(best)
            tokens.append(fewest)
        self.counts[word] = tokens[node]

    def _without_nodes(self, text: str) -> int:
        """Tokens of a long word; scores are held only as far as the longest piece reaches back."""
        ring = self.longest + 1
        bests, tokens = [0.0] * ring, [0] * ring
        for end in range(1, len(text) + 1):
            n_bytes, before = self._bytes(text[end - 1]), (end - 1) % ring
            best, fewest = bests[before] + n_bytes * self.byte_score, tokens[before] + n_bytes
            start = end - 1
            while start >= 0 and (score := self.endings.get(text[start:end])) is not None:
                before = start % ring
                if bests[before] + score > best or (bests[before] + score == best and tokens[before] + 1 < fewest):
                    best, fewest = bests[before] + score, tokens[before] + 1
                start -= 1
            bests[end % ring], tokens[end % ring] = best, fewest
        return tokens[len(text) % ring]

    @staticmethod
    def _bytes(letter: str) -> int:
        return 1 if letter < "\x80" else len(letter.encode("utf-8", "replace"))


def _counted(scores):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PrefixTrie(scores.value)
        for batch in batches:
            words_of, tokens_of = [], []
            for text in batch.column(1):
                words = (text.as_py() or "").split()
                words_of.append(len(words))
                tokens_of.append(trie.total(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words_of, pa.int64()), pa.array(tokens_of, pa.int64())],
                names=["doc_id", "n_pretokens", "n_tokens"],
            )

    return run


def count_tokens(
    docs: DataFrame, model: str, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id, n_pretokens, n_tokens``.

    ``model`` is the path of a sentencepiece model; the driver reads it and ships
    it. Pre-tokens are stretches without white space. Null and empty texts count 0.
    Repeated rows and null ids keep their row; an empty table gives an empty
    result. Other columns are not looked at.
    """
    scores = docs.sparkSession.sparkContext.broadcast(unigram_scores(Path(model).read_bytes()))
    source = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    return source.mapInArrow(_counted(scores), "doc_id bigint, n_pretokens bigint, n_tokens bigint")
