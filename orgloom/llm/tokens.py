"""Token counts by a linear longest-match automaton.

The vocabulary is a trie in which every state knows where to go on when no character
fits: its failure link, and how many pieces are certain by then, its popped count. Both
are worked out once. A word's greedy longest-match length is then found in one walk over
its characters, without making a piece and without going back, however long the word.

Pieces that begin a word and pieces that go on are told apart, as in word-piece
vocabularies. A sentencepiece word has the mark of its beginning before it: where no piece
joins the mark and the first character, the mark is a piece of its own. If the vocabulary
has a piece for each byte, a character at which no piece begins counts its UTF-8 bytes;
without them, a word that can't be cut into pieces counts as one unknown token.

The automaton's size depends on the vocabulary alone, so it is broadcast. Defined
results: null and empty texts have no words and no tokens; words are divided by white
space; equal texts have equal counts; all columns but ``text`` pass through, those named
like the counts are replaced by them; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orgloom.llm.common import map_batches, others, table

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: The mark of a piece that begins a word in a sentencepiece vocabulary, and of one that goes on in a text list.
BEGINS, GOES_ON = "▁", "##"
CACHE = 300_000
CACHED_LENGTH = 48


def pieces_of(path: str) -> tuple[list[str], list[str], bool]:
    """Pieces that begin a word, pieces that go on, and whether bytes are pieces, from a sentencepiece model or a text list.

    A word of a sentencepiece model begins behind its mark, so the lone mark is an empty
    beginning; the mark within a word is a character like others.
    """
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        special = (model.is_control, model.is_unknown, model.is_byte)
        names = [model.id_to_piece(i) for i in range(len(model)) if not any(f(i) for f in special)]
        n_bytes = sum(map(model.is_byte, range(len(model))))
        return [n[len(BEGINS) :] for n in names if n.startswith(BEGINS)], names, n_bytes == 256
    with open(path, encoding="utf-8") as lines:
        names = [line.rstrip("\n") for line in lines]
    marked = [n[len(GOES_ON) :] for n in names if n.startswith(GOES_ON)]
    return [n for n in names if n and not n.startswith(GOES_ON)], [n for n in marked if n], False


class Automaton:
    """States by number: 0 begins a word, 1 goes on after a piece.

    An empty piece in ``begin`` is the lone mark of a word's beginning. With ``in_bytes``
    every character, and the mark, can be cut into as many pieces as it has UTF-8 bytes.
    """

    def __init__(self, begin: list[str], go_on: list[str], in_bytes: bool = False):
        self.in_bytes = in_bytes
        self.step: list[dict[str, int]] = [{}, {}]
        whole = [False, False]
        for root, pieces in ((0, begin), (1, go_on)):
            for piece in pieces:
                at = root
                for char in piece:
                    following = self.step[at].get(char)
                    if following is None:
                        following = self.step[at][char] = len(self.step)
                        self.step.append({})
                        whole.append(False)
                    at = following
                whole[at] = True
        self.fail = [-1] * len(self.step)
        self.popped = [0] * len(self.step)
        if whole[0] or in_bytes:
            self.fail[0], self.popped[0] = 1, 1 if whole[0] else len(BEGINS.encode())
        level = [0, 1]
        while level:
            below = []
            for parent in level:
                for char, child in self.step[parent].items():
                    below.append(child)
                    if whole[child]:
                        self.fail[child], self.popped[child] = 1, 1
                        continue
                    link, popped = self.fail[parent], self.popped[parent]
                    while link >= 0 and char not in self.step[link]:
                        popped += self.popped[link]
                        link = self.fail[link]
                    if link >= 0:
                        self.fail[child], self.popped[child] = self.step[link][char], popped
                    elif in_bytes:
                        self.fail[child], self.popped[child] = 1, popped + len(char.encode())
            level = below

    def length(self, word: str) -> int:
        """Number of pieces of a word; 0 if it can't be cut."""
        step, fail, popped = self.step, self.fail, self.popped
        at = n = 0
        for char in word:
            following = step[at].get(char)
            while following is None:
                if fail[at] >= 0:
                    n += popped[at]
                    at = fail[at]
                    following = step[at].get(char)
                elif self.in_bytes:  # no piece begins with the character
                    n += len(char.encode())
                    following = 1
                else:
                    return 0
            at = following
        while at > 1:
            if fail[at] < 0:
                return 0
            n += popped[at]
            at = fail[at]
        return n


def count_tokens(docs: DataFrame, automaton: Automaton) -> DataFrame:
    """docs' columns besides text, with n_words, n_tokens (unknown words count one) and n_unknown."""
    shared = docs.sparkSession.sparkContext.broadcast(automaton)
    made = ("n_words", "n_tokens", "n_unknown")
    passed = others(docs, ("text", *made))
    kept, names = list(passed), list(passed.values())

    def make():
        length = shared.value.length
        cache: dict[bytes, int] = {}

        def count(text: str | None) -> tuple[int, int, int]:
            words = text.encode().split() if text else []
            tokens = unknown = 0
            for word, times in Counter(words).items():
                n = cache.get(word)
                if n is None:
                    n = length(word.decode())
                    if len(word) <= CACHED_LENGTH:
                        if len(cache) >= CACHE:
                            cache.clear()
                        cache[word] = n
                if n:
                    tokens += n * times
                else:
                    unknown += times
            return len(words), tokens + unknown, unknown

        def run(batch: pa.RecordBatch) -> dict:
            found = [count(text) for text in batch["text"].to_pylist()]
            return {c: batch[c] for c in kept} | dict(zip(made, map(list, zip(*found, strict=True)), strict=True))

        return run

    schema = docs.select(*names, *[F.lit(0).cast("long").alias(c) for c in made]).schema
    return map_batches(docs.select(*names, "text"), make, schema)


def op5_token_count(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, Automaton(*pieces_of(vocabulary)))
