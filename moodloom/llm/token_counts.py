"""Token counts by a linear longest-match automaton (Fast WordPiece, Song et al. 2021).

A trie of the vocabulary gets failure links: when no longer match exists, a state's
link tells where matching goes on, and a precomputed number tells how many tokens were
popped on the way. One pass over the characters thus yields the number of tokens of greedy
longest matching, without building a token. A character outside the vocabulary counts as
its UTF-8 bytes (byte fallback).

A text is matched as in SentencePiece: with a space before it, each space being part of the
piece that starts there. No piece goes on past the end of a word, so equal words (with the
spaces before them) are counted once per task and remembered, in a table of bounded size.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
REMEMBERED = 500_000
_CHUNKS = re.compile(" +[^ ]*")


def load_pieces(model_file: str) -> list[str]:
    """The ordinary pieces of a SentencePiece model; no control, unknown or byte pieces.

    U+2581 is written as a space. Read on the driver only.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    plain = [
        i
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    return [model.id_to_piece(i).replace(SPACE, " ") for i in plain]


@dataclass
class Automaton:
    """State 0 is the root. ``fail`` and ``popped`` of the root are unused."""

    goto: list[dict[str, int]]
    fail: list[int]
    popped: list[int]

    def count(self, text: str) -> int:
        """Tokens of greedy longest matching of a whole text."""
        goto, fail, popped = self.goto, self.fail, self.popped
        state = total = 0
        for char in text:
            step = goto[state].get(char)
            while step is None and state:
                total += popped[state]
                state = fail[state]
                step = goto[state].get(char)
            if step is None:
                total += len(char.encode())
            else:
                state = step
        while state:
            total += popped[state]
            state = fail[state]
        return total


def build(vocabulary: list[str]) -> Automaton:
    goto: list[dict[str, int]] = [{}]
    whole = [False]
    for piece in vocabulary:
        state = 0
        for char in piece:
            if char not in goto[state]:
                goto[state][char] = len(goto)
                goto.append({})
                whole.append(False)
            state = goto[state][char]
        whole[state] = bool(piece)
    fail, popped = [0] * len(goto), [0] * len(goto)
    queue = deque([0])
    while queue:
        parent = queue.popleft()
        for char, state in goto[parent].items():
            queue.append(state)
            if whole[state]:
                popped[state] = 1
                continue
            # Not a token: pop what the parent pops, then try to read the character further on.
            at, count = (fail[parent], popped[parent]) if parent else (0, 0)
            while char not in goto[at] and at:
                count += popped[at]
                at = fail[at]
            if parent and char in goto[at]:
                at = goto[at][char]
            else:
                count += len(char.encode())
            fail[state], popped[state] = at, count
    return Automaton(goto, fail, popped)


def chunks(text: str) -> list[str]:
    """Words, each with the spaces before it; a space is put before the text."""
    if "  " in text or text[:1] == " " or text[-1:] == " ":
        return _CHUNKS.findall(f" {text}")
    return [f" {word}" for word in text.split(" ")]


def count_tokens(docs: DataFrame, automaton: Automaton, id_col: str = "doc_id") -> DataFrame:
    """(id, n_chunks, n_tokens) of each whole text.

    A null or empty text has no chunk and no token. Repeated rows are counted one by one,
    other columns are ignored, and an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(automaton)  # as large as the vocabulary
    id_type = docs.schema[id_col].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, known = shared.value, {}
        for batch in batches:
            n_chunks, n_tokens = [], []
            for value in batch.column(1):
                text = value.as_py()
                total, words = 0, chunks(text) if text else []
                for word in words:
                    found = known.get(word)
                    if found is None:
                        found = machine.count(word)
                        if len(word) <= 64:
                            if len(known) >= REMEMBERED:
                                known.clear()
                            known[word] = found
                    total += found
                n_chunks.append(len(words))
                n_tokens.append(total)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_chunks, pa.int64()), pa.array(n_tokens, pa.int64())],
                names=[id_col, "n_chunks", "n_tokens"],
            )

    return docs.select(F.col(id_col), F.col("text")).mapInArrow(
        count, f"`{id_col}` {id_type}, n_chunks bigint, n_tokens bigint"
    )
