"""SentencePiece encoding with N-best segmentations, and decoding.

A text is encoded over the piece lattice: nodes are places in the text, edges are pieces
with their scores, and a segmentation is worth the sum of its pieces' scores. A forward Viterbi
pass gives the best score from the start to each node. A* search then runs backward
from the end; these scores are its heuristic, and being exact, paths leave the queue in the order of
their total scores, so the first N that reach the start are the N best.

As in SentencePiece, a space comes before the text and spaces belong to the pieces they begin.
No piece goes on past the end of a word, so the lattice falls into words (with the spaces before
them) joined at single nodes. The forward pass runs over all new words of a batch at once, by
length, and also gives the second best score of each. The N best segmentations of a text differ from its
best one only in the N - 1 words that lose least by their second best: only these are
searched, and their lists are merged. The results are those of a search over the whole text.

A character that is no piece is an edge of its own, scored below all pieces, and written as
its UTF-8 bytes. A U+2581 in the text is such a character, so decoding gives back any text exactly.
Word results are remembered per task in tables of bounded size.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodloom.llm.token_counts import SPACE, chunks

N_BEST = 3
UNKNOWN_PENALTY = 10.0
REMEMBERED = 250_000
SEARCHED = 20_000
LONG = 48  # longer words are few; they are solved one by one
ROWS = 500
UNKNOWN = -1
TIE = 1e-6


@dataclass
class Vocabulary:
    """Ids and scores of the ordinary pieces by their text (U+2581 as a space), and the 256 byte ids."""

    pieces: dict[str, int]
    scores: dict[int, float]
    byte_ids: list[int]
    size: int

    @property
    def unknown_score(self) -> float:
        """Below all single characters but the space."""
        single = [self.scores[i] for p, i in self.pieces.items() if len(p) == 1 and p != " "]
        return min(single, default=0.0) - UNKNOWN_PENALTY


def load_vocabulary(model_file: str) -> Vocabulary:
    """Pieces, scores and byte ids of a SentencePiece model with byte fallback. Read on the driver only."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces, scores, byte_ids = {}, {}, [0] * 256
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            byte_ids[int(model.id_to_piece(i)[1:-1], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            pieces[model.id_to_piece(i).replace(SPACE, " ")] = i
            scores[i] = model.get_score(i)
    return Vocabulary(pieces, scores, byte_ids, model.get_piece_size())


class Lattice:
    """Segmentation of single words, in plain Python: the A* search, and the Viterbi pass of long words."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.unknown = vocabulary.unknown_score
        self.trie: list[dict[str, int]] = [{}]
        self.piece = [UNKNOWN]
        for text, i in vocabulary.pieces.items():
            state = 0
            for char in text:
                if char not in self.trie[state]:
                    self.trie[state][char] = len(self.trie)
                    self.trie.append({})
                    self.piece.append(UNKNOWN)
                state = self.trie[state][char]
            self.piece[state] = i

    def edges(self, word: str) -> tuple[list[list[tuple[int, int, float]]], list[float]]:
        """For each node the edges that end there, (start, piece or UNKNOWN, score), and the best score to it."""
        trie, piece, scores = self.trie, self.piece, self.vocabulary.scores
        n, first = len(word), trie[0]
        ends: list[list[tuple[int, int, float]]] = [[] for _ in range(n + 1)]
        best = [0.0] + [-np.inf] * n
        for i, char in enumerate(word):
            here, state, j = best[i], first.get(char), i + 1
            if state is None or piece[state] == UNKNOWN:
                ends[j].append((i, UNKNOWN, self.unknown))
                best[j] = max(best[j], here + self.unknown)
            while state is not None:
                found = piece[state]
                if found != UNKNOWN:
                    score = scores[found]
                    ends[j].append((i, found, score))
                    if here + score > best[j]:
                        best[j] = here + score
                if j == n:
                    break
                state = trie[state].get(word[j])
                j += 1
        return ends, best

    def spelled(self, word: str, path: list[tuple[int, int]]) -> list[int]:
        """Ids of a path of (start, piece); an unknown character becomes its bytes."""
        ids: list[int] = []
        for start, piece in path:
            if piece == UNKNOWN:
                ids += [self.vocabulary.byte_ids[b] for b in word[start].encode()]
            else:
                ids.append(piece)
        return ids

    def best_two(self, word: str) -> tuple[float, list[int], float]:
        """The best score, its ids, and the second best score, from the forward pass alone."""
        ends, _ = self.edges(word)
        first, second = [0.0] + [-np.inf] * len(word), [-np.inf] * (len(word) + 1)
        came: list[tuple[int, int]] = [(0, UNKNOWN)] * (len(word) + 1)
        for j in range(1, len(word) + 1):
            high = low = -np.inf
            for i, piece, score in ends[j]:
                total = first[i] + score
                if total > high:
                    high, low, came[j] = total, max(high, second[i] + score), (i, piece)
                else:
                    low = max(low, total, second[i] + score)
            first[j], second[j] = high, low
        node, steps = len(word), []
        while node:
            steps.append(came[node])
            node = came[node][0]
        return first[-1], self.spelled(word, steps[::-1]), second[-1]

    def n_best(self, word: str, n: int) -> list[tuple[float, list[int]]]:
        """The n best segmentations, best first; those of equal score in a fixed order.

        Of equal totals, the path nearest the start goes on first, so ties are not all explored before one
        ends. A node is left n times at most, as every path through it further on is worse than n others.
        Both bound the steps by n for each edge. Totals count as equal within ``TIE``, which the sums of
        scores that are not whole numbers need.
        """
        ends, best = self.edges(word)
        left = [0] * (len(word) + 1)
        queue = [(-round(best[-1] / TIE), len(word), 0, 0.0, None)]
        pushed, found = 0, []
        while queue and len(found) < n:
            _, node, _, after, path = heapq.heappop(queue)
            if node == 0:
                steps = []
                while path is not None:
                    steps.append(path[0])
                    path = path[1]
                found.append((after, self.spelled(word, steps)))
                continue
            if left[node] == n:
                continue
            left[node] += 1
            for i, piece, score in ends[node]:
                if left[i] < n:
                    pushed -= 1  # of one node, the last path in goes first
                    total = -round((best[i] + score + after) / TIE)
                    heapq.heappush(queue, (total, i, pushed, score + after, ((i, piece), path)))
        return sorted(found, key=lambda x: -x[0])


class Encoder:
    """Best segmentations of many words, solved together and remembered by number."""

    def __init__(self, vocabulary: Vocabulary):
        self.lattice = Lattice(vocabulary)
        self.length = {i: len(text) for text, i in vocabulary.pieces.items()}
        self._build_table()
        self.clear()

    def _build_table(self) -> None:
        """The trie's steps in an open hash table: (state, character) to the next state."""
        trie = self.lattice.trie
        steps = [(state << 21 | ord(c), to) for state, next_ in enumerate(trie) for c, to in next_.items()]
        self.shift = 64 - max(4, (4 * len(steps)).bit_length())
        size = 1 << (64 - self.shift)
        self.mask = size - 1
        self.keys = np.full(size + 64, -1, np.int64)
        self.next = np.zeros(size + 64, np.int32)
        for key, to in steps:
            at = ((key * 0x9E3779B97F4A7C15) & (2**64 - 1)) >> self.shift
            while self.keys[at] != -1:
                at = (at + 1) & self.mask
            self.keys[at], self.next[at] = key, to
        self.piece = np.array(self.lattice.piece, np.int32)
        scores = self.lattice.vocabulary.scores
        self.score = np.array([scores.get(p, 0.0) for p in self.lattice.piece])

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.start = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.best = np.zeros(0)
        self.loss = np.zeros(0)  # of the second best segmentation
        self.searched: dict[str, list] = {}

    def _step(self, state: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The next states; 0 where there is none."""
        key = (state.astype(np.int64) << 21) | char
        at = ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(self.shift)).astype(np.int64)
        seen = self.keys[at]
        result = np.where(seen == key, self.next[at], 0)
        open_ = np.flatnonzero((seen != key) & (seen != -1))
        while len(open_):
            at[open_] = (at[open_] + 1) & self.mask
            seen = self.keys[at[open_]]
            hit = seen == key[open_]
            result[open_[hit]] = self.next[at[open_[hit]]]
            open_ = open_[~hit & (seen != -1)]
        return result

    def _solve(self, words: list[str]) -> None:
        """Forward pass over words of one length; their best path and second best score."""
        rows, length = len(words), len(words[0])
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64).reshape(rows, length)
        first = np.full((length + 1, rows), -np.inf)
        second = np.full((length + 1, rows), -np.inf)
        came = np.zeros((length + 1, rows), np.int32)
        piece = np.full((length + 1, rows), UNKNOWN, np.int32)
        first[0] = 0

        def reach(i: int, j: int, at: np.ndarray, ids, score) -> None:
            new, next_ = first[i, at] + score, second[i, at] + score
            old = first[j, at]
            second[j, at] = np.maximum(np.minimum(old, new), np.maximum(second[j, at], next_))
            better = new > old
            won = at[better]
            first[j, won] = new[better]
            came[j, won] = i
            piece[j, won] = ids[better]

        unknown = self.lattice.unknown
        for i in range(length):
            at = np.arange(rows)
            state = self._step(np.zeros(rows, np.int64), chars[:, i])
            odd = np.flatnonzero(self.piece[state] == UNKNOWN)  # the root is no piece either
            if len(odd):
                reach(i, i + 1, odd, np.full(len(odd), UNKNOWN, np.int32), unknown)
            j = i
            while True:
                going = state > 0
                at, state = at[going], state[going]
                if not len(at):
                    break
                j += 1
                ids = self.piece[state]
                ends = ids != UNKNOWN
                if ends.any():
                    reach(i, j, at[ends], ids[ends], self.score[state[ends]])
                if j == length:
                    break
                state = self._step(state, chars[at, j])

        node = np.full(rows, length)
        back, used = np.full((length, rows), UNKNOWN, np.int32), np.zeros(rows, np.int64)
        odd = np.zeros(rows, bool)
        live = np.arange(rows)
        while len(live):
            here = piece[node[live], live]
            odd[live[here == UNKNOWN]] = True
            back[used[live], live] = here
            node[live] = came[node[live], live]
            used[live] += 1
            live = live[node[live] > 0]
        place = used[:, None] - 1 - np.arange(length)[None, :]
        flat = np.take_along_axis(back.T, np.maximum(place, 0), 1)
        ids = [flat[place >= 0]]
        counts = used.copy()
        if odd.any():
            paths = [row[:n].tolist() for row, n in zip(flat, used.tolist())]
            for r in np.flatnonzero(odd).tolist():
                start, steps = 0, []
                for p in paths[r]:
                    steps.append((start, p))
                    start += 1 if p == UNKNOWN else self.length[p]
                paths[r] = self.lattice.spelled(words[r], steps)
            counts = np.array([len(p) for p in paths], np.int64)
            ids = [np.array([p for path in paths for p in path], np.int32)]
        self._append(words, ids[0], counts, first[length], first[length] - second[length])

    def _append(self, words, ids, counts, best, loss) -> None:
        base = len(self.known)
        self.known.update(zip(words, range(base, base + len(words))))
        self.fresh.append((ids, counts, best, loss))

    def numbers(self, words: list[list[str]]) -> list[np.ndarray]:
        """Numbers of the words of each text; new words are solved first."""
        if len(self.known) > REMEMBERED:
            self.clear()
        known = self.known
        new = {w for text in words for w in text if w not in known}
        self.fresh: list[tuple] = []
        by_length: dict[int, list[str]] = {}
        for word in sorted(new):
            if len(word) > LONG:
                self._solve_long(word)
            else:
                by_length.setdefault(len(word), []).append(word)
        for length in sorted(by_length):
            group = by_length[length]
            for low in range(0, len(group), 20_000):
                self._solve(group[low : low + 20_000])
        if self.fresh:
            ids, counts, best, loss = (np.concatenate(x) for x in zip(*self.fresh))
            start = len(self.ids) + np.cumsum(counts) - counts
            self.ids, self.start = np.concatenate([self.ids, ids]), np.concatenate([self.start, start])
            self.count = np.concatenate([self.count, counts])
            self.best, self.loss = np.concatenate([self.best, best]), np.concatenate([self.loss, loss])
        return [np.array([known[w] for w in text], np.int64) for text in words]

    def _solve_long(self, word: str) -> None:
        best, ids, second = self.lattice.best_two(word)
        self._append([word], np.array(ids, np.int32), np.array([len(ids)]), np.array([best]), np.array([best - second]))

    def best_ids(self, numbers: np.ndarray) -> np.ndarray:
        """Ids of the best segmentation of a sequence of words."""
        counts = self.count[numbers]
        at = np.repeat(self.start[numbers] - (np.cumsum(counts) - counts), counts)
        return self.ids[at + np.arange(len(at))]

    def word_lists(self, word: str, number: int, n: int) -> list:
        """The n best of a word, led by the one that ``best_ids`` gives, which others may equal in score."""
        found = self.searched.get(word)
        if found is None:
            if len(self.searched) >= SEARCHED:
                self.searched.clear()
            ids = self.best_ids(np.array([number])).tolist()
            rest = [x for x in self.lattice.n_best(word, n) if x[1] != ids]
            found = self.searched[word] = [(float(self.best[number]), ids), *rest][:n]
        return found

    def others(self, words: list[str], numbers: np.ndarray, n: int) -> list[dict]:
        """The second to the n-th best segmentation of a text, as edits of the best."""
        loss = self.loss[numbers]
        few = np.argsort(loss, kind="stable")[: n - 1]
        few = np.sort(few[np.isfinite(loss[few])])
        if not len(few):
            return []
        before = np.cumsum(self.count[numbers])
        lists = [self.word_lists(words[p], int(numbers[p]), n) for p in few.tolist()]
        total = float(self.best[numbers].sum())
        queue = [(-total, (0,) * len(lists))]
        met, found = {queue[0][1]}, []
        while queue and len(found) < n:
            score, choice = heapq.heappop(queue)
            found.append((-score, choice))
            for i in range(len(lists)):
                if choice[i] + 1 < len(lists[i]):
                    next_ = (*choice[:i], choice[i] + 1, *choice[i + 1 :])
                    if next_ not in met:
                        met.add(next_)
                        lost = lists[i][choice[i]][0] - lists[i][choice[i] + 1][0]
                        heapq.heappush(queue, (score + lost, next_))
        result = []
        for score, choice in found[1:]:
            edits = []
            for i, c in enumerate(choice):
                if c:
                    drop = int(self.count[numbers[few[i]]])
                    edits.append({"at": int(before[few[i]]) - drop, "drop": drop, "ids": lists[i][c][1]})
            result.append({"score": score, "edits": edits})
        return result


_EDIT = pa.struct([("at", pa.int32()), ("drop", pa.int32()), ("ids", pa.list_(pa.int32()))])
_OTHERS = pa.list_(pa.struct([("score", pa.float64()), ("edits", pa.list_(_EDIT))]))


class Decoder:
    """The text that a sequence of ids spells."""

    def __init__(self, vocabulary: Vocabulary):
        self.parts = [b""] * vocabulary.size
        for text, i in vocabulary.pieces.items():
            self.parts[i] = text.encode()
        for byte, i in enumerate(vocabulary.byte_ids):
            self.parts[i] = bytes([byte])

    def __call__(self, ids: np.ndarray) -> str:
        parts = self.parts
        known = ids[(ids >= 0) & (ids < len(parts))].tolist()
        text = b"".join([parts[i] for i in known]).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


def encode(
    docs: DataFrame,
    vocabulary: Vocabulary,
    n_best: int = N_BEST,
    id_col: str = "doc_id",
    decoded: bool = False,
) -> DataFrame:
    """(id, score, ids, others): the best segmentation of each whole text and the next ``n_best`` - 1.

    ``others`` lists the latter, best first, each with its score and its edits of ``ids``: at place
    ``at``, ``drop`` ids are replaced by ``ids``. A text with fewer segmentations has fewer.
    Equal scores come in a fixed order. A null text has null ids and score and no others, an empty one no
    ids and the score 0. Repeated rows are encoded one by one, other columns are ignored,
    and an empty table gives an empty result. With ``decoded``, a column of that name holds what ``decode``
    makes of the ids, without a second pass over them.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # as large as the vocabulary
    id_type = docs.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        spell = Decoder(shared.value)
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                part = batch.slice(low, ROWS)
                texts = part.column(1).to_pylist()
                words = [chunks(t) if t else [] for t in texts]
                scores, ids, others = [], [], []
                for text, own, numbers in zip(texts, words, encoder.numbers(words)):
                    if text is None:
                        scores.append(None)
                        ids.append(None)
                        others.append([])
                        continue
                    scores.append(float(encoder.best[numbers].sum()))
                    ids.append(encoder.best_ids(numbers))
                    others.append(encoder.others(own, numbers, n_best) if n_best > 1 else [])
                columns = [
                    part.column(0),
                    pa.array(scores, pa.float64()),
                    pa.array(ids, pa.list_(pa.int32())),
                    pa.array(others, _OTHERS),
                ]
                if decoded:
                    columns.append(pa.array([None if i is None else spell(i) for i in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = (
        f"`{id_col}` {id_type}, score double, ids array<int>, "
        "others array<struct<score:double,edits:array<struct<at:int,drop:int,ids:array<int>>>>>"
    ) + ", decoded string" * decoded
    names = [id_col, "score", "ids", "others", *["decoded"] * decoded]
    return docs.select(F.col(id_col), F.col("text")).mapInArrow(work, schema)


def apply_edits(ids: list[int], edits) -> list[int]:
    """Ids of another segmentation from those of the best."""
    result, last = [], 0
    for edit in sorted(edits, key=lambda e: e["at"]):
        result += [*ids[last : edit["at"]], *edit["ids"]]
        last = edit["at"] + edit["drop"]
    return result + list(ids[last:])


def decode(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``rows`` with a column ``decoded``: the text that the column ``ids`` spells.

    Null ids give null, no ids an empty text; ids outside the vocabulary, control ids and null ids
    spell nothing; bytes that are no UTF-8 become U+FFFD. A column named ``decoded`` is replaced.
    """
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)
    kept = rows.drop("decoded")
    schema = T.StructType([*kept.schema.fields, T.StructField("decoded", T.StringType())])
    names = [*kept.columns, "decoded"]
    place = names.index("ids")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spell = Decoder(shared.value)
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                piece = batch.slice(low, ROWS)
                texts = []
                for value in piece.column(place):
                    ids = value.values
                    texts.append(None if ids is None else spell(ids.drop_null().to_numpy(zero_copy_only=False)))
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns, pa.array(texts, pa.string())], names=names
                )

    return kept.mapInArrow(work, schema)
