"""Token counts without tokens: heap-and-linked-list pair merging, one count per distinct word."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.llm.bpe import local_file
from tableferry.llm.slices import text_slices

SPACE = "▁"
# Words whose counts a worker keeps.
WORDS_KEPT = 400_000


class PieceCounter:
    """Counts the pieces a sentencepiece BPE model with byte fallback makes of a text.

    The model must leave text as it is but for the space mark and the mark put
    before the text; one that does not is refused. It must not define symbols of
    its own either, which a loaded model does not tell, so that is up to the caller.
    """

    def __init__(self, file: str):
        model = sentencepiece.SentencePieceProcessor(model_file=file)
        pieces = [i for i in range(model.get_piece_size()) if not (
            model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i)
        )]
        probe = " a  Åﬁ½\n\t "
        if model.decode(model.encode(probe)) != probe or not any(map(model.is_byte, range(model.get_piece_size()))):
            raise ValueError("needs a BPE model with byte fallback that does not normalise")
        # higher scores merge first; equal scores, as of runs of spaces, from the left
        self.ranks = {model.id_to_piece(i): -model.get_score(i) for i in pieces}
        inner = {(a, b) for p in self.ranks for a, b in zip(p, p[1:])}
        # no piece goes on from another character into a space mark or holds a line feed,
        # so texts can be cut there without a change in what merges
        if any(b == SPACE and a != SPACE for a, b in inner) or any("\n" in pair for pair in inner):
            raise ValueError("pieces cross spaces or lines")
        self.line_feed = 1
        # counts of words met lately, and of those met before these
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def merge(self, word: str) -> int:
        """Initial symbols less merges, where a character that is no piece counts its bytes."""
        ranks = self.ranks
        symbols: list[str | None] = list(word)
        n = len(symbols)
        count = sum(1 if s in ranks else len(s.encode()) for s in symbols)
        heap = [(r, i) for i in range(n - 1) if (r := ranks.get(symbols[i] + symbols[i + 1])) is not None]
        heapify(heap)
        if not heap:
            return count
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            rank, left = heappop(heap)
            first = symbols[left]
            right = after[left]
            if first is None or right >= n or ranks.get(pair := first + symbols[right]) != rank:
                continue  # what stood here has merged since
            symbols[left], symbols[right] = pair, None
            count -= 1
            after[left] = beyond = after[right]
            if beyond < n:
                before[beyond] = left
                if (r := ranks.get(pair + symbols[beyond])) is not None:
                    heappush(heap, (r, left))
            previous = before[left]
            if previous >= 0 and (r := ranks.get(symbols[previous] + pair)) is not None:
                heappush(heap, (r, previous))
        return count

    def _words(self, text: str) -> list[str]:
        """Cut before each run of spaces and around line feeds; a run stays with what follows it."""
        marked = f" {text}".replace(SPACE, " ")
        words: list[str] = []
        for line in marked.split("\n"):
            first, *rest = line.split(" ")
            if first:
                words.append(first)
            if "" in rest:
                held = 1
                for part in rest[:-1]:
                    if part:
                        words.append(SPACE * held + part)
                        held = 1
                    else:
                        held += 1
                words.append(SPACE * held + rest[-1])
            else:
                words += [SPACE + part for part in rest]
        return words

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if len(self.known) > WORDS_KEPT // 2:
            # words that come again move on to the new store, the others go with the old one
            self.known, self.older = {}, self.known
        known, older, words = self.known, self.older, self._words(text)
        for word in set(words).difference(known):
            count = older.get(word)
            known[word] = self.merge(word) if count is None else count
        return text.count("\n") * self.line_feed + sum(map(known.__getitem__, words))


@lru_cache(maxsize=2)
def _counter(file: str) -> PieceCounter:
    return PieceCounter(file)


def with_token_count(docs: DataFrame, text_col: str, count_col: str, model: str) -> DataFrame:
    """Add the number of pieces of each text as ``long``; a column of that name is replaced.

    Null and empty texts have none. Control symbols spelled out in a text are
    ordinary text. Rows stay where they are; there is no shuffle.
    """
    others = [c for c in docs.columns if c != count_col]
    text_at = others.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(local_file(model))
        for batch in text_slices(batches, text_at):
            counts = pa.array([counter.count(t.as_py()) for t in batch.column(text_at)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, counts], [*others, count_col])

    fields = [docs.schema[c] for c in others] + [T.StructField(count_col, T.LongType())]
    return docs.select(*[F.col(f"`{c}`") for c in others]).mapInArrow(run, T.StructType(fields))
