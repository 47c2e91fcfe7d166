"""Byte-level BPE: encode by replaying the merges over the distinct words of many texts, decode by lookup.

A task collects the words of its rows it has not met, some megabytes of text at
a time, indexes every adjacent token pair by the token it would merge into, and
applies the merges in rank order to all these words at once, touching only the
neighbours of what merged. Words keep their ids for the texts that follow.
"""

from __future__ import annotations

import base64
import heapq
import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.llm.slices import text_slices

NONE = np.int32(2**31 - 1)
# Words whose ids a worker keeps.
WORDS_KEPT = 100_000
# Bytes of text whose new words share one replay: a replay steps through the ranks, however few its words.
REPLAY_BYTES = 2 << 20
# Slices or pairs looked up at a time: what a lookup takes besides its result is a few times 8 bytes for each.
BLOCK = 1 << 15


def _sorted_once(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.r_[True, values[1:] != values[:-1]]]


class MergeTable:
    """Ranks of a byte-level vocabulary: a token's id is its merge rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = max(ranks.values()) + 1
        self.tokens = {i: t for t, i in ranks.items()}
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        splits = [
            (ranks[left] * self.size + ranks[right], rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if (left := token[:cut]) in ranks and (right := token[cut:]) in ranks
        ]
        splits.sort()
        self.pair_keys = np.array([k for k, _ in splits] or [-1], dtype=np.int64)
        self.pair_ranks = np.array([r for _, r in splits] or [NONE], dtype=np.int32)
        lengths = np.zeros(self.size + 1, dtype=np.int64)
        for token, rank in ranks.items():
            lengths[rank + 1] = len(token)
        self.token_starts = np.cumsum(lengths)
        ordered = b"".join(self.tokens.get(i, b"") for i in range(self.size))
        self.token_bytes = np.frombuffer(ordered, dtype=np.uint8)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The token each pair merges into, or NONE."""
        keys = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NONE)

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The token ids of all words in a row, and how many each word has."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(sizes)
        token = self.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
        n = len(token)
        places = np.int32 if n < NONE else np.int64
        after = np.arange(1, n + 1, dtype=places)
        after[ends - 1] = -1
        before = np.arange(-1, n - 1, dtype=places)
        before[ends - sizes] = -1
        # what the pair that starts at a position merges into
        becomes = np.full(n, NONE, dtype=np.int32)
        for start in range(0, n, BLOCK):
            right = token[start + 1 : start + 1 + BLOCK]
            becomes[start : start + len(right)] = self.merged(token[start : start + len(right)], right)
        becomes[ends - 1] = NONE
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def add(positions: np.ndarray, ranks: np.ndarray) -> None:
            """Post positions under their merge; one entry for a position named twice."""
            entries = _sorted_once(ranks.astype(np.int64) * n + positions)
            ranks = (entries // n).astype(np.int32)
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            entries %= n
            for rank, posted in zip(ranks[np.r_[0, cuts]].tolist(), np.split(entries.astype(places), cuts)):
                if rank in index:
                    index[rank].append(posted)
                else:
                    index[rank] = [posted]
                    heapq.heappush(heap, rank)

        pairs = np.flatnonzero(becomes != NONE)
        if len(pairs):
            add(pairs, becomes[pairs])
        while heap:
            rank = heapq.heappop(heap)
            posted = index.pop(rank)
            left = posted[0] if len(posted) == 1 else _sorted_once(np.concatenate(posted))
            left = left[becomes[left] == rank]
            if not len(left):
                continue
            right = after[left]
            touching = right[:-1] == left[1:]
            if touching.any():
                # overlapping pairs, as in aaa: of each run take the first, third, ...
                order = np.arange(len(left))
                first = np.r_[True, ~touching]
                left = left[(order - np.maximum.accumulate(np.where(first, order, 0))) % 2 == 0]
                right = after[left]
            beyond = after[right]
            token[left] = rank
            token[right] = -1
            becomes[right] = NONE
            becomes[left] = NONE
            after[left] = beyond
            has_next = beyond >= 0
            before[beyond[has_next]] = left[has_next]
            previous = before[left]
            starts = np.concatenate([left[has_next], previous[previous >= 0]])
            if len(starts):
                ranks = self.merged(token[starts], token[after[starts]])
                becomes[starts] = ranks
                new = ranks != NONE
                if new.any():
                    add(starts[new], ranks[new])
        kept = token >= 0
        return token[kept], np.diff(np.cumsum(kept)[ends - 1], prepend=0)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids in a row, and where each id's bytes end."""
        starts = self.token_starts[ids]
        sizes = self.token_starts[ids + 1] - starts
        return gather(self.token_bytes, starts, sizes), np.cumsum(sizes)


class Splitter:
    """Cuts text into the pattern's matches, with letters and numbers as the tiktoken library knows them.

    The ``regex`` module follows a later Unicode edition than that library. The
    characters only the former counts as letters or numbers are looked up once,
    and stand as private-use characters while a text that has some is cut.
    """

    def __init__(self, pattern: str):
        self.pattern = regex.compile(pattern)
        one_byte = {bytes([b]): b for b in range(256)}
        library = tiktoken.Encoding("classes", pat_str=r"[\p{L}\p{N}]", mergeable_ranks=one_byte, special_tokens={})
        unassigned = (c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) == "Cn")
        later = {c for c in unassigned if regex.match(r"[\p{L}\p{N}]", c) and not library.encode_ordinary(c)}
        self.later, self.masks = frozenset(later), dict.fromkeys(map(ord, later), "\ue000")
        self.may_have = re.compile(f"[{min(later)}-{chr(sys.maxunicode)}]") if later else re.compile("(?!)")

    def __call__(self, text: str) -> list[str]:
        if text.isascii() or not self.may_have.search(text) or self.later.isdisjoint(text):
            return self.pattern.findall(text)
        return [text[m.start() : m.end()] for m in self.pattern.finditer(text.translate(self.masks))]


class _Numbers(dict):
    """Numbers words in the order they are met."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


def gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The slices of ``values`` that begin at ``starts``, one after the other."""
    ends = np.cumsum(sizes)
    out = np.empty(ends[-1] if len(ends) else 0, dtype=values.dtype)
    for at in range(0, len(ends), BLOCK):
        size, end = sizes[at : at + BLOCK], ends[at : at + BLOCK]
        shift = starts[at : at + BLOCK] - (end - size)
        first, last = end[0] - size[0], end[-1]
        out[first:last] = values[np.repeat(shift, size) + np.arange(first, last)]
    return out


class Encoder:
    """Encodes texts; keeps the ids of words it has met, up to a bound.

    Once half the bound is known, the words of these met more than once become
    the older store. Those of it that come again move on to the new one, the
    others go with the next change.
    """

    def __init__(self, table: MergeTable, pattern: str):
        self.table, self.split = table, Splitter(pattern)
        self._begin()
        self._turn()

    def _begin(self) -> None:
        """A new store."""
        self.numbers = _Numbers()
        self.ids = np.empty(0, dtype=np.int32)
        self.sizes = np.empty(0, dtype=np.int64)
        # how often each word was met; one that moved on, once more
        self.met = np.empty(0, dtype=np.int64)

    def _turn(self) -> None:
        """Make the words met more than once the older store and begin a new one."""
        again = self.met > 1
        self.older = {w: i for i, w in enumerate(compress(self.numbers, again))}
        self.older_sizes = self.sizes[again]
        self.older_ids = gather(self.ids, (np.cumsum(self.sizes) - self.sizes)[again], self.older_sizes)
        self._begin()

    def _learn(self) -> None:
        """Find the ids of the words new in this store: in the older one, or by replaying the merges."""
        words = self.numbers.new
        if not words:
            return
        new = [w.encode() for w in words]
        at = np.fromiter((self.older.get(w, -1) for w in words), dtype=np.int64, count=len(words))
        words.clear()
        known = np.flatnonzero(at >= 0)
        # a word that is a token itself needs no merge
        whole = np.array([self.table.ranks.get(w, -1) for w in new], dtype=np.int32)
        whole[known] = -1
        single = whole >= 0
        sizes = np.ones(len(new), dtype=np.int64)
        sizes[known] = self.older_sizes[at[known]]
        merged = np.flatnonzero(~single & (at < 0))
        if len(merged):
            ids, sizes[merged] = self.table.replay([new[i] for i in merged.tolist()])
        flat = np.empty(int(sizes.sum()), dtype=np.int32)
        kind = np.repeat(np.where(at >= 0, 0, np.where(single, 1, 2)), sizes)
        ends = np.cumsum(self.older_sizes)[at[known]]
        flat[kind == 0] = gather(self.older_ids, ends - sizes[known], sizes[known])
        flat[kind == 1] = whole[single]
        if len(merged):
            flat[kind == 2] = ids
        self.ids, self.sizes = np.concatenate([self.ids, flat]), np.concatenate([self.sizes, sizes])
        self.met = np.concatenate([self.met, at >= 0])

    def encode_lists(self, lists: Iterable[list[str]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each list of texts the ids of all in a row, and how many each has; one replay serves all lists."""
        if len(self.numbers) > WORDS_KEPT // 2:
            self._turn()
        number = self.numbers.__getitem__
        numbered = [[np.fromiter(map(number, self.split(t)), dtype=np.int32) for t in texts] for texts in lists]
        self._learn()
        for numbers in chain.from_iterable(numbered):
            np.add.at(self.met, numbers, 1)
        ends = np.cumsum(self.sizes)
        for words in numbered:
            counts = [int(self.sizes[w].sum()) for w in words]
            every = np.concatenate(words) if words else np.empty(0, dtype=np.int32)
            sizes = self.sizes[every]
            yield gather(self.ids, ends[every] - sizes, sizes), np.array(counts, dtype=np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The token ids of all texts in a row, and how many each text has."""
        return next(self.encode_lists([texts]))


def read_ranks(lines: Iterable[bytes]) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank per line."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def _table(file: str) -> MergeTable:
    with open(file, "rb") as lines:
        return MergeTable(read_ranks(lines))


@lru_cache(maxsize=2)
def _encoder(file: str, pattern: str) -> Encoder:
    return Encoder(_table(file), pattern)


def local_file(path: str) -> str:
    """The vocabulary where the machine has it installed, else the copy ``addFile`` sent along."""
    try:
        with open(path, "rb"):
            return path
    except FileNotFoundError:
        return SparkFiles.get(path.rsplit("/", 1)[-1])


def with_ids(
    docs: DataFrame, text_col: str, ids_col: str, vocabulary: str, pattern: str, bytes_col: str | None = None
) -> DataFrame:
    """Add the token ids of each text as ``array<int>``; a column of that name is replaced.

    A null text counts as empty and has no tokens. Special tokens do not exist:
    their strings are ordinary text. Where ``bytes_col`` is named, the ids are
    decoded in the same pass, as :func:`with_bytes` does. Rows stay where they
    are; there is no shuffle.
    """
    added = [ids_col, *([bytes_col] if bytes_col else [])]
    others = [c for c in docs.columns if c not in added]
    text_at = others.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(local_file(vocabulary), pattern)
        for slices in _replay_groups(text_slices(batches, text_at), text_at):
            texts = ([t or "" for t in rows.column(text_at).to_pylist()] for rows in slices)
            for rows, (ids, counts) in zip(slices, encoder.encode_lists(texts)):
                cuts = np.r_[0, np.cumsum(counts)]
                columns = [pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(ids))]
                if bytes_col:
                    columns.append(_byte_column(encoder.table, ids, cuts))
                yield pa.RecordBatch.from_arrays([*rows.columns, *columns], [*others, *added])

    fields = [docs.schema[c] for c in others] + [T.StructField(ids_col, T.ArrayType(T.IntegerType()))]
    if bytes_col:
        fields.append(T.StructField(bytes_col, T.BinaryType()))
    return docs.select(*[F.col(f"`{c}`") for c in others]).mapInArrow(run, T.StructType(fields))


def _replay_groups(slices: Iterable[pa.RecordBatch], text_at: int) -> Iterator[list[pa.RecordBatch]]:
    """Slices in order, in lists of about ``REPLAY_BYTES`` of text."""
    group: list[pa.RecordBatch] = []
    held = 0
    for rows in slices:
        group.append(rows)
        held += pc.sum(pc.binary_length(rows.column(text_at))).as_py() or 0
        if held >= REPLAY_BYTES:
            yield group
            group, held = [], 0
    if group:
        yield group


def _byte_column(table: MergeTable, ids: np.ndarray, cuts: np.ndarray, valid: list[bool] | None = None) -> pa.Array:
    """The decoded bytes of each run of ids between two cuts."""
    data, ends = table.decode(ids)
    at, data = np.r_[0, ends][cuts].tolist(), data.tobytes()
    values = (data[a:b] for a, b in zip(at, at[1:]))
    if valid:
        values = (v if ok else None for v, ok in zip(values, valid))
    return pa.array(values, pa.binary())


def with_bytes(docs: DataFrame, ids_col: str, bytes_col: str, vocabulary: str) -> DataFrame:
    """Add what the token ids stand for as ``binary``; null ids give null."""
    others = [c for c in docs.columns if c != bytes_col]
    ids_at = others.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(local_file(vocabulary))
        for batch in batches:
            for start in range(0, len(batch), 256):
                rows = batch.slice(start, 256)
                lists = rows.column(ids_at)
                counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                ids = lists.flatten().to_numpy(zero_copy_only=False)
                column = _byte_column(table, ids, np.r_[0, np.cumsum(counts)], lists.is_valid().to_pylist())
                yield pa.RecordBatch.from_arrays([*rows.columns, column], [*others, bytes_col])

    fields = [docs.schema[c] for c in others] + [T.StructField(bytes_col, T.BinaryType())]
    return docs.select(*[F.col(f"`{c}`") for c in others]).mapInArrow(run, T.StructType(fields))
