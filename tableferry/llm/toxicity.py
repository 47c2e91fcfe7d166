"""Toxicity by a small convolutional text classifier, trained on every labelled row.

Words are hashed to embeddings; filters of several widths run over a text, each
keeps its largest answer anywhere in it, and a linear layer turns these into a
score. A text is cut at its language's threshold, found on rows set aside.

Training goes in rounds. In each one every task of a Spark job takes the steps of
its own rows, from the network that all share, and Spark averages what they changed.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tableferry.llm import langid
from tableferry.llm.slices import text_slices
from tableferry.operators.keyfilter import key_filter

BUCKET_BITS = 18
BUCKETS = 1 << BUCKET_BITS
# characters hashed together, however long a text is, and bytes of text scored together
PIECE = 1 << 17
SCORED_BYTES = 1 << 19
# a word's hash is a polynomial of its code points in BASE, modulo 2**64; MIX spreads it over the buckets
BASE, MIX, WRAP = 0xD6E8FEB86659FD93, 0x9E3779B97F4A7C15, 1 << 64
WORD, BETWEEN, END = 0, 1, 2
# stands after each text; no code point is as large
END_CODE = 0x110000
WIDTHS = (1, 2, 3)
# so that a window of every width can lie in a text's padding alone
PAD = max(WIDTHS)
WORDS_AT_ONCE = 1 << 17
FOLDS = 5
# rows a task trains on in one round
PART_ROWS = 8192
# a step ends early at this many words, and looks at so many windows and hands on so many changes at once
STEP_WORDS = 1 << 20
STEP_WINDOWS = 1 << 13
# changes are summed as whole numbers of this fraction, so that their order does not matter
UNIT = 1 << 24
# logits are counted in bins of this fraction, each with its smallest and largest
BINS = 1024
# Languages with fewer rows of either class set aside share the common threshold.
LEAST_ROWS = 20


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Whether each code point is part of a word: letters and digits are."""
    kinds = [WORD if unicodedata.category(chr(c))[0] in "LN" else BETWEEN for c in range(END_CODE)]
    return np.array([*kinds, END], dtype=np.uint8)


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """The powers of ``BASE`` and of its inverse, for every place in a piece."""
    both = (np.full(2 * PIECE + 2, x, dtype=np.uint64) for x in (BASE, pow(BASE, -1, WRAP)))
    up, down = (np.multiply.accumulate(np.r_[np.uint64(1), x[1:]]) for x in both)
    return up, down


def _pieces(texts: Iterable[str | None]) -> Iterator[np.ndarray]:
    """The code points of all texts in lower case, ``END_CODE`` after each, at most ``2 * PIECE + 1`` at a time."""
    held, size, end = [], 0, END_CODE.to_bytes(4, "little")
    for text in texts:
        low = (text or "").lower()
        for at in range(0, len(low), PIECE):
            held.append(low[at : at + PIECE].encode("utf-32-le", "replace"))
            size += len(held[-1]) // 4
            if size >= PIECE:
                yield np.frombuffer(b"".join(held), dtype="<u4")
                held, size = [], 0
        held.append(end)
        size += 1
    if held:
        yield np.frombuffer(b"".join(held), dtype="<u4")


def word_buckets(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The hashed words of the texts one after the other, letters and digits in lower case, and how many each text has.

    What lies between two words is one cut, so a text without a letter or digit
    at an end has an empty word there; null counts as empty. Words are hashed
    where the network runs, on arrays of code points: no object is made a word.
    """
    up, down = _powers()
    # of the word that the last piece left open: its hash so far; and whether a cut was left open
    ids, ends, done, open_hash, cutting = [], [], 0, 0, False
    for codes in _pieces(texts):
        kinds = _kinds()[codes]
        between = kinds == BETWEEN
        # a word ends where a cut begins, and with its text
        at = np.flatnonzero((between & ~np.r_[cutting, between[:-1]]) | (kinds == END))
        values = np.where(kinds == WORD, codes, 0).astype(np.uint64) * down[: len(codes)]
        sums = np.r_[np.uint64(0), np.cumsum(values)]
        before = np.r_[np.uint64(-open_hash % WRAP), sums[at]]
        hashes = (before[1:] - before[:-1]) * up[at]
        hashes = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(MIX)
        ids.append((hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int32))
        ends.append(np.flatnonzero(kinds[at] == END) + done + 1)
        done += len(at)
        open_hash = (int(sums[-1]) - int(before[-1])) * int(up[len(codes)]) % WRAP
        cutting = bool(between[-1])
    if not ids:
        return np.empty(0, dtype=np.int32), np.empty(0, dtype=np.int64)
    return np.concatenate(ids), np.diff(np.concatenate(ends), prepend=0)


def remainder(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 5; null for a null id."""
    return F.crc32(id_col.cast("string")) % FOLDS


@dataclass
class Network:
    """``place`` gives a bucket's row of ``embeddings``; row 0 is zero and stands for padding and unlearned words."""

    place: np.ndarray
    embeddings: np.ndarray
    filters: dict[int, np.ndarray]
    bias: dict[int, np.ndarray]
    out: np.ndarray
    out_bias: float

    def answers(self) -> dict[int, list[np.ndarray]]:
        """Per width and position in the window, what each word adds to each filter."""
        return {w: [self.embeddings @ f for f in self.filters[w]] for w in WIDTHS}

    def logits(self, ids: np.ndarray, lengths: np.ndarray, tables: dict[int, list[np.ndarray]]) -> np.ndarray:
        """One value a text; ``ids`` holds the texts' buckets one after the other.

        Windows are taken a bounded number at a time, however long a text is.
        """
        seq, starts, left = padded(self.place[ids], lengths)
        pooled = []
        for w in WIDTHS:
            best = np.full((len(lengths), self.filters[w].shape[2]), -np.inf, dtype=np.float32)
            for at in range(0, starts[-1], WORDS_AT_ONCE):
                end = min(at + WORDS_AT_ONCE, starts[-1])
                found = sum(tables[w][k][seq[at + k : end + k]] for k in range(w))
                found[left[at:end] < w] = -np.inf
                first = np.searchsorted(starts, at, side="right") - 1
                last = np.searchsorted(starts, end, side="left")
                cuts = np.maximum(starts[first:last], at) - at
                best[first:last] = np.maximum(best[first:last], np.maximum.reduceat(found, cuts, axis=0))
            pooled.append(np.maximum(best + self.bias[w], 0))
        return np.concatenate(pooled, axis=1) @ self.out + self.out_bias


def padded(places: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts with padding after each, where each starts (and the last ends), and how far each place is from its text's end.

    A window that reaches beyond its text's padding does not count.
    """
    starts = np.r_[0, np.cumsum(lengths + PAD)]
    seq = np.zeros(starts[-1] + PAD, dtype=np.int32)
    text_of = np.repeat(np.arange(len(lengths)), lengths)
    seq[np.arange(len(places)) + text_of * PAD] = places
    return seq, starts, np.repeat(starts[1:], lengths + PAD) - np.arange(starts[-1])


def _vocabulary(found: np.ndarray, bad: np.ndarray, n: int, n_toxic: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """A row for each bucket found in ``least`` texts, and how far its texts' share of toxic ones is from chance.

    ``found`` and ``bad`` count the texts and the toxic texts of each bucket, among ``n`` and ``n_toxic``.
    """
    known = np.flatnonzero(found >= least)
    place = np.zeros(BUCKETS, dtype=np.int32)
    place[known] = np.arange(1, len(known) + 1)
    share = n_toxic / n
    expected = found[known] * share
    return place, (bad[known] - expected) / np.sqrt(expected * (1 - share) + 1)


def _text_counts(rows: Iterable[tuple[np.ndarray, bool]]) -> tuple[np.ndarray, np.ndarray]:
    """In how many texts, and toxic texts, each bucket is found."""
    found, bad = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
    for text, y in rows:
        seen = np.unique(text)
        found[seen] += 1
        if y:
            bad[seen] += 1
    return found, bad


def _pack(embeddings: np.ndarray, filters: dict, bias: dict, out: np.ndarray, out_bias: float) -> np.ndarray:
    """All parameters as rows of an embedding's width; the embeddings come first."""
    dim = embeddings.shape[1]
    rest = [*(filters[w] for w in WIDTHS), *(bias[w] for w in WIDTHS), out, np.array([out_bias])]
    rest = np.concatenate([x.ravel() for x in rest])
    return np.concatenate([embeddings, np.pad(rest, (0, -len(rest) % dim)).reshape(-1, dim)]).astype(np.float32)


def _unpack(rows: np.ndarray, known: int, n_filters: int) -> tuple[np.ndarray, dict, dict, np.ndarray, float]:
    dim, rest = rows.shape[1], rows[known:].ravel()
    shapes = [(w, dim, n_filters) for w in WIDTHS] + [(n_filters,)] * len(WIDTHS) + [(len(WIDTHS) * n_filters,), (1,)]
    ends = np.cumsum([np.prod(x) for x in shapes])
    parts = [rest[e - np.prod(x) : e].reshape(x).copy() for x, e in zip(shapes, ends)]
    n = len(WIDTHS)
    return rows[:known].copy(), dict(zip(WIDTHS, parts)), dict(zip(WIDTHS, parts[n:])), parts[-2], float(parts[-1][0])


@dataclass
class _Training:
    """The network being trained, the sums of its squared gradients, and the weight of a clean and of a toxic text."""

    place: np.ndarray
    values: np.ndarray
    squares: np.ndarray
    known: int
    n_filters: int
    weights: np.ndarray
    rate: float
    decay: float

    @classmethod
    def start(cls, place, lean, n, n_toxic, dim=12, n_filters=8, rate=0.05, decay=1e-4, seed=7):
        """The first coordinate of an embedding starts from how often the word occurs in toxic texts, the others from
        small random numbers. Both classes weigh the same together."""
        rng = np.random.default_rng(seed)
        embeddings = rng.normal(0, 0.02, (len(lean) + 1, dim)).astype(np.float32)
        embeddings[1:, 0] = np.tanh(lean / 4)
        embeddings[0] = 0
        filters = {w: rng.normal(0, 0.5, (w, dim, n_filters)) for w in WIDTHS}
        bias = {w: np.zeros(n_filters) for w in WIDTHS}
        values = _pack(embeddings, filters, bias, rng.normal(0, 0.2, len(WIDTHS) * n_filters), 0.0)
        weights = np.array([0.5 * n / (n - n_toxic), 0.5 * n / n_toxic])
        return cls(place, values, np.full_like(values, 1e-3), len(embeddings), n_filters, weights, rate, decay)

    def network(self) -> Network:
        return Network(self.place, *_unpack(self.values, self.known, self.n_filters))

    def after(self, steps: Iterable[tuple[list[np.ndarray], np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Values and squares after a step for each batch of texts, and how many steps changed each row.

        Max pooling sends gradients to one window a filter only, so a step changes few embeddings.
        """
        net, (e2, f2, b2, o2, c2) = self.network(), _unpack(self.squares, self.known, self.n_filters)
        touches, count = np.zeros(len(self.values), dtype=np.int64), 0

        def step(value, grad, square):
            square += grad * grad
            value -= self.rate * (grad / np.sqrt(square) + self.decay * value)

        for texts, toxic in steps:
            lengths = np.array([len(t) for t in texts])
            seq, starts, left = padded(self.place[np.concatenate(texts)], lengths)
            best, peaks = _peaks(net, seq, starts, left)
            hidden = np.maximum(best, 0)
            score = 1 / (1 + np.exp(-np.clip(hidden @ net.out + net.out_bias, -30, 30)))
            slope = ((score - toxic) * self.weights[toxic.astype(int)] / len(texts)).astype(np.float32)
            back = slope[:, None] * net.out * (hidden > 0)
            rows, grads = [], []
            for n, w in enumerate(WIDTHS):
                mine = slice(n * self.n_filters, (n + 1) * self.n_filters)
                moved = np.nonzero(back[:, mine])
                grad = np.empty_like(net.filters[w])
                for k in range(w):
                    at_k = seq[peaks[:, mine] + k]
                    grad[k] = np.einsum("dfe,df->ef", net.embeddings[at_k], back[:, mine])
                    rows.append(at_k[moved])
                    grads.append(back[:, mine][moved][:, None] * net.filters[w][k].T[moved[1]])
                step(net.filters[w], grad, f2[w])
                step(net.bias[w], back[:, mine].sum(axis=0), b2[w])
            step(net.out, hidden.T @ slope, o2)
            c2 += float(slope.sum()) ** 2
            net.out_bias -= self.rate * float(slope.sum()) / np.sqrt(c2)
            count += 1
            rows = np.concatenate(rows)
            if not len(rows):
                continue
            order = np.argsort(rows, kind="stable")
            rows = rows[order]
            first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
            touched, grad = rows[first], np.add.reduceat(np.concatenate(grads)[order], first, axis=0)
            value, square = net.embeddings[touched], e2[touched]
            step(value, grad, square)
            net.embeddings[touched], e2[touched] = value, square
            # padding stays silent
            net.embeddings[0] = 0
            touches[touched] += 1
        touches[self.known :] = count
        values = _pack(net.embeddings, net.filters, net.bias, net.out, net.out_bias)
        return values, _pack(e2, f2, b2, o2, c2), touches


def _peaks(net: Network, seq: np.ndarray, starts: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each filter's largest answer in each text, and where its window starts."""
    n_filters = net.filters[1].shape[2]
    flat = np.concatenate([f.T for w in WIDTHS for f in net.filters[w]])
    best = np.full((len(starts) - 1, len(WIDTHS) * n_filters), -np.inf, dtype=np.float32)
    peaks = np.zeros(best.shape, dtype=np.int64)
    for at in range(0, starts[-1], STEP_WINDOWS):
        end = min(at + STEP_WINDOWS, starts[-1])
        answers = (flat @ net.embeddings[seq[at : end + PAD - 1]].T).reshape(-1, n_filters, end - at + PAD - 1)
        found = np.empty((best.shape[1], end - at), dtype=np.float32)
        used = 0
        for n, w in enumerate(WIDTHS):
            mine = found[n * n_filters : (n + 1) * n_filters]
            mine[:] = net.bias[w][:, None]
            for k in range(w):
                mine += answers[used + k][:, k : k + end - at]
            mine[:, np.flatnonzero(left[at:end] < w)] = -np.inf
            used += w
        first = np.searchsorted(starts, at, side="right") - 1
        last = np.searchsorted(starts, end, side="left")
        for text in range(first, last):
            start = max(starts[text], at) - at
            part = found[:, start : starts[text + 1] - at]
            where = part.argmax(axis=1)
            top = part[np.arange(len(part)), where]
            higher = top > best[text]
            best[text][higher] = top[higher]
            peaks[text][higher] = (where + start + at)[higher]
    return best, peaks


def _steps(rows: Iterable[tuple[np.ndarray, bool]], batch: int) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Rows in order, ``batch`` at a time or fewer where they are long."""
    texts, toxic, words = [], [], 0
    for text, y in rows:
        texts.append(text)
        toxic.append(y)
        words += len(text)
        if len(texts) == batch or words >= STEP_WORDS:
            yield texts, np.array(toxic, dtype=bool)
            texts, toxic, words = [], [], 0
    if texts:
        yield texts, np.array(toxic, dtype=bool)


def train(
    texts: list[np.ndarray], toxic: np.ndarray, epochs: int = 10, batch: int = 32, least: int = 3, **start
) -> Network:
    """A network for texts (arrays of buckets) of both classes: what ``learn`` does with rows of one part.

    Words of fewer than ``least`` texts are not learned.
    """
    n, n_toxic = len(texts), int(toxic.sum())
    state = _Training.start(*_vocabulary(*_text_counts(zip(texts, toxic)), n, n_toxic, least), n, n_toxic, **start)
    for _ in range(epochs):
        state.values, state.squares, _ = state.after(_steps(zip(texts, toxic), batch))
    return state.network()


def threshold(logits: np.ndarray, toxic: np.ndarray, rows: np.ndarray | None = None, highest: np.ndarray | None = None) -> float:
    """The cut with the best F1, in the middle of the widest gap that reaches it.

    A value can stand for ``rows`` rows, ``toxic`` of them toxic, between it and ``highest``.
    """
    order = np.argsort(-logits, kind="stable")
    ranked, hits = logits[order], np.cumsum(toxic[order])
    said = np.arange(1, len(order) + 1) if rows is None else np.cumsum(rows[order])
    above = ranked if highest is None else highest[order]
    f1 = 2 * hits / (said + toxic.sum())
    last = np.r_[ranked[:-1] > ranked[1:], True]
    gap = ranked - np.r_[above[1:], ranked[-1] - 1]
    best = max(np.flatnonzero(last), key=lambda i: (round(f1[i], 9), gap[i]))
    return float(ranked[best] - gap[best] / 2)


@dataclass
class Classifier:
    """``constant`` is the score of all texts where one class or none was found among the learned rows."""

    constant: float
    network: Network | None = None
    thresholds: dict[str, float] | None = None
    common: float = 0.0


def _labelled(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """``fit_id, toxic``: the labelled ids that are not held out.

    An id labelled several times is toxic if one label says so.
    """
    rows = labels.select(F.col(id_col).alias("fit_id"), F.col(label_col).cast("int").alias("toxic")).dropna()
    rows = rows.where(remainder(F.col("fit_id")) != 0)
    return rows.groupBy("fit_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))


def _set_aside(labelled: DataFrame, texts: DataFrame, parts: int) -> DataFrame:
    """The ids that have a text, and whether each is set aside: a fifth of each class.

    Of each class in turn, so that both are on both sides wherever they have five
    ids; the turns are taken within ``parts`` groups of ids.
    """
    part = F.pmod(F.xxhash64(F.lit("aside"), "fit_id"), F.lit(parts))
    turn = F.row_number().over(Window.partitionBy(part, "toxic").orderBy(F.xxhash64(F.lit("turn"), "fit_id"), "fit_id"))
    found = labelled.join(texts.select("id"), F.col("fit_id") == F.col("id"), "left_semi")
    return found.withColumn("aside", turn % FOLDS == 0)


def _dealt(texts: DataFrame, labelled: DataFrame, languages: langid.Profiles, parts: int) -> DataFrame:
    """``toxic, aside, ids, lang_pred`` of each text with a label, in ``parts`` partitions, each in an order of hashes.

    The language is told for rows set aside only.
    """
    # most texts without a label stay where they are; of the others each is shuffled once
    may = key_filter(labelled.select(F.col("fit_id").cast("string").alias("key")), ["key"]).may_hold(F.col("id").cast("string"))
    wanted = texts.where(may).repartition(parts, "id")
    # columns made after the shuffle: the join then keeps its partitions, whatever spark.sql.shuffle.partitions says
    wanted = wanted.select("id", "text", F.xxhash64(F.lit("row"), "id", "text").alias("order"))
    fit = _set_aside(labelled, texts, parts).hint("shuffle_hash")
    rows = wanted.join(fit, F.col("id") == F.col("fit_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, 0, SCORED_BYTES):
            texts, aside = part.column(0).to_pylist(), part.column(1).to_pylist()
            langs = [languages.predict(t if a else None)[0] for t, a in zip(texts, aside)]
            ids, lengths = word_buckets(texts)
            ids = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lengths)], pa.int32()), pa.array(ids))
            found = [part.column(2), ids, part.column(1), pa.array(langs, pa.string()), part.column(3)]
            yield pa.RecordBatch.from_arrays(found, ["toxic", "ids", "aside", "lang_pred", "order"])

    rows = rows.select("text", "aside", "toxic", "order")
    rows = rows.mapInArrow(run, "toxic int, ids array<int>, aside boolean, lang_pred string, order long")
    # for a single part, which a join spreads
    return rows.coalesce(parts).sortWithinPartitions("order", "toxic").drop("order")


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, bool]]:
    """The buckets of each row of ``toxic, ids``, and its class."""
    for batch in batches:
        for y, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
            yield ids.values.to_numpy(zero_copy_only=False), y == 1


def _count_buckets(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """In how many rows, and toxic rows, each bucket is found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, bad = _text_counts(_read(batches))
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at]), pa.array(bad[at])], ["bucket", "found", "bad"])

    counts = rows.mapInArrow(run, "bucket long, found long, bad long")
    counts = counts.groupBy("bucket").agg(F.sum("found").alias("found"), F.sum("bad").alias("bad")).toArrow()
    found, bad = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
    at = counts.column("bucket").to_numpy()
    found[at], bad[at] = counts.column("found").to_numpy(), counts.column("bad").to_numpy()
    return found, bad


def _round(rows: DataFrame, state: _Training, batch: int) -> None:
    """Every task takes the steps of its rows; the changes are averaged, each by the steps that made it."""
    dim = state.values.shape[1]
    names = [f"{x}{i}" for x in "vs" for i in range(dim)]
    # given up after the round, so that the driver holds one network at a time
    shared = rows.sparkSession.sparkContext.broadcast(state)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = shared.value
        values, squares, touches = before.after(_steps(_read(batches), batch))
        pa.default_memory_pool().release_unused()
        changed = np.flatnonzero(touches)
        for first in range(0, len(changed), STEP_WINDOWS):
            at = changed[first : first + STEP_WINDOWS]
            change = np.concatenate([values[at] - before.values[at], squares[at] - before.squares[at]], axis=1)
            sums = np.rint(change.T.astype(np.float64) * touches[at] * UNIT).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(touches[at]), *map(pa.array, sums)], ["slot", "steps", *names])

    schema = ", ".join(["slot long", "steps long", *(f"{x} long" for x in names)])
    mean = [(F.sum(x) / F.sum("steps") / F.lit(float(UNIT))).cast("float").alias(x) for x in names]
    found = rows.mapInArrow(run, schema).groupBy("slot").agg(*mean).toArrow()
    shared.destroy()
    at = found.column("slot").to_numpy()
    change = np.stack([found.column(x).to_numpy() for x in names], axis=1)
    state.values[at] += change[:, :dim]
    state.squares[at] += change[:, dim:]


def _thresholds(rows: DataFrame, net: Network) -> tuple[dict[str, float], float]:
    """The best cut of each language with rows enough of both classes, and of all rows.

    Spark counts the rows of each bin of logits; the driver receives the bins.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = net.answers()
        for batch in batches:
            for part in _text_slices(batch, 1):
                flat = part.column(1).flatten().to_numpy(zero_copy_only=False)
                logits = net.logits(flat, pc.list_value_length(part.column(1)).to_numpy(zero_copy_only=False), tables)
                logits = pa.array(logits.astype(np.float64))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), logits], ["toxic", "lang_pred", "logit"])

    found = rows.select("toxic", "ids", "lang_pred").mapInArrow(run, "toxic int, lang_pred string, logit double")
    bins = found.groupBy("lang_pred", F.floor(F.col("logit") * BINS).alias("bin")).agg(
        F.count("*").alias("rows"), F.sum("toxic").alias("toxic"), F.min("logit").alias("low"), F.max("logit").alias("high")
    )
    bins = bins.toArrow().sort_by([("lang_pred", "ascending"), ("bin", "descending")])
    of = np.array(bins.column("lang_pred").to_pylist(), dtype=object)
    place, n, toxic, low, high = (bins.column(x).to_numpy() for x in ("bin", "rows", "toxic", "low", "high"))
    thresholds = {}
    for lang in sorted(set(of)):
        mine = of == lang
        if min(toxic[mine].sum(), (n - toxic)[mine].sum()) >= LEAST_ROWS:
            thresholds[lang] = threshold(low[mine], toxic[mine], n[mine], high[mine])
    order = np.argsort(-place, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(place[order]) != 0])
    toxic, n = (np.add.reduceat(x[order], first) for x in (toxic, n))
    return thresholds, threshold(np.minimum.reduceat(low[order], first), toxic, n, np.maximum.reduceat(high[order], first))


def learn(
    docs: DataFrame, labels: DataFrame, languages: langid.Profiles, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", part_rows: int = PART_ROWS, epochs: int = 10, batch: int = 32, least: int = 3, **start,
) -> Classifier:
    """Train on the whole text of every labelled row that is not held out.

    A fifth of the ids is set aside for the thresholds, one per predicted
    language and a common one; words of fewer than ``least`` texts of the others
    are not learned. The rows are dealt by a hash to tasks of about ``part_rows``
    and stay there for all ``epochs``; one part is trained like in one process.
    The driver holds the network, and receives counts of buckets, averaged
    changes and bins of logits, whose size does not follow the rows.
    """
    labelled = _labelled(labels, id_col, label_col).persist(StorageLevel.DISK_ONLY)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where(F.col("text").isNotNull())
    rows = None
    try:
        sizes = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
        if len(sizes) < 2:
            return Classifier(float(max(sizes, default=0)))
        rows = _dealt(texts, labelled, languages, -(-sum(sizes.values()) // part_rows)).persist(StorageLevel.DISK_ONLY)
        n = {(r["aside"], r["toxic"]): r["count"] for r in rows.groupBy("aside", "toxic").count().collect()}
        clean, toxic = n.get((False, 0), 0), n.get((False, 1), 0)
        if not clean or not toxic:
            return Classifier(float(toxic > 0))
        learned = rows.where(~F.col("aside")).select("toxic", "ids")
        size = (clean + toxic, toxic)
        state = _Training.start(*_vocabulary(*_count_buckets(learned), *size, least), *size, **start)
        for _ in range(epochs):
            _round(learned, state, batch)
        net = state.network()
        if not n.get((True, 0)) or not n.get((True, 1)):
            return Classifier(0.0, net, {})
        return Classifier(0.0, net, *_thresholds(rows.where("aside"), net))
    finally:
        labelled.unpersist()
        if rows is not None:
            rows.unpersist()


def _text_slices(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """Rows in order, about ``WORDS_AT_ONCE`` words at a time and one row at least."""
    sizes = pc.list_value_length(batch.column(at)).to_pylist()
    start, held = 0, 0
    for row, size in enumerate(sizes):
        if row > start and held + size > WORDS_AT_ONCE:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    yield batch.slice(start)


def with_toxicity(docs: DataFrame, text_col: str, classifier: Classifier, languages: langid.Profiles, score_col: str = "score") -> DataFrame:
    """Add the score, 0 to 1, from the whole text alone: 0.5 is the threshold of the text's predicted language.

    A null or empty text scores like one of unknown words. A column of that name
    is replaced, others are kept. Rows stay where they are.
    """
    others = [c for c in docs.columns if c != score_col]
    kept = docs.select(*[F.col(f"`{c}`") for c in others])
    if classifier.network is None:
        return kept.withColumn(score_col, F.lit(classifier.constant))
    net, thresholds, common = classifier.network, classifier.thresholds, classifier.common
    text_at = others.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = net.answers()
        for part in text_slices(batches, text_at, SCORED_BYTES):
            texts = part.column(text_at).to_pylist()
            # both from one worker: a second one for the languages would hold the texts again
            cuts = np.array([thresholds.get(languages.predict(t)[0], common) for t in texts])
            logits = net.logits(*word_buckets(texts), tables) - cuts
            scores = 1 / (1 + np.exp(-np.clip(logits, -500, 500)))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], [*others, score_col])

    fields = [kept.schema[c] for c in others] + [T.StructField(score_col, T.DoubleType())]
    return kept.mapInArrow(run, T.StructType(fields))


def predict_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    label_col: str = "toxic", **fit,
) -> DataFrame:
    """Learn from the labelled rows that are not held out and score all: adds ``held_out, score, predicted``.

    Held out are the ids whose crc32 as text is divisible by 5. A row without id
    is neither held out nor learned from; null labels, and ids that the
    documents lack, teach nothing; rows repeat if they repeat. Where the labels
    name one class or none, the score is 1 or 0 for all. Languages are predicted
    from the text, by profiles of the language operator; ``lang_col`` is what
    those are learned from, and no input of a score.
    """
    # from every row, not from a sample
    languages = langid.learn_unheld(docs, id_col, text_col, lang_col, fit_rows=float("inf"))
    classifier = learn(docs, labels, languages, id_col, text_col, label_col, **fit)
    found = with_toxicity(docs, text_col, classifier, languages)
    return found.withColumns({
        "held_out": F.coalesce(remainder(F.col(id_col)) == 0, F.lit(False)),
        "predicted": (F.col("score") >= 0.5).cast("int"),
    })
