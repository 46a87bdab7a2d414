"""Masked pseudo-likelihood: every word is predicted from the words on both sides of it.

The network looks at a window of words before and after a hidden one: each of their
positions has an embedding of each word, their sum goes through tanh, and the hidden word
is predicted in two steps, its class and then the word in the class. A document's score is
the sum of the log-probabilities of its words.

1. Word counts over all documents, combined in each task before the shuffle, are landed.
   The commonest words have a name each, the more of them the more words there are; the
   others share names by their last three bytes.
2. Training takes all documents and does not depend on how the table is laid out: documents
   are dealt to shards by a hash of id and text, as many shards as the number of words asks
   for, and go through them in the order of that hash. The output biases start as the
   counted frequencies, so the untrained network is the unigram. In each round every shard
   starts from the same weights, goes through its share of the round in mini-batches (numpy,
   Adagrad) and returns its state in blocks, which are averaged by the words seen, in the
   shuffle's tasks. The driver gets one network a round, whose size the vocabulary fixes.
3. Scoring is one pass with the weights broadcast. A word with a shared name scores
   log P(name) + log P(word | name), the latter from the counts of all words, less a
   discount that is left to words without a count. The pass lands documents in chunks of
   bounded size with the distinct words of each; these are joined with the counts, and
   documents meet the counts of their chunk.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.llm.ragged import SLICE, Hashes, mix, slices, utf8
from freightlens.llm.shingles import LOWER, words_of
from freightlens.session import land

#: Words kept in a task before they are combined, or landed as a chunk.
HELD = 2_000_000
#: Words that a shard has about, and the most shards.
SHARD, SHARDS = 4_000_000, 1 << 14
#: Taken off the count of every word with a shared name; so much is a word without a count worth.
DISCOUNT = 0.25


@dataclass(frozen=True)
class Shape:
    """Sizes of the network and its training."""

    common: int = 895
    endings: int = 128
    per_class: int = 32
    width: int = 16
    side: int = 2
    batch: int = 8192
    rate: float = 0.15
    rounds: int = 2
    seed: int = 7
    blocks: int = 64

    @property
    def vocabulary(self) -> int:
        """Names: the commonest words, shared names, one for what lies outside a document."""
        return -(-(1 + self.common + self.endings) // self.per_class) * self.per_class

    def grown(self, words: int) -> "Shape":
        """The shape for so many distinct words: names by their square root, classes by that of the names."""
        common = max(self.common, int(2 * words ** 0.5))
        return replace(self, common=common, per_class=max(self.per_class, math.isqrt(common + self.endings) + 1))


class Network:
    """Weights and gradients of the window network."""

    def __init__(self, shape: Shape, weights: dict[str, np.ndarray] | None = None):
        self.shape = shape
        n, d, per = shape.vocabulary, shape.width, shape.per_class
        draw = np.random.default_rng(shape.seed)
        self.weights = weights or {
            "context": draw.normal(0, 0.1, (2 * shape.side, n, d)).astype(np.float32), "bias": np.zeros(d, np.float32),
            "classes": draw.normal(0, 0.1, (n // per, d)).astype(np.float32), "class_bias": np.zeros(n // per, np.float32),
            "words": draw.normal(0, 0.1, (n // per, per, d)).astype(np.float32), "word_bias": np.zeros((n // per, per), np.float32)}
        # Biases begin where counts have put them and take smaller steps.
        self.squares = {k: np.full(w.shape, 1e-4 if k.endswith("_bias") else 1e-6, np.float32) for k, w in self.weights.items()}

    def begin_as_unigram(self, times: np.ndarray) -> "Network":
        """Set the output biases to the log frequencies of the names, ``times`` by name."""
        table = np.zeros(self.shape.vocabulary)
        table[:len(times)] = times
        table = table.reshape(self.weights["word_bias"].shape) + 0.5
        self.weights["word_bias"] = np.log(table / table.sum(1, keepdims=True)).astype(np.float32)
        self.weights["class_bias"] = np.log(table.sum(1) / table.sum()).astype(np.float32)
        return self

    def _hidden(self, windows: np.ndarray) -> np.ndarray:
        """A row a window, and a last column of ones, which the output biases are multiplied with."""
        context, names = self.weights["context"], np.ascontiguousarray(windows.T)
        total = context[0].take(names[0], 0)
        for k in range(1, len(names)):
            total += context[k].take(names[k], 0)
        total += self.weights["bias"]
        out = np.ones((total.shape[0], total.shape[1] + 1), total.dtype)
        np.tanh(total, out=out[:, :-1])
        return out

    def _outputs(self) -> tuple[np.ndarray, np.ndarray]:
        """Output weights of classes and of the words in each, with the biases as a last column."""
        w = self.weights
        return np.column_stack([w["classes"], w["class_bias"]]), np.concatenate([w["words"], w["word_bias"][:, :, None]], 2)

    def _groups(self, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
        """Order of the targets by class, the class of each, and (class, a, b) of the runs in that order."""
        kind = (targets // self.shape.per_class).astype(np.uint16)
        cuts = np.concatenate([[0], np.cumsum(np.bincount(kind, minlength=len(self.weights["classes"])))]).tolist()
        return np.argsort(kind, kind="stable"), kind, [(c, a, b) for c, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]

    @staticmethod
    def _logits(hidden: np.ndarray, words: np.ndarray, runs: list[tuple[int, int, int]]) -> np.ndarray:
        """Of the words in the class of each column's target; what is reduced stands first, so
        that numpy goes along the columns."""
        out = np.empty((words.shape[1], len(hidden)), np.result_type(hidden, words))
        for c, a, b in runs:
            np.matmul(words[c], hidden[a:b].T, out=out[:, a:b])
        return out

    @staticmethod
    def _softmax(logits: np.ndarray, n: int) -> np.ndarray:
        """In place, the softmax of each column, over n."""
        logits -= logits.max(0)
        np.exp(logits, out=logits)
        logits *= 1 / (logits.sum(0) * n)
        return logits

    def log_probabilities(self, windows: np.ndarray, targets: np.ndarray) -> np.ndarray:
        out = np.empty(len(targets), np.float32)
        order, kind, runs = self._groups(targets)
        hidden, kind, place = self._hidden(windows[order]), kind[order], targets[order] % self.shape.per_class
        classes, words = self._outputs()
        columns, logs = np.arange(len(targets)), 0
        for logits, picks in ((classes @ hidden.T, kind), (self._logits(hidden, words, runs), place)):
            logits -= logits.max(0)
            logs = logs + logits[picks, columns]
            logs -= np.log(np.exp(logits, out=logits).sum(0))
        out[order] = logs
        return out

    def learn(self, windows: np.ndarray, targets: np.ndarray) -> None:
        """One mini-batch step."""
        n = len(targets)
        order, _, runs = self._groups(targets)
        windows, place = windows[order], targets[order] % self.shape.per_class
        hidden = self._hidden(windows)
        classes, words = self._outputs()
        top = self._softmax(classes @ hidden.T, n)
        low = self._softmax(self._logits(hidden, words, runs), n)
        low[place, np.arange(n)] -= 1 / n
        for c, a, b in runs:
            top[c, a:b] -= 1 / n
        back, steps = top.T @ classes, np.zeros_like(words)
        for c, a, b in runs:
            back[a:b] += low[:, a:b].T @ words[c]
            steps[c] = low[:, a:b] @ hidden[a:b]
        step = top @ hidden
        self._step("classes", step[:, :-1])
        self._step("class_bias", step[:, -1])
        self._step("words", steps[:, :, :-1])
        self._step("word_bias", steps[:, :, -1])
        hidden = hidden[:, :-1]
        back = back[:, :-1] * (1 - hidden * hidden)
        self._step("bias", back.sum(0))
        for k in range(windows.shape[1]):
            by = np.argsort(windows[:, k].astype(np.uint16 if len(self.weights["context"][k]) <= 1 << 16 else np.int64), kind="stable")
            names = windows[by, k]
            heads = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
            self._step("context", np.add.reduceat(back.take(by, 0), heads), (k, names[heads]))

    def _step(self, name: str, gradient: np.ndarray, at=...) -> None:
        squares = self.squares[name][at] + gradient * gradient
        self.squares[name][at] = squares
        self.weights[name][at] -= self.shape.rate * gradient / np.sqrt(squares)

    def flat(self) -> np.ndarray:
        """Weights, then Adagrad's sums of squares."""
        return np.concatenate([w.ravel() for part in (self.weights, self.squares) for w in part.values()])

    def load(self, flat: np.ndarray) -> "Network":
        at = 0
        for part in (self.weights, self.squares):
            for name, w in part.items():
                part[name] = flat[at:at + w.size].reshape(w.shape).astype(np.float32)
                at += w.size
        return self


def _words(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and last three bytes of every word."""
    data = LOWER[data]
    rows, starts, ends = words_of(data, borders)
    hashes = Hashes(data)
    return rows, hashes.spans(starts, ends), hashes.spans(np.maximum(starts, ends - 3), ends)


def _from_zero(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return data[borders[0]:borders[-1]], borders - borders[0]


def _counts(rows: DataFrame, shape: Shape) -> DataFrame:
    """(word, shared, n) over all documents, words as hashes with the ending they may share a name by."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, shared, times = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def combined() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            both, first, which = np.unique(np.concatenate([words, *(h for h, _ in held)]), return_index=True, return_inverse=True)
            one = np.ones(len(which) - len(words), np.int64)
            return (both, np.concatenate([shared, *(e for _, e in held)])[first],
                    np.bincount(which, np.concatenate([times, one]), len(both)).astype(np.int64))

        def merged() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(shared), pa.array(times)], names=["word", "shared", "n"])

        for batch in batches:
            data, borders = utf8(batch.column("text"))
            for x, y in slices(np.diff(borders)):
                _, hashes, endings = _words(data[borders[x]:borders[y]], borders[x:y + 1] - borders[x])
                held.append((hashes, _shared(endings, shape)))
                if sum(len(h) for h, _ in held) > HELD:
                    words, shared, times = combined()
                    held.clear()
                    if len(words) > HELD:
                        yield merged()
                        words, shared, times = words[:0], shared[:0], times[:0]
        words, shared, times = combined()
        yield merged()

    return rows.mapInArrow(count, "word long, shared long, n long").groupBy("word").agg(F.first("shared").alias("shared"), F.sum("n").alias("n"))


def _shared(endings: np.ndarray, shape: Shape) -> np.ndarray:
    """Number of a shared name, from 0, by the hash of an ending."""
    return (mix(endings) % np.uint64(shape.endings)).astype(np.int64)


def within_name(times: np.ndarray) -> np.ndarray:
    """Log of a word's discounted count; less ``name_total`` of its shared name, log P(word | name).

    A name of D counted words leaves DISCOUNT of each, and once more, to as many words and
    one more that have no count, so the probabilities of all add up to 1.
    """
    return np.log(np.where(times > 0, times - DISCOUNT, DISCOUNT))


def name_total(times: np.ndarray) -> np.ndarray:
    """Log of the total that discounted counts of a shared name are part of."""
    return np.log(times + DISCOUNT)


LANDED = pa.schema([("chunk", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("named", pa.float64()), ("places", pa.binary()),
                    ("word", pa.int64()), ("place", pa.int32())])


class Names:
    """Names of words: 0 lies outside a document, then the commonest words, then endings."""

    def __init__(self, words: np.ndarray, shape: Shape):
        self.shape = shape
        order = np.argsort(words)
        self.words, self.ids = words[order], order + 1
        # Where words of the same leading bits begin, and how many there are at most: few, of hashes.
        bits = len(words).bit_length() + 3
        self.shift = np.uint64(64 - bits)
        heads = (self.words >> self.shift).astype(np.int64)
        self.first, self.most = np.searchsorted(heads, np.arange(1 << bits)), int(np.bincount(heads, minlength=1).max())

    def of(self, hashes: np.ndarray, endings: np.ndarray) -> np.ndarray:
        shared = 1 + self.shape.common + _shared(endings, self.shape)
        if not len(self.words):
            return shared
        at, ended = self.first[(hashes >> self.shift).astype(np.int64)], np.append(self.words, np.uint64(2**64 - 1))
        for _ in range(self.most):
            at += ended[at] < hashes
        at = np.minimum(at, len(self.words) - 1)
        return np.where(self.words[at] == hashes, self.ids[at], shared)

    def windows(self, data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Row, names around, name and hash of every word of a slice."""
        rows, hashes, endings = _words(data, borders)
        names, side, n = self.of(hashes, endings), self.shape.side, len(rows)
        around = np.zeros((n, 2 * side), np.int64)
        for k in range(side):
            step = k + 1
            if n > step:
                same = rows[step:] == rows[:-step]
                around[step:, k][same] = names[:-step][same]
                around[:-step, side + k][same] = names[step:][same]
        return rows, around, names, hashes


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Array | None]]:
    """(shard, texts) of about ``SLICE`` bytes of a shard's rows, or one longer text, and
    (shard, None) behind its last: the same wherever batches begin and end."""
    shard, held, size = None, [], 0
    for batch in batches:
        shards, texts = batch.column("shard").to_numpy(), batch.column("text")
        sizes = pc.binary_length(texts).to_numpy()
        at = 0
        for i, (s, n) in enumerate(zip(shards.tolist(), sizes.tolist())):
            if s != shard or size and size + n > SLICE:
                held.append(texts.slice(at, i - at))
                at = i
                if size:
                    yield shard, pa.concat_arrays(held)
                held, size = [], 0
                if s != shard and shard is not None:
                    yield shard, None
                shard = s
            size += n
        held.append(texts.slice(at))
    if shard is not None:
        if size:
            yield shard, pa.concat_arrays(held)
        yield shard, None


def _trained(rows: DataFrame, n_shards: int, names: Names, start: np.ndarray, shape: Shape) -> np.ndarray:
    """The network's state after every shard's share (doc_id, text) of a round."""
    sent = rows.sparkSession.sparkContext.broadcast((names, start))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, start = sent.value
        network, seen = Network(shape).load(start), 0
        for shard, texts in _slices(batches):
            if texts is not None:
                _, around, targets, _ = names.windows(*_from_zero(*utf8(texts)))
                mixed = np.random.default_rng(shape.seed).permutation(len(targets))
                for a in range(0, len(targets), shape.batch):
                    pick = mixed[a:a + shape.batch]
                    network.learn(around[pick], targets[pick])
                seen += len(targets)
                continue
            if seen:
                parts = np.array_split(network.flat().astype(np.float64) * seen, shape.blocks)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(shape.blocks), pa.int64()), pa.array([shard] * shape.blocks, pa.int64()), pa.array([seen] * shape.blocks, pa.int64()),
                     pa.array([p.astype(np.float32).tobytes() for p in parts], pa.binary())], names=["block", "shard", "seen", "weights"])
            network, seen = Network(shape).load(start), 0

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for block, seen, raw in zip(*(batch.column(c).to_pylist() for c in ("block", "seen", "weights"))):
                held = sums.setdefault(block, [0, 0.0])
                held[0] += seen
                held[1] = held[1] + np.frombuffer(raw, np.float32).astype(np.float64)
        blocks = sorted(sums)
        yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array([(sums[b][1] / sums[b][0]).tobytes() for b in blocks], pa.binary())],
                                         names=["block", "weights"])

    key = F.xxhash64("doc_id", "text")
    dealt = rows.select(F.pmod(key, F.lit(n_shards)).alias("shard"), key.alias("key"), "text").repartition(4 * n_shards, "shard")
    own = dealt.sortWithinPartitions("shard", "key", "text").select("shard", "text").mapInArrow(train, "block long, shard long, seen long, weights binary")
    own = own.repartition("block").sortWithinPartitions("block", "shard")  # sums in one order
    means = own.mapInArrow(add, "block long, weights binary").collect()  # one network
    if not means:
        return start
    return np.concatenate([np.frombuffer(r.weights) for r in sorted(means)]).astype(np.float32)


@dataclass
class Model:
    """What scoring needs: the network's state, its names, the log totals of shared names (all
    of a size that the vocabulary's names fix), and the landed counts of all words."""

    shape: Shape
    names: Names
    state: np.ndarray
    totals: np.ndarray
    counts: DataFrame


def _rows(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))


def fit(documents: DataFrame, shape: Shape = Shape(), id_column: str = "doc_id", text_column: str = "text", shard_words: int = SHARD) -> Model:
    """Counts and a trained network over all rows; the same however the table is laid out."""
    rows = _rows(documents, id_column, text_column)
    counts = land(_counts(rows, shape), "word-counts")
    n_distinct, n_words = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    shape = shape.grown(n_distinct)
    common = counts.orderBy(F.desc("n"), "word").limit(shape.common).collect()  # by the square root of the words
    names = Names(np.array([r.word for r in common], np.int64).view(np.uint64), shape)
    totals = np.zeros(shape.endings, np.int64)
    for r in counts.groupBy("shared").agg(F.sum("n").alias("n")).collect():
        totals[r.shared] = r.n
    for r in common:
        totals[r.shared] -= r.n
    times = np.zeros(1 + shape.common + shape.endings)
    times[1:1 + len(common)] = [r.n for r in common]
    times[1 + shape.common:] = totals
    state = Network(shape).begin_as_unigram(times).flat()
    n_shards = min(SHARDS, max(1, -(-n_words // shard_words)))
    turn = F.pmod(F.shiftright(F.xxhash64("text", "doc_id"), 8), F.lit(shape.rounds))
    for k in range(shape.rounds):
        state = _trained(rows.where(F.col("text").isNotNull() & (turn == k)), n_shards, names, state, shape)
    return Model(shape, names, state, name_total(totals), counts)


def pseudo_likelihood(documents: DataFrame, shape: Shape = Shape(), id_column: str = "doc_id", text_column: str = "text",
                      shard_words: int = SHARD) -> DataFrame:
    """(doc_id, n_words, log_likelihood, mean_log_likelihood) of every row.

    Words stand between ASCII white space, A-Z are lowered. A null or blank text has no
    words, a sum of 0 and a null mean. Ids may be null or repeated, each row is scored by
    itself and learned from once, in the round and shard that its id and text hash to; of
    words that are equally common, those of lower hash have a name. Scores are the same
    however the table is laid out (to rounding), and change with the corpus. An empty table
    gives no rows. Other columns are not read.
    """
    return scores(fit(documents, shape, id_column, text_column, shard_words), documents, id_column, text_column)


def scores(model: Model, documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The columns of :func:`pseudo_likelihood` for any documents."""
    rows, shape, counts = _rows(documents, id_column, text_column), model.shape, model.counts
    sent = rows.sparkSession.sparkContext.broadcast((model.names, model.state, model.totals))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weights, totals = sent.value
        network, first = Network(shape).load(weights), 1 + shape.common
        documents: list[tuple] = []
        chunk = TaskContext.get().partitionId() << 32

        def landed() -> Iterator[pa.RecordBatch]:
            """The documents held, with places in the list of their distinct words, and that list."""
            words, places = np.unique(np.concatenate([d[3] for d in documents]), return_inverse=True)
            places, at = places.astype(np.int32), 0
            for ids, n, sums, _, rare in documents:
                ends = np.concatenate([[0], np.cumsum(rare)]) * 4
                own = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(places[at:at + int(rare.sum())])])
                at += int(rare.sum())
                yield batch_of(len(n), doc_id=ids, n_words=pa.array(n), named=pa.array(sums), places=own.cast(pa.binary()))
            for a in range(0, len(words), 100_000):
                some = words[a:a + 100_000].view(np.int64)
                yield batch_of(len(some), word=pa.array(some), place=pa.array(np.arange(a, a + len(some), dtype=np.int32)))

        def batch_of(n: int, **columns: pa.Array) -> pa.RecordBatch:
            columns["chunk"] = pa.array(np.full(n, chunk))
            return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in LANDED], schema=LANDED)

        for batch in batches:
            data, borders = utf8(batch.column("text"))
            counts, rare, sums = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64), np.zeros(len(batch))
            unnamed = [np.empty(0, np.uint64)]
            for x, y in slices(np.diff(borders)):
                owner, around, targets, hashes = names.windows(data[borders[x]:borders[y]], borders[x:y + 1] - borders[x])
                for a in range(0, len(targets), shape.batch):
                    b = a + shape.batch
                    sums[x:y] += np.bincount(owner[a:b], network.log_probabilities(around[a:b], targets[a:b]), y - x)
                counts[x:y] = np.bincount(owner, minlength=y - x)
                sharing = targets >= first
                sums[x:y] -= np.bincount(owner[sharing], totals[targets[sharing] - first], y - x)
                rare[x:y] = np.bincount(owner[sharing], minlength=y - x)
                unnamed.append(hashes[sharing])
            documents.append((batch.column("doc_id"), counts, sums, np.concatenate(unnamed), rare))
            if sum(len(d[3]) for d in documents) > HELD:
                yield from landed()
                documents.clear()
                chunk += 1
        if documents:
            yield from landed()

    def finish(documents: pa.Table, words: pa.Table) -> pa.Table:
        logs = np.zeros(len(words))
        logs[words.column("place").to_numpy()] = within_name(words.column("n").to_numpy())
        data, borders = utf8(documents.column("places").combine_chunks())
        places = data[borders[0]:borders[-1]].view(np.int32)
        owner = np.repeat(np.arange(len(documents)), np.diff(borders) // 4)
        counts = documents.column("n_words").to_numpy()
        sums = documents.column("named").to_numpy() + np.bincount(owner, logs[places], len(documents))
        means = np.divide(sums, counts, out=np.zeros(len(sums)), where=counts > 0)
        return pa.table([documents.column("doc_id"), pa.array(counts), pa.array(sums), pa.array(means, mask=counts == 0)],
                        names=["doc_id", "n_words", "log_likelihood", "mean_log_likelihood"])

    scored = land(rows.mapInArrow(score, "chunk long, doc_id long, n_words long, named double, places binary, word long, place int"), "named-words")
    words = scored.where("word is not null").select("chunk", "place", "word").join(counts.select("word", "n"), "word", "left")
    words = words.select(F.col("chunk").alias("of"), "place", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    whole = scored.where("places is not null").select("chunk", "doc_id", "n_words", "named", "places")
    return whole.groupBy("chunk").cogroup(words.groupBy("of")).applyInArrow(
        finish, "doc_id long, n_words long, log_likelihood double, mean_log_likelihood double")
