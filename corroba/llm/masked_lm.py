"""Masked pseudo-likelihood: a bidirectional window network in numpy predicts every word from both sides.

1. Vocabulary: words are counted over the whole corpus; the most frequent become tokens, every other word
   falls into one of ``RARE`` tokens by its hash. Counts also give the output biases' start, so the
   untrained network is the corpus's unigram model.
2. Network: for each of the ``2 * SIDE`` neighbours an embedding table, summed to a hidden layer; the
   token is predicted in two steps, its class, then the token inside its class.
3. Training is data-parallel over all documents: in each round the documents of one hash part pass through
   the network where they lie, in at most ``TASKS`` tasks whatever the number of splits. Each task trains a copy on
   every position (``stride`` 1) and emits it in blocks; blocks are averaged in two steps, weighted by examples,
   and so are the squared gradients, which the next round goes on with. The driver only sees one model.
   ``TASKS`` bounds what a round shuffles; raise it along with the cluster.
4. Spelling: words that share a rare token are told apart by their bytes. Byte pairs of all rare words of all
   documents are counted along with the training, and a rare word's probability is that of its token times
   that of its spelling among the token's words.
5. Scoring: the sum over all positions of log p(word | neighbours on both sides), whole texts.

Words are lower-cased (A-Z). The averages depend on ``TASKS`` and on how the documents lie in files, so scores are
reproducible for the same table under the same settings. Defined results: null, empty and blank texts have no
tokens, likelihood 0 and a null mean; null and repeated ids are scored row by row; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as T
from ._frames import map_arrow, written

CLASS = 64  # tokens in a class
CLASSES = 64
TOKENS = CLASS * CLASSES
RARE = CLASS  # the last class
SIDE = 2
HIDDEN = 16
ROUNDS = 3
STRIDE = 1
BATCH = 4096
LEARN = 4096
RATE = 0.12
TASKS = 32
BLOCKS = 16
FAN = 4
EDGE = 256  # a word's begin as a byte before, its end as a byte after
SPELLED = 0.1  # added to each count of a byte pair
FLUSH = 400_000

Params = dict[str, np.ndarray]
Model = tuple[Params, Params, "Spelling"]  # network, sums of squared gradients, counts of byte pairs
_SHAPES = {"E": (2 * SIDE, TOKENS + 1, HIDDEN), "b": (HIDDEN,), "Wc": (HIDDEN, CLASSES), "bc": (CLASSES,), "Wo": (CLASSES, CLASS, HIDDEN), "bo": (CLASSES, CLASS)}
_SUMS = {k: s[:-1] if k in ("E", "Wo") else s for k, s in _SHAPES.items()}


class Vocabulary:
    """Token of a word's hash: its rank, or one of the last ``RARE`` tokens."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes.astype(np.uint64)
        self.bits, salt = 20, 0
        while True:  # a multiplier under which no two words share a place
            self.multiplier = np.uint64(0x9E3779B97F4A7C15 + 2 * salt)
            place = (self.hashes * self.multiplier) >> np.uint64(64 - self.bits)
            if len(np.unique(place)) == len(place):
                break
            salt += 1
            if salt % 64 == 0:
                self.bits += 1
        self.token = np.zeros(1 << self.bits, np.int16)
        self.known = np.zeros(1 << self.bits, np.uint64)
        self.token[place], self.known[place] = np.arange(len(place)), self.hashes

    def __getstate__(self):
        return self.hashes  # the table is made anew, so that tasks are sent the words only

    def __setstate__(self, hashes: np.ndarray):
        self.__init__(hashes)

    def tokens(self, h: np.ndarray) -> np.ndarray:
        place = (h * self.multiplier) >> np.uint64(64 - self.bits)
        rare = TOKENS - RARE + (h & np.uint64(RARE - 1)).astype(np.int32)
        return np.where((self.known[place] == h) & (h != 0), self.token[place].astype(np.int32), rare)


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """(h, n): how often each lower-cased word, by its hash, occurs in the corpus."""

    def make():
        hashes: list[np.ndarray] = []
        counts: list[np.ndarray] = []

        def flush():
            if hashes:
                h, n = np.concatenate(hashes), np.concatenate(counts)
                hashes.clear()
                counts.clear()
                h, at = np.unique(h, return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.bincount(at, n, len(h)).astype(np.int64))], ["h", "n"])

        def step(batch: pa.RecordBatch):
            for w in T.words(batch.column(0)):
                h, n = np.unique(w.hashes(), return_counts=True)
                hashes.append(h)
                counts.append(n)
                if sum(map(len, hashes)) > FLUSH:
                    yield from flush()

        step.finish = flush
        return step

    return map_arrow(docs, [text], "h bigint, n bigint", make).groupBy("h").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame, text: str = "text") -> tuple[Vocabulary, np.ndarray]:
    """The vocabulary, and how often each token occurs."""
    words = written(count_words(docs, text), "lm-words")
    top = words.orderBy(F.desc("n"), "h").limit(TOKENS - RARE).toPandas()
    rare = words.groupBy(F.expr(f"h & {RARE - 1}").alias("k")).agg(F.sum("n").alias("n")).toPandas()
    h = top["h"].to_numpy(np.int64).view(np.uint64) if len(top) else np.zeros(0, np.uint64)
    counts = np.zeros(TOKENS)
    counts[: len(top)] = top["n"]
    counts[TOKENS - RARE + rare["k"].to_numpy(np.int64)] = rare["n"]
    np.subtract.at(counts, TOKENS - RARE + (h & np.uint64(RARE - 1)).astype(np.int64), counts[: len(top)])
    return Vocabulary(h), counts


def fresh(counts: np.ndarray, seed: int = 11) -> Params:
    """The network before training: small random embeddings, unigram output biases."""
    rng = np.random.default_rng(seed)
    p = {k: np.zeros(s, np.float32) for k, s in _SHAPES.items()}
    p["E"][:] = rng.normal(0, 0.15, _SHAPES["E"])
    p["b"][:] = 0.1
    p["Wc"][:] = rng.normal(0, 0.1, _SHAPES["Wc"])
    p["Wo"][:] = rng.normal(0, 0.1, _SHAPES["Wo"])
    share = (counts + 0.5).reshape(CLASSES, CLASS)
    p["bc"][:] = np.log(share.sum(1) / share.sum())
    p["bo"][:] = np.log(share / share.sum(1, keepdims=True))
    return p


def flat(p: Params) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in _SHAPES])


def shaped(v: np.ndarray, shapes: dict[str, tuple[int, ...]] = _SHAPES) -> Params:
    out, at = {}, 0
    for k, s in shapes.items():
        n = int(np.prod(s))
        out[k] = v[at : at + n].reshape(s).astype(np.float32)
        at += n
    return out


def fresh_sums() -> Params:
    """Sums of squared gradients before training; one for a row of the large tables."""
    return {k: np.full(s, 1e-6, np.float32) for k, s in _SUMS.items()}


class Spelling:
    """Counts of byte pairs in rare words, and the probability of a word's bytes under them."""

    def __init__(self, counts: np.ndarray | None = None):
        self.counts = np.zeros((EDGE + 1, EDGE + 1)) if counts is None else counts

    def add(self, w: T.Words, rare: np.ndarray) -> None:
        start, end = w.start[rare], w.end[rare]
        if not len(start):
            return
        inside = np.zeros(len(w.data) + 1, np.int32)
        np.add.at(inside, start, 1)
        np.add.at(inside, end - 1, -1)
        at = np.flatnonzero(np.cumsum(inside[:-1]) > 0)  # bytes of rare words but the last of each
        size = EDGE + 1
        found = np.bincount(w.data[at].astype(np.int64) * size + w.data[at + 1], minlength=size * size)
        found += np.bincount(EDGE * size + w.data[start].astype(np.int64), minlength=size * size)
        found += np.bincount(w.data[end - 1].astype(np.int64) * size + EDGE, minlength=size * size)
        self.counts += found.reshape(size, size)

    def logs(self) -> np.ndarray:
        c = self.counts + SPELLED
        return np.log(c / c.sum(1, keepdims=True)).astype(np.float32)


def spelled(logs: np.ndarray, w: T.Words, rare: np.ndarray) -> np.ndarray:
    """log p(bytes of the word | its rare token): words are dealt to the ``RARE`` tokens evenly."""
    start, end = w.start[rare], w.end[rare]
    if not len(start):
        return np.zeros(0)
    total = np.zeros(len(w.data) + 1)
    np.cumsum(logs[w.data[:-1], w.data[1:]], out=total[1:-1], dtype=np.float64)
    return total[end - 1] - total[start] + logs[EDGE, w.data[start]] + logs[w.data[end - 1], EDGE] + np.log(RARE)


def sequence(w: T.Words, words: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of the block with ``SIDE`` boundary tokens between texts, and where each word stands."""
    at = np.arange(len(w.start)) + SIDE * (w.doc + 1)
    out = np.full(len(w.start) + SIDE * (w.n_docs + 1), TOKENS, np.int16)  # short, so that it sorts by radix
    out[at] = words.tokens(w.hashes())
    return out, at


_OFFSETS = [*range(-SIDE, 0), *range(1, SIDE + 1)]


def _hidden(p: Params, tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
    h = np.broadcast_to(p["b"], (len(at), HIDDEN)).copy()
    for k, step in enumerate(_OFFSETS):
        h += p["E"][k][tokens[at + step]]
    return np.maximum(h, 0)


# A column of scores for each position: sums down the columns run over whole rows at a time.


def _softmax(x: np.ndarray) -> np.ndarray:
    """Softmax of each column."""
    x -= x.max(0)
    np.exp(x, out=x)
    x /= x.sum(0)
    return x


def _log_at(x: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Log softmax at row ``k`` of each column."""
    x -= x.max(0)
    picked = x[k, np.arange(x.shape[1])]
    return picked - np.log(np.exp(x, out=x).sum(0))


def log_likelihoods(p: Params, tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
    """log p(token | both sides) at each position."""
    out = np.empty(len(at), np.float32)
    for i in range(0, len(at), 4 * BATCH):
        here = at[i : i + 4 * BATCH]
        target = tokens[here]
        order = np.argsort(target >> 6, kind="stable")
        target = target[order]
        h = _hidden(p, tokens, here[order])
        score = _log_at(p["Wc"].T @ h.T + p["bc"][:, None], target >> 6)
        edge = np.searchsorted(target >> 6, np.arange(CLASSES + 1))
        for c in np.flatnonzero(np.diff(edge)):
            a, b = edge[c], edge[c + 1]
            score[a:b] += _log_at(p["Wo"][c] @ h[a:b].T + p["bo"][c][:, None], target[a:b] & (CLASS - 1))
        out[i + order] = score
    return out


class Trainer:
    """Adagrad steps on a copy of the network."""

    def __init__(self, p: Params, g: Params | None = None):
        self.p = {k: v.copy() for k, v in p.items()}
        self.g = {k: v.copy() for k, v in (g or fresh_sums()).items()}
        self.examples = 0

    def _step(self, k: str, grad: np.ndarray, at=slice(None)) -> None:
        rows = self.g[k].ndim < self.p[k].ndim
        self.g[k][at] += (grad * grad).mean(-1) if rows else grad * grad
        scale = RATE / np.sqrt(self.g[k][at])
        self.p[k][at] -= (scale[..., None] if rows else scale) * grad

    def learn(self, tokens: np.ndarray, at: np.ndarray) -> None:
        p, n = self.p, len(at)
        self.examples += n
        target = tokens[at]
        order = np.argsort(target >> 6, kind="stable")
        at, target = at[order], target[order]
        h = _hidden(p, tokens, at)
        d = _softmax(p["Wc"].T @ h.T + p["bc"][:, None])
        d[target >> 6, np.arange(n)] -= 1
        d /= n
        back = d.T @ p["Wc"].T
        wc, bc = (d @ h).T, d.sum(1)
        edge = np.searchsorted(target >> 6, np.arange(CLASSES + 1))
        wo, bo = np.zeros_like(p["Wo"]), np.zeros_like(p["bo"])
        for c in np.flatnonzero(np.diff(edge)):
            a, b = edge[c], edge[c + 1]
            e = _softmax(p["Wo"][c] @ h[a:b].T + p["bo"][c][:, None])
            e[target[a:b] & (CLASS - 1), np.arange(b - a)] -= 1
            e /= n
            back[a:b] += e.T @ p["Wo"][c]
            wo[c], bo[c] = e @ h[a:b], e.sum(1)
        back *= h > 0
        for k, step in enumerate(_OFFSETS):
            context = tokens[at + step]
            by = np.argsort(context, kind="stable")
            rows, first = np.unique(context[by], return_index=True)
            grad = np.add.reduceat(back[by], first)
            self._step("E", grad, (k, rows))
        for k, grad in (("b", back.sum(0)), ("Wc", wc), ("bc", bc), ("Wo", wo), ("bo", bo)):
            self._step(k, grad)


def train_round(docs: DataFrame, text: str, words: Vocabulary, model: Model, turn: int, rounds: int, stride: int, tasks: int) -> Model:
    """The average network after one part of the documents; unchanged if the part has no words."""
    part = docs.where(F.col(text).isNotNull() & (F.pmod(F.xxhash64(text), F.lit(rounds)) == turn)).select(text).coalesce(tasks)
    p, g, known = model

    def make():
        trainer, spelling = Trainer(p, g), Spelling()

        def step(batch: pa.RecordBatch):
            for w in T.words(batch.column(0)):
                tokens, at = sequence(w, words)
                spelling.add(w, tokens[at] >= TOKENS - RARE)
                at = at[(turn + w.first) % stride :: stride]
                for i in range(0, len(at), LEARN):
                    trainer.learn(tokens, at[i : i + LEARN])
            return ()

        def finish():
            n = trainer.examples
            if n:
                v = np.concatenate([flat(trainer.p), *(trainer.g[k].ravel() for k in _SUMS), spelling.counts.ravel() / n])
                bucket = TaskContext.get().partitionId() % FAN
                pieces = [x.astype(np.float32).tobytes() for x in np.array_split(v, BLOCKS)]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(BLOCKS), pa.int32()), pa.array(np.full(BLOCKS, bucket), pa.int32()), pa.array(np.full(BLOCKS, n), pa.int64()), pa.array(pieces, pa.binary())], ["block", "bucket", "examples", "v"])

        step.finish = finish
        return step

    def averaged(frames):
        """The mean of each block's pieces, weighted by their examples."""
        key, total, n = None, None, 0

        def told():
            return pd.DataFrame({"block": [key[0]], "bucket": [key[1]], "examples": [n], "v": [(total / n).astype(np.float32).tobytes()]})

        for pdf in frames:
            for block, bucket, examples, v in zip(pdf["block"], pdf["bucket"], pdf["examples"], pdf["v"], strict=True):
                if key is not None and key != (block, bucket):
                    yield told()
                    total, n = None, 0
                key = (block, bucket)
                v = np.frombuffer(v, np.float32).astype(np.float64) * examples
                total = v if total is None else total + v
                n += examples
        if key is not None:
            yield told()

    schema = "block int, bucket int, examples bigint, v binary"
    emitted = map_arrow(part, [text], schema, make)
    by_bucket = emitted.repartition(BLOCKS * FAN, "block", "bucket").sortWithinPartitions("block", "bucket").mapInPandas(averaged, schema)
    by_block = by_bucket.withColumn("bucket", F.lit(0)).repartition(BLOCKS, "block").sortWithinPartitions("block").mapInPandas(averaged, schema)
    rows = sorted(by_block.collect(), key=lambda r: r.block)  # one model
    if not rows:
        return model
    v = np.concatenate([np.frombuffer(r.v, np.float32) for r in rows]).astype(np.float64)
    a, b = (sum(int(np.prod(s)) for s in shapes.values()) for shapes in (_SHAPES, _SUMS))
    counts = np.round(v[a + b :] * rows[0].examples).reshape(EDGE + 1, EDGE + 1)
    return shaped(v[:a]), shaped(v[a : a + b], _SUMS), Spelling(known.counts + counts)


def fit(docs: DataFrame, text: str = "text", rounds: int = ROUNDS, stride: int = STRIDE, tasks: int = TASKS) -> tuple[Vocabulary, Params, np.ndarray]:
    """Vocabulary, network, and the logs of the spelling's probabilities."""
    words, counts = vocabulary(docs, text)
    model: Model = (fresh(counts), fresh_sums(), Spelling())
    for turn in range(rounds):
        model = train_round(docs, text, words, model, turn, rounds, stride, tasks)
    return words, model[0], model[2].logs()


def text_likelihoods(w: T.Words, words: Vocabulary, p: Params, logs: np.ndarray) -> np.ndarray:
    """log p(word | both sides) at each position of a block."""
    tokens, at = sequence(w, words)
    out = log_likelihoods(p, tokens, at).astype(np.float64)
    rare = tokens[at] >= TOKENS - RARE
    out[rare] += spelled(logs, w, rare)
    return out


def score(docs: DataFrame, words: Vocabulary, p: Params, logs: np.ndarray, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_tokens, log_likelihood (sum), mean_log_likelihood."""

    def make():
        def step(batch: pa.RecordBatch):
            n, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for w in T.words(batch.column(1)):
                n[w.first : w.first + w.n_docs] = w.count
                total[w.first : w.first + w.n_docs] = np.bincount(w.doc, text_likelihoods(w, words, p, logs), w.n_docs)
            mean = pa.array(total / np.maximum(n, 1), mask=n == 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(total), mean], [id, "n_tokens", "log_likelihood", "mean_log_likelihood"])

        return step

    return map_arrow(docs, [id, text], f"`{id}` {dict(docs.dtypes)[id]}, n_tokens bigint, log_likelihood double, mean_log_likelihood double", make)


def pseudo_likelihood(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``score`` of all rows under a network trained on all of them."""
    words, p, logs = fit(docs, text)
    return score(docs, words, p, logs, id, text)
