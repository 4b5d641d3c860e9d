"""Toxicity of texts by a bidirectional gated recurrent network with attention.

A text is cut into words (runs of letters, A-Z in lower case) and scored in
overlapping windows of words, all of them. A word comes in as its own vector
(for words known from the training rows) and as the sum of the vectors of
its hashed byte 3- to 5-grams with its ends marked, so that unseen words
count by their characters. Two recurrent passes read a window, attention
pools their states, and a logistic output scores it. The text's score is a
logistic function of its windows' highest and mean outputs, fitted to texts
that the network wasn't trained on.

The network is trained in numpy on the driver, on at most ``2 * per_label``
labelled documents of either label and ``most_bytes`` of text; documents of
more than a twentieth of these aren't drawn. Only texts are labelled, so of a
toxic text, after the first rounds, the windows count that the network itself
finds toxic, and its highest one. Scoring is one pass without shuffles, over
all windows of whole texts, and its memory is bounded: windows are scored so
many at a time, and each worker remembers the inputs of a bounded number of
words.

Defined cases: null and empty texts, and texts without words, have one empty
window and are scored like any other; if the labelled rows don't show both
labels or have no words at all, every score is the share of toxic ones among
them (0 without rows); a null id counts as held out and is never learnt from;
of several labels of a document the highest counts; repeated rows are scored
alike; a very long text has very many windows; an empty table gives no rows;
carried columns keep their names and values whatever these are.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vertexloom.llm.common import give_back, small_batches, table, text_of
from vertexloom.llm.samples import remainder, sample

WINDOW, STRIDE = 32, 24
WORD_DIM, GRAM_DIM, STATE = 8, 8, 8
GRAM_BITS, GRAM_SIZES, MOST_WORDS = 15, (3, 4, 5), 20_000
PER_LABEL, MOST_BYTES, FOLDS, HELD = 1000, 32 << 20, 3, 1
#: What each training step takes off the vectors of words and n-grams.
DECAY = 0.05
THRESHOLD = 0.7
SCORED_TOGETHER, LEARNT_TOGETHER, REMEMBERED = 2048, 4096, 60_000
#: Bytes of words: letters, A-Z in lower case, and all of non-ASCII characters; others are blanks.
LETTERS = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(LETTERS).split()


def gram_table(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all words, one after another, and the place where each word's begin."""
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    plain = np.frombuffer(b"".join(b"^" + w + b"$" for w in words), np.uint8).astype(np.uint64)
    size = np.array([len(w) + 2 for w in words])
    owner, end = np.repeat(np.arange(len(words)), size), np.repeat(np.cumsum(size), size)
    place, found, owners = np.arange(len(plain)), [], []
    for n in GRAM_SIZES:
        if len(plain) < n:
            continue
        h = np.full(len(plain) - n + 1, n, np.uint64)
        for i in range(n):
            h = h * np.uint64(1_000_003) + plain[i : len(plain) - n + 1 + i]
        h = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - GRAM_BITS)
        inside = (place[: len(h)] + n <= end[: len(h)])
        found.append(h[inside].astype(np.int64))
        owners.append(owner[: len(h)][inside])
    gram, of = np.concatenate(found), np.concatenate(owners)
    order = np.argsort(of, kind="stable")
    return gram[order], np.searchsorted(of[order], np.arange(len(words)))


def windows_of(ids: np.ndarray, blank: int) -> np.ndarray:
    """Overlapping windows of word ids, the last ones filled with ``blank``; one even without words."""
    n = 1 + max(0, -(-(len(ids) - WINDOW) // STRIDE))
    filled = np.full((n - 1) * STRIDE + WINDOW, blank, np.int64)
    filled[: len(ids)] = ids
    return np.lib.stride_tricks.sliding_window_view(filled, WINDOW)[::STRIDE]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _summed(rows: np.ndarray, index: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of each index."""
    return np.stack([np.bincount(index, rows[:, k], n) for k in range(rows.shape[1])], axis=1).astype(np.float32)


class Network:
    """Weights, scoring and training."""

    def __init__(self, known: list[bytes], seed: int = 1):
        random = np.random.default_rng(seed)

        def drawn(*shape: int, scale: float) -> np.ndarray:
            return random.normal(0, scale, shape).astype(np.float32)

        self.known = {w: i + 1 for i, w in enumerate(known)}
        n = WORD_DIM + GRAM_DIM
        self.weights = {"word": drawn(len(known) + 1, WORD_DIM, scale=0.1), "gram": drawn(1 << GRAM_BITS, GRAM_DIM, scale=0.1), "attend": drawn(2 * STATE, scale=0.3), "out": drawn(2 * STATE, scale=0.3), "bias": np.zeros(1, np.float32)}
        for d in "fb":
            self.weights |= {f"in_{d}": drawn(n, 3 * STATE, scale=n**-0.5), f"off_{d}": np.zeros(3 * STATE, np.float32), f"rec_{d}": drawn(STATE, 3 * STATE, scale=STATE**-0.5)}
        self.scale, self.shift = np.array([1.0, 0.0]), 0.0
        self.constant: float | None = None
        self._forget()

    def inputs(self, words: list[bytes]) -> tuple[np.ndarray, tuple]:
        """A vector for each word, and what it was made of."""
        gram, start = gram_table(words)
        number = np.array([self.known.get(w, 0) for w in words])
        share = (1 / np.sqrt(np.diff(np.append(start, len(gram))))).astype(np.float32)[:, None]
        if not words:
            return np.empty((0, WORD_DIM + GRAM_DIM), np.float32), (np.empty(0, np.int64), gram, start, share)
        sums = np.add.reduceat(self.weights["gram"][gram], start, axis=0) * share
        return np.concatenate((self.weights["word"][number], sums), axis=1), (number, gram, start, share)

    def projected(self, vectors: np.ndarray, d: str) -> np.ndarray:
        """Gate inputs of each word, and last those of the blank, which leaves the state as it is."""
        blank = np.zeros((1, 3 * STATE), np.float32)
        blank[:, :STATE] = 30
        return np.concatenate((vectors @ self.weights[f"in_{d}"] + self.weights[f"off_{d}"], blank))

    def _pass(self, gates: np.ndarray, index: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """States after each place of the windows (place, window, state), read forwards or backwards."""
        rec, h = self.weights[f"rec_{d}"], np.zeros((len(index), STATE), np.float32)
        states = np.empty((WINDOW, len(index), STATE), np.float32)
        for t in range(WINDOW) if d == "f" else range(WINDOW - 1, -1, -1):
            x, g = gates[index[:, t]], h @ rec
            zr = _sigmoid(x[:, : 2 * STATE] + g[:, : 2 * STATE])
            z, r = zr[:, :STATE], zr[:, STATE:]
            n = np.tanh(x[:, 2 * STATE :] + r * g[:, 2 * STATE :])
            new = n + z * (h - n)
            if keep is not None:
                keep.append((t, h, z, r, n, g[:, 2 * STATE :]))
            h = states[t] = new
        return states

    def _pooled(self, states: np.ndarray, index: np.ndarray, blank: int) -> tuple:
        score = states @ self.weights["attend"] + np.where(index.T == blank, np.float32(-1e4), np.float32(0))
        share = np.exp(score - score.max(0))
        share /= share.sum(0)
        pool = np.einsum("tb,tbs->bs", share, states)
        return share, pool, pool @ self.weights["out"] + self.weights["bias"]

    def logits(self, gates_f: np.ndarray, gates_b: np.ndarray, index: np.ndarray, blank: int) -> np.ndarray:
        states = np.concatenate((self._pass(gates_f, index, "f"), self._pass(gates_b, index, "b")), axis=2)
        return self._pooled(states, index, blank)[2]

    def gradients(self, words: list[bytes], index: np.ndarray, target: np.ndarray, each: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the weighted logistic loss over windows of ``words``."""
        w, blank = self.weights, len(words)
        vectors, (number, gram, start, share) = self.inputs(words)
        kept: dict[str, list] = {"f": [], "b": []}
        both = [self._pass(self.projected(vectors, d), index, d, kept[d]) for d in "fb"]
        states = np.concatenate(both, axis=2)
        attend, pool, logit = self._pooled(states, index, blank)
        slope = ((_sigmoid(logit) - target) * each).astype(np.float32)
        out = {"out": pool.T @ slope, "bias": slope.sum(keepdims=True)}
        of_pool = slope[:, None] * w["out"]
        of_share = np.einsum("tbs,bs->tb", states, of_pool)
        of_score = attend * (of_share - (attend * of_share).sum(0))
        out["attend"] = np.einsum("tb,tbs->s", of_score, states)
        of_states = attend[:, :, None] * of_pool + of_score[:, :, None] * w["attend"]
        of_vectors = np.zeros_like(vectors)
        for d, part in (("f", of_states[:, :, :STATE]), ("b", of_states[:, :, STATE:])):
            rec, of_rec, back = w[f"rec_{d}"], np.zeros_like(w[f"rec_{d}"]), np.zeros((len(index), STATE), np.float32)
            of_places = np.empty((WINDOW, len(index), 3 * STATE), np.float32)
            for t, h, z, r, n, g in reversed(kept[d]):
                of_h = part[t] + back
                of_n = of_h * (1 - z) * (1 - n * n)
                of_z = of_h * (h - n) * z * (1 - z)
                of_r = of_n * g * r * (1 - r)
                of_g = np.concatenate((of_z, of_r, of_n * r), axis=1)
                of_rec += h.T @ of_g
                back = of_h * z + of_g @ rec.T
                of_places[t] = np.concatenate((of_z, of_r, of_n), axis=1)
            of_gates = _summed(of_places.reshape(-1, 3 * STATE), index.T.ravel(), blank + 1)[:blank]
            out |= {f"rec_{d}": of_rec, f"in_{d}": vectors.T @ of_gates, f"off_{d}": of_gates.sum(0)}
            of_vectors += of_gates @ w[f"in_{d}"].T
        out["word"] = _summed(of_vectors[:, :WORD_DIM], number, len(w["word"]))
        of_grams = np.repeat(of_vectors[:, WORD_DIM:] * share, np.diff(np.append(start, len(gram))), axis=0)
        out["gram"] = _summed(of_grams, gram, len(w["gram"]))
        return out

    def scores(self, texts: Iterator[str | None]) -> Iterator[float]:
        """A score for each text, in order; each worker's memory of words starts afresh when full."""
        if self.constant is not None:
            yield from (self.constant for _ in texts)
            return
        for outputs in self.outputs(texts):
            yield float(_sigmoid(outputs @ self.scale + self.shift))

    def outputs(self, texts: Iterator[str | None]) -> Iterator[np.ndarray]:
        """The highest and the mean output of each text's windows."""
        group: list[list[bytes]] = []
        waiting = 0
        for text in texts:
            group.append(words_of(text))
            waiting += 1 + len(group[-1]) // STRIDE
            if waiting >= SCORED_TOGETHER:
                yield from self._outputs(group)
                group, waiting = [], 0
        yield from self._outputs(group)

    def _forget(self) -> None:
        self._place: dict[bytes, int] = {}
        self._gates = {d: self.projected(np.empty((0, WORD_DIM + GRAM_DIM), np.float32), d) for d in "fb"}

    def _outputs(self, group: list[list[bytes]]) -> Iterator[np.ndarray]:
        """Row 0 of the remembered gate inputs is the blank's; the arrays grow by doubling."""
        if len(self._place) > REMEMBERED:
            self._forget()
        place, blank = self._place, 0
        new = list({w for words in group for w in words if w not in place})
        for at in range(0, len(new), LEARNT_TOGETHER):
            some, n = new[at : at + LEARNT_TOGETHER], len(place) + 1
            place.update(zip(some, range(n, n + len(some)), strict=True))
            vectors = self.inputs(some)[0]
            for d, gates in self._gates.items():
                if n + len(some) > len(gates):
                    grown = np.empty((2 * (n + len(some)), 3 * STATE), np.float32)
                    grown[:n] = gates[:n]
                    self._gates[d] = gates = grown
                gates[n : n + len(some)] = self.projected(vectors, d)[:-1]
        gates = [self._gates[d] for d in "fb"]
        parts = [windows_of(np.fromiter(map(place.__getitem__, words), np.int64, len(words)), blank) for words in group]
        if not parts:
            return
        index = np.concatenate(parts)
        logit = np.concatenate([self.logits(*gates, index[a : a + SCORED_TOGETHER], blank) for a in range(0, len(index), SCORED_TOGETHER)])
        sizes = np.array([len(p) for p in parts])
        starts = np.cumsum(sizes) - sizes
        yield from np.stack((np.maximum.reduceat(logit, starts), np.add.reduceat(logit, starts, dtype=np.float64) / sizes), axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, decay: float = 0.01) -> tuple[np.ndarray, float]:
    """Scale and shift of the logistic function of the columns of x that fits y, both labels weighing the same; by Newton's method."""
    middle, spread = x.mean(0), x.std(0) + 1e-9
    rows = np.column_stack(((x - middle) / spread, np.ones(len(x))))
    each, pull = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / len(y), np.array([decay] * x.shape[1] + [1e-6])
    w = np.zeros(len(pull))
    for _ in range(50):
        p = _sigmoid(rows @ w)
        curve = (rows * (each * p * (1 - p))[:, None]).T @ rows + np.diag(pull)
        step = np.linalg.solve(curve, rows.T @ (each * (y - p)) - pull * w)
        w += step * min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
    scale = w[:-1] / spread
    return scale, float(w[-1] - middle @ scale)


def train(rows: list, rounds: int = 6, whole_rounds: int = 2, batch: int = 1024, rate: float = 0.01, seed: int = 1) -> Network:
    """Train on rows with text and toxic (0 or 1): the weights on two thirds of them, the last scale on the rest."""
    labels = np.array([row["toxic"] for row in rows], np.float32)
    if len(set(labels.tolist())) < 2 or not any(words_of(row["text"]) for row in rows):
        network = Network([])
        network.constant = float(labels.mean()) if len(labels) else 0.0
        return network
    random = np.random.default_rng(seed)
    apart = random.random(len(rows)) < 1 / 3
    if len(set(labels[apart].tolist())) < 2 or len(set(labels[~apart].tolist())) < 2:
        apart[:] = False
    rest = [row for row, out in zip(rows, apart, strict=True) if out] or rows
    rest_labels = labels[apart] if apart.any() else labels
    rows, labels = [row for row, out in zip(rows, apart, strict=True) if not out], labels[~apart]
    texts = [words_of(row["text"]) for row in rows]
    frequency = Counter(w for words in texts for w in set(words))
    known = sorted((w for w, n in frequency.items() if n >= 3), key=lambda w: (-frequency[w], w))[:MOST_WORDS]
    network = Network(known, seed)
    all_words = sorted(frequency)
    number = {w: i for i, w in enumerate(all_words)}
    blank = len(all_words)
    parts = [windows_of(np.array([number[w] for w in words], np.int64), blank) for words in texts]
    index, owner = np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    target = labels[owner]
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in network.weights.items()}
    steps = 0
    counts = np.ones(len(index), bool)
    for turn in range(rounds):
        if turn >= whole_rounds:
            vectors = network.inputs(all_words)[0]
            gates = [network.projected(vectors, d) for d in "fb"]
            logit = np.concatenate([network.logits(*gates, index[a : a + SCORED_TOGETHER], blank) for a in range(0, len(index), SCORED_TOGETHER)])
            top = np.full(len(parts), -np.inf)
            np.maximum.at(top, owner, logit)
            counts = (target == 0) | (logit > 0) | (logit >= top[owner])
        order = random.permutation(np.flatnonzero(counts))
        some = target[order]
        share = max(1.0, some.sum()) / len(order)
        for a in range(0, len(order), batch):
            at = order[a : a + batch]
            here, local = np.unique(index[at], return_inverse=True)
            local = local.reshape(len(at), WINDOW)
            own = [all_words[i] for i in here if i != blank]
            each = np.where(target[at] > 0, 0.5 / share, 0.5 / (1 - share)) / len(at)
            slopes = network.gradients(own, local, target[at], each)
            steps += 1
            for k, slope in slopes.items():
                first, second = moments[k]
                first += 0.1 * (slope - first)
                second += 0.01 * (slope * slope - second)
                if k in ("word", "gram"):
                    network.weights[k] *= 1 - DECAY
                network.weights[k] -= rate * (first / (1 - 0.9**steps)) / (np.sqrt(second / (1 - 0.99**steps)) + 1e-6)
    network.scale, network.shift = _logistic(np.array(list(network.outputs(row["text"] for row in rest))), rest_labels)
    network._forget()
    return network


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_label: int = PER_LABEL, most_bytes: int = MOST_BYTES) -> Network:
    """Train on a bounded sample of the labelled documents that aren't held out."""
    marked = labels.filter(remainder(id_col, FOLDS) != HELD).select(F.col(id_col).alias("id"), F.col(label_col).alias("toxic")).dropna()
    marked = marked.groupBy("id").agg(F.max("toxic").cast("int").alias("toxic")).filter("toxic in (0, 1)")
    # Ids and labels only, of at most four times per_label rows.
    few = docs.sparkSession.createDataFrame(sample(marked, "toxic", per_label, 2 * per_label).collect(), f"id {labels.schema[id_col].dataType.simpleString()}, toxic int")
    rows = docs.select(F.col(id_col).alias("id"), text_of(F.col(text_col)).alias("text")).join(F.broadcast(few), "id")
    rows = rows.withColumn("size", F.octet_length("text")).filter(F.col("size") <= most_bytes // 20).dropDuplicates(["id", "text"])
    upto = Window.partitionBy("toxic").orderBy(F.xxhash64("id"), "id", "text").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("upto", F.sum("size").over(upto)).filter(F.col("upto") <= most_bytes // 2).select("id", "text", "toxic")
    return train(sorted(rows.collect(), key=lambda row: (str(row["id"]), row["text"])))


def scored(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id of each document, with held_out, score and predicted."""
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"), F.coalesce(remainder(id_col, FOLDS) == HELD, F.lit(True)).alias("held_out"))
    scores = _with_score(rows, network, "__text", ["__id", "held_out"])
    return scores.select(F.col("__id").alias(id_col), "held_out", F.col("__score").alias("score"), (F.col("__score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, network: Network, text_col: str = "text") -> DataFrame:
    """The documents that aren't predicted to be toxic, with the columns they came with."""
    names = [f"__in_{i}" for i in range(len(docs.columns))]
    kept = _with_score(docs.toDF(*names), network, names[docs.columns.index(text_col)], names).filter(F.col("__score") < THRESHOLD)
    return kept.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)])


def _with_score(docs: DataFrame, network: Network, text_col: str, carry: list[str]) -> DataFrame:
    """``carry`` and __score; the text goes along once, as a carried column or else as the last one."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(network)
    rows = docs.select(*carry, *([] if text_col in carry else [text_col]))
    at, n = rows.columns.index(text_col), len(carry)
    schema = T.StructType([*rows.schema[:n], T.StructField("__score", T.DoubleType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = list(shared.value.scores(text.as_py() for text in batch.column(at)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(scores, pa.float64())], names=names)
        shared.value._forget()
        give_back()

    return rows.mapInArrow(run, schema)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scored(docs, learn(docs, table(spark, sf_dir, "labels")))
