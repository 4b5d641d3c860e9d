"""Language of texts by error-correcting output codes over n-gram classifiers.

Every language has a codeword of bits. For each bit a binary classifier
(logistic regression on the square roots of the shares of hashed byte 2- and
3-grams of the lower-cased text) predicts whether the bit is set. A text's
language is the one whose codeword has the least loss, each bit's logistic
loss weighted by how well its classifier did on the language's training
rows. A text whose two best languages lie close is flagged as ambiguous.

The classifiers are fitted on a sample of the labelled documents: about
``per_label`` of each language and ``most_rows`` of all, at most twice as
many. Tasks turn a sampled text into its n-grams' shares, and those of one
short piece of it, so that short texts are learnt too; the driver gets these
vectors, whose size is fixed, and no texts. Prediction is one pass over whole
texts, without shuffles.

Defined cases: a null text, or one without letters, is ``und`` with score 0;
a language none of whose sampled texts has a letter is never predicted; with
no language left every text is ``und``; with one language every text with
letters is of it; a null id counts as held out and is never learnt from;
repeated rows are predicted alike and learnt from once; a very long text is
one row like any other, read whole; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vertexloom.llm.common import small_batches, table
from vertexloom.llm.samples import remainder, sample

PER_LABEL, MOST_ROWS = 400, 3200
BUCKETS = 1 << 12
PIECE = 80
AMBIGUOUS = 0.15
FOLDS = 5
#: Bytes that are no letters count as a blank.
BLANKS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def grams(text: str) -> np.ndarray:
    """Square roots of the shares of the text's hashed 2- and 3-grams."""
    plain = b" " + b" ".join(text.lower().encode().translate(BLANKS).split()) + b" "
    b = np.frombuffer(plain, np.uint8).astype(np.uint32)
    two = b[:-1] * np.uint32(257) + b[1:]
    three = two[:-1] * np.uint32(257) + b[2:]
    hashed = np.concatenate((two * np.uint32(2654435761), three * np.uint32(2246822519))) >> np.uint32(20)
    counts = np.bincount(hashed, minlength=BUCKETS)
    return np.sqrt(counts / max(1, len(hashed))).astype(np.float32)


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """A row of +1 and -1 for each of ``n`` classes: all splits for up to 5, else random ones that keep rows far apart."""
    if n <= 5:
        splits = [(1, *rest) for rest in product((1, -1), repeat=n - 1) if -1 in rest]
        return np.array(splits, np.float32).T.reshape(n, -1)
    random, length = np.random.default_rng(seed), math.ceil(10 * math.log2(n))
    best, most = None, -1
    for _ in range(200):
        code = random.choice(np.array([-1, 1], np.float32), (n, length))
        code = code[:, np.abs(code.sum(0)) < n]
        apart = (code.shape[1] - code @ code.T) / 2 + np.eye(n) * length
        if apart.min() > most:
            best, most = code, apart.min()
    return best


@dataclass
class Languages:
    """Fitted classifiers: names, codewords, weights of the bits for each language, coefficients."""

    names: list[str]
    code: np.ndarray
    weight: np.ndarray
    slope: np.ndarray
    offset: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score from 0 to 1, whether it is ambiguous."""
        if not self.names or not text or not any(map(str.isalpha, text)):
            return "und", 0.0, False
        if len(self.names) == 1:
            return self.names[0], 1.0, False
        margin = grams(text) @ self.slope + self.offset
        loss = (self.weight * np.logaddexp(0, -self.code * margin)).sum(1)
        share = np.exp(loss.min() - loss)
        first, second = np.sort(loss)[:2]
        best = int(loss.argmin())
        return self.names[best], float(share[best] / share.sum()), bool(second - first < AMBIGUOUS * second)


def examples(text: str) -> Iterator[np.ndarray]:
    """N-gram shares of a text and of one piece of it, where these have letters."""
    at = zlib.crc32(text.encode()) % max(1, len(text) - PIECE)
    for part in (text, text[at : at + PIECE]):
        if any(map(str.isalpha, part)):
            yield grams(part)


def fit(rows: list[tuple[str, np.ndarray]], rounds: int = 150, rate: float = 4.0, decay: float = 1e-5) -> Languages:
    """Fit on languages and n-gram shares: logistic regression of each bit by accelerated gradient steps."""
    names = sorted({lang for lang, _ in rows})
    if len(names) < 2:
        return Languages(names, *[np.zeros((len(names), 0), np.float32)] * 2, np.zeros((BUCKETS, 0)), np.zeros(0))
    place = {name: i for i, name in enumerate(names)}
    x, which, code = np.stack([shares for _, shares in rows]), np.array([place[lang] for lang, _ in rows]), codewords(len(names))
    target = code[which]
    share = np.bincount(which, minlength=len(names))
    each = (1 / np.maximum(share, 1))[which][:, None].astype(np.float32) / len(names)
    slope, offset = np.zeros((BUCKETS, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    step, bias_step = np.zeros_like(slope), np.zeros_like(offset)
    for _ in range(rounds):
        margin = x @ (slope + 0.9 * step) + offset + 0.9 * bias_step
        pull = each * target / (1 + np.exp(np.clip(target * margin, -30, 30)))
        step = 0.9 * step + rate * (x.T @ pull - decay * slope)
        bias_step = 0.9 * bias_step + 0.1 * rate * pull.sum(0)
        slope, offset = slope + step, offset + bias_step
    right = (x @ slope + offset) * target > 0
    weight = np.stack([right[which == k].mean(0) for k in range(len(names))]).astype(np.float32)
    weight = np.where(weight.sum(1, keepdims=True) > 0, weight, 1)  # a language that no bit gets right has all bits alike
    weight /= weight.sum(1, keepdims=True)
    return Languages(names, code, weight * code.shape[1], slope, offset)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_label: int = PER_LABEL, most_rows: int = MOST_ROWS) -> Languages:
    """Fit on a bounded sample of the documents that aren't held out and have a language."""
    small_batches(docs.sparkSession)
    rows = docs.filter(remainder(id_col, FOLDS) != 0).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).dropna()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, lang in zip(batch.column(0), batch.column(1), strict=True):
                for shares in examples(text.as_py()):
                    at = np.flatnonzero(shares)
                    out.append({"lang": lang.as_py(), "at": at.astype(np.int32), "share": shares[at]})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    schema = pa.schema([("lang", pa.string()), ("at", pa.list_(pa.int32())), ("share", pa.list_(pa.float32()))])
    drawn = sample(rows, "lang", per_label, most_rows, ("id", "text")).select("text", "lang")
    learnt = []
    for row in sorted(drawn.mapInArrow(run, "lang string, at array<int>, share array<float>").collect()):
        shares = np.zeros(BUCKETS, np.float32)
        shares[row["at"]] = row["share"]
        learnt.append((row["lang"], shares))
    return fit(learnt)


def predicted(docs: DataFrame, languages: Languages, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: held_out, lang_pred, score, ambiguous."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [shared.value.predict(text.as_py()) for text in batch.column(2)]
            made = zip(*out, strict=True) if out else ([], [], [])
            arrays = [pa.array(v, t) for v, t in zip(made, (pa.string(), pa.float64(), pa.bool_()), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *arrays], names=[id_col, "held_out", "lang_pred", "score", "ambiguous"])

    rows = docs.select(F.col(id_col), F.coalesce(remainder(id_col, FOLDS) == 0, F.lit(True)).alias("held_out"), F.col(text_col))
    return rows.mapInArrow(run, f"{id_col} {docs.schema[id_col].dataType.simpleString()}, held_out boolean, lang_pred string, score double, ambiguous boolean")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predicted(docs, learn(docs))
