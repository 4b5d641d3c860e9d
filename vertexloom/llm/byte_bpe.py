"""Byte-level BPE encoding and decoding by a public vocabulary of ranks.

A text is split by the vocabulary's pattern and each match is merged by
itself. A segment tree over the match's byte positions holds, at each leaf,
the rank of the pair that begins there, and at each inner node the leftmost
smallest of its leaves; the root is the next merge. A merge takes a position
out of the list of live ones and updates the leaves of the two live
neighbours, each by one walk up the tree.

Matches repeat, so each worker remembers the ids of recent ones, up to a
bound. New ones of up to 64 bytes are merged side by side, one tree to a row
of an array; longer ones one by one. The vocabulary (a few MB at most) is
broadcast.

Defined cases: a null text counts as empty and gives no ids; a null array of
ids decodes to no bytes; repeated rows are coded alike; a very long text is
split and coded whole; an empty table gives no rows; further columns stay,
except that columns with the name of a result are replaced.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from vertexloom.llm.common import give_back, small_batches, table

VOCABULARY = "byte_bpe_50k.tiktoken"
REMEMBERED = 100_000
#: Matches of more bytes are merged one by one; so many shorter ones side by side; texts are split so many code points at a time.
WIDEST, SIDE_BY_SIDE, TOGETHER = 64, 4_096, 1_000_000
#: No pair of live neighbours begins here.
NONE = 1 << 62


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one match: merge the leftmost pair of the smallest rank until no pair has a rank."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    width = 1 << (n - 1).bit_length()
    end = list(range(1, n + 1))  # where the part that begins at a live position ends
    before = list(range(-1, n - 1))  # the live position to its left
    tree = [NONE] * (2 * width)
    get = ranks.get
    for i in range(n - 1):
        rank = get(piece[i : i + 2])
        if rank is not None:
            tree[width + i] = rank << 32 | i
    for k in range(width - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b

    def put(i: int, value: int) -> None:
        k = width + i
        tree[k] = value
        k >>= 1
        while k:
            a, b = tree[2 * k], tree[2 * k + 1]
            best = a if a < b else b
            if tree[k] == best:
                break
            tree[k] = best
            k >>= 1

    def pair(i: int) -> int:
        j = end[i]
        rank = get(piece[i : end[j]]) if j < n else None
        return NONE if rank is None else rank << 32 | i

    while tree[1] != NONE:
        i = tree[1] & 0xFFFFFFFF
        j = end[i]
        end[i] = end[j]
        if end[i] < n:
            before[end[i]] = i
        put(j, NONE)
        put(i, pair(i))
        if i:
            put(before[i], pair(before[i]))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = end[i]
    return ids


class ByteBpe:
    """Encoder and decoder of texts for one worker."""

    def __init__(self, vocabulary: bytes, pattern: str, remembered: int = REMEMBERED):
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.numerals = {rank: str(rank) for rank in self.tokens}
        self.split_any = regex.compile(pattern).findall
        # In an ASCII text the classes of letters and digits are these, and the plainer matcher is faster.
        self.split_ascii = re.compile(pattern.replace(r"[^\s\p{L}\p{N}]", "[^\\sA-Za-z0-9]").replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]"), re.A).findall
        left, right, merged = array("i"), array("i"), array("i")
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        pairs = np.array(left, np.int64) << 32 | np.array(right, np.int64)
        order = np.argsort(pairs)
        self.pairs, self.pair_rank = pairs[order], np.array(merged, np.int64)[order]
        self.byte_rank = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.known: dict[str, tuple[int, ...]] = {}
        self.remembered = remembered

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of parts, NONE where they don't merge."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.pair_rank[at], NONE >> 8)

    def _merge_rows(self, pieces: list[bytes], width: int) -> list[tuple[int, ...]]:
        """Ids of matches of at most ``width`` bytes: each row of ``tree`` is one match's segment tree."""
        size = np.array([len(p) for p in pieces])
        part = self.byte_rank[np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)]
        place = np.arange(width)
        end = np.where(place + 1 < size[:, None], place + 1, width)
        before = np.tile(place - 1, (len(pieces), 1))
        live = place < size[:, None]
        tree = np.full((len(pieces), 2 * width), NONE)
        first = np.where(end[:, :-1] < width, self._ranks_of(part[:, :-1], part[:, 1:]), NONE >> 8)
        tree[:, width:-1] = first << 8 | place[:-1]
        for k in range(width - 1, 0, -1):
            tree[:, k] = np.minimum(tree[:, 2 * k], tree[:, 2 * k + 1])
        rows = np.flatnonzero(tree[:, 1] < NONE - 256)
        while len(rows):
            best = tree[rows, 1]
            i, merged = best & 255, best >> 8
            j = end[rows, i]
            after = end[rows, j]
            part[rows, i], end[rows, i], live[rows, j] = merged, after, False
            more, left = after < width, before[rows, i]
            before[rows[more], after[more]] = i[more]
            here = np.full(len(rows), NONE >> 8)
            here[more] = self._ranks_of(merged[more], part[rows[more], after[more]])
            some = left >= 0
            there = self._ranks_of(part[rows[some], left[some]], merged[some])
            tree[rows, width + j] = NONE
            tree[rows, width + i] = here << 8 | i
            tree[rows[some], width + left[some]] = there << 8 | left[some]
            for own, leaf in ((rows, j), (rows, i), (rows[some], left[some])):
                k = (width + leaf) >> 1
                for _ in range(width.bit_length() - 1):
                    tree[own, k] = np.minimum(tree[own, 2 * k], tree[own, 2 * k + 1])
                    k = k >> 1
            rows = rows[tree[rows, 1] < NONE - 256]
        ids, ends = part[live].tolist(), np.cumsum(live.sum(1)).tolist()
        return [tuple(ids[a:b]) for a, b in zip([0, *ends], ends)]  # noqa: B905

    def _learn(self, new: list[str]) -> None:
        by_width: dict[int, list[str]] = {}
        for piece in new:
            coded = piece.encode()
            if coded in self.ranks:
                self.known[piece] = (self.ranks[coded],)
            elif len(coded) > WIDEST:
                self.known[piece] = tuple(merge(coded, self.ranks))
            else:
                by_width.setdefault(1 << (len(coded) - 1).bit_length(), []).append(piece)
        for width, pieces in by_width.items():
            for at in range(0, len(pieces), SIDE_BY_SIDE):
                some = pieces[at : at + SIDE_BY_SIDE]
                self.known.update(zip(some, self._merge_rows([p.encode() for p in some], width), strict=True))

    def encode_all(self, texts: list[str]) -> Iterator[list[int]]:
        """Ids of each text; the matches that are new in all of them are merged together."""
        if len(self.known) > self.remembered:
            self.known.clear()
        split = [(self.split_ascii if text.isascii() else self.split_any)(text) for text in texts]
        known = self.known
        self._learn([piece for piece in dict.fromkeys(chain.from_iterable(split)) if piece not in known])
        for pieces in split:
            yield list(chain.from_iterable(map(known.__getitem__, pieces)))

    def encode(self, text: str) -> list[int]:
        return next(self.encode_all([text]))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def together(texts: Iterator[str]) -> Iterator[list[str]]:
    """Texts in runs of about TOGETHER code points."""
    run, size = [], 0
    for text in texts:
        run.append(text)
        size += len(text)
        if size >= TOGETHER:
            yield run
            run, size = [], 0
    if run:
        yield run


def vocabulary_file(name: str = VOCABULARY) -> tuple[str, str]:
    """Path and pattern of a vocabulary of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def _mapped(df: DataFrame, source: str, path: str | None, pattern: str | None, schema: str, rows, keep: list[str] | None = None) -> DataFrame:
    """``keep`` or else all columns of ``df``, and what ``rows(coder, values of source)`` gives for each row."""
    spark = df.sparkSession
    small_batches(spark)
    own_path, own_pattern = vocabulary_file()
    shared, pattern = spark.sparkContext.broadcast(Path(path or own_path).read_bytes()), pattern or own_pattern
    made = T.StructType.fromDDL(schema)
    keep = [c for c in keep or df.columns if c not in made.names]
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32())}
    types = [kinds[f.dataType.simpleString()] for f in made]
    result = T.StructType([*df.select(*keep).schema, *made])
    # The source goes along once: as a kept column, or else as the last one.
    columns = keep if source in keep else [*keep, source]
    at, n, names = columns.index(source), len(keep), result.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = ByteBpe(shared.value, pattern)
        for batch in batches:
            out = list(rows(coder, (value.as_py() for value in batch.column(at))))
            arrays = zip(*out, strict=True) if out else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *[pa.array(v, t) for v, t in zip(arrays, types, strict=True)]], names=names)
        del coder
        give_back()

    return df.select(*columns).mapInArrow(run, result)


def _encoded(coder: ByteBpe, texts: Iterator[str | None]) -> Iterator[tuple]:
    for some in together(text or "" for text in texts):
        for ids in coder.encode_all(some):
            yield (ids,)


def _decoded(coder: ByteBpe, coded: Iterator[list[int] | None]) -> Iterator[tuple]:
    for ids in coded:
        yield (coder.decode(ids or []),)


def encode(docs: DataFrame, text_col: str = "text", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``docs`` with token_ids, an array of the text's ids."""
    return _mapped(docs, text_col, path, pattern, "token_ids array<int>", _encoded)


def decode(coded: DataFrame, ids_col: str = "token_ids", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``coded`` with decoded, the bytes that its ids stand for."""
    return _mapped(coded, ids_col, path, pattern, "decoded binary", _decoded)


def _checked(coder: ByteBpe, texts: Iterator[str | None]) -> Iterator[tuple]:
    for some in together(text or "" for text in texts):
        for text, ids in zip(some, coder.encode_all(some), strict=True):
            yield ids, coder.decode(ids) == text.encode()


def encode_checked(docs: DataFrame, text_col: str = "text", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``docs`` with token_ids and round_trip, whether they decode to the text; both in one pass of one worker."""
    return _mapped(docs, text_col, path, pattern, "token_ids array<int>, round_trip boolean", _checked)


def _digests(coder: ByteBpe, texts: Iterator[str | None]) -> Iterator[tuple]:
    for (ids,) in _encoded(coder, texts):
        numerals = " ".join(map(coder.numerals.__getitem__, ids))
        yield len(ids), hashlib.sha256(numerals.encode()).hexdigest(), hashlib.sha256(coder.decode(ids)).hexdigest()


def code_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Per document: n_tokens, the digest of its ids and of what they decode to; ids stay in the worker."""
    return _mapped(docs, text_col, path, pattern, "n_tokens long, ids_sha256 string, decoded_sha256 string", _digests, keep=[id_col])


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_digests(table(spark, sf_dir, "documents"))
