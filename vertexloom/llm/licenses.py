"""License scans: notice phrases and identifier tags by Aho-Corasick, licence expressions by a shunting-yard parser.

A text's words are its runs of letters, digits and characters beyond ASCII,
A-Z in lower case. One automaton over all phrases and tags reads the words,
one blank between any two, and reports every place where a phrase's words
stand one after another. Of the operator's own phrases those that lie within
a longer one aren't reported; base phrases always are.

Where a tag is found, the expression behind its colon is read: as much of it
as is a whole expression, ``with`` before ``and`` before ``or``. It is turned
into postfix order by a shunting yard and evaluated: of ``and`` the strictest
terms hold, of ``or`` the mildest, and a known exception makes terms milder
by one step. Its licences' labels and those of its exceptions are the text's.

The score is that of the strongest finding: 1 for an expression whose every
name is known, 1/2 for another, and for a phrase of w words 1 - 1/2^(w-1).

Each row is scanned by itself, so nothing is shuffled. Defined cases: a null
text counts as empty and has no words, no labels and score 0; a very long
text is read in pieces that overlap by a phrase; an expression of any depth
or length is parsed without recursion, in linear time; repeated rows give
the same; a null id stays null; an empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vertexloom.llm.common import give_back, small_batches, table, text_of

# Phrases, the labels of licence families with how free their terms are, and exceptions.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
NOTICES = {
    "affero general public license": "agpl",
    "boost software license": "bsl",
    "bsd license": "bsd",
    "cc by": "cc-by",
    "cc by nc": "cc-by-nc",
    "cc by nc nd": "cc-by-nc-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "eclipse public license": "epl",
    "isc license": "isc",
    "lesser general public license": "lgpl",
    "library general public license": "lgpl",
    "mozilla public license": "mpl",
    "permission is hereby granted free of charge": "mit",
    "permission to use copy modify and or distribute this software": "isc",
    "redistribution and use in source and binary forms": "bsd",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "zlib license": "zlib",
}
TAGS = ("spdx license identifier", "license expression")
RESTRICTED, WEAK, FREE = 1, 2, 3
TERMS = {
    "0bsd": FREE, "agpl": RESTRICTED, "apache": FREE, "bsd": FREE, "bsl": FREE, "cc-by": FREE, "cc-by-nc": RESTRICTED, "cc-by-nc-nd": RESTRICTED, "cc-by-nc-sa": RESTRICTED, "cc-by-nd": RESTRICTED, "cc-by-sa": WEAK,
    "cc0": FREE, "cddl": WEAK, "epl": WEAK, "eupl": WEAK, "gpl": RESTRICTED, "isc": FREE, "lgpl": WEAK, "mit": FREE, "mpl": WEAK, "ofl": WEAK, "unlicense": FREE, "zlib": FREE,
}
EXCEPTIONS = ("bison-exception", "classpath-exception", "font-exception", "gcc-exception", "linux-syscall-note", "llvm-exception", "openjdk-assembly-exception")

#: A byte to what it is in words: A-Z in lower case, a-z, 0-9 and all of other characters as they are, the rest blank.
BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: Bytes of text that are cut into words together.
PIECE = 1 << 20
RANKS = {"or": 0, "and": 1, "with": 2}
TOKEN = re.compile(rb"[ \t]*([()]|[a-z0-9.+-]+)")
TAG = re.compile(rb"(?<![0-9a-z\x80-\xff])(?:" + b"|".join(re.escape(t.replace(" ", "-").encode()) for t in TAGS) + rb")[ \t]*:")


@dataclass(frozen=True)
class Terms:
    """What an expression comes to: its labels, how free it is (0: not known), whether all its names are known."""

    labels: frozenset[str]
    free: int
    known: bool


def tokens_of(text: bytes, at: int) -> list[str]:
    """The longest run of tokens from a place on that is a whole expression."""
    tokens: list[str] = []
    whole, depth, wanted = 0, 0, True
    while token := TOKEN.match(text, at):
        word, at = token[1].decode(), token.end()
        if wanted:
            if word == ")" or word in RANKS:
                break
            depth, wanted = depth + (word == "("), word == "("
        elif word == ")":
            if not depth:
                break
            depth -= 1
        elif word in RANKS:
            wanted = True
        else:
            break
        tokens.append(word)
        if not wanted and not depth:
            whole = len(tokens)
    return tokens[:whole]


def postfix(tokens: list[str]) -> list[str]:
    """The shunting yard: operands as they come, an operator after all that bind as strongly or more."""
    out, held = [], []
    for token in tokens:
        if token == "(":
            held.append(token)
        elif token == ")":
            while held[-1] != "(":
                out.append(held.pop())
            held.pop()
        elif token in RANKS:
            while held and held[-1] != "(" and RANKS[held[-1]] >= RANKS[token]:
                out.append(held.pop())
            held.append(token)
        else:
            out.append(token)
    return out + held[::-1]


def _named(name: str) -> Terms:
    """A licence, by its family, or an exception; a version and what is behind it don't count."""
    family = name if name in TERMS or name in EXCEPTIONS else re.sub(r"(-|v)[0-9].*$|\+$", "", name)
    if family in TERMS:
        return Terms(frozenset([family]), TERMS[family], True)
    return Terms(frozenset([family] if family in EXCEPTIONS else []), 0, family in EXCEPTIONS)


def evaluated(order: list[str]) -> Terms:
    """Terms of an expression in postfix order. Labels are gathered beside the stack, so that long expressions take linear time."""
    labels: set[str] = set()
    known, stack = True, []
    for token in order:
        if token not in RANKS:
            found = _named(token)
            labels |= found.labels
            known &= found.known
            stack.append(found)
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":
            free = min(FREE, left.free + 1) if left.free and right.labels and not right.free else left.free
        else:
            free = (min if token == "and" else max)(left.free, right.free)
        stack.append(Terms(frozenset(), free, True))
    return Terms(frozenset(labels), stack[0].free, known)


class Phrases:
    """An automaton over base phrases, notices and tags."""

    def __init__(self, base: dict[str, str], notices: dict[str, str]):
        import ahocorasick

        self.phrases = [*base, *[p for p in notices if p not in base], *TAGS]
        self.n_base, self.tags = len(base), range(len(self.phrases) - len(TAGS), len(self.phrases))
        self.words = np.array([p.count(" ") + 1 for p in self.phrases])
        self.automaton = ahocorasick.Automaton()
        for i, phrase in enumerate(self.phrases):
            self.automaton.add_word(f" {phrase} ", i)
        self.automaton.make_automaton()

    def places(self, text: bytes) -> tuple[int, np.ndarray, np.ndarray]:
        """Number of words, and for each place of a phrase its first word and its number, in order."""
        n, kept, cleaned, at = 0, [], text.translate(BYTES), 0
        starts: list[np.ndarray] = []
        which: list[np.ndarray] = []
        while at < len(cleaned):
            end = cleaned.find(b" ", at + PIECE)
            end = len(cleaned) if end < 0 else end
            words = kept + cleaned[at:end].split()
            at, before = end, n - len(kept)
            joined = b" " + b" ".join(words) + b" "
            hits = list(self.automaton.iter(joined.decode("latin-1")))
            if hits:
                number = np.array([i for _, i in hits])
                last = np.searchsorted(np.flatnonzero(np.frombuffer(joined, np.uint8) == 32), [e for e, _ in hits]) - 1
                new = last >= len(kept)  # a place that ends in what was kept has been reported
                starts.append((last - self.words[number] + 1 + before)[new])
                which.append(number[new])
            n += len(words) - len(kept)
            kept = words[-(int(self.words.max()) - 1) :]
        if not starts:
            return n, np.empty(0, np.int64), np.empty(0, np.int64)
        start, number = np.concatenate(starts), np.concatenate(which)
        order = np.lexsort((number, start))
        return n, start[order], number[order]

    def reported(self, start: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Which places count: base phrases, and own ones that don't lie within a longer own one; tags don't."""
        base = number < self.n_base
        own = np.flatnonzero(~base & (number < self.tags[0]))
        own = own[np.lexsort((-self.words[number[own]], start[own]))]
        ends = start[own] + self.words[number[own]]
        reach = np.maximum.accumulate(np.concatenate(([0], ends)))[:-1]
        out = base.copy()
        out[own[ends > reach]] = True
        return out


def expressions(text: bytes) -> Iterator[tuple[int, list[str]]]:
    """The first word of each tag in a text, A-Z in lower case, and its expression's tokens; tags without one are passed over."""
    words = None
    for tag in TAG.finditer(text):
        tokens = tokens_of(text, tag.end())
        if tokens:
            if words is None:
                inside = np.frombuffer(text.translate(BYTES), np.uint8) != 32
                words = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
            yield int(np.searchsorted(words, tag.start())), tokens


EXPRESSION = pa.struct([("word", pa.int64()), ("text", pa.string()), ("labels", pa.list_(pa.string())), ("free", pa.int32()), ("known", pa.bool_())])


def scan(docs: DataFrame, base: dict[str, str] = BASE, notices: dict[str, str] = NOTICES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: the id, n_words, ``bases`` and ``notices`` (arrays of first word and label), ``expressions`` (first word of the tag, text, labels, how free its terms are from 1 to 3 or 0, whether all its names are known) and score."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col), text_of(F.col(text_col)).cast("binary").alias("__text"))
    place = pa.struct([("word", pa.int64()), ("label", pa.string())])
    names = [id_col, "n_words", "bases", "notices", "expressions", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Phrases(base, notices)
        labels = [base.get(p) or notices[p] for p in finder.phrases[: finder.tags[0]]]
        weights = 1 - 0.5 ** (finder.words - 1.0)

        def listed(start: np.ndarray, number: np.ndarray, ends: list[int]) -> pa.Array:
            values = pa.StructArray.from_arrays([pa.array(start, pa.int64()), pa.array(labels, pa.string()).take(pa.array(number, pa.int64()))], names=["word", "label"])
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)

        for batch in batches:
            n_words, found, scores, both = [], [], [], ([[], [], [0]], [[], [], [0]])
            for text in batch.column(1):
                raw = text.as_py()
                n, start, number = finder.places(raw)
                tagged = [(word, tokens, evaluated(postfix(tokens))) for word, tokens in expressions(raw.lower())] if (number >= finder.tags[0]).any() else []
                counts = finder.reported(start, number)
                for (starts, numbers, ends), own in zip(both, (number < finder.n_base, counts & (number >= finder.n_base)), strict=True):
                    starts.append(start[own])
                    numbers.append(number[own])
                    ends.append(ends[-1] + int(own.sum()))
                n_words.append(n)
                found.append([{"word": word, "text": " ".join(tokens), "labels": sorted(terms.labels), "free": terms.free, "known": terms.known} for word, tokens, terms in tagged])
                scores.append(max([float(weights[number[counts]].max(initial=0.0)), *[1.0 if terms.known else 0.5 for _, _, terms in tagged]]))
            lists = [listed(np.concatenate([np.empty(0, np.int64), *starts]), np.concatenate([np.empty(0, np.int64), *numbers]), ends) for starts, numbers, ends in both]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), *lists, pa.array(found, pa.list_(EXPRESSION)), pa.array(scores, pa.float64())], names=names)
        give_back()

    kind, places = docs.schema[id_col].dataType.simpleString(), "array<struct<word:long,label:string>>"
    found = "array<struct<word:long,text:string,labels:array<string>,free:int,known:boolean>>"
    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_words long, bases {places}, notices {places}, expressions {found}, score double")


def joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, own = F.col("bases.label"), F.concat("bases.label", "notices.label", F.flatten("expressions.labels"))
    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        F.size("bases").cast("long").alias("n_base"),
        F.array_min("bases.word").alias("first_word"),
        F.array_max("bases.word").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(own).alias("labels"),
        "score",
        F.array_join("expressions.text", "; ").alias("expressions"),
    )
