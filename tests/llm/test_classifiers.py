"""Language ID and toxicity: plain versions of what they compute, held-out accuracy, awkward tables."""

import math
import random
import re
import zlib

import numpy as np
import pytest
from oracle import SF_DIR
from test_corpus import AWKWARD, docs_of

from vertexloom.llm import language_id, toxicity

LANGUAGES = {"en": "the and with house of", "de": "der und nicht haus von", "fr": "le et avec maison de"}


def texts_in(lang, n, seed=0):
    rnd = random.Random(seed + len(lang))
    return [" ".join(rnd.choice(LANGUAGES[lang].split()) for _ in range(rnd.randrange(3, 40))) for _ in range(n)]


def labelled(spark, rows):
    """Documents of (id, text, lang), with columns whose names clash with results."""
    return spark.createDataFrame([(i, t, g, "old", 0.5, True) for i, t, g in rows], "doc_id long, text string, lang string, lang_pred string, score double, held_out boolean")


def plain_prediction(languages, text):
    """Language and score by loops over bits and languages."""
    if not text or not any(c.isalpha() for c in text) or not languages.names:
        return "und", 0.0, False
    blanked = b" " + b" ".join("".join(chr(b) if b >= 128 or chr(b).isalpha() else " " for b in text.lower().encode()).encode("latin-1").split()) + b" "
    counts = {}
    for n, factor in ((2, 2654435761), (3, 2246822519)):
        for i in range(len(blanked) - n + 1):
            value = 0
            for b in blanked[i : i + n]:
                value = value * 257 + b
            at = (value * factor) % 2**32 >> 20
            counts[at] = counts.get(at, 0) + 1
    total = sum(counts.values())
    losses = []
    for k in range(len(languages.names)):
        loss = 0.0
        for bit in range(languages.code.shape[1]):
            margin = float(languages.offset[bit]) + sum(math.sqrt(c / total) * float(languages.slope[at, bit]) for at, c in counts.items())
            loss += float(languages.weight[k, bit]) * math.log1p(math.exp(-float(languages.code[k, bit]) * margin))
        losses.append(loss)
    least = min(losses)
    second = sorted(losses)[1]
    return languages.names[losses.index(least)], 1 / sum(math.exp(least - v) for v in losses), second - least < language_id.AMBIGUOUS * second


def test_decoding_against_loops(spark):
    rows = [(i, t, g) for g in LANGUAGES for i, t in enumerate(texts_in(g, 30), 100 * len(g) + len(LANGUAGES[g]))]
    languages = language_id.learn(labelled(spark, rows))
    assert languages.names == sorted(LANGUAGES) and np.allclose(languages.weight.sum(1), languages.code.shape[1])
    asked = [*texts_in("en", 5, 9), *texts_in("fr", 5, 9), "the haus le", "É", "x" * 30_000, "", None, "12 $"]
    got = {r.doc_id: r for r in language_id.predicted(docs_of(spark, list(enumerate(asked))), languages).collect()}
    for i, text in enumerate(asked):
        lang, score, ambiguous = plain_prediction(languages, text)
        assert got[i].lang_pred == lang and abs(got[i].score - score) < 1e-3, text
        assert got[i].ambiguous == ambiguous and got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)


def test_given_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    languages = language_id.learn(docs)
    rows = language_id.predicted(docs, languages).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert language_id.learn(docs.filter("doc_id < 0")).predict("text") == ("und", 0.0, False)


def test_languages_without_letters(spark):
    good = [(i, t, g) for g in ("en", "de") for i, t in enumerate(texts_in(g, 20), 1000 if g == "en" else 2000)]
    bad = [(i, "12345 678", "zxx") for i in range(20)]
    asked = docs_of(spark, [(1, "the and with the house"), (2, "der und nicht")])

    def predict(rows):
        languages = language_id.learn(labelled(spark, rows))
        return languages.names, [(r.lang_pred, 0 <= r.score <= 1) for r in language_id.predicted(asked, languages).orderBy("doc_id").collect()]

    assert predict([*good, *bad]) == (["de", "en"], [("en", True), ("de", True)])
    assert predict([*good[:20], *bad]) == (["en"], [("en", True)] * 2)
    assert predict([*bad, *[(50 + i, "?", "zyy") for i in range(20)]]) == ([], [("und", True)] * 2)
    assert predict([]) == ([], [("und", True)] * 2)


def test_languages_awkward_rows(spark):
    rows = [*[(i, t, "en") for i, t in AWKWARD], *[(77, "le et avec maison", "fr")] * 5, (None, "le et", None), *[(200 + i, t, g) for g in ("en", "fr") for i, t in enumerate(texts_in(g, 15, len(g)))]]
    docs = labelled(spark, rows)
    out = language_id.predicted(docs, language_id.learn(docs))
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score", "ambiguous"]
    got = out.collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got) and all(r.held_out for r in got if r.doc_id is None)
    assert len({(r.lang_pred, r.score) for r in got if r.doc_id == 77}) == 1


def test_every_language_of_very_many_is_learnt(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(1000 * k + i, " ".join([letters[k % 26] * 2 + letters[k // 26] * 3] * 5), f"l{k:03}") for k in range(300) for i in range(4)]
    assert len(language_id.learn(labelled(spark, rows), per_label=2, most_rows=600).names) > 256
    many = language_id.codewords(9)
    assert min(int((a != b).sum()) for i, a in enumerate(many) for b in many[:i]) >= 5


def test_toxicity_learns_words_and_their_parts():
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choice("ba de ki lo mu ne".split()) for _ in range(rnd.randrange(1, 4)))

    def text(toxic):
        return " ".join(rnd.choice(["awful", "zgrk" + word()]) if toxic and rnd.random() < 0.08 else word() for _ in range(rnd.randrange(20, 150)))

    rows = [{"text": text(i % 2), "toxic": i % 2} for i in range(500)]
    network = toxicity.train(rows, rounds=6)
    scores = np.array(list(network.scores(text(i % 2) for i in range(200))))
    assert np.mean((scores >= toxicity.THRESHOLD) == np.arange(200) % 2) > 0.85
    assert all(0 <= s <= 1 for s in network.scores(["", None, "!!", "awful " * 20_000]))
    assert list(toxicity.train([]).scores(["a"])) == [0.0]
    assert list(toxicity.train([{"text": "a", "toxic": 1}]).scores(["a"])) == [1.0]


def test_toxicity_gradients():
    """Slopes by hand against slopes by difference."""
    network = toxicity.Network([b"aa", b"bb"])
    words, index = [b"aa", b"bb", b"cc"], np.array([[i % 3 for i in range(toxicity.WINDOW)], [2, 1] + [3] * (toxicity.WINDOW - 2)])
    for k in network.weights:
        network.weights[k] = network.weights[k].astype(np.float64)
    target, each = np.array([1.0, 0.0]), np.array([0.5, 0.7])

    def loss():
        vectors = network.inputs(words)[0]
        logit = network.logits(*[network.projected(vectors, d).astype(np.float64) for d in "fb"], index, 3)
        return float((each * np.logaddexp(0, np.where(target > 0, -logit, logit))).sum())

    slopes = network.gradients(words, index, target, each)
    for k in ("word", "gram", "attend", "out", "bias", "in_f", "in_b", "rec_f", "rec_b", "off_f", "off_b"):
        flat = network.weights[k].reshape(-1)
        at = int(np.abs(slopes[k]).argmax())
        old, step = flat[at], 1e-2
        flat[at] = old + step
        high = loss()
        flat[at] = old - step
        low = loss()
        flat[at] = old
        assert abs((high - low) / (2 * step) - slopes[k].reshape(-1)[at]) < 0.02 * max(abs(slopes[k].reshape(-1)[at]), 1e-3) + 1e-4


def toxic_tables(spark, n=240):
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("ba de ki lo mu ne".split()) for _ in range(rnd.randrange(1, 4)))
    docs = [(i, " ".join("zgrkaw" if i % 2 and rnd.random() < 0.3 else word() for _ in range(rnd.randrange(10, 60)))) for i in range(n)]
    labels = [(i, 0, i % 2) for i in range(0, n, 1) if i % 5]
    return docs, labels


def test_toxicity_of_tables(spark):
    docs, labels = toxic_tables(spark)
    marks = [*labels, (1, 0, 0), (1, 0, 0), (None, 0, 1), (4000, 0, 1), (2, None, None), (3, 0, 7)]
    clashing = spark.createDataFrame([(i, t, "old", 0.25, True, 9) for i, t in [*docs, *AWKWARD, (None, "zgrkaw"), (9, "zgrkaw"), (9, "zgrkaw")]], "doc_id long, text string, lang string, score double, held_out boolean, predicted int")
    labelled_rows = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    network = toxicity.learn(clashing, labelled_rows)
    out = toxicity.scored(clashing, network)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.collect()
    assert len(rows) == clashing.count()
    assert all(r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    plain = [(i, float(s)) for (i, t) in [(r.doc_id, r.text) for r in clashing.collect()] for s in network.scores([t])]
    assert all(abs(a - b) < 1e-3 for (_, a), (_, b) in zip(sorted(((r.doc_id, r.score) for r in rows), key=str), sorted(plain, key=str), strict=True))
    assert np.mean([r.predicted == r.doc_id % 2 for r in rows if r.doc_id is not None and 20 < r.doc_id < 240]) > 0.9
    kept = toxicity.drop_toxic(clashing, network)
    assert kept.columns == clashing.columns and {(r.score, r.held_out, r.predicted) for r in kept.collect()} == {(0.25, True, 9)}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in rows if not r.predicted)


@pytest.mark.parametrize("texts", [[None, "", " ", "12 $"], []])
def test_toxicity_without_words(spark, texts):
    docs = docs_of(spark, [(i, texts[i % len(texts)]) for i in range(40) if texts])
    labels = spark.createDataFrame([(i, 0, i // 4 % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    scores = {round(r.score, 6) for r in toxicity.scored(docs_of(spark, AWKWARD), toxicity.learn(docs, labels)).collect()}
    assert len(scores) == 1 and 0 <= scores.pop() <= 1


def test_toxicity_where_some_have_no_words(spark):
    docs, labels = toxic_tables(spark, 60)
    docs = [(i, "" if i % 4 < 2 else t) for i, t in docs]
    network = toxicity.learn(docs_of(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert all(0 <= s <= 1 for s in network.scores([None, "", "zgrkaw", "é" * 100_000, "ba " * 100_000]))


def test_toxicity_sample_is_bounded_in_bytes(spark):
    docs, labels = toxic_tables(spark, 60)
    drawn = []
    own, toxicity.train = toxicity.train, lambda rows: drawn.extend(rows) or own([])
    try:
        toxicity.learn(docs_of(spark, [*docs[1:], (0, "long " * 100_000)]), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), most_bytes=8000)
    finally:
        toxicity.train = own
    assert drawn and sum(len(r["text"]) for r in drawn) <= 8000 and max(len(r["text"]) for r in drawn) <= 400


def plain_score(network, text):
    """A text's score word by word and place by place: both recurrent passes, attention, all windows."""
    w, sigmoid = network.weights, lambda x: 1 / (1 + math.exp(-x))
    dim = toxicity.STATE
    words = [bytes(b + 32 if 65 <= b <= 90 else b for b in v.encode()) for v in re.findall(r"(?:[A-Za-z]|[^\x00-\x7f])+", text or "")]

    def vector(word):
        marked, grams = b"^" + word + b"$", []
        for n in toxicity.GRAM_SIZES:
            for i in range(len(marked) - n + 1):
                h = n
                for b in marked[i : i + n]:
                    h = (h * 1_000_003 + b) % 2**64
                grams.append((h * 0x9E3779B97F4A7C15 % 2**64) >> (64 - toxicity.GRAM_BITS))
        return [*w["word"][network.known.get(word, 0)].tolist(), *[sum(float(w["gram"][g][k]) for g in grams) / math.sqrt(len(grams)) for k in range(toxicity.GRAM_DIM)]]

    def passed(vectors, d):
        h, states = [0.0] * dim, []
        for x in vectors if d == "f" else vectors[::-1]:
            into = [sum(x[i] * float(w[f"in_{d}"][i][k]) for i in range(len(x))) + float(w[f"off_{d}"][k]) for k in range(3 * dim)]
            back = [sum(h[i] * float(w[f"rec_{d}"][i][k]) for i in range(dim)) for k in range(3 * dim)]
            z = [sigmoid(into[k] + back[k]) for k in range(dim)]
            r = [sigmoid(into[dim + k] + back[dim + k]) for k in range(dim)]
            n = [math.tanh(into[2 * dim + k] + r[k] * back[2 * dim + k]) for k in range(dim)]
            h = [z[k] * h[k] + (1 - z[k]) * n[k] for k in range(dim)]
            states.append(h)
        return states if d == "f" else states[::-1]

    logits, start = [], 0
    while True:
        vectors = [vector(v) for v in words[start : start + toxicity.WINDOW]]
        states = [f + b for f, b in zip(passed(vectors, "f"), passed(vectors, "b"), strict=True)]
        attention = [math.exp(sum(s[k] * float(w["attend"][k]) for k in range(2 * dim))) for s in states]
        pool = [sum(a * s[k] for a, s in zip(attention, states, strict=True)) / sum(attention) if states else 0.0 for k in range(2 * dim)]
        logits.append(sum(pool[k] * float(w["out"][k]) for k in range(2 * dim)) + float(w["bias"][0]))
        if start + toxicity.WINDOW >= len(words):
            break
        start += toxicity.STRIDE
    return sigmoid(max(logits) * network.scale[0] + sum(logits) / len(logits) * network.scale[1] + network.shift)


def test_toxicity_scores_word_by_word():
    rng = random.Random(4)
    words = ["a", "bad", "Word", "é", "ÉTÉ", "x1y", "日本", "don't", "longerword"]
    network = toxicity.Network([b"bad", b"word", "é".encode()], seed=3)
    network.weights["bias"][0], network.scale, network.shift = 0.3, np.array([1.5, -0.7]), 0.2
    for name in ("off_f", "off_b"):
        network.weights[name] += np.random.default_rng(1).normal(0, 0.5, network.weights[name].shape).astype(np.float32)
    network._forget()
    texts = [None, "", "12 !", "bad", *[" ".join(rng.choices(words, k=k)) for k in (2, 31, 32, 33, 56, 57, 100)]]
    got = list(network.scores(texts))
    assert got == pytest.approx([plain_score(network, t) for t in texts], abs=2e-5)
    assert len({round(s, 4) for s in got}) > 6
