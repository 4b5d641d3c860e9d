"""License scans against brute force."""

import random
import re

import pytest

from vertexloom.llm import licenses, registry

SCHEMA = "doc_id long, text string, lang string, source string, labels string, score int"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def tree(tokens):
    """An expression by recursive descent: (operator, left, right) or a name."""

    def level(at, operators):
        if not operators:
            if tokens[at] == "(":
                inner, at = level(at + 1, ["or", "and", "with"])
                return inner, at + 1
            return tokens[at], at + 1
        left, at = level(at, operators[1:])
        while at < len(tokens) and tokens[at] == operators[0]:
            right, after = level(at + 1, operators[1:])
            left, at = (operators[0], left, right), after
        return left, at

    return level(0, ["or", "and", "with"])[0]


def value(node):
    if isinstance(node, str):
        found = licenses._named(node)
        return found.labels, found.free, found.known
    (ll, lf, lk), (rl, rf, rk) = value(node[1]), value(node[2])
    free = {"or": max(lf, rf), "and": min(lf, rf)}.get(node[0])
    if node[0] == "with":
        free = min(3, lf + 1) if lf and isinstance(node[2], str) and rl and not rf else lf
    return ll | rl, free, lk and rk


def base_places(text):
    words = WORD.findall(lowered(text or ""))
    return len(words), sorted((i, label) for phrase, label in licenses.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split())


TEXTS = [
    None, "", " \n", "MIT License", "mit-license; the MIT\nLICENSE!", "mit license mit license mit license", "smit license", "mit licenses", "émit license", "mit é license", "Apache License and GNU General Public License, the MIT License.",
    "GNU Lesser General Public License", "under CC BY-NC-SA 4.0", "cc by", "SPDX-License-Identifier: MIT", "// SPDX-License-Identifier: (GPL-2.0-only WITH Linux-syscall-note) OR BSD-3-Clause */", "x SPDX-License-Identifier: Apache-2.0 WITH LLVM-exception AND Foo-1.0",
    "xSPDX-License-Identifier: MIT", "SPDX License Identifier: MIT", "License-Expression: mit and (isc or gpl-3.0+) and more words", "SPDX-License-Identifier: )(", "SPDX-License-Identifier: MIT OR (BSD", "x" * 50_000, "word " * 20_000 + "mit license",
]


@pytest.mark.parametrize("piece", [licenses.PIECE, 7])
def test_query(spark, tmp_path, monkeypatch, piece):
    monkeypatch.setattr(licenses, "PIECE", piece)
    rng = random.Random(2)
    made = [" ".join(rng.choices(["mit", "MIT", "license", "apache", "general", "public", "é", "9", "-"], k=rng.randint(0, 60))) for _ in range(200)]
    texts = [*TEXTS, *made, made[0]]
    spark.createDataFrame([(i if i % 50 else None, t, "en", "s", "old", 7) for i, t in enumerate(texts)], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(((r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in registry.queries()["op11_license_scan"](spark, str(tmp_path)).collect()), key=str)
    want = []
    for text in texts:
        n, places = base_places(text)
        want.append((n, len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(sorted({label for _, label in places}))))
    assert got == sorted(want, key=str)


def test_labels(spark):
    rows = licenses.scan(spark.createDataFrame([(i, t, "en", "s", "old", 7) for i, t in enumerate(TEXTS)], SCHEMA))
    assert rows.columns == ["doc_id", "n_words", "bases", "notices", "expressions", "score"]
    found = {r.doc_id: ([b.label for b in r.bases], [(p.word, p.label) for p in r.notices], [(e.word, e.text, e.labels, e.free, e.known) for e in r.expressions], r.score) for r in rows.collect()}
    at = {t: i for i, t in enumerate(TEXTS)}
    assert found[at["GNU Lesser General Public License"]] == (["gpl"], [(1, "lgpl")], [], 0.875)
    assert found[at["under CC BY-NC-SA 4.0"]] == ([], [(1, "cc-by-nc-sa")], [], 0.875)
    assert found[at["cc by"]] == ([], [(0, "cc-by")], [], 0.5)
    assert found[at["SPDX-License-Identifier: MIT"]] == ([], [], [(0, "mit", ["mit"], 3, True)], 1.0)
    assert found[at["// SPDX-License-Identifier: (GPL-2.0-only WITH Linux-syscall-note) OR BSD-3-Clause */"]][2] == [(0, "( gpl-2.0-only with linux-syscall-note ) or bsd-3-clause", ["bsd", "gpl", "linux-syscall-note"], 3, True)]
    assert found[at["x SPDX-License-Identifier: Apache-2.0 WITH LLVM-exception AND Foo-1.0"]][2:] == ([(1, "apache-2.0 with llvm-exception and foo-1.0", ["apache", "llvm-exception"], 0, False)], 0.5)
    assert found[at["License-Expression: mit and (isc or gpl-3.0+) and more words"]][2] == [(0, "mit and ( isc or gpl-3.0+ ) and more", ["gpl", "isc", "mit"], 0, False)]
    assert found[at["SPDX-License-Identifier: MIT OR (BSD"]][2] == [(0, "mit", ["mit"], 3, True)]
    for none in ("xSPDX-License-Identifier: MIT", "SPDX License Identifier: MIT", "SPDX-License-Identifier: )("):
        assert found[at[none]][2] == []
    assert found[0] == ([], [], [], 0.0)


def test_expressions():
    rng = random.Random(4)
    names = ["mit", "gpl-2.0-only", "mpl-2.0", "foo", "classpath-exception-2.0", "apache-2.0"]

    def made(depth):
        if depth == 0 or rng.random() < 0.3:
            return rng.choice(names)
        inner = f"{made(depth - 1)} {rng.choice(['and', 'or', 'with'])} {made(depth - 1)}"
        return f"({inner})" if rng.random() < 0.5 else inner

    for _ in range(300):
        text = made(4)
        tokens = licenses.tokens_of(text.encode(), 0)
        assert "".join(tokens) == text.replace(" ", "")
        got = licenses.evaluated(licenses.postfix(tokens))
        assert (got.labels, got.free, got.known) == value(tree(tokens))
    deep = "(" * 20_000 + "mit" + ")" * 20_000 + " or gpl" * 20_000
    got = licenses.evaluated(licenses.postfix(licenses.tokens_of(deep.encode(), 0)))
    assert (got.labels, got.free, got.known) == ({"mit", "gpl"}, 3, True)
