import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from modelvigil.llm import spelling
from tests.llm.frames import clashing, documents


def apart_by_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_counts(docs, every=97):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 3 and len(w) >= 5}


def brute(docs, every=97):
    words = brute_counts(docs, every)
    deleted = {}
    for w in words:  # two words are near only if they share a form with at most one code point less
        for form in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            deleted.setdefault(form, []).append(w)
    near = {w: set() for w in words}
    for group in deleted.values():
        for a in group:
            near[a].update(b for b in group if apart_by_one(a, b))
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n, len(near[w]), words.get(form[w]) or 0) for w, n in words.items())


def got(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in df.collect())


CHAIN = " ".join(" ".join([w] * n) for w, n in [("colour", 3), ("colou", 6), ("colous", 12), ("colose", 24), ("colosse", 48), ("kolosse", 96)])
CASES = [
    (1, None), (2, ""), (3, CHAIN), (None, "Straße strasse Strase STRASE strase Straße Straße strasse strasse"), (4, "x" * 120_000),
    (5, "×÷×÷× " * 3 + "naïve naive naives " * 4), (5, "naïve naive naives " * 4), (6, "two words " * 3),
    (7, "words wordz swords word " * 5 + "Words's words-wordz" * 2), (8, "中文 cafés cafes CAFÉS " * 3), (9, "\U0001d400letters letters " * 3),
]


def test_odd_texts(spark):
    docs = clashing(documents(spark, CASES))
    assert got(spelling.variants(docs)) == brute(CASES)
    assert got(spelling.variants(docs, symbols=1)) == brute(CASES)
    assert spelling.variants(documents(spark, [])).count() == 0
    assert spelling.variants(documents(spark, [(1, None), (2, "few words")])).count() == 0


def test_deleted_letters(spark):
    docs = [(i, "sentence paragraph document") for i in range(400)]
    rows = got(spelling.variants(documents(spark, docs)))
    assert rows == brute(docs)
    counts = {}
    for i, text in docs:
        for word, n in spelling.runs(i, text, every=3):
            counts[word] = counts.get(word, 0) + n
    assert {w: n for w, n in counts.items() if n >= 3} == brute_counts(docs, 3) and len(counts) > 20


@settings(max_examples=200, deadline=None)
@given(st.text("abcéÿ", min_size=1, max_size=7), st.integers(1, 5))
def test_neighbourhoods_are_whole(word, symbols):
    row = spelling.reduced([word], symbols)
    own = tuple(row[0].tolist())
    every = {own}
    for i in range(len(own) + 1):
        every |= {own[:i] + (s,) + own[i:] for s in range(1, symbols + 1)}
        if i < len(own):
            every |= {own[:i] + own[i + 1 :]} | {own[:i] + (s,) + own[i + 1 :] for s in range(1, symbols + 1)}
    want = sorted(int(spelling.keys(np.array([w], dtype=np.uint64))[0]) if w else 0 for w in every)
    found, owners = spelling.neighbourhood(row, symbols)
    assert sorted(found.tolist()) == want and not owners.any()


def test_filter_holds_every_slot(spark):
    slots = [0, 1, 7, 8, 32_767, 32_768, 99_999, 2**20 - 1]
    known = spelling.filter_of(spark.createDataFrame([(s,) for s in slots * 2], "slot long"), 20)
    assert np.flatnonzero(np.unpackbits(known, bitorder="little")).tolist() == slots


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query(spark, folder):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert got(spelling.op13_spelling(spark, folder)) == brute(docs)
