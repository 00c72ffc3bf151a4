import hashlib
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from modelvigil.llm import pii
from tests.llm.frames import clashing, documents


def plain_luhn(digits):
    doubled = [2 * int(d) if i % 2 else int(d) for i, d in enumerate(digits[::-1])]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def plain_base(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and plain_luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
    ]
    found = [(m.start(), n, k, m.end()) for n, (k, p, ok) in enumerate(kinds) for m in re.finditer(p, text) if ok(m)]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(found)]


CASES = [
    (1, None), (2, ""), (3, "write to jo.doe+x@mail.example.com, or a@b.c@d.e"), (3, "write to jo.doe+x@mail.example.com, or a@b.c@d.e"),
    (4, "é 10.0.0.255 and 10.0.0.256 and 1.2.3.4.5.6.7.8 and 001.002.003.0000004"), (5, "4539 1488 0343 6467 or 4539-1488-0343-6468"),
    (6, "+1 (555) 010-2030, +49 30 1234567 8, +1, +123456789 +12345678901234567890"), (7, "@ @@ a@ @b.c a@b a@b. a@b..c .@-.-"),
    (None, "x@y.zz"), (8, "4" * 5_000 + "."), (9, "no data at all, no digits"),
]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "Z", "1", "42", "255", "256", ".", "@", "+", "-", " ", "(", ")", "%", "_", "é", "4539148803436467"]), max_size=30))
def test_base_spans_by_definition(parts):
    text = "".join(parts)
    assert [f"{k}:{a}:{b}" for a, b, k in pii.base_spans(text)] == plain_base(text)


def test_long_texts_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "1 " * 150_000, "+1" + "(" * 300_000, "a@" * 150_000, "a@b." * 75_000, "(at)" * 75_000, "1,2 " * 75_000):
        began = time.time()
        pii.base_spans(text)
        pii.candidates(text)
        assert time.time() - began < 10


def test_spans_of_odd_rows(spark):
    docs = clashing(documents(spark, CASES))
    rows = pii.personal_spans(docs, pii.learn(docs)).collect()
    by_text = dict(CASES)
    assert len(rows) == len(CASES)
    for r in rows:
        base = plain_base(by_text[r.doc_id] or "")
        kinds = [s.split(":")[0] for s in base]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(map(kinds.count, pii.BASE))
        spans = r.spans.split(",") if r.spans else []
        assert [s for s in spans if s.split(":")[0] in pii.BASE] == base and len(spans) == len(base) + r.n_added
    none = documents(spark, [])
    assert pii.personal_spans(none, pii.learn(none)).count() == 0


def test_trees_learn_and_calibrate():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(3_000, 5))
    labels = ((rows[:, 0] > 0) ^ (rows[:, 1] > 0.5)).astype(float)
    model = pii.fit(rows[:2_000], labels[:2_000])
    scores = model.score(rows[2_000:])
    assert ((scores > 0) == labels[2_000:]).mean() > 0.95
    assert model.score(rows[:0]).shape == (0,)
    cut = pii.threshold(scores, labels[2_000:])
    assert labels[2_000:][scores >= cut].mean() > 0.95 and (scores >= cut).sum() > 300
    assert pii.threshold(rng.normal(size=500), (np.arange(500) % 2).astype(float)) == float("inf")
    assert pii.threshold(np.zeros(0), np.zeros(0)) == float("inf")


@given(st.lists(st.integers(0, 1), max_size=12))
def test_isotonic_is_the_nearest_rising_sequence(labels):
    got = pii.isotonic(np.array(labels, dtype=float))
    # Max-min formula of the nearest rising sequence.
    n = len(labels)
    want = [max(min(np.mean(labels[a : b + 1]) for b in range(i, n)) for a in range(i + 1)) for i in range(n)]
    assert np.allclose(got, want)


@pytest.fixture(scope="module")
def model(spark):
    return pii.learn(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


def test_data_in_other_forms_is_found(model):
    def found(text):
        base = pii.base_spans(text)
        return [text[a:b] for a, b, _ in base + model.added([text], [base])[0]]

    for before, datum, after in [
        ("call me on ", "1 (487) 555-7209", " tomorrow"), ("write to ", "jo.doe (at) mail3.example.com", " please"),
        ("write to ", "jo.doe at mail dot example dot com", " please"), ("from ", "97[.]51[.]17[.]173", " again"),
        ("pay with ", "4929.3483.8514.6306", " now"),
    ]:
        assert found(before + datum + after) == [datum]
    for text in ("id 473696257 in the log", "on 2024-11-05 at 12:30", "some 1,234,567.89 of 10 000 000", "page 12, 13, 14, 15", "look at the dot in it"):
        assert found(text) == []


def test_held_out_candidates_and_clean_documents(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = pii.personal_spans(docs, model).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    clean = [r for r in rows if not plain_base(texts[r.doc_id] or "")]
    assert len(clean) > 500 and sum(r.n_added > 0 for r in clean) <= 0.002 * len(clean)
    hits = total = 0
    for text in texts.values():
        for start, end, kind in pii.base_spans(text or ""):
            if kind in ("email", "ip"):
                datum = text[start:end].replace("@", " @ ") if kind == "email" else text[start:end].replace(".", "[.]")
                shown = text[max(0, start - 40) : start] + datum + text[end : end + 40]
                base = pii.base_spans(shown)
                hits += any(shown[a:b] == datum for a, b, _ in model.added([shown], [base])[0])
                total += 1
    assert total > 20 and hits >= 0.9 * total


def test_redaction():
    text = "mail a@b.cc or +1 555 010 2030."
    assert pii.redacted(text, pii.base_spans(text)) == "mail <email> or <phone>."
    assert pii.redacted("", []) == ""


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = pii.op12_pii(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.base_sha256 == hashlib.sha256(",".join(plain_base(texts[r.doc_id] or "")).encode()).hexdigest()
