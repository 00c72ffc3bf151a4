import math
import zlib

import numpy as np
import pytest

from modelvigil.llm import language, ngrams, toxicity
from tests.llm.frames import clashing, documents

SF = "/root/testdata/sf0.1"


def held(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_char_ngrams_count_every_gram():
    for text in ("", "a", "Ab", "Straße ab ab", "漢字\U0001f600x" * 50):
        lower = text.lower()
        grams = [lower[i : i + n] for n in (1, 2, 3) for i in range(len(lower) - n + 1)]
        keys = []
        for gram in grams:
            key = 0
            for c in gram:
                key = (key << 21 | ord(c)) % 2**64
            keys.append(key)
        want = np.bincount(ngrams.slots(np.array(keys, dtype=np.uint64), 14), minlength=1 << 14)
        assert (ngrams.char_ngrams(text, 3, 14) == want).all()


def test_word_features_depend_on_words_alone():
    one, other = (ngrams.word_features(t, (4,), 20) for t in ("Alpha, beta; gamma", "gamma\nbeta alpha ALPHA"))
    assert one.tolist() == other.tolist() and len(one) == 6
    assert len(ngrams.word_features("", (4,), 20)) == len(ngrams.word_features(" .,!", (4,), 20)) == 0
    shared = set(ngrams.word_features("prefixone", (4, 5), 20)) & set(ngrams.word_features("x prefixtwo", (4, 5), 20))
    assert len(shared) == 2
    assert len(ngrams.word_features("word " * 50_000, (4, 5), 20)) == 2  # no fifth letter


def test_risk_is_non_negative_and_its_gradient_right():
    rng = np.random.default_rng(1)
    for prior, shift in ((0.1, 0.0), (0.6, 3.0)):
        p, u = rng.normal(size=6) + shift, rng.normal(size=9) - shift
        value, below, by_p, by_u = toxicity.risk(p, u, prior)
        assert value >= 0 and below == (prior == 0.6)
        if not below:
            for n in range(6):
                step = np.eye(6)[n] * 1e-6
                assert by_p[n] == pytest.approx((toxicity.risk(p + step, u, prior)[0] - value) / 1e-6, abs=1e-4)
            for n in range(9):
                step = np.eye(9)[n] * 1e-6
                assert by_u[n] == pytest.approx((toxicity.risk(p, u + step, prior)[0] - value) / 1e-6, abs=1e-4)


def test_elastic_net_leaves_weights_out_and_temperature_softens():
    rng = np.random.default_rng(2)
    rows = rng.normal(size=(300, 40)).astype(np.float32)
    labels = (rows[:, 3] > 0).astype(int)
    sample = language.Sample([np.arange(40)] * 300, list(rows), 40)
    weights, bias = language.fit(sample, labels, 2)
    assert np.allclose(sample.take(np.arange(5)).logits(weights, bias), rows[:5] @ weights.T + bias, atol=1e-5)
    assert ((rows @ weights.T + bias).argmax(axis=1) == labels).mean() > 0.95
    noisy = np.where(rng.random(300) < 0.2, 1 - labels, labels)
    logits = np.stack([np.where(labels == 0, 9.0, 0.0), np.where(labels == 1, 9.0, 0.0)], axis=1)
    t = language.temperature(logits, noisy)
    assert language.softmax(logits / t).max(axis=1).mean() == pytest.approx((noisy == labels).mean(), abs=0.03)


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def language_model(tables):
    return language.learn(tables[0])


def test_language_on_held_out_documents(spark, tables, language_model):
    rows = language.op6_language(spark, SF).collect()
    truth = {r.doc_id: r.lang for r in tables[0].select("doc_id", "lang").collect()}
    assert len(rows) == len(truth)
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    apart = [r for r in rows if r.held_out and truth[r.doc_id]]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in apart]) > 0.99
    assert (language_model.weights == 0).mean() > 0.2


ODD = [
    (1, None), (2, ""), (3, "12 34 !!"), (4, "the and of the tion ing"), (4, "the and of the tion ing"), (None, "der die das und"),
    (5, "漢字"), (6, "und der " * 40_000), (7, "ª"),
]


def test_language_of_odd_rows(spark, language_model):
    docs = clashing(documents(spark, ODD))
    rows = language.with_language(docs, language_model).collect()
    assert len(rows) == len(ODD)
    got = {r.doc_id: r for r in rows}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and got[1].score == 0
    assert all(got[i].lang_pred != "und" for i in (4, 5, 6, 7, None)) and got[None].held_out
    assert language.with_language(documents(spark, []), language_model).count() == 0


def test_language_with_nothing_to_learn_from(spark):
    docs = documents(spark, [(1, "text", None), (2, None, "en"), (None, "text", "en")])
    model = language.learn(docs)
    assert {tuple(r)[2:] for r in language.with_language(docs, model).collect()} == {("und", 0.0)}
    one = documents(spark, [(i, f"same language {i}", "en") for i in range(9)])
    assert {r.lang_pred for r in language.with_language(one, language.learn(one)).collect()} == {"en"}
    assert language.learn(documents(spark, [])).languages == []


def test_language_learns_from_labels_of_the_other_folds_only(spark):
    rows = [(i, f"alpha beta {i}" if i % 2 else f"omega psi {i}", "aa" if i % 2 else "bb") for i in range(200)]
    changed = [(i, t, "zz" if held(i) else lang) for i, t, lang in rows]
    one, other = (language.learn(documents(spark, r)) for r in (rows, changed))
    assert one.languages == other.languages == ["aa", "bb"] and (one.weights == other.weights).all()


def test_repeated_ids_neither_fill_nor_shrink_the_samples(spark, monkeypatch):
    seen = {}

    def spy(module):
        plain = module.fit

        def fit(first, *rest):
            seen[module] = (first, *rest)
            return plain(first, *rest)

        monkeypatch.setattr(module, "fit", fit)

    spy(language)
    spy(toxicity)
    ids = [i for i in range(3_000) if not held(i)]
    rows = [(i, f"some words {i} of text {k}", "en") for i in ids for k in range(6)]
    rows += [(ids[0], f"quelques mots {k}", "fr") for k in range(3_000)]
    docs = documents(spark, rows)
    language.learn(docs, per_language=300)
    assert len(seen[language][0]) == 301 - 301 // language.CALIBRATION
    labels = spark.createDataFrame([(ids[0], 1), (ids[1], 1), (ids[2], 0)], "doc_id long, toxic int")
    toxicity.learn(docs, labels, unlabelled=300)
    assert [len(part) for part in seen[toxicity][:2]] == [2, 300]


def test_rejected_languages_go(spark, tables):
    docs = clashing(tables[0].limit(1500).unionByName(documents(spark, ODD)))
    kept = language.identified(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) > 1450


def test_documents_stay_when_no_language_can_be_learnt(spark):
    docs = documents(spark, [(1, "some text", None), (2, "12 34", None), (3, None, None), (None, "other text", "en")])
    assert {r.text for r in language.identified(docs).collect()} == {"some text", "other text"}


def test_toxicity_on_held_out_documents(spark, tables):
    rows = toxicity.op5_toxicity(spark, SF).collect()
    assert len(rows) == tables[0].count()
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    truth = {r.doc_id: r.toxic for r in tables[1].collect()}
    apart = [r for r in rows if r.held_out and truth.get(r.doc_id) is not None]
    found = [r.predicted for r in apart if truth[r.doc_id] == 1]
    wrong = [r.predicted for r in apart if truth[r.doc_id] == 0]
    assert np.mean(found) > 0.8 and np.mean(wrong) < 0.01


def test_toxicity_of_odd_rows(spark, tables):
    model = toxicity.learn(*tables)
    rows = toxicity.scored(clashing(documents(spark, ODD)), model).collect()
    assert len(rows) == len(ODD) and all(r.predicted == 0 for r in rows)
    assert toxicity.scored(documents(spark, []), model).count() == 0


def test_toxicity_with_nothing_to_learn_from(spark):
    docs = documents(spark, ODD)
    labels = spark.createDataFrame([(None, 1, 1), (1, None, None), (4, 1, 0)], "doc_id long, quality int, toxic int")
    for some in (labels, labels.limit(0)):
        assert {r.predicted for r in toxicity.scored(docs, toxicity.learn(docs, some)).collect()} == {0}


def test_toxicity_ignores_held_out_labels(spark, tables):
    docs, labels = (t.where("doc_id < 600") for t in tables)
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 3 = 1, 1 - toxic, toxic) as toxic")
    one, other = (toxicity.learn(docs, some) for some in (labels, flipped))
    assert (one.weights == other.weights).all() and one.bias == other.bias


MASK = (1 << 64) - 1


def plain_slot(key, bits):
    return (key * 0x9E3779B97F4A7C15 & MASK) >> (64 - bits)


def plain_ngrams(text):
    points = list(map(ord, text.lower()))
    counts = {}
    for n in (1, 2, 3):
        for i in range(len(points) - n + 1):
            key = 0
            for p in points[i : i + n]:
                key = (key << 21 | p) & MASK
            slot = plain_slot(key, language.BITS)
            counts[slot] = counts.get(slot, 0) + 1
    return counts


def test_language_query_by_plain_computation(spark):
    """Document frequencies and every score of the table, worked out again in plain Python."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = docs.collect()
    model = language.learn(docs)
    taught = [r for r in rows if not held(r.doc_id) and r.lang is not None and r.text is not None]
    assert model.languages == sorted({r.lang for r in taught})
    frequency = {}
    for r in taught:
        for slot in plain_ngrams(r.text):
            frequency[slot] = frequency.get(slot, 0) + 1
    for slot in range(0, 1 << language.BITS, 37):
        want = math.log((1 + len(taught)) / (1 + frequency.get(slot, 0))) + 1
        assert model.idf[slot] == pytest.approx(want, rel=1e-5)
    got = {r.doc_id: r for r in language.op6_language(spark, folder).collect()}
    assert len(got) == len(rows)
    for r in rows:
        assert got[r.doc_id].held_out == held(r.doc_id)
        if not any(map(str.isalpha, r.text or "")):
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == ("und", 0.0)
            continue
        values = {slot: math.log1p(n) * float(model.idf[slot]) for slot, n in plain_ngrams(r.text).items()}
        size = math.sqrt(sum(v * v for v in values.values()))
        logits = [
            (sum(float(w[slot]) * v for slot, v in values.items()) / size + float(b)) / model.temperature
            for w, b in zip(model.weights, model.bias)
        ]
        odds = [math.exp(x - max(logits)) for x in logits]
        best = odds.index(max(odds))
        assert got[r.doc_id].lang_pred == model.languages[best]
        assert got[r.doc_id].score == pytest.approx(odds[best] / sum(odds), abs=1e-4)


def plain_words(text):
    base, found, word = 0x100000001B3, set(), []
    for p in [*map(ord, text.lower()), 32]:
        if 48 <= p < 58 or 97 <= p < 123 or p >= 0xC0:
            word.append(p)
            continue
        if word:
            keys = [sum(p * pow(base, i, 1 << 64) for i, p in enumerate(word)) & MASK]
            for length in toxicity.PREFIXES:
                if len(word) >= length:
                    keys.append(sum(p * pow(base, i, 1 << 64) for i, p in enumerate(word[:length])) + length & MASK)
            found.update(plain_slot(key, toxicity.BITS) for key in keys)
        word = []
    return found


def test_toxicity_query_by_plain_computation(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    model = toxicity.learn(docs, labels)
    got = {r.doc_id: r for r in toxicity.op5_toxicity(spark, folder).collect()}
    rows = docs.collect()
    assert len(got) == len(rows) and any(r.predicted for r in got.values())
    for r in rows:
        total = sum(float(model.weights[slot]) for slot in plain_words(r.text or "")) + model.bias
        score = 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))
        own = got[r.doc_id]
        assert own.held_out == held(r.doc_id) and own.score == pytest.approx(score, abs=1e-4)
        assert own.predicted == int(own.score >= 0.7)
