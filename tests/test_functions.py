import math
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from modelvigil.functions import checks, draws, text
from modelvigil.functions.divergence import kl, psi, psi_band
from modelvigil.functions.probability import with_softmax_choice


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def evaluated(spark, values, expression, kind="string"):
    return [r[0] for r in column(spark, values, kind).coalesce(1).select(expression(F.col("x"))).collect()]


TEXTS = [None, "", "    ", "\t\n\t\n\t\n", "       ", "abcd", " abcd\t", "abcde", " x abcde y ", "\x1c\x1d ab ", "　äöüßé　", "🙂🙂🙂🙂"]


def test_strip_is_python_strip(spark):
    assert evaluated(spark, TEXTS, text.strip) == [None if t is None else t.strip() for t in TEXTS]


def test_blank_texts(spark):
    want = [t is None or len(t.strip()) < 5 for t in TEXTS]
    assert evaluated(spark, TEXTS, lambda c: text.is_blank(c, 5)) == want


def test_truncate_counts_code_points(spark):
    assert evaluated(spark, ["🙂äb🙂c", "ab", None], lambda c: text.truncate(c, 3)) == ["🙂äb", "ab", None]


def test_replace_first_literal(spark):
    values = ["the theme", "a.the", "none", "", "theend the"]
    assert evaluated(spark, values, lambda c: text.replace_first(c, "the", "teh")) == [
        v.replace("the", "teh", 1) for v in values
    ]


def test_first_label_of_the_vocabulary_wins(spark):
    vocabulary = ["Hardware", "Access_Account", "Email"]
    raw = ["EMAIL or hardware", "it is access account", "access_account!", "nothing", "", None]
    assert evaluated(spark, raw, lambda c: text.normalize_prediction(c, vocabulary)) == [
        "Hardware", "Access_Account", "Access_Account", "INVALID", "INVALID", "INVALID",
    ]


def test_chat_prompt(spark):
    got = evaluated(spark, ["hi {system}"], lambda c: text.format_chat("S", c))[0]
    assert got == "<|im_start|>system\nS<|im_end|>\n<|im_start|>user\nhi {system}<|im_end|>\n<|im_start|>assistant\n"


def reference_psi(b, c, eps=1e-4):
    b, c = np.maximum(b, eps), np.maximum(c, eps)
    return float(((c - b) * np.log(c / b)).sum())


def reference_kl(b, c, eps=1e-4):
    b, c = np.maximum(b, eps), np.maximum(c, eps)
    b, c = b / b.sum(), c / c.sum()
    return float((c * np.log(c / b)).sum())


def test_divergences(spark):
    rng = np.random.default_rng(7)
    pairs = [(rng.dirichlet(np.ones(8)), rng.dirichlet(np.ones(8))) for _ in range(30)]
    pairs += [(p, p) for p, _ in pairs[:3]]
    pairs += [(np.eye(8)[0], np.eye(8)[1]), (np.full(8, 1 / 8), np.zeros(8))]
    rows = [(i, [float(x) for x in b], [float(x) for x in c]) for i, (b, c) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "i int, b array<double>, c array<double>")
    got = {r.i: (r.p, r.k) for r in df.select("i", psi(F.col("b"), F.col("c")).alias("p"), kl(F.col("b"), F.col("c")).alias("k")).collect()}
    for i, (b, c) in enumerate(pairs):
        assert got[i][0] == pytest.approx(reference_psi(b, c), abs=1e-12)
        assert got[i][1] == pytest.approx(reference_kl(b, c), abs=1e-12)
        assert got[i][0] >= 0 and got[i][1] >= -1e-15


def test_psi_bands(spark):
    assert evaluated(spark, [0.0, 0.0999, 0.1, 0.25, 0.2501, None], psi_band, "double") == [
        "none", "none", "moderate", "moderate", "significant", None,
    ]


def test_softmax_over_everything_choice_among_some(spark):
    scores = [[0.5, 9.0, 2.0, 2.0], [1000.0, 1.0, 999.0, 0.0]]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(scores)], "i int, s array<double>")
    got = with_softmax_choice(df, "s", [2, 3, 0], ["c", "d", "a"]).orderBy("i").collect()
    assert [r.predicted for r in got] == ["c", "a"]
    mass = sum(math.exp(x - 9) for x in scores[0])
    assert got[0].confidence == pytest.approx(math.exp(2.0 - 9) / mass)
    assert got[1].confidence == pytest.approx(math.exp(0) / (1 + math.exp(-1) + math.exp(-999)))


def test_checks_run_in_order(spark):
    rows = [
        (1, None, "UNSET", "fax"), (2, "long enough", "P1", None), (3, "long enough", None, "web"),
        (4, "  abc  ", "P2", "web"), (5, "long enough", "UNSET", "web"),
    ]
    df = spark.createDataFrame(rows, "id int, body string, priority string, origin string")
    rules = [checks.check_null_text("body"), checks.check_sentinel("priority"), checks.check_enum("origin", ["web"])]
    found = df.select("id", checks.validate(rules).alias("i")).select(
        "id", "i", checks.issue_types(F.col("i")).alias("t"), checks.has_blocking(F.col("i")).alias("b")
    )
    got = {r.id: r for r in found.collect()}
    assert got[1].t == "null_or_empty_text,silent_default_priority,schema_violation_source_system" and got[1].b
    assert [i.value for i in got[1].i] == [None, "UNSET", "fax"]
    assert got[2].t == "" and not got[2].b and got[2].i == []
    assert got[3].t == "" and got[4].t == "null_or_empty_text" and got[5].t == "silent_default_priority"


def test_draws_are_reproducible_and_even(spark):
    df = spark.range(20_000).select("id", draws.draw(F.col("id"), 1).alias("u"))
    first = {r.id: r.u for r in df.collect()}
    assert first == {r.id: r.u for r in df.repartition(7).collect()}
    values = np.array(list(first.values()))
    assert 0 <= values.min() and values.max() < 1 and abs(values.mean() - 0.5) < 0.02


def test_whitespace_constant_is_complete():
    every = {chr(c) for c in range(0x110000) if chr(c).isspace()}
    assert set(text.WHITESPACE) == every and unicodedata.category("\xa0") == "Zs"
