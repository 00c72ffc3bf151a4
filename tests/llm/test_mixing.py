import math
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from modelvigil.llm import language, mixing, packing, secrets, simhash
from modelvigil.llm.queries import ORACLES, QUERIES
from tests.compare import connect, differences
from tests.llm.frames import clashing, documents


def sized(spark, totals):
    return spark.createDataFrame([(k, float(v)) for k, v in totals.items()], "source_key string, total double")


def entropy(totals, a):
    powers = [v**a for v in totals.values()]
    return -sum(p / sum(powers) * math.log(p / sum(powers)) for p in powers)


TOTALS = {"a": 4_000, "b": 300, "c": 25, "d": 25}


@pytest.mark.parametrize("repeat", [1.0, 1.5, 4.0, 40.0, 1e9])
def test_exponent_meets_the_repetition_limit(spark, repeat):
    a = mixing.exponent(sized(spark, TOTALS), repeat=repeat)
    want = max(0.0, 1 - math.log(repeat) / math.log(4_000 / 25))
    assert a == pytest.approx(want, abs=1e-9)
    assert (4_000 / 25) ** (1 - a) <= repeat * (1 + 1e-9)


@pytest.mark.parametrize("share", [0.0, 0.3, 0.9, 1.0])
def test_exponent_meets_the_entropy(spark, share):
    low, high = entropy(TOTALS, 1), entropy(TOTALS, 0)
    target = low + share * (high - low)
    a = mixing.exponent(sized(spark, TOTALS), entropy=target)
    assert entropy(TOTALS, a) == pytest.approx(target, abs=1e-6)
    assert mixing.exponent(sized(spark, TOTALS), entropy=high + 1) == 0
    assert mixing.exponent(sized(spark, TOTALS), entropy=low - 1) == 1


def test_repeat_below_one_is_refused(spark):
    with pytest.raises(ValueError):
        mixing.exponent(sized(spark, TOTALS), repeat=0.5)


def rows_of(n=600):
    hot = [(i, "w " * (1 + i % 7), None, "hot") for i in range(n)]
    return hot + [(10_000 + i, "v " * 3, None, None) for i in range(60)] + [(20_000 + i, None, None, "empty") for i in range(20)]


def test_mix_keeps_every_document_and_its_quota(spark):
    docs = clashing(documents(spark, rows_of()))
    rows = mixing.mix(docs, repeat=2.0, block_docs=50, block_words=200).collect()
    copies = Counter(r.row.doc_id for r in rows)
    assert set(copies) == {d for d, *_ in rows_of()}
    assert len({(r.row.doc_id, r.copy) for r in rows}) == len(rows)
    sizes = {d: 1 + len((t or "").split()) for d, t, *_ in rows_of()}
    sources = {d: s for d, _, _, s in rows_of()}
    totals, got = Counter(), Counter()
    for d, size in sizes.items():
        totals[sources[d]] += size
        got[sources[d]] += size * copies[d]
    a = 1 - math.log(2) / math.log(max(totals.values()) / min(totals.values()))
    for source, total in totals.items():
        quota = total * (total / max(totals.values())) ** (a - 1)
        assert quota - 9 <= got[source] <= quota + 1
    assert max(copies.values()) == 2 and all(copies[d] == 1 for d in sizes if sources[d] == "hot")
    # Every mixed block holds the sources in like proportions.
    by_block = defaultdict(Counter)
    for r in rows:
        by_block[r.block][r.row.source] += sizes[r.row.doc_id]
    assert len(by_block) > 10
    for words in list(by_block.values())[:-1]:
        assert abs(words["hot"] / sum(words.values()) - got["hot"] / sum(got.values())) < 0.1


def test_mix_with_a_budget_cuts_sources_short(spark):
    rows = mixing.mix(documents(spark, rows_of()), repeat=1.0, budget=1_000, block_docs=50).collect()
    used = sum(1 + len((r.row.text or "").split()) for r in rows)
    assert 950 <= used <= 1_003 and max(Counter(r.row.doc_id for r in rows).values()) == 1


def test_mix_of_odd_rows(spark):
    odd = [(None, None), (None, "a"), (1, "b b"), (1, "b b"), (2, "c " * 50_000, "en", "x"), (3, "", None, "")]
    docs = clashing(documents(spark, odd))
    rows = mixing.mix(docs).collect()
    assert {(r.row.doc_id, r.row.text) for r in rows} == {(o[0], o[1]) for o in odd}
    assert sum(r.copy == 0 for r in rows) == len(odd)
    assert mixing.mixed_documents(docs).columns == docs.columns
    assert mixing.mixed_documents(documents(spark, [])).count() == 0
    assert mixing.mix(documents(spark, [])).columns == ["row", "copy", "block", "place"]


def test_mix_has_no_python_in_its_plan(spark):
    plan = mixing.op10_mixing(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_query_agrees_with_sql(spark, scale):
    folder = f"/root/testdata/{scale}"
    assert differences(spark, connect(folder), folder, QUERIES["op10_mixing"], ORACLES["op10_mixing"]) is None


def test_pipeline_stages(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        stage(spark, docs, folder).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = kept[name] = docs.collect()
        if name == "language":
            model = language.learn(spark.createDataFrame(before, docs.schema))
            good = [r for r in before if (p := model.predict(r.text))[0] != "und" and p[1] >= language.LEAST_SCORE]
            assert sorted(after) == sorted(good) and len(good) > 0.9 * len(before)
        elif name == "simhash":
            first = {}
            prints = [(r.doc_id, simhash.fingerprint(r.text)) for r in before]
            from tests.llm.test_near_duplicates import plain_groups

            first = {c for _, _, c in plain_groups(prints)}
            assert sorted(after) == sorted(r for r in before if r.doc_id in first)
        elif name == "secrets":
            encoding = secrets.vocabulary(secrets.default_path("byte_bpe_50k.tiktoken"))
            assert sorted((r.doc_id, r.text, r.n_chars) for r in after) == sorted(
                (r.doc_id, t, len(t)) for r in before for t in [secrets.masked(r.text, encoding)]
            )
        elif name == "mixing":
            assert {r.doc_id for r in after} == {r.doc_id for r in before}
            assert set(after) == set(before) and max(Counter(r.doc_id for r in after).values()) <= 2
        else:
            tokens = Counter()
            for r in after:
                tokens[r.doc_id] += r.length
            copies = Counter(r.doc_id for r in before)
            size = {r.doc_id: r.doc_tokens for r in after}
            assert tokens == Counter({d: n * size[d] for d, n in copies.items()})
        if name != "packing":
            assert docs.columns == columns
    assert corpus_pipeline.run(spark, folder).count() == len(kept["packing"])
    assert corpus_pipeline.ORACLE_SQL is None and packing.TIERS[0] == 2048


def test_pipeline_stages_with_odd_rows(spark):
    odd = [(None, None), (1, None), (2, ""), (3, "the and of that " * 30_000), (4, "the and of"), (4, "the and of"), (5, "the and of")]
    for rows in (odd, []):
        docs = documents(spark, rows)
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, "/root/testdata/sf0.001").count() >= 0
