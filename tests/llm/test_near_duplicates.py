import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from modelvigil.llm import simhash
from tests.llm.frames import clashing, documents


def plain_print(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    counts = Counter()
    for shingle in shingles:
        h = xxhash.xxh64(shingle.encode(), seed=42).intdigest()
        counts.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b, n in counts.items() if 2 * n > len(shingles))


def plain_groups(rows):
    """(doc_id, print) -> smallest doc_id reachable."""
    nodes = [(d, p) for d, p in rows if d is not None]
    prints = sorted({p for _, p in nodes})
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    values = np.array(prints, dtype=np.uint64)
    for p in prints:
        for q in values[np.bitwise_count(values ^ np.uint64(p)) <= 3].tolist():
            root[find(q)] = find(p)
    low = {}
    for d, p in nodes:
        low[find(p)] = min(d, low.get(find(p), d))
    return sorted(((d, f"{p:016x}", None if d is None else low[find(p)]) for d, p in rows), key=str)


WORDS = [f"word{i}" for i in range(400)]


def variants(n, seed):
    rng = np.random.default_rng(seed)
    base = [" ".join(rng.choice(WORDS, 220)) for _ in range(6)]
    out = []
    for i in range(n):
        words = base[i % 6].split()
        for _ in range(int(rng.integers(0, 4))):
            words[int(rng.integers(len(words)))] = "changed"
        out.append((i, " ".join(words)))
    return out


CASES = [
    (9, None), (4, ""), (6, " \t\n"), (1, "One"), (2, "one"), (3, "ÄÖ one"), (5, "a b c"), (5, "a b c"), (7, "A  b\x0bc\x1f"),
    (None, "a b c"), (8, "long " * 70_000), *[(100 + i, "the same words for all of them") for i in range(50)],
]


def test_fingerprint_by_definition():
    for _, text in CASES + variants(30, 1):
        assert simhash.fingerprint(text) == plain_print(text)


@pytest.mark.parametrize("rows", [CASES, variants(240, 2), []])
def test_groups(spark, rows):
    docs = clashing(documents(spark, rows))
    got = sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=str)
    assert got == plain_groups([(d, plain_print(t)) for d, t in rows])


@pytest.mark.parametrize("piece", [8_192, 7])
def test_links_of_large_buckets_are_not_lost(spark, piece):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, size=4, dtype=np.uint64)
    prints = base[rng.integers(0, 4, 600)]
    for _ in range(4):  # chains within a common upper half
        prints = np.where(rng.random(600) < 0.6, prints ^ (np.uint64(1) << rng.integers(0, 32, 600, dtype=np.uint64)), prints)
    prints = np.unique(prints)
    df = spark.createDataFrame([(int(p.view(np.int64)),) for p in prints], "print long")
    root = {int(p): int(p) for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for r in simhash.near_links(df, piece=piece).collect():
        root[find(r.u & (2**64 - 1))] = find(r.v & (2**64 - 1))
    got = {frozenset(p for p in root if find(p) == top) for top in {find(p) for p in root}}
    low = {d: c for d, _, c in plain_groups([(i, int(p)) for i, p in enumerate(prints)])}
    want = {frozenset(int(prints[i]) for i in low if low[i] == top) for top in set(low.values())}
    assert got == want


def test_distance_counts_stop_at_the_radius():
    rng = np.random.default_rng(6)
    for radius in (1, 2, 3):
        rows = rng.integers(0, 2**63, size=70, dtype=np.uint64)
        rows[1::2] = rows[::2] ^ (np.uint64(7) << np.arange(35, dtype=np.uint64)) * (np.arange(35) % 2 == 0)
        rows[3::4] ^= np.uint64(1) << np.uint64(60)
        planes = [sum(int(r >> np.uint64(k) & np.uint64(1)) << i for i, r in enumerate(rows)) for k in range(64)]
        for shift in (1, 2, 5):
            close = simhash.close_lanes(planes, shift, (1 << (70 - shift)) - 1, radius)
            want = sum(1 << i for i in range(70 - shift) if (rows[i] ^ rows[i + shift]).bit_count() <= radius)
            assert close == want


def test_one_of_each_group_stays(spark):
    docs = clashing(documents(spark, CASES))
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    ids = sorted(kept.select("doc_id").toPandas()["doc_id"].astype("object").where(lambda x: x.notna(), None), key=str)
    groups = {d: c for d, _, c in plain_groups([(d, plain_print(t)) for d, t in CASES])}
    assert ids == sorted([None, *{c for d, c in groups.items() if d is not None}], key=str)
    assert simhash.keep_first(documents(spark, [])).count() == 0


def test_clashing_ids_are_documents_of_their_own(spark):
    one, other, third = (" ".join(np.random.default_rng(s).choice(WORDS, 200)) for s in (1, 2, 3))
    rows = [(5, one, "en"), (5, one, "de"), (5, other), (5, other + " end"), (7, one), (7, third), (8, third), (None, one), (9, other)]
    docs = clashing(documents(spark, rows))
    got = sorted(((r.doc_id, r.text, r.lang) for r in simhash.keep_first(docs.repartition(5)).collect()), key=str)
    assert got == sorted([(5, one, "de"), (5, other, None), (7, third, None), (None, one, None)], key=str)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, plain_print(r.text)) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert sorted(map(tuple, simhash.op7_simhash(spark, folder).collect()), key=str) == plain_groups(rows)
