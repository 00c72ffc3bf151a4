import numpy as np
import pytest

from modelvigil.llm import components, near_vectors, topk
from modelvigil.llm.queries import ORACLES, QUERIES
from tests.compare import connect, differences

VECTORS = "vec_id long, embedding array<float>, label int, terms array<long>, unit string, side int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, None, [7], "u", 1) for i, v in rows], VECTORS)


def odd_rows():
    nan, inf = float("nan"), float("inf")
    return [
        (None, [1.0, 2.0]), (50, None), (100, [nan, 1.0]), (150, [1.0, None]), (200, [inf, 0.0]), (250, []), (300, [0.0, 0.0]),
        (350, [0.5, 0.25]), (350, [0.5, 0.25]), (400, [0.5]), (1, [0.5, 0.25]), (2, [0.5, 0.25]), (3, [-0.5, 0.25, 9.0]),
        (-50, [0.125, -3.0]),
    ]


def brute_top(rows, k, every=50):
    sound = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows
             if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, terms in dict(s for s in sound if s[0] % every == 0).items():
        scored = sorted((-sum(a * b for a, b in zip(terms, t)), i) for i, t in sound if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def found_top(df, k=5, **sizes):
    rows = topk.scaled(df)
    return sorted(map(tuple, topk.top_k(rows, rows.where("vec_id % 50 = 0"), k, **sizes).collect()))


def test_top_k_of_odd_rows(spark):
    assert found_top(vectors(spark, odd_rows())) == brute_top(odd_rows(), 5)
    assert found_top(vectors(spark, [])) == []
    assert found_top(vectors(spark, [(50, [1.0])])) == []


@pytest.mark.parametrize("seed", range(3))
def test_top_k_in_many_slices(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(np.round(rng.normal(size=(700, 6)), 1))]
    rows += [(1000 + i, rows[0][1]) for i in range(300)]  # one very common vector: ties by id
    got = found_top(vectors(spark, rows), 7, slice_rows=150, chunk=6, block=16)
    assert got == brute_top(rows, 7)


def test_blocks_are_pruned_and_the_rest_is_exact():
    rng = np.random.default_rng(4)
    rows = (rng.normal(size=(2_000, 8)) * 50).astype(np.int64)
    rows = rows[np.argsort(rows[:, 0])]
    query = np.array([[500, 0, 0, 0, 0, 1, 0, 0]])
    _, ids, scores, scored = topk.search_slice(np.arange(2_000), rows, np.array([-1]), query, 5, 50)
    assert scored < 10
    want = sorted(zip((-(rows @ query[0])).tolist(), range(2_000)))[:5]
    assert list(zip((-scores).tolist(), ids.tolist())) == want


@pytest.mark.parametrize("spread, most", [(0.05, 0.1), (3.0, 1.0)])
def test_clustered_slices_are_pruned_and_others_scored_at_once(spread, most):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 32))
    rows = (256 * (centres[rng.integers(0, 40, 4_000)] + spread * rng.normal(size=(4_000, 32)))).astype(np.int64)
    ids = rng.permutation(4_000)
    asked = rows[:300]
    query, found, score, scored = topk.search_slice(ids, rows, ids[:300], asked, 5, 50)
    assert scored <= most * 300 * 80
    exact = asked @ rows.T
    for n in range(0, 300, 7):
        want = sorted((-s, i) for s, i in zip(exact[n].tolist(), ids.tolist()) if i != ids[n])[:5]
        assert [(-s, i) for s, i in zip(score[query == n].tolist(), found[query == n].tolist())] == want


def test_scores_beyond_double_precision_are_exact(spark):
    rows = spark.createDataFrame([(1, [2**40 + 1, 3]), (2, [2**20, 5]), (0, [2**20, 1])], "vec_id long, terms array<long>")
    got = topk.top_k(rows, rows.where("vec_id = 0"), 2).collect()
    assert [(r.vec_id, r.score) for r in got] == [(1, 2**60 + 2**20 + 3), (2, 2**40 + 5)]


def brute_links(rows, cosine=0.95):
    sound = [(n, np.array(v, dtype=float)) for n, (i, v) in enumerate(rows)
             if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    width = max((len(v) for _, v in sound), default=0)
    unit = {n: np.pad(v, (0, width - len(v))) / np.linalg.norm(v) for n, v in sound}
    links = {n: {m for m in unit if m != n and unit[n] @ unit[m] >= cosine} for n in unit}
    out = []
    for n, (i, _) in enumerate(rows):
        seen, todo = {n}, [n]
        while todo:
            for m in links.get(todo.pop(), ()):
                if m not in seen:
                    seen.add(m)
                    todo.append(m)
        component = None if i is None else min(rows[m][0] for m in seen)
        out.append((i, len(links.get(n, ())), component, i is None or component == i))
    return sorted(out, key=str)


def found_links(df, **options):
    return sorted(map(tuple, near_vectors.near_vectors(df, **options).collect()), key=str)


def test_near_vectors_of_odd_rows(spark):
    assert found_links(vectors(spark, odd_rows())) == brute_links(odd_rows())
    assert found_links(vectors(spark, [])) == []


def test_near_vectors_in_many_blocks(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(60, 16))
    rows = [(int(i), (centres[i % 60] + rng.normal(size=16) * rng.choice([0.0, 0.1, 0.25, 0.4])).tolist()) for i in range(600)]
    rows += [(2_000 + i, rows[3][1]) for i in range(200)]
    # float32 values, as the table holds them
    rows = [(i, np.array(v, dtype=np.float32).tolist()) for i, v in rows]
    got, want = found_links(vectors(spark, rows), block=64), brute_links(rows)
    assert got == want


def test_tied_places_are_dealt_to_many_blocks(spark):
    """Multiples of one direction are different vectors with one place."""
    rows = [(i, [float(i + 1), 0.0]) for i in range(400)] + [(1_000 + i, [0.0, float(i + 1)]) for i in range(30)]
    got = found_links(vectors(spark, rows), block=40)
    assert got == brute_links(rows)


def test_an_empty_side_has_no_pairs():
    some, none = np.eye(3), np.zeros((0, 3))
    for left, right in [(none, some), (some, none), (none, None)]:
        a, b = near_vectors.linked_pairs(left, right)
        assert len(a) == len(b) == 0


def test_count_is_calibrated_to_the_wanted_recall():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(4_000, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = rng.normal(size=base.shape)
    side -= (side * base).sum(axis=1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    near = 0.9501 * base + np.sqrt(1 - 0.9501**2) * side
    hits = sum(len(near_vectors.linked_pairs(base[i : i + 1], near[i : i + 1])[0]) for i in range(len(base)))
    assert hits >= 3_996
    far = 0.9499 * base + np.sqrt(1 - 0.9499**2) * side
    assert not any(len(near_vectors.linked_pairs(base[i : i + 1], far[i : i + 1])[0]) for i in range(500))


def test_a_vector_goes_to_few_buckets_however_many_vectors_there_are():
    """It once went to all blocks in reach, six of ten, in one batch of rows."""
    for rows in (100, 10_000, 1_000_000, 100_000_000):
        sides, tables, probes = near_vectors.planned_buckets(rows, 0.95, 4_096)
        assert tables * probes <= 32 and tables * sides**2 <= 1 << near_vectors.BUCKET_BITS
        assert probes * rows / sides**2 <= 4_096


@pytest.mark.parametrize("width", [2, 64])
def test_pairs_at_the_cosine_share_a_bucket(width):
    rng = np.random.default_rng(5)
    base = near_vectors.unit_rows(rng.normal(size=(20_000, width)))
    side = rng.normal(size=base.shape)
    side = near_vectors.unit_rows(side - (side * base).sum(axis=1, keepdims=True) * base)
    near = 0.95 * base + np.sqrt(1 - 0.95**2) * side
    plan = near_vectors.planned_buckets(200_000, 0.95, 4_096)
    one, two = (
        np.concatenate([near_vectors.bucket_names(x[i : i + 2_000], *plan) for i in range(0, len(x), 2_000)]) for x in (base, near)
    )
    shared = np.zeros(len(one), dtype=bool)
    for column in one.T:
        shared |= (column[:, None] == two).any(axis=1)
    assert (~shared).sum() <= 5
    # nothing is taken for counted before in the first bucket it shares
    mixed, large = near_vectors.mixed, np.int64(1 << 40)
    order = np.where((one[:, :, None] == two[:, None, :]).any(axis=2), mixed(one.ravel()).reshape(one.shape), large)
    first = np.take_along_axis(one, order.argmin(axis=1)[:, None], 1)[:, 0]
    before = near_vectors.met_before(near_vectors.first_buckets(one), near_vectors.first_buckets(two), first)
    assert not before[shared].any()


def test_rows_of_a_large_bucket_leave_a_task_some_at_a_time(monkeypatch):
    class Units:
        def select(self, *names):
            return self

    n, none = 1_000, near_vectors.Balls(np.zeros((0, 4)), 0.95, (1, 1, 1))
    batch = near_vectors.pa.RecordBatch.from_pydict({
        "unit": np.arange(n), "s1": np.arange(n), "s2": np.arange(n), "buckets": near_vectors._binary(np.full((n, 1), 3, np.int32)),
    })
    monkeypatch.setattr(near_vectors, "_mapped", lambda df, work, ddl: work)
    monkeypatch.setattr(near_vectors, "OUT_ROWS", 700)
    out = list(near_vectors._dealt(Units(), none, "f4", near_vectors.Pieces([(3, 0, 4_000)], 100))(iter([batch])))
    assert max(len(rows["key"]) for rows in out) <= 700
    keys, unit = (np.concatenate([rows[name] for rows in out]) for name in ("key", "unit"))
    assert len(keys) == 40 * n
    bits = near_vectors.BUCKET_BITS
    met = {}
    for key, one in zip(keys.tolist(), unit.tolist()):
        met.setdefault(key, []).append(one)
    piece = (near_vectors.mixed(np.arange(n)) % 40).tolist()
    for key, units in met.items():
        low, high = key >> bits & (1 << bits) - 1, key >> 2 * bits
        assert sorted(units) == [i for i in range(n) if piece[i] in (low, high)]


def test_pieces_of_a_large_ball_meet_others_only():
    """A row of a ball with very many rows in a bucket isn't sent to all the pieces of that ball."""
    pieces = near_vectors.Pieces([(3, 0, 150), (3, 2, 4_000), (3, 5, 250)], 100)
    unit, ball = np.arange(6_000), np.repeat([0, 2, 5, 7], 1_500)
    mine, total, start, out = pieces.of_rows(np.full(6_000, 3), ball, unit)
    assert (total == 2 + 40 + 3).all()
    for number, low, high, left_out in [(0, 0, 2, 0), (2, 2, 42, 40), (5, 42, 45, 3), (7, 0, 2, 0)]:
        some = ball == number
        assert set(mine[some].tolist()) == set(range(low, high))
        assert (out[some] == left_out).all() and (start[some] == low).all()
    mine, total, start, out = pieces.of_rows(np.full(5, 4), np.zeros(5, int), np.arange(5))
    assert (total == 1).all() and not mine.any() and not out.any()


def test_near_vectors_of_large_groups_and_what_lies_around(spark):
    rng = np.random.default_rng(11)

    def around(centre, angle, n):
        side = rng.normal(size=(n, 24))
        side = near_vectors.unit_rows(side - (side @ centre)[:, None] * centre)
        return np.cos(angle)[:, None] * centre + np.sin(angle)[:, None] * side

    one, two = near_vectors.unit_rows(rng.normal(size=(2, 24)))
    values = np.concatenate([
        around(one, rng.uniform(0, 0.1, 300), 300), around(one, rng.uniform(0.1, 0.45, 150), 150),
        around(two, rng.uniform(0, 0.12, 120), 120), rng.normal(size=(100, 24)),
    ])
    # float32 values, as the table holds them
    values = (values * rng.uniform(0.1, 9, (len(values), 1))).astype(np.float32)
    rows = [(int(i), v.tolist()) for i, v in zip(rng.permutation(len(values)), values)]
    want = brute_links(rows)
    assert found_links(vectors(spark, rows), block=16) == want
    doubles = vectors(spark, rows).selectExpr("vec_id", "cast(embedding as array<double>) embedding")
    assert found_links(doubles) == want


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = np.random.default_rng(seed)
    links = [(int(a), int(b)) for a, b in rng.integers(-50, 50, size=(60, 2))]
    links += [(1_000 + i, 1_001 + i) for i in range(40)] + [(5_000, 5_001 + i) for i in range(200)] + [(7, None), (9, 9)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if b is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    df = spark.createDataFrame(links, "u long, v long")
    assert {tuple(r) for r in components.connected_components(df).collect()} == {(x, find(x)) for x in list(root)}


def test_components_of_nothing(spark):
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("name", ["op1_topk", "op2_near_vectors"])
def test_queries_agree_with_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    assert differences(spark, connect(folder), folder, QUERIES[name], ORACLES[name]) is None
