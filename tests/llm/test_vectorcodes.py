import hashlib
import math

import numpy as np
import pytest
from compare import database, difference

from tickloom.llm import queries, vectorcodes

SCHEMA = "vec_id long, embedding array<float>, label int, x string, error string"


def vectors_of(spark, data):
    return spark.createDataFrame([(i, v, label, "x", "e") for i, v, label in data], SCHEMA)


def plain(data, parts=4, entries=256, rounds=4):
    """Every distance of every round, in whole numbers."""
    rows = [(i, [math.floor(1024 * float(np.float32(c))) for c in v], label) for i, v, label in data if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not rows:
        return [], []
    size = len(rows[0][1])
    rows = [r for r in rows if len(r[1]) == size]
    cuts = [(p * size // parts, (p + 1) * size // parts) for p in range(parts)]
    books = [[r[1][a:b] for r in rows[:entries]] for a, b in cuts]

    def nearest(part, book):
        return min((sum((x - c) ** 2 for x, c in zip(part, entry)), k) for k, entry in enumerate(book))

    for n in range(rounds + 1):
        found = [[nearest(r[1][a:b], book) for (a, b), book in zip(cuts, books)] for r in rows]
        if n < rounds:
            for p, (a, b) in enumerate(cuts):
                for k in range(len(books[p])):
                    own = [r[1][a:b] for r, f in zip(rows, found) if f[p][1] == k]
                    if own:
                        books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    out = [(r[0], [k for _, k in f], sum(d for d, _ in f), r[2]) for r, f in zip(rows, found)]
    totals = {}
    for _, _, error, label in out:
        totals[label] = totals.get(label, 0) + error
    return [(i, code, error, totals[label]) for i, code, error, label in out], books


def coded(spark, data, **how):
    found = vectorcodes.compress(vectors_of(spark, data), **how)
    rows = vectorcodes.with_label_errors(found.rows).collect()
    return sorted(((r.vec_id, list(r.codes), r.error, r.label_error) for r in rows), key=repr), found


def test_query_against_sql(spark):
    sf, name = "/root/testdata/sf0.001", "op12_vectorcodes"
    assert difference(queries.QUERIES[name](spark, sf), database(sf), queries.ORACLES[name]) is None


@pytest.mark.parametrize("size", [8, 6, 3])
def test_against_plain_rounds(spark, size):
    rng = np.random.default_rng(size)
    data = [(int(i), rng.normal(0, 0.3, size).astype(np.float32).tolist(), [None, 1, 2][i % 3]) for i in rng.permutation(300)]
    data += data[:20]  # repeated rows
    data += [(None, data[0][1], None), (1000, [0.0] * size, 5), (1001, [0.0] * size, 5)]
    want, books = plain(data, entries=20)
    got, found = coded(spark, data, entries=20, groups=4)
    assert got == sorted(want, key=repr)
    digest = ",".join(str(c) for book in books for entry in book for c in entry)
    assert found.digest() == hashlib.sha256(digest.encode()).hexdigest()


def test_bounds_equal_full_scans_and_measure_less():
    rng = np.random.default_rng(1)
    centres = rng.integers(-900, 900, (40, 16))
    x = centres[rng.integers(0, 40, 5000)] + rng.integers(-60, 60, (5000, 16))
    start = x[:256]
    book = vectorcodes.Book(vectorcodes.neighbourhoods(start, 16), [start])
    code, bound = np.zeros(len(x), np.int64), np.full((len(x), 16), -np.inf)
    stamp = np.zeros((len(x), 16), np.int64)
    work = []
    for n in range(6):
        code, bound, stamp, error, measured = vectorcodes.assign(x, code, vectorcodes.rounded_down(bound).astype(float), stamp, book)
        full = vectorcodes.squared(x, book.rounds[-1])
        assert (code == full.argmin(1)).all() and (error == full.min(1)).all()
        for g, members in enumerate(book.groups):  # no bound lies above a distance it stands for
            then = np.stack([vectorcodes.squared(x, entries)[:, members] for entries in book.rounds])[stamp[:, g], np.arange(len(x))].astype(float)
            then[members[None, :] == code[:, None]] = np.inf
            assert (bound[:, g] <= np.sqrt(then.min(1))).all()
        work.append(measured / full.size)
        moved = book.rounds[-1].copy()
        for k in np.unique(code):
            moved[k] = x[code == k].sum(0) // (code == k).sum()
        book.rounds.append(moved)
    assert work[0] >= 1 and max(work[2:]) < 0.5


def test_net_displacement_is_below_the_sum_of_moves():
    there = np.array([[0, 0], [10, 0]])
    book = vectorcodes.Book([np.array([0]), np.array([1])], [there, there + 5, there])
    assert book.net()[0].tolist() == [0, 0] and book.net()[1, 0] == pytest.approx(math.hypot(5, 5))


def test_edge_rows(spark):
    ok = [0.25, -0.5, 0.125, 1.0]
    data = [
        (1, ok, None), (2, None, 1), (3, [0.1, None, 0.0, 0.0], 1), (4, [float("nan"), 0.0, 0.0, 0.0], 1), (5, [0.0, float("inf"), 0.0, 0.0], 1),
        (6, [0.0] * 5, 1), (7, [], 1), (None, ok, 3), (1, ok, None), (8, [-0.0001, 0.0, 0.0, 0.0], 3),
    ]
    got, found = coded(spark, data)
    assert got == sorted(plain(data)[0], key=repr)
    assert [r[0] for r in got].count(1) == 2 and {r[0] for r in got} == {1, None, 8}
    assert len(found.books[0].rounds) == 5
    assert coded(spark, [])[0] == [] and coded(spark, [(1, None, 1)])[0] == []
    assert coded(spark, [(1, [], 2), (2, [], 2)])[0] == [(1, [0, 0, 0, 0], 0, 0), (2, [0, 0, 0, 0], 0, 0)]


def test_large_numbers_are_exact(spark):
    rng = np.random.default_rng(9)
    data = [(i, (rng.integers(-(2**17), 2**17, 8) + 0.5).astype(np.float32).tolist(), i % 2) for i in range(60)]
    assert coded(spark, data, entries=7, groups=3)[0] == sorted(plain(data, entries=7)[0], key=repr)
    huge = [(i, [3e38 * (-1) ** i] * 4, 1) for i in range(4)]
    rows, _ = coded(spark, huge, entries=2)
    assert [r[1] for r in rows] == [[0] * 4, [1] * 4, [0] * 4, [1] * 4]


def test_a_label_in_a_third_of_all_rows(spark):
    rng = np.random.default_rng(3)
    data = [(i, rng.normal(0, 1, 4).astype(np.float32).tolist(), None if i % 3 else i) for i in range(600)]
    assert coded(spark, data, entries=4, groups=2)[0] == sorted(plain(data, entries=4)[0], key=repr)
