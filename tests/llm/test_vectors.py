"""Vector codes against plain integer loops."""

import hashlib
import math
import random

import numpy as np
import pytest

from riskloom.llm import vectors as V

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def expected(rows, parts=4, entries=256, rounds=4):
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v], l) for i, v, l in rows
            if v is not None and all(x is not None and math.isfinite(np.float32(x)) for x in v)]
    if not kept:
        return []
    width = len(kept[0][1]) // parts
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[r[1][p * width:(p + 1) * width] for r in first] for p in range(parts)]

    def nearest(v, p):
        d = [sum((a - b) ** 2 for a, b in zip(v[p * width:(p + 1) * width], e)) for e in books[p]]
        return min(range(len(d)), key=lambda e: (d[e], e)), min(d)

    for _ in range(rounds):
        groups = [{} for _ in range(parts)]
        for _, v, _ in kept:
            for p in range(parts):
                groups[p].setdefault(nearest(v, p)[0], []).append(v[p * width:(p + 1) * width])
        for p in range(parts):
            for e, members in groups[p].items():
                books[p][e] = [sum(c) // len(members) for c in zip(*members)]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    coded = [(i, l, [nearest(v, p) for p in range(parts)]) for i, v, l in kept]
    total = {}
    for _, label, found in coded:
        total[label] = total.get(label, 0) + sum(d for _, d in found)
    return [(i, "".join(f"{e:02x}" for e, _ in f), sum(d for _, d in f), total[l], digest) for i, l, f in coded]


def coded(df, **options):
    return [tuple(r) for r in V.report(*V.compress(df, **options)).collect()]


def key(row):
    return tuple(str(v) for v in row)


def test_against_loops(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, *range(400)]), [rng.choice([-0.5, 0.25, rng.gauss(0, 1)]) for _ in range(12)],
             rng.choice([None, 1, 2])) for _ in range(330)]
    rows += [(9, None, 1), (10, [1.0, None, *[0.0] * 10], 2), (11, [math.nan] * 12, 1), (12, [math.inf] * 12, None)]
    rows += rows[:20]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert sorted(coded(df), key=key) == sorted(expected(rows), key=key)


def test_few_rows_and_empty_entries(spark):
    rows = [(3, [0.0] * 8, 1), (1, [0.0] * 8, None), (2, [1.0] * 8, None)]
    got = coded(spark.createDataFrame(rows, SCHEMA))
    assert sorted(got, key=key) == sorted(expected(rows), key=key)


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [], None), (2, [], 1)]])
def test_nothing_to_code(spark, rows):
    got = coded(spark.createDataFrame(rows, SCHEMA))
    assert [(r[0], r[2], r[3]) for r in sorted(got)] == [(i, 0, 0) for i, v, _ in rows if v is not None]


def test_lengths_have_to_agree(spark):
    for rows in ([(1, [1.0] * 8, 1), (2, [1.0] * 4, 1)], [(1, [1.0] * 6, 1)]):
        with pytest.raises(ValueError, match="components"):
            V.compress(spark.createDataFrame(rows, SCHEMA))


def test_clashing_columns_and_large_components(spark):
    rows = [(i, [(-1) ** i * 1e3 * (i + j) for j in range(8)], i % 2) for i in range(20)]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA + ", whole int, codes int, error int")
    assert sorted(coded(df), key=key) == sorted(expected(rows), key=key)
    with pytest.raises(Exception, match="beyond"):
        V.compress(spark.createDataFrame([(1, [1e30] * 8, 1)], SCHEMA))


def test_limbs_are_exact():
    rng = np.random.default_rng(5)
    for top, bits in ((1 << 30, 24), (1 << 28, 7), (900, 26)):
        a, b = (rng.integers(-top, top, (50, 6)) for _ in range(2))
        wanted = [[sum(int(x) * int(y) for x, y in zip(u, v)) for v in b] for u in a]
        assert V.exact_products(a, b, bits).tolist() == wanted
        assert sum(int(limb[3]) << bits * i for i, limb in enumerate(V.limbs(a.ravel(), bits))) == a.ravel()[3]
    assert all(n * 4 ** V.limb_bits(n) <= 2**53 for n in (1, 16, 17, 1000, 4096))
