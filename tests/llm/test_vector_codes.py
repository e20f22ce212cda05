import hashlib
import math
import random

import numpy as np
import pytest

from helpers import rows_of
from sieveflow.llm import vector_codes
from sieveflow.llm.vector_codes import assigned, ball_tree, centres_and_radii, compress

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, entries=256, rounds=4):
    """{(vec_id, code, error, label_error)} and the digest, entry by entry."""
    kept = []
    for i, v, label in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(1024 * float(np.float32(x))) for x in v], label))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-max((len(v) for _, v, _ in kept), default=0) // 4) * 4
    size = width // 4
    parts = [[tuple((v + [0] * (width - len(v)))[p * size: (p + 1) * size]) for p in range(4)] for _, v, _ in kept]
    books = [[parts[i][p] for i in range(min(entries, len(kept)))] for p in range(4)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds if kept else 0):
        for p in range(4):
            of = {}
            for x in parts:
                of.setdefault(nearest(x[p], books[p])[1], []).append(x[p])
            books[p] = [tuple(sum(c) // len(of[i]) for c in zip(*of[i])) if i in of else e for i, e in enumerate(books[p])]
    out, by_label = [], {}
    for (i, _, label), x in zip(kept, parts):
        found = [nearest(x[p], books[p]) for p in range(4)]
        error = sum(d for d, _ in found)
        by_label[label] = by_label.get(label, 0) + error
        out.append((i, "".join(f"{e:02x}" for _, e in found), error, label))
    text = ",".join(str(c) for b in books for e in b for c in e)
    return sorted(((i, c, e, by_label[label]) for i, c, e, label in out), key=repr), hashlib.sha256(text.encode()).hexdigest()


def same(spark, rows, monkeypatch=None):
    got = compress(spark.createDataFrame(rows, SCHEMA).repartition(3))
    want, digest = plain(rows)
    found = got.collect()
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in found), key=repr) == want
    assert {r.codebooks_sha256 for r in found} <= {digest}
    return want


def gaussian(rng, n, dim, spread=0.3):
    middles = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(7)]
    return [(i, [rng.gauss(m, spread) for m in rng.choice(middles)], rng.choice([None, 1, 2, 3])) for i in range(n)]


@pytest.mark.parametrize("dim", [4, 24])
def test_same_as_plain_rounds(spark, dim, monkeypatch):
    monkeypatch.setattr(vector_codes, "BLOCK", 200)
    rows = gaussian(random.Random(dim), 900, dim)
    assert len(same(spark, rows)) == 900


def test_a_vector_that_makes_up_a_third(spark):
    rows = gaussian(random.Random(5), 400, 8)
    rows += [(1000 + i, rows[3][1], 1) for i in range(200)]
    same(spark, rows)


def test_integer_ties(spark):
    rng = random.Random(9)
    rows = [(i, [rng.randrange(4) / 1024 for _ in range(8)], i % 3) for i in range(500)]
    same(spark, rows)


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(5, [0.5, -0.5, 0.1, 0.2], 1), (5, [0.5, -0.5, 0.1, 0.2], 1), (5, [9.0, 1.0, 0.0, 0.0], 2), (None, [1.0, 2.0, 3.0, 4.0], None),
            (1, None, 1), (2, [None, 1.0, 1.0, 1.0], 1), (3, [nan, 1.0, 1.0, 1.0], 1), (4, [inf, 1.0, 1.0, 1.0], 1), (6, [1.0, 2.0], None),
            (7, [], 3), (8, [-0.0001, 0.0001, 1.0, 1.0, 5.0], 3), (9, [1.0, -inf, 1.0, 1.0], 1)]
    assert len(same(spark, rows)) == 7


def test_extreme_components_do_not_overflow(spark):
    got = compress(spark.createDataFrame([(1, [3e38] * 4, 1), (2, [-3e38] * 4, 1), (3, [0.0] * 4, 1)], SCHEMA)).collect()
    assert len(got) == 3 and all(r.error == 0 for r in got)


def test_empty_and_clashing_names(spark):
    assert rows_of(compress(spark.createDataFrame([], SCHEMA))) == []
    df = spark.createDataFrame(gaussian(random.Random(1), 20, 8), SCHEMA)
    clash = df.selectExpr("*", "1 AS v", "2 AS x", "3 AS code", "4 AS of", "5 AS error", "6 AS ids")
    assert rows_of(compress(clash)) == rows_of(compress(df))
    assert {r.label for r in compress(df.drop("label")).collect()} == {None}


def test_balls_hold_their_points_and_hand_over_their_caches():
    """With tight groups most balls are owned wholly, and no point of them is compared."""
    rng = np.random.default_rng(2)
    middles = rng.integers(-50_000, 50_000, (12, 6))
    points = np.unique(middles[rng.integers(0, 12, 3000)] + rng.integers(-300, 300, (3000, 6)), axis=0)
    weights = rng.integers(1, 5, len(points))
    tree = ball_tree(points, weights)
    points, weights = points[tree["order"]], weights[tree["order"]]
    centres, radii = centres_and_radii(points, tree)
    for a, b, c, r, n, s in zip(tree["lo"], tree["hi"], centres, radii, tree["count"], tree["sums"]):
        assert np.linalg.norm(points[a:b] - c, axis=1).max() <= r + 1e-6
        assert n == weights[a:b].sum() and (s == (points[a:b] * weights[a:b, None]).sum(axis=0)).all()
    tree |= {"centres": centres, "radii": radii}
    owner, left = vector_codes.owned(points, tree, middles)
    assert (owner >= 0).sum() < 200 and sum(tree["hi"][b] - tree["lo"][b] for b, _ in left) < 0.2 * len(points)
    count, sums, entry, least = assigned(points, weights, tree, middles, True)
    d = ((points[:, None, :] - middles[None]) ** 2).sum(axis=2)
    assert (entry == d.argmin(axis=1)).all() and (least == d.min(axis=1)).all()
    assert (count == np.bincount(entry, weights=weights, minlength=12)).all()
