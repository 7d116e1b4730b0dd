"""Vector searches against brute force, and on odd rows."""

import math
import random

import numpy as np

from changeflow.llm import hamming_index, topk
from changeflow.llm.vectors import best_of
from tests.llm import brute
from tests.llm.conftest import SF

ODD = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (20, [0.5, 0.5]), (40, [0.0, 0.0]), (60, None), (80, [float("nan"), 1.0]),
       (100, [0.0, -2.0]), (100, [0.0, -2.0]), (120, [float("inf"), 0.0]), (3, [None, 1.0]), (None, [1.0, 1.0]), (140, []), (200, [3.0, 1.0])]


def found(df) -> dict[int, list[tuple[float, int]]]:
    out: dict[int, list] = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_nearest_recall_and_scores(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = sorted((r["vec_id"], r["embedding"]) for r in df.collect())
    want = brute.nearest([r[0] for r in rows], [r[1] for r in rows], 20, 20)
    got = found(hamming_index.nearest(df))
    assert set(got) == set(want)
    hits = sum(len({v for _, v in got[q]} & {v for _, v in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    exact = {q: dict((v, s) for s, v in brute.nearest([r[0] for r in rows], [r[1] for r in rows], 20, len(rows))[q]) for q in list(want)[:3]}
    for q, every in exact.items():
        assert all(math.isclose(s, every[v], rel_tol=1e-12, abs_tol=1e-15) for s, v in got[q])
        assert got[q] == sorted(got[q], key=lambda x: (-x[0], x[1]))


def test_nearest_on_odd_rows(spark):
    df = spark.createDataFrame([(*r, "x") for r in ODD], "vec_id long, embedding array<float>, shard string")
    got = found(hamming_index.nearest(df))
    # Zero, null, empty and non-finite vectors take no part; a repeated id answers once and never meets itself.
    assert set(got) == {0, 20, 100, 200}
    assert got[0] == [(3.0, 200), (1.0, 1), (1.0, 2), (0.5, 20), (0.0, 100), (0.0, 100)]
    assert all(v != 100 for _, v in got[100])
    assert hamming_index.nearest(df.limit(0)).count() == 0


def test_equal_vectors_rank_by_id(spark):
    """Repeated vectors score alike to the last bit, wherever they stand."""
    rng = np.random.default_rng(7)
    many = rng.standard_normal((40, 64)).astype(np.float32)
    twin = rng.standard_normal(64).astype(np.float32)
    rows = [(i, many[i].tolist()) for i in range(1, 40)] + [(i, twin.tolist()) for i in range(100, 145)] + [(0, (twin + many[0] / 8).tolist())]
    rng.shuffle(rows)
    df = spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<float>")
    got = found(hamming_index.nearest(df, k=20))[0]
    assert len({s for s, _ in got}) == 1 and [v for _, v in got] == list(range(100, 120))


def test_pigeonhole_probing_is_complete():
    rng = np.random.default_rng(0)
    bits = rng.random((2000, 64)) > 0.5
    bits[::7] = bits[0] ^ (rng.random((286, 64)) < 0.15)
    index = hamming_index.Index(bits)
    for radius in (0, 3, 7, 8, 15, 20, 33, 64):
        query = np.packbits(bits[0], bitorder="little")
        want = np.flatnonzero((bits != bits[0]).sum(axis=1) <= radius)
        assert (index.within(query, radius) == want).all()


def test_top_k_is_exact(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = sorted((r["vec_id"], [math.floor(1024 * x) for x in r["embedding"]]) for r in df.collect())
    want = brute.nearest([r[0] for r in rows], [r[1] for r in rows], 100, 10)
    assert found(topk.top_k(df)) == want


def test_top_k_on_odd_rows(spark):
    df = spark.createDataFrame(ODD, "vec_id long, embedding array<float>")
    got = found(topk.top_k(df))
    assert set(got) == {0, 100, 200}
    k = 1024 * 1024
    assert got[0] == [(3 * k, 200), (k, 1), (k, 2), (k // 2, 20), (0, 40), (0, 100), (0, 100)]
    assert topk.top_k(df.limit(0)).count() == 0


def test_top_k_kernel_prunes_without_loss():
    rng = np.random.default_rng(1)
    rows = np.floor(1024 * rng.standard_normal((3000, 16)) * rng.lognormal(0, 1, (3000, 1)))
    asked = np.floor(1024 * rng.standard_normal((40, 16)))
    q, r, s = topk._answer({16: topk.rotation(rows.T @ rows)}, 10)(np.arange(3000), rows, np.arange(10_000, 10_040), asked)
    for i in range(40):
        want = best_of(rows @ asked[i], 10)
        assert (r[q == i] == want).all() and (s[q == i] == (rows @ asked[i])[want]).all()


def test_best_of_breaks_ties_by_position():
    rng = random.Random(0)
    x = np.array([rng.randint(0, 3) for _ in range(100)])
    assert best_of(x, 7).tolist() == sorted(range(100), key=lambda i: (-x[i], i))[:7]
