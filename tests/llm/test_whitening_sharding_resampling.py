import math
import random
import zlib
from collections import Counter
from fractions import Fraction

import brute
import numpy as np
import pytest
from test_operators import corpus, frame, tuples

from stepwave.llm import resampling as resampling_module
from stepwave.llm.best_fit import best_fit, into_capacity, into_shards
from stepwave.llm.exact_spectrum import eigenvectors, largest_roots, polynomial_modulo, primes_for, remaindered, roots_above
from stepwave.llm.prefix_crc import LANE, RunningCrc
from stepwave.llm.queries import QUERIES
from stepwave.llm.resampling import resample
from stepwave.llm.sharding import shard_documents
from stepwave.llm.whitening import scatter, whiten

VECTORS = "vec_id long, embedding array<float>, component string, k int, n string"


def vectors(spark, rows):
    return spark.createDataFrame([(k, v, "c", 7, None) for k, v in rows], VECTORS).repartition(3)


def polynomial(matrix):
    return remaindered((p, polynomial_modulo(matrix, p).tolist()) for p in primes_for(matrix))


def determinant(matrix):
    """By fractions."""
    a, out = [[Fraction(int(x)) for x in row] for row in matrix], Fraction(1)
    for j in range(len(a)):
        pivot = next((i for i in range(j, len(a)) if a[i][j]), None)
        if pivot is None:
            return 0
        if pivot != j:
            a[j], a[pivot], out = a[pivot], a[j], -out
        out *= a[j][j]
        for i in range(j + 1, len(a)):
            factor = a[i][j] / a[j][j]
            a[i] = [x - factor * y for x, y in zip(a[i], a[j], strict=True)]
    return out


@pytest.mark.parametrize("d", [1, 2, 5, 9])
def test_polynomial_is_the_determinant_of_x_minus_the_matrix(d):
    rng = np.random.default_rng(d)
    x = rng.integers(-(10**6), 10**6, (2 * d, d)).astype(object)
    matrix = x.T @ x
    found = polynomial(matrix)
    for point in (0, 1, -3, 10**9):
        assert sum(c * point**i for i, c in enumerate(found)) == determinant(point * np.eye(d, dtype=int).astype(object) - matrix)


def test_repeated_and_zero_roots():
    rng = np.random.default_rng(4)
    matrix = np.diag([9, 9, 4, 0]).astype(object)
    found = polynomial(matrix)
    assert found == [0, -324, 153, -22, 1]
    assert [roots_above(found, x) for x in (-1, 0, 3, 4, 8, 9)] == [4, 3, 3, 2, 2, 0]
    roots, bits = largest_roots(found, 8)
    assert [round(r / 2**bits, 12) for r in roots] == [9, 9, 4]
    unit = eigenvectors(matrix, roots, bits)
    assert np.allclose(unit.T @ unit, np.eye(3), atol=1e-14)
    assert np.allclose(matrix.astype(float) @ unit, unit * [9, 9, 4], atol=1e-12)
    x = rng.integers(-1000, 1000, (40, 12))
    matrix = (x.T @ x).astype(object)
    roots, bits = largest_roots(polynomial(matrix), 12)
    assert np.allclose([r / 2**bits for r in roots], np.linalg.eigvalsh(matrix.astype(float))[::-1], rtol=1e-11)


def test_scatter_is_exact_beyond_floating_point():
    x = np.array([[2**61 + 1, -(2**40) - 3], [5, 2**61 - 7], [-(2**62), 11]], np.int64)
    assert (scatter(x) == x.astype(object).T @ x.astype(object)).all()


def whitened_plain(rows, most, scale=1024, offset=100_000):
    """Deviations by whole numbers, components by floating point numbers."""
    kept = [(k, v) for k, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    length = max(Counter(len(v) for _, v in kept).items(), key=lambda x: (x[1], x[0]))[0]
    kept = [(k, v) for k, v in kept if len(v) == length]
    x = [[math.floor(scale * float(np.float32(c))) + offset for c in v] for _, v in kept]
    n, total = len(x), [sum(c) for c in zip(*x, strict=True)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(row, total, strict=True)) for row in x]
    centred = np.array([[n * c - s for c, s in zip(row, total, strict=True)] for row in x], float) / n
    values, unit = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:most]
    order = order[values[order] > 1e-9 * values.max()]
    return kept, deviation, centred @ unit[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def test_whitening(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1 + j) for j in range(6)]) for i in range(60)]
    rows += [(5, rows[5][1]), (None, rows[7][1]), (70, None), (71, [1.0, None] * 3), (72, [math.nan] * 6), (73, [math.inf] * 6), (74, []), (75, [1.0])]
    kept, deviation, want, share = whitened_plain(rows, 8)
    found = whiten(vectors(spark, rows)).collect()
    assert Counter((r.vec_id, r.deviation) for r in found if r.component == 1) == Counter((k, d) for (k, _), d in zip(kept, deviation, strict=True))
    assert {r.component for r in found} == set(range(1, 7)) and {r.n for r in found} == {len(kept)}
    assert max(r.identity_error for r in found) < 1e-12
    place = {k: i for i, (k, _) in enumerate(kept)}
    for c in range(1, 7):
        mine = [r for r in found if r.component == c]
        assert mine[0].explained == pytest.approx(share[c - 1], rel=1e-9)
        a, b = np.array([r.whitened for r in mine]), want[[place[r.vec_id] for r in mine], c - 1]
        assert np.allclose(a, b * np.sign(a @ b), atol=1e-9)


def test_whitening_of_few_equal_and_far_vectors(spark):
    assert whiten(vectors(spark, [])).count() == 0
    assert whiten(vectors(spark, [(1, None), (2, [math.nan])])).count() == 0
    assert whiten(vectors(spark, [(1, [1.0, 2.0])] * 3)).count() == 0
    two = whiten(vectors(spark, [(1, [1.0, 2.0, 5.0]), (2, [3.0, 1.0, 5.0])])).collect()
    assert sorted((r.vec_id, r.component, r.explained, abs(round(r.whitened, 12))) for r in two) == [(1, 1, 1.0, 1.0), (2, 1, 1.0, 1.0)]
    far = whiten(vectors(spark, [(1, [1e30, 0.0]), (2, [0.0, 1.0]), (3, [-1e30, 3.0])])).collect()
    assert len(far) == 6 and {r.deviation for r in far if r.vec_id == 1} == {None}
    assert max(r.identity_error for r in far) < 1e-9


def test_whitening_query_over_the_given_vectors(spark, sf_dir):
    found = QUERIES["op11_whitening"](spark, sf_dir).toPandas()
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    kept, deviation, want, share = whitened_plain(rows, 8)
    assert len(found) == 8 * len(kept) and found["identity_error"].max() <= 1e-4
    wide = found.pivot(index="vec_id", columns="component", values="whitened").loc[[k for k, _ in kept]].to_numpy()
    assert np.allclose(wide, want * np.sign((wide * want).sum(0)), atol=1e-6)
    first = found[found["component"] == 1].set_index("vec_id").loc[[k for k, _ in kept], "deviation"]
    assert first.tolist() == deviation
    assert np.allclose(found.groupby("component")["explained"].first(), share, rtol=1e-9)


def placed_bins(plan, groups):
    out = [None] * groups
    for p in plan:
        for i in range(p.count):
            assert out[p.first + i] is None
            out[p.first + i] = p.bin + i // p.each
    return out


@pytest.mark.parametrize("seed", range(20))
def test_best_fit_by_runs_is_best_fit_one_by_one(seed):
    rng = random.Random(seed)
    sizes = sorted((rng.choice([1, 2, 3, 5, 9, 17, 40]) * rng.randint(1, 3) for _ in range(rng.randint(1, 90))), reverse=True)
    runs = sorted(Counter(sizes).items(), reverse=True)
    for bins in (1, 2, 7, 30):
        for capacity in (max(sizes), -(-sum(sizes) // bins), 150):
            plan, want = best_fit(runs, capacity, bins), brute.best_fit(sizes, capacity, bins)
            assert (plan is None) == (want is None)
            if plan is not None:
                room = lambda bin_of: sorted(sum(s for s, b in zip(sizes, bin_of, strict=True) if b == x) for x in range(bins))  # noqa: E731, B023
                assert room(placed_bins(plan, len(sizes))) == room(want)


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_shards_are_near_equal(shards):
    rng = random.Random(shards)
    for sizes in ([], [5], [4] * 3, [1000, 900, 3, 2, 1], [rng.randint(1, 60) for _ in range(400)]):
        sizes = sorted(sizes, reverse=True)
        runs = sorted(Counter(sizes).items(), reverse=True)
        bins = placed_bins(into_shards(runs, shards), len(sizes))
        assert None not in bins and set(bins) <= set(range(shards))
        fills = [sum(s for s, b in zip(sizes, bins, strict=True) if b == x) for x in range(shards)]
        assert max(fills) <= max(sizes[0] if sizes else 0, -(-sum(sizes) // shards) + (sizes[0] if sizes else 0))
        if len(sizes) == 400:
            assert max(fills) - min(fills) <= 2
        bins = placed_bins(into_capacity(runs, 100), len(sizes))
        fills = Counter()
        for s, b in zip(sizes, bins, strict=True):
            fills[b] += s
        assert all(f <= 100 or bins.count(b) == 1 for b, f in fills.items())
        assert sorted(fills) == list(range(len(fills)))


@pytest.mark.parametrize("how", [{"shards": 8}, {"shards": 1}, {"shards": None, "capacity": 4000}])
def test_sharding(spark, how):
    rows = corpus() + [(200 + i, "copy of one text") for i in range(50)] + [(300, "")]
    found = shard_documents(frame(spark, rows), **how).collect()
    want = Counter((k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in found) == want
    by_shard = {}
    for r in found:
        by_shard.setdefault(r.shard, []).append(r)
    assert all(sorted(r.slot for r in part) == list(range(len(part))) for part in by_shard.values())
    assert len({(r.text_crc32, r["size"], r.shard) for r in found}) == len({(t or "") for _, t in rows})
    fills = {s: sum(r["size"] for r in part) for s, part in by_shard.items()}
    if "capacity" in how:
        assert all(f <= 4000 or len({r.text_crc32 for r in by_shard[s]}) == 1 for s, f in fills.items())
    else:
        assert set(fills) == set(range(how["shards"]))
    assert shard_documents(frame(spark, []), **how).count() == 0


def test_shards_of_the_given_documents(spark, sf_dir):
    found = QUERIES["op12_sharding"](spark, sf_dir).toPandas()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs)
    assert sorted(found[["doc_id", "size", "text_crc32"]].itertuples(index=False, name=None)) == want
    assert set(found["shard"]) == set(range(8)) and set(found["law"]) == {"bytes"} and found["grown_shard"].isna().all()
    text = {r.doc_id: r.text or "" for r in docs}
    weight = Counter()
    for t in text.values():
        weight[t] += len(t.encode()) + 1
    assert found["shard"].groupby(found["doc_id"].map(text)).nunique().max() == 1
    fills = found.groupby("shard")["size"].sum()
    assert fills.max() - fills.min() <= max(1, fills.mean() // 1000) or fills.max() <= max(weight.values())
    assert (found.groupby("shard")["slot"].max() + 1 == found.groupby("shard").size()).all()


def test_any_substring_crc_from_two_prefixes():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 5 * LANE + 77).astype(np.uint8)
    running, body = RunningCrc(data), data.tobytes()
    begin = np.concatenate((rng.integers(0, len(data), 500), [0, 0, LANE, len(data)]))
    end = np.concatenate((rng.integers(0, len(data), 500), [0, len(data), LANE, len(data)]))
    begin, end = np.minimum(begin, end), np.maximum(begin, end)
    assert running.between(begin, end).tolist() == [zlib.crc32(body[a:z]) for a, z in zip(begin.tolist(), end.tolist(), strict=True)]
    assert RunningCrc(np.zeros(0, np.uint8)).between(np.array([0]), np.array([0])).tolist() == [0]


@pytest.mark.parametrize(("least", "most", "block"), [(1, 1, 1 << 21), (1, 3, 1 << 21), (2, 2, 1 << 21), (1, 3, 512), (2, 5, 300)])
def test_resampling(spark, monkeypatch, least, most, block):
    """Blocks far smaller than a document give the same n-grams, also those over a border."""
    rows = corpus() + [(104, "Mixed CASE, über-Größe ÄÖ! x1\x00y_2 " * 40), (104, "Mixed CASE, über-Größe ÄÖ! x1\x00y_2 " * 40)]
    targets = [(1, rows[20][1]), (2, None), (None, "short one")]
    monkeypatch.setattr(resampling_module, "BLOCK", block)
    items = spark.createDataFrame(targets, "item_id long, text string")
    found = resample(frame(spark, rows), items, least, most, buckets=97, percent=30, min_words=10, seed=5)
    want = brute.resampling(rows, targets, least, most, 97, 30, 10, 5)
    cut = lambda r: (r[:5], r[5] is None)
    found = [tuple(r) for r in found.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()]
    assert Counter(r[:5] for r in found) == Counter(r[:5] for r in want)
    assert sorted(map(repr, map(cut, found))) == sorted(map(repr, map(cut, want)))
    place = lambda rows: {r[5]: r[4] for r in rows if r[5]}
    assert place(found) == place(want) and len(place(want)) > 3


def test_resampling_of_empty_tables(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    assert resample(frame(spark, []), items).count() == 0
    rows = corpus()
    assert tuples(resample(frame(spark, rows), items), "doc_id", "weight") == sorted(
        ((r[0], r[3]) for r in brute.resampling(rows, [], 1, 1, 10_000, 10, 20, 2024)), key=repr
    )
