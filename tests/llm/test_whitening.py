import numpy as np
import pytest

from stratiscore.llm import whitening
from stratiscore.sources.staging import local_rows

SCHEMA = "vec_id long, embedding array<float>, label int, x long, n long, component string"


def frame(spark, vectors):
    rows = [(i, v, 0, -1, -2, "c") for i, v in vectors]
    return local_rows(spark, SCHEMA, rows)


def usable(vectors):
    kept = [(i, v) for i, v in vectors if v and all(c is not None and np.isfinite(c) for c in v)]
    sizes = sorted({len(v) for _, v in kept}, key=lambda d: (sum(len(v) == d for _, v in kept), d))
    return [(i, v) for i, v in kept if len(v) == sizes[-1]] if kept else []


def check(workspace, vectors, components=16):
    """Whitened values against the eigenvectors of the covariance; returns the rows by id."""
    df = whitening.whiten(workspace, frame(workspace.spark, vectors), components)
    rows = df.collect()
    kept = usable(vectors)
    x = np.array([[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v in kept], object)
    fit = np.array(sorted({tuple(r) for r in x.tolist()}), object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = ((n * fit - sums) / n).astype(float)
    v = centred.T @ centred / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    k = min(components, int((e > 1e-9 * max(e[0], 1e-300)).sum()) if e[0] > 0 else 0)
    assert len(rows) == k * len(kept)
    if not k:
        return rows
    y = ((n * x - sums) / n).astype(float) @ q[:, :k] / np.sqrt(e[:k])
    order = sorted(range(len(kept)), key=lambda r: (kept[r][0] is not None, kept[r][0] or 0, tuple(x[r])))
    rows.sort(key=lambda r: (r["vec_id"] is not None, r["vec_id"] or 0, r["deviation"], r["component"]))
    for r in rows:
        assert r["n"] == n
        assert r["explained"] == pytest.approx(e[r["component"] - 1] / e.sum(), rel=1e-9)
        assert r["identity_error"] < 1e-9
    deviations = sorted(str(sum((n * x[i] - sums) ** 2)) for i in order)
    assert sorted(str(r["deviation"]) for r in rows if r["component"] == 1) == deviations
    gaps = np.diff(e[: k + 1]) if len(e) > k else np.diff(e)
    if np.abs(gaps).min(initial=1.0) > 1e-6 * e[0] and len({i for i, _ in kept}) == len(kept):
        found = np.array([r["whitened"] for r in rows]).reshape(len(kept), k)
        expected = y[order]
        assert np.allclose(np.abs(found), np.abs(expected), atol=1e-8)
    return rows


@pytest.mark.parametrize("n, dims, components", [(300, 20, 16), (40, 40, 5), (9, 12, 16), (500, 3, 16)])
def test_against_dense_eigenvectors(workspace, n, dims, components):
    rng = np.random.default_rng(n)
    values = rng.standard_normal((n, dims)) * np.linspace(1, 3, dims)
    vectors = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(values)]
    check(workspace, vectors + vectors[:1], components)


def test_few_steps_when_few_components_matter(workspace):
    rng = np.random.default_rng(7)
    values = rng.standard_normal((400, 60)) * 0.2
    values[:, :3] *= [400, 200, 90]
    rows = whitening.integer_vectors(frame(workspace.spark, [(i, v.tolist()) for i, v in enumerate(values)]))
    found = whitening.fit(workspace, rows, 2)
    assert found.steps < 40
    check(workspace, [(i, v.tolist()) for i, v in enumerate(values)], 2)


def test_low_rank(workspace):
    rng = np.random.default_rng(8)
    base = rng.integers(-40, 40, (200, 3)) @ rng.integers(-3, 4, (3, 10))
    check(workspace, [(i, (v / 64).tolist()) for i, v in enumerate(base)])


def test_equal_eigenvalues(workspace):
    """Breakdowns: every direction has the same variance."""
    axes = [(i, [float(s * (i % 6 == d)) for d in range(6)]) for i, s in enumerate([1] * 6 + [-1] * 6)]
    rows = check(workspace, axes)
    found = np.array([r["whitened"] for r in sorted(rows, key=lambda r: (r["vec_id"], r["component"]))])
    found = found.reshape(12, 6)
    assert np.allclose(found.T @ found / 12, np.eye(6))


def test_large_entries_are_exact(workspace):
    check(workspace, [(i, [1e9 * i, -3e8 * i * i, 1e9 * (i % 5)]) for i in range(30)])


def test_edges(workspace):
    nan, inf = float("nan"), float("inf")
    vectors = [
        (1, [0.5, 1.0]), (1, [0.5, 1.0]), (None, [1.5, 0.0]), (2, None), (3, [None, 1.0]), (4, [nan, 1.0]),
        (5, [inf, 0.0]), (6, []), (7, [1.0, 2.0, 3.0]), (8, [0.0, -2.0]), (9, [4.0, 4.0]),
    ]
    rows = check(workspace, vectors)
    assert {r["vec_id"] for r in rows} == {1, None, 8, 9}


@pytest.mark.parametrize("vectors", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5, [(1, None)], [(1, [float("inf")])]])
def test_nothing_varies(workspace, vectors):
    assert whitening.whiten(workspace, frame(workspace.spark, vectors)).count() == 0


def test_steps_do_not_form_a_product_of_the_dimensions(workspace, monkeypatch):
    """What a job returns is a few vectors, not a covariance."""
    widths = []
    plain = whitening.FitList.centred_sums

    def seen(self, of_block):
        found = plain(self, of_block)
        widths.append(found.shape[0])
        return found

    monkeypatch.setattr(whitening.FitList, "centred_sums", seen)
    rng = np.random.default_rng(9)
    vectors = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((200, 32)))]
    rows = whitening.integer_vectors(frame(workspace.spark, vectors))
    whitening.bidiagonalise(whitening.FitList(workspace, rows), 16)
    assert max(widths) <= 3
