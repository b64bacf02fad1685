"""Small matrix problems of the eigenpair iteration (``graph``), solved inside tasks.

``local_pairs`` solves a small industry as a dense matrix and ``sparse_pairs`` a larger one of bounded
size as a list of its entries; ``solved`` does the Rayleigh-Ritz step of the industries that are
iterated, from the inner products of their basis vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

TIE = 1e-9           # values that differ less, relatively, count as one eigenvalue
LOST = 1e-6          # estimated residual at which a pair that had converged is taken up again
NOISE = 1e-14        # length, relative to the largest value, below which a new direction is rounding
CHUNK = 1 << 19      # matrix entries multiplied at a time
BASIS_BYTES = 192 << 20      # bound on the basis of a sparse industry
LEAST_BASIS, MOST_BASIS = 48, 160
WAITING_BYTES = 32 << 20     # edges with names that wait to be numbered together

PAIRS = ("hy_dm string, rank int, node string, v double, eigenvalue double, residual double, centrality double")
SOLVED = ("hy_dm string, n long, found int, done boolean, before double, scale double, residuals array<double>, "
          "values array<double>, best array<array<double>>, next array<double>, noise double, kept array<array<double>>, "
          "gram array<double>, cross array<double>, norms array<double>")


def by_magnitude(values: np.ndarray) -> np.ndarray:
    """Order of the values, largest magnitude first; of +-lambda the positive one."""
    most = np.abs(values).max(initial=0.0)
    return np.argsort(-np.abs(values) - TIE * np.sign(values) * most, kind="stable")


# whole industries --------------------------------------------------------------------------
def eigenpairs(a: np.ndarray, k: int, gramian: bool) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors as columns): the ``k`` leading eigenpairs of ``a``, or of its Gramian.

    Of several leading vectors the first is the projection of the uniform vector, as the
    iteration from a uniform start gives it.
    """
    if gramian:
        _, sigma, vt = np.linalg.svd(a)
        values, vectors = np.concatenate((sigma ** 2, np.zeros(len(vt) - len(sigma)))), vt.T
    else:
        values, vectors = np.linalg.eigh((a + a.T) / 2)
        order = by_magnitude(values)
        values, vectors = values[order], vectors[:, order]
    vectors = _uniform_first(values, vectors)
    return values[:k], vectors[:, :k]


def _uniform_first(values: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Of several leading vectors the first becomes the projection of the uniform vector."""
    tied = np.flatnonzero(np.abs(values - values[0]) <= TIE * abs(values[0]))
    if len(tied) > 1:
        space = vectors[:, tied]
        uniform = space.T @ np.ones(len(space))
        if np.linalg.norm(uniform) > TIE * len(space):          # turned inside the space: the others stay eigenvectors
            vectors[:, tied] = space @ np.linalg.qr(np.column_stack((uniform, np.eye(len(tied)))))[0]
    return vectors


def local_pairs(edges: pd.DataFrame, k: int, gramian: bool) -> pd.DataFrame:
    """The rows of PAIRS of one industry, given all its edges (hy_dm, src, dst, w)."""
    nodes, at = np.unique(np.concatenate((edges["src"].to_numpy(object), edges["dst"].to_numpy(object))), return_inverse=True)
    a = np.zeros((len(nodes), len(nodes)))
    np.add.at(a, (at[: len(edges)], at[len(edges):]), edges["w"].to_numpy(float))
    values, vectors = eigenpairs(a, k, gramian)
    parts, most = [], abs(float(values[0]))
    for rank, value in enumerate(values.tolist(), 1):
        v = vectors[:, rank - 1]
        v = -v if v.sum() < 0 else v
        product = a.T @ (a @ v) if gramian else a @ v
        length = float(np.linalg.norm(product - value * v))
        parts.append(pd.DataFrame({
            "hy_dm": edges["hy_dm"].iloc[0], "rank": rank, "node": nodes, "v": v, "eigenvalue": value,
            "residual": length / most if most else length, "centrality": np.abs(a) @ np.abs(v)}))
    return pd.concat(parts, ignore_index=True)


# larger industries, by their entries ------------------------------------------------------------
class Entries:
    """A sparse matrix by rows, multiplied with a few vectors at a time."""

    def __init__(self, rows: np.ndarray, cols: np.ndarray, w: np.ndarray, n: int):
        order = np.argsort(rows, kind="stable")
        rows, self.n = rows[order], n
        self.cols, self.w = cols[order], w[order]
        del order
        self.begins = np.flatnonzero(np.append(True, rows[1:] != rows[:-1])) if len(rows) else np.zeros(0, np.int64)
        self.rows = rows[self.begins]                           # rows with an entry

    def times(self, x: np.ndarray, w: np.ndarray | None = None) -> np.ndarray:
        w = self.w if w is None else w
        out, at, ends = np.zeros((self.n, x.shape[1])), 0, np.append(self.begins[1:], len(w))
        while at < len(self.begins):
            lo = self.begins[at]
            stop = max(at + 1, int(np.searchsorted(ends, lo + CHUNK, "right")))
            hi = ends[stop - 1]
            terms = x[self.cols[lo:hi]] * w[lo:hi, None]
            out[self.rows[at:stop]] = np.add.reduceat(terms, self.begins[at:stop] - lo, axis=0)
            at = stop
        return out


def _orthonormal(new: np.ndarray, basis: np.ndarray, scale: float, rng: np.random.Generator) -> np.ndarray:
    """Unit vectors orthogonal to the basis: the new ones, noise in place of those that are only rounding."""
    out = np.zeros((len(new), 0))
    for x in new.T:
        for attempt in range(4):
            if attempt or not np.linalg.norm(x) > NOISE * scale:
                x = rng.standard_normal(len(new))
            begun = np.linalg.norm(x)
            for _ in range(3):
                x = x - basis @ (basis.T @ x)
                x = x - out @ (out.T @ x)
            length = np.linalg.norm(x)
            if length > max(NOISE * scale if not attempt else 0.0, 1e-8 * begun if attempt else 0.0):
                out = np.column_stack((out, x / length))
                break
    return out


def krylov(product, n: int, k: int, tol: float, max_steps: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, vectors as columns, residuals relative to the largest value): leading eigenpairs of a symmetric operator.

    Block Lanczos with full orthogonalisation and thick restarts.  The block starts with the uniform
    vector and ``k`` vectors of noise, which no eigenvector is orthogonal to, so an eigenvalue that
    comes several times is found as often.  ``product`` multiplies a block.
    """
    rng = np.random.default_rng(n)
    width, wanted = min(n, k + 1), min(n, k)
    longest = min(n, max(LEAST_BASIS, 4 * width, min(MOST_BASIS, BASIS_BYTES // (8 * n))))
    kept = min(max(longest // 3, 2 * width), longest - width)
    basis, table, size = np.zeros((n, longest), order="F"), np.zeros((longest, longest)), 0
    block = _orthonormal(np.column_stack((np.ones(n), rng.standard_normal((n, width - 1)))), basis[:, :0], 1.0, rng)
    for step in range(1, max_steps + 1):
        new = slice(size, size + block.shape[1])
        basis[:, new] = block
        size = new.stop
        q, left = basis[:, :size], product(np.ascontiguousarray(block))
        across = q.T @ left
        left -= q @ across
        more = q.T @ left
        left -= q @ more
        across += more
        table[:size, new], table[new, :size] = across, across.T
        values, vectors = np.linalg.eigh((table[:size, :size] + table[:size, :size].T) / 2)
        order = by_magnitude(values)
        values, vectors = values[order], vectors[:, order]
        scale = max(abs(float(values[0])), 1e-300)
        ends = vectors[new]
        residuals = np.sqrt(np.maximum(np.einsum("ij,ik,kj->j", ends, left.T @ left, ends), 0.0)) / scale
        tied = np.abs(values - values[0]) <= TIE * scale
        needed = max(wanted, int(np.flatnonzero(tied)[-1]) + 1 if size < n and residuals[tied].max() <= LOST else wanted)
        if size == n or step == max_steps or (size >= wanted and (residuals[:needed] <= tol / 2).all()):
            break
        if size + width > longest:
            if longest == n:                                    # the rest of the space completes the basis
                width = n - size
                left = left[:, :width]
            else:
                basis[:, :kept] = q @ vectors[:, :kept]
                table[:] = 0.0
                table[range(kept), range(kept)] = values[:kept]
                size = kept
        block = _orthonormal(left, basis[:, :size], scale, rng)
        if not block.shape[1]:
            break
    out = min(size, max(wanted, needed))
    values, vectors = values[:out], basis[:, :size] @ vectors[:, :out]
    vectors = _uniform_first(values, vectors)
    values, vectors = values[:wanted], vectors[:, :wanted]
    lengths = np.linalg.norm(product(np.ascontiguousarray(vectors)) - vectors * values, axis=0)
    return values, vectors, lengths / scale


def _solve_entries(industry: str, names: list[str], rows: np.ndarray, cols: np.ndarray, w: np.ndarray, k: int, gramian: bool,
                   tol: float, max_steps: int) -> Iterator[pa.RecordBatch]:
    """The rows of SPARSE_PAIRS of one industry; of a symmetric matrix each pair of nodes is given once."""
    n = len(names)
    if gramian:
        there, back = Entries(rows, cols, w, n), Entries(cols, rows, w, n)

        def product(x: np.ndarray) -> np.ndarray:
            return back.times(there.times(x))
    else:
        off = rows != cols
        there = Entries(np.concatenate((rows, cols[off])), np.concatenate((cols, rows[off])), np.concatenate((w, w[off])), n)
        product = there.times
    del rows, cols, w
    values, vectors, residuals = krylov(product, n, k, tol, max_steps)
    absolute, node = np.abs(there.w), pa.array(names, pa.string())
    for rank, (value, residual) in enumerate(zip(values.tolist(), residuals.tolist()), 1):
        v = vectors[:, rank - 1]
        v = -v if v.sum() < 0 else v
        centrality = there.times(np.abs(v)[:, None], absolute)[:, 0]
        yield pa.RecordBatch.from_arrays(
            [pa.repeat(pa.scalar(industry, pa.string()), n), pa.repeat(pa.scalar(rank, pa.int32()), n), node, pa.array(v), pa.repeat(value, n),
             pa.repeat(residual, n), pa.array(centrality), pa.repeat(residual <= tol, n)], names=_SPARSE_NAMES)


SPARSE_PAIRS = PAIRS + ", converged boolean"
_SPARSE_NAMES = [f.split()[0] for f in SPARSE_PAIRS.split(", ")]


def sparse_pairs(batches: Iterator[pa.RecordBatch], k: int, gramian: bool, tol: float, max_steps: int) -> Iterator[pa.RecordBatch]:
    """The rows of SPARSE_PAIRS of the industries of a task, given their edges (hy_dm, src, dst, w) industry by industry.

    Node names become numbers as they come, ``WAITING_BYTES`` of edges at a time, so a task holds 16 bytes
    per edge and each name once.
    """
    industry, numbers, parts, waiting, size = None, {}, [], [], 0

    def numbered(column: pa.ChunkedArray) -> np.ndarray:
        coded = column.dictionary_encode()                      # its chunks share one dictionary
        known = [numbers.setdefault(name, len(numbers)) for name in coded.chunk(0).dictionary.to_pylist()]
        return np.array(known, np.int32)[np.concatenate([c.indices.to_numpy() for c in coded.chunks])]

    def number() -> None:
        edges = pa.Table.from_batches(waiting)
        waiting.clear()
        parts.append((numbered(edges.column(1)), numbered(edges.column(2)), edges.column(3).to_numpy()))

    def solve() -> Iterator[pa.RecordBatch]:
        number()
        rows, cols, w = (np.concatenate(p) for p in zip(*parts))
        parts.clear()
        names = sorted(numbers)
        place = np.empty(len(names), np.int32)
        place[[numbers[name] for name in names]] = np.arange(len(names), dtype=np.int32)
        numbers.clear()
        return _solve_entries(industry, names, place[rows], place[cols], w, k, gramian, tol, max_steps)

    for batch in batches:
        runs, lo = pc.run_end_encode(batch.column(0)), 0
        for name, hi in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
            if waiting and name != industry:
                yield from solve()
                size = 0
            elif size > WAITING_BYTES:
                number()
                size = 0
            industry, part, lo = name, batch.slice(lo, hi - lo), hi
            waiting.append(part)
            size += part.nbytes
    if waiting:
        yield from solve()


# iterated industries -------------------------------------------------------------------------
def ritz(gram: np.ndarray, cross: np.ndarray, norms: np.ndarray, count: int):
    """The ``count`` best Ritz pairs of a basis q with products z = A q, given all their inner products.

    Returns (values, coefficients [pairs, basis], estimated residuals relative to the largest
    value, the basis made orthonormal); fewer pairs if the basis spans less.
    """
    gram, cross = (gram + gram.T) / 2, (cross + cross.T) / 2
    scale = np.sqrt(np.maximum(np.diag(gram), 1e-300))
    w, u = np.linalg.eigh(gram / np.outer(scale, scale))
    good = w > 1e-12 * max(w.max(), 1e-300)
    white = u[:, good] / np.sqrt(w[good]) / scale[:, None]
    values, vectors = np.linalg.eigh(white.T @ cross @ white)
    order = by_magnitude(values)[:count]
    coefficients, values = (white @ vectors[:, order]).T, values[order]
    squares = [c @ norms @ c - 2 * v * (c @ cross @ c) + v * v * (c @ gram @ c) for c, v in zip(coefficients, values)]
    residuals = np.sqrt(np.maximum(squares, 0.0)) / max(np.abs(values).max(initial=0.0), 1e-300)
    return values, coefficients, residuals, white


def direction(gram, cross, norms, white, value: float, best: np.ndarray) -> tuple[float, np.ndarray]:
    """(scale, coefficients over (q, z)) of a pair's residual, orthogonal to the basis, over its length.

    The length is what the inner products tell; the length that is then measured gives the residual.
    """
    along = white @ (white.T @ (cross @ best - value * (gram @ best)))
    out = np.concatenate([-value * best - along, best])
    both = np.block([[gram, cross], [cross.T, norms]])
    scale = max(float(np.sqrt(max(out @ both @ out, 0.0))), 1e-9 * abs(value))   # below that it is noise
    return scale, out / scale if scale else 0 * out


def _tables(row, size: int) -> list[np.ndarray]:
    """The tables of all inner products, the newest vector's last."""
    out = []
    for before, column in ((row.gram, row.qq), (row.cross, row.qz), (row.norms, row.zz)):
        table = np.zeros((size, size))
        if size > 1:
            table[:-1, :-1] = np.array(before, float).reshape(size - 1, size - 1)
        table[:, -1] = table[-1, :] = np.array(column, float)
        out.append(table)
    return out


def solved(batches: Iterator[pd.DataFrame], size: int, k: int, tol: float, restart: bool, kept: int) -> Iterator[pd.DataFrame]:
    """One row per industry: the newest inner products and the solution before -> the solution.

    ``found`` pairs have converged.  The newest basis vector was the residual of the pair after
    them, so its measured length tells whether that one has now, too.  Then a vector of noise
    comes next, which no eigenvector is orthogonal to: so further vectors of an eigenvalue
    that has several are found as well.
    """
    for batch in batches:
        rows = []
        for r in batch.itertuples(index=False):
            gram, cross, norms = _tables(r, size)
            found, residuals, noise = int(r.found), list(r.residuals), 0.0
            wanted = min(k, int(r.n))
            values, best, estimates, white = ritz(gram, cross, norms, max(wanted, kept))
            if r.before == r.before:                            # not NaN: a residual was measured
                length = r.scale * np.sqrt(max(gram[-1, -1], 0.0))
                residual = float(length / abs(r.before) if r.before else length)
                residuals = residuals[:found] + [residual]
                if residual <= tol and (estimates[: found + 1] <= LOST).all():
                    found += 1
                    noise = float(found < wanted)
            lost = np.flatnonzero(estimates[:found] > max(LOST, 10 * tol))
            target = int(lost[0]) if len(lost) else found
            found = min(found, target) if len(lost) else found
            if noise or target >= len(values):
                before, scale, after = float("nan"), 0.0, np.zeros(2 * size)
                noise = float(found < wanted)
            else:
                before = float(np.abs(values).max())
                scale, after = direction(gram, cross, norms, white, float(values[target]), best[target])
            top = np.zeros((kept, size))
            top[: min(kept, len(best))] = best[:kept]
            tables = [top @ t @ top.T for t in (gram, cross, norms)] if restart else [gram, cross, norms]
            rows.append((r.hy_dm, int(r.n), found, found >= wanted, before, scale, residuals, values[:wanted].tolist(),
                         [c.tolist() for c in best[:wanted]], after.tolist(), noise, [t.tolist() for t in top],
                         *(t.ravel().tolist() for t in tables)))
        yield pd.DataFrame(rows, columns=[f.split()[0] for f in SOLVED.split(", ")])
