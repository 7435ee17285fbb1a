"""Singular values and right singular vectors of a small square matrix by bidiagonalisation and qd transforms.

Householder reflections bring the matrix to upper bidiagonal form, dqds finds
the squared singular values (from the smallest up, by shifts that stay below
the smallest), and a twisted factorisation at each of them gives its vector.
Values too close for that to tell apart share a subspace, for which
inverse iteration and a Rayleigh-Ritz step give orthonormal vectors.
"""

from __future__ import annotations

import math

import numpy as np

EPS = float(np.finfo(np.float64).eps)
#: Relative gap under which neighbouring values are handled together.
CLOSE = 1e-5


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal and superdiagonal of ``U' r V``, and the reflectors of ``V`` (column ``k`` on, from column 1)."""
    m = np.array(r, np.float64)
    d = len(m)
    right: list[np.ndarray] = []

    def reflector(x: np.ndarray) -> np.ndarray:
        v = x.copy()
        norm = math.sqrt(float(v @ v))
        if norm == 0:
            return v
        v[0] += math.copysign(norm, v[0])
        return v / math.sqrt(float(v @ v))

    for k in range(d):
        u = reflector(m[k:, k])
        m[k:, k:] -= 2 * np.outer(u, u @ m[k:, k:])
        if k + 1 < d:
            v = reflector(m[k, k + 1:])
            m[k:, k + 1:] -= 2 * np.outer(m[k:, k + 1:] @ v, v)
            right.append(v)
    return np.diag(m).copy(), np.diag(m, 1).copy(), right


def back(z: np.ndarray, right: list[np.ndarray]) -> np.ndarray:
    """``V z``."""
    z = z.copy()
    for k in range(len(right) - 1, -1, -1):
        v = right[k]
        z[k + 1:] -= 2 * v * (v @ z[k + 1:])
    return z


def dqds(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One differential qd step with a shift: the new ``q`` and ``e``, and the ``d`` on the way (a negative one ends it)."""
    n = len(q)
    nq, ne, ds = [0.0] * n, [0.0] * (n - 1), [0.0] * n
    d = q[0] - shift
    for k in range(n - 1):
        ds[k] = d
        if d < 0:
            break
        nq[k] = d + e[k]
        if nq[k] == 0:  # a zero value: it moves down the array
            ne[k], d = 0.0, q[k + 1] - shift
        else:
            t = q[k + 1] / nq[k]
            ne[k], d = e[k] * t, d * t - shift
    nq[n - 1] = ds[n - 1] = d
    return nq, ne, ds


def squared_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The squared singular values, falling, of the bidiagonal matrix with diagonal ``a`` and superdiagonal ``b``."""
    scale = max([0.0, *np.abs(a), *np.abs(b)])
    if scale == 0:
        return np.zeros(len(a))
    todo = [([float(x) ** 2 for x in a / scale], [float(x) ** 2 for x in b / scale], 0.0)]
    found: list[float] = []
    while todo:
        q, e, moved = todo.pop()
        for _ in range(100 * len(q) + 200):
            n = len(q)
            if n == 0:
                break
            if n == 1:
                found.append(q.pop() + moved)
                continue
            cut = next((k for k in range(n - 2, -1, -1) if e[k] <= EPS * EPS * (q[k] + moved) or e[k] <= EPS * EPS * (q[k + 1] + moved)), None)
            if cut == n - 2:
                found.append(q.pop() + moved)
                e.pop()
                continue
            if cut is not None:
                todo.append((q[:cut + 1], e[:cut], moved))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            if q[0] < q[-1]:  # the small end last
                q, e = flipped(q, e)
            _, _, ds = dqds(q, e, 0.0)
            # 1 / d are the diagonal of the inverse, so 1 over their sum is below the smallest value.
            shift = 0.0 if min(ds) <= 0 else (1 - 8 * n * EPS) / sum(1 / x for x in ds)
            while True:
                nq, ne, ds = dqds(q, e, shift)
                if min(ds) >= 0 or shift == 0:
                    break
                shift = shift / 2 if shift > EPS * max(ds) else 0.0
            q, e, moved = nq, ne, moved + shift
        else:
            raise ArithmeticError("dqds didn't converge")
    return np.sort(np.array(found))[::-1] * scale**2


def flipped(q: list[float], e: list[float]) -> tuple[list[float], list[float]]:
    """Both reversed: the transpose with rows and columns in reverse is upper bidiagonal too and has the same values."""
    return q[::-1], e[::-1]


def twisted(a: np.ndarray, b: np.ndarray, value: float) -> tuple[np.ndarray, np.ndarray]:
    """The vector of ``B'B`` for ``value`` by the twisted factorisation, and the sizes ``gamma`` of all twists."""
    n = len(a)
    tiny = max(EPS * EPS * max([value, *(a * a), *(b * b)]), np.finfo(float).tiny)
    q = np.where(np.abs(a) < math.sqrt(tiny), math.sqrt(tiny), a)
    ld, low = q * q, b / q[:-1] if n > 1 else b  # B'B = L D L', with D = ld, L = low
    nonzero = lambda x: x if abs(x) > tiny else -tiny
    lp, s = np.zeros(max(n - 1, 0)), np.zeros(n)
    s[0] = -value
    for i in range(n - 1):  # from the top: L+ D+ L+'
        dp = nonzero(ld[i] + s[i])
        lp[i] = ld[i] * low[i] / dp
        s[i + 1] = lp[i] * low[i] * s[i] - value
    um, p = np.zeros(max(n - 1, 0)), np.zeros(n)
    p[n - 1] = ld[n - 1] - value
    for i in range(n - 2, -1, -1):  # from the bottom: U- D- U-'
        dm = nonzero(ld[i] * low[i] ** 2 + p[i + 1])
        t = ld[i] / dm
        um[i] = low[i] * t
        p[i] = p[i + 1] * t - value
    gamma = s + p + value
    k = int(np.argmin(np.abs(gamma)))
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -lp[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -um[i] * z[i]
    return z / np.linalg.norm(z), np.abs(gamma)


def vectors(a: np.ndarray, b: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    """Orthonormal vectors of ``B'B`` (as rows) for the first ``count`` of its falling ``values``."""
    n = len(a)
    out: list[np.ndarray] = []
    i = 0
    while i < min(count, n):
        j = i + 1
        while j < n and values[j - 1] - values[j] <= CLOSE * values[j - 1]:
            j += 1
        out += [twisted(a, b, float(values[i]))[0]] if j - i == 1 else list(cluster(a, b, values[i:j], min(j, count) - i))
        i = j
    return np.array(out[:count])


def cluster(a: np.ndarray, b: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    """The vectors of ``count`` neighbouring ``values``: inverse iteration from the twists, each kept off those before it, then Rayleigh-Ritz."""
    n = len(a)
    full = np.diag(a) + np.diag(b, 1)
    t = full.T @ full
    noise = np.random.default_rng(0)
    out = np.zeros((0, n))
    for k in range(count):
        z = twisted(a, b, float(values[k]))[0] + 1e-3 * noise.standard_normal(n)  # equal values give equal twists
        shift = values[k] + 4 * (k + 1) * EPS * max(values[0], EPS * float(np.abs(t).max()))
        for _ in range(4):
            z -= out.T @ (out @ z)
            z /= np.linalg.norm(z)
            try:
                z = np.linalg.solve(t - shift * np.eye(n), z)
            except np.linalg.LinAlgError:  # the shift is a value to the last bit
                shift += 64 * EPS * float(np.abs(t).max())
        for _ in range(2):
            z -= out.T @ (out @ z)
            z /= np.linalg.norm(z)
        out = np.vstack([out, z])
    return np.linalg.svd(full @ out.T, full_matrices=False)[2] @ out


def right_vectors(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """All squared singular values of square ``r``, falling, and up to ``count`` of its first right singular vectors as rows.

    Values that are zero but for rounding have no vector. Each vector's
    largest entry (the first of equal ones) is positive.
    """
    a, b, right = bidiagonalise(r)
    values = squared_values(a, b)
    count = min(count, int(np.sum(values > (8 * len(r) * EPS) ** 2 * values[:1])))
    out = np.array([back(z, right) for z in vectors(a, b, values, count)]).reshape(-1, len(r))
    lead = out[np.arange(len(out)), np.argmax(np.abs(out), axis=1)] if len(out) else np.zeros(0)
    return values, out * np.where(lead < 0, -1.0, 1.0)[:, None]
