"""Eigenvalues and eigenvectors of a symmetric integer matrix through its exact characteristic polynomial.

The polynomial is found modulo primes and put together by remainders; since all its roots are real, the
number of roots above a point is exactly the number of sign changes of the shifted polynomial. Everything
is whole numbers of any size, so the matrix may be as large as the table that it was summed from.
"""

from __future__ import annotations

from math import comb, isqrt

import numpy as np

#: Binary places below the bound on the roots to which a root is found.
ROOT_BITS = 200
#: Binary places of the arithmetic behind eigenvectors.
WORK_BITS = 400


def _is_prime(n: int) -> bool:
    """Exact for n under 3 * 10**9."""
    if n % 2 == 0:
        return n == 2
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """Primes under 2**31, falling, whose product is over ``bound``."""
    found, product, n = [], 1, (1 << 31) - 1
    while product <= bound:
        if _is_prime(n):
            found.append(n)
            product *= n
        n -= 2
    return found


def coefficient_bound(trace: int, d: int) -> int:
    """No coefficient of the polynomial of a positive semidefinite matrix is larger (Maclaurin)."""
    return max(comb(d, k) * trace**k // d**k + 1 for k in range(d + 1))


def hessenberg(matrix: np.ndarray, p: int) -> np.ndarray:
    """A matrix similar to ``matrix`` modulo ``p`` with zeros below its first subdiagonal."""
    h = matrix % p
    d = len(h)
    for k in range(1, d - 1):
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        pivot = k + int(below[0])
        if pivot != k:
            h[[k, pivot]] = h[[pivot, k]]
            h[:, [k, pivot]] = h[:, [pivot, k]]
        ratio = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1 :] = (h[k + 1 :] - ratio[:, None] * h[k]) % p
        h[:, k] = (h[:, k] + (h[:, k + 1 :] * ratio % p).sum(axis=1)) % p
    return h


def polynomial_mod(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(xI - matrix) modulo ``p``, the constant first."""
    h = hessenberg(matrix, p)
    d = len(h)
    leading = np.zeros((d + 1, d + 1), dtype=np.int64)
    leading[0, 0] = 1
    for k in range(1, d + 1):
        new = np.zeros(d + 1, dtype=np.int64)
        new[1:] = leading[k - 1, :-1]
        chain, weights = 1, np.zeros(k, dtype=np.int64)
        weights[k - 1] = h[k - 1, k - 1]
        for i in range(k - 2, -1, -1):
            chain = chain * int(h[i + 1, i]) % p
            weights[i] = int(h[i, k - 1]) * chain % p
        leading[k] = (new - (leading[:k] * weights[:, None] % p).sum(axis=0)) % p
    return leading[d]


def from_residues(primes: list[int], residues: list[list[int]]) -> list[int]:
    """Integers (smallest in size) with the given remainders, one list of them per prime."""
    values, product = [0] * len(residues[0]), 1
    for p, row in zip(primes, residues):
        inverse = pow(product, -1, p)
        values = [v + product * ((int(r) - v) * inverse % p) for v, r in zip(values, row)]
        product *= p
    return [v - product if 2 * v > product else v for v in values]


def _shifted(coefficients: list[int], a: int) -> list[int]:
    out = list(coefficients)
    for i in range(len(out) - 1):
        for j in range(len(out) - 2, i - 1, -1):
            out[j] += a * out[j + 1]
    return out


def roots_above(coefficients: list[int], a: int) -> int:
    """How many roots, with multiplicity, are over ``a``; all roots must be real."""
    signs = [c > 0 for c in _shifted(coefficients, a) if c]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def _value(coefficients: list[int], x: int) -> tuple[int, int]:
    value = slope = 0
    for c in reversed(coefficients):
        slope = slope * x + value
        value = value * x + c
    return value, slope


def _refined(coefficients: list[int], low: int, high: int) -> int:
    """The whole number at or just over the only root in (low, high], by Newton steps kept in the bracket."""
    rising = _value(coefficients, high)[0]
    if rising == 0:
        return high
    x, turn = (low + high) // 2, 0
    while high - low > 1:
        value, slope = _value(coefficients, x)
        if value == 0:
            return x
        if (value > 0) == (rising > 0):
            high = x
        else:
            low = x
        step = x - value // slope if slope else low
        # A step past the other side of the root by one closes the bracket around it.
        x = step + (1 if x == low else -1)
        turn += 1
        if turn % 4 == 0 or not low < x < high:
            x = (low + high) // 2
    return high


def largest_roots(coefficients: list[int], most: int, hints: list[float]) -> tuple[list[tuple[int, int]], int]:
    """([(numerator, multiplicity)] of the largest positive roots, falling, and the binary places of the numerators.

    Clusters are listed whole until ``most`` roots are covered; roots closer than a unit of the numerator
    are one cluster. ``hints`` are points where to cut first; what lies between cuts is counted exactly.
    """
    d = len(coefficients) - 1
    bound = max(1, -coefficients[d - 1])
    places = max(0, ROOT_BITS - bound.bit_length())
    scaled = [c << (places * (d - k)) for k, c in enumerate(coefficients)]
    cuts = sorted({int(h * (1 << 60)) << places >> 60 for h in hints if 0 < h < bound})
    found: list[tuple[int, int]] = []
    pending = [(0, bound << places, roots_above(scaled, 0), 0)]
    while pending and sum(m for _, m in found) < most:
        low, high, over_low, over_high = pending.pop()
        inside = over_low - over_high
        if not inside:
            continue
        # A root within a unit of zero counts as zero.
        if inside == 1 and low > 0:
            found.append((_refined(scaled, low, high), 1))
            continue
        if high - low <= 1:
            if low > 0:
                found.append((high, inside))
            continue
        between = [c for c in cuts if low < c < high]
        middle = between[len(between) // 2] if between else (low + high) // 2
        over = roots_above(scaled, middle)
        pending += [(low, middle, over_low, over), (middle, high, over, over_high)]
    return found, places


def null_vectors(matrix: list[list[int]], root: int, places: int, count: int) -> np.ndarray:
    """``count`` orthonormal vectors that ``matrix`` takes to ``root`` / 2**places times themselves.

    Inverse iteration in fixed-point numbers of ``WORK_BITS`` places: the matrix less the root is all but
    singular, so that two solutions leave nothing but its null space. Rows are float64.
    """
    d = len(matrix)
    up = max(0, WORK_BITS - max(1, max(abs(v) for row in matrix for v in row)).bit_length())
    a = np.array([[v << up for v in row] for row in matrix], dtype=object)
    shift = root << up >> places
    for i in range(d):
        a[i, i] -= shift
    one = WORK_BITS
    order = list(range(d))
    for k in range(d):
        pivot = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
        if pivot != k:
            a[[k, pivot]] = a[[pivot, k]]
            order[k], order[pivot] = order[pivot], order[k]
        if a[k, k] == 0:
            a[k, k] = 1
        for i in range(k + 1, d):
            ratio = (a[i, k] << one) // a[k, k]
            a[i, k] = ratio
            if ratio:
                a[i, k + 1 :] -= (a[k, k + 1 :] * ratio) >> one

    def solved(b: list[int]) -> list[int]:
        x = np.array([b[i] for i in order], dtype=object)
        for k in range(d):
            x[k + 1 :] -= (a[k + 1 :, k] * x[k]) >> one
        for k in range(d - 1, -1, -1):
            x[k] = (x[k] << one) // a[k, k]
            x[:k] -= (a[:k, k] * x[k]) >> one
        return list(x)

    def unit(v: list[int]) -> list[int]:
        size = isqrt(sum(x * x for x in v)) or 1
        return [(x << one) // size for x in v]

    rng = np.random.default_rng(1)
    basis: list[list[int]] = []
    for _ in range(count):
        v = unit([int(x) << one for x in rng.integers(1, 1 << 20, d)])
        for _ in range(2):
            v = unit(solved(v))
            for b in basis:
                along = sum(x * y for x, y in zip(v, b)) >> one
                v = [x - (along * y >> one) for x, y in zip(v, b)]
            v = unit(v)
        basis.append(v)
    return np.array([[float(x >> (one - 120)) / 2.0**120 for x in v] for v in basis])
