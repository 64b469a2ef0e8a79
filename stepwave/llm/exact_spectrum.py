"""Eigenvalues and eigenvectors of symmetric integer matrices, exactly through the characteristic polynomial.

The polynomial is found modulo many primes by Hessenberg reduction and joined by Chinese remaindering. All its roots are
real, so by Descartes' rule the sign changes of the shifted polynomial count the roots beyond a point exactly, repeated
ones included. Numbers are Python integers; the cost grows with the fourth power of the dimension.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np

#: Bits to which the trace is scaled up, so that roots as integers keep as many.
ROOT_BITS = 160
#: Bits behind the point of quotients, and of normalised vectors.
QUOTIENT_BITS, VECTOR_BITS = 192, 256
TURNS = 2


def is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide every number below 3.2e9."""
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_for(matrix: np.ndarray) -> list[int]:
    """Primes below 2^31 whose product exceeds twice every coefficient of the matrix's polynomial.

    For a matrix without negative eigenvalues no coefficient exceeds (1 + trace / d)^d.
    """
    d = len(matrix)
    limit = 2 * (2 + sum(int(matrix[i, i]) for i in range(d)) // max(d, 1)) ** d
    out, product, candidate = [], 1, (1 << 31) - 1
    while product <= limit:
        if is_prime(candidate):
            out.append(candidate)
            product *= candidate
        candidate -= 2
    return out


def hessenberg(a: np.ndarray, p: int) -> np.ndarray:
    """A similar matrix modulo ``p`` with zeros below the first subdiagonal; products of residues fit 64 bits."""
    a = a.copy()
    for j in range(len(a) - 2):
        rest = np.flatnonzero(a[j + 1 :, j])
        if not len(rest):
            continue
        pivot = j + 1 + int(rest[0])
        if pivot != j + 1:
            a[[j + 1, pivot]] = a[[pivot, j + 1]]
            a[:, [j + 1, pivot]] = a[:, [pivot, j + 1]]
        factor = a[j + 2 :, j] * pow(int(a[j + 1, j]), -1, p) % p
        a[j + 2 :] = (a[j + 2 :] - factor[:, None] * a[j + 1] % p) % p
        a[:, j + 1] = (a[:, j + 1] + (a[:, j + 2 :] * factor % p).sum(1)) % p
    return a


def polynomial_modulo(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(x - matrix) modulo ``p``, the constant one first."""
    d = len(matrix)
    h = hessenberg((matrix % p).astype(np.int64), p)
    leading = np.zeros((d + 1, d + 1), np.int64)  # polynomials of the leading blocks
    leading[0, 0] = 1
    for k in range(1, d + 1):
        weight, below = np.zeros(k, np.int64), 1
        for i in range(k - 1, -1, -1):
            weight[i] = h[i, k - 1] * below % p
            below = below * int(h[i, i - 1]) % p if i else 0
        leading[k, 1:] = leading[k - 1, :-1]
        leading[k] = (leading[k] - (weight[:, None] * leading[:k] % p).sum(0)) % p
    return leading[d]


def remaindered(residues: Iterator[tuple[int, list[int]]]) -> list[int]:
    """The coefficients, in the symmetric range, that leave these remainders modulo each prime."""
    value, product = [], 1
    for p, rest in residues:
        inverse = pow(product, -1, p)
        value = [v + product * ((r - v) * inverse % p) for v, r in zip(value or [0] * len(rest), rest, strict=True)]
        product *= p
    return [v - product if 2 * v > product else v for v in value]


def roots_above(polynomial: list[int], point: int) -> int:
    """Roots greater than ``point``, each as often as it occurs."""
    a = list(polynomial)
    for i in range(len(a) - 1):
        for j in range(len(a) - 2, i - 1, -1):
            a[j] += point * a[j + 1]
    signs = [x > 0 for x in a if x]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def value_at(polynomial: list[int], point: int) -> int:
    value = 0
    for c in reversed(polynomial):
        value = value * point + c
    return value


def largest_roots(polynomial: list[int], count: int) -> tuple[list[int], int]:
    """The ``count`` largest roots that are not zero, falling, as integers times 2^-bits, and ``bits``.

    For a polynomial without negative roots; a repeated root comes as often as it occurs.
    """
    d = len(polynomial) - 1
    trace = -polynomial[-2] if d else 0
    count = min(count, d - next(i for i, c in enumerate(polynomial) if c))
    bits = max(0, ROOT_BITS - trace.bit_length())
    scaled = [c << bits * (d - i) for i, c in enumerate(polynomial)]
    known: dict[int, int] = {0: d, trace << bits: 0}

    def above(point: int) -> int:
        if point not in known:
            known[point] = roots_above(scaled, point)
        return known[point]

    out = []
    for k in range(count):
        low, high = max(c for c in known if known[c] > k), min(c for c in known if known[c] <= k)
        while high - low > 1 and above(low) - above(high) > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if above(middle) > k else (low, middle)
        at_high = value_at(scaled, high)
        while high - low > 1 and at_high:  # one root inside: behind it the sign is that of the upper end
            middle = (low + high) // 2
            value = value_at(scaled, middle)
            if value == 0:
                high, at_high = middle, 0
            elif (value > 0) == (at_high > 0):
                high = middle
            else:
                low = middle
        out.append(high)
    return out, bits


def eigenvectors(matrix: np.ndarray, roots: list[int], bits: int) -> np.ndarray:
    """Unit eigenvectors (columns) for ``roots`` times 2^-bits, by inverse iteration in fixed-point numbers.

    Near the null space of matrix - root each solution is led by that space; earlier vectors are taken out of it, so
    that a repeated root gets orthogonal ones. The largest entry of a vector is positive.
    """
    d = len(matrix)
    rng, found, out = np.random.default_rng(11), [], []
    for root in roots:
        a = np.array([[int(x) << bits for x in row] for row in matrix], object)
        a[np.arange(d), np.arange(d)] -= root
        order, factors = np.arange(d), []
        for j in range(d):
            pivot = j + int(np.argmax(np.abs(a[j:, j])))
            a[[j, pivot]], order[[j, pivot]] = a[[pivot, j]], order[[pivot, j]]
            for f in factors:
                f[[j, pivot]] = f[[pivot, j]]
            a[j, j] = a[j, j] or 1
            factor = np.zeros(d, object)
            factor[j + 1 :] = (a[j + 1 :, j] << QUOTIENT_BITS) // a[j, j]
            a[j + 1 :, j:] -= np.outer(factor[j + 1 :], a[j, j:]) >> QUOTIENT_BITS
            factors.append(factor)
        y = np.array([int(x) << VECTOR_BITS for x in rng.integers(1, 1 << 62, d)], object)
        for _ in range(TURNS):
            y = np.array([int(x) << VECTOR_BITS + QUOTIENT_BITS for x in y], object)[order]
            for j, factor in enumerate(factors):
                y[j + 1 :] -= (factor[j + 1 :] * y[j]) >> QUOTIENT_BITS
            for j in range(d - 1, -1, -1):
                y[j] = (y[j] - int((a[j, j + 1 :] * y[j + 1 :]).sum())) // a[j, j]
            for _ in range(2):
                for u, square in found:
                    y = y - u * int((u * y).sum()) // square
            spare = max(int(abs(x)).bit_length() for x in y) - VECTOR_BITS
            y = y >> spare if spare > 0 else y << -spare
        found.append((y, int((y * y).sum())))
        unit = np.array([float(int(x)) for x in y]) / math.sqrt(found[-1][1])
        out.append(unit * (1 if unit[np.argmax(np.abs(unit))] > 0 else -1))
    return np.array(out).T.reshape(d, len(out))
