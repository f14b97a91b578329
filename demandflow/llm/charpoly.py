"""Exact eigenvalues and eigenvectors of a small integer covariance scatter.

The matrix is positive semi-definite with integer entries, so its characteristic polynomial has
integer coefficients, only real roots >= 0, and coefficients of alternating sign.  That makes
every step exact:

* modulo a prime the matrix is brought to Hessenberg form and the polynomial read off by its
  recurrence (:func:`charpoly_mod`, many primes at once);
* Chinese remainders give the coefficients, as enough primes exceed their bound
  ``C(d, k) (trace / d)^k``;
* a polynomial with only real roots has as many roots above ``a`` as ``p(x + a)`` has sign
  changes, so roots are counted, isolated and refined with whole numbers alone;
* repeated roots are found by the greatest common divisor with the derivative, so that the
  search for distinct roots ends;
* an eigenvector is the null space of ``M - mu``, found by inverse iteration with as many
  decimal digits as the gap to the neighbouring roots asks for.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal, localcontext
from fractions import Fraction

import numpy as np

# ------------------------------------------------------------------ primes and residues


def _is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide every n below 3.2e9."""
    if n < 2 or any(n % q == 0 for q in (2, 3, 5, 7)):
        return n in (2, 3, 5, 7)
    d, r = n - 1, 0
    while d % 2 == 0:
        d, r = d // 2, r + 1
    for a in (2, 3, 5, 7):
        x = pow(a, d, n)
        if x in (1, n - 1):
            continue
        for _ in range(r - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_below(top: int = 2**31) -> Iterator[int]:
    n = top - 1
    while n > 2:
        if _is_prime(n):
            yield n
        n -= 2


def bound_bits(dim: int, trace: int) -> int:
    """Bits of the largest coefficient: elementary symmetric functions of ``dim`` numbers >= 0
    with this sum are largest when all are equal."""
    mean = Fraction(trace, dim)
    best = max(math.comb(dim, k) * mean.numerator**k // mean.denominator**k for k in range(dim + 1))
    return best.bit_length() + 1


def primes_for(dim: int, trace: int) -> list[int]:
    """Primes whose product exceeds the bound of every coefficient."""
    need, product, out = 1 << bound_bits(dim, trace), 1, []
    for p in primes_below():
        out.append(p)
        product *= p
        if product > need:
            return out
    raise ArithmeticError("no primes left")


def _power(base: np.ndarray, exponent: np.ndarray, p: np.ndarray) -> np.ndarray:
    out = np.ones_like(base)
    while exponent.any():
        out = np.where(exponent & 1, out * base % p, out)
        base = base * base % p
        exponent = exponent >> 1
    return out


def hessenberg_mod(a: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Similar upper Hessenberg matrices of ``a`` (primes x d x d), each modulo its prime."""
    d, each = a.shape[1], np.arange(len(p))
    q = p[:, None]
    for k in range(1, d - 1):
        pivot = k + (a[:, k:, k - 1] != 0).argmax(1)
        a[each, k], a[each, pivot] = a[each, pivot].copy(), a[each, k].copy()
        a[each, :, k], a[each, :, pivot] = a[each, :, pivot].copy(), a[each, :, k].copy()
        # a column without a pivot needs no step: the power of 0 is 0
        u = a[:, k + 1:, k - 1] * _power(a[:, k, k - 1], p - 2, p)[:, None] % q
        a[:, k + 1:, k - 1:] = (a[:, k + 1:, k - 1:] - u[:, :, None] * a[:, k, None, k - 1:] % q[:, :, None]) % q[:, :, None]
        a[:, :, k] = (a[:, :, k] + (a[:, :, k + 1:] * u[:, None, :] % q[:, :, None]).sum(2)) % q
    return a


def charpoly_mod(matrix: np.ndarray, primes: list[int]) -> np.ndarray:
    """Coefficients of ``det(x - matrix)``, constant first, modulo each prime (all below 2^31)."""
    d, p = len(matrix), np.array(primes, np.int64)
    q = p[:, None]
    a = np.stack([(matrix % m).astype(np.int64) for m in primes])
    h = hessenberg_mod(a, p)
    c = np.zeros((len(p), d + 1, d + 1), np.int64)
    c[:, 0, 0] = 1
    for k in range(1, d + 1):
        new = np.roll(c[:, k - 1], 1, 1) - h[:, k - 1, k - 1, None] * c[:, k - 1] % q
        below = np.ones_like(p)
        for i in range(k - 2, -1, -1):
            below = below * h[:, i + 1, i] % p
            factor = below * h[:, i, k - 1] % p
            new[:, :i + 1] -= factor[:, None] * c[:, i, :i + 1] % q
        c[:, k] = new % q
    return c[:, d]


def chinese(residues: np.ndarray, primes: list[int], degree: int) -> list[int]:
    """Integer coefficients, highest power first, of a polynomial of this degree with only real
    roots >= 0, from its residues (constant first) modulo primes: the sign of each is known."""
    product = math.prod(primes)
    weights = []
    for p in primes:
        rest = product // p
        weights.append(rest * pow(rest, -1, p))
    out = []
    for j in range(degree + 1):
        sign = -1 if j % 2 else 1
        column = residues[:, degree - j].tolist()
        out.append(sign * (sum(w * (sign * int(r) % p) for w, r, p in zip(weights, column, primes, strict=True)) % product))
    return out


# ------------------------------------------------------------------ polynomials (highest power first)


def derivative(p: list[int]) -> list[int]:
    n = len(p) - 1
    return [c * (n - i) for i, c in enumerate(p[:-1])]


def _gcd_mod(a: list[int], b: list[int], m: int) -> list[int]:
    """Monic greatest common divisor modulo a prime."""
    def trimmed(x):
        k = next((i for i, c in enumerate(x) if c), len(x))
        return x[k:]

    a, b = trimmed([c % m for c in a]), trimmed([c % m for c in b])
    while b:
        inverse = pow(b[0], -1, m)
        while len(a) >= len(b):
            f = a[0] * inverse % m
            a = trimmed([(x - f * y) % m for x, y in zip(a, b + [0] * (len(a) - len(b)), strict=True)][1:])
        a, b = b, a
    inverse = pow(a[0], -1, m)
    return [c * inverse % m for c in a]


def _divided(a: list[int], b: list[int]) -> list[int] | None:
    """``a / b`` for a monic ``b``; None if there is a remainder."""
    a, out = list(a), []
    for i in range(len(a) - len(b) + 1):
        f = a[i]
        out.append(f)
        if f:
            for j, c in enumerate(b):
                a[i + j] -= f * c
    return None if any(a[len(out):]) else out


def square_free(p: list[int], primes: list[int]) -> list[int]:
    """The monic polynomial with the same roots, each once.  Modulo any prime the common divisor
    with the derivative is at least as long as the true one, so degree 0 proves that no root
    repeats; else the shortest ones are put together and checked by division."""
    d = derivative(p)
    if len(_gcd_mod(p, d, primes[0])) == 1:
        return p
    found = [(m, _gcd_mod(p, d, m)) for m in primes]
    least = min(len(g) for _, g in found)
    kept = [(m, g) for m, g in found if len(g) == least]
    residues = np.array([g[::-1] for _, g in kept], dtype=object)
    common = chinese(residues, [m for m, _ in kept], least - 1)
    out = _divided(p, common)
    if out is None or _divided(d, common) is None:
        raise ArithmeticError("too few primes agree on the common divisor")
    return out


def roots_above(p: list[int], m: int, s: int) -> int:
    """How many roots (with their multiplicities) are above ``m / 2^s``; all roots are real."""
    c = [x << (s * i) for i, x in enumerate(p)]
    n = len(c)
    for i in range(n - 1):
        for j in range(1, n - i):
            c[j] += m * c[j - 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def _sign(p: list[int], m: int, s: int) -> int:
    v = 0
    for i, c in enumerate(p):
        v = v * m + (c << (s * i))
    return (v > 0) - (v < 0)


class Interval:
    """One root of a square-free polynomial in ``(lo, hi] / 2^s``."""

    def __init__(self, lo: int, hi: int, s: int):
        self.lo, self.hi, self.s = lo, hi, s

    def low(self) -> Fraction:
        return Fraction(self.lo, 1 << self.s)

    def high(self) -> Fraction:
        return Fraction(self.hi, 1 << self.s)

    def halve(self, p: list[int], above: int) -> None:
        """``above``: the sign of ``p`` just above the root."""
        self.lo, self.hi, self.s = 2 * self.lo, 2 * self.hi, self.s + 1
        mid = (self.lo + self.hi) // 2
        sign = _sign(p, mid, self.s)
        if sign == 0:
            self.lo, self.hi = 2 * mid - 1, 2 * mid
            self.s += 1
        elif sign == above:
            self.hi = mid
        else:
            self.lo = mid


def largest_roots(p: list[int], trace: int, count: int) -> list[Interval]:
    """Isolating intervals of up to ``count`` largest roots of a square-free polynomial whose
    roots are real and > 0, in falling order."""
    stack = [(0, trace + 1, 0, len(p) - 1, 0)]
    out: list[Interval] = []
    while stack and len(out) < count:
        lo, hi, s, above_lo, above_hi = stack.pop()
        if above_lo == above_hi:
            continue
        if above_lo - above_hi == 1:
            out.append(Interval(lo, hi, s))
            continue
        lo, hi, s = 2 * lo, 2 * hi, s + 1
        mid = (lo + hi) // 2
        above = roots_above(p, mid, s)
        stack += [(lo, mid, s, above_lo, above), (mid, hi, s, above, above_hi)]
    return out


def refine(p: list[int], roots: list[Interval], bits: int = 100) -> list[Fraction]:
    """Narrow the intervals to 2^-bits of the root and of the gap to its neighbours; returns the
    least gap of each."""
    gaps = []
    for k, r in enumerate(roots):
        above = 1 if k % 2 == 0 else -1
        while r.lo == 0:
            r.halve(p, above)
    for k, r in enumerate(roots):
        above = 1 if k % 2 == 0 else -1
        while True:
            near = [r.low()]
            if k:
                near.append(roots[k - 1].low() - r.high())
            if k + 1 < len(roots):
                near.append(r.low() - roots[k + 1].high())
            if min(near) > 0 and (r.high() - r.low()) * (1 << bits) <= min(near):
                gaps.append(min(near))
                break
            r.halve(p, above)
            if k + 1 < len(roots) and near[-1] <= 0:
                roots[k + 1].halve(p, -above)
            if k and near[1] <= 0:
                roots[k - 1].halve(p, -above)
    return gaps


# ------------------------------------------------------------------ eigenvectors


def _unit(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Orthonormal columns; twice, against rounding."""
    for _ in range(2):
        done: list[np.ndarray] = []
        for v in columns:
            for u in done:
                v = v - (u * v).sum() * u
            done.append(v / (v * v).sum().sqrt())
        columns = done
    return columns


def null_space(matrix: np.ndarray, mu: Fraction, gap: Fraction, size: int, rounds: int = 3) -> list[list[float]]:
    """``size`` orthonormal eigenvectors of the eigenvalue that ``mu`` approximates, by inverse
    iteration: one elimination of ``matrix - mu`` and ``rounds`` solves from fixed, scattered
    vectors.  Errors shrink by (error of mu / gap) a round, and the digits carried exceed those
    that the gap uses up."""
    d = len(matrix)
    largest = max(1, max(abs(int(x)) for x in matrix.ravel()))
    lost = max(0, math.ceil(math.log10(d * largest) - (math.log10(gap.numerator) - math.log10(gap.denominator))))
    with localcontext() as context:
        context.prec = 60 + lost
        value = Decimal(mu.numerator) / Decimal(mu.denominator)
        a = np.array([[Decimal(int(x)) for x in row] for row in matrix], dtype=object)
        for i in range(d):
            a[i, i] -= value
        lu, order = a.copy(), list(range(d))
        tiny = Decimal(largest).scaleb(-context.prec)
        for k in range(d):
            best = max(range(k, d), key=lambda i: abs(lu[i, k]))
            if best != k:
                lu[[k, best]] = lu[[best, k]]
                order[k], order[best] = order[best], order[k]
            if abs(lu[k, k]) < tiny:
                lu[k, k] = tiny
            lu[k + 1:, k] = lu[k + 1:, k] / lu[k, k]
            lu[k + 1:, k + 1:] = lu[k + 1:, k + 1:] - np.multiply.outer(lu[k + 1:, k], lu[k, k + 1:])

        def solved(v: np.ndarray) -> np.ndarray:
            x = v[order].copy()
            for k in range(d):
                x[k + 1:] = x[k + 1:] - lu[k + 1:, k] * x[k]
            for k in range(d - 1, -1, -1):
                x[k] = x[k] / lu[k, k]
                x[:k] = x[:k] - lu[:k, k] * x[k]
            return x

        wanted = Decimal(10) ** -30 * d * largest
        for attempt in range(1, 9):
            seed, columns = 12345 * attempt, []
            for _ in range(size):
                entries = []
                for _ in range(d):
                    seed = (seed * 6364136223846793005 + 1442695040888963407) % 2**64
                    entries.append(Decimal((seed >> 33) - 2**30))
                columns.append(np.array(entries, dtype=object))
            for _ in range(rounds):
                columns = _unit([solved(v) for v in columns])
            if all(abs(x) <= wanted for v in columns for x in a.dot(v)):
                return [[float(x) for x in v] for v in columns]
    raise ArithmeticError("inverse iteration did not converge")
