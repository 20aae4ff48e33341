"""Whitening of embeddings with principal components from an exact characteristic polynomial.

Vectors become integers, so their scatter M = n * sum(y y') - sum(y) sum(y)' (y: integers less
the rounded mean) is exact: M is n * n times the covariance.  Its characteristic polynomial
is found modulo many primes (reduction to Hessenberg form, one prime a row of a Spark job)
and put together by Chinese remaindering.  All its roots are real and none is negative, so
the sign changes of its Taylor shift at a point count the roots beyond that point exactly;
halving isolates the largest roots.  Each isolated root is refined to ROOT_BITS bits and its
component follows from inverse iteration in long decimals (one root a row of a Spark job).

Spark does what grows with the rows: sums, scatter, whitening and the check of the result.
The driver sees only the d x d scatter, its d + 1 coefficients and the components.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from decimal import Decimal, localcontext
from fractions import Fraction
from math import comb, prod

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import drop, materialize, quoted

#: fixed values of the integer form floor(SCALE * c) + SHIFT
SCALE, SHIFT = 64, 1_000_000
#: vectors with larger integers are left out, as their scatter would not fit
MOST = 1 << 60
LIMB, PART, ROWS = 20, 60, 4096
ROOT_BITS, DIGITS, ROUNDS = 160, 110, 3
OUT_ROWS = 1 << 17


def integer_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, lengths, values): which vectors of a list<double> column count, their lengths, and their integers end to end.

    A vector counts if it is not NULL and has no entry that is NULL, NaN, infinite or beyond MOST.
    """
    there = ~np.asarray(column.is_null())
    lengths = np.zeros(len(column), np.int64)
    lengths[there] = column.drop_null().value_lengths().to_numpy(zero_copy_only=False)
    c = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)  # NULL entries become NaN
    bad = ~(np.abs(c) < MOST / SCALE / 2)
    fine = there
    if bad.any():
        upto = np.r_[0, np.cumsum(bad)]
        stop = np.cumsum(lengths)
        fine = there & (upto[stop] == upto[stop - lengths])
        c = c[np.repeat(fine, lengths)]
    return np.flatnonzero(fine), lengths[fine], np.floor(c * SCALE).astype(np.int64) + SHIFT


def matrix_of(column: pa.Array, d: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, x): which vectors of a column count and have length d, and their integers as rows."""
    rows, lengths, values = integer_rows(column)
    own = lengths == d
    return rows[own], (values if own.all() else values[np.repeat(own, lengths)]).reshape(int(own.sum()), d)


def totals(vectors: DataFrame) -> tuple[int, int, list[int]]:
    """(d, n, sums): the commonest length of the vectors that count (the longest of equally common ones), how many have it, and their exact sum.

    A task sends one row a length and place; no vectors, or empty ones: zeros.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, list] = {}
        for batch in batches:
            _, lengths, values = integer_rows(batch.column(0))
            for d in np.unique(lengths).tolist():
                own = lengths == d
                x = values[np.repeat(own, lengths)].reshape(int(own.sum()), d)
                low = (x & ((1 << 30) - 1)).sum(axis=0)  # two halves, as a sum of large integers may not fit
                total = [(int(h) << 30) + int(v) for h, v in zip((x >> 30).sum(axis=0), low)]
                had = seen.setdefault(d, [0, [0] * d])
                seen[d] = [had[0] + len(x), [p + q for p, q in zip(had[1], total)]]
        for d, (n, sums) in seen.items():
            yield pa.record_batch([pa.array([d] * (d + 1), pa.int32()), pa.array(range(-1, d), pa.int32()), pa.array([Decimal(n), *map(Decimal, sums)], pa.decimal128(38, 0))], names=["d", "at", "s"])

    sent = materialize(vectors.mapInArrow(run, "d int, at int, s decimal(38,0)").groupBy("d", "at").agg(F.sum("s").alias("s")), "vector-sums")
    top = sent.filter("at < 0").orderBy(F.desc("s"), F.desc("d")).first()
    if top is None or not top["d"]:
        return 0, 0, []
    by = {r["at"]: int(r["s"]) for r in sent.filter(F.col("d") == top["d"]).collect()}
    drop(sent)
    return top["d"], by[-1], [by[k] for k in range(top["d"])]


def exact_gram(y: np.ndarray) -> np.ndarray:
    """y'y of a few thousand int64 rows as Python integers: products of 20-bit limbs are exact in doubles."""
    limbs, rest = [], y
    while rest.any() or not limbs:
        low = ((rest + (1 << LIMB - 1)) & ((1 << LIMB) - 1)) - (1 << LIMB - 1)
        limbs.append(low.astype(np.float64))
        rest = (rest - low) >> LIMB
    out = np.zeros((y.shape[1], y.shape[1]), object)
    for a, left in enumerate(limbs):
        for b, right in enumerate(limbs):
            out += (left.T @ right).astype(np.int64).astype(object) << LIMB * (a + b)
    return out


def scatter(vectors: DataFrame, d: int, n: int, sums: list[int]) -> tuple[list[list[int]], list[int]]:
    """(M, centre): M[i][j] = n * n * covariance, exact; centre is the mean rounded to integers, taken off before multiplying.

    Each task sends d * (d + 1) / 2 numbers, summed by place in Spark.
    """
    centre = [(2 * s + n) // (2 * n) for s in sums]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = np.zeros((d, d), object)
        for batch in batches:
            y = matrix_of(batch.column(0), d)[1] - np.array(centre, np.int64)
            for at in range(0, len(y), ROWS):
                got += exact_gram(y[at : at + ROWS])
        i, j = np.triu_indices(d)
        rest, part = got[i, j], 0
        while rest.any():  # digits of base 2**PART, from minus half to half of it
            low = (rest + (1 << PART - 1)) % (1 << PART) - (1 << PART - 1)
            yield pa.record_batch([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(np.full(len(i), part, np.int32)), pa.array(low.astype(np.int64))], names=["i", "j", "part", "v"])
            rest, part = (rest - low) >> PART, part + 1

    sent = vectors.mapInArrow(run, "i int, j int, part int, v long")
    rest = [s - n * c for s, c in zip(sums, centre)]
    m = [[-rest[i] * rest[j] for j in range(d)] for i in range(d)]
    for r in sent.groupBy("i", "j", "part").agg(F.sum(F.col("v").cast("decimal(20,0)")).alias("v")).collect():
        add = n * (int(r["v"]) << PART * r["part"])
        m[r["i"]][r["j"]] += add
        if r["i"] != r["j"]:
            m[r["j"]][r["i"]] += add
    return m, centre


def is_prime(p: int) -> bool:
    """Miller-Rabin; these bases decide below 3,215,031,751."""
    if p < 2 or p % 2 == 0:
        return p == 2
    odd, twos = p - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        if base % p == 0:
            continue
        x = pow(base, odd, p)
        if x not in (1, p - 1) and all((x := x * x % p) != p - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_above(bound: int) -> list[int]:
    """Primes below 2**31, largest first, whose product is above bound."""
    out, p, product = [], (1 << 31) - 1, 1
    while product <= bound:
        if is_prime(p):
            out.append(p)
            product *= p
        p -= 2
    return out


def polynomial_mod(m: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(x - m) modulo a prime below 2**31, highest power first, by reduction to Hessenberg form."""
    h, d = m.copy(), len(m)
    for k in range(d - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        at = k + 1 + int(below[0])
        if at != k + 1:
            h[[at, k + 1]] = h[[k + 1, at]]
            h[:, [at, k + 1]] = h[:, [k + 1, at]]
        u = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - u[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * u % p).sum(axis=1)) % p
    poly = np.zeros((d + 1, d + 1), np.int64)  # row k: polynomial of the leading k x k block, lowest power first
    poly[0, 0] = 1
    for k in range(d):
        poly[k + 1, 1:] = poly[k, :-1]
        factor = np.ones(k + 1, np.int64)  # products of the subdiagonal from i + 1 to k
        for i in range(k - 1, -1, -1):
            factor[i] = factor[i + 1] * h[i + 1, i] % p
        weight = h[: k + 1, k] * factor % p
        poly[k + 1] = (poly[k + 1] - (weight[:, None] * poly[: k + 1] % p).sum(axis=0)) % p
    return poly[d, ::-1]


def characteristic_polynomial(spark, m: list[list[int]]) -> list[int]:
    """Coefficients of det(x - M), highest power first, of a symmetric M without negative eigenvalues.

    Coefficient k is, but for its sign, a sum of products of k eigenvalues, so it is between 0 and
    comb(d, k) * (trace / d) ** k; the primes' product is above the largest of these bounds.
    """
    d, trace = len(m), sum(m[i][i] for i in range(len(m)))
    primes = primes_above(max(comb(d, k) * trace**k // d**k + 1 for k in range(d + 1)))
    told = spark.sparkContext.broadcast(m)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column(0).to_pylist():
                left = np.array([[v % p for v in row] for row in told.value], np.int64)
                yield pa.record_batch([pa.array([p]), pa.array([polynomial_mod(left, p).tolist()], pa.list_(pa.int64()))], names=["p", "c"])

    jobs = spark.createDataFrame([(p,) for p in primes], "p long").repartition(min(len(primes), spark.sparkContext.defaultParallelism))
    residues = {r["p"]: r["c"] for r in jobs.mapInArrow(run, "p long, c array<long>").collect()}
    whole = prod(primes)
    part = {p: whole // p * pow(whole // p, -1, p) for p in primes}
    plus = [sum((residues[p][k] if k % 2 == 0 else -residues[p][k]) % p * part[p] for p in primes) % whole for k in range(d + 1)]
    return [v if k % 2 == 0 else -v for k, v in enumerate(plus)]


def roots_above(poly: list[int], point: int, bits: int) -> int:
    """How many roots (with multiplicity) are above point / 2**bits, if all roots are real: sign changes of the Taylor shift."""
    c = [v << bits * k for k, v in enumerate(poly)]
    for end in range(len(c), 1, -1):
        for k in range(1, end):
            c[k] += point * c[k - 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def value_sign(poly: list[int], point: int, bits: int) -> int:
    """Sign of the polynomial at point / 2**bits."""
    v = 0
    for k, c in enumerate(poly):
        v = v * point + (c << bits * k)
    return (v > 0) - (v < 0)


def isolate(poly: list[int], wanted: int, top: int) -> list[tuple[int, int, int, int, int]]:
    """Intervals (low, high, bits, above, count), largest roots first, until they hold `wanted` positive roots.

    The interval (low / 2**bits, high / 2**bits] holds `count` roots and `above` are beyond it.  count is 1, or
    the roots agree to ROOT_BITS bits: they are taken as equal.  top is at least the largest root.
    """
    positive = roots_above(poly, 0, 0)
    high = 1 << max(1, top.bit_length() + 1)
    out, todo, seen = [], [(0, high, 0, 0, positive)], 0
    while todo and seen < min(wanted, positive):
        low, high, bits, above, beyond_low = todo.pop()
        count = beyond_low - above
        if not count:
            continue
        if count == 1 and low or high - low <= 1 and low >> ROOT_BITS:
            out.append((low, high, bits, above, count))
            seen += count
            continue
        if high - low <= 1:
            low, high, bits = 2 * low, 2 * high, bits + 1
        middle = (low + high) >> 1
        beyond = roots_above(poly, middle, bits)
        todo += [(low, middle, bits, beyond, beyond_low), (middle, high, bits, above, beyond)]
    return out


def refine(poly: list[int], low: int, high: int, bits: int, above: int, count: int) -> Fraction:
    """The root of an isolated interval to ROOT_BITS bits.  At a point between two roots the sign tells the parity of the roots beyond."""
    if count > 1:
        return Fraction(low + high, 2 << bits)
    while low.bit_length() < ROOT_BITS or high - low > 1:
        if high - low <= 1:
            low, high, bits = 2 * low, 2 * high, bits + 1
        middle = (low + high) >> 1
        s = value_sign(poly, middle, bits)
        if not s:
            return Fraction(middle, 1 << bits)
        low, high = (low, middle) if s == (-1) ** above else (middle, high)
    return Fraction(low + high, 2 << bits)


def null_space(m: list[list[int]], root: Fraction, count: int) -> list[list[float]]:
    """Orthonormal vectors that M maps to root times themselves: inverse iteration from fixed random vectors, in long decimals."""
    with localcontext() as context:
        context.prec = DIGITS + len(str(max(abs(v) for row in m for v in row)))
        d, shift = len(m), Decimal(root.numerator) / Decimal(root.denominator)
        a = [[Decimal(v) - shift if i == j else Decimal(v) for j, v in enumerate(row)] for i, row in enumerate(m)]
        tiny = shift * Decimal(10) ** -DIGITS
        order = list(range(d))
        for k in range(d):
            best = max(range(k, d), key=lambda i: abs(a[i][k]))
            a[k], a[best] = a[best], a[k]
            order[k], order[best] = order[best], order[k]
            if abs(a[k][k]) < tiny:
                a[k][k] = tiny
            pivot = a[k]
            for row in a[k + 1 :]:
                if row[k]:
                    f = row[k] = row[k] / pivot[k]
                    row[k + 1 :] = [x - f * y for x, y in zip(row[k + 1 :], pivot[k + 1 :])]

        def solve(b: list[Decimal]) -> list[Decimal]:
            x = [b[i] for i in order]
            for i in range(d):
                x[i] -= sum((f * v for f, v in zip(a[i][:i], x)), Decimal(0))
            for i in range(d - 1, -1, -1):
                x[i] = (x[i] - sum((f * v for f, v in zip(a[i][i + 1 :], x[i + 1 :])), Decimal(0))) / a[i][i]
            return x

        rng = random.Random(13)
        basis = [[Decimal(rng.randrange(-1000, 1001)) for _ in range(d)] for _ in range(count)]
        for _ in range(ROUNDS):
            found: list[list[Decimal]] = []
            for v in map(solve, basis):
                for _ in range(2):
                    for w in found:
                        along = sum(x * y for x, y in zip(v, w))
                        v = [x - along * y for x, y in zip(v, w)]
                    length = sum(x * x for x in v).sqrt()
                    v = [x / length for x in v]
                found.append(v)
            basis = found
        return [[float(x) for x in v] for v in basis]


def components(spark, m: list[list[int]], n: int, most: int = 32) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vectors as columns, standard deviations, shares of the trace) of the `most` largest positive eigenvalues of M / n**2."""
    d, trace = len(m), sum(m[i][i] for i in range(len(m)))
    if not trace:
        return np.zeros((d, 0)), np.zeros(0), np.zeros(0)
    poly = characteristic_polynomial(spark, m)
    told = spark.sparkContext.broadcast((m, poly))
    jobs = [(k, *map(str, place[:2]), *place[2:]) for k, place in enumerate(isolate(poly, most, trace))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, poly = told.value
        for batch in batches:
            for r in batch.to_pylist():
                root = refine(poly, int(r["low"]), int(r["high"]), r["bits"], r["above"], r["count"])
                with localcontext() as context:
                    context.prec = DIGITS
                    exact = Decimal(root.numerator) / Decimal(root.denominator)
                    std, share = float(exact.sqrt() / n), float(exact / trace)
                for v in null_space(m, root, r["count"]):
                    yield pa.record_batch([pa.array([r["k"]], pa.int32()), pa.array([std]), pa.array([share]), pa.array([v], pa.list_(pa.float64()))], names=["k", "std", "share", "v"])

    table = spark.createDataFrame(jobs, "k int, low string, high string, bits int, above int, count int").repartition(min(len(jobs), 4 * spark.sparkContext.defaultParallelism), "k")
    got = sorted(table.mapInArrow(run, "k int, std double, share double, v array<double>").collect(), key=lambda r: (r["k"], r["v"]))[:most]
    return np.array([r["v"] for r in got]).T, np.array([r["std"] for r in got]), np.array([r["share"] for r in got])


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = 32) -> DataFrame:
    """Rows (id_col, component, n, deviation, whitened, explained, identity_error), one a fitted vector and component.

    Fitted are all vectors without a NULL, NaN or infinite entry whose length is the commonest one; others
    (empty ones and those beyond MOST too) give no row.  Ids of any type, NULL or repeated, stay as they are.
    Components of eigenvalue 0 are not returned, so no vectors, one vector or equal vectors give no rows.
    deviation is NULL where it does not fit a long.  Time grows with the rows and, apart from them, with the
    fourth power of the length: it is meant for lengths of tens to a few hundred.
    """
    spark, kind = df.sparkSession, df.schema[id_col].dataType.simpleString()
    out = f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = df.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(vector_col)).cast("array<double>").alias("x"))
    vectors = rows.select("x").filter("x is not null")
    d, n, sums = totals(vectors)
    m, centre = scatter(vectors, d, n, sums) if n else ([], [])
    axes, std, share = components(spark, m, n, most) if n else (np.zeros((0, 0)), np.zeros(0), np.zeros(0))
    count = len(std)
    if not count:
        return spark.createDataFrame([], out)
    rest = [s - n * c for s, c in zip(sums, centre)]
    base, off = np.array(centre, np.int64), np.array([float(Fraction(r, n)) for r in rest])
    to = axes / std

    def projected(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, x = matrix_of(column, d)
        y = x - base
        return at, y, (y - off) @ to

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        i, j = np.triu_indices(count)
        for batch in batches:
            _, _, w = projected(batch.column(0))
            if not len(w):
                continue
            mean = w.mean(axis=0)
            around = (w - mean).T @ (w - mean) + len(w) * np.outer(mean, mean)  # the mean of all is 0: no digits are lost
            yield pa.record_batch([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(around[i, j])], names=["i", "j", "v"])

    covariance = vectors.mapInArrow(gram, "i int, j int, v double").groupBy("i", "j").agg((F.sum("v") / n).alias("v"))
    error = covariance.agg(F.max(F.abs(F.col("v") - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0)))).first()[0]

    def deviations(y: np.ndarray) -> pa.Array:
        exact = np.array(rest, object)
        if (n * (int(np.abs(y).max()) + 1)) ** 2 * d < 1 << 62:
            return pa.array(((n * y - exact.astype(np.int64)) ** 2).sum(axis=1))
        wide = [int(((n * v.astype(object) - exact) ** 2).sum()) for v in y]
        return pa.array([v if v < 1 << 63 else None for v in wide], pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = OUT_ROWS // count + 1
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                own, y, w = projected(part.column(1))
                if not len(own):
                    continue
                each = np.repeat(np.arange(len(own)), count)
                yield pa.record_batch(
                    [part.column(0).take(pa.array(own[each])), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(y))), pa.array(np.full(len(each), n)), deviations(y).take(pa.array(each)), pa.array(w.ravel()),
                     pa.array(np.tile(share, len(y))), pa.array(np.full(len(each), error))],
                    names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.filter("x is not null").mapInArrow(run, out)
