"""Whitening of vectors through the exact characteristic polynomial of their integer scatter matrix.

Entries become whole numbers, so the scatter matrix ``n * sum(x x') - S S'``, n^2 times the covariance, is a matrix of whole numbers.
Tasks sum exact products; modulo many primes, one task each, it is brought to Hessenberg form and its characteristic polynomial read
off by recurrence; Chinese remaindering gives the coefficients as whole numbers. All roots of that polynomial are real, so by Descartes'
rule the sign changes of the polynomial shifted to a point count the roots above it, multiple ones as often as they occur: this isolates
the greatest roots to ``DIGITS`` binary digits. Inverse iteration in the null space of (matrix - root), in long decimals, gives the
components. Only tables of the size of the matrix reach the driver; rows are read twice, to sum and to project.
"""

from __future__ import annotations

import decimal
import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicatrix.llm.store import stored

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
LIMB = 32  # bits of a part of an exact sum
DIGITS = 320  # binary digits of a root
LONGEST = 2**63 - 1


# -- rows ---------------------------------------------------------------------


def whole_vectors(vectors: DataFrame, width: int | None = None) -> DataFrame:
    """vec_id and x, the entries as whole numbers; vectors that are null or hold null or non-finite entries are left out.

    Entries beyond the range of a long are held to it. With ``width``, shorter vectors are filled up with entries of zero.
    """
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("c"))
    rows = rows.where(F.col("c").isNotNull() & F.coalesce(F.forall("c", finite), F.lit(False)))
    room = F.lit(float(2**62))
    whole = lambda c: F.floor(F.greatest(-room, F.least(room, c * SCALE))).cast("long") + SHIFT
    x = F.transform("c", whole)
    if width is not None:
        x = F.concat(x, F.array_repeat(F.lit(SHIFT).cast("long"), F.lit(width) - F.size("c")))
    return rows.select("vec_id", x.alias("x"))


def table_of(column, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def product_sums(table: np.ndarray) -> list[list[int]]:
    """Exact sums of products of the columns of a table of longs, with a first column of ones before them."""
    table = np.concatenate([np.ones((len(table), 1), np.int64), table], axis=1)
    most = max(int(table.max()), -int(table.min()))
    if most * most * len(table) < 2**53:  # every partial sum is a whole number that a double holds
        return table.astype(np.float64).T.dot(table.astype(np.float64)).astype(np.int64).tolist()
    if most * most * len(table) < LONGEST:
        return table.T.dot(table).tolist()
    # Parts of 16 bits, the highest with the sign: their products are small again.
    parts = [(table >> (16 * k)) & 0xFFFF if k < 3 else table >> 48 for k in range(4)]
    total = np.zeros((table.shape[1],) * 2, object)
    for i, a in enumerate(parts):
        for j, b in enumerate(parts):
            total += a.T.dot(b).astype(object) * (1 << (16 * (i + j)))
    return total.tolist()


def scatter(rows: DataFrame, width: int) -> tuple[int, list[int], list[list[int]]]:
    """Number of rows, sums of x, and n * sum(x x') - S S', exact.

    Each task sends one row per pair of columns and part of the sum; they are added by pair and part.
    """

    def run(batches):
        sums: list[list[int]] | None = None
        for batch in batches:
            for at in range(0, batch.num_rows, 1 << 14):
                part = batch.slice(at, 1 << 14)
                # Without the common shift, which is added back below, numbers are small.
                new = product_sums(table_of(part.column(0), width) - SHIFT)
                sums = new if sums is None else [[a + b for a, b in zip(*lines)] for lines in zip(sums, new)]
        found: list[list[int]] = [[], [], [], []]
        for i, line in enumerate(sums or []):
            for j, value in enumerate(line[: i + 1]):
                sign, rest, k = (1 if value >= 0 else -1), abs(value), 0
                while rest or k == 0:
                    for column, x in zip(found, (i, j, k, sign * (rest & (2**LIMB - 1)))):
                        column.append(x)
                    rest, k = rest >> LIMB, k + 1
        yield pa.record_batch([pa.array(c, t) for c, t in zip(found, (pa.int32(), pa.int32(), pa.int32(), pa.int64()))], ["i", "j", "part", "value"])

    parts = rows.select("x").mapInArrow(run, "i int, j int, part int, value long").groupBy("i", "j", "part").agg(F.sum("value").alias("value"))
    sums = [[0] * (width + 1) for _ in range(width + 1)]
    for row in parts.collect():  # bounded by the square of the width
        sums[row["i"]][row["j"]] += row["value"] << (LIMB * row["part"])
    n, small = sums[0][0], [sums[i + 1][0] for i in range(width)]
    matrix = [[n * sums[max(i, j) + 1][min(i, j) + 1] - small[i] * small[j] for j in range(width)] for i in range(width)]
    return n, [s + SHIFT * n for s in small], matrix


# -- characteristic polynomial ------------------------------------------------


def primes_below(top: int, bits: int) -> list[int]:
    """Primes downwards from ``top``, an odd number below 2^31, until their product has more than ``bits`` bits."""
    found, candidate, product = [], top, 1
    while product.bit_length() <= bits:
        d, r = candidate - 1, 0
        while d % 2 == 0:
            d, r = d // 2, r + 1
        # These bases decide every number below 3.2 * 10^9.
        if all(_passes(base, d, r, candidate) for base in (2, 3, 5, 7)):
            found.append(candidate)
            product *= candidate
        candidate -= 2
    return found


def _passes(base: int, d: int, r: int, n: int) -> bool:
    x = pow(base, d, n)
    return x in (1, n - 1) or any((x := x * x % n) == n - 1 for _ in range(r - 1))


def polynomial_modulo(matrix: list[list[int]], p: int) -> list[int]:
    """Coefficients of det(y - matrix) modulo a prime below 2^31, from the constant one upwards."""
    d = len(matrix)
    h = np.array([[v % p for v in line] for line in matrix], np.int64)
    for k in range(1, d - 1):
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        pivot = k + int(below[0])
        if pivot != k:
            h[[k, pivot]] = h[[pivot, k]]
            h[:, [k, pivot]] = h[:, [pivot, k]]
        factor = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1 :] = (h[k + 1 :] - factor[:, None] * h[k] % p) % p
        for column in range(k + 1, d):
            h[:, k] = (h[:, k] + factor[column - k - 1] * h[:, column] % p) % p
    # Polynomials of the leading blocks, from those before.
    polys = [np.ones(1, np.int64)]
    for m in range(1, d + 1):
        new = np.zeros(m + 1, np.int64)
        new[1:] = polys[m - 1]
        new[:m] = (new[:m] - h[m - 1, m - 1] * polys[m - 1] % p) % p
        product = 1
        for i in range(m - 1, 0, -1):
            product = product * int(h[i, i - 1]) % p
            if not product:
                break
            new[:i] = (new[:i] - (product * int(h[i - 1, m - 1]) % p) * polys[i - 1] % p) % p
        polys.append(new)
    return polys[d].tolist()


def characteristic(spark, matrix: list[list[int]]) -> list[int]:
    """Coefficients of det(y - matrix), exact, from the constant one upwards.

    Coefficient d - k is a sum of k-rowed minors along the diagonal, for a matrix without negative eigenvalues at most
    (trace)^k / k!, so the primes' product passes twice the greatest of these.
    """
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    bits = max((trace**k // math.factorial(k)).bit_length() for k in range(d + 1)) + 2
    primes = primes_below(2**31 - 1, bits)

    def reduce(batches):
        for batch in batches:
            for p in batch.column(0).to_pylist():
                found = polynomial_modulo(matrix, p)
                yield pa.record_batch([pa.array(range(d + 1), pa.int32()), pa.array([p] * (d + 1)), pa.array(found)], ["k", "p", "residue"])

    def combine(batches):
        for batch in batches:
            values = []
            for pairs in batch.column(1).to_pylist():
                value, product = 0, 1
                for pair in pairs:
                    p = pair["p"]
                    value += product * ((pair["residue"] - value) * pow(product, -1, p) % p)
                    product *= p
                values.append(str(value if value <= product // 2 else value - product))
            yield pa.record_batch([batch.column(0), pa.array(values, pa.string())], ["k", "value"])

    tasks = spark.range(len(primes), numPartitions=min(len(primes), 64)).select(F.get(F.lit(primes), F.col("id").cast("int")).cast("long").alias("p"))
    residues = tasks.mapInArrow(reduce, "k int, p long, residue long")
    lists = residues.groupBy("k").agg(F.collect_list(F.struct("p", "residue")).alias("pairs"))
    found = {row["k"]: int(row["value"]) for row in lists.mapInArrow(combine, "k int, value string").collect()}
    return [found[k] for k in range(d + 1)]


# -- roots and components -----------------------------------------------------


def roots_above(coefficients: list[int], at: int, scale: int) -> int:
    """How many roots lie above at / 2^scale, for a polynomial whose roots are all real."""
    d = len(coefficients) - 1
    # Roots times 2^scale, then the shift by synthetic division.
    c = [v << (scale * (d - k)) for k, v in enumerate(coefficients)]
    for i in range(d):
        for k in range(d - 1, i - 1, -1):
            c[k] += at * c[k + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def value_sign(coefficients: list[int], at: int, scale: int) -> int:
    d, total = len(coefficients) - 1, 0
    for k in range(d, -1, -1):
        total = total * at + (coefficients[k] << (scale * (d - k)))
    return (total > 0) - (total < 0)


def isolated_root(coefficients: list[int], rank: int, bound: int, digits: int = DIGITS) -> tuple[int, int]:
    """(low, scale): the rank-th greatest root lies in (low, low + 1] / 2^scale. It is positive and at most ``bound``.

    Halving by counts until the root is alone; from there on the sign of the polynomial is enough.
    """
    scale, low, high = 0, 0, bound
    below, above = None, None  # roots above low, above high
    while high.bit_length() < digits or high - low > 1:
        if high - low <= 1:
            scale, low, high = scale + 1, 2 * low, 2 * high
            if high.bit_length() > 2 * digits:
                break
        middle = (low + high) // 2
        if below is not None and above is not None and below - above == 1:
            # One simple root: the sign at high is (-1)^above, and at a place below the root the other.
            sign = value_sign(coefficients, middle, scale)
            if sign == 0 or sign == (-1) ** above:
                high = middle
            else:
                low = middle
            continue
        n = roots_above(coefficients, middle, scale)
        if n >= rank:
            low, below = middle, n
        else:
            high, above = middle, n
    return low, scale


def null_vectors(matrix: list[list[int]], root: tuple[int, int], count: int) -> list[list[float]]:
    """Unit vectors, orthogonal to each other, in the space that (matrix - root) maps to about nothing: by inverse iteration.

    Long decimals keep apart eigenvalues that agree in far more digits than a double has. The first entry of greatest size is positive.
    """
    d = len(matrix)
    with decimal.localcontext() as context:
        context.prec = DIGITS * 302 // 1000 + 20
        context.Emax, context.Emin = decimal.MAX_EMAX, decimal.MIN_EMIN
        value = (decimal.Decimal(2 * root[0] + 1)) / (decimal.Decimal(2) ** (root[1] + 1))
        a = [[decimal.Decimal(v) for v in line] for line in matrix]
        for i in range(d):
            a[i][i] -= value
        order, tiny = list(range(d)), value.scaleb(-context.prec)
        for k in range(d):  # elimination with row exchanges
            pivot = max(range(k, d), key=lambda i: abs(a[i][k]))
            a[k], a[pivot], order[k], order[pivot] = a[pivot], a[k], order[pivot], order[k]
            if abs(a[k][k]) < tiny:
                a[k][k] = tiny
            line, head = a[k], a[k][k]
            for i in range(k + 1, d):
                if a[i][k]:
                    factor = a[i][k] / head
                    a[i] = [*a[i][:k], factor, *(x - factor * y for x, y in zip(a[i][k + 1 :], line[k + 1 :]))]
        found: list[list[decimal.Decimal]] = []
        rng = np.random.default_rng(7)
        for _ in range(count):
            v = [decimal.Decimal(int(x)) for x in rng.integers(1, 1 << 30, d)]
            for _ in range(3):
                y = [v[i] for i in order]
                for i in range(d):
                    y[i] -= sum((a[i][k] * y[k] for k in range(i)), decimal.Decimal(0))
                for i in range(d - 1, -1, -1):
                    y[i] = (y[i] - sum((a[i][k] * y[k] for k in range(i + 1, d)), decimal.Decimal(0))) / a[i][i]
                for other in found:
                    part = sum((x * z for x, z in zip(other, y)), decimal.Decimal(0))
                    y = [z - part * x for x, z in zip(other, y)]
                size = sum((z * z for z in y), decimal.Decimal(0)).sqrt()
                v = [z / size for z in y]
            found.append(v)
        out = []
        for v in found:
            lead = max(range(d), key=lambda i: (round(abs(v[i]), 12), -i))
            out.append([float(x if v[lead] > 0 else -x) for x in v])
        return out


def components(spark, matrix: list[list[int]], count: int = COMPONENTS) -> list[tuple[float, list[float]]]:
    """(eigenvalue as a share of the trace, unit vector) of the greatest positive eigenvalues of a symmetric matrix of whole numbers.

    Fewer than ``count`` if the matrix has fewer positive ones.
    """
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    if trace == 0:
        return []
    # A common factor makes numbers longer and changes no vector.
    common = math.gcd(*(v for line in matrix for v in line))
    matrix, trace = [[v // common for v in line] for line in matrix], trace // common
    coefficients = characteristic(spark, matrix)
    positive = d - next(k for k, v in enumerate(coefficients) if v)
    ranks = min(count, positive)

    def isolate(batches):
        for batch in batches:
            for rank in batch.column(0).to_pylist():
                low, scale = isolated_root(coefficients, rank + 1, trace)
                yield pa.record_batch([pa.array([rank]), pa.array([str(low)]), pa.array([scale])], ["rank", "low", "scale"])

    # One task per root, then one per group of roots that no digit tells apart.
    roots = spark.range(ranks, numPartitions=ranks).mapInArrow(isolate, "rank long, low string, scale long")
    groups = roots.groupBy("low", "scale").agg(F.min("rank").alias("rank"), F.count("*").alias("count"))

    def iterate(batches):
        for batch in batches:
            for row in batch.to_pylist():
                low, scale = int(row["low"]), row["scale"]
                share = float(decimal.Decimal(2 * low + 1) / (decimal.Decimal(2) ** (scale + 1)) / trace)
                for k, v in enumerate(null_vectors(matrix, (low, scale), row["count"])):
                    yield pa.record_batch([pa.array([row["rank"] + k]), pa.array([share]), pa.array([v], pa.list_(pa.float64()))], ["rank", "share", "vector"])

    found = groups.repartition(ranks, "rank").mapInArrow(iterate, "rank long, share double, vector array<double>")
    return [(row["share"], row["vector"]) for row in sorted(found.collect(), key=lambda r: r["rank"])]


# -- projection ---------------------------------------------------------------


def projected(rows: DataFrame, n: int, sums: list[int], scales: list[float], axes: list[list[float]]) -> DataFrame:
    """vec_id, deviation (null beyond the range of a long) and the projections of each row, an array."""
    width = len(sums)

    def run(batches):
        base = np.array([s // n for s in sums], np.int64)
        rest = np.array([s % n for s in sums], np.int64)
        turned = np.array(axes).reshape(len(axes), width).T / np.array(scales)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                # n x - S = n (x - S // n) - S mod n
                away = table_of(part.column(1), width) - base
                most = (max(int(away.max(initial=0)), -int(away.min(initial=0))) + 1) * n
                exact = away * n - rest if most * most * max(width, 1) < LONGEST else away.astype(object) * n - rest.astype(object)
                squares = (exact * exact).sum(axis=1)
                deviation = pa.array([int(x) if x <= LONGEST else None for x in squares], pa.int64())
                values = (away - rest / n).dot(turned)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * len(axes), pa.int32()), pa.array(values.ravel()))
                yield pa.record_batch([part.column(0), deviation, lists], ["vec_id", "deviation", "whitened"])

    return rows.mapInArrow(run, "vec_id long, deviation long, whitened array<double>")


def distance_to_identity(whitened: Column, count: int) -> Column:
    """Greatest absolute entry of the covariance of ``count`` projections minus the identity."""
    entries = [
        F.abs(F.covar_pop(whitened[i], whitened[j]) - F.lit(1.0 if i == j else 0.0)) for i in range(count) for j in range(i + 1)
    ]
    return functools.reduce(F.greatest, entries) if len(entries) > 1 else entries[0]


def whiten(vectors: DataFrame, count: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every usable row and component.

    Rows with repeated or null ids count and come out one by one; other columns are ignored. Vectors shorter than the longest are
    filled up with zeros. Components with eigenvalue 0 are left out, so equal vectors, one vector or an empty table give no rows.
    A deviation beyond the range of a long is null.
    """
    spark = vectors.sparkSession
    width = whole_vectors(vectors).agg(F.max(F.size("x"))).first()[0] or 0
    kind = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    n, sums, matrix = scatter(whole_vectors(vectors, width), width) if width else (0, [], [])
    found = components(spark, matrix, count) if n else []
    if not found:
        return spark.createDataFrame([], kind)
    trace = sum(matrix[i][i] for i in range(width))
    # An eigenvalue of the covariance is one of the scatter matrix over n^2.
    scales = [math.sqrt(share * (trace / n**2)) for share, _ in found]
    rows = stored(projected(whole_vectors(vectors, width), n, sums, scales, [v for _, v in found]), "whitened")
    error = rows.agg(distance_to_identity(F.col("whitened"), len(found))).first()[0]
    shares = F.array(*[F.lit(share) for share, _ in found])
    out = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return out.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(float(error)).alias("identity_error"),
    )
