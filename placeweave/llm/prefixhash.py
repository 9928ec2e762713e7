"""Document fingerprints from prefix polynomial hashes.

A text's code points are the coefficients of a polynomial; its values at a fixed base, modulo three primes, are kept for
all prefixes. The hash of any span is a difference of two of them, freed of its place, so span equality is one comparison
and the longest common extension of two places is found by binary search over lengths.

A fingerprint is a short string taken from these arrays: the length; the hash of the whole text under all three primes; a
ladder of hashes of prefixes and one of suffixes, at up to 31 even steps whose width is a power of two; and the least
hashes of all spans of twelve code points. Equal texts have equal fingerprints. The likeness of two fingerprints is the
larger of two shares: what their ladders show to be equal at both ends, found by binary search, and what their least span
hashes have in common. It is 1 for equal fingerprints and 0 when nothing is shared.

``with_next`` compares each text with the next one in ascending order of id and with its edited text. Texts are dealt out
by ranges of (id, hash of the text, place), each range in order with the first row of the next one behind it, so texts are
shuffled once and neither an id nor a text that many rows have meets in one task.

Results for edge cases: null texts are empty; ids may be null (they come last) and may repeat (their rows are ordered by a
hash of the text, then by place in the input, so the input must read the same twice: files or a stored table). After the
last row comes the first; a single row is its own next. An empty text equals another empty one (likeness 1) and nothing
else (0). Texts of any length are hashed whole. An empty table gives an empty result. Other columns are not read, whatever
their names.
"""

from __future__ import annotations

import bisect
import math

from pyspark.sql import DataFrame, SparkSession, functions as F

from placeweave.llm.store import Shared, release, small_batches, text_of

# The largest primes below 2 ** 31: two factors below them fit 64 bits. The bases are arbitrary numbers below them.
PRIMES = (2147483647, 2147483629, 2147483587)
BASES = (1103515245, 1812433253, 1566083941)

STEPS = 32
SPAN = 12
LEAST = 32
DIGITS = 8


class Prefixes:
    """Prefix arrays over code points; ``span`` gives the hash of any stretch, whatever its place."""

    #: Powers of each base and their inverses, made once a worker and grown as texts need.
    powers: list = []

    def __init__(self, text: str, primes: int = len(PRIMES)):
        import numpy as np

        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
        self.length = len(codes)
        self.sums, self.inverse = [], []
        for k in range(primes):
            power, inverse = _powers(k, self.length + 1)
            sums = np.zeros(self.length + 1, np.uint64)
            np.cumsum(codes * power[: self.length] % np.uint64(PRIMES[k]), out=sums[1:])
            sums %= np.uint64(PRIMES[k])
            self.sums.append(sums)
            self.inverse.append(inverse)

    def span(self, start, stop, k: int = 0):
        """The hash under prime ``k`` of code points ``start`` to ``stop`` (numbers or arrays of them)."""
        import numpy as np

        p = np.uint64(PRIMES[k])
        return (self.sums[k][stop] + p - self.sums[k][start]) % p * self.inverse[k][start] % p

    def name(self, start, stop):
        """The hash of a span under all primes."""
        return tuple(self.span(start, stop, k) for k in range(len(self.sums)))

    def equal(self, start: int, other: Prefixes, at: int, length: int) -> bool:
        """Whether ``length`` code points from ``start`` equal those of ``other`` from ``at``; beyond an end they do not."""
        if length < 0 or start < 0 or at < 0 or start + length > self.length or at + length > other.length:
            return False
        return self.name(start, start + length) == other.name(at, at + length)

    def extension(self, start: int, other: Prefixes, at: int) -> int:
        """The longest length of equal stretches from ``start`` and ``at``, by binary search."""
        if start < 0 or at < 0:
            return 0
        low, high = 0, max(0, min(self.length - start, other.length - at))
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if self.equal(start, other, at, middle) else (low, middle - 1)
        return low


def _powers(k: int, length: int):
    import numpy as np

    if not Prefixes.powers:
        Prefixes.powers = [(np.ones(1, np.uint64), np.ones(1, np.uint64)) for _ in PRIMES]
    have = Prefixes.powers[k]
    while len(have[0]) < length:
        n, p = len(have[0]), PRIMES[k]
        steps = (pow(BASES[k], n, p), pow(pow(BASES[k], -1, p), n, p))
        have = tuple(np.concatenate([v, v * np.uint64(s) % np.uint64(p)]) for v, s in zip(have, steps))
        Prefixes.powers[k] = have
    return have


def _mixed(x):
    """64-bit numbers whose order has nothing to do with the polynomials they come from."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hex(values) -> str:
    return values.astype(">u4").tobytes().hex()


def _least_spans(arrays: Prefixes):
    """The first halves of the ``LEAST`` least distinct hashes of all spans of ``SPAN`` code points."""
    import numpy as np

    if arrays.length < SPAN:
        return np.zeros(0, np.uint64)
    starts = slice(0, arrays.length - SPAN + 1)
    stops = slice(SPAN, arrays.length + 1)
    # A span's hash as in ``span``, for all starts at once.
    first, second = (
        (arrays.sums[k][stops] + np.uint64(p) - arrays.sums[k][starts]) % np.uint64(p) * arrays.inverse[k][starts] % np.uint64(p)
        for k, p in enumerate(PRIMES[:2])
    )
    every = _mixed(first << np.uint64(31) | second) >> np.uint64(32)
    if len(every) > 8 * LEAST:
        few = np.unique(np.partition(every, 4 * LEAST)[: 4 * LEAST])
        if len(few) >= LEAST:
            return few[:LEAST]
    return np.unique(every)[:LEAST]


def fingerprint(arrays: Prefixes) -> str:
    """``length:whole:prefixes:suffixes:spans``, numbers in hexadecimal; a colon ends each part but the last."""
    import numpy as np

    n = arrays.length
    step = ladder_step(n)
    ends = np.arange(1, n // step + 1) * step
    whole = "".join(f"{int(v):0{DIGITS}x}" for v in arrays.name(0, n))
    up, down = arrays.span(np.zeros_like(ends), ends), arrays.span(n - ends, np.full_like(ends, n))
    return f"{n:x}:{whole}:{_hex(up)}:{_hex(down)}:{_hex(_least_spans(arrays))}"


def ladder_step(n: int) -> int:
    """The smallest power of two that cuts ``n`` into fewer than ``STEPS`` steps."""
    step = 1
    while n // step >= STEPS:
        step *= 2
    return step


def likeness(a: str, b: str) -> float:
    """How much of the longer text the two fingerprints show to be shared, from 0 to 1."""
    if a == b:
        return 1.0
    (n, _, *ladders_a, spans_a), (m, _, *ladders_b, spans_b) = a.split(":"), b.split(":")
    n, m = int(n, 16), int(m, 16)
    if not n or not m:
        return 0.0
    step_a, step_b = ladder_step(n), ladder_step(m)
    step = max(step_a, step_b)
    ends = 0
    for x, y in zip(ladders_a, ladders_b):
        low, high = 0, min(n, m) // step
        while low < high:
            middle = (low + high + 1) // 2
            i, j = (middle * step // own * DIGITS for own in (step_a, step_b))
            low, high = (middle, high) if x[i - DIGITS : i] == y[j - DIGITS : j] else (low, middle - 1)
        ends += low * step
    ours, theirs = ({s[i : i + DIGITS] for i in range(0, len(s), DIGITS)} for s in (spans_a, spans_b))
    least = sorted(ours | theirs)[:LEAST]
    both = sum(v in ours and v in theirs for v in least) / max(1, len(least))
    return max(min(ends, n, m) / max(n, m), 2 * both / (1 + both))


# Queries about spans


def common_extensions(pairs: DataFrame, left: str, right: str, left_at: str, right_at: str, out: str = "extension") -> DataFrame:
    """``pairs`` with ``out``: how far the two texts agree from the two places (from 0); null places give null."""

    @F.pandas_udf("long")
    def longest(a, b, i, j):
        import pandas as pd

        release()
        got = [
            None if pd.isna(p) or pd.isna(q) else Prefixes(x or "").extension(int(p), Prefixes(y or ""), int(q)) for x, y, p, q in zip(a, b, i, j)
        ]
        return pd.Series(got, dtype="Int64")

    return pairs.withColumn(out, longest(text_of(left), text_of(right), F.col(left_at).cast("long"), F.col(right_at).cast("long")))


def equal_spans(pairs: DataFrame, left: str, right: str, left_at: str, right_at: str, length: str, out: str = "equal") -> DataFrame:
    """``pairs`` with ``out``: whether stretches of that length are equal; one that leaves its text equals none."""

    @F.pandas_udf("boolean")
    def same(a, b, i, j, n):
        import pandas as pd

        release()
        rows = zip(a, b, i, j, n)
        got = [None if any(map(pd.isna, v)) else Prefixes(x or "").equal(int(v[0]), Prefixes(y or ""), int(v[1]), int(v[2])) for x, y, *v in rows]
        return pd.Series(got, dtype="boolean")

    places = (F.col(c).cast("long") for c in (left_at, right_at, length))
    return pairs.withColumn(out, same(text_of(left), text_of(right), *places))


# A text and the next one

#: Text bytes of a range, and the most ranges; the bounds come from so many sampled rows a range.
RANGE_BYTES = 16 << 20
MOST_RANGES = 20_000
SAMPLED = 16


def _bounds(light: DataFrame) -> list[tuple]:
    """The first row of every range, as (null, id, h, place): real rows, the least of all first."""
    whole = light.agg(F.count("*"), F.sum("size"), F.min(F.struct("null", "id", "h", "place"))).first()
    if not whole[0]:
        return []
    ranges = max(1, min(MOST_RANGES, math.ceil((whole[1] or 0) / RANGE_BYTES), whole[0]))
    share = min(1.0, ranges * SAMPLED / whole[0])
    rows = light.sample(share, seed=11).collect() if ranges > 1 else []
    rows = sorted((r["null"], r["id"], r["h"], r["place"], r["size"]) for r in rows)
    bounds, total, passed = [tuple(whole[2])], sum(r[4] for r in rows), 0
    for *row, size in rows:
        if passed * ranges >= total * len(bounds) and tuple(row) > bounds[-1]:
            bounds.append(tuple(row))
        passed += size
    return bounds


def _ranges(spark: SparkSession, bounds: list[tuple]):
    """A function of (null, id, h, place): twice the row's range, plus one for a row that begins it."""
    shared = Shared(spark, bounds)

    @F.pandas_udf("long")
    def place(null, ids, h, places):
        import numpy as np
        import pandas as pd

        known = shared.value
        firsts = np.array([b[1] for b in known if not b[0]], np.int64)
        ids = ids.to_numpy(np.int64)
        out = np.searchsorted(firsts, ids, "right") - 1
        # Rows whose id begins a range, and rows without an id, are told apart by what follows the id.
        near = (np.searchsorted(firsts, ids, "left") != out + 1) | null.to_numpy(bool)
        out = out * 2
        for i in np.flatnonzero(near):
            row = (bool(null.iloc[i]), int(ids[i]), int(h.iloc[i]), int(places.iloc[i]))
            at = bisect.bisect_right(known, row) - 1
            out[i] = 2 * at + (known[at] == row)
        return pd.Series(out)

    return place


def _chained(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(range, ahead, id, text), in order within a partition; the row ``ahead`` is the one that comes after its range."""
    spark = docs.sparkSession
    key = F.col(doc_id).cast("long")
    rows = docs.select(key.alias("key"), text_of(text).alias("text"), F.monotonically_increasing_id().alias("place"))
    order = [F.isnull("key").alias("null"), F.coalesce("key", F.lit(0)).alias("id"), F.xxhash64("text").alias("h"), F.col("place")]
    bounds = _bounds(rows.select(*order, F.octet_length("text").alias("size")))
    n = max(1, len(bounds))
    rows = rows.select("key", "text", *order)
    rows = rows.withColumn("at", _ranges(spark, bounds)("null", "id", "h", "place") if n > 1 else F.lit(None).cast("long"))
    if n == 1:
        first = bounds[0] if bounds else (False, 0, 0, 0)
        same = [F.col(c) == F.lit(v) for c, v in zip(("null", "id", "h", "place"), first)]
        rows = rows.withColumn("at", F.when(same[0] & same[1] & same[2] & same[3], 1).otherwise(0).cast("long"))
    own, begins = F.shiftright("at", 1), F.col("at").bitwiseAND(F.lit(1)) == 1
    here = F.struct(own.alias("range"), F.lit(False).alias("ahead"))
    before = F.struct(((own + n - 1) % n).alias("range"), F.lit(True).alias("ahead"))
    rows = rows.withColumn("in", F.explode(F.when(begins, F.array(here, before)).otherwise(F.array(here))))
    rows = rows.select("in.range", "in.ahead", "null", "id", "h", "place", "key", "text")
    rows = rows.repartition(n, "range").sortWithinPartitions("range", "ahead", "null", "id", "h", "place")
    return rows.select("range", "ahead", F.col("key").alias("id"), "text")


def edited(text: str, other: str) -> str:
    """``text`` with its last quarter (rounded down) replaced by as many first code points of ``other``, or all it has."""
    cut = len(text) // 4
    return text[: len(text) - cut] + other[:cut]


NEXT = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, common_next long"


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for every text: its fingerprint, that of its edited text, and how alike they and the next text's are.

    ``common_next`` is the number of code points that it and the next text share from their start.
    """
    small_batches(docs.sparkSession, 200)

    def compare(batches):
        import hashlib

        import pyarrow as pa

        release()
        names = [field.split()[0] for field in NEXT.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
        held = None
        for batch in batches:
            out = []
            for at, ahead, key, words in zip(*(batch.column(c).to_pylist() for c in ("range", "ahead", "id", "text"))):
                arrays = Prefixes(words)
                name = fingerprint(arrays)
                if held is not None and held[0] == at:
                    _, own_key, own, own_arrays, own_name = held
                    other = edited(own, words)
                    other_name = own_name if other == own else fingerprint(Prefixes(other))
                    digest = hashlib.sha256(other.encode("utf-8", "replace")).hexdigest()
                    near = likeness(own_name, other_name), likeness(own_name, name)
                    out.append((own_key, len(own), digest, own_name, other_name, *near, own_arrays.extension(0, arrays, 0)))
                held = None if ahead else (at, key, words, arrays, name)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return _chained(docs, doc_id, text).mapInArrow(compare, NEXT).withColumnRenamed("id", doc_id)
