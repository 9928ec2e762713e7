"""N-gram Jaccard join by grouped prefixes: exact components of documents whose shingle sets are alike.

Shingles are 64-bit hashes of three words (or as many as the settings say), ordered by how many documents hold them (a sketch of counts over all
documents), rarest first. Sets that reach the threshold must share a shingle among the first of either, the prefix.
Equal sets are one document; documents of equal prefix and size are one group, and only groups meet by prefix shingle.
Group pairs that pass bounds true of all their members are expanded to members, whose whole sets are compared. Of shingles
that the same groups hold one is kept, for they pair the same groups.

Only links between different components matter, so every list of groups is first held against one of its own (its hub);
what then still is in different components is compared pair by pair: in each list, the groups outside its most frequent
component with all others. Nothing is skipped and no list is capped.

What is written on the way is removed as soon as nothing reads it any more.

Ids are longs; a row without an id belongs to no pair and has no component. Rows that repeat an id are judged each by its
own text. Null, empty and wordless texts have empty sets, link with nothing and are their own component. Texts of any length
are read whole. An empty table gives an empty result, and columns beside the two named are not read, whatever their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from placeweave.llm.graph import components
from placeweave.llm.store import Shared, discard, freed, small_batches, store, text_of
from placeweave.operators.sizing import BroadcastLimit

BLOCK = 1 << 20
COLUMNS = 32


@dataclass(frozen=True)
class Settings:
    #: Two sets link when 100 * intersection >= percent * union.
    percent: int = 90
    words: int = 3
    sketch_bits: int = 18
    #: Least bits of a set's signature, which has two for each shingle, up to the next power of two; they set how many unlike
    #: pairs are turned away before sets are read, never which link.
    signature_bits: int = 256
    #: Turns of comparing lists with hubs before all pairs that are left; they set speed only.
    turns: int = 4


#: Bytes of a word that are hashed by table; longer words are digested one by one.
SHORT = 64

_MADE: dict = {}


def _tables():
    """Lower-casing, white space, and a random number for each byte at each of the first places of a word; made once a task."""
    import numpy as np

    if not _MADE:
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        space = np.zeros(256, bool)
        space[[0x20, *range(0x09, 0x0E)]] = True
        random = np.random.default_rng(20240229).integers(0, 2**64, (SHORT, 256), np.uint64)
        random[:, space] = 0
        _MADE["tables"] = lower, space, random.ravel()
    return _MADE["tables"]


def _mix(x):
    import numpy as np

    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _block_words(data):
    """Hashes of the words of a byte array, and where they start.

    A word's hash adds up independent random numbers for its bytes by place, so no family of words collides by rule.
    """
    import numpy as np

    from hashlib import blake2b

    lower, space, random = _tables()
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~space[data]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    small = lower[data]
    first = starts[0]
    place = np.arange(len(data) - first, dtype=np.int32)
    place -= np.repeat((starts - first).astype(np.int32), np.diff(starts, append=len(data)))
    np.minimum(place, SHORT - 1, out=place)
    place <<= 8
    place += small[first:]
    sizes = ends - starts
    sums = np.add.reduceat(random.take(place), starts - first) + sizes.astype(np.uint64)
    for i in np.flatnonzero(sizes > SHORT).tolist():
        sums[i] = int.from_bytes(blake2b(small[starts[i] : ends[i]], digest_size=8).digest(), "little")
    return _mix(sums), starts


def _pieces(data: bytes):
    """A long text in blocks that end at white space; a longer word stays whole."""
    import numpy as np

    space, at, array = _tables()[1], 0, np.frombuffer(data, np.uint8)
    while at < len(array):
        end = min(at + BLOCK, len(array))
        if end < len(array):
            blank = np.flatnonzero(space[array[at:end]])
            if len(blank):
                end = at + int(blank[-1]) + 1
            else:
                while end < len(array) and not space[array[end]]:
                    end += 1
        yield array[at:end]
        at = end


def word_hashes(texts: list[str]):
    """The word hashes of each text, in order; texts go through together, a block at a time."""
    import numpy as np

    block: list[bytes] = []
    size = 0

    def flush():
        data = np.frombuffer(b"\n".join(block), np.uint8)
        words, starts = _block_words(data)
        bounds = np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in block)]))
        return [words[a:b] for a, b in zip(bounds, bounds[1:])]

    for text in texts:
        data = text.encode("utf-8", "replace")
        if size + len(data) + 1 > BLOCK and block:
            yield from flush()
            block, size = [], 0
        if len(data) >= BLOCK:
            yield np.concatenate([_block_words(piece)[0] for piece in _pieces(data)])
            continue
        block.append(data)
        size += len(data) + 1
    if block:
        yield from flush()


def shingle_sets(texts: list[str], n: int):
    """The distinct shingle hashes of each text, sorted. Fewer words than ``n`` are one shingle."""
    import numpy as np

    for words in word_hashes(texts):
        if not len(words):
            yield words
            continue
        width = min(n, len(words))
        rows = np.full(len(words) - width + 1, np.uint64(width), np.uint64)
        for k in range(width):
            rows = _mix(rows * np.uint64(0xD6E8FEB86659FD93) + words[k : len(words) - width + 1 + k])
        yield np.unique(rows)


def _texts(batch, name: str = "text", step: int = 256):
    column = batch.column(name)
    for at in range(0, len(column), step):
        yield at, [t or "" for t in column[at : at + step].to_pylist()]


def shingle_counts(docs: DataFrame, settings: Settings, text: str = "text"):
    """How many documents hold a shingle, by the first bits of its hash: bounded counts over all documents."""
    import numpy as np

    bits, n = settings.sketch_bits, settings.words
    small_batches(docs.sparkSession)

    def count(batches):
        import pyarrow as pa

        total = np.zeros(1 << bits, np.int64)
        for batch in batches:
            for _, texts in _texts(batch):
                every = np.concatenate([*shingle_sets(texts, n), np.zeros(0, np.uint64)])
                total += np.bincount((every >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
        rows = total.reshape(-1, COLUMNS)
        used = np.flatnonzero(rows.any(axis=1))
        names = ["row", *(f"c{i}" for i in range(COLUMNS))]
        yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(rows[used, i]) for i in range(COLUMNS))], names=names)

    schema = ", ".join(["row long", *(f"c{i} long" for i in range(COLUMNS))])
    parts = docs.select(text_of(text).alias("text")).mapInArrow(freed(count), schema)
    got = parts.groupBy("row").agg(*(F.sum(f"c{i}").alias(f"c{i}") for i in range(COLUMNS))).toArrow()
    total = np.zeros((1 << bits) // COLUMNS * COLUMNS, np.int64).reshape(-1, COLUMNS)
    total[got.column("row").to_numpy()] = np.stack([got.column(f"c{i}").to_numpy() for i in range(COLUMNS)], axis=1)
    return total.ravel()


def prefixes(docs: DataFrame, counts, settings: Settings, doc_id: str, text: str) -> DataFrame:
    """(id, v, n, prefix, sig): a text's set as a hash, its size, its rarest shingles, which a like set must share, and a signature.

    A signature's bits are parities: sets differ in at least as many shingles as their signatures differ in bits.
    """
    shared, bits, n, percent = Shared(docs.sparkSession, counts), settings.sketch_bits, settings.words, settings.percent
    least = max(settings.signature_bits, 64 * FOLDS)

    def rows(batches):
        import numpy as np
        import pyarrow as pa

        counts = shared.value
        for batch in batches:
            for at, texts in _texts(batch):
                sizes, names, firsts, marks = [], [], [], []
                for every in shingle_sets(texts, n):
                    size = len(every)
                    order = np.lexsort((every, counts[(every >> np.uint64(64 - bits)).astype(np.int64)]))
                    keep = size - (percent * size + 99) // 100 + 1 if size else 0
                    sizes.append(size)
                    names.append(set_name(every))
                    firsts.append(every[order[:keep]].view(np.int64))
                    width = 1 << (max(least, 2 * size) - 1).bit_length()
                    parity = np.bincount((every % np.uint64(width)).astype(np.int64), minlength=width) & 1
                    marks.append(np.packbits(parity.astype(np.uint8)).view(np.int64))
                ends = np.cumsum([0, *map(len, firsts)])
                flat = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(firsts)))
                ends = np.cumsum([0, *map(len, marks)])
                sig = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(marks)))
                ids = batch.column("id").slice(at, len(texts))
                arrays = [ids, pa.array(names, pa.int64()), pa.array(sizes, pa.int64()), flat, sig]
                yield pa.RecordBatch.from_arrays(arrays, names=["id", "v", "n", "prefix", "sig"])

    rows_in = docs.select(F.col(doc_id).cast("long").alias("id"), text_of(text).alias("text"))
    return rows_in.mapInArrow(freed(rows), "id long, v long, n long, prefix array<long>, sig array<long>")


def set_name(every) -> int:
    """A 64-bit name for a set of shingles."""
    from hashlib import blake2b

    return int.from_bytes(blake2b(every.tobytes(), digest_size=8).digest(), "little", signed=True)


@dataclass
class Sets:
    """Shingle sets on demand: texts are read again only for the documents that some pair names."""

    docs: DataFrame
    reps: DataFrame
    repeated: bool
    settings: Settings
    limit: BroadcastLimit

    def of(self, names: DataFrame) -> DataFrame:
        n = self.settings.words

        def sets(batches):
            import numpy as np
            import pyarrow as pa

            # Few texts at a time: a batch's sets together would be many times a task's share of memory.
            for batch in batches:
                for _, texts in _texts(batch, step=128):
                    rows = list(shingle_sets(texts, n))
                    ends = np.cumsum([0, *map(len, rows)])
                    flat = pa.array(np.concatenate(rows).view(np.int64))
                    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
                    yield pa.RecordBatch.from_arrays([pa.array(map(set_name, rows), pa.int64()), lists], names=["v", "set"])

        wanted = store(self.reps.select("v", "id").join(names.distinct(), "v"), "wanted")
        rows = wanted.count()
        chosen = self.docs.join(self.limit.hint(wanted.select("id").distinct(), rows, rows * 16), "id", "left_semi")
        made = chosen.select("text").mapInArrow(freed(sets), "v long, set array<long>")
        if self.repeated:
            made = made.join(wanted, "v", "left_semi").groupBy("v").agg(F.first("set").alias("set"))
        made = store(made, "sets")
        discard(wanted)
        return made

    def _plausible(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose signatures leave room for the threshold."""
        left, right = (
            self.reps.select(F.col("v").alias(v), F.col("n").alias(f"n_{v}"), F.col("sig").alias(f"sig_{v}")) for v in ("a", "b")
        )
        near = _near(_differ("sig_a", "sig_b"), F.col("n_a"), F.col("n_b"), self.settings)
        return pairs.join(left, "a").join(right, "b").filter(near).select("a", "b")

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose whole sets reach the threshold."""
        met = store(pairs.select("a", "b").distinct(), "met")
        pairs = store(self._plausible(met), "pairs")
        discard(met)
        if pairs.isEmpty():
            return pairs
        sets = self.of(pairs.select(F.explode(F.array("a", "b")).alias("v")))
        left = sets.select(F.col("v").alias("a"), F.col("set").alias("x"))
        right = sets.select(F.col("v").alias("b"), F.col("set").alias("y"))
        both = pairs.join(left, "a").join(right, "b")
        common = F.size(F.array_intersect("x", "y"))
        alike = 100 * common >= self.settings.percent * (F.size("x") + F.size("y") - common)
        links = store(both.filter(alike).select("a", "b"), "linked")
        discard(pairs, sets)
        return links


def _bucket(size: str, shift: float, settings: Settings) -> Column:
    """Sizes by powers of the threshold: like sets are in one bucket or in two that meet."""
    return F.floor(F.log(size) / F.lit(-math.log(settings.percent / 100)) + F.lit(shift))


def _possible(na: Column, ia: Column, nb: Column, ib: Column, settings: Settings) -> Column:
    """Whether two sizes, and a shared shingle at places ``ia`` and ``ib``, leave room for the threshold."""
    p = settings.percent
    most = F.least(ia, ib) + 1 + F.least(na - ia - 1, nb - ib - 1)
    return (100 * F.least(na, nb) >= p * F.greatest(na, nb)) & ((100 + p) * most >= p * (na + nb))


def _labelled(rows: DataFrame, label: DataFrame, key: str) -> DataFrame:
    names = label.select(F.col("id").alias(key), "component")
    return rows.join(names, key, "left").withColumn("label", F.coalesce("component", key)).drop("component")


def _hub_pairs(entries: DataFrame, turn: int, settings: Settings) -> DataFrame:
    """Each group of a list and size bucket against one of them, the hub, where their components differ.

    Buckets shift by half from turn to turn, so that none parts alike sizes for good. The first two turns take the hub that
    comes first in any list; later ones draw another for each list, which spreads what the earlier ones left apart.
    """
    rows = entries.withColumn("bucket", _bucket("n", 0.5 * (turn % 2), settings))
    rows = rows.withColumn("draw", F.col("g") if turn < 2 else F.xxhash64("g", "shingle", F.lit(turn)))
    hubs = rows.groupBy("shingle", "bucket").agg(
        *(F.min_by(c, "draw").alias(name) for c, name in (("g", "hub"), ("n", "hub_n"), ("i", "hub_i"), ("label", "hub_label"))),
        F.min("label").alias("lo"),
        F.max("label").alias("hi"),
    )
    hubs = store(hubs.filter("lo <> hi").drop("lo", "hi"), "hubs")
    near = _possible(F.col("n"), F.col("i"), F.col("hub_n"), F.col("hub_i"), settings)
    both = rows.join(hubs, ["shingle", "bucket"]).filter((F.col("label") != F.col("hub_label")) & near)
    return both.select(F.col("g").alias("a"), F.col("hub").alias("b"))


FOLDS = 4

#: Lists of more groups hold whole signatures against each other, shorter ones folded ones; it sets speed only.
LONG = 32


def _folded() -> list[Column]:
    """A signature folded to ``FOLDS`` longs: still parities of shingles, so still a bound on how many differ."""
    zero = F.lit(0).cast("long")
    parts = [F.filter("sig", lambda _, k: k % FOLDS == i) for i in range(FOLDS)]
    return [F.aggregate(part, zero, lambda x, y: x.bitwiseXOR(y)).alias(f"s{i}") for i, part in enumerate(parts)]


def _differ(a: str, b: str) -> Column:
    """How many bits differ between two whole signatures, one with twice the bits folded to the other's; 0 where one has more still."""

    def fitted(x: str, y: str) -> Column:
        half = F.floor(F.size(x) / 2).cast("int")
        return F.when(F.size(x) > F.size(y), F.zip_with(F.slice(x, 1, half), F.slice(x, half + 1, half), lambda p, q: p.bitwiseXOR(q))).otherwise(F.col(x))

    bits = F.zip_with(fitted(a, b), fitted(b, a), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.coalesce(F.aggregate(bits, F.lit(0), lambda s, x: s + x), F.lit(0))


def _apart(a: list, b: list) -> Column:
    """How many bits differ between two folded signatures."""
    return reduce(lambda x, y: x + y, [F.bit_count(x.bitwiseXOR(y)) for x, y in zip(a, b, strict=True)])


def _near(apart: Column, na: Column, nb: Column, settings: Settings) -> Column:
    """Whether sets of two sizes that differ in ``apart`` shingles or more can reach the threshold."""
    return (100 + settings.percent) * apart <= (100 - settings.percent) * (na + nb)


def _cross_pairs(entries: DataFrame, members: DataFrame, reps: DataFrame, settings: Settings) -> DataFrame:
    """Member pairs of all group pairs that may be alike and are not yet of one component.

    Of such a pair one group at least is outside the list's most frequent component, its main one, so those meet all others.
    The bounds are part of the joins' conditions, signatures too: what cannot be alike is never a row. Members of a
    group share prefix and size only, so groups are told apart by the bits in which all members of either agree, and then
    members by their own bits; in long lists, groups of one member by all of them.
    """
    marks = [f"s{i}" for i in range(FOLDS)]
    members = store(members.join(reps.select("v", "n", "sig", *_folded()), "v"), "marked")
    agreed = [agg(m).alias(f"{m}_{name}") for m in marks for name, agg in (("all", F.bit_and), ("any", F.bit_or))]
    agreed.append(F.first(F.when(F.col("size") == 1, F.col("sig"))).alias("sig"))
    bits = [f"{m}_{name}" for m in marks for name in ("all", "any")]
    purity = store(members.groupBy("g").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), *agreed), "purity")
    rows = store(entries.drop("label").join(purity.select("g", "lo", "hi"), "g"), "rows")
    lists = rows.groupBy("shingle", "lo").agg(F.count("*").alias("c"), F.max("hi").alias("hi")).groupBy("shingle")
    lists = lists.agg(F.min("lo").alias("x"), F.max("hi").alias("y"), F.max_by("lo", "c").alias("most"), F.sum("c").alias("c"))
    live = store(lists.filter("x <> y").select("shingle", "most", (F.col("c") > LONG).alias("long")), "live")
    main = ((F.col("lo") == F.col("most")) & (F.col("hi") == F.col("most"))).alias("main")
    found = rows.join(live, "shingle").select("shingle", "g", "n", "i", "lo", "hi", "long", main).join(purity.select("g", *bits, "sig"), "g")
    found = found.withColumn("sig", F.when(F.col("long"), F.col("sig"))).withColumn("bucket", _bucket("n", 0.0, settings))
    found = store(found.drop("long"), "open")
    discard(rows, purity)
    others = found.select("shingle", "bucket", *(F.col(c).alias(f"{c}_b") for c in ("g", "n", "i", "lo", "hi", "main", *bits, "sig")))
    buckets = F.explode(F.array(F.col("bucket") - 1, F.col("bucket"), F.col("bucket") + 1))
    apart = found.filter(~F.col("main")).withColumn("bucket", buckets)
    once = (F.col("g") < F.col("g_b")) | (F.col("main_b") & (F.col("g") != F.col("g_b")))
    pure = (F.col("lo") == F.col("hi")) & (F.col("lo_b") == F.col("hi_b")) & (F.col("lo") == F.col("lo_b"))
    near = _possible(F.col("n"), F.col("i"), F.col("n_b"), F.col("i_b"), settings)
    # Bits that all members of one group have and none of the other: they differ in every pair of members.
    lone = [F.bit_count(F.col(f"{m}_all{x}").bitwiseAND(F.bitwise_not(f"{m}_any{y}"))) for m in marks for x, y in (("", "_b"), ("_b", ""))]
    near &= _near(reduce(lambda x, y: x + y, lone), F.col("n"), F.col("n_b"), settings)
    near &= F.isnull("sig") | F.isnull("sig_b") | _near(_differ("sig", "sig_b"), F.col("n"), F.col("n_b"), settings)
    met = store(apart.join(others, ["shingle", "bucket"]).filter(once & ~pure & near).select("g", "g_b").distinct(), "met")
    a, b = (members.select(F.col("g").alias(g), *(F.col(c).alias(f"{c}_{x}") for c in ("v", "label", "n", *marks))) for g, x in (("g", "a"), ("g_b", "b")))
    apart = _apart([F.col(f"{m}_a") for m in marks], [F.col(f"{m}_b") for m in marks])
    near = (F.col("label_a") != F.col("label_b")) & _near(apart, F.col("n_a"), F.col("n_b"), settings)
    pairs = met.join(a, "g").join(b, "g_b").filter(near).select(F.col("v_a").alias("a"), F.col("v_b").alias("b"))
    pairs = store(pairs, "crossed")
    discard(members, found, met)
    return pairs


def _group_pairs(members: DataFrame) -> DataFrame:
    """Members of one group that are not yet of one component."""
    mixed = members.groupBy("g").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("g")
    rows = store(members.join(store(mixed, "mixed"), "g", "left_semi"), "apart")
    other = rows.select("g", F.col("v").alias("b"), F.col("label").alias("label_b"))
    return rows.join(other, "g").filter("v < b and label <> label_b").select(F.col("v").alias("a"), "b")


def _distinct_lists(entries: DataFrame) -> DataFrame:
    """The entries of one shingle of all that the same groups hold: any of them pairs what the others pair, for its bound on
    like sets holds at each place that they share. Lists are known by two 64-bit sums of their groups and their length."""
    names = [F.bit_xor(F.xxhash64("g")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "g")).alias("y")]
    lists = entries.groupBy("shingle").agg(F.count("*").alias("c"), *names)
    kept = store(lists.groupBy("c", "x", "y").agg(F.min("shingle").alias("shingle")).select("shingle"), "lists")
    return entries.join(kept, "shingle", "left_semi")


def near_components(
    docs: DataFrame,
    settings: Settings = Settings(),
    doc_id: str = "doc_id",
    text: str = "text",
    limit: BroadcastLimit = BroadcastLimit(1_000_000, 32 << 20),
) -> DataFrame:
    """(id, n, component) for every row of ``docs``."""
    counts = shingle_counts(docs, settings, text)
    made = store(prefixes(docs, counts, settings, doc_id, text), "prefixes")
    every = store(made.select("id", "v", "n"), "ids")
    usable = made.filter("n > 0 and id is not null")
    whole = usable.groupBy("v").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("sig").alias("sig"))
    whole = store(whole.withColumn("key", F.xxhash64("prefix")), "whole")
    discard(made)
    groups = store(whole.groupBy("n", "key").agg(F.min("v").alias("g"), F.count("*").alias("size")), "groups")
    members = store(whole.select("v", "n", "key").join(groups, ["n", "key"]).select("v", "g", "size"), "members")
    heads = whole.join(groups.select(F.col("g").alias("v")), "v", "left_semi")
    listed = store(heads.select(F.col("v").alias("g"), "n", F.posexplode("prefix").alias("i", "shingle")), "listed")
    reps = store(whole.select("v", "id", "n", "sig"), "reps")
    discard(whole)
    # A shingle that one group alone holds pairs nothing.
    held = store(listed.groupBy("shingle").agg(F.count("*").alias("c")).filter("c > 1").select("shingle"), "held")
    shared = store(listed.join(held, "shingle", "left_semi"), "shared")
    discard(listed, held)
    entries = store(_distinct_lists(shared), "entries")
    discard(shared)

    repeated = not every.groupBy("id").count().filter("count > 1").isEmpty()
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), text_of(text).alias("text"))
    sets = Sets(texts, reps, repeated, settings, limit)

    def joined(label: DataFrame | None, pairs: DataFrame) -> DataFrame:
        links = sets.linked(pairs)
        if label is not None:
            if links.isEmpty():
                return label
            links = links.unionByName(label.select(F.col("id").alias("a"), F.col("component").alias("b")))
        return store(components(links), "label")

    label = joined(None, members.filter("size > 1 and v <> g").select(F.col("v").alias("a"), F.col("g").alias("b")))
    for turn in range(settings.turns):
        label = joined(label, _hub_pairs(_labelled(entries, label, "g"), turn, settings))
    named = store(_labelled(members, label, "v"), "named")
    label = joined(label, _cross_pairs(entries, named, reps, settings).unionByName(_group_pairs(named)))

    # From sets back to rows: the least id of all rows whose sets are of one component.
    usable = every.filter("n > 0 and id is not null")
    rows = store(_labelled(usable.select("id", "v"), label, "v"), "rows")
    least = store(rows.groupBy("label").agg(F.min("id").alias("component")), "least")
    found = rows.join(least, "label").select("id", "v", "component").distinct()
    found = store(found.filter("id <> component"), "found")
    discard(reps, entries, members, groups, named, rows)
    out = every.select("id", "v", "n").join(found, ["id", "v"], "left")
    return out.select("id", "n", F.coalesce("component", "id").alias("component"))
