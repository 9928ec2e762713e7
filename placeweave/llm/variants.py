"""Spelling variants by finite-state composition: vocabulary acceptor, one-edit transducer, vocabulary acceptor.

A vocabulary word is near another when one inserted, deleted or replaced code point leads from one to the other. Two such
words share their first or their last code points, so the composition starts in as many initial states as there are
starts (or ends) of words, and each is a partition of its own: its words' remainders become a minimised acyclic acceptor,
and the pairs that acceptor, one-edit transducer and acceptor accept together are walked. Before the edit both copies of
the acceptor are in one state, so a walk costs what the words share, not what pairs there are.

A partition above ``Settings.most`` words starts in deeper states: it is parted by length and then by one more half of
what its words do not yet share, at either end. The last such partition leaves at most two code points open and is bounded
by the alphabet. Every pair is found in one partition only: the ones by a common end leave out what a common start finds.

Results for edge cases: a null text has no words; a null document id reads as an empty one; a text of any length is read
whole; rows that repeat count each time; an empty table gives an empty result; equal counts among near words go to the
smaller word in code-point order. Other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from placeweave.llm.store import release, store

# What a word is made of, and which occurrences lose a code point.
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
CUT_EVERY = 199

NO_CAP = 2**31 - 1


@dataclass(frozen=True)
class Settings:
    #: Words of fewer code points, or seen less often, are not in the vocabulary.
    least_length: int = 6
    least_count: int = 5
    #: A near word is a word's form when it is at least so many times as frequent.
    ratio: int = 5
    #: Words of one partition that a task composes at once; larger partitions are split, which changes no result.
    most: int = 20_000


def lowered(run: Column) -> Column:
    """A run with only A to Z lower-cased; the slower exact form is needed only beside capitals that have accents."""
    exact = F.translate(run, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(run.rlike("[\\u00C0-\\u00DE]"), exact).otherwise(F.lower(run))


def words_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word), one row an occurrence, after the rule that makes some occurrences lose a code point."""
    owner = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    runs = docs.select(owner.alias("owner"), F.explode(F.regexp_extract_all(text, F.lit(RUN), 0)).alias("run"))
    runs = runs.select("owner", lowered(F.col("run")).alias("run"))
    runs = runs.select("run", F.crc32(F.concat("owner", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    return runs.select(F.when(F.col("h") % CUT_EVERY == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(word, n) of the words long and frequent enough; counted before the shuffle, so a common word is a row a task."""
    long_enough = words.filter(F.char_length("word") >= settings.least_length)
    return long_enough.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= settings.least_count)


# The automata


def minimised(words: list[str]):
    """(arcs, final) of the smallest acyclic acceptor of sorted distinct words; state 0 is the initial state."""
    arcs: list[dict[str, int]] = [{}]
    final = [False]
    known: dict = {}
    path = [0]  # the states of the latest word, which may still grow
    last = ""

    def settle(depth: int) -> None:
        while len(path) > depth + 1:
            state = path.pop()
            like = known.setdefault((final[state], tuple(sorted(arcs[state].items()))), state)
            if like != state:
                arcs[path[-1]][last[len(path) - 1]] = like

    for word in words:
        shared = 0
        while shared < min(len(word), len(last)) and word[shared] == last[shared]:
            shared += 1
        settle(shared)
        for symbol in word[shared:]:
            arcs.append({})
            final.append(False)
            arcs[path[-1]][symbol] = len(arcs) - 1
            path.append(len(arcs) - 1)
        final[path[-1]] = True
        last = word
    settle(0)
    return arcs, final


def _common(arcs, final, p: int, q: int, but: str | None = None):
    """Strings that lead from both states to acceptance; ``but`` is a symbol that they must not begin with."""
    if not but and not (final[p] and final[q]) and arcs[p].keys().isdisjoint(arcs[q]):
        return
    path: list[str] = []
    todo = [(p, q, 0, "")]
    while todo:
        x, y, depth, symbol = todo.pop()
        if depth:
            del path[depth - 1 :]
            path.append(symbol)
        if final[x] and final[y]:
            yield "".join(path)
        below = arcs[y]
        for c, to in arcs[x].items():
            if c in below and not (depth == 0 and c == but):
                todo.append((to, below[c], depth + 1, c))


def composed(arcs, final, depth_below: int = NO_CAP):
    """Pairs (u, v) that the composition accepts, each once: equal up to their first difference, then one edit, then equal.

    ``depth_below`` leaves out pairs that agree in so many code points or more at their start.
    """
    path: list[str] = []
    todo = [(0, 0, "")]
    while todo:
        state, depth, symbol = todo.pop()
        if depth:
            del path[depth - 1 :]
            path.append(symbol)
        here = sorted(arcs[state].items())
        head = "".join(path) if here else ""
        for i, (c, to) in enumerate(here):
            for d, other in here[i + 1 :]:
                for rest in _common(arcs, final, to, other):
                    yield head + c + rest, head + d + rest
            # The longer word has one more symbol here, and the shorter one goes on with another symbol or ends.
            for rest in _common(arcs, final, state, to, c):
                yield head + rest, head + c + rest
            if depth + 1 < depth_below:
                todo.append((to, depth + 1, c))


# Partitions by initial state

KEYS = ["role", "a", "b", "cap", "head", "tail"]


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows with the initial state of each: the word's first ``a`` and last ``b`` code points."""
    tail = F.when(F.col("b") > 0, F.substring("word", F.char_length("word") - F.col("b") + 1, F.col("b"))).otherwise("")
    return rows.select("word", "n", "role", "a", "b", "cap", F.substring("word", F.lit(1), F.col("a")).alias("head"), tail.alias("tail"))


def _states(*states) -> Column:
    """Rows of (role, a, b, cap) to take the place of one."""
    names = ("role", "a", "b", "cap")
    made = [F.struct(*(F.lit(v).cast("int").alias(n) if isinstance(v, int) else v.cast("int").alias(n) for n, v in zip(names, s))) for s in states]
    return F.array(*made)


def _initial(words: DataFrame, settings: Settings) -> DataFrame:
    """Every word in the partition of its start and in that of its end."""
    half = settings.least_length // 2
    both = _states((0, half, 0, NO_CAP), (0, 0, settings.least_length - half, half))
    return _keyed(words.select("word", "n", F.explode(both).alias("s")).select("word", "n", "s.*"))


def _deeper(rows: DataFrame, settings: Settings) -> DataFrame:
    """The rows of crowded partitions in deeper initial states.

    ``role`` is the length of a pair's shorter word, 0 before it is told apart: a word stands for pairs of its own length
    and, as the longer word, for those of one less. With the role known, what a pair does not yet share is cut in halves
    and one of them is free of the edit.
    """
    size, a, b, cap, role = F.char_length("word"), F.col("a"), F.col("b"), F.col("cap"), F.col("role")
    half = F.floor((role - a - b) / 2)
    by_role = F.filter(_states((size, a, b, cap), (size - 1, a, b, cap)), lambda s: s["role"] >= settings.least_length)
    by_half = _states((role, a + half, b, cap), (role, a, role - a - half, F.least(cap, a + half)))
    by_half = F.filter(by_half, lambda s: s["a"] < s["cap"])
    deeper = rows.select("word", "n", F.explode(F.when(role == 0, by_role).otherwise(by_half)).alias("s"))
    return _keyed(deeper.select("word", "n", "s.*"))


def _near_of(batches):
    """Per word of a partition: how many near words, and the one of largest n. Rows arrive grouped by initial state."""
    import pyarrow as pa

    release()
    names = ["word", "n_near", "form_n", "form"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]

    def found(key, counts: dict[str, int]):
        role, a, b, cap, head, tail = key
        best: dict[str, list] = {}

        def say(word, near):
            held, n = best.setdefault(word, [0, 0, ""]), counts[near]
            held[0] += 1
            if n > held[1] or (n == held[1] and near < held[2]):
                held[1:] = n, near

        middles = sorted(w[a : len(w) - b] for w in counts)
        for u, v in composed(*minimised(middles), cap - a):
            u, v = head + u + tail, head + v + tail
            if (role == 0 or min(len(u), len(v)) == role) and u[:cap] != v[:cap]:
                say(u, v)
                say(v, u)
        return [(w, *held) for w, held in best.items()]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    state, counts, out = None, {}, []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in (*KEYS, "word", "n")]
        for *key, word, n in zip(*columns):
            if key != state:
                out += found(state, counts) if len(counts) > 1 else []
                state, counts = key, {}
                if len(out) > 10_000:
                    yield batch_of(out)
                    out = []
            counts[word] = n
    out += found(state, counts) if len(counts) > 1 else []
    if out:
        yield batch_of(out)


def near_words(words: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(word, n_near, form_n, form) of the words of ``words`` (word, n) that have near ones; ``form`` has the largest n."""
    rows, parts = store(_initial(words, settings), "initial-states"), []
    while True:
        sizes = store(rows.groupBy(*KEYS).agg(F.count("*").alias("size")).filter("size > 1"), "sizes")
        crowded = (F.col("size") > settings.most) & ((F.col("role") == 0) | (F.col("role") - F.col("a") - F.col("b") > 1))
        ready = rows.join(sizes.filter(~crowded).select(KEYS), KEYS, "left_semi")
        ready = ready.repartition(*KEYS).sortWithinPartitions(*KEYS).select(*KEYS, "word", "n")
        parts.append(store(ready.mapInArrow(_near_of, "word string, n_near long, form_n long, form string"), "near"))
        hot = sizes.filter(crowded).select(KEYS)
        if hot.isEmpty():
            break
        rows = store(_deeper(rows.join(hot, KEYS, "left_semi"), settings), "deeper-states")
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")
    near = every.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return near.select("word", "n_near", (-F.col("best.less")).alias("form_n"), "best.form")


def roots(links: DataFrame) -> DataFrame:
    """(word, root): the last word that the links (word, form) lead to. Each round doubles how far a word has come.

    Forms are always more frequent than their words, so there are no rings.
    """
    at = store(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = at.join(ahead, "root", "left")
        moved = store(moved.select("word", F.coalesce("further", "root").alias("root"), F.isnotnull("further").alias("moved")), "roots")
        if moved.filter("moved").isEmpty():
            return moved.select("word", "root")
        at = moved.select("word", "root")


def variants(words: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every row of a vocabulary (word, n)."""
    near = near_words(words, settings).withColumnRenamed("form", "near")
    every = words.join(near, "word", "left")
    is_form = F.col("form_n") >= settings.ratio * F.col("n")
    every = store(
        every.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("near")).alias("form"),
            F.when(is_form, F.col("form_n")).alias("form_n"),
        ),
        "forms",
    )
    last = roots(every.filter("form is not null"))
    return every.join(last, "word", "left").select(*every.columns, F.coalesce("root", "word").alias("root"))


def spelling_variants(docs: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``variants`` of the vocabulary of whole texts."""
    return variants(store(vocabulary(words_of(docs, doc_id, text), settings), "vocabulary"), settings)
