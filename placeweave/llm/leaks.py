"""Benchmark decontamination: a BM25 inverted index of test items, searched with block-max WAND by every passage.

Items are the indexed side. Term weights are BM25 scores divided by the item's score for itself, so one threshold fits
items of any length. Every text is cut into passages of twice the longest item, starting an item's length apart, so an
item lies whole inside some passage. A passage is searched only if its rarer terms alone lift some item to what the frequent ones cannot give;
whatever is retrieved is then verified by the share of the question's five-word shingles and of the answer's words.

Statistics cover all items; they are made by Spark and read in blocks of ``Settings.block_items`` items, each block's
index broadcast after its size was checked, every text meeting every block. Items without words are never found; null
texts have no passages; texts of any length are searched whole; repeated items are found one by one and repeated texts
alike; without documents, or without items, there are no pairs. Pairs carry the columns named here only, so other columns
of the documents cannot clash; ``without_leaks`` keeps every column as it is.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass, field
from itertools import chain, repeat

from pyspark.sql import Column, DataFrame, functions as F, types as T

from placeweave.llm.store import Shared, store, text_of

WORD = re.compile(r"\w+")
# Characters of text searched together; sets speed and memory only.
PORTION = 1_000_000
HIT = "array<struct<nr: bigint, score: double, question: double, answer: double>>"


@dataclass(frozen=True)
class Settings:
    threshold: float = 0.5
    overlap: float = 0.8
    #: The share of the threshold that frequent terms may give before they count as rarer ones; sets speed only.
    common: float = 0.5
    shingle: int = 5
    k1: float = 1.2
    b: float = 0.75
    posting_block: int = 64
    block_items: int = 50_000
    block_bytes: int = 256 << 20


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def shingles(tokens: list[str], n: int) -> set[tuple]:
    """All runs of ``n`` words; a shorter text is one run."""
    return {tuple(tokens[i : i + n]) for i in range(max(1, len(tokens) - n + 1))} if tokens else set()


@dataclass
class Index:
    """Postings of one block of items: for each term its items in order, their weights, and block maxima."""

    settings: Settings
    numbers: list[int]
    questions: list[list[str]]
    answers: list[list[str]]
    postings: dict[str, tuple[list[int], list[float]]]
    span: int = 0
    rare: dict[str, int] = field(default_factory=dict)
    flat: tuple = ()
    needed: object = None
    maxima: dict[str, list[float]] = field(default_factory=dict)

    def __post_init__(self):
        import numpy as np

        step = self.settings.posting_block
        self.maxima = {t: [max(w[i : i + step]) for i in range(0, len(w), step)] for t, (_, w) in self.postings.items()}
        self.span = max([1, *(len(q) + len(a) for q, a in zip(self.questions, self.answers, strict=True))])
        # The most frequent terms, as long as together they lift no item far, need not be looked at first.
        lifted, most, common = [0.0] * len(self.numbers), self.settings.threshold * self.settings.common, set()
        for term, (items, weights) in sorted(self.postings.items(), key=lambda x: (-len(x[1][0]), x[0])):
            if len(items) < 2 or any(lifted[i] + w > most for i, w in zip(items, weights, strict=True)):
                continue
            common.add(term)
            for i, w in zip(items, weights, strict=True):
                lifted[i] += w
        self.needed = self.settings.threshold - np.array(lifted) - 1e-9
        rare = [t for t in self.postings if t not in common]
        self.rare = {t: k for k, t in enumerate(rare)}
        sizes = np.array([len(self.postings[t][0]) for t in rare], np.int64)
        items = np.array([i for t in rare for i in self.postings[t][0]], np.int64)
        weights = np.array([w for t in rare for w in self.postings[t][1]], float)
        self.flat = items, weights, np.cumsum(sizes) - sizes, sizes

    def retrieve(self, terms: set[str]) -> list[tuple[int, float]]:
        """Items that ``terms`` score to the threshold or above: block-max WAND."""
        step, least, end = self.settings.posting_block, self.settings.threshold - 1e-9, len(self.numbers)
        used = [t for t in terms if t in self.postings]
        items, weights = [self.postings[t][0] for t in used], [self.postings[t][1] for t in used]
        maxima = [self.maxima[t] for t in used]
        tops, at, head = [max(m) for m in maxima], [0] * len(used), [i[0] for i in items]
        order, out = list(range(len(used))), []

        def advance(k: int, target: int) -> None:
            at[k] = bisect_left(items[k], target, at[k])
            head[k] = items[k][at[k]] if at[k] < len(items[k]) else end

        while True:
            order.sort(key=head.__getitem__)
            while order and head[order[-1]] == end:
                order.pop()
            bound, size = 0.0, 0
            while size < len(order) and bound < least:
                bound += tops[order[size]]
                size += 1
            if bound < least:
                return out
            pivot = head[order[size - 1]]
            while size < len(order) and head[order[size]] == pivot:
                size += 1
            for k in order[:size]:
                if head[k] < pivot:
                    advance(k, pivot)
            front = [k for k in order[:size] if head[k] < end]
            if sum(maxima[k][at[k] // step] for k in front) < least:
                # No item before the nearest end of a block, or before the next list's item, can reach the threshold.
                stops = [items[k][min(len(items[k]), (at[k] // step + 1) * step) - 1] + 1 for k in front]
                target = max(pivot + 1, min([*stops, *(head[k] for k in order[size : size + 1])], default=end))
            else:
                score = sum(weights[k][at[k]] for k in front if head[k] == pivot)
                if score >= least:
                    out.append((pivot, score))
                target = pivot + 1
            for k in front:
                if head[k] < target:
                    advance(k, target)

    def verify(self, item: int, passage: list[str]) -> tuple[float, float]:
        n, here = self.settings.shingle, set(passage)
        asked, told = shingles(self.questions[item], n), self.answers[item]
        size = min(n, len(self.questions[item]))
        found = len(asked & shingles(passage, size)) / len(asked) if asked else 1.0
        return found, sum(w in here for w in told) / len(told) if told else 1.0

    def candidates(self, blocks, places):
        """Windows of two neighbouring blocks whose rare terms lift some item far enough, given each token's block and rare term."""
        import numpy as np

        items, weights, begins, sizes = self.flat
        known = places >= 0
        once = np.unique(blocks[known] * len(begins) + places[known])
        blocks, places = once // max(1, len(begins)), once % max(1, len(begins))
        each = sizes[places]
        after = np.cumsum(each)
        at = np.repeat(begins[places] - after + each, each) + np.arange(after[-1] if len(after) else 0)
        width = len(self.numbers)
        keys = np.repeat(blocks, each) * width + items[at]
        names, back = np.unique(np.concatenate([keys, keys - width]), return_inverse=True)
        lifts = np.bincount(back, np.concatenate([weights[at], weights[at]]), len(names))
        return np.unique(names[lifts >= self.needed[names % width]] // width)

    def search_many(self, texts) -> list[dict[int, tuple[float, float, float]]]:
        """Verified items of each whole text with their best passage's figures. Texts go through some at a time."""
        import numpy as np

        tokens = [words(text) for text in texts]
        out: list[dict] = [{} for _ in tokens]
        # Blocks are numbered over all texts, with an empty one before each text, so no window joins two texts.
        counts = np.array([-(-len(t) // self.span) + 1 for t in tokens], np.int64)
        first = np.cumsum(counts) - counts + 1
        places = np.fromiter(chain.from_iterable(map(self.rare.get, t, repeat(-1)) for t in tokens), np.int64)
        blocks = np.concatenate([f + np.arange(len(t)) // self.span for f, t in zip(first, tokens, strict=True)] or [np.zeros(0, np.int64)])
        for window in self.candidates(blocks.astype(np.int64), places).tolist():
            text = int(np.searchsorted(first, window, "right")) - 1
            if text < 0 or window - first[text] >= counts[text] - 1:
                continue
            start, best = (window - int(first[text])) * self.span, out[text]
            passage = tokens[text][start : start + 2 * self.span]
            for item, score in self.retrieve(set(passage)):
                question, answer = self.verify(item, passage)
                if min(question, answer) >= self.settings.overlap:
                    best[item] = max(best.get(item, (0.0, 0.0, 0.0)), (score, question, answer))
        return out


def _portions(texts):
    """Lists of texts of about a million characters."""
    part, size = [], 0
    for text in texts:
        part.append(text.as_py() or "")
        size += len(part[-1])
        if size >= PORTION:
            yield part
            part, size = [], 0
    yield part


def numbered(items: DataFrame, item_id: str, question: Column, answer: Column) -> DataFrame:
    """(nr, item_id, question, answer) with consecutive numbers in hash order, so that blocks are alike."""
    from pyspark.sql import Window

    rows = items.select(F.col(item_id).alias("item_id"), text_of(question).alias("question"), text_of(answer).alias("answer"))
    # Numbers within hash buckets, shifted by the sizes of the buckets before: no window over the whole table.
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("item_id", "question", "answer"), F.lit(1024)))
    sizes = {r["bucket"]: r["count"] for r in rows.groupBy("bucket").count().collect()}
    shift, ahead = [], 0
    for bucket in range(1024):
        shift.append(ahead)
        ahead += sizes.get(bucket, 0)
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("item_id", "question", "answer")) - 1
    before = F.get(F.array(*[F.lit(s) for s in shift]), F.col("bucket").cast("int"))
    return rows.select((place + before).cast("long").alias("nr"), "item_id", "question", "answer")


def postings(items: DataFrame, settings: Settings) -> DataFrame:
    """(nr, terms array<struct<term, weight>>): BM25 weights over all items, divided by each item's own score."""
    split = F.arrow_udf(_split, "array<string>")
    every = items.select("nr", F.explode(split(F.concat_ws(" ", "question", "answer"))).alias("term"))
    counts = every.groupBy("nr", "term").agg(F.count("*").alias("tf"))
    lengths = counts.groupBy("nr").agg(F.sum("tf").alias("length"))
    n, mean = lengths.agg(F.count("*"), F.avg("length")).first()
    df = counts.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (F.lit(n or 0) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    spread = settings.k1 * (1 - settings.b + settings.b * F.col("length") / F.lit(float(mean or 1)))
    weight = idf * F.col("tf") * (settings.k1 + 1) / (F.col("tf") + spread)
    weighted = counts.join(lengths, "nr").join(df, "term").select("nr", "term", weight.alias("weight"))
    return weighted.groupBy("nr").agg(F.sum("weight").alias("own"), F.collect_list(F.struct("term", "weight")).alias("terms"))


def _split(texts):
    import pyarrow as pa

    return pa.array([words(t.as_py()) for t in texts], pa.list_(pa.string()))


def build(items: DataFrame, item_id: str = "item_id", question: Column | str = "text", answer: Column | str | None = None, settings: Settings = Settings()):
    """The numbered items and an iterator of index blocks."""
    asked = F.col(question) if isinstance(question, str) else question
    told = F.lit("") if answer is None else F.col(answer) if isinstance(answer, str) else answer
    numbers = store(numbered(items, item_id, asked, told), "items")
    listed = store(numbers.join(postings(numbers, settings), "nr", "left"), "postings")

    def blocks():
        total, nbytes = listed.agg(F.count("*"), F.sum(F.octet_length("question") + F.octet_length("answer"))).first()
        share = max(1, int(settings.block_bytes // 32 // max(1, (nbytes or 0) / max(1, total))))
        step = min(settings.block_items, share)
        for low in range(0, total, step):
            rows = listed.filter(F.col("nr").between(low, low + step - 1)).orderBy("nr").collect()
            found: dict[str, tuple[list[int], list[float]]] = {}
            for at, row in enumerate(rows):
                for term in row["terms"] or ():
                    items_, weights = found.setdefault(term["term"], ([], []))
                    items_.append(at)
                    weights.append(term["weight"] / row["own"])
            yield Index(settings, [r["nr"] for r in rows], [words(r["question"]) for r in rows], [words(r["answer"]) for r in rows], found)

    return numbers, blocks


def searcher(df: DataFrame, index: Index):
    """``text -> array of verified hits`` for a text column."""
    shared = Shared(df.sparkSession, index)

    @F.arrow_udf(HIT)
    def search(texts):
        import pyarrow as pa

        index, out = shared.value, []
        for hits in chain.from_iterable(map(index.search_many, _portions(texts))):
            out.append([dict(nr=index.numbers[i], score=s, question=q, answer=a) for i, (s, q, a) in sorted(hits.items())])
        kind = pa.struct([("nr", pa.int64()), *((n, pa.float64()) for n in ("score", "question", "answer"))])
        return pa.array(out, pa.list_(kind))

    return search


def find_leaks(docs: DataFrame, numbers: DataFrame, blocks, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap) of every verified pair."""
    pairs = None
    for index in blocks():
        hits = docs.select(F.col(doc_id).alias("doc_id"), F.explode(searcher(docs, index)(F.col(text))).alias("hit"))
        pairs = hits if pairs is None else pairs.unionByName(hits)
    if pairs is None:
        hit = T._parse_datatype_string(HIT).elementType
        pairs = docs.limit(0).select(F.col(doc_id).alias("doc_id"), F.lit(None).cast(hit).alias("hit"))
    flat = pairs.select("doc_id", "hit.*").withColumnsRenamed({"question": "question_overlap", "answer": "answer_overlap"})
    return flat.join(numbers.select("nr", "item_id"), "nr").drop("nr")


def without_leaks(docs: DataFrame, blocks, text: str = "text") -> DataFrame:
    """``docs`` without the rows that hold an item; no row is shuffled."""
    kept = docs
    for index in blocks():
        kept = kept.filter(F.size(searcher(docs, index)(F.col(text))) == 0)
    return kept


def question_and_answer(text: str = "text") -> tuple[Column, Column]:
    """An item of several lines asks in all but the last and answers in the last; one line is all question."""
    lines = F.split(F.trim(text_of(text)), "\n")
    last = F.when(F.size(lines) > 1, F.element_at(lines, -1)).otherwise("")
    return F.when(F.size(lines) > 1, F.array_join(F.slice(lines, F.lit(1), F.size(lines) - 1), "\n")).otherwise(F.col(text)), last
