"""Substring dedup by hashing: passages that stand elsewhere earlier are removed, with their offsets kept.

A line is normalised (case, white space) and digested. Digests are grouped over all documents; the occurrence in the
document of the lowest id, at the lowest position, stays. Consecutive lines of a document that are all repeats form a
passage, and a passage goes when it has at least ``least_words`` words, so lines that meet by chance are left alone.

Passages that begin or end inside a line are found by windows of ``window_words`` words, lines or not: every window that
a document of a lower id holds, or an earlier place of its own, goes. Equal windows of a text that overlap in a chain are
one place, so a cycle of fewer words than a window stays whole where it stands first. Two equal windows choose
the same word runs of half their length, those whose hash is the least among their neighbours, so only windows around a
chosen run that occurs twice are hashed and compared; none other can be equal to another.

A text that a lower id has as a whole goes as a whole, if it has as many words as a window, before any window is made.

Results for edge cases: a null id ranks last; rows with the same id rank alike, so neither loses to the other and repeats
among them stay. Null and empty texts have no units. Texts of any length are read whole. Words are parted by white space, so
a repeated line in a script without spaces counts as one word and stays. Columns beside the two named are not read, whatever
their names. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from placeweave.llm.jaccard import _mix, word_hashes
from placeweave.llm.store import discard, release, small_batches, store, text_of
from placeweave.operators.prefilter import only_possible, reduced_left_join

UNITS = "array<struct<pos: int, start: int, end: int, words: int, digest: binary, again: boolean>>"
LAST = 2**63 - 1


@dataclass(frozen=True)
class Settings:
    least_words: int = 50
    #: ``\n`` for lines, ``\n\n`` for paragraphs.
    separator: str = "\n"
    #: Words of a window that is compared wherever it stands.
    window_words: int = 50


def units_of(text: str, separator: str) -> list[dict]:
    """The units with words: place, code-point offsets, words, digest, and whether the text had it before."""
    from hashlib import blake2b

    out, at, seen = [], 0, set()
    for pos, unit in enumerate(text.split(separator)):
        words = unit.lower().split()
        if words:
            digest = blake2b(" ".join(words).encode("utf-8", "replace"), digest_size=16).digest()
            end = at + len(unit)
            out.append({"pos": pos, "start": at, "end": end, "words": len(words), "digest": digest, "again": digest in seen})
            seen.add(digest)
        at += len(unit) + len(separator)
    return out


def unit_udf(separator: str):
    @F.arrow_udf(UNITS)
    def units(texts):
        import pyarrow as pa

        kinds = {"pos": pa.int32(), "start": pa.int32(), "end": pa.int32(), "words": pa.int32(), "digest": pa.binary(), "again": pa.bool_()}
        flat, ends = {name: [] for name in kinds}, [0]
        for text in texts:
            for unit in units_of(text.as_py() or "", separator):
                for name, value in unit.items():
                    flat[name].append(value)
            ends.append(len(flat["pos"]))
        rows = pa.StructArray.from_arrays([pa.array(flat[n], k) for n, k in kinds.items()], list(kinds))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)

    return units


def _passages(marks: Column, least: int) -> Column:
    """Runs of neighbouring marks (sorted by pos) with enough words: ``array<struct<start, end>>``.

    A mark says which place comes right before it. Runs are sliced at the marks that begin one, so the work is linear.
    """
    places = F.sequence(F.lit(0), F.size(marks) - 1)
    begins = F.filter(places, lambda i: (i == 0) | (F.get(marks, i)["before"] != F.get(marks, i - 1)["pos"]))

    def run(begin: Column, k: Column) -> Column:
        stop = F.coalesce(F.get(begins, k + 1), F.size(marks))
        words = F.aggregate(F.slice(marks, begin + 1, stop - begin), F.lit(0), lambda n, m: n + m["words"])
        return F.struct(F.get(marks, begin)["start"].alias("start"), F.get(marks, stop - 1)["end"].alias("end"), words.alias("words"))

    runs = F.filter(F.transform(begins, run), lambda r: r["words"] >= least)
    return F.transform(runs, lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end")))


def repeated_units(docs: DataFrame, settings: Settings, doc_id: str, text: str) -> DataFrame:
    """(rank, body, marks): for each distinct (id, text) the units that stand earlier elsewhere, sorted by place."""
    units = unit_udf(settings.separator)
    body = text_of(text)
    listed = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("rank"), F.xxhash64(body).alias("body"), units(body).alias("u"))
    one = listed.select("rank", "body", F.posexplode("u").alias("nr", "x")).select("rank", "body", "nr", "x.*")
    every = store(one, "units")
    first = every.groupBy("digest").agg(F.min("rank").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    first = store(first, "repeats")
    hits = every.join(first, "digest").filter(F.col("again") | (F.col("rank") != F.col("first")))
    mark = F.struct(F.col("nr").alias("pos"), (F.col("nr") - 1).alias("before"), "start", "end", "words")
    marks = store(hits.groupBy("rank", "body").agg(F.sort_array(F.collect_set(mark)).alias("marks")), "marks")
    discard(every, first)
    return marks


def grams(words, k: int):
    """The hash of every run of ``k`` words, put together from runs whose lengths are powers of two."""
    import numpy as np

    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, at, step, run = np.full(n, k, np.uint64), 0, 1, words
    while True:
        if k & step:
            out = _mix(out * np.uint64(0xD6E8FEB86659FD93) + run[at : at + n])
            at += step
        if 2 * step > k:
            return out
        run = _mix(run[:-step] * np.uint64(0xD6E8FEB86659FD93) + run[step:])
        step *= 2


def chosen(hashes, width: int):
    """Places of the least of every ``width`` neighbours, the first of equals: neighbours that are equal choose alike."""
    import numpy as np

    if len(hashes) < width:
        return np.zeros(0, np.int64)
    if not width > 1:
        return np.arange(len(hashes))
    out = []
    for low in range(0, len(hashes) - width + 1, 1 << 14):
        part = hashes[low : low + (1 << 14) + width - 1]
        out.append(np.unique(low + np.arange(len(part) - width + 1) + np.lib.stride_tricks.sliding_window_view(part, width).argmin(axis=1)))
    return np.unique(np.concatenate(out))


def apart_before(hashes, places, size: int):
    """Which windows stand earlier in the text already; equal ones that overlap in a chain, as in a cycle, are one place."""
    import numpy as np

    order = np.lexsort((places, hashes))
    same = hashes[order][1:] == hashes[order][:-1]
    leaps = np.concatenate([[0], np.cumsum(same & (np.diff(places[order]) >= size))])
    start = np.maximum.accumulate(np.where(np.concatenate([[True], ~same]), np.arange(len(order)), 0))
    out = np.zeros(len(order), bool)
    out[order] = leaps > leaps[start]
    return out


def _words_of(texts: list[str]):
    """Word hashes of texts: case and white space as of units."""
    return word_hashes([" ".join(t.lower().split()) for t in texts])


def _marked_texts(batch, step: int = 128):
    for at in range(0, batch.num_rows, step):
        part = batch.slice(at, step)
        texts = [t or "" for t in part.column("text").to_pylist()]
        yield part, texts, _words_of(texts)


def repeated_windows(docs: DataFrame, settings: Settings) -> DataFrame:
    """(rank, body, start, end): windows of ``docs`` (rank, body, text) that stand earlier, in code points."""
    size = settings.window_words
    half = (size + 1) // 2
    width = size - half + 1
    small_batches(docs.sparkSession)

    def anchors(batches):
        import numpy as np
        import pyarrow as pa

        release()
        for batch in batches:
            for part, _, words in _marked_texts(batch):
                rows, twice, ends = [np.zeros(0, np.uint64)], [np.zeros(0, bool)], [0]
                for every in words:
                    runs = grams(every, half)
                    found, n = np.unique(runs[chosen(runs, width)], return_counts=True)
                    rows.append(found)
                    twice.append(n > 1)
                    ends.append(ends[-1] + len(found))
                at = np.repeat(np.arange(part.num_rows), np.diff(ends))
                ids = [part.column(c).take(pa.array(at)) for c in ("rank", "body")]
                arrays = [*ids, pa.array(np.concatenate(rows).view(np.int64)), pa.array(np.concatenate(twice))]
                yield pa.RecordBatch.from_arrays(arrays, names=["rank", "body", "anchor", "twice"])

    def windows(batches):
        import re

        import numpy as np
        import pyarrow as pa

        release()
        for batch in batches:
            for part, texts, words in _marked_texts(batch):
                wanted, columns = part.column("anchors"), {c: [] for c in ("at", "hash", "start", "end", "again")}
                for row, (text, every) in enumerate(zip(texts, words, strict=True)):
                    runs = grams(every, half)
                    spots = chosen(runs, width)
                    spots = spots[np.isin(runs[spots].view(np.int64), wanted[row].values.to_numpy())]
                    every = grams(every, size)
                    # A window holds the run at a spot if it starts at most ``width - 1`` words before it.
                    edge = np.zeros(len(every) + 1, np.int64)
                    np.add.at(edge, np.maximum(0, spots - width + 1), 1)
                    np.add.at(edge, np.minimum(len(every), spots + 1), -1)
                    places = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
                    if not len(places):
                        continue
                    bounds = np.array([m.span() for m in re.finditer(r"\S+", text)], np.int64)
                    every = every[places]
                    columns["at"].append(np.full(len(places), row))
                    columns["hash"].append(every.view(np.int64))
                    columns["start"].append(bounds[places, 0])
                    columns["end"].append(bounds[places + size - 1, 1])
                    columns["again"].append(apart_before(every, places, size))
                if not columns["at"]:
                    continue
                at, hashes, start, end, again = (np.concatenate(c) for c in columns.values())
                ids = [part.column(c).take(pa.array(at)) for c in ("rank", "body")]
                arrays = [*ids, pa.array(hashes), pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array(again)]
                yield pa.RecordBatch.from_arrays(arrays, names=["rank", "body", "hash", "start", "end", "again"])

    every = store(docs.mapInArrow(anchors, "rank long, body long, anchor long, twice boolean"), "anchors")
    common = every.groupBy("anchor").agg(F.count("*").alias("n"), F.max("twice").alias("twice")).filter("n > 1 or twice").select("anchor")
    common = store(common, "common")
    wanted = every.join(common, "anchor", "left_semi").groupBy("rank", "body").agg(F.collect_set("anchor").alias("anchors"))
    wanted = store(wanted, "wanted")
    discard(every, common)
    # Texts are many times their keys: those that surely hold nothing of the kind are not shuffled.
    some = only_possible(docs, wanted, ["rank", "body"], wanted.count())
    rows = some.join(wanted, ["rank", "body"]).select("rank", "body", "text", "anchors")
    found = rows.mapInArrow(windows, "rank long, body long, hash long, start int, end int, again boolean")
    found = store(found, "windows")
    discard(wanted)
    first = found.groupBy("hash").agg(F.min("rank").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    first = store(first, "held")
    some = only_possible(found, first, ["hash"], first.count())
    hits = some.join(first, "hash").filter(F.col("again") | (F.col("rank") != F.col("first")))
    # Windows of one text that overlap or touch are one span at once; rows that repeat give the same spans.
    spans = hits.groupBy("rank", "body").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    spans = store(spans.select("rank", "body", joined_spans(F.col("spans")).alias("spans")), "spans")
    discard(found, first)
    return spans.select("rank", "body", F.inline("spans"))


def split_copies(rows: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(rows to compare, spans of the others): a text that a row of a lower rank holds as a whole is one span from its first
    word to its last when it has ``least`` words, and none when it has fewer; it is not compared with anything."""
    # 128 bits name a text here, as a row that is taken for a copy is not looked at again.
    named = rows.withColumn("second", F.xxhash64(F.lit(1), "text"))
    ranks = named.groupBy("body", "second").agg(F.min("rank").alias("lo"), F.max("rank").alias("hi")).filter("lo <> hi").drop("hi")
    marked = named.join(store(ranks, "copies"), ["body", "second"], "left")
    later = F.coalesce(F.col("rank") > F.col("lo"), F.lit(False))
    n = F.size(F.filter(F.split("text", r"(?U)\s+"), lambda w: w != ""))
    start = F.length("text") - F.length(F.regexp_replace("text", r"(?U)^\s+", ""))
    end = F.length(F.regexp_replace("text", r"(?U)\s+$", ""))
    copies = marked.filter(later & (n >= least)).select("rank", "body", start.cast("int").alias("start"), end.cast("int").alias("end"))
    return marked.filter(~later).select("rank", "body", "text"), copies.distinct()


def joined_spans(spans: Column) -> Column:
    """Spans that overlap, or touch, as one."""

    @F.arrow_udf("array<struct<start: int, end: int>>")
    def joined(column):
        import numpy as np
        import pyarrow as pa

        starts, stops, ends = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [0]
        for row in column:
            flat = row.values
            start, end = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("start", "end"))
            order = np.lexsort((end, start))
            start, end = start[order], np.maximum.accumulate(end[order])
            new = np.concatenate([[True], start[1:] > end[:-1]]) if len(start) else np.zeros(0, bool)
            last = np.concatenate([new[1:], [True]]) if len(start) else new
            starts.append(start[new])
            stops.append(end[last])
            ends.append(ends[-1] + int(new.sum()))
        flat = pa.StructArray.from_arrays([pa.array(np.concatenate(x), pa.int32()) for x in (starts, stops)], ["start", "end"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)

    return joined(spans)


def cut(text: Column, spans: Column, separator: str) -> Column:
    """``text`` without the spans; the separator after a span goes with it, or the one before the last.

    A span that ends inside a line takes the white space after it along, one character.
    """
    step = len(separator)

    def after(end: Column) -> Column:
        blank = F.substring(text, end + 1, F.lit(1)).rlike(r"^\s$")
        return end + F.when(F.substring(text, end + 1, F.lit(step)) == separator, step).when(blank, 1).otherwise(0)

    bounds = F.transform(spans, lambda s, i: F.struct(F.when(i == 0, 0).otherwise(after(F.get(spans, i - 1)["end"])).alias("a"), s["start"].alias("b")))
    kept = F.transform(bounds, lambda b: F.substring(text, b["a"] + 1, b["b"] - b["a"]))
    rest = F.substring(text, after(F.get(spans, F.size(spans) - 1)["end"]) + 1, F.length(text))
    joined = F.concat(F.array_join(kept, ""), rest)
    ends = F.get(spans, F.size(spans) - 1)["end"] == F.length(text)
    parted = F.substring(joined, F.length(joined) - step + 1, F.lit(step)) == separator
    whole = F.when(ends & (F.length(joined) >= step) & parted, F.substring(joined, F.lit(1), F.length(joined) - step)).otherwise(joined)
    return F.when(F.size(spans) == 0, text).otherwise(whole)


def remove_repeats(docs: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, removed, n_removed): every row with its remaining text and the spans removed, in original offsets."""
    body = text_of(text)
    rows = docs.select(F.col(doc_id).alias("doc_id"), body.alias("text")).withColumns(
        {"rank": F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)), "body": F.xxhash64("text")}
    )
    marks = repeated_units(docs, settings, doc_id, text)
    lines = marks.select("rank", "body", F.inline(_passages(F.col("marks"), settings.least_words)))
    compared, copies = split_copies(rows.select("rank", "body", "text"), settings.window_words)
    spans = lines.unionByName(copies).unionByName(repeated_windows(compared, settings))
    listed = spans.groupBy("rank", "body").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    passages = store(listed.select("rank", "body", joined_spans(F.col("spans")).alias("removed")), "passages")
    none = F.array().cast("array<struct<start:int,end:int>>")
    joined = reduced_left_join(rows, passages, ["rank", "body"], passages.count())
    joined = joined.withColumn("removed", F.coalesce("removed", none))
    return joined.select(
        "doc_id", cut(F.col("text"), F.col("removed"), settings.separator).alias("text"), "removed", F.size("removed").alias("n_removed")
    )
