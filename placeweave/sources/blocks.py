"""JSON documents of any layout as splittable text: a structural index of blocks.

Text is read in pieces that end at a closing brace, so every document is cut into the blocks of its file whatever its
layout. What a block holds depends on where it begins: in a string or not, how deep, and in which member. So a first pass
reports for either string state what a block does: the state it ends in, how much deeper or higher it ends, the least depth
it comes to, and the last member name at every depth that may be the document's own. These reports, one row a block, are
composed in block order per file. The second pass then knows the state at the start of its block and cuts the items of the
wanted list; items that cross blocks are put together from their parts. A task holds one batch and one item at a time.

A character is structural where it stands outside strings; quotes after an odd run of backslashes are not quotes. Blocks end
behind a brace, so neither an escape nor a member name and its colon are ever parted (a name with a brace in it may be, and
is then no name that is looked for).
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.sizing import BroadcastLimit
from ..session import landed

# The functions below travel with the job, so executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEPARATOR = "}"
#: Depth inside the wanted list: the document is 1, the list 2, an item 3.
LIST, ITEM = 2, 3
STATE_BYTES = 200
#: The place of an item that crosses its block's end: behind all others of the block, as places stay below 2 ** 33.
CROSSING = (1 << 33) - 2

_QUOTE, _SLASH, _COLON, _COMMA = b'"\\:,'
_OPEN, _CLOSE = b"{[", b"}]"


def _structure(b):
    """(parity, at, step) of a stretch of bytes: parity of quotes up to each byte, and the places of brackets and colons
    with 1, -1 or 0 for what they do to the depth, strings not yet told apart."""
    import numpy as np

    quotes = b == _QUOTE
    slashes = np.flatnonzero(b == _SLASH)
    if len(slashes):
        first = np.flatnonzero(np.diff(slashes, prepend=-2) > 1)
        lengths = np.diff(first, append=len(slashes))
        after = (slashes[first] + lengths)[lengths % 2 == 1]
        quotes[after[after < len(b)]] = False
    effect = np.full(256, 2, np.int8)
    effect[[*_OPEN]], effect[[*_CLOSE]], effect[_COLON] = 1, -1, 0
    steps = effect[b]
    at = np.flatnonzero(steps != 2)
    return np.cumsum(quotes, dtype=np.int64) & 1, quotes, at, steps[at].astype(np.int64)


def _name(raw: bytes, quotes, colon: int) -> str:
    """The string right before a colon, ``?`` when it does not begin in this stretch."""
    import numpy as np

    k = int(np.searchsorted(quotes, colon))
    if k < 2:
        return "?"
    return raw[quotes[k - 2] + 1 : quotes[k - 1]].decode("utf-8", "replace")


def _joined(column):
    """The pieces of a batch as one stretch of bytes, the separators back in place."""
    return b"".join(piece + b"}" for piece in column.to_pylist())


def _runs(batch):
    """(path, block, size, rows) for each run of a batch's rows that belong to one block."""
    import numpy as np

    paths, blocks, sizes = (batch.column(c).to_pylist() for c in ("path", "block", "size"))
    turns = [0, *(i for i in range(1, len(paths)) if blocks[i] != blocks[i - 1] or paths[i] != paths[i - 1]), len(paths)]
    for a, b in zip(turns, turns[1:]):
        if b > a:
            yield paths[a], blocks[a], sizes[a], np.arange(a, b)


def text_pieces(source, found: list[str]) -> DataFrame:
    """(path, block, size, pos, value) of the pieces; ``(path, block, pos)`` sorts like the file."""
    text = source.option("lineSep", SEPARATOR).text(found)
    return text.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"),
        F.monotonically_increasing_id().alias("pos"),
        F.col("value").cast("binary").alias("value"),
    )


REPORT = "path string, block long, size long, bytes long, flips boolean, " + ", ".join(
    f"delta{e} long, low{e} long, names{e} map<long,string>" for e in (0, 1)
)


def _reports(batches):
    """A row for each block; 0 and 1 are the cases that it begins outside and inside a string."""
    import numpy as np
    import pyarrow as pa

    names = ["path", "block", "size", "bytes", "flips", "delta0", "low0", "names0", "delta1", "low1", "names1"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), *[pa.int64(), pa.int64(), pa.map_(pa.int64(), pa.string())] * 2]
    key, size, count, parity, case = None, 0, 0, 0, []

    def row():
        told = [v for delta, low, found in case for v in (delta, low, list(found.items()))]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((*key, size, count, bool(parity), *told), kinds)], names=names)

    for batch in batches:
        for path, block, of, rows in _runs(batch):
            if (path, block) != key:
                if key:
                    yield row()
                key, size, count, parity, case = (path, block), of, 0, 0, [[0, 0, {}], [0, 0, {}]]
            raw = _joined(batch.column("value").slice(rows[0], len(rows)))
            b = np.frombuffer(raw, np.uint8)
            inside, quotes, at, steps = _structure(b)
            places = np.flatnonzero(quotes)
            for entry in (0, 1):
                state = case[entry]
                keep = inside[at] == (entry ^ parity)
                depth = state[0] + np.cumsum(steps[keep])
                if not len(depth):
                    continue
                colons = steps[keep] == 0
                spots, depths = at[keep][colons], depth[colons]
                for d in np.unique(depths[depths <= 1]):
                    state[2][int(d)] = _name(raw, places, int(spots[np.flatnonzero(depths == d)[-1]]))
                state[0], state[1] = int(depth[-1]), min(state[1], int(depth.min()))
            count += len(b)
            parity ^= int(inside[-1]) if len(b) else 0
    if key:
        yield row()


STATE = "path string, block long, depth long, inside boolean, member string, opener long, closed boolean, ended boolean"


def _composer(member: str):
    """Reports in (path, block) order to the state at the start of every block.

    ``opener`` is the block in which the item open at the start began, ``closed`` whether the last brace of the block is
    really there, and ``ended`` (true for all but the last block) whether the document ends where the file does.
    """

    def compose(batches):
        import pyarrow as pa

        names = [field.split()[0] for field in STATE.split(", ")]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.int64(), pa.bool_(), pa.bool_()]
        path, depth, inside, name, opener, total, held = None, 0, 0, None, None, 0, None

        def last(row):
            """The file's last block: whether its last brace was read or made up, and whether the document is whole."""
            # A compressed file has no such count; there the document's own end decides.
            real = total == size or (total != size + 1 and depth == 0)
            return [*row[:6], real, inside == 0 and depth == (0 if real else -1)]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["path"] != path:
                    if held:
                        out.append(last(held))
                    path, depth, inside, name, opener, total, held = r["path"], 0, 0, None, None, 0, None
                if held:
                    out.append([*held, True, True])
                held, size = [path, r["block"], depth, bool(inside), name, opener], r["size"]
                delta, low, seen = (r[f"{c}{inside}"] for c in ("delta", "low", "names"))
                after = dict(seen).get(1 - depth, name)
                if depth + delta < ITEM or after != member:
                    opener = None
                elif opener is None or depth + low < ITEM:
                    opener = r["block"]
                depth, inside, name, total = depth + delta, inside ^ r["flips"], after, total + r["bytes"]
            if out:
                yield batch_of(out)
        if held:
            yield batch_of([last(held)])

    return compose


CUT = "path string, block long, pos long, opener long, part string, data binary"


def _cutter(member: str, parts_only: bool):
    """Pieces with the state of their block to whole items (``item``), what crosses a block's ends (``part``), and
    anything else that stands in the list (``junk``). ``parts_only`` gives the parts alone."""

    def cut(batches):
        import numpy as np
        import pyarrow as pa

        names = ["path", "block", "pos", "opener", "part", "data"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        plain = np.zeros(256, bool)
        plain[[*b" \t\r\n,"]] = True
        key, state, out = None, None, []

        def say(part, data, opener=None):
            if part == "part" or not parts_only:
                out.append((*key, state["pos"], opener, part, data))
            state["pos"] += 1

        def stretch(raw: bytes):
            """One more stretch of the block; items that it ends are said, one that it leaves open is kept."""
            if not raw:
                return
            b = np.frombuffer(raw, np.uint8)
            parity, quotes, at, steps = _structure(b)
            keep = parity[at] == state["inside"]
            spots, steps = at[keep], steps[keep]
            depth = state["depth"] + np.cumsum(steps)
            colons = np.flatnonzero((steps == 0) & (depth == 1))
            turns, places = spots[colons], np.flatnonzero(quotes) if len(colons) else None
            called = [state["member"], *(_name(raw, places, int(c)) for c in turns)]

            def wanted(places):
                return np.array([n == member for n in called])[np.searchsorted(turns, places)]

            def events(step, level):
                found = spots[(steps == step) & (depth == level)]
                return found[wanted(found)]

            # What opens and closes an item, and where stretches of the list outside items begin and end.
            starts, ends = events(1, ITEM), events(-1, LIST)
            opens, closes = events(1, LIST), events(-1, LIST - 1)
            in_list = called[0] == member
            begun = [0] if in_list and state["depth"] == LIST else []
            finished = [len(b)] if called[-1] == member and len(depth) and depth[-1] == LIST else []
            if not len(depth) and begun:
                finished = [len(b)]
            gaps = zip(sorted([*begun, *(opens + 1), *(ends + 1)]), sorted([*starts, *closes, *finished]))
            if not parts_only:
                odd = np.concatenate([[0], np.cumsum(~plain[b])])
                for a, z in gaps:
                    if odd[z] > odd[a]:
                        say("junk", raw[a:z])
            if state["open"] is not None and len(ends):
                whole = b"".join([*state["open"], raw[: ends[0] + 1]])
                say("part" if state["carried"] else "item", whole, state["opener"] if state["carried"] else None)
                state["open"], state["carried"], ends = None, False, ends[1:]
            elif state["open"] is not None:
                state["open"].append(raw)
            if not parts_only:
                for a, z in zip(starts, ends):
                    say("item", raw[a : z + 1])
            if len(starts) > len(ends):
                state["open"] = [raw[starts[-1] :]]
            state["depth"] = int(depth[-1]) if len(depth) else state["depth"]
            state["inside"] ^= int(parity[-1])
            state["member"] = called[-1]

        def finish():
            """The end of a block: its last brace, if it is there, and the item left open."""
            if state["last"]:
                stretch(b"}")
            if state["open"] is not None:
                say("part", b"".join(state["open"]), state["opener"] if state["carried"] else key[1])

        def batch_of():
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
            out.clear()
            return made

        for batch in batches:
            for path, block, _, rows in _runs(batch):
                raw = _joined(batch.column("value").slice(rows[0], len(rows)))
                if (path, block) != key:
                    if key:
                        finish()
                    at = int(rows[0])
                    depth, inside, name, opener, closed = (batch.column(c)[at].as_py() for c in ("depth", "inside", "member", "opener", "closed"))
                    key, carried = (path, block), opener is not None
                    state = {"depth": depth, "inside": int(inside), "member": name, "opener": opener, "last": closed, "pos": 0}
                    state |= {"carried": carried, "open": [] if carried else None}
                else:
                    raw = b"}" + raw
                # The last brace waits: only the block's end tells whether the file has it.
                stretch(raw[:-1])
            if out:
                yield batch_of()
        if key:
            finish()
            if out:
                yield batch_of()

    return cut


def list_items(
    spark: SparkSession, source, found: list[str], member: str, limit: BroadcastLimit = BroadcastLimit()
) -> DataFrame:
    """(path, block, pos, json, whole): items of the list ``member`` of every document, and what else stands in it.

    ``whole`` is false for text that cannot be an item: other text in the list, and the end of a document that is cut off.
    The index is made here, with one read of the text; the result reads it twice more, once for the items inside blocks and
    once for those that cross them.
    """
    pieces = text_pieces(source, found)
    reports = pieces.mapInArrow(_reports, REPORT).repartition("path").sortWithinPartitions("path", "block")
    states = landed(reports.mapInArrow(_composer(member), STATE), "block-states")
    n = states.count()
    known = states.select("path", "block", "depth", "inside", "member", "opener", "closed")
    near = pieces.join(limit.hint(known, n, n * STATE_BYTES), ["path", "block"])
    if not limit.allows(n, n * STATE_BYTES):
        near = near.repartition("path", "block").sortWithinPartitions("path", "block", "pos")
    rows = near.select("path", "block", "size", "value", "depth", "inside", "member", "opener", "closed")
    made = rows.mapInArrow(_cutter(member, parts_only=False), CUT).filter("part <> 'part'")
    inside = made.select("path", "block", "pos", F.col("data").cast("string").alias("json"), (F.col("part") == "item").alias("whole"))
    parts = rows.mapInArrow(_cutter(member, parts_only=True), CUT)
    ordered = F.array_sort(F.collect_list(F.struct("block", F.col("data").cast("string").alias("text"))))
    across = parts.groupBy("path", "opener").agg(ordered.alias("texts"))
    across = across.select(
        "path", F.col("opener").alias("block"), F.lit(CROSSING).alias("pos"), F.array_join("texts.text", "").alias("json"), F.lit(True).alias("whole")
    )
    cut_off = states.filter(~F.col("ended")).select(
        "path", "block", F.lit(CROSSING + 1).alias("pos"), F.lit("the document does not end").alias("json"), F.lit(False).alias("whole")
    )
    return inside.unionByName(across).unionByName(cut_off)
