"""Byte-level BPE through a sentencepiece model that is written straight from a rank vocabulary.

Every byte is mapped to a visible character, every token becomes a piece whose score is the negative of its rank, and
normalisation is the identity, so the best-scored merge is always the one of the lowest rank. Texts are cut by a pattern
first and each pre-token is encoded alone; decoding looks the bytes of each id up.

Results for edge cases: a null or empty text has no ids; texts of any length are encoded whole; rows that repeat are encoded
each; every other column stays, one that has the name of the new column is replaced; an empty table gives an empty one.
Null ids decode to null, an id outside the vocabulary stops the job.
"""

from __future__ import annotations

import base64
import gc
import struct
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import accumulate, chain

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from placeweave.llm.store import Kept, Shared

# Pre-tokens whose ids a task remembers between blocks, the bytes of a block, and words hashed at once.
# They set speed and memory only.
CACHE_ENTRIES = 75_000
BLOCK_BYTES = 400_000
WORDS_AT_ONCE = 50_000
#: Ids are kept as packed integers of this size.
ID_BYTES = 4
#: Bytes of a word that are hashed by table; longer words are digested one by one.
SHORT = 64

# Letters and digits of later Unicode versions than 16, which the rank files' own splitter does not know.
LATER_THAN_UNICODE_16 = """
0558 058b-058c 088f 0c5c 0cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf 10940-10959
10ec5-10ec7 10ed9-10eee 11b0a 11db0-11ddb 11de0-11de9 11df1 1246f 12475-1247f 12550-12686 16ea0-16eb8 16ebb-16ed3
16ff2-16ff6 187f8-187ff 18cd6-18cda 18d09-18d20 18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128 1b168 1d6a6
1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4
1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead 323b0-33479 3d000-3fc3f
"""


def splitter(pattern: str):
    """``text -> pre-tokens``. Characters of later Unicode versions count as neither letter nor digit."""
    import regex

    find = regex.compile(pattern)
    ranges = [[chr(int(end, 16)) for end in part.split("-")] for part in LATER_THAN_UNICODE_16.split()]
    later = regex.compile("[" + "".join("-".join(ends) for ends in ranges) + "]")

    def split(text: str) -> list[str]:
        if text.isascii() or not later.search(text):
            return find.findall(text)
        return [text[slice(*m.span())] for m in find.finditer(later.sub("\ue000", text))]

    return split


def byte_letters() -> list[str]:
    """A visible character for each byte: printable Latin-1 bytes stand for themselves, the rest follow U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [letters[b] for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank from a file of ``base64 rank`` lines; ranks must run from 0 without gaps."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = dict((int(rank), base64.b64decode(token)) for token, rank in pairs)
    if sorted(tokens) != list(range(len(tokens))):
        raise ValueError("ranks must run from 0 without gaps")
    missing = {bytes([b]) for b in range(256)} - set(tokens.values())
    if missing:
        raise ValueError(f"vocabulary lacks {len(missing)} single bytes")
    return [tokens[rank] for rank in range(len(tokens))]


def _varint(n: int) -> bytes:
    out = b""
    while n > 0x7F:
        out, n = out + bytes([n & 0x7F | 0x80]), n >> 7
    return out + bytes([n])


def _field(number: int, value: bytes | int | float) -> bytes:
    """One protocol-buffer field: a varint, a 32-bit float, or bytes with their length."""
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def serialise(tokens: list[bytes]) -> bytes:
    """The sentencepiece model: piece ``i`` is token ``i`` with score ``-i``; one more piece is the unknown one.

    Field numbers are those of the public model format: piece (text 1, score 2, type 3), trainer (model type 3,
    vocabulary size 4, ids 40 to 43), normaliser (name 1, three switches 3 to 5).
    """
    letters = byte_letters()
    normal, unknown, bpe, none = 1, 2, 2, (1 << 64) - 1
    pieces = [(("".join(letters[b] for b in token)).encode(), -float(rank), normal) for rank, token in enumerate(tokens)]
    pieces.append((b"<unk>", -float(len(tokens)), unknown))
    model = b"".join(_field(1, _field(1, text) + _field(2, score) + _field(3, kind)) for text, score, kind in pieces)
    ids = _field(40, len(tokens)) + b"".join(_field(n, none) for n in (41, 42, 43))
    trainer = _field(3, bpe) + _field(4, len(pieces)) + ids
    normaliser = _field(1, b"identity") + b"".join(_field(n, 0) for n in (3, 4, 5))
    return model + _field(2, trainer) + _field(3, normaliser)


@dataclass
class Codec:
    """Encodes and decodes in one process; the sentencepiece processor is opened on first use."""

    tokens: list[bytes]
    model: bytes
    pattern: str
    known: dict = field(default_factory=dict)
    spelled: dict = field(default_factory=dict)
    tools: tuple = ()
    last: tuple = ()

    def _tools(self):
        if not self.tools:
            self.tools = self._opened()
        return self.tools

    def _opened(self):
        import sentencepiece

        letters = byte_letters()
        processor = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        whole = {"".join(letters[b] for b in token): rank for rank, token in enumerate(self.tokens)}
        return splitter(self.pattern), processor, whole, {b: letters[b] for b in range(256)}

    def __getstate__(self):
        return self.tokens, self.model, self.pattern

    def __setstate__(self, state):
        self.tokens, self.model, self.pattern = state
        self.known, self.spelled, self.tools, self.last = {}, {}, (), ()

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of pre-tokens, as packed integers: a pre-token that is itself a token is that token, the rest are merged."""
        _, processor, whole, letters = self._tools()
        # All pieces are mapped in one go, parted by a zero byte, unless one of them holds such a byte.
        mapped = "\0".join(pieces).encode("utf-8", "replace").decode("latin-1").translate({**letters, 0: "\n"}).split("\n")
        if len(mapped) != len(pieces):
            mapped = [p.encode("utf-8", "replace").decode("latin-1").translate(letters) for p in pieces]
        ranks = list(map(whole.get, mapped))
        open_ = [m for m, rank in zip(mapped, ranks, strict=True) if rank is None]
        merged = iter(processor.encode(open_, out_type=int, num_threads=1) if open_ else ())
        every = [next(merged) if rank is None else (rank,) for rank in ranks]
        packed = array("i", chain.from_iterable(every)).tobytes()
        ends = list(accumulate(map(len, every), initial=0))
        return {p: packed[ID_BYTES * a : ID_BYTES * b] for p, a, b in zip(pieces, ends, ends[1:])}

    def encode_many(self, texts: Iterable[str]) -> Iterator:
        """Ids of each text as an array."""
        import numpy as np

        block = [text.encode("utf-8", "replace") for text in texts]
        data = np.frombuffer(b"".join(block), np.uint8)
        yield from self.encode_bytes(data, np.cumsum([0, *map(len, block)]))

    def encode_bytes(self, data, bounds) -> Iterator:
        """Ids of each text of joined UTF-8 texts. They go through in blocks, so new words reach the processor together."""
        import numpy as np

        collects = gc.isenabled()
        # Nothing made here refers to itself, and the collector would walk all remembered words again and again.
        gc.disable()
        try:
            low = 0
            while low < len(bounds) - 1:
                high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + BLOCK_BYTES, "right")) - 1)
                yield from self._encode_block(data[bounds[low] : bounds[high]], bounds[low + 1 : high + 1] - bounds[low])
                low = high
        finally:
            if collects:
                gc.enable()

    def _encode_block(self, data, ends) -> Iterator:
        """Words of a block are told apart by length and a 64-bit hash; only those not seen before are split and merged."""
        import numpy as np

        starts = word_starts(data, ends)
        stops = np.append(starts[1:], len(data))
        names, first, back = np.unique(word_names(data, starts, stops), return_index=True, return_inverse=True)
        ids = self._remember(names.tolist(), starts[first], stops[first], data)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // ID_BYTES
        flat = np.frombuffer(b"".join(ids), np.int32)
        out = spread(flat, np.cumsum(sizes) - sizes, sizes, back)
        after = np.append(0, np.cumsum(sizes[back]))
        bounds = after[np.searchsorted(starts, np.append(0, ends))]
        for a, b in zip(bounds, bounds[1:], strict=False):
            yield out[a:b]

    def _remember(self, names: list[int], starts, stops, data) -> list[bytes]:
        """Ids of the words of these names; words are read from ``data`` as text only where they are new."""
        import numpy as np

        if len(self.known) + len(names) > CACHE_ENTRIES:
            self.known = {name: self.known[name] for name in names if name in self.known}
            self.spelled = {name: self.spelled[name] for name in self.known}
        known, spelled = self.known, self.spelled
        found = list(map(known.get, names))
        seen = [i for i, ids in enumerate(found) if ids is not None]
        # Words are kept beside their ids, as an equal name alone is no proof. All bytes are compared at once.
        if seen:
            told = [spelled[names[i]] for i in seen]
            if spread(data, starts, stops - starts, np.array(seen)).tobytes() != "".join(told).encode():
                for i, word in zip(seen, told, strict=True):
                    if word.encode() != data[starts[i] : stops[i]].tobytes():
                        found[i] = None
        new, view = [i for i, ids in enumerate(found) if ids is None], data.data
        words = [str(view[a:b], "utf-8") for a, b in zip(starts[new].tolist(), stops[new].tolist(), strict=True)]
        split = self._tools()[0]
        # Letters alone, or after one space, are a pre-token wherever the pattern takes them so.
        plain = split(" ab") == [" ab"] and split("ab") == ["ab"]
        parts = {w: split(w) for w in words if not (plain and (w.isalpha() or w[0] == " " and w[1:].isalpha()))}
        pieces = set(chain.from_iterable(parts.values()))
        pieces.update(w for w in words if w not in parts)
        ids = self._learn(list(pieces))
        for word, several in parts.items():
            if len(several) != 1:
                ids[word] = b"".join(map(ids.__getitem__, several))
        for i, word in zip(new, words, strict=True):
            found[i] = known[names[i]] = ids[word]
            spelled[names[i]] = word
        return found

    def encode(self, text: str) -> list[int]:
        return next(self.encode_many([text])).tolist()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def spread(flat, begins, sizes, rows):
    """The runs ``flat[begins[r] : begins[r] + sizes[r]]`` of all rows, joined."""
    import numpy as np

    each = sizes[rows]
    after = np.cumsum(each)
    return flat[np.repeat(begins[rows] - after + each, each) + np.arange(after[-1] if len(after) else 0)]


def word_starts(data, ends):
    """Where words of joined texts start: places where every pattern of this family starts a pre-token.

    That is before a space between two characters that are no white space, and before an ASCII mark after an ASCII letter
    or digit: pre-tokens hold white space at their front only, and marks never follow letters in one. Bytes that may belong
    to other white space start nothing, which only makes words longer. Texts start at their own first byte.
    """
    import numpy as np

    kind = np.zeros(256, np.uint8)
    kind[[*range(0x09, 0x0E), 0x20]] = 1
    kind[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = 2
    kind[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = 3
    kind[[0xC2, 0xE1, 0xE2, 0xE3]] = 4  # first bytes of other white space
    kind[[0x80, 0x81, 0x9A]] = 5  # and second ones
    k = kind[data]
    n = len(data)
    start = np.zeros(n + 1, bool)
    if n > 2:
        before, here, after = k[:-2], k[1:-1], k[2:]
        doubtful = np.zeros(n - 2, bool)
        doubtful[1:] = (data[1:-2] >= 0x80) & ((k[:-3] == 4) | (k[:-3] == 5))
        start[1 : n - 1] = (data[1:-1] == 0x20) & (before != 1) & ~doubtful & (after != 1) & (after != 4)
        start[1 : n - 1] |= (here == 3) & (before == 2)
    start[0] = True
    start[ends] = True
    return np.flatnonzero(start[:n])


def word_names(data, starts, stops):
    """A 64-bit hash of each word: independent random numbers for its bytes by place, added up; long words are digested."""
    from hashlib import blake2b

    import numpy as np

    random, out = _hash_table(), np.empty(len(starts), np.uint64)
    for low in range(0, len(starts), WORDS_AT_ONCE):
        a, b = starts[low : low + WORDS_AT_ONCE], stops[low : low + WORDS_AT_ONCE]
        sizes, first = b - a, a[0]
        place = np.arange(b[-1] - first, dtype=np.int32)
        place -= np.repeat((a - first).astype(np.int32), sizes)
        np.minimum(place, SHORT - 1, out=place)
        place <<= 8
        place += data[first : b[-1]]
        x = np.add.reduceat(random.take(place), a - first) + sizes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for i in np.flatnonzero(sizes > SHORT).tolist():
            x[i] = int.from_bytes(blake2b(data[a[i] : b[i]], digest_size=8).digest(), "little")
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
        out[low : low + len(a)] = x ^ (x >> np.uint64(29))
    return out


_MADE: dict = {}


def _hash_table():
    import numpy as np

    if not _MADE:
        _MADE["random"] = np.random.default_rng(50257).integers(0, 2**64, SHORT * 256, np.uint64)
    return _MADE["random"]


def load(path: str, pattern: str) -> Codec:
    tokens = read_ranks(path)
    return Codec(tokens, serialise(tokens), pattern)


def encoder(spark: SparkSession, codec: Codec):
    """``text -> array<int>`` for a text column; null counts as empty. The broadcast is the vocabulary file's size.

    Where ids are both put out and decoded, Spark calls this twice for each batch in one worker, so a worker has one codec and
    the codec remembers its last batch.
    """
    shared = Kept(spark, codec)

    @F.arrow_udf("array<int>")
    def encode(texts):
        import numpy as np
        import pyarrow as pa

        texts = texts.fill_null("")
        if not len(texts):
            return pa.array([], pa.list_(pa.int32()))
        opened = shared.value
        if opened.last and opened.last[0].equals(texts):
            return opened.last[1]
        opened.last = ()
        bounds = np.frombuffer(texts.buffers()[1], np.int64 if pa.types.is_large_string(texts.type) else np.int32)
        bounds = bounds[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        rows = list(opened.encode_bytes(data, bounds))
        ends = np.cumsum([0, *map(len, rows)])
        values = np.concatenate(rows) if rows else np.zeros(0, np.int32)
        opened.last = texts, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))
        return opened.last[1]

    return encode


def decoder(spark: SparkSession, codec: Codec):
    """``array<int> -> binary``; null ids give null, an id outside the vocabulary stops the job."""
    shared = Shared(spark, codec.tokens)

    @F.arrow_udf("binary")
    def decode(column):
        import numpy as np
        import pyarrow as pa

        tokens = shared.value
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        flat, begins = np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(sizes) - sizes
        values, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_pylist()
        if len(values) and values.min() < 0:
            raise ValueError("ids must not be negative")
        out = []
        for start, end, valid in zip(ends, ends[1:], column.is_valid().to_pylist(), strict=False):
            out.append(spread(flat, begins, sizes, values[start:end]).tobytes() if valid else None)
        return pa.array(out, pa.binary())

    return decode


def encode_texts(df: DataFrame, codec: Codec, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with a column of token ids; every other column stays, one named ``ids`` is replaced."""
    return df.withColumn(ids, encoder(df.sparkSession, codec)(F.coalesce(df[text], F.lit(""))))


def decode_ids(df: DataFrame, codec: Codec, ids: str = "ids", data: str = "data") -> DataFrame:
    """``df`` with the bytes that the ids stand for."""
    return df.withColumn(data, decoder(df.sparkSession, codec)(df[ids]))


def ids_digest(ids: Column) -> Column:
    """Hex SHA-256 of the decimal ids joined by commas."""
    return F.sha2(F.array_join(ids.cast("array<string>"), ","), 256)
