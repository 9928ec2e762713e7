"""Quality by nearest-neighbour voting in a latent space.

A text becomes counts of byte-class pairs, weighted like terms, and pseudo-terms for its shape (repeated words, marks,
capitals). A truncated singular value decomposition of a bounded labelled sample gives the latent axes. The sample's
vectors are broadcast; every text is held against all of them in blocks of exact cosines, and its nearest neighbours
vote with weights that grow with similarity.

The model is bounded by ``Settings``: at most ``per_class`` labelled ids of either label, one text each (of several, the
least). Null and wordless texts score 0. Without labelled rows every score is 0.5. Repeated rows score alike; texts of any
length are read whole; of neighbours that tie for the last place any may vote. An empty table gives an empty result. Other
columns are carried along, one named like the score is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from placeweave.llm.store import Shared, release

# Byte classes: letters, then kinds of marks, then bytes of longer characters.
MARKS = b"\n .,;:!?|#$%&*-_'\"/()"
CLASSES = 64
STEPS = 10


@dataclass(frozen=True)
class Settings:
    per_class: int = 1000
    axes: int = 48
    neighbours: int = 15
    power: int = 8
    shape_weight: float = 2.0
    block: int = 256


def byte_classes():
    import numpy as np

    table = np.zeros(256, np.int64)
    for b in range(256):
        if 97 <= b <= 122:
            table[b] = b - 97
        elif 65 <= b <= 90:
            table[b] = 26
        elif 48 <= b <= 57:
            table[b] = 27
        elif b in MARKS:
            table[b] = 28 + MARKS.index(b)
        elif b < 128:
            table[b] = 28 + len(MARKS)
        else:
            table[b] = 29 + len(MARKS) + b % (CLASSES - 29 - len(MARKS))
    return table


def shape(text: str, data, words: list[str]) -> list[float]:
    """Shares in 0..1: equal neighbours, distinct words, capitals, marks, marks that stand alone, word length."""
    import operator

    n, size = len(words), max(1, len(data))
    same = sum(map(operator.eq, words, words[1:])) / max(1, n - 1)
    upper = ((data >= 65) & (data <= 90)).sum()
    lower = ((data >= 97) & (data <= 122)).sum()
    marks = ((data > 32) & (data < 128)).sum() - upper - lower
    alone = sum(not w[0].isalnum() and len(w) == 1 for w in set(words) if w) and sum(len(w) == 1 and not w.isalnum() for w in words)
    return [
        same,
        len(set(words)) / max(1.0, n**0.8),
        upper / max(1, upper + lower),
        min(1.0, 4 * marks / size),
        alone / max(1, n),
        min(1.0, len(text) / max(1, n) / 20),
    ]


SHAPES = 6
WIDTH = CLASSES * CLASSES + SHAPES * STEPS


def features(texts):
    """Rows of raw features for a list of texts, and which texts have words."""
    import numpy as np

    table, centres = byte_classes(), np.linspace(0, 1, STEPS)
    out, has = np.zeros((len(texts), WIDTH), np.float32), np.zeros(len(texts), bool)
    for row, text in enumerate(texts):
        words = text.split()
        if not words:
            continue
        has[row] = True
        data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        kinds = table[data]
        out[row, : CLASSES * CLASSES] = np.bincount(kinds[:-1] * CLASSES + kinds[1:], minlength=CLASSES * CLASSES)
        near = 1 - np.abs(np.array(shape(text, data, words))[:, None] - centres) * (STEPS - 1)
        out[row, CLASSES * CLASSES :] = np.clip(near, 0, None).ravel()
    return out, has


@dataclass
class Model:
    """What is broadcast: term weights, axes, and the labelled vectors with their labels."""

    weights: object
    axes: object
    vectors: object
    labels: object
    settings: Settings

    def project(self, raw):
        import numpy as np

        pairs = np.log1p(raw[:, : CLASSES * CLASSES])
        pairs *= self.weights
        pairs /= np.maximum(np.linalg.norm(pairs, axis=1, keepdims=True), 1e-9)
        forms = raw[:, CLASSES * CLASSES :] * np.float32(self.settings.shape_weight / SHAPES**0.5)
        latent = np.hstack([pairs, forms]) @ self.axes if self.axes is not None else np.hstack([pairs, forms])
        return latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)

    def score(self, texts: list[str]):
        import numpy as np

        if not len(self.labels):
            return np.full(len(texts), 0.5)
        out = []
        for at in range(0, len(texts), self.settings.block):
            raw, has = features(texts[at : at + self.settings.block])
            near = self.project(raw) @ self.vectors.T
            k = min(self.settings.neighbours, near.shape[1])
            best = np.argpartition(near, -k, axis=1)[:, -k:]
            vote = np.clip(np.take_along_axis(near, best, 1), 1e-6, 1).astype(float) ** self.settings.power
            out.append(np.where(has, (vote * self.labels[best]).sum(1) / vote.sum(1), 0.0))
        return np.clip(np.concatenate(out), 0, 1) if out else np.zeros(0)


def fit_rows(raw, labels, settings: Settings = Settings()) -> Model:
    """Term weights, axes and vectors from a bounded matrix of raw features."""
    import numpy as np

    raw, labels = np.asarray(raw, np.float32).reshape(-1, WIDTH), np.asarray(labels, float)
    seen = (raw[:, : CLASSES * CLASSES] > 0).sum(0)
    weights = np.log((1 + len(raw)) / (1 + seen)).astype(np.float32) + np.float32(0.1)
    plain = Model(weights, None, None, labels, settings)
    if not len(raw):
        return plain
    rows = plain.project(raw)
    # Subspace iteration: the leading right singular vectors of the sample.
    axes = np.linalg.qr(np.random.default_rng(7).standard_normal((WIDTH, settings.axes + 8)).astype(np.float32))[0]
    for _ in range(6):
        axes = np.linalg.qr(rows.T @ (rows @ axes))[0]
    turn = np.linalg.svd(rows @ axes, full_matrices=False)[2].T
    del rows
    model = Model(weights, (axes @ turn)[:, : settings.axes].astype(np.float32), None, labels, settings)
    model.vectors = model.project(raw).astype(np.float32)
    return model


def labelled_sample(docs: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """(text, quality) of the rows that come first by hash, at most ``per_class`` of either label, outside the held-out fold."""
    usable = labels.select("doc_id", "quality").filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    usable = usable.filter(~held_out(F.col("doc_id"))).distinct()
    first = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = [usable.filter(F.col("quality") == q).orderBy(*first).limit(settings.per_class) for q in (0, 1)]
    chosen = F.broadcast(picked[0].unionByName(picked[1]))
    # One text for each labelled id, however often the id stands in the table.
    found = docs.select("doc_id", "text").join(chosen, "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    return found.select("text", "quality")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Features are made where the texts are; the driver gets one row of numbers for each text of the bounded sample."""
    import numpy as np

    def rows(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for at in range(0, len(texts), 256):
                raw, has = features(texts[at : at + 256])
                raw = raw[has].astype(np.float32)
                y = batch.column("quality").to_numpy(zero_copy_only=False)[at : at + 256][has]
                data = pa.array([r.tobytes() for r in raw], pa.binary())
                yield pa.RecordBatch.from_arrays([data, pa.array(y, pa.int32())], names=["raw", "quality"])

    from hashlib import blake2b

    got = labelled_sample(docs, labels, settings).mapInArrow(rows, "raw binary, quality int").toArrow()
    y = got.column("quality").to_numpy()
    raw = np.empty((len(y), WIDTH), np.float32)
    names, row = [], None
    for i, row in enumerate(got.column("raw")):
        raw[i] = np.frombuffer(row.as_buffer(), np.float32)
        names.append((blake2b(raw[i]).digest(), y[i]))
    del got
    # Row order depends on the plan; sorting by content makes the model the same each time.
    order = sorted(range(len(raw)), key=names.__getitem__)
    raw, y = raw[order], y[order]
    model = fit_rows(raw, y, settings)
    del raw, row
    release()
    return model


def scorer(docs: DataFrame, model: Model):
    """``text -> double`` for a text column."""
    shared = Shared(docs.sparkSession, model)

    @F.arrow_udf("double")
    def score(texts):
        import pyarrow as pa

        model, step, out = shared.value, shared.value.settings.block, []
        for at in range(0, len(texts), step):
            out += model.score([t or "" for t in texts[at : at + step].to_pylist()]).tolist()
        return pa.array(out, pa.float64())

    return score


def score_texts(docs: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    return docs.withColumn(score, scorer(docs, model)(docs[text]))
