"""The corpus pipeline: quality, near copies, benchmark leaks, secrets, tokens. Each stage reads what the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``, with
whatever further columns ``docs`` has. Columns that a stage adds for its own work never clash with those, and everything
else is carried along untouched. Null texts read as empty, texts of any length are read whole, rows that repeat are judged
alike (near copies among them go), and an empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from placeweave.llm import bpe, jaccard, leaks, ledger, quality, queries
from placeweave.llm.store import store, table, text_of


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; the model is fitted on labelled documents of this input."""
    model = quality.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return docs.filter(quality.scorer(docs, model)(docs["text"]) >= queries.QUALITY_LEAST)


#: Near copies of a corpus: 80 of 100 shingles of five words. The query op9 keeps its own, tighter threshold.
NEAR = jaccard.Settings(percent=80, words=5)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the least id, and of rows that share it the first one of the table.

    Rows are told apart by their number in ``docs``, so rows that share an id are judged each by its own text, and rows
    without an id, which come after all others, are deduplicated too. ``docs`` must read the same each time: files or a
    stored table. An empty table stays empty; texts without words are never near copies.
    """
    row = "row_number"
    while row in docs.columns:
        row += "_"
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    texts = numbered.select(F.col(row).alias("row"), "doc_id", "text")
    found = jaccard.near_components(texts.select("row", "text"), NEAR, doc_id="row").filter("id <> component")
    found = store(found.select("id", "component"), "copies")
    members = found.unionByName(found.select(F.col("component").alias("id"), "component").distinct())
    order = F.struct(F.isnull("doc_id").alias("last"), "doc_id", F.col("row").alias("kept"))
    named = store(members.join(texts.select("row", "doc_id"), F.col("id") == F.col("row")), "members")
    best = store(named.groupBy("component").agg(F.min(order)["kept"].alias("kept")), "kept")
    dropped = store(named.join(best, "component").filter("id <> kept").select(F.col("id").alias(row)), "dropped")
    return numbered.join(dropped, row, "left_anti").select(*[numbered[c] for c in docs.columns])


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return leaks.without_leaks(docs, queries.leak_index(spark, sf_dir)[1])


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark; ``n_chars`` follows the text where it changed."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), docs["text"].alias("text"))
    found = ledger.scan(rows, ledger.Ledger(spark))
    marked = F.when(F.size("found") > 0, ledger.redact(text_of("text"), F.col("found")))
    done = found.select("doc", marked.alias("marked"))
    new = {"text": F.coalesce("marked", "doc.text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.coalesce(F.length("marked").cast(kind), "doc.n_chars")
    return done.select(*[new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids, decoded_sha256): token ids, and a digest of what they decode to."""
    rules = queries.codec()
    coded = bpe.decode_ids(bpe.encode_texts(docs.select("doc_id", "lang", "source", "text"), rules), rules)
    n = F.size("ids").cast("long").alias("n_tokens")
    return coded.select("doc_id", "lang", "source", n, "ids", F.sha2("data", 256).alias("decoded_sha256"))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("tokens", token_stage),
]

#: Nearest neighbours in a fitted space have no SQL form; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
