"""Secret scans over an incremental blob ledger, with Spark expressions only.

Every version of every path is addressed by the SHA-256 of its text. The ledger says which rules have read which blob;
a run reads only blobs that lack a rule, each once however many paths hold it, and its findings go back to all paths.

A null text is the empty blob, texts of any length are read whole, and rows that repeat give their result once each. Ledger
rows of unknown rules are ignored. An empty table gives an empty result and leaves the ledger as it is. Columns named
``blob`` or ``found`` are replaced by the operator's own; all others are carried along.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from placeweave.llm.store import store, text_of
from placeweave.session import scratch_path


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` count when ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def id(self) -> str:
        return f"{self.kind}@{self.version}"


# The three base kinds, in the order in which they are listed.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("forge", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + MORE
LEDGER = "blob binary, rules array<string>, found array<struct<start: bigint, end: bigint, rule: string>>"


def _pieces(text: Column, nr: int, rule: Rule) -> Column:
    """Lengths of the gap before each match and of the match, in order. The last piece is what follows."""
    every = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)).alias("key"),
    )
    return F.transform(
        every,
        lambda x, i: F.struct(
            F.lit(nr).alias("nr"),
            i.alias("i"),
            F.length(x["gap"]).cast("long").alias("gap"),
            F.length(x["hit"]).cast("long").alias("hit"),
            (F.length(x["key"]) >= rule.least).alias("ok"),
        ),
    )


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Ledger rows of ``blobs`` (blob, text, todo): the rules read and what they found. No shuffle beyond that by blob."""
    none = F.array().cast("array<struct<nr:int,i:int,gap:bigint,hit:bigint,ok:boolean>>")
    parts = [
        F.when(F.array_contains("todo", r.id) & F.col("text").rlike(r.pattern), _pieces(F.col("text"), nr, r)).otherwise(none)
        for nr, r in enumerate(rules)
    ]
    rows = blobs.select("blob", "todo", F.explode_outer(F.concat(*parts)).alias("p")).select("blob", "todo", "p.*")
    upto = Window.partitionBy("blob", "nr").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("hit")).over(upto)
    ids = F.array(*[F.lit(r.id) for r in rules])
    spans = rows.withColumn("end", end).withColumn(
        "span",
        F.when(
            F.col("ok"),
            F.struct((F.col("end") - F.col("hit")).alias("start"), "end", F.get(ids, F.col("nr")).alias("rule")),
        ),
    )
    return spans.groupBy("blob").agg(F.first("todo").alias("rules"), F.collect_list("span").alias("found"))


class Ledger:
    """A Parquet folder of (blob, rules, found); ``at`` None starts an empty one in the shared folder."""

    def __init__(self, spark: SparkSession, at: str | None = None):
        self.spark, self.at, self.empty = spark, at or scratch_path(spark, "ledger"), at is None

    def rows(self) -> DataFrame:
        if self.empty:
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(LEDGER).parquet(self.at)

    def add(self, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(self.at)
        self.empty = False

    def found(self, rules: tuple[Rule, ...]) -> DataFrame:
        """Blobs with findings of the given rules: one row each, spans by start, then rule order."""
        spans = self.rows().select("blob", F.explode("found").alias("x")).select("blob", "x.start", "x.end", "x.rule")
        order = F.create_map(*[F.lit(v) for nr, r in enumerate(rules) for v in (r.id, nr)])
        spans = spans.filter(F.col("rule").isin([r.id for r in rules])).withColumn("nr", F.element_at(order, F.col("rule")))
        span = F.struct("start", "nr", F.substring_index("rule", "@", 1).alias("kind"), "end", "rule")
        return spans.groupBy("blob").agg(F.sort_array(F.collect_set(span)).alias("found"))


def address(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def unseen(versions: DataFrame, ledger: Ledger, rules: tuple[Rule, ...], text: str = "text") -> DataFrame:
    """Blobs that some rule has not read: (blob, text, todo). One text a blob, picked before the shuffle where possible."""
    body = text_of(text)
    blobs = versions.select(address(body).alias("blob"), body.alias("text"))
    wanted = F.array(*[F.lit(r.id) for r in rules])
    if ledger.empty:
        todo = blobs.withColumn("todo", wanted)
    else:
        seen = store(ledger.rows().select("blob", F.explode("rules").alias("r")).groupBy("blob").agg(F.collect_set("r").alias("seen")), "seen")
        done = F.coalesce("seen", F.array().cast("array<string>"))
        todo = blobs.join(seen, "blob", "left").select("blob", "text", F.array_except(wanted, done).alias("todo"))
        todo = todo.filter(F.size("todo") > 0)
    return todo.groupBy("blob").agg(F.first("text").alias("text"), F.first("todo").alias("todo"))


def scan(versions: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``versions`` with ``blob`` and ``found`` (spans by start, then rule order); the ledger grows by what was read."""
    ledger.add(scan_blobs(unseen(versions, ledger, rules, text), rules))
    findings = store(ledger.found(rules), "findings")
    addressed = versions.drop("blob", "found").withColumn("blob", address(text_of(text)))
    none = F.array().cast(findings.schema["found"].dataType)
    return addressed.join(findings, "blob", "left").withColumn("found", F.coalesce("found", none))


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


#: Spans that are taken together: neither arrays nor texts grow with the number of spans.
SPANS_AT_ONCE = 128


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value made once, wherever and however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def redact(text: Column, spans: Column) -> Column:
    """``text`` with every span, or run of overlapping spans, replaced by one ``[KIND]`` mark."""

    def stops_of(groups: Column) -> Column:
        return F.transform(groups, lambda g: F.array_max(F.transform(g, lambda s: s["end"])))

    def before(stops: Column, g: Column) -> Column:
        return F.coalesce(F.array_max(F.slice(stops, F.lit(1), g)), F.lit(0).cast("long"))

    def marked(group: Column, begin: Column, piece: Column) -> Column:
        state = F.struct(begin.alias("at"), F.array().cast("array<string>").alias("out"))

        def step(s: Column, x: Column) -> Column:
            gap = F.substring(piece, (s["at"] - begin + 1).cast("int"), (x["start"] - s["at"]).cast("int"))
            mark = F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]"))
            return F.when(x["start"] < s["at"], F.struct(F.greatest(s["at"], x["end"]).alias("at"), s["out"].alias("out"))).otherwise(
                F.struct(x["end"].alias("at"), F.concat(s["out"], F.array(gap, mark)).alias("out"))
            )

        return F.array_join(F.aggregate(group, state, step, lambda s: s["out"]), "")

    def told(group: Column, begin: Column, stop: Column) -> Column:
        """The text from where the last group ended up to the end of this one."""
        cut = F.substring(text, (begin + 1).cast("int"), F.greatest(stop - begin, F.lit(0)).cast("int"))
        return _bound(cut, lambda piece: marked(group, begin, piece))

    def all_of(groups: Column, stops: Column) -> Column:
        done = F.transform(groups, lambda group, g: _bound(before(stops, g), lambda begin: told(group, begin, F.get(stops, g))))
        rest = F.substring(text, (F.array_max(stops) + 1).cast("int"), F.length(text))
        return F.concat(F.array_join(done, ""), rest)

    places = F.sequence(F.lit(0), F.floor((F.size(spans) - 1) / SPANS_AT_ONCE).cast("int"))
    groups = F.transform(places, lambda g: F.slice(spans, g * SPANS_AT_ONCE + 1, F.lit(SPANS_AT_ONCE)))
    done = _bound(groups, lambda groups: _bound(stops_of(groups), lambda stops: all_of(groups, stops)))
    return F.when(F.size(spans) == 0, text).otherwise(done)
