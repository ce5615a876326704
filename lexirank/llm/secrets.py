"""Secret scans over an incremental ledger of blobs, in DataFrame operations alone."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .storage import materialize, new_path


@dataclass(frozen=True)
class Rule:
    """A kind of secret. Matches are leftmost and don't overlap; one whose `group` has under `least` characters is dropped.

    hint: a text without a match of it can have no match of the pattern.
    """

    kind: str
    pattern: str
    hint: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


#: A run that is too short for access or hex holds no other match, so its length can stand in the pattern.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}", r"AKIA"),
    Rule("hex", r"[0-9a-f]{24,}", r"[0-9a-f]{24}"),
)
MORE_RULES = (
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", r"eyJ"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", r"-----BEGIN"),
    Rule("forge", r"gh[opsu]_[A-Za-z0-9]{36,}", r"gh[opsu]_"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", r"xox[abprs]-"),
)
RULES = BASE_RULES + MORE_RULES

_RAW = "array<struct<rule:string,i:int,gap:int,len:int,kept:boolean>>"


def blob_id(content: Column) -> Column:
    """The address of a content: SHA-256 of its UTF-8."""
    return F.sha2(content, 256)


def _matches(text: Column, rule: Rule) -> Column:
    """Each match's length and that of what stands between it and the one before."""
    pattern = F.lit(rule.pattern)
    found = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("found"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("part"),
    )
    rows = F.transform(
        found,
        lambda x, i: F.struct(
            F.lit(rule.name).alias("rule"), i.alias("i"), F.length(x["gaps"]).alias("gap"), F.length(x["found"]).alias("len"), (F.length(x["part"]) >= rule.least).alias("kept")
        ),
    )
    return F.when(text.rlike(rule.hint), F.filter(rows, lambda x: x["len"].isNotNull())).otherwise(F.lit(None).cast(_RAW))


class BlobLedger:
    """What has been scanned, by blob and rule version, and what was found: two tables that grow by appending.

    scans: a row for each blob of each run, with the rule versions that it was scanned by then.
    findings: blob, rule, kind, start, end (code points, end exclusive).
    Findings are written before scans: a run that is lost in between is done again and its rows, being equal, count once.
    """

    def __init__(self, spark, path: str | None = None) -> None:
        self.spark, self.path = spark, path or new_path(spark, "secret-ledger")

    def _table(self, name: str, schema: str) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def scans(self) -> DataFrame:
        return self._table("scans", "blob string, rules array<string>")

    def findings(self) -> DataFrame:
        return self._table("findings", "blob string, rule string, kind string, start long, end long").distinct()

    def scan(self, contents: DataFrame, content_col: str = "content", rules: tuple[Rule, ...] = RULES) -> None:
        """Scan the blobs of a table of versions by the rule versions that have not yet been run on them.

        A null content is the empty text. Equal contents are one blob, whatever rows, paths or versions have them.
        """
        text = F.coalesce(contents[content_col].cast("string"), F.lit(""))
        blobs = contents.select(blob_id(text).alias("blob"), text.alias("content")).dropDuplicates(["blob"])
        wanted = F.array(*[F.lit(r.name) for r in rules])
        seen = self.scans()
        if seen.isEmpty():
            todo = blobs.withColumn("rules", wanted)
        else:
            done = seen.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_set("rules"))).alias("done"))
            left = F.array_except(wanted, F.coalesce("done", F.array().cast("array<string>")))
            todo = blobs.join(done, "blob", "left").withColumn("rules", left).filter(F.size("rules") > 0)
        nothing = F.array().cast(_RAW)
        raw = [F.coalesce(F.when(F.array_contains("rules", r.name), _matches(F.col("content"), r)), nothing) for r in rules]
        scanned = materialize(todo.select("blob", "rules", F.concat(*raw).alias("raw")), "scanned")
        upto = Window.partitionBy("blob", "rule").orderBy("i")
        end = F.sum(F.col("gap") + F.col("len")).over(upto)
        found = scanned.select("blob", F.explode("raw").alias("m")).select("blob", "m.*").withColumn("end", end).filter("kept")
        found = found.select("blob", "rule", F.substring_index("rule", "@", 1).alias("kind"), (F.col("end") - F.col("len")).alias("start"), "end")
        found.write.mode("append").parquet(f"{self.path}/findings")
        scanned.select("blob", "rules").write.mode("append").parquet(f"{self.path}/scans")


SPANS = "array<struct<start:bigint,rank:int,end:bigint,kind:string>>"


def secret_spans(
    docs: DataFrame, text_col: str = "text", ledger: BlobLedger | None = None, rules: tuple[Rule, ...] = RULES, keep: list[str] | None = None
) -> DataFrame:
    """doc (a struct of the row, or of the columns to keep) and its secrets: spans, sorted by start, then by the order of the rules.

    Every row that has a scanned blob gets its findings: copies are scanned once. The findings, a row for each blob, are
    a written table, so that AQE can split the rows of a blob that very many have. Null and empty texts, and texts
    without a secret, have an empty array; rows that repeat are answered each; an empty table gives none.
    """
    ledger = ledger or BlobLedger(docs.sparkSession)
    ledger.scan(docs, text_col, rules)
    rank = F.element_at(F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.name), F.lit(i))]), F.col("rule"))
    wanted = ledger.findings().filter(F.col("rule").isin([r.name for r in rules]))
    by_blob = materialize(wanted.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "end", "kind"))).alias("spans")), "by-blob")
    rows = docs.select(F.struct(*[docs[c] for c in keep or docs.columns]).alias("doc"), blob_id(F.coalesce(docs[text_col].cast("string"), F.lit(""))).alias("blob"))
    return rows.join(by_blob.hint("merge"), "blob", "left").select("doc", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "<secret>") -> Column:
    """The text with a mark in place of each run of overlapping spans."""
    cut = lambda a, b: F.substring(text, (a + 1).cast("int"), (b - a).cast("int"))
    state = F.struct(F.lit("").alias("kept"), F.lit(0).cast("long").alias("at"))
    rest = F.aggregate(
        spans,
        state,
        lambda s, x: F.struct(
            F.when((x["start"] < s["at"]), s["kept"]).otherwise(F.concat(s["kept"], cut(s["at"], x["start"]), F.lit(mark))).alias("kept"),
            F.greatest(s["at"], x["end"]).alias("at"),
        ),
    )
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(rest["kept"], F.substring(text, (rest["at"] + 1).cast("int"), F.length(text))))
