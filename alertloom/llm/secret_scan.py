"""Secret scans with an incremental blob ledger.

A text is a blob, addressed by its SHA-256; a document is a path that points to one. Only pairs of a blob and a rule
version which the ledger doesn't have are scanned; their findings and then the scanned pairs are appended to it, and the
findings of all blobs are joined back to every path. The positions of the matches come from the lengths of matches and of
the gaps between them, summed up along the text, so that a text with very many matches costs no more than its length.

Defined cases: null text counts as empty and has no findings. Repeated rows and copies share a blob. Should a job
be lost between the two appends, the pairs are scanned again and the repeated findings count once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window, functions as F

from alertloom.llm.shared import new_path, salted_join, stored, text_of


@dataclass(frozen=True)
class Rule:
    """``kind`` matches ``pattern``; a match holds if its ``group`` has ``least`` characters or more. A rule whose
    pattern changes gets a new ``version``: only this pair is scanned anew."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1


# A private key with its body. With an END line after it, before any other five dashes: all up to there, whatever quotes, marks or
# headers stand between. Without one: what follows on its line up to 40 Base64 characters in a row, and the Base64 lines under it,
# which may be indented, quoted or commented; of a last line with other words its 40 or more Base64 characters. Groups are
# repeated a bounded number of times, as Java repeats them on its stack; plain lines go on without bound. No syntax that RE2 lacks.
KEY_HEAD = r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"
KEY_TO_END = r"[^-]*(?:--?-?-?[^-]+){0,400}-*-----END [A-Z ]{0,40}PRIVATE KEY-----"
KEY_RUN = r"[A-Za-z0-9+/=\\]{40}[A-Za-z0-9+/=\\]*"
KEY_ON_LINE = rf"[A-Za-z0-9+/=\\\x20\t]*{KEY_RUN}(?:[\x20\t]+[A-Za-z0-9+/]+={{1,2}})?"
KEY_MARKS, KEY_AFTER = r"""[\x20\t>|#*"'-]*""", r"""[\x20\t"',;.]*"""
KEY_LINES = (
    rf"{KEY_AFTER}[\r\n]+(?:{KEY_MARKS}(?:Proc-Type|DEK-Info):[^\r\n]*[\r\n]+){{0,2}}"
    rf"(?:(?:{KEY_MARKS}[A-Za-z0-9+/=\\]+{KEY_AFTER}(?:[\r\n]+|$)){{1,400}}(?:[A-Za-z0-9+/=\\\r\n]*(?:[\r\n]|$))?(?:{KEY_MARKS}{KEY_RUN})?|{KEY_MARKS}{KEY_RUN})"
)
PRIVATE = f"{KEY_HEAD}(?:{KEY_TO_END}|(?:{KEY_ON_LINE})?(?:{KEY_LINES})?)"

# Kinds, patterns and least lengths of the base, in the order in which kinds are listed.
RULES = [
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),  # as AKIA[A-Z0-9]+ of 16 or more: the run is taken whole from its first AKIA
    Rule("hex", r"[0-9a-f]{32,}"),
    # What the ledger adds to the base.
    Rule("private", PRIVATE, version=2),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
]
BASE = ("assign", "access", "hex")
#: What takes a secret's place in a redacted text.
MASK = "[SECRET]"

SCANNED = "blob string, kind string, version int"
FOUND = "blob string, kind string, version int, start long, end long"


def ledger_table(spark, path: str, name: str, schema: str) -> DataFrame:
    """A table of the ledger; without rows if nothing has been appended yet."""
    try:
        return spark.read.schema(schema).parquet(f"{path}/{name}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def scan(texts: DataFrame, rules: list[Rule]) -> DataFrame:
    """The findings (``FOUND``) of texts (blob, text, kinds): of each, the rules named in ``kinds``."""
    def matches(r: Rule) -> Column:
        def match(hit: Column) -> Column:
            value = F.regexp_extract(hit, r.pattern, r.group) if r.group else hit
            return F.struct(F.length(hit).alias("n"), F.length(value).alias("value"))

        return F.when(F.array_contains("kinds", r.kind) & F.col("text").rlike(r.pattern), F.struct(
            F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), F.lit(r.least).alias("least"),
            F.transform(F.split("text", r.pattern, -1), F.length).alias("gaps"),
            F.transform(F.regexp_extract_all("text", F.lit(r.pattern), F.lit(0)), match).alias("hits")))

    each = F.array(*map(matches, rules))
    hits = texts.select("blob", F.explode(each).alias("x")).filter("x is not null").select("blob", "x.*")
    hits = hits.select("blob", "kind", "version", "least", F.posexplode(F.arrays_zip("gaps", "hits")).alias("i", "z"))
    hits = hits.filter("z.hits is not null").select(
        "blob", "kind", "version", "least", "i", F.col("z.gaps").alias("gap"), F.col("z.hits.n").alias("n"), F.col("z.hits.value").alias("value"))
    along = Window.partitionBy("blob", "kind", "version").orderBy("i")
    hits = hits.withColumn("end", F.sum(F.col("gap").cast("long") + F.col("n")).over(along))
    return hits.filter("value >= least").select("blob", "kind", "version", (F.col("end") - F.col("n")).alias("start"), "end")


def update_ledger(docs: DataFrame, ledger: str, rules: list[Rule] | None = None) -> DataFrame:
    """Scan what is new in ``docs`` and return the paths: (doc_id, blob) of every row."""
    spark, rules = docs.sparkSession, rules or RULES
    paths = stored(docs.select("doc_id", F.sha2(text_of(), 256).alias("blob")), "paths")
    pairs = F.explode(F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules]))
    wanted = paths.select("blob").distinct().select("blob", pairs.alias("p")).select("blob", "p.*")
    unseen = stored(wanted.join(ledger_table(spark, ledger, "scanned", SCANNED), ["blob", "kind", "version"], "left_anti"), "unseen")
    kinds = unseen.groupBy("blob").agg(F.collect_set("kind").alias("kinds"))
    texts = docs.select(F.sha2(text_of(), 256).alias("blob"), text_of().alias("text")).filter("text != ''")
    texts = texts.groupBy("blob").agg(F.first("text").alias("text")).join(kinds, "blob")
    scan(texts, rules).write.mode("append").parquet(f"{ledger}/found")
    unseen.write.mode("append").parquet(f"{ledger}/scanned")
    return paths


def find_secrets(docs: DataFrame, ledger: str | None = None, rules: list[Rule] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, blob, and spans, an array of (start, rank, kind, end) by start and rank of the kind.

    Positions are code points, the end exclusive. ``ledger`` is a folder that outlives the job; without one, a new ledger is
    begun in the shared folder, for which everything is unseen.
    """
    spark, rules = docs.sparkSession, rules or RULES
    ledger = ledger or new_path(spark, "ledger")
    paths = update_ledger(docs, ledger, rules)
    rank = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (f"{r.kind} {r.version}", i)])
    found = ledger_table(spark, ledger, "found", FOUND).distinct().withColumn("rank", rank[F.concat_ws(" ", "kind", "version")])
    spans = found.filter("rank is not null").groupBy("blob").agg(
        F.sort_array(F.collect_list(F.struct("start", "rank", "kind", "end"))).alias("spans"))
    none = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    return salted_join(paths, spans, "blob", F.col("doc_id")).select("doc_id", "blob", F.coalesce("spans", none).alias("spans"))


def redact(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """``docs`` with each secret (overlapping spans as one) replaced by ``MASK`` and n_chars, if there, brought up to date."""
    ledger = ledger or new_path(docs.sparkSession, "ledger")
    found = find_secrets(docs, ledger).filter(F.size("spans") > 0).select("blob", "spans").dropDuplicates(["blob"])
    rows = docs.select(F.sha2(text_of(), 256).alias("blob"), F.struct("*").alias("_row"))
    merged = F.aggregate(
        "spans", F.array().cast("array<struct<start:bigint,end:bigint>>"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= s["start"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
                F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end")))),
        ).otherwise(F.concat(done, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))))
    cuts = stored(found.select("blob", merged.alias("cuts")), "cuts")
    cuts = cuts.select("blob", F.concat(F.array(F.lit(0).cast("long")), F.col("cuts.end")).alias("begins"),
                       F.concat(F.col("cuts.start"), F.array(F.lit(2**31 - 1).cast("long"))).alias("ends"))
    both = salted_join(rows, cuts, "blob", F.monotonically_increasing_id())
    between = F.array_join(F.zip_with("begins", "ends", lambda a, b: F.substring(F.col("_row.text"), a.cast("int") + 1, (b - a).cast("int"))), MASK)
    both = both.withColumn("_new", F.when(F.col("begins").isNull(), F.col("_row.text")).otherwise(between))
    new = {"text": F.col("_new"), "n_chars": F.when(F.col("begins").isNull(), F.col("_row.n_chars")).otherwise(F.length("_new"))} if "n_chars" in docs.columns else {"text": F.col("_new")}
    return both.select(*[(new[c].cast(t) if c in new else F.col("_row")[c]).alias(c) for c, t in docs.dtypes])
