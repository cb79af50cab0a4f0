"""Document fingerprints of closed syncmers, with Spark expressions only.

The symbols of a text are its words (runs of up to ``LONGEST`` characters other than white space). A run of ``K`` symbols is an anchor
if, of its ``WINDOW`` inner runs of ``S`` symbols, the one with the smallest hash stands first or last. Whether a run is an anchor
depends on nothing outside it, so two texts that share a passage share its anchors, at matching places. Every anchor is
kept; about 2 of ``WINDOW`` + 1 runs are. A text with fewer than ``K`` symbols is one run, and that is its anchor.

A fingerprint is the anchors' hashes in the order of the text, 24 bits each, as Base64: four characters an anchor. The likeness of
two is the Dice coefficient of their sets of hashes; it is 1 for equal fingerprints, the empty ones too.

Defined cases: null text counts as empty and has the empty fingerprint, as does a text of white space alone. Rows that repeat have
equal fingerprints. In ``edited_documents`` a row without doc_id has no next document, rows that share a doc_id are paired with every row of
the next id, and the only document is its own next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from alertloom.llm.shared import partitions, stored, text_of

#: Characters of a symbol, at most; symbols of an inner run; inner runs of an anchor (a power of two); symbols of an anchor.
LONGEST, S, WINDOW = 16, 2, 4
K = WINDOW + S - 1
SYMBOL = r"[^\x20\x09-\x0D]{1,%d}" % LONGEST
#: Bits kept of an anchor's hash.
MASK = 0xFFFFFF


def _ahead(values: str | Column, by: int) -> Column:
    """The array without its first ``by`` elements."""
    return F.slice(values, F.lit(by + 1), F.greatest(F.size(values) - by, F.lit(0)))


def with_anchors(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with a column ``out``: the anchors of the text in column ``text``, array<struct<at:int, hash:int>> by place, ``at`` the
    number of the first symbol. The steps are columns of their own, so that each is computed once a row."""
    p = f"_{out}_"
    df = df.withColumn(p + "h", F.transform(F.regexp_extract_all(text, F.lit(SYMBOL), F.lit(0)), lambda w: F.xxhash64(w)))
    # Inner runs of S = 2 symbols; the last element, which lacks its second, is never read.
    df = df.withColumn(p + "s", F.zip_with(p + "h", _ahead(p + "h", 1), lambda a, b: F.xxhash64(a, b)))
    least, chain, step = p + "s", p + "s", 1
    while step < WINDOW:  # smallest hash, and hash, of the run's first 2, 4, … inner runs
        df = df.withColumn(f"{p}m{step}", F.zip_with(least, _ahead(least, step), lambda a, b: F.least(a, b)))
        least = f"{p}m{step}"
        if step > 1:  # runs of 2 symbols tile the anchor two apart
            df = df.withColumn(f"{p}c{step}", F.zip_with(chain, _ahead(chain, step), lambda a, b: F.xxhash64(a, b)))
            chain = f"{p}c{step}"
        step *= 2
    n = F.greatest(F.size(p + "h") - (K - 1), F.lit(0))
    df = df.withColumn(p + "z", F.arrays_zip(
        F.slice(least, F.lit(1), n).alias("least"), F.slice(p + "s", F.lit(1), n).alias("first"),
        F.slice(p + "s", F.lit(WINDOW), n).alias("last"), F.slice(chain, F.lit(1), n).alias("chain")))
    hashed = F.transform(p + "z", lambda z, i: F.when(
        (z["least"] == z["first"]) | (z["least"] == z["last"]),
        F.struct(i.alias("at"), F.xxhash64(z["chain"], z["last"]).bitwiseAND(MASK).cast("int").alias("hash"))))
    alone = F.aggregate(p + "h", F.lit(K).cast("long"), lambda h, w: F.xxhash64(h, w))
    short = F.array(F.struct(F.lit(0).alias("at"), alone.bitwiseAND(MASK).cast("int").alias("hash")))
    anchors = F.when(F.size(p + "h") >= K, F.array_compact(hashed)).when(F.size(p + "h") > 0, short).otherwise(
        F.array().cast("array<struct<at:int,hash:int>>"))
    kept = [c for c in df.columns if not c.startswith(p)]
    return df.select(*kept, anchors.alias(out))


def encoded(anchors: str) -> Column:
    """The fingerprint's string; Spark's Base64 breaks lines, which are taken out again."""
    hexes = F.array_join(F.transform(f"{anchors}.hash", lambda h: F.lpad(F.hex(h), 6, "0")), "")
    return F.replace(F.base64(F.unhex(hexes)), F.lit("\r\n"), F.lit(""))


def likeness(a: str, b: str) -> Column:
    """Of two columns of anchors."""
    x, y = F.array_distinct(f"{a}.hash"), F.array_distinct(f"{b}.hash")
    total = F.size(x) + F.size(y)
    return F.when(total == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(x, y)) / total)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, anchors and fingerprint of every row."""
    rows = with_anchors(docs.select("doc_id", text_of().alias("text")), "text", "anchors")
    return rows.select("doc_id", "anchors", encoded("anchors").alias("fingerprint"))


def next_ids(docs: DataFrame) -> DataFrame:
    """doc_id and next_id: the next smaller id there is; for the smallest, the largest. Ids are dealt by ranges, whose ends meet in
    a table of one row a range."""
    ids = docs.select("doc_id").filter("doc_id is not null").distinct()
    ids = ids.repartitionByRange(partitions(docs.sparkSession), "doc_id").withColumn("part", F.spark_partition_id())
    ids = stored(ids, "ids")
    ends = ids.groupBy("part").agg(F.max("doc_id").alias("largest"))
    below = F.lag("largest").over(Window.orderBy("part"))
    ends = ends.select("part", F.coalesce(below, F.max("largest").over(Window.partitionBy())).alias("below"))
    lead = F.lead("doc_id").over(Window.partitionBy("part").orderBy(F.desc("doc_id")))
    return ids.withColumn("next", lead).join(F.broadcast(ends), "part").select("doc_id", F.coalesce("next", "below").alias("next_id"))


def edited_documents(docs: DataFrame) -> DataFrame:
    """Every text beside an edited one, in which the last half of its code points is replaced by as many of the next document (or
    all it has), and beside that document's: doc_id, n_chars, edited, and the anchors of the three texts."""
    rows = docs.select("doc_id", text_of().alias("text"))
    pairs = next_ids(docs)
    # Both sides read the same rows dealt by doc_id, which Spark shuffles once; the left then moves on to its next.
    left = rows.join(pairs, "doc_id").alias("a")
    both = left.join(rows.alias("b"), F.col("a.next_id") == F.col("b.doc_id"))
    both = both.select("a.doc_id", "a.text", F.col("b.text").alias("next_text"))
    without = rows.filter("doc_id is null").select("doc_id", "text", F.lit("").alias("next_text"))
    both = both.unionByName(without).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substr("next_text", F.lit(1), half))
    both = both.withColumn("edited", edited)
    for text, out in (("text", "anchors"), ("edited", "edited_anchors"), ("next_text", "next_anchors")):
        both = with_anchors(both, text, out)
    return both.drop("text", "next_text")
