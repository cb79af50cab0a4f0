"""One query for each operator: applied to its whole table, with the digest columns of its contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from alertloom.llm import (
    bpe, chat, exact_dedup, fingerprint, lang_id, near_dedup, ngram_join, packing, prefix_trie, quality, repair, secret_scan, token_store)
from alertloom.llm.shared import stored, table, text_of


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=3, share=(85, 100))


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.token_index(table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    langs, net = lang_id.train(docs.filter(~lang_id.held_out()))
    return lang_id.identify(docs, langs, net).select("doc_id", lang_id.held_out().alias("held_out"), "lang_pred", "score")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = bpe.decode_documents(bpe.encode_documents(table(spark, sf_dir, "documents")))
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))

    def named(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*secret_scan.BASE))
    return found.select("doc_id", *map(count, secret_scan.BASE), F.sha2(named(base), 256).alias("base_sha256"),
                        named(F.col("spans")).alias("spans"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(~quality.held_out()).select("doc_id", F.col("quality").alias("label"))
    scored = quality.score(docs, quality.train(docs, labels))
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


#: The conversation that the contract adds.
TRICKY = r"\### Assistant: </turn> ok"


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.createDataFrame([(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)], rows.schema)
    read = chat.parse_chat(stored(chat.format_chat(rows.unionByName(tricky)), "chat"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    part = F.struct("segment", F.size("turns").cast("long").alias("n"), lines.alias("lines"),
                    F.array_join("loss_texts", "").alias("loss"), F.col("formatted_chars").cast("long").alias("chars"))
    whole = read.select("conv_id", part.alias("p")).groupBy("conv_id").agg(F.sort_array(F.collect_list("p")).alias("p"), F.sum("p.n").alias("n_turns"), F.sum("p.chars").alias("formatted_chars"))
    loss = whole.select("conv_id", "n_turns", "formatted_chars", F.array_join("p.lines", "").alias("lines"), F.array_join("p.loss", "").alias("loss"))
    return loss.select("conv_id", "n_turns", F.sha2("lines", 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
                       F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprint.edited_documents(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint.encoded("anchors").alias("fingerprint"),
        fingerprint.encoded("edited_anchors").alias("edited_fingerprint"), fingerprint.likeness("anchors", "edited_anchors").alias("near_edited"),
        fingerprint.likeness("anchors", "next_anchors").alias("near_next"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(prefix_trie.rebuilt(prefix_trie.digests(table(spark, sf_dir, "conversations"))))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    repaired = repair.repair_conversations(repair.damaged(rows)).withColumnRenamed("conv_id", "of")
    every = rows.select("conv_id").distinct().join(repaired, F.col("conv_id").eqNullSafe(F.col("of")), "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    lines = F.array_join(F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    return every.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.sha2(F.coalesce(lines, F.lit("")), 256).alias("repaired_sha256"))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"), width=4, share=(85, 100))


QUERIES = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_token_output": op2_token_output,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_language_id": op4_language_id,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_secret_scan": op7_secret_scan,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_chat_format": op9_chat_format,
    "op10_fingerprints": op10_fingerprints,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_ngram_join": op13_ngram_join,
}
