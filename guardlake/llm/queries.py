"""The registered queries of this subpackage, one per operator, over whole tables."""

import public_tokenizers
from guardlake.llm import best_positions, bpe, chunk_dedup, exact_dedup, jaccard_join, mixing, periodic_runs, quality, repetition_rules, suffix_dedup, token_counts, token_files, topk
from guardlake.session import scratch_folder
from pyspark.sql import functions as F

#: Target shares of the sources of ``documents``.
SOURCE_WEIGHTS = {f"src{i}": 2.0 if i % 4 == 0 else 1.0 for i in range(20)}


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _digests(cut, *more):
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cut.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        *more,
    )


def op1_suffix_dedup(spark, sf_dir):
    return _digests(suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), length=50))


def op2_topk_search(spark, sf_dir):
    vectors = topk.integer_vectors(_table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where("id % 100 = 0"), 10)


def op3_bpe(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.digest_documents(_table(spark, sf_dir, "documents"), path)


def op4_token_files(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    folder = scratch_folder(spark, "token-files")
    token_files.write_token_files(_table(spark, sf_dir, "documents"), path, folder, end_id=2)
    return token_files.digest_token_files(spark, folder)


def op5_token_counts(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), path, limit=2048)


def op6_exact_dedup(spark, sf_dir):
    marked = exact_dedup.mark_copies(_table(spark, sf_dir, "documents"), keep="largest")
    return marked.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def op7_mix_sources(spark, sf_dir):
    mixed = mixing.mix_sources(_table(spark, sf_dir, "documents"), SOURCE_WEIGHTS)
    return mixed.select("row.doc_id", "row.source", "copy", "place", "row.text")


def op8_jaccard_join(spark, sf_dir):
    return jaccard_join.link_documents(_table(spark, sf_dir, "documents"), width=3, percent=90)


def op9_chunk_dedup(spark, sf_dir):
    cut = chunk_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return _digests(cut, F.col("kept").cast("string").alias("text"))


#: Scores below this are rejected.
QUALITY_LIMIT = 0.3


def op10_quality(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    voter = quality.fit(docs, _table(spark, sf_dir, "labels"))
    scored, score = quality.score_documents(docs, voter, columns=["doc_id"])
    return scored.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        F.col(score).alias("score"),
        (F.col(score) >= QUALITY_LIMIT).cast("int").alias("predicted"),
    )


def stretched(docs, doc_id="doc_id", text="text"):
    """(doc_id, text): of the ids whose crc32 ends in 0, the text's later words repeat a stretch of it.

    With h the crc32, g = h div 10 and n words, word a + i becomes word a + i % p,
    where a = g % n and p = 1 + (n - a) div (3 + g % 8).  Other texts, and those
    of null ids, stay as they are.
    """
    h = F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary"))
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    words = F.filter(F.split(F.when(chosen, body).otherwise(""), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    frame = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), body.alias("text"), F.floor(h / 10).alias("g"), chosen.alias("chosen"), words.alias("words"))
    frame = frame.withColumn("n", F.size("words").cast("long")).withColumn("chosen", F.col("chosen") & (F.col("n") > 0))
    frame = frame.withColumn("a", F.when(F.col("chosen"), F.col("g") % F.col("n"))).withColumn(
        "p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))
    )
    a, p, n = (F.col(c).cast("int") for c in "apn")
    head = F.slice("words", F.lit(1), a)
    tail = F.flatten(F.array_repeat(F.slice("words", a + 1, p), F.ceil((n - a) / p).cast("int")))
    made = F.array_join(F.slice(F.concat(head, tail), F.lit(1), n), " ")
    return frame.select("doc_id", F.when(F.col("chosen"), made).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark, sf_dir):
    marked = periodic_runs.collapse_runs(stretched(_table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.col("strongest")
    return marked.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("(1000 * strongest.length) div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )


def op12_repetition_rules(spark, sf_dir):
    return repetition_rules.repetition(_table(spark, sf_dir, "documents"))


def op13_ranked_search(spark, sf_dir):
    return best_positions.rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=10)


QUERIES = [op1_suffix_dedup, op2_topk_search, op3_bpe, op4_token_files, op5_token_counts, op6_exact_dedup, op7_mix_sources, op8_jaccard_join, op9_chunk_dedup, op10_quality, op11_periodic_runs, op12_repetition_rules, op13_ranked_search]


def queries():
    return {f.__name__: f for f in QUERIES}
