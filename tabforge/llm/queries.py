"""Driver queries ``opN_<name>``: each applies its operator with production
parameters to its whole table and derives the digest columns of its result."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabforge.llm import (bpe, ecoc, lexical, metric_join, minhash, packing, pii, repeats, sharding, spelling, token_cache,
                          toxicity, winnow)
from tabforge.llm.common import Scratch, crc_mod, join_ids, partitions, prepare
from tabforge.llm.oracle import ORACLE_SQL  # noqa: F401
from tabforge.sources.tables import table

SHARDS = 8
#: Key of the pseudonyms; a deployment sets its own.
PII_KEY = os.environ.get("TABFORGE_PII_KEY", "public key of the test tables").encode()


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_join.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law ``key``: eight shards of equal weight, a ninth for grown_shard.
    Null text counts as no bytes."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"))
    return sharding.shard(docs, ["doc_id"], [1.0] * SHARDS, added=[1.0]) \
        .select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(False))
    model = ecoc.fit(docs.where(~held))
    return ecoc.predict(docs, model, keep=("doc_id",)) \
        .select("doc_id", held.alias("held_out"), "lang_pred", "score", "ambiguous")


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes(table(spark, sf_dir, "documents"), k=4, percent=80)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                          public_tokenizers.PATTERN, keep=("doc_id",))


def with_next(docs: DataFrame, key: str, text: str, carried: str) -> DataFrame:
    """Add ``carried``: the text of the next row in ascending ``key`` (after
    the last: of the first).  Null keys come last; rows that share a key, or
    have none, stand in the order of a hash of their text (``__hash``).

    Rows are dealt to buckets of consecutive keys; each bucket also gets the
    first row of the next one as a guest.  The key's quantiles (as many as
    there are buckets) cut the buckets, found per row by binary search; rows
    without a key are dealt by their hash."""
    spark = docs.sparkSession
    n = 4 * partitions(spark)
    cuts = docs.select(F.approx_percentile(key, F.array(*[F.lit(i / n) for i in range(1, n)]), 20 * n)).first()[0] or []
    cuts = sorted(set(cuts))
    bounds = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<bigint>")
    # Number of cuts at or below the key: halve [lo, hi) until it is empty.
    span = F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi"))

    def halve(s, _):
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        up = F.get(bounds, mid) <= F.col(key)
        return F.when(s["lo"] >= s["hi"], s).when(up, F.struct((mid + 1).alias("lo"), s["hi"].alias("hi"))) \
            .otherwise(F.struct(s["lo"].alias("lo"), mid.alias("hi")))

    steps = F.sequence(F.lit(0), F.lit(len(cuts).bit_length()))
    bits = (n - 1).bit_length()
    keyless = len(cuts) + 1 + F.shiftrightunsigned(F.col("__hash").bitwiseXOR(F.lit(-1 << 63)), 64 - bits).cast("int") if bits else F.lit(len(cuts) + 1)
    bucket = F.when(F.col(key).isNull(), keyless).otherwise(F.aggregate(steps, span, halve)["lo"])
    keyed = docs.withColumn("__hash", F.xxhash64(text)).withColumn("__bucket", bucket)
    # One row per bucket from here on: its first row's place and the bucket before it.
    place = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.col("__hash").alias("hash"))
    firsts = keyed.groupBy("__bucket").agg(F.min(place).alias("__first"))
    order = Window.orderBy("__bucket")
    firsts = firsts.withColumn("__before", F.coalesce(F.lag("__bucket").over(order), F.last("__bucket").over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    places = F.array(F.struct(F.col("__bucket").alias("b"), F.lit(0).alias("guest")),
                     F.struct(F.col("__before").alias("b"), F.lit(1).alias("guest")))
    firsts = firsts.select("__before", F.col("__first.key").alias("__key"), F.col("__first.hash").alias("__own"))
    placed = keyed.join(F.broadcast(firsts), keyed[key].eqNullSafe(F.col("__key")) & (F.col("__hash") == F.col("__own")), "left") \
        .withColumn("__at", F.explode(F.filter(places, lambda p: p["b"].isNotNull()))) \
        .select(*docs.columns, "__hash", F.col("__at.b").alias("__bucket"), F.col("__at.guest").alias("__guest"))
    return placed.withColumn(carried, F.lead(text).over(next_order(key)))


def next_order(key: str) -> Window:
    """The order of ``with_next`` within a bucket; guests come last."""
    return Window.partitionBy("__bucket").orderBy("__guest", F.asc_nulls_last(key), "__hash")


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return fingerprint_report(table(spark, sf_dir, "documents"))


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness
    to each other and to the next document's."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    w = next_order("doc_id")
    chars = F.char_length("text")
    cut = F.floor(chars / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), chars - cut), F.substring("__next", F.lit(1), cut))
    pairs = with_next(docs, "doc_id", "text", "__next") \
        .select("doc_id", "text", "__hash", "__bucket", "__guest", chars.cast("long").alias("n_chars"), edited.alias("edited"))
    marked = pairs.select("doc_id", "__hash", "__bucket", "__guest", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                          winnow.hashes(winnow.fingerprint(F.col("text"))).alias("fp"),
                          winnow.hashes(winnow.fingerprint(F.col("edited"))).alias("edited_fp"))
    return marked.withColumn("next_fp", F.lead("fp").over(w)).where("__guest = 0").select(
        "doc_id", "n_chars", "edited_sha256", winnow.digest(F.col("fp")).alias("fingerprint"),
        winnow.digest(F.col("edited_fp")).alias("edited_fingerprint"),
        winnow.likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        winnow.likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))


def toxic_rows(docs: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows to learn toxicity from: every label whose document is not held out."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("label_id"), "toxic") \
        .where(crc_mod(F.col("label_id"), 5) != 0)
    return join_ids(docs, labels, docs["doc_id"] == labels["label_id"], 16).select("text", "toxic")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = toxicity.fit(toxic_rows(docs, spark, sf_dir))
    held = F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(False))
    return toxicity.score(docs, lexicon, keep=("doc_id",)) \
        .select("doc_id", held.alias("held_out"), "score", "predicted", "hits")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cache is new in each run, so every distinct text is encoded; a
    deployment names a lasting folder."""
    return token_cache.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                    Scratch(spark, "tokens").path("cache"), keep=("doc_id",), limit=1024)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.pseudonymise(docs, PII_KEY, counts="pii")
    return found.select("doc_id", "text", *[F.coalesce(F.col("pii")[k], F.lit(0)).alias(f"n_{k}") for k in pii.KINDS])


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                                  capacity=4096, end_id=1) \
        .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Letters are dropped from about one run in 199, as the contract says."""
    words = spelling.vocabulary(table(spark, sf_dir, "documents"), every=199, least=6, often=5)
    return spelling.variants(words, ratio=5).select("word", "form", "root", "n", "n_near", "form_n")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op13_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All places of a repeated string go, the first one too."""
    made = repeats.remove_repeats(table(spark, sf_dir, "documents"), length=400, first=False, keep=("doc_id",))
    return made.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_embedding_near_dedup, op2_sharding, op3_language_id, op4_minhash_near_dedup,
                            op5_byte_bpe, op6_fingerprints, op7_toxicity, op8_token_counts, op9_pii, op10_packing,
                            op11_spelling_variants, op12_lexical_search, op13_suffix_array_dedup,
                            pipeline)
}
