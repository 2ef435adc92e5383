"""Registered queries of the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import align, chat, decontaminate, embeddings, html_extract, mixing, rules, runs, sharding, simhash, toxicity, urls, warc
from tidemark.llm.common import cut, shared_folder

SHARDS = 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through an archive and back.  Null html is an empty payload, repeated page ids stay separate rows."""
    path = shared_folder(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    return warc.read_archive(spark, path).select(
        F.nullif("record_id", F.lit("")).cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"), "intact",
    )


def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to 150 % of their words, at most two epochs of a source."""
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source"
    )


def toxic_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the probabilities of the chain, trained on a bounded sample of the labelled ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = toxicity.label_categories(table(spark, sf_dir, "labels"))
    chain = toxicity.train(docs, labels, toxicity.CATEGORIES)
    return toxicity.score(docs, chain, toxicity.CATEGORIES).drop("text")


def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their fingerprint and the smallest doc_id that links of 3 bits or fewer reach."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = cut(simhash.with_fingerprint(docs, "fp").select("doc_id", "fp"))
    groups = simhash.near_duplicates(marked, "fp")
    return marked.join(groups, "fp").select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def contaminated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with a copy of a test item: the item, the alignment score and the words it spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.matches(docs, table(spark, sf_dir, "benchmark").select("item_id", "text")).drop("row")


def embedding_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors with the number of their links and their component."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


URL_RULES = [
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
]


def filter_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages judged by the rules and by the purity of their merged branch; a page's label is that of its document.

    `purity` is the template's own.
    """
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.filter_urls(pages, labels, URL_RULES).drop("branch", "branch_purity")


CHAT_SAMPLE = r"\### Assistant: </turn> ok"


def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one made of control strings, formatted, and read back from the output."""
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", F.coalesce("text", F.lit("")).alias("text")
    )
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CHAT_SAMPLE).alias("text"),
    )
    messages = chat.threads(rows.union(extra), "conv_id", "turn", "role", "text")
    back = chat.read_back(chat.format_paths(chat.paths(messages)))
    told = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(told, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 equal shards, and where they would go with one more."""
    sized = table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = sharding.shard_records(sized, "doc_id", [1.0] * SHARDS, [1.0] * (SHARDS + 1))
    return sharding.numbered(placed, "shard", ["doc_id", "text_crc32", "size"])


def extract_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page, by a labeller trained on a bounded sample of them."""
    return html_extract.extract(table(spark, sf_dir, "pages"))


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text; from a place on, one text in ten (by its id's CRC) repeats the words that begin there."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), "")
    of = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    g, n = F.floor(F.col("h") / 10), F.size("words")
    of = of.withColumn("a", F.when(n > 0, g % n).cast("int")).withColumn("left", F.size("words") - F.col("a"))
    of = of.withColumn("p", (1 + F.floor(F.col("left") / (3 + g % 8))).cast("int"))
    cycle = F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil(F.col("left") / F.col("p")).cast("int"))
    told = F.concat(F.slice("words", 1, F.col("a")), F.slice(F.flatten(cycle), F.lit(1), F.col("left")))
    return of.select("doc_id", F.when(F.col("p").isNotNull(), F.array_join(told, " ")).otherwise(F.col("text")).alias("text"))


# Public vocabularies; the folder is there on every machine.
TOKENIZERS = align.Tokenizers("/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model")


def token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the groups and links of their tokens under two vocabularies."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return align.aligned_documents(docs, TOKENIZERS).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def document_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by rules that were learnt from two thirds of the labels, chosen by the id's CRC."""
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ensemble = rules.train(docs, table(spark, sf_dir, "labels").where(~held_out))
    return rules.score(docs, ensemble).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, a tenth of them with a planted period, with their runs and a digest of what is left without repeats."""
    found = runs.find_runs(planted(table(spark, sf_dir, "documents")))
    line = F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    # runs come by start, then period, so of equal exponents the first stays
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda held, r: F.when(
        r["length"] * held["period"] > held["length"] * r["period"], r).otherwise(held))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": warc_archive,
    "op2_mixing": mix_sources,
    "op3_toxicity": toxic_documents,
    "op4_simhash": simhash_groups,
    "op5_decontamination": contaminated_documents,
    "op6_embeddings": embedding_groups,
    "op7_urls": filter_urls,
    "op8_chat": chat_format,
    "op9_sharding": shard_documents,
    "op10_html": extract_pages,
    "op11_alignment": token_alignment,
    "op12_runs": periodic_runs,
    "op13_quality": document_quality,
}
