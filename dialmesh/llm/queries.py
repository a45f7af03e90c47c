"""One query per operator over its whole table; ``QUERIES`` is what the entry point adds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..frames import add_once
from ..session import materialize, scratch_dir
from .bpe_digests import byte_pair_digests
from .common import WORD_PATTERN, table
from .embedding_dedup import embedding_duplicates
from .minhash_dedup import near_duplicates
from .packing import pack, token_pieces
from .periodic_runs import periodic_runs
from .piece_digests import piece_digests
from .quality_rules import base_failed, learn_rules, text_statistics, verdict
from .secret_scan import common_words, find, label_by_format, score_findings, train_forest
from .spelling_variants import spelling_variants
from .substring_dedup import remove_repeats
from .token_counts import count_tokens
from .token_files import read_token_files, write_token_files
from .tokenizers_files import public_path
from .toxicity import score_toxicity, toxic_by_language, train

CAPACITY = 4096


def held_out(key: str = "doc_id") -> Column:
    """Rows whose labels nothing may be learned from."""
    return F.crc32(F.col(key).cast("string")) % 5 == 0


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str):
    return train(docs, table(spark, sf_dir, "labels").where(~held_out()))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity_model(spark, docs, sf_dir)
    return score_toxicity(docs, model, ["doc_id", "lang"]).select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.coalesce(toxic_by_language("score", "lang", model), F.lit(False)).alias("over_threshold"),
    )


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{scratch_dir(spark)}/tokens"
    path = public_path("byte_bpe_50k.json")
    write_token_files(table(spark, sf_dir, "documents"), folder, path, end_id=2)
    return read_token_files(spark, folder, with_ids=False)


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def secret_forest(findings: DataFrame):
    """The tables hold no labelled findings: those that a strict format decides are labelled."""
    labelled = findings.where(~held_out()).withColumn("label", label_by_format(F.col("found")))
    return train_forest(labelled, common_words(findings))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    findings = materialize(find(table(spark, sf_dir, "documents"), every=True))
    return score_findings(findings, secret_forest(findings)).select(
        "doc_id",
        F.col("found.start").cast("long").alias("start"),
        F.length("found.value").cast("long").alias("length"),
        F.sha2("found.value", 256).alias("value_sha256"),
        F.round("score", 6).alias("score"),
        "is_secret",
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    statistics = materialize(text_statistics(table(spark, sf_dir, "documents")))
    labels = table(spark, sf_dir, "labels").where(~held_out()).select("doc_id", "quality")
    # rows that the base rule takes anyway have nothing to teach
    rules = learn_rules(statistics.where(~base_failed()).join(labels, "doc_id"))
    judged = statistics.withColumn("base_failed", base_failed())
    return judged.withColumn("kept", ~F.col("base_failed") & verdict(rules))


def op7_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(table(spark, sf_dir, "documents"), public_path("piece_bpe_32k.model"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_path("piece_bpe_32k.model")
    return count_tokens(table(spark, sf_dir, "documents"), path, limit=CAPACITY)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pack(token_pieces(docs, public_path("word_bpe_49k.json"), 1, CAPACITY), CAPACITY)


def _crc(*parts: str | Column) -> Column:
    """Unsigned crc32 of texts put together; a null counts as no text."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in map(lambda p: F.col(p) if isinstance(p, str) else p, parts)]
    return F.crc32(F.concat(*texts))


def planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text``; in a tenth of the documents the words from some place on repeat a period."""
    h = _crc("doc_id")
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD_PATTERN})"), 1))
    rows = add_once(docs.select("doc_id", "text"), "words", words)
    n, g = F.size("words").cast("bigint"), F.floor(h / 10).cast("bigint")
    rows = rows.withColumn("n", n).withColumn("a", F.when(F.col("n") > 0, g % F.col("n")))
    rows = rows.withColumn("p", F.lit(1) + F.floor((F.col("n") - F.col("a")) / (g % 8 + 3)).cast("bigint"))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    repeated = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1), lambda i: F.get("words", place(i).cast("int")))
    text = F.when(F.col("n") > 0, F.concat_ws(" ", repeated)).otherwise(F.col("text"))
    return rows.select("doc_id", text.alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(planted_periods(table(spark, sf_dir, "documents")))
    # of equal exponents the first stays: runs are in order of start and period
    best = F.aggregate(
        F.expr("slice(runs, 2, greatest(size(runs) - 1, 0))"),
        F.get("runs", F.lit(0)),
        lambda a, b: F.when(b["length"] * a["period"] > a["length"] * b["period"], b).otherwise(a),
    )
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.transform("runs", lambda r: F.concat(line(r), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        *[F.col(f"best.{name}").alias(name) for name in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def planted_misspellings(docs: DataFrame) -> DataFrame:
    """``word``: runs of letters in lower case; one in 97 loses a letter."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("([A-Za-z\u00C0-\u00FF]+)"), 1)).alias("run"))
    # lower() is the quicker one, but takes capitals beyond A-Z too
    lower = F.when(F.col("run").rlike("[\u00C0-\u00DE]"), F.translate("run", upper, upper.lower())).otherwise(F.lower("run"))
    runs = runs.select("doc_id", lower.alias("run"))
    h = _crc("doc_id", F.lit(":"), "run")
    at = (h % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return runs.select(F.when(h % 97 == 0, cut).otherwise(F.col("run")).alias("word"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = planted_misspellings(table(spark, sf_dir, "documents"))
    counts = words.where(F.length("word") >= 5).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return spelling_variants(counts.where("n >= 3"))


def op13_byte_pair_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_pair_digests(table(spark, sf_dir, "documents"), public_path("word_bpe_49k.json"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_token_files": op3_token_files,
    "op4_minhash_dedup": op4_minhash_dedup,
    "op5_secret_scan": op5_secret_scan,
    "op6_quality_rules": op6_quality_rules,
    "op7_piece_codec": op7_piece_codec,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_token_counts": op9_token_counts,
    "op10_packing": op10_packing,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_byte_pair_codec": op13_byte_pair_codec,
}
SQL: dict[str, str] = {}
