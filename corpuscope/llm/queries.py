"""One query per operator over its whole table, and the same in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscope.llm import (
    decontamination, embedding_dedup, language, licenses, line_dedup, periodic, quality, search, secrets, sentencepiece, simhash,
    training_order, whitening,
)
from corpuscope.llm.common import Scratch, read_file

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op6_decontamination(spark, sf):
    marked = decontamination.mark(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    names = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return marked.select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op7_line_dedup(spark, sf):
    kept = line_dedup.dedup(table(spark, sf, "documents"))
    return kept.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op9_simhash(spark, sf):
    return simhash.near_duplicates(table(spark, sf, "documents"))


@query
def op4_language(spark, sf):
    """``lang`` is what the metadata declares, ``source`` the host."""
    docs = table(spark, sf, "documents")
    return language.identify(
        docs, language.fit(docs, unknown=True), text=F.col("text"), declared=F.col("lang"), host=F.col("source"),
        keep={"doc_id": F.col("doc_id")}, key=F.col("doc_id"),
    )


@query
def language_of_pages(spark, sf):
    """The same for raw pages: declared by the markup, with the address's host and suffix."""
    pages = table(spark, sf, "pages")
    return language.identify(
        pages, language.fit(table(spark, sf, "documents"), unknown=True), text=language.visible_text(F.col("html")),
        declared=language.declared_in(F.col("html")), host=language.host_of(F.col("url")),
        keep={"page_id": F.col("page_id"), "url": F.col("url")},
    )


@query
def op3_sentencepiece(spark, sf):
    """Ids of every text, and whether they read back as the text."""
    coded = sentencepiece.encode_table(table(spark, sf, "documents"), read_file(spark, PIECES), check=True)
    return coded.select(
        "row.doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), F.col("decoded").eqNullSafe(F.col("row.text")).alias("same"),
    )


@query
def op2_secrets(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.Ledger(spark))
    base = [r.kind for r in secrets.BASE_RULES]
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    old = F.filter("spans", lambda s: s.kind.isin(base))
    count = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    counts = [count(kind) for kind in base]
    return found.select("row.doc_id", *counts, F.sha2(written(old), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


@query
def op5_licenses(spark, sf):
    return licenses.scan(table(spark, sf, "documents").select("doc_id", "text")).select(
        "row.doc_id", "license", "matched", "containment", "first_word"
    )


@query
def op8_quality(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "n_chars")
    scored = quality.score(docs, quality.fit(docs, table(spark, sf, "labels")))
    return scored.select(
        "row.doc_id", quality.held_out(F.col("row.doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= quality.CUT, 1).otherwise(0).alias("predicted"),
    )


@query
def op10_search(spark, sf):
    """Every document whose id is divisible by 20 asks, with its whole text, for its ten best among all documents."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return search.Index(docs).search(docs.filter("doc_id % 20 = 0"), 10)


@query
def op1_training_order(spark, sf):
    """The shards of all texts, read back: each slot's sequence number, place, and ids."""
    path = Scratch(spark, "shards").path
    training_order.write_shards(table(spark, sf, "documents"), path, read_file(spark, RANKS), key=20)
    return training_order.read_slots(spark, path)


def with_repeated_tail(key: Column, text: Column) -> Column:
    """The text's words, those of every tenth document by hash with a tail that repeats: from word a on, with period p."""
    hashed = F.crc32(key.cast("string").cast("binary"))
    g = F.floor(hashed / 10)

    def once(value: Column, use) -> Column:
        """``use`` of a value that is computed once, not at each place (or element) that names it."""
        return F.transform(F.array(value), use)[0]

    def tail(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("int")
        return once(F.struct(a.alias("a"), p.alias("p")), lambda at: F.concat(
            F.slice(words, F.lit(1), at.a), F.transform(F.sequence(at.a, n - 1), lambda i: F.get(words, at.a + (i - at.a) % at.p))
        ))

    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    repeated = F.array_join(once(words, tail), " ")
    return F.when((hashed % 10 == 0) & text.rlike(r"[^\x20\x09-\x0D]"), repeated).otherwise(text)


@query
def op11_periodic_runs(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", with_repeated_tail(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic.find_runs(docs, F.col("text"))
    # Longest first, then the smallest start and period: the least of (-length, start, period).
    top = F.array_min(F.transform("runs", lambda r: F.struct((-r.length).alias("less"), r.start.alias("start"), r.period.alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), "")
    return found.withColumn("top", top).select(
        "row.doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("top.start").alias("start"), (-F.col("top.less")).alias("length"),
        F.col("top.period").alias("period"), F.floor(-F.col("top.less") * 1000 / F.col("top.period")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_embedding_dedup(spark, sf):
    found = embedding_dedup.near_duplicates(table(spark, sf, "embeddings").select("vec_id", "embedding", "label"))
    return found.select("row.vec_id", "n_links", "component_id", "kept")


def fixed_point(vector: Column) -> Column:
    """floor(64 * c) + 1000000 of every entry; NULL if an entry is NULL or no number of at most 2^40 (1,100,000,000,000)."""
    usable = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) <= float(1 << 40)))
    return F.when(usable, F.transform(vector, lambda c: F.floor(c.cast("double") * 64) + 1000000))


@query
def op13_whitening(spark, sf):
    rows = table(spark, sf, "embeddings")
    x = fixed_point(F.col("embedding"))
    rows = rows.select("vec_id", "embedding")
    white = whitening.whiten(rows, x, whitening.fit(rows, x))
    # A deviation beyond the range of a long is NULL.
    return white.select("row.vec_id", "n", F.col("deviation").try_cast("bigint").alias("deviation"), "identity_error", F.explode("components").alias("c")).select(
        "vec_id", "c.component", "n", "deviation", "c.whitened", "c.explained", "identity_error"
    )
