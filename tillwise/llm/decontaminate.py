"""Benchmark decontamination with DataFrame functions alone.

The benchmark's word windows become a set of hashes, each with its text and its items.  Every
window of a document is looked up in it, hits are compared as text, and the positions they
cover are counted, cut out, or make the document go.

The set is broadcast only if its measured windows are below ``BROADCAST_WINDOWS``; a larger
benchmark is joined by shuffling windows.  Words are split once per document and windows
are generated next to the lookup, so that only hits and one row per document are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import materialize
from .text import lower_ascii, unused

WINDOW = 10
BROADCAST_WINDOWS = 500_000
BROADCAST_BYTES = 64 * 2**20
#: Windows that start in one chunk of a document.
CHUNK = 32
#: Everything but letters and digits of ASCII and all that lies above ASCII, after A-Z became a-z.
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_EITHER_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text in lower case; null and texts without a word give an empty array."""
    parts = F.split(F.coalesce(lower_ascii(text), F.lit("")), _GAP)
    return F.filter(parts, lambda w: w != "")


def _starts(part: Column, length: int) -> Column:
    """(pos, length) of the windows of ``length`` words that start in a chunk; pos counts from 1."""
    last = F.least(F.lit(CHUNK), F.size(part) - length + 1)
    return F.when(last > 0, F.transform(F.sequence(F.lit(1), last), lambda i: F.struct(i.alias("pos"), F.lit(length).alias("length"))))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows (hash, length, phrase, items): of ``window`` words, or the whole item where it has fewer."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("w")).where("size(w) > 0")
    length = F.least(F.size("w"), F.lit(window))
    starts = F.explode(F.sequence(F.lit(1), F.size("w") - length + 1))
    return (
        items.select("item", "w", length.alias("length"), starts.alias("pos"))
        .select("item", "length", F.slice("w", F.col("pos"), F.col("length")).alias("gram"))
        .groupBy("gram", "length")
        .agg(F.collect_set("item").alias("items"))
        .select(F.xxhash64("gram").alias("hash"), "length", F.array_join("gram", " ").alias("phrase"), "items")
    )


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, items (sorted texts), spans, contaminated.

    A word is hit if it lies inside an occurrence of a benchmark window.  ``spans`` are the hit
    words as disjoint (start, end) pairs, from 0, end exclusive.  Null texts have no words; items
    with a null id are matched but not listed; rows that repeat an id are judged on their own;
    an empty benchmark hits nothing.  Equal items are all listed, in the order of their texts.  Very long texts are
    looked up chunk by chunk, in time in proportion to their length.
    """
    grams = benchmark_windows(benchmark, window)
    stats = grams.agg(
        F.collect_set("length").alias("lengths"),
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.length("phrase") + 24 * (1 + F.size("items"))), F.lit(0)).alias("bytes"),
    ).first()
    lengths = sorted(stats["lengths"])  # at most ``window`` different numbers
    small = stats["n"] <= BROADCAST_WINDOWS and stats["bytes"] <= BROADCAST_BYTES
    if small:
        grams = F.broadcast(grams)
    row = F.monotonically_increasing_id()
    base = docs.select(row.alias("row"), F.col(id_col).alias("doc_id"), words(F.col(text_col)).alias("w"))
    # a window's row carries the few words of its chunk, however long the document is
    chunks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("w") - 1, F.lit(0)), F.lit(CHUNK)),
        lambda i: F.struct(i.alias("before"), F.slice("w", i + 1, F.lit(CHUNK + window - 1)).alias("part")),
    )
    at = base.select("row", "doc_id", F.size("w").alias("n_words"), F.explode(chunks).alias("chunk")).select("row", "doc_id", "n_words", "chunk.before", "chunk.part")
    none = F.array(F.struct(F.lit(0).alias("pos"), F.lit(0).alias("length")))
    every = F.concat(F.when(F.col("before") == 0, none).otherwise(F.slice(none, 1, 0)), *[F.coalesce(_starts(F.col("part"), n), F.slice(none, 1, 0)) for n in lengths])
    at = at.select("*", F.explode(every).alias("at")).select("row", "doc_id", "n_words", "before", "part", F.col("at.pos").alias("pos"), F.col("at.length").alias("len"))
    gram = F.slice("part", F.greatest("pos", F.lit(1)), F.col("len"))
    at = at.withColumn("h", F.xxhash64(gram))
    said = F.array_join(gram, " ")
    if not small:  # a shuffled row holds its own window, not its chunk
        at, said = at.withColumn("said", said).drop("part"), F.col("said")
    # hits by hash are compared as text; as a join key the text would be built for every window
    found = at.join(grams, (F.col("h") == F.col("hash")) & (F.col("len") == F.col("length")), "left")
    found = found.where((F.col("pos") == 0) | (F.col("phrase").isNotNull() & (said == F.col("phrase"))))
    found = found.withColumn("pos", F.when(F.col("pos") > 0, F.col("before") + F.col("pos")).otherwise(F.lit(0)))
    per_doc = found.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.collect_set(F.when(F.col("pos") > 0, F.struct((F.col("pos") - 1).alias("start"), (F.col("pos") + F.col("len") - 1).alias("end")))).alias("raw"),
        F.collect_set("items").alias("items"),
    )
    return per_doc.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"),
        _merged(F.array_sort("raw")).alias("spans"),
    ).select(
        "doc_id",
        "n_words",
        F.coalesce(F.aggregate("spans", F.lit(0), lambda a, s: a + s["end"] - s["start"]), F.lit(0)).cast("long").alias("n_hit"),
        "items",
        "spans",
        (F.size("spans") > 0).alias("contaminated"),
    )


def _merged(spans: Column) -> Column:
    """Union of sorted spans: each keeps what lies past the furthest end before it, and empty rests go."""
    start = F.struct(F.lit(0).alias("reach"), F.slice(spans, 1, 0).alias("out"))

    def step(acc, s):
        own = F.struct(F.greatest(s["start"], acc["reach"]).alias("start"), s["end"].alias("end"))
        return F.struct(
            F.greatest(acc["reach"], s["end"]).alias("reach"),
            F.when(s["end"] > acc["reach"], F.concat(acc["out"], F.array(own))).otherwise(acc["out"]).alias("out"),
        )

    return F.aggregate(spans, start, step, lambda acc: acc["out"])


def drop_documents(docs: DataFrame, benchmark: DataFrame, min_hit: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose id has ``min_hit`` hit words or more.

    Rows that share an id, the null id included, go together; ``drop_rows`` judges each row on its own.  The ids found are written first, so that Spark
    knows how few they are before it plans how to take them out.
    """
    found = find(docs, benchmark, id_col=id_col, text_col=text_col).where(F.col("n_hit") >= min_hit)
    hit = unused("_hit_id", docs.columns)
    gone = materialize(found.select(F.col("doc_id").alias(hit)).distinct(), "contaminated")
    return docs.join(gone, F.col(id_col).eqNullSafe(F.col(hit)), "left_anti")


def drop_rows(docs: DataFrame, benchmark: DataFrame, min_hit: int = 1, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that have ``min_hit`` hit words or more, whatever their ids.

    A verdict depends on the text alone, so the SHA-256 of a text tells which rows go.  The keys found are written
    first, so that Spark knows how few they are before it plans how to take them out.
    """
    key, hit = (unused(n, docs.columns) for n in ("_text_key", "_hit_key"))
    of_text = F.unhex(F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"), 256))
    found = find(docs.select(of_text.alias("key"), F.col(text_col).alias("text")), benchmark, id_col="key").where(F.col("n_hit") >= min_hit)
    gone = materialize(found.select(F.col("doc_id").alias(hit)).distinct(), "contaminated")
    return docs.withColumn(key, of_text).join(gone, F.col(key) == F.col(hit), "left_anti").drop(key)


def remove_spans(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) of unique ids with the hit words cut out; a text without hits is returned as it is."""
    found = find(docs, benchmark, id_col=id_col, text_col=text_col).select("doc_id", "spans")
    both = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(found, "doc_id", "left")
    gaps = F.split("text", _EITHER_CASE, -1)
    parts = F.regexp_extract_all("text", F.lit(_EITHER_CASE), F.lit(0))
    kept = F.transform(parts, lambda w, i: F.when(F.exists("spans", lambda s: (s["start"] <= i) & (i < s["end"])), F.lit("")).otherwise(w))
    rebuilt = F.array_join(F.zip_with(gaps, kept, lambda g, w: F.concat(g, F.coalesce(w, F.lit("")))), "")
    return both.select("doc_id", F.when(F.size("spans") > 0, rebuilt).otherwise(F.col("text")).alias("text"))
