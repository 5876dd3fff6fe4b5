"""Benchmark decontamination: a broadcast hash set of normalised n-grams, scanned windows, verified hits.

Built from DataFrame expressions alone. An n-gram of the benchmark is one row; document windows meet it on a 64-bit
hash of some of their words and are then verified on all of them.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import stored

#: What stands between words after A-Z have become a-z, and the words before that.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BETWEEN_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Benchmarks of at most so many distinct n-grams are broadcast (their texts too must fit); larger ones are joined by
#: a shuffle on the hash, with the same result.
BROADCAST_GRAMS = 1_000_000
BROADCAST_BYTES = 256_000_000


def words(text: Column) -> Column:
    """Lower-cased words. A text of one byte per character has no letters but A-Z to lower.

    Words are split, not extracted: extraction copies the text for every match.
    """
    plain = F.length(text) == F.octet_length(text)
    lowered = F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(F.coalesce(lowered, F.lit("")), BETWEEN), "")


def once(value: Column) -> Column:
    """``value`` behind a generated row, so the optimiser does not repeat it inside the lambdas that use it."""
    return F.explode(F.array(value))


def key(words_: Column, at: Column, length: int) -> Column:
    """Hash of five spread words of the window of ``length`` words at ``at``; equal windows have equal keys."""
    spread = sorted({0, length // 4, length // 2, 3 * length // 4, length - 1})
    return F.xxhash64(F.lit(length), *(F.get(words_, at + step) for step in spread))


def benchmark_grams(benchmark: DataFrame, size: int) -> DataFrame:
    """Stored distinct n-grams ``key, gram, items``: the items are those whose windows include the n-gram."""
    worded = benchmark.select("item_id", once(words(F.col("text"))).alias("words")).where(F.size("words") > 0)
    sized = worded.withColumn("length", F.least(F.lit(size), F.size("words")))
    each = sized.select(
        "item_id", "words", "length",
        F.explode(F.sequence(F.lit(0), F.size("words") - F.col("length"))).alias("at"))
    keyed = F.coalesce(*(
        F.when(F.col("length") == length, key(F.col("words"), F.col("at"), length)) for length in range(1, size + 1)))
    grams = each.select(
        "item_id", keyed.alias("key"), F.slice("words", F.col("at") + 1, F.col("length")).alias("gram"))
    return stored(grams.groupBy("key", "gram").agg(F.collect_set("item_id").alias("items")), "benchmark-grams")


def hits(docs: DataFrame, benchmark: DataFrame, size: int = 13) -> DataFrame:
    """Per distinct ``doc_id, text`` (by hash ``text_key``): ``n_rows, n_words``, verified ``hits`` and ``items``."""
    grams = benchmark_grams(benchmark, size)
    known = grams.agg(
        F.count("*").alias("n"), F.coalesce(F.sum(F.length(F.array_join("gram", " "))), F.lit(0)).alias("chars"),
        F.coalesce(F.sum(F.size("items")), F.lit(0)).alias("items"), F.collect_set(F.size("gram")).alias("lengths"),
    ).first()  # one row; lengths are at most ``size`` numbers
    small = known.n <= BROADCAST_GRAMS and 2 * known.chars + 16 * known.items <= BROADCAST_BYTES
    worded = docs.select("doc_id", F.xxhash64("text").alias("text_key"), once(words(F.col("text"))).alias("words"))
    # The position -1 stands for the document, so documents without windows stay. Keys are taken from the exploded
    # rows, not inside array lambdas: that compiles.
    placed = worded.select(
        "doc_id", "text_key", "words", F.explode(F.sequence(F.lit(-1), F.size("words") - 1)).alias("position"))
    at = F.col("position")
    lengths = sorted(known.lengths)
    runs = [
        F.struct(F.lit(length).alias("length"), F.when(
            (at >= 0) & (at + length <= F.size("words")), key(F.col("words"), at, length)).alias("key"))
        for length in lengths] or [F.struct(F.lit(0).alias("length"), F.lit(None).cast("long").alias("key"))]
    scanned = placed.select(
        "doc_id", "text_key", "words", "position",
        *([F.inline(F.array(*runs))] if len(runs) > 1 else [runs[0]["length"].alias("length"), runs[0]["key"].alias("key")]))
    first = F.col("length") == (lengths[0] if lengths else 0)
    if small:
        met = scanned.join(F.broadcast(grams), "key", "left").where(
            F.when(at < 0, first).otherwise(F.slice("words", F.greatest(at, F.lit(0)) + 1, F.col("length")) == F.col("gram")))
    else:  # a window takes its own words through the shuffle, not those of its document
        heads = scanned.where((at < 0) & first).select("doc_id", "text_key", "words", "position", "length").withColumn(
            "items", F.lit(None).cast(grams.schema["items"].dataType))
        windows = scanned.where(F.col("key").isNotNull()).select(
            "doc_id", "text_key", "position", "length", "key", F.slice("words", at + 1, F.col("length")).alias("window"))
        met = heads.unionByName(windows.join(grams, "key").where(F.col("window") == F.col("gram")).select(
            "doc_id", "text_key", F.lit(None).cast("array<string>").alias("words"), "position", "length", "items"))
    met = met.select(
        "doc_id", "text_key", F.when(F.col("position") < 0, F.size("words")).alias("size"),
        F.when(F.col("position") >= 0, F.struct("position", F.col("length"))).alias("hit"), "items")
    return met.groupBy("doc_id", "text_key").agg(
        F.count("size").alias("n_rows"), F.max("size").cast("long").alias("n_words"), F.collect_set("hit").alias("hits"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))


def covered(hits_: Column) -> Column:
    """Words inside any of the (position, length) hits."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(F.array_sort(hits_), start, lambda so, hit: F.struct(
        F.greatest(so["end"], hit["position"] + hit["length"]).alias("end"),
        (so["n"] + F.greatest(
            F.lit(0), hit["position"] + hit["length"] - F.greatest(so["end"], hit["position"]))).alias("n")))["n"]


def judged(found: DataFrame) -> DataFrame:
    """``found`` with ``n_hit`` and ``contaminated``: at least one in twenty words is hit."""
    return found.withColumn("n_hit", covered(F.col("hits")).cast("long")).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def decontamination(docs: DataFrame, benchmark: DataFrame, size: int = 13) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, item_ids, contaminated``, one row per input row.

    ``item_ids`` lists the items with occurring windows, sorted as strings and comma-joined. Null or empty texts have
    no words, null or empty items no windows; repeated rows each get the same result; other columns are ignored. An
    empty benchmark hits nothing.
    """
    rows = judged(hits(docs, benchmark, size)).withColumn(
        "row", F.explode(F.sequence(F.lit(1).cast("long"), "n_rows")))
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",").alias("item_ids"),
        "contaminated")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = 13) -> DataFrame:
    """``docs`` without contaminated documents; rows, columns and their order stay otherwise."""
    bad = judged(hits(docs, benchmark, size)).where("contaminated").select(
        F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"))
    return docs.join(
        bad, docs["doc_id"].eqNullSafe(bad["_doc"]) & (F.xxhash64(docs["text"]) == bad["_key"]), "left_anti")


def drop_spans(docs: DataFrame, benchmark: DataFrame, size: int = 13, mark: str = " ") -> DataFrame:
    """``doc_id, text`` with every hit run of words, and what stands between them, replaced by ``mark``."""
    found = hits(docs, benchmark, size).select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"), "hits")
    joined = docs.select("doc_id", "text").join(
        found, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.xxhash64("text") == F.col("_key")), "left")
    text = F.coalesce("text", F.lit(""))
    parts = F.array_remove(F.split(text, BETWEEN_ANY_CASE), "")
    gaps = F.split(text, WORD_ANY_CASE)
    hit = lambda at: F.exists("hits", lambda h: (h["position"] <= at) & (at < h["position"] + h["length"]))
    kept = F.transform("parts", lambda word, at: F.when(hit(at), F.lit("")).otherwise(word))
    between = F.transform("gaps", lambda gap, at: F.when((at > 0) & hit(at) & hit(at - 1), F.lit(mark)).otherwise(gap))
    joined = joined.select("*", once(F.struct(parts.alias("parts"), gaps.alias("gaps"))).alias("cut")).select(
        "doc_id", "text", "hits", "cut.*").select("*", once(F.struct(kept.alias("kept"), between.alias("between"))).alias(
            "done")).select("doc_id", "text", "hits", "done.*")
    rebuilt = F.array_join(F.flatten(F.transform(
        "between", lambda gap, at: F.array(gap, F.coalesce(F.get("kept", at), F.lit(""))))), "")
    return joined.select("doc_id", F.when(F.size("hits") > 0, rebuilt).otherwise(F.col("text")).alias("text"))
