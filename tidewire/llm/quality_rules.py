"""A ledger of quality rules: every rule is evaluated once, policies and ablations read its failure bits.

``measure`` takes the measurements of each text, ``ledger`` turns them into one long per row whose bit ``r`` is set
where rule ``r`` fails, ``apply_policy`` compares the bits with a versioned policy, ``ablation`` counts by bitwise
aggregation what each rule of a policy drops alone. No text is read twice.
"""

from collections import Counter
from functools import reduce
from itertools import compress

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import map_texts, stored

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters",
    "n_exclaimed", "longest_word",
)
SYMBOLS, BLANKS = "#*$%&|<>", " \t\n\x0b\x0c\r"


#: Rules, true where a row fails, in the order of their bits. A bit is never given to another rule; new rules go to the end.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "many_symbols": "100 * n_symbols > 30 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
    "shouting": "100 * n_upper > 60 * n_letters",
    "exclaiming": "100 * n_exclaimed > 40 * n_words",
    "endless_word": "longest_word > 1000",
}
BITS = {name: 1 << at for at, name in enumerate(RULES)}

#: Versioned policies: the rules that drop a row. A version, once used, stays as it is.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "many_symbols", "long_words", "repeated_lines"),
    "v2": tuple(RULES),
}


def repeated_words(words: list) -> int:
    """Words inside windows of three words that the text holds at least twice."""
    if len(words) < 4:
        return 0
    ids: dict = {}
    at = np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)
    pairs = at[:-1] * len(ids) + at[1:]
    if len(ids) > 2_000_000:  # keeps the product of three below 2^63
        pairs = np.unique(pairs, return_inverse=True)[1]
    triples = pairs[:-1] * len(ids) + at[2:]
    order = np.argsort(triples, kind="stable")
    same = triples[order][1:] == triples[order][:-1]
    twice = np.zeros(len(triples), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    hit = np.zeros(len(words), bool)
    for step in range(3):
        hit[step:step + len(triples)] |= twice
    return int(hit.sum())


def measurements(text: str) -> tuple:
    words = text.encode("utf-8", "surrogatepass").split()
    lines = text.split("\n")
    worded = list(compress(lines, (line.strip(BLANKS) for line in lines)))
    letters = [sum(map(text.count, s)) for s in ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")]
    return (
        len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)),
        sum(Counter(worded).values()) - len(set(worded)), repeated_words(words), len(worded), letters[0],
        sum(letters), sum(w.endswith(b"!") for w in words), max(map(len, words), default=0),
    )


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the measurements of every whole text; a null or empty text measures 0 throughout."""
    return map_texts(
        docs, ["doc_id"], lambda: lambda texts: list(zip(*map(measurements, texts))),
        ", ".join(f"{m} long" for m in MEASURES))


def ledger(measured: DataFrame) -> DataFrame:
    """``measured`` with ``failed_bits``: bit ``r`` is set where rule ``r`` fails."""
    bits = [F.when(F.expr(rule), F.lit(BITS[name])).otherwise(F.lit(0)).cast("long") for name, rule in RULES.items()]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return measured.withColumn("failed_bits", total)


def stored_ledger(docs: DataFrame) -> DataFrame:
    """Measurements and failure bits, one stored row per input row."""
    return stored(ledger(measure(docs)), "quality-ledger")


def mask(policy: str) -> int:
    return sum(BITS[rule] for rule in POLICIES[policy])


def apply_policy(judged: DataFrame, policy: str, column: str = "kept") -> DataFrame:
    """``judged`` with a boolean ``column``: no rule of the policy fails."""
    return judged.withColumn(column, F.col("failed_bits").bitwiseAND(F.lit(mask(policy))) == 0)


def ablation(judged: DataFrame, policy: str) -> DataFrame:
    """Per rule of a policy: rows that fail it, that fail it alone, and rows kept without it.

    The ledger is first reduced to one row per pattern of bits, so the work after that does not grow with the rows.
    """
    of_policy = F.col("failed_bits").bitwiseAND(F.lit(mask(policy)))
    patterns = judged.groupBy(of_policy.alias("bits")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*(
        F.struct(F.lit(name).alias("rule"), F.lit(BITS[name]).cast("long").alias("bit")) for name in POLICIES[policy]
    ))).alias("r")
    fails = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    alone = F.col("bits") == F.col("r.bit")
    return patterns.select("bits", "n", rules).groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(fails, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(alone, F.col("n")).otherwise(0)).alias("n_failed_alone"),
        F.sum(F.when(alone | (F.col("bits") == 0), F.col("n")).otherwise(0)).alias("n_kept_without"))


def ablations(judged: DataFrame) -> DataFrame:
    """``policy`` and the rows of ``ablation`` for every policy, read from one ledger."""
    parts = [ablation(judged, policy).select(F.lit(policy).alias("policy"), "*") for policy in POLICIES]
    return reduce(DataFrame.unionByName, parts)


def quality_rules(docs: DataFrame, policy: str = "v2") -> DataFrame:
    """Measurements, failure bits, ``base_failed`` and ``kept`` by a policy, one row per input row, from a stored ledger.

    Repeated rows are judged each; null and empty texts fail the base rules; other columns are ignored.
    """
    judged = apply_policy(stored_ledger(docs), "base", "base_kept")
    return apply_policy(judged, policy).withColumn("base_failed", ~F.col("base_kept")).withColumn(
        "kept", F.col("base_kept") & F.col("kept")).drop("base_kept")
