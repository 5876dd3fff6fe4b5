"""Secrets in texts: fixed patterns, and values in credential contexts whose guess cost is high.

The guess cost of a value is the least number of guesses, in bits, over all ways to cut it into dictionary words (also
reversed or with substituted letters), dates, repeats, keyboard walks, runs of the alphabet and brute-force spans;
dynamic programming over the end of each span finds it.
"""

import math
import re
import string
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import map_texts
from tidewire.llm.encoders import byte_encoder

KINDS = ("assign", "access", "hex", "guess")
#: The patterns of the contract.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

#: A credential context: a naming word, an assignment sign (after bearer, a blank will do), a value up to blank or quote.
CONTEXT = re.compile(
    r"""(?:(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|private[_-]?key|access[_-]?key|credentials?|"""
    r"""auth|bearer)["']?[ \t]*(?::|=>|=)|bearer[ \t])[ \t]*["']?([^\s"'<>]{8,})""", re.I | re.A)
CONTEXT_WORDS = ("pass", "pwd", "secret", "token", "key", "credential", "auth", "bearer")

#: Words that guessers try first, most frequent first.
WORDS = (
    "password pass admin root user login welcome letmein qwerty master secret token key test guest default changeme "
    "example sample dummy placeholder your insert here none null true false hello monkey dragon sunshine princess "
    "football baseball shadow super summer winter spring autumn monday friday january february march april june july "
    "august september october november december love money access server database mysql postgres oracle system home "
    "work company office public private the and for with this that from have will what when where who"
).split()
#: Letters that other characters stand for; a one is read in two ways.
SPELT = [str.maketrans("0134578@$!", letters) for letters in ("oleastbasi", "oieastbasi")]
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
NEXT = {a: b for row in ROWS for a, b in zip(row, row[1:])}
BACK = {b: a for a, b in NEXT.items()}
AFTER = dict(zip(string.ascii_lowercase, string.ascii_lowercase[1:]))
BEFORE = {b: a for a, b in AFTER.items()}
DATE = re.compile(r"(?:19|20)\d\d(?:[-/.]?(?:0[1-9]|1[0-2])(?:[-/.]?(?:0[1-9]|[12]\d|3[01]))?)?"
                  r"|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d")
DATE_BITS = math.log2(366 * 120)
WALK_BITS = math.log2(2 * sum(map(len, ROWS)))
ALPHABET_BITS = math.log2(2 * 26)
RUNS = ((NEXT, WALK_BITS), (BACK, WALK_BITS), (AFTER, ALPHABET_BITS), (BEFORE, ALPHABET_BITS))
#: Lengths of a repeated unit, and the least length of such a repeat.
UNITS = {1: 3, 2: 4, 3: 6, 4: 8}
#: Letters that a word of a vocabulary has at least.
LEAST_WORD = 4


def _lower(value: str) -> str:
    """``value`` with small letters where that keeps its length."""
    return "".join(c.lower() if c.isascii() else c for c in value)


class Dictionary:
    """Words by the order in which guessers try them: the fixed ones, then those of a vocabulary in rank order."""

    def __init__(self, more: list[str] = ()):
        self.ranks: dict[str, int] = {}
        for word in (*WORDS, *more):
            self.ranks.setdefault(word, len(self.ranks) + 1)
        self.longest = max(map(len, self.ranks))
        #: More characters than a word, date, run or least repeat has.
        self.reach = max(self.longest, len(string.ascii_lowercase), *map(len, ROWS)) + 1

    def words_from(self, value: str, at: int) -> Iterator[tuple[int, float]]:
        """(end, bits) of the words of ``value`` that start at ``at``: as they are, backwards, or with substitutes."""
        part = value[at:at + self.longest]
        low = _lower(part)
        spelt = {low.translate(t) for t in SPELT} - {low}
        upper = 0
        for n, letter in enumerate(part, 1):
            upper += letter.isupper()
            if n < 2:
                continue
            ways = [(low[:n], 0), (low[:n][::-1], 1)]
            if spelt:
                ways += [(other[:n], 1 + sum(map(str.__ne__, other[:n], low[:n]))) for other in spelt]
            bits = [math.log2(rank + 1) + more for word, more in ways if (rank := self.ranks.get(word))]
            if bits:
                yield at + n, min(bits) + (upper > 0) * (1 + (upper > 1))


@lru_cache(maxsize=4)
def dictionary(vocabulary: str | None = None) -> Dictionary:
    """The fixed words, and the words among the tokens of a rank file, whose order is that of their frequency."""
    if vocabulary is None:
        return Dictionary()
    tokens = (t.decode("ascii", "replace").strip().lower() for t in byte_encoder(vocabulary).table)
    return Dictionary([t for t in tokens if len(t) >= LEAST_WORD and t.isascii() and t.isalpha()])


def _classes(value: str) -> float:
    """Bits of one brute-forced character, by the classes that the value shows."""
    size = 26 * any(c.islower() for c in value) + 26 * any(c.isupper() for c in value)
    size += 10 * any(c.isdigit() for c in value) + 33 * any(not c.isalnum() for c in value)
    if re.fullmatch("[0-9a-f]+", value):
        size = 16 if re.search("[a-f]", value) else 10
    return math.log2(max(size, 2))


def guess_bits(value: str, limit: float = math.inf, words: Dictionary | None = None) -> float:
    """Least guess cost of ``value`` in bits; 0 for an empty one, infinite if the cost reaches ``limit``.

    Linear in the length: words, dates and walks are short, and of the starts of a repeat only those are kept that
    may still be the cheapest.
    """
    words = words or dictionary()
    low, size, brute = _lower(value), len(value), _classes(value)
    best = [0.0] + [math.inf] * size
    repeats = {unit: [[] for _ in range(unit)] for unit in UNITS}
    begun = dict.fromkeys(UNITS, 0)
    last = 0
    # Spans that start at ``at`` reach forward; a span costs its own guesses and one bit for the cut.
    for at in range(size + 1):
        for unit, least in UNITS.items():
            if at <= unit or low[at - 1] != low[at - 1 - unit]:  # no repeat goes on from before
                begun[unit] = max(0, at - unit)
                for starts in repeats[unit]:
                    starts.clear()
            first, starts = at - least, repeats[unit][at % unit]
            if first >= begun[unit] and best[first] < limit:
                # Later starts gain on earlier ones as long as the repeat lasts, but never more than now.
                if all(best[s] + math.log2(at - s) > best[first] + math.log2(least) for s in starts):
                    starts[:] = [s for s in starts if best[s] < best[first]] + [first]
            if starts:
                best[at] = min(best[at], min(best[s] + unit * brute + math.log2(at - s) + 1 for s in starts))
        here = best[at]
        if here < limit:
            last = at
        elif at - last > words.reach and not any(starts for every in repeats.values() for starts in every):
            return math.inf
        if at == size or here >= limit:
            continue
        best[at + 1] = min(best[at + 1], here + brute)
        for end, bits in words.words_from(value, at):
            best[end] = min(best[end], here + bits + 1)
        if value[at].isdigit():
            for end in {at + 4, at + 6, at + 7, at + 8, at + 10}:
                if end <= size and DATE.fullmatch(value, at, end):
                    best[end] = min(best[end], here + DATE_BITS + 1)
        for step, bits in RUNS:
            end = at + 1
            while end < size and step.get(low[end - 1]) == low[end]:
                end += 1
                if end - at >= 3:
                    best[end] = min(best[end], here + bits + math.log2(end - at) + 1)
    return best[size] if best[size] < limit else math.inf


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns: leftmost, not overlapping within a kind, short ones dropped."""
    low, found = text.lower(), []
    if "pass" in low or "secret" in low or "token" in low or "api" in low:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def guessed_spans(text: str, bits: float, words: Dictionary | None = None) -> Iterator[tuple[int, int, int]]:
    """Values of any length in credential contexts that cost at least ``bits`` to guess."""
    low = text.lower()
    if not any(w in low for w in CONTEXT_WORDS):
        return
    for m in CONTEXT.finditer(text):
        start, end = m.span(1)
        if guess_bits(text[start:end], bits, words) >= bits:
            yield start, 3, end


def scan(
    text: str, bits: float, words: Dictionary | None = None
) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Spans of the fixed patterns, and these with the guessed ones; a guessed span may overlap or equal others."""
    base = base_spans(text)
    return base, sorted([*base, *guessed_spans(text, bits, words)])


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def secret_spans(docs: DataFrame, bits: float = 48.0, vocabulary: str | None = None) -> DataFrame:
    """Spans of secrets in every whole text, one row per input row.

    ``vocabulary`` is a rank file whose words guessers are taken to know, the lower ranks first, after the fixed ones.

    ``spans`` lists all spans as kind:start:end in code points, ``base_spans`` those of the fixed patterns; spans of
    different kinds may overlap. A null
    or empty text has none; repeated rows are scanned each; other columns are ignored.
    """
    def make():
        words = dictionary(vocabulary)

        def judge(texts):
            found = [scan(t, bits, words) for t in texts]
            counts = [[sum(k == kind for _, k, _ in every) for _, every in found] for kind in range(4)]
            return [*counts, [written(base) for base, _ in found], [written(every) for _, every in found]]

        return judge

    return map_texts(
        docs, ["doc_id"], make,
        "n_assign long, n_access long, n_hex long, n_guess long, base_spans string, spans string")


def redact(
    docs: DataFrame, bits: float = 48.0, mark: str = "[SECRET]", vocabulary: str | None = None
) -> DataFrame:
    """``docs`` with every secret span of ``text`` replaced by ``mark``; touching spans become one mark.

    Columns, their order and null texts stay; ``n_chars``, where there is one, is counted anew for changed texts.
    """
    def clean(text: str) -> str:
        spans = scan(text, bits, dictionary(vocabulary))[1]
        parts, last, end = [], 0, -1
        for start, _, stop in spans:
            if start > end:
                parts += [text[last:start], mark]
            end = max(end, stop)
            last = end
        return "".join(parts) + text[last:] if spans else text

    others = [c for c in docs.columns if c != "text"]
    held = docs.select("text", F.struct(*(F.col(f"`{c}`") for c in others)).alias("kept"))
    done = map_texts(held, ["kept", "text"], lambda: lambda texts: [[clean(t) for t in texts]], "cleaned string")
    changed = F.col("text").isNotNull() & (F.col("text") != F.col("cleaned"))
    text = F.when(F.col("text").isNull(), None).otherwise(F.col("cleaned")).cast(docs.schema["text"].dataType)

    def column(name):
        if name == "text":
            return text.alias(name)
        value = F.col("kept").getField(name)
        if name == "n_chars":
            value = F.when(changed, F.length("cleaned")).otherwise(value).cast(docs.schema[name].dataType)
        return value.alias(name)

    return done.select(*map(column, docs.columns))
