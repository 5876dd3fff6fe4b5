"""Token counts by byte-pair merging on a heap and a linked list; no identifiers are emitted.

A piece starts as one symbol per byte. The adjacent pair of lowest rank merges first, the leftmost of equal ranks,
until no pair of the table is left: the count is the number of symbols minus the number of merges.
"""

import heapq
import json
import re
from functools import lru_cache

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import map_texts

#: Fixed value: the pre-tokenisation pattern of the public byte-level vocabulary.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Chunks whose counts a worker remembers before it starts afresh.
REMEMBERED = 400_000
_ID = 20
_LOW = (1 << _ID) - 1
_AT = (1 << 40) - 1


class Merges:
    """The merge table of a byte-level byte-pair file, with a bounded memory of chunk counts."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary = spec["model"]["vocab"]
        merges = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self.pairs = {
            vocabulary[a] << _ID | vocabulary[b]: rank << _ID | vocabulary[a + b] for rank, (a, b) in enumerate(merges)
        }
        # Fixed rule of the format: printable bytes stand for themselves, the others for code points from 256 on.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        shown = {**{b: chr(b) for b in printable}, **{b: chr(256 + at) for at, b in enumerate(others)}}
        self.first = [vocabulary[shown[b]] for b in range(256)]
        special = [t["content"] for t in spec.get("added_tokens", ())]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.pieces = regex.compile(PIECES)
        self.known: dict[str, int] = {}

    def piece(self, data: bytes) -> int:
        """Tokens of one pre-tokenised piece."""
        symbols = [self.first[b] for b in data]
        size = left = len(symbols)
        if size < 2:
            return size
        find = self.pairs.get
        heap = [
            merge >> _ID << 40 | at for at in range(size - 1)
            if (merge := find(symbols[at] << _ID | symbols[at + 1])) is not None
        ]
        heapq.heapify(heap)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        while heap:
            top = heapq.heappop(heap)
            at = top & _AT
            other = after[at]
            if symbols[at] < 0 or other >= size:
                continue
            merge = find(symbols[at] << _ID | symbols[other])
            if merge is None or merge >> _ID != top >> 40:  # the pair has changed since it was pushed
                continue
            symbols[at], symbols[other] = merge & _LOW, -1
            left -= 1
            after[at] = following = after[other]
            if following < size:
                before[following] = at
                if (merge := find(symbols[at] << _ID | symbols[following])) is not None:
                    heapq.heappush(heap, merge >> _ID << 40 | at)
            if (previous := before[at]) >= 0 and (merge := find(symbols[previous] << _ID | symbols[at])) is not None:
                heapq.heappush(heap, merge >> _ID << 40 | previous)
        return left

    def chunk(self, chunk: str) -> int:
        count = sum(self.piece(p.encode("utf-8", "surrogatepass")) for p in self.pieces.findall(chunk))
        if len(chunk) <= 64:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[chunk] = count
        return count

    def plain(self, text: str) -> int:
        """Tokens of a text without special strings.

        No piece crosses a single space between two visible characters, so the chunks between such spaces are
        counted on their own, and equal chunks once. A blank next to a blank keeps its neighbours in one chunk.
        """
        if not text:
            return 0
        known, count, total, chunks = self.known.get, self.chunk, 0, text.split(" ")
        held = chunks[0]
        for chunk in chunks[1:]:
            if chunk and not chunk[0].isspace() and held and not held[-1].isspace():
                found = known(held)
                total += count(held) if found is None else found
                held = " " + chunk
            else:
                held += " " + chunk
        found = known(held)
        return total + (count(held) if found is None else found)

    def count(self, text: str) -> int:
        if self.special is None or not self.special.search(text):
            return self.plain(text)
        parts = self.special.split(text)
        return sum(map(self.plain, parts)) + len(parts) - 1


@lru_cache(maxsize=4)
def merges(path: str) -> Merges:
    return Merges(path)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every whole text, one row per input row.

    A null or empty text has no bytes and no tokens; repeated rows are counted each; other columns are ignored.
    ``tokenizer`` is the path of a byte-level byte-pair ``.json`` file that all executors have.
    """
    def make():
        table = merges(tokenizer)
        return lambda texts: [[len(t.encode("utf-8", "surrogatepass")) for t in texts], [table.count(t) for t in texts]]

    return map_texts(docs, ["doc_id"], make, "n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit)
