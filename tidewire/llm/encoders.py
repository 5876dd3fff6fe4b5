"""Byte-pair encoders read from rank files, for texts of any length."""

import base64
from functools import lru_cache

import regex

#: Blanks in a row from which a run is encoded as a piece of its own: the library's pattern gives up on runs of some
#: 700 000 blanks. The ids are the same either way.
LONG_RUN = 50_000
_RUN = regex.compile(r"\p{White_Space}{%d,}+" % LONG_RUN)


class ByteEncoder:
    """The vocabulary of a ``.tiktoken`` rank file. Its one special string has the first free id."""

    def __init__(self, path: str, special: str = "<|endoftext|>"):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.special, self.special_id = special, len(ranks)
        self.table = [b""] * (len(ranks) + 1)
        for token, rank in ranks.items():
            self.table[rank] = token
        self.table[-1] = special.encode()
        self._encoding = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def plain(self, text: str) -> list[int]:
        """Ids of a text whose special strings are ordinary text."""
        if len(text) < LONG_RUN:
            return self._encoding.encode_ordinary(text)
        made, at = [], 0
        for run in _RUN.finditer(text):
            made += self._encoding.encode_ordinary(text[at:run.start()])
            # A run ends its text, or leaves its last blank to the word that follows.
            at = run.end() if run.end() == len(text) else run.end() - 1
            made += self._encoding._encode_single_piece(text[run.start():at])
        return made + self._encoding.encode_ordinary(text[at:])

    def ids(self, text: str) -> list[int]:
        """Ids of a text whose special strings are the special id, as the tokenizer's file has it."""
        if self.special not in text:
            return self.plain(text)
        first, *others = text.split(self.special)
        made = self.plain(first)
        for part in others:
            made.append(self.special_id)
            made += self.plain(part)
        return made


@lru_cache(maxsize=2)
def byte_encoder(path: str) -> ByteEncoder:
    return ByteEncoder(path)
