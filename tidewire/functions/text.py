"""String predicates that follow the JVM's notion of blank and length, as SQL text."""

# Fixed value: anything above U+0020 makes a string non-blank.
NON_BLANK = r"[^\x00-\x20]"

# Fixed value: the textual form of a UUID.
UUID_FORM = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"


def is_blank(text: str) -> str:
    """Null, empty, or made only of characters up to U+0020 (tabs and newlines too)."""
    return f"({text} IS NULL OR NOT rlike({text}, r'{NON_BLANK}'))"


def utf16_length(text: str) -> str:
    """Length in UTF-16 units: a character outside the basic plane counts twice."""
    return f"CAST(octet_length(encode({text}, 'UTF-16BE')) DIV 2 AS INT)"


def longer_than(text: str, limit: int) -> str:
    """Whether the UTF-16 length exceeds the limit, false for null.

    UTF-16 units number at most the UTF-8 bytes and at least the characters,
    so the byte and character counts settle nearly all rows without encoding.
    """
    return (
        f"CASE WHEN {text} IS NULL OR octet_length({text}) <= {limit} THEN false"
        f" WHEN char_length({text}) > {limit} THEN true"
        f" ELSE {utf16_length(text)} > {limit} END"
    )


def is_uuid(text: str) -> str:
    return f"rlike({text}, r'{UUID_FORM}')"


def numbered_uuid(number: str) -> str:
    """A version-4-shaped UUID carrying the 64 bits of a number: the upper 16 in its second group, the rest in the last."""
    digits = f"lpad(lower(hex(CAST({number} AS BIGINT))), 16, '0')"
    return f"concat('00000000-', substr({digits}, 1, 4), '-4000-8000-', substr({digits}, 5))"


def hashed_uuid(*texts: str) -> str:
    """A UUID-shaped id that depends only on the given values; null counts as empty."""
    joined = ", ".join(f"coalesce(CAST({text} AS STRING), '')" for text in texts)
    return (
        rf"regexp_replace(md5(concat_ws('\u001f', {joined})),"
        r" r'^(.{8})(.{4})(.{4})(.{4})(.{12})$', '$1-$2-$3-$4-$5')"
    )
