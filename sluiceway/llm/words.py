"""Words of whole texts, cut piece by piece inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

# Bytes of a text that are cut into words at a time.
PIECE = 4 << 20


def word_lists(text: bytes, width: int = 1) -> Iterator[list[bytes]]:
    """Words of a text by pieces; each list starts with the last `width` - 1 words of the one before."""
    start, before = 0, []
    while start < len(text):
        end = min(start + PIECE, len(text))
        while end < len(text) and text[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        words = before + text[start:end].split()
        yield words
        before, start = words[max(0, len(words) - width + 1) :] if width > 1 else [], end
