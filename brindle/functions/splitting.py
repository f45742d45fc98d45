"""Cutting one text into overlapping chunks. Small helpers that run inside Arrow UDFs."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Sequence
from itertools import accumulate

# Fixed value: a code chunk may end at a blank line or before a function header.
CODE_BREAK = re.compile(r"\n\n|\n(?=[a-zA-Z_]\w*\s+[a-zA-Z_]\w*\s*\()", re.ASCII)

_TOKEN = re.compile(r"[^ \t\n\r]+")


def whitespace_tokens(text: str) -> int:
    return sum(1 for _ in _TOKEN.finditer(text))


def packed_spans(lengths: Sequence[int], size: int, overlap: int, joint: int = 0) -> list[tuple[int, int]]:
    """Greedy packing of consecutive pieces into spans of at most ``size``.

    A span is as long as it can be (one piece may exceed ``size`` on its own). The next span
    always holds the piece that did not fit, preceded by as many trailing pieces as stay within
    ``overlap`` and still leave room for it. ``joint`` is the length of the separator.
    """
    # ends[i] is the length of the first i pieces, each with a separator after it.
    ends = [0, *accumulate(n + joint for n in lengths)]
    total = len(lengths)
    spans, start, must = [], 0, 1
    while must <= total:
        stop = max(must, bisect_right(ends, ends[start] + size + joint) - 1)
        spans.append((start, stop))
        if stop == total:
            break
        start = max(
            start,
            bisect_left(ends, ends[stop] - overlap - joint),
            min(stop, bisect_left(ends, ends[stop + 1] - size - joint)),
        )
        # Pieces without any tokens need not be carried past an oversized piece.
        start, must = min(start, stop), stop + 1
    return spans


def split_document(
    text: str,
    size: int = 300,
    overlap: int = 100,
    separator: str = "\n\n",
    count_tokens: Callable[[str], int] = whitespace_tokens,
) -> list[str]:
    """Chunks of whole pieces, at most ``size`` tokens unless one piece is longer."""
    pieces = [p for p in text.split(separator) if p]
    spans = packed_spans([count_tokens(p) for p in pieces], size, overlap, count_tokens(separator))
    chunks = (separator.join(pieces[a:b]).strip() for a, b in spans)
    return [c for c in chunks if c]


def split_code(text: str, size: int = 1000, overlap: int = 200) -> list[str]:
    """Slices of the text that end at code breaks; each starts with the last ``overlap``
    characters of the one before and has at most ``size`` unless one segment is longer."""
    # Segments and the separators between them, as end offsets.
    stops = [s for m in CODE_BREAK.finditer(text) for s in m.span()] + [len(text)]
    chunks, start, done = [], 0, 0
    while done < len(text):
        following = stops[bisect_right(stops, done)]
        fitting = bisect_right(stops, start + size) - 1
        stop = max(following, stops[fitting] if fitting >= 0 else 0)
        chunks.append(text[start:stop])
        start, done = max(start, stop - overlap), stop
    return chunks
