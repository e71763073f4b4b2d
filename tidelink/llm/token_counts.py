"""Token counts by byte-pair merging, without making token ids.

A text is turned into the merge alphabet of the vocabulary (one mark for a
space, one before the text) and cut where no vocabulary piece can cross.
Each cut is merged with a heap of adjacent pairs over a linked list: the
best-ranked, then leftmost, pair is popped and merged until none is left;
its count is its initial symbols less its merges. Counts of cuts are kept
in a bounded two-generation cache per Python worker.

Defined results: null counts as the empty text, which has no tokens; special
strings inside a text are ordinary text; any length is counted whole.
"""

from __future__ import annotations

import re
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelink.llm.common import public_path

MARK = "▁"
CACHE_ENTRIES = 300_000
CACHE_LENGTH = 64


class PieceCounter:
    """Counts the pieces of texts under one piece vocabulary."""

    def __init__(self, model_path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.rank = {model.id_to_piece(i): -model.get_score(i) for i in range(model.get_piece_size())
                     if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))}
        if any(MARK in p.lstrip(MARK) for p in self.rank):
            raise ValueError("a piece has a space mark inside; texts cannot be cut at spaces")
        # a character of no piece merges with nothing: the text is cut there too
        lone = "".join(c for c in "\n\t\r" if not any(c in p for p in self.rank))
        self.cuts = re.compile(f"{MARK}*[^{MARK}{lone}]+|{MARK}+" + (f"|[{lone}]" if lone else ""))
        self.recent: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        recent, total = self.recent, 0
        for cut in self.cuts.findall(MARK + text.replace(" ", MARK)):
            n = recent.get(cut)
            if n is None:
                n = self.remembered(cut)
                recent = self.recent
            total += n
        return total

    def remembered(self, cut: str) -> int:
        n = self.older.get(cut)
        if n is None:
            n = self.merged_count(cut)
        if len(cut) <= CACHE_LENGTH:
            if len(self.recent) >= CACHE_ENTRIES:
                self.recent, self.older = {}, self.recent
            self.recent[cut] = n
        return n

    def merged_count(self, s: str) -> int:
        rank, n = self.rank, len(s)
        symbols = sum(1 if c in rank else len(c.encode("utf-8", "surrogatepass")) for c in s)
        if n == 1:
            return symbols
        piece: list[str | None] = list(s)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, 2) for i in range(n - 1) if (r := rank.get(s[i:i + 2])) is not None]
        heapify(heap)
        merges = 0
        while heap:
            _, i, length = heappop(heap)
            left, j = piece[i], after[i]
            if left is None or j >= n or len(left) + len(piece[j]) != length:
                continue  # one of the two has been merged since
            whole = piece[i] = left + piece[j]
            piece[j] = None
            k = after[i] = after[j]
            merges += 1
            if k < n:
                before[k] = i
                wider = whole + piece[k]
                if (r := rank.get(wider)) is not None:
                    heappush(heap, (r, i, len(wider)))
            b = before[i]
            if b >= 0:
                wider = piece[b] + whole
                if (r := rank.get(wider)) is not None:
                    heappush(heap, (r, b, len(wider)))
        return symbols - merges


@lru_cache(maxsize=2)
def counter(model_path: str) -> PieceCounter:
    """One counter per Python worker and vocabulary file."""
    return PieceCounter(model_path)


def token_count(text: Column, model_path: str | None = None) -> Column:
    """Number of tokens of a text column (long, never null)."""
    path = model_path or public_path("piece_bpe_32k.model")

    @F.pandas_udf(T.LongType())
    def counted(texts: pd.Series) -> pd.Series:
        count = counter(path).count
        return pd.Series([count(t) for t in texts], dtype="int64")

    return counted(text)
