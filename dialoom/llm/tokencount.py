"""Exact token counts by prefix dynamic programming over byte-level BPE.

For a pre-token's bytes, ``count[i]`` is the number of tokens of the BPE encoding of its first ``i``
bytes. The encoding of a prefix is the encoding of a shorter prefix plus one last token, and a chain of
tokens is what the merges produce exactly if every neighbouring pair of it is; so for each end ``i`` the
last token is the one vocabulary entry that ends there and is compatible with the last token of the
prefix before it. One pass over the bytes gives counts for all prefixes.

Pre-tokens do not interact, so a text's table is the running sum of its pre-tokens' tables; only where
a cut changes how the end of the text splits (white-space runs, contractions) the last pieces are split
anew. The tables answer "how many tokens has this prefix" and "which prefix fits this budget" with no
further encoding.
"""

from __future__ import annotations

import functools
import re
from array import array
from bisect import bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import bpe
from .common import arrow_schema, map_arrow, struct_of, table, texts

#: Pre-tokens of a text whose characters all lie below this are split by the ``regex`` module; above it
#: the two libraries know different Unicode versions, so the tokenizer's own splitter is asked.
SAFE_BELOW = "\u0558"
_UNSAFE = re.compile(f"[{SAFE_BELOW}-\U0010ffff]")
_CONTRACTION = re.compile(r"'(?:s|t|re|ve|m|ll|d)\Z")
#: Entries of each table that a worker keeps over texts; a full one is emptied. Keys have LONG bytes at most
#: (pairs of tokens: twice the longest token), so a table stays below some 200 MB.
CACHE_ENTRIES = 800_000
#: Pre-tokens over this many bytes are counted in two arrays of their own, without entering any table.
LONG = 64


class PrefixCounter:
    """Token counts of all prefixes, for one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, special: str = bpe.SPECIAL, splitter=None):
        import regex

        self.ranks = ranks
        self.by_id = {v: k for k, v in ranks.items()}
        self.find = regex.compile(pattern).findall
        self.special = special
        self.splitter = splitter
        self.longest = max(map(len, ranks))
        self._made: dict[bytes, tuple[bytes, bytes]] = {}
        self._fits: dict[tuple[bytes, bytes], bool] = {}
        self._totals: dict[str, int] = {}
        self._prefix: dict[bytes, tuple[int, bytes]] = {}
        self._ends = None

    def _merge(self, piece: bytes, below: int = 1 << 60) -> list[bytes]:
        """BPE by its definition, the lowest-ranked neighbouring pair first, with the merges that rank below."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        rank = self.ranks.get
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: (rank(parts[i] + parts[i + 1], 1 << 60), i))
            if rank(parts[best] + parts[best + 1], 1 << 60) >= below:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def _halves(self, token: bytes) -> tuple[bytes, bytes]:
        """The two tokens whose merge made this one; a single byte is its own half."""
        known = self._made.get(token)
        if known is None:
            parts = [token] if len(token) == 1 else self._merge(token, self.ranks[token])
            known = self._made[token] = (parts[0], parts[-1])
        return known

    def _stay_apart(self, left: bytes, right: bytes) -> bool:
        """Whether merging leaves these two neighbours as they are.

        Undo merges next to the border, the latest first. A pair across the border that ranks before
        the merge just undone would have been joined then, so the two could not both have come about.
        """
        ranks, limit = self.ranks, 1 << 60
        while True:
            joined = ranks.get(left + right)
            if joined is not None and joined < limit:
                return False
            a, b = ranks[left], ranks[right]
            if len(left) == 1 and len(right) == 1:
                return True
            if len(right) == 1 or (len(left) > 1 and a > b):
                limit, left = a, self._halves(left)[1]
            else:
                limit, right = b + 1, self._halves(right)[0]

    def _compatible(self, left: bytes, right: bytes) -> bool:
        key = (left, right)
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) >= CACHE_ENTRIES:
                self._fits.clear()
            known = self._fits[key] = self._stay_apart(left, right)
        return known

    def piece_counts(self, piece: bytes) -> list[int]:
        """``counts[i]``: tokens of the first ``i`` bytes of one pre-token, for i from 0."""
        if len(piece) > LONG:
            return self._long(piece).tolist()
        self._reach(piece)
        return [0, *(self._prefix[piece[:i]][0] for i in range(1, len(piece) + 1))]

    def _long(self, piece: bytes) -> array:
        """The counts of a long pre-token: for each end the count and where the last token starts, four bytes each.

        An automaton of the vocabulary names the tokens that end at each byte, so the work grows with the
        length alone.
        """
        if self._ends is None:
            import ahocorasick

            self._ends = ahocorasick.Automaton()
            for token in self.ranks:
                self._ends.add_word(token.decode("latin-1"), len(token))
            self._ends.make_automaton()
        n, fits, compatible = len(piece), self._fits, self._compatible
        counts, starts = array("i", bytes(4 * (n + 1))), array("i", bytes(4 * (n + 1)))
        done = 0
        for last, size in self._ends.iter(piece.decode("latin-1")):
            end, start = last + 1, last + 1 - size
            if end == done:
                continue
            if start:
                before, token = piece[starts[start] : start], piece[start:end]
                if not (k if (k := fits.get((before, token))) is not None else compatible(before, token)):
                    continue
            counts[end], starts[end], done = counts[start] + 1, start, end
        return counts

    def _reach(self, piece: bytes) -> int:
        """Fill the table of prefixes up to the whole piece; what other pre-tokens began with is there already."""
        if len(piece) > LONG:
            return self._long(piece)[-1]
        table, ranks, fits, compatible = self._prefix, self.ranks, self._fits, self._compatible
        if len(table) >= CACHE_ENTRIES:
            table.clear()
        n = done = len(piece)
        while done and piece[:done] not in table:
            done -= 1
        for end in range(done + 1, n + 1):
            for start in range(max(0, end - self.longest), end):
                token = piece[start:end]
                if token in ranks:
                    if not start:
                        table[token] = (1, token)
                        break
                    count, before = table[piece[:start]]
                    if k if (k := fits.get((before, token))) is not None else compatible(before, token):
                        table[piece[:end]] = (count + 1, token)
                        break
        return table[piece][0]

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens of a text; special strings are pieces of their own."""
        if self.special in text:
            out = []
            for k, part in enumerate(text.split(self.special)):
                out += [self.special] * bool(k)
                out += self.pieces(part)
            return out
        if self.splitter is not None and not text.isascii() and _UNSAFE.search(text):
            return self.splitter(text)
        return self.find(text)

    def _total(self, piece: str) -> int:
        n = 1 if piece == self.special else self._reach(piece.encode())
        if len(piece) > LONG:
            return n
        if len(self._totals) >= CACHE_ENTRIES:
            self._totals.clear()
        self._totals[piece] = n
        return n

    def piece_totals(self, text: str) -> tuple[list[str], list[int]]:
        """The pre-tokens of the text with the last entry of each one's table."""
        pieces = self.pieces(text)
        known = self._totals
        totals = list(map(known.get, pieces))
        if None in totals:
            totals = [k if k is not None else (known.get(p) or self._total(p)) for p, k in zip(pieces, totals, strict=True)]
        return pieces, totals

    def prefix_counts(self, text: str) -> np.ndarray:
        """``counts[i]``: tokens of ``text[:i]`` for every i from 0 to len(text), exactly as encoded alone."""
        pieces, totals = self.piece_totals(text)
        out = np.zeros(len(text) + 1, dtype=np.int64)
        at, base = 0, 0
        for k, (piece, total) in enumerate(zip(pieces, totals, strict=True)):
            before = pieces[k - 1] if k else ""
            if piece == self.special:
                joint, start = (before, base - totals[k - 1]) if k else ("", base)
                for j in range(1, len(piece)):  # a cut string is ordinary text and joins what stands before it
                    out[at + j] = start + sum(self.piece_totals(joint + piece[:j])[1])
            else:
                raw = piece.encode()
                counts = self.piece_counts(raw)
                ends = np.cumsum([len(c.encode()) for c in piece]) if len(raw) != len(piece) else range(1, len(piece) + 1)
                out[at + 1 : at + len(piece) + 1] = [base + counts[e] for e in ends]
                if _CONTRACTION.match(piece):
                    for j in range(1, len(piece)):
                        out[at + j] = base + sum(self.piece_totals(piece[:j])[1])
                if before.isspace() and piece[0].isspace():
                    # a cut behind this first character leaves one white-space run, not two pieces
                    out[at + 1] = base - totals[k - 1] + sum(self.piece_totals(before + piece[0])[1])
            at += len(piece)
            base += total
            out[at] = base if not (before.isspace() and piece[0].isspace() and len(piece) == 1) else out[at]
        if pieces:
            out[at] = base
        return out

    def total(self, text: str) -> int:
        return sum(self.piece_totals(text)[1])

    def fitting_prefix(self, text: str, budget: int) -> int:
        """Characters of the longest run of whole pre-tokens from the start that has ``budget`` tokens at most."""
        pieces, totals = self.piece_totals(text)
        return self._fit(pieces, totals, budget)

    @staticmethod
    def _fit(pieces: list[str], totals: list[int], budget: int) -> int:
        k = bisect_right(list(accumulate(totals)), budget)
        return sum(map(len, pieces[:k]))


@functools.cache
def counter(ranks_path: str | None = None) -> PrefixCounter:
    """The counter of the 50k byte-level vocabulary, one in each Python worker."""
    import public_tokenizers

    split = bpe.library().pre_tokenizer.pre_tokenize_str
    return PrefixCounter(
        bpe.ranks(ranks_path), public_tokenizers.PATTERN, splitter=lambda text: [text[a:b] for _, (a, b) in split(text)]
    )


TOKEN_COUNTS = struct_of("doc_id long, n_bytes long, n_tokens long, over_limit boolean, fitting_chars long")


def count_tokens(docs: DataFrame, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_tokens, over_limit, fitting_chars``.

    ``over_limit`` says that the text has more than ``limit`` tokens; ``fitting_chars`` is the longest
    start of the text, in whole pre-tokens, that keeps to it. Null and empty texts have no token. Repeated rows
    are answered each; an empty table gives none; other columns are not read, so names that clash do no harm.
    Time and memory grow with a text's length, also where it is one single word.
    """
    out = arrow_schema(TOKEN_COUNTS)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = counter()
        n_bytes, n_tokens, fitting = [], [], []
        for text in texts(batch):
            pieces, totals = c.piece_totals(text)
            n = sum(totals)
            n_bytes.append(len(text.encode()))
            n_tokens.append(n)
            fitting.append(len(text) if n <= limit else c._fit(pieces, totals, limit))
        over = [n > limit for n in n_tokens]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_bytes), pa.array(n_tokens), pa.array(over), pa.array(fitting)], schema=out)

    rows = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"cast(`{text_col}` as string) as text")
    return map_arrow(rows, run, TOKEN_COUNTS)


def op6_token_counts(spark, sf_dir: str) -> DataFrame:
    """``count_tokens`` of ``documents`` with the limit of 1,024 tokens; cases as stated there."""
    return count_tokens(table(spark, sf_dir, "documents"))
