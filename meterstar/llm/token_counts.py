"""Edit-aware token counts: a segment tree of pre-token counts per document."""

from __future__ import annotations

import base64
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed: the pattern that splits text before the merges of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PIECES = regex.compile(PATTERN)
KNOWN = 400_000        # pre-tokens whose counts a worker remembers
LONG = 1000            # characters from which on a pre-token is merged without the encoder's own pattern, which fails on very long runs

# The cleaning that the query counts tokens before and after: runs of one mark shrink to it, long numbers to 0.
CLEANING = ((r"([!#$%&*])\1+", r"\1"), (r"\d{6,}", "0"))


def read_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Counter:
    """Tokens of pre-tokens, remembered."""

    def __init__(self, ranks: dict[bytes, int]):
        self.encoding = tiktoken.Encoding("counts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, int] = {}

    def __call__(self, piece: str) -> int:
        n = self.known.get(piece)
        if n is None:
            if len(self.known) >= KNOWN:
                self.known.clear()
            n = self.known[piece] = self._merged(piece)
        return n

    def _merged(self, piece: str) -> int:
        if len(piece) < LONG:
            return len(self.encoding.encode_ordinary(piece))
        return len(self.encoding._encode_single_piece(piece))  # a pre-token is one piece already


def pieces(text: str) -> list[str]:
    return _PIECES.findall(text)


class CountTree:
    """Token counts of a text's pre-tokens with all subtree sums; edits touch only what they change."""

    def __init__(self, text: str, count: Counter):
        self.text, self.count = text, count
        parts = pieces(text)
        self.starts = [0]
        for p in parts[:-1]:
            self.starts.append(self.starts[-1] + len(p))
        self.held = [[p] for p in parts]           # what each slot holds now
        self.size = 1 << max(0, (len(parts) - 1).bit_length()) if parts else 1
        self.sums = np.zeros(2 * self.size, np.int64)
        self.sums[self.size: self.size + len(parts)] = [count(p) for p in parts]
        at = self.size
        while at > 1:
            self.sums[at // 2: at] = self.sums[at: 2 * at].reshape(-1, 2).sum(axis=1)
            at //= 2
        self.encoded = 0                           # pre-tokens encoded again by edits

    @property
    def total(self) -> int:
        return int(self.sums[1])

    def _set(self, slots: range, values: list[int]) -> None:
        """New counts for neighbouring slots; sums are renewed once per subtree above them."""
        lo, hi = slots.start + self.size, slots.stop + self.size
        self.sums[lo:hi] = values
        while lo > 1:
            lo, hi = lo // 2, (hi + 1) // 2
            self.sums[lo:hi] = self.sums[2 * lo: 2 * hi].reshape(-1, 2).sum(axis=1)

    def apply(self, edits: list[tuple[int, int, str]]) -> None:
        """Apply edits (start, end, new text): ascending, not overlapping, places in the original text.

        A pre-token depends on its characters, the one behind it and, in blanks, on the whole run of
        blanks. So encoding starts again at the last pre-token that ends at or after the edit's start (or
        that of the blanks before it), and stops at the first old border, past the edit, that the new
        split also has. Edits with fewer than two slots between them go together.
        """
        groups: list[list] = []
        for start, end, new in edits:
            first = start
            while first and self.text[first - 1].isspace():
                first -= 1
            lo = max(0, bisect_left(self.starts, first) - 1)
            hi = max(lo + 1, bisect_right(self.starts, end))
            if groups and lo <= groups[-1][1] + 1:
                groups[-1][1] = max(groups[-1][1], hi)
                groups[-1][2].append((start, end, new))
            else:
                groups.append([lo, hi, [(start, end, new)]])
        # from the end, so that what lies behind a region is final and slots before it are untouched
        for lo, hi, own in reversed(groups):
            self._renew(lo, min(hi, len(self.held)), own)

    def _renew(self, lo: int, hi: int, edits: list[tuple[int, int, str]]) -> None:
        if not self.held:                          # an empty text has no slot yet
            self.held, self.starts = [[]], [0]
            hi = 1
        begin = self.starts[lo]
        end = self.starts[hi] if hi < len(self.starts) else len(self.text)
        out, at = [], begin
        for start, stop, new in edits:
            out += [self.text[at:start], new]
            at = stop
        changed = "".join(out) + self.text[at:end]
        more = 4
        while True:
            ahead = self.held[hi: hi + more]
            parts = pieces(changed + "".join(p for slot in ahead for p in slot))
            last = hi + more >= len(self.held)
            # borders of the slots behind the region, as places in the new stretch
            border, ends = len(changed), {}
            for j, slot in enumerate([*ahead, []]):
                ends.setdefault(border, hi + j)
                border += sum(map(len, slot))
            place, fresh, stop = 0, [], None
            for i, p in enumerate(parts):
                if place in ends and (last or i < len(parts) - 1):
                    stop = ends[place]
                    break
                fresh.append(p)
                place += len(p)
            if stop is None and last:
                stop = len(self.held)
            if stop is not None:
                break
            more *= 2
        self.encoded += len(fresh)
        self.held[lo] = fresh
        for j in range(lo + 1, stop):
            self.held[j] = []
        self._set(range(lo, max(stop, lo + 1)), [sum(map(self.count, fresh)), *[0] * (stop - lo - 1)])

    def edited(self) -> str:
        return "".join(p for slot in self.held for p in slot)


_CLEANERS = [(regex.compile(p), r) for p, r in CLEANING]


def cleaning_edits(text: str) -> list[tuple[int, int, str]]:
    found = sorted((m.start(), m.end(), m.expand(r)) for p, r in _CLEANERS for m in p.finditer(text))
    return [e for e in found if text[e[0]:e[1]] != e[2]]


def counted(docs: DataFrame, edits=cleaning_edits, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """Token counts of every whole text before and after ``edits`` (a function from a text to its edits).

    One pass with no shuffle. A text with edits gets a tree of its pre-tokens' counts; each edit
    encodes the pre-tokens that it touches and their boundary context again and renews the sums above
    them. The vocabulary file at ``vocabulary`` is read once by the driver and broadcast (50,256
    entries). Returns ``doc_id, n_tokens, n_edits, n_tokens_edited, n_encoded_again``; null or
    empty texts count 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                changes = edits(text) if text else []
                if changes:
                    tree = CountTree(text, counter)
                    before = tree.total
                    tree.apply(changes)
                    rows.append((before, len(changes), tree.total, tree.encoded))
                else:
                    n = sum(map(counter, pieces(text))) if text else 0
                    rows.append((n, 0, n, 0))
            cols = np.array(rows, np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, cols)],
                                             ["doc_id", "n_tokens", "n_edits", "n_tokens_edited", "n_encoded_again"])

    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(count, f"doc_id {kind}, n_tokens long, n_edits long, n_tokens_edited long, n_encoded_again long")
