"""Operator 2: packing token documents into fixed windows by minimum bin slack.

Every document is tokenised and ended with one end id. Whole windows are cut off its front as sequences of their
own. What remains (shorter than a window) is packed by minimum bin slack: a window takes the longest remaining
length, then a subset-sum dynamic program over the multiset of remaining lengths, held as a bitset in one Python
integer, finds the selection that leaves the least slack; backtracking gives how many of each length it takes. The
selection is reused as often as the counts allow, so the work follows the number of distinct lengths.

The multiset is that of one input partition: packing needs no shuffle, no key can be hot, memory follows the split
size, and only the last window of a partition is left noticeably short. A lost task is recomputed from the same
split, with the same sequence ids (partition number in the high bits). The input's partitions must therefore be
reproducible, as those of a file scan are.

``pack_in_order`` follows an order that the rows have instead: slices of it go to the partitions one after the other, and each
``slice_windows`` windows of remaining lengths are packed by themselves, so the sequence ids keep the order up to a slice.

Defined results: a null or empty text is a document of the end id alone; empty input gives no rows; repeated rows
are packed once each; null ids are passed on; a document of any length is cut at window boundaries; extra columns
are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geofleet.llm.common import for_workers

END_ID = 2
WINDOW = 4096
#: Remaining lengths of so many windows are packed together where an order is followed.
SLICE_WINDOWS = 64

#: Characters whose splitting or lower-casing differs between Python and the tokenizer: such texts go to it whole.
_WHOLE = "\x1c\x1d\x1e\x1fΣİ"
#: A lower-case word, by itself one pre-token and stable under the tokenizer's normalisation, and one mark after it.
_WORD = re.compile("([a-zß-öø-ÿ]+)([.,]?)")


def pack_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordTokenizer:
    """Ids of texts under a word-level BPE tokenizer file, with a cache of words.

    White space never crosses a pre-token, so a text's ids are its words' ids in a row. A plain word skips the
    normaliser and goes to the BPE model directly; every other word goes through the tokenizer. A text that holds the string of
    one of the file's added tokens, in whatever case, goes to it whole: there the raw text decides what is such a token.
    ``cache_words`` bounds the memory; a full cache is emptied.
    """

    def __init__(self, path: str, cache_words: int = 600_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.model._resize_cache(0)  # the words are cached here already; filling its own cache doubles the time
        self.cache: dict[str, bytes] = {}
        self.cache_words = cache_words
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.byte_chars = {b: chr(256 + n) for n, b in enumerate(hidden)}
        self.marks = {m: self._whole(m) for m in (".", ",")} | {"": b""}

    def _whole(self, text: str) -> bytes:
        return pack_ids(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        m = _WORD.fullmatch(word)
        if not m:
            return self._whole(word)
        plain, mark = m.groups()
        if mark and plain in self.cache:
            return self.cache[plain] + self.marks[mark]
        symbols = plain if plain.isascii() else plain.encode().decode("latin-1").translate(self.byte_chars)
        return pack_ids([t.id for t in self.model.tokenize(symbols)]) + self.marks[mark]

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        lowered = text.lower()
        if any(c in text for c in _WHOLE) or any(t in lowered for t in self.added):
            return self._whole(text)
        cache, words = self.cache, lowered.split()
        try:
            return b"".join(map(cache.__getitem__, words))
        except KeyError:
            pass
        if len(cache) > self.cache_words:
            cache.clear()
        new = {w: self._word(w) for w in set(words) if w not in cache}
        cache.update(new)
        return b"".join(map(cache.__getitem__, words))


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer_at(path: str) -> WordTokenizer:
    """One tokenizer per Python worker and file."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def fill(lengths: Iterable[tuple[int, int]], room: int) -> list[tuple[int, int]]:
    """Of the multiset ``lengths`` [(length, count)], the selection [(length, taken)] whose sum is closest to ``room``.

    Bit s of an integer says that sum s can be reached. Counts are bounded by splitting them in powers of two;
    the bitset before each part is kept for the backtracking. Stops when ``room`` is reached exactly.
    """
    reach, mask, parts = 1, (1 << (room + 1)) - 1, []
    for length, count in lengths:
        count = min(count, room // length)
        size = 1
        while count > 0:
            n = min(size, count)
            parts.append((length, n, reach))
            reach |= (reach << (length * n)) & mask
            count -= n
            size *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    taken: dict[int, int] = {}
    for length, n, before in reversed(parts):
        if not before >> total & 1:
            taken[length] = taken.get(length, 0) + n
            total -= length * n
    return list(taken.items())


def minimum_bin_slack(counts: dict[int, int], window: int) -> Iterator[tuple[list[tuple[int, int]], int]]:
    """Windows [(length, taken)] and how many times each is made, until the multiset ``counts`` is used up."""
    left, order = dict(counts), sorted(counts)
    while order:
        longest = order[-1]
        left[longest] -= 1
        room = window - longest
        below = (order[i] for i in range(bisect_right(order, room) - 1, -1, -1))
        chosen = dict(fill(((k, left[k]) for k in below if left[k]), room))
        left[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(left[k] // n for k, n in chosen.items())
        for k, n in chosen.items():
            left[k] -= n * times
            if not left[k]:
                del order[bisect_left(order, k)]
        yield sorted(chosen.items(), reverse=True), times


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _pack_partition(frames: Iterator[pd.DataFrame], encode: Callable[[str], bytes], window: int, end_id: int,
                    first_sequence: int, slice_windows: int | None = None) -> Iterator[pd.DataFrame]:
    end = pack_ids([end_id])
    sequence = first_sequence
    tails: dict[int, list[tuple]] = {}
    held = 0

    def flush() -> Iterator[list[tuple]]:
        nonlocal sequence
        rows = []
        for chosen, times in minimum_bin_slack({k: len(v) for k, v in tails.items()}, window):
            for _ in range(times):
                offset = 0
                for length, n in chosen:
                    for _ in range(n):
                        rows.append((*tails[length].pop(), sequence, offset))
                        offset += length
                sequence += 1
            if len(rows) > 50_000:
                yield rows
                rows = []
        tails.clear()
        yield rows

    for frame in frames:
        rows = []
        for doc, text in zip(frame["doc_id"], frame["text"], strict=True):
            ids = (encode(text) if isinstance(text, str) else b"") + end
            total = len(ids) // 4
            whole = total // window
            for k in range(whole):
                rows.append((doc, k * window, window, zlib.crc32(ids[4 * k * window:4 * (k + 1) * window]), total, sequence, 0))
                sequence += 1
            if rest := total - whole * window:
                tails.setdefault(rest, []).append((doc, whole * window, rest, zlib.crc32(ids[4 * whole * window:]), total))
                held += rest
            if slice_windows and held >= slice_windows * window:
                for packed in flush():
                    rows += packed
                held = 0
        yield _pieces(rows)
    for rows in flush():
        yield _pieces(rows)


def _pieces(rows: list[tuple]) -> pd.DataFrame:
    names = [c.split()[0] for c in PIECES.split(", ")]
    out = pd.DataFrame(rows, columns=names)
    return out.astype({c: "Int64" for c in names})


def pack(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         end_id: int = END_ID, slice_windows: int | None = None) -> DataFrame:
    """One row per piece: ``PIECES``. See the module's text for the method and the defined results."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 32
        yield from _pack_partition(frames, tokenizer_at(tokenizer_path).encode, window, end_id, first, slice_windows)

    narrow = for_workers(df).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInPandas(run, PIECES)


def pack_in_order(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                  end_id: int = END_ID, slice_windows: int = SLICE_WINDOWS) -> DataFrame:
    """``pack`` of Parquet files that Spark wrote, in the order of their rows: sequence ids follow it up to a slice.

    A scan deals file splits by size, so the rows are put back by file number and row index, in one shuffle by range.
    """
    name = F.col("_metadata.file_name")
    number = lambda pattern: F.regexp_extract(name, pattern, 1).try_cast("long")
    placed = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), number("^part-([0-9]+)").alias("_part"),
                       number("-c([0-9]+)[.]").alias("_file"), name.alias("_name"), F.col("_metadata.row_index").alias("_row"))
    order = ["_part", "_file", "_name", "_row"]
    return pack(placed.repartitionByRange(*order).sortWithinPartitions(*order), tokenizer_path, window=window, end_id=end_id, slice_windows=slice_windows)
