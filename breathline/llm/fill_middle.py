"""Fill-in-middle: texts are cut into prefix, middle and suffix at ends of units and put together in another order.

A slice of texts is one sequence of code points. A wavelet matrix over their character classes tells how many
characters of a class stand before a place; the counts of the classes that end a unit add up to the units that
are complete there. The two cuts of every text are found together, by bisection on those counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from breathline.llm.base import documents, slices

OTHER, BLANK, STOP, NEWLINE = range(4)
BITS = (1, 0)

# Classes whose characters end a unit; what follows the last of them is a unit too.
UNITS = {"lines": (NEWLINE,), "sentences": (STOP, NEWLINE), "words": (BLANK, NEWLINE)}

# White space beside the line feed, and marks that end sentences.
BLANKS = [0x09, *range(0x0B, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
          0x205F, 0x3000]
STOPS = [0x21, 0x2E, 0x3F]

CLASS_OF = np.full(0x3002, OTHER, dtype=np.uint8)
CLASS_OF[BLANKS], CLASS_OF[STOPS], CLASS_OF[0x0A] = BLANK, STOP, NEWLINE

MARKERS = ("<P>", "<S>", "<M>")
SLICE_BYTES = 4 << 20

MADE = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


class Bits:
    """A sequence of bits that counts its ones before any place: totals per 64 bits, and one word's own bits."""

    def __init__(self, bits: np.ndarray):
        packed = np.zeros((len(bits) // 64 + 1) * 8, dtype=np.uint8)
        packed[: (len(bits) + 7) // 8] = np.packbits(bits, bitorder="little")
        self.words = packed.view("<u8")
        self.before = np.zeros(len(self.words), dtype=np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def ones(self, places: np.ndarray) -> np.ndarray:
        word = places >> 6
        lower = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & lower)


class WaveletMatrix:
    """Symbols of two bits. Each level holds one bit of every symbol, in the order that the levels above left:
    zeros of a level come before its ones in the next."""

    def __init__(self, symbols: np.ndarray):
        self.levels = []
        for bit in BITS:
            bits = (symbols >> bit) & 1
            self.levels.append((Bits(bits), len(bits) - int(bits.sum())))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])

    def rank(self, symbol: int, places: np.ndarray) -> np.ndarray:
        """How often the symbol stands before each place."""
        low, high = np.zeros(1, dtype=np.int64), places
        for bit, (bits, zeros) in zip(BITS, self.levels):
            if symbol >> bit & 1:
                low, high = zeros + bits.ones(low), zeros + bits.ones(high)
            else:
                low, high = low - bits.ones(low), high - bits.ones(high)
        return high - low


class Units:
    """The units of the texts of one slice, which lie between ``starts`` and ``ends``."""

    def __init__(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: str):
        self.classes = UNITS[kind]
        symbols = CLASS_OF[np.minimum(codes, len(CLASS_OF) - 1)]
        self.matrix = WaveletMatrix(symbols)
        self.starts, self.ends = starts, ends
        self.at_start = self._ended(starts)
        last = np.where(ends > starts, ends - 1, 0)
        open_end = (ends > starts) & ~np.isin(symbols[last] if len(symbols) else last, self.classes)
        self.counts = self._ended(ends) - self.at_start + open_end

    def _ended(self, places: np.ndarray) -> np.ndarray:
        return sum(self.matrix.rank(symbol, places) for symbol in self.classes)

    def cut(self, units: np.ndarray) -> np.ndarray:
        """The first place of each text where that many of its units are complete; its end if there is none."""
        wanted = self.at_start + units
        low, high = self.starts.copy(), self.ends.copy()
        while (low < high).any():
            middle = (low + high) >> 1
            enough = self._ended(middle) >= wanted
            high = np.where(enough, middle, high)
            low = np.where(enough, low, np.minimum(middle + 1, high))
        return low


def _checked(markers: tuple[str, str, str]) -> tuple[str, str, str]:
    """A marker that could begin in another one, or in a text's end before it, could not be found again."""
    for one in markers:
        for other in markers:
            shorter = range(1, min(len(one), len(other)) + (one != other))
            if not one or (one != other and one in other) or any(one[-size:] == other[:size] for size in shorter):
                raise ValueError(f"the markers {one!r} and {other!r} overlap")
    return markers


def _draws(seed: int, doc_id: int | None) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[at:at + 8], 16) for at in range(0, 32, 8)]


def fill_in_middle(
    docs: DataFrame, unit: str = "lines", seed: int = 7, percent: int = 100, spm_percent: int = 50,
    markers: tuple[str, str, str] = MARKERS,
) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars (code points) and output of every whole text.

    ``form`` is psm (prefix, suffix, middle), spm (suffix, prefix, middle) or plain: the text as it is, with null
    lengths, when it is empty, holds one of the ``markers`` or is not among ``percent`` of 100 drawn by doc_id. Null
    texts count as empty (no units); a null doc_id draws like an id without digits; repeated rows are made alike;
    other columns are ignored; an empty table gives no rows. A text of any length is cut as a whole.
    """
    begin, after, between = _checked(tuple(markers))

    def make(ids: list[int | None], texts: list[str]) -> pa.RecordBatch:
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        ends = np.cumsum(lengths)
        starts = ends - lengths
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        units = Units(codes, starts, ends, unit)
        draws = np.array([_draws(seed, doc_id) for doc_id in ids], dtype=np.int64).reshape(-1, 4)
        chosen = np.sort(draws[:, :2] % (units.counts[:, None] + 1), axis=1)
        first, second = (units.cut(chosen[:, which]) - starts for which in (0, 1))
        rows = []
        for text, one, two, third, fourth in zip(texts, first.tolist(), second.tolist(), draws[:, 2], draws[:, 3]):
            if not text or third % 100 >= percent or any(marker in text for marker in markers):
                rows.append(("plain", None, None, text))
                continue
            prefix, middle, suffix = text[:one], text[one:two], text[two:]
            if fourth % 100 < spm_percent:
                rows.append(("spm", one, two - one, f"{after}{suffix}{begin}{prefix}{between}{middle}"))
            else:
                rows.append(("psm", one, two - one, f"{begin}{prefix}{after}{suffix}{between}{middle}"))
        form, prefix_chars, middle_chars, output = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(units.counts, pa.int64()), pa.array(form, pa.string()),
             pa.array(prefix_chars, pa.int64()), pa.array(middle_chars, pa.int64()), pa.array(output, pa.string())],
            names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
        )

    def transform(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                yield make(part.column(0).to_pylist(), part.column(1).to_pylist())

    return documents(docs).mapInArrow(transform, MADE)


def restored(form: Column, output: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that an output was made from: its pieces, found by the markers, in their first order. Null where
    form or output is null."""
    begin, after, between = (F.lit(marker) for marker in _checked(tuple(markers)))
    second = F.lit(2)

    def piece(marker: Column, following: Column) -> Column:
        return F.split_part(F.split_part(output, marker, second), following, F.lit(1))

    middle = F.split_part(output, between, second)
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(piece(begin, after), middle, piece(after, between)))
        .when(form == "spm", F.concat(piece(begin, between), middle, piece(after, begin)))
    )
