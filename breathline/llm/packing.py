"""Sequence packing: Karmarkar-Karp multiway differencing into near-equal windows.

A document's token ids end with one end mark. Whole windows' worth of a long document are sequences of their
own; the rest is cut into pieces of at most ``piece`` ids, and the pieces of a block of documents are dealt out
by multiway differencing: every piece starts as a partition with one loaded window, and the two partitions of
the largest spread are merged, the fullest windows of one onto the emptiest of the other, until one is left.
If its fullest window exceeds the capacity, the number of windows rises and the block is dealt anew.

Each input partition packs by itself, block after block, so nothing is shuffled and a task holds one block.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from breathline.llm.base import documents

CAPACITY = 2048
PIECE = 512
BLOCK = 1024
END_ID = 1

SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
ARROW = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()),
])


class Tokens:
    """Ids of whole texts under a byte-level vocabulary file of the tokenizers library.

    The vocabulary's ids are in merge order, so a rank encoder gives the same ids several times faster; the
    tests hold them against the library itself. Texts that may spell a special token go to the library."""

    def __init__(self, path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        letters = {letter: number for number, letter in _byte_letters()}
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        added = {token.content for token in self.library.get_added_tokens_decoder().values()}
        ranks = {
            bytes(letters[letter] for letter in token): number
            for token, number in vocabulary.items() if token not in added
        }
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        if "<|" in text:
            return _packed(self.library.encode(text, add_special_tokens=False).ids)
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


def _byte_letters() -> list[tuple[int, str]]:
    """The letter that a byte-level vocabulary writes for each byte: printable bytes stand for themselves, the
    others for the code points from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [number for number in range(256) if number not in printable]
    return [*((n, chr(n)) for n in printable), *((n, chr(256 + place)) for place, n in enumerate(others))]


def differenced(sizes: np.ndarray, windows: int) -> np.ndarray:
    """The window of each size: Karmarkar-Karp differencing for any number of windows.

    A partition is its window loads in falling order. Merging pairs the first window of one with the last
    of the other; the pairing is remembered, and followed back from the last partition to the single pieces.
    """
    count = len(sizes)
    if windows <= 1 or count == 0:
        return np.zeros(count, dtype=np.int64)
    loads: list[np.ndarray | None] = []
    heap = []
    for piece in np.argsort(-sizes, kind="stable"):
        single = np.zeros(windows, dtype=np.int64)
        single[0] = sizes[piece]
        heap.append((-int(sizes[piece]), len(loads), int(piece)))
        loads.append(single)
    merged: dict[int, tuple[int, int, np.ndarray]] = {}
    leaf = {number: piece for _, number, piece in heap}
    heap = [(spread, number) for spread, number, _ in heap]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, one = heapq.heappop(heap)
        _, two = heapq.heappop(heap)
        joined = loads[one] + loads[two][::-1]
        order = np.argsort(-joined, kind="stable")
        joined = joined[order]
        loads[one] = loads[two] = None
        merged[len(loads)] = (one, two, order)
        heapq.heappush(heap, (int(joined[-1] - joined[0]), len(loads)))
        loads.append(joined)
    result = np.zeros(count, dtype=np.int64)
    stack = [(heap[0][1], np.arange(windows))]
    while stack:
        number, names = stack.pop()
        if number in leaf:
            result[leaf[number]] = names[0]
            continue
        one, two, order = merged.pop(number)
        placed = np.empty(windows, dtype=np.int64)
        placed[order] = names
        stack.append((one, placed))
        stack.append((two, placed[::-1]))
    return result


def dealt(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The window of each size, no window above ``capacity``: as few as differencing can keep within it."""
    windows = max(1, math.ceil(int(sizes.sum()) / capacity))
    while True:
        window = differenced(sizes, windows)
        if len(sizes) == 0 or np.bincount(window, weights=sizes).max() <= capacity:
            return window
        windows += 1


def _cuts(length: int, capacity: int, piece: int) -> Iterator[tuple[int, int]]:
    start = 0
    while length - start >= capacity:
        yield start, capacity
        start += capacity
    while start < length:
        taken = min(piece, length - start)
        yield start, taken
        start += taken


def packer(path: str, pattern: str, capacity: int, piece: int, block: int, end_id: int):
    """The function that packs one input partition."""

    def pack_partition(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(path, pattern)
        end = np.array([end_id], dtype="<u4").tobytes()
        following = TaskContext.get().partitionId() << 33
        pending: list[tuple] = []
        done: list[tuple] = []

        def pack_pending() -> None:
            nonlocal following, pending
            window = dealt(np.array([row[2] for row in pending], dtype=np.int64), capacity)
            filled: dict[int, int] = {}
            for row, place in zip(pending, window.tolist()):
                offset = filled.get(place, 0)
                filled[place] = offset + row[2]
                done.append((*row[:4], following + place, offset, row[4]))
            following += int(window.max()) + 1
            pending = []

        def rows() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays(
                [pa.array(column, type=field.type) for column, field in zip(zip(*done), ARROW)], schema=ARROW
            )
            done.clear()
            return made

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = tokens.encode(text) + end
                    total = len(ids) // 4
                    for start, length in _cuts(total, capacity, piece):
                        cut = ids[4 * start:4 * (start + length)]
                        if length == capacity:
                            done.append((doc_id, start, length, total, following, 0, cut))
                            following += 1
                        else:
                            pending.append((doc_id, start, length, total, cut))
                            if len(pending) >= block:
                                pack_pending()
                if done:
                    yield rows()
        if pending:
            pack_pending()
        if done:
            yield rows()

    return pack_partition


def pack(
    docs: DataFrame, tokenizer: str, pattern: str, capacity: int = CAPACITY, piece: int = PIECE,
    block: int = BLOCK, end_id: int = END_ID,
) -> DataFrame:
    """Pieces of documents with their ids (little-endian unsigned 32-bit), sequence and offset in it.

    Null or empty text: one piece that holds the end mark alone. Repeated rows are packed once each. An empty
    table gives no rows; columns other than doc_id and text are ignored. A text of any length is cut into
    whole sequences and a rest. Ties between equal spreads are broken by age, so a block always packs alike.
    """
    return documents(docs).mapInArrow(packer(tokenizer, pattern, capacity, piece, block, end_id), SCHEMA)


def digest(packed: DataFrame) -> DataFrame:
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
