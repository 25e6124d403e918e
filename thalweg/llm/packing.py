"""Packing token ids into windows by multiway differencing.

A document's ids, ended by one separator, are cut into whole windows and a rest; the rest is cut into fragments of at
most ``fragment`` ids. Fragments of some thousands are packed at a time: Karmarkar and Karp's differencing keeps partial
partitions into k windows, and always merges the two with the largest differences, the fullest window of one with the
emptiest of the other. Where a window exceeds the capacity, k rises and the differencing begins anew. All happens
within the partitions of the input: no shuffle, and a task holds the texts of one batch and the fragments of one group.

Nulls: a null text is empty (its one id is the separator); null and repeated ids are kept, each row is a document. An
empty table gives an empty result. Other columns than the key and the text are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from bisect import insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import need

#: Fixed value: the split into pieces that byte-level vocabularies of 50k entries are made for.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Texts are encoded in parts of about as many characters, cut where pieces end in any case.
PART = 1 << 20
_CUT = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")


@dataclass(frozen=True)
class Windows:
    capacity: int = 1024
    fragment: int = 512
    group: int = 4096
    separator: int = 0


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies spell each byte as a letter: printable ones as themselves, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[str], list[int]]:
    """Ids of a text by the byte-level vocabulary file at ``path``, without added special tokens.

    Texts that spell a special token go through the file's own tokenizer; all others through a faster one of the same
    vocabulary and merges.
    """
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {x["content"] for x in spec["added_tokens"]}
    letters = _byte_letters()
    ranks = {bytes(letters[c] for c in k): v for k, v in spec["model"]["vocab"].items() if k not in special}
    fast = tiktoken.Encoding("file", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
    exact = Tokenizer.from_file(path)

    def encode(text: str) -> list[int]:
        if any(s in text for s in special):
            return exact.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def parts(text: str, size: int = PART) -> Iterator[str]:
    """The text in parts that are encoded alike alone or together: cut before single spaces between letters."""
    at = 0
    while len(text) - at > size and (m := _CUT.search(text, at + size)):
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


def _joined(a: list, b: list, k: int) -> list:
    """Two partial partitions as one: the fullest windows of ``b`` onto the emptiest of ``a``; windows by rising sums."""
    if len(a) < len(b):
        a, b = b, a
    free = k - len(a)  # empty windows of a
    down = b[::-1]
    new = down[:free] + [
        (x[0] + y[0], x[1], x[2] + y[2]) for x, y in zip(a, down[free:], strict=False)
    ]
    a = a[max(0, len(b) - free) :]
    if len(new) > 8:
        return sorted(a + new, key=itemgetter(0, 1))
    for window in new:
        insort(a, window, key=itemgetter(0, 1))
    return a


def _difference(sizes: list[int], k: int) -> list[list[int]]:
    """Partition of the items into k windows of near-equal sums, by multiway differencing.

    A partial partition holds its windows that aren't empty as (sum, first item, items).
    """
    heap = [(-s, i, [(s, i, [i])]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    made = len(heap)
    while len(heap) > 1:
        a = _joined(heapq.heappop(heap)[2], heapq.heappop(heap)[2], k)
        least = a[0][0] if len(a) == k else 0
        heapq.heappush(heap, (least - a[-1][0], made, a))
        made += 1
    return [items for _, _, items in heap[0][2]] if heap else []


def pack(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of items, none above the capacity; as few as differencing finds."""
    k = -(-sum(sizes) // capacity)
    while True:
        windows = _difference(sizes, max(k, 1))
        if all(sum(sizes[i] for i in w) <= capacity for w in windows):
            return [w for w in windows if w]
        k += max(1, k // 400)


def pack_documents(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", windows: Windows = Windows()
) -> DataFrame:
    """One row for each piece: where it lies in its document and in its sequence, with the crc32 of its ids."""
    need(docs, key, text)
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, capacity = encoder(tokenizer), windows.capacity
        sequence = TaskContext.get().partitionId() << 40
        out: list[tuple] = []
        rests: list[tuple] = []

        def settle() -> None:
            nonlocal sequence
            for window in pack([x[2] for x in rests], capacity):
                offset = 0
                for i in window:
                    out.append((*rests[i], sequence, offset))
                    offset += rests[i][2]
                sequence += 1
            rests.clear()

        def flush() -> pa.RecordBatch:
            columns = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)] if out else [pa.array([], pa.int64())] * len(names)
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            for doc, whole in zip(batch.column(0), batch.column(1), strict=True):
                held = [np.array(encode(p), dtype="<u4") for p in parts(whole.as_py() or "")]
                ids = np.concatenate([*held, np.array([windows.separator], dtype="<u4")])
                n, at, doc_id = len(ids), 0, doc.as_py()
                while at < n:
                    size = capacity if n - at >= capacity else min(windows.fragment, n - at)
                    piece = (doc_id, at, size, zlib.crc32(ids[at : at + size].tobytes()), n)
                    if size == capacity:
                        out.append((*piece, sequence, 0))
                        sequence += 1
                    else:
                        rests.append(piece)
                    at += size
                if len(rests) >= windows.group:
                    settle()
                if len(out) >= 50_000:
                    yield flush()
        if rests:
            settle()
        yield flush()

    return docs.select(docs[key].cast("long"), text).mapInArrow(run, SCHEMA)
