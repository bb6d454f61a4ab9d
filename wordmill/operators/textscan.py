"""Word scanning and look-ups on Arrow batches.

The tasks cut a bounded slice of lower-cased texts into words at once, by the
classes of their bytes, and count words or look them up in a bounded table that
was broadcast. Spark reads, partitions, joins and sums; a batch is all that a
function here sees. The words are those of ``functions.text.TOKEN_PATTERN``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20  # text or list elements worked at a time (one row at least)

# Classes of UTF-8 bytes: 0 space, 1 word character, 2 first byte of any other
# character, 3 one of its further bytes.
_WORD = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz"
_CLASS = np.array(
    [0 if c in b"\t\n\f\r " else 1 if c in _WORD else 3 if 0x80 <= c < 0xC0 else 2 for c in range(256)], np.uint8
)


def slices(sizes: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``most`` in all; a larger row is a run of its own."""
    sizes = np.asarray(sizes, np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        done = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield at, end
        at = end


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets from 0, bytes) of a string array; a null text is empty."""
    col = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = col.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return offsets - offsets[0], data


def _starts(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class, word starts here) of every byte."""
    kind = _CLASS[data]
    word = kind == 1
    begin = word.copy()
    begin[1:] &= ~word[:-1]
    edge = offsets[:-1][offsets[:-1] < len(data)]
    begin[edge] = word[edge]
    return kind, begin | (kind == 2)


def _per_text(offsets: np.ndarray, begin: np.ndarray) -> np.ndarray:
    before = np.concatenate([[0], np.cumsum(begin, dtype=np.int64)])
    return before[offsets[1:]] - before[offsets[:-1]]


def count_words(texts: pa.Array) -> np.ndarray:
    """The number of words of each lower-cased text."""
    if not len(texts):
        return np.zeros(0, np.int64)
    offsets, data = _bytes(texts)
    return _per_text(offsets, _starts(offsets, data)[1])


def split_texts(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(number of words of each lower-cased text, all words in a row)."""
    if not len(texts):
        return np.zeros(0, np.int64), pa.array([], pa.large_string())
    offsets, data = _bytes(texts)
    kind, begin = _starts(offsets, data)
    kept = kind != 0
    before = np.cumsum(kept, dtype=np.int64)
    at = np.flatnonzero(begin)
    ends = np.concatenate([before[at] - 1, before[-1:] if len(before) else np.zeros(1, np.int64)])
    words = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data[kept].tobytes()))
    return _per_text(offsets, begin), words


def first_places(keys: pa.Array, counts: np.ndarray, words: pa.Array) -> pa.Table:
    """(key, pos, token, n): every word of the texts once, with its occurrences
    and its first place in the order of (key, pos), null keys first."""
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy()
    row = np.repeat(np.arange(len(counts)), counts)
    pos = np.arange(len(codes)) - np.repeat(np.cumsum(counts) - counts, counts)
    gone = keys.is_null().to_numpy(zero_copy_only=False)
    plain = pc.fill_null(keys, 0).to_numpy(zero_copy_only=False)
    order = np.lexsort((plain, ~gone))
    new = np.ones(len(order), bool)
    new[1:] = (plain[order][1:] != plain[order][:-1]) | (gone[order][1:] != gone[order][:-1])
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)
    if (np.diff(rank) > 0).all():
        by_place = np.arange(len(codes))
    elif new.all():
        # Each key once: the words of the texts, text by text in the order of the keys.
        size, start = np.asarray(counts, np.int64)[order], (np.cumsum(counts) - counts)[order]
        by_place = np.arange(len(codes)) + np.repeat(start - (np.cumsum(size) - size), size)
    else:
        by_place = np.lexsort((pos, rank[row]))
    # Written from the last place to the first: the first one stays.
    first = np.zeros(len(coded.dictionary), np.int64)
    first[codes[by_place[::-1]]] = by_place[::-1]
    return pa.table(
        {
            "key": keys.take(pa.array(row[first])),
            "pos": pa.array(pos[first], pa.int64()),
            "token": coded.dictionary.cast(pa.string()),
            "n": pa.array(np.bincount(codes, minlength=len(first)), pa.int64()),
        }
    )


def list_of(counts: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), values)


def look_up(counts: np.ndarray, items: pa.Array, keys: pa.Array, values: pa.Array, name: str = "item") -> tuple[pa.Array, pa.Array]:
    """Lists of items looked up: (values, null where ``keys`` lack the item; the
    items that were not found, with their places)."""
    counts = np.asarray(counts, np.int64)
    at = pc.index_in(items, value_set=keys)
    miss = at.is_null().to_numpy(zero_copy_only=False)
    lost = np.flatnonzero(miss)
    row = np.repeat(np.arange(len(counts)), counts)
    pos = lost - (np.cumsum(counts) - counts)[row[lost]]
    small = items.take(pa.array(lost))
    rest = pa.StructArray.from_arrays([pa.array(pos, pa.int32()), small], names=["pos", name])
    return list_of(counts, values.take(at)), list_of(np.bincount(row[lost], minlength=len(counts)), rest)


def fill(near: pa.ListArray, far: pa.ListArray) -> pa.Array:
    """near with its nulls replaced, in their order, by the elements of far,
    which has one for each."""
    counts = np.asarray(pc.fill_null(pc.list_value_length(near), 0))
    flat = near.flatten()
    return list_of(counts, pc.replace_with_mask(flat, flat.is_null(), far.flatten().cast(flat.type)))
