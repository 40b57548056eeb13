"""Best-fit packing: best-two-fit on token counts.

Documents are tokenised in Arrow batches; the ids of a white-space-separated chunk do not depend on its neighbours, so
each chunk is encoded once per cache and documents are put together from chunks. Only piece lengths go on to
packing. Pieces are dealt to groups of about GROUP_PIECES; a group is packed in one task, and costs at most one
sequence more than packing all pieces at once. Null text is empty (one piece with the end id alone). Repeated
rows are packed as often as they occur.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larderlens.llm.chunks import ChunkCache
from larderlens.llm.common import settle, text_slices

CAPACITY = 2048
GROUP_PIECES = 16_384
END_ID = 0
MARK = b"\xff" * 4

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

_CACHES: dict[str, ChunkCache] = {}
_ENCODERS: dict[str, WordEncoder] = {}


class WordEncoder:
    """Ids of chunks without white space, by the tokenizer of a file.

    Most chunks consist of Latin letters, digits and ASCII signs. For these, and for the tokenizer's usual way of
    splitting, the parts that its model sees are found here and each distinct part goes to the model once. All other
    chunks go through the whole tokenizer.
    """

    # The steps before the model for which the short way holds.
    STEPS = (
        {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
        {"type": "Sequence", "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ]},
    )
    PLAIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ0-9!-&(-/:;=-@\[-`{-~]+")
    PARTS = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|\n|[^a-zß-öø-ÿ0-9\n]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        spec = json.loads(self.tokenizer.to_str())
        # PLAIN leaves out the sign that every added token begins with.
        begin = all(t["content"].startswith("<") for t in spec["added_tokens"])
        self.short = begin and (spec["normalizer"], spec["pre_tokenizer"]) == self.STEPS
        # Bytes as the printable characters of byte-level vocabularies: visible ones stand for themselves.
        seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in seen]
        self.shown = {b: chr(b) for b in seen} | {b: chr(256 + n) for n, b in enumerate(others)}
        del self.shown[10]  # parts have no line feed; it stands between them
        self.packed = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.parts = ChunkCache(self._by_model, held_bytes=64 << 20)

    def _by_model(self, parts: list[str]) -> list[bytes]:
        spelled = "\n".join(parts).encode().decode("latin-1").translate(self.shown).split("\n")
        return [b"".join([self.packed[t.id] for t in self.model.tokenize(s)]) for s in spelled]

    def _by_parts(self, texts: list[str]) -> list[bytes]:
        """Ids of plain texts. All are cut at once; a line feed between two becomes a mark that is no id."""
        cut = self.PARTS.findall("\n".join(texts).lower())
        wanted = set(cut)
        wanted.discard("\n")
        known = self.parts.results(wanted)
        known["\n"] = MARK
        held = b"".join(map(known.__getitem__, cut))
        ends = (np.flatnonzero(np.frombuffer(held, dtype="<u4") == 0xFFFFFFFF) * 4).tolist()
        return [held[lo:hi] for lo, hi in zip([0, *(e + 4 for e in ends)], [*ends, len(held)], strict=True)]

    def __call__(self, chunks: list[bytes]) -> list[bytes]:
        texts = [c.decode() for c in chunks]
        plain = [self.short and bool(self.PLAIN.fullmatch(t)) for t in texts]
        others = [t for t, yes in zip(texts, plain, strict=True) if not yes]
        whole = self.tokenizer.encode_batch_fast(others, add_special_tokens=False) if others else []
        by_tokenizer = (np.array(x.ids, dtype="<u4").tobytes() for x in whole)
        by_parts = iter(self._by_parts([t for t, yes in zip(texts, plain, strict=True) if yes]) if any(plain) else ())
        return [next(by_parts if yes else by_tokenizer) for yes in plain]


def token_ids(texts: Iterable[bytes], path: str) -> Iterator[bytes]:
    """The ids of each text as little-endian 32-bit numbers, without special tokens."""
    if path not in _CACHES:
        _ENCODERS[path] = WordEncoder(path)
        _CACHES[path] = ChunkCache(_ENCODERS[path])
    return _CACHES[path].joined([t.split() for t in texts])


def piece_rows(batches: Iterator[pa.RecordBatch], path: str, capacity: int) -> Iterator[pa.RecordBatch]:
    """A row for each piece of at most `capacity` ids."""
    end = np.array([END_ID], dtype="<u4").tobytes()
    for batch in batches:
        for rows, texts in text_slices(batch):
            out: list[tuple] = []
            for doc_id, ids in zip(rows.column("doc_id").to_pylist(), token_ids(texts.to_pylist(), path), strict=True):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    out.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*out, strict=True))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"]
            )
    if path in _CACHES:
        _CACHES[path].rest()
        _ENCODERS[path].parts.rest()
        pa.default_memory_pool().release_unused()


def best_two_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item.

    A bin takes the largest item that still fits until none does. If a gap is left, the bin's smallest item gives
    way to the two unpacked items that fill its room best, if they fill more than it did.
    """
    lengths = np.asarray(lengths, dtype=np.int64)
    sizes = np.arange(capacity + 1)
    left = np.bincount(lengths, minlength=capacity + 1)
    below = np.maximum.accumulate(np.where(left > 0, sizes, 0))  # the largest unpacked length up to each
    order = np.argsort(lengths, kind="stable")
    following = np.cumsum(left) - left  # of each length, where its next item stands in `order`

    def take(size: int, n: int) -> None:
        had = left[size] > 0
        left[size] -= n
        if had != (left[size] > 0):
            later = np.flatnonzero(left[size + 1 :] > 0)
            stop = size + 1 + int(later[0]) if len(later) else capacity + 1
            below[size:stop] = size if left[size] else below[size - 1]

    bins, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    used, rest = 0, len(lengths)
    while rest:
        content, gap = [], capacity
        while gap and (size := int(below[gap])):
            content.append(size)
            take(size, 1)
            gap -= size
        if gap:
            smallest = content[-1]
            room = gap + smallest
            first = sizes[1:room]
            second = below[room - first]
            second = np.where((second == first) & (left[first] < 2), below[first - 1], second)
            total = np.where((left[first] > 0) & (second > 0), first + second, 0)
            if len(total) and total.max() > smallest:
                at = int(np.argmax(total))
                content[-1:] = [int(first[at]), int(second[at])]
                take(content[-2], 1)
                take(content[-1], 1)
                take(smallest, -1)
        offset = 0
        for size in content:
            item = order[following[size]]
            following[size] += 1
            bins[item], offsets[item] = used, offset
            offset += size
        used += 1
        rest -= len(content)
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Add sequence_id and offset to rows with a `length` of 1 to `capacity`."""
    rows = settle(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    groups = max(1, -(-rows.count() // group_pieces))

    def packed(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("row", ignore_index=True)
        bins, offsets = best_two_fit(group["length"].to_numpy(), capacity)
        return group.drop(columns=["row", "group"]).assign(sequence_id=bins + (int(key[0]) << 32), offset=offsets)

    dealt = rows.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return dealt.groupBy("group").applyInPandas(packed, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Pack `docs` (doc_id, text): one row per piece with its place in a sequence."""
    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        lambda batches: piece_rows(batches, tokenizer_path, capacity), PIECES
    )
    return pack(pieces, capacity, group_pieces)
