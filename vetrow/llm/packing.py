"""Best-fit packing by hierarchical residual packing.

Every task packs its own items best-fit into bins, full bins are final, and
the underfull ones are merged up a tree: as items of a new best-fit round with
fewer, never larger, tasks. Only bins with room travel, as lists of item
references; token ids never do.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetrow.llm.common import map_batches, save, save_counted, tasks_for

CAPACITY = 2048
SLACK = 16          # a bin with less room than this is final
ITEMS_PER_ROUND = 16_384  # items or bins that one task packs at a time
SEPARATOR = 0

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_SPACES = re.compile(r"\s\s")


class ByteBpe:
    """Ids of whole texts by a byte-level BPE vocabulary file, as little-endian uint32 bytes.

    Texts without runs of white space need no look-ahead in the vocabulary's
    splitting pattern and go to a faster library with the same merges; the
    others, and texts with a special token's name, go to the tokenizer itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        byte = _byte_alphabet()
        marks = {self.tokenizer.id_to_token(i): i for i in range(self.tokenizer.get_vocab_size())}
        self.special = [m for m in marks if not all(c in byte for c in m) or m == "<|endoftext|>"]
        ranks = {bytes(byte[c] for c in m): i for m, i in marks.items() if m not in self.special}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
        self.merger = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        if _SPACES.search(text) or any(s in text for s in self.special):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return array("I", self.merger.encode_ordinary(text)).tobytes()


def _byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of the 256 bytes in byte-level vocabularies: printable bytes
    stand for themselves, the others follow from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def cut_pieces(ids: bytes, capacity: int) -> list[tuple[int, int, int]]:
    """(start, length, crc32) of the pieces; only the first may be shorter than the capacity when there are several."""
    n = len(ids) // 4
    first = (n - 1) % capacity + 1
    starts = [0, *range(first, n, capacity)]
    return [(a, b - a, zlib.crc32(ids[4 * a: 4 * b])) for a, b in zip(starts, [*starts[1:], n])]


def tokenize_pieces(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text",
                    capacity: int = CAPACITY) -> DataFrame:
    """One row per piece (``doc_id, piece, start, length, ids_crc32``): the text's ids and a
    closing separator, cut only when longer than the capacity. A null text is empty
    and gives one piece with the separator alone."""
    closing = np.array([SEPARATOR], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(tokenizer_path)
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1)
            rows = []
            for doc_id, text in zip(doc_ids, texts):
                ids = bpe.encode(text.as_py() or "")
                rows.extend((doc_id, i, *p) for i, p in enumerate(cut_pieces(ids + closing, capacity)))
            yield _batch(rows)

    return map_batches(docs.select(F.col(id_col).cast("long"), F.col(text_col)), run, PIECE)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * 5
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def best_fit(sizes: Iterable[int], capacity: int) -> list[list[int]]:
    """Best-fit in decreasing size: item indexes by bin. Bins with equal room share a list,
    and a bit mask of the rooms in use finds the tightest one at once."""
    sizes = np.asarray(list(sizes), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, bins = 0, []
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fitting = mask >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                mask &= ~(1 << room)
            bins[b].append(i)
            room -= size
        else:
            b, room = len(bins), capacity - size
            bins.append([i])
        if room:
            by_room[room].append(b)
            mask |= 1 << room
    return bins


_MEMBER = "struct<doc_id:long,piece:int,start:long,length:long,ids_crc32:long>"
_BIN = f"used long, members array<{_MEMBER}>"


def _pack_bins(capacity: int):
    """A round in one task: bins (or single items) of up to ITEMS_PER_ROUND at a time, best-fit as items."""
    member = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def pack(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        used = table.column(0).to_numpy()
        lists = table.column(1).chunk(0)
        bins = best_fit(used, capacity)
        order = np.array([i for b in bins for i in b], np.int64)
        counts = np.diff(lists.offsets.to_numpy())
        flat = lists.take(pa.array(order)).flatten()
        ends = np.cumsum([counts[b].sum() for b in bins])
        members = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), flat.cast(member))
        return pa.RecordBatch.from_arrays([pa.array([int(used[b].sum()) for b in bins], pa.int64()), members], ["used", "members"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, ITEMS_PER_ROUND):
                part = batch.slice(at, ITEMS_PER_ROUND)
                if rows + part.num_rows > ITEMS_PER_ROUND:
                    yield pack(held)
                    held, rows = [], 0
                if part.num_rows:
                    held.append(part)
                    rows += part.num_rows
        if held:
            yield pack(held)

    return run


def pack(pieces: DataFrame, *, capacity: int = CAPACITY, slack: int = SLACK, fan_in: int = 8) -> DataFrame:
    """Place pieces (``doc_id, piece, start, length, ids_crc32``, none longer than the
    capacity) in sequences: adds ``sequence_id`` (any number) and ``offset``, the gapless
    place there.

    A piece of the full length is a sequence by itself. The rest is packed by
    task, and bins with ``slack`` or more room go up the tree, ``fan_in`` tasks
    into one, until one round holds them all or merging no longer saves bins.
    Equal pieces are separate items; an empty table gives no sequence."""
    single = F.array(F.struct("doc_id", "piece", "start", "length", "ids_crc32"))
    done = pieces.where(F.col("length") == capacity).select(F.col("length").alias("used"), single.alias("members"))
    items = pieces.where(F.col("length") < capacity).select(F.col("length").alias("used"), single.alias("members"))
    bins = save(map_batches(items, _pack_bins(capacity), _BIN), "pack-bins")
    final = [done, bins.where(F.col("used") > capacity - slack)]
    open_ = bins.where(F.col("used") <= capacity - slack)
    left, tasks = open_.count(), None
    while left:
        tasks = max(tasks_for(left, ITEMS_PER_ROUND // 2), 0 if tasks is None else -(-tasks // fan_in))
        bins, made = save_counted(map_batches(open_.repartition(tasks), _pack_bins(capacity), _BIN), "pack-round")
        final.append(bins.where(F.col("used") > capacity - slack))
        open_ = bins.where(F.col("used") <= capacity - slack)
        if tasks == 1 or made > 0.98 * left:
            break
        left = open_.count()
    if left:
        final.append(open_)
    sequences = final[0]
    for more in final[1:]:
        sequences = sequences.unionByName(more)
    placed = sequences.select("members", F.monotonically_increasing_id().alias("sequence_id"))
    return map_batches(placed, _place_members, _PLACED)


_PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def _place_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sequences as their members, each with the sequence's number and its place there."""
    for batch in batches:
        lists = batch.column("members")
        members = lists.flatten()
        counts = lists.value_lengths().to_numpy(zero_copy_only=False)
        lengths = members.field("length").to_numpy(zero_copy_only=False)
        before = np.concatenate([[0], np.cumsum(lengths)])
        firsts = np.concatenate([[0], np.cumsum(counts)])[:-1]
        offsets = before[:-1] - np.repeat(before[firsts], counts)
        columns = [members.field(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")]
        columns += [pa.array(np.repeat(batch.column("sequence_id").to_numpy(), counts)), pa.array(offsets, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
