"""SentencePiece encoding and decoding with a distinct-chunk table.

No piece of the vocabulary holds a white-space marker after another character
(checked when the model is opened), so merges never cross the start of a marked
word. Each distinct marked word is therefore segmented once by a Python worker and
the texts' ids are put together by position.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetrow.llm.common import map_batches

MARK = "▁"
TABLE_CHUNKS = 500_000  # chunks a Python worker keeps; later ones live for one batch of texts
BATCH_TEXTS = 2000
_MARKED = re.compile(f"{MARK}+[^{MARK}]*")


class ChunkTable(dict):
    """Chunk to its decimal ids joined by commas; ``batch`` holds those that no longer fit."""

    def __init__(self):
        super().__init__()
        self.batch: dict[str, str] = {}

    def __missing__(self, chunk: str) -> str:
        return self.batch[chunk]


class ChunkCodec:
    """Encoder and decoder of one Python worker."""

    def __init__(self, model_path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece of this model crosses white space; words cannot be segmented alone")
        if self.model.normalize("a  b ﬁ") != f"{MARK}a{MARK}{MARK}b{MARK}ﬁ":
            raise ValueError("this model rewrites texts; words cannot be cut before its normaliser")
        self.alone = self.model.piece_to_id(MARK)
        self.decimal = [str(i) for i in range(len(pieces))]
        self.table = ChunkTable()
        self.odd: dict[str, str] = {}

    def chunks(self, text: str) -> list[str]:
        """The marked words of a text without their first marker."""
        if not text:
            return []
        words = text.split(" ")
        if MARK not in text and "" not in words:
            return words
        return [c[1:] for c in _MARKED.findall(MARK + text.replace(" ", MARK))]

    def learn(self, chunks: list[str]) -> dict[str, str]:
        """Segment chunks, and note those that decoding does not give back."""
        ids = self.model.encode(chunks, num_threads=1)
        if "" in chunks:
            ids[chunks.index("")] = [self.alone]
        flat = [i for own in ids for i in own]
        if self.model.decode(flat) != " ".join(chunks):
            for chunk, back in zip(chunks, self.model.decode(ids, num_threads=1)):
                if back != chunk:
                    self.odd[chunk] = back
        text = self.decimal.__getitem__
        return {c: ",".join(map(text, own)) for c, own in zip(chunks, ids)}

    def encode(self, texts: list[str]) -> list[tuple[str, list[str]]]:
        """(decimal ids joined by commas, chunks) of every text."""
        cut = [self.chunks(t) for t in texts]
        new = set().union(*cut).difference(self.table)
        self.table.batch = {}
        if new:
            learned = self.learn(list(new))
            if len(self.table) + len(learned) <= TABLE_CHUNKS:
                self.table.update(learned)
            else:
                self.table.batch = learned
        get = self.table.__getitem__
        return [(",".join(map(get, c)), c) for c in cut]

    def decode_chunks(self, chunks: list[str]) -> str:
        """What decoding the chunks' ids gives: the chunks, but for those that do not come back as they were."""
        if self.odd:
            return " ".join([self.odd.get(c, c) for c in chunks])
        return " ".join(chunks)


@lru_cache(maxsize=1)
def worker_codec(model_path: str) -> ChunkCodec:
    """The worker's codec: workers run many tasks, and the table serves them all."""
    return ChunkCodec(model_path)


def _texts(batch: pa.RecordBatch, step: int = BATCH_TEXTS) -> Iterator[tuple[list, list[str]]]:
    ids = batch.column(0).to_pylist()
    for at in range(0, batch.num_rows, step):
        yield ids[at: at + step], [t or "" for t in batch.column(1).slice(at, step).to_pylist()]


def encode(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids array<int>`` of every whole text; a null or empty text has no ids.

    Repeated rows are encoded alike, other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(model_path)
        for batch in batches:
            for doc_ids, texts in _texts(batch):
                ids = [[int(x) for x in s.split(",")] if s else [] for s, _ in codec.encode(texts)]
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return map_batches(docs.select(F.col(id_col).cast("long"), F.col(text_col)), run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model_path: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text`` of id lists; null decodes to the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_codec(model_path).model
        for batch in batches:
            lists = [x or [] for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(model.decode(lists, num_threads=1) if lists else [], pa.string())], ["doc_id", "text"])

    return map_batches(encoded.select(F.col(id_col).cast("long"), F.col(ids_col)), run, "doc_id long, text string")


def encode_digests(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: what ``encode`` and ``decode`` give, as
    digests, made from the same table in one pass so that no id list leaves its task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(model_path)
        for batch in batches:
            for doc_ids, texts in _texts(batch):
                rows = codec.encode(texts)
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc_ids, pa.int64()),
                    pa.array([s.count(",") + 1 if s else 0 for s, _ in rows], pa.int64()),
                    pa.array([hashlib.sha256(s.encode()).hexdigest() for s, _ in rows], pa.string()),
                    pa.array([hashlib.sha256(codec.decode_chunks(c).encode()).hexdigest() for _, c in rows], pa.string()),
                ], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_batches(
        docs.select(F.col(id_col).cast("long"), F.col(text_col)), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
