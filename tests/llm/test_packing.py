import random
import zlib

import numpy as np
import public_tokenizers
from brute import CLASHING, edge_rows, frame
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from vetrow.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_ids_equal_the_tokenizer(spark):
    rng = random.Random(1)
    alphabet = [*" \n\tab'sc1.,é▁ñ　ﬁ😀\r0", "'s", " the", "  ", "<|endoftext|>", "\x00", "́", "가"]
    bpe, tokenizer = packing.ByteBpe(PATH), Tokenizer.from_file(PATH)
    for _ in range(1500):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25)))
        assert bpe.encode(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=80))
def test_best_fit_bins(sizes):
    bins = packing.best_fit(sizes, 50)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    held = [sum(sizes[i] for i in b) for b in bins]
    assert all(h <= 50 for h in held)
    assert sum(h <= 25 for h in held) <= 1  # two half-empty bins would have been one


def place(rows, out, capacity):
    tokenizer = Tokenizer.from_file(PATH)
    want = []
    for d, t in rows:
        ids = [*(tokenizer.encode(t or "", add_special_tokens=False).ids), 0]
        first = (len(ids) - 1) % capacity + 1
        starts = [0, *range(first, len(ids), capacity)]
        for i, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            want.append((d is None, d or 0, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    got = [(r["doc_id"] is None, r["doc_id"] or 0, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out]
    assert sorted(got) == sorted(want)
    bins = {}
    for r in out:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for members in bins.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), -(-sum(w[4] for w in want) // capacity)


def test_edge_table(spark):
    rows = edge_rows()
    pieces = packing.save(packing.tokenize_pieces(frame(spark, rows, CLASHING), PATH), "pieces")
    used, least = place(rows, packing.pack(pieces).collect(), packing.CAPACITY)
    assert used <= least + 2


def test_many_rounds(spark, monkeypatch):
    monkeypatch.setattr(packing, "ITEMS_PER_ROUND", 8)
    rng = random.Random(4)
    rows = [(i, "word " * rng.randint(0, 60)) for i in range(300)]
    pieces = packing.save(packing.tokenize_pieces(frame(spark, rows), PATH, capacity=64), "pieces")
    used, least = place(rows, packing.pack(pieces, capacity=64, slack=2).collect(), 64)
    assert used <= 1.2 * least  # tasks of eight items leave room that whole bins cannot fill


def test_empty_table(spark):
    pieces = packing.save(packing.tokenize_pieces(frame(spark, []), PATH), "pieces")
    assert packing.pack(pieces).collect() == []
