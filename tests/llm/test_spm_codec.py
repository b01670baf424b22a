import hashlib
import random

import public_tokenizers
import sentencepiece
from brute import CLASHING, edge_rows, frame

from vetrow.llm import spm_codec

PATH = public_tokenizers.path("piece_bpe_32k.model")


def want(model, text):
    ids = model.encode(text or "")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(",".join(map(str, ids))), sha(model.decode(ids))


def test_chunks_equal_the_library():
    rng = random.Random(1)
    alphabet = [*" \n\tab'sc1.,é▁ñ　ﬁ😀\r0", " the", "  ", "▁▁", "<s>", "</s>", "<unk>", "\x00", "́", "가"]
    codec, model = spm_codec.ChunkCodec(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = ["", " ", "▁", "▁ ", " a", "a "] + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25))) for _ in range(2000)]
    for text, (ids, chunks) in zip(texts, codec.encode(texts)):
        assert ids == ",".join(map(str, model.encode(text))), text
        assert codec.decode_chunks(chunks) == model.decode(model.encode(text)), text


def test_full_table_stays_right(monkeypatch):
    monkeypatch.setattr(spm_codec, "TABLE_CHUNKS", 3)
    codec, model = spm_codec.ChunkCodec(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    for texts in (["one two three four", "five six"], ["seven one eight", "nine"], ["one two"]):
        for text, (ids, _) in zip(texts, codec.encode(texts)):
            assert ids == ",".join(map(str, model.encode(text)))


def test_edge_table_digests_and_round_trip(spark):
    rows, model = edge_rows(), sentencepiece.SentencePieceProcessor(model_file=PATH)
    docs = frame(spark, rows, CLASHING)
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
                 for r in spm_codec.encode_digests(docs, PATH).collect())
    assert got == sorted((d is None, d or 0, *want(model, t)) for d, t in rows)
    ids = spm_codec.encode(docs, PATH)
    back = spm_codec.decode(ids, PATH).collect()
    key = lambda d, t: (d is None, d or 0, t)
    assert sorted(key(r["doc_id"], r["text"]) for r in back) == sorted(key(d, model.decode(model.encode(t or ""))) for d, t in rows)


def test_empty_table(spark):
    assert spm_codec.encode_digests(frame(spark, []), PATH).collect() == []
    assert spm_codec.encode(frame(spark, []), PATH).collect() == []
