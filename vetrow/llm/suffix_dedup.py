"""Suffix-array dedup of repeated byte strings.

A byte is removed when a ``MIN_BYTES`` long string that covers it also starts in a
document with a smaller id. Every such string has a least ``GRAM`` byte gram
(its anchor, chosen by hash, the leftmost of equals), and equal strings have
equal anchors, so the work is dealt out by anchor:

1. anchors that occur in two documents are found (one shuffle of anchor hashes), and among
   them those around which all documents have the same string;
2. where strings differ, they are dealt by anchor, cut to what their anchor stands for;
   where all are the same, only who has it is;
3. a bucket's strings go into an enhanced suffix array; a stack scan of its
   common-prefix intervals, testing that left extensions differ, gives the
   maximal repeats with all their occurrences, and from them what is removed;
   that strings are the same was found by 32 bits of hash, and is made sure here
   by 96: where it is not so, the anchor's strings are dealt as differing ones;
4. documents are put together with their removals.

Equal strings are combined to the smallest document before each shuffle, so a
string that a third of all documents share travels once a batch. Anchors in
many documents (over 20,000 and a thousandth of all) whose strings differ have
them dealt by each whole string's hash: what is around a common line differs
and spreads.
"""

from __future__ import annotations

import hashlib
import pickle
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetrow.llm.common import map_batches, save, tasks_for

MIN_BYTES = 50
GRAM = 16
SPAN = MIN_BYTES - GRAM + 1        # grams in a string, and most strings of one anchor
SEGMENT = 1 << 18                  # bytes of text hashed at a time
BUCKET_BYTES = 1 << 22             # of text for each bucket of anchors: a batch has a payload for each bucket, ...
SLOT_BYTES = 12 << 20              # ... and a bucket one for each slot of documents, so that small ones grow with the square
BATCH_BYTES = 1 << 24              # of text whose strings are combined in a task
ARRAY_SUFFIXES = 1 << 16           # of the strings that go into one suffix array, unless one anchor has more
HOT_SHARE = 1000                   # an anchor in more than 1/HOT_SHARE of the documents is hot, ...
HOT_LEAST = 20_000                 # ... but not below so many documents
UID = np.uint64((1 << 40) - 1)     # bits of a row's hash that go with an anchor

ROW = "bucket int, kind int, slot int, doc_id long, uid long, payload binary"
DOCUMENT, REPLY, HOT, STRINGS, REMOVAL, CLASH = 1, 0, 2, 3, 0, 4
SAME = np.uint64(1 << 63)          # of a reply's key: all documents have the same string there


def _dump(value) -> bytes:
    """What goes through a shuffle: texts and sorted numbers, which compress well."""
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(value, 5))


def _load(payload: bytes):
    return pickle.loads(zstandard.ZstdDecompressor().decompress(payload))


def _segments(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bytes]]:
    """(documents, their offsets, starts in the buffer, buffer): texts in buffers of about SEGMENT bytes; a
    longer text is cut with an overlap, so that every string of MIN_BYTES lies in one segment."""
    held, size = [], 0
    for d, text in enumerate(texts):
        for at in range(0, max(len(text) - MIN_BYTES + 1, 0), SEGMENT):
            part = text[at: at + SEGMENT + MIN_BYTES - 1]
            if held and size + len(part) > SEGMENT:
                yield _buffer(held)
                held, size = [], 0
            held.append((d, at, part))
            size += len(part)
    if held:
        yield _buffer(held)


def _buffer(held):
    starts = np.cumsum([0, *(len(p) for _, _, p in held)])
    return np.array([d for d, _, _ in held]), np.array([a for _, a, _ in held]), starts, b"".join(p for _, _, p in held)


def gram_hashes(raw: bytes) -> np.ndarray:
    """64-bit hash of every GRAM byte gram of a buffer."""
    padded = np.frombuffer(raw + b"\0" * 8, np.uint8)
    words = np.ndarray((len(raw) + 1,), "<u8", padded, strides=(1,)).copy()
    n = len(raw) - GRAM + 1
    x = words[:n] * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x += words[8: 8 + n]
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(29)
    return x


def anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(document, first string, strings, hash, string hash) of every anchor: ``first`` is the offset in the text of the
    first MIN_BYTES string that it stands for, and ``strings`` their number, one after another; the last is a hash
    of all they cover and of the anchor's place in it."""
    out = [[], [], [], [], []]
    for docs, offsets, starts, raw in _segments(texts):
        x = gram_hashes(raw)
        n = len(raw) - MIN_BYTES + 1
        key = (x & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(x), dtype=np.uint64)
        step = 1
        while step * 2 <= SPAN:
            key = np.minimum(key[:-step], key[step:])
            step *= 2
        if step < SPAN:
            key = np.minimum(key[: len(key) - (SPAN - step)], key[SPAN - step:])
        at = (key[:n] & np.uint64(0xFFFFFFFF)).astype(np.int64)  # place of each string's anchor
        change = np.empty(n, bool)
        change[0] = True
        np.not_equal(at[1:], at[:-1], out=change[1:])
        ends = starts[1:-1]
        crossing = np.zeros(n, bool)
        for e in ends:
            crossing[max(0, e - MIN_BYTES + 1): min(e, n)] = True
            if e < n:
                change[e] = True
            if e - MIN_BYTES + 1 >= 0 and e - MIN_BYTES + 1 < n:
                change[e - MIN_BYTES + 1] = True
        first = np.flatnonzero(change)
        count = np.diff(np.append(first, n))
        inside = ~crossing[first]
        first, count = first[inside], count[inside]
        own = np.searchsorted(starts, first, "right") - 1
        out[0].append(docs[own])
        out[1].append(first - starts[own] + offsets[own])
        out[2].append(count)
        out[3].append(x[at[first]])
        out[4].append(_string_hash(x, first, count, at[first]))
    if not out[0]:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint32))
    return tuple(np.concatenate(c) for c in out)


def _string_hash(x: np.ndarray, first: np.ndarray, count: np.ndarray, at: np.ndarray) -> np.ndarray:
    """32-bit hash of the bytes [first, first + count + MIN_BYTES - 1), from grams that cover them."""
    end = first + count + MIN_BYTES - 1 - GRAM
    out = (at - first).astype(np.uint64) << np.uint64(8) | count.astype(np.uint64)
    for step in range(0, MIN_BYTES + SPAN, GRAM):
        out = (out ^ (out >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + x[np.minimum(first + step, end)]
    return (out >> np.uint64(32)).astype(np.uint32)


def anchor_keys(x: np.ndarray, buckets: int) -> np.ndarray:
    """bucket << 32 | 32 bits of the hash."""
    bucket = ((x >> np.uint64(3)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(buckets)
    return bucket << np.uint64(32) | (x & np.uint64(0xFFFFFFFF))


def _rows(bucket, kind, slot, payload) -> pa.RecordBatch:
    n = len(payload)
    none = pa.nulls(n, pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket, pa.int32()), pa.array([kind] * n, pa.int32()), pa.array(slot, pa.int32()), none, none, pa.array(payload, pa.binary())],
        ["bucket", "kind", "slot", "doc_id", "uid", "payload"])


def _by_slot(uid: np.ndarray, columns: list[np.ndarray], kind: int, slots: int, spread: int) -> pa.RecordBatch:
    """Rows for the documents ``uid``, packed by slot; ``spread`` buckets share the passing through."""
    slot = (uid & UID).astype(np.int64) % slots
    order = np.lexsort((uid, slot))
    slot = slot[order]
    cuts = np.flatnonzero(np.append(True, slot[1:] != slot[:-1])) if len(slot) else np.zeros(0, int)
    payload = [_dump([uid[order[a:b]], *(c[order[a:b]] for c in columns)]) for a, b in zip(cuts, [*cuts[1:], len(slot)])]
    which = slot[cuts].tolist()
    return _rows([s % spread for s in which], kind, which, payload)


def _text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], np.ndarray, list[bytes]]]:
    """(doc ids, row hashes, texts) of documents, up to BATCH_BYTES of text together."""
    ids, uids, texts, size = [], [], [], 0
    for batch in batches:
        for i, u, t in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "uid", "payload"))):
            if texts and size + len(t) > BATCH_BYTES:
                yield ids, np.array(uids, np.int64).view(np.uint64), texts
                ids, uids, texts, size = [], [], [], 0
            ids.append(i)
            uids.append(u)
            texts.append(t)
            size += len(t)
    if texts:
        yield ids, np.array(uids, np.int64).view(np.uint64), texts


def _packed(documents: DataFrame, slots: int, spread: int) -> DataFrame:
    """Documents by slot: rows DOCUMENT with the ids, row hashes and texts that a batch has for the slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, uids, texts in _text_batches(batches):
            by_slot = defaultdict(list)
            for i, slot in enumerate(((uids & UID).astype(np.int64) % slots).tolist()):
                by_slot[slot].append(i)
            which = list(by_slot)
            yield _rows([s % spread for s in which], DOCUMENT, which,
                        [_dump(([ids[i] for i in own], uids[own], [texts[i] for i in own])) for own in by_slot.values()])

    return map_batches(documents, run, ROW)


def _sorted_pairs(key: np.ndarray, uid: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted by key, and by uid where a key repeats; few do."""
    order = np.argsort(key)
    key, uid, columns = key[order], uid[order], [c[order] for c in columns]
    same = np.flatnonzero(np.append(key[1:] == key[:-1], False) | np.append(False, key[1:] == key[:-1]))
    if len(same):
        inner = same[np.lexsort((uid[same], key[same]))]
        uid[same], columns = uid[inner], [_put(c, same, inner) for c in columns]
    return key, uid, *columns


def _put(c: np.ndarray, to: np.ndarray, source: np.ndarray) -> np.ndarray:
    out = c.copy()
    out[to] = c[source]
    return out


def _find_shared(documents: DataFrame, buckets: int, slots: int, hot: int) -> DataFrame:
    """Step 1. Rows REPLY (slot; uid and keys of its shared anchors) and HOT (keys)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, uids, texts in _text_batches(batches):
            doc, _, _, x, string = anchors(texts)
            if not len(doc):
                continue
            key, uid, string = _sorted_pairs(anchor_keys(x, buckets), uids[doc], string)
            start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            differ = np.minimum.reduceat(string, start) != np.maximum.reduceat(string, start)
            fresh = np.append(True, (key[1:] != key[:-1]) | (uid[1:] != uid[:-1]))
            uid, key, string = uid[fresh], key[fresh], string[fresh]
            start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            count = np.diff(np.append(start, len(key)))
            local = np.repeat(count > 1, count)
            if local.any():
                yield _by_slot(uid[local], [key[local]], REPLY, slots, buckets)
            key, uid, string = key[start], uid[start] & UID, string[start]
            bucket = (key >> np.uint64(32)).astype(np.int64)
            cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            payload = []
            for a, b in zip(cuts, [*cuts[1:], len(key)]):
                many = np.flatnonzero((count[a:b] > 1) | differ[a:b])
                payload.append(_dump([
                    np.diff(key[a:b].astype(np.uint32), prepend=np.uint32(0)), uid[a:b].astype(np.uint32),
                    (uid[a:b] >> np.uint64(32)).astype(np.uint8), string[a:b],
                    many.astype(np.uint32), count[a:b][many].astype(np.uint32), differ[a:b][many]]))
            yield _rows(bucket[cuts].tolist(), STRINGS, [None] * len(cuts), payload)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replies, hot_keys = [], []

        def close(bucket: int, held: list[bytes]) -> None:
            parts = [_load(p) for p in held]
            key = np.concatenate([np.cumsum(p[0], dtype=np.uint32) for p in parts])
            uid = np.concatenate([p[1].astype(np.uint64) | p[2].astype(np.uint64) << np.uint64(32) for p in parts])
            string = np.concatenate([p[3] for p in parts])
            count, differ = np.ones(len(key), np.int64), np.zeros(len(key), bool)
            at = 0
            for p in parts:
                many = at + p[4].astype(np.int64)
                count[many], differ[many] = p[5], p[6]
                at += len(p[0])
            key, uid, string, count, differ = _sorted_pairs(key, uid, string, count, differ)
            start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            size = np.diff(np.append(start, len(key)))
            total = np.add.reduceat(count, start)
            shared = (size > 1) | (np.maximum.reduceat(count, start) > 1)  # a document is in one batch
            same = (np.minimum.reduceat(string, start) == np.maximum.reduceat(string, start)) & ~np.logical_or.reduceat(differ, start)
            own = np.repeat(shared, size)
            full = key.astype(np.uint64) | np.uint64(bucket) << np.uint64(32)
            replies.append((uid[own], (full | np.where(np.repeat(same, size), SAME, np.uint64(0)))[own]))
            hot_keys.append(full[start[(total > hot) & ~same]])

        held, current = [], None
        for batch in batches:
            passed = np.flatnonzero(batch.column("kind").to_numpy() == REPLY)
            if len(passed):
                yield batch.take(pa.array(passed))
            for bucket, kind, payload in zip(*(batch.column(c).to_pylist() for c in ("bucket", "kind", "payload"))):
                if kind != STRINGS:
                    continue
                if bucket != current and held:
                    close(current, held)
                    held = []
                    if sum(len(u) for u, _ in replies) > 1 << 20:
                        yield _by_slot(*_joined(replies), REPLY, slots, buckets)
                        replies.clear()
                current = bucket
                held.append(payload)
        if held:
            close(current, held)
        if replies:
            yield _by_slot(*_joined(replies), REPLY, slots, buckets)
        keys = np.concatenate(hot_keys) if hot_keys else np.zeros(0)
        if len(keys):
            yield _rows([0], HOT, [None], [_dump(keys)])

    def _joined(replies):
        return np.concatenate([u for u, _ in replies]), [np.concatenate([k for _, k in replies])]

    found = map_batches(documents, scan, ROW)
    return save(map_batches(found.repartition(buckets, "bucket").sortWithinPartitions("bucket"), gather, ROW), "suffix-shared")


def check_bits(doc_id) -> np.ndarray:
    """16 bits of an id, which with the row's 64-bit hash tell documents apart: two meet with a chance of 2^-80."""
    return (np.asarray(doc_id, np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(48)).astype(np.uint16)


class Strings:
    """Strings around shared anchors, combined: for equal ones only the rows of the smallest document go on."""

    def __init__(self):
        self.held: dict = {}
        self.removed: list[tuple[int, int, int, int]] = []

    def add(self, key, doc_id: int, uid: int, starts: list[int]) -> None:
        held = self.held.get(key)
        if held is None:
            self.held[key] = [doc_id, {uid: starts}]
        elif doc_id == held[0]:
            held[1].setdefault(uid, []).extend(starts)
        else:
            size = len(key[-1])
            if doc_id > held[0]:
                self.removed.extend((uid, s, s + size, doc_id) for s in starts)
            else:
                for u, own in held[1].items():
                    self.removed.extend((u, s, s + size, held[0]) for s in own)
                self.held[key] = [doc_id, {uid: starts}]


def string_digests(strings) -> np.ndarray:
    """(strings x 2) 64-bit halves of 128 bits of hash."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, strings)), np.uint64).reshape(-1, 2)


#: What is known of a string that is the same wherever its anchor is: anchor, hash, size, document, row, start.
SAME_COLUMNS = ("h", "one", "two", "size", "doc", "uid", "start")


def first_documents(same: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], tuple[np.ndarray, ...], np.ndarray]:
    """Of equal strings the rows of the smallest document; the others' (uid, start, end, document); and the anchors
    that stand for more than one string. Strings are equal where anchor, hash and size are."""
    order = np.lexsort((same["doc"], same["size"], same["two"], same["one"], same["h"]))
    s = {c: v[order] for c, v in same.items()}
    if not len(order):
        return s, tuple(s[c] for c in ("uid", "start", "start", "doc")), s["h"]
    apart = np.append(True, np.logical_or.reduce([s[c][1:] != s[c][:-1] for c in ("h", "one", "two", "size")]))
    smallest = s["doc"][np.flatnonzero(apart)][np.cumsum(apart) - 1]
    stay = s["doc"] == smallest
    gone = tuple(v[~stay] for v in (s["uid"], s["start"], s["start"] + s["size"], s["doc"]))
    anchors_ = s["h"][apart]
    clash = np.unique(anchors_[1:][anchors_[1:] == anchors_[:-1]])
    return {c: v[stay] for c, v in s.items()}, gone, clash


def _removals(removed: list[tuple[np.ndarray, ...]], slots: int, spread: int) -> pa.RecordBatch:
    """Rows REMOVAL from (uid, start, end, document) columns; a document's spans that touch are put together."""
    uid, start, end, doc = (np.concatenate([np.asarray(r[i], t) for r in removed]) for i, t in enumerate((np.uint64, np.int64, np.int64, np.int64)))
    check = check_bits(doc)
    order = np.lexsort((start, check, uid))
    uid, check, start, end = uid[order], check[order], start[order], end[order]
    group = np.cumsum(np.append(True, (uid[1:] != uid[:-1]) | (check[1:] != check[:-1])))
    reach = np.maximum.accumulate(group * (1 << 40) + end)  # the furthest end so far within a document
    new = np.flatnonzero(np.append(True, (group * (1 << 40) + start)[1:] > reach[:-1]))
    last = np.append(new[1:], len(uid)) - 1
    return _by_slot(uid[new], [start[new], reach[last] - group[last] * (1 << 40), check[new]], REMOVAL, slots, spread)


def _columns(rows: list[tuple[int, int, int, int]]) -> tuple[np.ndarray, ...]:
    return tuple(np.array(c, t) for c, t in zip(zip(*rows), (np.uint64, np.int64, np.int64, np.int64)))


ALIKE, VARIED, WHOLE = 1, 0, 2  # strings known to be the same, to be compared, dealt by their own hash


def _mark(uid: np.ndarray, key: np.ndarray) -> np.ndarray:
    """One number for a row and an anchor in it."""
    return (uid & UID) * np.uint64(0x9E3779B97F4A7C15) ^ key


def _cut_strings(joined: DataFrame, buckets: int, slots: int, hot_keys: np.ndarray, clashes: np.ndarray) -> DataFrame:
    """Step 2. Rows STRINGS (bucket) and REMOVAL (slot), from documents after their replies, sorted by slot and kind.
    ``clashes`` are anchors whose strings were taken for the same and are not."""

    def alike(doc, first, count, key, ids, uids, texts):
        """(rows of the smallest documents, bucket of each, removals) of strings that are the same everywhere."""
        size = count + MIN_BYTES - 1
        digests = string_digests([texts[d][s: s + n] for d, s, n in zip(doc.tolist(), first.tolist(), size.tolist())])
        same, gone, _ = first_documents({"h": key, "one": digests[:, 0], "two": digests[:, 1], "size": size,
                                         "doc": np.array(ids, np.int64)[doc], "uid": uids[doc], "start": first})
        bucket = (same["h"] >> np.uint64(32)).astype(np.int64)
        return same | {"h": (same["h"] & np.uint64(0xFFFFFFFF)).astype(np.uint32)}, bucket, gone

    def strings(ids, uids, texts, marks, known) -> Iterator[pa.RecordBatch]:
        doc, first, count, x, _ = anchors(texts)
        key = anchor_keys(x, buckets)
        mark = _mark(uids[doc], key)
        shared = np.isin(mark, marks)
        doc, first, count, key, mark = doc[shared], first[shared], count[shared], key[shared], mark[shared]
        mode = np.where(np.isin(key, hot_keys), WHOLE, np.where(np.isin(mark, known) & ~np.isin(key, clashes), ALIKE, VARIED))
        one = mode == ALIKE
        same, same_bucket, gone = alike(doc[one], first[one], count[one], key[one], ids, uids, texts)
        doc, first, count, key, mode = doc[~one], first[~one], count[~one], key[~one], mode[~one]
        found = Strings()
        low = (key & np.uint64(0xFFFFFFFF)).tolist()
        bucket = (key >> np.uint64(32)).tolist()
        own = uids.tolist()
        for d, s, n, b, h, m in zip(doc.tolist(), first.tolist(), count.tolist(), bucket, low, mode.tolist()):
            if m == VARIED:
                found.add((b, VARIED, h, texts[d][s: s + n + MIN_BYTES - 1]), ids[d], own[d], [s])
            else:
                for w in range(s, s + n):
                    string = texts[d][w: w + MIN_BYTES]
                    x64 = xxhash.xxh3_64_intdigest(string)
                    found.add(((x64 >> 33) % buckets, WHOLE, x64 & 0xFFFFFFFF, string), ids[d], own[d], [w])
        by_bucket = defaultdict(list)
        for key, (doc_id, rows) in found.held.items():
            for uid, starts in rows.items():
                by_bucket[key[0]].append((key[1], key[2], key[3], len(key[3]), doc_id, uid, starts))
        order = np.argsort(same_bucket, kind="stable")
        same, same_bucket = {c: v[order] for c, v in same.items()}, same_bucket[order]
        which = sorted({*by_bucket, *np.unique(same_bucket).tolist()})
        cuts = zip(np.searchsorted(same_bucket, which, "left").tolist(), np.searchsorted(same_bucket, which, "right").tolist())
        payload = []
        for b, (lo, hi) in zip(which, cuts):
            mode, h, string, size, doc_id, uid, starts = zip(*by_bucket[b]) if b in by_bucket else [()] * 7
            payload.append(_dump([
                [np.diff(same["h"][lo:hi], prepend=np.uint32(0)),
                 *(same[c][lo:hi].astype(t) for c, t in zip(SAME_COLUMNS[1:], (np.uint64, np.uint32, np.uint16, np.int64, np.uint64, np.uint32)))],
                np.array(mode, np.uint8), np.array(h, np.uint32), b"".join(string), np.array(size, np.uint16), np.array(doc_id, np.int64),
                np.array(uid, np.uint64), np.array([len(s) for s in starts], np.uint32), np.array([s for o in starts for s in o], np.uint32)]))
        if which:
            yield _rows(which, STRINGS, [None] * len(which), payload)
        removed = ([gone] if len(gone[0]) else []) + ([_columns(found.removed)] if found.removed else [])
        if removed:
            yield _removals(removed, slots, buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for replies, ids, uids, texts in _with_replies(batches):
            if replies and texts:
                parts = [_load(p) for p in replies]
                uid, key = np.concatenate([u for u, _ in parts]), np.concatenate([k for _, k in parts])
                marks, known = _mark(uid, key & ~SAME), (key & SAME) > 0
                yield from strings(ids, uids, texts, np.unique(marks), np.unique(marks[known]))

    return map_batches(joined, run, ROW)


def _with_replies(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], list[int], np.ndarray, list[bytes]]]:
    """(payloads of the slot, doc ids, row hashes, texts): a slot's payloads come before its documents. Slots are
    put together, and a slot is cut, at BATCH_BYTES of text."""
    replies, ids, uids, texts, size, current = [], [], [], [], 0, None
    for batch in batches:
        for slot, kind, payload in zip(*(batch.column(c).to_pylist() for c in ("slot", "kind", "payload"))):
            if slot != current:
                if size > BATCH_BYTES // 2:
                    yield replies, ids, np.concatenate(uids), texts
                    replies, ids, uids, texts, size = [], [], [], [], 0
                current = slot
            if kind != DOCUMENT:
                replies.append(payload)
                continue
            own, hashes, more = _load(payload)
            if texts and size + sum(map(len, more)) > BATCH_BYTES:
                yield replies, ids, np.concatenate(uids), texts
                ids, uids, texts, size = [], [], [], 0
            ids += own
            uids.append(hashes)
            texts += more
            size += sum(map(len, more))
    if texts:
        yield replies, ids, np.concatenate(uids), texts


class SuffixArray:
    """Enhanced suffix array of short strings: the suffixes of at least MIN_BYTES, sorted, with common prefixes."""

    def __init__(self, strings: list[bytes], least: int = MIN_BYTES):
        longest = max(map(len, strings))
        width = -(-longest // 8) * 8
        stride = width + longest
        flat = np.frombuffer(b"".join(s.ljust(stride, b"\0") for s in strings), np.uint8)
        sizes = np.array([len(s) for s in strings])
        count = sizes - least + 1
        self.string = np.repeat(np.arange(len(strings)), count)
        self.offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        begin = self.string * stride + self.offset
        held = np.lib.stride_tricks.sliding_window_view(flat, width)[begin]
        order = np.argsort(held.view(f"S{width}").ravel(), kind="stable")  # as bytes, up to the padding
        self.string, self.offset, held = self.string[order], self.offset[order], held[order]
        size = sizes[self.string] - self.offset
        differ = held[1:] != held[:-1]
        prefix = np.where(differ.any(1), differ.argmax(1), width) if len(held) > 1 else np.zeros(0, int)
        #: common prefix of a suffix and the one before it
        self.lcp = np.minimum(prefix, np.minimum(size[1:], size[:-1]))
        #: the byte before a suffix; unlike any other (negative) at a string's start
        before = flat[np.maximum(begin[order] - 1, 0)].astype(np.int64)
        self.left = np.where(self.offset > 0, before, -1 - np.arange(len(before)))

    def maximal_repeats(self, least: int = MIN_BYTES) -> Iterator[tuple[int, int, int]]:
        """(length, first, last): common-prefix intervals of at least ``least`` bytes, found by a stack scan, whose
        occurrences are not all preceded by the same byte. Positions are in suffix order; nested intervals
        are groups of their own."""
        lcp, left = self.lcp.tolist(), self.left.tolist()
        stack: list[list] = []  # [length, first, the common left byte or None]

        def merge(a, b):
            return a if a == b else None

        near = self.lcp >= least  # elsewhere nothing is open and nothing opens
        for i in (np.flatnonzero(np.append(near, False) | np.append(False, near)) + 1).tolist():
            now = lcp[i - 1] if i <= len(lcp) else 0
            if now < least and not stack:
                continue
            first, byte = i - 1, left[i - 1]
            while stack and stack[-1][0] > now:
                length, start, common = stack.pop()
                common = merge(common, byte)
                if common is None:
                    yield length, start, i - 1
                first, byte = start, common
            if now >= least:
                if stack and stack[-1][0] == now:
                    stack[-1][2] = merge(stack[-1][2], byte)
                else:
                    stack.append([now, first, byte])


def repeated_strings(strings: list[bytes], documents: list[int], least: int = MIN_BYTES) -> list[tuple[int, int, int]]:
    """(string, start, end): what the maximal repeats cover in strings whose document is not the smallest of a group."""
    array = SuffixArray(strings, least)
    doc = np.array(documents, np.int64)[array.string]
    out = set()
    for length, first, last in array.maximal_repeats(least):
        group = slice(first, last + 1)
        later = np.flatnonzero(doc[group] > doc[group].min())
        out.update(zip(array.string[group][later].tolist(), array.offset[group][later].tolist(),
                       (array.offset[group][later] + length).tolist()))
    return sorted(out)


def bundles(groups: list[list], suffixes, most: int = ARRAY_SUFFIXES) -> Iterator[list]:
    """Groups put together up to ``most`` suffixes; a larger one is by itself. Strings of different anchors have no string of
    MIN_BYTES in common, so nothing is lost between two arrays."""
    held, size = [], 0
    for group in groups:
        own = sum(map(suffixes, group))
        if held and size + own > most:
            yield held
            held, size = [], 0
        held.extend(group)
        size += own
    if held:
        yield held


def _judge(dealt: DataFrame, slots: int, buckets: int) -> DataFrame:
    """Step 3. REMOVAL rows (slot; uid, start, end, check) from the strings of each bucket, and CLASH rows: anchors whose
    strings were taken for the same and are not."""

    def close(bucket: int, held: list[bytes]) -> tuple[list[tuple[np.ndarray, ...]], np.ndarray]:
        found, entries, parts = Strings(), [], []
        for payload in held:
            same, mode, h, raw, size, doc_id, uid, n, starts = _load(payload)
            parts.append([np.cumsum(same[0], dtype=np.uint32), *same[1:]])
            at, begin = 0, 0
            for m, k, length, d, u, c in zip(mode.tolist(), h.tolist(), size.tolist(), doc_id.tolist(), uid.tolist(), n.tolist()):
                entries.append((m, k, raw[begin: begin + length], d, u, starts[at: at + c].tolist()))
                begin += length
                at += c
        alike = set(np.unique(np.concatenate([p[0] for p in parts])).tolist())
        late = [e for e in entries if e[0] != WHOLE and e[1] in alike]  # some batches had only their own word that it is shared
        if late:
            flat = [(k, string, d, u, s) for _, k, string, d, u, own in late for s in own]
            k, string, d, u, s = zip(*flat)
            digests = string_digests(string)
            parts.append([np.array(k, np.uint32), digests[:, 0], digests[:, 1].astype(np.uint32), np.array([len(x) for x in string], np.uint16),
                          np.array(d, np.int64), np.array(u, np.uint64), np.array(s, np.uint32)])
        types = (np.uint64, np.uint64, np.uint64, np.int64, np.int64, np.uint64, np.int64)
        _, gone, clash = first_documents({c: np.concatenate([p[i] for p in parts]).astype(t) for i, (c, t) in enumerate(zip(SAME_COLUMNS, types))})
        for m, k, string, d, u, own in entries:
            if m == WHOLE or k not in alike:
                found.add((m, k, string), d, u, own)
        groups = defaultdict(list)
        for key in found.held:
            if key[0] == VARIED:
                groups[key[1]].append(key)
        removed = found.removed
        for several in bundles([keys for keys in groups.values() if len(keys) > 1], lambda k: len(k[2]) - MIN_BYTES + 1):
            for s, a, b in repeated_strings([k[2] for k in several], [found.held[k][0] for k in several]):
                doc_id, rows = found.held[several[s]]
                for uid, starts in rows.items():
                    removed.extend((uid, x + a, x + b, doc_id) for x in starts)
        out = ([gone] if len(gone[0]) else []) + ([_columns(removed)] if removed else [])
        return out, clash | np.uint64(bucket) << np.uint64(32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current, removed, clashes = [], None, [], []

        def judged():
            more, clash = close(current, held)
            removed.extend(more)
            if len(clash):
                clashes.append(clash)

        for batch in batches:
            passed = np.flatnonzero(batch.column("kind").to_numpy() == REMOVAL)
            if len(passed):
                yield batch.take(pa.array(passed))
            for bucket, kind, payload in zip(*(batch.column(c).to_pylist() for c in ("bucket", "kind", "payload"))):
                if kind != STRINGS:
                    continue
                if bucket != current and held:
                    judged()
                    held = []
                    if sum(len(r[0]) for r in removed) > 1 << 19:
                        yield _removals(removed, slots, buckets)
                        removed = []
                current = bucket
                held.append(payload)
        if held:
            judged()
        if removed:
            yield _removals(removed, slots, buckets)
        if clashes:
            yield _rows([0], CLASH, [0], [_dump(np.concatenate(clashes))])

    return map_batches(dealt, run, ROW)


def covered(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs covered by spans."""
    if not len(starts):
        return []
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(np.append(True, starts[1:] > ends[:-1]))
    return list(zip(starts[new].tolist(), ends[np.append(new[1:], len(starts)) - 1].tolist()))


def _apply(joined: DataFrame) -> DataFrame:
    """Step 4. Documents after their removals, sorted by slot and kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for payloads, ids, uids, texts in _with_replies(batches):
            parts = [_load(p) for p in payloads]
            uid = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.uint64)
            start = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int64)
            end = np.concatenate([p[2] for p in parts]) if parts else np.zeros(0, np.int64)
            check = np.concatenate([p[3] for p in parts]) if parts else np.zeros(0, np.uint16)
            order = np.argsort(uid, kind="stable")
            uid, start, end, check = uid[order], start[order], end[order], check[order]
            lo, hi = np.searchsorted(uid, uids, "left"), np.searchsorted(uid, uids, "right")
            rows = []
            for doc_id, own_check, a, b, text in zip(ids, check_bits(ids), lo.tolist(), hi.tolist(), texts):
                own = check[a:b] == own_check
                runs = covered(start[a:b][own], end[a:b][own])
                digest, at = hashlib.sha256(), 0
                for x, y in runs:
                    digest.update(text[at:x])
                    at = y
                digest.update(text[at:])
                rows.append((doc_id, len(text), sum(y - x for x, y in runs), len(runs), digest.hexdigest(), [v for r in runs for v in r]))
            kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    return map_batches(joined, run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>")


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans`` of every row: bytes covered by a string of MIN_BYTES that
    also starts in a document with a smaller id are removed; ``spans`` holds the removed runs as start, end, start, ...
    in bytes of the UTF-8 text, judged on the input.

    A null text is empty. Rows that repeat an id do not remove each other's bytes, and equal rows have equal
    results; a row without an id is ranked before all others. Texts below MIN_BYTES bytes keep all. Other columns
    are ignored.

    Two strings around one anchor pass for equal where 96 bits of hash agree, and the removals of two documents are
    mixed up where 80 bits of their ids and texts do; nothing else rests on hashes."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    doc_id = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    size = docs.agg(F.sum(F.octet_length(text)).alias("b"), F.count(F.lit(1)).alias("n")).first()
    total = size["b"] or 0
    buckets, slots = tasks_for(total, BUCKET_BYTES, 24), tasks_for(total, SLOT_BYTES, 64)
    uid = F.xxhash64(doc_id, text)
    rows = docs.select(
        F.lit(None).cast("int").alias("bucket"), F.lit(DOCUMENT).alias("kind"),
        F.pmod(uid.bitwiseAND(F.lit(int(UID))), F.lit(slots)).cast("int").alias("slot"),
        doc_id.alias("doc_id"), uid.alias("uid"), text.cast("binary").alias("payload"))
    shared = _find_shared(rows, buckets, slots, max(HOT_LEAST, size["n"] // HOT_SHARE))
    hot = [_load(r["payload"]) for r in shared.where(F.col("kind") == HOT).select("payload").collect()]
    hot_keys = np.concatenate(hot) if hot else np.zeros(0, np.uint64)  # at most HOT_SHARE times a document's anchors

    def with_documents(payloads: DataFrame) -> DataFrame:
        return _packed(rows, slots, buckets).unionByName(payloads).repartition(slots, "slot").sortWithinPartitions("slot", "kind")

    clashes = np.zeros(0, np.uint64)
    while True:
        cut = _cut_strings(with_documents(shared.where(F.col("kind") == REPLY)), buckets, slots, hot_keys, clashes)
        dealt = cut.repartition(buckets, "bucket").sortWithinPartitions("bucket")
        removals = save(_judge(dealt, slots, buckets), "suffix-removals")
        found = [_load(r["payload"]) for r in removals.where(F.col("kind") == CLASH).select("payload").collect()]
        if not found:
            break
        clashes = np.union1d(clashes, np.concatenate(found))  # one anchor in 2^32 of those whose strings differ
    done = _apply(with_documents(removals.where(F.col("kind") == REMOVAL)))
    return done.withColumn("doc_id", F.when(F.col("doc_id") != -(1 << 63), F.col("doc_id")))
