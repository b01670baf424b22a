import random

import numpy as np
import pytest
from brute import CLASHING, counted, edge_rows, frame, repeated_bytes

from vetrow.llm import suffix_dedup


def results(df):
    return counted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect())


def test_edge_table_against_brute_force(spark):
    rows = edge_rows()
    assert results(suffix_dedup.remove_repeats(frame(spark, rows, CLASHING))) == counted(repeated_bytes(rows))


@pytest.mark.parametrize("hot", [20_000, 2])
def test_overlapping_repeats(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_LEAST", hot)
    rng = random.Random(hot)
    base = ["".join(rng.choice("ab é") for _ in range(rng.randint(30, 300))) for _ in range(6)]
    rows = []
    for i in range(60):
        text = ""
        for _ in range(rng.randint(0, 6)):
            x = rng.choice(base)
            a = rng.randint(0, len(x))
            text += x[a: rng.randint(a, len(x))] + rng.choice(["", "q", "zz", "".join(rng.choice("xyz") for _ in range(20))])
        rows.append((i if rng.random() < 0.9 else max(0, i - 1), text))
    rows += [(102, "a" * 400), (103, "a" * 300), (104, "ab" * 200), (105, "ab" * 80), (106, "b" + "a" * 49), (107, "a" * 49)]
    assert results(suffix_dedup.remove_repeats(frame(spark, rows))) == counted(repeated_bytes(rows))


def test_segments_do_not_matter(monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abc") for _ in range(rng.randint(0, 900))).encode() for _ in range(12)]

    def strings():
        doc, first, count, x, _ = suffix_dedup.anchors(texts)
        return sorted((d, s + k, h) for d, s, n, h in zip(doc.tolist(), first.tolist(), count.tolist(), x.tolist()) for k in range(n))

    whole = strings()
    assert len(whole) == sum(max(0, len(t) - 49) for t in texts)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 100)
    assert strings() == whole


def test_maximal_repeats_hold_all_occurrences():
    rng = random.Random(8)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(6, 18))) for _ in range(8)]
    array = suffix_dedup.SuffixArray(strings, least=4)
    got = {}
    for length, first, last in array.maximal_repeats(4):
        members = [(int(array.string[i]), int(array.offset[i])) for i in range(first, last + 1)]
        s, o = members[0]
        assert strings[s][o: o + length] not in got  # a repeat is one group
        got[strings[s][o: o + length]] = sorted(members)
    want = {}
    for s in strings:
        for a in range(len(s)):
            for b in range(a + 4, len(s) + 1):
                word = s[a:b]
                places = [(i, o) for i, t in enumerate(strings) for o in range(len(t) - len(word) + 1) if t[o: o + len(word)] == word]
                lefts = {strings[i][o - 1] if o else ("start", i) for i, o in places}
                rights = {strings[i][o + len(word)] if o + len(word) < len(strings[i]) else ("end", i) for i, o in places}
                if len(places) > 1 and len(lefts) > 1 and len(rights) > 1:
                    want[word] = sorted(places)
    assert {w: p for w, p in got.items()} == want


def test_strings_that_meet_in_32_bits_of_hash(spark):
    """Two documents that share 16 bytes, around which 32-bit hashes agree, and nothing else; beside them a true copy, and
    documents that share 50 bytes of one of them."""
    one, two = "ghiwquffbhlru vpgmxlynzfnjspvkpfbrumjxteenubulqr p", "sdkebpynjldmcfxwvmxlynzfnjspvkpfbpwiczjntunkjbizsj"
    assert suffix_dedup.anchors([one.encode()])[4][0] == suffix_dedup.anchors([two.encode()])[4][0]
    rows = [(1, one), (2, two)]
    assert [r["n_removed"] for r in suffix_dedup.remove_repeats(frame(spark, rows)).collect()] == [0, 0]
    rows += [(3, two), (4, "x" + one), (5, two + "y"), (6, one), (6, one)]
    assert results(suffix_dedup.remove_repeats(frame(spark, rows))) == counted(repeated_bytes(rows))


def test_documents_that_meet_in_their_row_hash():
    ids = list(range(2000))
    checks = suffix_dedup.check_bits(ids)
    assert len(np.unique(checks)) > 1900
    uid = np.full(2, 77, np.uint64)
    batch = suffix_dedup._removals([(uid, np.array([0, 100]), np.array([50, 160]), np.array([1, 2]))], 8, 1)
    found = suffix_dedup._load(batch.column("payload")[0].as_py())
    assert sorted(zip(*(c.tolist() for c in found[1:]))) == sorted([(0, 50, int(checks[1])), (100, 160, int(checks[2]))])


def test_equal_strings_by_128_bits():
    n = 300
    rng = np.random.default_rng(1)
    same = {"h": rng.integers(0, 5, n).astype(np.uint64), "one": rng.integers(0, 2, n).astype(np.uint64), "two": rng.integers(0, 2, n).astype(np.uint64),
            "size": np.full(n, 50), "doc": rng.integers(0, 9, n), "uid": np.arange(n).astype(np.uint64), "start": np.arange(n)}
    stay, gone, clash = suffix_dedup.first_documents(same)
    least = {}
    for h, a, b, d in zip(same["h"], same["one"], same["two"], same["doc"]):
        least[h, a, b] = min(d, least.get((h, a, b), 99))
    want = {int(u) for u, h, a, b, d in zip(same["uid"], same["h"], same["one"], same["two"], same["doc"]) if d > least[h, a, b]}
    assert set(gone[0].tolist()) == want and set(stay["uid"].tolist()) == set(range(n)) - want
    assert clash.tolist() == [0, 1, 2, 3, 4]


def test_empty_table(spark):
    assert suffix_dedup.remove_repeats(frame(spark, [])).collect() == []


def test_payloads_of_a_large_input_are_not_too_many():
    """Each batch has one for each bucket and each bucket one for each slot."""
    text = 10 << 30
    buckets, batches, slots = (-(-text // size) for size in (suffix_dedup.BUCKET_BYTES, suffix_dedup.BATCH_BYTES, suffix_dedup.SLOT_BYTES))
    assert batches * buckets < 2_000_000 and buckets * slots < 3_000_000 and batches * slots < 2_000_000


def test_strings_of_a_bucket_go_into_bounded_arrays(spark, monkeypatch):
    """Anchors are kept whole, and what is found does not change."""
    groups = [[b"a" * 60] * n for n in (3, 1, 9, 2, 2)]
    bundled = list(suffix_dedup.bundles(groups, lambda s: len(s) - 49, 50))
    assert [len(b) for b in bundled] == [4, 9, 4] and sum(bundled, []) == sum(groups, [])
    assert list(suffix_dedup.bundles([], len)) == []
    rng = random.Random(5)
    strings = ["".join(rng.choice("abcdefgh") for _ in range(90)) for _ in range(40)]
    rows = [(i, rng.choice(strings)[: rng.randint(50, 90)] + "".join(rng.choice("uvwxyz") for _ in range(30)) + rng.choice(strings)[rng.randint(0, 40):])
            for i in range(120)]
    found, documents = [], []
    for s in strings:
        for cut in (60, 70, 80):
            documents.append(len(documents))
            found.append(s[:cut].encode())
    whole = suffix_dedup.repeated_strings(found, documents)
    parts = [suffix_dedup.repeated_strings(b, documents[i * 3: i * 3 + 3]) for i, b in enumerate(suffix_dedup.bundles([found[i: i + 3] for i in range(0, 120, 3)], len, 1))]
    assert sorted((3 * i + s, a, b) for i, p in enumerate(parts) for s, a, b in p) == whole
    assert results(suffix_dedup.remove_repeats(frame(spark, rows))) == counted(repeated_bytes(rows))


def test_suffixes_are_in_the_order_of_their_bytes():
    rng = random.Random(9)
    strings = [bytes(rng.choice((0, 1, 97, 128, 255)) for _ in range(rng.randint(6, 20))) for _ in range(60)] + [b"\0" * 9, b"\0" * 8, b"a\0\0\0\0"]
    array = suffix_dedup.SuffixArray(strings, least=4)
    suffixes = [strings[s][o:] for s, o in zip(array.string.tolist(), array.offset.tolist())]
    assert len(suffixes) == sum(len(s) - 3 for s in strings) and [s.ljust(24, b"\0") for s in suffixes] == sorted(s.ljust(24, b"\0") for s in suffixes)
    for a, b, n in zip(suffixes, suffixes[1:], array.lcp.tolist()):
        assert a[:n] == b[:n] and (n == min(len(a), len(b)) or a[n] != b[n])
