import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import edge
from bookbase.llm import packing


def one_by_one(lengths, capacity):
    """Free room of each bin after best-fit decreasing, item by item."""
    room = []
    for length in sorted(lengths, reverse=True):
        fitting = [(r, i) for i, r in enumerate(room) if r >= length]
        if fitting:
            room[min(fitting)[1]] -= length
        else:
            room.append(capacity - length)
    return room


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=80))
def test_plan_is_best_fit_decreasing(lengths):
    counts = Counter(lengths)
    bins = {}
    for length, first, last, start, each, used in packing.plan(counts, 30):
        for k in range(last - first):
            bins.setdefault(start + k // each, []).append((used + k % each * length, length))
    placed = Counter()
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
            placed[length] += 1
        assert at <= 30
    assert placed == counts
    free = sorted(30 - sum(length for _, length in items) for items in bins.values())
    assert free == sorted(one_by_one(lengths, 30))


@given(st.sets(st.integers(0, 100)), st.integers(0, 100))
def test_tree_finds_tightest(open_at, asked):
    tree = packing.Tightest(100)
    for c in open_at:
        tree.mark(c, True)
    assert tree.least(asked) == min((c for c in open_at if c >= asked), default=None)


def test_pieces_hold_the_tokens(spark):
    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = packing.pack_documents(edge.documents(spark)).collect()
    left = Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got)
    for d, t, *_ in edge.rows():
        ids = np.array([*slow.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        at, piece = 0, 0
        first = len(ids) % 2048 or 2048
        while at < len(ids):
            size = first if piece == 0 else 2048
            left[(d, piece, at, size, zlib.crc32(ids[at:at + size].tobytes()))] -= 1
            at, piece = at + size, piece + 1
    assert not +left and min(left.values()) == 0
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) == len(one_by_one([r["length"] for r in got], 2048))


def test_fast_and_slow_ids_agree():
    fast = packing.default_tokens()
    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ["", " ", "  a  b\n\n c\t", "don't we'll I'M", "é ß 漢字🙂", "1234,5 % $$", "x" * 500, "<|endoftext|>a"]:
        assert fast(text).tolist() == slow.encode(text, add_special_tokens=False).ids


def test_empty_table(spark):
    assert packing.pack_documents(edge.documents(spark, [])).count() == 0
