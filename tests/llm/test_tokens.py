"""Tokens, token files and packing, against the library itself and plain sequential code."""

import bisect
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from fixtures import documents, frame, rows_of

from clickloom.llm.binary_output import decode_numbers, encode_documents, encode_numbers
from clickloom.llm.packing import CapacityTree, pack, plan_runs
from clickloom.llm.tokens import END_ID, Tokens, default_path

ALPHABET = " \n\t\r\x0b\x1c\xa0 　\u0085abéÀ日'st1,.!#<|>"


@pytest.fixture(scope="module")
def coder():
    return Tokens(default_path())


def library_ids(coder, text):
    return [*coder.library.encode(text or "", add_special_tokens=False).ids, END_ID]


def test_ids_are_those_of_the_library(coder):
    rng = random.Random(4)
    texts = ["", " ", "a  b", "don't 'S it's", "<|endoftext|> x", "x\n\n y", "é è\nça va"] + [
        "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 30))) for _ in range(4000)] + [t or "" for _, t, *_ in documents()]
    column = pa.array(texts)
    for array in (column, column.slice(3)):
        for first, last, ids, bounds in coder.encode(array):
            for k in range(last - first):
                assert ids[bounds[k]:bounds[k + 1]].tolist() == library_ids(coder, array[first + k].as_py())


def test_added_tokens_keep_their_id(coder):
    from tokenizers import Tokenizer
    fresh, rng, end = Tokenizer.from_file(default_path()), random.Random(6), "<|endoftext|>"
    parts = [end, end, end[:7], end[7:], "<", ">", " ", "  ", "\n", "\n\n", "a", "don't", "é", "日", ".", "x9", "\u3000"]
    texts = [end, end + end, f"a {end} b", f"a{end}\nb", end[:7], end[7:], f"{end[:7]}{end}", "x"] + [
        "".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(4000)]
    assert fresh.encode(end, add_special_tokens=False).ids == [50256]
    for first, last, ids, bounds in coder.encode(pa.array(texts)):
        for k in range(last - first):
            assert ids[bounds[k]:bounds[k + 1]].tolist() == [*fresh.encode(texts[first + k], add_special_tokens=False).ids, END_ID]


def test_small_tables_start_anew():
    small = Tokens(default_path(), slots=1 << 12)
    texts = [f"word{k} other{k * 7}" for k in range(40)]
    for _ in range(40):
        texts = [t + "x" for t in texts]
        for first, last, ids, bounds in small.encode(pa.array(texts)):
            assert ids[bounds[0]:bounds[1]].tolist() == library_ids(small, texts[first])


def test_numbers_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 1000):
        numbers = (rng.integers(0, 2**32, n) >> rng.integers(0, 32, n)).astype(np.uint32)
        assert decode_numbers(*encode_numbers(numbers), n).tolist() == numbers.tolist()


def test_files_hold_every_document_in_order(spark, coder):
    got = encode_documents(frame(spark)).collect()
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    assert [-1 if r.doc_id is None else r.doc_id for r in got] == sorted(-1 if i is None else i for i, *_ in documents())
    expected = sorted((repr(i), zlib.crc32(np.array(library_ids(coder, t), "<u4").tobytes())) for i, t, *_ in documents())
    assert sorted((repr(r.doc_id), r.ids_crc32) for r in got) == expected
    assert encode_documents(frame(spark, [])).collect() == []


def test_runs_are_best_fit_decreasing():
    rng = random.Random(2)
    for _ in range(200):
        capacity = rng.choice((7, 16, 100))
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 120))]
        histogram = {x: lengths.count(x) for x in set(lengths)}
        used, seen = {}, {}
        for length, first, count, sequence, per, offset in plan_runs(histogram, capacity):
            assert first == seen.get(length, 0)
            seen[length] = first + count
            for k in range(count):
                used.setdefault(sequence + k // per, []).append((offset + k % per * length, length))
        assert seen == histogram
        for places in used.values():
            ends = [a + n for a, n in sorted(places)]
            assert [a for a, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= capacity
        room, count = [], 0
        for length in sorted(lengths, reverse=True):
            at = bisect.bisect_left(room, length)
            if at == len(room):
                count, left = count + 1, capacity - length
            else:
                left = room.pop(at) - length
            if left:
                bisect.insort(room, left)
        assert len(used) == count


def test_tree_finds_the_tightest():
    tree, rng, rooms = CapacityTree(50), random.Random(3), []
    for _ in range(300):
        room = rng.randint(1, 50)
        tree.add(room, 1)
        rooms.append(room)
        if rng.random() < 0.5:
            tree.add(rooms.pop(rng.randrange(len(rooms))), -1)
        want = rng.randint(1, 50)
        assert tree.tightest(want) == min((r for r in rooms if r >= want), default=None)


def test_pieces_are_packed_without_gaps(spark, coder):
    got = pack(frame(spark), capacity=256).collect()
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        ends = [a + n for a, n in sorted(places)]
        assert [a for a, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 256
    expected = []
    for i, text, *_ in documents():
        ids = library_ids(coder, text)
        head = len(ids) - (-(-len(ids) // 256) - 1) * 256
        cuts = [0, *range(head, len(ids) + 1, 256)]
        expected += [(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(expected, key=repr)
    assert rows_of(pack(frame(spark, []))) == []


def test_runs_with_more_units_than_the_tables_hold():
    small = Tokens(default_path(), slots=1 << 8)
    texts = [" ".join(f"w{k}" for k in range(3000)), None, " ".join(f"v{k % 70}" for k in range(2000)) + "\n\nend", ""]
    got = [ids[a:b].tolist() for _, _, ids, at in small.encode(pa.array(texts, pa.string())) for a, b in zip(at[:-1], at[1:])]
    assert got == [library_ids(small, t) for t in texts]
