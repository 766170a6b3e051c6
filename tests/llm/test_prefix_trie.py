"""The conversation trie against a plain model, and the spilling queue against sorting."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from fixtures import rows_of

from clickloom.llm import prefix_trie
from clickloom.llm.common import table
from clickloom.llm.forward import SpillingQueue

SCHEMA = "conv_id long, turn long, role string, text string, depth int, shard string, leaves int, up string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def expected(rows) -> list[tuple]:
    turns = defaultdict(list)
    for r in rows:
        if r["conv_id"] is not None:
            role, text = r["role"] or "", r["text"] or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            turns[r["conv_id"]].append((r["turn"] is not None, r["turn"] or 0, tie, (role, text)))
    plain = {c: [t[-1] for t in sorted(ts)] for c, ts in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, own in plain.items():
        h = zlib.crc32(str(c).encode()) % 9
        leader = c - (c % 5 if c >= 0 else -(-c % 5))
        path = tuple(plain.get(leader, [])[:h] + own[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, ids in members.items():
        size = (len(ids) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += size
            leaves[node[:d]] += not children[node]
    return sorted(((min(ids), len(n), min(members[n[:-1]]) if n else None, len(ids), children[n], leaves[n], saved[n],
                    hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, ids in members.items()), key=repr)


def made(seed: int, n: int, long: int = 0) -> list[tuple]:
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(-20, 4 * n), n):
        for t in range(rng.choice((0, 1, 3, 9, 12))):
            rows.append((c, rng.choice((None, t, t, t)), rng.choice(("user", "user", None)), rng.choice((None, "", "é", f"t{t}", f"t{t}")),
                         1, "x", 2, "u"))
    rows += [(5, t, "user", f"t{t % 3}", 1, "x", 2, "u") for t in range(long)]
    rows += [(None, 0, "user", "nobody", 1, "x", 2, "u")] + rows[:4]
    return rows


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(prefix_trie.trie(df).select(*COLUMNS)) == expected(df.collect())


def test_awkward_rows(spark):
    check(spark, made(1, 30))


def test_empty_table(spark):
    check(spark, [])


def test_turnless_conversations_end_at_the_root(spark):
    check(spark, [(c, 0, "user", "only turn " * 2000, 1, "x", 2, "u") for c in range(1, 40)])


@pytest.mark.parametrize("shards", [1, 2])
def test_root_has_no_parent_in_any_shard(spark, monkeypatch, shards):
    monkeypatch.setattr(prefix_trie, "partitions", lambda session: shards)
    for first in (0, 64, 6400):  # the root's shard goes with the smallest id
        check(spark, [(first + c, t, "user", f"t{t}", 1, "x", 2, "u") for c in range(6) for t in range(12)])


def test_long_conversation_over_many_blocks_and_shards(spark, monkeypatch):
    for name, size in (("BLOCK", 16), ("CHUNK", 2), ("OWNERS", 3), ("LEVELS", 4)):
        monkeypatch.setattr(prefix_trie, name, size)
    check(spark, made(2, 40, long=150))


def test_many_copies_of_one_conversation(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    rows = [(5 * c, t, "user", f"t{t}", 1, "x", 2, "u") for c in range(60) for t in range(3)]
    check(spark, rows + made(3, 10))


def test_registered_query(spark, sf_dir):
    got = rows_of(prefix_trie.op12_prefix_trie(spark, sf_dir).select(*COLUMNS))
    assert got == expected(table(spark, sf_dir, "conversations").collect())


def test_sql_gives_the_same_rows(spark):
    df = spark.createDataFrame(made(4, 40), SCHEMA)
    conversations = df.toArrow()  # noqa: F841
    got = duckdb.sql(prefix_trie.OP12_SQL).select(", ".join(COLUMNS)).fetchall()
    assert sorted(got, key=repr) == expected(df.collect())


@pytest.mark.parametrize("most", [1, 3, 1000])
def test_queue_spills_and_keeps_order(most):
    rng, queue, held, out, wanted = random.Random(most), SpillingQueue(most), [], [], []
    for step in range(1500):
        message = (step // 3 + rng.randrange(1, 40), rng.randrange(9), step, -step)
        queue.push(message)
        held.append(message)
        while held and min(held)[0] <= step // 3:
            held.sort()
            wanted.append(held.pop(0))
            out.append(queue.pop())
    while queue.first() is not None:
        out.append(queue.pop())
    assert out == wanted + sorted(held)
