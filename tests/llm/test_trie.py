"""Prefix trie against a trie put together from whole sequences."""

import hashlib
import os
import random
import sys
import zlib
from collections import defaultdict

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from ripplekit.llm import prefix_trie  # noqa: E402
from ripplekit.llm.queries import op13_prefix_trie  # noqa: E402

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, depth string, s0 int"


def brute_force(rows):
    """All nodes from (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, role,
                           hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), text))
    own = {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(own.get(c - c % 100, [])[:h] + own[c][h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, seq in sorted(rebuilt.items()):
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, convs in members.items():
        own_saved = (len(convs) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += own_saved
    return sorted((min(convs), len(node), min(members[node[:-1]]) if node else -1, len(convs), children[node],
                   leaves[node], saved[node], hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest())
                  for node, convs in members.items())


def result(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children,
                   r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


@pytest.mark.parametrize("limit,queue,chunk", [(None, 1000, 1000), (3, 4, 2), (1, 2, 1)])
def test_trie(spark, limit, queue, chunk):
    """Shared and own turns, nulls, ties, repeated rows, a common start, equal
    conversations; with shards, spilled queues and several chunks."""
    rnd = random.Random(limit)
    rows = []
    for c in [*range(0, 40), *range(100, 130), 205, 206, 1000, 1001]:
        for turn in range(rnd.randint(1, 9)):
            text = rnd.choice(["a", "b", "é\U0001F600", "", None, "long " * 40])
            if c in range(10, 30):
                text = "same"
            rows.append((c, rnd.choice([turn, turn, None, 3]), rnd.choice(["user", "user", None]), text))
    rows += rows[:20] + [(None, 1, "user", "no id")]
    rnd.shuffle(rows)
    assert result(prefix_trie.prefix_trie(frame(spark, rows), limit, queue, chunk)) == brute_force(rows)


def test_empty_and_turnless(spark):
    assert prefix_trie.prefix_trie(frame(spark, [])).count() == 0
    assert prefix_trie.prefix_trie(frame(spark, [(None, 0, "r", "t")])).count() == 0
    # no first conversation in its group, and all own turns among the first h
    rows = [(c, 0, "r", "t") for c in range(501, 520)]
    assert any(zlib.crc32(str(c).encode()) % 6 for c in range(501, 520))
    assert result(prefix_trie.prefix_trie(frame(spark, rows))) == brute_force(rows)


def test_spilling_queue():
    rnd = random.Random(1)
    queue, held = prefix_trie.SpillingQueue(3, 7), []
    queue.BLOCK = 2
    for key in range(60):
        for _ in range(rnd.randint(0, 9)):
            held.append((rnd.randint(key, 70), rnd.randint(0, 3), rnd.randint(-2**40, 2**40)))
            queue.push(held[-1])
        got = [tuple(r) for r in queue.take((key,))]
        assert got == sorted(r for r in held if r[0] == key)
        held = [r for r in held if r[0] != key]
    assert len(queue.runs) > 5


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert result(op13_prefix_trie(spark, SF)) == brute_force(rows)
