"""Operator 13 against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.rows import FOLDER, empty
from weftgraph.llm import prefix_trie
from weftgraph.llm.queries import queries

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows, rebuild=True):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            convs[conv].append(((turn is not None, turn or 0), role.encode(), digest, (role, text)))
    convs = {c: [t[-1] for t in sorted(turns)] for c, turns in convs.items()}
    if rebuild:
        own, convs = convs, {}
        for c, turns in own.items():
            h = zlib.crc32(str(c).encode()) % 9
            base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
            convs[c] = own.get(base, [])[:h] + turns[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in sorted(convs.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children, leaves, saved = Counter(), Counter(), Counter()
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, of in members.items():
        cost = (len(of) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += cost
            leaves[node[:d]] += children[node] == 0
    return Counter(
        (of[0], len(n), members[n[:-1]][0] if n else None, len(of), children[n], leaves[n], saved[n], hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest())
        for n, of in members.items()
    )


def _found(frame):
    return Counter(tuple(r[c] for c in COLUMNS) for r in frame.collect())


def _rebuilt(frame, shape=prefix_trie.Shape(), **names):
    ids = F.col("conv_id")
    return prefix_trie.conversation_trie(frame, ids - ids % 5, F.crc32(ids.cast("string").cast("binary")) % 9, shape=shape, **names)


def awkward_turns(spark):
    """Shared openings, copies, prefixes of others, long conversations, ties, nulls and odd ids."""
    rng = random.Random(2)
    say = lambda: rng.choice(["yes", "no", "maybe é", "", None, "on\ngo"])
    rows = []
    for c in range(60):
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", say()) for t in range(rng.randrange(1, 11))]
    rows += [(100 + c, t, "user", "the same") for c in range(40) for t in range(3)]
    rows += [(200 + c, t, "user", f"turn {t}") for c in range(3) for t in range(37 + 5 * c)]
    rows += [(210, t, "user", f"turn {t}") for t in range(32)] + [(212, t, "user", f"turn {t}") for t in range(16)]
    rows += [(300, None, "user", "first"), (300, None, None, None), (300, 0, "b", "x"), (300, 0, "a", "x"), (300, 0, "a", "x"), (300, -1, "a", "z")]
    rows += [(-7, 0, "user", "below zero"), (-5, 0, "user", "base"), (-5, 1, None, "x"), (None, 0, "user", "nobody"), (403, 0, None, None)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)


SHAPES = [prefix_trie.Shape(), prefix_trie.Shape(7, 4), prefix_trie.Shape(3, 1)]


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("rebuild", [True, False])
def test_nodes(spark, shape, rebuild):
    turns = awkward_turns(spark)
    found = _rebuilt(turns, shape) if rebuild else prefix_trie.conversation_trie(turns, shape=shape)
    assert _found(found) == brute([tuple(r) for r in turns.collect()], rebuild)


def test_keys_do_not_depend_on_shards(spark):
    turns = awkward_turns(spark)
    keys = [set(map(bytes, (r.node for r in prefix_trie.conversation_trie(turns, shape=s).select("node").collect()))) for s in (prefix_trie.Shape(7, 4), prefix_trie.Shape(500, 4))]
    assert keys[0] == keys[1]


def test_only_turnless_and_no_conversations(spark):
    turns = spark.createDataFrame([(403, 0, None, None), (402, 5, "user", "x")], "conv_id long, turn long, role string, text string")
    assert _found(_rebuilt(turns)) == brute([tuple(r) for r in turns.collect()])
    assert _rebuilt(empty(turns)).count() == 0


def test_clashing_names(spark):
    turns = awkward_turns(spark)
    renamed = turns.withColumnsRenamed({"conv_id": "node", "turn": "position", "role": "hash", "text": "bytes"}).selectExpr("*", "7 AS conv_id", "'x' AS shard", "8 AS turn")
    found = prefix_trie.conversation_trie(renamed, conv_col="node", turn_col="position", role_col="hash", text_col="bytes")
    assert _found(found) == brute([tuple(r) for r in turns.collect()], False)


def test_query(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").collect()]
    found = queries()["op13_prefix_trie"](spark, FOLDER)
    assert sorted(found.columns) == sorted(COLUMNS) and all(found.schema[c].dataType.simpleString() == "bigint" for c in COLUMNS[:-1])
    assert _found(found) == brute(rows)
