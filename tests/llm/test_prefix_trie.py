import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlake.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(data):
    own = {}
    for conv, turn, role, text in data:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    # turns of one number by digest, as the operator's docstring says
    def order(t):
        return (*t[:2], hashlib.md5(f"{len(t[2])}:{t[2]}{t[3]}".encode()).hexdigest())

    own = {c: [t[2:] for t in sorted(ts, key=order)] for c, ts in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    found = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in members if len(n) == len(node) + 1 and n[:-1] == node]
        parents = {n[:-1] for n in below if n}
        ends = ",".join(str(c) for c in sorted(convs) if len(built[c]) == len(node))
        found.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children),
            sum(n not in parents for n in below), sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(found, key=str)


def result(df):
    nodes = prefix_trie.trie(prefix_trie.shared_openings(prefix_trie.paths(df)))
    assert nodes.columns == prefix_trie.RESULT
    return sorted((tuple(r) for r in nodes.collect()), key=str)


def conversations():
    rng = random.Random(13)
    data = []
    for conv in [*range(0, 130), *range(250, 330), 700]:
        for turn in range(rng.randint(1, 9)):
            data.append((conv, turn if turn else rng.choice([0, None]), rng.choice(["user", "assistant", None]), rng.choice(["a", "Ü🙂", "", None, "b c"])))
    # a third are equal, some of these share a long opening, one is deep
    data += [(c, t, "user", "same") for c in range(1000, 1100) for t in range(7)]
    data += [(c, t, "user", "same" if t < 8 else f"own {c}") for c in range(1100, 1130) for t in range(10)]
    data += [(2000, t, "user", f"deep {t}") for t in range(60)]
    return data + [(None, 0, "user", "no id"), (3000, 1, "user", "tie"), (3000, 1, "assistant", "tie"), (3000, 1, "user", "tie")]


@pytest.mark.parametrize("shard", [20_000, 40, 7])
def test_equals_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", shard)
    monkeypatch.setattr(prefix_trie, "BLOCK", 8)
    data = conversations()
    df = spark.createDataFrame(data, SCHEMA).withColumn("path", F.lit("x")).withColumn("H", F.lit(1)).repartition(5)
    assert result(df) == brute(data)


def test_empty_and_turnless(spark):
    assert result(spark.createDataFrame([], SCHEMA)) == []
    # only conversations whose turns all go, with no opening to take their place
    gone = [c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 >= 1]
    data = [(c, 0, "user", "x") for c in gone]
    assert result(spark.createDataFrame(data, SCHEMA)) == brute(data)
    assert len(brute(data)) == 1


def test_parentheses(monkeypatch):
    rng = random.Random(4)
    for block in (1, 4, 256):
        monkeypatch.setattr(prefix_trie, "BLOCK", block)
        for _ in range(60):
            bits, depth = [True], 1
            for _ in range(rng.randint(0, 200)):
                up = depth == 1 or rng.random() < 0.5
                bits.append(up)
                depth += 1 if up else -1
            bits += [False] * depth
            tree = prefix_trie.Parentheses(np.array(bits))
            stack, closes = [], {}
            for k, b in enumerate(bits):
                if b:
                    stack.append(k)
                else:
                    closes[stack.pop()] = k
            for at, close in closes.items():
                assert tree.close(at) == close
                inside = range(at, close)
                assert tree.nodes(at, close) == sum(bits[k] for k in inside)
                assert tree.leaves(at, close) == sum(bits[k] and not bits[k + 1] for k in inside)
