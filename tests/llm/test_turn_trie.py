import hashlib
import random
import zlib
from collections import defaultdict

import pyarrow as pa
import pytest

from foldmark.llm import queries as q
from foldmark.llm import turn_trie as t
from tests.llm.brute import rows_of
from tests.oracle import compare, connect

TABLE = "conv_id long, turn long, role string, text string, depth long, key binary, base long"


def conversations(spark, rows, partitions=3):
    """Turns with extra columns whose names clash with the operator's own."""
    return spark.createDataFrame([(*r, 1, b"k", 2) for r in rows], TABLE).repartition(partitions)


def turn_key(role, text):
    role, text = role or "", text or ""
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def plain(rows):
    held = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            held[c].append(((turn is not None, turn or 0), turn_key(role, text), (role or "", text or "")))
    original = {c: [x[2] for x in sorted(v, key=lambda x: x[:2])] for c, v in held.items()}
    family = lambda c: c - (abs(c) % 5) * (1 if c > 0 else -1)
    rebuilt = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(original.get(family(c), [])[:h] + own[h:])
    members = defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            members[rebuilt[c][:d]].append(c)
    children = defaultdict(list)
    for n in members:
        if n:
            children[n[:-1]].append(n)
    leaves, saved = {}, {}
    for n in sorted(members, key=len, reverse=True):
        own = (len(members[n]) - 1) * len(n[-1][1].encode()) if n else 0
        leaves[n] = sum(leaves[k] for k in children[n]) if children[n] else 1
        saved[n] = own + sum(saved[k] for k in children[n])
    out = []
    for n, m in members.items():
        ends = ",".join(str(c) for c in m if rebuilt[c] == n)
        up = members[n[:-1]][0] if n else None
        out.append(repr((m[0], len(n), up, len(m), len(children[n]), leaves[n], saved[n], hashlib.sha256(ends.encode()).hexdigest())))
    return sorted(out)


def got(df):
    return sorted(repr(tuple(x[c] for c in t.COLUMNS)) for x in rows_of(df))


def some_turns(seed, n=150, texts=4, longest=12):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        if rng.random() < 0.15:
            continue
        for k in range(rng.randint(1, longest)):
            rows.append((c, k, rng.choice(["user", "assistant"]), rng.choice(["", "é", "hi", "a long one"][:texts])))
    return rows


def test_whole_table_against_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert compare(q.op13_turn_trie(spark, sf), connect(sf), t.ORACLE_SQL) is None


@pytest.mark.parametrize("cells", [1, 30, 1 << 20])
def test_random_conversations(spark, cells):
    for seed, texts in ((1, 1), (2, 4)):
        rows = some_turns(seed, texts=texts)
        assert got(t.trie_nodes(conversations(spark, rows), cells=cells, salts=3)) == plain(rows)


def test_odd_rows(spark):
    rows = some_turns(5, 40)
    rows += [(60, None, None, None), (60, None, "user", "x"), (60, 1, "user", "x"), (60, 1, "user", "x"), (60, 1, "assistant", "x")]
    rows += [(None, 1, "user", "lost"), (None, None, None, None)]
    rows += [(65, k, "user", f"t{k % 7}") for k in range(1500)]  # very long
    rows += [(66, 0, "user", "only"), (70, 0, "user", "w" * 300000), (-3, 0, "user", "a"), (-3, 1, "user", "b"), (-5, 0, "user", "a"), (0, 99, "user", "z")]
    rows += [(c, k, "user", f"copy{k}") for c in range(1000, 1200) for k in range(12)]  # equal throughout
    for cells in (50, 1 << 20):
        assert got(t.trie_nodes(conversations(spark, rows, 5), cells=cells)) == plain(rows)


def test_empty_table(spark):
    assert t.trie_nodes(conversations(spark, [(None, 1, "user", "x")])).count() == 0
    assert t.trie_nodes(conversations(spark, [(1, 1, "user", "x")]).limit(0)).count() == 0


def test_turnless_conversations(spark):
    turnless = [c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1][:6]
    rows = [(c, 0, "user", "x") for c in turnless if c - c % 5 not in turnless]
    found = rows_of(t.trie_nodes(conversations(spark, rows)))
    assert len(found) == 1 and found[0]["n_children"] == 0 and found[0]["n_leaves"] == 1 and got(t.trie_nodes(conversations(spark, rows))) == plain(rows)


def test_members_stream_over_batches():
    one, two = b"a" * 16, b"b" * 16
    rows = [(one, b"1,2"), (one, b"3"), (two, b"9")]
    batches = [pa.RecordBatch.from_pylist([{"node": n, "ids": i}]) for n, i in rows]
    found = dict(x for out in t.ends_of_nodes(iter(batches)) for x in out)
    assert found == {one: hashlib.sha256(b"1,2,3").hexdigest(), two: hashlib.sha256(b"9").hexdigest()}
