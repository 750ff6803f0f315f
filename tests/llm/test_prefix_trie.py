import random
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import pytest

from flightloom.llm import prefix_trie
from flightloom.llm.prefix_trie import build_trie, chained, trie_nodes, turn_lists
from flightloom.llm.workload import op13_prefix_trie

COLUMNS = "conv_id long, turn int, role string, text string, node string, n long, path string, depth long, bytes int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "p", 2, 3) for r in rows], COLUMNS)


def gathered(rows):
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = sha256(f"{len(role)}:{role}{text}".encode()).digest()
            turns[c].append((t is not None, t or 0, tie, role, text))
    return {c: tuple((r, x) for *_, r, x in sorted(v)) for c, v in turns.items()}


def nodes(paths):
    """All nodes by way of dictionaries of beginnings."""
    members = defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    children = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
            leaves[k[:d]] += not children[k]
    out = []
    for k, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if paths[c] == k)))
        parent = min(members[k[:-1]]) if k else None
        out.append((min(m), len(k), parent, len(m), children[k], leaves[k], saved[k], sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def of(spark, rows):
    return found(trie_nodes(chained(turn_lists(table(spark, rows)))))


def conversation(c, texts):
    return [(c, i, "user" if i % 2 else "system", t) for i, t in enumerate(texts)]


def test_random_beginnings(spark):
    rng = random.Random(5)
    rows = []
    for c in range(120):
        rows += conversation(c, [rng.choice("aab") * rng.randrange(1, 3) for _ in range(rng.randrange(1, 9))])
    assert of(spark, rows) == nodes(gathered(rows))


def test_chain_of_nested_conversations(spark):
    """Each conversation goes on where another ends: the trie is one path with an end at each depth."""
    turns = [f"turn {i} ñ" for i in range(40)]
    rows = [r for c in range(40) for r in conversation(c, turns[: c + 1])]
    rows += conversation(50, turns[:30] + ["else"])
    assert of(spark, rows) == nodes(gathered(rows))


def test_copies_and_common_first_turns(spark, monkeypatch):
    """Also with handles that are too many to broadcast."""
    rows = [r for c in range(60) for r in conversation(c, ["hello", "there"])]
    rows += [r for c in range(100, 160) for r in conversation(c, ["hello", f"number {c}", "end"])]
    monkeypatch.setattr(prefix_trie, "fits_broadcast", lambda trie: False)
    assert of(spark, rows) == nodes(gathered(rows))


def test_edge_rows(spark):
    rows = [
        (1, None, "user", "first"), (1, 0, None, None), (1, 0, "user", None), (1, 0, "user", None),
        (2, None, "user", "first"), (2, 5, "", ""), (3, 0, "a", ":b"), (4, 0, "a:", "b"), (5, 0, "", "a:b"),
        (6, 0, "user", "x" * 100_000), (7, 0, "user", "x" * 100_000), (7, 1, "user", "日本 \U0001f600"),
        (None, 0, "user", "no id"), (2**62, 0, "user", "first"),
        *[(8, i, "user", f"{i % 7}") for i in range(300)], *[(9, i, "user", f"{i % 7}") for i in range(200)],
    ]
    assert of(spark, rows) == nodes(gathered(rows))


def test_no_conversations(spark):
    assert of(spark, []) == []
    assert of(spark, [(None, 0, "user", "no id")]) == []


def test_the_trie_is_compacted(spark):
    """As many edges as ends and branchings, however many turns; handles lie at two-fattest depths."""
    rows = conversation(1, "abcdefghijkl") + conversation(2, "abcdefghixyz") + conversation(3, "abcd")
    edges = build_trie(chained(turn_lists(table(spark, rows)))).collect()
    assert sorted((e.up, e.ends) for e in edges) == [(0, 4), (4, 9), (9, 12), (9, 12)]
    fat = {(0, 4): 4, (4, 9): 8, (9, 12): 12}
    for e in edges:
        at = (fat[e.up, e.ends] - e.up - 1) * 16
        assert e.handle == e.path[at : at + 16] and e.node == e.path[-16:] and e.first == e.path[:16]


@pytest.mark.parametrize("small", [True, False])
def test_fat_search_reaches_the_exit(spark, small):
    """Every depth of a long edge as the place where another path leaves it."""
    base = [f"t{i}" for i in range(33)]
    trie = build_trie(chained(turn_lists(table(spark, conversation(0, base) + conversation(1, base[:20])))))
    others = [r for d in range(34) for r in conversation(100 + d, base[:d] + ["off"])]
    got = prefix_trie.exits(chained(turn_lists(table(spark, others))), trie, 33, small).collect()
    assert {r.conv_id: r.shared for r in got} == {100 + d: d for d in range(34)}


def test_ids_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    rows = [(b"n%d" % (i % 2), i * 7 % 50) for i in range(50)]
    got = prefix_trie.joined_digests(spark.createDataFrame(rows, "node binary, conv_id long").repartition(5)).collect()
    for n in (b"n0", b"n1"):
        want = ",".join(str(i) for i in sorted(i for m, i in rows if m == n))
        assert {bytes(r.node): r.ends_sha256 for r in got}[n] == sha256(want.encode()).hexdigest()


def rebuilt(turns):
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = turns.get(c - c % 5, ())[:h] + own[h:]
    return out


@pytest.mark.parametrize("missing", [(), (0, 5, 10)])
def test_whole_table(spark, sf_dir, tmp_path, missing):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows.filter(~rows.conv_id.isin(*missing)).write.parquet(f"{tmp_path}/conversations.parquet")
    given = [tuple(r) for r in rows.collect() if r.conv_id not in missing]
    got = found(op13_prefix_trie(spark, str(tmp_path)))
    assert got == nodes(rebuilt(gathered(given)))
