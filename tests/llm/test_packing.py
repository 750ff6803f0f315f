import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from flightloom.llm.packing import Rounds, pack

from edge_rows import EDGE  # noqa: I001

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [0]


def check(rows, found, length):
    """Pieces tile the sequences and, put together, are the ids of every document."""
    sequences, docs = defaultdict(list), defaultdict(list)
    for r in found:
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
        sequences[r.sequence_id].append((r.offset, r.length))
        docs[r.doc_id].append((r.start, np.frombuffer(bytes(r.ids), "<u4").tolist(), r.doc_tokens))
    assert sorted(sequences) == list(range(len(sequences)))
    fill = {}
    for s, pieces in sequences.items():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at and n > 0
            at += n
        fill[s] = at
    assert all(n == length for s, n in fill.items() if s < len(fill) - 1) and fill[len(fill) - 1] <= length
    texts = defaultdict(list)
    for d, t, _ in rows:
        texts[d].append(ids_of(t))
    assert set(docs) == set(texts)
    for d, pieces in docs.items():
        if len(texts[d]) == 1:
            whole = [x for _, part, _ in sorted(pieces, key=lambda p: p[0]) for x in part]
            assert whole == texts[d][0] and {n for *_, n in pieces} == {len(whole)}
        else:  # an id with several rows: the same ids in all
            assert sorted(x for _, part, _ in pieces for x in part) == sorted(x for t in texts[d] for x in t)


@pytest.mark.parametrize("length,window", [(16, 64), (1024, 4096)])
def test_edge_rows(edge, length, window):
    found = pack(edge, PATH, length=length, window=window, with_ids=True).collect()
    check(EDGE, found, length)


def test_whole_table(documents):
    rows = [(r.doc_id, r.text, r.source) for r in documents.collect()]
    check(rows, pack(documents, PATH, with_ids=True).collect(), 1024)


def proportions(rows, found, window, length):
    source = {d: s for d, _, s in rows}
    served = defaultdict(lambda: defaultdict(int))
    for r in found:
        place = r.sequence_id * length + r.offset
        for i in range(r.length):
            served[(place + i) // window][source[r.doc_id]] += 1
    return served


def test_windows_hold_the_proportions(make_docs):
    rows = [(i, "some words here " * (i % 11 + 1), ["a", "b", "b", "c", None][i % 5]) for i in range(400)]
    found = pack(make_docs(rows), PATH, length=32, window=256, with_ids=True).collect()
    check(rows, found, 32)
    total = defaultdict(int)
    for d, t, s in rows:
        total[s] += len(ids_of(t))
    whole = sum(total.values())
    windows = proportions(rows, found, 256, 32)
    for w in list(windows)[:-1]:
        for s, n in total.items():
            assert abs(windows[w][s] - 256 * n / whole) <= 2 * len(total)


def test_given_targets(make_docs):
    """A source with a small target lasts longer; others fill in when queues run dry."""
    rows = [(i, "word " * 9, "ab"[i % 2]) for i in range(200)]
    found = pack(make_docs(rows), PATH, targets={"a": 3, "b": 1}, length=20, window=40, with_ids=True).collect()
    check(rows, found, 20)
    first = proportions(rows, found, 40, 20)[0]
    assert first["a"] == 30 and first["b"] == 10


def test_more_sources_than_queues(make_docs):
    rows = [(i, f"text number {i} " * (i % 4), f"s{i % 30}") for i in range(300)]
    check(rows, pack(make_docs(rows), PATH, length=16, window=64, queues=4, with_ids=True).collect(), 16)


def test_targets_of_sources_beyond_the_queues(make_docs):
    """The smallest source has a target and so a queue of its own."""
    rows = [(i, "word " * 9, f"big{i % 5}") for i in range(300)] + [(1000 + i, "word " * 9, "z") for i in range(40)]
    for queues in (1024, 3):
        options = {"targets": {"z": 3, "absent": 7}, "length": 20, "window": 80, "queues": queues}
        found = pack(make_docs(rows), PATH, with_ids=True, **options).collect()
        check(rows, found, 20)
        others = 5 if queues == 1024 else 3  # two of their own and the shared one
        assert abs(proportions(rows, found, 80, 20)[0]["z"] - 80 * 3 / (3 + others)) <= 1


def test_rounds_against_a_queue_simulation():
    """The closed form is deficit round-robin played turn by turn."""
    sizes, weights, window = [50, 7, 0, 123, 31], [5, 2, 1, 9, 4], 37
    rounds = Rounds(sizes, weights, window)
    stream, left, deficit = [], [0] * 5, [0] * 5
    while sum(left) < sum(sizes):
        for q in range(5):
            deficit[q] += window * weights[q]
            quantum, deficit[q] = divmod(deficit[q], sum(weights))
            take = min(quantum, sizes[q] - left[q])
            stream += [(q, left[q] + i) for i in range(take)]
            left[q] += take
    for q, size in enumerate(sizes):
        places = {}
        for at, place, n in rounds.spans(q, 0, size):
            places |= {at + i: place + i for i in range(n)}
        assert [stream[places[i]] for i in range(size)] == [(q, i) for i in range(size)]


def test_without_ids_and_empty(edge, nothing):
    assert "ids" not in pack(edge, PATH).columns
    assert pack(nothing, PATH).count() == 0
