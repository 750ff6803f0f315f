import random
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from flightloom.llm import encoding, token_codes
from flightloom.llm.encoding import ChunkEncoder
from flightloom.llm.token_codes import Codes, encode_codes, token_round_trip, write_token_files
from flightloom.session import fresh_path

from edge_rows import EDGE  # noqa: I001

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
ENCODERS = {"word": ChunkEncoder(WORD, False), "byte": ChunkEncoder(BYTE, True)}

PARTS = [
    " ", "  ", "\n", " \n", "\t", "a", "The", "don't", "'s", "!!", "...", "é", "Ä", "42", "日本", "́",
    "ﬁ", "<|endoftext|>", "<|startoftext|>", "_", "\x1c", "\xa0", "x" * 100, "Σας", "ǅ", "|", ",", "\U0001f600",
]


@pytest.mark.parametrize("name", ENCODERS)
@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS) | st.text(max_size=4), max_size=12).map("".join), max_size=6))
def test_ids_are_those_of_the_whole_text(name, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    e = ENCODERS[name]
    plain = [x.ids for x in e.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(b, "<u4").tolist() for b in e.encode(texts)] == plain


@pytest.mark.parametrize("name", ENCODERS)
def test_ids_of_documents(name, documents, monkeypatch):
    """Also when the remembered chunks are given up again and again."""
    monkeypatch.setattr(encoding, "KNOWN_CHUNKS", 500)
    monkeypatch.setattr(encoding, "KEPT_CHUNKS", 100)
    texts = [r.text or "" for r in documents.limit(300).collect()]
    e = ENCODERS[name]
    plain = [x.ids for x in e.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(b, "<u4").tolist() for b in e.encode(texts)] == plain


def test_a_spelling_is_encoded_once_whatever_its_case(monkeypatch):
    """Words of letters go to the library in one string without marks between them."""
    e = ChunkEncoder(WORD, False)
    given, ids = [], e._ids
    monkeypatch.setattr(e, "_ids", lambda texts: given.extend(texts) or ids(texts))
    text = "Zyxo zyxo qwop, ZYXO Qwop"
    assert np.frombuffer(e.encode([text])[0], "<u4").tolist() == ids([text])[0]
    assert [sorted(t.split(" ")) for t in given if t] == [["qwop", "zyxo"]]


def test_words_after_a_space_are_encoded_without_marks(monkeypatch):
    """Words go to the library in one string, told apart by the ids that begin with a space."""
    e = ChunkEncoder(BYTE, True)
    given, ids = [], e._ids
    monkeypatch.setattr(e, "_ids", lambda texts: given.extend(texts) or ids(texts))
    text = "zyxo Zyxo 4qwop!! qwop, zy_xo ﬁqé"
    assert np.frombuffer(e.encode([text])[0], "<u4").tolist() == ids([text])[0]
    assert [sorted(t.split(" ")) for t in given if " " in t] == [["", "4qwop!!", "Zyxo", "qwop", "zy_xo", "ﬁqé"]]


MEMORY = """
import random, resource, sys
from flightloom.llm.encoding import ChunkEncoder
rng = random.Random(3)
most = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024
text = lambda: " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8)) for _ in range(220))
e = ChunkEncoder(sys.argv[1], sys.argv[2] == "byte")
for _ in range(1000):
    e.encode([text()])
before = most()
e.known.clear()
e.encode([text() for _ in range(1000)])
print(most() - before)
"""


@pytest.mark.parametrize("name", ENCODERS)
def test_memory_does_not_follow_the_number_of_texts_at_once(name):
    """A thousand texts given together take hardly more memory than one after the other, though all words are new."""
    path = {"word": WORD, "byte": BYTE}[name]
    root = Path(encoding.__file__).parents[2]
    done = subprocess.run([sys.executable, "-c", MEMORY, path, name], cwd=root, capture_output=True, text=True, check=True)
    assert int(done.stdout) < 60  # MB


@pytest.mark.parametrize("name", ENCODERS)
def test_words_encoded_in_parts(name, documents, monkeypatch):
    monkeypatch.setattr(encoding, "WORDS_AT_ONCE", 7)
    monkeypatch.setattr(encoding, "CHARACTERS_AT_ONCE", 5_000)
    texts = [r.text or "" for r in documents.limit(100).collect()]
    e = ChunkEncoder({"word": WORD, "byte": BYTE}[name], name == "byte")
    given, ids = [], e._ids
    monkeypatch.setattr(e, "_ids", lambda texts: given.extend(texts) or ids(texts))
    plain = [x.ids for x in e.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(b, "<u4").tolist() for b in e.encode(texts)] == plain
    assert max(len(t.split(" ")) for t in given if t not in texts) <= 3 * 7


@pytest.mark.parametrize("name", ENCODERS)
def test_words_of_every_character(name):
    """In front, inside and at the end of a word, white space of all kinds included."""
    chars = [c for c in map(chr, [*range(0x3100), *range(0xFE00, 0x10000)]) if not 0xD800 <= ord(c) < 0xE000]
    texts = [" ".join(f"{c}a a{c} a{c}b {c} {c}{c}" for c in chars[i : i + 40]) for i in range(0, len(chars), 40)]
    e = ENCODERS[name]
    plain = [x.ids for x in e.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(b, "<u4").tolist() for b in e.encode(texts)] == plain


@pytest.mark.parametrize("name", ENCODERS)
def test_words_of_all_letters(name):
    rng = random.Random(5)
    letters = [c for c in map(chr, range(0x260)) if c.isalpha()]
    texts = [" ".join(letters), " ".join(c + "a" + c for c in letters)]
    texts += [" ".join("".join(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(300)) for _ in range(20)]
    e = ENCODERS[name]
    plain = [x.ids for x in e.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(b, "<u4").tolist() for b in e.encode(texts)] == plain


@pytest.mark.parametrize("n", [0, 1, 8, 511, 512, 513, 4_000])
@pytest.mark.parametrize("high", [1, 256, 60_000, 2**32])
def test_round_trip_and_random_access(n, high):
    ids = np.random.default_rng(n).integers(0, high, n, dtype=np.uint64).astype(np.uint32)
    data = encode_codes(ids)
    codes = Codes.open(data)
    assert len(codes) == n and (codes.all() == ids).all()
    for i in range(0, n, max(1, n // 200)):
        assert codes[i] == ids[i]


def test_container_layout():
    data = encode_codes(np.array([1, 300, 70_000]))
    assert data[:4] == b"DAC1" and int.from_bytes(data[4:8], "little") == 3
    with pytest.raises(ValueError):
        Codes.open(b"none" + data[4:])


def expected(rows):
    tokenizer = ENCODERS["word"].tokenizer
    ids = [(d, tokenizer.encode(t or "", add_special_tokens=False).ids + [1]) for d, t in rows]
    out, start = [], 0
    for d, x in sorted(ids, key=lambda r: (r[0] is not None, r[0] or 0)):
        out.append((d, start, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
        start += len(x)
    return out


@pytest.mark.parametrize("size", [1, 5_000, 10**9])
def test_files_of_documents(documents, monkeypatch, size):
    monkeypatch.setattr(token_codes, "CONTAINER_IDS", size)
    docs = documents.limit(200)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    random.Random(1).shuffle(rows)
    assert sorted(map(tuple, token_round_trip(docs, WORD).collect())) == sorted(expected(rows))


def test_edge_rows(edge):
    found = sorted(map(tuple, token_round_trip(edge, WORD).collect()), key=lambda r: r[1])
    want = expected([(d, t) for d, t, _ in EDGE])
    assert [r[0] for r in found] == [r[0] for r in want]
    key = lambda r: (repr(r[0]), r[2], r[3])  # noqa: E731  rows of one id may come in either order
    assert sorted(map(key, found)) == sorted(map(key, want))
    ends = 0
    for _, start, n, _ in found:
        assert start == ends
        ends += n


def test_containers_give_any_token(spark, documents):
    path = fresh_path(spark, "codes")
    docs = documents.limit(50)
    write_token_files(docs, path, WORD)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for row in spark.read.parquet(path).collect():
        codes, at = Codes.open(bytes(row.codes)), 0
        for doc_id, n in zip(row.doc_ids, row.lengths):
            ids = ENCODERS["word"].tokenizer.encode(texts[doc_id], add_special_tokens=False).ids + [1]
            assert n == len(ids) and codes[at] == ids[0] and codes[at + n - 1] == 1
            at += n


def test_empty_table(nothing):
    assert token_round_trip(nothing, WORD).count() == 0
