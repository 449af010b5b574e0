import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from demandlake.llm import token_files, tokens

BYTE = public_tokenizers.path("byte_bpe_50k.json")
BLANKS = [" ", "  ", "\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", " ", "​", "　"]


def texts(rng, n):
    parts = ["ab", "b", "c,", "it's", "É", "日", "<|endoftext|>", "12", "'s", ""]
    return ["".join(rng.choice(parts) + rng.choice(BLANKS if rng.random() < 0.2 else [" "]) for _ in range(rng.randint(0, 9))) for _ in range(n)]


def test_arrow_slices_give_the_ids_of_the_whole_text(monkeypatch):
    monkeypatch.setattr(tokens, "CHUNKS_JOINED", 3)
    monkeypatch.setattr(tokens, "CHUNKS_KEPT", 20)
    own, whole, rng = tokens.ChunkTokenizer(BYTE, True), Tokenizer.from_file(BYTE), random.Random(4)
    for _ in range(60):
        some = texts(rng, 20)
        for t, ids in zip(some, own.ids(pa.array(some, pa.string())), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids, repr(t)
    assert own.ids(pa.array([], pa.string())) == []


def test_chunks_met_before_are_not_tokenized_again(monkeypatch):
    own = tokens.ChunkTokenizer(BYTE, True)
    asked = []
    monkeypatch.setattr(own, "_encode", lambda some, encode=own._encode: asked.extend(some) or encode(some))
    first = own.ids(pa.array(["one two, three", "one three"]))
    assert len(asked) == 2  # "one" at the start of a text, and the others together
    asked.clear()
    assert own.ids(pa.array(["one three", "one two, three"])) == first[::-1] and asked == ["one"]


def test_long_chunks_are_not_kept(monkeypatch):
    monkeypatch.setattr(tokens, "CHUNK_BYTES", 2_000)
    own, whole = tokens.ChunkTokenizer(BYTE, True), Tokenizer.from_file(BYTE)
    for k in range(5):
        some = ["本" * 500 + str(k), f"a {'b' * 900}{k} the", f"c {'b' * 900}{k} the"]
        for _ in range(2):
            got = [np.frombuffer(x, "<u4").tolist() for x in own.ids(pa.array(some))]
            assert got == [e.ids for e in whole.encode_batch(some, add_special_tokens=False)]
    assert own.chunks.nbytes < 3_000 and max(map(len, own.chunks.to_pylist())) < 1_000


def test_slices_keep_rows_and_order(monkeypatch):
    monkeypatch.setattr(token_files, "TEXT_BYTES", 10)
    rows = [(i, "x" * n) for i, n in enumerate([0, 3, 7, 1, 40, 2, 2, 9, 0, 0, 12, 5])]
    batch = lambda some: pa.RecordBatch.from_arrays([pa.array([r[0] for r in some]), pa.array([r[1] for r in some], pa.string())], names=["doc_id", "text"])
    got = list(token_files._slices(iter([batch(rows[:5]), batch(rows[5:5]), batch(rows[5:])])))
    assert [r for b in got for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist())] == rows
    assert all(sum(map(len, b.column(1).to_pylist())) <= 10 or b.num_rows <= 3 for b in got) and len(got) > 5
