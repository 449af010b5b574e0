import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from demandlake.llm import id_coder, packing, tokens
from demandlake.llm.packing import best_fit_runs, pack, token_pieces
from demandlake.llm.scratch import fresh_path
from demandlake.llm.token_files import read_segment, token_files

BYTE, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = ["", " ", "a  b", " lead", "trail ", "x\n y", "a \n\n b", "it's don't  we'll", "tab\tand\x0bvt", " nbsp em x", "é ́x  ñ", "Σίσυφος ΣΑΣ.", "日本 語 テキスト", "🙂 🙃🙂", "%%% ***", "0 12 345,678", "\x1c \x85 ​", "!", "! !"]


@pytest.mark.parametrize("path, blanks", [(BYTE, True), (WORDS, False)])
def test_chunks_give_the_ids_of_the_whole_text(path, blanks, monkeypatch, rows):
    monkeypatch.setattr(tokens, "JOINED", 7)
    monkeypatch.setattr(tokens, "KEPT", 400)
    rng = random.Random(8)
    texts = ODD + [r[1] or "" for r in rows if r[0] != 500] + ["".join(rng.choice("ab .,'!\n\tés") for _ in range(200)) for _ in range(100)]
    own, whole = tokens.ChunkTokenizer(path, blanks), Tokenizer.from_file(path)
    for at in range(0, len(texts), 16):
        for t, ids in zip(texts[at : at + 16], own.ids(texts[at : at + 16])):
            assert np.frombuffer(ids, "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids, repr(t)


def test_coder_round_trip_and_damage(monkeypatch):
    monkeypatch.setattr(id_coder, "LANES", 8)
    rng = np.random.default_rng(3)
    blocks = [rng.integers(0, 50_257, n) for n in (0, 1, 2, 300, 4096)] + [np.array([5] * 700), np.array([7, 8, 9] * 300), np.full(9, 65_535), np.zeros(5, int)]
    blocks += [rng.choice([1, 300, 50_000], size=rng.integers(1, 900)) for _ in range(20)]
    codes = id_coder.encode(blocks)
    assert id_coder.split(b"".join(codes)) == codes
    assert all(np.array_equal(a, b) for a, b in zip(blocks, id_coder.decode(codes)))
    assert len(codes[5]) < 100 and len(codes[6]) < 150  # repeats cost little
    assert id_coder.decode(codes[3:4])[0].tolist() == blocks[3].tolist()  # blocks don't depend on each other
    bad = bytearray(codes[4])
    bad[40] ^= 1
    with pytest.raises(ValueError):
        id_coder.decode([bytes(bad)])
    with pytest.raises(ValueError):
        id_coder.decode([codes[4][:-4]])


def test_token_files_read_back(spark, docs, rows, no_docs):
    path = fresh_path(spark, "test-ids")
    got = sorted(((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in token_files(docs, BYTE, path).collect()))
    whole = Tokenizer.from_file(BYTE)
    want = Counter()
    for d, t, *_ in rows:
        ids = whole.encode(t or "", add_special_tokens=False).ids + [0]
        want[d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter(g[1:] for g in got) == want
    at = 0
    for start, _, n, _ in got:
        assert start == at
        at += n
    ids = [g[1] for g in got]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
    segment = spark.read.parquet(path).first()
    assert len(read_segment(bytes(segment["payload"]))) == segment["n_ids"]
    assert token_files(no_docs, BYTE, fresh_path(spark, "test-ids")).count() == 0


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= n]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


def test_runs_pack_like_best_fit_decreasing():
    rng = random.Random(6)
    for _ in range(60):
        capacity = rng.choice([10, 50, 128])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 400))]
        plan = best_fit_runs(dict(Counter(lengths)), capacity)
        used = defaultdict(int)
        placed = defaultdict(int)
        counts = Counter(lengths)
        ranks = defaultdict(list)
        for length, rank, each, first, offset in plan:
            ranks[length].append((rank, each, first, offset))
        for length, runs in ranks.items():
            ends = [r[0] for r in runs[1:]] + [counts[length]]
            for (rank, each, first, offset), end in zip(runs, ends):
                for k in range(end - rank):
                    seq = first + k // each
                    assert used[seq] == offset + (k % each) * length
                    used[seq] += length
                    placed[length] += 1
        assert placed == counts and all(u <= capacity for u in used.values())
        assert len(used) == best_fit_decreasing(lengths, capacity)


def test_packed_pieces(spark, docs, rows, no_docs, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 4)
    got = pack(token_pieces(docs, WORDS, 512), 512, ["doc_id", "piece", "ids_crc32"]).collect()
    whole, want = Tokenizer.from_file(WORDS), Counter()
    for d, t, *_ in rows:
        ids = whole.encode(t or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 512):
            want[d, k // 512, k, len(ids[k : k + 512]), zlib.crc32(np.array(ids[k : k + 512], "<u4").tobytes())] += 1
    assert Counter(tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 512
    assert len(sequences) == best_fit_decreasing([r["length"] for r in got], 512)
    assert pack(token_pieces(no_docs, WORDS, 512), 512, ["doc_id", "piece", "ids_crc32"]).count() == 0


def test_ids_beyond_the_coder_are_refused():
    from demandlake.llm import id_coder

    with pytest.raises(ValueError, match="65,536"):
        id_coder.encode([np.array([1, 2], dtype=np.uint32), np.array([65_536], dtype=np.uint32)])
    assert len(id_coder.encode([np.array([65_535], dtype=np.uint32), np.array([], dtype=np.uint32)])) == 2
