"""Token ids of texts from the public tokenizer files, for use inside tasks.

Words repeat, also rare ones, so each worker keeps what it has tokenized.  A text
is cut into chunks, at places where the tokenizer itself always starts a new
pre-token; only a chunk that wasn't met before is tokenized.  The ids equal those
of the whole text.

Byte-level vocabularies: chunks are cut, told apart and looked up by Arrow, and
their ids put together by numpy.  Others: chunks are kept in a dict; a new chunk is
cut into its pre-tokens, and only a new pre-token is tokenized.
"""

from __future__ import annotations

import gc
import os
import re
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Entries of one generation of a worker's store of chunks and pre-tokens (two make some 170 MB).
#: A full generation becomes the old one; what is met again moves to the new one.
KEPT = 500_000
#: Pre-tokens tokenized as one text.
JOINED = 5_000
#: Byte-level chunks kept (some 40 bytes each) and their bytes, and chunks tokenized as one text.
CHUNKS_KEPT, CHUNK_BYTES, CHUNKS_JOINED = 1_500_000, 1 << 26, 500
#: Longer chunks (texts without blanks) are the first to be forgotten.
LONG = 32

# --- fixed values: the pre-token pattern of the vocabularies ------------------
#: Letters whose classes, composition and lower case are beyond doubt.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: A line: letters, then punctuation; or anything else, which leaves both groups empty.
WORDS = re.compile(rf"^(?:([{LETTERS}]+)([!-&(-/:-@\[-`{{-~]*)|.*)$", re.M)
#: White space as Python's ``\s``, for Arrow's patterns.
SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
#: A text where a blank has white space or an end beside it; there only ``SINGLE`` blanks start a chunk.
ODD = f"[{SPACE}] |^ | $| [{SPACE}]"
SINGLE = re.compile(r"(?<=\S) (?=\S)")
#: A chunk (its first blank left out) that isn't tokenized together with others.
ALONE = f" |^$|^[{SPACE}]|[{SPACE}]$"


class ChunkTokenizer:
    """``ids(texts)``: for each text, its ids as little-endian unsigned 32-bit integers.

    ``keep_blanks`` False: the vocabulary drops white space and case, and ends
    words with a mark; chunks are what lies between blanks and line breaks.  True
    (byte-level): a chunk starts at each single blank between two other
    characters, and keeps it.
    """

    def __init__(self, path: str, keep_blanks: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.keep_blanks = keep_blanks
        self.known: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}
        vocab = self.tokenizer.get_vocab()
        # Which ids begin (byte-level: with a blank) or end (word mark) a pre-token.
        self.edge = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.edge[[i for t, i in vocab.items() if (t.startswith("Ġ") if keep_blanks else t.endswith("</w>"))]] = True
        # Byte-level: the chunks met, without their first blank, their ids one after the other
        # and where these begin; in how many slices each was met.
        self.chunks = pa.array([], pa.string())
        self.flat, self.begins, self.met = np.zeros(0, "<u4"), np.zeros(1, np.int64), np.zeros(0, np.int32)

    def _cut(self, chunks: list[str]) -> list[list[str]]:
        """Pre-tokens of each plain chunk; of another none."""
        return [([word.lower(), rest] if rest else [word.lower()]) if word else [] for word, rest in WORDS.findall("\n".join(chunks))]

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_pieces(self, new: list[str]) -> None:
        """Words are tokenized many at a time and told apart by their edges; the rest one by one."""
        joins = [p for p in new if p.isalpha()]
        for at in range(0, len(joins), JOINED):
            some = joins[at : at + JOINED]
            (ids,) = self._encode([" ".join(some)])
            cuts = [0, *(np.flatnonzero(self.edge[ids]) + 1).tolist()]
            if len(cuts) != len(some) + 1:  # not as the vocabulary promises: one by one then
                self._one_by_one(some)
                continue
            raw = ids.tobytes()
            for p, x, y in zip(some, cuts, cuts[1:]):
                self.known[p] = raw[4 * x : 4 * y]
        done = set(joins)
        self._one_by_one([p for p in new if p not in done])

    def _one_by_one(self, pieces: list[str]) -> None:
        for p, ids in zip(pieces, self._encode(pieces)):
            self.known[p] = ids.tobytes()

    def _recall(self, wanted: set[str]) -> list[str]:
        """What of ``wanted`` neither generation knows; the old one's entries move to the new."""
        old = self.old
        self.known.update((c, old[c]) for c in wanted if c in old)
        return [c for c in wanted if c not in old]

    def _learn(self, new: list[str]) -> None:
        """A pre-token is a chunk as well, of the same ids, so both share one store."""
        cut = self._cut(new)
        self._one_by_one([c for c, ps in zip(new, cut) if not ps])
        self._learn_pieces(self._recall(set(chain.from_iterable(cut)).difference(self.known)))
        get = self.known.__getitem__
        self.known.update((c, get(ps[0]) if len(ps) == 1 else b"".join(map(get, ps))) for c, ps in zip(new, cut) if ps)

    def ids(self, texts: list[str] | pa.Array) -> list[bytes]:
        """The ids of each text; the garbage collector waits, as nothing here is cyclic."""
        gc.disable()
        try:
            if self.keep_blanks:
                return self._ids_with_blanks(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
            return self._ids(texts)
        finally:
            gc.enable()

    def _ids(self, texts: list[str]) -> list[bytes]:
        split = [t.replace("\n", " ").split(" ") if t else [] for t in texts]
        flat = list(chain.from_iterable(split))
        if len(self.known) > KEPT:
            self.known, self.old = {"": b""}, self.known
        found = list(map(self.known.get, flat))
        missing = [i for i, x in enumerate(found) if x is None]
        if missing:
            self._learn(self._recall({flat[i] for i in missing}))
            for i in missing:
                found[i] = self.known[flat[i]]
        ends = list(accumulate(map(len, split), initial=0))
        return [b"".join(found[a:b]) for a, b in zip(ends, ends[1:])]

    def _ids_with_blanks(self, texts: pa.Array) -> list[bytes]:
        if not len(texts):
            return []
        odd = pc.match_substring_regex(texts, ODD).to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
        if odd.any():
            cut = [SINGLE.split(t) for t in texts.filter(pa.array(odd)).to_pylist()]
            lists = pa.concat_arrays([lists, pa.array(cut, lists.type)])
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
        words = lists.flatten()
        # A text's first chunk has no blank; these are not kept, their ids lie behind the store's.
        first = np.zeros(len(words), dtype=bool)
        first[ends[:-1]] = True
        firsts = words.filter(pa.array(first)).dictionary_encode()
        own = self._encode(firsts.dictionary.to_pylist())
        rest = words.filter(pa.array(~first)).dictionary_encode()
        number = np.empty(len(words), dtype=np.int64)
        number[~first] = self._numbers(rest.dictionary)[rest.indices.to_numpy()]
        number[first] = len(self.met) + firsts.indices.to_numpy().astype(np.int64)
        flat = np.concatenate([self.flat, *own])
        sizes = np.concatenate([np.diff(self.begins), [len(x) for x in own]])
        begins = np.cumsum(sizes) - sizes
        size = sizes[number]
        stops = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(begins[number] - stops[:-1], size)
        at += np.arange(len(at))
        raw, cuts = flat[at].tobytes(), (4 * stops[ends]).tolist()
        found = [raw[a:b] for a, b in zip(cuts, cuts[1:])]
        if len(self.met) > CHUNKS_KEPT or self.chunks.nbytes > CHUNK_BYTES:
            self._forget()
        if not odd.any():
            return found
        order = np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)])
        return [found[i] for i in np.argsort(order)]

    def _numbers(self, chunks: pa.Array) -> np.ndarray:
        """The number of each of these (different) chunks in the store, where new ones are added."""
        number = pc.fill_null(pc.index_in(chunks, value_set=self.chunks), -1).to_numpy().astype(np.int64)
        missing = np.flatnonzero(number < 0)
        if len(missing):
            new = chunks.take(pa.array(missing))
            alone = pc.match_substring_regex(new, ALONE).to_numpy(zero_copy_only=False)
            missing = np.concatenate([missing[~alone], missing[alone]])
            number[missing] = len(self.met) + np.arange(len(missing))
            joined, single = (new.filter(pa.array(x)) for x in (~alone, alone))
            ids, sizes = self._chunk_ids(joined.to_pylist(), single.to_pylist())
            self.chunks = pa.concat_arrays([self.chunks, joined, single])
            self.flat = np.concatenate([self.flat, *ids])
            self.begins = np.concatenate([self.begins, self.begins[-1] + np.cumsum(sizes, dtype=np.int64)])
            self.met = np.concatenate([self.met, np.zeros(len(missing), np.int32)])
        self.met[number] += 1
        return number

    def _chunk_ids(self, joined: list[str], single: list[str]) -> tuple[list[np.ndarray], list[int]]:
        """Ids of new chunks and how many each has: many at a time, told apart by their blanks; ``single`` one by one."""
        out, sizes = [], []
        for at in range(0, len(joined), CHUNKS_JOINED):
            some = joined[at : at + CHUNKS_JOINED]
            found = self._encode([" " + " ".join(some)])
            cuts = np.flatnonzero(self.edge[found[0]])
            if len(cuts) == len(some) and cuts[0] == 0:
                sizes += np.diff(cuts, append=len(found[0])).tolist()
            else:  # not as the vocabulary promises: one by one then
                found = self._encode([" " + c for c in some])
                sizes += map(len, found)
            out += found
        found = self._encode([" " + c for c in single])
        return out + found, sizes + [len(x) for x in found]

    def _forget(self) -> None:
        """Of the chunks met more than once and not LONG, those met most stay: half a store at most."""
        short = pc.binary_length(self.chunks).to_numpy() <= LONG
        keep = np.argsort(-self.met, kind="stable")
        keep = keep[short[keep] & (self.met[keep] > 1)][: CHUNKS_KEPT // 2]
        sizes = np.diff(self.begins)[keep]
        begins = np.concatenate([[0], np.cumsum(sizes)])
        self.flat = self.flat[np.repeat(self.begins[keep] - begins[:-1], sizes) + np.arange(begins[-1])]
        self.chunks, self.begins, self.met = self.chunks.take(pa.array(keep)), begins, self.met[keep] // 2


_OPEN: dict[tuple[str, bool], ChunkTokenizer] = {}


def tokenizer(path: str, keep_blanks: bool) -> ChunkTokenizer:
    """One tokenizer for each worker process, vocabulary and mode."""
    key = (path, keep_blanks)
    if key not in _OPEN:
        _OPEN[key] = ChunkTokenizer(path, keep_blanks)
    return _OPEN[key]
