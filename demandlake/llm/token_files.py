"""Operator 4: token-id files.

Documents are range-partitioned and sorted by id; each task tokenizes its run,
appends END_ID to every document and writes segments: rows of a Parquet table that
hold whole documents as independently coded, checksummed blocks (``id_coder``),
with the documents' ids and lengths beside them.  Any segment can be read alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandlake.llm import id_coder
from demandlake.llm.tokens import tokenizer

END_ID = 0
#: A segment is closed at this many ids; a longer document still is in one segment.
SEGMENT_IDS = 1 << 20
#: Ids that a task codes at once.
BATCH_IDS = id_coder.LANES * id_coder.BLOCK_IDS
#: Bytes of text that a task tokenizes at once; a longer text still is one.
TEXT_BYTES = 1 << 24
SEGMENTS = "part int, seq int, n_ids long, doc_ids array<long>, lengths array<long>, payload binary"
_DOCS = "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long"


def _blocks(ids: np.ndarray) -> list[np.ndarray]:
    return [ids[k : k + id_coder.BLOCK_IDS] for k in range(0, len(ids), id_coder.BLOCK_IDS)]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows (id, text) in slices of some TEXT_BYTES."""
    held, size = [], 0
    for b in batches:
        ends = np.concatenate([[0], np.cumsum(pc.binary_length(b.column(1)).to_numpy(), dtype=np.int64)])
        at = 0
        while at < b.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + TEXT_BYTES - size, side="right")) - 1)
            held.append(b.slice(at, to - at))
            size += int(ends[to] - ends[at])
            at = to
            if size >= TEXT_BYTES or at < b.num_rows:
                yield pa.concat_batches(held)
                held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def _segments(path: str):
    end = END_ID.to_bytes(4, "little")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        tok = tokenizer(path, keep_blanks=True)
        for b in _slices(batches):
            yield from zip(b.column(0).to_pylist(), tok.ids(b.column(1)))

    def coded(segments: list[tuple], part: int, seq: int) -> pa.RecordBatch:
        blocks = [_blocks(np.frombuffer(b"".join(raws), "<u4")) for _, raws in segments]
        codes = iter(id_coder.encode([x for own in blocks for x in own]))
        rows = [
            (part, seq + k, sum(map(len, raws)) // 4, docs, [len(r) // 4 for r in raws], b"".join(next(codes) for _ in own))
            for k, ((docs, raws), own) in enumerate(zip(segments, blocks))
        ]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["part", "seq", "n_ids", "doc_ids", "lengths", "payload"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        done: list[tuple] = []
        docs, raws, own, total = [], [], 0, 0
        for doc, ids in documents(batches):
            docs.append(doc)
            raws.append(ids + end)
            own += len(ids) // 4 + 1
            if own >= SEGMENT_IDS:
                done.append((docs, raws))
                total, docs, raws, own = total + own, [], [], 0
            if total >= BATCH_IDS:
                yield coded(done, part, seq)
                done, seq, total = [], seq + len(done), 0
        if docs:
            done.append((docs, raws))
        if done:
            yield coded(done, part, seq)

    return run


def write_token_files(docs: DataFrame, vocabulary: str, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the ids of all texts, in ascending ``id_col`` (nulls first; equal ids by text), to ``path``."""
    thin = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = thin.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered.mapInArrow(_segments(vocabulary), SEGMENTS).write.parquet(path)


def read_segment(payload: bytes) -> np.ndarray:
    """All ids of a segment."""
    return np.concatenate([np.zeros(0, np.int64), *id_coder.decode(id_coder.split(payload))])


def _documents():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]

        def read(segments: list[tuple]) -> pa.RecordBatch:
            codes = [id_coder.split(s[-1]) for s in segments]
            blocks = iter(id_coder.decode([c for own in codes for c in own]))
            rows = []
            for (part, seq, n_ids, doc_ids, lengths, _), own in zip(segments, codes):
                ids = np.concatenate([np.zeros(0, np.int64), *(next(blocks) for _ in own)]).astype("<u4")
                if len(ids) != n_ids or sum(lengths) != n_ids:
                    raise ValueError("a segment does not hold the ids that it names")
                at = 0
                for doc, n in zip(doc_ids, lengths):
                    rows.append((part, seq, doc, at, n, zlib.crc32(ids[at : at + n].tobytes())))
                    at += n
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"])

        held: list[tuple] = []
        for b in batches:
            for i in range(b.num_rows):
                held.append(tuple(c[i].as_py() for c in b.columns))
                if sum(s[2] for s in held) >= BATCH_IDS:
                    yield read(held)
                    held = []
        if held:
            yield read(held)

    return run


def read_token_files(segments: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the decoded blocks of a written table."""
    names = [c.split()[0] for c in SEGMENTS.split(", ")]
    found = segments.select(*names).mapInArrow(_documents(), _DOCS)
    sizes = segments.select("part", "seq", "n_ids")
    before = lambda w: F.coalesce(F.sum("n_ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    parts = parts.select("part", before(Window.orderBy("part")).alias("part_start"))  # a row for each written partition
    starts = sizes.select("part", "seq", before(Window.partitionBy("part").orderBy("seq")).alias("seg_start")).join(parts, "part")
    return found.join(starts, ["part", "seq"]).select("doc_id", (F.col("part_start") + F.col("seg_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, vocabulary: str, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes token-id files to ``path`` (a new folder that all executors share) and reads them back.

    ``start`` counts the ids of all documents before.  Null or empty text: only
    END_ID.  Null ids come first; repeated rows each have their place.  Empty
    table: no rows.  Other columns are ignored.
    """
    write_token_files(docs, vocabulary, path, id_col, text_col)
    return read_token_files(docs.sparkSession.read.schema(SEGMENTS).parquet(path))
