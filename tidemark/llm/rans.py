"""Token ids in files, coded by a static range asymmetric numeral system.

One table of frequencies, of all ids of the corpus and shared by all files, codes them. A file holds consecutive documents
in ascending doc_id order, null first, in independent blocks of whole documents. A block's ids are dealt in rows over
LANES interleaved states. Every SEGMENT_ROWS rows the block keeps a checkpoint (the states and the place in its words), from
which decoding can start without what stands before; each segment's words and each block's ids have a checksum.

A folder can be read with nothing else at hand. It holds

* ``frequencies``: TABLE_MAGIC, the number of ids and the checksum of what follows, each id's share of 2**SCALE_BITS (all
  unsigned 32-bit integers);
* ``part-N.rans``, N ascending with doc_id: MAGIC, the checksum of the table, the blocks, a footer (JSON: for each block its
  offset, length, documents and ids), the footer's length;
* ``blocks``: a table of all blocks (path, offset, length, documents, n_ids, and start, the number of ids before it). It is written last
  and names the files that count, so a write that was broken off leaves no folder that can be read by it.

Block: header of 8 unsigned 32-bit integers (documents, ids, lanes, rows a segment, segments, words, checksum of the ids,
checksum of the doc_ids and counts), doc_ids, their null flags, counts, for each segment its first word and checksum and
its LANES states, the words. A file is written under another name and then renamed to that of its partition, whose rows
are the same in every attempt: a lost executor leaves no half file, and a second attempt replaces the first one's.

Nulls: a null text has no ids but the end id. Repeated doc_ids (and nulls) follow one another, by a hash of their ids. An empty table
gives no file of blocks and no rows. A very long document makes a block of its own. Other columns are ignored.
"""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import library, texts_of, vocabulary
from tidemark.llm.common import as_bytes, cut, drop_cut, table, with_key
from tidemark.session import work_folder

MAGIC, TABLE_MAGIC = b"TMRANS02", b"TMFREQ01"
SCALE_BITS = 20
LOWEST = np.uint64(1 << 31)
LANES = 2048
SEGMENT_ROWS = 128
BLOCK_IDS = 3 * LANES * SEGMENT_ROWS
BLOCKS_A_TASK = 12
END_ID = 2


class Frequencies:
    """Shares of ids in 2**SCALE_BITS, each id at least one, and what coding looks up."""

    def __init__(self, counts: np.ndarray):
        total = 1 << SCALE_BITS
        share = 1 + np.floor(counts / max(1, counts.sum()) * (total - len(counts))).astype(np.int64)
        share[np.argmax(share)] += total - share.sum()
        self.share = share.astype(np.uint64)
        self.first = np.concatenate([[0], np.cumsum(share)[:-1]]).astype(np.uint64)
        self._symbols: np.ndarray | None = None

    @property
    def symbols(self) -> np.ndarray:
        """The id of each slot."""
        if self._symbols is None:
            self._symbols = np.repeat(np.arange(len(self.share), dtype=np.uint16), self.share.astype(np.int64))
        return self._symbols

    @classmethod
    def of_shares(cls, share: np.ndarray) -> Frequencies:
        made = cls.__new__(cls)
        made.__setstate__({"share": share.astype(np.uint64)})
        return made

    @property
    def checksum(self) -> int:
        return crc32(self.share.astype("<u4").tobytes())

    def to_bytes(self) -> bytes:
        return TABLE_MAGIC + struct.pack("<II", len(self.share), self.checksum) + self.share.astype("<u4").tobytes()

    @classmethod
    def from_bytes(cls, payload: bytes) -> Frequencies:
        n, checksum = struct.unpack_from("<II", payload, len(TABLE_MAGIC))
        made = cls.of_shares(np.frombuffer(payload, "<u4", n, len(TABLE_MAGIC) + 8))
        if not payload.startswith(TABLE_MAGIC) or made.checksum != checksum or made.share.sum() != 1 << SCALE_BITS:
            raise ValueError("the table of frequencies is damaged")
        return made

    def __setstate__(self, state):
        self.share = state["share"]
        self.first = (np.cumsum(self.share) - self.share).astype(np.uint64)
        self._symbols = None

    def __getstate__(self):
        return {"share": self.share}


def encode_block(doc_ids: list[int | None], documents: list[np.ndarray], table_: Frequencies) -> bytes:
    ids = np.concatenate(documents).astype(np.uint32)
    rows = -(-len(ids) // LANES)
    share, first = table_.share[ids], table_.first[ids]
    states = np.full(LANES, LOWEST)
    emitted: list[np.ndarray] = []
    checkpoints: list[tuple[int, np.ndarray]] = []
    full = np.uint64(63 - SCALE_BITS)
    words = 0
    for row in range(rows - 1, -1, -1):
        f, c = share[row * LANES : (row + 1) * LANES], first[row * LANES : (row + 1) * LANES]
        x = states[: len(f)]
        over = x >= f << full
        if over.any():
            emitted.append(out := (x[over] & np.uint64(0xFFFFFFFF)).astype("<u4"))
            words += len(out)
            x = np.where(over, x >> np.uint64(32), x)
        quotient, rest = np.divmod(x, f)
        states[: len(f)] = (quotient << np.uint64(SCALE_BITS)) + rest + c
        if row % SEGMENT_ROWS == 0:
            checkpoints.append((words, states.copy()))
    stream = np.concatenate(emitted[::-1]) if emitted else np.zeros(0, "<u4")
    checkpoints.reverse()
    begins = [words - left for left, _ in checkpoints]
    counts = np.array([len(d) for d in documents], "<u4")
    keys = np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes() + bytes(d is None for d in doc_ids) + counts.tobytes()
    segments = b""
    for k, (begin, (_, state)) in enumerate(zip(begins, checkpoints, strict=True)):
        end = begins[k + 1] if k + 1 < len(begins) else words
        segments += struct.pack("<II", begin, crc32(stream[begin:end].tobytes())) + state.astype("<u8").tobytes()
    head = struct.pack("<8I", len(documents), len(ids), LANES, SEGMENT_ROWS, len(begins), words, crc32(ids.astype("<u4").tobytes()), crc32(keys))
    return head + keys + segments + stream.tobytes()


class Block:
    def __init__(self, payload: bytes, table_: Frequencies):
        self.table = table_
        n, self.n_ids, self.lanes, self.rows, n_segments, words, self.checksum, key_sum = struct.unpack_from("<8I", payload)
        at = 32
        if crc32(payload[at : at + 13 * n]) != key_sum:
            raise ValueError("the block's documents are damaged")
        missing = payload[at + 8 * n : at + 9 * n]
        self.doc_ids = [None if gone else d for d, gone in zip(np.frombuffer(payload, "<i8", n, at).tolist(), missing, strict=True)]
        self.counts = np.frombuffer(payload, "<u4", n, at + 9 * n).astype(np.int64)
        at += 13 * n
        self.segments = []
        for _ in range(n_segments):
            self.segments.append((*struct.unpack_from("<II", payload, at), np.frombuffer(payload, "<u8", self.lanes, at + 8)))
            at += 8 + 8 * self.lanes
        self.words = np.frombuffer(payload, "<u4", words, at)

    def segment(self, k: int) -> np.ndarray:
        """Ids of segment k, from its checkpoint alone."""
        at, checksum, state = self.segments[k]
        end = self.segments[k + 1][0] if k + 1 < len(self.segments) else len(self.words)
        if crc32(self.words[at:end].tobytes()) != checksum:
            raise ValueError(f"segment {k} is damaged")
        n = min(self.rows * self.lanes, self.n_ids - k * self.rows * self.lanes)
        out, x = np.empty(n, np.uint32), state.astype(np.uint64)
        symbols, share, first, low = self.table.symbols, self.table.share, self.table.first, np.uint64((1 << SCALE_BITS) - 1)
        for begin in range(0, n, self.lanes):
            width = min(self.lanes, n - begin)
            y = x[:width]
            slot = y & low
            ids = symbols[slot]
            y = share[ids] * (y >> np.uint64(SCALE_BITS)) + slot - first[ids]
            under = np.flatnonzero(y < LOWEST)
            if len(under):
                y[under] = y[under] << np.uint64(32) | self.words[at : at + len(under)]
                at += len(under)
            x[:width] = y
            out[begin : begin + width] = ids
        return out

    def ids(self) -> np.ndarray:
        out = np.concatenate([self.segment(k) for k in range(len(self.segments))]) if self.segments else np.zeros(0, np.uint32)
        if crc32(out.astype("<u4").tobytes()) != self.checksum:
            raise ValueError("the block's ids do not match their checksum")
        return out


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _read(fs, at: str, path: str, offset: int = 0, length: int | None = None) -> bytes:
    with fs.open_input_file(f"{at}/{path}") as file:
        return file.read_at(file.size() - offset if length is None else length, offset)


def _put(fs, hidden: str, path: str) -> None:
    """Renames, in place of what an earlier attempt left; some stores do not rename onto a file."""
    try:
        fs.move(hidden, path)
    except OSError:
        fs.delete_file(path)
        fs.move(hidden, path)


@lru_cache(2)
def frequencies_of(folder: str) -> Frequencies:
    """The table that codes a folder's files."""
    return Frequencies.from_bytes(_read(*_filesystem(folder), "frequencies"))


def read_file(folder: str, path: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """doc_id and ids of each document of one file, by its footer."""
    payload, shared = _read(*_filesystem(folder), path), frequencies_of(folder)
    check_file(payload, shared)
    size = struct.unpack("<I", payload[-4:])[0]
    for entry in json.loads(payload[-4 - size : -4]):
        block = Block(payload[entry["offset"] : entry["offset"] + entry["length"]], shared)
        yield from zip(block.doc_ids, np.split(block.ids(), np.cumsum(block.counts)[:-1]), strict=True)


def check_file(head: bytes, shared: Frequencies) -> None:
    if head[: len(MAGIC) + 4] != MAGIC + struct.pack("<I", shared.checksum):
        raise ValueError("the file does not go with the table of frequencies")


def vocabulary_size(path: str) -> int:
    """Ids of a vocabulary file of the tokenizers library, from 0 to the largest."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    return 1 + max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])


def encode_ids(docs: DataFrame, path: str, end_id: int | None = END_ID) -> DataFrame:
    """doc_id, ids (unsigned 16-bit integers, so the vocabulary has 65,536 ids at most)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = library(path)
        end = b"" if end_id is None else np.array([end_id], "<u2").tobytes()
        for batch in batches:
            for part, texts in texts_of(batch):
                yield pd.DataFrame({"doc_id": part["doc_id"], "ids": [x + end for x in bpe.encode(texts)]})

    return with_key(docs.withColumn("text", as_bytes())).mapInPandas(run, "doc_id string, ids binary").withColumn("doc_id", F.col("doc_id").cast("long"))


def frequencies(ids: DataFrame, size: int) -> Frequencies:
    """Of all ids of the table: each task counts its own, Spark adds up; what reaches the driver has the vocabulary's size."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            counts += np.bincount(np.frombuffer(b"".join(batch["ids"]), "<u2"), minlength=size)
        seen = np.flatnonzero(counts)
        yield pd.DataFrame({"id": seen, "n": counts[seen]})

    rows = ids.select("ids").mapInPandas(count, "id long, n long").groupBy("id").sum("n").collect()
    counts = np.zeros(size, np.int64)
    for i, n in rows:
        counts[i] = n
    return Frequencies(counts)


def write_files(ids: DataFrame, folder: str, table_: Frequencies) -> None:
    """Writes the folder: table of frequencies, files, table of blocks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, at = _filesystem(folder)
        part = TaskContext.get().partitionId()
        name, hidden = f"part-{part:06d}.rans", f"{at}/.part-{part:06d}-{uuid.uuid4().hex}"
        file, blocks = None, []
        held: list[tuple[int | None, np.ndarray]] = []
        n_held = offset = 0

        def flush():
            nonlocal file, offset, n_held
            if file is None:
                file = fs.open_output_stream(hidden)
                head = MAGIC + struct.pack("<I", table_.checksum)
                file.write(head)
                offset = len(head)
            payload = encode_block([d for d, _ in held], [x for _, x in held], table_)
            file.write(payload)
            blocks.append({"offset": offset, "length": len(payload), "documents": len(held), "n_ids": n_held})
            offset += len(payload)
            held.clear()
            n_held = 0

        for batch in batches:
            for doc_id, packed in zip(batch["doc_id"], batch["ids"], strict=True):
                x = np.frombuffer(packed, "<u2")
                held.append((None if doc_id is None else int(doc_id), x))
                n_held += len(x)
                if n_held >= BLOCK_IDS:
                    flush()
        if held:
            flush()
        if file is not None:
            footer = json.dumps(blocks).encode()
            file.write(footer + struct.pack("<I", len(footer)))
            file.close()
            _put(fs, hidden, f"{at}/{name}")
            yield pd.DataFrame(blocks).assign(part=part, path=name)

    fs, at = _filesystem(folder)
    fs.create_dir(at, recursive=True)
    with fs.open_output_stream(f"{at}/frequencies") as file:
        file.write(table_.to_bytes())
    # rows that share a doc_id, or have none, are many partitions' if need be
    ordered = ids.withColumn("tie", F.xxhash64("ids")).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "ids")
    schema = "part long, path string, offset long, length long, documents long, n_ids long"
    blocks = cut(ordered.select(F.col("doc_id").cast("string").alias("doc_id"), "ids").mapInPandas(run, schema), "op10-blocks")
    # ids before each file, a row for each; then before each block of its own
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("own"))
    parts = parts.select("part", (F.sum("own").over(Window.orderBy("part")) - F.col("own")).alias("before"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("offset")) - F.col("n_ids")
    listed = blocks.join(parts, "part").select("path", "offset", "length", "documents", "n_ids", (F.col("before") + inside).alias("start"))
    listed.write.mode("overwrite").parquet(f"{folder}/blocks")
    drop_cut(blocks)


def read_files(spark: SparkSession, folder: str, digest: bool = True) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (or ids) of every document of a folder; blocks are decoded apart from one another."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        (fs, at), shared = _filesystem(folder), frequencies_of(folder)
        for batch in batches:
            for row in batch.itertuples():
                check_file(_read(fs, at, row.path, 0, len(MAGIC) + 4), shared)
                block = Block(_read(fs, at, row.path, row.offset, row.length), shared)
                ids, ends = block.ids().astype("<u4"), np.cumsum(block.counts)
                parts = [ids[e - n : e].tobytes() for e, n in zip(ends.tolist(), block.counts.tolist(), strict=True)]
                out = pd.DataFrame({"doc_id": pd.array(block.doc_ids, "Int64"), "start": row.start + ends - block.counts, "n_tokens": block.counts})
                yield out.assign(ids_crc32=[crc32(p) for p in parts]) if digest else out.assign(ids=parts)

    listed = spark.read.schema("path string, offset long, length long, start long").parquet(f"{folder}/blocks")
    schema = "doc_id long, start long, n_tokens long, " + ("ids_crc32 long" if digest else "ids binary")
    return listed.repartition(-(-listed.count() // BLOCKS_A_TASK) or 1).mapInPandas(run, schema)


def op10_rans_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written to files and read back."""
    path = vocabulary("word_bpe_49k.json")
    ids = cut(encode_ids(table(spark, sf_dir, "documents"), path), "op10-ids")
    folder = f"{work_folder(spark)}/op10-{uuid.uuid4().hex}"
    write_files(ids, folder, frequencies(ids, vocabulary_size(path)))
    drop_cut(ids)
    return read_files(spark, folder)
