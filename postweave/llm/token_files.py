"""Token ids of documents in patched frame-of-reference files, in ascending doc_id order.

A file is: MAGIC, the blocks (``pfor``), an Arrow table of block heads and starts, an Arrow table of
documents (doc_id, first id within the file, number of ids), and the tables' places.
Documents are dealt to files by ranges of doc_id and sorted within, so the files in order are one
stream of ids. Files are written under new names by each attempt of a task; the manifest, which Spark commits,
names those of the attempts that counted, so a lost executor or a second attempt leaves at most a file
that nothing refers to.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postweave.llm import pfor
from postweave.llm.batches import SPACES, file_uri, hash_spans, slabs, text_bytes
from postweave.plans.storage import new_path, stored

MAGIC = b"PFORIDS1"
TAIL = struct.Struct("<QQQ8s")
END_ID = 2
# Ids held before blocks are packed and written; a multiple of the block length.
FLUSH = pfor.BLOCK * 2048
# Pieces that are encoded in one text.
RUN = 256
# Pieces of text whose ids a Python worker remembers.
MEMORY = 3_000_000


# Second base of the hash of a piece: two pieces are taken as equal if both hashes are.
CHECK = 0xC2B2AE3D27D4EB4F

# White space of more than one byte in UTF-8.
WIDE_SPACES = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


class PieceEncoder:
    """Ids of whole texts by the tokenizers library, which sees each distinct piece of text once.

    A byte-level tokenizer starts a new token at a space that follows something else and precedes no
    white space. So the ids of a text are those of its pieces, cut before its spaces; texts with
    white space after a space are encoded whole. Pieces are looked up by two 64-bit hashes.
    """

    def __init__(self, path: str, end: int = END_ID, memory: int = MEMORY, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        names = sorted(self.tokenizer.get_vocab().items(), key=lambda item: item[1])
        self.token_bytes = np.array([len(name) for name, _ in names], np.int64)
        self.end, self.memory = end, memory
        self._forget()

    def _forget(self) -> None:
        """Piece 0 is the end of a document; keys are sorted, and ``number`` has the piece of each."""
        self.keys, self.checks, self.number = (np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64))
        self.ids, self.size, self.pieces = np.full(1 << 16, self.end, np.uint32), 1, 1
        self.begins = np.zeros(1 << 16, np.int64)
        self.begins[1] = 1

    def _learn(self, pieces: list[bytes], keys: np.ndarray, checks: np.ndarray) -> None:
        """Encode pieces and append their ids, which lie one after another by piece number.

        Pieces that begin with a space are encoded as runs of text. A byte-level token has as many bytes
        as its name has letters, so the lengths of the pieces tell which ids are whose.
        """
        spaced = np.array([p[:1] == b" " for p in pieces])
        order = np.argsort(spaced, kind="stable")
        pieces, heads = [pieces[k] for k in order], int((~spaced).sum())
        texts = pieces[:heads] + [b"".join(pieces[k : k + RUN]) for k in range(heads, len(pieces), RUN)]
        encoded = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        flat = np.concatenate([np.array(e.ids, np.uint32) for e in encoded])
        ends = np.searchsorted(np.cumsum(self.token_bytes[flat]), np.cumsum([len(p) for p in pieces]), "left") + 1
        while len(self.begins) < self.pieces + len(pieces) + 1:
            self.begins = np.concatenate([self.begins, np.zeros_like(self.begins)])
        while len(self.ids) < self.size + len(flat):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.size : self.size + len(flat)] = flat
        self.begins[self.pieces + 1 : self.pieces + 1 + len(pieces)] = self.size + ends
        numbers = np.empty(len(pieces), np.int64)
        numbers[order] = self.pieces + np.arange(len(pieces))
        at = np.searchsorted(self.keys, keys)
        self.keys, self.checks = np.insert(self.keys, at, keys), np.insert(self.checks, at, checks)
        self.number = np.insert(self.number, at, numbers)
        self.size += len(flat)
        self.pieces += len(pieces)

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        return at, (self.keys[at] == keys) if len(self.keys) else np.zeros(len(keys), bool)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a text column, the end id after each text, and the number of ids of each with it."""
        if self.pieces > self.memory:
            self._forget()
        data, bounds = text_bytes(column)
        rows = len(bounds) - 1
        spaces = np.flatnonzero(data == 0x20)
        whole = np.zeros(rows, bool)
        whole[np.searchsorted(bounds, spaces[_before_space(data, spaces)], "right") - 1] = True
        begins = np.zeros(len(data) + 1, bool)
        begins[spaces], begins[bounds[:-1]], begins[-1] = True, True, False
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(data)).astype(np.int64)
        owner = np.searchsorted(bounds, starts, "right") - 1
        cut = ~whole[owner]
        starts, ends, owner = starts[cut], ends[cut], owner[cut]
        keys, first, inverse = np.unique(hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        all_checks = hash_spans(data, starts, ends, CHECK)
        checks = all_checks[first]
        fresh = np.flatnonzero(~self._find(keys)[1])
        if len(fresh):
            pieces = [data[a:b].tobytes() for a, b in zip(starts[first[fresh]].tolist(), ends[first[fresh]].tolist())]
            self._learn(pieces, keys[fresh], checks[fresh])
        at = self._find(keys)[0][inverse]
        whole[owner[self.checks[at] != all_checks]] = True
        pieces_before = np.searchsorted(owner, np.arange(rows + 1))
        number = np.insert(self.number[at], pieces_before[1:], 0)
        begin, stop = self.begins[number], self.begins[number + 1]
        upto = np.concatenate([[0], np.cumsum(stop - begin)])
        ids = self.ids[np.arange(int(upto[-1])) + np.repeat(begin - upto[:-1], stop - begin)]
        cuts = upto[pieces_before + np.arange(rows + 1)]
        if not whole.any():
            return ids, np.diff(cuts)
        parts = [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
        for k in np.flatnonzero(whole).tolist():
            own = self.tokenizer.encode(data[bounds[k] : bounds[k + 1]].tobytes().decode(), add_special_tokens=False).ids
            parts[k] = np.array([*own, self.end], np.uint32)
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)


def _before_space(data: np.ndarray, spaces: np.ndarray) -> np.ndarray:
    """Of the places of spaces, those that white space follows (or may: the next text counts, too)."""
    after = [np.concatenate([data, np.zeros(4, np.uint8)])[spaces + k] for k in (1, 2, 3)]
    found = SPACES[after[0]] | ((after[0] >= 0x1C) & (after[0] <= 0x1F))
    for wide in WIDE_SPACES:
        if (after[0] == wide[0]).any():
            found |= np.logical_and.reduce([part == byte for part, byte in zip(after, wide)])
    return found


_encoders: dict[tuple[str, int, bool], PieceEncoder] = {}


def _encoder(path: str, end: int, special_as_text: bool = False) -> PieceEncoder:
    """One encoder for each Python worker, which Spark uses again for later tasks."""
    if (path, end, special_as_text) not in _encoders:
        _encoders[path, end, special_as_text] = PieceEncoder(path, end, special_as_text=special_as_text)
    return _encoders[path, end, special_as_text]


class FileWriter:
    """Writes one file block by block; the heads and document rows stay in memory until ``close``."""

    def __init__(self, path: str, doc_type: pa.DataType):
        self.filesystem, self.path = fs.FileSystem.from_uri(path)
        self.out = self.filesystem.open_output_stream(self.path)
        self.out.write(MAGIC)
        self.doc_type, self.tokens = doc_type, 0
        self.pending, self.held = [], 0
        self.heads, self.docs, self.counts = [], [], []

    def add(self, doc_ids: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        self.docs.append(doc_ids)
        self.counts.append(counts)
        self.pending.append(ids)
        self.held += len(ids)
        self.tokens += len(ids)
        if self.held >= FLUSH:
            ids = np.concatenate(self.pending)
            full = len(ids) // pfor.BLOCK * pfor.BLOCK
            self._write(ids[:full])
            self.pending, self.held = [ids[full:]], len(ids) - full

    def _write(self, ids: np.ndarray) -> None:
        for at in range(0, len(ids), FLUSH):
            heads, body = pfor.pack(ids[at : at + FLUSH])
            self.heads.append(heads)
            self.out.write(body.tobytes())

    def close(self) -> tuple[int, int]:
        """Write the rest and the tables; the numbers of documents and of ids."""
        if self.pending:
            self._write(np.concatenate(self.pending))
        heads = np.concatenate([np.zeros(0, pfor.HEAD), *self.heads])
        starts = np.cumsum(heads["size"], dtype=np.int64) - heads["size"] + len(MAGIC)
        blocks = pa.table({"start": starts, **{name: np.ascontiguousarray(heads[name]) for name in pfor.HEAD.names}})
        counts = np.concatenate([np.zeros(0, np.int64), *self.counts])
        docs = pa.table(
            {
                "doc_id": pa.chunked_array(self.docs, self.doc_type).combine_chunks(),
                "first": np.cumsum(counts) - counts,
                "count": counts,
            }
        )
        at = self.out.tell()
        places = [at]
        for table in (blocks, docs):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as writer:
                writer.write_table(table)
            data = sink.getvalue()
            self.out.write(data)
            at += data.size
            places.append(at)
        self.out.write(TAIL.pack(*places, MAGIC))
        self.out.close()
        return len(counts), self.tokens


class FileReader:
    """Random access to one file: its documents, and the ids in any range."""

    def __init__(self, path: str):
        filesystem, inner = fs.FileSystem.from_uri(path)
        self.file = filesystem.open_input_file(inner)
        size = self.file.size()
        tail = self.file.read_at(TAIL.size, size - TAIL.size)
        at, middle, end, magic = TAIL.unpack(tail)
        if magic != MAGIC:
            raise ValueError(f"{path} is no token file")
        tables = [pa.ipc.open_stream(self.file.read_at(b - a, a)).read_all() for a, b in ((at, middle), (middle, end))]
        self.docs = tables[1]
        self.heads = np.zeros(tables[0].num_rows, pfor.HEAD)
        for name in pfor.HEAD.names:
            self.heads[name] = tables[0].column(name).to_numpy()
        self.starts = tables[0].column("start").to_numpy()

    def ids(self, first: int, count: int) -> np.ndarray:
        """Only the blocks that hold the range are read."""
        if not count:
            return np.zeros(0, np.uint32)
        a, b = first // pfor.BLOCK, -(-(first + count) // pfor.BLOCK)
        size = int(self.heads["size"][a:b].sum(dtype=np.int64))
        body = np.frombuffer(self.file.read_at(size, int(self.starts[a])), np.uint8)
        return pfor.unpack(self.heads[a:b], body)[first - a * pfor.BLOCK :][:count]


def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    folder: str | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    special_as_text: bool = False,
) -> DataFrame:
    """Encode every whole text and write the ids; the manifest (file, part, documents, ids).

    A special token's name in a text is that token, as the tokenizer has it by default, or ordinary text on demand.

    Null and empty texts hold the end id only. Null ids come first; rows with equal ids are
    dealt by text too, so that one id with very many rows is spread. No rows: no files.
    """
    folder = file_uri(docs.sparkSession, folder or new_path(docs.sparkSession, "tokens"))
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("spread"))
    ordered = narrow.repartitionByRange("doc_id", "spread").sortWithinPartitions("doc_id", "spread")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        writer, path = None, None
        part = TaskContext.get().partitionId()
        encoder = _encoder(tokenizer, end_id, special_as_text)
        for batch in slabs(batches):
            if writer is None:
                path = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.pfor"
                parent, inner = fs.FileSystem.from_uri(folder)
                parent.create_dir(inner, recursive=True)
                writer = FileWriter(path, batch.schema.field("doc_id").type)
            ids, counts = encoder.encode(batch.column("text"))
            writer.add(batch.column("doc_id"), ids, counts)
        if writer:
            documents, tokens = writer.close()
            yield pa.RecordBatch.from_pydict({"file": [path], "part": [part], "documents": [documents], "ids": [tokens]})

    manifest = ordered.select("doc_id", "text").mapInArrow(write, "file string, part long, documents long, ids long")
    return stored(manifest, "token-manifest")


def read_token_files(manifest: DataFrame, doc_type: T.DataType) -> DataFrame:
    """Per document, from the files: doc_id, start (ids before it in all files), n_tokens, ids_crc32.

    The starts of files are summed on the driver, one number for each file; each file is read by a
    task of its own.
    """
    spark = manifest.sparkSession
    files = sorted(manifest.select("part", "file", "ids").collect())
    starts = np.cumsum([0, *(f.ids for f in files)]).tolist()
    rows = [(f.file, start) for f, start in zip(files, starts)]
    schema = T.StructType([T.StructField("doc_id", doc_type), *T._parse_datatype_string("start long, n_tokens long, ids_crc32 long")])
    listed = spark.createDataFrame(rows, "file string, base long")
    listed = listed.repartitionByRange(max(1, len(rows)), "file") if len(rows) > 1 else listed

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield from _documents(FileReader(path), base)

    return listed.mapInArrow(read, schema)


def _documents(file: FileReader, base: int) -> Iterator[pa.RecordBatch]:
    firsts, counts = file.docs.column("first").to_numpy(), file.docs.column("count").to_numpy()
    ends = firsts + counts
    at = 0
    while at < len(firsts):
        stop = max(at + 1, int(np.searchsorted(ends, firsts[at] + FLUSH, "right")))
        ids = file.ids(int(firsts[at]), int(ends[stop - 1] - firsts[at])).astype("<u4")
        cuts = (firsts[at:stop] - firsts[at]).tolist() + [len(ids)]
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": file.docs.column("doc_id").slice(at, stop - at).combine_chunks(),
                "start": pa.array(firsts[at:stop] + base),
                "n_tokens": pa.array(counts[at:stop]),
                "ids_crc32": pa.array([zlib.crc32(ids[a:b].data) for a, b in zip(cuts, cuts[1:])], pa.int64()),
            }
        )
        at = stop


def tokenized(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID) -> DataFrame:
    """Write the files and read every document back from them."""
    manifest = write_token_files(docs, tokenizer, doc_id=doc_id, text=text, end_id=end_id)
    return read_token_files(manifest, docs.schema[doc_id].dataType)
