"""Token ids in binary files of independent zstandard frames with a trailing seek table.

Layout of a file, all integers little-endian:

    frame, frame, ...   zstandard frames of up to FRAME_TOKENS ids (unsigned 32-bit)
    document index      skippable frame: rows, then doc_id, null flag and start of each
                        document (in ids from the file's begin), then its CRC-32
    seek table          skippable frame of the seekable format: per frame compressed
                        size, size and the low 32 bits of its XXH64; the number of
                        frames, a flag byte and the magic number end the file

Any zstandard decoder reads the ids of the whole file; ``TokenFile`` reads the tail,
then only the frames that hold the documents asked for, and checks each frame's sum.

Writer: rows are range-partitioned by doc_id (null first) and sorted in their
partition, so files in the order of (part, number) hold all documents in ascending
order; long ids and repeated ids are spread by a hash of the text. A file ends at
FILE_TOKENS ids or FILE_DOCS documents, whose index is held as arrays. The manifest
(Parquet, one row a file) counts the ids of each file; prefix sums over it give
every file's place in the corpus. A task writes under a name of its own attempt and
renames when a file is complete.

Encoding is the tokenizers library's own model: a text is cut where its splitting
pattern always cuts, each distinct piece of a batch is split and merged once, and a
bounded cache keeps ids of pieces across batches. Texts where a blank is followed by
white space, and texts with special strings, go to the library whole.

Edge cases: very long texts are encoded whole; a null text is an empty one (its ids are the end id alone); repeated
rows are written each; an empty table gives no file; extra columns are not written.
"""

from __future__ import annotations

import functools
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import expand, new_path, slices, small_batches, stored, table
from .prefix_table import vocabulary_path

TOKENIZER, END = "byte_bpe_50k.json", 2
FRAME_TOKENS, FILE_TOKENS, FILE_DOCS, CACHE = 1 << 16, 1 << 27, 1 << 20, 300_000
SKIP_INDEX, SKIP_SEEK, SEEK_MAGIC = 0x184D2A5D, 0x184D2A5E, 0x8F92EAB1


class ByteBpe:
    """The ids of many texts at once, as Tokenizer.encode(add_special_tokens=False) gives them."""

    def __init__(self, path: str) -> None:
        import regex
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.split = regex.compile(PATTERN).findall
        # Byte-level letters: printable bytes stand for themselves, others follow from 256.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.letters = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
        self.young: dict[str, bytes] = {}  # two generations, so that frequent pieces stay
        self.old: dict[str, bytes] = {}

    def piece(self, piece: str) -> bytes:
        word = piece.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def chunk(self, chunk: str) -> bytes:
        found = self.young.get(chunk)
        if found is None:
            found = self.old.get(chunk)
            if found is None:
                body = chunk[1:] if chunk[:1] == " " else chunk
                found = self.piece(chunk) if body.isalpha() else b"".join(map(self.piece, self.split(chunk)))
            if len(self.young) >= CACHE:
                self.young, self.old = {}, self.young
            self.young[chunk] = found
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids and how many each text has; a null text has none."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        whole = pc.match_substring_regex(texts, r" ($|[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}])")
        for s in self.special:
            whole = pc.or_(whole, pc.match_substring(texts, s))
        lists = pc.split_pattern(pc.if_else(whole, "", texts), " ")
        counts = pc.list_value_length(lists).to_numpy().astype(np.int64)
        first = np.zeros(int(counts.sum()), bool)
        first[np.cumsum(counts) - counts] = True
        spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), lists.values, pa.scalar("", pa.large_string()))
        coded = pc.if_else(pa.array(first), lists.values, spaced).dictionary_encode()
        ids = [self.chunk(c) for c in coded.dictionary.to_pylist()]
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        offset = np.cumsum(size) - size
        flat = np.frombuffer(b"".join(ids), "<u4")
        index = coded.indices.to_numpy()
        out, per = flat[expand(offset[index], size[index])], np.add.reduceat(size[index], np.cumsum(counts) - counts) if len(counts) else counts
        at = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
        if not len(at):
            return out, per
        parts, last, ends = [], 0, np.cumsum(per)
        for i in at:
            own = np.array(self.tokenizer.encode(texts[int(i)].as_py(), add_special_tokens=False).ids, "<u4")
            parts += [out[last : ends[i]], own]
            last, per[i] = int(ends[i]), len(own)
        return np.concatenate([*parts, out[last:]]), per


@functools.lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


class _Writer:
    """One file: frames as ids come, index and seek table at the end."""

    def __init__(self, where: fs.FileSystem, path: str) -> None:
        import zstandard

        self.where, self.path, self.name = where, path, f"{uuid.uuid4().hex}.tok"
        self.out = where.open_output_stream(f"{path}/_{self.name}", compression=None)
        self.zstd = zstandard.ZstdCompressor(level=1, write_checksum=True)
        self.frames, self.docs, self.null, self.starts, self.held, self.n_docs, self.n_held, self.tokens = [], [], [], [], [], 0, 0, 0

    def add(self, docs: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.docs.append(pc.fill_null(docs.cast(pa.int64()), 0).to_numpy().astype("<i8"))
        self.null.append(pc.is_null(docs).to_numpy(zero_copy_only=False).astype("u1"))
        self.n_docs += len(docs)
        self.starts.append(self.tokens + np.cumsum(sizes) - sizes)
        self.held.append(ids)
        self.n_held, self.tokens = self.n_held + len(ids), self.tokens + len(ids)
        if self.n_held >= FRAME_TOKENS:
            self._frames(self.n_held // FRAME_TOKENS * FRAME_TOKENS)

    def _frames(self, upto: int) -> None:
        import xxhash

        ids = np.concatenate(self.held)
        for a in range(0, upto, FRAME_TOKENS):
            raw = ids[a : min(a + FRAME_TOKENS, upto)].astype("<u4").tobytes()
            packed = self.zstd.compress(raw)
            self.out.write(packed)
            self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.held, self.n_held = [ids[upto:]], len(ids) - upto

    def close(self) -> tuple[str, int, int]:
        if self.n_held:
            self._frames(self.n_held)
        n = self.n_docs
        index = struct.pack("<Q", n) + np.concatenate([*self.docs, np.empty(0, "<i8")]).tobytes() + np.concatenate([*self.null, np.empty(0, "u1")]).tobytes()
        index += np.concatenate([*self.starts, [self.tokens]]).astype("<u8").tobytes()
        self.out.write(struct.pack("<II", SKIP_INDEX, len(index) + 4) + index + struct.pack("<I", zlib.crc32(index)))
        seek = b"".join(struct.pack("<III", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0x80, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SKIP_SEEK, len(seek)) + seek)
        self.out.close()
        self.where.move(f"{self.path}/_{self.name}", f"{self.path}/{self.name}")
        return self.name, n, self.tokens


class TokenFile:
    """Random access to the documents of a file."""

    def __init__(self, uri: str) -> None:
        where, path = fs.FileSystem.from_uri(uri)
        self.uri, self.file = uri, where.open_input_file(path)
        end = self.file.size()
        n, flags, magic = struct.unpack("<IBI", self.file.read_at(9, end - 9)) if end >= 17 else (0, 0, 0)
        if magic != SEEK_MAGIC or flags != 0x80:
            raise ValueError(f"{uri}: no seek table")
        at = end - 9 - 12 * n - 8
        kind, size = struct.unpack("<II", self.file.read_at(8, at))
        if kind != SKIP_SEEK or size != 12 * n + 9:
            raise ValueError(f"{uri}: broken seek table")
        self.frames = np.frombuffer(self.file.read_at(12 * n, at + 8), "<u4").reshape(n, 3).astype(np.int64)
        self.frame_at = np.concatenate(([0], np.cumsum(self.frames[:, 0])))
        self.token_at = np.concatenate(([0], np.cumsum(self.frames[:, 1] // 4)))
        index = self.file.read_at(at - int(self.frame_at[-1]), int(self.frame_at[-1]))
        body = index[8:-4]
        if struct.unpack("<I", index[:4])[0] != SKIP_INDEX or zlib.crc32(body) != struct.unpack("<I", index[-4:])[0]:
            raise ValueError(f"{uri}: broken document index")
        n = struct.unpack("<Q", body[:8])[0]
        self.docs = pa.array(np.frombuffer(body, "<i8", n, 8), mask=np.frombuffer(body, "u1", n, 8 + 8 * n).astype(bool))
        self.starts = np.frombuffer(body[8 + 9 * n :], "<u8").astype(np.int64)
        self._frame: tuple[int, np.ndarray] = (-1, np.empty(0, "<u4"))

    def _read(self, k: int) -> np.ndarray:
        if self._frame[0] != k:
            import xxhash
            import zstandard

            raw = zstandard.ZstdDecompressor().decompress(self.file.read_at(int(self.frames[k, 0]), int(self.frame_at[k])), max_output_size=int(self.frames[k, 1]))
            if len(raw) != self.frames[k, 1] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.frames[k, 2]:
                raise ValueError(f"{self.uri}: the sum of frame {k} differs")
            self._frame = (k, np.frombuffer(raw, "<u4"))
        return self._frame[1]

    def document(self, row: int) -> np.ndarray:
        """The ids of the row-th document; decompresses only the frames that hold them."""
        a, b = int(self.starts[row]), int(self.starts[row + 1])
        k, parts = int(np.searchsorted(self.token_at, a, side="right")) - 1, []
        while a < b:
            stop = min(b, int(self.token_at[k + 1]))
            parts.append(self._read(k)[a - int(self.token_at[k]) : stop - int(self.token_at[k])])
            a, k = stop, k + 1
        return np.concatenate(parts) if parts else np.empty(0, "<u4")

    def find(self, doc_ids: set[int | None]) -> Iterator[tuple[int | None, np.ndarray]]:
        wanted = pc.is_in(self.docs, pa.array(list(doc_ids), pa.int64()))
        for row in np.flatnonzero(wanted.to_numpy(zero_copy_only=False)).tolist():
            yield self.docs[row].as_py(), self.document(row)


def write_files(docs: DataFrame, folder: str, path: str, file_tokens: int = FILE_TOKENS, file_docs: int = FILE_DOCS) -> DataFrame:
    """Encode doc_id, text and write them in ascending doc_id. Returns the manifest:
    file, part, number, documents, tokens, first (ids of all files before)."""
    small_batches(docs.sparkSession, 10_000)  # more pieces are equal in more text
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order, "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, out, done = TaskContext.get().partitionId(), None, []
        where, at = fs.FileSystem.from_uri(folder)
        where.create_dir(at, recursive=True)
        for batch in batches:
            for b in slices(batch, "text", 8 << 20):
                ids, sizes = byte_bpe(path).encode(b.column("text"))
                ended = np.insert(ids, np.cumsum(sizes), END)  # after each document
                out = out or _Writer(where, at)
                out.add(b.column("doc_id"), ended, sizes + 1)
                if out.tokens >= file_tokens or out.n_docs >= file_docs:
                    done.append(out.close())
                    out = None
        if out is not None:
            done.append(out.close())
        yield pa.RecordBatch.from_pylist([{"file": f"{folder}/{name}", "part": part, "number": k, "documents": n, "tokens": t} for k, (name, n, t) in enumerate(done)], pa.schema([("file", pa.string()), ("part", pa.int32()), ("number", pa.int32()), ("documents", pa.int64()), ("tokens", pa.int64())]))

    manifest = stored(rows.mapInArrow(write, "file string, part int, number int, documents long, tokens long"), "manifest")
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("first", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read_files(manifest: DataFrame, batch_rows: int = 2000) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri, first in zip(b.column("file").to_pylist(), b.column("first").to_pylist(), strict=True):
                f = TokenFile(uri)
                for a in range(0, len(f.docs), batch_rows):
                    at = range(a, min(a + batch_rows, len(f.docs)))
                    ids = [f.document(k) for k in at]
                    yield pa.RecordBatch.from_arrays(
                        [f.docs.slice(a, len(at)), pa.array(f.starts[a : at.stop] + first, pa.int64()), pa.array([len(x) for x in ids], pa.int64()), pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    n = max(1, manifest.count())
    return manifest.select("file", "first").repartition(n).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_files(table(spark, sf_dir, "documents"), new_path(spark, "tokens"), vocabulary_path(TOKENIZER))
    return read_files(manifest)
