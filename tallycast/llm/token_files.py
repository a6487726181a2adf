"""Token ids in binary files: bit planes of fixed-size blocks, compressed with zstandard.

A file holds the ids of a run of documents. The ids are cut into blocks; bit k of all ids
of a block makes up plane k, and each plane that is not all zero is compressed on its own.
High planes of small ids are empty or nearly so, which is what the shuffle is for.

File: magic, compressed planes, chunk index, document index, footer. Chunk index, one row
per plane: first id of the block, ids in it, plane number, offset, length. Document index:
doc_id (and whether it is null) and number of ids per document, compressed. Footer: offsets
and lengths of both, number of ids, magic. All numbers are little-endian.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallycast.llm.common import per_worker, slices_of, table
from tallycast.session import cut_lineage, shared_folder

MAGIC = b"TBP1"
FOOTER = "<QQQQQ4s"  # chunk index at, its bytes, document index at, its bytes, ids, magic
CHUNK_ROW = np.dtype([("first", "<u8"), ("ids", "<u4"), ("plane", "<u4"), ("at", "<u8"), ("bytes", "<u8")])
BLOCK_IDS = 1 << 16
#: Id written after each document (fixed by the contract).
END_ID = 2
#: Bytes of text encoded in one go, and words kept encoded per Python worker.
_TEXT_BYTES, _CACHED_WORDS = 4_000_000, 900_000
#: Letters below U+0300, where composing changes nothing, but for U+0130, whose small form
#: ends with a mark.
_LETTERS = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u02af"
_FIRST_MARK = "\u0300"
#: Full stops and commas that end a word after a letter.
_STOPS = re.compile(f"[.,](?<=[{_LETTERS}][.,])[.,]*(?=[ \\n]|$)")
_ASCII_STOPS = re.compile(rb"[.,](?<=[A-Za-z][.,])[.,]*(?=[ \n]|$)")
#: Holds the place of a word that is not ASCII; no word in UTF-8 is this byte.
_APART = b"\x80"


#: What the entries of a tokenizer of words end with that end a word.
_WORD_END = "</w>"
#: A word of small letters alone, and how many of them are encoded as one line.
_WORD = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")
_LINE_WORDS = 500


def _is_latin(text: str) -> bool:
    """Whether all characters are below U+0100; a quick look at most texts that are not ASCII."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _bytes_of(planes_used: int) -> int:
    """Bytes per id that hold so many planes: 1, 2 or 4."""
    return 1 if planes_used <= 8 else 2 if planes_used <= 16 else 4


def planes(ids: np.ndarray) -> list[tuple[int, bytes]]:
    """The bit planes of a block that are not all zero, lowest first."""
    used = int(ids.max(initial=0)).bit_length()
    width = _bytes_of(used)
    raw = np.ascontiguousarray(ids, dtype=f"<u{width}").view(np.uint8).reshape(-1, width)
    bits = np.ascontiguousarray(np.unpackbits(raw, axis=1, bitorder="little").T[:used])
    packed = np.packbits(bits, axis=1, bitorder="little")
    return [(k, packed[k].tobytes()) for k in range(used) if packed[k].any()]


def from_planes(count: int, parts: list[tuple[int, bytes]]) -> np.ndarray:
    kind = np.dtype(f"<u{_bytes_of(max([k for k, _ in parts], default=0) + 1)}").type
    ids = np.zeros(count, kind)
    for k, raw in parts:
        ids |= np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little", count=count).astype(kind) << kind(k)
    return ids.astype("<u4")


class BitPlaneWriter:
    """Writes one file block by block; memory holds one block and the indexes."""

    def __init__(self, out, block_ids: int = BLOCK_IDS, level: int = 3):
        import zstandard

        self._out, self._block = out, block_ids
        self._pack = zstandard.ZstdCompressor(level=level).compress
        self._at = self._ids = self._flushed = 0
        self._waiting: list[np.ndarray] = []
        self._held = 0
        self._chunks: list[tuple] = []
        self._docs: list[tuple] = []
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self._out.write(data)
        self._at += len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self._docs.append((doc_id, len(ids)))
        self._ids += len(ids)
        self._waiting.append(ids)
        self._held += len(ids)
        if self._held >= self._block:
            joined = np.concatenate(self._waiting)
            whole = len(joined) // self._block * self._block
            for begin in range(0, whole, self._block):
                self._write(joined[begin : begin + self._block])
            self._waiting, self._held = [joined[whole:]], len(joined) - whole

    def _write(self, ids: np.ndarray) -> None:
        if not len(ids):
            return
        for plane, raw in planes(ids):
            packed = self._pack(raw)
            self._chunks.append((self._flushed, len(ids), plane, self._at, len(packed)))
            self._put(packed)
        if not ids.any():  # no plane at all: an index row keeps the count
            self._chunks.append((self._flushed, len(ids), 0, self._at, 0))
        self._flushed += len(ids)

    def close(self) -> int:
        self._write(np.concatenate(self._waiting) if self._waiting else np.zeros(0, np.uint32))
        chunks_at = self._at
        self._put(np.array(self._chunks, dtype=CHUNK_ROW).tobytes())
        docs_at = self._at
        known = np.array([d is not None for d, _ in self._docs], dtype="u1").tobytes()
        names = np.array([d or 0 for d, _ in self._docs], dtype="<i8").tobytes()
        counts = np.array([n for _, n in self._docs], dtype="<u8").tobytes()
        self._put(self._pack(known + names + counts))
        self._put(struct.pack(FOOTER, chunks_at, docs_at - chunks_at, docs_at, self._at - docs_at, self._ids, MAGIC))
        return self._ids


class BitPlaneReader:
    """Reads a file; :meth:`ids` fetches only the blocks that a range of ids touches."""

    def __init__(self, source, size: int):
        import zstandard

        self._source = source
        self._unpack = zstandard.ZstdDecompressor()
        tail = struct.calcsize(FOOTER)
        c_at, c_bytes, d_at, d_bytes, self.count, magic = struct.unpack(FOOTER, self._get(size - tail, tail))
        if magic != MAGIC:
            raise ValueError("not a bit-plane token file")
        self.chunks = np.frombuffer(self._get(c_at, c_bytes), dtype=CHUNK_ROW)
        raw = self._unpack.decompress(self._get(d_at, d_bytes)) if d_bytes else b""
        n = len(raw) // 17
        self.known = np.frombuffer(raw, "u1", n).astype(bool)
        self.doc_ids = np.frombuffer(raw, "<i8", n, n)
        self.counts = np.frombuffer(raw, "<u8", n, 9 * n).astype(np.int64)
        self._kept: tuple[int, np.ndarray] = (-1, np.zeros(0, np.uint32))

    def _get(self, at: int, size: int) -> bytes:
        self._source.seek(at)
        return self._source.read(size)

    def _block(self, first: int, rows: np.ndarray) -> np.ndarray:
        if self._kept[0] != first:
            parts = [
                (int(r["plane"]), self._unpack.decompress(self._get(int(r["at"]), int(r["bytes"]))))
                for r in rows
                if r["bytes"]
            ]
            self._kept = (first, from_planes(int(rows[0]["ids"]), parts))
        return self._kept[1]

    def ids(self, begin: int, end: int) -> np.ndarray:
        firsts = self.chunks["first"]
        out = []
        at = begin
        while at < end:
            first = firsts[np.searchsorted(firsts, at, side="right") - 1]
            rows = self.chunks[np.searchsorted(firsts, first) : np.searchsorted(firsts, first, side="right")]
            block = self._block(int(first), rows)
            stop = min(end, int(first) + len(block))
            out.append(block[at - int(first) : stop - int(first)])
            at = stop
        return np.concatenate(out) if out else np.zeros(0, np.uint32)


class WordEncoder:
    """Ids of texts from a tokenizer that drops white space, word by word.

    Splitting at ASCII white space changes nothing for such a tokenizer: no token holds
    white space, and its rules look at nothing beyond it. Arrow splits many texts and finds
    their different words; each is encoded once and kept under a number, by which the ids of
    all words are put together. A run of full stops and commas after a letter is a token run
    of its own, so it is set apart, which makes words repeat more often.
    """

    def __init__(self, path: str, cached_words: int = _CACHED_WORDS):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._most = cached_words
        self._last = np.zeros(self._tokenizer.get_vocab_size(), bool)
        self._last[[i for entry, i in self._tokenizer.get_vocab().items() if entry.endswith(_WORD_END)]] = True
        self._forget()

    def _forget(self) -> None:
        """No words are known."""
        self._cached: dict[bytes, int] = {}
        self._ids = np.zeros(1024, "<u4")  # of all words, one after the other
        self._ends = np.zeros(1025, np.int64)  # where those of each word end, after a zero

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self._cached) > self._most:
            self._forget()
        spaced = pa.array([self._spaced(text) for text in texts], pa.large_binary()).view(pa.large_string())
        split = pc.ascii_split_whitespace(spaced)
        held = split.flatten().dictionary_encode()
        words = held.dictionary.view(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        found = list(map(self._cached.get, words))
        if None in found:
            self._learn([word for word, number in zip(words, found) if number is None])
            found = list(map(self._cached.get, words))
        numbers = np.array(found, np.int64)[held.indices.to_numpy()]
        begins = self._ends[numbers]
        sizes = self._ends[numbers + 1] - begins
        upto = np.concatenate([[0], np.cumsum(sizes)])
        ids = self._ids[np.repeat(begins - upto[:-1], sizes) + np.arange(upto[-1])]
        edges = upto[np.cumsum([0, *split.value_lengths().to_pylist()])].tolist()
        return [ids[b:e] for b, e in zip(edges, edges[1:])]

    @staticmethod
    def _spaced(text: str) -> bytes:
        """Words in lower case, as the tokenizer has them, without stops, where that is safe.

        It is where no mark can be composed with a letter: the tokenizer composes letters
        before it lowers them, and some marks compose with a small letter only. In other
        texts the words of ASCII alone are lowered, the rest stay as they are.
        """
        special = "<|" in text  # special tokens keep their case
        if text.isascii() or _is_latin(text) or max(text) < _FIRST_MARK:
            lowered = text if special else text.lower()
            return _STOPS.sub(r" \g<0>", lowered).encode()
        words = text.encode("utf-8", "surrogatepass").split()
        others = iter([word for word in words if not word.isascii()])
        raw = b" ".join([word if word.isascii() else _APART for word in words])
        words = _ASCII_STOPS.sub(rb" \g<0>", raw if special else raw.lower()).split()
        return b" ".join([next(others) if word == _APART else word for word in words])

    def _learn(self, words: list[bytes]) -> None:
        """Encode words and keep them; those of letters alone many at a time.

        Such a word is one piece to the tokenizer and its last token alone ends a word, so
        the ids of a line of them can be cut again.
        """
        texts = b"\n".join(words).decode("utf-8", "replace").split("\n")
        plain, others = [], []
        for n, text in enumerate(texts):
            (plain if _WORD.fullmatch(text) else others).append(n)
        order, ids, sizes = [], [], []
        for at in range(0, len(plain), _LINE_WORDS):
            line = plain[at : at + _LINE_WORDS]
            coded = np.array(self._tokenizer.encode(" ".join([texts[n] for n in line]), add_special_tokens=False).ids, "<u4")
            cuts = np.flatnonzero(self._last[coded]) + 1
            if len(cuts) != len(line):
                others += line
                continue
            order += line
            ids.append(coded)
            sizes.append(np.diff(cuts, prepend=0))
        coded = [one.ids for one in self._tokenizer.encode_batch([texts[n] for n in others], add_special_tokens=False)]
        order += others
        ids.append(np.fromiter(chain.from_iterable(coded), "<u4"))
        sizes.append(np.array(list(map(len, coded)), np.int64))
        self._keep([words[n] for n in order], np.concatenate(ids), np.concatenate(sizes))

    def _keep(self, words: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        begin, end = len(self._cached), len(self._cached) + len(words)
        at = int(self._ends[begin])
        if end >= len(self._ends):
            self._ends = np.pad(self._ends, (0, 2 * end - len(self._ends)))
        if at + len(ids) > len(self._ids):
            self._ids = np.pad(self._ids, (0, 2 * (at + len(ids)) - len(self._ids)))
        self._ids[at : at + len(ids)] = ids
        self._ends[begin + 1 : end + 1] = at + np.cumsum(sizes)
        self._cached.update(zip(words, range(begin, end)))


def _open(folder: str):
    from pyarrow import fs

    if "://" in folder or folder.startswith("file:"):
        system, path = fs.FileSystem.from_uri(folder if "://" in folder else folder.replace("file:", "file://", 1))
    else:
        system, path = fs.LocalFileSystem(), folder
    return system, path


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Encode ``doc_id, text`` rows into files below ``folder``, ascending by doc_id.

    Returns ``(part, file, n_ids, n_docs)``, already evaluated and checkpointed; part order
    is id order. Documents are range-partitioned, so a file has a range of ids; rows with
    equal ids are ordered by text and stay rows of their own, null ids come first. Null and
    empty texts give the end id alone; an empty table gives no file; other columns play no
    part. A task writes under a name of its own and renames at the end, so one that is run
    again or twice leaves the same bytes under the same name.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    parted = ordered.select(F.spark_partition_id().cast("bigint").alias("part"), "doc_id", "text")
    system, path = _open(folder)
    system.create_dir(path, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = per_worker(f"words:{tokenizer_path}", lambda: WordEncoder(tokenizer_path))
        fs_here, base = _open(folder)
        part, writer, out, name = None, None, None, f"{base}/.{uuid.uuid4().hex}"
        docs_here = 0
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            texts, ids = batch.column(2), batch.column(1).to_pylist()
            for run in slices_of(ids, pc.binary_length(texts).to_pylist(), _TEXT_BYTES):
                if writer is None:
                    part = batch.column(0)[0].as_py()
                    out = fs_here.open_output_stream(name)
                    writer = BitPlaneWriter(out)
                coded = encoder.encode(texts[run.start : run.stop].to_pylist())
                for doc_id, one in zip(ids[run], coded):
                    writer.add(doc_id, np.concatenate([one, end]))
                docs_here += len(coded)
        if writer is not None:
            count = writer.close()
            out.close()
            final = f"{base}/part-{part:06d}.tbp"
            fs_here.move(name, final)
            yield pa.RecordBatch.from_pylist([{"part": part, "file": f"part-{part:06d}.tbp", "n_ids": count, "n_docs": docs_here}])

    return cut_lineage(parted.mapInArrow(write, "part bigint, file string, n_ids bigint, n_docs bigint"))


def map_token_files(files: DataFrame, folder: str, of: Callable, schema: str) -> DataFrame:
    """Apply ``of(reader, file row)``, which yields Arrow batches, to every file in parallel."""
    spread = files.repartition(files.sparkSession.sparkContext.defaultParallelism * 4, "file")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _open(folder)
        for batch in batches:
            for row in batch.to_pylist():
                path = f"{base}/{row['file']}"
                with system.open_input_file(path) as source:
                    yield from of(BitPlaneReader(source, source.size()), row)

    return spread.mapInArrow(read, schema)


def document_digests(files: DataFrame, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, read from the files.

    ``start`` counts the ids of all documents before it. What is summed in one task is a
    row per file.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("before", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def digest(reader: BitPlaneReader, row: dict) -> Iterator[pa.RecordBatch]:
        ends = np.cumsum(reader.counts)
        begins = ends - reader.counts
        for at in range(0, len(ends), 10_000):
            to = slice(at, at + 10_000)
            crc = [zlib.crc32(reader.ids(int(b), int(e)).tobytes()) for b, e in zip(begins[to], ends[to])]
            names = pa.array(reader.doc_ids[to], mask=~reader.known[to])
            yield pa.RecordBatch.from_arrays(
                [names, pa.array(begins[to] + row["before"]), pa.array(reader.counts[to]), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return map_token_files(placed, folder, digest, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = f"{shared_folder(spark)}/tallycast/token-files-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    files = write_token_files(docs, folder, public_tokenizers.path("word_bpe_49k.json"))
    return document_digests(files, folder)
