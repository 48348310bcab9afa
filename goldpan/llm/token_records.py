"""Token-id output as length-delimited binary records.

A record is: payload length (uint64), masked CRC-32C of those eight bytes (uint32), payload, masked CRC-32C of the payload
(uint32), all little-endian. The payload is a flag byte (1 if doc_id is null), the doc_id (int64) and the ids, two or four
bytes each. Beside each shard ``part-N.bin`` stands ``part-N.idx`` with one (offset uint64, ids uint64) pair a record, for
shuffled reads.
"""

from __future__ import annotations

import os
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from goldpan.scratch import lookup, new_path, written

from .common import text_bytes
from .rolling import U, keyed, laid_out, pieces, slices, tidy
from .shared_prints import contains

#: Distinct pieces that a worker remembers, at about 70 bytes each; beyond that it keeps the half that it met most.
CACHE_PIECES = 400_000
_BLOCK = 64


def _apply(tables: np.ndarray, x: np.ndarray) -> np.ndarray:
    return tables[0][x & 255] ^ tables[1][(x >> 8) & 255] ^ tables[2][(x >> 16) & 255] ^ tables[3][x >> 24]


def _crc_tables() -> tuple[np.ndarray, list[np.ndarray]]:
    """The table of CRC-32C, and for each j the map that appends 2**j zero bytes."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0x82F63B78), table >> 1).astype(np.uint32)
    bytes_ = np.arange(256, dtype=np.uint32)
    singles = np.stack([bytes_ << np.uint32(8 * k) for k in range(4)])
    shift = [table[singles & 255] ^ (singles >> np.uint32(8))]
    for _ in range(40):
        shift.append(_apply(shift[-1], shift[-1]))
    return table, shift


_TABLE, _SHIFT = _crc_tables()


def _append_zeros(crc: np.ndarray, count: np.ndarray) -> np.ndarray:
    crc, j = crc.copy(), 0
    while (count >> j).any():
        on = (count >> j & 1).astype(bool)
        crc[on] = _apply(_SHIFT[j], crc[on])
        j += 1
    return crc


def masked_crc32c(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Masked CRC-32C of data[start:end] for each pair; all blocks of 64 bytes are worked on side by side."""
    size = end - start
    blocks = np.maximum(1, -(-size // _BLOCK))
    first = np.concatenate(([0], np.cumsum(blocks)))
    padded = np.zeros(first[-1] * _BLOCK, np.uint8)  # zeros in front of a record don't count while the register is 0
    into = np.repeat(first[1:] * _BLOCK - size, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    padded[into] = data[np.repeat(start, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)]
    columns = np.ascontiguousarray(padded.reshape(-1, _BLOCK).T)
    crc = np.zeros(first[-1], np.uint32)
    for column in columns:
        crc = _TABLE[(crc ^ column) & 255] ^ (crc >> np.uint32(8))
    behind = np.repeat(first[1:], blocks) - 1 - np.arange(first[-1])
    crc = _append_zeros(crc, behind * _BLOCK)
    crc = np.bitwise_xor.reduceat(crc, first[:-1]) if len(size) else crc
    crc ^= _append_zeros(np.full(len(size), 0xFFFFFFFF, np.uint32), size)
    crc ^= np.uint32(0xFFFFFFFF)
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(0xA282EAD8)


#: First bytes of characters that are not white space: digits, letters, and beyond ASCII all lead bytes that no white space has.
_SOLID = np.array([chr(b).isalnum() and b < 128 or 0xC3 <= b <= 0xE0 or 0xE4 <= b <= 0xF4 for b in range(256)])
_encoders: dict[tuple, "Encoder"] = {}


def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """The kind of each ASCII byte, and whether a pre-token always ends between bytes of two kinds (at 8 * left + right)."""
    kind = np.full(256, _UNKNOWN, np.uint8)
    for b in range(33, 127):
        kind[b] = _LETTER if chr(b).isalpha() else _DIGIT if chr(b).isdigit() else _QUOTE if b == 39 else _SIGN
    kind[9:14], kind[32] = _WHITE, _SPACE
    edge, solid = np.zeros((8, 8), bool), (_LETTER, _DIGIT, _SIGN, _QUOTE)
    for left in solid:
        for right in (*solid, _WHITE, _SPACE):
            edge[left, right] = left != right and {left, right} != {_SIGN, _QUOTE}
    edge[_QUOTE, _LETTER] = False  # may be a contraction
    return kind, edge.ravel()


#: What only the tokenizer can tell apart is unknown: control characters and all beyond U+023F, × and ÷.
_UNKNOWN, _WHITE, _SPACE, _LETTER, _DIGIT, _SIGN, _QUOTE = range(7)
_KIND, _EDGE = _kinds()


def _cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where texts laid end to end (a line feed after each) may be cut, so that the pieces have the ids that they have in their text.

    Before a space that a solid character follows; where the kind of character changes; and behind one white space, but a
    blank, that stands alone.
    """
    kind = _KIND[data]
    lead = np.flatnonzero((data >= 0xC3) & (data <= 0xC8))  # U+00C0 to U+023F: letters, but for two
    lead = lead[(data[lead] != 0xC3) | ((data[lead + 1] & 0xDF) != 0x97)]
    kind[lead] = kind[lead + 1] = _LETTER
    kind[offsets[1:] - 1] = _UNKNOWN
    cut = np.zeros(len(data), bool)
    cut[1:] = _EDGE[kind[:-1] * np.uint8(8) + kind[1:]]
    cut[:-1] |= (data[:-1] == 32) & _SOLID[data[1:]]
    cut[offsets[:-1][np.diff(offsets) > 1]] = True
    cut[1:] |= cut[:-1] & (kind[:-1] == _WHITE) & (kind[1:] >= _LETTER)
    return cut


def _each(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places of all bytes of ranges laid end to end."""
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(int(size.sum()))


class Encoder:
    """Ids of texts by the tokenizers library, each distinct piece encoded once and remembered by its hash and bytes.

    Byte-level tokenizers never join words, numbers and signs to each other, so a text may be cut between them: a word is
    learnt once, whatever stands beside it. Pieces that begin with a space and a solid character may be laid end to end and
    encoded together. A tokenizer of another kind gets whole texts (``cut=False``).
    """

    def __init__(self, path: str, end_id: int, dtype: str, cut: bool):
        from tokenizers import Tokenizer

        self.tokenizer, self.dtype, self.cut, self.end = Tokenizer.from_file(path), np.dtype(dtype), cut, end_id
        if cut:
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
            self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
            for token, i in vocabulary.items():
                self.bytes_of[i] = len(token)  # a character of a token stands for a byte
            #: Added tokens are found before a text is split into words.
            self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
            for i, t in self.tokenizer.get_added_tokens_decoder().items():
                self.bytes_of[i] = len(t.content.encode())
            self._forget()

    @classmethod
    def of_task(cls, *key) -> "Encoder":
        """Workers run many tasks, and what one has learnt serves the next."""
        if key not in _encoders:
            _encoders[key] = cls(*key)
        return _encoders[key]

    def _forget(self) -> None:
        self.known, self.at, self.count, self.pool = np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, self.dtype)
        #: The bytes of each known piece, as equal hashes are no proof.
        self.place, self.size, self.bytes = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8)
        #: In how many slices each was met; halved whenever the memory was full.
        self.met = np.zeros(0, np.int64)

    def _trim(self) -> None:
        keep = np.sort(np.argsort(-self.met, kind="stable")[: CACHE_PIECES // 2])
        self.known, self.at, self.count, self.place, self.size, self.met = (x[keep] for x in (self.known, self.at, self.count, self.place, self.size, self.met // 2))
        self.pool, self.bytes = self.pool[_each(self.at, self.count)], self.bytes[_each(self.place, self.size)]
        self.at, self.place = np.cumsum(self.count) - self.count, np.cumsum(self.size) - self.size

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def _learn(self, hashes: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        spaced = (data[start] == 32) & _SOLID[data[np.minimum(start + 1, len(data) - 1)]]
        order = np.concatenate((np.flatnonzero(spaced), np.flatnonzero(~spaced)))
        hashes, start, size = hashes[order], start[order], (end - start)[order]
        n, ids, counts = int(spaced.sum()), [], []
        for first in range(0, n, 4000):  # pieces laid end to end; byte lengths of tokens tell where each ends
            own = slice(first, min(first + 4000, n))
            sizes = size[own]
            from_ = np.repeat(start[own] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            (found,) = self._encode([data[from_].tobytes().decode()])
            ends = np.searchsorted(np.cumsum(self.bytes_of[found]), np.cumsum(sizes)) + 1
            ids.append(found)
            counts.append(np.diff(ends, prepend=0))
        lone = self._encode([data[a : a + b].tobytes().decode() for a, b in zip(start[n:].tolist(), size[n:].tolist())])
        counts = np.concatenate([*counts, np.array([len(x) for x in lone], np.int64)]).astype(np.int64)
        self.known = np.concatenate((self.known, hashes))
        self.at = np.concatenate((self.at, len(self.pool) + np.cumsum(counts) - counts))
        self.count = np.concatenate((self.count, counts))
        self.pool = np.concatenate((self.pool, *ids, *lone)) if ids or lone else self.pool
        self.place = np.concatenate((self.place, len(self.bytes) + np.cumsum(size) - size))
        self.size = np.concatenate((self.size, size))
        self.bytes = np.concatenate((self.bytes, data[_each(start, size)]))
        self.met = np.concatenate((self.met, np.zeros(len(hashes), np.int64)))
        order = np.argsort(self.known, kind="stable")
        self.known, self.at, self.count, self.place, self.size, self.met = (x[order] for x in (self.known, self.at, self.count, self.place, self.size, self.met))

    def _other(self, entry: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Which pieces aren't those that are known under their hash."""
        other = self.size[entry] != size
        same = np.flatnonzero(~other & (size > 0))
        if len(same):
            differ = data[_each(start[same], size[same])] != self.bytes[_each(self.place[entry[same]], size[same])]
            if differ.any():
                other[same] = np.logical_or.reduceat(differ, np.cumsum(size[same]) - size[same])
        return other

    def _added_in(self, data: np.ndarray):
        """Place and size of each added token."""
        raw = data.tobytes() if self.added else b""
        for token in self.added:
            i = raw.find(token)
            while i >= 0:
                yield i, len(token)
                i = raw.find(token, i + 1)

    def __call__(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text, with the end id, as bytes."""
        end = np.array([self.end], self.dtype)
        if not self.cut:
            return [np.concatenate((x, end)).tobytes() for x in self._encode(texts.to_pylist())]
        out: list[bytes] = []
        for begin, stop in slices(texts, 1 << 19):
            data, offsets = laid_out(texts, begin, stop)
            cut = _cuts(data, offsets)
            for i, size in self._added_in(data):  # not within an added token
                cut[i + 1 : i + size] = False
            start = np.flatnonzero(cut)
            close = offsets[1:][np.searchsorted(offsets, start, "right") - 1] - 1
            ends = np.minimum(np.append(start[1:], len(data)), close)
            hashes = pieces(data, start, ends)
            distinct, first, of = np.unique(hashes, return_index=True, return_inverse=True)
            if len(self.known) > CACHE_PIECES:
                self._trim()
            new = ~contains(self.known, distinct)
            if new.any():
                self._learn(distinct[new], data, start[first[new]], ends[first[new]])
            entry = np.searchsorted(self.known, distinct)
            self.met[entry] += 1
            entry = entry[of]
            counts = self.count[entry]
            total = np.cumsum(counts)
            ids = self.pool[np.repeat(self.at[entry] - total + counts, counts) + np.arange(int(counts.sum()))]
            upto = np.concatenate(([0], total))[np.searchsorted(start, offsets[1:])]
            edges = np.concatenate(([0], upto)).tolist()
            found = [ids[a:b].tobytes() + end.tobytes() for a, b in zip(edges[:-1], edges[1:])]
            other = self._other(entry, data, start, ends - start)
            for i in np.unique(np.searchsorted(offsets, start[other], "right") - 1).tolist():  # hashes that clash: such texts are encoded whole
                found[i] = np.concatenate((*self._encode([texts[begin + i].as_py()]), end)).tobytes()
            out += found
        return out


def _is_byte_level(path: str) -> bool:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    kind = str(tokenizer.pre_tokenizer)
    # An added token ends the text before it, where white space is split in another way; so texts are cut only beside those that start with a sign.
    plain = not any(t.lstrip or t.rstrip or t.single_word or re.search(r"\s|^[^!-/:-@\[-`{-~]", t.content) for t in tokenizer.get_added_tokens_decoder().values())
    return plain and tokenizer.normalizer is None and "ByteLevel" in kind and "Sequence" not in kind and "add_prefix_space=False" in kind and "use_regex=False" not in kind


def _frames(ids: list[bytes], doc_ids: list[int | None], width: int) -> tuple[bytes, np.ndarray]:
    """Records laid end to end, and the size of each."""
    payloads = [struct.pack("<Bq", d is None, d or 0) + x for x, d in zip(ids, doc_ids)]
    size = np.array([len(p) for p in payloads], np.int64)
    lengths = size.astype("<u8").view(np.uint8)
    at = np.arange(len(size)) * 8
    data = np.frombuffer(b"".join(payloads), np.uint8)
    ends = np.cumsum(size)
    of_length, of_data = masked_crc32c(lengths, at, at + 8), masked_crc32c(data, ends - size, ends)
    out = []
    for p, n, a, b in zip(payloads, size.tolist(), of_length.tolist(), of_data.tolist()):
        out += (struct.pack("<QI", n, a), p, struct.pack("<I", b))
    return b"".join(out), size + 16


#: Names that Arrow has for the schemes of Hadoop's file systems.
_ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def arrow_uri(spark: SparkSession, path: str) -> str:
    """The URI under which Arrow finds what Hadoop calls ``path``: a path without scheme lies in Spark's default file system, not on an executor's disk."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    full = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(hadoop).toUri()
    scheme, host = full.getScheme(), full.getAuthority()
    return f"{_ARROW_SCHEMES.get(scheme, scheme)}://{host or ''}{full.getRawPath()}"


def write_records(docs: DataFrame, path: str, *, tokenizer_path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = 16 << 20) -> DataFrame:
    """Write the ids of all texts in ascending doc_id order (null first; repeated ids by the hash of their texts) and return the manifest.

    Manifest: shard, n_docs, n_tokens, width (bytes an id), one row for each shard that has documents. Null and empty texts
    give a record with the end id only. No rows: no files and an empty manifest.

    Rows alike in id and text are dealt to several shards too, and any file system that both Hadoop and Arrow know will do.

    Texts are dealt into ranges of doc_id before they are encoded, so that no id sequence is shuffled. A task writes its
    shard under a name of its own and renames it when it is whole; a task that runs again writes the same bytes.
    """
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    shards = max(1, -(-text_bytes(texts) // shard_bytes))
    cut = _is_byte_level(tokenizer_path)
    width = 2 if _vocabulary(tokenizer_path, end_id) <= 1 << 16 else 4
    where = arrow_uri(docs.sparkSession, path)

    def write(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from pyarrow import fs

        shard, docs_, tokens, offset = TaskContext.get().partitionId(), 0, 0, 0
        encode = Encoder.of_task(tokenizer_path, end_id, f"<u{width}", cut)
        out = index = None
        name = f"part-{shard:08d}"
        for batch in batches:
            for begin, end in slices(batch.column("text"), 1 << 19):
                part = batch.slice(begin, end - begin)
                if out is None:
                    system, root = fs.FileSystem.from_uri(where)
                    system.create_dir(root, recursive=True)
                    own = f"{root}/_{name}.{TaskContext.get().taskAttemptId()}"
                    out, index = system.open_output_stream(own + ".bin"), system.open_output_stream(own + ".idx")
                ids = encode(part.column("text"))
                data, size = _frames(ids, part.column("doc_id").to_pylist(), width)
                out.write(data)
                counts = np.array([len(x) // width for x in ids], "<u8")
                index.write(np.stack([offset + np.cumsum(size) - size, counts], axis=1).astype("<u8").tobytes())
                offset, docs_, tokens = offset + int(size.sum()), docs_ + len(ids), tokens + int(counts.sum())
        if out is not None:
            out.close()
            index.close()
            for kind in (".bin", ".idx"):
                system.move(own + kind, f"{root}/{name}{kind}")
            tidy()
            yield pa.RecordBatch.from_pydict({"shard": [shard], "n_docs": [docs_], "n_tokens": [tokens], "width": [width]}, pa.schema([("shard", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("width", pa.int32())]))

    # Not by id alone: many rows may have none, or the same. The last key only deals rows that are alike in both to several shards.
    order = [F.col("doc_id").asc_nulls_first(), F.col("hash").asc(), F.col("row").asc()]
    marked = texts.withColumns({"hash": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    ordered = marked.repartitionByRange(shards, *order).sortWithinPartitions(*order).drop("hash", "row")
    return written(ordered.mapInArrow(keyed(write), "shard int, n_docs long, n_tokens long, width int"), "token-manifest")


def _vocabulary(path: str, end_id: int) -> int:
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True), end_id + 1)


def parse(data: bytes, width: int) -> list[tuple[int | None, bytes]]:
    """doc_id and ids of each record; raises if a checksum is wrong."""
    heads, starts, ends, at = [], [], [], 0
    while at < len(data):
        n, crc = struct.unpack_from("<QI", data, at)
        heads.append((at, crc))
        starts.append(at + 12)
        ends.append(at + 12 + n)
        at += 16 + n
    raw = np.frombuffer(data, np.uint8)
    head_at, start, end = np.array([h[0] for h in heads], np.int64), np.array(starts, np.int64), np.array(ends, np.int64)
    if at != len(data) or (masked_crc32c(raw, head_at, head_at + 8) != np.array([h[1] for h in heads], np.uint32)).any():
        raise ValueError("a record's length is damaged")
    said = np.array([struct.unpack_from("<I", data, e)[0] for e in ends], np.uint32)
    for begin in range(0, len(starts), 2000):  # bounded work arrays
        part = slice(begin, begin + 2000)
        if (masked_crc32c(raw, start[part], end[part]) != said[part]).any():
            raise ValueError("a record's payload is damaged")
    out = []
    for s, e in zip(starts, ends):
        null, doc_id = struct.unpack_from("<Bq", data, s)
        out.append((None if null else doc_id, data[s + 9 : e]))
    return out


def read_records(manifest: DataFrame, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, read back from the shards.

    Spark reads whole shards (``shard_bytes`` bounds them, but for one very long document). Each shard's first position is a
    running sum over the manifest, which has one row a shard.
    """
    spark = manifest.sparkSession
    schema = "shard int, doc_id long, at long, n_tokens long, ids_crc32 long"
    first = manifest.first()
    if first is None:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    width = first["width"]
    arrow = pa.schema([("shard", pa.int32()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(batches):
        for batch in batches:
            for where, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                shard = int(re.search(r"part-(\d+)\.bin$", where)[1])
                records = parse(content.as_py(), width)
                counts = np.array([len(x) // width for _, x in records], np.int64)
                crcs = [zlib.crc32(np.frombuffer(x, f"<u{width}").astype("<u4").tobytes()) for _, x in records]
                yield pa.RecordBatch.from_arrays([pa.array([shard] * len(records), pa.int32()), pa.array([d for d, _ in records], pa.int64()), pa.array(np.cumsum(counts) - counts), pa.array(counts), pa.array(crcs, pa.int64())], schema=arrow)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.bin").load(path).select("path", "content")
    bases = manifest.select(F.col("shard").alias("b_shard"), (F.sum("n_tokens").over(Window.partitionBy(F.lit(1)).orderBy("shard")) - F.col("n_tokens")).alias("base"))
    rows = files.mapInArrow(read, schema)
    return rows.join(lookup(written(bases, "token-bases")), F.col("shard") == F.col("b_shard")).select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def encode_and_read(docs: DataFrame, *, tokenizer_path: str, end_id: int = 0, path: str | None = None, **options) -> DataFrame:
    """Write the records to ``path`` (a new folder in the shared one if none is given) and read them back."""
    path = path or new_path(docs.sparkSession, "tokens")
    return read_records(write_records(docs, path, tokenizer_path=tokenizer_path, end_id=end_id, **options), path)
