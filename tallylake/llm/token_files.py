"""Token ids in files of fixed-width bit-packed blocks.

A file is: MAGIC, the packed blocks, an index, and a trailer. A block holds BLOCK ids (the last one fewer, padded with
zeros) in the fewest bits that number the vocabulary, lowest bit first. The index has, for the file's documents in
order, their ids, a null mark each, and the number of token ids up to their end; then the byte offset of each block.
"""

import os
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylake.llm import byte_bpe, storage
from tallylake.llm.arrow_columns import steps

MAGIC = b"TIDPACK1"
BLOCK = 4096
LANES = 64
#: Characters of text that one step of the writer looks up: words repeat, so larger steps look up fewer.
STEP = 6_000_000
TRAILER = struct.Struct("<QQQQB8s")  # place of the index, documents, ids, blocks, bits, magic


def bits_for(vocabulary):
    return max(1, (vocabulary - 1).bit_length())


def pack(ids, bits):
    """Ids as bytes, LANES of them to `bits` 64-bit words; padded with zero ids to whole groups."""
    groups = -(-len(ids) // LANES)
    lanes = np.zeros(groups * LANES, np.uint64)
    lanes[: len(ids)] = ids
    lanes = lanes.reshape(groups, LANES)
    words = np.zeros((groups, bits), np.uint64)
    for lane in range(LANES):
        word, shift = divmod(lane * bits, 64)
        words[:, word] |= lanes[:, lane] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= lanes[:, lane] >> np.uint64(64 - shift)
    return words.astype("<u8").tobytes()


def unpack(data, bits):
    """All ids of whole groups, padding included."""
    words = np.frombuffer(data, "<u8").reshape(-1, bits)
    lanes = np.empty((len(words), LANES), np.uint64)
    for lane in range(LANES):
        word, shift = divmod(lane * bits, 64)
        lanes[:, lane] = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            lanes[:, lane] |= words[:, word + 1] << np.uint64(64 - shift)
    return (lanes & np.uint64((1 << bits) - 1)).astype(np.uint32).ravel()


class Writer:
    """Writes documents' ids to a stream; holds one block and the index."""

    def __init__(self, out, bits):
        self.out, self.bits, self.place = out, bits, len(MAGIC)
        self.docs, self.nulls, self.ends, self.blocks = [], [], [], []
        self.total, self.waiting, self.n_waiting = 0, [], 0
        out.write(MAGIC)

    def add(self, doc_id, ids):
        self.add_all([doc_id], ids, np.array([0, len(ids)]))

    def add_all(self, doc_ids, ids, ends):
        """Several documents whose ids stand end to end, from ends[i] to ends[i + 1]."""
        if len(ids) and int(ids.max()) >> self.bits:
            raise ValueError("an id needs more bits than the vocabulary has")
        self.docs.extend(d or 0 for d in doc_ids)
        self.nulls.extend(d is None for d in doc_ids)
        self.ends.extend((ends[1:] + self.total).tolist())
        self.total += len(ids)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= 64 * BLOCK:
            self._flush(False)

    def _flush(self, last):
        ids = np.concatenate([np.zeros(0, np.uint32), *self.waiting])
        whole = len(ids) if last else len(ids) // BLOCK * BLOCK
        step = BLOCK // LANES * self.bits * 8
        data = pack(ids[:whole], self.bits)
        self.blocks += range(self.place, self.place + len(data), step)
        self.out.write(data)
        self.place += len(data)
        self.waiting, self.n_waiting = [ids[whole:]], len(ids) - whole

    def close(self):
        self._flush(True)
        index = [np.array(self.docs, "<i8"), np.array(self.nulls, "u1"), np.array(self.ends, "<u8"),
                 np.array(self.blocks, "<u8")]
        for part in index:
            self.out.write(part.tobytes())
        self.out.write(TRAILER.pack(self.place, len(self.docs), self.total, len(self.blocks), self.bits, MAGIC))


class Reader:
    """Random access to the ids of a file."""

    def __init__(self, uri):
        system, path = storage.locate(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        trailer = self.file.read_at(TRAILER.size, size - TRAILER.size) if size >= TRAILER.size else b""
        if trailer[-8:] != MAGIC:
            raise ValueError(f"{uri}: not a whole token file")
        place, n, self.total, blocks, self.bits, _ = TRAILER.unpack(trailer)
        raw = self.file.read_at(size - TRAILER.size - place, place)
        self.docs = np.frombuffer(raw, "<i8", n)
        self.nulls = np.frombuffer(raw, "u1", n, 8 * n).astype(bool)
        self.ends = np.frombuffer(raw, "<u8", n, 9 * n).astype(np.int64)
        self.blocks = np.append(np.frombuffer(raw, "<u8", blocks, 17 * n).astype(np.int64), place)

    def ids(self, start, stop):
        """Ids at places start to stop of the file; reads and unpacks only their blocks."""
        if start >= stop:
            return np.zeros(0, np.uint32)
        first, last = start // BLOCK, -(-stop // BLOCK)
        begin, end = int(self.blocks[first]), int(self.blocks[last])
        return unpack(self.file.read_at(end - begin, begin), self.bits)[start - first * BLOCK : stop - first * BLOCK]


@lru_cache(maxsize=2)
def _library_encoder(path):
    """Ids of texts by the tokenizers library, which sees every different word once while it is remembered."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    bpe = byte_bpe.load(path)
    kind = np.uint16 if bpe.size <= 1 << 16 else np.uint32
    line_end = bpe.ids[b"\n"]

    def ids(text):
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, kind)

    def solve(words):
        """Pre-tokens that are a space and letters go to the library as the lines of one text; others as texts of one batch."""
        lines = [w for w in words if w[0] == " " and w[1:].isalpha()]
        found = ids("\n".join([*lines, ""])) if lines else np.zeros(0, kind)
        ends = np.flatnonzero(found == line_end)
        data, width = found.tobytes(), found.itemsize
        stops = (ends * width).tolist()
        starts = [0, *[e + width for e in stops]]
        known = {w: data[a:b] for w, a, b in zip(lines, starts, stops)}
        if len(lines) == len(words):
            return list(known.values())
        rest = [w for w in words if w not in known]
        found = tokenizer.encode_batch_fast(rest, add_special_tokens=False)
        known.update((w, np.array(e.ids, kind).tobytes()) for w, e in zip(rest, found, strict=True))
        return [known[w] for w in words]

    return byte_bpe.PieceTable(bpe, solve, kind, 1_000_000, 60_000_000)


def write_tokens(docs, path, folder, end_id=0, doc_id="doc_id", text="text"):
    """Write the ids of all texts in ascending doc_id order to files in folder, named by their place in that order.

    path: a file of the tokenizers library on every machine; ids are those of its encode without added special tokens,
    and end_id follows each document. Null and empty texts have the end id alone; null doc_ids come first; rows with
    equal ids stand in the order of their texts, so repeated rows give the same files. An empty table gives no file.
    Other columns are not read. Returns the folder. A retried task replaces its own file as a whole.
    """
    chosen = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # By the id and the text: a range of ids that holds very many rows of one id can then be split as well.
    ordered = chosen.repartitionByRange(parts, "doc_id", F.xxhash64("text")).sortWithinPartitions(
        "doc_id", F.xxhash64("text"), "text"
    )

    def run(batches):
        from pyspark import TaskContext

        table, bpe = _library_encoder(path), byte_bpe.load(path)
        rows = []

        def write(out):
            writer = Writer(out, bits_for(max(bpe.size, end_id + 1)))
            for batch in batches:
                for start, size in steps(batch.column("text"), STEP):
                    part = batch.slice(start, size)
                    ids, ends = table.encode(part.column("text"))
                    # The end id after each document's ids.
                    ids = np.insert(ids.astype(np.uint32), ends[1:], end_id)
                    writer.add_all(part.column("doc_id").to_pylist(), ids, ends + np.arange(len(ends)))
            writer.close()
            rows.append((len(writer.docs), writer.total))

        name = f"part-{TaskContext.get().partitionId():07d}.tid"
        storage.commit_file(folder, name, write)
        yield pa.RecordBatch.from_pydict({"file": [name], "n_docs": [rows[0][0]], "n_ids": [rows[0][1]]})

    ordered.mapInArrow(run, "file string, n_docs long, n_ids long").write.format("noop").mode("overwrite").save()
    return folder


def read_tokens(spark, folder, columns=("token_ids",)):
    """One row per document of a folder of token files: doc_id, start (ids before it in all files), n_tokens, and of
    token_ids (array) and ids_crc32 (of the ids as little-endian 32-bit integers) those in columns.

    Files are read in parallel, one task each; each is unpacked a few blocks at a time. No files: no rows.
    """
    files = storage.list_files(folder, (".tid",))
    totals = _totals(spark, files)
    fields = {"token_ids": "token_ids array<long>", "ids_crc32": "ids_crc32 long"}
    schema = ", ".join(["doc_id long", "start long", "n_tokens long", *[fields[c] for c in columns]])

    def run(batches):
        for batch in batches:
            for uri, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                yield from _rows(Reader(uri), base, columns)

    before, rows = 0, []
    for (uri, _), n in zip(files, totals, strict=True):
        rows.append((uri, before))
        before += n
    plan = spark.createDataFrame(rows, "file string, base long")
    return plan.repartition(max(1, len(rows))).mapInArrow(run, schema)


def _totals(spark, files):
    """Ids in each file: one number a file, from its trailer."""
    if not files:
        return []

    def run(batches):
        for batch in batches:
            names = batch.column("file").to_pylist()
            yield pa.RecordBatch.from_pydict({"file": names, "n": [Reader(u).total for u in names]})

    plan = spark.createDataFrame([(u,) for u, _ in files], "file string").repartition(min(len(files), 64))
    found = {r.file: r.n for r in plan.mapInArrow(run, "file string, n long").collect()}
    return [found[u] for u, _ in files]


def _rows(reader, base, columns, most=1 << 20):
    starts = np.concatenate([[0], reader.ends[:-1]]).astype(np.int64) if len(reader.ends) else reader.ends
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(reader.ends, starts[first] + most, "right")))
        ids = reader.ids(int(starts[first]), int(reader.ends[last - 1]))
        cuts = reader.ends[first:last] - starts[first]
        data = {
            "doc_id": pa.array(reader.docs[first:last], mask=reader.nulls[first:last]),
            "start": pa.array(starts[first:last] + base),
            "n_tokens": pa.array(reader.ends[first:last] - starts[first:last]),
        }
        parts = np.split(ids, cuts[:-1])
        if "token_ids" in columns:
            offsets = np.concatenate([[0], cuts]).astype(np.int32)
            data["token_ids"] = pa.ListArray.from_arrays(offsets, ids.astype(np.int64))
        if "ids_crc32" in columns:
            data["ids_crc32"] = pa.array([zlib.crc32(p.astype("<u4").tobytes()) for p in parts], pa.int64())
        yield pa.RecordBatch.from_pydict({k: data[k] for k in ["doc_id", "start", "n_tokens", *columns]})
        first = last
