"""Hard negatives from Hilbert-ordered Parquet blocks with zone maps.

Vectors are written in the order of their places on a Hilbert curve: files of row groups (blocks), each with the least
and greatest value of every dimension and of the label. Interval arithmetic over such a box bounds the inner product of
an anchor with any row of the block from both sides. A task holds some anchors that are close on the curve; it opens
only files, and in them only blocks, whose bounds reach a score window that is still open for one of its anchors.
"""

import base64
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tallylake.llm.hilbert import curve_keys
from tallylake.llm.storage import list_files, locate, new_folder

#: Rows of a block (a Parquet row group) and blocks of a file.
BLOCK_ROWS = 512
FILE_BLOCKS = 256
#: Anchors that a task searches for together.
ANCHORS_A_STEP = 1024
#: The curve runs through the dimensions that vary most, so many of them and so many bits of place in all.
CURVE_AXES = 32
CURVE_BITS = 128
#: Components from here on have no exact place in a float.
_LIMIT = 2.0**53
_NONE = np.iinfo(np.int64).min

_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def quantised(rows, ident, vector, label, scale):
    """(vec_id, label, v): rows that take part, with floor(scale * component) as v."""
    v = F.col(f"`{vector}`").cast("array<double>")
    low, high = F.lit(-_LIMIT / scale), F.lit(_LIMIT / scale)
    usable = F.forall(v, lambda x: F.coalesce((x > low) & (x < high), F.lit(False)))  # NaN is above every number
    wide = F.col(f"`{ident}`").cast("long").alias("vec_id"), F.col(f"`{label}`").cast("long").alias("label")
    taking = rows.where(usable).select(*wide, v.alias("v")).where("vec_id is not null and label is not null")
    return taking.withColumn("v", F.transform("v", lambda x: F.floor(x * scale)))


class Grid:
    """How vectors of a table are padded and put on the curve. Made from one aggregate: a row per dimension."""

    def __init__(self, rows):
        sums = rows.select(F.posexplode("v").alias("at", "x")).groupBy("at")
        found = sorted(sums.agg(F.avg("x"), F.stddev_pop("x"), F.max(F.abs("x"))).collect())
        self.size = len(found)
        most = max((r[3] for r in found), default=0)
        #: The narrowest number type that holds every component.
        self.type = np.dtype(next((t for t in (np.int16, np.int32) if most <= np.iinfo(t).max), np.int64))
        spread = np.array([r[2] for r in found])
        self.axes = np.argsort(-spread, kind="stable")[:CURVE_AXES]
        self.bits = min(16, CURVE_BITS // max(1, len(self.axes)))
        middle = np.array([r[1] for r in found])[self.axes]
        self.step = np.maximum(spread[self.axes], 1e-9) * 4 / (1 << self.bits)
        self.low = middle - 2 * spread[self.axes]

    def matrix(self, column):
        """Vectors of an Arrow list column as rows of equal length: shorter ones end in zeros."""
        lengths = np.diff(column.offsets.to_numpy())
        flat = column.flatten().to_numpy(zero_copy_only=False)
        if len(lengths) and (lengths == self.size).all():
            return flat.reshape(len(lengths), self.size)
        out = np.zeros((len(lengths), self.size), np.int64)
        out[np.arange(self.size) < lengths[:, None]] = flat
        return out

    def keys(self, matrix):
        if not self.size:
            return [b""] * len(matrix)
        cells = (matrix[:, self.axes] - self.low) / self.step
        return [k.tobytes() for k in curve_keys(np.clip(cells, 0, (1 << self.bits) - 1), self.bits)]


def _on_curve(rows, grid, ranges):
    """rows as (place, vec_id, label, v of equal length) in ranges of the curve; rows of one place part by vec_id."""

    def code(batches):
        for batch in batches:
            matrix = grid.matrix(batch.column("v"))
            v = pa.array([x.tobytes() for x in np.ascontiguousarray(matrix, grid.type)], pa.binary())
            place = pa.array(grid.keys(matrix), pa.binary())
            columns = [place, batch.column("vec_id"), batch.column("label"), v]
            yield pa.RecordBatch.from_arrays(columns, ["place", "vec_id", "label", "v"])

    coded = rows.mapInArrow(code, "place binary, vec_id long, label long, v binary")
    return coded.repartitionByRange(ranges, "place", "vec_id").sortWithinPartitions("place", "vec_id", "label")


def _pieces(batches, size):
    """Arrow batches cut and joined to tables of `size` rows, the last one shorter."""
    waiting, n = [], 0
    for batch in batches:
        waiting.append(batch)
        n += batch.num_rows
        if n >= size:
            table = pa.Table.from_batches(waiting).combine_chunks()
            for start in range(0, n - size + 1, size):
                yield table.slice(start, size)
            waiting, n = table.slice(n - n % size).to_batches(), n % size
    if n:
        yield pa.Table.from_batches(waiting).combine_chunks()


def _vectors(column, grid):
    flat = np.frombuffer(b"".join(column.to_pylist()), grid.type)
    return flat.reshape(len(column), grid.size)


def _box(matrix, labels):
    """Zone map of a block: least and greatest of every dimension, and of the label."""
    return np.concatenate([matrix.min(0), matrix.max(0), [labels.min(), labels.max()]]).astype(np.int64)


def _write_blocks(folder, grid):
    """Write a partition as files of blocks; yields (file, box of the file). Boxes of blocks stand in the file's footer.

    Each attempt writes under names of its own, and only names that a finished task has reported are ever read.
    """
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("v", pa.binary())])
    size = grid.size

    def run(batches):
        system, path = locate(folder)
        system.create_dir(path, recursive=True)
        blocks = _pieces(batches, BLOCK_ROWS)
        block = next(blocks, None)
        while block is not None:
            name, boxes = f"{uuid.uuid4().hex}.parquet", []
            with system.open_output_stream(f"{path}/{name}") as out, pq.ParquetWriter(out, schema) as writer:
                while block is not None and len(boxes) < FILE_BLOCKS:
                    boxes.append(_box(_vectors(block.column("v"), grid), block.column("label").to_numpy()))
                    writer.write_table(block.select(schema.names).cast(schema), row_group_size=BLOCK_ROWS)
                    block = next(blocks, None)
                boxes = np.array(boxes, np.int64)
                writer.add_key_value_metadata({"boxes": base64.b64encode(boxes.tobytes()).decode()})
            whole = np.concatenate([boxes[:, :size].min(0), boxes[:, size:2 * size].max(0),
                                    [boxes[:, -2].min(), boxes[:, -1].max()]])
            yield pa.RecordBatch.from_pylist([{"file": name, "box": whole.tobytes()}])

    return run


def _exact_type(left, right):
    """Number type in which all inner products of rows within two bounds of magnitude, and their parts, are whole."""
    most = float(left.astype(float).dot(right.astype(float)))
    if most < 2**24:
        return np.float32
    if most < 2**53:
        return np.float64
    if most < 2**62:
        return np.int64
    raise ValueError("inner products of these vectors do not fit a long")


class Boxes:
    """Bounds on the inner products of vectors with all rows inside boxes."""

    def __init__(self, raw, size):
        rows = np.frombuffer(raw, np.int64).reshape(-1, 2 * size + 2)
        self.low, self.high, self.first, self.last = rows[:, :size], rows[:, size:-2], rows[:, -2], rows[:, -1]
        self.reach = np.maximum(np.abs(self.low), np.abs(self.high)).max(0) if len(rows) else np.zeros(size)

    def one(self, i):
        """The i-th box alone, for labels."""
        alone = object.__new__(Boxes)
        alone.first, alone.last = self.first[i:i + 1], self.last[i:i + 1]
        return alone

    def bounds(self, vectors, kind):
        up, down = np.maximum(vectors, 0).astype(kind), np.minimum(vectors, 0).astype(kind)
        low, high = self.low.T.astype(kind), self.high.T.astype(kind)
        return (up @ low + down @ high).astype(np.int64), (up @ high + down @ low).astype(np.int64)


class Best:
    """The best k (score, vec_id) of each of several searches: higher scores first, then smaller ids."""

    def __init__(self, searches, k):
        self.score = np.full((searches, k), _NONE)
        self.ident = np.full((searches, k), np.iinfo(np.int64).max)

    def add(self, at, score, ident):
        """New finds: searches they belong to, scores, ids."""
        k = self.score.shape[1]
        rows = np.unique(at)
        if not len(rows):
            return
        at = np.concatenate([np.repeat(rows, k), at])
        score = np.concatenate([self.score[rows].ravel(), score])
        ident = np.concatenate([self.ident[rows].ravel(), ident])
        order = np.lexsort((ident, -np.maximum(score, _NONE + 1), at))
        sizes = np.bincount(np.searchsorted(rows, at))
        place = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        first = order[place < k]
        self.score[rows], self.ident[rows] = score[first].reshape(-1, k), ident[first].reshape(-1, k)


class _Positives:
    """Search for each anchor's best rows of the same label."""

    def __init__(self, ids, labels, k):
        self.ids, self.labels, self.best = ids, labels, Best(len(ids), k)

    def open(self, at, low, high, boxes):
        """Which of the anchors at need which boxes; bounds have a row per anchor."""
        same = (boxes.first <= self.labels[at, None]) & (self.labels[at, None] <= boxes.last)
        return same & (high >= self.best.score[at, -1:])

    def read(self, at, scores, ids, labels):
        hit = (labels == self.labels[at, None]) & (ids != self.ids[at, None])
        hit &= scores >= np.maximum(self.best.score[at, -1:], -(2.0**62))
        k = self.best.score.shape[1]
        if len(ids) > k and hit.sum() > 4 * k * len(at):  # few finds so far: the k-th best of the block is a floor
            floor = np.partition(np.where(hit, scores, -np.inf), len(ids) - k, axis=1)[:, len(ids) - k]
            hit &= scores >= floor[:, None]
        i, j = np.nonzero(hit)
        self.best.add(at[i], scores[i, j].astype(np.int64), ids[j])


class _Windows:
    """Search for the best rows of other labels whose scores lie in the windows below each positive's score."""

    def __init__(self, labels, positives, low_pct, high_pct, k):
        self.labels = labels
        found = positives != _NONE
        wide = np.where(found, positives, 0)
        self.low = np.where(found, -((-low_pct * wide) // 100), 1)
        self.high = np.where(found, (high_pct * wide) // 100, 0)
        self.best = Best(self.low.size, k)

    def _floors(self, at):
        k = self.low.shape[1]
        return np.maximum(self.low, self.best.score[:, -1].reshape(-1, k))[at]

    def open(self, at, low, high, boxes):
        floors, tops = self._floors(at), self.high[at]
        other = (boxes.first != self.labels[at, None]) | (boxes.last != self.labels[at, None])
        need = np.zeros(high.shape, bool)
        for i in range(floors.shape[1]):
            live = floors[:, i] <= tops[:, i]
            need |= live[:, None] & (high >= floors[:, i, None]) & (low <= tops[:, i, None])
        return need & other

    def read(self, at, scores, ids, labels):
        floors, tops = self._floors(at), self.high[at]
        empty = floors > tops
        least, most = np.where(empty, 2**62, floors).min(1), np.where(empty, -(2**62), tops).max(1)
        hit = (scores >= least[:, None]) & (scores <= most[:, None]) & (labels != self.labels[at, None])
        i, j = np.nonzero(hit)
        found = scores[i, j].astype(np.int64)
        for window in range(floors.shape[1]):
            inside = (found >= floors[i, window]) & (found <= tops[i, window])
            self.best.add(at[i[inside]] * floors.shape[1] + window, found[inside], ids[j[inside]])


def _scan(folder, zones, vectors, grid, search):
    """Let a search read every block that one of its anchors needs, files and blocks of the highest bounds first.

    The list of files is read piece by piece; bounds are taken again before each file and block, as windows close.
    """
    reach, everyone = np.abs(vectors).max(0), np.arange(len(vectors))
    system, path = locate(folder)
    for part, _ in zones:
        source, where = locate(part)
        with source.open_input_file(where) as stream:
            for batch in pq.ParquetFile(stream).iter_batches(batch_size=1000):
                names = batch.column("file").to_pylist()
                boxes = Boxes(b"".join(batch.column("box").to_pylist()), grid.size)
                low, high = boxes.bounds(vectors, _bound_type(reach, boxes.reach))
                for f in np.argsort(-high.max(0), kind="stable"):
                    one = boxes.one(f)
                    at = everyone[search.open(everyone, low[:, f:f + 1], high[:, f:f + 1], one)[:, 0]]
                    if len(at):
                        _scan_file(system, f"{path}/{names[f]}", vectors, reach, grid, search, at)


def _bound_type(left, right):
    return np.float64 if _exact_type(left, right) is not np.int64 else np.int64


def _scan_file(system, path, vectors, reach, grid, search, at):
    with system.open_input_file(path) as stream:
        file = pq.ParquetFile(stream)
        boxes = Boxes(base64.b64decode(file.metadata.metadata[b"boxes"]), grid.size)
        low, high = boxes.bounds(vectors[at], _bound_type(reach, boxes.reach))
        kind = _exact_type(reach, boxes.reach)
        for b in np.argsort(-high.max(0), kind="stable"):
            need = search.open(at, low[:, b:b + 1], high[:, b:b + 1], boxes.one(b))[:, 0]
            if need.any():
                block = file.read_row_group(int(b))
                rows = _vectors(block.column("v"), grid).T.astype(kind)
                scores = vectors[at[need]].astype(kind) @ rows
                search.read(at[need], scores, block.column("vec_id").to_numpy(), block.column("label").to_numpy())


def _search(folder, zone_folder, grid, positives, negatives, low_pct, high_pct):
    names = [n.split()[0] for n in _RESULT.split(", ")]

    def run(batches):
        zones = list_files(zone_folder, ".parquet")
        for anchors in _pieces(batches, ANCHORS_A_STEP):
            ids, labels = anchors.column("vec_id").to_numpy(), anchors.column("label").to_numpy()
            vectors = _vectors(anchors.column("v"), grid).astype(np.int64)
            first = _Positives(ids, labels, positives)
            _scan(folder, zones, vectors, grid, first)
            windows = _Windows(labels, first.best.score, low_pct, high_pct, negatives)
            _scan(folder, zones, vectors, grid, windows)
            search, place = np.nonzero(windows.best.score != _NONE)
            anchor, positive = search // positives, search % positives
            columns = [
                ids[anchor], first.best.ident[anchor, positive], place + 1, windows.best.ident[search, place],
                first.best.score[anchor, positive], windows.best.score[search, place],
            ]
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c).cast(t) for c, t in zip(columns, types)], names)

    return run


def hard_negatives(rows, is_anchor, ident="vec_id", vector="embedding", label="label", scale=256, positives=5,
                   negatives=5, low_pct=80, high_pct=100):
    """For each anchor and each of its positives, the best rows of other labels inside the positive's score window.

    Components become floor(scale * x); a score is the integer inner product. An anchor's positives are its best
    `positives` rows of its label under other ids; its negatives for a positive are the best `negatives` rows with
    low_pct * positive score <= 100 * score <= high_pct * positive score. Higher scores come first, equal ones by id.
    is_anchor is a condition on the columns of rows. Returns anchor_id, positive_id, rank, negative_id and both scores.

    All rows are searched, exactly. Rows with a null id or label, a null vector, or a component that is null, not
    finite or 2**53 / scale or more take no part. Shorter vectors count as if they ended in zeros. A repeated row is
    found as often as it is there, an anchor that repeats is answered each time. Pairs without a negative, and empty
    tables, give no rows. Other columns are not read. Texts play no part.
    """
    spark = rows.sparkSession
    taking = quantised(rows, ident, vector, label, scale)
    asking = quantised(rows.where(is_anchor), ident, vector, label, scale)
    grid = Grid(taking)
    n, asked = taking.count(), asking.count()
    cores = spark.sparkContext.defaultParallelism
    folder = new_folder(spark, "vector-blocks")
    ranges = max(-(-n // (BLOCK_ROWS * FILE_BLOCKS)), min(cores, -(-n // BLOCK_ROWS)), 1)
    written = _on_curve(taking, grid, ranges).mapInArrow(_write_blocks(folder, grid), "file string, box binary")
    zone_folder = new_folder(spark, "vector-zones")
    written.write.parquet(zone_folder)
    groups = max(-(-asked // ANCHORS_A_STEP), min(4 * cores, -(-asked // 16)), 1)
    search = _search(folder, zone_folder, grid, positives, negatives, low_pct, high_pct)
    return _on_curve(asking, grid, groups).mapInArrow(search, _RESULT)
