"""Best-fit packing of token sequences in bulk-synchronous rounds.

Every document becomes token ids plus an end id.  Only one longer than the
capacity is cut, into pieces of the capacity; its first piece takes the rest.
Full pieces are sequences of their own.  The others, at most one a document,
are packed in rounds over two tables, the pieces that wait and the open gaps:

1. Both are range-sorted together from the largest to the smallest (the sort
   key ends in an id, so a hot size is split over partitions), into ranges of
   about ``RANGE_ROWS`` rows.  As the waiting set shrinks there are fewer; what fits
   into one is packed there to the end, so the number of sequences doesn't hang
   on the session's partitions.
2. Every partition sweeps down its range: a piece goes to its successor, the
   smallest gap that holds it, and what is left of the gap is a gap again.
3. Pieces without a gap in their range meet the unused gaps of the larger
   ranges.  Both are ranked in their partition; the partitions' counts (four
   numbers each) are matched like brackets, nearest range first, as many pieces
   to a gap as surely fit.  This gives every rank of a piece the partition and
   rank of one gap and so resolves all conflicts; a join on (partition, rank)
   applies it.
4. Gaps are updated.  Of the pieces that no gap took, the largest open as many
   sequences as the length of all needs beyond the room that is left, and the
   next round begins.

Pieces come in phases, each half the size of the one before, so that the small
ones fill what the large ones leave.

Defined results: a null or empty text is the end id alone; rows that repeat a
doc_id are packed each; an empty table gives no rows; a very long text is
encoded whole and cut; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .byte_ids import byte_ids
from .common import Scratch, batches, id_text

CAPACITY = 1024
#: Halvings of the capacity that are packed one after another.
PHASES = 3
END_ID = 2


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian unsigned 16-bit) and
    ids_crc32 (of the ids as little-endian unsigned 32-bit numbers)."""
    rows = id_text(docs)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_ids().packed
        end = np.array([end_id], np.uint16).tobytes()
        for b in batches(it, 4 << 20):
            row, number, start, packed, crc = [], [], [], [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                ids = encode(text or "") + end
                wide = np.frombuffer(ids, np.uint16).astype("<u4").tobytes()
                n = len(ids) // 2
                at = [0, *range((n - 1) % capacity + 1, n, capacity), n]
                for k in range(len(at) - 1):
                    row.append(i)
                    number.append(k)
                    start.append(at[k])
                    packed.append(ids[2 * at[k]:2 * at[k + 1]])
                    crc.append(zlib.crc32(wide[4 * at[k]:4 * at[k + 1]]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row, pa.int64())), pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                 pa.array([len(x) // 2 for x in packed], pa.int64()), pa.array(packed, pa.binary()),
                 pa.array(crc, pa.int64())], names=["doc_id", "piece", "start", "length", "ids", "ids_crc32"])
    return rows.mapInArrow(run, f"doc_id {rows.dtypes[0][1]}, piece int, start bigint, length bigint, ids binary, "
                                "ids_crc32 bigint")


SWEPT = "kind int, id bigint, size int, seq bigint, offset int, rank bigint"
WAITS, GAP, PLACED, USED = 0, 1, 2, 3


#: Pieces and gaps of a range; fewer are packed in one.
RANGE_ROWS = 100_000


def _sweep(capacity: int, alone: bool = False):
    """One partition's sweep.  In: (size descending, gaps first) is_gap, id,
    size.  Out, by kind: pieces placed (seq, offset), pieces that wait (rank),
    gaps that hold every piece of the smaller ranges (rank) and smaller gaps.
    ``alone``: the only range, whose pieces open sequences where no gap fits."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[int]] = [[] for _ in range(capacity + 1)]
        full = 0  # bit g: some gap has size g
        last, waiting = capacity, 0
        for b in it:
            out: tuple[list, ...] = ([], [], [], [], [], [])
            for is_gap, id_, size in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                last = size
                if is_gap:
                    held[size].append(id_)
                    full |= 1 << size
                    continue
                above = full >> size
                if above:
                    gap = size + (above & -above).bit_length() - 1
                    seq = held[gap].pop()
                    if not held[gap]:
                        full &= ~(1 << gap)
                    if gap > size:
                        held[gap - size].append(seq)
                        full |= 1 << (gap - size)
                    row = (PLACED, id_, size, seq, capacity - gap, None)
                elif alone:  # there is no other range: the piece opens a sequence
                    row = (PLACED, id_, size, id_, 0, None)
                    held[capacity - size].append(id_)
                    full |= 1 << (capacity - size)
                else:
                    row = (WAITS, id_, size, None, None, waiting)
                    waiting += 1
                for o, x in zip(out, row, strict=True):
                    o.append(x)
            if out[0]:
                yield _swept(out)
        # Nearest ranges are matched first, so the smallest gaps come first.
        # (Gaps under half the largest wait: all ranked ones hold about as much.)
        rank, out = 0, ([], [], [], [], [], [])
        for size in range(1, capacity + 1):
            for seq in held[size]:
                fits = size >= last and 2 * size >= full.bit_length() - 1
                for o, x in zip(out, (GAP if fits else USED, seq, size, seq, None, rank if fits else None), strict=True):
                    o.append(x)
                rank += fits
                if len(out[0]) >= 50_000:
                    yield _swept(out)
                    out = ([], [], [], [], [], [])
        if out[0]:
            yield _swept(out)
    return run


def _swept(out) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds, strict=True)],
                                      names=["kind", "id", "size", "seq", "offset", "rank"])


def _brackets(counts: list[tuple]) -> tuple[list[tuple], dict[int, tuple[int, int]], int]:
    """counts: (partition, waiting pieces, gaps, largest piece, smallest gap)
    from the largest range down.  Matches (partition, first rank, end rank, gap
    partition, first gap rank, pieces for each gap); of every partition how many
    first ranks found a gap, and how many pieces of larger ranges found none;
    and how many found none in all."""
    stack: list[list[int]] = []
    matches, found, missing = [], {}, 0
    for part, waiting, gaps, largest, smallest in counts:
        taken = 0
        while taken < waiting and stack:
            top = stack[-1]
            each = top[3] // largest  # at least 1: the gap's range is above
            n = min(waiting - taken, (top[2] - top[1]) * each)
            matches.append((part, taken, taken + n, top[0], top[1], each))
            taken += n
            top[1] += -(-n // each)
            if top[1] == top[2]:
                stack.pop()
        found[part] = (taken, missing)
        missing += waiting - taken
        if gaps:
            stack.append([part, 0, gaps, smallest])
    return matches, found, missing


def best_fit(items: DataFrame, scratch: Scratch, capacity: int = CAPACITY) -> DataFrame:
    """items: id (distinct), size (1 to capacity - 1).  Rows (id, seq, offset)."""
    # Large pieces first: those of one halving of the capacity are all placed
    # before smaller ones may take the gaps that they leave.
    bounds = [capacity >> k for k in range(1, PHASES + 1)] + [0]
    sizes = items.agg(*[F.count(F.when(F.col("size") > b, 1)).alias(str(b)) for b in bounds]).first()
    # Two pieces of more than half the capacity never share a sequence.
    big = items.filter(F.col("size") > bounds[0])
    done = [big.select("id", F.col("id").alias("seq"), F.lit(0).alias("offset"))]
    gaps = [big.select("id", (F.lit(capacity) - F.col("size")).cast("int").alias("size"))]
    turn = 0
    for upper, lower in zip(bounds, bounds[1:], strict=False):
        left = sizes[str(lower)] - sizes[str(upper)]
        waits = items.filter((F.col("size") > lower) & (F.col("size") <= upper))
        while left:
            turn += 1
            every = reduce(DataFrame.unionByName, gaps)
            now, left = _round(waits, left, every.filter(F.col("size") > lower), lower, scratch, capacity, turn)
            done.append(now.filter(F.col("kind") == PLACED).select("id", "seq", "offset"))
            waits = now.filter(F.col("kind") == WAITS).select("id", "size")
            small = scratch.put(every.filter(F.col("size") <= lower), f"small-{turn}")
            gaps = [small, now.filter(F.col("kind") == GAP).select("id", "size")]
    return reduce(DataFrame.unionByName, [d.select("id", "seq", F.col("offset").cast("bigint").alias("offset")) for d in done])


def _round(waits: DataFrame, waiting: int, gaps: DataFrame, lower: int, scratch: Scratch, capacity: int,
           turn: int) -> tuple[DataFrame, int]:
    """One round: a table of the pieces placed, those that still wait and the
    gaps (kind, id, size, seq, offset), and how many pieces still wait."""
    spark = waits.sparkSession
    parts = -(-(waiting + gaps.count()) // RANGE_ROWS)
    both = gaps.select(F.lit(True).alias("is_gap"), "id", "size").unionByName(
        waits.select(F.lit(False).alias("is_gap"), "id", "size"))
    order = [F.col("size").desc(), F.col("is_gap").desc(), F.col("id")]
    if parts <= 1:  # a bounded number of rows is one range, packed to the end
        swept = both.coalesce(1).sortWithinPartitions(*order).mapInArrow(_sweep(capacity, alone=True), SWEPT)
        kind = F.when(F.col("kind") == PLACED, PLACED).otherwise(GAP).alias("kind")
        return scratch.put(swept.select(kind, "id", "size", "seq", "offset"), f"round-{turn}"), 0
    ranged = both.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    swept = scratch.put(ranged.mapInArrow(_sweep(capacity), SWEPT).withColumn("part", F.spark_partition_id()),
                        f"swept-{turn}")
    counts = swept.groupBy("part").agg(  # one row a partition
        F.count(F.when(F.col("kind") == WAITS, 1)).alias("waits"),
        F.count(F.when(F.col("kind") == GAP, 1)).alias("gaps"),
        F.max(F.when(F.col("kind") == WAITS, F.col("size"))).alias("largest"),
        F.min(F.when(F.col("kind") == GAP, F.col("size"))).alias("smallest")).orderBy("part").collect()
    matches, found, lost = _brackets([tuple(r) for r in counts])
    out = [swept.filter(F.col("kind") == PLACED).select("kind", "id", "size", "seq", "offset")]
    left = swept.filter(F.col("kind") == WAITS).select("id", "size", "part", "rank")
    open_gaps = swept.filter(F.col("kind").isin(GAP, USED)).select("id", "size", "part", "rank")
    if matches:
        # At most two ranges of ranks a partition.
        table = spark.createDataFrame(
            matches, "part int, first bigint, end bigint, gap_part int, gap_first bigint, each bigint")
        aimed = left.join(F.broadcast(table), "part").filter("rank >= first AND rank < end").select(
            F.col("id").alias("piece_id"), F.col("size").alias("piece_size"), F.col("gap_part").alias("part"),
            F.expr("(rank - first) div each + gap_first").alias("rank"))
        together = Window.partitionBy("seq").orderBy("piece_id")  # at most ``capacity`` pieces
        met = scratch.put(open_gaps.filter(F.col("rank").isNotNull()).join(aimed, ["part", "rank"]).select(
            "piece_id", "piece_size", F.col("id").alias("seq"), "size").withColumn(
            "filled", F.sum("piece_size").over(together).cast("int")), f"met-{turn}")
        out.append(met.select(F.lit(PLACED).alias("kind"), F.col("piece_id").alias("id"), F.col("piece_size").alias("size"),
                              "seq", (F.lit(capacity) - F.col("size") + F.col("filled") - F.col("piece_size")).alias("offset")))
        used = met.groupBy(F.col("seq").alias("id")).agg(F.max("filled").alias("filled"))
        open_gaps = open_gaps.join(used, "id", "left").select(
            "id", (F.col("size") - F.coalesce("filled", F.lit(0))).alias("size"))
    nothing = F.lit(None)
    as_gap = [F.lit(GAP).alias("kind"), "id", "size", nothing.cast("bigint").alias("seq"), nothing.cast("int").alias("offset")]
    now_open = scratch.put(open_gaps.filter("size > 0").select("id", "size"), f"open-{turn}")
    out.append(now_open.select(*as_gap))
    opens = 0
    if lost:
        taken = spark.createDataFrame([(p, t, m) for p, (t, m) in found.items()], "part int, taken bigint, missing bigint")
        alone = left.join(F.broadcast(taken), "part").filter("rank >= taken").select(
            "id", "size", (F.col("missing") + F.col("rank") - F.col("taken")).alias("place"))
        length = alone.agg(F.sum("size")).first()[0]
        if 2 * lost <= waiting:  # the gaps still take pieces; count on half of their room
            length -= (now_open.filter(F.col("size") > lower).agg(F.sum("size")).first()[0] or 0) // 2
        opens = max(0, min(lost, -(-length // capacity)))
        # The largest of the pieces that nothing holds open new sequences.
        first, later = alone.filter(F.col("place") < opens), alone.filter(F.col("place") >= opens)
        out.append(first.select(F.lit(PLACED).alias("kind"), "id", "size", F.col("id").alias("seq"), F.lit(0).alias("offset")))
        out.append(first.withColumn("size", (F.lit(capacity) - F.col("size")).cast("int")).select(*as_gap))
        out.append(later.withColumn("kind", F.lit(WAITS)).select("kind", "id", "size", *as_gap[3:]))
    now = scratch.put(reduce(DataFrame.unionByName, out), f"round-{turn}")
    scratch.drop(f"swept-{turn}")
    scratch.drop(f"met-{turn}")
    scratch.drop(f"open-{turn}")
    return now, lost - opens


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The pieces of all documents with sequence_id and offset in it."""
    scratch = Scratch(docs.sparkSession, "packing")
    cut = scratch.put(pieces(docs, capacity, end_id).withColumn("id", F.monotonically_increasing_id()), "pieces")
    items = scratch.put(cut.filter(F.col("length") < capacity).select("id", F.col("length").cast("int").alias("size")), "items")
    placed = best_fit(items, scratch, capacity)
    full = cut.filter(F.col("length") == capacity).withColumn("sequence_id", F.col("id")).withColumn(
        "offset", F.lit(0).cast("bigint"))
    rest = cut.filter(F.col("length") < capacity).join(placed.withColumnRenamed("seq", "sequence_id"), "id")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids"]
    return full.select(columns).unionByName(rest.select(columns))


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: its ids as one binary, its pieces in order."""
    return packed.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids"))).alias("p")).select(
        "sequence_id", F.aggregate("p", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"])).alias("ids"),
        F.transform("p", lambda x: x.dropFields("ids")).alias("pieces"))
