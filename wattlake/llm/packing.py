"""Best-fit packing of token sequences by large-item matching.

Documents are cut into pieces of at most ``capacity`` tokens. Only the number of pieces of each
length matters for a packing, and there are at most ``capacity`` lengths; so the packing is planned
on that histogram, whose size does not grow with the data:

* pieces longer than a third of the capacity are matched greedily, the longest with the longest
  that still fits beside it, at most two in a sequence;
* shorter pieces, the longest first, go to the sequences with the smallest sufficient gap, and to
  new sequences where no gap suffices.

The plan is a short list of runs; a run places the pieces of one length whose ranks lie in an
interval. Ranks need no shuffle: a piece's rank is its number among the pieces of that length in
its own partition plus the count in the partitions before.
"""

from __future__ import annotations

import bisect
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattlake.llm.arrow import id_and_text, map_in_arrow, slices, texts_of
from wattlake.llm.encoding import encoder
from wattlake.session import work_folder

RUN_SCHEMA = "length int, rank_0 long, n long, sequence_0 long, across long, offset_0 int"


@dataclass(frozen=True)
class Run:
    """Pieces of a length with rank_0 <= rank < rank_0 + n. Number d among them lies in sequence
    sequence_0 + d % across, at offset_0 + (d // across) * length."""

    length: int
    rank_0: int
    n: int
    sequence_0: int
    across: int
    offset_0: int


def plan(histogram: dict[int, int], capacity: int) -> list[Run]:
    """Runs that place all pieces of a histogram length -> count (lengths 1 to capacity)."""
    left = {k: n for k, n in histogram.items() if n}
    used: dict[int, int] = defaultdict(int)
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)
    runs: list[Run] = []
    sequences = 0

    def place(length: int, n: int, sequence: int, across: int, offset: int) -> None:
        runs.append(Run(length, used[length], n, sequence, across, offset))
        used[length] += n
        left[length] -= n
        if not left[length]:
            del left[length]

    large = sorted(k for k in left if 3 * k > capacity)
    while large:
        a = large[-1]
        if a not in left:
            large.pop()
            continue
        at = bisect.bisect_right(large, min(a, capacity - a)) - 1
        while at >= 0 and large[at] not in left:
            at -= 1
        b = large[at] if at >= 0 else 0
        if b and (b != a or left[a] > 1):
            m = left[a] // 2 if a == b else min(left[a], left[b])
            place(a, m, sequences, m, 0)
            place(b, m, sequences, m, a)
            gap = capacity - a - b
        else:
            # A last one that fits only beside its own kind takes the next shorter partner.
            at -= 1
            while b and at >= 0 and large[at] not in left:
                at -= 1
            b = large[at] if b and at >= 0 else 0
            m = 1 if b else left[a]
            place(a, m, sequences, m, 0)
            if b:
                place(b, m, sequences, m, a)
            gap = capacity - a - b
        if gap:
            gaps[gap].append((sequences, m))
        sequences += m

    free = sorted(gaps)
    for s in sorted(left, reverse=True):
        while s in left:
            at = bisect.bisect_left(free, s)
            if at == len(free):
                q = capacity // s
                m = max(1, left[s] // q)
                gaps[capacity].append((sequences, m))
                bisect.insort(free, capacity)
                sequences += m
                continue
            gap = free[at]
            first, m = gaps[gap].pop()
            q = gap // s
            full = min(m, left[s] // q)
            rest = 0
            if full:
                place(s, full * q, first, full, capacity - gap)
            elif left.get(s):
                rest = left[s]
                place(s, rest, first, 1, capacity - gap)
                full = 1
            if m > full:
                gaps[gap].append((first + full, m - full))
            if not gaps[gap]:
                del gaps[gap]
                free.pop(at)
            new_gap = gap - (rest or q) * s
            if new_gap:
                if new_gap not in gaps:
                    bisect.insort(free, new_gap)
                gaps[new_gap].append((first, full))
    return runs


def cut(
    docs: DataFrame,
    vocabulary: str,
    capacity: int,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of all documents: doc_id, piece, start, length, ids (little-endian unsigned 32-bit),
    with the partition and the rank among pieces of that length in the partition.

    The remainder of a long document is its first piece, all others are full.
    """
    source = id_and_text(docs, id_col, text_col)
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition = TaskContext.get().partitionId()
        encode = encoder(vocabulary).encode
        end = end_id.to_bytes(4, "little")
        ranks: dict[int, int] = defaultdict(int)
        for batch in batches:
            for part in slices(batch, 512):
                rows: list[list] = [[] for _ in range(6)]
                take = []
                for i, ids in enumerate(encode(texts_of(part))):
                    ids += end
                    n = len(ids) // 4
                    begin, stop, piece = 0, n % capacity or capacity, 0
                    while begin < n:
                        length = stop - begin
                        take.append(i)
                        for column, value in zip(
                            rows,
                            (piece, begin, length, ids[4 * begin : 4 * stop], partition, ranks[length]),
                            strict=True,
                        ):
                            column.append(value)
                        ranks[length] += 1
                        begin, stop, piece = stop, stop + capacity, piece + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(take, pa.int64())),
                        pa.array(rows[0], pa.int32()),
                        pa.array(rows[1], pa.int64()),
                        pa.array(rows[2], pa.int64()),
                        pa.array(rows[3], pa.binary()),
                        pa.array(rows[4], pa.int32()),
                        pa.array(rows[5], pa.int64()),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids", "partition", "local_rank"],
                )

    return map_in_arrow(
        source,
        run,
        f"doc_id {kind}, piece int, start long, length long, ids binary, partition int, "
        "local_rank long",
        keeps="encoders",
    )


def written_pieces(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """cut() with the pieces written under the shared work folder, so that no text is encoded
    twice and ranks stay as they are when a task is lost."""
    path = f"{work_folder(spark, 'pieces')}/pieces"
    cut(docs, **options).write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def place(spark: SparkSession, pieces: DataFrame, capacity: int) -> DataFrame:
    """Give each piece its sequence_id and offset. Further columns go along unread."""
    counts = pieces.groupBy("partition", "length").agg(F.count("*").alias("n"))
    # One row for each length: at most `capacity` rows.
    lengths = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = spark.createDataFrame([astuple(r) for r in plan(lengths, capacity)], RUN_SCHEMA)
    before = counts.select(
        F.col("partition"),
        F.col("length"),
        (
            F.sum("n").over(Window.partitionBy("length").orderBy("partition")) - F.col("n")
        ).alias("ranks_before"),
    )
    ranked = pieces.join(before, ["partition", "length"]).withColumn(
        "rank", F.col("ranks_before") + F.col("local_rank")
    )
    runs = runs.withColumn("length", F.col("length").cast("long"))
    number = F.col("rank") - F.col("rank_0")
    placed = ranked.join(F.broadcast(runs), "length").where(
        (F.col("rank") >= F.col("rank_0")) & (number < F.col("n"))
    )
    carried = [c for c in pieces.columns if c not in ("partition", "local_rank")]
    return placed.select(
        *carried,
        (F.col("sequence_0") + number % F.col("across")).alias("sequence_id"),
        (
            F.col("offset_0") + F.floor(number / F.col("across")).cast("long") * F.col("length")
        ).alias("offset"),
    )


def pack(
    spark: SparkSession,
    docs: DataFrame,
    vocabulary: str = "byte_bpe_50k.json",
    capacity: int = 1024,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: bool = False,
) -> DataFrame:
    """Pieces with their place: doc_id, piece, start, length, ids, sequence_id, offset.

    With ``digest`` the crc32 of the stored ids, ids_crc32, takes the place of the ids before
    anything is shuffled. A null or empty text is the end id alone. Repeated rows are packed as
    often as they occur; an empty table gives no rows; other columns are not read. The numbers of
    sequences depend on how Spark has cut the input, the number of sequences does not.
    """
    pieces = written_pieces(
        spark,
        docs,
        vocabulary=vocabulary,
        capacity=capacity,
        end_id=end_id,
        id_col=id_col,
        text_col=text_col,
    )
    if digest:
        pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return place(spark, pieces, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, length, ids, doc_ids in order of offset.

    A group holds at most the capacity in tokens, so it stays small whatever the input.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    joined = F.aggregate("parts", F.lit(b""), lambda ids, p: F.concat(ids, p["ids"]))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["length"]).alias("length"),
        joined.alias("ids"),
        F.transform("parts", lambda p: p["doc_id"]).alias("doc_ids"),
    )
