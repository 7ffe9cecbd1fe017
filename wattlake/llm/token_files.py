"""Token-id files: write the ids of all documents in order of doc_id, and read them back.

One file for each range of doc_id, a Parquet file whose rows are blocks of whole documents; a row
holds what its documents need to be found (file, block, start in the file) and the coded ids (see
id_codec). So files lie in any store that Spark can write to, a lost task is written anew, and a
block can be read alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattlake.llm import id_codec
from wattlake.llm.arrow import id_and_text, map_in_arrow, slices, texts_of
from wattlake.llm.encoding import encoder

BLOCK_IDS = 1 << 20

FILE_COLUMNS = "file int, block int, start long, n_ids long, {ids}, lengths array<long>, payload binary"


def write(
    docs: DataFrame,
    path: str,
    vocabulary: str = "word_bpe_49k.json",
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Write the files. A null or empty text is the end id alone; rows with equal ids keep all
    their rows; rows without an id come first; an empty table makes files without blocks."""
    source = id_and_text(docs, id_col, text_col)
    kind = source.schema["doc_id"].dataType.simpleString()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = TaskContext.get().partitionId()
        encode = encoder(vocabulary).encode
        end = end_id.to_bytes(4, "little")
        block = start = waiting = 0
        keys: list[pa.Array] = []
        lengths: list[int] = []
        parts: list[bytes] = []

        def flush() -> pa.RecordBatch:
            nonlocal block, start, waiting
            ids = np.frombuffer(b"".join(parts), "<u4").astype(np.int64)
            held = pa.concat_arrays(keys)
            row = pa.RecordBatch.from_arrays(
                [
                    pa.array([file], pa.int32()),
                    pa.array([block], pa.int32()),
                    pa.array([start], pa.int64()),
                    pa.array([len(ids)], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), held),
                    pa.array([lengths], pa.list_(pa.int64())),
                    pa.array([id_codec.encode(ids)], pa.binary()),
                ],
                names=["file", "block", "start", "n_ids", "doc_ids", "lengths", "payload"],
            )
            block, start, waiting = block + 1, start + len(ids), 0
            keys.clear(), lengths.clear(), parts.clear()
            return row

        for batch in batches:
            for part in slices(batch, 256):
                found = [ids + end for ids in encode(texts_of(part))]
                keys.append(part.column("doc_id"))
                parts.extend(found)
                lengths.extend(len(ids) // 4 for ids in found)
                waiting += sum(map(len, found)) // 4
                if waiting >= BLOCK_IDS:
                    yield flush()
        if waiting:
            yield flush()

    # The range is cut on the table as it is read, so that finding it tokenizes nothing.
    ranges = source.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    map_in_arrow(
        ranges, blocks, FILE_COLUMNS.format(ids=f"doc_ids array<{kind}>"), keeps="encoders"
    ).write.option("compression", "none").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids (little-endian unsigned 32-bit) of each document.

    start counts the ids of all documents before it. Only one row for each file is summed in
    order; starts inside a file are in its blocks. A damaged block raises an error.
    """
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    totals = files.groupBy("file").agg(F.sum("n_ids").alias("n"))
    before = totals.select(
        "file",
        (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("file_start"),
    )

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                lengths = np.asarray(row.column("lengths")[0].values, np.int64)
                ids = id_codec.decode(row.column("payload")[0].as_py()).astype("<u4").tobytes()
                stop = np.cumsum(lengths)
                base = row.column("start")[0].as_py() + row.column("file_start")[0].as_py()
                for k in range(0, len(lengths), 1024):
                    some = slice(k, k + 1024)
                    begins, stops = (stop - lengths)[some], stop[some]
                    yield pa.RecordBatch.from_arrays(
                        [
                            row.column("doc_ids")[0].values[some],
                            pa.array(base + begins, pa.int64()),
                            pa.array(lengths[some], pa.int64()),
                            pa.array(
                                [ids[4 * a : 4 * b] for a, b in zip(begins, stops, strict=True)],
                                pa.binary(),
                            ),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )

    coded = files.join(before, "file").select(
        "doc_ids", "lengths", "payload", "start", "file_start"
    )
    return map_in_arrow(
        coded, documents, f"doc_id {kind}, start long, n_tokens long, ids binary"
    )
