"""Mixture-controlled packing of tokenized documents into fixed-length sequences.

Documents wait in one queue per source. In every round of a deficit round-robin each queue is granted its
share of a window; a document is served in the first round whose grants so far cover it, and what is left
over stays with the queue for later rounds. With grants adding up without bound, that round is
`ceil(end / share) - 1`, where `end` is the number of tokens of the queue up to and with the document. So
the order needs no loop over windows: two prefix sums, each cut into blocks, give every document its
round and its place in the stream, and deficits carry across windows and partitions by themselves.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from scanweave.llm.tables import landed
from scanweave.llm.tokens import id_encoder

PIECES = (
    "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long"
)
_BLOCKS = 4096


def token_table(
    docs: DataFrame,
    tokenizer_path: str,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Written table of `row_key`, `doc_id`, `queue`, `ids` (little-endian, 2 or 4 bytes each), `n_tokens`.

    Every document ends with id 0. A null text has that id alone; a null source waits in the queue named
    by the empty string. `row_key` tells repeated rows apart and does not change when a task runs again.
    """
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("queue"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("body"),
    )
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def encode(batches):
        encoder, row = id_encoder(tokenizer_path), TaskContext.get().partitionId() << 33
        width, last = encoder.kind.itemsize, bytes(encoder.kind.itemsize)
        for batch in batches:
            ids = [encoder.encode(body) + last for body in batch.column(2).to_pylist()]
            keys = pa.array(range(row, row + len(ids)), pa.int64())
            row += len(ids)
            sizes = pa.array([len(found) // width for found in ids], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [keys, batch.column(0), batch.column(1), pa.array(ids, pa.binary()), sizes],
                ["row_key", "doc_id", "queue", "ids", "n_tokens"],
            )

    shape = f"row_key long, doc_id {id_type}, queue string, ids binary, n_tokens long"
    return landed(rows.mapInArrow(encode, shape), "packing-ids")


def stream_places(
    tokens: DataFrame,
    window_tokens: int,
    proportions: dict[str, float] | None = None,
) -> DataFrame:
    """`row_key` and `at`: the tokens before each document in the packed stream.

    Without `proportions` a source's share of each window is its share of all tokens, so that all queues
    last to the end; with them, sources not named get the smallest share named, and queues that run
    dry leave their part of the window to the others.
    """
    n_rows, total = tokens.agg(F.count("*"), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
    per_queue = max(1, min(_BLOCKS, n_rows // 256))
    keyed = tokens.select(
        "row_key", "queue", "n_tokens", F.pmod(F.xxhash64("row_key"), F.lit(per_queue)).alias("block")
    )
    one_queue = Window.partitionBy("queue")
    blocks = (
        keyed.groupBy("queue", "block")
        .agg(F.sum("n_tokens").alias("block_tokens"))
        .select(
            "queue",
            "block",
            (F.sum("block_tokens").over(one_queue.orderBy("block")) - F.col("block_tokens")).alias("before"),
            F.sum("block_tokens").over(one_queue).alias("queue_tokens"),
        )
    )
    if proportions:
        share = F.coalesce(
            F.create_map(*(F.lit(x) for pair in proportions.items() for x in pair))[F.col("queue")],
            F.lit(min(proportions.values())),
        ) / F.lit(sum(proportions.values()))
    else:
        share = F.col("queue_tokens") / F.lit(max(total, 1))
    in_block = Window.partitionBy("queue", "block").orderBy("row_key")
    queued = (
        keyed.withColumn("end", F.sum("n_tokens").over(in_block))
        .join(blocks, ["queue", "block"])
        .withColumn("end", F.col("end") + F.col("before"))
        .withColumn("round", F.floor((F.col("end") - 1) / (F.lit(float(window_tokens)) * share)))
        .select("row_key", "queue", "n_tokens", "end", "round")
    )
    queued = landed(queued, "packing-rounds")
    rounds = 1 + (queued.agg(F.max("round")).first()[0] or 0)
    groups = min(_BLOCKS, rounds)
    grouped = queued.withColumn("part", F.floor(F.col("round") * F.lit(groups) / F.lit(rounds)))
    parts = grouped.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    # At most _BLOCKS rows, whatever the size of the input.
    starts = parts.select(
        "part", (F.sum("part_tokens").over(Window.orderBy("part")) - F.col("part_tokens")).alias("before")
    )
    in_part = Window.partitionBy("part").orderBy("round", "queue", "end")
    return (
        grouped.withColumn("upto", F.sum("n_tokens").over(in_part))
        .join(starts, "part")
        .select("row_key", (F.col("before") + F.col("upto") - F.col("n_tokens")).alias("at"))
    )


def cuts(start: int, end: int, total: int, size: int) -> list[tuple[int, int, int, int]]:
    """The pieces of stream positions `start` to `end`: (from, to, sequence, offset).

    Sequences hold `size` tokens; what remains at the end of the stream fills sequences of falling powers
    of two, so none needs padding.
    """
    out, full = [], total // size * size
    while start < end and start < full:
        stop = min(end, (start // size + 1) * size)
        out.append((start, stop, start // size, start % size))
        start = stop
    edge, sequence = full, full // size
    while start < end:
        step = 1 << ((total - edge).bit_length() - 1)
        if start < edge + step:
            stop = min(end, edge + step)
            out.append((start, stop, sequence, start - edge))
            start = stop
        edge, sequence = edge + step, sequence + 1
    return out


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    sequence_tokens: int = 1024,
    window_tokens: int = 64 * 1024,
    proportions: dict[str, float] | None = None,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece of a document: where it lies in the document and in which sequence.

    All documents are packed, each token once; a null or empty text is its end mark alone. Sequences are
    full but for the last ones, which are powers of two, so nothing is padded. Repeated rows are packed as
    often as they come; a null id stays null; no rows give no pieces; columns other than the three named
    are not read. `with_ids` adds the piece's ids as `ids` (little-endian, as stored). Documents
    longer than a sequence, and those across its end, are cut.
    """
    tokens = token_table(docs, tokenizer_path, id_column, text, source)
    total = tokens.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    placed = tokens.select("row_key", "doc_id", "ids", "n_tokens").join(
        # Both sides grow with the corpus: never a copy of one in every task.
        stream_places(tokens, window_tokens, proportions).hint("merge"),
        "row_key",
    )
    rows = placed.select("doc_id", "ids", "n_tokens", "at")
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def lay_out(batches):
        for batch in batches:
            whole, sizes, places = (batch.column(i).to_pylist() for i in (1, 2, 3))
            owner, found, raw = [], [], []
            for i, (ids, n, at) in enumerate(zip(whole, sizes, places)):
                width = len(ids) // n
                values = np.frombuffer(ids, f"<u{width}")
                wide = values.astype("<u4").tobytes()
                for a, b, sequence, offset in cuts(at, at + n, total, sequence_tokens):
                    a, b = a - at, b - at
                    owner.append(i)
                    found.append((a, b - a, zlib.crc32(wide[4 * a : 4 * b]), n, sequence, offset))
                    if with_ids:
                        raw.append(ids[width * a : width * b])
            columns = [pa.array(c, pa.int64()) for c in (zip(*found) if found else [[]] * 6)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            columns.insert(0, batch.column(0).take(pa.array(owner, pa.int64())))
            if with_ids:
                columns.append(pa.array(raw, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(lay_out, PIECES.format(id=id_type) + (", ids binary" if with_ids else ""))


