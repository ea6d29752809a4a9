"""Token counts of whole texts, lengths only."""

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from scanweave.llm.tokens import by_bytes, piece_lengths

_BLANKS = b" \t\n\r\x0b\x0c"


def safe_parts(text: bytes, most: int) -> list[bytes]:
    """`text` in parts of about `most` bytes, cut in front of ASCII white space only.

    No token of an encoding that drops white space reaches across, so the counts of the parts add up to
    the count of the text. A run without white space is never cut.
    """
    parts, start = [], 0
    while len(text) - start > most:
        found = [at for mark in _BLANKS if (at := text.find(mark, start + most)) >= 0]
        if not found:
            break
        parts.append(text[start : min(found)])
        start = min(found)
    return [*parts, text[start:]]


def count_tokens(
    df: DataFrame,
    tokenizer_path: str,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    limit: int = 2048,
    batch_bytes: int = 1 << 20,
) -> DataFrame:
    """One row per row of `df`: the `keep` columns, `n_bytes` (UTF-8), `n_tokens`, `over_limit`.

    Counts are those of the whole text, without added special tokens, truncation or padding; special
    strings inside a text count as the library's default has them. For encodings that drop white space.
    A null text counts as empty: 0 bytes, 0 tokens. Repeated rows stay, no rows give no rows, null ids
    stay, and columns other than `keep` are not read, whatever their names.

    The texts stay where they were read: no shuffle. Each Arrow batch is encoded in batches of at most
    `batch_bytes`, longer texts in parts.
    """
    named = [F.col(name).alias(f"keep_{i}") for i, name in enumerate(keep)]
    rows = df.select(*named, F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("body"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]

    def lengths(batches):
        counter = piece_lengths(tokenizer_path)
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            parts, owner = [], []
            for i, body in enumerate(texts):
                for part in safe_parts(body, batch_bytes) if len(body) > batch_bytes else (body,):
                    parts.append(part)
                    owner.append(i)
            totals = [0] * len(texts)
            for start, end in by_bytes([len(part) for part in parts], batch_bytes):
                for i, n in zip(owner[start:end], counter.totals(parts[start:end]).tolist()):
                    totals[i] += n
            columns = [batch.column(i) for i in range(len(keep))]
            sizes = pa.array([len(body) for body in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*columns, sizes, pa.array(totals, pa.int64())],
                [*batch.schema.names[:-1], "n_bytes", "n_tokens"],
            )

    counted = rows.mapInArrow(lengths, ", ".join([*fields, "n_bytes long", "n_tokens long"]))
    return counted.select(
        *(F.col(f"keep_{i}").alias(name) for i, name in enumerate(keep)),
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
