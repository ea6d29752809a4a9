"""Words, how often they occur, and the more frequent spelling each is a variant of."""

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from scanweave.llm.tables import landed

# Runs of these characters are words of at least so many, and one in DAMAGED runs loses a character.
_RUN = re.compile("[A-Za-zÀ-ÿ]{5,}")
LEAST_CHARACTERS, DAMAGED = 5, 97


def _counted(batches, most: int = 300_000):
    """(word, n) of the documents of a task; a word comes again whenever `most` different ones were held."""
    found: Counter = Counter()
    for batch in batches:
        for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            start = zlib.crc32(f"{name}:".encode())
            for run, n in Counter(_RUN.findall(body.lower().decode("utf-8", "replace"))).items():
                check = zlib.crc32(run.encode(), start)
                if check % DAMAGED == 0:
                    at = check % len(run)
                    run = run[:at] + run[at + 1 :]
                    if len(run) < LEAST_CHARACTERS:
                        continue
                found[run] += n
            if len(found) >= most:
                yield _rows(found)
                found = Counter()
    yield _rows(found)


def _rows(found: Counter) -> pa.RecordBatch:
    columns = [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["word", "n"])


def word_counts(docs: DataFrame, least: int = 3, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """`word` and `n`, its occurrences in all texts, of words of five characters that occur `least` times.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF with A-Z lower-cased. Of a run whose CRC-32 behind its
    document's id (of a null id: nothing) and a colon is divisible by 97, one character is taken out. A null text has no
    words; repeated rows count again; no rows give no rows; other columns are not read. Tasks count their
    documents and send each different word once (or once per 300,000 words), so a frequent word is no hot key.
    """
    # Lower-casing the bytes touches A-Z alone.
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")), body)
    return rows.mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _pieces(length: Column) -> list[tuple[Column, Column]]:
    """Places (from 0, end exclusive) of the two halves of each of the two chunks of a word."""
    middle = F.floor(length / 2).cast("int")
    edges = [
        F.lit(0),
        F.floor(middle / 2).cast("int"),
        middle,
        middle + F.floor((length - middle) / 2).cast("int"),
        length,
    ]
    return list(zip(edges, edges[1:]))


def _grams(word: Column, size: Column, longer: int) -> list[Column]:
    """For each piece of a word `longer` characters shorter: what this word holds around it (`gram`) and in it (`hole`)."""
    length = size - longer
    return [
        F.struct(
            length.alias("length"),
            F.lit(i).alias("piece"),
            F.concat(word.substr(F.lit(1), start), word.substr(end + (longer + 1), size)).alias("gram"),
            word.substr(start + 1, end - start + longer).alias("hole"),
        )
        for i, (start, end) in enumerate(_pieces(length))
    ]


def near_pairs(words: DataFrame) -> DataFrame:
    """(`one`, `one_n`, `other`, `other_n`): all pairs of words an inserted, deleted or replaced character apart, once each.

    `words` holds different words and their `n`. Of a pair the shorter word (of equally long ones the smaller)
    contributes two disjoint chunks, the other the positional grams of their lengths. One edit leaves a chunk
    whole: the first in place if the edit lies behind it, else the second, moved by the difference of lengths, so grams at
    other places are not written. As many words share a chunk, the other chunk is halved in the same way: one half is whole
    as well, and words meet where chunk and half both agree, that is in all but the quarter that holds the edit. What
    is left, two strings of a few characters, is compared within the join, so only true pairs leave it.

    An inserted character beside the border of two quarters is found in both; the first of them counts.
    """
    size = F.length("word").cast("int")
    sized = words.select("word", "n", size.alias("size"))
    word, size = F.col("word"), F.col("size")
    at = F.explode(F.array(*_grams(word, size, 0))).alias("at")
    short = sized.select(word.alias("one"), F.col("n").alias("one_n"), at)
    short = short.select("one", "one_n", "at.length", "at.piece", "at.gram", F.col("at.hole").alias("own"))
    at = F.explode(F.array(*_grams(word, size, 0), *_grams(word, size, 1))).alias("at")
    long = sized.select(word.alias("other"), F.col("n").alias("other_n"), size.alias("other_size"), at)
    long = long.select("other", "other_n", "other_size", "at.length", "at.piece", "at.gram", "at.hole")

    longer = F.col("other_size") > F.col("length")
    earlier = longer & (F.col("piece") > 0) & F.col("hole").endswith(F.col("own"))
    edited = F.levenshtein("own", "hole", 1) == 1
    # Spark takes exploded rows for as small as the words were, and would broadcast them.
    pairs = short.hint("merge").join(long.hint("merge"), ["length", "piece", "gram"])
    return pairs.where((longer | (F.col("one") < F.col("other"))) & edited & ~earlier).select("one", "one_n", "other", "other_n")


def roots(forms: DataFrame) -> DataFrame:
    """`word` and the `root` its `form`s lead to, of words that have a form.

    Every form is at least twice as frequent as its word, so paths end and are at most 63 long. Each round doubles
    the step of all words at once; there are as many as the longest path has binary digits.
    """
    steps = landed(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = landed(steps.join(ahead.hint("merge"), "root", "left"), "spelling-roots")
        if joined.where("further is not null").isEmpty():
            return steps
        steps = joined.select("word", F.coalesce("further", "root").alias("root"))


def variants(counts: DataFrame) -> DataFrame:
    """`word`, `form`, `root`, `n`, `n_near`, `form_n` of every row of `counts` (different words, their `n`).

    Words are near if one inserted, deleted or replaced character leads from one to the other. `form` is the near word with
    the largest `n` (of equals the smallest in code-point order) if that is at least twice the word's own, else null, as is
    `form_n` then; `root` is where following forms ends, the word itself if it has none; `n_near` counts near words.
    No rows give no rows.
    """
    words = landed(counts.select("word", "n"), "spelling-words")
    pairs = near_pairs(words)
    both = pairs.select(F.col("one").alias("word"), F.col("other").alias("near"), F.col("other_n").alias("near_n")).union(
        pairs.select("other", "one", "one_n")
    )
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    around = both.groupBy("word").agg(F.count("*").alias("n_near"), best)
    known = words.join(around, "word", "left").withColumn("near_n", -F.col("best.less"))
    follows = F.col("near_n") >= 2 * F.col("n")
    known = landed(
        known.select(
            "word",
            F.when(follows, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(follows, F.col("near_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    ends = roots(known.where("form is not null"))
    return known.join(ends.hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
