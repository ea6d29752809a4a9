"""Quality rules: counts per document and lines that too many documents of a host share."""

from pyspark.sql import Column, DataFrame, functions as F

from scanweave.llm.tables import landed

# White space between words, symbols that count as junk, the base limits.
_GAP = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]+"
_SYMBOL = r"[#*$%&|<>]"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50


def normal_line(line: Column) -> Column:
    """Lower case; white space, digits and ASCII punctuation become single blanks."""
    return F.trim(F.regexp_replace(F.lower(line), r"[\x20\x09-\x0D\d\p{Punct}]+", " "))


def words(text: Column) -> Column:
    return F.filter(F.split(text, _GAP), lambda word: word != "")


def _windows(words_column: str) -> Column:
    """Hash of every three neighbouring words."""
    found = F.col(words_column)
    places = F.sequence(F.lit(0), F.size(found) - 3)
    return F.when(
        F.size(found) >= 3,
        F.transform(places, lambda i: F.xxhash64(F.get(found, i), F.get(found, i + 1), F.get(found, i + 2))),
    ).otherwise(F.array().cast("array<bigint>"))


def _repeat_starts(windows: str) -> Column:
    """Sorted places of the windows that are found twice or more."""
    found = F.sort_array(F.transform(windows, lambda value, i: F.struct(value.alias("value"), i.alias("at"))))
    # One-element array: the sorted windows are worked out once and then looked up.
    return F.flatten(
        F.transform(
            F.array(found),
            lambda sorted_: F.sort_array(
                F.transform(
                    F.filter(
                        sorted_,
                        lambda one, k: one["value"].eqNullSafe(F.get(sorted_, k + 1)["value"])
                        | one["value"].eqNullSafe(F.get(sorted_, k - 1)["value"]),
                    ),
                    lambda one: one["at"],
                )
            ),
        )
    )


def _covered(starts: str) -> Column:
    """Words covered by three-word windows at these sorted places."""
    found = F.col(starts)
    return F.aggregate(
        F.zip_with(
            found,
            F.slice(found, 2, F.greatest(F.size(found), F.lit(1))),
            lambda here, after: F.least(F.lit(3), F.coalesce(after - here, F.lit(3))),
        ),
        F.lit(0).cast("bigint"),
        lambda total, more: total + more,
    )


def document_counts(docs: DataFrame, id_column: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """Counts of each row, and `lines`: hash and words of each line that has a word.

    `text_key` tells texts apart. Texts are split into words once; all else is row-local, so there is
    no shuffle and memory follows the longest text.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), body.alias("body")
    )
    with_word = F.filter(F.split("body", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumns({"words": words(F.col("body")), "with_word": with_word})
    rows = rows.withColumn("windows", _windows("words"))
    rows = rows.withColumn(
        "starts",
        F.when(F.size(F.array_distinct("windows")) < F.size("windows"), _repeat_starts("windows")).otherwise(
            F.array().cast("array<int>")
        ),
    )
    return rows.select(
        "doc_id",
        "host",
        F.md5("body").alias("text_key"),
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("body", F.lit(_SYMBOL)).cast("long").alias("n_symbols"),
        (F.size("with_word") - F.size(F.array_distinct("with_word"))).cast("long").alias("n_dup_lines"),
        _covered("starts").alias("n_repeat_words"),
        F.transform(
            "with_word",
            lambda line: F.struct(
                F.xxhash64(normal_line(line)).alias("line"),
                F.regexp_count(line, F.lit(_WORD)).cast("long").alias("n"),
            ),
        ).alias("lines"),
    )


def frequent_lines(counts: DataFrame, least_documents: int, most_share: float, most_documents: int) -> DataFrame:
    """Lines (`host`, `line`) of more than `least_documents` documents of a host that are also in more than `most_share` of
    its documents, or in more than `most_documents`: a large host does not raise the bar without end.

    Documents are told apart by id, those without one by their text. The distinct counts are taken in two steps, the
    first by line and document, so a line in every document of a large host is counted by many tasks.
    """
    known = counts.withColumn("document", F.coalesce(F.col("doc_id").cast("string"), "text_key"))
    held = known.groupBy("host").agg(F.count_distinct("document").alias("held"))
    spread = (
        known.select("host", "document", F.explode(F.array_distinct(F.col("lines")["line"])).alias("line"))
        .groupBy("host", "line")
        .agg(F.count_distinct("document").alias("documents"))
        .where(F.col("documents") > least_documents)
    )
    bar = F.least(most_share * F.col("held"), F.lit(float(most_documents)))
    return spread.join(held, "host").where(F.col("documents") > bar).select("host", "line")


def line_losses(counts: DataFrame, frequent: DataFrame) -> DataFrame:
    """`n_frequent_words` and `frequent` (line hashes) per text of a host that has frequent lines."""
    lines = counts.select("host", "text_key", F.posexplode("lines").alias("at", "entry"))
    lines = lines.select("host", "text_key", "at", F.col("entry.line").alias("line"), F.col("entry.n").alias("n"))
    once = lines.join(frequent, ["host", "line"]).groupBy("host", "text_key", "at").agg(
        F.max("n").alias("n"), F.max("line").alias("line")
    )
    return once.groupBy("host", "text_key").agg(
        F.sum("n").alias("n_frequent_words"), F.collect_set("line").alias("frequent")
    )


def quality_rules(
    docs: DataFrame,
    least_documents: int = 20,
    most_share: float = 0.05,
    most_documents: int = 1000,
    least_left: float = 0.5,
    id_column: str = "doc_id",
    text: str = "text",
    host: str = "source",
) -> DataFrame:
    """One row per row of `docs`: the base counts, `base_failed`, `kept`, `n_frequent_words`, `host`, `frequent`.

    A document fails the base rules with fewer than 50 words, or if more than half of its words lie in
    three-word windows found twice or more in it (windows are compared by 64-bit hash). Beyond that, lines
    are normalised and hashed, the documents per host that hold a line are counted, lines in more than `least_documents`
    and in more than `most_share` of the host's documents or `most_documents` of them are taken out, and a document
    left with less than `least_left` of its words is rejected.

    A null text is empty and has no words; a null host is the host named by the empty string. Repeated
    rows count as one document, copies under other ids as further ones; all get the same verdict. A row without an id is a
    document by its text. Texts of any length are read whole, in time linear in them but for a sort of their words. No
    rows give no rows; other columns are not read, whatever their names.
    """
    counts = landed(document_counts(docs, id_column, text, host), "quality-counts")
    frequent = landed(frequent_lines(counts, least_documents, most_share, most_documents), "quality-frequent")
    losses = landed(line_losses(counts, frequent), "quality-losses")
    lost = F.coalesce("n_frequent_words", F.lit(0).cast("long"))
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    depleted = F.col("n_words") - lost < least_left * F.col("n_words")
    return counts.drop("lines").join(losses, ["host", "text_key"], "left").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & ~depleted).alias("kept"),
        lost.alias("n_frequent_words"),
        "host",
        F.coalesce("frequent", F.array().cast("array<bigint>")).alias("frequent"),
    )


def without_lines(text: Column, frequent: Column) -> Column:
    """`text` without the lines whose hash is in `frequent` (an output of `quality_rules`)."""
    kept = F.filter(F.split(text, "\n"), lambda line: ~F.array_contains(frequent, F.xxhash64(normal_line(line))))
    return F.array_join(kept, "\n")


#: DuckDB twin of the registered query, with its limits.
ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS body,
        coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) AS document FROM documents),
w AS (SELECT *, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(body, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM d),
texts AS (SELECT DISTINCT body, words FROM w),
win AS (SELECT body, len(words) AS n, unnest(range(1, len(words) - 1)) AS i, words FROM texts),
win3 AS (SELECT body, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c FROM win),
reps AS (SELECT body, i FROM (SELECT body, i, count(*) OVER (PARTITION BY body, a, b, c) AS k FROM win3) WHERE k > 1),
rep AS (SELECT body, count(*) AS n_repeat_words FROM
        (SELECT DISTINCT body, unnest([i, i + 1, i + 2]) AS p FROM reps) GROUP BY body),
l AS (SELECT DISTINCT host, body, unnest(range(1, len(lines) + 1)) AS pos, lines FROM w),
ln AS (SELECT host, body, pos, len(regexp_extract_all(lines[pos], '[^\x20\x09-\x0D]+')) AS n,
         trim(regexp_replace(lower(lines[pos]), '[\x20\x09-\x0D\d[:punct:]]+', ' ', 'g')) AS line FROM l),
hosts AS (SELECT host, count(DISTINCT document) AS held FROM d GROUP BY host),
has AS (SELECT DISTINCT host, body, line FROM ln),
freq AS (SELECT host, line FROM (SELECT host, line, count(DISTINCT document) AS k FROM has JOIN d USING (host, body) GROUP BY host, line)
         JOIN hosts USING (host) WHERE k > 20 AND (k > 0.05 * held OR k > 1000)),
lost AS (SELECT host, body, sum(n)::BIGINT AS lost FROM ln JOIN freq USING (host, line) GROUP BY host, body),
f AS (SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(length(array_to_string(words, '')), 0)::BIGINT AS word_chars,
        len(regexp_extract_all(body, '[#*$%&|<>]'))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(lost, 0)::BIGINT AS n_frequent_words
      FROM w LEFT JOIN rep USING (body) LEFT JOIN lost USING (host, body))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  (NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT (n_words - n_frequent_words < 0.5 * n_words)) AS kept,
  n_frequent_words
FROM f
"""
