"""Benchmark decontamination: SimHash over item-sized windows, block index, exact check."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from scanweave.llm.tables import landed

_BITS = 64
_BLOCK_BITS = 8


def shingle_hashes(words: Column, size: int = 5) -> Column:
    """Hash of every `size` neighbouring words; none for fewer words."""
    count = F.size(words) - (size - 1)
    hashes = F.transform(
        F.sequence(F.lit(0), count - 1), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(size)))
    )
    return F.when(count > 0, hashes).otherwise(F.array().cast("array<bigint>"))


def plain_words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda word: word != "")


def _exploded_shingles(texts: DataFrame, size: int) -> DataFrame:
    """`text_key`, `size` (number of its shingles), `at`, `hash` of all shingles of all texts, as one pipeline of generated code.

    The same places and hashes as `shingle_hashes` of `plain_words`: a split text can only be empty at its
    two ends, so shingles with an empty word are dropped and places count from the first word.
    """
    split = texts.select("text_key", F.split(F.lower("body"), r"[^\p{L}\p{N}]+").alias("words"))
    places = F.when(F.size("words") >= size, F.sequence(F.lit(0), F.size("words") - size))
    placed = split.select("text_key", "words", F.explode(places).alias("place"))
    parts = [F.get("words", F.col("place") + k) for k in range(size)]
    empty = (F.get("words", F.lit(0)) == "").cast("int") + (F.element_at("words", -1) == "").cast("int")
    return placed.where((parts[0] != "") & (parts[-1] != "")).select(
        "text_key",
        (F.size("words") - empty - (size - 1)).alias("size"),
        (F.col("place") - (F.get("words", F.lit(0)) == "").cast("int")).alias("at"),
        F.xxhash64(*parts).alias("hash"),
    )


def _given(value: Column, body) -> Column:
    """`body` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def simhash(hashes: Column) -> Column:
    """64 bits, each set if it is set in more than half of the hashes, repeats counted."""

    def fingerprint(hashes):
        ones = F.transform(
            F.sequence(F.lit(0), F.lit(_BITS - 1)),
            lambda bit: F.aggregate(
                hashes, F.lit(0), lambda total, h: total + F.getbit(h, bit).cast("int")
            ),
        )
        return F.aggregate(
            F.transform(ones, lambda n, bit: F.when(2 * n > F.size(hashes), _shifted(bit)).otherwise(F.lit(0).cast("long"))),
            F.lit(0).cast("long"),
            lambda out, part: out.bitwiseOR(part),
        )

    return _given(hashes, fingerprint)


def weighted_features(hashes: Column) -> Column:
    """A multiset of hashes as different features: the first occurrence of a hash is itself, further ones are hashed with
    their number. Features that two multisets do not share then flip bits independently, also where a refrain differs."""

    def numbered(ordered):
        def feature(h, i):
            number = i + 2 - F.array_position(ordered, h)
            return F.when(number == 1, h).otherwise(F.xxhash64(h, number))

        return F.transform(ordered, feature)

    repeated = _given(F.array_sort(hashes), numbered)
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), hashes).otherwise(repeated)


def _shifted(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), bit)


def _block(fingerprint: Column, i: int) -> Column:
    return F.shiftrightunsigned(fingerprint, _BLOCK_BITS * i).bitwiseAND(F.lit((1 << _BLOCK_BITS) - 1))


def _near_blocks(fingerprint: Column, flips: int) -> Column:
    """(block, value) of every block, and every value within `flips` bits of it."""
    masks = [m for m in range(1 << _BLOCK_BITS) if m.bit_count() <= flips]
    return F.flatten(
        F.array(
            *(
                F.array(*(_entry(i, _block(fingerprint, i).bitwiseXOR(F.lit(mask))) for mask in masks))
                for i in range(_BITS // _BLOCK_BITS)
            )
        )
    )


def _entry(i: int, value: Column) -> Column:
    return F.struct(F.lit(i).alias("block"), value.cast("int").alias("value"))


def item_shingles(benchmark: DataFrame, words: int = 5, id_column: str = "item_id", text: str = "text") -> DataFrame:
    """Written table of `item_id`, `n` (number of shingles), `hashes`, `fingerprint`; items without shingles left out."""
    body = plain_words(F.coalesce(F.col(text).cast("string"), F.lit("")))
    rows = benchmark.select(F.col(id_column).alias("item_id"), body.alias("words"))
    rows = rows.select("item_id", shingle_hashes(F.col("words"), words).alias("hashes")).where(F.size("hashes") > 0)
    return landed(
        rows.select("item_id", F.size("hashes").alias("n"), "hashes", simhash(weighted_features(F.col("hashes"))).alias("fingerprint")),
        "leak-items",
    )


def rare_shingles(items: DataFrame, similarity: float) -> DataFrame:
    """(`item_id`, `n`, `hash`): of every item its rarest shingles, so many that no window without any of them can be
    that similar.

    A window of similarity s shares s * n of an item's n shingles at least, repeats counted (of a text shorter than the
    item too), so it holds one of any shingles that make up more than the rest. Rare is what few items of that size hold.
    """
    held = items.select("item_id", "n", F.explode("hashes").alias("hash")).groupBy("item_id", "n", "hash")
    held = held.agg(F.count("*").alias("times"))
    shared = held.groupBy("n", "hash").agg(F.count("*").alias("items"))
    by_rarity = Window.partitionBy("item_id").orderBy("items", "hash")
    before = F.sum("times").over(by_rarity.rowsBetween(Window.unboundedPreceding, -1))
    ranked = held.join(shared, ["n", "hash"]).withColumn("before", F.coalesce(before, F.lit(0)))
    return ranked.where(F.col("before") <= F.col("n") - F.ceil(similarity * F.col("n") - 1e-9)).select("item_id", "n", "hash")


def _short_leaks(texts: DataFrame, benchmark: DataFrame, words: int) -> DataFrame:
    """Items of fewer than `words` words, found as their whole word sequence: the first place in every text."""
    body = plain_words(F.coalesce(F.col("text").cast("string"), F.lit("")))
    items = benchmark.select(F.col("item_id"), body.alias("words"))
    items = landed(items.where(F.size("words").between(1, words - 1)), "leak-short-items")
    found = None
    # At most `words` - 1 lengths.
    for row in items.select(F.size("words").alias("k")).distinct().collect():
        known = items.where(F.size("words") == row.k).select("item_id", shingle_hashes(F.col("words"), row.k)[0].alias("hash"))
        places = _exploded_shingles(texts, row.k).join(known, "hash").groupBy("text_key", "item_id")
        places = places.agg(F.min("at").alias("start")).select(
            "text_key", "item_id", "start", F.lit(row.k).alias("n_words"), F.lit(1.0).alias("similarity")
        )
        found = places if found is None else found.union(places)
    return found


def _near_items(windows: DataFrame, items: DataFrame, similarity: float, radius: int) -> DataFrame:
    """(`text_key`, `n`, `start`, `item_id`): windows and items that share a rare shingle, within `radius` bits."""
    window = ["text_key", "n", "start"]
    rare = landed(rare_shingles(items, similarity), "leak-rare")
    held = windows.select(*window, "fingerprint", F.explode(F.array_distinct("hashes")).alias("hash"))
    pairs = held.join(rare, ["n", "hash"]).select(*window, "fingerprint", "item_id").distinct()
    blocks = _BITS // _BLOCK_BITS
    index = items.select("item_id", F.col("fingerprint").alias("item_print"), F.explode(_near_blocks(F.col("fingerprint"), radius // blocks)).alias("e"))
    index = index.select("item_id", "item_print", "e.block", "e.value")
    probes = pairs.select(*window, "item_id", "fingerprint", F.explode(_near_blocks(F.col("fingerprint"), 0)).alias("e"))
    probes = probes.select(*window, "item_id", "fingerprint", "e.block", "e.value")
    return (
        probes.join(index, ["item_id", "block", "value"])
        .where(F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_print"))) <= radius)
        .select(*window, "item_id")
        .distinct()
    )


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    similarity: float = 0.8,
    words: int = 5,
    radius: int = 23,
    text: str = "text",
) -> DataFrame:
    """`text_key` (MD5 of a text), `item_id`, `start`, `n_words`, `similarity`: windows of texts that repeat an item.

    A window has as many words as the item (lower-case runs of letters and digits); a text with fewer words than
    the item is one window of its whole length. A similarity s over the
    multisets of `words`-word shingles needs 2s / (1 + s) of the window's shingles to be shingles of items
    of that size (of a shorter text, s / (1 + s) of both lengths), so windows with fewer are dropped unseen. The others get a
    SimHash fingerprint of their shingles and occurrence numbers, and meet the items of their size with which they share
    one of the item's rarest shingles, without which that similarity is out of reach. An index of eight 8-bit
    blocks finds every such pair within `radius` bits; the exact weighted similarity of the shingles decides. Of
    each text and item the best window is kept, the first if several tie.

    Items with fewer than `words` words are found as their whole word sequence. Copies of a text are one text
    here. Null and empty texts and items match nothing.
    """
    items = item_shingles(benchmark, words)
    known = landed(items.select("n", F.explode("hashes").alias("hash")).distinct(), "leak-shingles")

    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    texts = docs.select(F.md5(body).alias("text_key"), body.alias("body"))
    share = 2 * similarity / (1 + similarity)
    hits = _exploded_shingles(texts, words).join(known, "hash").groupBy("text_key", "n")
    hits = hits.agg(F.sort_array(F.collect_set("at")).alias("places"), F.max("size").alias("size"))
    short = F.col("size") < F.col("n")
    of_both = similarity / (1 + similarity) * (F.col("n") + F.col("size"))
    least = F.ceil(F.when(short, of_both).otherwise(share * F.col("n")) - 1e-9).cast("int")
    hits = hits.withColumn("least", least).where(F.size("places") >= F.col("least"))

    # All starts of windows that hold enough known shingles: from the last one that still reaches the
    # `least`-th known shingle up to the first known one, for every run of that many.
    runs = F.transform(
        F.sequence(F.lit(0), F.size("places") - F.col("least")),
        lambda i: F.struct(
            F.greatest(F.lit(0), F.get("places", i + F.col("least") - 1) - F.col("n") + 1).alias("low"),
            F.get("places", i).alias("high"),
        ),
    )
    runs = F.filter(runs, lambda r: r["low"] <= r["high"])
    starts = F.array_distinct(F.flatten(F.transform(runs, lambda r: F.sequence(r["low"], r["high"]))))
    starts = F.when(short, F.array(F.lit(0))).otherwise(starts)
    windows = hits.select("text_key", "n", F.explode(starts).alias("start"))
    windows = landed(windows, "leak-windows")
    keys = landed(windows.select("text_key").distinct(), "leak-keys")
    again = texts.join(keys, "text_key", "left_semi").groupBy("text_key").agg(F.first("body").alias("body"))
    again = again.withColumn("words", plain_words(F.col("body"))).select(
        "text_key", shingle_hashes(F.col("words"), words).alias("all")
    )
    windows = windows.join(again, "text_key").where(
        (F.col("start") + F.col("n") <= F.size("all")) | ((F.size("all") < F.col("n")) & (F.col("start") == 0))
    )
    windows = windows.select("text_key", "n", "start", F.slice("all", F.col("start") + 1, F.col("n")).alias("hashes"))
    windows = landed(windows.withColumn("fingerprint", simhash(weighted_features(F.col("hashes")))), "leak-prints")

    near = _near_items(windows, items, similarity, radius)
    counted = (
        near.join(windows.select("text_key", "n", "start", "hashes"), ["text_key", "n", "start"])
        .select("text_key", "n", "start", "item_id", F.size("hashes").alias("size"), F.explode("hashes").alias("hash"))
        .groupBy("text_key", "n", "start", "item_id", "size", "hash")
        .agg(F.count("*").alias("times"))
    )
    weights = items.select("item_id", F.explode("hashes").alias("hash")).groupBy("item_id", "hash").agg(
        F.count("*").alias("item_times")
    )
    shared = (
        counted.join(weights, ["item_id", "hash"])
        .groupBy("text_key", "n", "start", "item_id", "size")
        .agg(F.sum(F.least("times", "item_times")).alias("shared"))
        .withColumn("similarity", F.col("shared") / (F.col("n") + F.col("size") - F.col("shared")))
        .where(F.col("similarity") >= similarity - 1e-9)
    )
    best = F.max_by(F.struct("start", "size", "similarity"), F.struct("similarity", -F.col("start")))
    found = shared.groupBy("text_key", "item_id").agg(best.alias("best")).select(
        "text_key",
        "item_id",
        "best.start",
        (F.col("best.size") + (words - 1)).alias("n_words"),
        "best.similarity",
    )
    short_items = _short_leaks(texts, benchmark, words)
    return found if short_items is None else found.union(short_items)


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """One row per row of `docs`: `row`, a struct of all its columns, and `leaks`, an array of
    (item_id, start, n_words, similarity), empty for clean documents.

    Repeated rows stay and get the same leaks; null and empty texts are clean; an empty benchmark leaves
    all documents clean; columns may have any names.
    """
    found = landed(leaks(docs, benchmark, text=text, **options), "leaks")
    lists = found.groupBy("text_key").agg(
        F.array_sort(F.collect_list(F.struct("item_id", "start", "n_words", "similarity"))).alias("leaks")
    )
    lists = landed(lists, "leak-lists")
    rows = docs.select(F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"))
    rows = rows.withColumn("text_key", F.md5(F.coalesce(F.col("row").getField(text).cast("string"), F.lit(""))))
    none = F.array().cast(lists.schema["leaks"].dataType)
    return rows.join(lists, "text_key", "left").select("row", F.coalesce("leaks", none).alias("leaks"))


#: DuckDB twin of the registered query: all windows of texts that hold enough shingles of an item, without fingerprints.
ORACLE = r"""
WITH words_of AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark),
ig AS (SELECT item_id, len(w) - 4 AS n, unnest(range(1, len(w) - 3)) AS i, w FROM words_of WHERE len(w) >= 5),
iw AS (SELECT item_id, n, list_slice(w, i, i + 4) AS g, count(*) AS times FROM ig GROUP BY ALL),
t AS (SELECT DISTINCT coalesce(text, '') AS body FROM documents),
tw AS (SELECT body, regexp_extract_all(lower(body), '[\p{L}\p{N}]+') AS w FROM t),
tg AS (SELECT body, unnest(range(1, len(w) - 3)) AS p, w FROM tw WHERE len(w) >= 5),
ts AS (SELECT body, p, list_slice(w, p, p + 4) AS g FROM tg),
len_of AS (SELECT body, max(p) AS last FROM ts GROUP BY body),
hit AS (SELECT body, p, item_id, n, last FROM ts JOIN iw USING (g) JOIN len_of USING (body)),
near AS (SELECT body, item_id, n, last, least(n, last) AS size, min(p) AS low, max(p) AS high FROM hit
         GROUP BY ALL HAVING count(*) >= 0.8 / 1.8 * (n + least(n, last)) - 1e-9),
win AS (SELECT body, item_id, n, size, unnest(range(greatest(1, low - size + 1), least(high, last - size + 1) + 1)) AS a FROM near),
cnt AS (SELECT win.body, win.item_id, win.n, size, a, ts.g, count(*) AS seen
        FROM win JOIN ts ON ts.body = win.body AND ts.p BETWEEN a AND a + size - 1 GROUP BY ALL),
sim AS (SELECT body, cnt.item_id, cnt.n, size, a, sum(least(seen, times)) AS shared
        FROM cnt JOIN iw ON iw.item_id = cnt.item_id AND iw.g = cnt.g GROUP BY ALL),
short_items AS (SELECT item_id, w, len(w) AS k FROM words_of WHERE len(w) BETWEEN 1 AND 4),
short_runs AS (SELECT DISTINCT body, k, list_slice(w, p, p + k - 1) AS w FROM (
    SELECT body, k, w, unnest(range(1, len(w) - k + 2)) AS p FROM tw, (SELECT DISTINCT k FROM short_items))),
best AS (SELECT body, item_id, max(shared / (1.0 * n + size - shared)) AS similarity FROM sim GROUP BY ALL
         HAVING max(shared / (1.0 * n + size - shared)) >= 0.8 - 1e-9
         UNION ALL SELECT body, item_id, 1.0 FROM short_runs JOIN short_items USING (k, w)),
l AS (SELECT body, count(*) AS k, string_agg(item_id, ',' ORDER BY item_id) AS items, max(similarity) AS top FROM best GROUP BY body)
SELECT doc_id, k IS NOT NULL AS contaminated, coalesce(k, 0)::BIGINT AS n_items, coalesce(items, '') AS items,
  round(top, 6) AS best_similarity
FROM documents LEFT JOIN l ON l.body = coalesce(text, '')
"""
