"""Secrets in texts: fixed patterns, and windows of high entropy in candidate strings."""

import math

from pyspark.sql import Column, DataFrame, functions as F

# The base patterns and their least lengths.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
LEAST_VALUE, LEAST_ACCESS = 8, 16
KINDS = ("assign", "access", "hex", "entropy")

# Candidate strings: runs of 20 or more of these characters with a digit among them.
CANDIDATE = r"(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{20,}"
# The runs alone: looking ahead for a digit from every place of a long run would cost its square.
_RUN = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
# Least bits per character of a window, by the narrowest class that holds the whole string.
LEAST_BITS = {"hex": 2.9, "alphanumeric": 3.6, "encoded": 3.6}
# Strings that look random and are not secret.
ALLOWED = (
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",  # UUID
    r".*(?:[Ee][Xx][Aa][Mm][Pp][Ll][Ee]|0123456789|abcdefgh|ABCDEFGH|[xX]{6}).*",  # samples
    r"(?:[0-9]+[-_/=+]?)+",  # numbers, dates
    r"[0-9]*[a-z]+[0-9]*(?:[-_/][0-9]*[a-z]*[0-9]*)*",  # lower-case names and paths with numbers at their ends
)
# Text right before a string that marks it as a public checksum.
ALLOWED_BEFORE = r"(?:sha1|sha256|sha384|sha512|md5|crc32|integrity)[-:=]$"

_SCALE = 1_000_000
# Elements of an array that are summed up one by one; longer arrays are summed block by block.
_BLOCK = 128


def _weight(count: int) -> int:
    """count * log2(count) in millionths, so that adding and taking away is exact."""
    return round(_SCALE * count * math.log2(count)) if count else 0


def most_weights() -> dict[str, int]:
    """Largest sum of weights a window of each class may have and still reach its least bits."""
    return {
        kind: math.floor(_SCALE * WINDOW * (math.log2(WINDOW) - bits)) for kind, bits in LEAST_BITS.items()
    }


_SPAN = "array<struct<start:int,stop:int,value:string,extra:string,before:string>>"


def _given(value: Column, body) -> Column:
    """`body` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(values: Column, combine) -> Column:
    """`combine` of each element with all before it, in linear time.

    Appending to an array copies it, so only blocks grow element by element, and then the results of whole blocks.
    """

    def one_by_one(array):
        start = F.array().cast("array<bigint>")
        return F.aggregate(
            array,
            start,
            lambda out, x: F.concat(
                out, F.array(F.when(F.size(out) == 0, x).otherwise(combine(F.try_element_at(out, F.lit(-1)), x)))
            ),
        )

    def whole(array):
        last = F.floor((F.size(array) - 1) / _BLOCK).cast("int")
        blocks = F.transform(
            F.sequence(F.lit(0), last), lambda b: one_by_one(F.slice(array, b * _BLOCK + 1, F.lit(_BLOCK)))
        )
        return F.when(F.size(array) > 0, _given(blocks, joined)).otherwise(array)

    def joined(blocks):
        ends = one_by_one(F.transform(blocks, lambda block: F.element_at(block, -1)))

        def continued(ends):
            def after(block, b):
                return F.when(b == 0, block).otherwise(
                    F.transform(block, lambda x: combine(F.get(ends, b - 1), x))
                )

            return F.flatten(F.transform(blocks, after))

        return _given(ends, continued)

    return _given(values.cast("array<bigint>"), whole)


def _found(text: Column, pattern: str, group: int) -> Column:
    """Matches with code-point places; `extra` is a group of the match, `before` the ten characters in front of it."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.split(text, pattern, -1)
    entries = F.zip_with(
        F.slice(gaps, F.lit(1), F.size(gaps) - 1),
        F.arrays_zip(whole.alias("value"), part.alias("extra")),
        lambda gap, match: F.struct(
            F.length(gap).alias("gap"),
            F.right(gap, F.lit(10)).alias("near"),
            F.length(match["value"]).alias("size"),
            match["value"].alias("value"),
            match["extra"].alias("extra"),
        ),
    )

    def placed(found):
        def spans(stops):
            def one(match, k):
                earlier = F.when(k > 0, F.right(F.get(found, k - 1)["value"], F.lit(10))).otherwise("")
                return F.struct(
                    (F.get(stops, k) - match["size"]).cast("int").alias("start"),
                    F.get(stops, k).cast("int").alias("stop"),
                    match["value"].alias("value"),
                    match["extra"].alias("extra"),
                    F.right(F.concat(earlier, match["near"]), F.lit(10)).alias("before"),
                )

            return F.transform(found, one)

        steps = F.transform(found, lambda match: match["gap"] + match["size"])
        return _given(_running(steps, lambda a, b: a + b), spans)

    return _given(entries, placed)


def _none() -> Column:
    return F.array().cast(_SPAN)


def hot_windows(value: Column) -> Column:
    """Starts of the windows of a candidate string whose entropy reaches the least bits of its class.

    The character that enters a window and the one that leaves it change two counts and the sum of their weights; these
    changes are added up along the string.
    """
    # One more than a window holds: a character enters before another leaves.
    weights = F.array(*(F.lit(_weight(c)).cast("long") for c in range(WINDOW + 2)))
    limits = most_weights()
    most = (
        F.when(value.rlike("^[0-9a-fA-F]+$"), F.lit(limits["hex"]))
        .when(value.rlike("^[0-9A-Za-z]+$"), F.lit(limits["alphanumeric"]))
        .otherwise(F.lit(limits["encoded"]))
        .cast("long")
    )

    def held(window, letter):
        return F.length(window) - F.length(F.replace(window, letter, F.lit("")))

    def changes(letters):
        # Places of a byte array are reached at once; candidates are ASCII.
        def at(i):
            return F.substring(letters, i + 1, F.lit(1)).cast("string")

        def change(i):
            window = F.substring(letters, F.greatest(i - WINDOW, F.lit(0)) + 1, F.least(i, F.lit(WINDOW))).cast("string")
            return _given(F.struct(window.alias("window"), at(i).alias("new")), lambda seen: moved(seen, i))

        def moved(seen, i):
            new = held(seen["window"], seen["new"])
            entered = F.get(weights, new + 1) - F.get(weights, new)

            def left(old):
                count = held(seen["window"], old) + (old == seen["new"]).cast("int")
                return F.get(weights, count - 1) - F.get(weights, count)

            return entered + F.when(i >= WINDOW, _given(at(i - WINDOW), left)).otherwise(F.lit(0).cast("long"))

        return F.transform(F.sequence(F.lit(0), F.length(letters) - 1), change)

    def low(found):
        windows = F.sequence(F.lit(0), F.size(found["weights"]) - WINDOW)
        return F.filter(windows, lambda i: F.get(found["weights"], i + (WINDOW - 1)) <= found["most"])

    running = _running(_given(value.cast("binary"), changes), lambda a, b: a + b)
    return _given(F.struct(running.alias("weights"), most.alias("most")), low)


def allowed(value: Column) -> Column:
    """Whether one of the rules of ALLOWED covers the whole string; no rule looks twice at a stretch of it."""
    numbers = value.rlike("^[0-9]") & ~value.rlike("[^0-9/_=+-]") & ~value.rlike("[/_=+-]{2}")
    names = value.rlike("^[0-9]*[a-z][a-z0-9/_-]*$") & ~value.rlike("[a-z][0-9]+[a-z]")
    return value.rlike(f"^(?:{ALLOWED[0]})$") | value.rlike(ALLOWED[1].removeprefix(".*").removesuffix(".*")) | numbers | names


def _entropy_spans(text: Column) -> Column:
    """Stretches of hot windows in candidate strings that no allow rule covers."""

    def open_to_scan(span):
        both = span["value"].rlike("[0-9]") & span["value"].rlike("[A-Za-z]")
        return both & ~allowed(span["value"]) & ~span["before"].rlike(ALLOWED_BEFORE)

    def stretches(span):
        def merged(hot):
            first = F.filter(hot, lambda at, k: (k == 0) | (at > F.get(hot, k - 1) + WINDOW))
            last = F.filter(hot, lambda at, k: (k == F.size(hot) - 1) | (F.get(hot, k + 1) > at + WINDOW))
            return F.zip_with(first, last, lambda a, b: _span(span["start"] + a, span["start"] + b + WINDOW))

        return _given(hot_windows(span["value"]), merged)

    return F.flatten(F.transform(F.filter(_found(text, _RUN, 0), open_to_scan), stretches))


def _not_within(spans: Column, base: Column) -> Column:
    """The spans that no base span covers. Sorted together, a span is covered if one that starts no later ends no earlier."""
    marked = [
        F.transform(array, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["stop"].alias("stop")))
        for rank, array in ((0, base), (1, spans))
    ]

    def open_ones(both):
        reach = F.transform(both, lambda s: F.when(s["rank"] == 0, s["stop"]).otherwise(-1))

        def kept(reach):
            return F.filter(both, lambda s, k: (s["rank"] == 1) & (F.get(reach, k) < s["stop"]))

        return F.transform(_given(_running(reach, F.greatest), kept), lambda s: _span(s["start"], s["stop"]))

    return _given(F.array_sort(F.concat(*marked)), open_ones)


def _span(start: Column, stop: Column) -> Column:
    return F.struct(
        start.cast("int").alias("start"),
        stop.cast("int").alias("stop"),
        F.lit(None).cast("string").alias("value"),
        F.lit(None).cast("string").alias("extra"),
        F.lit(None).cast("string").alias("before"),
    )


def _named(spans: list[tuple[str, Column]]) -> Column:
    """All spans by start and kind: structs of start, rank, stop, kind."""
    def tagged(kind):
        return lambda s: F.struct(
            s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), s["stop"].alias("stop"), F.lit(kind).alias("kind")
        )

    parts = [F.transform(column, tagged(kind)) for kind, column in spans]
    return F.array_sort(F.concat(*parts))


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def find_secrets(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: `doc_id`, `text`, and `secrets`, an array of (start, rank, stop, kind).

    Places are code points, the end exclusive. Kinds `assign`, `access` and `hex` are the base patterns, leftmost
    and without overlap per kind; matches that are too short are dropped but still use up their text.
    `entropy` adds stretches of candidate strings whose 20-character windows reach the least bits of
    their character class, unless an allow rule covers the string or a base span covers the stretch.

    A null text is empty and has none. Repeated rows stay, null ids stay, no rows give none, other columns
    are not read. All is row-local built-in functions; texts without any hint skip the exact steps. Every step is linear
    in the text but for sorting its spans, whatever the length of a candidate and the number of matches.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_column).alias("doc_id"), body.alias("text"))
    col = F.col("text")
    assign = F.filter(_found(col, ASSIGN, 2), lambda s: F.length(s["extra"]) >= LEAST_VALUE)
    access = F.filter(_found(col, ACCESS, 0), lambda s: F.length(s["value"]) >= LEAST_ACCESS)
    rows = rows.withColumns(
        {
            "assign": F.when((col.contains("=") | col.contains(":")) & col.rlike(ASSIGN), assign).otherwise(_none()),
            "access": F.when(col.contains("AKIA"), access).otherwise(_none()),
            "hex": F.when(col.rlike(HEX), _found(col, HEX, 0)).otherwise(_none()),
            "dense": F.when(col.rlike(_RUN), _entropy_spans(col)).otherwise(_none()),
        }
    )
    base = F.concat("assign", "access", "hex")
    rows = rows.withColumn("entropy", F.when(F.size("dense") > 0, _not_within(F.col("dense"), base)).otherwise(_none()))
    return rows.select(
        "doc_id", "text", _named([(kind, F.col(kind)) for kind in KINDS]).alias("secrets")
    )


def secret_digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, SHA-256 of the written base spans, and all spans written out."""
    rows = found.withColumn("base", F.filter("secrets", lambda s: s["kind"] != "entropy"))

    def count(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.select(
        "doc_id",
        *(count(kind) for kind in KINDS),
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.col("secrets")).alias("spans"),
    )


def masked(text: Column, secrets: Column, mark: str = "*") -> Column:
    """`text` with every character of a secret (spans by start, as found) replaced by `mark`."""

    def written(of):
        # `hidden` reaches as far as the spans up to each one do; a span may lie within an earlier one.
        def cut(k):
            return F.when(k > 0, F.get(of["hidden"], k - 1)).otherwise(0).cast("int")

        def piece(s, k):
            clear = F.greatest(s["start"] - cut(k), F.lit(0))
            stars = F.greatest(F.get(of["hidden"], k).cast("int") - F.greatest(s["start"], cut(k)), F.lit(0))
            return F.concat(F.array_join(F.slice(of["letters"], cut(k) + 1, clear), ""), F.repeat(F.lit(mark), stars))

        rest = F.slice(of["letters"], cut(F.size(secrets)) + 1, F.size(of["letters"]))
        return F.concat(F.array_join(F.transform(secrets, piece), ""), F.array_join(rest, ""))

    hidden = _running(F.transform(secrets, lambda s: s["stop"]), F.greatest)
    return _given(F.struct(hidden.alias("hidden"), F.split(text, "").alias("letters")), written)


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql_found(kind: str, rank: int, pattern: str, keep: str) -> str:
    p = _sql(pattern.replace(r"\x20"," "))
    return f"""
x{rank} AS (SELECT doc_id, string_split_regex(body, {p}) AS gaps, regexp_extract_all(body, {p}) AS found,
    regexp_extract_all(body, {p}, {2 if kind == 'assign' else 0}) AS part FROM d WHERE regexp_matches(body, {p})),
y{rank} AS (SELECT doc_id, unnest(range(1, len(found) + 1)) AS k, gaps, found, part FROM x{rank}),
z{rank} AS (SELECT doc_id, list_sum(list_transform(gaps[1:k], lambda g: length(g)))::BIGINT
      + coalesce(list_sum(list_transform(found[1:k-1], lambda g: length(g))), 0)::BIGINT AS start, found[k] AS value, part[k] AS part FROM y{rank}),
s{rank} AS (SELECT doc_id, start, {rank} AS rank, start + length(value) AS stop, '{kind}' AS kind, value FROM z{rank} WHERE {keep})"""


def _oracle() -> str:
    open_ = " AND ".join(f"NOT regexp_full_match(value, {_sql(rule)})" for rule in ALLOWED)
    parts = [
        _sql_found("assign", 0, ASSIGN, f"length(part) >= {LEAST_VALUE}"),
        _sql_found("access", 1, ACCESS, f"length(value) >= {LEAST_ACCESS}"),
        _sql_found("hex", 2, HEX, "true"),
        _sql_found(
            "entropy",
            3,
            "[A-Za-z0-9+/_=-]{20,}",
            f"regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') AND {open_}",
        ),
    ]
    lim = most_weights()
    return "WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents)," + ",".join(parts) + f""",
c AS (SELECT s3.doc_id, start, value, CASE WHEN regexp_full_match(value, '[0-9a-fA-F]+') THEN {lim['hex']}
      WHEN regexp_full_match(value, '[0-9A-Za-z]+') THEN {lim['alphanumeric']} ELSE {lim['encoded']} END AS most
    FROM s3 JOIN d USING (doc_id) WHERE NOT regexp_matches(substr(body, greatest(1, start - 9), least(10, start)), {_sql(ALLOWED_BEFORE)})),
w AS (SELECT doc_id, start, most, value, unnest(range(0, length(value) - {WINDOW - 1})) AS i FROM c),
l AS (SELECT doc_id, start, most, i, unnest(string_split(substr(value, i + 1, {WINDOW}), '')) AS ch FROM w),
n AS (SELECT doc_id, start, most, i, ch, count(*) AS k FROM l GROUP BY ALL),
h AS (SELECT doc_id, start, i FROM n GROUP BY doc_id, start, most, i HAVING sum(round({_SCALE} * k * log2(k))) <= most),
e AS (SELECT doc_id, start, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id, start ORDER BY i) + {WINDOW} THEN 0 ELSE 1 END AS fresh FROM h),
r AS (SELECT doc_id, start, i, sum(fresh) OVER (PARTITION BY doc_id, start ORDER BY i) AS run FROM e),
base AS (SELECT doc_id, start, rank, stop, kind FROM s0 UNION ALL SELECT doc_id, start, rank, stop, kind FROM s1
    UNION ALL SELECT doc_id, start, rank, stop, kind FROM s2),
dense AS (SELECT doc_id, start + min(i) AS start, 3 AS rank, start + max(i) + {WINDOW} AS stop, 'entropy' AS kind FROM r GROUP BY doc_id, r.start, run),
spans AS (SELECT * FROM base UNION ALL SELECT * FROM dense x WHERE NOT EXISTS
    (SELECT 1 FROM base b WHERE b.doc_id = x.doc_id AND b.start <= x.start AND b.stop >= x.stop)),
f AS (SELECT doc_id, count(*) FILTER (rank = 0) AS a, count(*) FILTER (rank = 1) AS b, count(*) FILTER (rank = 2) AS c,
    count(*) FILTER (rank = 3) AS e, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank, stop) FILTER (rank < 3) AS base,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank, stop) AS spans FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(b, 0)::BIGINT AS n_access, coalesce(c, 0)::BIGINT AS n_hex,
  coalesce(e, 0)::BIGINT AS n_entropy, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN f USING (doc_id)"""


#: DuckDB twin of the registered query.
ORACLE = _oracle()
