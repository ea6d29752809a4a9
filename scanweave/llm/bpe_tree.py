"""Byte-level BPE of whole texts by a tree of mergeable parts, and back.

A text is halved until its parts are short, the parts are encoded, and neighbours are joined up the tree.
Joining is associative: the result is the encoding of the joined text, whatever the cuts were.
"""

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from scanweave.llm.tokens import by_bytes

# Fixed value: how the vocabulary's texts are cut into matches, each encoded separately.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# A match of PATTERN is decided by itself and so many characters behind it.
_AHEAD = 2
_ID = np.dtype("<u4")


class TreeCoder:
    """Encodes and decodes texts for one vocabulary of ranks.

    `leaf`: texts and matches of at most so many characters are encoded at once. `most`: so many different
    short matches are remembered.
    """

    def __init__(self, path: str, leaf: int = 512, most: int = 400_000):
        import regex
        import tiktoken

        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.bytes_of = [b""] * (max(self.ranks.values()) + 1)
        for piece, rank in self.ranks.items():
            self.bytes_of[rank] = piece
        self.leaf, self.most = leaf, most
        # One match for the whole string: the library's merges without its cutting.
        self.merges = tiktoken.Encoding("merges", pat_str=r"[\s\S]+", mergeable_ranks=self.ranks, special_tokens={})
        self.plain = regex.compile(PATTERN)
        self.strange, self.careful = self._by_library(tiktoken, regex)
        self.known: dict[str, tuple[str, np.ndarray]] = {}
        self.firm: dict[tuple[int, int], bool] = {}

    def _by_library(self, tiktoken, regex):
        """Characters whose kind is another in the library's version of Unicode, and a pattern that follows it."""
        sets, strange = {}, set()
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        for kind in (r"\p{L}", r"\p{N}", r"\s"):
            only = tiktoken.Encoding("kind", pat_str=kind, mergeable_ranks=self.ranks, special_tokens={})
            theirs = set(only.decode(only.encode_ordinary(every)))
            strange |= theirs ^ set(regex.findall(kind, every))
            sets[kind] = _ranges(theirs)
        if not strange:
            return None, self.plain
        careful = PATTERN.replace(r"[^\s\p{L}\p{N}]", f"[^{''.join(sets.values())}]").replace(r"\S", f"[^{sets[chr(92) + 's']}]")
        for kind, characters in sets.items():
            careful = careful.replace(kind + "+", f"[{characters}]+")
        return regex.compile(f"[{_ranges(strange)}]"), regex.compile(careful)

    def encode(self, text: str) -> bytes:
        """Ids of the text, little-endian, 32 bits each."""
        if not text:
            return b""
        pattern = self.careful if self.strange and self.strange.search(text) else self.plain
        return b"".join([ids for _, ids in self._tree(pattern, text, 0, len(text))])

    def decode(self, ids: bytes, leaf: int = 1 << 14) -> bytes:
        """Bytes of the ids: halves are decoded by themselves and put together."""
        if len(ids) <= 4 * leaf:
            return b"".join([self.bytes_of[i] for i in np.frombuffer(ids, _ID).tolist()])
        middle = len(ids) // 8 * 4
        return self.decode(ids[:middle], leaf) + self.decode(ids[middle:], leaf)

    def _tree(self, pattern, text: str, start: int, end: int) -> list:
        """(match, its ids) of text[start:end] taken by itself."""
        if end - start <= self.leaf:
            return [self.known.get(match) or self._short(match) for match in pattern.findall(text[start:end])]
        middle = (start + end) // 2
        return self._join(pattern, self._tree(pattern, text, start, middle), self._tree(pattern, text, middle, end))

    def _short(self, match: str) -> tuple[str, bytes]:
        found = match, np.array(self.merges.encode_ordinary(match), _ID).tobytes()
        if len(match) <= 64:
            if len(self.known) >= self.most:
                self.known.clear()
            self.known[match] = found
        return found

    def _join(self, pattern, left: list, right: list) -> list:
        """The matches of two neighbouring texts put together; `left` is changed.

        Matches of the left text with two characters behind them stand. The rest is cut again together with
        more and more matches of the right text, until a new cut falls on one of the right text's own: from
        there on both go the same way, since the pattern never looks back.
        """
        tail = [left.pop()]
        if left and len(tail[0][0]) < _AHEAD:
            tail.insert(0, left.pop())
        before = sum(len(match) for match, _ in tail)
        take = 4
        while True:
            old = tail + right[:take]
            window = "".join([match for match, _ in old])
            new, rest = self._agreed(pattern.findall(window), before, old[len(tail) :], len(window))
            if take >= len(right) and rest is None:
                rest = len(right)
            if rest is not None:
                break
            take *= 2
        left += self._encoded(new, tail + right[:rest])
        left += right[rest:]
        return left

    @staticmethod
    def _agreed(new: list[str], before: int, theirs: list, size: int):
        """The new matches up to the first sure cut that is one of `theirs` as well, and how many of theirs they replace."""
        cuts, at = {}, before
        for i, (match, _) in enumerate(theirs):
            cuts[at] = i
            at += len(match)
        at = 0
        for n, match in enumerate(new, 1):
            at += len(match)
            if at > size - _AHEAD:
                break
            if at in cuts:
                return new[:n], cuts[at]
        return new, None

    def _encoded(self, new: list[str], old: list) -> list:
        """The new matches with their ids; long ones are put together from the ids of the old matches they cover."""
        found, start = [], 0
        for match in new:
            end = start + len(match)
            if len(match) <= self.leaf:
                found.append(self.known.get(match) or self._short(match))
            else:
                ids, at = None, 0
                for piece, its in old:
                    low, high = max(start, at), min(end, at + len(piece))
                    if low < high:
                        if high - low < len(piece):
                            its = self._long(piece[low - at : high - at])
                        ids = its if ids is None else self._glue(ids, its)
                    at += len(piece)
                found.append((match, ids))
            start = end
        return found

    def _long(self, part: str) -> bytes:
        """Ids of a part of one match, by halves."""
        if len(part) <= self.leaf:
            return self._short(part)[1]
        middle = len(part) // 2
        return self._glue(self._long(part[:middle]), self._long(part[middle:]))

    def _glue(self, left: bytes, right: bytes) -> bytes:
        """Ids of two neighbouring parts of one match put together.

        A window over the boundary is encoded again and grows until both its outer neighbours stay beside it. Ids
        of which each neighbouring pair encodes to itself are the encoding of all their bytes: the first merge
        across any boundary between them would also be the first across it in the pair alone.
        """
        a, b = np.frombuffer(left, _ID), np.frombuffer(right, _ID)
        size = 1
        while True:
            i, j = self._back(a, len(a) - size), self._on(b, size)
            window = self.decode(a[i:].tobytes()) + self.decode(b[:j].tobytes())
            inner = np.asarray(self.merges.encode_to_numpy(window.decode()), _ID)
            if (i == 0 or self._stay(a[i - 1], inner[0])) and (j == len(b) or self._stay(inner[-1], b[j])):
                return b"".join((a[:i].tobytes(), inner.tobytes(), b[j:].tobytes()))
            size *= 2

    def _inside(self, rank: int) -> bool:
        """Whether the token starts in the middle of a character."""
        return self.bytes_of[rank][0] & 0xC0 == 0x80

    def _back(self, ids: np.ndarray, at: int) -> int:
        at = max(at, 0)
        while at > 0 and self._inside(ids[at]):
            at -= 1
        return at

    def _on(self, ids: np.ndarray, at: int) -> int:
        at = min(at, len(ids))
        while at < len(ids) and self._inside(ids[at]):
            at += 1
        return at

    def _stay(self, one: int, other: int) -> bool:
        """Whether the bytes of two tokens encode to these two."""
        key = int(one), int(other)
        found = self.firm.get(key)
        if found is None:
            if len(self.firm) >= self.most:
                self.firm.clear()
            found = self.firm[key] = self._merged(self.bytes_of[key[0]] + self.bytes_of[key[1]]) == list(key)
        return found

    def _merged(self, piece: bytes) -> list[int]:
        """Ids of a few bytes, not always whole characters: the lowest rank first, the leftmost of equals."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            pairs = [(self.ranks.get(parts[i] + parts[i + 1]), i) for i in range(len(parts) - 1)]
            rank, at = min(((r, i) for r, i in pairs if r is not None), default=(None, 0))
            if rank is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[part] for part in parts]


def _ranges(characters: set[str]) -> str:
    """The characters as the inside of a character class."""
    codes, found = sorted(map(ord, characters)), []
    for code in codes:
        if found and code == found[-1][1] + 1:
            found[-1][1] = code
        else:
            found.append([code, code])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in found)


@lru_cache(maxsize=2)
def tree_coder(path: str, leaf: int) -> TreeCoder:
    return TreeCoder(path, leaf)


def _by_value(df: DataFrame, keep: tuple[str, ...], given, name: str, work, batch_bytes: int) -> DataFrame:
    """The `keep` columns and `name`: what `work()` makes of each `given` value, in batches of few bytes."""
    rows = df.select(*(F.col(f"`{column}`").alias(f"keep_{i}") for i, column in enumerate(keep)), given.alias("given"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]

    def each(batches):
        do = work()
        for batch in batches:
            values = batch.column(len(keep))
            for start, end in by_bytes([len(value.as_buffer()) for value in values.cast(pa.binary())], batch_bytes):
                made = pa.array([do(value) for value in values[start:end].to_pylist()], pa.binary())
                kept = [column[start:end] for column in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*kept, made], [*batch.schema.names[:-1], name])

    made = rows.mapInArrow(each, ", ".join([*fields, f"`{name}` binary"]))
    return made.select(*(F.col(f"keep_{i}").alias(column) for i, column in enumerate(keep)), name)


def encode(
    df: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), leaf: int = 512, batch_bytes: int = 4 << 20
) -> DataFrame:
    """The `keep` columns of every row and `ids`: token ids of its whole text, little-endian, 32 bits each.

    The ids are those the vocabulary's library gives without special tokens. A null text is an empty one and has
    no ids. Repeated rows stay, no rows give no rows, other columns are not read, whatever their names.
    Texts stay where they were read, without a shuffle; besides the text and its ids a long text
    costs 8 bytes a match, and no text, however long its words or blanks, takes more than about
    n log n steps.
    """
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return _by_value(df, keep, body, "ids", lambda: tree_coder(path, leaf).encode, batch_bytes)


def decode(
    df: DataFrame, path: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",), leaf: int = 512, batch_bytes: int = 4 << 20
) -> DataFrame:
    """The `keep` columns of every row and `body`: the bytes its `ids` stand for. Null ids are none."""
    given = F.coalesce(F.col(f"`{ids}`"), F.lit(b""))
    return _by_value(df, keep, given, "body", lambda: tree_coder(path, leaf).decode, batch_bytes)
