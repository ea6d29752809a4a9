"""Exact token ids and token counts of whole texts by public tokenizers."""

import json
import os
import re
from functools import lru_cache

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

@lru_cache(maxsize=4)
def load(path: str):
    """The tokenizer in `path`, without truncation or padding; one per Python worker."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _encode(tokenizer, pieces: list[str]):
    batch = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)
    for start in range(0, len(pieces), 4096):
        yield from batch(pieces[start : start + 4096], add_special_tokens=False)


class _Recent(dict):
    """What was found for recent pieces; holds about twice `most` entries and then forgets the oldest half."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.older = most, {}

    def trim(self) -> None:
        if len(self) > self.most:
            self.older = dict(self)
            self.clear()

    def missing(self, wanted) -> list:
        """The wanted pieces that must be encoded; all others are at hand afterwards."""
        new = []
        for piece in wanted:
            if piece not in self:
                found = self.older.get(piece)
                if found is None:
                    new.append(piece)
                else:
                    self[piece] = found
        return new


class PieceLengths:
    """Token counts of pieces between ASCII white space, for encodings that drop white space.

    No token reaches across white space, so the counts of a text's pieces add up. Each different piece is
    encoded once; counts of recent pieces stay in the memory of the Python worker.
    """

    def __init__(self, path: str, most: int = 600_000):
        self.tokenizer, self.known = load(path), _Recent(most)
        self.marks = {mark: len(found) for mark, found in zip(b".,", _encode(self.tokenizer, [".", ","]))}

    def _learn(self, wanted: set[bytes]) -> None:
        new = self.known.missing(wanted)
        stems = {piece: piece[:-1] if piece[-1] in self.marks and piece[:-1].isalpha() else piece for piece in new}
        plain = self.known.missing(set(stems.values()))
        for piece, found in zip(plain, _encode(self.tokenizer, [piece.decode() for piece in plain])):
            self.known[piece] = len(found)
        for piece, stem in stems.items():
            if piece is not stem:
                self.known[piece] = self.known[stem] + self.marks[piece[-1]]

    def totals(self, texts: list[bytes]) -> np.ndarray:
        """Number of tokens of each text (UTF-8)."""
        split = [text.split() for text in texts]
        self.known.trim()
        self._learn(set().union(*split))
        look_up = self.known.__getitem__
        return np.fromiter((sum(map(look_up, pieces)) for pieces in split), np.int64, len(split))


# Fixed value: how the byte-level vocabulary cuts a text into words.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Characters on whose kind (letter, number, white space) all libraries agree: Latin script and its marks.
_FOREIGN = re.compile("[^\t\n\r -~¡-ɏ‐-‧‰-⁞€]")
_LONG_RUN = re.compile(r"\s{2000}|\S{2000}")


def _byte_letters() -> dict[str, int]:
    """The letters byte-level vocabularies write bytes with: visible Latin-1 as it is, the rest from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class IdEncoder:
    """Token ids, little-endian, of whole texts for a byte-level vocabulary.

    Texts in Latin script are merged by the ranks of the same vocabulary, which is four times as fast;
    all others, and those with very long runs, by the library the vocabulary was written for. Both
    give the same ids.
    """

    def __init__(self, path: str):
        import tiktoken

        self.tokenizer = load(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        special = {token["content"]: token["id"] for token in parts["added_tokens"]}
        letters = _byte_letters()
        ranks = {
            bytes(letters[c] for c in token): i for token, i in parts["model"]["vocab"].items() if token not in special
        }
        cutter = parts["pre_tokenizer"] or {}
        byte_level = cutter.get("type") == "ByteLevel" and cutter["use_regex"] and not cutter["add_prefix_space"]
        if parts["normalizer"] or not byte_level:
            raise ValueError("not a byte-level vocabulary that keeps texts as they are")
        self.merger = tiktoken.Encoding("ranks", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: str) -> bytes:
        """Ids of the text; strings of special tokens become those, as is the library's default."""
        if _FOREIGN.search(text) or _LONG_RUN.search(text):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self.merger.encode_to_numpy(text, allowed_special="all")
        return np.asarray(ids, self.kind).tobytes()


@lru_cache(maxsize=2)
def piece_lengths(path: str) -> PieceLengths:
    return PieceLengths(path)


@lru_cache(maxsize=2)
def id_encoder(path: str) -> IdEncoder:
    return IdEncoder(path)


def by_bytes(sizes: list[int], most: int):
    """Neighbouring rows in ranges of at most `most` bytes, or one row: (start, end) pairs."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)
