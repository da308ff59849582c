"""Byte-level BPE encoding and decoding by forced boundaries.

A token can't span a pair of neighbouring bytes that stands inside no token of the vocabulary. Such a pair is a
certain cut: what is left and right of it is encoded apart, and the ids are put one after the other. The table of
the 65,536 byte pairs is read off the vocabulary once per worker.

The tokenizer's own pattern cuts a text into words first. Each distinct word is cut by its byte pairs and encoded
once per worker, as long as the store of words has room. Fragments are merged by rank, the leftmost of equals first.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterable

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoremill.llm.common import per_batch, table

#: Fixed value: the pattern that byte-level tokenizers of this kind cut a text with.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Words a worker keeps, and the longest of them in characters.
KEPT, KEPT_LENGTH = 700_000, 64
#: A pair of ids as one key, and the rank of a pair that is never merged.
SHIFT, NEVER = 32, 1 << 62
#: From this length on a fragment is merged through a heap.
HEAP_FROM = 24

_loaded: dict = {}


def printable_bytes() -> dict[str, int]:
    """How byte-level vocabularies write bytes: visible Latin-1 as itself, the others from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class ForcedCutBpe:
    """Encoder and decoder of one tokenizer file (``tokenizer.json`` of a byte-level BPE).

    Raises ``ValueError`` for files it can't reproduce: another model or pattern, a normalizer, dropout, byte
    fallback, merges that are skipped for whole words, or added tokens that take in neighbouring space.
    """

    def __init__(self, path: str, kept: int = KEPT):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, cutter, added = spec["model"], spec.get("pre_tokenizer") or {}, spec.get("added_tokens", [])
        plain = (
            model["type"] == "BPE"
            and spec.get("normalizer") is None
            and cutter.get("type") == "ByteLevel"
            and cutter.get("use_regex", True)
            and not cutter.get("add_prefix_space", True)
            and (spec.get("decoder") or {}).get("type") == "ByteLevel"
            and not any(model.get(k) for k in ("dropout", "byte_fallback", "ignore_merges", "unk_token"))
            and not any(model.get(k) for k in ("continuing_subword_prefix", "end_of_word_suffix"))
            and not any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
        )
        if not plain:
            raise ValueError(f"{path}: not a plain byte-level BPE")
        as_byte = printable_bytes()
        vocabulary = model["vocab"]
        size = 1 + max([*vocabulary.values(), *(t["id"] for t in added)])
        self.bytes_of: list[bytes | None] = [None] * size
        for token, i in vocabulary.items():
            self.bytes_of[i] = bytes(map(as_byte.__getitem__, token))
        self.added = {t["content"]: t["id"] for t in added}
        for content, i in self.added.items():
            seen = all(c in as_byte for c in content)
            self.bytes_of[i] = bytes(map(as_byte.__getitem__, content)) if seen else content.encode()
        ids = {b: i for i, b in enumerate(self.bytes_of) if b is not None and i not in self.added.values()}
        self.byte_ids = [ids[bytes([b])] for b in range(256)]
        self.ranks: dict[int, int] = {}
        self.joined: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocabulary[left] << SHIFT | vocabulary[right]] = rank
            self.joined.append(vocabulary[left + right])
        #: ``inside[256 * a + b]``: some token holds byte ``b`` right after byte ``a``.
        self.inside = bytearray(65536)
        for token in vocabulary:
            own = self.bytes_of[vocabulary[token]]
            for a, b in zip(own, own[1:], strict=False):
                self.inside[256 * a + b] = 1
        self.find = regex.compile(PATTERN).findall
        self.split_added = regex.compile(
            "(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")"
        ).split if self.added else None
        self.words = _Kept(self._ids_text, kept)
        self.by_number = {str(i): data for i, data in enumerate(self.bytes_of)}

    # Encoding

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; null is the empty text."""
        return [int(i) for i in self.ids_text(text).split(",")[:-1]]

    def ids_text(self, text: str | None) -> str:
        """Ids of a text as decimal numbers, each with a comma behind it."""
        if not text:
            return ""
        if self.added and any(content in text for content in self.added):
            pieces = self.split_added(text)
            return "".join([f"{self.added[x]}," if i % 2 else self._plain(x) for i, x in enumerate(pieces)])
        return self._plain(text)

    def _plain(self, text: str) -> str:
        return "".join(map(self.words.__getitem__, self.find(text)))

    def _ids_text(self, word: str) -> str:
        ids: list[int] = []
        for fragment in self.cut(word.encode()):
            ids += self._merged(fragment)
        return "".join([f"{i}," for i in ids])

    def cut(self, data: bytes) -> list[bytes]:
        """``data`` in pieces that no token reaches across."""
        inside = self.inside
        if len(data) <= KEPT_LENGTH:
            cuts = [i for i in range(1, len(data)) if not inside[256 * data[i - 1] + data[i]]]
        else:
            codes = np.frombuffer(data, np.uint8).astype(np.int64)
            joined = np.frombuffer(inside, np.uint8)[256 * codes[:-1] + codes[1:]]
            cuts = (np.flatnonzero(joined == 0) + 1).tolist()
        if not cuts:
            return [data]
        return [data[a:b] for a, b in zip([0, *cuts], [*cuts, len(data)], strict=True)]

    def _merged(self, fragment: bytes) -> list[int]:
        symbols = [self.byte_ids[b] for b in fragment]
        return self._by_heap(symbols) if len(symbols) >= HEAP_FROM else self._by_scan(symbols)

    def _by_scan(self, symbols: list[int]) -> list[int]:
        """Merge by rank; ``ranks`` holds that of each pair of neighbours, ``NEVER`` for none."""
        rank_of, joined = self.ranks.get, self.joined
        ranks = [rank_of(a << SHIFT | b, NEVER) for a, b in zip(symbols, symbols[1:], strict=False)]
        while ranks and (best := min(ranks)) != NEVER:
            at = ranks.index(best)
            symbols[at : at + 2] = [joined[best]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank_of(symbols[at - 1] << SHIFT | symbols[at], NEVER)
            if at < len(ranks):
                ranks[at] = rank_of(symbols[at] << SHIFT | symbols[at + 1], NEVER)
        return symbols

    def _by_heap(self, symbols: list[int]) -> list[int]:
        """The same in n log n steps: neighbours as a linked list, candidate merges in a heap."""
        rank_of, joined, n = self.ranks.get, self.joined, len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        pairs = [a << SHIFT | b for a, b in zip(symbols, symbols[1:], strict=False)]
        heap = [(rank, i, pair) for i, pair in enumerate(pairs) if (rank := rank_of(pair)) is not None]
        heapq.heapify(heap)
        while heap:
            best, i, pair = heapq.heappop(heap)
            j = after[i]
            if symbols[i] < 0 or j < 0 or symbols[i] << SHIFT | symbols[j] != pair:
                continue  # one of the two has been merged since
            symbols[i], symbols[j] = joined[best], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else -1
                if right >= 0:
                    pair = symbols[left] << SHIFT | symbols[right]
                    if (rank := rank_of(pair)) is not None:
                        heapq.heappush(heap, (rank, left, pair))
        return [s for s in symbols if s >= 0]

    # Decoding

    def decode(self, ids: Iterable[int]) -> str:
        """Text of ids, special ones included; bytes that form no character become U+FFFD."""
        return b"".join([self.bytes_of[i] for i in ids]).decode("utf-8", "replace")

    def decode_text(self, ids: str) -> bytes:
        """UTF-8 text of ids written as ``ids_text`` writes them."""
        return b"".join(map(self.by_number.__getitem__, ids.split(",")[:-1])).decode("utf-8", "replace").encode()


class _Kept(dict):
    """Results by key; long keys aren't kept, and all are dropped when there are too many."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= KEPT_LENGTH:
            if len(self) >= self.limit:
                self.clear()
            self[key] = value
        return value


def encode_documents(docs: DataFrame, tokenizer_path: str, text: str = "text") -> DataFrame:
    """``docs`` with a column ``token_ids`` of the whole text's ids.

    Null and empty texts give an empty array. Rows are encoded one by one, so repeated ones each keep theirs;
    other columns stay as they are, whatever their names (a ``token_ids`` column is replaced). No rows give none.
    """

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        codec = per_batch(_loaded, ForcedCutBpe, tokenizer_path)
        return texts.map(codec.encode, na_action=None)

    return docs.withColumn("token_ids", ids(F.col(text)))


def decode_documents(encoded: DataFrame, tokenizer_path: str, ids: str = "token_ids") -> DataFrame:
    """``encoded`` with a column ``decoded`` of the text, special tokens written out; null ids give null."""

    @F.pandas_udf("string")
    def decoded(rows: pd.Series) -> pd.Series:
        codec = per_batch(_loaded, ForcedCutBpe, tokenizer_path)
        return rows.map(lambda row: None if row is None else codec.decode(row), na_action=None)

    return encoded.withColumn("decoded", decoded(F.col(ids)))


def round_trip(docs: DataFrame, tokenizer_path: str, text: str = "text") -> DataFrame:
    """Encode each text and decode its ids: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    Ids and texts don't leave the worker. Null texts are empty (no ids); each row of ``docs`` gives a row, also
    where ids repeat or are null, and a table without rows gives one without rows.
    """
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"

    @F.pandas_udf(schema)
    def digests(texts: pd.Series) -> pd.DataFrame:
        codec = per_batch(_loaded, ForcedCutBpe, tokenizer_path)
        rows = []
        for value in texts:
            ids = codec.ids_text(value)
            rows.append(
                (
                    ids.count(","),
                    hashlib.sha256(ids[:-1].encode()).hexdigest(),
                    hashlib.sha256(codec.decode_text(ids)).hexdigest(),
                )
            )
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", digests(F.col(text)).alias("d")).select("doc_id", "d.*")


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op11_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and round trip of every whole text of ``documents``; nulls and repeats as in ``round_trip``."""
    return round_trip(table(spark, sf_dir, "documents"), tokenizer_file())
