"""Token ids in raw binary shards, found again through a minimal perfect hash of the document keys.

Format of one folder:

- ``ids-<shard>.bin``: ``MAGIC``, one byte of item size (2 or 4), then the ids of the shard's documents
  one after the other, little-endian unsigned. Shards follow each other in ascending ``doc_id`` order.
- ``index-<part>.mph``: for the keys whose hash falls to that part, a minimal perfect hash (levels of
  bit arrays) and, by its slot, a 32-bit fingerprint of the key, shard, offset and length in ids.
- ``entries``: Parquet, one row per document: key, shard, offset, length.

A key is ``(doc_id, copy)``: rows that repeat a ``doc_id`` are numbered from 0. A lookup reads one bit
per level (two levels on average), one rank and one slot, whatever the number of keys.
"""

from __future__ import annotations

import io
import math
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoremill.llm.common import mixed, per_batch, table
from scoremill.session import run_folder

MAGIC = b"TOKIDS1"
HEADER = len(MAGIC) + 1
#: Keys per index file: one is built in the memory of a task.
KEYS_PER_PART = 200_000
#: Characters of text that a worker takes apart at a time.
CHARS_AT_ONCE = 8_000_000

#: What is cut off behind letters: the tokenizer's pattern starts a token there.
PUNCTUATION = ".,;:!?%|$&*#)"

#: White space at which texts are cut, as a tokenizer's pattern does: the last space goes with what follows it.
#: Texts with other white space or added tokens, which end a text for the pattern, go to the library whole.
WHITE = " \t\n\r"
CHUNKS = re.compile(r" ?[^ \t\n\r]+|[ \t\n\r]+(?![^ \t\n\r])|[\t\n\r]")
INNER_WHITE = re.compile(r"[\t\n\r]")
OTHER_WHITE = r"[^\S \t\n\r]"

#: Longer words are encoded again for each slice of texts, so that what a worker keeps stays small.
KEPT_LENGTH = 64

_loaded: dict = {}


# Files


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its file system, as Spark takes it: a path without scheme is on the default one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _store(folder: str) -> tuple[arrow_fs.FileSystem, str]:
    if folder.startswith("file:"):
        return arrow_fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    if "://" in folder:
        return arrow_fs.FileSystem.from_uri(folder)
    return arrow_fs.LocalFileSystem(), folder


class _Published:
    """A file that appears under its name only when complete; a repeated attempt may replace it."""

    def __init__(self, folder: str, name: str):
        self.files, self.root = _store(folder)
        self.files.create_dir(self.root, recursive=True)
        self.name = f"{self.root}/{name}"
        self.draft = f"{self.root}/.{name}.{uuid.uuid4().hex}"

    def __enter__(self):
        self.out = self.files.open_output_stream(self.draft)
        return self.out

    def __exit__(self, kind, *_):
        self.out.close()
        if kind is None:
            self.files.move(self.draft, self.name)
        else:
            self.files.delete_file(self.draft)


# Encoding


class WordwiseTokenizer:
    """A byte-level tokenizer of the tokenizers library that encodes each distinct word once.

    Its pattern lets a token take a space only at its start, so a text may be cut before a single space
    between two other characters. Arrow splits the texts there and numbers the distinct words, so that Python
    sees each of them once for many texts. Texts with other white space around a cut are cut by a pattern.
    """

    def __init__(self, path: str, limit: int = 700_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.after_space = np.zeros(size, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.after_space[i] = token.startswith("\u0120")  # how byte-level tokenizers write a space
        #: Ids of a word with the space before it, by the word, and of what is encoded as it is.
        self.known: dict[str, bytes] = {}
        self.bare: dict[str, bytes] = {}
        self.limit = limit
        added = [re.escape(token.content) for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.uncut = re.compile("|".join([OTHER_WHITE, *added])).search
        probe = "a.\n\nb,\n\tc  d \n e\r\n 'f\n's\n"
        #: Whether the tokenizer's pattern cuts at white space as ``CHUNKS`` does.
        self.cuts = self._whole([probe])[0] == b"".join(self._whole(CHUNKS.findall(probe)))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, packed; null is the empty text."""
        ids, lengths = self.encode_column(pa.array(texts, pa.string()))
        raw, ends = ids.tobytes(), (np.cumsum(lengths) * self.kind.itemsize).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each text has; null is the empty text."""
        if not len(texts):
            return np.zeros(0, self.kind), np.zeros(0, np.int64)
        texts = pc.fill_null(texts, "")
        split = pc.split_pattern(texts, " ")
        counts = pc.list_value_length(split).to_numpy().astype(np.int64)
        coded = split.flatten().dictionary_encode()
        places = coded.indices.to_numpy().astype(np.int64)
        words = coded.dictionary.to_numpy(zero_copy_only=False)
        last = np.cumsum(counts) - 1
        first = last - counts + 1
        # The first word of a text has no space before it.
        inner = np.ones(len(places), bool)
        inner[first] = False
        own, place = np.unique(places[first], return_inverse=True)
        starts = words[own].tolist()
        used = np.flatnonzero(np.bincount(places[inner], minlength=len(words)))
        number = np.zeros(len(words), np.int64)
        number[used] = np.arange(len(used))
        places[inner] = number[places[inner]]
        places[first] = len(used) + place
        found, opens, closes = self._spaced(words[used].tolist())
        found += self._bare(starts)
        opens = np.concatenate([opens, [not word for word in starts]])
        closes = np.concatenate([closes, [word[-1:].isspace() for word in starts]])
        # White space beside a space that is no cut: behind it, or before it unless the text ends there.
        beside = opens[places] & (inner | np.repeat(counts > 1, counts))
        closing = closes[places]
        closing[last] = False
        loose = np.flatnonzero(np.logical_or.reduceat(beside | closing, first))
        if len(loose):
            kept = np.ones(len(texts), bool)
            kept[loose] = False
            kept = np.repeat(kept, counts)
            kept[first] = True
            places[first[loose]] = len(found) + np.arange(len(loose))
            places = places[kept]
            counts[loose] = 1
            first = np.cumsum(counts) - counts
            found += self._loose(texts.take(pa.array(loose)).to_pylist())
        pool = np.frombuffer(b"".join(found), self.kind)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.kind.itemsize
        taken = sizes[places]
        shift = (np.cumsum(sizes) - sizes)[places] - (np.cumsum(taken) - taken)
        ids = pool[np.repeat(shift, taken) + np.arange(taken.sum())]
        return ids, np.add.reduceat(taken, first)

    def _loose(self, texts: list[str]) -> list[bytes]:
        """Ids of texts with other white space than single spaces."""
        cut = [i for i, text in enumerate(texts) if self.cuts and not self.uncut(text)]
        split = [CHUNKS.findall(texts[i]) for i in cut]
        ids = self._chunks(set().union(*split)).__getitem__
        found: list[bytes | None] = [None] * len(texts)
        for i, chunks in zip(cut, split, strict=True):
            found[i] = b"".join(map(ids, chunks))
        others = [i for i, one in enumerate(found) if one is None]
        for i, one in zip(others, self._whole([texts[i] for i in others]), strict=True):
            found[i] = one
        return found

    def _chunks(self, chunks: set[str]) -> dict[str, bytes]:
        """Ids of what ``CHUNKS`` finds."""
        spaced = [x for x in chunks if x[0] == " " and x[-1] not in WHITE]
        ids = dict(zip(spaced, self._spaced([x[1:] for x in spaced])[0], strict=True))
        others = list(chunks.difference(spaced))
        ids.update(zip(others, self._bare(others), strict=True))
        return ids

    def _spaced(self, words: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Ids of distinct words with a space before each; which are empty or open, and which close, with white space.

        Punctuation behind letters starts a token, and so do lines: they are encoded apart, so that fewer words are
        new. Only what words are put together from is kept.
        """
        if len(self.known) + len(self.bare) > self.limit:
            self.known.clear()
            self.bare.clear()
        known = self.known
        found = list(map(known.get, words))
        opens, closes = np.zeros(len(words), bool), np.zeros(len(words), bool)
        new, odd, lines, cut, stems, tails = [], [], [], [], [], []
        missing = [i for i, ids in enumerate(found) if ids is None]
        for i, letters in zip(missing, [words[i].rstrip(PUNCTUATION) for i in missing], strict=True):
            word = words[i]
            if letters.isalpha():
                if len(letters) == len(word):
                    new.append(i)
                    continue
                if len(word) <= KEPT_LENGTH:
                    cut.append(i)
                    stems.append(letters)
                    tails.append(word[len(letters) :])
                    continue
            opens[i] = not word or word[0].isspace()
            closes[i] = word[-1:].isspace()
            if opens[i]:
                found[i] = b""
            elif self.cuts and INNER_WHITE.search(word) and not self.uncut(word):
                lines.append((i, CHUNKS.findall(" " + word)))
            elif closes[i]:
                odd.append(i)
            else:
                new.append(i)
        learnt = [words[i] for i in new]
        new_stems = list(set(stems).difference(known, learnt))
        ids = self._joined([*learnt, *new_stems], " ", self.after_space)
        for i, word, one in zip(new, learnt, ids, strict=False):
            found[i] = one
            if len(word) <= KEPT_LENGTH:
                known[word] = one
        known.update(zip(new_stems, ids[len(new) :], strict=True))
        kinds = list(set(tails))
        tail_ids = dict(zip(kinds, self._bare(kinds), strict=True))
        for i, letters, tail in zip(cut, stems, tails, strict=True):
            found[i] = known[letters] + tail_ids[tail]
        for i, one in zip(odd, self._whole([" " + words[i] for i in odd]), strict=True):
            found[i] = one
        if lines:
            chunk = self._chunks(set().union(*(chunks for _, chunks in lines))).__getitem__
            for i, chunks in lines:
                found[i] = b"".join(map(chunk, chunks))
        return found, opens, closes

    def _bare(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces as they are."""
        bare = self.bare
        found = list(map(bare.get, pieces))
        odd, cut, stems = [], [], set()
        for i in [i for i, ids in enumerate(found) if ids is None]:
            letters = pieces[i].rstrip(PUNCTUATION)
            if self.cuts and letters.isalpha() and len(pieces[i]) <= KEPT_LENGTH:
                cut.append((i, letters, pieces[i][len(letters) :]))
                stems.update(filter(None, cut[-1][1:]))
            else:
                odd.append(i)
        new = list(stems.difference(bare))
        line = np.frombuffer(self._whole(["\n"])[0], self.kind)
        border = np.zeros(len(self.after_space), bool)
        border[line] = True
        size = len(line) * self.kind.itemsize
        bare.update(zip(new, [one[size:] for one in self._joined(new, "\n", border)], strict=True))
        for i, letters, tail in cut:
            found[i] = bare[letters] + bare[tail] if tail else bare[letters]
        for i, one in zip(odd, self._whole([pieces[i] for i in odd]), strict=True):
            found[i] = one
            if len(pieces[i]) <= KEPT_LENGTH:
                bare[pieces[i]] = one
        return found

    def _joined(self, words: list[str], sign: str, border: np.ndarray) -> list[bytes]:
        """Ids of ``sign`` and each word, encoded as few texts; ids marked in ``border`` tell where each word starts."""
        size, out = self.kind.itemsize, []
        for at in range(0, len(words), 2_000):
            some = words[at : at + 2_000]
            raw = self._whole([sign + sign.join(some)])[0]
            borders = (np.flatnonzero(border[np.frombuffer(raw, self.kind)]) * size).tolist()
            if len(borders) == len(some):
                out += [raw[a:b] for a, b in zip(borders, [*borders[1:], len(raw)], strict=True)]
            else:  # a special token among them took a space
                out += self._whole([sign + word for word in some])
        return out

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.kind).tobytes() for x in found]


def _coder(tokenizer_path: str) -> WordwiseTokenizer:
    """The worker's tokenizer. A function inside another travels with copies of the globals it names, so each task that
    named ``_loaded`` itself would begin with an empty one."""
    return per_batch(_loaded, WordwiseTokenizer, tokenizer_path)


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 2) -> None:
    """Encode the whole text of every row of ``docs (doc_id, text)`` and write shards and index.

    Null and empty texts hold only ``end_id``. Rows are in ascending order of ``doc_id`` (nulls first,
    repeated ids in order of their text); an id with very many different texts is dealt over several shards. Empty input writes no shard and an empty entry table.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        coder = _coder(tokenizer_path)
        first = next(batches, None)
        if first is None:
            return
        offset, before, copy = 0, object(), 0
        with _Published(folder, f"ids-{shard:08d}.bin") as out:
            out.write(MAGIC + bytes([coder.kind.itemsize]))
            for batch in chain([first], batches):
                lengths = [np.zeros(0, np.int64)]
                for texts in _slices(batch["text"]):
                    ids, sizes = coder.encode_column(texts)
                    out.write(np.insert(ids, np.cumsum(sizes), end_id).tobytes())
                    lengths.append(sizes + 1)
                lengths = np.concatenate(lengths)
                copies = []
                for key in batch["doc_id"].to_pylist():
                    copy = copy + 1 if key == before else 0
                    before = key
                    copies.append(copy)
                ends = offset + np.cumsum(lengths)
                offset += int(lengths.sum())
                rows = {"doc_id": batch["doc_id"], "copy": pa.array(copies, pa.int64())}
                rows |= {"shard": pa.array(np.full(len(copies), shard, np.int64))}
                yield pa.RecordBatch.from_pydict(rows | {"offset": ends - lengths, "n_tokens": lengths})

    spark = docs.sparkSession
    folder = _qualified(spark, folder)
    # A text's beginning is in the order of the text, and keeps the sample for the ranges small.
    start = F.substring("text", 1, 64).alias("start")
    ordered = docs.select(F.col("doc_id").cast("long"), "text", start).repartitionByRange("doc_id", "start")
    drafts = ordered.sortWithinPartitions("doc_id", "start", "text").select("doc_id", "text").mapInArrow(
        encode, "doc_id long, copy long, shard long, offset long, n_tokens long"
    )
    drafts.write.parquet(f"{folder}/drafts")
    _numbered(spark.read.parquet(f"{folder}/drafts")).write.parquet(f"{folder}/entries")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/drafts")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    _write_index(spark, folder)


def _numbered(drafts: DataFrame) -> DataFrame:
    """Entries whose copies are numbered over all shards of an id, not from 0 in each.

    Shards follow each other in order, so only the first and last id of a shard can go on in another one: lists as
    long as the number of shards.
    """
    spark = drafts.sparkSession
    ends = drafts.groupBy("shard").agg(F.min_by("doc_id", "offset").alias("first"), F.max_by("doc_id", "offset").alias("last"))
    ends = sorted(map(tuple, ends.collect()))
    shared = {left[2] for left, right in zip(ends, ends[1:], strict=False) if left[2] == right[1]}
    if not shared:
        return drafts
    known = sorted(shared - {None})
    own = F.col("doc_id").isin(known) if known else F.lit(False)
    own = own | F.col("doc_id").isNull() if None in shared else own
    counts = drafts.filter(own).groupBy("doc_id", "shard").count().collect()
    starts, passed = [], {}
    for key, shard, n in sorted(map(tuple, counts), key=lambda row: row[1]):
        starts.append((key, shard, passed.get(key, 0)))
        passed[key] = passed.get(key, 0) + n
    starts = F.broadcast(spark.createDataFrame(starts, "_id long, _shard long, _start long"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("shard") == F.col("_shard"))
    joined = drafts.join(starts, same, "left").withColumn("copy", F.col("copy") + F.coalesce("_start", F.lit(0)))
    return joined.select(*drafts.columns)


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    ends = np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy())
    start = passed = 0
    while start < len(texts):
        stop = min(int(np.searchsorted(ends, passed + CHARS_AT_ONCE)) + 1, len(texts))
        yield texts.slice(start, stop - start)
        start, passed = stop, int(ends[stop - 1])


# Index


def key_hash(doc_id: pd.Series, copy: pd.Series) -> np.ndarray:
    """64-bit hash of a key; no two first copies share one, since mixing is one-to-one."""
    missing = doc_id.isna().to_numpy()
    ids = doc_id.fillna(0).to_numpy(np.int64).view(np.uint64)
    salt = copy.to_numpy(np.int64).view(np.uint64) + np.where(missing, np.uint64(1 << 63), np.uint64(0))
    return mixed(ids ^ np.where(salt > 0, mixed(salt), np.uint64(0)))


class PerfectHash:
    """Levels of bit arrays: a key that is alone at its place of a level sets the bit and stops there."""

    SPACE, LEVELS = 2.0, 40

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        sizes = [int(bits.sum()) for bits in levels]
        self.before = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.ranks = [np.concatenate([[0], np.cumsum(bits)]).astype(np.int64) for bits in levels]

    @classmethod
    def of(cls, hashes: np.ndarray) -> PerfectHash:
        if len(np.unique(hashes)) != len(hashes):
            raise ValueError("two keys share a hash")
        levels: list[np.ndarray] = []
        while len(hashes):
            if len(levels) == cls.LEVELS:
                raise ValueError("no perfect hash found")
            size = max(8, math.ceil(cls.SPACE * len(hashes)))
            places = cls.place(hashes, len(levels), size)
            alone = np.bincount(places, minlength=size) == 1
            levels.append(alone)
            hashes = hashes[~alone[places]]
        return cls(levels)

    @staticmethod
    def place(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        return (mixed(hashes + seed) % np.uint64(size)).astype(np.int64)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 for some keys that aren't among those it was built from."""
        found = np.full(len(hashes), -1, np.int64)
        open_ = np.arange(len(hashes))
        for level, bits in enumerate(self.levels):
            places = self.place(hashes[open_], level, len(bits))
            hit = bits[places]
            found[open_[hit]] = self.before[level] + self.ranks[level][places[hit]]
            open_ = open_[~hit]
        return found

    def save(self) -> dict[str, np.ndarray]:
        out = {f"level{i}": np.packbits(bits) for i, bits in enumerate(self.levels)}
        return out | {"sizes": np.array([len(bits) for bits in self.levels], np.int64)}

    @classmethod
    def load(cls, saved) -> PerfectHash:
        sizes = saved["sizes"].tolist()
        return cls(
            [np.unpackbits(saved[f"level{i}"], count=n).astype(bool) for i, n in enumerate(sizes)]
        )


def fingerprints(hashes: np.ndarray) -> np.ndarray:
    return (mixed(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(32)).astype(np.uint32)


def _part(parts: int):
    """Index part of a key: any spread will do, as long as writer and reader agree."""
    return F.pmod(F.xxhash64("doc_id", "copy"), F.lit(parts))


def _write_index(spark: SparkSession, folder: str) -> None:
    entries = spark.read.parquet(f"{folder}/entries")
    parts = max(1, math.ceil(entries.count() / KEYS_PER_PART))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        hashes = key_hash(group["doc_id"], group["copy"])
        perfect = PerfectHash.of(hashes)
        order = np.argsort(perfect.slots(hashes))
        columns = {name: group[name].to_numpy()[order] for name in ("shard", "offset", "n_tokens")}
        buffer = io.BytesIO()
        np.savez(buffer, **perfect.save(), **columns, fingerprint=fingerprints(hashes)[order])
        part = int(group["part"].iloc[0])
        with _Published(folder, f"index-{part:08d}.mph") as out:
            out.write(buffer.getvalue())
        return pd.DataFrame({"part": [part], "parts": [parts], "keys": [len(group)]})

    built = entries.withColumn("part", _part(parts)).groupBy("part")
    built.applyInPandas(build, "part long, parts long, keys long").write.parquet(f"{folder}/parts")


# Reading


def locate(keys: DataFrame, folder: str) -> DataFrame:
    """Shard, offset and length of each ``(doc_id, copy)``, by the index; unknown keys get no row."""
    folder = _qualified(keys.sparkSession, folder)
    counted = keys.sparkSession.read.parquet(f"{folder}/parts").agg(F.max("parts")).first()[0] or 1

    def look_up(group: pd.DataFrame) -> pd.DataFrame:
        files, root = _store(folder)
        name = f"{root}/index-{int(group['part'].iloc[0]):08d}.mph"
        if files.get_file_info(name).type == arrow_fs.FileType.NotFound:
            return pd.DataFrame(columns=["doc_id", "copy", "shard", "offset", "n_tokens"])
        with files.open_input_file(name) as file:
            saved = np.load(io.BytesIO(file.read()))
        hashes = key_hash(group["doc_id"], group["copy"])
        slots = PerfectHash.load(saved).slots(hashes)
        real = (slots >= 0) & (saved["fingerprint"][slots] == fingerprints(hashes))
        found = group.loc[real, ["doc_id", "copy"]]
        return found.assign(**{c: saved[c][slots[real]] for c in ("shard", "offset", "n_tokens")})

    return (
        keys.select(F.col("doc_id").cast("long"), F.col("copy").cast("long"))
        .withColumn("part", _part(counted))
        .groupBy("part")
        .applyInPandas(look_up, "doc_id long, copy long, shard long, offset long, n_tokens long")
    )


def read_ids(folder: str, shard: int, offsets, lengths) -> Iterator[np.ndarray]:
    """Ids of documents of one shard, read at the places given."""
    files, root = _store(folder)
    with files.open_input_file(f"{root}/ids-{shard:08d}.bin") as file:
        head = file.read_at(HEADER, 0)
        if head[:-1] != MAGIC:
            raise ValueError(f"shard {shard} of {folder} is no file of token ids")
        kind = np.dtype(f"<u{head[-1]}")
        for offset, length in zip(offsets, lengths, strict=True):
            data = file.read_at(length * kind.itemsize, HEADER + offset * kind.itemsize)
            yield np.frombuffer(data, kind)


def digests(located: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of located documents, from the payload itself."""
    spark = located.sparkSession
    folder = _qualified(spark, folder)

    def fetch(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("offset")
        found = read_ids(folder, int(group["shard"].iloc[0]), group["offset"], group["n_tokens"])
        rows = [(len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for ids in found]
        sizes, crcs = zip(*rows, strict=True)
        return group[["doc_id", "shard", "offset"]].assign(n_tokens=sizes, ids_crc32=crcs)

    read = located.groupBy("shard").applyInPandas(
        fetch, "doc_id long, shard long, offset long, n_tokens long, ids_crc32 long"
    )
    # One row per shard file: a list as long as the folder's.
    totals = spark.read.parquet(f"{folder}/entries").groupBy("shard").agg(F.sum("n_tokens"))
    bases, base = [], 0
    for shard, size in sorted(map(tuple, totals.collect())):
        bases.append((shard, base))
        base += size
    starts = spark.createDataFrame(bases, "shard long, base long")
    joined = read.join(starts, "shard")
    return joined.select("doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all ``documents``, read back by key; nulls, repeats and empty tables as in ``write_token_files``."""
    folder = run_folder(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), folder, tokenizer_file())
    keys = spark.read.parquet(f"{folder}/entries").select("doc_id", "copy")
    return digests(locate(keys, folder), folder)
