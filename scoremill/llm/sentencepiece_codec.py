"""SentencePiece encoding and decoding of merge-type (BPE) models with byte fallback.

A merge model joins the best-scored neighbours first, the leftmost of equals. A sequence of pieces is
what that gives if, and only if, merging each two neighbours afresh gives back these two: the first
merge across a border would have been the next merge of the two alone. So the encoder looks for a
sequence whose neighbours all agree. It takes the longest piece at each position (one Aho-Corasick
pass finds them), falls back to shorter prefixes where neighbours don't agree, and steps back where
none does. A bitfield marks positions that were found to lead nowhere, so none is tried twice.

Texts are cut where no piece can reach across, and each distinct fragment is encoded once per worker
(up to a number of fragments that bounds the memory).
"""

from __future__ import annotations

import codecs
import hashlib
import re
import struct
from array import array

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoremill.llm.common import per_batch, table

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6

#: Words and parts of words a worker keeps, and four times as many pairs of pieces; some 250 MB.
FRAGMENTS = 250_000

_loaded: dict = {}


def _one_mark_a_byte(error: UnicodeDecodeError):
    return "�", error.start + 1


codecs.register_error("one_mark_a_byte", _one_mark_a_byte)


class Codec:
    """Encoder and decoder of one model file.

    Raises ``ValueError`` for models it can't reproduce: not of the merge type, without byte fallback,
    with a character map, or with pieces set by the user.
    """

    def __init__(self, model_path: str, fragments: int = FRAGMENTS):
        from sentencepiece import sentencepiece_model_pb2

        with open(model_path, "rb") as file:
            model = sentencepiece_model_pb2.ModelProto.FromString(file.read())
        norm = model.normalizer_spec
        if (
            model.trainer_spec.model_type != 2
            or norm.precompiled_charsmap
            or norm.remove_extra_whitespaces
            or not (norm.add_dummy_prefix and norm.escape_whitespaces)
            or {p.type for p in model.pieces} - {NORMAL, UNKNOWN, CONTROL, BYTE}
        ):
            raise ValueError(f"{model_path}: not a plain merge model with byte fallback")
        self.pieces = [p.piece for p in model.pieces]
        self.types = [p.type for p in model.pieces]
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.scores = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.byte_ids = [0] * 256
        for i, p in enumerate(model.pieces):
            if p.type == BYTE:
                self.byte_ids[int(p.piece[3:5], 16)] = i
        if not all(self.byte_ids):
            raise ValueError(f"{model_path}: no byte fallback")
        self.bytes_of = [
            bytes([int(piece[3:5], 16)]) if kind == BYTE
            else b"" if kind == CONTROL
            else " ⁇ ".encode() if kind == UNKNOWN
            else piece.replace(SPACE, " ").encode()
            for piece, kind in zip(self.pieces, self.types, strict=True)
        ]
        self.begin, self.end = self.pieces.index("<s>"), self.pieces.index("</s>")
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:
            self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        self.inside = {piece[i : i + 2] for piece in self.ids for i in range(len(piece) - 1)}
        #: A space sign can only start a piece: then words can be encoded one by one.
        self.by_word = not any(pair[1] == SPACE and pair[0] != SPACE for pair in self.inside)
        self.fits: dict[tuple[str, str], bool] = {}
        self.most_fits = 4 * fragments
        self.shorter: dict[str, str] = {}
        self.words = _Fragments(self._word, fragments)
        self.parts = _Fragments(self._packed, fragments)

    # Encoding

    def encode(self, text: str | None) -> list[int]:
        """Ids with begin and end; null is encoded as the empty text."""
        ids = array("I", self.packed(text))
        return [self.begin, *ids, self.end]

    def packed(self, text: str | None) -> bytes:
        """Ids without begin and end, as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if not self.by_word:
            return self.parts[SPACE + text.replace(" ", SPACE)]
        if SPACE in text or "  " in text or text[0] == " " or text[-1] == " ":
            marked = SPACE + text.replace(" ", SPACE)
            runs = re.findall(f"{SPACE}+[^{SPACE}]*", marked)
            return b"".join(
                [self.words[run[1:] if run[1:2] != SPACE and len(run) > 1 else run] for run in runs]
            )
        return b"".join(map(self.words.__getitem__, text.split(" ")))

    def _word(self, key: str) -> bytes:
        """A word with its space sign, which the key leaves out unless there are several."""
        word = key if key[:1] == SPACE else SPACE + key
        cuts = [i for i in range(1, len(word)) if word[i - 1 : i + 1] not in self.inside]
        return b"".join(
            [self.parts[word[a:b]] for a, b in zip([0, *cuts], [*cuts, len(word)], strict=True)]
        )

    def _packed(self, part: str) -> bytes:
        ids: list[int] = []
        for piece in self.segment(part):
            known = self.ids.get(piece)
            if known is None:
                ids += [self.byte_ids[b] for b in piece.encode()]
            else:
                ids.append(known)
        return struct.pack(f"<{len(ids)}I", *ids)

    def segment(self, text: str) -> list[str]:
        """Pieces of a marked text; characters that no piece covers stand alone."""
        longest = list(text)
        for end, piece in self.automaton.iter(text):
            longest[end + 1 - len(piece)] = piece  # the last one found from a start is the longest
        fits, dead = self.fits, bytearray(len(text) + 1)
        chosen: list[str] = []
        at, candidate = 0, longest[0] if text else ""
        while at < len(text):
            last = chosen[-1] if chosen else ""
            after = at + len(candidate)
            if not dead[after]:
                agreed = fits.get((last, candidate))
                if agreed is None:
                    agreed = self._agree(last, candidate)
                if agreed:
                    chosen.append(candidate)
                    at = after
                    if at < len(text):
                        candidate = longest[at]
                    continue
            if len(candidate) > 1:
                candidate = self._prefix(candidate)
            else:
                dead[at] = 1
                candidate = chosen.pop()
                at -= len(candidate)
        return chosen

    def _prefix(self, piece: str) -> str:
        """The longest piece that a longer one starts with; a single character at last."""
        found = self.shorter.get(piece)
        if found is None:
            found = next((p for k in range(len(piece) - 1, 1, -1) if (p := piece[:k]) in self.ids), piece[0])
            self.shorter[piece] = found
        return found

    def _agree(self, left: str, right: str) -> bool:
        """Whether merging both afresh gives back these two (or ``right`` alone at the start)."""
        if len(self.fits) > self.most_fits:
            self.fits.clear()
        agreed = self.fits[left, right] = self._merged(left + right) == ([left, right] if left else [right])
        return agreed

    def _merged(self, text: str) -> list[str]:
        symbols, scores = list(text), self.scores
        while True:
            best, where = None, -1
            for i in range(len(symbols) - 1):
                score = scores.get(symbols[i] + symbols[i + 1])
                if score is not None and (best is None or score > best):
                    best, where = score, i
            if best is None:
                return symbols
            symbols[where : where + 2] = [symbols[where] + symbols[where + 1]]

    # Decoding

    def decode(self, ids) -> str:
        """Text of ids; control ids are silent, bytes that form no character become U+FFFD each."""
        ids = list(ids)
        data = b"".join(map(self.bytes_of.__getitem__, ids))
        first = next((i for i in ids if self.types[i] != CONTROL), None)
        if first is not None and self.types[first] == NORMAL and self.pieces[first][0] == SPACE:
            data = data[1:]
        return data.decode("utf-8", "one_mark_a_byte")


class _Fragments(dict):
    """Results by fragment; long fragments aren't kept, and all are dropped when there are too many."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key: str) -> bytes:
        value = self.make(key)
        if len(key) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[key] = value
        return value


def encode_documents(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """``docs`` with a column ``token_ids``: begin id, pieces, end id.

    Null and empty texts give begin and end. Repeated rows are encoded each; other columns, whatever
    their names, stay as they are (a ``token_ids`` column is replaced).
    """

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        codec = per_batch(_loaded, Codec, model_path)
        return texts.map(codec.encode, na_action=None)

    return docs.withColumn("token_ids", ids(F.col(text)))


def decode_documents(encoded: DataFrame, model_path: str, ids: str = "token_ids") -> DataFrame:
    """``encoded`` with a column ``decoded`` of the text; null ids give null."""

    @F.pandas_udf("string")
    def decoded(rows: pd.Series) -> pd.Series:
        codec = per_batch(_loaded, Codec, model_path)
        return rows.map(lambda row: None if row is None else codec.decode(row), na_action=None)

    return encoded.withColumn("decoded", decoded(F.col(ids)))


def round_trip(docs: DataFrame, model_path: str, text: str = "text", fragments: int = FRAGMENTS) -> DataFrame:
    """Encode and decode each text: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    The ids don't leave the worker, so nothing larger than a digest is written. Null texts are empty;
    rows of an equal ``doc_id`` each give a row, null ids too. ``fragments`` bounds what a worker keeps.
    """
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"

    @F.pandas_udf(schema)
    def digests(texts: pd.Series) -> pd.DataFrame:
        codec = per_batch(_loaded, Codec, model_path, fragments)
        begin, end = struct.pack("<I", codec.begin), struct.pack("<I", codec.end)
        rows = []
        for value in texts:
            packed = begin + codec.packed(value) + end
            rows.append(
                (
                    len(packed) // 4,
                    hashlib.sha256(packed).hexdigest(),
                    hashlib.sha256(codec.decode(array("I", packed)).encode()).hexdigest(),
                )
            )
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", digests(F.col(text)).alias("d")).select("doc_id", "d.*")


def model_file(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), model_file())
