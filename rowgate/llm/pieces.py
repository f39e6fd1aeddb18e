"""SentencePiece models of the merge type: exact encoding by backtracking, and decoding.

A merge-type model joins, again and again, the two neighbouring pieces whose union has
the best score. The result is the one sequence of pieces in which every two neighbours
are *compatible*: merging their joint text alone gives the same two pieces. So instead
of merging whole texts, a text is walked from the left:

1. an Aho-Corasick automaton over all pieces gives the longest match at every place;
2. the longest match that is compatible with the piece before is taken, else the next
   shorter prefix of it that is a piece; compatibility is found by merging the two
   pieces' text again, and remembered;
3. when no match is left, the place before is marked in a bit field as failed, and the
   walk steps back. A failed place is never entered again, whatever leads to it: the
   pieces up to a place are unique, so a place fails once and for all.

Time is linear in the text and so is memory, however long a text or word is. Where no
piece of the model has a space mark after another character, words are encoded one by
one and frequent words are remembered.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Callable, Iterator
from itertools import groupby

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowgate.llm.frames import read, text_of, with_columns

SPACE = "▁"
# Words and pairs of pieces that a Python process remembers. Words are kept in two
# generations of this size: what the older one holds and is met again moves on.
REMEMBERED_WORDS = 350_000
REMEMBERED_PAIRS = 1_000_000
# Longer words are encoded anew each time.
LONGEST_REMEMBERED = 64

# Fixed values of the public model format: kinds of pieces.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)
# Fixed value of the format: the text of an unknown id.
UNKNOWN_TEXT = " ⁇ "


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a serialised message."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (raw[at] & 127) << shift
            shift += 7
            at += 1
            if raw[at - 1] < 128:
                return value, at

    at = 0
    while at < len(raw):
        key, at = number(at)
        kind = key & 7
        if kind == 0:
            value, at = number(at)
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value, at = raw[at : at + size], at + size
        elif kind == 2:
            size, at = number(at)
            value, at = raw[at : at + size], at + size
        else:
            raise ValueError("not a model file")
        yield key >> 3, value


class Model:
    """The pieces of a model file's bytes.

    Raises ValueError for a model that is not of the merge type, normalises text beyond
    marking spaces, has no byte pieces, or has user-defined or unused pieces.
    """

    def __init__(self, raw: bytes):
        self.texts: list[str] = []
        self.kinds: list[int] = []
        scores: list[float] = []
        trainer, rules = {}, {}
        for field, value in _fields(raw):
            if field == 1:
                piece = dict(_fields(value))
                self.texts.append(piece[1].decode("utf-8"))
                scores.append(struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0])
                self.kinds.append(piece.get(3, NORMAL))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                rules = dict(_fields(value))
        self.prefixed = bool(rules.get(3, 1))
        if trainer.get(3, 1) != 2 or not trainer.get(35, 0) or trainer.get(24, 0):
            raise ValueError("not a merge-type model with byte pieces and leading space marks")
        if rules.get(2) or rules.get(4, 1) or not rules.get(5, 1):
            raise ValueError("the model normalises text beyond marking spaces")
        if USER_DEFINED in self.kinds or UNUSED in self.kinds:
            raise ValueError("user-defined and unused pieces are not handled")
        self.ids = {t: i for i, t in enumerate(self.texts) if self.kinds[i] == NORMAL}
        self.scores = {t: scores[i] for t, i in self.ids.items()}
        self.characters = {t for t in self.ids if len(t) == 1}
        if not all(self.characters.issuperset(t) for t in self.ids):
            raise ValueError("a piece holds a character that is no piece")
        named = {t: i for i, t in enumerate(self.texts) if self.kinds[i] == BYTE}
        self.bytes = [named[f"<0x{b:02X}>"] for b in range(256)]
        self.values = {i: b for b, i in enumerate(self.bytes)}
        controls = {t: i for i, t in enumerate(self.texts) if self.kinds[i] == CONTROL}
        self.end = controls.get("</s>")
        self.lengths = [len(t) for t in self.texts]
        self.matches = ahocorasick.Automaton()
        for text, i in self.ids.items():
            self.matches.add_word(text, i)
        self.matches.make_automaton()
        self.shorter = [-1] * len(self.texts)
        for text, i in self.ids.items():
            prefixes = (text[:n] for n in range(len(text) - 1, 0, -1))
            self.shorter[i] = next((self.ids[p] for p in prefixes if p in self.ids), -1)
        # Whether a space mark can only begin a piece, other space marks aside.
        self.by_word = not any(re.search(f"[^{SPACE}]{SPACE}", t) for t in self.ids)
        self.shown = [t.replace(SPACE, " ") if k == NORMAL else "" for t, k in zip(self.texts, self.kinds, strict=True)]
        # A byte below 128 is a character by itself, whatever is around it.
        for byte, i in enumerate(self.bytes[:128]):
            self.shown[i] = chr(byte)
        self.special = frozenset([*self.bytes[128:], *(i for i, k in enumerate(self.kinds) if k == UNKNOWN)])
        self._pairs: dict[int, bool] = {}
        self._words: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text by merging, best score first, leftmost on ties."""
        parts = list(text)
        while len(parts) > 1:
            found = [
                (-self.scores[joint], at)
                for at, joint in enumerate(a + b for a, b in zip(parts[:-1], parts[1:], strict=True))
                if joint in self.scores
            ]
            if not found:
                break
            at = min(found)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, first: int, second: int) -> bool:
        """Whether merging keeps the two pieces apart and whole; ``first`` -1: the second alone."""
        parts = [self.texts[second]] if first < 0 else [self.texts[first], self.texts[second]]
        fits = self.merged("".join(parts)) == parts
        if len(self._pairs) >= REMEMBERED_PAIRS:
            self._pairs.clear()
        self._pairs[first * len(self.texts) + second] = fits
        return fits

    def walked(self, text: str) -> list[int]:
        """The ids of a text that consists of known characters."""
        size, lengths, shorter, known = len(text), self.lengths, self.shorter, self._pairs.get
        longest = [-1] * (size + 1)
        for end, piece in self.matches.iter(text):
            # Ends come in rising order, so what stays at a place is its longest match.
            longest[end - lengths[piece] + 1] = piece
        failed = None
        taken: list[int] = []
        at, piece, before = 0, longest[0], -1
        while at < size:
            row = before * len(lengths)
            while piece >= 0:
                end = at + lengths[piece]
                if failed is None or not failed[end >> 3] >> (end & 7) & 1:
                    fits = known(row + piece)
                    if fits is None:
                        fits = self.compatible(before, piece)
                    if fits:
                        break
                piece = shorter[piece]
            if piece >= 0:
                taken.append(piece)
                at, before = end, piece
                piece = longest[at]
            else:
                if failed is None:
                    failed = bytearray(size // 8 + 1)
                failed[at >> 3] |= 1 << (at & 7)
                piece = taken.pop()
                before = taken[-1] if taken else -1
                at -= lengths[piece]
        return taken

    def word(self, text: str) -> tuple[int, ...]:
        """The ids of a word that the younger generation does not hold."""
        ids = self._older.get(text)
        if ids is None:
            if self.characters.issuperset(text):
                ids = tuple(self.walked(text))
            else:
                # No piece holds an unknown character, so none reaches over one.
                ids = ()
                for usual, run in groupby(text, self.characters.__contains__):
                    part = "".join(run)
                    ids += tuple(self.walked(part)) if usual else tuple(self.bytes[b] for b in part.encode("utf-8"))
        if len(text) <= LONGEST_REMEMBERED:
            if len(self._words) >= REMEMBERED_WORDS:
                self._older, self._words = self._words, {}
            self._words[text] = ids
        return ids

    def encode(self, text: str, end: bool = True) -> list[int]:
        marked = text.replace(" ", SPACE)
        if marked and self.prefixed:
            marked = SPACE + marked
        words = re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", marked) if self.by_word else [marked]
        ids: list[int] = []
        known = self._words.get
        for word in words:
            found = known(word)
            if found is None:
                found = self.word(word)
                known = self._words.get
            ids += found
        return [*ids, self.end] if end else ids

    def decode(self, ids: list[int]) -> str:
        """The text of ids; ids out of range raise IndexError."""
        begin = 0
        while begin < len(ids) and self.kinds[ids[begin]] == CONTROL:
            begin += 1
        strip = self.prefixed and begin < len(ids) and self.texts[ids[begin]].startswith(SPACE)
        if self.special.isdisjoint(ids):
            text = "".join([self.shown[i] for i in ids])
        else:
            parts = []
            for kind, run in groupby(ids, lambda i: self.kinds[i]):
                if kind == BYTE:
                    parts.append(_characters(bytes(self.values[i] for i in run)))
                else:
                    parts += [UNKNOWN_TEXT if kind == UNKNOWN else self.shown[i] for i in run]
            text = "".join(parts)
        return text[1:] if strip else text


def _characters(raw: bytes) -> str:
    """UTF-8 as text; every byte that begins no character becomes U+FFFD by itself."""
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(raw):
            for size in range(1, 5):
                try:
                    out.append(raw[at : at + size].decode("utf-8"))
                except UnicodeDecodeError:
                    continue
                at += size
                break
            else:
                out.append("�")
                at += 1
        return "".join(out)


_MODELS: dict[bytes, Model] = {}


def model_of(raw: bytes) -> Model:
    """The model, built once in every Python process."""
    key = hashlib.sha256(raw).digest()
    if key not in _MODELS:
        _MODELS[key] = Model(raw)
    return _MODELS[key]


def shared_model(spark: SparkSession, path: str) -> Callable[[], Model]:
    """The model of a file that the driver can read, for use in tasks.

    The file goes to the executors as a broadcast: half a megabyte for 32,000 pieces,
    and its size does not depend on the data.
    """
    with open(path, "rb") as file:
        raw = file.read()
    model_of(raw)
    sent = spark.sparkContext.broadcast(raw)
    return lambda: model_of(sent.value)


def encoded(df: DataFrame, model: Callable[[], Model], column: str = "text", end: bool = True) -> DataFrame:
    """``df`` with the ids of a text column as ``ids``, whole texts, null as empty.

    An empty text has the end id only. A column named ``ids`` gives way.
    """

    @F.pandas_udf("array<int>")
    def encode(texts: pd.Series) -> pd.Series:
        pieces = model()
        return pd.Series([np.array(pieces.encode(t, end), np.int32) for t in texts], dtype=object)

    return with_columns(df, ids=encode(text_of(f"`{column}`")))


def decoded(df: DataFrame, model: Callable[[], Model], column: str = "ids") -> DataFrame:
    """``df`` with the text of an array of ids as ``decoded``; null ids give null."""

    @F.pandas_udf("string")
    def decode(ids: pd.Series) -> pd.Series:
        pieces = model()
        return pd.Series([None if i is None else pieces.decode(i.tolist()) for i in ids], dtype=object)

    return with_columns(df, decoded=decode(F.col(f"`{column}`")))


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the text decoded from them."""
    import public_tokenizers

    model = shared_model(spark, public_tokenizers.path("piece_bpe_32k.model"))
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    both = decoded(encoded(docs, model), model)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {"op12_pieces": op12_pieces}
# Merging is iterative; tests compare with the public library on whole texts.
SQL: dict[str, str] = {}
