"""Byte-level BPE encoding and decoding by batched merge rounds.

The vocabulary is a tokenizer file (JSON) whose path is a parameter. The driver
reads it and sends a broadcast of fixed size, so executors need no file. Each
task takes bounded slices of whole texts: distinct words of a slice stand in one
flat array of symbols, and every round merges, in each word, its lowest-ranked
pair at all places, found by binary search over the sorted pair keys.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOKENIZER_SETTING = "spark.corpusmill.tokenizer"
SLICE_CHARS = 1 << 20
CACHED_WORDS = 1 << 18
#: Fixed value: how byte-level tokenizers split a text before the merges. White
#: space is the Unicode property.
SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+"
    r"| ?[^{spaces}{letters}{numbers}]+|[{spaces}]+(?![^{spaces}])|[{spaces}]+"
)
_CLASSES = {"letters": r"\p{L}", "numbers": r"\p{N}", "spaces": r"\p{White_Space}"}
#: Latin-1 texts are split by the faster standard engine with spelled-out classes.
_PLAIN_END = "\u0100"
_NO_RANK = np.int64(1 << 40)


def _fill(classes: dict[str, str]) -> str:
    pattern = SPLIT
    for name, members in classes.items():
        pattern = pattern.replace("{" + name + "}", members)
    return pattern


def _plain_classes() -> dict[str, str]:
    """The members of each class below `_PLAIN_END`."""
    chars = "".join(map(chr, range(ord(_PLAIN_END))))
    return {name: re.escape("".join(regex.findall(kind, chars))) for name, kind in _CLASSES.items()}


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte: itself where visible, else from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Sorted pair keys with ranks and results, bytes of each id, special tokens."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, alphabet = spec["model"], byte_alphabet()
        ids: dict[str, int] = model["vocab"]
        if spec.get("normalizer") or model["type"] != "BPE" or model.get("ignore_merges"):
            raise ValueError("a plain byte-level BPE file is needed")
        self.byte_ids = np.array([ids[c] for c in alphabet], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([ids[a] for a, _ in merges], np.int64)
        right = np.array([ids[b] for _, b in merges], np.int64)
        made = np.array([ids[a + b] for a, b in merges], np.int64)
        self._check_order(left, right, made)
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        to_byte = {c: b for b, c in enumerate(alphabet)}
        pieces = dict.fromkeys(range(max([*ids.values(), *self.special.values()]) + 1), b"")
        for token, i in [*ids.items(), *self.special.items()]:
            known = all(c in to_byte for c in token)
            pieces[i] = bytes(to_byte[c] for c in token) if known else token.encode()
        self.piece_ends = np.cumsum([len(pieces[i]) for i in range(len(pieces))])
        self.pieces = np.frombuffer(b"".join(pieces[i] for i in range(len(pieces))), np.uint8)

    def _check_order(self, left: np.ndarray, right: np.ndarray, made: np.ndarray) -> None:
        """Merging all places of a pair at once is right if a pair's parts are made before it."""
        born = np.full(int(made.max(initial=0)) + 1 + int(max(left.max(), right.max())), -1)
        np.maximum.at(born, made, np.arange(len(made)))
        if (np.maximum(born[left], born[right]) >= np.arange(len(made))).any():
            raise ValueError("merges are not in the order in which they were learned")

    def lookup(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of pair keys, and the symbols that they make."""
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        found = self.keys[at] == keys
        return np.where(found, self.ranks[at], _NO_RANK), self.made[at]


def merge_words(vocabulary: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all words in one flat array, and the count of each word."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    symbols = vocabulary.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
    owner = np.repeat(np.arange(len(words)), lengths)
    done_symbols, done_owners = [], []
    while len(symbols):
        same = owner[1:] == owner[:-1]
        ranks, made = vocabulary.lookup(symbols[:-1] << 32 | symbols[1:])
        ranks = np.append(np.where(same, ranks, _NO_RANK), _NO_RANK)
        first = np.flatnonzero(np.append(True, ~same))
        least = np.repeat(np.minimum.reduceat(ranks, first), np.diff(np.append(first, len(owner))))
        open_ = least < _NO_RANK
        done_symbols.append(symbols[~open_])
        done_owners.append(owner[~open_])
        hit = open_ & (ranks == least)
        # In a chain of overlapping places, every second one is merged, from the left.
        places = np.flatnonzero(hit)
        fresh = np.append(True, np.diff(places) > 1)
        start = np.maximum.accumulate(np.where(fresh, places, 0))
        places = places[(places - start) % 2 == 0]
        symbols[places] = made[places]
        open_[places + 1] = False
        symbols, owner = symbols[open_], owner[open_]
    owner = np.concatenate([*done_owners, np.zeros(0, np.int64)])
    symbols = np.concatenate([*done_symbols, np.zeros(0, np.int64)])
    order = np.argsort(owner, kind="stable")
    return symbols[order].astype(np.uint32), np.bincount(owner, minlength=len(words))


def _gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    before = np.cumsum(lengths) - lengths
    return values[np.arange(lengths.sum()) + np.repeat(starts - before, lengths)]


class _Index(dict):
    """Numbers new words in the order in which they are met."""

    def __missing__(self, word: str) -> int:
        self[word] = place = len(self)
        return place


class Encoder:
    """Encodes slices of texts and remembers the symbols of recent words."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.split_any = regex.compile(_fill(_CLASSES)).findall
        self.split_plain = re.compile(_fill(_plain_classes())).findall
        tokens = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, tokens)) + ")") if tokens else None
        self._forget()

    def _forget(self) -> None:
        self.index = _Index((token, i) for i, token in enumerate(self.vocabulary.special))
        self.symbols = [np.array([*self.vocabulary.special.values()], np.uint32)]
        self.counts = [np.ones(len(self.index), np.int64)]

    def split(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.split_any(text)
        return self.split_plain(text)

    def _words(self, text: str) -> list[str]:
        if self.special is None or not any(token in text for token in self.vocabulary.special):
            return self.split(text)
        words: list[str] = []
        for i, piece in enumerate(self.special.split(text)):
            words += [piece] if i % 2 else self.split(piece)
        return words

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the count of each text."""
        if len(self.index) > CACHED_WORDS:
            self._forget()
        words: list[str] = []
        bounds = [0]
        for text in texts:
            words += self._words(text)
            bounds.append(len(words))
        known = len(self.index)
        which = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        if len(self.index) > known:
            new = [word.encode() for word in islice(self.index, known, None)]
            symbols, counts = merge_words(self.vocabulary, new)
            self.symbols, self.counts = (
                [np.concatenate([*self.symbols, symbols])],
                [np.concatenate([*self.counts, counts])],
            )
        lengths = self.counts[0][which]
        ends = np.cumsum(self.counts[0])
        ids = _gather(self.symbols[0], ends[which] - lengths, lengths)
        total = np.append(0, np.cumsum(lengths))
        return ids, np.diff(total[bounds])


def decode(vocabulary: Vocabulary, ids: np.ndarray) -> bytes:
    """The bytes of a text from its ids; broken UTF-8 is replaced as usual."""
    ends = vocabulary.piece_ends[ids]
    starts = np.where(ids > 0, vocabulary.piece_ends[np.maximum(ids.astype(np.int64), 1) - 1], 0)
    data = _gather(vocabulary.pieces, starts, ends - starts).tobytes()
    return data.decode("utf-8", "replace").encode()


def _slices(texts: pa.Array) -> Iterator[list[str]]:
    part, size = [], 0
    for text in texts:
        value = text.as_py() or ""
        if part and size + len(value) > SLICE_CHARS:
            yield part
            part, size = [], 0
        part.append(value)
        size += len(value)
    if part:
        yield part


def tokenizer_path() -> str:
    """The production vocabulary; any byte-level BPE file of the same format will do."""
    import public_tokenizers  # here, so that other queries need no vocabulary

    return public_tokenizers.path("byte_bpe_50k.json")


def broadcast_vocabulary(spark: SparkSession, path: str | None = None) -> Broadcast[Vocabulary]:
    """The vocabulary at `path`, or at the session's setting `TOKENIZER_SETTING`, or the production one."""
    path = path or spark.conf.get(TOKENIZER_SETTING, None) or tokenizer_path()
    return spark.sparkContext.broadcast(Vocabulary(path))


def encode_texts(
    table: DataFrame, vocabulary: Broadcast[Vocabulary], key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of `table`: its key and `ids`, an array of token ids.

    A null or empty text has no ids. Special tokens in a text are matched as
    such. Repeated rows give repeated rows; other columns are left out.
    """
    kept = table.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))

    def run(batches):
        encoder = Encoder(vocabulary.value)
        for batch in batches:
            at = 0
            for texts in _slices(batch["text"]):
                ids, counts = encoder.encode(texts)
                offsets = np.append(0, np.cumsum(counts)).astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch["key"].slice(at, len(texts)), column], ["key", "ids"])
                at += len(texts)

    kind = kept.schema["key"].dataType.simpleString()
    return kept.mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decode_ids(
    table: DataFrame, vocabulary: Broadcast[Vocabulary], key: str = "doc_id", ids: str = "ids"
) -> DataFrame:
    """One row per row of `table`: its key and the `text` of its ids; null ids give an empty text."""
    kept = table.select(F.col(f"`{key}`").alias("key"), F.col(f"`{ids}`").alias("ids"))

    def run(batches):
        for batch in batches:
            values = (row.values.to_numpy(zero_copy_only=False) if row.is_valid else np.zeros(0, np.int32) for row in batch["ids"])
            texts = pa.array([decode(vocabulary.value, v.astype(np.uint32)).decode() for v in values], pa.string())
            yield pa.RecordBatch.from_arrays([batch["key"], texts], ["key", "text"])

    kind = kept.schema["key"].dataType.simpleString()
    return kept.mapInArrow(run, f"key {kind}, text string").withColumnRenamed("key", key)


def token_counts(
    table: DataFrame, vocabulary: Broadcast[Vocabulary], key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of `table`: its key and `n_tokens`; rules as for `encode_texts`."""
    kept = table.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))

    def run(batches):
        encoder = Encoder(vocabulary.value)
        for batch in batches:
            counts = [np.zeros(0, np.int64), *[encoder.encode(texts)[1] for texts in _slices(batch["text"])]]
            yield pa.RecordBatch.from_arrays([batch["key"], pa.array(np.concatenate(counts).astype(np.int64))], ["key", "n_tokens"])

    kind = kept.schema["key"].dataType.simpleString()
    return kept.mapInArrow(run, f"key {kind}, n_tokens bigint").withColumnRenamed("key", key)


def token_digests(
    table: DataFrame, vocabulary: Broadcast[Vocabulary], key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row: key, `n_tokens`, digests of the ids and of the decoded text.

    The ids (`ids_sha256`) count as little-endian unsigned 32-bit integers, the
    decoded text (`decoded_sha256`) as UTF-8. Encoding and decoding run in one
    pass, so the ids themselves are never shipped. A null or empty text has no ids;
    long ones are encoded whole, in slices of bounded size. Repeated rows give
    repeated rows, an empty table an empty result; other columns are left out.
    """
    kept = table.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    names = ["key", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches):
        encoder = Encoder(vocabulary.value)
        for batch in batches:
            counts, digests, decoded = [], [], []
            for texts in _slices(batch["text"]):
                ids, lengths = encoder.encode(texts)
                at = 0
                for n in lengths.tolist():
                    own = ids[at : at + n]
                    at += n
                    counts.append(n)
                    digests.append(hashlib.sha256(own.astype("<u4").tobytes()).hexdigest())
                    decoded.append(hashlib.sha256(decode(vocabulary.value, own)).hexdigest())
            columns = [batch["key"], pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = kept.schema["key"].dataType.simpleString()
    made = kept.mapInArrow(run, f"key {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    return made.withColumnRenamed("key", key)
