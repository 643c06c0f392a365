"""Byte-level BPE over Arrow batches with the ``tokenizers`` library.

Bytes are mapped to printable characters before the merges and back after
them.  Words recur, so every task keeps the ids of recent words and gives the
library's merge model only words it has not seen lately.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from riskloom.llm.common import map_batches, texts

CACHED_WORDS = 600_000
MARKS = tuple(".,;:!?")


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte: itself, or one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


TO_CHARACTER = byte_characters()
TO_BYTE = {c: b for b, c in TO_CHARACTER.items()}


def mapped(data: bytes) -> str:
    return data.decode("latin-1").translate(TO_CHARACTER)


def unmapped(token: str) -> bytes:
    return bytes(map(TO_BYTE.__getitem__, token))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _last_merge(token: bytes, rank: int, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two parts that merge into ``token`` when only lower ranks come before it."""
    parts = [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 2:
        options = [(ranks.get(a + b, rank), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
        best, i = min(options)
        if best >= rank:
            raise ValueError(f"no merges lead to {token!r}")
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts[0], parts[1]


@lru_cache(maxsize=4)
def tokenizer_of_ranks(path: str, pattern: str) -> str:
    """A byte-level tokenizer, as JSON, that merges by the ranks in ``path``."""
    ranks = read_ranks(path)
    merges = [tuple(map(mapped, _last_merge(token, rank, ranks)))
              for token, rank in sorted(ranks.items(), key=lambda x: x[1]) if len(token) > 1]
    made = Tokenizer(models.BPE(vocab={mapped(t): r for t, r in ranks.items()}, merges=merges))
    made.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return made.to_str()


@lru_cache(maxsize=4)
def tokenizer_of_file(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers."""

    # No match of the pattern goes over the border before a space or a line feed that has no
    # white space on either side.  Texts in which no two such characters meet are cut there by
    # plain splitting, others at such spaces only.  Rarer white space is left to the library.
    _other = re.compile(r"[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
    _rare = re.compile(r"[^\S \n\t\r]")
    _border = re.compile(r"(?<=\S) (?=\S)")

    def __init__(self, definition: str, pattern: str):
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text
        self.model = self.tokenizer.model
        self.match = regex.compile(pattern)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes_of: list[bytes] = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, i in vocabulary.items():
            if all(c in TO_BYTE for c in token):
                self.bytes_of[i] = unmapped(token)
        self.names = [str(i) for i in range(len(self.bytes_of))]

    def encode(self, text: str) -> bytes:
        if not self._other.search(text) and text.count(" ") + text.count("\n") + 1 == len(text.split()):
            first, *rest = text.replace("\n", " \n").split(" ")
        elif not self._rare.search(text):
            first, *rest = self._border.split(text)
        else:
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        found = list(map(self.young.get, rest))
        if None in found:
            found = [self._word(w) if ids is None else ids for w, ids in zip(rest, found)]
        return self._merge(first) + b"".join(found)

    def _word(self, word: str) -> bytes:
        """Ids of ``word`` after a space, or after the line feed it starts with.

        Words not met again for long are forgotten.
        """
        ids = self.young.get(word) or self.old.get(word) or self._merge(word if word[0] == "\n" else " " + word)
        if len(self.young) >= CACHED_WORDS:
            self.old, self.young = self.young, {}
        self.young[word] = ids
        return ids

    def _merge(self, text: str) -> bytes:
        return array("I", [token.id for part in self._matches(text)
                           for token in self.model.tokenize(mapped(part.encode()))]).tobytes()

    def _matches(self, text: str) -> list[str]:
        """The matches of the pattern; letters after at most a space and before a mark are told without it."""
        word = text[1:] if text[:1] == " " else text
        if word.isalpha():
            return [text]
        if word[-1:] in MARKS and word[:-1].isalpha():
            return [text[:-1], text[-1]]
        return self.match.findall(text)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode_pieces(self, ids: list[int]) -> Iterator[str]:
        """The text of each id; a character split over ids comes with its last one."""
        whole = codecs.getincrementaldecoder("utf-8")("replace")
        for n, i in enumerate(ids, 1):
            yield whole.decode(self.bytes_of[i], final=n == len(ids))


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(definition: Broadcast, pattern: str) -> Encoder:
    """One encoder for each Python worker and definition."""
    key = (hashlib.sha256(definition.value.encode()).hexdigest(), pattern)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(definition.value, pattern)
    return _ENCODERS[key]


def broadcast_definition(spark: SparkSession, definition: str) -> Broadcast:
    """The vocabulary, read on the driver; its size does not depend on the data."""
    return spark.sparkContext.broadcast(definition)


def encode(docs: DataFrame, definition: str, pattern: str) -> DataFrame:
    """(doc_id, ids, starts, ends): offsets are in code points of the text.

    One row per row of ``docs``, repeated ones too; null text counts as empty
    and has no ids.  Other columns are ignored.
    """
    shared = broadcast_definition(docs.sparkSession, definition)

    def run(batch):
        made = encoder(shared, pattern).tokenizer.encode_batch(batch["text"], add_special_tokens=False)
        yield {"doc_id": batch["doc_id"], "ids": [e.ids for e in made],
               "starts": [[a for a, _ in e.offsets] for e in made],
               "ends": [[b for _, b in e.offsets] for e in made]}

    return map_batches(texts(docs), run, "doc_id bigint, ids array<int>, starts array<int>, ends array<int>")


def decode(encoded: DataFrame, definition: str, pattern: str) -> DataFrame:
    """(doc_id, pieces): the text that each of ``ids`` adds; null ids give null."""
    shared = broadcast_definition(encoded.sparkSession, definition)

    def run(batch):
        enc = encoder(shared, pattern)
        yield {"doc_id": batch["doc_id"],
               "pieces": [None if ids is None else list(enc.decode_pieces(ids)) for ids in batch["ids"]]}

    return map_batches(encoded, run, "doc_id bigint, pieces array<string>", ["doc_id", "ids"])


def round_trip(docs: DataFrame, definition: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), one row per row of ``docs``.

    A null or empty text has no tokens and the digests of empty strings.  Rows
    are handled one by one, so repeated rows and repeated ids are kept.
    """
    shared = broadcast_definition(docs.sparkSession, definition)

    def run(batch):
        enc = encoder(shared, pattern)
        made = {"doc_id": batch["doc_id"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for text in batch["text"]:
            ids = np.frombuffer(enc.encode(text), "<u4").tolist()
            names = " ".join(map(enc.names.__getitem__, ids))
            made["n_tokens"].append(len(ids))
            made["ids_sha256"].append(hashlib.sha256(names.encode()).hexdigest())
            made["decoded_sha256"].append(hashlib.sha256(enc.decode(ids)).hexdigest())
        yield made

    return map_batches(texts(docs), run,
                       "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
