"""Benchmark decontamination: an FM-index per shard of documents, searched for test phrases.

A shard is what one task has read of consecutive documents, up to
``SHARD_WORDS`` indexed words or ``SHARD_ROWS`` documents.  Its text is the sequence of words that occur in
the searched phrases; a word that occurs in none can be in no occurrence, so it
ends a run, and runs shorter than the shortest phrase are left out.  The text's
suffixes are sorted, its Burrows-Wheeler transform is kept as a wavelet matrix
with prefix counts, and the place in the text of every ``SAMPLE``-th suffix and
of every run's first.  All phrases are searched backwards at once; every row of
their final intervals walks to the nearest kept place.  Occurrences become
spans of words, which are merged.

Documents are never shuffled.  Phrases are sent to tasks in blocks of at most
``BLOCK_BYTES``, one pass over the documents for each block, so neither the
driver nor a task ever holds more of the benchmark than that.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.common import identified, map_batches
from riskloom.llm.spans import merged
from riskloom.sources.storage import materialize

WINDOW = 10
SAMPLE = 8
SHARD_WORDS = 1 << 20
SHARD_ROWS = 1 << 15
BLOCK_BYTES = 16 << 20
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")  # of texts in lower case

# Bytes of words: digits, letters, and all of other alphabets; everything else parts words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isdigit() or 97 <= b <= 122 else 32
              for b in range(256))

_LOWER = str.maketrans(ascii_uppercase, ascii_lowercase)


def words_of(text: str) -> list[bytes]:
    """The words of a text, A-Z in lower case."""
    return text.encode().translate(_FOLD).split()


class Phrases:
    """The distinct windows of a block of items, as word numbers from 1 on."""

    def __init__(self, items: list[tuple[int | None, str]], width: int = WINDOW):
        self.numbers: dict[bytes, int] = {}
        self.items: list[set] = []
        found: dict[tuple, int] = {}
        for item, text in items:
            words = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(text)]
            size = min(width, len(words))
            for i in range(len(words) - size + 1 if words else 0):
                at = found.setdefault(tuple(words[i:i + size]), len(found))
                if at == len(self.items):
                    self.items.append(set())
                self.items[at].add(item)
        self.lengths = np.array([len(p) for p in found], np.int64)
        self.shortest = int(self.lengths.min()) if found else 0
        # the last word of every phrase in the last column, zeros in front
        self.words = np.zeros((len(found), max(self.lengths, default=0)), np.int64)
        for row, phrase in enumerate(found):
            self.words[row, self.words.shape[1] - len(phrase):] = phrase


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Places of ``text`` in order of their suffixes, by doubling; only tied suffixes are sorted again.

    Zeros end suffixes and differ from one another, the earlier one being less.
    """
    n = len(text)
    ends = np.flatnonzero(text == 0)
    key = text + len(ends)
    key[ends] = np.arange(len(ends))
    order = np.argsort(key, kind="stable")
    new = np.r_[True, key[order[1:]] != key[order[:-1]]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    width = 1
    while True:
        # a tied row has an equal neighbour: it is no group of its own
        tied = np.flatnonzero(~(new & np.r_[new[1:], True]))
        if not len(tied):
            return order
        at = order[tied]
        # no tied suffix reaches an end within ``width``, so the place ahead exists
        ahead = rank[at + width]
        within = np.lexsort((ahead, rank[at]))
        at, ahead, own = at[within], ahead[within], rank[at][within]
        order[tied] = at
        new[tied] = np.r_[True, (own[1:] != own[:-1]) | (ahead[1:] != ahead[:-1])]
        rank[at] = np.maximum.accumulate(np.where(new[tied], tied, 0))
        width *= 2


class WaveletMatrix:
    """Counts of a symbol in any prefix of a sequence, and the symbol at a place, by bits."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.levels = []
        for shift in reversed(range(max(1, int(largest).bit_length()))):
            ones = (symbols >> shift) & 1
            before = np.zeros(len(symbols) + 1, np.int64)
            np.cumsum(ones, out=before[1:])
            self.levels.append((shift, before, len(symbols) - before[-1]))
            symbols = np.concatenate([symbols[ones == 0], symbols[ones == 1]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each ``symbol`` occurs before its ``place``."""
        start = np.zeros_like(place)
        for shift, before, zeros in self.levels:
            one = (symbol >> shift) & 1 == 1
            start = np.where(one, zeros + before[start], start - before[start])
            place = np.where(one, zeros + before[place], place - before[place])
        return place - start

    def symbol_and_rank(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place and how often it occurs before."""
        start, symbol = np.zeros_like(place), np.zeros_like(place)
        for _, before, zeros in self.levels:
            one = before[place + 1] - before[place]
            symbol = 2 * symbol + one
            start = np.where(one == 1, zeros + before[start], start - before[start])
            place = np.where(one == 1, zeros + before[place], place - before[place])
        return symbol, place - start


class FMIndex:
    """Backward search over word numbers; zeros in ``text`` end runs, the last place is one."""

    def __init__(self, text: np.ndarray, largest: int):
        order = suffix_order(text)
        last = text[order - 1]  # of the first place: the zero at the end
        self.before = np.r_[0, np.cumsum(np.bincount(text, minlength=largest + 1))]
        self.tree = WaveletMatrix(last, largest)
        kept = (order % SAMPLE == 0) | (last == 0)  # zeros are no symbol to walk over
        self.kept_before = np.r_[0, np.cumsum(kept)]
        self.kept_places = order[kept]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase, low, high) of the phrases that occur: the rows of their suffixes."""
        alive = np.arange(len(phrases))
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.before[-1])
        for back in range(1, phrases.shape[1] + 1):
            going = back <= lengths[alive]
            word = phrases[alive, -back]
            first = self.before[word]
            low = np.where(going, first + self.tree.rank(word, low), low)
            high = np.where(going, first + self.tree.rank(word, high), high)
            some = low < high
            alive, low, high = alive[some], low[some], high[some]
        return alive, low, high

    def locate(self, row: np.ndarray) -> np.ndarray:
        """The place in the text at which the suffix of each row starts."""
        place = np.empty(len(row), np.int64)
        open_, at, steps = np.arange(len(row)), row, 0
        while len(open_):
            kept = self.kept_before[at + 1] > self.kept_before[at]
            place[open_[kept]] = self.kept_places[self.kept_before[at[kept]]] + steps
            open_, at = open_[~kept], at[~kept]
            symbol, rank = self.tree.symbol_and_rank(at)
            at = self.before[symbol] + rank
            steps += 1
        return place


class Shard:
    """Runs of searched words of consecutive documents."""

    def __init__(self, phrases: Phrases):
        self.phrases = phrases
        self.rows: list[tuple[int, int]] = []  # (document, words in it)
        self.runs: list[tuple[int, int, np.ndarray]] = []  # (document's place here, first word, numbers)
        self.size = 0

    def add(self, doc: int, text: str) -> None:
        words = words_of(text)
        here = len(self.rows)
        self.rows.append((doc, len(words)))
        if len(words) < self.phrases.shortest or not self.phrases.shortest:
            return
        known = self.phrases.numbers.get
        numbers = np.fromiter((known(w, 0) for w in words), np.int64, len(words))
        gaps = np.flatnonzero(np.r_[True, numbers == 0, True])
        long = np.flatnonzero(np.diff(gaps) > self.phrases.shortest)
        for first, end in zip(gaps[long].tolist(), (gaps[long + 1] - 1).tolist()):
            self.runs.append((here, first, numbers[first:end]))
            self.size += end - first + 1

    def occurrences(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document's place here, first word, phrase) of every occurrence."""
        none = np.empty(0, np.int64)
        if not self.runs:
            return none, none, none
        sizes = np.array([len(r[2]) + 1 for r in self.runs])
        starts = np.cumsum(sizes) - sizes
        text = np.zeros(sizes.sum(), np.int64)
        for start, run in zip(starts.tolist(), self.runs):
            text[start:start + len(run[2])] = run[2]
        index = FMIndex(text, len(self.phrases.numbers))
        phrase, low, high = index.search(self.phrases.words, self.phrases.lengths)
        count = high - low
        rows = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
        place = index.locate(rows)
        run = np.searchsorted(starts, place, side="right") - 1
        first = np.array([r[1] for r in self.runs])[run] + place - starts[run]
        return np.array([r[0] for r in self.runs])[run], first, np.repeat(phrase, count)

    def results(self) -> dict:
        doc, first, phrase = self.occurrences()
        made = {"doc_id": [d for d, _ in self.rows], "n_words": [n for _, n in self.rows],
                "spans": [[] for _ in self.rows], "items": [[] for _ in self.rows]}
        by_doc = np.argsort(doc, kind="stable")
        cuts = np.flatnonzero(np.r_[True, np.diff(doc[by_doc]) != 0]) if len(doc) else []
        for part in np.split(by_doc, cuts[1:]) if len(doc) else []:
            here = doc[part[0]]
            ends = first[part] + self.phrases.lengths[phrase[part]]
            made["spans"][here] = [{"start": a, "end": b} for a, b in
                                   merged(list(zip(first[part].tolist(), ends.tolist())))]
            made["items"][here] = list(set().union(*[self.phrases.items[p] for p in np.unique(phrase[part])]))
        return made


def find_leaks(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW,
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, spans, items): where documents repeat ``width`` words of a test item.

    ``spans`` are the maximal runs [start, end) of words covered by occurrences,
    by word number; ``items`` the ids of the items that occur, in no order.  An
    item of fewer words has to occur as a whole, one without words never does.
    Occurrences don't go past a document's end.  One row per document, see
    ``identified`` for ids that are null or repeated; null texts have no words.
    Items that repeat an id share it, items without an id mark spans but are
    not listed.  Further columns of either table are not looked at.
    """
    known = identified(docs)
    items = materialize(benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text")
                        .where(F.col("text").isNotNull())
                        .withColumn("size", F.octet_length("text").cast("bigint") + 64))
    size = items.agg(F.sum("size")).first()[0] or 0
    blocks = -(-size // block_bytes) or 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    found = None
    for number in range(blocks):
        rows = items.where(block == number).select("item_id", "text").distinct().collect()
        part = _search(known, Phrases([(r.item_id, r.text) for r in rows], width))
        found = part if found is None else found.unionByName(part)
    if blocks == 1:
        return found
    every = found.groupBy("doc_id").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    return every.withColumn("spans", _united(F.col("spans")))


def _united(spans):
    """Spans joined where they overlap or touch, as ``merged`` does inside a task."""
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def add(done, span):
        last = F.try_element_at(done, F.lit(-1))
        joins = F.coalesce(span["start"] <= last["end"], F.lit(False))
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        return F.when(joins, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(
            F.concat(done, F.array(span)))

    return F.aggregate(F.array_sort(spans), empty, add)


def _search(docs: DataFrame, phrases: Phrases) -> DataFrame:
    """One pass over the documents; the phrases travel with the tasks, once per executor."""
    sent = docs.sparkSession.sparkContext.broadcast(phrases)

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        shard = Shard(sent.value)
        for batch in batches:
            for doc, text in zip(batch["doc_id"], batch["text"]):
                shard.add(doc, text)
                if shard.size >= SHARD_WORDS or len(shard.rows) >= SHARD_ROWS:
                    yield shard.results()
                    shard = Shard(sent.value)
        yield shard.results()

    return map_batches(docs, rows, "doc_id bigint, n_words bigint, "
                       "spans array<struct<start: bigint, end: bigint>>, items array<bigint>",
                       ["doc_id", "text"], streaming=True)


def report(leaks: DataFrame) -> DataFrame:
    """Counts and the digest of the items of ``find_leaks``, one row per document."""
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    ids = F.array_sort(F.transform(F.array_compact("items"), lambda i: i.cast("string")))
    return leaks.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size(ids).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def without_leaks(docs: DataFrame, leaks: DataFrame) -> DataFrame:
    """(doc_id, text) of all documents, every span cut out with what stands between its words."""
    marked = identified(docs).join(leaks.select("doc_id", "spans"), "doc_id")

    def rows(batch):
        cleaned = []
        for text, spans in zip(batch["text"], batch["spans"]):
            if spans:
                words = [m.span() for m in WORD.finditer(text.translate(_LOWER))]
                at, parts = 0, []
                for span in spans:
                    parts.append(text[at:words[span["start"]][0]])
                    at = words[span["end"] - 1][1]
                text = "".join([*parts, text[at:]])
            cleaned.append(text)
        yield {"doc_id": batch["doc_id"], "text": cleaned}

    return map_batches(marked, rows, "doc_id bigint, text string", ["doc_id", "text", "spans"])
