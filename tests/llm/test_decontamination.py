"""The FM-index against plain search."""

import hashlib
import random
import re

import numpy as np
import pytest

from riskloom.llm import decontamination as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS, ITEMS = "doc_id bigint, text string", "item_id bigint, text string"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def expected(docs, items, width=10):
    windows = {}
    for item, text in items:
        words = WORD.findall(lower(text))
        size = min(width, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            windows.setdefault(tuple(words[i:i + size]), set()).add(item)
    found = []
    for doc, text in docs:
        words = WORD.findall(lower(text))
        hit, listed = set(), set()
        for window, who in windows.items():
            for i in range(len(words) - len(window) + 1):
                if tuple(words[i:i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    listed |= who
        ids = sorted(str(i) for i in listed if i is not None)
        found.append((doc, len(words), len(hit), len(ids),
                      hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(found)


def some(seed, vocabulary=4):
    rng = random.Random(seed)
    words = ["a", "B", "é", "9", "Ünd", "x1", "żż"][:vocabulary]

    def text(least, most):
        return "".join(rng.choice(words) + rng.choice([" ", ", ", "\n", "-", "\t\t"]) for _ in range(rng.randint(least, most)))

    items = [(rng.choice([None, *range(30)]), text(0, 16)) for _ in range(12)] + [(40, None), (41, ""), (42, "!?"), (43, "żż")]
    docs = [(i, text(0, 120)) for i in range(40)] + [(100, None), (101, ""), (102, "...")]
    docs += [(200 + i, "z " + items[i % 12][1] + " z" * i + (items[(i + 5) % 12][1] or "")) for i in range(20)]
    docs += [(300 + i, docs[i % 3][1]) for i in range(15)]
    return docs, items


@pytest.mark.parametrize("seed,block", [(1, 1 << 20), (2, 1 << 20), (3, 400)])
def test_against_search(spark, seed, block):
    """With blocks of 400 bytes the phrases go in several passes."""
    docs, items = some(seed, 3 + seed)
    leaks = D.find_leaks(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS),
                         block_bytes=block)
    got = sorted(tuple(r) for r in D.report(leaks).collect())
    assert got == expected(docs, items)


def test_small_shards():
    docs, items = some(8)
    phrases = D.Phrases([i for i in items if i[1] is not None])
    shard, found = D.Shard(phrases), {}
    for i, (doc, text) in enumerate(docs):
        shard.add(doc, text or "")
        if i % 7 == 6:
            made = shard.results()
            found.update(zip(made["doc_id"], made["spans"]))
            shard = D.Shard(phrases)
    made = shard.results()
    found.update(zip(made["doc_id"], made["spans"]))
    wanted = {d[0]: d[2] for d in expected(docs, items)}
    assert {d: sum(s["end"] - s["start"] for s in spans) for d, spans in found.items()} == wanted


def test_index_counts_and_places():
    rng = np.random.default_rng(1)
    text = np.r_[np.tile(rng.integers(0, 4, 60), 5), 0]
    order = D.suffix_order(text)
    ends = np.flatnonzero(text == 0)
    key = text + len(ends)
    key[ends] = np.arange(len(ends))
    assert order.tolist() == sorted(range(len(text)), key=lambda i: key[i:].tolist())
    index = D.FMIndex(text, 3)
    for length in (1, 2, 5, 9):
        phrases = rng.integers(1, 4, (40, length))
        alive, low, high = index.search(phrases, np.full(40, length))
        rows = {int(p): index.locate(np.arange(a, b)) for p, a, b in zip(alive, low, high)}
        for p, phrase in enumerate(phrases):
            want = [i for i in range(len(text) - length + 1) if (text[i:i + length] == phrase).all()]
            assert sorted(rows.get(p, np.empty(0)).tolist()) == want


def test_cut_out(spark):
    items = spark.createDataFrame([(1, "one two three"), (2, "three FOUR")], ITEMS)
    docs = spark.createDataFrame([(1, "Well, One two (three) four! five"), (2, "one two"), (3, None)], DOCS)
    leaks = D.find_leaks(docs, items)
    assert {r.doc_id: r.text for r in D.without_leaks(docs, leaks).collect()} == {1: "Well, ! five", 2: "one two", 3: ""}


def test_empty_tables_ids_and_clashing_columns(spark):
    docs, items = some(5)
    none_docs, none_items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert D.report(D.find_leaks(none_docs, spark.createDataFrame(items, ITEMS))).count() == 0
    clean = D.report(D.find_leaks(spark.createDataFrame(docs, DOCS), none_items)).collect()
    assert len(clean) == len(docs) and not any(r.contaminated for r in clean)
    twice = docs + [(None, "a b"), (0, docs[0][1])]
    clash = spark.createDataFrame([(*d, 1, 2) for d in twice], DOCS + ", spans int, items int")
    both = spark.createDataFrame([(*i, 1) for i in items], ITEMS + ", size int")
    assert sorted(tuple(r) for r in D.report(D.find_leaks(clash, both)).collect()) == expected(docs, items)


def test_very_long_text(spark):
    text = "so it goes on and on and never comes to an end " * 30_000
    docs, items = [(1, text)], [(1, "it goes on and on and never comes to an end so it"), (2, "never to")]
    got = D.report(D.find_leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))).first()
    assert (got.n_words, got.n_items, got.contaminated) == (360_000, 1, True) and got.n_hit > 359_000
