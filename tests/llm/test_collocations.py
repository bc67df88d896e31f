"""Transducers against dictionaries, collocations against counts of all phrases."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from ferrylane.llm import collocations
from ferrylane.llm.transducers import Transducer, build, union


def random_keys(seed, n=300):
    rng = random.Random(seed)
    return {tuple(rng.choice(["a", "b", "é", "of", "\x01"]) for _ in range(rng.randint(1, 5))): rng.randint(0, 50) for _ in range(n)}


@pytest.mark.parametrize("seed", [1, 2])
def test_transducers_hold_what_was_added(seed):
    one, two = random_keys(seed), random_keys(seed + 10)
    a, b = build(sorted(one.items())), build(sorted(two.items()))
    assert list(a.items()) == sorted(one.items())
    assert len({s for s in a.states}) == len(a.states)  # minimal: no two states alike
    summed = Counter(one) + Counter({k: 0 for k in two})
    summed = {k: one.get(k, 0) + two.get(k, 0) for k in {*one, *two}}
    assert list(union([a, b]).items()) == sorted(summed.items())
    assert dict(union([a, b], 30).items()) == {k: n for k, n in summed.items() if n >= 30}
    assert dict(a.compose(b)) == {k: one[k] for k in one.keys() & two.keys()}
    assert list(Transducer.from_row(a.row()).items()) == sorted(one.items())
    assert list(build([]).items()) == [] == list(union([]).items()) and Transducer.from_row(build([]).row()).states == build([]).states


def test_equal_ends_are_stored_once():
    keys = [(x, "in", "the", y) for x in "abcdefgh" for y in "rst"]
    assert len(build((k, 7) for k in sorted(keys)).states) == 5


def brute(rows, least, shown):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", folded):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            own = counts.setdefault(lang, Counter())
            for n in range(1, 6):
                own.update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, own in counts.items():
        frequent = {p: a for p, a in own.items() if a >= least and len(p) > 1}
        scored = []
        for p, a in frequent.items():
            if any(len(q) > len(p) and 100 * b >= 100 * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in frequent.items()):
                continue
            score, k = min((1000 * a * totals[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:shown], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def texts(seed):
    rng = random.Random(seed)
    vocabulary = ["The", "the", "of", "State", "in", "New", "York", "city\x01", "é", "a-b"]
    weights = [9, 9, 7, 2, 6, 3, 3, 2, 1, 1]
    rows = []
    for i in range(120):
        words = rng.choices(vocabulary, weights, k=rng.randint(0, 60))
        rows.append(("".join(w + rng.choice([" ", "  ", "\t", " ", ". ", ",", "\n", "\r", " "]) for w in words), rng.choice(["en", "fr", None])))
    return rows + [(None, "en"), ("", None), ("ha ha ha ha ha ha " * 30_000, "en"), ("New York City Hall. " * 30, "fr"), ("new york city hall", None)]


@pytest.mark.parametrize("tight", [False, True])
def test_collocations_equal_counts_of_all_phrases(llm, monkeypatch, tight):
    if tight:  # many ranges and rounds of unions, and filters that are filled in tasks
        for name, value in (("RANGE_PHRASES", 4), ("FAN_IN", 2), ("GATHERED", 0)):
            monkeypatch.setattr(collocations, name, value)
    shown = 25 if tight else 2000
    rows = [(t[:3000] if tight and t else t, lang) for t, lang in texts(4)]
    df = llm.createDataFrame(rows, "text string, lang string").selectExpr("1 AS n", "text", "lang", "'x' AS phrase", "0 AS hash")
    got = collocations.collocations(df.repartition(3), least=5, shown=shown)
    want = brute(rows, 5, shown)
    assert sorted(tuple(r) for r in got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()) == want
    assert len({r[0] for r in want}) == 3
    assert tight or {r[2].count(" ") for r in want} == {1, 2, 3, 4} and "new york city hall" in {r[2] for r in want}


def test_tasks_that_hold_little_and_filters_that_let_all_through(monkeypatch):
    """The passes by themselves: what is handed on early adds up to the same, and a full filter changes no count."""
    for name, value in (("HELD_PHRASES", 5), ("HELD_HASHES", 20), ("HELD_BYTES", 1)):
        monkeypatch.setattr(collocations, name, value)
    monkeypatch.setattr(collocations.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 3})())
    texts = [["a b a b. a b", "b a, a b"], [None, "a b a"]]
    batches = [pa.RecordBatch.from_arrays([pa.array(["x", "y"]), pa.array(t, pa.string())], names=["lang", "text"]) for t in texts]
    full = type("Shared", (), {"value": b"\xff" * 8192})()
    counts, parts, shards = Counter(), Counter(), []
    for made in collocations._mine(2, full, 65536, 4, True)(iter(batches)):
        for row in made.to_pylist():
            if row["kind"] == collocations._AUTOMATON:
                shards.append(row["shard"])
                for key, n in Transducer.from_row(row).items():
                    assert collocations.prefix_range(key, 4) == row["prefix"]
                    counts[row["lang"], " ".join(key)] += n
            elif row["kind"] == collocations._STRETCH:
                parts[row["lang"], row["text"]] += 1
    assert counts == {("x", "a b"): 3, ("x", "b a"): 1, ("y", "b a"): 2, ("y", "a b"): 2} and len(shards) > 2
    assert parts == {("x", "a b a b"): 1, ("y", "a b a"): 1}


def test_no_rows_and_no_frequent_phrases(llm, nothing, messy):
    assert collocations.collocations(nothing).isEmpty()
    assert collocations.collocations(messy, least=10**6).isEmpty()
    assert collocations.collocations(messy, least=40).where("phrase = 'quick1 the0'").isEmpty()
