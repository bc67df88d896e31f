"""Spelling variants against all pairs."""

import random
import re
import zlib

import pytest

from ferrylane.llm import spelling


def brute_words(rows):
    counts = {}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 6:
                counts[run] = counts.get(run, 0) + 1
    return {w: n for w, n in counts.items() if n >= 5}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts):
    near = {w: [v for v in counts if one_apart(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {(w, form[w], root(w), counts[w], len(near[w]), counts.get(form[w])) for w in counts}


def chained(seed, n):
    """Words and near words of them, some in chains of rising counts."""
    rng, counts = random.Random(seed), {}
    for _ in range(n):
        word = "".join(rng.choice("aeéstÿ") for _ in range(rng.randint(6, 9)))
        for i in range(rng.randint(1, 4)):
            counts[word] = 5 * 6**i + rng.randint(0, 3)
            at = rng.randrange(len(word))
            word = rng.choice([word[:at] + word[at + 1:], word[:at] + rng.choice("aesñ") + word[at + rng.randint(0, 1):]])
    return {w: c for w, c in counts.items() if len(w) >= 6}


def got(df):
    return {tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


@pytest.mark.parametrize("small_blocks", [False, True])
def test_variants_equal_all_pairs(llm, monkeypatch, small_blocks):
    if small_blocks:  # deep keys, cut subtrees
        for name, value in (("SUBTREE_WORDS", 2), ("BLOCK_WORDS", 3)):
            monkeypatch.setattr(spelling, name, value)
    counts = chained(1, 40 if small_blocks else 250)
    want = brute(counts)
    assert any(r[1] and r[2] != r[1] for r in want) and max(r[4] for r in want) > 2
    assert got(spelling.variants(llm.createDataFrame(list(counts.items()), "word string, n long").repartition(3))) == want


def test_words_of_texts(llm, messy, nothing):
    rng = random.Random(3)
    vocabulary = ["letter", "lettter", "Létter", "ÀÉ×÷ÿabc", "needle", "needles", "sixsix", "x" * 3000]
    rows = [(i if i % 7 else None, " ".join(rng.choice(vocabulary) for _ in range(300)) + ("Ā" if i % 2 else "")) for i in range(40)]
    rows += [(1, "LETTER-letter9letter " * 60_000), (2, None), (2, ""), (2, "needle needle")]
    counts = brute_words(rows)
    assert len(counts) > len(vocabulary)  # some lost a letter
    df = llm.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {tuple(r) for r in spelling.counted_words(df).collect()} == set(counts.items())
    assert spelling.spelling_variants(nothing).isEmpty()
    assert {r[0] for r in got(spelling.spelling_variants(messy))} == set(brute_words([(r.doc_id, r.text) for r in messy.collect()]))


@pytest.mark.parametrize("small, held", [(0, 1), (20, 100), (1 << 14, 1 << 21)])
def test_every_pair_is_met_once(monkeypatch, small, held):
    monkeypatch.setattr(spelling, "SMALL", small)
    monkeypatch.setattr(spelling, "HELD_LETTERS", held)
    counts = list(chained(5, 300))
    by_length = {}
    for w in counts:
        by_length.setdefault(len(w), []).append(w)
    pairs = []
    for length, members in by_length.items():
        tree = spelling.Subtree(members)
        for queries in (members, by_length.get(length - 1, [])):
            m, q = tree.near(queries)
            pairs += [frozenset((members[i], queries[j])) for i, j in zip(m, q)]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {frozenset((a, b)) for a in counts for b in counts if a < b and one_apart(a, b)}
