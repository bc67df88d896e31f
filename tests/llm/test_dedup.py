"""Exact and near dedup, against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ferrylane.llm import bloom, exact_dedup, minhash
from ferrylane.llm.common import Workspace
from ferrylane.llm.components import components
from ferrylane.llm.shingles import shingle_sets

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def folded(text):
    return (text or "").translate(LOWER)


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def grouped(ids, links):
    """The smallest id that each reaches."""
    parent = {i: i for i in ids}
    for a, b in links:
        a, b = find(parent, a), find(parent, b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {i: find(parent, i) for i in ids}


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", folded(text))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def similar(texts):
    """All links of {id: text}, by comparing every pair that shares a shingle."""
    sets, holders = {i: shingles(t) for i, t in texts.items()}, defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    shared = Counter((a, b) for ids in holders.values() for a in ids for b in ids if a < b)
    return sets, [(a, b) for (a, b), n in shared.items() if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n)]


def check_near(spark, texts, **options):
    sets, links = similar(texts)
    want = grouped(texts, links)
    got = minhash.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3), **options).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (len(sets[i]), c, c == i) for i, c in want.items()}
    return links


def test_shingles_are_those_of_the_words():
    texts = ["a b c d e f", "A\tB  c\nd e\x0bf", "a b", "b a", "", None, "  ", "a b c d e a b c d e a b c d e", "é b c d É", "é b c d é", "x" * 9000, " "]
    got = list(shingle_sets(pa.array(texts)))
    assert [len(s) for s in got] == [len(shingles(t)) for t in texts]
    for a in range(len(texts)):
        for b in range(len(texts)):
            assert len(set(got[a].tolist()) & set(got[b].tolist())) == len(shingles(texts[a]) & shingles(texts[b]))


@pytest.mark.parametrize("k", [8, 64])
def test_near_duplicates_equal_brute_force(llm, k):
    rng = random.Random(k)
    words = [f"w{i}" for i in range(400)]
    passage = rng.choices(words, k=40)
    texts, i = {}, 0
    for group in range(12):
        base = rng.choices(words, k=rng.choice([3, 5, 7, 30, 90, 300])) + (passage if group % 3 == 0 else [])
        for _ in range(rng.choice([1, 3, 9])):
            copy = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 12)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts[i := i + rng.randrange(1, 4)] = rng.choice([" ", "\n", "  "]).join(copy)
    assert check_near(llm, texts, k=k)


def test_a_large_group_of_near_copies_with_a_common_passage(llm):
    """More members than a short list has, edited so that many pairs are similar and many are not."""
    rng = random.Random(5)
    base, texts = [f"b{i}" for i in range(120)], {}
    for i in range(160):
        copy = list(base)
        for place in rng.sample(range(120), rng.choice([0, 1, 2, 3, 4, 6])):
            copy[place] = f"new{rng.randrange(10**6)}"
        texts[i] = " ".join(copy)
    for i in range(160, 220):
        texts[i] = " ".join(base[:50] + [f"own{rng.randrange(10**6)}" for _ in range(rng.choice([10, 20, 60]))])
    assert check_near(llm, texts)


def test_near_duplicates_of_messy_rows(messy, nothing, rows_of):
    got = rows_of(minhash.near_duplicates(messy), "doc_id", "n_shingles", "component_id", "kept")
    assert len(got) == messy.count()
    assert [r for r in got if r[0] in (4, 5, 6)] == [(4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True)]
    assert {r[2] for r in got if r[0] in (1, 2)} == {1} and {r[2] for r in got if r[0] in (7, 8)} == {7}
    assert {r[2] for r in got if r[0] in (9, 10)} == {9}
    assert [r[2:] for r in got if r[0] is None] == [(None, True)] * 2
    kept = minhash.keep_one_of_each(messy)
    assert kept.columns == messy.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((r[0] for r in got if r[3]), key=str)
    assert minhash.near_duplicates(nothing).isEmpty() and minhash.keep_one_of_each(nothing).isEmpty()


def test_components_of_chains_stars_and_cycles(llm):
    links = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 160)] + [(201, 200), (202, 201), (200, 202), (300, 300)]
    got = components(Workspace(llm, "t"), llm.createDataFrame(links, "a long, b long"))
    ids = {x for a, b in links for x in (a, b) if a != b}
    assert {r.id: r.component_id for r in got.collect()} == grouped(ids, [p for p in links if p[0] != p[1]])
    assert components(Workspace(llm, "t"), llm.createDataFrame([], "a long, b long")).isEmpty()


def test_filters_do_not_fill_up(llm):
    """Rows that one filter would have no room for: hardly any but the repeats are taken for repeats."""
    texts = [(i, f"text {i}") for i in range(20_000)] + [(20_000 + i, f"TEXT {i}") for i in range(100)]
    docs = llm.createDataFrame(texts, "doc_id long, text string").repartition(5)
    ws = Workspace(llm, "t")
    keyed = ws.save(exact_dedup.with_digest(docs, "text", "digest", ["doc_id"]), "digests")
    flagged = exact_dedup._possible_repeats(ws, keyed, 16, 1 << 16)
    assert flagged.count() == 20_100 and 200 <= flagged.where("maybe").count() < 1200
    kept = exact_dedup.deduplicate(docs, max_bits=1 << 16)
    assert kept.count() == 20_000 and {r.doc_id for r in kept.where("doc_id < 100").collect()} == set()
    assert exact_dedup.equal_texts(docs, max_bits=1 << 16).where("NOT kept").count() == 100


@pytest.mark.parametrize("max_bits", [1 << 16, 1 << 28])
def test_equal_texts_of_messy_rows(messy, rows_of, max_bits):
    texts = [(r.doc_id, folded(r.text)) for r in messy.collect()]
    groups = defaultdict(list)
    for doc_id, text in texts:
        groups[text].append(doc_id)
    largest = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    got = rows_of(exact_dedup.equal_texts(messy.repartition(4), max_bits=max_bits), "doc_id", "keep_id", "group_size", "kept", F.hex("digest"))
    assert got == sorted(((i, largest[t], len(groups[t]), i == largest[t], hashlib.sha256(t.encode()).hexdigest().upper()) for i, t in texts), key=repr)
    kept = exact_dedup.deduplicate(messy.repartition(4), max_bits=max_bits)
    assert kept.columns == messy.columns
    assert sorted((folded(r.text), r.doc_id) for r in kept.collect()) == sorted((t, i) for t, i in largest.items())


def test_a_full_filter_only_costs_shuffling(llm):
    """More rows than bits: nearly every row is taken for a possible repeat, and the answer stays."""
    docs = llm.range(70_000).select("id", F.concat(F.lit("t"), F.col("id") % 69_999).alias("text")).withColumnRenamed("id", "doc_id")
    got = exact_dedup.equal_texts(docs, bits_per_row=1, max_bits=1 << 16)
    assert got.where("not kept").count() == 1 and got.count() == 70_000


def test_no_texts(nothing):
    assert exact_dedup.equal_texts(nothing).isEmpty() and exact_dedup.deduplicate(nothing).isEmpty()


def test_rows_without_an_equal_are_not_shuffled(llm, plan_of):
    docs = llm.range(1000).selectExpr("id as doc_id", "concat('t', id) as text")
    below = plan_of(exact_dedup.equal_texts(docs)).split("== Physical Plan ==")[1].split("Union\n")[1]
    alone = [line for line in below.splitlines() if line.lstrip().startswith(":")]
    assert len(alone) > 1 and not any("Exchange" in line for line in alone)


def test_id_filters(messy, llm, rows_of):
    ids = llm.createDataFrame([(1,), (9,), (None,), (77,)], "x long")
    have = [r[0] for r in rows_of(bloom.with_ids(messy, ids), "doc_id")]
    lack = [r[0] for r in rows_of(bloom.without_ids(messy, ids), "doc_id")]
    assert sorted(have) == [1, 1, 9, 9] and len(have) + len(lack) == messy.count() and None in lack
    assert bloom.with_ids(messy, ids).columns == messy.columns


def near_copies(n, seed=7):
    """Copies of one text of 70 words, with one word to six replaced."""
    rng, base, texts = random.Random(seed), [f"b{i}" for i in range(70)], {}
    for i in range(n):
        copy = list(base)
        for place in rng.sample(range(70), rng.choice([1, 2, 3, 6])):
            copy[place] = f"new{i}x{place}"
        texts[i] = " ".join(copy)
    return texts


def test_the_parities_of_similar_texts_never_speak_against_them(llm):
    texts = near_copies(40) | {100 + i: " ".join(f"w{j % (i + 2)}" for j in range(30 * i)) for i in range(8)}
    sets, links = similar(texts)
    ids = pa.RecordBatch.from_arrays([pa.array(list(texts)), pa.array(list(texts.values()))], names=["doc_id", "text"])
    found = llm.createDataFrame(pa.Table.from_batches([minhash._full_sets(ids)])).selectExpr("doc_id", "size(shingles) AS n", "parities")
    assert {r.doc_id: r.n for r in found.collect()} == {i: len(s) for i, s in sets.items()}
    left, right = found.toDF("a", "n_a", "left"), found.toDF("b", "n_b", "right")
    both = left.join(right, F.col("a") < F.col("b"))
    n = F.col("n_a") + F.col("n_b")
    passed = {(r.a, r.b) for r in both.where(minhash._may_be_similar(n, n, "left", "right")).collect()}
    assert set(links) <= passed
    assert len(passed) < both.count() / 2


def test_a_group_s_largest_component_leads_no_more(llm):
    rows = [(1, d, 30, 29 if d == 18 else 25, 20, 0 if d < 15 else d, 0) for d in range(20)]
    members = llm.createDataFrame(rows, "value long, doc_id long, n int, remaining int, in_list int, component_id long, largest long")
    members = members.withColumn("parities", F.lit(None).cast("struct<" + ", ".join(f"w{i}: bigint" for i in range(8)) + ">"))
    leaders = minhash._leaders(members, 4096, 1)
    assert {r.leader for r in leaders.collect()} == set(range(15, 20))
    first = minhash._leaders(members, 1, 0)
    assert [r.leader for r in first.collect()] == [18]
    lists = minhash._open_lists(members.select("value", "doc_id", "component_id")).collect()
    assert [tuple(r) for r in lists] == [(1, 20, 0)]
