"""Pieces, token counts and token files, against the libraries and as round trips."""

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ferrylane.llm import pieces, range_coder, token_counts, token_files
from ferrylane.session import scratch_path

TEXTS = st.lists(st.one_of(
    st.text(max_size=12), st.sampled_from(["the ", "tokeniser", "  ", "\n", " \n ", "\t", "<|endoftext|>", "don't", "1234", "é", "é", "ß", "Σ ", "日本語",
                                           "\x1c", "\u0085", " ", "🙂", "▁", "!!", " ?"])), max_size=15).map("".join)


@pytest.fixture(scope="module")
def model(path_of):
    with open(path_of("piece_bpe_32k.model"), "rb") as file:
        return pieces.Pieces(file.read())


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(TEXTS, min_size=1, max_size=5), rate=st.sampled_from([0.0, 0.1, 0.5, 1.0]), seed=st.integers(0, 3))
def test_pieces_decode_without_loss(model, texts, rate, seed):
    got = pieces.encode(model, texts, range(len(texts)), pieces.Dropout(rate, seed))
    assert [pieces.decode(model, ids) for ids in got] == texts
    again = pieces.encode(model, texts[::-1], list(range(len(texts)))[::-1], pieces.Dropout(rate, seed))[::-1]
    assert all((a == b).all() for a, b in zip(got, again))


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(TEXTS.filter(lambda t: "▁" not in t), min_size=1, max_size=5))
def test_without_dropout_pieces_are_the_library_s(model, texts):
    got = pieces.encode(model, texts, range(len(texts)), pieces.Dropout(0, 0))
    assert [ids.tolist() for ids in got] == [model.library.encode(t) for t in texts]


@pytest.mark.parametrize("rate", [0.0, 0.3])
def test_both_agendas_agree(model, monkeypatch, rate):
    texts = ["unbelievable internationalisation of words", "aaaaaaaaaaaaaaaaaaaaaaaaaa", "no" * 30, "x" * 400, "日本語テキスト" * 40]
    side = pieces.encode(model, texts, range(5), pieces.Dropout(rate, 1))
    monkeypatch.setattr(pieces, "WIDTHS", ())
    heap = pieces.encode(model, texts, range(5), pieces.Dropout(rate, 1))
    assert [a.tolist() for a in side] == [b.tolist() for b in heap]


def merged_one_by_one(model, text, key, rate, seed):
    """Merge-dropout by its definition: of all neighbours that may merge and are not skipped the best, the leftmost of equals; over and over."""
    def scramble(x):
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ x >> shift) * factor % 2**64
        return x ^ x >> 31

    digest = lambda t: int.from_bytes(hashlib.blake2b(t.encode(), digest_size=8).digest(), "big")
    row = digest(f"{digest(str(seed))}:{key}")

    def skipped(start, middle, end):
        place = (start * 0x9E3779B97F4A7C15 + middle * 0xC2B2AE3D27D4EB4F + end * 0x165667B19E3779F9) % 2**64
        return scramble(row ^ scramble(place)) < min(int(rate * 2**64), 2**64 - 1)

    sp = model.library
    known = {sp.id_to_piece(i): i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
    symbols = [(i, i + 1, "▁" if c == " " else None if c == "▁" or c not in known else c, c) for i, c in enumerate(" " + text if text else "")]
    while True:
        best = None
        for i, (a, b) in enumerate(zip(symbols, symbols[1:])):
            if a[2] and b[2] and a[2] + b[2] in known and not skipped(a[0], a[1], b[1]):
                offer = (-sp.get_score(known[a[2] + b[2]]), i)
                best = offer if best is None else min(best, offer)
        if best is None:
            break
        a, b = symbols[best[1]:best[1] + 2]
        symbols[best[1]:best[1] + 2] = [(a[0], b[1], a[2] + b[2], None)]
    out = []
    for _, _, name, char in symbols:
        out += [known[name]] if name else [sp.piece_to_id(f"<0x{x:02X}>") for x in char.encode()]
    return out


@settings(max_examples=60, deadline=None)
@given(text=TEXTS, rate=st.sampled_from([0.0, 0.1, 0.5, 0.9, 1.0]), seed=st.integers(0, 3), key=st.sampled_from([0, -7, "a:1", None]))
def test_dropout_is_what_merging_one_by_one_gives(model, text, rate, seed, key):
    got = pieces.encode(model, [text], [key], pieces.Dropout(rate, seed))
    assert got[0].tolist() == merged_one_by_one(model, text, key, rate, seed)


def test_long_stretches_are_merged_one_by_one_as_well(model):
    for text in ("internationalisation" * 8, "na" * 70, "the quick  brown fox " * 6):
        got = pieces.encode(model, [text], [5], pieces.Dropout(0.2, 1))
        assert got[0].tolist() == merged_one_by_one(model, text, 5, 0.2, 1)


def test_dropout_varies_with_row_and_seed(model):
    text = "internationalisation considerations"
    cut = {tuple(pieces.encode(model, [text], [row], pieces.Dropout(0.3, seed))[0]) for row in range(8) for seed in range(3)}
    assert len(cut) > 10


def test_a_model_that_changes_texts_is_refused(monkeypatch, path_of):
    import sentencepiece

    monkeypatch.setattr(sentencepiece.SentencePieceProcessor, "normalize", lambda self, t: t.strip())
    with open(path_of("piece_bpe_32k.model"), "rb") as file, pytest.raises(ValueError, match="changes texts"):
        pieces.Pieces(file.read())


def test_pieces_of_messy_rows(messy, nothing, path_of):
    got = pieces.with_pieces(messy, path_of("piece_bpe_32k.model"))
    assert got.columns == [*messy.columns, "_pieces"]
    whole = pieces.cut(messy, path_of("piece_bpe_32k.model"), 0.1, 0).collect()
    assert len(whole) == messy.count() and all(r.lossless and r.n_pieces == len(r.pieces) for r in whole)
    assert {r.n_pieces for r in whole if r.doc_id in (4, 5)} == {0}
    assert pieces.with_pieces(nothing, path_of("piece_bpe_32k.model")).isEmpty()


@pytest.fixture(scope="module", params=["byte_bpe_50k.json", "word_bpe_49k.json"])
def tokenizer(request, path_of):
    with open(path_of(request.param), "rb") as file:
        return file.read()


@settings(max_examples=150, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(TEXTS, min_size=1, max_size=5))
def test_counts_by_segment_are_the_library_s(tokenizer, texts):
    counter = token_counts.Counter(tokenizer)
    library = Tokenizer.from_str(tokenizer.decode())
    assert counter.counts(texts) == [len(library.encode(t, add_special_tokens=False)) for t in texts]


@settings(max_examples=150, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(TEXTS, min_size=1, max_size=5))
def test_ids_by_word_are_the_library_s(tokenizer, texts):
    library = Tokenizer.from_str(tokenizer.decode())
    got = token_files.WordEncoder(tokenizer).encode(texts)
    assert [ids.tolist() for ids in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_only_odd_words_pass_the_whole_library(path_of):
    class Counting:
        asked: list[str] = []

        def encode_batch_fast(self, texts, add_special_tokens):
            self.asked += texts
            return library.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    library = Tokenizer.from_file(path_of("word_bpe_49k.json"))
    with open(path_of("word_bpe_49k.json"), "rb") as file:
        encoder = token_files.WordEncoder(file.read())
    encoder.tokenizer = Counting()
    texts = ["The cat, the CAT'S 12 na\u00efve Stra\u00dfe; \u00c4rger!'s", "", " the\tcat<|endoftext|> \u0130x e\u0301 the"]
    assert [ids.tolist() for ids in encoder.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert sorted(Counting.asked) == sorted(["cat<|endoftext|>", "\u0130x", "e\u0301"])


def test_which_tokenizers_may_be_cut(path_of):
    read = {n: open(path_of(f"{n}_bpe_{k}k.json"), "rb").read() for n, k in (("byte", 50), ("word", 49))}
    assert token_counts.splits_at_spaces(read["byte"]) and not token_counts.splits_at_spaces(read["word"])
    import json

    assert token_files.splits_at_spaces(json.loads(read["word"])) and not token_files.splits_at_spaces(json.loads(read["byte"]))


def test_only_misses_are_encoded(llm, messy, nothing, path_of, rows_of):
    cache, path = scratch_path(llm, "cache"), path_of("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    want = sorted([(r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False))) for r in messy.collect()], key=repr)
    assert rows_of(token_counts.count_tokens(messy.where("doc_id < 8"), path, cache)) == [r for r in want if r[0] is not None and r[0] < 8]
    stored = llm.read.parquet(cache)
    first = stored.count()
    assert first == messy.where("doc_id < 8").selectExpr("coalesce(text, '')").distinct().count()
    assert rows_of(token_counts.count_tokens(messy, path, cache)) == want
    everything = messy.selectExpr("coalesce(text, '')").distinct().count()
    assert llm.read.parquet(cache).count() == everything > first
    assert rows_of(token_counts.count_tokens(messy, path, cache)) == want and llm.read.parquet(cache).count() == everything
    # A count that was stored is believed, another tokenizer's is not, and one stored twice does no harm.
    llm.read.parquet(cache).write.mode("append").parquet(cache)
    assert rows_of(token_counts.count_tokens(messy, path, cache)) == want
    other = token_counts.count_tokens(messy, path_of("word_bpe_49k.json"), cache)
    assert rows_of(other, "n_tokens") != sorted([(r[2],) for r in want], key=repr)
    assert token_counts.count_tokens(nothing, path, cache).isEmpty()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**17 - 1) | st.integers(0, 5), max_size=120), max_size=6))
def test_blocks_round_trip(blocks):
    arrays = [np.array(b, dtype=np.int64) for b in blocks]
    coded = range_coder.encode_blocks(arrays, 17)
    assert [b.tolist() for b in range_coder.decode_blocks(coded, [len(b) for b in blocks], 17)] == blocks
    for ids, words in zip(arrays, coded):  # each alone
        assert range_coder.decode_blocks([words], [len(ids)], 17)[0].tolist() == ids.tolist()


def test_predictable_ids_take_little_room():
    rng = np.random.default_rng(1)
    for ids, most in ((np.tile([7, 90, 41000], 1300), 0.06), (rng.integers(0, 49408, 4000), 2.2), (rng.zipf(1.3, 4000) % 49408, 1.6)):
        words = range_coder.encode_blocks([ids], 16)[0]
        assert 2 * len(words) / len(ids) < most
    with pytest.raises(ValueError):
        range_coder.encode_blocks([np.array([1])], 30)


def test_ids_that_nothing_predicts_come_back():
    rng = np.random.default_rng(2)
    blocks = [rng.integers(0, 2**24, n) for n in (0, 700, 1, 4096, 129, 4000)]
    words = range_coder.encode_blocks(blocks, 24)
    assert max(map(len, words)) > 4096 * 5 // 4
    assert all((a == b).all() for a, b in zip(blocks, range_coder.decode_blocks(words, [len(b) for b in blocks], 24), strict=True))


def test_damage_is_noticed():
    pack = token_files.write_packs([[(5, np.arange(9000)), (None, np.array([], dtype=np.int64))]], 16)[0]
    assert [(i, ids.tolist()) for i, ids in token_files.read_packs([pack])[0]] == [(5, list(range(9000))), (None, [])]
    for place in (0, 4, 20, 60, len(pack) - 1):
        bad = bytearray(pack)
        bad[place] ^= 1
        with pytest.raises(token_files.CorruptPack):
            token_files.read_packs([bytes(bad)])
    with pytest.raises(token_files.CorruptPack):
        token_files.read_packs([pack[:10]])


@pytest.mark.parametrize("parts", [1, 5])
def test_token_files_of_messy_rows(llm, messy, nothing, path_of, rows_of, parts):
    path = path_of("word_bpe_49k.json")
    library, out = Tokenizer.from_file(path), scratch_path(llm, "tokens")
    before = llm.conf.get("spark.sql.adaptive.coalescePartitions.enabled"), llm.conf.get("spark.sql.shuffle.partitions")
    llm.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    llm.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        token_files.write_tokens(messy.repartition(3), out, path, 2)
    finally:
        llm.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[0])
        llm.conf.set("spark.sql.shuffle.partitions", before[1])
    encode = lambda t: library.encode(t or "", add_special_tokens=False).ids + [2]
    docs = sorted(((r.doc_id is not None, r.doc_id or 0, r.doc_id, encode(r.text)) for r in messy.collect()), key=repr)
    got = sorted(token_files.read_tokens(llm, out).collect(), key=lambda r: r.start)
    assert sorted(((r.doc_id is not None, r.doc_id or 0, r.doc_id, list(r.ids)) for r in got), key=repr) == docs
    assert [(r.doc_id is not None, r.doc_id or 0) for r in got] == sorted(d[:2] for d in docs)
    assert [r.start for r in got] == np.concatenate([[0], np.cumsum([len(r.ids) for r in got])[:-1]]).tolist()
    digests = {(r.start, r.n_tokens, r.ids_crc32) for r in token_files.read_token_digests(llm, out).collect()}
    assert digests == {(r.start, len(r.ids), zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())) for r in got}
    empty = scratch_path(llm, "tokens")
    token_files.write_tokens(nothing, empty, path, 2)
    assert token_files.read_tokens(llm, empty).isEmpty()
