import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarrylake.llm import packing, token_planes, tokens
from quarrylake.llm.queries import QUERIES

from .conftest import ODD

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
#: Strings of added tokens, whole, in parts and in capitals, and what may stand beside them.
ADDED = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "endoftext", "<|end", "a", "É", " ", "\n", "!!", "'s", "9"]


@pytest.fixture(scope="module")
def tokenizer():
    return tokenizers.Tokenizer.from_file(PATH)  # as it is: no flag set


def plain(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], np.uint32)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=25) | st.text(alphabet="abÉéß'.,!* \t\n9ΣİŸ", max_size=40) | st.lists(st.sampled_from(ADDED), max_size=9).map("".join), max_size=5))
def test_words_give_the_ids_of_whole_texts(tokenizer, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    ids, offsets = tokens.word_ids(PATH).encode(pa.array(texts, pa.string()), 2)
    for i, t in enumerate(texts):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == plain(tokenizer, t).tolist()


def test_strings_of_added_tokens(tokenizer):
    ids, _ = tokens.word_ids(PATH).encode(pa.array(["hello <|endoftext|> world"]), None)
    assert ids.tolist() == tokenizer.encode("hello <|endoftext|> world", add_special_tokens=False).ids and len(ids) == 3


def test_a_small_cache_changes_nothing():
    small, texts = tokens.WordIds(PATH, limit=3), pa.array(["one two three four", "two five, six", "one"])
    for _ in range(2):
        assert small.encode(texts, 2)[0].tolist() == tokens.word_ids(PATH).encode(texts, 2)[0].tolist()
    assert tokens.WordIds(PATH, whole=True).encode(texts, 2)[0].tolist() == small.encode(texts, 2)[0].tolist()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=70), st.booleans(), st.sampled_from([8, 16, 64]))
def test_planes_round_trip(ids, bits, block):
    ids = np.array(ids, np.uint32)
    assert token_planes.decode_chunk(token_planes.encode_chunk(ids, bits, block)).tolist() == ids.tolist()


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))


@pytest.mark.parametrize("folder", ["odd", "small"])
def test_token_files(spark, request, tokenizer, folder):
    path = request.getfixturevalue(folder)
    rows = ordered([(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()])
    want, start = [], 0
    for i, t in rows:
        ids = plain(tokenizer, t)
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op5_token_planes"](spark, path).collect()]
    assert sorted(got, key=lambda r: r[1]) == want


def test_token_files_hold_the_ids(spark, odd, tmp_path, tokenizer):
    docs = spark.read.parquet(f"{odd}/documents.parquet").where("doc_id = 9 OR doc_id = 6")
    token_planes.write_tokens(docs, f"file://{tmp_path}/t", PATH, bits=True, chunk_ids=50)
    got = {r.doc_id: r.ids for r in token_planes.read_tokens(spark, f"file://{tmp_path}/t", with_ids=True).collect()}
    assert got == {i: plain(tokenizer, t).tolist() for i, t, *_ in ODD if i in (6, 9)}
    index = spark.read.parquet(f"file://{tmp_path}/t/index").orderBy("start").collect()
    assert [r.start for r in index] == [0, *np.cumsum([r.n_ids for r in index]).tolist()[:-1]]


def test_empty_tables(spark, empty):
    assert QUERIES["op5_token_planes"](spark, empty).count() == QUERIES["op4_packing"](spark, empty).count() == 0


def check_packing(spark, path, tokenizer):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    got = QUERIES["op4_packing"](spark, path).collect()
    want = sorted(
        (repr(i), a, min(4096, len(ids) - a), zlib.crc32(ids[a : a + 4096].tobytes()), len(ids)) for i, t in rows for ids in [plain(tokenizer, t)] for a in range(0, len(ids), 4096)
    )
    assert sorted((repr(r.doc_id), r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    return sum(w[2] for w in want) / (4096 * len(sequences))


def test_packing(spark, odd, small, tokenizer):
    check_packing(spark, odd, tokenizer)
    assert check_packing(spark, small, tokenizer) > 0.95


def test_packing_ranks_in_buckets(spark, odd, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "RANKED", 1)
    check_packing(spark, odd, tokenizer)


def test_sequences(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    got = packing.sequences(docs, PATH).collect()
    assert all(len(r.ids) == 4096 for r in got) and sum(len(r.doc_ids) for r in got) >= len(ODD)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 63), st.integers(1, 40), max_size=12))
def test_plan_places_each_piece_once(histogram):
    plan, n = packing.shortest_pack_first(histogram, 64)
    seen, filled = set(), {}
    for length, rank, count, first, offset in plan.tolist():
        for k in range(count):
            assert (length, rank + k) not in seen and 0 <= first + k < n
            seen.add((length, rank + k))
            filled.setdefault(first + k, []).append((offset, length))
    assert seen == {(length, r) for length, c in histogram.items() for r in range(c)}
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
