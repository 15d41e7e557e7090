"""BPE encoding and decoding, and token-id files, against the tokenizers library."""
from __future__ import annotations

import hashlib
import zlib

import llm_cases as C
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reqtrail.llm import bpe, token_files
from reqtrail.llm.common import shared_folder

public = pytest.importorskip("public_tokenizers")
PATH = public.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abcdeTHING' .,<|>endoftxs\n\t\x1c\x85 éÉßΣς漢²́"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_encoding_is_the_librarys(text):
    from tokenizers import Tokenizer

    library = test_encoding_is_the_librarys.__dict__.setdefault("library", Tokenizer.from_file(PATH))
    ids = bpe.encode_texts([text.encode()], PATH)[0].tolist()
    assert ids == library.encode(text, add_special_tokens=False).ids
    assert token_files._chunks(PATH).encode([text.encode()], 2)[0] == np.array(ids + [2], "<u4").tobytes()


@pytest.mark.parametrize("text", ["<|endoftext|>a<|startoftext|>", "a<|endoftext|", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "abcabcabc" * 50, "Ᲊx", "\U000105c0"])
def test_special_tokens_and_new_letters(library, text):
    assert bpe.encode_texts([text.encode()], PATH)[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_all_pairs_of_a_small_alphabet_need_no_backtracking_errors(library):
    import itertools

    for word in map("".join, itertools.product("ane", repeat=6)):
        assert bpe.encode_texts([word.encode()], PATH)[0].tolist() == library.encode(word, add_special_tokens=False).ids


def test_encode_and_decode_edge_cases(spark, library):
    got = sorted((r.doc_id is not None, r.doc_id or 0, tuple(r.ids), r.decoded) for r in bpe.encode(C.frame(spark), PATH, decoded=True).collect())
    want = []
    for d, t, *_ in C.rows():
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((d is not None, d or 0, tuple(ids), library.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want)
    back = bpe.decode(bpe.encode(C.frame(spark), PATH), PATH)
    assert sorted(r.text for r in back.collect()) == sorted(w[3] for w in want)
    assert bpe.encode(C.frame(spark, []), PATH, decoded=True).count() == 0


def test_token_files_round_trip(spark, library):
    folder = shared_folder(spark, "test-token-files")
    manifest = token_files.write_token_files(C.frame(spark), PATH, folder, files=3)
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32, tuple(r.ids)) for r in token_files.read_token_files(manifest, folder).orderBy("start").collect()]
    want, start = {}, 0
    for d, t, *_ in C.rows():
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        want.setdefault(d, []).append(tuple(ids))
    assert [g[0] for g in got] == [r[0] for r in C.in_order(C.rows())]
    for d, at, n, crc, ids in got:
        assert at == start and n == len(ids) and ids in want[d] and crc == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += n
    assert sum(map(len, want.values())) == len(got)
    assert manifest.agg(F.sum("ids")).first()[0] == start


def test_token_files_of_an_empty_table(spark):
    assert token_files.encode_corpus(spark, C.frame(spark, []), PATH).count() == 0


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, token_files.CHECKPOINT_STEP, token_files.BLOCK - 1, token_files.BLOCK + 1, 3 * token_files.BLOCK + 77])
def test_blocks_checkpoints_and_checksums(n):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.2, n) % 500).astype(np.int64)
    table = token_files.Table.from_counts(np.bincount(ids, minlength=500))
    writer = token_files.Writer(table)
    writer.add([7], np.array([n]), ids)
    data = writer.finish()
    reader = token_files.Reader(data, table)
    assert np.array_equal(np.concatenate([*reader.blocks(), np.zeros(0, np.uint32)]), ids)
    for start, count in [(0, n), (n // 3, n // 2), (max(0, n - 5), min(5, n))]:
        assert np.array_equal(reader.ids(start, min(count, n - start)), ids[start:start + count])
    if n > 1000:  # there are words of the stream to break
        broken = bytearray(data)
        broken[8 + 32] ^= 255
        with pytest.raises(ValueError, match="checksum"):
            list(token_files.Reader(bytes(broken), table).blocks())


def test_one_symbol_and_even_tables():
    for counts in (np.array([5]), np.ones(40_000, np.int64), np.array([0, 10**12, 1])):
        table = token_files.Table.from_counts(counts)
        assert int(table.freq.sum()) == 1 << token_files.SCALE and ((table.freq > 0) == (counts > 0)).all()
        ids = np.flatnonzero(counts)[:1000]
        writer = token_files.Writer(table)
        writer.add([1], np.array([len(ids)]), ids)
        assert np.array_equal(np.concatenate(list(token_files.Reader(writer.finish(), table).blocks())), ids)


def test_query_digests(spark, library, tmp_path):
    from reqtrail.llm import queries

    C.frame(spark, clashing=False).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op10_bpe(spark, str(tmp_path)).collect())
    want = []
    for d, t, *_ in C.rows():
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((d or 0, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want)
