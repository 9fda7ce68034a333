import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from reviewlens.llm import eliasfano, packing
from reviewlens.llm.queries import QUERIES
from reviewlens.llm.store import open_folder
from reviewlens.llm.subwords import Subwords
from tests.llm.conftest import FOLDER, TRICKY

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_library(library, documents):
    parts = ["a", "b", " ", "  ", "\n", ".", ",", "'s", "é", " ", "\x1c", "\t", "1", "漢", "!", "don't", "\r\n", "\x85", "ß.", " the", "$"]
    draw = np.random.default_rng(5)
    texts = ["".join(draw.choice(parts, draw.integers(0, 25))) for _ in range(5000)]
    texts += ["end <|endoftext|> next", "<|endoftext|>", "a<|endoftext|>b <|endoftext|><|endoftext|> c", "a <|endoftext| >"]
    texts += [r[1] or "" for r in TRICKY] + [r["text"] for r in documents.collect()]
    encoder = Subwords(PATH)
    for begin in range(0, len(texts), 1000):  # later batches meet pieces of earlier ones
        part = texts[begin : begin + 1000]
        ids, starts = encoder.encode(pa.array(part))
        for k, text in enumerate(part):
            assert ids[starts[k] : starts[k + 1]].tolist() == library(text), repr(text[:200])


def test_the_library_gets_pieces_in_few_texts(library):
    words = [f"w{k}{mark}" for k in range(20_000) for mark in ("", ".", " ", "\u2003", " \n", "é")]
    texts = [" ".join(words[k : k + 500]) for k in range(0, len(words), 500)]
    texts += [words[k] for k in range(40)] + ["", " ", "\n", "é ", "x" * 200_000 + " y"]
    encoder, given = Subwords(PATH), []
    whole = encoder.library
    encoder.library = lambda some: given.extend(some) or whole(some)
    ids, starts = encoder.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == [library(t) for t in texts]
    plain = [" ".join(words[k : k + 500 : 6]) for k in range(0, len(words), 500)]
    given.clear()
    encoder.encode(pa.array(plain))
    assert len(given) < 2 * len(plain)  # first pieces, a few with white space, and the others joined
    encoder.bytes_of[:] = 3  # as if it were no byte-level vocabulary: pieces are encoded one by one
    ids, starts = encoder.encode(pa.array(plain))
    assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == [library(t) for t in plain]


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 257, 5000])
def test_elias_fano_round_trip(n):
    draw = np.random.default_rng(n)
    for values in (np.sort(draw.integers(0, 10**9, n)), np.sort(draw.integers(0, 9, n)), np.zeros(n, np.int64)):
        sequence = eliasfano.Sequence(eliasfano.encode(values))
        assert (sequence.slice(0, n) == values).all()
        for a in draw.integers(0, n + 1, 20):
            assert (sequence.slice(int(a), int(a) + 300) == values[a : a + 300]).all()
        assert all(sequence.select(k) == values[k] for k in range(0, n, 97))


def test_boundaries_need_few_bits():
    starts = np.cumsum(np.random.default_rng(1).integers(1, 2000, 100_000))
    assert len(eliasfano.encode(starts)) * 8 / len(starts) < 2.2 + np.log2(starts[-1] / len(starts)) + 1


def expected(rows, library):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    at, out = 0, []
    for doc, text in order:
        ids = [*library(text), 0]
        out.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def read(df):
    rows = [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in df.collect()]
    return sorted(rows, key=lambda r: r[1])


def test_query_equals_plain_packing(spark, documents, library):
    want = expected([(r["doc_id"], r["text"]) for r in documents.collect()], library)
    assert read(QUERIES["op7_token_ids_elias_fano"](spark, FOLDER)) == want


@pytest.mark.parametrize("limits", [{}, {"shard_docs": 2}, {"shard_ids": 10}])
def test_edge_rows(tricky, library, limits):
    folder, manifest = packing.write_shards(tricky, PATH, **limits)
    assert read(packing.read_shards(folder, manifest)) == expected([r[:2] for r in TRICKY], library)


def test_random_access(tricky, library):
    folder, manifest = packing.write_shards(tricky, PATH)
    by_doc = {r[0]: r[1] for r in TRICKY}
    system, path = open_folder(folder)
    for entry in manifest.collect():
        shard = packing.Shard(system, f"{path}/{entry['file']}")
        for k in range(shard.n_docs):
            doc = shard.doc_ids(k, k + 1)[0]
            assert shard.document(k).tolist() == [*library(by_doc[doc]), 0]


def test_empty_table(tricky):
    assert packing.read_shards(*packing.write_shards(tricky.limit(0), PATH)).count() == 0
