import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm import token_files as T

PATH = public_tokenizers.path("byte_bpe_50k.json")


def expected(rows):
    tokenizer, start, out = Tokenizer.from_file(PATH), 0, []
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_round_trip_equals_plain_encoding(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    assert sorted(map(tuple, T.encode_and_read(docs, PATH).collect())) == expected(rows)


def test_odd_rows(spark, odd_docs, no_docs):
    out = T.encode_and_read(odd_docs, PATH).collect()
    assert len(out) == odd_docs.count()
    assert sorted(r["start"] for r in out)[0] == 0 and sum(r["n_tokens"] for r in out) == max(r["start"] + r["n_tokens"] for r in out)
    assert T.encode_and_read(no_docs, PATH).count() == 0


def test_pieces_equal_whole_texts():
    encoder = T.Encoder(PATH)
    for text in ("a  b\n\n c\t d  ", "<|endoftext|> hi", "É ñ 日本語   x's 12ab!!", "", "x² ½ 12٣ a_b __ ᵃ Ⅷ \x1c\x85", "\U0001f600 'll we've"):
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash(n):
    keys = np.random.default_rng(n).permutation(n * 3)[:n].astype(np.int64) - n
    values = np.arange(n)
    index = T.Index(T.index_bytes(keys, shard=values, row=values, rows=values, offset=values * 2, count=values * 3))
    ok, found = index.find(keys)
    assert ok.all() and (found["offset"] == values * 2).all()
    assert sorted(index.hash.slots(keys).tolist()) == list(range(n))  # minimal and perfect
    ok, _ = index.find(np.arange(10**9, 10**9 + 2000, dtype=np.int64))
    assert not ok.any()


def test_small_shards_and_single_keys(spark):
    """Shards and index files of a few rows; rows of a key lie in several shards; every key is read alone too."""
    texts = {i: " ".join(f"w{i} a{k}" for k in range(i % 7)) for i in range(120)}
    rows = [*texts.items(), *[(40, f"again {k}") for k in range(25)], (None, "no key"), (None, None), (41, None), (41, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    folder = T.shared_dir(spark, "small-shards")
    manifest = T.write(docs, folder, PATH, shard_bytes=100, shard_rows=6)
    T.build_index(manifest, folder, keys_a_file=30)
    assert len(T.shards_of(folder)) > 20 and T.index_files(folder) > 3
    out = T.read_keys(manifest.select("key"), folder, nulls=True).collect()
    order = manifest.orderBy("shard", "row").collect()
    assert [r["key"] for r in order] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    assert sorted(r["start"] for r in out) == [sum(r["n_tokens"] for r in order[:i]) for i in range(len(order))]
    encode = Tokenizer.from_file(PATH).encode
    want = sorted([(i if i is not None else -1, zlib.crc32(np.array([*encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes())) for i, t in rows])
    assert sorted((r["key"] if r["key"] is not None else -1, r["ids_crc32"]) for r in out) == want
    for key in [*texts, 40, 41]:
        got = sorted(zlib.crc32(ids.astype("<u4").tobytes()) for ids in T.get(folder, key))
        assert got == sorted(c for i, c in want if i == key)
    assert T.get(folder, 10**12) is None and T.get(folder, -5) is None


def test_keys_must_be_whole_numbers(spark):
    with pytest.raises(TypeError):
        T.write(spark.createDataFrame([("a", "b")], "doc_id string, text string"), T.shared_dir(spark, "string-keys"), PATH)
