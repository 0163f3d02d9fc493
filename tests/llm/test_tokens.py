import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from foldmark.llm import packing, token_files, vocab
from foldmark.llm.vocab import ID, Encoder, public_path
from tests.llm.brute import docs_of, rows_of

SF = "/root/testdata/sf0.001"
ODD = [
    *["", " ", "  a b", "a  b\n c ", "x\n\ny z", "\ta b", "it's I'm don't 12 345", "a  b", "Σς ΟΔΟΣ a"],
    *["é ̈a", "<|endoftext|> x", "a\x1cb \x1c c", "ﬁ Ａ", "😀 😀a", "word " * 9000],
]


def plain_ids(name, texts):
    encoder = Encoder(public_path(name), True)
    return [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("name, keeps", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_pieces_give_the_librarys_ids(name, keeps):
    texts = pq.read_table(f"{SF}/documents.parquet")["text"].to_pylist() + ODD
    got = Encoder(public_path(name), keeps).encode(texts)
    assert [np.frombuffer(g, ID).tolist() for g in got] == plain_ids(name, texts)


def test_memory_of_pieces_starts_anew(monkeypatch):
    monkeypatch.setattr("foldmark.llm.vocab.REMEMBERED", 3)
    texts = ["a b c d e", "f g a b", "h"]
    got = Encoder(public_path("byte_bpe_50k.json"), True)
    assert [np.frombuffer(x, ID).tolist() for t in texts for x in got.encode([t])] == plain_ids("byte_bpe_50k.json", texts)


@pytest.mark.parametrize("tabled, recent", [(5, 3), (3_000_000, 100), (3_000_000, 150_000)])
def test_columns_give_the_librarys_ids(monkeypatch, tabled, recent):
    monkeypatch.setattr(vocab, "TABLED", tabled)
    monkeypatch.setattr(vocab, "RECENT", recent)
    vocab._worker_memory((public_path("byte_bpe_50k.json"), "table")).clear()
    texts = pq.read_table(f"{SF}/documents.parquet")["text"].to_pylist() + ODD + ["", "a b", "a\n\nb c", "x \n", "Word. word, word\nWord"]
    want, encoder = [x + [7] for x in plain_ids("byte_bpe_50k.json", texts)], vocab.ColumnEncoder(public_path("byte_bpe_50k.json"))
    for _ in range(2):  # the second time from the table
        ids, n = encoder.encode_column(pa.array(texts), 7)
        assert n.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]
    single = [encoder.encode_column(pa.array([t]), 7)[0].tolist() for t in texts[-30:]]
    assert single == want[-30:]
    assert len(encoder.table) <= max(tabled, len({p for t in texts for p in t.replace("\n", " \n").split(" ")}))


ROWS = [(5, "one two three"), (5, "one two three"), (None, "no key"), (2**60 + 1, "large key"), (1, None), (3, ""), (4, "long " * 9000), (9, ODD[9])]


def test_packing(spark):
    got = rows_of(packing.pack_documents(docs_of(spark, ROWS)))
    ids = [x + [1] for x in plain_ids("word_bpe_49k.json", [t or "" for _, t in ROWS])]
    want = sorted(
        (str(key), n, at, len(x[at : at + 4096]), zlib.crc32(np.array(x[at : at + 4096], ID).tobytes()))
        for (key, _), x in zip(ROWS, ids)
        for n, at in enumerate(range(0, len(x), 4096))
    )
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    assert_packed(got, 4096)


def assert_packed(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return bins


def test_packing_is_tight_in_several_chunks(spark, tmp_path):
    rng = np.random.default_rng(3)
    sizes = [int(x) for x in rng.integers(1, 1000, 3000)]
    rows = [(i, 0, 0, n, zlib.crc32(str(i).encode())) for i, n in enumerate(sizes)]
    spark.createDataFrame(rows, packing.PIECES).write.parquet(str(tmp_path / "pieces"))
    pieces = spark.read.parquet(str(tmp_path / "pieces"))
    got = rows_of(packing.place_pieces(pieces, 4096, 64, chunk_tokens=400_000))
    assert len({r["sequence_id"] // packing.BINS_PER_CHUNK for r in got}) == 4
    assert len(got) == 3000 and len(assert_packed(got, 4096)) <= 1.03 * sum(sizes) / 4096


def test_tightest_bin_and_fullest_closes():
    bins = packing.OpenBins(10, 2)
    assert [bins.place(n) for n in (6, 7, 3, 4, 9, 8, 2)] == [(0, 0), (1, 0), (1, 7), (0, 6), (2, 0), (3, 0), (3, 8)]
    bins = packing.OpenBins(10, 2)
    assert [bins.place(n) for n in (6, 7, 8, 4, 2)] == [(0, 0), (1, 0), (2, 0), (0, 6), (2, 8)]


@pytest.mark.parametrize("n, kinds", [(0, 5), (1, 1), (5, 2), (1024, 3), (5000, 700), (70_000, 50_000)])
def test_rans_round_trip(n, kinds):
    ids = (np.random.default_rng(n).integers(0, kinds, n) ** 2 // max(1, kinds)).astype(ID)
    coder = token_files.Coder(token_files.scaled_frequencies(np.bincount(ids, minlength=kinds + 5)))
    payload = coder.encode(ids)
    assert coder.decode(payload).tolist() == ids.tolist()
    if n > 100:
        broken = bytearray(payload)
        broken[-1] ^= 1
        with pytest.raises(ValueError):
            coder.decode(bytes(broken))


def test_rans_is_near_the_entropy():
    ids = np.minimum(np.random.default_rng(1).geometric(0.1, 200_000), 99).astype(ID)
    counts = np.bincount(ids)
    p = counts[counts > 0] / len(ids)
    payload = token_files.Coder(token_files.scaled_frequencies(counts)).encode(ids)
    assert len(payload) * 8 < 1.01 * len(ids) * -(p * np.log2(p)).sum() + 8 * 8 * token_files.LANES + 300


def test_token_files(spark):
    got = sorted(rows_of(token_files.token_file_rows(docs_of(spark, ROWS))), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, 1, 3, 4, 5, 5, 9, 2**60 + 1]
    start = 0
    by_key = {key: x for (key, _), x in zip(ROWS, plain_ids("byte_bpe_50k.json", [t or "" for _, t in ROWS]))}
    for r in got:
        ids = by_key[r["doc_id"]] + [0]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, ID).tobytes()))
        start += len(ids)


def test_read_ids_back(spark, tmp_path):
    token_files.write_token_files(docs_of(spark, ROWS), str(tmp_path / "set"))
    got = {r["doc_id"]: r["ids"] for r in rows_of(token_files.read_token_files(spark, str(tmp_path / "set")))}
    assert got[3] == [0] and got[9] == plain_ids("byte_bpe_50k.json", [ROWS[-1][1]])[0] + [0]


def test_empty_tables(spark):
    assert packing.pack_documents(docs_of(spark, [])).collect() == []
    assert token_files.token_file_rows(docs_of(spark, [])).collect() == []
