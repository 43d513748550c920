import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from helpers import awkward, frame
from ledgerline.llm import op12_token_files as op

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, encoding="utf-8") as file:
        return file.read()


def texts():
    rng = random.Random(1)
    pool = "abc ABC  \n\t\r'stve0123456789.,!?;:éäßñÀÉ×÷漢字かな🙂́​ \x00\x1c…İΣς<|endoftext|>"
    out = ["".join(rng.choice(pool) for _ in range(rng.randrange(0, 300))) for _ in range(300)]
    return out + ["", " \n", "a" * 3000, "<|endoftext|>", "x<|endoftext|>.", "Don't stop... 'Tis É. é.! …. a.b. 1. ok.)", "É́. ÷. ×, ï; ÿ", "́. é.  ."]


@pytest.mark.parametrize("remembered", [5, 10**6])
def test_ids_of_pieces_are_those_of_whole_texts(vocabulary, remembered):
    plain = Tokenizer.from_file(PATH)
    own = op.Encoder(vocabulary, remembered)
    every = texts() + [f"then {own.between[0]} and {own.between[0].upper()}."]
    for part in (every[:100], every, every[50:]):
        raw = [t.encode() for t in part]
        ids, counts = own.ids(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
        want = [plain.encode(t, add_special_tokens=False).ids + [op.END_ID] for t in part]
        assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


@pytest.mark.parametrize("distinct", [1, 2, 3, 40, 5000, 65_536])
def test_blocks_round_trip(distinct):
    rng = np.random.default_rng(distinct)
    ranks = np.minimum((distinct ** rng.random(7000)).astype(np.int64), distinct - 1)
    ranks[2000:4000] = np.tile(ranks[:40], 50)
    sizes = np.array([1, 1024, 7, 1024, 1024, 900, 1, 1024, 1024, 971])
    words, used = op.encode_blocks(ranks, sizes, distinct)
    assert np.array_equal(op.decode_blocks(words, used, sizes, distinct), ranks)
    # each block stands alone
    at, first = np.cumsum(sizes) - sizes, np.cumsum(used) - used
    for i in (0, 2, 5):
        assert np.array_equal(op.decode_blocks(words[first[i] : first[i] + used[i]], used[i : i + 1], sizes[i : i + 1], distinct), ranks[at[i] : at[i] + sizes[i]])


def test_repetition_is_cheap():
    """Predictions of order 2 make a loop cost little, order 0 alone could not."""
    loop = np.tile(np.arange(200), 20)
    words, _ = op.encode_blocks(loop, np.array([4000]), 200, 4000)
    assert 32 * len(words) / len(loop) < 2


def test_file_and_damage():
    rng = random.Random(3)
    ids = np.array([rng.choice([2, 7, 9, 49407, rng.randrange(49408)]) for _ in range(5000)], np.uint16)
    counts = np.array([1, 3000, 1999])
    content = op.file_bytes(3, 4, 99, pa.array([None, -5, 1 << 62]), counts, ids)
    head, doc_ids, back, got = op.read_file(content)
    assert (head["partition"], head["number"], head["before"], doc_ids) == (3, 4, 99, [None, -5, 1 << 62])
    assert back.tolist() == counts.tolist() and np.array_equal(got, ids)
    for at in [0, 4, 20, 60, len(content) // 2, len(content) - 9, len(content) - 1]:
        damaged = bytearray(content)
        damaged[at] ^= 0x40
        try:
            same = op.read_file(bytes(damaged))
        except ValueError:
            continue
        assert at >= len(content) - 9 and np.array_equal(same[3], ids)  # bits after the last id's
    with pytest.raises(ValueError):
        op.read_file(content[:-9] + content[-1:])


def check(rows, got):
    """Starts, counts and checksums of documents in ascending order."""
    plain = Tokenizer.from_file(PATH)
    order = sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    start, want = 0, []
    for doc_id, text in order:
        ids = np.array(plain.encode(text, add_special_tokens=False).ids + [2], "<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids)))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_query_on_awkward_rows(spark, tmp_path):
    rows = awkward() + [(-3, t) for t in texts()[:40]] + [(i, t) for i, t in enumerate(texts())]
    frame(spark, rows).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = op.op12_token_files(spark, str(tmp_path))
    assert got.dtypes == [("doc_id", "bigint"), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")]
    check(rows, got.collect())


def test_many_small_files_and_no_rows(spark, tmp_path, vocabulary):
    rows = [(i, t) for i, t in enumerate(texts()[:60])]
    op.write_files(frame(spark, rows), f"{tmp_path}/a", vocabulary, file_ids=300)
    got = op.read_ids(spark, f"{tmp_path}/a").orderBy("start").collect()
    plain = Tokenizer.from_file(PATH)
    assert [(r["doc_id"], list(r["ids"])) for r in got] == [(i, plain.encode(t, add_special_tokens=False).ids + [2]) for i, t in rows]
    assert spark.read.format("binaryFile").load(f"{tmp_path}/a").where(F.col("length") > 0).count() > 10
    op.write_files(frame(spark, []), f"{tmp_path}/b", vocabulary)
    assert op.read_checksums(spark, f"{tmp_path}/b").count() == 0


def test_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    check([tuple(r) for r in docs], op.op12_token_files(spark, "/root/testdata/sf0.001").collect())
